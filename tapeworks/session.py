"""Session helpers shared by batch jobs, streams and tests."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "tapeworks", **conf: str) -> SparkSession:
    """Session with the settings the library relies on.

    Nothing here fixes a partition count: on a cluster adaptive execution
    sizes shuffles from the data; tests pass ``spark.sql.shuffle.partitions``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Recording a stack trace for every expression makes planning slow.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on (frame times are UTC) and give workers the package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship(spark)
    return spark


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application.

    Workers then import it wherever they run; where it is installed on every
    machine the copy sent is the same code.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.TemporaryDirectory()  # the driver serves the archive from here until it ends
    archive = Path(folder.name) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as into:
        for source in sorted(package.rglob("*.py")):
            into.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    # Files sent along reach tasks only. The worker that a stateful stream starts beside the driver looks here.
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    environment["PYTHONPATH"] = os.pathsep.join([str(package.parent), *filter(None, known)])
    _shipped[application] = folder


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only on a local master,
    where driver and executors are one process, does a temporary folder take its place.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="tapeworks-")
    return _local_dirs[application]
