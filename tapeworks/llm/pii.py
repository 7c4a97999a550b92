"""Personal data by weak supervision.

Four patterns give the base spans. Looser candidates (bare phone numbers,
digit groups such as national ids, account numbers, names after a title, street
addresses) are voted on by labelers: regular expressions on the span's form,
gazetteers of words, and the words around it. A candidate's votes are one of a
fixed number of combinations, so counts of these describe the whole corpus.
Expectation-maximisation over the counts estimates how often each labeler is
right; the resulting probabilities train a logistic classifier on the span's
features, which also judges candidates that no labeler voted on.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm.common import whole_text, written

BASE = ("email", "ip", "card", "phone")
# The base patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The look-behind only skips starts inside a run of digits, which fail where the run's start failed.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Numbers have any groups, only few digits make none; accounts end in a group of 1 to 4, see ``account_end``.
LOOSE = re.compile(
    r"(?P<number>(?<![\w.+])\(?[0-9]++\)?(?:[\x20.-]{1,2}[0-9]++)+(?!\.*\w))"
    r"|(?P<account>(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<name>(?<!\w)(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Señora?)\.?\x20[A-ZÀ-Þ]\w++(?:\x20[A-ZÀ-Þ]\w++)?)"
    r"|(?P<address>(?<!\w)[0-9]++\x20(?:[A-ZÀ-Þ]\w++\x20){1,3}(?:Street|St|Road|Rd|Avenue|Ave|Lane|Drive)(?!\w))"
)
KINDS = ("number", "account", "name", "address")
FIRST_NAMES = frozenset("john mary james anna peter maria paul laura thomas sarah hans julia pierre marie luis carmen".split())
CONTEXT = frozenset(
    "phone tel telephone call mobile fax contact mail email e-mail address name ssn iban account passport born customer"
    " telefon anruf adresse konto kontakt appel adresse compte nom téléphone llamar teléfono dirección cuenta nombre".split()
)
AGAINST = frozenset("isbn version page pages chapter section figure table total price order item vol no year".split())
AROUND = 40
LEAST_DIGITS = 4
# The longest phone numbers and national ids.
MOST_DIGITS = 15
LONGEST_ACCOUNT = 34
US_FORM = re.compile(r"\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3,4}[\x20.-][0-9]{3,5}|[0-9]{3}-[0-9]{2}-[0-9]{4}")
DATE = re.compile(r"[0-9]{1,2}[\x20.-][0-9]{1,2}[\x20.-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}[\x20.-][0-9]{1,2}[\x20.-][0-9]{1,2}")
# One row of weights per combination of features; see ``features``.
FEATURES = 13
THRESHOLD = 0.8
_WORD = re.compile(r"[\w-]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Each at-sign with the longest local part before it and a domain after it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, free))
        at = text.find("@", max(at + 1, free))
    return found


def ips(text: str) -> list[tuple[int, int]]:
    fits = lambda part: len(part) <= 3 and int(part or "0") <= 255
    return [m.span() for m in IP.finditer(text) if all(fits(part.lstrip("0")) for part in m.group().split("."))]


def passes_luhn(digits: str) -> bool:
    double = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    values = [ord(d) - 48 for d in reversed(digits)]
    return (sum(values[::2]) + sum(double[v] for v in values[1::2])) % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    spans = {"email": emails(text) if "@" in text else [], "ip": [], "card": [], "phone": []}
    if DIGIT.search(text):
        spans["ip"] = ips(text)
        for match in CARD.finditer(text):
            digits = re.sub("[ -]", "", match.group())
            if 16 <= len(digits) <= 19 and passes_luhn(digits):
                spans["card"].append(match.span())
        if "+" in text:
            for match in PHONE.finditer(text):
                if 8 <= len(re.findall("[0-9]", match.group())) <= 15:
                    spans["phone"].append(match.span())
    return spans


def account_end(span: str) -> int:
    """Where the account number at the start of ``span`` ends, 0 if it is none.

    Words in capitals may follow a spaced number. The longest prefix of whole
    groups with right check digits decides; without one, all groups count but
    a short last one of letters.
    """
    ends = [m.start() for m in re.finditer("\x20", span)] + [len(span)]
    for end in reversed(ends):
        compact = span[:end].replace(" ", "")
        if 15 <= len(compact) <= LONGEST_ACCOUNT and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1:
            return end
    last = span[ends[-2] + 1 :] if len(ends) > 1 else ""
    end = ends[-2] if last.isalpha() and len(last) < 4 else len(span)
    return end if len(span[:end].replace(" ", "")) <= LONGEST_ACCOUNT else 0


def number_form(digits: int, span: str) -> int:
    """1 for phone and id numbers of a known shape, 0 for dates and totals that none has, -1 for other shapes."""
    if digits < 7 or digits > MOST_DIGITS or DATE.fullmatch(span):
        return 0
    return 1 if digits <= 12 and US_FORM.fullmatch(span) else -1


def votes(kind: str, span: str, before: list[str], after: list[str]) -> tuple[int, ...]:
    """Each labeler's vote: 1 personal, 0 not, -1 none."""
    around = set(before) | set(after)
    digits = len(re.findall("[0-9]", span))
    form = number_form(digits, span) if kind == "number" else (1 if kind == "account" and digits >= 10 else -1)
    gazetteer = 1 if kind == "name" and any(w.lower() in FIRST_NAMES for w in span.split()) else (1 if kind == "address" else -1)
    context = 1 if around & CONTEXT else -1
    against = 0 if around & AGAINST else -1
    plain = 0 if kind == "number" and (digits < 7 or re.fullmatch(r"(19|20)[0-9]{2}[\x20.-].*", span)) else -1
    return form, gazetteer, context, against, plain


def features(kind: str, span: str, before: list[str], after: list[str]) -> int:
    """The span's features as bits: kind, length and form, context."""
    digits = len(re.findall("[0-9]", span))
    near = before[-1:] + after[:1]
    flags = [kind == k for k in KINDS]
    flags += [digits >= 7, digits >= 10, "-" in span or "." in span, "(" in span]
    flags += [bool(set(near) & CONTEXT), bool(set(before + after) & CONTEXT), bool(set(before + after) & AGAINST), len(span) > 20]
    flags += [kind == "number" and digits > MOST_DIGITS]
    return sum(1 << i for i, flag in enumerate(flags) if flag)


def candidates(text: str, taken: list[tuple[int, int]]):
    """Looser spans that no base span overlaps, with votes and features."""
    if not DIGIT.search(text) and not any(t in text for t in ("Mr", "Ms", "Dr", "Herr", "Frau", "Mme", "Señor")):
        return
    taken = sorted(taken)
    at = free = 0
    while match := LOOSE.search(text, free):
        start, end = match.span()
        kind = match.lastgroup
        if kind == "account":
            end = start + account_end(match.group())
        elif kind == "number" and end - start < 3 * LEAST_DIGITS and len(DIGIT.findall(match.group())) < LEAST_DIGITS:
            end = start
        if end == start:
            free = start + 1
            continue
        free = end
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at < len(taken) and taken[at][0] < end:
            continue
        before = _WORD.findall(text[max(0, start - AROUND) : start].lower())
        after = _WORD.findall(text[end : end + AROUND].lower())
        span = text[start:end]
        yield kind, start, end, votes(kind, span, before, after), features(kind, span, before, after)


def pattern_of(vote: tuple[int, ...]) -> int:
    return sum((v + 1) * 3**i for i, v in enumerate(vote))


def votes_of(pattern: int, labelers: int) -> list[int]:
    return [pattern // 3**i % 3 - 1 for i in range(labelers)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spot = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pattern", pa.int32()), ("features", pa.int32())]))
    for batch in batches:
        base, loose = [], []
        for text in batch.column(1).to_pylist():
            spans = base_spans(text)
            taken = [s for found in spans.values() for s in found]
            base.append([{"kind": k, "start": a, "end": b} for k in BASE for a, b in spans[k]])
            loose.append(
                [
                    {"kind": kind, "start": a, "end": b, "pattern": pattern_of(vote), "features": bits}
                    for kind, a, b, vote, bits in candidates(text, taken)
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(base, pa.list_(pa.struct(list(spot.value_type)[:3]))), pa.array(loose, spot)],
            names=["doc_id", "base", "loose"],
        )


SPOTS = "base array<struct<kind:string,start:int,end:int>>, loose array<struct<kind:string,start:int,end:int,pattern:int,features:int>>"


def reliabilities(counts: dict[int, int], labelers: int, rounds: int = 100) -> tuple[float, np.ndarray, dict[int, float]]:
    """Prior, each labeler's vote distribution in both classes, and the probability of every pattern.

    Expectation-maximisation over independent labelers that may abstain; it
    starts from the share of positive among the votes cast. Counts of one half
    are added to every vote, so nothing becomes impossible.
    """
    patterns = list(counts)
    n = np.array([counts[p] for p in patterns], float)
    cast = np.array([votes_of(p, labelers) for p in patterns])
    positive, negative = (cast == 1).sum(1), (cast == 0).sum(1)
    belief = (positive + 0.5) / (positive + negative + 1.0)
    for _ in range(rounds):
        prior = float((n @ belief + 1) / (n.sum() + 2))
        table = np.zeros((2, labelers, 3))
        for c, weight in enumerate((n * (1 - belief), n * belief)):
            for v in range(3):
                table[c, :, v] = ((cast == v - 1) * weight[:, None]).sum(0) + 0.5
        table /= table.sum(2, keepdims=True)
        score = np.full(len(patterns), math.log(prior) - math.log(1 - prior))
        for i in range(labelers):
            score += np.log(table[1, i, cast[:, i] + 1]) - np.log(table[0, i, cast[:, i] + 1])
        belief = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return prior, table, dict(zip(patterns, belief.tolist()))


def classifier(pairs: dict[int, tuple[float, float]], rounds: int = 300) -> np.ndarray:
    """Logistic weights (bias last) from the counts and mean probabilities of feature combinations."""
    bits = list(pairs)
    x = np.array([[b >> i & 1 for i in range(FEATURES)] + [1] for b in bits], float)
    n, y = np.array([pairs[b] for b in bits], float).T
    weights = np.zeros(FEATURES + 1)
    for _ in range(rounds):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (n * (y - p)) - 0.1 * weights
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(FEATURES + 1)
        step = np.linalg.solve(hessian, gradient)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return weights


def find(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, base, added`` of every row: arrays of ``kind, start, end`` in code points.

    ``base`` is ordered by kind and start; ``added`` are the candidates that the
    classifier finds personal with at least ``threshold``, by start. Null and
    empty texts have none. Rows that repeat an id are judged one by one.
    """
    kind = dict(docs.dtypes)[id_col]
    scanned = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(_scan, f"doc_id {kind}, {SPOTS}")
    scanned = written(spark, scanned, "pii")
    labelers = len(votes("number", "", [], []))
    # At most 3^labelers patterns times 2^FEATURES combinations, however many spans.
    seen = scanned.select(F.explode("loose").alias("c")).groupBy("c.pattern", "c.features").count().collect()
    weights = np.zeros(FEATURES + 1)
    if seen:
        counts: dict[int, int] = {}
        for r in seen:
            counts[r["pattern"]] = counts.get(r["pattern"], 0) + r["count"]
        belief = reliabilities(counts, labelers)[2]
        pairs: dict[int, tuple[float, float]] = {}
        for r in seen:
            n, y = pairs.get(r["features"], (0.0, 0.0))
            more = r["count"]
            pairs[r["features"]] = (n + more, (n * y + more * belief[r["pattern"]]) / (n + more))
        weights = classifier(pairs)
    score = lambda c: sum(
        (F.when(c.getField("features").bitwiseAND(1 << i) != 0, float(weights[i])).otherwise(0.0) for i in range(FEATURES)), F.lit(float(weights[-1]))
    )
    least = math.log(threshold / (1 - threshold))
    chosen = F.filter("loose", lambda c: score(c) >= least)
    added = F.transform(chosen, lambda c: F.struct(c.getField("kind").alias("kind"), c.getField("start").alias("start"), c.getField("end").alias("end")))
    return scanned.select("doc_id", "base", added.alias("added"))


def report(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Per row the counts of base spans, their digest and all spans as text."""
    found = find(spark, docs, **options)
    text = lambda spans: F.array_join(
        F.transform(spans, lambda c: F.concat_ws(":", c.getField("kind"), c.getField("start"), c.getField("end"))), ","
    )
    of = lambda spans, kind: F.filter(spans, lambda c: c.getField("kind") == kind)
    # By kind, base kinds first, then by start.
    every = F.concat("base", F.flatten(F.array(*[of("added", kind) for kind in KINDS])))
    return found.select(
        "doc_id",
        *[F.size(of("base", kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE],
        F.sha2(text(F.col("base")), 256).alias("base_sha256"),
        text(every).alias("spans"),
    )
