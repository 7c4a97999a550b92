"""Every registered query: name -> (query, SQL with the same result)."""

from tapeworks.plans import (
    config_queries,
    frame_queries,
    history_queries,
    metric_queries,
    state_queries,
)

QUERIES = {
    **frame_queries.QUERIES,
    **metric_queries.QUERIES,
    **state_queries.QUERIES,
    **config_queries.QUERIES,
    **history_queries.QUERIES,
}
