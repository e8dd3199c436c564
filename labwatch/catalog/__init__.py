"""Every operator on the shared test tables, each with an independent SQL statement of its result."""

from labwatch.catalog.base import ORACLES, QUERIES  # noqa: F401
from labwatch.catalog import (  # noqa: F401  (each module registers its queries)
    aggregate_queries,
    check_queries,
    feed_queries,
    file_queries,
    function_queries,
    join_queries,
    projection_queries,
    summary_queries,
    window_queries,
)
