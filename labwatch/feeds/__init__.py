"""Declarative laboratory feeds."""

from labwatch.feeds.runner import convert_types, fix_values, run_feed, run_stages  # noqa: F401
from labwatch.feeds.spec import LabSpec  # noqa: F401
from labwatch.feeds.labs import FEEDS  # noqa: F401
