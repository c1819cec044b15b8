"""Imports every module that registers queries."""

from allelespan.plans import (  # noqa: F401
    filter_queries,
    interval_queries,
    layout_queries,
    pair_queries,
    statistic_queries,
)
