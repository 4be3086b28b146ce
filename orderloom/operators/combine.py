"""The feeds as one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from orderloom.schema import ORDER_COLUMNS


def combine_feeds(*feeds: DataFrame) -> DataFrame:
    """UNION ALL of order rows; duplicates stay."""
    return reduce(DataFrame.unionByName, (feed.select(*ORDER_COLUMNS) for feed in feeds))
