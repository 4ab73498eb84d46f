"""Several readers of one exchange."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def above_exchange(condition: Column) -> Column:
    """A condition that stays above the exchange it filters (it depends on the partition id, always >= 0), so that several
    filters of one exchange share it. A plain one would be pushed below it, and each reader would make - and feed - its own."""
    return F.when(F.spark_partition_id() >= F.lit(0), condition)
