"""Settings for replaying tables as streams, put back afterwards."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from math import isqrt

from pyspark.sql import SparkSession

#: Rows of a replay for which a partition of state is worth its files.
ROWS_OF_STATE = 200_000
#: Each task of a stateful operator sends the driver a metric for each of its partitions of state: for so many rows there
#: is one pair of them at most, so that what is sent grows with the rows, not with their square.
ROWS_OF_PAIR = 12_500


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions of state for so many rows: no more than the session has for a shuffle."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), max(4, min(rows // ROWS_OF_STATE, isqrt(rows // ROWS_OF_PAIR)))))


@contextmanager
def settings(spark: SparkSession, **values: str | int) -> Iterator[None]:
    """Settings (with ``__`` for a dot) that hold within the block."""
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
