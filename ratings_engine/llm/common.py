"""Small helpers the operators of this package share."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratings_engine.sources import storage

WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use refers to it (also in lambdas)."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """The words of a text, none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written once to the folder the cluster shares and read from there."""
    return storage.stage(df, label)[0]


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: How many arrays one task adds up.
FAN_IN = 16


def summed(rows: DataFrame, zero: np.ndarray, part: Callable) -> np.ndarray:
    """Sum over all rows of an array of fixed size. part(total, column) adds an Arrow column to it.

    Each task makes one array; tasks add up FAN_IN of them at a time until few are left for the driver."""

    def packed(array):
        return zlib.compress(array.tobytes(), 1)

    def each(batches):
        total = zero.copy()
        for batch in batches:
            part(total, batch.column(0))
        yield pa.RecordBatch.from_pydict({"part": [packed(total)]})

    def add(table):
        total = zero.copy()
        for array in table.column("part"):
            total += np.frombuffer(zlib.decompress(array.as_py()), zero.dtype).reshape(zero.shape)
        return pa.table({"part": pa.array([packed(total)], pa.binary())})

    count = rows.rdd.getNumPartitions()
    parts = rows.mapInArrow(each, "part binary").withColumn("slot", F.spark_partition_id())
    while count > FAN_IN:
        count = -(-count // FAN_IN)
        parts = (parts.withColumn("slot", F.pmod("slot", F.lit(count))).groupBy("slot")
                 .applyInArrow(lambda key, table: add(table).append_column("slot", pa.array([key[0].as_py()], pa.int32())),
                               "part binary, slot int"))
    total = zero.copy()
    for row in parts.select("part").toLocalIterator():
        total += np.frombuffer(zlib.decompress(bytes(row[0])), zero.dtype).reshape(zero.shape)
    return total
