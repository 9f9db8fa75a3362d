"""Integer vectors from a column of floats: which rows are kept, how they are quantised, and tables
that are dropped when the next one has been written."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm.files import new_folder

#: Largest component in absolute value for which every squared distance fits a long.
MAX_COMPONENT = 1 << 27


def finite(vector: Column) -> Column:
    """True for a vector that is there and holds finite numbers only."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, number), F.lit(False))


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as int. ``scale`` is a power of two, so the product is
    exact. A component out of bounds becomes ``MAX_COMPONENT + 1``, which :func:`check` finds."""
    one = lambda x: F.floor(x.cast("double") * F.lit(float(scale)))
    fits = lambda x: F.abs(x.cast("double") * F.lit(float(scale))) <= MAX_COMPONENT
    return F.transform(vector, lambda x: F.when(fits(x), one(x)).otherwise(MAX_COMPONENT + 1).cast("int"))


def check(table: DataFrame, column: str) -> int:
    """Rows of ``table``; raises where a component's squares would not fit a long."""
    n, most = table.agg(F.count(F.lit(1)), F.max(F.array_max(column))).first()
    if (most or 0) > MAX_COMPONENT:
        raise ValueError(f"a component beyond {MAX_COMPONENT} in absolute value: squared distances would not fit a long")
    return n


def matrix(col: pa.Array) -> np.ndarray:
    """Rows of a list column of one length, as int64."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0), np.int64)


def lists(m: np.ndarray, typ: pa.DataType) -> pa.ListArray:
    """A matrix as a list column."""
    n, d = m.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(m.reshape(-1), typ))


class Tables:
    """Tables of one iterative job in a folder of its own under the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, kind: str):
        self.spark, self.root = spark, new_folder(spark, kind)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
