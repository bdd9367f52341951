"""What the training-data operators share."""

from __future__ import annotations

import ctypes
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.session import cut, ship

__all__ = ["batches_for", "connected_components", "cut", "fold_of", "matrix", "release", "runs_of", "ship", "table", "usable", "usual_length"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo `folds`; fold 0 is held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


def batches_for(df: DataFrame, size: Column, target: int, least: int = 24) -> int:
    """How many batches of about `target` bytes `df` makes; one aggregate over the input, two numbers to the driver."""
    total = df.agg(F.sum(F.coalesce(size, F.lit(0)).cast("long")).alias("n")).first()["n"] or 0
    return max(least, math.ceil(total / target))


def usable(vector: str = "embedding") -> Column:
    """A vector that takes part: not null, not empty, only finite components, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is larger than any number
    return F.coalesce(F.col(vector).isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def usual_length(df: DataFrame, vector: str = "embedding") -> int:
    """The commonest length of the usable vectors (ties: the shorter); 0 if there are none."""
    row = df.where(usable(vector)).groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return row["d"] if row else 0


def matrix(column):
    """An Arrow list column of equal lengths as a double matrix."""
    import numpy as np

    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    n = len(column)
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def release() -> None:
    """Hand freed memory back to the system: a Python worker lives on between groups and stages, and would keep its largest size."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def runs_of(offsets, size: int = 1 << 20):
    """Consecutive documents (first, last + 1) of about `size` bytes together, at least one each; bounds a worker's scratch memory."""
    import numpy as np

    first, docs = 0, len(offsets) - 1
    while first < docs:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        yield first, last
        first = last


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the undirected `edges` (a, b); component is the smallest node reachable.

    Alternating large-star and small-star steps, all of them DataFrame joins and partial aggregates, each cut by a
    reliable checkpoint. The minima are checkpointed before they are joined, so that both sides of each join come
    straight from an exchange and AQE can split a hub's partition. No edges: no rows. Null ends and loops are dropped.
    """
    e = cut(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    for _ in range(rounds):
        if _settled(e):
            break
        both = e.union(e.select("v", "u"))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.union(least).distinct())
    else:
        raise RuntimeError("connected components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())


def _settled(e: DataFrame) -> bool:
    """Whether every upper end has one lower end and no lower end is an upper end too, so that each component is a star."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)").isEmpty()
