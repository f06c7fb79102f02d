"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import durable, forget, shared_folder  # noqa: F401 (forget and shared_folder are for the operators)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read by Spark alone so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder through the file system that Spark itself uses for it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rest(df: DataFrame, *used: str) -> list[str]:
    """Columns that an operator only carries along: those whose names differ from ``used`` by more than case, as Spark sees names."""
    return [c for c in df.columns if c.lower() not in {u.lower() for u in used}]


def named(column: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(f"`{column.replace('`', '``')}`")


def text_hashes(text: Column) -> tuple[Column, Column]:
    """Two chained 64-bit hashes of a text (null and empty alike): 128 bits name it for exact-copy matching."""
    whole = F.coalesce(text, F.lit(""))
    return F.xxhash64(whole), F.xxhash64(F.lit("second"), whole)


class Memo(dict):
    """A memo of a pure function with a bound: it holds two generations of ``entries`` keys at most. When the young one is
    full it becomes the old one, from which keys that are asked for again move up."""

    def __init__(self, function, entries: int = 200_000, longest: int = 64):
        super().__init__()
        self.function, self.entries, self.longest, self.old = function, entries, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def as_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null is empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces_of(finder, text: str, bulk: int = 1 << 20) -> Iterable[str]:
    """All matches of a compiled pattern; long texts are walked, not held as one list."""
    if len(text) <= bulk:
        return finder.findall(text)
    return (m.group() for m in finder.finditer(text))


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where the left side may hold a hot key and the right side has one row for each key.

    The derived key makes both sides be shuffled for this join even where the right side is already clustered by the
    keys: only then can adaptive execution split the hot partitions of the left side.
    """
    mixed = "mixed key"
    return (
        left.withColumn(mixed, F.xxhash64(*[named(k) for k in keys]))
        .join(right.withColumn(mixed, F.xxhash64(*[named(k) for k in keys])).hint("merge"), [*keys, mixed], how)
        .drop(mixed)
    )


def components(links: DataFrame) -> DataFrame:
    """Connected components of the links ``(a long, b long)``: ``(node, root)``, root the least node reachable.

    Alternates the large-star and the small-star step (Kiveris and others, 2014) until the links stand still. The least
    neighbour of a node is aggregated before any shuffle and joined back by a join that can split hubs, so
    a component of any size is never gathered. Nothing goes to the driver but a count and a hash sum a round.
    """
    pairs = durable(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = state(pairs)
    if not before[0]:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:  # the steps are known to settle, in about the square of the logarithm of the links
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = skew_join(both, least, ["a"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = skew_join(large, least, ["a"]).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.withColumnRenamed("m", "b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        older, pairs = pairs, durable(small.filter("a <> b").distinct())
        now = state(pairs)
        forget(older)
        if now == before:
            break
        before = now
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))


def sliced(batches, rows: int = 500):
    """Arrow batches cut into smaller ones, to hold less at a time."""
    for batch in batches:
        for i in range(0, len(batch), rows):
            yield batch.slice(i, rows)


def spread(df: DataFrame) -> DataFrame:
    """For costly row-wise work: deal rows out evenly where the input has fewer splits than the cluster has cores. Large inputs,
    and inputs that have been shuffled already, stay as they are."""
    if re.search(r"(?m)^[ :+*()\d-]*Exchange\b", df._jdf.queryExecution().executedPlan().toString()):  # a node's name begins its line
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df
