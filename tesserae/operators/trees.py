"""Releases as hash trees: what is equal is never read again. References of many tables in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Children of a node.
FAN = 16


def write_tree(df: DataFrame, folder: str, key: list[str], depth: int = 3, ignored: tuple[str, ...] = ("created_at", "updated_at")) -> None:
    """A release's table in ``folder``/rows, one partition for each of 16 ** ``depth`` ranges of the key's hash, and its tree in ``folder``/tree: (level, node, n, a, b), for each
    node the number of its rows and two sums of their hashes. ``ignored`` columns (clocks) are kept, but not hashed. Rows that repeat are counted. The two files of a range
    in two releases hold the same keys, whatever else changed."""
    columns = [c for c in df.columns if c not in ignored]
    leaf = F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in key]), 64 - 4 * depth).cast("int")
    # a NULL and its neighbours are told apart by a mark for each column
    cells = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    rows = df.withColumns({"leaf": leaf, "hash a": F.xxhash64(*cells), "hash b": F.xxhash64(F.lit("second"), *cells)})
    rows.repartition("leaf").sortWithinPartitions("leaf", *key).write.partitionBy("leaf").parquet(f"{folder}/rows")
    sums = [F.sum(F.col(f"hash {c}").cast("decimal(38,0)")).alias(c) for c in "ab"]
    leaves = df.sparkSession.read.parquet(f"{folder}/rows").groupBy("leaf").agg(F.count("*").alias("n"), *sums)
    levels = F.explode(F.sequence(F.lit(0), F.lit(depth)))
    nodes = leaves.withColumn("level", levels).withColumn("node", (F.col("leaf") / F.pow(F.lit(FAN), F.lit(depth) - F.col("level"))).cast("int"))
    nodes.groupBy("level", "node").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b")]).coalesce(1).write.parquet(f"{folder}/tree")


def differing_leaves(spark: SparkSession, now: str, before: str) -> list[int]:
    """Ranges in which two releases differ, found from the top: only children of nodes that differ are compared. The trees alone are read; at most 16 ** depth numbers come
    to the driver."""
    trees = [spark.read.parquet(f"{folder}/tree") for folder in (now, before)]
    depth = trees[0].agg(F.max("level")).first()[0]
    if depth is None:  # no rows: all that the other one has
        depth = trees[1].agg(F.max("level")).first()[0]
    if depth is None:
        return []
    open_ = None
    for level in range(depth + 1):
        mine, theirs = (t.filter(F.col("level") == level).select("node", F.struct("n", "a", "b").alias(side)) for t, side in zip(trees, ("now", "was"), strict=True))
        both = mine.join(theirs, "node", "full_outer").filter(~F.col("now").eqNullSafe(F.col("was")))
        if open_ is not None:
            both = both.filter((F.col("node") / FAN).cast("int").isin(open_))
        open_ = sorted(r.node for r in both.select("node").collect())
        if not open_:
            return []
    return open_


def tree_diff(spark: SparkSession, now: str, before: str, ignored: tuple[str, ...] = ("created_at", "updated_at")) -> DataFrame:
    """Rows, with their numbers, that one of two releases written by ``write_tree`` has more often than the other (positive: now), as ``multiset_differences`` of the whole tables; only
    partitions of ranges that differ are read."""
    leaves = differing_leaves(spark, now, before)
    sides = [spark.read.parquet(f"{folder}/rows").filter(F.col("leaf").isin(leaves) if leaves else F.lit(False)) for folder in (now, before)]
    columns = [c for c in sides[0].columns if c not in (*ignored, "leaf", "hash a", "hash b")]
    tally = lambda df, sign: df.groupBy("hash a", "hash b", *columns).agg((F.lit(sign) * F.count("*")).alias("surplus"))
    both = tally(sides[0], 1).unionByName(tally(sides[1], -1))
    return both.groupBy(*columns).agg(F.sum("surplus").alias("surplus")).filter("surplus <> 0")


def check_references(tables: dict[str, DataFrame], references: list[tuple[str, str, str, str]]) -> DataFrame:
    """(reference, child_rows, lost_rows, lost_keys, least_lost) of each reference (child table, column, parent table, key): rows of the child, those whose key no row of the parent has, how many such
    keys there are, and the least of them, as text. NULL refers to nothing; references without rows are told too.

    All tables are read once, and all keys of all references meet in one exchange, after they were combined where they were read: a hot key is one row a task.
    """
    spark = next(iter(tables.values())).sparkSession
    name = lambda i: "{0}.{1} -> {2}.{3}".format(*references[i])
    tokens = None
    for t, df in tables.items():
        said = [F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("key"), F.lit(1).alias("child")) for i, (child, c, _, _) in enumerate(references) if child == t]
        said += [F.struct(F.lit(i).alias("i"), F.col(f"`{k}`").cast("string").alias("key"), F.lit(0).alias("child")) for i, (_, _, parent, k) in enumerate(references) if parent == t]
        if said:
            rows = df.select(F.explode(F.array(*said)).alias("s")).select("s.*").filter("key IS NOT NULL")
            tokens = rows if tokens is None else tokens.unionByName(rows)
    keys = tokens.groupBy("i", "key").agg(F.sum("child").alias("rows"), F.min("child").alias("child"))
    lost = F.col("child") == 1  # the parent does not have it
    found = keys.groupBy("i").agg(
        F.sum("rows").alias("child_rows"), F.coalesce(F.sum(F.when(lost, F.col("rows"))), F.lit(0)).alias("lost_rows"), F.count_if(lost).alias("lost_keys"), F.min(F.when(lost, F.col("key"))).alias("least_lost")
    )
    every = spark.createDataFrame([(i, name(i)) for i in range(len(references))], "i int, reference string")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return every.join(found, "i", "left").select("reference", zero("child_rows"), zero("lost_rows"), zero("lost_keys"), "least_lost")
