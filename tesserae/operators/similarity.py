"""Names that nearly agree: a join on edit distance that meets no pair without reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _grams(name: Column, q: int) -> Column:
    """array<struct<gram, pos>> of the name's overlapping grams, with ``q`` - 1 marks at either end."""
    pad = "\x02" * (q - 1)
    padded = F.concat(F.lit(pad), name, F.lit("\x03" * (q - 1)))
    return F.transform(F.sequence(F.lit(1), F.length(name) + q - 1), lambda i: F.struct(F.substring(padded, i, F.lit(q)).alias("gram"), i.alias("pos")))


def _fewer(name: Column, most: int) -> Column:
    """The name, and what is left of it without up to ``most`` characters."""
    without = lambda s, i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s)))
    one = lambda s: F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: without(s, i))).otherwise(F.array().cast("array<string>"))
    level = out = F.array(name)
    for _ in range(most):
        level = F.array_distinct(F.flatten(F.transform(level, one)))
        out = F.concat(out, level)
    return F.array_distinct(out)


def similar_names(left: DataFrame, right: DataFrame, most: int = 1, q: int = 2) -> DataFrame:
    """(block, name, other, distance): all pairs of distinct names of ``left`` and ``right`` (block, name) in one block whose edit distance is ``most`` or less. NULLs take no part.

    ``most`` edits spoil most * q grams of a name at most. So of its most * q + 1 rarest grams (rarest in the block, on both sides) one is left, and the rarest that is left stands among those of
    the other name too, at most ``most`` places further on or back. Names meet by such grams, if their lengths are near enough; only these pairs are measured. A name too short to
    have as many grams meets others, just as short or a little longer, by what is left without up to ``most`` characters.
    """
    names = left.select("block", "name").distinct().withColumn("side", F.lit(0)).unionByName(right.select("block", "name").distinct().withColumn("side", F.lit(1))).filter("block IS NOT NULL AND name IS NOT NULL")
    long = most * q - q + 2  # from this length on, there are most * q + 1 grams
    names = names.withColumn("length", F.length("name"))
    grams = names.filter(F.col("length") >= long).select("block", "name", "side", "length", F.explode(_grams(F.col("name"), q)).alias("g")).select("block", "name", "side", "length", "g.*")
    often = grams.groupBy("block", "gram").agg(F.count("*").alias("often"))
    ranked = grams.join(often, ["block", "gram"]).groupBy("block", "name", "side", "length").agg(F.sort_array(F.collect_list(F.struct("often", "gram", "pos"))).alias("all"))
    by_gram = ranked.select("block", "name", "side", "length", F.explode(F.slice("all", 1, most * q + 1)).alias("g")).select("block", "name", "side", "length", F.col("g.gram").alias("token"), F.col("g.pos").alias("pos"))
    short = names.filter(F.col("length") < long + most).select("block", "name", "side", "length", F.explode(_fewer(F.col("name"), most)).alias("token"), F.lit(0).alias("pos"))
    tokens = by_gram.withColumn("kind", F.lit("gram")).unionByName(short.withColumn("kind", F.lit("rest")))
    a = tokens.filter("side = 0").drop("side")
    b = tokens.filter("side = 1").select("block", "kind", "token", F.col("name").alias("other"), F.col("length").alias("other_length"), F.col("pos").alias("other_pos"))
    near = (F.abs(F.col("length") - F.col("other_length")) <= most) & (F.abs(F.col("pos") - F.col("other_pos")) <= most)
    pairs = a.join(b, ["block", "kind", "token"]).filter(near).select("block", "name", "other").distinct()
    return pairs.withColumn("distance", F.levenshtein("name", "other")).filter(F.col("distance") <= most)


def nearest_names(left: DataFrame, right: DataFrame, most: int = 1) -> DataFrame:
    """``similar_names`` with the least distance of each name; others at the same distance stay beside it."""
    pairs = similar_names(left, right, most)
    least = pairs.groupBy("block", "name").agg(F.min("distance").alias("distance"))
    return pairs.join(least, ["block", "name", "distance"])
