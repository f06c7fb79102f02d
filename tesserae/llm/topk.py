"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into ``m`` segments; the index has a row for each segment of each distinct code. Segments are searched at
radius 0, 1, 2, ...: once all are done up to ``r - 1`` and the first ``a`` also at ``r``, every code at Hamming distance
``m * r + a - 1`` or less has been found (a farther one needs more than that many differing bits). A query whose kth verified
distance is within that bound is finished; at each radius it probes no more segments than its kth distance so far asks for.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import durable, named

#: A segment's bits: the default, which is the least that ``segment_bits`` chooses, and the most.
BITS, BITS_MOST = 16, 20
#: Parts that a query's candidates are ranked in before they meet.
SLICES = 16


def segment_bits(codes: int) -> int:
    """The width at which a bucket of the index holds about one of ``codes`` codes, had they no pattern, from 16 bits on: below that, a narrower
    segment would save probes in small tables only to add them, faster than the rows, in larger ones."""
    return min(BITS_MOST, max(BITS, round(math.log2(max(2, codes)))))


def _finite(vector: Column) -> Column:
    """Not null or empty, and all components finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def sign_codes(vectors: DataFrame, id_col: str, vector_col: str, width: int = BITS) -> DataFrame:
    """(id, bits, code): a bit for each component, 1 if it is positive, in segments of ``width`` bits (the last may be shorter).
    Vectors that are null, empty or hold null or non-finite components have no code, nor have rows with a null id."""
    usable = vectors.select(named(id_col).cast("long").alias("id"), named(vector_col).alias("v")).filter(F.col("id").isNotNull() & _finite(F.col("v")))
    segments = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("v") - 1) / width).cast("int")),
        lambda s: F.aggregate(F.slice("v", s * width + 1, width), F.lit(0), lambda a, x: a * 2 + F.when(x > 0, 1).otherwise(0)),
    )
    return usable.select("id", F.size("v").alias("bits"), segments.alias("code"))


def _masks(width: int, radius: int) -> Column:
    """All ``radius``-bit masks of a segment, as one literal array."""
    found = (sum(1 << b for b in bits) for bits in combinations(range(width), radius))
    return F.split(F.lit(",".join(map(str, found))), ",").cast("array<int>")


def _nearest(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` least (distance, id) of each query, ranked: in slices of the ids first, so that no task sorts all candidates of a query."""
    order = ["distance", "id"]
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(SLICES)).cast("int"))
    first = sliced.withColumn("rank", F.row_number().over(W.partitionBy("query_id", "bits", "slice").orderBy(*order))).filter(F.col("rank") <= k)
    return first.drop("slice").withColumn("rank", F.row_number().over(W.partitionBy("query_id", "bits").orderBy(*order))).filter(F.col("rank") <= k)


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10, width: int = BITS) -> DataFrame:
    """(query_id, rank, id, distance): the ``k`` codes nearest to each query, ties to the smaller id, never the query's own id.

    Both inputs have ``id``, ``bits`` and ``code`` in segments of ``width`` bits; only codes of as many bits are compared. Equal codes
    share an index entry with their ``k + 1`` smallest ids (no more can be needed), so copies add no work. Rows that repeat an
    id and code count once; an id with several codes is several candidates. Fewer than ``k`` other ids: all of them. Either side empty: an empty result.

    A code is taken from the first segment that reaches it only, so nothing is found twice and no candidates are compared to be told apart.
    """
    spark = codes.sparkSession
    held = W.partitionBy("bits", "code").orderBy("id")
    entries = durable(
        codes.distinct().withColumn("n", F.row_number().over(held)).filter(F.col("n") <= k + 1)  # the limit is applied before the shuffle, too
        .groupBy("bits", "code").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    )
    index = durable(entries.select("bits", "code", "ids", F.posexplode("code").alias("segment", "value")))
    counts = F.broadcast(codes.distinct().groupBy("bits").agg(F.count("*").alias("among")))  # a row for each code length
    waiting = durable(
        queries.distinct().join(counts, "bits")
        .select(F.col("id").alias("query_id"), "bits", F.col("code").alias("wanted"), "among", F.lit(0).cast("long").alias("got"), F.lit(None).cast("int").alias("kth"))
    )
    best = done = spark.createDataFrame([], "query_id long, bits int, id long, distance int")
    full_length, parts = F.least(F.lit(width), F.col("bits") - F.col("segment") * width), F.size("wanted")
    for radius in range(width + 1):
        known = F.col("got") >= k
        probes = (
            waiting.withColumn("probed", F.when(known, F.least(parts, F.col("kth") - parts * radius + 1)).otherwise(parts))
            .select("query_id", "bits", "wanted", "probed", F.when(known, F.col("kth")).otherwise(F.col("bits")).alias("most"), F.posexplode("wanted").alias("segment", "own"))
            .filter("segment < probed")
            .withColumn("mask", F.explode(_masks(width, radius)))
            .filter(F.col("mask") < F.pow(F.lit(2), full_length))
        )
        apart = F.zip_with("wanted", "code", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        found = (
            probes.select("query_id", "bits", "wanted", "most", "segment", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
            .join(index, ["bits", "segment", "value"])
            .select("query_id", "bits", "ids", "segment", "most", apart.alias("apart"))
            .filter((F.array_min("apart") == radius) & (F.array_position("apart", F.lit(radius)) == F.col("segment") + 1))
            .withColumn("distance", F.aggregate("apart", F.lit(0), lambda t, x: t + x))
            .filter("distance <= most")
            .select("query_id", "bits", F.explode("ids").alias("id"), "distance")
            .filter("id <> query_id")
        )
        best = durable(_nearest(best.unionByName(found), k))
        sums = best.groupBy("query_id", "bits").agg(F.max("distance").alias("kth"), F.count("*").alias("got"))
        covered = F.col("parts") * radius + F.col("probed") - 1
        probed = F.when(known, F.least(parts, F.col("kth") - parts * radius + 1)).otherwise(parts)
        judged = waiting.select("query_id", "bits", "wanted", "among", parts.alias("parts"), probed.alias("probed")).join(sums, ["query_id", "bits"], "left")
        full = F.coalesce(F.col("got"), F.lit(0)) >= F.col("among") - 1
        full = full | F.coalesce((F.col("got") >= k) & (F.col("kth") <= covered), F.lit(False)) | (covered >= F.col("bits"))
        judged = durable(judged.withColumn("full", full))
        done = done.unionByName(best.join(judged.filter("full").select("query_id", "bits"), ["query_id", "bits"], "left_semi").drop("rank"))
        waiting = judged.filter(~F.col("full")).select("query_id", "bits", "wanted", "among", F.coalesce("got", F.lit(0)).alias("got"), "kth")
        if waiting.isEmpty():
            break
        best = best.join(waiting.select("query_id", "bits"), ["query_id", "bits"], "left_semi").drop("rank")
    ranked = F.row_number().over(W.partitionBy("query_id", "bits").orderBy("distance", "id"))
    return done.select("query_id", ranked.alias("rank"), "id", "distance")


def op4_topk(spark, sf_dir):
    """Queries: the rows of ``embeddings`` whose id is divisible by 100; candidates: every other row."""
    from ._common import table

    vectors = table(spark, sf_dir, "embeddings")
    width = segment_bits(vectors.count())
    codes = durable(sign_codes(vectors, "vec_id", "embedding", width))
    return top_k(codes, codes.filter("id % 100 = 0"), width=width).withColumnRenamed("id", "vec_id")


SQL = {
    "op4_topk": """
        WITH v AS (SELECT vec_id, [CASE WHEN x > 0 THEN 1 ELSE 0 END FOR x IN embedding] AS code FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
        p AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum([CASE WHEN q.code[i] <> c.code[i] THEN 1 ELSE 0 END FOR i IN range(1, len(q.code) + 1)]) AS INTEGER) AS distance
            FROM v q, v c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, distance
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS n FROM p) WHERE n <= 10
    """,
}
