"""Trie of conversation prefixes, as preorder intervals.

A prefix is named by its length and two sums of 64-bit digests of its turns, each mixed with its place, so all prefixes of all conversations come from
one distributed running sum. Distinct prefixes are the nodes. A node whose parent has several children begins a chain, which goes on to the next
branching; chains are ranked by the branchings on their way from the root, lexicographically by prefix digests, and nodes by chain and depth: the preorder.
A subtree is an interval of it, so its leaves and savings are differences of running sums at its ends.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import durable, named, skew_join
from .scans import Scan

NODE = ["depth", "a", "b"]


def turns_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, place, a, b, chars): the turns of each conversation in order, from 1 on, with two digests of role and text, and the text's code points.

    Turns go by number, nulls first, then by role, then by text. A null role or text is empty; rows without a conversation's id take no part; repeated rows
    are repeated turns; an empty table gives no rows; other columns are ignored. Texts are shuffled once. A conversation of any length is spread over tasks;
    only turns that agree in number, role and the first 64 characters must lie in one task (sorted there, with spilling).
    """
    role, text = F.coalesce(named(role_col), F.lit("")), F.coalesce(named(text_col), F.lit(""))
    rows = conversations.select(named(conv_col).cast("long").alias("conv"), named(turn_col).alias("turn"), role.alias("role"), text.alias("text")).filter("conv IS NOT NULL")
    rows = rows.withColumns({"a": F.xxhash64("role", "text"), "b": F.xxhash64(F.lit("second"), "role", "text"), "chars": F.length("text").cast("long")})
    deal = [F.col("conv"), F.col("turn"), F.substring("role", 1, 64), F.substring("text", 1, 64)]
    scan = Scan(rows, ["conv", "turn", "role", "text"], group="conv", drop=("turn", "role", "text"), deal=deal)
    return scan.rows().withColumnRenamed("index", "place")


def _mixed(index: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Digests mixed with places, so that sums tell orders apart (the finaliser of splitmix64)."""
    x = digest + index * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, a, b, pa, pb, chars): the prefix that each turn ends, and the one before it, of turns (conv, place, a, b, chars). Places order the turns of
    a conversation; they may have gaps."""
    weigh = lambda index, column: [_mixed(index, column("digest_a")), _mixed(index + np.uint64(1 << 32), column("digest_b"))]
    rows = turns.withColumnsRenamed({"a": "digest_a", "b": "digest_b"})
    scan = Scan(rows, ["conv", "place"], group="conv", weigh=weigh, sums=("a", "b"))

    def before(batches):
        for batch in batches:
            less = [pa.array(batch.column(s).to_numpy() - batch.column(w).to_numpy()) for s, w in (("a", "wa"), ("b", "wb"))]
            names = ["conv", "index", "a", "b", "chars"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names[:4]], *less, batch.column("chars")], names=["conv", "depth", "a", "b", "pa", "pb", "chars"])

    return scan.rows("wa", "wb").mapInArrow(before, "conv long, depth long, a long, b long, pa long, pb long, chars long")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the trie of the conversations ``convs`` (conv, distinct) with the turns (conv, place, a, b, chars).

    Nodes: depth, a, b (together its name), conv (smallest member), parent_conv (null for the root), n_convs, n_children, n_leaves, saved (over the subtree,
    members but one times the code points of the last turn), position and subtree_end (the node's preorder interval, from 1). Ends: (conv, depth, a, b), the node
    at which each conversation ends; one without turns ends at the root. No conversations: no nodes. Names are equal for equal prefixes, and for
    others with a chance of 2**-128.

    A conversation or node with any share of the rows is split by adaptive joins or aggregated before it is shuffled. What one row holds is the branchings
    on the way to a node, at most about the square root of twice the number of turns.
    """
    steps = prefixes(turns)
    blank = {c: F.lit(0).cast("long") for c in (*NODE, "pa", "pb", "chars")}
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")).filter("n_convs > 0").withColumns(blank)
    found = steps.groupBy(*NODE).agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), *[F.min(c).alias(c) for c in ("pa", "pb", "chars")])
    nodes = durable(found.unionByName(root))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = durable(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))

    # each node meets its parent: whose smallest member, and whether the node begins a chain
    up = nodes.filter("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv").alias("parent_conv"), (F.col("n_children") > 1).alias("begins"))
    nodes = durable(skew_join(nodes, up, ["depth", "pa", "pb"], "left").withColumn("begins", F.coalesce("begins", F.lit(False))).drop("pa", "pb"))

    # the branchings on the way of each conversation, then of each node (in its smallest member)
    begun = skew_join(steps.select("conv", *NODE), nodes.filter("begins").select(*NODE), NODE)
    ways = begun.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(*NODE))).alias("way"))
    way = F.filter(F.coalesce("way", F.array().cast("array<struct<depth:bigint,a:bigint,b:bigint>>")), lambda s: s["depth"] <= F.col("depth"))
    last = F.coalesce(F.try_element_at("on_way", F.lit(-1)), F.struct(*[F.lit(0).cast("long").alias(c) for c in NODE]))
    path = F.when(F.col("begins") | (F.col("depth") == 0), F.transform("on_way", lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"), s["depth"].alias("depth"))))
    nodes = durable(skew_join(nodes, ways, ["conv"], "left").withColumn("on_way", way).withColumns({"chain": last, "path": path}).drop("way", "on_way"))

    # chains in lexicographic order, and the last one below each
    ranked = durable(Scan(nodes.filter("path IS NOT NULL").select("chain", "path"), ["path"]).rows().withColumnRenamed("index", "rank"))
    below = ranked.select("rank", F.explode("path").alias("s")).groupBy("s").agg(F.max("rank").alias("last")).select(F.struct(*[F.col(f"s.{c}").alias(c) for c in NODE]).alias("chain"), "last")
    below = below.unionByName(ranked.agg(F.max("rank").alias("last")).filter("last IS NOT NULL").select(F.struct(*[F.lit(0).cast("long").alias(c) for c in NODE]).alias("chain"), "last"))
    ranked = ranked.select("chain", "rank").join(below, "chain")

    # the preorder, with running sums of leaves and savings; a subtree ends where the last chain below its own ends
    nodes = skew_join(nodes.drop("path", "begins"), ranked, ["chain"]).drop("chain").withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saving": (F.col("n_convs") - 1) * F.col("chars")})
    order = Scan(nodes, ["rank", "depth"], weigh=lambda index, column: [column("leaf"), column("saving")], sums=("leaves", "savings")).rows()
    ends = order.groupBy(F.col("rank").alias("last")).agg(F.max("index").alias("subtree_end"), F.max("leaves").alias("leaves_end"), F.max("savings").alias("savings_end"))
    placed = skew_join(order, ends, ["last"])
    out = placed.select(
        *NODE, "conv", "parent_conv", "n_convs", "n_children", (F.col("leaves_end") - F.col("leaves") + F.col("leaf")).alias("n_leaves"),
        (F.col("savings_end") - F.col("savings") + F.col("saving")).alias("saved"), F.col("index").alias("position"), "subtree_end",
    )
    longest = steps.groupBy("conv").agg(F.max(F.struct(*NODE)).alias("end"))
    end = [F.coalesce(F.col(f"end.{c}"), F.lit(0).cast("long")).alias(c) for c in NODE]
    return out, convs.join(longest, "conv", "left").select("conv", *end)


def digest_of_ends(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): SHA-256 of the ids of the conversations that end at each node, in decimal, ascending, joined by commas.

    Ids meet in blocks of 65,536 consecutive numbers; a node's blocks then pass one after the other through the digest, which has no parallel form. Only one
    block is held at a time.
    """
    blocks = ends.groupBy(*NODE, F.shiftright("conv", 16).alias("block")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches):
        node, digest = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")], strict=True):
                if key == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            yield pack(done)
        if node:
            yield pack([(*node, digest.hexdigest())])

    def pack(rows):
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[*NODE, "ends_sha256"])

    return blocks.repartition(*NODE).sortWithinPartitions(*NODE, "block").mapInArrow(run, "depth long, a long, b long, ends_sha256 string")


def open_alike(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt to share openings, and their ids: conversation c takes the first h turns of c - c % ``every`` (those that there are), then its own turns after
    its first h; h is the unsigned crc32 of c in decimal, modulo ``most``. Places keep the order and may have gaps."""
    convs = durable(turns.select("conv").distinct())
    taken = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("long")
    own = turns.filter(F.col("place") > taken)
    openings = turns.filter((F.col("conv") % every == 0) & (F.col("place") < most)).withColumnRenamed("conv", "base")
    wanted = convs.select("conv", (F.col("conv") - F.col("conv") % every).alias("base"), taken.alias("taken")).filter("taken > 0")
    shared = wanted.join(openings, "base").filter("place <= taken").select(*turns.columns)
    return own.unionByName(shared), convs


def op11_prefix_trie(spark, sf_dir):
    from ._common import table

    turns, convs = open_alike(turns_of(table(spark, sf_dir, "conversations")))
    nodes, ends = prefix_trie(turns, convs)
    out = nodes.join(digest_of_ends(ends), NODE, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


SQL = {
    "op11_prefix_trie": """
        WITH RECURSIVE t AS (
            SELECT conv_id AS c, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS turn,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
            FROM conversations WHERE conv_id IS NOT NULL),
        -- crc32 of the id, a bit a step: before every eighth step the next character comes in
        bits AS (
            SELECT c, CAST(c AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS UBIGINT) AS v FROM (SELECT DISTINCT c FROM t)
            UNION ALL
            SELECT c, s, i + 1, xor(w >> 1, CASE WHEN w % 2 = 1 THEN CAST(3988292384 AS UBIGINT) ELSE CAST(0 AS UBIGINT) END)
            FROM (SELECT c, s, i, CASE WHEN i % 8 = 0 THEN xor(v, CAST(ascii(s[i // 8 + 1]) AS UBIGINT)) ELSE v END AS w FROM bits WHERE i < 8 * length(s))),
        convs AS (SELECT c, c - c % 100 AS base, xor(v, CAST(4294967295 AS UBIGINT)) % 6 AS h FROM bits WHERE i = 8 * length(s)),
        rebuilt AS (
            SELECT convs.c, 1 AS own, p, turn FROM t JOIN convs ON t.c = convs.c WHERE p > h
            UNION ALL SELECT convs.c, 0, p, turn FROM t JOIN convs ON t.c = base WHERE p <= h),
        whole AS (SELECT convs.c, coalesce(l, []) AS l FROM convs LEFT JOIN (SELECT c, list(turn ORDER BY own, p) AS l FROM rebuilt GROUP BY c) r ON convs.c = r.c),
        member AS (SELECT c, unnest(range(len(l) + 1)) AS depth, l FROM whole),
        nodes AS (
            SELECT list_slice(l, 1, depth) AS prefix, depth, min(c) AS conv_id, count(*) AS n_convs, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(l) = depth) AS ends
            FROM member GROUP BY ALL),
        children AS (SELECT list_slice(prefix, 1, depth - 1) AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
        full_ AS (
            SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * length(n.prefix[depth].text) ELSE 0 END AS saving
            FROM nodes n LEFT JOIN children k ON n.prefix = k.prefix),
        up AS (SELECT list_slice(prefix, 1, k) AS prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saving) AS BIGINT) AS saved_tokens
               FROM (SELECT *, unnest(range(depth + 1)) AS k FROM full_) GROUP BY 1)
        SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, up.n_leaves, up.saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
        FROM full_ f JOIN up ON f.prefix = up.prefix LEFT JOIN nodes p ON f.depth > 0 AND p.prefix = list_slice(f.prefix, 1, f.depth - 1)
    """,
}
