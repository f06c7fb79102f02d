"""Approximate nearest neighbours by vantage-point trees, one for each shard.

A vantage-point tree splits unit vectors (on which Euclidean distance orders as cosine does) by their distance to a vantage
point. Its top, fitted on a bounded sample, deals vectors to shards by proximity; each shard builds a tree over its own. A query is
first searched in the shard that it falls into, which gives a distance ``t`` of its kth best; by the triangle inequality
a side, and so a whole shard, may be skipped where the query's distance to the split exceeds ``t``. ``relax`` tightens that to
``relax * t``: 1 never skips a neighbour, less is faster and may.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import durable, named
from .topk import _finite

#: Vectors that the top of the tree is fitted on, at most, and the fewest of them in a cell.
SAMPLE, SAMPLE_CELL = 32_768, 16
#: Vectors of a shard and queries that share one copy of it, about; vectors of a leaf.
SHARD, BLOCK, LEAF = 8_192, 16_384, 64
#: Squared distances of near-equal unit vectors are uncertain by rounding.
SLACK = 1e-7
KEYS = ["bits", "cell", "part", "block"]


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.sqrt((matrix * matrix).sum(axis=1))[:, None]


def apart(unit: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (unit @ point)))


class Router:
    """The top of a vantage-point tree: the cell of a vector, and the least distance at which a query may meet each cell."""

    def __init__(self, unit: np.ndarray, cells: int):
        self.nodes: list = []  # (vantage, cut, inner node, outer node) or a cell's number
        self.cells = 0
        rng = np.random.default_rng(0)
        depth = max(0, int(np.ceil(np.log2(max(1, cells)))))
        self._grow(unit, depth, rng)

    def _grow(self, unit: np.ndarray, depth: int, rng) -> int:
        mine = len(self.nodes)
        self.nodes.append(self.cells)
        if depth and len(unit) >= 2 * SAMPLE_CELL:
            vantage = unit[rng.integers(len(unit))]
            d = apart(unit, vantage)
            cut = float(np.median(d))
            if (d > cut).any():
                inner = self._grow(unit[d <= cut], depth - 1, rng)
                outer = self._grow(unit[d > cut], depth - 1, rng)
                self.nodes[mine] = (vantage, cut, inner, outer)
                return mine
        self.nodes[mine] = self.cells
        self.cells += 1
        return mine

    def cell_of(self, unit: np.ndarray) -> np.ndarray:
        out = np.zeros(len(unit), np.int32)
        todo = [(0, np.arange(len(unit)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if isinstance(self.nodes[node], int):
                out[at] = self.nodes[node]
                continue
            vantage, cut, inner, outer = self.nodes[node]
            near = apart(unit[at], vantage) <= cut
            todo += [(inner, at[near]), (outer, at[~near])]
        return out

    def bounds(self, unit: np.ndarray) -> np.ndarray:
        """(queries, cells): by the triangle inequality, no vector of the cell is nearer."""
        out = np.zeros((len(unit), self.cells))
        todo = [(0, np.zeros(len(unit)))]
        while todo:
            node, bound = todo.pop()
            if isinstance(self.nodes[node], int):
                out[:, self.nodes[node]] = bound
                continue
            vantage, cut, inner, outer = self.nodes[node]
            d = apart(unit, vantage)
            todo += [(inner, np.maximum(bound, d - cut)), (outer, np.maximum(bound, cut - d))]
        return out


class VPTree:
    """Vantage-point tree over distinct rows of a matrix of unit vectors."""

    def __init__(self, unit: np.ndarray, leaf: int = LEAF):
        self.unit, self.leaf = unit, leaf
        self.nodes: list = []
        rng = np.random.default_rng(0)
        todo = [(np.arange(len(unit)), None)]
        while todo:
            at, parent = todo.pop()
            if parent is not None:
                self.nodes[parent[0]][parent[1]] = len(self.nodes)
            if len(at) <= leaf:
                self.nodes.append([None, None, at, unit[at]])
                continue
            vantage = self.unit[at[rng.integers(len(at))]]
            d = apart(unit[at], vantage)
            order = np.argsort(d, kind="stable")
            half = len(at) // 2
            inner, outer = at[order[:half]], at[order[half:]]
            # the split lies between the farthest inner and the nearest outer vector
            mine = len(self.nodes)
            self.nodes.append([0, 0, (vantage, float(d[order[half - 1]]), float(d[order[half]])), None])
            todo += [(outer, (mine, 1)), (inner, (mine, 0))]

    def search(self, query: np.ndarray, k: int, relax: float, weight: np.ndarray, within: float = np.inf) -> np.ndarray:
        """The nearest rows that together hold ``k`` vectors or more (``weight`` of each row), ties included, at distance ``within`` or less."""
        rows: list[np.ndarray] = []
        dists: list[np.ndarray] = []
        best, kth = np.zeros(0), within
        todo = [(0.0, 0)] if self.nodes else []
        while todo:
            bound, node = todo.pop()
            if bound > relax * kth + SLACK:
                continue
            a, b, what, vectors = self.nodes[node]
            if vectors is not None:
                d = apart(vectors, query)
                near = d <= kth + SLACK
                if near.any():
                    rows.append(what[near])
                    dists.append(d[near])
                    best = np.sort(np.concatenate([best, np.repeat(d[near], weight[what[near]])]))[:k]
                    if len(best) == k:
                        kth = min(kth, best[-1])
                continue
            vantage, inside, outside = what
            d = float(np.sqrt(max(0.0, 2 - 2 * float(vantage @ query))))
            low, high = max(bound, d - inside), max(bound, outside - d)
            todo += [(high, b), (low, a)] if low <= high else [(low, a), (high, b)]
        if not rows:
            return np.zeros(0, np.int64)
        row, dist = np.concatenate(rows), np.concatenate(dists)
        return row[dist <= kth + SLACK]


def cosine(matrix: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine in double precision; a row's value does not depend on its place in the matrix."""
    dots = (matrix * query).sum(axis=1)
    return dots / (np.sqrt((matrix * matrix).sum(axis=1)) * np.sqrt((query * query).sum()))


def matrix_of(column) -> np.ndarray:
    """A matrix in double precision of an Arrow column of lists of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


class Shard:
    """The distinct vectors of a shard, each with the ids that have it, under a tree that is built once."""

    def __init__(self, batches: list):
        table = pa.Table.from_batches(batches)
        self.vectors = matrix_of(table.column("v"))
        ids = table.column("ids").combine_chunks()
        self.ids = ids.flatten().to_numpy(zero_copy_only=False)
        self.weight = np.diff(ids.offsets.to_numpy())
        self.first = np.cumsum(self.weight) - self.weight
        #: how many ids of each vector are no other vector's: only those count towards k while the tree is searched
        _, place, times = np.unique(self.ids, return_inverse=True, return_counts=True)
        self.alone = np.add.reduceat((times[place] == 1).astype(np.int64), self.first)
        self.tree = VPTree(unit_rows(self.vectors))

    def search(self, query_ids, queries, within, k: int, relax: float) -> pa.RecordBatch:
        """The ids of each query's ``k`` nearest in this shard, found by the tree and scored exactly; an id counts by its nearest vector."""
        out = [], [], []
        for qid, q, unit, t in zip(query_ids, queries, unit_rows(queries), within, strict=True):
            rows = self.tree.search(unit, k + 1, relax, self.alone, t)  # one more, for the query's own row
            if not len(rows):
                continue
            score = np.repeat(cosine(self.vectors[rows], q), self.weight[rows])
            found = np.concatenate([self.ids[self.first[r] : self.first[r] + self.weight[r]] for r in rows])
            other = found != qid
            score, found = score[other], found[other]
            order = np.lexsort((found, -score))
            best = order[np.sort(np.unique(found[order], return_index=True)[1])[:k]]
            for column, x in zip(out, (np.full(len(best), qid), found[best], score[best]), strict=True):
                column.append(x)
        kinds = np.int64, np.int64, np.float64
        columns = [pa.array(np.concatenate(x).astype(kind) if x else np.zeros(0, kind)) for x, kind in zip(out, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])


def search_shards(vectors: DataFrame, asked: DataFrame, k: int, relax: float) -> DataFrame:
    """(query_id, vec_id, score): candidates from the shards that each query is sent to.

    A shard and its queries come to one task as a stream, the shard's vectors first: the tree is built once, queries pass by it.
    """
    rows = vectors.select(*KEYS, F.lit(0).alias("kind"), F.lit(None).cast("long").alias("id"), "v", "ids", F.lit(None).cast("double").alias("t"))
    rows = rows.unionByName(asked.select(*KEYS, F.lit(1).alias("kind"), "id", "v", F.lit(None).cast("array<bigint>").alias("ids"), "t"))

    def run(batches):
        here, held, shard = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in [*KEYS, "kind"]], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                key, part = tuple(keys[a, :-1].tolist()), batch.slice(a, b - a)
                if key != here:
                    here, held, shard = key, [], None
                if keys[a, -1] == 0:
                    held.append(part)
                    continue
                if held:
                    shard, held = Shard(held), []
                if shard is not None:
                    yield shard.search(part.column("id").to_numpy(), matrix_of(part.column("v")), part.column("t").to_numpy(zero_copy_only=False), k, relax)

    return rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "kind").mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, relax: float = 0.6, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest vectors found for each query, nearest first, by cosine.

    Both inputs have ``id_col`` and ``vector_col``. Ties go to the smaller id; a query's own id is no candidate; fewer
    candidates: all that are found. Vectors null, empty, zero or holding null or non-finite components take no part, nor do
    rows with a null id; only vectors of as many components are compared. Repeated rows count once. An id with several vectors, on either side, is as near as the nearest of
    them, and has one rank. Either side empty: an empty result.

    Equal vectors share an entry with their ``k + 1`` smallest ids. A cell over the size of a shard, which the sample could not part,
    is dealt to several by a hash. The vectors' shuffles are four, whatever the number of queries: for repeated rows, for equal
    vectors, and one for each of the two searches; beyond that a shard is copied once for every ``block`` queries that visit it.
    """

    def usable(df):
        kind = dict(df.dtypes)[vector_col]
        v = named(vector_col) if kind in ("array<float>", "array<double>") else named(vector_col).cast("array<double>")
        chosen = df.select(named(id_col).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & _finite(F.col("v")))
        return chosen.filter(F.exists("v", lambda x: x != 0)).withColumn("bits", F.size("v")).distinct()

    least = W.partitionBy("bits", "v").orderBy("id")
    entries = usable(vectors).withColumn("n", F.row_number().over(least)).filter(F.col("n") <= k + 1)  # limited before the shuffle, too
    entries = durable(entries.groupBy("bits", "v").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    asked = usable(queries)

    sample = entries.select("bits", "v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toArrow()
    lengths = sample.column("bits").to_numpy()
    sizes = {r.bits: r.n for r in entries.groupBy("bits").agg(F.count("*").alias("n")).filter(F.col("bits").isin(np.unique(lengths).tolist())).collect()}
    routers = {n: Router(unit_rows(matrix_of(sample.column("v").take(pa.array(np.flatnonzero(lengths == n))))), -(-size // shard)) for n, size in sizes.items()}

    def route(df):
        """``df`` with the cell that each vector falls into; vectors of a length that the sample lacks are in one."""

        def run(batches):
            for batch in batches:
                bits = batch.column("bits").to_numpy()
                cell = np.zeros(len(batch), np.int32)
                for n in np.unique(bits).tolist():
                    if n in routers:
                        at = np.flatnonzero(bits == n)
                        cell[at] = routers[n].cell_of(unit_rows(matrix_of(batch.column("v").take(pa.array(at)))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        return df.mapInArrow(run, f"{fields}, cell int")

    dealt = durable(route(entries))
    # a row for each cell: their number is bounded by the sample
    parts = dealt.groupBy("bits", "cell").agg(F.count("*").alias("n")).select("bits", "cell", F.ceil(F.col("n") / shard).cast("int").alias("parts"))
    parts = F.broadcast(durable(parts))
    dealt = dealt.join(parts, ["bits", "cell"]).withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")).drop("parts")

    def visit(wanted):
        """Candidates from the cells that ``wanted`` (bits, cell, id, v, t) names; a cell with many queries is copied for each block of them."""
        blocks = wanted.groupBy("bits", "cell").agg(F.count("*").alias("n")).select("bits", "cell", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
        blocks = F.broadcast(blocks)  # a row for each cell
        to_all = wanted.join(parts, ["bits", "cell"]).join(blocks, ["bits", "cell"])
        to_all = to_all.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        copied = dealt.join(blocks, ["bits", "cell"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return search_shards(copied, to_all, k, relax)

    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    home = durable(route(asked).withColumn("t", F.lit(float("inf"))))
    once = lambda df: df.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    at_home = once(visit(home)).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank")
    at_home = durable(at_home)
    kth = at_home.groupBy("query_id").agg(F.min("score").alias("kth"), F.count("*").alias("got")).filter(F.col("got") >= k).select(F.col("query_id").alias("id"), "kth")
    known = home.drop("t").join(kth, "id", "left").select("bits", "cell", "id", "v", F.coalesce(F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("kth"))), F.lit(float("inf"))).alias("t"))

    def other_cells(batches):
        for batch in batches:
            for i in range(0, len(batch), 256):
                some = batch.slice(i, 256)
                bits, cell, t = (some.column(c).to_numpy() for c in ("bits", "cell", "t"))
                for n in np.unique(bits).tolist():
                    if n not in routers:
                        continue
                    at = np.flatnonzero(bits == n)
                    own = some.take(pa.array(at))
                    bound = routers[n].bounds(unit_rows(matrix_of(own.column("v"))))
                    row, to = np.nonzero(bound <= relax * t[at][:, None] + SLACK)
                    away = to != cell[at][row]
                    out = own.take(pa.array(row[away]))
                    yield pa.RecordBatch.from_arrays([out.column("bits"), pa.array(to[away].astype(np.int32)), out.column("id"), out.column("v"), out.column("t")], names=["bits", "cell", "id", "v", "t"])

    kind = dict(home.dtypes)["v"]
    away = durable(known.mapInArrow(other_cells, f"bits int, cell int, id long, v {kind}, t double"))
    found = once(at_home.unionByName(visit(away)))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_vp_search(spark, sf_dir):
    from ._common import table

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter("vec_id % 50 = 0"))
