"""SimHash near-dedup with pivot distance tables.

Fingerprints at Hamming distance ``r`` or less are linked. By the triangle inequality, the distances of two linked
fingerprints to any reference fingerprint (pivot) differ by ``r`` at most. This is used twice:

* a tree of pivots deals fingerprints into cells: those with distance up to a cut go left, those with a distance over
  ``cut - r`` go right, so that each linked pair meets in a cell;
* in a cell, a table of distances to many pivots discards pairs by their maximum coordinate difference, and only the
  survivors are verified.

The tree's shape is fitted on a bounded sample; links do not depend on it. Cells over a size (dense clusters that pivots
cannot part) are handled exactly by another way: fingerprints that share a one-bit neighbour.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import as_bytes, components, durable, named, skew_join, sliced, spread

#: Fingerprints that the pivot tree's shape is fitted on, at most.
SAMPLE = 20_000
#: Fingerprints that a cell should hold, and may hold.
CELL, CELL_MOST = 1_500, 20_000
#: Reference fingerprints, and those whose distances a cell's table holds.
PIVOTS, COORDINATES = 64, 12


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of word shingles, repeats included; a bit is 1 if set in over half of the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) < shingle:
        parts = [whole]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        last = len(words) - shingle + 1
        parts = [whole[i:j] for i, j in zip((ends - sizes)[:last].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for i in range(0, len(parts), 1 << 16):
        chunk = np.frombuffer(b"".join([digest(p, seed) for p in parts[i : i + (1 << 16)]]), np.uint8).reshape(-1, 8)
        votes += np.unpackbits(chunk, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(parts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, seed: int) -> DataFrame:
    """(doc_id, fp): fp as a signed 64-bit integer."""

    def run(batches):
        for batch in sliced(batches):
            found = np.array([fingerprint(t, shingle, seed) for t in as_bytes(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return spread(docs).mapInArrow(run, "doc_id long, fp long")


def _apart(a, b):
    return np.bitwise_count(a ^ b)


class PivotTree:
    """Deals fingerprints into cells so that every pair at distance ``radius`` or less shares a cell."""

    def __init__(self, sample: np.ndarray, total: int, radius: int, pivots: np.ndarray):
        self.radius, self.pivots = radius, pivots
        self.nodes: list[tuple[int, int, int, int]] = []  # pivot, cut, left, right; pivot -1: a cell
        self.cells = 0
        table = _apart(sample[:, None], pivots[None, :])
        scale = total / max(1, len(sample))
        self.extra: list[tuple[int, int]] = []
        self._grow(table, np.arange(len(sample)), scale, 0)
        if scale > 1:  # cells that the sample is too small to part further: cut at the medians of other pivots
            expected, middle = 16 * scale, np.median(table, axis=0).astype(int)
            for p in range(len(pivots) - 1, -1, -1):
                if expected <= CELL or len(self.extra) >= 40:
                    break
                self.extra.append((p, int(middle[p])))
                expected *= 0.6

    def _grow(self, table, at, scale, depth) -> int:
        mine = len(self.nodes)
        self.nodes.append((-1, 0, self.cells, 0))
        if len(at) * scale > CELL and len(at) > 16 and depth < 40:
            found = table[at]
            cut = np.median(found, axis=0).astype(int)
            left = (found <= cut).sum(axis=0)
            right = (found.astype(int) > cut - self.radius).sum(axis=0)
            work = left.astype(float) ** 2 + right.astype(float) ** 2
            p = int(np.argmin(work))
            if work[p] < 0.9 * len(at) ** 2:
                d = table[at, p].astype(int)
                a = self._grow(table, at[d <= cut[p]], scale, depth + 1)
                b = self._grow(table, at[d > cut[p] - self.radius], scale, depth + 1)
                self.nodes[mine] = (p, int(cut[p]), a, b)
                return mine
        self.nodes[mine] = (-1, 0, self.cells, 0)
        self.cells += 1
        return mine

    def deal(self, fps: np.ndarray):
        """Pairs of arrays (cell, positions in ``fps``)."""
        todo = [(0, np.arange(len(fps)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            p, cut, left, right = self.nodes[node]
            if p < 0:
                yield from self._deal_on(left, at, fps)
                continue
            d = _apart(fps[at], self.pivots[p]).astype(np.int16)
            todo.append((left, at[d <= cut]))
            todo.append((right, at[d > cut - self.radius]))

    def _deal_on(self, cell, at, fps):
        found = [(cell, at)]
        for p, cut in self.extra:
            deeper = []
            for c, at in found:
                d = _apart(fps[at], self.pivots[p]).astype(np.int16)
                deeper += [(2 * c, at[d <= cut]), (2 * c + 1, at[d > cut - self.radius])]
            found = [x for x in deeper if len(x[1])]
        yield from found


def links_in_cell(fps: np.ndarray, pivots: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a cell at distance ``radius`` or less."""
    table = _apart(fps[:, None], pivots[None, :])
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], np.ascontiguousarray(table[order].T)
    first, out_a, out_b = table[0].astype(np.int64), [], []
    step = 64
    for s in range(0, len(fps), step):
        e = min(s + step, len(fps))
        hi = int(np.searchsorted(first, first[e - 1] + radius, "right"))
        near = np.ones((e - s, hi - s), bool)
        for k in range(len(pivots)):  # the differences are read modulo 256: -radius..radius becomes 0..2*radius
            near &= (table[k, None, s:hi] - table[k, s:e, None] + np.uint8(radius)) <= 2 * radius
            if k % 3 == 2 and not near.any():
                break
        a, b = np.nonzero(near)
        ahead = b > a
        a, b = fps[s + a[ahead]], fps[s + b[ahead]]
        close = _apart(a, b) <= radius
        out_a.append(a[close])
        out_b.append(b[close])
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (fps[:0], fps[:0])


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component in these pairs), without the roots themselves."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        now = root.copy()
        np.minimum.at(now, root[a], low)
        np.minimum.at(now, root[b], low)
        now = now[now]
        if (now == root).all():
            break
        root = now
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def link_fingerprints(fps: DataFrame, radius: int = 2, cell_most: int = CELL_MOST) -> DataFrame:
    """Links ``(a, b)`` that connect the same fingerprints as all pairs at distance ``radius`` or less do.

    ``fps`` holds each fingerprint once, as ``fp``. Cells return a spanning forest of their links.
    """
    total = fps.count()
    sample = np.array([r[0] for r in fps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64).view(np.uint64)
    pivots = np.random.default_rng(0).integers(0, 2**64, PIVOTS, np.uint64)
    pivots[: PIVOTS // 4] = np.resize(sample, PIVOTS // 4) if len(sample) else pivots[: PIVOTS // 4]
    tree = PivotTree(sample, total, radius, pivots)  # of a size that SAMPLE bounds: it travels with the functions

    def deal(batches):
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            for cell, at in tree.deal(own.view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), cell, np.int64)), pa.array(own[at])], names=["cell", "fp"])

    def together(batches):  # few, larger batches
        kept, n = [], 0
        for b in deal(batches):
            kept.append(b)
            n += len(b)
            if n >= 50_000:
                yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
                kept, n = [], 0
        if kept:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()

    def link(table):
        own = table.column("fp").to_numpy().view(np.uint64)
        a, b = links_in_cell(np.ascontiguousarray(own), tree.pivots[-COORDINATES:], tree.radius)
        a, b = spanning(a, b) if len(a) else (a, b)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    dealt = durable(fps.select("fp").mapInArrow(together, "cell long, fp long"))
    large = durable(dealt.groupBy("cell").count().filter(F.col("count") > cell_most).select("cell"))
    if large.isEmpty():
        return dealt.groupBy("cell").applyInArrow(link, "a long, b long")
    links = skew_join(dealt, large, ["cell"], "left_anti").groupBy("cell").applyInArrow(link, "a long, b long")
    if radius <= 2:
        return links.unionByName(links_by_flips(skew_join(dealt, large, ["cell"], "left_semi").select("fp").distinct(), radius))
    # every two blocks of a dense cell meet in a task of their own, which discards pairs by the same tables
    blocks = durable(dealt.groupBy("cell").count().filter(F.col("count") > cell_most).select("cell", F.ceil(F.col("count") * 2 / cell_most).cast("int").alias("blocks")))
    own = skew_join(dealt, blocks, ["cell"]).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("other <> block")
    met = met.select("fp", "cell", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    return links.unionByName(met.groupBy("cell", "low", "high").applyInArrow(lambda t: link(t.select(["fp"])), "a long, b long"))


def links_by_flips(fps: DataFrame, radius: int) -> DataFrame:
    """Links of radius 2 or less, whatever the density: fingerprints within distance 2 share one that differs from each in
    one bit at most, and all of the 65 that can share it are within distance 2 of each other, so no group exceeds 65 rows."""
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")) for b in range(64)])
    at = fps.select("fp", F.explode(flips).alias("at"))
    if radius < 2:
        flipped = at.filter("fp <> at").select(F.col("fp").alias("a"), F.col("at").alias("b")) if radius else at.limit(0).select(F.col("fp").alias("a"), F.col("at").alias("b"))
        return flipped.join(fps.select(F.col("fp").alias("b")), "b", "left_semi").select("a", "b")
    least = at.groupBy("at").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1")
    return at.join(least, "at").filter("fp <> b").select(F.col("fp").alias("a"), "b")


def near_duplicates(docs: DataFrame, radius: int = 2, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", cell_most: int = CELL_MOST) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the smallest id reachable over links of at most ``radius``
    differing bits. A null or empty text, or one of blanks only, has fingerprint zero and is linked like any other. Rows that
    repeat an id each get a row; null ids stay null, belong to their component, and are its id only where all its ids are
    null (then null). An empty table gives an empty result; other columns are ignored.

    Exact copies collapse to one fingerprint before any search, by aggregation on the map side.
    """
    found = durable(fingerprints(docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).alias("text")), shingle, seed))
    fps = durable(found.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = durable(components(link_fingerprints(fps, radius, cell_most)))
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = skew_join(rooted.select("fp", "root"), of_root, ["root"]).select("fp", "component_id")
    return skew_join(found, of_fp, ["fp"]).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, radius: int = 2, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate component: that with the smallest id.

    Rows that share an id are one document: they stay or go together, and go if any of their texts repeats that of a
    smaller id. Rows with a null id stay only where no id of their component is known. An empty table stays empty.
    """
    return keep_least(docs, near_duplicates(docs, radius, shingle, seed, id_col, text_col), id_col)


def keep_least(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that ``found`` (doc_id, component_id) gives another component's id."""
    gone = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("gone id")).distinct()
    return docs.join(gone.hint("shuffle_hash"), named(id_col).cast("long").eqNullSafe(F.col("`gone id`")), "left_anti")


def op3_simhash(spark, sf_dir):
    from ._common import table

    return near_duplicates(table(spark, sf_dir, "documents"))
