"""Near-copies by the share of common word shingles: SimHash first, then what lies beyond its radius.

Texts whose sets of word shingles have a Jaccard similarity of ``least`` or more are linked. Groups of texts are found in two ways, and compared by their shingles:

* SimHash: fingerprints (``simhash``, three words: over five words, near-copies differ in more bits) at a distance of ``radius`` or less are linked by pivot
  distance tables; each component is a group.
* Texts just at ``least`` differ in more bits than pivots can search, so texts of different components are brought together where they agree in all ``ROWS``
  least hashes of one band or more (MinHash); a pair at similarity ``s`` does with probability ``1 - (1 - s**ROWS) ** BANDS``: at 0.8, about 1 pair in
  ten million does not. Bands that hold texts of one component only are settled by it.

So no link is an estimate.

A group whose texts are too large for one task is compared in blocks. Each block is joined by one text of the group, its hub; what reaches the hub within its
block is linked to all else that does. Only the others (strays) must still meet all blocks, a block of strays at a time, so that every pair is compared or
known to be linked, and a task never holds more than two blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from ._common import as_bytes, components, durable, named, skew_join, sliced, spread

#: Bands of least hashes, and hashes of a band.
BANDS, ROWS = 31, 4
#: Bytes of text that a block of a group has, about; a longer text has a block of its own at most.
BLOCK = 32 << 20
_RNG = np.random.default_rng(0)
_TURN = _RNG.integers(0, 2**32, BANDS * ROWS, np.uint32)
_TIMES = _RNG.integers(0, 2**32, BANDS * ROWS, np.uint32) | np.uint32(1)
_BAND = _RNG.integers(0, 2**64, BANDS, np.uint64)


def plain_words(text: bytes) -> bytes:
    """A text's words in lower case, one blank between them."""
    return b" ".join(text.lower().split())


def shingles(plain: bytes, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """Distinct 64-bit hashes of a plain text's word shingles; a text of fewer words is one shingle."""
    words = plain.split(b" ")
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    last = max(1, len(words) - shingle + 1)
    parts = zip((ends - sizes)[:last].tolist(), ends[min(shingle, len(words)) - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(plain[i:j], seed) for i, j in parts), np.uint64, last))


def bands(own: np.ndarray) -> np.ndarray:
    """A set's bands, each as a signed 64-bit integer."""
    high = (own >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 2**32 - 1, np.uint32)
    for i in range(0, len(high), 256):
        np.minimum(least, ((high[i : i + 256, None] ^ _TURN) * _TIMES).min(axis=0), out=least)
    out = _BAND.copy()
    for column in least.reshape(BANDS, ROWS).T:
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def links_in_group(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """A spanning forest, as pairs of positions, of all pairs of a group with similarity ``least`` or more.

    A member found is compared with all that are not yet found, so what is linked early is not compared again.
    """
    known, flat = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(x) for x in sets])
    ends = np.cumsum(sizes)
    own = [flat[e - n : e] for e, n in zip(ends, sizes, strict=True)]
    left, here, out = np.arange(len(sets)), np.zeros(len(known), bool), []
    while len(left):
        todo, left = [int(left[0])], left[1:]
        items = flat if len(left) + 1 == len(sets) else None
        while todo and len(left):
            at = todo.pop()
            if items is None or len(items) != sizes[left].sum():
                items = np.concatenate([own[i] for i in left])
            here[own[at]] = True
            common = np.add.reduceat(here[items], np.cumsum(sizes[left]) - sizes[left], dtype=np.int64)
            here[own[at]] = False
            near = common >= least * (sizes[left] + sizes[at] - common) - 1e-9
            if near.any():
                found = left[near].tolist()
                out += [(at, i) for i in found]
                todo += found
                left = left[~near]
    return out


def _links_in_blocks(large: DataFrame, plain: DataFrame, link, block: int, compare) -> DataFrame:
    """Links (a, b) of the groups ``large`` (node, bytes, band, blocks, hub), a row for each member, that connect the same texts as all their pairs do."""
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    at = large.withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    hubs = large.select("band", "hub", "blocks").distinct().select("band", F.col("hub").alias("node"), numbers("blocks").alias("block"), "hub")
    meet = at.select("band", "node", "block", "hub").unionByName(hubs).distinct()

    def link_block(group):
        """(a, b, band): each text but the least of its component, linked to that or, if it is there, to the hub."""
        hub, nodes = group.column("hub")[0].as_py(), group.column("node").to_numpy()
        order = np.argsort(nodes != hub, kind="stable")  # the hub's component is found first, from the hub
        nodes, root = nodes[order], {}
        for known, new in compare([group.column("plain")[int(i)].as_py() for i in order]):
            root[new] = root.get(known, known)
        a, b = (nodes[np.fromiter(x, np.int64, len(root))] for x in (root.keys(), root.values()))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "band": pa.array([group.column("band")[0].as_py()] * len(a), pa.int64())})

    near = durable(skew_join(meet, plain, ["node"]).groupBy("band", "block").applyInArrow(link_block, "a long, b long, band long"))
    reached = near.select("band", F.col("a").alias("node"), F.col("b").alias("hub"))
    strays = durable(at.filter("node <> hub").join(reached.hint("merge"), ["band", "node", "hub"], "left_anti"))
    of_band = strays.groupBy("band").agg(F.ceil(F.sum("bytes") / block).alias("slices"))
    one = skew_join(strays, of_band, ["band"]).select("band", "node", F.pmod(F.xxhash64(F.lit("slice"), "node"), "slices").alias("slice"), numbers("blocks").alias("block"))
    two = skew_join(at, of_band, ["band"]).select("band", "node", numbers("slices").alias("slice"), "block")
    far = skew_join(one.unionByName(two).distinct(), plain, ["node"]).groupBy("band", "slice", "block").applyInArrow(link, "a long, b long")
    return near.select("a", "b").unionByName(far)


def near_copies(docs: DataFrame, least: float = 0.8, shingle: int = 5, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, radius: int = 2) -> DataFrame:
    """(doc_id, component_id) for every row of ``docs``: the smallest id reachable over links.

    Texts of the same words are linked, null and empty ones too. Rows that repeat an id each get a row; null ids stay null, belong to
    their component, and are its id only where all its ids are null (then null). An empty table gives an empty result.

    A text is named by a 64-bit hash of its words. Copies collapse before any search; groups that hold the same texts in several
    bands are compared once, and only texts of a group travel to be compared. ``block`` bounds the bytes of text that are compared in one task, ``radius``
    (2 at most) the bits in which fingerprints differ that SimHash links; the result does not depend on them.
    """
    texts = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).alias("text"))

    def sign(batches):
        for batch in sliced(batches):
            plain = [plain_words(t) for t in as_bytes(batch.column(1))]
            nodes = np.array([xxhash.xxh64_intdigest(p, seed) for p in plain], np.uint64).view(np.int64)
            fps = np.array([simhash.fingerprint(p, seed=seed) for p in plain], np.uint64).view(np.int64)
            found = np.array([bands(shingles(p, shingle, seed)) for p in plain], np.int64).reshape(-1)
            ends = pa.array(np.arange(0, len(found) + 1, BANDS, dtype=np.int32))
            sizes = pa.array([len(p) for p in plain], pa.int64())
            columns = [batch.column(0), pa.array(nodes), sizes, pa.array(fps), pa.ListArray.from_arrays(ends, pa.array(found))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "bytes", "fp", "bands"])

    def reduce_to_words(batches):
        for batch in sliced(batches):
            plain = [plain_words(t) for t in as_bytes(batch.column(0))]
            nodes = np.array([xxhash.xxh64_intdigest(p, seed) for p in plain], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(plain, pa.binary())], names=["node", "plain"])

    def compare(plain):
        return links_in_group([shingles(p, shingle, seed) for p in plain], least)

    def link(group):
        nodes = group.column("node").to_numpy()
        pairs = compare(group.column("plain").to_pylist())
        a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
        return pa.table({"a": pa.array(nodes[a], pa.int64()), "b": pa.array(nodes[b], pa.int64())})

    signed = durable(spread(texts).mapInArrow(sign, "doc_id long, node long, bytes long, fp long, bands array<long>"))
    of_node = durable(signed.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("bytes").alias("bytes"), F.first("fp").alias("fp")))

    near = durable(components(simhash.link_fingerprints(durable(of_node.select("fp").distinct()), radius)))
    classes = durable(skew_join(of_node, near.withColumnRenamed("node", "fp"), ["fp"], "left").select("node", "bytes", F.coalesce("root", "fp").alias("class")))
    several = classes.groupBy("class").agg(F.count("*").alias("n")).filter("n > 1").select("class")
    of_class = skew_join(classes.select("node", "class"), several, ["class"]).select(F.col("class").alias("band"), "node")

    # beyond the radius: bands that hold texts of several components; only what this needs rides along in the exchanges of all bands
    of_bands = signed.groupBy("node").agg(F.first("bands").alias("bands")).join(classes.select("node", "class").hint("merge"), "node")
    of_bands = of_bands.select("node", "class", F.explode(F.array_distinct("bands")).alias("band"))
    open_bands = of_bands.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high").select("band")
    beyond = skew_join(of_bands.select("band", "node"), open_bands, ["band"]).select("band", "node")

    met = durable(of_class.unionByName(beyond).distinct())
    sizes = skew_join(met, classes.select("node", "bytes"), ["node"])
    blocks = F.least(F.ceil(F.sum("bytes") / block), F.count("*")).alias("blocks")
    groups = sizes.groupBy("band").agg(F.count("*").alias("n"), F.bit_xor("node").alias("x"), F.bit_xor(F.xxhash64("node")).alias("y"), blocks, F.min("node").alias("hub"))
    groups = groups.groupBy("n", "x", "y").agg(F.min("band").alias("band"), F.min("blocks").alias("blocks"), F.min("hub").alias("hub")).select("band", "blocks", "hub")
    inside = durable(skew_join(sizes, groups, ["band"]).select("node", "bytes", "band", "blocks", "hub"))
    wanted = inside.select("node").distinct()
    plain = spread(texts.select("text")).mapInArrow(reduce_to_words, "node long, plain binary")
    plain = skew_join(plain, wanted, ["node"], "left_semi").groupBy("node").agg(F.first("plain").alias("plain"))
    whole = inside.filter("blocks <= 1").select("band", "node")
    large = inside.filter("blocks > 1")
    if large.isEmpty():
        links = skew_join(whole, plain, ["node"]).select("band", "node", "plain").groupBy("band").applyInArrow(link, "a long, b long")
    else:
        plain = durable(plain)
        links = skew_join(whole, plain, ["node"]).select("band", "node", "plain").groupBy("band").applyInArrow(link, "a long, b long")
        links = links.unionByName(_links_in_blocks(large, plain, link, block, compare))
    roots = durable(components(links))
    rooted = of_node.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named_by = skew_join(rooted.select("node", "root"), of_root, ["root"]).select("node", "component_id")
    return skew_join(signed.select("doc_id", "node"), named_by, ["node"]).select("doc_id", "component_id")
