"""Substring dedup by level-wise doubling.

A window of ``window`` words can repeat only if each part of it repeats. Starting from a short length, every level keeps
the windows whose part of that length occurs again, and only these are extended to twice that length, up to
the window itself, or until no candidates are left (all levels are one plan; where a level finds nothing, adaptive execution
takes the levels after it out). The part that a window is judged by at a level is the one with the least hash
among all its parts of that length (the leftmost, on ties): equal windows then pick equal parts, neighbours mostly share
theirs, and a level shuffles about ``2 / (window - length + 2)`` rows a word instead of one.

Exact copies of a text are collapsed first (all of their windows occur elsewhere, so the answer for them is known);
one of them stands for the others. Each text that takes part is shuffled once, by its hash; all levels and the final
reassembly read that one exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import as_bytes, named, sliced, text_hashes

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Hashes of earlier batches that a task keeps in mind, at most.
REMEMBERED = 1 << 20
SCHEMA = "h1 long, h2 long, c int, t1 long, t2 long, run long"


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Both halves of the 128-bit hash of each word: two rows."""
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64)
    return np.ascontiguousarray(digests.reshape(-1, 2).T)


def window_hashes(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hash of the ``length`` words from each start: a polynomial modulo 2**64 over word hashes, by doubling, then mixed."""
    base = base | 1
    done, out = 0, None
    part, size = words, 1
    bits = length
    while True:
        if bits & 1:
            if out is None:
                out, done = part, size
            else:  # ``out`` covers the first words, ``part`` the next
                n = len(words) - (done + size) + 1
                out = out[:n] * np.uint64(pow(base, size, 1 << 64)) + part[done : done + n]
                done += size
        bits >>= 1
        if not bits:
            break
        n = len(part) - size
        part = part[:n] * np.uint64(pow(base, size, 1 << 64)) + part[size : size + n]
        size *= 2
    out = out ^ (out >> np.uint64(32))
    out = out * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def leftmost_least(values: np.ndarray, span: int) -> np.ndarray:
    """Position of the least of each ``span`` consecutive values, the leftmost on ties."""
    at = np.arange(len(values))
    low, size = values, 1
    while size < span:
        step = min(size, span - size)
        n = len(low) - step
        right = low[step : step + n] < low[:n]
        at = np.where(right, at[step : step + n], at[:n])
        low = np.where(right, low[step : step + n], low[:n])
        size += step
    return at


def runs_at(words: np.ndarray, length: int, window: int, alive: np.ndarray | None):
    """(h1, h2, lo, hi, place): the part at ``place`` stands for the windows lo..hi, among those alive (None: all)."""
    n = words.shape[1] - window + 1
    h1 = window_hashes(words[0], length, BASES[0])
    chosen = leftmost_least(h1, window - length + 1)[:n]
    starts = np.arange(n) if alive is None else alive
    chosen = chosen[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    h2 = window_hashes(words[1], length, BASES[1])[chosen[first]] if length == window else np.zeros(len(first), np.uint64)
    return h1[chosen[first]], h2, starts[first], starts[last], chosen[first]


def spread(runs) -> np.ndarray:
    """Window starts of runs (first start in the upper 32 bits, last in the lower), in order, each once."""
    runs = np.sort(np.array(runs or [], np.int64))
    lo, hi = runs >> 32, runs & 0xFFFFFFFF
    sizes = hi - lo + 1
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.unique(np.repeat(lo, sizes) + within)


class Told:
    """Hashes of a task's earlier batches, within a bound: which are known, and which of them others have been told of."""

    def __init__(self, most: int = REMEMBERED):
        self.most, self.pending = most, None
        self.h1 = self.h2 = np.zeros(0, np.uint64)
        self.told = np.zeros(0, bool)

    def find(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, told, place) of hashes."""
        if self.pending is not None:
            pending, self.pending = self.pending, None
            self._merge(*pending)
        if not len(self.h1):
            return np.zeros(len(h1), bool), np.zeros(len(h1), bool), np.zeros(len(h1), np.int64)
        at = np.minimum(np.searchsorted(self.h1, h1), len(self.h1) - 1)
        known = (self.h1[at] == h1) & (self.h2[at] == h2)
        return known, known & self.told[at], at

    def add(self, h1: np.ndarray, h2: np.ndarray, told: np.ndarray) -> None:
        """Each hash once; kept in mind when the next batch comes."""
        self.pending = h1, h2, told

    def _merge(self, h1, h2, told):
        known, _, at = self.find(h1, h2)
        self.told[at[known]] |= told[known]
        new = ~known
        if len(self.h1) + new.sum() > self.most:  # those that repeat stay, then those of this batch
            keep = self.told if self.told.sum() <= self.most // 2 else np.zeros(len(self.h1), bool)
            self.h1, self.h2, self.told = self.h1[keep], self.h2[keep], self.told[keep]
            if new.sum() > self.most // 2:
                new &= told
                new &= np.cumsum(new) <= self.most // 2
        both = np.concatenate([self.h1, h1[new]])
        order = np.argsort(both, kind="stable")
        self.h1, self.h2, self.told = both[order], np.concatenate([self.h2, h2[new]])[order], np.concatenate([self.told, told[new]])[order]


def level_rows(texts: DataFrame, length: int, window: int, remembered: int = REMEMBERED) -> DataFrame:
    """A row for each part to be counted at this level.

    What occurs twice within a batch, or again in a later batch of the task, is known to repeat: its places go on under a hash of
    their own, with count 2, and one row without a place tells other tasks. So a hot hash has about as many rows as
    there are tasks, as in any aggregation on the map side.
    """

    def run(batches):
        memory = Told(remembered)
        for batch in batches:
            alive = batch.column("alive").to_pylist() if "alive" in batch.schema.names else None
            parts = []
            for i, text in enumerate(as_bytes(batch.column("text"))):
                words = text.split()
                if len(words) < window:
                    continue
                starts = spread(alive[i]) if alive is not None else None
                if starts is not None and not len(starts):
                    continue
                h1, h2, lo, hi, place = runs_at(word_hashes(words), length, window, starts)
                parts.append((h1, h2, lo, hi, place, np.full(len(lo), i)))
            if not parts:
                continue
            h1, h2, lo, hi, place, row = (np.concatenate(x) for x in zip(*parts, strict=True))
            t1, t2 = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("t1", "t2"))
            order = np.lexsort((place, row, h2, h1))
            a, b, r, p = h1[order], h2[order], row[order], place[order]
            new, moved = np.ones(len(a), bool), np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            moved[1:] = new[1:] | (r[1:] != r[:-1]) | (p[1:] != p[:-1])
            group = np.cumsum(new) - 1
            known, told, _ = memory.find(a[new], b[new])
            repeats = (np.bincount(group, weights=moved) > 1) | known
            memory.add(a[new], b[new], repeats)
            twice = repeats[group]
            count = np.where(twice, 2, moved).astype(np.int32)  # several runs of windows at one place count once
            tell = order[new][repeats & ~told]
            # back to the order of the texts: rows of one text lie together and compress
            twice, count = (x[np.argsort(order)] for x in (twice, count))
            own = window_hashes(np.stack([t1.view(np.uint64), lo.astype(np.uint64)], 1).reshape(-1), 2, BASES[1])[::2]
            keys = np.where(twice, own, h1), np.where(twice, t2.view(np.uint64), h2)
            nowhere = np.arange(len(lo) + len(tell)) >= len(lo)
            columns = [pa.array(np.concatenate([k, h[tell]]).view(np.int64)) for k, h in zip(keys, (h1, h2), strict=True)]
            columns.append(pa.array(np.concatenate([count, np.full(len(tell), 2, np.int32)])))
            for x in (t1, t2, lo << 32 | hi):
                columns.append(pa.array(np.concatenate([x, np.zeros(len(tell), np.int64)]), mask=nowhere))
            yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "c", "t1", "t2", "run"])

    return texts.mapInArrow(run, SCHEMA)


def dedup_substrings(docs: DataFrame, window: int = 35, start: int = 9, id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): each word covered by a window whose words also start anywhere else is removed.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; kept words are joined by one space. All windows are judged on the input,
    copies in the same document and overlapping ones included. A null or empty text has no words and keeps an empty text; texts
    of fewer words than the window lose nothing. Repeated rows, with one id or several, are copies of each other. A null id
    stays null; an empty table gives an empty result; other columns are ignored.
    """
    if not 1 <= start <= window:
        raise ValueError("start must be from 1 to the window")
    t1, t2 = text_hashes(named(text_col))
    base = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).alias("text"), t1.alias("t1"), t2.alias("t2"))
    copies = base.groupBy("t1", "t2").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first"))
    # Texts with at least a thousandth of all rows: a thousand at most, so they can be broadcast.
    hot = copies.filter(F.col("copies") >= max(2, -(-docs.count() // 1000))).select(F.col("t1").alias("s1"), F.col("t2").alias("s2"), F.col("first").alias("stands"), F.lit(True).alias("hot"))
    marked = base.join(F.broadcast(hot), (F.col("t1") == F.col("s1")) & (F.col("t2") == F.col("s2")), "left")
    copied = F.coalesce(F.col("hot"), F.lit(False)) & ~F.col("doc_id").eqNullSafe(F.col("stands"))
    texts = marked.filter(~copied).select("doc_id", "text", "t1", "t2").join(copies.hint("shuffle_hash"), ["t1", "t2"])
    # "<=", as an equality would become a key of the join and ask for another exchange; a null id may stand, too
    least = F.lit(-(2**63)).cast("long")
    standing = texts.filter(F.coalesce("doc_id", least) <= F.coalesce("first", least))

    found, length = None, start
    while True:
        if found is None:
            level = level_rows(standing.select("t1", "t2", "text"), length, window, remembered)
        else:
            level = level_rows(standing.join(found.hint("shuffle_hash"), ["t1", "t2"]).select("t1", "t2", "text", "alive"), length, window, remembered)
        again = level.withColumn("n", F.sum("c").over(W.partitionBy("h1", "h2"))).filter("n > 1 AND run IS NOT NULL")
        found = again.groupBy("t1", "t2").agg(F.collect_list("run").alias("alive"))
        if length == window:
            break
        length = min(2 * length, window)

    judged = texts.join(found.hint("shuffle_hash"), ["t1", "t2"], "left").select("doc_id", "text", "copies", "alive")

    def cut(batches):
        for batch in sliced(batches):
            n_words, n_removed, kept = [], [], []
            for text, copies, alive in zip(as_bytes(batch.column("text")), batch.column("copies").to_pylist(), batch.column("alive").to_pylist(), strict=True):
                words = text.split()
                n = len(words)
                if copies > 1 and n >= window:
                    stay = []
                elif alive:
                    at = spread(alive)
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                    stay = [words[i] for i in np.flatnonzero(np.cumsum(edge[:n]) == 0).tolist()]
                else:
                    stay = words
                n_words.append(n)
                n_removed.append(n - len(stay))
                kept.append(b" ".join(stay))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    schema = "doc_id long, n_words long, n_removed long, kept_text string"
    no_windows = F.lit(None).cast("array<bigint>").alias("alive")
    others = marked.filter(copied).select("doc_id", "text", F.lit(2).cast("long").alias("copies"), no_windows)
    return judged.mapInArrow(cut, schema).unionByName(others.mapInArrow(cut, schema))


def op8_substring_dedup(spark, sf_dir):
    from ._common import table

    out = dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = {
    "op8_substring_dedup": r"""
        WITH w AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        starts AS (SELECT n, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35),
        windows AS (SELECT n, i, array_to_string(ws[i:i + 34], ' ') AS k FROM starts JOIN w USING (n)),
        twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
        gone AS (SELECT DISTINCT n, unnest(range(i, i + 35)) AS p FROM windows WHERE k IN (SELECT k FROM twice)),
        words AS (SELECT n, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
        kept AS (SELECT n, string_agg(word, ' ' ORDER BY p) AS kept FROM words ANTI JOIN gone USING (n, p) GROUP BY n),
        lost AS (SELECT n, count(*) AS n_removed FROM gone GROUP BY n)
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (n) LEFT JOIN lost USING (n)
    """,
}
