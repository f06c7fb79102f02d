"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary answers whole pre-tokens with one probe and one comparison.
Tier two: the others are merged with a heap of adjacent pairs over linked bytes, lowest rank first, leftmost on ties.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from ._common import Memo, named, pieces_of, sliced, spread

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(content: bytes) -> dict[bytes, int]:
    """A rank file: base64 of the piece, a space, its rank."""
    return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in content.splitlines() if line)}


class PerfectHash:
    """Minimal perfect hash by hash-and-displace: ``n`` keys fill slots 0 to n-1 exactly.

    A key's first hash picks a bucket. Buckets are placed from the largest down: a displacement is sought that sends all
    keys of the bucket to free slots; buckets with a single key take the next free slot and store it as ``-slot - 1``.
    """

    def __init__(self, keys: list[bytes], per_bucket: int = 3):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // per_bucket)
        self.shift = [0] * self.buckets
        self.key: list[bytes | None] = [None] * n
        members: list[list[tuple[int, bytes]]] = [[] for _ in range(self.buckets)]
        for k in keys:
            h = xxhash.xxh3_64_intdigest(k)
            members[h % self.buckets].append((h, k))
        free = set(range(n))
        for b in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            if len(members[b]) > 1:
                shift = 1
                while True:
                    slots = {self._slot(h, shift) for h, _ in members[b]}
                    if len(slots) == len(members[b]) and slots <= free:
                        break
                    shift += 1
                self.shift[b] = shift
                for h, k in members[b]:
                    self.key[self._slot(h, shift)] = k
                free -= slots
            elif members[b]:
                slot = free.pop()
                self.shift[b] = -slot - 1
                self.key[slot] = members[b][0][1]

    def _slot(self, h: int, shift: int) -> int:
        x = ((h >> 17) ^ (shift * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
        x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
        return (x ^ (x >> 32)) % self.n

    @classmethod
    def restored(cls, shift: list[int], key: list[bytes]) -> PerfectHash:
        """The hash whose parts were found elsewhere."""
        own = cls.__new__(cls)
        own.n, own.buckets, own.shift, own.key = len(key), len(shift), shift, key
        return own

    def find(self, key: bytes) -> int:
        """The slot of a key, or -1 where it is none of the keys."""
        if not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        shift = self.shift[h % self.buckets]
        slot = -shift - 1 if shift < 0 else self._slot(h, shift)
        return slot if self.key[slot] == key else -1


class Codec:
    """Encoder and decoder of a rank vocabulary, without special tokens."""

    def __init__(self, content: bytes, pattern: str, placed: tuple[list[int], list[int]] | None = None):
        """``placed``: the parts of the perfect hash (``parts``), if it was built before."""
        import regex

        self.ranks = read_ranks(content)
        self.piece_of = {i: p for p, i in self.ranks.items()}
        self.whole = PerfectHash.restored(placed[0], [self.piece_of[i] for i in placed[1]]) if placed else PerfectHash(list(self.ranks))
        self.id_at = placed[1] if placed else [self.ranks[k] for k in self.whole.key]
        self.pair_rank = [self.ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]
        self.pattern = regex.compile(pattern)
        self.memo = Memo(self._packed)

    def parts(self) -> tuple[list[int], list[int]]:
        """What the perfect hash is made of: displacements, and the identifier in each slot."""
        return self.whole.shift, self.id_at

    def _packed(self, piece: str) -> bytes:
        raw = piece.encode()
        slot = self.whole.find(raw)
        return array("I", [self.id_at[slot]] if slot >= 0 else self.merge(raw)).tobytes()

    def merge(self, piece: bytes) -> list[int]:
        """Identifiers of a piece by merging its linked bytes."""
        n, get = len(piece), self.ranks.get
        end = list(range(1, n + 1))  # where the part that starts here ends
        before = list(range(-1, n - 1))  # where the part before starts
        # rank of the part joined with the next one; -1: no such piece, or no such part any more
        joined = [self.pair_rank[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]
        joined.append(-1)
        heap = [r << 40 | i for i, r in enumerate(joined) if r >= 0]  # ordered by rank, then place
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFFFF
            if joined[i] != top >> 40:
                continue
            j = end[i]
            k = end[i] = end[j]
            joined[j] = joined[i] = -1
            if k < n:
                before[k] = i
                if (r := get(piece[i : end[k]])) is not None:
                    joined[i] = r
                    heappush(heap, r << 40 | i)
            h = before[i]
            if h >= 0:
                joined[h] = r = get(piece[h:k], -1)
                if r >= 0:
                    heappush(heap, r << 40 | h)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def encode(self, text: str) -> bytes:
        """The identifiers as unsigned 32-bit integers in the machine's order (little-endian on all Spark platforms)."""
        return b"".join(map(self.memo.__getitem__, pieces_of(self.pattern, text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.piece_of.__getitem__, array("I", ids)))


def encode_documents(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Encode every whole text and decode the ids again; one output row per input row, no shuffle.

    ``ranks`` is the content of the rank file (fixed size); the perfect hash over it is built once, on the driver. ``keep_ids`` adds
    ``ids array<int>``, ``carry`` names columns that follow as they are. A null text is empty: no tokens, digests of no bytes. A null id stays null, repeated rows repeat (a text that
    follows itself is encoded once), an empty table gives no rows, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern, Codec(ranks, pattern).parts()))

    def run(batches):
        codec = Codec(*shared.value)
        before, result = None, None
        for batch in sliced(batches):
            found = []
            for text in batch.column(1).to_pylist():
                if result is None or text != before:
                    packed = codec.encode(text or "")
                    before, result = text, (packed, hashlib.sha256(packed).hexdigest(), hashlib.sha256(codec.decode(packed)).hexdigest())
                found.append(result)
            columns = [batch.column(0), pa.array([len(x[0]) // 4 for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string()), pa.array([x[2] for x in found], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                ends = np.cumsum([0, *(len(x[0]) // 4 for x in found)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(x[0] for x in found), np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[2:]], names=[*names, *batch.schema.names[2:]])

    # columns travel under numbers, so names may hold anything
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).alias("text"), *[named(c).alias(str(i)) for i, c in enumerate(carry)])
    schema = SCHEMA + (", ids array<int>" if keep_ids else "") + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    out = spread(rows).mapInArrow(run, schema)
    return out.withColumnsRenamed({str(i): c for i, c in enumerate(carry)}) if carry else out


def op9_byte_bpe(spark, sf_dir):
    import public_tokenizers

    from ._common import table

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    return encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
