"""Token counts by heap-and-linked-list byte-pair merging, without making identifiers.

A pre-token of ``n`` bytes that undergoes ``m`` merges has ``n - m`` tokens. Merges are taken from a heap of adjacent
pairs ordered by (rank, position); symbols form a doubly linked list, so one merge touches its two neighbours only and a
pre-token of ``n`` bytes costs O(n log n).
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import Memo, named, pieces_of, sliced, spread

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the others
    take the code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class MergeCounter:
    """Counts tokens of texts under a byte-level BPE vocabulary file in JSON form."""

    def __init__(self, vocabulary: str, pattern: str):
        import regex

        spec = json.loads(vocabulary)
        model, alphabet = spec["model"], byte_alphabet()
        ids = model["vocab"]
        self.start = [0] * 256
        for stand_in, byte in alphabet.items():
            self.start[byte] = ids[stand_in]
        #: (left symbol, right symbol) -> (rank, merged symbol)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[ids[left], ids[right]] = (rank, ids[left + right])
        specials = sorted((x["content"] for x in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.pattern = regex.compile(pattern)
        self.memo = Memo(lambda piece: self.count_piece(piece.encode()))

    def count_piece(self, piece: bytes) -> int:
        """Initial symbols minus merges."""
        n = len(piece)
        if n < 2:
            return n
        pairs, start = self.pairs, self.start
        symbol = [start[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if found := pairs.get((symbol[i], symbol[i + 1])):
                heap.append((found[0], i))
        heapify(heap)
        merges = 0
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if symbol[i] < 0 or j >= n:
                continue
            found = pairs.get((symbol[i], symbol[j]))
            if found is None or found[0] != rank:
                continue  # one of the two has since been merged
            merges += 1
            symbol[i], symbol[j] = found[1], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if right := pairs.get((symbol[i], symbol[k])):
                    heappush(heap, (right[0], i))
            h = before[i]
            if h >= 0 and (left := pairs.get((symbol[h], symbol[i]))):
                heappush(heap, (left[0], h))
        return n - merges

    def count(self, text: str) -> int:
        """Tokens of a whole text; a special string inside it is one token."""
        total, segments = 0, [text]
        if self.special and self.special.search(text):
            segments = self.special.split(text)
            total = len(segments) - 1
        get = self.memo.__getitem__
        return total + sum(sum(map(get, pieces_of(self.pattern, s))) for s in segments)


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text; one output row per input row, no shuffle.

    ``vocabulary`` is the content of the vocabulary file (of fixed size, so it travels with the task), ``pattern`` its
    pre-token pattern. A null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated rows give repeated
    results; an empty table gives an empty result; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, pattern))

    def run(batches):
        counter = MergeCounter(*shared.value)
        for batch in sliced(batches):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            tokens = [counter.count(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return spread(docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).alias("text"))).mapInArrow(run, SCHEMA)


def op1_token_counts(spark, sf_dir):
    import public_tokenizers

    from ._common import table

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)
