"""Token ids as Parquet: list columns, controlled row groups, dictionary or delta encoding, page indexes.

Documents are dealt out by ranges of their ids and sorted, so file n holds the documents before those of file n+1, and a file's documents are in order. Each row has
its place among the tokens of its file; a small index tells where each file begins. A reader that wants lengths alone never touches the ids; one that wants some
documents, or a span of the token stream, meets only the pages that hold them, by the files' page indexes.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import durable, named, partitions, remove_folder, shared_folder, sliced

SCHEMA = "doc_id long, first long, last long, n_tokens long, ids array<int>"


#: Kinds of bytes: punctuation, letters, digits, spaces, other white space, apostrophes, and all that is none of these for sure.
_PUNCTUATION, _LETTER, _DIGIT, _SPACE, _WHITE, _APOSTROPHE, _OTHER = range(7)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[33:127] = _PUNCTUATION
for _bytes, _kind in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", _LETTER), (b"0123456789", _DIGIT), (b" ", _SPACE), (b"\t\n\v\f\r", _WHITE), (b"'", _APOSTROPHE)):
    _KINDS[list(_bytes)] = _kind
#: First bytes of two-byte letters: U+00C0 to U+027F (but for the signs of multiplication and division) and U+0400 to U+047F.
_LEADS = np.zeros(256, bool)
_LEADS[[*range(0xC3, 0xCA), 0xD0, 0xD1]] = True
#: Where a piece always ends: between a byte of the one kind and one of the other.
_ENDS = np.zeros((7, 7), bool)
for _kind, _after in ((_LETTER, (_PUNCTUATION, _DIGIT, _SPACE, _WHITE, _APOSTROPHE)), (_DIGIT, (_PUNCTUATION, _LETTER, _SPACE, _WHITE, _APOSTROPHE)), (_PUNCTUATION, (_LETTER, _DIGIT, _SPACE, _WHITE)), (_APOSTROPHE, (_SPACE, _WHITE))):
    _ENDS[_kind, list(_after)] = True
#: First two bytes of characters that may be white space.
_MAYBE_WHITE = np.array([0xC285, 0xC2A0, 0xE19A, 0xE280, 0xE281, 0xE380], np.uint16)
_WORD = re.compile(r" ?\S+")


def piece_ends(data: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8 text, whether a piece of the byte-level pattern begins there for sure: after letters, digits or punctuation where another kind follows (an
    apostrophe may begin a piece that goes on with letters), and at a single space before anything but white space. Other pieces may begin elsewhere, too."""
    kinds = _KINDS[data]
    after = np.append(data[1:], np.uint8(0))
    lead = np.flatnonzero(_LEADS[data[:-1]])
    lead = lead[(data[lead] != 0xC3) | ((data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7))]
    kinds[lead] = kinds[lead + 1] = _LETTER
    begins = np.zeros(len(data), bool)
    begins[1:] = _ENDS[kinds[:-1], kinds[1:]]
    spaces = np.flatnonzero(kinds[:-1] == _SPACE)
    follows = kinds[spaces + 1]
    far = spaces[(follows == _OTHER) & (data[spaces + 1] >= 0xC2)]
    begins[far[~np.isin((after[far].astype(np.uint16) << 8) | after[np.minimum(far + 1, len(data) - 1)], _MAYBE_WHITE)]] = True
    begins[spaces[(follows != _OTHER) & (follows != _SPACE) & (follows != _WHITE)]] = True
    return begins


class Encoder:
    """The library's ids of whole texts, with a memo of words where that changes nothing.

    A byte-level vocabulary without a normaliser splits texts by a pattern whose pieces end for sure at the places of ``piece_ends``; so texts may be cut there, and each distinct part
    is given to the library once. Texts that hold a special string, and vocabularies of other kinds, are encoded whole. Cutting, telling parts apart and putting ids together are
    numpy's and Arrow's work; Python meets distinct parts only.
    """

    def __init__(self, vocabulary: str, end_id: int | None = None, entries: int = 700_000, longest: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_padding()
        self.library.no_truncation()
        spec = json.loads(vocabulary)
        split = spec.get("pre_tokenizer") or {}
        self.plain = spec.get("normalizer") is None and spec.get("post_processor") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        self.specials = [t["content"] for t in spec.get("added_tokens", []) if t["content"]]
        feed = self.library.encode("\n", add_special_tokens=False).ids
        self.line_feed = feed[0] if self.plain and len(feed) == 1 else None
        self.end_id, self.entries, self.longest = end_id, entries, longest
        self._forget()

    def _forget(self) -> None:
        """Slot 0 holds the end of a document; the others hold the ids of the parts in the memo."""
        self.memo, self.pool, self.places, self.sizes = {}, array("i", [self.end_id or 0]), array("q", [0]), array("q", [1])

    def _learn(self, parts: list[bytes]) -> None:
        """Ids of new parts into the memo. Words go to the library by lines of a text, as a line feed beside them is always a piece of its own and an id that no word has."""
        texts = [p.decode() for p in parts]
        words = [self.line_feed is not None and _WORD.fullmatch(t) is not None for t in texts]
        self._learn_apart([p for p, w in zip(parts, words, strict=True) if not w])
        parts, texts = [p for p, w in zip(parts, words, strict=True) if w], [t for t, w in zip(texts, words, strict=True) if w]
        for i in range(0, len(parts), 20_000):
            some = parts[i : i + 20_000]
            lines = ["\n".join(texts[j : min(j + 100, i + len(some))]) for j in range(i, i + len(some), 100)]
            found = np.concatenate([np.array([*x.ids, self.line_feed], np.int32) for x in self.library.encode_batch_fast(lines, add_special_tokens=False)])
            ends = np.flatnonzero(found == self.line_feed)
            if len(ends) != len(some) or any(s in x for s in self.specials for x in lines):
                self._learn_apart(some)
                continue
            begins = np.append(0, ends[:-1] + 1)
            self.memo.update(zip(some, range(len(self.places), len(self.places) + len(some)), strict=True))
            self.places.frombytes((begins + len(self.pool)).astype(np.int64).tobytes())
            self.sizes.frombytes((ends - begins).astype(np.int64).tobytes())
            self.pool.frombytes(found.tobytes())

    def _learn_apart(self, parts: list[bytes]) -> None:
        for i in range(0, len(parts), 5000):  # an encoding is far larger than its ids
            some = parts[i : i + 5000]
            for part, found in zip(some, self.library.encode_batch_fast([p.decode() for p in some], add_special_tokens=False), strict=True):
                ids = found.ids
                self.memo[part] = len(self.places)
                self.places.append(len(self.pool))
                self.sizes.append(len(ids))
                self.pool.extend(ids)

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text; null is empty."""
        texts = texts.cast(pa.string()).fill_null("")
        n = len(texts)
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int32)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        begins = piece_ends(data) if self.plain and len(data) else np.zeros(len(data), bool)
        for special in self.specials if self.plain else ():
            for i in np.flatnonzero(pc.match_substring(texts, special).to_numpy(zero_copy_only=False)):
                begins[ends[i] : ends[i + 1]] = False
        begins[ends[:-1][np.diff(ends) > 0]] = True
        starts = np.flatnonzero(begins)
        parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        distinct = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.memo) > self.entries:
            self._forget()
        unknown = [p for p in distinct if p not in self.memo]
        long = [p for p in unknown if len(p) > self.longest]
        self._learn([p for p in unknown if len(p) <= self.longest])
        kept = len(self.pool), len(self.places)
        self._learn(long)
        slots = np.fromiter(map(self.memo.__getitem__, distinct), np.int64, len(distinct))[parts.indices.to_numpy()]
        upto = np.searchsorted(starts, ends)
        if self.end_id is not None:
            slots = np.insert(slots, upto[1:], 0)
            upto = upto + np.arange(n + 1)
        sizes = np.array(self.sizes)[slots]
        after = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.array(self.pool)[np.repeat(np.array(self.places)[slots] - after[:-1], sizes) + np.arange(after[-1])]
        for p in long:
            del self.memo[p]
        del self.pool[kept[0] :], self.places[kept[1] :], self.sizes[kept[1] :]
        return pa.ListArray.from_arrays(pa.array(after[upto].astype(np.int32)), pa.array(ids))


def _encoder(vocabulary: str, end_id: int | None) -> Encoder:
    """The worker's encoder, which stays for the tasks that it runs next. It stands by the library, as this module travels by value, anew for each task."""
    import tokenizers

    key, kept = (vocabulary, end_id), vars(tokenizers).get("_kept_encoder")
    if kept is None or kept[0] != key:
        kept = tokenizers._kept_encoder = key, Encoder(vocabulary, end_id)
    return kept[1]


def _by_bytes(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with so many bytes of text (column 1) at most, or one row."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(batch):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def encode_with_end(docs: DataFrame, vocabulary: str, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) of every whole text by a vocabulary in JSON form, row by row, in the order of the rows; special strings inside texts as the library does by
    default, none added, ``end_id`` appended to each document. A null text is empty; a null id stays; repeated rows repeat; other columns are ignored."""
    return _placed(docs, vocabulary, end_id, id_col, text_col).select("doc_id", "n_tokens", "ids")


def _placed(docs: DataFrame, vocabulary: str, end_id: int | None, id_col: str, text_col: str) -> DataFrame:
    """The same, with ``first`` and ``last``: the places of a document's first and last token among the tokens of its partition, from 0."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        encoder, at = _encoder(shared.value, end_id), 0
        for batch in batches:
            for some in _by_bytes(batch):
                lists = encoder.encode(some.column(1))
                n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                upto = at + np.cumsum(n)
                at = int(upto[-1])
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(upto - n), pa.array(upto - 1), pa.array(n), lists], names=["doc_id", "first", "last", "n_tokens", "ids"])

    return docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).alias("text")).mapInArrow(run, SCHEMA)


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text", files: int | None = None, row_group_mb: int = 32, page_rows: int = 1000) -> None:
    """Token ids of ``docs`` in ``folder``/tokens, ascending by id (null ids first; documents with one id by a digest of their text), and ``folder``/index with a row a file.

    There are ``files`` files (None: as many as the session has shuffle partitions); each is cut into row groups of ``row_group_mb`` and pages of ``page_rows`` rows at most. Ids are
    encoded by a dictionary (a vocabulary of 50,000 takes 16 bits an id), places and lengths as deltas. Texts are shuffled once and encoded behind the shuffle. Documents
    with one id, any number of them, are spread over files.
    """
    text = F.coalesce(named(text_col), F.lit(""))
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("digest"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "digest", "row"]
    dealt = rows.repartitionByRange(files or partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    options = {
        "parquet.block.size": row_group_mb << 20, "parquet.page.row.count.limit": page_rows, "parquet.writer.version": "v2", "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": "true", "compression": "zstd", "maxRecordsPerFile": 0,
    }
    _placed(dealt, vocabulary, end_id, "doc_id", "text").write.options(**options).parquet(f"{folder}/tokens")
    spark = docs.sparkSession
    per_file = _files(spark, folder).groupBy("file", "name").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.min("doc_id").alias("least_doc"), F.max("doc_id").alias("greatest_doc"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    per_file.withColumn("file_start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long"))).coalesce(1).write.parquet(f"{folder}/index")


def _files(spark: SparkSession, folder: str, *names: str) -> DataFrame:
    """The rows of the files, or of those called ``names``, with the number that Spark gave each file."""
    rows = spark.read.schema(SCHEMA).parquet(*[f"{folder}/tokens/{n}" for n in names or ("",)])
    return rows.withColumn("name", F.col("_metadata.file_name")).withColumn("file", F.regexp_extract("name", r"^part-(\d+)", 1).cast("int"))


def read_tokens(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens[, ids]): ``start`` counts the tokens of all documents before. Without ``ids`` their pages are not read. A filter on ``doc_id`` reaches the files' page indexes."""
    index = spark.read.parquet(f"{folder}/index").select("file", "file_start")
    rows = _files(spark, folder).join(F.broadcast(index), "file")  # a row a file
    return rows.select("doc_id", (F.col("file_start") + F.col("first")).alias("start"), "n_tokens", *["ids"] * ids)


def read_span(spark: SparkSession, folder: str, begin: int, end: int) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents that hold tokens ``begin`` to ``end`` (exclusive) of the whole stream, ids cut to the span. Files outside of
    the span are not opened; inside, ``first`` and ``last`` ascend, so all pages but those of the span are skipped."""
    index = spark.read.parquet(f"{folder}/index")
    found = index.filter((F.col("file_start") < end) & (F.col("file_start") + F.col("n_tokens") > begin)).orderBy("file").select("name", "file_start").collect()
    if not found:
        return read_tokens(spark, folder).limit(0)
    at_ends = {r.name: r.file_start for r in (found[0], found[-1])}
    parts = [_files(spark, folder, n).filter((F.col("last") >= begin - at) & (F.col("first") < end - at)) for n, at in at_ends.items()]
    between = [r.name for r in found if r.name not in at_ends]
    if between:  # wanted whole
        parts.append(_files(spark, folder, *between))
    rows = reduce(DataFrame.unionByName, parts).join(F.broadcast(index.select("name", "file_start")), "name")  # a row a file
    out = rows.select("doc_id", (F.col("file_start") + F.col("first")).alias("start"), "n_tokens", "ids")
    skipped = F.greatest(F.lit(begin) - F.col("start"), F.lit(0)).cast("int")
    kept = F.least(F.col("n_tokens"), F.lit(end) - F.col("start")).cast("int") - skipped
    return out.withColumn("ids", F.slice("ids", skipped + 1, kept)).withColumn("start", F.greatest("start", F.lit(begin).cast("long")))


def digest_of_ids(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the unsigned crc32 of the ids as unsigned 32-bit integers, least byte first."""

    def run(batches):
        for batch in sliced(batches, 1000):
            column = batch.column("ids")
            values, ends = column.flatten().to_numpy().astype("<u4"), np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "start", "n_tokens")], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op13_token_store(spark, sf_dir):
    """Writes the files to the shared folder, reads them back, keeps the digests and removes the files."""
    import uuid

    import public_tokenizers

    from ._common import table

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    folder = f"{shared_folder(spark)}/token-store-{uuid.uuid4().hex}"
    try:
        write_tokens(table(spark, sf_dir, "documents"), folder, vocabulary)
        return durable(digest_of_ids(read_tokens(spark, folder)))
    finally:
        remove_folder(spark, folder)
