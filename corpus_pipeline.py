"""Training-corpus pipeline: each stage takes the documents that its predecessor kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` applies
them to ``documents``, with a checkpoint between stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm import byte_bpe, language_id, line_dedup, mixing, shingle_dedup, simhash
from tesserae.llm._common import durable, table

#: Language ID, bisection over all sources and BPE have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told, ``lang`` being the one that the text shows; others (null, without a letter, or in
    scripts of no learned language: score 0) go.

    Where no language can be learned, none can be ruled out either: all documents with a letter stay as they are.
    """
    model = language_id.learn(docs.filter(language_id.fold() != 1))
    if not model.languages:
        return docs.filter(r"text RLIKE r'\p{L}'")
    found = language_id.identify(docs, model).filter(f"lang_pred <> '{language_id.UNKNOWN}' AND score > 0")
    return found.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: texts that share four fifths of their five-word shingles. SimHash links those within
    its radius, which are then checked by their shingles; least hashes bring together those beyond it, which are most of them: see the README."""
    return simhash.keep_least(docs, shingle_dedup.near_copies(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at target weights, which close half of the gap to the highest entropy; every document is used once at least, null and empty
    texts too. A row for each use, the uses of a document following each other; ``mix_sources`` gives their places."""
    return mixing.mix_sources(docs, gap_closed=0.5).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each use of a document, with a digest of what they decode to, then its source and language; uses that follow each other are encoded once. A
    null or empty text has no tokens."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    return byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, keep_ids=True, carry=tuple(c for c in ("source", "lang") if c in docs.columns))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = durable(docs)
    return docs
