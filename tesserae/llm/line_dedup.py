"""Line dedup: lines that many documents share stay in one of them only.

Lines are exploded as (document, position, 128-bit hash of the normalised line); distinct documents are counted for each
hash; lines over the threshold are dropped everywhere but in the keeper; documents are reassembled by position. Only
hashes and positions travel for the counting; each text is shuffled once, to meet the positions that it loses.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import durable, forget, named, rest, skew_join, text_hashes

BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def trimmed(line: Column) -> Column:
    """A line without blanks at its ends. Spark's rtrim lists all characters of a line, so it is kept to lines that end in a blank."""
    ends = reduce(or_, [line.endswith(b) for b in BLANK])
    return F.ltrim(F.when(ends, F.rtrim(line, F.lit(BLANK))).otherwise(line), F.lit(BLANK))


def lowered(text: Column) -> Column:
    """A-Z in lower case; Spark's lower does this, and only this, to ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, own, pos, h1, h2) of each line long enough to be judged."""
    lines = docs.select("doc", "own", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).filter(F.octet_length("line") >= min_chars)
    keys = lines.select("doc", "own", "pos", trimmed(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    h1, h2 = text_hashes(F.col("key"))
    return keys.withColumn("key", lowered(F.col("key"))).select("doc", "own", "pos", h1.alias("h1"), h2.alias("h2"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with the text reassembled, plus ``n_lines`` (before dropping) and ``n_dropped``.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` different documents keeps its lines in the
    document with the largest id only. A null or empty text is one empty line, never dropped, and comes back as an empty text. Documents are
    told apart by id: rows that repeat an id count once and are treated alike; rows with a null id count as one document
    that sorts below all others. Bytes of a text that are no UTF-8 become U+FFFD, before anything else. ``n_lines`` and ``n_dropped`` replace columns of those names, in any case. An empty table gives an empty result.

    Lines are split and hashed once; their hashes and positions stand in the shared folder until the verdicts are known. The counting shuffles on (hash, document)
    and then on partial counts, so no line is hot; the join that brings verdicts back has one row for each repeated hash on its small side and is left to
    adaptive skew splitting. The lost positions that a task holds in memory take a tenth of its texts' bytes at most: four for a line of ``min_chars``.
    """
    carried = rest(docs, id_col, text_col, "n_lines", "n_dropped")
    valid = F.make_valid_utf8(named(text_col))
    base = docs.select(
        named(id_col).cast("long").alias("doc"),
        F.xxhash64(valid).alias("own"),  # tells apart rows that share an id
        valid.alias("text"),
        F.struct(F.lit(0).alias("_"), *[named(c).alias(f"c{i}") for i, c in enumerate(carried)]).alias("carried"),
    )
    lines = durable(line_hashes(base.select("doc", "own", "text"), min_chars))
    verdicts = (
        lines.select("h1", "h2", F.coalesce("doc", F.lit(-(2**63))).alias("doc"))
        .groupBy("h1", "h2")
        .agg(F.countDistinct("doc").alias("n"), F.max("doc").alias("keeper"))
        .filter(F.col("n") >= min_docs)
        .select("h1", "h2", "keeper")
    )
    lost = durable(
        skew_join(lines, verdicts, ["h1", "h2"])
        .filter(F.coalesce("doc", F.lit(-(2**63))) != F.col("keeper"))
        .groupBy(F.col("doc").alias("lost_doc"), F.col("own").alias("lost_own"))
        .agg(F.collect_set("pos").alias("lost"))
    )
    forget(lines)
    joined = base.join(lost.hint("shuffle_hash"), F.col("doc").eqNullSafe(F.col("lost_doc")) & (F.col("own") == F.col("lost_own")), "left").select("doc", F.coalesce("text", F.lit("")).alias("text"), "lost", "carried")
    parts = joined.select("*", F.split("text", "\n", -1).alias("parts"))
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("lost"))  # in order
    text = F.when(F.col("lost").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("parts", i)), "\n"))
    counts = F.size("parts").cast("long"), F.coalesce(F.size("lost"), F.lit(0)).cast("long")
    out = parts.select("doc", text.alias("text"), counts[0].alias("n_lines"), counts[1].alias("n_dropped"), "carried")
    kept = {id_col: F.col("doc"), text_col: F.col("text")} | {c: F.col(f"carried.c{i}") for i, c in enumerate(carried)}
    return out.select(*[kept[c].alias(c) for c in docs.columns if c in kept], F.col("n_lines"), F.col("n_dropped"))


def op2_line_dedup(spark, sf_dir):
    from ._common import table

    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = {
    "op2_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, row_n, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM (SELECT doc_id, row_n, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos
                  FROM (SELECT doc_id, row_number() OVER () AS row_n, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
        ), bad AS (
            SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
        ), judged AS (
            SELECT lines.*, bad.k IS NOT NULL AND lines.doc_id <> bad.keeper AS gone FROM lines LEFT JOIN bad ON lines.k = bad.k
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id, row_n
    """,
}
