"""Ids that repeat with other contents, and bytes that are no text."""

import math
import os
import sys

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute

from tesserae.llm import line_dedup, vp_search


def test_ids_with_several_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i % 70, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(200)]
    rows += [(5, [x * (1 + j / 100) for x in rows[0][1]]) for j in range(9)]  # many near one query, under one id
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = []
    for q in range(0, 70, 10):
        best = {}
        for i, a in rows:
            for j, b in rows:
                if i == q != j:
                    score = sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
                    best[j] = max(best.get(j, -2), score)
        order = sorted(best, key=lambda j: (-best[j], j))[:5]
        want += [(q, n + 1, j, round(best[j], 9)) for n, j in enumerate(order)]
    for shard in (vp_search.SHARD, 16):
        found = vp_search.nearest(df, df.filter("vec_id % 10 = 0"), k=5, relax=1.0, shard=shard)
        assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in found.collect()) == want


def test_lines_with_bytes_that_are_no_text(spark):
    line = "a line that many documents share, long enough to be judged"
    rows = [(i, f"{line}\nown {i}".encode()) for i in range(5)] + [(9, b"\x61\xff\x62\n" + line.encode()), (10, b"\xff" * 50), (11, None)]
    df = spark.createDataFrame([(i, None if t is None else bytearray(t)) for i, t in rows], "doc_id long, b binary").select("doc_id", F.col("b").cast("string").alias("text"))
    have = sorted((r.doc_id, r.n_lines, r.n_dropped, brute.sha(r.text)) for r in line_dedup.dedup_lines(df).collect())
    # the replacement of a bad byte, as Python makes it
    assert have == sorted(brute.line_dedup([(i, None if t is None else t.decode(errors="replace")) for i, t in rows]))


def test_dense_fingerprints_at_any_radius(spark):
    from tesserae.llm import simhash
    from tesserae.llm._common import components

    rng = np.random.default_rng(6)
    base = rng.integers(-(2**63), 2**63, 3, dtype=np.int64)
    fps = sorted({int(b ^ np.int64(rng.integers(0, 2**14))) for b in base for _ in range(400)})  # so close that no pivot parts them
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for radius in (3, 1):
        links = components(simhash.link_fingerprints(df, radius, cell_most=150))
        have = {r.node: r.root for r in links.collect()}
        pairs = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if bin((a ^ b) & (2**64 - 1)).count("1") <= radius]
        want = {x: x for x in fps}
        for a, b in pairs:
            low, high = sorted((want[a], want[b]))
            if low != high:
                want = {x: low if r == high else r for x, r in want.items()}
        assert {x: have.get(x, x) for x in fps} == want


def test_columns_carried_beside_ids(spark):
    import public_tokenizers

    from tesserae.llm import byte_bpe

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    df = spark.createDataFrame([(1, "a text", "x", 2.5), (2, None, None, None)], "doc_id long, text string, `a.b` string, n double")
    out = byte_bpe.encode_documents(df, ranks, public_tokenizers.PATTERN, keep_ids=True, carry=("a.b", "n"))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "a.b", "n"]
    assert sorted((r[0], r[1], r[5], r[6]) for r in out.collect()) == [(1, 2, "x", 2.5), (2, 0, None, None)]


def test_a_sample_bounded_by_characters(spark):
    from tesserae.llm import language_id

    rows = [(i, "the house and the river " * 50, "en") for i in range(20)] + [(100 + i, "das haus und der fluss " * 50, "de") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few = language_id.learn(df, sample_chars=10)  # one text of each language
    many = language_id.learn(df)
    assert sorted(few.languages) == sorted(many.languages) == ["de", "en"]
    told = {r.doc_id: r.lang_pred for r in language_id.identify(df, few).collect()}
    assert told == {i: lang for i, _, lang in rows}
    narrow = language_id.Labeller(many, 12.0, most_bytes=80)
    assert narrow.entries == 10 and [narrow.label(t)[0] for _, t, _ in rows] == [lang for *_, lang in rows]
