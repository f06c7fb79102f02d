"""Empty tables, very long texts, clashing names, bounds and stores; SQL of this subpackage against DuckDB."""

import types

import brute
import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tesserae.llm import _common, byte_bpe, language_id, line_dedup, mixing, queries, simhash, substring_dedup, token_counts, topk, vp_search, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def vocabulary():
    return open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()


def rank_file():
    return open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()


def some_model(spark):
    rows = [(i, "the house and the river", "en") for i in range(5)] + [(10 + i, "das haus und der fluss", "de") for i in range(5)]
    return language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert token_counts.count_tokens(empty, vocabulary(), public_tokenizers.PATTERN).count() == 0
    assert byte_bpe.encode_documents(empty, rank_file(), public_tokenizers.PATTERN).count() == 0
    assert language_id.identify(empty, some_model(spark), spans=True).count() == 0
    assert simhash.keep_representatives(empty).count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0 and substring_dedup.dedup_substrings(empty).count() == 0 and mixing.mix_sources(empty).count() == 0


def test_the_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_texts_of_megabytes(spark):
    import tiktoken
    from tokenizers import Tokenizer

    long = "".join(f"the house {i % 977} and\tthe river {'x' * (i % 50)}\n" for i in range(100_000))
    one_word = "é" * 1_500_000
    rows = [(1, long), (2, one_word), (3, "short\n" + "the house and the river, " * 20)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    have = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, vocabulary(), public_tokenizers.PATTERN).collect()}
    assert have == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows}
    ranks = byte_bpe.read_ranks(rank_file())
    codec = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    some = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in byte_bpe.encode_documents(df.filter("doc_id <> 2"), rank_file(), public_tokenizers.PATTERN).collect()}
    assert some == {i: (len(codec.encode_ordinary(t)), brute.sha(t)) for i, t in rows if i != 2}
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, brute.sha(r.text)) for r in line_dedup.dedup_lines(df).collect()) == sorted(brute.line_dedup(rows))
    assert sorted((r.doc_id, r.fingerprint) for r in simhash.near_duplicates(df).collect()) == sorted((i, f"{brute.fingerprint(t):016x}") for i, t in rows)
    assert sorted((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in substring_dedup.dedup_substrings(df).collect()) == sorted(brute.substring_dedup(rows))
    labels = {r.doc_id: r for r in language_id.identify(df, some_model(spark)).collect()}
    assert labels[1].lang_pred == labels[3].lang_pred == "en" and labels[1].score > 0.9
    pages = spark.createDataFrame([(i, "u", t) for i, t in rows], "page_id long, url string, html string")
    assert sum(r.payload_bytes for r in warc.read_warc(warc.write_warc(pages, _common.shared_folder(spark) + "/long"), payloads=False).collect()) == sum(len(t.encode()) for _, t in rows)


def test_words_in_parts_are_the_words():
    text = "a bb  ccc\td\n" * 50 + "x" * 40 + " end\x1c\u2003z "
    for size in (1, 7, 64, 10_000):
        assert [w for part in language_id.words_in_parts(text, size) for w in part] == text.split()
    assert list(language_id.words_in_parts("")) == []


def test_a_long_sequence_is_labelled_in_steps():
    import numpy as np

    rng = np.random.default_rng(8)
    for _ in range(50):
        scores = -rng.random((rng.integers(1, 60), rng.integers(2, 12))) * 5
        whole = language_id.viterbi(scores, 3.0)
        at = np.arange(len(scores))
        assert (language_id.viterbi(scores, 3.0, at, step=7) == whole).all()


def test_names_that_differ_by_case_are_replaced(spark):
    df = spark.createDataFrame([(1, "the house", "en", "s", 9, "z", "z", "z", "z")], DOCS + ", N_DROPPED string, Score string, MIX_EPOCH string, Lang_Pred string")
    assert line_dedup.dedup_lines(df).select("n_dropped").first()[0] == 0
    assert language_id.identify(df, some_model(spark)).select("score", "lang_pred").first()[1] == "en"
    assert mixing.mix_sources(df).select("mix_epoch").first()[0] == 0


def test_no_folder_of_one_machine_on_a_cluster():
    context = types.SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    spark = types.SimpleNamespace(sparkContext=context, conf=types.SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        _common.shared_folder(spark)


def test_names_of_stores():
    pairs = {"/a/b": "/a/b", "file:/a/b": "/a/b", "file:///a/b": "/a/b", "dbfs:/a/b": "/dbfs/a/b", "s3a://bucket/a": "s3://bucket/a", "s3n://bucket/a": "s3://bucket/a", "s3://bucket/a": "s3://bucket/a", "hdfs://host:9000/a": "hdfs://host:9000/a", "gs://bucket/a": "gs://bucket/a", "abfss://c@h/a": "abfss://c@h/a", "wasbs://c@h/a": "abfss://c@h/a"}
    assert {k: warc.arrow_uri(k) for k in pairs} == pairs


@pytest.mark.parametrize("remembered", [4, 1 << 20])
def test_substring_dedup_in_small_batches(spark, remembered):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"a{i} b{i} {passage if i % 3 else ''} c{i} " + " ".join(f"{i}w{j}" for j in range(40))) for i in range(90)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        out = substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), remembered=remembered).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in out) == sorted(brute.substring_dedup(rows))


def test_a_hot_window_has_few_rows_in_a_task(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, i, f"a{i} {passage}") for i in range(90)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        level = substring_dedup.level_rows(spark.createDataFrame(rows, "t1 long, t2 long, text string").coalesce(1), 35, 35).groupBy("h1", "h2").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert level <= 2  # 30 batches


@pytest.mark.parametrize("options", [{}, {"gap_closed": 0.5, "max_repetition": None}, {"gap_closed": 0.7, "max_repetition": 1.5}, {"budget": 9000.0, "max_repetition": 3.0}, {"target_entropy": None}])
def test_any_number_of_sources(spark, options):
    rows = [(i, "w " * (1 + i % 17), f"s{(i * i) % 13 if i % 3 else 0}") for i in range(500)] + [(1000, "", "none"), (1001, "a b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    have = [sorted(map(repr, mixing.mix_sources(df, block=10, collected=n, **options).collect())) for n in (100, 2)]
    assert have[0] == have[1] and len(have[0]) > 100


def test_the_order_is_the_one_that_brute_force_realises(spark):
    """The documents of each pass in the order of hashed blocks and documents, until the budget is spent."""
    rows = [(i, f"t{i} " * (1 + i % 23), f"s{i % 3 if i % 5 else 0}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    block, tokens, count = 20, {}, {}
    for _, t, s in rows:
        tokens[s], count[s] = tokens.get(s, 0) + len(t.split()), count.get(s, 0) + 1
    share = mixing.toward_even_target(mixing.entropy(mixing.tempered(tokens, 1)), 3, 0.5)
    exponent = mixing.bisect_exponent(tokens, share, 2.0)
    weights = mixing.tempered(tokens, exponent)
    spent = mixing.passes_needed(tokens, weights)
    assert exponent < 1
    hashed = df.crossJoin(spark.range(3).select(F.col("id").cast("int").alias("e"))).select("doc_id", "e", F.col("source").alias("s"), F.xxhash64("text").alias("own"))
    blocks = F.create_map(*[F.lit(x) for s, n in count.items() for x in (s, -(-n // block))])[F.col("s")]
    hashed = hashed.withColumn("b", F.pmod(F.xxhash64(F.lit(0), "doc_id", "own"), blocks.cast("long")))
    hashed = hashed.select("doc_id", "e", "s", F.xxhash64(F.lit(0), "e", "s", "b").alias("x"), F.xxhash64(F.lit(0), "e", "doc_id", "own").alias("y")).collect()
    words = {d: len(t.split()) for d, t, _ in rows}
    want = []
    for s in tokens:
        left = weights[s] * spent
        for e in range(3):
            for r in sorted((r for r in hashed if r.s == s and r.e == e), key=lambda r: (r.x, r.y, r.doc_id)):
                if left > 1e-6:
                    want.append((r.doc_id, e, r.x, r.y))
                left -= words[r.doc_id]
    have = mixing.mix_sources(df, block=block, gap_closed=0.5).select("doc_id", "mix_epoch", "mix_block", "mix_order").collect()
    assert sorted(map(tuple, have)) == sorted(want)


def test_segments_follow_the_number_of_codes(spark, sf_dir):
    assert [topk.segment_bits(n) for n in (0, 1, 500, 50_000, 300_000, 10**6, 10**9)] == [16, 16, 16, 16, 18, 20, 20]
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = []
    for width in (8, 13, 20):
        codes = topk.sign_codes(vectors, "vec_id", "embedding", width)
        found.append(sorted(map(tuple, topk.top_k(codes, codes.filter("id % 100 = 0"), width=width).collect())))
    assert found[0] == found[1] == found[2]


def test_router_bounds_hold():
    import numpy as np

    rng = np.random.default_rng(3)
    unit = vp_search.unit_rows(rng.normal(size=(600, 8)) + 3 * rng.normal(size=(6, 8))[rng.integers(6, size=600)])
    router = vp_search.Router(unit[:300], 8)
    cell, bound = router.cell_of(unit), router.bounds(unit[:50])
    assert router.cells == 8 and set(cell) <= set(range(8))
    real = np.sqrt(np.maximum(0, 2 - 2 * unit[:50] @ unit.T))
    assert (bound[:, cell] <= real + 1e-9).all()


@pytest.mark.parametrize("name", sorted(line_dedup.SQL | topk.SQL | warc.SQL | substring_dedup.SQL))
def test_query_against_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    found = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    df = queries.queries()[name](spark, sf_dir)
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, found.fetchall()))
