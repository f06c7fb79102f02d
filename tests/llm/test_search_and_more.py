import gzip
import io
import math
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute
from test_shingles import plain_components

from tesserae.llm import language_id, mixing, topk, vp_search, warc

VECTORS = "vec_id long, embedding array<float>, label int, id string, v string, code string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None, "x", "y", "z") for i, v in rows], VECTORS)


def vector_rows(n=300, dim=40):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, dim))
    rows = [(i, [float(x) for x in (centres[i % 6] + rng.normal(size=dim) * 0.6).astype(np.float32)]) for i in range(n)]
    same = rows[7][1]
    rows += [(n + i, same) for i in range(40)] + [(n + 50, [2 * x for x in same])]
    nan, inf = float("nan"), float("inf")
    return rows + [(n + 60, None), (n + 61, []), (n + 62, [0.0] * dim), (n + 63, [nan] * dim), (n + 64, [inf] + [1.0] * (dim - 1)), (n + 65, [None] + [1.0] * (dim - 1)), (None, same), (n + 66, [1.0, 2.0]), (5, rows[5][1])]


def usable(rows, zero=True):
    out = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))}
    return sorted(out)


@pytest.mark.parametrize("k", [1, 5, 1000])
def test_top_k_matches_brute_force(spark, k):
    rows = vector_rows() if k < 1000 else vector_rows(20, 40)[:30]
    codes = topk.sign_codes(vectors(spark, rows), "vec_id", "embedding")
    have = sorted(tuple(r) for r in topk.top_k(codes, codes.filter("id % 20 = 0"), k).collect())
    want, held = [], usable(rows)
    for q, a in held:
        if q % 20 == 0:
            found = sorted({(sum((x > 0) != (y > 0) for x, y in zip(a, b, strict=True)), i) for i, b in held if i != q and len(a) == len(b)})
            want += [(q, n + 1, i, d) for n, (d, i) in enumerate(found[:k])]
    assert have == sorted(want)


def test_top_k_of_nothing(spark):
    empty = topk.sign_codes(vectors(spark, []), "vec_id", "embedding")
    assert topk.top_k(empty, empty).count() == 0


def brute_nearest(rows, k):
    out, held = {}, usable(rows, zero=False)
    for q, a in held:
        if q % 10 == 0:
            a = np.array(a)
            found = [(-float((np.array(b) * a).sum() / (np.sqrt((np.array(b) ** 2).sum()) * np.sqrt((a * a).sum()))), i) for i, b in held if i != q and len(b) == len(a)]
            out[q] = sorted(found)[:k]
    return out


@pytest.mark.parametrize("shard", [50, 10_000])
def test_vantage_point_search_is_exact_at_factor_one_and_near_it_below(spark, shard):
    rows = vector_rows()
    want = brute_nearest(rows, 5)
    for relax, least in ((1.0, 1.0), (0.6, 0.9)):
        df = vectors(spark, rows)
        have = {}
        for r in vp_search.nearest(df, df.filter("vec_id % 10 = 0"), relax=relax, shard=shard, block=20).collect():
            have.setdefault(r.query_id, {})[r.rank] = (-r.score, r.vec_id)
        # a vector and its multiples have equal cosines up to rounding: compare scores
        hit = total = 0
        for q, best in want.items():
            assert sorted(have.get(q, {})) == list(range(1, len(best) + 1))
            hit += sum(have[q][n + 1][0] <= s + 1e-12 for n, (s, _) in enumerate(best))
            total += len(best)
        assert hit >= least * total
    assert vp_search.nearest(vectors(spark, []), vectors(spark, [])).count() == 0


def test_vantage_point_recall_on_the_embeddings(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = {q: {i for _, i in best} for q, best in ((q, b) for q, b in brute_nearest(rows, 5).items() if q % 50 == 0)}
    have = {}
    for r in vp_search.nearest(df, df.filter("vec_id % 50 = 0")).collect():
        have.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(want[q] & have[q]) for q in want) >= 0.9 * sum(map(len, want.values()))


def exact_viterbi(scores, penalty):
    value, back = scores[0].copy(), []
    for row in scores[1:]:
        step = value[:, None] - penalty * (1 - np.eye(len(row)))
        back.append(step.argmax(axis=0))
        value = step.max(axis=0) + row
    return value.max()


def worth(scores, labels, penalty):
    return scores[np.arange(len(labels)), labels].sum() - penalty * (np.diff(labels) != 0).sum()


def test_viterbi_finds_a_best_path():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n, k = rng.integers(1, 30), rng.integers(1, 5)
        scores, penalty = -rng.random((n, k)) * 4, float(rng.random() * 6)
        assert worth(scores, language_id.viterbi(scores, penalty), penalty) == pytest.approx(exact_viterbi(scores, penalty))


def test_spans_of_mixed_text(spark):
    english = "the house and the river were there with the other things that they had"
    german = "das haus und der fluss waren dort mit den anderen dingen die sie hatten"
    russian = "дом и река были там"
    learned = [(i, english, "en") for i in range(5)] + [(10 + i, german, "de") for i in range(5)] + [(20, russian, "ru"), (21, None, "fr"), (22, "x", None)]
    model = language_id.learn(spark.createDataFrame(learned, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en", "ru"]
    rows = [(1, f"{english} {english} 12 {german} {german} {russian}"), (2, None), (3, "12 !"), (4, ""), (None, german), (5, "漢字"), (5, "漢字")]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, score string, `0` int")
    out = language_id.identify(df, model, spans=True)
    assert out.columns == ["doc_id", "text", "0", "lang_pred", "score", "lang_spans"]
    have = {r.text: r for r in out.collect()}
    words = len(english.split())
    spans = [(s.lang, s.first, s.words) for s in have[rows[0][1]].lang_spans]
    assert [s[0] for s in spans] == ["en", "de", "ru"] and abs(spans[1][1] - 2 * words) <= 1 and spans[2][2] == 5
    assert [have[t].lang_pred for t in (None, "12 !", "", german)] == ["und", "und", "und", "de"]
    assert have["漢字"].score == 0 and have["漢字"].lang_pred == "en" and out.count() == 7
    nothing = language_id.learn(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {(r.lang_pred, r.score) for r in language_id.identify(df, nothing).collect()} == {("und", 0.0)}


def test_held_out_accuracy(spark, sf_dir):
    out = language_id.op5_language_id(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = out.filter("held_out").join(docs, "doc_id").filter("lang is not null").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def page_rows():
    return [(5, "http://a/x y\r\nz", "<p>same</p>"), (3, None, "<p>same</p>"), (9, "u", "<p>é漢</p>" * 9000), (4, "v", None), (6, "v", ""), (None, "w", "<p>same</p>"), (None, "w", "alone"), (3, "again", "<p>same</p>"), (8, "z", "x\r\n\r\ny")]


def test_archives_come_back_whole(spark, tmp_path):
    rows = page_rows()
    df = spark.createDataFrame([(i, u, h, "extra", "z") for i, u, h in rows], "page_id long, url string, html string, first string, sha string")
    manifest = warc.write_warc(df, str(tmp_path / "w"), roll=2000)
    assert sum(r.records for r in manifest.collect()) == len(rows)
    have = warc.read_warc(manifest).collect()
    assert len(have) == len(rows)
    full = sorted(((r.record_id, r.record_type, bytes(r.payload) if r.payload is not None else None, r.refers_to, r.payload_bytes, r.payload_digest) for r in have), key=repr)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        least = min((j for j, _, g in rows if (g or "") == (h or "") and j is not None), default=None)
        again = least is not None and i != least
        want.append((f"urn:page:{'' if i is None else i}", "revisit" if again else "response", None if again else data, f"urn:page:{least}" if again else None, len(data), warc.sha1_base32(data)))
    assert full == sorted(want, key=repr)
    large = warc.read_warc(warc.write_warc(df, str(tmp_path / "v"), min_bytes=100)).collect()
    assert {r.record_type for r in large} == {"response"}
    assert warc.read_warc(warc.write_warc(df.limit(0), str(tmp_path / "n"))).count() == 0


def test_damaged_archives_are_errors():
    good = warc.record_bytes("urn:page:1", "u", b"payload" * 100, None, "2024-01-01T00:00:00Z", 6)
    assert len(list(warc.read_records(io.BytesIO(good * 3)))) == 3
    plain = gzip.decompress(good)
    bad = [good[:-20], b"junk" + good, gzip.compress(plain[:-2]), gzip.compress(plain.replace(b"payload", b"Payload", 1)), gzip.compress(plain + b"more"), gzip.compress(plain.replace(b"WARC/1.1", b"XXXX")), gzip.compress(b"WARC/1.1\r\n")]
    for data in bad:
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(data)))


def mixing_rows():
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 40), "hot" if i % 2 else f"s{i % 7}") for i in range(400)]
    return rows + [(1000, None, None), (1001, "a b", None), (None, "c d e", "s1"), (1002, "", "blank"), (1003, None, "blank"), (7, rows[7][1], "hot")]


def test_weights_meet_their_targets():
    tokens = {"a": 800, "b": 150, "c": 40, "d": 10, None: 0}
    for share in (0.6, 0.8, 0.95, 1.0):
        w = mixing.tempered(tokens, mixing.bisect_exponent(tokens, target_entropy=share))
        assert mixing.entropy(w) == pytest.approx(max(share * math.log(4), mixing.entropy(mixing.tempered(tokens, 1))), abs=1e-6)
    w = mixing.tempered(tokens, mixing.bisect_exponent(tokens, max_repetition=3, budget=1000))
    assert mixing.repetition(tokens, w, 1000) == pytest.approx(3, abs=1e-6)
    both = mixing.bisect_exponent(tokens, target_entropy=1.0, max_repetition=3, budget=1000)
    assert mixing.tempered(tokens, both) == w
    assert mixing.bisect_exponent({}) == 1.0 and mixing.tempered({}, 0.5) == {} and sum(mixing.tempered(tokens, 0.3).values()) == pytest.approx(1)


@pytest.mark.parametrize("budget", [None, 3000.0])
def test_budgets_are_spent_on_permuted_blocks(spark, budget):
    rows = mixing_rows()
    df = spark.createDataFrame([(i, t, s, "m", "e") for i, t, s in rows], "doc_id long, text string, source string, mix_epoch string, s string")
    out = mixing.mix_sources(df, budget=budget, block=20)
    assert out.columns == ["doc_id", "text", "source", "s", "mix_epoch", "mix_block", "mix_order"]
    have = out.collect()
    count = lambda t: len((t or "").split())
    tokens = {}
    for _, t, s in rows:
        tokens[s] = tokens.get(s, 0) + count(t)
    weights = mixing.tempered(tokens, mixing.bisect_exponent(tokens, 0.95, 2.0, budget))
    spent = budget or max(t / weights[s] for s, t in tokens.items() if t)
    longest = max(count(t) for _, t, _ in rows)
    for s, t in tokens.items():
        own = sorted((r for r in have if r.source == s), key=lambda r: (r.mix_epoch, r.mix_block, r.mix_order, repr(r.doc_id)))
        used = sum(count(r.text) for r in own)
        if not t:
            assert sorted(r.doc_id for r in own) == sorted(i for i, _, x in rows if x == s)
            continue
        assert weights[s] * spent - 1e-6 <= used <= weights[s] * spent + 2 * longest
        whole = int(weights[s] * spent / t + 1e-9)
        for e in range(whole):
            assert sorted(repr((r.doc_id, r.text)) for r in own if r.mix_epoch == e) == sorted(repr((i, x)) for i, x, y in rows if y == s)
        before = 0  # in the order given, the last pass stops where its budget is spent
        for r in (r for r in own if r.mix_epoch == whole):
            assert before < weights[s] * spent - whole * t + longest
            before += count(r.text)
    if budget is None:
        assert {r.doc_id for r in have} == {i for i, _, _ in rows}
        orders = [[r.doc_id for r in sorted((r for r in have if r.source == "s0" and r.mix_epoch == e), key=lambda r: (r.mix_block, r.mix_order))] for e in (0, 1)]
        assert orders[0][: len(orders[1])] != orders[1] or not orders[1]
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(150)
    odd = [(10_000, None, None, "src1", None), (10_001, "", "en", None, 0), (10_002, "12 34", "en", "src1", 5), (None, "no id here at all", "en", "src1", 3)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).cache()
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, sf_dir)
        after = out.collect()
        if name != "byte_bpe":
            assert out.columns == docs.columns
        if name == "language_id":
            assert sorted((r.doc_id, r.text) for r in after if r.doc_id is not None) == sorted(x for x in before if x[0] not in (None, 10_000, 10_001, 10_002))
        elif name == "line_dedup":
            want = sorted(brute.line_dedup([(-1 if d is None else d, t) for d, t in before]))
            assert sorted((-1 if r.doc_id is None else r.doc_id, brute.sha(r.text)) for r in after) == [(w[0], w[3]) for w in want]
        elif name == "simhash_near_dedup":
            # a stage on word shingles: five words, a similarity of 0.8 or more
            assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(d for d, c in plain_components(before) if d == c and d is not None)
        elif name == "mixing":
            assert {r.doc_id for r in after} == {d for d, _ in before}
        else:
            assert sorted(repr(r.doc_id) for r in after) == sorted(repr(d) for d, _ in before)
            by_text = {(d, brute.sha(t or "")) for d, t in before}
            assert {(r.doc_id, r.decoded_sha256) for r in after} == by_text and all(len(r.ids) == r.n_tokens for r in after)
        docs = spark.createDataFrame(after, out.schema)
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
