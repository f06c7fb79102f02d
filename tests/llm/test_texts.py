import os
import random
import sys

import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute

from tesserae.llm import byte_bpe, line_dedup, simhash, substring_dedup, token_counts

DOCS = "doc_id long, text string, extra string, n_lines string, h1 string"
ODD = [
    None, "", " ", "\n", "a", "\n\n\n", "Hello  world, it's 42!!", "  \t x　y \x1c z \x85 w​", "naïve ÉTÉ é", "漢字かな交じり文 テスト",
    "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>c", "'s 't're'VE don't", "x" * 5000, "ab" * 3000 + " " * 300 + "\n" * 50, "🙂🙃 \U0001f468‍\U0001f469",
    "1234567890" * 40, "\r\n\r\n windows\r\n", "٣٤٥ ½ Ⅷ", "ábc̈",
]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "kept", None) for d, t in rows], DOCS)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def odd_rows():
    rng = random.Random(3)
    chars = "abc  \n\t'é漢🙂1½.,!?  \x1f\r"
    return list(enumerate(ODD)) + [(None, "no id"), (3, "\n"), (3, "other")] + [(100 + i, "".join(rng.choices(chars, k=rng.randint(0, 80)))) for i in range(200)]


def test_token_counts_match_the_library(spark, docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = odd_rows() + docs
    out = token_counts.count_tokens(frame(spark, rows), open(path, encoding="utf-8").read(), public_tokenizers.PATTERN)
    want = [(d, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for d, t in rows]
    assert got(out) == sorted(want, key=repr)


def test_codec_matches_the_library(spark, docs):
    import tiktoken

    content = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()
    ranks = byte_bpe.read_ranks(content)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = odd_rows() + docs
    out = byte_bpe.encode_documents(frame(spark, rows), content, public_tokenizers.PATTERN, keep_ids=True)
    want = []
    for d, t in rows:
        ids = library.encode_ordinary(t or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((d, len(ids), brute.sha(packed), brute.sha((t or "").encode()), ids))
    assert got(out) == sorted(want, key=repr)


def test_perfect_hash_is_minimal_and_exact():
    keys = [f"k{i}".encode() for i in range(5000)]
    whole = byte_bpe.PerfectHash(keys)
    assert sorted(whole.find(k) for k in keys) == list(range(5000))
    assert all(whole.find(b"x" + k) == -1 for k in keys)
    assert byte_bpe.PerfectHash([]).find(b"a") == -1
    assert byte_bpe.PerfectHash([b"a"]).find(b"a") == 0


def line_rows():
    long = "This Line is Long enough to be judged, É it is"
    rows = [(i, f"{'  ' if i % 2 else ''}{long.upper() if i % 3 else long}\nown {i}\n{long}\t") for i in range(6)]
    return rows + [(4, "again " + long), (5, long), (None, long + "\n\nx"), (None, None), (7, ""), (8, "\n"), (9, long[:39])]


def test_line_dedup_matches_brute_force(spark, docs):
    for rows in (docs, [r for r in line_rows() if r[0] is not None], []):
        out = line_dedup.dedup_lines(frame(spark, rows))
        assert out.columns == ["doc_id", "text", "extra", "h1", "n_lines", "n_dropped"]
        have = sorted(((r.doc_id, r.n_lines, r.n_dropped, brute.sha(r.text)) for r in out.collect()), key=repr)
        assert have == sorted(brute.line_dedup(rows), key=repr)


def test_line_dedup_stays_in_the_jvm_with_odd_keys(spark):
    """No worker process holds texts beside the executor's heap; only the six ASCII blanks are stripped, only A-Z lower-cased, lengths are code points."""
    base = ["k" * 40, "É" * 39, "É" * 40, "🙂" * 40, "🙂" * 39, "K" * 20 + "\u212a" * 20, "İI" * 20, "\xa0" + "n" * 39, "\x1c" + "c" * 39, "\x85" * 45, "mid \t\x0b dle " * 5, "\0" * 41]
    dress = [lambda x: x, str.lower, lambda x: x + "\x0b\x0c\r", lambda x: " \t " + x.translate(brute.LOWER), lambda x: x + " " * 50, lambda x: "\x0c" + x + "\xa0"]
    rng, rows = random.Random(9), []
    for i in range(30):
        lines = [rng.choice(dress)(rng.choice(base)) for _ in range(rng.randint(0, 12))] + [" " * 60] * rng.randint(0, 2)
        rows.append((i, "\n".join(lines)))
    out = line_dedup.dedup_lines(frame(spark, rows))
    assert not [x for x in ("Arrow", "Python", "Pandas") if x in out._jdf.queryExecution().executedPlan().toString()]
    have = sorted((r.doc_id, r.n_lines, r.n_dropped, brute.sha(r.text)) for r in out.collect())
    assert have == sorted(brute.line_dedup(rows)) and sum(r[2] for r in have) > 20


def test_line_dedup_takes_null_ids_as_one_document_below_all_others(spark):
    rows = line_rows()
    have = sorted(((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, brute.sha(r.text)) for r in line_dedup.dedup_lines(frame(spark, rows)).collect()), key=repr)
    assert have == sorted(brute.line_dedup([(-1 if d is None else d, t) for d, t in rows]), key=repr)


def near_rows():
    rng = random.Random(5)
    words = ["w%d" % i for i in range(50)]
    rows = odd_rows() + [(2000, None), (None, None)]
    for i in range(40):
        text = rng.choices(words, k=rng.randint(1, 400))
        rows.append((300 + 10 * i, " ".join(text)))
        for j in range(rng.randint(0, 5)):
            text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((300 + 10 * i + 1 + j, " ".join(text)))
    return rows


@pytest.mark.parametrize("cell_most", [20_000, 3])
def test_simhash_matches_brute_force(spark, docs, cell_most, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 40)  # a tree of several levels
    for rows in (near_rows() + docs[:150], []):
        assert got(simhash.near_duplicates(frame(spark, rows), cell_most=cell_most)) == sorted(brute.simhash(rows), key=repr)


def test_one_document_of_each_component_stays(spark):
    rows = [(i, t) for i, (d, t) in enumerate(near_rows())]
    out = simhash.keep_representatives(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "extra", "n_lines", "h1"]
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, _, c in brute.simhash(rows) if d == c)


def window_rows(window):
    rng = random.Random(9)
    words = ["a", "b", "B", "é", "漢"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(60)]
    passage = " ".join(f"p{i}" for i in range(window + 5))
    rows += [(100, f"x {passage}\ty"), (101, f"z\n{passage}"), (102, passage + " " + passage), (103, "r " * 100), (104, "r s " * 60), (105, None), (106, ""), (107, "")]
    return rows + [(None, passage), (108, rows[3][1]), (108, rows[3][1]), (109, "q " * window), (110, "u " * (window - 1))]


@pytest.mark.parametrize("window,start", [(35, 9), (35, 18), (35, 35), (6, 2), (5, 1), (1, 1)])
def test_substring_dedup_matches_brute_force(spark, docs, window, start):
    rows = window_rows(window) + (docs if window > 6 else [])
    out = substring_dedup.dedup_substrings(frame(spark, rows), window, start)
    have = [(r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in out.collect()]
    assert sorted(have, key=repr) == sorted(brute.substring_dedup(rows, window), key=repr)


def test_substring_dedup_with_a_hot_text(spark):
    rows = [(i, "h " * 50) for i in range(500)] + [(None, "h " * 50)] * 3 + [(1000 + i, f"{i} " * 40) for i in range(20)]
    out = substring_dedup.dedup_substrings(frame(spark, rows))
    have = [(r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in out.collect()]
    assert sorted(have, key=repr) == sorted(brute.substring_dedup(rows), key=repr)
    assert substring_dedup.dedup_substrings(frame(spark, [])).count() == 0
