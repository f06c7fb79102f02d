"""Prefix tries, sort-means and token stores against plain versions."""

import glob
import hashlib
import math
import os
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from tesserae.llm import prefix_trie, scans, sort_means, token_store

TURNS = "conv_id long, turn long, role string, text string, conv string, place int, a string, rank int, depth string"
DOCS = "doc_id long, text string, ids string, row int, digest string, file string, n_tokens string"


@pytest.fixture(params=[True, False])
def whole_and_split(spark, request):
    """Small tables in one part, and in as many parts as there are."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(request.param).lower())
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def plain_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, held in members.items():
        below = [x for x in members if x[: len(node)] == node]
        leaves = [x for x in below if not any(y[:-1] == x for y in below if y)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = sorted(c for c in held if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        children = [x for x in members if x and x[:-1] == node]
        out.append((min(held), len(node), parent, len(held), len(children), len(leaves), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def trie_of(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "y", 2, "z") for r in rows], TURNS)
    turns, convs = prefix_trie.open_alike(prefix_trie.turns_of(df))
    nodes, ends = prefix_trie.prefix_trie(turns, convs)
    out = nodes.join(prefix_trie.digest_of_ends(ends), prefix_trie.NODE, "left").collect()
    nothing = hashlib.sha256(b"").hexdigest()
    return out, sorted([(r.conv, r.depth, r.parent_conv, r.n_convs, r.n_children, r.n_leaves, r.saved, r.ends_sha256 or nothing) for r in out], key=repr)


def trie_rows():
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 12), *range(95, 115), 300, 305, 306, 999, -3, -101, 1 << 40]:
        for t in range(rng.randrange(0, 9)):
            rows.append((c, t, "user" if t % 2 else "assistant", rng.choice("ab") * rng.randrange(1, 3)))
    rows += [(7, None, None, "first"), (7, 3, None, None), (7, 3, "", ""), (8, 1, "user", "é漢𝄞"), (8, 1, "user", "é漢𝄞"), (None, 1, "user", "nobody")]
    rows += [(400, t, "user", f"{t}") for t in range(40)] + [(401, t, "user", f"{t}") for t in range(25)]
    return rows


def test_trie_matches_plain_version(spark, whole_and_split):
    rows = trie_rows()
    nodes, have = trie_of(spark, rows)
    assert have == plain_trie(rows)
    # the intervals: positions are a permutation, and a node's interval holds as many nodes as its subtree
    by_place = {r.position: r for r in nodes}
    assert sorted(by_place) == list(range(1, len(nodes) + 1))
    for r in nodes:
        inside = [by_place[p] for p in range(r.position, r.subtree_end + 1)]
        assert all(x.depth > r.depth for x in inside[1:]) and sum(x.n_children == 0 for x in inside) == r.n_leaves


def test_trie_of_one_long_conversation_and_of_many_copies(spark):
    rows = [(100, t, "user", f"turn {t % 7}") for t in range(900)] + [(200 + i, t, "user", "same") for i in range(250) for t in range(3)]
    _, have = trie_of(spark, rows)
    held = plain_trie_of_depths(rows)
    assert {(r[0], r[1]): r[3] for r in have} == held
    root = [r for r in have if r[1] == 0][0]
    assert root[3] == 251 and root[5] == sum(r[4] == 0 for r in have)


def plain_trie_of_depths(rows):
    """(smallest member, depth) -> members, without the subtrees."""
    own = {}
    for c, t, role, text in rows:
        own.setdefault(c, []).append((role, text))
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        turns = own.get(c - c % 100, [])[:h] + turns[h:]
        state = ()
        for d in range(len(turns) + 1):
            state = hash((state, turns[d - 1])) if d else ()
            members.setdefault((d, state), []).append(c)
    return {(min(v), d): len(v) for (d, _), v in members.items()}


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert trie_of(spark, [])[1] == []
    alone = [(5, 0, None, None)]  # its opening is another's, which is absent
    assert trie_of(spark, alone)[1] == plain_trie(alone)


def test_scan_carries_over_parts(spark, whole_and_split):
    rng = random.Random(2)
    rows = [(g, i, rng.randrange(-(2**63), 2**63)) for g in (-4, 0, 3, 4, 9) for i in range(rng.choice((1, 3, 200)))]
    scan = scans.Scan(spark.createDataFrame(rows, "g long, i long, v long"), ["g", "i"], group="g", weigh=lambda index, column: [column("v") * index], sums=("s",))
    have = sorted((r.g, r.i, r["index"], r.s) for r in scan.rows().collect())
    want, upto = [], {}
    for g, i, v in sorted(rows):
        n, s = upto.get(g, (0, 0))
        upto[g] = n, s = n + 1, (s + v * (n + 1)) % 2**64
        want.append((g, i, n, s - 2**64 if s >= 2**63 else s))
    assert have == want


VECTORS = "vec_id long, embedding array<float>, packed string, cluster string, distance double"


def plain_means(rows, k, rounds):
    held = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            x = [math.floor(256 * float(np.float32(c))) for c in v]
            if all(abs(c) < 1 << 27 for c in x):
                held.append((i, x))
    seeds = sorted(held, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))[:k]
    at = [s[1] for s in seeds]
    for n in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(at)) for _, x in held]
        if n < rounds:
            for j in range(len(at)):
                own = [x for (_, x), f in zip(held, found, strict=True) if f[1] == j]
                if own:
                    at[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return sorted([(i, f[1], f[0]) for (i, _), f in zip(held, found, strict=True)], key=repr), at


def mean_rows():
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in (rng.integers(-2, 3, 64) / 4).astype(np.float32)]) for i in range(60)]  # coarse: many ties
    rows += [(i, [float(x) for x in rng.normal(size=64).astype(np.float32)]) for i in range(60, 150)]
    rows += [(200 + i, rows[3][1]) for i in range(70)] + [(3, rows[3][1]), (3, rows[9][1]), (None, rows[5][1])]
    nan, inf = float("nan"), float("inf")
    return rows + [(500, None), (501, []), (502, [1.0] * 63), (503, [nan] * 64), (504, [inf] + [1.0] * 63), (505, [None] + [1.0] * 63), (506, [1e30] + [0.0] * 63), (507, [0.0] * 64)]


@pytest.mark.parametrize("k, rounds", [(40, 5), (3, 2), (1, 1), (400, 1)])
def test_sort_means_matches_plain_version(spark, k, rounds):
    rows = mean_rows()
    df = spark.createDataFrame([(i, v, "x", "y", 1.0) for i, v in rows], VECTORS)
    out, clusters = sort_means.sort_means(df, k=k, rounds=rounds)
    want, at = plain_means(rows, k, rounds)
    have = sorted([tuple(r) for r in out.collect()], key=repr)
    assert have == want and [c["centroid"] for c in clusters] == at
    for c in clusters:
        own = [d for _, j, d in want if j == c["cluster"]]
        assert (c["n"], c["inertia"]) == (len(own), sum(own))


def test_sort_means_of_nothing(spark):
    out, clusters = sort_means.sort_means(spark.createDataFrame([(1, None, "x", "y", 1.0)], VECTORS))
    assert out.count() == 0 and clusters == []


def test_the_order_saves_distances():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (40, 64))
    x = centres[rng.integers(0, 40, 2000)] + rng.integers(-50, 50, (2000, 64))
    order = sort_means.Order(centres)
    first, d, _ = order.nearest(x, np.zeros(2000, np.int64))
    again, d2, measured = order.nearest(x, first)
    assert (first == again).all() and (d == d2).all() and measured == 2000  # nothing lies within twice the distance
    all_ = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (first == all_.argmin(axis=1)).all() and (d == all_.min(axis=1)).all()


def vocabulary():
    return open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()


def store_rows():
    long = "".join(f"the house {i % 977} and\tthe river {'x' * (i % 50)}\n" for i in range(30_000))
    rows = [(i, f"document {i} " * (i % 40)) for i in range(200)]
    return rows + [(300, None), (301, ""), (302, "a <|endoftext|> b"), (303, long), (304, "é漢𝄞\x00"), (None, "nobody's"), (-5, "before all"), (7, rows[7][1]), (7, rows[7][1])]


def stored(spark, rows, folder, **how):
    df = spark.createDataFrame([(i, t, "x", 1, "y", "z", "n") for i, t in rows], DOCS)
    token_store.write_tokens(df, folder, vocabulary(), **how)
    return folder


def plain_store(rows):
    from tokenizers import Tokenizer

    library, at, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, at, len(ids), ids))
        at += len(ids)
    return out


def test_token_store(spark, tmp_path):
    import pyarrow.parquet as pq

    want = plain_store(store_rows())
    folder = stored(spark, store_rows(), f"{tmp_path}/store", files=5, row_group_mb=1, page_rows=20)
    digests = [(i, s, n, zlib.crc32(np.array(ids, "<u4").tobytes())) for i, s, n, ids in want]
    assert sorted(map(tuple, token_store.digest_of_ids(token_store.read_tokens(spark, folder)).collect()), key=repr) == sorted(digests, key=repr)
    files = sorted(glob.glob(f"{folder}/tokens/*.parquet"))
    assert len(files) == 5
    groups = 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        groups += meta.num_row_groups
        columns = {meta.row_group(0).column(j).path_in_schema: meta.row_group(0).column(j) for j in range(meta.num_columns)}
        assert all(c.has_offset_index and c.has_column_index for c in columns.values())
        assert "DELTA_BINARY_PACKED" in columns["first"].encodings and "RLE_DICTIONARY" in columns["ids.list.element"].encodings
    # lengths alone: the ids are not in what is read
    lengths = token_store.read_tokens(spark, folder, ids=False)
    plan = lengths._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema", 1)[1].split("\n")[0]
    assert sorted([r.n_tokens for r in lengths.collect()]) == sorted(n for _, _, n, _ in want)


@pytest.mark.parametrize("begin, end", [(0, 1), (5, 50), (1000, 120_000), (0, 10**9), (10**9, 10**9 + 5)])
def test_a_span_of_the_stream(spark, tmp_path_factory, begin, end):
    folder = str(tmp_path_factory.getbasetemp() / "spans")
    if not os.path.exists(folder):
        stored(spark, store_rows(), folder, files=6, page_rows=20)
    stream = [x for *_, ids in plain_store(store_rows()) for x in ids]
    rows = sorted(token_store.read_span(spark, folder, begin, end).collect(), key=lambda r: r.start)
    assert [x for r in rows for x in r.ids] == stream[begin:end]
    assert all(stream[r.start : r.start + len(r.ids)] == r.ids for r in rows)


def test_words_are_given_to_the_library_once():
    import random

    import pyarrow as pa

    encoder, given = token_store.Encoder(vocabulary(), 0), []
    library = encoder.library

    class Counting:
        def encode_batch_fast(self, texts, **how):
            given.extend(texts)
            return library.encode_batch_fast(texts, **how)

    encoder.library = Counting()
    dice = random.Random(5)
    signs = [*"ab Z09.,'-!\n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u180e\u200b\u2003\u2028\u3000\ufeff«ß×÷éЖя中あ、\u0301½²٣…😀\x00\x7f_", "'s", "'re", " 's", "  ", "\n\n", " a", "ll", "<|endoftext|>"]
    texts = ["".join(dice.choices(signs, k=dice.randint(0, 14))) for _ in range(20_000)] + [None, "", "中" * 500]
    want = [x.ids + [0] for x in library.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
    assert [ids for i in range(0, len(texts), 997) for ids in encoder.encode(pa.array(texts)[i : i + 997]).to_pylist()] == want
    given.clear()
    some = pa.array([f"{a}word{b}{c} 7{c}" for a in ("", " ", "(") for b in "xyz" for c in ".,!?;:"])
    encoder.encode(some)
    words = "\n".join(given).split("\n")
    assert len(words) == len(set(words)) < 30
    given.clear()
    encoder.encode(some)
    assert not given


def test_an_empty_store(spark, tmp_path):
    folder = stored(spark, [], f"{tmp_path}/empty")
    assert token_store.read_tokens(spark, folder).count() == 0 and token_store.read_span(spark, folder, 0, 10).count() == 0


def test_new_queries_match_their_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    for name, table in (("conversations", prefix_trie), ("embeddings", sort_means)):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
        (query, sql), = table.SQL.items()
        df = getattr(table, query)(spark, sf_dir)
        found = con.execute(sql)
        columns = [c[0] for c in found.description]
        assert sorted(map(repr, found.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())
