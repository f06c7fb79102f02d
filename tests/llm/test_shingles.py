import random

import numpy as np
import pyarrow as pa
import pytest
from test_texts import frame, near_rows

from tesserae.llm import shingle_dedup, simhash


def plain_components(rows, least=0.8):
    """(id, least id of the component) by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common >= least * (len(sets[i]) + len(sets[j]) - common) - 1e-9 and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    of = {}
    for r, (d, _) in zip(root, rows, strict=True):
        if d is not None:
            of[r] = min(d, of.get(r, d))
    return sorted(((d, of.get(r)) for r, (d, _) in zip(root, rows, strict=True)), key=repr)


def family(rng, first, n, edits):
    """Copies of a text, each with a few words replaced."""
    base = [f"f{rng.randrange(5000)}" for _ in range(150)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(150)] = f"e{rng.randrange(10**6)}"
        rows.append((first + i, " ".join(words)))
    return rows


def test_near_copies_match_all_pairs(spark):
    rng = random.Random(7)
    rows = near_rows() + family(rng, 5000, 120, 12) + [(7000 + 10 * i + j, t) for i in range(40) for j, (_, t) in enumerate(family(rng, 0, 3, 4))]
    for given in (rows, []):
        have = sorted(((r.doc_id, r.component_id) for r in shingle_dedup.near_copies(frame(spark, given)).collect()), key=repr)
        assert have == plain_components(given)


@pytest.mark.parametrize("block", [15_000])
def test_large_groups_in_blocks(spark, block):
    """Groups of near-copies, of chains that only neighbours link, and of texts that share bands without being linked, cut into blocks."""
    rng = random.Random(11)
    chain, words = [], [f"c{i}" for i in range(60)]
    for i in range(25):
        words = words[:]
        words[(3 * i) % 60] = f"x{i}"
        chain.append((9000 + i, " ".join(words)))
    rows = family(rng, 1, 40, 4) + family(rng, 200, 40, 14) + chain
    have = sorted(((r.doc_id, r.component_id) for r in shingle_dedup.near_copies(frame(spark, rows), block=block).collect()), key=repr)
    assert have == plain_components(rows)


def test_strays_meet_all_blocks(spark):
    """One group, a chain: few texts reach the hub within their blocks, yet all are one component; a text apart stays so."""
    words, texts = [f"c{i}" for i in range(60)], []
    for i in range(24):
        words = words[:]
        words[(3 * i) % 60] = f"x{i}"
        texts.append(" ".join(words))
    texts.append("apart " * 8)

    def compare(plain):
        return shingle_dedup.links_in_group([shingle_dedup.shingles(p) for p in plain], 0.8)

    def link(group):
        nodes = group.column("node").to_pylist()
        found = compare(group.column("plain").to_pylist())
        return pa.table({k: pa.array([nodes[p[i]] for p in found], pa.int64()) for i, k in enumerate("ab")})

    large = spark.createDataFrame([(i, len(t), 5, 6, 0) for i, t in enumerate(texts)], "node long, bytes long, band long, blocks long, hub long")
    plain = spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(texts)], "node long, plain binary")
    links = shingle_dedup._links_in_blocks(large, plain, link, 1000, compare)
    root = {i: i for i in range(len(texts))}
    for r in links.collect():
        a, b = root[r.a], root[r.b]
        root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    assert plain_components([(i, t) for i, t in enumerate(texts)]) == sorted(root.items(), key=repr) and len(set(root.values())) == 2


def test_pipeline_drops_near_copies_beyond_two_bits(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(kept) == sorted(d for d, c in plain_components(rows) if d == c)
    assert {6, 145} & kept == {6}  # five-word similarity 0.83, over two bits apart


def test_pipeline_links_by_simhash_what_its_radius_reaches(spark, monkeypatch):
    """Without any band in common, pairs within two bits are still found, by the pivot tables, and checked by their shingles."""
    import corpus_pipeline

    rng, rows = random.Random(3), []
    for i in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(400)]
        rows += [(10 * i, " ".join(words)), (10 * i + 1, " ".join([*words, f"e{i}"]))]
    rows += [(9001, None), (9002, ""), (9005, "a b"), (9007, "A  b")]
    monkeypatch.setattr(shingle_dedup, "bands", lambda own: np.random.default_rng().integers(-(2**62), 2**62, shingle_dedup.BANDS))
    docs = frame(spark, rows)
    have = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    fps = {d: simhash.fingerprint((t or "").encode()) for d, t in rows}
    within = [i for i in range(60) if (fps[10 * i] ^ fps[10 * i + 1]).bit_count() <= 2]
    assert len(within) > 30
    assert have == sorted({d for d, _ in rows} - {10 * i + 1 for i in within} - {9002, 9007})
