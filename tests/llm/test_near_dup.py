import numpy as np
import pytest

import corpus_pipeline
from tessera.llm.common import components, lookup, ranked
from tessera.llm.hashing import similarity_sketch
from tessera.llm.near_dup import near_duplicates
from tests.llm import helpers
from tests.llm.helpers import alike, odd_documents, shingles


def test_equals_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    sets = [(r.doc_id, shingles(r.text, 3)) for r in rows]
    want = helpers.components([r.doc_id for r in rows], alike(sets, 85))
    got = {r.doc_id: r for r in near_duplicates(docs, 3, 85).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets}
    assert all(r.kept == (i == want[i]) for i, r in got.items())


def test_chains_in_one_group_of_near_copies(spark):
    """Texts that drift from a base, so that ends are linked through the middle only."""
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(150):
        changed = list(words)
        for at in rng.choice(120, size=k % 9, replace=False):
            changed[at] = f"x{rng.integers(30)}"
        texts.append(" ".join(changed))
    texts += [" ".join(f"u{k}_{i}" for i in range(50)) for k in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = helpers.components(range(len(texts)), alike([(i, shingles(t, 3)) for i, t in enumerate(texts)], 85))
    for rounds in (1, 2):
        got = {r.doc_id: r.component_id for r in near_duplicates(docs, 3, 85, star_rounds=rounds).collect()}
        assert got == want


def test_pairs_that_only_the_last_search_meets(spark):
    """Pairs at 60 to 65 % in buckets crowded by smaller ids that are less alike."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(120)]

    def changed(text, n):
        out = list(text)
        for at in rng.choice(120, size=n, replace=False):
            out[at] = f"x{rng.integers(10**9)}"
        return out

    texts = [changed(words, 7) for _ in range(60)]
    for _ in range(12):
        texts.append(changed(words, 7))
        texts.append(changed(texts[-1], 9))
    texts += [[f"u{i}" for i in range(120)], [f"u{i}" for i in range(119)]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = helpers.components(range(len(rows)), alike([(i, shingles(t, 3)) for i, t in rows], 60))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, 3, 60, bands=100, rows=1, star_rounds=1).collect()}
    assert got == want


def test_odd_rows(spark):
    rows = near_duplicates(odd_documents(spark), 3, 85).collect()
    assert len(rows) == len(helpers.ODD) + 2
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by[i].n_shingles for i in range(4)] == [0, 0, 0, 0] and all(by[i].kept for i in range(4))
    assert by[5].component_id == 4 and by[9].component_id == 8  # copies, and A-Z in lower case
    assert next(r for r in rows if r.doc_id is None).kept
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty, 3, 85).count() == 0


def test_rows_that_share_an_id(spark, sf):
    """Each text is compared, none that is unique is lost, and the pipeline keeps one of equal rows."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    rows = [(1, a), (7, a + " end"), (7, b), (8, b + " end"), (9, c), (9, c), (9, c + " end"), (1, "one only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in near_duplicates(docs, 5, 80).collect()}
    assert got == {(1, 56): 1, (7, 57): 1, (7, 56): 7, (8, 57): 7, (9, 56): 9, (9, 57): 9, (1, 1): 1}
    left = corpus_pipeline.near_dedup(spark, docs, sf).collect()
    assert sorted(r.doc_id for r in left) == [1, 1, 7, 9] and {(1, a), (1, "one only"), (7, b)} <= {tuple(r) for r in left}


def test_sketch_agrees_with_similarity():
    rng = np.random.default_rng(0)
    size, hits = 100, []
    for _ in range(60):
        pool = rng.integers(1, 2**63, 150).astype(np.uint64)
        both = similarity_sketch(np.concatenate([pool[:120], pool[30:150]]), np.repeat([0, 1], 120), 2, size)
        assert (both != ~np.uint64(0)).all()
        hits.append((both[0] == both[1]).mean())
    assert abs(np.mean(hits) - 90 / 150) < 0.03
    tiny = similarity_sketch(np.array([7], np.uint64), np.array([0]), 2, size)
    assert (tiny[0] != ~np.uint64(0)).all() and (tiny[1] == ~np.uint64(0)).all()


def test_components_of_long_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 400)] + [(500, 500), (None, 3), (900, 800)]
    rng = np.random.default_rng(3)
    links = [links[i] for i in rng.permutation(len(links))]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for p in links for x in p if None not in p and p[0] != p[1]}
    assert got == helpers.components(nodes, [p for p in links if None not in p and p[0] != p[1]])


def test_lookup_with_a_hot_key(spark):
    left = spark.createDataFrame([(7 if i % 2 else i, i) for i in range(3000)] + [(None, -1)], "k long, v long")
    right = spark.createDataFrame([(i, f"n{i}") for i in range(2000)], "k long, name string")
    got = lookup(left, right, "k", "left").collect()
    assert len(got) == 3001 and all((r.name == f"n{r.k}") if r.k is not None and r.k < 2000 else r.name is None for r in got)


def test_ranks_without_a_window_per_group(spark):
    rows = [(None if i % 5 == 0 else f"g{i % 3}", i % 7, i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, s long, id long")
    got = {r.id: r["rank"] for r in ranked(df, ["g"], [df["s"], df["id"]]).collect()}
    for g in {r[0] for r in rows}:
        order = sorted((r[1], r[2]) for r in rows if r[0] == g)
        assert [got[i] for _, i in order] == list(range(len(order)))


def test_sketches_need_small_bandings(spark):
    with pytest.raises(ValueError):
        near_duplicates(spark.createDataFrame([], "doc_id long, text string"), bands=40, rows=5)
