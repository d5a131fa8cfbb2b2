import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import fingerprints, mixing, packing, token_files, tokens
from tessera.llm.common import shared_dir
from tessera.llm.tokens import Encoder
from tests.llm.helpers import ODD, WORD, odd_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    model = Tokenizer.from_file(PATH)
    model.encode_special_tokens = True
    return lambda text: model.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def test_encoder_equals_the_library(spark, sf, plain, encoder):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts += [t or "" for t in ODD] + ["it's  we'LL 'tis\n\n\n end \n", "a \n b\n ", " '", "<|endoftext|> x", "naïve café ½ ²", "tab\tbed", "x\r\ny"]
    assert encoder.encode(texts) == [raw(plain(t)) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é'st12 .,!\n\t <|日") | st.characters(codec="utf-8"), max_size=40))
def test_encoder_on_any_text(text):
    encoder = _ENCODER
    assert encoder.encode([text]) == encoder._whole([text])


_ENCODER = Encoder(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abÀé'sretvmlld12 .,!\"\n\n  "), max_size=60), max_size=6))
def test_encoder_on_texts_of_its_own_signs(texts):
    assert _ENCODER.encode(texts) == [_ENCODER._whole([t])[0] for t in texts]


@pytest.mark.parametrize("added", [False, True])
def test_encoder_that_forgets_equals_the_library(monkeypatch, spark, sf, added):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()]
    texts += ["x" * 5000, "é" * 13 + " " + "é" * 12, "=" * 24 + " " * 30 + "\n" * 25 + "end", "'s're'tis can't '' 've", "a" * 24, " " + "b" * 24, "", " ", "\n", "a<|endoftext|>b"]
    monkeypatch.setattr(tokens, "_MOST", 50)
    monkeypatch.setattr(tokens, "_AT_ONCE", 37)
    small = Encoder(PATH, added=added)
    for _ in range(2):
        assert small.encode(texts) == [small._whole([t])[0] for t in texts]


def test_pieces_of_packed_documents_are_encoded_once_however_long_they_are():
    own = Encoder(PATH)
    texts = ["see " + "".join("abcdefghij"[k * j % 7] for j in range(100)) + f" and {'=' * (70 + k)}" for k in range(1, 30)]
    first = own.encode(texts)
    own.model = None
    assert own.encode(texts) == first


def test_new_pieces_of_a_group_go_to_the_library_as_one_text(encoder):
    class Counting:
        def __init__(self, model):
            self.model, self.n = model, 0

        def encode_batch_fast(self, texts, **options):
            self.n += len(texts)
            return self.model.encode_batch_fast(texts, **options)

    own = Encoder(PATH)
    own.model = Counting(own.model)
    texts = [f"Word{k}x, (q{k}) {k * 7}\"y{k}\" it's\nNext{k}!" for k in range(200)]
    assert own.encode(texts) == encoder._whole(texts)
    assert own.model.n <= 3


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_ranks_round_trip(values):
    ranks = np.array(values, np.uint32)
    control, data = token_files.encode_ranks(ranks)
    assert len(control) == -(-len(values) // 4) and len(data) >= len(values)
    back = list(token_files.decode_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values)))
    assert np.concatenate([*back, np.empty(0, np.uint32)]).tolist() == values


def test_token_files_round_trip(spark, sf, plain):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    manifest = token_files.write_token_files(docs, f"{shared_dir(spark)}/files-a", PATH, 2)
    assert len(manifest) > 1
    got = token_files.read_token_files(spark, manifest, ids=True).orderBy("start").collect()
    start = 0
    for r, want in zip(got, sorted(docs.collect(), key=lambda r: r.doc_id), strict=True):
        ids = raw([*plain(want.text), 2])
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids), r.ids_crc32) == (want.doc_id, start, len(ids) // 4, ids, zlib.crc32(ids))
        start += r.n_tokens


def test_added_tokens_in_texts_get_the_ids_of_the_library(spark):
    library = Tokenizer.from_file(PATH)
    texts = ["one.<|endoftext|>Start", "<|endoftext|>", "a <|endoftext|> b <|endoftext|", "plain words", "日本<|endoftext|>"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in want[0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    manifest = token_files.write_token_files(docs, f"{shared_dir(spark)}/files-d", PATH, 2)
    got = token_files.read_token_files(spark, manifest, ids=True).orderBy("start").collect()
    assert [bytes(r.ids) for r in got] == [raw([*w, 2]) for w in want]
    cut = packing.pieces(docs, PATH, 1024, 2).collect()
    assert {r.doc_id: r.ids_crc32 for r in cut} == {i: zlib.crc32(raw([*w, 2])) for i, w in enumerate(want)}


def test_a_hot_id_fills_several_files_in_order(spark, plain):
    """Two thirds of the rows share an id: ranges split it, files are cut by size, and equal ids stay together in order."""
    rows = [(5, f"text number {i} of the hot id") for i in range(400)] + [(i, f"own {i}") for i in range(100, 300)] + [(None, "no id")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    manifest = token_files.write_token_files(docs, f"{shared_dir(spark)}/files-e", PATH, 2, file_ids=500)
    assert len(manifest) > 6 and max(n for _, n in manifest) < 0.5 * sum(n for _, n in manifest)
    got = token_files.read_token_files(spark, manifest, ids=True).orderBy("start").collect()
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    assert sorted(bytes(r.ids) for r in got) == sorted(raw([*plain(t), 2]) for _, t in rows)
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()


def test_token_files_of_odd_rows(spark, plain):
    docs = odd_documents(spark)
    manifest = token_files.write_token_files(docs, f"{shared_dir(spark)}/files-b", PATH, 2)
    got = token_files.read_token_files(spark, manifest).collect()
    assert len(got) == len(ODD) + 2
    assert {r.n_tokens for r in got if r.doc_id in (0, 1)} == {1}
    assert sum(r.n_tokens for r in got) == sum(n for _, n in manifest)
    empty = docs.limit(0)
    assert token_files.read_token_files(spark, token_files.write_token_files(empty, f"{shared_dir(spark)}/files-c", PATH, 2)).count() == 0


def check_packing(rows, limits):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= limits.tokens and len(pieces) <= limits.documents and sum(n * n for _, n in pieces) <= limits.attention
    return len(by)


@pytest.mark.parametrize("score", ["residual", "dot"])
def test_packing_is_valid_and_close_to_the_least(spark, sf, plain, score):
    docs = spark.read.parquet(f"{sf}/documents.parquet").union(spark.read.parquet(f"{sf}/documents.parquet").limit(20))
    rows = packing.pack(packing.pieces(docs, PATH, 1024, 2), packing.Limits(), score).collect()
    n = check_packing(rows, packing.Limits())
    assert n <= 1.02 * -(-sum(r.length for r in rows) // 1024) + 2
    want = Counter()
    for r in docs.collect():
        ids = [*plain(r.text), 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want.update((r.doc_id, p, a, b - a, zlib.crc32(raw(ids[a:b]))) for p, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want


def test_packing_under_every_constraint(spark):
    limits = packing.Limits(tokens=100, documents=3, attention=5000)
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 60, 400).tolist()
    cut = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(cut, limits).collect()
    assert len(rows) == 400
    assert check_packing(rows, limits) < 250
    with pytest.raises(ValueError):
        packing.best_fit({80: 1}, limits)


def test_packing_of_odd_rows(spark):
    rows = packing.pack(packing.pieces(odd_documents(spark), PATH, 1024, 2)).collect()
    check_packing(rows, packing.Limits())
    assert [r.length for r in rows if r.doc_id == 0] == [1]
    assert packing.pack(packing.pieces(odd_documents(spark).limit(0), PATH, 1024, 2)).count() == 0


def test_mixing_reaches_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.copies(docs).collect()
    again = mixing.copies(docs.repartition(3)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    sizes = {r.doc_id: len(WORD.findall(r.text or "")) for r in docs.collect()}
    assert {r.doc_id: r.size for r in rows} == sizes
    total = Counter()
    taken = Counter()
    for r in rows:
        total[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    names = sorted(total, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, rest = {}, 1.5 * sum(total.values()), set(names)
    while True:  # share by weight, stop those above, share the rest again
        level = left / sum(weight[s] for s in rest)
        over = {s for s in rest if weight[s] * level > 2 * total[s]}
        if not over:
            break
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
        rest -= over
    target |= {s: weight[s] * level for s in rest}
    for r in rows:
        assert r.target == pytest.approx(target[source[r.doc_id]], rel=1e-9)
    for s in names:
        longest = max(r.size for r in rows if source[r.doc_id] == s)
        assert abs(taken[s] - target[s]) <= longest + 1


def test_mixing_odd_rows(spark):
    docs = odd_documents(spark)
    rows = mixing.copies(docs).collect()
    assert len(rows) == len(ODD) + 2 and all(r.taken == r["size"] * r["copies"] for r in rows)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in mixing.copies(docs, keep=docs.columns).collect())
    assert mixing.copies(docs.limit(0)).count() == 0


def plain_winnow(text, k, window):
    grams = fingerprints.kgram_hashes(text, k) >> np.uint64(24)
    kept = set()
    for i in range(max(1, len(grams) - window + 1) if len(grams) else 0):
        part = grams[i : i + window].tolist()
        kept.add((min(part), i + max(j for j, x in enumerate(part) if x == min(part))))
    return sorted(kept, key=lambda x: x[1])


@pytest.mark.parametrize("text", ["", "a", "abcabcabcabc" * 20, "the quick brown fox jumps over the lazy dog " * 3, "日本語" * 30, "x" * 200])
@pytest.mark.parametrize("k,window", [(4, 5), (16, 16), (3, 1)])
def test_winnowing_equals_its_definition(text, k, window):
    hashes, positions = fingerprints.winnow(text, k, window)
    assert list(zip(hashes.tolist(), positions.tolist())) == plain_winnow(text, k, window)


def test_equal_grams_hash_equally_wherever_they_stand():
    a = fingerprints.kgram_hashes("zz" + "the same words" + "yyyyy", 14)
    assert fingerprints.kgram_hashes("the same words", 14)[0] in a
    shared = "a shared run of thirty-one chars"
    one, two = (set(fingerprints.winnow(x + shared + y)[0].tolist()) for x, y in (("abc" * 30, "q" * 9), ("xyz" * 11, "")))
    assert one & two


def test_fingerprints_of_edited_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in fingerprints.compared(docs).collect()}
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: -r.doc_id)
    assert len(got) == len(rows)
    for r, after in zip(rows, rows[1:] + rows[:1]):
        text, other = r.text or "", after.text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        g = got[r.doc_id]
        assert (g.n_chars, g.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert g.fingerprint == fingerprints.digest(*fingerprints.winnow(text)) and g.edited_fingerprint == fingerprints.digest(*fingerprints.winnow(edited))
        a, b, c = (set(fingerprints.winnow(t)[0].tolist()) for t in (text, edited, other))
        assert g.near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert g.near_next == pytest.approx(len(a & c) / len(a | c) if a | c else 1.0)


def test_fingerprints_of_odd_rows(spark):
    docs = odd_documents(spark)
    rows = fingerprints.compared(docs).collect()
    assert len(rows) == len(ODD) + 2
    assert len({r.fingerprint for r in rows if r.doc_id in (4, 5)}) == 1
    kept = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    assert kept[1].hashes == [] and kept[4].positions == [0]
    assert fingerprints.compared(docs.limit(0)).count() == 0
    assert fingerprints.compared(docs.where(F.col("doc_id") == 12)).count() == 1
