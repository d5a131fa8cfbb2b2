import pathlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import lines, urls, vectors
from tessera.llm.common import noting
from tests.llm import helpers
from tests.llm.helpers import ODD, alike, odd_documents


def near_links(rows, threshold=0.98):
    out = []
    for i, (a, x, la) in enumerate(rows):
        for b, y, lb in rows[:i]:
            if la is None or la != lb or x is None or y is None or len(x) != len(y):
                continue
            if any(v is None or not np.isfinite(v) for v in [*x, *y]) or not any(x) or not any(y):
                continue
            p, q = np.array(x, float), np.array(y, float)
            if p @ q / np.sqrt((p @ p) * (q @ q)) >= threshold:
                out.append((a, b))
    return out


def vector_rows():
    rng = np.random.default_rng(4)
    rows = []
    for k in range(12):
        base = rng.standard_normal(32)
        for _ in range(12):
            v = (base + rng.standard_normal(32) * 0.12 * rng.random()).astype(np.float32).tolist()
            rows.append((len(rows), v, int(k % 3) if rng.random() > 0.05 else None))
    rows += [(200, rows[0][1], rows[0][2]), (201, rows[0][1], rows[0][2]), (202, [2 * x for x in rows[0][1]], rows[0][2])]
    rows += [(210, None, 1), (211, [0.0] * 32, 1), (212, [float("nan")] + [1.0] * 31, 1), (213, [None] + [1.0] * 31, 1), (214, [float("inf")] * 32, 1), (215, [], 1), (216, rows[0][1][:16], rows[0][2])]
    return rows


@pytest.mark.parametrize("block", [256, 5])
def test_vectors_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit("clash"))
    links = near_links(rows)
    want = helpers.components([r[0] for r in rows], links)
    n = {r[0]: sum(r[0] in p for p in links) for r in rows}
    got = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    assert len(got) == len(rows) and sum(n.values()) > 500
    assert {i: r.n_links for i, r in got.items()} == n
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (i == want[i]) for i, r in got.items())


def test_vectors_without_rows_or_ids(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert vectors.near_vectors(spark.createDataFrame([], kind)).count() == 0
    rows = vectors.near_vectors(spark.createDataFrame([(None, [1.0], 1), (1, [1.0], 1), (1, [1.0], 1)], kind)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.kept) for r in rows) == [(0, 0, True), (1, 0, True), (1, 0, True)]


def plain_rule(host, path):
    best = None
    for kind, h, p in urls.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, kind)
    return best or (None, None)


def plain_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


ODD_URLS = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.NET/EN/x", "http://example.net", "http://a.example.net/en/1", "http://xexample.net/en/1", "https://example.com/de", "http://É.org/fr/", "a://b://c/d", "http://h.org?x=/fr/", "http://h.org#/fr/", "http://h.com/a/b/c/d/e/f/g/h/i", "http://h.com//", "http://user:pw@h.org:80/fr/1\nx"]


def test_urls(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame([(10**6 + i, u) for i, u in enumerate(ODD_URLS)] + [(10**6, None)], "page_id long, url string")
    both = pages.unionByName(odd).withColumn("host", F.lit("clash"))
    rows = {r.page_id: r for r in urls.judged_pages(both).collect()}
    url = {r.page_id: r.url for r in both.collect()}
    assert len(rows) == len(url)
    for i, r in rows.items():
        host, path = plain_parts(url[i])
        rule, kind = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and (kind is None or r.verdict == kind)
    assert urls.judged_pages(odd.limit(0)).count() == 0


def test_templates_learn_from_labelled_neighbours(spark):
    """Branches that share a template with blocked pages go; branches like the allowed ones, or without labels, stay."""
    rules = [("block", "h.test", "/spam/1"), ("allow", "h.test", "/news/1")]
    made = [f"http://h.test/spam/{n}" for n in range(10, 30)] + [f"http://h.test/news/{n}" for n in range(10, 30)] + [f"http://h.test/about/{n}" for n in range(5)]
    made += ["http://h.test/spam/777", "http://h.test/news/777"] + [f"http://w.test/tag/{w}" for w in "abcdefghijklmnopqrst"]
    df = spark.createDataFrame(list(enumerate(made)), "page_id long, url string")
    got = {r.page_id: r for r in urls.judged_pages(df, rules).collect()}
    at = made.index("http://h.test/spam/777")
    assert (got[at].rule, got[at].verdict) == (None, "block") and got[at + 1].verdict == "allow"
    assert all(got[i].verdict == "allow" for i, u in enumerate(made) if "about" in u)
    assert {got[i].template for i, u in enumerate(made) if "w.test" in u} == {"/tag/*"} or len({got[i].template.rsplit("/", 1)[0] for i, u in enumerate(made) if "w.test" in u}) == 1


def test_templates_tell_deep_branches_apart(spark):
    rules = [("block", "h.test", "/a/b/c/d/e/f/spam/1"), ("allow", "h.test", "/a/b/c/d/e/f/news/1")]
    made = [f"http://h.test/a/b/c/d/e/f/{kind}/{n}" for kind in ("spam", "news") for n in (*range(10, 20), 777)]
    got = {r.page_id: r for r in urls.judged_pages(spark.createDataFrame(list(enumerate(made)), "page_id long, url string"), rules).collect()}
    assert [(got[i].rule, got[i].verdict) for i in (10, 21)] == [(None, "block"), (None, "allow")]


def test_a_path_alone_in_its_node_keeps_its_segments(spark):
    made = ["http://h.test/a/b/c/9", "http://h.test/a/x/y/z/w/v", "http://h.test/", "http://h.test", "http://h.test/a"]
    got = {r.page_id: r.template for r in urls.judged_pages(spark.createDataFrame(list(enumerate(made)), "page_id long, url string")).collect()}
    assert got[1].endswith("/w/v") and len(set(got.values())) >= 3


def plain_lines(docs, percent):
    first, place = {}, {}
    for i, text in sorted(docs):
        for n, line in enumerate((text or "").split("\n") if text is not None else []):
            if line.strip():
                first.setdefault(line, (i, n))
                place[i, n] = line
    k = lines.SHINGLE
    sets = [(first[x], {x[j : j + k] for j in range(len(x) - k + 1)} or {x}) for x in first]
    classes = helpers.components(first.values(), alike(sets, percent))
    return {at: classes[first[x]] for at, x in place.items()}


def test_lines_equal_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    want = plain_lines([tuple(r) for r in docs.collect()], 80)
    got = lines.line_classes(docs).collect()
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.first_doc_id, r.first_line_no)) for r in got)
    assert {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no) for r in got if (r.doc_id, r.line_no) in want} == want


def test_fuzzy_lines_of_one_group(spark):
    """Lines that drift from one another, a few words at a time."""
    rng = random.Random(5)
    base = [f"word{rng.randrange(10**6)}" for _ in range(30)]
    docs, line = [], list(base)
    for i in range(80):
        if i % 3 == 0:
            line = list(base)
        line[rng.randrange(30)] = f"other{rng.randrange(10**6)}"
        docs.append((i, " ".join(line) + "\nshared footer\n" + f"own line {rng.random()} {rng.random()}"))
    want = plain_lines(docs, 80)
    got = lines.line_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    wrong = [r for r in got if (r.doc_id, r.line_no) in want and want[r.doc_id, r.line_no] != (r.first_doc_id, r.first_line_no)]
    assert len(wrong) <= 2  # a pair may miss all bands; here several paths join each class


def test_short_and_digit_only_lines_equal_all_pairs(spark):
    """Near copies whose shingles are few, or follow no vowel: another end, a character more."""
    rng = random.Random(8)
    docs = []
    for signs, sizes in (("0234678", (12, 16, 19, 24, 40, 70)), ("bcdfghjk ", (12, 16, 19, 24, 40, 70)), ("0123456789", (12, 14, 18, 30)), ("abcdefghijk", (12, 14, 18, 30))):
        for size in sizes:
            for _ in range(15):
                base = "".join(rng.choice(signs) for _ in range(size - 2)) + "zz"
                near = [base, base[:-1] + "q", base + "x", "x" + base]
                docs += [(len(docs) + i, line) for i, line in enumerate(rng.sample(near, 4))]
    want = plain_lines(docs, 80)
    assert len(set(want.values())) < 0.6 * len(want)
    got = lines.line_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no) for r in got} == want


def test_recall_just_above_the_threshold(spark):
    """Pairs of 80 to 90 %, of capitals, digits, code, words and other scripts, each kind found at 99 %."""
    rng = random.Random(4)
    kinds = {"capitals": "BCDFGHLNORSTUPK", "digits": "0123456789", "hex": "0123456789abcdef", "letters": "abcdefghij klmnop", "script": "абвгдежзиклмноп "}
    docs, pairs, k = [], {}, lines.SHINGLE
    for kind, signs in kinds.items():
        for n in range(240):
            size = rng.choice((24, 40, 100, 150, 400))
            line = "".join(rng.choice(signs) for _ in range(size))
            near = list(line)
            for _ in range(max(1, size // 90)):
                near[rng.randrange(size)] = rng.choice(signs)
            near = "".join(near)
            a, b = ({x[j : j + k] for j in range(len(x) - k + 1)} for x in (line, near))
            if 0.8 <= len(a & b) / len(a | b) < 1:
                pairs.setdefault(kind, []).append((2 * len(docs), line, near))
                docs.append((2 * len(docs), line))
                docs.append((docs[-1][0] + 1, near))
    docs = [(i, text) for i, (_, text) in enumerate(docs)]
    at = {text: i for i, text in docs}
    got = {r.doc_id: r.first_doc_id for r in lines.line_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for kind, found in pairs.items():
        linked = sum(got[at[x]] == got[at[y]] for _, x, y in found)
        assert len(found) > 50 and linked >= 0.99 * len(found), (kind, linked, len(found))


def test_rows_that_share_a_doc_id_keep_what_only_they_have(spark):
    rows = [(0, "shared line of some length\nx other"), (1, "shared line of some length"), (1, "a line that nobody else has at all"), (None, "shared line of some length")]
    out = lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in out if r.doc_id is not None) == [(False, 0, rows[0][1]), (False, 1, rows[2][1])]
    assert [r.text for r in out if r.doc_id is None] == [rows[3][1]]
    same = lines.deduplicated(spark.createDataFrame([(7, "the very same row\ntwo"), (7, "the very same row\ntwo")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.text) for r in same] == [(7, "the very same row\ntwo")]


def test_lines_of_odd_rows(spark):
    docs = odd_documents(spark)
    got = lines.line_classes(docs).collect()
    assert sum(r.doc_id == 3 for r in got) == 3 and all(r.kept for r in got if r.doc_id in (1, 2, 3))
    assert [r.first_doc_id for r in got if r.doc_id == 5] == [4] and all(r.kept for r in got if r.doc_id is None)
    out = lines.deduplicated(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    texts = {r.doc_id: r.text for r in out.collect()}
    assert 5 not in texts and texts[0] is None and texts[1] == "" and texts[11] == ODD[11]
    assert lines.line_classes(docs.limit(0)).count() == 0 and lines.deduplicated(docs.limit(0)).count() == 0


def test_line_dedup_keeps_the_rest_of_a_text(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta\nkeep me\n"), (2, "first of two\nalpha beta gamma delta\n\nlast"), (3, "alpha beta gamma delta")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.deduplicated(docs).collect()}
    assert got == {1: "alpha beta gamma delta\nkeep me\n", 2: "first of two\n\nlast"}


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.dtypes, [docs.count()]
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, sf)
        assert out.dtypes == columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen.append(docs.count())
    kept, lined, near = seen[1:4]
    assert seen[0] * 0.7 < kept <= seen[0] and kept * 0.7 < lined <= kept and near <= lined
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert len(packed) >= docs.count()


def test_pipeline_of_odd_rows(spark, sf):
    docs = odd_documents(spark)
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, sf)
        assert out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), out.schema)
    corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    empty = odd_documents(spark).limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, sf).count() == 0


def test_bands_go_out_in_parts_and_minima_are_slim(spark):
    texts = spark.createDataFrame([(k, f"line number {k} of some length") for k in range(50)], "node long, line string")
    signed = lines._signatures(texts)
    assert dict(signed.dtypes)["minima"] == "array<int>"
    whole, *parts = signed.select(lines.bands(F.col("minima")), *[lines.bands(F.col("minima"), p) for p in range(lines.PARTS)]).first()
    assert [b for part in parts for b in part] == whole and max(map(len, parts)) <= len(whole) // 4


@pytest.mark.parametrize("few", [lines.FEW, 0])
def test_marks_keep_the_rows_whose_number_is_asked_for(spark, monkeypatch, few):
    monkeypatch.setattr(lines, "FEW", few)
    numbers = [*range(3000), *(2**33 + k for k in range(100)), 5 * 2**33 + 63, 5 * 2**33 + 64]
    asked = {n for n in numbers if n % 7 == 0 or n % 64 == 63} | {2**40}
    rows = spark.createDataFrame([(n, f"t{n}") for n in numbers], "node long, line string").repartition(3)
    got = lines._marked(rows, spark.createDataFrame([(n,) for n in asked], "x long"), "node").collect()
    assert sorted(map(tuple, got)) == [(n, f"t{n}") for n in sorted(asked & set(numbers))]


def test_blocks_of_lines_meet_once(spark):
    """Every pair with a line that is apart meets in one block, and lines apart are not dealt to blocks from both sides."""
    for n_apart, n_main, n_rest, n_all in ((400, 0, 10, 10), (60, 90, 3, 7), (5, 30, 1, 1)):
        rows = [(7, 0, x, x if x < n_apart else -1, x < n_apart, n_rest, n_all) for x in range(n_apart + n_main)]
        there = spark.createDataFrame(rows, "bucket long, band int, x long, root long, apart boolean, n_rest int, n_all int")
        a, b = (side.collect() for side in lines._dealt(lines._placed(there)))
        met = Counter()
        blocks = {}
        for r in b:
            blocks.setdefault((r.i, r.j), []).append(r)
        for r in a:
            met.update((min(r.x, s.x), max(r.x, s.x)) for s in blocks.get((r.i, r.j), []) if (r.root < s.root if r.i == r.j and s.apart else r.root != s.root))
        assert met == {(x, y): 1 for x in range(n_apart) for y in range(x + 1, n_apart + n_main)}
        assert len(a) + len(b) < 0.65 * (n_apart * n_all + (n_apart + n_main) * n_rest) or n_all < 10


def test_line_classes_leave_little_on_the_shared_disk(spark):
    """Texts, signatures and sets are deleted once nothing reads them; what stays is slim."""
    rng = random.Random(7)
    rows = [(i, "\n".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz     ", k=200)) for _ in range(20))) for i in range(800)]
    rows += [(i + 800, t.replace("a", "b", 1)) for i, t in rows[:200]]
    paths = []
    with noting(paths):
        out = lines.line_classes(spark.createDataFrame(rows, "doc_id long, text string"))
        assert out.where("not kept").count() == 200 * 20
    left = sum(f.stat().st_size for p in paths for f in pathlib.Path(p.removeprefix("file:")).rglob("*.parquet"))
    assert left < 0.25 * sum(len(t) for _, t in rows)
