"""The registered queries themselves, on the smallest tables, against plain versions of what their columns state."""

import hashlib
import re
import zlib

import pytest

from tessera.llm import queries


@pytest.fixture(scope="module")
def texts(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    return {r.doc_id: r for r in rows}


def crc(i):
    return zlib.crc32(str(i).encode())


def test_language_query(spark, sf, texts):
    got = {r.doc_id: r for r in queries.op1_language_id(spark, sf).collect()}
    assert set(got) == set(texts) and all(got[i].held_out == (crc(i) % 3 == 1) for i in got)
    langs = {r.lang for r in texts.values()} - {None}
    for i, r in got.items():
        letters = any(c.isalpha() for c in texts[i].text or "")
        assert 0 <= r.score <= 1 and (r.lang_pred in langs if letters else r.lang_pred == "und")


def test_quality_query(spark, sf, texts):
    got = {r.doc_id: r for r in queries.op3_quality_classifier(spark, sf).collect()}
    assert set(got) == set(texts)
    assert all(r.held_out == (crc(i) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for i, r in got.items())


def test_fingerprint_query(spark, sf, texts):
    got = {r.doc_id: r for r in queries.op5_document_fingerprints(spark, sf).collect()}
    order = sorted(texts, reverse=True)
    assert set(got) == set(texts)
    for i, after in zip(order, [*order[1:], order[0]]):
        text, other = texts[i].text or "", texts[after].text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        assert (got[i].near_next == 1) == (got[i].fingerprint == got[after].fingerprint) or texts[i].text != texts[after].text


def plain_rule(host, path):
    fits = [(h, p, v) for v, h, p in queries_rules() if (host == h or host.endswith(f".{h}")) and path.startswith(p)]
    best = max(fits, key=lambda f: len(f[0] + f[1]), default=None)
    return (best[0] + best[1], best[2]) if best else (None, None)


def queries_rules():
    return [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def test_url_query(spark, sf):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op6_url_filters(spark, sf).collect()
    assert sorted(r.page_id for r in got) == sorted(urls)
    for r in got:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", urls[r.page_id] or "")
        host = m[1].translate({c: c + 32 for c in range(65, 91)}) if m else ""
        path = m[2] if m else ""
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block") and verdict in (None, r.verdict)
