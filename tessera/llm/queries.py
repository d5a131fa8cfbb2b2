"""The corpus operators applied to whole tables: one query each."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprints, language, mixing, packing, quality, token_files
from .common import shared_dir, tuned
from .lines import line_classes
from .near_dup import near_duplicates
from .urls import judged_pages
from .vectors import near_vectors

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


def remainder(n: int):
    """crc32 of doc_id as text, modulo n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets are at least 85 % alike."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the texts and labels of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(remainder(3) == 1, F.lit(False))
    model = language.train(docs.where(~held))
    return language.identify(docs, model).withColumn("held_out", held)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, the first line of its class, and whether it is kept."""
    return line_classes(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(remainder(5) == 0, F.lit(False))
    model = quality.train(docs, table(spark, sf_dir, "labels").where(~held))
    scores = quality.scored(docs, model)
    return scores.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.compared(table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return judged_pages(table(spark, sf_dir, "pages"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the token files of all documents hold, read back."""
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), folder, TOKENIZER, END_ID)
    return token_files.read_token_files(spark, manifest)


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors with equal labels and cosines of 0.98 or more."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    found = mixing.copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of 1024 tokens."""
    cut = packing.pieces(table(spark, sf_dir, "documents"), TOKENIZER, 1024, END_ID)
    return packing.pack(cut, packing.Limits(tokens=1024))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_url_filters": op6_url_filters,
    "op7_token_output": op7_token_output,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_source_mixing": op9_source_mixing,
    "op10_best_fit_packing": op10_best_fit_packing,
}

#: All pairs in SQL, for the small tables that the driver compares.
COMPONENTS = """reach AS (SELECT id AS node, id AS root FROM ids UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY 1)"""

ORACLES: dict[str, str] = {
    "op4_minhash_near_dedup": f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents), s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 3 THEN list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w), u AS (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2), links AS (
  SELECT a, b FROM p WHERE 100 * c >= 85 * (na + nb - c)), ids AS (SELECT doc_id AS id FROM documents), {COMPONENTS}
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN roots ON node = doc_id""",
    "op8_embedding_near_dedup": f"""WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98), ids AS (SELECT vec_id AS id FROM embeddings), {COMPONENTS}
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN roots ON node = vec_id""",
    "op9_source_mixing": """WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w FROM d GROUP BY 1), o AS (
  SELECT *, sum(2.0 * source_size) OVER c AS capped, sum(w) OVER () - sum(w) OVER c AS open_w, 1.5 * sum(source_size) OVER () AS total, 2.0 * source_size / w AS ratio FROM s WINDOW c AS (ORDER BY 2.0 * source_size / w, source NULLS LAST)), l AS (
  SELECT min(CASE WHEN lv >= ratio AND lv <= next_ratio THEN lv END) AS level FROM (
    SELECT (total - capped) / nullif(open_w, 0) AS lv, ratio, lead(ratio) OVER (ORDER BY ratio, source NULLS LAST) AS next_ratio FROM o
    UNION ALL SELECT any_value(total) / sum(w), 0, min(ratio) FROM o) x), t AS (
  SELECT source, source_size, least(2.0 * source_size, w * level) AS target FROM s, l), r AS (
  SELECT doc_id, size, source_size, target, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) - 1 AS place, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS each,
    CAST('0x' || substr(md5('17:' || coalesce(source, '')), 1, 8) AS BIGINT) / 4294967296.0 AS shift FROM d JOIN t USING (source))
SELECT doc_id, size, source_size, round(target, 6) AS target, CAST(size * (floor((place + 1) * each + shift) - floor(place * each + shift)) AS BIGINT) AS taken FROM r""",
}
