"""The corpus pipeline: quality, line deduplication, near-duplicate documents, source mixing, packing."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import lines, mixing, packing, quality
from tessera.llm.common import noting, release, stage, tuned
from tessera.llm.near_dup import near_duplicates
from tessera.llm.queries import END_ID, TOKENIZER
from tessera.session import ship


#: Tables that the stages before staged for themselves; a stage's result is written before the next one is called.
_left: list[str] = []


def _tidy(step: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """Deletes what earlier stages staged for themselves, and notes what this one does."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        tuned(ship(spark))
        release(spark, _left)
        with noting(_left):
            return step(spark, docs, sf_dir)

    return run_step


@_tidy
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.3 go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.kept(docs, model, 0.3)


@_tidy
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each class of alike lines stays."""
    return lines.deduplicated(docs)


@_tidy
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, whether ids repeat or not."""
    rows = stage(docs.withColumn("_row", F.monotonically_increasing_id()))
    gone = stage(near_duplicates(rows, width=5, percent=80, row="_row").where("not kept").select("_row"))
    return rows.join(gone.hint("merge"), "_row", "left_anti").select(*docs.columns)


@_tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, repeated or left out so that sources have their target sizes."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 1024 tokens. Its own tables stay, as its result is read later."""
    tuned(ship(spark))
    release(spark, _left)
    return packing.pack(packing.pieces(docs, TOKENIZER, 1024, END_ID), packing.Limits(tokens=1024))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stage(docs)
    return docs


#: Signatures, latent vectors and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
ORACLES: dict[str, str] = {}
