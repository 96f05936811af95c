"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and
returns the columns of documents, the last one the pieces of packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeproof.llm import frames, line_windows, mixing, near_duplicates, packing, quality, queries

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base nor a learned rule rejects.

    Null and empty texts, and all others under 50 words, fail the base. Repeated
    rows, which share their text, stay or go together; null ids are judged like
    others but teach nothing. An empty table gives none; without labels only the
    base rejects. Extra columns are kept as they are.
    """
    queries.importable(spark)
    return quality.keep_good(docs, frames.read(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later occurrences of three-line windows; n_chars follows the text.

    Every row stays, a null text stays null and so becomes its n_chars; of repeated
    windows the first in the order of ids and row keys stays. An
    empty table gives none. Extra columns are kept as they are.
    """
    cleaned = line_windows.line_dedup(docs).withColumn("n_chars", F.length("text").cast("long"))
    return cleaned.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more.

    Of repeated rows one stays, of a group the one of the least id. Texts without
    words are near nothing and all stay, as do unrelated texts of one id or of a
    null id. An empty table gives none. Extra columns are kept as they are.
    """
    queries.importable(spark)
    return near_duplicates.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the budget of their source takes, each at most once.

    A null language or source is a value of its own. Repeated rows are taken
    together or not at all; texts without words cost nothing and are taken where
    their place lies within the prefix. An empty table gives none. Extra columns,
    also those named like the ones that mixing adds, are kept as they are.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    carried = docs.select("doc_id", "text", "lang", "source", row)
    mixed = mixing.mixture(carried, queries.tree(), queries.WEIGHTS, queries.MIX_FRACTION, max_epochs=1)
    return mixed.where("n_copies > 0").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens.

    A null or empty text is its end token alone. Repeated rows and null ids are
    packed one by one. An empty table gives none. Other columns are not read.
    """
    queries.importable(spark)
    return packing.pack(docs, packing.default_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Rules are learned and sequences packed, which SQL does not express; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again."""
    docs = frames.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = frames.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
