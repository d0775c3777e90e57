"""From raw documents to token files in five stages, each one operator of ``tickloom.llm``.

A stage takes (spark, docs, folder of the tables) and returns a DataFrame that is written as Parquet
and read again for the next. All but the last return the columns of ``documents``.

Stages take null and empty texts, repeated rows, empty tables and very long texts as their operators
do. Columns beyond doc_id, text and lang travel as one struct, so a column of whatever name comes out as
it went in.
"""

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontam, language, mixing, neardup
from tickloom.llm.common import documents, table, written
from tickloom.llm.queries import token_files
from tickloom.plans.joins import checked_join

# Tokens of the mix relative to the documents that reach it: with the target weights of
# ``mixing.TARGETS`` this keeps the rates of all but toxic documents at about one or more.
MIX_SIZE = 1.5


# Columns that the operators read; all others are carried along.
READ = ("doc_id", "text", "lang")


def whole_rows(stage):
    """The stage over rows whose other columns are packed into ``_row``, and unpacked after it."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in READ]
        row = [F.struct(*(docs[f"`{c}`"] for c in others)).alias("_row")] if others else []
        found = stage(spark, docs.select(*READ, *row), sf_dir)
        return found.select(*(F.col("_row")[c].alias(c) if c in others else c for c in docs.columns))

    return run_stage


@whole_rows
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models reject go: no letters, or unlike every learned language."""
    found = language.identified(docs, language.fitted(docs), docs.columns)
    return found.where(~F.col("rejected")).select(docs.columns)


@whole_rows
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of the smallest doc_id stays, once.

    Rows without doc_id are not compared and stay.
    """
    classes, _ = neardup.near_duplicates(docs, weighted=True)
    gone = written(classes.where("doc_id <> class_id").select("doc_id").distinct(), "copies")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = written(repeated.where("n > 1").select("doc_id"), "repeated")
    left = checked_join(docs, gone, ["doc_id"], "left_anti", spread=["text"])
    if repeated.isEmpty():
        return left.select(docs.columns)
    once = checked_join(left, repeated, ["doc_id"], "left_semi", spread=["text"])
    others = checked_join(left, repeated, ["doc_id"], "left_anti", spread=["text"])
    return others.unionByName(once.dropDuplicates(["doc_id"])).select(docs.columns)


@whole_rows
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), docs.columns)
    return found.where(F.size("hits") == 0).select(docs.columns)


@whole_rows
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its rate says, so that the domains have their target weights."""
    rated = mixing.mixed(docs, table(spark, sf_dir, "labels"), size=MIX_SIZE, keep=docs.columns)
    n = mixing.copies(F.col("rate"), "doc_id", "text")
    return (
        rated.withColumn("_n", n)
        .where("_n > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
        .select(docs.columns)
    )


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_files(docs)


STAGES = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("token_files", write_tokens),
]

# Trained models and files are not SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
