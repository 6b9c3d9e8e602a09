"""From raw documents to packed training sequences.

Each stage works on all that the one before kept. ``run`` writes what a stage returns to the shared folder
and hands it to the next as Parquet, so a lost executor costs at most a stage.

Workers go on from stage to stage with what they once held, so all stages send them few texts at a time.
"""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tickwright.llm.classifier import keep_by_quality
from tickwright.llm.decontamination import without_leaks
from tickwright.llm.minhash import BATCH_ROWS, keep_one_of_each
from tickwright.llm.packing import pack_documents
from tickwright.llm.suffixes import without_repeats
from tickwright.session import shared_dir

#: SQL has no classifier, no suffix order by bytes and no tokenizer.
ORACLE_SQL = None

#: Repeated passages of more than 50 words go, also where short words make them less than 400 bytes.
PASSAGE_WORDS = 51


#: Rows in a batch for Python.
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _few_at_a_time(stage: Stage) -> Stage:
    """The stage, after which the session sends at most BATCH_ROWS rows in a batch: what it returns has yet to be run."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
            spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_few_at_a_time
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_by_quality(spark, docs, _table(spark, sf_dir, "labels"))


@_few_at_a_time
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates by five-word shingles the smallest id stays."""
    return keep_one_of_each(spark, docs)


@_few_at_a_time
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 51 words that occur twice are cut out of all texts, and strings of 400 bytes where those hold fewer
    words; a text may become empty."""
    return without_repeats(spark, docs, words=PASSAGE_WORDS)


@_few_at_a_time
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return without_leaks(spark, docs, _table(spark, sf_dir, "benchmark"))


@_few_at_a_time
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
