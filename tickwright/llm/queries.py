"""Each operator over its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickwright.llm.chat import format_conversations, read_back
from tickwright.llm.collocations import collocations
from tickwright.llm.classifier import score_documents
from tickwright.llm.decontamination import find_leaks
from tickwright.llm.licenses import scan_licenses
from tickwright.llm.minhash import near_duplicates
from tickwright.llm.packing import pack_documents
from tickwright.llm.periodic_runs import periodic_runs, run_digests, with_planted_repeats
from tickwright.llm.personal_data import personal_data, span_digests
from tickwright.llm.quality_rules import quality_rules
from tickwright.llm.sharding import shard_documents
from tickwright.llm.suffixes import repeated_spans
from tickwright.llm.warc import archive_and_read

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts look like a template's marks."""
    said = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role")) for k, r in enumerate(("user", "assistant"))])).alias("of"),
    ).select("conv_id", "of.*", F.lit(CONTROL_TEXT).alias("text"))
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(spark, conversations.unionByName(said)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


#: Passages of more than 50 words are told of, also where short words make them less than 400 bytes.
PASSAGE_WORDS = 51


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is removed by strings of 400 bytes, and beside it what lies in repeated passages of words."""
    found = repeated_spans(spark, _table(spark, sf_dir, "documents"), words=PASSAGE_WORDS)
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return found.select("doc_id", "n_bytes", "n_removed", n_spans, "kept_sha256", "n_passages", "n_passage_words")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(spark, _table(spark, sf_dir, "pages"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, _table(spark, sf_dir, "documents"), size=2)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(spark, _table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark, _table(spark, sf_dir, "documents"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(personal_data(_table(spark, sf_dir, "documents")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs in the documents, a tenth of which are made periodic first."""
    return run_digests(periodic_runs(with_planted_repeats(_table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Query] = {
    "op1_chat_format": op1_chat_format,
    "op2_quality_rules": op2_quality_rules,
    "op3_license_scan": op3_license_scan,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_warc": op5_warc,
    "op6_decontaminate": op6_decontaminate,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_sharding": op8_sharding,
    "op9_packing": op9_packing,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_collocations": op11_collocations,
    "op12_personal_data": op12_personal_data,
    "op13_periodic_runs": op13_periodic_runs,
}
