"""Quality rules kept in a ledger of failure bits, policies applied to it, and what each rule decides.

Every rule is evaluated once for each document. A policy is a named set of rules, a mask over the bits, so
another policy or an ablation reads the ledger and not the texts.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

GAP = r"[\x20\x09-\x0D]+"
NOT_GAP = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    """A document fails where the SQL condition over the measurements is true."""

    name: str
    fails: str


#: The place in this list is the rule's bit: append, never reorder.
RULES = [
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 30 * n_words"),
    Rule("duplicate_lines", "n_lines >= 10 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("upper_case", "100 * n_upper > 40 * word_chars"),
    Rule("bare_words", "100 * n_bare_words > 20 * n_words"),
    Rule("exclamations", "100 * n_exclamations > 30 * n_words"),
]
BASE = ("few_words", "repeated_words")
POLICIES = {
    "base": BASE,
    "2": (*BASE, "symbols", "duplicate_lines", "word_length"),
    "3": tuple(rule.name for rule in RULES),
}
CURRENT = "3"
MEASURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_bare_words",
    "n_exclamations",
]


def mask_of(policy: str) -> int:
    return sum(1 << k for k, rule in enumerate(RULES) if rule.name in POLICIES[policy])


def _repeated_words(trigrams: Column) -> Column:
    """Words in three-word windows that occur twice or more, from (hash, place) in order of the hash."""

    def repeated(x: Column, k: Column) -> Column:
        before, after = F.get(trigrams, k - 1)["hash"], F.get(trigrams, k + 1)["hash"]
        return F.coalesce(x["hash"] == before, F.lit(False)) | F.coalesce(x["hash"] == after, F.lit(False))

    places = F.sort_array(F.transform(F.filter(trigrams, repeated), lambda x: x["place"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("covered"))
    return F.aggregate(
        places,
        start,
        lambda a, p: F.struct(p.alias("last"), (a["covered"] + F.least(F.lit(3), p - a["last"])).alias("covered")),
        lambda a: a["covered"],
    )


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the columns in MEASURES, each a long, from whole texts; a null text has no words."""
    text = F.col("text")
    split = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id",
        "text",
        F.filter(F.split("text", GAP), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(NOT_GAP)).alias("lines"),
    )
    n_words = F.size("words")
    window = lambda k: F.xxhash64(F.get("words", k), F.get("words", k + 1), F.get("words", k + 2))
    hashed = split.select(
        "doc_id",
        n_words.alias("n_words"),
        F.char_length(F.array_join("words", "")).alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        F.regexp_count(text, F.lit(r"[A-Z]")).alias("n_upper"),
        F.size(F.filter("words", lambda w: ~w.rlike(r"[\p{L}\p{N}]"))).alias("n_bare_words"),
        F.regexp_count(text, F.lit("!")).alias("n_exclamations"),
        F.when(n_words >= 3, F.transform(F.sequence(F.lit(0), n_words - 3), window)).alias("hashes"),
    )
    # Most texts repeat no window, which a set of their hashes tells without a sort.
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    pairs = F.transform("hashes", lambda h, k: F.struct(h.alias("hash"), k.alias("place")))
    sorted_ = hashed.withColumn("trigrams", F.when(repeats, F.sort_array(pairs)))
    counted = sorted_.withColumn("n_repeat_words", F.coalesce(_repeated_words(F.col("trigrams")), F.lit(0)))
    return counted.select("doc_id", *[F.col(m).cast("long").alias(m) for m in MEASURES])


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and ``fail_bits``, one bit for each rule. One row for each row of docs."""
    bits = [F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(RULES)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured(docs).withColumn("fail_bits", total.cast("long"))


def apply_policy(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to a ledger."""
    failed = lambda p: F.col("fail_bits").bitwiseAND(F.lit(mask_of(p))) != 0
    return rows.withColumns({"base_failed": failed("base"), "kept": ~failed("base") & ~failed(policy)})


def ablations(rows: DataFrame) -> DataFrame:
    """For each policy and rule of it: documents, how many fail the rule, how many fail by it alone.

    The ledger is first counted by its bits, at most two to the number of rules rows.
    """
    counts = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    asked = [
        F.struct(F.lit(policy).alias("policy"), F.lit(rule.name).alias("rule"), F.lit(mask_of(policy)).cast("long").alias("mask"), F.lit(1 << k).cast("long").alias("bit"))
        for policy in POLICIES
        for k, rule in enumerate(RULES)
        if rule.name in POLICIES[policy]
    ]
    each = counts.select("*", F.inline(F.array(*asked)))
    inside = F.col("fail_bits").bitwiseAND(F.col("mask"))
    return each.groupBy("policy", "rule").agg(
        F.sum("n").alias("n_docs"),
        F.sum(F.when(inside.bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(inside == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(inside == 0, F.col("n")).otherwise(0)).alias("n_kept"),
    )


def quality_rules(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """doc_id, the measurements, fail_bits, base_failed and kept of every row of docs.

    An empty or null text has no words and fails ``few_words``; a null doc_id stays null; repeated rows are
    judged each; other columns are left out.
    """
    return apply_policy(ledger(docs), policy)
