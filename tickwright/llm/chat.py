"""Conversations as training windows of a token budget.

The prefix sums of a conversation's turn tokens cut it into cells; the turns that lie in one cell, or one
turn that crosses into the next, are a span. A window is a span with the system turn and a limited history
before it, both repeated and without loss. No step holds a conversation in one task: a window has the turns
of its budget, and prefix sums are made over blocks of turns first.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tickwright.session import shared_dir

BUDGET = 2048
HISTORY = 512
#: A long system turn leaves a span at least so many tokens.
LEAST_SPAN = 512
BLOCK = 256
#: Tokens of the marks around a turn.
TURN_MARKS = 4
OPEN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
#: Where a backslash parts a control string: those of this template and the usual ones of others.
_INSIDE_CONTROL = r"(?<=<)(?=\|)|(?<=\|)(?=>)|(?<=\[)(?=/?INST\])|(?<=<)(?=/?s>)|(?<=<)(?=</?SYS>>)"


def escaped(text: Column) -> Column:
    """Backslashes doubled, then one put inside each control string."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _INSIDE_CONTROL, r"\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_tokens(text: Column) -> Column:
    """Runs of letters, runs of digits and single other signs: what a tokenizer would at least cut."""
    return F.regexp_count(text, F.lit(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]")).cast("long")


def _numbered(turns: DataFrame) -> DataFrame:
    """Adds ``place``, the row's number in its conversation, and ``before``, the tokens ahead of it.

    Rows go by turn, then role and text. Sums are made within blocks of turns, then over the blocks.
    """
    turns = turns.withColumn("block", F.floor(F.col("turn") / BLOCK))
    in_block = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    running = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over_blocks = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = F.sum("cost").alias("cost"), F.count("*").alias("n")
    blocks = turns.groupBy("conv_id", "block").agg(*sums).select(
        F.col("conv_id").alias("b_conv"),
        F.col("block").alias("b_block"),
        F.coalesce(F.sum("cost").over(over_blocks), F.lit(0)).alias("cost_before"),
        F.coalesce(F.sum("n").over(over_blocks), F.lit(0)).alias("n_before"),
    )
    within = turns.withColumns(
        {"run": F.sum("cost").over(running) - F.col("cost"), "row": F.row_number().over(in_block)}
    )
    same = F.col("conv_id").eqNullSafe(F.col("b_conv")) & F.col("block").eqNullSafe(F.col("b_block"))
    return within.join(blocks, same).select(
        *turns.columns,
        (F.col("n_before") + F.col("row")).alias("place"),
        (F.col("cost_before") + F.col("run")).alias("before"),
    )


def format_conversations(
    spark: SparkSession,
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    least_span: int = LEAST_SPAN,
) -> DataFrame:
    """Windows: conv_id, span, formatted, loss_spans, n_turns, n_repeated, tokens, over_budget.

    ``formatted`` is the turns in order, the first ``n_repeated`` of which are repeated; ``loss_spans`` are
    the places (start from 0, length, in code points) of the assistant texts that are new in this window.
    A turn alone larger than a span gets its own window, whole, marked ``over_budget`` if that is past the
    budget. A null role or text is an empty one, null conv_ids are one conversation, turns that are null come
    first, equal turns go by role and text, repeated rows stay. Other columns are left out.

    The turns with their spans are kept in the shared folder, since four steps read them.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("cost", text_tokens(F.col("text")) + TURN_MARKS)
    placed = _numbered(turns)
    is_system = (F.col("place") == 1) & (F.col("role") == "system")
    system = placed.where(is_system)
    system_cost = system.select(F.col("conv_id").alias("s_conv"), F.col("cost").alias("system_cost"))
    placed = placed.join(system_cost, F.col("conv_id").eqNullSafe(F.col("s_conv")), "left").withColumn(
        "system_cost", F.coalesce("system_cost", F.lit(0))
    )
    # The system turn stands before the others' count and opens the first span.
    start = F.when(is_system, 0).otherwise(F.col("before") - F.col("system_cost"))
    cell = F.greatest(F.lit(budget - history) - F.col("system_cost"), F.lit(least_span))
    cut = placed.withColumns({"start": start, "cell": cell, "system": is_system}).withColumn(
        "end", F.when(F.col("system"), F.col("start")).otherwise(F.col("start") + F.col("cost"))
    )
    at, last = F.floor(F.col("start") / F.col("cell")), F.floor((F.col("end") - 1) / F.col("cell"))
    crosses = (last > at) & (F.col("start") % F.col("cell") != 0) & ~F.col("system")
    path = shared_dir(spark, "turns")
    cut.withColumn("span", 2 * at + crosses.cast("long")).write.parquet(path)
    home = spark.read.parquet(path)
    spans = home.groupBy("conv_id", "span", "cell").agg(F.min("start").alias("span_start")).select(
        F.col("conv_id").alias("w_conv"),
        F.col("span").alias("w_span"),
        F.col("span_start"),
        F.floor(F.col("span_start") / F.col("cell")).alias("w_cell"),
    )
    # A turn is history of the spans that start within ``history`` tokens of it, in a few cells.
    reach = F.sequence(
        F.floor(F.col("end") / F.col("cell")), F.floor((F.col("start") + history) / F.col("cell"))
    )
    repeated = (
        home.where(~F.col("system") & (F.col("end") <= F.col("start") + history))
        .withColumn("near", F.explode(reach))
        .join(spans, F.col("conv_id").eqNullSafe(F.col("w_conv")) & (F.col("near") == F.col("w_cell")))
        .where(F.col("span_start").between(F.col("end"), F.col("start") + history))
    )
    retained = home.where("system").join(
        spans, F.col("conv_id").eqNullSafe(F.col("w_conv")) & (F.col("w_span") > F.col("span"))
    )
    shown = ["conv_id", "span", "place", "role", "text", "cost", "new"]
    again = [
        rows.withColumn("span", F.col("w_span")).withColumn("new", F.lit(False)).select(*shown)
        for rows in (repeated, retained)
    ]
    members = home.withColumn("new", F.lit(True)).select(*shown).unionByName(again[0]).unionByName(again[1])
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(SAYS))
    pieces = members.select(
        "conv_id",
        "span",
        F.struct(
            "place",
            "new",
            "cost",
            head.alias("head"),
            escaped(F.col("text")).alias("body"),
            ((F.col("role") == "assistant") & F.col("new")).alias("target"),
        ).alias("piece"),
    )
    gathered = pieces.groupBy("conv_id", "span").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    whole = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    # (characters so far, spans so far), piece by piece
    empty = F.struct(F.lit(0).alias("chars"), F.expr("CAST(array() AS array<struct<start:int,length:int>>)").alias("spans"))

    def step(a: Column, p: Column) -> Column:
        head_chars, body_chars = F.char_length(p["head"]), F.char_length(p["body"])
        span = F.struct((a["chars"] + head_chars).alias("start"), body_chars.alias("length"))
        spans = F.when(p["target"], F.concat(a["spans"], F.array(span))).otherwise(a["spans"])
        return F.struct((a["chars"] + head_chars + body_chars + len(END)).alias("chars"), spans.alias("spans"))

    tokens = F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["cost"])
    return gathered.select(
        "conv_id",
        "span",
        whole.alias("formatted"),
        F.aggregate("pieces", empty, step, lambda a: a["spans"]).alias("loss_spans"),
        F.size("pieces").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: ~p["new"])).alias("n_repeated"),
        tokens.alias("tokens"),
        (tokens > budget).alias("over_budget"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Each conversation's turns and loss text from its windows alone.

    One row for each conversation, whose digests need all its text in one row.
    """
    turns = F.slice(F.split("formatted", r"<\|end\|>", -1), F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    role = lambda t: F.substring_index(t, SAYS, 1).substr(F.lit(len(OPEN) + 1), F.char_length(t))
    text = lambda t: F.substring_index(t, SAYS, -1)
    said = F.transform(turns, lambda t: F.concat(unescaped(role(t)), F.lit("\n"), unescaped(text(t)), F.lit("\n")))
    loss = F.transform("loss_spans", lambda s: unescaped(F.col("formatted").substr(s["start"] + 1, s["length"])))
    parts = windows.select(
        "conv_id",
        F.struct("span", F.array_join(said, "").alias("said"), F.array_join(loss, "").alias("loss")).alias("part"),
        (F.col("n_turns") - F.col("n_repeated")).alias("n"),
        F.char_length("formatted").alias("chars"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.sort_array(F.collect_list("part")).alias("parts"),
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
        F.count("*").alias("n_windows"),
    )
    joined = whole.select(
        "*",
        F.array_join(F.col("parts.said"), "").alias("said"),
        F.array_join(F.col("parts.loss"), "").alias("loss"),
    )
    return joined.select(
        "conv_id",
        F.col("n_turns").cast("long").alias("n_turns"),
        F.sha2("said", 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
        "n_windows",
    )
