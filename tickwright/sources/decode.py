"""Turning untyped rows and JSON messages into ticks, and setting aside what is not a tick."""

from pyspark.sql import Column, DataFrame, functions as F

from tickwright.functions import parse_day
from tickwright.schemas import TICK_JSON_NAMES, TICK_REQUIRED, TICKS


def _typed(name: str, text: Column, whole_default: int | None = None) -> Column:
    target = TICKS[name].dataType.simpleString()
    if target == "bigint" and whole_default is not None:
        text = F.coalesce(text, F.lit(str(whole_default)))
    value = parse_day(text) if target == "date" else text.try_cast(target)
    return value.alias(name)


def decode_positional(rows: DataFrame, fields: str = "fields") -> DataFrame:
    """An array of 14 texts per row, in the order of the tick schema, to typed columns.

    A text that does not fit its type gives null; see ``split_rejected``.
    """
    return rows.select(
        *[_typed(f.name, F.get(F.col(fields), i)) for i, f in enumerate(TICKS.fields)]
    )


def decode_json(rows: DataFrame, message: str = "value") -> DataFrame:
    """A JSON object per message (text or bytes) to typed columns.

    A whole number that the message leaves out is 0; other fields it leaves out are null.
    """
    layout = ", ".join(f"{name} string" for name in TICK_JSON_NAMES)
    parsed = rows.select(F.from_json(F.col(message).cast("string"), layout).alias("tick"))
    return parsed.select(
        *[
            _typed(f.name, F.col("tick").getField(name), whole_default=0)
            for f, name in zip(TICKS.fields, TICK_JSON_NAMES)
        ]
    )


def split_rejected(ticks: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """The ticks with every required field present, and the others.

    With ``strict`` the first incomplete tick fails the job instead of being left out.
    """
    required = [name for name in TICK_REQUIRED if name in ticks.columns]
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    rejected = ticks.where(~complete)
    if strict:
        complete = F.when(complete, True).otherwise(
            F.raise_error(F.lit("tick without a required field")).cast("boolean")
        )
    return ticks.where(complete), rejected
