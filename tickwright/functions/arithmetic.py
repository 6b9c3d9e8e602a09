"""Column arithmetic with stated rounding. Everything stays a built-in expression.

Longer formulas are SQL text over column names: one call to the JVM each, and easier to read.
"""

from decimal import Decimal

from pyspark.sql import Column, functions as F

from tickwright.schemas import AMOUNT


def amount(price: Column, volume: Column) -> Column:
    """Price times volume, two decimals."""
    return (price * volume).cast(AMOUNT)


def cents(value: str, whole: str = "BIGINT") -> str:
    """SQL: a two-decimal price or amount as a whole number of hundredths."""
    return f"CAST(({value}) * 100 AS {whole})"


def half_up(num: str, den: str, scale: int, precision: int = 20) -> str:
    """SQL: ``num / den`` of whole numbers, half up to ``scale`` decimals; 0 where ``den`` is 0.

    Decimal division in Spark keeps a limited scale, so rounding its result would round twice.
    Whole-number division of ``2*num*10^scale + den`` by ``2*den`` is exact.
    """
    top, bottom = f"CAST(abs({num}) AS DECIMAL(38,0))", f"CAST(abs({den}) AS DECIMAL(38,0))"
    steps = f"({2 * 10**scale} * {top} + {bottom}) div (2 * {bottom})"
    sign = f"CAST(signum({num}) * signum({den}) AS BIGINT)"
    step = f"{Decimal(1).scaleb(-scale):f}BD"
    return (
        f"CAST(CASE WHEN ({den}) = 0 THEN 0 "
        f"ELSE CAST({sign} * ({steps}) AS DECIMAL(19,0)) * {step} END AS DECIMAL({precision},{scale}))"
    )


def half_up_ratio(num: str, den: str, scale: int, precision: int = 20) -> Column:
    """``half_up`` as a column."""
    return F.expr(half_up(num, den, scale, precision))


def whole_quotient(num: str, den: str) -> str:
    """SQL: ``num / den`` of whole numbers, rounded down, up to 32 digits; ``den`` is positive.

    ``div`` gives a long, which is too short here, and a decimal quotient is rounded. What is left over is
    taken off first, so that the quotient is whole.
    """
    return f"CAST(({num} - pmod({num}, {den})) / {den} AS DECIMAL(38,0))"


def root_steps(name: str, steps: str, scale: int) -> list[dict[str, str]]:
    """SQL of columns, one after another: ``name`` is a square root on a grid of ``scale`` decimals, in steps.

    ``steps`` is the square in steps of the same grid; 0 and less give 0. The result is that of averaging
    ``x`` with ``value/x``, each rounded half up, which comes to rest one step above the nearest lower grid
    point as soon as the root is a quarter step past it, not a half step. The root by doubles is made exact
    by one whole-number step.
    """
    square, rough, near, low = (f"{name}_{part}" for part in ("square", "rough", "near", "low"))
    return [
        {square: f"greatest({steps}, 0) * {10**scale}"},
        {rough: f"greatest(CAST(floor(sqrt(CAST({square} AS DOUBLE))) AS DECIMAL(19,0)), 1)"},
        {near: f"floor(({rough} + {whole_quotient(square, rough)}) / 2)"},
        {low: f"CASE WHEN {near} * {near} > {square} THEN {near} - 1 ELSE {near} END"},
        {name: f"CASE WHEN {square} > 0 AND 2 * {square} >= 2 * {low} * {low} + {low} THEN {low} + 1 ELSE {low} END"},
    ]
