"""Volume-weighted spread, skewness and kurtosis of the prices of a stock-day.

The three statistics are central moments of prices in whole hundredths. Power sums are kept as whole numbers,
those of higher powers in two or three parts, and are added up before the shuffle. Moving them to the mean and
rounding are whole-number arithmetic too, down to the spread's tenth decimal. Where 38 digits hold all of it, it
is decimal arithmetic; for other keys the same sums go through whole numbers of any length (``functions/wide.py``).
"""

import re
from math import comb

from pyspark.sql import DataFrame, functions as F

from tickwright.functions import cents, root_steps, whole_quotient
from tickwright.functions.wide import from_decimals, half_up_quotients, products, sums, to_decimal, to_double

_WHOLE = "DECIMAL(38,0)"


# A price of c hundredths has c * c = 1e10 h + l; then c**3 and c**4 follow from h and l. Every part of a sum has 38
# digits as long as a key has fewer than 1e17 shares. Columns: part of a sum, and what it adds for each share.
_PARTS = {
    "s1": ("c",),
    "s2h": ("h",),
    "s2l": ("l",),
    "s3h": ("h", "c"),
    "s3l": ("l", "c"),
    "s4a": ("h", "h"),
    "s4b": ("h", "l"),
    "s4c": ("l", "l"),
}
_ABOVE = {"t1": "s1", "t2h": "s2h", "t2l": "s2l"}
_TERM = "DECIMAL(31,0)"


def with_moment_terms(levels: DataFrame) -> DataFrame:
    """Add what each level gives to the power sums."""
    whole = levels.selectExpr("*", "coalesce(volume_sum, 0) AS shares", f"{cents('price')} AS c")
    parted = whole.selectExpr(
        "*", "c div 100000 AS c_high", "c % 100000 AS c_low"
    ).selectExpr(
        "*",
        "c_high * c_high + (2 * c_high * c_low) div 100000 AS h",
        "(2 * c_high * c_low) % 100000 * 100000 + c_low * c_low AS l",
    )
    wide = {name: f"CAST({name} AS DECIMAL(11,0))" for name in "chl"}
    first = [f"CAST(CAST(shares AS DECIMAL(19,0)) * {wide[parts[0]]} AS {_TERM}) AS x_{name}" for name, parts in _PARTS.items() if len(parts) == 1]
    terms = parted.selectExpr("*", *first)
    second = []
    for name, parts in _PARTS.items():
        if len(parts) == 2:
            before = {"h": "x_s2h", "l": "x_s2l"}[parts[0]]
            second.append(f"CAST(try_multiply({before}, {wide[parts[1]]}) AS {_WHOLE}) AS x_{name}")
    return terms.selectExpr("*", *second)


def moment_sums() -> list:
    """Power sums of levels that carry the terms.

    ``n`` counts shares and ``s1`` to ``s4`` are the sums, in parts; ``t``, ``t1`` and ``t2`` are the same without
    negative volumes, which the spread leaves out. ``lo``, ``hi`` and ``mass`` tell what fits.
    """
    above = "CASE WHEN shares > 0 THEN {0} ELSE 0 END"
    texts = {"n": "sum(shares)", "t": f"sum({above.format('shares')})"}
    texts |= {name: f"CAST(try_sum(x_{name}) AS {_WHOLE})" for name in _PARTS}
    texts |= {name: f"CAST(try_sum({above.format(f'x_{part}')}) AS {_WHOLE})" for name, part in _ABOVE.items()}
    texts |= {
        "lo": "min(c)",
        "hi": "max(c)",
        "mass": "sum(CAST(abs(shares) AS DOUBLE))",
    }
    return [F.expr(text).alias(name) for name, text in texts.items()]


def _half_up(num: str, den: str) -> str:
    """SQL: ``num / den`` of whole numbers, half up, also below zero; ``den`` is positive."""
    return whole_quotient(f"(2 * {num} + {den})", f"(2 * {den})")


def _about_near(order: int) -> str:
    """SQL: the power sum of the given order after every price has been lowered by ``near``."""
    terms = []
    for j, total in enumerate(["n", "s1", "s2", "s3", "s4"][: order + 1]):
        terms.append(" * ".join([f"{(-1) ** (order - j) * comb(order, j)}", total, *["near"] * (order - j)]))
    return " + ".join(terms)


# What 38 digits hold: a key without negative volumes whose prices are not too far from the mean.
_FITS = (
    "t = n AND mass < 4e12D AND power(reach, 4D) * mass < 5e36D AND power(spread, 2D) * mass < 1e21D "
    "AND power(spread, 3D) * mass < 1e31D AND power(spread, 4D) < 1e31D"
)
#: From so many shares on the parts of the sums may not fit.
_MOST_SHARES = "1e17D"
#: What a key's sums are made into: both variances, and the third and fourth moment in steps of eight decimals.
_MOMENTS = ["a_var", "b_var", "third", "fourth"]

# Columns, one step after another. Power sums u1 to u4 are about the hundredth next to the mean; the means are steps
# a (1e-8 hundredths, for the spread) and b (1e-6) from there. Squares of a hundredth are 1e-4, hence the powers of ten.
# Third and fourth moment are divided part by part: whole quotients, and what is left with what is finer.
_MOMENT_STEPS = [
    {f"u{k}": _about_near(k) for k in (1, 2, 3, 4)},
    {"a": _half_up("100000000 * u1", "n"), "b": _half_up("1000000 * u1", "n"), "most": whole_quotient("u4", "n")},
    {
        "a2": f"{10**16}BD * u2 - 200000000 * a * u1 + n * a * a",
        "b2": f"{10**12}BD * u2 - 2000000 * b * u1 + n * b * b",
        "b3": "1000000 * u3 - 3 * b * u2",
        "b3_fine": "b * b * (3000000 * u1 - n * b)",
        "b4": "1000000 * (u4 - most * n) - 4 * b * u3",
    },
    {
        "a_var": _half_up("a2", f"({10**10}BD * n)"),
        "b_var": _half_up("b2", "(100000000 * greatest(n - 1, 1))"),
        "c": whole_quotient("b3", "(10000 * n)"),
        "more": whole_quotient("b4", "(1000000 * n)"),
    },
    {
        "c_left": f"{10**12}BD * (b3 - c * 10000 * n) + b3_fine",
        "d4": "1000000 * (b4 - more * 1000000 * n) + 6 * b * b * u2",
    },
    # Half of a step goes up, away from zero: below zero, down.
    {
        "below": f"CASE WHEN c < -1000 OR (c <= 1000 AND c * {10**16}BD * n + c_left < 0) THEN 1 ELSE 0 END",
        "rest": whole_quotient("d4", f"({10**12}BD * n)"),
    },
    {
        "third": "c + " + whole_quotient(f"(2 * c_left + {10**16}BD * n - below)", f"({2 * 10**16}BD * n)"),
        "fourth": "most + more + rest + "
        + _half_up(f"({10**12}BD * (d4 - rest * {10**12}BD * n) + b * b * b * (n * b - 4000000 * u1))", f"({10**24}BD * n)"),
    },
]


def _worked_out(steps: list[dict[str, str]], wanted: str) -> str:
    """SQL: ``wanted`` made step by step in one expression from the columns of a row.

    Each step is a struct that the next ones read.
    """
    home: dict[str, str] = {}

    def at_home(text: str) -> str:
        return re.sub(r"(?<![.'\w])[a-z]\w*", lambda m: f"{home[m[0]]}.{m[0]}" if m[0] in home else m[0], text)

    opening = ""
    for k, step in enumerate(steps):
        fields = ", ".join(f"'{name}', {at_home(text)}" for name, text in step.items())
        opening += f"transform(array(named_struct({fields})), z{k} -> "
        home |= {name: f"z{k}" for name in step}
    return f"{opening}{at_home(wanted)}" + ")[0]" * len(steps)


def _of_any_length() -> str:
    """SQL: a struct of the moments in steps as above, from sums of any length.

    With the mean in whole steps of 1e-6 hundredths (1e-8 for the spread), the central moments are sums of products
    of whole numbers; only the last quotient is rounded. The fourth moment may have more than 38 digits: a double.
    """

    def mean(total: str, count: str, grid: int) -> str:
        return f"signum({total}) * {whole_quotient(f'(abs({total}) * {2 * grid}BD + {count})', f'(2 * {count})')}"

    def of(array: str, names: str) -> dict[str, str]:
        return {name: f"{array}[{k}]" for k, name in enumerate(names.split())}

    decimals = "s1 t1 t2h t2l s2h s2l s3h s3l s4a s4b s4c n t m a less".split()
    limb = {name: f"limbs[{k}]" for k, name in enumerate(decimals)}
    limb |= of("joined", "t2 s2 s3 s4") | of("squares", "a2 m2") | of("powers", "m3 m4")
    pairs = "a.t1 t.a2 m.s1 n.m2 m.s2 m2.s1 n.m3 m.s3 m2.s2 m3.s1 n.m4".split()
    limb |= {pair: f"mixed[{k}]" for k, pair in enumerate(pairs)}

    def total(*terms: tuple[int, str, int]) -> list[tuple[int, str, int]]:
        return [(factor, limb[name], shift) for factor, name, shift in terms]

    def pair(names: str) -> tuple[str, str]:
        a, b = names.split(".")
        return limb[a], limb[b]

    def divisor(name: str) -> str:
        return f"named_struct('limbs', {limb[name]}, 'value', CAST({name} AS {_WHOLE}))"

    steps = [
        {"m": f"CASE WHEN n > 1 THEN {mean('s1', 'n', 10**6)} ELSE 0 END", "a": mean("t1", "t", 10**8), "less": "greatest(n - 1, 1)"},
        {"limbs": from_decimals(*decimals)},
        {
            "joined": sums(
                total((10, "t2h", 1), (1, "t2l", 0)), total((10, "s2h", 1), (1, "s2l", 0)),
                total((10, "s3h", 1), (1, "s3l", 0)), total((100, "s4a", 2), (20, "s4b", 1), (1, "s4c", 0)),
            ),
            "squares": products(pair("a.a"), pair("m.m")),
        },
        {"powers": products(pair("m2.m"), pair("m2.m2"))},
        {"mixed": products(*map(pair, pairs))},
        {
            "totals": sums(
                total((10**7, "t2", 1), (-2 * 10**8, "a.t1", 0), (1, "t.a2", 0)),
                total((1000, "s2", 1), (-2 * 10**6, "m.s1", 0), (1, "n.m2", 0)),
                total((1, "s3", 2), (-3000, "m.s2", 1), (3 * 10**6, "m2.s1", 0), (-1, "n.m3", 0)),
                total((10**6, "s4", 2), (-4, "m.s3", 2), (6000, "m2.s2", 1), (-4 * 10**6, "m3.s1", 0), (1, "n.m4", 0)),
            )
        },
        # Over 1e10 t, 1e8 (n - 1), 1e16 n and 1e24 n.
        {
            "quotients": half_up_quotients(
                ("totals[0]", 10, 1, divisor("t")), ("totals[1]", 10**8, 0, divisor("less")),
                ("totals[2]", 10**7, 1, divisor("n")), ("totals[3]", 10**6, 2, divisor("n")),
            )
        },
    ]
    steps[0] = {name: f"CAST({text} AS {_WHOLE})" for name, text in steps[0].items()}
    made = [f"'{name}', {to_decimal(f'quotients[{k}]')}" for k, name in enumerate(_MOMENTS[:3])]
    return _worked_out(steps, f"named_struct({', '.join(made)}, 'fourth', {to_double('quotients[3]')})")


_DEVIATION = "(CAST(b_root AS DOUBLE) / 1e8D)"
_SHARES = "CAST(n AS DOUBLE)"
_STATISTICS = {
    "price_std": "CAST(CAST(a_root AS DECIMAL(20,0)) * 0.0000000001BD AS DOUBLE)",
    "price_skewness": "CASE WHEN n < 3 OR b_root = 0 THEN 0D "
    f"ELSE round(CAST(third AS DOUBLE) / 1e8D / power({_DEVIATION}, 3D), 8) "
    f"* round({_SHARES} / (({_SHARES} - 1) * ({_SHARES} - 2)), 8) END",
    "price_kurtosis": "CASE WHEN n < 2 OR b_root = 0 THEN 0D "
    f"ELSE round(fourth / 1e8D / power({_DEVIATION}, 4D), 8) - 3 END",
}


def with_moments(sums: DataFrame) -> DataFrame:
    """Replace the power sums by ``price_std``, ``price_skewness`` and ``price_kurtosis``.

    Keys without positive volume have no spread and are left out.

    Rounding follows each statistic's definition step by step: the mean, the variance, the root and each
    quotient are rounded (10 decimals for the spread, 8 for the other two). The spread divides by all shares
    and leaves out volumes that are not positive; the other two take the variance over one share less.
    Skewness is multiplied by ``V/((V-1)(V-2))`` on top of dividing by ``V``. A variance that rounds to zero
    gives 0. Every price has its statistics; only a key of 1e17 shares and more has none.
    """
    names = ["n", "t", *_PARTS, *_ABOVE, "lo", "hi", "mass"]
    kept = [c for c in sums.columns if c not in names]

    def add(steps: DataFrame, guard: str, step: dict[str, str]) -> DataFrame:
        return steps.selectExpr("*", *[f"CASE WHEN {guard} THEN CAST({text} AS {_WHOLE}) END AS {name}" for name, text in step.items()])

    steps = sums.where("t > 0").selectExpr(
        *[f"CAST({c} AS {_WHOLE}) AS {c}" if c in ("n", "t") else c for c in sums.columns],
        f"CASE WHEN mass < {_MOST_SHARES} THEN {_half_up('t1', f'CAST(t AS {_WHOLE})')} END AS near",
        "CAST(greatest(abs(lo), abs(hi)) AS DOUBLE) AS reach",
    )
    steps = steps.selectExpr("*", "CAST(greatest(hi - near, near - lo) AS DOUBLE) AS spread")
    steps = steps.selectExpr("*", f"{_FITS} AS fits")
    rejoined = {
        "s2": "s2h * 10000000000BD + s2l",
        "s3": "s3h * 10000000000BD + s3l",
        "s4": "s4a * 100000000000000000000BD + s4b * 20000000000BD + s4c",
    }
    for step in [rejoined, *_MOMENT_STEPS]:
        steps = add(steps, "fits", step)
    steps = steps.selectExpr("*", f"CASE WHEN NOT fits AND mass < {_MOST_SHARES} THEN {_of_any_length()} END AS wide")
    steps = steps.selectExpr(
        *kept, "n", "mass", *[f"CASE WHEN fits THEN {name} ELSE wide.{name} END AS {name}" for name in _MOMENTS]
    )
    for a, b in zip(root_steps("a_root", "a_var", 10), root_steps("b_root", "b_var", 8)):
        steps = add(steps, "a_var IS NOT NULL", a | b)
    known = f"mass < {_MOST_SHARES}"
    return steps.selectExpr(*kept, *[f"CASE WHEN {known} THEN {text} END AS {name}" for name, text in _STATISTICS.items()])


def weighted_moments(levels: DataFrame, keys: list[str]) -> DataFrame:
    """Spread, skewness and kurtosis per key. A key without positive volume has no spread: no row.

    Levels are sent by key and summed where they meet. Where keys are many, a task that summed first would hold sums
    of nearly every key and send them, and those are twenty times as wide as a level.
    """
    terms = with_moment_terms(levels.where(F.col("price").isNotNull()).repartition(*keys))
    return with_moments(terms.groupBy(*keys).agg(*moment_sums())).select(
        *keys, "price_std", "price_skewness", "price_kurtosis"
    )
