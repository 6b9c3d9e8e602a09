"""Whole numbers of any length as SQL text: arrays of limbs to base 1e9, the lowest first.

A number is the sum of its limbs times their powers of the base; limbs may be negative. Sums and products are kept
to ``LIMBS`` limbs, as in two's complement: a highest limb of half the base or more stands for a negative number.
All of it is array functions of Spark, meant for a few rows a key and not for every tick. Every function works on
an array of numbers at once, which keeps the text, and so the plan, short.
"""

from itertools import count

from tickwright.functions.arithmetic import whole_quotient

LIMBS = 14
_BASE = "1000000000L"
_WHOLE = "DECIMAL(38,0)"
_serial = count()


def _names(n: int) -> list[str]:
    """Names for lambda variables that nothing else has."""
    return [f"w{next(_serial)}" for _ in range(n)]


def _let(values: list[str], body) -> str:
    """``body`` of names for values, each of which is worked out once."""
    (held,) = _names(1)
    fields = ", ".join(f"'v{k}', {value}" for k, value in enumerate(values))
    return f"transform(array(named_struct({fields})), {held} -> {body(*[f'{held}.v{k}' for k in range(len(values))])})[0]"


def _each(values: list[str], body) -> str:
    (x,) = _names(1)
    return f"transform(array({', '.join(values)}), {x} -> {body(x)})"


def from_decimals(*numbers: str) -> str:
    """Limbs of whole numbers of up to 38 digits."""
    part = "1000000000000000000BD"

    def limbs(sign: str, low: str, high: str) -> str:
        (y,) = _names(1)
        middle = f"CAST(pmod({high}, {part}) AS BIGINT)"
        parts = [f"{low} % {_BASE}", f"{low} div {_BASE}", f"{middle} % {_BASE}", f"{middle} div {_BASE}", f"CAST({whole_quotient(high, part)} AS BIGINT)"]
        return f"transform(array({', '.join(parts)}), {y} -> {sign} * {y})"

    def halves(v: str) -> str:
        low = f"CAST(pmod(abs({v}), {part}) AS BIGINT)"
        return _let([f"CAST(signum({v}) AS BIGINT)", low, whole_quotient(f"abs({v})", part)], limbs)

    return _each([f"CAST({x} AS {_WHOLE})" for x in numbers], halves)


def _carried(raw: str) -> str:
    """Limbs from 0 to the base; what is carried out of the last one is a limb of its own, up to ``LIMBS``."""
    s, x, end = _names(3)
    moved = f"pmod({x} + {s}.carry, {_BASE})"
    return (
        f"aggregate({raw}, named_struct('out', CAST(array() AS ARRAY<BIGINT>), 'carry', 0L), "
        f"({s}, {x}) -> named_struct('out', concat({s}.out, array({moved})), 'carry', ({x} + {s}.carry - {moved}) div {_BASE}), "
        f"{end} -> slice(concat({end}.out, array({end}.carry)), 1, {LIMBS}))"
    )


def products(*pairs: tuple[str, str]) -> str:
    """Products of pairs of numbers, one of which has at most nine limbs that aren't 0."""

    def product(pair: str) -> str:
        k, i, total = _names(3)
        a, b = f"{pair}.a", f"{pair}.b"
        places = f"sequence(0, least(size({a}) + size({b}) - 2, {LIMBS - 1}))"
        meet = f"sequence(greatest(0, {k} - size({b}) + 1), least({k}, size({a}) - 1))"
        return _carried(f"transform({places}, {k} -> aggregate({meet}, 0L, ({total}, {i}) -> {total} + {a}[{i}] * {b}[{k} - {i}]))")

    return _each([f"named_struct('a', {a}, 'b', {b})" for a, b in pairs], product)


def _sum(terms: str) -> str:
    total, term, y, k = _names(4)
    more = f"transform({total}, ({y}, {k}) -> {y} + {term}.factor * coalesce(get({term}.number, {k} - {term}.shift), 0L))"
    return _carried(f"aggregate({terms}, array_repeat(0L, {LIMBS}), ({total}, {term}) -> {more})")


def _terms(terms: list[tuple[str, str, str]]) -> str:
    fields = [f"named_struct('factor', {factor}, 'number', {number}, 'shift', {shift})" for factor, number, shift in terms]
    return f"array({', '.join(fields)})"


def sums(*sums_of: list[tuple[int, str, int]]) -> str:
    """Sums of numbers, each times a factor and a power of the base, in ``LIMBS`` limbs."""
    return _each([_terms([(f"{factor}L", number, str(shift)) for factor, number, shift in terms]) for terms in sums_of], _sum)


def _over(limbs: str, divisor: str) -> str:
    """The whole quotient of a number that isn't negative by one of up to 28 digits."""
    s, x, end = _names(3)
    here = f"CAST({s}.left * 1000000000BD + {x} AS {_WHOLE})"
    return (
        f"aggregate(reverse({limbs}), named_struct('out', CAST(array() AS ARRAY<BIGINT>), 'left', CAST(0 AS {_WHOLE})), "
        f"({s}, {x}) -> named_struct('out', concat(array(CAST({whole_quotient(here, divisor)} AS BIGINT)), {s}.out), "
        f"'left', CAST(pmod({here}, {divisor}) AS {_WHOLE})), {end} -> {end}.out)"
    )


def half_up_quotients(*quotients: tuple[str, int, int, str]) -> str:
    """Totals over a positive divisor times a factor and a power of the base, half away from zero.

    Totals have ``LIMBS`` limbs; divisors are limbs with a value: ``struct<limbs, value>``. A result is a struct of a
    sign and the limbs of a number that isn't negative.
    """

    def quotient(q: str) -> str:
        (x,) = _names(1)
        sign = f"CASE WHEN {q}.total[{LIMBS - 1}] >= 500000000L THEN -1L ELSE 1L END"
        size = _carried(f"transform({q}.total, {x} -> {sign} * {x})")
        twice = _sum(_terms([("2L", size, "0"), (f"{q}.factor", f"{q}.divisor.limbs", f"{q}.shift")]))
        # Whole quotients of whole quotients are whole quotients of the product.
        cut = f"slice({twice}, {q}.shift + 1, {LIMBS} - {q}.shift)"
        return f"named_struct('sign', {sign}, 'limbs', {_over(_over(cut, f'CAST(2 * {q}.factor AS {_WHOLE})'), f'{q}.divisor.value')})"

    return _each(
        [f"named_struct('total', {total}, 'factor', {factor}L, 'shift', {shift}, 'divisor', {divisor})" for total, factor, shift, divisor in quotients],
        quotient,
    )


def to_decimal(quotient: str) -> str:
    """Of one of ``half_up_quotients``, up to 38 digits."""
    total, x = _names(2)
    steps = f"CAST({total} * 1000000000BD + {x} AS {_WHOLE})"
    return f"CAST({quotient}.sign * aggregate(reverse({quotient}.limbs), CAST(0 AS {_WHOLE}), ({total}, {x}) -> {steps}) AS {_WHOLE})"


def to_double(quotient: str) -> str:
    """The nearest double up to 36 digits, to the last few bits beyond."""
    total, x, y = _names(3)
    rough = f"{quotient}.sign * aggregate(reverse({quotient}.limbs), 0D, ({total}, {x}) -> {total} * 1e9D + {x})"
    return f"CASE WHEN exists(slice({quotient}.limbs, 5, {LIMBS}), {y} -> {y} <> 0) THEN {rough} ELSE CAST({to_decimal(quotient)} AS DOUBLE) END"
