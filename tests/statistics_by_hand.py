"""Spread, skewness and kurtosis in exact decimals, straight from their definitions.

Levels are pairs of price and volume.
"""

from decimal import ROUND_HALF_UP, Decimal, getcontext
from math import sqrt

getcontext().prec = 80


def to_places(value: Decimal, places: int) -> Decimal:
    return value.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)


def settled(value: Decimal, places: int) -> Decimal:
    """Average of x and value/x, rounded at each step, until it stays."""
    if value <= 0:
        return Decimal(0)
    x, seen = to_places(Decimal(sqrt(value)), places), None
    while x != seen:
        seen, x = x, to_places((x + to_places(value / x, places)) / 2, places)
    return x


def central(levels, places, power):
    shares = sum(v for _, v in levels)
    mean = to_places(sum(p * v for p, v in levels) / shares, places)
    return sum((p - mean) ** power * v for p, v in levels)


def spread(levels):
    levels = [(p, v) for p, v in levels if v > 0]
    shares = sum(v for _, v in levels)
    return settled(to_places(central(levels, 10, 2) / shares, 10), 10)


def deviation(levels):
    shares = sum(v for _, v in levels)
    if shares < 2:
        return Decimal(0)
    return settled(to_places(central(levels, 8, 2) / (shares - 1), 8), 8)


def skewness(levels):
    shares, sd = Decimal(sum(v for _, v in levels)), deviation(levels)
    if shares < 3 or sd == 0:
        return Decimal(0)
    ratio = to_places(to_places(central(levels, 8, 3) / shares, 8) / sd**3, 8)
    return ratio * to_places(shares / ((shares - 1) * (shares - 2)), 8)


def kurtosis(levels):
    shares, sd = Decimal(sum(v for _, v in levels)), deviation(levels)
    if shares == 0 or sd == 0:
        return Decimal(0)
    return to_places(to_places(central(levels, 8, 4) / shares, 8) / sd**4, 8) - 3
