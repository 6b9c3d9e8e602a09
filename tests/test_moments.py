import random
from decimal import Decimal

from frames import by_code, edges, levels, limits, listed
from statistics_by_hand import kurtosis, skewness, spread

from tickwright.operators.levels import price_levels
from tickwright.operators.moments import weighted_moments
from tickwright.plans import day_features
from tickwright.schemas import STOCK_DAY
from tickwright.sources.events import event_ticks, lineitem_ticks


def same(row, book):
    """The spread to its tenth decimal; the other two to their eighth, after products of doubles."""
    assert row.price_std == float(spread(book))
    for found, wanted in ((row.price_skewness, skewness(book)), (row.price_kurtosis, kurtosis(book))):
        assert abs(Decimal(found) - wanted) <= Decimal("1e-12") * max(1, abs(wanted))


def check(spark, books):
    """From the levels alone, and in a feature row of a day without ticks, which opens at 0."""
    table = levels(spark, [(code, p, v) for code, book in books.items() for p, v in book])
    wanted = {c for c, book in books.items() if sum(max(v, 0) for _, v in book)}
    found = by_code(weighted_moments(table, STOCK_DAY))
    days = limits(spark, [(c, 1, 2) for c in books])
    rows = by_code(day_features(listed(table), edges(spark, [("other", 1, 1)]), days), "ticket_code")
    assert set(found) == set(rows) == wanted
    for code in wanted:
        book = [(Decimal(str(p)), v) for p, v in books[code]]
        same(found[code], book)
        assert [rows[code][c] for c in ("price_std", "price_skewness", "price_kurtosis")] == [
            found[code][c] for c in ("price_std", "price_skewness", "price_kurtosis")
        ]


def test_random_books(spark):
    chance = random.Random(11)
    books = {}
    for i in range(300):
        middle = chance.choice([80, 1500, 30_000, 250_000])
        width = chance.choice([1, 4, 60, middle // 2])
        prices = {chance.randint(max(1, middle - width), middle + width) for _ in range(40)}
        books[f"c{i}"] = [(p / 100, chance.randint(0, 10 ** chance.randint(0, 7))) for p in prices]
    check(spark, books)


def test_edges(spark):
    check(
        spark,
        {
            "one_level": [(10.25, 100)],
            "one_share": [(10.25, 1)],
            "two_shares": [(10.00, 1), (11.00, 1)],
            "three_shares": [(10.00, 1), (11.00, 1), (15.00, 1)],
            "tiny_variance": [(10.00, 10_000_000), (10.01, 1)],
            "zero_volume": [(10.00, 0), (11.00, 0)],
            "idle_level": [(10.00, 50), (11.00, 0), (12.00, 7)],
            "free": [(0.00, 5), (0.01, 9)],
        },
    )


def test_no_volume_no_row(spark):
    table = levels(spark, [("a", 10, 0), ("a", 11, None), ("b", 10, 5)])
    assert set(by_code(weighted_moments(table, STOCK_DAY))) == {"b"}


def test_high_prices(spark):
    """High prices and large volumes, where doubles far from the mean would lose everything."""
    check(
        spark,
        {
            "tens": [(600_000, 1_000_000), (600_010, 500_000), (600_050, 500_000)],
            "cents": [("600000.00", 1_000_000), ("600000.10", 500_000), ("600000.50", 500_000)],
            "wide": [(1_000_000, 100_000), (1_000_500, 60_000), (1_001_000, 40_000)],
            "large": [("0.01", 9_000_000_000), ("0.02", 7_000_000_000), ("30.00", 123_456_789)],
            "negative": [(10, 100), (12, -30), (15, 50)],
        },
    )


def test_sums_of_any_length(spark):
    """Wrong prices up to 99,999,999.99 and very many shares: sums of more than 38 digits, and powers of more."""
    far = Decimal("99999999.99")
    books = {
        "a": [(far, 100), (Decimal("10.00"), 5000), (Decimal("10.50"), 900)],
        "b": [(Decimal(10), 5), (Decimal(11), 5)],
        "c": [(Decimal(10), 10**14), (Decimal(11), 5)],
        "d": [(Decimal("9000000.00"), 2), (Decimal("1.00"), 3)],
        "e": [(Decimal(1_000_000), 10**12), (Decimal("0.01"), 10**12), (Decimal("123456.78"), 7)],
        "f": [(far, 10**16), (Decimal("0.01"), 8 * 10**16), (Decimal("5.55"), -3)],
        "g": [(far, 1), (Decimal("0.01"), 1)],
        "h": [(far, -50), (Decimal("70000000.00"), 10**9), (Decimal(3), 4 * 10**15)],
    }
    chance = random.Random(5)
    for i in range(60):
        top = chance.choice([10**5, 10**8, 10**10 - 1])
        books[f"r{i}"] = [(Decimal(c) / 100, chance.randint(0, 10 ** chance.randint(0, 15))) for c in {chance.randint(0, top) for _ in range(12)}]
    check(spark, books)


def test_only_beyond_any_volume_is_nothing_known(spark):
    found = by_code(weighted_moments(levels(spark, [("a", 10, 10**17), ("a", 11, 1), ("b", 10, 10**17 - 1000)]), STOCK_DAY))
    assert found["a"].price_std is None and found["a"].price_skewness is None and found["a"].price_kurtosis is None
    assert found["b"].price_std == 0


def test_shared_tables(spark, sf_dir):
    """Every stock-day of the shared tables, against exact decimals."""
    for table in (event_ticks(spark, sf_dir), lineitem_ticks(spark, sf_dir)):
        books = {}
        found = price_levels(table)
        for row in found.collect():
            books.setdefault((row.order_code, row.order_date), []).append((row.price, row.volume_sum))
        rows = weighted_moments(found, STOCK_DAY).collect()
        assert len(rows) == len([b for b in books.values() if sum(v for _, v in b) > 0])
        for row in rows:
            same(row, books[row.order_code, row.order_date])
