"""Column helpers: exact half-up averages, decimal minor units, name normalisation, half-even conversion."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions.dates import months_between_boundaries
from tillroll.functions.money import avg_half_up, minor_to_major
from tillroll.functions.names import normalize_name
from tillroll.operators import reconcile


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=400), min_size=1, max_size=60))
def test_avg_half_up_is_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "d int")
    got = df.agg(avg_half_up("d", 2).alias("a")).first()["a"]
    want = (Decimal(sum(values)) / Decimal(len(values))).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    assert got == float(want)


def test_avg_half_up_ties_and_empty(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (2,)] * 10 + [(None,)], "d int")  # mean 1.75 exactly
    assert df.agg(avg_half_up("d", 1).alias("a")).first()["a"] == 1.8
    empty = spark.createDataFrame([(None,)], "d int")
    assert empty.agg(avg_half_up("d", 2).alias("a")).first()["a"] is None


def test_minor_units_and_months(spark):
    df = spark.createDataFrame([(12345, "2024-01-31", "2024-02-01")], "c long, a string, b string")
    r = df.select(minor_to_major("c").alias("m"),
                  months_between_boundaries(F.to_date("a"), F.to_date("b")).alias("mb")).first()
    assert r["m"] == Decimal("123.45") and r["mb"] == 1


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ &.,-éÅß", min_size=0, max_size=20), min_size=1, max_size=10))
def test_normalize_name_is_idempotent(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string").select(normalize_name("n").alias("x"))
    once = [r["x"] for r in df.collect()]
    twice = [r["x"] for r in df.select(normalize_name("x").alias("x")).collect()]
    assert once == twice and all(x == x.strip() and "  " not in x for x in once)


def test_conversion_rounds_half_even(spark):
    totals = spark.createDataFrame([("P", "EUR", Decimal("0.125")), ("Q", "EUR", Decimal("0.135")),
                                    ("R", "GBP", Decimal("2.345")), ("S", "XXX", Decimal("1.000"))],
                                   "`Publisher Name` string, `Invoicing Currency` string, "
                                   "`Purchase Price In Invoicing Currency` decimal(10,3)")
    rates = spark.createDataFrame([("EUR", Decimal("1.000000"))], "currency string, rate_to_gbp decimal(14,6)")
    out = {r["Publisher Name"]: r["Converted to GBP"] for r in reconcile.convert_to_gbp(totals, rates).collect()}
    assert out == {"P": Decimal("0.12"), "Q": Decimal("0.14"), "R": Decimal("2.34"), "S": None}
