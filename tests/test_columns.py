"""Scalar helpers on the edge rows listed in FIXTURES.md §3."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from zonescope.functions import columns as C


def _eval(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_clean_numeric(spark):
    values = ["1 234,50 EUR", "", None, "abc", "-5", "1.234,5", "12.", "1e5", "45 min", "n/a"]
    assert _eval(spark, values, C.clean_numeric) == [1234.5, None, None, None, -5.0, None, 12.0, 15.0, 45.0, None]


def test_parse_date(spark):
    values = ["2024-02-15", "15/02/2024", "2024/02/15", "2024-02-31", "2024-02-15\n", "inconnue", None]
    d = dt.date(2024, 2, 15)
    assert _eval(spark, values, C.parse_date) == [d, d, None, None, None, None, None]


def test_truthy_flag(spark):
    values = ["oui", "TRUE", "1", "t", "Yes", "1.0", "non", "0", "vrai", "", None, "0.0"]
    assert _eval(spark, values, C.truthy_flag) == [1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0]


def test_missing_markers(spark):
    values = ["NA", "n/a", "null", "NaN", "", "Paris", "0"]
    assert _eval(spark, values, C.missing_to_null) == [None, None, None, None, None, "Paris", "0"]


def test_price_per_m2(spark):
    df = spark.createDataFrame([(1000.0, 0.0), (1000.0, None), (1000.0, -2.0), (1000.0, 4.0)], "v double, s double")
    got = [r[0] for r in df.select(C.price_per_m2("v", "s")).collect()]
    assert got == [None, None, None, 250.0]


def test_to_int_and_double(spark):
    assert _eval(spark, ["3", "3.0", "3.5", "abc", ""], C.to_int) == [3, 3, None, None, None]
    assert _eval(spark, ["43.5", "x", ""], C.to_double) == [43.5, None, None]


def test_month_start(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 15),), (None,)], "d date")
    assert [r[0] for r in df.select(C.month_start("d")).collect()] == [dt.date(2024, 2, 1), None]


def test_fingerprint_matches_md5(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    got = df.select(C.fingerprint("x", "y", "z")).first()[0]
    assert got == hashlib.md5(b"a||||c").hexdigest()


def test_grid_cell_levels(spark):
    df = spark.createDataFrame([(45.123, 3.456), (None, 3.0), (95.0, 1.0)], "lat double, lon double")
    rows = df.select(C.grid_cell("lat", "lon", 8).alias("g8"), C.grid_cell("lat", "lon", 9).alias("g9")).collect()
    g8, g9 = rows[0]
    _, r8, c8 = g8.split(":")
    _, r9, c9 = g9.split(":")
    assert int(r9) // 2 == int(r8) and int(c9) // 2 == int(c8)
    assert rows[1] == (None, None) and rows[2] == (None, None)


def test_round_half_up(spark):
    got = _eval(spark, [1.005, 2.675, -1.005, None], lambda c: C.round_half_up(c, 2), "double")
    assert got == [1.01, 2.68, -1.01, None]


@pytest.mark.parametrize(
    "name,expected",
    [(" Code Commune ", "code_commune"), ("Valeur foncière", "valeur_fonci_re"), ("__x--y__", "x_y"),
     ("nombre_pieces_principales", "nombre_pieces_principales")],
)
def test_normalize_column_name(name, expected):
    assert C.normalize_column_name(name) == expected


def test_normalize_collision_raises():
    with pytest.raises(ValueError):
        C.normalize_column_names(["Code Commune", "code-commune"])


def test_rounding_away_from_ties_needs_no_decimal_and_gives_the_same(spark):
    from pyspark.sql import functions as F

    from zonescope.functions.columns import round_half_up

    r = F.rand(5)
    values = F.array(r * 100000, r, (F.rand(6) - 0.5) * 1e10, (F.floor(r * 1000000) + 0.5) / 1000000, -(F.floor(r * 100000) + 0.5) / 1000,
                     F.rand(9) * 1e17, F.lit(float("nan")), F.lit(float("inf")), F.lit(-0.0), F.lit(None).cast("double"))
    rows = spark.range(2000).select(F.explode(values).alias("x"))
    for digits in (3, 6):
        wide = F.round(F.col("x").try_cast(f"decimal(28,{digits + 4})"), digits).cast("double")
        assert rows.where(~round_half_up("x", digits).eqNullSafe(wide)).count() == 0
    assert "CASE WHEN" in str(round_half_up(F.col("x"), 3)._jc)
