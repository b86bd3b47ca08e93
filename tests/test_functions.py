from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from support import values
from pyspark.sql import functions as F

from siltstone.functions import amounts, dates, keys, text


def one(spark, column, **inputs):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()] or [F.lit(1)])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("sci-fi", "Sci-Fi"),
        ("  HELLO wORLD", "  Hello World"),
        ("don't stop", "Don't Stop"),
        ("a/b&c_d", "A/B&C_D"),
        ("élan vital", "Élan Vital"),
        ("", ""),
        (None, None),
    ],
)
def test_initcap_breaks_on_punctuation(spark, given, expected):
    assert one(spark, text.initcap_words(F.lit(given).cast("string"))) == expected


@pytest.mark.parametrize("given", ["don't stop", "o'neil-smith", "BUDI bin 3rd", "ärger"])
def test_title_case_is_pythons(spark, given):
    assert one(spark, text.title_case(F.lit(given))) == given.title()


def test_whitespace(spark):
    assert one(spark, text.collapse_whitespace(F.lit(" a \n b\t"))) == "a b"
    assert one(spark, text.path_safe(F.lit("12/Pid.B/2024/PN Jkt"))) == "12_Pid.B_2024_PN_Jkt"


def test_md5_key_keeps_null_slots_and_plain_numbers(spark):
    rows = spark.createDataFrame(
        [(1, None, dt.datetime(2024, 1, 2, 3, 4, 5), 1.5e7, 12.5), (2, "x", None, 0.0005, 3.0)],
        "a long, b string, c timestamp_ntz, d double, e double",
    )
    got = dict(values(keys.with_md5_key(rows, ["a", "b", "c", "d", "e"]), "a", "md5_key"))
    assert got[1] == hashlib.md5(b"1||2024-01-02 03:04:05|15000000.0|12.5").hexdigest()
    assert got[2] == hashlib.md5(f"2|x||{0.0005}|3.0".encode()).hexdigest()


def test_sha256_id_comes_first_and_needs_its_columns(spark):
    rows = spark.createDataFrame([(1, "b")], "a long, b string")
    keyed = keys.with_sha256_id(rows, ["a", "b"], "id")
    assert keyed.columns == ["id", "a", "b"]
    assert keyed.first()["id"] == hashlib.sha256(b"1-b").hexdigest()
    with pytest.raises(ValueError):
        keys.with_sha256_id(rows, ["nope"], "id")


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("13 Januari 2025", dt.date(2025, 1, 13)),
        ("1 Nopember 2024", dt.date(2024, 11, 1)),
        ("1 november 2024", dt.date(2024, 11, 1)),
        ("30 Februari 2024", None),
        ("3 March 2024", None),
        ("13 Januari", None),
        ("pada 13 Januari 2025", None),
        ("—", None),
        (None, None),
    ],
)
def test_indonesian_date(spark, given, expected):
    assert one(spark, dates.indonesian_date(F.lit(given).cast("string"))) == expected


def test_indonesian_date_inside_text(spark):
    assert one(spark, dates.indonesian_date_within(F.lit("44 tahun/10 Januari 1980"))) == dt.date(1980, 1, 10)
    assert one(spark, dates.indonesian_date_within(F.lit("44 tahun"))) is None


def test_whole_minutes_truncates(spark):
    start, end = dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 2)
    rows = spark.createDataFrame([(start, end)], "a timestamp_ntz, b timestamp_ntz")
    assert rows.select(dates.whole_minutes(F.col("a"), F.col("b"))).first()[0] == 1


def test_driver_side_months():
    assert dates.add_months(dt.date(2024, 4, 30), -2) == dt.date(2024, 2, 29)
    assert dates.add_months(dt.date(2024, 12, 31), 2) == dt.date(2025, 2, 28)
    assert dates.add_months(dt.date(2024, 1, 15), -13) == dt.date(2022, 12, 15)
    assert dates.first_month_on_or_after(dt.date(2024, 4, 1)) == dt.date(2024, 4, 1)
    assert dates.first_month_on_or_after(dt.date(2024, 12, 2)) == dt.date(2025, 1, 1)


def test_run_date_is_jakartas(spark):
    instant = F.lit("2024-05-31 18:00:00").cast("timestamp_ntz").cast("timestamp")
    assert one(spark, dates.run_date(instant)) == dt.date(2024, 6, 1)


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("4076 Ribu", 4_076_000),
        ("1,250.5 jt", 1_250_500_000),
        ("2 T", 2_000_000_000_000),
        ("7 orang", 7),
        ("1,234", 1234),
        ("1.234", 1),
        ("12.9", 12),
        ("1.0000005 juta", 1_000_001),
        ("1.2.3", None),
        ("a b c", None),
        ("n/a", None),
        ("", None),
        (None, None),
    ],
)
def test_amount_from_text(spark, given, expected):
    # 1.0000005 is kept to six decimals, half up.
    assert one(spark, amounts.amount_from_text(F.lit(given).cast("string"))) == expected


def test_exact_mean_skips_nulls_and_empty(spark):
    rows = spark.createDataFrame([(0.1,), (0.2,), (None,)], "x double")
    assert rows.agg(amounts.exact_mean(F.col("x"))).first()[0] == 0.15
    assert rows.where("x > 5").agg(amounts.exact_mean(F.col("x"))).first()[0] is None
