from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, text
from millrace.operators import cleaning
from millrace.sources import readers, schema, writers


def values(spark, rule, items):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(rule("x")).collect()]


def test_normalize_text_traps(spark):
    got = values(spark, text.normalize_text, ["ERROR", "unknown", " NaN ", "", " ", None, "  A   b\tC "])
    assert got == [None] * 6 + ["a b c"]


def test_parse_number_traps(spark):
    got = values(spark, text.parse_number, ["$1,50", "1.234.56", "-3", "ERROR", None, "12 usd", "abc"])
    assert got == [1.5, None, -3.0, None, None, 12.0, None]


def test_drop_error_rows_also_drops_null(spark):
    df = spark.createDataFrame([("error",), (None,), ("5",)], "total string")
    assert [r.total for r in cleaning.drop_error_rows(df, "total").collect()] == ["5"]


def test_timestamp_layout_order(spark):
    items = ["3/4/2023", "25/12/2023", "2023-09-08", "11/8/2016", "not a date", None, "2023-09-08 10:20:30"]
    month_first = values(spark, dates.parse_timestamp, items)
    assert [x and x.date() for x in month_first] == [
        dt.date(2023, 3, 4), dt.date(2023, 12, 25), dt.date(2023, 9, 8), dt.date(2016, 11, 8), None, None, dt.date(2023, 9, 8),
    ]
    day_first = values(
        spark, lambda c: dates.parse_timestamp(c, dates.ISO_THEN_DAY_FIRST, fallback=False), items
    )
    assert day_first[0] == dt.datetime(2023, 4, 3)
    assert day_first[6] == dt.datetime(2023, 9, 8, 10, 20, 30)


def test_dates_are_parsed_before_the_scrub(spark):
    df = spark.createDataFrame([("11/8/2016", "a/b*c")], "day string, name string")
    row = cleaning.scrub_strings(df.withColumn("day", dates.parse_date("day"))).first()
    assert row.day == dt.date(2016, 11, 8) and row.name == "abc"


def test_magnitudes(spark):
    assert values(spark, text.parse_magnitude, ["290.4 million", "x", None]) == [290.4, None, None]
    items = ["90–100 million", "90-100 million", "600 million500 million", "500 million", "12.5", None, "n/a"]
    assert values(spark, text.parse_range_or_concat, items) == [95.0, 95.0, 600.0, 500.0, 12.5, None, None]


def test_category_fixes(spark):
    assert values(spark, text.normalize_category, ["limon", " San Jose ", "CARTAGO", None]) == [
        "Limón", "San José", "Cartago", None,
    ]


def test_impute_median_keeps_present_values_and_rounds(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None), (None, 4.0), (10.0, 9.0), (None, 10.0)], "a double, b double")
    got = cleaning.impute_median(df, {"a": None, "b": 0}).collect()
    assert sorted(r.a for r in got) == [1.0, 2.0, 2.0, 2.0, 10.0]
    assert sorted(r.b for r in got) == [1.0, 4.0, 7.0, 9.0, 10.0]  # 6.5 rounds half up


def test_impute_median_of_an_empty_column_stays_null(spark):
    df = spark.createDataFrame([(None, 1)], "a double, b int")
    assert cleaning.impute_median(df, {"a": None}).first().a is None


def test_non_numeric_rows_include_blank(spark):
    df = spark.createDataFrame([(" ",), ("1.5",), (None,), ("x",)], "a string")
    assert sorted(r.a for r in cleaning.non_numeric_rows(df, "a").collect()) == [" ", "x"]


def test_duplicate_and_null_reports(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None)], "x int, y string")
    assert cleaning.duplicate_count(df).first().duplicates == 2
    report = {r["column"]: (r["nulls"], r["percent"]) for r in cleaning.null_report(df).collect()}
    assert report == {"x": (0, 0.0), "y": (1, 25.0)}
    counts = {r["column"]: r["n_distinct"] for r in cleaning.cardinality_report(df).collect()}
    assert counts == {"x": 2, "y": 1}


def test_csv_round_trip_and_encoding(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes("Provincia , Total\nLimón,3\nSan José,4\n".encode("latin-1"))
    raw = schema.clean_column_names(readers.read_csv(spark, str(path), encoding="ISO-8859-1"))
    assert raw.dtypes == [("Provincia", "string"), ("Total", "string")]
    assert {r.Provincia for r in raw.collect()} == {"Limón", "San José"}
    typed = readers.read_csv(spark, str(path), infer=True, encoding="ISO-8859-1")
    assert schema.clean_column_names(typed).dtypes[1] == ("Total", "int")
    out = str(tmp_path / "out")
    writers.write_csv(raw, out)
    writers.write_csv(raw, out)
    assert readers.read_csv(spark, out).count() == 2


def test_key_counts_round_trip(spark, tmp_path):
    out = str(tmp_path / "counts")
    df = spark.createDataFrame([("Limón|2026-01-06", 27)], "key string, total long")
    writers.write_delimited(df, out)
    back = readers.read_delimited(spark, out, ["key", "total"], ["string", "bigint"])
    row = back.select(text.split_key("key", 0).alias("p"), text.split_key("key", 1).alias("d"), "total").first()
    assert tuple(row) == ("Limón", "2026-01-06", 27)


def test_tables_and_results(spark, tmp_path):
    out = str(tmp_path / "result")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, g string")
    writers.write_result(df, out, ["g"])
    spark.read.parquet(out).createOrReplaceTempView("stored_result")
    assert readers.read_table(spark, "stored_result").count() == 2


def test_find_column(spark):
    df = spark.createDataFrame([("a", "b", "c")], "`Fecha y Hora` string, Genero string, ` Provincia ` string")
    assert schema.find_column(df, ["provincia"]) == " Provincia "
    assert schema.find_column(df, ["fecha"], mode="contains") == "Fecha y Hora"
    assert schema.find_column(df, ["nope"], fallback=2) == " Provincia "
    with pytest.raises(KeyError):
        schema.find_column(df, ["nope"])


def test_preview_tail_needs_an_order(spark):
    df = spark.range(10)
    assert [r.id for r in schema.preview(df, 3, ["id"], tail=True).collect()] == [9, 8, 7]
    with pytest.raises(ValueError):
        schema.preview(df, 3, tail=True)


def test_filter_numeric_reads_raw_text(spark):
    df = spark.createDataFrame([("12300000.5",), ("1.23E7",), ("-4",), ("",)], "a string")
    kept = cleaning.filter_numeric(df, ["a"]).agg(F.collect_set("a")).first()[0]
    assert set(kept) == {"12300000.5", "-4"}
