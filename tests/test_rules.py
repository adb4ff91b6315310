from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rowsieve import RowSchema
from rowsieve.functions import elapsed_seconds, file_stamp, int_value, literal_rows

SCHEMA = (
    RowSchema()
    .int_column("id", is_nullable=False)
    .string_column("code", is_nullable=False, matches="^[A-Z0-9]+$")
    .string_column("flag", is_nullable=False, matches="N|Y")
    .timestamp_column("day", mask="yyyy-MM-dd", is_nullable=False)
)
COLUMNS = "id string, code string, flag string, day string, note string"
GOOD = ("1", "AB1", "N", "2015-08-31", "kept as is")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def one_column(spark, values):
    return spark.createDataFrame([(value,) for value in values], "v string")


def verdicts(spark, schema, values):
    rows = schema.flag(one_column(spark, values)).collect()
    return {row["v"]: row["_is_valid"] for row in rows}


def test_int_text(spark):
    values = ["12", "12.7", "abc", "99999999999", " 7 ", "", None]
    assert verdicts(spark, RowSchema().int_column("v"), values) == {
        "12": True,
        "12.7": False,
        "abc": False,
        "99999999999": False,
        " 7 ": True,
        "": False,
        None: True,
    }
    wide = verdicts(spark, RowSchema().int_column("v", is_nullable=False, big=True), values)
    assert wide["99999999999"] and not wide[None]


def test_int_text_with_fractions_cut_off(spark):
    values = ["12.7", "-3.", "+4", "1.2.3", "x.5", "99999999999.5", "", None]
    frame = one_column(spark, values)
    got = frame.select("v", int_value(F.col("v"), fractions="truncate").alias("n")).collect()
    assert {row["v"]: row["n"] for row in got} == {
        "12.7": 12,
        "-3.": -3,
        "+4": 4,
        "1.2.3": None,
        "x.5": None,
        "99999999999.5": None,
        "": None,
        None: None,
    }
    with pytest.raises(ValueError):
        int_value(F.col("v"), fractions="round")


def test_date_text(spark):
    values = ["2015-08-31", "2015-13-31", "2015-02-31", "2015-8-3", "2015-08-31 10:00:00", None]
    got = verdicts(spark, RowSchema().timestamp_column("v", mask="yyyy-MM-dd"), values)
    assert got == {value: value in ("2015-08-31", None) for value in values}


def test_pattern_is_searched_unless_full_match(spark):
    values = ["N", "XNY", "q", "", None]
    search = RowSchema().string_column("v", is_nullable=False, matches="N|Y")
    whole = RowSchema().string_column("v", matches="N|Y", full_match=True)
    assert verdicts(spark, search, values) == {
        "N": True, "XNY": True, "q": False, "": False, None: False,
    }
    assert verdicts(spark, whole, values) == {
        "N": True, "XNY": False, "q": False, "": False, None: True,
    }


def test_empty_match_is_no_match(spark):
    got = verdicts(spark, RowSchema().string_column("v", matches="a*"), ["aa", "baa", ""])
    assert got == {"aa": True, "baa": False, "": False}


def test_full_match_does_not_forgive_a_line_end(spark):
    got = verdicts(spark, RowSchema().string_column("v", matches="N", full_match=True), ["N", "N\n"])
    assert got == {"N": True, "N\n": False}


def test_rules_on_typed_columns(spark):
    df = spark.sql("SELECT 12 AS n, 12.0D AS x, DATE'2015-08-31' AS d, 7 AS s")
    schema = (
        RowSchema()
        .int_column("n", is_nullable=False)
        .int_column("x", is_nullable=False)
        .timestamp_column("d", mask="dd/MM/yyyy", is_nullable=False)
        .string_column("s", matches=r"^\d$")
    )
    valid = schema.split(df).valid
    assert dict(valid.dtypes) == {"n": "int", "x": "int", "d": "timestamp", "s": "int"}
    assert valid.count() == 1


def test_split_types_valid_rows_and_keeps_invalid_ones(spark):
    bad = [
        ("x", "AB1", "N", "2015-08-31", "a"),
        ("1", "ab1", "N", "2015-08-31", "b"),
        ("1", "AB1", None, "2015-08-31", None),
        ("1", "AB1", "N", "2015-02-31", ""),
    ]
    split = SCHEMA.split(frame(spark, GOOD, *bad), reasons=True)
    assert split.valid.dtypes == [
        ("id", "int"), ("code", "string"), ("flag", "string"), ("day", "timestamp"),
        ("note", "string"),
    ]
    assert [tuple(row) for row in split.valid.collect()] == [
        (1, "AB1", "N", dt.datetime(2015, 8, 31), "kept as is")
    ]
    got = {tuple(row)[:5]: row["_failed"] for row in split.invalid.collect()}
    assert got == dict(
        zip(bad, [["id:int"], ["code:matches"], ["flag:not_null"], ["day:timestamp"]])
    )


def test_all_valid_all_invalid_and_empty(spark):
    def counted(df):
        return tuple(SCHEMA.counts(df).first())

    assert counted(frame(spark, GOOD, GOOD)) == (2, 0)
    assert counted(frame(spark, (None,) * 5, ("",) * 5)) == (0, 2)
    empty = frame(spark, GOOD).where("false")
    assert counted(empty) == (0, 0)
    assert SCHEMA.split(empty).valid.count() == 0
    assert {row["num_failed"] for row in SCHEMA.failure_counts(empty).collect()} == {0}


def test_validity_agrees_with_the_single_tests(spark):
    from itertools import product

    parts = [("1", "x", None), ("A", "a", None), ("Y", "z", None), ("2020-01-01", "no", None)]
    for nullable in (True, False):
        schema = (
            RowSchema()
            .int_column("id", is_nullable=nullable)
            .string_column("code", is_nullable=nullable, matches="^[A-Z]+$")
            .string_column("flag", is_nullable=nullable)
            .timestamp_column("day", mask="yyyy-MM-dd", is_nullable=nullable)
        )
        rows = [(*row, "n") for row in product(*parts)]
        checked = schema.flag(frame(spark, *rows)).withColumns(
            {f"t{i}": test for i, test in enumerate(schema.tests().values())}
        )
        for row in checked.collect():
            single = [row[f"t{i}"] for i in range(len(schema.tests()))]
            assert None not in single
            assert row["_is_valid"] == all(single) == (row["_failed"] == [])
            assert len(row["_failed"]) == single.count(False)


def test_no_rules_means_all_valid(spark):
    assert tuple(RowSchema().counts(frame(spark, GOOD, (None,) * 5)).first()) == (2, 0)


def test_awkward_column_names(spark):
    df = spark.createDataFrame([("1", "x")], "`a.b` string, `c d` string")
    schema = RowSchema().int_column("a.b", is_nullable=False)
    assert [tuple(row) for row in schema.split(df).valid.collect()] == [(1, "x")]


def test_mistakes_are_refused(spark):
    with pytest.raises(ValueError, match="already has a rule"):
        SCHEMA.int_column("id")
    with pytest.raises(ValueError, match="already has"):
        SCHEMA.flag(frame(spark, GOOD).withColumn("_failed", F.lit(1)))
    for use in (SCHEMA.flag, SCHEMA.counts, SCHEMA.split):
        with pytest.raises(ValueError, match="no column"):
            use(frame(spark, GOOD).drop("code"))


def test_valid_and_invalid_make_up_the_input(spark):
    df = spark.range(0, 5000, 1, 7).select(
        F.when(F.col("id") % 7 == 0, "x").otherwise(F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 11 == 0, None).otherwise("A1").alias("code"),
        F.lit("N").alias("flag"),
        F.lit("2015-08-31").alias("day"),
        F.col("id").cast("string").alias("note"),
    )
    split = SCHEMA.split(df)
    counts = SCHEMA.counts(df).first()
    assert counts["num_valid_rows"] + counts["num_invalid_rows"] == 5000
    assert split.valid.count() == counts["num_valid_rows"]
    assert split.invalid.exceptAll(df).count() == 0
    notes = split.valid.select("note").unionAll(split.invalid.select("note"))
    assert notes.distinct().count() == 5000
    assert tuple(SCHEMA.counts(df.repartition(3)).first()) == tuple(counts)


def test_flagging_works_on_a_stream(spark, tmp_path):
    frame(spark, GOOD, ("x", "AB1", "N", "2015-08-31", "a")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(COLUMNS).parquet(str(tmp_path / "in"))
    query = (
        SCHEMA.flag(stream)
        .writeStream.format("memory")
        .queryName("flagged")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(60)
    got = spark.table("flagged").select("id", "_is_valid").collect()
    assert {row["id"]: row["_is_valid"] for row in got} == {"1": True, "x": False}


def test_the_check_is_one_projection_without_shuffle(spark):
    plan = SCHEMA.flag(frame(spark, GOOD))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_small_helpers(spark):
    assert file_stamp("2023-11-14T22:13:20.000Z") == "2023-11-14T221320.000Z"
    row = spark.range(1).select(
        elapsed_seconds(1900, 3100).alias("s"), file_stamp(F.lit("22:13:20")).alias("t")
    )
    assert tuple(row.first()) == (2, "221320")
    assert literal_rows(spark, [], {"a": "int"}).count() == 0
    assert [tuple(r) for r in literal_rows(spark, [(1, None)], {"a": "int", "b": "string"}).collect()] == [
        (1, None)
    ]


def test_typed_fractions_are_no_integers(spark):
    rows = spark.createDataFrame([(12.7,), (12.0,), (None,)], "n double")
    parts = RowSchema().int_column("n").split(rows)
    assert sorted(r["n"] for r in parts.valid.where("n is not null").collect()) == [12]
    assert parts.invalid.count() == 1
    instants = spark.sql("SELECT timestamp'2020-01-01 00:00:00' AS n")
    assert RowSchema().int_column("n").split(instants).valid.count() == 0
