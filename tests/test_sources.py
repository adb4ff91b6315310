from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from rowsieve import ResultKey, RowSchema, Size, compute_metrics, read_delimited, read_history
from rowsieve import success_metrics
from rowsieve.functions import day_of_millis
from rowsieve.sources import (
    append_metrics,
    append_run_metrics,
    compact_history,
    fresh_path,
    integer_range,
    run_metrics,
    scratch_root,
    write_invalid_csv,
    write_valid_csv,
    write_valid_orc,
)

HEADER = "a\tb\tc\td\te\n"


@pytest.fixture
def tsv(tmp_path):
    def write(*lines, name="in.tsv"):
        path = tmp_path / name
        path.write_text(HEADER + "\n".join(lines))
        return str(path)

    return write


def test_raw_read_takes_names_from_the_header_and_leaves_text(spark, tsv):
    df = read_delimited(spark, tsv("1\tx\ty\tz\t2015-08-31", "q\tx\ty\tz\t"))
    assert df.dtypes == [(name, "string") for name in "abcde"]
    assert [tuple(row) for row in df.collect()] == [
        ("1", "x", "y", "z", "2015-08-31"),
        ("q", "x", "y", "z", None),
    ]


def test_inference_and_explicit_schema(spark, tsv):
    path = tsv("1\t2.5\ttrue\tz\t2015-08-31", "2\t3\tfalse\tz\t2015-08-30")
    assert [kind for _, kind in read_delimited(spark, path, infer=True).dtypes] == [
        "int", "double", "boolean", "string", "date",
    ]
    given = read_delimited(spark, path, schema="a bigint, b string, c string, d string, e string")
    assert given.first()["a"] == 1
    with pytest.raises(ValueError):
        read_delimited(spark, path, schema="a int", infer=True)


def test_quotes(spark, tsv):
    lines = [
        '1\tx\tmid "q" text\tz\te',
        '2\tx\t18"\tz\te',
        '3\tx\t"opens and never closes\tz\te',
        "4\tx\t\tz",
    ]
    rows = {row["a"]: tuple(row)[2:] for row in read_delimited(spark, tsv(*lines)).collect()}
    assert rows["1"] == ('mid "q" text', "z", "e")
    assert rows["2"] == ('18"', "z", "e")
    assert rows["3"][1:] == (None, None) and "never closes\tz\te" in rows["3"][0]
    assert rows["4"] == (None, "z", None)
    plain = read_delimited(spark, tsv(*lines), quote=None).where("a = 3").first()
    assert tuple(plain)[2:] == ('"opens and never closes', "z", "e")


def test_file_name_with_a_comma(spark, tsv):
    df = read_delimited(spark, tsv("1\tx\ty\tz\te", name="lookup_letters,csv"))
    assert df.count() == 1


def test_range_is_held_to_int_max(spark):
    ids = integer_range(spark, 11, 3, clamp=True)
    assert [row["id"] for row in ids.collect()] == list(range(1, 11))
    assert ids.rdd.getNumPartitions() == 3
    near = integer_range(spark, 2**40, 2, start=2**31 - 4, clamp=True)
    assert [row["id"] for row in near.collect()] == [2**31 - 4, 2**31 - 3, 2**31 - 2]


def test_null_and_empty_survive_the_csv_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", "", None), ("x", None, "")], "id string, p string, q string")
    split = RowSchema().int_column("id").split(df, reasons=True)
    out = str(tmp_path)
    valid = write_valid_csv(split.valid, out, "t")
    invalid = write_invalid_csv(split.invalid, out, "t")
    assert valid.endswith("t_valid_csv") and invalid.endswith("t_invalid")
    # On disk null is nothing and empty text is a pair of quotes; a null mark tells them apart.
    read = {"sep": ",", "header": False, "nullValue": "\\N"}
    back = read_delimited(spark, valid, schema="id int, p string, q string", **read)
    assert tuple(back.first()) == (1, "", None)
    back = read_delimited(spark, invalid, schema="id string, p string, q string, f string", **read)
    assert tuple(back.first()) == ("x", None, "", "id:int")


def test_sinks_overwrite(spark, tmp_path):
    for n in (5, 3):
        path = write_valid_orc(spark.range(n), str(tmp_path), "t")
        assert spark.read.orc(path).count() == n


def test_scratch_root_is_the_cluster_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def metrics(spark, rows, name="m"):
    return spark.createDataFrame(rows, "entity string, instance string, name string, value double")


def test_history_by_tag_and_day(spark, tmp_path):
    path = str(tmp_path / "history")
    day = 86_400_000
    for no, (date, tags) in enumerate(
        [(day * 10, {"tag": "a"}), (day * 11, {"tag": "b"}), (day * 12, {"tag": "a", "site": "x"})]
    ):
        append_metrics(metrics(spark, [("Dataset", "*", "Size", float(no))]), path, ResultKey(date, tags))
    tagged = read_history(spark, path, tags={"tag": "a"})
    assert sorted(row["value"] for row in tagged.collect()) == [0.0, 2.0]
    assert [row["value"] for row in read_history(spark, path, tags={"tag": "a", "site": "x"}).collect()] == [2.0]
    recent = read_history(spark, path, first_day="1970-01-12", last_day="1970-01-12")
    assert [row["value"] for row in recent.collect()] == [1.0]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan
    table = success_metrics(tagged, ["tag", "site"])
    assert table.columns == ["entity", "instance", "name", "value", "dataset_date", "tag", "site"]


def test_a_repeated_key_replaces_its_metrics(spark, tmp_path):
    path, key = str(tmp_path / "history"), ResultKey(5, {"tag": "a", "b": "c"})
    again = ResultKey(5, {"b": "c", "tag": "a"})
    append_metrics(
        metrics(spark, [("Dataset", "*", "Size", 1.0), ("Column", "x", "Mean", 4.0)]), path, key,
        written_at=10,
    )
    append_metrics(metrics(spark, [("Dataset", "*", "Size", 2.0)]), path, again, written_at=20)
    got = {row["name"]: row["value"] for row in read_history(spark, path).collect()}
    assert got == {"Size": 2.0, "Mean": 4.0}


def test_metrics_without_value_are_no_success_metrics(spark, tmp_path):
    path = str(tmp_path / "history")
    append_metrics(metrics(spark, [("Column", "x", "Mean", None)]), path, ResultKey(1))
    assert read_history(spark, path).count() == 1
    assert success_metrics(read_history(spark, path)).count() == 0


def test_day_is_the_utc_day():
    assert day_of_millis(1_700_000_000_000) == "2023-11-14"
    assert day_of_millis(-1) == "1969-12-31"


def test_runs_may_be_written_at_the_same_time(spark, tmp_path):
    path = str(tmp_path / "history")

    def write(no):
        append_metrics(
            metrics(spark, [("Dataset", "*", "Size", float(no))]), path, ResultKey(no, {"tag": "a"})
        )

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(write, range(16)))
    found = read_history(spark, path, tags={"tag": "a"}).collect()
    assert sorted(row["value"] for row in found) == [float(no) for no in range(16)]


def test_run_metrics_are_appended(spark, tmp_path):
    counts = spark.createDataFrame([(7, 3)], "num_valid_rows bigint, num_invalid_rows bigint")
    path = str(tmp_path / "runs")
    for end in (4_000, 9_999):
        append_run_metrics(
            run_metrics(counts, job="j", dataset="d", start_millis=1_500, end_millis=end),
            path,
            end_millis=end,
        )
    rows = spark.read.parquet(path).orderBy("ts", "metric").collect()
    assert [(r["metric"], r["value"], r["labels"]) for r in rows[:3]] == [
        ("job_total_duration_sec", 3.0, {"dataset": "d"}),
        ("num_Invalid_Rows_count", 3.0, {"dataset": "d"}),
        ("num_Valid_Rows_count", 7.0, {"dataset": "d"}),
    ]
    assert rows[3]["value"] == 8.0


def test_metrics_go_straight_into_the_history(spark, tmp_path):
    path = str(tmp_path / "history")
    append_metrics(compute_metrics(spark.range(4), [Size()]), path, ResultKey(0))
    assert read_history(spark, path).first()["value"] == 4.0


def test_repeated_appends_read_back_the_last(spark, tmp_path):
    path, key = str(tmp_path / "history"), ResultKey(5, {"tag": "a"})
    for rows in (5, 7, 6):
        append_metrics(compute_metrics(spark.range(rows), [Size()]), path, key)
        assert read_history(spark, path).first()["value"] == float(rows)
    for rows in (3, 4):
        append_metrics(compute_metrics(spark.range(rows), [Size()]), path, key, written_at=2**60)
        assert read_history(spark, path).first()["value"] == float(rows)


def test_history_prunes_days(spark, tmp_path):
    path = str(tmp_path / "history")
    append_metrics(compute_metrics(spark.range(2), [Size()]), path, ResultKey(0))
    append_metrics(compute_metrics(spark.range(3), [Size()]), path, ResultKey(86_400_000))
    recent = read_history(spark, path, first_day="1970-01-02")
    assert recent.first()["value"] == 3.0 and recent.count() == 1
    assert "PartitionFilters: []" not in recent._jdf.queryExecution().executedPlan().toString()


def test_range_is_whole_unless_clamped(spark):
    big = integer_range(spark, 2**31 + 5, 4, start=2**31 - 3)
    assert big.count() == 8
    assert integer_range(spark, 2**31 + 5, 4, start=2**31 - 3, clamp=True).count() == 2


def test_headers_must_agree(spark, tmp_path):
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "1.tsv").write_text("a\tb\n1\t2\n")
    (folder / "2.tsv").write_text("b\ta\n3\t4\n")
    with pytest.raises(Exception, match="header|CSV"):
        read_delimited(spark, str(folder)).collect()


def test_malformed_records_keep_their_text(spark, tmp_path):
    path = tmp_path / "rows.tsv"
    path.write_text("a\tb\n1\t2\n3\t4\t5\n")
    rows = read_delimited(spark, str(path), malformed="_raw").collect()
    assert [tuple(row) for row in rows] == [("1", "2", None), ("3", "4", "3\t4\t5")]


def test_compaction_bounds_the_files_read_and_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "history")
    rows = spark.range(2000).selectExpr(
        "'Dataset' AS entity", "'*' AS instance", "'Size' AS name", "CAST(id AS DOUBLE) AS value",
        "id AS dataset_date", "map('tag', CAST(id % 3 AS STRING)) AS tags", "id AS written_at",
        "date_add(DATE'1970-01-01', CAST(id % 4 AS INT)) AS ds", "format_string('%020d-x', id) AS run",
    )
    rows.repartition(8, "run").write.partitionBy("ds", "run").parquet(path)

    def values():
        return sorted(row["value"] for row in read_history(spark, path).collect())

    def files():
        return len(read_history(spark, path).inputFiles())

    assert files() == 2000
    before = values()
    assert compact_history(spark, path) == 2000
    assert values() == before and files() <= 4
    append_metrics(metrics(spark, [("Dataset", "*", "Size", 5000.0)]), path, ResultKey(5))
    assert values() == [*before, 5000.0] and files() <= 5
    assert [row["value"] for row in read_history(spark, path, tags={"tag": "1"}, last_day="1970-01-01").collect()]
    assert compact_history(spark, path) == 1 and values() == [*before, 5000.0] and files() <= 4
    assert compact_history(spark, path) == 0 and values() == [*before, 5000.0]


def test_appends_during_a_compaction_stay(spark, tmp_path, monkeypatch):
    """One run ends between the listing and the removals, another is still being written."""
    from rowsieve.sources import history

    path, key = str(tmp_path / "history"), ResultKey(5, {"tag": "a"})
    append_metrics(metrics(spark, [("Dataset", "*", "Size", 1.0)]), path, key, written_at=1)
    open_run = append_metrics(metrics(spark, [("Column", "x", "Mean", 2.0)]), path, key, written_at=1)
    (tmp_path / "history" / open_run.split("/")[-2] / open_run.split("/")[-1] / "_temporary").mkdir()
    plain = history.rename

    def renamed(*given):
        append_metrics(metrics(spark, [("Dataset", "*", "Size", 9.0)]), path, key, written_at=2)
        plain(*given)

    monkeypatch.setattr(history, "rename", renamed)
    assert compact_history(spark, path) == 1
    got = {row["name"]: row["value"] for row in read_history(spark, path).collect()}
    assert got == {"Size": 9.0, "Mean": 2.0}

    def broken(*_):
        raise OSError("no rename")

    monkeypatch.setattr(history, "rename", broken)
    with pytest.raises(OSError):
        compact_history(spark, path)
    assert {row["name"]: row["value"] for row in read_history(spark, path).collect()} == got
