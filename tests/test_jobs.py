"""Whole jobs over a delimited file of 24 rows shaped like real trouble."""

from __future__ import annotations

import glob

import pytest

from rowsieve import (
    Check,
    ResultKey,
    RowSchema,
    enrich,
    read_delimited,
    read_history,
    run_gate,
    run_profile,
    run_verification,
    success_metrics,
)
from rowsieve.plans import jobs, published_gate, run_published_gate
from rowsieve.sources import discard, retire, scratch_root

NAMES = "id parent product title stars votes vine headline body day".split()

RULES = (
    RowSchema()
    .int_column("id", is_nullable=False)
    .string_column("product", is_nullable=False, matches="^[A-Z0-9]+$")
    .int_column("parent", is_nullable=False)
    .string_column("vine", is_nullable=False, matches="N|Y")
    .timestamp_column("day", mask="yyyy-MM-dd", is_nullable=False)
)


def line(no, *, id=None, product="B00X", stars=5, headline="fine", body="ok", day="2015-08-31"):
    fields = [
        id or str(100 + no), str(7000 + no), product, 'ring 18"', str(stars), str(no % 3), "N",
        headline, body, day,
    ]
    return "\t".join(fields)


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    lines = [line(no, stars=5 if no % 6 else 4) for no in range(20)]
    lines += [
        line(20, headline='"opens a quote', body="so fast"),  # swallows body and day
        line(21, id="555", day="2015-13-31"),
        line(22, id="555", day="2015-02-31"),
        line(23, id="101", product="x00X"),
    ]
    path = tmp_path_factory.mktemp("in") / "reviews.tsv"
    path.write_text("\t".join(NAMES) + "\n" + "\n".join(lines))
    return read_delimited(spark, str(path))


def test_gate(spark, source, tmp_path):
    out, runs = str(tmp_path / "out"), str(tmp_path / "runs")
    done = run_gate(
        source, RULES, out, "gate", dataset="reviews.tsv", reasons=True, metrics_path=runs,
        start_millis=1_000, end_millis=5_500,
    )
    assert (done.num_valid_rows, done.num_invalid_rows) == (20, 4)
    valid = spark.read.orc(done.valid_orc)
    kinds = dict(valid.dtypes)
    assert (kinds["id"], kinds["day"], kinds["stars"]) == ("int", "timestamp", "string")
    assert valid.columns == NAMES and valid.count() == 20
    assert read_delimited(spark, done.valid_csv, sep=",", header=False).count() == 20
    names = [*NAMES, "failed"]
    schema = ", ".join(f"{name} string" for name in names)
    bad = read_delimited(spark, done.invalid_csv, sep=",", header=False, schema=schema).collect()
    assert {row["parent"]: row["failed"] for row in bad} == {
        "7020": "day:not_null",
        "7021": "day:timestamp",
        "7022": "day:timestamp",
        "7023": "product:matches",
    }
    gauges = {row["metric"]: row["value"] for row in spark.read.parquet(runs).collect()}
    assert gauges == {
        "num_Valid_Rows_count": 20.0,
        "num_Invalid_Rows_count": 4.0,
        "job_total_duration_sec": 4.0,
    }


def test_gate_leaves_no_settings_or_staging_behind(spark, source, tmp_path):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    run_gate(source, RULES, str(tmp_path), "tidy-gate", dataset="d")
    assert spark.conf.get(key) == before
    assert not glob.glob(f"{scratch_root(spark)}/rowsieve/tidy-gate-staging-*")


def test_only_scratch_tables_are_discarded(spark, tmp_path):
    with pytest.raises(ValueError, match="not a scratch table"):
        discard(spark, str(tmp_path))


def test_gate_without_invalid_or_without_any_rows(spark, source, tmp_path):
    for condition, expected in [("id = '100'", (1, 0)), ("id = '555'", (0, 2)), ("false", (0, 0))]:
        done = run_gate(source.where(condition), RULES, str(tmp_path), "gate", dataset="d")
        assert (done.num_valid_rows, done.num_invalid_rows) == expected
        assert spark.read.schema("id int").orc(done.valid_orc).count() == expected[0]


def test_gate_may_replace_its_own_source(spark, tmp_path):
    path = str(tmp_path / "t_valid_orc")
    spark.sql("SELECT '1' AS id UNION ALL SELECT 'x'").write.orc(path)
    done = run_gate(
        spark.read.orc(path), RowSchema().int_column("id"), str(tmp_path), "t", dataset="t"
    )
    assert done.valid_orc == path and (done.num_valid_rows, done.num_invalid_rows) == (1, 1)
    assert [row["id"] for row in spark.read.orc(path).collect()] == [1]


def test_enriched_gate(spark, source, tmp_path):
    lookup = tmp_path / "lookup_stars,csv"
    lookup.write_text("stars,description\n" + "\n".join(f"{n},{n} stars" for n in range(1, 6)))
    enriched = enrich(source, read_delimited(spark, str(lookup), sep=","), "stars", ["description"])
    done = run_gate(enriched, RULES, str(tmp_path / "out"), "gate", dataset="reviews.tsv")
    assert (done.num_valid_rows, done.num_invalid_rows) == (20, 4)
    rows = spark.read.orc(done.valid_orc)
    assert rows.columns == [*NAMES, "description"]
    assert {row["description"] for row in rows.collect()} == {"4 stars", "5 stars"}


def test_verification(spark, source, tmp_path):
    checks = [
        Check("Error", "review rows")
        .has_size("value = 5")
        .is_complete("id")
        .is_unique("id")
        .is_complete("parent")
        .is_contained_in("vine", ["Y", "N"])
        .is_non_negative("votes"),
        Check("Warning", "star spread").has_approx_quantile("stars", 0.5, "value <= 10"),
    ]
    history = str(tmp_path / "history")
    key = ResultKey(1_700_000_000_000, {"tag": "demo", "site": "a"})
    run = run_verification(source, checks, history, key)
    assert run.status().first()["status"] == "Error"
    failed = {row["constraint"]: row["message"] for row in run.failures().collect()}
    assert set(failed) == {"Size", "Uniqueness(id)"}
    assert failed["Uniqueness(id)"].startswith("value 0.833333")
    run_verification(source.limit(3), checks, history, ResultKey(1_700_000_100_000, {"tag": "x"}))
    stored = success_metrics(read_history(spark, history, tags={"tag": "demo"}), ["tag"])
    assert stored.count() == 7
    # judged from the stored rows: the source is not read again
    assert "FileScan csv" not in run.results._jdf.queryExecution().executedPlan().toString()


def test_verification_under_one_key_is_replaced(spark, tmp_path):
    history, key = str(tmp_path / "history"), ResultKey(5, {"tag": "a"})
    check = [Check("Error", "c").has_size("value = 3")]
    assert run_verification(spark.range(2), check, history, key).status().first()[0] == "Error"
    assert run_verification(spark.range(3), check, history, key).status().first()[0] == "Success"


def test_profile(spark, source, tmp_path):
    done = run_profile(source, str(tmp_path), "reviews.tsv", "2023-11-14T22:13:20.000Z")
    assert done.profile_json.endswith("/profile/2023-11-14T221320.000Z_reviews.tsv.json")
    rows = {row["column"]: row for row in done.profile.collect()}
    assert rows["body"]["completeness"] == pytest.approx(23 / 24)
    assert rows["day"]["inferred_datatype"] == "String"
    assert rows["stars"]["inferred_datatype"] == "Integral" and rows["stars"]["maximum"] == 5.0
    assert spark.read.json(done.profile_json).first()["run_ts"] == "2023-11-14T22:13:20.000Z"
    stars = {r["value"]: r["absolute"] for r in done.histograms.where("column = 'stars'").collect()}
    assert stars == {"5": 20, "4": 4}
    vine = done.histograms.where("column = 'vine'").first()
    assert (vine["value"], vine["absolute"], vine["ratio"]) == ("N", 24, 1.0)
    assert done.histogram_json.endswith("_reviews.tsv_histograms.json")
    # both parts are read from what was saved, not computed again
    for part in (done.profile, done.histograms):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "FileScan json" in plan and "FileScan csv" not in plan


def test_profile_without_low_cardinality_columns(spark, tmp_path):
    done = run_profile(spark.range(1000), str(tmp_path), "ids", "2023-11-14T22:13:20Z", threshold=5)
    assert done.histograms is None


def test_a_broken_run_leaves_the_published_outputs_whole(spark, source, tmp_path, monkeypatch):
    """Whichever of the three writes fails, readers see the run before, all of it."""

    def rows():
        paths = published_gate(spark, str(tmp_path), "reviews")
        return [
            sorted(map(str, spark.read.orc(paths["valid_orc"]).collect())),
            *[sorted(map(str, spark.read.csv(paths[name]).collect())) for name in ("valid_csv", "invalid_csv")],
        ]

    with pytest.raises(FileNotFoundError):
        published_gate(spark, str(tmp_path), "reviews")
    run_published_gate(source, RULES, str(tmp_path), "reviews", dataset="d")
    first = rows()
    assert all(first)
    for name in ("write_valid_orc", "write_valid_csv", "write_invalid_csv", "publish"):
        with monkeypatch.context() as patch:

            def fails(*_):
                raise OSError("disk gone")

            patch.setattr(jobs, name, fails)
            with pytest.raises(OSError, match="disk gone"):
                run_published_gate(source.where("false"), RULES, str(tmp_path), "reviews", dataset="d")
        assert rows() == first
    metrics = str(tmp_path / "gauges")
    run_published_gate(source.where("false"), RULES, str(tmp_path), "reviews", dataset="d", metrics_path=metrics)
    assert rows() == [[], [], []] and spark.read.parquet(metrics).count() == 3
    assert retire(spark, str(tmp_path / "reviews")) == 1 and rows() == [[], [], []]
