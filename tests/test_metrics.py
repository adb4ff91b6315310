from __future__ import annotations

import math
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowsieve import (
    ApproxDistinct,
    ApproxQuantile,
    Completeness,
    Compliance,
    Containment,
    Maximum,
    Mean,
    Minimum,
    NonNegative,
    Size,
    StandardDeviation,
    Uniqueness,
    compute_metrics,
    exact_quantiles,
)


def values(df, *metrics):
    return {
        (row["name"], row["instance"]): row["value"] for row in compute_metrics(df, metrics).collect()
    }


def one(df, metric):
    (value,) = values(df, metric).values()
    return value


@pytest.fixture(scope="module")
def keys(spark):
    rows = [(1, "a"), (2, "a"), (2, "b"), (3, None), (3, "c"), (3, "c"), (None, None), (None, "d")]
    return spark.createDataFrame(rows, "k bigint, s string")


def test_uniqueness_counts_once_only_values(keys):
    # k: 1 once, 2 twice, 3 three times -> 1 of 6; pairs: (3,c) twice, five others once -> 5 of 7
    got = values(keys, Uniqueness(("k",)), Uniqueness(("k", "s")), Uniqueness(("s",)))
    assert got[("Uniqueness", "k")] == pytest.approx(1 / 6)
    assert got[("Uniqueness", "k,s")] == pytest.approx(5 / 7)
    assert got[("Uniqueness", "s")] == pytest.approx(2 / 6)


def test_uniqueness_is_the_same_alone_together_and_by_digest(keys):
    alone = one(keys, Uniqueness(("k", "s")))
    together = values(keys, Uniqueness(("k", "s")), Uniqueness(("k",)))
    assert together[("Uniqueness", "k,s")] == pytest.approx(alone)
    assert one(keys, Uniqueness(("k", "s"), digest=True)) == pytest.approx(alone)


def test_uniqueness_keys_are_read_in_one_scan(keys, spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    metrics = [Uniqueness(("l_orderkey", "l_linenumber")), Uniqueness(("l_partkey",)), Size()]
    plan = compute_metrics(df, metrics)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    assert "l_comment" not in plan and "l_shipdate" not in plan


def test_many_uniqueness_keys_go_in_batches(spark):
    df = spark.range(3).select(*[F.col("id").alias(f"c{i}") for i in range(130)])
    got = values(df, *[Uniqueness((f"c{i}",)) for i in range(130)])
    assert len(got) == 130 and set(got.values()) == {1.0}


def test_scan_metrics(spark):
    rows = [(1.0, "Y"), (-2.0, "N"), (None, None), (5.0, "Q")]
    df = spark.createDataFrame(rows, "x double, f string")
    got = values(
        df,
        Size(), Completeness("x"), Containment("f", ("Y", "N")), NonNegative("x"),
        Compliance("x above 0", "x > 0"), Minimum("x"), Maximum("x"), Mean("x"),
        StandardDeviation("x"), ApproxDistinct("f"), ApproxQuantile("x", 0.5),
    )
    assert got == {
        ("Size", "*"): 4.0,
        ("Completeness", "x"): 0.75,
        ("Compliance", "f contained in Y,N"): 0.75,
        ("Compliance", "x is non-negative"): 0.75,
        ("Compliance", "x above 0"): 0.5,
        ("Minimum", "x"): -2.0,
        ("Maximum", "x"): 5.0,
        ("Mean", "x"): pytest.approx(4 / 3),
        ("StandardDeviation", "x"): pytest.approx(statistics.pstdev([1, -2, 5])),
        ("ApproxCountDistinct", "f"): 3.0,
        ("ApproxQuantile-0.5", "x"): 1.0,
    }


def test_non_negative_text(spark):
    df = spark.createDataFrame([("-1",), ("0",), ("abc",), (None,), ("-0.5",)], "v string")
    assert one(df, NonNegative("v")) == 3 / 5


def test_the_median_of_an_even_count_is_the_lower_middle(spark):
    df = spark.createDataFrame([(v,) for v in (0, 0, 4, 10)], "v int")
    assert one(df, ApproxQuantile("v", 0.5)) == 0.0
    assert exact_quantiles(df, [("v", 0.5)]).first()["value"] == 0.0


def test_an_empty_table_has_no_shares(spark):
    df = spark.createDataFrame([], "k int, s string")
    got = values(
        df, Size(), Completeness("k"), Uniqueness(("k",)), Uniqueness(("k", "s")),
        Containment("s", ("a",)), NonNegative("k"), ApproxQuantile("k", 0.5), Mean("k"),
    )
    assert got.pop(("Size", "*")) == 0.0
    assert set(got.values()) == {None} and len(got) == 7


def test_repeated_metrics_are_computed_once_and_conflicts_refused(keys):
    assert compute_metrics(keys, [Size(), Size(), Completeness("k")]).count() == 2
    with pytest.raises(ValueError, match="two ways"):
        compute_metrics(keys, [ApproxQuantile("k", 0.5), ApproxQuantile("k", 0.5, 10)])
    with pytest.raises(ValueError):
        compute_metrics(keys, [])


def test_metrics_do_not_depend_on_partitioning(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    metrics = [
        Size(), Uniqueness(("o_custkey",)), Containment("o_orderstatus", ("O",)),
        Minimum("o_totalprice"), ApproxDistinct("o_custkey"),
    ]
    assert values(df, *metrics) == values(df.repartition(13), *metrics)


def test_a_hot_key_with_most_rows(spark):
    df = spark.range(0, 100_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    )
    hot = sum(1 for i in range(100_000) if i % 3 == 0)
    assert one(df, Uniqueness(("k",))) == pytest.approx((100_000 - hot) / 100_000)


@pytest.mark.parametrize("settle_rows", [10, 1000, 100_000])
@pytest.mark.parametrize("shape", ["spread", "hot", "few", "constant", "negative"])
def test_exact_quantiles_against_sorting(spark, shape, settle_rows):
    rng = random.Random(7)
    n = 20_000
    draw = {
        "spread": lambda: rng.random() * 1e6,
        "hot": lambda: 42.0 if rng.random() < 0.4 else rng.random() * 100,
        "few": lambda: float(rng.randrange(4)),
        "constant": lambda: 3.0,
        "negative": lambda: rng.gauss(0, 1) * 10 ** rng.randrange(-5, 9),
    }[shape]
    numbers = [draw() for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in [*numbers, None]], "v double").repartition(8)
    ordered = sorted(numbers)
    targets = [("v", q) for q in (0.0, 0.001, 0.4, 0.5, 0.999, 1.0)]
    for row in exact_quantiles(df, targets, settle_rows=settle_rows).collect():
        rank = max(1, math.ceil(row["quantile"] * n))
        assert row["value"] == ordered[rank - 1], (row, shape)


def test_exact_quantile_ranks_are_exact(spark):
    df = spark.range(1, 101)
    targets = [("id", i / 100) for i in (7, 14, 28, 29, 55, 56, 57, 58)]
    got = {row["quantile"]: row["value"] for row in exact_quantiles(df, targets).collect()}
    assert got == {i / 100: float(i) for i in (7, 14, 28, 29, 55, 56, 57, 58)}


def test_exact_quantile_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v int")
    assert exact_quantiles(df, [("v", 0.5)]).first()["value"] is None


def test_exact_quantile_recovers_from_a_wrong_bracket(spark):
    """Whatever the summary says, ranks are counted: a bad bracket costs a scan, not the answer."""
    from rowsieve.operators.quantiles import _Search

    df = spark.range(1, 1001).select(F.col("id").alias("v"))
    for low, high in [(900, 950), (10, 20)]:
        search = _Search("v", 0.5, low=low, high=high, wider=(None, None), rank=500)
        for _ in range(20):
            if search.done:
                break
            seen = df.agg(*[part.alias(key) for key, part in search.aggregates().items()]).first()
            search.narrow(seen.asDict())
        assert search.done and search.value == 500


def test_approximate_quantile_is_within_its_error(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    for quantile in (0.1, 0.5, 0.9):
        value = one(df, ApproxQuantile("l_extendedprice", quantile, 1000))
        below, upto = df.agg(
            F.count_if(F.col("l_extendedprice") < value) / F.count("*"),
            F.count_if(F.col("l_extendedprice") <= value) / F.count("*"),
        ).first()
        assert below - 1 / 1000 <= quantile <= upto + 1 / 1000


def test_distinct_counts_are_close(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    names = ["l_orderkey", "l_suppkey", "l_returnflag"]
    approx = values(df, *[ApproxDistinct(name) for name in names])
    for name in names:
        exact = df.select(name).distinct().count()
        assert abs(approx[("ApproxCountDistinct", name)] - exact) <= 0.2 * exact


def test_uniqueness_against_counting(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    counted = Counter(tuple(row) for row in df.select("l_orderkey", "l_linenumber").collect())
    once = sum(1 for n in counted.values() if n == 1)
    got = one(df, Uniqueness(("l_orderkey", "l_linenumber")))
    assert got == pytest.approx(once / sum(counted.values())) and 0 <= got <= 1


def test_sets_and_signs_of_unlike_types(spark):
    text = spark.createDataFrame([("1",), ("x",), ("2",), ("9",)], "k string")
    whole = spark.createDataFrame([(1,), (3,)], "k int")
    assert compute_metrics(text, [Containment("k", (1, 2))]).first()["value"] == 0.5
    assert compute_metrics(whole, [Containment("k", ("1", "x"))]).first()["value"] == 0.5
    signs = spark.createDataFrame([("-99999999999",), ("-1e15",), ("5",)], "k string")
    assert compute_metrics(signs, [NonNegative("k")]).first()["value"] == pytest.approx(1 / 3)


def test_quantiles_filter_before_they_expand(spark, tmp_path, monkeypatch):
    from rowsieve.operators import quantiles

    path = str(tmp_path / "values")
    spark.range(200_000).selectExpr("cast(id as double) v", "cast(id % 977 as double) w").write.parquet(path)
    plans, settle = [], quantiles._settle

    def watched(table, searches):
        plans.append(table)
        settle(table, searches)

    monkeypatch.setattr(quantiles, "_settle", watched)
    rows = exact_quantiles(spark.read.parquet(path), [("v", 0.5), ("w", 0.25)], settle_rows=50_000)
    assert {r["column"]: r["value"] for r in rows.collect()}["v"] == 99_999.0
    assert plans
