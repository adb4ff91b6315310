from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowsieve import RowSchema, enrich, unmatched

FACT = [(1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e")]
LOOKUP = [(1, "one", "x"), (2, "two", "x"), (2, "zwei", "x"), (None, "nil", "x")]


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(FACT, "k int, v string")


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame(LOOKUP, "k int, description string, unused string")


def rows(df):
    return Counter(tuple(row) for row in df.collect())


def test_inner_join_keeps_fact_columns_and_multiplies_on_double_keys(fact, lookup):
    got = enrich(fact, lookup, "k", ["description"])
    assert got.columns == ["k", "v", "description"]
    assert rows(got) == Counter(
        {(1, "a", "one"): 1, (2, "b", "two"): 1, (2, "b", "zwei"): 1, (2, "c", "two"): 1,
         (2, "c", "zwei"): 1}
    )


def test_lost_rows_include_null_keys(fact, lookup):
    assert rows(unmatched(fact, lookup, "k")) == Counter({(3, "d"): 1, (None, "e"): 1})


def test_marking_keeps_every_row_and_filters_back_to_the_inner_join(fact, lookup):
    marked = enrich(fact, lookup, "k", ["description"], mark_unmatched=True)
    kept = marked.where("_matched").drop("_matched")
    assert rows(kept) == rows(enrich(fact, lookup, "k", ["description"]))
    assert rows(marked.where("not _matched").select("k", "v")) == rows(unmatched(fact, lookup, "k"))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan


def test_keys_of_other_names_and_several_keys(spark, fact):
    lookup = spark.createDataFrame([(1, "a", "hit"), (2, "x", "miss")], "id int, name string, d string")
    got = enrich(fact, lookup, {"k": "id", "v": "name"}, ["d"])
    assert rows(got) == Counter({(1, "a", "hit"): 1})


def test_a_table_can_be_its_own_lookup(fact):
    got = enrich(fact, fact.select("k", F.col("v").alias("other")), "k", ["other"])
    assert rows(got)[(2, "b", "c")] == 1


def test_name_clash_is_refused(fact, lookup):
    with pytest.raises(ValueError, match="already has"):
        enrich(fact, lookup.withColumnRenamed("description", "v"), "k", ["v"])


def test_enriched_rows_go_through_the_same_rules(fact, lookup):
    rules = RowSchema().string_column("description", is_nullable=False, matches="^[a-z]+$")
    assert tuple(rules.counts(enrich(fact, lookup, "k", ["description"])).first()) == (5, 0)


def test_only_used_lookup_columns_are_joined(fact, lookup):
    plan = enrich(fact, lookup, "k", ["description"])._jdf.queryExecution().optimizedPlan()
    assert "unused" not in plan.toString().split("Join Inner")[1].split("LogicalRDD")[0]


def test_hot_key_is_split_when_the_lookup_is_too_big_to_broadcast(spark):
    """A key, or null, with half of all rows: the shuffled join splits it into several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(0, 200_000, 1, 16).select(
            F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 1000).alias("k"),
            F.col("id").cast("string").alias("v"),
        )
        hot_null = fact.withColumn("k", F.nullif("k", F.lit(7)))
        lookup = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("d").alias("d"))
        for joined, expected in [
            (enrich(fact, lookup, "k", ["d"]), 200_000),
            (unmatched(fact, lookup.where("k <> 7"), "k"), 100_200),
        ]:
            data = joined.select(F.count(F.lit(1)))
            assert data.collect()[0][0] == expected
            assert "skew=true" in data._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_text_keys_meet_typed_ones(spark):
    fact = spark.createDataFrame([("1",), ("x",), (None,), ("99999999999999999999",)], "k string")
    lookup = spark.createDataFrame([(1, "one")], "code int, name string")
    assert [tuple(r) for r in enrich(fact, lookup, {"k": "code"}, ["name"]).collect()] == [("1", "one")]
    assert unmatched(fact, lookup, {"k": "code"}).count() == 3
    typed = spark.createDataFrame([(1,), (2,)], "k int")
    words = spark.createDataFrame([("1", "one"), ("y", "why")], "code string, name string")
    assert enrich(typed, words, {"k": "code"}, ["name"]).count() == 1
