"""Sliced operators must equal the plain ones, whatever the slicing, with one key holding most rows."""

import uuid

import pytest
from pyspark.sql import Window, functions as F

from upkeep.operators import quantiles
from upkeep.operators.lookups import BROADCAST_BYTES, key_statistics
from upkeep.operators.ordered import next_match, running_totals, with_row_windows
from upkeep.operators.quantiles import exact_quantiles, store
from upkeep.operators.slicing import DEFAULT_POLICY, SlicePolicy, slice_rows

POLICIES = [
    pytest.param(DEFAULT_POLICY, id="plain"),
    pytest.param(SlicePolicy(rows_per_slice=60), id="sliced"),
    pytest.param(SlicePolicy(rows_per_slice=9, samples_per_slice=3), id="tiny-slices"),
]


@pytest.fixture(scope="module")
def rows(spark):
    """Half of the rows on one key, some without key, many equal times."""
    key = F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 31 == 0, None).otherwise(F.col("id") % 40 + 2)
    return spark.range(1500).select(
        "id",
        key.cast("int").alias("k"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(200))).alias("ts"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(97)) / 10).alias("v"),
    )


def collected(df, *names):
    def tidy(value):
        return round(value, 6) if isinstance(value, float) else value

    return sorted((tuple(tidy(v) for v in row) for row in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("policy", POLICIES)
def test_row_windows(rows, policy):
    outputs = {
        "previous": lambda w: F.lag("ts").over(w),
        "following": lambda w: F.lead("ts").over(w),
        "count30": lambda w: F.count("id").over(w.rowsBetween(-29, 0)),
        "mean30": lambda w: F.avg("v").over(w.rowsBetween(-29, 0)),
    }
    got = with_row_windows(rows, ["k"], ["ts", "id"], outputs, ["v"], 29, 1, policy)
    plain = Window.partitionBy("k").orderBy("ts", "id")
    want = rows.select("*", *[F.when(F.col("k").isNotNull(), b(plain)).alias(n) for n, b in outputs.items()])
    names = ["id", "k", *outputs]
    assert collected(got, *names) == collected(want, *names)


@pytest.mark.parametrize("policy", POLICIES)
@pytest.mark.parametrize("keys", [["k"], []])
def test_running_totals(rows, policy, keys):
    known = rows.where("k is not null")
    got = running_totals(known, keys, ["ts", "id"], {"run": "v"}, {"whole": "v"}, policy)
    order = Window.partitionBy(*keys, F.lit(0)).orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = known.select("*", F.sum("v").over(order).alias("run"), F.sum("v").over(Window.partitionBy(*keys, F.lit(0))).alias("whole"))
    assert collected(got, "id", "run", "whole") == collected(want, "id", "run", "whole")


@pytest.mark.parametrize("policy", POLICIES)
def test_next_match_equals_brute_force(rows, policy):
    left = rows.where("id % 3 = 0").select("k", "id", "ts")
    right = rows.where("id % 3 = 1 and (k is null or k < 20)").select("k", F.col("ts").alias("at"))
    got = {r["id"]: (r["m"], r["has"]) for r in next_match(left, right, "k", "ts", "id", "at", "m", "has", policy).collect()}
    later = {}
    for row in right.collect():
        later.setdefault(row["k"], []).append(row["at"])
    for row in left.collect():
        times = later.get(row["k"], []) if row["k"] is not None else []
        after = [t for t in times if t > row["ts"]]
        assert got[row["id"]] == (min(after) if after else None, bool(times))
    assert len(got) == left.count()


@pytest.mark.parametrize("policy,accuracy", [(DEFAULT_POLICY, 10_000), (DEFAULT_POLICY, 4), (SlicePolicy(rows_per_slice=5), 4)])
@pytest.mark.parametrize("keys", [["k"], []])
def test_quantiles(rows, policy, accuracy, keys):
    wanted = {"low": 0.0, "q10": 0.1, "median": 0.5, "q75": 0.75, "high": 1.0}
    got = exact_quantiles(rows, keys, "v", wanted, mean="mean", count="n", policy=policy, accuracy=accuracy)
    known = rows.where("k is not null") if keys else rows
    want = known.groupBy(*keys).agg(
        *[F.percentile("v", F.lit(q)).alias(n) for n, q in wanted.items()], F.avg("v").alias("mean"), F.count("v").alias("n")
    )
    names = [*keys, *wanted, "mean", "n"]
    assert collected(got, *names) == collected(want, *names)


def test_quantiles_of_skewed_large_group_use_narrow_brackets(spark):
    rows = spark.range(60_000).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    want = rows.agg(F.percentile("v", F.lit(0.5)), F.percentile("v", F.lit(0.9))).first()
    for margin in (5.0, 0.0):  # without a margin brackets miss, and are widened
        got = exact_quantiles(rows, [], "v", {"median": 0.5, "q": 0.9}, accuracy=1_000, margin=margin).first()
        assert tuple(got) == tuple(want)


@pytest.mark.parametrize("accuracy", [10_000, 5])
def test_quantiles_of_infinities_and_ties(spark, accuracy):
    inf = float("inf")
    values = [-inf] * 60 + [1.0] * 25 + [2.0] * 10 + [inf] * 4 + [float("nan")]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(rows, [], "v", {"a": 0.1, "b": 0.5, "c": 0.7, "d": 0.9, "e": 0.97}, accuracy=accuracy).first()
    assert tuple(got) == (-inf, -inf, 1.0, 2.0, inf)


def test_no_values_no_row(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(empty, [], "v", {"median": 0.5}).count() == 0


def test_hot_key_is_spread_and_cold_keys_are_not(rows):
    policy = SlicePolicy(rows_per_slice=60)
    sliced = slice_rows(rows, ["k"], ["ts", "id"], policy)
    sizes = sliced.rows.groupBy("k", "_slice").count().collect()
    hot = [r["count"] for r in sizes if r["k"] == 1]
    assert len(hot) > 5 and max(hot) < 300
    assert all(r["_slice"] == 0 for r in sizes if r["k"] not in (1, None))
    assert not slice_rows(rows, ["k"], ["ts", "id"]).is_split


def jobs_of(spark, work):
    """Spark jobs that ``work`` starts."""
    group = f"counted {uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "")
    work()
    spark.sparkContext.setJobGroup("other", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_one_median_takes_few_jobs(spark, folder):
    spark.range(50_000).select((F.col("id") % 777).cast("double").alias("v"), (F.col("id") % 50).alias("k")).write.parquet(f"{folder}/v")
    rows = spark.read.parquet(f"{folder}/v")
    assert jobs_of(spark, lambda: exact_quantiles(rows, [], "v", {"m": 0.5}, accuracy=1000).collect()) <= 8
    assert jobs_of(spark, lambda: exact_quantiles(rows, ["k"], "v", {"m": 0.5}, accuracy=1000).collect()) <= 14


def test_wide_lookups_are_not_broadcast(spark):
    rows = spark.range(90_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("t"))
    narrow = key_statistics(rows, [["k"]], {"n": F.count(F.lit(1))})[("k",)]
    wide = key_statistics(rows, [["k"]], {"text": F.max(F.repeat("t", 100))})[("k",)]
    assert narrow.size < BROADCAST_BYTES < wide.size
    plans = [lookup.attach(rows)._jdf.queryExecution().executedPlan().toString() for lookup in (narrow, wide)]
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]


def test_quantiles_take_one_sketch_and_no_interpreted_lambda(spark, monkeypatch):
    rows = spark.range(2_000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    plans = []
    monkeypatch.setattr(quantiles, "store", lambda df, **m: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or store(df, **m))
    got = exact_quantiles(rows, ["k"], "v", {"low": 0.25, "median": 0.5}, accuracy=20)
    assert sorted(map(tuple, got.collect())) == [(0, 499.5, 999.0), (1, 500.5, 1000.0)]
    assert plans and all("lambda" not in plan for plan in plans) and sum(plan.count("percentile_approx") for plan in plans) == 1
