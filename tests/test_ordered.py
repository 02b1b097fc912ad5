"""Sliced order operators against pandas on shuffled, tied and skewed rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import ordered
from sensorloom.operators.labels import flags_by_table, with_overlap_flag
from sensorloom.operators.ordered import Order


def frame(spark, seed, rows=600, keys=1, hot=True):
    """Shuffled rows with ties; a third at one instant and a third at one key if ``hot``."""
    rng = np.random.default_rng(seed)
    at = rng.integers(0, 200, rows)
    key = rng.integers(0, keys, rows)
    if hot:
        at[: rows // 3] = 77
        key[rows // 3 : 2 * rows // 3] = 0
    pdf = pd.DataFrame({"id": rng.permutation(rows), "at": at, "key": key, "v": rng.integers(0, 3, rows)})
    pdf["time"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(pdf["at"], unit="s")
    df = spark.createDataFrame(pdf).withColumn("time", F.col("time").cast("timestamp_ntz")).repartition(5)
    return pdf, df


@pytest.mark.parametrize("seed,keys", [(1, 1), (2, 4)])
def test_previous_and_running_totals_equal_pandas(spark, seed, keys, monkeypatch):
    pdf, df = frame(spark, seed, keys=keys)
    by = ("key",) if keys > 1 else ()
    order = Order("time", "id", by)
    monkeypatch.setattr(ordered, "PARTITIONS", 15)
    got = ordered.with_previous(df, order, ["v", "id"], "_p", "seq")
    got = ordered.with_running_totals(got, order, {"n": F.lit(1), "s": F.col("v")})
    got = got.select("id", "_p.*", "seq", "n", "s").toDF("id", "pv", "pid", "seq", "n", "s").toPandas().set_index("id")
    want = pdf.sort_values([*by, "time", "id"]).set_index("id", drop=False)
    groups = want.groupby("key") if by else want.assign(one=1).groupby("one")
    expected = pd.DataFrame(
        {"pv": groups["v"].shift(1), "pid": groups["id"].shift(1), "n": groups.cumcount() + 1, "s": groups["v"].cumsum()}
    )
    got = got.loc[expected.index]
    for c in expected:
        assert np.array_equal(got[c].astype(float), expected[c].astype(float), equal_nan=True), c
    for _, part in got.assign(key=want["key"] if by else 0).groupby("key"):
        assert part["seq"].is_monotonic_increasing and part["seq"].is_unique


@pytest.mark.parametrize("by", [(), ("key",)])
def test_no_slice_holds_much_more_than_its_share(spark, by, monkeypatch):
    monkeypatch.setattr(ordered, "PARTITIONS", 10)
    _, df = frame(spark, 3, rows=3000, keys=3)
    found = ordered.in_order(df, Order("time", "id", by))
    sizes = [r["count"] for r in found.rows.groupBy("_slice").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 600 and len(sizes) >= 8


def test_borders_do_not_change_results(spark, monkeypatch):
    _, df = frame(spark, 4)
    order = Order("time", "id")
    found = []
    for n in (1, 20):
        monkeypatch.setattr(ordered, "PARTITIONS", n)
        found.append(ordered.with_index(df, order))
    whole, cut = found
    assert whole.exceptAll(cut).count() == 0 and cut.exceptAll(whole).count() == 0


def test_input_is_evaluated_twice_at_most(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PARTITIONS", 6)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        seen.add(1)
        return x

    df = spark.range(0, 2000, 1, 4).select(counted("id").alias("id"), (F.col("id") % 50).alias("t"))
    order = Order("t", "id")
    for make in (lambda: ordered.with_previous(df, order, ["id"]), lambda: ordered.with_index(df, order), lambda: ordered.downsample(df, order, 100), lambda: ordered.ordered_split(df, order)):
        before = seen.value
        make().count()
        assert seen.value - before <= 2 * 2000


@pytest.mark.parametrize("share", [0.0, 0.7, 1.0])
def test_ordered_split(spark, share):
    pdf, df = frame(spark, 5, rows=101)
    got = ordered.ordered_split(df, Order("time", "id"), share).toPandas()
    cut = max(1, min(int(101 * share), 100))
    train = set(pdf.sort_values(["time", "id"])["id"][:cut])
    assert set(got.loc[got["split"] == "train", "id"]) == train


@pytest.mark.parametrize("limit,kept", [(600, 600), (400, 600), (100, 100), (250, 300)])
def test_downsample_steps(spark, limit, kept):
    _, df = frame(spark, 6)
    assert ordered.downsample(df, Order("time", "id"), limit).count() == kept


def test_seconds_to_next_is_strictly_later(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PARTITIONS", 12)
    pdf, df = frame(spark, 7, keys=3)
    events = df.filter(F.col("v") == 0).select("key", F.col("time").alias("e"))
    order = Order("time", "id", ("key",))
    got = ordered.seconds_to_next(df, events, order, "e").toPandas().set_index("id")["seconds_to_next"]
    for row in pdf.itertuples():
        later = pdf[(pdf["key"] == row.key) & (pdf["v"] == 0) & (pdf["at"] > row.at)]["at"]
        if later.empty:
            assert np.isnan(got[row.id])
        else:
            assert got[row.id] == later.min() - row.at


def test_table_calendar_flags_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PARTITIONS", 12)
    pdf, df = frame(spark, 8, keys=2)
    rng = np.random.default_rng(0)
    begin = rng.integers(0, 200, 40)
    cal = pd.DataFrame({"key": rng.integers(0, 2, 40), "b": begin, "e": begin + rng.integers(0, 20, 40)})
    zero = pd.Timestamp("2024-01-01")
    cal["start"], cal["end"] = (zero + pd.to_timedelta(cal[c] * 3600, unit="s") for c in ("b", "e"))
    hours = df.withColumn("time", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("at"))))
    table = spark.createDataFrame(cal[["key", "start", "end"]])
    got = flags_by_table(hours, table, Order("time", "id", ("key",)), 2, 3).toPandas().set_index("id")
    for row in pdf.itertuples():
        own = cal[cal["key"] == row.key]
        inside = ((own["b"] <= row.at) & (row.at <= own["e"])).any()
        before = ((own["b"] - 2 <= row.at) & (row.at < own["b"])).any()
        after = ((own["e"] < row.at) & (row.at <= own["e"] + 3)).any()
        assert tuple(got.loc[row.id, ["failure_window", "pre_failure", "post_maintenance"]]) == (inside, before, after)


def test_overlap_flag(spark):
    rows = [(1, "2024-01-01", "2024-01-10"), (2, "2024-01-02", "2024-01-03"), (3, "2024-01-05", "2024-01-06"), (4, "2024-01-20", "2024-01-21")]
    df = spark.createDataFrame(rows, "interval_id int, start string, end string")
    df = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})
    got = {r["interval_id"]: r["overlaps_earlier"] for r in with_overlap_flag(df).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}


def test_sliced_plan_has_no_single_task_window(spark):
    _, df = frame(spark, 9, rows=3000)
    order = Order("time", "id", ("key",))
    plan = ordered.with_previous(df, order, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_ties_and_keys_beyond_doubles_are_exact(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PARTITIONS", 15)
    base = 1 << 60
    rows = [(1, base + i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, id long").repartition(5)
    for order in (ordered.Order("k", "id"), ordered.Order("id")):
        got = ordered.with_previous(df, order, ["id"]).filter("_prev is not null")
        assert got.count() == 2999 and got.filter("_prev.id <> id - 1").count() == 0
        assert ordered.with_index(df, order).filter(F.col("_index") != F.col("id") - base + 1).count() == 0
    down = ordered.Order("id", descending=True)
    got = ordered.with_previous(df, down, ["id"]).filter("_prev is not null")
    assert got.count() == 2999 and got.filter("_prev.id <> id + 1").count() == 0
    split = ordered.ordered_split(df, ordered.Order("k", "id"), 0.7)
    assert split.filter("split = 'train'").agg(F.count("*"), F.max("id")).first() == (2100, base + 2099)


def test_daily_times_are_cut_by_their_ties(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PARTITIONS", 200)
    rows = 20_000
    df = spark.range(rows).select((F.col("id") % 40).alias("day"), F.col("id").alias("tie"), F.pmod(F.xxhash64("id"), F.lit(7)).alias("v"))
    found = ordered.in_order(df, ordered.Order("day", "tie")).rows.groupBy("_slice").count()
    assert found.count() > 150 and found.agg(F.max("count")).first()[0] <= 400
    got = ordered.with_index(df, ordered.Order("day", "tie"))
    wrong = got.filter(F.col("_index") != F.col("day") * (rows // 40) + F.floor(F.col("tie") / 40) + 1)
    assert wrong.count() == 0
