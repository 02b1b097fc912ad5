import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorloom.operators import rolling


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=80),
    st.sampled_from([1, 2, 5, 15, 60]),
)
def test_trailing_equals_pandas(values, rows):
    series = pd.Series(values, dtype=float)
    roll = series.rolling(rows, min_periods=1)
    got = rolling.trailing(series.to_numpy(), rows, rolling.STATISTICS)
    want = {
        "mean": roll.mean(),
        "min": roll.min(),
        "max": roll.max(),
        "q25": roll.quantile(0.25),
        "q75": roll.quantile(0.75),
    }
    for name, expected in want.items():
        np.testing.assert_allclose(got[name], expected, rtol=1e-9, atol=1e-6, err_msg=name)
    exact = [np.std(w, ddof=1) if (w := series[max(0, i - rows + 1) : i + 1].dropna()).size > 1 else 0.0 for i in range(len(series))]
    np.testing.assert_allclose(got["std"], exact, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("block_rows", [4, 7, 1024])
def test_blocks_equal_one_global_frame(spark, block_rows, monkeypatch):
    monkeypatch.setattr(rolling, "CELL", 16)
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"at": np.sort(rng.choice(500, 120, replace=False)), "key": rng.integers(0, 2, 120), "v": rng.normal(size=120)})
    pdf["bucket"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(pdf["at"], unit="min")
    pdf.loc[::9, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v"))).repartition(3)
    stats = [(s, "v", 5) for s in rolling.STATISTICS] + [("mean", "v", 1), ("mean", "v", 3)]
    got = rolling.with_rolling(df, "bucket", "minute", stats, ("key",), block_rows).toPandas()
    assert len(got) == 120
    got = got.sort_values(["key", "bucket"])
    for key, part in pdf.groupby("key"):
        roll = part["v"].rolling(5, min_periods=1)
        mine = got[got["key"] == key]
        np.testing.assert_allclose(mine["roll5_mean_v"], roll.mean(), atol=1e-12)
        np.testing.assert_allclose(mine["roll5_std_v"], roll.std().fillna(0.0), atol=1e-9)
        np.testing.assert_allclose(mine["roll5_q75_v"], roll.quantile(0.75), atol=1e-12)
        np.testing.assert_allclose(mine["roll1_mean_v"], part["v"])
        np.testing.assert_allclose(mine["roll3_mean_v"], part["v"].rolling(3, min_periods=1).mean(), atol=1e-12)


def test_rejects_bad_requests(spark):
    df = spark.createDataFrame([("2024-01-01", 1.0)], "b string, v double").withColumn("b", F.col("b").cast("timestamp"))
    with pytest.raises(ValueError):
        rolling.with_rolling(df, "b", "minute", [("median", "v", 5)])


def test_a_frame_may_be_longer_than_a_block(spark):
    import datetime as dt

    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "m timestamp_ntz, v double")
    got = rolling.with_rolling(df, "m", "minute", [("mean", "v", 150)], block_rows=16).collect()
    for r in got:
        low = max(0, int(r["v"]) - 149)
        assert abs(r["roll150_mean_v"] - (low + r["v"]) / 2) < 1e-9


def by_hand(values, rows, kind):
    out = []
    for i in range(len(values)):
        frame = [v for v in values[max(0, i - rows + 1) : i + 1] if np.isfinite(v)]
        if kind == "std":
            out.append(np.std(frame, ddof=1) if len(frame) > 1 else 0.0)
        elif not frame:
            out.append(np.nan)
        else:
            out.append({"mean": np.mean, "min": np.min, "max": np.max, "q25": lambda f: np.quantile(f, 0.25), "q75": lambda f: np.quantile(f, 0.75)}[kind](frame))
    return np.array(out)


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 15, 60, 64, 255, 400])
def test_every_statistic_of_every_frame(rows):
    rng = np.random.default_rng(rows)
    values = np.round(rng.normal(size=300) * rng.choice([1, 1e6], 300), 1)
    values[rng.random(300) < 0.2] = np.nan
    values[100:180] = 7.5  # ties and constant frames
    values[200:270] = np.nan
    got = rolling.trailing(values, rows, rolling.STATISTICS)
    for kind in rolling.STATISTICS:
        np.testing.assert_allclose(got[kind], by_hand(values, rows, kind), rtol=1e-9, atol=1e-9)
    assert got["std"][150] == pytest.approx(0, abs=1e-9) or rows > 50


def test_no_rows_and_no_known_values():
    assert all(len(v) == 0 for v in rolling.trailing(np.zeros(0), 5, rolling.STATISTICS).values())
    got = rolling.trailing(np.full(4, np.nan), 3, rolling.STATISTICS)
    assert np.isnan(got["q25"]).all() and np.isnan(got["mean"]).all() and (got["std"] == 0).all()


def test_a_day_of_seconds_takes_memory_for_its_rows_only():
    import tracemalloc

    values = np.random.default_rng(1).normal(size=172_800)
    tracemalloc.start()
    got = rolling.trailing(values, 86_400, rolling.STATISTICS)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
    last = values[-86_400:]
    want = [last.mean(), last.std(ddof=1), last.min(), last.max(), *np.quantile(last, [0.25, 0.75])]
    assert [got[k][-1] for k in rolling.STATISTICS] == pytest.approx(want, rel=1e-12)


def test_blocks_of_few_rows_are_evaluated_together():
    """Many keys of few rows are one call, and no frame reaches into the rows of another key."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 9, 9_000)
    keys, values = np.repeat(np.arange(len(sizes)), sizes), rng.normal(size=sizes.sum())
    values[::17] = np.nan
    calls = []

    def evaluate(rows, first):
        calls.append(len(first))
        start = np.repeat(first, np.diff(np.append(first, rows.num_rows)))
        made = rolling.trailing(rows["v"].to_numpy(), 5, ["mean", "std", "min", "max", "q25", "q75"], start)
        return pa.table(made | {"k": rows["k"]})

    whole = pa.table({"k": keys, "v": values})
    got = pa.Table.from_batches(rolling._whole_blocks(["k"], evaluate)(iter(whole.to_batches(max_chunksize=1_000))))
    assert sum(calls) == len(sizes) and len(calls) < 6
    assert got["k"].to_numpy().tolist() == keys.tolist()
    ends = np.cumsum(sizes)
    for k in range(0, len(sizes), 101):
        own = slice(ends[k] - sizes[k], ends[k])
        for kind, want in rolling.trailing(values[own], 5, ["mean", "std", "min", "max", "q25", "q75"]).items():
            np.testing.assert_allclose(got[kind].to_numpy()[own], want, rtol=1e-12, atol=1e-12)
