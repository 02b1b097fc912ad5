import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorloom.models import forest, isolation, linear, mad, matrix
from sensorloom.operators import evaluate, ordered
from sensorloom.operators.quantiles import exact_quantiles
from sensorloom.spec import Calendar


@pytest.mark.parametrize("kind", ["normal", "ties", "constant"])
def test_radix_quantiles_are_exact(spark, kind):
    rng = np.random.default_rng(5)
    a = {"normal": rng.normal(size=4000), "ties": np.where(rng.random(4000) < 0.4, 7.0, rng.normal(size=4000)), "constant": np.ones(4000)}[kind]
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": rng.exponential(size=4000)})).repartition(4)
    df = df.withColumn("b", F.when(F.col("b") > 0.1, F.col("b")))
    shares = [0.0, 0.25, 0.5, 0.9, 0.995, 1.0]
    got = exact_quantiles(df, ["a", "b"], shares, small_cells=0)
    pdf = df.toPandas()
    np.testing.assert_allclose(got["a"], np.quantile(pdf["a"], shares), rtol=1e-12)
    np.testing.assert_allclose(got["b"], np.nanquantile(pdf["b"], shares), rtol=1e-12)


def test_sortable_bits_sort_like_doubles():
    from sensorloom.operators import quantiles

    values = np.array([-np.inf, -1e300, -2.5, -5e-324, 0.0, 5e-324, 1.0, np.nextafter(1.0, 2), 3e8, np.inf])
    keys = quantiles.sortable(values)
    assert (keys[1:] > keys[:-1]).all() and quantiles.sortable(np.array([-0.0]))[0] == keys[4]
    assert [quantiles._double(int(k)) for k in keys] == values.tolist()


def test_quantiles_evaluate_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return float(x)

    df = spark.range(3000).select(counted("id").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    got = exact_quantiles(df, ["a", "b"], [0.1 * k for k in range(11)], small_cells=0)
    assert seen.value == 3000
    assert got["a"] == pytest.approx(np.quantile(np.arange(3000.0), [0.1 * k for k in range(11)])) and got["b"][10] == 6.0


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert exact_quantiles(df, ["a"], [0.5]) == {"a": [None]}
    assert exact_quantiles(df, ["a"], [0.5], small_cells=0) == {"a": [None]}


def scores(spark, rows=500, seed=2):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"score": np.round(rng.random(rows), 2), "label": (rng.random(rows) < 0.2).astype(int)})
    pdf.loc[: rows // 3, "score"] = 0.5  # a third of the rows share one score
    pdf["time"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.permutation(rows), unit="h")
    return pdf, spark.createDataFrame(pdf).repartition(4)


def test_average_precision(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PARTITIONS", 12)
    pdf, df = scores(spark)
    s = pdf.sort_values(["score", "time"], ascending=[False, True])
    tp, n = s["label"].cumsum(), np.arange(1, len(s) + 1)
    want = float((s["label"] * tp / n).sum() / s["label"].sum())
    assert evaluate.average_precision(df, "score", "label", "time").first()["average_precision"] == pytest.approx(want)
    g = pdf.groupby("score")["label"].agg(["sum", "count"]).sort_index(ascending=False)
    grouped = float((g["sum"] * g["sum"].cumsum() / g["count"].cumsum()).sum() / g["sum"].sum())
    assert evaluate.average_precision_grouped(df, "score", "label").first()["average_precision"] == pytest.approx(grouped)


def test_no_positives_has_no_average_precision(spark):
    _, df = scores(spark)
    row = evaluate.average_precision(df.withColumn("label", F.lit(0)), "score", "label", "time").first()
    assert row["average_precision"] is None and row["positive_rows"] == 0


def test_threshold_sweep_against_numpy(spark):
    pdf, df = scores(spark)
    got = evaluate.threshold_sweep(df, "score", "label").toPandas().sort_values("threshold")
    thresholds = np.unique(np.quantile(pdf["score"], np.linspace(0.50, 0.995, 80)))
    np.testing.assert_allclose(got["threshold"], thresholds, rtol=1e-12)
    best, key = None, (-1.0, -1.0)
    for t, row in zip(thresholds, got.itertuples()):
        hit = pdf["score"] >= t
        tp, fp = int((hit & (pdf["label"] == 1)).sum()), int((hit & (pdf["label"] == 0)).sum())
        fn = int((~hit & (pdf["label"] == 1)).sum())
        assert (row.tp, row.fp, row.fn, row.tn) == (tp, fp, fn, len(pdf) - tp - fp - fn)
        p, r = tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn)
        f1 = 2 * p * r / (p + r) if p + r else 0.0
        if (f1, r) > key:
            best, key = t, (f1, r)
    assert got.loc[got["is_best"] == 1, "threshold"].iloc[0] == pytest.approx(best)


def test_single_class_threshold(spark):
    pdf, df = scores(spark)
    row = evaluate.best_threshold(df.withColumn("label", F.lit(0)), "score", "label").collect()
    assert len(row) == 1 and row[0]["threshold"] == pytest.approx(np.quantile(pdf["score"], 0.95))


def test_lead_time(spark):
    cal = Calendar.of([("2024-01-03 00:00:00", "2024-01-03 01:00:00", "a"), ("2024-01-05 00:00:00", "2024-01-05 01:00:00", "b"), ("2025-01-01 00:00:00", "2025-01-02 00:00:00", "out")])
    rows = [("2024-01-01 00:00:00", 1), ("2024-01-02 00:00:00", 1), ("2024-01-02 12:00:00", 1), ("2024-01-05 00:00:00", 1), ("2024-01-06 00:00:00", 0)]
    df = spark.createDataFrame(rows, "t string, p int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    leads = evaluate.lead_time(df, cal, "t", "p")
    got = {r["interval_id"]: (r["detected"], r["lead_time_hours"]) for r in leads.collect()}
    assert got == {1: (1, 24.0), 2: (0, None)}
    summary = evaluate.lead_time_summary(leads).first()
    assert (summary["detected_windows"], summary["mean_lead_time_hours"]) == (1, 24.0)


def test_scaler_uses_train_only(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0), (float("inf"), 5.0)], "a double, c double")
    scaler = matrix.fit_scaler(train, ["a", "c"])
    assert scaler.medians["a"] == 2.0 and scaler.means["a"] == 2.0 and scaler.stds["c"] == 1.0
    out = scaler.transform(spark.createDataFrame([(100.0, None)], "a double, c double")).first()
    assert out["a"] == pytest.approx((100 - 2) / np.std([1, 3, 2, 2], ddof=1)) and out["c"] == 0.0


def learnable(spark, rows=300):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(rows, 3))
    y = (x[:, 0] + 0.5 * rng.normal(size=rows) > 1.2).astype(int)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y, id=np.arange(rows))
    return pdf, spark.createDataFrame(pdf).repartition(3)


def test_gradient_descent_equals_numpy(spark):
    pdf, df = learnable(spark)
    x, y = pdf[["a", "b", "c"]].to_numpy(), pdf["y"].to_numpy()
    xb, coef = np.column_stack([np.ones(len(x)), x]), np.zeros(4)
    w = np.minimum(np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum()))), 30)
    for _ in range(12):
        grad = xb.T @ ((1 / (1 + np.exp(-xb @ coef)) - y) * w) / w.sum()
        grad[1:] += 0.001 * coef[1:]
        coef -= 0.08 * grad
    model = linear.fit_gradient(df, ["a", "b", "c"], "y", iterations=12)
    np.testing.assert_allclose([model.intercept, *model.weights], coef, atol=1e-12)
    got = df.select("id", model.score().alias("s")).toPandas().sort_values("id")["s"]
    np.testing.assert_allclose(got, 1 / (1 + np.exp(-xb @ coef)), atol=1e-12)


def test_trained_models_find_the_signal(spark):
    pdf, df = learnable(spark)
    for fit in (linear.fit_logistic, lambda d, c, y: forest.fit_forest(d, c, y, trees=10, depth=4, leaf=2)):
        scored = fit(df, ["a", "b", "c"], "y").scored(df).toPandas()
        assert scored.loc[scored["y"] == 1, "score"].mean() > scored.loc[scored["y"] == 0, "score"].mean() + 0.2


def test_scores_equal_those_of_the_trainers(spark, monkeypatch):
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.linalg import Vectors

    kept = []
    for kind in (LogisticRegression, RandomForestClassifier):
        monkeypatch.setattr(kind, "fit", lambda self, data, real=kind.fit: kept.append(real(self, data)) or kept[-1])
    pdf, df = learnable(spark)
    for fit in (linear.fit_logistic, lambda d, c, y: forest.fit_forest(d, c, y, trees=7, depth=5, leaf=3)):
        model = fit(df, ["a", "b", "c"], "y")
        found = kept[-1]
        for r in model.scored(df).orderBy("id").limit(60).collect():
            assert r["score"] == pytest.approx(found.predictProbability(Vectors.dense(r["a"], r["b"], r["c"]))[1], abs=1e-9)
    assert model.importances == pytest.approx(found.featureImportances.toArray()) and sum(model.importances) == pytest.approx(1)
    hole = model.scored(df.limit(3).withColumn("a", F.lit(None).cast("double"))).collect()
    assert [r["score"] for r in hole] == [None] * 3


def test_isolation_forest_ranks_outliers_first_and_repeats(spark):
    pdf, df = learnable(spark)
    df = df.withColumn("a", F.when(F.col("id") < 5, 40.0 + 20.0 * F.col("id")).otherwise(F.col("a")))
    fit = lambda parts: isolation.fit_isolation(df.repartition(parts), ["a", "b", "c"], "id", trees=60, sample=256)
    one, two = fit(2), fit(5)
    assert one.nodes.sort_values(["tree", "node"]).reset_index(drop=True).equals(two.nodes.sort_values(["tree", "node"]).reset_index(drop=True))
    top = one.score(df).orderBy(F.desc("score")).limit(5).select("id").collect()
    assert {r["id"] for r in top} == set(range(5))


def test_rare_draws_are_spread_over_the_trees(spark):
    rows = spark.range(200_000).select("id", F.array(F.rand(1), F.rand(2)).alias("x"))
    got = isolation._draw(rows, "id", 20, 0.002, 7).groupBy("tree").count().collect()
    assert len(got) == 20 and all(280 < r["count"] < 540 for r in got)


@pytest.mark.parametrize("share", [1.0, 0.6, 0.05])
def test_a_tree_draws_as_if_by_itself(spark, share):
    rows = spark.range(4000).select("id", F.array(F.lit(1.0)).alias("x"))
    drawn = isolation._draw(rows, "id", 12, share, 3)
    assert drawn.distinct().count() == drawn.count()  # no tree has a row twice
    sizes = [r["count"] for r in drawn.groupBy("tree").count().collect()]
    spread = 5 * (4000 * share * (1 - share)) ** 0.5
    assert len(sizes) == 12 and all(abs(n - 4000 * share) <= spread for n in sizes)


def test_mad_falls_back_to_all_rows(spark):
    df = spark.createDataFrame([(float(i), 0) for i in range(11)], "a double, normal_candidate int")
    model = mad.fit_mad(df, ["a"])
    assert model.center["a"] == 5.0 and model.deviation["a"] == 3.0
    assert df.select(model.score().alias("s")).agg(F.max("s")).first()[0] == pytest.approx(5 / 3)
    flat = mad.fit_mad(df.withColumn("a", F.lit(1.0)), ["a"])
    assert flat.deviation["a"] == 1.0


def test_class_weights_are_capped(spark):
    df = spark.createDataFrame([(1,)] + [(0,)] * 999, "y int")
    got = {r["label"]: r["class_weight"] for r in evaluate.class_weights(df, "y").collect()}
    assert got[1] == 30.0 and got[0] == pytest.approx(1000 / 1998)


def test_quantiles_ignore_nan_and_null_alike_at_any_size(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(float(i % 97), nan if i % 3 else float(i), None, -inf if i == 5 else inf if i == 6 else None if i % 2 else 1.0) for i in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    small = exact_quantiles(df, ["a", "b", "c", "d"], [0.25, 0.5, 0.9])
    large = exact_quantiles(df, ["a", "b", "c", "d"], [0.25, 0.5, 0.9], small_cells=0)
    assert small == large and small["c"] == [None] * 3


def test_sweep_without_scores(spark):
    from sensorloom.operators.evaluate import threshold_sweep

    df = spark.createDataFrame([(None, 1), (None, 0)], "s double, y int")
    assert threshold_sweep(df, "s", "y").count() == 0
