"""One query per operator over the given tables; each reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import adapters as a
from sensorloom.compressor import COMPRESSOR
from sensorloom.functions import gates, risk
from sensorloom.functions.scalars import band, bucket_start, bucket_text, day_text, finite_or, one_hot
from sensorloom.models import forest, isolation, linear, mad, matrix
from sensorloom.operators import analysis, calendars, evaluate, features, kpi, labels, normalize, ordered, quality, reconcile
from sensorloom.operators import reshape, rolling
from sensorloom.plans import dashboards, warehouse
from sensorloom.session import scratch_path
from sensorloom.sources import events as ev
from sensorloom.sources import readings as src
from sensorloom.sources import sinks
from sensorloom.streaming import jobs, pipeline, stores

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
E_ = a.EVENTS
C_ = COMPRESSOR
AVERAGES = ["pressure", "temperature"]
NOW = jobs.Trigger(available_now=True)


def rounded(df: DataFrame, places: int | None = 6) -> DataFrame:
    """Round doubles so that sums taken in another order compare equal."""
    if places is None:
        return df
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    # quartiles sit on quarter steps between means, where six places meet exact ties
    finer = {c: 8 if "_q25_" in c or "_q75_" in c else places for c in doubles}
    return df.withColumns({c: F.round(F.col(c).cast("double"), n) + F.lit(0.0) for c, n in finer.items()})


def query(name: str, places: int | None = 6) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir), places)

        run.__doc__, run.__name__ = fn.__doc__, name
        QUERIES[name] = run
        return run

    return register


# ---- sources and sinks -------------------------------------------------------------


def _csv(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "raw-csv")
    raw = a.raw_text(spark, sf)
    # an unnamed first header, as exported index columns have
    raw.withColumnRenamed("_c0", "").write.option("header", True).csv(path)
    return path


@query("src_csv")
def src_csv(spark, sf):
    raw = src.read_readings_csv(spark, _csv(spark, sf))
    named = normalize.standardise_columns(raw, C_)
    return named.agg(
        F.count("*").alias("row_count"),
        F.count(F.when(F.col("tp2") == "bad", 1)).alias("bad_numbers"),
        F.count(F.when(F.col("event_time_raw") == "not-a-time", 1)).alias("bad_times"),
        F.sum(F.col("raw_index").cast("long")).alias("index_sum"),
        F.sum(F.col("dv_electric").try_cast("double")).alias("dv_electric_sum"),
    )


@query("src_csv_projected")
def src_csv_projected(spark, sf):
    rows = src.read_projected_csv(spark, _csv(spark, sf), C_, ["event_time", "raw_index", "tp2", "dv_electric"])
    return rows.filter(F.col("event_time").isNotNull())


@query("scan_parquet")
def scan_parquet(spark, sf):
    rows = a.table(spark, sf, "events").filter(F.col("value") >= 100.0)
    return rows.select("event_id", "ts", "value")


@query("sink_partitioned_roundtrip")
def sink_partitioned_roundtrip(spark, sf):
    path = scratch_path(spark, "readings")
    rows = a.readings(spark, sf)
    sinks.write_partitioned(rows, path, ["dt"])
    # a second write of one day replaces that day only
    day = rows.filter(F.col("dt") == "2024-01-05").withColumn("pressure", F.col("pressure") + 1.0)
    sinks.write_partitioned(day, path, ["dt"])
    back = spark.read.parquet(path)
    return back.select("raw_index", "event_time", "pressure", F.col("dt").cast("string").alias("dt"), "operating_state")


@query("verified_write")
def verified_write(spark, sf):
    rows = a.readings(spark, sf)
    base = scratch_path(spark, "layers")
    first = sinks.verified_write(rows, src.layer_path(base, "readings"), ["dt"], label="readings")
    return first.unionByName(warehouse.build_layers(spark, base, E_))


_LAKES: dict[tuple[str, str], str] = {}


def _lake(spark, sf) -> str:
    """The layers of the readings, written once per session; pages and gates read what is stored."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LAKES:
        base = scratch_path(spark, "lake")
        sinks.verified_write(a.readings(spark, sf), src.layer_path(base, "readings"), ["dt"], label="readings")
        warehouse.build_layers(spark, base, E_)
        _LAKES[key] = base
    return _LAKES[key]


def _layer(spark, sf, name: str) -> DataFrame:
    rows = src.read_layer(spark, _lake(spark, sf), name)
    return rows.withColumn("dt", F.col("dt").cast("string")) if "dt" in rows.columns else rows


def _layers(spark, sf) -> dict[str, DataFrame]:
    return {name: _layer(spark, sf, name) for name in src.LAYERS}


@query("publish_tables")
def publish_tables(spark, sf):
    location = scratch_path(spark, "warehouse")
    database = "plant_" + location.rsplit("-", 1)[1][:12]
    tables = {name: (df, warehouse.PARTITIONS[name]) for name, df in _layers(spark, sf).items()}
    gate = warehouse.publish_tables(spark, tables, database, location)
    warehouse.realtime_placeholder(spark, database, "realtime_kpi", AVERAGES)
    empty = {"realtime_kpi": spark.table(f"{database}.realtime_kpi")}
    return gate.unionByName(quality.table_gate(empty, ["realtime_kpi"]))


@query("table_gate")
def table_gate(spark, sf):
    tables = {name: a.table(spark, sf, name) for name in ("events", "orders", "lineitem")}
    tables["nothing"] = tables["events"].filter(F.col("value") < 0)
    tables["may_be_empty"] = tables["nothing"]
    return quality.table_gate(tables, ["may_be_empty"])


def _views(spark, sf) -> dict[str, str]:
    _layer(spark, sf, "window_kpi").createOrReplaceTempView("window_kpi_table")
    _layer(spark, sf, "sensor_kpi").createOrReplaceTempView("sensor_kpi_table")
    names = {"window": "bi_window_kpi", "sensor": "bi_sensor_kpi"}
    warehouse.create_views(
        spark,
        {"window": "window_kpi_table", "sensor": "sensor_kpi_table"},
        AVERAGES,
        names,
        E_.bucket,
        "TIMESTAMP_NTZ",
    )
    return names


@query("view_window_kpi")
def view_window_kpi(spark, sf):
    return spark.table(_views(spark, sf)["window"])


@query("view_sensor_kpi")
def view_sensor_kpi(spark, sf):
    return spark.table(_views(spark, sf)["sensor"])


@query("sink_tsv")
def sink_tsv(spark, sf):
    path = scratch_path(spark, "extract")
    rows = kpi.window_state_kpi(kpi.window_kpi(a.readings(spark, sf), E_), E_, AVERAGES)
    sinks.write_tsv(rows, path, ["dt", "operating_state"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return spark.read.option("sep", "\t").schema(schema).csv(path)


@query("encode_events")
def encode_events(spark, sf):
    coded = ev.encode_events(a.clean_events(spark, sf))
    names = ["event_id", "event_time", "ingest_time", "source", "operating_state", "failure_type"]
    numbers = ["raw_index", "is_failure_window", "tp2", "oil_temperature", "lps"]
    return coded.select(
        "key",
        *[F.get_json_object("value", f"$.{n}").alias(n) for n in names],
        *[F.get_json_object("value", f"$.{n}").cast("double").alias(n) for n in numbers],
    )


def _valid_events(spark, sf) -> DataFrame:
    decoded = ev.decode_events(a.payloads(spark, sf), C_)
    return pipeline.accepted(pipeline.gated(decoded, gates.strict_rules(C_)))


def _risk_events(spark, sf, valid: DataFrame | None = None) -> DataFrame:
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return pipeline.scored(_valid_events(spark, sf) if valid is None else valid, C_, scoring_time=stamp)


@query("latest_state")
def latest_state(spark, sf):
    store = stores.ParquetStore(
        scratch_path(spark, "latest"), ["state_key"], ["event_time", "raw_index"], ttl_seconds=7200
    )
    rows = _risk_events(spark, sf).withColumns(
        {
            "state_key": stores.store_key("risk:latest", F.col("operating_state")),
            "written_at": F.lit("2024-02-01 00:00:00").cast("timestamp"),
        }
    )
    kept = rows.select("state_key", "event_time", "raw_index", "event_id", "risk_score", "risk_level", "written_at")
    for batch in range(2):  # two batches, the first one repeated after a pretended failure
        part = kept.filter(F.col("raw_index") % 2 == batch)
        for _ in range(2 - batch):
            stores.write_degraded(store, pipeline.latest_per_key(part, ["state_key"], ["event_time", "raw_index"]), batch)
    now = F.lit("2024-02-01 01:00:00").cast("timestamp")
    return store.read(spark, now, "written_at").drop("written_at")


# ---- projections -------------------------------------------------------------------


@query("normalize")
def normalize_(spark, sf):
    rows = normalize.normalize(a.raw_text(spark, sf), C_, a.CALENDAR)
    rows = normalize.with_lineage(rows, "csv", F.lit("raw"), F.lit("2024-02-01").cast("timestamp"))
    return rows.drop("event_date", "ods_loaded_at")


@query("normalize_quarantine")
def normalize_quarantine(spark, sf):
    return normalize.quarantine(a.raw_text(spark, sf), C_).select("raw_index", "event_time_raw", "reason")


@query("time_buckets")
def time_buckets(spark, sf):
    rows = a.table(spark, sf, "events")
    return rows.select(
        "event_id",
        bucket_start(rows, "ts", "minute").alias("event_minute"),
        bucket_start(rows, "ts", "hour").alias("event_hour"),
        day_text(F.col("ts")).alias("dt"),
        bucket_text(F.col("ts")).alias("minute_bucket"),
    )


@query("state_banding")
def state_banding(spark, sf):
    i = F.col("raw_index")
    broken = F.when(i % 31 == 0, F.lit(float("nan"))).when(i % 37 != 0, F.col("pressure"))
    return a.bare_readings(spark, sf).select("raw_index", band(broken, E_.bands).alias("operating_state"))


@query("interaction_deltas")
def interaction_deltas(spark, sf):
    rows = normalize.with_deltas(a.compressor(spark, sf), C_)
    return rows.select("raw_index", "delta_tp3_reservoirs", "delta_tp2_tp3")


@query("finite_or")
def finite_or_(spark, sf):
    i = F.col("event_id")
    text = (
        F.when(i % 13 == 0, F.lit("NaN"))
        .when(i % 17 == 0, F.lit("Infinity"))
        .when(i % 19 == 0, F.lit("x"))
        .when(i % 23 != 0, F.col("value").cast("string"))
    )
    return a.table(spark, sf, "events").select("event_id", finite_or(text).alias("value"))


@query("one_hot_state")
def one_hot_state(spark, sf):
    rows = a.readings(spark, sf)
    state = F.when(F.col("raw_index") % 29 != 0, F.col("operating_state"))
    return rows.select("raw_index", *one_hot(state, [*E_.bands.states, "unknown"], "state_", "unknown"))


@query("binary_target")
def binary_target(spark, sf):
    rows = kpi.window_kpi(a.readings(spark, sf), E_)
    return rows.select(E_.bucket, "operating_state", evaluate.binary_target(rows).alias("label"))


@query("decode_events")
def decode_events(spark, sf):
    rows = ev.decode_events(a.payloads(spark, sf), C_)
    return rows.groupBy(
        F.col("_corrupt").isNotNull().cast("int").alias("is_corrupt"),
        F.coalesce("operating_state", F.lit("none")).alias("operating_state"),
    ).agg(
        F.count("*").alias("event_rows"),
        F.count("event_id").alias("id_rows"),
        F.sum("tp2").alias("tp2_sum"),
        F.min("event_time").alias("min_event_time"),
    )


def _contract_payloads(spark, sf) -> DataFrame:
    """Payloads with further faults in the JSON types: a text sensor, a boolean sensor, a
    short time, a missing sensor."""
    i = F.get_json_object("value", "$.raw_index").cast("long")
    v = F.col("value")
    return a.payloads(spark, sf).select(
        F.when(i % 71 == 0, F.regexp_replace(v, r'"tp2":[^,]*', '"tp2":"high"'))
        .when(i % 73 == 0, F.regexp_replace(v, r'"lps":[^,]*', '"lps":true'))
        .when(i % 79 == 0, F.regexp_replace(v, r'"event_time":"[^"]*"', '"event_time":"2024-01-01"'))
        .when(i % 67 == 0, F.regexp_replace(v, r'"h1":[^,]*,', ""))
        .when(i % 61 == 0, F.concat(F.lit("["), v, F.lit("]")))
        .otherwise(v)
        .alias("value")
    )


@query("validate_contract")
def validate_contract(spark, sf):
    rows = ev.validate_contract(_contract_payloads(spark, sf), C_)
    listed = F.coalesce(F.nullif(F.array_join("errors", ","), F.lit("")), F.lit("none"))
    return rows.groupBy("status", listed.alias("errors")).agg(F.count("*").alias("event_rows"))


@query("contract_summary")
def contract_summary(spark, sf):
    return ev.contract_summary(ev.validate_contract(_contract_payloads(spark, sf), C_))


@query("risk_score")
def risk_score(spark, sf):
    return a.compressor(spark, sf).select(
        "raw_index", *[c.alias(n) for n, c in risk.components().items()], risk.score().alias("risk_score")
    )


@query("risk_reason")
def risk_reason(spark, sf):
    return a.compressor(spark, sf).select("raw_index", risk.alarm_reasons().alias("risk_reason"))


@query("risk_passthrough")
def risk_passthrough(spark, sf):
    i = F.col("raw_index")
    given = F.when(i % 5 == 0, F.col("tp2") / 4.0)
    model = F.when(i % 7 == 0, F.col("tp2") / 50.0)
    score, reasons, source = risk.passthrough(given, model)
    return a.compressor(spark, sf).select(
        "raw_index",
        score.alias("risk_score"),
        F.concat_ws(",", reasons).alias("risk_reason"),
        source.alias("risk_score_source"),
        risk.level(score).alias("risk_level"),
    )


@query("risk_level")
def risk_level(spark, sf):
    rows = a.compressor(spark, sf).select("raw_index", (F.col("tp2") / 15.0 - 0.05).alias("risk_score"))
    rows = rows.filter(F.col("risk_score").between(0.0, 1.0))
    return rows.withColumn("risk_level", risk.level(F.col("risk_score")))


@query("risk_enrich")
def risk_enrich(spark, sf):
    return _risk_events(spark, sf).drop(*C_.analog, "ingest_time")


@query("sensor_long")
def sensor_long(spark, sf):
    return reshape.to_long(a.readings(spark, sf), E_, ["raw_index", "event_time", "dt"])


# ---- joins -------------------------------------------------------------------------


@query("dim_join")
def dim_join(spark, sf):
    return reshape.with_dimension(reshape.to_long(a.readings(spark, sf), E_, ["raw_index"]), E_)


@query("interval_label")
def interval_label(spark, sf):
    rows = a.bare_readings(spark, sf).select("raw_index", "event_time")
    return normalize.with_interval_label(rows, E_, a.OVERLAPPING)


@query("interval_label_first")
def interval_label_first(spark, sf):
    rows = a.bare_readings(spark, sf).select("raw_index", "event_time")
    return normalize.with_interval_label(rows, E_, a.OVERLAPPING, on_overlap="first")


def _labelled(spark, sf) -> DataFrame:
    rows = normalize.with_deltas(normalize.with_state(a.bare_readings(spark, sf), E_), E_)
    return features.horizon_labels(rows, E_, a.CALENDAR)


@query("rul_seconds")
def rul_seconds(spark, sf):
    return _labelled(spark, sf).select("raw_index", "rul_seconds")


@query("seconds_to_next")
def seconds_to_next(spark, sf):
    """Time from each reading to the next error event; the event table grows with the data."""
    rows = a.bare_readings(spark, sf)
    errors = rows.filter(F.col("d_error") == 1).select(F.col("event_time").alias("error_time"))
    timed = rows.select("raw_index", "event_time")
    return ordered.seconds_to_next(timed, errors, ordered.Order("event_time", "raw_index"), "error_time").select(
        "raw_index", "seconds_to_next"
    )


@query("seconds_to_next_by_key")
def seconds_to_next_by_key(spark, sf):
    rows = a.bare_readings(spark, sf)
    errors = rows.filter(F.col("d_error") == 1).select("equipment_id", F.col("event_time").alias("error_time"))
    timed = rows.select("raw_index", "equipment_id", "event_time")
    order = ordered.Order("event_time", "raw_index", ("equipment_id",))
    return ordered.seconds_to_next(timed, errors, order, "error_time").select("raw_index", "seconds_to_next")


_KEY_COLUMNS = ["mean_pressure", "std_temperature", "slope_delta_pt", "state_transition_count"]


def _feature_copies(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Features from full and from single-precision sensors."""
    full = features.base_features(a.bare_readings(spark, sf), E_, a.CALENDAR)
    single = a.bare_readings(spark, sf).withColumns(
        {n: F.col(n).cast("float").cast("double") for n in E_.names}
    )
    return full, features.base_features(single, E_, a.CALENDAR)


def _profiles(spark, sf) -> tuple[DataFrame, DataFrame]:
    full, single = _feature_copies(spark, sf)
    args = (E_.bucket, features.FLAGS, _KEY_COLUMNS)
    return reconcile.feature_profile(single, *args), reconcile.feature_profile(full, *args)


@query("profile_parity", 4)
def profile_parity(spark, sf):
    return reconcile.profile_parity(*_profiles(spark, sf))


def _model_metrics(spark, sf) -> DataFrame:
    """Metrics of three score rules on two sources, one rule untrained in one of them."""
    rows = a.scored(spark, sf)
    rules = {"plain": F.col("score"), "inverse": 1.0 - F.col("score"), "flat": F.col("score") * 0.5}
    parts = []
    # a text file keeps two places of each score
    as_text = rows.withColumn("score", F.floor(F.col("score") * 100.0) / F.lit(100.0))
    for source, chosen in (("csv_derived", as_text), ("warehouse_derived", rows)):
        for name, score in rules.items():
            made = chosen.select("event_time", "label", score.alias("score"))
            metrics = evaluate.classification_metrics(made, "score", "label", "event_time", 0.5)
            skipped = source == "csv_derived" and name == "flat"
            parts.append(
                metrics.select(
                    F.lit(source).alias("source_type"),
                    F.lit(name).alias("model_name"),
                    F.lit("skipped" if skipped else "trained").alias("status"),
                    "precision",
                    "recall",
                    "f1",
                    "false_alarms_per_day",
                )
            )
    return reduce(DataFrame.unionByName, parts)


MEASURES = ["precision", "recall", "f1", "false_alarms_per_day"]


@query("metric_delta")
def metric_delta(spark, sf):
    return reconcile.metric_delta(_model_metrics(spark, sf), "csv_derived", "warehouse_derived", MEASURES)


@query("failure_contrast")
def failure_contrast(spark, sf):
    return analysis.failure_contrast(a.readings(spark, sf), E_)


@query("segment_contrast")
def segment_contrast(spark, sf):
    return analysis.segment_contrast(analysis.segment_means(_labelled(spark, sf), E_), E_)


# ---- aggregations ------------------------------------------------------------------


@query("kpi_overall")
def kpi_overall(spark, sf):
    return kpi.overall_kpi(a.readings(spark, sf), E_)


@query("kpi_window")
def kpi_window(spark, sf):
    return kpi.window_kpi(a.readings(spark, sf), E_)


@query("kpi_window_wide")
def kpi_window_wide(spark, sf):
    return kpi.window_kpi(a.wide_readings(spark, sf), a.WIDE)


@query("kpi_sensor")
def kpi_sensor(spark, sf):
    return kpi.sensor_kpi(a.readings(spark, sf), E_)


@query("kpi_sensor_wide", 3)
def kpi_sensor_wide(spark, sf):
    return kpi.sensor_kpi(a.wide_readings(spark, sf), a.WIDE)


@query("kpi_state")
def kpi_state(spark, sf):
    return kpi.state_kpi(a.readings(spark, sf), E_, AVERAGES)


@query("daily_counts")
def daily_counts(spark, sf):
    return kpi.daily_counts(a.readings(spark, sf), E_)


@query("daily_stats")
def daily_stats(spark, sf):
    return quality.daily_stats(a.readings(spark, sf), E_)


@query("daily_outliers")
def daily_outliers(spark, sf):
    return quality.daily_outliers(a.wide_readings(spark, sf), a.WIDE)


@query("duplicate_times")
def duplicate_times(spark, sf):
    return quality.duplicate_times(a.wide_readings(spark, sf), a.WIDE)


def _with_nulls(spark, sf) -> DataFrame:
    i = F.col("raw_index")
    return a.readings(spark, sf).withColumns(
        {
            "pressure": F.when(i % 41 != 0, F.col("pressure")),
            "d_view": F.when(i % 43 != 0, F.col("d_view")),
        }
    )


@query("null_counts")
def null_counts(spark, sf):
    return quality.null_counts(_with_nulls(spark, sf), ["event_time", "operating_state", *E_.names])


@query("value_counts")
def value_counts(spark, sf):
    rows = quality.value_counts(_with_nulls(spark, sf), E_.digital)
    return rows.withColumn("value", F.coalesce(F.col("value"), F.lit(-1.0)))


@query("category_counts")
def category_counts(spark, sf):
    return quality.category_counts(a.readings(spark, sf), ["failure_type", "operating_state"])


@query("risk_level_counts")
def risk_level_counts(spark, sf):
    return _risk_events(spark, sf).groupBy("risk_level").agg(F.count("*").alias("event_rows"))


@query("analog_summary")
def analog_summary(spark, sf):
    return quality.analog_summary(a.readings(spark, sf), E_)


@query("time_bounds")
def time_bounds(spark, sf):
    return quality.time_bounds(a.readings(spark, sf), E_)


@query("weighted_rollup")
def weighted_rollup(spark, sf):
    rows = kpi.window_kpi(a.readings(spark, sf), E_)
    return kpi.weighted_rollup(rows, [E_.bucket, "dt"], ["avg_pressure", "avg_temperature"])


@query("dash_window")
def dash_window(spark, sf):
    return dashboards.window_dashboard(spark, _views(spark, sf)["window"], AVERAGES)


@query("long_counts")
def long_counts(spark, sf):
    return kpi.long_counts(_layer(spark, sf, "sensor_long"))


@query("long_counts_wide")
def long_counts_wide(spark, sf):
    return kpi.rows_per_sensor(a.readings(spark, sf), E_)


@query("long_counts_sql")
def long_counts_sql(spark, sf):
    _layer(spark, sf, "sensor_long").createOrReplaceTempView("sensor_long_view")
    return dashboards.rows_per_sensor(spark, "sensor_long_view")


@query("ods_count")
def ods_count(spark, sf):
    a.readings(spark, sf).createOrReplaceTempView("readings_view")
    return dashboards.readings_count(spark, "readings_view")


@query("window_consistency")
def window_consistency(spark, sf):
    return dashboards.window_totals(spark, _views(spark, sf)["window"])


@query("label_summary")
def label_summary(spark, sf):
    return analysis.label_summary(_labelled(spark, sf))


@query("rul_summary")
def rul_summary(spark, sf):
    return analysis.remaining_time_summary(_labelled(spark, sf))


@query("segment_means")
def segment_means(spark, sf):
    return analysis.segment_means(_labelled(spark, sf), E_)


@query("volatility_rank")
def volatility_rank(spark, sf):
    return analysis.volatility_rank(a.readings(spark, sf), E_)


_CORR = [*C_.analog, "delta_tp3_reservoirs", "delta_tp2_tp3"]


def _corr(spark, sf) -> DataFrame:
    rows = normalize.with_deltas(a.compressor(spark, sf), C_)
    # tp2 and motor_current are one signal here, which would tie the ranking
    return analysis.correlation_matrix(rows, [c for c in _CORR if c != "motor_current"])


@query("corr_matrix")
def corr_matrix(spark, sf):
    return _corr(spark, sf)


@query("corr_top")
def corr_top(spark, sf):
    return analysis.top_correlations(_corr(spark, sf), _CORR, 10)


@query("hourly_mean")
def hourly_mean(spark, sf):
    return analysis.resample_mean(_with_nulls(spark, sf), E_, ["pressure", "temperature"])


@query("daily_transitions")
def daily_transitions(spark, sf):
    return analysis.daily_transitions(a.readings(spark, sf), E_)


def _base(spark, sf) -> DataFrame:
    return features.base_features(a.bare_readings(spark, sf), E_, a.CALENDAR)


@query("minute_features")
def minute_features(spark, sf):
    return _base(spark, sf).drop(*[f"slope_{n}" for n in E_.signals])


@query("minute_slope")
def minute_slope(spark, sf):
    return _base(spark, sf).select(E_.bucket, *[f"slope_{n}" for n in E_.signals])


@query("layer_summary")
def layer_summary(spark, sf):
    layers = _layers(spark, sf)
    layers.pop("overall_kpi")
    rows = quality.layer_summary(layers, E_)
    numbers = [c for c in rows.columns if c not in ("layer", "min_time", "max_time")]
    return rows.na.fill(-1, numbers).na.fill("none", ["min_time", "max_time"])


@query("feature_profile")
def feature_profile(spark, sf):
    return reconcile.feature_profile(_base(spark, sf), E_.bucket, features.FLAGS, _KEY_COLUMNS)


# ---- ordered windows ---------------------------------------------------------------


@query("interval_stats")
def interval_stats(spark, sf):
    return quality.interval_stats(a.bare_readings(spark, sf), E_)


@query("interval_hist")
def interval_hist(spark, sf):
    return quality.interval_hist(a.bare_readings(spark, sf), E_)


@query("top_gaps")
def top_gaps(spark, sf):
    return quality.top_gaps(a.bare_readings(spark, sf), E_)


@query("state_transitions")
def state_transitions(spark, sf):
    return features.with_changes(a.readings(spark, sf), E_).select("raw_index", "state_transition_flag")


@query("toggles")
def toggles(spark, sf):
    rows = features.with_changes(a.readings(spark, sf), E_)
    return rows.select("raw_index", *[f"toggle_{d}" for d in E_.digital])


@query("keyed_transitions")
def keyed_transitions(spark, sf):
    """State changes per equipment, for fleets."""
    from dataclasses import replace

    spec = replace(E_, by=("equipment_id",))
    return features.with_changes(a.readings(spark, sf), spec).select("raw_index", "state_transition_flag")


def _split_stats(quantiles: bool) -> list[rolling.Stat]:
    return [s for s in features.rolling_stats(E_) if (s[0] in ("q25", "q75")) == quantiles]


def _rolled(spark, sf, quantiles: bool) -> DataFrame:
    stats = _split_stats(quantiles)
    rows = rolling.with_rolling(_base(spark, sf), E_.bucket, E_.bucket_unit, stats)
    return rows.select(E_.bucket, *[f"roll{n}_{k}_{c}" for k, c, n in stats])


@query("rolling_stats")
def rolling_stats(spark, sf):
    return _rolled(spark, sf, False)


@query("rolling_quantiles")
def rolling_quantiles(spark, sf):
    return _rolled(spark, sf, True)


@query("feature_table")
def feature_table(spark, sf):
    return features.feature_table(a.bare_readings(spark, sf), E_, a.CALENDAR)


@query("compressor_feature_table", None)
def compressor_feature_table(spark, sf):
    """The 507-column table of the 15-sensor compressor, at minutes."""
    return features.feature_table(a.compressor(spark, sf), C_, a.CALENDAR)


@query("downsample")
def downsample(spark, sf):
    rows = a.bare_readings(spark, sf).select("raw_index", "event_time", "pressure")
    return ordered.downsample(rows, ordered.Order("event_time", "raw_index"), 300)


@query("ordered_split")
def ordered_split(spark, sf):
    rows = kpi.window_kpi(a.readings(spark, sf), E_).select(E_.bucket, "operating_state", "sample_count")
    return ordered.ordered_split(rows, ordered.Order(E_.bucket, text_tie="operating_state"))


@query("chrono_split")
def chrono_split(spark, sf):
    rows = a.bare_readings(spark, sf)
    return evaluate.split_check(evaluate.chrono_split(rows, "event_time", a.TRAIN_END, a.VALID_END), "event_time")


@query("average_precision")
def average_precision(spark, sf):
    return evaluate.average_precision(a.scored(spark, sf), "score", "label", "event_time")


@query("average_precision_grouped")
def average_precision_grouped(spark, sf):
    return evaluate.average_precision_grouped(a.scored(spark, sf), "score", "label")


# ---- dashboards --------------------------------------------------------------------


@query("dash_sensor")
def dash_sensor(spark, sf):
    return dashboards.sensor_dashboard(spark, _views(spark, sf)["sensor"])


@query("latest_risk")
def latest_risk(spark, sf):
    _risk_events(spark, sf).createOrReplaceTempView("risk_events_view")
    return dashboards.latest_risk(spark, "risk_events_view")


def _window_state(spark, sf) -> DataFrame:
    return kpi.window_state_kpi(kpi.window_kpi(a.readings(spark, sf), E_), E_, AVERAGES)


@query("dash_window_state")
def dash_window_state(spark, sf):
    _window_state(spark, sf).createOrReplaceTempView("window_state_view")
    return dashboards.window_state_dashboard(spark, "window_state_view", AVERAGES)


@query("dash_models")
def dash_models(spark, sf):
    rows = reconcile.metric_delta(_model_metrics(spark, sf), "csv_derived", "warehouse_derived", MEASURES)
    rows.createOrReplaceTempView("model_metrics_view")
    return dashboards.model_page(spark, "model_metrics_view", ["csv_derived", "warehouse_derived"], MEASURES)


@query("dash_labels")
def dash_labels(spark, sf):
    analysis.label_summary(_labelled(spark, sf)).createOrReplaceTempView("label_summary_view")
    return dashboards.label_page(spark, "label_summary_view")


@query("attention_top")
def attention_top(spark, sf):
    rows = a.readings(spark, sf)
    return analysis.attention_sensors(analysis.failure_contrast(rows, E_), kpi.sensor_kpi(rows, E_))


@query("consistency_metrics")
def consistency_metrics(spark, sf):
    kpi.sensor_kpi(a.readings(spark, sf), E_).createOrReplaceTempView("sensor_table_view")
    _window_state(spark, sf).createOrReplaceTempView("window_state_view")
    return dashboards.consistency_metrics(
        spark, {"sensor": "sensor_table_view", "window_state": "window_state_view"}
    )


# ---- labels ------------------------------------------------------------------------


@query("interval_calendar")
def interval_calendar(spark, sf):
    """Calendar rows made from orders, with faults by rule, cleaned."""
    i = F.col("o_orderkey")
    start = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    end = F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss")
    kind = F.when(i % 3 == 0, F.concat(F.col("o_orderpriority"), F.lit("_high"))).otherwise(F.col("o_orderpriority"))
    text = (
        F.when(i % 97 == 0, F.concat_ws("|", start, kind))
        .when(i % 89 == 0, F.concat_ws("|", F.lit("soon"), end, kind))
        .when(i % 83 == 0, F.concat_ws("|", start, end, F.lit(" ")))
        .when(i % 79 == 0, F.concat_ws("|", end, start, kind))
        .otherwise(F.concat_ws(" | ", start, end, kind))
    )
    raw = a.table(spark, sf, "orders").select(i.alias("line_no"), text.alias("line"))
    rows = labels.interval_calendar(raw, "line", "line_no")
    return rows.select(
        "line_no",
        F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start_time"),
        F.date_format("end", "yyyy-MM-dd HH:mm:ss").alias("end_time"),
        "interval_type",
        "severity",
        F.concat_ws(",", "issues").alias("issues"),
    ).na.fill("none")


@query("calendar_overlaps")
def calendar_overlaps(spark, sf):
    """Intervals of a table that start before an earlier one ends, per customer."""
    orders = a.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("equipment_id"),
        F.col("o_orderkey").alias("interval_id"),
        F.col("o_orderdate").alias("start"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("end"),
    )
    return labels.with_overlap_flag(orders, ("equipment_id",)).select("interval_id", "overlaps_earlier")


@query("interval_flags_by_table")
def interval_flags_by_table(spark, sf):
    """Membership and horizons against a large keyed calendar (orders of each customer)."""
    orders = a.table(spark, sf, "orders")
    rows = orders.select(
        F.col("o_orderkey").alias("raw_index"),
        F.col("o_custkey").alias("equipment_id"),
        (F.col("o_orderdate") + F.expr("INTERVAL 20 DAYS")).alias("event_time"),
    )
    calendar = orders.select(
        F.col("o_custkey").alias("equipment_id"),
        F.col("o_orderdate").alias("start"),
        (F.col("o_orderdate") + F.expr("INTERVAL 12 DAYS")).alias("end"),
    )
    flagged = labels.flags_by_table(rows, calendar, ordered.Order("event_time", "raw_index", ("equipment_id",)), 24, 24)
    return flagged.select("raw_index", "failure_window", "pre_failure", "post_maintenance")


KEYED = replace(E_, by=("equipment_id",))


@query("labels_by_table")
def labels_by_table(spark, sf):
    """Every label against all orders as incidents of their own equipment."""
    rows = features.horizon_labels(a.bare_readings(spark, sf), KEYED, a.order_calendar(spark, sf))
    return rows.select("raw_index", *features.FLAGS, "failure_type", "rul_seconds")


@query("labels_by_table_first")
def labels_by_table_first(spark, sf):
    """One calendar for all equipment; of incidents that overlap the one listed first gives the type."""
    calendar = a.order_calendar(spark, sf).drop("equipment_id")
    rows = calendars.labels_by_table(a.bare_readings(spark, sf), calendar, features.row_order(E_), on_overlap="first")
    return rows.select("raw_index", "failure_window", "failure_type", "rul_seconds")


@query("feature_table_by_calendar")
def feature_table_by_calendar(spark, sf):
    """The feature table per equipment, labelled by a calendar table."""
    rows = features.feature_table(a.bare_readings(spark, sf), KEYED, a.order_calendar(spark, sf))
    return rows.select("equipment_id", E_.bucket, "sample_count", *features.FLAGS, "rul_seconds", "mean_pressure", "roll5_mean_mean_pressure")


@query("lead_time_by_table")
def lead_time_by_table(spark, sf):
    rows = a.bare_readings(spark, sf).withColumn("prediction", (F.col("pressure") >= 60).cast("int"))
    return calendars.lead_time_by_table(rows, a.order_calendar(spark, sf), "event_time", "prediction", ("equipment_id",))


@query("horizon_labels")
def horizon_labels(spark, sf):
    return _labelled(spark, sf).select("raw_index", *features.FLAGS, "failure_type")


@query("label_segment")
def label_segment(spark, sf):
    return _labelled(spark, sf).select("raw_index", features.label_segment().alias("segment"))


# ---- streaming ---------------------------------------------------------------------


@query("gate_basic")
def gate_basic(spark, sf):
    gate = pipeline.gated(ev.decode_events(a.payloads(spark, sf), C_), gates.basic_rules(C_))
    return gate.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("event_rows"))


@query("gate_strict")
def gate_strict(spark, sf):
    gate = pipeline.gated(ev.decode_events(a.payloads(spark, sf), C_), gates.strict_rules(C_))
    return gate.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("event_rows"))


@query("kpi_1m")
def kpi_1m(spark, sf):
    return pipeline.minute_kpi(_valid_events(spark, sf), C_, "event_time")


#: Files a batch of a stream over several reads, so that writing and reading them is shared by as many tasks.
BATCH_FILES = 6


def _payload_files(spark, sf, copies: int = 1, batches: int = 1) -> str:
    """Payloads as text files; for several batches, events are dealt to them without regard to time."""
    path = scratch_path(spark, "payloads")
    rows = a.payloads(spark, sf)
    rows = rows.repartition(batches * BATCH_FILES, F.xxhash64("value")) if batches > 1 else rows
    for _ in range(copies):
        rows.write.mode("append").text(path)
    return path


def _stream(spark, sf, copies: int = 1, batches: int = 1) -> DataFrame:
    each = BATCH_FILES if batches > 1 else None
    return ev.decode_events(ev.text_source(spark, _payload_files(spark, sf, copies, batches), each), C_)


def _stream_valid(spark, sf, copies: int = 1, batches: int = 1) -> DataFrame:
    return pipeline.accepted(pipeline.gated(_stream(spark, sf, copies, batches), gates.strict_rules(C_)))


def _drain(spark, rows: DataFrame, partitions=()) -> DataFrame:
    path, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "checkpoint")
    jobs.append_parquet(rows, path, checkpoint, partitions, NOW).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


@query("stream_ods")
def stream_ods(spark, sf):
    rows = _drain(spark, pipeline.readings_with_day(_stream_valid(spark, sf), C_), ["dt"])
    return rows.select("event_id", "raw_index", "event_time", "operating_state", "tp2", F.col("dt").cast("string"))


@query("stream_dlq")
def stream_dlq(spark, sf):
    gate = pipeline.gated(_stream(spark, sf), gates.strict_rules(C_))
    rows = _drain(spark, pipeline.rejected(gate, C_))
    return rows.groupBy("reason", "payload").agg(F.count("*").alias("event_rows"))


def _event_kpi(spark, sf) -> jobs.MinuteKpi:
    kpis = jobs.MinuteKpi(C_, scratch_path(spark, "event-kpi"))
    rows = _stream_valid(spark, sf, batches=8)
    jobs.each_batch(rows, kpis.handle, scratch_path(spark, "checkpoint"), trigger=NOW).awaitTermination()
    return kpis


@query("stream_event_kpi")
def stream_event_kpi(spark, sf):
    """Eight batches of events in no order of time; every one of them counts."""
    return _event_kpi(spark, sf).read(spark).drop("window_start")


@query("stream_late_rows")
def stream_late_rows(spark, sf):
    """Rows of all batches, the late ones among them included."""
    return _event_kpi(spark, sf).late(spark).agg(
        F.sum("event_rows").alias("event_rows"), (F.sum("late_rows") > 0).alias("has_late_rows"), F.max("newest").alias("newest")
    )


@query("stream_kpi_1m")
def stream_kpi_1m(spark, sf):
    """Arrival-time KPI; which minute rows arrive in differs per run, so totals are shown."""
    kept = stores.ParquetStore(scratch_path(spark, "arrival"), ["minute_bucket", "operating_state"], ["sample_count"])
    rows = pipeline.arrival_kpi(_stream_valid(spark, sf), C_)
    jobs.each_batch(rows, kept.write, scratch_path(spark, "checkpoint"), "update", NOW).awaitTermination()
    return kept.read(spark).groupBy("operating_state").agg(
        F.sum("sample_count").alias("sample_count"), F.sum("failure_sample_count").alias("failure_sample_count")
    )


@query("stream_risk")
def stream_risk(spark, sf):
    rows = _drain(spark, _risk_events(spark, sf, _stream_valid(spark, sf)), ["dt"])
    return rows.select("event_id", "event_time", "risk_score", "risk_level", "risk_reason", F.col("dt").cast("string"))


@query("stream_dedup")
def stream_dedup(spark, sf):
    """The source delivers every event twice, far apart; each id is kept once."""
    sink = jobs.FirstSeen(C_, scratch_path(spark, "unique"))
    rows = _stream_valid(spark, sf, 2, 4)
    jobs.each_batch(rows, sink.handle, scratch_path(spark, "checkpoint"), trigger=NOW).awaitTermination()
    return sink.read(spark, rows.schema).select("event_id", "raw_index", "event_time")


def _fan_out(spark, sf):
    kpi = stores.ParquetStore(scratch_path(spark, "kpi-state"), ["window_start", "operating_state"], ["sample_count"], compact_every=3)
    risk_rows = stores.ParquetStore(scratch_path(spark, "risk-state"), ["equipment_id"], ["event_time", "raw_index"], compact_every=3)
    job = jobs.FanOut(C_, gates.strict_rules(C_), scratch_path(spark, "fanout"), kpi, risk_rows)
    source = ev.text_source(spark, _payload_files(spark, sf, 2, 4), files_per_batch=BATCH_FILES)
    job.start(source, scratch_path(spark, "checkpoint"), NOW).awaitTermination()
    return job


@query("stream_fanout")
def stream_fanout(spark, sf):
    job = _fan_out(spark, sf)
    minutes = job.kpi_state.read(spark)
    parts = {
        # rejected events have no id to know them by, so both deliveries are there
        "dead_letters": job.read(spark, "dead_letters").agg(F.count("*")),
        "readings": job.read(spark, "readings").agg(F.count("*")),
        "risk_events": job.read(spark, "risk_events").agg(F.count("*")),
        "minute_rows": minutes.agg(F.count("*")),
        "minute_samples": minutes.agg(F.sum("sample_count")),
        "latest_raw_index": job.risk_state.read(spark).agg(F.max("raw_index")),
    }
    rows = [df.toDF("value").select(F.lit(n).alias("output"), F.col("value").cast("long")) for n, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)


@query("stream_fanout_kpi")
def stream_fanout_kpi(spark, sf):
    """The KPI cache after eight batches, each event delivered twice."""
    return _fan_out(spark, sf).kpi_state.read(spark).drop("window_start")


@query("stream_fanout_readings")
def stream_fanout_readings(spark, sf):
    rows = _fan_out(spark, sf).read(spark, "readings")
    return rows.select("event_id", "raw_index", "event_time", "operating_state", *C_.names, "dt")


# ---- quality -----------------------------------------------------------------------


@query("profile")
def profile(spark, sf):
    return quality.profile(_with_nulls(spark, sf), E_, 10_000)


@query("expectations")
def expectations(spark, sf):
    rows = a.readings(spark, sf)
    nulls = quality.null_counts(rows, ["event_time", "operating_state", *E_.names])
    metrics = [
        rows.agg(F.count("*").alias("value")).select(F.lit("reading_rows").alias("metric"), "value"),
        kpi.sensor_kpi(rows, E_).agg(F.count("*").alias("value")).select(F.lit("sensor_rows").alias("metric"), "value"),
        rows.agg(F.countDistinct("dt").alias("value")).select(F.lit("active_days").alias("metric"), "value"),
        nulls.agg(F.sum("null_rows").alias("value")).select(F.lit("null_total").alias("metric"), "value"),
    ]
    wanted = {
        "reading_rows": quality.POSITIVE,
        "sensor_rows": 5,
        "active_days": 31,
        "null_total": 0,
        "absent": quality.POSITIVE,
    }
    out = quality.check_expectations(reduce(DataFrame.unionByName, metrics), wanted)
    return out.withColumn("actual", F.coalesce("actual", F.lit(-1.0)))


@query("layer_alignment")
def layer_alignment(spark, sf):
    layers = _layers(spark, sf)
    layers.pop("overall_kpi")
    layers["features"] = _base(spark, sf)
    return quality.layer_alignment(quality.layer_summary(layers, E_), len(E_.names))


def _reconciled(spark, sf) -> dict[str, DataFrame]:
    """KPIs of all days next to a stored copy of all days, and next to a copy that lacks one day."""
    rows = kpi.window_kpi(a.readings(spark, sf), E_)
    measures = ["sample_count", "failure_sample_count"]
    out = {}
    for pair, kept in (("whole_copy", F.lit(True)), ("copy_without_a_day", F.col("dt") != "2024-01-05")):
        path = scratch_path(spark, "copy")
        rows.filter(kept).write.parquet(path)
        out[pair] = reconcile.reconcile(rows, spark.read.parquet(path), ["dt", "operating_state"], measures)
    return out


@query("reconcile", 3)
def reconcile_(spark, sf):
    pairs = _reconciled(spark, sf)
    return reduce(DataFrame.unionByName, [checks.withColumn("pair", F.lit(pair)) for pair, checks in pairs.items()])


@query("comparison_status")
def comparison_status(spark, sf):
    """Overall verdict of a comparison: models trained in both sources, and the two stores they read."""
    metrics = _model_metrics(spark, sf)
    models = metrics.groupBy("model_name").agg(F.min(F.when(F.col("status") == "trained", "PASS").otherwise("FAIL")).alias("status"))
    compared = models.filter(F.col("model_name") != "flat")
    pairs = _reconciled(spark, sf)
    asked = {
        "same_stores": [compared, pairs["whole_copy"]],
        "a_day_lost": [compared, pairs["copy_without_a_day"]],
        "a_model_not_trained": [models, pairs["whole_copy"]],
    }
    return reduce(DataFrame.unionByName, [reconcile.comparison_status(checks).select(F.lit(name).alias("comparison"), "status") for name, checks in asked.items()])


@query("parity_verdicts")
def parity_verdicts(spark, sf):
    rows = a.readings(spark, sf)
    window = kpi.window_kpi(rows, E_)
    return reconcile.parity_verdicts(
        reconcile.profile_parity(*_profiles(spark, sf)),
        rows.agg(F.countDistinct(E_.bucket)),
        window.agg(F.sum("sample_count")),
        rows.agg(F.count("*")),
    )


@query("label_populated")
def label_populated(spark, sf):
    summary = analysis.label_summary(_labelled(spark, sf))
    return analysis.label_populated(summary, ["failure_window", "pre_failure_24h", "normal_candidate", "absent"])


# ---- models ------------------------------------------------------------------------


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder, because what follows reads it many times."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _features(spark, sf) -> DataFrame:
    return _stored(features.feature_table(a.bare_readings(spark, sf), E_, a.CALENDAR), "features")


def _model_frame(table: DataFrame) -> tuple[DataFrame, list[str]]:
    names = features.model_feature_names(E_, table.columns)
    keep = [E_.bucket, "pre_failure_24h", "failure_window", "normal_candidate"]
    rows = evaluate.model_rows(table).select(*keep, *names)
    return evaluate.chrono_split(rows, E_.bucket, a.TRAIN_END, a.VALID_END), names


@query("model_input")
def model_input(spark, sf):
    rows, _ = _model_frame(features.feature_table(a.bare_readings(spark, sf), E_, a.CALENDAR))
    return rows


@query("class_weights")
def class_weights(spark, sf):
    rows = a.scored(spark, sf).filter(F.col("event_time") < a.TRAIN_END)
    return evaluate.class_weights(rows, "label")


@query("clean_matrix", 5)
def clean_matrix(spark, sf):
    rows, _ = _model_frame(_base(spark, sf))
    names = [f"{k}_{n}" for n in E_.signals for k in ("mean", "std", "slope")]
    scaler = matrix.fit_scaler(rows.filter(F.col("split") == "train"), names)
    return scaler.transform(rows).select(E_.bucket, "split", *names)


def _trained(spark, sf) -> tuple[DataFrame, list[str]]:
    rows, names = _model_frame(_features(spark, sf))
    scaler = matrix.fit_scaler(rows.filter(F.col("split") == "train"), names)
    return _stored(scaler.transform(rows), "matrix"), names


def _evaluated(scored: DataFrame, name: str) -> DataFrame:
    """Threshold from validation, metrics on test."""
    scored = _stored(scored.select(E_.bucket, "split", "pre_failure_24h", "score"), "scores")
    valid = scored.filter(F.col("split") == "validation")
    best = evaluate.best_threshold(valid, "score", "pre_failure_24h").first()["threshold"]
    metrics = evaluate.classification_metrics(
        scored.filter(F.col("split") == "test"), "score", "pre_failure_24h", E_.bucket, best
    )
    return metrics.select(F.lit(name).alias("model_name"), F.lit(best).alias("threshold"), "*")


@query("model_logistic")
def model_logistic(spark, sf):
    rows, names = _trained(spark, sf)
    model = linear.fit_logistic(rows.filter(F.col("split") == "train"), names, "pre_failure_24h")
    return _evaluated(model.scored(rows), "logistic")


@query("model_gradient")
def model_gradient(spark, sf):
    rows, names = _trained(spark, sf)
    train = rows.filter(F.col("split") == "train")
    model = linear.fit_gradient(train, names, "pre_failure_24h")
    return _evaluated(rows.withColumn("score", model.score()), "gradient")


@query("model_forest")
def model_forest(spark, sf):
    rows, names = _trained(spark, sf)
    model = forest.fit_forest(rows.filter(F.col("split") == "train"), names, "pre_failure_24h")
    return _evaluated(model.scored(rows), "forest")


@query("model_iforest")
def model_iforest(spark, sf):
    rows, names = _trained(spark, sf)
    normal = rows.filter((F.col("split") == "train") & (F.col("pre_failure_24h") == 0))
    normal = normal.withColumn("row_id", F.unix_timestamp(E_.bucket))
    model = isolation.fit_isolation(normal, names, "row_id")
    return _evaluated(model.score(rows), "isolation_forest")


@query("model_bounds")
def model_bounds(spark, sf):
    """All models trained on one matrix: every row gets a score, scores keep to their range, and supervised ones separate the classes they learned."""
    rows, names = _trained(spark, sf)
    train = rows.filter(F.col("split") == "train")
    target = "pre_failure_24h"
    normal = train.filter(F.col(target) == 0).withColumn("row_id", F.unix_timestamp(E_.bucket))
    supervised = {
        "logistic": linear.fit_logistic(train, names, target),
        "gradient": linear.fit_gradient(train, names, target),
        "forest": forest.fit_forest(train, names, target),
    }
    scored = {name: (model.scored(rows), 0.0, 1.0) for name, model in supervised.items()}
    scored["isolation_forest"] = (isolation.fit_isolation(normal, names, "row_id").score(rows), -0.5, 0.5)
    mean_of = lambda y: F.avg(F.when(F.col(target) == y, F.col("score")))
    parts = []
    for name, (df, low, high) in scored.items():
        facts = df.groupBy("split").agg(
            F.count("*").alias("scored_rows"),
            F.sum(target).cast("long").alias("positive_rows"),
            F.count_if(F.col("score").isNull()).alias("null_scores"),
            F.min(F.col("score").between(low, high)).alias("in_range"),
            (mean_of(1) > mean_of(0)).alias("separates"),
        )
        learned = (F.col("split") == "train") & F.lit(name in supervised)
        parts.append(facts.select(F.lit(name).alias("model_name"), "*").withColumn("separates", F.when(learned, F.col("separates"))))
    return reduce(DataFrame.unionByName, parts)


@query("mad_anomaly", 5)
def mad_anomaly(spark, sf):
    rows, _ = _model_frame(_base(spark, sf))
    names = [f"{k}_{n}" for n in E_.signals for k in ("mean", "std")]
    model = mad.fit_mad(rows.filter(F.col("split") == "train"), names)
    return rows.select(E_.bucket, "split", model.score().alias("score"))


@query("threshold_sweep")
def threshold_sweep(spark, sf):
    return evaluate.threshold_sweep(a.scored(spark, sf), "score", "label")


@query("classification_metrics")
def classification_metrics(spark, sf):
    return evaluate.classification_metrics(a.scored(spark, sf), "score", "label", "event_time", 0.6)


def _alarms(spark, sf) -> DataFrame:
    rows = a.scored(spark, sf)
    return rows.withColumn("prediction", (F.col("score") >= 0.8).cast("int"))


@query("lead_time")
def lead_time(spark, sf):
    return evaluate.lead_time(_alarms(spark, sf), a.CALENDAR, "event_time", "prediction")


@query("lead_time_summary")
def lead_time_summary(spark, sf):
    return evaluate.lead_time_summary(evaluate.lead_time(_alarms(spark, sf), a.CALENDAR, "event_time", "prediction"))


@query("top_weights")
def top_weights(spark, sf):
    rows, names = _trained(spark, sf)
    model = linear.fit_logistic(rows.filter(F.col("split") == "train"), names, "pre_failure_24h")
    return evaluate.top_weights(rows, names, model.weights, 30)


@query("forest_importances")
def forest_importances(spark, sf):
    rows, names = _trained(spark, sf)
    model = forest.fit_forest(rows.filter(F.col("split") == "train"), names, "pre_failure_24h")
    return evaluate.top_weights(rows, names, model.importances, 30)


@query("score_table")
def score_table(spark, sf):
    rows, names = _trained(spark, sf)
    model = linear.fit_logistic(rows.filter(F.col("split") == "train"), names, "pre_failure_24h")
    scored = model.scored(rows.filter(F.col("split") == "test"))
    path = scratch_path(spark, "scores")
    out = scored.select(E_.bucket, "pre_failure_24h", "score", (F.col("score") >= 0.5).cast("int").alias("prediction"))
    out.write.parquet(path)
    return spark.read.parquet(path)
