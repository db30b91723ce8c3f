"""Registered queries and the SQL each one must agree with.

All queries run over the whole event and supplier tables. ``cellpulse.sources.events``
says how an event becomes an activity row; the SQL below states the same mapping
once more, independently, in ``oracle_queries``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellpulse.functions.digest import content_by_date, content_check
from cellpulse.operators import aggregate, analytics, asof, clean, clusters, drops, gate1, gate2, geo, reports, risk, sketches, spatial
from cellpulse.plans import ingest, publish
from cellpulse.plans.batch import run_landing, run_rows, stage_hourly, stage_rows
from cellpulse.schemas import MEASURES, RAW_COLUMNS
from cellpulse.session import prepare, scratch_path, stored
from cellpulse.sources import landing
from cellpulse.sources.events import (
    area_collections,
    geojson_of,
    landing_of,
    lattice_collections,
    read_activity,
    write_landing,
)
from cellpulse.sources.geojson import grid_lookup, read_geojson
from cellpulse.streaming import dedup, incremental
from oracle_queries import all_queries

try:
    import corpus_pipeline
    from cellpulse.llm import queries as corpus_queries
except ImportError:  # the operators for training text are an optional part, with packages of their own
    corpus_queries = None

RUN_AT = datetime(2024, 2, 1)
SMALL = "/root/testdata/sf0.001"


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Values that two engines can agree on: doubles rounded, times without a zone."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(F.round(column, 2 * digits), digits)
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# ---------------------------------------------------------------- inputs


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_activity(prepare(spark), sf_dir)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_activity(_raw(spark, sf_dir))


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.hourly_grid_summary(_clean(spark, sf_dir))


def _stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a table that a query reads several times, as the batch does, and read it back."""
    path = scratch_path(spark, label)
    return publish.write_by_date(df, path)


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored once, so that its size on disk tells how to join it."""
    return stored(grid_lookup(read_geojson(spark, geojson_of(spark, sf_dir), multi_line=False)), "lookup")


def _baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.grid_baseline(_hourly(spark, sf_dir))


def _hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.hotspots(_baseline(spark, sf_dir))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.activity_alerts(_hotspots(spark, sf_dir), RUN_AT)


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.hourly_spine(_stored(spark, _hourly(spark, sf_dir), "hourly"))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.risk_features(_spine(spark, sf_dir))


def _geometry_text(df: DataFrame) -> DataFrame:
    """The geometry as text, so that it can be compared: kind, points of the first ring, first corner."""
    ring = F.get(F.get("geometry.coordinates", F.lit(0)), F.lit(0))
    corner = F.get(ring, F.lit(0))
    return df.withColumns(
        {
            "geometry_type": F.col("geometry.type"),
            "ring_points": F.when(
                F.col("geometry").isNotNull(), F.size(ring)
            ),
            "corner_x": F.get(corner, F.lit(0)),
            "corner_y": F.get(corner, F.lit(1)),
        }
    ).drop("geometry")


# ---------------------------------------------------------------- files and file gate


def q_detect_files(spark, sf_dir):
    found = landing.detect_deliveries(prepare(spark), landing_of(spark, sf_dir))
    return found.select("filename", "file_date", (F.col("bytes") > 0).alias("has_content"))


def q_read_raw(spark, sf_dir):
    raw = landing.read_raw(prepare(spark), landing_of(spark, sf_dir))
    return raw.withColumn("filename", landing.delivery_name(F.col("_source_file"))).drop("_source_file")


def q_gate1_schema(spark, sf_dir):
    profile = gate1.profile_deliveries(prepare(spark), landing_of(spark, sf_dir))
    return gate1.schema_check(profile.layouts).select(
        "filename",
        F.array_join("missing_columns", ",").alias("missing_columns"),
        F.array_join("extra_columns", ",").alias("extra_columns"),
        "usual_order",
    )


def q_gate1_cadence(spark, sf_dir):
    profile = gate1.profile_deliveries(prepare(spark), landing_of(spark, sf_dir))
    return gate1.cadence_check(profile.counts)


def q_gate1_duplicates(spark, sf_dir):
    return gate1.duplicate_check(landing.read_raw(prepare(spark), landing_of(spark, sf_dir)))


def _verdict(mode):
    def query(spark, sf_dir):
        found, _ = gate1.judge_landing(prepare(spark), landing_of(spark, sf_dir), mode)
        return found.withColumns(
            {"reasons": F.array_join("reasons", "; "), "warnings": F.array_join("warnings", "; ")}
        )

    return query


def q_route_rows(spark, sf_dir):
    folder = landing_of(prepare(spark), sf_dir)
    out = scratch_path(spark, "zones")
    routed = ingest.ingest(spark, folder, out, "run-1", RUN_AT)
    return routed.groupBy("filename", "status", "reason").agg(F.count("*").alias("routed_rows"))


def _two_runs(spark, sf_dir):
    """The log after judging the same landing folder in reference mode, then in strict mode."""
    folder = landing_of(prepare(spark), sf_dir)
    out = scratch_path(spark, "log")
    for mode, hour in (("reference", 1), ("strict", 2)):
        found, _ = gate1.judge_landing(spark, folder, mode)
        ingest.append_log(ingest.log_records(found, datetime(2024, 2, 1, hour)), out)
    return ingest.read_log(spark, out)


def q_ingestion_log(spark, sf_dir):
    return present(_two_runs(spark, sf_dir))


def q_latest_log(spark, sf_dir):
    return present(reports.latest_log(_two_runs(spark, sf_dir)))


def q_daily_intake(spark, sf_dir):
    return present(reports.daily_intake(_two_runs(spark, sf_dir)))


def q_ingestion_health(spark, sf_dir):
    return present(reports.ingestion_health(_two_runs(spark, sf_dir)))


# ---------------------------------------------------------------- outputs


def q_readback_check(spark, sf_dir):
    out = scratch_path(prepare(spark), "readback")
    checked, rows_in = stage_rows(_raw(spark, sf_dir), f"{out}/checked", gather=True)
    valid = checked.where(F.col("row_status") == clean.ROW_VALID)
    hourly, hourly_rows = stage_hourly(valid, f"{out}/hourly")
    return content_check("checked_rows_readback", content_by_date(checked), rows_in).unionByName(
        content_check("hourly_rows_readback", content_by_date(hourly), hourly_rows)
    )


def q_gate2_checks(spark, sf_dir):
    valid = _clean(spark, sf_dir)
    hourly = _stored(spark, aggregate.hourly_grid_summary(valid), "hourly")
    spots = analytics.hotspots(analytics.grid_baseline(hourly))
    spots = _stored(spark, spots.withColumn("date", F.to_date("timestamp")), "hotspots")
    checks = gate2.gate2_checks(
        hourly,
        aggregate.daily_traffic_summary(hourly),
        spots,
        analytics.activity_alerts(spots, RUN_AT),
        lookup=_lookup(spark, sf_dir),
        compared=gate2.reconcile(valid, hourly),
    )
    return present(checks)


def q_gate2_reconcile(spark, sf_dir):
    return present(gate2.reconcile(_clean(spark, sf_dir), _hourly(spark, sf_dir)))


def q_stage_totals(spark, sf_dir):
    return present(gate2.country_reconcile(_clean(spark, sf_dir), _hourly(spark, sf_dir)))


def q_dashboard_csv(spark, sf_dir):
    """The rollup file, read back."""
    path = scratch_path(prepare(spark), "dashboard")
    summary = aggregate.dashboard_summary(_hourly(spark, sf_dir))
    publish.write_dashboard_csv(summary, path)
    return present(spark.read.schema(summary.schema).option("header", True).csv(path))


def q_dashboard_csv_order(spark, sf_dir):
    """The lines of the rollup file in their order: one per hour of the data."""
    path = scratch_path(prepare(spark), "dashboard")
    summary = aggregate.dashboard_summary(_hourly(spark, sf_dir))
    publish.write_dashboard_csv(summary, path)
    lines = spark.read.schema(summary.schema).option("header", True).csv(path).select(
        "timestamp", F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("place")
    )
    in_file = Window.orderBy("block", "place")
    return present(lines.select(F.row_number().over(in_file).cast("long").alias("line"), "timestamp"))


def q_published_views(spark, sf_dir):
    """The published tables by SQL, joined with each other."""
    out, _, _, _ = _published(spark, sf_dir)
    publish.register_views(spark, out, ["hourly_grid_summary", "daily_grid_summary"])
    return present(
        spark.sql(
            "select d.date, count(*) as cells, sum(d.daily_total_activity) as daily, sum(h.total) as hourly"
            " from daily_grid_summary d join (select date, grid_id, sum(total_activity) as total from hourly_grid_summary"
            " group by date, grid_id) h on h.date = d.date and h.grid_id = d.grid_id group by d.date"
        )
    )


def q_gate2_damaged(spark, sf_dir):
    """All checks over tables with a fault for each of them; none may pass."""
    valid = _clean(prepare(spark), sf_dir)
    hourly = _stored(spark, aggregate.hourly_grid_summary(valid), "hourly")
    day, hour = F.day("timestamp"), F.hour("timestamp")
    spots = analytics.hotspots(analytics.grid_baseline(hourly))
    alerts = analytics.activity_alerts(spots, RUN_AT).withColumn("baseline", F.lit(0.0))
    spots = spots.withColumn("baseline_activity", F.when(hour >= 16, F.col("baseline_activity")))
    daily = aggregate.daily_traffic_summary(hourly)
    daily = daily.withColumn(
        "daily_activity", F.when(F.day("date") == 9, -1 - F.col("daily_activity")).otherwise(F.col("daily_activity"))
    )
    twice = F.explode(F.when(day == 8, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    damaged = (
        hourly.where(day != 10)
        .withColumn("copy", twice)
        .withColumns(
            {
                "grid_id": F.when(day == 3, F.concat(F.lit("x"), "grid_id")).otherwise(F.col("grid_id")),
                "sms_in": F.when(day != 4, F.col("sms_in")),
                "call_in": F.when(day == 5, -1 - F.col("call_in")).otherwise(F.col("call_in")),
                "internet_activity": F.when(day == 6, F.lit(float("inf"))).otherwise(F.col("internet_activity")),
                "timestamp": F.when((day != 7) | (hour != 0), F.col("timestamp")),
            }
        )
    )
    lookup = _lookup(spark, sf_dir).withColumn("grid_id", F.concat(F.lit("z"), "grid_id"))
    scores = hourly.select(F.lit(2.0).alias("risk_score"))
    compared = gate2.reconcile(valid, damaged)
    return present(gate2.gate2_checks(damaged, daily, spots, alerts, lookup, compared, scores))


HALF_DAY = 14


def _full_days(spark, sf_dir):
    """Raw rows of all days, as a landing has them that passes the file gate: every cell at every hour, zeros where nothing happened."""
    hourly = _stored(spark, _hourly(spark, sf_dir), "hourly")
    rows = analytics.hourly_spine(hourly, carried=MEASURES)
    values = {"datetime": F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), "CellID": F.col("grid_id")}
    values |= {"countrycode": F.lit("39")}
    values |= {
        raw: F.when(F.col(m).isNull(), "0.000000").otherwise(F.round(m, 6).cast("decimal(20,6)").cast("string"))
        for raw, m in zip(RAW_COLUMNS[3:], MEASURES, strict=True)
    }
    name = F.concat(F.lit(landing.NAME_PREFIX), F.date_format("timestamp", "yyyy-MM-dd"), F.lit(".csv"))
    return rows.select(*[v.alias(c) for c, v in values.items()], name.alias("_source_file"))


def _published(spark, sf_dir):
    """A run of the whole pipeline over all days, file gate first; returns where, and what it says."""
    out = scratch_path(prepare(spark), "published")
    rows = _full_days(spark, sf_dir)
    write_landing(rows, f"{out}/landing", plain=True)
    reference = geojson_of(spark, sf_dir)
    result = run_landing(
        spark, f"{out}/landing", out, reference, "run-1", RUN_AT, multi_line_reference=False
    )
    return out, reference, rows, result


def q_published_counts(spark, sf_dir):
    out, _, _, _ = _published(spark, sf_dir)
    tables = (
        "checked_activity",
        "hourly_grid_summary",
        "daily_traffic_summary",
        "daily_grid_summary",
        "hotspots",
        "activity_alerts",
    )
    counts = None
    for table in tables:
        rows = publish.read_published(spark, out, table).groupBy("date").agg(F.count("*").alias("row_count"))
        rows = rows.select(F.lit(table).alias("table_name"), "date", "row_count")
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


def q_published_after_refusal(spark, sf_dir):
    """What readers see after the same run id has come again with half a day and was refused."""
    out, reference, rows, _ = _published(spark, sf_dir)
    half = rows.where(F.col("datetime").like(f"%-{HALF_DAY} 0%"))
    try:
        run_rows(
            spark, half, out, reference, "run-1", RUN_AT, multi_line_reference=False, gather_input=True
        )
        raise AssertionError("half a day was published")
    except publish.PublicationRefused:
        seen = publish.read_published(spark, out, "hourly_grid_summary")
    return present(
        seen.groupBy("date").agg(
            F.count("*").alias("row_count"), *[F.sum(m).alias(m) for m in (*MEASURES, "total_activity")]
        )
    )


def q_content_check(spark, sf_dir):
    """The hourly table as stored, and with one value of the first cell changed: the row count stays, the content does not."""
    out = scratch_path(prepare(spark), "content")
    hourly, went_in = stage_hourly(_clean(spark, sf_dir), f"{out}/hourly")
    first = hourly.agg(F.min(F.struct("grid_id", "timestamp"))).scalar()
    here = F.struct("grid_id", "timestamp") == first
    changed = hourly.withColumn("sms_in", F.when(here, F.col("sms_in") + 1).otherwise(F.col("sms_in")))
    changed = publish.write_by_date(changed, f"{out}/changed")
    return content_check("as_stored", content_by_date(hourly), went_in).unionByName(
        content_check("one_value_changed", content_by_date(changed), went_in)
    )


def q_published_content(spark, sf_dir):
    """Rows of each published table and date, and whether they are still those that the manifest knows."""
    out, _, _, _ = _published(spark, sf_dir)
    found = None
    for name in ("checked_activity", "hourly_grid_summary", "daily_grid_summary"):
        rows = publish.published_content(spark, out, name).select(F.lit(name).alias("table_name"), "*")
        found = rows if found is None else found.unionByName(rows)
    return found


def q_points_in_cells(spark, sf_dir):
    """Events as points, and the cells (with holes, triangles, two parts) that they fall into; points outside have none."""
    suppliers = prepare(spark).read.parquet(f"{sf_dir}/supplier.parquet")
    lookup = stored(grid_lookup(_read_collections(spark, area_collections(suppliers))), "areas")
    points = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        (F.col("user_id") % 120 + 0.37).alias("x"), (F.get_json_object("props", "$.k").cast("int") % 30 + 0.41).alias("y"), "value"
    )
    return present(spatial.totals_by_cell(points, lookup, "value"))


def _read_collections(spark, lines):
    """Collections written once as text and read by the GeoJSON source."""
    folder = scratch_path(spark, "areas")
    lines.write.text(folder)
    return read_geojson(spark, folder, multi_line=False)


def q_drop_hours(spark, sf_dir):
    return present(drops.drop_hours(_stored_spine(spark, sf_dir)))


def q_drop_episodes(spark, sf_dir):
    return present(drops.drop_episodes(drops.drop_hours(_stored_spine(spark, sf_dir))))


def q_hotspot_clusters(spark, sf_dir):
    """Hotspots of cells that lie side by side on a lattice, put together by shared edges."""
    suppliers = prepare(spark).read.parquet(f"{sf_dir}/supplier.parquet")
    lookup = stored(grid_lookup(_read_collections(spark, lattice_collections(suppliers))), "lattice")
    return present(clusters.hotspot_clusters(stored(_hotspots(spark, sf_dir), "hotspots"), lookup))


def q_alert_risk(spark, sf_dir):
    """Each alert with the last score at or before it that was not low, and how old that was."""
    features = stored(_features(prepare(spark), sf_dir), "features")
    scores = risk.risk_scores(risk.PUBLISHED, features, RUN_AT).where("risk_level <> 'LOW'")
    alerts = _alerts(spark, sf_dir).select("alert_id", "grid_id", "timestamp", "alert_level")
    found = asof.last_state(alerts, scores, carried=("risk_level", "risk_score"))
    age = (F.unix_timestamp("timestamp") - F.unix_timestamp("state_time")) / 3600
    return present(found.withColumn("age_hours", age.cast("long")))


def q_active_cells_by_week(spark, sf_dir):
    """Cells active in each week, counted, and whether the estimate from the stored daily sketches is within its error."""
    hourly = _stored(spark, _hourly(spark, sf_dir), "hourly")
    daily = publish.write_by_date(sketches.cell_sketches(hourly), scratch_path(spark, "sketches"))
    week = F.to_date(F.date_trunc("week", "date"))
    estimated = sketches.active_cells(daily, week).withColumnRenamed("active_cells", "estimate")
    exact = hourly.groupBy(week.alias("period")).agg(F.count_distinct("grid_id").alias("active_cells"))
    within = F.abs(F.col("estimate") - F.col("active_cells")) <= 0.05 * F.col("active_cells")
    return exact.join(estimated, "period").select("period", "active_cells", within.alias("within_error"))


def q_activity_distribution(spark, sf_dir):
    """Rows per hour of the day, and whether median and 90 % quantile of the merged daily sketches lie within the rank error."""
    hourly = _stored(spark, _hourly(spark, sf_dir).withColumn("hour", F.hour("timestamp")), "hourly")
    daily = publish.write_by_date(sketches.activity_sketches(hourly, ["hour"]), scratch_path(spark, "sketches"))
    found = stored(sketches.activity_quantiles(daily, ["hour"]), "quantiles")
    x, n = F.col("total_activity"), F.count("*")

    def within(p, name):
        below, upto = F.count_if(x < F.col(name)) / n, F.count_if(x <= F.col(name)) / n
        return ((below <= p + sketches.RANK_ERROR) & (upto >= p - sketches.RANK_ERROR)).alias(f"{name}_within")

    return hourly.join(found, "hour").groupBy("hour", "n_rows").agg(within(0.5, "p50"), within(0.9, "p90"))


def _stored_spine(spark, sf_dir):
    return stored(_spine(spark, sf_dir), "spine")


# ---------------------------------------------------------------- risk and streams


def _reported(report):
    """A report over the stored hourly table and the alerts in it."""

    def query(spark, sf_dir):
        hourly = _stored(spark, _hourly(spark, sf_dir), "hourly")
        spots = analytics.hotspots(analytics.grid_baseline(hourly))
        return present(report(hourly, analytics.activity_alerts(spots, RUN_AT)))

    return query


def q_risk_scores(spark, sf_dir):
    return present(risk.risk_scores(risk.PUBLISHED, _features(prepare(spark), sf_dir), RUN_AT))


def q_risk_evaluation(spark, sf_dir):
    # Training passes over the features many times: keep them as a table.
    features = stored(_features(prepare(spark), sf_dir), "features")
    return risk.risk_evaluation(risk.train_risk_model(features), features)


def q_gate2_risk(spark, sf_dir):
    return gate2.risk_check(q_risk_scores(spark, sf_dir))


def q_stream_new_files(spark, sf_dir):
    folder = landing_of(prepare(spark), sf_dir, plain=True)
    out = scratch_path(spark, "stream")
    for _ in range(2):  # the second run finds nothing new
        incremental.copy_new_rows(incremental.stream_raw(spark, folder), f"{out}/rows", f"{out}/state")
    rows = spark.read.parquet(f"{out}/rows").withColumn(
        "filename", landing.delivery_name(F.col("_source_file"))
    )
    return rows.groupBy("filename").agg(F.count("*").alias("row_count"))


def q_stream_hourly(spark, sf_dir):
    """One day is sent twice; the second delivery adds nothing."""
    folder = landing_of(prepare(spark), sf_dir, plain=True, resent=True)
    out = scratch_path(spark, "stream")
    incremental.hourly_from_landing(spark, folder, out, f"{out}/state", max_files=20)
    incremental.compact_sums(spark, f"{out}/sums")
    return present(incremental.read_hourly_sums(spark, f"{out}/sums"))


def q_stream_deduplicated(spark, sf_dir):
    folder = landing_of(prepare(spark), sf_dir, plain=True)
    out = scratch_path(spark, "stream")
    rows = clean.clean_activity(incremental.stream_raw(spark, folder, max_files=20))
    incremental.append_first_deliveries(rows, f"{out}/rows", f"{out}/state")
    return present(spark.read.parquet(f"{out}/rows").select(*incremental.GRAIN))


def q_stream_bounded_state(spark, sf_dir):
    """Two deliveries of half a month, with a day inside the delay and one beyond it sent again: each row is stored once."""
    raw = stored(_raw(spark, sf_dir), "raw")
    day = F.substring("_source_file", len(landing.NAME_PREFIX) + 9, 2).cast("int")
    again = F.concat(F.lit(landing.NAME_PREFIX), F.lit("again-"), F.lpad(day.cast("string"), 2, "0"), F.lit(".csv"))
    folder, out = scratch_path(spark, "inbox"), scratch_path(spark, "unique")
    rows = lambda: clean.clean_activity(incremental.stream_raw(spark, folder))
    write_landing(raw.where(day <= 15), folder, plain=True)
    dedup.append_unique(rows(), f"{out}/rows", f"{out}/state", "3 days")
    resent = raw.where(day.isin(2, 14)).withColumn("_source_file", again)
    write_landing(raw.where(day > 15).unionByName(resent), folder, plain=True)
    dedup.append_unique(rows(), f"{out}/rows", f"{out}/state", "3 days")
    return present(spark.read.parquet(f"{out}/rows").select(*incremental.GRAIN))


# ---------------------------------------------------------------- registry


def entry(spark: SparkSession, sf_dir: str = SMALL) -> DataFrame:
    """The network dashboard: parse, reject, aggregate twice."""
    return present(aggregate.dashboard_summary(_hourly(spark, sf_dir)))


def activity_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "detect_files": q_detect_files,
        "read_raw": q_read_raw,
        "gate1_schema": q_gate1_schema,
        "gate1_cadence": q_gate1_cadence,
        "gate1_duplicates": q_gate1_duplicates,
        "gate1_verdict": _verdict("strict"),
        "gate1_verdict_reference": _verdict("reference"),
        "route_rows": q_route_rows,
        "ingestion_log": q_ingestion_log,
        "latest_log": q_latest_log,
        "daily_intake": q_daily_intake,
        "ingestion_health": q_ingestion_health,
        "clean_activity": lambda s, d: present(_clean(s, d)),
        "rejected_rows": lambda s, d: clean.rejected_rows(_raw(s, d)).withColumn(
            "reasons", F.array_join("reasons", "; ")
        ),
        "null_profile": lambda s, d: clean.null_profile(_raw(s, d)),
        "run_metrics": lambda s, d: clean.run_metrics(_raw(s, d)),
        "hourly_grid_summary": lambda s, d: present(_hourly(s, d)),
        "daily_traffic_summary": lambda s, d: present(aggregate.daily_traffic_summary(_hourly(s, d))),
        "daily_grid_summary": lambda s, d: present(aggregate.daily_grid_summary(_hourly(s, d))),
        "peak_hour": lambda s, d: present(aggregate.peak_hour(_hourly(s, d))),
        "top_grids": lambda s, d: present(aggregate.top_grids(_hourly(s, d))),
        "dashboard_summary": lambda s, d: present(aggregate.dashboard_summary(_hourly(s, d))),
        "grid_lookup": lambda s, d: _geometry_text(_lookup(s, d)),
        "grid_centroids": lambda s, d: present(geo.grid_centroids(_lookup(s, d))),
        "grid_activity_geo": lambda s, d: present(
            _geometry_text(geo.enrich_with_geometry(_hourly(s, d), _lookup(s, d)))
        ),
        "top_grids_geo": lambda s, d: present(
            _geometry_text(geo.enrich_with_geometry(aggregate.top_grids(_hourly(s, d)), _lookup(s, d)))
        ),
        "unmatched_grids": lambda s, d: geo.unmatched_grids(_hourly(s, d), _lookup(s, d)),
        "silent_grids": lambda s, d: geo.silent_grids(_hourly(s, d), _lookup(s, d)),
        "geo_coverage": lambda s, d: present(geo.geo_coverage(_hourly(s, d), _lookup(s, d))),
        "readback_check": q_readback_check,
        "gate2_checks": q_gate2_checks,
        "gate2_reconcile": q_gate2_reconcile,
        "gate2_risk": q_gate2_risk,
        "stage_totals": q_stage_totals,
        "hourly_spine": lambda s, d: present(_spine(s, d)),
        "grid_baseline": lambda s, d: present(_baseline(s, d)),
        "hotspots": lambda s, d: present(_hotspots(s, d)),
        "activity_alerts": lambda s, d: present(_alerts(s, d)),
        "risk_features": lambda s, d: present(_features(s, d)),
        "risk_scores": q_risk_scores,
        "risk_evaluation": q_risk_evaluation,
        "dashboard_csv": q_dashboard_csv,
        "dashboard_csv_order": q_dashboard_csv_order,
        "published_views": q_published_views,
        "gate2_damaged": q_gate2_damaged,
        "published_counts": q_published_counts,
        "published_after_refusal": q_published_after_refusal,
        "network_kpis": _reported(reports.network_kpis),
        "grid_breakdown": lambda s, d: present(reports.grid_breakdown(_hourly(s, d))),
        "alerts_page": lambda s, d: present(reports.alerts_page(_alerts(s, d), page=2, size=25, alert_type="SPIKE")),
        "grid_severity": lambda s, d: present(
            _geometry_text(reports.grid_severity(_alerts(s, d), _lookup(s, d)))
        ),
        "alert_evidence": _reported(lambda hourly, alerts: reports.alert_evidence(alerts, hourly)),
        "compare_grids": lambda s, d: present(
            reports.compare_busiest(_stored(s, _hourly(prepare(s), d), "hourly"))
        ),
        "date_comparison": lambda s, d: present(reports.date_comparison(_hourly(s, d))),
        "stream_new_files": q_stream_new_files,
        "stream_hourly": q_stream_hourly,
        "stream_deduplicated": q_stream_deduplicated,
        "stream_bounded_state": q_stream_bounded_state,
        "content_check": q_content_check,
        "published_content": q_published_content,
        "points_in_cells": q_points_in_cells,
        "hotspot_clusters": q_hotspot_clusters,
        "alert_risk": q_alert_risk,
        "active_cells_by_week": q_active_cells_by_week,
        "activity_distribution": q_activity_distribution,
        "drop_hours": q_drop_hours,
        "drop_episodes": q_drop_episodes,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = activity_queries()
    if corpus_queries is not None:
        found |= corpus_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    """SQL for every query that SQL can express; not for ``risk_evaluation``, which trains a model."""
    found = all_queries()
    if corpus_queries is not None:
        found |= corpus_queries.SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
