"""Monitoring over the audit log: latest run per report, counters, run
table, daily average run time and its linear trend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quincena.functions.columns import report_label
from quincena.operators.cdc import scd1_latest
from quincena.schemas import AUDIT_KEYS, RUN_FAIL, RUN_OK


def with_report(log: DataFrame) -> DataFrame:
    return log.withColumn("report", report_label())


def last_run(log: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Latest poll per (institution, status) with 0/1 ``OK`` / ``ERROR``
    flags and the ``institution - status`` label."""
    latest = scd1_latest(log, AUDIT_KEYS, "checked_at", tie_break)
    return with_report(latest).withColumns({
        "OK": (F.col("run_status") == RUN_OK).cast("int"),
        "ERROR": (F.col("run_status") == RUN_FAIL).cast("int"),
    })


def counters(last: DataFrame) -> DataFrame:
    """Data version, last run, files downloaded and errors against the
    number of reports."""
    g = last.agg(
        F.max("source_update").alias("max_source_update"),
        F.max("checked_at").alias("max_checked_at"),
        F.countDistinct("report").alias("reports"),
        F.sum("OK").alias("files_downloaded"),
        F.sum("ERROR").alias("errors"),
    )
    return g.withColumns({
        "downloaded_ratio": F.col("files_downloaded") / F.col("reports"),
        "error_ratio": F.col("errors") / F.col("reports"),
    })


def run_table(last: DataFrame) -> DataFrame:
    return (last.groupBy(
                F.date_trunc("SECOND", "start_at").cast("timestamp_ntz").alias("start_second"),
                "report", "run_status",
                F.date_trunc("DAY", "source_update").cast("timestamp_ntz").alias("source_day"))
            .agg(F.avg("time").alias("avg_time"), F.sum("OK").alias("ok_runs"),
                 F.sum("ERROR").alias("error_runs")))


def daily_avg(log: DataFrame) -> DataFrame:
    return (log.groupBy(F.date_trunc("DAY", "start_at").cast("timestamp_ntz").alias("day"))
            .agg(F.avg("time").alias("avg_time")))


def trend(daily: DataFrame, horizon_days: int = 7, digits: int = 6) -> DataFrame:
    """Least-squares line of the daily average over the day number, fitted
    on observed days and projected ``horizon_days`` past the last one. The
    fit is one global aggregate (scalar subqueries), the days are rows."""
    x = F.datediff(F.to_date("day"), F.lit("1970-01-01").cast("date")).cast("double")
    d = daily.withColumn("_x", x)
    slope = d.agg(F.regr_slope("avg_time", "_x")).scalar()
    intercept = d.agg(F.regr_intercept("avg_time", "_x")).scalar()
    future = (d.agg(F.max(F.to_date("day")).alias("_m"))
              .select(F.explode(F.sequence(F.date_add("_m", 1), F.date_add("_m", horizon_days))).alias("_d"))
              .select(F.col("_d").cast("timestamp_ntz").alias("day"), F.lit(None).cast("double").alias("avg_time"),
                      F.datediff("_d", F.lit("1970-01-01").cast("date")).cast("double").alias("_x")))
    allx = d.unionByName(future)
    return allx.select("day", "avg_time",
                       F.round(intercept + slope * F.col("_x"), digits).alias("trend_time"),
                       (F.col("avg_time").isNull()).alias("is_forecast"))


SMOOTHING = {"level": 0.3, "slope": 0.05, "season": 0.2}
BAND = 1.96  # standard deviations


def seasonal_forecast(daily: DataFrame, horizon_days: int = 7, season: int = 7, smoothing: dict[str, float] = SMOOTHING,
                      digits: int = 6) -> DataFrame:
    """``day, avg_time, fitted, low, high, is_forecast``: additive exponential
    smoothing with a season of ``season`` days, one step ahead on every day from
    the first to the last observed and ``horizon_days`` beyond.

    A day's fit is level + slope + its season's part, all as they stood before
    it; an observation then moves the three (a day without one moves the level
    by the slope only). The first day sets the level; slope and season start
    at 0. The band is ``BAND`` residual standard deviations, times the root of
    the steps ahead. Days without a date are left out; no day, no row.

    The smoothing runs over days in order, so it is one fold over one row's
    array: as long as the calendar, however many polls a day has."""
    kind = "double"
    seen = daily.where("day IS NOT NULL").select(F.to_date("day").alias("_d"), F.col("avg_time").cast(kind).alias("avg_time"))
    span = seen.agg(F.min("_d").alias("_a"), F.max("_d").alias("_z")).where("_a IS NOT NULL")
    days = span.select("_z", F.explode(F.sequence("_a", F.date_add("_z", horizon_days))).alias("_d"))
    point = F.struct("_d", "avg_time", F.greatest(F.datediff("_d", "_z"), F.lit(0)).alias("ahead"))
    points = days.join(seen, "_d", "left").agg(F.array_sort(F.collect_list(point)).alias("points")).where(F.size("points") > 0)
    first = F.filter("points", lambda p: p["avg_time"].isNotNull())[0]
    start = F.struct(F.coalesce(first["avg_time"], F.lit(0.0)).alias("level"), F.lit(0.0).alias("slope"),
                     F.array_repeat(F.lit(0.0), season).alias("parts"), F.lit(0.0).alias("squares"), F.lit(0).alias("n"),
                     F.array().cast("array<double>").alias("fits"))

    def step(state, p):
        at = F.pmod(F.datediff(p["_d"], F.lit("1970-01-01").cast("date")), F.lit(season))
        part, y = F.get(state["parts"], at), p["avg_time"]
        before = state["level"] + state["slope"]
        fit = before + part
        level = F.when(y.isNull(), before).otherwise(smoothing["level"] * (y - part) + (1 - smoothing["level"]) * before)
        slope = F.when(y.isNull(), state["slope"]).otherwise(
            smoothing["slope"] * (level - state["level"]) + (1 - smoothing["slope"]) * state["slope"])
        moved = F.when(y.isNull(), part).otherwise(smoothing["season"] * (y - level) + (1 - smoothing["season"]) * part)
        return F.struct(level.alias("level"), slope.alias("slope"),
                        F.transform(state["parts"], lambda v, i: F.when(i == at, moved).otherwise(v)).alias("parts"),
                        (state["squares"] + F.coalesce((y - fit) * (y - fit), F.lit(0.0))).alias("squares"),
                        (state["n"] + y.isNotNull().cast("int")).alias("n"),
                        F.concat(state["fits"], F.array(fit)).alias("fits"))

    folded = points.select("points", F.aggregate("points", start, step).alias("s"))
    rows = folded.select(F.sqrt(F.col("s.squares") / F.col("s.n")).alias("_sd"),
                         F.inline(F.arrays_zip(F.col("points").alias("p"), F.col("s.fits").alias("fit"))))
    width = BAND * F.col("_sd") * F.sqrt(F.greatest(F.col("p.ahead"), F.lit(1)))
    return rows.select(F.col("p._d").cast("timestamp_ntz").alias("day"), F.col("p.avg_time").alias("avg_time"),
                       F.round("fit", digits).alias("fitted"), F.round(F.col("fit") - width, digits).alias("low"),
                       F.round(F.col("fit") + width, digits).alias("high"), (F.col("p.ahead") > 0).alias("is_forecast"))
