"""Series analysis: every event is a sample of the series named by its type."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.operators import series
from sedimenta.plans.suites.registry import query, table

ORDER = ("ts", "event_id")


def samples(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        F.col("event_type").alias("series"),
        "value",
    )


SAMPLES = "WITH s AS (SELECT ts, event_id, event_type AS series, value FROM events)"


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 10) for n in names})


@query("series_summary", f"""{SAMPLES} SELECT series, round(avg(value), 10) AS average,
  min(value) AS min, max(value) AS max, max(value) AS peak FROM s GROUP BY series""")
def q_summary(spark, sf_dir):
    return rounded(series.series_summary(samples(spark, sf_dir)), "average")


@query("series_position", f"""{SAMPLES} SELECT ts, event_id, series, value,
  row_number() OVER (PARTITION BY series ORDER BY ts, event_id) AS position,
  count(*) OVER (PARTITION BY series) AS group_size FROM s""")
def q_position(spark, sf_dir):
    return series.with_position(samples(spark, sf_dir), ["series"], ORDER)


TREND = """, p AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts, event_id) AS i,
  count(*) OVER (PARTITION BY series) AS n FROM s),
a AS (SELECT series, count(*) AS samples, avg(value) FILTER (i <= n // 2) AS x,
  avg(value) FILTER (i > n // 2) AS y FROM p WHERE n > 2 GROUP BY series)
SELECT series, samples, round(x, 10) AS first_average, round(y, 10) AS second_average,
  CASE WHEN y > x * 1.2 THEN 'increasing' WHEN y < x * 0.8 THEN 'decreasing' ELSE 'stable' END
  AS trend FROM a"""


@query("series_trend", SAMPLES + TREND)
def q_trend(spark, sf_dir):
    return rounded(
        series.series_trend(samples(spark, sf_dir), ORDER), "first_average", "second_average"
    )


@query("series_trend_by_user", "WITH s AS (SELECT ts, event_id, CAST(user_id AS VARCHAR) AS series,"
       " value FROM events)" + TREND)
def q_trend_by_user(spark, sf_dir):
    """Many short series, with all three trends among them."""
    per_user = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        F.col("user_id").cast("string").alias("series"),
        "value",
    )
    return rounded(series.series_trend(per_user, ORDER), "first_average", "second_average")


DELTA = """SELECT series, arg_min(value, ts) AS initial, arg_max(value, ts) AS final,
  arg_max(value, ts) - arg_min(value, ts) AS change,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS execution_time
FROM s GROUP BY series"""


@query("series_delta", f"{SAMPLES} {DELTA}")
def q_delta(spark, sf_dir):
    return series.series_delta(samples(spark, sf_dir), ORDER)


@query("efficiency_score", f"""{SAMPLES}, d AS ({DELTA})
SELECT round(greatest(0, least(100, 100 - 2 * sum(greatest((initial * 10 + final * 10) / 2 - 80, 0)))),
  10) AS efficiency_score FROM d WHERE series IN ('signup', 'purchase')""")
def q_efficiency(spark, sf_dir):
    scaled = samples(spark, sf_dir).withColumn("value", F.col("value") * 10)
    return rounded(
        series.efficiency_score(scaled, ORDER, ("signup", "purchase")), "efficiency_score"
    )


@query("latest_n", f"""{SAMPLES} SELECT * FROM s
QUALIFY row_number() OVER (PARTITION BY series ORDER BY ts DESC, event_id DESC) <= 100""")
def q_latest_n(spark, sf_dir):
    return series.latest_n(samples(spark, sf_dir), 100, ORDER)


@query("rolling_recommendation", f"""{SAMPLES}, r AS (SELECT * FROM s
  QUALIFY row_number() OVER (PARTITION BY series ORDER BY ts DESC, event_id DESC) <= 3),
a AS (SELECT series, count(*) AS samples, avg(value) AS m FROM r GROUP BY series)
SELECT series, samples, round(m, 10) AS recent_average, CASE
  WHEN series IN ('view', 'click', 'signup') AND m > 80 THEN 'scale_up'
  WHEN series IN ('view', 'click', 'signup') AND m < 20 THEN 'scale_down'
  WHEN series IN ('error', 'purchase') AND m > 85 THEN 'raise_memory' END AS recommendation
FROM a""")
def q_rolling(spark, sf_dir):
    return rounded(
        series.rolling_recommendation(
            samples(spark, sf_dir), ORDER, ("view", "click", "signup"), ("error", "purchase")
        ),
        "recent_average",
    )


@query("rolling_average", f"""{SAMPLES} SELECT series, ts, event_id, value,
  CASE WHEN count(*) OVER w = 3 THEN round(avg(value) OVER w, 10) END AS rolling_average
FROM s WINDOW w AS (PARTITION BY series ORDER BY ts, event_id ROWS 2 PRECEDING)""")
def q_rolling_average(spark, sf_dir):
    return rounded(series.rolling_average(samples(spark, sf_dir), ORDER), "rolling_average")


@query("classify_health", """
WITH v AS (SELECT arg_max(value, ts) FILTER (event_type = 'click') AS cpu,
  arg_max(value, ts) FILTER (event_type = 'view') AS mem,
  arg_max(value, ts) FILTER (event_type = 'signup') AS jobs,
  arg_max(value, ts) FILTER (event_type = 'purchase') AS store FROM events)
SELECT CASE WHEN cpu > 90 OR mem > 90 THEN 'critical' WHEN cpu > 75 OR mem > 80 THEN 'warning'
  ELSE 'healthy' END AS overall_health,
  concat_ws(',', CASE WHEN cpu > 75 AND cpu <= 90 THEN 'cpu_elevated' END,
    CASE WHEN mem > 80 AND mem <= 90 THEN 'memory_elevated' END,
    CASE WHEN store > 0.9 THEN 'storage_memory_high' END,
    CASE WHEN jobs > 10 THEN 'many_active_jobs' END) AS warnings,
  concat_ws(',', CASE WHEN cpu > 90 THEN 'cpu_high' END, CASE WHEN mem > 90 THEN 'memory_high' END)
    AS critical_issues FROM v""")
def q_health(spark, sf_dir):
    names = {
        series.CPU: "click",
        series.MEMORY: "view",
        series.JOBS: "signup",
        series.STORAGE: "purchase",
    }
    health = series.classify_health(samples(spark, sf_dir), ORDER, names)
    return health.select(
        "overall_health",
        F.array_join("warnings", ",").alias("warnings"),
        F.array_join("critical_issues", ",").alias("critical_issues"),
    )
