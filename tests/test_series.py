from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import quality, series, summaries
from tests.conftest import rows


def samples(spark, **values):
    data = [
        (s, f"2024-01-01 00:{n:02d}:00", v) for s, vs in values.items() for n, v in enumerate(vs)
    ]
    return spark.createDataFrame(data, "series string, ts string, value double").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


def test_trend(spark):
    df = samples(
        spark,
        two=[1.0, 9.0],
        three=[1.0, 1.0, 2.0],  # halves of 1 and 2
        odd=[10.0, 10.0, 5.0, 5.0, 5.0],
        flat=[1.0, 1.0, 1.1, 1.1],
        gaps=[10.0, 10.0, None, 10.0],
    )
    got = {r["series"]: r for r in series.series_trend(df).collect()}
    assert {k: v["trend"] for k, v in got.items()} == {
        "three": "increasing", "odd": "decreasing", "flat": "stable", "gaps": "decreasing",
    }
    assert (got["three"]["first_average"], got["three"]["second_average"]) == (1.0, 1.5)
    summary = {r["series"]: r for r in series.series_summary(df).collect()}
    assert summary["gaps"]["average"] == 10.0


def test_position_spreads_a_hot_group(spark):
    """Most rows are one series; positions are right and its rows stay spread."""
    df = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 97)).alias("series"),
        (F.hash("id") % 1000).alias("ts"),
        "id",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = series.with_position(df, ["series"], ["ts", "id"])
        got = {r["id"]: (r["position"], r["group_size"]) for r in placed.collect()}
        largest = (
            placed.filter("series = 'hot'").groupBy(F.spark_partition_id()).count()
            .agg(F.max("count")).first()[0]
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups = defaultdict(list)
    for r in df.collect():
        groups[r["series"]].append((r["ts"], r["id"]))
    want = {
        i: (n, len(members))
        for members in groups.values()
        for n, (_, i) in enumerate(sorted(members), 1)
    }
    assert got == want
    assert largest < len(groups["hot"]) * 0.8


def test_trend_splits_copies_of_one_sample(spark):
    """One sample makes up most of the series and lies across its middle."""
    df = spark.range(1000).select(
        F.lit("s").alias("series"),
        F.timestamp_seconds(
            F.when(F.col("id") < 100, 1).when(F.col("id") < 900, 2).otherwise(3)
        ).alias("ts"),
        F.when(F.col("id") < 100, 5.0).when(F.col("id") < 900, 1.0).otherwise(9.0).alias("value"),
    )
    row = series.series_trend(df).first()
    assert (row["samples"], row["first_average"], row["second_average"]) == (1000, 1.8, 2.6)
    assert row["trend"] == "increasing"


def test_trend_over_many_hours(spark):
    """Against a direct count, with a hot series, a hot hour and rows without time."""
    df = spark.range(20_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 41)).alias("series"),
        F.when(F.col("id") % 5 == 0, F.timestamp_seconds(F.lit(500_000)))
        .when(F.col("id") % 97 > 0, F.timestamp_seconds(F.abs(F.hash("id")) % 1_000_000))
        .alias("ts"),
        "id",
        (F.hash("id", F.lit(1)) % 100).cast("double").alias("value"),
    )
    groups = defaultdict(list)
    for r in df.collect():
        groups[r["series"]].append((r["ts"] is not None, r["ts"], r["id"], r["value"]))
    want = {}
    for name, members in groups.items():
        values = [m[3] for m in sorted(members)]
        half = len(values) // 2
        want[name] = (len(values), sum(values[:half]) / half, sum(values[half:]) / (len(values) - half))
    got = {
        r["series"]: (r["samples"], r["first_average"], r["second_average"])
        for r in series.series_trend(df, ("ts", "id")).collect()
    }
    assert got.keys() == want.keys()
    for name in want:
        assert got[name] == pytest.approx(want[name])


def test_latest_beyond_the_rank_limit(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 2500, "hot").otherwise("cold").alias("series"),
        F.col("id").alias("ts"),
    )
    got = series.latest_n(df, 1200)
    summary = got.groupBy("series").agg(F.min("ts").alias("first"), F.count("*").alias("n"))
    assert rows(summary, "series", "first", "n") == [("cold", 2500, 500), ("hot", 1300, 1200)]


def test_rolling_average_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(series, "BLOCK_ROWS", 4)
    df = samples(spark, a=[float(n * n) for n in range(23)], b=[1.0, 2.0])
    got = series.rolling_average(df).orderBy("series", "ts").collect()
    a = [r["rolling_average"] for r in got if r["series"] == "a"]
    squares = [n * n for n in range(23)]
    assert a[:2] == [None, None]
    assert a[2:] == pytest.approx([sum(squares[n - 2 : n + 1]) / 3 for n in range(2, 23)])
    assert [r["rolling_average"] for r in got if r["series"] == "b"] == [None, None]


def test_delta_and_efficiency(spark):
    df = spark.createDataFrame(
        [(series.CPU, 1000, 20.0), (series.CPU, 1100, 80.0), (series.MEMORY, 1000, 30.0), (series.MEMORY, 1100, 70.0)],
        "series string, ts int, value double",
    ).withColumn("ts", F.timestamp_seconds("ts"))
    delta = {r["series"]: r for r in series.series_delta(df).collect()}
    assert delta[series.CPU]["execution_time"] == 100.0
    assert delta[series.CPU]["change"] == 60.0
    assert series.efficiency_score(df).first()[0] == 100.0
    hot = df.withColumn("value", F.lit(95.0))
    assert series.efficiency_score(hot).first()[0] == 40.0
    assert series.efficiency_score(df.withColumn("value", F.lit(500.0))).first()[0] == 0.0
    assert series.efficiency_score(df.limit(0)).first()[0] == 100.0


def test_recommendation(spark):
    df = samples(
        spark,
        **{series.CPU: [0.0, 90.0, 80.0, 85.0], series.MEMORY: [90.0, 90.0], "x": [99.0] * 3},
    )
    got = {r["series"]: r["recommendation"] for r in series.rolling_recommendation(df).collect()}
    assert got == {series.CPU: "scale_up", series.MEMORY: None, "x": None}
    low = samples(spark, **{series.CPU: [10.0] * 3, series.MEMORY: [86.0] * 3})
    got = {r["series"]: r["recommendation"] for r in series.rolling_recommendation(low).collect()}
    assert got == {series.CPU: "scale_down", series.MEMORY: "raise_memory"}


@pytest.mark.parametrize(
    "values, level, warnings, critical",
    [
        ({series.CPU: 85.0, series.MEMORY: 70.0, series.JOBS: 5.0}, "warning", ["cpu_elevated"], []),
        ({series.CPU: 10.0, series.MEMORY: 91.0}, "critical", [], ["memory_high"]),
        ({series.CPU: 95.0, series.MEMORY: 85.0}, "critical", ["memory_elevated"], ["cpu_high"]),
        (
            {series.CPU: 1.0, series.STORAGE: 0.95, series.JOBS: 11.0, series.EXECUTORS_TOTAL: 10.0,
             series.EXECUTORS_ACTIVE: 7.0},
            "healthy",
            ["storage_memory_high", "many_active_jobs", "executors_inactive"],
            [],
        ),
    ],
)
def test_health(spark, values, level, warnings, critical):
    df = samples(spark, **{k: [99.0, v] for k, v in values.items()})
    row = series.classify_health(df).first()
    assert (row["overall_health"], row["warnings"], row["critical_issues"]) == (level, warnings, critical)


def test_latest(spark):
    df = samples(spark, a=[1.0, 2.0, 3.0], b=[4.0])
    assert rows(series.latest_n(df, 2), "series", "value") == [("a", 2.0), ("a", 3.0), ("b", 4.0)]


def test_quality(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, 'a'), (2, NULL) AS t(x, y)")
    checks = {"not_empty": True, "no_nulls": ["x", "y", "z"], "no_duplicates": True, "min_rows": 3, "max_rows": 2}
    got = rows(quality.check_quality(df, checks), "check", "column", "passed", "observed")
    assert got == sorted(
        [("not_empty", None, True, 3), ("no_nulls", "x", True, 0), ("no_nulls", "y", False, 1),
         ("no_nulls", "z", False, None), ("no_duplicates", None, False, 1), ("min_rows", None, True, 3),
         ("max_rows", None, False, 3)], key=repr,
    )
    empty = rows(quality.check_quality(df.limit(0), checks), "check", "column", "passed", "observed")
    assert ("not_empty", None, False, 0) in empty and ("no_duplicates", None, True, 0) in empty
    with pytest.raises(ValueError, match="typo"):
        quality.check_quality(df, {"typo": 1})


def test_size_estimate(spark):
    df = spark.range(20_000).withColumn("x", F.lit("abc"))
    row = quality.estimate_size(df).first()
    assert (row["row_count"], row["column_count"], row["estimated_size_bytes"], row["estimated_size_mb"]) == (
        20_000, 2, 2_000_000, 1.91,
    )
    assert 0 < row["sample_count"] <= 1000
    assert quality.estimate_size(df, measure=True).first()["estimated_size_bytes"] < 1_000_000
    assert quality.estimate_size(df.limit(0)).first()["estimated_size_bytes"] == 0


def test_empty_summaries(spark):
    none = spark.createDataFrame([], summaries.RESULT_SCHEMA)
    assert summaries.load_summary(none).first()["success_rate"] == 0.0
    row = summaries.run_summary(none).first()
    assert (row["total_files"], row["success_rate"], row["records_per_second"]) == (0, 0.0, 0.0)
