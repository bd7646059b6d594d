"""Analysis of metric samples in long form: ``(ts, series, value)``.

``order_by`` names the columns that order the samples of a series; add a unique
column where two samples may share a timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.operators.dedup import sort_keys, top_per_group
from sedimenta.scratch import scratch_root

# Metric names and thresholds.
CPU, MEMORY = "system_cpu_percent", "system_memory_percent"
STORAGE, JOBS = "storage_memory_utilization", "active_jobs"
EXECUTORS_TOTAL, EXECUTORS_ACTIVE = "total_executors", "active_executors"
CPU_WARNING, CPU_CRITICAL = 75, 90
MEMORY_WARNING, MEMORY_CRITICAL = 80, 90
STORAGE_WARNING, JOBS_WARNING, EXECUTORS_WARNING = 0.9, 10, 0.8
SCALE_UP_CPU, SCALE_DOWN_CPU, RAISE_MEMORY = 80, 20, 85
RISING, FALLING = 1.2, 0.8
PENALTY_FROM, PENALTY_FACTOR = 80, 2

# Rows of one series that a rolling window handles in one task.
BLOCK_ROWS = 100_000


def _order(order_by: Sequence[str]) -> Column:
    return F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)


def series_summary(samples: DataFrame) -> DataFrame:
    """Average, minimum, maximum and peak per series; missing values do not count."""
    return samples.groupBy("series").agg(
        F.avg("value").alias("average"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.max("value").alias("peak"),
    )


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    weight: str | None = None,
) -> DataFrame:
    """Add ``position`` (1-based) and ``group_size`` of each row in its group.

    With ``weight`` a row stands for that many rows and its position is that of the
    first one.

    A window over the keys would put a whole group into one task. Here the rows are
    range-sorted by keys and order (ties by the other columns), so that a large
    group spans many partitions, and checkpointed, so that partitions stay as they
    are. A row's position is its offset in its partition plus the group's rows in
    earlier partitions, of which there is one count per group and partition.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    rows = F.lit(1) if weight is None else F.col(weight)
    placed = (
        df.orderBy(*keys, *sort_keys(df, order_by), *sort_keys(df, skip=keys))
        .checkpoint()
        .withColumn("__row", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__row", 33))
    )
    # A window group here is one group's share of one sorted partition.
    in_part = (
        Window.partitionBy(*keys, "__part")
        .orderBy("__row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # At most one row per group and partition from here to the join.
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*keys, "__part")
        .agg(F.sum(rows).alias("__rows"))
        .select(
            *keys,
            "__part",
            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
            F.sum("__rows").over(by_key).alias("group_size"),
        )
    )
    return (
        placed.withColumn("__offset", F.coalesce(F.sum(rows).over(in_part), F.lit(0)))
        .join(offsets, [*keys, "__part"])
        .withColumn("position", F.col("__before") + F.col("__offset") + 1)
        .select(*df.columns, "position", "group_size")
    )


def series_trend(samples: DataFrame, order_by: Sequence[str] = ("ts",)) -> DataFrame:
    """Second-half average against first-half average per series.

    Only series of more than two samples have a trend; an odd sample belongs to the
    second half and a missing value counts as 0.

    The halves are found from counts per hour, and only the hour a series' middle
    falls into is ordered row by row. In there equal samples are counted first, so
    copies of one do not pile up.
    """
    rows = samples.select(
        "series",
        *order_by,
        F.coalesce("value", F.lit(0.0)).alias("value"),
        F.date_trunc("hour", order_by[0]).alias("__hour"),
    )
    # A series has at most one row per hour in these windows.
    of_series = Window.partitionBy("series")
    earlier = of_series.orderBy("__hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = (
        rows.groupBy("series", "__hour")
        .agg(F.count(F.lit(1)).alias("__n"), F.sum("value").alias("__sum"))
        .withColumns(
            {
                "__before": F.coalesce(F.sum("__n").over(earlier), F.lit(0)),
                "__samples": F.sum("__n").over(of_series),
            }
        )
        .filter(F.col("__samples") > 2)
        .withColumn("__early", F.floor(F.col("__samples") / 2) - F.col("__before"))
    )
    split = (F.col("__early") > 0) & (F.col("__early") < F.col("__n"))
    first = F.col("__early") >= F.col("__n")
    whole = hours.filter(~split).select(
        "series",
        F.when(first, F.col("__n")).otherwise(0).alias("early"),
        F.when(first, F.col("__sum")).otherwise(0.0).alias("early_sum"),
        F.when(first, 0).otherwise(F.col("__n")).alias("late"),
        F.when(first, 0.0).otherwise(F.col("__sum")).alias("late_sum"),
    )

    middle = hours.filter(split).select(
        F.col("series").alias("__series"), F.col("__hour").alias("__at"), "__early"
    )
    inside = rows.join(
        middle,
        F.col("series").eqNullSafe(F.col("__series")) & F.col("__hour").eqNullSafe(F.col("__at")),
    )
    counted = inside.groupBy("series", *order_by, "value", "__early").agg(
        F.count(F.lit(1)).alias("copies")
    )
    placed = with_position(counted, ["series"], order_by, "copies")
    # Of a row's copies, those up to the middle belong to the first half.
    early = F.least(
        F.col("copies"), F.greatest(F.col("__early") - F.col("position") + 1, F.lit(0))
    )
    late = F.col("copies") - early
    parts = placed.select(
        "series",
        early.alias("early"),
        (F.col("value") * early).alias("early_sum"),
        late.alias("late"),
        (F.col("value") * late).alias("late_sum"),
    )
    averages = (
        whole.unionByName(parts)
        .groupBy("series")
        .agg(
            (F.sum("early") + F.sum("late")).alias("samples"),
            (F.sum("early_sum") / F.sum("early")).alias("first_average"),
            (F.sum("late_sum") / F.sum("late")).alias("second_average"),
        )
    )
    old, new = F.col("first_average"), F.col("second_average")
    return averages.withColumn(
        "trend",
        F.when(new > old * RISING, "increasing")
        .when(new < old * FALLING, "decreasing")
        .otherwise("stable"),
    )


def series_delta(samples: DataFrame, order_by: Sequence[str] = ("ts",)) -> DataFrame:
    """First value, last value, change and elapsed seconds per series."""
    at, ts = _order(order_by), order_by[0]
    return (
        samples.groupBy("series")
        .agg(
            F.min_by("value", at).alias("initial"),
            F.max_by("value", at).alias("final"),
            F.min(ts).alias("__from"),
            F.max(ts).alias("__to"),
        )
        .select(
            "series",
            "initial",
            "final",
            (F.col("final") - F.col("initial")).alias("change"),
            (
                (F.unix_micros("__to") - F.unix_micros("__from")) / F.lit(1000000.0)
            ).alias("execution_time"),
        )
    )


def efficiency_score(
    samples: DataFrame,
    order_by: Sequence[str] = ("ts",),
    penalized: Sequence[str] = (CPU, MEMORY),
) -> DataFrame:
    """One row: 100 minus twice each penalized series' mean excess over 80, kept
    within 0..100."""
    mean = (F.col("initial") + F.col("final")) / 2
    excess = F.greatest(mean - PENALTY_FROM, F.lit(0.0))
    penalty = F.coalesce(F.sum(excess), F.lit(0.0)) * PENALTY_FACTOR
    score = F.lit(100.0) - penalty
    return (
        series_delta(samples.filter(F.col("series").isin(list(penalized))), order_by)
        .agg(F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)).alias("efficiency_score"))
    )


def latest_n(samples: DataFrame, n: int = 100, order_by: Sequence[str] = ("ts",)) -> DataFrame:
    """The latest ``n`` samples of every series."""
    # Ties go by the other columns, whichever way is taken.
    others = [c for c in samples.columns if c not in ("series", *order_by)]
    newest = [F.col(c).desc() for c in order_by] + [F.col(c).asc() for c in others]
    limit = int(samples.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= limit:
        return top_per_group(samples, ["series"], newest, n)
    # Spark cuts groups before the shuffle up to that rank only.
    placed = with_position(samples, ["series"], newest)
    return placed.filter(F.col("position") <= n).select(*samples.columns)


def rolling_recommendation(
    samples: DataFrame,
    order_by: Sequence[str] = ("ts",),
    cpu_series: Sequence[str] = (CPU,),
    memory_series: Sequence[str] = (MEMORY,),
    window: int = 3,
) -> DataFrame:
    """Advice from the mean of the last three samples of CPU and memory series;
    none for a series with fewer samples."""
    recent = (
        latest_n(samples, window, order_by)
        .groupBy("series")
        .agg(
            F.count(F.lit(1)).alias("samples"),
            F.avg(F.coalesce("value", F.lit(0.0))).alias("recent_average"),
        )
    )
    enough = F.col("samples") == window
    cpu = enough & F.col("series").isin(list(cpu_series))
    memory = enough & F.col("series").isin(list(memory_series))
    mean = F.col("recent_average")
    return recent.withColumn(
        "recommendation",
        F.when(cpu & (mean > SCALE_UP_CPU), "scale_up")
        .when(cpu & (mean < SCALE_DOWN_CPU), "scale_down")
        .when(memory & (mean > RAISE_MEMORY), "raise_memory"),
    )


def rolling_average(
    samples: DataFrame, order_by: Sequence[str] = ("ts",), window: int = 3
) -> DataFrame:
    """Every sample with the mean of the last ``window`` samples up to it, NULL
    while there are fewer.

    Rows are placed by :func:`with_position` and cut into blocks of positions, each
    carrying the few rows before it, so no task holds a whole series.
    """
    placed = with_position(
        samples.select("series", *order_by, F.coalesce("value", F.lit(0.0)).alias("value")),
        ["series"],
        order_by,
    )
    block = F.floor((F.col("position") - 1) / BLOCK_ROWS)
    spill = F.floor((F.col("position") - 2 + window) / BLOCK_ROWS)
    # A row also feeds every later block that the window-1 rows after it reach.
    copies = placed.withColumn("__home", block).withColumn(
        "__block", F.explode(F.sequence(block, spill))
    )
    frame = (
        Window.partitionBy("series", "__block")
        .orderBy("position")
        .rowsBetween(-(window - 1), 0)
    )
    return (
        copies.withColumns(
            {
                "__n": F.count(F.lit(1)).over(frame),
                "__mean": F.avg("value").over(frame),
            }
        )
        .filter(F.col("__block") == F.col("__home"))
        .select(
            "series",
            *order_by,
            "value",
            F.when(F.col("__n") == window, F.col("__mean")).alias("rolling_average"),
        )
    )


def classify_health(
    samples: DataFrame,
    order_by: Sequence[str] = ("ts",),
    names: dict[str, str] | None = None,
) -> DataFrame:
    """One row: overall health, warning codes and critical codes of the latest
    samples.

    CPU and memory set the level (the worst wins). Storage use, job count and
    inactive executors only add warnings. ``names`` maps the standard metric names
    to the series that hold them.
    """
    names = names or {}

    def latest(metric):
        here = F.col("series") == names.get(metric, metric)
        return F.max_by(F.when(here, F.col("value")), F.when(here, _order(order_by)))

    metrics = (CPU, MEMORY, STORAGE, JOBS, EXECUTORS_TOTAL, EXECUTORS_ACTIVE)
    now = samples.agg(*[latest(m).alias(m) for m in metrics])
    cpu, memory = F.col(CPU), F.col(MEMORY)
    share = F.when(
        F.col(EXECUTORS_TOTAL) > 0,
        F.coalesce(F.col(EXECUTORS_ACTIVE), F.lit(0.0)) / F.col(EXECUTORS_TOTAL),
    )
    warnings = [
        F.when((cpu > CPU_WARNING) & (cpu <= CPU_CRITICAL), "cpu_elevated"),
        F.when((memory > MEMORY_WARNING) & (memory <= MEMORY_CRITICAL), "memory_elevated"),
        F.when(F.col(STORAGE) > STORAGE_WARNING, "storage_memory_high"),
        F.when(F.col(JOBS) > JOBS_WARNING, "many_active_jobs"),
        F.when(share < EXECUTORS_WARNING, "executors_inactive"),
    ]
    critical = [
        F.when(cpu > CPU_CRITICAL, "cpu_high"),
        F.when(memory > MEMORY_CRITICAL, "memory_high"),
    ]
    level = (
        F.when((cpu > CPU_CRITICAL) | (memory > MEMORY_CRITICAL), "critical")
        .when((cpu > CPU_WARNING) | (memory > MEMORY_WARNING), "warning")
        .otherwise("healthy")
    )
    return now.select(
        level.alias("overall_health"),
        F.array_compact(F.array(*warnings)).alias("warnings"),
        F.array_compact(F.array(*critical)).alias("critical_issues"),
    )
