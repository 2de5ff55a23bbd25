"""Profiles of any frame: shape, nulls, types and numeric summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.rates import percent
from tarmac.functions.sqltext import column_name, text_literal
from tarmac.session import compile_wide_rows, scratch_folder


def shape(df: DataFrame) -> DataFrame:
    """``(rows, cols)``."""
    return df.agg(F.count("*").alias("rows")).withColumn(
        "cols", F.lit(len(df.columns)).cast("long")
    )


def column_names(df: DataFrame) -> DataFrame:
    """``(position, column)`` of the frame's own layout."""
    names = [(i, n) for i, n in enumerate(df.columns)]
    return df.sparkSession.createDataFrame(names, "position long, column string")


def _column_counts(df: DataFrame) -> DataFrame:
    """``(column, type, non_null, rows)`` from one aggregate over all columns."""
    counts = [F.expr(f"count({column_name(c)}) as c{i}") for i, c in enumerate(df.columns)]
    cells = ", ".join(
        f"{text_literal(name)}, {text_literal(dtype)}, c{i}"
        for i, (name, dtype) in enumerate(df.dtypes)
    )
    long_form = f"stack({len(df.columns)}, {cells}) as (column, type, non_null)"
    return df.agg(F.count("*").alias("rows"), *counts).selectExpr(long_form, "rows")


def null_profile(df: DataFrame) -> DataFrame:
    """``(column, null_count, null_pct)``, emptiest columns first."""
    nulls = F.col("rows") - F.col("non_null")
    return (
        _column_counts(df)
        .select(
            "column",
            nulls.alias("null_count"),
            percent(nulls, F.col("rows"), 2).alias("null_pct"),
        )
        .orderBy(F.desc("null_pct"), "column")
    )


def column_info(df: DataFrame) -> DataFrame:
    """``(column, type, non_null)``."""
    return _column_counts(df).select("column", "type", "non_null")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


# The quantiles of a numeric summary.
QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _long_values(df: DataFrame, names: list[str]) -> DataFrame:
    """``(pos, value)`` of every present number; NaN counts as missing."""
    compile_wide_rows(df.sparkSession)
    numbers = ", ".join(f"cast({column_name(n)} as double)" for n in names)
    cells = F.expr(f"array({numbers})")
    return df.select(F.posexplode(cells).alias("pos", "value")).filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def _positions(spark, names: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "pos int, column string")


def _moments(freq: DataFrame) -> DataFrame:
    """Count, mean, sample deviation and range per column from value counts.

    The broadcast side has one row per column.
    """
    n, v = F.col("n"), F.col("value")
    first = freq.groupBy("pos").agg(
        F.sum("n").alias("count"),
        (F.sum(n * v) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    squares = (
        freq.join(F.broadcast(first.select("pos", "mean")), "pos")
        .groupBy("pos")
        .agg(F.sum(n * (v - F.col("mean")) * (v - F.col("mean"))).alias("squares"))
    )
    freedom = F.nullif(F.col("count") - 1, F.lit(0))
    return first.join(squares, "pos").withColumn("std", F.sqrt(F.col("squares") / freedom))


def _exact_quantiles(freq: DataFrame) -> DataFrame:
    """Linear-interpolated quantiles from range-partitioned value counts.

    ``freq`` holds each distinct value once, with the range partition
    (``part``) it lies in. Counts per partition say which partitions hold the
    wanted ranks; only those are sorted, each within itself. Nothing larger
    than one range partition meets in a task. The broadcast sides have at most
    two rows per column and quantile.
    """
    earlier = Window.partitionBy("pos").orderBy("part")
    sizes = (
        freq.groupBy("pos", "part")
        .agg(F.sum("n").alias("size"))
        .withColumn("before", F.sum("size").over(earlier) - F.col("size"))
        .withColumn("total", F.sum("size").over(Window.partitionBy("pos")))
    )
    ranks = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("name"), ((F.col("total") - 1) * q).alias("rank")
                )
                for name, q in QUANTILES.items()
            ]
        )
    )
    targets = (
        sizes.select("pos", "part", "before", "size", ranks.alias("target"))
        .select("pos", "part", "before", "size", "target.*")
        .filter(
            (F.floor("rank") < F.col("before") + F.col("size"))
            & (F.ceil("rank") >= F.col("before"))
        )
    )
    held = targets.select("pos", "part", "before").distinct()
    in_part = Window.partitionBy("pos", "part").orderBy("value")
    upto = F.col("before") + F.sum("n").over(in_part)
    placed = freq.join(F.broadcast(held), ["pos", "part"]).select(
        "pos", "part", "value", upto.alias("upto"), (upto - F.col("n")).alias("start")
    )

    def value_at(rank: Column) -> Column:
        here = (F.col("start") <= rank) & (rank < F.col("upto"))
        return F.max(F.when(here, F.col("value")))

    found = (
        placed.join(
            F.broadcast(targets.select("pos", "part", "name", "rank")), ["pos", "part"]
        )
        .groupBy("pos", "name", "rank")
        .agg(
            value_at(F.floor("rank")).alias("low"), value_at(F.ceil("rank")).alias("high")
        )
    )
    weight = F.col("rank") - F.floor("rank")
    value = F.col("low") + (F.col("high") - F.col("low")) * weight
    return (
        found.select("pos", "name", value.alias("value"))
        .groupBy("pos")
        .pivot("name", list(QUANTILES))
        .agg(F.first("value"))
    )


def numeric_summary(df: DataFrame, exact: bool = True) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max per numeric column.

    The exact form reads the source once, into counts per distinct value:
    repeated values collapse on the map side however often they occur. The
    counts are range-partitioned and written to a scratch folder, since their
    partition number is used as data and must not change if a task is run again;
    the folder is removed once the summary, a row per column, is known. The same
    counts give the moments: a wide aggregate of its own over all columns was
    measured to take as long as the whole summary. ``exact=False`` uses quantile
    sketches and writes nothing.
    """
    spark = df.sparkSession
    names = numeric_columns(df)
    values = _long_values(df, names)
    if exact:
        counts = (
            values.groupBy("pos", "value")
            .agg(F.count("*").alias("n"))
            .repartitionByRange("pos", "value")
            .withColumn("part", F.spark_partition_id())
        )
        with scratch_folder(spark) as root:
            counts.write.parquet(root)
            freq = spark.read.parquet(root)
            found = _moments(freq).join(_exact_quantiles(freq), "pos")
            rows = found.collect()  # one row per column
        measures = spark.createDataFrame(rows, found.schema)
    else:
        quartiles = F.percentile_approx("value", list(QUANTILES.values()), 10_000)
        measures = values.groupBy("pos").agg(
            F.count("*").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            *[quartiles[i].alias(name) for i, name in enumerate(QUANTILES)],
        )
    return (
        _positions(spark, names)
        .join(measures, "pos", "left")
        .select(
            "column",
            F.coalesce("count", F.lit(0)).alias("count"),
            "mean",
            "std",
            "min",
            *QUANTILES,
            "max",
        )
    )
