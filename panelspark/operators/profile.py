"""Data profiling as result tables, one row per column (or column and value)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

QUARTILES = (0.25, 0.5, 0.75)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def shape(df: DataFrame) -> DataFrame:
    """Position, type, rows and non-NULL values of every column, in one pass."""
    total = F.count(F.lit(1))
    entries = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(i).cast("bigint").alias("position"),
            F.lit(f.dataType.simpleString()).alias("type"),
            total.alias("n_rows"),
            F.count(F.col(f"`{f.name}`")).alias("n_values"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*entries).alias("columns")).select(F.inline("columns"))


def missing(df: DataFrame) -> DataFrame:
    """Missing values and their percentage per column, in one pass."""
    rows = F.count(F.lit(1))
    entries = []
    for name in df.columns:
        lacking = F.count_if(F.col(f"`{name}`").isNull())
        share = F.when(rows > 0, F.round(lacking * 100.0 / rows, 4)).otherwise(F.lit(0.0))
        entries.append(F.struct(F.lit(name).alias("column"), lacking.alias("n_missing"), share.alias("pct_missing")))
    return df.agg(F.array(*entries).alias("columns")).select(F.inline("columns"))


def summary(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Rows, distinct values, minimum and maximum per column.

    Values are grouped before they are counted, so distinct counting is spread over the cluster.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "v")
    counts = values.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.count("v").alias("n_distinct"),
        F.round(F.min("v"), digits).alias("min_value"),
        F.round(F.max("v"), digits).alias("max_value"),
    )


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    at: Sequence[float] = QUARTILES,
    accuracy: int = 10_000,
    slices: int = 1024,
) -> DataFrame:
    """Exact quantiles (linear interpolation between the two closest ranks), one row per column.

    ``percentile`` would keep every distinct value of a column in one task.  Here a sketch of
    bounded size, whose rank error is guaranteed, brackets each quantile.  The second pass
    groups equal values inside the brackets, cut into ``slices``, and counts everything
    between brackets as single blocks.  Ranks are found over the slice totals first, and only
    the slices that hold a wanted rank are put in order: about n / (accuracy * slices) values each.
    """
    margin = 4.0 / accuracy
    edges = [e for q in at for e in (max(0.0, q - margin), min(1.0, q + margin))]
    wide = df.agg(*[F.percentile_approx(F.col(c).cast("double"), edges, accuracy).alias(c) for c in columns])
    named = [e for c in columns for e in (F.lit(c), F.col(c))]
    bounds = wide.select(F.create_map(*named).alias("bounds")).scalar()

    cells = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "v")
    cells = cells.filter(F.col("v").isNotNull()).withColumn("edges", F.element_at(bounds, F.col("column")))
    v = F.col("v")
    brackets = [(F.col("edges")[2 * i], F.col("edges")[2 * i + 1]) for i in range(len(at))]
    none = F.lit(None).cast("int")
    inside = F.coalesce(*[F.when(v.between(low, high), F.lit(i)) for i, (low, high) in enumerate(brackets)], none)
    behind = F.coalesce(*[F.when(v > brackets[i][1], F.lit(i)) for i in reversed(range(len(at)))], F.lit(-1))
    cells = cells.select("column", "v", "edges", inside.alias("inside"), behind.alias("behind"))
    cells = cells.select(
        "column",
        "v",
        "inside",
        "behind",
        F.get("edges", F.col("inside") * 2).alias("low"),
        F.get("edges", F.col("inside") * 2 + 1).alias("high"),
    )
    # Places are whole numbers in value order: the slices of bracket i, then the block behind it.
    stride = slices + 1
    piece = F.when(F.col("high") > F.col("low"), F.floor((v - F.col("low")) / (F.col("high") - F.col("low")) * (slices - 1)))
    in_slice = F.col("inside") * stride + F.coalesce(piece, F.lit(0))
    place = F.coalesce(in_slice, F.col("behind") * stride + slices).cast("int")
    counts = (
        cells.select("column", place.alias("place"), F.when(F.col("inside").isNotNull(), v).alias("v"))
        .groupBy("column", "place", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )

    # At most len(at) * slices + len(at) + 1 rows per column.
    order = Window.partitionBy("column").orderBy("place")
    pieces = (
        counts.groupBy("column", "place")
        .agg(F.sum("n").alias("m"))
        .select(
            "column",
            "place",
            (F.sum("m").over(order) - F.col("m")).alias("before"),
            "m",
            F.sum("m").over(Window.partitionBy("column")).alias("total"),
        )
    )

    def ranks(total):
        for q in at:
            position = F.lit(q) * (total - 1)
            yield f"lo_{_label(q)}", F.floor(position)
            yield f"hi_{_label(q)}", F.ceil(position)

    wanted = reduce(
        lambda a, b: a | b,
        [(F.col("before") <= r) & (r < F.col("before") + F.col("m")) for _, r in ranks(F.col("total"))],
    )
    inner = Window.partitionBy("column", "place").orderBy("v")
    ranked = (
        counts.join(pieces.filter(wanted).drop("m"), ["column", "place"])
        .withColumn("first", F.col("before") + F.sum("n").over(inner) - F.col("n"))
        .withColumn("last", F.col("first") + F.col("n") - 1)
    )
    value = F.when(
        F.col("v").isNull(), F.raise_error(F.lit("a quantile fell outside its bracket; raise the accuracy"))
    ).otherwise(F.col("v"))
    picks = [F.max(F.when(r.between(F.col("first"), F.col("last")), value)).alias(n) for n, r in ranks(F.col("total"))]
    picked = ranked.groupBy("column").agg(F.max("total").alias("n_values"), *picks)
    out = []
    for q in at:
        low, high = F.col(f"lo_{_label(q)}"), F.col(f"hi_{_label(q)}")
        position = F.lit(q) * (F.col("n_values") - 1)
        out.append((low + (position - F.floor(position)) * (high - low)).alias(_label(q)))
    return picked.select("column", *out)


def _label(q: float) -> str:
    return f"p{q * 100:g}".replace(".", "_")


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of every column: one pass, one row."""
    wide = []
    for c in columns:
        v = F.col(c).cast("double")
        wide.append(
            F.struct(
                F.count(v).alias("n"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
            ).alias(c)
        )
    return df.agg(F.struct(*wide).alias("m"))


def describe(df: DataFrame, columns: Sequence[str], digits: int = 4, accuracy: int = 10_000) -> DataFrame:
    """count, mean, std, min, quartiles, max per numeric column."""
    moments = _moments(df, columns).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        *[F.col(f"m.{c}.{s}").alias(s) for s in ("n", "mean", "std", "min", "max")],
                    )
                    for c in columns
                ]
            )
        )
    )
    full = moments.join(quantiles(df, columns, QUARTILES, accuracy), "column", "left")
    numbers = ["mean", "std", "min", *[_label(q) for q in QUARTILES], "max"]
    return full.select("column", "n", *[F.round(c, digits).alias(c) for c in numbers])


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct values per text column.

    Digests of fixed size are shuffled instead of the texts.
    """
    digests = df.select(*[F.sha2(F.col(c), 256).alias(c) for c in columns])
    values = digests.unpivot([], list(columns), "column", "digest").filter(F.col("digest").isNotNull()).distinct()
    names = F.array(*[F.lit(c) for c in columns])
    counts = values.groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(1).select(F.explode(names).alias("column"))
    return every.join(counts, "column", "left").select("column", F.coalesce("n", F.lit(0)).alias("n_distinct"))


def top_values(df: DataFrame, columns: Sequence[str], top: int = 10, fewer_than: int = 50) -> DataFrame:
    """The ``top`` most frequent values of every text column with fewer than ``fewer_than`` distinct ones.

    Which columns qualify is known (from digests) before any value is grouped, so long free
    texts are never shuffled.
    """
    qualifying = (
        distinct_counts(df, columns).filter(F.col("n_distinct") < fewer_than).agg(F.collect_set("column").alias("c")).scalar()
    )
    cells = df.select(*columns).unpivot([], list(columns), "column", "value")
    kept = cells.filter(F.col("value").isNotNull() & F.array_contains(qualifying, F.col("column")))
    counts = kept.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value")))
    return counts.withColumn("position", rank.cast("bigint")).filter(F.col("position") <= top)


def _outlier_cells(df: DataFrame, columns: Sequence[str], sigmas: float) -> DataFrame:
    """(column, value, n, mean, std, lower, upper) of every value outside its bounds."""
    moments = _moments(df, columns).scalar()
    cells = []
    for c in columns:
        m, v = moments[c], F.col(c).cast("double")
        low, high = m["mean"] - sigmas * m["std"], m["mean"] + sigmas * m["std"]
        # A column without a deviation (fewer than two values) has no outliers.
        cells.append(
            F.when(
                (v < low) | (v > high),
                F.struct(
                    v.alias("value"), m["mean"].alias("mean"), m["std"].alias("std"), low.alias("lower"), high.alias("upper")
                ),
            ).alias(c)
        )
    long = df.select(*cells).unpivot([], list(columns), "column", "cell").filter(F.col("cell").isNotNull())
    return long.select("column", "cell.*")


def outliers(df: DataFrame, columns: Sequence[str], sigmas: float = 3.0, digits: int = 4) -> DataFrame:
    """Bounds, number and percentage of values beyond ``sigmas`` deviations; columns without any are left out."""
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    cells = _outlier_cells(df, columns, sigmas)
    grouped = cells.groupBy("column").agg(
        *[F.round(F.max(c), digits).alias(c) for c in ("mean", "std", "lower", "upper")],
        F.count(F.lit(1)).alias("n_outliers"),
    )
    return grouped.withColumn("pct_outliers", F.round(F.col("n_outliers") * 100.0 / rows, digits))


def outlier_examples(df: DataFrame, columns: Sequence[str], sigmas: float = 3.0, examples: int = 5) -> DataFrame:
    """A few values beyond the bounds per column, the smallest first."""
    rank = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    cells = _outlier_cells(df, columns, sigmas).select("column", "value")
    return cells.withColumn("position", rank.cast("bigint")).filter(F.col("position") <= examples)


def correlations(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every ordered pair of columns, all from one aggregate."""
    values = {c: F.col(c).cast("double") for c in columns}
    pairs = [(a, b) for i, a in enumerate(columns) for b in list(columns)[i:]]
    wide = df.agg(
        F.array(
            *[
                F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.corr(values[a], values[b]), digits).alias("r"))
                for a, b in pairs
            ]
        ).alias("pairs")
    ).select(F.inline("pairs"))
    both = F.array(
        F.struct(F.col("a").alias("column_a"), F.col("b").alias("column_b"), F.col("r").alias("corr")),
        F.struct(F.col("b").alias("column_a"), F.col("a").alias("column_b"), F.col("r").alias("corr")),
    )
    mirrored = F.when(F.col("a") == F.col("b"), F.slice(both, 1, 1)).otherwise(both)
    return wide.select(F.inline(mirrored))


def correlations_with(df: DataFrame, label: str, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every column with the label, in one pass."""
    target = F.col(label).cast("double")
    entries = [
        F.struct(F.lit(c).alias("column"), F.round(F.corr(F.col(c).cast("double"), target), digits).alias("corr"))
        for c in columns
    ]
    return df.agg(F.array(*entries).alias("columns")).select(F.inline("columns"))


def preview(df: DataFrame, rows: int = 5, order: Sequence[Column] = ()) -> DataFrame:
    """The first rows, for a report."""
    return (df.orderBy(*order) if order else df).limit(rows)
