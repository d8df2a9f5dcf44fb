"""Profiling: nulls, statistics, distributions, correlations and quality.

Each profile is one aggregation over all columns at once.  Where bins or brackets must be known
first, the columns asked for are written once as doubles, and the passes read only that table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from titlelens.functions.hints import broadcast_if_small
from titlelens.functions.metrics import reliable_rating, valid_financials, with_metrics
from titlelens.operators.quantiles import quantiles
from titlelens.operators.rollup import titles_per_year, token_counts
from titlelens.plans.scratch import scratch_path, stored

# The columns profiled by default.
NUMERIC_COLUMNS = ["budget_musd", "revenue_musd", "runtime", "vote_average", "vote_count",
                   "popularity", "cast_size", "crew_size"]
CORRELATED_COLUMNS = ["budget_musd", "revenue_musd", "runtime", "vote_average", "vote_count",
                      "popularity"]


def _present(df: DataFrame, columns: Sequence[str] | None, default: Sequence[str]) -> list[str]:
    return [c for c in (default if columns is None else columns) if c in df.columns]


def _percent(part: Column, whole: Column) -> Column:
    """Null when there is nothing to take a share of."""
    return F.try_divide(part, whole) * 100


def _long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) with the non-null values of numeric columns as doubles."""
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot([], list(columns), "column", "value").filter("value IS NOT NULL")


_ROWS, _FINANCIAL, _RATED = "__rows", "__financial", "__rated"


def _counts(df: DataFrame) -> list[Column]:
    """All that nulls, overview and quality need: rows, present cells per column, usable rows."""
    counts = [F.count("*").alias(_ROWS), *[F.count(f"`{c}`").alias(c) for c in df.columns]]
    if {"budget_musd", "revenue_musd"} <= set(df.columns):
        counts.append(F.count_if(valid_financials()).alias(_FINANCIAL))
    if {"vote_count", "vote_average"} <= set(df.columns):
        counts.append(F.count_if(reliable_rating()).alias(_RATED))
    return counts


def overview(df: DataFrame) -> DataFrame:
    """One row per column with its position and type, and the row and column counts."""
    return _overview_of(df.agg(F.count("*").alias(_ROWS)), df)


def _overview_of(counted: DataFrame, df: DataFrame) -> DataFrame:
    described = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(field.name).alias("column"),
                 F.lit(field.dataType.simpleString()).alias("type"))
        for i, field in enumerate(df.schema, start=1)
    ])
    return counted.select(F.inline(described), F.col(_ROWS).alias("row_count"),
                          F.lit(len(df.columns)).alias("col_count"))


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, most incomplete first, from one pass.  NaN is a value, not a null."""
    return _nulls_of(df.agg(*_counts(df)), df)


def _nulls_of(counted: DataFrame, df: DataFrame) -> DataFrame:
    share = F.bround(_percent(F.col("null_count"), F.col(_ROWS)), 2)
    return (counted.unpivot([_ROWS], [f"`{c}`" for c in df.columns], "column", "filled")
            .withColumn("null_count", F.col(_ROWS) - F.col("filled"))
            .select("column", "null_count", share.alias("null_percentage"))
            .orderBy(F.desc("null_percentage"), "column"))


def summary(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles as rows of text, a column per metric.

    The layout of Spark's own summary, whose quartiles are elements.  They are exact at any size;
    with `exact=False` they come from Spark's sketch.
    """
    columns = _present(df, columns, NUMERIC_COLUMNS)
    if not exact:
        return df.select(*columns).summary()
    return _summary_of(_doubles(df, columns), columns)


def _summary_of(doubles: DataFrame, columns: Sequence[str]) -> DataFrame:
    q = F.col("quantiles")
    cells = {"count": F.col("count"), "mean": F.col("mean"), "stddev": F.col("std"),
             "min": F.col("min"), "25%": q[0], "50%": q[1], "75%": q[2], "max": F.col("max")}
    measured = _measured(doubles, columns, element=True)
    long = measured.select("column", F.posexplode(F.array(*[
        cell.cast("string") for cell in cells.values()])).alias("place", "text"))
    # One row per metric and line.
    wide = long.groupBy("place").agg(*[
        F.max(F.when(F.col("column") == c, F.col("text"))).alias(c) for c in columns])
    names = F.array(*map(F.lit, cells))
    return wide.orderBy("place").select(F.get(names, F.col("place")).alias("summary"), *columns)


def _doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles, written once: exact quantiles and bins pass over them repeatedly."""
    return stored(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]),
                  "profile")


def _measured(df: DataFrame, columns: Sequence[str], exact: bool = True,
              element: bool = False) -> DataFrame:
    """Moments and quartiles, one row per column, one with count 0 where there are no values."""
    moments = {"count": F.count("*"), "mean": F.avg("value"), "std": F.stddev("value"),
               "min": F.min("value"), "max": F.max("value")}
    measured = quantiles(_long_values(df, columns), "value", [0.25, 0.5, 0.75], ["column"],
                         len(columns), exact, element, also=moments,
                         rows=df.count() * len(columns) if exact else None)
    names = F.explode(F.array(*[F.lit(c) for c in columns]))
    listed = df.sparkSession.range(0, 1, 1, 1).select(names.alias("column"))
    return listed.join(F.broadcast(measured), "column", "left").withColumn(
        "count", F.coalesce("count", F.lit(0)))


def statistics(df: DataFrame, columns: Sequence[str] | None = None,
               exact: bool = True) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles, one row per numeric column."""
    columns = _present(df, columns, NUMERIC_COLUMNS)
    return _statistics_of(_doubles(df, columns) if exact else df, columns, exact)


def _statistics_of(doubles: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    measured = _measured(doubles, columns, exact)
    q = F.col("quantiles")
    return measured.select("column", "count", "mean", "std", "min", q[0].alias("p25"),
                           q[1].alias("median"), q[2].alias("p75"), "max")


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 30) -> DataFrame:
    """Equal-width bins between each column's extremes, empty bins included.

    Bins are closed on the left, and the last one on both sides.  A column with a single value
    gets a range of width one around it.  The profit is always added.  NaN and infinite values
    are left out: they have no place in a range.
    """
    rows = with_metrics(df, "profit_musd")
    chosen = _binned(rows, columns)
    return _histogram_of(_doubles(rows, chosen), chosen, bins)


def _binned(rows: DataFrame, columns: Sequence[str] | None) -> list[str]:
    chosen = _present(rows, columns, NUMERIC_COLUMNS)
    extra = ["profit_musd"] if "profit_musd" in rows.columns and "profit_musd" not in chosen else []
    return chosen + extra


def _histogram_of(doubles: DataFrame, chosen: Sequence[str], bins: int = 30) -> DataFrame:
    values = _long_values(doubles, chosen).filter(
        ~F.isnan("value") & (F.abs("value") < float("inf")))

    extremes = values.groupBy("column").agg(F.min("value").alias("least"),
                                            F.max("value").alias("most"))
    spread = F.when(F.col("least") == F.col("most"), 0.5).otherwise(0.0)
    ranges = extremes.select("column", (F.col("least") - spread).alias("lo"),
                             (F.col("most") + spread).alias("hi"))

    def edge(k: Column) -> Column:
        step = (F.col("hi") - F.col("lo")) / bins
        return F.when(k == bins, F.col("hi")).otherwise(F.col("lo") + k * step)

    # The position by division may be off by one at an edge; the edges themselves decide.
    v = F.col("value")
    guess = F.least(F.floor((v - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins),
                    F.lit(bins - 1))
    settled = (F.when(v < edge(F.col("guess")), F.col("guess") - 1)
               .when((F.col("guess") < bins - 1) & (v >= edge(F.col("guess") + 1)),
                     F.col("guess") + 1)
               .otherwise(F.col("guess")))
    # One row per column is broadcast.
    counts = (values.join(F.broadcast(ranges), "column")
              .withColumn("guess", guess)
              .groupBy("column", (settled + 1).cast("int").alias("bin"))
              .agg(F.count("*").alias("filled")))
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    return (grid.join(broadcast_if_small(counts, bins * len(chosen)), ["column", "bin"], "left")
            .select("column", "bin", edge(F.col("bin") - 1).alias("bin_start"),
                    edge(F.col("bin")).alias("bin_end"),
                    F.coalesce("filled", F.lit(0)).alias("count"))
            .orderBy("column", "bin"))


def _moments_by_mask(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per combination of present columns: rows, means, extremes and co-moments, in one scan.

    Within such a group a column is present in all rows or in none, so plain aggregates serve
    every pair of columns.  There are as many groups as there are patterns of nulls.
    """
    place = range(len(columns))
    doubles = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}")
                          for i, c in enumerate(columns)])
    mask = " + ".join(f"if(x{i} IS NULL, 0L, {1 << i}L)" for i in place)
    measures = [f"avg(x{i}) AS m{i}" for i in place]
    measures += [f"min(x{i}) AS lo{i}" for i in place] + [f"max(x{i}) AS hi{i}" for i in place]
    measures += [f"covar_pop(x{i}, x{j}) AS c{i}_{j}"
                 for i, j in combinations_with_replacement(place, 2)]
    return doubles.groupBy(F.expr(mask).alias("mask")).agg(
        F.expr("count(*) AS n"), *[F.expr(m) for m in measures])


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_x, column_y, correlation) for all ordered pairs, from one scan.

    Each pair uses the rows that have both values, and is null if either is constant there.  The
    moments of the groups with both present are merged pair by pair: what lies between the means
    of the groups is added to what lies within them, so no large squares are subtracted.
    """
    columns = _present(df, columns, CORRELATED_COLUMNS)
    if not 0 < len(columns) < 64:
        raise ValueError("from 1 to 63 columns can be correlated")
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    structs = ", ".join(
        f"named_struct('x', {i}, 'y', {j}, 'n', n, 'mx', m{i}, 'my', m{j}, 'xy', c{i}_{j}, "
        f"'xx', c{i}_{i}, 'yy', c{j}_{j}, 'lox', lo{i}, 'hix', hi{i}, 'loy', lo{j}, 'hiy', hi{j})"
        for i, j in pairs)
    groups = (_moments_by_mask(df, columns).selectExpr(f"inline(array({structs}))")
              .filter("mx IS NOT NULL AND my IS NOT NULL"))
    # As many rows per pair as there are patterns of nulls.
    centred = groups.selectExpr(
        "*", "mx - sum(n * mx) OVER (PARTITION BY x, y) / sum(n) OVER (PARTITION BY x, y) AS dx",
        "my - sum(n * my) OVER (PARTITION BY x, y) / sum(n) OVER (PARTITION BY x, y) AS dy")
    merged = centred.groupBy("x", "y").agg(
        *[F.expr(e) for e in (
            "sum(n * (xy + dx * dy)) AS xy", "sum(n * (xx + dx * dx)) AS xx",
            "sum(n * (yy + dy * dy)) AS yy",
            "min(lox) < max(hix) AND min(loy) < max(hiy) AS varies")])
    value = F.expr("CASE WHEN varies AND x = y THEN 1D "
                   "WHEN varies THEN try_divide(xy, sqrt(xx) * sqrt(yy)) END")
    found = merged.select("x", "y", value.alias("correlation"))
    every = ", ".join(f"named_struct('x', {i}, 'y', {j})" for i, j in pairs)
    listed = df.sparkSession.range(0, 1, 1, 1).selectExpr(f"inline(array({every}))")
    # One row per pair of columns is broadcast.
    both = listed.join(F.broadcast(found), ["x", "y"], "left").selectExpr(
        "inline(IF(x = y, array(named_struct('x', x, 'y', y)), "
        "array(named_struct('x', x, 'y', y), named_struct('x', y, 'y', x))))", "correlation"
    ).toDF("x", "y", "correlation")
    names = F.array(*map(F.lit, columns))
    return both.orderBy("x", "y").select(F.get(names, F.col("x")).alias("column_x"),
                                         F.get(names, F.col("y")).alias("column_y"), "correlation")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The same as a square: one row and one column per metric, in the given order."""
    columns = _present(df, columns, CORRELATED_COLUMNS)
    cells = [F.max(F.when(F.col("column_y") == c, F.col("correlation"))).alias(c) for c in columns]
    place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column"))
    return (correlation_pairs(df, columns).groupBy(F.col("column_x").alias("column"))
            .agg(*cells).orderBy(place))


def quality_report(df: DataFrame) -> DataFrame:
    """Completeness of all cells, and how many rows have usable money and rating values."""
    return _quality_of(df.agg(*_counts(df)), df)


def _quality_of(counted: DataFrame, df: DataFrame) -> DataFrame:
    filled = sum((F.col(f"`{c}`") for c in df.columns), F.lit(0))
    rows, cells = F.col(_ROWS), F.col(_ROWS) * len(df.columns)
    return counted.withColumn("filled_cells", filled).select(
        rows.alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
        cells.alias("total_cells"),
        "filled_cells",
        (cells - F.col("filled_cells")).alias("missing_cells"),
        _percent(F.col("filled_cells"), cells).alias("completeness_pct"),
        F.col(_FINANCIAL).alias("valid_financial_rows"),
        _percent(F.col(_FINANCIAL), rows).alias("valid_financial_pct"),
        F.col(_RATED).alias("reliable_rating_rows"),
        _percent(F.col(_RATED), rows).alias("reliable_rating_pct"))


def full_profile(df: DataFrame, all_parts: bool = False) -> dict[str, DataFrame]:
    """The parts of the profile by name, from one pass over `df`.

    That pass writes the few columns that are looked at again, as doubles, tokens and years, and
    counts rows, nulls and usable rows on the way, as metrics of the write itself.  All parts
    read the narrow table or those counts; `df` is not computed a second time.
    """
    spark, rows = df.sparkSession, with_metrics(df, "profit_musd", "release_year")
    numeric, chosen = _present(df, None, NUMERIC_COLUMNS), _binned(rows, None)
    observed = Observation()
    counts = _counts(df)
    kept = [F.col(c).cast("double").alias(c) for c in chosen]
    kept += [F.col(c) for c in ("genres", "release_year") if c in rows.columns]
    narrow = rows.observe(observed, *counts).select(*kept)
    path = scratch_path(spark, "profile")
    narrow.write.parquet(path)
    narrow = spark.read.schema(narrow.schema).parquet(path)
    # One row of counts.
    counted = spark.createDataFrame(
        [tuple(observed.get.values())], ", ".join(f"`{name}` long" for name in observed.get))
    parts = {
        "overview": _overview_of(counted, df),
        "null_profile": _nulls_of(counted, df),
        "summary": _summary_of(narrow, numeric),
        "statistics": _statistics_of(narrow, numeric),
        "histogram": _histogram_of(narrow, chosen),
        "genre_counts": token_counts(narrow),
    }
    if all_parts:
        parts |= {
            "titles_per_year": titles_per_year(narrow),
            "correlation": correlation_matrix(narrow),
            "quality_report": _quality_of(counted, df),
        }
    return parts


# What names a row of each part.
ROW_KEYS = {"overview": ["column"], "null_profile": ["column"], "summary": ["summary"],
            "statistics": ["column"], "histogram": ["column", "bin"], "genre_counts": ["genre"],
            "titles_per_year": ["release_year"], "correlation": ["column"], "quality_report": []}


def profile_values(parts: dict[str, DataFrame], places: int = 4) -> DataFrame:
    """All parts as one table of text: part, row, column, value.

    Doubles, and the numbers of the summary, are shown with `places` digits after the point,
    rounded half up from a hair above.
    """
    def text(name: str, kind: str) -> Column:
        value = F.col(f"`{name}`")
        if kind == "double":
            value = F.round(value + 1e-9, places).cast(f"decimal(38,{places})")
        return value.cast("string").alias(name)

    def long(part: str, df: DataFrame) -> DataFrame:
        keys = ROW_KEYS[part]
        row = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
        cells = [c for c in df.columns if c not in keys]
        if part == "summary":
            df = df.select(*keys, *[F.col(c).try_cast("double").alias(c) for c in cells])
        kinds = dict(df.dtypes)
        return (df.select(row.alias("__row"), *[text(c, kinds[c]) for c in cells])
                .unpivot(["__row"], cells, "column", "value")
                .select(F.lit(part).alias("part"), F.col("__row").alias("row"), "column", "value"))

    return reduce(DataFrame.unionByName, [long(part, df) for part, df in parts.items()])
