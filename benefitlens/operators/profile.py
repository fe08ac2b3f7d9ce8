"""Profiles and aggregates (A1-A28): each is one job over all columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benefitlens.schemas import numeric_columns, text_columns


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation; null (not an ANSI error) when a side is constant.

    Rows where either side is null are skipped, like pandas (G13).
    """
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def profile_table(df: DataFrame) -> DataFrame:
    """A1 + PF13: one row per column: position, type kind, non-null and row counts."""
    nums = set(numeric_columns(df))
    fields = df.schema.fields
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    structs = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.lit("numeric" if f.name in nums else "text").alias("kind"),
                        F.col(f"c{i}").cast("bigint").alias("non_null"))
               for i, f in enumerate(fields)]
    out = agg.select(F.col("_rows").cast("bigint").alias("n_rows"),
                     F.lit(len(fields)).alias("n_cols"), F.explode(F.array(*structs)).alias("s"))
    return out.select("n_rows", "n_cols", "s.*")


def missing_profile(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """A2: null count and percentage per column, one pass, unpivoted."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).cast("bigint").alias(c) for c in cols])
    long = agg.unpivot(["_rows"], cols, "column_name", "null_count")
    long = long.withColumn("null_pct", F.try_divide(F.col("null_count") * 100.0, F.col("_rows"))).drop("_rows")
    return long.filter(F.col("null_count") > 0) if only_missing else long


def _moments(c: str) -> list[Column]:
    col = F.col(c).cast("double")
    return [F.count(col).cast("bigint").alias("count"), F.avg(col).alias("mean"),
            F.stddev_samp(col).alias("std"), F.min(col).alias("min"), F.max(col).alias("max")]


def _describe(df: DataFrame, value: str, groups, exact: bool, extra=()) -> DataFrame:
    """Moments in one grouped pass; quartiles exact (distributed) or approximate.

    Without groups a constant key stands in, so the two one-row results are
    combined by an ordinary equi-join.
    """
    from benefitlens.operators.quantiles import quartile_columns
    keyless = not groups
    if keyless:
        df, groups = df.withColumn("_k", F.lit(0)), ["_k"]
    moments = df.groupBy(*groups).agg(*_moments(value), *extra)
    if exact:
        qs = quartile_columns(df, value, groups)
    else:
        qs = df.groupBy(*groups).agg(
            F.percentile_approx(F.col(value).cast("double"), [0.25, 0.5, 0.75], 10000).alias("_q"))
        qs = qs.select(*groups, *[F.col("_q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))])
    # both sides hold one row per group
    out = moments.join(qs, list(groups), "left")
    return out.drop("_k") if keyless else out


def describe_numeric(df: DataFrame, columns=None, exact: bool = True) -> DataFrame:
    """A3: pandas ``describe()`` per numeric column (sample std, interpolated
    quartiles) over one unpivoted frame grouped by column name.

    ``exact=True`` uses the distributed exact quantiles; ``exact=False``
    switches to ``percentile_approx``.
    """
    cols = columns or numeric_columns(df)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
             .unpivot([], cols, "column_name", "_v")
    return _describe(long, "_v", ["column_name"], exact)


def describe_by_group(df: DataFrame, by: str, column: str, exact: bool = True) -> DataFrame:
    """A4: ``groupby(by)[column].describe()``; null group keys are dropped."""
    return _describe(df.filter(F.col(by).isNotNull()), column, [by], exact)


def value_counts(df: DataFrame, column: str, normalize: bool = False, dropna: bool = False) -> DataFrame:
    """Counts per value (null kept unless ``dropna``), optionally as shares."""
    src = df.filter(F.col(column).isNotNull()) if dropna else df
    g = src.groupBy(column).agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    if normalize:
        total = src.count()  # one bounded scalar; no single-task window over the values
        g = g.withColumn("proportion", F.col("count") / F.lit(float(total)))
    return g


#: A text column with more distinct values (estimated) takes its top values from sketches.
NARROW = 100_000


def cardinality_top5(df: DataFrame, columns=None, top: int = 5, exact: bool = True, rsd: float = 0.01,
                     narrow: int = NARROW) -> DataFrame:
    """Distinct count and the ``top`` most frequent values of every text
    column.

    Columns of few values are counted in one unpivot + one grouped count.  For
    wide ones the top values come from count-min candidates that are recounted
    (``heavy``), so they're exact without shuffling every value.  ``exact=False``
    reports HyperLogLog estimates as ``n_unique`` and adds ``relative_sd``,
    their relative standard deviation.

    Ties are broken by the value text so the report is deterministic.
    """
    from benefitlens.operators.heavy import approx_cardinality, top_values
    cols = columns or text_columns(df)
    estimates = {r["column_name"]: r["n_unique"] for r in approx_cardinality(df, cols, rsd).collect()}  # a number a column
    wide = [c for c in cols if estimates[c] > narrow]
    few = [c for c in cols if c not in wide]
    parts, cards = [], []
    if few:
        long = df.select(*few).unpivot([], few, "column_name", "value")
        counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
        w = Window.partitionBy("column_name").orderBy(F.col("count").desc(), F.col("value").asc_nulls_first())
        parts.append(counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top))
        cards.append(counts.filter(F.col("value").isNotNull()).groupBy("column_name")
                     .agg(F.count(F.lit(1)).cast("bigint").alias("n_unique")))
    if wide:
        parts.append(top_values(df, wide, top))
        long = df.select(*wide).unpivot([], wide, "column_name", "value").filter(F.col("value").isNotNull())
        cards.append(long.distinct().groupBy("column_name").agg(F.count(F.lit(1)).cast("bigint").alias("n_unique")))
    ranked = reduce(DataFrame.unionByName, parts)
    if exact:
        return ranked.join(reduce(DataFrame.unionByName, cards), "column_name", "left")
    known = F.create_map(*[F.lit(x) for c in cols for x in (c, estimates[c])])
    return ranked.withColumns({"n_unique": F.nullif(known[F.col("column_name")], F.lit(0)).cast("bigint"), "relative_sd": F.lit(float(rsd))})


def distinct_levels(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null levels."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def rate_by_group(df: DataFrame, by, target: str = "enrolled") -> DataFrame:
    """Mean target per group; null keys dropped like pandas groupby."""
    keys = [by] if isinstance(by, str) else list(by)
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return (df.filter(cond).groupBy(*keys)
            .agg(F.avg(F.col(target).cast("double")).alias("rate"),
                 F.count(F.lit(1)).cast("bigint").alias("n")))


def count_by_group(df: DataFrame, by: str, column: str = "employee_id") -> DataFrame:
    """Non-null count of ``column`` per group."""
    return (df.filter(F.col(by).isNotNull()).groupBy(by)
            .agg(F.count(column).cast("bigint").alias("count")))


def first_by_group(df: DataFrame, by: str, column: str) -> DataFrame:
    """A per-group constant (e.g. a region attribute) without ordering:
    min and max are reported so a non-constant column is visible."""
    return (df.filter(F.col(by).isNotNull()).groupBy(by)
            .agg(F.min(column).alias("value"),
                 (F.min(column).eqNullSafe(F.max(column))).alias("is_constant")))


def crosstab(df: DataFrame, row: str, col: str, levels) -> DataFrame:
    """Counts pivoted on the given column levels (zero-filled)."""
    p = df.groupBy(row).pivot(col, levels).agg(F.count(F.lit(1)))
    return p.select(row, *[F.coalesce(F.col(str(v)), F.lit(0)).cast("bigint").alias(f"{col}_{v}")
                           for v in levels])


def crosstab_margins(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts with row/column/grand totals via ``cube``; margins are
    labelled 'All' (totals are told apart from null keys by ``grouping``)."""
    c = df.cube(row, col).agg(F.count(F.lit(1)).cast("bigint").alias("count"),
                              F.grouping(row).alias("_gr"), F.grouping(col).alias("_gc"))
    return c.select(
        F.when(F.col("_gr") == 1, F.lit("All")).otherwise(F.col(row).cast("string")).alias(row),
        F.when(F.col("_gc") == 1, F.lit("All")).otherwise(F.col(col).cast("string")).alias(col),
        "count")


def crosstab_rowpct(df: DataFrame, row: str, col: str, levels, missing: str = "Missing") -> DataFrame:
    """Cross-tab over the given column levels as shares of their row, nulls
    shown as ``Missing``; a row value that has none of the levels is left out."""
    filled = df.withColumn(row, F.coalesce(F.col(row).cast("string"), F.lit(missing)))
    p = filled.groupBy(row).pivot(col, levels).agg(F.count(F.lit(1)))
    total = sum((F.coalesce(F.col(str(v)), F.lit(0)) for v in levels), F.lit(0))
    return p.filter(total > 0).select(row, *[(F.coalesce(F.col(str(v)), F.lit(0)) / total).alias(f"{col}_{v}")
                                             for v in levels])


def corr_with_target(df: DataFrame, columns, target: str = "enrolled") -> DataFrame:
    """Pearson correlation of each column with the target, one pass."""
    agg = df.agg(*[safe_corr(F.col(c), F.col(target)).alias(c) for c in columns])
    return agg.unpivot([], list(columns), "column_name", "corr")


def missing_corr(df: DataFrame, columns, target: str = "enrolled") -> DataFrame:
    """Correlation of each column's missingness with the target."""
    agg = df.agg(*[safe_corr(F.col(c).isNull().cast("int"), F.col(target)).alias(c) for c in columns])
    return agg.unpivot([], list(columns), "column_name", "corr")


def missing_cooccur(df: DataFrame, columns) -> DataFrame:
    """Rows where both columns of a pair are null, for all pairs (also those that never meet).

    A row's pattern is the list of its null columns.  Rows are counted by
    pattern (combined map-side), and pairs are expanded from the distinct
    patterns only, so neither the plan nor the work grows with rows times
    columns squared.
    """
    names = sorted(set(columns))
    marks = [F.when(F.col(f"`{c}`").isNull(), F.lit(i)) for i, c in enumerate(names)]
    patterns = (df.select(F.array_compact(F.array(*marks)).alias("_p")).filter(F.size("_p") > 1)
                .groupBy("_p").agg(F.count(F.lit(1)).alias("_n")))
    pairs = F.flatten(F.transform("_p", lambda a, i: F.transform(
        F.slice("_p", i + 2, F.size("_p")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    met = patterns.select("_n", F.explode(pairs).alias("_pair")).groupBy("_pair.a", "_pair.b").agg(F.sum("_n").alias("_n"))
    m = len(names)
    every = (df.sparkSession.range(max(m - 1, 0)).select(F.col("id").cast("int").alias("a"))
             .withColumn("b", F.explode(F.sequence(F.col("a") + 1, F.lit(m - 1)))))
    name = lambda i: F.element_at(F.array(*[F.lit(c) for c in names]), F.col(i) + 1)
    return every.join(met, ["a", "b"], "left").select(
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("both_missing"), name("a").alias("column_a"), name("b").alias("column_b"))


def quantiles(df: DataFrame, column: str, probs, exact: bool = True) -> DataFrame:
    """Interpolated quantiles (exact, distributed) or ``percentile_approx``."""
    if exact:
        from benefitlens.operators.quantiles import exact_quantiles
        return exact_quantiles(df, column, probs)
    col = F.col(column).cast("double")
    out = df.agg(F.percentile_approx(col, [float(p) for p in probs], 10000).alias("_q"))
    return out.select(F.posexplode("_q").alias("_i", "value")).select(
        F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("_i") + 1).alias("prob"), "value")


def chronology_stats(engineered: DataFrame) -> DataFrame:
    """Rows with both dates, contacts after application and their range."""
    d = F.col("days_contact_to_app")
    return engineered.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_if(F.col("app_date").isNull()).cast("bigint").alias("null_app_date"),
        F.count_if(F.col("contact_date").isNull()).cast("bigint").alias("null_contact_date"),
        F.count(d).cast("bigint").alias("both_dates"),
        F.count_if(d < 0).cast("bigint").alias("contact_after_app"),
        F.min(F.when(d < 0, d)).alias("min_negative_days"),
        F.max(F.when(d < 0, d)).alias("max_negative_days"),
        F.try_divide(F.count_if(d < 0) * 100.0, F.count(d)).alias("pct_after"),
        F.avg(F.when(d >= 0, F.col("enrolled").cast("double"))).alias("rate_in_order"),
        F.avg(F.when(d < 0, F.col("enrolled").cast("double"))).alias("rate_after"),
    )


def date_format_profile(df: DataFrame, column: str = "application_date") -> DataFrame:
    """A25/PF11/F27: slash-dated values, how many have a first or second part
    above 12, and the maxima of both parts."""
    s = F.col(column)
    slash = df.filter(s.isNotNull() & s.contains("/"))
    first = F.expr(f"try_cast(split(`{column}`, '/')[0] AS INT)")
    second = F.expr(f"try_cast(split(`{column}`, '/')[1] AS INT)")
    return slash.agg(
        F.count(F.lit(1)).cast("bigint").alias("slash_rows"),
        F.max(first).alias("max_first"), F.max(second).alias("max_second"),
        F.count_if(first > 12).cast("bigint").alias("first_gt_12"),
        F.count_if(second > 12).cast("bigint").alias("second_gt_12"))


def date_parse_failures(df: DataFrame, raw: str, parsed: Column) -> DataFrame:
    """Raw text present but not parseable."""
    return df.filter(F.col(raw).isNotNull() & parsed.isNull())


def start_age_profile(df: DataFrame) -> DataFrame:
    """``age - tenure_years`` summarised like ``describe`` plus the
    count of starts before 18."""
    d = df.withColumn("start_age", F.col("age") - F.col("tenure_years"))
    return _describe(d, "start_age", [], True,
                     extra=[F.count_if(F.col("start_age") < 18).cast("bigint").alias("under_18")])
