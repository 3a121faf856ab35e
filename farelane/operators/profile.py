"""Profiling tables: what an exploratory notebook would print or plot."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.operators.quantiles import Summary, number, per_column, stack_columns, summaries
from farelane.staging import staged

QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles and maximum per column."""
    with staged(df.select(*(number(c).alias(c) for c in cols)), "describe") as rows:
        found = summaries(rows, cols, QUARTILES)
    out = [(c, s.count, s.mean, s.std, s.min, *s.quantiles, s.max) for c, s in found.items()]
    return df.sparkSession.createDataFrame(
        out,
        "column string, count long, mean double, std double, min double, "
        "q25 double, q50 double, q75 double, max double",
    )


def box_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 IQR) and outlier count per column."""
    with staged(df.select(*(number(c).alias(c) for c in cols)), "box") as rows:
        found = summaries(rows, cols, QUARTILES)
        filled = [c for c in cols if found[c].count and found[c].ones is None]
        x = F.col("x")
        reach = {c: 1.5 * (found[c].quantiles[2] - found[c].quantiles[0]) for c in filled}
        low = per_column([found[c].quantiles[0] - reach[c] for c in filled])
        high = per_column([found[c].quantiles[2] + reach[c] for c in filled])
        marks = (
            stack_columns(rows, filled)
            .groupBy("c")
            .agg(
                F.min(F.when(x >= low, x)).alias("low"),
                F.max(F.when(x <= high, x)).alias("high"),
                F.count_if((x < low) | (x > high)).alias("outliers"),
            )
            .collect()
            if filled
            else []
        )
    whiskers = {filled[m.c]: (m.low, m.high, m.outliers) for m in marks}
    whiskers |= {c: _flag_whiskers(found[c]) for c in cols if found[c].ones is not None}
    out = [(c, *found[c].quantiles, *whiskers.get(c, (None, None, 0))) for c in cols]
    return df.sparkSession.createDataFrame(
        out,
        "column string, q25 double, q50 double, q75 double, whisker_low double, whisker_high double, outliers long",
    )


def _flag_whiskers(s: Summary) -> tuple[float, float, int]:
    """Whiskers and outliers of a column of zeros and ones."""
    q25, _, q75 = s.quantiles
    reach = 1.5 * (q75 - q25)
    values = [(v, n) for v, n in ((0.0, s.count - s.ones), (1.0, s.ones)) if n]
    low, high = [v for v, _ in values if v >= q25 - reach], [v for v, _ in values if v <= q75 + reach]
    return low[0], high[-1], sum(n for v, n in values if not q25 - reach <= v <= q75 + reach)


def column_info(df: DataFrame) -> DataFrame:
    """``(position, column, type, non_null)`` for every column, in one pass."""
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.count(f.name).alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def time_range(df: DataFrame, col: str = "pickup_datetime") -> DataFrame:
    return df.agg(F.min(col).alias("first_pickup"), F.max(col).alias("last_pickup"))


def dataset_month(df: DataFrame, floor: str | None = "2014-12-01", col: str = "pickup_datetime") -> DataFrame:
    """Month of the latest trip; anything before 2015 counts as ``floor``."""
    last = F.max(col)
    month = F.trunc(last.cast("date"), "month")
    if floor is not None:
        month = F.when(F.year(last) < 2015, F.lit(floor).cast("date")).otherwise(month)
    return df.agg(month.alias("dataset_month"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


def head_sorted(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in the given order (all columns when none is named)."""
    return df.orderBy(*(order or df.columns)).limit(n)


def fit_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x``: one row ``slope, intercept, r2, n``."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation of two columns: one row ``r, n``."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    return df.agg(F.corr(x, y).alias("r"), F.count_if(both).alias("n"))


def pearson(df: DataFrame, x: str, y: str) -> tuple[float, float]:
    """Pearson r and its two-sided p-value."""
    r, n = correlation(df, x, y).first()
    return r, pearson_p_value(r, n)


def pearson_p_value(r: float, n: int) -> float:
    """Two-sided p-value of r under no correlation: Student t with n - 2 degrees of freedom."""
    if n < 3:
        return 1.0
    free = n - 2
    rest = max(1.0 - r * r, 0.0)  # = free / (free + t^2)
    return _incomplete_beta(free / 2.0, 0.5, rest)


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _incomplete_beta(b, a, 1.0 - x)
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    # modified Lentz evaluation: value = 1 / (1 + d1 / (1 + d2 / (1 + ...)))
    tiny = 1e-300
    value = c = 1.0
    d = 0.0
    for i in range(1, 1000):
        m = i // 2
        if i % 2:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1.0 / (1.0 + term * d or tiny)
        c = 1.0 + term / c or tiny
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return math.exp(log_front) / (a * value)


def corr_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix as ``(i, j, r)``; pairs with a constant column have a null ``r``.

    The matrix is built in distributed passes over the staged columns; its size
    depends on the number of columns only. Rows with a missing value are left out.
    """
    with staged(df.select(*cols), "corr") as rows:
        vectors = VectorAssembler(inputCols=list(cols), outputCol="v", handleInvalid="skip").transform(rows).select("v")
        matrix = Correlation.corr(vectors, "v").first()[0].toArray()
        extent = vectors.select(Summarizer.metrics("min", "max").summary(F.col("v")).alias("s")).first().s
    spread = [lo != hi for lo, hi in zip(extent["min"], extent["max"])]
    out = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            known = spread[i] and spread[j] and not math.isnan(matrix[i][j])
            out.append((a, b, float(matrix[i][j]) if known else None))
    return df.sparkSession.createDataFrame(out, "i string, j string, r double")
