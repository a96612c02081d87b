"""Contingency tables, their margins, and the tests on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats, tails


def cells(df: DataFrame, row: Column, col: Column, by: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """Counts a (row and col), b (row only), c (col only), d (neither), always one row per stratum.

    Rows where one of the two conditions is NULL are left out.
    """
    weight = F.lit(1) if weight is None else weight
    weight = F.when(row.isNotNull() & col.isNotNull(), weight)

    def count(r: bool, c: bool) -> Column:
        hit = (row if r else ~row) & (col if c else ~col)
        return F.coalesce(F.sum(F.when(hit, weight)), F.lit(0)).cast("bigint")

    grid = {"a": (True, True), "b": (True, False), "c": (False, True), "d": (False, False)}
    return df.groupBy(*by).agg(*[count(*rc).alias(name) for name, rc in grid.items()])


def present(flag: Column, null_flag: str = "true") -> Column:
    """A flag that may be missing after an outer join: ``true`` reads a missing flag as set,
    ``drop`` leaves such rows out, ``false`` reads it as not set."""
    if null_flag == "drop":
        return flag
    return F.coalesce(flag, F.lit(null_flag == "true"))


def counts(df: DataFrame, row: str, col: str) -> DataFrame:
    """Long crosstab without NULLs."""
    return df.dropna(subset=[row, col]).groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))


def with_margins(df: DataFrame, row: str, col: str) -> DataFrame:
    """Long crosstab with row, column and grand totals; a total has NULL in place of the value."""
    return counts(df, row, col).cube(row, col).agg(F.sum("n").alias("n"))


def row_pct(df: DataFrame, row: str, col: str, digits: int = 2) -> DataFrame:
    """Crosstab as percentages of each row."""
    table = counts(df, row, col)
    total = F.sum("n").over(Window.partitionBy(row))
    return table.select(row, col, "n", F.round(F.lit(100.0) * F.col("n") / total, digits).alias("pct"))


def value_counts(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows per listed value, zero where it does not occur."""
    found = df.filter(F.col(column).isin(list(values))).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    wanted = df.sparkSession.createDataFrame([(v,) for v in values], f"{column} {dict(df.dtypes)[column]}")
    return wanted.join(found, column, "left").fillna(0, ["n"])


def swap_rows() -> list[str]:
    """The cells with the two rows exchanged, as the tests with rows [no, yes] need them."""
    return ["d", "c", "b", "a"]


def with_tests(
    table: DataFrame,
    zero: str = "haldane",
    floor: float | None = None,
    one_sided: bool = False,
    fisher: bool = True,
) -> DataFrame:
    """Add odds ratio, interval, chi-squared with correction and Fisher p-values to cells a, b, c, d.

    The table has one row per stratum by now; only these rows meet Python. The one-sided p-value
    asks whether d is larger than independence allows.
    """
    abcd = ["a", "b", "c", "d"]
    out = table.withColumns(
        {
            "n": F.col("a") + F.col("b") + F.col("c") + F.col("d"),
            **stats.odds_ratio(*abcd, zero=zero),
            "chi2": stats.chi2_yates(*abcd, floor=floor),
        }
    )
    more = {"p_chi2": tails.p_chi2("chi2")}
    if fisher:
        more["p_fisher"] = tails.p_fisher(*abcd)
    if one_sided:
        more["p_greater"] = tails.p_fisher(*swap_rows(), alternative="greater")
    return out.withColumns(more)


def holm(df: DataFrame, p: str, out: str = "p_holm") -> DataFrame:
    """Holm's step-down adjustment over the rows of a result table (one row per stratum)."""
    by_p = Window.orderBy(F.col(p).asc_nulls_last())
    everything = Window.partitionBy()
    steps = df.withColumns({"_rank": F.row_number().over(by_p), "_m": F.count(p).over(everything)})
    scaled = steps.withColumn("_scaled", F.least(F.lit(1.0), F.col(p) * (F.col("_m") - F.col("_rank") + 1)))
    running = F.max("_scaled").over(Window.orderBy("_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return scaled.withColumn(out, F.when(F.col(p).isNotNull(), running)).drop("_rank", "_m", "_scaled")


def binomial_rates(df: DataFrame, success: Column, by: Sequence[str] = (), p0: float = 0.5) -> DataFrame:
    """Successes, rate with Wilson interval, exact binomial p-value and deviation in points."""
    table = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(success).alias("k"))
    out = table.withColumns(stats.wilson("k", "n"))
    out = out.withColumn("diff_pp", (F.col("rate") - p0) * 100)
    return out.withColumn("p_binom", tails.p_binomial("k", "n", p0))
