"""Fund utilisation and agreement between independent sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.measures import rows, total
from ..functions.values import ratio


def _sum(name: str) -> Column:
    return F.coalesce(total(F.col(name)), F.lit(0))


def state_utilisation(df: DataFrame) -> DataFrame:
    """Allocation, spending and the share of sums per state, rows with an allocation only."""
    return (
        df.filter(F.coalesce(F.col("allocated"), F.lit(0)) != 0)
        .groupBy("state")
        .agg(
            rows().alias("seats"),
            _sum("allocated").alias("allocated"),
            _sum("expenditure").alias("expenditure"),
            _sum("works_completed").alias("works_completed"),
        )
        .filter("allocated > 0")
        .withColumn("pct_spent", ratio(F.col("expenditure"), F.col("allocated"), 1, times=100))
        .orderBy(F.col("pct_spent").desc(), "state")
    )


def reconcile(ours: DataFrame, theirs: DataFrame, metrics: dict[str, tuple[str, str]]) -> DataFrame:
    """Totals side by side: metric, ours, theirs, delta, pct_delta.

    `metrics` maps a label to the summed column on each side. A metric is left out when either
    total is 0 or missing. Amounts are added exactly, as decimals, and the sum is rounded once.
    """

    def long_form(df: DataFrame, side: int, name: str) -> DataFrame:
        def whole(column: str) -> Column:
            return F.round(F.sum(F.col(column).cast("decimal(28,4)")), 0).cast("bigint")

        sums = df.agg(*[whole(pair[side]).alias(f"m{i}") for i, pair in enumerate(metrics.values())])
        pairs = [part for i, label in enumerate(metrics) for part in (F.lit(label), F.col(f"m{i}"))]
        return sums.select(F.stack(F.lit(len(metrics)), *pairs).alias("metric", name))

    return (
        long_form(ours, 0, "ours")
        .join(long_form(theirs, 1, "theirs"), "metric")
        .filter("ours <> 0 AND theirs <> 0")
        .withColumn("delta", F.col("ours") - F.col("theirs"))
        .withColumn("pct_delta", ratio(F.col("delta"), F.col("theirs"), 2, times=100))
    )


HOUSE = "Lok Sabha"


def comparable(theirs: DataFrame, house: str = HOUSE) -> DataFrame:
    """The rows of the other source that are of our house."""
    return theirs.filter(F.col("house") == house)


def consistency_audit(df: DataFrame, house: str = HOUSE) -> DataFrame:
    """Totals of the other source, its comparable subset, and rows that contradict themselves."""
    subset = F.col("house") == house

    def held(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    def subset_sum(name: str) -> Column:
        return F.coalesce(F.sum(F.when(subset, held(name))), F.lit(0))

    wrong = F.count_if(held("completedWorksCount") > held("recommendedWorksCount"))
    return df.agg(
        rows().alias("records_total"),
        F.count_if(subset).alias("records_subset"),
        (rows() - F.count_if(subset)).alias("records_other"),
        wrong.alias("records_completed_exceeds_recommended"),
        ratio(wrong, rows(), 1, times=100).alias("pct_inconsistent"),
        F.round(subset_sum("allocatedAmount")).cast("bigint").alias("subset_allocated"),
        F.round(subset_sum("totalExpenditure")).cast("bigint").alias("subset_expenditure"),
        subset_sum("completedWorksCount").alias("subset_works_completed"),
        subset_sum("recommendedWorksCount").alias("subset_works_recommended"),
    )


def funds_kpis(df: DataFrame) -> DataFrame:
    """Sums of a slice; money only over rows with an allocation."""
    held = F.coalesce(F.col("allocated"), F.lit(0)) != 0
    sums = df.agg(
        F.coalesce(F.sum(F.when(held, F.col("allocated"))), F.lit(0)).alias("allocated"),
        F.coalesce(F.sum(F.when(held, F.col("expenditure"))), F.lit(0)).alias("expenditure"),
        _sum("works_completed").alias("works_completed"),
        _sum("works_recommended").alias("works_recommended"),
    )
    return sums.withColumn("pct_spent", ratio(F.col("expenditure"), F.col("allocated"), 1, times=100))
