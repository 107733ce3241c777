"""Relationship health: explicit rules and the statistical score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.functions.values import as_ts, choose, tidy_round

NO_DATE_DAYS = 9999


def days_silent(last_date: Column, as_of) -> Column:
    return F.coalesce(F.datediff(as_ts(as_of).cast("date"), last_date), F.lit(NO_DATE_DAYS)).cast("long")


def series_position(snapshots: DataFrame) -> DataFrame:
    """Month rows with their place from the start (``i`` from 0), from the end, and the series length."""
    by_rel = Window.partitionBy("rel_id")
    return (
        snapshots.select("rel_id", "year_month", "shipment_count",
                         F.coalesce("total_quantity", F.lit(0.0)).alias("qty"))
        .withColumn("i", F.row_number().over(by_rel.orderBy("year_month")) - 1)
        .withColumn("n", F.count(F.lit(1)).over(by_rel))
        .withColumn("from_end", F.col("n") - F.col("i"))
    )


def stress_rules(rels: DataFrame, snapshots: DataFrame, as_of) -> DataFrame:
    """Rule status, score and reason of every relationship; the first rule that holds decides.

    churned 95, dormant 80, stressed 60, irregular 35, healthy 10. A relationship without a last
    date has been silent for 9999 days; one without months can be dormant but not churned.
    """
    recent = F.col("from_end") <= 2
    stats = series_position(snapshots).groupBy("rel_id").agg(
        F.avg(F.when(recent, F.col("qty"))).alias("recent_qty"),
        F.avg(F.when(recent, F.col("shipment_count"))).alias("recent_freq"),
        F.avg("shipment_count").alias("mean_freq"))
    joined = rels.join(stats, "rel_id", "left").withColumn(
        "days", days_silent(F.col("last_shipment_date"), as_of))
    base = F.coalesce(F.col("baseline_avg_qty"), F.lit(0.0))
    joined = joined.withColumns({
        "drop": F.when((base > 0) & F.col("recent_qty").isNotNull(),
                       F.greatest(F.lit(0.0), (base - F.col("recent_qty")) / base)).otherwise(0.0),
        "known": F.col("mean_freq").isNotNull(),
    })
    days, drop = F.col("days"), F.col("drop")
    halved = (F.col("mean_freq") > 0) & (F.col("recent_freq") < F.col("mean_freq") * 0.5)
    churned = F.col("known") & (days > 180)
    collapsed = F.col("known") & (drop >= 0.70)
    dormant = (days > 90) | collapsed
    stressed = (drop >= 0.30) | days.between(45, 90)
    drop_text = F.concat(F.lit("volume_drop_"), F.floor(drop * 100).cast("int").cast("string"), F.lit("pct"))
    return joined.select(
        "rel_id", "buyer_id", "buyer_name", "supplier_id", "supplier_name", "hs_code", "baseline_avg_qty",
        choose([(churned, "churned"), (dormant, "dormant"), (stressed, "stressed"), (halved, "irregular")],
               "healthy").alias("rule_status"),
        choose([(churned, 95), (dormant, 80), (stressed, 60), (halved, 35)], 10).cast("double").alias("rule_score"),
        choose([(churned, "no_shipment_6_months"), (days > 90, "no_shipment_3_months"),
                (collapsed, "volume_collapsed_70pct"), (drop >= 0.30, drop_text),
                (days.between(45, 90), "shipment_gap_45_90d"), (halved, "shipment_frequency_halved")],
               "no_stress_signals").alias("rule_reason"),
        F.when(days < NO_DATE_DAYS, days).alias("rule_days_silent"),
        tidy_round(drop * 100, 1).alias("rule_vol_drop_pct"),
    )


def series_features(snapshots: DataFrame) -> DataFrame:
    """Per relationship: mean, variation, slope, share of zero months, recent against first months."""
    s = series_position(snapshots)
    agg = s.groupBy("rel_id").agg(
        F.avg("qty").alias("mean_qty"), F.stddev_samp("qty").alias("_sd"),
        F.regr_slope("qty", F.col("i").cast("double")).alias("_slope"),
        F.avg((F.col("qty") == 0).cast("double")).alias("zero_frac"),
        F.avg(F.when(F.col("from_end") <= 3, F.col("qty"))).alias("_last"),
        F.avg(F.when(F.col("i") < 6, F.col("qty"))).alias("_first"),
        F.count(F.lit(1)).alias("n_months"))
    return agg.select(
        "rel_id", "mean_qty",
        F.when(F.col("mean_qty") > 0, F.coalesce("_sd", F.lit(0.0)) / F.col("mean_qty")).otherwise(0.0).alias("cv_qty"),
        F.when(F.col("n_months") >= 3, F.round(F.coalesce("_slope", F.lit(0.0)), 9)).otherwise(0.0).alias("slope"),
        "zero_frac",
        F.when(F.col("_first") > 0, F.col("_last") / F.col("_first")).otherwise(1.0).alias("recent_vs_baseline"),
        "n_months")


def anomaly_statistical(features: DataFrame) -> DataFrame:
    """Adds anomaly_score in 0..1 from the drop, the variation and the share of empty months."""
    raw = (1.0 - F.col("recent_vs_baseline")) * 0.5 + F.col("cv_qty") * 0.3 + F.col("zero_frac") * 0.2
    return features.withColumn("anomaly_score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)))


def health_status(scored: DataFrame) -> DataFrame:
    """Trend, health 0..100 and status from features with an anomaly_score."""
    a, rvb, slope = F.col("anomaly_score"), F.col("recent_vs_baseline"), F.col("slope")
    health = 100 - a * 60 - F.when(a > 0.7, 20).otherwise(0)
    bounded = scored.withColumn("_h", F.greatest(F.lit(0.0), F.least(F.lit(100.0), health)))
    h = F.col("_h")
    return bounded.select(
        "rel_id", tidy_round(a, 4).alias("anomaly_score"),
        choose([(rvb < 0.20, "collapsed"), (slope < -0.1, "declining"), (slope > 0.1, "growing")],
               "stable").alias("trend_direction"),
        tidy_round(h, 1).alias("health_score"),
        choose([(h >= 70, "healthy"), (h >= 40, "stressed"), (h >= 20, "dormant")], "churned").alias("health_status"))


def stress_reason(health: DataFrame, rels: DataFrame, as_of) -> DataFrame:
    """Why a model-detected relationship is in trouble; the shipment date outranks the trend."""
    joined = health.join(rels.select("rel_id", "last_shipment_date"), "rel_id", "left")
    silent = days_silent(F.col("last_shipment_date"), as_of)
    return joined.select(*health.columns, choose([
        (F.col("health_status") == "churned", "churned"), (silent > 180, "long_gap"),
        (F.col("trend_direction") == "declining", "quantity_drop"),
        (F.col("trend_direction") == "collapsed", "long_gap")], "irregular").alias("stress_reason"))
