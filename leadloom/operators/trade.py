"""Trade relationships and their monthly series.

A relationship is one (buyer, supplier, product code). All per-relationship windows run on
the monthly table (at most ``months`` rows per relationship), never on raw shipments, so a
relationship that holds a third of all shipments is reduced map-side before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.functions.ids import stable_id
from leadloom.functions.rank import best_row
from leadloom.functions.skew import grid_join
from leadloom.functions.values import as_ts, choose, norm, text, tidy_round
from leadloom.session import staged

# Accepted source names of each shipment column, most wanted first.
SHIPMENT_ALIASES = {
    "buyer_id": ["importer_id", "buyer_id", "consignee_id", "companyid"],
    "buyer_name": ["importer_name", "buyer_name", "consignee_name", "company_name"],
    "supplier_id": ["exporter_id", "supplier_id", "shipper_id"],
    "supplier_name": ["exporter_name", "supplier_name", "shipper_name"],
    "hs_code": ["hs_code", "hscode", "matched_hs_code", "commodity_code"],
    "quantity": ["quantity", "net_weight", "gross_weight", "total_weight", "weight_kg"],
    "value": ["shipment_value", "total_value", "trade_value", "fob_value", "cif_value", "amount"],
    "ship_date": ["shipment_date", "bl_date", "date", "arrival_date", "departure_date", "created_at"],
}
SHIPMENT_TYPES = {"quantity": "double", "value": "double", "ship_date": "timestamp"}
SHIPMENT_REQUIRED = ("buyer_id", "supplier_id", "hs_code", "ship_date")

BASELINE_MONTHS = 6
PRIORITY = {"shipment_bl": 1, "import_partner": 2, "bsl_crossmatch": 3}


def _month_id(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM-dd")


def monthly_trade(shipments: DataFrame, as_of, months: int = 36) -> DataFrame:
    """Per relationship and calendar month: shipment count, quantity, value, names, last day.

    Rows with a null or blank key, or older than ``months`` before ``as_of``, are left out;
    null quantities and values count as 0. Names are an attribute, not part of the key.
    """
    keys = ["buyer_id", "supplier_id", "hs_code"]
    rows = shipments.where(F.col("ship_date") >= as_ts(as_of) - F.make_ym_interval(months=F.lit(months)))
    rows = rows.withColumns({k: F.trim(F.col(k).cast("string")) for k in keys})
    for key in keys:
        rows = rows.where(F.col(key) != "")
    monthly = rows.groupBy(*keys, F.trunc(F.col("ship_date").cast("date"), "month").alias("year_month")).agg(
        F.min(F.nullif(F.col("buyer_name"), F.lit(""))).alias("buyer_name"),
        F.min(F.nullif(F.col("supplier_name"), F.lit(""))).alias("supplier_name"),
        F.count(F.lit(1)).alias("shipment_count"),
        F.sum(F.coalesce(F.col("quantity"), F.lit(0.0))).alias("total_quantity"),
        F.sum(F.coalesce(F.col("value"), F.lit(0.0))).alias("total_value"),
        F.max(F.col("ship_date").cast("date")).alias("last_shipment_date"),
    )
    return monthly.select(stable_id(*keys).alias("rel_id"), *monthly.columns)


def with_baseline(monthly: DataFrame) -> DataFrame:
    """Month rows with ``baseline_qty`` / ``baseline_value``: means over the first 6 months present.

    One window on rel_id; the later groupBy(rel_id) reuses its partitioning.
    """
    by_rel = Window.partitionBy("rel_id")
    in_base = F.col("month_no") <= BASELINE_MONTHS
    return (
        monthly.withColumn("month_no", F.row_number().over(by_rel.orderBy("year_month")))
        .withColumn("baseline_qty", F.avg(F.when(in_base, F.col("total_quantity"))).over(by_rel))
        .withColumn("baseline_value", F.avg(F.when(in_base, F.col("total_value"))).over(by_rel))
    )


def trade_baseline(monthly: DataFrame) -> DataFrame:
    """Per relationship the baseline quantity and value, and how many months went in."""
    return with_baseline(monthly).where(F.col("month_no") <= BASELINE_MONTHS).groupBy("rel_id").agg(
        F.avg("total_quantity").alias("baseline_avg_qty"),
        F.avg("total_value").alias("baseline_avg_value"),
        F.count(F.lit(1)).alias("baseline_months"),
    )


def trade_relationships(monthly: DataFrame) -> DataFrame:
    """One row per relationship: names, chapter, totals, age in months, baseline, last date."""
    def first_name(col: str) -> Column:
        return F.coalesce(F.min_by(col, F.when(F.col(col).isNotNull(), F.col("year_month"))), F.lit(""))

    grouped = with_baseline(monthly).groupBy("rel_id", "buyer_id", "supplier_id", "hs_code").agg(
        first_name("buyer_name").alias("buyer_name"),
        first_name("supplier_name").alias("supplier_name"),
        F.sum("shipment_count").alias("total_shipments"),
        F.count(F.lit(1)).alias("relationship_age_months"),
        F.max("baseline_qty").alias("baseline_avg_qty"),
        F.max("baseline_value").alias("baseline_avg_value"),
        F.max("last_shipment_date").alias("last_shipment_date"),
        F.max("year_month").alias("last_month"),
    )
    return grouped.withColumns({
        "hs_chapter": F.substring("hs_code", 1, 2),
        "data_source": F.lit("shipment_bl"),
    })


def trade_snapshots(monthly: DataFrame) -> DataFrame:
    """One row per relationship and month with the change against baseline in percent."""
    base = F.col("baseline_qty")
    return with_baseline(monthly).select(
        stable_id(F.col("rel_id"), _month_id(F.col("year_month"))).alias("snapshot_id"),
        "rel_id", "year_month", "shipment_count", "total_quantity", "total_value",
        F.when(base > 0, tidy_round((F.col("total_quantity") / base - 1.0) * 100, 2))
        .otherwise(F.lit(0.0)).alias("qty_vs_baseline_pct"),
    )


def _months_30(later: Column, earlier: Column) -> Column:
    return F.floor(F.datediff(later, earlier) / 30).cast("long")


def relationships_from_partners(partners: DataFrame, imported: DataFrame, companies: DataFrame,
                                as_of, min_share: float = 0.5) -> DataFrame:
    """Relationships estimated from a buyer's partner list and the codes it imports.

    Partner x code of the same buyer (equi join on the company, code share >= ``min_share``),
    the buyer's own list row adds dates and counts. Monthly volume = kg * share / 100 / 12;
    age = max(1, 30-day months). Per relationship the row with the largest code share wins.
    """
    today = as_ts(as_of).cast("date")
    codes = imported.where((F.col("import_share_pct") >= min_share) & F.col("hs_code").isNotNull()).select(
        F.col("company_id"), F.col("hs_code"), F.col("import_share_pct").alias("hs_share"))
    buyers = companies.where(norm("company_role") == "buyer").select(
        "company_id", "from_date", "to_date", "number_of_shipments")
    buyers = best_row(buyers, ["company_id"], [F.col("to_date")])
    joined = partners.join(codes, "company_id").join(buyers, "company_id", "left")
    rows = joined.select(
        F.trim("company_id").alias("buyer_id"), text("company_name").alias("buyer_name"),
        F.trim("partner_company_id").alias("supplier_id"),
        text("partner_company_name").alias("supplier_name"),
        F.trim("hs_code").alias("hs_code"), "hs_share",
        F.coalesce("trade_volume_kg", F.lit(0.0)).alias("_kg"),
        "from_date", "to_date", F.coalesce("number_of_shipments", F.lit(0)).cast("long").alias("total_shipments"),
    ).where((F.col("buyer_id") != "") & (F.col("supplier_id") != "") & (F.col("hs_code") != ""))
    best = best_row(rows, ["buyer_id", "supplier_id", "hs_code"], [F.col("hs_share"), F.col("_kg")])
    end = F.coalesce("to_date", today)
    return best.select(
        stable_id("buyer_id", "supplier_id", "hs_code").alias("rel_id"),
        "buyer_id", "buyer_name", "supplier_id", "supplier_name", "hs_code",
        F.substring("hs_code", 1, 2).alias("hs_chapter"), "total_shipments",
        F.greatest(F.lit(1), F.coalesce(_months_30(end, F.col("from_date")), F.lit(0))).alias("relationship_age_months"),
        tidy_round(F.col("_kg") * F.col("hs_share") / 100 / 12, 2).alias("baseline_avg_qty"),
        F.lit(0.0).alias("baseline_avg_value"),
        F.coalesce("to_date", F.date_sub(today, 180)).alias("last_shipment_date"),
        F.lit("import_partner").alias("data_source"), "from_date", "to_date",
    )


def synthetic_months(rels: DataFrame, as_of) -> DataFrame:
    """Month rows between from_date and to_date of estimated relationships, thinning at the end.

    Below 6 remaining 30-day months the volume is scaled by ``max(.1, 1 - remaining/total * .3)``.
    """
    end = F.coalesce("to_date", as_ts(as_of).cast("date"))
    spans = rels.where(F.col("from_date").isNotNull()).withColumn("_end", end)
    spans = spans.withColumn("_total", _months_30(F.col("_end"), F.col("from_date"))).where(
        (F.col("_total") > 0) & (F.col("from_date") <= F.col("_end")))
    months = spans.select("rel_id", "baseline_avg_qty", "_end", "_total", F.explode(F.sequence(
        F.trunc("from_date", "month"), F.trunc("_end", "month"), F.expr("interval 1 month"))).alias("year_month"))
    left = _months_30(F.col("_end"), F.col("year_month"))
    factor = F.when(left < 6, F.greatest(F.lit(0.1), 1.0 - (left / F.col("_total")) * 0.3)).otherwise(1.0)
    months = months.withColumn("total_quantity", tidy_round(F.col("baseline_avg_qty") * factor, 2))
    return months.select(
        stable_id(F.col("rel_id"), _month_id(F.col("year_month"))).alias("snapshot_id"),
        "rel_id", "year_month",
        F.when(F.col("total_quantity") > 0,
               F.greatest(F.lit(1), F.floor(F.col("total_quantity") / 1000))).otherwise(0).cast("long").alias("shipment_count"),
        "total_quantity", F.lit(0.0).alias("total_value"), F.lit(0.0).alias("qty_vs_baseline_pct"),
    )


def relationships_from_codes(companies: DataFrame, imported: DataFrame, exported: DataFrame,
                             as_of, min_share: float = 1.0) -> DataFrame:
    """Possible relationships: buyer and supplier whose import and export codes agree.

    The result itself holds every such pair, so its size is the join's size. How many buyers and
    suppliers a code has decides into how many parts it is cut (``grid_join``).
    """
    today = as_ts(as_of).cast("date")
    buyers = best_row(companies.where(norm("company_role") == "buyer").select(
        "company_id", "company_name", "number_of_shipments", "shipment_value", "from_date", "to_date"),
        ["company_id"], [F.col("to_date")])
    sellers = best_row(companies.where(norm("company_role") == "supplier").select(
        "company_id", "company_name"), ["company_id"], [])
    demand = buyers.join(imported.where(F.col("import_share_pct") >= min_share).groupBy("company_id", "hs_code").agg(
        F.max("import_share_pct").alias("hs_share")), "company_id").select(
        F.trim("company_id").alias("buyer_id"), text("company_name").alias("buyer_name"), "hs_code", "hs_share",
        "number_of_shipments", "shipment_value", "from_date", "to_date")
    supply = sellers.join(exported.where(F.col("export_share_pct") >= min_share).select(
        "company_id", "hs_code").distinct(), "company_id").select(
        F.trim("company_id").alias("supplier_id"), text("company_name").alias("supplier_name"), "hs_code")
    pairs = grid_join(staged(demand, "demand"), staged(supply, "supply"), ["hs_code"], spread=(["buyer_id"], ["supplier_id"]))
    pairs = pairs.where(F.col("buyer_id") != F.col("supplier_id"))
    pairs = pairs.where((F.col("buyer_id") != "") & (F.col("supplier_id") != "") & (F.trim("hs_code") != ""))
    end = F.coalesce("to_date", today)
    return pairs.select(
        stable_id(F.col("buyer_id"), F.col("supplier_id"), F.trim("hs_code")).alias("rel_id"),
        "buyer_id", "buyer_name", "supplier_id", "supplier_name", F.trim("hs_code").alias("hs_code"),
        F.substring(F.trim("hs_code"), 1, 2).alias("hs_chapter"),
        F.coalesce("number_of_shipments", F.lit(0)).cast("long").alias("total_shipments"),
        F.greatest(F.lit(1), F.coalesce(_months_30(end, F.col("from_date")), F.lit(0))).alias("relationship_age_months"),
        tidy_round(F.coalesce("shipment_value", F.lit(0.0)) * F.col("hs_share") / 100 / 12, 2).alias("baseline_avg_qty"),
        F.lit(0.0).alias("baseline_avg_value"),
        F.coalesce("to_date", F.date_sub(today, 365)).alias("last_shipment_date"),
        F.lit("bsl_crossmatch").alias("data_source"),
    )


UNION_COLUMNS = ("rel_id", "buyer_id", "buyer_name", "supplier_id", "supplier_name", "hs_code", "hs_chapter",
                 "total_shipments", "relationship_age_months", "baseline_avg_qty", "baseline_avg_value",
                 "last_shipment_date", "data_source")


def union_trade_sources(*sources: DataFrame, last_writer: bool = False) -> DataFrame:
    """Relationships of all sources, one per rel_id: shipments before partners before code matches.

    ``last_writer=True`` reverses the order of preference.
    """
    rows = None
    for source in sources:
        part = source.select(*UNION_COLUMNS)
        rows = part if rows is None else rows.unionByName(part)
    place = choose([(F.col("data_source") == s, n) for s, n in PRIORITY.items()], 9)
    return best_row(rows, ["rel_id"], [place if last_writer else -place])


def apply_external_health(rels: DataFrame, external: DataFrame) -> DataFrame:
    """Health from an outside report: fills a missing score, and lowers one not set by hand.

    ``rels`` needs health_score and score_override. Several report rows of one pair: the lowest.
    """
    report = external.where(
        F.col("trade_relationship_health").isNotNull() & F.col("supplier_id").isNotNull()
        & F.col("buyer_id").isNotNull())
    report = best_row(report.select(
        "supplier_id", "buyer_id", F.col("trade_relationship_health").cast("double").alias("external_health_score"),
        F.coalesce("total_shipment_count", F.lit(0)).cast("long").alias("external_shipment_count"),
        text("shipment_trend").alias("external_shipment_trend")),
        ["supplier_id", "buyer_id"], [-F.col("external_health_score")])
    joined = rels.join(report, ["supplier_id", "buyer_id"], "left")
    worse = (F.col("external_health_score") < F.col("health_score")) & ~F.coalesce("score_override", F.lit(False))
    return joined.withColumn("health_score", F.when(
        F.col("health_score").isNull() | worse, F.coalesce("external_health_score", "health_score"),
    ).otherwise(F.col("health_score")))
