"""Countries: volume, merchants and weights; and data-quality reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import parsed_date, percent, ratio, rounded
from ..operators.currency import money, with_rates
from ..operators.ranking import top
from ..sources.params import DIAGNOSTICS_FLOOR, AsOf
from ..sources.warehouse import Warehouse
from .headline import day

NONEMPTY = "country IS NOT NULL AND country <> ''"


def recent_receipts(wh: Warehouse, as_of: AsOf) -> DataFrame:
    since = as_of.month_before
    return wh.receipts(since=since).where(parsed_date(F.col("receipt_date")) >= day(since))


def merchant_gtv(wh: Warehouse, as_of: AsOf) -> DataFrame:
    """Volume by merchant, summed before it meets the merchants."""
    return with_rates(recent_receipts(wh, as_of), wh.fx()).groupBy("merchant_id").agg(F.sum(money("total_money", "per_minor")).alias("eur"))


def markets(wh: Warehouse, as_of: AsOf = AsOf(), most: int = 10) -> DataFrame:
    """The countries with most merchants. The average is over all of a country's merchants."""
    df = wh.merchants().where(NONEMPTY).join(merchant_gtv(wh, as_of), "merchant_id", "left")
    df = df.groupBy("country").agg(F.sum("eur").cast("double").alias("eur"), F.count(F.lit(1)).alias("merchant_count"))
    gtv = F.coalesce(F.col("eur") / 1e6, F.lit(0.0))
    df = df.select(
        "country", F.lit("").alias("flag_emoji"), gtv.alias("gtv_millions"), "merchant_count", ratio(gtv, F.col("merchant_count")).alias("avg_gtv_per_merchant")
    )
    return top(df, most, F.desc("merchant_count"), F.col("country"))


def gtv_by_market(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    """Volume and merchants with receipts by country, null and empty countries included."""
    df = wh.merchants().select("merchant_id", "country").join(merchant_gtv(wh, as_of), "merchant_id")
    df = df.groupBy("country").agg(rounded(F.sum("eur").cast("double") / 1e6, 1).alias("gtv_millions"), F.count(F.lit(1)).alias("merchant_count"))
    return df.orderBy(F.desc_nulls_last("gtv_millions"), F.asc_nulls_last("country"))


def country_weights(wh: Warehouse, as_of: AsOf = AsOf(), most: int = 30) -> DataFrame:
    """Share of all merchants, those without a country included in the total; counted in one scan."""
    df = wh.merchants().groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    df = df.withColumn("total", F.sum("n").over(Window.partitionBy()))  # a row for each country
    df = df.where(NONEMPTY).select(F.col("country").alias("country_code"), percent(F.col("n"), F.col("total"), 2).alias("weight"))
    return top(df, most, F.desc("weight"), F.col("country_code"))


def diagnostics(wh: Warehouse, as_of: AsOf = AsOf(), floor: str = DIAGNOSTICS_FLOOR) -> DataFrame:
    """Rows and merchants by month, raw sums by currency, and the count of receipts without a currency."""
    row = lambda source, period, rows, metric: (
        F.lit(source).alias("source"),
        period.alias("period"),
        rows.cast("long").alias("row_count"),
        metric.cast("double").alias("metric_value"),
    )
    one = F.count(F.lit(1))
    since = date.fromisoformat(f"{floor}-01")
    # Sales are a row a merchant and month, so a count of merchants is one of distinct ones.
    sales = wh.sales(since=since).where(F.col("month") >= floor).groupBy("month").agg(one.alias("n"), F.count("merchant_id").alias("u"))
    # One scan gives the sums by currency; the totals are sums of those few rows.
    money_rows = recent_receipts(wh, as_of).groupBy("currency").agg(one.alias("n"), F.sum("total_money").alias("raw"))
    nulls = money_rows.agg(F.sum(F.when(F.col("currency").isNull(), F.col("n")).otherwise(0)).alias("nn"), F.sum("n").alias("n"))
    df = sales.select(*row("active_users", F.col("month"), F.col("n"), F.col("u")))
    df = df.unionByName(money_rows.select(*row("gtv_currency", F.coalesce("currency", F.lit("NULL")), F.col("n"), F.col("raw"))))
    df = df.unionByName(nulls.select(*row("gtv_null_pct", F.lit("null_vs_total"), F.coalesce("nn", F.lit(0)), F.coalesce("n", F.lit(0)))))
    return df.orderBy("source", F.desc("metric_value"), "period")


def _eu(wh: Warehouse, **bounds) -> DataFrame:
    return wh.invoices(**bounds).where((F.col("region") == "EU") & F.col("status").isin("paid", "payment_due") & ~F.col("deleted"))


def revenue_diag(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    """One row on the EU invoices, in raw hundredths."""
    start, stop = (F.unix_seconds(day(d).cast("timestamp")) for d in (as_of.year_start, as_of.next_year))
    now = (F.col("date") >= start) & (F.col("date") < stop)
    stamp = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    return _eu(wh).agg(
        F.lit("eu_invoices").alias("source"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(now).alias("current_year_rows"),
        F.sum(F.when(now, F.col("total")).otherwise(0)).cast("long").alias("current_year_amount"),
        stamp(F.min("date")).alias("min_date"),
        stamp(F.max("date")).alias("max_date"),
    )


def revenue_sample(wh: Warehouse, as_of: AsOf = AsOf(), most: int = 5) -> DataFrame:
    """The newest EU invoices of the year; ties by amount and the other columns."""
    start, stop = (F.unix_seconds(day(d).cast("timestamp")) for d in (as_of.year_start, as_of.next_year))
    rows = _eu(wh, since=as_of.year_start, until=as_of.next_year).where((F.col("date") >= start) & (F.col("date") < stop))
    rows = rows.select(
        "amount_due", "amount_paid", "total", F.col("currency").alias("currency_code"), "status", F.timestamp_seconds("date").cast("timestamp_ntz").alias("invoice_date")
    )
    return top(rows, most, F.desc("invoice_date"), F.desc("total"), F.asc("amount_due"), F.asc_nulls_last("currency_code"))
