"""Typed views of the merchant warehouse over the driver's tables.

The two billing regions are one relation with a region column, so a plan scans it once. The methods
take date bounds where callers have them: they are put on the scanned column, which Parquet prunes by,
beside the bound that the caller states on the derived value.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import month_index
from .constants import fx_rates

TABLES = tuple("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split())

#: Columns and types of each view; checked on load.
SCHEMAS = {
    "merchants": "merchant_id bigint, merchant_uuid string, country string, email string, created_at timestamp_ntz",
    "sales": "merchant_id bigint, month string, sales_count bigint",
    "receipts": "merchant_id bigint, total_money bigint, currency string, receipt_date string",
    "subscriptions": "region string, subscription_id bigint, customer_id string, status string, mrr bigint, currency string,"
    " created_at bigint, cancelled_at bigint, deleted boolean",
    "customers": "region string, customer_id string, deleted boolean",
    "invoices": "region string, customer_id string, total bigint, amount_due bigint, amount_paid bigint, currency string,"
    " status string, date bigint, deleted boolean",
}


class SchemaMismatch(ValueError):
    pass


def checked(name: str, df: DataFrame) -> DataFrame:
    want = [tuple(c.strip().split(" ")) for c in SCHEMAS[name].split(",")]
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if got != want:
        raise SchemaMismatch(f"{name}: {got}; expected {want}")
    return df


def bounded(df: DataFrame, column: str, since: date | None, until: date | None) -> DataFrame:
    """Rows of [since, until) by literals on a plain column: these reach the Parquet reader."""
    if since:
        df = df.where(f"{column} >= TIMESTAMP_NTZ '{since} 00:00:00'")
    if until:
        df = df.where(f"{column} < TIMESTAMP_NTZ '{until} 00:00:00'")
    return df


def region_of(key: Column) -> Column:
    return F.when(key % 2 == 0, "EU").otherwise("UK")


def billing_id(key: Column) -> Column:
    """Text ids, some of them not numbers."""
    return F.when(key % 27 == 0, F.concat(F.lit("cb_"), key.cast("string"))).otherwise(key.cast("string"))


class Warehouse:
    #: How orders meet their lines where they aren't broadcast: only a task's orders are held, a few narrow columns of
    #: a quarter of the rows, where a sort would hold its lines too.
    orders_join = "shuffle_hash"

    def __init__(self, spark: SparkSession, sf_dir: str, broadcast_keys: int = 2_000_000):
        """broadcast_keys: order keys that a broadcast may hold, about 30 MB by default."""
        self.spark, self.sf_dir, self.broadcast_keys = spark, sf_dir, broadcast_keys

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def fx(self) -> DataFrame:
        """48 constant rows, so always broadcast."""
        return F.broadcast(fx_rates(self.spark))

    def merchants(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", "n_name")
        df = self.table("customer").select("c_custkey", "c_nationkey").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        key = F.col("c_custkey")
        country = F.when(F.col("c_nationkey") == 24, None).when(F.col("c_nationkey") == 23, "").otherwise(F.col("n_name"))
        created = F.expr(
            "TIMESTAMP_NTZ '1995-01-01 00:00:00' + make_ym_interval(0, INT(c_custkey % 72)) + make_dt_interval(INT(c_custkey % 28))"
        )
        return checked(
            "merchants",
            df.select(
                key.alias("merchant_id"),
                F.concat(F.lit("uuid-"), key.cast("string")).alias("merchant_uuid"),
                country.alias("country"),
                F.concat(F.lit("m"), key.cast("string"), F.lit("@example.com")).alias("email"),
                F.when(key % 97 != 0, created).alias("created_at"),
            ),
        )

    def order_lines(self, wanted: DataFrame | None = None) -> DataFrame:
        """(k, lines): the lines of each order; of at least the wanted ones if some are."""
        lines = self.table("lineitem").select(F.col("l_orderkey").alias("k"))
        if wanted is not None:
            few = wanted.count() <= self.broadcast_keys
            lines = lines.join(F.broadcast(wanted) if few else wanted.hint(self.orders_join), F.col("k") == F.col("wanted"), "left_semi")
        return lines.groupBy("k").agg(F.count(F.lit(1)).alias("lines"))

    def sold(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """(o_custkey, o_orderdate, lines) of each order with lines. They are counted by order before the join, so only counts meet orders.

        Bounds cut the orders first, and only their lines are counted: the keys are broadcast if they were
        counted to be few, so the lines of other orders never leave the scan. Else both sides are shuffled
        by the key once, which the count and the join then have in common.
        """
        orders = bounded(self.table("orders"), "o_orderdate", since, until).select("o_orderkey", "o_custkey", "o_orderdate")
        lines = self.order_lines(orders.select(F.col("o_orderkey").alias("wanted")) if since or until else None)
        return orders.hint(self.orders_join).join(lines, F.col("o_orderkey") == F.col("k")).select("o_custkey", "o_orderdate", "lines")

    def sales(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """Sales of a merchant in a month."""
        month = F.date_format("o_orderdate", "yyyy-MM")
        df = self.sold(since, until).groupBy(F.col("o_custkey").alias("merchant_id"), month.alias("month"))
        return checked("sales", df.agg(F.sum("lines").alias("sales_count")))

    def sale_months(self) -> DataFrame:
        """(merchant_id, m): the months of sales() by month_index(), without those of unknown date.

        Months are bits of a number for each five years, so a task holds about a row a merchant, where sales() holds one for each month.
        """
        m, bits = month_index(F.col("o_orderdate")), F.col("bits")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (m % 60).cast("int"))
        df = self.sold().groupBy(F.col("o_custkey").alias("merchant_id"), (m - m % 60).alias("first")).agg(F.bit_or(bit).alias("bits"))
        df = df.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(59)))).where(F.getbit(bits, F.col("i")) == 1)
        return df.select("merchant_id", (F.col("first") + F.col("i")).alias("m"))

    def receipts(self, since: date | None = None, until: date | None = None) -> DataFrame:
        code = F.substring("o_orderpriority", 1, 1)
        currency = F.when(code == "1", "EUR").when(code == "2", "USD").when(code == "3", "JPY").when(code == "5", "XXX")
        text = F.when(F.col("o_orderkey") % 101 == 0, "bad-date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        return checked(
            "receipts",
            bounded(self.table("orders"), "o_orderdate", since, until).select(
                F.col("o_custkey").alias("merchant_id"),
                F.round(F.col("o_totalprice") * 100).cast("long").alias("total_money"),
                currency.alias("currency"),
                text.alias("receipt_date"),
            ),
        )

    def subscriptions(self) -> DataFrame:
        k, cust = F.col("o_orderkey"), F.col("o_custkey")
        status = F.when(F.col("o_orderstatus") == "P", "active").when(F.col("o_orderstatus") == "F", "cancelled").otherwise("non_renewing")
        five = k % 5
        currency = F.when(five == 1, "USD").when(five == 2, "GBP").when(five == 3, "EUR").when(five == 4, "XXX")
        created = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
        return checked(
            "subscriptions",
            self.table("orders").select(
                region_of(cust).alias("region"),
                k.alias("subscription_id"),
                billing_id(cust).alias("customer_id"),
                status.alias("status"),
                F.round("o_totalprice").cast("long").alias("mrr"),
                currency.alias("currency"),
                created.alias("created_at"),
                F.when(F.col("o_orderstatus") == "F", created + (k % 20) * 86400).alias("cancelled_at"),
                (k % 53 == 0).alias("deleted"),
            ),
        )

    def customers(self) -> DataFrame:
        k = F.col("c_custkey")
        return checked(
            "customers", self.table("customer").select(region_of(k).alias("region"), billing_id(k).alias("customer_id"), (k % 41 == 0).alias("deleted"))
        )

    def invoices(self, since: date | None = None, until: date | None = None) -> DataFrame:
        lines = bounded(self.table("lineitem"), "l_shipdate", since, until)
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        df = lines.join(orders.hint(self.orders_join), F.col("l_orderkey") == F.col("o_orderkey"))
        total = F.round(F.col("l_extendedprice") * 100).cast("long")
        paid = F.when(F.col("l_returnflag") == "A", total).otherwise(F.lit(0))
        status = F.when(F.col("l_returnflag") == "A", "paid").when(F.col("l_returnflag") == "N", "payment_due").otherwise("voided")
        n = F.col("l_linenumber")
        return checked(
            "invoices",
            df.select(
                region_of(F.col("o_custkey")).alias("region"),
                billing_id(F.col("o_custkey")).alias("customer_id"),
                total.alias("total"),
                (total - paid).alias("amount_due"),
                paid.alias("amount_paid"),
                F.when(n == 2, "XXX").when(n == 4, "USD").when(n == 3, "EUR").alias("currency"),
                status.alias("status"),
                F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("date"),
                (F.col("l_orderkey") % 59 == 0).alias("deleted"),
            ),
        )

    def view(self, name: str) -> DataFrame:
        """A view by its name; quoted names with hyphens, as billing exports have them, select a region."""
        plain = name.strip('"`').lower()
        for region in ("eu", "uk"):
            for kind in ("subscriptions", "customers", "invoices"):
                if plain == f"billing-{region}-{kind}":
                    return getattr(self, kind)().where(F.col("region") == region.upper())
        return getattr(self, plain)()
