"""The large facts kept for several queries: bucketed by order key for good, or held for one run."""

from __future__ import annotations

from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .warehouse import Warehouse

#: The key by which each fact is bucketed.
FACTS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}


def write_bucketed(wh: Warehouse, prefix: str, buckets: int = 200) -> None:
    """Writes the facts as tables <prefix>_<name>, in buckets of the order key, each by one task and sorted.

    Queries that meet lines and orders by that key then read them as they lie: lineitem is shuffled here
    once, and not by every caller of sales() and invoices().
    """
    for name, key in FACTS.items():
        rows = wh.table(name).repartition(buckets, key)
        rows.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(f"{prefix}_{name}")


class BucketedWarehouse(Warehouse):
    """The same views over the tables of write_bucketed(), which are sorted by the order key, so they are merged."""

    orders_join = "merge"

    def __init__(self, spark: SparkSession, sf_dir: str, prefix: str, **options):
        super().__init__(spark, sf_dir, **options)
        self.prefix = prefix

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.prefix}_{name}") if name in FACTS else super().table(name)


class HeldWarehouse(Warehouse):
    """The same views, with what they take from lineitem computed once and held until release(), on disk where memory is short.

    Lines are held as counts by order and as invoices; bounds are put on these, so a run of many queries
    scans lineitem twice. Blocks of lost executors are computed anew.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, **options):
        super().__init__(spark, sf_dir, **options)
        self._held: dict[str, DataFrame] = {}

    def _hold(self, name: str, make) -> DataFrame:
        if name not in self._held:
            self._held[name] = make().persist(StorageLevel.MEMORY_AND_DISK)
        return self._held[name]

    def release(self) -> None:
        for df in self._held.values():
            df.unpersist()
        self._held.clear()

    def __enter__(self) -> HeldWarehouse:
        return self

    def __exit__(self, *_) -> None:
        self.release()

    def order_lines(self, wanted: DataFrame | None = None) -> DataFrame:
        return self._hold("order_lines", super().order_lines)

    def invoices(self, since: date | None = None, until: date | None = None) -> DataFrame:
        rows = self._hold("invoices", super().invoices)
        at = lambda d: F.unix_seconds(F.expr(f"TIMESTAMP_NTZ '{d} 00:00:00'").cast("timestamp"))
        if since:
            rows = rows.where(F.col("date") >= at(since))
        if until:
            rows = rows.where(F.col("date") < at(until))
        return rows


__all__ = ["BucketedWarehouse", "HeldWarehouse", "write_bucketed"]
