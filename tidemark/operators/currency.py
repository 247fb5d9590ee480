"""Joins to the exchange rates. The three policies for unknown currencies differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Currency that a null stands for, by billing region.
REGION_DEFAULT = (("EU", "EUR"), ("UK", "GBP"))


def region_default(region: Column) -> Column:
    out = F.lit("EUR")
    for name, currency in REGION_DEFAULT:
        out = F.when(region == name, currency).otherwise(out)
    return out


def with_rates(rows: DataFrame, fx: DataFrame, default: Column | str = "EUR", how: str = "left", currency: str = "currency") -> DataFrame:
    """rows with rate, per_cent and per_minor of coalesce(currency, default).

    how='inner' drops rows of unknown currencies; 'left' keeps them with null rates, so that sums skip
    them and counts don't. Callers that take unknown currencies at par coalesce the rate to 1.
    """
    asked = F.coalesce(F.col(currency), default if isinstance(default, Column) else F.lit(default))
    rates = fx.select(F.col("currency").alias("fx_currency"), "rate", "per_cent", "per_minor")
    return rows.join(rates, asked == F.col("fx_currency"), how).drop("fx_currency")


def money(amount: Column | str, factor: Column | str) -> Column:
    """An exact amount: whole units times an exact factor, DECIMAL(37,12)."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return amount.cast("decimal(18,0)") * (F.col(factor) if isinstance(factor, str) else factor)
