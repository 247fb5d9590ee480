"""The market-sizing model: total, serviceable and obtainable market by country under two scenarios."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import coded, count_text, exact_sum, fixed, money_text, ratio
from ..sources.constants import CONTINENTS, INFORMAL_SCALE, PROVIDERS, TIER_COLUMNS, TIERS, values
from ..sources.planning import market_countries
from ..sources.warehouse import Warehouse

MEASURES = ("formal", "informal_firms", "firms", "tam_gtv", "tam_tpv", "tam_rev", "sam_gtv", "sam_tpv", "sam_rev", "sam_firms", "som_gtv", "som_tpv", "som_rev", "som_firms")


@dataclass(frozen=True)
class Model:
    """Fees as fractions, the served-volume cap in USD thousand, and the penetration. The defaults are ours."""

    gtv_fee: float = 0.002
    tpv_fee: float = 0.005
    cap: float = 1000.0
    penetration: float = 0.01


def market_rows(wh: Warehouse, model: Model = Model(), scenario: str = "c", countries: DataFrame | None = None) -> DataFrame:
    """The measures of each country. Scenario 'c' counts formal firms only, 'e' a share of the informal ones too."""
    return _sized(market_countries(wh) if countries is None else countries, F.lit(scenario), model, wh)


def _sized(countries: DataFrame, scenario, model: Model, wh: Warehouse) -> DataFrame:
    types = {"tier": "string"}
    tiers = values(wh.spark, TIERS, ", ".join(("t_" + c if c == "tier" else c) for c in TIER_COLUMNS))
    tiers = tiers.select(*[F.col(c).cast(types.get(c.removeprefix("t_"), "double")).alias(c) for c in tiers.columns])
    df = countries.join(F.broadcast(tiers), F.col("tier") == F.col("t_tier")).withColumn("scenario", scenario)
    c, cap = F.col, F.lit(model.cap)
    df = df.withColumn("informal_firms", F.when(c("scenario") == "c", 0.0).otherwise(c("informal") * INFORMAL_SCALE))
    scale = min(model.cap / 1000, 1.5)
    share = lambda q: F.least(F.lit(1.0), c(q) * scale)
    least = lambda q: F.least(c(q), cap)
    df = df.withColumns(
        {
            "formal": c("micro") + c("small") + c("medium"),
            "tam_gtv": c("micro") * c("gp_m") + c("small") * c("gp_s") + c("medium") * c("gp_d") + c("informal_firms") * c("gp_i"),
            "sam_gtv": c("micro") * least("cap_m")
            + c("small") * share("q_s") * least("cap_s")
            + c("medium") * share("q_d") * least("cap_d")
            + c("informal_firms") * least("gp_i"),
            "sam_firms": c("micro") + c("small") * share("q_s") + c("medium") * share("q_d") + c("informal_firms"),
        }
    )
    df = df.withColumns({"firms": c("formal") + c("informal_firms"), "tam_tpv": c("tam_gtv") * c("digital_share"), "sam_tpv": c("sam_gtv") * c("digital_share")})
    fees = lambda k: c(f"{k}_gtv") * model.gtv_fee + c(f"{k}_tpv") * model.tpv_fee
    df = df.withColumns({"tam_rev": fees("tam"), "sam_rev": fees("sam")})
    df = df.withColumns({f"som_{k}": F.when(c("served"), c(f"sam_{k}")).otherwise(0.0) for k in ("gtv", "tpv", "rev", "firms")})
    keep = ("name", "continent", "served", "tier", "psp", "source", "digital_share", "micro", "small", "medium", "informal", "scenario")
    return df.select(*keep, *MEASURES)


def market_totals(wh: Warehouse, model: Model = Model(), scenario: str = "c", countries: DataFrame | None = None) -> DataFrame:
    """One row: sums of all measures, and what the penetration makes of the obtainable market."""
    df = market_rows(wh, model, scenario, countries).agg(*[exact_sum(F.col(m)).alias(m) for m in MEASURES])
    p = model.penetration
    return df.select(
        *MEASURES,
        (F.col("som_rev") * p).alias("penetrated_rev"),
        (F.col("som_gtv") * model.gtv_fee * p).alias("penetrated_gtv_fee"),
        (F.col("som_tpv") * model.tpv_fee * p).alias("penetrated_tpv_fee"),
    )


def _continent_order(continent):
    return F.array_position(F.array(*[F.lit(x) for x in CONTINENTS]), continent).cast("long")


def market_by_continent(wh: Warehouse, model: Model = Model(), scenario: str = "c", countries: DataFrame | None = None) -> DataFrame:
    """Sums by continent in fixed order; continents beyond the order are left out."""
    keep = ("formal", "informal_firms", "tam_gtv", "tam_tpv", "tam_rev", "sam_rev", "som_rev")
    df = market_rows(wh, model, scenario, countries).groupBy("continent").agg(*[exact_sum(F.col(m)).alias(m) for m in keep])
    df = df.withColumn("position", _continent_order(F.col("continent"))).where("position > 0")
    return df.select("continent", "position", *keep, count_text(F.col("formal")).alias("formal_text"), money_text(F.col("tam_gtv")).alias("tam_gtv_text")).orderBy("position")


def market_drilldown(wh: Warehouse, model: Model = Model(), scenario: str = "c", countries: DataFrame | None = None) -> DataFrame:
    """Continents with subtotals and their countries, from one aggregate over grouping sets."""
    keep = ("micro", "small", "medium", "informal_firms", "tam_gtv", "tam_tpv", "tam_rev", "sam_gtv", "sam_rev", "som_rev")
    rows = market_rows(wh, model, scenario, countries)
    df = rows.groupingSets([[F.col("continent")], [F.col("continent"), F.col("name")]], "continent", "name")
    df = df.agg(F.grouping("name").cast("int").alias("g"), *[exact_sum(F.col(m)).alias(m) for m in keep])
    df = df.withColumn("position", _continent_order(F.col("continent"))).where("position > 0")
    return df.select("continent", "name", (F.col("g") == 1).alias("is_subtotal"), *keep).orderBy("continent", F.desc("is_subtotal"), "name")


COMPARED = (
    ("Total firms", "firms", 1.0),
    ("TAM GTV", "tam_gtv", 1.0),
    ("TAM revenue potential", "tam_rev", 1.0),
    ("SAM revenue potential", "sam_rev", 1.0),
    ("SOM revenue potential", "som_rev", 1.0),
    ("Penetrated revenue", "som_rev", None),
)


def market_scenarios(wh: Warehouse, model: Model = Model(), countries: DataFrame | None = None) -> DataFrame:
    """Both scenarios side by side: six metrics with absolute and relative difference, from one plan over the countries."""
    countries = market_countries(wh) if countries is None else countries
    both = _sized(countries, F.explode(F.array(F.lit("c"), F.lit("e"))), model, wh)
    names = dict.fromkeys(m for _, m, _ in COMPARED)
    one = both.agg(*[exact_sum(F.when(F.col("scenario") == s, F.col(m))).alias(f"{m}_{s}") for m in names for s in ("c", "e")])
    rows = []
    for i, (label, m, factor) in enumerate(COMPARED):
        f = model.penetration if factor is None else factor
        a, b = F.col(f"{m}_c") * f, F.col(f"{m}_e") * f
        rows.append(
            F.struct(
                F.lit(i + 1).cast("long").alias("position"),
                F.lit(label).alias("metric"),
                a.alias("conservative"),
                b.alias("expansive"),
                (b - a).alias("difference"),
                (ratio(b, a) - 1).alias("relative"),
            )
        )
    return one.select(F.inline(F.array(*rows))).orderBy("position")


#: Columns of the country table by number; 0 doesn't sort.
SORTS = (None, "continent", "tier", "formal", "informal_firms", "tam_gtv", "tam_tpv", "tam_rev", "sam_rev", "som_rev", "digital_share")


def filtered(rows: DataFrame, continent: str | None = None, served: bool | None = None, psp: list[str] | None = None, contains: str | None = None) -> DataFrame:
    """Filters that are set, all of them; contains is found in any case."""
    if continent:
        rows = rows.where(F.col("continent") == continent)
    if served is not None:
        rows = rows.where(F.col("served") == served)
    if psp:
        rows = rows.where(F.col("psp").isin(*psp))
    if contains:
        rows = rows.where(F.contains(F.lower("name"), F.lit(contains.lower())))
    return rows


#: Order of texts: letters before their accents, accents before case, as readers of most languages expect.
COLLATION = "UNICODE"


def sort_keys(rows: DataFrame, column: int, descending: bool) -> list:
    """Sort keys of a column number: null is below all, texts go by COLLATION, ties by name. None for column 0."""
    name = SORTS[column]
    if name is None:
        return []
    key = F.collate(name, COLLATION) if isinstance(rows.schema[name].dataType, T.StringType) else F.col(name)
    return [key.desc_nulls_last() if descending else key.asc_nulls_first(), F.collate("name", COLLATION), F.col("name")]


def sorted_by(rows: DataFrame, column: int = 7, descending: bool = True) -> DataFrame:
    """Rows by a column number; null is below all, texts sort by COLLATION, ties by name."""
    keys = sort_keys(rows, column, descending)
    return rows.orderBy(*keys) if keys else rows


def market_country_table(wh: Warehouse, model: Model = Model(), scenario: str = "c", column: int = 7, descending: bool = True, **filters) -> DataFrame:
    return sorted_by(filtered(market_rows(wh, model, scenario), **filters), column, descending)


#: Headings of the exported table.
EXPORT = ("Country", "Continent", "Served", "Tier", "Formal SMBs", "Informal SMBs", "GTV TAM", "TPV TAM", "Revenue TAM", "Revenue SAM", "Revenue SOM", "Digital %", "PSP", "SMB Source")


def market_export(wh: Warehouse, model: Model = Model(), scenario: str = "c", **table) -> DataFrame:
    """The country table as texts for a file: whole numbers, informal firms only in scenario 'e', labels for codes."""
    df = market_country_table(wh, model, scenario, **table)
    whole = lambda c: F.floor(F.col(c) + 0.5).cast("long").cast("string")
    informal = whole("informal_firms") if scenario == "e" else F.lit("")
    cols = [
        F.col("name"),
        F.col("continent"),
        F.when(F.col("served"), "Yes").otherwise("No"),
        F.col("tier"),
        whole("formal"),
        informal,
        *[whole(c) for c in ("tam_gtv", "tam_tpv", "tam_rev", "sam_rev", "som_rev")],
        F.concat(fixed(F.col("digital_share") * 100, 1), F.lit("%")),
        coded(F.col("psp"), PROVIDERS, F.col("psp")),
        F.col("source"),
    ]
    return df.select(*[c.alias(n) for c, n in zip(cols, EXPORT, strict=True)])


__all__ = ["Model", "market_by_continent", "market_country_table", "market_drilldown", "market_export", "market_rows", "market_scenarios", "market_totals"]
