"""The dashboard's document as rows, its summary as lines, and the paths that stand in for missing results."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import fixed
from ..operators.lineage import shared_folder
from ..sources.params import AsOf
from ..sources.versions import Versions
from ..sources.warehouse import Warehouse
from . import cohorts as C
from . import market_model, postprocess

#: What names an entry of a section; sections that aren't here have one entry.
KEYS = {
    "funnel": ("key",),
    "cohort_vintages": ("month",),
    "cohort_aging": ("cohort_month", "age_months"),
    "top_markets": ("country",),
    "revenue_projection": ("year",),
    "gtv_projection": ("year",),
    "diagnostics": ("source", "period"),
    "revenue_diag": ("source",),
    "revenue_sample": ("invoice_date", "total"),
    "cohort_curve": ("month",),
    "region_countries": ("region",),
}


def _cell(section: str, key: Column, metric: str, value: Column, kind: T.DataType) -> Column:
    number = isinstance(kind, T.NumericType)
    return F.struct(
        F.lit(section).alias("section"),
        key.alias("key"),
        F.lit(metric).alias("metric"),
        (value.cast("double") if number else F.lit(None).cast("double")).alias("number"),
        (F.lit(None).cast("string") if number else value.cast("string")).alias("text"),
    )


def _by_month(values: Column, months: Column, metric: str, kind: T.DataType) -> Column:
    return F.transform(values, lambda v, i: _cell("monthly", F.get(months, i), metric, v, kind))


def _entries(entries: Column, section: str, fields: list[T.StructField]) -> Column:
    keys = KEYS[section]

    def cells(x: Column) -> Column:
        key = F.concat_ws("|", *[x[k].cast("string") for k in keys])
        return F.array(*[_cell(section, key, f.name, x[f.name], f.dataType) for f in fields if f.name not in keys])

    return F.flatten(F.transform(entries, cells))


def _single(values: Column, section: str, kind: T.DataType) -> Column:
    return F.transform(values, lambda x: _cell(section, x.cast("string"), section, x, kind))


def _weights(weights: Column, section: str, kind: T.DataType) -> Column:
    return F.transform(F.map_entries(weights), lambda x: _cell(section, x["key"], "weight", x["value"], kind))


def document_rows(document: DataFrame) -> DataFrame:
    """(section, key, metric, number, text): a row for each value of a nested document of one row."""
    cells = []
    none = F.lit("")
    for f in document.schema.fields:
        kind, col = f.dataType, F.col(f.name)
        if f.name == "monthly":
            for series in kind.fields:
                for measure in () if series.name == "months" else series.dataType.fields:
                    values = col[series.name][measure.name]
                    name, of = f"{series.name}_{measure.name}", measure.dataType.elementType
                    cells.append(_by_month(values, col["months"], name, of))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            cells.append(_entries(col, f.name, kind.elementType.fields))
        elif isinstance(kind, T.ArrayType):
            cells.append(_single(col, f.name, kind.elementType))
        elif isinstance(kind, T.MapType):
            cells.append(_weights(col, f.name, kind.valueType))
        elif isinstance(kind, T.StructType):
            cells.append(F.array(*[_cell(f.name, none, g.name, col[g.name], g.dataType) for g in kind.fields]))
        else:
            cells.append(F.array(_cell(f.name, none, f.name, col, kind)))
    return document.select(F.inline(F.concat(*cells)))


def reviewed(wh: Warehouse) -> DataFrame:
    """One row: a first document, of sections that no daily query makes (reviews, countries of a region) and a period of its own."""
    reviews = wh.table("labels").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("quality") == 1).alias("good"))
    nation = wh.table("nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("countries"))
    regions = wh.table("region").join(nation, F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("r_name").alias("region"), "countries")
    regions = regions.agg(F.array_sort(F.collect_list(F.struct("region", "countries"))).alias("region_countries"))
    return reviews.select(F.struct("total", "good").alias("reviews")).crossJoin(regions).withColumn("period", F.lit("Q1 1999"))


def run(wh: Warehouse, versions: Versions, as_of: AsOf = AsOf(), results: dict[str, DataFrame] | None = None) -> int:
    """A daily run: the document over the newest one that is whole, published as the next version, whose number is returned."""
    made = postprocess.dashboard_document(wh, as_of, results)
    before = versions.latest(made.schema)
    return versions.publish(made if before is None else postprocess.dashboard_document(wh, as_of, results, previous=before))


def dashboard_document(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    """The rows of the second of two runs' documents, with the sections that only the first one's file holds."""
    root = f"{shared_folder(wh.spark).rstrip('/')}/documents-{uuid.uuid4().hex}"
    versions = Versions(wh.spark, root)
    versions.publish(reviewed(wh))
    made = postprocess.dashboard_document(wh, as_of)
    return document_rows(versions.read(run(wh, versions, as_of), made.schema))


def agg_map_weights(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    """The entries of the map of weights."""
    from .markets import country_weights

    return postprocess.weights_map(country_weights(wh, as_of)).select(F.explode("country_weights").alias("country_code", "weight"))


def funnel_fallback(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    """The funnel from the repaired KPIs alone."""
    return postprocess.funnel_fallback(postprocess.kpi_repaired(wh, as_of))


def market_filtered_sorted(wh: Warehouse, column: int = 3, descending: bool = False, **filters) -> DataFrame:
    """The country table under filters, with each row's place in the order; a report, so one window over it does."""
    rows = market_model.filtered(market_model.market_rows(wh), **(filters or {"served": True, "psp": ["P", "B"], "contains": "a"}))
    order = market_model.sort_keys(rows, column, descending)
    return rows.select("name", "continent", "psp", "formal", "tam_rev", F.row_number().over(Window.partitionBy().orderBy(*order)).cast("long").alias("place"))


def market_sorted_texts(wh: Warehouse) -> DataFrame:
    """All countries in the order of their continents' names, the last first, and of their own names."""
    return market_filtered_sorted(wh, column=1, descending=True, contains="")


def console_summary(wh: Warehouse, as_of: AsOf = AsOf()) -> DataFrame:
    """(position, line): the run's summary, one line a figure."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    complete = postprocess.incomplete_months(wh, as_of)
    one = postprocess.kpi_repaired(wh, as_of, complete=complete)
    one = one.crossJoin(count(postprocess.cohort_vintages(wh, as_of), "vintages")).crossJoin(count(C.unified_merchant(wh, as_of), "unified"))
    one = one.crossJoin(count(C.cohort_aging(wh, as_of), "aging")).crossJoin(complete.agg(F.count("revenue_actual").alias("filled")))
    one = one.crossJoin(count(postprocess.top_markets_flagged(wh, as_of), "top_markets"))
    whole = lambda c: F.format_number(F.col(c).cast("double"), 0)
    lines = (
        ("dataStatus", F.lit("ACTUAL")),
        ("lastUpdated", F.lit(str(as_of.day))),
        ("totalRevenue", F.concat(F.lit("€"), fixed(F.col("total_revenue"), 2), F.lit("M"))),
        ("activeUsers", whole("active_users")),
        ("registered", whole("registered")),
        ("paying", whole("paying")),
        ("ARPC", F.concat(F.lit("€"), fixed(F.col("arpc"), 2), F.lit("/mo"))),
        ("Monthly churn", F.concat(fixed(F.col("monthly_churn"), 1), F.lit("%"))),
        ("Cohort vintages", F.col("vintages").cast("string")),
        ("Unified merch", F.concat(F.col("unified").cast("string"), F.lit(" rows"))),
        ("Cohort aging", F.concat(F.col("aging").cast("string"), F.lit(" rows"))),
        ("Top markets", F.col("top_markets").cast("string")),
        ("Monthly actuals", F.concat(F.col("filled").cast("string"), F.lit("/12 months filled"))),
    )
    rows = [F.struct(F.lit(i + 1).cast("long").alias("position"), F.concat(F.rpad(F.lit(f"{n}:"), 17, " "), v).alias("line")) for i, (n, v) in enumerate(lines)]
    return one.select(F.inline(F.array(*rows)))


__all__ = ["agg_map_weights", "console_summary", "dashboard_document", "document_rows", "funnel_fallback", "market_filtered_sorted", "market_sorted_texts", "reviewed", "run"]
