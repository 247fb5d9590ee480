"""The catalog of a folder of tables: names, columns, row counts and sample rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .constants import quoted
from .warehouse import TABLES

_EMPTY = "table_name string, column_name string, data_type string, nullable boolean, position long"


def tables(spark: SparkSession, sf_dir: str) -> list[str]:
    """Names of the Parquet tables under a path that Spark can list."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(fs_path)]
    return sorted(n.removesuffix(".parquet") for n in names if n.endswith(".parquet"))


def catalog_columns(spark: SparkSession, sf_dir: str, only: tuple[str, ...] | None = None) -> DataFrame:
    """A row for each column. Only schemas are read. A table that can't be read gives no rows."""
    rows = []
    for name in only or tables(spark, sf_dir):
        schema = contained(lambda n=name: spark.read.parquet(f"{sf_dir}/{n}.parquet").schema)
        rows += [(name, f.name, f.dataType.simpleString(), f.nullable, i) for i, f in enumerate(schema or [])]
    if not rows:
        return spark.createDataFrame([], _EMPTY)
    body = ", ".join("(" + ", ".join(quoted(v) for v in r) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {body} AS t(table_name, column_name, data_type, nullable, position)")
    return df.withColumn("position", F.col("position").cast("long"))


def contained(f: Callable):
    """f(), or None where Spark refuses: one bad table doesn't stop a walk over the others."""
    from pyspark.errors import PySparkException

    try:
        return f()
    except PySparkException:
        return None


def catalog_row_counts(spark: SparkSession, sf_dir: str, only: tuple[str, ...] = TABLES) -> DataFrame:
    """(table_name, n_rows); counts come from Parquet footers, no column is read."""
    one = [spark.read.parquet(f"{sf_dir}/{t}.parquet").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t in only]
    return reduce(DataFrame.unionByName, one)


def catalog_sample(spark: SparkSession, sf_dir: str, name: str, rows: int = 3) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(rows)


def catalog_namespaces(spark: SparkSession, hidden: tuple[str, ...] = ("information_schema",)) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases() if d.name.lower() not in hidden)


def namespaces(spark: SparkSession, sf_dir: str = "") -> DataFrame:
    """(namespace) of the session's catalog."""
    return spark.createDataFrame([(n,) for n in catalog_namespaces(spark)], "namespace string")


def sample_variants(spark: SparkSession, sf_dir: str, only: tuple[str, ...] = TABLES, rows: int = 3) -> DataFrame:
    """(table_name, nth, row): the first rows of each table by all its columns (nulls first), of unlike schemas in one VARIANT."""
    one = []
    for t in only:
        df = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        order = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns]
        first = df.orderBy(*order).limit(rows)  # each task leaves so many rows, whatever the table's size
        nth = F.row_number().over(Window.partitionBy().orderBy(*order)).cast("long")
        own = F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
        one.append(first.select(F.lit(t).alias("table_name"), nth.alias("nth"), own.alias("row")))
    return reduce(DataFrame.unionByName, one)


def catalog_samples(spark: SparkSession, sf_dir: str, only: tuple[str, ...] = TABLES, rows: int = 3) -> DataFrame:
    """(table_name, nth, column_name, number, text): a row for each value of the sample rows; of arrays the number of entries."""
    found = sample_variants(spark, sf_dir, only, rows).lateralJoin(spark.tvf.variant_explode(F.col("row").outer()))
    kind, whole = F.schema_of_variant("value"), lambda t: F.variant_get("value", "$", t)
    number = F.when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), whole("double")).when(kind.startswith("ARRAY"), F.size(whole("array<variant>")).cast("double"))
    text = F.when(kind.startswith("TIMESTAMP"), F.date_format(whole("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")).when(number.isNull(), whole("string"))
    return found.select("table_name", "nth", F.col("key").alias("column_name"), number.alias("number"), text.alias("text"))


def catalog_sizes(spark: SparkSession, sf_dir: str, only: tuple[str, ...] = TABLES) -> DataFrame:
    """(table_name, n_files, n_rows, n_bytes) of the tables' files that have rows.

    Tasks read the files' footers: the rows that they count have no column, and the sizes come with the files.
    """
    one = []
    for t in only:
        files = spark.read.parquet(f"{sf_dir}/{t}.parquet").groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("size"))
        sums = [F.count(F.lit(1)).alias("n_files"), *[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(f"n_{n}") for c, n in (("rows", "rows"), ("size", "bytes"))]]
        one.append(files.agg(*sums).select(F.lit(t).alias("table_name"), "n_files", "n_rows", "n_bytes"))
    return reduce(DataFrame.unionByName, one)


def register_views(spark: SparkSession, sf_dir: str, only: tuple[str, ...] = TABLES) -> None:
    """Temporary views of the driver's tables, for SQL by name."""
    for t in only:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
