"""Sinks: a JSON document, quoted CSV, and an HTML table that spreadsheets open."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_document(document: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-row document as one line of JSON; null fields are kept."""
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in document.columns]), {"ignoreNullFields": "false"})
    document.select(whole.alias("value")).coalesce(1).write.mode(mode).text(path)


def read_document(spark: SparkSession, path: str, schema) -> DataFrame:
    """The document written before; no rows where there is none."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def write_csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Every field quoted, quotes doubled, a header in each part file; parts are written in parallel."""
    rows.write.mode(mode).csv(path, header=True, quoteAll=True, quote='"', escape='"', emptyValue="", nullValue="", lineSep="\n")


def csv_text(header: list[str], rows: list[tuple]) -> str:
    """A small report as one text with a byte-order mark, for a download."""
    cell = lambda v: '"' + ("" if v is None else str(v)).replace('"', '""') + '"'
    return "﻿" + "\n".join(",".join(map(cell, r)) for r in [header, *rows])


def table_html(header: list[str], rows: list[tuple]) -> str:
    """A small report as an HTML table."""
    cells = lambda tag, r: "".join(f"<{tag}>{html.escape('' if v is None else str(v), quote=False)}</{tag}>" for v in r)
    body = "".join(f"<tr>{cells('td', r)}</tr>" for r in rows)
    return f"<html><body><table><thead><tr>{cells('th', header)}</tr></thead><tbody>{body}</tbody></table></body></html>"
