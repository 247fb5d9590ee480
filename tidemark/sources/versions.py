"""Versions of a document in a folder: written whole, published at once, read back by the next run.

A run claims a number, writes its files under it and then publishes it by creating one empty marker, which every file
system does at once or not at all. Readers see published versions only, the newest first, so a run that dies leaves
nothing that is read, and two runs at a time get numbers of their own.
"""

from __future__ import annotations

import logging

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import write_document

log = logging.getLogger(__name__)
_BROKEN = "_broken"


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _named(self, folder: str) -> list[int]:
        where = self._path(f"{self.root}/{folder}")
        names = [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []
        return sorted((int(n) for n in names if n.isdigit()), reverse=True)

    def _create(self, name: str) -> bool:
        """Makes an empty file; False if there is one."""
        where = self._path(f"{self.root}/{name}")
        self._fs.mkdirs(where.getParent())
        return self._fs.createNewFile(where)

    def published(self) -> list[int]:
        """Numbers of the published versions, the newest first."""
        return self._named("published")

    def publish(self, document: DataFrame) -> int:
        """Writes a one-row document as the next version. It can be read once it is whole."""
        number = max([0, *self._named("claimed")]) + 1
        while not self._create(f"claimed/{number}"):
            number += 1
        write_document(document, self.path(number))
        self._create(f"published/{number}")
        return number

    def path(self, number: int) -> str:
        return f"{self.root}/versions/{number}"

    def read(self, number: int, known: T.StructType | None = None) -> DataFrame | None:
        """A version, or None if it is not one whole document. Fields of known have its types, others those they show."""
        try:
            found = self.spark.read.json(self.path(number)).schema
            kinds = {f.name: f for f in (known.fields if known else ())}
            if set(found.names) <= {"_corrupt_record"}:
                log.warning("version %s is broken", number)
                return None
            schema = T.StructType([kinds.get(f.name, f) for f in found.fields if f.name != "_corrupt_record"]).add(_BROKEN, T.StringType())
            document = self.spark.read.schema(schema).option("columnNameOfCorruptRecord", _BROKEN).json(self.path(number))
            whole = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields[:-1]])))  # all fields are parsed
            marks = [r[0] for r in document.select(_BROKEN, whole).take(2)]
        except PySparkException as e:
            log.warning("version %s can't be read: %s", number, str(e).splitlines()[0])
            return None
        if marks != [None]:
            log.warning("version %s is broken", number)
            return None
        return document.drop(_BROKEN)

    def latest(self, known: T.StructType | None = None) -> DataFrame | None:
        """The newest published version that is whole; older ones stand in for broken ones, and None for none."""
        for number in self.published():
            document = self.read(number, known)
            if document is not None:
                return document
        return None

    def prune(self, keep: int = 10) -> None:
        """Deletes all but the newest published versions, the markers first."""
        for number in self.published()[keep:]:
            self._fs.delete(self._path(f"{self.root}/published/{number}"), False)
            self._fs.delete(self._path(self.path(number)), True)


__all__ = ["Versions"]
