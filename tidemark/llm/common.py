"""Shared parts of the corpus operators: word tables, row identity, checkpoints, components."""

from __future__ import annotations

import random
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import cut
from ..operators.lineage import shared_folder as ensure_checkpoint_dir

#: Bytes of a word that is `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z; every other byte
#: becomes a space. Bytes from 0x80 belong to words, so the rule holds on UTF-8 as on code points.
ALNUM_LOWER = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: The same rule as a Java regular expression for the gaps between words of a lower-cased text.
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Lower-cases A-Z alone.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes of the rows that a Python function gets at once; what it makes of them, as words or pieces, is many times as large.
BATCH_BYTES = 1 << 20


__all__ = [
    "across_labels", "ALNUM_LOWER", "LOWER_ASCII", "NOT_ALNUM", "alnum_words", "arrow_map", "connected_components", "cut", "ensure_checkpoint_dir",
    "free_name", "in_blocks", "modest", "remove", "ship", "sliced", "text_key", "texts",
]


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a UTF-8 text."""
    return text.translate(ALNUM_LOWER).split()


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A column of texts as UTF-8 bytes; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not use, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ours in the shared folder, once nothing reads it any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def modest(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """df for a join: broadcast if it was counted to have at most so many rows, else as it is. df: short rows, checkpointed."""
    return F.broadcast(df) if df.count() <= rows else df


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for a context, as --py-files would."""
    sc, package = spark.sparkContext, Path(__file__).resolve().parent.parent
    if getattr(sc, "_tidemark_shipped", False) or not package.is_dir():
        return
    path = f"{tempfile.mkdtemp(prefix='tidemark-package-')}/{package.name}.zip"  # of the driver, which serves it
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for f in sorted(package.rglob("*.py")):
            out.write(f, f.relative_to(package.parent))
    sc.addPyFile(path)
    sc._tidemark_shipped = True


def sliced(batches: Iterator[pa.RecordBatch], most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes, or a row: Spark bounds a batch by its rows alone, whatever they hold."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def arrow_map(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow() with this package at hand in the workers, over batches of bounded bytes."""
    ship(df.sparkSession)
    return df.mapInArrow(lambda batches: run(sliced(batches)), schema)


def text_key(text: Column) -> Column:
    """64-bit key of a text; with doc_id it names a row. Rows alike in both are repeats of one row and get one result."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def connected_components(edges: DataFrame, seed: int = 20) -> DataFrame:
    """Components of an undirected graph by randomised contraction.

    edges: two long columns a and b. Returns (node, component), component being the least node
    reachable; nodes without an edge to another node do not occur.

    In each round every node merges into the least of its closed neighbourhood under an order that
    changes by round (XOR with a random word, a bijection), so chains shrink by a constant factor a
    round. Neighbourhood minima are partially aggregated, and both relabelling joins have a
    checkpointed table on either side, so a node with very many edges is split by the skew join.
    Nothing is gathered on the driver but one count a round.
    """
    rng = random.Random(seed)
    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    nodes = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
    labels = cut(nodes.select("node", F.col("node").alias("at")))
    while not e.isEmpty():
        mask = F.lit(rng.getrandbits(63) - rng.getrandbits(63))
        both = e.select("a", "b").union(e.select("b", "a"))
        to = both.groupBy("a").agg(F.min(F.col("b").bitwiseXOR(mask)).alias("m"))
        to = cut(to.select(F.col("a").alias("from_node"), F.least(F.col("a").bitwiseXOR(mask), "m").bitwiseXOR(mask).alias("to")))
        x, y = to.toDF("xa", "x"), to.toDF("yb", "y")
        e = e.join(x, F.col("a") == F.col("xa")).join(y, F.col("b") == F.col("yb"))
        e = cut(e.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
        labels = cut(
            labels.join(to, F.col("at") == F.col("from_node"), "left").select("node", F.coalesce("to", "at").alias("at"))
        )
    least = cut(labels.groupBy("at").agg(F.min("node").alias("component")).withColumnRenamed("at", "of"))
    return labels.join(least, F.col("at") == F.col("of")).select("node", "component")


def in_blocks(rows: DataFrame, key: str, salt: Column, block: int) -> DataFrame:
    """rows with p and q: rows of one key that share p and q make a group of about 2 * block rows at most.

    A key of up to `block` rows is one group (0, 0). The rows of a larger one are dealt into blocks by
    salt, and every pair of blocks is a group, so that any two rows of a key meet in one group at least.
    """
    large = cut(rows.groupBy(key).agg(F.count(F.lit(1)).alias("in_all")).where(F.col("in_all") > block))
    if large.isEmpty():
        return rows.withColumns({"p": F.lit(0), "q": F.lit(0)})
    small = rows.join(large, key, "left_anti").withColumns({"p": F.lit(0), "q": F.lit(0)})
    dealt = rows.join(large, key).withColumn("blocks", F.ceil(F.col("in_all") / block).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(salt, F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")})
    return small.unionByName(dealt.drop("in_all", "blocks", "own", "other"))


def across_labels(rows: DataFrame, key: str, salt: Column, block: int) -> DataFrame:
    """rows (key, label, ...) with p and q: any two rows of a key but those of its largest label meet in one group (key, p, q).

    A key of up to `block` rows is one group. In a larger one the rows of its largest label are dealt into blocks by salt, and
    so are all others; each block of others meets every block, so few others cost few groups, however many rows there are.
    """
    large = cut(rows.groupBy(F.col(key).alias("of_key")).agg(F.count(F.lit(1)).alias("in_all")).where(F.col("in_all") > block))
    if large.isEmpty():
        return rows.withColumns({"p": F.lit(0), "q": F.lit(0)})
    labels = rows.join(modest(large), F.col(key) == F.col("of_key")).groupBy("of_key", "in_all", "label").agg(F.count(F.lit(1)).alias("n"))
    top = labels.groupBy("of_key", "in_all").agg(F.max(F.struct("n", "label")).alias("top"))
    blocks = lambda n: F.ceil(n / block).cast("int")
    sizes = cut(top.select("of_key", F.col("top.label").alias("most"), blocks(F.col("top.n")).alias("ps"), blocks(F.col("in_all") - F.col("top.n")).alias("qs")))
    small = rows.join(modest(sizes), F.col(key) == F.col("of_key"), "left_anti").withColumns({"p": F.lit(0), "q": F.lit(0)})
    dealt = rows.join(modest(sizes.where("qs > 0")), F.col(key) == F.col("of_key"))
    first = F.col("label") == F.col("most")
    own = F.when(first, F.pmod(salt, "ps")).otherwise(F.col("ps") + F.pmod(salt, "qs")).cast("int")
    others = F.explode(F.sequence(F.when(first, F.col("ps")).otherwise(0), F.col("ps") + F.col("qs") - 1))
    dealt = dealt.withColumn("own", own).withColumn("other", others).withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")})
    return small.unionByName(dealt.drop("of_key", "most", "ps", "qs", "own", "other"))
