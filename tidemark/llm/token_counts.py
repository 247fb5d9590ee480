"""Token counts of flat token files by separator scan.

A flat file is a run of little-endian token ids without an index; an end-of-document id closes each
document. Blocks of a file are searched for the id by vectorised comparison. A block knows how many
separators it holds and how its tokens fall between them; a prefix sum of the separators over the
blocks of a file gives each piece the number of its document, so pieces of a document that were cut
at a block's bounds meet again under one number.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, cut, ensure_checkpoint_dir, remove

BLOCKS = "file string, block long, ids binary"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; s3a is the name that Hadoop has for s3."""
    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))


def read_token_files(spark: SparkSession, path: str, width: int = 2, block_tokens: int = 1 << 16, task_bytes: int = 32 << 20) -> DataFrame:
    """Flat files under path as rows (file, block, ids). Files are listed with their lengths; tasks then read
    ranges of whole tokens, so a file may be of any size and is read by many tasks."""
    step = block_tokens * width
    files = spark.read.format("binaryFile").load(path).select("path", "length")  # contents aren't read
    total = files.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    starts = F.posexplode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(step))).alias("block", "at")
    ranges = files.where("length > 0").select("path", "length", starts).repartition(tasks, "path", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, length, block, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if length % width:
                    raise ValueError(f"{name}: {length} bytes aren't whole tokens of {width} bytes")
                system, inner = file_system(name)
                with system.open_input_file(inner) as f:
                    ids = f.read_at(min(step, length - at), at)
                part = [pa.array([name]), pa.array([block], pa.int64()), pa.array([ids], pa.binary())]
                yield pa.RecordBatch.from_arrays(part, names=["file", "block", "ids"])

    return arrow_map(ranges, run, BLOCKS)


def count_tokens(blocks: DataFrame, eod: int, width: int = 2) -> DataFrame:
    """(file, nth, n_tokens, closed): the tokens of every document of flat files, separators not counted.

    blocks: file, block (0, 1, ... within a file) and ids (bytes of `width` bytes a token; null is
    empty). nth counts the documents of a file from 0. closed is false for tokens at the end of a file
    that no separator follows; an empty rest is no document. A block row that is repeated counts once.
    Files without tokens give no rows. The prefix sum runs in two levels, over groups of 1,024 blocks
    and within them, so no task sees all blocks of a file at once.
    """
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = []
            for ids in batch.column(2).to_pylist():
                tokens = np.frombuffer(ids or b"", kind)
                at = np.flatnonzero(tokens == eod)
                pieces.append(np.diff(np.concatenate(([-1], at, [len(tokens)]))) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(pieces, pa.list_(pa.int64()))], names=["file", "block", "pieces"]
            )

    found = arrow_map(blocks.select("file", "block", "ids"), run, "file string, block long, pieces array<long>")
    found = cut(found.dropDuplicates(["file", "block"]))
    seps = found.select("file", "block", F.floor(F.col("block") / 1024).alias("part"), (F.size("pieces") - 1).cast("long").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = seps.groupBy("file", "part").agg(F.sum("n").alias("n"))
    parts = parts.select("file", "part", before(Window.partitionBy("file").orderBy("part")).alias("start"))
    starts = seps.select("file", "block", "part", before(Window.partitionBy("file", "part").orderBy("block")).alias("inner"))
    starts = starts.join(parts, ["file", "part"]).select("file", "block", (F.col("start") + F.col("inner")).alias("start"))
    pieces = found.join(starts, ["file", "block"]).select("file", "start", F.size("pieces").alias("k"), F.posexplode("pieces"))
    return (
        pieces.groupBy("file", (F.col("start") + F.col("pos")).alias("nth"))
        .agg(F.sum("col").alias("n_tokens"), F.max(F.col("pos") < F.col("k") - 1).alias("closed"))
        .where("closed or n_tokens > 0")
    )


def write_token_stream(docs: DataFrame, ranks: bytes, pattern: str, eod: int, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encodes docs into flat files, one for each partition, and returns the folder written.

    The folder lies in spark.checkpoint.dir. ids/ has the files of little-endian 16-bit ids, each document
    followed by eod; order/ has, as Parquet, the order of the documents in them (file, nth, doc_id). A
    task that is run again writes a file of another name, and order names those of the tasks that counted.
    ranks: the bytes of a tiktoken file. Null texts are empty documents.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-stream-{uuid.uuid4().hex}"
    order = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(shared, pattern).encode_ordinary, TaskContext.get()
        name, out, nth = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.bin", None, 0
        system, folder = file_system(f"{path}/ids")
        for batch in batches:
            if out is None:
                system.create_dir(folder, recursive=True)
                out = system.open_output_stream(f"{folder}/{name}", buffer_size=1 << 20)
            for text in batch.column(1):
                got = encode(text.as_py() or "")
                got.append(eod)
                out.write(np.array(got, "<u2").tobytes())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(range(nth, nth + n), pa.int64()), batch.column(0)], names=["file", "nth", "doc_id"])
            nth += n
        if out is not None:
            out.close()

    arrow_map(order, run, "file string, nth long, doc_id long").write.parquet(f"{path}/order")
    return path


def count_document_tokens(docs: DataFrame, ranks: bytes, pattern: str, eod: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every row of docs, counted in the flat files that the rows are encoded to.

    Null ids and repeated rows stay: every row is a document of the files. Null and empty texts have
    0 tokens. The text of the separator in a document is ordinary text and never taken for it. An empty
    table gives an empty one; other columns are not read. The files are deleted once all is counted.
    """
    spark = docs.sparkSession
    path = write_token_stream(docs, ranks, pattern, eod, id_col, text_col)
    order = spark.read.parquet(f"{path}/order")
    if order.isEmpty():
        return order.select("doc_id", F.lit(0).cast("long").alias("n_tokens"))
    named = F.substring_index("file", "/", -1)
    counts = count_tokens(read_token_files(spark, f"{path}/ids"), eod).withColumn("file", named)
    found = order.join(counts, ["file", "nth"], "left").select("doc_id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))
    found = cut(found)
    remove(spark, path)
    return found


_ENCODERS: dict = {}


def encoder(shared, pattern: str):
    """The worker's own tiktoken encoding of broadcast ranks, kept from task to task."""
    import tiktoken

    key = (hash(shared.value), pattern)
    if key not in _ENCODERS:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        _ENCODERS[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]
