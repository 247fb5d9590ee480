"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every benchmark item gives patterns: its windows of `window` consecutive words, or the whole item
where it has fewer. Patterns of one length are searched together: a shift table over blocks of two
words says how far the search may jump when a block ends at the current word, buckets by suffix
block and prefix block select the patterns that may end there, and a direct comparison confirms.

The patterns are the stated query set. They are packed into blocks of about `block_words` words, in
pieces of at most `chunk_words + window - 1` words whatever the length of an item. If one block holds
them all, the documents stream through one map, without a shuffle. Else each block is broadcast by
itself for a pass of its own, whose few hits are written out before the next block is read; so one
block at most is in memory at a time, on the driver and in each task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import alnum_words, arrow_map, cut, ensure_checkpoint_dir, free_name, modest, remove, texts

#: Gaps between words before lower-casing.
_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A piece of an item: its id, the piece's words and the words of the whole item.
Piece = tuple[str, list[bytes], int]


class WuManber:
    """Patterns of one length in words."""

    def __init__(self, length: int):
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}

    def add(self, item: str, words: list[bytes], start: int) -> None:
        """The pattern words[start : start + length] of an item."""
        m, two = self.length, self.block == 2
        for end in range(start + self.block - 1, start + m):
            key = (words[end - 1], words[end]) if two else words[end]
            left = start + m - 1 - end
            if left < self.shift.get(key, self.default):
                self.shift[key] = left
        last = start + m - 1
        suffix, prefix = ((words[last - 1], words[last]), (words[start], words[start + 1])) if two else (words[last], words[start])
        self.buckets.setdefault(suffix, {}).setdefault(prefix, []).append((words, start, item))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, str]]:
        """(start, item) of every occurrence, from left to right."""
        m, n, default, shift, buckets = self.length, len(words), self.default, self.shift.get, self.buckets
        two = self.block == 2
        i = m - 1
        while i < n:
            key = (words[i - 1], words[i]) if two else words[i]
            jump = shift(key, default)
            if jump:
                i += jump
                continue
            at = i - m + 1
            prefix = (words[at], words[at + 1]) if two else words[at]
            here = words[at : i + 1]
            for piece, start, item in buckets[key].get(prefix, ()):
                if piece[start : start + m] == here:
                    yield at, item
            i += 1


def compile_patterns(pieces: list[Piece], window: int) -> list[WuManber]:
    """A machine for each pattern length, the shortest first."""
    machines: dict[int, WuManber] = {}
    for item, words, total in pieces:
        m = min(window, total)
        if m:
            machine = machines.setdefault(m, WuManber(m))
            for start in range(len(words) - m + 1):
                machine.add(item, words, start)
    return [machines[m] for m in sorted(machines)]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans, overlapping or touching ones joined."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def find(words: list[bytes], machines: list[WuManber]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged spans of words inside occurrences, and the items that occur."""
    spans: list[tuple[int, int]] = []
    items: set[str] = set()
    for machine in machines:
        for at, item in machine.search(words):
            items.add(item)
            if not spans or spans[-1] != (at, at + machine.length):
                spans.append((at, at + machine.length))
    return merge(spans), items


def _pieces(benchmark: DataFrame, window: int, chunk_words: int, item_col: str, text_col: str) -> DataFrame:
    words = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), _GAPS), lambda x: x != "")
    return (
        benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), words.alias("w"))
        .select("item", F.size("w").alias("total"), "w")
        .where("total > 0")
        .select("item", "total", "w", F.explode(F.sequence(F.lit(0), F.col("total") - 1, F.lit(chunk_words))).alias("at"))
        .select("item", "total", F.slice("w", F.col("at") + 1, chunk_words + window - 1).alias("piece"))
    )


RESULT = (
    ("n_words", T.LongType(), pa.int64()),
    ("n_hit", T.LongType(), pa.int64()),
    ("items", T.ArrayType(T.StringType()), pa.list_(pa.string())),
    ("contaminated", T.BooleanType(), pa.bool_()),
)


def _judged(batch: pa.RecordBatch, keep: list[str], rows: list[tuple[int, list[tuple[int, int]], set[str]]]) -> pa.RecordBatch:
    """The columns to keep and the verdict on (number of words, merged spans, items) of every row."""
    hit = [sum(e - s for s, e in spans) for _, spans, _ in rows]
    n_words = [n for n, _, _ in rows]
    values = (n_words, hit, [sorted(x) for _, _, x in rows], [h > 0 and 20 * h >= n for h, n in zip(hit, n_words, strict=True)])
    arrays = [pa.array(v, kind) for v, (_, _, kind) in zip(values, RESULT, strict=True)]
    own = [batch.column(batch.schema.get_field_index(c)) for c in keep]
    return pa.RecordBatch.from_arrays([*own, *arrays], names=[*keep, *(n for n, _, _ in RESULT)])


def _scan(shared, window: int, text_col: str, keep: list[str]):
    """Search and verdict in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines = compile_patterns(shared.value, window)
        for batch in batches:
            yield _judged(batch, keep, [(len(w), *find(w, machines)) for w in map(alnum_words, texts(batch, text_col))])

    return run


def _hits(shared, window: int):
    """(h1, h2, spans, items) of the texts that one block's patterns occur in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines = compile_patterns(shared.value, window)
        for batch in batches:
            found = [find(alnum_words(x), machines) for x in texts(batch)]
            at = [i for i, (spans, _) in enumerate(found) if spans]
            arrays = [batch.column(i).take(pa.array(at, pa.int64())) for i in (0, 1)]
            arrays.append(pa.array([[x for s in found[i][0] for x in s] for i in at], pa.list_(pa.int32())))
            arrays.append(pa.array([sorted(found[i][1]) for i in at], pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(arrays, names=["h1", "h2", "spans", "hit_items"])

    return run


def _judge(text_col: str, spans_col: str, items_col: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()  # noqa: B023, E731
            rows = []
            for text, flat, items in zip(texts(batch, text_col), column(spans_col), column(items_col), strict=True):
                flat = flat or []
                rows.append((len(alnum_words(text)), merge(list(zip(flat[::2], flat[1::2], strict=True))), set(items or ())))
            yield _judged(batch, keep, rows)

    return run


def _in_passes(docs: DataFrame, keyed: DataFrame, n_blocks: int, window: int, text_col: str) -> DataFrame:
    """docs with the spans and items that all blocks' passes found, each pass written out before the next begins."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/patterns-{uuid.uuid4().hex}"
    keyed.repartition("block").write.partitionBy("block").parquet(path)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    h1, h2 = F.xxhash64(text), F.xxhash64(F.lit(1), text)
    rows = docs.select(h1.alias("h1"), h2.alias("h2"), text.alias("text"))
    passes = []
    for b in range(n_blocks):
        shared = spark.sparkContext.broadcast(_block(spark.read.parquet(path).where(F.col("block") == b)))
        found = arrow_map(rows, _hits(shared, window), "h1 long, h2 long, spans array<int>, hit_items array<string>")
        passes.append(cut(found.dropDuplicates(["h1", "h2"])))
        shared.unpersist()
    remove(spark, path)
    found = reduce(DataFrame.union, passes).groupBy("h1", "h2")
    found = cut(found.agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("hit_items"))).alias("hit_items")))
    names = [free_name(docs, c) for c in ("h1", "h2", "spans", "hit_items")]
    found = modest(found.toDF(*names))
    out = docs.join(found, (h1 == F.col(names[0])) & (h2 == F.col(names[1])), "left").drop(*names[:2])
    return arrow_map(out, _judge(text_col, *names[2:], docs.columns), T.StructType(docs.schema.fields + [T.StructField(n, t) for n, t, _ in RESULT]))


def _block(pieces: DataFrame) -> list[Piece]:
    """One block's pieces on the driver: about block_words words."""
    return [(r.item, [w.encode().lower() for w in r.piece], r.total) for r in pieces.select("item", "piece", "total").collect()]


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    block_words: int = 200_000,
    chunk_words: int = 20_000,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """docs with n_words, n_hit (words inside an occurrence), items (sorted ids) and contaminated.

    A word is `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the whole text with A-Z lower-cased.
    contaminated: n_hit > 0 and 20 * n_hit >= n_words. Rows are not dropped; they are shuffled only if the
    benchmark has more than one block and more texts are hit than a broadcast may hold. Repeated rows are judged alike. A null or empty text has no words and no hits. Null item ids stand
    as 'null'; items alike in id are one item; items without words give no pattern; without any
    pattern nothing is hit. Columns of docs named like a result column, in any case, give way to it.
    An empty table gives an empty one.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in [n for n, _, _ in RESULT]])
    pieces = _pieces(benchmark, window, chunk_words, item_col, item_text_col)
    n_blocks = max(1, -(-(pieces.agg(F.sum(F.size("piece"))).first()[0] or 0) // block_words))
    if n_blocks > 1:
        keyed = pieces.withColumn("block", F.pmod(F.xxhash64("item", "piece"), F.lit(n_blocks)).cast("int"))
        return _in_passes(docs, keyed, n_blocks, window, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(_block(pieces))
    return arrow_map(docs, _scan(shared, window, text_col, docs.columns), T.StructType(docs.schema.fields + [T.StructField(n, t) for n, t, _ in RESULT]))


def items_digest(items) -> object:
    """Lower-case hex SHA-256 of the comma-joined ids."""
    return F.sha2(F.concat_ws(",", items), 256)


__all__ = ["WuManber", "compile_patterns", "decontaminate", "find", "items_digest", "merge"]
