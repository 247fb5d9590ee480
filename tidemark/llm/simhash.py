"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints of 64 bits are hashed by 2^(r+1) - 1 structured bit masks: each bit gets a random word of
r+1 bits, and the mask of a non-zero word v holds the bits whose word has odd parity with v. Two
fingerprints that differ in at most r bits agree on at least one mask, whatever the bits, because r
words of r+1 bits always leave a v orthogonal to all of them. No pair within the radius is missed.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER_ASCII, arrow_map, connected_components, cut, free_name, in_blocks, texts


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of the shingles of a UTF-8 text, repeats included.

    A-Z are lower-cased; words are runs without space and \\x09-\\x0D; a shingle is `shingle` words
    joined by spaces, or all the words where there are fewer; its hash is XXH64. A bit is set if over
    half of the hashes have it. No words: 0.
    """
    words = text.translate(LOWER_ASCII).split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
        hashes = [digest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i : i + (1 << 16)], np.uint64)
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def covering_masks(radius: int, seed: int = 7, bits: int = 64) -> list[int]:
    """2^(radius+1) - 1 masks such that any `radius` bits or fewer are all outside of at least one."""
    rng = random.Random(seed)
    width = radius + 1
    # Spread the bits evenly over the words, the zero word left out: a bit with it would be in no mask.
    words = [1 + i % ((1 << width) - 1) for i in range(bits)]
    rng.shuffle(words)
    return [sum(1 << i for i, w in enumerate(words) if (w & v).bit_count() & 1) for v in range(1, 1 << width)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(text_col: str, shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            values = [_signed(fingerprint(x, shingle, seed)) for x in texts(batch, text_col)]
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [c for i, c in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.int64())], names=[*names, "fp"])

    return run


def spanning_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(member, least member) of every component of two or more under links at `radius` bits or fewer.

    values: unsigned; numpy counts the bits of a signed number's magnitude.
    """
    out: list[tuple[int, int]] = []
    rest = values.copy()
    while len(rest) > 1:
        queue, group, rest = [rest[0]], [int(rest[0])], rest[1:]
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue.pop()) <= radius
            if near.any():
                found = rest[near]
                queue.extend(found)
                group.extend(found.tolist())
                rest = rest[~near]
        least = min(group)
        out += [(x, least) for x in group if x != least]
    return out


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = np.diff(lists.offsets.to_numpy())
            starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            two = starts[sizes == 2]
            a, b = values[two], values[two + 1]
            near = np.bitwise_count(a ^ b) <= radius
            pairs = [(a[near], b[near])]
            for i in np.flatnonzero(sizes > 2):
                if found := spanning_links(values[starts[i] : starts[i] + sizes[i]], radius):
                    pairs.append(tuple(np.array(found, np.uint64).T))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in zip(*pairs, strict=True)], names=["a", "b"])

    return run


def fingerprint_components(fps: DataFrame, radius: int = 4, block: int = 2048, seed: int = 7) -> DataFrame:
    """(fp, component) of the distinct fingerprints fp that link to another one.

    Buckets are gathered as lists of at most about `block` fingerprints. A larger bucket is dealt into
    blocks by hash and every pair of its blocks is searched by itself, so no link is lost and no task
    holds more than two blocks. Of each list only links to the least member of a component leave,
    never all its pairs.
    """
    masks = covering_masks(radius, seed)
    keys = fps.select(
        "fp", F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(_signed(m))) for i, m in enumerate(masks)])).alias("key")
    )
    found = in_blocks(keys, "key", F.xxhash64("fp"), block).groupBy("key", "p", "q").agg(F.collect_list("fp").alias("fps"))
    found = found.where(F.size("fps") > 1).select("fps")
    return connected_components(arrow_map(found, _links(radius), "a long, b long"))


def simhash_components(
    docs: DataFrame, radius: int = 4, shingle: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fp (signed long) and component_id of every row of docs.

    Fingerprints link at `radius` differing bits or fewer; component_id is the least id reachable over
    links, a row's own included. Copies collapse to one fingerprint before the search, so a large group
    of them costs one row. A null or empty text, or one without words, has fingerprint 0, which links
    like any other. Null ids count as greater than all others: a component of null ids alone has
    component_id null. Repeated rows stay, each with the same result. Other columns are not read.
    An empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = cut(arrow_map(rows, _fingerprints("text", shingle, seed), "doc_id long, fp long"))
    fps = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    # Every fingerprint becomes as many rows as there are masks, so they are spread over all tasks first.
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-fps.count() // 500_000))
    linked = cut(fingerprint_components(fps.select("fp").repartition(tasks, "fp"), radius).select(F.col("node").alias("fp"), "component"))
    known = cut(fps.join(linked, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component")))
    least = cut(known.groupBy("component").agg(F.min("least").alias("component_id")))
    by_fp = cut(known.join(least, "component").select(F.col("fp").alias("of"), "component_id"))
    return rows.join(by_fp, F.col("fp") == F.col("of")).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of docs for each component: that of the least id; of rows repeated in the id, that of the least text.

    Rows alike in id and text go by a hash of all their columns. Rows whose id is null can't be named by a
    component; they are kept. An empty table gives an empty one; a null text counts as empty.
    """
    found = simhash_components(docs, id_col=id_col, text_col=text_col, **options)
    keep, row = free_name(docs, "keep"), free_name(docs, "row")
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias(keep)).distinct()
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.struct(F.col(f"`{text_col}`"), F.xxhash64(F.to_json(own)))
    named = docs.join(first, F.col(f"`{id_col}`") == F.col(keep), "left_semi").groupBy(F.col(f"`{id_col}`").alias(keep)).agg(F.min_by(own, order).alias(row))
    named = named.select(*[F.col(row)[c].alias(c) for c in docs.columns])
    return named.unionByName(docs.where(F.col(f"`{id_col}`").isNull()))
