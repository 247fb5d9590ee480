"""MinHash near-duplicates by a signature-coordinate inverted join.

A document's set of shingles has a signature of SIGNATURE minima. Documents are posted under coordinate-value pairs;
two sets of similarity s agree on each coordinate with probability s, so pairs under the match threshold can't be near
copies but with a chance that is stated in `miss_probability` (2e-9 at the bound itself). Only the rarest shared pairs are
posted (prefix), and documents with fewer shared pairs than the threshold not at all (skip). Links that count enough
collisions make candidate groups, in which every link is confirmed on the full sets.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_ASCII, arrow_map, connected_components, cut, in_blocks, modest, text_key, texts

#: Coordinates of a signature, and collisions that a candidate needs.
SIGNATURE, MATCHES = 64, 30
#: Coordinates that are counted first.
FIRST = 48
#: Rows of a posting list searched at once; lists of over WIDE rows are linked without a count, which only widens groups.
BLOCK, WIDE = 8192, 65_536
#: Bytes of text that one task confirms at once.
CONFIRMED_BYTES = 8 << 20
_WORD = (1 << 64) - 1
_draw = random.Random(20)
_XORS = np.array([_draw.getrandbits(64) for _ in range(SIGNATURE)], np.uint64)[:, None]
_ODDS = np.array([_draw.getrandbits(64) | 1 for _ in range(SIGNATURE)], np.uint64)[:, None]


def miss_probability(similarity: float, signature: int = SIGNATURE, matches: int = MATCHES) -> float:
    """Chance that a pair of this similarity collides in fewer coordinates than asked."""
    return sum(math.comb(signature, k) * similarity**k * (1 - similarity) ** (signature - k) for k in range(matches))


def shingle_set(text: bytes, shingle: int = 4) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a UTF-8 text; fewer words are one shingle, none give none."""
    words = text.translate(LOWER_ASCII).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh3_64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
    return np.unique(np.fromiter((digest(joined[s:e]) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)), np.uint64, len(starts)))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minima under SIGNATURE orders, the coordinate in the lowest bits, so that a value alone names the pair."""
    least = np.full(SIGNATURE, _WORD, np.uint64)
    for i in range(0, len(hashes), 4096):
        least = np.minimum(least, ((hashes[None, i : i + 4096] ^ _XORS) * _ODDS).min(axis=1))
    return (least & np.uint64(_WORD ^ (SIGNATURE - 1))) | np.arange(SIGNATURE, dtype=np.uint64)


def sketch(values: np.ndarray) -> bytes:
    """A byte of each coordinate; unlike ones agree by chance in one of 256."""
    return (values >> np.uint64(6)).astype(np.uint8).tobytes()


_ROWS = "doc_id long, text_key long, k1 long, k2 long, n_shingles long, values array<long>, sketch binary"
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n_shingles", pa.int64()), ("values", pa.list_(pa.int64())), ("sketch", pa.binary())]
)


def _signatures(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, values, sketches, sizes = [], [], [], []
            for text in texts(batch):
                found = shingle_set(text, shingle)
                own = signature(found) if len(found) else None
                sizes.append(len(found))
                names.append(xxhash.xxh3_128_digest(found.tobytes()))
                values.append(None if own is None else own.view(np.int64))
                sketches.append(None if own is None else sketch(own))
            keys = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
            columns = [batch.column(0), batch.column(1), keys[:, 0], keys[:, 1], sizes, values, sketches]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)

    return run


def spanning(n: int, linked) -> list[tuple[int, int]]:
    """(member, first member) of every component of two or more of 0..n-1; linked(i, rest) tells which of rest link to i."""
    out: list[tuple[int, int]] = []
    rest = np.arange(n)
    while len(rest) > 1:
        first, queue, rest = int(rest[0]), [int(rest[0])], rest[1:]
        while queue and len(rest):
            near = linked(queue.pop(), rest)
            found = rest[near].tolist()
            queue += found
            out += [(x, first) for x in found]
            rest = rest[~near]
    return out


def _near_sizes(a: np.ndarray, b, per_cent: int) -> np.ndarray:
    return np.minimum(a, b) * 100 >= np.maximum(a, b) * per_cent


def _collisions(per_cent: int, matches: int):
    """Posting lists of (node, size, sketch) to spanning links of those that collide often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int]] = []
            for rows in batch.column(0):
                rows = rows.values
                nodes = rows.field("node").to_pylist()
                sizes = rows.field("n_shingles").to_numpy()
                marks = np.frombuffer(b"".join(rows.field("sketch").to_pylist()), np.uint8).reshape(len(nodes), SIGNATURE)

                def linked(i: int, rest: np.ndarray) -> np.ndarray:
                    near = _near_sizes(sizes[rest], sizes[i], per_cent)
                    # A count of the first coordinates skips those that the others can't bring to the threshold.
                    some = (marks[rest[near], :FIRST] == marks[i, :FIRST]).sum(axis=1)
                    near[near] = some >= matches - (SIGNATURE - FIRST)
                    near[near] = (marks[rest[near]] == marks[i]).sum(axis=1) >= matches
                    return near

                out += [(nodes[a], nodes[b]) for a, b in spanning(len(nodes), linked)]
            yield _links(out)

    return run


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def similar(sets: list[np.ndarray], per_cent: int) -> list[tuple[int, int]]:
    """Spanning links of the sets with 100 * intersection >= per_cent * union, counted by merging the sets' inverted lists."""
    sizes = np.array([len(s) for s in sets])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(at, kind="stable")
    posted, ends = owner[order], np.cumsum(np.bincount(at, minlength=len(values)))
    begins = np.concatenate(([0], np.cumsum(sizes)))

    def linked(i: int, rest: np.ndarray) -> np.ndarray:
        near = _near_sizes(sizes[rest], sizes[i], per_cent)
        if not near.any():
            return near
        own = at[begins[i] : begins[i + 1]]
        stop, start = ends[own], np.where(own > 0, ends[own - 1], 0)
        total = int((stop - start).sum())
        take = np.repeat(stop - np.cumsum(stop - start), stop - start) + np.arange(total)
        common = np.bincount(posted[take], minlength=len(sets))[rest]
        return near & (100 * common >= per_cent * (sizes[rest] + sizes[i] - common))

    return spanning(len(sets), linked)


def _confirm(shingle: int, per_cent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int]] = []
            for rows in batch.column(0):
                rows = rows.values
                nodes = rows.field("node").to_pylist()
                sets = [shingle_set(t, shingle) for t in rows.field("text").cast(pa.large_binary()).to_pylist()]
                out += [(nodes[a], nodes[b]) for a, b in similar(sets, per_cent)]
            yield _links(out)

    return run


def _postings(classes: DataFrame, matches: int) -> DataFrame:
    """(token, node, n_shingles, sketch): the rarest shared coordinate-value pairs of classes that share enough of them."""
    pairs = classes.select("node", F.explode("values").alias("token"))
    often = cut(pairs.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("token").alias("shared"), "n"))
    shared = pairs.join(modest(often), F.col("token") == F.col("shared"))
    shared = shared.groupBy(F.col("node").alias("of")).agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("tokens"))
    # Two sets with enough common pairs have one among the first size - matches + 1 of each, in any common order.
    prefix = F.slice("tokens", F.lit(1), F.size("tokens") - matches + 1)
    shared = shared.where(F.size("tokens") >= matches).select("of", prefix.alias("tokens"))
    rows = shared.join(classes.select("node", "n_shingles", "sketch"), F.col("node") == F.col("of"))
    return rows.select(F.explode("tokens.token").alias("token"), "node", "n_shingles", "sketch")


def candidate_groups(classes: DataFrame, per_cent: int = 80, matches: int = MATCHES, block: int = BLOCK, wide: int = WIDE) -> DataFrame:
    """(node, component): groups of classes that no near copy crosses. Groups may be wider than the links need."""
    postings = cut(_postings(classes, matches))
    lists = cut(postings.groupBy(F.col("token").alias("t")).agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("b")).where("n > 1"))
    usual = postings.join(modest(lists.where(F.col("n") <= wide).select("t")), F.col("token") == F.col("t"), "left_semi")
    found = in_blocks(usual, "token", F.xxhash64("node"), block).groupBy("token", "p", "q")
    found = arrow_map(found.agg(F.collect_list(F.struct("node", "n_shingles", "sketch")).alias("rows")).select("rows"), _collisions(per_cent, matches), "a long, b long")
    stars = postings.join(modest(lists.where(F.col("n") > wide).select("t", "b")), F.col("token") == F.col("t")).select(F.col("node").alias("a"), "b")
    return connected_components(found.unionByName(stars))


def confirmed_links(members: DataFrame, shingle: int = 4, per_cent: int = 80, size: int = CONFIRMED_BYTES, rounds: int = 2) -> DataFrame:
    """(a, b): links that span the components of members (node, text, component) under the similarity of full sets.

    A group of up to `size` bytes is searched at once. A larger one is dealt into blocks by hash, `rounds` times anew; groups of
    near copies become one component in this way, each text being read once a round. Where several components are left, the
    largest one is held against the others, and these against each other, in pairs of blocks, so that no link is lost.
    """
    members = cut(members.withColumn("bytes", F.octet_length("text") + 16))
    sizes = cut(members.groupBy(F.col("component").alias("c")).agg(F.sum("bytes").alias("all")).where(F.col("all") > size))

    def search(rows: DataFrame, *by: str) -> DataFrame:
        lists = rows.groupBy("component", *by).agg(F.collect_list(F.struct("node", "text")).alias("rows"))
        return cut(arrow_map(lists.where(F.size("rows") > 1).select("rows"), _confirm(shingle, per_cent), "a long, b long"))

    large = modest(sizes)
    links = search(members.join(large, F.col("component") == F.col("c"), "left_anti"))
    if sizes.isEmpty():
        return links
    rows = members.join(large, F.col("component") == F.col("c")).withColumn("blocks", F.ceil(F.col("all") / size))
    for k in range(rounds):
        dealt = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit(k)), "blocks"))
        links = links.unionByName(search(dealt, "own"))
    label = cut(connected_components(links).select(F.col("node").alias("of"), F.col("component").alias("label")))
    rows = rows.drop("c", "all", "blocks").join(modest(label), F.col("node") == F.col("of"), "left").withColumn("label", F.coalesce("label", "node"))
    parts = cut(rows.groupBy("component", "label").agg(F.sum("bytes").alias("part")))
    split = parts.groupBy(F.col("component").alias("c")).agg(F.max(F.struct("part", "label")).alias("top"), F.sum("part").alias("all"), F.count(F.lit(1)).alias("n"))
    split = cut(split.where("n > 1").select("c", F.col("top.label").alias("most"), F.ceil(F.col("top.part") / size).alias("ps"), F.ceil((F.col("all") - F.col("top.part")) / size).alias("qs")))
    if split.isEmpty():
        return links
    rows = rows.join(modest(split), F.col("component") == F.col("c"))
    salt, first = F.xxhash64("node"), F.col("label") == F.col("most")
    own = F.when(first, F.pmod(salt, "ps")).otherwise(F.col("ps") + F.pmod(salt, "qs"))
    others = F.sequence(F.when(first, F.col("ps")).otherwise(F.lit(0)), F.col("ps") + F.col("qs") - 1)
    rows = rows.withColumn("own", own).withColumn("other", F.explode(others)).withColumns({"p": F.least("own", "other"), "q": F.greatest("own", "other")})
    return links.unionByName(search(rows, "p", "q"))


def minhash_components(
    docs: DataFrame, shingle: int = 4, per_cent: int = 80, matches: int = MATCHES, id_col: str = "doc_id", text_col: str = "text", **sizes
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of docs.

    Documents link where 100 * intersection >= per_cent * union of their sets of shingles; A-Z are lower-cased, words are
    runs without space and \\x09-\\x0D, a shingle is `shingle` words, or all words where there are fewer. Sets are held as 64-bit
    hashes. component_id is the least id reachable, a row's own included; kept tells whether it is the row's own.

    A null or empty text, or one without words, has an empty set and links with nothing, its copies included. Null ids count
    as greater than all others; components of null ids alone have component_id null and are kept. Repeated rows stay, each
    with the same result. An empty table gives an empty one. Other columns are not read. Like sets are one class before
    the search, so many copies cost one row. sizes: block, wide, size, rounds of the two searches.
    """
    search = {k: sizes[k] for k in ("block", "wide") if k in sizes}
    confirm = {k: sizes[k] for k in ("size", "rounds") if k in sizes}
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_key(F.col(f"`{text_col}`")).alias("text_key"), F.col(f"`{text_col}`").alias("text"))
    rows = cut(arrow_map(source, _signatures(shingle), _ROWS))
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    classes = rows.where("n_shingles > 0").groupBy("k1", "k2").agg(
        F.min(first).alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("values").alias("values"), F.any_value("sketch").alias("sketch")
    )
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()))
    groups = cut(candidate_groups(classes, per_cent, matches, **search).select(F.col("node").alias("of"), "component"))
    named = cut(classes.join(modest(groups), F.col("node") == F.col("of")).select("node", "component", F.col("first.doc_id").alias("d"), F.col("first.text_key").alias("t")))
    members = source.join(modest(named), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")))
    # Repeated rows of a class's first document are one member.
    members = members.groupBy("node").agg(F.any_value("component").alias("component"), F.any_value("text").alias("text"))
    linked = cut(connected_components(confirmed_links(members, shingle, per_cent, **confirm)).select(F.col("node").alias("of"), "component"))
    known = classes.select("k1", "k2", "node", "copies", F.col("first.doc_id").alias("least")).join(modest(linked), F.col("node") == F.col("of"), "left")
    known = cut(known.where("copies > 1 OR of IS NOT NULL").select("k1", "k2", F.coalesce("component", "node").alias("component"), "least"))
    least = cut(known.groupBy("component").agg(F.min("least").alias("component_id")))
    known = cut(known.join(modest(least), "component").select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "component_id"))
    same = (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & (F.col("n_shingles") > 0)
    out = rows.select("doc_id", "n_shingles", "k1", "k2").join(modest(known), same, "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
