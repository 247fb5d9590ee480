"""Line deduplication by a segment-partition edit join.

Two lines within t edits share one of t + 1 segments of the shorter line, at a place that the lengths
narrow down. Each line is indexed by its segments and probes the segments of the lengths from its own
down to t less, at the few starts that an alignment can have (multi-match-aware windows). Keys carry
the length, so one hash join finds all candidates; a banded bit-parallel edit distance verifies them.

Rows of the join are hashes only. Text is fetched for lines that have a candidate at all. A key that
very many lines share is refined: what is left of the lines without the shared segment must be within
t edits too, so it is cut into t + 1 segments in its turn, and the lines meet under those.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import across_labels, arrow_map, connected_components, cut, free_name, in_blocks, modest, text_key

INDEX, PROBE = 1, 2


def partition(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of even segments; the longer ones last."""
    size, longer = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        n = size + (i >= parts - longer)
        out.append((at, n))
        at += n
    return out


def windows(length: int, edits: int) -> list[tuple[int, int, int, int, int]]:
    """(role, indexed length, segment, start, size) of what a line of this length indexes and probes."""
    out = []
    for less in range(edits + 1):
        other = length - less
        for i, (at, n) in enumerate(partition(other, edits + 1)):
            low = max(0, at - i, at + less - (edits - i))
            high = min(length - n, at + i, at + less + (edits - i))
            for start in range(low, high + 1):
                out.append((PROBE | INDEX if less == 0 and start == at else PROBE, other, i, start, n))
    return out


def within(a: str, b: str, k: int) -> bool:
    """Whether the edit distance of two texts is at most k, by bit vectors over a band of diagonals."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > k:
        return False
    if a == b:
        return True
    s, n = 0, len(b)
    while s < n and a[s] == b[s]:
        s += 1
    e = 0
    while e < n - s and a[-1 - e] == b[-1 - e]:
        e += 1
    a, b = a[s : len(a) - e], b[s : len(b) - e]
    if len(a) <= k:
        return True
    if not k or not b:
        return False
    rows: dict[str, int] = {}
    for i, c in enumerate(a):
        rows[c] = rows.get(c, 0) | 1 << i
    # The vector's highest bit is k rows below the diagonal; the score is followed along that edge of
    # the band until it meets the last row, and then along the row.
    width = 2 * k + 2
    full = (1 << width) - 1
    edge, row = 1 << (width - 1), 1 << (width - 2)
    vp, vn = full & ~((1 << (width - k - 1)) - 1), 0
    score, at = k, k + 1 - width
    most = k + len(b) - (len(a) - k)
    for i, c in enumerate(b):
        match = rows.get(c, 0)
        x = (match >> at if at >= 0 else match << -at) & full
        d0 = ((((x & vp) + vp) ^ vp) | x | vn) & full
        hp = vn | full & ~(d0 | vp)
        hn = d0 & vp
        if i < len(a) - k:
            score += not d0 & edge
        else:
            score += bool(hp & row) - bool(hn & row)
            row >>= 1
        if score > most:
            return False
        shifted = d0 >> 1
        vp = hn | full & ~(shifted | hp)
        vn = shifted & hp
        at += 1
    return score <= k


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _segments(edits: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        plans: dict[int, list] = {}
        seen: set[int] = set()
        for batch in batches:
            keys, ids, roles = [], [], []
            for text in batch.column(0).to_pylist():
                for line in (text or "").split("\n"):
                    n = len(line)
                    if n < least:
                        continue
                    raw = line.encode()
                    own = digest(raw, 42)
                    if own in seen:
                        continue
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(own)
                    plan = plans.get(n)
                    if plan is None:
                        if len(plans) > 5_000:
                            plans.clear()
                        plan = plans[n] = [(role, of << 4 | i, s, s + m) for role, of, i, s, m in windows(n, edits)]
                    if len(raw) == n:  # ASCII: bytes are characters
                        keys += [digest(raw[s:e], seed) for _, seed, s, e in plan]
                    else:
                        keys += [digest(line[s:e].encode(), seed) for _, seed, s, e in plan]
                    roles += [p[0] for p in plan]
                    ids += [own] * len(plan)
            arrays = [pa.array(keys, pa.uint64()).view(pa.int64()), pa.array(ids, pa.uint64()).view(pa.int64()), pa.array(roles, pa.int8())]
            for i in range(0, max(1, len(keys)), 1 << 16):
                yield pa.RecordBatch.from_arrays([x.slice(i, 1 << 16) for x in arrays], names=["key", "id", "role"])

    return run


def _parts(key: int, entry: int, less: int, rest: str, edits: int) -> list[tuple[int, int, int, int]]:
    """(key, role, start, size) that what is left of a line of a refined key indexes and probes.

    less: by how many characters the line is longer than the indexed lines of its key. Too short a rest
    has no segments and stays under one key.
    """
    other, head = len(rest) - less, key.to_bytes(8, "little", signed=True)
    if other <= edits:
        return [(_signed(xxhash.xxh64_intdigest(head + b"rest", 42)), entry, 0, 0)]
    out = []
    for role, of, i, start, n in windows(len(rest), edits):
        if of == other:
            own = xxhash.xxh64_intdigest(head + (of << 4 | i).to_bytes(8, "little") + rest[start : start + n].encode(), 42)
            out.append((_signed(own), role if entry & INDEX else PROBE, start, n))
    return out


def _refined(edits: int):
    """Rows of refined keys. A row without a rest is of the first level: the segment is found again in its line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, name, role, less, rest, start, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if less is None:
                    cuts = [
                        (len(rest) - of, s, n)
                        for r, of, i, s, n in windows(len(rest), edits)
                        if r == role and _signed(xxhash.xxh64_intdigest(rest[s : s + n].encode(), of << 4 | i)) == key
                    ]
                else:
                    cuts = [(less, start, size)]
                for fewer, s, n in cuts:
                    left = rest[:s] + rest[s + n :]
                    out += [(k, name, r, fewer, left, a, m) for k, r, a, m in _parts(key, role, fewer, left, edits)]
            kinds = (pa.int64(), pa.int64(), pa.int8(), pa.int32(), pa.string(), pa.int32(), pa.int32())
            for i in range(0, len(out), 1 << 14):
                part = out[i : i + (1 << 14)]
                arrays = [pa.array([x[c] for x in part], t) for c, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "id", "role", "less", "rest", "start", "size"])

    return run


def _refine(keys: DataFrame, lines: DataFrame, edits: int, block: int, levels: int) -> DataFrame:
    """keys (key, id, role), with the rows of keys over `block` lines under finer keys, up to `levels` times over."""
    schema = "key long, id long, role byte, less int, rest string, start int, size int"
    large = cut(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select("key"))
    if large.isEmpty() or not levels:
        return keys
    out = keys.join(modest(large), "key", "left_anti")
    none = F.lit(None).cast("int")
    rows = keys.join(modest(large), "key").join(lines, "id").select("key", "id", "role", none.alias("less"), F.col("line").alias("rest"), none.alias("start"), none.alias("size"))
    for level in range(levels):
        rows = cut(arrow_map(rows, _refined(edits), schema))
        shared = rows.groupBy("key").agg(
            F.min("id").alias("lo"), F.max("id").alias("hi"), F.max(F.col("role").bitwiseAND(INDEX)).alias("indexed"), F.count(F.lit(1)).alias("n")
        )
        shared = cut(shared.where("lo <> hi AND indexed > 0").select("key", (F.col("n") > block).alias("large")))
        rows = rows.join(modest(shared), "key")
        last = level == levels - 1
        found = rows.select("key", "id", "role") if last else rows.where("NOT large").select("key", "id", "role")
        out = out.unionByName(found.distinct())
        rows = rows.where("large").drop("large")
        if last or shared.where("large").isEmpty():
            break
    return cut(out)


def _verify(edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int]] = []
            for group in batch.column(0).to_pylist():
                out += spanning_links([(x["id"], x["role"], x["line"]) for x in group], edits, [x["label"] for x in group])
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def spanning_links(lines: list[tuple[int, int, str]], edits: int, labels: list | None = None) -> list[tuple[int, int]]:
    """Verified links that join all lines of a key which links join; pairs joined already, or of one label, aren't compared."""
    first: dict = {}
    root = [first.setdefault(x, i) for i, x in enumerate(labels)] if labels else list(range(len(lines)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for j, (b, role_b, y) in enumerate(lines):
        for i in range(j):
            a, role_a, x = lines[i]
            if a != b and (role_a | role_b) == (INDEX | PROBE) and find(i) != find(j) and within(x, y, edits):
                root[find(j)] = find(i)
                out.append((a, b))
    return out


def _searched(groups: DataFrame, lines: DataFrame, edits: int, *by: str) -> DataFrame:
    """Links of the lines that groups (by, id, role, label) hold."""
    lists = groups.join(lines, "id").groupBy("key", *by).agg(F.collect_list(F.struct("id", "role", "line", "label")).alias("lines"))
    return arrow_map(lists.where(F.size("lines") > 1).select("lines"), _verify(edits), "a long, b long")


def _dense(keys: DataFrame, lines: DataFrame, edits: int, block: int, rounds: int, dense: int) -> tuple[DataFrame, DataFrame] | None:
    """Links found in keys of over `dense` lines with their lines dealt into blocks, `rounds` times; and (of, label): what they
    join. None if no key is so large. A line is searched `rounds` times a key, so lines that differ in a counter become one
    without all pairs."""
    large = cut(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > dense))
    if large.isEmpty():
        return None
    rows = keys.join(modest(large), "key").withColumns({"label": F.col("id"), "k": F.explode(F.sequence(F.lit(1), F.lit(rounds)))})
    links = cut(_searched(rows.withColumn("q", F.pmod(F.xxhash64("id", "k"), F.ceil(F.col("n") / block))), lines, edits, "k", "q"))
    return links, cut(connected_components(links).select(F.col("node").alias("of"), F.col("component").alias("label")))


def _lines(docs: DataFrame, id_col: str, text_col: str, least: int, short: bool = False) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("h"), F.posexplode(F.split(text, "\n")).alias("nth", "line"))
    wanted = F.length("line") >= least
    if short:
        wanted = wanted | F.col("line").rlike(r"[\p{L}\p{N}]")
    return rows.where(wanted).withColumns({"id": F.xxhash64("line"), "check": F.hash("line")})


def line_links(docs: DataFrame, edits: int = 2, least: int = 40, block: int = 256, broadcast_ids: int = 1_000_000, levels: int = 3, rounds: int = 3, dense: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b): links of distinct lines within `edits` edits that join all lines which such links join.

    A line is named by its XXH64. Lines shorter than `least` characters are left out. A key of over `dense` lines (8 blocks) is
    searched in blocks of its lines first, dealt `rounds` times; where lines are left that these don't join, and in other keys of
    over `block` lines, it is refined up to `levels` times, and what is still larger is searched in pairs of blocks, as far as
    its lines aren't joined. Keys that lines share and ids of candidates are broadcast up to broadcast_ids of them, and joined by a shuffle beyond.
    """
    keys = arrow_map(docs.select(F.col(text_col)), _segments(edits, least), "key long, id long, role byte")
    # Sums by key are made partially in each task, so no task gathers the rows of a key that very many lines share.
    shared = keys.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.max(F.col("role").bitwiseAND(INDEX)).alias("indexed"))
    shared = cut(shared.where("lo <> hi AND indexed > 0").select("key"))
    few = shared.count() <= broadcast_ids
    keys = cut(keys.join(F.broadcast(shared) if few else shared, "key", "left_semi").distinct())
    ids = cut(keys.select("id").distinct().withColumnRenamed("id", "wanted"))
    few = ids.count() <= broadcast_ids
    lines = _lines(docs, id_col, text_col, least).join(F.broadcast(ids) if few else ids, F.col("id") == F.col("wanted"))
    lines = cut(lines.select("id", "line").dropDuplicates(["id"]))
    found = _dense(keys, lines, edits, block, rounds, 8 * block if dense is None else dense)
    if found is None:
        groups = in_blocks(_refine(keys, lines, edits, block, levels), "key", F.xxhash64("id"), block)
        return _searched(groups.withColumn("label", F.col("id")), lines, edits, "p", "q")
    links, label = found[0], modest(found[1])
    keys = _open(_refine(_open(keys, label).drop("label"), lines, edits, block, levels), label)
    return _searched(across_labels(keys, "key", F.xxhash64("id"), block), lines, edits, "p", "q").unionByName(links)


def _open(keys: DataFrame, label: DataFrame) -> DataFrame:
    """keys with the label of each line, without the keys whose lines have one label."""
    rows = keys.join(label, F.col("id") == F.col("of"), "left").withColumn("label", F.coalesce("label", "id")).drop("of")
    one = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo = hi").select("key")
    return rows.join(modest(cut(one)), "key", "left_anti")


def repeated_lines(docs: DataFrame, edits: int = 2, least: int = 40, id_col: str = "doc_id", text_col: str = "text", short: bool = False, **options) -> DataFrame:
    """(doc_id, h, lines, n_near): the line numbers to drop of every document that has some.

    Lines that are equal or joined by links make a class; its first line by doc_id (null last) and line
    number stays, and all others go. short: shorter lines with a letter or digit are grouped too, by
    equality alone. n_near counts those that differ from the one that stays. h is the
    key of the text; rows alike in id and text stand for one document. Lines are equal if two hashes, of 64
    and of 32 bits, are: among 10^12 different lines, two would be taken for one with a chance near 10^-5.
    """
    classes = cut(connected_components(line_links(docs, edits, least, id_col=id_col, text_col=text_col, **options)))
    rows = _lines(docs, id_col, text_col, least, short).drop("line")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "nth", "id")
    firsts = rows.groupBy("id", "check").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    known = firsts.join(classes, F.col("id") == F.col("node"), "left").where("n > 1 OR node IS NOT NULL")
    alone = F.when(F.col("component").isNull(), F.col("check"))
    known = cut(known.select("id", "check", "first", F.coalesce("component", "id").alias("class"), F.coalesce(alone, F.lit(0)).alias("own")))
    heads = cut(known.groupBy("class", "own").agg(F.min("first").alias("head")))
    known = cut(known.join(heads, ["class", "own"]).select(F.col("id").alias("of"), F.col("check").alias("of_check"), "head"))
    gone = rows.join(known, (F.col("id") == F.col("of")) & (F.col("check") == F.col("of_check"))).where(
        ~(F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("nth") == F.col("head.nth")) & (F.col("id") == F.col("head.id")))
    )
    return gone.groupBy("doc_id", "h").agg(
        F.array_sort(F.collect_set("nth")).alias("lines"), F.count_distinct(F.when(F.col("id") != F.col("head.id"), F.col("nth"))).alias("n_near")
    )


def _without(text_col: str, lines_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            drop = batch.column(batch.schema.get_field_index(lines_col)).to_pylist()
            new, n_lines = [], []
            for text, gone in zip(batch.column(at).to_pylist(), drop, strict=True):
                lines = None if text is None else text.split("\n")
                n_lines.append(0 if lines is None else len(lines))
                if gone and lines:
                    out = set(gone)
                    text = "\n".join(x for i, x in enumerate(lines) if i not in out)
                new.append(text)
            counts = [len(x or ()) for x in drop]
            names = batch.schema.names[:-2]
            columns = [pa.array(new, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            columns += [pa.array(n_lines, pa.int64()), pa.array(counts, pa.int64()), batch.column(len(names) + 1)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_lines", "n_dropped", "n_near"])

    return run


def dedup_lines(docs: DataFrame, edits: int = 2, least: int = 40, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with the repeated lines cut out of the text, and n_lines, n_dropped and n_near.

    Lines end at \\n. Lines of less than `least` characters are never near others; exact copies of them
    stay too, unless short is given, and then go if they hold a letter or digit. No row goes: a document whose
    lines all stand elsewhere is left with an empty text. Null texts stay null and have no lines; null
    ids come last in the order of documents; rows alike in id and text lose the same lines. Columns of
    docs named like a result column, in any case, give way to it.
    An empty table gives an empty one.
    """
    result = ("n_lines", "n_dropped", "n_near")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in result])
    names = [free_name(docs, c) for c in ("gone_id", "gone_h", "lines_gone")]
    gone = repeated_lines(docs, edits, least, id_col, text_col, **options).toDF(*names, "n_near")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(names[0])) & (text_key(F.col(f"`{text_col}`")) == F.col(names[1]))
    rows = docs.join(gone, same, "left").select(*[F.col(f"`{c}`") for c in docs.columns], names[2], F.coalesce("n_near", F.lit(0)).alias("n_near"))
    more = [T.StructField(c, T.LongType()) for c in ("n_lines", "n_dropped", "n_near")]
    return arrow_map(rows, _without(text_col, names[2]), T.StructType(docs.schema.fields + more))
