"""Phrase collocations by pivot partitioning, as MG-FSM does it.

Words get ids by falling frequency within their language, so a phrase's pivot, its rarest word, is its greatest id. Texts
are rewritten: words too rare for any phrase become blanks, and of every other word the neighbours that are more frequent
than it are kept, up to four a side. These fragments go to the bucket of the pivot, where all occurrences of the phrases that
it owns come together; phrases are mined there level by level, and only frequent ones leave. Pivots of many occurrences are
split by the neighbouring word, which a phrase has in common, and the most frequent ones by salts, whose counts are added.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, cut, modest, texts

#: Longest phrase in words.
LONGEST = 5
_REACH = LONGEST - 1
#: Word ids that a broadcast may hold; beyond it texts meet their ids in a join.
BROADCAST_WORDS = 400_000
#: Fragments a bucket is meant to have, buckets at most, and fragments that a task mines at once.
BUCKET, BUCKETS, HELD = 250_000, 200_000, 2_000_000
#: Occurrences of a pivot for each split by neighbour, and for each salt.
SPLIT, SALTED = 1_000_000, 64_000_000
#: Tokens that a task rewrites at once.
TOKENS = 1_000_000
#: Lower-cases A-Z, makes tabs spaces and the separators `[.,;:!?\x0A-\x0D]` line feeds.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
#: Stands between pieces; no UTF-8 text has this byte.
_GAP = b"\xff"


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, with _GAP between pieces."""
    return text.translate(_PLAIN).replace(b"\n", b" \xff ").split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of parts of a task; word null stands for all words."""
    counts: dict[str, Counter] = defaultdict(Counter)

    def told() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            found.pop(_GAP, None)
            words = [None, *found]
            sizes = [sum(found.values()), *found.values()]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), pa.array(words, pa.binary()).cast(pa.string()), pa.array(sizes, pa.int64())], names=["lang", "word", "n"])
        counts.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
            counts[lang].update(tokens(text))
        if sum(map(len, counts.values())) > 500_000:
            yield from told()
    yield from told()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of ids; the same in every task."""
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) >> np.uint64(1)


def fragments(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, left, right): a fragment of 2 * _REACH + 1 ids for each pivot, blanks being 0, and its words on either side.

    A phrase is that of its first pivot: words to the left are more frequent, words to the right may be the pivot again.
    """
    n, pad = len(ids), np.zeros(_REACH, ids.dtype)
    wide = np.concatenate((pad, ids, pad))
    rows = np.lib.stride_tricks.sliding_window_view(wide, 2 * _REACH + 1)[:n].copy() if n else np.zeros((0, 2 * _REACH + 1), ids.dtype)
    open_left = open_right = ids > 0
    left, right = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for j in range(1, _REACH + 1):
        a, b = rows[:, _REACH - j], rows[:, _REACH + j]
        open_left = open_left & (a > 0) & (a < ids)
        open_right = open_right & (b > 0) & (b <= ids)
        a[~open_left], b[~open_right] = 0, 0
        left += open_left
        right += open_right
    return rows, left, right


def _routed(ids: np.ndarray, hot_ids: np.ndarray, hot_counts: np.ndarray, buckets: int, at: int, split: int, salted: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, sizes, ids) of the fragments of a stretch of ids. Those of a split pivot go in two: phrases that go on to the right
    of it by the word there, phrases that end in it by the word before it."""
    rows, left, right = fragments(ids)
    pivot = rows[:, _REACH]
    hot = np.zeros(len(ids), bool)
    if len(hot_ids):
        place = np.minimum(np.searchsorted(hot_ids, pivot), len(hot_ids) - 1)
        count = np.where(hot_ids[place] == pivot, hot_counts[place], 0)
        hot = count > split
    parts, ways, before, after, only = [], [], [], [], []

    def add(some: np.ndarray, way: np.ndarray, with_left: int, with_right: bool) -> None:
        part = rows[some]
        part[:, : _REACH - with_left] = 0
        if not with_right:
            part[:, _REACH + 1 :] = 0
        parts.append(part)
        ways.append((way % np.uint64(buckets)).astype(np.int64))
        before.append(np.minimum(left[some], with_left))
        after.append(right[some] if with_right else np.zeros(len(some), np.uint8))
        only.append(np.full(len(some), with_left < _REACH, np.uint8))

    usual = np.flatnonzero(~hot & ((left > 0) | (right > 0)))
    add(usual, _mixed(pivot[usual]), _REACH, True)
    for on in (True, False):
        some = np.flatnonzero(hot & ((right if on else left) > 0))
        if len(some):
            splits, salts = (-(-count[some] // size) for size in (split, salted))
            extra = _mixed(rows[some, _REACH + 1 if on else _REACH - 1]) % splits.astype(np.uint64) * np.uint64(2) + np.uint64(on)
            extra = (extra << np.uint64(20)) + ((at + some) % salts).astype(np.uint64)
            # A phrase that goes on to the right has a word less to the left.
            add(some, _mixed(_mixed(pivot[some]) + extra + np.uint64(1)), _REACH - 1 if on else _REACH, on)
    rows, way, before, after, only = (np.concatenate(x) for x in (parts, ways, before, after, only))
    order = np.argsort(way, kind="stable")
    rows, way, sizes = rows[order], way[order], (before + 5 * after + 25 * only)[order].astype(np.uint8)
    stream = rows[rows > 0]
    ends = np.cumsum((before.astype(np.int64) + after + 1)[order])
    cuts = np.flatnonzero(np.diff(way)) + 1
    if not len(way):
        return
    starts, stops = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(way)]))
    pack = zstandard.ZstdCompressor(level=1).compress
    for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
        yield int(way[a]), pack(sizes[a:b].tobytes()), pack(_planes(stream[ends[a - 1] if a else 0 : ends[b - 1]]))


def _planes(ids: np.ndarray) -> bytes:
    """Ids by place of their bytes: the higher places are mostly alike and pack well."""
    return ids.view(np.uint8).reshape(-1, ids.itemsize).T.tobytes()


def _unplaned(data: bytes, dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


_FRAGMENTS = "bucket int, sizes binary, ids binary"


def _emitted(found: Iterator[tuple[int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
    rows = list(found)
    for i in range(0, len(rows), 4096):
        b, s, x = zip(*rows[i : i + 4096], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(s, pa.binary()), pa.array(x, pa.binary())], names=["bucket", "sizes", "ids"])


def _rewritten(arrays, dtype, route):
    """Batches to fragments; arrays(batch) gives the ids of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, at = [], 0, 0
        blank = np.zeros(1, dtype)
        for batch in batches:
            for ids in arrays(batch):
                held += [ids, blank]
                size += len(ids) + 1
                if size >= TOKENS:
                    yield from _emitted(_routed(np.concatenate(held), *route[:3], at, *route[3:]))
                    held, size, at = [], 0, at + size
        if held:
            yield from _emitted(_routed(np.concatenate(held), *route[:3], at, *route[3:]))

    return run


def _looked_up(broadcast, dtype):
    """The ids of texts by a broadcast dictionary of each language."""

    def arrays(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        known = broadcast.value
        for lang, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
            get = known.get(lang, {}).get
            yield np.array([get(t, 0) for t in tokens(text)], dtype)

    return arrays


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, lang, place, word) of every word; pieces and texts lie more than a place apart."""
    for batch in batches:
        for row, lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch), strict=True):
            own = tokens(text)
            for i in range(0, len(own), 65_536):
                some = [(i + k, w) for k, w in enumerate(own[i : i + 65_536]) if w != _GAP]
                columns = [pa.array([row] * len(some), pa.int64()), pa.array([lang] * len(some), pa.string()), pa.array([k for k, _ in some], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([w for _, w in some], pa.binary()).cast(pa.string())], names=["row", "lang", "place", "word"])


def _joined_up(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The ids of texts from lists of (place, id), ordered by place."""
    for pairs in batch.column(0):
        pairs = pairs.values
        place, ids = pairs.field("place").to_numpy(), pairs.field("id").to_numpy()
        out = np.zeros(int(place[-1]) + 1, np.int64)
        out[place] = ids
        yield out


def _mine(rows: np.ndarray, only_right: np.ndarray, least: int, partial: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrases, counts) of the phrases of each length that the pivots own; partial pivots' phrases all leave.

    A phrase is looked for where both its parts of a word less are frequent. only_right: the phrases that end in the pivot are
    counted elsewhere.
    """
    names, codes = np.unique(rows, return_inverse=True)
    codes = codes.reshape(rows.shape)  # blanks are 0 in every bucket: a fragment never fills all places
    if names[0] != 0:
        codes, names = codes + 1, np.concatenate(([0], names))
    width = len(names)
    frequent: dict[tuple[int, int], np.ndarray] = {}
    for m in range(2, LONGEST + 1):
        windows = [(_REACH - m + k, _REACH + k - 1) for k in range(2, m + 1)] + [(_REACH - m + 1, _REACH)]
        chosen = []
        for s, e in windows:
            good = (codes[:, s] > 0) & (codes[:, e] > 0)
            if e == _REACH:
                good &= ~only_right
            for part in ((s, e - 1), (s + 1, e)):
                if part in frequent:
                    good &= frequent[part] | only_right if part[1] == _REACH else frequent[part]
            chosen.append(np.flatnonzero(good))
        key, first = None, None
        words = [np.concatenate([codes[c, s + j] for c, (s, _) in zip(chosen, windows, strict=True)]) for j in range(m)]
        if not len(words[0]):
            return
        for j, own in enumerate(words):
            key = own.astype(np.int64) if key is None else key * width + own
            if j:
                _, first, key, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        kept = (counts >= least) | partial[np.concatenate(chosen)][first]
        yield names[np.stack([w[first[kept]] for w in words], axis=1)], counts[kept]
        ok, at = kept[key], 0
        for c, window in zip(chosen, windows, strict=True):
            flags = np.zeros(len(rows), bool)
            flags[c[ok[at : at + len(c)]]] = True
            frequent[window] = flags
            at += len(c)


def _rows_of(sizes: list[bytes], ids: list[bytes], dtype) -> tuple[np.ndarray, np.ndarray]:
    """Fragments, and which of them are only for phrases that go on to the right."""
    unpack = zstandard.ZstdDecompressor().decompress
    sizes = np.frombuffer(b"".join(map(unpack, sizes)), np.uint8)
    ids = np.concatenate([_unplaned(unpack(x), dtype) for x in ids])
    before, after = (sizes % 5)[:, None].astype(np.int64), (sizes // 5 % 5)[:, None]
    place = np.arange(-_REACH, _REACH + 1)[None, :]
    rows = np.zeros((len(sizes), 2 * _REACH + 1), np.int64)
    rows[(place >= -before) & (place <= after)] = ids
    return rows, sizes >= 25


_MINED = "ids array<long>, f long"


def _mined(least: int, dtype, salted_upto: int, held_most: int):
    """Buckets, in order, to (ids, f). A bucket of more fragments than are held gives partial counts of all its phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(sizes: list[bytes], ids: list[bytes], whole: bool) -> Iterator[pa.RecordBatch]:
            rows, only_right = _rows_of(sizes, ids, dtype)
            partial = (rows[:, _REACH] <= salted_upto) | (not whole)
            for phrases, counts in _mine(rows, only_right, least, partial):
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(phrases) + 1) * phrases.shape[1], pa.int32()), pa.array(phrases.ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays([lists, pa.array(counts, pa.int64())], names=["ids", "f"])

        bucket, sizes, ids, held, whole = None, [], [], 0, True
        for batch in batches:
            for own, s, x in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if own != bucket or held > held_most:
                    if sizes:
                        whole = whole and own != bucket
                        yield from told(sizes, ids, whole)
                    whole = own != bucket
                    bucket, sizes, ids, held = own, [], [], 0
                sizes.append(s)
                ids.append(x)
                held += zstandard.frame_content_size(s)
        if sizes:
            yield from told(sizes, ids, whole)

    return run


def word_counts(docs: DataFrame, least: int, broadcast_words: int = BROADCAST_WORDS) -> tuple[DataFrame, DataFrame, bool]:
    """(lang, n) of all words; (lang, word, f, id) of those with f >= least, ids by falling f; whether these are few."""
    counts = arrow_map(docs.select("lang", "text"), _count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    counts = cut(counts.where((F.col("f") >= least) | F.col("word").isNull()))
    words, order = counts.where("word IS NOT NULL"), (F.desc("f"), "lang", "word")
    few = words.count() <= broadcast_words
    if few:  # so many rows fit one window
        words = words.withColumn("id", F.row_number().over(Window.partitionBy().orderBy(*order)).cast("long"))
    else:
        words = words.orderBy(*order).withColumn("id", F.monotonically_increasing_id() + 1)
    return counts.where("word IS NULL").select("lang", F.col("f").alias("n")), cut(words), few


def phrase_counts(
    docs: DataFrame, words: DataFrame, few: bool, n_words: int, least: int, bucket: int = BUCKET, split: int = SPLIT, salted: int = SALTED, held: int = HELD
) -> DataFrame:
    """(ids, f) of the phrases of 2 to LONGEST words with f >= least. words, few: of word_counts; n_words: their occurrences."""
    spark = docs.sparkSession
    buckets = int(min(BUCKETS, max(spark.sparkContext.defaultParallelism, -(-n_words // bucket))))
    hot = words.where(F.col("f") > split).select("id", "f").orderBy("id").toPandas()  # at most n_words / split rows
    hot_ids, hot_counts = hot["id"].to_numpy(np.int64), hot["f"].to_numpy(np.int64)
    salted_upto = int(hot_ids[hot_counts > salted].max(initial=0))
    if few:
        known: dict[str, dict[bytes, int]] = defaultdict(dict)
        for r in words.select("lang", "word", "id").toLocalIterator():
            known[r.lang][r.word.encode()] = r.id
        dtype = np.uint16 if sum(map(len, known.values())) < (1 << 16) else np.uint32
        source, arrays = docs.select("lang", "text"), _looked_up(spark.sparkContext.broadcast(dict(known)), dtype)
    else:
        dtype, arrays = np.int64, _joined_up
        placed = arrow_map(docs.select(F.monotonically_increasing_id().alias("row"), "lang", "text"), _placed, "row long, lang string, place long, word string")
        placed = placed.join(words.select("lang", "word", "id"), ["lang", "word"])
        source = placed.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "id"))).alias("pairs")).select("pairs")
    routed = arrow_map(source, _rewritten(arrays, dtype, (hot_ids, hot_counts, buckets, split, salted)), _FRAGMENTS)
    routed = routed.repartition("bucket").sortWithinPartitions("bucket")
    found = arrow_map(routed, _mined(least, dtype, salted_upto, held), _MINED)
    return cut(found.groupBy("ids").agg(F.sum("f").alias("f")).where(F.col("f") >= least))


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(18,0)")


def scored(phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of phrases that no longer one accounts for; the lowest-scoring cut counts."""
    parts = phrases.unionByName(words.select(F.array("id").alias("ids"), "f"))
    within = F.flatten(F.transform(F.sequence(F.lit(2), F.size("ids") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.size("ids") - m + 1), lambda s: F.slice("ids", s, m))))
    inner = phrases.where(F.size("ids") > 2).select(F.explode(within).alias("inner"), F.col("f").alias("whole"))
    inner = inner.groupBy("inner").agg(F.max("whole").alias("whole"))
    kept = phrases.join(inner, F.col("ids") == F.col("inner"), "left").where("whole IS NULL OR 100 * whole < 100 * f").select("ids", F.col("f").alias("a"))
    cuts = kept.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.slice("ids", F.lit(1), F.col("k")), "tail": F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k"))})
    cuts = cuts.join(parts.select(F.col("ids").alias("head"), F.col("f").alias("l")), "head").join(parts.select(F.col("ids").alias("tail"), F.col("f").alias("r")), "tail")
    first = words.select(F.col("id").alias("of"), "lang").join(F.broadcast(totals), "lang")  # a row for each language
    cuts = cuts.join(modest(cut(first)), F.get("ids", F.lit(0)) == F.col("of"))
    # Up to 38 digits: 1000 * a * n and l * r, each of two counts.
    cuts = cuts.withColumns({"a_": _exact("a"), "l_": _exact("l"), "r_": _exact("r"), "n_": _exact("n")})
    cuts = cuts.withColumn("score", F.expr("(CAST(1000 AS DECIMAL(4,0)) * (a_ * n_)) div (l_ * r_)"))
    best = cut(cuts.groupBy("ids", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")))
    spelt = best.select("ids", F.posexplode("ids").alias("place", "id")).join(modest(words.select("id", "word")), "id")
    spelt = spelt.groupBy("ids").agg(F.array_join(F.array_sort(F.collect_list(F.struct("place", "word")))["word"], " ").alias("phrase"))
    return best.join(spelt, "ids").select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))


def mine_collocations(docs: DataFrame, least: int = 100, top: int | None = 2000, text_col: str = "text", lang_col: str = "lang", broadcast_words: int = BROADCAST_WORDS, **sizes) -> DataFrame:
    """Per language the `top` phrases by score: lang, rank, phrase, a, l, r, n, score; all of them, without rank, if top is None.

    A-Z are lower-cased; texts are split at `[.,;:!?\\x0A-\\x0D]` into pieces and these at spaces and tabs into words. Candidates
    are phrases of 2 to 5 words within a piece that occur `least` times or more (a), overlaps included. A cut after the first
    words gives counts l and r of either part and score floor(1000 * a * n / (l * r)), n being all words of the language; the
    least score counts, ties to the shortest head. A candidate inside a longer one as frequent as itself is dropped. Ties of
    score go to the greater a, then to the phrase in byte order.

    A null language is `und`, a null or blank text has no words, repeated rows count each, an empty table gives no rows,
    other columns are not read. sizes: bucket, split, salted, held of phrase_counts.
    """
    source = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    totals, words, few = word_counts(source, least, broadcast_words)
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    found = scored(phrase_counts(source, words, few, n_words, least, **sizes), words, totals)
    if top is None:
        return found
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))  # each task leaves `top` rows a language
    found = found.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
