"""Quality rules: text statistics and zstandard compression bands.

A text is compressed whole and in fixed chunks. Repetitive text compresses too well and noise too
badly; how well clean prose compresses depends on the length, so the limits are a table over bytes.
fit_bands() takes the table from all documents that are labelled good; without such labels the wide
limits of Bands() hold, which any prose meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, cut, modest, texts


@dataclass(frozen=True)
class Bands:
    """Limits of compressed / raw bytes by raw length.

    limits: (bytes from, least ratio, most ratio), ascending. Prose in Latin script compresses at
    level 3 to about 0.6 of 500 bytes and 0.42 of 20 kB; random base64 stays at 0.77 and random hex
    at 0.57. The lower limits are about half of what prose reaches, the upper ones between prose and
    base64. Below the first length frame overhead dominates and no band applies.
    chunk: bytes of a chunk. bad_chunks: share of the chunks' bytes that may lie outside of their
    band; the chunks are judged by the same table.
    """

    limits: tuple[tuple[int, float, float], ...] = (
        (256, 0.30, 0.88),
        (512, 0.26, 0.80),
        (1024, 0.23, 0.74),
        (2048, 0.21, 0.72),
        (8192, 0.19, 0.70),
        (65536, 0.15, 0.70),
    )
    chunk: int = 4096
    bad_chunks: float = 0.5
    level: int = 3

    def verdict(self, size: int, compressed: int) -> int:
        """-1 repetitive, 1 incompressible, 0 within the band."""
        low, high = 0.0, float("inf")
        for start, lo, hi in self.limits:
            if size < start:
                break
            low, high = lo, hi
        return -1 if compressed < low * size else 1 if compressed > high * size else 0


_SPACES = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOL = bytes(b for b in range(256) if b not in _SYMBOLS)
_CONTINUATION = bytes(range(0x80, 0xC0))


def text_statistics(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text.

    Words are runs of bytes other than space and \\x09-\\x0D.
    """
    words = text.split()
    n = len(words)
    word_chars = len(text.translate(None, _SPACES + _CONTINUATION))
    symbols = len(text.translate(None, _NOT_SYMBOL))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if n >= 3:
        first: dict[tuple[bytes, bytes, bytes], int] = {}
        again: list[int] = []
        put = first.setdefault
        for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)):
            j = put(w, i)
            if j != i:
                again.append(i)
                again.append(j)
        end = 0
        for i in sorted(set(again)):
            repeated += i + 3 - max(i, end)
            end = i + 3
    return n, word_chars, symbols, len(lines) - len(set(lines)), repeated


def compression(text: bytes, compressor: zstandard.ZstdCompressor, bands: Bands) -> tuple[float | None, float, int]:
    """Ratio of the whole text, share of bytes in chunks outside of their band, and the verdict."""
    size = len(text)
    if not size:
        return None, 0.0, 0
    whole = len(compressor.compress(text))
    verdict = bands.verdict(size, whole)
    bad = 0
    if size > bands.chunk:
        for i in range(0, size, bands.chunk):
            part = text[i : i + bands.chunk]
            if bands.verdict(len(part), len(compressor.compress(part))):
                bad += len(part)
    elif verdict:
        bad = size
    return whole / size, bad / size, verdict


RESULT = (
    ("n_words", T.LongType(), pa.int64()),
    ("word_chars", T.LongType(), pa.int64()),
    ("n_symbols", T.LongType(), pa.int64()),
    ("n_dup_lines", T.LongType(), pa.int64()),
    ("n_repeat_words", T.LongType(), pa.int64()),
    ("base_failed", T.BooleanType(), pa.bool_()),
    ("zstd_ratio", T.DoubleType(), pa.float64()),
    ("bad_chunk_share", T.DoubleType(), pa.float64()),
    ("kept", T.BooleanType(), pa.bool_()),
)


def _measured(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=level)
        for batch in batches:
            found = [(len(x), len(compressor.compress(x)), len(x.split()) >= 50) for x in texts(batch)]
            columns = [batch.column(0), *(pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.bool_()), strict=True))]
            if found:
                yield pa.RecordBatch.from_arrays(columns, names=["own_id", "size", "compressed", "enough"])

    return run


def band_starts(sizes: np.ndarray, counts: np.ndarray, per_band: int, least: int) -> tuple[list[int], int]:
    """First sizes of bands of a quarter of an octave or more, with per_band texts each, and the first size beyond them.

    sizes: distinct and ascending, each of counts texts.
    """
    counts, sizes = counts[sizes >= least], sizes[sizes >= least]
    upto = np.cumsum(counts)
    n = int(upto[-1]) if len(upto) else 0
    starts, start, done = [], float(least), 0
    while n - done >= per_band:
        end = start * 2**0.25
        stop = max(int(np.searchsorted(sizes, end)), int(np.searchsorted(upto, done + per_band)) + 1)
        if n - int(upto[stop - 1]) < per_band:
            stop = len(sizes)
        starts.append(math.ceil(start))
        done, start = int(upto[stop - 1]), max(end, float(sizes[stop - 1]) + 1)
    return starts, math.ceil(start)


def _limits(bands: list[tuple[int, float, float]], beyond: int, margin: float, wide: Bands) -> tuple[tuple[int, float, float], ...]:
    """The table of bands (start, low quantile, high quantile) with the margin; beyond them, and where there are none, the wide limits hold."""
    if not bands:
        return wide.limits
    out = [(start, low * (1 - margin), high * (1 + margin)) for start, low, high in bands]
    here = [x for x in wide.limits if x[0] <= beyond][-1:]
    return (*out, *((beyond, lo, hi) for _, lo, hi in here), *(x for x in wide.limits if x[0] > beyond))


def limits_of(sizes: np.ndarray, ratios: np.ndarray, tail: float, margin: float, per_band: int, wide: Bands) -> tuple[tuple[int, float, float], ...]:
    """The table of fit_bands() for texts at hand: quantiles of the ratios of each band of band_starts(), and the margin."""
    starts, beyond = band_starts(*np.unique(sizes, return_counts=True), per_band, wide.limits[0][0])
    bands = []
    for start, end in zip(starts, [*starts, beyond][1:], strict=True):
        own = ratios[(sizes >= start) & (sizes < end)]
        bands.append((start, float(np.quantile(own, tail)), float(np.quantile(own, 1 - tail))))
    return _limits(bands, beyond, margin, wide)


def _of_good(docs: DataFrame, good: DataFrame, level: int) -> DataFrame:
    """(own_id, size, compressed, enough) of the texts of docs (own_id, text) whose ids are good; no text is shuffled.

    Up to 1,000,000 ids are broadcast, so that only their texts are compressed; beyond, all are, and the sizes meet the ids.
    """
    same = F.col("own_id") == F.col("sample_id")
    kind = docs.schema["own_id"].dataType.simpleString()
    measured = lambda rows: arrow_map(rows.select("own_id", "text"), _measured(level), f"own_id {kind}, size long, compressed long, enough boolean")
    few = modest(good)
    return measured(docs.join(few, same, "left_semi")) if few is not good else measured(docs).join(good, same, "left_semi")


def fit_bands(
    docs: DataFrame,
    labels: DataFrame,
    tail: float = 0.002,
    margin: float = 0.02,
    per_band: int = 50,
    wide: Bands | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Bands:
    """Bands from all documents that labels calls good (quality = 1, 50 words or more).

    A band reaches from the exact `tail` to the 1 - tail quantile of its documents' ratios, and `margin` further.
    Spark counts the documents by size and takes the quantiles by band, so the driver sees neither: it gets the counts by
    size (by 16 significant bits of it, so up to some 500,000 whatever the input) and the quantiles. Null ids are left out,
    ids repeated in docs count once. Without labels, or with fewer good documents than per_band, the result is the wide table.
    """
    wide = wide or Bands()
    good = cut(labels.where("quality = 1").select(F.col(id_col).alias("sample_id")).where("sample_id IS NOT NULL").distinct())
    found = _of_good(docs.select(F.col(id_col).alias("own_id"), F.col(text_col).alias("text")), good, wide.level)
    found = found.groupBy("own_id").agg(F.min(F.struct("size", "compressed", "enough")).alias("x")).where("x.enough AND x.size > 0")
    found = cut(found.groupBy("x.size", "x.compressed").agg(F.count(F.lit(1)).alias("n")))
    step = F.expr("shiftleft(1L, greatest(0, length(bin(size)) - 16))")
    by_size = found.groupBy((F.col("size") - F.col("size") % step).alias("size")).agg(F.sum("n").alias("n")).collect()
    sizes, counts = np.array(sorted((r.size, r.n) for r in by_size), np.int64).reshape(-1, 2).T
    starts, beyond = band_starts(sizes, counts, per_band, wide.limits[0][0])
    if not starts:
        return wide
    band = sum((F.col("size") >= x).cast("int") for x in starts)
    quantiles = F.percentile(F.col("compressed") / F.col("size"), [tail, 1 - tail], F.col("n")).alias("q")
    rows = found.where(F.col("size").between(starts[0], beyond - 1)).groupBy(band.alias("band")).agg(quantiles).collect()
    return replace(wide, limits=_limits(sorted((starts[r.band - 1], *r.q) for r in rows), beyond, margin, wide))


def quality_rules(docs: DataFrame, bands: Bands | None = None, text_col: str = "text") -> DataFrame:
    """docs with the statistics of text_statistics(), base_failed, zstd_ratio, bad_chunk_share and kept.

    base_failed: n_words < 50, or over half of the words lie in repeated 3-word windows. kept: the base
    passes, the whole text's ratio lies in the band of its length, and at most bands.bad_chunks of its
    bytes lie in chunks outside of theirs. One map over the rows: nothing is shuffled, dropped or
    gathered. A null text counts as empty: no words, so it fails; its zstd_ratio is null. Repeated rows
    are judged alike. Columns of docs named like a result column, in any case, give way to it.
    An empty table gives an empty one.
    """
    bands = bands or Bands()
    names = [n for n, _, _ in RESULT]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            rows = []
            for text in texts(batch, text_col):
                stats = text_statistics(text)
                n, repeated = stats[0], stats[4]
                failed = n < 50 or 100 * repeated > 50 * n
                ratio, bad, verdict = compression(text, compressor, bands)
                rows.append((*stats, failed, ratio, bad, not failed and not verdict and bad <= bands.bad_chunks))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            arrays = [pa.array(c, kind) for c, (_, _, kind) in zip(columns, RESULT, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *names])

    return arrow_map(docs, run, T.StructType(docs.schema.fields + [T.StructField(n, t) for n, t, _ in RESULT]))
