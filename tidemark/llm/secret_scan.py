"""Secret scans: fixed patterns, and dictionary-primed zstandard novelty.

A candidate is a long token of mixed characters near a sensitive word. Its novelty is the marginal
size it adds to the compressed code around it, under a dictionary of identifiers, as a share of what
random strings of its length and alphabet add there: what the dictionary or the surroundings already
spell costs next to nothing, a secret costs as much as noise, be it hexadecimal or base64.
"""

from __future__ import annotations

import random
import re
import string
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the runs [0-9a-f]+ of 24 characters or more

#: Words that make what follows them sensitive, and the candidates themselves.
_SENSITIVE = re.compile(r"key|secret|token|passw|pwd|auth|credential|private|bearer|signature|certificate", re.ASCII | re.IGNORECASE)
_SENSITIVE_HINTS = ("key", "secret", "token", "passw", "pwd", "auth", "credential", "private", "bearer", "signature", "certificate")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}(?:\.[A-Za-z0-9+/_=-]+)*")
_LAST_PART = re.compile(r"[A-Za-z0-9+/_=-]+\Z")
#: A PEM header makes all up to its END line one candidate; without an END, the base64 lines after it.
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----\s*")
_PEM_LINES = re.compile(r"[A-Za-z0-9+/=]+(?:\r?\n[A-Za-z0-9+/=]+)*")

#: Identifiers and phrases of ordinary code and configuration; the compressor starts from them.
IDENTIFIERS = """
abstract access account action address admin algorithm allow api app application argument array async
attribute auth authorization await base64 begin block body boolean branch buffer build bytes cache call
callback certificate channel char check class client close code column command commit common component
config configuration connect connection const constructor container content context controller cookie
count create credential current data database date debug default delete description destination device
directory document domain double element email enable encoding endpoint entity entry environment error
event example exception execute export expression factory false field file filter final finally float
format function global group handler hash header host html http https identifier image import include
index init input instance integer interface internal item iterator json key label lambda language length
level library license link list listener load local localhost location lock log login long main manager
map master match message metadata method model module name namespace network node null number object
offset open operation option order output package page parameter parent parse password path pattern
payload permission pipeline platform plugin point policy pool port position prefix private process
profile project property protected protocol provider proxy public query queue random range read receive
record reference region register release remote remove render replace report repository request reset
resource response result return role root route runtime schema scope script search secret section secure
select self sequence server service session setting shared signature size socket source stack start state
static status stream string struct style switch symbol system table target task template test text thread
throw time timeout timestamp title token topic trace transaction transform true type union unique unknown
update upload uri url user username utf-8 uuid valid value variable vector version view virtual void
volume web while widget window worker workspace write xml yaml yield getUserById findAllByName AndName OrElse
setValue isEnabled hasNext toString fromJson withDefault onChange newInstance parseInt addAll your-api-key-here changeme example
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef
"""


#: Dates and times of logs and releases; no words, but ordinary text too.
DATES = "2024-01-15T10:20:30 2023-12-31 2022-06-07 2021-11-28 2020-05-04 2019-08-09"


@lru_cache(maxsize=2)
def _primed(words: str = "") -> zstandard.ZstdCompressor:
    """The compressor under a dictionary of words, the most telling ones last."""
    plain = [w for w in IDENTIFIERS.split() if w.isalpha() and w.islower()]
    content = f"{words} {DATES} {' '.join(map(str.capitalize, plain))} {IDENTIFIERS}".encode()
    start = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=19, dict_data=start, write_content_size=False)


def _alphabet(token: str) -> str:
    """Characters of the classes that a token has: digits, letters (to f if none is beyond) and its own signs."""
    hexadecimal = not re.search("[g-zG-Z]", token)
    out = string.digits
    if re.search("[a-z]", token):
        out += "abcdef" if hexadecimal else string.ascii_lowercase
    if re.search("[A-Z]", token):
        out += "ABCDEF" if hexadecimal else string.ascii_uppercase
    return out + "".join(sorted(set(re.sub("[A-Za-z0-9]", "", token))))


@lru_cache(maxsize=4096)
def _noise(alphabet: str, size: int) -> tuple[str, ...]:
    """Random strings to compare with; more of them where chance matters more."""
    r = random.Random(size)
    return tuple("".join(r.choices(alphabet, k=size)) for _ in range(4 if size < 64 else 2))


def novelty(before: str, candidate: str, after: str, words: str = "", step: int = 4096) -> float:
    """Marginal compressed bytes of the candidate in its surroundings, as a share of those of noise of its kind.

    Long candidates are measured in slices of `step` characters.
    """
    compress = _primed(words).compress
    around = (before + "\n" + after).encode()
    least = len(compress(around))
    adds = lambda x: len(compress(around + b"\n" + x.encode())) - least
    alphabet = _alphabet(candidate)
    own = noise = 0.0
    for at in range(0, len(candidate), step):
        part = candidate[at : at + step]
        like = _noise(alphabet, len(part))
        own += adds(part)
        noise += sum(map(adds, like)) / len(like)
    return own / max(1.0, noise)


def _pem_bodies(text: str) -> Iterator[tuple[int, int]]:
    closed = "-----END" in text
    at = 0
    while m := _PEM.search(text, at):
        at = s = m.end()
        e = text.find("-----END", s) if closed else -1
        closed = e >= 0
        if e < 0:
            lines = _PEM_LINES.match(text, s)
            e = lines.end() if lines else s
        e = s + len(text[s:e].rstrip())
        if s < e and _SENSITIVE.search(m[1]):
            at = e
            yield s, e


def _mixed(token: str) -> bool:
    kinds = bool(re.search("[a-z]", token)) + bool(re.search("[A-Z]", token)) + bool(re.search("[0-9]", token))
    return kinds >= 2 and bool(re.search("[0-9]", token))


#: Parts of a token: a word with its capital, capitals, digits, signs.
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+")


@lru_cache(maxsize=256)
def _jumps(alphabet: str) -> float:
    """How often a character of noise begins a part."""
    noise = _noise(alphabet, 4096)[0]
    return (len(_PARTS.findall(noise)) - 1) / (len(noise) - 1)


def jumpiness(token: str) -> float:
    """Parts of a token as a share of those of noise of its kind; identifiers of several words have few."""
    return (len(_PARTS.findall(token)) - 1) / (len(token) - 1) / _jumps(_alphabet(token))


def _candidates(text: str, context: int) -> Iterator[tuple[int, int]]:
    """Tokens that begin within `context` characters after a sensitive word or end within so many before it, on its line or the
    next one to it; each once, with the dotted parts that adjoin it."""
    ends: list[int] | None = None
    tried: set[int] = set()
    seen = 0
    for hint in _SENSITIVE.finditer(text):
        line_end = text.find("\n", hint.end())
        line_end = text.find("\n", line_end + 1) if line_end >= 0 else -1
        line_end = len(text) if line_end < 0 else line_end
        stop = min(hint.end() + context, line_end)
        at = max(seen, hint.end())
        while at <= stop and (m := _CANDIDATE.search(text, at, line_end)) and m.start() <= stop:
            s, e = m.span()
            while s - 1 > at and text[s - 1] == ".":  # shorter parts before it
                part = _LAST_PART.search(text[max(at, s - 1 - 15) : s - 1])
                if not part:
                    break
                s -= 1 + len(part[0])
            at = seen = e
            if e not in tried:
                tried.add(e)
                yield s, e
        if ends is None:
            tokens = [m.span() for m in _CANDIDATE.finditer(text)]
            ends = [e for _, e in tokens]
        for k in range(bisect_right(ends, hint.start()) - 1, -1, -1):
            s, e = tokens[k]
            if e < hint.start() - context or text.count("\n", e, hint.start()) > 1 or e in tried:
                break  # those before it were tried with it, or are too far
            tried.add(e)
            yield s, e


def find_secrets(text: str, least_novelty: float = 0.83, context: int = 160, window: int = 256, words: str = "", least_jumps: float = 0.45) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, ordered by start and kind.

    assign, access and hex are the leftmost non-overlapping matches of their patterns; a match that is
    too short is dropped. A novel span is a candidate near a sensitive word, before or after it, that no base span holds whole,
    whose novelty reaches least_novelty and whose changes of case, digits and signs are no fewer than least_jumps of those of noise.
    `window` characters on each side are the surroundings and words more of the dictionary. A candidate runs to the end of its token and of the
    dotted parts that adjoin it, however long. The body of a PEM block is one candidate, touched or not.
    """
    spans: list[tuple[int, int, int]] = []
    novel = lambda s, e: novelty(text[max(0, s - window) : s], text[s:e], text[e : e + window], words) >= least_novelty
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if any(h in low for h in _SENSITIVE_HINTS):
        for s, e in _pem_bodies(text):
            if _mixed(text[s:e]) and novel(s, e):
                spans.append((s, 3, e))
        base = sorted((s, e) for s, _, e in spans)
        starts, reach = [s for s, _ in base], list(accumulate((e for _, e in base), max))
        for s, e in _candidates(text, context):
            k = bisect_right(starts, s)
            if k and reach[k - 1] >= e:  # a base span holds it
                continue
            if _mixed(text[s:e]) and jumpiness(text[s:e]) >= least_jumps and novel(s, e):
                spans.append((s, 3, e))
    return [(KINDS[k], s, e) for s, k, e in sorted(spans)]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_SPAN_TYPE = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)


def frequent_words(docs: DataFrame, size: int = 4_000, text_col: str = "text") -> str:
    """The `size` words that most rows have, over all rows: runs of 4 to 24 letters A-Z of either case, the most frequent last.

    Secrets are no such words: candidates have digits. Ties go by the word; nulls have none. At most 100 kB.
    The words are ranked in 8 groups first, so the driver sees 8 * size rows at most, however many partitions there are.
    """
    words = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "[^A-Za-z]+"), lambda w: F.length(w).between(4, 24))
    counts = docs.select(F.explode(F.array_distinct(words)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    one = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(8))).orderBy(F.desc("n"), "word")
    counts = counts.withColumn("place", F.row_number().over(one)).where(F.col("place") <= size)
    return " ".join(r.word for r in reversed(counts.orderBy(F.desc("n"), "word").limit(size).collect()))


def scan_secrets(docs: DataFrame, text_col: str = "text", least_novelty: float = 0.83, words: str = "") -> DataFrame:
    """docs with secrets: an array of (kind, start, end), by start and then kind.

    words: the corpus's own words for the dictionary (frequent_words()). One map over the rows; nothing is
    shuffled or dropped. An empty table gives an empty one. A null or empty text has none, repeated rows
    get the same spans, and the work on a text grows with its length. A column of docs named secrets, in
    any case, gives way to the result.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "secrets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(x or "", least_novelty, words=words)] for x in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(_SPAN))], names=[*batch.schema.names, "secrets"])

    return arrow_map(docs, run, T.StructType(docs.schema.fields + [T.StructField("secrets", _SPAN_TYPE)]))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first wins. No spans: the text itself."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: x[1]):
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])
