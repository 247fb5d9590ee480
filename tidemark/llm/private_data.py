"""Personal data: fixed patterns, and information-theoretic sanitisation of the terms around them.

The patterns find the protected entities. How strongly a term reveals an entity is estimated from
their co-occurrence in the corpus: the pointwise mutual information of both against all the
information that the entity has. Terms that leave less than a threshold of it open are reported
wherever they stand, and generalised with the entities.

Everything is DataFrame functions. Offsets are running sums of the lengths of matches and of the gaps
between, made in log2(n) rounds over an array of n matches; terms meet entities by an equality join on
stretches of the text. So the work on a text grows with its length, however dense its matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, cut, free_name, modest, text_key

KINDS = ("email", "ip", "card", "phone", "term")

#: The patterns of the base kinds, written so that Java's engine neither recurses nor rescans a run:
#: a run of the first class starts after another character or where the last match ended, and
#: repeats that can't give anything back are possessive. They match what the plain forms match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A term is a run of four letters or more; in other words, a word of this length between non-letters.
TERM, TERM_LETTERS = r"\p{L}{4,}+", 4
NOT_TERM = r"[^\p{L}]+"

_SPANS = "CAST(array() AS array<struct<kind:int,start:int,end:int,value:string>>)"
_PLACES = "CAST(array() AS array<struct<start:int,end:int,value:string>>)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), value being computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running results of an associative function over an array, by doubling: log2(n) passes over it."""
    powers = F.array(*[F.lit(1 << k) for k in range(31)])

    def over(given: Column) -> Column:
        return F.aggregate(
            F.filter(powers, lambda p: p < F.size(given)),
            given,
            lambda acc, p: F.transform(acc, lambda x, i: F.when(i < p, x).otherwise(join(F.get(acc, i - p), x))),
        )

    return let(values, over)


def located(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the pattern's matches, in code points from 0, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)

    def placed(v: Column) -> Column:
        # Each gap but the last is followed by a match.
        steps = F.zip_with(F.slice(v["gaps"], 1, F.size(v["found"])), v["found"], lambda g, x: g + F.length(x))
        ends = running(steps, lambda a, b: a + b)
        return F.zip_with(
            ends, v["found"], lambda e, x: F.struct((e - F.length(x)).alias("start"), e.alias("end"), x.alias("value"))
        )

    return let(F.struct(found.alias("found"), gaps.alias("gaps")), placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_ip(value: Column) -> Column:
    """Parts up to 255; leading zeros don't count, whatever their number."""
    part = lambda p: F.lpad(F.ltrim(p, F.lit("0")), 3, "0")
    return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (part(p) <= "255"))


def _is_card(value: Column) -> Column:
    d = F.reverse(_digits(value))
    twice = lambda x: F.when(x > 4, x * 2 - 9).otherwise(x * 2)
    nth = lambda i: F.substring(d, i, F.lit(1)).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda acc, i: acc + F.when(i % 2 == 0, twice(nth(i))).otherwise(nth(i))
    )
    return F.when(F.length(d).between(16, 19), total % 10 == 0).otherwise(False)


def _is_phone(value: Column) -> Column:
    return F.length(_digits(value)).between(8, 15)


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end, value) of the base kinds, by kind as listed and then start. kind is its number in KINDS."""
    none = F.expr(_PLACES)
    each = (
        (F.when(F.contains(text, F.lit("@")), located(text, EMAIL)).otherwise(none), None),
        (F.when(text.rlike(r"[0-9]\.[0-9]"), located(text, IP)).otherwise(none), _is_ip),
        (F.when(text.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]"), located(text, CARD)).otherwise(none), _is_card),
        (F.when(F.contains(text, F.lit("+")), located(text, PHONE)).otherwise(none), _is_phone),
    )
    return F.concat(*[_of_kind(i, spans, holds) for i, (spans, holds) in enumerate(each)])


def _of_kind(kind: int, spans: Column, holds) -> Column:
    kept = spans if holds is None else F.filter(spans, lambda s: holds(s["value"]))
    return F.transform(
        kept, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))
    )


def _rows(docs: DataFrame, text_col: str) -> DataFrame:
    """(r, h, text): two 64-bit keys name a text, whatever rows have it. Null is empty."""
    r, h = _keys(text_col)
    return docs.select(r.alias("r"), h.alias("h"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def _keys(text_col: str) -> tuple[Column, Column]:
    text = F.col(f"`{text_col}`")
    return F.xxhash64(F.lit(1), text.isNull(), text), text_key(text)


def _terms(rows: DataFrame) -> DataFrame:
    """(r, h, start, end, term) of all terms of the rows' texts, once for repeated rows."""
    words = rows.select("r", "h", F.explode(located(F.col("text"), TERM)).alias("w"))
    words = words.select("r", "h", F.col("w.start").alias("start"), F.col("w.end").alias("end"), F.lower("w.value").alias("term"))
    return words.dropDuplicates(["r", "h", "start"])


def _stretches(start: Column, end: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(start / width), F.floor(end / width))).alias("stretch")


def _outside(words: DataFrame, mentions: DataFrame, width: int) -> DataFrame:
    """The words that overlap no base span."""
    w = words.select("r", "h", "start", "end", _stretches(F.col("start"), F.col("end") - 1, width))
    s = mentions.select("r", "h", F.col("start").alias("s"), F.col("end").alias("e"), _stretches(F.col("start"), F.col("end") - 1, width))
    inside = w.join(s, ["r", "h", "stretch"]).where("s < end AND start < e").select("r", "h", "start").distinct()
    return words.join(inside, ["r", "h", "start"], "left_anti")


def term_counts(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(term, n_t): the texts that have a term. Rows of like texts are one.

    Every row's terms are counted, partially in each task; what repeated rows count too much is
    taken off again, so that texts are not shuffled to find the repeats.
    """

    def of(df: DataFrame, weight: Column) -> DataFrame:
        words = F.filter(F.split("text", NOT_TERM), lambda w: F.length(w) >= TERM_LETTERS)
        return df.select(F.explode(F.array_distinct(F.transform(words, F.lower))).alias("term"), weight.cast("long").alias("n"))

    counted = of(rows, F.lit(1))
    again = cut(found.groupBy("r", "h").agg(F.count(F.lit(1)).alias("times")).where("times > 1"))
    if not again.isEmpty():
        repeated = rows.join(modest(again), ["r", "h"]).dropDuplicates(["r", "h"])
        counted = counted.unionByName(of(repeated, 1 - F.col("times")))
    return counted.groupBy("term").agg(F.sum("n").alias("n_t"))


#: Coordinates of a signature of word triples, and those of a band, by which near copies are found; coordinates that must agree.
_COORDINATES, _BAND, _AGREE = 40, 4, 24


def witnesses(words: DataFrame) -> DataFrame:
    """(r, witness) of texts that are near copies of another one: near copies have one witness in common.

    words: r, h, start, term. Texts have a signature of minima over their triples of terms. Those that share a band are
    linked to the least of them where _AGREE coordinates are alike (a similarity of about 0.6).
    """
    order = Window.partitionBy("r", "h").orderBy("start")  # one text
    triples = words.select("r", F.xxhash64("term", F.lead("term", 1).over(order), F.lead("term", 2).over(order)).alias("t"))
    least = triples.groupBy("r").agg(*[F.min(F.xxhash64(F.lit(i), "t")).alias(f"m{i}") for i in range(_COORDINATES)])
    least = cut(least.select("r", F.array(*[f"m{i}" for i in range(_COORDINATES)]).alias("own")))
    bands = [F.xxhash64(F.lit(b), *[F.get("own", F.lit(b + i)) for i in range(_BAND)]) for b in range(0, _COORDINATES, _BAND)]
    shared = least.select("r", F.explode(F.array(*bands)).alias("band"))
    first = cut(shared.groupBy("band").agg(F.min("r").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("band").alias("of"), "b"))
    links = shared.join(modest(first), F.col("band") == F.col("of")).where("r <> b").select("r", "b").distinct()
    both = links.join(least, "r").join(least.select(F.col("r").alias("b"), F.col("own").alias("other")), "b")
    alike = F.size(F.filter(F.zip_with("own", "other", lambda x, y: x == y), lambda x: x))
    return connected_components(both.where(alike >= _AGREE).select(F.col("r").alias("a"), "b")).toDF("near", "witness")


def disclosing_terms(
    rows: DataFrame, found: DataFrame, disclosure: float = 0.9, residual: float = 0.75, prior: float = 1.0, reach: int = 80
) -> DataFrame:
    """(entity, term, ic, pmi) where the term discloses the entity. Evidence is counted in texts that are no copies of each other.

    rows: r, h, text; found: r, h, spans. With n texts, n_e of an entity, n_t of a term and n_et that
    have both within `reach` characters, the entity's information is ic = log2(n / n_e) and the term's
    share in it pmi = log2(n n_et / (n_e (n_t + prior))). The term discloses the entity if pmi is at least
    `disclosure` of ic and leaves at most `residual` bits open. The prior stands for texts not seen: a
    pair found in one text alone leaves a whole bit open, one of two texts 0.58 bits. Like texts are one, and
    near copies (witnesses()) that have entities count once in all of n_e, n_t and n_et. Entities
    of fewer texts than that can have no such term and aren't looked at further.
    """
    share = 2.0**-residual
    least = prior * share / (1 - share) if share < 1 else float("inf")
    spans = found.where(F.size("spans") > 0).dropDuplicates(["r", "h"]).select("r", "h", F.explode("spans").alias("s"))
    entity = F.xxhash64("s.kind", F.lower("s.value")).alias("entity")
    mentions = cut(spans.select("r", "h", entity, F.col("s.start").alias("start"), F.col("s.end").alias("end")))
    several = mentions.select("r", "h", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    several = cut(several.where(F.col("n_e") >= least).select("entity"))
    empty = rows.sparkSession.createDataFrame([], "entity long, term string, ic double, pmi double")
    if several.isEmpty():
        return empty
    n = found.select("r", "h").distinct().count()
    own = cut(mentions.join(modest(several), "entity", "left_semi"))
    words = cut(_terms(rows.join(modest(cut(own.select("r", "h").distinct())), ["r", "h"], "left_semi")))
    near_copies = modest(cut(witnesses(words)))
    told_by = lambda df: df.join(near_copies, F.col("r") == F.col("near"), "left").withColumn("g", F.coalesce("witness", "r"))
    by_entity = told_by(own).select("g", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    by_entity = cut(by_entity.where(F.col("n_e") >= least))
    s = own.select("r", "h", "entity", F.col("start").alias("s"), F.col("end").alias("e"), _stretches(F.col("start") - reach, F.col("end") + reach, reach))
    w = words.withColumn("stretch", F.floor(F.col("start") / reach))
    near = w.join(s, ["r", "h", "stretch"]).where((F.col("start") >= F.col("s") - reach) & (F.col("end") <= F.col("e") + reach))
    near = cut(near.select("r", "h", "start", "end", "term", "entity"))
    pairs = told_by(_outside(near, mentions, reach).select("r", "entity", "term").distinct()).select("g", "entity", "term").distinct()
    pairs = cut(pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et")).where(F.col("n_et") >= least))
    if pairs.isEmpty():
        return empty
    copies = told_by(words.select("r", "term").distinct()).groupBy("g", "term").agg((F.count(F.lit(1)) - 1).alias("more")).where("more > 0")
    copies = copies.groupBy("term").agg(F.sum("more").alias("more"))
    known = pairs.join(term_counts(rows, found), "term").join(copies, "term", "left").join(modest(by_entity), "entity")
    known = known.withColumn("n_t", F.col("n_t") - F.coalesce("more", F.lit(0)))
    known = known.where(F.col("n_et") >= share * (F.col("n_t") + prior))
    ic = F.log2(F.lit(float(n)) / F.col("n_e"))
    pmi = F.log2(F.lit(float(n)) * F.col("n_et") / (F.col("n_e") * (F.col("n_t") + prior)))
    return known.select("entity", "term", ic.alias("ic"), pmi.alias("pmi")).where((F.col("ic") > 0) & (F.col("pmi") >= disclosure * F.col("ic")))


def term_spans(docs: DataFrame, text_col: str, reach: int = 80, **thresholds) -> DataFrame | None:
    """(r, h, more): the places of disclosing terms, by start, of the documents that have some; None if no document has."""
    rows = _rows(docs, text_col)
    found = cut(rows.select("r", "h", base_spans(F.col("text")).alias("spans")))
    told = cut(disclosing_terms(rows, found, reach=reach, **thresholds).select("term").distinct())
    if told.isEmpty():
        return None
    words = F.filter(F.split("text", NOT_TERM), lambda w: F.length(w) >= TERM_LETTERS)
    having = rows.select("r", "h", F.explode(F.array_distinct(F.transform(words, F.lower))).alias("term"))
    having = cut(having.join(modest(told), "term", "left_semi").select("r", "h").distinct())
    hits = _terms(rows.join(modest(having), ["r", "h"], "left_semi")).join(modest(told), "term", "left_semi")
    mentions = found.join(modest(having), ["r", "h"], "left_semi").dropDuplicates(["r", "h"]).select("r", "h", F.explode("spans").alias("s"))
    hits = _outside(cut(hits), mentions.select("r", "h", F.col("s.start").alias("start"), F.col("s.end").alias("end")), reach)
    place = F.struct(F.lit(KINDS.index("term")).alias("kind"), "start", "end")
    return cut(hits.groupBy("r", "h").agg(F.array_sort(F.collect_list(place)).alias("more")))


def _with_spans(docs: DataFrame, text_col: str, **options) -> tuple[DataFrame, str]:
    """docs with the spans of every row, and the name of their column."""
    out, r, h, mine, more = docs, *(free_name(docs, x) for x in ("own_r", "own_h", "private_spans", "more_spans"))
    base = F.transform(base_spans(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    hits = term_spans(docs, text_col, **options)
    if hits is None:
        return out.withColumn(mine, base), mine
    keys = _keys(text_col)
    hits = hits.toDF("hit_" + r, "hit_" + h, more)
    same = (F.col(r) == F.col("hit_" + r)) & (F.col(h) == F.col("hit_" + h))
    none = F.expr("CAST(array() AS array<struct<kind:int,start:int,end:int>>)")
    out = out.withColumns({r: keys[0], h: keys[1], mine: base}).join(modest(hits), same, "left")
    out = out.select(*[F.col(f"`{c}`") for c in docs.columns], F.concat(mine, F.coalesce(more, none)).alias(mine))
    return out, mine


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, spans) of every row of docs; spans is an array of (kind, start, end), by kind and start.

    kind is the number in KINDS. Base kinds are the leftmost non-overlapping matches of their patterns
    that hold (IP parts up to 255, cards of 16 to 19 digits with a right check digit, phones of 8 to 15
    digits). term spans are all places of the terms that disclose an entity (disclosing_terms() names the
    options), in this document or another one, unless they overlap a base span. A null or empty text has
    no spans; null ids are allowed; rows of like texts get the same spans and count once as evidence, and so do near
    copies, whatever their ids. Other columns are not read. An empty table gives no rows.
    """
    found, mine = _with_spans(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), "text", **options)
    return found.select("doc_id", F.col(mine).alias("spans"))


def generalised(text: Column, spans: Column, block: int = 128) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named by the first.

    Spans are taken in blocks, and each block cuts its own stretch out of the text, because a cut walks
    the text from its start.
    """
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def merged(v: Column) -> Column:
        heads = F.transform(
            v["o"],
            lambda s, i: F.struct(
                i.alias("i"), s["start"].alias("start"), s["kind"].alias("kind"), ((i == 0) | (s["start"] >= F.get(v["far"], i - 1))).alias("new")
            ),
        )
        end = lambda hd, j: F.coalesce(F.get(v["far"], F.get(hd, j + 1)["i"] - 1), F.element_at(v["far"], -1))
        return let(
            F.filter(heads, lambda x: x["new"]),
            lambda hd: F.transform(
                hd, lambda x, j: F.struct(x["start"].alias("start"), end(hd, j).alias("end"), x["kind"].alias("kind"))
            ),
        )

    def of_block(m: Column, b: Column) -> Column:
        part = F.slice(m, b * block + 1, F.lit(block))
        begin = F.when(b == 0, 0).otherwise(F.get(m, b * block - 1)["end"])

        def joined(v: Column) -> Column:
            def piece(s: Column, i: Column) -> Column:
                before = F.when(i == 0, v["begin"]).otherwise(F.get(v["part"], i - 1)["end"])
                return F.concat(F.substring(v["cut"], before - v["begin"] + 1, s["start"] - before), F.get(names, s["kind"]))

            return F.array_join(F.transform(v["part"], piece), "")

        whole = lambda v: F.struct(
            v["part"].alias("part"),
            v["begin"].alias("begin"),
            F.substring(text, v["begin"] + 1, F.element_at(v["part"], -1)["end"] - v["begin"]).alias("cut"),
        )
        return let(let(F.struct(part.alias("part"), begin.alias("begin")), whole), joined)

    def out(m: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / block).cast("int")), lambda b: of_block(m, b))
        return F.concat(F.array_join(blocks, ""), F.substring(text, F.element_at(m, -1)["end"] + 1, F.length(text)))

    far = let(ordered, lambda o: F.struct(o.alias("o"), running(F.transform(o, lambda s: s["end"]), F.greatest).alias("far")))
    return F.when(text.isNull(), None).when(F.size(spans) > 0, let(let(far, merged), out)).otherwise(text)


def sanitise(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """docs with private_spans (as spans of find_private()) and sanitised: the text with every span generalised to its kind.

    Overlapping spans become one, named by the first. A null text stays null and an empty one empty; null
    ids are allowed; repeated rows stay, each with the same result; an empty table gives an empty one.
    Columns of docs named like a result column, in any case, give way to it.
    """
    result = ("private_spans", "sanitised")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in result])
    found, mine = _with_spans(docs, text_col, **options)
    return found.withColumn("sanitised", generalised(F.col(f"`{text_col}`"), F.col(mine)))
