"""Sharding by a k-d tree over document metadata.

A node of the tree is split at the weighted median of its widest dimension, for k leaves at the share
floor(k/2) / k of its bytes, until each leaf has the target bytes. Medians are found by histograms:
the rows of all nodes of a level are summed by the digits of (coordinate, text hash, id hash), most
significant first, and only the digit that the median falls into is looked at again. Ties in the
coordinate are ordered by text, which keeps equal texts together unless their group is too heavy for
its shard. The nodes are a table: running sums over at most 4,096 digits of a node, and the heavy texts (no
more than shards / slack in all), pick the digit for all nodes of a level at once, and the driver sees only
whether a level is done. So a level takes two passes over its rows, and one or two more where a cut falls
into a heavy text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_key

#: A digit of a key has 12 bits; hashes keep 60.
DIGIT, DIGITS = 12, 5
_ALL = (1 << DIGIT * DIGITS) - 1
#: Bit above a text's hash that is set for texts of which all copies weigh more than a cut may be off: they come last in their coordinate.
_HEAVY = 1 << DIGIT * DIGITS


def category(c: Column) -> Column:
    """Coordinate of a categorical column; null is a category of its own."""
    return F.pmod(F.xxhash64(F.coalesce(c.cast("string"), F.lit("")), c.isNull()), F.lit(1 << DIGIT)).cast("long")


def magnitude(c: Column) -> Column:
    """Coordinate of a count on a logarithmic scale; null and negative values are 0."""
    log = F.log2(F.greatest(F.coalesce(c.cast("double"), F.lit(0.0)), F.lit(0.0)) + 1)
    return F.least(F.floor(log * 64), F.lit((1 << DIGIT) - 1)).cast("long")


def _pick(dims: int, which: str = "dim") -> Column:
    out = F.col("c0")
    for i in range(1, dims):
        out = F.when(F.col(which) == i, F.col(f"c{i}")).otherwise(out)
    return out


def kd_shards(
    docs: DataFrame,
    dims: list[Column],
    n_shards: int | None = None,
    target_bytes: int | None = None,
    slack: float = 0.01,
    id_col: str = "doc_id",
    text_col: str = "text",
    slot_rows: int = 10_000,
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of docs.

    dims: coordinates from 0 to 4,095 (category(), magnitude()). Shards are 0 to n_shards - 1, or as
    many as target_bytes needs. size is the text's UTF-8 bytes and 8 more. Shards have nearly equal
    bytes: a cut is off by at most half of slack of a shard, or half of a document where that is more.
    Equal texts share the least of their coordinates, so they lie together; only a cut inside of a
    group that weighs over slack of a shard parts it. slot numbers the rows of a shard from 0 without gaps,
    in an order given by hashes.

    A null text has size 8 and CRC 0 and lies with other null texts; null ids and repeated rows are rows
    like others, each with its own slot. An empty table gives no rows. Fewer rows than shards leave
    shards empty. Columns of docs that dims don't use are not read.
    """
    spark = docs.sparkSession
    m = len(dims)
    names = [f"c{i}" for i in range(m)]
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(text_col), F.lit(0)).alias("text_crc32"),
        text_key(F.col(text_col)).bitwiseAND(_ALL).alias("h"),
        F.xxhash64(F.lit(1), F.col(id_col)).bitwiseAND(_ALL).alias("d"),
        *[c.alias(n) for c, n in zip(dims, names, strict=True)],
    )
    rows = cut(rows)
    groups = rows.groupBy("h").agg(*[F.min(n).alias(f"g{n}") for n in names], F.sum("size").alias("in_all"), F.count(F.lit(1)).alias("n"))
    groups = cut(groups.where("n > 1").drop("n").withColumnRenamed("h", "gh"))
    rows = rows.join(groups, F.col("h") == F.col("gh"), "left")
    own = [F.coalesce(f"g{n}", n).alias(n) for n in names]
    rows = cut(rows.select("doc_id", "size", "text_crc32", "h", "d", *own, F.coalesce("in_all", "size").alias("in_all")))

    whole = rows.agg(F.sum("size").alias("b"), *[F.max(n).alias(f"hi{n}") for n in names], *[F.min(n).alias(f"lo{n}") for n in names]).first()
    total = whole["b"] or 0
    if n_shards is None:
        n_shards = max(1, math.ceil(total / (target_bytes or max(1, total))))
    span = [max(1, (whole[f"hi{n}"] or 0) - (whole[f"lo{n}"] or 0)) for n in names]
    light = slack * total / n_shards

    # A level has no more nodes than there are shards, so their number needs no counting.
    small_side = F.broadcast if n_shards <= 1_000_000 else lambda df: df
    # A node is its first shard and its number of leaves; a row carries both.
    h = F.when(F.col("in_all") > light, F.col("h").bitwiseOR(_HEAVY)).otherwise(F.col("h")).alias("h")
    columns = ["doc_id", "size", "text_crc32", "d", *names]
    placed = rows.select(*columns, h, F.lit(0).cast("long").alias("shard"), F.lit(n_shards).cast("long").alias("leaves"))
    for depth in range(math.ceil(math.log2(n_shards))):
        widths = [((F.max(n) - F.min(n)) / s).alias(n) for n, s in zip(names, span, strict=True)]
        spread = placed.where("leaves > 1").groupBy(F.col("shard").alias("node"), F.col("leaves").alias("of")).agg(F.sum("size").alias("weight"), *widths)
        widest = F.array_max(F.array(*[F.struct(F.col(n).alias("width"), F.lit(-i).alias("i")) for i, n in enumerate(names)]))["i"]
        level = spread.select(
            "node", "of", F.floor(F.col("of") / 2).alias("left"), (-widest).alias("dim"), (F.col("weight") * F.floor(F.col("of") / 2) / F.col("of")).alias("want"),
            *[F.lit(0).cast("long").alias(f"k{i}") for i in range(3)], F.lit(0).alias("round"), F.lit(False).alias("done"),
        )
        # Most cuts are fixed by the coordinate and one digit of the text's hash, so these two rounds are one plan.
        for _ in range(2):
            level = _narrowed(placed, level, m, light, small_side)
        level = cut(level)
        while not level.where("NOT done").isEmpty():
            level = cut(level.where("done").unionByName(_narrowed(placed, level.where("NOT done"), m, light, small_side)))
        mine = _pick(m)
        less = (mine < F.col("k0")) | (
            (mine == F.col("k0")) & ((F.col("h") < F.col("k1")) | ((F.col("h") == F.col("k1")) & (F.col("d") < F.col("k2"))))
        )
        placed = placed.join(small_side(level.drop("want", "round", "done")), F.col("shard") == F.col("node"), "left")
        leaf = F.col("node").isNull()
        placed = placed.select(
            *columns, "h",
            F.when(leaf | less, F.col("shard")).otherwise(F.col("shard") + F.col("left")).alias("shard"),
            F.when(leaf, F.col("leaves")).when(less, F.col("left")).otherwise(F.col("leaves") - F.col("left")).alias("leaves"),
        )
        if depth % 2:
            placed = cut(placed)
    placed = placed.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "h", "d")
    return _slots(cut(placed), n_shards, slot_rows)


def _narrowed(placed: DataFrame, level: DataFrame, dims: int, light: float, small_side) -> DataFrame:
    """level with the cut of every open node fixed, or one digit of it; nodes that are done stay as they are.

    Round 0 looks at the coordinate, the rounds 1 to 5 at the digits of the text's hash and those up to 10
    at the id's. A heavy text is a digit of its own in round 1, and the ids follow at once. want: the bytes
    that go left of the cut, counted within what the key fixes so far.
    """
    nth = F.col("round") - 1
    part = F.when(F.col("round") == 0, 0).otherwise(F.floor(nth / DIGITS) + 1).cast("int")
    power = lambda digits: F.element_at(F.array(*[F.lit(1 << DIGIT * i) for i in range(DIGITS + 1)]), digits + 1)
    low = F.when(F.col("round") == 0, 0).otherwise(DIGITS - 1 - nth % DIGITS).cast("int")
    nodes = [*level.columns, "part", "low"]
    here = placed.join(small_side(level.withColumns({"part": part, "low": low})), F.col("shard") == F.col("node")).withColumn("k", _pick(dims))
    fixed = ((F.col("part") < 1) | (F.col("k") == F.col("k0"))) & ((F.col("part") < 2) | (F.col("h") == F.col("k1")))
    own = F.when(F.col("part") == 1, F.col("h")).otherwise(F.col("d"))
    known = F.when(F.col("part") == 1, F.col("k1")).otherwise(F.col("k2"))
    above = power(F.col("low") + 1)
    top = F.col("low") == DIGITS - 1
    fixed = fixed & ((F.col("part") == 0) | top | (own - own % above == known - known % above))
    digit = ((own % above - own % power(F.col("low"))) / power(F.col("low"))).cast("long")
    digit = F.when((F.col("part") == 1) & top & (F.col("h") >= _HEAVY), F.col("h")).otherwise(digit)
    # A node that is done passes through as one digit.
    digit = F.when(F.col("done"), F.lit(-1)).when(F.col("part") == 0, F.col("k")).otherwise(digit).alias("digit")
    sums = here.where(F.col("done") | fixed).groupBy(*nodes, digit).agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    one = Window.partitionBy("node").orderBy("digit")
    sums = sums.withColumn("before", F.coalesce(F.sum("b").over(one.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # Sizes are positive, so this is one row a node: the first that reaches want, else the last.
    reached = F.col("before") + F.col("b") > F.col("want")
    picked = sums.withColumn("last", F.lead("digit").over(one).isNull())
    picked = picked.where((reached & (F.col("before") <= F.col("want"))) | (F.col("last") & ~reached))
    before, b = F.col("before"), F.col("b")
    # Within a text's hash the cut may snap to the nearest bound; a light group isn't split.
    small = (F.col("n") == 1) | (b <= F.when(F.col("round") <= DIGITS, light).otherwise(light * 0.25))
    ends = (F.col("round") == 2 * DIGITS) | small
    past = F.when(ends & (F.col("want") - before > before + b - F.col("want")), 1).otherwise(0)
    heavy = (F.col("part") == 1) & (F.col("digit") >= _HEAVY)
    add = F.when(heavy, F.col("digit") + past).otherwise((F.col("digit") + past) * power(F.col("low")))
    open_ = ~F.col("done")
    return picked.select(
        "node", "of", "left", "dim",
        F.when(open_ & ~ends, F.col("want") - before).otherwise(F.col("want")).alias("want"),
        *[F.when(open_ & (F.col("part") == i), F.col(f"k{i}") + add).otherwise(F.col(f"k{i}")).cast("long").alias(f"k{i}") for i in range(3)],
        F.when(heavy, DIGITS + 1).otherwise(F.col("round") + 1).alias("round"),
        (F.col("done") | ends).alias("done"),
    )


def _slots(placed: DataFrame, n_shards: int, slot_rows: int) -> DataFrame:
    """Numbers the rows of each shard: counts of parts of about slot_rows rows, their prefix sum, and the place in the part."""
    parts = max(1, math.ceil(placed.count() / n_shards / slot_rows))
    placed = placed.withColumn("part", F.pmod(F.col("d"), F.lit(parts)))
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("shard", "part").orderBy("d", "h", "doc_id"))
    numbered = placed.withColumn("nth", nth).join(starts, ["shard", "part"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("nth") - 1).cast("long").alias("slot"))
