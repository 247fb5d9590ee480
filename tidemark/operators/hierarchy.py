"""Adjacency lists (id, reports_to): levels, ancestors that are kept, counts of descendants, and the closure.

All double the distance that is known in each round, so a tree of depth n takes log2(n) joins of written tables, whatever
its depth or its rows. Counts and kept ancestors carry sums and marks, a row a node; only closure(), whose result are pairs,
makes pairs. Ids may have several parents: then a way is a row, and it ends before it comes to a node again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import cut


def _edges(nodes: DataFrame) -> tuple[DataFrame, bool]:
    """(id, reports_to) without repeats, and whether an id has more than one parent."""
    edges = cut(nodes.select("id", "reports_to").distinct())
    return edges, not edges.groupBy("id").count().where("count > 1").isEmpty()


def _within(edges: DataFrame) -> DataFrame:
    """(id, up) without repeats, up null where the parent is no node."""
    ids = edges.select(F.col("id").alias("known")).distinct()
    return cut(edges.join(ids, F.col("reports_to") == F.col("known"), "left").select("id", F.col("known").alias("up")).distinct())


def closure(nodes: DataFrame, depth: int | None = None) -> DataFrame:
    """(descendant, ancestor, distance >= 1) of an adjacency list, however deep it is; with several parents a row a way.

    A way up ends where it comes to a node for the second time, so cycles end. Ancestors that are no nodes
    are left out. Only where depth is given are ways cut, at that distance, and cycles are followed up to it.
    """
    edges, several = _edges(nodes)
    up = edges.where("reports_to IS NOT NULL").select(F.col("id").alias("descendant"), F.col("reports_to").alias("ancestor"), F.lit(1).cast("long").alias("distance"))
    if depth is not None:
        reach = _stepped(up, depth)
    elif several:
        reach = _ways_up(up)
    else:
        reach = _doubled(up)
    return reach.join(edges.select(F.col("id").alias("ancestor")), "ancestor", "left_semi").select("descendant", "ancestor", "distance")


def _stepped(up: DataFrame, depth: int) -> DataFrame:
    """Ways of up to depth steps, a step a round."""
    reach = last = up = cut(up)
    step = up.select(F.col("descendant").alias("via"), F.col("ancestor").alias("next"))
    for k in range(2, depth + 1):
        last = cut(last.join(step, F.col("ancestor") == F.col("via")).select("descendant", F.col("next").alias("ancestor"), F.lit(k).cast("long").alias("distance")))
        if last.isEmpty():
            break
        reach = reach.unionByName(last)
    return reach


def _doubled(up: DataFrame) -> DataFrame:
    reach, known = cut(up), 1
    while True:
        far = reach.where(F.col("distance") == known).select("descendant", F.col("ancestor").alias("via"))
        on = reach.select(F.col("descendant").alias("via"), "ancestor", (F.col("distance") + known).alias("distance"))
        more = cut(far.join(on, "via").select("descendant", "ancestor", "distance"))
        if more.isEmpty():
            return reach
        reach = reach.unionByName(more)
        # A way comes back at the second place of an ancestor, or at the first of the node itself.
        back = reach.groupBy("descendant", "ancestor").agg(F.array_sort(F.collect_list("distance")).alias("at"))
        again = F.when(F.col("descendant") == F.col("ancestor"), F.get("at", F.lit(0))).otherwise(F.get("at", F.lit(1)))
        ends = back.groupBy(F.col("descendant").alias("of")).agg(F.min(again).alias("end")).where("end IS NOT NULL")
        reach = cut(reach.join(ends, F.col("descendant") == F.col("of"), "left").where("end IS NULL OR distance <= end").select("descendant", "ancestor", "distance"))
        known *= 2


def _ways_up(up: DataFrame) -> DataFrame:
    """All ways up where ids have several parents; trail holds the nodes before the ancestor, by which a way knows its end."""
    reach, known = cut(up.withColumn("trail", F.array("descendant"))), 1
    while True:
        going = ~F.array_contains("trail", F.col("ancestor"))
        far = reach.where((F.col("distance") == known) & going).select(F.col("descendant").alias("from"), F.col("ancestor").alias("via"), F.col("trail").alias("before"))
        more = far.join(reach, F.col("via") == F.col("descendant")).where(~F.arrays_overlap("before", "trail"))
        more = cut(more.select(F.col("from").alias("descendant"), "ancestor", (F.col("distance") + known).alias("distance"), F.concat("before", "trail").alias("trail")))
        if more.isEmpty():
            return reach.select("descendant", "ancestor", "distance")
        reach = reach.unionByName(more)
        known *= 2


def levels(nodes: DataFrame, depth: int | None = None) -> DataFrame:
    """(id, level, path) from the roots down, to the last level or to depth. Nodes whose parent doesn't exist are in no tree
    and are left out, like those of a cycle. With several parents an id has a row for each way down, and is not entered again
    below itself.
    """
    edges, several = _edges(nodes)
    trail = F.array("id") if several else F.col("id").cast("string")
    known = cut(edges.select("id", F.col("reports_to").alias("up"), trail.alias("path"), F.lit(1).cast("long").alias("n")))
    rooted = known.where("up IS NULL").count()
    whole = F.concat("before", "path") if several else F.concat_ws("/", "before", "path")
    while True:
        above = known.select(F.col("id").alias("via"), F.col("up").alias("next"), F.col("path").alias("before"), F.col("n").alias("more"))
        # Ways that begin at a root are done; those that have lost their way, or come back to a node, drop out here.
        on = known.where("up IS NOT NULL").join(above, F.col("up") == F.col("via"))
        if several:
            on = on.where(~F.arrays_overlap("before", "path"))
        on = on.select("id", F.col("next").alias("up"), whole.alias("path"), (F.col("n") + F.col("more")).alias("n"))
        known = cut(known.where("up IS NULL").unionByName(on))
        now = known.where("up IS NULL").count()
        if now == rooted:  # no way of these lengths, so none of a greater one
            break
        rooted = now
    path = F.array_join(F.col("path").cast("array<string>"), "/") if several else F.col("path")
    found = known.where("up IS NULL").select("id", (F.col("n") - 1).alias("level"), path.alias("path"))
    return found if depth is None else found.where(F.col("level") <= depth)


def with_ancestors(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id) of the wanted nodes and of all that stand above one of them.

    In each round nodes are marked whose descendants at the known distance are marked, and the distance doubles; the jumps
    are a row a node in a tree. A round that marks nothing is the last: marks come at all distances up to the greatest.
    """
    edges, _ = _edges(nodes)
    jump = _within(edges).where("up IS NOT NULL")
    marked = cut(edges.select("id").join(wanted.select("id"), "id", "left_semi").distinct())
    count = marked.count()
    while True:
        above = jump.join(marked, "id").select(F.col("up").alias("id"))
        marked = cut(marked.unionByName(above).distinct())
        now = marked.count()
        if now == count:
            return marked
        count = now
        jump = cut(jump.join(jump.select(F.col("id").alias("via"), F.col("up").alias("next")), F.col("up") == F.col("via")).select("id", F.col("next").alias("up")).distinct())


def _leapt(t: DataFrame, known: DataFrame) -> DataFrame:
    """t (id, up, ...) with the node that is as far above up as up is above id."""
    return t.join(known.select(F.col("id").alias("via"), F.col("up").alias("next")), F.col("up") == F.col("via"), "left")


def _sums(own: DataFrame) -> DataFrame:
    """(id, up, size): nodes of each subtree, its root included; up stays only with nodes that lead into a cycle.

    Subtrees known up to a distance get those of the nodes that stand so far below; then the distance doubles.
    """
    t = cut(own.select("id", "up", F.lit(1).cast("long").alias("size")))
    open_ = t.where("up IS NOT NULL").count()
    while open_:
        more = t.where("up IS NOT NULL").groupBy(F.col("up").alias("of")).agg(F.sum("size").alias("more"))
        t = cut(_leapt(t.join(more, F.col("id") == F.col("of"), "left"), t).select("id", F.col("next").alias("up"), (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")))
        now = t.where("up IS NOT NULL").count()
        if now == open_:  # no node of these depths, so none of a greater one
            break
        open_ = now
    return t


def _cycles(own: DataFrame) -> DataFrame:
    """(id, cycle) of the nodes on cycles, cycle being the least of them; all nodes of own lead into one."""
    jump = own
    count = jump.select("up").distinct().count()
    while True:
        jump = cut(_leapt(jump, jump).select("id", F.col("next").alias("up")))
        now = jump.select("up").distinct().count()
        if now == count:  # a leap from these nodes meets each of them again
            break
        count = now
    on = jump.select(F.col("up").alias("id")).distinct()
    t = cut(own.join(on, "id", "left_semi").select("id", "up", F.least("id", "up").alias("cycle")))
    while True:
        ahead = t.select(F.col("id").alias("via"), F.col("up").alias("next"), F.col("cycle").alias("seen"))
        t = cut(t.join(ahead, F.col("up") == F.col("via")).select("id", F.col("next").alias("up"), F.least("cycle", "seen").alias("cycle"), F.col("cycle").alias("before")))
        if t.where("cycle <> before").isEmpty():
            return t.select("id", "cycle")


def descendant_counts(nodes: DataFrame) -> DataFrame:
    """(id, direct_reports, descendants) of every node; nodes of a cycle are descendants of each other and of themselves.

    With one parent each, a row a node and round. With several, the pairs of closure() are counted, each descendant once.
    """
    edges, several = _edges(nodes)
    own = _within(edges)
    direct = own.where("up IS NOT NULL").groupBy(F.col("up").alias("boss")).agg(F.count(F.lit(1)).alias("direct_reports"))
    if several:
        below = closure(nodes).groupBy(F.col("ancestor").alias("of")).agg(F.count_distinct("descendant").alias("descendants"))
        below = edges.select("id").distinct().join(below, F.col("id") == F.col("of"), "left").select("id", F.coalesce("descendants", F.lit(0).cast("long")).alias("descendants"))
    else:
        sums = _sums(own)
        below = sums.where("up IS NULL").select("id", (F.col("size") - 1).alias("descendants"))
        if not (bound := cut(own.join(sums.where("up IS NOT NULL").select("id"), "id", "left_semi"))).isEmpty():
            below = below.unionByName(_below_cycles(bound))
    found = below.join(direct, F.col("id") == F.col("boss"), "left")
    return found.select("id", F.coalesce("direct_reports", F.lit(0).cast("long")).alias("direct_reports"), "descendants")


def _below_cycles(own: DataFrame) -> DataFrame:
    """(id, descendants) where all nodes lead into cycles: these are trees once the cycles are cut."""
    cycles = _cycles(own).withColumnRenamed("id", "on")
    cut_ = own.join(cycles, F.col("id") == F.col("on"), "left").select("id", F.when(F.col("on").isNull(), F.col("up")).alias("up"), "cycle")
    sums = _sums(cut_).select("id", "size").join(cycles, F.col("id") == F.col("on"), "left")
    wholes = sums.where("cycle IS NOT NULL").groupBy(F.col("cycle").alias("c")).agg(F.sum("size").alias("whole"))
    return sums.join(wholes, F.col("cycle") == F.col("c"), "left").select("id", F.coalesce("whole", F.col("size") - 1).alias("descendants"))
