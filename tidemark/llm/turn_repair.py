"""Conversation structure repair by signatures.

A conversation's rows become a compact string of roles and faults. It is cut into parts of at most PART symbols; each
distinct part is solved once, by memoised recursion, for every state that it may start and end in. Parts of one
conversation combine like matrices over (cost, audit), so a conversation of any length is repaired without being
gathered: first the parts of one task, then one row a task. Audits are joined back and replayed on the rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, ensure_checkpoint_dir, modest, remove

#: Symbols, and bytes of text, after which a part ends.
PART, PART_BYTES = 64, 1 << 20
#: Costs of the edits; TRUNCATED is added for a truncated row that is not deleted. Fixed values.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after the system's turn, after a user's, after an assistant's. An end in 1 or 2 is completed by inserts.
STATES = 4
CLOSING = {0: "", 1: "II", 2: "I", 3: ""}
#: Blanks `[\x20\x09-\x0D]`.
BLANKS = " \t\n\x0b\x0c\r"
_FAR = 1 << 60
_DELETED = "x"


def _asked(state: int) -> int:
    """The state after the turn that is due: a user's, or after one an assistant's."""
    return 3 if state == 2 else 2


def _kept(symbol: str, state: int) -> int | None:
    if symbol == "s":
        return 1 if state == 0 else None
    return _asked(state) if symbol == ("a" if state == 2 else "u") else None


@lru_cache(maxsize=1 << 17)
def _ways(signature: str, state: int) -> tuple[tuple[int, int, str], ...]:
    """(end state, cost, audit) of the cheapest edits of a signature from a state, ties by the audit's order."""
    if not signature:
        return ((state, 0, ""),)
    found: dict[int, tuple[int, str]] = {}
    before, paid = state, ""
    for _ in range(3):  # more than two inserts in a row lead back to a state without them
        for edit, cost, after in _edits(signature[0], before):
            for end, more, audit in _ways(signature[1:], after):
                way = (len(paid) * INSERT + cost + more, paid + edit + audit)
                if end not in found or way < found[end]:
                    found[end] = way
        before, paid = _asked(before), paid + "I"
    return tuple((end, *way) for end, way in sorted(found.items()))


def _edits(symbol: str, state: int) -> Iterator[tuple[str, int, int]]:
    yield "D", DELETE, state
    if symbol != _DELETED:
        extra = TRUNCATED if symbol.isupper() else 0
        if (after := _kept(symbol.lower(), state)) is not None:
            yield "K", extra, after
        yield "R", REROLE + extra, _asked(state)


def solve(signature: str) -> tuple[list[int], list[int], list[str | None]]:
    """Costs, ranks and audits by start * STATES + end. Ranks order the audits of one start; no audit begins another one
    of the same part, so the order of what follows never matters to them."""
    costs, ranks, audits = [_FAR] * STATES**2, [0] * STATES**2, [None] * STATES**2
    for start in range(STATES):
        ways = _ways(signature, start)
        for end, cost, audit in ways:
            costs[start * STATES + end], audits[start * STATES + end] = cost, audit
        for rank, (end, _, _) in enumerate(sorted(ways, key=lambda w: w[2])):
            ranks[start * STATES + end] = rank
    return costs, ranks, audits


def joined(a: tuple[list[int], list[int]], b: tuple[list[int], list[int]]) -> tuple[list[int], list[int]]:
    """Costs and ranks of two stretches in a row."""
    costs, ranks = [_FAR] * STATES**2, [0] * STATES**2
    for start in range(STATES):
        order = []
        for end in range(STATES):
            ways = [(a[0][start * STATES + m] + b[0][m * STATES + end], a[1][start * STATES + m], b[1][m * STATES + end]) for m in range(STATES)]
            cost, first, second = min(ways)
            if cost < _FAR:
                costs[start * STATES + end] = cost
                order.append((first, second, end))
        for rank, (_, _, end) in enumerate(sorted(order)):
            ranks[start * STATES + end] = rank
    return costs, ranks


def best_end(costs: list[int], ranks: list[int], start: int = 0) -> int:
    """The end state of the cheapest whole, closing inserts included."""
    at = start * STATES
    return min(range(STATES), key=lambda t: (costs[at + t] + INSERT * len(CLOSING[t]), ranks[at + t]))


def stations(steps: list[tuple[list[int], list[int]]], start: int, end: int) -> list[int]:
    """The states before, between and after consecutive stretches on the cheapest way from start to end."""
    left = [[_FAR] * STATES for _ in range(len(steps))] + [[0 if t == end else _FAR for t in range(STATES)]]
    for k in range(len(steps) - 1, -1, -1):
        costs = steps[k][0]
        left[k] = [min(costs[s * STATES + t] + left[k + 1][t] for t in range(STATES)) for s in range(STATES)]
    out = [start]
    for k, (costs, ranks) in enumerate(steps):
        at = out[-1] * STATES
        out.append(min(range(STATES), key=lambda t: (costs[at + t] + left[k + 1][t], ranks[at + t])))
    return out


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) of a fixed damage that crc32 of conv_id:turn decides; nulls are one space."""
    kind = F.crc32(F.encode(F.concat_ws(":", _text("conv_id"), _text("turn")), "UTF-8")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(_text("text"), ".!?", "")).otherwise(_text("text"))
    return turns.where(kind != 0).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(_text("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


_PART = (
    "conv_id long, part long, signature string, roles array<string>, texts array<string>, first_kind string, last_kind string,"
    " illegal long, least_turn long, most_turn long, turns long, blank long, duplicate long, truncated long"
)


def _part(conv, part: int, rows: list[tuple]) -> tuple:
    kinds = [r[1] for r in rows]
    turns = [r[4] for r in rows if r[4] is not None]
    fault = [r[0] for r in rows]
    return (
        conv,
        part,
        "".join(_DELETED if f in "-=" else f for f in fault),
        [r[2] for r in rows],
        [r[3] for r in rows],
        kinds[0],
        kinds[-1],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:])),
        turns[0] if turns else None,
        turns[-1] if turns else None,
        len(set(turns)),
        fault.count("-"),
        fault.count("="),
        sum(f.isupper() for f in fault),
    )


def _rows(columns: list[pa.Array]) -> Iterator[tuple]:
    return zip(*[c.to_pylist() for c in columns], strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    kind = lambda t: pa.list_(kinds[t[6:-1]]) if t.startswith("array<") else kinds[t]
    return pa.schema([(c.split()[0], kind(c.split()[1])) for c in ddl.split(",")])


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to parts. A part is named by its task and its place there, which ascend in the order of rows."""
    from pyspark import TaskContext

    task = TaskContext.get().partitionId() << 32

    def parts() -> Iterator[tuple]:
        held, size, conv, n = [], 0, None, 0
        for batch in batches:
            for conv_id, turn, role, text, copies, fault, kind in _rows(batch.columns):
                for nth in range(copies):
                    if held and (conv != conv_id or len(held) == PART or size > PART_BYTES):
                        yield _part(conv, task + n, held)
                        held, size, n = [], 0, n + 1
                    conv, own = conv_id, fault if nth == 0 or fault == "-" else "="
                    kept = own not in "-="
                    held.append((own, kind, role if kept else None, text if kept else None, turn))
                    size += len(text) if kept else 0
        if held:
            yield _part(conv, task + n, held)

    yield from _batches(parts(), _arrow(_PART))


def write_parts(turns: DataFrame, path: str, copies: str | None) -> DataFrame:
    """Writes the parts of rows (conv_id, turn, role, text) to path and reads them; the column copies says how many each stands for.

    Rows stand by turn (nulls first), then role and text. Like rows are counted before the sort, so many copies are one.
    """
    many = F.col(copies) if copies else F.lit(1)
    turns = turns.select(*[F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")], _text("role").alias("role"), _text("text").alias("text"), many.cast("long").alias("copies"))
    digest = [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2")]
    often = turns.groupBy(F.col("conv_id").alias("c"), *digest).agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last"))
    often = modest(cut(often.where("first <> last").select("c", F.col("h1").alias("o1"), F.col("h2").alias("o2"), "first")))
    rows = turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.xxhash64("role", "text") == F.col("o1")) & (F.xxhash64(F.lit(1), "text", "role") == F.col("o2"))
    rows = rows.join(often, same, "left").withColumn("seen", F.coalesce(F.col("first") < F.struct("turn"), F.lit(False)))
    kind = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("o")
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(F.ltrim(bare, F.lit(BLANKS)) == "", "-").when(F.col("seen"), "=").when(F.right(bare, F.lit(1)).isin(".", "!", "?"), kind).otherwise(F.upper(kind))
    rows = rows.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"), kind.alias("kind"))
    order = ("conv_id", "turn", "role", "text")
    arrow_map(rows.repartitionByRange(*order).sortWithinPartitions(*order), _encode, _PART).write.parquet(path)
    return turns.sparkSession.read.schema(_PART).parquet(path)


_SOLVED = "own string, costs array<long>, ranks array<int>, audits array<string>"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batches(((s, *solve(s)) for batch in batches for s in batch.column(0).to_pylist()), _arrow(_SOLVED))


def _lists(row) -> tuple[list[int], list[int]]:
    return [int(x) for x in row.costs], [int(x) for x in row.ranks]


def _fold(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    steps = [_lists(r) for r in rows.itertuples()]
    whole = steps[0]
    for step in steps[1:]:
        whole = joined(whole, step)
    return pd.DataFrame({"c": rows["conv_id"].iloc[:1].astype("Int64"), "task": rows["task"].iloc[:1], "costs": [whole[0]], "ranks": [whole[1]]})


def _place_tasks(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("task")
    steps = [_lists(r) for r in rows.itertuples()]
    whole = steps[0]
    for step in steps[1:]:
        whole = joined(whole, step)
    at = stations(steps, 0, best_end(*whole))
    return pd.DataFrame({"of": rows["c"].astype("Int64"), "at_task": rows["task"], "start": at[:-1], "end": at[1:], "last_task": [k == len(steps) - 1 for k in range(len(steps))]})


def _place_parts(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    at = stations([_lists(r) for r in rows.itertuples()], int(rows["start"].iloc[0]), int(rows["end"].iloc[0]))
    last = [bool(rows["last_task"].iloc[0]) and k == len(rows) - 1 for k in range(len(rows))]
    return pd.DataFrame({"placed": rows["part"], "start": at[:-1], "end": at[1:], "last": last})


def place(parts: DataFrame) -> DataFrame:
    """parts with the way chosen: start (state), edits, cost, last, alone (the conversation's only part)."""
    solved = cut(arrow_map(parts.select("signature").distinct(), _solve, _SOLVED))
    several = cut(parts.groupBy(F.col("conv_id").alias("many")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("many"))
    narrow = parts.select("conv_id", "part", "signature", F.shiftright("part", 32).alias("task"))
    steps = narrow.join(modest(several), F.col("conv_id").eqNullSafe(F.col("many")), "left_semi")
    steps = cut(steps.join(modest(solved), F.col("signature") == F.col("own")).select("conv_id", "part", "task", "costs", "ranks"))
    tasks = steps.groupBy("conv_id", "task").applyInPandas(_fold, "c long, task long, costs array<long>, ranks array<int>")
    tasks = tasks.groupBy("c").applyInPandas(_place_tasks, "of long, at_task long, start int, end int, last_task boolean")
    steps = steps.join(modest(cut(tasks)), F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("task") == F.col("at_task")))
    placed = steps.groupBy("conv_id", "task").applyInPandas(_place_parts, "placed long, start int, end int, last boolean")
    found = parts.join(modest(cut(placed)), F.col("part") == F.col("placed"), "left").join(modest(solved), F.col("signature") == F.col("own"))
    # A conversation's only part starts in 0 and ends where the closing inserts are cheapest.
    closes = F.array(*[F.lit(INSERT * len(CLOSING[t])) for t in range(STATES)])
    ends = F.transform(F.sequence(F.lit(0), F.lit(STATES - 1)), lambda t: F.struct((F.get("costs", t) + F.get(closes, t)).alias("all"), F.get("ranks", t).alias("rank"), t.alias("end")))
    end = F.coalesce("end", F.array_min(ends)["end"])
    found = found.withColumns({"alone": F.col("placed").isNull(), "start": F.coalesce("start", F.lit(0)), "last": F.coalesce("last", F.lit(True)), "end": end})
    way = F.col("start") * STATES + F.col("end")
    closing = F.when(F.col("last"), F.get(F.array(*[F.lit(CLOSING[t]) for t in range(STATES)]), F.col("end"))).otherwise("")
    found = found.withColumns({"edits": F.concat(F.get("audits", way), closing), "cost": F.get("costs", way) + INSERT * F.length(closing)})
    return found.drop("own", "costs", "ranks", "audits", "placed", "signature", "end")


def replay(edits: str, start: int, roles: list, texts: list) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that edits leave or insert."""
    state, at = start, 0
    for edit in edits:
        due = "assistant" if state == 2 else "user"
        if edit == "I":
            yield edit, due, ""
        elif edit != "D":
            yield edit, roles[at] if edit == "K" else due, texts[at]
        if edit == "K" and state == 0 and roles[at].startswith("s"):
            state = 1
        elif edit != "D":
            state = _asked(state)
        at += edit != "I"


_TOLD = "conv_id long, part long, alone boolean, first_kind string, last_kind string, illegal long, least_turn long, most_turn long, turns long, blank long, duplicate long, truncated long, cost long, audit string, body string"


def _tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def told() -> Iterator[tuple]:
        for batch in batches:
            for *head, edits, start, roles, texts in _rows(batch.columns):
                body = "\n".join(f"{role}:{text}" for _, role, text in replay(edits, start, roles, texts))
                yield *head, edits, hashlib.sha256(body.encode()).hexdigest() if head[2] else body

    yield from _batches(told(), _arrow(_TOLD), 64)


_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Whole:
    """A conversation whose parts come in order; its text is hashed as it comes and not held."""

    def __init__(self, conv):
        self.conv, self.sums, self.audit, self.digest, self.began = conv, [0] * 4, [], hashlib.sha256(), False
        self.illegal = self.turns = 0
        self.kind = self.least = self.most = None

    def add(self, first_kind, last_kind, illegal, least, most, turns, *rest):
        *sums, audit, body = rest
        self.illegal += illegal + (self.kind is not None and self.kind + first_kind not in ("su", "ua", "au"))
        self.kind = last_kind
        self.turns += turns - (least is not None and least == self.most)
        self.least = least if self.least is None else self.least
        self.most = self.most if most is None else most
        self.sums = [a + b for a, b in zip(self.sums, sums, strict=True)]
        self.audit.append(audit)
        if body:
            self.digest.update((("\n" if self.began else "") + body).encode())
            self.began = True

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        *faults, cost = self.sums
        return self.conv, gaps, *faults, self.illegal, cost, "".join(self.audit), self.digest.hexdigest()


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def wholes() -> Iterator[tuple]:
        whole = None
        for batch in batches:
            for conv, _, _, *rest in _rows(batch.columns):
                if whole is None or whole.conv != conv:
                    if whole:
                        yield whole.row()
                    whole = _Whole(conv)
                whole.add(*rest)
        if whole:
            yield whole.row()

    yield from _batches(wholes(), _arrow(_REPORT))


def _solved_parts(turns: DataFrame, copies: str | None, make) -> DataFrame:
    """make(parts with their edits), computed; the parts' table is deleted once used."""
    spark = turns.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/turns-{uuid.uuid4().hex}"
    out = cut(make(place(write_parts(turns, path, copies))))
    remove(spark, path)
    return out


def repair_report(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """One row a conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    turns: conv_id, turn, role, text and, if rows stand for several, a column that says for how many; other columns are not
    read. A null role or text is one space, so a null text is blank and a null role neither system, user nor assistant. Null conv_ids are one
    conversation. Rows stand by turn (nulls first), then role and text; repeated rows are duplicates. No rows give no rows.

    A row's first fault counts: blank, duplicate (role and text of an earlier row), truncated (last character not `[.!?]`).
    The audit is the cheapest sequence of Keep, Rerole, Delete and Insert that leaves `(s?(ua)+)?`, the least of like cost.
    """

    def make(parts: DataFrame) -> DataFrame:
        head = [c.split()[0] for c in _TOLD.split(",")][:-2]
        return arrow_map(parts.select(*head, "edits", "start", "roles", "texts"), _tell, _TOLD)

    told = _solved_parts(turns, copies, make)
    gaps = F.coalesce(F.col("most_turn") - F.col("least_turn") + 1 - F.col("turns"), F.lit(0).cast("long"))
    one = told.where("alone").select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("body").alias("repaired_sha256"))
    more = told.where("NOT alone").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return one.unionByName(arrow_map(more, _finish, _REPORT))


_REPAIRED = "conv_id long, part long, nth int, edit string, role string, text string"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for conv, part, edits, start, roles, texts in _rows(batch.columns):
                for nth, row in enumerate(replay(edits, start, roles, texts)):
                    yield conv, part, nth, *row

    yield from _batches(rows(), _arrow(_REPAIRED))


def repaired_turns(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """(conv_id, part, nth, edit, role, text): the repaired conversations, ordered by part and nth within each. Rows as for repair_report."""
    return _solved_parts(turns, copies, lambda parts: arrow_map(parts.select("conv_id", "part", "edits", "start", "roles", "texts"), _repaired, _REPAIRED))


def all_conversations(report: DataFrame, turns: DataFrame) -> DataFrame:
    """The report with a row for every conv_id of turns: zeros, no audit and the hash of nothing where all rows are gone."""
    ids = turns.select(F.col("conv_id").cast("long").alias("id")).distinct()
    found = ids.join(report, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select(F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
