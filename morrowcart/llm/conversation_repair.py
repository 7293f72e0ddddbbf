"""Conversation structure repair by lightest derivations.

A conversation is legal when its roles' initials match `(s?(ua)+)?`: an optional
system turn, then user and assistant in turn. Each row has a first fault: blank
(nothing but white space), duplicate (role and text of an earlier row) or
truncated (its last visible character does not end a sentence). A repair edits
every row in order: Keep (0), Rerole to user or assistant (2), Delete (3, the
only edit of blank and duplicate rows), and Inserts an empty user or assistant
turn anywhere (2); a truncated row that stays adds 1. The cheapest repair is
wanted, the ASCII-least word of edit initials (its audit) among equals.

Repairs are deductions over a weighted hypergraph. Items are the rows and the
prefixes (rows read, grammar state); a hyperedge derives a longer prefix from a
prefix and a row, or inserts a turn. Values are pairs (cost, audit), combined by
adding costs and appending audits. That is superior (no value is below its
antecedents') and monotone: two derivations of one prefix at one cost are never
a proper prefix of each other, since they edit the same rows and an extra insert
costs more, so what is appended never reorders them. Hence Knuth's agenda: the
least value is popped and final, until the goal is (`lightest`).

At scale: rows move as initials, faults and digests, range-partitioned by
(conversation, turn, role, text), so that a conversation of any size is spread
over ranges. Each range's piece is solved where it is, in blocks of `BLOCK` rows
whose tables of (entry state, exit state) chain associatively; pieces of a
conversation are chained last. Texts move once, after the plans are known, as a
sorted stream: a task holds the audit of one conversation, never its texts. The
SHA-256 of a repaired conversation is sequential by definition, so the stream of
one conversation stays in one task; memory does not grow with its texts.

Null roles and texts count as one space, so they are illegal and blank; null
turns come first, and the null conversation is one like any other. Rows of one
turn are ordered by role and text (its first `HEAD` characters, then its
SHA-256). An empty role is as illegal as an unknown one. Repeated rows are
duplicates. A conversation without rows is legal: no edits. An empty table gives
no rows. Only the four columns named are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Callable, Hashable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

SPACE = " \t\n\x0b\x0c\r"
BLOCK = 256
HEAD = 32
DELETE, REROLE, INSERT, CUT = 3, 2, 2, 1  # costs
START, SYSTEM, USER, ASSISTANT = range(4)  # states of the grammar: nothing read, or the last role
STATES = range(4)
FINAL = (START, ASSISTANT)
_NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_FREE = [(p, role, q) for (p, role), q in _NEXT.items() if role != "s"]  # roles a repair may write

Value = tuple[int, str]
#: head, tail, weight: from the tail's values (in order) and the weight the head's value is combined
Edge = tuple[Hashable, tuple, Value]


def lightest(axioms: dict[Hashable, Value], edges: Iterable[Edge], goals: Callable[[Hashable], bool]) -> dict[Hashable, Value]:
    """Knuth's generalisation of Dijkstra's algorithm: the least (cost, audit)
    of every item, popped in rising order, until all wanted ones are final.

    `goals` is told each final item and returns true when no more is needed."""
    by_tail: dict[Hashable, list] = {}
    for head, tail, weight in edges:
        edge = [len(tail), head, tail, weight]
        for t in tail:
            by_tail.setdefault(t, []).append(edge)
    agenda = [(*v, i, item) for i, (item, v) in enumerate(axioms.items())]
    heapq.heapify(agenda)
    pushed, final = len(agenda), {}
    best = dict(axioms)
    while agenda:
        cost, audit, _, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit)
        if goals(item):
            break
        for edge in by_tail.get(item, ()):
            edge[0] -= 1
            if edge[0] or edge[1] in final:
                continue
            c, a = 0, ""
            for t in edge[2]:
                c, a = c + final[t][0], a + final[t][1]
            got = (c + edge[3][0], a + edge[3][1])
            if edge[1] not in best or got < best[edge[1]]:
                best[edge[1]] = got
                heapq.heappush(agenda, (*got, pushed, edge[1]))
                pushed += 1
    return final


def _edges(initials: str, faults: str) -> list[Edge]:
    n = len(initials)
    out: list[Edge] = [((i, q), ((i, p),), (INSERT, "I")) for i in range(n + 1) for p, _, q in _FREE]
    for i, (role, fault) in enumerate(zip(initials, faults)):
        row = ("row", i)
        out += [((i + 1, p), ((i, p), row), (DELETE, "D")) for p in STATES]
        if fault in "bd":
            continue
        stays = CUT if fault == "t" else 0
        out += [((i + 1, q), ((i, p), row), (REROLE + stays, "R")) for p, _, q in _FREE]
        out += [((i + 1, q), ((i, p), row), (stays, "K")) for (p, r), q in _NEXT.items() if r == role]
    return out


def _rows(n: int) -> dict[Hashable, Value]:
    return {("row", i): (0, "") for i in range(n)}


def solve(initials: str, faults: str) -> Value:
    """(cost, audit) of the cheapest repair. `initials`: s, u, a or x (any other
    role) per row; `faults`: b(lank), d(uplicate), t(runcated) or k (none)."""
    if len(initials) > BLOCK:
        return finish(table(initials, faults))
    n = len(initials)
    edges = _edges(initials, faults) + [("goal", ((n, q),), (0, "")) for q in FINAL]
    return lightest({(0, START): (0, ""), **_rows(n)}, edges, lambda item: item == "goal")["goal"]


Table = dict[tuple[int, int], Value]


def _block_table(initials: str, faults: str) -> Table:
    n, out = len(initials), {}
    for p in STATES:
        missing = set(STATES)

        def done(item):
            if item[0] == n:
                missing.discard(item[1])
            return not missing

        final = lightest({(0, p): (0, ""), **_rows(n)}, _edges(initials, faults), done)
        out |= {(p, q): final[n, q] for q in STATES if (n, q) in final}
    return out


def chain(a: Table, b: Table) -> Table:
    """The table of two pieces, one after the other."""
    out: Table = {}
    for (p, m), (c, x) in a.items():
        for q in STATES:
            if (m, q) in b:
                d, y = b[m, q]
                if (p, q) not in out or (c + d, x + y) < out[p, q]:
                    out[p, q] = (c + d, x + y)
    return out


def _chained(tables: list[Table]) -> Table:
    """Pairwise, so that an audit is copied log2(pieces) times."""
    while len(tables) > 1:
        tables = [chain(*tables[i:i + 2]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
    return tables[0]


def table(initials: str, faults: str) -> Table:
    """Least values from every state before the rows to every state after them."""
    if not initials:
        return {(p, p): (0, "") for p in STATES}
    return _chained([_block_table(initials[i:i + BLOCK], faults[i:i + BLOCK]) for i in range(0, len(initials), BLOCK)])


def finish(t: Table) -> Value:
    return min(t[START, q] for q in FINAL if (START, q) in t)


def edits(audit: str, rows: Iterable[tuple]) -> Iterable[tuple]:
    """(edit, turn, role, text) of the repaired rows; `rows`: (turn, initial, role, text) in order."""
    state, at = START, 0

    def inserts():
        nonlocal state, at
        while audit[at:at + 1] == "I":
            role, state, at = *(("assistant", ASSISTANT) if state == USER else ("user", USER)), at + 1
            yield "I", None, role, ""

    for turn, initial, role, text in rows:
        yield from inserts()
        edit, at = audit[at], at + 1
        if edit == "K":
            state = _NEXT[state, initial]
            yield edit, turn, role, text
        elif edit == "R":
            role, state = ("assistant", ASSISTANT) if state == USER else ("user", USER)
            yield edit, turn, role, text
    yield from inserts()


# ---- Spark ----

def damaged(conversations: DataFrame) -> DataFrame:
    """The damage the registered query repairs: by crc32 of `conv_id:turn` modulo
    20, 0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats
    it, 4 makes it a user's. Nulls count as one space."""
    kind = F.crc32(F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    return (conversations.withColumn("_kind", kind).where("_kind <> 0")
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
                    F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                    F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")).drop("_copy"))


def _prepared(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    t, r = F.coalesce(F.col(text), F.lit(" ")), F.coalesce(F.col(role), F.lit(" "))
    first = F.substring(r, 1, 1)
    seen = F.rtrim(t, F.lit(SPACE))
    return rows.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), r.alias("role"), t.alias("text"),
                       F.when(first.isin("s", "u", "a"), first).otherwise("x").alias("initial"),
                       F.when(seen == "", "b").when(F.right(seen, F.lit(1)).isin(".", "!", "?"), "k").otherwise("t").alias("fault"),
                       F.substring(t, 1, HEAD).alias("head"), F.unhex(F.sha2(t, 256)).alias("digest"))


_ORDER = ["turn", "role", "head", "digest"]  # ascending, nulls first
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_TABLE = T.ArrayType(T.StructType([T.StructField("p", T.IntegerType()), T.StructField("q", T.IntegerType()),
                                   T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]))


def _counted(initials: str, faults: str) -> list[int]:
    legal = sum(initials.count(p) for p in ("su", "ua", "au"))
    return [faults.count(f) for f in "bdt"] + [max(0, len(initials) - 1) - legal]


def _count_type(df: DataFrame) -> list[T.StructField]:
    return [df.schema["conv"], *[T.StructField(c, T.LongType()) for c in _COUNTS]]


def _solved(pieces: DataFrame) -> DataFrame:
    """A piece's counts, ends and value: of the whole conversation, or its table."""
    schema = T.StructType([*_count_type(pieces), T.StructField("part", T.LongType()), T.StructField("ends", T.StringType()),
                           T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("table", _TABLE)])

    def run(batches):
        for b in batches:
            got = []
            for part, initials, faults, whole in zip(*[b.column(i).to_pylist() for i in range(1, 5)]):
                cost, audit = solve(initials, faults) if whole else (None, None)
                cells = None if whole else [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in sorted(table(initials, faults).items())]
                got.append((*_counted(initials, faults), part, initials[0] + initials[-1], cost, audit, cells))
            types = [pa.int64()] * 5 + [pa.string(), pa.int64(), pa.string(), pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))]
            cols = list(zip(*got)) if got else [()] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]], schema.names)

    return pieces.select("conv", "part", "initials", "faults", "whole").mapInArrow(run, schema)


def _joined(parts: DataFrame) -> DataFrame:
    """Conversations that span ranges: their pieces' tables, chained in order."""
    schema = T.StructType([*_count_type(parts), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
    grouped = parts.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", *_COUNTS, "ends", "table"))).alias("pieces"))

    def run(batches):
        for b in batches:
            got = []
            for pieces in b.column(1).to_pylist():
                counts = [sum(p[c] for p in pieces) for c in _COUNTS]
                counts[3] += sum(x["ends"][1] + y["ends"][0] not in ("su", "ua", "au") for x, y in zip(pieces, pieces[1:]))
                got.append((*counts, *finish(_chained([{(c["p"], c["q"]): (c["cost"], c["audit"]) for c in p["table"]} for p in pieces]))))
            cols = list(zip(*got)) if got else [()] * 6
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 5 + [pa.string()])]], schema.names)

    return grouped.mapInArrow(run, schema)


def _ranged(rows: DataFrame, ranges: int | None) -> DataFrame:
    """Rows in order: `at` rises over the whole table. Rows alike in all keys may
    part between ranges (`salt`), which changes nothing, as they are the same."""
    keys = ["conv", *_ORDER, "salt"]
    salted = rows.select("conv", *_ORDER, "initial", "fault", F.monotonically_increasing_id().alias("salt"))
    out = salted.repartitionByRange(ranges, *keys) if ranges else salted.repartitionByRange(*keys)
    return out.sortWithinPartitions(*keys).select("conv", "turn", "role", "digest", "initial", "fault", F.monotonically_increasing_id().alias("at"))


def repair_plans(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 known: DataFrame | None = None, ranges: int | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit): one row
    a conversation of `rows`, and of the ids in `known`, which may have no rows.

    gaps: turns missing between the least and the greatest; illegal: neighbouring
    rows whose initials are not su, ua or au."""
    given = _prepared(rows, conv_id, turn, role, text)
    ordered = stored(_ranged(given, ranges), "repair-order")
    repeated = (ordered.where("fault <> 'b'").groupBy("conv", "role", "digest").agg(F.min("at").alias("first"), F.count("*").alias("n"))
                .where("n > 1").select(F.col("conv").alias("conv2"), F.col("role").alias("role2"), F.col("digest").alias("digest2"), "first"))
    marked = ordered.join(repeated, F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("role") == F.col("role2")) & (F.col("digest") == F.col("digest2")), "left")
    fault = F.when((F.col("fault") != "b") & (F.col("at") > F.col("first")), "d").otherwise(F.col("fault"))
    cells = F.array_sort(F.collect_list(F.struct("at", "initial", fault.alias("fault"))))
    pieces = (marked.groupBy("conv", F.shiftright("at", 33).alias("part")).agg(cells.alias("cells"))
              .select("conv", "part", F.array_join("cells.initial", "").alias("initials"), F.array_join("cells.fault", "").alias("faults")))
    pieces = stored(pieces, "repair-pieces")
    # a range cuts at most one conversation at its start: never more ids than ranges
    spans = pieces.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv").alias("conv2"), F.lit(False).alias("whole"))
    flagged = pieces.join(F.broadcast(spans), F.col("conv").eqNullSafe(F.col("conv2")), "left").withColumn("whole", F.col("whole").isNull())
    solved = stored(_solved(flagged), "repair-solved")
    value = ["conv", *_COUNTS, "cost", "audit"]
    plans = solved.where("table IS NULL").select(value).unionByName(_joined(solved.where("table IS NOT NULL")).select(value))

    turns = ordered.select("conv", "turn")
    if known is not None:
        turns = turns.unionByName(known.select(F.col(conv_id).alias("conv"), F.lit(None).cast(ordered.schema["turn"].dataType).alias("turn")))
    spread = (turns.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv")
              .agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps")).withColumnRenamed("conv", "conv2"))
    both = spread.join(plans, F.col("conv").eqNullSafe(F.col("conv2")), "left")
    zero = [F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in ("gaps", *_COUNTS, "cost")]
    return both.select(F.col("conv2").alias(conv_id), *zero, F.coalesce("audit", F.lit("")).alias("audit"))


def _stream(rows: DataFrame, plans: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one task."""
    given = _prepared(rows, conv_id, turn, role, text).select("conv", F.lit(1).alias("kind"), *_ORDER, "initial", "text")
    null = F.lit(None)
    heads = plans.select(F.col(conv_id).alias("conv"), F.lit(0).alias("kind"), *[null.cast(given.schema[c].dataType).alias(c) for c in (*_ORDER, "initial")], F.col("audit").alias("text"))
    return (given.unionByName(heads).repartition("conv").sortWithinPartitions("conv", "kind", *_ORDER)
            .select("conv", "kind", "turn", "initial", "role", "text"))


def _with_schema(batches):
    """The batches and their Arrow schema (an empty one for an empty partition)."""
    batches = iter(batches)
    first = next(batches, None)
    if first is None:
        return (), pa.schema([(str(i), pa.null()) for i in range(6)])
    return itertools.chain([first], batches), first.schema


def _conversations(batches):
    """(conversation, audit, its rows) of a sorted stream; the rows are read as they come."""
    def flat():
        for b in batches:
            yield from zip(*[b.column(i).to_pylist() for i in range(6)])

    rows, head = flat(), None
    head = next(rows, None)
    while head is not None:
        conv, audit, following = head[0], head[5], None

        def own():
            nonlocal following
            for r in rows:
                if r[1] == 0:
                    following = r
                    return
                yield r[2:]

        part = own()
        yield conv, audit, part
        for _ in part:  # what the caller left unread
            pass
        head = following


def repaired(rows: DataFrame, plans: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, position, edit, turn, role, text): the repaired conversations.
    Inserted rows have no turn."""
    stream = _stream(rows, plans, conv_id, turn, role, text)
    schema = T.StructType([T.StructField(conv_id, stream.schema["conv"].dataType), T.StructField("position", T.LongType()), T.StructField("edit", T.StringType()),
                           T.StructField("turn", stream.schema["turn"].dataType), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches):
        batches, schemas = _with_schema(batches)
        types = [schemas.field(0).type, pa.int64(), pa.string(), schemas.field(2).type, pa.string(), pa.string()]
        out, size = [], 0
        for conv, audit, part in _conversations(batches):
            for i, (edit, t, r, x) in enumerate(edits(audit, part)):
                out.append((conv, i, edit, t, r, x))
                size += len(x) + 50
                if size > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t_) for c, t_ in zip(zip(*out), types)], schema.names)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t_) for c, t_ in zip(zip(*out), types)], schema.names)

    return stream.mapInArrow(run, schema)


def repaired_digests(rows: DataFrame, plans: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """`plans` with `repaired_sha256`, the SHA-256 of the repaired `role:text` rows joined by newlines."""
    kept = plans.select(conv_id, "audit", F.struct(*[c for c in plans.columns if c not in (conv_id, "repaired_sha256")]).alias("plan"))
    stream = _stream(rows, plans, conv_id, turn, role, text)
    schema = T.StructType([stream.schema["conv"], T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        batches, schemas = _with_schema(batches)
        ids, sums = [], []
        for conv, audit, part in _conversations(batches):
            h, between = hashlib.sha256(), b""
            for _, _, r, x in edits(audit, part):
                h.update(between + f"{r}:{x}".encode())
                between = b"\n"
            ids.append(conv)
            sums.append(h.hexdigest())
            if len(ids) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(ids, schemas.field(0).type), pa.array(sums)], schema.names)
                ids, sums = [], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, schemas.field(0).type), pa.array(sums)], schema.names)

    sums = stream.mapInArrow(run, schema)
    return kept.join(sums, F.col(conv_id).eqNullSafe(F.col("conv"))).select(conv_id, "plan.*", "repaired_sha256")
