"""Repair of conversations' structure at least cost, by a rank-compressed dynamic programme over their rows.

A conversation's rows, in order of turn, become one whose roles' initials are `(s?(ua)+)?`. Keep costs 0, Rerole (to user or
assistant) 1, Delete 2, Insert (a row without text) 5; a row that is blank or repeats an earlier one has to be deleted, one
that is cut off and stays costs 5 more. Of the cheapest repairs the one is taken whose audit, the edits' initials in order, is
least in ASCII order.

1. Each row is one macro edit: a run of up to two inserts and the row's own edit (three and more are never cheapest). No
   macro begins another one, so audits of the same rows compare like their lists of macros, and a macro's
   place in ASCII order is its code.
2. A layer of the programme holds for each of four states (nothing yet, after s, u, a) the least cost, the rank of its audit among
   the layer's, and a pointer to the state before and the macro. Two audits compare by the ranks they come from, then
   by macro, so no audit is ever spelt out. Costs of a layer count from its least; a state that is SPARE above
   it cannot be on a cheapest way and goes, so there are few different layers, and steps between them are kept.
3. Rows are sorted and cut to segments of SEGMENT rows at most, whatever their conversation, so a long one is spread over many
   tasks. A segment is solved for each of four states before it, which gives costs and ranks of all four states behind it;
   these 4 by 4 tables, one a segment, are folded along a conversation. With the states on the cheapest way known, every segment follows
   its pointers back.
4. Kept rows get their texts by a join on the row's identity: conversation, turn, role and digest of the text.

Defined results: null roles and texts are one space, null conversation ids are one conversation, null turns come first; rows of one
turn are taken by role, then by the SHA-256 of the text; repeated rows all count, all but the first as duplicates; a role without an
initial of s, u, a (the empty one, too) can only be given a new role or deleted; texts are read whole; a conversation all of whose
rows go has an empty repair; an empty table gives none; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lychgate.llm.common import small_batches, to_arrow, written

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
SEGMENT = 8_192
SPARE = 30
SPACE = " \t\n\x0b\f\r"
ENDS = ".!?"
USER, ASSISTANT = "user", "assistant"
#: Kinds of rows' initials and of rows, and states of the programme.
SYSTEM, ASKS, ANSWERS, OTHER = range(4)
FINE, OPEN, GONE = range(3)
NOTHING, AFTER_S, AFTER_U, AFTER_A = STATES = range(4)
#: The state that a row of a role leads to.
STEPS = {(NOTHING, SYSTEM): AFTER_S, (NOTHING, ASKS): AFTER_U, (AFTER_S, ASKS): AFTER_U, (AFTER_U, ANSWERS): AFTER_A, (AFTER_A, ASKS): AFTER_U}
MACROS = sorted("I" * n + edit for n in range(3) for edit in "DKR")
#: Inserts that end a repair.
TAILS = {NOTHING: 0, AFTER_S: 2, AFTER_U: 1, AFTER_A: 0}
FAULTS = ("blank", "duplicate", "truncated")


def _role(state: int) -> int:
    """The role that an inserted or changed row takes."""
    return ANSWERS if state == AFTER_U else ASKS


@cache
def ways(state: int, code: int) -> list[tuple[int, int, int]]:
    """(cost, macro, state after) of a row; code: 4 times its kind and its initial's kind."""
    kind, role = divmod(code, 4)
    out = []
    for n in range(3):
        if n:
            state = STEPS[state, _role(state)]
        edits = [("D", DELETE, state)]
        if kind != GONE:
            more = CUT_OFF if kind == OPEN else 0
            edits.append(("R", REROLE + more, STEPS[state, _role(state)]))
            if (state, role) in STEPS:
                edits.append(("K", KEEP + more, STEPS[state, role]))
        out += [(n * INSERT + cost, MACROS.index("I" * n + edit), after) for edit, cost, after in edits]
    return out


#: A layer: for each state its cost above the least and its rank, or None.
Layer = tuple


def ordered(found: list) -> tuple[int, Layer, tuple]:
    """(least cost, layer, pointers) of found: for each state (cost, rank of the state before, macro, that state) or None."""
    least = min(x[0] for x in found if x)
    found = [x if x and x[0] - least <= SPARE else None for x in found]
    order = sorted(x[1:3] for x in found if x)
    return least, tuple((x[0] - least, order.index(x[1:3])) if x else None for x in found), tuple((x[3], x[2]) if x else None for x in found)


@cache
def step(layer: Layer, code: int) -> tuple[int, Layer, tuple]:
    """The layer behind a row: what its least cost adds, the layer, and a pointer (state before, macro) for each state."""
    found: list = [None] * 4
    for state, held in enumerate(layer):
        if held:
            for cost, macro, after in ways(state, code):
                way = (held[0] + cost, held[1], macro, state)
                if found[after] is None or way < found[after]:
                    found[after] = way
    return ordered(found)


def begun(state: int) -> Layer:
    return tuple((0, 0) if s == state else None for s in STATES)


def table_of(codes: bytes) -> list[int]:
    """Costs (-1 where there is no way) and ranks from each state before the rows to each one behind, 32 numbers."""
    out = []
    for state in STATES:
        total, layer = 0, begun(state)
        for code in codes:
            added, layer, _ = step(layer, code)
            total += added
        out += [x for held in layer for x in ((total + held[0], held[1]) if held else (-1, 0))]
    return out


def macros_of(codes: bytes, entry: int, last: int) -> list[int]:
    """The macros of the cheapest way from one state before the rows to one behind."""
    layer, pointers = begun(entry), []
    for code in codes:
        _, layer, back = step(layer, code)
        pointers.append(back)
    out, state = [], last
    for back in reversed(pointers):
        state, macro = back[state]
        out.append(macro)
    return out[::-1]


@dataclass
class Fold:
    """Tables of a conversation's segments, in order."""

    total: int = 0
    layer: Layer = begun(NOTHING)
    back: list = field(default_factory=list)
    illegal: int = 0
    last: int | None = None

    def add(self, table: list[int], illegal: int, first: int, last: int) -> None:
        found: list = [None] * 4
        for state, held in enumerate(self.layer):
            for after in STATES if held else ():
                cost, rank = table[8 * state + 2 * after : 8 * state + 2 * after + 2]
                way = (held[0] + cost, held[1], rank, state)
                if cost >= 0 and (found[after] is None or way < found[after]):
                    found[after] = way
        added, self.layer, pointers = ordered(found)
        self.total += added
        self.back.append([p and p[0] for p in pointers])
        self.illegal += illegal + (self.last is not None and not legal(self.last, first))
        self.last = last

    def ends(self) -> tuple[int, list[tuple[int, int]], int]:
        """(cost, states before and behind every segment, inserts at the end) of the cheapest way of least audit."""
        cost, _, state = min((held[0] + INSERT * TAILS[s], held[1], s) for s, held in enumerate(self.layer) if held)
        tail, out = TAILS[state], []
        for back in reversed(self.back):
            out.append((back[state], state))
            state = back[state]
        return self.total + cost, out[::-1], tail


def legal(code: int, then: int) -> bool:
    return (code % 4, then % 4) in ((SYSTEM, ASKS), (ASKS, ANSWERS), (ANSWERS, ASKS))


def spelt(macros: list[int], entry: int, codes: bytes, tail: int) -> list[tuple[str, int | None, int | None]]:
    """(edit, place of its row or None, role's kind or None where a row keeps its own or goes)."""
    out, state = [], entry

    def add(edit: str, at: int | None, role: int) -> None:
        nonlocal state
        out.append((edit, at, None if edit == "K" else role))
        state = STEPS[state, role]

    for at, macro in enumerate(macros):
        for edit in MACROS[macro]:
            if edit == "D":
                out.append(("D", at, None))
            else:
                add(edit, None if edit == "I" else at, codes[at] % 4 if edit == "K" else _role(state))
    for _ in range(tail):
        add("I", None, _role(state))
    return out


def rows_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with null roles and texts as one space."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """rows with one of five kinds of damage, or none, by their conversation and turn."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, USER).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("kind", kind).where("kind != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def told_apart(rows: DataFrame) -> DataFrame:
    """Different rows (conv_id, turn, role, hash) with the number n of each, whether it is blank, an earlier turn has it, and its end is open."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    kinds = rows.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("hash"), (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(*ENDS)).alias("open"))
    alike = written(kinds.groupBy("conv_id", "turn", "role", "hash").agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("open").alias("open")), "alike")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = alike.groupBy("conv_id", "role", "hash").agg(F.min(place).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    a, b = alike.alias("a"), written(again, "again").alias("b")  # plain rows on both sides, so that a common one can be split
    met = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.hash") == F.col("b.hash")), "left")
    seen = F.coalesce(F.struct(F.col("a.turn").isNotNull(), "a.turn") != F.col("first"), F.lit(False))
    return met.select("a.*", seen.alias("seen"))


def counted(told: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated."""
    again = F.when(F.col("blank"), 0).when(F.col("seen"), F.col("n")).otherwise(F.col("n") - 1)
    cut = F.when(~F.col("blank") & ~F.col("seen") & F.col("open"), 1).otherwise(0)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    return told.groupBy("conv_id").agg(gaps.alias("gaps"), F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"), F.sum(again).alias("duplicate"), F.sum(cut).alias("truncated"))


def segments(told: DataFrame, most: int = SEGMENT) -> DataFrame:
    """conv_id, part, segment, codes of its rows and their turns, roles and hashes; (part, segment) is in order."""
    role = F.substring("role", 1, 1)
    initial = F.when(role == "s", SYSTEM).when(role == "u", ASKS).when(role == "a", ANSWERS).otherwise(OTHER)
    kind = F.when(F.col("blank") | F.col("seen"), GONE).when(F.col("open"), OPEN).otherwise(FINE)
    rows = told.select("conv_id", "turn", "role", "hash", "n", (4 * kind + initial).cast("int").alias("code"))
    order = ["conv_id", "turn", "role", "hash"]
    schema = "conv_id long, part int, segment int, codes binary, turns array<long>, roles array<string>, hashes array<binary>"
    kinds = to_arrow(StructType.fromDDL(schema))

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        now, held = None, []

        def out():
            nonlocal number, held
            codes, *cols = zip(*held, strict=True)
            row = [now, part, number, bytes(codes), *cols]
            number, held = number + 1, []
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds.types, strict=True)], schema=kinds)

        for batch in batches:
            for conv, turn, r, h, n, code in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and conv != now:
                    yield out()
                now = conv
                for copy in range(n):
                    if len(held) == most:
                        yield out()
                    held.append((4 * GONE + code % 4 if copy else code, turn, r, h))
        if held:
            yield out()

    return small_batches(rows.repartitionByRange(*order).sortWithinPartitions(*order)).mapInArrow(run, schema)


def _tables(parts: DataFrame) -> DataFrame:
    schema = "conv_id long, part int, segment int, `table` array<long>, illegal long, first int, last int"
    kinds = to_arrow(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            codes = batch["codes"].to_pylist()
            cols = [[table_of(c) for c in codes], [sum(not legal(x, y) for x, y in zip(c, c[1:])) for c in codes], [c[0] for c in codes], [c[-1] for c in codes]]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kinds.names[:3]), *(pa.array(c, t) for c, t in zip(cols, kinds.types[3:], strict=True))], schema=kinds)

    return small_batches(parts.select("conv_id", "part", "segment", "codes")).mapInArrow(run, schema)


def _folded(tables: DataFrame) -> DataFrame:
    """Per segment the states before and behind it on the cheapest way; on a conversation's last one its cost, illegal neighbours and inserts at the end."""
    schema = "conv_id long, part int, segment int, entry int, last int, tail int, cost long, illegal long"
    kinds = to_arrow(StructType.fromDDL(schema))

    def run(batches):
        now, keys, fold, rows = None, [], Fold(), []

        def close():
            cost, ends, tail = fold.ends()
            for k, ((part, segment), (entry, last)) in enumerate(zip(keys, ends, strict=True), 1):
                rows.append((now, part, segment, entry, last, *((tail, cost, fold.illegal) if k == len(keys) else (0, 0, 0))))

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types, strict=True)], schema=kinds)

        for batch in batches:
            for conv, part, segment, *told in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if keys and conv != now:
                    close()
                    keys, fold = [], Fold()
                    if len(rows) > 10_000:
                        yield out()
                        rows = []
                now = conv
                keys.append((part, segment))
                fold.add(*told)
        if keys:
            close()
            yield out()

    return small_batches(tables.repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment")).mapInArrow(run, schema)


@dataclass
class Repair:
    """edits: conv_id, part, segment, edits (an array of edit, role, turn, old, hash in order); costs: conv_id, cost, illegal, of its last
    segment; told: the rows told apart; rows: as they were read."""

    edits: DataFrame
    costs: DataFrame
    told: DataFrame
    rows: DataFrame

    def audits(self) -> DataFrame:
        """conv_id, audit."""
        piece = F.struct("part", "segment", F.array_join(F.transform("edits", lambda x: x["edit"]), "").alias("audit"))
        return self.edits.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["audit"]), "").alias("audit"))

    def repaired(self) -> DataFrame:
        """conv_id, part, segment, at, role, text: the rows of the repaired conversations, in the order of part, segment and at."""
        rows = self.edits.select("conv_id", "part", "segment", F.posexplode("edits").alias("at", "x")).select("conv_id", "part", "segment", "at", "x.*")
        made = rows.where("edit = 'I'").select("conv_id", "part", "segment", "at", "role", F.lit("").alias("text"))
        stay = rows.where("edit in ('K', 'R')").alias("a")
        texts = self.rows.withColumn("hash", F.unhex(F.sha2("text", 256))).groupBy("conv_id", "turn", "role", "hash").agg(F.first("text").alias("text")).alias("b")
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{d}")) for c, d in (("conv_id", "conv_id"), ("turn", "turn"), ("old", "role"), ("hash", "hash"))]
        met = stay.join(texts, same[0] & same[1] & same[2] & same[3])
        return met.select("a.conv_id", "part", "segment", "at", "a.role", "b.text").union(made)


def repair(conversations: DataFrame, most: int = SEGMENT) -> Repair:
    """The cheapest repairs of conversations (conv_id, turn, role, text)."""
    rows = rows_of(conversations)
    told = written(told_apart(rows), "told")
    parts = written(segments(told, most), "segments")
    ends = written(_folded(_tables(parts)), "ends")
    schema = "conv_id long, part int, segment int, edits array<struct<edit:string,role:string,turn:long,old:string,hash:binary>>"
    kinds = to_arrow(StructType.fromDDL(schema))
    names = {ASKS: USER, ANSWERS: ASSISTANT}

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes, out = row["codes"], []
                for edit, at, role in spelt(macros_of(codes, row["entry"], row["last"]), row["entry"], codes, row["tail"]):
                    turn, old, h = (None, None, None) if at is None else (row[c][at] for c in ("turns", "roles", "hashes"))
                    out.append({"edit": edit, "role": old if edit == "K" else names.get(role), "turn": turn, "old": old, "hash": h})
                yield pa.RecordBatch.from_pydict({"conv_id": [row["conv_id"]], "part": [row["part"]], "segment": [row["segment"]], "edits": [out]}, schema=kinds)

    known = parts.join(ends.select("part", "segment", "entry", "last", "tail"), ["part", "segment"])
    edits = written(small_batches(known).mapInArrow(run, schema), "edits")
    return Repair(edits, ends.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal")), told, rows)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of role:text of the rows in order, joined by newlines. A digest is made row by row: a task
    holds its running value and no conversation."""
    schema = "conv_id long, repaired_sha256 string"
    kinds = to_arrow(StructType.fromDDL(schema))

    def run(batches):
        now, sha, out = None, None, []

        def made():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds.types, strict=True)], schema=kinds)

        for batch in batches:
            for conv, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if sha is None or conv != now:
                    if sha:
                        out.append((now, sha.hexdigest()))
                    now, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            if len(out) > 10_000:
                yield made()
                out = []
        if sha:
            out.append((now, sha.hexdigest()))
        if out:
            yield made()

    order = ["conv_id", "part", "segment", "at"]
    return small_batches(repaired.repartition("conv_id").sortWithinPartitions(*order)).mapInArrow(run, schema)


def report(conversations: DataFrame, found: Repair) -> DataFrame:
    """One row for every conv_id of conversations: counts of its faults, cost and audit of its repair and the digest of what it gives."""
    columns = {c: "long" for c in ("gaps", *FAULTS, "illegal", "cost")} | {"audit": "string", "repaired_sha256": "string"}
    rows = lambda df: df.select("conv_id", *((F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()))
    every = rows(conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct())
    for df in (counted(found.told), found.costs, found.audits(), digests(found.repaired())):
        every = every.union(rows(df))
    none: dict[str, Column] = {c: F.lit(0) for c in columns} | {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return every.groupBy("conv_id").agg(*(F.coalesce(F.max(c), none[c]).cast(t).alias(c) for c, t in columns.items()))


def op12_conversations(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return report(table, repair(damaged(rows_of(table))))
