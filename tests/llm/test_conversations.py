import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import duckdb
import pytest

from lychgate.llm import conversations, queries
from tests.test_oracle import rows as plain_rows

GOOD = re.compile(r"(s?(ua)+)?\Z")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (kind != 0) * (1 + (kind == 3))
    return out


def plain_repair(rows):
    """Faults, cost, audit and repaired rows of one conversation by spelling out every audit."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, last, inserted):
        """(cost, audit, rows) from row i on, behind a row of initial last, after so many inserts in a row."""
        found = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        if inserted < 3:
            for r in set(follow[last]) & set("ua"):
                cost, audit, rest = best(i, r, inserted + 1)
                found.append((cost + 5, "I" + audit, (({"u": "user", "a": "assistant"}[r], ""), *rest)))
        if i < len(rows):
            cost, audit, rest = best(i + 1, last, 0)
            found.append((cost + 2, "D" + audit, rest))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                if rows[i][2][:1] and rows[i][2][:1] in follow[last]:
                    cost, audit, rest = best(i + 1, rows[i][2][0], 0)
                    found.append((cost + more, "K" + audit, (rows[i][2:], *rest)))
                for r in set(follow[last]) & set("ua"):
                    cost, audit, rest = best(i + 1, r, 0)
                    found.append((cost + 1 + more, "R" + audit, (({"u": "user", "a": "assistant"}[r], rows[i][3]), *rest)))
        return min(found, default=(10**9, "", ()))

    cost, audit, out = best(0, "", 0)
    assert GOOD.match("".join(r[0][:1] for r in out))
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    told = (gaps, *(faults.count(f) for f in conversations.FAULTS), sum(p not in ("su", "ua", "au") for p in pairs))
    return (*told, cost, audit, hashlib.sha256("\n".join(":".join(r) for r in out).encode()).hexdigest())


def plain_report(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    for own in by.values():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
    return {conv: plain_repair(own) for conv, own in by.items()}


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "conv_id long, turn long, role string, text string, hash string, n int, code string")


def reported(df, most=conversations.SEGMENT):
    return {r[0]: tuple(r)[1:] for r in conversations.report(df, conversations.repair(df, most)).collect()}


def made(n, seed, length=9):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", " ", "union"], ["", " \n", "A.", "B!", "C", "C", "d?\t", "Ünï", ". x"]
    return [(conv, t if rng.random() < 0.9 else None, rng.choice(roles[: rng.choice([2, 3, 7])]), rng.choice(texts) + rng.choice(["", str(t) + "."])) for conv in range(n) for t in range(rng.randint(1, length))]


@pytest.mark.parametrize("most", [1, 3, 8_192])
def test_against_all_audits(spark, most):
    rows = made(300, most)
    assert reported(table(spark, rows), most) == plain_report(rows)


def test_layers_against_all_audits():
    rng = random.Random(5)
    text = {conversations.FINE: "x.", conversations.OPEN: "x", conversations.GONE: ""}
    for _ in range(1500):
        codes = bytes(rng.randrange(12) for _ in range(rng.randint(0, 10)))
        rows = [(1, i, "suat"[c % 4], text[c // 4] and f"{i}{text[c // 4]}") for i, c in enumerate(codes)]
        fold, cut = conversations.Fold(), rng.randint(0, len(codes))
        for part in (codes[:cut], codes[cut:]):
            if part:
                fold.add(conversations.table_of(part), 0, part[0], part[-1])
        cost, ends, tail = fold.ends()
        edits = []
        for k, (part, (entry, last)) in enumerate(zip([p for p in (codes[:cut], codes[cut:]) if p], ends, strict=True), 1):
            edits += conversations.spelt(conversations.macros_of(part, entry, last), entry, part, tail if k == len(ends) else 0)
        assert (cost, "".join(e[0] for e in edits)) == plain_repair(rows)[5:7]


def test_macros_do_not_begin_each_other():
    assert not [(a, b) for a in conversations.MACROS for b in conversations.MACROS if a != b and b.startswith(a)] and len(conversations.MACROS) == 9


def test_query_against_plain_version(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    own = plain_report(plain_damage(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.op12_conversations(spark, sf).collect()}
    assert got == {r[0]: own.get(r[0], empty) for r in rows}


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    assert plain_rows(queries.queries()["op12_conversations"](spark, sf).toPandas()) == plain_rows(con.execute(queries.OP12_SQL).df())


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (None, 1, "user", "a."), (1, 5, "user", None), (1, 5, None, "b."), (1, 5, "assistant", "z."), (1, 5, "user", "c."), (2, None, "s", "."), (3, 2**40, "user", "x" * 300_000)]
    rows += [(4, 0, "user", "same.")] * 60
    got = reported(table(spark, rows), 7)
    spaced = [(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows]
    assert got == plain_report(spaced) and got[4][:4] == (0, 0, 59, 0)
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    own = plain_report(plain_damage(rows))
    answer = {r["conv_id"]: tuple(r)[1:] for r in conversations.op12_conversations(spark, str(tmp_path)).collect()}
    assert answer.keys() == {r[0] for r in rows} and {c: answer[c] for c in own} == own
    assert reported(table(spark, [])) == {}


def test_a_long_conversation_is_spread(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", f"{i}.") for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
    try:
        found = conversations.repair(table(spark, rows), 100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["n"] for r in found.edits.selectExpr("size(filter(edits, x -> x.edit != 'I')) as n").collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 100 and found.edits.select("part").distinct().count() > 1
    assert "".join(r["role"][0] for r in found.repaired().orderBy("part", "segment", "at").collect()) == "ua" * (found.repaired().count() // 2)
