"""URL filters by a sort-merge range join of addresses with (host, path) rules.

A host's key is its labels in reverse, each followed by a dot, so that a rule's host and all its subdomains are the
interval of keys that begin with the rule's key. Intervals of this kind are nested or apart.

1. Keys of addresses are cut into parts at boundaries taken from a sample of them; the path and a hash of the row follow
   the key in the order, so one host's or one address' rows are spread over as many parts as they fill. Boundaries only
   balance the parts: no result depends on them.
2. A rule goes to every part that its interval meets. Rows and rules of a part are sorted by key, rules first.
3. A sweep over a sorted part keeps a stack of the rules' hosts whose intervals are open. Of each host on the stack the
   longest path that the address' path begins with is looked up; the longest of these rules, host and path together, wins.

Defined results: a null address or one without `://` has an empty host and an empty path; a host stands as it is
written, with port and user if there are any, but for A-Z in lower case; an empty path begins with no rule's `/`;
of rules of equal length the one with the longer host wins; of the same host and path, block wins; a rule with an empty
host fits every address; a rule with a null host, path or verdict takes no part; without a rule that fits, rule is null and the
verdict is `default`; repeated rows and rows without id are judged one by one; an empty table gives none; extra
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lychgate.llm.common import small_batches, to_arrow

ALLOW, BLOCK = "allow", "block"
#: Fixed values of the contract.
RULES = ((ALLOW, "com", "/"), (BLOCK, "example.com", "/en/"), (ALLOW, "www.example.com", "/en/"), (BLOCK, "net", "/es/"), (BLOCK, "net", "/fr/"))
#: Sampled keys a part, and characters of a boundary.
SAMPLED, BOUNDARY = 20, 200
#: After every character of a key.
LAST = "\U0010ffff"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCHEMA = "page_id long, host string, path string, rule string, verdict string"


def host_key(host: Column) -> Column:
    """Labels in reverse, each with a dot after it; an empty host has the key of one empty label."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def addresses(pages: DataFrame) -> DataFrame:
    """page_id, host, path, key and salt of every row. The salt tells equal rows apart by their place in the files."""
    part = lambda n: F.coalesce(F.regexp_extract("url", r"://([^/?#]*)([^?#]*)", n), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.translate(part(1), UPPER, LOWER).alias("host"), part(2).alias("path"), F.hex(F.xxhash64("page_id", "url", F.monotonically_increasing_id())).alias("salt"))
    return rows.withColumn("key", host_key(F.col("host")))


def boundaries(rows: DataFrame, parts: int) -> list[tuple[str, str, str]]:
    """At most parts - 1 places (key, path, salt) that cut rows into parts of about equal size."""
    total = rows.count()
    if parts < 2 or not total:
        return []
    share = min(1.0, SAMPLED * parts / total)
    cut = [F.substring(c, 1, BOUNDARY).alias(c) for c in ("key", "path", "salt")]
    # A share by the salt: the same rows whenever a task is run again.
    found = sorted(tuple(r) for r in rows.where(F.pmod(F.xxhash64("salt"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select(*cut).collect())
    return sorted({found[i * len(found) // parts] for i in range(1, parts)}) if found else []


def _dealt(rows: DataFrame, cuts: list[tuple[str, str, str]], schema: str) -> DataFrame:
    """rows with part: the number of cuts at or before its place."""
    kinds = to_arrow(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = zip(*(batch[c].to_pylist() for c in ("key", "path", "salt")), strict=True)
            part = pa.array([bisect_right(cuts, place) for place in places], pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kinds.names[:-1]), part], schema=kinds)

    return small_batches(rows).mapInArrow(run, schema)


def rule_intervals(rules: DataFrame, cuts: list[tuple[str, str, str]]) -> DataFrame:
    """Every rule in each part that its host's interval meets: key, host, path, verdict, part."""
    rows = rules.where("host is not null and path is not null and verdict is not null")
    rows = rows.select(F.translate("host", UPPER, LOWER).alias("host"), "path", F.lower("verdict").alias("verdict"))
    rows = rows.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block comes after allow
    rows = rows.withColumn("key", F.when(F.col("host") == "", F.lit("")).otherwise(host_key(F.col("host"))))
    kinds = to_arrow(StructType.fromDDL("key string, host string, path string, verdict string, part int"))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                first, last = bisect_left(cuts, (row["key"],)), bisect_right(cuts, (row["key"] + LAST,))
                # A cut itself begins a part, so the interval begins in the part before its first cut.
                parts = range(first, last + 1)
                cols = [[row[c]] * len(parts) for c in kinds.names[:-1]]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols), pa.array(parts, pa.int32())], schema=kinds)

    return small_batches(rows.select("key", "host", "path", "verdict")).mapInArrow(run, "key string, host string, path string, verdict string, part int")


class Open:
    """A host on the stack with its rules: the longest of its paths that begins another path."""

    def __init__(self, key: str):
        self.key, self.rules, self.sizes = key, {}, []

    def add(self, host: str, path: str, verdict: str) -> None:
        self.rules[path] = (len(host) + len(path), len(host)), host + path, verdict
        self.sizes = sorted({len(p) for p in self.rules}, reverse=True)

    def longest(self, path: str) -> tuple | None:
        for size in self.sizes:
            if size <= len(path) and (found := self.rules.get(path[:size])):
                return found
        return None


class Sweep:
    """Rules and addresses of a part in order of keys, rules before addresses of the same key."""

    def __init__(self):
        self.part, self.stack = None, []

    def close(self, part: int, key: str) -> None:
        """Take hosts from the stack that end before key."""
        if part != self.part:
            self.part, self.stack = part, []
        while self.stack and not key.startswith(self.stack[-1].key):
            self.stack.pop()

    def rule(self, part: int, key: str, host: str, path: str, verdict: str) -> None:
        self.close(part, key)
        if not self.stack or self.stack[-1].key != key:
            self.stack.append(Open(key))
        self.stack[-1].add(host, path, verdict)

    def judge(self, part: int, key: str, path: str, default: str) -> tuple[str | None, str]:
        self.close(part, key)
        found = [x for x in (o.longest(path) for o in self.stack) if x]
        return max(found)[1:] if found else (None, default)


def judged(pages: DataFrame, rules: DataFrame, default: str = ALLOW, parts: int | None = None) -> DataFrame:
    """Per row of pages (page_id, url): page_id, host, path, the rule that fits it best and its verdict. rules: host, path,
    verdict (allow or block). parts: into how many the addresses are cut, three for each shuffle partition if None."""
    if default not in (ALLOW, BLOCK):
        raise ValueError(f"default has to be {ALLOW} or {BLOCK}: {default}")
    spark = pages.sparkSession
    rows = addresses(pages)
    cuts = boundaries(rows, parts or 3 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = _dealt(rows.select("page_id", "key", "path", "salt", "host"), cuts, "page_id long, key string, path string, salt string, host string, part int")
    both = dealt.select("part", "key", F.lit(1).alias("kind"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    both = both.union(rule_intervals(rules, cuts).select("part", "key", F.lit(0), F.lit(None).cast("long"), "host", "path", "verdict"))
    kinds = to_arrow(StructType.fromDDL(SCHEMA))

    def run(batches):
        sweep = Sweep()
        for batch in batches:
            out = []
            for part, key, kind, page, host, path, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind:
                    out.append((page, host, path, *sweep.judge(part, key, path, default)))
                else:
                    sweep.rule(part, key, host, path, verdict)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds.types, strict=True)], schema=kinds)

    return small_batches(both.repartition("part").sortWithinPartitions("part", "key", "kind")).mapInArrow(run, SCHEMA)


def rule_table(spark, rules=RULES) -> DataFrame:
    """rules (verdict, host, path) as a table."""
    return spark.createDataFrame([*rules], "verdict string, host string, path string")


def op11_url_rules(spark, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), rule_table(spark))
