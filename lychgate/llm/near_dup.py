"""Near-duplicate documents by b-bit MinHash, with every link confirmed on whole shingle sets.

1. Documents with equal sets form a class; its least id stands for it.
2. HASHES minima a class give BANDS band keys of ROWS minima each, and BITS low bits of every minimum,
   packed. A pair at the least linked similarity shares no band with a probability of 4e-7.
3. Classes that meet in a band are candidates where their similarity, estimated by bit counts and corrected for chance
   collisions, comes within MARGIN of the threshold. Each is compared with the least id of its band; where
   some in a band are not near that one, all in the band are compared, in blocks. Families are the
   components of these near pairs, so classes that only met by common phrases are in none together.
4. Whole sets of the classes in families are made again from the texts. Each is compared with its family's least id.
   Those not linked with it, and they alone, are compared with the rest: they are dealt to blocks
   of bounded size, a task takes two blocks and confirms candidates that are not already linked: one by one where they
   are few, else by products of membership matrices over the shingles that two sets share. A task
   reports a spanning forest of its links, not its pairs.
5. The components of the proven links are the groups.

Defined results: a null, empty or wordless text has an empty set and is linked with nothing; equal
texts are linked; rows that share a doc_id count as one document; a row without doc_id takes no part
and gets no component; an empty table gives none; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lychgate.llm.common import docs_of, forget, likely, map_batches, parted, small_batches, to_arrow, unused, written
from lychgate.llm.graph import components
from lychgate.llm.shingles import common, set_key, shingle_set

ROWS, BANDS, BITS = 4, 20, 4
HASHES = ROWS * BANDS
MARGIN = 0.25
BLOCK_SHINGLES, BLOCK_SETS = 1_000_000, 2_000

_rng = np.random.Generator(np.random.PCG64(7))
_FLIP = _rng.integers(0, 2**32, (HASHES, 1), dtype=np.uint32)
_ODD = _rng.integers(0, 2**31, (HASHES, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BAND = _rng.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHUNK = 2048
_NIBBLES = np.uint64(0x1111111111111111)


def minima(s: np.ndarray) -> np.ndarray:
    """The least value of each hash over a set that is not empty."""
    low = (s >> np.uint64(32)).astype(np.uint32)
    out = None
    for at in range(0, len(low), _CHUNK):
        part = ((low[at : at + _CHUNK] ^ _FLIP) * _ODD).min(axis=1)
        out = part if out is None else np.minimum(out, part)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    keys = (m.reshape(BANDS, ROWS).astype(np.uint64) * _BAND).sum(axis=1, dtype=np.uint64)
    return ((keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def pack_bits(m: np.ndarray) -> np.ndarray:
    """The BITS low bits of each minimum, 16 to a 64-bit number."""
    low = (m & np.uint32(2**BITS - 1)).astype(np.uint64).reshape(-1, 64 // BITS)
    return (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarities of packed signatures a (n, words) and b (m, words) by counts of equal BITS-bit
    fields, corrected for fields that are equal by chance."""
    unequal = np.zeros((len(a), len(b)), np.uint16)
    for w in range(a.shape[1]):
        x = a[:, w, None] ^ b[None, :, w]
        x |= x >> np.uint64(2)
        x |= x >> np.uint64(1)
        unequal += np.bitwise_count(x & _NIBBLES)
    chance = 2.0**-BITS
    return (1 - unequal / HASHES - chance) / (1 - chance)


def linked(common_size, a_size, b_size, percent: int):
    return 100 * common_size >= percent * (a_size + b_size - common_size)


class Forest:
    """Union-find that keeps the edges which joined two trees."""

    def __init__(self, n: int):
        self.up, self.edges = list(range(n)), []

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        p, q = self.root(x), self.root(y)
        if p != q:
            self.up[max(p, q)] = min(p, q)
            self.edges.append((x, y))


def _products(sets: list[np.ndarray], rows: list[int], cols: list[int]) -> np.ndarray:
    """Intersection sizes of all sets in rows with all in cols, by products of membership matrices."""
    used = sorted({*rows, *cols})
    sizes = [len(sets[i]) for i in used]
    values, ids = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True)
    keep = np.bincount(ids) > 1
    number = np.cumsum(keep) - 1
    owner = np.repeat(np.arange(len(used)), sizes)
    inside = keep[ids]
    ids, owner = number[ids[inside]], owner[inside]
    order = np.argsort(ids, kind="stable")
    ids, owner = ids[order], owner[order]
    at = {i: k for k, i in enumerate(used)}
    r, c = [at[i] for i in rows], [at[i] for i in cols]
    out = np.zeros((len(r), len(c)), np.float32)
    for first in range(0, int(keep.sum()), 1024):
        lo, hi = np.searchsorted(ids, (first, first + 1024))
        member = np.zeros((len(used), 1024), np.float32)
        member[owner[lo:hi], ids[lo:hi] - first] = 1
        out += member[r] @ member[c].T
    return out.astype(np.int64)


def link_sets(
    sets: list[np.ndarray], packed: np.ndarray, left: list[int], right: list[int], percent: int, done: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """A spanning forest of the links between a set in left and one in right; all of them are proven. Sets that are
    done are linked with each other already."""
    forest = Forest(len(sets))
    done = np.zeros(len(sets), bool) if done is None else done
    linked_already = np.flatnonzero(done)
    for i in linked_already[1:].tolist():
        forest.up[i] = int(linked_already[0])
    sizes = np.array([len(s) for s in sets])
    same = left == right
    for at in range(0, len(left), 512):
        tile = left[at : at + 512]
        others = right[at:] if same else right
        near = estimates(packed[tile], packed[others]) >= percent / 100 - MARGIN
        a, b = sizes[tile][:, None], sizes[others][None, :]
        near &= 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
        near &= ~(done[tile][:, None] & done[others][None, :])
        if same:
            near &= np.arange(len(others))[None, :] > np.arange(len(tile))[:, None]
        if np.count_nonzero(near) > max(64, near.size // 50):
            ok = near & linked(_products(sets, tile, others), a, b, percent)
            for i, j in zip(*np.nonzero(ok), strict=True):
                forest.join(tile[i], others[j])
        else:
            for i, j in zip(*np.nonzero(near), strict=True):
                x, y = tile[i], others[j]
                if forest.root(x) != forest.root(y) and linked(common(sets[x], sets[y]), sizes[x], sizes[y], percent):
                    forest.join(x, y)
    return forest.edges


def near_forest(packed: np.ndarray, least: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of packed signatures whose estimated similarity is `least` or more: from one
    signature to the next, those not yet reached are compared with those just reached."""
    left, edges = np.arange(1, len(packed)), []
    reached = np.zeros(min(1, len(packed)), np.int64)
    while len(left):
        found = []
        for at in range(0, len(reached), 512):
            part = reached[at : at + 512]
            near = estimates(packed[part], packed[left]) >= least
            hit = near.any(axis=0)
            edges += zip(part[near[:, hit].argmax(axis=0)].tolist(), left[hit].tolist(), strict=True)
            found.append(left[hit])
            left = left[~hit]
        reached = np.concatenate(found)
        if not len(reached):
            reached, left = left[:1], left[1:]
    return edges


def signatures(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, key of its set, band keys and packed minima (none for an empty set)."""

    def batch(cols):
        forget()
        sizes, keys, bands, packed = [], [], [], []
        known: dict[bytes, tuple[list[int], list[int]]] = {}
        for t in cols["text"]:
            s = shingle_set(t)
            sizes.append(len(s))
            keys.append(k := set_key(s) if len(s) else None)
            if k is not None and k not in known:
                m = minima(s)
                known[k] = band_keys(m).tolist(), pack_bits(m).view(np.int64).tolist()
            own = known.get(k, ([], []))
            bands.append(own[0])
            packed.append(own[1])
        yield {"doc_id": cols["doc_id"], "n_shingles": sizes, "key": keys, "bands": bands, "packed": packed}

    schema = "doc_id long, n_shingles long, key binary, bands array<long>, packed array<long>"
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), batch, schema)


def _estimate(a: str, b: str) -> Column:
    """estimates() of two columns of packed minima."""
    unequal = F.lit(0)
    for w in range(HASHES * BITS // 64):
        x = F.col(a)[w].bitwiseXOR(F.col(b)[w])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        unequal = unequal + F.bit_count(x.bitwiseAND(F.lit(int(_NIBBLES))))
    chance = 2.0**-BITS
    return (1 - unequal / HASHES - chance) / (1 - chance)


def near_pairs(classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of classes with a band in common and an estimate within MARGIN of the threshold, as many as
    connect all that such pairs connect."""
    least = percent / 100 - MARGIN
    met = classes.select("node", F.explode("bands").alias("band"), "packed")
    hubs = met.groupBy("band").agg(F.min(F.struct("node", "packed")).alias("hub"), F.max("node").alias("last")).where("hub.node < last")
    hubs = written(hubs.select("band", F.col("hub.node").alias("hub"), F.col("hub.packed").alias("hub_packed")), "hubs")
    star = met.join(hubs, "band").where("node > hub").select("band", "node", "hub", (_estimate("packed", "hub_packed") >= least).alias("near"))
    star = written(star, "star")
    # Bands in which some are not near the least id, but may be near each other.
    mixed = written(star.groupBy("band").agg(F.min("near").alias("all"), F.count("*").alias("n")).where("not all and n > 1").select("band"), "mixed")
    members = met.join(mixed, "band").select(F.col("band").alias("family"), "node", F.lit(1).cast("long").alias("n"), F.lit(True).alias("open"), "packed")
    kinds = to_arrow(StructType.fromDDL("a long, b long"))

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by([("family", "ascending"), ("node", "ascending")])
        node = table["node"].to_numpy()
        bits = table["packed"].combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(node), -1)
        edges = [(first + x, first + y) for first, end in _runs(table["family"].to_numpy()) for x, y in near_forest(bits[first:end], least)]
        return pa.table({"a": node[[e[0] for e in edges]], "b": node[[e[1] for e in edges]]} if edges else {"a": [], "b": []}, schema=kinds)

    more = in_tasks(written(members, "mixed"), 200_000).groupBy("task", "i", "j").applyInArrow(link, "a long, b long")
    return star.where("near").select(F.col("node").alias("a"), F.col("hub").alias("b")).union(more).distinct()


def family_sets(docs: DataFrame, families: DataFrame) -> DataFrame:
    """Whole sets and packed minima of the classes in families (node, root)."""

    def batch(cols):
        forget()
        sets = [shingle_set(t) for t in cols["text"]]
        packed = [pack_bits(minima(s)).tobytes() if len(s) else b"" for s in sets]
        yield {
            "family": cols["root"], "node": cols["node"], "n": [len(s) for s in sets],
            "elements": [s.tobytes() for s in sets], "packed": packed,
        }

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    rows = likely(texts, families.select("node"), "node").join(families.hint("merge"), "node")
    return map_batches(rows, batch, "family long, node long, n long, elements binary, packed binary").where("n > 0")


def starred(members: DataFrame, percent: int) -> DataFrame:
    """members, but for the least of a family, with open: whether it is not linked with that one."""
    # Several texts of one id: the smallest set stands for the family.
    hubs = members.where("node = family").groupBy("family").agg(F.min("elements").alias("hub"))
    schema = "family long, node long, n long, elements binary, packed binary, open boolean"
    kinds = to_arrow(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            pairs = zip(batch["elements"], batch["hub"], strict=True)
            sets = [(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in pairs]
            far = [not linked(common(x, y), len(x), len(y), percent) for x, y in sets]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kinds.names[:-1]), pa.array(far, pa.bool_())], schema=kinds)

    return small_batches(members.join(written(hubs, "least"), "family")).mapInArrow(run, schema)


def _runs(x: np.ndarray) -> list[tuple[int, int]]:
    """Where equal neighbours begin and end."""
    if not len(x):
        return []
    starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])).tolist()
    return [*zip(starts, [*starts[1:], len(x)], strict=True)]


def in_tasks(members: DataFrame, weight: int) -> DataFrame:
    """members (family, node, n, open, ...) with task, i, j and block: every two members of a family one of which at
    least is open meet in a task (task, i, j). A task has two blocks of `weight` in n and BLOCK_SETS members at most, about,
    or small families together."""
    blocks_of = lambda n, sets: F.ceil(F.greatest(F.col(n) / weight, F.col(sets) / BLOCK_SETS)).cast("int")
    sums = [F.sum(F.when(F.col("open") == F.lit(o), x)).alias(name) for o in (True, False) for x, name in ((F.col("n"), f"n_{o}"), (F.lit(1), f"sets_{o}"))]
    sized = members.groupBy("family").agg(F.sum("n").alias("n"), F.count("*").alias("sets"), *sums).na.fill(0).where("sets_True > 0")
    sized = sized.select("family", "n", (blocks_of("n", "sets") <= 1).alias("small"), blocks_of("n_True", "sets_True").alias("opens"), blocks_of("n_False", "sets_False").alias("rest"))
    sized = written(sized, "sized")
    bins = max(1, -(-(sized.where("small").agg(F.sum("n").alias("t")).first()["t"] or 0) // weight))
    part = lambda n: F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.col(n))).cast("int")
    block = F.when(F.col("small"), F.lit(0)).when(F.col("open"), part("opens")).otherwise(F.col("opens") + part("rest"))
    # An open block meets every block, another one the open ones.
    last = F.when(F.col("small"), F.lit(0)).when(F.col("open"), F.col("opens") + F.col("rest") - 1).otherwise(F.col("opens") - 1)
    pairs = F.transform(F.sequence(F.lit(0), last), lambda j: F.struct(F.least(j, "block").alias("i"), F.greatest(j, "block").alias("j")))
    task = F.when(F.col("small"), -1 - F.pmod(F.xxhash64("family"), F.lit(bins))).otherwise(F.col("family"))
    dealt = members.join(sized.drop("n"), "family").withColumn("block", block).withColumn("pair", F.explode(pairs))
    return dealt.withColumn("task", task).select("task", "pair.i", "pair.j", "block", *members.columns)


def confirmed_links(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): a spanning forest of the proven links in every family but those with its least id; of starred()."""
    schema = "a long, b long"
    kinds = to_arrow(StructType.fromDDL(schema))

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by([("family", "ascending"), ("node", "ascending")])
        family, node, blocks_of = (table[c].to_numpy() for c in ("family", "node", "block"))
        done = ~table["open"].to_numpy()
        elements, packed = table["elements"], table["packed"]
        edges: list[tuple[int, int]] = []
        for first, end in _runs(family):
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in elements[first:end]]
            bits = np.frombuffer(b"".join(x.as_py() for x in packed[first:end]), np.uint64).reshape(end - first, -1)
            of = blocks_of[first:end]
            i, j = (int(table[c][first].as_py()) for c in "ij")
            left, right = ([*range(end - first)],) * 2 if i == j else (np.flatnonzero(of == b).tolist() for b in (i, j))
            edges += [(int(node[first + x]), int(node[first + y])) for x, y in link_sets(sets, bits, left, right, percent, done[first:end])]
        return pa.table({"a": [e[0] for e in edges], "b": [e[1] for e in edges]}, schema=kinds)

    return in_tasks(members, BLOCK_SHINGLES).groupBy("task", "i", "j").applyInArrow(link, schema)


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id, kept."""
    rows = written(signatures(docs), "signatures")
    known = rows.where("n_shingles > 0 and doc_id is not null")
    classes = known.groupBy("key").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("packed").alias("packed"))
    classes = written(classes, "classes")
    families = components(near_pairs(classes, percent))
    members = written(starred(written(family_sets(docs, families), "sets"), percent), "starred")
    star = members.where("not open and node != family").select(F.col("node").alias("a"), F.col("family").alias("b"))
    links = star.union(confirmed_links(members, percent))
    # Rows of one doc_id with different texts are one document.
    ids = known.select("key", "doc_id").join(classes.select("key", "node"), "key")
    again = ids.where("doc_id != node").groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    twice = ids.join(classes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi").where("doc_id != node")
    more = again.where("lo < hi").select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    more = more.union(twice.select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    roots = components(links.union(more))
    # Rows without a set or an id have no class; they need no join, and would all meet in one task.
    told = known.select("doc_id", "n_shingles", "key").join(classes.select("key", "node"), "key").select("doc_id", "n_shingles", "node")
    other = rows.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("node"), F.lit(None).cast("long").alias("root"))
    return (
        written(told, "told").join(roots, "node", "left").select("doc_id", "n_shingles", "node", "root").union(other)
        .select("doc_id", "n_shingles", _component().alias("component_id"), F.coalesce(F.col("doc_id") == _component(), F.lit(False)).alias("kept"))
    )


def _component() -> Column:
    return F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "node", "doc_id"))


def one_of_each(docs: DataFrame, percent: int = 85) -> DataFrame:
    """docs without those near a document of smaller id; of the rows of an id the one with the least text (null last,
    then by its other columns) is kept, of rows without id all."""
    groups = written(near_duplicates(docs, percent).where("doc_id is not null").select("doc_id", "kept"), "groups")
    # Rows that go, and those of an id that stands more than once; all others pass without a shuffle.
    told = groups.groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_or("kept").alias("kept")).where("n > 1 or not kept")
    told = written(told, "told")
    maybe, rest = parted(docs, told.select("doc_id"), "doc_id")
    gone = told.where("not kept").select("doc_id")
    stay = maybe.join(gone.hint("merge"), "doc_id", "left_anti").select(docs.columns)
    order, place = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last(), F.to_json(F.struct(*docs.columns))), unused("place", docs.columns)
    return rest.unionByName(stay.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place))


def op6_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(docs_of(spark, sf_dir))


def iter_brute_links(texts: list[str | None], percent: int = 85) -> Iterator[tuple[int, int]]:
    """All linked pairs of a small list, from word tuples; for tests."""
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                yield i, j
