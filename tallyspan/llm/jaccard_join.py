"""N-gram Jaccard join by a size-aware heavy-light split.

Two documents link when their sets of distinct word shingles have a Jaccard similarity of at least
``percent`` / 100. All work is on distinct sets; copies meet again at the end.

* Light sets (up to a size chosen by cost): each enumerates its subsets of every size that an overlap
  with a partner can have. Sets that share a subset of size c link to the smallest of them whenever c
  alone proves the similarity, and any two that link there also link to it, so stars lose nothing.
* Heavy sets: inverted lists over the rarest shingles of each set (as many as a partner must hit once).
  Rarity is counted on a fixed three eighths of the hash space, and that part comes first in the common
  order, so the order is total and the prefix rule exact while most shingles are never shuffled. A shingle
  of one document only is a mismatch in its prefix, so most documents end there. Lists with the same least
  member are scanned as one. Every candidate is verified on its whole set: against the first members of its list, then,
  if these have not connected them, against all others (``list_edges``).

The passes over the texts write no copy of them. Shingles are 64-bit hashes, so two different ones are
taken for equal with a chance of 2^-64.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyspan.llm import bloom
from tallyspan.llm.graph import components, sorted_groups
from tallyspan.llm.rows import only, without
from tallyspan.llm.words import SPACED, U64, mix, rows_of_words, shingles
from tallyspan.session import materialise

SAMPLED = 3  # eighths of the hash space in which rarity is counted
LIGHT_MOST = 24  # sizes up to which the cost of subsets is compared at all
HEADS = 32  # members of an inverted list that all others are compared with first
SPREAD = 1024  # members of a list that one task compares with the heads
BLOCK = 256  # members outside a list's largest component that one task holds while the list passes by
BLOCK_BYTES = 8 << 20  # and their bytes
BUCKET_ENTRIES = 400_000  # inverted-list entries that one task sorts at a time
PACKED_ENTRIES = 200_000  # and that a task holds until it deals them to buckets
OUT_BYTES = 2 << 20  # sets that a task holds before it hands them on
HOT_MOST = 100_000  # shingles kept as frequent: a bound on a broadcast, not on the result


def least_overlap(size: int, percent: int) -> int:
    """Elements of a set of ``size`` that any partner must hold."""
    return -(-percent * size // 100)


def subset_rows(size: int, percent: int) -> int:
    return sum(math.comb(size, c) for c in range(max(1, least_overlap(size, percent)), size + 1))


def light_boundary(histogram: dict[int, int], percent: int, verify: float = 4.0) -> int:
    """The largest size to enumerate: cheapest in rows for the given number of sets per size."""

    def cost(x: int) -> float:
        light = sum(n * subset_rows(s, percent) for s, n in histogram.items() if s <= x)
        floor = least_overlap(x + 1, percent) if x else 0
        heavy = sum(n * (s + verify * (s - least_overlap(s, percent) + 1)) for s, n in histogram.items() if s >= floor)
        return light + heavy

    return min(range(LIGHT_MOST + 1), key=lambda x: (cost(x), x))


def fingerprint(elements: np.ndarray) -> int:
    """A signed 64-bit key of a set; -1 (never a real key) for the empty set."""
    if len(elements) == 0:
        return -1
    total = int(mix(elements ^ U64(0x51ED270B7A3C9D11)).sum(dtype=U64))
    return int(mix(np.array([total ^ (len(elements) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)], U64))[0] >> U64(1))


def _sets(column: pa.Array, n: int):
    for row, words in rows_of_words(column, SPACED):
        yield row, shingles(words, n)


def _describe(n: int, keep: int):
    """Pass 1: size, key, small sets in full, and shingles that are frequent within the task."""

    def run(batches):
        docs, seen, counts = 0, [], {}

        def frequent():
            values, times = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.empty(0, U64), np.empty(0, int))
            often = times >= max(8, docs // 1000)
            for v, t in zip(values[often].tolist(), times[often].tolist()):
                counts[v] = counts.get(v, 0) + t

        for batch in batches:
            keys, sizes, small = [], [], []
            for _, found in _sets(batch.column(1), n):
                keys.append(fingerprint(found))
                sizes.append(len(found))
                small.append(found.tobytes() if 0 < len(found) <= keep else None)
                if len(found):
                    seen.append(found[(found & U64(7)) < SAMPLED])
                    docs += 1
            rows = len(keys)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "key": batch.column(2),
                    "fp": pa.array(keys, pa.int64()),
                    "n": pa.array(sizes, pa.int64()),
                    "small": pa.array(small, pa.binary()),
                    "hot": pa.nulls(rows, pa.int64()),
                    "times": pa.nulls(rows, pa.int64()),
                }
            )
            if sum(map(len, seen)) > 1_000_000:
                frequent()
                docs, seen = 0, []
        frequent()
        rows = len(counts)
        if rows:
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.nulls(rows, pa.int64()),
                    "key": pa.nulls(rows, pa.int64()),
                    "fp": pa.nulls(rows, pa.int64()),
                    "n": pa.nulls(rows, pa.int64()),
                    "small": pa.nulls(rows, pa.binary()),
                    "hot": pa.array(np.array(list(counts), U64).view(np.int64)),
                    "times": pa.array(list(counts.values()), pa.int64()),
                }
            )

    return run


def _tiers(found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """0: rarity is counted; 1: it is not; 2: known as frequent."""
    tier = np.where((found & U64(7)) < SAMPLED, 0, 1).astype(np.int8)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
        tier[frequent[at] == found] = 2
    return tier


def _invert(n: int, percent: int, floor: int, frequent, buckets: int):
    """Pass 2: (shingle, set) entries of heavy sets, packed by shingle bucket.

    An entry is the shingle, the set's key, and a word of tier and prefix facts: the prefix length and how
    many of the set's shingles have a counted rarity. A set with too few of those adds as many others as
    its prefix may need, in the common order.
    """

    def run(batches):
        hot = frequent.value
        held, size = [], 0

        def flush():
            rows = np.concatenate(held)
            bucket = (mix(rows["h"]) % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rows, bucket = rows[order], bucket[order]
            at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            for a, b in zip(at, [*at[1:], len(rows)]):
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([int(bucket[a])]), "entries": [rows[a:b].tobytes()]})

        for batch in batches:
            for _, found in _sets(batch.column(1), n):
                if len(found) < max(1, floor):
                    continue
                tier = _tiers(found, hot)
                prefix = len(found) - least_overlap(len(found), percent) + 1
                counted = found[tier == 0]
                entry = counted
                if len(counted) < prefix:
                    more = np.concatenate((found[tier == 1], found[tier == 2]))[: prefix - len(counted)]
                    entry = np.concatenate((counted, more))
                rows = np.empty(len(entry), ENTRY)
                rows["h"], rows["fp"] = entry, fingerprint(found)
                rows["spare"] = min(len(counted), 2**31 - 1) - prefix
                rows["rank"] = np.concatenate((np.zeros(len(counted), np.int8), _tiers(entry[len(counted) :], hot)))
                held.append(rows)
                size += len(rows)
                if size > PACKED_ENTRIES:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


#: One inverted-list entry: shingle, set, counted shingles less the prefix length, tier.
ENTRY = np.dtype([("h", "<u8"), ("fp", "<i8"), ("spare", "<i4"), ("rank", "i1")])


def _shared(batches):
    """Pass 3, one bucket of shingles at a time: the entries of shingles that several sets hold."""

    def out(parts):
        rows = np.concatenate(parts)
        rows = rows[np.lexsort((rows["fp"], rows["h"]))]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows["h"][1:] != rows["h"][:-1]) | (rows["fp"][1:] != rows["fp"][:-1])
        rows = rows[fresh]
        first = np.flatnonzero(np.concatenate(([True], rows["h"][1:] != rows["h"][:-1])))
        times = np.diff(np.append(first, len(rows)))
        sets = np.repeat(times, times)
        rows, sets = rows[sets > 1], sets[sets > 1]
        # the rarity of a shingle that only some of its sets list is unknown: its hash alone orders it
        for a in range(0, len(rows), 100_000):
            part, often = rows[a : a + 100_000], sets[a : a + 100_000]
            yield pa.RecordBatch.from_pydict(
                {
                    "h": pa.array(part["h"].view(np.int64) if part["h"].flags.c_contiguous else np.ascontiguousarray(part["h"]).view(np.int64)),
                    "fp": pa.array(np.ascontiguousarray(part["fp"])),
                    "spare": pa.array(part["spare"].astype(np.int64)),
                    "tier": pa.array(part["rank"].astype(np.int64)),
                    "times": pa.array(np.where(part["rank"] == 0, often, 0).astype(np.int64)),
                }
            )

    for group in sorted_groups(batches, ["bucket"]):
        parts = [np.frombuffer(b.as_buffer(), ENTRY) for c in group.column("entries").chunks for b in c]
        if parts:
            yield from out(parts)


def _subsets(percent: int):
    """All subsets of light sets that may be an overlap, as (size, hash of the subset, set)."""

    def run(batches):
        for batch in batches:
            size, key, fp, n = [], [], [], []
            for f, total, small in zip(*(batch.column(i).to_pylist() for i in range(3))):
                values = mix(np.frombuffer(small, U64) ^ U64(0x8CB92BA72F3D8DD7))
                for c in range(max(1, least_overlap(total, percent)), total + 1):
                    left_out = np.array(list(itertools.combinations(range(total), total - c)), np.int64).reshape(math.comb(total, c), total - c)
                    sums = values.sum(dtype=U64) - values[left_out].sum(axis=1, dtype=U64)
                    key.append(sums)
                    size.append(np.full(len(sums), c))
                    fp.append(np.full(len(sums), f))
                    n.append(np.full(len(sums), total))
            if key:
                yield pa.RecordBatch.from_pydict(
                    {
                        "c": pa.array(np.concatenate(size).astype(np.int64)),
                        "key": pa.array(np.concatenate(key).view(np.int64)),
                        "fp": pa.array(np.concatenate(fp).astype(np.int64)),
                        "n": pa.array(np.concatenate(n).astype(np.int64)),
                    }
                )

    return run


def light_edges(sets: DataFrame, most: int, percent: int) -> DataFrame:
    """Stars over shared subsets of the sets with at most ``most`` shingles."""
    keyed = sets.where(F.col("n") <= most).select("fp", "n", "small").mapInArrow(_subsets(percent), "c long, key long, fp long, n long")
    centre = keyed.groupBy("c", "key").agg(F.min(F.struct("n", "fp")).alias("least"), F.count("*").alias("sets")).where("sets > 1")
    return (
        keyed.join(centre, ["c", "key"])
        .where(F.col("fp") != F.col("least.fp"))
        .where((100 + percent) * F.col("c") >= percent * (F.col("n") + F.col("least.n")))
        .select(F.col("fp").alias("a"), F.col("least.fp").alias("b"))
    )


class _Index:
    """Overlaps of one set with each of several others."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        values = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(values, kind="stable")
        self.values, self.owner = values[order], owner[order]

    def similar(self, own: np.ndarray, percent: int) -> np.ndarray:
        """Positions of the sets that are similar to ``own``."""
        lo, hi = np.searchsorted(self.values, own, "left"), np.searchsorted(self.values, own, "right")
        lengths = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
        common = np.bincount(self.owner[at], minlength=len(self.sizes))
        return np.flatnonzero(100 * common >= percent * (self.sizes + len(own) - common))


class _Joined:
    """Which labels are known to be connected."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> bool:
        """False if they were connected already."""
        x, y = self.top(x), self.top(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _against(percent: int):
    """Links of the rows of a part with the sets at its head, as a forest; rows are (list, part, head, fp, label, set), heads first.

    Only the heads are held; the other rows pass by one at a time. Labels that are connected are not linked again.
    """

    def run(batches):
        here, heads, labels, index, joined = None, [], [], None, _Joined()
        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in ("centre", "part", "head", "fp", "label")))
            a, b = [], []
            for (centre, part, head, fp, label), elements in zip(keys, batch.column("elements")):
                if here != (centre, part):
                    here, heads, labels, index, joined = (centre, part), [], [], None, _Joined()
                own = np.frombuffer(elements.as_buffer(), U64)
                if head:
                    heads.append((fp, own))
                    labels.append(label)
                    continue
                if index is None:
                    index = _Index([found for _, found in heads])
                for x in index.similar(own, percent).tolist():
                    if heads[x][0] != fp and joined.join(labels[x], label):
                        a.append(fp)
                        b.append(heads[x][0])
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _linked(members: DataFrame, sets: DataFrame, percent: int, parallel: int) -> DataFrame:
    """Edges found by ``_against`` for members (centre, part, head, fp, label)."""
    return (
        members.join(sets, "fp")
        .select("centre", "part", "head", "fp", "label", "elements")
        .repartition(parallel, "centre", "part")
        .sortWithinPartitions("centre", "part", F.desc("head"))
        .mapInArrow(_against(percent), "a long, b long")
    )


def _parts(rows: DataFrame, number) -> DataFrame:
    """A row for each of ``number`` parts."""
    return rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), number - 1)))


def list_edges(units: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges that connect what is similar within each list; units are (centre, fp), sets (fp, elements).

    First every member meets the HEADS members that come first in its list: a list of no more is done, and a group of
    near copies is mostly connected, by one edge per member. Then only members outside the list's largest component meet
    the whole list, both in parts of bounded size, and only sets of different components are linked. So rows and edges grow
    with the members of a group of near copies, not with its pairs, and every pair is decided.
    """
    parallel = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = units.groupBy("centre").agg(F.count("*").alias("m"))
    rank = F.row_number().over(Window.partitionBy("centre").orderBy(F.xxhash64("fp"), "fp"))
    parts = F.ceil(F.col("m") / SPREAD)
    first = units.withColumn("rank", rank).where(F.col("rank") <= HEADS).drop("rank").join(sizes, "centre")
    heads = _parts(first, parts).select("centre", "part", F.lit(True).alias("head"), "fp")
    others = units.join(sizes, "centre").select("centre", F.pmod(F.xxhash64(F.lit(2), "fp"), parts).alias("part"), F.lit(False).alias("head"), "fp")
    stars = materialise(_linked(heads.unionByName(others).withColumn("label", F.col("fp")), sets, percent, parallel), "stars")
    long = materialise(units.join(sizes.where(F.col("m") > HEADS), "centre").select("centre", "fp"), "long-lists")
    if long.isEmpty():
        return stars
    roots = components(stars).withColumnRenamed("node", "fp").withColumnRenamed("root", "label")
    named = materialise(long.join(roots, "fp", "left").select("centre", "fp", F.coalesce("label", "fp").alias("label")), "labelled")
    groups = named.groupBy("centre", "label").agg(F.count("*").alias("n"))
    open_lists = groups.groupBy("centre").agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.count("*").alias("groups")).where("groups > 1")
    rest = named.join(open_lists, "centre").where(F.col("label") != F.col("most")).select("centre", "fp", "label")
    rest = materialise(rest.join(sets.select("fp", F.octet_length("elements").alias("bytes")), "fp"), "left-over")
    room = rest.groupBy("centre").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("bytes") / BLOCK_BYTES)).alias("parts"))
    room = room.join(sizes, "centre").select("centre", "parts", F.ceil(F.col("m") / SPREAD).alias("slices"))
    # each part of the left-over members meets each slice of the list, so no task reads a whole list
    own = rest.join(room, "centre").withColumn("own", F.pmod(F.xxhash64(F.lit(3), "fp"), "parts"))
    heads = _parts(own, F.col("slices")).select(
        "centre", (F.col("own") * F.col("slices") + F.col("part")).alias("part"), F.lit(True).alias("head"), "fp", "label"
    )
    piece = F.pmod(F.xxhash64(F.lit(4), "fp"), "slices")
    others = _parts(named.join(room, "centre"), F.col("parts")).select(
        "centre", (F.col("part") * F.col("slices") + piece).alias("part"), F.lit(False).alias("head"), "fp", "label"
    )
    # a part that no left-over member fell into has nothing to compare
    others = others.join(heads.select("centre", "part").distinct(), ["centre", "part"], "left_semi")
    return stars.unionByName(_linked(heads.unionByName(others), sets, percent, parallel))


def heavy_edges(docs: DataFrame, frequent, n: int, percent: int, floor: int, buckets: int) -> DataFrame:
    spark = docs.sparkSession
    entries = docs.select("doc_id", "text").mapInArrow(_invert(n, percent, floor, frequent, buckets), "bucket long, entries binary")
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = materialise(
        entries.repartition(max(parallel, buckets), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_shared, "h long, fp long, spare long, tier long, times long"),
        "lists",
    )
    # a set whose prefix is filled by shingles of its own has no partner
    open_sets = (
        listed.groupBy("fp")
        .agg(F.sum(F.when(F.col("tier") == 0, 1).otherwise(0)).alias("common"), F.first("spare").alias("spare"))
        .withColumn("take", F.col("common") - F.col("spare"))
        .where("take > 0")
        .select("fp", "take")
    )
    spot = Window.partitionBy("fp").orderBy("tier", "times", "h")
    prefix = (
        listed.join(open_sets, "fp").withColumn("spot", F.row_number().over(spot)).where("spot <= take").select("h", "fp")
    )
    prefix = materialise(prefix, "prefixes")
    # lists with the same least member (by hash) are scanned together, so a text goes to few places
    order = F.xxhash64("fp")
    lists = prefix.groupBy("h").agg(F.count("*").alias("n"), F.min(order).alias("centre")).where("n > 1").select("h", "centre")
    units = materialise(prefix.join(lists, "h").select("centre", "fp").distinct(), "units")
    bits = spark.sparkContext.broadcast(bloom.build(units.select("fp").distinct()))
    sets = docs.select("text").mapInArrow(_wanted(n, bits), "fp long, elements binary").groupBy("fp").agg(F.first("elements").alias("elements"))
    return list_edges(units, materialise(sets, "list-sets"), percent)


def _wanted(n: int, bits):
    """(key, elements) of the sets that may be members of a list."""

    def run(batches):
        for b in batches:
            keys, elements, held = [], [], 0
            for _, found in _sets(b.column(0), n):
                key = fingerprint(found)
                if key >= 0 and bloom.may_hold(bits.value, np.array([key], np.int64))[0]:
                    keys.append(key)
                    elements.append(found.tobytes())
                    held += len(elements[-1])
                if held > OUT_BYTES:
                    yield pa.RecordBatch.from_pydict({"fp": pa.array(keys, pa.int64()), "elements": pa.array(elements, pa.binary())})
                    keys, elements, held = [], [], 0
            yield pa.RecordBatch.from_pydict({"fp": pa.array(keys, pa.int64()), "elements": pa.array(elements, pa.binary())})

    return run


def grouped(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, key, n, root) for every row of ``docs`` (doc_id long, text string, key long): its set's size and component."""
    spark = docs.sparkSession
    described = materialise(
        docs.select("doc_id", "text", "key").mapInArrow(
            _describe(n, LIGHT_MOST), "doc_id long, key long, fp long, n long, small binary, hot long, times long"
        ),
        "sets",
    )
    sets = described.where("fp is not null")
    histogram = {
        r["n"]: r["sets"]
        for r in sets.where(F.col("n").between(1, 2 * LIGHT_MOST)).select("fp", "n").distinct().groupBy("n").agg(F.count("*").alias("sets")).collect()
    }
    most = light_boundary(histogram, percent)
    distinct = sets.where(F.col("n") > 0).groupBy("fp").agg(F.first("n").alias("n"), F.first("small").alias("small"))
    entries = sets.agg(F.sum("n")).first()[0] or 0
    hot = (
        described.where("hot is not null").groupBy("hot").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "hot").limit(HOT_MOST).select("hot").toArrow()["hot"].to_numpy()
    )
    frequent = spark.sparkContext.broadcast(np.sort(np.array(hot, np.int64).view(U64)))
    floor = least_overlap(most + 1, percent)
    buckets = max(1, math.ceil(entries * SAMPLED / 8 / BUCKET_ENTRIES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    edges = light_edges(distinct, most, percent).union(heavy_edges(docs, frequent, n, percent, floor, buckets))
    roots = components(edges)
    return sets.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("doc_id", "key", "n", F.coalesce("root", "fp").alias("root"))


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("key")
    )


def jaccard_groups(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (columns ``doc_id``, ``text``; others are ignored).

    Words are runs of non-space characters with A-Z lower-cased. A text with fewer than ``n`` words is one
    shingle. Null, empty and blank texts have no shingles and link with nothing: their component is their own
    doc_id. Rows that repeat (or that share a doc_id) each give a row. A null doc_id counts as no id: the row
    takes part, and gets the least id of its component, or null if that has none. An empty table gives no rows.
    """
    named = grouped(_plain(docs), n, percent)
    least = named.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return named.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of linked documents: that of the least doc_id.

    All columns stay. Where that doc_id repeats, one of its rows is kept (by the hash of its text, then by all
    columns). Rows without shingles or without doc_id are never removed.
    """
    rows = materialise(grouped(_plain(docs), n, percent).where("n > 0 and doc_id is not null"), "groups")
    kept = rows.groupBy("root").agg(F.min(F.struct("doc_id", "key"))["key"].alias("kept"))
    gone = rows.join(kept, "root").where("key <> kept").select("key").distinct()
    again = rows.join(kept, "root").where("key = kept").groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key")
    gone, again = materialise(gone, "gone"), materialise(again, "again")
    keyed = docs.withColumn("_key", F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    first = Window.partitionBy("_key").orderBy(*docs.columns)
    once = only(keyed, "_key", again).withColumn("_row", F.row_number().over(first)).where("_row = 1")
    return without(keyed, "_key", gone.union(again)).unionByName(once.drop("_row")).select(*docs.columns)
