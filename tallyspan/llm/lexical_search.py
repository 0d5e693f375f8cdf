"""Ranked lexical search by pipelined term partitioning.

Documents are cut into blocks and inverted, keeping terms that any item asks for. Terms belong to owners, by the share
of documents that hold them: the rare ones' owner comes first. Items travel in bundles from owner to owner. A bundle
carries, for each block, a sparse accumulator of document scores; a stage is a cogroup of the bundles' accumulators
with the owner's postings for the same (bundle, block), so a group is bounded by the block, however frequent a term is.

Scores are integers and only grow. After a stage the k-th best accumulator of an item over all blocks is a bound on its
k-th result. With the most that later owners can add, it tells exactly which accumulators are still needed, and whether
a document without one can still come in. So the frequent terms' owners mostly update a few documents.

Terms are 64-bit hashes of whole texts' terms: two different ones would be taken for one with a chance of 2^-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyspan.llm import bloom
from tallyspan.llm.numbered import numbered
from tallyspan.llm.words import ALNUM, rows_of_words
from tallyspan.session import materialise

SHARES = (1024, 64, 8)  # owners by document frequency: at most 1/1024 of the documents, 1/64, 1/8, more
OWNERS = len(SHARES) + 1
BUNDLE = 256  # items that travel together
BLOCK_DOCS = 8192
BLOCK_ENTRIES = 500_000
ITEMS_AT_ONCE = 1 << 16  # items of one round: what bounds are broadcast for

ENTRY = np.dtype([("h", "<u8"), ("doc", "<u4"), ("tf", "<u4")])
SCORE = np.dtype([("slot", "<u4"), ("doc", "<u4"), ("score", "<i8")])


def item_terms(items: DataFrame) -> DataFrame:
    """(slot, h, q): how often an item (slot, text) holds a term."""

    def run(batches):
        for batch in batches:
            slots = batch.column(0).to_pylist()
            for row, found in rows_of_words(batch.column(1), ALNUM):
                h, q = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_pydict({"slot": pa.array([slots[row]] * len(h), pa.int64()), "h": pa.array(h.view(np.int64)), "q": pa.array(q)})

    return items.select("slot", "text").mapInArrow(run, "slot long, h long, q long")


def _invert(bits):
    """Blocks of documents: ids, lengths in terms, and entries (term, document in the block, frequency) of terms that may be asked for."""

    def run(batches):
        ids, lengths, held, size = [], [], [], 0

        def block():
            rows = np.concatenate(held)
            return pa.RecordBatch.from_pydict(
                {
                    "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                    "lengths": pa.array([lengths], pa.list_(pa.int64())),
                    "entries": [rows[np.argsort(rows["h"], kind="stable")].tobytes()],
                    "n_docs": pa.array([len(ids)], pa.int64()),
                    "n_terms": pa.array([sum(lengths)], pa.int64()),
                }
            )

        for batch in batches:
            names = batch.column(0).to_pylist()
            for row, found in rows_of_words(batch.column(1), ALNUM):
                if not len(found):
                    continue
                h, tf = np.unique(found[bloom.may_hold(bits.value, found)], return_counts=True)
                entries = np.empty(len(h), ENTRY)
                entries["h"], entries["doc"], entries["tf"] = h, len(ids), tf
                held.append(entries)
                ids.append(names[row])
                lengths.append(len(found))
                size += len(h)
                if len(ids) == BLOCK_DOCS or size >= BLOCK_ENTRIES:
                    yield block()
                    ids, lengths, held, size = [], [], [], 0
        if ids:
            yield block()

    return run


def length_factor(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of each document, in whole numbers."""
    if 25 * int(lengths.max(initial=0)) * n_docs < 1 << 63:
        return 75 + 25 * lengths * n_docs // n_terms
    return np.array([75 + 25 * int(n) * n_docs // n_terms for n in lengths], np.int64)


def _postings(n_docs: int, n_terms: int):
    """(block, h, docs, parts, df, top): a term's documents in a block and what each gives per unit of weight."""

    def run(batches):
        for batch in batches:
            for number, lengths, entries in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                rows = np.frombuffer(entries.as_buffer(), ENTRY)
                if not len(rows):
                    continue
                m = length_factor(lengths.values.to_numpy(zero_copy_only=False), n_docs, n_terms)
                tf = rows["tf"].astype(np.int64)
                part = (1_000_000_000 * tf // (1000 * tf + 12 * m[rows["doc"]])).astype(np.uint32)
                first = np.flatnonzero(np.concatenate(([True], rows["h"][1:] != rows["h"][:-1])))
                last = np.append(first[1:], len(rows))
                doc = np.ascontiguousarray(rows["doc"])
                for a in range(0, len(first), 4096):
                    cuts = list(zip(first[a : a + 4096].tolist(), last[a : a + 4096].tolist()))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "block": pa.array([number] * len(cuts), pa.int64()),
                            "h": pa.array(rows["h"][first[a : a + 4096]].astype(np.uint64).view(np.int64)),
                            "docs": [doc[x:y].tobytes() for x, y in cuts],
                            "parts": [part[x:y].tobytes() for x, y in cuts],
                            "df": pa.array([y - x for x, y in cuts], pa.int64()),
                            "top": pa.array(np.maximum.reduceat(part, first)[a : a + 4096].astype(np.int64)),
                        }
                    )

    return run


def _stage(owner: int, shared, k: int):
    """One owner's work for the accumulators of a bundle in a block."""

    def run(key, left, right):
        bound, kth = shared.value
        last = owner == OWNERS - 1
        carried = [np.frombuffer(a.as_buffer(), SCORE) for a in left.column("acc")]
        acc = np.concatenate(carried) if carried else np.zeros(0, SCORE)
        docs = [np.frombuffer(x.as_buffer(), np.uint32) for x in right.column("docs")]
        parts = [np.frombuffer(x.as_buffer(), np.uint32) for x in right.column("parts")]
        weights = right.column("w").to_pylist()
        asked: dict[int, list] = {}
        for t, slots in enumerate(right.column("slots").to_pylist()):
            for s in slots:
                asked.setdefault(s["slot"], []).append((t, s["q"]))
        size = 1 + max([int(d[-1]) for d in docs] + [int(acc["doc"].max(initial=0))])
        out = []
        slots = sorted({*asked, *np.unique(acc["slot"]).tolist()})
        # accumulators are in the order of slots
        begin, end = (np.searchsorted(acc["slot"], np.array(slots, np.uint32), side) for side in ("left", "right"))
        for slot, a, b in zip(slots, begin, end):
            rest, least = int(bound[slot, owner:].sum()), int(kth[slot])
            after = int(bound[slot, owner + 1 :].sum())
            own, score = acc["doc"][a:b], acc["score"][a:b]
            still = score + rest >= least
            own, score = own[still], score[still].copy()
            if rest >= least:  # a document without an accumulator can still come in
                total = np.zeros(size, np.int64)
                total[own] = score
                for t, q in asked.get(slot, ()):
                    total[docs[t]] += q * weights[t] * parts[t].astype(np.int64)
                own = np.flatnonzero(total).astype(np.uint32)
                score = total[own]
            elif len(own):
                for t, q in asked.get(slot, ()):
                    at = np.minimum(np.searchsorted(docs[t], own), len(docs[t]) - 1)
                    score += np.where(docs[t][at] == own, q * weights[t] * parts[t][at].astype(np.int64), 0)
            good = (score + after >= least) & (score > 0)
            own, score = own[good], score[good]
            if last and len(own) > k:
                good = score >= np.partition(score, len(score) - k)[len(score) - k]  # ties stay: ids decide
                own, score = own[good], score[good]
            rows = np.empty(len(own), SCORE)
            rows["slot"], rows["doc"], rows["score"] = slot, own, score
            out.append(rows)
        rows = np.concatenate(out) if out else acc[:0]
        if last:
            return pa.table(
                {
                    "block": pa.array([key[1].as_py()] * len(rows), pa.int64()),
                    "slot": pa.array(rows["slot"].astype(np.int64)),
                    "doc": pa.array(rows["doc"].astype(np.int64)),
                    "score": pa.array(np.ascontiguousarray(rows["score"])),
                }
            )
        kept = [rows.tobytes()] if len(rows) else []
        return pa.table(
            {
                "bundle": pa.array([key[0].as_py()] * len(kept), pa.int64()),
                "block": pa.array([key[1].as_py()] * len(kept), pa.int64()),
                "acc": pa.array(kept, pa.binary()),
            }
        )

    return run


def _best(k: int):
    """(slot, score): a task's k best accumulators of each item."""

    def run(batches):
        top = np.zeros(0, SCORE)
        for batch in batches:
            for a in batch.column(0):
                rows = np.concatenate((top, np.frombuffer(a.as_buffer(), SCORE)))
                rows = rows[np.lexsort((-rows["score"], rows["slot"]))]
                first = np.searchsorted(rows["slot"], rows["slot"])
                top = rows[np.arange(len(rows)) - first < k]
        yield pa.RecordBatch.from_pydict({"slot": pa.array(top["slot"].astype(np.int64)), "score": pa.array(np.ascontiguousarray(top["score"]))})

    return run


def _kth(accumulators: DataFrame, n_slots: int, k: int) -> np.ndarray:
    """Each item's k-th best accumulator over all blocks; 0 where it has fewer."""
    rank = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("score")))
    best = accumulators.select("acc").mapInArrow(_best(k), "slot long, score long").withColumn("rank", rank).where(F.col("rank") == k)
    out = np.zeros(n_slots, np.int64)
    for r in best.select("slot", "score").collect():
        out[r["slot"]] = r["score"]
    return out


def _round(asked: DataFrame, postings: DataFrame, n_slots: int, k: int) -> DataFrame:
    """(block, slot, doc, score) of what may be among the k best of items 0 … n_slots - 1; ``asked`` has (slot, h, q, w, top, owner)."""
    spark = postings.sparkSession
    bound = np.zeros((n_slots, OWNERS), np.int64)
    for r in asked.groupBy("slot", "owner").agg(F.sum(F.col("q") * F.col("w") * F.col("top")).alias("most")).collect():
        bound[r["slot"], r["owner"]] = r["most"]
    bundled = asked.groupBy(F.floor(F.col("slot") / BUNDLE).alias("bundle"), "owner", "h", "w").agg(F.collect_list(F.struct("slot", "q")).alias("slots"))
    bundled = materialise(bundled, "bundles")
    kth = np.zeros(n_slots, np.int64)
    accumulators = spark.createDataFrame([], "bundle long, block long, acc binary")
    for owner in range(OWNERS):
        own = postings.select("block", "h", "docs", "parts").join(bundled.where(F.col("owner") == owner).select("bundle", "h", "w", "slots"), "h").drop("h")
        last = owner == OWNERS - 1
        schema = "block long, slot long, doc long, score long" if last else "bundle long, block long, acc binary"
        stage = _stage(owner, spark.sparkContext.broadcast((bound, kth)), k)
        accumulators = accumulators.groupBy("bundle", "block").cogroup(own.groupBy("bundle", "block")).applyInArrow(stage, schema)
        if not last:
            accumulators = materialise(accumulators, f"owner{owner}")
            kth = _kth(accumulators, n_slots, k)
    return accumulators


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item, of those with a score above 0. Runs jobs when called.

    Null and empty texts have no terms: such documents are not counted, such items have no results. Rows of ``docs``
    that repeat, or share a doc_id, are documents of their own; a row of ``items`` that repeats is one item, and
    different texts under one item_id are ranked each by itself. Equal scores go by doc_id, null first. An item with
    fewer matches has fewer rows; empty tables give none. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = items.select(F.col("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    slots = materialise(numbered(texts, "slot"), "items")
    n_items = slots.count()
    terms = materialise(item_terms(slots), "item-terms")
    bits = spark.sparkContext.broadcast(bloom.build(terms.select("h").distinct()))
    blocks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _invert(bits), "doc_ids array<long>, lengths array<long>, entries binary, n_docs long, n_terms long"
    )
    blocks = numbered(blocks, "block")
    n_docs, n_terms = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    postings = blocks.select("block", "lengths", "entries").mapInArrow(
        _postings(n_docs, n_terms), "block long, h long, docs binary, parts binary, df long, top long"
    )
    postings = materialise(postings, "postings")
    facts = postings.groupBy("h").agg(F.sum("df").alias("df"), F.max("top").alias("top"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0)))
    owner = F
    for number, share in enumerate(SHARES):
        owner = owner.when(F.col("df") * share <= n_docs, number)
    asked = terms.join(facts, "h").select("slot", "h", "q", weight.cast("long").alias("w"), "top", owner.otherwise(OWNERS - 1).alias("owner"))
    asked = materialise(asked.where("w > 0"), "asked")
    found = None
    for first in range(0, n_items, ITEMS_AT_ONCE):
        size = min(ITEMS_AT_ONCE, n_items - first)
        own = asked.where(F.col("slot").between(first, first + size - 1)).withColumn("slot", F.col("slot") - first)
        best = _round(own, postings, size, k).withColumn("slot", F.col("slot") + first)
        found = best if found is None else found.unionByName(best)
    if found is None:
        return slots.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    named = found.join(blocks.select("block", "doc_ids"), "block").withColumn("doc_id", F.get("doc_ids", F.col("doc").cast("int")))
    order = Window.partitionBy("slot").orderBy(F.desc("score"), F.asc("doc_id"), "block", "doc")
    ranked = named.select("slot", "score", "doc_id", "block", "doc").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(slots.select("slot", "item_id"), "slot").select("item_id", "rank", "doc_id", "score")
