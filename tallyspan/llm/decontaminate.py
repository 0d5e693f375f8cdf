"""Benchmark decontamination: rare word pairs are seeds of candidate passages, Smith-Waterman alignment scores them.

1. How many documents hold each pair of adjacent words of the test items is counted over the whole corpus.
2. An alignment of score s with m matches in r unbroken runs has at least r - 1 edits, so s <= m - r + 1, and
   m - r >= s - 1 pairs of the item stand in it unbroken. An item of L words that needs a score of s therefore
   has its L - s + 1 rarest pairs as seeds: they leave s - 2 of its L - 1 pairs, too few for any alignment, so
   every passage that reaches the score holds a seed, wherever its edits are and whichever pairs they break.
3. Documents are joined to items on the seeds. A Bloom filter of fixed size thins the documents' n-grams
   before the exact join, so no table of them is written.
4. The parts of a document around its seeds that hold s - 1 pairs of the item are aligned with the item, word by word. The score is the best
   local alignment (a match 1, a mismatch or gap -1) as a share of the item's words.

Words are runs of letters and digits, lower-cased. Texts that are equal are aligned once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyspan.llm import bloom
from tallyspan.llm.rows import without
from tallyspan.llm.words import ALNUM, U64, chunks, grams, mix, span_hashes, text_bytes, word_hashes
from tallyspan.session import materialise

RUN = 2  # words of a seed; the bound above is one of pairs

def _text_keys(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 63-bit key of each row's text."""
    hashes = span_hashes(data, bounds[:-1], bounds[1:])
    return (mix(hashes ^ np.diff(bounds).astype(U64)) >> U64(1)).astype(np.int64)


def _grams_by_row(column: pa.Array, n: int):
    """(first row, text keys, n-gram hashes, their word place in the text, their row in the chunk)."""
    data, bounds = text_bytes(column)
    for first, last in chunks(bounds):
        own = bounds[first : last + 1] - bounds[first]
        part = data[bounds[first] : bounds[last]]
        words, _, _, at = word_hashes(part, own, ALNUM)
        found = grams(words, n)
        row = np.repeat(np.arange(last - first), np.diff(at))
        place = np.arange(len(words)) - at[row] if len(words) else np.zeros(0, np.int64)
        whole = (row[: len(found)] == row[n - 1 :]) if len(found) else np.zeros(0, bool)
        yield first, _text_keys(part, own), found[whole], place[: len(found)][whole], row[: len(found)][whole]


def _items(n: int):
    """(item, its text, pair, place) of items of at least ``n`` words."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, keys, found, place, row in _grams_by_row(batch.column(1), RUN):
                long = np.bincount(row, minlength=len(keys))[row] >= n - RUN + 1
                found, place, row = found[long], place[long], row[long]
                yield pa.RecordBatch.from_pydict(
                    {"item_id": pa.array(ids[first + row]), "item": pa.array(keys[row]), "h": pa.array(found.view(np.int64)), "place": pa.array(place)}
                )

    return run


def _held(bits):
    """(gram, documents): of this task, for grams that the filter may hold."""

    def run(batches):
        counts: dict[int, int] = {}
        for batch in batches:
            for _, _, found, _, row in _grams_by_row(batch.column(0), RUN):
                hit = bloom.may_hold(bits.value, found)
                pairs = np.unique(np.rec.fromarrays([found[hit], row[hit]])) if hit.any() else ()
                if len(pairs):
                    for h, c in zip(*np.unique(pairs["f0"], return_counts=True)):
                        counts[int(h)] = counts.get(int(h), 0) + int(c)
        if counts:
            yield pa.RecordBatch.from_pydict(
                {"h": pa.array(np.array(list(counts), U64).view(np.int64)), "docs": pa.array(list(counts.values()), pa.int64())}
            )

    return run


def _hits(bits):
    """(text, gram, place) for grams that may be seeds."""

    def run(batches):
        for batch in batches:
            for _, keys, found, place, row in _grams_by_row(batch.column(0), RUN):
                hit = bloom.may_hold(bits.value, found)
                if hit.any():
                    yield pa.RecordBatch.from_pydict(
                        {"text_key": pa.array(keys[row[hit]]), "h": pa.array(found[hit].view(np.int64)), "at": pa.array(place[hit])}
                    )

    return run


def _wanted(bits):
    def run(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for first, last in chunks(bounds):
                own = bounds[first : last + 1] - bounds[first]
                keys = _text_keys(data[bounds[first] : bounds[last]], own)
                want = pa.array(bloom.may_hold(bits.value, keys))
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).filter(want), pa.array(keys).filter(want), part.column(1).filter(want)], ["doc_id", "text_key", "text"]
                )

    return run


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """(score, start, end) of the best local alignment of ``item`` in ``passage``, the first of equal ones.

    One row of the table at a time; gaps along the passage come from a running maximum.
    """
    width = len(passage)
    columns = np.arange(1, width + 1)
    above, above_from = np.zeros(width + 1, np.int64), np.arange(width + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = above[:-1] + np.where(passage == word, 1, -1)
        up = above[1:] - 1
        score = np.maximum(np.maximum(diagonal, up), 0)
        origin = np.where(score == diagonal, above_from[:-1], np.where(score == up, above_from[1:], columns))
        origin = np.where(score == 0, columns, origin)
        lifted = score + columns
        top = np.maximum.accumulate(lifted)
        leader = np.maximum.accumulate(np.where(lifted == top, np.arange(width), 0))
        along = top - columns
        origin = np.where(along > score, origin[leader], origin)
        score = np.maximum(score, along)
        k = int(score.argmax())
        if score[k] > best[0]:
            best = (int(score[k]), int(origin[k]), k + 1)
        above, above_from = np.concatenate(([0], score)), np.concatenate(([0], origin))
    return best


def regions(starts: list[int], length: int, size: int) -> list[tuple[int, int]]:
    """Word ranges around the places where an item of ``length`` words would start, overlapping ones joined."""
    out: list[list[int]] = []
    for s in sorted(set(starts)):
        a, b = max(0, s - length // 2), min(size, s + length + length // 2 + 1)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _words(column: pa.Array, row: int) -> np.ndarray:
    data, bounds = text_bytes(column.slice(row, 1))
    own = data[bounds[0] : bounds[1]]
    return word_hashes(own, np.array([0, len(own)]), ALNUM)[0]


def _scored(least: float):
    def run(batches):
        for batch in batches:
            texts, items = batch.column("text"), batch.column("item_text")
            out = []
            for k, starts in enumerate(batch.column("starts").to_pylist()):
                words, item = _words(texts, k), _words(items, k)
                pairs, need = grams(item, RUN), math.ceil(least * len(item)) - 1
                near = [(a, b) for a, b in regions(starts, len(item), len(words)) if np.isin(pairs, grams(words[a:b], RUN)).sum() >= need]
                found = max(
                    ((s, a + x, a + y) for a, b in near for s, x, y in [align(item, words[a:b])]),
                    key=lambda r: (r[0], -r[1]), default=(0, 0, 0),
                )
                if found[0] >= least * len(item) and found[0] > 0:
                    out.append((batch.column("text_key")[k].as_py(), batch.column("item")[k].as_py(), found[0] / len(item), found[1], found[2]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 5, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                ["text_key", "item", "score", "start_word", "end_word"],
            )

    return run


def _lower():
    return F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))


def without_leaks(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not in ``found``, as ``leaks`` returns it, whatever their doc_id.

    A text is known by its 63-bit key, as in ``leaks``. Runs a job over the keys when called.
    """

    names = [*docs.columns, "_text_key"]

    def keyed(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column(batch.num_columns - 1))
            keys = [_text_keys(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]) for a, b in chunks(bounds)]
            own = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], own], names)

    kinds = StructType([*docs.schema.fields, StructField("_text_key", LongType())])
    return without(docs.select("*", _lower().alias("_lower")), "_text_key", found.select("text_key"), (keyed, kinds)).select(docs.columns)


def leaks(docs: DataFrame, benchmark: DataFrame, n: int = 4, least: float = 0.5) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word, text_key): documents and the items they leak.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are ignored. Items with fewer
    than ``n`` words match nothing, as do null and empty texts. All pairs whose best alignment has ``least`` of the
    item's words as its score are found, provided that ``least * n`` is over 1 (a score of 1 is a single word). Rows or items that repeat each
    give their pairs; of several places in one text the best is returned, the first of equal ones.
    """
    spark = docs.sparkSession
    lower = _lower()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lower.alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), lower.alias("text"))
    placed = materialise(items.mapInArrow(_items(n), "item_id long, item long, h long, place long"), "item-grams")
    all_bits = spark.sparkContext.broadcast(bloom.build(placed.select("h").distinct()))
    held = docs.select("text").mapInArrow(_held(all_bits), "h long, docs long").groupBy("h").agg(F.sum("docs").alias("docs"))
    rare = placed.select("item", "h", "place").distinct().join(held, "h", "left").select("item", "h", "place", F.coalesce("docs", F.lit(0)).alias("docs"))
    size = F.max("place").over(Window.partitionBy("item")) + RUN
    nth = F.row_number().over(Window.partitionBy("item").orderBy("docs", "h", "place"))
    seeds = (
        rare.withColumn("words", size).withColumn("nth", nth)
        .where(F.col("nth") <= F.col("words") - F.ceil(F.lit(float(least)) * F.col("words")) + 1)
        .select("item", "h", "place")
    )
    seeds = materialise(seeds, "seeds")
    bits = spark.sparkContext.broadcast(bloom.build(seeds.select("h").distinct()))
    candidates = (
        docs.select("text")
        .mapInArrow(_hits(bits), "text_key long, h long, at long")
        .distinct()
        .join(seeds, "h")
        .groupBy("text_key", "item")
        .agg(F.collect_set(F.col("at") - F.col("place")).alias("starts"))
    )
    candidates = materialise(candidates, "candidates")
    few = spark.sparkContext.broadcast(bloom.build(candidates.select("text_key").distinct()))
    texts = materialise(docs.mapInArrow(_wanted(few), "doc_id long, text_key long, text string"), "candidate-texts")
    once = texts.groupBy("text_key").agg(F.first("text").alias("text"))
    named = items.join(placed.select("item_id", "item").distinct(), "item_id")
    item_texts = named.groupBy("item").agg(F.first("text").alias("item_text"))
    scored = (
        candidates.join(item_texts, "item")
        .join(once, "text_key")
        .select("text_key", "item", "starts", "text", "item_text")
        .mapInArrow(_scored(least), "text_key long, item long, score double, start_word long, end_word long")
    )
    return (
        materialise(scored, "scored")
        .join(texts.select("doc_id", "text_key"), "text_key")
        .join(placed.select("item", "item_id").distinct(), "item")
        .select("doc_id", "item_id", "score", "start_word", "end_word", "text_key")
    )
