"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text, per language.

The units are the bytes of the texts, all 256 apart, in runs of ``LONGEST``: any script, letter case, digit and mark counts as itself.
A space or line break after a word that equals the word before it is a unit of its own, the byte 0xFF, which no text holds:
runs of bytes are too short to see a word said again, and trusted text seldom says one again. A run is a key of 64 bits, exact. Only runs that
stand in texts are counted, so the model grows with them. Counts are kept and joined as Spark tables sharded by (language, n-gram):
raw counts for the highest order, counts of different predecessors below, discounts from counts of counts,
context weights, and each order joined with the next lower one. The model stays a Spark table. To score texts, they
are cut into blocks of one language; the different n-grams of each block are joined with the model by (language,
n-gram), where unseen ones take their contexts' weights of the lower orders, and the probabilities found go back to
their block. No task and no driver holds a model, so any number of languages has models of its own.

A document's log probability is drawn towards its language's mean by a fixed number of units, so that a few
words are no evidence. It is rejected where its perplexity is beyond a limit set by quantiles of the trusted
documents of its language: the upper quantile plus a share of its distance from the median. A trusted document's perplexity is
for this that under a model of the other part of the trusted documents, which are parted by a hash: a model that has read a text knows its long runs. That limit is drawn
towards the median plus the distance that trusted documents of all languages have from theirs (or, if that is more, the
distance of the language's lower quantile), the more, the fewer trusted documents the language has. A language with too few of them for a model is scored by the model of all
languages; the median is then that of its own documents, of which no more than half may be bad.
"""

from __future__ import annotations

import io
import math
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tallyspan.llm import bloom
from tallyspan.llm.rows import without
from tallyspan.llm.words import CHUNK_BYTES, LOWER, SPACED, chunks, text_bytes, word_spans
from tallyspan.session import bucketed, discard, materialise, written

LONGEST = 5  # bytes in the runs of the models that queries train; a key holds up to 7
ORDER = 3  # of a model that is not said to have another: ``dense`` shows one of this order whole
BITS = 8
SYMBOLS = 1 << BITS
AT_ONCE = 16  # blocks whose n-grams a task holds at once
HELD_GRAMS = 1 << 20  # counted n-grams that a task holds at once
TABLE = 1 << 23  # cells of a table that numbers n-grams; beyond that they are sorted
BLOCK_BYTES = 1 << 20  # texts of one language in a row; a longer text is a row of its own
ASK_BYTES = 1 << 23  # texts of one language that ask for their n-grams together: the more, the fewer rows ask for the same one
HELD_BYTES = 1 << 25  # texts that a task holds while its blocks fill up
POOLED = "*"
ALL, PARTS = "a", ("0", "1")  # before a language's name while a model is trained: of all trusted texts, of those outside a part
_NEWLINE = 10
_AGAIN = 255
PRIOR = 20  # trusted documents that weigh as much as what is known of all languages


@dataclass
class Model:
    """Languages with models of their own, then that of all; (lang, n, key, p, rest); means and limits by language."""

    languages: dict[str, int] = field(default_factory=dict)
    grams: DataFrame | None = None
    mean: dict[str, float] = field(default_factory=dict)
    limit: dict[str, float] = field(default_factory=dict)
    drawn_by: float = 200.0
    order: int = ORDER

    def own(self, lang: str) -> str:
        """The language whose model a language is scored by."""
        return lang if lang in self.languages else POOLED

    def pool(self, lang: str) -> str:
        """The model of all languages beside that of ``own``."""
        return POOLED

    def pools(self, lang: str):
        """``pool`` of a column."""
        return F.lit(POOLED)

    def means(self, languages: list[str]) -> np.ndarray:
        return np.array([self.mean.get(x, self.mean.get(POOLED, 0.0)) for x in languages])

    def limits(self, languages: list[str]) -> np.ndarray:
        return np.array([self.limit.get(x, self.limit.get(POOLED, math.inf)) for x in languages])


class HeldOut(Model):
    """Names are a part and a language: a part's texts are scored by what stands outside it, or else by the model of all parts."""

    def own(self, lang: str) -> str:
        return next((x for x in (lang, ALL + lang[1:]) if x in self.languages), self.pool(lang))

    def pool(self, lang: str) -> str:
        return lang[:1] + POOLED if lang[:1] + POOLED in self.languages else ALL + POOLED

    def pools(self, lang: str):
        return F.coalesce(*[F.when(F.substring(lang, 1, 1) == x, F.lit(self.pool(x))) for x in (ALL, *PARTS)])


def said_again(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places of the spaces and line breaks after words that equal the word before; A-Z are lower-cased."""
    starts, ends, first = word_spans(data, bounds, SPACED)
    if len(starts) < 2:
        return np.empty(0, np.int64)
    size = ends - starts
    same = np.zeros(len(starts), bool)
    same[1:] = (size[1:] == size[:-1]) & (LOWER[data[starts[1:]]] == LOWER[data[starts[:-1]]]) & (LOWER[data[ends[1:] - 1]] == LOWER[data[ends[:-1] - 1]])
    same[first[:-1][first[:-1] < len(starts)]] = False  # the first word of a text
    again = np.flatnonzero(same)
    if len(again) == 0:
        return again
    size, back = size[again], starts[again] - starts[again - 1]
    before = np.concatenate(([0], np.cumsum(size)[:-1]))
    at = np.repeat(starts[again] - before, size) + np.arange(size.sum())
    differ = np.add.reduceat((LOWER[data[at]] != LOWER[data[at - np.repeat(back, size)]]).astype(np.int64), before)
    again = again[differ == 0]
    text = np.searchsorted(first, again, "right") - 1
    return ends[again][ends[again] < bounds[text + 1]]


def symbols_of(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The unit of each byte."""
    symbols = data.copy()
    symbols[said_again(data, bounds)] = _AGAIN
    return symbols


def _numbered(symbols: np.ndarray, ends: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(the different n-grams that end at ``ends``, ascending; the number of each end's one in them), numbered order by order."""
    used = np.flatnonzero(np.bincount(symbols, minlength=SYMBOLS))
    rank = np.zeros(SYMBOLS, np.int64)
    rank[used] = np.arange(len(used))
    last = rank[symbols]
    keys, ids = np.zeros(1, np.int64), np.zeros(len(symbols) + 1, np.int32)
    for n in range(1, order + 1):
        # ids[i] is of the run of n - 1 units before last[i + n - 1]
        code = ids[: len(last) - n + 1] * np.int64(len(used)) + last[n - 1 :]
        if n == order:
            code = code[ends - (n - 1)]
        cells = len(keys) * len(used)
        if cells > TABLE:
            found, ids = np.unique(code, return_inverse=True)
        else:
            seen = np.zeros(cells, bool)
            seen[code] = True
            found, ids = np.flatnonzero(seen), (np.cumsum(seen, dtype=np.int32) - 1)[code]
        keys = (keys[found // len(used)] << BITS) | used[found % len(used)]
    return keys, ids


def _pieces(symbols: np.ndarray, bounds: np.ndarray, order: int):
    """(first unit, end, different n-grams, ascending, the number of the one that ends at each unit) of runs of units.

    Before its first unit a text has newlines.
    """
    pad = order - 1
    for first, last in chunks(bounds):
        begin, end = int(bounds[first]), int(bounds[last])
        if last == first + 1:  # a text of any length
            for a in range(begin, end, CHUNK_BYTES):
                b, back = min(a + CHUNK_BYTES, end), min(pad, a - begin)
                own = np.concatenate((np.full(pad - back, _NEWLINE, np.uint8), symbols[a - back : b]))
                yield a, b, *_numbered(own, np.arange(pad, len(own)), order)
        elif end > begin:
            sizes = np.diff(bounds[first : last + 1])
            sizes = sizes[sizes > 0]
            ends = np.arange(end - begin) + pad * (1 + np.repeat(np.arange(len(sizes)), sizes))
            own = np.full(end - begin + pad * len(sizes), _NEWLINE, np.uint8)
            own[ends] = symbols[begin:end]
            yield begin, end, *_numbered(own, ends, order)


def gram_keys(data: np.ndarray, bounds: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each byte: its bytes, the last one lowest."""
    return np.concatenate([np.zeros(0, np.int64), *(keys[ids] for _, _, keys, ids in _pieces(symbols_of(data, bounds), bounds, order))])


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts (n-grams, how often) in one."""
    keys, ids = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, ids, np.concatenate([c for _, c in parts]))
    return keys, total


def _counts(order: int):
    """(lang, key, c) of texts (lang, text): n-gram counts of a task, where an n-gram may stand in several rows."""

    def run(batches):
        own: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def counted():
            for lang, parts in own.items():
                keys, c = parts[0]
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(keys), pa.string()), "key": pa.array(keys), "c": pa.array(c)})
            own.clear()

        for batch in batches:
            languages = np.array(batch.column(0).to_pylist(), object)
            data, bounds = text_bytes(batch.column(1))
            for first, last in chunks(bounds):
                at = bounds[first : last + 1] - bounds[first]
                symbols = symbols_of(data[bounds[first] : bounds[last]], at)
                for lang in sorted(set(languages[first:last])):
                    mine = languages[first:last] == lang
                    sizes = np.diff(at)
                    held = symbols[np.repeat(mine, sizes)]
                    for _, _, keys, ids in _pieces(held, np.concatenate(([0], np.cumsum(sizes[mine]))), order):
                        own.setdefault(lang, []).append((keys, np.bincount(ids, minlength=len(keys))))
                        size += len(keys)
                if size > HELD_GRAMS:
                    for lang, parts in own.items():
                        own[lang] = [_added(parts)]
                    size = sum(len(parts[0][0]) for parts in own.values())
                    if size > HELD_GRAMS // 2:
                        yield from counted()
                        size = 0
        for lang, parts in own.items():
            own[lang] = [_added(parts)]
        yield from counted()

    return run


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, n, key, p, rest) from counts (lang, key, c) of the highest order.

    ``p`` is the interpolated probability of a seen n-gram; ``rest`` is the weight that its context
    ``key >> BITS`` leaves to the lower order.
    """
    tables = {order: counts}
    for n in range(order - 1, 0, -1):
        mask = (1 << BITS * n) - 1
        tables[n] = materialise(
            tables[n + 1].groupBy("lang", F.col("key").bitwiseAND(mask).alias("key")).agg(F.count("*").alias("c")), f"grams{n}"
        )
    done = []
    lower = None
    for n in range(1, order + 1):
        t = tables[n]
        times = t.groupBy("lang").agg(*[F.count_if(F.col("c") == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)])
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        formula = lambda k, y=y: F.when(
            (F.col(f"n{k}") > 0) & (F.col("n1") > 0), F.greatest(F.lit(0.05), F.least(F.lit(float(k)), k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")))
        ).otherwise(F.lit(0.5 * k))
        discounts = times.select("lang", *[formula(k).alias(f"d{k}") for k in (1, 2, 3)])
        context = F.shiftright("key", BITS)
        cut = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        cut = F.least(cut, F.col("c").cast("double"))
        cutted = t.join(discounts, "lang").select("lang", "key", "c", context.alias("h"), cut.alias("cut"))
        contexts = cutted.groupBy("lang", "h").agg(F.sum("c").alias("total"), F.sum("cut").alias("freed"))
        own = cutted.join(contexts, ["lang", "h"]).withColumn("rest", F.col("freed") / F.col("total"))
        kept = (F.col("c") - F.col("cut")) / F.col("total")
        if lower is None:
            out = own.withColumn("p", kept + F.col("rest") / SYMBOLS)
        else:
            below = lower.select("lang", F.col("key").alias("low"), F.col("p").alias("p_low"))
            out = own.withColumn("low", F.col("key").bitwiseAND((1 << BITS * (n - 1)) - 1)).join(below, ["lang", "low"])
            out = out.withColumn("p", kept + F.col("rest") * F.col("p_low"))
        lower = materialise(out.select("lang", F.lit(n).alias("n"), "key", "p", "rest"), f"kn{n}")
        done.append(lower)
    out = done[0]
    for t in done[1:]:
        out = out.unionByName(t)
    return out


def dense(grams: DataFrame, languages: list[str]) -> np.ndarray:
    """All log probabilities of runs of ORDER units per language on the driver, to look at a small model; no query uses it."""
    number = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")) - 1
    rows = grams.select(number.cast("byte").alias("lang"), F.col("n").cast("byte").alias("n"), F.col("key").cast("int").alias("key"), F.col("p").cast("double").alias("p"), F.col("rest").cast("double").alias("rest")).toArrow()
    out = np.zeros((len(languages), SYMBOLS**ORDER), np.float32)
    which, order, keys, probs, rests = (rows[c].to_numpy() for c in ("lang", "n", "key", "p", "rest"))
    for i in range(len(languages)):
        p = np.full(1, 1.0 / SYMBOLS)
        for n in range(1, ORDER + 1):
            part = (which == i) & (order == n)
            key, prob, left = keys[part], probs[part], rests[part]
            rest = np.ones(SYMBOLS ** (n - 1))
            rest[key >> BITS] = left
            wide = np.tile(p, SYMBOLS) if n > 1 else np.repeat(p, SYMBOLS)
            p = np.repeat(rest, SYMBOLS) * wide
            p[key] = prob
        out[i] = np.log(p)
    return out


def probabilities(grams: DataFrame, wanted: DataFrame, n: int = ORDER, seen: bool = True) -> DataFrame:
    """(lang, key, p) for distinct ``wanted`` (lang, key) of ``n`` units: unseen ones take their context's rest of the lower order.

    With ``seen`` false the model has none of ``wanted``.

    Each key looks up itself, its context and their lower order at once, and two orders below in a step of its own:
    no looked-up row has more than SYMBOLS ** 2 askers per language.
    """
    code = lambda k: F.col("key").cast("long").bitwiseAND((1 << BITS * k) - 1)
    orders, below = [k for k in (n - 1, n) if k > 0], max(0, n - 2)
    looked = orders if seen else orders[:-1]
    model = grams.where(F.col("n").isin(orders))
    rows = model.where(F.col("n").isin(looked)).select("lang", F.concat(F.lit("p"), "n").alias("what"), F.col("key").alias("code"), F.col("p").alias("value")).unionByName(
        model.select("lang", F.concat(F.lit("rest"), "n").alias("what"), F.shiftright("key", BITS).alias("code"), F.col("rest").alias("value")).distinct()
    )
    asked = [(f"p{k}", code(k)) for k in looked] + [(f"rest{k}", F.shiftright(code(k), BITS)) for k in orders]
    p = F.lit(1.0 / SYMBOLS)
    if below:
        lower = probabilities(grams, wanted.select("lang", code(below).alias("key")).distinct(), below)
        rows = rows.unionByName(lower.select("lang", F.lit("below").alias("what"), F.col("key").alias("code"), F.col("p").alias("value")))
        asked.append(("below", code(below)))
        p = F.col("below")
    asks = wanted.select("lang", "key", F.explode(F.array(*[F.struct(F.lit(what).alias("what"), at.alias("code")) for what, at in asked])).alias("ask"))
    found = asks.select("lang", "key", "ask.*").join(rows, ["lang", "what", "code"], "left")
    found = found.groupBy("lang", "key").agg(*[F.max(F.when(F.col("what") == what, F.col("value"))).alias(what) for what, _ in asked])
    for k in orders:
        p = F.coalesce(*[F.col(f"p{x}") for x in looked if x == k], F.coalesce(F.col(f"rest{k}"), F.lit(1.0)) * p)
    return found.select("lang", "key", p.alias("p"))


def _packed(block: int, lang: str, held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Part of a block as a row: the rows without their texts, and the texts' symbols."""
    rows = pa.Table.from_batches([b.append_column("units", pa.array(n)) for b, n, _ in held])
    out = io.BytesIO()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(rows)
    symbols = np.concatenate([s for _, _, s in held])
    return pa.RecordBatch.from_pydict(
        {"block": pa.array([block], pa.int64()), "lang": [lang], "held": pa.array([out.getvalue()], pa.binary()), "size": pa.array([len(symbols)], pa.int64()),
         "symbols": pa.array([pa.Codec("zstd", 9).compress(symbols.tobytes(), asbytes=True)], pa.binary())}
    )


def _unpacked(row: dict) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """(rows, their units, bounds of the rows' units)."""
    rows = pa.ipc.open_stream(row["held"]).read_all()
    bounds = np.concatenate(([0], np.cumsum(rows["units"].to_numpy())))
    return rows, np.frombuffer(pa.Codec("zstd").decompress(row["symbols"], row["size"], asbytes=True), np.uint8), bounds


def _blocks(model: Model, full: int, asking: int):
    """Rows (name, id, text) by the model that scores them, packed by about ``full`` bytes; rows of one block hold about ``asking``."""

    def run(batches):
        first, number = TaskContext.get().partitionId() << 32, 0
        waiting: dict[str, list] = {}
        size: dict[str, int] = {}
        block: dict[str, tuple[int, int]] = {}  # the block that a language fills, and its bytes

        def packed(lang: str) -> pa.RecordBatch:
            nonlocal number
            own, held = block.get(lang, (0, asking))
            if held >= asking:
                own, held, number = first + number, 0, number + 1
            block[lang] = own, held + size.pop(lang)
            return _packed(own, lang, waiting.pop(lang))

        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            languages = np.array([model.own(x) for x in batch.column("name").to_pylist()], object)
            for start, stop in chunks(bounds):
                at = bounds[start : stop + 1] - bounds[start]
                symbols = symbols_of(data[bounds[start] : bounds[stop]], at)
                for lang in sorted(set(languages[start:stop])):
                    mine = languages[start:stop] == lang
                    rows = batch.select(["name", "id"]).slice(start, stop - start).filter(pa.array(mine))
                    own = symbols[np.repeat(mine, np.diff(at))]
                    waiting.setdefault(lang, []).append((rows, np.diff(at)[mine], own))
                    size[lang] = size.get(lang, 0) + len(own)
                    while size and (max(size.values()) >= full or sum(size.values()) > HELD_BYTES):
                        yield packed(max(size, key=size.get))
        for lang in list(waiting):
            yield packed(lang)

    return run


def _asked(order: int):
    """(block, lang, key): the different n-grams of each block.

    A block whose rows stand far apart may ask twice for the same one.
    """

    def asks(block: int, lang: str, keys: np.ndarray):
        return pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(keys), block)), "lang": pa.array([lang] * len(keys), pa.string()), "key": pa.array(keys)})

    def run(batches):
        held: dict[tuple[int, str], np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                at = row["block"], row["lang"]
                seen = held.pop(at, None)
                if seen is None:
                    seen = np.zeros(0, np.int64)
                    if len(held) >= AT_ONCE:
                        oldest = next(iter(held))
                        yield asks(*oldest, held.pop(oldest))
                _, symbols, bounds = _unpacked(row)
                held[at] = np.unique(np.concatenate([seen, *(keys for _, _, keys, _ in _pieces(symbols, bounds, order))]))
        for at, seen in held.items():
            yield asks(*at, seen)

    return run


def _summed(model: Model, pooled: bool, batches):
    for batch in batches:
        answers = ["log_p", "log_q"] if pooled else ["log_p"]
        for i, row in enumerate(batch.drop_columns(["keys", *answers]).to_pylist()):
            rows, symbols, bounds = _unpacked(row)
            own = row["lang"]
            by = [own, *([model.pool(own)] if pooled and model.pool(own) != own else [])]
            total = np.zeros((len(by), len(rows)))
            if batch.column("keys")[i].is_valid:
                known = batch.column("keys")[i].values.to_numpy()
                ascending = np.argsort(known)
                known, log_p = known[ascending], [batch.column(x)[i].values.to_numpy()[ascending] for x in answers[: len(by)]]
                for first, end, keys, ids in _pieces(symbols, bounds, model.order):
                    at, cut = np.searchsorted(known, keys), np.clip(bounds, first, end) - first
                    for k, values in enumerate(log_p):
                        total[k] += np.diff(np.concatenate(([0.0], np.cumsum(values[at][ids], dtype=np.float64)))[cut])
            for name, sums_ in zip(by, total):
                out = rows.append_column("model", pa.array([name] * len(rows), pa.string())).append_column("total", pa.array(sums_))
                yield from out.select(["name", "id", "model", "total", "units"]).to_batches()


def sums(rows: DataFrame, model: Model, pooled: bool = False, then=None) -> DataFrame:
    """(name, id, model, total, units) for every row (name, id, text): the sum of log probabilities of the text's n-grams.

    ``name`` is the language; ``model`` is the one that scored the row. With ``pooled`` rows of languages with a model
    of their own are also scored by that of all. ``then`` (a function and schema as for mapInArrow) works on these rows in the
    tasks that sum them: a mapInArrow after them would take a Python worker more in each. Runs jobs when called.
    """
    kind = f"name string, id {rows.schema['id'].dataType.simpleString()}"
    if model.grams is None:
        unknown = rows.select("name", "id", F.lit(POOLED).alias("model"), F.lit(0.0).alias("total"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("units"))
        return unknown.mapInArrow(*then) if then else unknown
    only, order = replace(model, grams=None, mean={}, limit={}), model.order  # what the tasks need of it
    held = bucketed(rows.select("name", "id", "text").mapInArrow(_blocks(only, BLOCK_BYTES, ASK_BYTES), "block long, lang string, held binary, size long, symbols binary"), "texts", "block")
    blocks = materialise(held.select("block", "lang"), "blocks")
    asked = materialise(held.select("block", "lang", "size", "held", "symbols").mapInArrow(_asked(order), "block long, lang string, key long"), "asked")
    wanted = asked.select("lang", "key").distinct()
    if pooled:
        wanted = wanted.unionByName(wanted.select(model.pools("lang").alias("lang"), "key")).distinct()
    longest = model.grams.where(F.col("n") == order).select("lang", "key", "p")
    seen = materialise(wanted.join(longest, ["lang", "key"], "left"), "seen")
    known = seen.where("p is not null").unionByName(probabilities(model.grams, seen.where("p is null").select("lang", "key"), order, seen=False))
    known = known.select("lang", "key", F.log("p").cast("float").alias("log_p"))
    lists = ["log_p"]
    if pooled:
        other = known.select(F.col("lang").alias("pool"), "key", F.col("log_p").alias("log_q"))
        known = known.join(blocks.select("lang").distinct(), "lang", "left_semi").withColumn("pool", model.pools("lang")).join(other, ["pool", "key"]).drop("pool")
        lists.append("log_q")
    # the lists have the order in which their one aggregate meets the rows
    found = asked.join(known, ["lang", "key"]).groupBy("block").agg(*[F.collect_list(x).alias(x if x != "key" else "keys") for x in ("key", *lists)])
    # a block of empty texts alone asks for nothing; a block's answers go to each of its rows, which stay where they are
    answered = held.join(found.hint("shuffle_hash"), "block", "left").select("lang", "held", "size", "symbols", "keys", *lists)
    if then:
        work, result = then
        return answered.mapInArrow(lambda batches: work(_summed(only, pooled, batches)), result)
    return answered.mapInArrow(lambda batches: _summed(only, pooled, batches), f"{kind}, model string, total double, units long")


def _perplexity(model: Model, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(perplexity, limit) per row of ``sums``."""
    names = batch.column("name").to_pylist()
    total, units = batch.column("total").to_numpy(), batch.column("units").to_numpy()
    return np.exp(-(total + model.drawn_by * model.means(names)) / (units + model.drawn_by)), model.limits(names)


def trusted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(lang, text) of documents whose every label says good quality and not toxic; written once."""
    spark = docs.sparkSession
    good = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .where("quality = 1 and coalesce(toxic, 0) = 0")
        .select("doc_id")
    )
    bits = spark.sparkContext.broadcast(bloom.build(good))

    def thinned(batches):
        for b in batches:
            yield b.filter(pa.array(bloom.may_hold(bits.value, b.column(0).fill_null(-1).to_numpy(zero_copy_only=False))))

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    # what the filter lets pass wrongly is found by its ids alone, so that no text is shuffled
    wrong = materialise(ids.mapInArrow(thinned, "doc_id long").join(good, "doc_id", "left_anti"), "untrusted")
    passed = without(texts, "doc_id", wrong, (thinned, StructType.fromDDL("doc_id long, lang string, text string")))
    return materialise(passed.where("doc_id is not null and text <> ''").select("lang", "text"), "trusted")


def quantiles(bins: DataFrame, keys: list[str], wanted: dict[str, float]) -> DataFrame:
    """(keys, a column per wanted quantile) of values ``s`` that stand ``n`` times each."""
    running = bins.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys).orderBy("s"))).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    return running.groupBy(*keys).agg(*[F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("s"))).alias(name) for name, q in wanted.items()])


def train(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, slack: float = 0.5, least_documents: int = 20) -> Model:
    """The model of the trusted documents and the limits of each language, from texts that the models scoring them have not read.

    Without trusted documents the model is empty and rejects nothing. A null language is an empty one. A language
    with fewer than ``least_documents`` trusted documents, or none, is scored by the model of all languages; its
    mean and median come from all its own documents in ``docs``, its limit from the median and the spread of trusted ones.
    A language that ``docs`` does not hold has the mean and limit of all trusted documents.
    """
    spark = docs.sparkSession
    before = written()
    texts = trusted_texts(docs, labels)
    done = written() - before
    sizes = texts.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()
    if not sizes:
        return Model()
    own = [r["lang"] for r in sizes if r["n"] >= least_documents and r["lang"] != POOLED]
    languages = [*own, POOLED]
    before = written()
    part = lambda lang, text: F.concat(F.pmod(F.xxhash64(lang, text), F.lit(len(PARTS))).cast("string"), lang)
    parted = texts.select(part(F.col("lang"), F.col("text")).alias("name"), "text")
    counts = materialise(parted.mapInArrow(_counts(LONGEST), "lang string, key long, c long").groupBy("lang", "key").agg(F.sum("c").alias("c")), "grams")
    counts = counts.select(F.substring("lang", 1, 1).alias("part"), F.expr("substring(lang, 2)").alias("lang"), "key", "c")
    counts = counts.where(F.col("lang").isin(own)).unionByName(counts.withColumn("lang", F.lit(POOLED)))
    # each model counts what stands outside its part, that of all parts everything
    read = F.array(F.lit(ALL), *[F.when(F.col("part") != x, F.lit(x)) for x in PARTS])
    counts = counts.select(F.explode(read).alias("model"), "lang", "key", "c").where("model is not null")
    counts = materialise(counts.groupBy(F.concat("model", "lang").alias("lang"), "key").agg(F.sum("c").alias("c")), "counts")
    grams = kneser_ney(counts, LONGEST)
    done |= written() - before
    full = materialise(grams.where(F.substring("lang", 1, 1) == ALL).withColumn("lang", F.expr("substring(lang, 2)")), "model")
    model = Model({x: i for i, x in enumerate(languages)}, full, order=LONGEST)

    held_out = HeldOut({r["lang"]: i for i, r in enumerate(counts.select("lang").distinct().orderBy("lang").collect())}, grams, order=LONGEST)
    before = written()
    lang = F.expr("substring(name, 2)")
    scored = sums(parted.select("name", F.lit(0).alias("id"), "text"), held_out, pooled=True)
    scored = scored.select(F.when(F.expr("substring(model, 2)") == POOLED, F.lit(POOLED)).otherwise(lang).alias("lang"), "total", "units")
    few = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.col("text").cast("string").alias("text")).where(
        ~F.col("lang").isin(own) & (F.col("lang") != POOLED)
    )
    if not few.select("lang").isEmpty():
        few = few.where("text <> ''").select(part(F.col("lang"), F.col("text")).alias("name"), F.lit(0).alias("id"), "text")
        scored = scored.unionByName(sums(few, held_out).select(lang.alias("lang"), "total", "units"))
    done |= written() - before
    scored = materialise(scored, "scored")
    discard(spark, done)
    means = materialise(scored.groupBy("lang").agg((F.sum("total") / F.sum("units")).alias("mean")), "means")
    model.mean = {r["lang"]: r["mean"] for r in means.collect()}
    surprise = -(F.col("total") + model.drawn_by * F.col("mean")) / (F.col("units") + model.drawn_by)
    # quantiles from counts per thousandth: exact to that, and as many rows as there are values
    bins = materialise(scored.join(means, "lang").groupBy("lang", F.round(surprise, 3).alias("s")).agg(F.count("*").alias("n")), "surprises")
    at = quantiles(bins, ["lang"], {"low": 1 - quantile, "mid": 0.5, "high": quantile})
    apart = bins.where(F.col("lang").isin(own or [POOLED])).join(at, "lang").groupBy(F.round(F.col("s") - F.col("mid"), 3).alias("s")).agg(F.sum("n").alias("n"))
    spread = quantiles(apart, [], {"high": quantile}).first()["high"]
    trusted = {r["lang"]: r["n"] for r in sizes if r["lang"] in own} | {POOLED: sum(r["n"] for r in sizes)}
    for r in at.collect():
        n, wide = trusted.get(r["lang"], 0), max(spread, r["mid"] - r["low"])
        limit = (n * (r["high"] + slack * (r["high"] - r["mid"])) + PRIOR * (r["mid"] + (1 + slack) * wide)) / (n + PRIOR)
        # never below the mean, where empty texts are
        model.limit[r["lang"]] = math.exp(max(limit, -model.mean[r["lang"]]) + 0.001)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, keep) for every row; a null or empty text has its language's mean and is kept."""
    judged = replace(model, grams=None)

    def run(batches):
        for batch in batches:
            found, limits = _perplexity(judged, batch)
            doc = batch.column("id")
            yield pa.RecordBatch.from_arrays(
                [doc.field("doc_id"), doc.field("lang"), pa.array(found), pa.array(limits), pa.array(found <= limits)], ["doc_id", "lang", "perplexity", "threshold", "keep"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    lang = F.col("lang").cast("string")
    rows = docs.select(F.coalesce(lang, F.lit("")).alias("name"), F.struct("doc_id", lang.alias("lang")).alias("id"), F.col("text").cast("string").alias("text"))
    return sums(rows, model, then=(run, f"doc_id {kind}, lang string, perplexity double, threshold double, keep boolean"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with all their columns; repeated rows are judged alike.

    A rejected text is known by a 64-bit hash of its language and itself.
    """
    judged = replace(model, grams=None)

    def run(batches):
        for batch in batches:
            found, limits = _perplexity(judged, batch)
            yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(~(found <= limits)))], ["id"])

    lang, text = F.coalesce(F.col("lang").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.xxhash64(lang, text)
    rejected = materialise(sums(docs.select(lang.alias("name"), key.alias("id"), text.alias("text")), model, then=(run, "id long")).distinct(), "rejected")
    return without(docs.withColumn("_text_key", key), "_text_key", rejected).select(docs.columns)
