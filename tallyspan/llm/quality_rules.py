"""Quality rules: a table of thresholds compiled into one projection over measures of each text.

A rule bounds a measure, or its ratio to another one, in whole percent. ``RULES`` is the table of production;
``compiled`` turns any such table into Columns, so a verdict costs a few integer comparisons per row. All
measures are built-in functions over the whole text, without shuffles and without user functions: the rows of a
hot source or group of copies are judged where they are read.

Words are runs of non-space characters (space, and the characters from 9 to 13, separate them). Repeated runs of words
are found by hash first: a text whose 5-word windows all hash differently repeats none, and only the others have
their windows compared as texts. Comparing takes about 250 bytes of executor memory per word of the one text.

Null and empty texts have no words, are below the least length and are not kept. A null or unknown language has the
stop words of all. Repeated rows each have their row with the same verdict; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

WINDOW = 5

# What separates words, symbols that prose has few of, and what separates words when stop words are counted.
SPACES = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
MARKS = SPACES + ".,;:!?\"'()" + SYMBOLS

# Frequent function words by language.
STOP_WORDS = {
    "en": "a an and are as at be but by for from had has have he her his in is it not of on or she that the they this to was were which with you".split(),
    "de": "als auch auf aus bei das dem den der des die ein eine einen er es für hat ich im in ist mit nicht sich sie sind und von war wie zu zum".split(),
    "fr": "au aux avec ce ces dans de des du elle en est et eux il la le les leur mais ne nous on ou par pas pour que qui sa se son sur un une".split(),
    "es": "al como con de del el en es esta este fue ha la las lo los más me no o para pero por que se ser sin son su sus un una y".split(),
}


@dataclass(frozen=True)
class Rule:
    """``least`` <= ``of`` <= ``most``; with ``per``, both bounds are hundredths of that measure. Either bound may be missing.

    A rule with ``only_from`` is for texts of at least that many words: a ratio over a few words is no evidence.
    """

    name: str
    of: str
    per: str | None = None
    least: int | None = None
    most: int | None = None
    only_from: int = 0

    def passed(self, measures: str) -> Column:
        """Over a struct column of measures."""
        m = F.col(measures)
        value, unit = (m[self.of], F.lit(1)) if self.per is None else (m[self.of] * 100, m[self.per])
        bounds = [value >= unit * self.least] if self.least is not None else []
        bounds += [value <= unit * self.most] if self.most is not None else []
        fits = reduce(lambda a, b: a & b, bounds, F.lit(True))
        return fits | (m["n_words"] < self.only_from) if self.only_from else fits


BASE = (
    Rule("too few words", "n_words", least=10),
    Rule("repeated runs", "n_repeat_words", "n_words", most=20),
)
RULES = (
    *BASE,
    Rule("word length", "word_chars", "n_words", least=200, most=1500),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("repeated lines", "n_dup_lines", "n_lines", most=40, only_from=20),
    Rule("marks of lines", "n_marked_lines", "n_lines", most=30, only_from=20),
    Rule("exclamations", "n_exclamations", "n_words", most=20),
    Rule("stop words", "n_stop_words", "n_words", least=5, only_from=50),
)

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_marked_lines", "n_exclamations", "n_stop_words", "n_repeat_words",
)


def compiled(rules=RULES, measures: str = "measures") -> tuple[Column, Column]:
    """(names of the failed rules, in the order of the table; whether none failed) over a struct column of measures."""
    passed = [r.passed(measures) for r in rules]
    failed = F.array_compact(F.array(*[F.when(~p, F.lit(r.name)) for r, p in zip(rules, passed)], F.lit(None).cast("string")))
    return failed, reduce(lambda a, b: a & b, passed, F.lit(True))


def _stop_words(words: Column, lang: Column) -> Column:
    """How many words are among the stop words of the language."""
    every = sorted({w for own in STOP_WORDS.values() for w in own})
    count = lambda own: F.size(F.filter(words, lambda w: w.isin(own)))
    out = F
    for name, own in STOP_WORDS.items():
        out = out.when(lang == name, count(own))
    return out.otherwise(count(every))


def _windows(words: Column, n: Column, make) -> Column:
    """``make(position)`` for every window of five words."""
    return F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), make))


def measured(docs: DataFrame, name: str = "measures") -> DataFrame:
    """``docs`` (with ``text`` and ``lang``; any other columns) and a struct ``name`` of all ``MEASURES`` as longs.

    The chain of projections gives each value a name once, so that no array is computed twice; it runs as one stage.
    """
    c = F.col
    rows = docs.select(
        F.struct(*[c(f"`{x}`") for x in docs.columns]).alias("row"),
        F.coalesce(c("text").cast("string"), F.lit("")).alias("t"),
        c("lang").cast("string").alias("lang"),
    )
    rows = rows.withColumns(
        {
            "words": F.array_remove(F.split("t", f"[{SPACES}]+"), ""),
            "bare": F.split(F.lower("t"), f"[{MARKS}]+"),
            "lines": F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{SPACES}]")),
        }
    )
    rows = rows.withColumn("n", F.size("words"))
    # hashes of the windows: all different means that no window repeats
    rows = rows.withColumn("hashes", _windows(c("words"), c("n"), lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)])))
    rows = rows.withColumn("again", F.coalesce(F.size("hashes") > F.size(F.array_distinct("hashes")), F.lit(False)))
    text_of = lambda i: F.struct(F.array_join(F.slice("words", i + 1, WINDOW), " ").alias("k"), i.alias("at"))
    rows = rows.withColumn("sorted", F.when(c("again"), F.array_sort(_windows(c("words"), c("n"), text_of))))
    same = lambda x, j: F.coalesce(F.get("sorted", j)["k"] == x["k"], F.lit(False))
    found = F.filter("sorted", lambda x, j: same(x, j - 1) | same(x, j + 1))
    rows = rows.withColumn("starts", F.array_sort(F.transform(found, lambda x: x["at"])))
    covered = F.zip_with("starts", F.slice("starts", 2, F.size("starts")), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    repeated = F.coalesce(F.when(F.size("starts") > 0, F.aggregate(covered, F.lit(0), lambda s, x: s + x)), F.lit(0))
    out = {
        "n_words": c("n"),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.length("t") - F.length(F.regexp_replace("t", f"[{SYMBOLS}]+", "")),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_marked_lines": F.size(F.filter("lines", lambda x: x.rlike(r"^[\x20\t]*[-*•]|(\.\.\.|…|\|)[\x20\t]*$"))),
        "n_exclamations": F.length("t") - F.length(F.replace("t", F.lit("!"), F.lit(""))),
        "n_stop_words": _stop_words(c("bare"), c("lang")),
        "n_repeat_words": repeated,
    }
    return rows.select("row.*", F.struct(*[out[m].cast("long").alias(m) for m in MEASURES]).alias(name))


def judged(docs: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, the measures, base_failed, failed, kept) of every row."""
    failed, kept = compiled(rules)
    rows = measured(docs.select("doc_id", "text", "lang"))
    return rows.select("doc_id", "measures.*", (~compiled(BASE)[1]).alias("base_failed"), failed.alias("failed"), kept.alias("kept"))


def keep(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of ``docs`` that no rule fails, with all their columns."""
    name = "measures"
    while name in docs.columns:
        name += "_"
    return measured(docs, name).where(compiled(rules, name)[1]).select(*[F.col(f"`{x}`") for x in docs.columns])
