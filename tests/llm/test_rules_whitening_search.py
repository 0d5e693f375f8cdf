"""Quality rules, whitening and lexical search: against brute force, and on nulls, empty and long texts, repeats, ties, empty tables and odd columns."""

import collections
import math
import random
import re

import numpy as np
import pytest

import oracle
from tallyspan.llm import lexical_search, quality_rules, whitening
from tallyspan.llm.queries import ORACLES, QUERIES
from tallyspan.llm.registry import reachable

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(spark):
    return reachable(spark)


@pytest.mark.parametrize("key", ["op12_quality_rules", "op13_lexical_search"])
def test_query_equals_sql(spark, key, monkeypatch):
    monkeypatch.setattr(oracle, "QUERIES", QUERIES)
    monkeypatch.setattr(oracle, "ORACLES", ORACLES)
    assert oracle.differences(spark, oracle.connect(SF), SF, key)[1] == []


# --- quality rules

DOCS = "doc_id long, text string, lang string, t string, words string, n int, measures int, `a.b` int, row int"
ODD = [
    None, "", " \t\n\x0b\x0c\r ", "one", "a b c d e a b c d e", "a b c d e f a b c d e", "x " * 50, "no line\nno line\n\n \nno line\nother",
    "é ü 日本 😀 and the of # $ %", " two words", "- item one\n* item two\n• three\nend ...\nbar |", "w" * 100_000, "word%d " * 3,
    " ".join(f"w{i % 977}" for i in range(30_000)), "same five words are here same five words are here five words are here same",
]


def plain_measures(text, lang):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = collections.defaultdict(list)
    for i in range(len(words) - 4):
        seen[tuple(words[i : i + 5])].append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    own = quality_rules.STOP_WORDS.get(lang) or {w for x in quality_rules.STOP_WORDS.values() for w in x}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_marked_lines": sum(bool(re.search(r"^[ \t]*[-*•]|(\.\.\.|…|\|)[ \t]*\Z", x)) for x in lines),
        "n_exclamations": text.count("!"),
        "n_stop_words": sum(w in own for w in re.split(r"[\x20\x09-\x0D.,;:!?\"'()#*$%&|<>]+", text.lower())),
        "n_repeat_words": len(covered),
    }


def rule_docs(spark, texts, langs):
    return spark.createDataFrame([(i, t, lang, "t", "w", 1, 2, 3, 4) for i, (t, lang) in enumerate(zip(texts, langs))], DOCS)


def test_measures_equal_plain_ones(spark):
    rng = random.Random(5)
    texts = ODD + [" ".join(rng.choice(["a", "b", "the", "x|", "\n", "y\n", "c!"]) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    langs = [[None, "en", "de", "xx", ""][i % 5] for i in range(len(texts))]
    got = {r.doc_id: r for r in quality_rules.judged(rule_docs(spark, texts, langs)).collect()}
    assert len(got) == len(texts)
    for i, (text, lang) in enumerate(zip(texts, langs)):
        want = plain_measures(text, lang)
        assert {m: got[i][m] for m in quality_rules.MEASURES} == want, (i, (text or "")[:60])
        assert got[i].base_failed == (want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"])
        assert got[i].kept == (not got[i].failed) and (not got[i].base_failed or not got[i].kept)


def test_rules_are_one_projection_without_python_or_shuffle(spark):
    plan = quality_rules.judged(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_keep_leaves_columns_and_repeats(spark):
    good = "the quick brown fox and a lazy dog are in the old house by the river with you"
    docs = rule_docs(spark, [good, good, "too short", None], ["en", "en", "en", None])
    docs = docs.unionByName(docs)
    out = quality_rules.keep(docs)
    assert out.schema == docs.schema and sorted(r.doc_id for r in out.collect()) == [0, 0, 1, 1]
    assert quality_rules.keep(docs, ()).count() == 8 and quality_rules.judged(docs.limit(0)).count() == 0


def test_table_of_rules(spark):
    docs = rule_docs(spark, ["a b c d # #", "a b c d e f"], ["en", "en"])
    table = (quality_rules.Rule("few symbols", "n_symbols", "n_words", most=20), quality_rules.Rule("six", "n_words", least=6, most=6), quality_rules.Rule("late", "n_lines", most=0, only_from=7))
    got = {r.doc_id: (r.failed, r.kept) for r in quality_rules.judged(docs, table).collect()}
    assert got == {0: (["few symbols"], False), 1: ([], True)}


def test_rules_part_labelled_documents(spark):
    """Held-out labels: nearly all junk goes; good text stays, but for what the base rules reject."""
    sf = "/root/testdata/sf0.01"
    rows = quality_rules.judged(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good) and sum(not r.kept for r in bad) >= 0.95 * len(bad)


# --- whitening

VECTORS = "vec_id long, embedding array<float>, label int, x int, number string, v string, n int, whitened int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "a", "b", 2, 3) for i, v in rows], VECTORS)


def plain_whitening(x, components):
    n = len(x)
    c = x - x.sum(axis=0) / n
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, x.shape[1])
    return c @ u[:, :k] / np.sqrt(e[:k]), e[:k] / np.trace(cov)


@pytest.mark.parametrize("blocks", [(4096, 1024), (7, 5)])
def test_whitening_equals_numpy(spark, monkeypatch, blocks):
    """Also with many small blocks, and in panels."""
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", blocks[0])
    monkeypatch.setattr(whitening, "COLUMNS_PER_BLOCK", blocks[1])
    if blocks[0] == 7:
        monkeypatch.setattr(whitening, "PANEL_ROWS", 60)
        monkeypatch.setattr(whitening, "BLOCKS_PER_TASK", 2)
    rng = np.random.default_rng(3)
    data = (rng.normal(size=(150, 12)) @ rng.normal(size=(12, 12)) * 3).astype(np.float32)
    x = np.floor(64 * data.astype(float)).astype(np.int64) + 1_000_000
    got = whitening.whiten(vectors(spark, list(enumerate(data.tolist()))), components=9).collect()
    want, explained = plain_whitening(x, 9)
    mine = np.array([r.whitened for r in sorted(got, key=lambda r: r.vec_id)])
    signs = np.sign((mine * want).sum(axis=0))
    assert np.abs(mine * signs - want).max() < 1e-8
    assert np.allclose(got[0].explained, explained, rtol=1e-10) and got[0].identity_error < 1e-9
    apart = 150 * x - x.sum(axis=0)
    assert {r.vec_id: r.deviation for r in got} == dict(enumerate((apart**2).sum(axis=1).tolist())) and {r.n for r in got} == {150}


def test_query_has_a_row_per_vector_and_component(spark):
    rows = QUERIES["op11_whitening"](spark, SF).collect()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    assert len(rows) == 32 * len(table) and {r.component for r in rows} == set(range(1, 33))
    assert [c for c in rows[0].asDict()] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-4
    w = np.zeros((len(table), 32))
    at = {r.vec_id: i for i, r in enumerate(table)}
    for r in rows:
        w[at[r.vec_id], r.component - 1] = r.whitened
    assert np.abs(w.T @ w / len(table) - np.eye(32)).max() < 1e-9


def test_whitening_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 2.0]), (7, [3.0, 1.0]), (7, [3.0, 1.0]), (8, [-2.0, 0.5]), (9, [1.0, 1.0, 1.0])]
    got = whitening.whiten(vectors(spark, odd), components=32).collect()
    assert sorted((r.vec_id or 0, r.n, len(r.whitened)) for r in got) == [(0, 4, 2), (7, 4, 2), (7, 4, 2), (8, 4, 2), (9, 1, 3)]
    alone = next(r for r in got if r.vec_id == 9)
    assert alone.whitened == [None] * 3 and alone.deviation == 0 and alone.explained == [None] * 3
    w = np.array([r.whitened for r in got if r.vec_id != 9])
    assert np.abs(w.T @ w / 4 - np.eye(2)).max() < 1e-9 and max(r.identity_error for r in got) < 1e-9
    assert whitening.components_of(whitening.whiten(vectors(spark, odd[:5]))).count() == 0
    assert whitening.whiten(vectors(spark, odd).limit(0)).count() == 0


def test_components_without_variance_are_null(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert all(r.whitened[0] is not None and r.whitened[1:] == [None, None] for r in got)
    assert got[0].explained[0] == pytest.approx(1.0)


# --- lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_search(docs, items, k):
    terms = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n_docs, n_terms = sum(map(bool, terms)), sum(map(len, terms))
    tfs = [collections.Counter(t) for t in terms]
    df = collections.Counter(x for tf in tfs for x in tf)
    out = []
    for item, text in set(items):
        scored = []
        for (doc, _), own, tf in zip(docs, terms, tfs):
            score = 0
            for x in TERM.findall((text or "").translate(LOWER)):
                if tf[x]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    score += w * (1_000_000_000 * tf[x] // (1000 * tf[x] + 12 * (100 - 25 + 25 * len(own) * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, -1 if doc is None else doc))
        out += [(item, rank, None if doc == -1 else doc, -score) for rank, (score, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k):
    docs = spark.createDataFrame([(*d, "en", 1, 2, 3, 4) for d in docs], "doc_id long, text string, lang string, block int, slot int, h int, score int")
    items = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, slot int, rank int")
    return sorted(map(tuple, lexical_search.search(docs, items, k).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def zipf(rng, n):
    return " ".join(f"w{min(int(rng.paretovariate(0.7)), 500)}" for _ in range(n))


@pytest.mark.parametrize("sizes", [None, (7, 40, 3, 1 << 16), (7, 40, 3, 5)])
def test_search_equals_brute_force(spark, monkeypatch, sizes):
    """Also with tiny blocks and bundles, and in rounds: many owners' stages carry accumulators."""
    if sizes:
        for name, value in zip(("BLOCK_DOCS", "BLOCK_ENTRIES", "BUNDLE", "ITEMS_AT_ONCE"), sizes):
            monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(11)
    docs = [(i, zipf(rng, rng.choice([0, 1, 5, 30, 80]))) for i in range(260)]
    docs += [(1000 + i, "w1 w2 w3 tie") for i in range(9)]
    items = [(i, zipf(rng, rng.choice([1, 3, 12, 40]))) for i in range(12)] + [(50, "w1"), (51, "w1 w2 tie tie TIE"), (52, "absent terms only")]
    assert found(spark, docs, items, 5) == plain_search(docs, items, 5)


def test_search_of_odd_rows(spark):
    docs = [
        (1, None), (2, ""), (3, " .,;\n"), (4, "Straße straße É é 日本"), (5, "the end"), (5, "the end"), (None, "the end"), (6, "the beginning of the end"), (7, "x" * 50_000), (8, "end " * 20_000),
    ]
    items = [(1, None), (2, ""), (3, "STRASSE straße é"), (4, "the END, the end."), (4, "the END, the end."), (4, "beginning"), (None, "end"), (9, "x" * 50_000)]
    assert found(spark, docs, items, 20) == plain_search(docs, items, 20)
    assert found(spark, docs, items, 2) == plain_search(docs, items, 2)
    empty = "item_id long, text string"
    some = spark.createDataFrame(docs, "doc_id long, text string")
    assert lexical_search.search(some, spark.createDataFrame([], empty)).count() == 0
    assert lexical_search.search(some.limit(0), spark.createDataFrame([(1, "the end")], empty)).count() == 0
