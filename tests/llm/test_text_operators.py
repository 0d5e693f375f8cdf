"""Operators over texts: against brute force, and on nulls, empty and long texts, repeats, empty tables and odd columns."""

import base64
import collections
import hashlib
import math
import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyspan.llm import bloom, bpe, decontaminate, html_text, jaccard_join, pii, quality, rows, token_counts, words
from tallyspan.llm.queries import QUERIES
from tallyspan.llm.registry import reachable

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, h long, fp long, key long, n long, root long, row long, base string"


@pytest.fixture(scope="session")
def spark(spark):
    return reachable(spark)


def docs_of(spark, texts, first=0, langs=None):
    """Documents with columns whose names the operators use inside."""
    data = [(first + i, t, (langs or ["en"] * len(texts))[i], 1, 2, 3, 4, 5, 6, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(data, DOCS)


ODD = ["", None, "one", "Two words", " \t\n ", "x" * 70_000, "word " * 30_000, "same text of five words here", "same text of five words here", "é ü 😀 日本 words"]


# --- words, filters, rows


def test_word_hashes_do_not_depend_on_neighbours():
    import pyarrow as pa

    texts = ["a b c", None, "", "b", " C  a\tB ", "ab c"]
    found = dict(words.rows_of_words(pa.array(texts), words.SPACED))
    a, b, c = found[0]
    assert list(found[3]) == [b] and list(found[4]) == [c, a, b] and len(found[1]) == len(found[2]) == 0
    assert found[5][0] not in (a, b, c) and found[5][1] == c
    sliced = dict(words.rows_of_words(pa.array(texts).slice(3, 2), words.SPACED))
    assert list(sliced[1]) == [c, a, b]


def test_bloom_holds_all_its_keys(spark):
    keys = [-5, 0, 7, 2**62, -(2**63), None]
    bits = bloom.build(spark.createDataFrame([(k,) for k in keys], "k long"))
    assert bloom.may_hold(bits, np.array(keys[:-1], np.int64)).all()
    assert bloom.may_hold(bits, np.arange(100, 1100)).sum() == 0
    assert not bloom.may_hold(bloom.build(spark.createDataFrame([], "k long")), np.arange(10)).any()


def test_rows_are_taken_by_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k long, v string")
    keys = spark.createDataFrame([(2,), (None,), (9,)], "k long")
    assert sorted(r.v for r in rows.only(df, "k", keys).collect()) == ["b", "c"]
    assert sorted(r.v for r in rows.without(df, "k", keys).collect()) == ["a", "d"]


def python_steps(df):
    """The most Python steps that one task of ``df`` runs one after the other."""
    most = run = 0
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        run = 0 if "Exchange" in line or "Scan" in line else run + ("MapInArrow" in line)
        most = max(most, run)
    return most


def test_a_task_keeps_one_python_worker(spark):
    """Each step of a chain would hold a worker of its own, and an executor keeps them all."""
    grams = quality.kneser_ney(spark.createDataFrame([(x, k, 2) for x in ("en", "*") for k in range(40)], "lang string, key long, c long"))
    docs = docs_of(spark, ["a b c d e f", "", None, "an item of eight words is found here"])
    assert python_steps(quality.score(docs, quality.Model({"en": 0, "*": 1}, grams))) == 1
    found = decontaminate.leaks(docs, spark.createDataFrame([(1, "an item of eight words is found here")], "item_id long, text string"))
    clean = decontaminate.without_leaks(docs, found)
    assert python_steps(clean) == 1
    assert python_steps(corpus_pipeline.byte_level_bpe(spark, docs, SF)) == 1
    assert clean.schema == docs.schema and sorted(r.doc_id for r in clean.collect()) == [0, 1, 2]
    assert sorted(r.doc_id for r in decontaminate.without_leaks(docs, found.limit(0)).collect()) == [0, 1, 2, 3]


def test_encoding_and_decoding_at_once_is_both_in_turn(spark):
    docs = docs_of(spark, ODD)
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    apart, at_once = bpe.decode(bpe.encode(docs, vocabulary), vocabulary), bpe.encode_and_decode(docs, vocabulary)
    assert at_once.schema == apart.schema and sorted(map(tuple, at_once.collect())) == sorted(map(tuple, apart.collect()))


def test_rows_are_made_where_they_are_parted(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k long, v string")
    schema = spark.createDataFrame([], "v string, twice long").schema

    def doubled(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([None if k is None else 2 * k for k in b.column(0).to_pylist()], pa.int64())], ["v", "twice"])

    for keys, left in (([4, None, 9], ["a", "d"]), ([], ["a", "b", "c", "d"])):
        got = rows.without(df, "twice", spark.createDataFrame([(k,) for k in keys], "k long"), (doubled, schema))
        assert got.columns == ["v", "twice"] and sorted(r.v for r in got.collect()) == left


def test_batches_of_packed_rows_are_bounded(spark):
    """A thousand rows of a megabyte each would be held by the JVM and by the worker at once."""

    def counted(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": pa.array([b.num_rows], pa.int64())})

    packed = spark.range(0, 12, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).cast("binary").alias("held"))
    found = [r.rows for r in packed.mapInArrow(counted, "rows long").collect()]
    assert sum(found) == 12 and max(found) <= 5


# --- 10


def test_entries_are_dealt_out_before_they_are_many():
    """A task holds a bounded number of inverted-list entries, however many a batch of texts makes, and loses none."""

    class Frequent:
        value = np.empty(0, np.uint64)

    texts = pa.array([" ".join(f"w{i}x{k}" for k in range(700)) for i in range(1000)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), texts], ["doc_id", "text"])
    out = [len(b.column(1)[0].as_py()) // jaccard_join.ENTRY.itemsize for b in jaccard_join._invert(5, 80, 1, Frequent, 1)([batch])]
    counted = sum(int(((found & np.uint64(7)) < jaccard_join.SAMPLED).sum()) for _, found in jaccard_join._sets(texts, 5))
    assert sum(out) >= counted and max(out) <= jaccard_join.PACKED_ENTRIES + 700


def shingle_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def plain_groups(texts, n, percent):
    sets = [shingle_set(t, n) for t in texts]
    least = list(range(len(sets)))
    changed = True
    links = [
        (i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    while changed:
        changed = False
        for i, j in links:
            m = min(least[i], least[j])
            changed |= least[i] != m or least[j] != m
            least[i] = least[j] = m
    return [(len(s), c) for s, c in zip(sets, least)]


def edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        at = rng.integers(len(out))
        out[at] = f"w{rng.integers(40)}"
    return " ".join(out)


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_jaccard_equals_all_pairs(spark, n, percent):
    """Sizes on both sides of the light boundary, a large group of near copies, and a passage in every text."""
    rng = np.random.default_rng(3)
    texts = list(ODD)
    for size in (3, 6, 9, 12, 15, 17, 20, 28, 60, 150):
        base = [f"w{k}" for k in rng.integers(0, 400, size)]
        texts += [edited(rng, base, e) for e in (0, 0, 1, 1, 2, 3, 5)]
    base = [f"v{k}" for k in range(90)]
    texts += [edited(rng, base, int(rng.integers(0, 5))) for _ in range(90)]
    passage = " ".join(f"p{k}" for k in range(50))
    texts += [" ".join(f"u{k}" for k in rng.integers(0, 10_000, 40)) + " " + passage for _ in range(40)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(docs_of(spark, texts), n, percent).collect()}
    assert [got[i] for i in range(len(texts))] == plain_groups(texts, n, percent)


def test_jaccard_blocks_of_a_long_list(spark, monkeypatch):
    for name, value in (("BLOCK", 8), ("HEADS", 2), ("SPREAD", 8), ("BLOCK_BYTES", 9000)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = np.random.default_rng(5)
    base = [f"v{k}" for k in range(80)]
    texts = [edited(rng, base, int(rng.integers(0, 4))) for _ in range(60)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_groups(texts, 4, 85)


def test_edges_of_near_copies_grow_with_their_number(spark):
    """Lists of near copies of different distance: rows that link them, and the groups they make."""

    def edges(m):
        rng = np.random.default_rng(m)
        base = rng.integers(1, 1 << 62, 100).astype(np.uint64)
        sets = []
        for _ in range(m):
            own = base.copy()
            at = rng.choice(100, int(rng.integers(0, 12)), replace=False)
            own[at] = rng.integers(1, 1 << 62, len(at)).astype(np.uint64)
            sets.append(np.unique(own))
        units = spark.createDataFrame([(7, i) for i in range(m)], "centre long, fp long")
        rows = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(sets)], "fp long, elements binary")
        found = [(r.a, r.b) for r in jaccard_join.list_edges(units, rows, 85).collect()]
        label = list(range(m))
        linked = list(range(m))

        def top(up, x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in found:
            label[max(top(label, a), top(label, b))] = min(top(label, a), top(label, b))
        for i in range(m):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                    linked[max(top(linked, i), top(linked, j))] = min(top(linked, i), top(linked, j))
        assert [top(label, i) for i in range(m)] == [top(linked, i) for i in range(m)]
        return len(found)

    few, many = edges(150), edges(600)
    assert many <= 6 * few and many <= 3 * 600


def test_jaccard_odd_ids(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(7, text), (None, text), (3, text), (3, text), (None, "z z z z z"), (5, "")], "doc_id long, text string")
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_groups(df).collect())
    assert got == {(7, 5, 3): 1, (None, 5, 3): 1, (3, 5, 3): 2, (None, 1 + 0, None): 1, (5, 0, 5): 1} or got[(None, 1, None)] == 1
    assert jaccard_join.jaccard_groups(df.limit(0)).count() == 0
    kept = jaccard_join.keep_one(df, 4, 85)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == sorted([(3, text), (-1, text), (-1, "z z z z z"), (5, "")])


def test_light_boundary_weighs_subsets_against_lists():
    assert jaccard_join.light_boundary({}, 85) == 0
    assert 6 <= jaccard_join.light_boundary({s: 100 for s in range(1, 49)}, 85) <= 14
    assert jaccard_join.subset_rows(14, 85) == 91 + 14 + 1


# --- 8 and 4


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    ranks = {b: i for i, b in enumerate(vocabulary.tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


STRANGE = [*ODD, "\x1c\x1d\x85b\xa0c", "'s'T'll don't", " " * 3000 + "x", "!?" * 5000, "Ⅷ ½ ١٢٣", "<|endoftext|>", "a\r\n\r\n b"]


def test_bpe_equals_the_library(spark, vocabulary, library):
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(docs_of(spark, STRANGE), vocabulary), vocabulary).collect()}
    for i, t in enumerate(STRANGE):
        assert np.frombuffer(got[i].ids, "<u4").tolist() == library.encode_ordinary(t or "")
        assert bytes(got[i].decoded) == (t or "").encode()
    assert bpe.encode(docs_of(spark, []), vocabulary).count() == 0


def test_bpe_query_over_all_documents(spark, library):
    got = {r.doc_id: r for r in QUERIES["op8_byte_bpe"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d.text)
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


def test_perfect_hash_has_a_slot_for_each_key():
    hashes = words.mix(np.arange(1, 5001).astype(np.uint64))
    shift, key_at = bpe.perfect_hash(hashes)
    assert sorted(key_at) == list(range(5000))
    slots = bpe._slots(hashes, shift[(hashes % np.uint64(len(shift))).astype(np.int64)], 5000)
    assert (key_at[slots] == np.arange(5000)).all()


def test_vocabulary_file_is_checked(tmp_path):
    bad = tmp_path / "v"
    bad.write_bytes(b"".join(base64.b64encode(bytes([k])) + b" %d\n" % (k + 1) for k in range(4)))
    with pytest.raises(ValueError):
        bpe.read_vocabulary(str(bad), "x")


def plain_sections(vocabulary, library, text, lengths, rule):
    place = [i for i, ch in enumerate(text) for _ in ch.encode()]
    borders = np.concatenate(([0], np.minimum(np.cumsum(lengths), len(text)), [len(text)]))
    out, at = [0.0] * (len(lengths) + 1), 0
    for token in library.encode_ordinary(text):
        size = len(vocabulary.tokens[token])
        a, b = place[at], place[at + size - 1] + 1
        at += size
        held = [max(0, min(b, borders[k + 1]) - max(a, borders[k])) for k in range(len(out))]
        touched = [k for k, x in enumerate(held) if x]
        if rule == "share":
            for k in touched:
                out[k] += held[k] / (b - a)
        else:
            out[{"first": touched[0], "last": touched[-1], "largest": held.index(max(held))}[rule]] += 1
    return out


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_share_all_tokens(spark, vocabulary, library, rule):
    """Borders inside words, characters and white space, past the text, and a rest."""
    texts = ["hello world again", "日本語 text 😀!", "a\n\n\nb  \n c", "", None, "x" * 400]
    lengths = [3, 0, 4, 2, 5]
    got = collections.defaultdict(dict)
    df = docs_of(spark, texts)
    for r in token_counts.count_tokens(df, vocabulary, F.array(*[F.lit(x) for x in lengths]), rule).collect():
        got[r.doc_id][r.section] = (r.n_chars, r.n_tokens)
    for i, t in enumerate(texts):
        want = plain_sections(vocabulary, library, t or "", lengths, rule)
        assert [got[i][k][1] for k in range(5)] == pytest.approx(want[:5])
        assert got[i].get(None, (0, 0.0))[1] == pytest.approx(want[5])
        assert sum(c for c, _ in got[i].values()) == len(t or "")


def test_null_text_has_a_row_as_an_empty_one(spark, vocabulary):
    docs = docs_of(spark, [None, "", "a\nb"])
    got = sorted(tuple(r) for r in token_counts.count_tokens(docs, vocabulary, token_counts.lines(F.col("text"))).collect())
    assert got[:2] == [(0, 0, 0, 0.0), (1, 0, 0, 0.0)] and [r[:3] for r in got[2:]] == [(2, 0, 2), (2, 1, 1)]


def test_token_query_adds_up(spark):
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {r.doc_id: len(r.ids) // 4 for r in bpe.encode(docs, vocabulary).collect()}
    got = QUERIES["op4_token_counts"](spark, SF).groupBy("doc_id").agg(F.sum("n_tokens").alias("t"), F.sum("n_chars").alias("c")).collect()
    chars = {r.doc_id: len(r.text) for r in docs.collect()}
    assert {r.doc_id: int(r.t) for r in got} == whole and {r.doc_id: r.c for r in got} == chars
    text, lengths = token_counts.joined_fields(["lang", "text"])
    row = docs_of(spark, ["two words"]).select(text.alias("t"), lengths.alias("l")).first()
    assert row.t == "en\ntwo words" and list(row.l) == [3, 10]


# --- 3

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            if kind == "card":
                twice = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(d - 9 if d > 9 else d for d in twice) % 10:
                    continue
            out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x for *_, x in sorted(out)]


PRIVATE = [
    "1.2.3.4.5.6.7.8 a@b.c_d@e.f x@y@z.com, +1 (017) 555-7713-- 4111 1111 1111 1111 4111-1111-1111-1111",
    "12 " * 3000, "1" * 30_000, "é 😀 4111111111111111 256.1.1.1 001.002.003.004 999999999999999999.1.1.1", "a.b@c-d.e-f.g@h.i",
    "+1 2\n3 4567890123", "+1" + "(" * 3000 + "2", "٣٤٥ ４１１１ 1.1.1.1١", *ODD,
]


def test_base_spans_equal_plain_search(spark):
    got = {r.doc_id: r for r in pii.personal_data(docs_of(spark, PRIVATE)).collect()}
    for i, t in enumerate(PRIVATE):
        want = plain_base(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t[:50]
        kinds = collections.Counter(x.split(":")[0] for x in want)
        assert [got[i][f"n_{k}"] for k in BASE] == [kinds[k] for k in BASE]
        assert got[i].spans == ",".join(want)


def test_patterns_discover_unseen_identifiers(spark):
    """Cards that fail Luhn and obfuscated addresses in contexts that known ones induce; other numbers stay."""
    good = ["4111111111111111", "5500005555555559", "340000000000009", "6011000990139424", "4012888888881881", "4222222222222220", "30569309025904", "3530111333300000"]
    texts = [f"order {k}: please charge card {g} today" for k, g in enumerate(good)]
    texts += ["order 77: please charge card 4111111111111112 today", "order 78: in the year 19841984 we met"]
    got = {r.doc_id: r for r in pii.personal_data(docs_of(spark, texts)).collect()}
    at = texts[8].index("4111111111111112")
    assert got[8].spans == f"card:{at}:{at + 16}" and got[8].n_card == 0 and got[8].n_added == 1
    assert got[9].spans == "" and all(got[k].n_added == 0 for k in range(8))
    masked = {r.doc_id: r.text for r in pii.mask(docs_of(spark, texts)).collect()}
    assert masked[8] == "order 77: please charge card <CARD> today" and masked[9] == texts[9]


def test_few_known_values_discover_many_in_long_chains(spark):
    """Four known phones discover thirty unseen ones, in groups too; chains go on past three rounds; dates and other kinds are evidence against."""
    texts = [f"x{k} please ring +1 555 010 20{k:02} today" for k in range(4)]
    texts += [f"y{k} please ring (017) 555-77{k:02} today" for k in range(30)]
    names = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    chain = [(a, f"(0{n}{k}) 555-88{n}{k}") for n, a in enumerate(names) for k in range(4)]
    texts += [f"please ring {v} today" for a, v in chain if a == "alpha"]
    for n, a in enumerate(names):
        texts += [f"{a} {a} {v} {a}" for x, v in chain if x == a or (n and x == names[n - 1])]
    dated = [f"z{k} seen around +1 555 030 40{k:02} here" for k in range(4)] + [f"z{k} seen around 2024-05-1{k} here" for k in range(4)]
    dated += ["z9 seen around 555 123 4567 here"]
    got = [r.spans for r in pii.personal_data(docs_of(spark, [*texts, *dated])).orderBy("doc_id").collect()]
    for t, spans in zip(texts, got):
        number = re.search(r"[+(][0-9() -]+[0-9]", t)
        assert spans == f"phone:{number.start()}:{number.end()}", t
    assert got[len(texts) + 4 :] == [""] * 5


def test_mask_keeps_rows_and_columns(spark):
    df = docs_of(spark, [*PRIVATE, "x a@b.co y 1.2.3.4.", "x a@b.co y 1.2.3.4."])
    out = pii.mask(df)
    assert out.schema == df.schema
    got = sorted((r.doc_id, r.text) for r in out.collect() if r.text is not None)
    assert len(got) == df.where("text is not null").count()
    assert got[-1][1] == got[-2][1] == "x <EMAIL> y <IP>."
    assert pii.mask(df.limit(0)).count() == pii.personal_data(df.limit(0)).count() == 0


def test_personal_data_plan_is_native(spark):
    plan = QUERIES["op3_personal_data"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_personal_data_query(spark):
    got = {r.doc_id: r for r in QUERIES["op3_personal_data"](spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        want = plain_base(d.text)
        assert got[d.doc_id].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) - {""} <= set(got[d.doc_id].spans.split(","))


# --- 2


def plain_align(item, passage):
    best, table = 0, np.zeros((len(item) + 1, len(passage) + 1), int)
    for i, a in enumerate(item):
        for j, b in enumerate(passage):
            table[i + 1][j + 1] = max(0, table[i][j] + (1 if a == b else -1), table[i][j + 1] - 1, table[i + 1][j] - 1)
    return int(table.max(initial=best))


def test_alignment_equals_the_full_table():
    rng = np.random.default_rng(1)
    for _ in range(200):
        item, passage = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 30))
        score, start, end = decontaminate.align(item, passage)
        assert score == plain_align(item, passage)
        if score:
            assert 0 <= start < end <= len(passage) and plain_align(item, passage[start:end]) == score
    assert decontaminate.align(np.array([1, 2, 3]), np.array([9, 1, 2, 3, 9])) == (3, 1, 4)


def test_leaks_find_copies_and_edits_and_nothing_else(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{k}" for k in range(500)]
    item = [" ".join(rng.choice(vocabulary, 30)) for _ in range(6)]
    fill = lambda: " ".join(rng.choice(vocabulary, 200))
    changed = item[1].split()
    changed[10], changed[20] = "new", "words"
    texts = [
        fill() + " " + item[0].upper().replace(" ", ", ") + " " + fill(), fill() + " " + " ".join(changed) + " " + fill(),
        fill() + " " + " ".join(x for k, x in enumerate(item[2].split()) if k not in (9, 19)) + " " + fill(),
        fill(), item[3], item[3], " ".join(item[4].split()[:9]) + " " + fill(), *ODD,
    ]
    tests = spark.createDataFrame([(i, t, 1) for i, t in enumerate(item)] + [(90, None, 1), (91, "", 1), (92, "a b", 1), (5, item[5], 1)], "item_id long, text string, h long")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs_of(spark, texts), tests).collect()}
    assert set(got) == {(0, 0), (1, 1), (2, 2), (4, 3), (5, 3)}
    assert got[0, 0].score == 1.0 and (got[0, 0].start_word, got[0, 0].end_word) == (200, 230)
    assert got[1, 1].score == pytest.approx(26 / 30)
    assert decontaminate.leaks(docs_of(spark, []), tests).count() == decontaminate.leaks(docs_of(spark, texts), tests.limit(0)).count() == 0


@pytest.mark.parametrize("beside", [False, True])
def test_leaks_of_dense_edits_equal_full_alignment(spark, beside):
    """An edit every 2nd to 6th word, exact copies beside them or not; broken pairs that others hold or nobody does."""
    rng = np.random.default_rng(4)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [rng.choice(vocabulary, size).tolist() for size in (4, 9, 20, 31)]
    texts = []
    for item in items:
        fill = lambda: rng.choice(vocabulary, 25).tolist()
        for every in (2, 3, 4, 5, 6):
            hit = lambda k, e=every: k % e == e - 1
            texts.append(fill() + ["new" if hit(k) else x for k, x in enumerate(item)] + fill())
            texts.append(fill() + [x for k, x in enumerate(item) if not hit(k)] + fill())
            texts.append(fill() + [y for k, x in enumerate(item) for y in ([x, "new"] if hit(k) else [x])] + fill())
        if beside:
            texts += [fill() + item + fill()] * 2
    tests = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(docs_of(spark, [" ".join(x) for x in texts]), tests).collect()}
    full = {(d, i): plain_align(x, t) / len(x) for d, t in enumerate(texts) for i, x in enumerate(items)}
    assert got == pytest.approx({k: v for k, v in full.items() if v >= 0.5})
    assert len(got) > 30


def test_leak_query_equals_plain_search(spark):
    got = {(r.doc_id, r.item_id) for r in QUERIES["op2_decontaminate"](spark, SF).collect()}
    w = lambda t: re.findall(r"\w+", t.lower())
    joined = {r.doc_id: " " + " ".join(w(r.text)) + " " for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    exact = {(d, b.item_id) for b in spark.read.parquet(f"{SF}/benchmark.parquet").collect() for d, t in joined.items() if " " + " ".join(w(b.text)) + " " in t}
    assert exact <= got and exact


# --- 6


def plain_kneser_ney(counts, order, symbols, bits):
    """Probabilities by the textbook formulas over dictionaries."""
    tables = {order: dict(counts)}
    for n in range(order - 1, 0, -1):
        tables[n] = collections.Counter(k & ((1 << bits * n) - 1) for k in tables[n + 1])
    discount = {}
    for n, t in tables.items():
        c = collections.Counter(t.values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else None
        discount[n] = [min(max(0.05, k - (k + 1) * y * c[k + 1] / c[k]), k) if c[k] and c[1] else 0.5 * k for k in (1, 2, 3)]

    def p(key, n):
        if n == 0:
            return 1 / symbols
        t, d, h = tables[n], discount[n], key >> bits
        same = {k: v for k, v in t.items() if k >> bits == h}
        if not same:
            return p(key & ((1 << bits * (n - 1)) - 1), n - 1)
        cut = lambda v: min(d[min(v, 3) - 1], v)
        total = sum(same.values())
        own = (t[key] - cut(t[key])) / total if key in t else 0.0
        return own + sum(map(cut, same.values())) / total * p(key & ((1 << bits * (n - 1)) - 1), n - 1)

    return p


def test_kneser_ney_equals_the_formulas(spark):
    text = b"the cat sat on the mat. the dog sat on the cat, and the mat!\nanother line of words 12"
    keys = quality.gram_keys(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    counts = collections.Counter(keys.tolist())
    rows_ = spark.createDataFrame([("en", k, c) for k, c in counts.items()], "lang string, key long, c long")
    table = quality.dense(quality.kneser_ney(rows_), ["en"])[0]
    p = plain_kneser_ney(counts, quality.ORDER, quality.SYMBOLS, quality.BITS)
    rng = np.random.default_rng(0)
    for key in [*list(counts)[:40], *rng.integers(0, 1 << 20, 40).tolist()]:
        assert np.exp(table[key]) == pytest.approx(p(int(key), quality.ORDER), rel=1e-4)
    assert np.exp(table.astype(np.float64)).reshape(-1, quality.SYMBOLS).sum(axis=1) == pytest.approx(1.0, abs=1e-4)


def test_pre_tokens_in_use_are_merged_once(monkeypatch):
    """What a worker has resolved stays while it is met again, however many other pre-tokens pass; ids are tiktoken's."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    vocabulary = bpe.read_vocabulary(path, public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("t", pat_str=vocabulary.pattern, mergeable_ranks={t: r for r, t in enumerate(vocabulary.tokens)}, special_tokens={})
    merged, merge = collections.Counter(), bpe.merge
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    monkeypatch.setattr(bpe, "merge", lambda piece, ranks: (merged.update([piece]), merge(piece, ranks))[1])
    encoder = bpe.Encoder(vocabulary)
    letters = np.random.default_rng(4).permutation(list("abcdefghijklmnopqrstuvwxyzäöß") * 400)
    for i in range(0, len(letters), 60):
        text = "qzqxkvbw " + " ".join("".join(letters[k : k + 6]) for k in range(i, i + 60, 6))
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == theirs.encode(text, disallowed_special=())
        assert len(encoder.known) <= 40 and len(encoder.earlier) <= 40
    assert merged[b"qzqxkvbw"] == 1


def test_texts_are_scored_by_a_join_with_the_model(spark, monkeypatch):
    """The model never comes to the driver; sums are those of the plain formula, in blocks of any size, for unseen n-grams too."""
    monkeypatch.setattr(quality, "dense", None)
    text = b"the cat sat on the mat, the dog sat on the log. 12 cats, 3 dogs!"
    counts = collections.Counter(quality.gram_keys(np.frombuffer(text, np.uint8), np.array([0, len(text)])).tolist())
    grams = quality.kneser_ney(spark.createDataFrame([(x, k, c) for x in ("en", "*") for k, c in counts.items()], "lang string, key long, c long"))
    p = plain_kneser_ney(counts, quality.ORDER, quality.SYMBOLS, quality.BITS)
    keys = [*list(counts)[:30], *np.random.default_rng(1).integers(0, 1 << 20, 60).tolist()]
    wanted = spark.createDataFrame([("en", int(k)) for k in set(keys)], "lang string, key int")
    found = quality.probabilities(grams, wanted).collect()
    assert len(found) == len(set(keys)) and all(r.p == pytest.approx(p(r.key, quality.ORDER), rel=1e-9) for r in found)
    texts = ["the cat", None, "", "zq~ 9 the mat", "the cat", "é the log the log"] * 3
    model = quality.Model({"en": 0, "*": 1}, grams, {"en": -2.0, "*": -2.5}, {"en": 12.0, "*": 20.0}, 50.0)
    for size in (quality.BLOCK_BYTES, 20):
        monkeypatch.setattr(quality, "BLOCK_BYTES", size)
        got = {r.doc_id: r for r in quality.score(docs_of(spark, texts, langs=["en", "xx", None] * 6), model).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            raw = np.frombuffer((t or "").encode(), np.uint8)
            total = sum(math.log(p(int(k), quality.ORDER)) for k in quality.gram_keys(raw, np.array([0, len(raw)])))
            mean, limit = (-2.0, 12.0) if i % 3 == 0 else (-2.5, 20.0)
            want = math.exp(-(total + 50.0 * mean) / (len(raw) + 50.0))
            assert got[i].perplexity == pytest.approx(want, rel=1e-5) and got[i].threshold == limit and got[i].keep == (want <= limit)


def test_gram_keys_end_at_their_text():
    data = np.frombuffer(b"abcab", np.uint8)
    apart = [quality.gram_keys(data[:3], np.array([0, 3])), quality.gram_keys(data[3:], np.array([0, 2]))]
    assert (quality.gram_keys(data, np.array([0, 3, 3, 5])) == np.concatenate(apart)).all()


def test_quality_on_held_out_labels(spark):
    """Trained on the labels of even documents, judged on those of odd ones."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    n = {(r.quality, r.keep): r["count"] for r in quality.score(docs, model).join(labels.where("doc_id % 2 = 1 and toxic = 0"), "doc_id").groupBy("quality", "keep").count().collect()}
    kept, lost = n.get((1, True), 0), n.get((1, False), 0)
    assert kept >= 0.97 * (kept + lost)
    assert n.get((0, False), 0) >= 0.6 * (n.get((0, False), 0) + n.get((0, True), 0))


def test_quality_odd_input(spark):
    docs = docs_of(spark, [*ODD, *ODD], langs=[None, "xx"] * len(ODD))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(docs, none)
    assert [r.keep for r in quality.score(docs, model).collect()] == [True] * docs.count()
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (6, 1, None), (7, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    assert list(model.languages) == ["*"]
    out = quality.keep_good(docs, model)
    assert out.schema == docs.schema and {r.doc_id for r in out.collect()} >= {0, 1, 6, 7}
    assert quality.score(docs.limit(0), model).count() == 0


def test_every_language_has_limits_of_its_own(spark):
    """Eighteen languages with models, and a nineteenth in letters of its own with too few trusted documents for one."""
    rng = np.random.default_rng(5)
    text = lambda letters: " ".join("".join(rng.choice(list(letters), 5)) for _ in range(120))
    rows_ = [(100 * k + i, text("abcde"), f"l{k}") for k in range(17) for i in range(24)]
    rows_ += [(9000 + i, text("uvwxy"), "rare") for i in range(22)] + [(9500 + i, text("mnopq"), "small") for i in range(12)]
    rows_ += [(9900, text("abcde"), "rare")]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    trusted = [(d, 1, 0) for d, _, _ in rows_ if d < 9503]
    model = quality.train(docs, spark.createDataFrame(trusted, "doc_id long, quality int, toxic int"))
    assert set(model.languages) == {*(f"l{k}" for k in range(17)), "rare", "*"} and {"small", "rare"} <= set(model.limit)
    got = quality.score(docs, model).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _, _ in rows_)
    assert {r.doc_id for r in got if not r.keep} == {9900}
    assert sorted(r.doc_id for r in quality.keep_good(docs, model).collect()) == sorted(d for d, _, _ in rows_ if d != 9900)


def test_words_said_again():
    """The separators after words that equal the word before in the same text, whatever stands between the two."""
    texts = ["the The  the. the.\nthe", "", " a a", "a b a", "Osó Osó osó Oso x", "ab ab", "\n"]
    raw = [t.encode() for t in texts]
    bounds = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    want = []
    for text, begin in zip(raw, bounds):
        found = [(m.group(), m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
        want += [begin + b[2] for a, b in zip(found, found[1:]) if a[0].lower() == b[0].lower() and b[2] < len(text)]
    assert quality.said_again(np.frombuffer(b"".join(raw), np.uint8), bounds).tolist() == want
    assert len(quality.said_again(np.zeros(0, np.uint8), np.array([0, 0]))) == 0


def test_section_ends_and_crossing_tokens():
    """One search over the texts of a chunk gives what each text alone gives, token by token."""
    rng = np.random.default_rng(3)
    for rule in token_counts.RULES:
        totals = rng.integers(0, 30, 40)
        lengths = [None if k % 9 == 4 else [None if x == 5 else int(x) for x in rng.integers(0, 9, rng.integers(0, 6))] for k in range(40)]
        until = np.cumsum(totals)
        number, ends = token_counts.section_ends(pa.array(lengths, pa.list_(pa.int32())), until)
        cuts = [np.unique(np.concatenate(([0, n], rng.integers(0, n + 1, n // 3)))) for n in totals]
        starts = np.concatenate([c[:-1] + u - n for c, u, n in zip(cuts, until, totals)])
        stops = np.concatenate([c[1:] + u - n for c, u, n in zip(cuts, until, totals)])
        got = token_counts.allocate(starts, stops, ends, rule)[:-1]
        want = []
        for own, n, c in zip(lengths, totals, cuts):
            borders = [0]
            for x in own or []:
                borders.append(min(borders[-1] + (x or 0), n))
            borders.append(n)
            tokens = [0.0] * (len(borders) - 1)
            for a, b in zip(c[:-1], c[1:]):
                held = [max(0, min(b, y) - max(a, x)) for x, y in zip(borders, borders[1:])]
                holders = [i for i, h in enumerate(held) if h]
                for i, h in enumerate(held):
                    tokens[i] += {"first": i == holders[0], "last": i == holders[-1], "largest": i == held.index(max(held)), "share": h / (b - a)}[rule]
            want += tokens
            assert (number[len(want) - len(tokens) : len(want)] == [*range(len(tokens) - 1), -1]).all()
        assert got == pytest.approx(want)


@pytest.mark.parametrize(
    "inner",
    ['<div style="overflow:hidden">T</div>', '<p aria-hidden="false">T</p>', '<p title="a hidden gem">T</p>', '<div data-role="form">T</div>',
     '<p id="social-effects">T</p>', '<p>a <span class="comment">T</span></p>', "<p title='x class=\"ad\" y'>T</p>", '<li class="respond">T</li>'],
)
def test_attributes_that_hide_nothing(spark, inner):
    pages = spark.createDataFrame([(1, "http://a/x", f"<nav>menu</nav><article><p>Begin</p>{inner}</article>")], "page_id long, url string, html string")
    assert html_text.extract(pages).first().text.replace("a T", "T") == "Begin\nT"


@pytest.mark.parametrize("inner", ["<div hidden>T</div>", '<div CLASS = "x ad">T</div>', "<div role=navigation>T</div>", '<div a=b id="sidebar">T</div>'])
def test_attributes_that_hide(spark, inner):
    pages = spark.createDataFrame([(1, "http://a/x", f"<article><p>Begin</p>{inner}</article>")], "page_id long, url string, html string")
    assert html_text.extract(pages).first().text == "Begin"


def test_large_blocks_ask_once_for_their_ngrams(spark, monkeypatch):
    """Rows of one block share its questions and answers: texts of a language are not asked for by the megabyte."""
    asked, real = [], quality.materialise
    monkeypatch.setattr(quality, "materialise", lambda df, name: asked.append((name, real(df, name))) or asked[-1][1])
    texts = ["the cat sat on the mat and saw another cat " * 100, "a dog ran after it " * 200, ""]
    docs = spark.createDataFrame([(i, texts[i % 3], "en", "s", 0) for i in range(600)], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    asked.clear()
    rows = quality.score(docs, model).collect()
    found = dict(asked)
    assert found["blocks"].count() >= 2 and found["blocks"].select("block").distinct().count() == 1
    assert found["asked"].count() == found["asked"].distinct().count() > 0
    assert len(rows) == 600 and len({(r.doc_id % 3, r.perplexity) for r in rows}) == 3
    for r in rows[:3]:
        alone = quality.score(docs.where(f"doc_id = {r.doc_id}"), model).first()
        assert abs(alone.perplexity - r.perplexity) < 1e-9


def script_docs(spark, seed=11):
    """Good texts of thirty invented Cyrillic words, junk of the same letters, and a good text in capitals."""
    rng = np.random.default_rng(seed)
    letters = [chr(c) for c in range(0x430, 0x450)]
    vocabulary = ["".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(30)]
    good = lambda: " ".join(rng.choice(vocabulary, 80))
    junk = lambda: " ".join("".join(rng.permutation(list(w))) for w in good().split())
    data = [(i, good(), "ru") for i in range(60)] + [(100 + i, junk(), "ru") for i in range(10)] + [(200, good().upper(), "ru")]
    docs = spark.createDataFrame([(*r, "s", len(r[1])) for r in data], "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")


def test_letters_of_any_script_are_told_apart(spark):
    """Junk has as many letters, spaces and words as good text, in another order; all perplexities are those of the plain formula."""
    docs, labels = script_docs(spark)
    model = quality.train(docs, labels)
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert {i for i, r in got.items() if r.keep} == set(range(60))
    texts = {r.doc_id: np.frombuffer(r.text.encode(), np.uint8) for r in docs.collect()}
    keys = {i: quality.gram_keys(t, np.array([0, len(t)]), quality.LONGEST).tolist() for i, t in texts.items()}
    p = plain_kneser_ney(collections.Counter(k for i in range(40) for k in keys[i]), quality.LONGEST, quality.SYMBOLS, quality.BITS)
    known = {}
    for i in (0, 45, 100, 200):
        total = sum(known[k] if k in known else known.setdefault(k, math.log(p(k, quality.LONGEST))) for k in keys[i])
        want = math.exp(-(total + model.drawn_by * model.mean["ru"]) / (len(texts[i]) + model.drawn_by))
        assert got[i].perplexity == pytest.approx(want, rel=1e-5)


def test_keys_are_the_bytes_of_runs():
    """No two bytes are one unit, whether the runs are numbered by tables or sorted, in texts of any length."""
    rng = np.random.default_rng(2)
    texts = [b"", "Añ b 日本\n9".encode(), b"", bytes(range(32, 127)), rng.integers(32, 127, quality.CHUNK_BYTES + 9).astype(np.uint8).tobytes(), b"x"]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    want = []
    for t in texts:
        t = b"\n" * 4 + t
        again = {m.end(1) for m in re.finditer(rb"(?:^|(?<=[\x20\x09-\x0D]))([^\x20\x09-\x0D]+)(?=[\x20\x09-\x0D])", t) if m.group(1).lower() == (t[: m.start()].split() or [b""])[-1].lower()} if len(t) < 99 else set()
        own = np.frombuffer(t, np.uint8).copy()
        if len(t) >= 99:
            own[4 + quality.said_again(own[4:], np.array([0, len(own) - 4]))] = 255
        own[list(again)] = 255
        want += [int.from_bytes(own[i - 4 : i + 1].tobytes(), "big") for i in range(4, len(own))]
    assert quality.gram_keys(data, bounds, 5).tolist() == want


def test_counts_grow_with_the_texts(monkeypatch):
    """Every run of every text is counted, more of them than any table of classes has cells, also where a task holds few at once."""
    rng = np.random.default_rng(8)
    texts = [rng.integers(33, 127, n).astype(np.uint8).tobytes().decode() for n in (1_200_000, 0, 5, 300, 300, 7_000)] + [None]
    batch = pa.RecordBatch.from_pydict({"lang": pa.array(["a", "a", "b", "b", "a", "c", "b"]), "text": pa.array(texts, pa.string())})
    want = collections.Counter()
    for lang, text in zip(batch["lang"].to_pylist(), texts):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        want.update((lang, k) for k in quality.gram_keys(raw, np.array([0, len(raw)]), 5).tolist())
    assert len(want) > 1 << 20 and sum(want.values()) == sum(len(t or "") for t in texts)
    for held in (quality.HELD_GRAMS, 1000):
        monkeypatch.setattr(quality, "HELD_GRAMS", held)
        got = collections.Counter()
        for b in quality._counts(5)(iter([batch.slice(0, 3), batch.slice(3)])):
            for lang, key, c in zip(*(b[k].to_pylist() for k in ("lang", "key", "c"))):
                got[lang, key] += c
        assert got == want
