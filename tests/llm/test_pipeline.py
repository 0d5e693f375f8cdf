"""The pipeline: each stage against a plain version of its decision, on its own input."""

import re

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from tallyspan.llm import pii, quality
from tallyspan.llm.registry import reachable

from test_text_operators import plain_base, plain_groups, script_docs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    docs, out = reachable(spark).read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        rows = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        out.append((rows, docs.collect()))
    return out


def test_stages_keep_columns(stages):
    for _, after in stages[:-1]:
        assert list(after[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [len(a) for a, _ in stages[1:]] == [len(b) for _, b in stages[:-1]]


def test_quality_stage_keeps_good_documents(spark, stages):
    before, after = stages[0]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {r.doc_id for r in before if r.doc_id in labels and labels[r.doc_id].quality == 1 and labels[r.doc_id].toxic == 0}
    kept = {r.doc_id for r in after}
    assert len(good & kept) >= 0.95 * len(good)
    bad = {i for i, r in labels.items() if r.quality == 0}
    assert len(bad - kept) >= 0.5 * len(bad)


def test_one_of_each_group_stays(stages):
    before, after = stages[1]
    before = sorted(before, key=lambda r: r.doc_id)
    groups = plain_groups([r.text for r in before], 5, 80)
    assert {r.doc_id for r in after} == {r.doc_id for i, (r, (n, c)) in enumerate(zip(before, groups)) if n == 0 or c == i}


def test_leaking_documents_go(spark, stages):
    before, after = stages[2]
    words = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaking = {r.doc_id for r in before if any(i in words(r.text) for i in items)}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - leaking


def test_leaking_texts_go_whatever_their_ids(spark):
    """A null doc_id hides no leak, and a clean document that shares a leaking one's doc_id stays."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(None, f"so {item} it is", "en", "s", 1), (7, item, "en", "s", 1), (7, "a clean text of its own", "en", "s", 1), (None, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = cp.benchmark_decontamination(spark, docs, SF)
    assert got.schema == docs.schema and {(r.doc_id, r.text) for r in got.collect()} == {(7, "a clean text of its own"), (None, None)}


def test_personal_data_is_masked(stages):
    before, after = stages[3]
    texts = {r.doc_id: r for r in after}
    assert len(texts) == len(before)
    for r in before:
        got = texts[r.doc_id]
        assert got.n_chars == len(got.text) and not plain_base(got.text)
        if not plain_base(r.text):
            assert got.text == r.text


def test_last_stage_and_run(spark, stages):
    before, after = stages[4]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == sorted(map(tuple, after))


def test_stages_take_odd_documents(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, "a b c d e f", "en", "s", 11), (3, "a b c d e f", "en", "s", 11), (3, "a b c d e f", "en", "s", 11), (4, "mail x@y.zz now", "fr", "s", 14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for sample in (docs, docs.limit(0)):
        for _, stage in cp.STAGES:
            assert stage(spark, sample, SF).count() <= sample.count()
    masked = {r.doc_id: r for r in cp.personal_data(spark, docs, SF).collect()}
    assert masked[4].text == "mail <EMAIL> now" and masked[1].text is None
    kept = cp.near_duplicates(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 2, 3, 4]
    assert quality and pii and F


def test_quality_stage_tells_scripts_apart(spark, tmp_path):
    """Junk made of the good documents' own letters, none of them ASCII, goes; good documents without a label stay."""
    docs, labels = script_docs(spark)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert {r.doc_id for r in cp.quality_classifier(spark, docs, str(tmp_path)).collect()} == set(range(60))
