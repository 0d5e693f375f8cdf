import pytest
from pyspark.sql import functions as F

from tallyspan.sources import ingest as i

c = F.col


def lines(spark, *texts):
    return spark.createDataFrame([(x,) for x in texts], "value string")


def test_delimited(spark):
    df = i.delimited(lines(spark, "a\tb\tc", "a\t\t", "x"), "value", width=3)
    assert df.columns == ["column_1", "column_2", "column_3"]
    assert [tuple(r) for r in df.collect()] == [("a", "b", "c"), ("a", None, None), ("x", None, None)]
    many = i.delimited(lines(spark, "1|a;b;", "2|"), "value", ["k", "v"], delimiter="|", lists=["v"], list_delimiter=";").collect()
    assert many[0]["v"] == ["a", "b", None] and many[1]["v"] == [None]
    with pytest.raises(ValueError):
        i.delimited(lines(spark, "a"), "value", ["k", "K"])


def test_header_skip_over_many_blocks(spark, tmp_path):
    # several files of several blocks each, all read with the same two skipped rows and header
    for f in range(3):
        body = "".join(f"{f}\t{n}\n" for n in range(3000))
        (tmp_path / f"f{f}.tsv").write_text("# one\n# two\nfile\tno\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    try:
        df = i.read_delimited_files(spark, str(tmp_path), skip=2)
        assert df.columns == ["file", "no"]
        got = {(r["file"], r["no"]) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {(str(f), str(n)) for f in range(3) for n in range(3000)}
    (tmp_path / "other.tsv").write_text("# one\n# two\nother\theader\n")
    with pytest.raises(ValueError):
        i.read_delimited_files(spark, str(tmp_path), skip=2)


def test_json_discovery(spark):
    df = lines(
        spark,
        '{"a": 1, "b": "x", "n": null, "o": {"p": 1}, "l": [1, "y"], "d": [[1]], "mix": 1}',
        '{"a": 2.5, "b": "z", "q": true, "mix": "s", "late": 7}',
        '{"l": [1, {"deep": 2}], "d": [[2]]}',
        "not json",
    )
    assert i.discover_json_fields(df, "value") == {"a": "double", "b": "string", "l": "array<string>", "late": "bigint", "mix": "string", "q": "string"}
    rows = i.json_rows(df, "value").collect()
    assert rows[0]["l"] == ["1", "y"] and rows[0]["mix"] == "1" and rows[1]["late"] == 7 and rows[2]["l"] is None and rows[3]["a"] is None


def test_flatten(values):
    v = F.lit('{"a": {"b": [10, 20], "k.x": 5}, "r": "t", "l": [{"u": 3}]}')
    got = values(
        [
            i.flatten_root(v, "r"), i.flatten_path(v, "$.a.b[1]", "bigint"), i.flatten_jq(v, ".a.b[]", "bigint"), i.flatten_jq(v, ".l[0].u", "bigint"),
            i.flatten_path(v, "$.no"), i.flatten_root(F.lit("broken"), "r"),
        ]
    )[0]
    assert got == ("t", 20, 10, 3, None, None)
    with pytest.raises(ValueError):
        i.flatten_jq(v, ".a | length")


def test_regex_needs_the_whole_line(spark):
    df = i.regex_rows(lines(spark, "k=1,a;b", "k=1,a;b,x y"), "value", r"k=(\d+),([^,]*)", ["k", "v"], lists=["v"], list_delimiter=";").collect()
    assert df[0]["k"] == "1" and df[0]["v"] == ["a", "b"] and df[0][i.REASON] is None
    assert df[1]["k"] is None and df[1][i.REASON] == "no match"


def test_rejects(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    good, bad = i.split_rejects(df, {"null": c("v").isNull(), "two": c("v") == 2})
    assert [r["v"] for r in good.collect()] == [1]
    assert {r[i.REASON] for r in bad.collect()} == {"null", "two"}
    good, _ = i.split_rejects(df, {"two": c("v") == 2}, strict=True)
    with pytest.raises(Exception, match="row rejected: two"):
        good.collect()


def test_charsets(spark):
    df = spark.createDataFrame([(b"a\xc3\xa9\xff",), (None,)], "b binary")
    assert [r[0] for r in df.select(i.decode_text(c("b"))).collect()] == ["aé�", None]
    assert df.select(i.decode_text(c("b"), "ISO-8859-1")).first()[0] == "aÃ©ÿ"
    assert df.select(i.decode_text(c("b"), "US-ASCII")).first()[0] == "a���"


def test_numbers_in_text(values):
    rows = [("+1,234",), ("-7",), ("1.5",), (" 8 ",), (None,), ("x",), ("+x",), ("9223372036854775807",), ("9223372036854775808",), ("-9223372036854775808.00",), ("1e3",), ("2.50",)]
    got = values([i.text_to_number(c("v")), i.text_to_long(c("v")), i.exact_long(c("v"))], rows, "v string")
    assert [g[0] for g in got[:7]] == [1234.0, -7.0, 1.5, 8.0, 0.0, None, None]
    assert [g[1] for g in got[:7]] == [1234, -7, None, 8, 0, None, None]
    assert [g[2] for g in got] == [None, -7, None, None, None, None, None, 2**63 - 1, None, -(2**63), 1000, None]
