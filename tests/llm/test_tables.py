"""WARC packages, web pages, vectors and conversations."""

import io
import zipfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.llm import chat, html_text, vector_file, warc_zip
from tallyspan.llm.queries import ORACLES, QUERIES
from tallyspan.llm.registry import reachable

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(spark):
    return reachable(spark)


# --- 1


def reader(data):
    return lambda at, n: data[at : at + n]


@pytest.mark.parametrize("wide", [False, True])
def test_directory_finds_members(monkeypatch, wide):
    """With and without ZIP64 fields; a comment that looks like an end record."""
    if wide:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for k in range(3):
            with z.open(zipfile.ZipInfo(f"dir/é{k}"), "w", force_zip64=True) as f:
                f.write(b"x" * (100 + k))
        z.comment = b"PK\x05\x06 is no end"
    data = out.getvalue()
    found = warc_zip.directory(reader(data), len(data))
    assert [(m.name, m.stored_bytes) for m in found] == [(f"dir/é{k}", 100 + k) for k in range(3)]
    for m in found:
        at = warc_zip.data_start(reader(data), m)
        assert data[at : at + m.stored_bytes] == b"x" * m.stored_bytes
    with pytest.raises(ValueError):
        warc_zip.directory(reader(data[:-30]), len(data) - 30)
    with pytest.raises(ValueError):
        warc_zip.directory(reader(b""), 0)


def test_compressed_member_is_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 100)
    data = out.getvalue()
    with pytest.raises(ValueError):
        warc_zip.data_start(reader(data), warc_zip.directory(reader(data), len(data))[0])


def test_records_come_back_whole(spark):
    html = ["<p>a</p>", None, "", "\r\n\r\nWARC/1.1\r\n", "é😀" * 90_000, "<p>a</p>", "<p>a</p>"]
    pages = spark.createDataFrame([(i, f"http://h/{i}\r\nX: y", t, "x", 1) for i, t in enumerate(html)], "page_id long, url string, html string, digest string, type int")
    manifest = warc_zip.write_packages(pages)
    read = {r.record_id: r for r in warc_zip.read_packages(manifest).collect()}
    for i, t in enumerate(html):
        r = read[f"urn:page:{i}"]
        if i in (0, 1, 5):
            assert r.type == "revisit" and r.payload is None and r.refers_to == f"urn:page:{2 if i == 1 else 6}"
        else:
            assert r.type == "response" and bytes(r.payload) == (t or "").encode() and r.target_uri == f"http://h/{i} X: y"
    got = {r.page_id: r for r in warc_zip.page_records(manifest).collect()}
    assert got[0].payload_bytes == 8 and got[0].refers_to == 6 and got[1].payload_bytes == 0
    assert got[2].payload_digest == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_records_of_odd_ids(spark):
    pages = spark.createDataFrame([(None, None, "a"), (4, "u", "a"), (4, "u", "a"), (2, "u", "a"), (None, "u", "b"), (None, "u", "b")], "page_id long, url string, html string")
    got = sorted(((r.page_id or -1), r.record_type, r.refers_to or -1, r.payload_bytes) for r in warc_zip.page_records(warc_zip.write_packages(pages)).collect())
    assert got == [(-1, "response", -1, 1), (-1, "response", -1, 1), (-1, "revisit", 4, 1), (2, "revisit", 4, 1), (4, "response", -1, 1), (4, "response", -1, 1)]
    large = warc_zip.page_records(warc_zip.write_packages(pages, least_bytes=2)).collect()
    assert {r.record_type for r in large} == {"response"}
    assert warc_zip.page_records(warc_zip.write_packages(pages.limit(0))).count() == 0


# --- 9


def text_of(page):
    root = html_text.parse(page)
    html_text.mark(root)
    return "\n".join(t for t, _ in html_text.blocks(root))


@pytest.mark.parametrize(
    "page,want",
    [
        ("<nav>menu</nav><article><h1>T &amp; u</h1><p>a  b\n c<p>d<b>e</b>f<br>g</article><footer>x</footer>", "T & u\na b c\nde" + "f g"),
        ("<article><p>one<aside>no</aside><form>no<input></form><div class='reader-comments'>no</div><p>two</article>", "one\ntwo"),
        ("<article><p><b>bold<br><p>next</p></article>after", "bold\nnext"),
        ("<main><p>m</p></main><div>outside</div>", "m"),
        ("<body class='has-sidebar'><div id=x><p>plain</div><div role=navigation>menu</div></body>", "plain"),
        ("<script>var a='<p>no</p>';</script><style>p{}</style><p>yes<!-- no --><!-- <p>no", "yes"),
        ("<article><ul><li>1<li>2</ul><table><tr><td>a<td>b<tr><td>c</table></article>", "1\n2\na\nb\nc"),
        ("<article><p>cut off &amp", "cut off &"),
        ("<article><p>cut <b", "cut"),
        ("<article><p title='a>b' class=\"x\">5 < 6 && 7 > 3 &lt;p&gt; &#233;&nbsp;z</p></article>", "5 < 6 && 7 > 3 <p> é z"),
        ("<article><p>a<textarea>no</textarea><svg><text>no</text></svg><noscript>no</noscript>b</p></article>", "ab"),
        ("<article><p>a</p><div id='cookiebar'>no</div><div class='commentList2'>no</div><p class='lead ad-free'>no</p></article>", "a"),
        ("", ""),
        ("<<<>>>&&&", "<<<>>>&&&"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("</p></div>x</body>", "x"),
    ],
)
def test_article_text(page, want):
    assert text_of(page) == want


@pytest.mark.parametrize(
    "page,want",
    [
        ("<div class='content-sidebar-wrap'><main><p>a</p></main><div class='sidebar'>no</div></div>", "a"),
        ("<div class='has-sidebar'><article><p>a</p></article><div class='sidebar'>no</div></div>", "a"),
        ("<main><h1>t</h1><div class='has-sidebar'><article><p>a</p></article></div></main>", "t\na"),
        ("<div class='with-nav'><main><article><p>a</p></article></main></div><div class='related'><article>no</article></div>", "a"),
        ("<article><h2 id='related-work'>r</h2><section id='social-effects'><p>s</p></section><section class='comments'>no</section></article>", "r\ns"),
        ("<main><p>a</p><h2 id='notice'>n</h2><div id='share'>no</div></main>", "a\nn"),
    ],
)
def test_names_of_wrappers_and_titles_hide_no_article(page, want):
    assert text_of(page) == want


def page_table(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, host string, row int")


def test_templates_of_a_host_go(spark):
    """A box inside the article on many pages of one host goes; the same box on few pages stays, as do shared paragraphs."""
    box, shared = "<div><span>Read our other stories</span></div>", "<p>Licensed to all.</p>"
    rows = [("https://A.example/1", f"<article><p>story {k}</p>{box}{shared}</article>") for k in range(10)]
    rows += [("http://b.example:80/", f"<article><p>story {k}</p>{box}</article>") for k in range(3)]
    rows += [("http://c.example/", f"<article><div>copied</div>{box}</article>")] * 20
    rows += [(None, f"<article><p>no host {k}</p>{box}</article>") for k in range(12)]
    got = {r.page_id: r for r in html_text.extract(page_table(spark, rows)).collect()}
    assert got[4].text == "story 4\nLicensed to all." and got[4].url == "https://A.example/1" and got[4].n_chars == len(got[4].text)
    assert got[11].text == "story 1\nRead our other stories"
    assert got[20].text == "copied\nRead our other stories"
    assert got[40].text.endswith("stories") and len(got) == len(rows)


def test_templates_of_one_section_go_at_every_host_size(spark):
    """A box on ten pages of a section goes, whether the host has ten pages or four hundred."""
    box = "<div><span>More from this section</span></div>"
    rows = [(f"http://{h}/s/{k}", f"<article><p>story {k}</p>{box}</article>") for h in ("small", "large") for k in range(10)]
    rows += [(f"http://large/t/{k}", f"<article><p>other {k}</p></article>") for k in range(390)]
    got = {r.page_id: r.text for r in html_text.extract(page_table(spark, rows)).collect()}
    assert [got[k] for k in range(20)] == [f"story {k}" for k in range(10)] * 2 and len(got) == len(rows)


def test_pages_odd_input(spark):
    df = page_table(spark, [("http://a/", None), ("", ""), ("nonsense", "<p>x"), ("http://a/", "<p>x"), ("http://a/", "<p>x"), ("http://a/", "<p>" + "y " * 200_000)])
    got = sorted((r.page_id, r.text[:3], r.n_chars) for r in html_text.extract(df).collect())
    assert [g[1:] for g in got] == [("", 0), ("", 0), ("x", 1), ("x", 1), ("x", 1), ("y y", 399_999)]
    assert html_text.extract(df.limit(0)).count() == 0


def test_page_query_keeps_article_only(spark):
    got = {r.page_id: r for r in QUERIES["op9_html_text"](spark, SF).collect()}
    import html
    import re

    for p in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", p.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>?", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[p.page_id].text == "\n".join(b for b in blocks if b)


# --- 5


def plain_top(rows, k, scale=256):
    v = {}
    for i, e in rows:
        if i is not None and e and all(x is not None and np.isfinite(x) for x in e):
            v[i, tuple(int(np.floor(scale * float(x))) for x in e)] = i
    out = []
    for (q, a) in v:
        if q % 2 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for (i, b) in v if i != q and len(a) == len(b))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.2, 40.0])
def test_top_k_equals_all_pairs(spark, monkeypatch, spread):
    """Coarse cells, ties, equal vectors, other lengths, and rows that take no part."""
    monkeypatch.setattr(vector_file, "BLOCK", 16)
    monkeypatch.setattr(vector_file, "QUERY_BLOCK", 5)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(rng.normal(0, spread, 6))]) for i in range(80)]
    rows += [(100 + i, rows[3][1]) for i in range(30)] + [(200, [0.5, 0.25]), (202, [0.5, -0.25]), (204, [0.1])]
    rows += [(300, None), (302, [None, 1.0]), (304, [float("nan")] * 6), (306, [float("inf")] * 6), (308, []), (None, rows[0][1]), rows[2], rows[2]]
    df = spark.createDataFrame([(i, e, 1, "x") for i, e in rows], "vec_id long, embedding array<float>, label int, key string")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in vector_file.top_k(df, lambda i: i % 2 == 0).collect())
    assert got == plain_top(rows, 5)
    assert vector_file.top_k(df.limit(0), lambda i: i % 2 == 0).count() == 0


def test_product_is_exact_beyond_doubles():
    a = np.array([[2**40, 3]])
    assert vector_file.product(a, a)[0, 0] == 2**80 + 9
    assert vector_file.product(np.array([[3, -4]]), np.array([[5, 6]]))[0, 0] == -9


# --- 7


def turns_of(spark, talks):
    rows = [(c, k, r, t, 1, 2) for c, turns in talks for k, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position int, n_turns int")


def test_snapshots_collapse(spark):
    a, b, c, d = ("user", "hi"), ("bot", "yes"), ("user", "more"), ("bot", None)
    talks = [(1, [a, b, c]), (2, [a]), (3, [a, b]), (4, [a, b, c]), (5, [a, b, d]), (6, [a, b, ("bot", "")]), (7, [b, a]), (None, [c]), (8, [c, a]), (9, [("user", "hi!")])]
    got = {}
    for r in chat.render(turns_of(spark, talks)).orderBy("conv_id", "position").collect():
        got.setdefault(r.conv_id, []).append(r.rendered)
    assert set(got) == {1, 5, 6, 7, 8, 9}
    assert "".join(got[1]) == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>bot\nyes<|im_end|>\n<|im_start|>user\nmore<|im_end|>\n"
    assert got[5][2] == got[6][2] == "<|im_start|>bot\n<|im_end|>\n"


def test_chat_odd_input(spark):
    df = spark.createDataFrame(
        [(1, 2, "u", "b"), (1, 1, "u", "a"), (1, 1, "u", "a"), (2, None, None, "a"), (2, 5, "u", ""), (3, 1, "u", "x" * 50_000), (3, 1, "a", "y")],
        "conv_id long, turn long, role string, text string",
    )
    got = {}
    for r in chat.render(df).orderBy("conv_id", "position").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.n_turns, len(r.rendered)))
    assert [x[0] for x in got[3]] == ["a", "u"] and len(got[1]) == 2 and [x[0] for x in got[2]] == [None, "u"]
    assert chat.render(df.limit(0)).count() == 0


def test_one_long_conversation_spreads(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    talk = [("user", f"t{k}") for k in range(500)]
    out = chat.render(turns_of(spark, [(1, talk), (2, talk[:499]), (3, talk[:1]), (4, talk[1:])])).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r.conv_id for r in out} == {1, 4}
    assert [r.rendered[len("<|im_start|>user\n") : -len("<|im_end|>\n")] for r in sorted(out, key=lambda r: r.position) if r.conv_id == 1] == [t for _, t in talk]


def test_chat_plan_is_native(spark):
    plan = QUERIES["op7_chat"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- SQL


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "conversations", "benchmark", "labels"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    want = con.execute(ORACLES[key])
    names = [d[0] for d in want.description]
    rows = sorted(map(repr, want.fetchall()))
    got = QUERIES[key](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r) for r in got.select(*[F.col(n) for n in names]).collect()))) == rows
