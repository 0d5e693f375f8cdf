"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from tallyspan.llm import bpe, chat, decontaminate, html_text, lexical_search, pii, quality, quality_rules, token_counts, vector_file, warc_zip, whitening
from tallyspan.llm.jaccard_join import jaccard_groups
from tallyspan.llm.registry import ORACLES, QUERIES, query  # noqa: F401  (re-exported)
from tallyspan.tables import table

JACCARD_SQL = r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, string_split(trim(regexp_replace(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS w
      FROM documents),
    shingles AS (
      SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) >= 4
                 THEN list_transform(range(1, len(w) - 2), lambda i: list_aggregate(w[i : i + 3], 'string_agg', ' '))
                 WHEN w = [''] THEN [] ELSE [list_aggregate(w, 'string_agg', ' ')] END) AS s
        FROM words)),
    sizes AS (SELECT d.doc_id, count(s)::BIGINT AS n_shingles FROM documents d LEFT JOIN shingles USING (doc_id) GROUP BY 1),
    links AS (
      SELECT a.doc_id AS a, b.doc_id AS b
      FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
      JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, x.n_shingles, y.n_shingles
      HAVING 100 * count(*) >= 85 * (x.n_shingles + y.n_shingles - count(*))),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
    SELECT s.doc_id, s.n_shingles, min(r.b)::BIGINT AS component_id
    FROM sizes s JOIN reach r ON r.a = s.doc_id GROUP BY 1, 2
"""


@query("op10_jaccard_join", JACCARD_SQL)
def op10(spark, sf_dir):
    return jaccard_groups(table(spark, sf_dir, "documents"))


@query("op8_byte_bpe")
def op8(spark, sf_dir):
    return byte_bpe(table(spark, sf_dir, "documents"))


def byte_bpe(docs):
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(bpe.encode(docs, vocabulary), vocabulary))


@query("op9_html_text")
def op9(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op3_personal_data")
def op3(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query("op6_quality")
def op6(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return quality.score(documents, quality.train(documents, table(spark, sf_dir, "labels")))


@query("op2_decontaminate")
def op2(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


WARC_SQL = """
    WITH d AS (
      SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
    b AS (
      SELECT page_id, payload_bytes,
             list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (('0x' || substr(h, (5 * (i // 4) + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) % 32 + 1, 1)), 'string_agg', '')
               AS payload_digest
      FROM d),
    m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM b)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> last THEN last END AS refers_to
    FROM m
"""


@query("op1_warc", WARC_SQL)
def op1(spark, sf_dir):
    return warc_zip.page_records(warc_zip.write_packages(table(spark, sf_dir, "pages")))


@query("op4_token_counts")
def op4(spark, sf_dir):
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary, token_counts.lines(F.col("text")))


TOP_K_SQL = """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query("op5_vector_file", TOP_K_SQL)
def op5(spark, sf_dir):
    return vector_file.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


CHAT_SQL = """
    WITH o AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS position,
             count(*) OVER (PARTITION BY conv_id) AS n_turns
      FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
    c AS (SELECT conv_id, count(*) AS n, list(struct_pack(r := role, t := text) ORDER BY position) AS turns FROM o GROUP BY conv_id),
    kept AS (
      SELECT a.conv_id FROM c a WHERE NOT EXISTS (
        SELECT 1 FROM c b WHERE (b.n > a.n AND b.turns[1 : a.n] = a.turns) OR (b.n = a.n AND b.turns = a.turns AND b.conv_id < a.conv_id)))
    SELECT o.conv_id, o.position::BIGINT AS position, o.n_turns::BIGINT AS n_turns, o.role,
           '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS rendered
    FROM o SEMI JOIN kept ON kept.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query("op7_chat", CHAT_SQL)
def op7(spark, sf_dir):
    return chat.render(table(spark, sf_dir, "conversations"))


def _in(words):
    return "(" + ", ".join("'" + w + "'" for w in words) + ")"


def _stop_words_sql():
    own = quality_rules.STOP_WORDS
    count = "len(list_filter(bare, lambda x: x IN {}))".format
    cases = " ".join(f"WHEN '{name}' THEN {count(_in(words))}" for name, words in own.items())
    return f"CASE lang {cases} ELSE {count(_in(sorted({w for words in own.values() for w in words})))} END"


QUALITY_RULES_SQL = rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
    w AS (
      SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             string_split_regex(lower(t), '[\x20\x09-\x0D.,;:!?"''()#*$%&|<>]+') AS bare,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
      FROM d),
    windows AS (
      SELECT rid, i, list_aggregate(w[i : i + 4], 'string_agg', ' ') AS k FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
    again AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
    covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, unnest(range(0, 5)) AS k FROM again) GROUP BY rid),
    m AS (
      SELECT doc_id, len(w)::BIGINT AS n_words, length(list_aggregate(list_concat(w, ['']), 'string_agg', ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\t]*[-*•]|(\.\.\.|…|\|)[\x20\t]*$')))::BIGINT AS n_marked_lines,
             length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_exclamations, ({_stop_words_sql()})::BIGINT AS n_stop_words,
             coalesce(n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN covered USING (rid)),
    b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
    SELECT *, NOT base_failed AND 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words AND 100 * n_symbols <= 10 * n_words
           AND (n_words < 20 OR (100 * n_dup_lines <= 40 * n_lines AND 100 * n_marked_lines <= 30 * n_lines))
           AND 100 * n_exclamations <= 20 * n_words AND (n_words < 50 OR 100 * n_stop_words >= 5 * n_words) AS kept
    FROM b
"""


@query("op12_quality_rules", QUALITY_RULES_SQL)
def op12(spark, sf_dir):
    return quality_rules.judged(table(spark, sf_dir, "documents")).drop("failed")


@query("op11_whitening")
def op11(spark, sf_dir):
    return whitening.components_of(whitening.whiten(table(spark, sf_dir, "embeddings"), components=32))


SEARCH_SQL = r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
    i AS (SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
    g AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
    q AS (SELECT item_id, t, count(*)::BIGINT AS q FROM (SELECT item_id, unnest(w) AS t FROM i) GROUP BY ALL),
    p AS (SELECT rid, doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT rid, doc_id, len(w) AS n, unnest(w) AS t FROM d) SEMI JOIN q USING (t) GROUP BY ALL),
    f AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, g GROUP BY t, n_docs),
    c AS (SELECT rid, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS part FROM p JOIN f USING (t), g),
    s AS (SELECT item_id, rid, doc_id, sum(q * part)::BIGINT AS score FROM q JOIN c USING (t) GROUP BY ALL HAVING sum(q * part) > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 20
"""


@query("op13_lexical_search", SEARCH_SQL)
def op13(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
