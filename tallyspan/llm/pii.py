"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base patterns find e-mail addresses, IP addresses, card numbers and phone numbers. They are the seeds: the
words around them give lexical patterns (the two words before, and the word on either side). Patterns and the
identifier-like values that stand in them form a graph, which is scored in rounds: a pattern is as trustworthy
for a kind as the share of that kind in its different values that are known to be of a kind or plainly no
identifier, a value is as likely of a kind as its patterns together make it. Values that reach the threshold count
as known in the next round, and the rounds go on until one adds nothing.
In the end, identifier-like text in a trusted pattern is added as a span; base spans always stay.

Positions are code points. A match's place is the sum of the lengths of the pieces before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyspan.session import materialise

# The kinds in the order in which they are listed, and their patterns. A match can only begin
# where a run begins or right behind the match before (\G), so no run is tried from each of its characters.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: A run of non-space characters with a digit or an at sign.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Digit groups joined by blanks, dots, brackets or hyphens.
GROUPS = r"(?<![\p{L}\p{N}@])\(?\+?[0-9]++(?:[\x20().-]{1,3}+[0-9]++)++(?![\p{L}\p{N}@])"
#: Of an identifier-like value: a time, a date, an amount, or fewer than six digits in fewer than four fields.
PLAIN = (
    r"\A(?:[0-9]{4}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./][0-9]{4}|[0-9]{1,2}(?::[0-9]{2}){1,2}"
    r"|[0-9]+[.,][0-9]{1,2}|[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?|(?:[^0-9@]*[0-9]){4,5}[^0-9@]*)\z"
)
CONTEXT = 80

SPAN = "struct<start:int,kind:int,end:int,text:string,before:string,after:string>"


def _has_digit(text: Column) -> Column:
    return text.rlike("[0-9]")


def find(text: Column, pattern: str, kind: int, when: Column) -> Column:
    """Spans of all matches of ``pattern``, with up to CONTEXT characters on either side."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    n = F.size(found)
    parts = F.arrays_zip(
        F.slice(gaps, F.lit(1), n).alias("gap"), found.alias("text"), F.slice(gaps, F.lit(2), n).alias("next")
    )
    empty = F.array().cast(f"array<{SPAN}>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["text"])
        span = F.struct(
            begin.alias("start"),
            F.lit(kind).alias("kind"),
            end.alias("end"),
            x["text"].alias("text"),
            F.substring(x["gap"], -CONTEXT, CONTEXT).alias("before"),
            F.substring(x["next"], 1, CONTEXT).alias("after"),
        )
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.when(when, F.aggregate(parts, start, step, lambda acc: acc["out"])).otherwise(empty)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled, less 9 above 9; the sum is a multiple of ten."""
    n = F.length(digits)
    doubled = lambda d: F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
    total = F.aggregate(
        F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(i.alias("i"), F.substring(digits, i, F.lit(1)).cast("int").alias("d"))),
        F.lit(0),
        lambda acc, x: acc + F.when((n - x["i"]) % 2 == 1, doubled(x["d"])).otherwise(x["d"]),
    )
    return total % 10 == 0


def valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike(r"\A(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])\z"))
    if kind == "card":
        return F.when(F.length(_digits(x)).between(14, 19), luhn(_digits(x))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(x)).between(10, 15)
    return F.lit(True)


def _valid_of(kind: str):
    return lambda s: valid(kind, s["text"])


def base_spans(text: Column) -> list[Column]:
    """One array of spans for each kind."""
    out = []
    for i, kind in enumerate(KINDS):
        when = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else _has_digit(text)
        if kind != "email":
            when = when & _has_digit(text)
        spans = find(text, PATTERNS[kind], i, when)
        out.append(F.filter(spans, _valid_of(kind)).alias(kind))
    return out


def candidates(text: Column, base: Column) -> Column:
    """Identifier-like spans (kind -1): at least four digits or an at sign, clear of all base spans.

    Runs without blanks and digit groups with blanks; of the two that overlap, the context decides.
    """
    tokens = F.concat(
        find(text, TOKEN, -1, _has_digit(text) | F.contains(text, F.lit("@"))),
        F.filter(find(text, GROUPS, -1, _has_digit(text)), lambda s: F.contains(s["text"], F.lit(" "))),
    )
    opened = r"\A(?:(?!\([0-9]+\))[^\p{L}\p{N}+])*+"

    def trimmed(s: Column) -> Column:
        lead = F.length(F.regexp_extract(s["text"], opened, 0))
        core = F.regexp_replace(s["text"], opened + r"|[^\p{L}\p{N}]++\z", "")
        return F.struct(
            (s["start"] + lead).alias("start"), s["kind"].alias("kind"), (s["start"] + lead + F.length(core)).alias("end"),
            core.alias("text"), s["before"].alias("before"), s["after"].alias("after"),
        )

    like = lambda s: (F.length(F.regexp_replace(s["text"], "[^0-9@]", "")) >= 4) | F.contains(s["text"], F.lit("@"))
    clear = lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return F.filter(F.transform(tokens, trimmed), lambda s: like(s) & clear(s))


def _patterns(before: Column, after: Column) -> Column:
    """Lexical patterns of a place: the two words before it, and the word on either side."""
    words = lambda c: F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    left, right = words(before), words(after)
    two = F.when(F.size(left) >= 2, F.concat(F.lit("2 "), F.array_join(F.slice(left, -2, 2), " ")))
    around = F.when(
        (F.size(left) >= 1) & (F.size(right) >= 1), F.concat(F.lit("1 "), F.element_at(left, -1), F.lit(" _ "), F.element_at(right, 1))
    )
    return F.filter(F.array(two, around), lambda p: p.isNotNull())


def _value(kind: Column, text: Column) -> Column:
    """Values that differ in case or separators only are one."""
    return F.when(kind.isin(2, 3), _digits(text)).otherwise(F.lower(text))


def described(docs: DataFrame) -> DataFrame:
    """(row, doc_id, email, ip, card, phone, base, other, k1, k2) for every row; written, as rows are numbered."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text"))
    found = texts.select("doc_id", "text", *base_spans(F.col("text")))
    found = found.withColumn("base", F.array_sort(F.concat(*KINDS)))
    found = found.withColumn("other", candidates(F.col("text"), F.col("base")))
    found = found.withColumn("k1", F.xxhash64("text")).withColumn("k2", F.xxhash64(F.lit(1), "text")).drop("text")
    return materialise(found.withColumn("row", F.monotonically_increasing_id()), "spans")


def _plain(value: Column) -> Column:
    """It is no identifier of any kind, wherever it stands. An address of four fields may have few digits."""
    return value.rlike(PLAIN) & ~value.rlike(r"\A[0-9]+(?:[.:][0-9]+){3,}\z")


def discover(spans: DataFrame, support: int = 4, trust: float = 0.8, accept: float = 0.9) -> DataFrame:
    """(row, k1, k2, start, kind, end): candidates that trusted patterns show to be of a kind.

    A pattern is trusted for a kind if at least ``support`` different known values stand in it and they make
    up ``trust`` of its different values that are known or plainly no identifier; unseen ones tell nothing. A
    value keeps the kind it is first given. Rounds go on until none is added, so each but the last adds one.
    """
    places = spans.select("row", "k1", "k2", F.explode(F.concat("base", "other")).alias("s")).select(
        "row", "k1", "k2", "s.start", "s.end", "s.kind", _value(F.col("s.kind"), F.col("s.text")).alias("value"),
        F.explode(_patterns(F.col("s.before"), F.col("s.after"))).alias("pattern"),
    )
    places = materialise(places.withColumn("plain", (F.col("kind") < 0) & _plain(F.col("value"))), "places")
    edges = places.select("pattern", "kind", "value", "plain").distinct()
    # a pattern without enough base or candidate values can never be trusted
    wide = edges.groupBy("pattern").agg(F.count_distinct("value").alias("values"), F.count_if("plain").alias("plains")).where(F.col("values") >= support)
    edges = materialise(edges.where("not plain").drop("plain").join(wide, "pattern"), "edges")
    unseen = edges.where("kind < 0").select("pattern", "value")
    known = edges.where("kind >= 0").select("value", F.col("kind").alias("of"), F.lit(1.0).alias("score")).distinct()
    trusted = None
    while True:
        seen = edges.select("pattern", "value", "plains").distinct().join(known, "value")
        judged = seen.groupBy("pattern").agg((F.count_distinct("value") + F.first("plains")).alias("judged"))
        sure = (
            seen.groupBy("pattern", "of")
            .agg(F.sum("score").alias("good"), F.count("*").alias("n"))
            .where(F.col("n") >= support)
            .join(judged, "pattern")
            .where(F.col("good") >= trust * F.col("judged"))
            .select("pattern", "of", F.least(F.lit(0.999), F.col("good") / F.col("judged")).alias("trust"))
        )
        sure = materialise(sure, "trusted")
        scored = (
            unseen.join(sure, "pattern")
            .groupBy("value", "of")
            .agg((1 - F.exp(F.sum(F.log1p(-F.col("trust"))))).alias("score"))
            .where(F.col("score") >= accept)
            .groupBy("value")
            .agg(F.min_by(F.struct("of", "score"), F.struct(-F.col("score"), F.col("of"))).alias("s"))
            .select("value", "s.of", "s.score")
            .join(known.select("value").distinct(), "value", "left_anti")
        )
        added = materialise(scored, "added")
        pairs = sure.select("pattern", "of")
        trusted = pairs if trusted is None else trusted.union(pairs).distinct()
        if added.isEmpty():
            break
        known = materialise(known.union(added), "known")
        trusted = materialise(trusted, "all-trusted")
    return (
        places.where("kind < 0 and not plain")
        .join(trusted, "pattern")
        .join(known.select("value", "of").distinct(), ["value", "of"])
        .select("row", "k1", "k2", "start", F.col("of").alias("kind"), "end")
        .distinct()
    )


def widest(spans: Column) -> Column:
    """Spans that are no part of another: digit groups rather than one of the groups."""
    part = lambda s, o: (o["start"] <= s["start"]) & (s["end"] <= o["end"]) & (o["end"] - o["start"] > s["end"] - s["start"])
    return F.filter(spans, lambda s: ~F.exists(spans, lambda o: part(s, o)))


def written(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for every row of ``docs`` (doc_id, text).

    The counts and the digest are of base spans; ``spans`` also has those that patterns add. A null text is an
    empty one: no spans, an empty string. Rows that repeat each give a row; other columns are left out.
    """
    base = described(docs)
    added = discover(base).groupBy("row").agg(widest(F.collect_set(F.struct("start", "kind", "end"))).alias("added"))
    short = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    joined = base.join(added, "row", "left").withColumn("added", F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    return joined.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat(short, F.col("added")))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets (``<EMAIL>``); overlapping spans are one,
    named after the first. Other columns, rows and a null text stay as they are."""
    kept = docs.columns
    base = described(docs)
    key = [F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_k1"), F.xxhash64(F.lit(1), F.coalesce(F.col("text"), F.lit(""))).alias("_k2")]
    short = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    added = discover(base).groupBy("k1", "k2").agg(widest(F.collect_set(F.struct("start", "kind", "end"))).alias("_added"))
    found = base.where(F.size("base") > 0).groupBy("k1", "k2").agg(F.first(short).alias("_base"))
    spans = found.join(added, ["k1", "k2"], "full").select(
        F.col("k1").alias("_k1"), F.col("k2").alias("_k2"),
        F.array_sort(F.concat(F.coalesce("_base", F.array().cast("array<struct<start:int,kind:int,end:int>>")),
                              F.coalesce("_added", F.array().cast("array<struct<start:int,kind:int,end:int>>")))).alias("_spans"),
    )
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] > acc["at"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"])).otherwise("")
        name = F.when(s["start"] >= acc["at"], F.element_at(names, s["kind"] + 1)).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap, name).alias("out"))

    masked = F.aggregate(
        "_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return (
        docs.select("*", *key)
        .join(spans, ["_k1", "_k2"], "left")
        .withColumn("text", F.when(F.col("_spans").isNotNull() & text.isNotNull(), masked).otherwise(text))
        .select(*kept)
    )
