"""Work ranges for reads split by key: disjoint, complete, and never more of them than asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def ranges(lo: int, hi: int, n: int) -> list[tuple[int, int]]:
    """``[lo, hi]`` as at most ``n`` half-open ranges that cover it exactly; the step is at least 1."""
    if n < 1:
        raise ValueError("at least one range")
    span = hi + 1 - lo
    if span <= 0:
        return []
    n = min(n, span)
    cuts = [lo + span * i // n for i in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


def range_predicates(key: str, parts: list[tuple[int, int]], nullable: bool = True) -> list[str]:
    """One predicate per range; rows without a key belong to no range and get their own."""
    out = [f"{key} >= {a} AND {key} < {b}" for a, b in parts]
    return [*out, f"{key} IS NULL"] if nullable or not out else out


def hash_predicates(key: str, n: int, hashed: str | None = None) -> list[str]:
    """Without a split key: one predicate per remainder of an integer key, negative keys included.

    A key that is no integer needs ``hashed``: the database's hash of it, as an integer expression
    (``CRC32(name)``, ``ORA_HASH(name)`` …).
    """
    number = hashed or key
    return [f"MOD(MOD({number}, {n}) + {n}, {n}) = {i}" for i in range(n)] + [f"{key} IS NULL"]


def default_split_key(configured: str | None, primary_keys: list[str]) -> str | None:
    """The configured key, else a sole primary key named ``id`` in any case, else none."""
    if configured:
        return configured
    if len(primary_keys) == 1 and primary_keys[0].lower() == "id":
        return primary_keys[0]
    return None


def task_of(predicates: list[str]) -> Column:
    """Number of the predicate a row falls under, for checks and for tables read as a whole."""
    out = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(predicates))):
        out = F.when(F.expr(p), F.lit(i)).otherwise(out)
    return out


def balanced_ranges(tables: DataFrame, tasks: int) -> DataFrame:
    """Ranges over many tables with about equal rows per task, at most ``tasks`` tasks.

    ``tables`` has one row per table: ``table, lo, hi`` (inclusive keys) and ``rows``. Large tables
    are cut, small ones packed together. One row per table goes in and at most tables + tasks come
    out, so the one ordered window here is over metadata, not over rows.
    """
    total = F.sum("rows").over(Window.partitionBy())
    sized = tables.where("rows > 0").withColumn("_step", F.greatest(F.lit(1), F.ceil(total / F.lit(tasks))))
    keys = F.col("hi").cast("decimal(20,0)") - F.col("lo") + 1
    pieces = F.least(F.greatest(F.lit(1), F.ceil(F.col("rows") / F.col("_step"))).cast("decimal(20,0)"), keys).cast("long")
    cut = (
        sized.withColumn("_n", pieces)
        .withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    )

    def edge(i):
        # in decimals: keys may spread over the whole range of longs
        span = F.col("hi").cast("decimal(20,0)") + 1 - F.col("lo")
        return (F.col("lo") + F.floor((span * i).cast("decimal(38,0)") / F.col("_n").cast("decimal(18,0)"))).cast("decimal(20,0)").try_cast("long")

    share = F.call_function("div", F.col("rows") * (F.col("_i") + 1), F.col("_n")) - F.call_function("div", F.col("rows") * F.col("_i"), F.col("_n"))
    out = cut.select("table", edge(F.col("_i")).alias("lo"), edge(F.col("_i") + 1).alias("hi"), share.alias("rows"), "_step")
    running = F.sum("rows").over(Window.orderBy("table", "lo").rowsBetween(Window.unboundedPreceding, 0))
    # a range belongs to the task its middle falls into; what is left joins the last task
    middle = F.col("_until") - F.col("rows") / 2
    task = F.least(F.lit(tasks - 1), F.floor(middle / F.col("_step"))).cast("long")
    return out.withColumn("_until", running).withColumn("task", task).drop("_until", "_step")
