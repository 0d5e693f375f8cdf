"""User-defined aggregates from a reset, an aggregate and a combine function."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

HELD = 100_000

def scripted_aggregate(
    df: DataFrame,
    group: list[str],
    fields: list[str],
    name: str,
    reset: Callable[[], float],
    fold: Callable[[float, pd.DataFrame], float],
    combine: Callable[[float, float], float],
    fan: int = 64,
) -> DataFrame:
    """``fold`` runs over Arrow batches where the rows are, so no group is ever gathered whole.

    A task keeps one state per group and hands it on once; beyond ``HELD`` groups it hands on what it has and
    starts anew. ``reset`` gives a neutral state: combining it with any other changes nothing. The states are
    merged first per slot and then per group.
    """
    keys = [df.schema[g] for g in group]
    state = T.StructType([*keys, T.StructField("_slot", T.IntegerType()), T.StructField(name, T.DoubleType())])
    merged = T.StructType([*keys, T.StructField(name, T.DoubleType())])

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part_no = TaskContext.get().partitionId()
        states: dict[tuple, float] = {}

        def handed_on() -> pd.DataFrame:
            rows = [(*key, part_no % fan, s) for key, s in states.items()]
            states.clear()
            return pd.DataFrame(rows, columns=[*group, "_slot", name])

        for batch in batches:
            for key, part in batch.groupby(group, dropna=False, sort=False):
                key = tuple(None if pd.isna(k) else k for k in key)
                states[key] = fold(states[key] if key in states else reset(), part)
            if len(states) > HELD:
                yield handed_on()
        yield handed_on()

    def merge(kept: list[str], schema: T.StructType):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            row = {k: [pdf[k].iloc[0]] for k in kept}
            row[name] = [float(reduce(combine, pdf[name].tolist()))]
            return pd.DataFrame(row)[schema.fieldNames()]

        return run

    states = df.select(*group, *fields).mapInPandas(per_batch, state)
    slots = states.groupBy(*group, "_slot").applyInPandas(merge([*group, "_slot"], state), state)
    return slots.groupBy(*group).applyInPandas(merge(group, merged), merged)
