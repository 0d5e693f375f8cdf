"""Taking rows out of a wide table by key without shuffling the rows that are not concerned.

A Bloom filter of fixed size parts the rows: those it clears are certainly not in the key table, only the
others meet the exact join. A null key is in no table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyspan.llm import bloom


def _side(docs: DataFrame, key: str, bits, hit: bool, made=None) -> DataFrame:
    prepare, schema = made or (iter, docs.schema)
    at = schema.fieldNames().index(key)

    def run(batches):
        for b in prepare(batches):
            k = b.column(at)
            maybe = bloom.may_hold(bits.value, k.fill_null(0).to_numpy(zero_copy_only=False)) & np.asarray(k.is_valid())
            yield b.filter(pa.array(maybe == hit))

    return docs.mapInArrow(run, schema)


def _keys(docs: DataFrame, keys: DataFrame):
    keys = keys.toDF("_in").where("_in is not null").distinct()
    return keys, docs.sparkSession.sparkContext.broadcast(bloom.build(keys))


def only(docs: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``key`` (a long) is in the one-column table ``keys``."""
    keys, bits = _keys(docs, keys)
    return _side(docs, key, bits, True).join(keys, F.col(key) == F.col("_in"), "left_semi")


def without(docs: DataFrame, key: str, keys: DataFrame, made=None) -> DataFrame:
    """The rows of ``docs`` whose ``key`` (a long) is not in the one-column table ``keys``. Runs a job over the keys when called.

    ``made`` (a function as for mapInArrow, and the StructType of its rows) makes the rows with their key from those of ``docs``
    in the task that parts them: a mapInArrow before would take a Python worker more in each task.
    """
    if keys.isEmpty():
        return docs.mapInArrow(*made) if made else docs
    keys, bits = _keys(docs, keys)
    rest = _side(docs, key, bits, True, made).join(keys, F.col(key) == F.col("_in"), "left_anti")
    return _side(docs, key, bits, False, made).unionByName(rest)
