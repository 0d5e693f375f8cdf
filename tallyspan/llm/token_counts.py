"""Token counts per section from one encoding of the whole text.

A text is encoded once, as a whole; tokens keep their place in it. Sections (lines, fields, …) are consecutive
spans of code points. A task joins the two lists of sorted intervals by binary search. A token that crosses a
boundary is allocated by a named rule:

* ``first`` / ``last``: to the section of its first / last character,
* ``largest``: to the section that holds most of its characters, the first of equal ones,
* ``share``: to each section in proportion to its characters (counts are then fractions).

A byte-level token may hold part of a character; its span is that of the characters it touches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tallyspan.llm.bpe import Vocabulary, _encoder
from tallyspan.llm.words import chunks, text_bytes

RULES = ("first", "last", "largest", "share")


def lines(text: Column) -> Column:
    """Section lengths of the lines of a text, each with its line break; a null text is an empty one, of one line."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.length(x) + 1)


def joined_fields(fields: list[str], separator: str = "\n") -> tuple[Column, Column]:
    """(text, section lengths) of several columns joined in order; each separator counts with the field before it."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    return F.concat_ws(separator, *values), F.array(*[F.length(v) + len(separator) for v in values])


def allocate(starts: np.ndarray, stops: np.ndarray, ends: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section from token spans [start, stop) and the sections' ends; the last entry is text past all sections."""
    count = len(ends) + 1
    first = np.searchsorted(ends, starts, "right")
    last = np.searchsorted(ends, stops - 1, "right")
    if rule == "first":
        return np.bincount(first, minlength=count).astype(np.float64)
    if rule == "last":
        return np.bincount(last, minlength=count).astype(np.float64)
    out = np.bincount(first[first == last], minlength=count).astype(np.float64)
    across = np.flatnonzero(first != last)
    if len(across):
        borders = np.concatenate(([0], ends, [np.iinfo(np.int64).max]))
        pieces = last[across] - first[across] + 1
        begin = np.concatenate(([0], np.cumsum(pieces)[:-1]))
        token = np.repeat(across, pieces)
        section = np.repeat(first[across] - begin, pieces) + np.arange(len(token))
        held = np.minimum(borders[section + 1], stops[token]) - np.maximum(borders[section], starts[token])
        if rule == "largest":
            order = np.lexsort((section, -held, token))
            out += np.bincount(section[order[begin]], minlength=count)
        else:
            out += np.bincount(section, held / np.repeat(np.add.reduceat(held, begin), pieces), minlength=count)
    return out


def section_ends(lengths: pa.Array, until: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, end) of every section of consecutive texts, of which text k ends at until[k]; ends run over all texts.

    Each text's sections are followed by one more, numbered -1, for what is past them. A null list has no sections, a
    null length is 0.
    """
    counts = pc.fill_null(pc.list_value_length(lengths), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    running = np.concatenate(([0], np.cumsum(pc.fill_null(lengths.flatten(), 0).to_numpy(zero_copy_only=False).astype(np.int64))))
    before = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(text)) - before[text]
    begin = np.concatenate(([0], until[:-1]))
    own = np.minimum(begin[text] + running[1:] - running[before[text]], until[text])
    past = np.arange(len(counts)) + before + counts
    numbers, ends = np.full(len(text) + len(counts), -1), np.empty(len(text) + len(counts), np.int64)
    ends[past] = until
    numbers[np.arange(len(text)) + text] = number
    ends[np.arange(len(text)) + text] = own
    return numbers, ends


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, lengths: Column, rule: str = "largest", text: str | Column = "text") -> DataFrame:
    """(doc_id, section, n_chars, n_tokens): a row per section, numbered from 0, of every row of ``docs``.

    ``lengths`` gives the code points of each section in order. What a text has beyond them is section null (only
    if it holds anything); a section beyond the text is shorter or empty and has no tokens. A null text is an empty
    one. n_tokens is a double, whole unless the rule is ``share``. Repeated rows each give their rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encoder = _encoder(shared)
        token_bytes = np.array([len(t) for t in encoder.vocabulary.tokens], np.int64)
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for first, last in chunks(bounds):
                part = batch.slice(first, last - first)
                ids = encoder.encode(part.column(1).fill_null("").to_pylist())
                character = np.cumsum((data[bounds[first] : bounds[last]] & 0xC0) != 0x80)
                until = np.concatenate(([0], character))[bounds[first + 1 : last + 1] - bounds[first]]  # where each text ends
                number, ends = section_ends(part.column(2), until)
                # the spans of a chunk's texts follow one another, so one search serves all
                upto = np.cumsum(token_bytes[np.frombuffer(b"".join(ids), "<u4")])
                if len(upto):
                    starts = character[np.concatenate(([0], upto[:-1]))] - 1
                    tokens = allocate(starts, character[upto - 1], ends, rule)[:-1]
                else:
                    tokens = np.zeros(len(ends))
                size = np.diff(ends, prepend=0)
                row = np.cumsum(number < 0) - (number < 0)
                keep = (number >= 0) | (size > 0)
                number = number[keep]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row[keep])), pa.array(number.astype(np.int32), mask=number < 0), pa.array(size[keep].astype(np.int64)), pa.array(tokens[keep])],
                    ["doc_id", "section", "n_chars", "n_tokens"],
                )

    column = F.col(text) if isinstance(text, str) else text
    return docs.select("doc_id", column.cast("string").alias("text"), lengths.alias("lengths")).mapInArrow(
        run, f"doc_id {kind}, section int, n_chars long, n_tokens double"
    )
