"""Byte-level BPE encoding and decoding with a two-tier lookup.

A pre-token that is a vocabulary entry as a whole is resolved by a minimal perfect hash (hash and
displace: one displacement per bucket, as many slots as tokens), probed for all new pre-tokens of a chunk
at once. Any other pre-token is merged: its bytes form a linked list, a heap holds the adjacent pairs by
rank and place, and stale heap entries are skipped, so a pre-token of any length takes n log n steps.
A task keeps what it has resolved, up to a bounded number of pre-tokens.

Ids are stored as little-endian unsigned 32-bit integers in a binary column.
"""

from __future__ import annotations

import base64
import heapq
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tallyspan.llm.words import U64, chunks, mix, span_hashes, text_bytes

REMEMBERED = 200_000  # resolved pre-tokens that a worker keeps; beyond it those not met of late go
MOST_TOKENS = 2_000_000  # a vocabulary is broadcast: larger ones are refused
REMEMBERED_LENGTH = 64  # longer pre-tokens are resolved each time
_STEP = U64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by rank, and the perfect hash over them."""

    pattern: str
    tokens: tuple[bytes, ...]
    shift: np.ndarray
    rank_at: np.ndarray

    def whole(self, pieces: list[bytes]) -> list[int]:
        """The rank of each piece that is a token, else -1."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(lengths)
        hashes = span_hashes(np.frombuffer(b"".join(pieces), np.uint8), ends - lengths, ends)
        ranks = self.rank_at[_slots(hashes, self.shift[(hashes % U64(len(self.shift))).astype(np.int64)], len(self.rank_at))].tolist()
        tokens = self.tokens
        return [r if tokens[r] == p else -1 for r, p in zip(ranks, pieces)]


def _slots(hashes: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    moved = (mix(hashes + shift.astype(U64) * _STEP) % U64(n)).astype(np.int64)
    return np.where(shift < 0, -1 - shift, moved)


def perfect_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacement per bucket, key number per slot) for distinct hashes; a negative displacement names the slot."""
    n = len(hashes)
    buckets = max(1, n // 4)
    shift = np.zeros(buckets, np.int64)
    key_at = np.full(n, -1, np.int64)
    bucket = (hashes % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if n else []
    tries = np.arange(1, 257, dtype=np.int64)
    free = None
    for keys in sorted(groups, key=len, reverse=True):
        b = bucket[keys[0]]
        if len(keys) == 1:
            free = free if free is not None else iter(np.flatnonzero(key_at < 0).tolist())
            slot = next(free)
            shift[b], key_at[slot] = -1 - slot, keys[0]
            continue
        base = 0
        while True:
            at = _slots(hashes[keys][None, :], (tries + base)[:, None], n)
            ordered = np.sort(at, axis=1)
            good = np.flatnonzero((key_at[at] < 0).all(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1))
            if len(good):
                shift[b] = tries[good[0]] + base
                key_at[at[good[0]]] = keys
                break
            base += len(tries)
    return shift, key_at


def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    """From a file of lines ``base64-token rank`` with ranks 0, 1, 2 …"""
    ranked = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranked[int(rank)] = base64.b64decode(token)
    if sorted(ranked) != list(range(len(ranked))) or len(set(ranked.values())) != len(ranked):
        raise ValueError(f"{path}: ranks must be 0 to n - 1, each token once")
    if len(ranked) > MOST_TOKENS:
        raise ValueError(f"{path}: {len(ranked)} tokens; at most {MOST_TOKENS} are broadcast")
    tokens = tuple(ranked[r] for r in range(len(ranked)))
    lengths = np.array([len(t) for t in tokens], np.int64)
    ends = np.cumsum(lengths)
    shift, rank_at = perfect_hash(span_hashes(np.frombuffer(b"".join(tokens), np.uint8), ends - lengths, ends))
    return Vocabulary(pattern, tokens, shift, rank_at)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of a piece's tokens: always the pair of least rank, leftmost first, becomes one token."""
    n = len(piece)
    rank_of, push, pop, replace = ranks.get, heapq.heappush, heapq.heappop, heapq.heapreplace
    after = list(range(1, n + 1))  # end of the token that starts here
    before = list(range(-1, n))
    pair = [rank_of(piece[i : i + 2], -1) for i in range(n - 1)]  # rank of the token here with the next one; -1 if none
    pair.append(-1)
    # an entry is rank and start in one small integer; it holds as long as the pair there has that rank
    shift = n.bit_length()
    low = (1 << shift) - 1
    heap = [r << shift | i for i, r in enumerate(pair) if r >= 0]
    heapq.heapify(heap)
    while heap:
        least = heap[0]
        start = least & low
        if pair[start] != least >> shift:
            pop(heap)
            continue
        middle = after[start]
        end = after[start] = after[middle]
        before[end], pair[middle] = start, -1
        pair[start] = r = rank_of(piece[start : after[end]], -1) if end < n else -1
        left = before[start]
        if left >= 0:
            pair[left] = further = rank_of(piece[left:end], -1)
            if further >= 0:
                replace(heap, further << shift | left)  # in the place of the entry that is done
                if r >= 0:
                    push(heap, r << shift | start)
                continue
        if r >= 0:
            replace(heap, r << shift | start)
        else:
            pop(heap)
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : after[at]]])
        at = after[at]
    return out


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Resolves pre-tokens to their ids as bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.split = regex.compile(vocabulary.pattern).findall
        self.ranks = {t: r for r, t in enumerate(vocabulary.tokens)}
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}  # resolved before ``known`` last started anew

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [self.split(t) for t in texts]
        if len(self.known) > REMEMBERED // 2:
            self.known, self.earlier = {}, self.known
        known, earlier = self.known, self.earlier
        new = [p for p in set().union(*pieces) if p not in known]
        once = {}
        if new and earlier:
            known.update((p, earlier[p]) for p in new if p in earlier)
            new = [p for p in new if p not in known]
        if new:
            raw = [p.encode() for p in new]
            for piece, data, rank in zip(new, raw, self.vocabulary.whole(raw)):
                ids = rank.to_bytes(4, "little") if rank >= 0 else _packed(merge(data, self.ranks))
                (known if len(piece) <= REMEMBERED_LENGTH else once)[piece] = ids
        if once:
            look = lambda p: known.get(p) or once[p]
            return [b"".join(map(look, own)) for own in pieces]
        return [b"".join(map(known.__getitem__, own)) for own in pieces]


_encoders: list[tuple[object, Encoder]] = []


def _encoder(shared) -> Encoder:
    """One encoder per worker and vocabulary."""
    if not _encoders or _encoders[0][0] is not shared.value:
        _encoders[:] = [(shared.value, Encoder(shared.value))]
    return _encoders[0][1]


def _encoding(shared):
    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            _, bounds = text_bytes(batch.column(1))
            for first, last in chunks(bounds):
                texts = batch.column(1).slice(first, last - first).fill_null("").to_pylist()
                ids = encoder.encode(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return run


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids) for every row of ``docs``; other columns are left out.

    A null or empty text has no ids (an empty binary, not null). Repeated rows each give a row.
    """
    run = _encoding(docs.sparkSession.sparkContext.broadcast(vocabulary))
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def _decoding(shared):
    def run(batches):
        token = shared.value.tokens.__getitem__
        for batch in batches:
            _, bounds = text_bytes(batch.column(1))
            for first, last in chunks(bounds):
                part = batch.slice(first, last - first)
                decoded = [None if x is None else b"".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    return run


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that the ids stand for. Null ids decode to null; an id outside the vocabulary fails."""
    run = _decoding(encoded.sparkSession.sparkContext.broadcast(vocabulary))
    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids binary, decoded binary"
    )


def encode_and_decode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """What ``decode`` returns for ``encode`` of ``docs``, by one Python worker per task: as two steps each would keep the vocabulary in one of its own."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    encoding, decoding = _encoding(shared), _decoding(shared)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        lambda batches: decoding(encoding(batches)), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, decoded binary"
    )


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
