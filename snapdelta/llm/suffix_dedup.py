"""Exact substring deduplication by sorted suffixes.

Suffixes that start at anchors (see ``repeats``) are range-partitioned by their
leading bytes with sampled splitters. Each bucket sorts its suffixes by multikey
quicksort over eight-byte tokens, and the bytes before the anchors likewise, read
backwards. Common prefixes of sorted neighbours then tell which contexts agree on how
many bytes either way, and a window is repeated if another context agrees on both
sides of the anchor. These comparisons are of bytes.

Not every repeat needs the sort. Equal texts are told by a 128-bit key. Contexts whose
gram and whole are again elsewhere are told by hashes first, and all copies of one are then held
against each other byte by byte, in an aggregation that combines copies before the shuffle, since
they would otherwise all meet in a bucket. Copies that turn out to differ are
compared like any other context; of equal ones a single copy is sorted, where other contexts have its gram.

Suffixes with equal leading bytes stay in one bucket up to a bound (``repeats.HEAVY``
contexts); beyond it their windows are sorted over several buckets by two 64-bit
codes, and the edges of buckets are compared, so no group is too large for a task and none is cut short.

Every byte covered by a window of 200 bytes that starts anywhere else is removed, in
all places. Null counts as empty; matches never cross texts; equal texts of at least
200 bytes are removed whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .common import Stages
from .repeats import BUCKET, PAIRS, Kind, gathered, removal, repeated_by_offset, run_ends, starts_frame, unpack

WIDTH = 200
GRAM = 16
#: A fixed random 64-bit code per byte value.
CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def raw(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


BYTES = Kind(raw, WIDTH, GRAM, lambda data: CODES[data])


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """Order of rows of tokens: three-way partitions by one token, the equal part by the next."""
    order = np.arange(len(words))
    todo = [(0, len(words), 0)]
    while todo:
        low, high, depth = todo.pop()
        n = high - low
        if n < 2 or depth == words.shape[1]:
            continue
        rows = order[low:high]
        if n <= 24:
            order[low:high] = rows[np.lexsort(words[rows, depth:].T[::-1])]
            continue
        token = words[rows, depth]
        pivot = np.partition(token, n // 2)[n // 2]
        less, equal = token < pivot, token == pivot
        a, b = int(less.sum()), int(equal.sum())
        order[low:high] = np.concatenate([rows[less], rows[equal], rows[~less & ~equal]])
        todo += [(low, low + a, depth), (low + a, low + a + b, depth + 1), (low + a + b, high, depth)]
    return order


def as_tokens(rows: np.ndarray) -> np.ndarray:
    """Bytes of equal rows as big-endian eight-byte tokens, whose order is that of the bytes."""
    pad = -rows.shape[1] % 8
    return np.pad(rows, ((0, 0), (0, pad))).view(">u8").astype(np.uint64)


def common_prefixes(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each sorted row shares with the one before it."""
    out = np.zeros(len(rows), np.int64)
    for at in range(1, len(rows), 8192):
        a, b = rows[order[at - 1 : at + 8191][: len(rows) - at]], rows[order[at : at + 8192]]
        differs = a != b
        first = differs.argmax(1)
        out[at : at + len(b)] = np.where(differs.any(1), first, rows.shape[1])
    return out


def compare_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows of a bucket's contexts."""
    at, most, least = unpack(rows["place"].to_numpy())
    side = WIDTH - GRAM
    ahead = np.zeros((len(rows), WIDTH), np.uint8)
    back = np.zeros((len(rows), side), np.uint8)
    for i, (data, m, n) in enumerate(zip(rows["data"], most, least, strict=True)):
        whole = np.frombuffer(data, np.uint8)
        back[i, :m] = whole[:m][::-1]
        ahead[i, : WIDTH - n] = whole[m : m + WIDTH - n]

    def classes(side_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = multikey_quicksort(as_tokens(side_))
        return order, common_prefixes(side_, order)

    (right, right_common), (left, left_common) = classes(ahead), classes(back)
    size = np.int64(len(rows))

    def keys(before: int) -> np.ndarray:
        # Sorted neighbours that share enough bytes are of one class on that side.
        r, l_ = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        r[right] = np.cumsum(right_common < WIDTH - before)
        l_[left] = np.cumsum(left_common < before)
        return r * (size + 1) + l_

    row, low, high = repeated_by_offset(BYTES, most, least, ~rows["full"].to_numpy(), at, keys)
    return starts_frame(rows["_t1"].to_numpy()[row], rows["_t2"].to_numpy()[row], low, high)


def compare(stages: Stages, texts: DataFrame, asked: DataFrame) -> DataFrame:
    """Contexts to their buckets, and repeated windows out of them."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {"lead": [], "_t1": [], "_t2": [], "place": [], "full": [], "data": []}
            for row in b.to_pylist():
                data = row["text"].encode()
                for a in row["anchors"]:
                    at, most, least = a["place"] >> 20, a["place"] >> 10 & 1023, a["place"] & 1023
                    out["lead"].append(data[at : at + GRAM])
                    out["_t1"].append(row["_t1"])
                    out["_t2"].append(row["_t2"])
                    out["place"].append(a["place"])
                    out["full"].append(a["full"])
                    out["data"].append(data[at - most : at - least + WIDTH])
            yield pa.RecordBatch.from_pydict(out, schema=CONTEXT)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            yield compare_bucket(pd.concat(parts, ignore_index=True))

    n = asked.count()
    buckets = max(1, math.ceil(n / BUCKET))
    rows = texts.join(gathered(asked, ["place", "full"]), ["_t1", "_t2"]).select("_t1", "_t2", "text", "anchors")
    found = rows.mapInArrow(contexts, "lead BINARY, _t1 BIGINT, _t2 BIGINT, place BIGINT, full BOOLEAN, data BINARY")
    return found.repartitionByRange(buckets, F.col("lead")).mapInPandas(search, PAIRS)


def whole_contexts(texts: DataFrame, anchors: DataFrame) -> DataFrame:
    """``gram, context, data``: the bytes around each anchor."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {"gram": [], "context": [], "data": []}
            for text, found in zip(b.column("text").to_pylist(), b.column("anchors").to_pylist(), strict=True):
                data = text.encode()
                for a in found:
                    at, most, least = a["place"] >> 20, a["place"] >> 10 & 1023, a["place"] & 1023
                    out["gram"].append(a["gram"])
                    out["context"].append(a["context"])
                    out["data"].append(data[at - most : at - least + WIDTH])
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("gram", pa.int64()), ("context", pa.int64()), ("data", pa.binary())]))

    rows = texts.join(gathered(anchors, ["place", "gram", "context"]), ["_t1", "_t2"]).select("text", "anchors")
    return rows.mapInArrow(cut, "gram BIGINT, context BIGINT, data BINARY")


CONTEXT = pa.schema([
    ("lead", pa.binary()), ("_t1", pa.int64()), ("_t2", pa.int64()), ("place", pa.int64()), ("full", pa.bool_()), ("data", pa.binary()),
])


def _cut(text: str, gone: np.ndarray) -> tuple[int, int, int, str]:
    data = text.encode()
    if not gone.any():
        return len(data), 0, 0, hashlib.sha256(data).hexdigest()
    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
    return len(data), int(gone.sum()), len(run_ends(gone)[0]), hashlib.sha256(kept).hexdigest()


def _cut_text(text: str, gone: np.ndarray) -> tuple[str]:
    data = text.encode()
    kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if gone.any() else data
    return (kept.decode("utf-8", "replace"),)


def removed(docs: DataFrame, kind: Kind = BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    columns = "n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING"
    return removal(docs.sparkSession, docs.select("doc_id", "text"), kind, compare, columns, _cut, contexts=whole_contexts).drop("text")


def kept_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with ``kept``: the text without its repeated bytes."""
    return removal(docs.sparkSession, docs, BYTES, compare, "kept STRING", _cut_text, contexts=whole_contexts)


__all__ = ["kept_texts", "multikey_quicksort", "removed", "repeats"]
