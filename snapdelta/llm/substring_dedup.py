"""Substring deduplication over words by seed and extend.

Seeds are winnowed anchors (see ``repeats``): runs of eight words. Texts that share a
seed meet at it, and their words are extended both ways from it as far as a window
of the threshold can reach. A repeat is kept if it covers such a window; the union of
windows that occur again is the union of all maximal repeats of at least that many
words, and these words are removed in all places.

Many texts at one seed are not paired up: for each number of words before the seed,
the windows of all texts are numbered by their extension, which is one word longer at
one end and shorter at the other than the last, and equal numbers are repeats.

Words are runs between ASCII white space, unchanged. Null counts as no words; matches
never cross texts; equal texts of at least 35 words lose all of them.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, WORD, Stages, nested, unnested, words_of
from .repeats import BUCKET, PAIRS, Kind, gathered, mix, powers, prefix, removal, repeated_by_offset, run_ends, starts_frame, unpack

WIDTH = 35
GRAM = 8
BLANK = re.compile(rb"[\x20\x09-\x0D]")
PIECE = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
CODES = np.random.default_rng(21).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def word_codes(text: str) -> np.ndarray:
    """A 64-bit hash of every word, in order; a long text is hashed in pieces that end between words."""
    data, at, found = text.encode(), 0, []
    while at < len(data):
        cut = BLANK.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        found.append(_codes(np.frombuffer(data, np.uint8, end - at, at)))
        at = end
    return found[0] if len(found) == 1 else np.concatenate([np.zeros(0, np.uint64), *found])


def _codes(data: np.ndarray) -> np.ndarray:
    start, end = run_ends(~SPACE[data])
    sums = prefix(CODES[data])
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


WORDS = Kind(word_codes, WIDTH, GRAM)


def extend(rows: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows among texts that share seeds."""
    at, most, least = unpack(rows["place"].to_numpy())
    side = WIDTH - GRAM
    words = np.zeros((len(rows), side + WIDTH), np.uint64)
    for i, (data, m) in enumerate(zip(rows["data"], most, strict=True)):
        own = np.frombuffer(data, np.uint64)
        words[i, side - m : side - m + len(own)] = own
    seed = rows["gram"].to_numpy().view(np.uint64)
    up, _ = powers(WIDTH)
    state = {"before": 0, "hash": (words[:, side : side + WIDTH] * up[:WIDTH]).sum(1, dtype=np.uint64)}

    def keys(before: int) -> np.ndarray:
        while state["before"] < before:
            step = state["before"]
            last = words[:, side - step + WIDTH - 1]
            state["hash"] = (state["hash"] - last * up[WIDTH - 1]) * BASE + words[:, side - step - 1]
            state["before"] += 1
        return mix(state["hash"] ^ seed)

    row, low, high = repeated_by_offset(WORDS, most, least, ~rows["full"].to_numpy(), at, keys)
    return starts_frame(rows["_t1"].to_numpy()[row], rows["_t2"].to_numpy()[row], low, high)


CONTEXT = pa.schema([
    ("gram", pa.int64()), ("_t1", pa.int64()), ("_t2", pa.int64()), ("place", pa.int64()), ("full", pa.bool_()), ("data", pa.binary()),
])


def compare(stages: Stages, texts: DataFrame, asked: DataFrame) -> DataFrame:
    """Words around every seed to the tasks of their seeds, and repeated windows out of them."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {c: [] for c in CONTEXT.names}
            for row in b.to_pylist():
                codes = word_codes(row["text"])
                for a in row["anchors"]:
                    at, most, least = a["place"] >> 20, a["place"] >> 10 & 1023, a["place"] & 1023
                    values = (a["gram"], row["_t1"], row["_t2"], a["place"], a["full"], codes[at - most : at - least + WIDTH].tobytes())
                    for name, value in zip(CONTEXT.names, values, strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=CONTEXT)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            yield extend(pd.concat(parts, ignore_index=True))

    parts = max(1, math.ceil(asked.count() / BUCKET))
    rows = texts.join(gathered(asked, ["place", "gram", "full"]), ["_t1", "_t2"]).select("_t1", "_t2", "text", "anchors")
    found = rows.mapInArrow(contexts, "gram BIGINT, _t1 BIGINT, _t2 BIGINT, place BIGINT, full BOOLEAN, data BINARY")
    return found.repartition(parts, F.col("gram")).mapInPandas(search, PAIRS)


def _cut(text: str, gone: np.ndarray) -> tuple[int, int, str]:
    words = words_of(text)
    kept = [w for w, g in zip(words, gone, strict=True) if not g] if gone.any() else words
    return len(words), len(words) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()


def _cut_text(text: str, gone: np.ndarray) -> tuple[str]:
    if not gone.any():
        return (text,)
    spans = [m.span() for m in WORD.finditer(text)]
    return (" ".join(text[spans[a][0] : spans[b - 1][1]] for a, b in zip(*run_ends(~gone), strict=True)),)


def removed(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document."""
    columns = "n_words BIGINT, n_removed BIGINT, kept_sha256 STRING"
    return removal(docs.sparkSession, docs.select("doc_id", "text"), WORDS, compare, columns, _cut).drop("text")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` whose texts lack their repeated words; runs of kept words keep the white
    space between them. A null text stays null, and ``n_chars``, if there, follows."""
    kept = removal(docs.sparkSession, nested(docs), WORDS, compare, "_kept STRING", _cut_text)
    text = F.when(F.col("text").isNotNull(), F.col("_kept"))
    types = dict(docs.dtypes)
    new = {"n_chars": F.length(text).cast(types["n_chars"])} if "n_chars" in types else {}
    return unnested(kept, docs.columns, text=text, **new)
