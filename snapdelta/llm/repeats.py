"""Windows of tokens that occur more than once: what both substring operators share.

A window of ``width`` consecutive tokens is represented by its anchor, the token run
of ``gram`` tokens in it with the smallest hash (the leftmost of equals). Equal
windows have equal anchors at equal places, so only anchors need to meet: about one
per half a window of text. An anchor stands for a run of windows, and its *context*
is the text they cover. Anchors are compared in steps, each of which leaves less:

1. anchors whose gram occurs once have no repeated window;
2. anchors whose whole context occurs again have only repeated windows;
3. of each other context, and of one copy of each repeated context whose gram also
   has other contexts, the tokens around the anchor are compared window by window.

Equal texts are collapsed first: they are stored once, hashed by a 128-bit key, in a
bucketed table, so texts are shuffled a single time and later joins only move small
rows to them. Counts and smallest ids are combined before every shuffle, so a gram
or context of a third of all anchors leaves each task as one row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, new_path
from .common import BASE, MIX, Stages, shuffle_cleanup

#: Tokens of a text whose hashes are held at a time.
PIECE = 1 << 20
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; tables grow with the longest piece met."""
    if not _powers or len(_powers["up"]) <= n:
        size = max(1 << 16, 1 << int(n).bit_length())
        one = np.ones(1, np.uint64)
        _powers["up"] = np.cumprod(np.concatenate([one, np.full(size, BASE)]))
        _powers["down"] = np.cumprod(np.concatenate([one, np.full(size, INVERSE)]))
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    x = (x ^ (x >> np.uint64(29))) * BASE
    return x ^ (x >> np.uint64(32))


def prefix(codes: np.ndarray) -> np.ndarray:
    """Sums from which any run's polynomial hash follows."""
    up, _ = powers(len(codes))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up[: len(codes)])])


def run_hash(sums: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    _, down = powers(len(sums))
    return (sums[start + length] - sums[start]) * down[start]


def smallest(values: np.ndarray, size: int) -> np.ndarray:
    """Position of the leftmost smallest value of every window of ``size`` values."""
    n = len(values) - size + 1
    key = values & ~np.uint64(0xFFFFFFFF) | np.arange(len(values), dtype=np.uint64)
    rows = np.concatenate([key, np.full(-len(key) % size, ~np.uint64(0))]).reshape(-1, size)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return (np.minimum(back[:n], ahead[size - 1 : size - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


@dataclass(frozen=True)
class Kind:
    """What a token is, and how wide windows and grams are."""

    #: A text's tokens, and their 64-bit codes, made of ``PIECE`` tokens at a time.
    tokens: Callable[[str], np.ndarray]
    width: int
    gram: int
    codes: Callable[[np.ndarray], np.ndarray] = lambda tokens: tokens
    #: Bits of a context's hash; fewer only show that nothing rests on them.
    bits: int = 64

    def anchors(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Packed places, gram hashes and context hashes of a text's anchors. A long text is
        walked in pieces; a run of windows cut between two is two contexts of one anchor."""
        tokens = self.tokens(text)
        n = len(tokens) - self.width + 1
        if n < 1:
            return None
        found = [self._anchors(self.codes(tokens[at : at + PIECE + self.width - 1]), at) for at in range(0, n, PIECE)]
        return found[0] if len(found) == 1 else tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _anchors(self, codes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(codes) - self.width + 1
        sums = prefix(codes)
        grams = mix(run_hash(sums, np.arange(len(codes) - self.gram + 1), self.gram))
        at = smallest(grams, self.width - self.gram + 1)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.concatenate([first[1:], [n]]) - 1
        at = at[first]
        place = pack(at, at - first, at - last)
        context = run_hash(sums, first, last - first + self.width)
        context = mix(context + place.astype(np.uint64) % np.uint64(1 << 20) * MIX)
        return place + (start << 20), grams[at], context >> np.uint64(64 - self.bits)


def pack(at: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Anchor position, and the most and least tokens a window may have before it."""
    return at << 20 | most << 10 | least


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 20, place >> 10 & 1023, place & 1023


def keyed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the two halves of the text's key; null counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({"_t1": F.xxhash64(text), "_t2": F.xxhash64(F.lit("second half"), text)})


class Texts:
    """Every distinct text once, bucketed by key; a context manager that drops the table."""

    def __init__(self, docs: DataFrame, text_col: str = "text"):
        self.spark = docs.sparkSession
        self.name = f"texts_{uuid.uuid4().hex}"
        self.path = new_path(self.spark, "texts")
        rows = keyed(docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")))
        rows = rows.groupBy("_t1", "_t2").agg(F.first("text").alias("text"), (F.count("*") > 1).alias("copied"))
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        with shuffle_cleanup(self.spark):
            rows.write.option("path", self.path).bucketBy(n, "_t1", "_t2").saveAsTable(self.name)

    def __enter__(self) -> DataFrame:
        return self.spark.table(self.name)

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.path)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


ANCHORS = "_t1 BIGINT, _t2 BIGINT, place BIGINT, gram BIGINT, context BIGINT"


def find_anchors(texts: DataFrame, kind: Kind) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [kind.anchors(t) for t in b.column("text").to_pylist()]
            of = np.repeat(np.arange(len(found)), [0 if f is None else len(f[0]) for f in found])
            found = [f for f in found if f is not None]
            if found:
                place, gram, context = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b.column("_t1").take(pa.array(of)), b.column("_t2").take(pa.array(of))]
                    + [pa.array(x) for x in (place, signed(gram), signed(context))],
                    names=["_t1", "_t2", "place", "gram", "context"],
                )

    return texts.select("_t1", "_t2", "text").mapInArrow(find, ANCHORS)


def classify(stages: Stages, anchors: DataFrame) -> DataFrame:
    """Anchors that can have repeated windows: ``full`` ones have only such; ``compare``
    marks those whose tokens must be compared, ``heavy`` if their gram has too many
    contexts for one task."""
    grams = anchors.groupBy("gram").agg(F.count("*").alias("n"), (F.min("context") != F.max("context")).alias("mixed"))
    grams = stages.write(grams.filter("n > 1").drop("n"), "grams")
    rows = stages.write(anchors.join(grams, "gram"), "candidates")
    name = F.struct("_t1", "_t2", "place")
    contexts = rows.groupBy("gram", "context").agg((F.count("*") > 1).alias("full"), F.min(name).alias("first"))
    contexts = stages.write(contexts, "contexts")
    heavy = contexts.groupBy("gram").count().filter(F.col("count") > HEAVY).select("gram", F.lit(True).alias("heavy"))
    contexts = contexts.join(heavy, "gram", "left") if not heavy.isEmpty() else contexts.withColumn("heavy", F.lit(None).cast("boolean"))
    rows = rows.join(contexts, ["gram", "context"])
    compare = F.col("mixed") & (~F.col("full") | (F.col("first") == name))
    heavy_ = F.coalesce("heavy", F.lit(False)).alias("heavy")
    return stages.write(rows.select("_t1", "_t2", "place", "gram", "context", "full", compare.alias("compare"), heavy_), "anchors")


#: Contexts of one gram that one task compares; grams with more are compared by windows.
HEAVY = 50_000
#: Contexts a bucket is planned for.
BUCKET = 30_000


def gathered(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per text a list of packed places; as long as the text at most."""
    return rows.groupBy("_t1", "_t2").agg(F.collect_list(F.struct(*columns)).alias("anchors"))


def run_ends(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def covered(n: int, width: int, starts: list[tuple[int, int]]) -> np.ndarray:
    """Which of ``n`` tokens lie in windows that start in the given closed ranges."""
    edge = np.zeros(n + 1, np.int32)
    if starts:
        low, high = np.array(starts, np.int64).T
        np.add.at(edge, low, 1)
        np.add.at(edge, high + width, -1)
    return np.cumsum(edge)[:-1] > 0


PAIRS = "_t1 BIGINT, _t2 BIGINT, low BIGINT, high BIGINT"


def starts_frame(t1: np.ndarray, t2: np.ndarray, low: np.ndarray, high: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"_t1": t1, "_t2": t2, "low": low, "high": high})


def repeated_by_offset(
    kind: Kind, most: np.ndarray, least: np.ndarray, wanted: np.ndarray, at: np.ndarray, keys: Callable[[int], np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every number of tokens before the anchor, which contexts have a window that
    another context has as well. ``keys`` numbers the windows of all contexts; returns
    the context and the first and last start of each run of repeated windows."""
    found = np.zeros((len(at), kind.width - kind.gram + 2), bool)
    for before in range(kind.width - kind.gram + 1):
        own = np.flatnonzero((least <= before) & (before <= most))
        if len(own) < 2:
            continue
        key = keys(before)[own]
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(own), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        found[own[twice], before] = True
    found[~wanted] = False
    flat = np.zeros((len(at), found.shape[1] + 1), bool)
    flat[:, 1:] = found
    low, high = run_ends(flat.ravel())
    row, first = np.divmod(low, flat.shape[1])
    last = (high - 1) % flat.shape[1]
    return row, at[row] - (last - 1), at[row] - (first - 1)


def heavy_windows(stages: Stages, texts: DataFrame, rows: DataFrame, kind: Kind) -> DataFrame:
    """Windows of anchors whose gram has too many contexts for one task, compared as rows
    of their own: the exact way beyond ``HEAVY``.

    Windows are cut by sampled splitters into ranges of (first token, hash, text), so a
    window of any number of texts spreads over buckets; each bucket is sorted, equal
    neighbours are repeated, and a window at the edge of a bucket is compared with the
    edges of the buckets beside it.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                codes = kind.codes(kind.tokens(row["text"]))
                sums = prefix(codes)
                place = np.array([a["place"] for a in row["anchors"]], np.int64)
                partial = np.array([not a["full"] for a in row["anchors"]])
                at, most, least = unpack(place)
                n = most - least + 1
                start = np.repeat(at - most, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                wide = mix(run_hash(sums, start, kind.width))
                yield pa.RecordBatch.from_pydict({
                    "lead": signed(codes[start]), "hash": signed(wide), "_t1": np.full(len(start), row["_t1"]),
                    "_t2": np.full(len(start), row["_t2"]), "start": start, "partial": np.repeat(partial, n),
                })

    lists = gathered(rows, ["place", "full"])
    windows = texts.join(lists, ["_t1", "_t2"]).mapInArrow(
        emit, "lead BIGINT, hash BIGINT, _t1 BIGINT, _t2 BIGINT, start BIGINT, partial BOOLEAN"
    )
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["lead", "hash", "_t1", "_t2", "start"]
    ranged = windows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = stages.write(ranged.withColumn("bucket", F.spark_partition_id()), "windows")
    window = F.struct("lead", "hash")
    counts = ranged.groupBy("bucket", "lead", "hash").agg(F.count("*").alias("n"))
    edges = counts.groupBy("bucket").agg(F.min(window).alias("first"), F.max(window).alias("last"))
    # One row per bucket: windows at an edge that a bucket beside it has too.
    both = edges.select("bucket", F.explode(F.array_distinct(F.array("first", "last"))).alias("w"))
    shared = both.groupBy("w").agg(F.count("*").alias("buckets")).filter("buckets > 1").select("w.lead", "w.hash")
    twice = counts.filter("n > 1").select("lead", "hash").unionByName(shared).distinct()
    again = ranged.filter("partial").join(twice, ["lead", "hash"], "left_semi")
    return again.select("_t1", "_t2", F.col("start").alias("low"), F.col("start").alias("high"))


def unlike(stages: Stages, anchors: DataFrame, contexts: DataFrame) -> DataFrame:
    """``gram, context`` of those whose copies differ in bytes: ``contexts`` has ``data`` for every
    full anchor. Copies combine before the shuffle, so a context of any number of copies leaves each task once."""
    both = contexts.groupBy("gram", "context").agg(F.min("data").alias("least"), F.max("data").alias("most"))
    return stages.write(both.filter("least <> most").select("gram", "context", F.lit(True).alias("unlike")), "unlike")


def repeated_starts(
    stages: Stages,
    texts: DataFrame,
    kind: Kind,
    compare: Callable[[Stages, DataFrame, DataFrame], DataFrame],
    contexts: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Per text the ranges of starts of its repeated windows, as a list. With ``contexts`` (texts and
    anchors to ``gram, context, data``) copies of a context are held against each other, and those that
    only share a hash are compared like any other."""
    anchors = classify(stages, stages.write(find_anchors(texts, kind), "all-anchors"))
    if contexts is not None:
        odd = unlike(stages, anchors, contexts(texts, anchors.filter("full")))
        if not odd.isEmpty():
            differ = F.col("unlike").isNotNull()
            anchors = anchors.join(odd, ["gram", "context"], "left").withColumns(
                {"full": F.col("full") & ~differ, "compare": F.col("compare") | differ}
            )
            anchors = stages.write(anchors.drop("unlike"), "anchors-apart")
    at, most, least = F.shiftright("place", 20), F.shiftright("place", 10).bitwiseAND(1023), F.col("place").bitwiseAND(1023)
    full = anchors.filter("full").select("_t1", "_t2", (at - most).alias("low"), (at - least).alias("high"))
    asked = anchors.filter("compare")
    partial = compare(stages, texts, asked.filter("NOT heavy"))
    heavy = asked.filter("heavy")
    if not heavy.isEmpty():
        partial = partial.unionByName(heavy_windows(stages, texts, heavy, kind))
    partial = stages.write(partial, "partial")
    return stages.write(full.unionByName(partial).groupBy("_t1", "_t2").agg(F.collect_list(F.struct("low", "high")).alias("starts")), "starts")


def removal(
    spark: SparkSession,
    docs: DataFrame,
    kind: Kind,
    compare: Callable[[Stages, DataFrame, DataFrame], DataFrame],
    columns: str,
    cut: Callable[[str, np.ndarray], tuple],
    text_col: str = "text",
    contexts: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``docs`` joined with what ``cut`` gives for each text and its removed tokens."""
    names = [c.split()[0] for c in columns.split(", ")]
    types = {"BIGINT": pa.int64(), "STRING": pa.string()}
    arrow = [types[c.split()[1]] for c in columns.split(", ")]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, copied, starts in zip(*(b.column(c).to_pylist() for c in ("text", "copied", "starts")), strict=True):
                n = len(kind.tokens(text)) if starts or copied else 0
                if copied and n >= kind.width:
                    gone = np.ones(n, bool)
                else:
                    gone = covered(n, kind.width, [(s["low"], s["high"]) for s in starts or []])
                rows.append(cut(text, gone))
            values = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [b.column("_t1"), b.column("_t2"), *[pa.array(v, t) for v, t in zip(values, arrow, strict=True)]],
                names=["_t1", "_t2", *names],
            )

    with Stages(spark) as stages, Texts(docs, text_col) as texts:
        starts = repeated_starts(stages, texts, kind, compare, contexts)
        done = texts.join(starts, ["_t1", "_t2"], "left").select("_t1", "_t2", "text", "copied", "starts")
        result = Stages(spark).write(done.mapInArrow(finish, f"_t1 BIGINT, _t2 BIGINT, {columns}"), "removed", keep=True)
    return keyed(docs, text_col).join(result, ["_t1", "_t2"]).drop("_t1", "_t2")
