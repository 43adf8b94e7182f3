"""Best-fit packing of token sequences with large items matched first.

Documents are tokenized and get an end token; longer ones are cut into pieces of the
capacity. Pieces above a third of the capacity fit at most two to a bin, so they are
paired greedily: the longest with the longest partner that fits. Smaller pieces then
go, longest first, into the tightest gap that holds them.

Packing needs lengths only, and there are at most ``capacity`` of them: the plan is
made from the histogram of lengths, for whole classes of equal bins at a time, and
its size does not depend on the number of documents. Each piece finds its place from
its length and its rank among pieces of that length. Ranks are counted per task and
added up over tasks, so no task sees all pieces of a length.

A null or empty text is the end token alone. Repeated rows are packed each on its own.
"""

from __future__ import annotations

import bisect
import json
import struct
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Rows, Stages

CAPACITY = 4096
END = 1
CACHE = 1_000_000
BATCH = 512


# How byte-level tokenizers write a byte as a character. Printable Latin-1
# stands for itself, the other bytes follow from code point 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
SYMBOL = {b: chr(b) for b in PRINTABLE}
SYMBOL |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in SYMBOL)}


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows ``length, first rank, bins, first bin, offset``: pieces of a length with ranks
    from the first one on lie in consecutive bins at one offset."""
    left = {n: c for n, c in histogram.items() if c}
    slots: list[tuple[int, int, int, int, int]] = []
    used = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    bins = 0

    def take(length: int, count: int, first: int, offset: int) -> None:
        slots.append((length, used[length], count, first, offset))
        used[length] += count
        left[length] -= count

    def leave(gap: int, first: int, count: int) -> None:
        if gap:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, count))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        at = bisect.bisect_right(large, capacity - a) - 1
        while at >= 0 and left[large[at]] < (2 if large[at] == a else 1):
            if not left[large[at]]:
                large.pop(at)
            at -= 1
        b = large[at] if at >= 0 else 0
        count = left[a] if not b else left[a] // 2 if a == b else min(left[a], left[b])
        take(a, count, bins, 0)
        if b:
            take(b, count, bins, a)
        leave(capacity - a - b, bins, count)
        bins += count

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect.bisect_left(sizes, n)
            if at == len(sizes):
                count = -(-left[n] // (capacity // n))
                leave(capacity, bins, count)
                bins += count
                continue
            gap = sizes[at]
            first, open_ = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                sizes.pop(at)
            count = min(left[n], open_)
            take(n, count, first, capacity - gap)
            leave(gap - n, first, count)
            if count < open_:
                leave(gap, first + count, open_ - count)
    rows = np.array(slots, np.int64).reshape(-1, 5)
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


class WordTokenizer:
    """Ids of whole texts from a tokenizers file whose pieces never cross white space.

    Words between spaces and line ends are encoded once and kept, as little-endian
    32-bit ids; a text's ids are those of its words in order. Names of added tokens
    (``<|endoftext|>``) in a text become those tokens, as by the library's default.
    """

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.model = self.tokenizer.model
        self.reset()

    def reset(self) -> None:
        self.rows, self.known, self.pieces = Rows(), [], {}

    def piece(self, piece: str) -> bytes:
        """Ids of one piece of lower-case letters, straight from the model."""
        known = self.pieces.get(piece)
        if known is None:
            symbols = piece if piece.isascii() else "".join([SYMBOL[b] for b in piece.encode()])
            ids = [t.id for t in self.model.tokenize(symbols)]
            known = self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return known

    def learn(self, words: list[str]) -> None:
        """Encode new words. A word of Latin-1 letters, or one with a full stop or comma
        behind, is one piece or two whatever the normalizer does; the whole tokenizer
        encodes the others."""
        for word in words:
            core, tail = (word[:-1], word[-1]) if word[-1:] in ("." , ",") else (word, "")
            if core.isalpha() and max(core) < "\u0100":
                self.known.append(self.piece(core.lower()) + (self.piece(tail) if tail else b""))
            else:
                ids = self.tokenizer.encode(word, add_special_tokens=False).ids
                self.known.append(struct.pack(f"<{len(ids)}I", *ids))

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        for at in range(0, len(texts), BATCH):
            if len(self.rows) > CACHE:
                self.reset()
            found = []
            for text in texts[at : at + BATCH]:
                words = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
                found.append(list(map(self.rows.__getitem__, words)))
            new, self.rows.new = self.rows.new, []
            self.learn(new)
            for rows in found:
                yield b"".join(map(self.known.__getitem__, rows))


_tokenizers: dict[int, WordTokenizer] = {}


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the task that made them and their rank of its length there."""
    with open(tokenizer_file, encoding="utf-8") as f:
        content = f.read()
    json.loads(content)
    shared = docs.sparkSession.sparkContext.broadcast(content)  # a vocabulary: the same size for any corpus
    key = zlib.crc32(content.encode())
    id_type = dict(docs.dtypes)["doc_id"]
    names = ["piece", "start", "length", "ids_crc32", "task", "rank"] + ["ids"] * with_ids
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()] + [pa.list_(pa.uint32())] * with_ids
    schema = f"doc_id {id_type}, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT, task INT, rank BIGINT"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _tokenizers:
            _tokenizers[key] = WordTokenizer(shared.value)
        tokenizer, task = _tokenizers[key], TaskContext.get().partitionId()
        last, step = np.array([end], "<u4").tobytes(), 4 * capacity
        seen = [0] * (capacity + 1)
        for b in batches:
            of, rows = [], []
            for i, ids in enumerate(tokenizer.ids(b.column("text").to_pylist())):
                ids += last
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    n = len(part) // 4
                    row = (k, at // 4, n, zlib.crc32(part), task, seen[n])
                    seen[n] += 1
                    of.append(i)
                    rows.append((*row, np.frombuffer(part, "<u4").astype(np.int64)) if with_ids else row)
            values = zip(*rows, strict=True) if rows else [()] * len(names)
            cols = [pa.array(list(v), t) for v, t in zip(values, [*types[:6], *[pa.list_(pa.int64())] * with_ids], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(of, pa.int64())), *cols], names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids ARRAY<BIGINT>" * with_ids)


def packed(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``; ``with_ids`` adds its token ids."""
    stages = Stages(docs.sparkSession)
    rows = stages.write(pieces(docs, tokenizer_file, capacity, end, with_ids), "pieces", keep=True)
    counts = rows.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    counts = stages.write(counts.withColumn("before", F.coalesce(before, F.lit(0))), "piece-counts", keep=True)
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    table = plan(histogram, capacity)
    shared = docs.sparkSession.sparkContext.broadcast((table, (table[:, 0] << 42) + table[:, 1]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, keys = shared.value
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            rank = rank + b.column("before").to_numpy()
            at = np.searchsorted(keys, (length << 42) + rank, side="right") - 1
            got = table[at].reshape(-1, 5)
            out = b.drop_columns(["task", "rank", "before"])
            out = out.append_column("sequence_id", pa.array(got[:, 3] + rank - got[:, 1], pa.int64()))
            yield out.append_column("offset", pa.array(got[:, 4], pa.int64()))

    joined = rows.join(counts.drop("n"), ["task", "length"])
    cols = [c for c in rows.columns if c not in ("task", "rank")]
    joined = joined.select(*cols, "task", "rank", "before")
    schema = ", ".join(f"{c} {t}" for c, t in joined.dtypes if c in cols) + ", sequence_id BIGINT, offset BIGINT"
    return joined.mapInArrow(place, schema)


def sequences(pieces_with_ids: DataFrame) -> DataFrame:
    """The packed sequences themselves: at most a capacity of tokens each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces_with_ids.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
