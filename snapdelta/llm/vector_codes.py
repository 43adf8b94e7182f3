"""Vector compression to one code byte per part, by dictionaries of each dimension's values.

Components become whole numbers, vectors are cut into equal consecutive parts, and every
part is replaced by its nearest entry of that part position's codebook. Codebooks start
from the vectors of the smallest ids and are moved ``rounds`` times to the floor of the
mean of the parts they stand for.

Vectors are stored once in blocks: for each dimension the distinct values of the block
and, for each vector, the number of its value. To measure a block, the squared
differences of every distinct value to all entries are tabulated per dimension, and the
distance of a part is a sum of rows gathered from these tables by value number. No
vector is multiplied or squared by itself, so the arithmetic grows with the distinct values,
and the rest is gathers and adds of whole numbers, which are exact: in 32 or 64 bits
where the largest distance of the block fits, else in Python's integers.

A round is one pass over the blocks. Its tasks leave a count and sums per entry, which
Spark adds up per entry; the driver holds the codebooks only (``entries`` vectors).

Defined results: rows whose vector is null, empty or holds null or non-finite components
are dropped, as are those of another length than most; the length must be a multiple of
``parts``. Repeated rows are kept, each with its own result; an id that occurs twice starts
two entries, in order of the vectors. A null id comes after all others. With fewer vectors than
``entries`` the codebooks are smaller. No row left: an empty result. Errors beyond a long
raise an ``OverflowError``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages
from .integers import finite_vectors, floors, peak

BLOCK = 4096
#: Rows measured at a time: their distances to all entries stay in the cache.
STEP = 512


def block(numbers: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct values of each dimension, and the numbers of the vectors' values (dimension by row)."""
    found = [np.unique(column, return_inverse=True) for column in numbers.T]
    return [v for v, _ in found], np.array([i for _, i in found], np.uint16)


def nearest_entries(values: list[np.ndarray], codes: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties: the lowest) of one part and the squared distance to it.
    ``values`` and ``codes`` are the part's dimensions of a block; ``book`` is entry by dimension."""
    reach = max(map(peak, values), default=0) + peak(book)
    most = len(values) * reach * reach
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
    tables = [(v.astype(kind)[:, None] - book[:, d].astype(kind)[None, :]) ** 2 for d, v in enumerate(values)]
    best, error = [], []
    for at in range(0, codes.shape[1], STEP):
        part = codes[:, at : at + STEP]
        total = tables[0][part[0]]
        for table, of in zip(tables[1:], part[1:], strict=True):
            total += table[of]
        entry = total.argmin(1)
        best.append(entry)
        error.append(total[np.arange(len(entry)), entry])
    return np.concatenate(best), np.concatenate(error)


def _pack(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            part = b.slice(at, BLOCK)
            values, codes = block(floors(part.column("v"), scale))
            yield pa.RecordBatch.from_pydict(
                {
                    "ids": pa.array([part.column("id").to_pylist()], pa.list_(pa.int64())),
                    "labels": pa.array([part.column("label").to_pylist()], pa.list_(pa.string())),
                    "sizes": pa.array([[len(v) for v in values]], pa.list_(pa.int32())),
                    "dictionary": pa.array([np.concatenate(values).tobytes()], pa.binary()),
                    "codes": pa.array([codes.tobytes()], pa.binary()),
                }
            )


BLOCKS = "ids ARRAY<BIGINT>, labels ARRAY<STRING>, sizes ARRAY<INT>, dictionary BINARY, codes BINARY"


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[np.ndarray], np.ndarray]]:
    for b in batches:
        for row in b.to_pylist():
            values = np.split(np.frombuffer(row["dictionary"], np.int64), np.cumsum(row["sizes"])[:-1])
            yield row, values, np.frombuffer(row["codes"], np.uint16).reshape(len(values), -1)


def _parts(values: list, codes: np.ndarray, books: np.ndarray) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray]]:
    """Each part of a block: its number, dimensions, nearest entries and squared distances."""
    width = books.shape[2]
    for p, book in enumerate(books):
        dims = slice(p * width, (p + 1) * width)
        yield p, dims, *nearest_entries(values[dims], codes[dims], book)


def _sums(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a task's vectors add to every entry: a count, and a sum per position."""
    parts, entries, width = books.shape
    counts = np.zeros((parts, entries), np.int64)
    sums = np.zeros(books.shape, object)
    for _, values, codes in _unpack(batches):
        for p, dims, best, _ in _parts(values, codes, books):
            order = np.argsort(best, kind="stable")
            used, first = np.unique(best[order], return_index=True)
            counts[p] += np.bincount(best, minlength=entries)
            for j, d in enumerate(range(dims.start, dims.stop)):
                v = values[d] if peak(values[d]) < 2**50 else values[d].astype(object)
                sums[p, used, j] += np.add.reduceat(v[codes[d][order]], first).astype(object)
    part, entry = np.nonzero(counts)
    yield pa.RecordBatch.from_pydict(
        {
            "part": pa.array(part, pa.int32()),
            "entry": pa.array(entry, pa.int32()),
            "n": pa.array(counts[part, entry], pa.int64()),
            "s": pa.array([[Decimal(int(x)) for x in sums[p, e]] for p, e in zip(part, entry, strict=True)], pa.list_(pa.decimal128(38, 0))),
        }
    )


def _codes(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    for row, values, codes in _unpack(batches):
        found = list(_parts(values, codes, books))
        error = np.sum([e.astype(object) for *_, e in found], axis=0)
        code = np.array([b for _, _, b, _ in found], np.uint8).T
        yield pa.RecordBatch.from_pydict(
            {
                "id": pa.array(row["ids"], pa.int64()),
                "label": pa.array(row["labels"], pa.string()),
                "code": pa.array([c.tobytes().hex() for c in code], pa.string()),
                "error": pa.array([int(e) for e in error], pa.int64()),
            }
        )


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal: by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
) -> tuple[DataFrame, np.ndarray]:
    """``id, label, code, error, label_error`` per vector (labels as text) and the codebooks,
    part by entry by position. ``label_error`` is the error summed over equal labels, nulls together."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte")
    spark = rows.sparkSession
    labels = F.col(f"`{label_col}`").cast("string")
    usable = finite_vectors(rows, vector_col, id=F.col(f"`{id_col}`").cast("bigint"), label=labels)
    result = "id BIGINT, label STRING, code STRING, error BIGINT"
    with Stages(spark) as stages:
        first = usable.select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(entries).toArrow()
        if not first.num_rows:
            return spark.createDataFrame([], f"{result}, label_error BIGINT"), np.zeros((parts, 0, 0), np.int64)
        start = floors(first.column("v").combine_chunks(), scale)
        if start.shape[1] % parts:
            raise ValueError(f"vectors of {start.shape[1]} components cannot be cut into {parts} equal parts")
        books = start.reshape(len(start), parts, -1).swapaxes(0, 1).copy()
        blocks = stages.write(usable.mapInArrow(lambda b: _pack(b, scale), BLOCKS), "blocks")
        for _ in range(rounds):
            shared = spark.sparkContext.broadcast(books)
            added = blocks.mapInArrow(lambda b, s=shared: _sums(b, s.value), "part INT, entry INT, n BIGINT, s ARRAY<DECIMAL(38,0)>")
            total = added.groupBy("part", "entry").agg(
                F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[j]) for j in range(books.shape[2])]).alias("s")
            )
            books = books.copy()
            for r in total.collect():  # an entry each
                books[r["part"], r["entry"]] = [int(x) // r["n"] for x in r["s"]]
            shared.unpersist()
        shared = spark.sparkContext.broadcast(books)
        coded = stages.write(blocks.mapInArrow(lambda b: _codes(b, shared.value), result), "codes", keep=True)
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).drop("of"), books
