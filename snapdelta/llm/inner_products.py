"""Exact search for the largest inner products, by a three-phase uniform threshold.

A score is a sum over ``parts`` slices of the components. Vectors are stored in blocks, a
row per block and slice, so that a slice's scores are made without the other slices. Blocks
of candidates and of queries meet in cells of bounded size, and each cell and
slice is a list of local scores, from which three phases take as little as is safe:

1. *Gather.* Each list gives the first entries of every query. Their full scores are
   resolved, and the k-th largest is the query's cutoff: a true lower bound of its k-th best
   score. (Inner products may be negative, so a missing slice cannot count as zero, as it does
   where sums only grow; hence full scores.)
2. *Collect.* The cutoff goes to all lists, and each gives every entry whose local score is at
   least the cutoff divided by the number of slices. A candidate that no list gives stays
   below that share in each slice, and so below the cutoff. Entries given by all slices are
   complete; others have an upper bound. The k-th complete score is the second cutoff.
3. *Resolve.* Incomplete candidates whose bound reaches the second cutoff get their full score
   in the cell that holds both vectors.

All arithmetic is on whole numbers: matrix products in doubles where every sum stays below
2^53, else in 64 bits or Python's integers. Nothing passes through the driver but counts.

Copies: identical rows count once; of equal vectors only the ``k + 1`` smallest ids are
candidates, since no other can be among the first ``k``. So a vector that a third of all
rows share adds that many entries. Defined results: vectors that are null, empty, of
another length than most, or hold null or non-finite components take no part, nor do rows without an id;
zero vectors do. An id with several vectors is one query for each; a row is never found by a
query of its own id. A score beyond a long raises an ``OverflowError``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Stages
from .integers import finite_vectors, floors, peak

PARTS = 2
BLOCK = 2048
#: Most blocks of queries and of candidates in a cell: 16 and 32 MB of 64 components.
QUERY_BLOCKS, BLOCKS = 16, 32
#: Entries per query that the lists of a slice give together in the first phase, at least.
GATHER = 64
#: Queries whose local scores with all vectors of a cell are held at a time.
STEP = 64
ENTRIES = "q BIGINT, query_id BIGINT, c BIGINT, vec_id BIGINT, score BIGINT"


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``."""
    most = peak(a) * peak(b) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2**63:
        return a @ b.T
    out = a.astype(object) @ b.astype(object).T
    if out.size and peak(out) >= 2**63:
        raise OverflowError("an inner product is beyond what a long holds")
    return out.astype(np.int64)


def _pack(batches: Iterator[pa.RecordBatch], parts: int, side: str) -> Iterator[pa.RecordBatch]:
    """Blocks numbered across tasks; row ``i`` of block ``b`` is number ``b * BLOCK + i``."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 24
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(at, BLOCK)
            m = floors(rows.column("v"), 1)
            ids = pa.array([rows.column("vec_id").to_pylist()] * parts, pa.list_(pa.int64()))
            data = [np.ascontiguousarray(x).tobytes() for x in np.array_split(m, parts, axis=1)]
            yield pa.RecordBatch.from_pydict(
                {
                    "side": pa.array([side] * parts),
                    "block": pa.array([number] * parts, pa.int64()),
                    "part": pa.array(range(parts), pa.int32()),
                    "ids": ids,
                    "m": pa.array(data, pa.binary()),
                }
            )
            number += 1


PACKED = "side STRING, block BIGINT, part INT, ids ARRAY<BIGINT>, m BINARY"


def _side(cell: pa.Table, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, ids and components (slices side by side) of the queries or candidates of a cell."""
    blocks: dict[int, list] = {}
    for row in cell.to_pylist():
        if row["side"] == side:
            blocks.setdefault(row["block"], []).append(row)
    numbers, ids, m = [], [], []
    for b in sorted(blocks):
        slices = sorted(blocks[b], key=lambda row: row["part"])
        n = len(slices[0]["ids"])
        numbers.append(b * BLOCK + np.arange(n))
        ids.append(np.array(slices[0]["ids"], np.int64))
        m.append(np.hstack([np.frombuffer(row["m"], np.int64).reshape(n, -1) for row in slices]))
    if not blocks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0), np.int64)
    return np.concatenate(numbers), np.concatenate(ids), np.vstack(m)


def _entries(q, qid, c, cid, score) -> pa.Table:
    names = ("q", "query_id", "c", "vec_id", "score")
    return pa.table({n: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for n, x in zip(names, (q, qid, c, cid, score), strict=True)})


def _local(cell: pa.Table, pick) -> pa.Table:
    """Entries of one list; ``pick`` gets the local scores of some queries, which pairs may count
    and the queries' numbers, and gives rows and columns of the entries wanted."""
    q, qid, a = _side(cell, "query")
    c, cid, b = _side(cell, "candidate")
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    if len(q) and len(c):
        for at in range(0, len(q), STEP):
            rows = slice(at, at + STEP)
            score = products(a[rows], b)
            i, j = pick(score, qid[rows][:, None] != cid, q[rows])
            for x, values in zip(out, (q[rows][i], qid[rows][i], c[j], cid[j], score[i, j]), strict=True):
                x.append(values)
    return _entries(*out)


def first_entries(cell: pa.Table, n: int) -> pa.Table:
    """The ``n`` largest local scores of every query."""

    def pick(score, allowed, _):
        width = score.shape[1]
        rank = np.where(allowed, score, np.iinfo(np.int64).min)
        best = np.argpartition(rank, width - n, axis=1)[:, width - n :] if n < width else np.tile(np.arange(width), (len(rank), 1))
        i = np.repeat(np.arange(len(rank)), best.shape[1])
        j = best.ravel()
        good = allowed[i, j]
        return i[good], j[good]

    return _local(cell, pick)


def entries_above(cell: pa.Table, cutoffs: pa.Table, parts: int) -> pa.Table:
    """Every local score that is at least its query's share of the cutoff; all, if the query has none."""
    of = dict(zip(cutoffs.column("q").to_pylist(), cutoffs.column("cutoff").to_pylist(), strict=True))

    def pick(score, allowed, q):
        # parts * s >= cutoff for whole numbers: s >= ceil(cutoff / parts)
        least = np.array([-(-of[x] // parts) if of.get(x) is not None else np.iinfo(np.int64).min for x in q.tolist()], np.int64)
        return np.nonzero(allowed & (score >= least[:, None]))

    return _local(cell, pick)


def full_scores(cell: pa.Table, wanted: pa.Table) -> pa.Table:
    """The full scores of the pairs wanted, in the cell that holds both vectors."""
    q, qid, a = _side(cell, "query")
    c, cid, b = _side(cell, "candidate")
    i = np.searchsorted(q, wanted.column("q").to_numpy())
    j = np.searchsorted(c, wanted.column("c").to_numpy())
    kind = np.int64 if peak(a) * peak(b) * max(1, a.shape[1]) < 2**63 else object
    score = [(a[i[s : s + 4096]].astype(kind) * b[j[s : s + 4096]].astype(kind)).sum(1) for s in range(0, len(i), 4096)]
    if kind is object and any(peak(s) >= 2**63 for s in score):
        raise OverflowError("an inner product is beyond what a long holds")
    return _entries([q[i]], [qid[i]], [c[j]], [cid[j]], [s.astype(np.int64) for s in score])


def _kth(scores: DataFrame, k: int, name: str) -> DataFrame:
    """The k-th largest score of every query that has that many."""
    order = Window.partitionBy("q").orderBy(F.desc("score"))
    ranked = scores.select("q", "score", F.row_number().over(order).alias("n")).filter(F.col("n") <= k)
    return ranked.filter(F.col("n") == k).select("q", F.col("score").alias(name))


def largest_products(
    rows: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    parts: int = PARTS,
    gather: int = GATHER,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of each row that ``is_query``
    selects with all rows of other ids, ties to the smaller id. Components are scaled and rounded down."""
    spark = rows.sparkSession
    cell = ["g", "r", "part"]
    with Stages(spark) as stages:
        usable = finite_vectors(rows, vector_col, vec_id=F.col(f"`{id_col}`").cast("bigint"), asked=is_query)
        v = F.transform("v", lambda x: F.floor(x * scale).cast("double"))  # equal when rounded is equal
        distinct = usable.filter("vec_id IS NOT NULL").groupBy("vec_id", v.alias("v")).agg(F.max("asked").alias("asked"))
        first = Window.partitionBy("v").orderBy("vec_id")
        held = distinct.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
        blocks = [
            stages.write(d.select("vec_id", "v").mapInArrow(lambda b, s=side: _pack(b, parts, s), PACKED), side)
            for side, d in (("candidate", held), ("query", distinct.filter("asked")))
        ]
        candidates, queries = blocks
        n_queries, n_blocks = (b.filter("part = 0").count() for b in (queries, candidates))
        if not n_queries or not n_blocks:
            return spark.createDataFrame([], "query_id BIGINT, rank INT, vec_id BIGINT, score BIGINT")
        groups = math.ceil(n_queries / QUERY_BLOCKS)
        ranges = max(math.ceil(n_blocks / BLOCKS), min(n_blocks, spark.sparkContext.defaultParallelism))
        of = lambda block, n: F.pmod(F.xxhash64(block), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        cells = candidates.withColumn("r", of("block", ranges)).withColumn("g", every(groups)).unionByName(
            queries.withColumn("g", of("block", groups)).withColumn("r", every(ranges))
        )

        def resolved(pairs: DataFrame) -> DataFrame:
            block = lambda x: F.floor(F.col(x) / BLOCK)
            placed = pairs.select("q", "c", of(block("q"), groups).alias("g"), of(block("c"), ranges).alias("r"))
            return cells.groupBy("g", "r").cogroup(placed.groupBy("g", "r")).applyInArrow(full_scores, ENTRIES)

        each = max(2, math.ceil(k / max(1, ranges - 1)), math.ceil(gather / ranges))
        gathered = cells.groupBy(*cell).applyInArrow(lambda t: first_entries(t, each), ENTRIES)
        cutoffs = stages.write(_kth(resolved(gathered.select("q", "c").distinct()), k, "cutoff"), "cutoffs")
        asked = queries.filter("part = 0").select("block", F.posexplode("ids").alias("i", "id"))
        asked = asked.select((F.col("block") * BLOCK + F.col("i")).alias("q"), of("block", groups).alias("g"))
        sent = asked.join(cutoffs, "q", "left").withColumn("r", every(ranges)).withColumn("part", every(parts))
        above = cells.groupBy(*cell).cogroup(sent.groupBy(*cell)).applyInArrow(lambda t, u: entries_above(t, u, parts), ENTRIES)
        summed = above.groupBy("q", "query_id", "c", "vec_id").agg(F.sum("score").alias("score"), F.count("*").alias("known"))
        seen = stages.write(summed, "entries")
        complete = seen.filter(F.col("known") == parts).drop("known")
        second = _kth(complete, k, "second")
        open_ = seen.filter(F.col("known") < parts).join(cutoffs, "q").join(second, "q", "left")
        # A slice that gave no entry is below its share: at most ceil(cutoff / parts) - 1.
        share = F.ceil(F.col("cutoff").cast("decimal(38,0)") / parts) - 1
        bound = F.col("score") + (F.lit(parts) - F.col("known")) * share
        left = open_.filter(bound >= F.coalesce(F.greatest("cutoff", "second"), F.col("cutoff")))
        found = complete.unionByName(resolved(left.select("q", "c")))
        order = Window.partitionBy("q", "query_id").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return stages.write(ranked.select("query_id", "rank", "vec_id", "score"), "largest", keep=True)
