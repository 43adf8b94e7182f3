"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each table projects vectors on Gaussian directions and cuts every projection into
cells of equal width; a bucket is a combination of cells. A neighbour's projection
differs from the query's by a Gaussian whose deviation is its distance, which gives
each bucket a chance to hold a near neighbour. A query visits its own bucket and
perturbed ones in order of that chance until the chances add up to ``TARGET`` for the
tables together (a neighbour is missed if every table misses it); candidates of all tables
are merged and ranked by exact distance.

Directions are fixed by a seed; cell widths are fitted on a bounded sample (``SAMPLE``
vectors, by a hash of the id). The distance that gives the chances is the query's own:
that of its k-th nearest in the sample, which its k-th neighbour among all vectors
cannot exceed. So a dense cluster, whatever its share, leaves the probes of other
queries as they are. Every vector is indexed. Buckets are searched in blocks of bounded numbers of vectors and queries,
and a block leaves at most ``k`` rows per query, so neither a full bucket nor a large
query set meets in one task, and no pair leaves the task that measured it. A vector goes to as many
places as queries visit its bucket, in thousands; one that nobody visits goes nowhere. Queries
that find fewer than ``k`` neighbours visit every bucket in a second pass.

Vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part, nor do rows without an id. Identical rows count once. Of
equal vectors only the ``k + 1`` smallest ids can be among the nearest, so only they
are indexed: a vector that a third of all rows share is that many rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Stages

TABLES = 2
HASHES = 4
CELLS = 16
TARGET = 0.95
SAMPLE = 2000
#: Share of the sample whose distances cells are wide enough for.
NEAR = 0.9
VECTORS, QUERIES = 4096, 1024
_erf = np.vectorize(math.erf, otypes=[float])


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    v = F.col("v")
    rows = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (most["n"] if most else 0))


class Index:
    """Directions, cell edges and the sample that bounds each query's distances."""

    def __init__(self, ids: np.ndarray, sample: np.ndarray, k: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.directions = rng.standard_normal((TABLES, sample.shape[1], HASHES))
        self.ids, self.sample, self.k = ids, sample, k
        at = np.einsum("nd,tdh->tnh", sample, self.directions)
        self.low, span = at.min(1), at.max(1) - at.min(1)
        self.least = 1e-9 * float(span.max()) + 1e-300
        # Wide enough for most queries; narrower cells only mean more probes for the others.
        near = max(float(np.quantile(self.reach(ids, sample), NEAR)), self.least)
        self.cells = np.clip(np.ceil(span / (1.5 * near)), 1, CELLS).astype(int)
        self.width = np.maximum(span / self.cells, 1e-300)

    def reach(self, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Upper bound of each vector's distance to its k-th neighbour: the distance to
        the farthest of ``k`` others near it in the sample."""
        out = np.full(len(vectors), self.least)
        n = min(self.k, len(self.sample) - 1)
        for rows in np.array_split(np.arange(len(vectors)), len(vectors) // 256 + 1) if n > 0 else ():
            v = vectors[rows]
            rough = (v**2).sum(1)[:, None] + (self.sample**2).sum(1) - 2 * v @ self.sample.T
            rough[ids[rows][:, None] == self.ids] = np.inf
            for i, best in zip(rows, np.argpartition(rough, n - 1, axis=1)[:, :n], strict=True):
                out[i] = max(self.least, float(np.sqrt(((self.sample[best] - vectors[i]) ** 2).sum(1).max())))
        return out

    def buckets(self, vectors: np.ndarray, table: int) -> np.ndarray:
        at = (vectors @ self.directions[table] - self.low[table]) / self.width[table]
        cell = np.clip(np.floor(at), 0, self.cells[table] - 1).astype(np.int64)
        return np.ravel_multi_index(tuple(cell.T), tuple(self.cells[table]))

    def probes(self, vector: np.ndarray, reach: float, table: int, target: float) -> np.ndarray:
        """Buckets in order of their chance to hold a neighbour at distance ``reach``,
        until the chances add up to ``target``."""
        chance = np.ones(1)
        for j, at in enumerate(vector @ self.directions[table]):
            edge = self.low[table, j] + self.width[table, j] * np.arange(self.cells[table, j] + 1)
            edge[0], edge[-1] = -np.inf, np.inf
            part = np.diff(0.5 * (1 + _erf((edge - at) / (reach * 2**0.5))))
            chance = np.outer(chance, part).ravel()
        order = np.argsort(-chance, kind="stable")
        if target >= 1:
            return order
        return order[: int(np.searchsorted(np.cumsum(chance[order]), target)) + 1]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _nearest(queries: pd.DataFrame, vectors: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest vectors of each query in one block."""
    if not len(queries) or not len(vectors):
        return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    q, v = _matrix(queries["v"]), _matrix(vectors["v"])
    qid, vid = queries["query_id"].to_numpy(), vectors["vec_id"].to_numpy()
    rough = (q**2).sum(1)[:, None] + (v**2).sum(1) - 2 * q @ v.T
    rough[qid[:, None] == vid] = np.inf
    n = min(k, len(vid))
    edge = np.partition(rough, n - 1, axis=1)[:, n - 1]
    slack = 1e-9 * (1 + (q**2).sum(1) + (v**2).sum(1).max())
    out_q, out_v, out_s = [], [], []
    for i in range(len(qid)):
        at = np.flatnonzero((rough[i] <= edge[i] + slack[i]) & np.isfinite(rough[i]))
        score = np.sqrt(((v[at] - q[i]) ** 2).sum(1))
        best = np.lexsort((vid[at], score))[:k]
        out_q.append(np.full(len(best), qid[i]))
        out_v.append(vid[at][best])
        out_s.append(score[best])
    return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})


def nearest(rows: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", target: float = TARGET) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows that ``is_query`` (a column) selects."""
    with Stages(rows.sparkSession) as stages:
        return _nearest_of(stages, rows, is_query, k, id_col, vector_col, target)


def _nearest_of(stages: Stages, rows: DataFrame, is_query, k: int, id_col: str, vector_col: str, target: float) -> DataFrame:
    spark = rows.sparkSession
    schema = "query_id BIGINT, rank INT, vec_id BIGINT, score DOUBLE"
    rows = usable(rows, id_col, vector_col)
    # Only what can be among the nearest: the smallest ids of equal vectors.
    first = Window.partitionBy("v").orderBy("vec_id")
    distinct = rows.groupBy("vec_id", "v").agg(F.lit(1).alias("one")).drop("one")
    vectors = distinct.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1).drop("n")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"vec_id": b["vec_id"], "v": [np.asarray(x, np.float64).tobytes() for x in b["v"]]})

    base = stages.write(vectors.mapInPandas(pack, "vec_id BIGINT, v BINARY"), "vectors")
    asked = stages.write(distinct.filter(is_query).mapInPandas(pack, "vec_id BIGINT, v BINARY"), "queries")
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    n_queries = asked.count()
    if not len(sample) or not n_queries:
        return spark.createDataFrame([], schema)
    index = Index(sample["vec_id"].to_numpy(), _matrix(sample["v"]), k)
    shared = spark.sparkContext.broadcast(index)

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                m = _matrix(b["v"])
                for t in range(TABLES):
                    yield pd.DataFrame({"table": t, "bucket": shared.value.buckets(m, t), "vec_id": b["vec_id"], "v": b["v"]})

    stored = base.mapInPandas(store, "table INT, bucket BIGINT, vec_id BIGINT, v BINARY")
    # At most TABLES * CELLS ** HASHES buckets, and only how many blocks each has.
    blocks = stages.write(
        stored.groupBy("table", "bucket").agg(F.ceil(F.count("*") / VECTORS).cast("int").alias("blocks")), "blocks"
    )

    def search(which: DataFrame, target: float, name: str) -> DataFrame:
        each = 1 - (1 - target) ** (1 / TABLES)

        def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if not len(b):
                    continue
                m = _matrix(b["v"])
                reach = shared.value.reach(b["vec_id"].to_numpy(), m)
                for qid, row, r in zip(b["vec_id"], m, reach, strict=True):
                    for t in range(TABLES if target < 1 else 1):
                        yield pd.DataFrame({"table": t, "bucket": shared.value.probes(row, r, t, each), "query_id": qid})

        probes = which.mapInPandas(visit, "table INT, bucket BIGINT, query_id BIGINT")
        probes = stages.write(probes, f"probes{name}")
        # Buckets that exist and are visited: blocks of their vectors, parts of their queries.
        visited = probes.groupBy("table", "bucket").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
        meeting = stages.write(blocks.join(visited, ["table", "bucket"]), f"meeting{name}")
        keys = ["table", "bucket", "block", "part"]
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        vectors = which.select(F.col("vec_id").alias("query_id"), "v").distinct()
        part = F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int").alias("part")
        asking = probes.join(meeting, ["table", "bucket"]).select("table", "bucket", "query_id", part, every(F.col("blocks")).alias("block"))
        probes = asking.join(vectors, "query_id").select(*keys, "query_id", "v")
        block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block")
        held = stored.join(meeting, ["table", "bucket"]).select("table", "bucket", block, "vec_id", "v", every(F.col("parts")).alias("part"))
        found = probes.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(
            lambda q, v: _nearest(q, v, k), "query_id BIGINT, vec_id BIGINT, score DOUBLE"
        )
        return found.distinct()

    found = stages.write(search(asked, target, "0"), "found")
    total = base.count()
    short = found.groupBy("query_id").count().filter(F.col("count") >= min(k, total - 1)).select(F.col("query_id").alias("vec_id"))
    missing = stages.write(asked.join(short, "vec_id", "left_anti"), "missing")
    if not missing.isEmpty():
        found = found.unionByName(search(missing, 1.0, "1")).distinct()
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return stages.write(ranked.select("query_id", "rank", "vec_id", "score"), "nearest", keep=True)
