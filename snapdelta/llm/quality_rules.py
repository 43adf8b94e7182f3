"""Quality rules: base counts per document, then robust multivariate outliers.

Every document gets four counts and a base rule. Documents that pass are compared
with their own language and source by minimum-covariance-determinant estimates of
location and scatter: of all halves of a group, that with the least determinant of its
scatter is sought by concentration steps (each keeps the share of documents nearest to
the current estimate and estimates again, which lowers the determinant) from several
deterministic starts: all documents, the nearest by the floors, and the nearest in each statistic
alone. Every start goes on until its determinant stops falling, and the least one
wins. A document is rejected if its Mahalanobis distance is beyond a chi-square quantile.

A concentration step is one aggregation, over the starts of all groups together: distances fall into
narrow bins, sums per group, start and bin are combined before the shuffle, and the nearest bins that
reach the share give the next estimate. Vectors are integers (thousandths), so sums are exact
and results do not depend on the order of rows. A group of a third of all rows
leaves each map task as a few hundred rows.

Null language or source is a group value of its own; a null or empty text has no
words and fails the base rule. A group with fewer than ``MIN_GROUP`` documents that
pass the base rule is judged by the estimate over its whole language, all sources
together; if the language has fewer too, by the estimate over all documents. So every
document that passes the base rule has a distance.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Stages, nested, unnested, words_of

SYMBOLS = "#*$%&|<>"
BLANK = "\t\n\x0b\x0c\r "
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5
DIMS = 4
#: Smallest standard deviation of each dimension: log word length, log symbols per
#: hundred characters, log duplicate lines, log of ten times the repeated share.
#: Most groups have no symbol and no duplicate line at all, so scatter needs a floor.
#: That of symbols is one in some 450 characters: alone they reject from about 2 % on.
#: The others are wide since clean documents repeat a line or two, and a fifth of their
#: words: these dimensions only add to the distance.
FLOORS = (0.06, 0.2, 0.5, 0.4)
#: Share of a group that estimates rest on: almost half of it may be junk.
SHARE = 0.5
#: A start ends when a step lowers its determinant by less than this share, or after so many steps.
LEAST_GAIN = 1e-3
MOST_STEPS = 12
MIN_GROUP = 30
TAIL = 1e-5


def repeated_words(words: list[str]) -> int:
    """Words covered by windows of five that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        key = key * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    starts = np.concatenate([order[1:][same], order[:-1][same]])
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.unique(starts)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """The five counts of one whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = words_of(text)
    lines = text.split("\n")
    dup = 0
    if len(set(lines)) != len(lines):
        seen: set[str] = set()
        for line in lines:
            if line.strip(BLANK):
                dup += line in seen
                seen.add(line)
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeated_words(words)


def with_counts(docs: DataFrame, text_col: str = "text", drop_text: bool = False) -> DataFrame:
    """``docs`` with the five counts as ``_<count>`` columns; one pass, no shuffle."""
    kept = [f for f in docs.schema.fields if not (drop_text and f.name == text_col)]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"_{c} BIGINT" for c in COUNTS])
    names = [f.name for f in kept]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [counts(t) for t in batch.column(text_col).to_pylist()]
            cols = list(zip(*rows, strict=True)) if rows else [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(c, pa.int64()) for c in cols],
                names=[*names, *[f"_{c}" for c in COUNTS]],
            )

    return docs.mapInArrow(add, schema)


def base_failed() -> Column:
    return (F.col("_n_words") < 10) | (100 * F.col("_n_repeat_words") > 20 * F.col("_n_words"))


def _vector() -> list[Column]:
    """The transformed statistics in thousandths; word length comes relative to its
    group's median, shrunk for short texts, whose mean says little."""
    n = F.greatest(F.col("_n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("_word_chars"), F.lit(1)).cast("double")
    length = (F.log(chars / n) - F.col("_median") / 200.0) * F.sqrt(n / (n + 100.0))
    raw = [
        length,
        F.log1p(100.0 * F.col("_n_symbols") / chars),
        F.log1p(F.col("_n_dup_lines").cast("double")),
        F.log1p(10.0 * F.col("_n_repeat_words") / n),
    ]
    return [F.round(1000 * c).cast("bigint").alias(f"_v{i}") for i, c in enumerate(raw)]


def _cdf(dof: int, x: float) -> float:
    """Chi-square distribution for even degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, dof // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def chi2_quantile(dof: int, p: float) -> float:
    low, high = 0.0, 200.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if _cdf(dof, mid) < p else (low, mid)
    return low


def _floor_matrix() -> np.ndarray:
    return np.diag([(1000 * f) ** 2 for f in FLOORS])


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(DIMS) for j in range(i, DIMS)]


def _distance() -> Column:
    """Squared Mahalanobis distance of the vector columns to the joined estimate."""
    d = [F.col(f"_v{i}") - F.col(f"_c{i}") for i in range(DIMS)]
    total = F.lit(0.0)
    for i, j in _pairs():
        total = total + (1 if i == j else 2) * F.col(f"_p{i}{j}") * d[i] * d[j]
    return F.greatest(total, F.lit(0.0))


def _starts() -> list[np.ndarray]:
    """Inverse scatters (around 0) that the searches start from: none, so that all documents
    count; the floors; each statistic alone."""
    floor = np.linalg.inv(_floor_matrix())
    return [np.zeros((DIMS, DIMS)), floor, *[np.diag(np.eye(DIMS)[i] * np.diag(floor)) for i in range(DIMS)]]


def _invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of each group's nearest rows to centre, inverse scatter and log determinant."""
    quantile = chi2_quantile(DIMS, SHARE)
    scale = SHARE / _cdf(DIMS + 2, quantile)
    for g in batches:
        if not len(g):
            continue
        n = g["n"].to_numpy(float)
        centre = np.stack([g[f"s{i}"].to_numpy(float) / n for i in range(DIMS)], 1)
        scatter = np.zeros((len(g), DIMS, DIMS))
        for i, j in _pairs():
            scatter[:, i, j] = scatter[:, j, i] = g[f"q{i}{j}"].to_numpy(float) / n - centre[:, i] * centre[:, j]
        scatter = scale * scatter + _floor_matrix()
        inverse = np.linalg.inv(scatter)
        out = {"_lang": g["_lang"], "_source": g["_source"], "_start": g["_start"], "_det": np.linalg.slogdet(scatter)[1]}
        out |= {f"_c{i}": centre[:, i] for i in range(DIMS)}
        out |= {f"_p{i}{j}": inverse[:, i, j] for i, j in _pairs()}
        yield pd.DataFrame(out)


ESTIMATE = "_lang STRING, _source STRING, _start INT, _det DOUBLE, " + ", ".join(
    [f"_c{i} DOUBLE" for i in range(DIMS)] + [f"_p{i}{j} DOUBLE" for i, j in _pairs()]
)


def _keyed(rows: DataFrame, lang: str, source: str) -> DataFrame:
    """Group values as text of one type: 'n' for null, 'v' before any other value."""
    tag = lambda c: F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(c).cast("string")))
    return rows.withColumns({"_lang0": tag(lang), "_source0": tag(source)})


def estimates(stages: Stages, counted: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per language and source with the median, centre and inverse scatter of the
    group that judges it: itself, its language or all documents."""
    rows = _keyed(counted, lang, source).filter(~base_failed())
    bin_ = F.round(200 * F.log(F.col("_word_chars") / F.col("_n_words"))).cast("int")
    hist = stages.write(rows.groupBy("_lang0", "_source0", bin_.alias("bin")).count(), "rules-hist")
    sizes = hist.groupBy("_lang0", "_source0").agg(F.sum("count").alias("size"))
    sizes = sizes.withColumn("in_lang", F.sum("size").over(Window.partitionBy("_lang0")))
    # Group values begin with 'n' or 'v', so these names are no group's.
    own, whole, every = (F.struct(a.alias("_lang"), b.alias("_source")) for a, b in (
        (F.col("_lang0"), F.col("_source0")), (F.col("_lang0"), F.lit("*")), (F.lit("*"), F.lit("*"))
    ))
    judge = F.when(F.col("size") >= MIN_GROUP, own).when(F.col("in_lang") >= MIN_GROUP, whole).otherwise(every)
    groups = stages.write(sizes.select("_lang0", "_source0", judge.alias("judge")), "rules-judges")
    groups = groups.select("_lang0", "_source0", "judge.*")
    # Documents count in each estimate that covers them and judges somebody.
    parts = sizes.select("_lang0", "_source0", F.explode(F.array(own, whole, every)).alias("part")).select("_lang0", "_source0", "part.*")
    parts = parts.join(groups.select("_lang", "_source").distinct(), ["_lang", "_source"])
    parts = stages.write(parts, "rules-parts")
    medians = (
        hist.join(parts, ["_lang0", "_source0"])
        .groupBy("_lang", "_source")
        .agg(F.percentile("bin", F.lit(0.5), F.col("count")).alias("_median"))
    )
    medians = stages.write(medians, "rules-medians")
    groups = groups.join(medians, ["_lang", "_source"])

    vectors = rows.join(parts.join(medians, ["_lang", "_source"]), ["_lang0", "_source0"]).select("_lang", "_source", *_vector())
    vectors = stages.write(vectors, "rules-vectors")
    estimate = least_determinant(stages, vectors, medians.select("_lang", "_source"))
    return groups.join(estimate, ["_lang", "_source"]).drop("_lang", "_source")


def least_determinant(stages: Stages, vectors: DataFrame, groups: DataFrame) -> DataFrame:
    """Centre and inverse scatter of each group's half with the least determinant found."""
    key = ["_lang", "_source", "_start"]
    columns = [*[f"_c{i}" for i in range(DIMS)], *[f"_p{i}{j}" for i, j in _pairs()]]
    starts = [
        F.struct(F.lit(n).alias("_start"), F.lit(float("inf")).alias("_det"), F.lit(False).alias("_done"),
                 *[F.lit(0.0).alias(f"_c{i}") for i in range(DIMS)], *[F.lit(float(p[i, j])).alias(f"_p{i}{j}") for i, j in _pairs()])
        for n, p in enumerate(_starts())
    ]
    current = groups.select("_lang", "_source", F.inline(F.array(*starts)))
    for step in range(MOST_STEPS):
        going = current.filter("NOT _done")
        near = vectors.join(going.drop("_det", "_done"), ["_lang", "_source"]).withColumn(
            "bin", F.floor(64 * F.log2(1 + _distance())).cast("int")
        )
        sums = [F.count("*").alias("n"), *[F.sum(f"_v{i}").alias(f"s{i}") for i in range(DIMS)]]
        sums += [F.sum(F.col(f"_v{i}") * F.col(f"_v{j}")).alias(f"q{i}{j}") for i, j in _pairs()]
        bins = near.groupBy(*key, "bin").agg(*sums)
        group = Window.partitionBy(*key)
        bins = bins.withColumns({
            "before": F.coalesce(F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "size": F.sum("n").over(group),
        })
        nearest = bins.filter(F.col("before") < SHARE * F.col("size")).groupBy(*key)
        cols = ["n", *[f"s{i}" for i in range(DIMS)], *[f"q{i}{j}" for i, j in _pairs()]]
        summed = nearest.agg(*[F.sum(c).cast("double").alias(c) for c in cols])
        new = summed.mapInPandas(_invert, ESTIMATE)
        # The first two steps only lead from the start to a half; from then on the least one stays.
        fell = F.col("new._det") < F.col("old._det") - LEAST_GAIN if step > 1 else F.lit(True)
        pick = lambda c: F.when(fell, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)  # noqa: B023, E731
        moved = going.alias("old").join(new.alias("new"), key).select(
            *[F.col(f"old.{c}") for c in key], pick("_det"), (~fell).alias("_done"), *[pick(c) for c in columns]
        )
        current = stages.write(moved.unionByName(current.filter("_done")), f"rules-step{step}")
        if current.filter("NOT _done").isEmpty():
            break
    best = current.groupBy("_lang", "_source").agg(F.min_by(F.struct(*columns), F.struct("_det", "_start")).alias("e"))
    return best.select("_lang", "_source", *[F.col(f"e.{c}").alias(c) for c in columns])


def judged(counted: DataFrame, estimate: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``counted`` with ``_base_failed``, ``_distance`` (null where a group has no document that passes
    the base rule) and ``_kept``."""
    columns = counted.columns
    rows = _keyed(counted, lang, source).join(estimate, ["_lang0", "_source0"], "left")
    rows = rows.select("*", *_vector())
    rows = rows.withColumns({"_base_failed": base_failed(), "_distance": F.when(F.col("_c0").isNotNull(), _distance())})
    limit = chi2_quantile(DIMS, 1 - TAIL)
    kept = ~F.col("_base_failed") & (F.col("_distance") <= limit)
    return rows.withColumn("_kept", kept).select(*columns, "_base_failed", "_distance", "_kept")


def quality_rules(docs: DataFrame, text_col: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts and verdicts of all documents: ``doc_id``, the counts, ``base_failed``,
    ``kept`` and the squared distance. Repeated rows are judged each on its own."""
    slim = docs.select("doc_id", text_col, lang, source)
    with Stages(docs.sparkSession) as stages:
        counted = stages.write(with_counts(slim, text_col, drop_text=True), "rules-counts", keep=True)
        estimate = stages.write(estimates(stages, counted, lang, source), "rules-estimate", keep=True)
    out = judged(counted, estimate, lang, source)
    return out.select(
        "doc_id",
        *[F.col(f"_{c}").alias(c) for c in COUNTS],
        F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
        F.col("_distance").alias("distance"),
    )


def keep_good(docs: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents kept, all columns. Statistics come from a first pass over all
    texts; a second pass counts again rather than shuffle texts to their verdicts."""
    with Stages(docs.sparkSession) as stages:
        counted = stages.write(with_counts(docs.select("text", lang, source), drop_text=True), "rules-counts")
        estimate = stages.write(estimates(stages, counted, lang, source), "rules-estimate", keep=True)
    rows = judged(with_counts(nested(docs, lang, source)), estimate, lang, source)
    return unnested(rows.filter("_kept"), docs.columns)
