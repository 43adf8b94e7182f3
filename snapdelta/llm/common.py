"""Small helpers the operators share: words, text keys, staged tables."""

from __future__ import annotations

import contextlib
import re
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, new_path

#: Words of the contracts: everything between ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Characters at which ``str.split`` also cuts.
OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per application, as ``--py-files`` would:
    operators' functions import it wherever their tasks run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="package-")) / package.name  # Spark copies it from the driver
    spark.sparkContext.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
    _shipped.add(app)


def words_of(text: str) -> list[str]:
    """Words between ASCII white space; other Unicode spaces belong to words."""
    return WORD.findall(text) if OTHER_SPACE.search(text) else text.split()


def text_key(col: str | Column) -> Column:
    """128-bit key of a text, so that equal texts are one unit of work; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))))


def remainder(col: str, n: int) -> Column:
    """crc32 of an id as text modulo ``n``; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def nested(docs: DataFrame, *also: str) -> DataFrame:
    """The text, the columns of ``also`` and a struct of all but the text, so that an
    operator's own columns cannot clash with those of the documents."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"] or [F.lit(None).alias("none")]
    return docs.select(F.struct(*rest).alias("_row"), "text", *also)


def unnested(rows: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The documents' columns again, those of ``new`` replaced."""
    own = {"text": F.col("text")} | new
    return rows.select(*[(own[c] if c in own else F.col("_row").getField(c)).alias(c) for c in columns])


class Stages:
    """Tables written to the shared folder to cut a plan, removed again.

    A table survives lost executors, unlike cached blocks. ``write`` also lets
    Spark drop the shuffle files of the job that made it. Use as a context
    manager for everything but the table the result reads; that one is left
    to ``spark.cleaner`` of the shared folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def write(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        path = new_path(self.spark, name)
        if not keep:
            self.paths.append(path)
        with shuffle_cleanup(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            delete_path(self.spark, path)


@contextlib.contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Shuffle files go when the job that wrote them is done, not at the next garbage collection."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD6E8FEB86659FD93)


def word_grams(words: list[str], sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed byte n-grams of words, edges marked by ``<`` and ``>``: buckets, the word
    each belongs to, and a 64-bit hash per word. The whole marked word is a gram too."""
    data = [f"<{w}>".encode() for w in words]
    lengths = np.fromiter(map(len, data), np.int64, len(data))
    text = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64) + np.uint64(1)
    start = np.cumsum(lengths) - lengths
    of = np.repeat(np.arange(len(data)), lengths)
    shift = np.uint64(64 - bits)
    place = np.arange(len(text)) - start[of]
    powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(lengths.max(initial=1)), BASE)]))
    whole = np.add.reduceat(text * powers[place], start) if len(data) else np.zeros(0, np.uint64)
    whole = (whole ^ (whole >> np.uint64(29))) * MIX
    whole ^= whole >> np.uint64(32)
    ids, owner = [(whole * MIX >> shift).astype(np.int64)], [np.arange(len(data))]
    rolled, size = text, 1
    for n in sorted(sizes):
        while size < n:
            rolled = rolled[:-1] * BASE + text[size:] if len(rolled) > 1 else rolled[:0]
            size += 1
        ok = place[: len(rolled)] + n <= lengths[of[: len(rolled)]]
        h = rolled[ok] + MIX // np.uint64(n)
        h = (h ^ (h >> np.uint64(31))) * MIX
        ids.append((h >> shift).astype(np.int64))
        owner.append(of[: len(rolled)][ok])
    return np.concatenate(ids), np.concatenate(owner), whole


class Rows(dict):
    """Numbers words in the order they are first met; ``new`` lists those since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = row = len(self)
        return row


class WordTable:
    """Rows of numbers per word, computed once per worker and model.

    ``compute`` gives an array per column for a list of new words. Words of many texts
    are looked up together; a full table starts again.
    """

    def __init__(self, compute: Callable[[list[str]], list[np.ndarray]], most: int = 1_000_000):
        self.compute, self.most = compute, most
        self.rows = Rows()
        self.columns: list[np.ndarray] = []

    def index(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Rows of the words of each text; ``columns`` has their numbers until the next call."""
        if len(self.rows) > self.most:
            self.rows, self.columns = Rows(), []
        found = [np.fromiter(map(self.rows.__getitem__, words), np.int32, len(words)) for words in texts]
        new, self.rows.new = self.rows.new, []
        first = len(self.rows) - len(new)
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            got = self.compute(part)
            need = first + len(part)
            if not self.columns or need > len(self.columns[0]):
                room = max(2 * need, 1024)
                old = self.columns or [g[:0] for g in got]
                self.columns = [np.concatenate([o[:first], np.zeros((room - first, *o.shape[1:]), o.dtype)]) for o in old]
            for column, values in zip(self.columns, got, strict=True):
                column[first:need] = values
            first = need
        return found
