"""Phrases that stand together more often than their words: counted exactly by direct-address tiles.

Texts become blocks of a bounded number of words, each with a vocabulary of its own; only
vocabularies are shuffled to count words and to number the frequent ones by falling
frequency. A block then counts adjacent numbers in *tiles*: bands of numbers that double in
width, so that a tile of two bands holds a comparable share of the pairs of a language
whatever its vocabulary. A tile that is small and well filled is an array addressed directly
by row and column (``numpy.bincount``); a sparse one is a sorted list of codes with counts.
Both leave as packed codes and counts, tiles are merged across blocks the same way, and what
is left are the phrases with their numbers of occurrences.

For longer phrases this repeats itself: frequent pairs are numbered by falling frequency in
their turn, every occurrence of a pair in a block becomes its number, and two neighbouring pairs
that overlap in a word are a phrase of three words, counted in tiles of pair numbers, and
so on. A part of a frequent phrase is frequent, so nothing frequent is missed.

Where the work goes: a block holds at most ``BLOCK`` words (and one stretch of 1 MB); a
long text or a text without separators goes on in the next block, which then starts with the last words of the one before
without counting them. Tiles are cut into slices by a hash of the code, more of them the
more words there are, so that neither a hot word nor a hot language or tile meets in one task; a hot pair
arrives as one count per block. The driver gets a count per partition.

Defined results: a null text is empty and a null language is ``und``, which counts with a language of that
name; repeated rows count each; an empty table gives no phrase. Counts are exact. Scores are computed
in 38-digit decimals: exact while ``a * a`` stays below 10^32, an error beyond.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import MIX, Rows, Stages

#: Characters that end a piece, and what they all become.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
END = b"."
TABLE = bytes.maketrans(SEPARATORS + b"\t", END * len(SEPARATORS) + b" ")
BREAK = re.compile(rb"[ .]")
#: Words of a block and of all open blocks of a task.
BLOCK, OPEN = 400_000, 1_200_000
STRETCH = 1 << 20
#: Width of the first two bands of numbers; each further band is as wide as all before it.
BAND = 1024
#: A tile of at most so many cells is counted densely if every eighth cell can be filled.
CELLS, FILLED = 1 << 21, 8
#: Pairs of words per slice of a tile, on average over all tiles together.
SLICE = 1 << 25
#: Codes held unmerged while a tile is merged.
PENDING = 1 << 22
#: Packed tiles that are unpacked from a batch at a time.
UNPACKED = 256


def stretches(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in lower case (A to Z only), ``END`` between pieces, about 1 MB at a time."""
    text = text.lower().translate(TABLE)
    at = 0
    while at < len(text):
        found = BREAK.search(text, at + STRETCH)
        end = found.start() if found else len(text)
        yield text[at:end].replace(END, b" . ").split()
        at = end


class Block:
    """Words of one language as numbers in the order first met; ``END`` is -1."""

    def __init__(self, before: list[bytes] = []):  # noqa: B006  never changed
        self.rows = Rows()
        self.rows[END]  # number 0
        self.lead = len(before)
        self.parts = [self.numbers(before)]
        self.size = self.lead

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.rows.__getitem__, words), np.int32, len(words)) - 1

    def add(self, words: list[bytes]) -> None:
        self.parts.append(self.numbers(words))
        self.size += len(words)

    def last(self, n: int) -> list[bytes]:
        """The last ``n`` words of the piece that is not ended yet."""
        tail = np.concatenate(self.parts)[-n:] if n else np.zeros(0, np.int32)
        ends = np.flatnonzero(tail < 0)
        return [self.rows.new[i + 1] for i in tail[ends[-1] + 1 if len(ends) else 0 :]]

    def row(self, number: int, lang: str) -> pa.RecordBatch:
        seq = np.concatenate(self.parts)
        own = seq[self.lead :]
        words = self.rows.new[1:]
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array([number], pa.int64()),
                "lang": pa.array([lang]),
                "lead": pa.array([self.lead], pa.int32()),
                "words": pa.array([words], pa.list_(pa.binary())),
                "counts": pa.array([np.bincount(own[own >= 0], minlength=len(words))], pa.list_(pa.int64())),
                "seq": pa.array([seq.tobytes()], pa.binary()),
            }
        )


WORDS = "block BIGINT, lang STRING, lead INT, words ARRAY<BINARY>, counts ARRAY<BIGINT>, seq BINARY"


def word_blocks(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the texts of a task, numbered across tasks."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    blocks: dict[str, Block] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            for words in stretches(text.as_py()):
                block = blocks.get(lang) or blocks.setdefault(lang, Block())
                block.add(words)
                total += len(words)
                if block.size >= BLOCK:
                    yield block.row(number, lang)
                    number, total = number + 1, total - block.size
                    blocks[lang] = Block(block.last(longest - 1))
                    total += blocks[lang].size
            if lang in blocks:
                blocks[lang].add([END])
                total += 1
            while total > OPEN:
                most = max(blocks, key=lambda x: blocks[x].size)
                block = blocks.pop(most)
                yield block.row(number, most)
                number, total = number + 1, total - block.size
    for lang, block in blocks.items():
        yield block.row(number, lang)
        number += 1


def band(numbers: np.ndarray) -> np.ndarray:
    """0 below ``BAND``, then one more each time the number doubles."""
    return np.frexp((numbers // BAND).astype(np.float64))[1].astype(np.int64)


def band_start(i: np.ndarray | int) -> np.ndarray | int:
    return np.where(np.asarray(i) > 0, BAND << np.maximum(np.asarray(i) - 1, 0), 0)


def band_width(i: int) -> int:
    return BAND << max(i - 1, 0)


def merged(codes: np.ndarray, counts: np.ndarray, area: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and their summed counts: by direct address in a small, filled tile, else sorted."""
    if area <= CELLS and len(codes) >= area // FILLED:
        cells = np.bincount(codes, weights=counts, minlength=area)  # sums below 2^53 are exact
        used = np.flatnonzero(cells)
        return used, cells[used].astype(np.int64)
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def tile_numbers(codes: np.ndarray, area: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of a tile in order, and the place of each code among them."""
    if area <= CELLS and len(codes) >= area // FILLED:
        cells = np.bincount(codes, minlength=area) > 0
        return np.flatnonzero(cells), (np.cumsum(cells) - 1)[codes]
    return np.unique(codes, return_inverse=True)


def portions(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows. Spark fills a batch with many megabytes, and a block or a tile is taken
    out of it as an object of its own: not all of them at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _slices(codes: np.ndarray, n: int) -> np.ndarray:
    mixed = codes.astype(np.uint64) * MIX
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(n)).astype(np.int64)


TILES = "block BIGINT, lang STRING, lead INT, seq BINARY, tile INT, slice INT, first INT, codes BINARY, counts BINARY"


def pair_tiles(batches: Iterator[pa.RecordBatch], size: int, slices: int) -> Iterator[pa.RecordBatch]:
    """Counts of neighbouring numbers of every block, packed by tile and slice, and the block as
    numbers of its own pairs. Place ``i`` stands for the ``size - 1`` words from ``i``."""
    for batch in portions(batches, 1):
        for row, mapped in zip(batch.drop_columns("mapped").to_pylist(), batch.column("mapped"), strict=True):
            seq = np.frombuffer(row["seq"], np.int32)
            numbers = np.full(int(seq.max(initial=-1)) + 2, -1, np.int64)  # the last is for -1
            starts, new = mapped.values.field("first").to_numpy(), mapped.values.field("ids")
            if pa.types.is_binary(new.type):
                for start, part in zip(starts, new.to_pylist(), strict=True):
                    numbers[start : start + len(part) // 8] = np.frombuffer(part, np.int64)
            else:
                numbers[starts] = new.to_numpy()
            ids = numbers[seq]
            at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
            own = at + size - 1 >= row["lead"]
            left, right = ids[at], ids[at + 1]
            bands = band(left), band(right)
            tiles = (bands[0] * 64 + bands[1]).astype(np.int16)
            order = np.argsort(tiles, kind="stable")
            cuts = np.flatnonzero(np.diff(tiles[order])) + 1
            out: dict[str, list] = {n: [] for n in ("tile", "slice", "first", "codes", "counts")}
            pairs = np.full(max(len(seq) - 1, 0), -1, np.int32)
            first = 0
            for of in np.split(order, cuts) if len(order) else ():
                tile = int(tiles[of[0]])
                i, j = divmod(tile, 64)
                area = band_width(i) * band_width(j)
                code = (left[of] - band_start(i)) * band_width(j) + right[of] - band_start(j)
                distinct, place = tile_numbers(code, area)
                counts = np.bincount(place[own[of]], minlength=len(distinct))
                slice_of = _slices(distinct, slices)
                by = np.argsort(slice_of, kind="stable")
                back = np.empty_like(by)
                back[by] = np.arange(len(by))
                pairs[at[of]] = first + back[place]
                edges = np.flatnonzero(np.diff(slice_of[by])) + 1
                for part in np.split(by, edges):
                    out["tile"].append(tile)
                    out["slice"].append(int(slice_of[part[0]]))
                    out["first"].append(first)
                    out["codes"].append(_packed(distinct[part]))
                    out["counts"].append(counts[part].astype(np.uint32).tobytes())
                    first += len(part)
            n = len(out["tile"])
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([row["block"]] * (n + 1), pa.int64()),
                    "lang": pa.array([row["lang"]] * (n + 1)),
                    "lead": pa.array([row["lead"]] + [None] * n, pa.int32()),
                    "seq": pa.array([pairs.tobytes()] + [None] * n, pa.binary()),
                }
                | {k: pa.array([None, *v], kind) for (k, v), kind in zip(out.items(), kinds, strict=True)}
            )


def _packed(codes: np.ndarray) -> bytes:
    """Codes in 4 bytes each, or in 8 behind a mark, if one is too large."""
    return codes.astype(np.uint32).tobytes() if not len(codes) or codes.max() < 2**32 else b"\0" + codes.astype(np.int64).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32).astype(np.int64) if len(data) % 4 == 0 else np.frombuffer(data, np.int64, offset=1)


PAIRS = "lang STRING, tile INT, slice INT, code BIGINT, a BIGINT, b BIGINT, f BIGINT"


def frequent_pairs(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Pairs that occur often enough, from packed tiles in order of language, tile and slice."""
    key, codes, counts, held = None, [], [], 0

    def squeeze(area: int) -> None:
        nonlocal codes, counts, held
        a, b = merged(np.concatenate(codes), np.concatenate(counts), area)
        codes, counts, held = [a], [b], len(a)

    def finished() -> Iterator[pa.RecordBatch]:
        if key is None:
            return
        lang, tile, part = key
        i, j = divmod(tile, 64)
        squeeze(band_width(i) * band_width(j))
        often = counts[0] >= least
        code, f = codes[0][often], counts[0][often]
        if len(code):
            row, column = np.divmod(code, band_width(j))
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang]).take(pa.array(np.zeros(len(code), np.int32))),
                    "tile": pa.array(np.full(len(code), tile), pa.int32()),
                    "slice": pa.array(np.full(len(code), part), pa.int32()),
                    "code": pa.array(code, pa.int64()),
                    "a": pa.array(row + band_start(i), pa.int64()),
                    "b": pa.array(column + band_start(j), pa.int64()),
                    "f": pa.array(f, pa.int64()),
                }
            )

    for batch in portions(batches, UNPACKED):
        for row in batch.to_pylist():
            this = (row["lang"], row["tile"], row["slice"])
            if this != key:
                yield from finished()
                key, codes, counts, held = this, [], [], 0
            codes.append(_unpacked(row["codes"]))
            counts.append(np.frombuffer(row["counts"], np.uint32).astype(np.int64))
            held += len(codes[-1])
            if held > max(PENDING, 2 * len(codes[0])):  # the first are those already merged
                i, j = divmod(row["tile"], 64)
                squeeze(band_width(i) * band_width(j))
    yield from finished()


MAPPED = "block BIGINT, first INT, ids BINARY"


def block_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The new numbers of a block's pairs. Comes in order of language, tile and slice, where
    the frequent pairs (no block) stand before the blocks' codes."""
    key, codes, ids, table = None, [], [], None
    for batch in portions(batches, UNPACKED):
        out: dict[str, list] = {"block": [], "first": [], "ids": []}
        for lang, tile, part, block, first, packed, code, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (lang, tile, part) != key:
                key, codes, ids, table = (lang, tile, part), [], [], None
            if block is None:
                codes.append(code)
                ids.append(number)
                continue
            if table is None:
                order = np.argsort(np.array(codes, np.int64), kind="stable")
                table = np.array(codes, np.int64)[order], np.array(ids, np.int64)[order]
            if len(table[0]):
                wanted = _unpacked(packed)
                at = np.minimum(np.searchsorted(table[0], wanted), len(table[0]) - 1)
                out["block"].append(block)
                out["first"].append(first)
                out["ids"].append(np.where(table[0][at] == wanted, table[1][at], -1).tobytes())
        if out["block"]:
            yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(out.items(), (pa.int64(), pa.int32(), pa.binary()), strict=True)})


def numbered(stages: Stages, grams: DataFrame, *ties: str) -> DataFrame:
    """``id``: place of a gram in its language by falling ``f``, then by ``ties``."""
    order = ["lang", F.desc("f"), *ties]
    placed = grams.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = stages.write(placed, "ranked")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    starts, total = [], 0
    for r in placed.groupBy(part.alias("p")).count().orderBy("p").collect():  # a row per partition
        starts.append((r["p"], total))
        total += r["count"]
    starts = grams.sparkSession.createDataFrame(starts, "p BIGINT, start BIGINT")
    whole = placed.withColumn("p", part).join(starts, "p").withColumn("at", F.col("start") + place).drop("p", "start")
    base = whole.groupBy("lang").agg(F.min("at").alias("base"))
    return whole.join(base, "lang").withColumn("id", F.col("at") - F.col("base")).drop("at", "base")


def phrases(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    first: int | None = 2000,
    inside: int = 50,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first phrases of 2 to ``longest`` words.

    ``a`` counts the phrase (at least ``least``), ``l`` and ``r`` the two sides of the cut with the
    lowest score ``floor(10^6 a a / (l r))``, ``n`` all words. A phrase is dropped if a longer one that
    holds it occurs at least ``inside`` percent as often. ``first=None`` ranks all."""
    spark = docs.sparkSession
    lang, text = (F.coalesce(F.col(c), F.lit(other)) for c, other in (("lang", "und"), ("text", "")))
    result = "lang STRING, rank BIGINT, phrase STRING, a BIGINT, l BIGINT, r BIGINT, n BIGINT, score BIGINT"
    with Stages(spark) as stages:
        texts = docs.select(lang.cast("string").alias("lang"), text.cast("binary").alias("text"))
        blocks = stages.write(texts.mapInArrow(lambda b: word_blocks(b, longest), WORDS), "words")
        entry = F.explode(F.arrays_zip("words", "counts")).alias("e")
        counted = blocks.select("lang", entry).groupBy("lang", F.col("e.words").alias("word")).agg(F.sum("e.counts").alias("f"))
        counted = stages.write(counted, "vocabulary")
        totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
        words = counted.agg(F.sum("f")).first()[0] or 0
        slices = max(1, -(-words // SLICE))
        grams = stages.write(numbered(stages, counted.filter(F.col("f") >= least), "word"), "numbered")
        own = blocks.select("block", "lang", F.posexplode("words").alias("pos", "word"))
        known = grams.select("lang", "word", "id")
        pairs = own.join(known, ["lang", "word"]).select("block", F.col("pos").alias("first"), F.col("id").alias("ids"))
        level = grams.select(
            "lang",
            "id",
            "f",
            F.array().cast("array<bigint>").alias("before"),
            F.array().cast("array<bigint>").alias("after"),
            F.col("word").cast("string").alias("phrase"),
            F.col("word").cast("string").alias("last"),
        )
        found = []
        for size in range(2, longest + 1):
            mapped = pairs.groupBy("block").agg(F.collect_list(F.struct("first", "ids")).alias("mapped"))
            ready = blocks.select("block", "lang", "lead", "seq").join(mapped, "block")
            tiles = stages.write(ready.mapInArrow(lambda b, s=size: pair_tiles(b, s, slices), TILES), "tiles")
            key = ["lang", "tile", "slice"]
            packed = tiles.filter("tile IS NOT NULL")
            often = packed.select(*key, "codes", "counts").repartition(*key).sortWithinPartitions(*key)
            often = stages.write(often.mapInArrow(lambda b: frequent_pairs(b, least), PAIRS), "pairs")
            often = stages.write(numbered(stages, often, "a", "b"), "numbered")
            level = stages.write(_longer(often, level), "phrases")
            found.append(level)
            if size < longest:
                known = often.select(*key, _null("block", "bigint"), _null("first", "int"), _null("codes", "binary"), "code", "id")
                asked = packed.select(*key, "block", "first", "codes", _null("code", "bigint"), _null("id", "bigint"))
                both = known.unionByName(asked).repartition(*key).sortWithinPartitions(*key, F.col("block").isNotNull())
                blocks = tiles.filter("tile IS NULL").select("block", "lang", "lead", "seq")
                pairs = stages.write(both.mapInArrow(block_numbers, MAPPED), "mapped")
        ranked = None
        for this, next_ in zip(found, [*found[1:], None], strict=True):
            if next_ is not None:
                parent = next_.select("lang", F.col("a").alias("id"), "f").unionByName(next_.select("lang", F.col("b").alias("id"), "f"))
                parent = parent.groupBy("lang", "id").agg(F.max("f").alias("longer"))
                this = this.join(parent, ["lang", "id"], "left").filter(F.coalesce(F.col("longer") * 100 < F.col("f") * inside, F.lit(True)))
            this = this.select("lang", "phrase", F.col("f").alias("a"), _cut(this).alias("cut"))
            ranked = this if ranked is None else ranked.unionByName(this)
        if ranked is None:
            return spark.createDataFrame([], result)
        ranked = ranked.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = ranked.withColumn("rank", F.row_number().over(order))
        if first is not None:
            ranked = ranked.filter(F.col("rank") <= first)
        ranked = ranked.join(totals, "lang")
        return stages.write(ranked.select("lang", F.col("rank").cast("bigint"), "phrase", "a", "l", "r", "n", "score"), "ranked", keep=True)


def _null(name: str, kind: str) -> Column:
    return F.lit(None).cast(kind).alias(name)


def _longer(grams: DataFrame, parts: DataFrame) -> DataFrame:
    """Phrases and the counts of their beginnings and ends, from those of the two phrases they overlap from."""
    begin = parts.select("lang", F.col("id").alias("a"), F.concat("before", F.array("f")).alias("before"), F.col("phrase").alias("begin"))
    end = parts.select("lang", F.col("id").alias("b"), F.concat("after", F.array("f")).alias("after"), "last")
    return (
        grams.join(begin, ["lang", "a"])
        .join(end, ["lang", "b"])
        .select("lang", "id", "f", "a", "b", "before", "after", F.concat_ws(" ", "begin", "last").alias("phrase"), "last")
    )


def _cut(grams: DataFrame) -> Column:
    """The cut with the lowest score (ties: after the fewest words): ``score, k, l, r``."""
    whole = lambda c: c.cast("decimal(19,0)")
    f = whole(F.col("f"))

    def at(left: Column, i: Column) -> Column:
        right = F.element_at("after", -(i + 1))  # after k words, the rest has all but k
        score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * f * f, whole(left) * whole(right))
        return F.struct(score.alias("score"), i.alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform("before", at))
