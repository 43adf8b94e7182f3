"""Near-duplicate detection by BagMinHash signatures, bands and exact verification.

A document is the multiset of its five-word shingles (its whole words if it has one
to four). Weights are counts, cut into dyadic intervals (0,1], (1,2], (2,4], ...; each
shingle has a Poisson process on each interval, its points ordered by height and
spread over the signature's registers, and a point counts if its place in the
interval is at most the weight. A register keeps its lowest point, so two documents
agree in a register with the probability of their weighted Jaccard similarity. Only
points below a height that fills all registers are drawn, whatever the length.

Documents that agree in a whole band meet in a bucket. Buckets are not paired up:
each has a hub, and members join the hub's canopy if their signatures agree enough
that a duplicate of the hub's neighbours could be among them (distances obey the
triangle inequality); members near the hub are done with the bucket, the others get
a second hub and then a canopy of their own. Canopies are compared exactly, in blocks
of bounded numbers of texts and shingles. First every block is compared within itself and with
the hub, so that a family of near copies of the hub is one class after its texts were read
once; only texts not linked to the hub then meet the other blocks of their canopy. Each block
leaves a spanning forest, never its pairs. Components
of the links found are the classes; equal texts are one node throughout.

Every document is returned. A document without words is a class by itself, together
with others of equal text. The class id is the smallest id in the class (null if it
has none), and its first document stands for the class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, MIX, Stages, nested, unnested
from .repeats import Texts, keyed, mix, prefix, run_hash, signed
from .substring_dedup import word_codes

SHINGLE = 5
SIMILARITY = (4, 5)
BANDS, ROWS = 36, 6
REGISTERS = BANDS * ROWS
#: Agreement with the hub (share of registers) from which a member is in its canopy, and
#: from which it is done with the bucket. With links at a distance of 0.2, canopies need
#: a radius 0.2 larger than that of the members done; the rest allows for three standard
#: deviations of either estimate.
CANOPY, DONE = 0.25, 0.65
HUB_ROUNDS = 2
BLOCK = 1024
#: Shingles of a block on average, of texts signed at a time, and shared ones expanded at a time.
SHINGLES = 1 << 18
SIGNED_AT = 1 << 18
EXPANDED = 1 << 18


def shingles(text: str) -> np.ndarray:
    """Hashes of the shingles, with repetitions."""
    codes = word_codes(text)
    n = min(SHINGLE, len(codes))
    if not n:
        return codes
    return mix(run_hash(prefix(codes), np.arange(len(codes) - n + 1), n) + np.uint64(n))


def signatures(bags: list[np.ndarray]) -> np.ndarray:
    """Registers of some documents, none of them empty: one row each."""
    unique = [np.unique(b, return_counts=True) for b in bags]
    element = np.concatenate([u for u, _ in unique])
    weight = np.concatenate([n for _, n in unique])
    of = np.repeat(np.arange(len(bags)), [len(u) for u, _ in unique])
    # One item for each dyadic interval that the weight reaches into.
    items = [(element, weight, of, np.zeros(len(of), np.int64), np.ones(len(of), np.int64))]
    low = 1
    while (more := weight > low).any():
        n = int(more.sum())
        level = mix(element[more] + np.uint64(low * int(MIX) % (1 << 64)))
        items.append((level, weight[more], of[more], np.full(n, low), np.full(n, low)))
        low *= 2
    element, weight, of, low_, rate = (np.concatenate(x) for x in zip(*items, strict=True))
    total = np.array([len(b) for b in bags])
    height = REGISTERS * (math.log(REGISTERS) + 3) / total
    out = np.full((len(bags), REGISTERS), np.inf)
    open_ = np.ones(len(bags), bool)
    while open_.any():
        own = np.flatnonzero(open_[of])
        out[open_] = np.inf
        x = np.zeros(len(own))
        state = element[own]
        while len(own):
            state = mix(state + BASE)
            x = x - np.log(((state >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53) / rate[own]
            alive = x <= height[of[own]]
            own, x, state = own[alive], x[alive], state[alive]
            mark = mix(state ^ MIX)
            register = ((mark >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
            place = low_[own] + 1 + (((mark & np.uint64(0xFFFFFFFF)) * rate[own].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            counts = place <= weight[own]
            np.minimum.at(out.ravel(), of[own[counts]] * REGISTERS + register[counts], x[counts])
        open_ = np.isinf(out).any(1)
        height[open_] *= 2
    return out


SIGNED = pa.schema([("_t1", pa.int64()), ("_t2", pa.int64()), ("n", pa.int64()), ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _portions(lengths: np.ndarray, most: int) -> list[np.ndarray]:
    """Indexes cut where the lengths before add up to multiples of ``most``."""
    at = (np.cumsum(lengths) - lengths) // most
    return np.split(np.arange(len(lengths)), np.flatnonzero(np.diff(at)) + 1) if len(lengths) else []


def sign(texts: DataFrame) -> DataFrame:
    """Signatures (two bytes a register) and band keys of all texts with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = pc.binary_length(b.column("text")).to_numpy(zero_copy_only=False)
            for rows in _portions(np.nan_to_num(lengths) // 6, SIGNED_AT):  # a word has about six bytes
                part = b.slice(rows[0], len(rows))
                bags = [shingles(t) for t in part.column("text").to_pylist()]
                has = np.flatnonzero([len(x) for x in bags])
                if not len(has):
                    continue
                values = mix(signatures([bags[i] for i in has]).view(np.uint64))
                bands = np.zeros((len(has), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for r in range(ROWS):
                    bands = mix(bands + values[:, r::ROWS])
                short = (values >> np.uint64(48)).astype("<u2")
                taken = pa.array(has)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_t1").take(taken), part.column("_t2").take(taken), pa.array([len(bags[i]) for i in has], pa.int64()),
                        pa.array([s.tobytes() for s in short], pa.binary()),
                        pa.array(list(signed(bands.ravel()).reshape(bands.shape)), pa.list_(pa.int64())),
                    ],
                    schema=SIGNED,
                )

    return texts.select("_t1", "_t2", "text").mapInArrow(run, "_t1 BIGINT, _t2 BIGINT, n BIGINT, signature BINARY, bands ARRAY<BIGINT>")


def _agreement(pairs: DataFrame) -> DataFrame:
    """Adds ``agree``, the share of registers in which two signatures agree."""
    columns = [c for c in pairs.columns if c not in ("a", "b")]
    types = dict(pairs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c = (np.frombuffer(b"".join(b.column(x).to_pylist()), "<u2").reshape(-1, REGISTERS) for x in "ab")
            agree = pa.array((a == c).mean(1))
            yield pa.RecordBatch.from_arrays([b.column(x) for x in columns] + [agree], names=[*columns, "agree"])

    return pairs.mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in columns) + ", agree DOUBLE")


def canopies(stages: Stages, signs: DataFrame) -> DataFrame:
    """``canopy, _t1, _t2, hub``: every two texts of a bucket that can be duplicates share one;
    ``hub`` marks the text that the others are near, where there is one."""
    rows = signs.select(F.explode("bands").alias("key"), "_t1", "_t2")
    full = rows.groupBy("key").count().filter("count > 1").select("key")
    rows = stages.write(rows.join(full, "key"), "buckets")
    by_id = lambda x, a: signs.select(F.col("_t1").alias(f"{x}1"), F.col("_t2").alias(f"{x}2"), F.col("signature").alias(a))
    found = []
    for i in range(HUB_ROUNDS):
        hubs = rows.groupBy("key").agg(F.min(F.struct("_t1", "_t2")).alias("hub"), F.count("*").alias("n"))
        hubs = hubs.filter("n > 1").select("key", F.col("hub._t1").alias("h1"), F.col("hub._t2").alias("h2"))
        met = stages.write(rows.join(hubs, "key"), f"met{i}")
        pairs = met.filter("_t1 <> h1 OR _t2 <> h2").select("h1", "h2", F.col("_t1").alias("m1"), F.col("_t2").alias("m2")).distinct()
        pairs = pairs.join(by_id("h", "a"), ["h1", "h2"]).join(by_id("m", "b"), ["m1", "m2"])
        agreed = stages.write(_agreement(pairs), f"agreed{i}")
        inside = agreed.filter(F.col("agree") >= CANOPY)
        canopy = F.concat_ws(":", F.lit(i), "h1", "h2").alias("canopy")
        found.append(inside.select(canopy, F.col("m1").alias("_t1"), F.col("m2").alias("_t2"), F.lit(False).alias("hub")))
        found.append(inside.select(canopy, F.col("h1").alias("_t1"), F.col("h2").alias("_t2"), F.lit(True).alias("hub")).distinct())
        left = met.filter("_t1 <> h1 OR _t2 <> h2").join(
            agreed.filter(F.col("agree") < DONE).select("h1", "h2", F.col("m1").alias("_t1"), F.col("m2").alias("_t2")),
            ["h1", "h2", "_t1", "_t2"],
        )
        left = left.select("key", "_t1", "_t2")
        more = left.groupBy("key").count().filter("count > 1").select("key")
        rows = stages.write(left.join(more, "key"), f"left{i}")
    found.append(rows.select(F.concat_ws(":", F.lit("bucket"), "key").alias("canopy"), "_t1", "_t2", F.lit(False).alias("hub")))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return stages.write(out, "canopies")


class Forest:
    """Union-find over a block's rows; the smallest row is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


LINKED = "canopy STRING, _t1 BIGINT, _t2 BIGINT, r1 BIGINT, r2 BIGINT, near BOOLEAN"


def block_links(rows: pd.DataFrame, similarity: tuple[int, int] = SIMILARITY) -> pd.DataFrame:
    """A forest of the links in a block: each text with the first one of its tree, and whether
    the hub is in that tree. Texts marked ``open`` are only compared with the others, where there are any."""
    rows = rows.sort_values(["_t1", "_t2", "open"], ignore_index=True)
    bags = []
    for t in rows["text"]:
        # The k-th copy of a shingle is an element of its own: overlaps are then those of multisets.
        b = np.sort(shingles(t))
        first = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else np.zeros(0, np.int64)
        nth = np.arange(len(b)) - np.repeat(first, np.diff(np.concatenate([first, [len(b)]])))
        bags.append(mix(b + nth.astype(np.uint64) * MIX))
    size = np.array([len(b) for b in bags])
    element, code = np.unique(np.concatenate(bags) if bags else np.zeros(0, np.uint64), return_inverse=True)
    bags.clear()
    of = np.repeat(np.arange(len(size)), size)
    order = np.argsort(code, kind="stable")
    holders = of[order].astype(np.int32)
    first = np.searchsorted(code[order], np.arange(len(element) + 1))
    at = np.cumsum(size) - size
    forest = Forest(len(size))
    side = rows["open"].to_numpy(bool)
    across = side.any()
    p, q = similarity
    for i in np.flatnonzero(side) if across else range(len(size)):
        own = code[at[i] : at[i] + size[i]]
        n = first[own + 1] - first[own]
        own, n = own[n > 1], n[n > 1]
        if not len(own):
            continue
        shared = np.zeros(len(size), np.int64)
        for some in _portions(n, EXPANDED):
            m = n[some]
            flat = np.repeat(first[own[some]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            shared += np.bincount(holders[flat], minlength=len(size))
        # shared / union >= p / q
        linked = (p + q) * shared >= p * (size[i] + size)
        if across:
            linked &= ~side
        else:
            linked[: i + 1] = False
        for j in np.flatnonzero(linked):
            forest.join(int(i), int(j))
    root = np.array([forest.root(i) for i in range(len(size))], np.int64)
    hub = np.zeros(len(size), bool)
    hub[root[rows["hub"].to_numpy(bool)]] = True
    t1, t2 = rows["_t1"].to_numpy(), rows["_t2"].to_numpy()
    return pd.DataFrame({"canopy": rows["canopy"], "_t1": t1, "_t2": t2, "r1": t1[root], "r2": t2[root], "near": hub[root]})


def links(stages: Stages, texts: DataFrame, groups: DataFrame, signs: DataFrame) -> DataFrame:
    """Links between texts of a canopy. Its blocks are compared within themselves and with the hub;
    then texts the hub's class lacks meet all others, again in blocks."""
    weighed = groups.join(signs.select("_t1", "_t2", "n"), ["_t1", "_t2"])
    count = lambda: F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / SHINGLES)).cast("int")
    sizes = stages.write(weighed.filter("NOT hub").groupBy("canopy").agg(count().alias("blocks")), "sizes")
    dealt = lambda n: F.pmod(F.xxhash64("_t1", "_t2"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = weighed.filter("NOT hub").join(sizes, "canopy").withColumn("block", dealt("blocks"))
    hubs = groups.filter("hub").join(sizes, "canopy").withColumn("block", every("blocks"))
    names = ["canopy", "block", "_t1", "_t2", "hub"]
    first = members.select(*names).unionByName(hubs.select(*names)).withColumn("open", F.lit(False))
    held = texts.select("_t1", "_t2", "text").join(first, ["_t1", "_t2"])
    within = stages.write(held.groupBy("canopy", "block").applyInPandas(lambda g: block_links(g), LINKED), "within")

    large = sizes.filter("blocks > 1").select("canopy")
    seen = within.join(large, "canopy").join(signs.select("_t1", "_t2", "n"), ["_t1", "_t2"])
    seen = seen.select("canopy", "_t1", "_t2", "near", "n")
    few = seen.groupBy("canopy").agg(F.count_if(~F.col("near")).alias("m"), F.sum(F.when(~F.col("near"), F.col("n"))).alias("w"))
    few = few.filter("m > 0").select("canopy", F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("w") / SHINGLES)).cast("int").alias("opened"))
    opened = stages.write(few, "opened")
    if opened.isEmpty():
        return stages.write(_apart(within).distinct(), "links")
    near = seen.filter("near").groupBy("canopy").agg(count().alias("blocks"))
    seen = seen.join(opened, "canopy").join(near, "canopy", "left").fillna(0, ["blocks"])
    # Texts not near the hub meet each other, each two parts once (j < 0 marks no block of the others),
    # and the blocks of those that are.
    parts = seen.filter("NOT near").withColumn("part", dealt("opened"))
    each = parts.withColumn("other", every("opened"))
    key = ["canopy", "i", "j"]
    names = [*key, "_t1", "_t2", F.lit(False).alias("hub"), "open"]
    own = each.withColumns({"i": F.least("part", "other"), "j": -1 - F.greatest("part", "other"), "open": F.col("part") < F.col("other")})
    asking = parts.filter("blocks > 0").withColumn("j", every("blocks")).withColumns({"i": F.col("part"), "open": F.lit(True)})
    others = seen.filter("near").withColumn("j", dealt("blocks")).withColumn("i", every("opened")).withColumn("open", F.lit(False))
    held = texts.select("_t1", "_t2", "text").join(
        own.select(*names).unionByName(asking.select(*names)).unionByName(others.select(*names)), ["_t1", "_t2"]
    )

    def linked(group: pd.DataFrame) -> pd.DataFrame:
        found = block_links(group)
        return found[(found["_t1"] != found["r1"]) | (found["_t2"] != found["r2"])]

    across = held.groupBy(*key).applyInPandas(linked, LINKED)
    return stages.write(_apart(within.unionByName(across)).distinct(), "links")


def _apart(found: DataFrame) -> DataFrame:
    return found.filter("_t1 <> r1 OR _t2 <> r2").select("_t1", "_t2", "r1", "r2")


def components(stages: Stages, edges: DataFrame) -> DataFrame:
    """``_t1, _t2, c1, c2``: every linked text and the smallest text of its component, by
    turns of large and small stars until nothing changes."""
    node = lambda a, b: F.struct(F.col(a).alias("x"), F.col(b).alias("y"))
    pairs = edges.select(node("_t1", "_t2").alias("u"), node("r1", "r2").alias("v"))
    state, i = None, 0
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stages.write(large.filter("u <> v").distinct(), f"large{i}")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        pairs = stages.write(small, f"small{i}")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state, i = now, i + 1
    return pairs.select(F.col("u.x").alias("_t1"), F.col("u.y").alias("_t2"), F.col("v.x").alias("c1"), F.col("v.y").alias("c2"))


def _classes(stages: Stages, docs: DataFrame) -> DataFrame:
    """Texts that are linked, and their component."""
    with Texts(docs) as texts:
        signs = stages.write(sign(texts), "signatures")
        groups = canopies(stages, signs)
        found = links(stages, texts, groups, signs)
    return components(stages, found)


def _classified(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id``, ``text`` and a row) with the key of their class, the class's
    smallest id and its size."""
    spark = docs.sparkSession
    with Stages(spark) as stages:
        labels = Stages(spark).write(_classes(stages, docs), "classes", keep=True)

    def labelled(rows: DataFrame) -> DataFrame:
        rows = keyed(rows).join(labels, ["_t1", "_t2"], "left")
        return rows.withColumns({"_c1": F.coalesce("c1", "_t1"), "_c2": F.coalesce("c2", "_t2")})

    slim = labelled(docs.select("doc_id", "text")).groupBy("_c1", "_c2")
    first = slim.agg(F.min("doc_id").alias("_class"), F.count("*").alias("_size"))
    return labelled(docs).join(Stages(spark).write(first, "firsts", keep=True), ["_c1", "_c2"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, class_size, kept`` of every document; ``kept`` is the class's first."""
    rows = _classified(docs.select("doc_id", "text"))
    kept = F.col("doc_id").eqNullSafe(F.col("_class"))
    return rows.select("doc_id", F.col("_class").alias("class_id"), F.col("_size").alias("class_size"), kept.alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each class, all columns: the one with the smallest id. Of rows that
    share that id, or of a class without ids, any one stays."""
    rows = _classified(nested(docs, "doc_id")).filter(F.col("doc_id").eqNullSafe(F.col("_class")))
    repeated = rows.groupBy("_c1", "_c2").count().filter("count > 1")
    if not repeated.isEmpty():
        rows = rows.dropDuplicates(["_c1", "_c2"])
    return unnested(rows, docs.columns)
