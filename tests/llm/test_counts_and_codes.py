"""Phrase mining, vector codes and exact search against plain versions."""

import hashlib
import re
import tracemalloc
from collections import Counter
from decimal import Decimal

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapdelta.llm import inner_products, phrases, queries, vector_codes

# --- phrases -----------------------------------------------------------------------------------------


def plain_phrases(docs, longest=3, least=10, inside=50):
    """lang -> list of (phrase, a, l, r, n, score) in order."""
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, max(longest, 2) + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = {}
    for lang, c in counts.items():
        often = {p: a for p, a in c.items() if 2 <= len(p) <= longest and a >= least}
        rows = []
        for p, a in often.items():
            holds = lambda q: len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))  # noqa: B023, E731
            if any(holds(q) and 100 * f >= inside * a for q, f in often.items()):
                continue
            score, _, l, r = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((" ".join(p), a, l, r, totals[lang], score))
        out[lang] = sorted(rows, key=lambda x: (-x[5], -x[1], x[0].encode()))
    return {lang: rows for lang, rows in out.items() if rows}


def found_phrases(docs, **more):
    out = {}
    for r in phrases.phrases(docs, **more).orderBy("lang", "rank").collect():
        rows = out.setdefault(r["lang"], [])
        assert r["rank"] == len(rows) + 1
        rows.append((r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]))
    return out


@pytest.fixture(scope="module")
def prose(spark):
    from snapdelta.llm.common import ship

    ship(spark)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)] + ["Élan", "ÀB", "中文", "x\x1cy", "new", "york", "city"]
    rows = []
    for i in range(60):
        text = " ".join(words[min(int(rng.zipf(1.4)), len(words)) - 1] for _ in range(int(rng.integers(0, 300))))
        text = re.sub("w7 ", "w7. ", text).replace("w9 ", "w9\t") + " New York City" * (i % 3) + "\nnew york\r\n"
        rows.append((i, text, ["en", "fr", None, "und"][i % 4], "x", 5))
    rows += [(60, None, "en", "x", 5), (61, "", None, "x", 5), (62, " .,;\t!?\n ", "fr", "x", 5), (63, "only one", "rare", "x", 5), rows[5], rows[5]]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, tile STRING, n INT").repartition(5)


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_phrases(prose, longest):
    docs = [(r["lang"], r["text"]) for r in prose.collect()]
    got = found_phrases(prose, longest=longest, least=4)
    assert got == plain_phrases(docs, longest, 4)
    assert set(got) == {"en", "fr", "und"} and any(" " in p for p, *_ in got["und"])


def test_phrases_in_many_blocks_tiles_and_slices(prose, monkeypatch):
    """Blocks that end inside texts, open blocks that give way, narrow bands, sliced tiles."""
    docs = [(r["lang"], r["text"]) for r in prose.collect()]
    for name, value in {"BLOCK": 40, "OPEN": 90, "STRETCH": 50, "BAND": 4, "SLICE": 500, "PENDING": 8}.items():
        monkeypatch.setattr(phrases, name, value)
    assert _in_this_process(docs, 3, 4) == plain_phrases(docs, 3, 4)


def _in_this_process(docs, longest, least):
    """The steps of ``phrases`` with plain joins: workers do not see changed constants."""
    import pyspark

    class Context:
        @staticmethod
        def get():
            return Context()

        def partitionId(self):
            return 1

    real, pyspark.TaskContext = pyspark.TaskContext, Context
    try:
        batch = pa.RecordBatch.from_pydict(
            {"lang": ["und" if a is None else a for a, _ in docs], "text": pa.array([(b or "").encode() for _, b in docs], pa.binary())}
        )
        blocks = [b.to_pylist()[0] for b in phrases.word_blocks(iter([batch]), longest)]
    finally:
        pyspark.TaskContext = real
    assert len(blocks) > 100 and any(b["lead"] for b in blocks)
    f, totals = Counter(), Counter()
    for b in blocks:
        for w, n in zip(b["words"], b["counts"], strict=True):
            f[b["lang"], (w.decode(),)] += n
            totals[b["lang"]] += n
    counts = Counter(f)

    def numbers(grams):
        of = Counter()
        out = {}
        for lang, g in sorted((k for k in grams if grams[k] >= least), key=lambda k: (k[0], -grams[k], k[1])):
            out[lang, g] = of[lang]
            of[lang] += 1
        return out

    ids = numbers(f)
    mapped = {
        b["block"]: [(i, np.int64(ids[b["lang"], (w.decode(),)]).tobytes()) for i, w in enumerate(b["words"]) if (b["lang"], (w.decode(),)) in ids]
        for b in blocks
    }
    slices = max(1, -(-sum(totals.values()) // phrases.SLICE))
    assert slices > 1
    for size in range(2, longest + 1):
        kind = pa.list_(pa.struct([("first", pa.int32()), ("ids", pa.binary())]))
        tiles = []
        for b in blocks:
            row = {k: [b[k]] for k in ("block", "lang", "lead", "seq")}
            row["mapped"] = pa.array([[{"first": i, "ids": x} for i, x in mapped.get(b["block"], [])]], kind)
            for out in phrases.pair_tiles(iter([pa.RecordBatch.from_pydict(row)]), size, slices):
                tiles += out.to_pylist()
        packed = sorted((t for t in tiles if t["tile"] is not None), key=lambda t: (t["lang"], t["tile"], t["slice"]))
        assert len({(t["tile"], t["slice"]) for t in packed}) > 8
        columns = {k: [t[k] for t in packed] for k in ("lang", "tile", "slice", "codes", "counts")}
        often = [r for out in phrases.frequent_pairs(iter([pa.RecordBatch.from_pydict(columns)]), least) for r in out.to_pylist()]
        name = {(lang, i): g for (lang, g), i in ids.items()}
        grams = {(r["lang"], name[r["lang"], r["a"]] + name[r["lang"], r["b"]][-1:]): r for r in often}
        assert all(name[lang, r["a"]][1:] == name[lang, r["b"]][:-1] for (lang, _), r in grams.items())
        counts.update({k: r["f"] for k, r in grams.items()})
        ids = numbers({k: r["f"] for k, r in grams.items()})
        known = [(r["lang"], r["tile"], r["slice"], None, None, None, r["code"], ids[k]) for k, r in grams.items()]
        asked = [(t["lang"], t["tile"], t["slice"], t["block"], t["first"], t["codes"], None, None) for t in packed]
        both = sorted(known + asked, key=lambda x: (*x[:3], x[3] is not None))
        types = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*both, strict=True), types, strict=True)], list("abcdefgh"))
        mapped = {}
        for out in phrases.block_numbers(iter([batch])):
            for r in out.to_pylist():
                mapped.setdefault(r["block"], []).append((r["first"], r["ids"]))
        blocks = [t for t in tiles if t["tile"] is None]
    out = {}
    often = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    for (lang, p), a in often.items():
        if any(100 * often.get((lang, q), 0) >= 50 * a for q in {q for x, q in often if x == lang and len(q) == len(p) + 1 and p in (q[1:], q[:-1])}):
            continue
        score, _, l, r = min((10**6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((" ".join(p), a, l, r, totals[lang], score))
    return {lang: sorted(rows, key=lambda x: (-x[5], -x[1], x[0].encode())) for lang, rows in out.items()}


def test_phrase_limits_ties_and_none(spark, prose):
    every = found_phrases(prose, least=4, first=None)
    few = found_phrases(prose, least=4, first=3)
    assert few == {lang: rows[:3] for lang, rows in every.items()}
    assert phrases.phrases(prose.limit(0)).collect() == []
    one = spark.createDataFrame([(None,), ("",)], "text STRING").withColumn("lang", F.lit(None).cast("string"))
    assert phrases.phrases(one).collect() == []


def test_a_long_text_without_breaks(spark):
    text = "a b " * 600_000  # over one block and two stretches, one piece
    got = found_phrases(spark.createDataFrame([(text, "x"), ("z" * 3_000_000, "x")], "text STRING, lang STRING"))
    n = 1_200_000
    assert got["x"] == [(p, a, l, r, n + 1, 10**6 * a * a // (l * r)) for p, a, l, r in [("a b a", n // 2 - 1, n // 2, n // 2 - 1), ("b a b", n // 2 - 1, n // 2 - 1, n // 2)]] or {
        x[0]: x[1] for x in got["x"]
    } == {"a b a": n // 2 - 1, "b a b": n // 2 - 1}


def test_scores_beyond_64_bits(spark):
    a, l, r = 3_000_000_000_017, 4_000_000_000_000, 5_000_000_000_003
    row = spark.createDataFrame([(a, [l], [r])], "f BIGINT, before ARRAY<BIGINT>, after ARRAY<BIGINT>")
    assert row.select(phrases._cut(row).alias("c")).first()["c"]["score"] == 10**6 * a * a // (l * r)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(1, 9)), max_size=60), st.sampled_from([51, 64, 10**9]))
def test_merged_tiles(entries, area):
    codes, counts = (np.array([e[i] for e in entries], np.int64) for i in (0, 1))
    got = phrases.merged(codes, counts, area)
    want = Counter()
    for c, n in entries:
        want[c] += n
    assert dict(zip(*(x.tolist() for x in got), strict=True)) == want and got[0].tolist() == sorted(want)


def test_bands():
    n = np.arange(0, 100_000)
    b = phrases.band(n)
    assert (n >= phrases.band_start(b)).all() and (n < phrases.band_start(b) + [phrases.band_width(i) for i in b.tolist()]).all()


# --- vector codes ------------------------------------------------------------------------------------


def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Python integers only. ``rows``: (id, vector, label)."""
    ints = [[int(np.floor(np.float64(x) * scale)) for x in v] for _, v, _ in rows]
    width = len(ints[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in ints]
    start = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, ints[i]))[:entries]
    books = [[cut[i][p] for i in start] for p in range(parts)]
    best = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(best(v[p], books[p])[1], []).append(v[p])
            for e, vs in groups.items():
                books[p][e] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
    found = [[best(v[p], books[p]) for p in range(parts)] for v in cut]
    total = Counter()
    for (_, _, label), f in zip(rows, found, strict=True):
        total[label] += sum(d for d, _ in f)
    out = Counter()
    for (i, _, label), f in zip(rows, found, strict=True):
        out[i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), total[label]] += 1
    text = ",".join(str(x) for book in books for e in book for x in e)
    return out, hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(("n", "size", "scale"), [(700, 1.0, 1024), (90, 1.0, 1024), (60, 1e9, 1024), (300, 40.0, 3)])
def test_vector_codes(spark, n, size, scale):
    rng = np.random.default_rng(n)
    m = (size * rng.standard_normal((n, 8))).round(2)
    m[n // 3 : n // 2] = m[n // 3]  # copies and ties
    rows = [(i, v.tolist(), [None, "a", "b"][i % 3]) for i, v in enumerate(m)]
    rows += [rows[1], rows[1], (None, m[5].tolist(), "a")]
    odd = [(9000, None, "a"), (9001, [float("nan")] * 8, "a"), (9002, [None] + [1.0] * 7, "b"), (9003, [float("inf")] * 8, None), (9004, [], "b"), (9005, [1.0] * 3, "b")]
    df = spark.createDataFrame(rows + odd, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label STRING").withColumn("code", F.lit(1))
    coded, books = vector_codes.vector_codes(df.repartition(3), entries=64, scale=scale)
    want, digest = plain_codes(rows, entries=64, scale=scale)
    assert Counter((r["id"], r["code"], r["error"], r["label_error"]) for r in coded.collect()) == want
    assert vector_codes.digest(books) == digest


def test_no_vectors(spark):
    empty = spark.createDataFrame([(1, None, 1)], "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")
    coded, books = vector_codes.vector_codes(empty)
    assert coded.collect() == [] and books.shape[1] == 0
    assert inner_products.largest_products(empty, F.col("vec_id") % 100 == 0).collect() == []


def test_errors_beyond_a_long_are_told(spark):
    df = spark.createDataFrame([(0, [1e300] * 4, 1)], "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT")
    with pytest.raises(Exception, match="beyond what a long holds"):
        vector_codes.vector_codes(df)


# --- largest inner products --------------------------------------------------------------------------


def plain_products(rows, k=10, scale=1024):
    ints = {(i, tuple(int(np.floor(np.float64(x) * scale)) for x in v)) for i, v in rows}
    out = Counter()
    for q, a in ints:
        if q % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), c) for c, b in ints if c != q)[:k]
            out.update((q, rank, c, -s) for rank, (s, c) in enumerate(scores, 1))
    return out


def products_of(df, **more):
    return Counter(tuple(r) for r in inner_products.largest_products(df, F.col("vec_id") % 100 == 0, **more).collect())


ODD = [(10_000, None), (10_100, []), (10_200, [float("nan")] * 12), (10_300, [1.0] * 3), (10_400, [None] + [1.0] * 11), (None, [1.0] * 12), (10_500, [float("-inf")] * 12)]


@pytest.mark.parametrize(("size", "parts", "gather"), [(1.0, 2, 64), (1.0, 3, 1), (1e5, 2, 64), (4e5, 5, 10)])
def test_largest_products(spark, size, parts, gather):
    """Copies of one vector, near copies of another, zero vectors, ties, an id with two vectors;
    numbers that need doubles, 64 bits and more."""
    rng = np.random.default_rng(9)
    m = (size * rng.standard_normal((900, 12))).round(3)
    m[100:400] = m[100]
    m[400:600] = m[400] + 0.01 * size * rng.standard_normal((200, 12)).round(2)
    m[700:705] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(m)] + [(300, m[7].tolist()), (800, m[100].tolist())]
    df = spark.createDataFrame(rows + ODD + rows[:40], "vec_id BIGINT, embedding ARRAY<DOUBLE>").withColumn("score", F.lit("x"))
    assert products_of(df.repartition(4), parts=parts, gather=gather) == plain_products(rows)


@pytest.mark.parametrize("n", [1, 2, 7])
def test_fewer_candidates_than_asked(spark, n):
    rows = [(100 * i, [float(i - 1), 2.0]) for i in range(n)]
    assert products_of(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>")) == plain_products(rows)


def test_lists_give_little(spark):
    """The second phase collects a share of all pairs that falls as the table grows."""
    rng = np.random.default_rng(2)
    share = []
    for n in (500, 4000):
        q, c = rng.integers(-500, 500, (20, 64)), rng.integers(-500, 500, (n, 64))
        cutoff = np.sort(q @ c.T, axis=1)[:, -10]
        given = sum(int((2 * (q[:, s] @ c[:, s].T) >= cutoff[:, None]).sum()) for s in (slice(0, 32), slice(32, 64)))
        share.append(given / (20 * n))
    assert share[1] < 0.6 * share[0] and share[1] < 0.06


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.sampled_from([10, 2**20, 2**29, 2**31]), st.integers(0, 99))
def test_products_are_exact(n, size, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-size, size, (n, 4)), rng.integers(-size, size, (3, 4))
    want = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
    if max(abs(x) for r in want for x in r) < 2**63:
        assert inner_products.products(a, b).tolist() == want


# --- queries -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_and_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = queries.QUERIES[name](spark, folder)
    want = con.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    plain = lambda v: int(v) if isinstance(v, Decimal) else v
    want = Counter(tuple(plain(r[names.index(c)]) for c in df.columns) for r in want.fetchall())
    assert want and Counter(tuple(r) for r in df.collect()) == want


def test_blocks_of_a_batch_are_unpacked_one_by_one():
    """A batch holds many blocks; counting one of them must not copy the others."""
    n, words = 40, 50_000
    seq = (np.arange(words, dtype=np.int32) * 7919) % 97
    entry = pa.struct([("first", pa.int32()), ("ids", pa.int64())])
    mapped = [{"first": i, "ids": i} for i in range(97)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array(["en"] * n), pa.array([0] * n, pa.int32()),
         pa.array([seq.tobytes()] * n, pa.binary()), pa.array([mapped] * n, pa.list_(entry))],
        names=["block", "lang", "lead", "seq", "mapped"])
    tracemalloc.start()
    tiles = phrases.pair_tiles(iter([batch]), 2, 1)
    first = next(tiles).to_pylist()
    copied = sum(t.size for t in tracemalloc.take_snapshot().traces if t.size == seq.nbytes + 33)
    tracemalloc.stop()
    assert copied <= 3 * (seq.nbytes + 33) < n * seq.nbytes
    rest = [t.to_pylist() for t in tiles]
    assert len(rest) == n - 1
    pairs = Counter(zip(seq[:-1].tolist(), seq[1:].tolist()))
    for out in (first, *rest):
        counts = sum(np.frombuffer(r["counts"], np.uint32).sum() for r in out if r["counts"] is not None)
        codes = sum(len(r["codes"]) // 4 for r in out if r["codes"] is not None)
        assert (counts, codes) == (words - 1, len(pairs))
