"""WARC round trips and neighbour search."""

import base64
import hashlib
import io
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapdelta.llm import neighbours, warc


@pytest.fixture(scope="module")
def pages(spark):
    from snapdelta.llm.common import ship

    ship(spark)
    rows = [(i, f"http://h{i % 4}/a b\n{i}", ["same", "é中" * 50, None, "", f"own {i}"][i % 5], "x") for i in range(60)]
    rows += [(0, "http://again", "same", "x"), (None, None, "same", None), (70, "u", "\x1f\x8b\x08 fake magic " * 900, None)]
    return spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING, refers_to STRING").repartition(3)


def want(pages):
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    first = {}
    for i, data in rows:
        if i is not None and (data not in first or i < first[data]):
            first[data] = i
    out = Counter()
    for i, data in rows:
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        response = first.get(data, i) == i
        out[i, len(data), digest, "response" if response else "revisit", None if response else first[data]] += 1
    return out


def test_round_trip(spark, pages):
    files = warc.write_archives(pages)
    for split in (warc.SPLIT, 700):
        records = warc.read_archives(spark, files, split)
        got = Counter(tuple(r) for r in warc.page_records(records).collect())
        assert got == want(pages)
    payloads = {bytes(r["payload"]) for r in records.filter("record_type = 'response'").collect()}
    assert payloads == {(r["html"] or "").encode() for r in pages.collect()}
    assert {r["url"] for r in records.collect()} == {r["url"] for r in pages.collect()}
    assert warc.read_archives(spark, warc.write_archives(pages.limit(0))).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=300) | st.just(warc.MAGIC * 40), max_size=12), st.integers(1, 900))
def test_every_record_has_one_owner(payloads, split):
    members = [warc.member(warc.record(i, None, p, None, warc.DATE)) for i, p in enumerate(payloads)]
    data = b"".join(members)
    got = [r for at in range(0, len(data), split) for r in warc.records_in(io.BytesIO(data), len(data), at, min(len(data), at + split))]
    assert [r.payload for r in got] == payloads


def test_broken_members_are_skipped():
    good = [warc.member(warc.record(i, "http://x", b"payload %d" % i, None, warc.DATE)) for i in range(3)]
    data = good[0] + warc.MAGIC + b"junk" * 20 + good[1] + warc.member(b"not a record") + good[2][:-9]
    got = list(warc.records_in(io.BytesIO(data), len(data), 0, len(data)))
    assert [r.payload for r in got] == [b"payload 0", b"payload 1"]


def test_lost_records_are_told(spark):
    import pathlib

    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i} " * 50) for i in range(30)], "page_id BIGINT, url STRING, html STRING")
    files = warc.write_archives(pages.repartition(2))
    assert warc.lost_records(files, warc.read_archives(spark, files)).isEmpty()
    path = pathlib.Path(files.orderBy("path").first()["path"].removeprefix("file:"))
    data = bytearray(path.read_bytes())
    at = data.find(warc.MAGIC, 100)
    data[at + 20 : at + 40] = b"\0" * 20
    path.write_bytes(bytes(data))
    path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    lost = warc.lost_records(files, warc.read_archives(spark, files)).collect()
    assert len(lost) == 1 and lost[0]["records"] - lost[0]["found"] == 1


def test_a_large_record_is_read_in_linear_time():
    import time

    data = warc.member(warc.record(1, "http://x", np.random.default_rng(1).bytes(60_000_000), None, warc.DATE))
    began = time.process_time()
    got = list(warc.records_in(io.BytesIO(data), len(data), 0, len(data)))
    assert len(got) == 1 and len(got[0].payload) == 60_000_000
    assert time.process_time() - began < 20


def exact(rows, k=10):
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows], float)
    out = {}
    for i, q in rows:
        if i % 100 == 0:
            d = np.sqrt(((m - np.array(q, float)) ** 2).sum(1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(6)
    m = rng.standard_normal((1500, 16)).astype(np.float32)
    m[200:700] = m[200]  # a vector that a third of all rows share
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    odd = [(10_000, None), (10_100, [0.0] * 16), (10_200, [float("nan")] * 16), (10_300, [1.0] * 3), (10_400, [None] + [1.0] * 15), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows + odd + rows[:50], "vec_id BIGINT, embedding ARRAY<FLOAT>").withColumn("rank", F.lit("x"))
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    expected = exact(rows)
    assert set(got) == set(expected)
    hits = 0
    for q, found in got.items():
        assert [x[2] for x in found] == list(range(1, 11))
        assert [x[:2] for x in found] == sorted((x[:2] for x in found), key=lambda x: (x[1], x[0]))
        hits += len({x[0] for x in found} & {x[0] for x in expected[q]})
        truth = dict(exact(rows, 1500)[q]) if q in (0, 200) else {}
        assert all(score == pytest.approx(truth.get(v, score), abs=1e-12) for v, score, _ in found)
    assert hits / (10 * len(got)) >= 0.9
    assert [x[:2] for x in got[300]] == [(i, 0.0) for i in range(200, 210)]


def test_few_vectors_and_none(spark):
    schema = "vec_id BIGINT, embedding ARRAY<FLOAT>"
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 9.0]), (2, [5.0, 5.0]), (100, [1.0, 0.0])], schema)
    rows = {(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).collect()}
    assert rows == {(0, 1, 100), (0, 2, 2), (0, 3, 1), (100, 1, 0), (100, 2, 2), (100, 3, 1)}
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert neighbours.nearest(df, F.col("vec_id") < 0).count() == 0


@pytest.mark.parametrize("share", [3, 2])
def test_recall_beside_a_dense_cluster(spark, share):
    rng = np.random.default_rng(7)
    m = rng.standard_normal((2100, 64))
    m[: 2100 // share] = m[0] + 0.01 * rng.standard_normal((2100 // share, 64))  # near copies, not equal ones
    ids = rng.permutation(2100).tolist()
    rows = [(i, v.tolist()) for i, v in zip(ids, m, strict=True)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 10 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    vids, recall = np.array(ids), {}
    for i, q in zip(ids, m, strict=True):
        if i % 10 == 0:
            d = ((m - q) ** 2).sum(1)
            recall[i] = len(got[i] & set(vids[np.lexsort((vids, d))][1:11].tolist())) / 10
    outside = [recall[i] for i in ids[2100 // share :] if i in recall]
    assert np.mean(list(recall.values())) >= 0.9
    assert np.mean(outside) >= 0.9
