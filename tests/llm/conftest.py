import hashlib

import pytest

SPACES = "\t\n\x0b\x0c\r "


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with nulls, empty and long texts, copies, shared passages, repeated rows
    and columns whose names operators might use themselves."""
    from snapdelta.llm.common import ship

    ship(spark)
    word = lambda i: hashlib.md5(str(i).encode()).hexdigest()[: 3 + i % 6]
    prose = lambda seed, n: " ".join(word((seed * 7919 + i * i * 31 + i) % 4000) for i in range(n))
    passage = prose(999, 60)
    base = prose(5, 200)
    near = base.split(" ")
    near[40] = "changed"
    texts = [
        None,
        "",
        " \n\t ",
        "one",
        "three short words",
        prose(1, 120),
        prose(1, 120),
        base,
        " ".join(near),
        prose(2, 50) + "\n" + passage + "\n" + prose(3, 40),
        prose(4, 30) + " " + passage,
        passage + " " + prose(6, 20) + " " + passage,
        "ab " * 300,
        "line of text\nline of text\n" * 40,
        "x" * 5000,
        "é" * 150 + " ñandú " + "é" * 150,
        "中文   text with \x1c odd spaces  and   runs\r\n",
        prose(8, 3000),
        "$$$ ### %%% " * 30 + prose(9, 40),
    ]
    rows = [(i, t, ["en", "fr", None][i % 3], ["s1", None][i % 2], "x", 1, "y") for i, t in enumerate(texts)]
    rows += [(5, texts[5], "en", "s1", "x", 1, "y"), (None, prose(12, 40), None, None, None, None, None)]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, _score STRING, piece INT, canopy STRING"
    return spark.createDataFrame(rows, schema).coalesce(3)


@pytest.fixture
def empty(spark, corpus):
    return spark.createDataFrame([], corpus.schema)


@pytest.fixture
def texts(corpus):
    return {(r["doc_id"], r["text"]): r["text"] for r in corpus.select("doc_id", "text").collect()}
