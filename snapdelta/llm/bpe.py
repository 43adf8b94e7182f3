"""Byte-level BPE encoding and decoding by a monoid tree reduction.

A piece of text is cut into halves until they are short, halves are encoded on their
own, and neighbours are joined: the tokens around the boundary are encoded again as
one window, which grows until the tokens outside it cannot change. That is decided
exactly. Merges go in order of rank, so a sequence of tokens is *the* encoding of its
bytes if and only if every two neighbours are the encoding of their own bytes: a
merge across a boundary would happen in the same state in the pair alone. Joining is
associative with the empty sequence as unit, and decoding concatenates up the tree.

Texts are first cut into pieces by the tokenizer's pattern; a piece that is a token
is that token, as tiktoken has it. Texts of any length are read whole, each in one
task. A null text is empty and has no tokens.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import OTHER_SPACE, Rows

LEAF = 8
SHORT = 24
CACHE = 1_000_000
LONG = 64
NONE = 1 << 60


def plain_spaces(text: str) -> bool:
    """Whether every space parts two words: no other white space next to it or at an edge."""
    odd = "  " in text or " \n" in text or "\n " in text or any(c in text for c in "\t\r\x0b\x0c")
    return not (odd or text[0].isspace() or text[-1].isspace() or OTHER_SPACE.search(text))


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: a base64 token and its number a line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) }


class Encoder:
    """Encodes and decodes with one table of ranks; keeps what it has met before."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.reset()

    def reset(self) -> None:
        """Forget what was met before."""
        self.leaves: dict[bytes, tuple[bytes, ...]] = {}
        self.stable: dict[tuple[bytes, bytes], bool] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.rows = Rows()
        #: Of each chunk in ``rows``: its ids, the same as text, and the bytes they decode to.
        self.ids: list[tuple[int, ...]] = []
        self.texts: list[str] = []
        self.bytes: list[bytes] = []

    def merged(self, data: bytes) -> Sequence[bytes]:
        """Tokens of ``data`` by merging the neighbours of lowest rank, leftmost first."""
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        if len(data) <= SHORT:
            get = ranks.get
            found = [get(a + b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
            while found and (best := min(found)) < NONE:
                at = found.index(best)
                joined = parts[at] + parts.pop(at + 1)
                parts[at] = joined
                found.pop(at)
                if at:
                    found[at - 1] = get(parts[at - 1] + joined, NONE)
                if at < len(found):
                    found[at] = get(joined + parts[at + 1], NONE)
            return parts
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        alive = list(parts)

        def push(i: int) -> None:
            j = after[i]
            if j < n and (r := ranks.get(alive[i] + alive[j])) is not None:
                heapq.heappush(heap, (r, i, alive[i], alive[j]))

        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] is not None else n
            if j >= n or alive[i] != a or alive[j] != b:
                continue
            alive[i], alive[j] = a + b, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [t for t in alive if t is not None]

    def neighbours(self, a: bytes, b: bytes) -> bool:
        """Whether ``a, b`` is the encoding of their bytes."""
        key = (a, b)
        known = self.stable.get(key)
        if known is None:
            known = self.stable[key] = tuple(self.merged(a + b)) == key
        return known

    def join(self, left: Sequence[bytes], right: Sequence[bytes]) -> Sequence[bytes]:
        """The encoding of two neighbouring encodings' bytes."""
        if not left or not right or self.neighbours(left[-1], right[0]):
            return [*left, *right]
        i, j = 1, 1
        while True:
            middle = self.merged(b"".join([*left[len(left) - i :], *right[:j]]))
            ahead = i == len(left) or self.neighbours(left[-i - 1], middle[0])
            behind = j == len(right) or self.neighbours(middle[-1], right[j])
            if ahead and behind:
                return [*left[: len(left) - i], *middle, *right[j:]]
            i = i if ahead else min(2 * i, len(left))
            j = j if behind else min(2 * j, len(right))

    def tree(self, data: bytes) -> Sequence[bytes]:
        if len(data) <= LEAF:
            known = self.leaves.get(data)
            if known is None:
                known = self.leaves[data] = tuple(self.merged(data))
            return known
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def piece(self, piece: str) -> tuple[int, ...]:
        known = self.pieces.get(piece)
        if known is None:
            data = piece.encode()
            rank = self.ranks.get(data)
            known = (rank,) if rank is not None else tuple([self.ranks[t] for t in self.tree(data)])
            if len(piece) <= LONG:
                self.pieces[piece] = known
        return known

    def chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of a text without spaces but at its start; letters need no pattern."""
        word = chunk[1:] if chunk[:1] == " " else chunk
        if word.isalpha():
            return self.piece(chunk)
        if word[:-1].isalpha() and word[-1] in ".,":
            return self.piece(chunk[:-1]) + self.piece(chunk[-1])
        return tuple([i for p in self.pattern.findall(chunk) for i in self.piece(p)])

    def chunks(self, text: str) -> list[int]:
        """Rows of the text's chunks. Where single spaces part its words, the pattern
        always begins a match at the space, so words can be looked up with theirs."""
        if max(len(self.rows), len(self.leaves), len(self.stable), len(self.pieces)) > CACHE:
            self.reset()  # so that a worker's memory stays bounded
        if not text:
            return []
        if plain_spaces(text):
            parts = text.replace(" ", "\0 ").split("\0") if "\0" not in text else self.pattern.findall(text)
        else:
            parts = self.pattern.findall(text)
        rows = list(map(self.rows.__getitem__, parts))
        new, self.rows.new = self.rows.new, []
        for c in new:
            ids = self.chunk(c)
            self.ids.append(ids)
            self.texts.append(",".join(map(str, ids)))
            self.bytes.append(self.decode(ids))
        return rows

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text."""
        return [i for r in self.chunks(text or "") for i in self.ids[r]]

    def round_trip(self, text: str | None) -> tuple[int, str, bytes]:
        """Number of ids, the ids as text, and what they decode to, concatenated from the
        chunks' own encodings and decodings."""
        rows = self.chunks(text or "")
        known = self.ids
        n = sum([len(known[r]) for r in rows])
        return n, ",".join(map(self.texts.__getitem__, rows)), b"".join(map(self.bytes.__getitem__, rows))

    def decode(self, ids: Sequence[int]) -> bytes:
        if len(ids) <= 4096:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_encoders: dict[str, Encoder] = {}


def _mapped(
    docs: DataFrame, rank_file: str, pattern: str, columns: str, fn: Callable[[Encoder, str | None], tuple]
) -> DataFrame:
    """``doc_id`` and the values ``fn`` gives for each text."""
    with open(rank_file, "rb") as f:
        content = f.read()
    key = hashlib.sha256(content + pattern.encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(content)  # a vocabulary: the same size for any corpus
    schema = pa.schema([pa.field(n, {"BIGINT": pa.int64(), "STRING": pa.string(), "BINARY": pa.binary(), "ARRAY<INT>": pa.list_(pa.int32())}[t]) for n, t in (c.split(" ") for c in columns.split(", "))])
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _encoders:
            _encoders[key] = Encoder(read_ranks(shared.value), pattern)
        for b in batches:
            rows = [fn(_encoders[key], t) for t in b.column("text").to_pylist()]
            values = zip(*rows, strict=True) if rows else [()] * len(schema)
            arrays = [pa.array(v, f.type) for v, f in zip(values, schema, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *arrays], names=["doc_id", *schema.names])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {columns}")


def encoded(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every whole text."""
    return _mapped(docs, rank_file, pattern, "ids ARRAY<INT>", lambda e, t: (e.encode(t),))


def decoded(rows: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; the bytes may be any, so ``text`` is binary."""
    ids = rows.select("doc_id", rows["ids"].alias("text"))
    return _mapped(ids, rank_file, pattern, "text BINARY", lambda e, i: (e.decode(i or []),))


def _digest(encoder: Encoder, text: str | None) -> tuple[int, str, str]:
    n, ids, data = encoder.round_trip(text)
    return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(data).hexdigest()


def round_trips(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Every text encoded and its ids decoded again, as digests: ids need not leave the task."""
    return _mapped(docs, rank_file, pattern, "n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING", _digest)
