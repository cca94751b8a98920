"""Byte-level BPE encoding and decoding as a monoid over a tree of halves.

The pattern cuts a text into pre-tokens; merges never cross them, so joining there is concatenation. Within a
pre-token the bytes are halved down to LEAF bytes, leaves are merged pair by pair (the lowest rank first, of equal ones
the leftmost), and neighbours are joined by encoding the bytes of a window over the boundary anew. The window grows,
twofold on the side that isn't settled, until the tokens outside provably stay: a sequence of tokens is the encoding of
its bytes if and only if each two neighbours are the encoding of their own joint bytes, which holds for rank files in
which every token encodes to itself (checked when the ranks are loaded). So it is enough that the window's first and
last tokens stand well with their neighbours outside. Decoding halves the ids and concatenates up the tree.

Null text is the empty text: 0 tokens. A text of any length is walked SPAN pre-tokens at a time. Ids and other columns
are passed by; null ids stay null; repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, forget, kept, rows, texts

LEAF = 6
#: Ids that a leaf of the decoding tree joins at once.
LEAF_IDS = 1 << 10
#: Pre-tokens of a text that are encoded before their ids are hashed and let go.
SPAN = 1 << 16
#: Bytes of pre-tokens and their ids that a worker remembers; beyond, it forgets them all and starts anew. Longer
#: pre-tokens than LONG bytes aren't remembered.
MEMO, LONG = 64 << 20, 256
#: Tokens beyond which a merge keeps its pairs in a heap.
HEAP = 24
NO_RANK = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Memo(dict):
    """Encodings of pre-tokens, each found when first asked for."""

    def __init__(self, encode: Callable[[bytes], list[int]]):
        self.encode, self.size = encode, 0

    def __missing__(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        found = tuple(self.encode(data))
        if len(data) <= LONG:
            if self.size > MEMO:
                self.clear()
                self.size = 0
            self.size += 240 + 2 * len(data) + 8 * len(found)
            self[piece] = found
        return found


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.text_of = {r: str(r) for r in self.bytes_of}
        self.memo = Memo(self.encode_piece)
        self.leaves: dict[bytes, list[int]] = {}
        #: Of two neighbours, the encoding of their joint bytes.
        self.pairs: dict[tuple[int, int], list[int]] = {}

    def check(self) -> None:
        """The condition under which neighbours decide: every token is the encoding of its own bytes."""
        for b, r in self.ranks.items():
            halves = self.join(self.merge(b[: len(b) // 2]), self.merge(b[len(b) // 2 :])) if len(b) > 1 else [r]
            if self.merge(b) != [r] or halves != [r]:
                raise ValueError(f"token {r} doesn't encode to itself")

    # leaves and windows

    def merge(self, data: bytes) -> list[int]:
        """Merges single bytes, always the pair of the lowest rank, of equal ones the leftmost."""
        if len(data) > HEAP:
            return self._merge_long(data)
        rank, parts = self.ranks.get, [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2], NO_RANK) for i in range(len(data) - 1)]
        while pairs and (least := min(pairs)) < NO_RANK:
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], NO_RANK)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], NO_RANK)
        return [self.ranks[x] for x in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap of pairs: begins of the left part, ends of both; stale pairs are passed by."""
        n, rank = len(data), self.ranks.get
        end, start_of = list(range(1, n + 1)), list(range(-1, n))  # a part's end by its begin; the begin of the part before
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(data[i : i + 2])) is not None]
        heapify(heap)
        gone = bytearray(n + 1)
        while heap:
            _, i, j, k = heappop(heap)
            if gone[i] or end[i] != j or j >= n or gone[j] or end[j] != k:
                continue
            gone[j], end[i] = 1, k
            if k < n:
                start_of[k] = i
                if (r := rank(data[i : end[k]])) is not None:
                    heappush(heap, (r, i, k, end[k]))
            if (h := start_of[i]) >= 0 and (r := rank(data[h:k])) is not None:
                heappush(heap, (r, h, i, k))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : end[i]]])
            i = end[i]
        return out

    def _leaf(self, data: bytes) -> list[int]:
        found = self.leaves.get(data)
        if found is None:
            if len(self.leaves) > 100_000:
                self.leaves.clear()
            found = self.leaves[data] = self.merge(data)
        return found

    def _window(self, ids: list[int]) -> list[int]:
        return self.merge(b"".join(map(self.bytes_of.__getitem__, ids)))

    # the tree

    def pair(self, left: int, right: int) -> list[int]:
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) > 200_000:
                self.pairs.clear()
            found = self.pairs[left, right] = self.merge(self.bytes_of[left] + self.bytes_of[right])
        return found

    def stable(self, left: int, right: int) -> bool:
        return self.pair(left, right) == [left, right]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left + right
        a = b = 1
        inner = self.pair(left[-1], right[0])
        if len(inner) == 2 and inner[0] == left[-1]:
            return left + right
        while True:
            held = a == len(left) or self.stable(left[-a - 1], inner[0])
            holds = b == len(right) or self.stable(inner[-1], right[b])
            if held and holds:
                return left[:-a] + inner + right[b:]
            a, b = min(a if held else 2 * a, len(left)), min(b if holds else 2 * b, len(right))
            inner = self._window(left[-a:] + right[:b])

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) <= LEAF:
            return self._leaf(data)
        mid = len(data) // 2
        return self.join(self.encode_piece(data[:mid]), self.encode_piece(data[mid:]))

    def encode_spans(self, text: str) -> Iterator[list[int]]:
        """Ids of SPAN pre-tokens at a time."""
        found = self.pattern.findall(text) if len(text) <= SPAN else (m[0] for m in self.pattern.finditer(text))
        found = iter(found)
        while pieces := list(islice(found, SPAN)):
            yield list(chain.from_iterable(map(self.memo.__getitem__, pieces)))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.encode_spans(text)))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


def _codec(shared) -> Codec:  # noqa: ANN001  a Broadcast of (ranks, pattern)
    ranks, pattern = shared.value
    codec = kept("bpe", lambda: Codec(ranks, pattern))
    if codec.ranks is not ranks or codec.pattern.pattern != pattern:
        forget()
        codec = kept("bpe", lambda: Codec(ranks, pattern))
    return codec


_CHECKED: set[int] = set()


def shared_codec(spark: SparkSession, path: str, pattern: str):  # noqa: ANN201
    """The rank file, some hundred thousand bytes whatever the input, goes to the executors from the driver."""
    ranks = read_ranks(path)
    key = hash(tuple(ranks.items()))
    if key not in _CHECKED:
        Codec(ranks, pattern).check()
        _CHECKED.add(key)
    return spark.sparkContext.broadcast((ranks, pattern))


def digests(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row: encoded, decoded again from the ids."""
    shared = shared_codec(df.sparkSession, path, pattern)

    def digest(text: str) -> tuple[int, str, str]:
        codec = _codec(shared)
        as_text = codec.text_of.__getitem__
        n, forth, back = 0, hashlib.sha256(), hashlib.sha256()
        for ids in codec.encode_spans(text):
            forth.update(("," * bool(n) + ",".join(map(as_text, ids))).encode())
            back.update(codec.decode(ids))
            n += len(ids)
        return n, forth.hexdigest(), back.hexdigest()

    # a hundred rows at a time, not an Arrow batch: those are of up to 64 MB, held several times over outside the heap
    found = F.udf(digest, "n_tokens long, ids_sha256 string, decoded_sha256 string", useArrow=False)
    return texts(df, id_col, text_col).select("doc_id", found("text").alias("found")).select("doc_id", "found.*")


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids: what a training job reads."""
    shared = shared_codec(df.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for ids, part in rows(batches, "doc_id", "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([codec.encode(t) for t in part], pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids -> doc_id, text (binary: the bytes of the ids in a row; null ids are none)."""
    shared = shared_codec(df.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for keys, ids in rows(batches, "doc_id", "ids"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([codec.decode(x or []) for x in ids], pa.binary())], names=["doc_id", "text"]
            )

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, text binary")


def production(df: DataFrame) -> DataFrame:
    import public_tokenizers as vocabularies

    return digests(df, vocabularies.path("byte_bpe_multi_50k.tiktoken"), vocabularies.PATTERN)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return production(documents(spark, sf_dir))


QUERIES = {"op2_byte_bpe": op2_byte_bpe}
ORACLES: dict[str, str] = {}
