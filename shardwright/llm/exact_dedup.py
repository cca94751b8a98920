"""Exact dedup: radix tries that own byte strings, one set of tries for each (length, content hash) partition.

1. Every map task normalises its texts and inserts them into a radix trie whose terminals hold the smallest id and a
   count, so a task sends each different text once, however many copies it has. A trie over its byte bound spills its
   largest subtree: those owners go on as rows and leave the trie.
2. The rows meet by (length, hash). A second trie for each such key takes the full byte strings; its terminals are the
   owners. What reaches one key is at most one row for each map task and spill, so a group with a third of all rows
   isn't gathered.
3. Documents look up their owner by (length, hash) in a shuffled equi-join that adaptive execution can split. Only
   owners of two or more rows take part.

Null text is the empty text. Null ids never own a group that has another id; a group of null ids only has a null
keep_id and its rows are kept. Rows that repeat the smallest id are all kept and counted (see first_rows()). An empty
table gives an empty result. Columns other than id and text are neither read nor able to clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, rows, single_spaced, texts

#: Bytes of text that a map task's trie may hold before it spills a subtree.
TRIE_BYTES = 64 << 20


class _Node:
    __slots__ = ("label", "kids", "low", "count")

    def __init__(self, label: bytes):
        self.label, self.kids, self.low, self.count = label, None, None, 0


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


class RadixTrie:
    """Byte strings with compressed edges; a terminal has count > 0 and the smallest id seen (None: no id)."""

    def __init__(self) -> None:
        self.root, self.bytes = _Node(b""), 0

    def insert(self, key: bytes, low: int | None, count: int = 1) -> None:
        node, at = self.root, 0
        while at < len(key):
            kids = node.kids
            if kids is None:
                kids = node.kids = {}
            kid = kids.get(key[at])
            if kid is None:
                kid = kids[key[at]] = _Node(key[at:])
                self.bytes += len(kid.label) + 200
                node, at = kid, len(key)
                break
            label = kid.label
            if key.startswith(label, at):
                node, at = kid, at + len(label)
                continue
            same = _common(label, key, at)
            fork = _Node(label[:same])
            kid.label = label[same:]
            fork.kids = {kid.label[0]: kid}
            kids[key[at]] = fork
            self.bytes += 200
            node, at = fork, at + same
        node.low = low if not node.count else _least(node.low, low)
        node.count += count

    def owners(self, node: _Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, int | None, int]]:
        todo = [(node or self.root, prefix)]
        while todo:
            node, before = todo.pop()
            key = before + node.label
            if node.count:
                yield key, node.low, node.count
            if node.kids:
                todo += [(kid, key) for kid in node.kids.values()]

    def spill(self) -> Iterator[tuple[bytes, int | None, int]]:
        """Empties the largest subtree below the root."""
        sizes = {k: sum(len(x) + 200 for x, _, _ in self.owners(n)) for k, n in (self.root.kids or {}).items()}
        if sizes:
            k = max(sizes, key=sizes.get)
            yield from self.owners(self.root.kids.pop(k))
            self.bytes = sum(v for i, v in sizes.items() if i != k)


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of label and key[at:], by halving."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[low:mid] == key[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


_OWNER = "n_len long, text_sha256 string, body binary, low long, n long"
_OWNER_ARROW = pa.schema(
    [("n_len", pa.int64()), ("text_sha256", pa.string()), ("body", pa.binary()), ("low", pa.int64()), ("n", pa.int64())]
)


def _owner_rows(found: Iterator[tuple[bytes, int | None, int]], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    part, held = [], 0
    for body, low, n in found:
        part.append((len(body), hashlib.sha256(body).hexdigest(), body, low, n))
        held += len(body) + 100
        if held > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), _OWNER_ARROW)], schema=_OWNER_ARROW)
            part, held = [], 0
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), _OWNER_ARROW)], schema=_OWNER_ARROW)


def _local_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = RadixTrie()
    for ids, bodies in rows(batches, "doc_id", "text"):
        for i, t in zip(ids, bodies):
            trie.insert(single_spaced(t.encode()), i)
        while trie.bytes > TRIE_BYTES:
            yield from _owner_rows(trie.spill())
    yield from _owner_rows(trie.owners())


def _final_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (n_len, text_sha256): one key's trie at a time."""
    out = pa.schema([("n_len", pa.int64()), ("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
    key, trie, done = None, RadixTrie(), []

    def close() -> None:
        if key is not None:
            owners = list(trie.owners())
            if len(owners) > 1:
                raise ValueError(f"two texts of {key[0]} bytes share the hash {key[1]}")
            if owners[0][2] > 1:
                done.append((*key, owners[0][1], owners[0][2]))

    for n_len, sha, body, low, n in (r for part in rows(batches, "n_len", "text_sha256", "body", "low", "n") for r in zip(*part)):
        if (n_len, sha) != key:
            close()
            key, trie = (n_len, sha), RadixTrie()
            if len(done) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), out)], schema=out)
                done.clear()
        trie.insert(body, low, n)
    close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), out)], schema=out)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_len, shas = [], []
        for (bodies,) in rows(iter([batch]), "text"):
            for t in bodies:
                body = single_spaced(t.encode())
                n_len.append(len(body))
                shas.append(hashlib.sha256(body).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_len, pa.int64()), pa.array(shas, pa.string())], names=["doc_id", "n_len", "text_sha256"]
        )


def owners(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(n_len, text_sha256, keep_id, group_size) of each text that two or more rows have."""
    local = texts(df, id_col, text_col).mapInArrow(_local_owners, _OWNER)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = local.repartition(n, "n_len", "text_sha256").sortWithinPartitions("n_len", "text_sha256")
    return met.mapInArrow(_final_owners, "n_len long, text_sha256 string, keep_id long, group_size long")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    keyed = texts(df, id_col, text_col).mapInArrow(_keys, "doc_id long, n_len long, text_sha256 string")
    found = owners(df, id_col, text_col)
    out = keyed.join(found, ["n_len", "text_sha256"], "left")
    alone = F.col("group_size").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


QUERIES = {"op6_exact_dedup": op6_exact_dedup}
ORACLES = {
    "op6_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
     g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g USING (body)"""
}
