"""SimHash near-dedup: fingerprints of word shingles, linked by multi-index hashing.

A fingerprint is cut into segments of SEGMENT bits; each has a table from its values to the fingerprints that have them.
Small Hamming balls within a segment are enumerated, table matches fetched, and complete distances verified. Two forms:

near_duplicates(): 64 bits, linked at MOST_BITS = 2 differing bits or fewer, without a loss. Then one of two segments
differs in one bit at most. A fingerprint probes each table with its own value and with each of its 0-bits set (of two
values one bit apart, one has the 0). A table entry of over CROWD fingerprints isn't fetched: all that touch one are
linked by balls of radius 1 over the whole fingerprint instead, in which both sides meet in the middle. Such an entry
has at most 65 members, and its members link to its least one, so a crowd of any size costs 65 rows a fingerprint.

near_copies(): texts whose shingle sets are alike in LEAST or more. A fingerprint has 512 bits in 16 segments, as 0.8 of alikeness leaves
one bit in seven different, and differing bits are mostly those whose counts were nearly even. So a segment's ball
are all settings of its WEAK weakest bits, on both sides. Members of an entry are paired with its first one, in an order
of the entry's own. A pair links if its complete distance is FAR or less and then the shingle sets
themselves, compared in full, are alike enough. Pairs that differ in other bits than the weak ones are missed by this, so
an exact pass follows, over pairs whose texts the fingerprints' links leave in different components. Two texts alike in
LEAST share a shingle among the first of each, n - ceil(LEAST * n) + 1 of n, in any one order of all shingles. The order
is that of a sample's frequencies, so that shared ones are rare; what the sample says changes cost, never links. Pairs
that meet are kept if their places in the order and their sizes leave enough to share, if the parities of their
shingles in BITS bins differ in no more bins than the sets may, and then by comparison in full.

Null text is the empty text. near_duplicates(): it has no word, fingerprint zero, linked like any other; null ids take part
in no component number (component_id is null only where no id of a component is known); repeated rows are rows of their
own. near_copies(): texts are known by their 64-bit hash, so rows that repeat an id with other texts are apart; texts without a
word are in no group; a text of fewer words than a shingle is one shingle. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import amid, documents, dropped, forget, rows, texts, written
from .components import components

SEED, WORDS, MOST_BITS = 42, 3, 2
#: Bits of a segment; a table entry that is fetched has at most CROWD fingerprints.
SEGMENT, CROWD = 32, 64
#: near_copies(): words of a shingle, least similarity, 64-bit parts of a fingerprint, weak bits of a segment, complete distance.
LONG_WORDS, LEAST, PARTS, WEAK, FAR = 5, 0.8, 8, 2, 120
TABLES = 64 * PARTS // SEGMENT
#: The exact pass: bins of parities; one text of SAMPLED tells frequencies, those of OFTEN or more, HEAD shingles at most.
BITS, SAMPLED, OFTEN, HEAD = 1024, 16, 3, 200_000
#: Rounding that comparisons of sizes forgive.
SLACK = 1e-6
#: Hashes of shingles that a task comparing pairs remembers.
SHINGLED = 1 << 22
#: Shingles hashed before their bits are counted.
CHUNK = 1 << 14
_MIX = np.random.default_rng(64).integers(0, 1 << 63, (3, PARTS), np.uint64) * np.uint64(2) + np.uint64(1)


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many rows have each bit; h: rows of 64-bit parts."""
    bits = np.unpackbits(h.view(np.uint8).reshape(len(h), -1), axis=1, bitorder="little")
    total = np.zeros(bits.shape[1], np.int64)
    for at in range(0, len(bits), 255):  # as many as a byte can count
        total += bits[at : at + 255].sum(0, dtype=np.uint8)
    return total


def _hashes(words: list[bytes], n_words: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles, repeats included, CHUNK at a time; of fewer words, of the whole sequence."""
    hashed, form = xxhash.xxh64_intdigest, b" ".join([b"%b"] * min(n_words, len(words)))
    n = len(words) - n_words + 1
    for at in range(0, max(1, n), CHUNK):
        part = words[at : at + CHUNK + n_words - 1]
        yield np.array([hashed(form % t, seed) for t in zip(*(part[k:] for k in range(min(n_words, len(words)))))], np.uint64)


def fingerprint(text: bytes, n_words: int = WORDS, seed: int = SEED) -> int:
    """Bit b is 1 if it is set in over half of the hashes of all shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    n, ones = 0, np.zeros(64, np.int64)
    for h in _hashes(words, n_words, seed):
        n += len(h)
        ones += _bit_counts(h.reshape(-1, 1))
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in batches:
        out = [fingerprint(t.encode()) for (part,) in rows(iter([batch]), "text") for t in part]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(out, np.uint64).view(np.int64))], names=["doc_id", "fp"])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return texts(df, id_col, text_col).mapInArrow(_fingerprints, "doc_id long, fp long")


def _tables() -> list[str]:
    """Of each segment, its number and value in one long."""
    low = f"(fp & {(1 << SEGMENT) - 1}L)"
    return [low, f"(shiftrightunsigned(fp, {SEGMENT}) | {1 << SEGMENT}L)"]


def _met_in_balls(crowd: DataFrame) -> DataFrame:
    """(a, b): links of the members of each entry, of the radius-1 balls of whole fingerprints, to its least one."""
    ball = F.expr(f"array(fp, {', '.join(f'fp ^ shiftleft(1L, {b})' for b in range(64))})")
    met = crowd.select("fp", F.explode(ball).alias("entry")).groupBy("entry").agg(F.collect_list("fp").alias("members")).where("size(members) > 1")
    return met.select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a <> b").distinct()


def links(distinct: DataFrame) -> DataFrame:
    """(a, b) with a <> b over different fingerprints `fp`: enough links at MOST_BITS or fewer to connect all of them."""
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = distinct.repartition(n)  # many rows of each come: many tasks, whatever adaptive execution merged
    tables = _tables()
    flips = [f"if(fp & shiftleft(1L, {k * SEGMENT + b}) = 0, {t} | {1 << b}L, null)" for k, t in enumerate(tables) for b in range(SEGMENT)]
    homes = spread.select(F.col("fp").alias("other"), F.expr(f"explode(array({', '.join(tables)}))").alias("key"))
    probes = spread.select("fp", F.expr(f"explode(array({', '.join(tables + flips)}))").alias("key")).where("key IS NOT NULL")
    crowded = written(homes.groupBy("key").count().where(f"count > {CROWD}").select("key"), "crowded")
    if crowded.isEmpty():
        dropped(crowded)
        fetched, rest = homes, None
    else:
        fetched = homes.join(crowded, "key", "left_anti")
        rest = _met_in_balls(probes.join(crowded, "key", "left_semi").select("fp").distinct())
    near = f"bit_count(a ^ b) <= {MOST_BITS}"
    met = probes.join(fetched.hint("shuffle_hash"), "key").select(F.col("fp").alias("a"), F.col("other").alias("b")).where("a <> b").where(near)
    return met if rest is None else met.union(rest.where(near))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id."""
    marked = written(fingerprints(df, id_col, text_col), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("low"))
    of = components(links(distinct.select("fp")).select(F.col("a").alias("u"), F.col("b").alias("v")))
    # components are numbered by fingerprint; each takes the least id of all its fingerprints
    known = distinct.join(of, F.col("fp") == F.col("u"), "left").select("fp", "low", F.coalesce("component", "fp").alias("component"))
    least = known.groupBy("component").agg(F.min("low").alias("component_id"))
    by_fp = known.join(least, "component").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# near copies by similarity


def shingles(text: str) -> np.ndarray:
    """The different shingles' hashes, in order."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(np.concatenate(list(_hashes(words, LONG_WORDS, SEED))))


def margins(text: str) -> np.ndarray | None:
    """Of each bit, how many shingles have it rather than not; None without a word."""
    return _margins(shingles(text))


def _margins(h: np.ndarray) -> np.ndarray | None:
    if not len(h):
        return None
    ones = np.zeros(64 * PARTS, np.int64)
    for at in range(0, len(h), CHUNK):
        x = (h[at : at + CHUNK, None] ^ _MIX[0]) * _MIX[1]
        x = (x ^ (x >> np.uint64(32))) * _MIX[2]
        ones += _bit_counts(x ^ (x >> np.uint64(29)))
    return 2 * ones - len(h)


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for (part,) in rows(batches, "text"):
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([shingles(t) for t in part]).view(np.int64))], names=["shingle"])


def _frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The sample's most frequent shingles, in order of their hashes, and how many of its texts have each."""
    sample = docs.where(F.pmod("node", F.lit(SAMPLED)) == 0).select("text").mapInArrow(_shingled, "shingle long")
    often = sample.groupBy("shingle").count().where(f"count >= {OFTEN}").orderBy(F.desc("count"), "shingle").limit(HEAD).toArrow()
    hashes = often.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], often.column("count").to_numpy()[order]


def _rarest(h: np.ndarray, often: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Of a text's shingles, as many of the rarest as must hold one of any text that is alike enough."""
    k = len(h) - ceil(LEAST * len(h) - SLACK) + 1
    hashes, counts = often
    if not len(hashes):
        return h[:k]
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    return h[np.argsort(np.where(hashes[at] == h, counts[at], 0), kind="stable")[:k]]


def _parities(h: np.ndarray) -> np.ndarray:
    """Of each bin, whether it has an odd number of the shingles. Sets differ in as many shingles as parities at least."""
    odd = np.bincount((h % np.uint64(BITS)).view(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


_SKETCH = "id long, node long, doc_id long, fp array<long>, value array<int>, weak array<int>, n int, rare array<long>, odd array<long>"


def _sketch(often) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001  a Broadcast of _frequent()
    """Fingerprints, segments' values, the single bits that are weak in each; number, rarest ones and parities of the shingles.

    Ids are short where they meet in a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        nxt = TaskContext.get().partitionId() << 36
        for nodes, ids, part in rows(batches, "node", "doc_id", "text"):
            sets = [(node, i, h) for node, i, h in zip(nodes, ids, map(shingles, part)) if len(h)]
            m = np.array([_margins(h) for *_, h in sets], np.int64).reshape(-1, 64 * PARTS)
            bits = np.packbits(m > 0, axis=1, bitorder="little")
            weak = np.abs(m).reshape(len(m), TABLES, SEGMENT).argsort(2, kind="stable")[:, :, :WEAK]
            listed = lambda x, n: pa.ListArray.from_arrays(np.arange(len(m) + 1, dtype=np.int32) * n, np.ascontiguousarray(x).reshape(-1))
            rare = [_rarest(h, often.value).view(np.int64) for *_, h in sets]
            ends = np.cumsum([0, *map(len, rare)]).astype(np.int32)
            nxt += len(m)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(nxt - len(m), nxt)),
                    pa.array([node for node, *_ in sets], pa.int64()),
                    pa.array([i for _, i, _ in sets], pa.int64()),
                    listed(bits.view(np.int64), PARTS),
                    listed(bits.view(np.int32), TABLES),
                    listed((np.uint32(1) << weak.astype(np.uint32)).view(np.int32), TABLES * WEAK),
                    pa.array([len(h) for *_, h in sets], pa.int32()),
                    pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int64), *rare])),
                    listed(np.array([_parities(h) for *_, h in sets], np.int64).reshape(len(m), -1), BITS // 64),
                ],
                names=["id", "node", "doc_id", "fp", "value", "weak", "n", "rare", "odd"],
            )

    return run


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that are alike enough. A text is in many pairs: its shingles are remembered, up to SHINGLED hashes of all."""
    held: dict[int, np.ndarray] = {}
    size = 0

    def of(node: int, text: pa.Scalar) -> np.ndarray:
        nonlocal size
        found = held.get(node)
        if found is None:
            found = shingles(text.as_py())
            if size + len(found) > SHINGLED:
                held.clear()
                size = 0
            held[node] = found
            size += len(found)
        return found

    for batch in batches:
        u, v, a, b = (batch.column(n) for n in ("u", "v", "a", "b"))
        keep = []
        for k, (x, y) in enumerate(zip(u.to_pylist(), v.to_pylist())):
            s, t = of(x, a[k]), of(y, b[k])
            both = len(np.intersect1d(s, t, assume_unique=True)) if min(len(s), len(t)) >= LEAST * max(len(s), len(t)) else 0
            keep.append(both > 0 and both >= LEAST * (len(s) + len(t) - both))
        yield pa.RecordBatch.from_arrays([u, v], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _candidates(sketch: DataFrame) -> DataFrame:
    """(u, v): ids of members of table entries and of their entries' first ones.

    A row of the sketch is in one entry of each setting of each segment at most, so that even where a third of all rows
    are alike, no entry has more than that part of a 768th of what is dealt out. Entries are streamed, not gathered.
    """
    n = int(sketch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    settings = ["^".join(["value[s]", *(f"weak[s * {WEAK} + {k}]" for k in range(WEAK) if c >> k & 1)]) for c in range(1 << WEAK)]
    each = sketch.repartition(n, "id").select("id", "value", "weak", F.expr(f"explode(sequence(0, {TABLES - 1}))").alias("s"))
    entries = each.select("id", "s", F.expr(f"explode(array({', '.join(settings)}))").alias("setting"))
    entry = entries.select("id", F.expr("shiftleft(cast(s AS long), 32) | (cast(setting AS long) & 4294967295L)").alias("entry"))
    first = F.first("id").over(Window.partitionBy("entry").orderBy(F.xxhash64("id", "entry")))
    return entry.select(first.alias("u"), F.col("id").alias("v")).where("u <> v").distinct()


def _ends(sketch: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
    """The sketch's columns for both ends of pairs of ids."""
    return tuple(sketch.select(F.col("id").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("node", *names))) for x in ("u", "v"))


def _pair() -> list[Column]:
    return [F.least("u_node", "v_node").alias("u"), F.greatest("u_node", "v_node").alias("v")]


def _by_fingerprints(sketch: DataFrame) -> DataFrame:
    """(u, v): pairs of texts whose fingerprints are near."""
    u, v = _ends(sketch, "fp")
    apart = " + ".join(f"bit_count(u_fp[{k}] ^ v_fp[{k}])" for k in range(PARTS))
    near = _candidates(sketch).join(u, "u").join(v, "v").where(f"{apart} <= {FAR}").where("u_node <> v_node")
    return near.select(*_pair()).distinct()


def _left_apart(sketch: DataFrame, of: DataFrame) -> DataFrame:
    """(u, v): all pairs of texts of different components that may be alike enough."""
    n = int(sketch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = Window.partitionBy("shingle")
    rare = sketch.repartition(n, "id").select("id", "n", F.posexplode("rare").alias("pos", "shingle"))
    met = rare.withColumns({"low": F.min("id").over(by), "high": F.max("id").over(by)}).where("low <> high")
    met = written(met.select("shingle", "id", "n", "pos"), "met")
    # one row a text, though rows may repeat it
    texts_ = sketch.groupBy("node").agg(F.min("id").alias("id")).join(of.withColumnRenamed("u", "node"), "node", "left")
    named = met.join(texts_.select("id", F.coalesce("component", "node").alias("component")), "id")
    mixed = named.withColumns({"low": F.min("component").over(by), "high": F.max("component").over(by)}).where("low <> high")
    mixed = written(mixed.select("shingle", "id", "n", "pos", "component"), "mixed")
    a, b = (mixed.select("shingle", *(F.col(c).alias(f"{x}_{c}") for c in ("id", "n", "pos", "component"))) for x in ("u", "v"))
    share = LEAST / (1 + LEAST)
    may = (
        f"u_component <> v_component AND (u_n < v_n OR u_n = v_n AND u_id < v_id) AND u_n >= {LEAST} * v_n - {SLACK}"
        f" AND least(u_n - u_pos, v_n - v_pos) >= {share!r} * (u_n + v_n) - {SLACK}"
    )
    pairs = written(a.join(b, "shingle").where(may).select(F.col("u_id").alias("u"), F.col("v_id").alias("v")).distinct(), "apart")
    dropped(met, mixed)
    u, v = _ends(sketch, "n", "odd")
    apart = " + ".join(f"bit_count(u_odd[{k}] ^ v_odd[{k}])" for k in range(BITS // 64))
    return pairs.join(u, "u").join(v, "v").where(f"{apart} <= {1 - 2 * share!r} * (u_n + v_n) + {SLACK}").select(*_pair())


def _compared(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(u, v): the pairs whose texts are alike enough."""
    pairs = written(pairs, "pairs")
    asked = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    # one row a text, though ids may repeat it; only texts that may be asked for are shuffled
    known = written(amid(docs, "node", asked, "node").join(asked, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text")), "asked")
    left = known.select(F.col("node").alias("u"), F.col("text").alias("a"))
    right = known.select(F.col("node").alias("v"), F.col("text").alias("b"))
    linked = written(pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(_alike, "u long, v long"), "links")
    dropped(pairs, known)
    return linked


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, component_id) of each text of a group of two or more; component_id is the group's least known id."""
    docs = texts(df, id_col, text_col).withColumn("node", F.xxhash64("text"))
    often = df.sparkSession.sparkContext.broadcast(_frequent(docs))
    sketch = written(docs.select("node", "doc_id", "text").mapInArrow(_sketch(often), _SKETCH), "sketch")
    near = _compared(docs, _by_fingerprints(sketch))
    of = components(near)
    missed = _compared(docs, _left_apart(sketch, of))
    if not missed.isEmpty():
        of = components(of.withColumnRenamed("component", "v").union(missed))
    group = of.withColumnRenamed("u", "node").union(of.select("component", "component")).distinct()
    ids = group.join(sketch.select("node", "doc_id"), "node")
    out = written(group.join(ids.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component").select("node", "component_id"), "groups")
    dropped(sketch, near, missed)
    return out


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


QUERIES = {"op10_simhash_near_dedup": op10_simhash_near_dedup}
ORACLES: dict[str, str] = {}
