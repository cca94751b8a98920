"""LM scoring with a hashed maximum-entropy model.

Tokens are lower-cased (A-Z) words between white space, then one end for each text. Counts of all training tokens are
summed by token. The HEAD most frequent (at most; the bound is exact, by a count threshold) are broadcast; all other
tokens meet their counts in a join, so counts are complete whatever the vocabulary.

The model factors P(token | context) = P(class | context) P(token | class, context) over the whole head, in classes of
neighbours by frequency: of WIDE tokens, and as many of WIDE x WIDE tokens (in two steps) as the head needs. The last
class holds all rare tokens, in buckets by their bytes' CRC-32; their number grows with the different rare tokens. A rare
token's share of its bucket is its smoothed count. Class logits add the hashed rows of three features: the token before
(bigram), the one before that (skip) and both (trigram). Logits within a class add the hashed row of the token before
and the class. Contexts are hashed from the tokens' bytes, whether in the head or not; feature rows grow with the
different tokens from LEAST_ROWS to MOST_ROWS. Biases are log frequencies, rows start at zero.

Training: synchronous rounds, each over a slice of the training documents, so that all rounds together read each text
once. Under the round's weights every task sums, for each weight, how often it was observed and expected (their
difference is the gradient); sums of all tasks are added by block in a shuffle, tasks in groups of GROUP first when there
are more. A weight then moves by its gradient over its expected uses in all rounds so far (the curvature) and PRIOR
expected uses of its row. Sums don't depend on how rows are dealt to tasks, so neither do scores, but for rounding. What
reaches the driver has the model's size, which is bounded. Scoring gathers the same features in batches.

Null text is the empty text: one end token. Rows with a null id are held in (they train). Repeated rows train and are
scored each. With no training row, counts are zero and every token is rare. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, rows, texts, written

END = b""
HEAD = 150_000
CLASSES = WIDE = 64
#: No token of a head has this number; a model's rare buckets are numbered from its own head's size on.
RARE = HEAD
#: Hashed rows of class features, and as many of features within a class: one for ROW_TOKENS different tokens. Every
#: task sends its rows back, so their number is bounded.
LEAST_ROWS, MOST_ROWS, ROW_TOKENS = 8192, 32768, 16
#: Stands before a text's first token; no CRC-32 is as large.
BOS = 1 << 32
BATCH, ROUNDS, BLOCK = 8192, 4, 256
#: Expected uses that each row is taken to have had besides, and the largest step before it is shared.
PRIOR, LARGEST = 60, 1.5
#: Three features add up to a class's logit and one to a place's, under classes that move as well: steps are so many parts.
PARTS = (3, 1.5)
#: Tasks whose sums are added before those of all are.
GROUP = 16
#: Shares of a row that are added a row at a time.
SHORT = 8
#: Bytes of text that a training task goes through at least, so that the rows it sends back are fewer than those.
TRAIN_BYTES = 64 << 20
#: Counts up to here are steps of their own when the head is chosen; above, FINE / 2 steps for each doubling.
FINE = 64
#: Different tokens that a task counts before it passes counts on.
HELD = 200_000


def tokens_of(text: str) -> list[bytes]:
    words = text.encode().lower().split()
    words.append(END)
    return words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        keys, n = list(held), list(held.values())
        held.clear()
        for i in range(0, len(keys), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 20_000], pa.binary()), pa.array(n[i : i + 20_000], pa.int64())], names=["token", "n"])

    for (part,) in rows(batches, "text"):
        for text in part:
            held.update(tokens_of(text))
        if len(held) > HELD:
            yield from flush()
    yield from flush()


class Model:
    """Weights and the head of the vocabulary."""

    def __init__(self, head: list[tuple[bytes, int]], n_tokens: int, n_distinct: int, rare: list[tuple[int, int]] | None = None):
        """rare: tokens and different tokens of each bucket of rare ones; one bucket if not given."""
        self.number = {t: k for k, (t, _) in enumerate(head)}
        self.n_tokens, self.n_distinct = n_tokens, n_distinct
        count = np.array([n for _, n in head], np.float64)
        self.log_count = np.log10(count + 0.5)
        buckets = np.array(rare or [(n_tokens - count.sum(), n_distinct - len(head))], np.float64)
        self.buckets = len(buckets)
        rare_mass = buckets[:, 0] + 0.5 * (buckets[:, 1] + 1)
        self.log_rare = np.log10(rare_mass)
        self.log_all = np.log10(n_tokens + 0.5 * (n_distinct + 1))
        self._place(len(head))
        mass = np.append(count + 0.5, rare_mass)
        within = np.zeros((max(CLASSES, self.node.max() + 1), WIDE))
        np.add.at(within, (self.cls, self.place), mass)
        deep = np.flatnonzero(self.node >= 0)
        np.add.at(within, (self.node[deep], self.last[deep]), mass[deep])
        with np.errstate(divide="ignore", invalid="ignore"):
            self.bias_c = np.maximum(np.log(np.bincount(self.cls, mass, CLASSES) / mass.sum()), -60).astype(np.float32)
            shares = np.log(within / within.sum(1, keepdims=True))
        self.bias_w = np.maximum(np.nan_to_num(shares, nan=-60, neginf=-60), -60).astype(np.float32)
        n_rows = LEAST_ROWS
        while n_rows < MOST_ROWS and n_rows * ROW_TOKENS < n_distinct:
            n_rows *= 2
        self.rows_c = np.zeros((n_rows, WIDE), np.float32)
        self.rows_w = np.zeros((n_rows, WIDE), np.float32)

    def _place(self, n_head: int) -> None:
        """Of each number, its class and place there; in classes of two steps also the inner node (else -1) and place."""
        large = max(0, -(-(n_head - (CLASSES - 1) * WIDE) // (WIDE * WIDE - WIDE)))
        small = CLASSES - 1 - large
        k = np.arange(n_head)
        rest, flat_ = k - small * WIDE, k < small * WIDE
        b = np.arange(self.buckets)
        stepped = self.buckets > WIDE
        self.cls = np.append(np.where(flat_, k // WIDE, small + rest // (WIDE * WIDE)), np.full(len(b), CLASSES - 1))
        self.place = np.append(np.where(flat_, k % WIDE, rest // WIDE % WIDE), b // WIDE if stepped else b)
        self.node = np.append(np.where(flat_, -1, CLASSES + rest // WIDE), CLASSES + large * WIDE + b // WIDE if stepped else np.full(len(b), -1))
        self.last = np.append(rest % WIDE, b % WIDE)

    def numbered(self, words: list[bytes]) -> np.ndarray:
        """Places in the head; len(head) for all other tokens."""
        return np.fromiter(map(self.number.get, words, repeat(len(self.number))), np.int64, len(words))

    def features(self, before: np.ndarray, skip: np.ndarray) -> np.ndarray:
        a, b = before.astype(np.uint64), skip.astype(np.uint64)
        mixed = [(a + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), (b + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)]
        mixed.append((mixed[0] ^ (mixed[1] >> np.uint64(7))) * np.uint64(0xD6E8FEB86659FD93))
        return np.stack([(m >> np.uint64(40)) % np.uint64(len(self.rows_c)) for m in mixed]).astype(np.int64)

    def inner(self, before: np.ndarray, node: np.ndarray) -> np.ndarray:
        m = (before.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + (node.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (((m ^ (m >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)) % np.uint64(len(self.rows_w))).astype(np.int64)

    def forward(self, own: np.ndarray, before: np.ndarray, skip: np.ndarray):  # noqa: ANN201
        """Natural log-probabilities of tokens, then rows, shares and hits of classes, and of steps within a class."""
        own = np.minimum(own, len(self.cls) - 1)
        cls = self.cls.take(own)
        f = self.features(before, skip)
        c = self.rows_c.take(f[0], 0)
        c += self.rows_c.take(f[1], 0)
        c += self.rows_c.take(f[2], 0)
        c += self.bias_c
        score = _soften(c, cls)
        node = self.node.take(own)
        deep = np.flatnonzero(node >= 0)
        node = np.append(cls, node[deep])
        place = np.append(self.place.take(own), self.last.take(own[deep]))
        g = self.inner(np.append(before, before[deep]), node)
        w = self.rows_w.take(g, 0)
        w += self.bias_w.take(node, 0)
        within = _soften(w, place)
        score += within[: len(own)]
        score[deep] += within[len(own) :]
        return score, f, c, cls, g, w, place

    def scored(self, own: np.ndarray, before: np.ndarray, skip: np.ndarray) -> np.ndarray:
        parts = [self.forward(*(x[i : i + BATCH] for x in (own, before, skip)))[0] for i in range(0, len(own), BATCH)]
        return np.concatenate(parts) if parts else np.zeros(0)


def _soften(logits: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Turns rows of logits into shares; the log of each row's share at its hit."""
    logits -= logits.max(1, keepdims=True)
    chosen = logits[np.arange(len(hit)), hit].astype(np.float64)
    np.exp(logits, out=logits)
    z = logits.sum(1, keepdims=True)
    logits /= z
    return chosen - np.log(z[:, 0])


def _summed(x: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of runs of rows: short runs a row of each at a time, long ones a run at a time."""
    total = x.take(first, 0)
    at = np.flatnonzero((size > 1) & (size <= SHORT))
    for k in range(1, SHORT):
        total[at] += x.take(first[at] + k, 0)
        at = at[size[at] > k + 1]
    for k in np.flatnonzero(size > SHORT).tolist():
        np.add.reduce(x[first[k] : first[k] + size[k]], 0, out=total[k])
    return total


class Uses:
    """How often each weight was observed and expected under a model's weights, summed over tokens."""

    def __init__(self, model: Model):
        self.m = model
        self.observed = [np.zeros(x.size, np.float32) for x in (model.rows_c, model.rows_w)]
        self.expected = [np.zeros_like(x) for x in (model.rows_c, model.rows_w)]

    def add(self, own: np.ndarray, before: np.ndarray, skip: np.ndarray) -> None:
        _, f, c, cls, g, w, place = self.m.forward(own, before, skip)
        for rows_at in f:
            self._add(0, rows_at, cls, c)
        self._add(1, g, place, w)

    def _add(self, k: int, rows_at: np.ndarray, hit: np.ndarray, shares: np.ndarray) -> None:
        np.add.at(self.observed[k], rows_at * WIDE + hit, np.float32(1))
        order = np.argsort(rows_at, kind="stable")
        r = rows_at[order]
        first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        self.expected[k][r[first]] += _summed(shares.take(order, 0), first, np.diff(np.append(first, len(r))))

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        """(block, float32 of its observed, then of its expected uses) of the blocks with any."""
        base = 0
        for observed, expected in zip(self.observed, self.expected):
            for at in range(0, len(expected), BLOCK):
                if expected[at : at + BLOCK].any():
                    yield base + at // BLOCK, observed[at * WIDE : (at + BLOCK) * WIDE].tobytes() + expected[at : at + BLOCK].tobytes()
            base += len(expected) // BLOCK


def moved(weights: np.ndarray, observed: np.ndarray, expected: np.ndarray, curvature: np.ndarray, parts: float) -> None:
    """One step of rows of weights; curvature is their expected uses of all rounds before and takes in this one's."""
    curvature += expected
    uses = expected.sum(1, keepdims=True)
    share = expected / np.maximum(uses, 1e-9)
    weights += np.clip((observed - expected) / (curvature + PRIOR * share + 1e-3), -LARGEST, LARGEST) / parts


def _stream(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(token or rare bucket, hash of the token before, hash of the one before that) of many texts at a time."""
    for (part,) in rows(batches, "text"):
        yield _contexts(model, part)[1:4]


def _contexts(model: Model, part: list[str]):  # noqa: ANN202
    words, sizes = [], []
    for text in part:
        own = tokens_of(text)
        sizes.append(len(own))
        words.append(own)
    flat = [w for own in words for w in own]
    number = model.numbered(flat)
    hashed = np.fromiter(map(crc32, flat), np.int64, len(flat))
    size = np.array(sizes, np.int64)
    start = np.cumsum(size) - size
    before = np.append(BOS, hashed[:-1])
    before[start] = BOS
    skip = np.append(BOS, before[:-1])
    skip[start] = BOS
    own = np.where(number < len(model.number), number, len(model.number) + hashed % model.buckets)
    return number, own, before, skip, start, size, flat


_BLOCK = pa.schema([("block", pa.int32()), ("salt", pa.int32()), ("body", pa.binary())])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums bodies by block, holding only sums."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, body in zip(batch.column("block").to_pylist(), batch.column("body")):
            v = np.frombuffer(body.as_buffer(), np.float32)
            if block in held:
                held[block] += v
            else:
                held[block] = v.astype(np.float64)
    for block, v in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([0], pa.int32()), pa.array([v.astype(np.float32).tobytes()], pa.binary())], schema=_BLOCK)


def train_round(train: DataFrame, model: Model, curvature: list[np.ndarray], tasks: int) -> None:
    """One step of the model, and what it adds to the curvature."""
    shared = train.sparkSession.sparkContext.broadcast(model)  # of fixed size
    groups = -(-tasks // GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = Uses(shared.value)
        for cols in _stream(shared.value, batches):
            for i in range(0, len(cols[0]), BATCH):
                uses.add(*(x[i : i + BATCH] for x in cols))
        salt = TaskContext.get().partitionId() % groups
        for block, body in uses.blocks():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([salt], pa.int32()), pa.array([body], pa.binary())], schema=_BLOCK)

    kind = "block int, salt int, body binary"
    n = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = train.coalesce(tasks).mapInArrow(run, kind).repartition(n, "block", "salt").mapInArrow(_added, kind)
    if groups > 1:
        sums = sums.repartition(n, "block").mapInArrow(_added, kind)
    for block, _, body in sums.collect():  # the model's size
        observed, expected = np.frombuffer(bytes(body), np.float32).reshape(2, BLOCK, WIDE).astype(np.float64)
        k = int(block >= len(model.rows_c) // BLOCK)
        at = block * BLOCK - k * len(model.rows_c)
        moved((model.rows_c, model.rows_w)[k][at : at + BLOCK], observed, expected, curvature[k][at : at + BLOCK], PARTS[k])
    shared.destroy()


def trained(train: DataFrame, model: Model) -> Model:
    """All rounds; a document is in the round that its id's hash says."""
    total = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(1, -(-total // (ROUNDS * TRAIN_BYTES)))
    curvature = [np.zeros_like(x) for x in (model.rows_c, model.rows_w)]
    for k in range(ROUNDS):
        train_round(train.where(F.expr(f"pmod(xxhash64(doc_id), {ROUNDS}) = {k}")), model, curvature, tasks)
    return model


def token_totals(train: DataFrame) -> DataFrame:
    """(token binary, n) over all training texts."""
    return written(train.mapInArrow(_count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")), "tokens")


def _step(n: Column) -> Column:
    """The count with only its first binary digits kept, of which there are as many as in FINE - 1."""
    cut = F.greatest(F.length(F.bin(n)) - F.length(F.bin(F.lit(FINE - 1))), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", n, cut), cut)


def _head(totals: DataFrame, most: int) -> tuple[list[tuple[bytes, int]], int, int, int]:
    """(tokens of at least some count, at most `most`, most frequent first), that count, all tokens, all distinct ones."""
    by = totals.groupBy(_step(F.col("n")).alias("step")).agg(F.sum("n").alias("n"), F.count("*").alias("distinct"), F.max("n").alias("most")).orderBy(F.desc("step")).collect()
    least, at_least = (by[0]["most"] + 1 if by else 1), 0
    for row in by:  # at most FINE + 63 x FINE / 2 rows
        at_least += row["distinct"]
        if at_least > most:
            break
        least = row["step"]
    got = sum(row["n"] for row in by), sum(row["distinct"] for row in by)
    head = [(bytes(t), n) for t, n in totals.where(F.col("n") >= least).collect()]
    return sorted(head, key=lambda x: (-x[1], x[0])), least, *got


def learn(train: DataFrame) -> tuple[Model, DataFrame]:
    """train: (doc_id, text). The model, and the totals of tokens outside its head."""
    totals = token_totals(train)
    head, least, n_tokens, n_distinct = _head(totals, HEAD)
    tail = totals.where(F.col("n") < least)
    rare = [(0, 0)] * max(1, min(WIDE * WIDE, (n_distinct - len(head)) // WIDE))
    for b, n, v in tail.groupBy((F.crc32("token") % len(rare)).alias("b")).agg(F.sum("n"), F.count("*")).collect():  # at most WIDE x WIDE rows
        rare[b] = (n, v)
    model = Model(head, n_tokens, n_distinct, rare)
    return (trained(train, model) if n_tokens else model), tail


_SCORED = "row long, doc_id long, n_tokens long, n_known long, own double, head double, rare double, tail array<struct<token:binary,n:long>>"


def score(df: DataFrame, model: Model, tail: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        pair = pa.struct([("token", pa.binary()), ("n", pa.int64())])
        key = TaskContext.get().partitionId() << 36
        log_count = np.append(m.log_count, 0.0)
        for ids, part in rows(batches, "doc_id", "text"):
            number, own, before, skip, start, size, flat = _contexts(m, part)
            known = number < len(m.number)
            logs = log_count[number]
            add = lambda v: np.add.reduceat(v.astype(np.float64), start)
            tails: list[list[tuple[bytes, int]]] = []
            off = np.flatnonzero(~known)
            of = np.searchsorted(off, np.append(start, len(flat)))
            for a, b in zip(of[:-1], of[1:]):
                tails.append([{"token": t, "n": n} for t, n in Counter(flat[k] for k in off[a:b].tolist()).items()])
            cols = [
                np.arange(key, key + len(ids)), None, size, add(known).astype(np.int64), add(m.scored(own, before, skip)) / np.log(10), add(logs),
                add(np.where(known, 0.0, m.log_rare.take(np.maximum(own - len(m.number), 0)))),
            ]
            key += len(ids)
            arrays = [pa.array(ids, pa.int64()) if c is None else pa.array(c) for c in cols]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(tails, pa.list_(pair))], names=["row", "doc_id", "n_tokens", "n_known", "own", "head", "rare", "tail"])

    scored = written(texts(df, id_col, text_col).mapInArrow(run, _SCORED), "scored")
    other = scored.select("row", F.explode("tail").alias("t")).select("row", F.col("t.token").alias("token"), F.col("t.n").alias("tf"))
    met = other.join(tail, "token", "left").select("row", (F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("logs"), F.when(F.col("n") > 0, F.col("tf")).otherwise(0).alias("known"))
    more = met.groupBy("row").agg(F.sum("logs").alias("logs"), F.sum("known").alias("known"))
    logs, known = F.coalesce("logs", F.lit(0.0)), F.coalesce("known", F.lit(0))
    return scored.drop("tail").join(more, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + known).cast("long").alias("n_known"),
        F.lit(int(model.n_tokens)).cast("long").alias("train_tokens"),
        (F.col("head") + logs - F.col("n_tokens") * F.lit(float(model.log_all))).alias("base_score"),
        (F.col("own") + logs - F.col("rare")).alias("score"),
    )


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 1, F.lit(False))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model, tail = learn(texts(docs.where(~held_out())))
    out = score(docs, model, tail)
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op8_lm_scoring": op8_lm_scoring}
ORACLES: dict[str, str] = {}
