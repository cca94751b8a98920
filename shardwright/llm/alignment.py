"""Alignment of the tokens of two tokenizers by the bytes that they cover, and counts of linked id pairs.

Both tokenizers cut the same bytes. A token of one and a token of the other that share a byte are an edge of a
bipartite graph; a union-find over these edges (one for each stretch of bytes that no token end divides) gives its
connected components, which are exactly the smallest groups at whose ends tokens of both end. Every A id of a group is
linked to every B id of it; the members of a component are expanded into links, in long groups by their distinct ids.

Units: a place between a character that is surely no white space (WORD) and a space ends a token of both, as no piece of
either reaches over it (checked when the vocabularies are loaded). So a text is cut there, and a worker remembers what it
found for a unit, the units asked for most often the longest. If the tokenizers don't give a unit's bytes back, its whole
text goes to them in one piece, and if the bytes differ there, the text has no tokens.

Counts are of documents; a map task adds up its own before anything is shuffled. The pairs of the highest counts, at most
HEAD, are broadcast (16 bytes each); a document's other pairs meet their counts in a join.

Null or empty text: no tokens, zeros, '' for the digest. Each row is a document, so repeated rows count each; null ids
stay null; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, kept, rows, texts, written

#: A character that isn't white space under any tokenizer's reading; a unit's first space after one.
WORD = r"[!-~\w]"
CUT = re.compile(rf"(?<={WORD})(?= )")
#: Units that can stand side by side in one string and be cut there again.
WHOLE = re.compile(rf" (?s:.*){WORD}\Z")
#: Characters on whose classes all readings of the pre-token pattern agree; texts of others go to the tokenizers library.
PLAIN = re.compile("[\t\n -~¡-ɏ]*")
#: Characters whose units are looked up at a time.
BLOCK = 1 << 20
#: Bytes of units that a worker remembers; beyond, the half that was asked for least goes.
MEMO = 80 << 20
#: Links of a group that are expanded token by token.
SMALL = 64
#: Pairs whose counts are broadcast.
HEAD = 1_000_000
#: A pair as one number: the B id in the low bits, the A id above it, both under 2 ** LOW.
LOW = 20


def byte_level() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def united(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Union-find over the edges (u, v) of n nodes, all at once: the least node of each node's component.

    Roots of an edge's ends are hooked to the lesser one, then every path is compressed, until no edge has two roots.
    """
    up = np.arange(n)
    while True:
        a, b = up[u], up[v]
        apart = a != b
        if not apart.any():
            return up
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(flat := up[up], up):
            up = flat


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), then the same from start[1] on."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - start, size)


@dataclass(slots=True)
class Units:
    """Aligned units: columns with a row each, and their links one after another."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray  # entries of pair and times
    pair: np.ndarray
    times: np.ndarray
    said: list[str]  # groups as text, each with ; after it

    @staticmethod
    def none(n: int) -> Units:
        return Units(np.zeros(n, bool), *(np.zeros(n, np.int64) for _ in range(4)), np.zeros(0, np.int64), np.zeros(0, np.int64), [""] * n)

    def __add__(self, more: Units) -> Units:
        return Units(*(np.concatenate([getattr(self, c), getattr(more, c)]) for c in COLUMNS), self.said + more.said)

    def taken(self, which: np.ndarray) -> Units:
        starts = np.cumsum(self.n_links) - self.n_links
        at = ranges(starts[which], self.n_links[which])
        return Units(*(getattr(self, c)[which] for c in COLUMNS[:5]), self.pair[at], self.times[at], [self.said[k] for k in which.tolist()])


COLUMNS = ("good", "n_a", "n_b", "n_groups", "n_links", "pair", "times")


@dataclass(slots=True)
class Aligned:
    """A text's counts, its links by pair, and the digest of its groups."""

    n_a: int
    n_b: int
    n_groups: int
    pair: np.ndarray
    times: np.ndarray
    sha256: str


class Aligner:
    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        stands_for, vocabulary = byte_level(), self.a.get_vocab(with_added_tokens=True)
        known = {t: bytes(stands_for[c] for c in t) if all(c in stands_for for c in t) else t.encode() for t in vocabulary}
        self.a_bytes = [b""] * (1 + max(vocabulary.values()))
        for t, i in vocabulary.items():
            self.a_bytes[i] = known[t]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        over = re.compile(rf"{WORD} ")
        if any(over.search(x.decode("utf-8", "ignore")) for x in (*self.a_bytes, *self.b_bytes)):
            raise ValueError("a piece reaches over the end of a word")
        self.a_size, self.b_size = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        #: Ids as they stand in a digest: of A before , and |, then of B before , and ;
        self.signs = [f"{i}{mark}" for many, marks in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for mark in marks for i in range(many)]
        self.ranks = self._ranks(json.loads(a_json), known)
        self.place: dict[str, int] = {}
        self.units, self.uses, self.size = Units.none(0), np.zeros(0, np.int64), 0

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    @staticmethod
    def _ranks(model: dict, known: dict[str, bytes]):  # noqa: ANN205
        """The same merges as ranks for the faster library, if the ids are in the order of the merges; else None."""
        import public_tokenizers as vocabularies
        import tiktoken

        vocabulary = model["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        ids = [vocabulary.get("".join(m)) for m in pairs]
        first = len(vocabulary) - len(pairs)
        if model.get("normalizer") or ids != list(range(first, first + len(pairs))) or first != 256:
            return None
        return tiktoken.Encoding("a", pat_str=vocabularies.PATTERN, mergeable_ranks={known[t]: i for t, i in vocabulary.items()}, special_tokens={})

    def encoded(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of a text that begins with a space; None if a tokenizer doesn't give its bytes back."""
        if self.ranks is not None and PLAIN.fullmatch(text):
            a = self.ranks.encode_ordinary(text)
        else:
            a = self.a.encode(text, add_special_tokens=False).ids
        b, data = self.b.encode(text[1:]), text.encode()
        same = b"".join(map(self.a_bytes.__getitem__, a)) == data == b"".join(map(self.b_bytes.__getitem__, b))
        return (a, b) if same else None

    def align(self, units: list[str]) -> Units:
        """Units anew. Those that end with a word are encoded side by side; if that fails, each on its own."""
        plain = [k for k, u in enumerate(units) if PLAIN.fullmatch(u) and WHOLE.match(u)]
        runs, others = [plain] if plain else [], set(range(len(units))).difference(plain)
        a_ids, b_ids, done = [], [], []
        for run in (*runs, *([k] for k in sorted(others))):
            found = self.encoded("".join([units[k] for k in run]))
            if found is None and len(run) > 1:
                for k in run:
                    if (one := self.encoded(units[k])) is not None:
                        a_ids += one[0]
                        b_ids += one[1]
                        done.append(k)
            elif found is not None:
                a_ids += found[0]
                b_ids += found[1]
                done += run
        return self._aligned(units, done, np.array(a_ids, np.int64), np.array(b_ids, np.int64))

    def _aligned(self, units: list[str], done: list[int], a: np.ndarray, b: np.ndarray) -> Units:
        """units[k] of done, one after another, are the bytes that a and b cut."""
        out = Units.none(len(units))
        if not done:
            return out
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        unit_end = np.cumsum([len(units[k].encode()) for k in done])
        if not (np.isin(unit_end, a_end).all() and np.isin(unit_end, b_end).all()):
            raise ValueError("a token reaches over the end of a unit")
        ends = np.union1d(a_end, b_end)
        root = united(len(a) + len(b), np.searchsorted(a_end, ends), len(a) + np.searchsorted(b_end, ends))
        first = root[: len(a)] == np.arange(len(a))  # a component's least node is its first A token
        of_a = np.cumsum(first) - 1
        of_b = of_a[root[len(a) :]]
        groups = int(of_a[-1]) + 1
        in_a, in_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
        from_a, from_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        unit_of = np.searchsorted(unit_end, a_end[from_a])  # of each group, as a place in done
        # links
        small = in_a * in_b <= SMALL
        each = np.where(small, in_b, 0)[of_a]
        pair = np.repeat(a, each) << LOW | b[ranges(from_b[of_a], each)]
        of, times = np.repeat(unit_of[of_a], each), np.ones(len(pair), np.int64)
        for g in np.flatnonzero(~small).tolist():
            left, right = (np.unique(x[f : f + n], return_counts=True) for x, f, n in ((a, from_a[g], in_a[g]), (b, from_b[g], in_b[g])))
            pair = np.append(pair, (left[0][:, None] << LOW | right[0]).ravel())
            times = np.append(times, (left[1][:, None] * right[1]).ravel())
            of = np.append(of, np.full(len(pair) - len(of), unit_of[g]))
        # text: the tokens of each group, A before B
        last_a, last_b = np.append(first[1:], True), np.append(of_b[1:] != of_b[:-1], True)
        signs = np.concatenate([a + len(self.a_bytes) * last_a, 2 * len(self.a_bytes) + b + len(self.b_bytes) * last_b])
        order = np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")
        words = list(map(self.signs.__getitem__, signs[order].tolist()))
        n_a, n_b, n_groups = (np.bincount(unit_of, weights=w, minlength=len(done)).astype(np.int64) for w in (in_a, in_b, None))
        at = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        # a link's unit is a place in units from here on
        where = np.array(done)
        of = where[of]
        by_unit = np.argsort(of, kind="stable")
        out.good[where], out.n_a[where], out.n_b[where], out.n_groups[where] = True, n_a, n_b, n_groups
        out.n_links = np.bincount(of, minlength=len(units))
        out.pair, out.times = pair[by_unit], times[by_unit]
        for k, unit in enumerate(done):
            out.said[unit] = "".join(words[at[k] : at[k + 1]])
        return out

    def look_up(self, units: list[str]) -> np.ndarray:
        """Rows of self.units, which learns those it doesn't hold."""
        if self.size > MEMO:
            keep = np.sort(np.argsort(-self.uses, kind="stable")[: len(self.uses) // 2])
            known = list(self.place)  # in the order of their rows
            self.place = {known[k]: n for n, k in enumerate(keep.tolist())}
            self.units, self.uses = self.units.taken(keep), self.uses[keep] // 2
            self.size = self._bytes(self.units) + sum(map(len, self.place))
        found = list(map(self.place.get, units))
        missing = list(dict.fromkeys(u for u, k in zip(units, found) if k is None))
        if missing:
            more = self.align(missing)
            self.place |= zip(missing, range(len(self.units.said), len(self.units.said) + len(missing)))
            self.units, self.uses = self.units + more, np.append(self.uses, np.zeros(len(missing), np.int64))
            self.size += self._bytes(more) + sum(map(len, missing))
            found = list(map(self.place.__getitem__, units))
        at = np.array(found, np.int64)
        self.uses += np.bincount(at, minlength=len(self.uses))
        return at

    @staticmethod
    def _bytes(units: Units) -> int:
        return 320 * len(units.said) + 16 * len(units.pair) + sum(map(len, units.said))

    @staticmethod
    def blocks(text: str) -> Iterator[list[str]]:
        """A text's units, BLOCK characters at a time."""
        at = 0
        while at < len(text):
            end = CUT.search(text, at + BLOCK) if len(text) - at > BLOCK else None
            to = end.start() if end else len(text)
            yield CUT.split(text[at:to])
            at = to

    def texts(self, many: list[str]) -> list[Aligned | None]:
        """Documents' own texts; the space before each is added here. None: it has no tokens."""
        n = len(many)
        sums, digests, good = np.zeros((3, n), np.int64), [hashlib.sha256() for _ in many], np.array([bool(t) for t in many], bool)
        begun, links = [False] * n, []

        def add(of: np.ndarray, table: Units, at: np.ndarray) -> None:
            """Rows `at` of the table stand in the documents `of`, in order."""
            for row, column in zip(sums, (table.n_a, table.n_b, table.n_groups)):
                np.add.at(row, of, column[at])
            begins = np.cumsum(table.n_links) - table.n_links
            size = table.n_links[at]
            which = ranges(begins[at], size)
            links.append(joined(np.repeat(of, size) << 2 * LOW | table.pair[which], table.times[which]))
            edges = np.flatnonzero(np.diff(of, prepend=-1)).tolist()
            rows_at = at.tolist()
            for s, e in zip(edges, [*edges[1:], len(of)]):
                k = int(of[s])
                said = "".join(map(table.said.__getitem__, rows_at[s:e]))[:-1]
                digests[k].update((";" * begun[k] + said).encode())
                begun[k] = True

        waiting: list[str] = []
        owners: list[int] = []

        def flush() -> None:
            if waiting:
                at, of = self.look_up(waiting), np.array(owners, np.int64)
                good[of[~self.units.good[at]]] = False
                fine = good[of]
                add(of[fine], self.units, at[fine])
            waiting.clear()
            owners.clear()

        held = 0
        for k, t in enumerate(many):
            if t:
                for units in self.blocks(" " + t):
                    waiting += units
                    owners += [k] * len(units)
                    held += sum(map(len, units)) if len(t) > BLOCK else len(t)
                    if held > BLOCK:
                        flush()
                        held = 0
        flush()
        for k in np.flatnonzero(~good).tolist():
            if many[k]:  # some unit's bytes differ: the whole text decides
                sums[:, k], digests[k], begun[k] = 0, hashlib.sha256(), False
                links[:] = [(key[key >> 2 * LOW != k], times[key >> 2 * LOW != k]) for key, times in links]
                one = self.align([" " + many[k]])
                if one.good[0]:
                    good[k] = True
                    add(np.array([k]), one, np.array([0]))
        key, times = joined(np.concatenate([x[0] for x in links]), np.concatenate([x[1] for x in links])) if links else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        edge = np.searchsorted(key, np.arange(n + 1) << 2 * LOW).tolist()
        pair = key & ((1 << 2 * LOW) - 1)
        return [Aligned(*sums[:, k].tolist(), pair[edge[k] : edge[k + 1]], times[edge[k] : edge[k + 1]], digests[k].hexdigest()) if good[k] else None for k in range(n)]

    def groups(self, text: str) -> list[tuple[list[int], list[int]]]:
        """A text's groups, each with its A and B ids in order."""
        found: list[str] = []
        for units in self.blocks(" " + text) if text else ():
            at = self.look_up(units)
            if not self.units.good[at].all():
                found = self.align([" " + text]).said
                break
            found += map(self.units.said.__getitem__, at.tolist())
        halves = (g.partition("|") for g in "".join(found).split(";") if g)
        return [(list(map(int, a.split(","))), list(map(int, b.split(",")))) for a, _, b in halves]


def joined(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its times."""
    if (times == 1).all():
        return np.unique(key, return_counts=True)
    once, where = np.unique(key, return_inverse=True)
    total = np.zeros(len(once), np.int64)
    np.add.at(total, where, times)
    return once, total


def shared_aligner(spark: SparkSession, a_path: str, b_path: str) -> Broadcast:
    """Both vocabularies, a few million bytes whatever the input, go from the driver to the executors."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return spark.sparkContext.broadcast((a.read(), b.read()))


def _aligner(shared: Broadcast) -> Aligner:
    return kept("alignment", lambda: Aligner(*shared.value))


def alignments(df: DataFrame, shared: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and groups, an array of (a, b) with the ids of each group in order."""
    group = pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared)
        for ids, part in rows(batches, "doc_id", "text"):
            found = [[{"a": a, "b": b} for a, b in aligner.groups(t)] for t in part]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(group))], names=["doc_id", "groups"])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, groups array<struct<a:array<int>,b:array<int>>>")


COUNTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
NAMES = [c.split(" ")[0] for c in COUNTS.split(", ")]


def listed(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *values]), kind))


def links(df: DataFrame, shared: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document COUNTS, and its links: pair (a << LOW | b) and times, arrays side by side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, nothing = _aligner(shared), np.zeros(0, np.int64)
        for ids, part in rows(batches, "doc_id", "text"):
            found = aligner.texts(part)
            counts = [(x.n_a, x.n_b, x.n_groups, int(x.times.sum())) if x else (0, 0, 0, 0) for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in zip(*counts)), pa.array([x.sha256 if x else "" for x in found], pa.string()),
                    listed([x.pair if x else nothing for x in found], pa.int64()), listed([x.times if x else nothing for x in found], pa.int64()),
                ],
                names=[*NAMES, "pair", "times"],
            )

    return texts(df, id_col, text_col).mapInArrow(run, COUNTS + ", pair array<long>, times array<long>")


def pair_counts(linked: DataFrame) -> DataFrame:
    """(pair, n): how many documents of links() hold the pair."""
    return linked.select(F.explode("pair").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def by_id(counts: DataFrame) -> DataFrame:
    """pair_counts() as (a, b, n)."""
    return counts.select(F.shiftright("pair", LOW).cast("int").alias("a"), F.col("pair").bitwiseAND((1 << LOW) - 1).cast("int").alias("b"), "n")


def size_class() -> Column:
    """An eighth of a power of two; some 500 of them whatever is counted."""
    return F.floor(F.log2("n") * 8).cast("int")


def most_counted(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The pairs, in order, with their counts, from a size class on that at most `most` pairs reach; and that class."""
    classes = counts.groupBy(size_class().alias("size")).agg(F.count("*").alias("many")).collect()
    line, held = 1 << 30, 0
    for size, many in sorted(((r["size"], r["many"]) for r in classes), reverse=True):
        if held + many > most:
            break
        line, held = size, held + many
    got = counts.where(size_class() >= line).select("pair", "n").toArrow()
    pairs, n = got["pair"].to_numpy(), got["n"].to_numpy()
    order = np.argsort(pairs)
    return pairs[order], n[order], line


def aligned(df: DataFrame, shared: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: tokens, groups, links; links whose count is their A id's highest; the sum of the links' counts."""
    spark = df.sparkSession
    linked = written(links(df, shared, id_col, text_col), "links")
    counts = written(pair_counts(linked), "pairs")
    pairs, n, line = most_counted(counts, HEAD)
    highest = counts.groupBy(F.shiftright("pair", LOW).alias("a")).agg(F.max("n").alias("high"))
    top = highest.toArrow()  # a row for each A id at most
    best = np.zeros(1 + max(top["a"].to_pylist(), default=0), np.int64)
    best[top["a"].to_numpy()] = top["high"].to_numpy()
    known = spark.sparkContext.broadcast((pairs, n, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, many, high = known.value
        for batch in batches:
            pair, times = (batch.column(c).flatten().to_numpy() for c in ("pair", "times"))
            of = np.repeat(np.arange(batch.num_rows), batch.column("pair").value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(head, pair), max(0, len(head) - 1))
            hit = head[at] == pair if len(head) else np.zeros(len(pair), bool)
            count, left = many[at[hit]], ~hit
            n_best, count_sum = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, of[hit], times[hit] * (count == high[pair[hit] >> LOW]))
            np.add.at(count_sum, of[hit], times[hit] * count)
            cut = np.searchsorted(of[left], np.arange(1, batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in NAMES), pa.array(n_best), pa.array(count_sum), *(listed(np.split(x[left], cut), pa.int64()) for x in (pair, times))],
                names=[*NAMES, "n_best", "count_sum", "pair", "times"],
            )

    out = linked.mapInArrow(run, COUNTS + ", n_best long, count_sum long, pair array<long>, times array<long>")
    below = counts.where(size_class() < line)
    if below.isEmpty():
        return out.select(*RESULT)
    return with_rest(written(out.withColumn("row", F.monotonically_increasing_id()), "aligned"), below, highest)


RESULT = [*NAMES[:5], "n_best", "count_sum", "groups_sha256"]


def with_rest(out: DataFrame, below: DataFrame, highest: DataFrame) -> DataFrame:
    """Adds what the pairs outside the broadcast head give. HEAD other pairs are in more documents or as many, so no key
    of the join is hot; highest has a row for each id of a vocabulary at most."""
    asked = out.select("row", F.explode(F.arrays_zip("pair", "times")).alias("r")).select("row", "r.pair", "r.times")
    met = asked.join(below, "pair").join(F.broadcast(highest), F.shiftright("pair", LOW) == F.col("a"))
    more = met.groupBy("row").agg(F.sum(F.when(F.col("n") == F.col("high"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    plus = {c: F.col(c) + F.coalesce(d, F.lit(0)) for c, d in (("n_best", "more_best"), ("count_sum", "more_sum"))}
    return out.join(more, "row", "left").withColumns(plus).select(*RESULT)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocabularies

    shared = shared_aligner(spark, vocabularies.path("byte_bpe_50k.json"), vocabularies.path("piece_bpe_32k.model"))
    return aligned(documents(spark, sf_dir), shared)


QUERIES = {"op11_token_alignment": op11_token_alignment}
ORACLES: dict[str, str] = {}
