"""Language ID by rank-order profiles.

A text's letters, in lower case, form words; each word is framed by marks, and its n-grams of 1 to LONGEST characters
are counted. A profile is the TOP most frequent n-grams in order (ties: by hash). A text's distance to a language is the
sum, over the text's own profile, of how far each n-gram is out of place in the language's profile, at most TOP each.
The least distance wins (ties: the first language by name); the score is 1 minus that distance over its maximum.

Profiles are learnt from all training rows: each task counts, counts are summed by (language, n-gram) and the TOP of
each language are ranked in salted parts first, so that neither a frequent language nor a frequent n-gram is gathered.
What is broadcast is TOP n-grams for each language, whatever the rows.

Null text, or text without a letter: language `und`, score 0. Rows with a null id don't train and are predicted. With
no training row every text is `und`. Repeated rows train and are predicted each.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, kept, rows, texts

TOP, LONGEST, SALTS = 300, 3, 64
UNKNOWN = "und"
#: n-grams whose hashes a worker remembers.
MEMO = 200_000
#: Letters whose n-grams are counted at a time.
STRUNG = 1 << 16
#: Letters of training texts that are counted together.
COUNTED = 1 << 20
MARK = ord("_")
_WORDS = re.compile(r"[^\W\d_]+")


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order, and the sums of their counts."""
    if len(parts) == 1:
        return parts[0]
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)


class Grams:
    """Counts n-grams as codes, the code points side by side in a long, and remembers the codes' hashes: they alone leave the worker."""

    def __init__(self) -> None:
        #: Of each code point: 0 not in a word, 1 in a word, 2 a letter, -1 not met yet.
        self.kind = np.full(0x110000, -1, np.int8)
        self.codes, self.hashes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bits = 63 // LONGEST

    def framed(self, text: str) -> np.ndarray:
        """Code points of a text's words one after another, each with a mark before it, and one after the last; none without a letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.kind[points]
        if kind.min(initial=0) < 0:
            for p in np.unique(points[kind < 0]).tolist():
                if p >> self.bits:
                    raise ValueError(f"n-grams of {LONGEST} code points don't fit a long")
                self.kind[p] = 1 + chr(p).isalpha() if _WORDS.match(chr(p)) else 0
            kind = self.kind[points]
        if kind.max(initial=0) < 2:
            return np.zeros(0, np.uint32)
        s = np.full(len(points) + 2, MARK, np.uint32)
        s[1:-1] = np.where(kind > 0, points, MARK)
        inside = s != MARK
        return s[inside | np.append(True, inside[:-1])]

    def counted(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, counts) of the n-grams of framed words."""
        found = []
        for at in range(0, len(s), STRUNG):
            part = s[at : at + STRUNG + LONGEST - 1].astype(np.int64)
            code, whole, codes = part, np.ones(len(part), bool), [part[:STRUNG]]
            for n in range(2, min(LONGEST, len(part)) + 1):
                code = code[:-1] << self.bits | part[n - 1 :]
                whole = whole[: len(code)]
                if n > 2:  # a mark inside: it would reach into the next word
                    whole = whole & (part[n - 2 : -1] != MARK)
                codes.append(code[:STRUNG][whole[:STRUNG]])
            found.append(np.unique(np.concatenate(codes), return_counts=True))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes, n = _summed(found)
        n[np.searchsorted(codes, MARK)] = 2 * (np.count_nonzero(s == MARK) - 1)  # a mark stands before a word and after it
        return codes, n

    def hashed(self, codes: np.ndarray) -> np.ndarray:
        """Hashes of codes that are in order."""
        at = np.searchsorted(self.codes, codes)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == codes[known]
        if not known.all():
            if len(self.codes) > MEMO:
                self.codes, self.hashes = np.zeros(0, np.int64), np.zeros(0, np.int64)
                return self.hashed(codes)
            new = codes[~known]
            here = np.array([xxhash.xxh64_intdigest(self.gram(c)) - (1 << 63) for c in new.tolist()], np.int64)
            at = np.searchsorted(self.codes, new)
            self.codes, self.hashes = np.insert(self.codes, at, new), np.insert(self.hashes, at, here)
            at = np.searchsorted(self.codes, codes)
        return self.hashes[at]

    def gram(self, code: int) -> str:
        points = [code >> self.bits * k & (1 << self.bits) - 1 for k in range(LONGEST)]
        return "".join(chr(p) for p in reversed(points) if p)


def _grams() -> Grams:
    return kept("grams", Grams)


def counted(words: Counter) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram hashes, counts) of words with their counts."""
    codes, n = _grams().counted(_grams().framed(" ".join(words.elements())))
    return _grams().hashed(codes), n


def top(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hashes of the TOP most frequent n-grams in order."""
    if len(codes) > TOP:
        keep = counts >= np.partition(counts, len(counts) - TOP)[len(counts) - TOP]
        codes, counts = codes[keep], counts[keep]
    keys = _grams().hashed(codes)
    return keys[np.lexsort((keys, -counts))[:TOP]]


def words_of(text: str) -> list[str]:
    """Runs of letters; other alphanumeric signs that aren't digits count if there is any letter at all."""
    words = _WORDS.findall(text.lower())
    return words if any(c.isalpha() for w in words for c in w) else []


class Profiles:
    def __init__(self, ranked: dict[str, list[int]]):
        self.names = sorted(ranked)
        self.keys = np.unique(np.array([k for v in ranked.values() for k in v], np.int64))
        # one row more for what no profile has; -1 marks an n-gram that a profile lacks
        self.rank = np.full((len(self.keys) + 1, len(self.names)), -1, np.int64)
        for j, name in enumerate(self.names):
            self.rank[np.searchsorted(self.keys, np.array(ranked[name], np.int64)), j] = np.arange(len(ranked[name]))

    def predict(self, text: str) -> tuple[str, float]:
        words = _grams().framed(text)
        if not len(words) or not self.names:
            return UNKNOWN, 0.0
        own = top(*_grams().counted(words))
        at = np.searchsorted(self.keys, own)
        at[at == len(self.keys)] = 0
        at = np.where(self.keys[at] == own, at, len(self.keys))
        ranks = self.rank[at]
        apart = np.where(ranks < 0, TOP, np.minimum(TOP, np.abs(ranks - np.arange(len(own))[:, None]))).sum(0)
        best = int(np.argmin(apart))
        return self.names[best], float(1 - apart[best] / (TOP * len(own)))


_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, (codes, n) in held.items():
            for i in range(0, len(codes), 10_000):
                keys = _grams().hashed(codes[i : i + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n[i : i + 10_000])], schema=_COUNTS)
        held.clear()

    words: dict[str, list[np.ndarray]] = defaultdict(list)
    size = 0

    def count() -> None:
        for lang, found in words.items():
            now = _grams().counted(np.concatenate([*found, np.array([MARK], np.uint32)]))
            held[lang] = _summed([held[lang], now]) if lang in held else now
        words.clear()

    for langs, part in rows(batches, "lang", "text"):
        for lang, text in zip(langs, part):
            found = _grams().framed(text)[:-1]  # the mark after a text's last word is the one before the next text's first
            if len(found):
                words[lang].append(found)
                size += len(found)
            if size > COUNTED:
                count()
                size = 0
        if sum(len(codes) for codes, _ in held.values()) > 200_000:
            yield from flush()
    count()
    yield from flush()


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles of all rows of df with a language."""
    labelled = texts(df.where(F.col(lang_col).isNotNull()), id_col, text_col, F.col(lang_col).cast("string").alias("lang"))
    total = labelled.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = [F.desc("n"), F.asc("gram")]
    parts = total.withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(SALTS)))
    parts = parts.withColumn("r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(f"r <= {TOP}")
    best = parts.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(f"r <= {TOP}")
    ranked: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for row in best.select("lang", "r", "gram").toLocalIterator():
        ranked[row[0]].append((row[1], row[2]))
    return Profiles({k: [g for _, g in sorted(v)] for k, v in ranked.items()})


def predict(df: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of each row."""
    shared = df.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t) for (part,) in rows(iter([batch]), "text") for t in part]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = predict(docs, learn(docs.where(~held_out() & F.col("doc_id").isNotNull())))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


QUERIES = {"op9_language_id": op9_language_id}
ORACLES: dict[str, str] = {}
