"""Fill-in-middle: a text's prefix, suffix and middle, cut between units that an automaton tells.

An automaton reads bytes and says after which of them a unit ends (code points, lines). Texts are scanned in chunks, all
chunks at once and from every state: a chunk gives the function from its first to its last state, and for each first
state the number of units that end in it. Functions compose, so a doubling scan over a text's chunks tells the state in
which each is entered, and then the units before it. A cut after k units is found in the one chunk that holds the
k-th end. A second automaton counts the markers that a text already contains.

Texts of over GIANT bytes are cut into segments that tasks of their own scan; a segment's function and counts are
composed in the same way, and only the segments that hold a cut are looked into again. The whole text is put together
by column functions, on bytes.

Null or empty text: no unit, form plain, the empty output. A null id hashes as the empty string. Bytes that aren't
UTF-8 belong to the unit that ends next. Repeated rows are repeated; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, flat, texts, written

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
#: Bytes of a chunk, of texts that are scanned at a time, of texts that are cut into segments, and of a segment.
CHUNK, BATCH, GIANT, SEGMENT = 256, 4 << 20, 4 << 20, 1 << 20


@dataclass(frozen=True)
class Automaton:
    """State after each byte, and whether a unit ends with the byte; states x 257, where byte 256 changes nothing."""

    step: np.ndarray
    ends: np.ndarray

    @staticmethod
    def of(states: int, rule: Callable[[int, int], tuple[int, bool]]) -> Automaton:
        step, ends = np.zeros((states, 257), np.uint8), np.zeros((states, 257), np.uint8)
        for s in range(states):
            for b in range(256):
                step[s, b], ends[s, b] = rule(s, b)
            step[s, 256] = s
        return Automaton(step, ends)

    @property
    def states(self) -> int:
        return len(self.step)

    def scan(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row of bytes and each first state: the last state, and how many units end."""
        state = np.tile(np.arange(self.states), (len(chunks), 1))
        count = np.zeros(state.shape, np.int64)
        for column in chunks.T:
            count += self.ends[state, column[:, None]]
            state = self.step[state, column[:, None]]
        return state.astype(np.int64), count

    def find(self, chunks: np.ndarray, entry: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Of each row entered in a state: the bytes up to the end of its rank-th unit."""
        state, seen, found = entry.copy(), np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        for k, column in enumerate(chunks.T):
            seen += self.ends[state, column]
            state = self.step[state, column].astype(np.int64)
            found[(seen == rank) & (found == 0)] = k + 1
        return found


def composed(f: tuple[np.ndarray, np.ndarray], g: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First f, then g, row by row."""
    return np.take_along_axis(g[0], f[0], 1), f[1] + np.take_along_axis(g[1], f[0], 1)


def running(last: np.ndarray, count: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Doubling scan: each row composed with all rows before it down to the row that `first` names."""
    at, reach = np.arange(len(last)), 1
    while True:
        open_ = np.flatnonzero(at - reach >= first)
        if not len(open_):
            return last, count
        more = composed((last[open_ - reach], count[open_ - reach]), (last[open_], count[open_]))
        last, count = last.copy(), count.copy()
        last[open_], count[open_] = more
        reach *= 2


def _code_point(left: int, b: int) -> tuple[int, bool]:
    """left: bytes that the code point still needs."""
    if left and 0x80 <= b < 0xC0:
        return left - 1, left == 1
    need = 1 if 0xC2 <= b < 0xE0 else 2 if 0xE0 <= b < 0xF0 else 3 if 0xF0 <= b < 0xF5 else 0
    return need, need == 0


def _marker(state: int, b: int) -> tuple[int, bool]:
    """1 after <, 2 after < and a marker's letter; > ends a marker then."""
    if b == ord("<"):
        return 1, False
    if state == 1 and b in b"PSM":
        return 2, False
    return 0, state == 2 and b == ord(">")


CODE_POINTS = Automaton.of(4, _code_point)
LINES = Automaton.of(1, lambda s, b: (0, b == 10))
MARKERS = Automaton.of(3, _marker)


def chunked(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts side by side as rows of CHUNK bytes (256 after a text's end); each row's text, and each text's first row."""
    size = np.diff(ends)
    many = np.maximum(1, -(-size // CHUNK))
    first = np.cumsum(many) - many
    out = np.full(int(many.sum()) * CHUNK, 256, np.uint16)
    shift = np.repeat(first * CHUNK - ends[:-1], size)
    out[np.arange(len(data)) + shift] = data
    return out.reshape(-1, CHUNK), np.repeat(np.arange(len(size)), many), first


class Scan:
    """Texts side by side, scanned: for each chunk, the function and the counts from its text's begin to its end."""

    def __init__(self, units: Automaton, data: np.ndarray, ends: np.ndarray):
        self.units = units
        self.chunks, self.of, self.first = chunked(data, ends)
        self.last, self.count = running(*units.scan(self.chunks), self.first[self.of])
        self.end = np.append(self.first[1:], len(self.of)) - 1

    def located(self, entry: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Of each text, entered in a state: the bytes up to the end of its rank-th unit; 0 for rank 0."""
        upto = self.count[np.arange(len(self.of)), entry[self.of]]
        ended = np.zeros(len(self.first), np.int64)  # chunks that end before the unit does
        np.add.at(ended, self.of, upto < rank[self.of])
        row = np.minimum(self.first + ended, self.end)
        before = np.maximum(row - 1, 0)
        inside = self.units.find(self.chunks[row], np.where(ended > 0, self.last[before, entry], entry), rank - np.where(ended > 0, upto[before], 0))
        return np.where(rank == 0, 0, (row - self.first) * CHUNK + inside)


def hashed(k: int) -> Column:
    """The k-th group of 8 hexadecimal digits of the id's digest."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def planned(df: DataFrame) -> DataFrame:
    """form, and the units before the two cuts, of n and marked: h1 % (n + 1) and h2 % (n + 1)."""
    a, b = hashed(1) % (F.col("n") + 1), hashed(2) % (F.col("n") + 1)
    plain = (F.octet_length("text") == 0) | F.col("marked") | (hashed(3) % 100 >= PLAIN_FROM)
    form = F.when(plain, "plain").when(hashed(4) % 100 < SPM_BELOW, "spm").otherwise("psm")
    return df.withColumns({"low": F.least(a, b), "high": F.greatest(a, b), "form": form})


def _small(units: Automaton, draws: Callable[[np.ndarray, pa.RecordBatch], tuple[np.ndarray, np.ndarray]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            begins, size = 0, np.cumsum(whole.column("n_bytes").to_numpy())
            while begins < whole.num_rows:
                until = max(begins + 1, int(np.searchsorted(size, (size[begins - 1] if begins else 0) + BATCH, "right")))
                batch = whole.slice(begins, until - begins)
                begins = until
                data, ends = flat(batch.column("text"))
                none = np.zeros(batch.num_rows, np.int64)
                scan, marks = Scan(units, data, ends), Scan(MARKERS, data, ends)
                n, marked = scan.count[scan.end, 0], marks.count[marks.end, 0] > 0
                low_at, high_at = (scan.located(none, r) for r in draws(n, batch))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("doc_id", "text")), pa.array(n), pa.array(marked), pa.array(low_at), pa.array(high_at)],
                    names=["doc_id", "text", "n", "marked", "low_at", "high_at"],
                )

    return run


def _draws(n: np.ndarray, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    h1, h2 = (batch.column(c).to_numpy() % (n + 1) for c in ("h1", "h2"))
    return np.minimum(h1, h2), np.maximum(h1, h2)


def _segments(units: Automaton) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4):
                part = batch.slice(at, 4)
                data, ends = flat(part.column("bytes"))
                columns = []
                for automaton in (units, MARKERS):
                    scan = Scan(automaton, data, ends)
                    columns += [pa.array(x[scan.end].tolist(), pa.list_(pa.int64())) for x in (scan.last, scan.count)]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("seg"), *columns], names=["row", "seg", "last", "count", "m_last", "m_count"])

    return run


def _finds(units: Automaton) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4):
                part = batch.slice(at, 4)
                data, ends = flat(part.column("bytes"))
                found = Scan(units, data, ends).located(*(part.column(c).to_numpy() for c in ("entry", "rank")))
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("which"), pa.array(found + part.column("seg").to_numpy() * SEGMENT)], names=["row", "which", "at"])

    return run


def _composed(last: str, count: str) -> Column:
    """The segments' functions in order, from state 0: (state, units) before each segment and after the last."""
    begin = F.array(F.struct(F.lit(0).cast("long").alias("state"), F.lit(0).cast("long").alias("units")))

    def onwards(done: Column, s: Column) -> Column:
        now = F.element_at(done, -1)
        return F.concat(done, F.array(F.struct(F.get(s[last], now["state"]).alias("state"), (now["units"] + F.get(s[count], now["state"])).alias("units"))))

    return F.aggregate("segments", begin, onwards)


def giants(docs: DataFrame, units: Automaton) -> DataFrame:
    """doc_id, text, n, marked, low_at, high_at of texts that are scanned by segments."""
    whole = written(docs.withColumn("row", F.monotonically_increasing_id()), "giants")
    bytes_ = F.col("text").cast("binary")
    each = whole.select("row", F.explode(F.sequence(F.lit(0), F.expr(f"(n_bytes - 1) div {SEGMENT}").cast("int"))).alias("seg"), bytes_.alias("b"))
    cut = each.select("row", "seg", F.substring("b", F.col("seg") * SEGMENT + 1, F.lit(SEGMENT)).alias("bytes")).repartition("row", "seg")
    scanned = cut.mapInArrow(_segments(units), "row long, seg int, last array<long>, count array<long>, m_last array<long>, m_count array<long>")
    told = scanned.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("seg", "last", "count", "m_last", "m_count"))).alias("segments"))
    told = told.select("row", _composed("last", "count").alias("steps"), (F.element_at(_composed("m_last", "m_count"), -1)["units"] > 0).alias("marked"))
    told = written(told.withColumn("n", F.element_at("steps", -1)["units"]), "scanned")
    drawn = planned(whole.join(told, "row")).select("row", "n_bytes", "text", "steps", F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("low").alias("want")), F.struct(F.lit(1).alias("which"), F.col("high").alias("want")))).alias("c"))
    seg = F.greatest(F.size(F.filter("steps", lambda s: s["units"] < F.col("c.want"))) - 1, F.lit(0))
    asked = drawn.select("row", "c.which", "c.want", seg.alias("seg"), F.get("steps", seg).alias("step"), "text")
    asked = asked.select("row", "which", F.col("seg").cast("long").alias("seg"), F.col("step.state").alias("entry"), (F.col("want") - F.col("step.units")).alias("rank"), F.substring(bytes_, (F.col("seg") * SEGMENT + 1).cast("int"), F.lit(SEGMENT)).alias("bytes"))
    found = asked.mapInArrow(_finds(units), "row long, which int, at long").groupBy("row").agg(F.min("at").alias("low_at"), F.max("at").alias("high_at"))
    return whole.join(told.select("row", "n", "marked"), "row").join(found, "row").select("doc_id", "text", "n", "marked", "low_at", "high_at")


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", units: Automaton = CODE_POINTS) -> DataFrame:
    """doc_id, text, n (units), form, prefix_units, middle_units (null if plain) and output, for each row."""
    docs = texts(df, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    small = docs.where(F.col("n_bytes") <= GIANT).select("doc_id", "text", "n_bytes", hashed(1).alias("h1"), hashed(2).alias("h2"))
    cut = small.mapInArrow(_small(units, _draws), "doc_id long, text string, n long, marked boolean, low_at long, high_at long")
    big = docs.where(F.col("n_bytes") > GIANT)
    if not big.isEmpty():
        cut = cut.unionByName(giants(big, units))
    b = F.col("text").cast("binary")
    part = lambda f, t: F.substring(b, (f + 1).cast("int"), (t - f).cast("int"))
    prefix, middle, suffix = part(F.lit(0), F.col("low_at")), part(F.col("low_at"), F.col("high_at")), part(F.col("high_at"), F.octet_length("text"))
    p, s, m = (F.lit(x).cast("binary") for x in (PREFIX, SUFFIX, MIDDLE))
    output = F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(b)
    told = lambda c: F.when(F.col("form") != "plain", c)
    return planned(cut).select(
        "doc_id", "text", "n", "form", told(F.col("low")).alias("prefix_units"), told(F.col("high") - F.col("low")).alias("middle_units"), output.cast("string").alias("output")
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form comes from. A text with a marker is left plain, so each marker stands once."""
    # a marker can't overlap another, so the first one found is the one that was put there
    first = lambda x, mark: F.substring_index(x, mark, 1)
    rest = lambda x, mark: F.substring(x, F.char_length(first(x, mark)) + len(mark) + 1, F.char_length(x))
    body = F.substring(output, len(PREFIX) + 1, F.char_length(output))
    one, two = F.when(form == "psm", first(body, SUFFIX)).otherwise(first(body, PREFIX)), F.when(form == "psm", rest(body, SUFFIX)).otherwise(rest(body, PREFIX))
    half, middle = first(two, MIDDLE), rest(two, MIDDLE)
    return F.when(form == "plain", output).when(form == "psm", F.concat(one, middle, half)).otherwise(F.concat(half, middle, one))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(documents(spark, sf_dir))
    return out.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"), F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    )


_SQL = """WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (SELECT doc_id, text, n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b, CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM d),
f AS (SELECT doc_id, text, n, least(a, b) AS lo, greatest(a, b) AS hi, CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT doc_id, text, n, form, lo, hi, substr(text, 1, lo) AS pre, substr(text, lo + 1, hi - lo) AS mid, substr(text, hi + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
 sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE text END) AS output_sha256,
 sha256(text) AS restored_sha256 FROM p"""

QUERIES = {"op13_fill_in_middle": op13_fill_in_middle}
ORACLES = {"op13_fill_in_middle": _SQL}
