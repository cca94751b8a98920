"""Suffix-array dedup: removes each byte covered by a WIDTH-byte string that also starts in a document of smaller id.

Sorting all suffixes of a corpus together doesn't distribute, so strings are first sent to where they can meet:

1. Documents are dealt by hash of id into groups of bounded size. In a group, the least hash of the KGRAM-byte grams in
   each WIDTH-byte window is taken; a run is a stretch of windows with the same least hash, its piece the bytes that
   they cover. Equal strings have equal least hashes, so they lie in runs of the same hash.
2. Groups send their different hashes, packed by bucket. A bucket answers which of them other groups have too, and which
   are hot: with over HOT different pieces in all.
3. Groups send the bytes of each different piece whose hash is shared, by other groups or by several documents or pieces
   of their own, with its smallest id and the places of its runs. A piece with a hot hash is sent a window at a time, and
   each window goes by a hash of its own, so no frequent gram gathers in one bucket.
4. Buckets make equal pieces one and build suffix arrays of a hash's different pieces (suffixes.py: two-stage sorting,
   adjacent common prefixes), some million bytes at a time, never parting pieces of one hash. Among neighbours with
   WIDTH common bytes, those whose id isn't the smallest answer with their places. All is decided by bytes; hashes
   only bring strings together.
5. Groups cut the places out. All steps read the one exchange of the texts; texts cross the network once.

Strings are judged on the input, not on what is left, and never cross documents. Null text is the empty text. Null ids
count as larger than all others and equal to each other; documents of equal id don't remove from each other. Texts
shorter than WIDTH bytes stay whole. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, sha256, texts
from .suffixes import sorted_windows

WIDTH, KGRAM = 50, 20
#: Bytes of text in a group, and of text whose pieces meet in a bucket, on average.
GROUP_BYTES, BUCKET_BYTES = 8 << 20, 8 << 20
#: Window starts looked at in one go, and bytes of pieces that are sorted together unless one hash has more.
STRETCH, SORTED_BYTES = 1 << 19, 2 << 20
#: Different pieces of one hash, in all groups, beyond which its windows are dealt one by one.
HOT = 20_000
NO_ID = np.iinfo(np.int64).max
_LOW48 = np.uint64((1 << 48) - 1)

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0][0]) < n:
        with np.errstate(over="ignore"):
            both = []
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                both.append(np.multiply.accumulate(p))
        _POWERS[0] = (both[0], both[1])
    return _POWERS[0]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def runs(flat: np.ndarray, ends: np.ndarray, width: int = WIDTH, kgram: int = KGRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of documents that lie one after another (ends: their bounds, from 0): hash, context's hash, document, start, end."""
    span = width - kgram + 1
    for low in range(0, max(0, len(flat) - width + 1), STRETCH):
        high = min(low + STRETCH, len(flat) - width + 1)
        data = flat[low : high + width - 1]
        n = len(data)
        forth, back = _powers(STRETCH + width + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * forth[:n], out=sums[1:])
        grams = _mixed((sums[kgram:] - sums[:-kgram]) * back[: n - kgram + 1])
        size = 1
        least = grams
        while 2 * size <= span:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < span:
            more = span - size
            least = np.minimum(least[:-more], least[more:])
        count = high - low
        cut = np.empty(count, bool)
        cut[0] = True
        np.not_equal(least[1:count], least[: count - 1], out=cut[1:])
        inner = ends[np.searchsorted(ends, low, "right") : np.searchsorted(ends, high + width, "left")]
        for edge in (inner - low, inner - low - width + 1):
            cut[edge[(edge >= 0) & (edge < count)]] = True
        first = np.flatnonzero(cut)
        last = np.append(first[1:], count) - 1 + width  # end of the context
        doc = np.searchsorted(ends, first + low, "right") - 1
        whole = last + low <= ends[doc + 1]
        first, last, doc = first[whole], last[whole], doc[whole]
        context = _mixed((sums[last] - sums[first]) * back[first] + (last - first).astype(np.uint64))
        yield least[first] & _LOW48, context & _LOW48, doc, first + low, last + low


def all_runs(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    parts = list(runs(flat, ends))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(p) for p in zip(*parts))


def _pack(*cols: np.ndarray) -> bytes:
    """Each column by planes of bytes, of which those that are 0 throughout are left out."""
    out = []
    for c in cols:
        n = len(c)
        planes = np.ascontiguousarray(c).view(np.uint8).reshape(n, 8)
        width = next((k for k in range(8, 0, -1) if planes[:, k - 1].any()), 0)
        out += [np.array([n, width], np.int64).tobytes(), np.ascontiguousarray(planes[:, :width].T).tobytes()]
    return b"".join(out)


def _unpack(data: bytes, n_cols: int) -> tuple[list[np.ndarray], int]:
    """The first columns, as signed numbers, and where they end."""
    at, out = 0, []
    for _ in range(n_cols):
        n, width = np.frombuffer(data, np.int64, 2, at).tolist()
        planes = np.zeros((n, 8), np.uint8)
        planes[:, :width] = np.frombuffer(data, np.uint8, width * n, at + 16).reshape(width, n).T
        out.append(planes.reshape(-1).view(np.int64))
        at += 16 + width * n
    return out, at


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Whether each row differs from the one before."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of these sizes one after another: of which run each element is, and its place there."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class _Group:
    """A group's documents, by id and then text, one after another."""

    def __init__(self, table: pa.Table):
        ids = [NO_ID if i is None else i for i in table.column("doc_id").to_pylist()]
        self.null = [i is None for i in table.column("doc_id").to_pylist()]
        bodies = [t.encode() for t in table.column("text").to_pylist()]
        order = sorted(range(len(ids)), key=lambda k: (ids[k], bodies[k]))
        self.ids = np.array([ids[k] for k in order], np.int64)
        self.null = [self.null[k] for k in order]
        self.bodies = [bodies[k] for k in order]
        self.ends = np.concatenate([[0], np.cumsum([len(b) for b in self.bodies])]).astype(np.int64)
        self.flat = np.frombuffer(b"".join(self.bodies), np.uint8)

    def runs(self) -> tuple[np.ndarray, ...]:
        return all_runs(self.flat, self.ends)

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the bytes from a are those from b."""
        out, cuts = np.ones(len(a), bool), np.cumsum(size) // STRETCH
        for k in range(int(cuts[-1]) + 1 if len(a) else 0):
            own = np.flatnonzero(cuts == k)
            of, nth = _spread(size[own])
            out[own[of[self.flat[a[own][of] + nth] != self.flat[b[own][of] + nth]]]] = False
        return out


_SENT = "bucket int, g int, body binary"
_SENT_ARROW = pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("body", pa.binary())])


def _sent(found: list[tuple[int, int, bytes]]) -> pa.Table:
    cols = list(zip(*found)) if found else [[], [], []]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, _SENT_ARROW.types)], schema=_SENT_ARROW)


def _parts(part: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of each part, in their order."""
    order = np.argsort(part, kind="stable")
    if len(order):
        yield from np.split(order, np.flatnonzero(np.diff(part[order])) + 1)


def _offered(h: np.ndarray, c: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Different hashes in order, the pieces of each (told apart by 16 bits), and each bucket's share of them."""
    keys = np.sort((h << np.uint64(16)) | (c & np.uint64(0xFFFF)))
    h = keys[_heads(keys)] >> np.uint64(16)
    first = np.flatnonzero(_heads(h))
    own = h[first]
    part = (own % np.uint64(buckets)).astype(np.int64)
    return own, np.diff(np.append(first, len(h))), [(int(part[x[0]]), x) for x in _parts(part)]


def _offer(buckets: int):  # noqa: ANN202
    def offer(key: tuple, table: pa.Table) -> pa.Table:
        h, c, *_ = _Group(table).runs()
        own, n, parts = _offered(h, c, buckets)
        return _sent([(b, key[0].as_py(), _pack(np.diff(own[x], prepend=np.uint64(0)), n[x])) for b, x in parts])

    return offer


def _answer(hot: int):  # noqa: ANN202
    def answer(key: tuple, table: pa.Table) -> pa.Table:
        """For each group, of each hash that it offers: 0 if no other group has it, else 1, or 2 if hot."""
        h, n = [], []
        for x in table.column("body"):
            (step, many), _ = _unpack(x.as_py(), 2)
            h.append(np.cumsum(step))
            n.append(many)
        sizes = [len(x) for x in h]
        h, n = np.concatenate(h), np.concatenate(n)
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(_heads(h[order]))
        state = np.where(np.diff(np.append(first, len(h))) < 2, 0, np.where(np.add.reduceat(n[order], first) > hot, 2, 1)) if len(h) else h
        said = np.empty(len(h), np.uint8)
        said[order] = np.repeat(state, np.diff(np.append(first, len(h))))
        parts = np.split(said, np.cumsum(sizes)[:-1])
        return _sent([(key[0].as_py(), g, x.tobytes()) for g, x in zip(table.column("g").to_pylist(), parts)])

    return answer


_WINDOW = np.random.default_rng(50).integers(0, 1 << 63, 4096, np.uint64) * np.uint64(2) + np.uint64(1)


def _windows(group: _Group, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of one window each, by the window's own hash."""
    of, nth = _spread(end - start - WIDTH + 1)
    doc, start = doc[of], start[of] + nth
    mixed = np.zeros(len(start), np.uint64)
    for k in range(WIDTH):
        mixed += _BYTE[group.flat[start + k]] * _WINDOW[k]
    mixed = _mixed(mixed)
    return mixed & _LOW48, mixed >> np.uint64(16), doc, start, start + WIDTH


def _pieces(buckets: int):  # noqa: ANN202
    def pieces(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _sent([])
        group = _Group(docs)
        h, c, doc, start, end = group.runs()
        own, n, parts = _offered(h, c, buckets)
        said = dict(zip(answers.column("bucket").to_pylist(), (x.as_py() for x in answers.column("body"))))
        state = np.zeros(len(own), np.uint8)
        for b, x in parts:
            state[x] = np.frombuffer(said[b], np.uint8)
        # runs of one piece side by side, in order of ids; those that can't meet any other go
        order = np.lexsort((c, h))
        h, c = h[order], c[order]
        of = np.cumsum(_heads(h)) - 1
        new = np.append(_heads(h, c), True)
        meets = ((state > 0) | (n > 1))[of]
        stay = np.flatnonzero(meets | ~(new[1:] & new[:-1]))
        order, h, c, meets, hot = order[stay], h[stay], c[stay], meets[stay], (state == 2)[of[stay]]
        doc, start, end = doc[order], start[order], end[order]
        if hot.any():
            more = _windows(group, doc[hot], start[hot], end[hot])
            h, c, doc, start, end = (np.append(x[~hot], y) for x, y in zip((h, c, doc, start, end), more))
            meets = np.append(meets[~hot], np.ones(len(more[0]), bool))
            order = np.lexsort((c, h))
            h, c, doc, start, end, meets = (x[order] for x in (h, c, doc, start, end, meets))
        new = _heads(h, c)
        first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.zeros(0, np.int64)
        again = np.flatnonzero(~new)
        size = end - start
        differs = again[size[again] != size[first[again]]]
        again = again[size[again] == size[first[again]]]
        differs = np.append(differs, again[~group.same(start[again], start[first[again]], size[again])])
        if len(differs):  # of equal hash, but not of equal bytes: pieces of their own
            c[differs] = np.uint64(1 << 48) + np.arange(len(differs), dtype=np.uint64)
            meets[np.isin(h, h[differs])] = True
            order = np.lexsort((c, h))
            h, c, doc, start, end, meets = (x[order] for x in (h, c, doc, start, end, meets))
            new = _heads(h, c)
        first = np.flatnonzero(new)
        of = np.cumsum(new) - 1
        ids = group.ids[doc]
        low = np.minimum.reduceat(ids, first) if len(first) else ids
        other = ids > low[of]
        several = np.logical_or.reduceat(other, first) if len(first) else other
        send = np.flatnonzero(meets[first] | several)
        taken = np.zeros(len(first), bool)
        taken[send] = True
        same = np.bincount(of[~other], minlength=len(first))
        more = np.bincount(of[other], minlength=len(first))
        runs_ = np.flatnonzero(taken[of])
        runs_ = runs_[np.lexsort((other[runs_], of[runs_]))]
        begins = start[runs_]
        until = np.cumsum((same + more)[send])
        part = (h[first[send]] % np.uint64(buckets)).astype(np.int64)
        out = []
        for x in _parts(part):
            k = send[x]
            lead = first[k]
            size = end[lead] - start[lead]
            row, nth = _spread((same + more)[k])
            own_begins = begins[(until[x] - (same + more)[k])[row] + nth]
            row, nth = _spread(size)
            flat = group.flat[start[lead][row] + nth].tobytes()
            out.append((int(part[x[0]]), key[0].as_py(), _pack(np.diff(h[lead], prepend=np.uint64(0)), size, low[k], same[k], more[k], own_begins) + flat))
        return _sent(out)

    return pieces


def union(start: np.ndarray, end: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals joined where they overlap or touch, except where one begins at one of the cuts."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.append(True, start[1:] > end[:-1]) | np.isin(start, cuts)
    new[0] = True
    # an interval that begins at a cut can't be inside another, but a later one may begin at the same cut
    new[1:] &= ~((start[1:] == start[:-1]))
    first = np.flatnonzero(new)
    return start[first], np.append(end[first[1:] - 1], end[-1])


def _digest(body: bytes, start: np.ndarray, end: np.ndarray) -> tuple[int, int, int, str]:
    kept = b"".join(body[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(body)]))
    return len(body), len(body) - len(kept), len(start), sha256(kept)


def _gone(pieces: np.ndarray, size: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array of pieces that lie one after another: (piece, start, end) of stretches that a smaller id has."""
    start = np.cumsum(size + 1) - size - 1
    flat = np.zeros(len(pieces) + len(size), np.uint8)
    inner = np.ones(len(flat), bool)
    inner[start + size] = False
    flat[inner] = pieces
    order, common = sorted_windows(flat, start, start + size, WIDTH)
    of = np.searchsorted(start, order, "right") - 1
    head = np.flatnonzero(common < WIDTH)
    least = np.minimum.reduceat(low[of], head)
    place = np.sort(order[low[of] > least[np.cumsum(common < WIDTH) - 1]])
    of = np.searchsorted(start, place, "right") - 1
    if not len(place):
        return place, place, place
    first = np.flatnonzero(_heads(place - np.arange(len(place)), of))
    last = place[np.append(first[1:], len(place)) - 1]
    of, begin = of[first], place[first]
    return of, begin - start[of], last - start[of] + WIDTH


def _places(key: tuple, table: pa.Table) -> pa.Table:
    """For each group, where the strings lie in its documents that a smaller id has too."""
    cols: list[list[np.ndarray]] = [[] for _ in range(6)]
    flats, owners = [], []
    for g, cell in zip(table.column("g").to_pylist(), table.column("body")):
        data = cell.as_py()
        (step, *rest, begins), at = _unpack(data, 6)
        for col, x in zip(cols, (np.cumsum(step), *rest, begins)):
            col.append(x)
        owners.append(np.full(len(step), g, np.int64))
        flats.append(np.frombuffer(data, np.uint8, offset=at))
    if not owners:
        return _sent([])
    h, size, low, same, more, begins = (np.concatenate(x) for x in cols)
    g, flat = np.concatenate(owners), np.concatenate(flats)
    at, runs_at = np.cumsum(size) - size, np.cumsum(same + more) - same - more
    # equal pieces become one, of their smallest id
    numbers: dict[tuple[int, bytes], int] = {}
    body, bounds = flat.tobytes(), zip(h.tolist(), at.tolist(), (at + size).tolist())
    of = np.fromiter((numbers.setdefault((k, body[x:y]), len(numbers)) for k, x, y in bounds), np.int64, len(h))
    del body, numbers
    order = np.lexsort((low, of))
    lead = order[_heads(of[order])]  # of each different piece, the cell row with its smallest id
    owner = low[lead]
    mine = low == owner[of]
    rows_, none = np.arange(len(h)), np.zeros(len(h), np.int64)
    found = [(rows_, none, size, np.where(mine, same, 0), np.where(mine, more, same + more))]
    # of a hash's different pieces, strings are sorted together; hashes one after another until there are enough bytes
    order = np.argsort(h[lead], kind="stable")
    new = np.append(_heads(h[lead[order]]), True)
    order = order[~(new[1:] & new[:-1])]  # a hash's only piece has none to be compared with
    bounds = np.flatnonzero(np.append(_heads(h[lead[order]]), True)) if len(order) else np.zeros(1, np.int64)
    until = np.append(0, np.cumsum(size[lead[order]]))[bounds]
    stretches: list[tuple[np.ndarray, ...]] = []
    k = 0
    while k < len(bounds) - 1:
        nxt = max(k + 1, int(np.searchsorted(until, until[k] + SORTED_BYTES, "right")) - 1)
        own = order[bounds[k] : bounds[nxt]]
        k = nxt
        row, nth = _spread(size[lead[own]])
        x, s, e = _gone(flat[at[lead[own]][row] + nth], size[lead[own]], owner[own])
        stretches.append((own[x], s, e))
    if stretches:  # they are gone from the runs of each cell row that has the piece's smallest id
        x, s, e = (np.concatenate(c) for c in zip(*stretches))
        holders = np.flatnonzero(mine)
        holders = holders[np.argsort(of[holders], kind="stable")]
        low_, high = np.searchsorted(of[holders], x), np.searchsorted(of[holders], x, "right")
        row, nth = _spread(high - low_)
        piece = holders[low_[row] + nth]
        found.append((piece, s[row], e[row], np.zeros(len(piece), np.int64), same[piece]))
    piece, s, e, first, n = (np.concatenate(x) for x in zip(*found))
    row, nth = _spread(n)
    begin = begins[(runs_at[piece] + first)[row] + nth]
    s, e, owner = begin + s[row], begin + e[row], g[piece[row]]
    out = []
    for x in _parts(owner):
        x = x[np.argsort(s[x], kind="stable")]
        out.append((key[0].as_py(), int(owner[x[0]]), _pack(np.diff(s[x], prepend=0), e[x] - s[x])))
    return _sent(out)


_DONE_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _finish(key: tuple, docs: pa.Table, places: pa.Table) -> pa.Table:
    if not docs.num_rows:
        return _DONE_ARROW.empty_table()
    group = _Group(docs)
    s, e = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x in places.column("body"):
        (step, size), _ = _unpack(x.as_py(), 2)
        s.append(np.cumsum(step))
        e.append(s[-1] + size)
    a, b = union(np.concatenate(s), np.concatenate(e), group.ends)
    lo, hi = np.searchsorted(a, group.ends[:-1]), np.searchsorted(a, group.ends[1:])
    out = []
    for k, (body, base) in enumerate(zip(group.bodies, group.ends.tolist())):
        i = None if group.null[k] else int(group.ids[k])
        out.append((i, *_digest(body, a[lo[k] : hi[k]] - base, b[lo[k] : hi[k]] - base)))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _DONE_ARROW.types)], schema=_DONE_ARROW)


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    picked = texts(df, id_col, text_col)
    total = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups, buckets = max(parts, -(-total // GROUP_BYTES)), max(parts, -(-total // BUCKET_BYTES))
    docs = picked.withColumn("g", F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int"))
    offers = docs.groupBy("g").applyInArrow(_offer(buckets), _SENT)
    answers = offers.groupBy("bucket").applyInArrow(_answer(HOT), _SENT)
    pieces = docs.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(_pieces(buckets), _SENT)
    places = pieces.groupBy("bucket").applyInArrow(_places, _SENT)
    return docs.groupBy("g").cogroup(places.groupBy("g")).applyInArrow(_finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir))


QUERIES = {"op3_suffix_dedup": op3_suffix_dedup}
ORACLES: dict[str, str] = {}
