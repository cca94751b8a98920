"""Media columns: what binary values hold, by signature and structure.

One Aho-Corasick pass locates the magic bytes of all formats in a value. At each hit the format's validator walks the
structure (chunk lengths, checksums, markers, trailers) and gives the exact length, or nothing where the magic bytes
were chance. The type at offset 0 corrects the declared one; whole files at later offsets are carved, leftmost first,
without overlaps.

store() keeps bytes losslessly as 8-bit samples of a RIFF wave file, and read() gives them back through the same
walk. Null values and null texts are empty: type application/octet-stream, nothing embedded; an empty text is stored
as 64 zero samples. Repeated rows and null ids pass through; equal values give equal results; no shuffle takes place.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, rows, sha256, texts

BLOCK = 64
UNKNOWN = "application/octet-stream"
#: What validators of one value share: places that walks have passed (none of them led to a file's end, or it would have
#: been carved and later hits inside it passed by), and the ends of archives. So a place is walked once, however many
#: magic bytes lead there.
Seen = dict


def png_end(b: bytes, at: int, seen: Seen) -> int | None:
    at += 8
    first, passed = True, seen.setdefault("png", set())
    while at + 12 <= len(b) and (first or at not in passed):
        if not first:
            passed.add(at)
        n = int.from_bytes(b[at : at + 4], "big")
        kind, end = b[at + 4 : at + 8], at + 12 + n
        if end > len(b) or first != (kind == b"IHDR") or zlib.crc32(b[at + 4 : end - 4]) != int.from_bytes(b[end - 4 : end], "big"):
            return None
        if kind == b"IEND":
            return end
        at, first = end, False
    return None


def gif_end(b: bytes, at: int, seen: Seen) -> int | None:
    if at + 13 > len(b):
        return None
    flags = b[at + 10]
    at += 13 + (3 << (flags & 7) + 1 if flags & 128 else 0)
    passed = seen.setdefault("gif", set())
    while at < len(b) and at not in passed:
        passed.add(at)
        if b[at] == 0x3B:
            return at + 1
        if b[at] == 0x21:
            at += 2
        elif b[at] == 0x2C and at + 10 <= len(b):
            flags = b[at + 9]
            at += 11 + (3 << (flags & 7) + 1 if flags & 128 else 0)
        else:
            return None
        while at < len(b) and b[at]:
            at += b[at] + 1
        at += 1
    return None


def jpeg_end(b: bytes, at: int, seen: Seen) -> int | None:
    at += 2
    passed = seen.setdefault("jpeg", set())
    while at + 4 <= len(b) and b[at] == 0xFF and at not in passed:
        passed.add(at)
        marker = b[at + 1]
        n = int.from_bytes(b[at + 2 : at + 4], "big")
        if marker == 0xD9 or n < 2 or at + 2 + n > len(b):
            return None
        at += 2 + n
        if marker == 0xDA:
            while (at := b.find(b"\xff", at)) >= 0 and at + 1 < len(b):
                if b[at + 1] == 0xD9:
                    return at + 2
                if b[at + 1] == 0 or 0xD0 <= b[at + 1] <= 0xD7 or b[at + 1] == 0xFF:
                    at += 1 + (b[at + 1] != 0xFF)
                else:
                    break
            if at < 0:
                return None
    return None


def bmp_end(b: bytes, at: int, seen: Seen) -> int | None:
    if at + 26 > len(b):
        return None
    size, reserved, pixels, header = struct.unpack_from("<IIII", b, at + 2)
    ok = reserved == 0 and header in (12, 40, 52, 56, 108, 124) and 14 + header <= pixels <= size and at + size <= len(b)
    return at + size if ok else None


def riff_chunks(b: bytes, at: int) -> tuple[int, dict[bytes, tuple[int, int]]] | None:
    """End of the file at `at`, and where each chunk's first data lies; None unless lengths add up."""
    if at + 12 > len(b):
        return None
    end = at + 8 + int.from_bytes(b[at + 4 : at + 8], "little")
    if end > len(b):
        return None
    chunks, p = {}, at + 12
    while p + 8 <= end:
        n = int.from_bytes(b[p + 4 : p + 8], "little")
        if p + 8 + n > end:
            return None
        chunks.setdefault(b[p : p + 4], (p + 8, n))
        p += 8 + n + n % 2
    return (end, chunks) if chunks and p in (end, end + 1) else None


#: The chunk that a form must hold, by the begin of its name.
_NEED = {b"WAVE": b"fmt ", b"WEBP": b"VP8", b"AVI ": b"LIST"}


class RiffChunks:
    """Chunks as all RIFF headers of a value reach them, each place read once however many headers lead there.

    From a place the walk goes on to one next place, so walks that meet stay together: a forest. Each place knows its
    depth, the next place and one further on (twice as far where depths allow), so that the last place up to a given one
    is found in logarithmic steps, and the nearest place of each wanted kind.
    """

    def __init__(self, b: bytes):
        self.b, self.place = b, {}
        at = -1
        while (at := b.find(b"RIFF", at + 1)) >= 0:
            fresh, p = [], at + 12
            while p not in self.place and (ends := self.data_end(p)) is not None:
                fresh.append(p)
                p = ends + (ends - p) % 2
            if p not in self.place:  # no chunk lies here
                self.place[p] = (0, p, p, (None,) * len(_NEED))
            for q in reversed(fresh):
                depth, _, jump, near = self.place[p]
                further = self.place[jump]
                even = depth - further[0] == further[0] - self.place[further[2]][0]
                kind = b[q : q + 4]
                self.place[q] = (depth + 1, p, further[2] if even else p, tuple(q if kind.startswith(k) else n for k, n in zip(_NEED.values(), near)))
                p = q

    def data_end(self, p: int) -> int | None:
        """End of the data of the chunk at p, padding left out."""
        n = int.from_bytes(self.b[p + 4 : p + 8], "little")
        return p + 8 + n if p + 8 + n <= len(self.b) else None

    def end(self, at: int) -> int | None:
        """End of the file whose header is at `at`, as riff_chunks() finds it, if it holds the chunk that its form needs."""
        form, p = self.b[at + 8 : at + 12], at + 12
        end = at + 8 + int.from_bytes(self.b[at + 4 : at + 8], "little")
        if form not in _NEED or not p < end <= len(self.b):
            return None
        near = self.place[p][3][list(_NEED).index(form)]
        while (now := self.place[p])[0] and now[1] <= end:
            p = now[2] if now[2] <= end else now[1]
        if p != end and self.data_end(p) != end:  # the last chunk's padding may be beyond
            return None
        return end if near is not None and near < end else None


def riff_end(b: bytes, at: int, seen: Seen) -> int | None:
    if "riff" not in seen:
        seen["riff"] = RiffChunks(b)
    return seen["riff"].end(at)


def pdf_end(b: bytes, at: int, seen: Seen) -> int | None:
    if not (b[at + 5 : at + 6].isdigit() and b[at + 6 : at + 7] == b"." and b[at + 7 : at + 8].isdigit()):
        return None
    nxt = b.find(b"%PDF-", at + 5)
    end = b.rfind(b"%%EOF", at, nxt if nxt > 0 else len(b))
    return end + 5 if end > 0 and b.find(b"startxref", at, end) > 0 else None


def zip_end(b: bytes, at: int, seen: Seen) -> int | None:
    if "zip" not in seen:  # of each archive's begin, its first end
        ends, p = seen.setdefault("zip", {}), -1
        while (p := b.find(b"PK\x05\x06", p + 1)) >= 0 and p + 22 <= len(b):
            n, size, offset, comment = struct.unpack_from("<HIIH", b, p + 10)
            begin = p - size - offset
            if n and begin >= 0 and b[p - size : p - size + 4] == b"PK\x01\x02" and p + 22 + comment <= len(b):
                ends.setdefault(begin, p + 22 + comment)
    return seen["zip"].get(at)


def gzip_end(b: bytes, at: int, seen: Seen) -> int | None:
    """Inflates 64 KiB at a time, keeping nothing; the member's own checksum and length decide."""
    d, p = zlib.decompressobj(31), at
    try:
        while not d.eof and p < len(b):
            d.decompress(d.unconsumed_tail or b[p : p + 65536], 65536)
            if not d.unconsumed_tail:
                p += 65536
        return min(p, len(b)) - len(d.unused_data) if d.eof else None
    except zlib.error:
        return None


#: Type, magic bytes, validator. The formats' own signatures.
FORMATS: list[tuple[str, tuple[bytes, ...], Callable[[bytes, int, Seen], int | None]]] = [
    ("image/png", (b"\x89PNG\r\n\x1a\n",), png_end),
    ("image/gif", (b"GIF87a", b"GIF89a"), gif_end),
    ("image/jpeg", (b"\xff\xd8\xff",), jpeg_end),
    ("image/bmp", (b"BM",), bmp_end),
    ("audio/wav", (b"RIFF",), riff_end),
    ("application/pdf", (b"%PDF-",), pdf_end),
    ("application/zip", (b"PK\x03\x04",), zip_end),
    ("application/gzip", (b"\x1f\x8b\x08",), gzip_end),
]
_RIFF = {b"WAVE": "audio/wav", b"WEBP": "image/webp", b"AVI ": "video/avi"}


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for k, (_, magics, _) in enumerate(FORMATS):
        for m in magics:
            a.add_word(m.decode("latin-1"), (k, len(m)))
    a.make_automaton()
    return a


_AUTOMATON = _automaton()


def sniff(data: bytes) -> tuple[str, int, list[tuple[str, int, int]]]:
    """(type at offset 0, its length or that of all data, [(type, offset, length) of embedded files])."""
    top, length, inner, free = UNKNOWN, len(data), [], 1
    seen: Seen = {}
    for last, (k, n) in _AUTOMATON.iter(data.decode("latin-1")):
        at = last - n + 1
        if 0 < at < free:
            continue
        end = FORMATS[k][2](data, at, seen)
        if end is None:
            continue
        kind = _RIFF.get(data[at + 8 : at + 12], "") if FORMATS[k][0] == "audio/wav" else FORMATS[k][0]
        if at == 0:
            top, length = kind, end
            seen = {}
        else:
            inner.append((kind, at, end - at))
            free = end
    return top, length, inner


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % BLOCK or (0 if data else BLOCK))


def store(payload: bytes, rate: int = 8000) -> bytes:
    """A RIFF wave file of one channel of unsigned 8-bit samples; the payload's length is even."""
    head = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(payload))
    return b"RIFF" + struct.pack("<I", len(head) + len(payload)) + head + payload


def read(media: bytes) -> bytes:
    found = riff_chunks(media, 0)
    if media[8:12] != b"WAVE" or found is None or b"data" not in found[1]:
        raise ValueError("not a wave file")
    at, n = found[1][b"data"]
    return media[at : at + n]


def sniffed(df: DataFrame, key: str, blob: str, declared: str | None = None) -> DataFrame:
    """key, declared, detected, corrected, length and embedded (an array of type, offset, length, content) for a binary column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_type = pa.struct([("type", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("content", pa.binary())])
        for batch in batches:
            for keys, blobs, said in rows(iter([batch]), "key", "blob", "declared"):
                found = [sniff(b or b"") for b in blobs]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.string()),
                        pa.array(said, pa.string()),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([s != f[0] for s, f in zip(said, found)], pa.bool_()),
                        pa.array([f[1] for f in found], pa.int64()),
                        pa.array([[{"type": t, "offset": o, "length": n, "content": b[o : o + n]} for t, o, n in f[2]] for b, f in zip(blobs, found)], pa.list_(part_type)),
                    ],
                    names=["key", "declared", "detected", "corrected", "length", "embedded"],
                )

    picked = df.select(F.col(key).cast("string").alias("key"), F.col(blob).cast("binary").alias("blob"), (F.col(declared) if declared else F.lit(None)).cast("string").alias("declared"))
    return picked.mapInArrow(run, "key string, declared string, detected string, corrected boolean, length long, embedded array<struct<type:string,offset:long,length:long,content:binary>>")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        cols: list[list] = [[] for _ in names]
        for (part,) in rows(iter([batch]), "text"):
            for text in part:
                data = text.encode()
                media = store(padded(data))
                kind, length, inner = sniff(media)
                back = read(media[:length])
                feature = f"{UNKNOWN}>{kind};samples={len(back)};embedded={'+'.join(f'{t}@{o}:{n}' for t, o, n in inner) or 'none'}"
                for c, v in zip(cols, (len(data), len(back), sha256(back), zlib.crc32(back[-BLOCK:]), len(media), sha256(media), feature)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, kinds))], names=["doc_id", *names])


def media_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text stored as a wave file, sniffed, read back and described."""
    return texts(df, id_col, text_col).mapInArrow(
        _digest, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    )


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digests(documents(spark, sf_dir))


QUERIES = {"op7_media_columns": op7_media_columns}
ORACLES: dict[str, str] = {}
