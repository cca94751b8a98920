"""Secret scans: keywords by Aho-Corasick, anchored expressions only near hits, checksums where a format embeds one.

All keywords and expressions are ASCII, so texts are scanned as UTF-8 bytes and positions turned into code points only
for what is found. Each kind takes its leftmost matches that don't overlap, as a scan of the whole text would: hits
come in order, a hit inside an earlier match of its kind is passed by, and a match that fails its length or checksum
is dropped but still spends its characters. A run of hexadecimal digits has no keyword; its expression runs as it is.

Null text is the empty text: no spans, base_sha256 of the empty string. Repeated rows are scanned each; null ids stay
null; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, rows, sha256, texts

# The formats' own letters, lengths and checks.
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_RUN = re.compile(rb"[0-9a-f]{32,}")


def crc_tail(token: bytes) -> bool:
    """prefix_, thirty letters, and their CRC-32 as six base-62 digits, as in access tokens of code hosts and registries."""
    body, tail = token[-36:-6], token[-6:]
    n = 0
    for c in tail:
        n = n * 62 + BASE62.index(c)
    return zlib.crc32(body) == n


def luhn(digits: bytes) -> bool:
    ds = [c - 48 for c in digits if 48 <= c <= 57]
    return 13 <= len(ds) <= 19 and sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(ds))) % 10 == 0


def iban(number: bytes) -> bool:
    n = number.replace(b" ", b"")
    return int("".join(str(int(chr(c), 36)) for c in n[4:] + n[:4])) % 97 == 1


Kind = tuple[str, tuple[bytes, ...], "re.Pattern[bytes]", Callable[["re.Match[bytes]"], bool]]
#: Kinds in order; the first two and hex are the base. Keywords are in lower case and stand at a match's first byte.
KINDS: list[Kind] = [
    (
        "assign",
        (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"),
        re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
        lambda m: len(m[2]) >= 8,
    ),
    ("access", (b"akia",), re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", (), HEX_RUN, lambda m: True),
    ("host_token", (b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_"), re.compile(rb"gh[pousr]_[A-Za-z0-9]+"), lambda m: len(m[0]) == 40 and crc_tail(m[0])),
    ("registry_token", (b"npm_",), re.compile(rb"npm_[A-Za-z0-9]+"), lambda m: len(m[0]) == 40 and crc_tail(m[0])),
    ("signed_token", (b"eyj",), re.compile(rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), lambda m: len(m[0]) >= 40),
    ("private_key", (b"-----begin",), re.compile(rb"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )*PRIVATE KEY-----"), lambda m: True),
    ("chat_token", (b"xoxa-", b"xoxb-", b"xoxp-", b"xoxr-", b"xoxs-"), re.compile(rb"xox[abprs]-[A-Za-z0-9-]+"), lambda m: len(m[0]) >= 20),
    ("card", (b"card",), re.compile(rb"card(?: ?(?:no|number|#))?[.:=]?\x20*((?:[0-9][ -]?){13,19})(?![0-9])", re.I), lambda m: luhn(m[1])),
    ("iban", (b"iban",), re.compile(rb"IBAN[:=]?\x20*([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?)(?![A-Z0-9])"), lambda m: iban(m[1])),
]
BASE = ("assign", "access", "hex")
#: Letters that a kind's first part takes up to its end, so that all hits of one run fail together, and are tried once.
RUNS = {"signed_token": re.compile(rb"[A-Za-z0-9_-]+")}


def _automaton() -> ahocorasick.Automaton:
    found: dict[str, list[int]] = {}
    for k, (_, words, _, _) in enumerate(KINDS):
        for w in words:
            found.setdefault(w.decode(), []).append(k)
    a = ahocorasick.Automaton()
    for w, kinds in found.items():
        a.add_word(w, (len(w), tuple(kinds)))
    a.make_automaton()
    return a


_AUTOMATON = _automaton()


def byte_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) in bytes, by start, then kind."""
    hits: dict[int, list[int]] = {}
    for last, (n, kinds) in _AUTOMATON.iter(data.lower().decode("latin-1")):
        for k in kinds:
            hits.setdefault(k, []).append(last - n + 1)
    out = []
    for k, starts in hits.items():
        kind, _, expression, holds = KINDS[k]
        run, free, lost = RUNS.get(kind), 0, 0
        for at in sorted(starts):
            if at < max(free, lost):
                continue
            if m := expression.match(data, at):
                free = m.end()
                if holds(m):
                    out.append((at, k, free))
            elif run:
                lost = run.match(data, at).end()
    out += [(m.start(), 2, m.end()) for m in HEX_RUN.finditer(data)]
    return sorted(out)


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    data = text.encode()
    found = byte_spans(data)
    if len(data) == len(text):
        return [(KINDS[k][0], s, e) for s, k, e in found]
    out, at, points = [], 0, 0
    for s, k, e in found:
        points += len(data[at:s].decode())
        at = s
        out.append((KINDS[k][0], points, points + e - s if data[s:e].isascii() else points + len(data[s:e].decode())))
    return out


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols: list[list] = [[] for _ in range(6)]
        for (part,) in rows(iter([batch]), "text"):
            for text in part:
                spans = scan(text)
                base = [x for x in spans if x[0] in BASE]
                for c, v in zip(cols, [*(sum(x[0] == k for x in base) for k in BASE), sha256(_listed(base).encode()), _listed(spans), len(spans) - len(base)]):
                    c.append(v)
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, kinds))],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_more"],
        )


def secret_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return texts(df, id_col, text_col).mapInArrow(
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_more long"
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(documents(spark, sf_dir))


QUERIES = {"op4_secret_scan": op4_secret_scan}
ORACLES: dict[str, str] = {}
