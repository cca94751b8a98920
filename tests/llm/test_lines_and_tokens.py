"""Cross-tokenizer alignment, line dedup and fill-in-middle against brute force, on small tables with the odd cases."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers as vocabularies
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shardwright.llm import alignment, fill_in_middle, line_dedup

SCHEMA = "doc_id long, text string, lang string, pos string, line int, pair string, h1 string, n_bytes string, mark int, row string, gone int, seg int"
DATA = "/root/testdata/sf0.001"
LINE = "This line of some twenty characters  "
TEXTS = [
    "", None, "a", " \n\n \t", LINE, f"x\n{LINE}\n{LINE.upper()}\ny", f"\t{LINE.lower()}\r\nown line of this document, long enough\n", "\n".join([LINE] * 40), "ÉCOLE DES LIGNES COMMUNES É\nz", "école des lignes communes é\nz", "ÉCOLE des lignes COMMUNES É",
    "twenty code points é", "TWENTY code points é\n", "twenty CODE points é\n\n", "nineteen code poinés", "nineteen code poinés\n", "nineteen code poinés", "a<P>b", "a < P > <S", "<M", "漢字🙂 straße <|endoftext|> </s> <0x41> ▁", "  two  spaces \n tabs\t.", "\0 \x1c \x85", "of of of the the", "=" * 300, "漢" * 200, "the " * 4000,
    "".join(random.Random(3).choice("ab é漢🙂\n.") for _ in range(30000)),
]


@pytest.fixture(scope="module")
def docs(spark):
    more = ("en", "p", 1, "q", "h", "b", 2, "r", 3, 4)
    rows = [(i, t, *more) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], *more), (5, f"other\n{LINE}", *more), (None, LINE + "\nnull id", *more), (None, TEXTS[7], *more), (None, None, *more)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def shared(spark):
    return alignment.shared_aligner(spark, vocabularies.path("byte_bpe_50k.json"), vocabularies.path("piece_bpe_32k.model"))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_empty_tables(empty, shared):
    for out in (alignment.aligned(empty, shared), alignment.alignments(empty, shared), line_dedup.line_dedup(empty), fill_in_middle.fill_in_middle(empty)):
        assert out.count() == 0


# alignment


class Plain:
    """Both libraries over whole texts; groups end where ends of both tokenizers meet."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(vocabularies.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=vocabularies.path("piece_bpe_32k.model"))
        self.a.encode_special_tokens = True
        stands_for = alignment.byte_level()
        self.a_bytes = {i: bytes(stands_for[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}

    def groups(self, text):
        if not text:
            return []
        data, out = (" " + text).encode(), []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        a_bytes = [self.a_bytes[i] for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, self.b.id_to_piece(b))]
        if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            return []
        a_end, b_end = np.cumsum(list(map(len, a_bytes))).tolist(), np.cumsum(list(map(len, b_bytes))).tolist()
        i = j = 0
        for end in sorted(set(a_end) & set(b_end)):
            p, q = a_end.index(end, i) + 1, b_end.index(end, j) + 1
            out.append((a[i:p], b[j:q]))
            i, j = p, q
        return out


def aligned_by_hand(rows):
    plain, held, count = Plain(), [], Counter()
    for i, t in rows:
        groups = plain.groups(t)
        links = Counter((x, y) for a, b in groups for x in a for y in b)
        held.append((i, groups, links))
        count.update(links.keys())
    high = defaultdict(int)
    for (x, _), n in count.items():
        high[x] = max(high[x], n)
    out = []
    for i, groups, links in held:
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        best = sum(n for p, n in links.items() if count[p] == high[p[0]])
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values()), best, sum(n * count[p] for p, n in links.items()), digest(said) if groups else ""))
    return sorted(out, key=str)


@pytest.mark.parametrize("head", [0, 40, 1_000_000])
def test_alignment(docs, shared, monkeypatch, head):
    monkeypatch.setattr(alignment, "HEAD", head)
    want = aligned_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(alignment.aligned(docs, shared)) == want
    assert sum(r[1] == 0 for r in want) == 4  # null twice, empty, and a text with U+2581


def test_alignment_of_real_texts(spark, shared):
    some = spark.read.parquet(f"{DATA}/documents.parquet")
    assert rows_of(alignment.aligned(some, shared)) == aligned_by_hand([(r.doc_id, r.text) for r in some.collect()])


def test_alignment_in_blocks_and_with_little_memory(monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 50)
    monkeypatch.setattr(alignment, "MEMO", 20_000)
    monkeypatch.setattr(alignment, "SMALL", 1)
    with open(vocabularies.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(vocabularies.path("piece_bpe_32k.model"), "rb") as b:
        aligner = alignment.Aligner(a.read(), b.read())
    r, plain = random.Random(1), Plain()
    texts = [t or "" for t in TEXTS] + ["".join(r.choice(" \n\t ab.é漢🙂\x1c\x85  's12\x00﻿!") for _ in range(r.randrange(1, 70))) for _ in range(3000)]
    for at in range(0, len(texts), 100):
        for t, found in zip(texts[at : at + 100], aligner.texts(texts[at : at + 100])):
            groups = plain.groups(t)
            assert (found is None) == (not groups), t
            if groups:
                links = Counter(x << alignment.LOW | y for a, b in groups for x in a for y in b)
                assert dict(zip(found.pair.tolist(), found.times.tolist())) == links and found.n_groups == len(groups), t
                assert aligner.groups(t) == groups


def test_union_find():
    r = np.random.default_rng(2)
    for n in (1, 2, 50, 400):
        u, v = r.integers(0, n, n // 2), r.integers(0, n, n // 2)
        label = list(range(n))
        for _ in range(n):
            for a, b in zip(u, v):
                label[a] = label[b] = min(label[a], label[b])
        assert alignment.united(n, u, v).tolist() == label


# lines


def lines_by_hand(rows, min_chars=20, min_docs=3):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                held[key(line)].add(i)
    keeper = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keeper.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("heavy", [10_000, 7])
def test_line_dedup(docs, monkeypatch, heavy):
    monkeypatch.setattr(line_dedup, "HEAVY", heavy)
    want = lines_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(line_dedup.line_dedup(docs)) == want and sum(r[2] for r in want) > 40


def test_line_dedup_of_few_lines(spark):
    r = random.Random(4)
    pool = ["".join(r.choice("abC \t") for _ in range(r.randrange(1, 6))) for _ in range(30)]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randrange(0, 12)))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(line_dedup.line_dedup(df, min_chars=2, min_docs=2)) == lines_by_hand(rows, 2, 2)


def test_line_dedup_is_native(docs):
    plan = line_dedup.line_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


# fill-in-middle


def fim_by_hand(i, t):
    t = t or ""
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(t)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = t[:low], t[low:high], t[high:]
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, n, "plain", None, None, t
    if h4 % 100 < 20:
        return i, n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("giant", [4 << 20, 30, 0])
def test_fill_in_middle(docs, monkeypatch, giant):
    monkeypatch.setattr(fill_in_middle, "GIANT", giant)
    monkeypatch.setattr(fill_in_middle, "SEGMENT", 70)
    monkeypatch.setattr(fill_in_middle, "CHUNK", 16)
    many = docs.select("doc_id", "text").union(docs.selectExpr("doc_id + 1000", "concat(text, ' <', text)"))
    out = fill_in_middle.fill_in_middle(many)
    want = sorted((fim_by_hand(r.doc_id, r.text) for r in many.collect()), key=str)
    assert rows_of(out.select("doc_id", "n", "form", "prefix_units", "middle_units", "output")) == want
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    assert all(r.back == r.text for r in out.select("text", fill_in_middle.restored(out["output"], out["form"]).alias("back")).collect())


def test_automata_compose():
    r = random.Random(7)
    for automaton, count in ((fill_in_middle.CODE_POINTS, len), (fill_in_middle.LINES, lambda t: t.count("\n")), (fill_in_middle.MARKERS, lambda t: sum(t.count(x) for x in ("<P>", "<S>", "<M>")))):
        texts = ["".join(r.choice("<PSM>é漢🙂\na") for _ in range(r.randrange(0, 1500))) for _ in range(40)] + ["", "", "<<P>><P", "\n"]
        data = [t.encode() for t in texts]
        scan = fill_in_middle.Scan(automaton, np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
        n = scan.count[scan.end, 0]
        assert n.tolist() == list(map(count, texts))
        if automaton is fill_in_middle.CODE_POINTS:
            rank = np.array([r.randrange(k + 1) for k in n.tolist()])
            at = scan.located(np.zeros(len(texts), np.int64), rank)
            assert at.tolist() == [len(t[:k].encode()) for t, k in zip(texts, rank.tolist())]


@pytest.mark.parametrize("module", [line_dedup, fill_in_middle])
def test_same_as_sql(spark, module):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    for name, sql in module.ORACLES.items():
        ours = module.QUERIES[name](spark, DATA)
        theirs = con.sql(sql)
        assert sorted(ours.columns) == sorted(theirs.columns)
        assert rows_of(ours.select(*theirs.columns)) == sorted(theirs.fetchall(), key=str)
