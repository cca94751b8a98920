"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens.

Pre-tokens are the words between white space (0x20, 0x09 to 0x0D), each with the word mark before it. A worker inserts
the different pre-tokens of its documents, some million bytes at a time, into a trie. A node is a prefix; its forward
score is the best sum of piece scores over all ways to cut that prefix, computed once for all pre-tokens that share it,
with the token count of that best cut (of equal scores the fewest tokens). Terminals store their counts, and a
document's count is the sum over its pre-tokens. A character that no piece covers costs its UTF-8 bytes.

The trie is laid out by depth: sorted pre-tokens put each node's terminals side by side, so all nodes of a depth follow
from those above in one numpy step. Terminals' counts outlive their trie until KNOWN are stored. A pre-token of over
LONG characters runs through the same recurrence on its own, a node at a time.

Null text is the empty text: no pre-token, no token. Repeated rows are counted each; null ids stay null; an empty
table gives an empty result. No shuffle takes place.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, rows, texts

MARK = "▁"
LONG = 128
#: Pre-tokens of one trie, text bytes whose pre-tokens are gathered for it, terminals remembered.
WORDS, GATHERED, KNOWN = 200_000, 4 << 20, 400_000
#: Bits of a code point in a key (node, code point) of the pieces' own trie.
POINT = 21
FAR = np.iinfo(np.int64).max


def read_scores(path: str) -> dict[str, float]:
    """Pieces of a sentencepiece model with unigram log-probabilities by their rank (Zipf's law with exponent 1)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        (-model.get_score(i), i, model.id_to_piece(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    whole = math.log(sum(1 / (k + 1) for k in range(len(pieces))))
    return {p: -math.log(k + 1) - whole for k, (_, _, p) in enumerate(sorted(pieces))}


def _points(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)


def _byte_lengths(points: np.ndarray) -> np.ndarray:
    return 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)


class UnigramTrie:
    """Scores of pieces, and the terminals of the pre-tokens inserted so far.

    A node keeps its open pieces: the starts from which its prefix may still grow into a piece, each with the place in
    the pieces' own trie, and the score and tokens before the start. They make a node's score follow from its parent.
    """

    def __init__(self, scores: dict[str, float]):
        steps: dict[int, int] = {}
        ends = {}
        for piece, score in scores.items():
            node = 0
            for c in piece:
                node = steps.setdefault(node << POINT | ord(c), len(steps) + 1)
            ends[node] = score
        self.steps = steps
        self.keys = np.array(sorted(steps) or [-1], np.int64)
        self.kids = np.array([steps.get(k, 0) for k in self.keys.tolist()], np.int64)
        self.own = np.full(len(steps) + 1, -np.inf)
        self.own[list(ends)] = list(ends.values())
        #: A byte costs as much as a piece one rank below the last.
        self.byte = min(scores.values(), default=0.0) - 1.0
        self.terminals: dict[bytes, int] = {}

    def insert(self, words: Iterable[bytes]) -> None:
        """Stores the token counts of pre-tokens, given without their mark."""
        new = iter(words)
        while part := list(islice(new, WORDS)):
            marked = sorted((MARK + w.decode(), w) for w in part)
            short = [x for x in marked if len(x[0]) <= LONG]
            self.terminals.update(zip((w for _, w in short), self._by_depth([m for m, _ in short])))
            self.terminals.update((w, self._alone(m)) for m, w in marked if len(m) > LONG)

    def _by_depth(self, words: list[str]) -> list[int]:
        """Token counts of sorted words without repeats."""
        points, lengths = _points(words), np.array([len(w) for w in words], np.int64)
        first = np.cumsum(lengths) - lengths
        counts = np.zeros(len(words), np.int64)
        alive, node = np.arange(len(words)), np.zeros(len(words), np.int64)
        # the nodes of a depth: score and tokens; open pieces, a node's own start last, from `at` on, `many` of them
        score, tokens = np.zeros(1), np.zeros(1, np.int64)
        place, before, spent = np.zeros(1, np.int64), score, tokens
        at, many = np.zeros(1, np.int64), np.ones(1, np.int64)
        depth = 0
        while len(alive):
            c = points[first[alive] + depth]
            opens = np.ones(len(alive), bool)
            opens[1:] = (node[1:] != node[:-1]) | (c[1:] != c[:-1])
            parent, c = node[opens], c[opens]
            node = np.cumsum(opens) - 1

            wide = many[parent]
            of = np.repeat(np.arange(len(parent)), wide)
            taken = np.arange(len(of)) + np.repeat(at[parent] - (np.cumsum(wide) - wide), wide)
            key = place[taken] << POINT | c[of]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            live = np.flatnonzero(self.keys[found] == key)
            of, taken, grown = of[live], taken[live], self.kids[found[live]]
            cut, used = before[taken] + self.own[grown], spent[taken] + 1

            n = _byte_lengths(c)
            plain = score[parent] + n * self.byte
            best, fewest = plain.copy(), tokens[parent] + n
            if len(of):
                runs = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                heads = of[runs]
                best[heads] = np.maximum(plain[heads], np.maximum.reduceat(cut, runs))
                fewest[plain < best] = FAR
                tied = np.where(cut == best[of], used, FAR)
                fewest[heads] = np.minimum(fewest[heads], np.minimum.reduceat(tied, runs))

            many = np.bincount(of, minlength=len(parent)) + 1
            last = np.cumsum(many) - 1
            slots = np.arange(len(of)) + of
            place, spots, spends = np.zeros(len(of) + len(parent), np.int64), np.empty(len(of) + len(parent)), np.empty(len(of) + len(parent), np.int64)
            place[slots], spots[slots], spends[slots] = grown, before[taken], spent[taken]
            spots[last], spends[last] = best, fewest
            before, spent, at, score, tokens = spots, spends, last - many + 1, best, fewest

            depth += 1
            ends = lengths[alive] == depth
            counts[alive[ends]] = tokens[node[ends]]
            alive, node = alive[~ends], node[~ends]
        return counts.tolist()

    def _alone(self, word: str) -> int:
        """The same recurrence along one path."""
        score, tokens, starts = 0.0, 0, []
        for c in word:
            point, opened = ord(c), []
            n = len(c.encode())
            best, fewest = score + n * self.byte, tokens + n
            for place, s, t in (*starts, (0, score, tokens)):
                grown = self.steps.get(place << POINT | point)
                if grown is not None:
                    opened.append((grown, s, t))
                    cut = s + float(self.own[grown])
                    if cut > best or cut == best and t + 1 < fewest:
                        best, fewest = cut, t + 1
            score, tokens, starts = best, fewest, opened
        return tokens

    def counts(self, documents: list[Counter]) -> list[int]:
        """Tokens of each document, given as its pre-tokens with their numbers."""
        new = set().union(*documents) - self.terminals.keys()
        if len(self.terminals) + len(new) > KNOWN:
            self.terminals.clear()
            new = set().union(*documents)
        self.insert(new)
        get = self.terminals.__getitem__
        return [sum(n * get(w) for w, n in d.items()) for d in documents]


def pretokens(text: str) -> Counter:
    """Pre-tokens and their numbers; a long text is split a piece at a time, so no list of all its words arises."""
    data = text.encode()
    found: Counter = Counter()
    at = 0
    while len(data) - at > GATHERED:
        # the piece ends before its last word, unless that fills it: then the word's whole length is taken along
        head = data[at : at + GATHERED].split()
        end = data.rfind(head[-1], at, at + GATHERED) if len(head) > 1 else at
        if end > at:
            found.update(head[:-1])
            at = end
            continue
        rest = data[at:].split(None, 1)
        found.update(rest[:1])
        at = len(data) - len(rest[1]) if len(rest) > 1 else len(data)
    found.update(data[at:].split())
    return found


#: The worker's trie, and the scores it was made of.
_TRIES: list[tuple[dict[str, float], UnigramTrie]] = []


def _trie(scores: dict[str, float]) -> UnigramTrie:
    if not _TRIES or _TRIES[0][0] is not scores:
        _TRIES[:] = [(scores, UnigramTrie(scores))]
    return _TRIES[0][1]


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pretokens, n_distinct, n_tokens of each row."""
    # a vocabulary file's size doesn't depend on the input
    shared = df.sparkSession.sparkContext.broadcast(read_scores(path))

    def gathered(batch: pa.RecordBatch) -> Iterator[list[Counter]]:
        held, size = [], 0
        for (part,) in rows(iter([batch]), "text"):
            for text in part:
                held.append(pretokens(text))
                size += len(text)
                if size > GATHERED:
                    yield held
                    held, size = [], 0
        yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(shared.value)
        for batch in batches:
            n_words, n_distinct, n_tokens = [], [], []
            for held in gathered(batch):
                n_words += [d.total() for d in held]
                n_distinct += map(len, held)
                n_tokens += trie.counts(held)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_words, n_distinct, n_tokens))],
                names=["doc_id", "n_pretokens", "n_distinct", "n_tokens"],
            )

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, n_pretokens long, n_distinct long, n_tokens long")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocabularies

    return token_counts(documents(spark, sf_dir), vocabularies.path("piece_bpe_32k.model"))


QUERIES = {"op5_token_counts": op5_token_counts}
ORACLES: dict[str, str] = {}
