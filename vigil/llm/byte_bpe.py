"""Byte-level BPE: merge replay over the distinct pre-tokens of a share of the corpus, and decoding.

A task takes its share of the documents in Arrow batches. Their distinct pre-tokens (matches of
the tokenizer's pattern) that it has not met before stand as one chain of byte tokens each in
common arrays. An inverted index leads from the rank of a token pair to the positions where it
stands in any word; ranks are replayed in order, each at all its positions from left to right,
and only the two neighbours of a merged pair get new entries. A word whose merge makes a pair
of a lower rank waits with its other positions until that one is done, so every word is merged
as it would be alone (lowest rank first, then leftmost).

Documents are then put together from remembered words: no shuffle, and memory is bounded by
:data:`MOST_WORDS` remembered words, one batch and the vocabulary. A Python worker keeps its
words for the next task.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_RANKS = 1_000_000      # bound of the broadcast vocabulary
MOST_WORDS = 1_000_000       # words a worker remembers
BATCH_BYTES = 4 << 20       # text that is encoded together


@dataclass(frozen=True)
class Vocabulary:
    """Byte strings by rank (rank = id) and the pattern that cuts texts into pre-tokens."""

    ranks: dict[bytes, int]
    pattern: str
    tokens: dict[int, bytes] = field(init=False)
    single: np.ndarray = field(init=False)          # id of each byte
    pairs: np.ndarray = field(init=False)           # rank of each pair of bytes, or -1
    byte_pairs: dict[int, int] = field(init=False)  # the same by left id * 2**24 + right id

    def __post_init__(self):
        if len(self.ranks) > MOST_RANKS:
            raise ValueError(f"{len(self.ranks)} ranks; the bound is {MOST_RANKS}")
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        single = np.array([self.ranks[bytes([b])] for b in range(256)])
        pairs = np.full((256, 256), -1)
        for b, i in self.ranks.items():
            if len(b) == 2:
                pairs[b[0], b[1]] = i
        known = {int(single[a]) << 24 | int(single[b]): int(pairs[a, b]) for a, b in zip(*np.nonzero(pairs >= 0), strict=True)}
        for name, value in (("tokens", {i: b for b, i in self.ranks.items()}), ("single", single),
                            ("pairs", pairs), ("byte_pairs", known)):
            object.__setattr__(self, name, value)


def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    """Ranks from a file of ``base64 rank`` lines, read on the driver only."""
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}, pattern)


def replay_merges(words: Sequence[bytes], vocabulary: Vocabulary) -> list[list[int]]:
    """Ids of each word: a whole word of the vocabulary is one id, all others are merged."""
    ids, counts = _replay(words, vocabulary, dict(vocabulary.byte_pairs))
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] if len(words) else []


def _replay(words: Sequence[bytes], vocabulary: Vocabulary, known: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, number of each word's); ``known``: pair (left * 2**24 + right) -> rank or -1."""
    ranks, tokens = vocabulary.ranks, vocabulary.tokens
    whole = np.fromiter((ranks.get(w, -1) for w in words), np.int64, len(words))
    counts = (whole >= 0).astype(np.int64)
    open_ = [k for k in np.flatnonzero(whole < 0).tolist() if words[k]]
    if not open_:
        return whole[whole >= 0], counts
    sizes = np.array([len(words[k]) for k in open_])
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(words[k] for k in open_), np.uint8)
    n = len(raw)
    ids: list[int] = vocabulary.single[raw].tolist()
    of: list[int] = np.repeat(np.arange(len(open_)), sizes).tolist()    # word of a position
    chain = np.arange(1, n + 1)
    chain[starts + sizes - 1] = -1
    after: list[int] = chain.tolist()       # next position of the word; -1 at its end
    chain = np.arange(-1, n - 1)
    chain[starts] = -1
    before: list[int] = chain.tolist()

    # inverted index: rank that a pair merges to -> positions of its left token
    rank_at = np.full(n, -1)
    rank_at[:-1] = vocabulary.pairs[raw[:-1], raw[1:]]
    rank_at[starts + sizes - 1] = -1
    now: list[int] = rank_at.tolist()       # the same while ranks are replayed
    spot = np.flatnonzero(rank_at >= 0)
    spot = spot[np.argsort(rank_at[spot], kind="stable")]
    found, first = np.unique(rank_at[spot], return_index=True)
    where = {r: s.tolist() for r, s in zip(found.tolist(), np.split(spot, first[1:]), strict=False)}
    heap = found.tolist()

    while heap:
        rank = heapq.heappop(heap)
        spots = where.pop(rank, None)
        if spots is None:
            continue
        spots.sort()
        waits, held = -1, []                # word that has a lower pair now, and its positions
        for p in spots:
            if now[p] != rank:              # merged away since, or followed by another token now
                continue
            if of[p] == waits:
                held.append(p)
                continue
            q = after[p]
            ids[p], ids[q], now[q] = rank, -1, -1
            r = after[p] = after[q]
            if r >= 0:
                before[r] = p
                right = ids[r]
                x = known.get(rank << 24 | right)
                if x is None:
                    x = known[rank << 24 | right] = ranks.get(tokens[rank] + tokens[right], -1)
                now[p] = x
                if x >= 0:
                    if x in where:
                        where[x].append(p)
                    else:
                        where[x] = [p]
                        heapq.heappush(heap, x)
                    if x < rank:
                        waits = of[p]
            else:
                now[p] = -1
            b = before[p]
            if b >= 0:
                left = ids[b]
                x = known.get(left << 24 | rank)
                if x is None:
                    x = known[left << 24 | rank] = ranks.get(tokens[left] + tokens[rank], -1)
                now[b] = x
                if x >= 0:
                    if x in where:
                        where[x].append(b)
                    else:
                        where[x] = [b]
                        heapq.heappush(heap, x)
                    if x < rank:
                        waits = of[p]
        if held:
            if rank in where:
                where[rank].extend(held)
            else:
                where[rank] = held
                heapq.heappush(heap, rank)
    left_over = np.array(ids)
    alive = left_over >= 0
    counts[open_] = np.add.reduceat(alive, starts)
    flat = np.repeat(whole, counts)
    flat[flat < 0] = left_over[alive]
    return flat, counts


class _Lists:
    """Lists of ids in one growing array."""

    def __init__(self):
        self.ids, self.ends, self.size = np.zeros(1 << 16, np.int32), np.zeros(1 << 12, np.int64), 0

    def __len__(self) -> int:
        return self.size

    def extend(self, ids: np.ndarray, counts: np.ndarray) -> None:
        at, size = int(self.ends[self.size]), self.size + len(counts)
        while at + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while size >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[at: at + len(ids)] = ids
        self.ends[self.size + 1: size + 1] = at + np.cumsum(counts)
        self.size = size

    def take(self, spot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the lists of these numbers, offset of each in them and their end)."""
        begin, count = self.ends[spot], self.ends[spot + 1] - self.ends[spot]
        upto = np.concatenate([[0], np.cumsum(count)])
        return self.ids[np.repeat(begin - upto[:-1], count) + np.arange(upto[-1])], upto


class _Words:
    """Remembered words of a worker and their ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.cut = regex.compile(vocabulary.pattern).findall
        spaces = [c for c in map(chr, range(0x3001)) if regex.match(r"\s", c)]
        # a blank after white space: words between blanks could then not be cut on their own
        self.irregular = [c + " " for c in spaces if c.isascii()], [c + " " for c in spaces]
        self.runs = regex.compile(r"\s*\S+|\s+").findall
        self.forget()

    def forget(self) -> None:
        self.heads: dict[str, int] = {}      # as they stand
        self.tails: dict[str, int] = {}      # after one blank
        self.pretokens: dict[str, int] = {}
        self.pairs = dict(self.vocabulary.byte_pairs)
        self.pieces = _Lists()               # ids of the pre-tokens
        self.lists = _Lists()                # ids of the words

    def split(self, text: str) -> tuple[list[str], list[str]]:
        """(words as they stand, words after one blank): no match of the pattern crosses their
        borders, because a match holds white space at its begin only."""
        if any(c in text for c in self.irregular[not text.isascii()]):
            return self.runs(text), []
        first, *rest = text.split(" ")
        return [first] if first else [], rest

    def learn(self, heads: set[str], tails: set[str]) -> None:
        # words that white space does not end are cut in one go: each blank begins the next one
        plain = [w for w in tails if w and not w[-1].isspace()]
        found = self.cut(" " + " ".join(plain)) if plain else []
        begins = [k for k, t in enumerate(found) if t[0] == " "]
        if len(begins) != len(plain):       # a pattern that leaves blanks out
            plain, found, begins = [], [], []
        for table, words, before in ((self.heads, heads, ""), (self.tails, tails.difference(plain), " ")):
            for w in words:
                table[w] = len(self.lists) + len(begins)
                begins.append(len(found))
                found += self.cut(before + w)
        self.tails.update(zip(plain, range(len(self.lists), len(self.lists) + len(plain)), strict=True))
        new = list(set(found).difference(self.pretokens))
        self.pretokens.update(zip(new, range(len(self.pieces), len(self.pieces) + len(new)), strict=True))
        self.pieces.extend(*_replay([t.encode("utf-8", "surrogatepass") for t in new], self.vocabulary, self.pairs))
        ids, upto = self.pieces.take(np.fromiter(map(self.pretokens.__getitem__, found), np.int64, len(found)))
        self.lists.extend(ids, np.diff(upto[[*begins, len(found)]]))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offset of each text in them)."""
        parts = [self.split(t) for t in texts]
        heads = set().union(*(h for h, _ in parts))
        tails = set().union(*(t for _, t in parts))
        if len(self.lists) > MOST_WORDS or len(self.pairs) > MOST_WORDS:
            self.forget()
        self.learn(heads.difference(self.heads), tails.difference(self.tails))
        spots: list[int] = []
        words = [0]
        for h, t in parts:
            spots.extend(map(self.heads.__getitem__, h))
            spots.extend(map(self.tails.__getitem__, t))
            words.append(len(spots))
        ids, upto = self.lists.take(np.array(spots, np.int64))
        return ids, upto[np.array(words)]


_worker: list[tuple[object, _Words]] = []    # what this Python worker remembers from its last task


def _words_of(shared: tuple[dict[bytes, int], str]) -> _Words:
    """The words that earlier tasks of this worker met with the same broadcast vocabulary, else none."""
    if not (_worker and _worker[0][0] is shared):
        _worker[:] = [(shared, _Words(Vocabulary(*shared)))]
    return _worker[0][1]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches cut so that their texts hold about BATCH_BYTES (one longer text stays whole)."""
    for b in batches:
        texts = [(t or b"").decode("utf-8", "replace") for t in b.column("text").cast(pa.binary()).to_pylist()]
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= BATCH_BYTES):
                size += len(texts[end])
                end += 1
            yield b.slice(at, end - at), texts[at:end]
            at = end


def encode(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id") -> DataFrame:
    """Token ids of every text: one row per input row, (``key``, ids array<int>).

    Texts are cut by the pattern, each match is encoded on its own; special tokens are ordinary
    text. Classes of characters are those of the installed ``regex`` library; another encoder can
    differ on code points that only the newer of both knows. Edge cases: null or empty text has
    no ids; invalid UTF-8 is read with U+FFFD; repeated rows and null keys each keep their row;
    other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.ranks, vocabulary.pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words_of(shared.value)
        for b, texts in _blocks(batches):
            ids, offsets = words.encode(texts)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=[key, "ids"])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary, key: str = "doc_id") -> DataFrame:
    """The bytes of every row's ``ids``: (``key``, ids, decoded binary).

    Ids beyond the vocabulary raise; null ids decode to nothing. Bytes need not be whole
    characters: ids are decoded as they are.
    """
    shared = encoded.sparkSession.sparkContext.broadcast((vocabulary.ranks, vocabulary.pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Vocabulary(*shared.value).tokens
        table = pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.binary())
        for b in batches:
            lists = b.column(1)
            ids = lists.flatten()
            known = ids.to_numpy(zero_copy_only=False)
            if ids.null_count or (len(ids) and not 0 <= known.min() <= known.max() < len(table)):
                raise ValueError("an id that the vocabulary does not have")
            flat = table.take(ids)
            if flat.null_count:
                raise ValueError("an id that the vocabulary does not have")
            at = np.frombuffer(flat.buffers()[1], np.int32, len(flat) + 1, flat.offset * 4) if len(flat) else np.zeros(1, np.int32)
            count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            offsets = at[np.concatenate([[0], np.cumsum(count)])]
            data = flat.buffers()[2] if len(flat) else pa.py_buffer(b"")
            texts = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(offsets.astype(np.int32)), data])
            yield pa.RecordBatch.from_arrays([b.column(0), lists, texts], names=[key, "ids", "decoded"])

    kind = dict(encoded.dtypes)[key]
    return encoded.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, ids array<int>, decoded binary")


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: number of ids, SHA-256 of the comma-joined decimal ids and of the decoded bytes."""
    return decoded.select(
        key, F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
