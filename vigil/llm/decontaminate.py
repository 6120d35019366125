"""Benchmark decontamination: prefix-filtered containment join of item windows and documents.

A window is ``width`` consecutive words of an item (a shorter item is one window). Its tokens
are the word shingles in it. For full containment the prefix filter needs one token of each
window: the rarest in the corpus. A document position with that token, at the token's offset
in the window, fixes where the window would lie (positional bound); it must fit between the
document's ends (length bound); then all its words are compared. Only rare tokens are probed,
so common words cost nothing.

The benchmark is read in blocks of bounded size; each block is broadcast and all documents
stream past it, so neither side is shuffled and no block grows with the benchmark.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.base import WordHash, alnum_words, map_rows, shingle_hashes

WINDOW = 10
TOKEN = 3               # words of a shingle that serves as a token
BLOCK_WORDS = 200_000   # benchmark words in one broadcast block
_BITS = 20


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items in blocks of at most ``block_words`` words (one item at least), a partition at a time."""
    block: list = []
    size = 0
    for r in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).toLocalIterator():
        words = alnum_words(bytes(r[1]) if r[1] is not None else None)
        if not words:
            continue
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((r[0], words))
        size += len(words)
    if block:
        yield block


def _tokens(words: list[bytes], memo: WordHash) -> tuple[int, np.ndarray]:
    width = min(TOKEN, len(words))
    return width, shingle_hashes(memo.of(words), width)


def _bitmap(values: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << _BITS, bool)
    bits[values & np.uint64((1 << _BITS) - 1)] = True
    return bits


def _at(shingles: np.ndarray, wanted: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Positions of ``shingles`` whose value is in the sorted ``wanted``."""
    pos = np.nonzero(bits[shingles & np.uint64((1 << _BITS) - 1)])[0]
    if len(pos):
        found = np.searchsorted(wanted, shingles[pos])
        pos = pos[wanted[np.minimum(found, len(wanted) - 1)] == shingles[pos]]
    return pos


def _rarity(docs: DataFrame, tokens: dict[int, np.ndarray]) -> dict[int, dict[int, int]]:
    """Occurrences in all documents of the block's tokens, by token width."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast({w: (v, _bitmap(v)) for w, v in tokens.items()})

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        memo = WordHash()
        totals = {w: np.zeros(len(v), np.int64) for w, (v, _) in shared.value.items()}
        for b in batches:
            for text in b["text"]:
                h = memo.of(alnum_words(text))
                for w, (wanted, bits) in shared.value.items():
                    if len(h) >= w:
                        s = shingle_hashes(h, w)
                        np.add.at(totals[w], np.searchsorted(wanted, s[_at(s, wanted, bits)]), 1)
            memo.trim()
        for w, (wanted, _) in shared.value.items():
            at = np.nonzero(totals[w])[0]
            yield {"width": [w] * len(at), "token": wanted[at].view(np.int64), "n": totals[w][at]}

    counts = (map_rows(docs.select("text"), run, "width int, token long, n long")
              .groupBy("width", "token").agg(F.sum("n").alias("n")))
    out: dict[int, dict[int, int]] = defaultdict(dict)
    for r in counts.collect():  # at most one row per token of the block
        out[r[0]][r[1] & 0xFFFFFFFFFFFFFFFF] = r[2]
    return out


def _prefix_index(block: list[tuple[str | None, list[bytes]]], docs: DataFrame, window: int) -> dict:
    """{token width: {rarest token: {offset in window: {window words: [item ids]}}}}."""
    memo = WordHash()
    toks: dict[int, set[int]] = defaultdict(set)
    windows: dict[tuple[bytes, ...], set] = defaultdict(set)
    for item, words in block:
        span = min(window, len(words))
        for i in range(len(words) - span + 1):
            windows[tuple(words[i:i + span])].add(item)
    hashed = {w: _tokens(list(w), memo) for w in windows}
    for width, s in hashed.values():
        toks[width].update(s.tolist())
    count = _rarity(docs, {w: np.array(sorted(v), np.uint64) for w, v in toks.items()})
    index: dict = defaultdict(lambda: defaultdict(lambda: defaultdict(dict)))
    for words, (width, s) in hashed.items():
        token, off = min((count[width].get(t, 0), t, i) for i, t in enumerate(s.tolist()))[1:]
        index[width][token][off][words] = sorted(windows[words], key=lambda x: (x is None, x))
    return {w: (np.array(sorted(d), np.uint64), {t: {o: dict(x) for o, x in m.items()} for t, m in d.items()})
            for w, d in index.items()}


def _probe(shared, first: bool, last: bool):
    """Add the block's hits to the spans and items found so far; after the last block, report."""
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        memo = WordHash()
        index = {w: (wanted, _bitmap(wanted), at) for w, (wanted, at) in shared.value.items()}
        for b in batches:
            out = {"doc_id": b["doc_id"], "text": b["text"], "n_words": [], "spans": [], "items": []}
            for k, text in enumerate(b["text"]):
                words = alnum_words(text)
                h = memo.of(words)
                spans = [] if first else list(b["spans"][k])
                items = set() if first else set(b["items"][k])
                for width, (wanted, bits, at) in index.items():
                    if len(h) < width:
                        continue
                    s = shingle_hashes(h, width)
                    pos = _at(s, wanted, bits)
                    for p, token in zip(pos.tolist(), s[pos].tolist(), strict=True):
                        for off, wins in at[token].items():
                            start = p - off
                            if start < 0:
                                continue
                            for win, ids in wins.items():
                                stop = start + len(win)
                                if stop <= len(words) and tuple(words[start:stop]) == win:
                                    spans += [start, stop]
                                    items.update(x for x in ids if x is not None)
                out["n_words"].append(len(words))
                out["spans"].append(spans)
                out["items"].append(sorted(items))
            memo.trim()
            yield _report(out) if last else out
    return run


def _report(b: dict) -> dict:
    hits, digest = [], []
    for n, spans, items in zip(b["n_words"], b["spans"], b["items"], strict=True):
        hit = np.zeros(n, bool)
        for i, j in zip(spans[::2], spans[1::2], strict=True):
            hit[i:j] = True
        hits.append(int(hit.sum()))
        digest.append(hashlib.sha256(",".join(items).encode()).hexdigest())
    return {"doc_id": b["doc_id"], "n_words": b["n_words"], "n_hit": hits, "items": b["items"],
            "n_items": [len(x) for x in b["items"]], "items_sha256": digest,
            "contaminated": [x > 0 for x in hits]}


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """Words of each document inside an occurrence of a benchmark window.

    Returns one row per input row: doc_id, n_words, n_hit, items (sorted ids, as strings),
    n_items, items_sha256 (of the comma-joined ids), contaminated (n_hit > 0).

    Edge cases: null text has no words and is clean; an item without words has no window; a
    null item_id hits words but is not listed; repeated items count once; an empty benchmark
    leaves all documents clean. Other columns are ignored.
    """
    sc = docs.sparkSession.sparkContext
    cur = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = "doc_id long, text string, n_words long, spans array<int>, items array<string>"
    report = ("doc_id long, n_words long, n_hit long, items array<string>, n_items long, "
              "items_sha256 string, contaminated boolean")
    blocks = _blocks(benchmark, block_words)
    block, first = next(blocks, []), True
    while True:
        after = next(blocks, None)
        shared = sc.broadcast(_prefix_index(block, docs, window) if block else {})
        cur = map_rows(cur, _probe(shared, first, after is None), report if after is None else found)
        if after is None:
            return cur
        block, first = after, False
