"""Token counts under a unigram vocabulary: dynamic programming shared over a trie of words.

Each task inserts the distinct pre-tokens that it meets in one trie. A node stands for a prefix
and holds its unigram forward scores (best log score and its number of tokens); they are
computed when the node is made, once per shared prefix, from the nodes above it. Pieces that may
end there are found by walking a trie of the reversed vocabulary back from the node, so a suffix
that begins no piece ends the search. The tokens at a pre-token's last node are its terminal
count; a document's count is the sum over its pre-tokens. No shuffle; the trie and the table of
terminal counts are emptied when they are large, so memory is bounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.base import map_rows

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"            # begins a word
MOST_PIECES = 1_000_000    # bound of the broadcast vocabulary
MOST_TERMINALS = 1_000_000 # terminal counts a task remembers
MOST_NODES = 1_500_000     # nodes of its trie


def load_pieces(path: str = VOCABULARY) -> dict[str, float]:
    """Pieces of a SentencePiece model file with a unigram log score each.

    A merge vocabulary has ranks, not probabilities: the score is Zipf's ``-log(2 + rank)``
    with the rank in file order. Control, unknown and byte pieces are not text and are left
    out. Read on the driver only.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    if sp.get_piece_size() > MOST_PIECES:
        raise ValueError(f"{path} has {sp.get_piece_size()} pieces; the bound is {MOST_PIECES}")
    text = [i for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {sp.id_to_piece(i): -math.log(2 + k) for k, i in enumerate(text)}


def unknown_score(pieces: dict[str, float]) -> float:
    """Log score of a character that no piece covers: below every piece's."""
    return min(pieces.values(), default=0.0) - 10.0


class Trie:
    """Prefixes of the inserted words with their best path; ties go to fewer tokens.

    A character no piece covers costs as many tokens as it has UTF-8 bytes.
    """

    def __init__(self, pieces: dict[str, float]):
        self.unknown = unknown_score(pieces)
        self.suffixes: dict = {}        # vocabulary read from the end; "" holds a piece's score
        for piece, score in pieces.items():
            at = self.suffixes
            for c in reversed(piece):
                at = at.setdefault(c, {})
            if piece:
                at[""] = score
        self.forget()

    def forget(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.score = [0.0]
        self.tokens = [0]

    def count(self, word: str) -> int:
        """Insert ``word``; the number of tokens on its best path."""
        child, score, tokens = self.child, self.score, self.tokens
        node, path = 0, [0]
        for end, c in enumerate(word):
            key = node, c
            node = child.get(key)
            if node is None:
                up = path[-1]
                best, fewest = score[up] + self.unknown, tokens[up] + len(c.encode("utf-8", "replace"))
                at, start = self.suffixes, end
                while start >= 0 and (at := at.get(word[start])) is not None:
                    p = at.get("")
                    if p is not None:
                        up = path[start]
                        s, t = score[up] + p, tokens[up] + 1
                        if s > best or (s == best and t < fewest):
                            best, fewest = s, t
                    start -= 1
                node = child[key] = len(score)
                score.append(best)
                tokens.append(fewest)
            path.append(node)
        return tokens[node]


def _count(shared):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        trie = Trie(shared.value)
        known: dict[bytes, int] = {}
        for b in batches:
            out: dict = {"doc_id": b["doc_id"], "n_pretokens": [], "n_tokens": []}
            split = [(t or b"").split() for t in b["text"]]
            for w in {w for words in split for w in words if w not in known}:
                known[w] = trie.count(MARK + w.decode("utf-8", "replace"))
            for words in split:
                out["n_pretokens"].append(len(words))
                out["n_tokens"].append(sum(map(known.__getitem__, words)))
            if len(known) > MOST_TERMINALS:
                known.clear()
            if len(trie.score) > MOST_NODES:
                trie.forget()
            yield out
    return run


def token_counts(docs: DataFrame, pieces: dict[str, float] | None = None) -> DataFrame:
    """Number of tokens of every document under a unigram vocabulary.

    Pre-tokens are the runs between ASCII white space, each with a leading word mark. Returns
    one row per input row: doc_id, n_pretokens, n_tokens.

    Edge cases: null or blank text has 0 tokens; repeated rows each get their count; other
    columns are ignored; an empty vocabulary counts UTF-8 bytes (word mark included).
    """
    pieces = load_pieces() if pieces is None else pieces
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _count(shared),
                    "doc_id long, n_pretokens long, n_tokens long")


