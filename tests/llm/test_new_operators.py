"""Byte-level BPE, phrase collocations and hard negatives against brute force on small tables."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from vigil.llm import byte_bpe, collocations, hard_negatives

VOCABULARY = byte_bpe.load_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=VOCABULARY.pattern, mergeable_ranks=VOCABULARY.ranks, special_tokens={})

TEXTS = [None, "", " ", "\n", "a", " a", "  a  b   c ", "a \n b\t c\n\n", "it's we'll 'S don't", "x  y  z", "\x1c \x1c",
         "<|endoftext|> hi", "aaaa" * 900 + "b", "ab" * 2000, " " * 900, "\n" * 700 + " x", "é漢字١２３", "a" * 120_000, "\U0001F600 \U0001F600"]


def _random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab  \n\t'sré漢１２.,!  \x1c\x85") for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_bpe_equals_the_reference_encoder(docs):
    texts = TEXTS + _random_texts(400, 3)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (None, "null id"), (3, "id again")]
    encoded = byte_bpe.encode(docs(rows), VOCABULARY)
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256)
                 for r in byte_bpe.digests(byte_bpe.decode(encoded, VOCABULARY)).collect())
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in rows:
        ids = REFERENCE.encode_ordinary(t or "")
        want.append((str(i), len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want)
    assert byte_bpe.encode(docs([]), VOCABULARY).count() == 0


def test_bpe_replay_of_any_vocabulary_equals_word_by_word():
    """Ranks in random order: merges that make pairs of lower ranks, and words that no merge makes."""
    rng = random.Random(5)
    for trial in range(30):
        longer = {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(40)}
        order = rng.sample(sorted(longer), len(longer))
        ranks = {bytes([b]): b for b in range(256)} | {w: 256 + k for k, w in enumerate(order)}
        vocabulary = byte_bpe.Vocabulary(ranks, ".+")
        plain = tiktoken.Encoding("plain", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 40))) for _ in range(60)] + [b""]
        assert byte_bpe.replay_merges(words, vocabulary) == [plain.encode_ordinary(w.decode()) for w in words], trial


def test_bpe_forgets_and_rejects(monkeypatch, spark):
    monkeypatch.setattr(byte_bpe, "MOST_WORDS", 5)
    words = byte_bpe._Words(VOCABULARY)
    for t in _random_texts(60, 7):
        ids, ends = words.encode([t, t])
        assert ids.tolist() == 2 * REFERENCE.encode_ordinary(t) and ends.tolist() == [0, len(ids) // 2, len(ids)]
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary({b"a": 0}, ".")
    beyond = spark.createDataFrame([(1, [7, 60_000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="does not have"):
        byte_bpe.decode(beyond, VOCABULARY).collect()


def test_bpe_worker_merges_a_word_once_for_all_its_tasks(monkeypatch):
    merged = []
    replay = byte_bpe._replay
    monkeypatch.setattr(byte_bpe, "_replay", lambda words, *a: merged.extend(words) or replay(words, *a))
    shared, other = (VOCABULARY.ranks, VOCABULARY.pattern), (VOCABULARY.ranks, VOCABULARY.pattern)
    texts = [t for t in TEXTS if t] + _random_texts(200, 11)
    for k, t in enumerate([*texts, *texts]):        # each as a task of its own
        words = byte_bpe._words_of(shared)
        ids, _ = words.encode([t])
        assert ids.tolist() == REFERENCE.encode_ordinary(t)
        assert k < len(texts) or len(merged) == once
        once = len(merged)
    assert len(merged) == len(set(merged))
    assert byte_bpe._words_of(other) is not words and byte_bpe._words_of(other) is byte_bpe._words_of(other)


def test_bpe_pattern_that_leaves_blanks_out():
    words = byte_bpe._Words(byte_bpe.Vocabulary(VOCABULARY.ranks, r"\w+"))
    plain = tiktoken.Encoding("words", pat_str=r"\w+", mergeable_ranks=VOCABULARY.ranks, special_tokens={})
    for t in ("a bc  d\n e.f g", " the of", "x \n"):
        want = [i for w in t.split() for x in w.split(".") for i in plain.encode_ordinary(x)]
        assert words.encode([t])[0].tolist() == want


def _brute_phrases(rows, least, longest, top):
    """rows: (lang, text)."""
    import re
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cands = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    gone = {(lang, w[i:i + m]) for (lang, w), a in cands.items() for m in range(2, len(w)) for i in range(len(w) - m + 1)
            if 100 * a >= 100 * f[lang, w[i:i + m]]}
    out = []
    for (lang, w), a in cands.items():
        if (lang, w) not in gone:
            score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], n[lang]))
    ranks, want = Counter(), []
    for lang, s, a, p, left, right, total in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= top:
            want.append((lang, ranks[lang], p.decode(), -a, left, right, total, -s))
    return want


@pytest.mark.parametrize(("bits", "block", "trigger"), [(1 << 26, 4 << 20, 16), (1 << 15, 5000, 1), (1 << 15, 200, 3)])
def test_collocations_match_brute_force(monkeypatch, docs, bits, block, trigger):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", block)
    monkeypatch.setattr(collocations, "TRIGGER", trigger)
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(12)] + ["É", "A", "漢", "\x1cx"]
    fixed = ["new york city hall", "w1 w2 w3 w4 w5 w6 w7", "same same same same same same", "x"]
    texts = []
    for i in range(120):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 9))) for _ in range(8)]
        texts.append("".join(p + rng.choice([". ", ",", "\n", " ", "\t", "!?", "  "]) for p in parts))
    rows = [(i, t, "s", rng.choice(["en", "de", None, "und"])) for i, t in enumerate(texts)]
    rows += [(1, texts[1], "s", "en"), (1, texts[1], "s", "en"), (None, texts[2], "s", "de"), (None, None, "s", "en"), (5, "", "s", None),
             (6, " ".join(["same"] * 3000), "s", "en"), (7, "one two " * 4000, "s", "de"), (8, "tie a. tie a. tie b. tie b", "s", "en")]
    for least, top in ((2, 2000), (9, 5)):
        got = collocations.collocations(docs(rows), least=least, top=top, filter_bits=bits).collect()
        assert sorted(map(tuple, got)) == sorted(_brute_phrases([(r[3], r[1]) for r in rows], least, 5, top))
    assert collocations.collocations(docs([])).count() == 0


def test_collocation_arithmetic_beyond_64_bits(spark):
    """The score's products pass 64 bits for counts of a large corpus."""
    a, n, left, right = 10 ** 12 + 7, 10 ** 16 + 3, 10 ** 13 + 1, 10 ** 13 + 9
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert row.selectExpr(collocations.SCORE).first()[0] == 1000 * a * n // (left * right)


def test_chunks_own_every_start_once(docs):
    rng = random.Random(2)
    text = ". ".join(" ".join(f"v{rng.randrange(30)}" for _ in range(rng.randint(1, 60))) for _ in range(40))
    chunks = collocations.chunk_dictionary(docs([(1, text), (2, text)])).collect()
    assert sum(c.own * c.freq for c in chunks) == 2 * len(text.replace(".", "").split())
    assert all(len(bytes(c.chunk).split()) == c.n_words and c.own in (c.n_words, c.n_words - 4) for c in chunks)
    assert all(c.freq >= 2 for c in chunks)


VEC = "vec_id long, embedding array<float>, label int, score int, block string"


def _brute_negatives(rows, is_anchor, scale=256):
    seen = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = tuple(math.floor(scale * float(np.float32(x))) for x in v)
        seen[i, label, q] = None
    seen, out = list(seen), []
    for a in seen:
        if not is_anchor(a[0]):
            continue
        score = lambda b, a=a: sum(x * y for x, y in zip(a[2], b[2], strict=True))
        ranked = sorted((-score(b), b[0], b[1]) for b in seen if b != a and len(b[2]) == len(a[2]))
        for s, p, _ in [r for r in ranked if r[2] == a[1]][:5]:
            hard = [r for r in ranked if r[2] != a[1] and -80 * s <= -100 * r[0] <= -100 * s][:5]
            out += [(a[0], p, k + 1, r[1], -s, -r[0]) for k, r in enumerate(hard)]
    return sorted(out)


@pytest.mark.parametrize("block", [2048, 7])
def test_hard_negatives_match_brute_force(monkeypatch, spark, block):
    monkeypatch.setattr(hard_negatives, "LEAST_BLOCK", block)
    monkeypatch.setattr(hard_negatives, "MOST_BLOCK", max(block, 7))
    monkeypatch.setattr(hard_negatives, "SLICE", 3)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * rng.choice([0.05, 0.5, 2.0])).tolist(), int(rng.integers(0, 4))) for i in range(160)]
    rows += [(200 + i, [0.5] * 8, i % 3) for i in range(40)]                          # one common vector, ties
    rows += [(300, [0.0] * 8, 1), (301, None, 1), (302, [1.0] * 8, None), (303, [float("nan")] + [0.0] * 7, 1),
             (304, [None] + [0.0] * 7, 1), (305, [float("-inf")] * 8, 2), (None, [0.5] * 8, 1), (306, [-1.0] * 8, 1),
             (310, [1.0, 2.0], 1), (320, [1.5, 2.0], 1), (330, [1.4, 2.0], 2), (340, [], 1), (350, [], 2)]
    rows += [rows[0], rows[0], (10, [0.25] * 8, 3)]                                   # a repeated row, an id with two vectors
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VEC)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == _brute_negatives(rows, lambda i: i % 10 == 0)
    assert hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 16)) * 300
    rows = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(2000, 16)) * 3).astype(np.int64)
    tree = hard_negatives.Tree(rows)
    leaves = np.sort(np.concatenate([x for x in tree.leaf if x is not None]))
    assert leaves.tolist() == list(range(2000))
    for node, leaf in enumerate(tree.leaf):
        if leaf is not None:
            far = np.linalg.norm(tree.points[leaf] - tree.points[tree.centre[node]], axis=1)
            assert (far <= tree.radius[node] + 1e-6).all()
    verified, scores = [], tree.scores
    tree.scores = lambda at, q: verified.append(len(at)) or scores(at, q)
    ids, wanted = np.arange(2000), np.ones(2000, bool)
    for q in rows[:40]:
        s = rows @ q
        best = np.lexsort((ids, -s))[:5]
        assert [(a, -b) for a, b, _ in tree.first(q, ids, wanted, 5)] == [(int(s[i]), int(i)) for i in best]
    assert sum(verified) < 0.25 * 40 * 2000      # the descent leaves most rows unseen
    huge = hard_negatives.Tree(np.array([[2 ** 40, -3], [2 ** 21, 5]]))
    assert [a for a, _, _ in huge.first(np.array([2 ** 22, 1]), np.arange(2), np.ones(2, bool), 2)] == [2 ** 62 - 3, 2 ** 43 + 5]
