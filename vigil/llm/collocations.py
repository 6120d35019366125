"""Phrase collocations: prefix-free parsing of the corpus, n-grams counted in distinct chunks.

Texts are cut into pieces and words. A window of :data:`OVERLAP` words whose hash is 0 modulo
:data:`TRIGGER` ends a chunk and begins the next one, so neighbouring chunks share the words of
that window and cut points depend on content alone: repeated text gives equal chunks. A chunk
owns the n-grams that begin before the shared words (the last chunk of a piece owns all), hence
an n-gram of up to ``OVERLAP + 1`` words lies whole in the one chunk that owns it and is counted
once. The dictionary holds every distinct chunk of a language with its parse frequency, and
n-grams are counted inside the dictionary, weighted by it.

Counting goes by length. A phrase that occurs ``least`` times has parts that do, so n-grams are
counted only where both their parts of one word less may be frequent. "May be" is a bitmap of hashes of fixed
size (broadcast; a false positive is only counted in vain, a frequent phrase is never missed).
Words are counted by their text, longer phrases by the 64-bit hashes of their words and language,
one column a word: the text of a frequent phrase is found again by joining its words, and no
n-gram's text is ever shuffled. Tasks add up the n-grams of some MB of the dictionary first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.base import LOWER, materialize, mix64

LONGEST = 5
OVERLAP = LONGEST - 1
TRIGGER = 16
FILTER_BITS = 1 << 26       # size of the broadcast bitmap
BLOCK_BYTES = 2 << 20       # bytes of the dictionary that are counted together

_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
# a separator becomes a mark, and can be no part of a word; the comma is free for another mark
_CUT = LOWER.translate(bytes(0x20 if b == 0x09 else 0x2E if b in _SEPARATORS else b for b in range(256)))
# floor(1000 a n / (l r)), exact: both products fit 38 digits
SCORE = ("(1000BD * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) "
         "div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
_A = np.uint64(0x9E3779B97F4A7C15)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class _Hasher:
    """64-bit hashes of the words of a buffer, each word followed by one blank.

    Two polynomial hashes over the bytes (of mixed byte values, modulo 2^64, different bases) are
    mixed into one; both come from running sums, so no word becomes an object.
    """

    def __init__(self):
        self.byte = [mix64(np.arange(256, dtype=np.uint64) * _A + np.uint64(k + 1)) for k in range(2)]
        self.powers: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def _grow(self, n: int) -> None:
        if n <= self.size:
            return
        self.size = n * 5 // 4
        ones = np.ones(self.size, np.uint64)
        self.powers = []
        for base in _BASES:
            both = []
            for x in (base, pow(base, -1, 1 << 64)):
                run = ones.copy()
                run[1:] = np.uint64(x)
                both.append(np.cumprod(run, dtype=np.uint64))
            self.powers.append(tuple(both))

    def words(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, begin, end) of every word."""
        end = np.flatnonzero(buf == 0x20)
        if not len(end):
            return np.zeros(0, np.uint64), end, end
        begin = np.concatenate([[0], end[:-1] + 1])
        self._grow(len(buf))
        h = (end - begin).astype(np.uint64)
        for byte, (up, down) in zip(self.byte, self.powers, strict=True):
            upto = np.cumsum(byte[buf] * up[: len(buf)])
            h = mix64(h * _A + (upto[end] - upto[begin] + byte[buf[begin]] * up[begin]) * down[begin])
        return h, begin, end


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of each text: words each followed by a blank, number of words and of owned starts."""
    hasher = _Hasher()
    for b in batches:
        texts = b.column("text").cast(pa.binary()).to_pylist()
        langs = b.column("lang").to_pylist()
        text = b"".join([(t or b"").translate(_CUT).replace(b".", b" . ") + b" , " for t in texts])
        text = b" ".join(text.split()) + b" "
        buf = np.frombuffer(text, np.uint8)
        h, begin, stop = hasher.words(buf)
        n = len(h)
        one = stop - begin == 1
        ends_text = one & (buf[begin] == 0x2C)
        mark = ends_text | (one & (buf[begin] == 0x2E))
        plain = ~mark
        begins = plain & np.concatenate([[True], mark[:-1]])
        stops = np.flatnonzero(plain & np.concatenate([mark[1:], [True]])) + 1
        # trigger windows lie whole inside a piece
        window, whole = np.zeros(n, np.uint64), np.zeros(n, bool)
        if n >= OVERLAP:
            m = n - OVERLAP + 1
            acc, ok = h[:m].copy(), plain[:m].copy()
            for j in range(1, OVERLAP):
                acc = acc * _A + h[j: m + j]
                ok &= plain[j: m + j]
            window[:m], whole[:m] = mix64(acc), ok
        starts = np.flatnonzero(begins | (whole & (window % np.uint64(TRIGGER) == 0)))
        if not len(starts):
            continue
        piece_end = stops[np.searchsorted(stops, starts, side="right")]
        following = np.concatenate([starts[1:], [n]])
        last = following >= piece_end
        end = np.where(last, piece_end, following + OVERLAP)
        own = np.where(last, end, following) - starts
        of = np.cumsum(ends_text)[starts]
        cut = zip(begin[starts].tolist(), (stop[end - 1] + 1).tolist(), strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()).take(pa.array(of)), pa.array([text[x:y] for x, y in cut], pa.binary()),
             pa.array(end - starts, pa.int64()), pa.array(own, pa.int64())], names=["lang", "chunk", "n_words", "own"])


def chunk_dictionary(docs: DataFrame) -> DataFrame:
    """Distinct chunks (lang, chunk, n_words, own) and how often the corpus has each (freq).

    Equal chunks can own different numbers of starts (one ends its piece, one does not); they
    are entries of their own.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    chunks = rows.mapInArrow(_parse, "lang string, chunk binary, n_words long, own long")
    return chunks.groupBy("lang", "chunk", "n_words", "own").agg(F.count(F.lit(1)).alias("freq"))


def _with_lang(h: np.ndarray, lang: np.ndarray) -> np.ndarray:
    return mix64(h ^ lang)


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(x.encode("utf-8", "replace")) for x in langs], np.uint64)


class _Block:
    """Chunks that are counted together, as arrays over their words."""

    def __init__(self, parts: list[pa.RecordBatch], hasher: _Hasher):
        rows = pa.Table.from_batches(parts).combine_chunks()
        sizes = rows.column("n_words").to_numpy()
        chunk = rows.column("chunk").combine_chunks()
        at = np.frombuffer(chunk.buffers()[1], np.int32, len(chunk) + 1, chunk.offset * 4)
        self.text = chunk.buffers()[2].slice(int(at[0]), int(at[-1] - at[0])).to_pybytes()
        self.h, self.begin, self.end = hasher.words(np.frombuffer(self.text, np.uint8))
        of = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(of)) - (np.cumsum(sizes) - sizes)[of]
        self.left = sizes[of] - place               # words from here to the chunk's end
        self.owned = place < rows.column("own").to_numpy()[of]
        self.weight = rows.column("freq").to_numpy()[of]
        lang = rows.column("lang").combine_chunks().dictionary_encode()
        self.langs = lang.dictionary.to_pylist()
        self.lang = lang.indices.to_numpy()[of]
        self.h = _with_lang(self.h, _lang_hashes(self.langs)[self.lang])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    hasher, held, size = _Hasher(), [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.column("chunk").nbytes
        if size >= BLOCK_BYTES:
            yield _Block(held, hasher)
            held, size = [], 0
    if held:
        yield _Block(held, hasher)


def _sums(keys: list[np.ndarray], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each group, sum of its weights). Rows are ordered by a mix of the keys; a
    group that a collision of the mix divides has several rows, which later sums unite."""
    mixed = keys[0]
    for k in keys[1:]:
        mixed = mix64(mixed * _A + k)
    order = np.argsort(mixed)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        x = k[order]
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return order[first], np.add.reduceat(weight[order], first)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        spot = np.flatnonzero(block.owned)
        at, f = _sums([block.h[spot]], block.weight[spot])
        at = spot[at]
        texts = [block.text[x:y] for x, y in zip(block.begin[at].tolist(), block.end[at].tolist(), strict=True)]
        langs = pa.array(block.langs, pa.string()).take(pa.array(block.lang[at]))
        yield pa.RecordBatch.from_arrays([langs, pa.array(texts, pa.binary()), pa.array(f)], names=["lang", "phrase", "f"])


def _word_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = _Hasher()
    for b in batches:
        if b.num_rows:
            words = b.column("phrase").to_pylist()
            h, _, _ = hasher.words(np.frombuffer(b" ".join(words) + b" ", np.uint8))
            h = _with_lang(h, _lang_hashes(b.column("lang").to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(h.view(np.int64))], names=[*b.schema.names, "h"])


def _bit(hashes: list[np.ndarray], bits: int) -> np.ndarray:
    at = hashes[0]
    for k, h in enumerate(hashes[1:], 1):
        at = at ^ (h >> np.uint64(7 * k))
    return (at & np.uint64(bits - 1)).astype(np.int64)


def _grams(size: int, filter_, bits: int):
    """Count n-grams of ``size`` words whose two parts of one word less may both be frequent."""
    schema = pa.schema([*((f"w{k}", pa.int64()) for k in range(1, size + 1)), ("f", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = np.frombuffer(filter_.value, np.uint8)
        for block in _blocks(batches):
            n = len(block.h)
            hot = np.zeros(n + 1, bool)
            if n >= size - 1:
                at = _bit([block.h[k: n - size + 2 + k] for k in range(size - 1)], bits)
                hot[: len(at)] = (may[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            spot = np.flatnonzero(block.owned & hot[:-1] & hot[1:] & (block.left >= size))
            if not len(spot):
                continue
            keys = [block.h[spot + k] for k in range(size)]
            at, f = _sums(keys, block.weight[spot])
            yield pa.RecordBatch.from_arrays([*(pa.array(k[at].view(np.int64)) for k in keys), pa.array(f)], schema=schema)
    return run


def _bitmap(frequent: DataFrame, words: int, bits: int):
    """Broadcast bitmap of the phrases' hashes (at most ``bits / 8`` bytes reach the driver)."""
    at = F.col("w1")
    for k in range(1, words):
        at = at.bitwiseXOR(F.shiftrightunsigned(f"w{k + 1}", 7 * k))
    at = at.bitwiseAND(F.lit(bits - 1)) + 1
    slices = (frequent.select(F.bitmap_bucket_number(at).alias("slice"), F.bitmap_bit_position(at).alias("bit"))
              .groupBy("slice").agg(F.bitmap_construct_agg("bit").alias("bits")))
    whole = np.zeros(bits // 8, np.uint8)
    size = 4096
    for r in slices.toLocalIterator():
        whole[(r["slice"] - 1) * size: r["slice"] * size] = np.frombuffer(r["bits"], np.uint8)
    return frequent.sparkSession.sparkContext.broadcast(whole.tobytes())


def phrase_counts(docs: DataFrame, least: int = 100, longest: int = LONGEST,
                  filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, f) of every phrase of up to ``longest`` words that occurs ``least``
    times or more in a language, (lang, n) with all word occurrences). Phrases are binary, their
    words joined by single blanks."""
    if not 1 <= longest <= OVERLAP + 1 or filter_bits < 1 << 15 or filter_bits & (filter_bits - 1):
        raise ValueError("at most OVERLAP + 1 words, and a power of two of bits, 2^15 at least")
    dictionary = materialize(chunk_dictionary(docs), "phrase-chunks")
    totals = dictionary.groupBy("lang").agg(F.sum(F.col("own") * F.col("freq")).alias("n"))
    words = materialize(
        dictionary.mapInArrow(_words, "lang string, phrase binary, f long")
        .groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
        .mapInArrow(_word_hashes, "lang string, phrase binary, f long, h long"), "phrase-words")
    counts = words.select("lang", "phrase", F.lit(1).alias("words"), "f")
    level = words.select(F.col("h").alias("w1"))
    for size in range(2, longest + 1):
        names = [f"w{k}" for k in range(1, size + 1)]
        shared = _bitmap(level, size - 1, filter_bits)
        level = materialize(
            dictionary.mapInArrow(_grams(size, shared, filter_bits), ", ".join(f"{x} long" for x in names) + ", f long")
            .groupBy(*names).agg(F.sum("f").alias("f")).filter(F.col("f") >= least), f"phrase-{size}")
        counts = counts.unionByName(_spelled(level, names, words))
    return materialize(counts, "phrase-counts"), totals


def _spelled(level: DataFrame, names: list[str], words: DataFrame) -> DataFrame:
    """Frequent phrases with their text, word by word from the frequent words."""
    text = words.select("h", F.col("lang").alias("_lang"), F.col("phrase").alias("_word"))
    out = level.join(text.withColumnRenamed("h", names[0]), names[0]).withColumnsRenamed({"_lang": "lang", "_word": "phrase"})
    for name in names[1:]:
        out = (out.join(text.drop("_lang").withColumnRenamed("h", name), name)
               .withColumn("phrase", F.concat("phrase", F.lit(b" "), F.col("_word"))).drop("_word"))
    return out.select("lang", "phrase", F.lit(len(names)).alias("words"), "f")


def collocations(docs: DataFrame, least: int = 100, longest: int = LONGEST, top: int = 2000,
                 filter_bits: int = FILTER_BITS) -> DataFrame:
    """The best-bound phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of 2 to ``longest`` words with ``a >= least`` occurrences. Cut after
    its first k words, a candidate scores ``floor(1000 a n / (l r))`` with the occurrences of
    both parts and the language's words; the lowest cut counts (ties to the smallest k). A
    candidate that stands inside a longer one as often as anywhere is dropped. The first ``top``
    by score, occurrences and phrase (UTF-8 byte order) are returned.

    Arithmetic is exact: products are decimals of 38 digits and the quotient is integral.
    Edge cases: null texts have no words, a null lang is ``und``; words are bytes as they stand
    (control characters other than separators, blanks and tabs included); repeated rows count
    each; ids play no part; other columns are ignored; an empty table has no result.
    """
    counts, totals = phrase_counts(docs, least, longest, filter_bits)
    cands = counts.filter("words >= 2").select("lang", F.col("phrase").cast("string").alias("phrase"),
                                               "words", F.col("f").alias("a"))
    cands = cands.withColumn("w", F.split("phrase", " "))
    part = lambda k, length: F.array_join(F.slice(F.col("w"), k, length), " ")
    known = counts.select("lang", F.col("phrase").cast("string").alias("part"), "f")
    cuts = (cands.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
                    part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right")))
    cuts = (cuts.join(known.withColumnsRenamed({"part": "left", "f": "l"}), ["lang", "left"])
            .join(known.withColumnsRenamed({"part": "right", "f": "r"}), ["lang", "right"])
            .join(totals, "lang"))
    scored = (cuts.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase")
              .agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("s")).select("lang", "phrase", "s.*"))
    # parts of two words and more that lie inside a longer candidate of the same count
    inside = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda k: F.array_join(F.slice(F.col("w"), k, m), " "))))
    covered = (cands.filter("words >= 3").select("lang", F.col("a").alias("longer"), F.explode(inside).alias("phrase"))
               .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    left = (scored.join(covered, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
