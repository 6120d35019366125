"""Language identification: nearest of several centroids per language, by cosine.

Features are hashed character 2- and 3-grams of the lower-cased letters (every other run is
one blank), weighted log(1 + tf) * idf and L2-normalised. Document frequencies are counted
over all training documents. Centroids come from spherical k-means on a bounded sample of
each language (:data:`SAMPLE` documents). A text is *rejected* when it lies far from all centroids:
when its best cosine is below a bound. Cosines rise with the length of a text, of noise as well, so
each language has a bound for every length class (grams by powers of two), learned from the same
sample: :data:`MARGIN` of the cosine that all but :data:`TAIL` of the runs of its documents of that
length reach. The margin leaves odd texts in, such as one word over and over.

Learning uses text and non-null lang of documents with crc32(doc_id as text) mod 3 <> 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.base import map_rows, materialize

DIMS = 4096
CENTROIDS = 4       # per language
SAMPLE = 300        # labelled documents per language that the centroids are fitted on
LEAST = 0.15        # least cosine that is not rejected where no bound could be learned
MARGIN = 0.36       # of a low quantile of the cosines of a language's own runs of a length
TAIL = 0.05         # that quantile
RUNS = 2            # runs of a length that a document gives, at its beginning and middle
FEW_RUNS = 20       # with fewer, the bound of the shorter class holds
_CLASSES = 18       # up to runs of 65,536 characters
ROUNDS = 8
_CHUNK = 1 << 18    # characters hashed at a time


def _letter_table() -> np.ndarray:
    """For each code point: itself if it is a letter, else 32."""
    points = np.arange(0x110000, dtype=np.uint32)
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(letter, points, np.uint32(32))


def gram_counts(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Counts of the hashed grams of the whole text; None if it has no letter."""
    total = None
    low = text.lower()
    for at in range(0, len(low), _CHUNK):
        # two characters of overlap keep the grams across the border
        c = letters[np.frombuffer(low[max(0, at - 2): at + _CHUNK].encode("utf-32-le", "replace"), np.uint32)]
        if not (c != 32).any():
            continue
        c = np.concatenate(([32], c, [32])).astype(np.uint32)
        c = c[~((c == 32) & np.concatenate(([False], c[:-1] == 32)))]
        two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] * np.uint32(0xC2B2AE3D) + c[2:] * np.uint32(0x27D4EB2F)
        grams = np.concatenate((two, three))
        n = np.bincount((grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(20), minlength=DIMS)
        total = n if total is None else total + n
    return total


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts).astype(np.float32) * idf
    norm = float(np.sqrt(v @ v))
    return v / norm if norm else v


def _texts(batch: dict) -> Iterator[np.ndarray | None]:
    for t in batch["text"]:
        yield gram_counts(t.decode("utf-8", "replace"), _letters()) if t else None


_TABLE: list = []


def _letters() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_letter_table())
    return _TABLE[0]


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _document_frequencies(batches: Iterator[dict]) -> Iterator[dict]:
    df, docs = np.zeros(DIMS, np.int64), 0
    for b in batches:
        for counts in _texts(b):
            if counts is not None:
                df += counts > 0
                docs += 1
    at = np.nonzero(df)[0]
    yield {"gram": [-1, *at.tolist()], "n": [docs, *df[at].tolist()]}


def _cluster(idf: np.ndarray, k: int):
    """Spherical k-means of one language's sample; starts from far-apart documents."""
    def run(key: tuple, pdf):
        import pandas as pd

        pdf = pdf.sort_values(["order", "text"])
        rows = [gram_counts(t, _letters()) for t in pdf["text"]]
        x = np.array([vector(c, idf) for c in rows if c is not None], np.float32)
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "bounds": []})
        centre = [_unit(x.mean(0))]
        while len(centre) < min(k, len(x)):
            centre.append(x[int(np.argmin((x @ np.array(centre).T).max(1)))])
        c = np.array(centre)
        for _ in range(ROUNDS):
            near = (x @ c.T).argmax(1)
            c = np.array([_unit(x[near == i].mean(0)) if (near == i).any() else c[i] for i in range(len(c))])
        bounds = _bounds(list(pdf["text"]), c, idf)
        return pd.DataFrame({"lang": key[0], "centroid": [r.tolist() for r in c], "bounds": [bounds] * len(c)})
    return run


def length_class(grams: int) -> int:
    return min(int(grams).bit_length(), _CLASSES)


def _bounds(texts: list[str], centroids: np.ndarray, idf: np.ndarray) -> list[float]:
    """Least cosine that is not rejected, for each length class.

    A text of class c has 2^(c-1) grams or more, two a character: the bound comes from runs of
    2^(c-2) characters inside the documents, the shortest of the class.
    """
    bounds = [0.0] * (_CLASSES + 1)
    for c in range(4, _CLASSES + 1):
        size = 1 << (c - 2)
        runs = [t[at: at + size] for t in texts for at in (0, len(t) // 2)[:RUNS] if at + size <= len(t)]
        bounds[c] = bounds[c - 1]
        if len(runs) >= FEW_RUNS:
            counts = [gram_counts(t, _letters()) for t in runs]
            near = [float((centroids @ vector(n, idf)).max()) for n in counts if n is not None]
            if len(near) >= FEW_RUNS:
                bounds[c] = max(bounds[c], round(MARGIN * float(np.quantile(near, TAIL)), 6))
    return bounds


def _unit(v: np.ndarray) -> np.ndarray:
    norm = np.sqrt(v @ v)
    return v / norm if norm else v


def fit(docs: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS) -> dict:
    """{"langs", "centroids", "bounds" (rows), "idf"} learned from the training documents.

    The model's size is (languages x k x DIMS) floats whatever the corpus.
    """
    train = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
             .filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                     & ~is_held_out(F.col("doc_id"))))
    counted = {r[0]: r[1] for r in map_rows(train.select("text"), _document_frequencies, "gram int, n long")
               .groupBy("gram").agg(F.sum("n").alias("n")).collect()}  # DIMS + 1 rows at most
    idf = np.log((1 + counted.get(-1, 0)) / (1 + np.array([counted.get(g, 0) for g in range(DIMS)]))).astype(np.float32) + 1
    rank = Window.partitionBy("lang").orderBy("order", "doc_id")
    ids = (train.select("doc_id", "lang", F.xxhash64("doc_id").alias("order"))
           .withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= sample)
           .select("doc_id", "lang", "order"))
    picked = materialize(train.join(ids, ["doc_id", "lang"]).select("lang", "text", "order"), "langid-sample")
    rows = (picked.groupBy("lang").applyInPandas(_cluster(idf, k), "lang string, centroid array<float>, bounds array<double>")
            .orderBy("lang", "centroid").collect())
    return {"langs": [r[0] for r in rows], "idf": idf,
            "centroids": np.array([r[1] for r in rows], np.float32).reshape(len(rows), DIMS),
            "bounds": [r[2] for r in rows]}


def _classify(shared, least: float):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        model = shared.value
        langs, centroids, idf = model["langs"], model["centroids"], model["idf"]
        for b in batches:
            out = {k: v for k, v in b.items() if k != "text"} | {"lang_pred": [], "score": [], "rejected": []}
            for counts in _texts(b):
                lang, score, bound = "und", 0.0, least
                if counts is not None and langs:
                    cos = centroids @ vector(counts, idf)
                    best = int(cos.argmax())
                    lang, score = langs[best], float(min(1.0, max(0.0, cos[best])))
                    bound = model["bounds"][best][length_class(counts.sum())] or least
                out["lang_pred"].append(lang)
                out["score"].append(score)
                out["rejected"].append(lang == "und" or score < bound)
            yield out
    return run


def identify(docs: DataFrame, model: dict | None = None, least: float = LEAST) -> DataFrame:
    """Predicted language of every document.

    Returns one row per input row: doc_id, held_out, lang_pred, score (cosine, 0 to 1),
    rejected (no language, or score below the bound of the language and
    length, or ``least`` where none was learned). Only the text is an input.

    Edge cases: null text or text without a letter is ``und`` with score 0 and rejected;
    without training documents all are ``und``; null doc_id is not held out and not learned
    from; repeated rows get equal results; other columns are ignored.
    """
    model = fit(docs) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = map_rows(cols, _classify(shared, least),
                   "doc_id long, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
