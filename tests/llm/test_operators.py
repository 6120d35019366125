"""Each operator against brute force on small tables, with nulls, empty texts, ties and repeats."""

import hashlib
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vigil.llm import (base, decontaminate, fingerprints, langid, licenses, line_dedup, mixing, near_dedup,
                       passages, token_counts, warc)

VOCAB = [f"w{i}" for i in range(400)]
EDGE = [(900, None), (901, ""), (902, " \n "), (903, "one"), (904, "one"), (None, "null id here"), (905, "é" * 5000)]


def _text(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def _corpus(seed=1, n=40):
    """Random texts, exact copies, and copies with one to ten words replaced."""
    rng = random.Random(seed)
    rows = [(i, _text(rng, rng.randint(1, 200))) for i in range(n)]
    base = _text(rng, 150)
    for i in range(n, 2 * n):
        words = base.split()
        for _ in range(rng.randint(0, 10)):
            words[rng.randrange(len(words))] = rng.choice(VOCAB)
        rows.append((i, " ".join(words)))
    return rows + [(200, rows[3][1]), (201, rows[3][1]), (201, rows[3][1])]


def _sets(rows, width=3):
    out = {}
    for i, t in rows:
        w = (t or "").lower().split()
        out[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    return out


def test_near_duplicates_match_brute_force(docs):
    rows = _corpus()
    sets = _sets(rows)
    comp = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                inter = len(sets[a] & sets[b])
                if inter and 100 * inter >= 85 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
        if all(comp[comp[i]] == comp[i] for i in comp):
            break
    got = near_dedup.near_duplicates(docs(rows + EDGE)).collect()
    assert len(got) == len(rows + EDGE)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None and r.doc_id < 900} == comp
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id in (900, 901, 902, 903, 904)} == {
        900: (0, 900), 901: (0, 901), 902: (0, 902), 903: (1, 903), 904: (1, 903)}
    assert near_dedup.near_duplicates(docs([])).count() == 0


def test_large_group_of_near_copies_with_relatives_and_bridges(docs):
    rng = random.Random(43)
    base = [f"b{i}" for i in range(200)]
    def edited(places, mark):
        w = base[:]
        for k in places:
            w[k] = f"{mark}x{k}"
        return " ".join(w)
    rows = [(i, edited([rng.randrange(200)], f"e{i}")) for i in range(150)]
    # edits in 3 to 12 places: some link with the copies, some with each other only, some with none
    for j in range(40):
        places = sorted(rng.sample(range(200), 3 + j % 10))
        rows += [(1000 + 2 * j, edited(places, f"r{j}")), (1001 + 2 * j, edited(places[1:], f"r{j}"))]
    sets = {i: {tuple(t.split()[k:k + 3]) for k in range(len(t.split()) - 2)} for i, t in rows}
    comp = {i: i for i in sets}
    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs(rows)).collect()}
    assert got == {i: root(i) for i in sets} and 5 < len(set(got.values())) < 80


def test_warc_round_trip_with_magic_in_payloads(spark, tmp_path):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    big = "é" * 600
    rows = [(1, "http://a/", big), (2, None, big), (3, "u", fake + "tail"), (4, "u\nx", None), (5, "u", "WARC/1.1\r\n"),
            (6, "u", ""), (7, "u", fake * 50), (8, "u", "plain\r\n\r\n"), (None, "u", big)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = warc.archive_report(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == len(rows)
    for r in got:
        html = dict((p, h or "") for p, _, h in rows)[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(html), hashlib.sha1(html).hexdigest()), r
    assert {r.page_id: r.refers_to for r in got if r.record_type == "revisit"} == {1: 2, None: 2}


def test_warc_of_repeated_page_ids(spark, tmp_path):
    a, b, c = "a" * 1500, "b" * 40, "c" * 2000
    rows = [(3, "u", a), (5, "u", b), (5, "u", a), (5, "u", c), (4, "u", c), (5, "u", c), (None, "u", a), (None, "u", b)]
    got = warc.archive_report(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w")).collect()
    digest = lambda t: (len(t), hashlib.sha1(t.encode()).hexdigest())
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == sorted(
        (str(i), *digest(t), "revisit" if len(t) > 1000 and i != 5 else "response", 5 if len(t) > 1000 and i != 5 else None)
        for i, _, t in rows)
    empty = warc.archive_report(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "e"))
    assert empty.count() == 0


def test_decontamination_matches_brute_force(spark, docs):
    rng = random.Random(3)
    items = [(i, _text(rng, n)) for i, n in enumerate([12, 30, 10, 4, 1])] + [(9, None), (10, "...")]
    rows = [(i, _text(rng, 60)) for i in range(20)]
    rows += [(50, "x, " + items[0][1] + "! y"), (51, items[1][1][20:]), (52, items[3][1].upper())] + EDGE
    bench = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: [w.decode() for w in decontaminate.alnum_words((t or "").encode())]
    want = {}
    for doc, text in rows:
        w, hit, found = split(text), set(), set()
        for item, t in items:
            q = split(t)
            k = min(10, len(q))
            for s in {tuple(q[i:i + k]) for i in range(len(q) - k + 1)} if q else ():
                for i in range(len(w) - k + 1):
                    if tuple(w[i:i + k]) == s:
                        hit.update(range(i, i + k))
                        found.add(str(item))
        want[doc] = (len(w), len(hit), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
    for block in (200_000, 15):    # one block, and several
        got = decontaminate.decontaminate(docs(rows), bench, block_words=block).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.items_sha256) for r in got} == want
    assert decontaminate.decontaminate(docs(rows), bench.limit(0)).filter("contaminated").count() == 0


def _sketch(text, scale=fingerprints.SCALE):
    w, out = [x for x in text.lower().split()], set()
    for i in range(max(1, len(w) - 4)) if w else ():
        h = 42
        for x in w[i:i + 5]:
            h = xxhash.xxh64_intdigest(x.encode(), seed=h)
        out.add(h - 2 ** 64 if h >= 2 ** 63 else h)
    low = {h for h in out if h < -(2 ** 63) + 2 ** 64 // scale}
    return low or ({min(out)} if out else set())


@pytest.mark.parametrize("ranges", [1, 7])
def test_fingerprints_match_brute_force(docs, ranges):
    rows = [r for r in _corpus(5, 20) if r[0] != 201] + [(900, None), (901, ""), (903, "one")]
    got = {r.doc_id: r for r in fingerprints.fingerprint_edits(docs(rows), ranges=ranges).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        a, b, c = _sketch(t), _sketch(edited), _sketch(nxt)
        near = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == "".join(f"{h % 2 ** 64:016x}" for h in sorted(a))
        assert (r.near_edited, r.near_next) == pytest.approx((near(a, b), near(a, c)))


def test_langid_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert out.filter(F.col("lang_pred") == F.col("lang")).count() >= 0.95 * out.count()
    assert out.filter("rejected").count() == 0


def test_langid_rejects_noise_of_any_length_and_keeps_clean_texts(spark):
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(known)
    rng = random.Random(41)
    scripts = {"latin": (97, 26), "cyrillic": (0x430, 32), "greek": (0x3B1, 24), "han": (0x4E00, 8000)}
    rows = [(script, " ".join("".join(chr(first + rng.randrange(n)) for _ in range(rng.randint(2, 9))) for _ in range(words)))
            for script, (first, n) in scripts.items() for words in (30, 100, 300, 1000, 5000) for _ in range(10)]
    noise = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, source string, text string")
    assert langid.identify(noise, model).filter("rejected").count() >= 0.95 * len(rows)
    rejected = F.col("rejected").cast("int")
    # whole documents, and short texts of five of their words
    five = F.array_join(F.slice(F.split("text", " "), 1, 5), " ")
    for text in (F.col("text"), five):
        clean = known.filter("lang is not null and text rlike '[a-zA-Z]{3}'").select("doc_id", text.alias("text"))
        assert langid.identify(clean, model).agg(F.avg(rejected)).first()[0] <= 0.01


def test_langid_edges(docs):
    rows = [(i, "the of and to " * 5, "s", "en") for i in range(9)] + [(20, None), (21, "123 ???"), (22, "")]
    got = {r.doc_id: r for r in langid.identify(docs(rows)).collect()}
    assert {got[i].lang_pred for i in (20, 21, 22)} == {"und"} and all(got[i].rejected for i in (20, 21, 22))
    assert got[0].lang_pred == "en" and 0.9 < got[0].score <= 1
    assert langid.identify(docs([])).count() == 0


def test_passages_exact_and_edited(docs):
    rng = random.Random(7)
    p = _text(rng, 80)
    edited = p.split()
    edited[20], edited[50] = "zz", "yy"
    rows = [(i, _text(rng, 150)) for i in range(10)]
    rows += [(20, _text(rng, 40) + " " + p), (21, p + " " + _text(rng, 60)), (22, _text(rng, 30) + " " + " ".join(edited))]
    got = {(r.doc_id, r.source_id): r for r in passages.repeated_passages(docs(rows + EDGE)).collect()}
    assert set(got) == {(21, 20), (22, 20)}
    assert got[21, 20].first_word == 0 and 80 <= got[21, 20].end_word <= 82 and got[21, 20].identity > 0.97
    assert got[22, 20].end_word - got[22, 20].first_word >= 80 and got[22, 20].identity > 0.9
    assert passages.repeated_passages(docs([])).count() == 0


@pytest.mark.parametrize("foreign", [70, 100, 1000])
def test_passages_second_long_passage_of_a_pair(docs, foreign):
    rng = random.Random(17)
    far = lambda n, tag: " ".join(f"{tag}{rng.randrange(10 ** 9)}" for _ in range(n))
    one, two = far(500, "p"), far(300, "q")
    rows = [(1, f"{one} {far(foreign, 'a')} {two}"), (2, f"{one} {far(foreign, 'b')} {two}")]
    covered = set()
    for r in passages.repeated_passages(docs(rows)).collect():
        assert (r.doc_id, r.source_id) == (2, 1) and r.identity > 0.95
        covered.update(range(r.first_word, r.end_word))
    assert covered >= set(range(500)) | set(range(500 + foreign, 800 + foreign))


def _reported(got, doc, source):
    return {w for r in got if (r.doc_id, r.source_id) == (doc, source) for w in range(r.first_word, r.end_word)}


def test_passages_whose_seeds_stand_elsewhere_and_repeated_words(docs):
    rng = random.Random(19)
    far = lambda n: " ".join(f"f{rng.randrange(10 ** 9)}" for _ in range(n))
    words = far(60).split()
    # every seed of the passage stands in one unrelated earlier document, or in many
    once = [(k, far(20) + " " + " ".join(words[k:k + 6]) + " " + far(20)) for k in range(0, 60, 2)]
    hot = far(60).split()
    many = [(100 + 40 * k + n, far(9) + " " + " ".join(hot[k:k + 6]) + " " + far(9)) for k in range(0, 60, 2) for n in range(20)]
    rows = once + many + [(5000, " ".join(words)), (5001, far(30) + " " + " ".join(words)),
                          (5002, " ".join(hot)), (5003, far(30) + " " + " ".join(hot)),
                          (6000, far(5) + " again" * 70), (6001, far(7) + " again" * 300),
                          (6002, (far(20) + " ") * 10)]
    rows.append((6003, far(3) + " " + rows[-1][1]))
    got = passages.repeated_passages(docs(rows)).collect()
    assert _reported(got, 5001, 5000) == set(range(30, 90))
    assert _reported(got, 5003, 5002) == set(range(30, 90))
    assert _reported(got, 6001, 6000) == set(range(7, 307))
    assert _reported(got, 6003, 6002) == set(range(3, 203))


@pytest.mark.parametrize("alike", [0.8, 0.85, 0.9])
def test_passages_recall_of_edited_copies(docs, alike):
    rng = random.Random(23)
    far = lambda n: [f"f{rng.randrange(10 ** 9)}" for _ in range(n)]
    rows, n = [], 0
    for length in [60] * 60 + [100] * 30:
        p = far(length)
        q = p[:]
        inner = [k for k in range(length) if 2 <= k < length - 2]    # the passage keeps its ends
        for k in rng.sample(inner, round(length * (1 - alike))):
            q[k] = far(1)[0]
        rows += [(n, " ".join(far(40) + p + far(40))), (n + 1, " ".join(far(25) + q + far(30)))]
        n += 2
    got = passages.repeated_passages(docs(rows)).collect()
    # brute force finds each of them: the copies are aligned word by word and reach the bounds
    found = sum(len(_reported(got, k + 1, k)) >= 50 for k in range(0, n, 2))
    assert found >= 0.97 * n / 2, found


def test_passages_edited_copies_of_words_that_stand_in_many_places(docs):
    """Every 4-gram stands in 18 unrelated earlier documents, and each word but one in 5 to 10 is copied."""
    rng = random.Random(31)
    far = lambda n: [f"f{rng.randrange(10 ** 9)}" for _ in range(n)]
    rows, copies = [], set()
    for k, step in enumerate([5, 6, 7, 7, 8, 8, 10]):
        p = far(60)
        for _ in range(18):     # in pieces too short for a passage
            for at in range(0, 57, 4):
                rows.append((len(rows), " ".join(far(9) + p[at:at + 7] + far(9))))
        q = [w if at % step != step - 1 else far(1)[0] for at, w in enumerate(p)]
        rows += [(10_000 + 2 * k, " ".join(far(40) + p + far(40))), (10_001 + 2 * k, " ".join(far(25) + q + far(30)))]
        copies.add((10_001 + 2 * k, 10_000 + 2 * k))
    got = passages.repeated_passages(docs(rows)).collect()
    # brute force: the copies are aligned word by word and 48 or more of 60 words are alike
    assert {(r.doc_id, r.source_id) for r in got} == copies
    assert all(len(_reported(got, *c)) >= 50 for c in copies)


def test_passages_crowded_copies_with_words_inserted_and_removed(docs):
    """Every 4-gram stands in 18 unrelated documents; in the copies every n-th word is followed by a new one or left out."""
    rng = random.Random(43)
    far = lambda n: [f"f{rng.randrange(10 ** 9)}" for _ in range(n)]
    rows, copies = [], set()
    for k, (step, more) in enumerate([(7, True), (8, False), (8, True), (9, False), (10, True)]):
        p = far(72)
        for _ in range(18):
            for at in range(0, 69, 4):
                rows.append((len(rows), " ".join(far(9) + p[at:at + 7] + far(9))))
        q = [v for at, w in enumerate(p) for v in ([w] if at % step != step - 1 else [w, *far(1)] if more else [])]
        rows += [(20_000 + 2 * k, " ".join(far(40) + p + far(40))), (20_001 + 2 * k, " ".join(far(25) + q + far(30)))]
        copies.add((20_001 + 2 * k, 20_000 + 2 * k))
    got = passages.repeated_passages(docs(rows)).collect()
    assert {(r.doc_id, r.source_id) for r in got} == copies
    assert all(len(_reported(got, *c)) >= 50 for c in copies)


def test_passages_crowded_places_in_blocks_and_short_texts(docs, monkeypatch):
    """Places of a seed in several blocks give the same pairs; texts too short for a passage give none."""
    rng = random.Random(47)
    far = lambda n: [f"f{rng.randrange(10 ** 9)}" for _ in range(n)]
    p = far(60)
    rows = [(n, " ".join(far(9) + p[at:at + 7] + far(9))) for n, at in enumerate(list(range(0, 57, 4)) * 18)]
    rows += [(1000 + n, " ".join(p[:30])) for n in range(20)]
    rows += [(5000, " ".join(far(40) + p + far(40))), (5001, " ".join(far(25) + [w if at % 7 else "zz" for at, w in enumerate(p)] + far(30)))]
    rows += [(6000 + n, " ".join(far(12) + ["again"] * (20 + n) + far(12))) for n in range(9)]
    whole = passages.repeated_passages(docs(rows)).collect()
    assert {(r.doc_id, r.source_id) for r in whole} == {(5001, 5000)}
    monkeypatch.setattr(passages, "BLOCK", 5)
    assert passages.repeated_passages(docs(rows)).collect() == whole


def test_passages_places_are_sent_in_few_bytes_and_none_is_lost(docs, spark):
    """Seeds, documents and positions of whole texts, at 10 bytes a place or less; a row each took over 20."""
    rng = random.Random(61)
    rows = [(rng.randrange(-10 ** 12, 10 ** 12), _text(rng, rng.randrange(0, 900))) for _ in range(300)]
    rows += [(7, "a b c"), (8, None), (9, "a b c d"), (9, "x a b c d"), (10, "a a a a a a a")]
    base = docs(rows).selectExpr("doc_id doc", "text words")
    got = passages.map_rows(base, passages._packed(passages._seeds, 5), passages.PACK).collect()
    places = [p for r in got for p in zip(*(v.tolist() for v in passages.unpack(
        r.places, r.seeds, r.runs, r.docs, r.ends, r.steps)), strict=True)]
    want = []
    for doc, text in rows:
        s = passages.seed_hashes(passages.WordHash().of(passages.space_words((text or "").encode())))
        want += [(h, doc, at) for at, h in enumerate(s.tolist())]
    assert sorted(places) == sorted(want)
    assert len({(p[0], r.bucket) for r in got for p in zip(passages.unpack(
        r.places, r.seeds, r.runs, r.docs, r.ends, r.steps)[0].tolist(), strict=True)}) == len({p[0] for p in places})
    sent = sum(len(r.seeds) + len(r.docs) + len(r.ends) + len(r.steps) for r in got)
    assert sent <= 10 * len(places), sent / len(places)


def test_passages_seeds_of_two_documents_against_all_places():
    rng = np.random.default_rng(67)
    for n in (1, 9, 400):
        seed, doc, pos = rng.integers(0, n // 2 + 1, n), rng.integers(-5, 5, n), rng.integers(0, 50, n).astype(np.int32)
        *got, cuts = passages.repeated_seeds(seed, doc, pos)
        want = sorted((s, d, p) for s, d, p in zip(seed.tolist(), doc.tolist(), pos.tolist(), strict=True)
                      if len({e for t, e in zip(seed.tolist(), doc.tolist(), strict=True) if t == s}) > 1)
        assert [tuple(r) for r in zip(*(v.tolist() for v in got), strict=True)] == want
        assert [want[c][0] for c in cuts[:-1]] == sorted({w[0] for w in want}) and cuts[-1] == len(want)


def test_passages_bytes_of_words_leave_out_no_passage():
    rng = random.Random(73)
    seen = set()
    for _ in range(600):
        x = [b"%d" % rng.randrange(3000) for _ in range(140)]
        y = [b"%d" % rng.randrange(3000) if rng.random() < rng.choice([0.1, 0.2, 0.3]) else w for w in x[:rng.randrange(60, 141)]]
        at = [k for k in range(len(y) - 3) if x[k:k + 4] == y[k:k + 4]]
        at = [k for k in at if k - at[0] < rng.choice([2, 60])]
        if not at:
            continue
        codes = [bytes(passages.WordHash().of(w).astype(np.uint8)) for w in (x, y)]
        got = passages.align(x, y, at, at)
        passes = got[1] - got[0] >= 50 and got[4] >= 0.8
        assert passages.may_align(*codes, at, at, 50, 0.8) or not passes
        seen.add((passes, passages.may_align(*codes, at, at, 50, 0.8)))
    assert {(True, True), (False, False)} <= seen


def test_passages_leave_no_table_behind_but_the_found_ones(docs, monkeypatch):
    """A source that many share is dealt over tasks, a pair's slices are apart, rows of equal doc_id have two texts."""
    rng = random.Random(71)
    far = lambda n: " ".join(f"f{rng.randrange(10 ** 9)}" for _ in range(n))
    one, two = far(80), far(90)
    rows = [(1, f"{one} {far(900)} {two}"), *((10 + n, f"{two} {far(700)} {one}") for n in range(5)),
            (50, f"{far(3)} {one}"), (50, f"{far(4)} {two}")]
    with base.scoped_tables() as made:
        whole = passages.repeated_passages(docs(rows)).collect()
    assert len(made) == 2 and all("passage-found" in path for path in made)
    for doc in range(10, 15):
        assert _reported(whole, doc, 1) == set(range(90)) | set(range(790, 870))
    assert _reported(whole, 50, 1) == set(range(3, 83)) | set(range(4, 94))
    monkeypatch.setattr(passages, "SHARED", 2)
    assert sorted(passages.repeated_passages(docs(rows)).collect()) == sorted(whole)


def test_passages_of_repeated_words_are_chained_a_few_times(docs, monkeypatch):
    """Copies of repeated words, of a repeated line and of a text that repeats itself: each diagonal was a chain before."""
    rng = random.Random(83)
    far = lambda n: " ".join(f"f{rng.randrange(10 ** 9)}" for _ in range(n))
    line, own = far(31), " ".join(far(9) + " the same words come again and again" for _ in range(40))
    rows = [(n, f"{far(20)} {'over ' * 600} {far(5)} {f'{line} ' * 20} {far(5)} {'this that ' * 200} {own}") for n in range(4)]
    chained, found = [], passages.materialize

    def counted(df, name):
        out = found(df, name)
        if name in ("passage-chains", "passage-likely"):
            chained.append(out.count())
        return out
    monkeypatch.setattr(passages, "materialize", counted)
    got = passages.repeated_passages(docs(rows)).collect()
    for n in range(1, 4):
        assert len(_reported(got, n, 0)) >= 600 + 31 * 20 + 400 + 16 * 40
    assert sum(chained) < 1500, chained


def test_passages_of_a_chain_that_goes_on_elsewhere(docs):
    """The words behind the passage stand farther behind in the source, or others do in between: a part of the chain is a passage."""
    rng = random.Random(89)
    far = lambda n: " ".join(f"f{rng.randrange(10 ** 9)}" for _ in range(n))
    one, two, three = far(55), far(12), far(9)
    rows = [(1, f"{far(9)} {one} {far(45)} {two} {far(60)} {three}"), (2, f"{far(5)} {one} {two} {far(50)} {three} {far(9)}")]
    got = passages.repeated_passages(docs(rows)).collect()
    assert _reported(got, 2, 1) == set(range(5, 60))


def test_passages_words_of_odd_texts_have_the_hashes_of_words():
    texts = [b"  A b\tC\n d ", None, b"", b" ", b"x", "\u00c4 \u00a0B\x0bc\x1cd\x0ce a".encode()]
    for more in ([], [b"\xff a", b"B \xfe"]):
        h, words = passages.word_hashes(texts + more)
        split = [passages.space_words(text) for text in texts + more]
        assert words.tolist() == list(map(len, split))
        assert h.tolist() == [v for w in split for v in passages.WordHash().of(w).tolist()]


def test_passages_packed_rows_come_whole_to_the_tasks_of_their_keys():
    rng = np.random.default_rng(97)
    columns = [rng.integers(-2 ** 62, 2 ** 62, 500), rng.integers(0, 40, 500), *(rng.integers(0, 10 ** 9, 500) for _ in range(5)),
               rng.integers(0, 2 ** 63, (500, 4)).astype(np.uint64)]
    sent = list(passages.deal(passages.RUNS, columns[1], columns, 7))
    assert sum(map(len, (b["rows"] for b in sent))) <= 7
    got = passages.columns_of(passages.dealt(iter(sent)), passages.RUNS)
    rows = lambda c: sorted(tuple(np.ravel(v[i]).tolist()[k] for v in c for k in range(np.ravel(v[i]).size)) for i in range(500))
    assert rows(got) == rows(columns)


def test_passages_bits_and_bytes_of_words_leave_out_no_run_and_no_chain():
    """Against the alignment of the words: runs by bits of the words around, chains by their bytes, in parts where they go astray."""
    rng = random.Random(101)
    seen = set()
    for _ in range(400):
        x, odds = [b"%d" % rng.randrange(3000) for _ in range(150)], rng.choice([0.1, 0.2, 0.3, 0.45])
        y = [b"%d" % rng.randrange(3000) if rng.random() < odds else w for w in x]
        at = [k for k in range(30, 110) if x[k:k + 4] == y[k:k + 4]]
        if not at:
            continue
        end = at[0]
        while end + 1 in at:
            end += 1
        h = [passages.WordHash().of(w) for w in (x, y)]
        around = np.ones(400, bool)
        around[100:250] = (h[0] & np.uint64(3)) != (h[1] & np.uint64(3))
        left, right = (np.packbits(around[v:v + 64], bitorder="little").view(np.uint64) for v in (100 + at[0] - 64, 100 + end + 4))
        room = tuple(np.clip(np.array([v]) - 64, 0, 16) for v in (at[0], 150 - end - 4))
        lo, hi = max(0, at[0] - 80), min(150, end + 84)
        got = passages.align(x[lo:hi], y[lo:hi], [at[0] - lo, end - lo], [at[0] - lo, end - lo])
        passes = got[1] - got[0] >= 50 and got[4] >= 0.8
        may = bool(passages.may_pass(left, right, np.array([end + 4 - at[0]]), room, 50, 0.8)[0])
        assert may or not passes
        codes = [bytes(v.astype(np.uint8)) for v in h]
        parts = list(passages.likely_parts(*codes, at, at, 50, 0.8, 1))
        whole = passages.align(x, y, at, at)
        assert parts or not (whole[1] - whole[0] >= 50 and whole[4] >= 0.8)
        seen.add((may, passes, bool(parts)))
    assert {(True, True, True), (False, False, False)} <= seen


def test_passages_places_inside_repetitions_and_their_ends():
    seed = np.array([1, 2, 3, 3, 3, 3, 9, 4, 5, 4, 5, 4, 5, 6, 7, 8, 6])
    begins = np.zeros(len(seed), bool)
    begins[[0, 6]] = True
    inside, rest = passages.repeats(seed, begins)
    assert np.flatnonzero(inside).tolist() == [3, 4, 5, 9, 10, 11, 12]
    assert rest.tolist() == [0, 0, 3, 2, 1, 0, 0, 5, 4, 3, 2, 1, 0, 0, 0, 0, 0]


def test_passages_words_beyond_the_ends_of_a_text_differ():
    left, right = passages.inside(*np.zeros((2, 4), np.uint64), np.array([0, 3, 64, 90]), np.array([4, 63, 64, 5]))
    assert [int(v).bit_count() for v in left] == [64, 61, 0, 0] and int(left[1]) == 2 ** 61 - 1
    assert [int(v).bit_count() for v in right] == [60, 1, 0, 59] and int(right[0]) == 2 ** 64 - 16


def test_passages_word_by_word_against_all_windows():
    rng = np.random.default_rng(59)
    seen = set()
    for _ in range(400):
        differs = rng.random(128) < rng.choice([0.15, 0.25, 0.4])
        differs[64:64 + rng.integers(4, 30)] = False
        differs[:rng.integers(0, 60)] = True        # the text begins, and ends, here
        differs[128 - rng.integers(1, 60):] = True
        left, right = np.packbits(differs, bitorder="little").view(np.uint64).reshape(2, 1)
        brute = any(differs[a:b].sum() <= 0.2 * (b - a) for a in range(1, 65) for b in range(max(64, a + 50), 128))
        got = bool(passages.word_by_word(left, right, 50, 0.8)[0])
        assert got or not brute
        seen.add((got, brute))
    assert {(True, True), (False, False)} <= seen


def test_passages_pairs_of_a_seed_against_all_pairs():
    rng = np.random.default_rng(53)
    for n in (1, 7, 300):
        kind = np.sort(rng.integers(0, 3, n))
        doc, fresh, block = rng.integers(0, 40, n), rng.random(n) < 0.7, rng.integers(0, 2, n)
        for dealt in (block, np.zeros(n, np.int64)):
            got = sorted((int(x), int(y)) for xs, ys in passages.begins_of_runs(kind, doc, fresh, dealt) for x, y in zip(xs, ys, strict=True))
            two = len(set(dealt.tolist())) > 1
            assert got == [(x, y) for x in range(n) for y in range(n) if doc[y] < doc[x] and fresh[x]
                           and (kind[x] != kind[y] or not kind[x]) and (not two or dealt[x] != dealt[y])]


def test_passages_matches_without_company_only_are_left_out():
    rng = random.Random(41)
    rows = sorted({(rng.randrange(3), rng.randrange(3), rng.randrange(900), rng.choice([4] * 30 + [8, 50])) for _ in range(120)})
    kept = passages._in_company(*map(list, zip(*rows, strict=True)))
    for i, (doc, src, x, _) in enumerate(rows):
        reach = [(p, p + n - 4) for k, (d, s, p, n) in enumerate(rows) if k != i and (d, s) == (doc, src)]
        if any(p - 64 <= x <= end + 64 for p, end in reach):
            assert i in kept
    far = [(1, 1, 0, 4), (1, 2, 0, 4), (1, 2, 65, 4), (1, 3, 0, 4), (1, 3, 64, 4), (2, 1, 0, 4)]
    assert passages._in_company(*map(list, zip(*far, strict=True))) == [0, 3, 4, 5]


def test_passages_filter_of_crowded_places_loses_no_alike_pair():
    rng = np.random.default_rng(37)
    for _ in range(300):
        length = int(rng.integers(50, 140))
        differs = np.zeros(400, bool)
        differs[:] = rng.random(400) < 0.9
        at = 130
        differs[at:at + length] = False
        differs[at + rng.choice(length, int(0.2 * length), replace=False)] = True
        begins = [x for x in range(at, at + length - 3) if not differs[x:x + 4].any() and (x == at or differs[x - 1])]
        bits = lambda part: np.packbits(part, bitorder="little").view(np.uint64)
        left = np.concatenate([bits(differs[x - 64:x]) for x in begins])
        right = np.concatenate([bits(differs[x:x + 64]) for x in begins])
        assert passages.may_be_alike(left, right, 50, 0.8).any()
    one = np.array([0xFFFF_FFFF_FFFF_FFFF], np.uint64)
    assert not passages.may_be_alike(one, one << np.uint64(13), 50, 0.8).any()


def test_licenses_match_exact_containment(docs):
    rng = random.Random(9)
    rows = [(i, _text(rng, 100)) for i in range(5)]
    rows += [(50 + k, _text(rng, 37) + " " + t + " " + _text(rng, 41)) for k, t in enumerate(licenses.TEMPLATES.values())]
    rows += [(90, "Released under\nthe MIT license"), (90, "nothing"), *EDGE]
    words = lambda t: "".join(c if c.isascii() and c.isalnum() else " " for c in (t or "").lower()).split()
    grams = lambda w: {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
    got = {(r.doc_id, r.license): r.containment for r in licenses.scan_licenses(docs(rows)).collect()}
    for k, name in enumerate(licenses.TEMPLATES):
        assert got[50 + k, name] == 1.0
    assert (90, "mit-short") in got
    for (doc, name), c in got.items():
        t = grams(words(licenses.TEMPLATES[name]))
        assert c <= max(len(t & grams(words(x))) / len(t) for i, x in rows if i == doc) + 1e-9 and c >= 0.8
    assert {d for d, _ in got} == {50 + k for k in range(len(licenses.TEMPLATES))} | {90}


def test_mixing_meets_targets(docs):
    rng = random.Random(11)
    rows = [(i, _text(rng, rng.randint(1, 60)), rng.choice(["a", "b", "c", None])) for i in range(800)]
    rows += [(900, None, "a"), (901, "", "empty"), (None, "x y", "b"), (5, "x y z", "b")]
    a = sorted(map(str, mixing.mix_sources(docs(rows)).collect()))
    assert a == sorted(map(str, mixing.mix_sources(docs(rows[::-1])).collect()))
    per = {}
    for r in mixing.mix_sources(docs(rows)).collect():
        assert r.taken <= 2 * r.size
        t = per.setdefault(r.source, [0, r.target, r.source_size])
        t[0] += r.taken
    assert sum(t[1] for t in per.values()) == pytest.approx(1.5 * sum(t[2] for t in per.values()))
    assert all(abs(t[0] - t[1]) <= 60 and t[1] <= 2 * t[2] for t in per.values())


def test_mixing_takes_documents_by_their_inclusion_odds(spark, docs):
    rng = random.Random(12)
    lengths = {1: 1, 3: 2, 12: 4, 50: 6, 200: 8}    # words: bits
    rows = [(i, " ".join([f"w{i}"] * rng.choice(list(lengths))), rng.choice("aaaabc")) for i in range(9000)]
    rows += [(None, f"without id {i}", "a") for i in range(3000)]
    table = docs(rows)
    sized = table.select("source", mixing.n_words(F.col("text")).alias("size")).withColumn("bits", F.length(F.bin("size")))
    targets = mixing.source_targets(sized)
    expected = {(r.source, r.bits): r for r in mixing.expected_copies(sized, targets).collect()}
    for source, target in {(r.source, r.target) for r in expected.values()}:
        assert sum(r.copies * r.words for r in expected.values() if r.source == source) == pytest.approx(target)
    got = {}
    for r in mixing.mix_sources(table).collect():
        got.setdefault((r.source, r.size.bit_length()), []).append(r.copies)
        assert r.copies in (math.floor(expected[r.source, r.size.bit_length()].copies), math.ceil(expected[r.source, r.size.bit_length()].copies))
    assert got.keys() == expected.keys()
    unequal = 0
    for key, copies in got.items():
        want, p = expected[key].copies, expected[key].copies % 1
        assert abs(sum(copies) - want * len(copies)) <= 4 * math.sqrt(len(copies) * p * (1 - p)) + 1, key
        unequal += 0 < p < 1
    assert unequal >= 8     # the sample's probabilities differ between the classes of a source


def test_token_counts_match_brute_force(docs):
    pieces = {"▁": -3.0, "▁th": -2.0, "the": -2.5, "▁the": -1.0, "e": -2.0, "re": -2.2, "a": -4.0, "t": -4.5, "h": -4.6, "ré": -2.0}
    unknown = token_counts.unknown_score(pieces)

    def count(word):
        w, best = "▁" + word, [(0.0, 0)]
        for end in range(1, len(w) + 1):
            best.append(max([(best[end - 1][0] + unknown, best[end - 1][1] - len(w[end - 1].encode()))] + [
                (best[i][0] + pieces[w[i:end]], best[i][1] - 1) for i in range(end) if w[i:end] in pieces]))
        return -best[-1][1]
    rows = [(1, "the there tree"), (1, "the there tree"), (2, "xyz théré ath"), *EDGE]
    got = token_counts.token_counts(docs(rows), pieces).collect()
    want = sorted((str(i), len((t or "").split()), sum(map(count, (t or "").split()))) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_pretokens, r.n_tokens) for r in got) == want


def _check_lines(docs, rows):
    """Operator 10 against comparing each line with all earlier ones."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).digest()))
    seen, want, texts = [], {}, []
    for doc, text in order:
        gone = []
        for no, line in enumerate(text.split("\n") if text else []):
            w = [x.encode() for x in line.lower().split()]
            if w:
                if any(v == w or (min(len(v), len(w)) >= 5 and line_dedup.within_one_edit(v, w)) for v in seen):
                    gone.append(no)
                seen.append(w)
        left = [x for no, x in enumerate((text or "").split("\n")) if no not in gone]
        if any(x.split() for x in left) or not (text or "").split():
            texts.append((str(doc), None if text is None else "\n".join(left)))
        want.setdefault((str(doc), hashlib.md5((text or "").encode()).hexdigest()), []).append((gone, len((text or "").split("\n")) if text else 0))
    got = line_dedup.duplicate_lines(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_rows, r.n_lines, r.n_kept, r.removed_lines) for r in got) == sorted(
        (k[0], len(v), v[0][1], v[0][1] - len(v[0][0]), v[0][0]) for k, v in want.items())
    left = [(str(r.doc_id), r.text) for r in line_dedup.dedup_lines(docs(rows)).collect()]
    assert sorted(left, key=str) == sorted(texts, key=str)


def _edited_lines(rng, n, ids):
    lines = [_text(rng, rng.randint(1, 12)) for _ in range(30)]

    def edit(line):
        w = line.split()
        k = rng.randrange(len(w))
        return " ".join(rng.choice([w[:k] + w[k + 1:], w[:k] + [rng.choice(VOCAB)] + w[k + 1:], w[:k] + ["new"] + w[k:]]))
    return [(ids(i), "\n".join(edit(rng.choice(lines)) if rng.random() < 0.5 else rng.choice(lines) for _ in range(6)) + "\n\n")
            for i in range(n)], lines


def test_lines_match_brute_force(docs):
    rows, lines = _edited_lines(random.Random(13), 40, lambda i: i)
    _check_lines(docs, rows + [(900, None), (901, ""), (902, " \n "), (None, lines[0]), (-5, lines[1]), (2 ** 63 - 1, lines[2])])


def test_lines_of_null_and_repeated_ids(docs):
    rng = random.Random(14)
    rows, lines = _edited_lines(rng, 40, lambda i: rng.choice([None, None, 1, 2, 3]))
    _check_lines(docs, rows + rows[:6] + [(None, ""), (None, ""), (1, None), (1, " "), (1, " ")])
    _check_lines(docs, [(1, "same line"), (1, "same line"), (None, "other line"), (None, "other line")])
    _check_lines(docs, [(1, "a b c d e f"), (1, "p q r s t u"), (2, "p q r s t v")])
    assert line_dedup.duplicate_lines(docs([])).count() == line_dedup.dedup_lines(docs([])).count() == 0


def test_very_long_lines(monkeypatch, docs):
    """A line of 200,000 words takes as many steps; one edit of it is found across tasks' batches."""
    words = [f"w{i * i % 7919}" for i in range(200_000)]
    other = words[:150_000] + ["new"] + words[150_000:]
    got = {r.doc_id: r.removed_lines for r in line_dedup.duplicate_lines(docs(
        [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[1:])), (4, " ".join(words[2:]))])).collect()}
    assert got == {1: [], 2: [0], 3: [0], 4: [0]}


def test_variant_keys_tell_words_and_places_apart():
    rng = random.Random(5)
    for _ in range(300):
        w = [rng.choice(b"abc").to_bytes() for _ in range(rng.randint(1, 9))]
        keys = line_dedup.variant_keys(w)
        assert [line_dedup.variant_keys(w[:i] + w[i + 1:])[0] for i in range(len(w)) if len(w) > 1] == keys[1:] * (len(w) > 1)
    keys = {}
    for n in range(1, 7):
        for at in range(3 ** n):
            w = [b"abc"[at // 3 ** i % 3].to_bytes() for i in range(n)]
            assert keys.setdefault(line_dedup.variant_keys(w)[0], w) == w


def test_one_edit():
    e = line_dedup.within_one_edit
    a = [b"a", b"b", b"c"]
    assert e(a, a) and e(a, a[:2]) and e(a, [b"a", b"x", b"c"]) and e(a, [b"z", *a])
    assert not e(a, [b"b", b"a", b"c"]) and not e(a, a[:1]) and not e(a, [b"x", b"y", b"c"])
