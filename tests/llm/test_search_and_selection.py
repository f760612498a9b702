"""Nearest neighbours, importance resampling and collocations against brute force, with awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from txlab.llm import neighbour_graph, phrases, resampling

LARGE = (1 << 53) + 1


def prose(seed, n, vocabulary=40):
    r = random.Random(seed)
    return " ".join(f"w{r.randint(1, vocabulary)}" + r.choice(["", "", "", "", ".", ","]) for _ in range(n))


# ---- nearest neighbours --------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, score string, rank int, v long"


def vector_frame(spark, rows):
    return spark.createDataFrame([(k, None if e is None else [None if x is None else float(x) for x in e], 0, "x", 1, 2) for k, e in rows], VECTORS)


def brute(rows, asks, count=5):
    """Per query the keys and cosines of the nearest rows, in double precision."""
    def usable(e):
        return e is not None and all(x is not None and math.isfinite(x) for x in e) and any(e)
    good = [(k, np.array(np.float32(e), float)) for k, e in rows if k is not None and usable(e)]
    width = max([len(e) for _, e in good], default=1)
    good = [(k, np.pad(e, (0, width - len(e)))) for k, e in good]
    out = set()
    for k, e in {(k, tuple(e)) for k, e in good if asks(k)}:
        e = np.array(e)
        near = sorted(((-round(float(e @ o / (np.linalg.norm(e) * np.linalg.norm(o))), 9), i) for i, o in good if i != k))[:count]
        out |= {(k, r + 1, i, -s) for r, (s, i) in enumerate(near)}
    return out


def answers(df, asks):
    return {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in neighbour_graph.nearest(df, asks).collect()}


def test_neighbours_of_awkward_rows(spark):
    r = np.random.default_rng(1)
    rows = [(k, r.normal(size=8)) for k in range(60)] + [(100 + k, [1] * 8) for k in range(40)] + [(140, [2] * 8), (141, [-1] * 8)]
    rows += [(200, None), (201, [0] * 8), (202, [1, None] + [0] * 6), (203, [float("nan")] * 8), (204, [float("inf")] * 8), (205, []), (None, [1] * 8)]
    rows += [(206, [1, 1, 1]), (10, rows[10][1]), (10, rows[11][1]), (LARGE, rows[3][1]), (300, rows[3][1]), (301, [0.0, 1] + [0] * 6), (302, [-0.0, 1] + [0] * 6)]
    rows = [(k, None if e is None else list(e)) for k, e in rows]
    got = answers(vector_frame(spark, rows), (F.col("vec_id") % 10 == 0) | (F.col("vec_id") == LARGE))
    want = brute(rows, lambda k: k % 10 == 0 or k == LARGE)
    # a repeated key with two vectors asks twice; the pairs of its two answers are compared as a set
    assert {(q, i) for q, _, i, _ in got} == {(q, i) for q, _, i, _ in want}
    assert {x for x in got if x[0] != 10} == {x for x in want if x[0] != 10}
    assert dict(neighbour_graph.nearest(vector_frame(spark, rows[:3]), F.col("vec_id") == 0).dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}


def test_few_or_no_candidates(spark):
    rows = [(0, [1, 0]), (1, [1, 1]), (2, [0, 1]), (3, None)]
    assert answers(vector_frame(spark, rows), F.col("vec_id") % 50 == 0) == brute(rows, lambda k: k == 0)
    assert neighbour_graph.nearest(vector_frame(spark, rows[:1]), F.lit(True)).count() == 0
    assert neighbour_graph.nearest(vector_frame(spark, []), F.lit(True)).count() == 0
    assert neighbour_graph.nearest(vector_frame(spark, rows), F.lit(False)).count() == 0


def test_recall_of_neighbours(spark):
    """Vectors without clusters in 32 dimensions, and a group of near copies; most of the graph is never compared directly."""
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(size=(2500, 32)), r.normal(size=32) + 0.02 * r.normal(size=(500, 32))])
    rows = [(k, list(v)) for k, v in enumerate(x)]
    got = {(q, i) for q, _, i, _ in answers(vector_frame(spark, rows), F.col("vec_id") % 50 == 0)}
    want = {(q, i) for q, _, i, _ in brute(rows, lambda k: k % 50 == 0)}
    recall = len(got & want) / len(want)
    print(f"recall {recall:.3f}")
    assert len(got) == len(want) and recall >= 0.95


# ---- importance resampling -----------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, weight int, n_features int, bucket int"


def features(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def weights(texts, target, longest):
    def runs(t):
        w = features(t)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    s, t = Counter(b for x in texts for b in runs(x)), Counter(b for x in target for b in runs(x))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (S + 10000.0) / ((s[b] + 1.0) * (T + 10000.0))))
    return [(len(runs(x)), sum(gain(b) for b in runs(x))) for x in texts]


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling(spark, longest):
    rows = [(k, prose(k, 5 + k), "en") for k in range(60)] + [(None, prose(5, 30), "x"), (None, None, None), (70, "", "a"), (71, "é" * 30 + " ÀB 日本 x-y_z 1.5", "a"),
            (LARGE, prose(7, 40), None), (72, "word " * 30_000, "b"), (3, prose(3, 25), "en"), (3, prose(3, 25), "en"), *[(80, prose(9, 50), "c")] * 30]
    target = [prose(500, 200), None, "", prose(501, 50, 10)]
    df = spark.createDataFrame([(k, t, g, 1, 2, 3) for k, t, g in rows], DOCS).repartition(5)
    got = resampling.resample(df, spark.createDataFrame([(t, 1) for t in target], "text string, score int"), longest=longest).collect()
    want = []
    for (k, _, _), (n, w) in zip(rows, weights([t for _, t, _ in rows], target, longest)):
        h = int(hashlib.sha256(f"2024:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        want.append((k, n, w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    pool = sorted((x for x in want if x[1] >= 20), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    drawn = Counter((*x, r + 1) for r, x in enumerate(pool[:len(pool) // 10]))
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == Counter(want)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got if r["rank"]) == drawn
    assert all(t in ("bigint",) for _, t in resampling.resample(df.limit(3), df.limit(2)).dtypes)


def test_resampling_of_nothing(spark):
    docs = spark.createDataFrame([(1, prose(1, 30), "en", 1, 2, 3)], DOCS)
    none = docs.where("false")
    assert resampling.resample(none, docs).count() == 0
    assert resampling.resample(docs, none).first()["rank"] is None  # a tenth of one document is none


def test_cut_by_counts(spark):
    r = random.Random(3)
    for values in ([r.randint(-10**18, 10**18) for _ in range(300)], [5] * 50 + [-(1 << 63)] + [(1 << 63) - 1] * 3, [7]):
        df = spark.createDataFrame([(v,) for v in values], "v long")
        for wanted in {1, len(values) // 2 or 1, len(values)}:
            cut = sorted(values)[wanted - 1]
            assert resampling._least(df, "v", wanted) == (cut, sum(v < cut for v in values))


# ---- collocations --------------------------------------------------------------------------------

def brute_collocations(rows, least, top, cover):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = lang or "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f.setdefault(lang, Counter())[tuple(w[i:i + m])] += 1
    out = set()
    for lang, c in f.items():
        often = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        held = Counter()
        for p, a in often.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    held[p[i:i + m]] = max(held[p[i:i + m]], a)
        found = []
        for p, a in often.items():
            if 100 * held[p] >= cover * a:
                continue
            score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top]):
            out.add((lang, rank + 1, p.decode(), -a, left, right, n[lang], -s))
    return out


def collocation_rows(df, **o):
    return {tuple(r) for r in phrases.collocations(df, **o).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


@pytest.mark.parametrize("least,top", [(2, 2000), (5, 7)])
def test_collocations(spark, least, top):
    rows = [(prose(k, 80, 12), "en" if k % 3 else "fr") for k in range(25)] + [(None, "en"), ("", None), (" \t\n.,;", "de"), (prose(3, 60, 5), None),
            ("one two three four " * 2000, "en"), ("x " * 3000, "es"), ("ÉA éa ÉA éa 日本 語\t日本 語\x0b日本  語\x00q", "fr"), *[(prose(99, 50), "de")] * 12, ("one", "it"), ("A b\rA b\x0cA b", "")]
    df = spark.createDataFrame([(k, t, g, "p", 1, 2) for k, (t, g) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, n int, score int").repartition(4)
    assert collocation_rows(df, least=least, top=top) == brute_collocations(rows, least, top, 80)


def test_collocations_of_nothing(spark):
    df = spark.createDataFrame([("a b", "en")], "text string, lang string")
    assert phrases.collocations(df).count() == 0 and phrases.collocations(df.where("false")).count() == 0


def test_chunks_cover_every_run_once():
    """Every run of up to four words starts in the own part of one chunk and ends inside it, whatever surrounds a passage."""
    for seed in range(20):
        text = phrases._tidy(prose(seed, 300, 10 if seed % 2 else 200) + "\n" + "same " * 50)
        runs, found = Counter(), Counter()
        for piece in text.split(b"\n"):
            w = piece.split()
            runs.update(tuple(w[i:i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
        for chunk, own in phrases.chunks(text):
            w = chunk.split(b" ")
            found.update(tuple(w[i:i + m]) for m in range(1, 5) for i in range(min(own, len(w) - m + 1)))
        assert runs == found
    passage = prose(1, 200, 1000).replace(".", "").replace(",", "").encode()
    a, b = ({c for c, _ in phrases.chunks(before + passage)} for before in (b"", b"other words before it "))
    assert len(a & b) >= len(a) - 2


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "PORTION", 100)
    raw = phrases._tidy(prose(4, 2000))
    parts = list(phrases._portions(raw))
    assert b"\n".join(parts) == raw and len(parts) > 20


def test_frequent_runs_need_frequent_parts():
    """A run that its own filter lets through by chance stays out if a part is not frequent, and one bit of two is not enough."""
    import pyarrow as pa

    b = phrases.Block([pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array(["a b c d e\n"]), pa.array([2], pa.int32()), pa.array([40])], ["lang", "chunk", "own", "times"])])
    none, every = np.zeros(phrases.FILTER_WORDS, np.uint64), np.full(phrases.FILTER_WORDS, 2**64 - 1, np.uint64)

    def starts(*filters):
        return [i.tolist() for _, i, _ in phrases._frequent_runs(b, dict(enumerate(filters, 1)), 4)]

    assert starts(every, every, every, every) == [[0, 1], [0, 1], [0, 1], [0, 1]]
    assert starts(every, none, every, every) == [[0, 1], [], [], []]
    h = b.w.hashes(np.array([1]), np.array([2]), b.salt[:1])[0]

    def held(*places):
        f = none.copy()
        for g in places:
            f[int(g) >> 44] |= np.uint64(1 << (int(g) >> 38 & 63))
        return f

    second = int(h) << 26 & 2**64 - 1
    assert starts(every, held(h, second), every, every)[:3] == [[0, 1], [1], []]
    assert starts(every, held(h), every, every)[1] == starts(every, held(second), every, every)[1] == []


def test_phrases_are_cut_out_at_one_place(spark, monkeypatch):
    """The last pass gives a frequent phrase for the places that counts carry, not once for each task that holds it."""
    rows = [("en", f"alpha beta u{k}", 3, 1) for k in range(400)]
    entries = spark.createDataFrame(rows, "lang string, chunk string, own int, times long").repartition(20)
    made, plain = [], type(entries).mapInArrow
    monkeypatch.setattr(type(entries), "mapInArrow", lambda *a, **o: made.append(plain(*a, **o)) or made[-1])
    found = {tuple(r) for r in phrases.frequencies(entries, 30).select("lang", "phrase", "size", "f").collect()}
    assert found == {("en", "alpha", 1, 400), ("en", "beta", 1, 400), ("en", "alpha beta", 2, 400)}
    assert 3 <= sum(df.count() for df in made if "phrase" in df.columns) <= 9


def test_phrases_of_languages_with_one_checksum(spark):
    """``plumless`` and ``buckeroo`` have the same crc32; chunks may also share a place."""
    assert zlib.crc32(b"plumless") == zlib.crc32(b"buckeroo")
    rows = [(f"one two u{k}", "plumless" if k % 3 else "buckeroo") for k in range(90)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    assert collocation_rows(df, least=30) == brute_collocations(rows, 30, 2000, 80)
