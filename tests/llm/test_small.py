"""Awkward rows for every operator: NULLs, empty and long texts, repeated rows, empty tables, clashing names."""

import gzip
import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from txlab.llm import bpe, components, lines, mixing, quality, sharding, simhash, suffixes, toxicity, vectors, warc
from txlab.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, component string, position int, removed int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, "c", 2, 3, 4) for i, t, s in rows], SCHEMA)


def prose(seed, n, length=7):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, length))) for _ in range(n)) + "."


PASSAGE = prose(99, 120)


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(1, None, None), (2, "", "a"), (3, " \n\t", "a"), (4, prose(1, 60), "b"), (4, prose(1, 60), "b"), (5, prose(1, 60), "b"),
            (6, prose(1, 59) + " changed.", None), (7, PASSAGE + " " + prose(2, 30), "b"), (8, prose(3, 30) + "\n" + PASSAGE, "c"),
            (9, "x" * 30_000, "c"), (10, prose(4, 9000), "a"), (None, prose(5, 40), "d"), (11, "é ü\n日本 語\n" * 200, "ü"),
            (12, "Home | About | Contact\n" + prose(6, 30), "d"), (4, prose(7, 20), "b")]
    return frame(spark, rows)


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.where("false")


def split(text):
    return (text or "").encode().split()


def test_components(spark):
    r = random.Random(3)
    links = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(None, 1), (5, 5)]
    got = {x.node: x.component for x in components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    low = {k: k for p in links for k in p if None not in p and p[0] != p[1]}
    for _ in range(100):
        for a, b in links:
            if None not in (a, b) and a != b:
                low[a] = low[b] = min(low[a], low[b])
    assert got == low
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_sharding(spark, awkward, empty):
    docs = awkward.toPandas()
    for n in (1, 3, 40):
        rows = sharding.shard(awkward, n).collect()
        assert len(rows) == len(docs)
        for k in range(n):
            slots = sorted(r.slot for r in rows if r.shard == k)
            assert slots == list(range(len(slots)))
        assert all(0 <= r.shard < n for r in rows)
        assert len({(r.text_crc32, r.size, r.shard) for r in rows}) == len({(r.text_crc32, r.size) for r in rows})
    assert sharding.shard(empty, 4).count() == 0


def least_capacity(sizes, shards):
    best = {0: 0}
    for _ in range(shards):
        new = {}
        for i, c in best.items():
            total = 0
            for j in range(i, len(sizes) + 1):
                if j > i:
                    total += sizes[j - 1]
                new[j] = min(new.get(j, 1 << 60), max(c, total))
        best = new
    return best[len(sizes)]


def test_cuts_are_minimax_with_few_known_ends():
    r = random.Random(1)
    for trial in range(60):
        sizes = [r.choice([1, 5, 20, 300 if trial % 3 == 0 else 30]) for _ in range(r.randint(1, 60))]
        ends, shards = list(itertools.accumulate(sizes)), r.randint(1, 8)
        known = sorted({ends[-1], *r.sample(ends, min(3, len(ends)))})

        def refine(row, stretches):
            more = set(row.ends)
            for k in stretches:
                inner = [e for e in ends if (row.ends[k - 1] if k else 0) < e < row.ends[k]]
                more.add(inner[len(inner) // 2])
            new = sorted(more)
            return sharding.Row(new, [any(a < e < b for e in ends) for a, b in zip([0] + new, new)], row.largest)

        row = sharding.Row(known, [any(a < e < b for e in ends) for a, b in zip([0] + known, known)], max(sizes))
        capacity, cuts = sharding.find_cuts(row, shards, refine)
        parts = [b - a for a, b in zip([0] + cuts, cuts)]
        assert capacity == least_capacity(sizes, shards) and max(parts) == capacity, (sizes, shards)
        assert set(cuts) <= set(ends) | {0} and cuts[-1] == ends[-1] and len(cuts) == shards


def repeat_words(ws):
    seen = Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    return len({k for i in range(len(ws) - 4) if seen[tuple(ws[i:i + 5])] > 1 for k in range(i, i + 5)})


@pytest.mark.parametrize("places", [8, 20_000])
def test_sharding_with_a_huge_group(spark, monkeypatch, places):
    monkeypatch.setattr(sharding, "PLACES", places)
    monkeypatch.setattr(sharding, "PREFIX", 1)
    r = random.Random(3)
    texts = ["h" * 60_000] + [f"{k} " + "x" * r.randint(1, 90) for k in range(700)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for shards in (1, 4, 9):
        rows = sharding.shard(docs, shards).collect()
        order = sorted(texts, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
        size = Counter()
        for x in rows:
            size[x.shard] += x.size
        assert len(rows) == len(texts) and max(size.values()) == least_capacity([len(t) + 16 for t in order], shards)
        of = {x.doc_id: x.shard for x in rows}
        assert [of[texts.index(t)] for t in order] == sorted(of.values())


@pytest.mark.parametrize("shards", [3, 7])
def test_sharding_of_many_small_groups(spark, monkeypatch, shards):
    monkeypatch.setattr(sharding, "PLACES", 8)
    monkeypatch.setattr(sharding, "PREFIX", 1)
    texts = [f"{k} " + "x" * (k * 37 % 211) for k in range(600)]
    rows = sharding.shard(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shards).collect()
    size = Counter()
    for x in rows:
        size[x.shard] += x.size
    sizes = [len(t) + 16 for t in sorted(texts, key=lambda t: hashlib.sha256(t.encode()).hexdigest())]
    assert max(size.values()) == least_capacity(sizes, shards)


def test_quality(awkward, empty, spark):
    more = frame(spark, [(20, "a b c d e f a b c d e f g\n" * 3, "s"), (21, "one two three four five one two three four five", "s"), (22, "a b\n\na b\n \nc #$", "s")])
    docs = awkward.union(more)
    for r in quality.judge(docs).collect():
        ws = split(r.text)
        assert r.n_words == len(ws) and r.word_chars == sum(len(w.decode()) for w in ws)
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in r.text or "")
        worded = [x for x in (r.text or "").split("\n") if x.encode().split()]
        assert r.n_dup_lines == len(worded) - len(set(worded)) and r.n_lines == len(worded)
        assert r.n_repeat_words == repeat_words(ws)
        assert r.base_failed == (len(ws) < 10 or 100 * r.n_repeat_words > 20 * len(ws))
        assert r.kept == (not r.base_failed and r.n_lost_chars * 100 <= r.n_line_chars * 40)
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert got[12].n_removed_lines == 1 and got[12].cleaned == got[12].text.split("\n")[1] and got[12].kept
    assert quality.judge(docs).where("kept").count() == sum(r.kept for r in quality.judge(docs).collect())
    assert quality.judge(empty).count() == 0
    assert {c: t for c, t in quality.judge(docs).dtypes}["removed"] == "int"


def test_quality_keeps_prose_that_mentions_boilerplate(spark):
    prose_lines = ["The library keeps its catalog in the basement of the old town hall.", "The firm gained market share on its rivals in the second half of the year.",
                   "The team finished the design update before the end of the week.", "Children who read more at home tend to write better at school.",
                   "A reader may sign up for the course at the desk, and most of them do so in spring."]
    junk = ["Read more", "Click here to read more about our services.", "Copyright 2020 Example Company Limited. All rights reserved.", "Sign up for our newsletter!",
            "This site uses cookies to improve your experience.", "Privacy policy and terms of use.", " | ".join(f"Entry number {k}" for k in range(40)),
            " > ".join(f"Part {k}" for k in range(9000))]
    got = [r.rule for r in spark.createDataFrame([(k, x) for k, x in enumerate(prose_lines + junk)], "k long, line string").coalesce(1)
           .orderBy("k").select(quality.line_fails(F.col("line")).alias("rule")).collect()]
    assert got[:5] == [None] * 5 and None not in got[5:] and got[11:] == ["navigation", "navigation"]
    judged = quality.judge(frame(spark, [(k, x, "s") for k, x in enumerate(prose_lines + [junk[6]])])).collect()
    assert [r.kept for r in judged] == [True] * 5 + [False] and [r.cleaned for r in judged][:5] == prose_lines


def plain_line(line):
    w = "".join("0" if c in "123456789" else " " if c in lines.SPACED else c for c in line.lower()).split(" ")
    w = [x for x in w if x]
    return " ".join(w) if w else " ".join(split(line)[k].decode() for k in range(len(split(line))))


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_line_dedup(spark, awkward, empty):
    import xxhash

    long = prose(31, 90)
    docs = awkward.union(frame(spark, [(30, long + "\nShared line 12 here.", "s"), (31, long[:200] + "zz" + long[203:] + "\nshared LINE, 34 here", "s"),
                                       (32, "!!!\n...\n!!!", "s")]))
    got = lines.groups(docs, "doc_id").collect()
    hashes = {}

    def simhash_of(norm):
        ws = set(norm.split(" "))
        bits = sum(np.array([(xxhash.xxh64_intdigest(w, 42) >> j) & 1 for j in range(64)]) for w in ws)
        return sum(1 << j for j in range(64) if bits[j] * 2 > len(ws))

    where = {}
    for d in {(r.doc_id, r.text) for r in docs.collect()}:
        for pos, line in enumerate((d[1] or "").split("\n")):
            if split(line):
                where[(d[0], d[1], pos)] = plain_line(line)
                hashes[plain_line(line)] = simhash_of(plain_line(line))
    names = sorted(hashes)
    group = {n: n for n in names}
    for a, b in itertools.combinations(names, 2):
        if bin(hashes[a] ^ hashes[b]).count("1") <= 3 and levenshtein(a, b) <= int(0.2 * max(len(a), len(b))):
            group = {n: group[a] if g == group[b] else g for n, g in group.items()}
    assert len(got) == len(where)
    assert len({r.group for r in got}) == len(set(group.values())) < len(names)
    kept = {r.doc_id: r for r in lines.dedup(docs, "doc_id").collect()}
    assert kept[30].n_removed_lines == 0 and kept[31].n_removed_lines == 2 and kept[31].deduped == ""
    assert kept[32].n_removed_lines == 1 and kept[32].deduped == "!!!\n..." and kept[1].deduped is None
    assert lines.dedup(docs, "doc_id").count() == docs.count()
    assert lines.dedup(empty, "doc_id").count() == 0


def test_line_groups_of_near_copies(spark, monkeypatch):
    import xxhash

    r = random.Random(8)
    texts = set()
    for base in (prose(60, 16), prose(61, 16)):
        for _ in range(14):
            ws = base.split(" ")
            for _ in range(r.randint(0, 3)):
                ws[r.randrange(len(ws))] = prose(r.randint(100, 105), 1)[:-1]
            texts.add(" ".join(ws))
    docs = frame(spark, [(k, t, "s") for k, t in enumerate(sorted(texts))])
    norm = {k: plain_line(t) for k, t in enumerate(sorted(texts))}
    fps = {}
    for k, t in norm.items():
        hs = [xxhash.xxh64_intdigest(w, 42) for w in set(t.split(" "))]
        fps[k] = sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hs) > len(hs))
    low = {k: k for k in norm}
    for a, b in itertools.combinations(norm, 2):
        if bin(fps[a] ^ fps[b]).count("1") <= 8 and levenshtein(norm[a], norm[b]) <= int(0.2 * max(len(norm[a]), len(norm[b]))):
            low = {n: min(low[a], low[b]) if g in (low[a], low[b]) else g for n, g in low.items()}
    every = lines.line_fingerprints(docs, "doc_id")
    monkeypatch.setattr(lines._blocks, "__defaults__", (10,))
    got = {x.key: x.group for x in lines.groups(docs, "doc_id", distance=8).collect()}
    assert {x.key: x.fp % (1 << 64) for x in every.collect()} == fps
    assert 1 < len(set(low.values())) < len(low)
    assert len({(got[k], low[k]) for k in low}) == len(set(low.values())) == len(set(got.values()))


def near_lines():
    """Pairs of lines ``(kind, a, b)`` at edit similarity 0.8 or more: words replaced in lines of several lengths, letters in short ones."""
    r, out = random.Random(12), []
    for n, changed in ((10, 1), (8, 1), (20, 1), (20, 3), (40, 1), (40, 6), (60, 9)):
        while sum(k == (n, changed) for k, _, _ in out) < 12:
            ws = prose(r.random(), n)[:-1].split(" ")
            made = list(ws)
            for i in r.sample(range(n), changed):
                made[i] = prose(r.random(), 1)[:-1]
            out.append(((n, changed), " ".join(ws), " ".join(made)))
    for _ in range(12):
        line = prose(r.random(), 8)[:-1]
        at = r.sample([i for i, c in enumerate(line) if c != " "], 3)
        out.append(("letters", line, "".join("z" if i in at else c for i, c in enumerate(line))))
    return [(k, a, b) for k, a, b in out if levenshtein(a, b) <= int(0.2 * max(len(a), len(b)))]


def test_recall_of_line_groups(spark):
    pairs = near_lines()
    texts = sorted({x for _, a, b in pairs for x in (a, b)})
    docs = frame(spark, [(k, t, "s") for k, t in enumerate(texts)])
    at = {t: k for k, t in enumerate(texts)}
    group = {x.key: x.group for x in lines.groups_by_similarity(docs, "doc_id").collect()}
    alike = {(a, b) for a, b in itertools.combinations(texts, 2) if abs(len(a) - len(b)) <= 0.2 * max(len(a), len(b))
             and len(set(a.split()) & set(b.split())) * 3 > len(set(a.split())) and levenshtein(a, b) <= int(0.2 * max(len(a), len(b)))}
    alike |= {(min(a, b), max(a, b)) for _, a, b in pairs}
    found = Counter((k, group[at[a]] == group[at[b]]) for k, a, b in pairs)
    print({k: (found[k, True], found[k, True] + found[k, False]) for k, _ in found})
    assert sum(group[at[a]] == group[at[b]] for a, b in alike) >= 0.95 * len(alike)
    # Nothing is grouped that all pairs would not group.
    low = {t: t for t in texts}
    for a, b in alike:
        low = {t: min(low[a], low[b]) if g in (low[a], low[b]) else g for t, g in low.items()}
    assert all(low[a] == low[b] for a, b in itertools.combinations(texts, 2) if group[at[a]] == group[at[b]])
    assert sum(v for (k, same), v in found.items() if same) > 0 and lines.groups_by_similarity(docs.where("false"), "doc_id").count() == 0


def test_short_lines_are_compared_where_they_meet(spark, monkeypatch):
    """Of pairs of short lines none is named and fetched again from the documents, and groups are those of all pairs that share a band."""
    r, asked = random.Random(5), []
    made = ["".join(r.choice(["the", "an", "on", "ti", "re", "ü", " "]) for _ in range(24))[:40].strip() for _ in range(90)]
    made += [x[:9] + "z" + x[10:] for x in made[:30]] + [x[3:] + "s" for x in made[30:40]]
    texts = sorted({plain_line(x) for x in made})
    docs = frame(spark, [(k, t, "s") for k, t in enumerate(texts)] + [(1000, "word " * 30 + "one", "s"), (1001, "word " * 30 + "two", "s")])
    before = lines._verified

    def verified(docs, key, text, nodes, pairs, similarity):
        asked.append(pairs.count())
        return before(docs, key, text, nodes, pairs, similarity)

    monkeypatch.setattr(lines, "_verified", verified)
    group = {x.key: x.group for x in lines.groups_by_similarity(docs, "doc_id").collect()}
    assert len(asked) == 2 and sum(asked) <= 1 and group[1000] == group[1001]
    every, rows = lines.line_sketches(docs, "doc_id")
    numbers = {x.n: x.key for x in every.collect() if x.key < 1000}
    met = {}
    for x in rows.collect():
        met.setdefault(x.v, set()).add(numbers.get(x.n, -1))
    low = {k: k for k in range(len(texts))}
    tried = {tuple(sorted(p)) for m in met.values() for p in itertools.combinations(m - {-1}, 2)}
    for a, b in tried:
        if abs(len(texts[a]) - len(texts[b])) <= 16 and levenshtein(texts[a], texts[b]) <= int(0.2 * max(len(texts[a]), len(texts[b]))):
            low = {n: min(low[a], low[b]) if g in (low[a], low[b]) else g for n, g in low.items()}
    assert len(tried) > len(low) - len(set(low.values())) > 10
    assert len({(group[k], low[k]) for k in low}) == len(set(low.values())) == len({group[k] for k in low})


def test_counts_of_letters_rule_out_no_like_lines(spark):
    r = random.Random(6)
    pairs = []
    for _ in range(300):
        a = "".join(r.choice("etaonihs rdlüö|0zб") for _ in range(r.randint(1, 80)))
        b = list(a)
        for _ in range(r.randint(0, 20)):
            at = r.randrange(len(b) + 1)
            b[at:at + r.randint(0, 1)] = r.choice([[], ["e"], ["x"], ["б"]])
        pairs.append((a, "".join(b), levenshtein(a, "".join(b))))
    d = spark.createDataFrame(pairs, "a string, b string, most int")
    counted = d.select("most", F.struct(*lines._counts("a")).alias("p"), F.struct(*lines._counts("b")).alias("q"))
    got = counted.selectExpr("most", *[f"{lines._few_left(x, y, 'most')} AS k{x}" for x, y in ("pq", "qp")], f"{lines._few_left('p', 'q', '0')} AS same").collect()
    assert all(x.kp and x.kq for x in got) and any(not x.same for x in got)


@pytest.mark.parametrize("lane,n", [(8, 1), (8, 2), (8, 127), (16, 128), (16, 32_767), (32, 32_768)])
def test_fingerprint_lanes(spark, lane, n):
    hashes = F.expr("transform(sequence(1, n), i -> IF(n % 2 = 1, -1L, xxhash64(i)))").alias("xs")
    r = spark.range(1).select(F.lit(n).alias("n")).select(hashes).select("xs", lines._fingerprint("xs", lane).alias("fp")).first()
    want = sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in r.xs) > n)
    assert r.fp % (1 << 64) == want


def test_toxicity(spark, awkward, empty):
    rows = [(k, prose(k, 40) + (" vilestuff word." if k % 4 == 0 else " plain word."), "s") for k in range(300)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(300)] + [(7, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.classify(docs.union(awkward), labels).collect()
    assert len(got) == 300 + awkward.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id > 12]
    assert held and sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.9 * len(held)
    assert toxicity.classify(empty, labels).count() == 0
    assert {r.predicted for r in toxicity.classify(docs.limit(3), labels.where("toxic = 0")).collect()} == {0}


def test_mixing(awkward, empty, spark):
    docs = awkward.union(frame(spark, [(k, prose(k, k % 17), "abc"[k % 3]) for k in range(100, 400)]))
    plan = mixing.plan(docs).collect()
    assert len(plan) == docs.count()
    total = Counter()
    for r in docs.collect():
        total[r.source] += len(split(r.text))
    order = sorted((s for s in total if s is not None)) + [None]
    weight, target, full = {s: k % 3 + 1 for k, s in enumerate(order)}, {}, set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in full)
        open_ = [s for s in order if s not in full]
        target = {s: 3.0 * total[s] if s in full else left * weight[s] / sum(weight[x] for x in open_) for s in order}
        more = {s for s in open_ if target[s] >= 3 * total[s]}
        if not more:
            break
        full |= more
    for r in plan:
        assert r.source_size == total[r.source] and abs(r.target - target[r.source]) < 1e-6 and 0 <= r.copies <= 3
    for s in order:
        taken, most = sum(r.size * r.copies for r in plan if r.source == s), max(r.size for r in plan if r.source == s)
        assert abs(taken - target[s]) <= most
    mixed = mixing.mix(docs).collect()
    copies = Counter()
    for r in plan:
        copies[r.doc_id, r.size] += r.copies
    assert Counter((r.doc_id, len(split(r.text))) for r in mixed) == +copies
    at = [r.position for r in mixed]
    assert at == sorted(at) and all(0 <= p <= 1 for p in at)
    assert sorted(map(tuple, mixing.plan(docs.repartition(3)).collect()), key=str) == sorted(map(tuple, plan), key=str)
    assert mixing.plan(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mixing_order(awkward, empty, spark):
    docs = awkward.union(frame(spark, [(k, prose(k, k % 17), "abc"[k % 3]) for k in range(100, 400)]))
    rows = mixing.ranked(mixing.plan(docs)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.position is None) == (r["rank"] is None) == (r.copies == 0)
        if r.copies:
            # The demand of the source up to the position is the middle of the document.
            t = r.position
            assert abs(r.target * (t + r.slope * (t * t - t)) - min(r.offset + r.size / 2, r.target)) < 1e-6 * r.target
    taken = sorted((r for r in rows if r.copies), key=lambda r: r["rank"])
    assert [r["rank"] for r in taken] == list(range(len(taken)))
    assert [r.position for r in taken] == sorted(r.position for r in taken)
    first = Counter((r.doc_id, r.size, round(r.position, 9)) for r in mixing.mix(docs).where("copy = 0").withColumn("size", F.size(mixing.words(F.col("text")))).collect())
    assert first == Counter((r.doc_id, r.size, round(r.position, 9)) for r in taken)
    assert mixing.ranked(mixing.plan(empty)).count() == 0


def test_warc(spark):
    magic = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    body = "<p>" + "é" * 80
    rows = [(1, "u\r\nX: y", body), (2, None, body), (2, None, body), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
            (7, "u", magic * 3), (8, "u", "tail " + magic + "WARC/1."), (9, "u", magic * 3), (10, "u", "W" * 50_000), (0, "u", "\r\n\r\n" + "z" * 200),
            *[(k, "u", magic + str(k) * 100) for k in range(20, 60)]]
    pages = spark.createDataFrame([r + (9, "x") for r in rows], "page_id long, url string, html string, payload int, record_type string")
    for per_file in (1, 7, 8192):
        path = scratch_path(spark, "warc")
        warc.write_warc(pages, path, records_per_file=per_file)
        read = warc.read_pages(spark, path)
        got = sorted(tuple(r) for r in warc.payload_figures(read).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
        want = []
        for k, _, h in rows:
            b = (h or "").encode()
            first = min(i for i, _, x in rows if x == h)
            again = len(b) >= 100 and first != k
            want.append((k, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first if again else None))
        assert got == sorted(want, key=lambda t: (t[0], t[1])) or sorted(map(str, got)) == sorted(map(str, want))
        if per_file == 7:
            texts = {r.page_id: r.payload for r in read.where("record_type = 'response'").collect()}
            assert bytes(texts[8]).decode() == rows[8][2]
    path = scratch_path(spark, "warc")
    warc.write_warc(pages.where("false"), path)
    assert warc.read_pages(spark, path).count() == 0


def test_warc_magics_in_heads(spark):
    """A magic in the URL, one at the end of a header, and splits that cut heads anywhere."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = [(1, "http://a/x", "<p>1"), (2, "http://a/WARC/1.0/x", "<p>2"), (3, "http://a/WARC/1.", "<p>WARC/1.0\r\n3"), (4, "WARC/1." * 30, "<p>4"), (5, "http://a/WARC/1.0%0D%0AContent-Length: 3", "5")]
    path = scratch_path(spark, "warc")
    warc.write_warc(spark.createDataFrame(rows * 1, "page_id long, url string, html string").coalesce(1), path)
    try:
        for split in ("1000000", "300", "41"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            got = sorted((r.page_id, r.url, bytes(r.payload).decode()) for r in warc.read_pages(spark, path).collect())
            assert got == rows, split
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_warc_broken_chain(spark, tmp_path):
    record = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    for name, body in (("cut", record + record.replace(": 5", ": 50")), ("junk", "x" + record), ("hole", record + "x" * 20 + record)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc").write_bytes(body.encode())
        with pytest.raises(ValueError, match="behind the file" if name == "cut" else "no record follows"):
            warc.read_warc(spark, str(tmp_path / name))


def test_warc_compressed(spark, tmp_path):
    """Files that are one gzip stream, and a foreign one with a stream for each record."""
    rows = [(k, "u", "WARC/1.0\r\n" * (k % 3) + "é" * 60 + str(k % 7)) for k in range(50)]
    path = scratch_path(spark, "warc")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path, records_per_file=20, compression="gzip")
    read = warc.read_pages(spark, path)
    assert read.count() == 50 and spark.read.format("binaryFile").load(path).where("path LIKE '%.gz'").count() > 0
    plain = {r.page_id: bytes(r.payload).decode() for r in read.where("record_type = 'response'").collect()}
    assert plain and all(plain[k] == rows[k][2] for k in plain)
    want = {(k, len(h.encode()), hashlib.sha256(h.encode()).hexdigest()) for k, _, h in rows}
    for digests in (False, True):
        got = warc.payload_figures(warc.read_pages(spark, path, digests=digests)).collect()
        assert len(got) == 50 and {(r.page_id, r.payload_bytes, r.payload_digest) for r in got} == want
    record = "WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    bodies = ["hello", "", "a WARC/1.0\r\nContent-Length: 3\r\n\r\nxyz b"]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(record.format(len(b), b).encode()) for b in bodies))
    got = warc.read_warc(spark, str(tmp_path)).orderBy("start").collect()
    assert [bytes(r.block).decode() for r in got] == bodies


def test_warc_split_files(spark):
    """Splits far smaller than a record: places and segments cross their ends."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = [(k, "u", ("WARC/1.1 " if k % 3 else "<b>") * 40 + str(k)) for k in range(60)]
    path = scratch_path(spark, "warc")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        got = {r.page_id: bytes(r.payload).decode() for r in warc.read_pages(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {k: h for k, _, h in rows}


def test_vectors(spark, monkeypatch):
    for name, value in (("CELL", 20), ("HOME_BLOCK", 8), ("VISITOR_BLOCK", 11), ("TILE", 4)):
        monkeypatch.setattr(vectors, name, value)
    r = np.random.default_rng(0)
    centres = r.normal(size=(12, 8))
    data = [centres[k % 12] * (1 + k % 3) + r.normal(size=8) * 0.12 for k in range(120)]
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(data)]
    rows += [(200, None, 1), (201, [0.0] * 8, 1), (202, [1.0] * 7 + [None], 1), (203, [float("nan")] * 8, 1), (204, [float("inf")] + [1.0] * 7, 1),
             (205, rows[3][1], 1), (205, rows[3][1], 1), (206, [1.0, 2.0], 1), (207, [2.0, 4.0], 1), (208, [], 1)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")).collect()

    def unit(v):
        ok = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        return np.array(v) / np.linalg.norm(v) if ok else None

    units = [unit(v) for _, v, _ in rows]
    near = [[a != b and units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.95
             for b in range(len(rows))] for a in range(len(rows))]
    low = [k for k, _, _ in rows]
    for _ in range(len(rows)):
        low = [min([low[a]] + [low[b] for b in range(len(rows)) if near[a][b]]) for a in range(len(rows))]
    assert sorted((x.vec_id, x.n_links, x.component) for x in got) == sorted((k, sum(near[a]), low[a]) for a, (k, _, _) in enumerate(rows))
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def plain_fingerprint(text):
    import xxhash

    ws = (text or "").encode().lower().split()
    shingles = [b" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if sum(h >> j & 1 for h in hs) * 2 > len(hs)) if hs else 0


def test_simhash(spark, awkward, empty):
    docs = awkward.union(frame(spark, [(50 + k, prose(1, 60 - k % 2) + " tail" * (k % 3), "s") for k in range(12)]))
    rows = docs.collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    low = [r.doc_id if r.doc_id is not None else 1 << 40 for r in rows]
    for _ in range(len(rows)):
        low = [min(low[b] for b in range(len(rows)) if bin(fps[a] ^ fps[b]).count("1") <= 4) for a in range(len(rows))]
    got = simhash.near_duplicates(docs, "doc_id").select("doc_id", simhash.hex16(F.col("fp")).alias("f"), "component").collect()
    want = [(r.doc_id, f"{f:016x}", None if c == 1 << 40 else c) for r, f, c in zip(rows, fps, low)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    kept = simhash.keep_first(docs, "doc_id")
    assert kept.count() == len(set(low)) and kept.columns == docs.columns
    assert simhash.near_duplicates(empty, "doc_id").count() == 0 and simhash.keep_first(empty, "doc_id").count() == 0


def test_recall_of_near_copies(spark, awkward, tmp_path):
    r, texts = random.Random(4), []
    for n, changed in ((100, 1), (200, 1), (200, 4), (400, 8), (60, 1), (100, 3)):
        for _ in range(10):
            ws = prose(r.random(), n)[:-1].split(" ")
            made = list(ws)
            for i in r.sample(range(n), changed):
                made[i] = prose(r.random(), 1)[:-1] + "z"
            texts += [" ".join(ws), " ".join(made)]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split(" ") for t in texts)]
    low = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            low = [low[a] if g == low[b] else g for g in low]
    docs = frame(spark, [(k, t, "s") for k, t in enumerate(texts)]).select(*corpus_pipeline.COLUMNS)
    kept = {x.doc_id for x in corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()}
    copies = len(texts) - len(set(low))
    print(f"{len(texts) - len(kept)} of {copies} near copies removed")
    assert 40 <= copies < 60 and set(low) <= kept and len(kept) - len(set(low)) <= 0.02 * copies
    # NULL and empty texts are one group, NULL keys never win, and no row is made twice.
    got = simhash.keep_first(awkward, "doc_id", shingle=5, similarity=0.8).collect()
    assert sorted(str(x.doc_id) for x in got) == sorted(map(str, [1, 4, 4, 7, 8, 9, 10, None, 11, 12]))


@pytest.mark.parametrize("segments,distance", [(2, 4), (2, 5), (3, 4), (4, 3)])
def test_hamming_links(spark, segments, distance):
    r = random.Random(segments)
    base = [r.getrandbits(64) for _ in range(15)]
    fps = set(base) | {b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 6))) for b in base for _ in range(12)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {(x.a, x.b) for x in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), distance, segments).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= distance}


def encoding():
    import base64

    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, public_tokenizers.PATTERN, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, awkward, empty):
    path, pattern, own = encoding()
    docs = awkward.where("length(text) < 20000 OR text IS NULL").union(frame(spark, [
        (70, "a" * 600 + " <|endoftext|> it's 123  x \n\n  y", "s"), (71, "\x00\x1c\x85  \U0001f600́ ñandú 1234567", "s")]))
    rows = docs.collect()
    want = sorted((str(r.doc_id), len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
                  for r in rows for i in [own.encode_ordinary(r.text or "")])
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(docs, "doc_id", path, pattern).collect())
    assert got == want
    tokens = bpe.encode(docs, "doc_id", path, pattern)
    assert sorted(map(str, (list(r.ids) for r in tokens.collect()))) == sorted(str(own.encode_ordinary(r.text or "")) for r in rows)
    assert sorted(bytes(r.bytes) for r in bpe.decode(tokens, "doc_id", path).collect()) == sorted((r.text or "").encode() for r in rows)
    assert bpe.round_trip(empty, "doc_id", path, pattern).count() == 0


def stripped(texts, length):
    bs = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in bs for i in range(len(b) - length + 1))
    out = []
    for b in bs:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), len(bytes(gone).split(b"\0")) - bytes(gone).split(b"\0").count(b""), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group", [20_000, 2])
def test_repeats(spark, awkward, empty, group):
    r = random.Random(5)
    base = prose(40, 300)
    near = []
    for k in range(12):
        t = list(base)
        for _ in range(r.randint(0, 3)):
            t[r.randrange(len(t))] = "#"
        near.append((80 + k, "".join(t)[r.randint(0, 50):], "s"))
    docs = awkward.where("length(text) < 20000 OR text IS NULL").union(frame(spark, near + [(95, "ab" * 700, "s"), (96, "q" * 450, "s"), (97, prose(41, 60) * 2, "s")]))
    rows = docs.collect()
    got = suffixes.remove_repeats(docs, group=group).collect()
    assert sorted(map(str, ((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got))) == \
        sorted(map(str, ((x.doc_id, *w) for x, w in zip(rows, stripped([x.text for x in rows], 400)))))
    assert suffixes.remove_repeats(empty).count() == 0


def test_deep_shallow_order():
    r = random.Random(2)
    for _ in range(30):
        strings = ["".join(r.choice("ab") for _ in range(r.randint(0, 12))).encode() for _ in range(r.randint(1, 40))]
        for shallow in (0, 2, 50):
            order, common = suffixes.deep_shallow(strings, 0, shallow)
            assert [strings[k] for k in order] == sorted(strings)
            assert common[1:] == [suffixes.lcp(strings[a], strings[b]) for a, b in zip(order, order[1:])]


def test_long_text_anchors_agree_with_short_chunks(monkeypatch):
    body = prose(50, 4000).encode()
    want = [a.tolist() for a in suffixes.anchors(body)]
    monkeypatch.setattr(suffixes, "_CHUNK_BITS", 12)
    assert suffixes.anchors(body)[0].tolist() == want[0]


def test_pipeline(spark, awkward, tmp_path):
    docs = awkward.select(*corpus_pipeline.COLUMNS).union(spark.createDataFrame(
        [(100 + k, prose(1000 + k, 50), "en", "abc"[k % 3], 1) for k in range(30)], "doc_id long, text string, lang string, source string, n_chars long"))
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    step = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        step = spark.createDataFrame(stage(spark, step, str(tmp_path)).collect(), docs.schema)
        assert step.columns == docs.columns
        assert {k for k in range(100, 130)} <= {r.doc_id for r in step.collect()}, name
    ids = [r.doc_id for r in step.collect()]
    assert 5 not in ids and 1 not in ids
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    mixed = {r.doc_id for r in mixing.mix(step).collect()}
    assert {r.doc_id for r in result} == mixed
    text = {(r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in step.collect()}
    assert {(r.doc_id, r.decoded_sha256) for r in result} <= text


def test_line_dedup_keeps_only_its_groups(spark, awkward):
    """Of all tables that line dedup writes on the way only the groups are left; rows given twice change nothing."""
    import os

    from txlab import session

    folder = os.path.dirname(session.scratch_path(spark, "x"))
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    docs = awkward.select("doc_id", "text").where("length(text) < 2000 OR text IS NULL")
    once = lines.removals(docs, "doc_id", find=lines.groups_by_similarity).collect()
    assert {n.split("-")[0] for n in set(os.listdir(folder)) - before} == {"groups"}
    twice = lines.removals(docs.union(docs), "doc_id", find=lines.groups_by_similarity).collect()
    assert sorted(map(str, once)) == sorted(map(str, twice)) and any(r.removed for r in once)


def test_only_kept_steps_leave_no_shuffle_files(spark):
    """Shuffle files of the steps go when their step has ended, also if the work fails; the session's setting is put back."""
    import glob

    from txlab import session

    top = spark.conf.get("spark.local.dir", None) or spark._jvm.java.lang.System.getProperty("java.io.tmpdir")
    setting = spark.conf.get(session.SWEEP, None)

    def files():
        return set(glob.glob(f"{top}/**/blockmgr-*/*/shuffle_*.data", recursive=True))

    def work():
        step = session.freeze(spark.range(1000).repartition(3, "id"), "step")
        assert files() <= before
        return step.groupBy((F.col("id") % 7).alias("k")).count()

    before = files()
    assert sorted(map(tuple, session.freeze_only(spark, work).collect())) == sorted((k, 143 - (k == 6)) for k in range(7))
    assert files() <= before and spark.conf.get(session.SWEEP, None) == setting
    with pytest.raises(ZeroDivisionError):
        session.freeze_only(spark, lambda: 1 / 0)
    assert spark.conf.get(session.SWEEP, None) == setting


def light_lines(n):
    """Lines of the same 250 short words, each with a long word of its own, which alone is in its min-hashes."""
    light = ["".join(x) for x in itertools.islice(itertools.product("bcdfghklmnprst", "aeiou", "lmnrst"), 250)]
    return [" ".join([*light[:125], "".join(random.Random(k).choice("abcdefgh") for _ in range(9)), *light[125:]]) for k in range(n)]


def test_pipeline_links_line_fingerprints(spark, tmp_path):
    """Lines that agree in nearly all words but share no band of min-hashes are found by their fingerprints."""
    texts = light_lines(8)
    docs = frame(spark, [(k, t, "s") for k, t in enumerate(texts)] + [(20, "Another line altogether, which has no like.", "s")])
    want = {x.key: x.group for x in lines.groups(docs, "doc_id").collect()}
    got = {x.key: x.group for x in lines.groups_by_similarity(docs, "doc_id").collect()}
    assert len(set(want.values())) == 2 and got == want
    kept = corpus_pipeline.line_dedup(spark, docs.select(*corpus_pipeline.COLUMNS), str(tmp_path))
    assert {x.doc_id for x in kept.collect()} == {0, 20}
    _, rows = lines.line_sketches(docs, "doc_id")
    assert rows.where("fp IS NULL").groupBy("v").count().where("count > 1").count() == 0


def test_long_texts_are_compared_along_shared_pieces(spark):
    """The distance along shared pieces is never below the least, mostly near it, and the verdict is that of the least."""
    r, pairs = random.Random(14), []
    for k in range(120):
        ws = prose(k, r.choice((10, 30, 60, 200)))[:-1].split(" ")
        made = list(ws)
        for _ in range(r.randint(0, len(ws) // 3)):
            at = r.randrange(len(made) + 1)
            made[at:at + r.randint(0, 1)] = r.choice([[], ["ünd"], prose(r.random(), r.randint(1, 4))[:-1].split(" ")])
        pairs.append((" ".join(ws), " ".join(made)))
    pairs += [(prose(1000 + k, 40), prose(2000 + k, 40)) for k in range(10)] + [("", ""), ("a", ""), ("ab " * 60, "ab " * 60), ("ab " * 60, "ba " * 60)]
    d = spark.createDataFrame([(k, a, b, levenshtein(a, b)) for k, (a, b) in enumerate(pairs)], "k int, a string, b string, d int")
    got = d.withColumn("most", F.expr(lines._at_most("a", "b"))).collect()
    assert all(x.most >= x.d for x in got) and sum(x.most <= 1.2 * x.d + 2 for x in got) > 60
    like = {x.k for x in got if x.d <= int(0.2 * max(len(x.a), len(x.b)))}
    assert {x.k for x in lines._alike(d, "a", "b", 0.8).collect()} == like and 20 < len(like) < 110


def test_tables_taken_apart_are_not_broadcast(spark, tmp_path):
    """A table of fingerprints is small before its balls are taken apart and 66 times as long after: it must not go through the driver."""
    spark.range(300).select(F.xxhash64("id").alias("fp")).write.parquet(str(tmp_path / "nodes"))
    plan = simhash.links(spark.read.parquet(str(tmp_path / "nodes")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_pipeline_links_fingerprints(spark, tmp_path):
    """Fingerprints count repeats, sets of shingles do not: texts with one much repeated passage are close in the former only."""
    passage = " ".join(f"w{k}" for k in range(9)) + " "
    texts = [passage * 40 + prose(k, 20) for k in (1, 2)] + [prose(3, 200)]
    assert (simhash.fingerprint(texts[0]) ^ simhash.fingerprint(texts[1])).bit_count() <= simhash.DISTANCE
    docs = frame(spark, [(k, t, "s") for k, t in enumerate(texts)]).select(*corpus_pipeline.COLUMNS)
    assert {x.doc_id for x in simhash.keep_first(docs, "doc_id", shingle=5, similarity=0.8).collect()} == {0, 1, 2}
    assert {x.doc_id for x in corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()} == {0, 2}


LARGE = (1 << 53) + 1


@pytest.mark.parametrize("kind", ["long", "string"])
def test_keys_beside_null(spark, kind):
    """Large whole numbers and texts as keys come back unchanged from batches that hold a NULL key."""
    key = (lambda k: k) if kind == "long" else (lambda k: None if k is None else f"k{k}")
    docs = spark.createDataFrame([(key(k), prose(k or 0, 20)) for k in (LARGE, None, 3)], f"doc_id {kind}, text string").coalesce(1)
    want = sorted(map(str, (key(LARGE), None, key(3))))
    path, pattern, _ = encoding()
    labels = spark.createDataFrame([(key(3), 1)], f"doc_id {kind}, toxic int")
    tokens = bpe.encode(docs, "doc_id", path, pattern)
    for out in (bpe.round_trip(docs, "doc_id", path, pattern), tokens, bpe.decode(tokens, "doc_id", path), simhash.near_duplicates(docs, "doc_id"),
                simhash.similar(docs, "doc_id", "text", 5, 0.8), toxicity.classify(docs, labels)):
        assert dict(out.dtypes)["doc_id"] == ("bigint" if kind == "long" else "string")
        assert sorted(str(r.doc_id) for r in out.collect()) == want


def test_decode_of_batches_without_ids(spark):
    path, pattern, _ = encoding()
    docs = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert [bytes(r.bytes) for r in bpe.decode(bpe.encode(docs, "doc_id", path, pattern), "doc_id", path).collect()] == [b"", b""]


def test_bpe_recursive_queries():
    """Both recursive queries, by themselves and as ``learn`` picks them, against tiktoken."""
    path, pattern, own = encoding()
    r = random.Random(9)
    parts = ["".join(r.choice("etaoin shé中") for _ in range(n)).strip() or "x" for n in [1, 1, 2, 2, 3, 5, 8, 13, 40, 200] * 5] + ["aaaa" * 20, "ab" * 31]
    words = sorted({" ".join(w.split()).replace(" ", "") or "y" for w in parts}, key=len)
    encoder = bpe.Encoder(path, pattern)
    want = {k: own._core_bpe.encode_single_piece(w.encode()) for k, w in enumerate(words)}
    for query in (bpe.CONTRACT, bpe.CONTRACT_LONG):
        assert {w: list(ids) for w, ids in encoder.contract([w.encode() for w in words], query)} == want
    encoder.learn({"etaoin" * 300, *words})
    assert encoder.known["etaoin" * 300][1].decode().split() == [str(i) for i in own._core_bpe.encode_single_piece(b"etaoin" * 300)]
