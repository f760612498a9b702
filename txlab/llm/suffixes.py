"""Repeated passages: suffixes at anchors, sorted deep-shallow, give the bytes covered by strings that occur twice."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import freeze

#: A byte goes if a string of so many bytes that covers it starts anywhere else too.
LENGTH = 400
#: Anchors are chosen by the hash of so many bytes.
GRAM = 64
#: Bytes that multikey quicksort looks at beyond those known to be equal; what still agrees goes to a blind trie.
SHALLOW = 32
#: Different contexts of one gram that a task sorts together; more are compared by hashes of all their windows.
GROUP = 20_000

_CHUNK_BITS = 20


# --- Anchors -------------------------------------------------------------------------------------------------------

def anchors(body: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes of a text's anchors.

    In every window of ``length`` bytes the gram with the smallest hash is one, and of equal ones the last. Which it is
    depends on the window alone, so two equal windows have an anchor at the same place in them. ``gram`` is a power of 2.
    """
    spots, keys = [], []
    width = length - gram + 1
    step = (1 << _CHUNK_BITS) - length
    for start in range(0, max(1, len(body) - length + 1), step):
        b = np.frombuffer(body, dtype=np.uint8)[start:start + step + length - 1]
        if len(b) < length:
            break
        h, factor, s = b.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
        while s < gram:
            h = h[:-s] * np.uint64(factor) + h[s:]
            factor, s = factor * factor % (1 << 64), s * 2
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        low = np.uint64((1 << _CHUNK_BITS) - 1)
        m = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
        s = 1
        while 2 * s <= width:
            m = np.minimum(m[:-s], m[s:])
            s *= 2
        if s < width:
            m = np.minimum(m[:s - width], m[width - s:])
        m = m[np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))]
        at = np.unique(low - (m & low)).astype(np.int64)
        spots.append(at + start)
        keys.append(h[at].view(np.int64))
    if not spots:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spot, first = np.unique(np.concatenate(spots), return_index=True)
    return spot, np.concatenate(keys)[first]


# --- Sorting -------------------------------------------------------------------------------------------------------

def lcp(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that agree in ``known`` bytes."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while low + 1 < high:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


def _byte(s: bytes, d: int) -> int:
    return s[d] if d < len(s) else -1


def blind_trie(strings: list[bytes], members: list[int], depth: int) -> tuple[list[int], list[int]]:
    """``members`` in order of their strings, and the common prefix of each with its predecessor (the first: 0).

    All agree in ``depth`` bytes. A node holds only the depth at which its strings part and a branch per byte there. A
    new string goes down blindly to some leaf, is compared once with that leaf's string, and is hung in at the depth
    where they part.
    """
    root: list = [None, None, [members[0]]]  # depth, branches, or members of a leaf
    for m in members[1:]:
        s, node = strings[m], root
        while node[2] is None:
            node = node[1].get(_byte(s, node[0])) or next(iter(node[1].values()))
        other = strings[node[2][0]]
        d = lcp(s, other, depth)
        if d == len(s) == len(other):
            node[2].append(m)
            continue
        node = root
        while node[2] is None and node[0] < d:
            node = node[1][_byte(s, node[0])]
        if node[2] is None and node[0] == d:
            node[1][_byte(s, d)] = [None, None, [m]]
        else:
            below = list(node)
            node[:] = [d, {_byte(other, d): below, _byte(s, d): [None, None, [m]]}, None]
    order: list[int] = []
    common: list[int] = []
    stack = [(root, 0)]
    while stack:
        node, d = stack.pop()
        if node[2] is not None:
            whole = len(strings[node[2][0]])
            order += node[2]
            common += [d] + [whole] * (len(node[2]) - 1)
        else:
            branches = sorted(node[1].items())
            for k in range(len(branches) - 1, -1, -1):
                stack.append((branches[k][1], node[0] if k else d))
    return order, common


def deep_shallow(strings: list[bytes], known: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Order of the strings, and the common prefix of each with its predecessor (the first: 0).

    Multikey quicksort parts them by one byte after the other, from ``known`` on, for ``shallow`` bytes; groups that still
    agree then are ordered by a blind trie.
    """
    order: list[int] = []
    common: list[int] = []
    stack = [(list(range(len(strings))), known, 0)]
    while stack:
        group, d, before = stack.pop()
        if len(group) == 1 or d >= known + shallow:
            o, c = blind_trie(strings, group, d)
            order += o
            common += [before] + c[1:]
            continue
        pivot = _byte(strings[group[len(group) // 2]], d)
        less = [m for m in group if _byte(strings[m], d) < pivot]
        same = [m for m in group if _byte(strings[m], d) == pivot]
        more = [m for m in group if _byte(strings[m], d) > pivot]
        if pivot < 0:  # strings that end here are equal
            parts = [(less, d), (same, known + shallow), (more, d)]
        else:
            parts = [(less, d), (same, d + 1), (more, d)]
        parts = [p for p in parts if p[0]]
        for k in range(len(parts) - 1, -1, -1):
            stack.append((*parts[k], d if k else before))
    return order, common


def reach(left: list[bytes], right: list[bytes], length: int = LENGTH, gram: int = GRAM) -> list[tuple[int, int]]:
    """For suffixes that begin with one gram: how far before and after its start each is covered; (0, 0) if not.

    ``left``: the bytes before, backwards; ``right``: the bytes from the gram on. A window that starts l bytes before the
    gram occurs twice if two suffixes agree in l bytes to the left and ``length - l`` to the right. Which suffixes agree
    follows from the sorted orders of both sides, and changes only at the common prefixes of neighbours.
    """
    n = len(left)
    most = length - gram
    if n == 2:
        a, b = lcp(left[0], left[1]), lcp(right[0], right[1])
        a, b = min(a, most), min(b, length)
        return [(a, b)] * 2 if a + b >= length else [(0, 0)] * 2
    ways = []
    for strings, known in ((left, 0), (right, gram)):
        order, common = deep_shallow(strings, known)
        ways.append((np.array(order), np.array(common)))
    (lo, lc), (ro, rc) = ways
    cuts = {0} | {int(v) + 1 for v in lc[1:]} | {length - int(v) for v in rc[1:]}
    cuts = sorted(c for c in cuts if 0 <= c <= most)
    low, high = np.full(n, length, np.int64), np.full(n, -1, np.int64)
    a, b = np.empty(n, np.int64), np.empty(n, np.int64)
    for k, l in enumerate(cuts):
        a[lo] = np.cumsum(np.concatenate([[0], lc[1:] < l]))
        b[ro] = np.cumsum(np.concatenate([[0], rc[1:] < length - l]))
        _, which, times = np.unique(a * n + b, return_inverse=True, return_counts=True)
        twice = times[which] > 1
        # A side too short for the window agrees with none: its common prefixes are shorter too.
        last = cuts[k + 1] - 1 if k + 1 < len(cuts) else most
        low[twice] = np.minimum(low[twice], l)
        high[twice] = np.maximum(high[twice], last)
    return [(int(h), length - int(l)) if h >= 0 else (0, 0) for l, h in zip(low, high)]


# --- Spark ---------------------------------------------------------------------------------------------------------

def _bytes(text) -> bytes:
    return text.encode() if isinstance(text, str) else b""


def _sorted_groups(frames: Iterator[pd.DataFrame], by: str) -> Iterator[pd.DataFrame]:
    """Groups of rows with one value, from frames sorted by it; a group may go on in the next frame."""
    held: list[pd.DataFrame] = []
    for f in frames:
        if not len(f):
            continue
        v = f[by].to_numpy()
        cuts = [0, *(np.flatnonzero(v[1:] != v[:-1]) + 1), len(f)]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[0][by].iloc[0] != v[a]:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(f.iloc[a:b])
    if held:
        yield pd.concat(held)


def _reaches(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """``k, c, before, after`` from ``k, c, left, right`` where no ``k`` has more rows than a task may hold."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for g in _sorted_groups(frames, "k"):
            if len(g) > 1:
                spans = reach(g["left"].tolist(), g["right"].tolist(), length, gram)
                out += [(k, c, a, b) for k, c, (a, b) in zip(g["k"], g["c"], spans) if b]
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=["k", "c", "before", "after"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["k", "c", "before", "after"])

    return contexts.repartition("k").sortWithinPartitions("k").mapInPandas(run, "k bigint, c string, before bigint, after bigint")


def _reaches_by_hash(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """The same for grams of any frequency: every window is a row, and those that occur twice are found by their digest.

    Some hundred rows a context, but combining counts over them, and no group is gathered.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for f in frames:
            for k, c, left, right in f[["k", "c", "left", "right"]].itertuples(index=False):
                s, at = left[::-1] + right, len(left)
                rows += [(k, c, l, hashlib.blake2b(s[at - l:at - l + length], digest_size=16).digest())
                         for l in range(max(0, length - len(right)), min(at, length - gram) + 1)]
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=["k", "c", "l", "w"])
                    rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["k", "c", "l", "w"])

    w = freeze(contexts.mapInPandas(run, "k bigint, c string, l int, w binary"), "windows")
    twice = w.groupBy("k", "l", "w").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("k", "l", "w")
    both = w.join(twice, ["k", "l", "w"]).groupBy("k", "c").agg(F.min("l").alias("low"), F.max("l").alias("high"))
    return both.select("k", "c", F.col("high").cast("long").alias("before"), (length - F.col("low")).cast("long").alias("after"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   group: int = GROUP) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept`` (binary; NULL where nothing was removed) and ``kept_sha256``, per row.

    Every byte covered by a string of ``length`` bytes that also starts anywhere else, in this document or another, is
    removed; ``n_spans`` counts the maximal removed runs. NULL texts are empty. Rows with equal texts are one text that
    occurs several times: from ``length`` bytes on all of it goes. An empty table gives no rows.

    Every window of that length holds an anchor whose choice depends on the window alone, about one in ``length / 2``
    bytes. Anchors are counted by the hash of their gram and those met once are dropped; only around the others are
    suffixes cut from the texts, sorted, and compared as far as a window that holds the anchor can reach. A gram with
    more than ``group`` different contexts goes by hashes of its windows, which has the same result.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    named = docs.select(F.col(key).alias("key"), body.alias("text"), F.xxhash64(body).alias("t1"),
                        (F.crc32(body.cast("binary")) * (1 << 20) + F.octet_length(body) % (1 << 20)).alias("t2"))
    light = freeze(named.select("key", "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "light")

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = [anchors(_bytes(t), length, gram) for t in f["text"]]
            n = [len(p) for p, _ in found]
            if not sum(n):
                continue
            yield pd.DataFrame({"t1": np.repeat(f["t1"].to_numpy(), n), "t2": np.repeat(f["t2"].to_numpy(), n),
                                "pos": np.concatenate([p for p, _ in found]), "k": np.concatenate([k for _, k in found])})

    every = freeze(named.where(F.octet_length("text") >= length).select("t1", "t2", "text").mapInPandas(find, "t1 bigint, t2 bigint, pos bigint, k bigint"), "anchors")
    m = F.xxhash64("t1", "t2", "pos")
    again = every.groupBy("k").agg(F.min(m).alias("a"), F.max(m).alias("b")).where("a <> b").select("k")
    alive = freeze(every.join(again, "k").select("k", "t1", "t2", "pos").distinct(), "alive")
    places = alive.groupBy("t1", "t2").agg(F.collect_list(F.struct("k", "pos")).alias("places"))
    texts = freeze(named.where(F.octet_length("text") >= length).select("t1", "t2", "text").dropDuplicates(["t1", "t2"]).join(places, ["t1", "t2"]), "texts")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows: list[tuple] = []
            for t1, t2, t, ps in zip(f["t1"], f["t2"], f["text"], f["places"]):
                b = _bytes(t)
                for p in ps:
                    at = p["pos"]
                    rows.append((p["k"], t1, t2, at, b[max(0, at - length + gram):at][::-1], b[at:at + length]))
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=["k", "t1", "t2", "pos", "left", "right"])
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["k", "t1", "t2", "pos", "left", "right"])

    cut_out = texts.mapInPandas(cut, "k bigint, t1 bigint, t2 bigint, pos bigint, left binary, right binary")
    named_context = cut_out.withColumn("c", F.concat(F.md5("left"), F.md5("right")))
    # Suffixes that agree as far as a window can reach are one context: it is sorted once, however often it occurs.
    seen = freeze(named_context.select("k", "c", "t1", "t2", "pos", F.octet_length("left").alias("ll"), F.octet_length("right").alias("rl")), "seen")
    sizes = freeze(seen.groupBy("k", "c").agg(F.count(F.lit(1)).alias("times"), F.max("ll").alias("ll"), F.max("rl").alias("rl")), "contexts")
    per_gram = sizes.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    contexts = named_context.select("k", "c", "left", "right").dropDuplicates(["k", "c"]).join(per_gram.where("n > 1"), "k")
    found = _reaches(contexts.where(F.col("n") <= group), length, gram)
    if per_gram.where(F.col("n") > group).limit(1).count():
        found = found.union(_reaches_by_hash(contexts.where(F.col("n") > group), length, gram))
    whole = sizes.where((F.col("times") > 1) & (F.col("ll") + F.col("rl") >= length)).select("k", "c", F.col("ll").cast("long").alias("before"), F.col("rl").cast("long").alias("after"))
    covers = found.union(whole).groupBy("k", "c").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    spans = seen.join(covers, ["k", "c"]).select("t1", "t2", (F.col("pos") - F.col("before")).alias("start"), (F.col("pos") + F.col("after")).alias("stop"))
    spans = spans.groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def strip(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for t1, t2, t, ss in zip(f["t1"], f["t2"], f["text"], f["spans"]):
                b, kept, at, runs, gone = _bytes(t), [], 0, 0, 0
                for a, z in sorted((s["start"], s["stop"]) for s in ss):
                    if a > at or not runs:
                        kept.append(b[at:a])
                        runs, gone = runs + 1, gone + z - a
                        at = z
                    elif z > at:
                        gone += z - at
                        at = z
                kept.append(b[at:])
                whole = b"".join(kept)
                rows.append((t1, t2, gone, runs, whole, hashlib.sha256(whole).hexdigest()))
            yield pd.DataFrame(rows, columns=["t1", "t2", "n_removed", "n_spans", "kept", "kept_sha256"])

    done = texts.select("t1", "t2", "text").join(spans, ["t1", "t2"]).mapInPandas(strip, "t1 bigint, t2 bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string")
    copies = light.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("copies"))
    out = light.join(copies, ["t1", "t2"]).join(done, ["t1", "t2"], "left")
    all_ = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("key").alias(key), "n_bytes", F.when(all_, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(all_, zero + 1).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"), F.when(all_, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"),
        F.when(all_, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))
