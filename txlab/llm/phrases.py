"""Phrase collocations by prefix-free parsing: pieces become a dictionary of overlapping chunks, phrases are counted in it."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import freeze

#: Words of the longest phrase, and what chunks overlap by: a phrase that starts in a chunk's own part ends inside the chunk.
LONGEST = 4
OVERLAP = LONGEST - 1
LEAST = 30
SCALE = 2_000_000
#: A longer phrase stands for a shorter one if it has at least this share of its occurrences.
COVER = 80
TOP = 2000
#: One window of ``OVERLAP`` words in so many begins a new chunk, whatever stands around it.
SPARSE = 16
#: Bytes of text that are parsed or counted at a time.
PORTION = 3_000_000
#: Bits of the filter of frequent phrases, in 64-bit words: 8 MB whatever the corpus. It lets too much pass, never too little.
#: A hash has two bits in it, so that what passes wrongly stays rare while under a tenth of the bits is set.
FILTER_WORDS = 1 << 20
#: Salts among which the best phrases of a language are found before they meet, in two steps.
SALTS = (256, 16)

#: Two odd bases, each with hashes of its own.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_LOWER = bytes(10 if b in _BREAKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(kind: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2^64, as many as a portion needs."""
    if kind not in _powers or len(_powers[kind][0]) < n:
        size = max(n, PORTION + (1 << 18))
        both = []
        for base in (_BASES[kind], pow(_BASES[kind], -1, 1 << 64)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            both.append(np.cumprod(a))
        _powers[kind] = both[0], both[1]
    return _powers[kind][0][:n], _powers[kind][1][:n]


class Words:
    """The words of a byte buffer as places, and hashes of any run of them."""

    def __init__(self, raw: bytes | memoryview):
        self.b = np.frombuffer(raw, np.uint8)
        gap = (self.b == 32) | (self.b == 10)
        edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.piece = np.searchsorted(np.flatnonzero(self.b == 10), self.start)  # line ends before the word
        self.sums: dict[int, np.ndarray] = {}

    def lengths(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.end[last] - self.start[first]

    def hashes(self, first: np.ndarray, last: np.ndarray, salt: np.ndarray | int, kind: int = 0) -> np.ndarray:
        """A hash of the bytes from the start of each word ``first`` to the end of ``last``, mixed with ``salt``."""
        up, down = _power(kind, len(self.b) + 1)
        if kind not in self.sums:
            self.sums[kind] = np.concatenate(([np.uint64(0)], np.cumsum((self.b.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)))
        s = self.start[first]
        h = (self.sums[kind][self.end[last]] - self.sums[kind][s]) * down[s] + np.asarray(salt, np.uint64)
        for shift, odd in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(odd)
        return h ^ (h >> np.uint64(32))


def _tidy(text: str) -> bytes:
    """Lowered bytes with one space between words and a line end between pieces."""
    raw = text.encode().translate(_LOWER)
    while b"  " in raw:
        raw = raw.replace(b"  ", b" ")
    return raw


def _portions(raw: bytes) -> Iterator[bytes]:
    """``raw`` in parts of about ``PORTION`` bytes that end at the end of a piece."""
    at = 0
    while at < len(raw):
        stop = len(raw) if at + PORTION >= len(raw) else raw.find(b"\n", at + PORTION)
        stop = len(raw) if stop < 0 else stop
        yield raw[at:stop]
        at = stop + 1


def chunks(raw: bytes) -> Iterator[tuple[bytes, int]]:
    """``chunk, own`` of every chunk of every piece: its words joined by a space, and how many of them are its own.

    A chunk begins with its piece, and wherever the hash of the next ``OVERLAP`` words of the piece is a multiple of ``SPARSE``. It ends
    with the words that begin the next one, so equal passages give equal chunks wherever they stand, and every phrase
    of up to ``LONGEST`` words starts in the own part of exactly one chunk.
    """
    w = Words(raw)
    n = len(w.start)
    if not n:
        return
    opens = np.concatenate(([True], w.piece[1:] != w.piece[:-1]))
    i = np.arange(max(0, n - OVERLAP + 1))
    full = i[w.piece[i] == w.piece[i + OVERLAP - 1]] if len(i) else i
    trigger = full[w.hashes(full, full + OVERLAP - 1, 0) % np.uint64(SPARSE) == 0]
    opens[trigger] = True
    first = np.flatnonzero(opens)
    after = np.append(first[1:], n)  # first word of the next chunk
    same = np.append(w.piece[first[1:]] == w.piece[first[:-1]], False)
    last = np.where(same, after + OVERLAP - 1, after - 1)
    for a, z, own in zip(w.start[first].tolist(), w.end[last].tolist(), (after - first).tolist()):
        yield raw[a:z], own


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, chunk, own, times``: the distinct chunks of each language with their frequencies in the parse."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by: dict[str, list[bytes]] = {}
            for t, g in zip(b.column(0), b.column(1)):
                by.setdefault(g.as_py(), []).append(_tidy(t.as_py()))
            for g, parts in by.items():
                found: Counter = Counter()
                for raw in _portions(b"\n".join(parts)):
                    found.update(chunks(raw))
                    if len(found) > 400_000:
                        yield _rows(g, found)
                        found = Counter()
                yield _rows(g, found)

    def _rows(g: str, found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([g] * len(found), pa.string()), pa.array([c for c, _ in found], pa.binary()).cast(pa.string()),
             pa.array([o for _, o in found], pa.int32()), pa.array(list(found.values()), pa.int64())], ["lang", "chunk", "own", "times"])

    texts = docs.select(F.coalesce(text, F.lit("")).alias("t"), F.coalesce(lang, F.lit("und")).alias("g")).where("t != ''")
    return texts.mapInArrow(run, "lang string, chunk string, own int, times long").groupBy("lang", "chunk", "own").agg(F.sum("times").alias("times"))


class Block:
    """Chunks of the dictionary as words, and per word the weight of its chunk, whether it is its own, its language and its place, if given."""

    def __init__(self, parts: list[pa.RecordBatch]):
        t = pa.Table.from_batches(parts).combine_chunks()
        lang, chunk = t.column(0).combine_chunks().dictionary_encode(), t.column(1).combine_chunks()
        chunk = chunk.chunk(0) if isinstance(chunk, pa.ChunkedArray) else chunk
        ends = np.frombuffer(chunk.buffers()[1], np.int64 if pa.types.is_large_string(chunk.type) else np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
        self.w = Words(memoryview(chunk.buffers()[2])[int(ends[0]):int(ends[-1])])  # every chunk ends with a line end
        of = self.w.piece
        own, self.times = t.column(2).to_numpy()[of], t.column(3).to_numpy()[of]
        self.langs = lang.dictionary.to_pylist()
        self.lang = lang.indices.to_numpy()[of]
        self.salt = np.array([zlib.crc32(g.encode()) for g in self.langs], np.uint64)[self.lang]
        self.second = np.array([int.from_bytes(hashlib.sha256(g.encode()).digest()[:8], "big") for g in self.langs], np.uint64)[self.lang]
        self.at = t.column(4).to_numpy()[of] if t.num_columns > 4 else None
        self.mine = np.arange(len(of)) - np.searchsorted(of, np.arange(len(t)))[of] < own

    def checks(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """32 more bits of hash of runs, by another base and another salt of the language."""
        return (self.w.hashes(first, last, self.second[first], 1) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The dictionary of a task in blocks of about ``PORTION`` bytes."""
    parts, size = [], 0
    for b in batches:
        if b.num_rows:
            parts.append(b)
            size += b.column(1).nbytes
        if size >= PORTION:
            yield Block(parts)
            parts, size = [], 0
    if parts:
        yield Block(parts)


def _lines(entries: DataFrame) -> DataFrame:
    """``entries`` as blocks read them. ``at`` is the place of a chunk: a hash, which few chunks share."""
    return entries.select("lang", F.concat("chunk", F.lit("\n")).alias("chunk"), "own", "times", F.hash("lang", "chunk").alias("at"))


def _runs(b: Block, n: int) -> np.ndarray:
    """The first words of all runs of ``n`` words that start in the own part of a chunk."""
    i = np.flatnonzero(b.mine[:len(b.mine) - n + 1]) if len(b.mine) >= n else np.zeros(0, np.int64)
    return i[b.w.piece[i] == b.w.piece[i + n - 1]]


def _counted(b: Block, i: np.ndarray, n: int) -> pa.RecordBatch:
    """``h, c, n, at``: the different runs of ``n`` words among those from the words ``i`` on, by 96 bits of hash, with their weights and their least place."""
    h = b.w.hashes(i, i + n - 1, b.salt[i])
    order = np.argsort(h)
    h, i = h[order], i[order]
    c = b.checks(i, i + n - 1)
    start = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))) if len(h) else np.zeros(0, np.int64)
    total, at = (np.add.reduceat(b.times[i], start), np.minimum.reduceat(b.at[i], start)) if len(h) else (b.times[i], b.at[i])
    return pa.RecordBatch.from_arrays([pa.array(h[start].view(np.int64)), pa.array(c[start]), pa.array(total), pa.array(at)], ["h", "c", "n", "at"])


def _passes(filters: np.ndarray, h: np.ndarray) -> np.ndarray:
    return _bit(filters, h) & _bit(filters, h << np.uint64(26))


def _frequent_runs(b: Block, filters: dict[int, np.ndarray], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``n``, first words and hashes of the runs that start in the own part of a chunk and that no filter rules out.

    A phrase is no more frequent than its parts, so a run must pass by itself, and both its parts of ``n - 1`` words must. Without that the runs
    let through by chance would grow with the frequent phrases times all runs.
    """
    i = _runs(b, 1)
    for n in range(1, longest + 1):
        i = i[i + n <= len(b.mine)]
        i = i[b.w.piece[i] == b.w.piece[i + n - 1]]
        h = b.w.hashes(i, i + n - 1, b.salt[i])
        ok = _passes(filters[n], h)
        i, h = i[ok], h[ok]
        if n > 1:
            ok = _passes(filters[n - 1], b.w.hashes(i + 1, i + n - 1, b.salt[i]))
            i, h = i[ok], h[ok]
        yield n, i, h


def _field(hashes: DataFrame) -> np.ndarray:
    """The longs ``h``, by their upper 26 bits, as a bit field of fixed size."""
    bit = F.expr("shiftleft(1L, cast(shiftrightunsigned(h, 38) & 63 as int))")
    words = hashes.groupBy(F.shiftrightunsigned("h", 44).alias("at")).agg(F.bit_or(bit).alias("bits")).toPandas()  # FILTER_WORDS rows at most
    out = np.zeros(FILTER_WORDS, np.int64)
    out[words["at"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def _bit(field: np.ndarray, h: np.ndarray) -> np.ndarray:
    return (field[(h >> np.uint64(44)).astype(np.int64)] >> (h >> np.uint64(38) & np.uint64(63)) & np.uint64(1)).astype(bool)


def _frequent_hashes(entries: DataFrame, n: int, known: np.ndarray | None, least: int) -> DataFrame:
    """``h, c, n, at, size`` of the runs of ``n`` words that reach ``least``: 96 bits of hash, their count, and the place of a chunk that has one.

    Only runs whose two shorter parts pass the filter ``known`` are counted at all.
    """
    shared = entries.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in _blocks(batches):
            i = _runs(b, n)
            if known is not None:
                i = i[_passes(known, b.w.hashes(i, i + n - 2, b.salt[i]))]
                i = i[_passes(known, b.w.hashes(i + 1, i + n - 1, b.salt[i]))]
            yield _counted(b, i, n)

    counted = _lines(entries).mapInArrow(run, "h long, c int, n long, at int").groupBy("h", "c").agg(F.sum("n").alias("n"), F.min("at").alias("at"))
    return counted.where(F.col("n") >= least).withColumn("size", F.lit(n))


def frequencies(entries: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """``lang, phrase, size, f`` of every phrase of 1 to ``longest`` words with at least ``least`` occurrences.

    Length by length, runs are counted by 96 bits of hash, and what is not frequent rules out what is longer. A count carries one place of
    its phrase, so that the words are cut out there only: the rows of the last pass grow with the frequent phrases, not with the tasks that hold each.
    """
    filters: dict[int, np.ndarray] = {}
    often = []
    for n in range(1, longest + 1):
        often.append(freeze(_frequent_hashes(entries, n, filters.get(n - 1), least), "often"))
        filters[n] = _field(often[-1].select(F.explode(F.array("h", F.shiftleft("h", 26))).alias("h")))
    wanted = reduce(DataFrame.unionByName, often)
    places = _field(wanted.select(F.shiftleft(F.col("at").cast("long"), 32).alias("h")))
    shared = entries.sparkSession.sparkContext.broadcast((filters, places))  # FILTER_WORDS words a length, and as many

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_bit(shared.value[1], b.column(4).to_numpy().astype(np.uint64) << np.uint64(32))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(placed(batches)):
            raw = b.w.b.tobytes()
            for n, i, h in _frequent_runs(b, shared.value[0], longest):
                c = b.checks(i, i + n - 1)
                order = np.lexsort((b.at[i], c, h))
                i, h, c = i[order], h[order], c[order]
                at = b.at[i]
                new = np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1]) | (at[1:] != at[:-1])))[:len(h)]
                i, h, c, at = i[new], h[new], c[new], at[new]
                phrases = [raw[x:z] for x, z in zip(b.w.start[i].tolist(), b.w.end[i + n - 1].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.langs[g] for g in b.lang[i].tolist()], pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(h.view(np.int64)),
                     pa.array(c), pa.array(at), pa.array(np.full(len(i), n, np.int32))], ["lang", "phrase", "h", "c", "at", "size"])

    found = _lines(entries).mapInArrow(run, "lang string, phrase string, h long, c int, at int, size int")
    # Chunks that share a place may give a phrase twice.
    return found.join(wanted, ["h", "c", "at", "size"]).groupBy("lang", "phrase", "size").agg(F.max("n").alias("f"))


def _part(first, count):
    """So many words of ``phrase`` from the given one on (counted from 1)."""
    return F.array_join(F.slice("_w", first, count), " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of 2 to 4 words of each language.

    Texts are lowered (A-Z), cut into pieces at punctuation and line ends and into words at spaces and tabs. A phrase needs ``least``
    occurrences ``a``; of all cuts in two, that with the lowest score, 2,000,000 * a / (l + r) rounded down, counts, ``l`` and ``r`` being
    the occurrences of its parts. A phrase that a longer frequent one holds as words in a row goes if that has ``cover`` percent
    of its occurrences. ``n`` is the number of words of the language. Ties in score go to the larger ``a``, then to the phrase first in byte order.

    NULL and empty texts have no words; a NULL language is ``und``; repeated rows count as often as they occur; very long texts are worked
    through piece by piece, and one piece alone must fit a task. No documents, or none with frequent phrases, give no rows. Other columns are
    ignored. The number of occurrences fits 64 bits; products are worked out in decimals.
    """
    entries = freeze(dictionary(docs, text, lang), "dictionary")
    totals = entries.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n"))  # one row a language
    f = freeze(frequencies(entries, least), "frequencies")
    candidates = f.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("_w"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("_head", _part(F.lit(1), F.col("k"))).withColumn("_tail", _part(F.col("k") + 1, F.col("size") - F.col("k")))
    head = f.select(F.col("lang").alias("_g1"), F.col("phrase").alias("_head"), F.col("f").alias("l"))
    tail = f.select(F.col("lang").alias("_g2"), F.col("phrase").alias("_tail"), F.col("f").alias("r"))
    cuts = cuts.join(head, (F.col("lang") == F.col("_g1")) & (cuts["_head"] == head["_head"])).join(tail, (F.col("lang") == F.col("_g2")) & (cuts["_tail"] == tail["_tail"]))
    score = F.expr(f"(cast(a AS decimal(28,0)) * {SCALE}BD) DIV (cast(l AS decimal(28,0)) + cast(r AS decimal(28,0)))")
    scored = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_c"))
              .select("lang", "phrase", "a", "_c.l", "_c.r", "_c.score"))
    inner = candidates.where("size > 2").select(
        F.col("lang").alias("_g"), F.col("a").alias("_f"), F.col("_w"), F.col("size"), F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("_m"))
    inner = inner.select("_g", "_f", "_w", "_m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("_m") + 1)).alias("_i"))
    held = inner.select("_g", _part(F.col("_i"), F.col("_m")).alias("_p"), "_f").groupBy("_g", "_p").agg(F.max("_f").alias("_f"))
    kept = scored.join(held, (F.col("lang") == F.col("_g")) & (F.col("phrase") == F.col("_p")), "left")
    big = lambda c, n: F.col(c).cast("decimal(28,0)") * F.lit(n).cast("decimal(4,0)")
    best = kept.where(F.col("_f").isNull() | (big("_f", 100) < big("a", cover))).select("lang", "phrase", "a", "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for salt in SALTS:  # so that the last step sees a bounded number of rows a language
        part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salt))).orderBy(*order)
        best = best.withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= top).drop("_r")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
