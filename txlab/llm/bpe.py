"""Byte-level BPE: DuckDB contracts the words of a partition in one recursive query, tasks put texts together again."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import key_text, keyed_back

#: Distinct words that one recursive query contracts at a time: bounds the memory of a task.
WORDS_PER_QUERY = 20_000
#: Of words of so many bytes a query keeps the current round only, which costs more but bounds memory.
LONG_WORD = 1_000
#: Rank of a pair that is no token: after all others.
NEVER = (1 << 31) - 1
#: Words whose ids a Python worker remembers. It forgets all when full, which costs time and changes nothing.
REMEMBERED = 600_000

#: All pairs of tokens whose bytes together are a token again; of these, the lower id merges first.
MERGES = """
CREATE TABLE merges AS
WITH cuts AS (SELECT t.id, t.hex, unnest(range(1, length(t.hex) // 2)) AS cut FROM vocab t)
SELECT (l.id::BIGINT << 32) + r.id AS pair, c.id AS id FROM cuts c
JOIN vocab l ON l.hex = c.hex[:2 * c.cut] JOIN vocab r ON r.hex = c.hex[2 * c.cut + 1:]"""

#: One row per word and round: its tokens and the ranks of their neighbouring pairs. A round merges, in every word that
#: has a mergeable pair, the pair with the smallest rank, and of equal ones the leftmost; only the two pairs that the new
#: token makes with its neighbours are looked up. A word without a mergeable pair has come to its fixpoint: its row holds its ids.
def _contract(kept: str) -> str:
    return f"""
WITH RECURSIVE state(w, toks, ranks, best, place) {kept} (
  SELECT w, toks, ranks, list_min(ranks), list_position(ranks, list_min(ranks)) FROM words
  UNION ALL
  (WITH merged AS (
     SELECT w, best, place, ranks, toks[1:place - 1] || [best] || toks[place + 2:] AS toks, toks[place - 1] AS before, toks[place + 2] AS after
     FROM state WHERE best < {NEVER}
   ), ranked AS (
     SELECT w, toks, ranks[1:greatest(place - 2, 0)] || CASE WHEN place > 1 THEN [coalesce(l.id, {NEVER})::INT] ELSE [] END
       || CASE WHEN after IS NOT NULL THEN [coalesce(r.id, {NEVER})::INT] ELSE [] END || ranks[place + 2:] AS ranks
     FROM merged LEFT JOIN merges l ON l.pair = (before::BIGINT << 32) + best LEFT JOIN merges r ON r.pair = (best::BIGINT << 32) + after
   )
   SELECT w, toks, ranks, list_min(ranks), list_position(ranks, list_min(ranks)) FROM ranked)
) SELECT w, toks FROM state WHERE coalesce(best, {NEVER}) = {NEVER}"""


CONTRACT, CONTRACT_LONG = _contract("AS"), _contract("USING KEY (w) AS").replace("UNION ALL", "UNION")


class Encoder:
    """Ids of words by the ranks of a vocabulary file, worked out by DuckDB for many words at once."""

    def __init__(self, vocabulary: str, pattern: str):
        import duckdb
        import regex

        rows = [line.split() for line in open(vocabulary, "rb") if line.strip()]
        vocab = pd.DataFrame({"hex": [base64.b64decode(a).hex() for a, _ in rows], "id": [int(b) for _, b in rows]})
        self.tokens = {i: (str(i).encode(), bytes.fromhex(h)) for h, i in zip(vocab["hex"], vocab["id"])}
        self.find = regex.compile(pattern).findall
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        self.con.execute("SET preserve_insertion_order = false")
        self.con.execute("CREATE TABLE vocab AS SELECT hex, id::INTEGER AS id FROM vocab")
        self.con.execute(MERGES)
        first = {i: t[0] for i, (_, t) in self.tokens.items() if len(t) == 1}
        self.single = np.zeros(256, np.int32)
        self.single[list(first.values())] = list(first)
        self.pairs = np.full((256, 256), NEVER, np.int32)
        for pair, i in self.con.execute("SELECT pair, id FROM merges").fetchall():
            if pair >> 32 in first and pair & 0xFFFFFFFF in first:
                self.pairs[first[pair >> 32], first[pair & 0xFFFFFFFF]] = i
        self.known: dict[str, tuple[int, bytes, bytes]] = {}

    def learn(self, words: set[str]) -> None:
        """Make the entries of ``words`` known: number of ids, ids joined by a space, bytes decoded from the ids."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(words)
        new.sort(key=len)  # words of like length need like many rounds
        raw = [w.encode() for w in new]
        cut = next((k for k, r in enumerate(raw) if len(r) >= LONG_WORD), len(raw))
        for of, query in ((range(0, cut), CONTRACT), (range(cut, len(raw)), CONTRACT_LONG)):
            for k in range(of.start, of.stop, WORDS_PER_QUERY):
                part = raw[k:min(k + WORDS_PER_QUERY, of.stop)]
                for w, ids in self.contract(part, query):
                    found = [self.tokens[i] for i in ids]
                    self.known[new[k + w]] = len(ids), b" ".join([i for i, _ in found]), b"".join([t for _, t in found])

    def contract(self, part: list[bytes], query: str) -> Iterator[tuple[int, list[int]]]:
        """Place in ``part`` and ids of every word, by a recursive query that begins with the single bytes."""
        ends = np.cumsum([0, *map(len, part)])
        b = np.frombuffer(b"".join(part), np.uint8)
        inside = np.ones(len(b), bool)
        inside[ends[1:] - 1] = False  # the last byte of a word makes no pair
        ranks = np.append(self.pairs[b[:-1], b[1:]], np.int32(NEVER))[inside]
        words = pa.table({"w": pa.array(np.arange(len(part), dtype=np.int32)),  # noqa: F841
                          "toks": pa.ListArray.from_arrays(ends.astype(np.int32), self.single[b]),
                          "ranks": pa.ListArray.from_arrays((ends - np.arange(len(ends))).astype(np.int32), ranks)})
        self.con.execute(query)
        while rows := self.con.fetchmany(50_000):
            yield from rows


_encoder: dict[tuple[str, str], Encoder] = {}


def _encoded(vocabulary: str, pattern: str, texts: list[str]) -> Iterator[list[tuple[int, bytes, bytes]]]:
    key = vocabulary, pattern
    if key not in _encoder:
        _encoder.clear()
        _encoder[key] = Encoder(*key)
    encoder = _encoder[key]
    split, words = [], set()
    for text in texts:
        split.append(encoder.find(text))
        words.update(split[-1])
    encoder.learn(words)
    get = encoder.known.__getitem__
    for found in split:
        yield list(map(get, found))


def _portions(frames: Iterator[pd.DataFrame], text: str, chars: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """The rows of ``frames`` in portions of about so many characters, so that word lists stay small."""
    for frame in frames:
        group = frame[text].str.len().fillna(0).cumsum() // chars
        yield from (part for _, part in frame.groupby(group, sort=False))


def encode(docs: DataFrame, key: str, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """``key, ids`` (array of int): every whole text as token ids, without special tokens.

    Texts are cut by ``pattern``; each match is merged by itself. NULL and empty texts have no ids. Rows stay where
    they are (no shuffle) and repeated rows give equal rows.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in _portions(frames, "_text"):
            texts = [t if isinstance(t, str) else "" for t in f["_text"]]
            ids = [[int(i) for w in ws for i in w[1].split()] for ws in _encoded(vocabulary, pattern, texts)]
            yield pd.DataFrame({key: f[key], "ids": ids})

    return keyed_back(docs.select(key_text(key), F.col(text).alias("_text")).mapInPandas(run, f"`{key}` string, ids array<int>"), docs, key)


def decode(tokens: DataFrame, key: str, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``key, bytes`` (binary): the bytes that ids stand for, put in order by DuckDB; NULL or no ids give no bytes."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import duckdb

        vocab = pd.DataFrame([(base64.b64decode(a).hex(), int(b)) for a, b in  # noqa: F841
                              (line.split() for line in open(vocabulary, "rb") if line.strip())], columns=["hex", "id"])
        con = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        for f in frames:
            rows = pa.table({"r": pa.array(range(len(f)), pa.int64()), "ids": pa.array([[] if i is None else list(i) for i in f["_ids"]], pa.list_(pa.int32()))})  # noqa: F841
            out = con.execute("""
                WITH t AS (SELECT r, unnest(ids)::BIGINT AS id, generate_subscripts(ids, 1) AS pos FROM rows)
                SELECT r, string_agg(hex, '' ORDER BY pos) AS hex FROM t JOIN vocab USING (id) GROUP BY r""").fetchall()
            got = dict(out)
            yield pd.DataFrame({key: f[key], "bytes": [bytes.fromhex(got.get(r, "")) for r in range(len(f))]})

    return keyed_back(tokens.select(key_text(key), F.col(ids).alias("_ids")).mapInPandas(run, f"`{key}` string, bytes binary"), tokens, key)


def round_trip(docs: DataFrame, key: str, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256``: encode and decode in one pass, and digest what came out.

    ``ids_sha256`` is over the decimal ids joined by one space, ``decoded_sha256`` over the bytes that the ids of the
    words decode to, in order. Same rules as ``encode``.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in _portions(frames, "_text"):
            texts = [t if isinstance(t, str) else "" for t in f["_text"]]
            rows = []
            for ws in _encoded(vocabulary, pattern, texts):
                n, ids, decoded = zip(*ws) if ws else ((), (), ())
                rows.append((sum(n), hashlib.sha256(b" ".join(ids)).hexdigest(), hashlib.sha256(b"".join(decoded)).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"], index=f.index)
            out.insert(0, key, f[key])
            yield out

    return keyed_back(docs.select(key_text(key), F.col(text).alias("_text"))
                      .mapInPandas(run, f"`{key}` string, n_tokens bigint, ids_sha256 string, decoded_sha256 string"), docs, key)
