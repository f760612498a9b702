"""The operators bound to the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import pin, scratch_path
from . import bpe, lines, mixing, neighbour_graph, phrases, quality, resampling, sharding, simhash, suffixes, toxicity, vectors, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.tiktoken"
SHARDS = 40


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = lambda spark, folder: build(pin(spark), folder)
        if sql is not None:
            ORACLE[name] = sql
        return build
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_sharding")
def op1(spark, folder):
    s = sharding.shard(table(spark, folder, "documents"), SHARDS)
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op2_quality_rules")
def op2(spark, folder):
    return quality.judge(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines",
        "n_removed_lines", "n_line_chars", "n_lost_chars")


@query("op3_line_dedup")
def op3(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    r = lines.removals(docs, "doc_id", find=lines.groups_by_similarity)
    return (docs.select("doc_id", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("u")).join(r, "u", "left")
            .select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), "removed"))


@query("op4_toxicity")
def op4(spark, folder):
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op5_mixing")
def op5(spark, folder):
    p = mixing.ranked(mixing.plan(table(spark, folder, "documents")))
    return p.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies", "position", "rank")


@query("op6_warc", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
q AS (SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM q WHERE n >= 100 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, q.digest AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM q LEFT JOIN f ON q.digest = f.digest AND n >= 100""")
def op6(spark, folder):
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, folder, "pages"), path, compression="gzip")
    return warc.payload_figures(warc.read_pages(spark, path, digests=True))


@query("op7_embedding_near_dedup", """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, row_number() OVER (ORDER BY vec_id) AS r FROM embeddings
), good AS (
  SELECT * FROM v WHERE e IS NOT NULL AND list_count(e) = len(e) AND len(list_filter(e, lambda x: isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.r <> b.r AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT DISTINCT a AS node, a AS seen FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen
), named AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node), counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM v LEFT JOIN named ON node = vec_id LEFT JOIN counted ON a = vec_id""")
def op7(spark, folder):
    d = vectors.near_duplicates(table(spark, folder, "embeddings"))
    return d.select("vec_id", "n_links", F.col("component").alias("component_id"), (F.col("vec_id") == F.col("component")).alias("kept"))


@query("op8_simhash_near_dedup")
def op8(spark, folder):
    d = simhash.near_duplicates(table(spark, folder, "documents"), "doc_id")
    return d.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


@query("op9_bpe")
def op9(spark, folder):
    import public_tokenizers

    return bpe.round_trip(table(spark, folder, "documents"), "doc_id", public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@query("op10_suffix_array_dedup")
def op10(spark, folder):
    found = suffixes.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") == 0).alias("kept"))


@query("op11_nearest_neighbours")
def op11(spark, folder):
    return neighbour_graph.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op12_importance_resampling", """
WITH RECURSIVE bits AS (SELECT range::BIGINT AS b, range::BIGINT AS v, 0 AS step FROM range(256)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE step = 8),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
dw AS (SELECT r, unnest(ws) AS w FROM d),
bw AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
words AS (SELECT DISTINCT w, lower(hex(encode(w))) AS h FROM (SELECT w FROM dw UNION ALL SELECT w FROM bw)),
bucket AS (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)),
  lambda a, x: xor(t[(xor(a, x) & 255) + 1], a >> 8)), 4294967295) % 10000 AS b FROM words, crc),
s AS (SELECT b, count(*)::DOUBLE AS s FROM dw JOIN bucket USING (w) GROUP BY b), t AS (SELECT b, count(*)::DOUBLE AS t FROM bw JOIN bucket USING (w) GROUP BY b),
gain AS (SELECT b, floor(1000e0 * ln((coalesce(t, 0e0) + 1e0) * ((SELECT coalesce(sum(s), 0e0) FROM s) + 10000e0) / ((coalesce(s, 0e0) + 1e0) * ((SELECT coalesce(sum(t), 0e0) FROM t) + 10000e0))))::BIGINT AS g
  FROM (SELECT DISTINCT b FROM bucket) LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
weights AS (SELECT r, sum(g)::BIGINT AS weight FROM dw JOIN bucket USING (w) JOIN gain USING (b) GROUP BY r),
scored AS (SELECT doc_id, r, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
  + floor(-1000e0 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5e0) / 4294967296e0)))::BIGINT AS score FROM d LEFT JOIN weights USING (r)),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS total FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * total // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (r)""")
def op12(spark, folder):
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_collocations", """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws, count(*)::HUGEINT AS times FROM pieces GROUP BY 1, 2),
runs AS (SELECT lang, ws, times, unnest([1, 2, 3, 4]) AS m FROM p),
spots AS (SELECT lang, ws, times, m, unnest(range(1, len(ws) - m + 2)) AS i FROM runs),
f AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, m, sum(times) AS f FROM spots GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 30),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM c),
valued AS (SELECT c.lang, c.phrase, c.a, k, h.f AS l, t.f AS r, (2000000::HUGEINT * c.a) // (h.f + t.f) AS score FROM cuts c
  JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(c.ws[1:k], ' ') JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(c.ws[k + 1:], ' ')),
worst AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
sizes AS (SELECT lang, ws, a, m, unnest(range(2, m)) AS s FROM c),
inner_ AS (SELECT lang, ws, a, s, unnest(range(1, m - s + 2)) AS i FROM sizes),
held AS (SELECT lang, array_to_string(ws[i:i + s - 1], ' ') AS phrase, max(a) AS longer FROM inner_ GROUP BY 1, 2),
best AS (SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, encode(w.phrase)) AS rank
  FROM worst w LEFT JOIN held USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM best JOIN n USING (lang) WHERE rank <= 2000""")
def op13(spark, folder):
    return phrases.collocations(table(spark, folder, "documents"))
