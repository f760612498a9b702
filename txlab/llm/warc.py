"""WARC archives: written as text by Spark's own sink, read back by a chain of record boundaries."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import freeze

#: Fixed values of the format.
MAGIC = "WARC/1."
VERSION = "0"
END = "\r\n"
BLANK = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads shorter than this are always stored.
LEAST_BYTES = 100
#: Records in an archive file, which sets the number of jumps a reader needs (its logarithm).
RECORDS_PER_FILE = 8192
DATE = "2024-01-01T00:00:00Z"


def _payload(body: str) -> Column:
    return F.coalesce(F.col(body), F.lit(""))


def plan_records(pages: DataFrame, key: str = "page_id", body: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """``pages`` with ``payload_digest``, ``record_type`` and ``refers_to``.

    Of rows with equal payloads of at least ``least`` bytes that with the smallest key is the response, and rows that
    share this key are responses too; the others revisit it. Keys are found by a combining aggregate over digests, and
    payloads are shuffled once, by the join back, which can be split where a payload is very common. The payloads that
    occur twice grow with the pages, so they are not broadcast.
    """
    digest = F.sha2(_payload(body).cast("binary"), 256)
    p = pages.withColumn("payload_digest", digest).withColumn("_long", F.octet_length(_payload(body)) >= least)
    light = pages.select(F.col(key).alias("_k"), digest.alias("_d"), F.octet_length(_payload(body)).alias("_l")).where(F.col("_l") >= least)
    first = light.groupBy("_d").agg(F.min("_k").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").hint("merge")
    again = (F.col("_first").isNotNull()) & F.col("_long") & ~F.col(key).eqNullSafe(F.col("_first"))
    return (p.join(first, F.col("payload_digest") == F.col("_d"), "left")
            .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(again, F.col("_first"))).drop("_d", "_first", "_n", "_long"))


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html",
               records_per_file: int = RECORDS_PER_FILE, compression: str = "none") -> None:
    """Write one record per row below ``path``, on any file system Spark writes to.

    A row is the record's header and block, and the separator of rows is the two line ends that close a record, so
    the text sink writes plain archives, with its commit protocol for tasks that are repeated. A response holds an
    HTTP head and the payload; a revisit names the digest and the record it refers to. NULL payloads are empty.
    ``compression="gzip"`` writes each file as one gzip stream, which is read in one task; ``records_per_file`` bounds it.
    """
    p = plan_records(pages.select(key, url, body), key, body)
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(_payload(body)).cast("string"), F.lit(BLANK))
    block = F.when(F.col("record_type") == "response", F.concat(head, _payload(body))).otherwise("")

    def line(name: str, value: Column) -> Column:
        # Control characters would end a header line; they are written as %XX like in any URL.
        safe = value.cast("string")
        for c in ("\r", "\n", "\0"):
            safe = F.replace(safe, F.lit(c), F.lit(f"%{ord(c):02X}"))
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), safe, F.lit(END))).otherwise("")

    def urn(k: Column) -> Column:
        h = F.md5(k.cast("string").cast("binary"))
        parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    record = F.concat(
        F.lit(MAGIC + VERSION + END), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", urn(F.coalesce(F.col(key).cast("string"), F.lit("")))),
        line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", F.col(url)), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("WARC-Profile", F.when(F.col("record_type") == "revisit", F.lit(PROFILE))), line("WARC-Refers-To", F.when(F.col("refers_to").isNotNull(), urn(F.col("refers_to")))),
        line("X-Page-Id", F.col(key)), line("X-Refers-To-Page-Id", F.col("refers_to")), line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("_block")), F.lit(END), F.col("_block"))
    (p.withColumn("_block", block).select(record.alias("value")).write.option("lineSep", BLANK)
     .option("maxRecordsPerFile", records_per_file).option("compression", compression).text(path))


def _header(head: Column, name: str) -> Column:
    return F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The files cut at every magic: ``file, block`` (start of the split), ``n`` (order within it), ``value``.

    Spark's line reader deals out splits of a file, whatever its size, and finds the magics that cross their ends.
    """
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("n"), "value"))


def _inside(split: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and successors of a split's candidates in order, the place of each successor among them, and if it has one."""
    split = split.sort_values("start")
    start, following = split["start"].to_numpy(), split["next"].to_numpy()
    at = np.minimum(np.searchsorted(start, following), len(start) - 1)
    held = start[at] == following
    return start, following, np.where(held, at, np.arange(len(start))), held


def _exits(split: pd.DataFrame) -> pd.DataFrame:
    """``split`` with ``exit``: the first offset on each candidate's chain that is not a candidate of this split."""
    start, following, to, _ = _inside(split)
    while not np.array_equal(to, to[to]):
        to = to[to]
    return pd.DataFrame({"file": split["file"].iloc[0], "block": split["block"].iloc[0], "start": start, "next": following, "exit": following[to]})


def _visited(split: pd.DataFrame) -> pd.DataFrame:
    """``file, start`` of the candidates on the chains from those where ``entry`` holds."""
    _, _, to, held = _inside(split)
    split = split.sort_values("start")
    on = split["entry"].to_numpy().copy()
    while held.any():
        on[to[on & held]] = True
        held, to = held & held[to], to[to]
    return split.loc[on, ["file", "start"]]


def _reachable(candidates: DataFrame) -> DataFrame:
    """``file, start`` of the records on the chain from the start of each file, by pointer jumping.

    ``candidates``: ``file, block, start, next``. Chains are first followed inside each split, whose size is bounded,
    so that only offsets that lead from split to split are left to jump. Round i of these knows the first 2^i splits
    that a chain enters; it adds what the known entries jump to and then doubles the jumps. At last each split follows
    its chains from its entries.
    """
    ways = freeze(candidates.groupBy("file", "block").applyInPandas(_exits, "file string, block long, start long, next long, exit long"), "ways")
    doors = ways.select("file", F.col("exit").alias("start")).distinct()
    jumps = freeze(ways.where("start = 0").union(ways.join(doors, ["file", "start"], "left_semi").select(ways.columns))
                   .select("file", "start", "exit").distinct(), "jumps")
    places, known = jumps.select("file", "start"), jumps.where("start = 0").select("file", "start")
    size = known.count()
    while size:
        ahead = known.join(jumps, ["file", "start"]).select("file", F.col("exit").alias("start")).join(places, ["file", "start"], "left_semi")
        grown = freeze(known.union(ahead).distinct(), "entries")
        now = grown.count()
        known = grown
        if now == size:
            break
        size = now
        a, b = jumps.alias("a"), jumps.alias("b")
        jumps = freeze(a.join(b, (F.col("a.file") == F.col("b.file")) & (F.col("a.exit") == F.col("b.start")))
                       .select("a.file", "a.start", "b.exit"), "jumps")
    entered = ways.select("file", "block", "start", "next").join(known.withColumn("_in", F.lit(True)), ["file", "start"], "left")
    entered = entered.select("file", "block", "start", "next", F.coalesce("_in", F.lit(False)).alias("entry"))
    return freeze(entered.groupBy("file", "block").applyInPandas(_visited, "file string, start long"), "chain")


def _as_text(head: Column, block: Column) -> list[Column]:
    return [head.cast("string").alias("head"), block.alias("block")]


def read_warc(spark: SparkSession, path: str, columns: Callable[[Column, Column], list[Column]] = _as_text) -> DataFrame:
    """``file, start`` and ``columns(head, block)`` (both binary) of the records of archives, plain or (``.gz``) compressed
    as a whole or record by record; offsets are those of the plain text.

    A record without magics inside is one segment: its columns are made where it is read, before anything is shuffled, so
    digests of blocks cost no shuffle of the blocks. By default they are the head as text and the block.

    Tasks list every place where a header with a length follows a magic, and where that record would end. Only the
    places that the chain from the start of a file comes to are records; magics and whole records inside a payload are
    not. A payload or a head that holds magics was cut there, and is put together from its segments. A file that does not begin
    with a record, or whose chain breaks off before its end or leads beyond it, is an error, as records would be missing or
    cut short. No files give no rows.
    """
    s = _segments(spark, path)
    head = F.substring_index("value", BLANK, 1)
    light = s.select("file", "block", "n", F.octet_length("value").cast("long").alias("bytes"), head.alias("head"), F.instr("value", BLANK).alias("_at"))
    says = F.expr(r"try_cast(regexp_extract(concat(head, if(_at > 0, '\r\n', '')), '(?i)\\r\\nContent-Length:[ \\t]*(\\d+)[ \\t]*\\r\\n', 1) AS BIGINT)")
    light = light.select("file", "block", "n", "bytes", F.col("head").rlike(r"^\d\r\n").alias("_opens"), says.alias("_says"),
                         F.when(F.col("_at") > 0, F.octet_length("head") + len(BLANK)).cast("long").alias("_blank"))
    light = freeze(light, "segments")
    cut = len(MAGIC)
    # Where a segment's magic starts: all segments and magics before it, by split and then within the split.
    blocks = light.groupBy("file", "block").agg(F.sum(F.col("bytes") + cut).alias("_sum"))
    blocks = blocks.withColumn("_before", F.sum("_sum").over(Window.partitionBy("file").orderBy("block")) - F.col("_sum"))
    inside = F.coalesce(F.sum(F.col("bytes") + cut).over(Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = freeze(light.withColumn("_in", inside).join(blocks, ["file", "block"]).withColumn("start", F.col("_before") + F.col("_in") - cut)
                    .drop("_in", "_before", "_sum"), "places")
    # A head may hold magics itself. It ends at the first blank line from its segment on, and its length is the first one
    # stated from there on: both are looked for in the split first, and then in the splits behind it.
    sees = {"_end": F.when(F.col("_blank").isNotNull(), F.col("start") + cut + F.col("_blank")), "_len": F.when(F.col("_says").isNotNull(), F.struct("start", F.col("_says").alias("v")))}
    onward = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    later = Window.partitionBy("file").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    firsts = placed.groupBy("file", "block").agg(*[F.min(v).alias(k) for k, v in sees.items()])
    firsts = firsts.select("file", "block", *[F.first(k, ignorenulls=True).over(later).alias(f"{k}_later") for k in sees])
    ahead = placed.select("*", *[F.first(v, ignorenulls=True).over(onward).alias(f"{k}_here") for k, v in sees.items()]).join(firsts, ["file", "block"])
    ahead = ahead.select("file", "block", "n", "bytes", "start", "_opens", *[F.coalesce(f"{k}_here", f"{k}_later").alias(k) for k in sees])
    known = F.col("_opens") & (F.col("start") >= 0) & (F.col("_len.start") < F.col("_end"))
    placed = freeze(ahead.select("file", "block", "n", "bytes", "start", F.when(known, F.col("_end") - F.col("start") - cut).alias("_head"),
                                 F.when(known, F.col("_len.v")).alias("_length")), "candidates")
    whole = cut + F.col("_head") + F.col("_length")
    candidates = placed.where(F.col("_length").isNotNull()).withColumn("next", F.col("start") + whole + len(BLANK))
    chain = _reachable(candidates.select("file", "block", "start", "next")).withColumn("_on", F.lit(True))
    ends = placed.groupBy("file").agg(F.max(F.col("start") + cut + F.col("bytes")).alias("_size"))
    reached = candidates.join(chain, ["file", "start"]).groupBy("file").agg(F.max("next").alias("_reached"))
    # The blank lines behind the last record may be missing, but nothing else.
    whole_file = F.coalesce("_reached", F.lit(0)).between(F.col("_size") - len(BLANK), F.col("_size") + len(BLANK))
    broken = ends.join(reached, "file", "left").where(~whole_file).select("file", "_reached", "_size").first()
    if broken and (broken["_reached"] or 0) > broken["_size"]:
        raise ValueError(f"{broken['file']}: the last record ends behind the file, at byte {broken['_reached'] - len(BLANK)}")
    if broken:
        raise ValueError(f"{broken['file']}: no record follows at byte {broken['_reached'] or 0}")

    # Every segment belongs to the last record that starts before it, within its split or an earlier one.
    marked = placed.join(chain, ["file", "start"], "left")
    own = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("_rec", F.last(F.when(F.col("_on"), F.col("start")), ignorenulls=True).over(own))
    tails = marked.groupBy("file", "block").agg(F.max("_rec").alias("_last"))
    tails = tails.withColumn("_carry", F.last("_last", ignorenulls=True).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)))
    marked = marked.join(tails, ["file", "block"]).withColumn("rec", F.coalesce("_rec", "_carry")).where("rec IS NOT NULL")
    records = candidates.join(chain, ["file", "start"]).select("file", F.col("start").alias("rec"), "_head", "_length", whole.alias("_whole"))
    need = marked.select("file", "block", "n", "start", "rec").join(records, ["file", "rec"])
    need = need.where(F.col("start") < F.col("rec") + F.col("_whole"))  # what follows the block is not part of it
    counts = need.groupBy("file", "rec").agg(F.count(F.lit(1)).alias("_n"))
    need = freeze(need.join(counts, ["file", "rec"]), "parts")

    def made(value: Column, head: Column, length: Column) -> Column:
        body = value.cast("binary")
        return F.struct(*columns(F.substring(body, F.lit(1), head.cast("int") - len(BLANK)), F.substring(body, head.cast("int") + 1, length.cast("int")))).alias("_made")

    # A record of one segment has its head, its length and its block there; what only looks like one is not in ``need``.
    own = s.select("file", "block", "n", "value", head.alias("head"), F.instr("value", BLANK).alias("_at")).where("_at > 0")
    own = own.withColumns({"_head": (F.octet_length("head") + len(BLANK)).cast("long"), "_length": says}).where("_head + _length <= octet_length(value)")
    own = own.select("file", "block", "n", made(F.col("value"), F.col("_head"), F.col("_length")))
    one = own.join(need.where("_n = 1").select("file", "block", "n", "rec"), ["file", "block", "n"]).select("file", "rec", "_made")
    # Written by themselves, so that their size is known before the join: few are broadcast, and then no text is shuffled.
    pieces = freeze(need.where("_n > 1"), "pieces")
    many = (s.join(pieces, ["file", "block", "n"]).groupBy("file", "rec", "_head", "_length")
            .agg(F.sort_array(F.collect_list(F.struct("start", "value"))).alias("_s"))
            .select("file", "rec", "_head", "_length", F.array_join(F.transform("_s", lambda x: x["value"]), MAGIC).alias("value"))
            .select("file", "rec", made(F.col("value"), F.col("_head"), F.col("_length"))))
    return one.union(many).select("file", F.col("rec").alias("start"), "_made.*")


def read_pages(spark: SparkSession, path: str, key_type: str = "bigint", digests: bool = False) -> DataFrame:
    """``page_id, url, record_type, refers_to, said_digest, payload`` (binary) of archives written by ``write_warc``.

    The payload of an HTTP block is what follows its head; that of a revisit is NULL. With ``digests`` there are
    ``payload_bytes`` and ``payload_digest`` in its place, made where the record is read.
    """
    def columns(head: Column, block: Column) -> list[Column]:
        text = head.cast("string")
        named = lambda n: F.nullif(_header(text, n), F.lit(""))
        http = _header(text, "Content-Type").startswith("application/http")
        # The head is ASCII, so that places in characters and in bytes agree up to its end.
        after = F.when(http, F.instr(block.cast("string"), BLANK) + len(BLANK)).otherwise(1)
        payload = F.when(_header(text, "WARC-Type") != "revisit", F.substring(block, after, F.octet_length(block)))
        figures = [F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest")]
        return [named("X-Page-Id").cast(key_type).alias("page_id"), named("WARC-Target-URI").alias("url"), _header(text, "WARC-Type").alias("record_type"),
                named("X-Refers-To-Page-Id").cast(key_type).alias("refers_to"),
                F.regexp_replace(_header(text, "WARC-Payload-Digest"), "^sha256:", "").alias("said_digest"), *(figures if digests else [payload.alias("payload")])]

    return read_warc(spark, path, columns).drop("file", "start")


def payload_figures(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of ``read_pages``.

    Both figures come from the payload that was read; a revisit has those of the response it refers to, which is found
    by id and digest.
    """
    if "payload" in records.columns:
        records = records.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    r = freeze(records.select("page_id", "record_type", "refers_to", "said_digest", "payload_bytes", "payload_digest"), "payloads")
    own = r.where("record_type = 'response'")
    stored = own.select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes")).distinct()
    again = r.where("record_type = 'revisit'").join(stored, (F.col("refers_to") == F.col("_id")) & (F.col("said_digest") == F.col("_digest")), "left")
    return (own.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
            .union(again.select("page_id", "_bytes", "_digest", "record_type", "refers_to")))
