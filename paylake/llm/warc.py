"""WARC archives: written from page rows, read back by boundary-chain verification.

Writing: the rows of the lowest page id of a payload are responses, later copies are revisits that name it. Reading: a task
sees only that some bytes look like the start of a record, and a payload may hold such bytes. So every candidate is taken
as an edge from its offset to the offset its declared length points to, pointers jump from the start of the file, and only
candidates that are reached are records; the text behind the others belongs to the record they lie in.
"""

from __future__ import annotations

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from paylake.llm.common import small_batches, staged, table
from paylake.session import scratch_folder

MAGIC = "WARC/1.0\r\n"
#: Payloads of fewer bytes are always written whole.
SMALLEST_REVISIT = 100
#: Bounds an archive, and so what the order of one file's offsets costs.
RECORDS_PER_FILE = 50_000
#: Names of files and places of records are sent to all tasks up to this many bytes, and merged beyond.
BROADCAST_BYTES = 16 << 20
#: Bytes of pages that texts are compressed against on their way.
SHARED_BYTES = 64 << 10
DATE = "2024-01-01T00:00:00Z"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _one_line(text: Column) -> Column:
    """Line ends would end the header early; they are percent-encoded, and nothing else is."""
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _shared(pages: DataFrame) -> bytes:
    """The beginnings of a few pages, for texts to be compressed against; which pages decides sizes only, never results."""
    some = pages.select(F.left(F.coalesce("html", F.lit("")), F.lit(4096)).alias("html")).limit(64).collect()
    return "".join(r.html for r in some).encode()[:SHARED_BYTES]


def _dictionary(shared: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(shared, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(shared) >= 1024 else None


def _squeezed(texts: Column, shared: bytes) -> Column:
    @F.pandas_udf(BinaryType())
    def squeezed(texts: pd.Series) -> pd.Series:
        if known := _dictionary(shared):
            known.precompute_compress(level=9)
        pack = zstandard.ZstdCompressor(level=9, dict_data=known)
        return texts.map(lambda t: pack.compress(t.encode()))

    return squeezed(texts)


def _restored(packed: Column, shared: bytes) -> Column:
    @F.pandas_udf(StringType())
    def restored(packed: pd.Series) -> pd.Series:
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(shared))
        return packed.map(lambda b: unpack.decompress(b).decode())

    return restored(packed)


def mark_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) with `_digest` as bytes, `_bytes` and `_original`, the page whose payload a revisit repeats.

    Null html is an empty payload. Rows of one page_id with one payload are alike; a row without an id is a response. Texts
    travel once, to where their digest's first page is known, and compressed against what pages share, as that shuffle holds all
    payloads.
    """
    html = F.coalesce("html", F.lit(""))
    known = pages.withColumns({"_digest": F.unhex(F.sha2(html.cast("binary"), 256)), "_bytes": F.octet_length(html).cast("long")})
    first = (
        known.filter(f"_bytes >= {SMALLEST_REVISIT}").groupBy(F.col("_digest").alias("_d"))
        .agg(F.min("page_id").alias("_first"), F.max("page_id").alias("_last")).filter("_first < _last").drop("_last")
    )
    # Only payloads with a copy are matched; the join is split where one payload has many copies. Their number grows with
    # the pages, so they are merged and never broadcast.
    shared = _shared(pages)
    known = known.withColumn("html", _squeezed(html, shared))
    joined = known.join(first.hint("merge"), F.col("_digest") == F.col("_d"), "left").drop("_d").withColumn("html", _restored(F.col("html"), shared))
    return joined.withColumn("_original", F.when(F.col("page_id") > F.col("_first"), F.col("_first"))).drop("_first")


def write_warc(pages: DataFrame, path: str) -> None:
    """Write pages (page_id, url, html) as WARC files. Other columns are not written. An empty table gives no record."""
    rows = mark_revisits(pages.select("page_id", "url", "html"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("_bytes").cast("string"), F.lit("\r\n\r\n")
    )
    block = F.when(F.col("_original").isNotNull(), http).otherwise(F.concat(http, F.coalesce("html", F.lit(""))))
    rows = rows.withColumn("_block", block)
    header = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(F.col("_original").isNotNull(), F.lit("revisit")).otherwise(F.lit("response"))),
        F.coalesce(_line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))), F.lit("")),
        _line("WARC-Date", F.lit(DATE)),
        F.coalesce(_line("WARC-Target-URI", _one_line(F.col("url"))), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.lower(F.hex("_digest")))),
        F.coalesce(
            F.concat(
                _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("_original").cast("string"), F.lit(">"))),
            ),
            F.lit(""),
        ),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length("_block").cast("string")),
        F.lit("\r\n"),
    )
    # The writer ends each row with the last byte of the record's closing empty lines.
    record = F.concat(header, F.col("_block"), F.lit("\r\n\r")).alias("value")
    rows.select(record).write.option("lineSep", "\n").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _field(name: str) -> Column:
    return F.regexp_extract(F.col("_header"), f"(?i)(?:^|\r\n){name}: *([^\r\n]*)", 1)


def _parsed(pieces: DataFrame) -> DataFrame:
    """Header fields, the payload's digest and size, and where the declared lengths say the record ends.

    pieces: (file, at, value), value being the text behind the magic at byte `at`.
    """
    found = pieces.withColumn("_split", F.instr("value", "\r\n\r\n"))
    found = found.withColumn("_header", F.when(F.col("_split") > 0, F.substring("value", F.lit(1), F.col("_split") - 1)))
    length = F.when(F.length(_field("Content-Length")).between(1, 18), F.expr("try_cast(regexp_extract(_header, '(?i)(?:^|\r\n)Content-Length: *([0-9]+) *(?:\r\n|$)', 1) AS BIGINT)"))
    found = found.withColumn("_head_bytes", F.octet_length("_header") + 4).withColumn("_block_bytes", length)
    end = F.col("at") + len(MAGIC) + F.col("_head_bytes") + F.col("_block_bytes") + 4
    rest = F.expr("substring(value, _split + 4)")
    found = found.withColumn("_whole", F.coalesce(F.octet_length("value") == F.col("_head_bytes") + F.col("_block_bytes") + 4, F.lit(False)))
    found = found.withColumn("_block", F.when(F.col("_whole"), F.expr("left(substring(value, _split + 4), length(value) - _split - 7)")).otherwise(rest))
    body = F.expr("substring(_block, instr(_block, '\r\n\r\n') + 4)")
    kind = _field("WARC-Type")
    declared = F.expr("try_cast(regexp_extract(substring_index(_block, '\r\n\r\n', 1), '(?i)\r\nContent-Length: *([0-9]+)', 1) AS BIGINT)")
    return found.select(
        "file", "at", end.alias("next"), F.col("_whole").alias("whole"), kind.alias("record_type"), _field("WARC-Target-URI").alias("url"),
        F.expr(r"try_cast(regexp_extract(_header, '(?i)\r\nWARC-Record-ID: *<urn:page:(-?[0-9]+)>', 1) AS BIGINT)").alias("page_id"),
        F.expr(r"try_cast(regexp_extract(_header, '(?i)\r\nWARC-Refers-To: *<urn:page:(-?[0-9]+)>', 1) AS BIGINT)").alias("refers_to"),
        F.when(kind == "revisit", declared).otherwise(F.octet_length(body).cast("long")).alias("payload_bytes"),
        F.when(kind == "revisit", F.regexp_extract(_field("WARC-Payload-Digest"), "sha256:([0-9a-f]{64})", 1)).otherwise(F.sha2(body.cast("binary"), 256)).alias("payload_digest"),
    )


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The text between candidates, with its file, split and order there. The reader cuts files into byte ranges."""
    text = spark.read.option("lineSep", MAGIC).option("recursiveFileLookup", "true").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split_at"),
        F.monotonically_increasing_id().alias("_nth"), F.octet_length("value").cast("long").alias("_len"), "value",
    )


def _with_offsets(pieces: DataFrame) -> DataFrame:
    """Byte offset `at` of the magic before each piece; the piece before the first magic of a file is dropped."""
    order = W.partitionBy("file").orderBy("_split_at", "_nth")
    start = F.sum(F.col("_len") + len(MAGIC)).over(order) - F.col("_len") - 2 * len(MAGIC)
    return pieces.withColumn("at", start).filter("at >= 0").drop("_split_at", "_nth", "_len")


def _reached(candidates: DataFrame) -> tuple[DataFrame, int]:
    """(f, at), f being the file's hash, of the candidates that are reached, and how many those are; see `chain`."""
    state = staged(candidates.select(F.xxhash64("file").alias("f"), "at", "next", (F.col("at") == 0).alias("on")), "warc-chain")
    reached = -1
    while (now := state.filter("on").count()) != reached:
        reached = now
        far = state.filter("next IS NOT NULL").select("f", F.col("at").alias("next"), F.col("next").alias("_far"))
        hit = state.filter("on AND next IS NOT NULL").select("f", F.col("next").alias("at")).distinct().withColumn("_hit", F.lit(True))
        state = staged(
            state.join(far.hint("merge"), ["f", "next"], "left").join(hit.hint("merge"), ["f", "at"], "left")
            .select("f", "at", F.col("_far").alias("next"), (F.col("on") | F.coalesce("_hit", F.lit(False))).alias("on")),
            "warc-chain",
        )
    return state.filter("on").select("f", "at"), reached


def kept(candidates: DataFrame) -> DataFrame:
    """The candidates, with all their columns, that the chain reaches; see `chain`."""
    ends, n = _reached(candidates)
    ends = F.broadcast(ends) if 32 * n <= BROADCAST_BYTES else ends.hint("merge")
    return candidates.withColumn("f", F.xxhash64("file")).join(ends, ["f", "at"], "left_semi").select(*candidates.columns)


def _follows() -> Column:
    """Whether a candidate begins where the one before it in its file ends, or the first one where the file does."""
    return F.coalesce(F.lag("next", 1, 0).over(W.partitionBy("file").orderBy("at")) == F.col("at"), F.lit(False))


def _records(candidates: DataFrame) -> DataFrame:
    """The same as `kept`, for stored candidates that know whether each `_follows`.

    Where all candidates of a file do, each reaches the next, and all are records. Only other files need the chain.
    """
    doubtful = staged(candidates.groupBy("file").agg(F.bool_and("_follows").alias("_all")).filter("NOT _all").select("file"), "warc-doubtful")
    candidates = candidates.drop("_follows")
    if doubtful.isEmpty():
        return candidates
    return _of_files(candidates, doubtful, "left_anti").unionByName(kept(_of_files(candidates, doubtful)))


def chain(candidates: DataFrame) -> DataFrame:
    """The candidates (file, at) that the chain of (file, at, next) from offset 0 of each file reaches.

    Pointer jumping: after k rounds the first 2^k records are reached and every pointer spans 2^k records. A round joins
    one small row per candidate, its file as a hash, and is written, so its plan does not grow; its files compress too
    well for their size to tell what may be broadcast, so the joins are merges.
    """
    return kept(candidates).select("file", "at")


def _of_files(pieces: DataFrame, files: DataFrame, how: str = "left_semi") -> DataFrame:
    """The pieces of the named files, given as a stored table, or all others: sent to where the text is read if the names are few."""
    size = files.agg(F.sum(F.octet_length("file") + 64)).first()[0] or 0
    return pieces.join(F.broadcast(files) if size <= BROADCAST_BYTES else files.hint("merge"), "file", how)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: file, at, record_type, url, page_id, refers_to, payload_bytes, payload_digest.

    A candidate is kept where the chain from its file's start reaches it. A record with magic in its payload was read in
    pieces; only files with such records are read again, and the pieces put together. A truncated last record is kept
    with the bytes there are.
    """
    pieces = _pieces(spark, path)
    # Parsed where it is read, with places still counted from each piece: only small rows are ordered and shuffled.
    place = F.struct("file", "_split_at", "_nth", "_len")
    parsed = _parsed(pieces.select(place.alias("file"), F.lit(0).cast("long").alias("at"), "value"))
    parsed = parsed.select("file.*", *[c for c in parsed.columns if c not in ("file", "at", "next")], F.col("next").alias("_span"))
    found = _with_offsets(parsed).withColumn("next", F.col("at") + F.col("_span")).drop("_span")
    found = staged(found.withColumn("_follows", _follows()), "warc-candidates")
    records = _records(found)
    broken = staged(records.filter("NOT whole").select("file", F.col("at").alias("_start"), F.col("next").alias("_end")), "warc-broken")
    columns = ["file", "at", "record_type", "url", "page_id", "refers_to", "payload_bytes", "payload_digest"]
    if broken.isEmpty():
        return records.select(*columns)
    again = _with_offsets(_of_files(pieces, staged(broken.select("file").distinct(), "warc-files")))
    # The offsets have brought the texts of a file together already; the merge shuffles only the small side.
    inside = again.join(broken.hint("merge"), "file").filter("at >= _start AND (at < _end OR at = _start)")
    joined = inside.groupBy("file", F.col("_start").alias("at")).agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("_parts"))
    whole = _parsed(joined.select("file", "at", F.array_join(F.col("_parts.value"), MAGIC).alias("value")))
    return records.filter("whole").select(*columns).union(whole.select(*columns))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path = scratch_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""WITH p AS (SELECT page_id, encode(COALESCE(html, '')) AS b FROM pages),
    d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
    m AS (SELECT *, MIN(page_id) OVER (PARTITION BY payload_digest) AS original FROM d)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= {SMALLEST_REVISIT} AND page_id > original THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= {SMALLEST_REVISIT} AND page_id > original THEN original END AS refers_to FROM m"""
