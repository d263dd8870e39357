"""WARC archives: writing, and reading by boundary-chain verification.

Writing: a record is one text row whose rows end with CR LF, so Spark's own text
writer puts standard, uncompressed WARC files into the shared folder. Records
of equal payloads: that of the smallest page id is a response, the others are
revisits of it without a payload of their own.

Reading: a file is split at the magic (the version line that begins a record)
by Spark's text reader, in parallel and also within files. Each piece between
two magics is a candidate record; its offset is the running sum of the pieces'
lengths, and its header gives the offset of its successor. The magic may also
stand inside a payload, even with a whole record around it, so candidates
prove nothing by themselves: pointer jumping from the start of each file
(every turn doubles the distance covered) keeps the records that are reachable,
and only these are records. Only offsets are shuffled; a payload is read again only
where it holds the magic, to be put together from its pieces.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlens.llm.common import map_groups, maybe_in, stored
from claimlens.session import new_scratch_path

# Fixed values of the WARC 1.1 format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
MIN_REVISIT = 0         # payloads of fewer bytes are always responses
RECORDS_PER_FILE = 20_000
_BASE32_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column (160 bits are 32 digits)."""
    digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*groups)), _BASE32_DIGITS, _BASE32)


def _one_line(c: Column) -> Column:
    """A header value: line breaks would end the header, so they are percent-encoded."""
    return F.replace(F.replace(c, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload and refers_to (null: a response).

    Payloads are equal if both SHA-1 and SHA-256 are. Of equal ones the
    smallest page_id is the response; rows that repeat it are responses too,
    as a record cannot refer to itself. A null page_id is the largest: it
    revisits the others, and is a response where there is none.
    Only pages whose payload may repeat are shuffled.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    raw = F.col("payload").cast("binary")
    same = F.unhex(F.concat(F.sha1(raw), F.sha2(raw, 256)))
    groups = (rows.filter(F.octet_length("payload") >= min_bytes).select("page_id", same.alias("same"))
              .groupBy("same").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .filter((F.col("n") > 1) & F.col("first").isNotNull()).select("same", "first"))
    groups = stored(groups, "copies")
    marked = maybe_in(rows.withColumn("own", same), F.col("own"), groups.select("same"), "maybe")
    moved = marked.filter("maybe").join(groups, F.col("own") == F.col("same"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return (marked.filter("not maybe").select("page_id", "url", "payload", F.lit(None).cast("long").alias("refers_to"))
            .unionByName(moved.select("page_id", "url", "payload", refers.alias("refers_to"))))


def records(rows: DataFrame) -> DataFrame:
    """One string column: the WARC record of each row, without its last line break."""
    payload = F.col("payload").cast("binary")
    size = F.octet_length("payload")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    size.cast("string"), F.lit(END + END))
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END))
    head = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _urn(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", _one_line(F.col("url")))).otherwise(""),
        F.when(F.col("page_id").isNotNull(), line("X-Page-Id", F.col("page_id").cast("string"))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(payload))),
        line("X-Payload-Length", size.cast("string")),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _urn(F.col("refers_to"))),
            line("X-Refers-To-Page", F.col("refers_to").cast("string")))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END))
    return rows.select(F.concat(head, block, F.lit(END)).alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT) -> None:
    """Write a record for every row of ``pages`` into WARC files below ``path``."""
    (records(with_revisits(pages, min_bytes)).write.option("lineSep", END)
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, at (order in it) and the text between two magics."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("at"), "value"))


def _field(name: str) -> Column:
    """A header field's value, or null."""
    found = F.regexp_extract(F.col("header"), rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _parsed(pieces: DataFrame) -> DataFrame:
    """What the pieces say of themselves, with ``value`` left out.

    length and header_length in bytes; declared: the block's length (null: no
    record header); whole: the piece is the record to its last byte. Of whole
    responses the payload's own size and digest are computed here, at the scan.
    """
    rows = (pieces.withColumn("header", F.concat(F.lit(END), F.substring_index("value", END + END, 1)))
            .withColumn("length", F.octet_length("value"))
            .withColumn("header_length", F.octet_length("header") - len(END)))
    none = F.col("header_length") == F.col("length")  # no empty line: not a header
    rows = rows.withColumn("declared", F.when(~none, _field("Content-Length").try_cast("long")))
    rows = (rows.withColumn("whole", F.coalesce(
                F.col("header_length") + F.col("declared") + 4 * len(END) == F.col("length"), F.lit(False)))
            .withColumn("type", _field("WARC-Type")))
    block = F.substring(F.col("value").cast("binary"), F.col("header_length") + 2 * len(END) + 1,
                        F.col("declared").cast("int"))
    rows = rows.withColumn("body", F.when(F.col("whole") & (F.col("type") == "response"), block.cast("string")))
    http = F.octet_length(F.substring_index("body", END + END, 1))
    rows = rows.withColumn("body", F.substring(F.col("body").cast("binary"), http + 2 * len(END) + 1,
                                               F.octet_length("body")))
    return rows.select(
        *[c for c in pieces.columns if c != "value"], "length", "header_length", "declared", "whole", "type",
        _field("X-Page-Id").try_cast("long").alias("page_id"),
        F.coalesce(F.octet_length("body"), _field("X-Payload-Length").try_cast("int")).cast("long").alias("payload_bytes"),
        F.coalesce(base32_sha1(F.col("body")), F.regexp_replace(_field("WARC-Payload-Digest"), "(?i)^sha1:", ""))
        .alias("payload_digest"),
        _field("X-Refers-To-Page").try_cast("long").alias("refers_to"))


def _offsets(pieces: DataFrame) -> DataFrame:
    """Adds ``start``, the offset of the piece in its file (after its magic)."""
    before = Window.partitionBy("file").orderBy("block", "at").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn("start", F.coalesce(F.sum(F.col("length") + F.lit(len(MAGIC))).over(before),
                                                 F.lit(0)).cast("long"))


def reachable(offsets: np.ndarray, successors: np.ndarray) -> np.ndarray:
    """Which candidates (sorted offsets) the chain from offset 0 reaches, by pointer jumping.

    A successor of -1, or one that is no candidate's offset, ends the chain.
    """
    n = len(offsets)
    at = np.searchsorted(offsets, successors)
    hit = (at < n) & (offsets[np.minimum(at, max(n - 1, 0))] == successors) if n else np.zeros(0, bool)
    jump = np.append(np.where(hit, at, n), n)  # n: the end, which leads to itself
    reached = np.zeros(n + 1, bool)
    if n and offsets[0] == 0:
        reached[0] = True
    covered = 1
    while covered <= n:  # after a turn, all within ``covered`` steps are reached
        reached[jump[np.flatnonzero(reached)]] = True
        jump = jump[jump]
        covered *= 2
    return reached[:n]


def _chain(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("offset", kind="stable")
    keep = reachable(frame["offset"].to_numpy(np.int64), frame["successor"].to_numpy(np.int64))
    return frame.loc[keep, ["file", "offset"]]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``, in no order.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to,
    and where it is: file, offset, length. Size and digest of a response are
    those of its payload as it was read; a revisit's are from its header.
    A file that does not begin with a record has none; an empty folder neither.
    """
    pieces = _pieces(spark, path)
    found = stored(_offsets(_parsed(pieces)), "pieces")
    # Everything but a file's first piece follows a magic, so it is a candidate.
    offset = F.col("start") - len(MAGIC)
    successor = F.col("start") + F.col("header_length") + F.col("declared") + 4 * len(END)
    edges = found.filter(F.col("start") > 0).select("file", offset.alias("offset"),
                                                    F.coalesce(successor, F.lit(-1)).alias("successor"))
    chain = stored(map_groups(edges, ["file"], _chain, "file string, offset long"), "chain")
    proven = found.withColumn("offset", offset).join(chain, ["file", "offset"])
    fields = ["page_id", "payload_bytes", "payload_digest", "type", "refers_to", "file", "offset"]
    whole = proven.filter("whole").select(*fields, F.col("length") + len(MAGIC))
    broken = proven.filter("not whole").select("file", "offset", successor.alias("end"))
    if broken.isEmpty():
        return whole.toDF(*_OUT)
    # Records with the magic inside: their pieces are read again and joined.
    broken = stored(broken, "broken")
    again = pieces.join(broken.select("file").distinct(), "file", "left_semi").withColumn("length", F.octet_length("value"))
    again = _offsets(again).select("file", "start", "value")
    parts = again.join(_spans(found, chain, broken), ["file", "start"])
    joined = parts.groupBy("file", "offset").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("start", "value"))), lambda x: x["value"]), MAGIC).alias("value"))
    mended = _parsed(joined).filter("whole").select(*fields, F.col("length") + len(MAGIC))
    return whole.toDF(*_OUT).unionByName(mended.toDF(*_OUT))


_OUT = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "offset", "length"]


def _spans(found: DataFrame, chain: DataFrame, broken: DataFrame) -> DataFrame:
    """(file, start, offset): the pieces of each broken record, ``offset`` being the record's."""
    marks = chain.select("file", (F.col("offset") + len(MAGIC)).alias("start"), "offset")
    order = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    owned = (found.select("file", "start").join(marks, ["file", "start"], "left")
             .withColumn("offset", F.last("offset", ignorenulls=True).over(order)))
    return (owned.join(broken, ["file", "offset"]).filter(F.col("start") < F.col("end"))
            .select("file", "start", "offset"))


def round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT, path: str | None = None) -> DataFrame:
    """Write all pages to archives and read these back: one row per page.

    A null html is an empty payload, a null url gives a record without URI, a
    null page_id one without id. Empty tables give no rows.
    """
    spark = pages.sparkSession
    path = path or new_scratch_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path)
