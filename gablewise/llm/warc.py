"""WARC archives: writing segmented records, and reading them back into whole payloads.

A payload goes into an HTTP response block with chunked transfer framing. A block longer than a segment is split: the first
part is the record itself (segment 1), the others are continuation records that name it as their origin; the last of them
states the total length. Reading parses the records, brings continuations together by origin, orders them by segment number,
verifies the lengths and removes the chunk framing. Records whose payload repeats another's are revisits without a payload.

Archives are written by Spark's text writer as one gzip member a record; its line separator is an empty gzip member, so that a
file is a sequence of members that any WARC reader takes, and Spark's text reader, with the same separator, hands a task one
record at a time. Other archives, plain or gzip, are read by the text reader cut at every "WARC/"; the pieces of a file come
in order, and are put together again as far as each record's Content-Length says. So neither holds a whole file in memory.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablewise.llm.common import broadcast_if_small, save, scratch, small_batches

VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
#: What every version line starts with, and what one goes on with.
MARK, FIRST_LINE = b"WARC/", re.compile(rb"\d+\.\d+\r\n")
#: A gzip member of nothing.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff") + b"\x03" + bytes(9)
CHUNK = 32_768
#: Longest block of one record: common pages are longer, so that segments are the rule.
SEGMENT = 2_048
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """HTTP/1.1 chunked framing."""
    out = []
    for i in range(0, len(payload), size):
        part = payload[i : i + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


SIZE = re.compile(rb"[0-9A-Fa-f]{1,15}")


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body (extensions and trailers are skipped); None if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        n = int(m[0], 16) if (m := SIZE.fullmatch(body[at:end].split(b";")[0].strip())) else -1
        if n < 0:
            return None
        if n == 0:
            return b"".join(out)
        part = body[end + 2 : end + 2 + n]
        at = end + 2 + n + 2
        if len(part) < n or body[at - 2 : at] != b"\r\n":
            return None
        out.append(part)


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP response block, without its transfer framing."""
    head, found, body = block.partition(END)
    if not found:
        return None
    framed = any(x.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for x in head.split(b"\r\n"))
    return dechunked(body) if framed else body


def record(kind: str, record_id: str, block: bytes, **headers: str) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": DATE} | headers | {"Content-Length": str(len(block))}
    return VERSION + b"".join(f"{k.replace('_', '-')}: {v}\r\n".encode("utf-8", "replace") for k, v in head.items()) + b"\r\n" + block


def member(record: bytes) -> bytes:
    """A record with the separator after it, as one gzip member."""
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(record + END) + z.flush()


def segments(record_id: str, block: bytes, size: int, **headers: str) -> list[bytes]:
    """The records of one response block."""
    if len(block) <= size:
        return [record("response", record_id, block, **headers)]
    parts = [block[i : i + size] for i in range(0, len(block), size)]
    out = [record("response", record_id, parts[0], WARC_Segment_Number="1", **headers)]
    for n, part in enumerate(parts[1:], 2):
        total = {"WARC_Segment_Total_Length": str(len(block))} if n == len(parts) else {}
        out.append(record("continuation", f"{record_id}:{n}", part, WARC_Segment_Number=str(n), WARC_Segment_Origin_ID=f"<{record_id}>", **total))
    return out


def write_warc(pages: DataFrame, path: str, segment_bytes: int = SEGMENT) -> None:
    """One record or run of segments for each row of pages (page_id long, url string, html string).

    The payload is the html in UTF-8, null as empty. Of rows with equal payloads (by SHA-256) those with the smallest page_id
    are responses, the others revisits of it; rows alike in both are all responses. Null page_ids come after all others. A
    null url is written as none. No rows give an archive without records. Only digests are grouped, and only those that occur
    twice are joined back; if they are too many to broadcast, by shuffle.
    """
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.select("page_id", "url", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload")).withColumn("sha", F.unhex(F.sha2("payload", 256)))
    twice = rows.groupBy("sha").agg(F.count("*").alias("n"), F.min("page_id").alias("first_id")).where("n > 1")
    twice = broadcast_if_small(save(twice.select("sha", "first_id"), "warc-repeats"))
    rows = rows.join(twice.withColumn("repeats", F.lit(True)), "sha", "left")
    visit = F.col("repeats").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    rows = rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "payload", F.expr("uuid()").alias("uuid"), F.when(visit, F.col("first_id")).cast("string").alias("first_id"), visit.alias("visit"))

    def to_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[bytes] = []
            for page, url, payload, uid, first, again in zip(b.page_id, b.url, b.payload, b.uuid, b.first_id, b.visit, strict=True):
                payload, name = bytes(payload), f"urn:uuid:{uid}"
                own = {"WARC_Payload_Digest": f"sha1:{base32_sha1(payload)}"}
                if url is not None:
                    own["WARC_Target_URI"] = " ".join(url.split())
                if page is not None:
                    own["X_Page_Id"] = page
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + END
                if again:
                    own |= {"WARC_Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "X_Refers_To_Page": first}
                    out.append(record("revisit", name, http, Content_Type="application/http; msgtype=response", **own))
                else:
                    out += segments(name, http + chunked(payload), segment_bytes, Content_Type="application/http; msgtype=response", **own)
            yield pd.DataFrame({"record": [member(r) for r in out]})

    records = rows.mapInPandas(to_records, "record binary").select(F.col("record").cast("string"))
    records.write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


RECORD = "kind string, record_id string, page_id long, refers_to long, digest string, segment int, origin string, total long, block binary, whole boolean"
FIELDS = [x.split()[0] for x in RECORD.split(", ")]
DIGITS = re.compile(r"\d{1,18}")


def headers_of(head: bytes) -> dict[str, str]:
    lines = (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n"))
    return {k.strip().lower(): v.strip() for k, _, v in lines}


def stated_length(head: bytes) -> int | None:
    """The Content-Length of a record's headers; None if there is no sound one."""
    n = headers_of(head).get("content-length", "")
    return int(n) if DIGITS.fullmatch(n) else None


def parse(raw: bytes) -> tuple | None:
    """The fields of a record from its version line on. whole: its block is as long as stated. None: it's no record.

    A header that should be a number and isn't counts as missing; without a sound Content-Length a record is not whole.
    """
    head, found, block = raw.partition(END)
    h, n = headers_of(head), stated_length(head)
    if "warc-type" not in h:
        return None
    number = lambda k, most: int(h[k]) if DIGITS.fullmatch(h.get(k, "")) and int(h[k]) <= most else None
    long, short = (1 << 63) - 1, (1 << 31) - 1
    segment, sound = number("warc-segment-number", short), "warc-segment-number" not in h
    whole = bool(found) and n is not None and len(block) >= n and (sound or segment is not None)
    digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    block = block[:n] if n is not None else block.removesuffix(END)
    return h["warc-type"], h.get("warc-record-id"), number("x-page-id", long), number("x-refers-to-page", long), digest, segment, h.get("warc-segment-origin-id"), number("warc-segment-total-length", long), block, whole


def glued(pieces: Iterable[tuple[str, bytes]]) -> Iterator[bytes]:
    """Records from the pieces (file, bytes) that a file falls into at every MARK, in order.

    A record goes on over further pieces until it has its Content-Length. If no separator follows there, the length was wrong:
    then the first piece is a record by itself, and the next one begins another.
    """
    held: list[bytes] = []
    file = None

    def need(first: bytes) -> int | None:
        head, found, _ = first.partition(END)
        n = stated_length(head) if found else None
        return None if n is None else len(head) + len(END) + n

    def settle(last: bool) -> Iterator[bytes]:
        """Gives the records that are complete; with last, all that is held."""
        nonlocal held
        while held:
            raw = MARK.join(held)
            size = need(raw)
            if size is None and END not in raw and not last and len(held) == 1:
                return  # the headers may go on
            if size is not None and len(raw) < size and not last:
                return
            if size is not None and len(raw) >= size and raw[size:].strip(b"\r\n") == b"":
                yield raw
                held = []
            else:
                yield held[0]
                held = [x for x in held[1:] if FIRST_LINE.match(x)] if len(held) > 1 else []

    for name, piece in pieces:
        if name != file:
            yield from settle(True)
            held, file = [], name
        if held and END not in MARK.join(held) and FIRST_LINE.match(piece):
            yield from settle(True)  # headers that never end
        if held or FIRST_LINE.match(piece):
            held.append(piece)
        yield from settle(False)
    yield from settle(True)


def _records(raws: Iterable[bytes]) -> Iterator[pd.DataFrame]:
    rows: list[tuple] = []
    size = 0

    def frame() -> pd.DataFrame:
        whole = {"page_id": "Int64", "refers_to": "Int64", "segment": "Int32", "total": "Int64"}
        columns = zip(*rows, strict=True) if rows else [()] * len(FIELDS)
        return pd.DataFrame({k: pd.array(list(v), whole.get(k, object)) for k, v in zip(FIELDS, columns, strict=True)}).astype({"whole": bool})

    for raw in raws:
        if (r := parse(raw)) is not None:
            rows.append(r)
            size += len(raw)
        if len(rows) == 1000 or size > 8 << 20:
            yield frame()
            rows, size = [], 0
    yield frame()


def inflated(raw: bytes) -> bytes:
    """A gzip member's content; as much of it as there is if it is broken."""
    z = zlib.decompressobj(31)
    try:
        return z.decompress(raw)
    except zlib.error:
        return b""


def read_records(spark: SparkSession, path: str, own: bool = False) -> DataFrame:
    """The records of the archives in path, of any WARC version. own: archives that write_warc has written.

    Other archives should be in gzip or smaller than spark.sql.files.maxPartitionBytes: a plain file that Spark reads in several
    parts may lose a record that contains "WARC/" at a cut. What is no record is skipped, and a broken one is not whole.
    """
    small_batches(spark)
    sep = EMPTY_MEMBER if own else MARK
    text = spark.read.option("lineSep", sep.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    pieces = text.select(F.col("value").cast("binary").alias("value"), F.input_file_name().alias("file"))

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _records(inflated(bytes(v)) for x in batches for v in x.value)

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _records(MARK + r for r in glued((f, bytes(v)) for x in batches for f, v in zip(x.file, x.value, strict=True)))

    return pieces.mapInPandas(members if own else others, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """(kind, record_id, page_id, refers_to, digest, block, whole) with the segments of a record joined.

    whole is false if a segment is missing, shorter than stated, or the sum of lengths is not the stated total. Repeated
    segments count once. Only records in segments are shuffled, by origin; a group is one record's segments.
    """
    one = records.where("segment IS NULL").select("kind", "record_id", "page_id", "refers_to", "digest", "block", "whole")
    parts = records.where("segment IS NOT NULL").withColumn("origin", F.coalesce("origin", "record_id"))
    first = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    g = parts.groupBy("origin").agg(
        first("kind"), first("page_id"), first("refers_to"), first("digest"), F.max("total").alias("total"), F.min("whole").alias("each"),
        F.array_sort(F.collect_set(F.struct("segment", "block"))).alias("s"),
    )
    block = F.expr("unhex(array_join(transform(s, x -> hex(x.block)), ''))")  # in time linear in the length
    numbered = F.expr("s.segment = sequence(1, size(s))")
    g = g.withColumn("block", block)
    whole = F.col("each") & numbered & F.coalesce(F.octet_length("block") == F.col("total"), F.lit(False)) & F.col("kind").isNotNull()
    return one.unionByName(g.select(F.coalesce("kind", F.lit("continuation")).alias("kind"), F.col("origin").alias("record_id"), "page_id", "refers_to", "digest", "block", whole.alias("whole")))


def read_payloads(spark: SparkSession, path: str, own: bool = False) -> DataFrame:
    """(page_id, record_type, refers_to, payload_digest, payload, valid) of the archives in path.

    valid: the record is whole, its framing is sound, and the payload has the stated digest (of a revisit: the record is
    whole). The payload of a revisit is null.
    """

    def decode(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for kind, block, digest, whole in batches:
            got = [payload_of(bytes(x)) if k != "revisit" else None for k, x in zip(kind, block, strict=True)]
            own = [base32_sha1(x) if x is not None else None for x in got]
            valid = [bool(w and (k == "revisit" or o is not None and o == d)) for k, w, o, d in zip(kind, whole, own, digest, strict=True)]
            yield pd.DataFrame({"payload": got, "valid": valid})

    decode = F.pandas_udf(decode, "payload binary, valid boolean")
    x = reassemble(read_records(spark, path, own)).withColumn("x", decode("kind", F.coalesce("block", F.lit(b"")), "digest", "whole"))
    return x.select("page_id", F.col("kind").alias("record_type"), "refers_to", F.col("digest").alias("payload_digest"), "x.payload", "x.valid")


def archive_round_trip(pages: DataFrame, segment_bytes: int = SEGMENT) -> DataFrame:
    """Writes pages as WARC and reads them back: (page_id, payload_bytes, payload_digest, record_type, refers_to, valid).

    A revisit's payload_bytes are those of the response that it refers to. Rows, nulls, ties and repeated rows: as write_warc
    has them. A payload of any length is written whole, in segments; other columns of pages don't matter. No rows give no rows.
    """
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_warc(pages, path, segment_bytes)
    read = read_payloads(spark, path, own=True).select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to", "valid")
    read = save(read, "warc-read")
    revisits = read.where("record_type = 'revisit'").drop("payload_bytes")
    wanted = broadcast_if_small(save(revisits.select(F.col("payload_digest").alias("d")).distinct(), "warc-wanted"))
    found = read.where("record_type = 'response'").join(wanted, F.col("payload_digest") == F.col("d"), "left_semi")
    found = save(found.groupBy(F.col("payload_digest").alias("d")).agg(F.max("payload_bytes").alias("payload_bytes")), "warc-found")
    revisits = revisits.join(broadcast_if_small(found), F.col("payload_digest") == F.col("d"), "left").drop("d")
    return read.where("record_type <> 'revisit'").unionByName(revisits)
