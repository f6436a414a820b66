r"""WARC archives: writing with revisits and segments, reading with reassembly.

Writing. Payloads are sent as HTTP responses with chunked transfer framing. A block
longer than ``segment_bytes`` is cut: the first record carries segment number 1,
continuation records carry the origin's id and their number, the last one the total
length. Of records with equal payloads of at least ``least`` bytes, that with the
largest page id is the response; the others are revisit records that refer to it.
Files are written by Spark's text writer with the record separator of the format,
so archives are gzip-compressed, committed atomically, and go to any store Spark writes to.

Reading. Archives are parsed by record headers and content lengths. Segments are
grouped by origin id, ordered by number, checked to be complete against the total
length, and joined; then the HTTP header is split off and the chunks are decoded.
Unsegmented records skip the grouping. Revisits take payload length and digest from
the response they refer to. A broken record and a revisit without its response raise
an error.

Scale: pages are staged once with their row numbers, so that all branches of the plan
see the same ones. Payloads go through one shuffle when written, keyed by digest, where skewed
digests are split; the copies of a payload are reduced before that to a digest and
the largest page id. A file holds at most ``FILE_RECORDS`` records of at most
``segment_bytes``, so a reading task is bounded whatever the page lengths. A page's
segments meet in one group: it is as large as that page.

Defined results: null html is an empty payload; null urls are left out of the header;
null page ids stay null and are the smallest; repeated rows are separate records, of
equal page ids any one is the response; an empty table gives an empty archive; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.sources.staging import stage

END = b"\r\n\r\n"
VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked"
CHUNK = 8192
FILE_RECORDS = 1000
PARSED = (
    "record_id string, page_id long, type string, refers_to string, refers_to_page long, payload_digest string,"
    " origin string, number int, total long, block binary"
)


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Decode chunked framing; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        chunk = body[line + 2 : line + 2 + size]
        if len(chunk) != size or body[line + 2 + size : line + 4 + size] != b"\r\n":
            raise ValueError("broken chunk framing")
        out.append(chunk)
        at = line + 4 + size


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A WARC record without its closing separator."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers if v is not None), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + END + block


def _urn(page, row) -> str:
    return f"<urn:page:{'' if page is None else page}:{row}>"


def records_of(page, row, url: str | None, digest: str, html: str | None, refers, segment_bytes: int) -> Iterator[bytes]:
    """The records of one page; ``refers`` is (page, row) of the response for a revisit."""
    common = [("WARC-Date", DATE), ("WARC-Target-URI", None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%~"))]
    common.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    own = _urn(page, row)
    if refers is not None:
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Refers-To", _urn(*refers)), *common], b"")
        return
    block = HTTP + END + chunked((html or "").encode())
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    segmented = len(parts) > 1
    first = [("WARC-Type", "response"), ("WARC-Record-ID", own), *common, ("Content-Type", "application/http; msgtype=response")]
    yield record(first + [("WARC-Segment-Number", 1)] * segmented, parts[0])
    for number, part in enumerate(parts[1:], 2):
        headers = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{number}>"), ("WARC-Date", DATE)]
        headers += [("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", number)]
        yield record(headers + [("WARC-Segment-Total-Length", len(block))] * (number == len(parts)), part)


def _write(batches: Iterator[pa.RecordBatch], segment_bytes: int) -> Iterator[pa.RecordBatch]:
    names = ("page", "row", "url", "digest", "html", "to_page", "to_row")
    for batch in batches:
        out, size = [], 0
        for values in zip(*(batch[n] for n in names)):
            page, row, url, digest, html, to_page, to_row = (v.as_py() for v in values)
            refers = None if to_row is None or to_row == row else (to_page, to_row)
            for one in records_of(page, row, url, digest, html, refers, segment_bytes):
                out.append(one)
                size += len(one)
                if size > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def write_archives(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html",
    least: int = 1000, segment_bytes: int = 32 << 10,
) -> None:
    """One record per page, more for long ones, as compressed archives under ``path``."""
    body = F.coalesce(F.col(html), F.lit(""))
    # Row numbers made twice in one plan may differ between its branches.
    rows = stage(
        pages.select(
            F.col(id).cast("long").alias("page"), F.monotonically_increasing_id().alias("row"), F.col(url).alias("url"),
            F.sha1(F.encode(body, "UTF-8")).alias("digest"), body.alias("html"),
        ),
        "pages",
        "zstd",
    )
    # Digests that occur more than once, with the response among their pages.
    copies = (
        rows.where(F.octet_length("html") >= least).groupBy("digest")
        .agg(F.max(F.struct("page", "row")).alias("to"), F.expr("count(1) AS n"))
        .where("n > 1").selectExpr("digest", "to.page AS to_page", "to.row AS to_row")
    )
    # A revisit needs no payload.
    placed = rows.join(copies, "digest", "left").withColumn("html", F.expr("CASE WHEN to_row IS NULL OR to_row = row THEN html END"))
    columns = ["page", "row", "url", "digest", "html", "to_page", "to_row"]
    (
        placed.select(*columns).mapInArrow(lambda batches: _write(batches, segment_bytes), "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)
    )


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an uncompressed archive."""
    at = 0
    while at < len(data):
        end = data.index(END, at)
        lines = data[at:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines[1:])}
        start, size = end + len(END), int(headers["content-length"])
        if data[start + size : start + size + len(END)] != END:
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield headers, data[start : start + size]
        at = start + size + len(END)


def unzipped(data: bytes) -> bytes:
    """All members of gzip data, or data that is not compressed."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out) if out else data


def _page(urn: str | None) -> int | None:
    page = urn.split(":")[2] if urn else ""
    return int(page) if page else None


def _read(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for h, block in parse_archive(unzipped(content.as_py())):
                own, kind = h["warc-record-id"], h["warc-type"]
                number = h.get("warc-segment-number")
                origin = h.get("warc-segment-origin-id", own if number else None)
                total = h.get("warc-segment-total-length")
                refers, digest = h.get("warc-refers-to"), h.get("warc-payload-digest", "").removeprefix("sha1:")
                rows.append((own, _page(own), kind, refers, _page(refers), digest, origin, number and int(number), total and int(total), block))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``; columns as in ``PARSED``."""
    names = [p.strip().split(" ")[0] for p in PARSED.split(",")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(lambda batches: _read(batches, names), PARSED)


def _payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads of whole responses: segments joined, framing decoded, digest checked."""
    for batch in batches:
        out = []
        for parts, total, digest in zip(batch["parts"].to_pylist(), batch["total"].to_pylist(), batch["payload_digest"].to_pylist()):
            block = b"".join(p["block"] for p in sorted(parts, key=lambda p: p["number"]))
            if [p["number"] for p in sorted(parts, key=lambda p: p["number"])] != list(range(1, len(parts) + 1)):
                raise ValueError("segments are missing or repeated")
            if total is None and len(parts) > 1 or total is not None and len(block) != total:
                raise ValueError("segments do not have the total length")
            head, _, body = block.partition(END)
            payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
            if digest and hashlib.sha1(payload).hexdigest() != digest:
                raise ValueError("the payload does not have its digest")
            out.append(payload)
        yield pa.RecordBatch.from_arrays(
            [batch["record_id"], batch["page_id"], pa.array(out, pa.binary())], ["record_id", "page_id", "payload"]
        )


def responses(records: DataFrame) -> DataFrame:
    """``record_id``, ``page_id``, ``payload`` of every response, reassembled and decoded."""
    whole = records.where("type = 'response' AND origin IS NULL").select(
        "record_id", "page_id", "payload_digest", F.lit(None).cast("long").alias("total"),
        F.array(F.struct(F.lit(1).alias("number"), "block")).alias("parts"),
    )
    joined = records.where("origin IS NOT NULL").groupBy(F.col("origin").alias("record_id")).agg(
        F.max(F.expr("CASE WHEN number = 1 THEN page_id END")).alias("page_id"),
        F.max(F.expr("CASE WHEN number = 1 THEN payload_digest END")).alias("payload_digest"),
        F.max("total").alias("total"), F.collect_list(F.struct("number", "block")).alias("parts"),
    )
    both = whole.unionByName(joined)
    return both.mapInArrow(_payload, "record_id string, page_id long, payload binary")


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """Per page, from the archives: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``."""
    records = read_records(spark, path)
    found = responses(records).select(
        "record_id", "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")
    )
    again = records.where("type = 'revisit'").select("page_id", "refers_to", "refers_to_page")
    revisits = again.join(found.select(F.col("record_id").alias("refers_to"), "payload_bytes", "payload_digest"), "refers_to", "left")
    lost = "raise_error(concat('revisit of page ', coalesce(page_id, 'null'), ' without its response ', coalesce(refers_to, 'null')))"
    revisits = revisits.where(F.expr(f"CASE WHEN payload_digest IS NULL THEN CAST({lost} AS BOOLEAN) ELSE true END"))
    columns = ["page_id", "payload_bytes", "payload_digest"]
    return found.select(*columns, F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.select(*columns, F.lit("revisit").alias("record_type"), F.col("refers_to_page").alias("refers_to"))
    )
