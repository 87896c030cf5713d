"""Web archives without repeated payloads: revisit records resolved by payload digest."""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.common import new_path, stored
from gridtally.operators.key_filter import BITS, key_filter, mark_filter

# Equal payloads shorter than this are all written in full.
MIN_BYTES = 100
# An archive holds at most so many records, and payloads of at most so many bytes, unless it holds one
# record only. Each is read back by one task, as one value of Spark's, which ends at 2 GiB.
RECORDS_PER_ARCHIVE = 2_000
ARCHIVE_BYTES = 1 << 30
WRITTEN_AT = "2024-01-01T00:00:00Z"

_BREAK = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def first_of(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``payload_digest`` and ``original``, the smallest page_id, of digests that occur more than once.

    ``headers`` has ``page_id``, ``payload_bytes`` and ``payload_digest``. Headers alone are shuffled,
    and the ids of a digest are reduced before that, so a digest may have any number of records.
    """
    return stored(
        headers.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("original"), F.count("*").alias("records"))
        .where("records > 1")
        .drop("records")
    )


def resolve(rows: DataFrame, originals: DataFrame) -> DataFrame:
    """``rows`` with ``record_type`` and ``refers_to``, by the ``first_of`` their headers.

    A row whose digest has an original with another page_id is a revisit of it, all others are responses.
    So rows that repeat the original's id are responses too, and a row without id is a revisit if another
    row with its digest has one. Both sides are exchanged for this join alone, so that a digest many
    records share can be split.
    """
    own = F.col("original").isNull() | F.col("page_id").eqNullSafe(F.col("original"))
    return rows.join(originals, "payload_digest", "left").select(
        *rows.columns,
        F.when(own, "response").otherwise("revisit").alias("record_type"),
        F.when(~own, F.col("original")).alias("refers_to"),
    )


def _record_id(page_id: Column, digest: Column, copy: Column) -> Column:
    name = F.md5(F.concat_ws(":", F.lit("page"), page_id.cast("string"), digest, copy.cast("string")))
    parts = [F.substring(name, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record(written_at: str = WRITTEN_AT) -> Column:
    """One WARC record as text, without the two line breaks that end it; all its headers are fresh.

    A response holds an HTTP head and the payload, a revisit the head alone. Line breaks and other
    control characters in an address are left out of its header. ``copy`` tells records of one page and
    payload apart; revisits refer to the copy 0 of their original.
    """
    revisit = F.col("record_type") == "revisit"
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_BREAK}Content-Type: text/html; charset=utf-8{_BREAK}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(_BREAK * 2),
    )
    block = F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    page = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x1F\x7F]", "")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("payload_digest"), F.col("copy"))),
        F.lit(f"WARC-Date: {written_at}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Page-ID: "), page("page_id")),
        F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")),
        F.when(
            revisit,
            F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to"), F.col("payload_digest"), F.lit(0))),
        ),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws(_BREAK, *lines), F.lit(_BREAK * 2), block)


def write_archives(
    pages: DataFrame, path: str | None = None, records: int = RECORDS_PER_ARCHIVE, bits: int = BITS
) -> str:
    """Write one record per row of ``pages`` (``page_id``, ``url``, ``html``); the folder written.

    Payloads are the UTF-8 of ``html``, none for null. The archives are gzipped files, in ``path`` or a new
    folder of those all executors share, of at most ``records`` records, fewer if the longest payload would
    let them pass ``ARCHIVE_BYTES``. No two records have the same id.

    Payloads are read twice, once for their digests and once to be written. Headers are shuffled to resolve
    the revisits, which are written from their headers alone. A response is written where its payload was
    read: a bitmap of ``bits`` bits tells which payloads surely occur once. Only where it leaves that open, and
    a second bitmap does not tell that the row is a revisit, payloads are exchanged to be sure. These are
    the originals of repeated payloads and few others, so copies are never moved, however many there are.
    """
    path = path or new_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    headers = stored(rows.drop("payload"))
    longest = headers.agg(F.max("payload_bytes")).first()[0] or 0
    records = max(1, min(records, ARCHIVE_BYTES // (longest + 1)))
    originals = first_of(headers)
    repeated = key_filter(originals, ["payload_digest"], bits)
    resolved = stored(resolve(headers, originals).withColumn("copy", F.monotonically_increasing_id()))

    key = ["page_id", "payload_digest"]
    answers = resolved.where("record_type = 'response'").select(*key)
    unsure = mark_filter(answers, repeated, ["payload_digest"], "_maybe", bits).where("_maybe").select(*key).distinct()
    candidates = key_filter(unsure, key, bits)
    marked = mark_filter(rows, repeated, ["payload_digest"], "_maybe", bits)
    once = marked.where(~F.col("_maybe")).withColumn("copy", F.monotonically_increasing_id())
    open_ = mark_filter(marked.where("_maybe"), candidates, key, "_answer", bits).where("_answer")
    known = unsure.withColumnsRenamed({name: f"_{name}" for name in key})
    same = F.col("page_id").eqNullSafe(F.col("_page_id")) & (F.col("payload_digest") == F.col("_payload_digest"))
    of_key = Window.partitionBy(*key).orderBy("url")
    sure = open_.join(known, same, "left_semi").withColumn("copy", (F.row_number().over(of_key) - 1).cast("long"))

    columns = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "copy"]
    none = F.lit(None).cast(pages.schema["page_id"].dataType)
    full = once.select(*columns).union(sure.select(*columns))
    full = full.withColumns({"record_type": F.lit("response"), "refers_to": none})
    revisits = resolved.where("record_type = 'revisit'").withColumn("payload", F.lit(""))
    for part in (full, revisits):
        (
            part.select(record().alias("value"))
            .write.mode("append")
            .option("lineSep", _BREAK * 2)
            .option("compression", "gzip")
            .option("maxRecordsPerFile", records)
            .text(path)
        )
    return path


def read_archives(spark, path: str) -> DataFrame:
    """The headers of all records: ``page_id``, ``url``, ``record_type``, ``payload_digest`` as stated,
    and ``payload_bytes`` and ``found_digest`` of the payload itself, null for revisits.

    Each archive is one task's and is decompressed as it is read, one record at a time.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(
        _read,
        "page_id long, url string, record_type string, payload_digest string, payload_bytes long, found_digest string",
    )


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """The header fields, in lower case, and the block of each record of a file."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.read(int(fields["content-length"]))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "found_digest"]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
    for batch in batches:
        for content in batch.column(0):
            rows = []
            with gzip.open(io.BytesIO(content.as_buffer())) as stream:
                for fields, block in parse(stream):
                    page = fields["warc-page-id"]
                    full = fields["warc-type"] == "response"
                    payload = block.partition(b"\r\n\r\n")[2] if full else b""
                    rows.append(
                        (
                            None if page == "-" else int(page),
                            fields["warc-target-uri"],
                            fields["warc-type"],
                            fields["warc-payload-digest"].partition(":")[2],
                            len(payload) if full else None,
                            sha256(payload).hexdigest() if full else None,
                        )
                    )
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def resolved_records(read: DataFrame) -> DataFrame:
    """Records with the size and digest of their full payload, and the page revisits refer to.

    Revisits join the response of their digest, the one with the smallest page_id.
    """
    read = stored(read)
    originals = stored(
        read.where("record_type = 'response'")
        .groupBy(F.col("found_digest").alias("payload_digest"))
        .agg(F.min(F.struct("page_id", "payload_bytes")).alias("original"))
        .join(read.where("record_type = 'revisit'").select("payload_digest").distinct(), "payload_digest")
    )
    responses = read.where("record_type = 'response'").select(
        "page_id", "url", "payload_bytes", F.col("found_digest").alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    revisits = (
        read.where("record_type = 'revisit'")
        .drop("payload_bytes")
        .join(originals, "payload_digest", "left")
        .select(
            "page_id", "url", F.col("original.payload_bytes").alias("payload_bytes"), "payload_digest",
            "record_type", F.col("original.page_id").alias("refers_to"),
        )
    )
    return responses.union(revisits)
