"""WARC archives with an index that is written first and read by ranges.

Every task writes its pages to archives of its own, one gzip member per record, as is
usual for WARC files, and returns the index: archive, offset, length, page, URL and digest
of each record. Pages are not shuffled for it. An archive is named after the task's
attempt; a task that is run again writes another one, and the index, committed with the
rows of the attempts that succeeded, never points to what a lost one left behind.

To read records back, their index rows are sorted by archive and offset; neighbouring
ranges are read with one request, as long as the gap between them is small, and no
more than a bounded number of bytes is held at a time. Both ways go through
``pyarrow.fs``, so the folder can lie in any store it knows.

Of pages with equal payloads of some size, that with the smallest id is a response
and all others are revisits that refer to it.

Defined cases: NULL payloads are empty, NULL URLs are the empty string; control
characters and spaces in a URL are percent-encoded in the record. Repeated rows of the
page with the smallest id are all responses. Pages without an id are records with an empty
id, and no page refers to them unless no page with the payload has one. An empty table
gives no archive and an empty index.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.sources.workspace import materialize, table_path

CRLF = "\r\n"
END_OF_RECORD = CRLF + CRLF
DATE = "2024-01-01T00:00:00Z"
HTTP_HEADER = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{END_OF_RECORD}"


@dataclass(frozen=True)
class WarcParams:
    archive_bytes: int = 64 << 20
    min_revisit_bytes: int = 100
    max_gap: int = 64 << 10
    max_read: int = 8 << 20


def _uri(url: Column) -> Column:
    url = F.regexp_replace(F.coalesce(url, F.lit("")), "%(?![0-9A-Fa-f]{2})", "%25")
    for code in (9, 10, 13, 32):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.regexp_replace(url, r"[\x00-\x1F\x7F]", "%00")


def _record(date: str) -> Column:
    """The text of a record without the blank line at its end."""
    is_response = F.col("record_type") == "response"
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    block = F.when(is_response, F.concat(F.lit(HTTP_HEADER), F.col("payload"))).otherwise("")
    head = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _uri(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(
            ~is_response,
            F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to"), F.lit(">")),
        ),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit(END_OF_RECORD), block)


def records(pages: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest``, ``record_type`` and ``refers_to``."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest")
    )
    large = F.octet_length("payload") >= params.min_revisit_bytes
    twice = (
        rows.where(large)
        .groupBy(F.col("digest").alias("of"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    revisit = large & F.col("of").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (
        rows.join(materialize(twice, "twice"), F.col("digest") == F.col("of"), "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("first")))
        .drop("of", "first")
    )


INDEX = (
    "archive string, offset long, length long, page_id string, url string, digest string,"
    " record_type string"
)


def _store(uri: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if "://" not in uri:  # also Hadoop's short form of a local path
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def write_archives(
    pages: DataFrame, params: WarcParams = WarcParams()
) -> tuple[str, DataFrame]:
    """Writes all pages (``page_id``, ``url``, ``html``); the folder and the index."""
    folder = table_path(pages.sparkSession, "archives")
    made = records(pages, params).select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        "digest",
        "record_type",
        F.concat(_record(DATE), F.lit(END_OF_RECORD)).alias("record"),
    )
    columns = [part.split()[0] for part in INDEX.split(",")]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = _store(folder)
        store.create_dir(top, recursive=True)
        archive, name, offset = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, digest, kind, record in batch.itertuples(index=False):
                    if archive is None or offset >= params.archive_bytes:
                        if archive is not None:
                            archive.close()
                        attempt = TaskContext.get().taskAttemptId()
                        name, offset = f"{attempt}-{uuid.uuid4().hex}.warc.gz", 0
                        archive = store.open_output_stream(f"{top}/{name}", compression=None)
                    member = gzip.compress(record.encode(), 6, mtime=0)
                    archive.write(member)
                    rows.append([name, offset, len(member), page_id, url, digest, kind])
                    offset += len(member)
                yield pd.DataFrame(rows, columns=columns)
        finally:
            if archive is not None:
                archive.close()

    index = made.mapInPandas(write, INDEX)
    index = index.withColumn("page_id", F.col("page_id").cast("long"))
    return folder, materialize(index, "index")


def _parsed(member: bytes) -> tuple:
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(END_OF_RECORD.encode())
    fields = dict(line.split(": ", 1) for line in head.decode().split(CRLF)[1:])
    block = rest[: int(fields["Content-Length"])]
    if raw[len(head) + 4 + len(block) :] != END_OF_RECORD.encode():
        raise ValueError("a record doesn't end where its index row says")
    page, refers = (
        fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        for name in ("WARC-Record-ID", "WARC-Refers-To")
    )
    return (
        page or None,
        fields["WARC-Type"],
        fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        refers or None,
        fields["WARC-Target-URI"],
        block.partition(END_OF_RECORD.encode())[2],
    )


def coalesced(ranges: list[tuple[int, int]], max_gap: int, max_read: int) -> list[list[int]]:
    """Sorted (offset, length) ranges as requests: lists of the ranges' positions."""
    requests: list[list[int]] = []
    begin = end = 0
    for i, (offset, length) in enumerate(ranges):
        near = requests and offset - end <= max_gap and offset + length - begin <= max_read
        if near:
            requests[-1].append(i)
        else:
            requests.append([i])
            begin = offset
        end = offset + length
    return requests


def read_records(folder: str, selected: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """The records of the ``selected`` index rows, parsed.

    ``page_id``, ``record_type``, ``digest``, ``refers_to``, ``uri`` and ``payload``.
    """
    n = int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = selected.select("archive", "offset", "length").repartition(n, "archive")
    rows = rows.sortWithinPartitions("archive", "offset")
    # Ids travel as text: pandas would turn those of a batch with a NULL into doubles.
    schema = (
        "page_id string, record_type string, digest string, refers_to string, uri string,"
        " payload binary"
    )
    columns = [part.split()[0] for part in schema.split(",")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = _store(folder)
        for batch in batches:
            for name, group in batch.groupby("archive", sort=False):
                ranges = list(zip(group["offset"], group["length"]))
                with store.open_input_file(f"{top}/{name}") as archive:
                    for request in coalesced(ranges, params.max_gap, params.max_read):
                        begin = ranges[request[0]][0]
                        data = archive.read_at(sum(ranges[request[-1]]) - begin, begin)
                        starts = [(ranges[i][0] - begin, ranges[i][1]) for i in request]
                        parts = [_parsed(data[at : at + n]) for at, n in starts]
                        yield pd.DataFrame(parts, columns=columns)

    ids = {c: F.col(c).cast("long") for c in ("page_id", "refers_to")}
    return rows.mapInPandas(read, schema).withColumns(ids)
