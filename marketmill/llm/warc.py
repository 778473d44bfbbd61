"""WARC archives: writing, normalising whole-file gzip, reading by offset.

Spark's text sink writes records, which end in two line breaks, as gzip files of one stream
each. Such a file can't be entered in the middle. The normaliser inflates each once, chunk
by chunk, rewrites every record as a gzip member of its own and writes an offset index
beside the archive. Readers then fetch single members. An archive is written under a name
of its own and moved when it is whole, so a task that is lost and repeated leaves no part.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm.common import open_store, stored, whole_text
from marketmill.session import scratch_path

BREAK = "\r\n"
CHUNK = 1 << 20
INFLATED = 4 << 20  # handed out by one call
BATCH_BYTES = 8 << 20
INDEX = "archive string, record long, offset long, length long, record_id string, type string"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload binary,"
    " payload_bytes long, payload_digest string"
)


def base32_of_hex(digest: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 in hex: five hex digits are four of base32."""
    parts = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return F.translate(F.upper(F.concat(*parts)), digits, letters)


def record_of(page: str = "page_id", url: str = "url") -> Column:
    """The text of a record from page_id, url, body, bytes, digest and refers_to."""

    def named(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))

    def urn(value: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(value.cast("string"), F.lit("")), F.lit(">"))

    again = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + BREAK + "Content-Type: text/html; charset=utf-8" + BREAK),
        named("Content-Length", F.col("bytes").cast("string")),
        F.lit(BREAK),
    )
    block = F.when(again, F.lit("")).otherwise(F.concat(http, F.col("body")))
    target = F.regexp_replace(F.col(url).cast("string"), r"[\r\n]+", " ")
    head = F.concat(
        F.lit("WARC/1.1" + BREAK),
        named("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        named("WARC-Record-ID", urn(F.col(page))),
        named("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        F.coalesce(named("WARC-Target-URI", target), F.lit("")),
        named("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        named("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.when(
            again,
            F.concat(
                F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/"),
                F.lit("identical-payload-digest" + BREAK),
                named("WARC-Refers-To", urn(F.col("refers_to"))),
            ),
        ).otherwise(F.lit("")),
        named("Content-Type", F.lit("application/http;msgtype=response")),
    )
    return F.concat(head, named("Content-Length", F.octet_length(block).cast("string")),
                    F.lit(BREAK), block)


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, page: str = "page_id", url: str = "url",
    html: str = "html",
) -> None:
    """A WARC record for each row of `pages`, in gzip files of one stream below `folder`.

    The payload is the text in UTF-8, a null one empty. Of payloads that are equal and of
    `least_bytes` or more the one with the largest id is a response, as are rows that repeat
    that id; the others are revisits that refer to it. Smaller ones, and rows without an id,
    are responses. A null url is left out; other columns are not written.
    """
    rows = pages.select(
        F.col(f"`{page}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        whole_text(html).alias("body"),
    )
    rows = rows.withColumns(
        {"bytes": F.octet_length("body").cast("long"), "digest": base32_of_hex(F.sha1("body"))}
    )
    rows = rows.withColumn("second", F.xxhash64("body"))
    # Equal payloads are found on narrow rows, merged before the shuffle. SHA-1 alone would
    # take two payloads that were made to collide for equal.
    same = ["digest", "bytes", "second"]
    shared = (
        rows.filter(F.col("bytes") >= least_bytes)
        .groupBy(*same)
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1 AND last IS NOT NULL")
        .select(*same, "last")
    )
    joined = rows.join(stored(shared, "payloads"), same, "left")
    refers = F.when(F.col("page_id") < F.col("last"), F.col("last"))
    records = joined.withColumn("refers_to", refers).select(record_of().alias("value"))
    writer = records.write.option("compression", "gzip").option("lineSep", BREAK * 2)
    writer.text(folder)


class RecordStream:
    """Records of a gzip stream that is inflated once, in chunks."""

    def __init__(self, source):
        self.source = source
        self.held = bytearray()

    def inflated(self) -> Iterator[bytes]:
        stream = zlib.decompressobj(31)
        while waiting := self.source.read(CHUNK):
            while waiting:
                out = stream.decompress(waiting, INFLATED)
                if out:
                    yield out
                waiting = stream.unconsumed_tail
                if stream.eof:  # the next member of a file that has several
                    waiting = stream.unused_data
                    stream = zlib.decompressobj(31)

    def __iter__(self) -> Iterator[bytes]:
        chunks = self.inflated()
        need, looked = None, 0
        while True:
            if need is None:
                end = self.held.find(b"\r\n\r\n", looked)
                if end >= 0:
                    head = bytes(self.held[:end])
                    need = end + 8 + int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1])
                else:
                    looked = max(0, len(self.held) - 3)
            if need is not None and len(self.held) >= need:
                yield bytes(self.held[:need])
                del self.held[:need]
                need, looked = None, 0
                continue
            chunk = next(chunks, None)
            if chunk is None:
                if self.held.strip():
                    raise ValueError("the archive ends within a record")
                return
            self.held += chunk


def header(record: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields and block of a record, without the two line breaks that end it."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split(BREAK)[1:]
    fields = dict(line.split(": ", 1) for line in lines if ": " in line)
    return fields, rest[:-4]


def normalise(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Rewrites every archive below `folder` into `target`, one gzip member for each record.

    Returns the index (stored): archive, record, offset, length, record_id, type. Beside
    each archive lies the same as text, a line for each record.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    paths = listed.select("path")
    files = max(1, paths.count())
    dealt = paths.repartitionByRange(files, "path")

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                yield rewritten(path, target)

    index = dealt.mapInPandas(rewrite, INDEX)
    return stored(index, "warc-index")


def rewritten(path: str, target: str) -> pd.DataFrame:
    """One archive: rewrites it and returns its index."""
    store, place = open_store(path)
    out_store, out_folder = open_store(target)
    out_store.create_dir(out_folder, recursive=True)
    name = re.sub(r"(\.txt)?\.gz$", "", place.rsplit("/", 1)[1]) + ".warc.gz"
    draft = f"{out_folder}/.{uuid.uuid4().hex}"
    rows, offset = [], 0
    with store.open_input_stream(place, compression=None) as source, out_store.open_output_stream(
        draft, compression=None
    ) as out:
        for number, record in enumerate(RecordStream(source)):
            member = gzip.compress(record, 6, mtime=0)
            out.write(member)
            fields, _ = header(record)
            rows.append((f"{target}/{name}", number, offset, len(member),
                         fields.get("WARC-Record-ID"), fields.get("WARC-Type")))
            offset += len(member)
    found = pd.DataFrame(
        rows, columns=["archive", "record", "offset", "length", "record_id", "type"]
    )
    with out_store.open_output_stream(f"{draft}.idx", compression=None) as out:
        out.write(found.drop(columns="archive").to_csv(sep="\t", index=False).encode())
    out_store.move(f"{draft}.idx", f"{out_folder}/{name}.idx")
    out_store.move(draft, f"{out_folder}/{name}")
    return found


def page_number(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def read_records(index: DataFrame) -> DataFrame:
    """The records that `index` lists, each fetched from its offset.

    page_id, url, record_type, refers_to, payload (null for revisits), payload_bytes,
    payload_digest (of the bytes read; of revisits as the record states them).
    """

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, source = None, None
        rows, size = [], 0
        for batch in batches:
            for archive, offset, length in zip(batch["archive"], batch["offset"], batch["length"],
                                               strict=True):
                if archive != held:
                    store, place = open_store(archive)
                    held, source = archive, store.open_input_file(place)
                source.seek(int(offset))
                rows.append(parsed(gzip.decompress(source.read(int(length)))))
                size += len(rows[-1][4] or b"")
                if size > BATCH_BYTES:
                    yield frame(rows)
                    rows, size = [], 0
        yield frame(rows)

    # As many tasks as archives, of equal numbers of records: the bytes of the index say nothing.
    tasks = max(1, index.select("archive").distinct().count())
    near = index.repartitionByRange(tasks, "archive", "offset")
    near = near.sortWithinPartitions("archive", "offset")
    return near.select("archive", "offset", "length").mapInPandas(fetch, RECORDS)


def parsed(record: bytes) -> tuple:
    fields, block = header(record)
    kind = fields["WARC-Type"]
    payload = None if kind == "revisit" else block.partition(b"\r\n\r\n")[2]
    size = int(fields["WARC-Payload-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None:
        size = len(payload)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    refers = page_number(fields.get("WARC-Refers-To"))
    return (page_number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, refers,
            payload, size, digest)


def frame(rows: list[tuple]) -> pd.DataFrame:
    names = [part.split()[0] for part in RECORDS.split(", ")]
    found = pd.DataFrame(rows, columns=names)
    whole = {"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"}
    return found.astype(whole)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes `pages` as archives, normalises them and reads every record back."""
    spark = pages.sparkSession
    base = scratch_path(spark, "warc")
    write_archives(pages, f"{base}/whole", least_bytes)
    return read_records(normalise(spark, f"{base}/whole", f"{base}/members"))
