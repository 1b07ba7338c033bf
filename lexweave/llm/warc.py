"""WARC archives: a writer of gzip members and a splittable reader."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import fresh_path, materialize
from .common import attach, partitions

#: Payloads below this many bytes are stored each time.
REVISIT_BYTES = 1000
FILE_BYTES = 256 << 20
SPLIT_BYTES = 16 << 20
READ_BYTES = 1 << 20
LEVEL = 1

#: Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

RECORDS = (
    "path string, offset long, member_bytes long, record_type string, record_id string, "
    "refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary"
)


# --- writing -------------------------------------------------------------------------------


def record(kind: str, record_id: str, uri: str | None, refers_to: str | None, digest: bytes, size: int, payload: bytes) -> bytes:
    """One WARC record: its HTTP head keeps the size of the full payload in either kind."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (payload if kind == "response" else b"")
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{record_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": " ".join((uri or "").split()) or None,
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(digest).decode(),
        "WARC-Refers-To": f"<{refers_to}>" if refers_to else None,
        "WARC-Profile": PROFILE if kind == "revisit" else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def _writer(folder: str, level: int, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        out, name, size, count = None, "", 0, 0
        done = []

        def close() -> None:
            if out is not None:
                out.close()
                done.append((name, size, count))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None or size >= file_bytes:
                    close()
                    part = TaskContext.get().partitionId()
                    # another attempt of the task writes other names; the manifest decides
                    name, size, count = f"pages-{part:06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                data = member(
                    record(row["kind"], row["record_id"], row["uri"], row["refers_to"],
                           bytes(row["digest"]), row["size"], row["payload"] or b""), level,
                )
                out.write(data)
                size, count = size + len(data), count + 1
        close()
        names, sizes, counts = zip(*done) if done else ((), (), ())
        yield pa.record_batch(
            [pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
            ["name", "length", "records"],
        )

    return write


def write_warc(records: DataFrame, folder: str, level: int = LEVEL, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``kind, record_id, uri, refers_to, digest, size, payload`` rows as archives.

    Each task writes files of its own; the manifest, ``path, length, records``, names those of
    the attempts that counted, so a lost executor leaves unlisted files only. Returns it.
    """
    spark = records.sparkSession
    base = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    if base.startswith("file:/") and not base.startswith("file://"):
        base = "file://" + base.removeprefix("file:")
    fs, root = pafs.FileSystem.from_uri(base)
    fs.create_dir(root, recursive=True)
    rows = records.select("kind", "record_id", "uri", "refers_to", "digest", "size", "payload")
    found = rows.mapInArrow(_writer(base, level, file_bytes), "name string, length long, records long")
    found = found.withColumn("path", F.concat(F.lit(f"{base}/"), F.col("name"))).drop("name")
    found.write.parquet(f"{base}/_manifest")
    return spark.read.parquet(f"{base}/_manifest")


# --- reading -------------------------------------------------------------------------------


class Source:
    """Buffered reads of one file."""

    def __init__(self, uri: str, length: int):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        self.length = length
        self.at, self.data = 0, b""

    def get(self, start: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``start``."""
        n = max(min(n, self.length - start), 0)
        if not self.at <= start <= start + n <= self.at + len(self.data):
            self.at = start
            self.file.seek(start)
            self.data = self.file.read(min(max(n, READ_BYTES), self.length - start))
        low = start - self.at
        return self.data[low : low + n]


def head_of(source: Source, at: int) -> dict[str, str] | None:
    """The record head of a gzip member at ``at``; None if there is no such member."""
    if source.get(at, 3) != MAGIC:
        return None
    inflate, text, place = zlib.decompressobj(31), b"", at
    while b"\r\n\r\n" not in text and not inflate.eof:
        data = source.get(place, 4096)
        if not data or len(text) > 1 << 20:
            return None
        try:
            text += inflate.decompress(data, 1 << 16)
        except zlib.error:
            return None
        place += len(data)
        if not VERSION.startswith(text[:7]) and text[:5] != b"WARC/":
            return None
    head, mark, _ = text.partition(b"\r\n\r\n")
    fields = dict(
        line.decode("utf-8", "replace").split(": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line
    )
    return fields if mark and "WARC-Type" in fields and fields.get("Content-Length", "").isdigit() else None


def unpack(source: Source, at: int) -> tuple[bytes, int]:
    """The whole member at ``at`` and where it ends; its checksum is verified."""
    inflate, parts, place = zlib.decompressobj(31), [], at
    while not inflate.eof:
        data = source.get(place, 1 << 16)
        if not data:
            raise ValueError(f"gzip member at {at} is cut off")
        parts.append(inflate.decompress(data))
        place += len(data)
    return b"".join(parts), place - len(inflate.unused_data)


def follow(source: Source, at: int, end: int) -> int:
    """Where the chain of members from ``at`` leaves the range; an error if it breaks."""
    while at < min(end, source.length):
        if head_of(source, at) is None:
            raise ValueError(f"no record at {at}")
        _, at = unpack(source, at)
    return at


def first_member(source: Source, start: int, end: int) -> tuple[int, int] | None:
    """The first place in the range from which members follow each other, and where they end.

    Scan for the magic, decode the record head, follow the chain through the range.
    """
    at = start
    while at < min(end, source.length):
        data = source.get(at, READ_BYTES)
        found = data.find(MAGIC)
        if found < 0:
            at += max(len(data) - 2, 1)
            continue
        at += found
        if at < end and head_of(source, at) is not None:
            try:
                return at, follow(source, at, end)
            except (ValueError, zlib.error):
                pass
        at += 1
    return None


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(
        line.decode("utf-8", "replace").split(": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line
    )
    return fields, rest[: int(fields["Content-Length"])]


def _plain(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def read_range(uri: str, length: int, first: int, end: int) -> Iterator[dict]:
    """Records from the one at ``first`` that start before ``end``; the last may reach beyond."""
    source, at = Source(uri, length), first
    while at < min(end, length):
        data, after = unpack(source, at)
        fields, block = parse(data)
        http, _, payload = block.partition(b"\r\n\r\n")
        size = next(
            (int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")),
            len(payload),
        )
        digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        full = fields["WARC-Type"] == "response"
        if full and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"{uri}: payload of the record at {at} does not match its digest")
        yield {
            "path": uri, "offset": at, "member_bytes": after - at, "record_type": fields["WARC-Type"],
            "record_id": _plain(fields.get("WARC-Record-ID")), "refers_to": _plain(fields.get("WARC-Refers-To")),
            "target_uri": fields.get("WARC-Target-URI"), "payload_digest": digest,
            "payload_bytes": size, "payload": payload if full else None,
        }
        at = after


def _reader(keep_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "offset", "member_bytes", "record_type", "record_id", "refers_to",
                 "target_uri", "payload_digest", "payload_bytes", "payload"]
        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

        rows, held = [], 0
        for batch in batches:
            for split in batch.to_pylist():
                for row in read_range(split["path"], split["length"], split["first"], split["end"]):
                    held += len(row["payload"] or b"") + 200
                    rows.append(row if keep_payload else row | {"payload": None})
                    if held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return read


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first record of each range, sought or, where it is due, given, and the last one's end."""
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            source = Source(r["path"], r["length"])
            if r["due"] is not None:
                found = r["due"], follow(source, r["due"], r["end"])
            else:
                found = first_member(source, r["start"], r["end"]) if r["sought"] else None
            r["first"], r["after"] = found or (None, None)
        names = ["path", "length", "start", "end", "first", "after"]
        kinds = [pa.string(), *[pa.int64()] * 5]
        yield pa.record_batch([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)


RANGES = "path string, length long, start long, end long, first long, after long"


def record_ranges(files: DataFrame, split_bytes: int) -> DataFrame:
    """Byte ranges of files with the first record each one owns.

    Every range seeks its own first record, all at once. A payload that is an archive itself
    may hold true records, so neighbours are compared: where one range's last record ends, the
    next one's first must start. Ranges that disagree are read again from the place that is
    due, until none does; files without such payloads agree at once.
    """
    n = partitions(files.sparkSession)
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    ranges = files.filter("length > 0").select("path", F.col("length").cast("long"), F.explode(starts).alias("start"))
    ranges = ranges.withColumn("end", F.least(F.col("start") + split_bytes, "length"))
    due = F.when(F.col("start") == 0, F.lit(0).cast("long"))
    ranges = ranges.withColumn("due", due).withColumn("sought", F.lit(True)).repartition(n, "path", "start")
    found = materialize(ranges.mapInArrow(_find, RANGES), "warc-ranges")
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        place = F.coalesce(F.max("after").over(earlier), F.lit(0))
        checked = found.withColumn("_place", place)
        checked = checked.withColumn("due", F.when(F.col("_place") < F.col("end"), F.col("_place")))
        wrong = ~F.col("due").eqNullSafe(F.col("first"))
        again = checked.filter(wrong).select("path", "length", "start", "end", "due", F.lit(False).alias("sought"))
        if again.isEmpty():
            return found
        fixed = again.repartition(n, "path", "start").mapInArrow(_find, RANGES)
        found = materialize(checked.filter(~wrong).select(found.columns).union(fixed), "warc-ranges")


def read_warc(files: DataFrame, split_bytes: int = SPLIT_BYTES, keep_payload: bool = True) -> DataFrame:
    """Records of ``path, length`` files, read by byte ranges in as many tasks as needed.

    A range owns the records that start inside; see ``record_ranges``. Digests of stored
    payloads are verified; a damaged member stops the job. Empty files have no records.
    ``member_bytes`` of a file sum to its length.
    """
    ranges = record_ranges(files, split_bytes).filter("first IS NOT NULL")
    n = partitions(files.sparkSession)
    return ranges.repartition(n, "path", "start").mapInArrow(_reader(keep_payload), RECORDS)


# --- pages ---------------------------------------------------------------------------------


def page_records(pages: DataFrame, key: str = "page_id", uri: str = "url", payload: str = "html",
                 least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Archive records of pages; of equal payloads the largest key is stored, the rest revisit it.

    Payloads under ``least_bytes`` and rows without a key are always stored; a null payload is
    empty. Rows that repeat the largest key are each stored.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    light = pages.select(F.col(key).cast("long").alias("k"), F.unhex(F.sha1(body)).alias("digest"), F.octet_length(body).cast("long").alias("size"))
    groups = light.filter((F.col("size") >= least_bytes) & F.col("k").isNotNull())
    groups = groups.groupBy("digest").agg(F.max("k").alias("kept"), F.count("*").alias("n")).filter("n > 1")
    groups = materialize(groups.select(F.hex("digest").alias("name"), "kept", "n"), "warc-groups")
    rows = pages.select(
        F.col(key).cast("long").alias("k"), F.col(uri).alias("uri"), body.alias("payload"),
        F.unhex(F.sha1(body)).alias("digest"), F.octet_length(body).cast("long").alias("size"),
    ).withColumn("name", F.when((F.col("size") >= least_bytes) & F.col("k").isNotNull(), F.hex("digest")))
    rows = attach(rows, groups, "name", "n", pages.count(), F.xxhash64("k", "name", "uri"))
    again = F.col("kept").isNotNull() & (F.col("kept") > F.col("k"))
    return rows.select(
        F.when(again, "revisit").otherwise("response").alias("kind"),
        _page_urn(F.col("k")).alias("record_id"),
        "uri",
        F.when(again, _page_urn(F.col("kept"))).alias("refers_to"),
        "digest",
        "size",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def _page_urn(key: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(key.cast("string"), F.lit("none")))


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None,
                  split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Writes pages to archives and returns what the archives say about each.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to, url``. Rows without a key
    come back with a null ``page_id``. An empty table writes no file and returns no row.
    """
    folder = folder or fresh_path(spark, "warc")
    files = write_warc(page_records(pages), folder)
    found = read_warc(files, split_bytes, keep_payload=False)

    def number(name: str) -> Column:
        return F.expr(f"try_cast(substring({name}, {len('urn:page:') + 1}) as bigint)")

    return found.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"), F.col("target_uri").alias("url"),
    )
