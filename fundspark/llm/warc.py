"""WARC archives as seekable Zstandard bundles.

A bundle holds WARC records in order. Records are grouped into frames that decompress on their
own; a skippable frame at the end holds the seek table: compressed and decompressed size of every
frame, the number of frames and a magic number. The index maps a record to bundle, frame and the
offset within the decompressed frame, so one record costs one frame.

Bundles are written by tasks under names made from what they hold; a file appears under its name
only when complete, so a task that runs twice leaves the same bundle.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.operators.lineage import materialise, work_path

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

FRAME_BYTES = 512 << 10
BUNDLE_BYTES = 16 << 20
DATE = "1970-01-01T00:00:00Z"
INDEX_SCHEMA = "record_id string, page_id long, bundle string, frame int, frame_offset long, record_bytes long"
READ_SCHEMA = (
    "record_id string, page_id long, bundle string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to long, body_bytes long, body_digest string"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, occurrence: str) -> str:
    """A name of its own for every record; ``occurrence`` tells rows that repeat a page apart."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{occurrence}')}>"


def warc_record(
    kind: str,
    name: str,
    page_id: int | None,
    url: str | None,
    payload: bytes,
    digest: str,
    refers_to: int | None,
) -> bytes:
    """One WARC/1.1 record. A revisit names the page it repeats and carries no payload."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {' '.join(url.split())}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"X-Refers-To-Page: {refers_to}")
    body = b"" if kind == "revisit" else payload
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *pair) for pair in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    body = entries + footer
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """``(start, compressed size, decompressed size)`` of every frame."""
    count, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if flags & 0x80 else 8
    at, start, frames = len(bundle) - 9 - count * width, 0, []
    for i in range(count):
        packed, size = struct.unpack_from("<II", bundle, at + i * width)
        frames.append((start, packed, size))
        start += packed
    return frames


class BundleWriter:
    """Collects records into frames and frames into one bundle in memory, of bounded size."""

    def __init__(self, level: int):
        import zstandard

        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.open_bytes = 0
        self.total = 0

    def add(self, record: bytes) -> tuple[int, int]:
        place = len(self.frames), self.open_bytes
        self.open.append(record)
        self.open_bytes += len(record)
        self.total += len(record)
        if self.open_bytes >= FRAME_BYTES:
            self.close_frame()
        return place

    def close_frame(self) -> None:
        if self.open:
            packed = self.compressor.compress(b"".join(self.open))
            self.frames.append(packed)
            self.sizes.append((len(packed), self.open_bytes))
            self.open, self.open_bytes = [], 0

    def finish(self) -> bytes:
        self.close_frame()
        return b"".join(self.frames) + seek_table(self.sizes)


def _store(folder: str, name: str, content: bytes) -> None:
    """Write under another name first; the rename makes the bundle appear whole."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    attempt = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(attempt) as out:
        out.write(content)
    system.move(attempt, f"{path}/{name}")


def _write(folder: str, level: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, rows, seen = BundleWriter(level), [], hashlib.sha1()
        # Repeats of one row may be in any task; its number and the place in it tell them apart.
        task, place = TaskContext.get().partitionId(), 0

        def flush() -> pd.DataFrame:
            name = f"{seen.hexdigest()[:24]}.warc.zst"
            _store(folder, name, writer.finish())
            out = pd.DataFrame(rows, columns=["record_id", "page_id", "frame", "frame_offset", "record_bytes"])
            out.insert(2, "bundle", name)
            return out.astype({"page_id": "Int64"})

        for batch in batches:
            # Nullable ids arrive as floats where one is missing; the text form is exact.
            for page, row, url, html, refers in zip(
                batch["page"], batch["row"], batch["url"], batch["html"], batch["refers"], strict=True
            ):
                page_id = None if page is None else int(page)
                payload = (html or "").encode("utf-8", "surrogatepass")
                name = record_id(page_id, f"{row}/{task}/{place}")
                place += 1
                kind = "response" if refers is None else "revisit"
                record = warc_record(
                    kind, name, page_id, url, payload, base32_sha1(payload),
                    None if refers is None else int(refers),
                )
                rows.append((name, page_id, *writer.add(record), len(record)))
                seen.update(name.encode() + hashlib.sha1(record).digest())
                if writer.total >= BUNDLE_BYTES:
                    yield flush()
                    writer, rows = BundleWriter(level), []
        if rows:
            yield flush()

    return run


def plan_records(
    pages: DataFrame,
    *,
    min_payload_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    salts: int = 32,
) -> DataFrame:
    """Pages with ``refers``: the page whose equal payload each one repeats, else NULL.

    Payloads of ``min_payload_bytes`` or more are grouped by SHA-1 and length; only these travel.
    Groups are spread over ``salts``, as one payload may be that of most pages.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    raw = html.cast("binary")
    base = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        html.alias("html"),
        F.sha1(raw).alias("digest"),
        F.length(raw).alias("size"),
    )
    groups = base.where(F.col("size") >= min_payload_bytes).groupBy("digest", "size").agg(
        F.max("id").alias("keeper"), F.count(F.lit(1)).alias("copies")
    )
    groups = groups.where("copies > 1 and keeper is not null")
    salt = F.pmod(F.xxhash64("id", "url"), F.lit(salts)).cast("int")
    spread = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = base.withColumn("salt", salt).join(
        spread.select("digest", "size", "salt", "keeper"), ["digest", "size", "salt"], "left"
    )
    other = F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("id"))
    # Rows that repeat a page are told apart by what they hold.
    row = F.concat_ws("/", F.col("digest"), F.coalesce(F.md5(F.col("url").cast("binary")), F.lit("-")))
    return joined.select(
        F.col("id").cast("string").alias("page"),
        row.alias("row"),
        "url",
        "html",
        F.when(other, F.col("keeper").cast("string")).alias("refers"),
    )


def write_archives(
    pages: DataFrame, folder: str | None = None, *, level: int = 3, min_payload_bytes: int = 0, **columns
) -> tuple[str, DataFrame]:
    """Write all pages; returns the folder and the index of records.

    A NULL html is an empty payload. Of equal payloads the one with the largest page id is the
    response and the others are revisits of it; rows that repeat this largest page are responses
    too. A page without id is written without one: it can be a revisit but is never referred to,
    and if no copy has an id all are responses. No pages: an empty index and no bundle.
    """
    spark = pages.sparkSession
    folder = folder or work_path(spark, "warc")
    if "://" not in folder:
        folder = f"file://{folder}"
    planned = plan_records(pages, min_payload_bytes=min_payload_bytes, **columns)
    index = planned.mapInPandas(_write(folder, level), INDEX_SCHEMA)
    return folder, materialise(index, "warc-index")


def parse_record(frame: bytes, start: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, body and end of the record at ``start`` of a decompressed frame."""
    split = frame.index(b"\r\n\r\n", start)
    lines = frame[start:split].decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not at the start of a record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    body = split + 4
    end = body + int(headers["Content-Length"])
    if frame[end : end + 4] != b"\r\n\r\n":
        raise ValueError("record is cut short")
    return headers, frame[body:end], end + 4


class BundleReader:
    """Frames of one bundle: the seek table at its end, then only what is asked for."""

    def __init__(self, folder: str, bundle: str):
        import zstandard
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(folder)
        self.inflate = zstandard.ZstdDecompressor()
        self.file = system.open_input_file(f"{path}/{bundle}")
        size = self.file.size()
        self.file.seek(size - 9)
        count, flags, _ = struct.unpack("<IBI", self.file.read(9))
        table = 8 + count * (12 if flags & 0x80 else 8) + 9
        self.file.seek(size - table)
        self.frames = read_seek_table(self.file.read(table))

    def __enter__(self) -> BundleReader:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def frame(self, number: int) -> bytes:
        start, packed, size = self.frames[number]
        self.file.seek(start)
        return self.inflate.decompress(self.file.read(packed), max_output_size=size)


def _read(folder: str):
    def run(entries: pd.DataFrame) -> pd.DataFrame:
        rows, bundle = [], entries["bundle"].iloc[0]
        with BundleReader(folder, bundle) as reader:
            for number, of_frame in entries.groupby("frame", sort=True):
                content = reader.frame(int(number))
                for name, at in zip(of_frame["record_id"], of_frame["frame_offset"], strict=True):
                    head, body, _ = parse_record(content, int(at))
                    if head["WARC-Record-ID"] != name:
                        raise ValueError(f"{bundle}: another record lies where the index says")
                    page, refers = head.get("X-Page-ID"), head.get("X-Refers-To-Page")
                    rows.append(
                        (
                            name,
                            None if page is None else int(page),
                            bundle,
                            head["WARC-Type"],
                            head["WARC-Payload-Digest"].removeprefix("sha1:"),
                            int(head["X-Payload-Length"]),
                            None if refers is None else int(refers),
                            len(body),
                            base32_sha1(body),
                        )
                    )
        names = [column.split()[0] for column in READ_SCHEMA.split(", ")]
        out = pd.DataFrame(rows, columns=names)
        return out.astype({"page_id": "Int64", "refers_to": "Int64"})

    return run


def read_archives(spark, folder: str, index: DataFrame) -> DataFrame:
    """Every record that the index names, read at its frame and offset; a frame is inflated once.

    A group is the index of one bundle, which holds about ``BUNDLE_BYTES`` of records. Bundles that
    no index entry names, as a task that ran twice may leave, are not opened. An empty index reads
    nothing.
    """
    return index.groupBy("bundle").applyInPandas(_read(folder), READ_SCHEMA)


def read_record(folder: str, bundle: str, frame: int, frame_offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry: the seek table, then a single frame."""
    with BundleReader(folder, bundle) as reader:
        headers, body, _ = parse_record(reader.frame(frame), frame_offset)
    return headers, body
