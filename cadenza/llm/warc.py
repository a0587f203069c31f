"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding whole WARC
records, closed by a skippable frame with the seek table (compressed and plain
size of each frame) in the seekable format's layout.  A reader needs the
footer and one frame to get at a record; the index maps a record's identifier
to its bundle, frame and offset in the frame.

Records with equal payloads of at least ``MIN_SHARED`` bytes are written once:
the one with the largest id is a response, the others are revisits without
payload that refer to it.

Plan: digests are built-in functions; the response of a digest is found by an
aggregation over (digest, size) with map-side maxima and joined back (Spark
splits the join where a digest is hot).  Tasks stream their records into
frames of ``FRAME_BYTES`` and bundles of ``BUNDLE_BYTES`` plain bytes, so
memory holds a frame and never a group.  Bundles go to the shared folder under
names that no other attempt uses; only those named by the committed index
table are read, so a task that is run again leaves an orphan and no double.

Defined results: a null payload is empty; rows of one digest that share the
largest id are all responses; a row without id is a response (identified by
its digest); repeated rows are records of their own, told apart by bundle,
frame and offset; an empty table gives an empty index and no archive; a payload
longer than a frame is a frame of its own; only id, address and payload are read,
so other columns' names cannot clash.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored
from cadenza.session import checkpoint_dir

MIN_SHARED = 1000
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of addresses (RFC 4122)
_EPOCH = "1970-01-01T00:00:00Z"


def record_id(page_id: int | None, digest: str) -> str:
    name = f"page:{page_id}" if page_id is not None else f"payload:{digest}"
    return f"<urn:uuid:{uuid.uuid5(_SPACE, name)}>"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit without.

    The page id and the full payload's size stand in headers of their own, so
    that a revisit can be read without its response."""
    # the block of a record is the payload itself (content type application/octet-stream, no HTTP head)
    block = b"" if refers_to is not None else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {_EPOCH}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {size}",
    ]
    if url:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url))
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if refers_to is not None:
        head += [
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"WARC-Refers-To-Page-ID: {refers_to}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head += ["Content-Type: application/octet-stream", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(plain: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of the records in a frame from ``at`` on."""
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at)
        first, *rest = plain[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = dict(x.split(": ", 1) for x in rest)
        size = int(headers["Content-Length"])
        yield at, headers, plain[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The footer: a skippable frame of (compressed, plain) sizes, their count,
    a descriptor (no checksums) and the magic number."""
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


def frames(file) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of a bundle's frames, from its footer."""
    size = file.size()
    file.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != _SEEKABLE or flags & 0x80:
        raise ValueError("no seek table without checksums at the end")
    file.seek(size - 9 - 8 * n)
    sizes = [struct.unpack("<II", file.read(8)) for _ in range(n)]
    out, at = [], 0
    for packed, plain in sizes:
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(file, at: tuple[int, int, int]) -> bytes:
    start, packed, plain = at
    file.seek(start)
    return zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain) if plain else b""


def _open(path: str):
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)


def _uri(path: str) -> str:
    """``file:/x`` (as Hadoop writes it) as ``file:///x``."""
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


class _Bundle:
    """Writes records to one bundle; ``index`` gets (page_id, record_id, bundle, frame, offset, length)."""

    def __init__(self, path: str, index: list):
        where, inside = _open(path)
        self.path, self.index, self.out = path, index, where.open_output_stream(inside, compression=None)
        self.sizes, self.buffer, self.total = [], bytearray(), 0

    def add(self, page_id, digest: str, data: bytes) -> None:
        self.index.append((page_id, record_id(page_id, digest), self.path, len(self.sizes), len(self.buffer), len(data)))
        self.buffer += data
        self.total += len(data)

    def flush(self) -> None:
        if self.buffer:
            packed = zstandard.ZstdCompressor(level=3).compress(bytes(self.buffer))
            self.out.write(packed)
            self.sizes.append((len(packed), len(self.buffer)))
            self.buffer = bytearray()

    def close(self) -> None:
        self.flush()
        self.out.write(seek_table(self.sizes))
        self.out.close()


#: Frames that a reading task takes at most, about, and frames in a row that one task reads.
TASK_FRAMES, RUN_FRAMES = 256, 8

INDEX = "page_id long, record_id string, bundle string, frame int, offset long, length long"


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_shared: int = MIN_SHARED, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write the archives; the index (page_id, record_id, bundle, frame, offset, length)."""
    spark = pages.sparkSession
    folder = _uri(folder or checkpoint_dir(spark, "warc"))
    where, inside = _open(folder)
    where.create_dir(inside, recursive=True)

    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("digest")
    )
    shared = (
        rows.where(F.col("size") >= min_shared)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("of"), F.col("size").alias("of_size"), "first")
    )
    revisit = F.when(F.col("page_id") < F.col("first"), F.col("first"))
    typed = rows.join(stored(shared, "shared"), (F.col("digest") == F.col("of")) & (F.col("size") == F.col("of_size")), "left").select(
        "page_id", "url", F.when(revisit.isNull(), F.col("payload")).alias("payload"), "size", "digest", revisit.alias("refers_to")
    )

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, index = None, []

        def told() -> Iterator[pa.RecordBatch]:
            if index:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(index, columns=[x.split()[0] for x in INDEX.split(", ")]).astype({"page_id": "Int64", "frame": "int32"}), preserve_index=False)
                index.clear()

        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(6))):
                page_id, url, data, size, digest, refers = (x.as_py() for x in row)
                if bundle is None:
                    bundle = _Bundle(f"{folder}/{uuid.uuid4().hex}.warc.zst", index)
                bundle.add(page_id, digest, record(page_id, url, data or b"", size, digest, refers))
                if len(bundle.buffer) >= frame_bytes:
                    bundle.flush()
                if bundle.total >= bundle_bytes:
                    bundle.close()
                    bundle = None
                    yield from told()
        if bundle is not None:
            bundle.close()
        yield from told()

    return stored(typed.mapInArrow(put, INDEX), "warc-index")


RECORDS = "page_id long, record_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to long, payload binary, bundle string, frame int, offset long"


def read(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the frames that ``index`` names, each read through its
    bundle's seek table; responses are checked against their digests.  Frames
    are dealt out over at least as many tasks as there are shuffle partitions,
    and over more where frames are many."""

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, part in batch.groupby("bundle"):
                where, inside = _open(path)
                with where.open_input_file(inside) as file:
                    places = frames(file)
                    for k in sorted(set(part["frame"].tolist())):
                        at, out = places[k], []
                        for offset, h, block in parsed(read_frame(file, at)):
                            digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                            if h["WARC-Type"] == "response" and (len(block) != int(h["WARC-Payload-Length"]) or hashlib.sha1(block).hexdigest() != digest):
                                raise ValueError(f"{path}, frame {k}: the payload does not fit its digest")
                            page, refers = h.get("WARC-Page-ID"), h.get("WARC-Refers-To-Page-ID")
                            out.append((
                                int(page) if page else None, h["WARC-Record-ID"], h["WARC-Type"], h.get("WARC-Target-URI"), int(h["WARC-Payload-Length"]), digest,
                                int(refers) if refers else None, block if payloads and h["WARC-Type"] == "response" else None, path, k, offset,
                            ))
                        yield pd.DataFrame(out, columns=[x.split()[0] for x in RECORDS.split(", ")]).astype({"page_id": "Int64", "refers_to": "Int64"})

    named = index.select("bundle", "frame").distinct()
    tasks = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-named.count() // TASK_FRAMES))
    return named.repartition(tasks, "bundle", F.floor(F.col("frame") / RUN_FRAMES)).mapInPandas(get, RECORDS)


def lookup(index: DataFrame) -> DataFrame:
    """The blocks of the indexed records, each read from its own frame only:
    (page_id, record_id, record_type, payload)."""

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (path, k), part in batch.groupby(["bundle", "frame"]):
                where, inside = _open(path)
                with where.open_input_file(inside) as file:
                    plain = read_frame(file, frames(file)[k])
                out = []
                for r in part.itertuples():
                    _, h, block = next(parsed(plain, int(r.offset)))
                    out.append((r.page_id, h["WARC-Record-ID"], h["WARC-Type"], block))
                yield pd.DataFrame(out, columns=["page_id", "record_id", "record_type", "payload"]).astype({"page_id": "Int64"})

    return index.mapInPandas(get, "page_id long, record_id string, record_type string, payload binary")
