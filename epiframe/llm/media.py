"""Media columns: content-addressed payloads in tar shards.

A task writes its payloads to a tar shard of its own in shared storage, each once under its digest. Payloads never go through a
shuffle, so one that many tasks hold is stored by each of them; a digest's place is the first of these, and all its rows
carry this digest, shard, offset and length. Metadata columns are filled by range reads of the
headers, and features by range reads of whole payloads, once a digest, dealt by shard and range.

A shard is renamed to its final name when it is whole and named for its attempt, so a task that runs twice leaves
a shard that no row names. The index is a written table.

Texts become 8-bit greyscale PNG pictures, 576 bytes a row, padded with bytes 255; PNG is lossless.

Defined results: a null text is empty and is one row of padding; a null id stays null; repeated rows are
repeated and share a payload; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import new_path, staged

WIDTH = 576
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
HEADER_BYTES = 33
_INDEX = "n_bytes long, digest string, shard string, offset long, length long"
_PLACE = "digest string, shard string, offset long, length long"


def pad(data: bytes, unit: int = WIDTH) -> bytes:
    return data + b"\xff" * (-len(data) % unit or (0 if data else unit))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes) -> bytes:
    rows = np.frombuffer(payload, dtype=np.uint8).reshape(-1, WIDTH)
    raw = np.hstack([np.zeros((len(rows), 1), np.uint8), rows]).tobytes()
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw, 6)) + _chunk(b"IEND", b"")


def png_header(head: bytes) -> tuple[int, int, int]:
    """Width, height and bits of a sample, from the first 33 bytes."""
    if head[:8] != _SIGNATURE or head[12:16] != b"IHDR":
        raise ValueError("not a PNG picture")
    return struct.unpack(">IIB", head[16:25])


def from_png(png: bytes) -> bytes:
    """The samples of a greyscale picture whose rows are unfiltered, as ``to_png`` writes them."""
    width, height, _ = png_header(png)
    at, body = 8, b""
    while at < len(png):
        (n,) = struct.unpack(">I", png[at : at + 4])
        kind, part = png[at + 4 : at + 8], png[at + 8 : at + 8 + n]
        if zlib.crc32(kind + part) != struct.unpack(">I", png[at + 8 + n : at + 12 + n])[0]:
            raise ValueError(f"damaged {kind!r} chunk")
        body += part if kind == b"IDAT" else b""
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(body), dtype=np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("filtered rows")
    return rows[:, 1:].tobytes()


def brightness_print(payload: bytes, cells: int = 64) -> str:
    """64-bit average hash over 64 vertical bands of the picture, as 16 hexadecimal digits."""
    bands = np.frombuffer(payload, dtype=np.uint8).reshape(-1, cells, WIDTH // cells).sum(axis=(0, 2), dtype=np.int64)
    return np.packbits(bands * cells > bands.sum()).tobytes().hex()


class ShardWriter:
    """Writes members to ``folder``; ``add`` gives shard, offset and length. Close it to make the shard visible."""

    def __init__(self, folder: str, name: str):
        self.fs, root = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(root, recursive=True)
        self.path, self.uri = f"{root}/{name}.tar", f"{folder}/{name}.tar"
        self.out, self.at, self.where = self.fs.open_output_stream(f"{self.path}.part"), 0, {}

    def add(self, digest: str, suffix: str, make) -> tuple[str, int, int]:
        if digest not in self.where:
            data = make()
            info = tarfile.TarInfo(digest + suffix)
            info.size = len(data)
            head = info.tobuf(tarfile.PAX_FORMAT)
            self.out.write(head + data + b"\0" * (-len(data) % 512))
            self.where[digest] = (self.uri, self.at + len(head), len(data))
            self.at += len(head) + len(data) + -len(data) % 512
        return self.where[digest]

    def close(self) -> None:
        self.out.write(b"\0" * 1024)
        self.out.close()
        self.fs.move(f"{self.path}.part", self.path)


class RangeReader:
    """Range reads with the last shard kept open."""

    def __init__(self):
        self.uri, self.file = None, None

    def read(self, uri: str, offset: int, length: int) -> bytes:
        if uri != self.uri:
            if self.file:
                self.file.close()
            fs, path = pafs.FileSystem.from_uri(uri)
            self.uri, self.file = uri, fs.open_input_file(path)
        return self.file.read_at(length, offset)


def store_texts(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = 256 << 20) -> DataFrame:
    """Write every text's picture into tar shards under ``folder``; the index has a row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count, shard, held = TaskContext.get(), 0, None, []

        def rows() -> pa.RecordBatch:
            shard.close()
            ids = pa.concat_arrays([h[0] for h in held])
            cols = list(zip(*(x for h in held for x in h[1])))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(cols, kinds))], ["id", "n_bytes", "digest", "shard", "offset", "length"])

        for b in batches:
            if not len(b):
                continue
            if shard is None:
                shard, held = ShardWriter(folder, f"shard-{task.partitionId():06d}-{task.taskAttemptId()}-{count}"), []
            found = []
            for t in b.column(1):
                data = (t.as_py() or "").encode()
                digest = hashlib.sha256(data).hexdigest()
                found.append((len(data), digest, *shard.add(digest, ".png", lambda data=data: to_png(pad(data)))))
            held.append((b.column(0), found))
            if shard.at >= shard_bytes:
                yield rows()
                shard, count = None, count + 1
        if shard is not None:
            yield rows()

    kind = docs.schema[id_col].dataType.simpleString()
    return staged(docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, {_INDEX}"), "media-index")


def places(index: DataFrame) -> DataFrame:
    """``digest, shard, offset, length``: one place of each payload."""
    first = index.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("p"))
    return staged(first.select("digest", "p.*"), "media-places")


def by_range(index: DataFrame, range_bytes: int = 16 << 20) -> DataFrame:
    """Places dealt by shard and range, in reading order, in as many parts as its bytes need."""
    total = index.agg(F.sum("length")).first()[0] or 0
    parts = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // range_bytes))
    return index.repartition(int(parts), "shard", F.floor(F.col("offset") / range_bytes)).sortWithinPartitions("shard", "offset")


def with_headers(index: DataFrame) -> DataFrame:
    """The places plus ``width, height, bits``, from reads of the 33 header bytes of each payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RangeReader()
        for b in batches:
            found = [png_header(reader.read(*place, HEADER_BYTES)) for place in zip(b.column("shard").to_pylist(), b.column("offset").to_pylist())]
            cols = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, pa.int32()) for c in cols)], [*b.schema.names, "width", "height", "bits"])

    return index.mapInArrow(run, f"{_PLACE}, width int, height int, bits int")


def with_features(index: DataFrame) -> DataFrame:
    """The places plus figures and features of the payloads, read back whole from the shards."""
    more = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    names = [x.split()[0] for x in more.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RangeReader()
        for b in batches:
            found = []
            for place in zip(*(b.column(c).to_pylist() for c in ("shard", "offset", "length"))):
                png = reader.read(*place)
                payload = from_png(png)
                found.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(png), hashlib.sha256(png).hexdigest(), brightness_print(payload)))
            cols = list(zip(*found)) or [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, k) for c, k in zip(cols, kinds))], [*b.schema.names, *names])

    return index.mapInArrow(run, f"{_PLACE}, width int, height int, bits int, {more}")


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Store the texts and return a row each with place, header columns and features."""
    index = store_texts(docs, folder or new_path(docs.sparkSession, "media"), id_col, text_col)
    # written, so that AQE can split the join on a payload that a third of all rows have
    found = staged(with_features(with_headers(by_range(places(index)))), "media-features")
    return index.select(F.col("id").alias(id_col), "n_bytes", "digest").join(found, "digest").select(id_col, "n_bytes", *found.columns)
