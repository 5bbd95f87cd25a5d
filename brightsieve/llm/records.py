"""Token ids as length-delimited binary records, with an index file for reads in any order.

A data file is a run of frames: the payload's length (8 bytes), the masked
checksum of those 8 bytes, the payload, its masked checksum; all integers are
little-endian. A checksum is zlib's CRC-32, masked by a rotation of 15 bits and
a constant, so that a checksum over data that holds checksums stays useful. A
payload is a document's id, the width of a token id in bytes, the count, and
the ids. Beside each data file lies an index of fixed-size entries (id, offset
of the frame, count, ids before it in the file), so that any record is read
with one seek.

Files are in ascending order of document id over all files: rows are range
partitioned and sorted, each task writes its own files under a name of its own
attempt, and the manifest names the files of the attempts that succeeded. The
manifest has one row per file of up to FILE_BYTES; only it reaches the driver.

Defined cases: a null text is empty and has the end id alone; a null id comes
first; rows with equal ids are in order of their texts' hash, equal rows in any
order; an empty table writes no file. Other columns aren't read.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightsieve.llm.base import lean, new_path, slices, written
from brightsieve.llm.bpe import pieces, tokenizer_path

FILE_BYTES = 128 << 20
#: Bytes that a task holds before it writes or after it reads; texts are encoded GROUP_BYTES at once.
BUFFER = 2 << 20
GROUP_BYTES = 1 << 19
MASK = 0xA282EAD8
_LENGTH, _SUM = struct.Struct("<Q"), struct.Struct("<I")
_PAYLOAD = struct.Struct("<?qBI")
_ENTRY = np.dtype([("has_id", "?"), ("doc_id", "<i8"), ("offset", "<u8"), ("count", "<u4"), ("before", "<u8")])


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = _LENGTH.pack(len(payload))
    return b"".join((size, _SUM.pack(masked(size)), payload, _SUM.pack(masked(payload))))


def unframe(data: bytes, at: int = 0) -> tuple[bytes, int]:
    """The payload of the frame at ``at`` and where the next begins; ValueError if a checksum fails."""
    size = data[at : at + 8]
    if len(size) < 8 or _SUM.unpack_from(data, at + 8)[0] != masked(size):
        raise ValueError(f"damaged length at {at}")
    start, end = at + 12, at + 12 + _LENGTH.unpack(size)[0]
    payload = data[start:end]
    if len(data) < end + 4 or _SUM.unpack_from(data, end)[0] != masked(payload):
        raise ValueError(f"damaged record at {at}")
    return payload, end + 4


def _opened(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri)


class Writer:
    """One data file and its index."""

    def __init__(self, folder: str, name: str):
        self.uri = f"{folder}/{name}.rec"
        fs, path = _opened(folder)
        fs.create_dir(path, recursive=True)
        self.data, self.index = fs.open_output_stream(f"{path}/{name}.rec"), fs.open_output_stream(f"{path}/{name}.idx")
        self.held, self.waiting, self.offset, self.ids, self.entries, self.count = [], 0, 0, 0, [], 0

    def add(self, doc_id: int | None, packed: bytes, width: int) -> None:
        count = len(packed) // width
        framed = frame(_PAYLOAD.pack(doc_id is not None, doc_id or 0, width, count) + packed)
        self.entries.append((doc_id is not None, doc_id or 0, self.offset, count, self.ids))
        self.held.append(framed)
        self.offset, self.ids, self.count, self.waiting = self.offset + len(framed), self.ids + count, self.count + 1, self.waiting + len(framed)
        if self.waiting >= BUFFER:
            self.flush()

    def flush(self) -> None:
        self.data.write(b"".join(self.held))
        self.index.write(np.array(self.entries, _ENTRY).tobytes())
        self.held, self.entries, self.waiting = [], [], 0

    def close(self) -> tuple[str, int, int]:
        self.flush()
        self.data.close()
        self.index.close()
        return self.uri, self.count, self.ids


def write(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int, int, int]]:
    """Writes all rows; the manifest: (file, records, ids, ids in all files before), in order."""

    @lean
    def run(batches):
        from pyspark import TaskContext

        known, part = pieces(path), TaskContext.get().partitionId()
        end, out, made = known.pack([end_id]), None, []
        for some in (s for batch in batches for s in slices(batch, 1, GROUP_BYTES)):
            texts = [t or "" for t in some.column(1).to_pylist()]
            for key, packed in zip(some.column(0).to_pylist(), known.many(texts)):
                if out is None:
                    out = Writer(folder, f"{part:06d}-{len(made):04d}-{uuid.uuid4().hex[:12]}")
                out.add(key, packed + end, known.width)
                if out.offset >= FILE_BYTES:
                    made.append(out.close())
                    out = None
        known.forget()
        if out is not None:
            made.append(out.close())
        rows = [(part, k, *m) for k, m in enumerate(made)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], ["part", "seq", "file", "records", "ids"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
        F.xxhash64(text_col).alias("hash"), F.monotonically_increasing_id().alias("row"),  # so that equal ids can be dealt over tasks
    )
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, "id", "hash", "row").sortWithinPartitions("id", "hash", "row").select("id", "text")
    manifest = written(ordered.mapInArrow(run, "part long, seq long, file string, records long, ids long"), "manifest")
    found, before = [], 0
    for r in sorted(manifest.collect()):
        found.append((r.file, r.records, r.ids, before))
        before += r.ids
    return found


def _entries(uri: str) -> np.ndarray:
    fs, path = _opened(uri)
    with fs.open_input_stream(path.removesuffix(".rec") + ".idx") as f:
        return np.frombuffer(f.read(), _ENTRY)


def read_record(uri: str, number: int) -> tuple[int | None, np.ndarray]:
    """One record of a file by its place, through the index: id and token ids."""
    entry = _entries(uri)[number]
    fs, path = _opened(uri)
    with fs.open_input_file(path) as f:
        f.seek(int(entry["offset"]))
        head = f.read(12)
        rest = f.read(_LENGTH.unpack(head[:8])[0] + 4)
    return _ids(unframe(head + rest)[0])


def _ids(payload: bytes) -> tuple[int | None, np.ndarray]:
    has_id, doc_id, width, count = _PAYLOAD.unpack_from(payload)
    return doc_id if has_id else None, np.frombuffer(payload, f"<u{width}", count, _PAYLOAD.size)


def read(spark: SparkSession, manifest: list[tuple[str, int, int, int]], with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every record of the files, checksums verified."""

    @lean
    def run(batches):
        for batch in batches:
            for uri, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                entries = _entries(uri)
                fs, path = _opened(uri)
                with fs.open_input_file(path) as f:
                    size = f.size()
                    stops = np.r_[entries["offset"][1:].astype(np.int64), size]
                    at = 0
                    while at < len(entries):
                        begin = int(entries["offset"][at])
                        to = max(at + 1, int(np.searchsorted(stops, begin + BUFFER, "right")))
                        f.seek(begin)
                        data, rows, place = f.read(int(stops[to - 1]) - begin), [], 0
                        for e in entries[at:to]:
                            payload, place = unframe(data, place)
                            key, ids = _ids(payload)
                            if len(ids) != e["count"]:
                                raise ValueError(f"{uri}: the index and the record at {e['offset']} differ")
                            ids = ids.astype("<u4")
                            rows.append((key, before + int(e["before"]), len(ids), zlib.crc32(ids.tobytes()), *([ids.astype(np.int32)] if with_ids else [])))
                        at = to
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(list(c), k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())))],
                            ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(rows[0])],
                        )

    files = spark.createDataFrame([(f, b) for f, _, _, b in manifest], "file string, before long").repartition(max(1, len(manifest)))
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


#: Appended to each document in the registered query.
END_ID = 2


def op8_records(spark, sf_dir: str) -> DataFrame:
    manifest = write(spark.read.parquet(f"{sf_dir}/documents.parquet"), new_path(spark, "records"), tokenizer_path(), END_ID)
    return read(spark, manifest)
