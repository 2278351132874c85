"""Token ids as length-delimited binary records with an offset index."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialise, shared_path
from quarry.llm.crc32c import crc32c, masked
from quarry.llm.files import open_folder
from quarry.llm.tokens import tokenizer
from quarry.llm.words import text_runs

#: A record: 64-bit length, masked CRC-32C of it, payload, masked CRC-32C of the payload.
#: The payload: 64-bit id, 1 if there is an id, bytes per token id (2 or 4), the token ids.
_HEAD = struct.Struct("<qBB")
_INDEX = "file string, part long, nth long, position long, bytes long, id long, n_tokens long"


def _payload(key: int | None, width: int, ids: bytes) -> bytes:
    return _HEAD.pack(key or 0, key is not None, width) + ids


def _frames(payloads: list[bytes]) -> list[bytes]:
    sizes = np.array([len(p) for p in payloads], "<u8")
    of_data = masked(crc32c(np.frombuffer(b"".join(payloads), np.uint8), sizes)).astype("<u4")
    of_size = masked(crc32c(np.frombuffer(sizes.tobytes(), np.uint8), np.full(len(sizes), 8))).astype("<u4")
    return [b"".join((n.tobytes(), a.tobytes(), p, b.tobytes())) for n, a, p, b in zip(sizes, of_size, payloads, of_data)]


def write_records(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize, write record files in ascending id order, return their index.

    The rows are range-partitioned by id (ties by text hash, so a repeated id
    does not fill one range) and each task writes one file into the shared
    folder under a name of its attempt; the index, written as a table, names
    only files of attempts that ended well, so a lost executor leaves at most
    an orphaned file.  Null ids come first.

    Returns the index: file, part (files in id order), nth (record in the
    file), position, bytes, id, n_tokens.
    """
    folder = shared_path(docs.sparkSession, "records")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    dealt = rows.repartitionByRange(F.col("id"), tie).sortWithinPartitions(F.col("id"), tie)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        file = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}.rec"
        store, path = open_folder(file)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        encode = tokenizer(vocabulary).encode
        position = nth = 0
        with store.open_output_stream(path) as out:
            for batch in batches:
                keys = batch.column("id").to_pylist()
                for lo, hi, data, offsets in text_runs(batch.column("text")):
                    ids, at = encode(data, offsets)
                    width = 2 if len(ids) == 0 or int(ids.max()) < 1 << 16 and end_id < 1 << 16 else 4
                    ids, end = ids.astype(f"<u{width}"), end_id.to_bytes(width, "little")
                    payloads = [_payload(k, width, ids[at[d]:at[d + 1]].tobytes() + end) for d, k in enumerate(keys[lo:hi])]
                    frames = _frames(payloads)
                    out.write(b"".join(frames))
                    size = np.array([len(f) for f in frames], np.int64)
                    first = position + np.cumsum(size) - size
                    m = len(frames)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file] * m), pa.array([context.partitionId()] * m, pa.int64()), pa.array(np.arange(nth, nth + m)),
                         pa.array(first), pa.array(size), pa.array(keys[lo:hi], pa.int64()), pa.array(np.diff(at) + 1)],
                        names=["file", "part", "nth", "position", "bytes", "id", "n_tokens"])
                    position, nth = position + int(size.sum()), nth + m

    return materialise(dealt.mapInArrow(write, _INDEX), "record-index")


def _payloads(raw: bytes, file: str) -> tuple[list[bytes], int]:
    """Whole records at the start of ``raw``, checked, and the bytes they take."""
    at, out, sums, sizes = 0, [], [], []
    while at + 16 <= len(raw):
        n = int.from_bytes(raw[at:at + 8], "little")
        if at + 16 + n > len(raw):
            break
        sizes.append(raw[at:at + 12])
        out.append(raw[at + 12:at + 12 + n])
        sums.append(int.from_bytes(raw[at + 12 + n:at + 16 + n], "little"))
        at += 16 + n
    if out:
        heads = np.frombuffer(b"".join(s[:8] for s in sizes), np.uint8)
        want = np.frombuffer(b"".join(s[8:] for s in sizes), "<u4")
        lengths = [len(p) for p in out]
        if (masked(crc32c(heads, np.full(len(out), 8))) != want).any() or (
                masked(crc32c(np.frombuffer(b"".join(out), np.uint8), lengths)) != np.array(sums, np.uint32)).any():
            raise OSError(f"{file}: a record does not match its checksum")
    return out, at


def _decode(payload: bytes) -> tuple[int | None, bytes]:
    key, there, width = _HEAD.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{width}", offset=_HEAD.size)
    return key if there else None, ids.astype("<u4").tobytes()


def read_records(spark: SparkSession, index: DataFrame, buffer: int = 8 << 20) -> DataFrame:
    """Read whole record files back in their order, one task per file.

    The file names are few bytes, so the number of tasks is given and not left
    to the sizes of partitions.  Every frame's two checksums are verified.  The number of ids before each
    file is summed from the index over its files, one row per file.

    Returns id, start (ids of all records before it), n_tokens, ids
    (little-endian unsigned 32-bit).
    """
    files = index.groupBy("file", "part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("file", F.coalesce(before, F.lit(0)).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(*(c.to_pylist() for c in batch.columns)):
                store, path = open_folder(file)
                with store.open_input_stream(path) as src:
                    rest = b""
                    while True:
                        more = src.read(buffer)
                        found, used = _payloads(rest + more, file)
                        rest = (rest + more)[used:]
                        if found:
                            keys, ids = zip(*map(_decode, found))
                            n = np.array([len(x) // 4 for x in ids], np.int64)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(keys, pa.int64()), pa.array(start + np.cumsum(n) - n), pa.array(n), pa.array(ids, pa.binary())],
                                names=["id", "start", "n_tokens", "ids"])
                            start += int(n.sum())
                        if not more:
                            break
                    if rest:
                        raise OSError(f"{file}: it ends inside a record")

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "file").mapInArrow(read, "id long, start long, n_tokens long, ids binary")


def read_shuffled(index: DataFrame, seed: int = 0) -> DataFrame:
    """Records in a random order: index rows are dealt by a seeded hash, and each is range-read by its position.

    Returns id, ids.
    """
    place = F.xxhash64(F.lit(seed), "file", "position")
    dealt = index.select("file", "position", "bytes", place.alias("place")).repartitionByRange("place").sortWithinPartitions("place")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            out = []
            for file, position, size in zip(*(batch.column(c).to_pylist() for c in ("file", "position", "bytes"))):
                if file not in opened:
                    if len(opened) >= 64:
                        opened.pop(next(iter(opened))).close()
                    store, path = open_folder(file)
                    opened[file] = store.open_input_file(path)
                found, _ = _payloads(bytes(opened[file].read_at(size, position)), file)
                out.append(_decode(found[0]))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([i for _, i in out], pa.binary())], names=["id", "ids"])

    return dealt.mapInArrow(read, "id long, ids binary")
