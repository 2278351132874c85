"""WARC records in ZIP-packaged archives: writer, directory parser, range reader."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise, shared_path
from quarry.llm.files import open_folder

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_URN = re.compile(r"<urn:page:(-?\d+|none)>")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _page(urn: str) -> int | None:
    found = _URN.fullmatch(urn)[1]
    return None if found == "none" else int(found)


def record(page: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP head and the digest but no payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page)}", f"WARC-Date: {date}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
            f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers (names in lower case), HTTP head and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, http, payload


def directory(store_file, size: int) -> dict[str, tuple[int, int]]:
    """Where the bytes of each stored member lie: name -> (position, bytes).

    Reads the end record, if need be the ZIP64 end record and extra fields,
    the central directory, and the local header of each member; nothing else.
    """
    tail = store_file.read_at(min(size, 65_557 + 20), max(0, size - 65_557 - 20))
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        if tail[at - 20:at - 16] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end = struct.unpack_from("<Q", tail, at - 12)[0]
        count, length, start = struct.unpack_from("<QQQ", store_file.read_at(56, end), 32)
    listing = store_file.read_at(length, start)
    found, at = {}, 0
    for _ in range(count):
        if listing[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", listing, at + 10)
        packed, plain, n, m, k = struct.unpack_from("<IIHHH", listing, at + 20)
        local, = struct.unpack_from("<I", listing, at + 42)
        name = listing[at + 46:at + 46 + n].decode()
        extra, e = listing[at + 46 + n:at + 46 + n + m], 0
        while e + 4 <= len(extra):
            tag, width = struct.unpack_from("<HH", extra, e)
            if tag == 1:  # the 64-bit values of the fields that are full, in this order
                wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, e + 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            e += 4 + width
        if method == 0:
            a, b = struct.unpack_from("<HH", store_file.read_at(30, local), 26)
            found[name] = (local + 30 + a + b, plain)
        at += 46 + n + m + k
    return found


def write_archives(pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write every page as a WARC record into ZIP-packaged archives; returns their paths.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with
    the largest id is a response and the others are revisits of it; rows that
    repeat that id too are all responses.  Null ids are below all others, a
    null html is an empty payload.  Each task writes one archive under a name
    of its attempt: a gzip member for each record, and an index; both are
    stored, so records can be read in place.  Only archives of attempts that
    ended well are named in the returned table (column archive).
    """
    folder = shared_path(pages.sparkSession, "archives")
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("html"),
                        F.unhex(F.sha2(payload, 256)).alias("same"))
    heads = materialise(rows.filter(F.octet_length("html") >= min_bytes).groupBy("same")
                        .agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeated-payloads")
    joined = rows.join(heads.withColumn("again", F.lit(True)), "same", "left")
    revisit = F.col("again").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    typed = joined.select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("head")).alias("head"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        file = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}.wacz"
        store, path = open_folder(file)
        out = None
        index, position = [], 0
        for batch in batches:
            for page, url, html, again, head in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    store.create_dir(path.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(path)
                    packed = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
                    member = packed.open(ARCHIVE, "w", force_zip64=True)
                raw = gzip.compress(record(page, url, html.encode(), "revisit" if again else "response", head, date), 4, mtime=0)
                member.write(raw)
                index.append(f"{_urn(page)} {json.dumps({'offset': position, 'length': len(raw)})}\n")
                position += len(raw)
        if out is None:
            return
        member.close()
        packed.writestr(INDEX, "".join(index))
        packed.close()
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([file])], names=["archive"])

    return materialise(typed.mapInArrow(write, "archive string"), "archive-list")


def locate(archives: DataFrame) -> DataFrame:
    """Every record of the archives: archive, position, bytes (from the stored indexes)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                store, path = open_folder(archive)
                with store.open_input_file(path) as src:
                    members = directory(src, src.size())
                    for name, (at, size) in members.items():
                        if not name.startswith("indexes/"):
                            continue
                        base = members[ARCHIVE][0]
                        lines = src.read_at(size, at).decode().splitlines()
                        spots = [json.loads(x.partition(" ")[2]) for x in lines]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([archive] * len(spots)), pa.array([base + s["offset"] for s in spots], pa.int64()),
                             pa.array([s["length"] for s in spots], pa.int64())], names=["archive", "position", "bytes"])

    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # paths are few bytes: not left to partition sizes
    return archives.repartition(tasks, "archive").mapInArrow(find, "archive string, position long, bytes long")


def _ranges(spots: list[tuple[str, int, int]], most: int) -> Iterator[list[tuple[str, int, int]]]:
    """Neighbouring records of one archive, read together up to ``most`` bytes."""
    run: list[tuple[str, int, int]] = []
    for s in spots:
        if run and (s[0] != run[-1][0] or s[1] != run[-1][1] + run[-1][2] or s[1] + s[2] - run[0][1] > most):
            yield run
            run = []
        run.append(s)
    if run:
        yield run


def read_archives(located: DataFrame, most: int = 4 << 20) -> DataFrame:
    """Range-read located records in place.

    A response's digest is computed anew from its payload and must match the
    stored one.  Returns page_id, url, record_type, refers_to (null for
    responses), payload (null for revisits), payload_bytes, payload_digest
    (bare base-32 SHA-1 of the full payload).
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        names = ["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"]
        opened: tuple[str, fs.FileSystem | None] = ("", None)
        for batch in batches:
            for run in _ranges(list(zip(*(c.to_pylist() for c in batch.columns))), most):
                archive, start = run[0][0], run[0][1]
                if opened[0] != archive:
                    store, path = open_folder(archive)
                    opened = (archive, store.open_input_file(path))
                raw = opened[1].read_at(run[-1][1] + run[-1][2] - start, start)
                out = []
                for _, at, size in run:
                    headers, http, payload = parse(zlib.decompress(raw[at - start:at - start + size], wbits=31))
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    kind = headers["warc-type"]
                    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise OSError(f"{archive}: the payload at {at} does not match its digest")
                    full = int(re.search(rb"(?im)^content-length: (\d+)", http)[1])
                    out.append((_page(headers["warc-record-id"]), headers.get("warc-target-uri"), kind,
                                _page(headers["warc-refers-to"]) if kind == "revisit" else None,
                                payload.decode() if kind == "response" else None, full, digest))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return located.mapInArrow(read, "page_id long, url string, record_type string, refers_to long, payload string, payload_bytes long, payload_digest string")
