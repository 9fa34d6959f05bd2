"""Web archives packed in ZIP files, read by ranges without extraction.

An archive is a ZIP file whose members are *stored* (not compressed by the ZIP):

    archive/data.warc.gz   WARC records, each its own gzip member
    indexes/index.cdxj     one line per record: key, time, and JSON with offset and length in the member

The reader finds the end-of-central-directory record (and the ZIP64 one where sizes or counts need it),
parses the central directory with its ZIP64 extra fields, locates the stored members through their local
headers, reads the index by range, and then each record's bytes by range: nothing is unpacked to disk.

Archives get fresh names; only those reported by finished tasks enter the manifest. Defined cases: a null
payload is an empty one; payloads below ``MIN_REVISIT`` bytes are always stored; of equal payloads the
row with the smallest id is stored (a null id last) and the others refer to it, rows that repeat its id
are stored too; an empty table writes no archive."""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import written
from .files import make_folder, open_input, open_output, read_range

MIN_REVISIT = 100
ARCHIVE_RECORDS = 20_000
RUN_BYTES = 4 << 20  # records this close together are read in one range
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the pages carry no capture time; a fixed one keeps reruns equal


# ---------------------------------------------------------------- records


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def build_record(page_id, url: str | None, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    """A WARC/1.1 response (HTTP headers and payload), or a revisit (HTTP headers only)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}", "WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url or ""),
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Page-Id: {'' if page_id is None else page_id}"]
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8").split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload) of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _headers(head)
    size = int(warc["content-length"])
    if not head.startswith(b"WARC/1.") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return warc, _headers(http), payload


# ---------------------------------------------------------------- ZIP directories

EOCD, EOCD64, LOCATOR = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"


def read_directory(f, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (method, local header offset, stored size) from the central directory of an open file."""
    tail_at = max(0, size - 22 - 65_535 - 20)
    tail = read_range(f, tail_at, size - tail_at)
    at = tail.rfind(EOCD, 0, len(tail) - 18)
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(EOCD, 0, at)  # the same four bytes inside a comment
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        if at < 20 or tail[at - 20:at - 16] != LOCATOR:
            raise ValueError("no ZIP64 locator")
        record = read_range(f, struct.unpack_from("<Q", tail, at - 12)[0], 56)
        if record[:4] != EOCD64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    raw, at, out = read_range(f, start, length), 0, {}
    for _ in range(count):
        if raw[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, at + 20)
        offset = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, x = raw[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while x + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, x)
            if kind == 1:  # ZIP64: 8 bytes for each field that is all ones, in this order
                values = iter(struct.unpack_from(f"<{n // 8}Q", extra, x + 4))
                full = next(values) if full == 0xFFFFFFFF else full
                packed = next(values) if packed == 0xFFFFFFFF else packed
                offset = next(values) if offset == 0xFFFFFFFF else offset
            x += 4 + n
        out[name] = (method, offset, packed)
        at += 46 + n_name + n_extra + n_comment
    return out


def member_range(f, entry: tuple[int, int, int]) -> tuple[int, int]:
    """(offset, size) of a stored member's bytes in the ZIP file."""
    method, offset, size = entry
    if method != 0:
        raise ValueError("member is compressed, not stored")
    local = read_range(f, offset, 30)
    if local[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    n_name, n_extra = struct.unpack_from("<HH", local, 26)
    return offset + 30 + n_name + n_extra, size


# ---------------------------------------------------------------- writing


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(_id, _url, _payload, _size, _digest, _refers): the payload is null for rows that refer to another."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), payload.alias("_payload"))
    rows = rows.withColumn("_size", F.octet_length("_payload").cast("long")).withColumn("_digest", F.sha2("_payload", 256))
    # Only digests met twice are grouped further or joined; the pages' bytes are never shuffled for this.
    first = (rows.filter(F.col("_size") >= MIN_REVISIT).groupBy("_digest")
             .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1 and _first is not null"))
    repeats = (rows.select("_id", "_digest").join(first, "_digest")
               .filter(~F.col("_id").eqNullSafe(F.col("_first")))
               .select(F.coalesce(F.col("_id").cast("string"), F.lit("")).alias("_k"), "_digest", F.col("_first").alias("_refers")).distinct())
    repeats = written(repeats, "warc-repeats")
    if repeats.isEmpty():
        return rows.withColumn("_refers", F.lit(None).cast("long"))
    rows = rows.withColumn("_k", F.coalesce(F.col("_id").cast("string"), F.lit("")))
    return (rows.join(repeats, ["_k", "_digest"], "left").drop("_k")
            .withColumn("_payload", F.when(F.col("_refers").isNull(), F.col("_payload"))))


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", archive_records: int = ARCHIVE_RECORDS) -> DataFrame:
    """Write one record per row and return the manifest (path, n_records)."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, held, archive = [], [], None

        def start():
            path = f"{folder}/{uuid.uuid4().hex}.zip"
            out = open_output(path)
            box = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
            return path, out, box, box.open(DATA, "w", force_zip64=True)

        def close():
            path, out, box, data = archive
            data.close()
            box.writestr(INDEX, "".join(f"{k} 19700101000000 {json.dumps(v)}\n" for k, v in held))
            box.close()
            out.close()
            done.append((path, len(held)))

        at = 0
        for batch in batches:
            for i, url, payload, size, digest, refers in zip(*(batch.column(c).to_pylist() for c in (
                    "_id", "_url", "_payload", "_size", "_digest", "_refers")), strict=True):
                if archive is None:
                    archive, held, at = start(), [], 0
                member = gzip.compress(build_record(i, url, payload or b"", digest, size, refers), 6, mtime=0)
                archive[3].write(member)
                held.append((re.sub(r"\s", "", url or "-") or "-",
                             {"offset": str(at), "length": str(len(member)), "digest": f"sha256:{digest}"}))
                at += len(member)
                if len(held) >= archive_records:
                    close()
                    archive = None
        if archive is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()),
                                          pa.array([n for _, n in done], pa.int64())], names=["path", "n_records"])

    marked = mark_revisits(pages, id_col, url_col, html_col)
    return written(marked.mapInArrow(write, "path string, n_records long"), "warc-manifest")


# ---------------------------------------------------------------- reading


def list_records(manifest: DataFrame) -> DataFrame:
    """(path, offset, length) of every record in every archive, from directories and indexes alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_input(path) as f:
                    names = read_directory(f, f.size())
                    base, _ = member_range(f, names[DATA])
                    lines = read_range(f, *member_range(f, names[INDEX])).decode().splitlines()
                found = [json.loads(x.split(" ", 2)[2]) for x in lines]
                yield pa.RecordBatch.from_arrays([
                    pa.array([path] * len(found), pa.string()), pa.array([base + int(x["offset"]) for x in found], pa.int64()),
                    pa.array([int(x["length"]) for x in found], pa.int64())], names=["path", "offset", "length"])

    return manifest.select("path").repartition(F.col("path")).mapInArrow(run, "path string, offset long, length long")


def read_records(records: DataFrame) -> DataFrame:
    """Range-read the listed records: page_id, record_type, refers_to, url, payload (null for revisits),
    payload_bytes and payload_digest (both of the full payload; a stored payload's are taken from its bytes
    and held against the record's headers)."""
    kind = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                      ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def parsed(data: bytes) -> tuple:
        warc, http, payload = parse_record(gzip.decompress(data))
        digest, size = warc["warc-payload-digest"].removeprefix("sha256:"), int(http["content-length"])
        if warc["warc-type"] == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
            raise ValueError(f"payload of record {warc['warc-record-id']} differs from its digest")
        revisit = warc["warc-type"] == "revisit"
        return (int(warc["x-page-id"]) if warc["x-page-id"] else None, warc["warc-type"],
                int(warc["x-refers-to-page-id"]) if revisit else None, warc["warc-target-uri"],
                None if revisit else payload, size, digest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, f = None, None
        for batch in batches:
            todo = list(zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length")), strict=True))
            k = 0
            while k < len(todo):
                if todo[k][0] != path:
                    path, f = todo[k][0], open_input(todo[k][0])
                first, last = todo[k][1], k  # one range for records that lie next to each other
                while (last + 1 < len(todo) and todo[last + 1][0] == path and todo[last + 1][1] == todo[last][1] + todo[last][2]
                       and todo[last + 1][1] + todo[last + 1][2] - first <= RUN_BYTES):
                    last += 1
                data = read_range(f, first, todo[last][1] + todo[last][2] - first)
                rows = [parsed(data[o - first:o - first + n]) for _, o, n in todo[k:last + 1]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), kind, strict=True)],
                                                 schema=kind)
                k = last + 1

    # The list is small beside the bytes it stands for, so the number of tasks is given: adaptive execution would
    # join partitions by the list's own size.
    tasks = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = (records.withColumn("_run", F.floor(F.col("offset") / RUN_BYTES)).repartition(tasks, "path", "_run")
              .sortWithinPartitions("path", "offset").drop("_run"))
    return spread.mapInArrow(run, "page_id long, record_type string, refers_to long, url string, payload binary, "
                                  "payload_bytes long, payload_digest string")
