"""WARC records in ZIP-packaged archives: a writer and a range reader.

An archive is a ZIP file whose members are stored, not deflated: ``archive/data.warc.gz``
(one gzip member per record) and ``indexes/index.cdxj`` (one line per record with its offset and
length inside the first). The reader parses the end-of-central-directory record, the ZIP64
locator and directory where present, finds both members, and reads ranges of records through
the index; nothing is extracted to disk.

Scale: archives are closed at ``max_bytes``, so a task holds one index and one run of
records; reads of neighbouring records are joined up to 8 MB. Archives are written under a name
unique to the task attempt and reach the manifest only when the attempt succeeds, so lost or
doubled attempts leave files that nobody reads. Paths are opened with Arrow's file systems
(local or shared folder, HDFS, object stores) by the URI of the output folder.

Equal payloads of at least ``min_bytes``: the row with the smallest id is the response, the others revisit
it (their payload is not stored again). Edge cases: null payloads are empty ones; rows with a null id are always
responses, as nothing could refer to them; rows that repeat the smallest id are responses each;
an empty table writes no archive and reads as an empty table.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milesbase.llm.common import prepare, shared_path, staged

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
MAX_BYTES = 32 << 20
RUN_BYTES = 8 << 20
MANIFEST = "archive string, records bigint, bytes bigint"
RECORDS = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
           "archive string, record_offset bigint, record_length bigint, url string, payload binary")


def file_system(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


# ---- WARC records -------------------------------------------------------------------------------------

def _one_line(text: str) -> str:
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unescaped(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url, payload: bytes, refers_to) -> tuple[bytes, str]:
    """One WARC record (uncompressed) and its payload digest."""
    digest = digest_of(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parsed_record(raw: bytes) -> dict:
    """Fields of one uncompressed WARC record; the payload of a response is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")

    def page(value):
        return int(value[len("<urn:page:"):-1]) if value and value.startswith("<urn:page:") else None

    url = fields.get("WARC-Target-URI")
    return {"page_id": page(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": page(fields.get("WARC-Refers-To")),
            "url": None if url is None else _unescaped(url), "payload": payload if kind == "response" else None}


# ---- ZIP directory ------------------------------------------------------------------------------------

def zip_members(f, size: int) -> dict[str, tuple[int, int]]:
    """name -> (offset of its data, length) of the stored members of an open archive."""
    def read(at, n):
        f.seek(at)
        return f.read(n)

    tail_at = max(0, size - 22 - 65535)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\5\6")
    while end >= 0 and end + 22 + struct.unpack("<H", tail[end + 20:end + 22])[0] != len(tail):
        end = tail.rfind(b"PK\5\6", 0, end)  # the mark inside a comment
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack("<HLL", tail[end + 10:end + 20])
    at = tail_at + end - 20
    locator = read(at, 20) if at >= 0 else b""
    if locator[:4] == b"PK\6\7":
        record = read(struct.unpack("<Q", locator[8:16])[0], 56)
        if record[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack("<QQQ", record[32:56])
    directory, members, at = read(start, length), {}, 0
    for _ in range(count):
        if directory[at:at + 4] != b"PK\1\2":
            raise ValueError("damaged central directory")
        flags, method = struct.unpack("<HH", directory[at + 8:at + 12])
        packed, plain, n_name, n_extra, n_note = struct.unpack("<LLHHH", directory[at + 20:at + 34])
        header = struct.unpack("<L", directory[at + 42:at + 46])[0]
        name = directory[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, x = directory[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while x + 4 <= len(extra):
            kind, n = struct.unpack("<HH", extra[x:x + 4])
            if kind == 1:  # ZIP64: only the fields that are all ones above, in this order
                wide = [v[0] for v in struct.iter_unpack("<Q", extra[x + 4:x + 4 + n // 8 * 8])]
                if plain == 0xFFFFFFFF:
                    plain = wide.pop(0)
                if packed == 0xFFFFFFFF:
                    packed = wide.pop(0)
                if header == 0xFFFFFFFF:
                    header = wide.pop(0)
            x += 4 + n
        at += 46 + n_name + n_extra + n_note
        if method == 0:  # stored; others can't be read by range
            local = read(header, 30)
            if local[:4] != b"PK\3\4":
                raise ValueError(f"no local header of {name}")
            n_name, n_extra = struct.unpack("<HH", local[26:30])
            members[name] = (header + 30 + n_name + n_extra, plain)
    return members


def read_archive(f, size: int, path: str, with_payload: bool = False):
    """Yield the records of an open archive, in the order of its index."""
    members = zip_members(f, size)
    data, n_data = members[DATA]
    at, n = members[INDEX]
    f.seek(at)
    entries = [json.loads(x.split(b" ", 2)[2]) for x in f.read(n).splitlines()]
    i = 0
    while i < len(entries):
        j, first = i, entries[i]["offset"]
        end = first
        while j < len(entries) and entries[j]["offset"] == end and (j == i or end + entries[j]["length"] - first <= RUN_BYTES):
            end += entries[j]["length"]
            j += 1
        if end > n_data:
            raise ValueError(f"the index of {path} points past its records")
        f.seek(data + first)
        run = f.read(end - first)
        for e in entries[i:j]:
            o = e["offset"] - first
            row = parsed_record(zlib.decompress(run[o:o + e["length"]], 31))
            row |= {"archive": path, "record_offset": e["offset"], "record_length": e["length"]}
            if not with_payload:
                row["payload"] = None
            yield row
        i = j


# ---- Spark jobs ---------------------------------------------------------------------------------------

class _Archive:
    """One archive being written."""

    def __init__(self, fs, path: str):
        self.path, self.stream = path, fs.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index, self.at = [], 0

    def add(self, page_id, url, payload, refers_to):
        raw, digest = record_bytes(page_id, url, payload, refers_to)
        packed = gzip.compress(raw, 2, mtime=0)
        self.data.write(packed)
        entry = {"url": url, "digest": f"sha1:{digest}", "mime": "warc/revisit" if refers_to is not None else "text/html",
                 "offset": self.at, "length": len(packed)}
        self.index.append(f"page:{page_id} 19700101000000 {json.dumps(entry)}\n")
        self.at += len(packed)

    def close(self) -> tuple:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.index))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.index), self.at


def write_archives(pages: DataFrame, out_dir: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Write a record per row below ``out_dir`` and return the manifest (archive, records, bytes), staged."""
    prepare(pages.sparkSession)
    rows = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
        F.encode(F.coalesce(F.col(f"`{payload_col}`"), F.lit("")), "UTF-8").alias("payload"))
    digest = F.sha2(F.col("payload"), 256)
    firsts = (rows.where(F.col("page_id").isNotNull() & (F.octet_length("payload") >= min_bytes))
              .groupBy(digest.alias("digest")).agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").drop("n"))
    # only digests that repeat are joined; a hot one stays one row on its side, and Spark splits the other side
    rows = rows.withColumn("digest", digest).join(firsts, "digest", "left")
    revisit = (F.col("first") < F.col("page_id")) & (F.octet_length("payload") >= min_bytes)
    rows = rows.select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"))

    def write(batches):
        from pyspark import TaskContext
        fs, root = file_system(out_dir)
        fs.create_dir(root, recursive=True)
        stem = f"{root}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        archive, done, n = None, [], 0
        for batch in batches:
            ids, urls, payloads, refs = (batch.column(k) for k in ("page_id", "url", "payload", "refers_to"))
            for i in range(batch.num_rows):
                if archive is None:
                    archive, n = _Archive(fs, f"{stem}-{n:05d}.wacz"), n + 1
                archive.add(ids[i].as_py(), urls[i].as_py(), payloads[i].as_py(), refs[i].as_py())
                if archive.at >= max_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["archive", "records", "bytes"])

    return staged(rows.mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, out_dir: str, with_payload: bool = False) -> DataFrame:
    """The records of the archives that ``manifest`` lists, a row each (payload only on demand)."""
    prepare(manifest.sparkSession)
    tasks = max(1, min(manifest.count(), 20_000))

    def read(batches):
        fs, _ = file_system(out_dir)
        names = [x.split()[0] for x in RECORDS.split(", ")]
        types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        kinds = [types[x.split()[1]] for x in RECORDS.split(", ")]
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                size = fs.get_file_info(path).size
                with fs.open_input_file(path) as f:
                    rows, held = [], 0
                    for row in read_archive(f, size, path, with_payload):
                        rows.append(row)
                        held += row["payload_bytes"] if with_payload else 1000
                        if held >= RUN_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in zip(names, kinds)], names=names)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in zip(names, kinds)], names=names)

    return manifest.select("archive").repartition(tasks).mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame, **kw) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    out_dir = shared_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, out_dir, **kw), out_dir)
