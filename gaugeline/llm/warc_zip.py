"""WARC archives packed in ZIP files, written and read by byte ranges.

A package is a ZIP file of stored (uncompressed) members: ``archive/data.warc.gz``, one gzip member per
WARC record, and ``indexes/index.cdxj``, one JSON line per record with its offset and length in the archive. The
reader parses the end record, its ZIP64 form and the central directory, finds both members and fetches records by range:
nothing is extracted. Payloads that are equal are stored once, as the response of the largest page number; the others
are revisits of it, which keep the HTTP header and so the payload's length.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import filesystem, publish, saved, slices

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGES = "package int, records long, path string"
RECORDS = ("package int, page_id long, url string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary")
WARC_DATE = "2024-01-01T00:00:00Z"
BLOCK = 4 << 20

# The fixed parts of ZIP records, by the format's public description.
END, END64_AT, END64 = struct.Struct("<4s4H2IH"), struct.Struct("<4sIQI"), struct.Struct("<4sQ2H2I4Q")
CENTRAL, LOCAL = struct.Struct("<4s6H3I5H2I"), struct.Struct("<4s5H3I2H")
NONE16, NONE32 = 0xFFFF, 0xFFFFFFFF


def record_uri(page_id: int | None, package: int, place: int) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:page:none:{package}:{place}>"


def warc_record(kind: str, uri: str, url: str | None, digest: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, compressed as a gzip member of its own."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {uri}", f"WARC-Date: {WARC_DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c not in "\r\n" else " " for c in url))
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 1, mtime=0)


def parse_record(data: bytes) -> dict:
    """The fields of one gzip member; an error if a response's payload does not have its digest."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, body = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(body) != length or base32_sha1(body) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    number = fields["WARC-Record-ID"][10:-1]
    return {
        "page_id": None if number.startswith("none") else int(number), "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"], "payload_bytes": length, "payload_digest": digest,
        "refers_to": int(fields["WARC-Refers-To"][10:-1]) if "WARC-Refers-To" in fields else None,
        "payload": body if response else None,
    }


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def members(read_at, size: int) -> dict[str, tuple[int, int]]:
    """(first byte, length) of the data of every stored member of a ZIP file; ``read_at(n, offset)`` reads a range."""
    tail_at = max(0, size - END.size - NONE16 - END64_AT.size)
    tail = read_at(size - tail_at, tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("not a ZIP file: no end record")
    _, _, _, _, count, length, offset, _ = END.unpack_from(tail, at)
    if NONE16 == count or NONE32 in (length, offset):
        mark, _, where, _ = END64_AT.unpack_from(tail, at - END64_AT.size)
        if mark != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        *_, count, length, offset = END64.unpack(read_at(END64.size, where))
    directory, found, at = read_at(length, offset), {}, 0
    for _ in range(count):
        (mark, _, _, flags, method, _, _, _, packed, plain, n_name, n_extra, n_note, _, _, _, local) = CENTRAL.unpack_from(directory, at)
        if mark != b"PK\x01\x02":
            raise ValueError("central directory is damaged")
        name = directory[at + CENTRAL.size :][:n_name].decode()
        extra = directory[at + CENTRAL.size + n_name :][:n_extra]
        packed, local = wide(extra, plain, packed, local)
        if method == 0 and not flags & 1:
            *_, n_name2, n_extra2 = LOCAL.unpack(read_at(LOCAL.size, local))
            found[name] = local + LOCAL.size + n_name2 + n_extra2, packed
        at += CENTRAL.size + n_name + n_extra + n_note
    return found


def wide(extra: bytes, plain: int, packed: int, local: int) -> tuple[int, int]:
    """Packed size and local offset, taken from the ZIP64 field where the short ones are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            if plain == NONE32:
                next(values)
            packed = next(values) if packed == NONE32 else packed
            local = next(values) if local == NONE32 else local
        at += 4 + n
    return packed, local


def with_revisits(pages: DataFrame, key: str = "page_id", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """(k, u, p, refers_to): pages with the page each revisits, null for responses; null payloads are empty.

    Of pages with equal payloads of ``least_bytes`` or more, that with the largest key is the response. Rows that repeat that
    key are responses too, and a group without keys has responses only.
    """
    rows = pages.select(F.col(key).cast("long").alias("k"), F.col("url").cast("string").alias("u"),
                        F.coalesce(F.encode(F.col(payload).cast("string"), "UTF-8"), F.lit(b"")).alias("p"))
    marks = (F.sha1("p"), F.octet_length("p"))
    twins = (
        rows.select("k", marks[0].alias("d"), marks[1].alias("n")).where(F.col("n") >= least_bytes)
        .groupBy("d", "n").agg(F.max("k").alias("last"), F.count("*").alias("rows"))
        .where("rows > 1 and last is not null")
    )
    twins = saved(twins, "warc-twins")
    dealt = rows.join(twins, (marks[0] == F.col("d")) & (marks[1] == F.col("n")), "left")
    return dealt.select("k", "u", "p", F.when(~F.col("k").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def write_packages(pages: DataFrame, folder: str, key: str = "page_id", payload: str = "html",
                   least_bytes: int = 0) -> DataFrame:
    """One ZIP package per task, a WARC record per page; returns a table of the packages.

    ``pages`` has ``key``, ``url`` and ``payload``; further columns are not looked at. An empty table gives no package.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, (store, top), out = TaskContext.get().partitionId(), filesystem(folder), None
        written, index, at = f"{top}/attempt-{uuid.uuid4().hex}.zip", io.StringIO(), 0
        n = 0
        for batch in slices(batches, 256):
            if out is None:
                store.create_dir(top, recursive=True)
                out = store.open_output_stream(written)
                pack = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
                archive = pack.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
            for row in batch.to_pylist():
                digest, kind = base32_sha1(row["p"]), "response" if row["refers_to"] is None else "revisit"
                record = warc_record(kind, record_uri(row["k"], package, n), row["u"], digest, row["p"], row["refers_to"])
                archive.write(record)
                index.write(json.dumps({"page_id": row["k"], "type": kind, "offset": at, "length": len(record)}) + "\n")
                at, n = at + len(record), n + 1
        if out is None:
            return
        archive.close()
        pack.writestr(zipfile.ZipInfo(INDEX), index.getvalue())
        pack.close()
        out.close()
        publish(store, written, f"{top}/package-{package:06d}.zip")
        yield pa.RecordBatch.from_pydict({
            "package": pa.array([package], pa.int32()), "records": pa.array([n], pa.int64()),
            "path": [f"{top}/package-{package:06d}.zip"]})

    rows = with_revisits(pages, key, payload, least_bytes)
    return saved(rows.mapInArrow(write, PACKAGES), "warc-packages")


def read_packages(packages: DataFrame, folder: str) -> DataFrame:
    """All records of the packages, read by range through their indexes; payload is null for revisits.

    One task reads one package, neighbouring records in ranges of about 4 MB.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(row["path"]) as f:
                    for some in records(lambda n, at, f=f: f.read_at(n, at), f.size()):
                        yield pa.RecordBatch.from_pylist([{"package": row["package"], **x} for x in some], schema=schema)

    schema = pa.schema([
        ("package", pa.int32()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
    n = packages.count()
    if n > 1:
        packages = packages.repartitionByRange(n, "package")
    return packages.mapInArrow(read, RECORDS)


def records(read_at, size: int, numbers: set[int] | None = None) -> Iterator[list[dict]]:
    """The records of one package, or only those of some page numbers, a range at a time."""
    found = members(read_at, size)
    (base, _), (at, length) = found[ARCHIVE], found[INDEX]
    block: list[tuple[int, int]] = []
    for line in io.BytesIO(read_at(length, at)):
        entry = json.loads(line)
        if numbers is not None and entry["page_id"] not in numbers:
            continue
        place = entry["offset"], entry["length"]
        if block and (place[0] != sum(block[-1]) or sum(place) - block[0][0] > BLOCK):
            yield fetch(read_at, base, block)
            block = []
        block.append(place)
    if block:
        yield fetch(read_at, base, block)


def fetch(read_at, base: int, block: list[tuple[int, int]]) -> list[dict]:
    first = block[0][0]
    data = read_at(sum(block[-1]) - first, base + first)
    return [parse_record(data[o - first : o - first + n]) for o, n in block]
