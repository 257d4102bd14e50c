"""Token ids in length-delimited binary records, with an offset index for shuffled reads.

A data file holds records one after another: the payload's length (8 bytes), the length's masked
checksum (4), the payload, its masked checksum (4); all numbers little-endian. The checksum is
CRC-32, turned by 15 bits and added to a fixed number, so that a checksum of checksums is not one
itself. A payload is the document's number (8 bytes), a flag byte (1: the number is null), the bytes per
id (2 or 4) and the ids. The index beside it has, per record, its offset, its length and its number of
ids, so that any record can be read by itself. A manifest table has one row per data file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.llm.common import filesystem, publish, saved, slices
from gaugeline.llm.wordcache import WordEncoder

MASK = 0xA282EAD8
HEAD, PAYLOAD_HEAD, FOOT = struct.Struct("<QI"), struct.Struct("<qBB"), struct.Struct("<I")
INDEX = np.dtype([("offset", "<u8"), ("length", "<u4"), ("n_tokens", "<u4")])
MANIFEST = "shard int, records long, n_tokens long, data string, index string"
RECORDS = "shard int, place long, doc_id long, n_tokens long, before long, ids binary"
BLOCK = 4 << 20

_ENCODERS: dict[tuple, WordEncoder] = {}


def encoder_of(tokenizer_json: str, spaces: bool) -> WordEncoder:
    """The worker's own encoder, kept from task to task."""
    key = (hash(tokenizer_json), spaces)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(tokenizer_json, spaces)
    return _ENCODERS[key]


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    payload = PAYLOAD_HEAD.pack(doc_id or 0, doc_id is None, width) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((length, FOOT.pack(masked(length)), payload, FOOT.pack(masked(payload))))


def unframe(record: bytes) -> tuple[int | None, np.ndarray]:
    """The document's number and its ids; an error if a checksum is wrong."""
    length, crc = HEAD.unpack_from(record)
    payload = record[HEAD.size : HEAD.size + length]
    if crc != masked(record[:8]) or FOOT.unpack_from(record, HEAD.size + length)[0] != masked(payload):
        raise ValueError("checksum of a token record is wrong")
    doc_id, null, width = PAYLOAD_HEAD.unpack_from(payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=PAYLOAD_HEAD.size)


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, key: str = "doc_id",
                  text: str = "text", spaces: bool = True) -> DataFrame:
    """Write every whole text as one record, in ascending order of ``key``; returns the manifest.

    Null texts count as empty, so each record has ``end_id`` at least. Null keys come first; rows that
    share a key are ordered by their text. Shards follow one another in key order, cut by row counts, and the
    rows of one key may span shards. A task that is run again writes the same bytes under the same name. An empty table
    gives an empty manifest.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = encoder_of(shared.value, spaces), TaskContext.get().partitionId()
        end = np.array([end_id], encoder.dtype).tobytes()
        width, (store, top) = encoder.dtype.itemsize, filesystem(folder)
        own = f"{top}/attempt-{uuid.uuid4().hex}"
        index, at, total = [], 0, 0
        out = None
        for batch in slices(batches, 2048):
            if out is None:
                store.create_dir(top, recursive=True)
                out = store.open_output_stream(f"{own}.data")
            frames = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                frames.append(frame(doc_id, ids + end, width))
                n = len(ids) // width + 1
                index.append((at, len(frames[-1]), n))
                at, total = at + len(frames[-1]), total + n
            out.write(b"".join(frames))
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{own}.index") as f:
            f.write(np.array(index, INDEX).tobytes())
        names = [f"{top}/shard-{shard:06d}.{kind}" for kind in ("data", "index")]
        for kind, name in zip(("data", "index"), names, strict=True):
            publish(store, f"{own}.{kind}", name)
        yield pa.RecordBatch.from_pylist([{
            "shard": shard, "records": len(index), "n_tokens": total, "data": names[0], "index": names[1]}],
            schema=pa.schema([("shard", pa.int32()), ("records", pa.int64()), ("n_tokens", pa.int64()),
                              ("data", pa.string()), ("index", pa.string())]))

    rows = (
        docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
        .withColumn("tie", F.xxhash64("t")).withColumn("spread", F.monotonically_increasing_id())
        .repartitionByRange("k", "tie", "spread").sortWithinPartitions("k", "tie", "spread")
        .select("k", "t")
    )
    return saved(rows.mapInArrow(write, MANIFEST), "record-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest, one row per data file, with the ids of all earlier files as ``base``."""
    earlier = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))


def read_records(manifest: DataFrame, folder: str, seed: int | None = None) -> DataFrame:
    """The records of all files: shard, place, doc_id, n_tokens, before, ids (unsigned 32-bit).

    ``before`` counts the ids of all records before this one. Checksums are verified. Without a seed, files are
    read from front to end; with one, each file's records are fetched one by one through its index in
    a shuffled order that the seed fixes. One task reads one file.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                yield from read_file(store, row, seed)

    shards = manifest.count()
    files = with_starts(manifest)
    if shards > 1:
        files = files.repartitionByRange(shards, "shard")
    return files.mapInArrow(read, RECORDS)


def read_file(store: pa.fs.FileSystem, row: dict, seed: int | None) -> Iterator[pa.RecordBatch]:
    with store.open_input_stream(row["index"]) as f:
        index = np.frombuffer(f.read(), INDEX)
    before = row["base"] + np.cumsum(index["n_tokens"], dtype="i8") - index["n_tokens"]
    order = np.arange(len(index)) if seed is None else np.random.default_rng([seed, row["shard"]]).permutation(len(index))
    with store.open_input_file(row["data"]) as f:
        at = 0
        while at < len(order):
            # Records up to a block's worth of bytes, one at least.
            sizes = np.cumsum(index["length"][order[at : at + 4096]], dtype="i8")
            some = order[at : at + max(1, int(np.searchsorted(sizes, BLOCK, "right")))]
            if seed is None:
                first = int(index["offset"][some[0]])
                block = f.read_at(int(index["length"][some].sum(dtype="i8")), first)
                begins = (index["offset"][some] - np.uint64(first)).tolist()
                parts = [block[o : o + n] for o, n in zip(begins, index["length"][some].tolist(), strict=True)]
            else:
                parts = [f.read_at(int(index["length"][i]), int(index["offset"][i])) for i in some.tolist()]
            docs = [unframe(p) for p in parts]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(some), row["shard"], "i4")), pa.array(some.astype("i8")),
                pa.array([d for d, _ in docs], pa.int64()), pa.array([len(x) for _, x in docs], pa.int64()),
                pa.array(before[some]), pa.array([x.astype("<u4").tobytes() for _, x in docs], pa.binary()),
            ], names=["shard", "place", "doc_id", "n_tokens", "before", "ids"])
            at += len(some)
