"""Binary token files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

A file holds one ascending range of documents. All integers are little-endian:

    magic "TRNK", version u32, documents u64, ids u64, distinct ids u64, data bytes u64
    the distinct ids by falling frequency, u32 each (an id's place is its rank)
    doc_id i64 and number of ids u64 of each document
    control bytes: two bits per id, the number of its rank's bytes less one, the first id in the lowest bits
    data bytes: the ranks, least significant byte first
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import files, partitions, range_bounds, split_range_number
from .tokens import encoded

MAGIC, VERSION = b"TRNK", 1
HEADER = struct.Struct("<4sIQQQQ")
#: The four lengths that each control byte states.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
#: Ids coded or decoded at a time (a multiple of 4).
CHUNK = 1 << 20
#: Ids of a file, about.
FILE_IDS = 1 << 24


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4", copy=False)
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    keep = np.arange(4) < size[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The ranks again, CHUNK at a time: lengths by table lookup of the control bytes, then one gather per byte."""
    at = 0
    for first in range(0, n, CHUNK):
        m = min(CHUNK, n - first)
        size = LENGTHS[control[first // 4 : (first + m + 3) // 4]].reshape(-1)[:m]
        ends = at + np.cumsum(size)
        start = ends - size
        out = data[start].astype(np.uint32)
        for k in (1, 2, 3):
            more = np.flatnonzero(size > k)
            if not len(more):
                break
            out[more] |= data[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
        at = int(ends[-1])
        yield out


def file_bytes(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> Iterator[bytes]:
    """The content of a file, in parts."""
    counts = np.bincount(ids, minlength=1)
    by_rank = np.argsort(-counts, kind="stable")[: int((counts > 0).sum())]
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    control, data = [], []
    for k in range(0, len(ids), CHUNK):
        c, d = encode_ranks(rank_of[ids[k : k + CHUNK]])
        control.append(c)
        data.append(d)
    yield HEADER.pack(MAGIC, VERSION, len(doc_ids), len(ids), len(by_rank), sum(map(len, data)))
    yield by_rank.astype("<u4").tobytes()
    yield doc_ids.astype("<i8").tobytes()
    yield lengths.astype("<u8").tobytes()
    yield from control
    yield from data


def parse(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, numbers of ids, ids) of a file."""
    magic, version, n_docs, n, n_ranks, n_data = HEADER.unpack_from(raw)
    if (magic, version) != (MAGIC, VERSION):
        raise ValueError("not a token file of this version")
    at = HEADER.size
    by_rank = np.frombuffer(raw, "<u4", n_ranks, at)
    doc_ids = np.frombuffer(raw, "<i8", n_docs, at := at + 4 * n_ranks)
    lengths = np.frombuffer(raw, "<u8", n_docs, at := at + 8 * n_docs).astype(np.int64)
    control = np.frombuffer(raw, np.uint8, -(-n // 4), at := at + 8 * n_docs)
    data = np.frombuffer(raw, np.uint8, n_data, at + len(control))
    ids = np.empty(n, "<u4")
    done = 0
    for ranks in decode_ranks(control, data, n):
        ids[done : done + len(ranks)] = by_rank[ranks]
        done += len(ranks)
    return doc_ids, lengths, ids


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, file_ids: int = FILE_IDS) -> list[tuple[str, int]]:
    """Writes the ids of ``docs`` (doc_id long, text string), each document ended by ``end_id``, by ascending doc_id.

    Each range of documents has files of about ``file_ids`` ids (more only where the group of texts that reaches it has
    more), in ``folder`` (shared storage), so a task holds one file's ids however large its range is; a file appears whole
    or not at all and a task that runs again writes the same bytes. Returns (path, number of ids) of each file in order.
    Null and empty texts are the end id alone, equal doc_ids go by a hash of the text, and fill several ranges if they
    are many; null ones are first (as the smallest long). An empty table writes nothing.
    """
    n = partitions(docs.sparkSession)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"), "text", F.xxhash64("text").alias("tie"))
    bounds = range_bounds(keyed.select("key"), "key", n)
    numbered = keyed.select("key", "text", "tie", split_range_number(bounds, "key", "tie").alias("shard"))
    dealt = numbered.repartitionById(n, F.col("shard")).sortWithinPartitions("shard", "key", "tie", "text").select("key", "text", "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, lengths, parts, size, shard, part = [], [], [], 0, 0, 0
        last = np.array([end_id], "<u4").tobytes()
        fs, path = files(folder)

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            parts.clear()
            fs.create_dir(path, recursive=True)
            own, name = f"{path}/.{uuid.uuid4().hex}", f"{path}/tokens-{shard:06d}-{part:06d}.bin"
            with fs.open_output_stream(own) as out:
                for piece in file_bytes(np.concatenate(doc_ids), np.array(lengths), ids):
                    out.write(piece)
            try:
                fs.move(own, name)
            except OSError:  # another attempt of this task was first, with the same bytes
                if fs.get_file_info(name).type == FileType.NotFound:
                    raise
                fs.delete_file(own)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([part], pa.int32()), pa.array([len(ids)], pa.int64())], names=["shard", "part", "n"])

        for batch in batches:
            if batch.num_rows:
                shard = batch.column(2)[0].as_py()
            keys = batch.column(0).to_numpy()
            for first, group in encoded(tokenizer, batch.column(1), min(1 << 21, 4 * file_ids)):
                doc_ids.append(keys[first : first + len(group)])
                lengths.extend(len(raw) // 4 + 1 for raw in group)
                parts.append(last.join([*group, b""]))
                size += len(parts[-1]) // 4
                if size >= file_ids:
                    yield flush()
                    doc_ids, lengths, size, part = [], [], 0, part + 1
        if lengths:
            yield flush()

    rows = sorted(tuple(r) for r in dealt.mapInArrow(run, "shard int, part int, n long").collect())
    return [(f"{folder}/tokens-{shard:06d}-{part:06d}.bin", n) for shard, part, n in rows]


def read_token_files(spark: SparkSession, manifest: list[tuple[str, int]], ids: bool = False) -> DataFrame:
    """Reads token files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (and ids if asked for)."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids
    if not manifest:
        return spark.createDataFrame([], schema)
    starts = np.concatenate([[0], np.cumsum([n for _, n in manifest])]).tolist()
    rows = [(k, path, starts[k]) for k, (path, _) in enumerate(manifest)]
    listed = spark.createDataFrame(rows, "k int, path string, start long").repartitionById(len(rows), F.col("k"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                fs, name = files(path)
                with fs.open_input_stream(name) as source:
                    doc_ids, lengths, found = parse(source.read())
                ends = np.cumsum(lengths)
                raw = memoryview(found).cast("B")
                for k in range(0, len(doc_ids), 1024):
                    last, n = ends[k : k + 1024], lengths[k : k + 1024]
                    parts = [raw[4 * (e - m) : 4 * e] for e, m in zip(last.tolist(), n.tolist())]
                    arrays = [pa.array(doc_ids[k : k + 1024]), pa.array(start + last - n), pa.array(n), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                    arrays += [pa.array([bytes(p) for p in parts], pa.binary())] * ids
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + ids])

    out = listed.mapInArrow(run, schema)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(2**63)), F.col("doc_id")))
