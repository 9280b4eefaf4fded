"""Token-ID / binary output with one shared zstandard dictionary (operator 10).

Store layout under a root folder all executors share::

    dictionary.zdict            the shared dictionary (may be empty)
    shards/shard-*.ids          one file for each range of doc_ids
    manifest/                   Parquet: one row for each committed shard

A shard holds, in ascending doc_id order, one zstandard frame for each
document (its packed ids, end id included), then an offset index, then a
fixed trailer::

    magic(8) id_width(u32) n_docs(u32) dictionary_sha256(32)
    frame ... frame
    index: n_docs entries of doc_id(i64) has_id(u8) offset(u64) bytes(u32) n_ids(u64) first_id(u64)
    trailer: index_offset(u64) n_docs(u64) n_ids(u64) magic(8)

so a short document is read with three ranged reads and one small
decompression (``read_document``). ``first_id`` counts from the start of the
shard; the manifest adds the ids of the shards before.

The dictionary is trained on the serialized id arrays of a bounded sample:
the ``SAMPLE_DOCS`` documents of smallest id hash, ``SAMPLE_IDS`` ids of each.
Everything else covers all documents.

Writing survives lost executors: every attempt writes a file of its own name,
and only files named in the manifest, which is written after the stage ended,
belong to the store.

Defined results: a null or empty text gives the end id alone; rows that share
a doc_id are kept, ordered by their ids; rows without doc_id come first; an
empty table gives a store without shards; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clinlake.llm.common import shuffle_partitions, table
from clinlake.llm.word_bpe import VOCABULARY, encoder
from clinlake.session import scratch_path

MAGIC = b"CLIDS001"
HEAD = "<8sII32s"
TAIL = "<QQQ8s"
HEAD_BYTES, TAIL_BYTES = struct.calcsize(HEAD), struct.calcsize(TAIL)
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("offset", "<u8"), ("bytes", "<u4"), ("n_ids", "<u8"), ("first_id", "<u8")])
END_ID = 2
LEVEL = 3
SAMPLE_DOCS = 512
SAMPLE_IDS = 4096
DICTIONARY_BYTES = 1 << 16

MANIFEST = "shard int, path string, n_docs long, n_ids long, bytes long"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _open(root: str):
    """The file system and path of a folder given as a path or URI."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(root)


def _read_file(path: str) -> bytes:
    fs, at = _open(path)
    with fs.open_input_stream(at) as f:
        return f.read()


@lru_cache(maxsize=4)
def _dictionary(content: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(content) if content else None


def _compressor(content: bytes):
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(content), write_dict_id=False)


def _decompressor(content: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=_dictionary(content))


def train_dictionary(docs: DataFrame, vocabulary: str) -> bytes:
    """A dictionary of the sample's id arrays; empty where there is too little to train on."""
    import zstandard

    chosen = docs.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)  # a fixed number of longs
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")

    def ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(vocabulary)
        width = np.dtype(own.code).itemsize
        for pdf in batches:
            yield pd.DataFrame({"ids": [own.encode(t or "")[:SAMPLE_IDS * width] for t in pdf["text"]]})

    packed = sorted(r["ids"] for r in sample.mapInPandas(ids, "ids binary").collect())
    packed = [bytes(p) for p in packed if p]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, packed).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_store(docs: DataFrame, root: str, vocabulary: str) -> DataFrame:
    """Encode all documents into a store under ``root``; returns its manifest."""
    spark = docs.sparkSession
    content = train_dictionary(docs, vocabulary)
    fs, at = _open(root)
    fs.create_dir(f"{at}/shards", recursive=True)
    with fs.open_output_stream(f"{at}/dictionary.zdict") as f:
        f.write(content)
    n = shuffle_partitions(spark)
    cuts = F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n)
    bounds = np.array(sorted(set(docs.agg(cuts.alias("cuts")).first()["cuts"] or [])), dtype="int64")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, squeeze = encoder(vocabulary), _compressor(content)
        end = own.pack([END_ID])
        width = len(end)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            frames, counts = [], []
            for text in texts:
                packed = own.encode(text.as_py() or "") + end
                frames.append(squeeze.compress(packed))
                counts.append(len(packed) // width)
            where = np.searchsorted(bounds, ids.fill_null(-(2**63)).to_numpy(zero_copy_only=False), side="right")
            yield pa.RecordBatch.from_arrays(
                [pa.array(where, pa.int32()), ids, pa.array(counts, pa.int64()), pa.array(frames, pa.binary())],
                ["shard", "doc_id", "n_ids", "frame"])

    frames = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "shard int, doc_id long, n_ids long, frame binary")
    dealt = frames.repartitionById(max(1, len(bounds) + 1), F.col("shard")).sortWithinPartitions("doc_id", "n_ids", "frame")
    digest = hashlib.sha256(content).digest()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_fs, own_at = _open(root)
        width = np.dtype(encoder(vocabulary).code).itemsize
        name = f"shard-{uuid.uuid4().hex}.ids"
        entries, out, at_byte, first, shard = [], None, 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = own_fs.open_output_stream(f"{own_at}/shards/{name}", buffer_size=1 << 20)
                out.write(struct.pack(HEAD, MAGIC, width, 0, digest))
                at_byte, shard = HEAD_BYTES, batch.column(0)[0].as_py()
            part = np.zeros(batch.num_rows, INDEX)
            for i, frame in enumerate(batch.column(3)):
                view = frame.as_buffer()
                out.write(view)
                part["offset"][i], part["bytes"][i] = at_byte, view.size
                at_byte += view.size
            part["has_id"] = ~np.asarray(batch.column(1).is_null())
            part["doc_id"] = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
            part["n_ids"] = batch.column(2).to_numpy()
            part["first_id"] = first + np.cumsum(part["n_ids"]) - part["n_ids"]
            first += int(part["n_ids"].sum())
            entries.append(part)
        if out is None:
            return
        index = np.concatenate(entries)
        out.write(index.tobytes())
        out.write(struct.pack(TAIL, at_byte, len(index), first, MAGIC))
        out.close()
        size = at_byte + index.nbytes + TAIL_BYTES
        yield pa.RecordBatch.from_pylist([{"shard": shard, "path": f"shards/{name}", "n_docs": len(index), "n_ids": first, "bytes": size}],
                                         schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                                                           ("n_ids", pa.int64()), ("bytes", pa.int64())]))

    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{root}/manifest")
    return read_manifest(spark, root)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row for each shard, with ``base``: the ids of all shards before it."""
    shards = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    return shards.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def shard_documents(path: str, content: bytes) -> Iterator[tuple[np.void, np.ndarray]]:
    """(index entry, ids) of every document of a shard, in file order."""
    fs, at = _open(path)
    unpack = _decompressor(content)
    with fs.open_input_file(at) as f:
        magic, width, _, digest = struct.unpack(HEAD, f.read(HEAD_BYTES))
        if magic != MAGIC or digest != hashlib.sha256(content).digest():
            raise ValueError(f"{path}: not a shard of this dictionary")
        index = _read_index(f)
    kind = "<u2" if width == 2 else "<u4"
    with fs.open_input_stream(at, buffer_size=1 << 20) as f:
        f.read(HEAD_BYTES)
        for entry in index:
            yield entry, np.frombuffer(unpack.decompress(f.read(int(entry["bytes"]))), kind)


def _read_index(f) -> np.ndarray:
    size = f.size()
    where, n_docs, _, magic = struct.unpack(TAIL, f.read_at(TAIL_BYTES, size - TAIL_BYTES))
    if magic != MAGIC:
        raise ValueError("truncated shard")
    return np.frombuffer(f.read_at(n_docs * INDEX.itemsize, where), INDEX)


def read_document(root: str, shard_path: str, doc_id: int) -> list[list[int]]:
    """The ids of each row with this doc_id, by ranged reads of one shard."""
    content = _read_file(f"{root}/dictionary.zdict")
    fs, at = _open(f"{root}/{shard_path}")
    with fs.open_input_file(at) as f:
        _, width, _, _ = struct.unpack(HEAD, f.read_at(HEAD_BYTES, 0))
        index = _read_index(f)
        found = index[(index["doc_id"] == doc_id) & (index["has_id"] == 1)]
        kind, unpack = "<u2" if width == 2 else "<u4", _decompressor(content)
        return [np.frombuffer(unpack.decompress(f.read_at(int(e["bytes"]), int(e["offset"]))), kind).tolist() for e in found]


def read_store(spark: SparkSession, root: str, with_ids: bool = True) -> DataFrame:
    """Every document of a store: doc_id, start, n_tokens, ids_crc32, and its ids."""
    shards = read_manifest(spark, root).select("shard", "path", "base")
    content = _read_file(f"{root}/dictionary.zdict")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                rows, held = [], 0
                for entry, ids in shard_documents(f"{root}/{shard['path']}", content):
                    rows.append((int(entry["doc_id"]) if entry["has_id"] else None, shard["base"] + int(entry["first_id"]),
                                 len(ids), zlib.crc32(ids.astype("<u4").tobytes())) + ((ids.astype("int32"),) if with_ids else ()))
                    held += len(ids) if with_ids else 1
                    if held > 1 << 20 if with_ids else held >= 8192:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, schema)

    n = max(1, shuffle_partitions(spark))
    dealt = shards.repartitionById(n, F.pmod("shard", F.lit(n)).cast("int"))
    spark_type = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return dealt.mapInArrow(read, spark_type)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents to a fresh store, then read its files back."""
    root = scratch_path(spark, "tokens")
    write_store(table(spark, sf_dir, "documents"), root, vocabulary_path())
    return read_store(spark, root, with_ids=False)
