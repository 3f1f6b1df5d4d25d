"""Token ids in seekable files: independent zstandard frames, a trailing seek
table and a checksum per frame.

A shard file, all numbers little-endian:

* data frames, each an ordinary zstandard frame with a content checksum, over
  ``u32 n``, n x ``u8`` (1: the document has an id), n x ``i64`` doc_id,
  n x ``u32`` id count, then the ids as ``u32``;
* a skippable frame 0x184D2A50 with, per data frame, ``i64`` first and last
  doc_id and ``u32`` documents, so a reader finds a document's frame;
* a skippable frame 0x184D2A5E, the public seekable-format table: per frame
  ``u32`` compressed size, decompressed size and low half of xxh64 of the
  content, then ``u32`` frames, ``u8`` 0x80 (checksums), ``u32`` 0x8F92EAB1.

Edge cases: null text is empty (its only id is the end id); a null doc_id
sorts first and is kept; repeated rows are all kept; an empty table gives a
store without shards; a document longer than a frame gets a frame of its own.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_path, table, utf8
from .pieces import library_words, worker_encoder

INDEX_MAGIC, SEEK_MAGIC, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1  # fixed format values
FRAME_BYTES = 1 << 18  # of raw content; a reader decompresses one frame a document
END_ID = 0
MANIFEST = "file string, first_id long, last_id long, n_docs long, n_ids long"


def pack_frame(docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    n = len(docs)
    return b"".join(
        [
            struct.pack("<I", n),
            bytes(d is not None for d, _ in docs),
            np.array([d or 0 for d, _ in docs], "<i8").tobytes(),
            np.array([len(x) for _, x in docs], "<u4").tobytes(),
            *(x.astype("<u4").tobytes() for _, x in docs),
        ]
    )


def unpack_frame(raw: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    (n,) = struct.unpack_from("<I", raw)
    has = np.frombuffer(raw, np.uint8, n, 4)
    ids = np.frombuffer(raw, "<i8", n, 4 + n)
    sizes = np.frombuffer(raw, "<u4", n, 4 + 9 * n).astype(np.int64)
    flat = np.frombuffer(raw, "<u4", int(sizes.sum()), 4 + 13 * n)
    ends = np.cumsum(sizes)
    for i in range(n):
        yield (int(ids[i]) if has[i] else None), flat[ends[i] - sizes[i] : ends[i]]


class ShardWriter:
    """Appends documents to one shard file."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = 3):
        import zstandard

        self.out, self.frame_bytes = out, frame_bytes
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
        self.docs, self.raw, self.seek, self.index = [], 0, [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids))
        self.raw += 13 + 4 * len(ids)
        if self.raw >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        import xxhash

        if not self.docs:
            return
        raw = pack_frame(self.docs)
        frame = self.pack(raw)
        self.out.write(frame)
        self.seek.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        known = [d for d, _ in self.docs if d is not None] or [0]
        self.index.append((min(known), max(known), len(self.docs)))
        self.docs, self.raw = [], 0

    def close(self) -> None:
        self.flush()
        index = b"".join(struct.pack("<qqI", *x) for x in self.index)
        seek = b"".join(struct.pack("<III", *x) for x in self.seek) + struct.pack("<IBI", len(self.seek), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index + struct.pack("<II", SEEK_MAGIC, len(seek)) + seek)


class ShardReader:
    """Random access to one shard; every frame's checksum is verified."""

    def __init__(self, src):
        import zstandard

        self.src, self.zstd = src, zstandard.ZstdDecompressor()
        size = src.size() if hasattr(src, "size") and callable(src.size) else src.seek(0, 2)
        src.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", src.read(9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError("no seek table at the end of the file")
        src.seek(size - 9 - 12 * n)
        self.seek = np.frombuffer(src.read(12 * n), "<u4").reshape(n, 3)
        self.starts = np.concatenate([[0], np.cumsum(self.seek[:, 0].astype(np.int64))])
        src.seek(int(self.starts[-1]) + 8)
        self.index = np.frombuffer(src.read(20 * n), np.dtype([("first", "<i8"), ("last", "<i8"), ("docs", "<u4")]))

    def frame(self, k: int) -> bytes:
        import xxhash

        self.src.seek(int(self.starts[k]))
        raw = self.zstd.decompress(self.src.read(int(self.seek[k, 0])))
        if len(raw) != self.seek[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.seek[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order, or those asked for, opening only their frames."""
        sought = None if wanted is None else np.array(sorted(wanted), np.int64)
        for k in range(len(self.seek)):
            if sought is not None:
                first, last, _ = self.index[k]
                if np.searchsorted(sought, first) == np.searchsorted(sought, last, "right"):
                    continue
            for doc_id, ids in unpack_frame(self.frame(k)):
                if wanted is None or doc_id in wanted:
                    yield doc_id, ids


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark gives it: one without a scheme lies in
    the default file system of the cluster, not on the disk of an executor."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()


def open_store(path: str):
    """(file system, path in it) of a qualified shared folder, local or remote."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, frame_bytes: int = FRAME_BYTES, added: bool = False) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into shards
    below ``path``.  Each task writes one new file; the manifest, committed by
    Spark, names the files of the attempts that count, so a repeated task
    leaves an unnamed file and never a wrong one.  ``added`` gives the added
    tokens of the tokenizer file their own ids, as the library does on whole
    texts; without it they are text like any other."""
    path = qualified(docs.sparkSession, path)

    def write(batches):
        enc = worker_encoder("library", tokenizer, library_words, added)
        files, root = open_store(path)
        out = writer = None
        ids, n_docs, n_ids = [], 0, 0
        for batch in batches:
            if out is None:
                name = f"shard-{uuid.uuid4().hex}.zst"
                out = files.open_output_stream(f"{root}/{name}", compression=None)
                writer = ShardWriter(out, frame_bytes)
            doc_ids = batch.column(0).to_pylist()
            ids += [d for d in (doc_ids[0], doc_ids[-1])] if doc_ids else []
            for r0, flat, offs in enc.encode(*utf8(batch.column(1))):
                for i in range(len(offs) - 1):
                    writer.add(doc_ids[r0 + i], np.append(flat[offs[i] : offs[i + 1]], np.uint32(end_id)))
                n_docs += len(offs) - 1
                n_ids += len(flat) + len(offs) - 1
        if out is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"file": [name], "first_id": [ids[0]], "last_id": [ids[-1]], "n_docs": [n_docs], "n_ids": [n_ids]},
                schema=pa.schema([("file", pa.string()), *((c, pa.int64()) for c in ("first_id", "last_id", "n_docs", "n_ids"))]),
            )

    files, root = open_store(path)
    files.create_dir(root)
    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id")).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard with the ids of all shards before it (``start``).
    The window sees one row per file, not per document."""
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "last_id", "file").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest").withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def read_store(spark: SparkSession, path: str, wanted: list[int] | None = None, with_ids: bool = False) -> DataFrame:
    """Documents of a store: doc_id, start, n_tokens, ids_crc32 and, on
    request, the ids.  ``wanted`` opens only the frames that can hold them
    (``start`` is then null: the documents between are not read)."""
    path = qualified(spark, path)
    pick = None if wanted is None else set(wanted)
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.list_(pa.int64()))] if with_ids else []

    def read(batches):
        files, root = open_store(path)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held = {k: [] for k, _ in fields}, 0
                with files.open_input_file(f"{root}/{name}") as src:
                    for doc_id, ids in ShardReader(src).documents(pick):
                        rows["doc_id"].append(doc_id)
                        rows["start"].append(start if pick is None else None)
                        rows["n_tokens"].append(len(ids))
                        rows["ids_crc32"].append(zlib.crc32(ids.tobytes()))
                        if with_ids:
                            rows["ids"].append(ids.tolist())
                        start += len(ids)
                        held += len(ids) if with_ids else 1
                        if held > 1 << 18:
                            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(fields))
                            rows, held = {k: [] for k, _ in fields}, 0
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(fields))

    shards = manifest(spark, path)
    if pick is not None:
        low, high = (min(pick), max(pick)) if pick else (1, 0)
        shards = shards.where((F.col("first_id").isNull() | (F.col("first_id") <= high)) & (F.col("last_id") >= low))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    # One task a file: a number keeps adaptive execution from merging the few small rows.
    return shards.select("file", "start").repartition(max(1, shards.count())).mapInArrow(read, schema)


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_path(spark, "token-store")
    write_store(table(spark, sf_dir, "documents", "doc_id", "text"), path, public_tokenizers.path("byte_bpe_50k.json"), added=True)
    return read_store(spark, path)
