"""Token ids as files of independent zstandard frames with a seek table.

The files follow the published seekable format: frames one after the other,
then a skippable frame that lists for each frame its compressed and its full
size and a checksum (the low 32 bits of XXH64), and a footer. A reader finds
any frame from the end of the file and decompresses only those that hold the
documents asked for. An index table, written by Spark next to the files, says
which frame and which ids within it belong to a document.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardframe.llm.bpe import encoder, slices
from wardframe.llm.common import quoted

FRAME_BYTES = 1 << 20
LEVEL = 1
# Fixed values of the format: the magic numbers of the table frame and of its footer.
TABLE_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 0x80
ENTRY, FOOTER = struct.Struct("<III"), struct.Struct("<IBI")


def _store(folder: str):
    """The file system and path of a folder, local, mounted or remote."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def checksum(raw: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class FrameWriter:
    """Writes frames to a file of its own, which gets its name once it is whole."""

    def __init__(self, folder: str, name: str):
        import zstandard

        self.store, base = _store(folder)
        self.store.create_dir(base, recursive=True)
        self.path, self.draft = f"{base}/{name}", f"{base}/.{name}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.draft)
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)
        self.table: list[tuple[int, int, int]] = []

    def frame(self, raw: bytes) -> int:
        """Writes one frame and returns its number."""
        packed = self.zstd.compress(raw)
        self.out.write(packed)
        self.table.append((len(packed), len(raw), checksum(raw)))
        return len(self.table) - 1

    def close(self) -> None:
        entries = b"".join(ENTRY.pack(*e) for e in self.table)
        footer = FOOTER.pack(len(self.table), WITH_CHECKSUMS, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(entries) + len(footer)))
        self.out.write(entries + footer)
        self.out.close()
        self.store.move(self.draft, self.path)


class FrameReader:
    """Reads single frames of a file."""

    def __init__(self, folder: str, name: str):
        store, base = _store(folder)
        self.file = store.open_input_file(f"{base}/{name}")
        size = self.file.size()
        count, flags, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != FOOTER_MAGIC or flags != WITH_CHECKSUMS:
            raise ValueError(f"no seek table in {name}")
        raw = self.file.read_at(ENTRY.size * count, size - FOOTER.size - ENTRY.size * count)
        self.table = list(ENTRY.iter_unpack(raw))
        self.starts = np.cumsum([0, *(e[0] for e in self.table)])

    def frame(self, n: int) -> bytes:
        import zstandard

        packed, full, expected = self.table[n]
        data = self.file.read_at(packed, int(self.starts[n]))
        raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=full)
        if len(raw) != full or checksum(raw) != expected:
            raise ValueError(f"frame {n} is damaged")
        return raw

    def close(self) -> None:
        self.file.close()


def _writer(folder: str, tokenizer_path: str, end_id: int | None, frame_bytes: int):
    def run(batches):
        from pyspark import TaskContext

        shard = f"shard-{TaskContext.get().partitionId():06d}.zst"
        own, out = encoder(tokenizer_path), None
        end = b"" if end_id is None else struct.pack("<I", end_id)
        waiting: list[bytes] = []
        held = offset = 0
        for batch in batches:
            for a, b in slices(batch.column(1)):
                if out is None:
                    out = FrameWriter(folder, shard)
                ids, ends = own.encode(pc.fill_null(batch.column(1).slice(a, b - a), ""))
                frames, places, sizes = [], [], []
                for s, e in zip(ends, ends[1:]):
                    raw = ids[s:e].tobytes() + end
                    if held and held + len(raw) > frame_bytes:
                        out.frame(b"".join(waiting))
                        waiting, held = [], 0
                    frames.append(len(out.table))
                    places.append(held // 4)
                    sizes.append(len(raw) // 4)
                    waiting.append(raw)
                    held += len(raw)
                starts = offset + np.cumsum([0, *sizes])
                offset = int(starts[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([shard] * len(sizes), pa.string()),
                        pa.array(frames, pa.int32()),
                        pa.array(places, pa.int64()),
                        pa.array(starts[:-1], pa.int64()),
                        pa.array(sizes, pa.int64()),
                    ],
                    names=["id", "shard", "frame", "place", "start_in_shard", "n_tokens"],
                )
        if out is not None:
            if waiting:
                out.frame(b"".join(waiting))
            out.close()

    return run


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int | None = 0,
    frame_bytes: int = FRAME_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Writes the ids of all documents in ascending id order; returns their index.

    The documents are dealt out by ranges of their ids, one file per range; ids
    that repeat are ordered by the hash of their text, and null ids come first.
    A null text is empty: only ``end_id`` is written for it, or nothing where
    that is None. A frame holds whole documents, up to ``frame_bytes`` of ids or
    one longer document. A task that runs again writes the same file again.

    The index, stored below ``folder``, has per row the id, file, frame, place
    in the frame, the ids before it in the file and in all files (``start``),
    and ``n_tokens``. An empty table writes no file and gives an empty index.
    """
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("body"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("body")]
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("shard", T.StringType()),
            T.StructField("frame", T.IntegerType()),
            T.StructField("place", T.LongType()),
            T.StructField("start_in_shard", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )
    written = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_writer(folder, tokenizer_path, end_id, frame_bytes), schema)
    )
    written.write.parquet(f"{folder}/index")
    index = docs.sparkSession.read.schema(schema).parquet(f"{folder}/index")
    return _with_starts(index).withColumnRenamed("id", id_col)


def _with_starts(index: DataFrame) -> DataFrame:
    """Adds ``start``: the ids in all files before the row's file, and before it in the file.

    One running sum over the files, of which there are as many as tasks wrote.
    """
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    joined = index.join(before, "shard").withColumn("start", F.col("before") + F.col("start_in_shard"))
    return joined.select(*index.columns, "start")


def read_token_files(folder: str, index: DataFrame) -> DataFrame:
    """The rows of ``index``, all or a selection, with their ``ids``.

    ``ids`` holds little-endian unsigned 32-bit integers. Each frame that the
    index names is decompressed once, by the task that has its rows, and held
    against its checksum; other frames are not read.
    """
    names = index.columns
    schema = T.StructType([*index.schema.fields, T.StructField("ids", T.BinaryType())])
    at = [names.index(c) for c in ("shard", "frame", "place", "n_tokens")]

    def run(batches):
        reader, open_shard, number, raw = None, None, None, b""
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                found = []
                for shard, frame, place, n in zip(*[part.column(i).to_pylist() for i in at]):
                    if shard != open_shard:
                        if reader:
                            reader.close()
                        reader, open_shard, number = FrameReader(folder, shard), shard, None
                    if frame != number:
                        raw, number = reader.frame(frame), frame
                    found.append(raw[4 * place : 4 * (place + n)])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.binary())], names=[*names, "ids"]
                )
        if reader:
            reader.close()

    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.repartition(tasks, "shard", "frame").sortWithinPartitions("shard", "frame", "place")
    return dealt.mapInArrow(run, schema)


def pick(index: DataFrame, ids: Sequence[int], id_col: str = "doc_id") -> DataFrame:
    """The index rows of some documents, to read only their frames."""
    return index.filter(quoted(id_col).isin(list(ids)))


def token_files_folder(spark: SparkSession) -> str:
    from wardframe.session import scratch_path

    return scratch_path(spark, "token-files")
