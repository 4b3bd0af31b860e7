"""Token sequences written in training order, as shards of fixed stride.

A keyed Feistel permutation with cycle-walking gives each sequence a global slot: no table
of the order exists, and any slot can be computed from its sequence and back. A shard
holds a range of slots as records of equal length, so that a reader resumes at any slot by
one seek.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadstream.llm.common import in_arrow, own_folder, written
from roadstream.llm.shingles import mix
from roadstream.llm.tokens import encoder, with_end

ROUNDS = 6
#: Ids of a sequence at most, and sequences of a shard.
LENGTH, SHARD_ROWS = 256, 131_072


class Permutation:
    """A keyed bijection of range(size)."""

    def __init__(self, size: int, key: int):
        self.size = size
        self.half = max(1, -(-max(size - 1, 1).bit_length() // 2))
        self.mask = np.uint64((1 << self.half) - 1)
        with np.errstate(over="ignore"):
            start = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            self.keys = mix(start + np.uint64(key & (2**64 - 1)))

    def _once(self, x: np.ndarray, keys) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & self.mask)
        # The halves change places, so that the same rounds with reversed keys undo it.
        return (right << np.uint64(self.half)) | left

    def _walk(self, x: np.ndarray, keys) -> np.ndarray:
        out = self._once(np.asarray(x, np.uint64), keys)
        while len(beyond := np.flatnonzero(out >= self.size)):
            out[beyond] = self._once(out[beyond], keys)
        return out.astype(np.int64)

    def slot(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, self.keys)

    def index(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self.keys[::-1])


def materialise(
    docs: DataFrame,
    tokenizer: str,
    key: int = 1,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Write all sequences and return a row for each: ``slot``, ``shard``, ``position``
    (the record's first byte in its file), ``path``, ``id``, ``start``, ``length``.

    A document is its ids and a closing id 0, cut every ``length`` ids; each cut is a
    sequence. A record is the number of its ids and ``length`` ids, 0 beyond that number,
    as little-endian unsigned 32-bit and 16-bit numbers (32-bit ones for a vocabulary over
    65,536). Slots run from 0 without gaps; the same documents in the same files, key and
    settings give the same order.

    A null text is an empty one; repeated rows and null ids have sequences of their own.
    Other columns are not read. Texts are tokenised twice, first to count sequences by
    task: ``docs`` must be read from files, whose tasks get the same rows each time (a
    task that gets others stops). A shard is written by one task under a name of its own
    and renamed when complete; only the paths returned count.
    """
    spark = docs.sparkSession
    folder = folder or own_folder(spark)
    folder = folder if ":" in folder.split("/")[0] else f"file://{folder}"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        encode, n = encoder(tokenizer), 0
        for b in batches:
            n += sum(-(-(len(encode(t or "")) + 1) // length) for t in b["text"].to_pylist())
        yield {"task": [TaskContext.get().partitionId()], "n": [n]}

    # One row a task.
    counts = {r["task"]: r["n"] for r in in_arrow(rows, "task int, n long", count).collect()}
    bases, total = {}, 0
    for task in sorted(counts):
        bases[task] = total
        total += counts[task]
    wide = _vocabulary(tokenizer) > 1 << 16
    kind = "<u4" if wide else "<u2"
    order = Permutation(total, key)
    schema = StructType.fromDDL("slot long, shard int").add(rows.schema["id"])
    for name, of in (("start", "long"), ("length", "integer"), ("record", "binary")):
        schema = schema.add(name, of)

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        encode, task = encoder(tokenizer), TaskContext.get().partitionId()
        index = bases[task]
        for b in batches:
            texts = [with_end(encode(t or "")) for t in b["text"].to_pylist()]
            sizes = np.array([len(x) for x in texts], np.int64)
            rows_of = -(-sizes // length)
            first = np.cumsum(rows_of) - rows_of
            at = np.repeat(np.arange(len(texts)), rows_of)
            starts = (np.arange(len(at)) - first[at]) * length
            lengths = np.minimum(length, sizes[at] - starts)
            head = 4 // np.dtype(kind).itemsize
            block = np.zeros((len(at), head + length), kind)
            block[:, :head] = lengths.astype("<u4")[:, None].view(kind)
            for x, i, n in zip(texts, first, rows_of, strict=True):
                filled = np.zeros(n * length, kind)
                filled[: len(x)] = x
                block[i : i + n, head:] = filled.reshape(n, length)
            slots = order.slot(np.arange(index, index + len(at)))
            index += len(at)
            records = pa.Array.from_buffers(
                pa.binary(block.itemsize * block.shape[1]), len(at), [None, pa.py_buffer(block.tobytes())]
            )
            yield {
                "slot": slots, "shard": slots // shard_rows, "id": b["id"].take(pa.array(at, pa.int64())),
                "start": starts, "length": lengths, "record": records,
            }
        if index != bases[task] + counts[task]:
            raise ValueError("a task has read other rows than before; write the documents first")

    made = in_arrow(rows, schema, cut)
    n_shards = max(1, -(-total // shard_rows))
    ranged = made.repartition(n_shards, "shard").sortWithinPartitions("shard", "slot")
    out = StructType.fromDDL("slot long, shard int, position long, path string").add(rows.schema["id"])
    out = out.add("start", "long").add("length", "integer")

    def write(batches: Iterator[dict]) -> Iterator[dict]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        now, path, stream, position = None, None, None, 0

        def close():
            if stream is not None:
                stream.close()
                store.move(path + ".part", path)

        for b in batches:
            shards = b["shard"].to_numpy()
            records = b["record"].to_pylist()
            paths, positions = [], []
            for shard, record in zip(shards.tolist(), records, strict=True):
                if shard != now:
                    close()
                    now, position = shard, 0
                    path = f"{base}/shard-{shard:06d}-{uuid.uuid4().hex}.bin"
                    stream = store.open_output_stream(path + ".part", compression=None)
                stream.write(record)
                paths.append(path)
                positions.append(position)
                position += len(record)
            yield {c: b[c] for c in ("slot", "shard", "id", "start", "length")} | {
                "path": paths, "position": positions,
            }
        close()

    return written(in_arrow(ranged, out, write))


def _vocabulary(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).get_vocab_size()


def read_slots(stream, first: int, count: int, stride: int, kind: str = "<u2") -> list[np.ndarray]:
    """The ids of ``count`` records of a shard from its record ``first`` on."""
    stream.seek(first * stride)
    data = stream.read(count * stride)
    out = []
    for at in range(0, len(data), stride):
        n = int(np.frombuffer(data, "<u4", 1, at)[0])
        out.append(np.frombuffer(data, kind, n, at + 4))
    return out


def read_back(
    written_rows: DataFrame, folder: str, length: int = LENGTH, shard_rows: int = SHARD_ROWS, wide: bool = False
) -> DataFrame:
    """Per record of the shards, read from the files in order: ``slot``, ``length``,
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers)."""
    kind = "<u4" if wide else "<u2"
    stride = 4 + length * (4 if wide else 2)
    files = written_rows.groupBy("path").agg(F.min("slot").alias("first"), F.count(F.lit(1)).alias("n"))
    files = written(files)

    def read(batches: Iterator[dict]) -> Iterator[dict]:
        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path, first, n in zip(*(b[c].to_pylist() for c in ("path", "first", "n")), strict=True):
                with store.open_input_file(path) as stream:
                    for at in range(0, n, 8192):
                        got = read_slots(stream, at, min(8192, n - at), stride, kind)
                        yield {
                            "slot": np.arange(first + at, first + at + len(got)),
                            "length": [len(x) for x in got],
                            "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in got],
                        }

    spread = files.repartition(max(1, min(10_000, files.count())), "path")
    return in_arrow(spread, "slot long, length int, ids_crc32 long", read)


def training_order(docs: DataFrame, tokenizer: str, folder: str | None = None, **settings) -> DataFrame:
    """Write the shards and read them back: a row per sequence of ``materialise``, with the
    checksum of what its record holds."""
    folder = folder or own_folder(docs.sparkSession)
    folder = folder if ":" in folder.split("/")[0] else f"file://{folder}"
    rows = materialise(docs, tokenizer, folder=folder, **settings)
    of_shards = {k: v for k, v in settings.items() if k in ("length", "shard_rows")}
    held = read_back(rows, folder, wide=_vocabulary(tokenizer) > 1 << 16, **of_shards)
    # Spark estimates what is read back by the list of files: without the hint it would broadcast
    # a row for every sequence.
    return rows.drop("path").join(held.drop("length").hint("merge"), "slot")
