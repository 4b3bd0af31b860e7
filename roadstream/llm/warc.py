"""WARC archives whose records are compressed one by one with a shared dictionary.

An archive begins with a skippable frame (magic number 0x184D2A5D) that holds the
Zstandard dictionary; each record is a frame of its own, so that a reader that has the
dictionary can begin at any record's offset.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadstream.llm.common import in_arrow, own_folder, written
from roadstream.plans import fits_broadcast

MAGIC = 0x184D2A5D
#: Payloads below this length are stored again rather than referred to.
LEAST_REVISIT = 100
#: The dictionary is built from at most so many records and bytes of each.
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 4096, 112_640
#: Archives are closed when they have grown to this.
ARCHIVE_BYTES = 512 << 20
LEVEL = 6
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


# --- one archive -----------------------------------------------------------------------


def train(samples: list[bytes]) -> bytes:
    """A dictionary from sample records; empty where there is too little to learn from."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", MAGIC, len(dictionary)) + dictionary


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields)
    return head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, rest[:n]


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive, one in memory at a time."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != MAGIC:
        raise ValueError("the archive does not begin with a dictionary")
    dictionary = stream.read(size)
    given = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    decompressor, data = zstandard.ZstdDecompressor(**given), b""
    while data or (data := stream.read(1 << 20)):
        one, out = decompressor.decompressobj(), []
        while True:
            out.append(one.decompress(data))
            if one.eof:
                data = one.unused_data
                break
            if not (data := stream.read(1 << 20)):
                raise ValueError("the archive ends within a record")
        yield parsed(b"".join(out))


# --- Spark -----------------------------------------------------------------------------


def with_revisits(pages: DataFrame, id_col: str, least: int) -> DataFrame:
    """Add ``digest`` and ``refers_to``: the smallest id with an equal payload of at least
    ``least`` bytes where that is another row's, else null. Payloads are not shuffled while
    they are compared, only their digests."""
    marked = pages.withColumn("digest", F.sha2("payload", 256))
    long_ = marked.where(F.octet_length("payload") >= least)
    firsts = written(
        long_.groupBy("digest")
        .agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    # One row per payload that has copies; past the limit the pages are shuffled.
    firsts = F.broadcast(firsts) if fits_broadcast(firsts) else firsts
    found = marked.join(firsts, "digest", "left")
    later = (F.col(id_col).isNull() & F.col("_first").isNotNull()) | (F.col(id_col) > F.col("_first"))
    own = F.octet_length("payload") >= least
    return found.withColumn("refers_to", F.when(own & later, F.col("_first"))).drop("_first")


def _sample(pages: DataFrame) -> list[bytes]:
    """Records for the dictionary, the same in every run: those with the smallest hashes."""
    order = F.xxhash64("digest")
    rows = pages.where("refers_to is null").orderBy(order, "digest").select(
        "id", "url", "digest", F.substring("payload", 1, SAMPLE_BYTES).alias("payload")
    )
    return [_response(r["id"], r["url"], r["digest"], bytes(r["payload"])) for r in rows.limit(SAMPLES).collect()]


def _urn(page) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page/{page}')}>"


def _common(kind: str, page, url: str | None, digest: str) -> list[tuple[str, str]]:
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    return [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _urn(page)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        *([("WARC-Target-URI", target)] if target else []),
        *([("X-Page-ID", str(page))] if page is not None else []),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]


def _response(page, url, digest, payload: bytes) -> bytes:
    return record([*_common("response", page, url, digest), ("Content-Type", "text/html")], payload)


def _revisit(page, url, digest, first, size: int) -> bytes:
    return record(
        [
            *_common("revisit", page, url, digest),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _urn(first)),
            ("X-Refers-To-Page-ID", str(first)),
            ("X-Payload-Length", str(size)),
        ],
        b"",
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_revisit: int = LEAST_REVISIT,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per row below ``folder`` and return the archives (``path``,
    ``records``, ``bytes``).

    The payload is the UTF-8 text of ``payload_col``, null being empty. Of rows with equal
    payloads of ``least_revisit`` bytes or more, that with the smallest id is the response
    and the others revisit it; shorter ones are all responses. Repeated rows with that
    smallest id are all responses; a null id comes after every other, and if all are null,
    all are responses. A null or empty url has no target field; characters that a header
    cannot hold are escaped in it. Other columns are not read.

    A task writes under a name of its own and renames the file when it is complete; only
    the archives returned count, so what a lost task left is never read. ``folder`` must
    be one that executors reach by ``pyarrow.fs``. Dictionary and records need nothing but
    the archive itself to be read.
    """
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.encode(F.col(payload_col), "UTF-8"), F.lit(b"")).alias("payload"),
    )
    rows = with_revisits(rows, "id", least_revisit)
    shared = pages.sparkSession.sparkContext.broadcast(train(_sample(rows)))

    def write(batches: Iterator[dict]) -> Iterator[dict]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        dictionary = shared.value
        given = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        compressor = zstandard.ZstdCompressor(level=LEVEL, **given)
        out = None
        done: list[tuple[str, int, int]] = []

        def close():
            out["stream"].close()
            store.move(out["path"] + ".part", out["path"])
            done.append((out["path"], out["records"], out["bytes"]))

        for b in batches:
            columns = [b[c].to_pylist() for c in ("id", "url", "digest", "payload", "refers_to")]
            for page, url, digest, payload, first in zip(*columns, strict=True):
                if out is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.zst"
                    head = dictionary_frame(dictionary)
                    out = {"path": path, "stream": store.open_output_stream(path + ".part", compression=None), "records": 0, "bytes": len(head)}
                    out["stream"].write(head)
                one = (
                    _response(page, url, digest, payload)
                    if first is None
                    else _revisit(page, url, digest, first, len(payload))
                )
                frame = compressor.compress(one)
                out["stream"].write(frame)
                out["records"] += 1
                out["bytes"] += len(frame)
                if out["bytes"] >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        paths, records, sizes = zip(*done, strict=True) if done else ((), (), ())
        yield {"path": list(paths), "records": list(records), "bytes": list(sizes)}

    return written(in_arrow(rows, "path string, records long, bytes long", write))


def read_archives(spark: SparkSession, archives: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """A row per record: ``page_id``, ``url``, ``record_type``, ``payload_bytes``,
    ``payload_digest``, ``refers_to``, ``payload`` (null for a revisit).

    Archives are spread over tasks by their number; length and digest of a response are
    those of the payload read, and a digest that differs from the header's is an error."""
    names = {"page_id": "string", "url": "string", "record_type": "string", "payload_bytes": "long",
             "payload_digest": "string", "refers_to": "string", "payload": "binary"}
    schema = StructType()
    for name, kind in names.items():
        schema = schema.add(name, kind)

    def read(batches: Iterator[dict]) -> Iterator[dict]:
        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path in b["path"].to_pylist():
                with store.open_input_stream(path, compression=None) as stream:
                    rows, size = [], 0
                    for fields, block in read_archive(stream):
                        rows.append(_row(fields, block))
                        size += len(block)
                        if size > 16 << 20 or len(rows) >= 5000:
                            yield {n: list(c) for n, c in zip(names, zip(*rows, strict=True), strict=True)}
                            rows, size = [], 0
                    if rows:
                        yield {n: list(c) for n, c in zip(names, zip(*rows, strict=True), strict=True)}

    paths = archives.select("path")
    n = max(1, min(10_000, archives.count()))
    got = in_arrow(paths.repartition(n), schema, read)
    ids = {c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")}
    return got.withColumns(ids)


def _row(fields: dict[str, str], block: bytes) -> tuple:
    kind, named = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    size = len(block)
    if kind == "revisit":
        size = int(fields["X-Payload-Length"])
    elif hashlib.sha256(block).hexdigest() != named:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} has another digest")
    return (
        fields.get("X-Page-ID"),
        fields.get("WARC-Target-URI"),
        kind,
        size,
        named,
        fields.get("X-Refers-To-Page-ID"),
        block if kind == "response" else None,
    )


def archived(pages: DataFrame, folder: str | None = None, **columns: str) -> DataFrame:
    """Write ``pages`` and read the archives back."""
    spark = pages.sparkSession
    folder = folder or own_folder(spark)
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    kind = pages.schema[columns.get("id_col", "page_id")].dataType.simpleString()
    return read_archives(spark, write_archives(pages, folder, **columns), folder, kind)
