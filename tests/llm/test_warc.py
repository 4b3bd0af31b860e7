import hashlib
import io
import random
import struct
from collections import Counter

import pytest
import zstandard

from roadstream.llm import warc as W
from pyspark.sql import functions as F


def brute_force(rows):
    payloads = [(i, (html or "").encode()) for i, _, html in rows]
    smallest = {}
    for i, p in payloads:
        if i is not None and len(p) >= 100:
            smallest[p] = min(i, smallest.get(p, i))
    out = []
    for i, p in payloads:
        first = smallest.get(p)
        again = first is not None and i != first
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first if again else None))
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    page = lambda n: "<html><p>" + " ".join(rng.choice(["tree", "häuser", "😀", "\r\n\r\n"]) for _ in range(n)) + "</p></html>"
    out = [(i, f"http://a.example/{i}", page(rng.randrange(1, 300))) for i in range(200)]
    out += [(300 + i, "http://b.example/", out[5][2]) for i in range(60)]
    out += [(400, None, None), (401, "", ""), (402, "http://x/ \r\nWARC-Type: bad", "<a>"), (403, "u", "<a>")]
    out += [(500, "u", "x" * 99), (501, "u", "x" * 99), (502, "u", "y" * 100), (503, "u", "y" * 100)]
    out += [(5, "http://a.example/5", out[5][2]), (None, "u", out[5][2]), (None, None, "z" * 200), (600, "u", page(400_000))]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("size", [W.ARCHIVE_BYTES, 2000])
def test_round_trip(spark, tmp_path, rows, size):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    pages = pages.withColumn("payload", F.lit(1)).withColumn("digest", F.lit("x"))
    folder = f"file://{tmp_path}/archives"
    archives = W.write_archives(pages, folder, archive_bytes=size)
    got = W.read_archives(spark, archives, folder).collect()
    assert archives.agg(F.sum("records")).first()[0] == len(rows) == len(got)
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(tuple(r[n] for n in names) for r in got) == brute_force(rows)
    kept = Counter((r["page_id"], bytes(r["payload"])) for r in got if r["record_type"] == "response")
    whole = Counter((i, (h or "").encode()) for i, _, h in rows)
    assert all(whole[k] == n for k, n in kept.items())


def test_archives_stand_alone(spark, tmp_path, rows):
    """The leading frame holds the dictionary, and each record is a frame of its own."""
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    W.write_archives(pages, f"file://{tmp_path}/a")
    (path,) = (tmp_path / "a").glob("*.warc.zst")
    data = path.read_bytes()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and size > 0
    one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    at, n = 8 + size, 0
    while at < len(data):
        d = one.decompressobj()
        fields, _ = W.parsed(d.decompress(data[at:]))
        at, n = len(data) - len(d.unused_data), n + 1
    assert n == len(rows)
    assert not list((tmp_path / "a").glob("*.part"))


def test_damage_is_noticed():
    good = W.dictionary_frame(b"") + zstandard.compress(W._response(1, "u", "0" * 64, b"abc"))
    ((fields, block),) = W.read_archive(io.BytesIO(good))
    assert block == b"abc"
    with pytest.raises(ValueError):
        W._row(fields, block)
    with pytest.raises(ValueError):
        list(W.read_archive(io.BytesIO(good[:-3])))


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.archived(pages, str(tmp_path / "none")).count() == 0
