"""Near-duplicates: banded MinHash, sequential Bayesian pruning, exact confirmation.

Rows with equal shingle sets form a class, so that exact copies are one item from the
start. Classes that agree in a band of their signature are candidates. In a bucket of any
size the candidates are compared with one leader at a time, and what has come together is
one item for the next round; at last, members outside a bucket's largest component are
compared with all members of other components, block by block inside tasks, and only links
leave a task. So each pair of components in a bucket is either merged or was compared in
full, while no bucket yields its pairs as rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadstream.llm.common import in_arrow, written
from roadstream.llm.components import components
from roadstream.llm.shingles import set_key, shingles

#: 32 bands of 5: a pair at similarity 0.8 shares no band with probability 3e-6.
BANDS, BAND_ROWS = 32, 5
#: Minimum hashes that are compared at a time.
BATCH = 32
LEADER_ROUNDS = 2
#: A block holds about so many members, or shingles, of a bucket on either side.
BLOCK, BLOCK_SHINGLES = 512, 400_000


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
    miss: float = 1e-6,
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``n_shingles``, ``component_id``, ``kept``.

    Two rows are linked if ``100 * |A and B| >= percent * |A or B|`` for their sets of
    ``size``-word shingles; ``component_id`` is the smallest id that links lead to, the
    row's own included, and ``kept`` marks the row with that id. ``miss`` is the posterior
    probability of similarity at which a candidate is dropped before exact comparison.

    A null or empty text, or one of white space, has no shingle and is linked with
    nothing. Repeated rows are copies of each other and share ``kept``. A row without an
    id lends its links to others, has the component of its copies, if any, and is kept.
    Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = written(_prints(rows, size))
    classes = written(
        prints.where("n_shingles > 0")
        .groupBy("cls")
        .agg(
            F.min("id").alias("least"),
            F.first("n_shingles").alias("n"),
            F.first("signature").alias("signature"),
        )
    )
    labels = _linked_classes(rows, classes, size, percent, miss)
    # The smallest id of a component, for each of its classes.
    named = classes.select("cls", "least").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    lowest = (
        named.where("label is not null")
        .groupBy("label")
        .agg(F.min("least").alias("component_id"))
    )
    ends = written(
        named.join(lowest, "label", "left").select(
            "cls", F.coalesce("component_id", "least").alias("component_id")
        )
    )
    found = prints.select("id", "n_shingles", "cls").join(ends, "cls", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component_id"))
    return found.select(
        "id",
        "n_shingles",
        component.alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == component)).alias("kept"),
    )


# --- signatures ------------------------------------------------------------------------


def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    k = BANDS * BAND_ROWS
    return (
        rng.integers(0, 2**32, (k, 1), dtype=np.uint32),
        rng.integers(0, 2**31, (k, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1),
    )


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minimum of each of ``BANDS * BAND_ROWS`` permutations of 32-bit values."""
    flip, scale = _constants_once()
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(flip), 2**32 - 1, np.uint32)
    for at in range(0, len(low), 2048):
        x = (low[at : at + 2048] ^ flip) * scale
        x ^= x >> np.uint32(15)
        np.minimum(least, (x * np.uint32(0x2C1B3C6D)).min(axis=1), out=least)
    # Sixteen bits are as good as all: two differing minima agree in them once in 65,536.
    return (least >> np.uint32(16)).astype(np.uint16)


_CONSTANTS: list = []


def _constants_once() -> tuple[np.ndarray, np.ndarray]:
    if not _CONSTANTS:
        _CONSTANTS.extend(_constants())
    return _CONSTANTS[0], _CONSTANTS[1]


def _prints(rows: DataFrame, size: int) -> DataFrame:
    """(id, n_shingles, cls, signature); a class is named by a digest of its set."""

    def read(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            sets = [shingles(t, size) for t in b["text"].to_pylist()]
            yield {
                "id": b["id"],
                "n_shingles": [len(s) for s in sets],
                "cls": [set_key(s) if len(s) else None for s in sets],
                "signature": [signature(s).tobytes() if len(s) else None for s in sets],
            }

    schema = StructType([rows.schema["id"]])
    for name, kind in (("n_shingles", "long"), ("cls", "binary"), ("signature", "binary")):
        schema = schema.add(name, kind)
    return in_arrow(rows, schema, read)


# --- candidates ------------------------------------------------------------------------


def _linked_classes(
    rows: DataFrame, classes: DataFrame, size: int, percent: int, miss: float
) -> DataFrame:
    """(node, label) of the classes that are linked with another."""
    members = _members(classes)
    sets = _sets(rows, classes, members, size)
    edges, labels = None, None
    for turn in range(LEADER_ROUNDS + 1):
        if turn < LEADER_ROUNDS:
            found = _confirmed(_led(members, labels, turn), classes, sets, percent, miss)
        else:
            found = _rest(members, labels, classes, sets, percent, miss)
        found = written(found)
        edges = found if edges is None else edges.unionByName(found)
        labels = written(components(edges))
    return labels


def _members(classes: DataFrame) -> DataFrame:
    """(key, band, cls) for the buckets that hold two classes or more."""
    width = 2 * BAND_ROWS
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring("signature", b * width + 1, F.lit(width))),
    )
    banded = written(classes.select("cls", F.posexplode(keys).alias("band", "key")))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return written(banded.join(written(shared.select("key")), "key", "left_semi"))


def _with_labels(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("cls"))
    own = labels.withColumnRenamed("node", "cls")
    return members.join(own, "cls", "left").withColumn("label", F.coalesce("label", "cls"))


def _led(members: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """Each member of a bucket with the bucket's leader, unless they are in one component.

    A round has an order of its own for all buckets, so that a member mostly meets the
    same leader in each of its buckets."""
    tagged = written(_with_labels(members, labels)) if labels is not None else _with_labels(members, None)
    order = F.xxhash64("cls", F.lit(turn))
    leaders = written(
        tagged.groupBy("key").agg(
            F.min_by(F.struct("cls", "label"), F.struct(order, "cls")).alias("head")
        )
    )
    met = tagged.join(leaders, "key").where("label <> head.label")
    return _ordered(met, F.col("cls"), F.col("head.cls"))


def _rest(
    members: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, miss: float
) -> DataFrame:
    """Links of members outside their bucket's largest component with other components.

    A bucket is cut into blocks of those few members by all members. The signatures of a
    block are compared first; the full sets are fetched only for members that a likely
    pair of the block has. Of a member's links with one component the first is enough."""
    tagged = written(_with_labels(members, labels).join(classes.select("cls", "n"), "cls"))
    sizes = tagged.groupBy("key", "label").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s"))
    largest = sizes.groupBy("key").agg(
        F.max_by("label", F.struct("m", "label")).alias("largest"),
        F.max_by(F.struct("m", "s"), F.struct("m", "label")).alias("_l"),
        F.count(F.lit(1)).alias("labels"),
        F.sum("m").alias("m"),
        F.sum("s").alias("s"),
    )

    def pieces(m, s):
        return F.ceil(F.greatest(m / BLOCK, s / BLOCK_SHINGLES, F.lit(1.0))).cast("int")

    split = written(
        largest.where("labels > 1").select(
            "key",
            "largest",
            pieces(F.col("m"), F.col("s")).alias("all_"),
            pieces(F.col("m") - F.col("_l.m"), F.col("s") - F.col("_l.s")).alias("few_"),
        )
    )
    here = written(tagged.join(split, "key"))
    place = F.xxhash64("cls", F.lit(7))
    columns = ("key", "band", "cls", "label", "n")
    few = here.where("label <> largest").select(
        *columns,
        F.pmod(place, "few_").cast("int").alias("row"),
        F.explode(F.sequence(F.lit(0), F.col("all_") - 1)).alias("col"),
        F.lit(True).alias("few"),
    )
    every = here.select(
        *columns,
        F.explode(F.sequence(F.lit(0), F.col("few_") - 1)).alias("row"),
        F.pmod(place, "all_").cast("int").alias("col"),
        F.lit(False).alias("few"),
    )
    both = few.unionByName(every).join(classes.select("cls", "signature"), "cls")
    needed = least_matches(percent, miss)
    block = ["key", "row", "col"]

    def likely(group: pa.Table) -> pa.Table:
        x, y = (group.filter(pa.compute.equal(group["few"], side)) for side in (True, False))
        if len(x) and len(y):
            i, j = _likely_pairs(x, y, percent, needed)
            x, y = x.take(pa.array(np.unique(i))), y.take(pa.array(np.unique(j)))
        else:
            x, y = x.slice(0, 0), y.slice(0, 0)
        return pa.concat_tables([x, y]).select([*block, "cls", "label", "few"])

    schema = "key long, row int, col int, cls binary, label binary, few boolean"
    maybe = written(both.groupBy(*block).applyInArrow(likely, schema))

    def linked(group: pa.Table) -> pa.Table:
        x, y = (group.filter(pa.compute.equal(group["few"], side)) for side in (True, False))
        a, b = _links(x, y, percent)
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    found = maybe.join(sets, "cls").groupBy(*block).applyInArrow(linked, "a binary, b binary")
    return _ordered(found, F.col("a"), F.col("b"))


def _likely_pairs(x: pa.Table, y: pa.Table, percent: int, needed: list[int]):
    """Positions (i, j) of the pairs of a block that signatures don't rule out, each pair in
    the first band that it shares."""
    left, right = (
        np.frombuffer(b"".join(t["signature"].to_pylist()), np.uint16).reshape(len(t), -1) for t in (x, y)
    )
    n, m = (t["n"].to_numpy().astype(np.float64) for t in (x, y))
    named: dict[bytes, int] = {}
    of_x, of_y = (
        np.array([named.setdefault(v, len(named)) for v in t["label"].to_pylist()]) for t in (x, y)
    )
    at, to = [], []
    for lo in range(0, len(x), 64):
        part = slice(lo, lo + 64)
        small = np.minimum(n[part, None], m[None, :])
        fits = 100 * small >= percent * np.maximum(n[part, None], m[None, :])
        i, j = np.nonzero(fits & (of_x[part, None] != of_y[None, :]))
        i += lo
        same = np.zeros(len(i), np.int32)
        for k, least in enumerate(needed):
            batch = slice(k * BATCH, (k + 1) * BATCH)
            same += (left[i, batch] == right[j, batch]).sum(axis=1, dtype=np.int32)
            stay = same >= least
            i, j, same = i[stay], j[stay], same[stay]
        agree = (left[i] == right[j]).reshape(-1, BANDS, BAND_ROWS).all(axis=2)
        first = agree.argmax(axis=1) == x["band"][0].as_py() if len(i) else np.zeros(0, bool)
        at.append(i[first])
        to.append(j[first])
    return np.concatenate(at), np.concatenate(to)


def _links(x: pa.Table, y: pa.Table, percent: int) -> tuple[list[bytes], list[bytes]]:
    """Exact links between the two sides of a block, one per member and component."""
    if not len(x) or not len(y):
        return [], []
    sets = [v.values.to_numpy() for t in (x, y) for v in t["hashes"]]
    sizes = np.array([len(s) for s in sets])
    every, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    k = len(x)
    both = np.zeros((k, len(y)), np.float32)
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    for lo in range(0, len(every), 4096):
        cut = slice(*np.searchsorted(number, [lo, lo + 4096]))
        has = np.zeros((len(sets), 4096), np.float32)
        has[owner[cut], number[cut] - lo] = 1
        both += has[:k] @ has[k:].T
    union = sizes[:k, None] + sizes[None, k:] - both
    names, labels = x["cls"].to_pylist(), x["label"].to_pylist()
    others, of = y["cls"].to_pylist(), y["label"].to_pylist()
    a, b = [], []
    for i, row in enumerate(100 * both >= percent * union):
        done = {labels[i]}
        for j in np.flatnonzero(row):
            if of[j] not in done:
                done.add(of[j])
                a.append(names[i])
                b.append(others[j])
    return a, b


def _ordered(met: DataFrame, x, y) -> DataFrame:
    return met.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


# --- comparison ------------------------------------------------------------------------


def least_matches(percent: int, miss: float, batch: int = BATCH) -> list[int]:
    """After each batch of minimum hashes, the fewest matches with which a pair goes on.

    With a uniform prior the similarity has, after m matches in n, a Beta(m + 1, n - m + 1)
    posterior, and P(similarity >= t) = P(Binomial(n + 1, t) <= m). A pair is dropped when
    that falls below ``miss``."""
    t, out = percent / 100, []
    for n in range(batch, BANDS * BAND_ROWS + 1, batch):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def _confirmed(
    pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, miss: float
) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    signs = classes.select("cls", "signature", "n")
    a = signs.select(F.col("cls").alias("a"), F.col("signature").alias("_sa"), F.col("n").alias("_na"))
    b = signs.select(F.col("cls").alias("b"), F.col("signature").alias("_sb"), F.col("n").alias("_nb"))
    needed = least_matches(percent, miss)

    @F.pandas_udf("boolean")
    def likely(x: pd.Series, y: pd.Series) -> pd.Series:
        alive = np.ones(len(x), bool)
        if len(x):
            same = np.zeros(len(x), np.int64)
            left = np.frombuffer(b"".join(x), np.uint16).reshape(len(x), -1)
            right = np.frombuffer(b"".join(y), np.uint16).reshape(len(y), -1)
            for i, least in enumerate(needed):
                at = np.flatnonzero(alive)
                part = slice(i * BATCH, (i + 1) * BATCH)
                same[at] += (left[at, part] == right[at, part]).sum(axis=1)
                alive[at] = same[at] >= least
        return pd.Series(alive)

    # Sets whose sizes alone forbid the similarity are no candidates.
    fits = F.expr(f"100 * least(_na, _nb) >= {percent} * greatest(_na, _nb)")
    maybe = written(
        pairs.join(a, "a").join(b, "b").where(fits).where(likely("_sa", "_sb")).select("a", "b")
    )
    left = sets.select(F.col("cls").alias("a"), F.col("hashes").alias("_ha"))
    right = sets.select(F.col("cls").alias("b"), F.col("hashes").alias("_hb"))
    both = F.size(F.array_intersect("_ha", "_hb")).cast("long")
    union = F.size("_ha") + F.size("_hb") - both
    return (
        maybe.join(left, "a")
        .join(right, "b")
        .where(100 * both >= percent * union)
        .select("a", "b")
    )


def _sets(rows: DataFrame, classes: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """(cls, hashes): the full sets of the classes that share a bucket with another."""
    wanted = members.select("cls").distinct()
    names = written(classes.select("cls", "least").join(wanted, "cls", "left_semi"))
    # A class of rows without ids is looked for by its set alone.
    nameless = names.where("least is null").limit(1).count() > 0
    ids = names.select(F.col("least").alias("id")).where("id is not null").distinct()
    texts = rows.join(ids, "id", "left_semi")
    if nameless:
        texts = texts.unionByName(rows.where("id is null"))

    def read(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            found = [shingles(t, size) for t in b["text"].to_pylist()]
            found = [s for s in found if len(s)]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in found])])
            flat = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
            yield {
                "cls": [set_key(s) for s in found],
                "hashes": pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            }

    made = in_arrow(texts.select("text"), "cls binary, hashes array<long>", read)
    found = written(made.join(names.select("cls"), "cls", "left_semi"))
    # Repeated ids may bring a set twice.
    return written(found.dropDuplicates(["cls"])) if nameless or _repeats(found) else found


def _repeats(found: DataFrame) -> bool:
    return found.groupBy("cls").count().where("count > 1").limit(1).count() > 0
