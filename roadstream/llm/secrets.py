"""Secrets in texts, and who owns them across the corpus.

Candidates are matched in every text; their values are hashed, and the hashes are counted
by distinct repository and owner. A value that many owners show is an example that has
been copied around, and so is one that says so; one that few show, and that looks random,
may be live. All but examples are redacted.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadstream.llm.common import in_arrow, written
from roadstream.plans.dimensions import BROADCAST_BYTES

#: In the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "opaque")
BASE = KINDS[:3]

# Fixed patterns. Letters of the names are ASCII in either case.
_NAMES = ("password", "passwd", "secret", "token", "api_?key")
_EITHER = "|".join(re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", n) for n in _NAMES)
ASSIGN = re.compile(rf"""({_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_LONG_HEX = re.compile("[0-9a-f]{24}")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Bits a character from which an opaque value, or a live one, looks random.
RANDOM_BITS = 3.0
#: Seven characters have less than 3 bits each at most: of a short value this share of what
#: its length can reach is enough.
RANDOM_SHARE = 0.85
#: Words and runs of six letters or more, which random values hardly hold.
PLACEHOLDER = re.compile("example|sample|placeholder|change_?me|redacted|x{6}", re.I)
OPAQUE_BITS = 3.5


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def looks_random(value: str) -> bool:
    return entropy(value) >= min(RANDOM_BITS, RANDOM_SHARE * math.log2(max(len(value), 2)))


def spans(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the candidates, by start, then kind."""
    if not text:
        return []
    out = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= LEAST["assign"]:
            out.append((m.start(), m.end(), "assign", m[2]))
    for m in ACCESS.finditer(text):
        if len(m[0]) >= LEAST["access"]:
            out.append((m.start(), m.end(), "access", m[0]))
    # A run of 24 is looked for first; the run is then widened to all of it.
    at = 0
    while m := _LONG_HEX.search(text, at):
        end = HEX.match(text, m.start()).end()
        out.append((m.start(), end, "hex", text[m.start() : end]))
        at = end
    taken, at = _disjoint((s, e) for s, e, _, _ in out), 0
    for m in OPAQUE.finditer(text):
        value = m[0]
        # Both go from left to right, so that each span is passed once.
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if (at == len(taken) or taken[at][0] >= m.end()) and _looks_opaque(value):
            out.append((m.start(), m.end(), "opaque", value))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _disjoint(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same positions as spans that do not meet, by start."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def _looks_opaque(value: str) -> bool:
    digits = sum(c.isdigit() for c in value)
    return (
        digits >= 3
        and any(c.islower() for c in value)
        and any(c.isupper() for c in value)
        and entropy(value) >= OPAQUE_BITS
    )


def listed(found: list[tuple[int, int, str, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in found)


def candidates(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text, and columns that are passed on) without the text, with ``spans``,
    an array of (start, end, kind, value_hash, random, placeholder)."""
    carried = [f for f in rows.schema.fields if f.name != "text"]
    item = "start: int, end: int, kind: string, value_hash: binary, random: boolean, placeholder: boolean"
    schema = StructType([*carried, *StructType.fromDDL(f"spans array<struct<{item}>>")])
    kind = pa.list_(
        pa.struct(
            [
                ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value_hash", pa.binary()),
                ("random", pa.bool_()), ("placeholder", pa.bool_()),
            ]
        )
    )

    def read(batches: Iterator[dict]) -> Iterator[dict]:
        from hashlib import blake2b

        for b in batches:
            out = [
                [
                    {
                        "start": s,
                        "end": e,
                        "kind": k,
                        "value_hash": blake2b(v.encode("utf-8", "surrogatepass"), digest_size=16).digest(),
                        "random": looks_random(v),
                        "placeholder": PLACEHOLDER.search(v) is not None,
                    }
                    for s, e, k, v in spans(text)
                ]
                for text in b["text"].to_pylist()
            ]
            yield {**{f.name: b[f.name] for f in carried}, "spans": pa.array(out, kind)}

    return in_arrow(rows, schema, read)


def ownership(found: DataFrame) -> DataFrame:
    """(value_hash, repositories, owners, occurrences) over the whole corpus. Occurrences
    are first added up by (value, repository, owner), so that a value in a third of all
    rows is a few rows by the time it is gathered."""
    seen = found.select("repository", "owner", F.explode("spans").alias("s")).groupBy(
        F.col("s.value_hash").alias("value_hash"), "repository", "owner"
    )
    by_owner = seen.agg(F.count(F.lit(1)).alias("occurrences"))
    repositories = by_owner.groupBy("value_hash", "repository").agg(
        F.sum("occurrences").alias("occurrences")
    )
    per_value = repositories.groupBy("value_hash").agg(
        F.count(F.lit(1)).alias("repositories"), F.sum("occurrences").alias("occurrences")
    )
    owners = (
        by_owner.groupBy("value_hash", "owner").agg(F.lit(1).alias("one"))
        .groupBy("value_hash").agg(F.count(F.lit(1)).alias("owners"))
    )
    return per_value.join(owners, "value_hash")


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repository_col: str = "source",
    owner_col: str = "source",
    live_owners: int = 1,
    example_owners: int = 10,
    keep_rows: bool = False,
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``repository``, ``owner`` and ``spans``, an array by
    start of (start, end, kind, repositories, owners, occurrences, verdict); with
    ``keep_rows`` also the row itself as the struct ``row``.

    Offsets are code points, the end exclusive. ``verdict`` is "example" for a value that
    ``example_owners`` owners or more show or that has the form of a placeholder, "live" for
    one that looks random for its length and that at most ``live_owners`` show, else "unclear". Kinds are ``assign``, ``access``, ``hex``,
    and, outside these, ``opaque``: 20 characters or more of mixed case and digits with
    high entropy.

    Null and empty texts have no span. A null repository or owner counts as one of its
    own. Repeated rows are the same repository and owner, so copies of a row leave the
    verdict as it is. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.col(repository_col).cast("string").alias("repository"),
        F.col(owner_col).cast("string").alias("owner"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_rows else []),
    )
    found = candidates(rows)
    keys = [c for c in ("id", "repository", "owner", "row") if c in rows.columns]
    # A row's number ties its spans together again, as ids may be null or repeat.
    found = written(found.withColumn("_no", F.monotonically_increasing_id()))
    have = found.where(F.size("spans") > 0)
    owners = written(ownership(have))
    each = have.select("_no", F.explode("spans").alias("s")).withColumn("value_hash", F.col("s.value_hash"))
    verdict = (
        F.when((F.col("owners") >= example_owners) | F.col("s.placeholder"), "example")
        .when((F.col("owners") <= live_owners) & F.col("s.random"), "live")
        .otherwise("unclear")
    )
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("s.kind")).cast("int")
    judged = each.join(owners, "value_hash").select(
        "_no",
        F.struct(
            F.col("s.start").alias("start"),
            order.alias("_order"),
            F.col("s.end").alias("end"),
            F.col("s.kind").alias("kind"),
            "repositories",
            "owners",
            "occurrences",
            verdict.alias("verdict"),
        ).alias("s"),
    )
    # A text's spans are as many as its length allows.
    lists = judged.groupBy("_no").agg(F.sort_array(F.collect_list("s")).alias("_spans"))
    names = ("start", "end", "kind", "repositories", "owners", "occurrences", "verdict")
    plain = F.transform("_spans", lambda s: F.struct(*[s[n].alias(n) for n in names]))
    with_spans = have.select(*keys, "_no").join(lists, "_no").select(*keys, plain.alias("spans"))
    # Texts without a span need no join; their rows are not shuffled.
    without = found.where(F.size("spans") == 0)
    return with_spans.unionByName(without.select(*keys, F.array().cast(_span_type()).alias("spans")))


def _span_type() -> str:
    return (
        "array<struct<start: int, end: int, kind: string, repositories: bigint, "
        "owners: bigint, occurrences: bigint, verdict: string>>"
    )


def redacted(text: str, at: list[tuple[int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with the given spans replaced; spans that overlap become one."""
    out, last = [], 0
    for start, end in sorted(at):
        if start >= last:
            out += [text[last:start], mark]
        last = max(last, end)
    return "".join([*out, text[last:]])


def hidden() -> Column:
    """(start, end) of the ``spans`` of a scan that are not examples."""
    return F.transform(F.filter("spans", lambda s: s["verdict"] != "example"), lambda s: F.struct(s["start"], s["end"]))


def _replaced(text: str, at: str) -> Column:
    @F.pandas_udf("string")
    def replaced(texts: pd.Series, at: pd.Series) -> pd.Series:
        found = [redacted(t, [tuple(s.values()) for s in spans]) for t, spans in zip(texts, at, strict=True)]
        return pd.Series(found, dtype=object)

    return replaced(text, at)


def redact_rows(docs: DataFrame, at: DataFrame, names: list[str], text_col: str = "text") -> DataFrame:
    """``docs`` without its columns ``names``, with the spans ``_at`` of the written table
    ``at`` replaced in the texts of the rows that these columns name. Only such rows go through
    Python, and texts are shuffled only if the table is too large for every task."""
    size = F.sum(F.length(names[0]) + F.size("_at") * 16 + 64).alias("n")
    if (at.agg(size).first()["n"] or 0) <= BROADCAST_BYTES:
        at = F.broadcast(at)
    columns = [c for c in docs.columns if c not in names]
    marked = docs.join(at, names).withColumn("_text", _replaced(f"`{text_col}`", "_at"))
    marked = marked.select(*[F.col("_text" if c == text_col else f"`{c}`").alias(c) for c in columns])
    return marked.unionByName(docs.join(at, names, "left_anti").select(*[f"`{c}`" for c in columns]))


def redact(scanned: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of a ``scan`` with ``keep_rows``; what is not an example is replaced in
    their texts: a key that two owners show is no less a key."""
    rows = scanned.select("row", hidden().alias("_at"))
    names = scanned.schema["row"].dataType.names
    marked = rows.where(F.size("_at") > 0).withColumn("_text", _replaced(f"row.`{text_col}`", "_at"))
    marked = marked.select(*[F.col("_text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in names])
    return marked.unionByName(rows.where(F.size("_at") == 0).select("row.*"))


def digests(scanned: DataFrame) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of the contract."""

    def text_of(items):
        one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(items, one), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def verdicts(name: str):
        return F.size(F.filter("spans", lambda s: s["verdict"] == name)).cast("long").alias(f"n_{name}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return scanned.select(
        "id",
        *[number(k) for k in BASE],
        F.sha2(text_of(base), 256).alias("base_sha256"),
        text_of(F.col("spans")).alias("spans"),
        verdicts("live"),
        verdicts("example"),
    )
