"""Repair of conversations by a Viterbi search whose chunks run in parallel.

The cheapest edits that leave a legal order of roles are a shortest path over four states:
nothing yet, after the system turn, after a user, after an assistant. ``Search`` computes the
cost to go backward over the rows; the path is then traced forward, taking of equally cheap
edits the one whose letter is least.

Rows are sorted by conversation over the cluster and cut into chunks. A conversation that lies
inside one task is solved there. One that is cut starts every chunk from a speculative vector
of costs at its right end. Fix-up passes hand each chunk the vector its right neighbour found:
the chunk reruns from the right until old and new vectors differ only by a constant, from
where on everything before it holds as well. Once no chunk changes, the stitched vectors give
each chunk the state it leaves in for every state it may be entered in; these maps are
composed along a conversation by doubling, and every chunk is traced from its own entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from roadstream.llm.common import in_arrow, written

#: Rows and characters of a chunk; a row is never cut.
CHUNK_ROWS, CHUNK_CHARS = 4096, 4 << 20
#: Chunks of one conversation that a fix-up pass chains in a task, at most.
REACH = 4096

WHITE = " \t\n\v\f\r"
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
ACCEPTED = (START, AFTER_ASSISTANT)
#: The state behind the one role that may be put in, and that role.
ONWARD = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
ROLE = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
#: A row's code is its initial (system, user, assistant, other) and four times its fault.
INITIALS = "sua"
PLAIN, TRUNCATED, BLANK, DUPLICATE = range(4)
KEPT = ({START: AFTER_SYSTEM}, {START: AFTER_USER, AFTER_SYSTEM: AFTER_USER, AFTER_ASSISTANT: AFTER_USER}, {AFTER_USER: AFTER_ASSISTANT}, {})
LEGAL = {(0, 1), (1, 2), (2, 1)}
RELABEL, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3

Vector = tuple[int, ...]


@dataclass(frozen=True)
class Move:
    """Edits at one row: their letters, the role given by each one that leaves a line (None:
    its own), the state behind them and their cost."""

    letters: str
    roles: tuple[str | None, ...]
    state: int
    cost: int


def _with_inserts(costs: list[int]) -> list[int]:
    for _ in range(3):
        costs = [min(c, INSERT + costs[ONWARD[q]]) for q, c in enumerate(costs)]
    return costs


class Search:
    """Steps of the search, each computed once: few vectors occur."""

    def __init__(self) -> None:
        ends = _with_inserts([0 if q in ACCEPTED else 1 << 20 for q in range(4)])
        self.end: Vector = tuple(ends)
        self.closing = [self._path(q, ends, {}) for q in range(4)]
        self._steps: dict[tuple[Vector, int], tuple[Vector, list[Move]]] = {}

    def step(self, after: Vector, code: int) -> tuple[Vector, list[Move]]:
        """From the costs behind a row those before it, less a constant, and each state's move."""
        known = self._steps.get((after, code))
        if known is None:
            options = [self._edits(q, after, code) for q in range(4)]
            costs = _with_inserts([min(c for c, _, _ in o.values()) for o in options])
            moves = [self._path(q, costs, options) for q in range(4)]
            least = min(costs)
            known = self._steps[after, code] = tuple(c - least for c in costs), moves
        return known

    @staticmethod
    def _edits(state: int, after: Vector, code: int) -> dict[str, tuple[int, int, int]]:
        """By letter: cost to go, the state behind the row, and the edit's own cost."""
        fault, initial = divmod(code, 4)
        out = {"D": (DELETE + after[state], state, DELETE)}
        if fault in (PLAIN, TRUNCATED):
            extra = UNFINISHED if fault == TRUNCATED else 0
            if state in KEPT[initial]:
                behind = KEPT[initial][state]
                out["K"] = (extra + after[behind], behind, extra)
            behind = ONWARD[state]
            out["R"] = (RELABEL + extra + after[behind], behind, RELABEL + extra)
        return out

    @staticmethod
    def _path(state: int, costs: list[int], options) -> Move:
        """The least letters from a state through one row, or to the end where there is none."""
        letters, roles, spent = "", [], 0
        while options or state not in ACCEPTED or costs[state]:
            here = options[state] if options else {}
            ways = {k: v for k, v in here.items() if v[0] == costs[state]}
            if INSERT + costs[ONWARD[state]] == costs[state]:
                ways["I"] = (0, ONWARD[state], INSERT)
            letter = min(ways)
            _, behind, cost = ways[letter]
            letters, spent = letters + letter, spent + cost
            if letter != "D":
                roles.append(None if letter == "K" else ROLE[behind])
            state = behind
            if letter != "I":
                break
        return Move(letters, tuple(roles), state, spent)

    def before(self, codes: bytes, after: Vector) -> Vector:
        """The costs at the left end of a chunk."""
        for code in reversed(codes):
            after = self.step(after, code)[0]
        return after

    def fixed(self, codes: bytes, old: Vector, new: Vector, before: Vector) -> Vector:
        """The same for a new right end: ``before`` holds as soon as the vectors, which are
        kept less a constant, agree."""
        for code in reversed(codes):
            if old == new:
                return before
            old, new = self.step(old, code)[0], self.step(new, code)[0]
        return new

    def moves(self, codes: bytes, after: Vector) -> list[list[Move]]:
        """Each row's move from every state."""
        out = []
        for code in reversed(codes):
            after, moves = self.step(after, code)
            out.append(moves)
        return out[::-1]

    def exits(self, codes: bytes, after: Vector) -> list[int]:
        """The state a chunk is left in, by the one it is entered in."""
        states = list(range(4))
        for moves in self.moves(codes, after):
            states = [moves[q].state for q in states]
        return states

    def trace(self, codes: bytes, after: Vector, state: int, last: bool) -> tuple[list[Move], int]:
        """The moves of a chunk's rows, at the very end also those behind them, and their cost."""
        path = []
        for moves in self.moves(codes, after):
            path.append(moves[state])
            state = path[-1].state
        if last:
            path.append(self.closing[state])
        return path, sum(m.cost for m in path)


def _lines(path: list[Move], roles: list[str], texts: list[str]) -> list[str]:
    """``role:text`` of every line that the moves leave."""
    out = []
    for at, move in enumerate(path):
        given = iter(move.roles)
        for letter in move.letters:
            if letter == "I":
                out.append(f"{next(given)}:")
            elif letter != "D":
                out.append(f"{next(given) or roles[at]}:{texts[at]}")
    return out


@dataclass
class Rows:
    """Rows of one conversation in order."""

    conv: object
    turns: list[int | None] = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    chars: int = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(role) + len(text)

    def codes(self) -> tuple[bytes, list[dict]]:
        """The code of every row, and the digests of those that are not blank and first here."""
        codes, first, seen = bytearray(), [], set()
        for at, (role, text) in enumerate(zip(self.roles, self.texts, strict=True)):
            end = text.rstrip(WHITE)
            digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
            if not end:
                fault = BLANK
            elif digest in seen:
                fault = DUPLICATE
            else:
                fault = PLAIN if end[-1] in ".!?" else TRUNCATED
                seen.add(digest)
                first.append({"at": at, "digest": digest})
            initial = INITIALS.find(role[:1]) if role else -1
            codes.append(4 * fault + (initial if initial >= 0 else 3))
        return bytes(codes), first


def _counts(codes: bytes) -> dict:
    initials = [c % 4 for c in codes]
    faults = [codes.count(bytes([4 * f + i])) for f in range(4) for i in range(4)]
    return {
        "blank": sum(faults[4 * BLANK : 4 * BLANK + 4]),
        "duplicate": sum(faults[4 * DUPLICATE : 4 * DUPLICATE + 4]),
        "truncated": sum(faults[4 * TRUNCATED : 4 * TRUNCATED + 4]),
        "illegal": sum((a, b) not in LEGAL for a, b in zip(initials, initials[1:])),
    }


_FOUND = "blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint, cost: bigint, audit: string, lines: array<string>"
_CHUNK = (
    f"task: int, nth: int, whole: boolean, low: bigint, high: bigint, turns: bigint, {_FOUND}, "
    "codes: binary, firsts: array<struct<at: int, digest: binary>>, roles: array<string>, texts: array<string>"
)
_VECTOR = ArrayType(IntegerType())


def _chunk(part: Rows, whole: bool, search: Search) -> dict:
    codes, firsts = part.codes()
    turns = {t for t in part.turns if t is not None}
    row = {"conv": part.conv, "whole": whole, "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(turns)}
    if not whole:
        return row | {"codes": codes, "firsts": firsts, "roles": part.roles, "texts": part.texts}
    return row | _counts(codes) | _solved(search, codes, search.end, START, True, part.roles, part.texts)


def _solved(search: Search, codes: bytes, after: Vector, state: int, last: bool, roles, texts) -> dict:
    path, cost = search.trace(codes, after, state, last)
    return {"cost": cost, "audit": "".join(m.letters for m in path), "lines": _lines(path, roles, texts)}


def _conversations(batches: Iterator[dict], chunk_rows: int) -> Iterator[tuple[Rows, bool]]:
    """Chunks of a sorted partition, and whether a chunk is known to be its whole conversation:
    the first and the last one of a partition may go on in the next."""
    part, several, first = None, False, True
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("conv", "turn", "role", "text")]
        for conv, turn, role, text in zip(*columns, strict=True):
            if part is None:
                part = Rows(conv)
            elif conv != part.conv:
                yield part, not (several or first)
                part, several, first = Rows(conv), False, False
            elif len(part.turns) >= chunk_rows or part.chars + len(text) > CHUNK_CHARS:
                yield part, False
                part, several = Rows(conv), True
            part.add(turn, role, text)
    if part is not None:
        yield part, False


def _chunks(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Chunks of conversations in order; whole ones are solved already."""
    # Copies of a row are told apart by a number, so that they can be cut as well.
    order = [
        F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role",
        F.substring("text", 1, 64), F.xxhash64("text"), F.monotonically_increasing_id(),
    ]
    names = ["_conv", "_turn", "_role", "_head", "_hash", "_copy"]
    keyed = rows.select("*", *[(F.col(o) if isinstance(o, str) else o).alias(n) for n, o in zip(names[2:], order[2:], strict=True)])
    by = [*order[:2], *names[2:]]
    ordered = keyed.repartitionByRange(*by).sortWithinPartitions(*by).drop(*names)
    schema = StructType([StructField("conv", rows.schema["conv"].dataType), *StructType.fromDDL(_CHUNK)])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        from pyspark import TaskContext

        search, task, nth = Search(), TaskContext.get().partitionId(), 0
        held: list[dict] = []
        for part, whole in _conversations(batches, chunk_rows):
            held.append(_chunk(part, whole, search) | {"task": task, "nth": nth})
            nth += 1
            if not whole or len(held) >= 256:
                yield _columns(held, schema)
                held = []
        if held:
            yield _columns(held, schema)

    return in_arrow(ordered, schema, work)


def _columns(rows: list[dict], schema: StructType) -> dict:
    return {f.name: [r.get(f.name) for r in rows] for f in schema}


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.conv").eqNullSafe(F.col(f"{b}.conv"))


def _neighbour(chunks: DataFrame, distance: int, columns: list[str], suffix: str) -> DataFrame:
    """``chunks`` with columns of the chunk ``distance`` further on in its conversation."""
    other = chunks.select((F.col("place") - distance).alias("place"), "conv", *[F.col(c).alias(c + suffix) for c in columns])
    here = (F.col("a.place") == F.col("b.place")) & _same("a", "b")
    return chunks.alias("a").join(other.alias("b"), here, "left").select("a.*", *[f"b.{c}{suffix}" for c in columns])


def _placed(chunks: DataFrame) -> DataFrame:
    """The cut conversations' chunks with their place among all chunks; a conversation's
    follow one another. Sizes are a row a task of the sort."""
    from roadstream.llm.common import before_this

    sizes = chunks.groupBy("task").agg(F.count(F.lit(1)).alias("_n"))
    bases = sizes.select("task", before_this(F.col("_n"), [], ["task"]).alias("_base"))
    return chunks.where("not whole").join(F.broadcast(bases), "task").withColumn("place", F.col("_base") + F.col("nth")).drop("_base")


def _repeated(cut: DataFrame) -> DataFrame:
    """Per chunk the rows whose role and text an earlier chunk of the conversation has. A common
    text is first reduced to one row a chunk."""
    each = cut.select("place", "conv", F.explode("firsts").alias("f")).select("place", "conv", "f.at", "f.digest")
    earliest = each.groupBy("conv", "digest").agg(F.min(F.struct("place", "at")).alias("e")).select("e.place", "e.at")
    again = each.join(earliest, ["place", "at"], "left_anti")
    return again.groupBy("place").agg(F.collect_list("at").alias("repeated"))


def _coded(cut: DataFrame) -> DataFrame:
    """place, conv, codes, last: codes with the repetitions of earlier chunks."""
    rows = cut.select("place", "conv", "codes").join(_repeated(cut), "place", "left")
    schema = StructType([f for f in rows.schema if f.name != "repeated"])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            codes = []
            for before, repeated in zip(batch["codes"].to_pylist(), batch["repeated"].to_pylist(), strict=True):
                changed = bytearray(before)
                for at in repeated or []:
                    changed[at] = 4 * DUPLICATE + changed[at] % 4
                codes.append(bytes(changed))
            yield {"place": batch["place"], "conv": batch["conv"], "codes": codes}

    return in_arrow(rows, schema, work)


def _speculated(coded: DataFrame) -> DataFrame:
    """Each chunk's costs at both ends if the conversation ended with it."""
    schema = StructType([*coded.schema.fields]).add("after", _VECTOR).add("before", _VECTOR)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        search = Search()
        for batch in batches:
            before = [search.before(codes, search.end) for codes in batch["codes"].to_pylist()]
            yield batch | {"after": [list(search.end)] * len(before), "before": [list(b) for b in before]}

    return in_arrow(coded, schema, work)


def _fixed(vectors: DataFrame, reach: int) -> DataFrame:
    """One fix-up pass: chunks whose right neighbour has found other costs than they were run
    with run again, up to ``reach`` of them one after another; ``changed`` marks them."""
    schema = StructType([*vectors.schema.fields]).add("changed", "boolean")
    known = _neighbour(vectors, 1, ["before"], "_next").withColumn("_group", F.floor(F.col("place") / reach))

    def work(group: pd.DataFrame) -> pd.DataFrame:
        search, following = Search(), None
        rows = []
        for row in group.sort_values("place", ascending=False).to_dict("records"):
            after, before = tuple(map(int, row["after"])), tuple(map(int, row["before"]))
            found = following if following is not None else row["before_next"]
            new = after if found is None else tuple(map(int, found))
            if new != after:
                before = search.fixed(row["codes"], after, new, before)
            following = before
            rows.append([row["place"], row["conv"], row["codes"], list(new), list(before), new != after])
        return pd.DataFrame(rows, columns=schema.names)

    return known.groupBy("conv", "_group").applyInPandas(work, schema)


def _converged(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Run fix-up passes until no chunk changes; the number of passes that changed one."""
    passes, reach = 0, 1
    while True:
        fixed = written(_fixed(vectors, reach))
        changed = fixed.where("changed").limit(1).count()
        vectors = fixed.drop("changed")
        if not changed:
            return vectors, passes
        passes, reach = passes + 1, min(REACH, 4 * reach)


def _entered(vectors: DataFrame) -> DataFrame:
    """place, after, last, state: the state in which each chunk is entered. The maps from entry
    to exit are composed over 1, 2, 4, ... chunks."""
    schema = StructType([StructField("place", LongType()), vectors.schema["conv"]]).add("map", _VECTOR)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        search = Search()
        for batch in batches:
            rows = zip(batch["codes"].to_pylist(), batch["after"].to_pylist(), strict=True)
            yield {"place": batch["place"], "conv": batch["conv"], "map": [search.exits(c, tuple(a)) for c, a in rows]}

    maps = written(in_arrow(vectors, schema, work))
    extent = maps.groupBy("conv").agg((F.max("place") - F.min("place") + 1).alias("n")).agg(F.max("n").alias("n")).first()["n"]
    distance = 1
    while distance < (extent or 0):
        both = _neighbour(maps, -distance, ["map"], "_earlier")
        composed = F.transform("map_earlier", lambda q: F.element_at("map", q + 1))
        maps = written(both.select("place", "conv", F.coalesce(composed, "map").alias("map")))
        distance *= 2
    beside = _neighbour(_neighbour(maps, -1, ["map"], "_earlier"), 1, ["place"], "_next")
    entries = beside.select(
        "place",
        F.coalesce(F.get("map_earlier", F.lit(START)), F.lit(START)).alias("state"),
        F.col("place_next").isNull().alias("last"),
    )
    return vectors.select("place", "codes", "after").join(entries, "place")


def _traced(cut: DataFrame, entries: DataFrame) -> DataFrame:
    """Counts, edits and lines of every chunk of a cut conversation."""
    rows = cut.select("place", "conv", "low", "high", "turns", "roles", "texts").join(entries, "place")
    kept = ["place", "conv", "low", "high", "turns"]
    schema = StructType([*[rows.schema[c] for c in kept], *StructType.fromDDL(_FOUND), *StructType.fromDDL("head: int, tail: int")])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        search = Search()
        names = ["codes", "after", "state", "last", "roles", "texts"]
        for batch in batches:
            out = []
            for codes, after, *rest in zip(*[batch[c].to_pylist() for c in names], strict=True):
                found = _counts(codes) | {"head": codes[0] % 4, "tail": codes[-1] % 4}
                out.append(found | _solved(search, codes, tuple(after), *rest))
            yield {c: batch[c] for c in kept} | _columns(out, StructType(schema.fields[len(kept) :]))

    return in_arrow(rows, schema, work)


_SUMS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _joined(traced: DataFrame) -> DataFrame:
    """One row a cut conversation; an audit is as long as its conversation."""
    beside = _neighbour(traced.drop("lines"), -1, ["tail", "high"], "_earlier")
    legal = F.lit(False)
    for a, b in sorted(LEGAL):
        legal = legal | ((F.col("tail_earlier") == a) & (F.col("head") == b))
    border = F.when(F.col("tail_earlier").isNotNull() & ~legal, 1).otherwise(0)
    shared = F.when(F.col("high_earlier") == F.col("low"), 1).otherwise(0)
    rows = beside.withColumn("illegal", F.col("illegal") + border).withColumn("turns", F.col("turns") - shared)
    parts = F.sort_array(F.collect_list(F.struct("place", "audit")))
    return rows.groupBy("conv").agg(
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("turns").alias("turns"),
        *[F.sum(c).alias(c) for c in _SUMS],
        F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"),
    )


def repaired(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    chunk_rows: int = CHUNK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Two frames. Per conversation that has rows: ``conv``, ``gaps``, ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost`` and ``audit``, the letters of its cheapest edits in
    order (Keep, Rerole, Delete, Insert). And its repaired lines: ``conv``, ``place``,
    ``lines``, an array of ``role:text``; a conversation's arrays follow one another by ``place``.

    Rows are taken by turn, nulls first, those of one turn by role and text. A null role or
    text is one blank; a null conversation is one of its own. Rows with the same role and text
    as an earlier one of the conversation are duplicates, copies of a row too. A role that
    is empty or begins otherwise than those of system, user and assistant cannot be kept. Costs
    that are equal are settled by the least letters. Empty texts are blank; long texts count
    towards a chunk's size. An empty table gives two empty frames; other columns are not read.
    """
    blank = F.lit(" ")
    placed = rows.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col), blank).alias("role"),
        F.coalesce(F.col(text_col), blank).alias("text"),
    )
    chunks = written(_chunks(placed, chunk_rows))
    cut = _placed(chunks)
    vectors, _ = _converged(written(_speculated(_coded(cut))))
    traced = written(_traced(cut, _entered(vectors)))
    names = ["conv", "low", "high", "turns", *_SUMS, "audit"]
    found = chunks.where("whole").select(*names).unionByName(_joined(traced).select(*names))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    summary = found.select("conv", gaps.cast("bigint").alias("gaps"), *_SUMS, "audit")
    whole = chunks.where("whole").select("conv", F.lit(None).cast("bigint").alias("place"), "lines")
    return summary, whole.unionByName(traced.select("conv", "place", "lines"))


def line_digests(lines: DataFrame) -> DataFrame:
    """Per conversation ``conv`` and ``sha256`` of its repaired lines joined by line feeds.

    A hash is taken in order, so a cut conversation's chunks go through one task, as a
    sorted stream of which a chunk is held at a time."""
    whole = lines.where("place is null").select("conv", F.sha2(F.array_join("lines", "\n"), 256).alias("sha256"))
    cut = lines.where("place is not null")
    by = ["conv", "place"]

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        last: object = batches
        for batch in batches:
            for conv, parts in zip(batch["conv"].to_pylist(), batch["lines"].to_pylist(), strict=True):
                if last is batches or conv != last:
                    if last is not batches:
                        yield {"conv": [last], "sha256": [digest.hexdigest()]}
                    last, digest, begun = conv, hashlib.sha256(), False
                for line in parts:
                    digest.update(("\n" + line if begun else line).encode())
                    begun = True
        if last is not batches:
            yield {"conv": [last], "sha256": [digest.hexdigest()]}

    streamed = in_arrow(cut.repartition("conv").sortWithinPartitions(*by), whole.schema, work)
    return whole.unionByName(streamed)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows after the damage of the contract: by the CRC of ``conv_id:turn``, in
    twentieths, a row is dropped, emptied, stripped of its stops, repeated, or made a user's."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(F.col(c), blank) for c in ("role", "text"))
    hit = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_hit"))
    changed = (
        hit.where("_hit <> 0")
        .withColumn("text", F.when(F.col("_hit") == 1, "").when(F.col("_hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("_hit") == 4, "user").otherwise(F.col("role")))
    )
    copies = F.when(F.col("_hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return changed.withColumn("_copy", F.explode(copies)).select("conv_id", "turn", "role", "text")


def digests(rows: DataFrame) -> DataFrame:
    """The contract's row of every conversation in ``rows``, repaired after its damage."""
    summary, lines = repaired(damaged(rows))
    found = summary.join(line_digests(lines).withColumnRenamed("conv", "_conv"), F.col("conv").eqNullSafe(F.col("_conv")))
    every = rows.select("conv_id").distinct()
    both = every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("gaps", *_SUMS)]
    return both.select(
        "conv_id",
        *zero,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
