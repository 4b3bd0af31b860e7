import hashlib
import random
import re
import zlib

import pytest

from roadstream.llm import repair as R

SMALL = "/root/testdata/sf0.001"
WHITE = " \t\n\v\f\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(key.encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


#: role initials -> whether they are a legal prefix; states by the pattern itself
def state_of(initials):
    if re.fullmatch("(s?(ua)+)?", initials):
        return "A" if initials else ""
    if initials == "s":
        return "s"
    return "U" if re.fullmatch("s?(ua)*u", initials) else None


def cheapest(rows):
    """(cost, audit, lines) by trying all edits, keeping the best per state after each row."""
    best = {"": (0, "", ())}

    def put(out, state, initial, cost, audit, lines):
        then = state_of({"": "", "s": "s", "U": "u", "A": "ua"}[state] + initial)
        if then is not None:
            out[then] = min(out.get(then, (10**9,)), (cost, audit, lines))

    def inserted(best):
        for _ in range(4):
            more = dict(best)
            for state, (cost, audit, lines) in best.items():
                for role in ("user", "assistant"):
                    put(more, state, role[0], cost + 3, audit + "I", (*lines, f"{role}:"))
            best = more
        return best

    for role, text, fault in rows:
        out = {}
        for state, (cost, audit, lines) in inserted(best).items():
            gone = (cost + 4, audit + "D", lines)
            out[state] = min(out.get(state, (10**9,)), gone)
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            if role[:1] in ("s", "u", "a"):
                put(out, state, role[0], cost + more, audit + "K", (*lines, f"{role}:{text}"))
            for new in ("user", "assistant"):
                put(out, state, new[0], cost + more + 3, audit + "R", (*lines, f"{new}:{text}"))
        best = out
    ends = inserted(best)
    return min(ends[s] for s in ("", "A") if s in ends)


def brute(rows):
    out = {conv: (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv, *_ in rows}
    left = damage(rows)
    for conv in out:
        mine = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        if not mine:
            continue
        seen, marked = set(), []
        for _, _, role, text in mine:
            end = text.rstrip(WHITE)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else None if end[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        cost, audit, lines = cheapest(marked)
        turns = [t for _, t, _, _ in mine if t is not None]
        faults = [sum(f == k for _, _, f in marked) for k in ("blank", "duplicate", "truncated")]
        initials = [r[:1] for r, _, _ in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return sorted(out.values(), key=repr)


def random_rows(rng, convs, longest):
    rows = []
    for conv in [*range(convs), None]:
        for turn in range(rng.randrange(longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User"])
            text = rng.choice(["Hello.", "Well!", "no stop", " ", "", None, " ", "?", f"Unlike {turn}.", "a\tb.\n"])
            rows.append((conv, None if rng.random() < 0.05 else turn + (turn > 4), role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_search_equals_trying_all_edits():
    rng, search = random.Random(2), R.Search()
    for _ in range(1500):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), "x", rng.choice([None, None, "truncated", "blank"])) for _ in range(rng.randrange(9))]
        kinds = {None: R.PLAIN, "truncated": R.TRUNCATED, "blank": R.BLANK}
        codes = bytes(4 * kinds[f] + ("sua".find(r[0]) if r[0] in "sua" else 3) for r, _, f in rows)
        path, cost = search.trace(codes, search.end, R.START, True)
        assert (cost, "".join(m.letters for m in path)) == cheapest(rows)[:2]
        lines = R._lines(path, [r for r, _, _ in rows], [t for _, t, _ in rows])
        assert tuple(lines) == cheapest(rows)[2]


def test_fix_up_stops_where_vectors_differ_by_a_constant():
    rng, search, early = random.Random(3), R.Search(), 0
    for _ in range(500):
        codes = bytes(rng.choice([0, 1, 2, 3, 5, 6, 9, 13]) for _ in range(rng.randrange(1, 40)))
        other = search.before(bytes([rng.randrange(16) for _ in range(3)]), search.end)
        left = search.before(codes, search.end)
        assert search.fixed(codes, search.end, other, left) == search.before(codes, other)
        early += search.before(codes, other) == left
    assert early > 250


@pytest.mark.parametrize("chunk_rows", [1, R.CHUNK_ROWS])
def test_any_cut_equals_brute_force(spark, chunk_rows, monkeypatch):
    """Also with chunks of a row, so that all conversations are cut and stitched."""
    rng = random.Random(chunk_rows)
    rows = random_rows(rng, 12, 14)
    rows += [(99, t, rng.choice(["user", "assistant", "user", "system"]), rng.choice(["Yes.", f"A{t}.", "open", ""])) for t in range(150)]
    rows += [(100, t, "user", "same.") for t in range(90)] + [(101, None, "user", "tie.")] * 40
    rows += [(102, t, "system", "") for t in range(60)]
    whole = R.repaired
    monkeypatch.setattr(R, "repaired", lambda r: whole(r, chunk_rows=chunk_rows))
    assert sorted(map(tuple, R.digests(frame(spark, rows)).collect()), key=repr) == brute(rows)


def test_passes_reach_further_each_time(spark):
    """Deleted rows hand costs on unchanged, so that a fix-up crosses all of their chunks."""
    rows = [(1, 0, "user", "Open"), *[(1, t, "user", "") for t in range(1, 120)], (1, 120, "assistant", "Yes."), (1, 121, "user", "No.")]
    chunks = R.written(R._chunks(frame(spark, rows).withColumnRenamed("conv_id", "conv"), 2))
    vectors, passes = R._converged(R.written(R._speculated(R._coded(R._placed(chunks)))))
    assert vectors.count() == 61 and 1 <= passes <= 8


def test_extra_columns_and_no_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")]
    odd = frame(spark, rows).selectExpr("*", "1 conv", "2 place", "3 lines", "4 codes", "5 _copy")
    assert sorted(map(tuple, R.digests(odd).collect()), key=repr) == brute(rows)
    none = frame(spark, [])
    assert R.digests(none).collect() == []
    # Nothing is left of a conversation whose only row is dropped.
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    assert list(map(tuple, R.digests(frame(spark, [(7, turn, "user", "Hi.")])).collect())) == brute([(7, turn, "user", "Hi.")])


def test_given_table(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, R.digests(table).collect()), key=repr) == brute(rows)


def test_long_texts(spark):
    long = "word " * 2_000_000
    rows = [(1, 0, "user", long), (1, 1, "user", long + "."), (1, 2, "assistant", long + "!")]
    assert sorted(map(tuple, R.digests(frame(spark, rows)).collect()), key=repr) == brute(rows)
