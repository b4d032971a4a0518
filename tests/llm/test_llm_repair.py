"""Conversation repair against plain Python over whole conversations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from claimsdq.llm import repair as RP

COLUMNS = "conv_id long, turn long, role string, text string, key string, k string, audit string, fault string"


def least(rows):
    """(cost, audit, turns) by dynamic programming over (row, state), audits compared as strings."""
    n = len(rows)

    @lru_cache(maxsize=None)
    def go(i, state, inserts):
        best = None
        if i == n and state in ("", "a"):
            best = (0, "", ())

        def offer(cost, symbol, rest, turn=()):
            nonlocal best
            if rest is not None:
                way = (cost + rest[0], symbol + rest[1], turn + rest[2])
                best = way if best is None or way < best else best
        new = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        name = {"u": "user", "a": "assistant"}[new]
        if inserts < 3:
            offer(2, "I", go(i, new, inserts + 1), ((name, ""),))
        if i < n:
            role, text, forced, cut = rows[i]
            offer(3, "D", go(i + 1, state, 0))
            if not forced:
                offer(2 + cut, "R", go(i + 1, new, 0), ((name, text),))
                if (state, role[:1]) in (("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")):
                    offer(cut, "K", go(i + 1, role[:1], 0), ((role, text),))
        return best
    for i in range(n, 0, -1):                  # from the end, so that no call goes deep
        for state in ("", "s", "u", "a"):
            go(i, state, 0)
    return go(0, "", 0)


def plain(rows):
    """The contract, row by row."""
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        convs[c]
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        convs[c] += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = {}
    for c, got in convs.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged, figures = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, role, text in got:
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else \
                "truncated" if words[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                figures[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, *_ in got if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(got, got[1:]))
        cost, audit, done = least(tuple(judged))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()
        out[c] = (gaps, figures["blank"], figures["duplicate"], figures["truncated"], illegal, cost, audit, sha)
    return out


def make(seed, n=40, longest=9):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(1, longest)):
            role = r.choice(["user", "assistant"]) if r.random() < 0.4 else ["user", "assistant"][t % 2]
            role = r.choice(["system", "tool", None, "", "unknown"]) if r.random() < 0.15 else role
            text = r.choice(["Yes.", "So it is!", "cut off", "", None, "\t ", "Ünd?  ", "...", "\x1c", str(r.random()) + "."])
            rows.append((c, t * r.choice([1, 1, 2]) if r.random() < 0.95 else None, role, text))
    rows += [(None, 3, "user", "No id."), (None, None, "assistant", "None."), (n + 1, 0, "system", "Alone.")]
    rows += r.sample(rows, 8)                                          # repeated rows, ties
    r.shuffle(rows)
    return [(*row, *["clash"] * 4) for row in rows]


def solve(turns, **kw):
    damaged, copies = RP.damage(turns)
    pieces = RP.repair(damaged, copies, **kw)
    return pieces, {r.conv_id: tuple(r)[1:] for r in RP.figures(pieces).collect()}


def test_every_shape_is_known_and_reached_from_the_end():
    todo, seen = [RP.END, RP.SPECULATIVE], set()
    while todo:
        shape = todo.pop()
        if shape not in seen:
            seen.add(shape)
            todo += [RP.step(shape, code)[0] for code in "xsuaoSUAO"]
    assert seen <= set(RP.ALL_SHAPES)


def test_shapes_from_any_start_stay_among_the_known():
    for shape in RP.ALL_SHAPES:
        for code in "xsuaoSUAO":
            RP.step(shape, code)


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, dict(chunk_rows=2)), (3, dict(chunk_rows=1, passes=1, fan=2)),
                                     (4, dict(chunk_rows=3, chunk_chars=10, passes=2, fan=3))])
def test_matches_plain_search(spark, seed, kw):
    rows = make(seed)
    _, got = solve(spark.createDataFrame(rows, COLUMNS).repartition(5), **kw)
    assert got == plain(rows)


def test_one_long_conversation_over_many_chunks(spark):
    r = random.Random(7)
    # regular turns with faults, then a stretch whose shapes never converge
    rows = [(1, t, ["user", "assistant"][t % 2] if r.random() < 0.9 else "user", f"{t}.") for t in range(150)]
    rows += [(1, 150 + t, "tool", f"x{t}.") for t in range(120)] + [(2, 0, "user", "Short?")]
    for kw in (dict(chunk_rows=7, passes=3, fan=4), dict(chunk_rows=16, passes=40)):
        pieces, got = solve(spark.createDataFrame([(*x, *["clash"] * 4) for x in rows], COLUMNS), **kw)
        assert got == plain(rows)
    text = "\n".join(f"{t.role}:{t.text}" for t in RP.repaired_turns(pieces.filter("conv_id = 1")).orderBy("k", "place").collect())
    assert hashlib.sha256(text.encode()).hexdigest() == got[1][-1]


def test_regular_turns_converge_in_one_fix_up(spark):
    rows = [("v1", k, 40, "uauAuaUa" * 4) for k in range(40)]
    links = spark.createDataFrame(rows, "key string, k long, total long, codes string")
    out, n = RP.stitched(links, 6, 1024)
    assert n == 2                                  # one pass that mends, one that finds nothing to do
    got = {r.k: (r.shapes, r.entry) for r in out.collect()}
    whole = RP.backward("uauAuaUa" * 160, RP.END)
    assert "".join(got[k][0] for k in range(40)) == whole


def test_empty_dropped_and_string_keys(spark):
    assert solve(spark.createDataFrame([], COLUMNS))[1] == {}
    dropped = next(c for c in range(500) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    _, got = solve(spark.createDataFrame([(dropped, 0, "user", "Gone.", *["clash"] * 4)], COLUMNS))
    assert got == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    rows = [("a", 0, "user", "Hi."), ("a", 1, "assistant", "Ho."), (None, 0, "user", "x"), ("", 0, "assistant", "y.")]
    _, got = solve(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    assert got == plain(rows)
