"""Conversation structure repair by a rank-convergence parallel Viterbi.

A conversation is a path of rows; its role initials should read ``(s?(ua)+)?``.
Each row is kept (K, free), given the role user or assistant (R, 2) or deleted
(D, 3; the only way for blank and duplicate rows); empty turns may be inserted
anywhere (I, 2), and a truncated row that stays costs 1 more.  The cheapest
edits are a shortest path over four states (nothing yet, after s, u, a), and of
the cheapest ones the ASCII-least audit string is wanted.  From each state one
role at most can come next by R or I, so an audit string stands for one path.

1. *Rows.*  Equal rows of a conversation (turn, role, text) are pre-aggregated;
   a (role, text) seen at an earlier turn is looked up by digest, hot ones by a
   broadcast bounded by arithmetic (``lookup_hot_safe``).
2. *Chunks.*  Rows are range-partitioned and sorted by conversation, turn, role
   and text, so that one conversation may lie over many tasks, and are cut into
   chunks of ``chunk_rows`` rows.  A conversation that lies in one chunk is
   solved on the spot.
3. *Speculation.*  Costs to go are computed from the end.  A chunk cannot know
   the vector at its right end, so it starts from a speculative one (zeros; the
   last chunk from the true one) and keeps the vector before each of its rows
   up to a constant (its *shape*).
4. *Fix-up passes.*  Each chunk whose right neighbour's left shape is not what
   it started from runs again from that shape, and stops at the first row where
   its shape equals the kept one: from there on the vectors differ by a constant
   only.  Passes go on until no chunk has to run.
5. *When shapes do not converge* (periodic rows, such as one role for ever):
   after ``passes`` passes the chunks are run from every shape there is (they
   are few), and these maps are composed along the conversation by a tree.
6. *Tracing.*  With the stitched backward costs a chunk maps each entry state to
   one exit state; the maps are composed by the same tree, and every chunk then
   traces its own part of the least audit.

``repair`` returns pieces, one a chunk; no task holds a whole conversation.  Only
``figures`` meets one in a task, as a SHA-256 of one text must: its pieces stream
through in order.

Edge cases: a null role or text is one space; a null ``conv_id`` is a
conversation of its own; rows with equal turn are taken in (role, text) order; a
role is judged by its first character (an empty one fits nowhere); rows with a
null turn come first and do not count for gaps; a conversation without rows
after damage gives zeros and empty texts; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsdq.llm.common import lookup_hot_safe, map_batches, staged

# ------------------------------------------------------------- one row's step

# Costs of the edits; CUT is what a truncated row costs when it stays.
RENAME, DELETE, INSERT, CUT = 2, 3, 2, 1
#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a.  The state that the one
#: role which R or I can give leads to, and those that keeping an initial leads to.
NEXT = (2, 2, 3, 2)
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLE = {2: "user", 3: "assistant"}
LEGAL_PAIRS = frozenset(("su", "ua", "au"))
#: What must still be inserted when the rows end in a state.
CLOSING = ("", "II", "I", "")
_FAR = 1 << 30
_BLANKS = " \t\n\x0b\x0c\r"


def _closed(g: list[int]) -> tuple[int, ...]:
    """Costs to go before the inserts of a place, given those after them."""
    u, a = min(g[2], INSERT + g[3]), min(g[3], INSERT + g[2])
    return min(g[0], INSERT + u), min(g[1], INSERT + u), u, a


def _shape(v: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(x - v[3] for x in v)


#: Every shape there can be, relative to "after a": nothing yet is at best 3
#: cheaper and never dearer, s is dearer by 4 at most, u by 2 either way.
SHAPES = [(d0, d1, d2, 0) for d0, d1, d2 in product(range(-3, 1), range(0, 5), range(-2, 3))]
_ID = {s: chr(33 + n) for n, s in enumerate(SHAPES)}
_OF = {c: s for s, c in _ID.items()}
ALL_SHAPES, ALL_STATES = "".join(_OF), "0123"
END = _ID[_shape(_closed([0, _FAR, _FAR, 0]))]
SPECULATIVE = _ID[0, 0, 0, 0]


@lru_cache(maxsize=None)
def step(after: str, code: str) -> tuple[str, tuple[tuple[str, int], ...]]:
    """The shape before a row, given the shape after it, and per state the least
    edits of that place: audit symbols up to and with the row's, next state.

    A row's code: x must be deleted; s, u, a, o keep that initial (o: none that
    fits); upper case: truncated."""
    b = _OF[after]
    kind, cut = code.lower(), CUT if code.isupper() else 0
    moves = []
    for state in range(4):
        ways = {"D": (DELETE + b[state], state)}
        if kind != "x":
            ways["R"] = (RENAME + cut + b[NEXT[state]], NEXT[state])
            if (state, kind) in KEEP:
                ways["K"] = (cut + b[KEEP[state, kind]], KEEP[state, kind])
        moves.append(ways)
    before = _closed([min(cost for cost, _ in ways.values()) for ways in moves])
    edits = []
    for state in range(4):
        symbols, at = "", state
        while not symbols or symbols[-1] == "I":
            ways = moves[at] | {"I": (INSERT + before[NEXT[at]], NEXT[at])}
            least = min(s for s, (cost, _) in ways.items() if cost == before[at])
            symbols, at = symbols + least, ways[least][1]
        edits.append((symbols, at))
    return _ID[_shape(before)], tuple(edits)


def backward(codes: str, right: str, known: str = "") -> str:
    """The shape before each row, given the shape after the last one.  With
    ``known`` (the shapes of an earlier run) it ends where both agree."""
    out, shape = [], right
    for n in range(len(codes) - 1, -1, -1):
        shape = step(shape, codes[n])[0]
        if known and known[n] == shape:
            return known[:n + 1] + "".join(reversed(out))
        out.append(shape)
    return "".join(reversed(out))


def trace(codes: str, shapes: str, right: str, state: int) -> tuple[list[str], int]:
    """The least edits of each row, entered in ``state``, and the last state."""
    out = []
    for code, after in zip(codes, shapes[1:] + right):
        symbols, state = step(after, code)[1][state]
        out.append(symbols)
    return out, state


def carry_out(codes: str, edits: list[str], state: int, roles: list[str], texts: list[str], last: bool):
    """(audit, repaired turns, cost) of a chunk entered in ``state``; ``roles``
    and ``texts`` are those of its rows that may stay."""
    turns, cost, n = [], 0, 0

    def insert():
        nonlocal state, cost
        state, cost = NEXT[state], cost + INSERT
        turns.append({"role": ROLE[state], "text": ""})

    for code, symbols in zip(codes, edits):
        for s in symbols:
            if s == "I":
                insert()
            elif s == "D":
                cost += DELETE
            else:
                cost += (RENAME if s == "R" else 0) + (CUT if code.isupper() else 0)
                state = NEXT[state] if s == "R" else KEEP[state, code.lower()]
                turns.append({"role": ROLE[state] if s == "R" else roles[n], "text": texts[n]})
        n += code != "x"
    closing = CLOSING[state] if last else ""
    for _ in closing:
        insert()
    return "".join(edits) + closing, turns, cost


# ---------------------------------------------------------------------- chunks

FIGURES = ("first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal")
_CHUNK = ("key string, part int, seq long, whole boolean, codes string, roles array<string>, texts array<string>, "
          "first_initial string, last_initial string, " + ", ".join(f"{f} long" for f in FIGURES))
_PIECE = "audit string, cost long, repaired array<struct<role:string,text:string>>"
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_ARROW = pa.schema([("key", pa.string()), ("part", pa.int32()), ("seq", pa.int64()), ("whole", pa.bool_()),
                    ("codes", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
                    ("first_initial", pa.string()), ("last_initial", pa.string()),
                    *[(f, pa.int64()) for f in FIGURES],
                    ("audit", pa.string()), ("cost", pa.int64()), ("repaired", _TURNS)])
_EDGES = ["key", "k", "total", "first_initial", "last_initial", *FIGURES]


class _Chunk:
    """Rows of one conversation in order, with the figures to be added up."""

    def __init__(self, key: str, seq: int):
        self.key, self.seq, self.size = key, seq, 0
        self.codes, self.roles, self.texts = [], [], []
        self.first_initial = self.last_initial = None
        self.first_turn = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, first: bool) -> None:
        initial, said = role[:1], text.strip(_BLANKS)
        if self.codes and self.last_initial + initial not in LEGAL_PAIRS:
            self.illegal += 1
        if not self.codes:
            self.first_initial = initial
        self.last_initial = initial
        if turn is not None:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        if not said or not first:
            self.blank += not said
            self.duplicate += bool(said)
            self.codes.append("x")
            return
        cut = said[-1] not in ".!?"
        self.truncated += cut
        code = initial if initial in ("s", "u", "a") else "o"
        self.codes.append(code.upper() if cut else code)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)

    def row(self, part: int, whole: bool) -> dict:
        codes = "".join(self.codes)
        out = {"key": self.key, "part": part, "seq": self.seq, "whole": whole, "first_initial": self.first_initial,
               "last_initial": self.last_initial, **{f: getattr(self, f) for f in FIGURES}}
        if not whole:
            return out | {"codes": codes, "roles": self.roles, "texts": self.texts}
        edits, _ = trace(codes, backward(codes, END), END, 0)
        audit, turns, cost = carry_out(codes, edits, 0, self.roles, self.texts, True)
        return out | {"audit": audit, "cost": cost, "repaired": turns}


def _in_batches(rows: Iterator[dict], schema: pa.Schema, weigh) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for r in rows:
        out.append(r)
        size += weigh(r)
        if len(out) >= 1000 or size > 4 << 20:
            yield pa.RecordBatch.from_pylist(out, schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _weight(r: dict) -> int:
    return 100 + sum(map(len, r.get("texts") or ())) + sum(len(t["text"]) for t in r.get("repaired") or ())


def _chunks(rows: DataFrame, chunk_rows: int, chunk_chars: int) -> DataFrame:
    """Sorted rows (key, turn, role, text, n, first) to chunks; a conversation
    that neither begins nor ends its task and lies in one chunk is ``whole``."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        chunk, opening = None, True           # opening: the task's first conversation
        for b in batches:
            for key, turn, role, text, n, first in zip(*[c.to_pylist() for c in b.columns]):
                if chunk is None:
                    chunk = _Chunk(key, 0)
                elif chunk.key != key:
                    yield chunk.row(part, chunk.seq == 0 and not opening)
                    chunk, opening = _Chunk(key, 0), False
                for copy in range(n):
                    if len(chunk.codes) >= chunk_rows or chunk.size > chunk_chars:
                        yield chunk.row(part, False)
                        chunk = _Chunk(key, chunk.seq + 1)
                    chunk.add(turn, role, text, first and copy == 0)
        if chunk is not None:
            yield chunk.row(part, False)      # the next task may go on with it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(chunks(batches), _ARROW, _weight)
    return map_batches(rows.select("key", "turn", "role", "text", "n", "first"), run, f"{_CHUNK}, {_PIECE}")


def _numbered(chunks: DataFrame) -> DataFrame:
    """Add ``k`` (the chunk's place in its conversation) and ``total``.  The
    windows see one row per conversation and task."""
    per_part = chunks.groupBy("key", "part").agg(F.count("*").alias("c"))
    every = Window.partitionBy("key")
    starts = per_part.select("key", "part", F.coalesce(F.sum("c").over(
        every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("start"),
        F.sum("c").over(every).alias("total"))
    return chunks.join(starts, ["key", "part"]).withColumn("k", F.col("start") + F.col("seq")).drop("start")


# -------------------------------------------------------------------- stitching

def along(maps: DataFrame, domain: str, first: str, fan: int = 1024) -> DataFrame:
    """``key, k, f`` (``f[i]``: where ``domain[i]`` goes in step k) to ``key, k,
    entry``: what step k starts from when step 0 starts from ``first``.

    A tree: ``fan`` neighbouring maps are composed into one (composition is
    ``translate``), their starts found among themselves, then inside."""
    def after(at: Column, f: Column) -> Column:
        return F.call_function("translate", at, F.lit(domain), f)

    top = maps.agg(F.max("k")).first()[0] or 0
    items = maps.groupBy("key", F.expr(f"k div {fan}").alias("g")) \
        .agg(F.sort_array(F.collect_list(F.struct("k", "f"))).alias("items"))
    if top < fan:
        items = items.withColumn("entry", F.lit(first))
    else:
        items = staged(items, "repair-groups")
        whole = items.select("key", F.col("g").alias("k"),
                             F.aggregate("items", F.lit(domain), lambda at, x: after(at, x["f"])).alias("f"))
        items = items.join(along(whole, domain, first, fan).withColumnRenamed("k", "g"), ["key", "g"])
    none = F.array().cast("array<struct<k:bigint,entry:string>>")
    walk = F.aggregate("items", F.struct(F.col("entry").alias("at"), none.alias("out")), lambda acc, x: F.struct(
        after(acc["at"], x["f"]).alias("at"),
        F.concat(acc["out"], F.array(F.struct(x["k"].alias("k"), acc["at"].alias("entry")))).alias("out")))
    return items.select("key", F.inline(walk["out"]))


def _run_pass(links: DataFrame) -> DataFrame:
    """One pass: chunks whose ``need`` is not what they ran from run (again)."""
    schema = pa.schema([("key", pa.string()), ("k", pa.int64()), ("total", pa.int64()), ("codes", pa.string()),
                        ("right", pa.string()), ("shapes", pa.string()), ("ran", pa.bool_())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for r in b.to_pylist():
                need, r["ran"] = r.pop("need"), False
                if need is not None and need != r["right"]:
                    r["shapes"] = backward(r["codes"], need, r["shapes"] or "")
                    r["right"], r["ran"] = need, True
                yield r

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(rows(batches), schema, lambda r: 2 * len(r["codes"]))
    return map_batches(links.select("key", "k", "total", "codes", "right", "shapes", "need"), run,
                       "key string, k long, total long, codes string, right string, shapes string, ran boolean")


def _maps(links: DataFrame, kind: str) -> DataFrame:
    """Each chunk as a map: of shapes (right end to left end, numbered from the
    end of the conversation) or of states (entry to exit)."""
    schema = pa.schema([("key", pa.string()), ("k", pa.int64()), ("f", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for r in b.to_pylist():
                if kind == "shapes":
                    now = list(ALL_SHAPES)
                    for code in reversed(r["codes"]):
                        goes = {s: step(s, code)[0] for s in set(now)}
                        now = [goes[s] for s in now]
                    yield {"key": r["key"], "k": r["total"] - 1 - r["k"], "f": "".join(now)}
                else:
                    ends = [trace(r["codes"], r["shapes"], r["right"], s)[1] for s in range(4)]
                    yield {"key": r["key"], "k": r["k"], "f": "".join(map(str, ends))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(rows(batches), schema, lambda r: 200)
    return map_batches(links.select("key", "k", "total", "codes", "right", "shapes"), run, "key string, k long, f string")


def stitched(chunks: DataFrame, passes: int, fan: int) -> tuple[DataFrame, int]:
    """``key, k, total, codes`` to the same with the true ``right`` shape, all
    ``shapes`` and the ``entry`` state; and the number of passes."""
    last = F.col("k") == F.col("total") - 1
    none = F.lit(None).cast("string")
    guess = F.when(last, F.lit(END)).otherwise(F.lit(SPECULATIVE))
    links = staged(_run_pass(chunks.withColumns({"right": none, "shapes": none, "need": guess}).fillna("", ["right"])),
                   "repair-pass")
    left = F.when(F.length("shapes") > 0, F.substring("shapes", 1, 1)).otherwise(F.col("right"))
    for n in range(1, passes + 1):
        need = links.select("key", (F.col("k") - 1).alias("k"), left.alias("need"))
        links = staged(_run_pass(links.join(need, ["key", "k"], "left")), "repair-pass")
        if links.filter("ran").isEmpty():
            break
    else:
        true = along(_maps(links, "shapes"), ALL_SHAPES, END, fan).withColumnRenamed("entry", "need") \
            .withColumnRenamed("k", "from_end")
        links = links.withColumn("from_end", F.col("total") - 1 - F.col("k"))
        links = staged(_run_pass(links.join(true, ["key", "from_end"])), "repair-pass")
    return links.join(along(_maps(links, "states"), ALL_STATES, "0", fan), ["key", "k"]), n


def _solved(chunks: DataFrame) -> DataFrame:
    """Each chunk's part of the least audit and of the repaired conversation."""
    cols = ["key", "k", "total", *[f for f in _EDGES if f not in ("key", "k", "total")]]
    schema = pa.schema([("key", pa.string()), ("k", pa.int64()), ("total", pa.int64()), ("first_initial", pa.string()),
                        ("last_initial", pa.string()), *[(f, pa.int64()) for f in FIGURES],
                        ("audit", pa.string()), ("cost", pa.int64()), ("repaired", _TURNS)])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for r in b.to_pylist():
                state = int(r["entry"])
                edits, _ = trace(r["codes"], r["shapes"], r["right"], state)
                audit, turns, cost = carry_out(r["codes"], edits, state, r["roles"], r["texts"], r["k"] == r["total"] - 1)
                yield {c: r[c] for c in cols} | {"audit": audit, "cost": cost, "repaired": turns}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(rows(batches), schema, _weight)
    return map_batches(chunks.select(*cols, "codes", "roles", "texts", "shapes", "right", "entry"), run,
                       "key string, k long, total long, first_initial string, last_initial string, "
                       + ", ".join(f"{f} long" for f in FIGURES) + f", {_PIECE}")


# -------------------------------------------------------------------- the operator

def _first_seen(rows: DataFrame) -> DataFrame:
    """Add ``first``: no row of an earlier turn has this role and text."""
    rows = staged(rows.withColumn("digest", F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)),
                  "repair-rows")
    when = F.when(F.col("n") > 0, F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn")))
    seen = rows.groupBy("key", "digest").agg(F.min(when).alias("at"), F.count("*").alias("turns_with_it")) \
        .filter("turns_with_it > 1").select("key", "digest", F.col("at.turn").alias("first_turn"), "turns_with_it")
    found = lookup_hot_safe(rows, seen, ["key", "digest"], "turns_with_it", rows.count())
    first = F.col("turns_with_it").isNull() | F.col("turn").eqNullSafe(F.col("first_turn"))
    return found.select("key", "turn", "role", "text", "n", first.alias("first"))


def repair(turns: DataFrame, copies: Column | None = None, chunk_rows: int = 4096, chunk_chars: int = 1 << 20,
           passes: int = 6, fan: int = 1024) -> DataFrame:
    """``conv_id, turn, role, text`` to pieces of repaired conversations:
    ``conv_id, k, total`` (piece k of so many), ``audit``, ``cost``, ``repaired``
    (turns of role and text) and the piece's figures (``figures`` adds them up).

    ``copies``: how often a row counts; one of 0 copies only names its conversation."""
    n = F.lit(1) if copies is None else copies
    there = n > 0
    blank = F.lit(" ")
    rows = turns.select(
        F.when(F.col("conv_id").isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col("conv_id").cast("string"))).alias("key"),
        F.when(there, F.col("turn").cast("long")).alias("turn"),
        F.when(there, F.coalesce("role", blank)).otherwise(F.lit("")).alias("role"),
        F.when(there, F.coalesce("text", blank)).otherwise(F.lit("")).alias("text"), n.cast("long").alias("n")) \
        .groupBy("key", "turn", "role", "text").agg(F.sum("n").alias("n"))
    order = ["key", "turn", "role", "text"]
    ordered = _first_seen(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = staged(_chunks(ordered, chunk_rows, chunk_chars), "repair-chunks")
    one = F.lit(1).cast("long")
    pieces = chunks.filter("whole").withColumns({"k": one - 1, "total": one})
    several = chunks.filter("NOT whole").drop("audit", "cost", "repaired")
    numbered = staged(_numbered(several.select("key", "part", "seq", "codes")), "repair-links")
    links, _ = stitched(numbered.select("key", "k", "total", "codes"), passes, fan)
    placed = links.select("key", "k", "shapes", "right", "entry") \
        .join(numbered.select("key", "part", "seq", "k", "total"), ["key", "k"])
    rest = _solved(several.join(placed, ["key", "part", "seq"]))
    out = pieces.select(*rest.columns).unionByName(rest)
    kind = turns.schema["conv_id"].dataType
    conv = F.when(F.col("key") == "n", F.lit(None)).otherwise(F.expr("substring(key, 2)")).cast(kind)
    return out.select(conv.alias("conv_id"), *out.columns)


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """The repaired conversations, one row a turn: ``conv_id, k, place, role, text``."""
    return pieces.select("conv_id", "k", F.posexplode("repaired").alias("place", "t")) \
        .select("conv_id", "k", "place", "t.role", "t.text")


def figures(pieces: DataFrame) -> DataFrame:
    """Per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256`` (of the ``role:text`` lines)."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kind = pieces.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, out = None, None
        for b in batches:
            done = []
            for r in b.to_pylist():
                if conv is None or conv["key"] != r["key"]:
                    if conv is not None:
                        done.append(_finish(conv))
                    conv = r | {"sha": hashlib.sha256(), "audits": [], "n": 0}
                else:
                    _join(conv, r)
                conv["audits"].append(r["audit"])
                for t in r["repaired"]:
                    conv["sha"].update(f"{chr(10) if conv['n'] else ''}{t['role']}:{t['text']}".encode())
                    conv["n"] += 1
                conv["repaired"] = None
            out = b.schema.field("conv_id").type
            if done:
                yield _table(done, out)
        if conv is not None:
            yield _table([_finish(conv)], out)

    def _table(rows, kind):
        cols = list(zip(*rows))
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    schema = f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, " \
             "audit string, repaired_sha256 string"
    cols = ["conv_id", *_EDGES, "audit", "cost", "repaired"]
    alone = map_batches(pieces.filter("total = 1").select(*cols), run, schema)
    long = pieces.filter("total > 1").select(*cols).repartition("key").sortWithinPartitions("key", "k")
    return alone.unionByName(map_batches(long, run, schema))


def _join(conv: dict, r: dict) -> None:
    """Add the next piece's figures to a conversation's."""
    for f in ("blank", "duplicate", "truncated", "illegal", "cost"):
        conv[f] += r[f]
    if r["first_initial"] is not None:
        if conv["last_initial"] is not None and conv["last_initial"] + r["first_initial"] not in LEGAL_PAIRS:
            conv["illegal"] += 1
        conv["last_initial"] = r["last_initial"]
    if r["first_turn"] is not None:
        conv["turns"] += r["turns"] - (r["first_turn"] == conv["last_turn"])
        conv["first_turn"] = r["first_turn"] if conv["first_turn"] is None else conv["first_turn"]
        conv["last_turn"] = r["last_turn"]


def _finish(c: dict) -> tuple:
    gaps = 0 if c["first_turn"] is None else c["last_turn"] - c["first_turn"] + 1 - c["turns"]
    return (c["conv_id"], gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"], c["cost"],
            "".join(c["audits"]), c["sha"].hexdigest())


def damage(turns: DataFrame) -> tuple[DataFrame, Column]:
    """Planted faults by ``crc32("conv_id:turn") % 20``: 0 drops the row, 1 empties
    its text, 2 removes its ``.!?``, 3 doubles it, 4 makes its role user; the
    damaged turns and how often each counts."""
    blank = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    copies = F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1)
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        kind.alias("fault")), copies
