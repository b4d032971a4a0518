"""Suffix-array dedup: bytes under repeated strings of ``length`` bytes go.

A byte goes if some string of ``length`` bytes over it also starts earlier
(smaller ``doc_id``, or same document and earlier start).  Strings are judged
on the input.

The repeats are found in suffix arrays built column by column over collections
of strings: every round inserts one more symbol of each string, from its end to
its start, into the collection's Burrows-Wheeler transform and common-prefix
array, which are read from and written to files sequentially (``collection_bwt``).
A round costs a pass over the collection, so strings must be short and
collections small.  Spark sees to both without losing a match:

1. *Anchors.*  A window of ``length`` bytes is filed under its smallest
   ``GRAM``-byte hash.  Equal windows have equal anchors.  Neighbouring windows
   with one anchor form a segment of at most ``length - GRAM + 1`` windows, so
   no string is longer than twice ``length``.
2. *Pruning.*  An anchor at a single place in the whole corpus holds no
   repeat.  Only segments of the other anchors go on.
3. *Copies.*  Segments that are byte for byte one (anchor and 64-bit digest)
   are pre-aggregated: the earliest stands for all, every other one is wholly
   repeated.  A text that a third of all documents share is one string here.
4. *Collections.*  Where an anchor still has different segments, these meet in
   one task, a few MB of them, are cut down once more around their anchor
   (``narrowed``, again without loss), and the suffix array of that collection
   shows runs of suffixes with common prefixes of ``length`` or more.  In each run all
   but the earliest place are repeats.  Scratch files are the task's own and
   end with it.
5. *Crowded anchors.*  An anchor with more than ``crowd`` different segments
   (a short phrase that very many documents hold in different surroundings) is
   filed again, window by window under the window's own digest, so no task
   gets more than ``crowd`` strings of one anchor.

A document's place in the order, and its key in every join, is its ``doc_id``
and then its ``tie``, a hash of its text.  So rows that share a ``doc_id`` but not
their text are documents of their own, in the order of that hash; rows that share
both are one document, whose equal places are not earlier than each other.

Edge cases: null text counts as empty; texts shorter than ``length`` lose
nothing; a null ``doc_id`` counts as smaller than any (the least 64-bit number
stands for it); very long texts are hashed in blocks; an empty table gives an
empty result; other columns are not looked at.  ``doc_id`` must be an integer.
"""

from __future__ import annotations

import hashlib
import math
import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsdq.llm.common import map_batches, staged

GRAM = 32
_LOWEST = -(1 << 63)
_BLOCK = 1 << 18
#: Low bits of a hash that give way to the gram's place (mod 256).
_PLACE = np.uint64(255)


# ------------------------------------------------------------- rolling hashes

@lru_cache(maxsize=8)
def _hash_tables(n: int, seed: int):
    """Byte values, powers and inverse powers of an odd base modulo 2**64."""
    rng = np.random.default_rng(seed)
    values = rng.integers(1, 1 << 64, 256, dtype=np.uint64, endpoint=False)
    base = int(rng.integers(0, 1 << 61)) * 8 + 5
    inverse = pow(base, -1, 1 << 64)

    def powers(x):
        p = np.full(n + 1, x, np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)
    return values, powers(base), powers(inverse)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _prefix(data: np.ndarray, seed: int):
    values, up, down = _hash_tables(_BLOCK + 4096, seed)
    p = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[:len(data)], out=p[1:])
    return p, down


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    out, have = a, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[:len(out) - (width - have)], out[width - have:])
    return out


def segments(data: bytes, length: int, digests: bool = True, twices: bool = True):
    """Segments of one text: arrays (anchor, digest, start, windows, twice).

    ``twice``: the anchor's gram stands at two places in the segment, so two
    windows of the segment itself may be equal.  Digests and this flag are left
    out (0, False) where they are not asked for."""
    parts = []
    whole = np.frombuffer(data, np.uint8)
    span = length - GRAM + 1
    for at in range(0, max(0, len(whole) - length + 1), _BLOCK):
        b = whole[at:at + _BLOCK + length - 1]
        p, down = _prefix(b, 11)
        h = _mixed((p[GRAM:] - p[:-GRAM]) * down[:len(b) - GRAM + 1]) & ~_PLACE
        place = np.arange(len(h), dtype=np.uint64) & _PLACE
        if twices:
            first = _sliding_min(h | place, span)
            last = _sliding_min(h | (_PLACE - place), span)
            anchor = first >> np.uint64(8)
            first, last = first & _PLACE, _PLACE - (last & _PLACE)
        else:
            anchor = _sliding_min(h, span) >> np.uint64(8)
        n = len(anchor)
        cut = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        run_start = np.concatenate(([0], cut))
        run_len = np.diff(np.concatenate((run_start, [n])))
        pieces = -(-run_len // span)             # runs in periodic text are cut
        start = np.repeat(run_start, pieces)
        nth = np.arange(len(start)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = start + nth * span
        end = np.minimum(start + span, np.repeat(run_start + run_len, pieces))
        size = end - start
        twice = np.zeros(len(start), bool)
        if twices:
            moved = np.zeros(n, np.int32)
            moved[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
            changes = np.cumsum(moved)
            twice = (changes[end - 1] != changes[start]) | (first[start] != last[start])
        digest = np.zeros(len(start), np.uint64)
        if digests:
            q, qdown = _prefix(b, 23)
            stop = end + length - 1
            digest = _mixed((q[stop] - q[start]) * qdown[start] + size.astype(np.uint64))
        parts.append((anchor[start].view(np.int64), digest.view(np.int64), start + at, size, twice))
    if not parts:
        return [np.empty(0, np.int64)] * 4 + [np.empty(0, bool)]
    return [np.concatenate(c) for c in zip(*parts)]


# ------------------------------------------------ column-wise BWT and LCP

def _range_min(lcp: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(lcp[lo..hi]) per pair, hi included."""
    if not len(lo):
        return np.empty(0, lcp.dtype)
    pairs = np.empty(2 * len(lo), np.int64)
    pairs[::2], pairs[1::2] = lo, hi + 1
    return np.minimum.reduceat(np.append(lcp, lcp.dtype.type(0)), pairs)[::2]


def collection_bwt(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray, folder: str):
    """BWT and LCP array of the strings ``flat[starts:starts + lens]``, each
    closed by an end mark of its own (the marks sort first, by string).

    Round j puts, for every string of j symbols or more, its suffix of length j
    in order: a symbol c at place p of the BWT belongs to the suffix that
    starts with c, whose place is the number of smaller symbols plus the c's
    before p.  Its common prefix with the next c-suffix on either side is one
    more than the smallest common prefix between the two c's.  Both arrays are
    read from the last round's files and written to new ones, front to back.
    """
    marks = int(flat.max(initial=0)) >= 255       # 255 never occurs in UTF-8
    sym, mark = (np.uint16, np.uint16(256)) if marks else (np.uint8, np.uint8(255))
    longest = int(lens.max(initial=0))
    num = np.uint8 if longest < 255 else np.uint32
    m, flat = len(lens), flat.astype(sym)

    def store(j, bwt, lcp):
        bwt.tofile(os.path.join(folder, f"bwt.{j % 2}"))
        lcp.tofile(os.path.join(folder, f"lcp.{j % 2}"))

    def load(j):
        return (np.fromfile(os.path.join(folder, f"bwt.{j % 2}"), sym),
                np.fromfile(os.path.join(folder, f"lcp.{j % 2}"), num))

    store(0, flat[starts + lens - 1], np.zeros(m, num))
    place, owner = np.arange(m), np.arange(m)
    for j in range(1, longest + 1):
        bwt, lcp = load(j - 1)
        order = np.argsort(bwt, kind="stable")
        fresh = np.zeros(len(bwt), bool)
        fresh[place] = True
        rank = np.flatnonzero(fresh[order])
        p = order[rank]
        s = owner[np.searchsorted(place, p)]
        c = bwt[p]
        before, after = order[np.maximum(rank - 1, 0)], order[np.minimum(rank + 1, len(order) - 1)]
        has_before = (rank > 0) & (bwt[before] == c)
        has_after = (rank < len(order) - 1) & (bwt[after] == c)
        new = m + rank
        old = np.ones(len(bwt) + len(new), bool)
        old[new] = False
        left = lens[s] - j
        bwt2 = np.empty(len(old), sym)
        bwt2[old] = bwt
        bwt2[new] = np.where(left > 0, flat[starts[s] + np.maximum(left, 1) - 1], mark)
        lcp2 = np.empty(len(old), num)
        lcp2[old] = lcp
        lcp2[new] = 0
        lcp2[new[has_before]] = _range_min(lcp, before[has_before] + 1, p[has_before]) + 1
        lcp2[new[has_after] + 1] = _range_min(lcp, p[has_after] + 1, after[has_after]) + 1
        store(j, bwt2, lcp2)
        live = left > 0
        place, owner = new[live], s[live]
    return load(longest)


def suffix_rows(bwt: np.ndarray, lens: np.ndarray, at_least: int):
    """(row, string, start) of every suffix of ``at_least`` symbols or more,
    by walking all strings from their ends through the finished BWT."""
    m = len(lens)
    order = np.argsort(bwt, kind="stable")
    up = np.empty(len(bwt), np.int64)
    up[order] = m + np.arange(len(bwt))
    rows, ids, out = np.arange(m), np.arange(m), []
    for j in range(1, int(lens.max(initial=0)) + 1):
        go = lens[ids] >= j
        ids, rows = ids[go], up[rows[go]]
        if j >= at_least:
            out.append((rows, ids, lens[ids] - j))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 3


def _later_places(key: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of rows sorted by (key, doc, at): which are later than their key's first
    place (the same place twice is not later than itself)."""
    later = np.zeros(len(key), bool)
    later[1:] = key[1:] == key[:-1]
    first = np.maximum.accumulate(np.where(later, 0, np.arange(len(key))))
    return later & ((doc != doc[first]) | (at != at[first]))


def repeated_windows(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray, doc: np.ndarray, start: np.ndarray,
                     length: int, folder: str):
    """(doc, window start) of every window of ``length`` bytes in the strings
    ``flat[starts:starts + lens]`` that is equal to an earlier one of the
    collection; ``start``: where the strings begin in their documents."""
    bwt, lcp = collection_bwt(flat, starts, lens, folder)
    rows, ids, offset = suffix_rows(bwt, lens, length)
    run = np.cumsum(lcp < length)[rows]
    d, w = doc[ids], start[ids] + offset
    by = np.lexsort((w, d, run))
    run, d, w = run[by], d[by], w[by]
    later = _later_places(run, d, w)
    return d[later], w[later]


def _string_hashes(flat: np.ndarray, offset: np.ndarray, seed: int):
    """A function (lo, hi) -> hashes of flat[lo:hi]; a pair lies in one string,
    and ``offset`` is each byte's place in its string."""
    values, up, down = _hash_tables(int(offset.max(initial=0)) + 1, seed)
    p = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(values[flat] * up[offset], out=p[1:])
    return lambda lo, hi: (p[hi] - p[lo]) * down[offset[lo]]


#: Windows whose first anchor lies in one band of this many places are judged together.
BAND = 9


def narrowed(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray, anchor: np.ndarray, doc: np.ndarray,
             start: np.ndarray, length: int):
    """Cut strings down to what can still repeat.

    A window whose first anchor gram stands ``l`` bytes from its start shares,
    with all windows of the same band of ``l``, a core of ``length - BAND + 1``
    bytes that lies fixed to that gram.  Equal windows have equal ``l`` and so
    equal cores.  A band's windows whose core stands nowhere else hold no repeat
    and are left out; nothing is settled here.

    Returns (lo, hi, doc, start) of the strings left, as slices of ``flat``."""
    offset = np.arange(len(flat)) - np.repeat(starts, lens)
    inside = np.flatnonzero(offset <= np.repeat(lens - GRAM, lens))
    gram = _mixed(_string_hashes(flat, offset, 11)(inside, inside + GRAM)) >> np.uint64(8)
    of = np.repeat(np.arange(len(lens)), lens - GRAM + 1)
    hit = np.flatnonzero(gram == anchor.view(np.uint64)[of])
    of, at = of[hit], offset[inside[hit]]            # every place of every string's anchor
    after = np.zeros(len(of), np.int64)              # windows before it have an earlier one
    after[1:] = np.where(of[1:] == of[:-1], at[:-1] + 1, 0)
    lo, hi, owner, core, core_end = [], [], [], [], []
    for first in range(0, length - GRAM + 1, BAND):
        last = min(first + BAND - 1, length - GRAM)
        a = np.maximum(np.maximum(at - last, 0), after)
        z = np.minimum(at - first, lens[of] - length)
        ok = np.flatnonzero(a <= z)
        base = starts[of[ok]]
        lo.append(base + a[ok])
        hi.append(base + z[ok] + length)
        owner.append(of[ok])
        core.append(base + at[ok] - first)
        core_end.append(base + at[ok] - last + length)
    lo, hi, owner, core, core_end = map(np.concatenate, (lo, hi, owner, core, core_end))
    _, group, size = np.unique(_mixed(_string_hashes(flat, offset, 31)(core, core_end)), return_inverse=True,
                               return_counts=True)
    keep = size[group] > 1
    lo, hi, owner = lo[keep], hi[keep], owner[keep]
    # neighbouring bands of a string become one slice again
    by = np.lexsort((lo, owner))
    lo, hi, owner = lo[by], hi[by], owner[by]
    new = np.ones(len(lo), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (lo[1:] > hi[:-1] - length + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(lo)) - 1 if len(lo) else first
    lo, hi, owner = lo[first], hi[last], owner[first]
    return lo, hi, doc[owner], start[owner] + lo - starts[owner]


def _intervals(doc: np.ndarray, window: np.ndarray, length: int):
    """Byte intervals (doc, lo, hi) under the given windows, neighbours joined."""
    by = np.lexsort((window, doc))
    doc, window = doc[by], window[by]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (window[1:] > window[:-1] + 1)
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(doc)) - 1 if len(doc) else lo
    return doc[lo], window[lo], window[hi] + length


# ------------------------------------------------------------------ the jobs

def _order() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST).cast("long"))


#: What a document is known by.
_DOC = ["doc", "tie"]
#: How an interval was found to be repeated.
COPY, ARRAY, WINDOW = range(3)


def _anchor_rows(base: DataFrame, length: int) -> DataFrame:
    """One row per segment: its anchor and the number of places it stands for (2
    if the gram stands in the segment twice)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text in b.column(0):
                anchor, _, _, _, twice = segments(text.as_py(), length, digests=False)
                if len(anchor):
                    yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(1 + twice.astype(np.int64))],
                                                     names=["anchor", "places"])
    return map_batches(base.select("data"), run, "anchor long, places long")


def _segment_rows(base: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, tie, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                anchor, digest, start, size, _ = segments(text.as_py(), length, twices=False)
                if len(anchor):
                    # the number of windows shares a number with the start
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(digest), pa.array(np.full(len(anchor), doc, np.int64)),
                         pa.array(np.full(len(anchor), tie, np.int64)), pa.array((start << 8) | size)],
                        names=["anchor", "digest", "doc", "tie", "packed"])
    return map_batches(base.select("doc", "tie", "data"), run, "anchor long, digest long, doc long, tie long, packed long")


def _ranked(doc: np.ndarray, tie: np.ndarray):
    """Each document's number in the order of this collection, and the documents."""
    by = np.lexsort((tie, doc))
    new = np.ones(len(by), bool)
    new[1:] = (doc[by][1:] != doc[by][:-1]) | (tie[by][1:] != tie[by][:-1])
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(new) - 1
    return rank, doc[by][new], tie[by][new]


def _collection_rows(strings: DataFrame, length: int) -> DataFrame:
    """Intervals from the collections; a task's strings (a few MB by how they
    were dealt) are one collection."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, numbers = [], []
        for b in batches:
            texts += b.column(4).to_pylist()
            numbers.append([b.column(c).to_numpy(zero_copy_only=False) for c in range(4)])
        if not texts:
            return
        doc, tie, start, anchor = map(np.concatenate, zip(*numbers))
        rank, docs, ties = _ranked(doc, tie)
        lens = np.array([len(t) for t in texts], np.int64)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        lo, hi, d, s = narrowed(flat, np.cumsum(lens) - lens, lens, anchor, rank, start, length)
        if not len(lo):
            return
        with tempfile.TemporaryDirectory(prefix="bwt-") as folder:   # this task's own files
            d, w = repeated_windows(flat, lo, hi - lo, d, s, length, folder)
        at, lo, hi = _intervals(d, w, length)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (docs[at], ties[at], lo, hi)]
                                         + [pa.array(np.full(len(at), ARRAY, np.int32))], names=[*_DOC, "lo", "hi", "how"])
    return map_batches(strings.select(*_DOC, "start", "anchor", "bytes"), run, "doc long, tie long, lo long, hi long, how int")


def _window_rows(strings: DataFrame, length: int) -> DataFrame:
    """One row per window of the strings: two 64-bit hashes and its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, tie, start, text in zip(*[c.to_pylist() for c in b.columns]):
                data = np.frombuffer(text, np.uint8)
                cols = []
                for seed in (11, 23):
                    p, down = _prefix(data, seed)
                    h = _mixed((p[length:] - p[:-length]) * down[:len(data) - length + 1])
                    cols.append(pa.array(h.view(np.int64)))
                n = len(cols[0])
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(np.full(n, doc, np.int64)), pa.array(np.full(n, tie, np.int64)), pa.array(start + np.arange(n))],
                    names=["h1", "h2", *_DOC, "start"])
    return map_batches(strings.select(*_DOC, "start", "bytes"), run, "h1 long, h2 long, doc long, tie long, start long")


def _later_than_first(places: DataFrame, firsts: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``places`` that are not the first place of their key."""
    place = [*_DOC, "start"]
    f = firsts.select(*keys, *[F.col(c).alias(f"f_{c}") for c in place])
    return places.join(f, keys).filter(F.struct(*place) != F.struct(*[f"f_{c}" for c in place]))


def _finished(rows: DataFrame, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, cover in zip(b.column(1), b.column(2)):
                data = np.frombuffer(text.as_py(), np.uint8)
                step = np.zeros(len(data) + 1, np.int64)
                if cover.is_valid and len(data):
                    flat = cover.values.flatten()
                    lo, hi = (np.minimum(x.to_numpy(zero_copy_only=False), len(data)) for x in flat)
                    np.add.at(step, lo, 1)
                    np.add.at(step, hi, -1)
                gone = np.cumsum(step[:-1]) > 0
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[:1].sum())
                out.append((len(data), int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            n = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in n[:3]], pa.array(n[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    # the identifier comes out of the order, so that this join and the one that
    # cuts the strings read one and the same exchange of the texts
    doc_id = F.when(F.col("doc") != _LOWEST, F.col("doc")).cast(kind).alias("doc_id")
    return map_batches(rows.select(doc_id, "data", "cover"), run,
                       f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def repeated_intervals(base: DataFrame, length: int, crowd: int, collection_mb: int) -> DataFrame:
    """``doc, tie, lo, hi, how``: byte intervals under repeated strings (may
    overlap).  ``base``: doc, tie, data (bytes).

    What a join by anchor looks up is written first: a hot anchor's rows can then
    be split over several tasks (AQE's skew join splits no side whose other one
    is aggregated in the same stage)."""
    spark = base.sparkSession
    shared = staged(_anchor_rows(base, length).groupBy("anchor").agg(
        F.sum("places").alias("n"), F.max("places").alias("most")).filter("n > 1")
        .select("anchor", (F.col("most") > 1).alias("twice")), "suffix-shared")
    places = staged(_segment_rows(base, length).join(shared, "anchor").select(
        "anchor", "digest", *_DOC, F.shiftright("packed", 8).alias("start"),
        F.col("packed").bitwiseAND(F.lit(255).cast("long")).alias("windows"), "twice"), "suffix-places")
    firsts = staged(places.groupBy("anchor", "digest").agg(
        F.min(F.struct(*_DOC, "start")).alias("at"), F.max("windows").alias("windows"),
        F.max("twice").alias("twice"), F.count("*").alias("n"))
        .select("anchor", "digest", "at.*", "windows", "twice", "n"), "suffix-firsts")

    copies = _later_than_first(places, firsts.filter("n > 1"), ["anchor", "digest"]).select(
        *_DOC, F.col("start").alias("lo"), (F.col("start") + F.col("windows") + (length - 1)).alias("hi"), F.lit(COPY).alias("how"))

    per_anchor = staged(firsts.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max("twice").alias("any_twice"))
                        .filter("kinds > 1 OR any_twice").select("anchor", "kinds"), "suffix-kinds")
    wanted = staged(firsts.join(per_anchor, "anchor").select("anchor", *_DOC, "start", "windows", "kinds"),
                    "suffix-wanted")
    size = wanted.agg(F.sum(F.col("windows") + length).alias("b"), F.max("kinds").alias("k")).first()
    by_doc = wanted.groupBy(*_DOC).agg(F.collect_list(F.struct("anchor", "start", "windows", "kinds")).alias("w"))
    strings = base.join(by_doc, _DOC).select(*_DOC, "data", F.explode("w").alias("w")).select(
        *_DOC, "w.anchor", "w.start", "w.kinds",
        F.substring("data", F.col("w.start").cast("int") + 1,
                    (F.col("w.windows") + (length - 1)).cast("int")).alias("bytes"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                math.ceil((size["b"] or 0) / (collection_mb << 20)))
    crowded = (size["k"] or 0) > crowd
    quiet = strings.filter(F.col("kinds") <= crowd) if crowded else strings
    out = copies.unionByName(_collection_rows(quiet.repartition(parts, "anchor"), length))
    if crowded:
        windows = staged(_window_rows(strings.filter(F.col("kinds") > crowd), length), "suffix-windows")
        keys = ["h1", "h2"]
        earliest = windows.groupBy(*keys).agg(F.min(F.struct(*_DOC, "start")).alias("at"), F.count("*").alias("n")) \
            .filter("n > 1").select(*keys, "at.*")
        out = out.unionByName(_later_than_first(windows, earliest, keys).select(
            *_DOC, F.col("start").alias("lo"), (F.col("start") + length).alias("hi"), F.lit(WINDOW).alias("how")))
    return out


def _base(docs: DataFrame) -> DataFrame:
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(_order().alias("doc"), F.xxhash64(data).alias("tie"), data.alias("data"))


def remove_repeats(docs: DataFrame, length: int = 100, crowd: int = 100_000, collection_mb: int = 4) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    if length < 2 * GRAM or 2 * length > 255:
        raise ValueError(f"length must lie between {2 * GRAM} and 127")
    base = _base(docs)
    cover = repeated_intervals(base, length, crowd, collection_mb) \
        .groupBy(*_DOC).agg(F.collect_list(F.struct("lo", "hi")).alias("cover"))
    return _finished(base.join(cover, _DOC, "left"), docs.schema["doc_id"].dataType.simpleString())
