"""Personal data: exact patterns, and a character BiLSTM-CRF that adds to them.

Base spans (email, ip, card, phone) come from fixed patterns and always stay.
A tagger (``tagger.Tagger``) is trained from labelled spans: windows of the
corpus around base spans, and windows with generated data in spellings that
the patterns miss ("name (at) example dot com", "555-0100 ext", grouped
cards), set into the corpus's own text.  It then reads every text:

* A text is decoded in overlapping windows of ``WIDTH`` characters, ``WIDTH //
  2`` apart.  Windows without a trigger (a digit, ``@`` or "at" as a word, in
  any case and any brackets) are passed over: ``accepted`` takes no span without
  one, so the result is that of decoding every window.
* Spans cut by a window's edge are stitched: touching parts of one kind from
  neighbouring windows are joined, and the text around them is decoded again in
  one wider window, wider still while its span is cut, up to ``WIDEST``
  characters.  So a span is found wherever the windows' edges fall.
* The document's candidate spans from all windows are reconciled together: a
  weighted interval schedule keeps the set of non-overlapping spans with the
  largest total margin over "outside".
* A candidate must pass its kind's plausibility check (Luhn, digits, parts) and
  a least margin, and must not touch a base span.

The training sample is bounded: ``sample_windows`` windows of the corpus, those
with the smallest hash of (doc_id, place) over all rows, and a few generated ones
for each.  Everything else covers whole texts of all rows, in one pass without a
shuffle.

Edge cases: null text counts as empty; an empty table gives an empty result (the
tagger then learns from generated windows alone); repeated rows give equal rows;
very long texts are decoded in bounded batches; other columns are not looked at.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from bisect import bisect_right
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimsdq.llm.common import map_batches, staged
from claimsdq.llm.tagger import PAD, Tagger, char_classes

KINDS = ("email", "ip", "card", "phone")
WIDTH = 96
#: The widest window in which a cut span is decoded again.
WIDEST = 1536
_BATCH = 512
#: Generated windows for each one of the corpus.
GENERATED = 3
Span = tuple[int, int, int]      # kind number, start, end

# ---------------------------------------------------------------- the patterns

# Equal to the plain patterns, but each text is scanned in linear time: an
# email is looked for around its "@", runs of digits are entered at their start.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# "at" and "dot" as words of any case: no letter or digit on either side.
_AT = re.compile(r"@|(?<![^\W_])at(?![^\W_])", re.IGNORECASE)
_DOT = re.compile(r"\.|(?<![^\W_])dot(?![^\W_])", re.IGNORECASE)
# A spelled-out address: parts without blanks; "at" and "dot" stand as signs, in
# brackets, or as words between blanks (or other joints).
_JOINT = r"[\s_-]"


def _spelled(sign: str, word: str) -> str:
    return rf"(?:{sign}|{_JOINT}*[(\[{{]\s*(?:{sign}|{word})\s*[)\]}}]{_JOINT}*|{_JOINT}+{word}{_JOINT}+)"


_PART = r"[^\W_]+(?:-[^\W_]+)*"
_ADDRESS = re.compile(rf"[^\s@()\[\]{{}}]+?{_spelled(r' ?@ ?', 'at')}{_PART}(?:{_spelled(r'[.]', 'dot')}{_PART})+", re.IGNORECASE)
# What every accepted span holds.
_TRIGGER = re.compile(f"[0-9]|{_AT.pattern}", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        x = int(d) * (1 + n % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _byte(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """The base spans by kind, then start."""
    out: list[Span] = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(_byte(p) for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def plausible(kind: int, s: str) -> bool:
    """Whether a tagged string can be what its tag says."""
    d = _digits(s)
    if kind == 0:
        return bool(_AT.search(s)) and bool(_DOT.search(s)) and len(s) >= 7
    if kind == 1:
        parts = re.findall(r"[0-9]+", s)
        return len(parts) == 4 and all(map(_byte, parts))
    if kind == 2:
        return 13 <= len(d) <= 19 and luhn(d)
    return 7 <= len(d) <= 15


def accepted(span: Span, text: str) -> bool:
    """Whether a tagged span is plausible; its "at" and "dot" must be words of
    the text, not word ends that the span's edge cuts off ("form|at x.y")."""
    kind, lo, hi = span

    def holds(word):
        return any(lo <= m.start() and m.end() <= hi for m in word.finditer(text, max(0, lo - 1), hi + 1))
    return plausible(kind, text[lo:hi]) and (kind != 0 or (holds(_AT) and holds(_DOT)))


def settled(span: Span, text: str, reach: int = 64) -> Span:
    """A tagged address as the spelled-out address it lies on, up to ``reach``
    characters further on either side (the one that shares most with the span);
    other spans, and tags on no such address, as they are."""
    kind, lo, hi = span
    if kind != 0:
        return span
    start = lo
    while start > 0 and lo - start < reach and text[start - 1] in _LOCAL:
        start -= 1
    near = [m.span() for m in _ADDRESS.finditer(text, start, min(len(text), hi + reach))]
    best = max(near, key=lambda x: (min(x[1], hi) - max(x[0], lo), x[1] - x[0]), default=(lo, hi))
    return (kind, *best) if best[0] < hi and best[1] > lo else span


# ------------------------------------------------------------- labelled windows

def tags_of(spans: list[Span], start: int, width: int = WIDTH) -> np.ndarray:
    """Tags of a window: 0 outside, 1 + 2 kind at a span's start, 2 + 2 kind in it."""
    t = np.zeros(width, np.int64)
    for kind, lo, hi in spans:
        lo2, hi2 = max(lo, start), min(hi, start + width)
        if lo2 < hi2:
            t[lo2 - start:hi2 - start] = 2 + 2 * kind
            if lo >= start:
                t[lo - start] = 1 + 2 * kind
    return t


def generated_windows(contexts: list[str], n: int, seed: int = 5, cuts: float = 0.0,
                      long: float = 0.0) -> list[tuple[str, list[Span]]]:
    """Windows of context with generated data in them, and its spans.  One in
    five holds look-alikes instead (dates, versions, order numbers, hex).  A share
    ``cuts`` of the windows begins anywhere, so their spans may be cut on either
    side; a share ``long`` of the addresses has many parts."""
    r = np.random.default_rng(seed)

    def num(k):
        return "".join(map(str, r.integers(0, 10, k)))

    def word():
        return "".join(chr(97 + c) for c in r.integers(0, 26, r.integers(3, 9)))

    def pick(*options):
        return options[r.integers(len(options))]

    def card():
        body = num(15)
        body += next(d for d in "0123456789" if luhn(body + d))
        sep = pick("", " ", "-", ".", "  ")
        return sep.join(body[i:i + 4] for i in range(0, 16, 4))

    def email():
        at, dot = pick(("@", "."), (" at ", " dot "), (" (at) ", "."), ("[at]", "[dot]"), ("(at)", "(dot)"), (" @ ", "."),
                       (" AT ", " DOT "), (" (AT) ", "."), ("[AT]", "[DOT]"), (" ( at ) ", " ( dot ) "), ("{at}", "{dot}"))
        if long and r.random() < long:
            local = pick(".", "_", "-").join(word() for _ in range(r.integers(2, 6)))
            host = dot.join(word() for _ in range(r.integers(2, 6)))
            return f"{local}{at}{host}{dot}{pick('com', 'org', 'net', 'edu')}"
        return f"{word()}{pick('', '.', '_')}{num(2) if r.random() < .3 else word()}{at}{word()}{dot}{pick('com', 'org', 'net')}"

    def ip():
        return pick(".", " . ", "[.]").join(str(x) for x in r.integers(0, 256, 4))

    def phone():
        return pick(f"{num(3)}-{num(3)}-{num(4)}", f"({num(3)}) {num(3)}-{num(4)}", f"00{num(2)} {num(3)} {num(6)}",
                    f"+{num(1)} ({num(3)}) {num(3)}-{num(4)}", f"{num(3)}.{num(3)}.{num(4)}", f"+{num(2)}/{num(3)}/{num(6)}")

    def lookalike():
        return pick(f"{num(4)}-{num(2)}-{num(2)}", f"Version {num(1)}.{num(1)}", f"v{num(1)}.{num(2)}.{num(1)}",
                    f"no. {num(6)}", num(16), num(3), f'"{r.bytes(20).hex()}"', f"{num(2)}:{num(2)}:{num(2)}",
                    f"$ {num(3)},{num(3)}.{num(2)}", f"@{word()}", f"at {num(1)}.{num(1)}")

    makers, out = (email, ip, card, phone), []
    for _ in range(n):
        context = contexts[r.integers(len(contexts))] if contexts else " ".join(word() for _ in range(20))
        cut = int(r.integers(0, 60))
        left, right = (context[:cut].rstrip() + " ").lstrip(), " " + context[cut:].lstrip()
        spans = []
        if r.random() < 0.2:
            text = left + lookalike() + right
        else:
            kind = int(r.integers(4))
            s = makers[kind]()
            text = left + s + right
            spans = [(kind, len(left), len(left) + len(s))]
        if cuts and r.random() < cuts:
            more = contexts[r.integers(len(contexts))] if contexts else word()
            at = int(r.integers(0, max(1, len(left) + len(text) // 2)))
            text, spans = f"{text} {more}"[at:], [(k, lo - at, hi - at) for k, lo, hi in spans if hi > at]
        out.append((text[:WIDTH], [s for s in spans if s[1] < WIDTH]))
    return out


def labelled_windows(docs: DataFrame, n: int) -> list[tuple[str, list[Span]]]:
    """The ``n`` windows around triggers with the smallest hash of (doc_id, place),
    over all rows, with the base spans in them.  Each task keeps its ``n`` smallest,
    so it sends windows, never texts, and no document or part of the table is
    favoured; the driver gets the ``n`` smallest of all and nothing else."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = []                                 # a heap: the largest hash kept on top
        for b in batches:
            for doc, t in zip(b.column(0).to_pylist(), b.column(1)):
                text, spans, last = t.as_py() or "", None, -WIDTH
                for m in _TRIGGER.finditer(text):
                    start = max(0, m.start() - WIDTH // 3)
                    if m.start() < last + WIDTH:
                        continue
                    last = start
                    order = -crc32(f"{doc}:{start}".encode())
                    if len(best) >= n and (order, "") <= best[0][:2]:
                        continue
                    spans = base_spans(text) if spans is None else spans
                    inside = [(k, lo - start, hi - start) for k, lo, hi in spans if lo < start + WIDTH and hi > start]
                    row = (order, text[start:start + WIDTH], ",".join(f"{k}:{a}:{z}" for k, a, z in inside))
                    (heapq.heappush if len(best) < n else heapq.heappushpop)(best, row)
        yield pa.RecordBatch.from_arrays([pa.array([-r[0] for r in best], pa.int64()), pa.array([r[1] for r in best], pa.string()),
                                          pa.array([r[2] for r in best], pa.string())], names=["h", "w", "s"])
    rows = map_batches(docs.select("doc_id", "text"), run, "h long, w string, s string")
    # written first: a collected top-n would send every task's n rows to the driver
    found = staged(rows.orderBy("h", "w", "s").limit(n), "pii-sample").orderBy("h", "w", "s").collect()
    return [(r["w"], [tuple(map(int, x.split(":"))) for x in r["s"].split(",") if x]) for r in found]


def train(docs: DataFrame, sample_windows: int = 600, epochs: int = 8) -> Tagger:
    real = labelled_windows(docs, sample_windows)
    contexts = [re.sub(r"[0-9@]+", "", w) for w, _ in real]
    windows = real + generated_windows(contexts, GENERATED * sample_windows, cuts=0.3, long=0.3)
    return train_on(windows, epochs)


def train_on(windows: list[tuple[str, list[Span]]], epochs: int) -> Tagger:
    ids = np.full((len(windows), WIDTH), PAD)
    tags = np.zeros((len(windows), WIDTH), np.int64)
    for n, (w, spans) in enumerate(windows):
        c = char_classes(w)[:WIDTH]
        ids[n, :len(c)] = c
        tags[n] = tags_of(spans, 0)
        tags[n, len(c):] = 0
    tagger = Tagger(1 + 2 * len(KINDS))
    tagger.fit(ids, tags, epochs)
    return tagger


# ------------------------------------------------------------------- the search

def window_starts(text: str) -> list[int]:
    """Starts of the overlapping windows that hold a trigger's first character,
    so of every window that holds an ``accepted`` span whole."""
    step, out, last = WIDTH // 2, [], -1
    for m in _TRIGGER.finditer(text):
        first = max(0, m.start() // step - 1)
        for k in range(max(first, last + 1), m.start() // step + 1):
            if k * step < len(text):
                out.append(k * step)
                last = k
    return out


def spans_in(tags: np.ndarray, margin: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
    """(kind, start, end, margin) of the spans in one tagged window."""
    t = 0
    while t < len(tags):
        if tags[t] == 0:
            t += 1
            continue
        kind, end = int(tags[t] - 1) // 2, t + 1
        while end < len(tags) and tags[end] == 2 + 2 * kind:
            end += 1
        yield kind, t, end, float(margin[t:end].sum())
        t = end


def reconcile(found: dict[Span, float]) -> list[Span]:
    """The non-overlapping spans with the largest total margin."""
    spans = sorted(found, key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in spans]
    best, take = [0.0], []
    for n, s in enumerate(spans):
        before = bisect_right(ends, s[1], 0, n)
        with_it = best[before] + found[s]
        take.append(with_it > best[-1])
        best.append(max(best[-1], with_it))
    out, n = [], len(spans)
    while n:
        if take[n - 1]:
            out.append(spans[n - 1])
            n = bisect_right(ends, spans[n - 1][1], 0, n - 1)
        else:
            n -= 1
    return out[::-1]


def stitched(parts: list[Span]) -> list[Span]:
    """Touching or overlapping parts of one kind joined."""
    out: list[Span] = []
    for kind, lo, hi in sorted(parts):
        if out and out[-1][0] == kind and lo <= out[-1][2]:
            out[-1] = (kind, out[-1][1], max(hi, out[-1][2]))
        else:
            out.append((kind, lo, hi))
    return out


def _decoded(texts: list[str], jobs: list[tuple[int, int, int]], tagger: Tagger) -> Iterator[tuple[int, Span, float, bool]]:
    """Spans in windows (text, start, width): text, span, margin, whether an edge cuts it."""
    by_width: dict[int, list] = {}
    for job in jobs:
        by_width.setdefault(job[2], []).append(job)
    for width, mine in sorted(by_width.items()):
        size = max(1, _BATCH * WIDTH // width)
        for at in range(0, len(mine), size):
            some = mine[at:at + size]
            ids = np.full((len(some), width), PAD)
            for row, (n, start, _) in enumerate(some):
                c = char_classes(texts[n][start:start + width])
                ids[row, :len(c)] = c
            tags, margin = tagger.decode(ids)
            for row in np.flatnonzero(tags.any(axis=1)):
                n, start, _ = some[row]
                here = min(width, len(texts[n]) - start)
                for kind, lo, hi, score in spans_in(tags[row, :here], margin[row]):
                    cut = (lo == 0 and start > 0) or (hi == here and start + here < len(texts[n]))
                    yield n, (kind, start + lo, start + hi), score, cut


def find_spans(texts: list[str], tagger: Tagger, least_margin: float = 3.0,
               starts_of=window_starts) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    jobs = [(n, start, WIDTH) for n, t in enumerate(texts) for start in starts_of(t)]
    found: list[dict[Span, float]] = [{} for _ in texts]
    asked = set(jobs)
    while jobs:
        cuts: dict[int, list[Span]] = {}
        for n, s, score, cut in _decoded(texts, jobs, tagger):
            if cut:
                cuts.setdefault(n, []).append(s)
                continue
            s = settled(s, texts[n])
            if accepted(s, texts[n]):
                found[n][s] = max(score, found[n].get(s, 0.0))
        jobs = []
        for n, parts in cuts.items():
            for _, lo, hi in stitched(parts):
                width = 2 * WIDTH
                while width < hi - lo + WIDTH:
                    width *= 2
                if width > WIDEST:
                    continue
                # the parts in the middle, but no window reaches beyond the text
                start = max(0, min((lo + hi - width) // 2, len(texts[n]) - width))
                job = (n, start, min(width, len(texts[n])))
                if job not in asked:
                    asked.add(job)
                    jobs.append(job)
    out = []
    for n, text in enumerate(texts):
        added = []
        if found[n]:
            taken = sorted((lo, hi) for _, lo, hi in base[n])
            starts = [lo for lo, _ in taken]
            reach = np.maximum.accumulate([hi for _, hi in taken]) if taken else []
            for s in reconcile(found[n]):
                k = bisect_right(starts, s[2] - 1)
                if found[n][s] >= least_margin and not (k and reach[k - 1] > s[1]):
                    added.append(s)
        out.append((base[n], sorted(base[n] + added)))
    return out


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{lo}:{hi}" for k, lo, hi in spans)


def scan(docs: DataFrame, tagger: Tagger | None = None, **training) -> DataFrame:
    """Per document: ``doc_id``, the number of base spans by kind, the digest of
    the base spans and all spans as text (kind:start:end, by kind and start)."""
    model = train(docs, **training) if tagger is None else tagger

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                b = whole.slice(start, 256)
                found = find_spans([t.as_py() or "" for t in b.column(1)], model)
                counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64())
                          for k in range(len(KINDS))]
                sha = [hashlib.sha256(shown(base).encode()).hexdigest() for base, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *counts, pa.array(sha, pa.string()),
                     pa.array([shown(every) for _, every in found], pa.string())], names=names)
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = ", ".join(f"n_{k} long" for k in KINDS)
    return map_batches(docs.select("doc_id", "text"), run,
                       f"doc_id {kind}, {counted}, base_sha256 string, spans string")
