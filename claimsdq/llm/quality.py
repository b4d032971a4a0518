"""Quality rules as a short-circuit cascade.

Every rule is a test on one text with the measurements it needs.  On a bounded
sample of rows (``sample_rows``, a documented parameter) each rule's time and its rejections are measured; the rules are
then ordered by rejection per cost, and every document of the table runs down
that order until the first rule rejects it.  A document stays if no rule
rejects it, so the order changes the work and never the verdict.

Measurements are shared: the words of a text are split once, and a rule pays
only for what no earlier rule has computed (a text's ``Measures`` computes
each figure on first use).

Edge cases: a null text has no words and is rejected; an empty table gives an
empty result; very long texts are measured whole (memory in proportion to one
text); repeated rows get equal verdicts; other columns are not looked at.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsdq.llm.common import map_batches

# \x1c-\x1f and other blanks of str.split are no separators here
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")


class Measures:
    """Figures of one text, each computed when a rule first asks for it."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return _WORD.findall(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return len(_SYMBOL.findall(self.text))

    @cached_property
    def lines(self) -> list[str]:
        """The lines that hold a word."""
        return [line for line in self.text.split("\n") if _WORD.search(line)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a 5-word window that occurs more than once."""
        w = self.words
        if len(w) < 6:
            return 0
        seen = Counter(windows := list(zip(w, w[1:], w[2:], w[3:], w[4:])))
        if len(seen) == len(windows):
            return 0
        covered = end = 0
        for at, window in enumerate(windows):
            if seen[window] > 1:
                covered += at + 5 - max(at, end)
                end = at + 5
        return covered


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


#: The default rules.  The first two are the base; the others reject what the
#: labelled junk looks like (symbols after every word, one word over and over,
#: copied lines) with room on the side of clean text.
RULES = (
    Rule("few_words", lambda m: m.n_words < 10),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 20 * m.n_words),
    Rule("symbols", lambda m: 10 * m.n_symbols > 3 * m.n_words),
    Rule("repeated_lines", lambda m: 2 * m.n_dup_lines > len(m.lines)),
    Rule("word_length", lambda m: m.word_chars > 40 * m.n_words),
)
BASE = RULES[:2]


@dataclass(frozen=True)
class RuleCost:
    name: str
    seconds: float      # per document, with what it must compute first
    rejected: float     # share of the sample


def measure_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 200) -> list[RuleCost]:
    """Cost and selectivity of each rule alone, on a bounded sample: the first
    ``sample_rows`` rows in table order (a few row groups are read, not the
    corpus).  Measured inside a task over whole texts; the driver gets one
    line per rule and batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py() for t in b.column(0)]
            seconds, hits = [], []
            for rule in rules:
                began = time.thread_time()
                hits.append(sum(rule.rejects(Measures(t)) for t in texts))
                seconds.append(time.thread_time() - began)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.name for r in rules]), pa.array([len(texts)] * len(rules), pa.int64()),
                 pa.array(seconds, pa.float64()), pa.array(hits, pa.int64())],
                names=["rule", "n", "seconds", "hits"])

    lines = map_batches(docs.select("text").limit(sample_rows), run,
                        "rule string, n long, seconds double, hits long") \
        .groupBy("rule").agg(F.sum("n").alias("n"), F.sum("seconds").alias("s"), F.sum("hits").alias("h")).collect()
    found = {r["rule"]: RuleCost(r["rule"], r["s"] / max(1, r["n"]), r["h"] / max(1, r["n"])) for r in lines}
    return [found.get(r.name, RuleCost(r.name, 0.0, 0.0)) for r in rules]


def order_rules(costs: list[RuleCost], rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """Highest rejection per cost first; ties keep their given order."""
    by = {c.name: c for c in costs}
    return tuple(sorted(rules, key=lambda r: -by[r.name].rejected / max(by[r.name].seconds, 1e-9)))


def first_rejection(m: Measures, cascade: tuple[Rule, ...]) -> str | None:
    for rule in cascade:
        if rule.rejects(m):
            return rule.name
    return None


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def assess(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 200) -> DataFrame:
    """``doc_id``, the five figures, ``base_failed`` and ``kept`` of every row."""
    cascade = order_rules(measure_rules(docs, rules, sample_rows), rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1):
                m = Measures(t.as_py())
                kept = first_rejection(m, cascade) is None
                failed = any(r.rejects(m) for r in BASE)
                rows.append((*[getattr(m, f) for f in FIGURES], failed, kept and not failed))
            cols = list(zip(*rows)) or [()] * (len(FIGURES) + 2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in cols[:-2]],
                 *[pa.array(c, pa.bool_()) for c in cols[-2:]]],
                names=["doc_id", *FIGURES, "base_failed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    figures = ", ".join(f"{f} bigint" for f in FIGURES)
    return map_batches(docs.select("doc_id", "text"), run,
                       f"doc_id {kind}, {figures}, base_failed boolean, kept boolean")


def keep_clean(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 200) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns, one pass and no
    shuffle; a rejected text pays for the rules up to the rejecting one only."""
    cascade = order_rules(measure_rules(docs, rules, sample_rows), rules)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stays = [first_rejection(Measures(t.as_py()), cascade) is None for t in b.column(at)]
            yield b.filter(pa.array(stays, pa.bool_()))

    return map_batches(docs, run, docs.schema)
