"""Source divergence audit: how far each source's words lie from the others' of
its language, in whole numbers only.

1. *Vectors.*  Every document becomes an exact sparse vector: its terms (ASCII
   letters, lower-cased, and all characters above ASCII) and their counts.
2. *Vocabulary.*  Per lang, the terms in at least ``min_df`` documents; the size
   of the vocabulary has no bound but the largest integer.
3. *Group sums.*  As a summarizer does, each task adds its documents' vectors to
   one buffer per (lang, source), hands on the buffers when they hold
   ``buffer_terms`` terms, and the buffers of all tasks are merged: occurrences
   and documents per (lang, source, term), then one row per kept term with its
   non-zero sources.
4. *Pairs.*  With p and q the smoothed shares of a term in two groups, a pair's
   value is the sum of ``(p - q)^2 div q`` over the whole vocabulary.  It is
   summed from the non-zero entries alone: all terms as if absent from both
   sides, each side's terms (by how often each count occurs) as if absent from
   the other, and the terms of both corrected for that.

``pyspark.ml``'s CountVectorizer keeps the vocabulary on the driver and sends it
to every task, and its Summarizer holds a dense buffer of that length per group.
A vocabulary grows with its corpus, so the same steps run on tables here, and the
term itself is a vector's index.  Tests hold vocabulary, vectors and sums against
those two classes.

Edge cases: null text, lang and source count as empty; a group without terms is
still compared; a lang without kept terms gives 0 for every pair and no terms;
repeated rows are documents of their own; very long texts are read whole; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimsdq.llm.common import lookup_hot_safe, map_batches, staged

#: Shares are parts of this many.
UNIT = 1_000_000_000
#: Letters stay (A-Z as a-z), and so do the bytes of characters above ASCII.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: The small side of a join by lang is copied this often, to spread one lang over many tasks.
SPREAD = 32


def vector(text: bytes) -> Counter:
    """The sparse vector of one text in UTF-8: term (UTF-8) to count."""
    return Counter(text.translate(_TABLE).split())


def _columns(docs: DataFrame) -> DataFrame:
    empty = F.lit("")
    return docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"),
                       F.coalesce("text", empty).cast("binary").alias("data"))


def document_vectors(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source, terms, counts`` of every document, terms ascending."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "lang", "source", "terms", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [sorted(vector(t.as_py()).items()) for t in b.column(3)]
            terms = pa.array([[t for t, _ in p] for p in pairs], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
            counts = pa.array([[n for _, n in p] for p in pairs], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], terms, counts], names=names)
    rows = docs.select("doc_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")],
                       F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    return map_batches(rows, run, f"doc_id {kind}, lang string, source string, terms array<string>, counts array<long>")


def _buffers(docs: DataFrame, buffer_terms: int) -> DataFrame:
    """The tasks' buffers: ``lang, source, term, n, docs``; each group also has
    rows of the empty term, which no text holds."""
    names = ["lang", "source", "term", "n", "docs"]

    def flushed(groups: dict) -> pa.RecordBatch:
        cols = [[], [], [], [], []]
        for (lang, source), sums in groups.items():
            cols[0] += [lang] * len(sums)
            cols[1] += [source] * len(sums)
            cols[2] += sums
            cols[3] += [v >> 40 for v in sums.values()]
            cols[4] += [v & (1 << 40) - 1 for v in sums.values()]
        types = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, held = {}, 0
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                sums = groups.setdefault((lang, source), {b"": 0})
                before = len(sums)
                for term, n in vector(text.as_py()).items():
                    sums[term] = sums.get(term, 0) + (n << 40) + 1      # occurrences and documents in one number
                held += len(sums) - before
                if held > buffer_terms:
                    yield flushed(groups)
                    groups, held = {}, 0
        if groups:
            yield flushed(groups)

    out = map_batches(_columns(docs), run, "lang string, source string, term binary, n long, docs long")
    return out.withColumn("term", F.col("term").cast("string"))


def group_sums(docs: DataFrame, min_df: int = 3, buffer_terms: int = 400_000) -> tuple[DataFrame, DataFrame]:
    """(sums, groups).  ``sums``: ``lang, term, docs, total, sums`` (array of source,
    n > 0) of every kept term.  ``groups``: ``lang, source, n, terms, lang_n, size``
    (occurrences and kept terms of the group, occurrences of the lang, size of the
    lang's vocabulary)."""
    # one exchange serves both aggregates: the buffers are aggregated already
    merged = _buffers(docs, buffer_terms).repartition("lang", "term") \
        .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")) \
        .groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"),
                                     F.collect_list(F.struct("source", "n")).alias("sums"))
    table = staged(merged.filter((F.col("docs") >= min_df) | (F.col("term") == "")), "divergence-sums")
    kept = table.filter("term != ''")
    each = table.select("lang", "term", F.inline("sums"))
    here = F.col("term") != ""
    by_lang = kept.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("*").alias("size"))
    groups = each.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count_if(here).alias("terms")) \
        .join(by_lang, "lang", "left").fillna(0, ["lang_n", "size"])
    return kept, staged(groups, "divergence-groups")


def _share(count: str, n: str, size: str) -> str:
    """SQL: the smoothed share of a term, in parts of ``UNIT``."""
    return f"(1 + cast({UNIT} as decimal(38,0)) * ({count} + 1) div ({n} + {size}))"


def _gap(p: str, q: str) -> str:
    """SQL: what a term adds to the value of p against q."""
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _entries(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Every non-zero entry: ``lang, term, total, source, n`` with its group's
    figures, its share ``p`` and the share ``z`` of a term that the group lacks."""
    rows = kept.select("lang", "term", "total", F.inline("sums"))
    known = groups.filter("terms > 0").select("lang", "source", F.col("n").alias("group_n"), "terms", "lang_n", "size")
    found = lookup_hot_safe(rows, known, ["lang", "source"], "terms", groups.agg(F.sum("terms")).first()[0] or 0)
    return staged(found.selectExpr("lang", "term", "total", "source", "n", "group_n", "lang_n", "size",
                                   f"{_share('n', 'group_n', 'size')} AS p", f"{_share('0', 'group_n', 'size')} AS z"),
                  "divergence-entries")


def _spread(groups: DataFrame) -> DataFrame:
    """The other side of a join by lang, once per salt."""
    return groups.selectExpr("lang", "source AS item", "n AS item_n", "terms AS item_terms",
                             f"explode(sequence(0, {SPREAD - 1})) AS salt")


def pair_scores(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every ordered pair of a lang's sources."""
    others = _spread(groups)

    def salted(df: DataFrame, *by: str) -> DataFrame:
        return df.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SPREAD)).cast("int"))

    # as if no term were in both
    grid = salted(groups, "source").join(others, ["lang", "salt"]).filter("source != item")
    nothing = f"(size - terms - item_terms) * {_gap('z', 'item_z')}"
    base = grid.filter("size > 0").selectExpr("*", f"{_share('0', 'n', 'size')} AS z", f"{_share('0', 'item_n', 'size')} AS item_z") \
        .selectExpr("lang", "source", "item", f"{nothing} AS value") \
        .unionByName(grid.filter("size = 0").selectExpr("lang", "source", "item", "0L AS value"))
    counts = entries.groupBy("lang", "source", "n", "p", "z", "size").agg(F.count("*").alias("h"))
    met = salted(counts, "source", "n").join(others, ["lang", "salt"]).filter("source != item") \
        .selectExpr("*", f"{_share('0', 'item_n', 'size')} AS item_z")
    own = met.selectExpr("lang", "source", "item", f"h * {_gap('p', 'item_z')} AS value")
    theirs = met.selectExpr("lang", "item AS source", "source AS item", f"h * {_gap('item_z', 'p')} AS value")
    # the terms of both sides, corrected
    per_term = entries.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "z")).alias("x")) \
        .filter(F.size("x") > 1)
    both = per_term.select("lang", F.explode("x").alias("a"), "x").select("lang", "a", F.explode("x").alias("b")) \
        .filter("a.source != b.source").selectExpr(
            "lang", "a.source AS source", "b.source AS item",
            f"{_gap('a.p', 'b.p')} - {_gap('a.p', 'b.z')} - {_gap('a.z', 'b.p')} + {_gap('a.z', 'b.z')} AS value")
    return base.unionByName(own).unionByName(theirs).unionByName(both) \
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_scores(entries: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of the terms that a source has more of than its lang."""
    return entries.selectExpr("*", f"{_share('total', 'lang_n', 'size')} AS q").filter("p > q") \
        .selectExpr("lang", "source", "term AS item", f"{_gap('p', 'q')} AS value")


def _ranked(scores: DataFrame) -> DataFrame:
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return scores.withColumn("rank", F.row_number().over(by))


def audit(docs: DataFrame, min_df: int = 3, top_terms: int = 200, buffer_terms: int = 400_000) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has every other
    source of the lang, part ``term`` the ``top_terms`` most telling terms."""
    kept, groups = group_sums(docs, min_df, buffer_terms)
    entries = _entries(kept, groups)
    pairs = _ranked(pair_scores(entries, groups))
    terms = _ranked(term_scores(entries)).filter(F.col("rank") <= top_terms)
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*cols) \
        .unionByName(terms.withColumn("part", F.lit("term")).select(*cols))
