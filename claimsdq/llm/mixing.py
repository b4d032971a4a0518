"""Mixing sources to target weights by a multivariate-hypergeometric splitting
tree (native).

1. Sizes.  A document's size is its number of words; a source's, their sum.
2. Targets.  Sources share the total by weight; none gets more than
   ``max_repeat`` times its own size, and what is above goes to the others by
   weight until none is above (water filling, solved from the sources sorted
   by cap over weight).
3. Quotas.  A source's rounded target is so many whole epochs over all its
   documents, plus a rest that is drawn without replacement.
4. Tree.  Documents are dealt to the leaves by a hash of key and text, so each
   (source, leaf) holds an exactly known number of words.  From the root
   down, every node hands its left child a hypergeometric number of the rest's
   words and the right child what remains.  The counts in the leaves are then
   multivariate hypergeometric, exact in sum, and each leaf can be drawn alone.
5. Draw.  A leaf permutes its documents by a hash.  A document is a block of
   words; blocks are taken in that order, disjoint, until the leaf's quota is
   met, and the last one is cut to fit.

So every source's taken words equal its rounded target.  All random numbers
are hashes of (seed, source, node), so reruns and retries agree.  The number
of leaves follows the number of rows (``leaf_docs`` each), so the largest
window covers about that many rows of one source even when one source holds a
third of the corpus.  The quota tree has one row per source and node, and each
of its levels is one join.

Edge cases: null text has size 0 and takes 0; a null source is a source of its
own, last in order; repeated rows are separate blocks, and rows that share a
``doc_id`` are told apart by their text; an empty table gives an empty result; a
corpus without words takes nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsdq.llm.common import WORD, staged

#: Ratio-of-uniforms trials per node; a trial succeeds more often than not, and
#: none is made after the first success.
TRIALS = 64
#: Levels of the quota tree between two written tables.
LEVELS = 3
_LN_FACT = [math.lgamma(n + 1) for n in range(17)]


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _uniform(*parts: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + F.lit(0.5)) * F.lit(2.0 ** -53)


def _ln_fact(n: Column) -> Column:
    """ln n! for a whole-number double: a table below 17, else Stirling."""
    def series(x):
        return ((x - 0.5) * F.log(x) - x + F.lit(0.5 * math.log(2 * math.pi))
                + (F.lit(1 / 12) - (F.lit(1 / 360) - F.lit(1 / 1260) / (x * x)) / (x * x)) / x)
    table = F.array(*[F.lit(v) for v in _LN_FACT])
    return _let(n, lambda m: F.when(m < 17, F.get(table, m.cast("int"))).otherwise(_let(m + 1, series)))


def hypergeometric(good: Column, bad: Column, draws: Column, *seed: Column) -> Column:
    """How many of ``draws`` items taken without replacement are good.

    Ratio-of-uniforms rejection (Stadlober's bounds): constant work at any
    size, no sum over the support.  Works on the smaller colour and the
    smaller of drawn and left, then maps back.
    """
    def solve(p):
        total = p.good + p.bad
        small, large = F.least(p.good, p.bad), F.greatest(p.good, p.bad)
        m = F.least(p.draws, total - p.draws)
        share = small / total
        mode = F.floor((m + 1) * (small + 1) / (total + 2)).cast("double")
        centre = m * share + 0.5
        spread = F.sqrt((total - m) * p.draws * share * (1 - share) / (total - 1) + 0.5)
        shape = F.struct(
            small.alias("small"), large.alias("large"), m.alias("m"), mode.alias("mode"),
            centre.alias("centre"), (F.lit(1.7155277699214135) * spread + 0.8989161620588988).alias("width"),
            F.least(F.least(m, small) + 1, F.floor(centre + 16 * spread).cast("double")).alias("stop"))

        def weight(q, z):
            return _ln_fact(z) + _ln_fact(q.small - z) + _ln_fact(q.m - z) + _ln_fact(q.large - q.m + z)

        def draw(q):
            peak = weight(q, q.mode)

            return _let(q.withField("peak", peak), lambda q2: F.struct(
                F.coalesce(F.aggregate(F.sequence(F.lit(1), F.lit(TRIALS)), F.lit(None).cast("double"),
                                       lambda z, t: F.when(z.isNotNull(), z).otherwise(_trial(q2, t))),
                           q2.mode).alias("z"),
                q2.m.alias("m")))

        def _trial(q, t):
            def judge(x):
                w = q.centre + q.width * (_uniform(*seed, t, F.lit("y")) - 0.5) / x
                return _let(F.floor(w).cast("double"), lambda z: F.when(
                    (z >= 0) & (z < q.stop), F.when(2 * F.log(x) <= q.peak - weight(q, z), z)))
            return _let(_uniform(*seed, t, F.lit("x")), judge)

        def back(r):
            z = F.when(p.good > p.bad, r.m - r.z).otherwise(r.z)
            return F.when(r.m < p.draws, p.good - z).otherwise(z)

        free = (F.when(p.draws <= 0, F.lit(0.0)).when(p.good <= 0, F.lit(0.0))
                .when(p.bad <= 0, p.draws).when(p.draws >= total, p.good))
        return F.coalesce(free, _let(_let(shape, draw), back))

    p = F.struct(good.cast("double").alias("good"), bad.cast("double").alias("bad"),
                 draws.cast("double").alias("draws"))
    return _let(p, solve).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], max_repeat: int) -> DataFrame:
    """``source, source_size`` -> the same with ``target`` (double) and
    ``quota`` (long).  One row per source, so its windows stay small."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("__rank", F.row_number().over(by_name)) \
        .withColumn("weight", F.get(cycle, F.pmod(F.col("__rank") - 1, F.lit(len(weights))).cast("int"))) \
        .withColumn("__cap", F.col("source_size") * F.lit(max_repeat))
    every = Window.partitionBy()
    filling = Window.orderBy((F.col("__cap") / F.col("weight")), "__rank") \
        .rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("__cap").over(filling), F.lit(0).cast("long"))
    heads = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(filling), zero)
    s = s.withColumn("__level", left / heads) \
        .withColumn("__full", F.col("__level") * F.col("weight") > F.col("__cap"))
    rest = F.sum("source_size").over(every) - F.coalesce(
        F.sum(F.when(F.col("__full"), F.col("__cap"))).over(every), F.lit(0).cast("long"))
    open_weight = F.sum(F.when(F.col("__full"), zero).otherwise(F.col("weight"))).over(every)
    s = s.withColumn("__rest", rest).withColumn("__open", open_weight)
    target = F.when(F.col("__full"), F.col("__cap").cast("double")) \
        .when(F.col("__open") > 0, F.col("weight") * F.col("__rest") / F.col("__open")).otherwise(zero)
    return s.withColumn("target", target) \
        .withColumn("quota", F.least(F.round("target").cast("long"), F.col("__cap"))) \
        .select("source", "source_size", "target", "quota")


def _splits(leaves: DataFrame, depth: int) -> DataFrame:
    """The words under the left and the right child of every inner node that holds
    any: one aggregate serves all levels.  ``leaves``: _SOURCE, leaf, words."""
    level = F.explode(F.sequence(F.lit(0), F.lit(depth - 1))).alias("level")
    under = leaves.select(*_SOURCE, "leaf", "words", level).withColumns({
        "node": F.expr(f"shiftright(leaf, {depth} - level)"),
        "right_side": F.expr(f"shiftright(leaf, {depth - 1} - level) & 1") == 1})
    words = {side: F.sum(F.when(F.col("right_side") == (side == "right"), F.col("words")).otherwise(0)).alias(side)
             for side in ("left", "right")}
    return under.groupBy(*_SOURCE, "level", "node").agg(words["left"], words["right"])


def leaf_quotas(leaves: DataFrame, sources: DataFrame, depth: int, seed: int) -> DataFrame:
    """Split each source's rest over its leaves down a binary tree of hypergeometric
    draws.  ``leaves``: source, leaf, words of the leaves that have documents.

    A node is a row: every level joins its nodes to the words under their two
    children and deals the draws between them, so no value grows with the number
    of leaves.  Nodes that are dealt nothing end there.  A written table every few
    levels keeps the plan short."""
    def named(df: DataFrame) -> DataFrame:
        return df.withColumns({"__source": F.coalesce("source", F.lit("")), "__no_source": F.col("source").isNull()})

    leaves = named(leaves)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("quota") / F.col("source_size"))).otherwise(F.lit(0))
    sources = sources.withColumn("epochs", epochs.cast("long"))
    own_seed = F.when(F.col("source").isNull(), F.lit(seed).cast("long")) \
        .otherwise(F.xxhash64(F.lit(seed), F.lit("source"), F.col("source")))
    dealt = named(sources).select(*_SOURCE, own_seed.alias("seed"), F.lit(0).alias("node"),
                                  (F.col("quota") - F.col("epochs") * F.col("source_size")).alias("rest"))
    if depth:
        splits = staged(_splits(leaves, depth), "mix-splits")
    for d in range(depth):
        split = dealt.filter("rest > 0").join(splits.filter(F.col("level") == d), [*_SOURCE, "node"])
        k = hypergeometric(F.col("left"), F.col("right"), F.col("rest"), F.col("seed"), F.lit(d), F.col("node"))
        sides = _let(k, lambda k: F.array(
            F.struct((2 * F.col("node")).alias("node"), k.alias("rest")),
            F.struct((2 * F.col("node") + 1).alias("node"), (F.col("rest") - k).alias("rest"))))
        dealt = split.select(*_SOURCE, "seed", F.inline(sides))
        if d % LEVELS == LEVELS - 1:
            dealt = staged(dealt, "mix-nodes")
    drawn = dealt.select(*_SOURCE, F.col("node").alias("leaf"), "rest")
    return leaves.join(drawn, [*_SOURCE, "leaf"], "left").join(named(sources).drop("source"), _SOURCE) \
        .select("source", "source_size", "target", "epochs", "leaf", F.coalesce("rest", F.lit(0).cast("long")).alias("leaf_quota"))


def _size() -> Column:
    return F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")


def _text() -> Column:
    """Tells rows of one ``doc_id`` apart, so that they spread over the leaves."""
    return F.xxhash64("text")


#: The source as two columns without nulls, so that the join to the quotas and
#: the window over a leaf ask for one and the same partitioning.
_SOURCE = ["__source", "__no_source"]
_KEYS = [*_SOURCE, "__leaf"]


def _dealt(rows: DataFrame, depth: int, seed: int) -> DataFrame:
    leaf = F.pmod(F.xxhash64(F.lit(seed), F.lit("leaf"), "doc_id", "__text"), F.lit(1 << depth)).cast("int")
    return rows.withColumns({"__source": F.coalesce(F.col("source"), F.lit("")),
                             "__no_source": F.col("source").isNull(), "__leaf": leaf})


def _quotas(sizes: DataFrame, weights, max_repeat: int, leaf_docs: int, min_depth: int,
            seed: int) -> tuple[DataFrame, int]:
    """The written quota table (one row per source and leaf) and the tree's depth."""
    depth = max(min_depth, math.ceil(math.log2(max(1, sizes.count() / leaf_docs))))
    leaves = staged(_dealt(sizes, depth, seed).groupBy("source", F.col("__leaf").alias("leaf"))
                    .agg(F.sum("__size").alias("words")), "mix-leaves")
    per_source = leaves.groupBy("source").agg(F.sum("words").alias("source_size"))
    quotas = staged(leaf_quotas(leaves, source_targets(per_source, list(weights), max_repeat), depth, seed),
                    "mix-quotas")
    return quotas.select(F.coalesce(F.col("source"), F.lit("")).alias("__source"),
                         F.col("source").isNull().alias("__no_source"), F.col("leaf").alias("__leaf"),
                         F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
                         F.col("epochs").alias("__epochs"), F.col("leaf_quota").alias("__quota")), depth


def _drawn(rows: DataFrame, quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """Add ``__part``: the words drawn from each row (with ``__size``) in its
    leaf's permuted order."""
    permuted = Window.partitionBy(*_KEYS) \
        .orderBy(F.xxhash64(F.lit(seed), F.lit("block"), "doc_id", "__text"), "doc_id", "__text", "__size") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("__size").over(permuted) - F.col("__size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("__size"), F.col("__quota") - before))
    return _dealt(rows, depth, seed).join(quotas, _KEYS).withColumn("__part", part)


def plan_mix(docs: DataFrame, weights=(1.0, 2.0, 3.0), max_repeat: int = 3, leaf_docs: int = 50_000,
             min_depth: int = 5, seed: int = 17) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target,
    epochs, part, taken, shard``.  ``taken = epochs * size + part``."""
    rows = staged(docs.select("doc_id", "source", _size().alias("__size"), _text().alias("__text")), "mix-sizes")
    quotas, depth = _quotas(rows, weights, max_repeat, leaf_docs, min_depth, seed)
    return _drawn(rows, quotas, depth, seed).select(
        "doc_id", "source", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), F.col("__epochs").alias("epochs"), F.col("__part").alias("part"),
        (F.col("__epochs") * F.col("__size") + F.col("__part")).alias("taken"), F.col("__leaf").alias("shard"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to and with its ``n``-th word, separators kept."""
    # pieces end where a blank is followed by a word, so each piece after an
    # optional blank one at the start holds one word
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])", -1)
    lead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), F.lit(1)).otherwise(F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), (n + lead).cast("int")), "")


def mix(docs: DataFrame, weights=(1.0, 2.0, 3.0), max_repeat: int = 3, leaf_docs: int = 50_000,
        min_depth: int = 5, seed: int = 17) -> DataFrame:
    """The mixed corpus: each document once per epoch and its drawn part once
    more (cut after the last drawn word), shuffled inside each task.  Columns
    are those of ``docs``; ``n_chars``, where there is one, follows a cut.
    Texts move once, to the task of their source and leaf."""
    sizes = staged(docs.select("doc_id", "source", _size().alias("__size"), _text().alias("__text")), "mix-sizes")
    quotas, depth = _quotas(sizes, weights, max_repeat, leaf_docs, min_depth, seed)
    names = docs.columns
    own = {c: f"__own_{i}" for i, c in enumerate(names)}
    rows = docs.select("doc_id", "source", _size().alias("__size"), _text().alias("__text"),
                       *[F.col(f"`{c}`").alias(own[c]) for c in names])
    drawn = _drawn(rows, quotas, depth, seed)
    none = F.array().cast("array<bigint>")
    whole = F.when(F.col("__epochs") > 0, F.array_repeat(F.col("__size"), F.col("__epochs").cast("int")))
    copies = F.when(F.col("__size") > 0, F.concat(
        F.coalesce(whole, none), F.when(F.col("__part") > 0, F.array("__part")).otherwise(none)))
    out = drawn.select("doc_id", "__size", *own.values(), F.posexplode(copies).alias("__copy", "__words")) \
        .sortWithinPartitions(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("__copy")))
    cut = F.col("__words") < F.col("__size")

    def column(c: str) -> Column:
        col = F.col(own[c])
        if c == "text":
            col = F.when(cut, first_words(col, F.col("__words"))).otherwise(col)
        elif c == "n_chars":
            new = F.length(first_words(F.col(own["text"]), F.col("__words")))
            col = F.when(cut, new.cast(docs.schema[c].dataType)).otherwise(col)
        return col.alias(c)

    return out.select(*[column(c) for c in names])
