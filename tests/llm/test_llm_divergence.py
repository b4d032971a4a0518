"""The divergence audit against plain Python and against Spark ML's own classes."""

import random
import re
import string
from collections import Counter

from llm_cases import documents, empty, frame
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from claimsdq.llm import divergence as D

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def make(seed, n=60):
    r = random.Random(seed)
    rows = []
    for row in documents(seed, n, 400):
        rows.append((row[0], row[1], r.choice(["en", "en", "de", None, "xx"]), *row[3:]))
    rows.append((900, "only here and nowhere", "zz", "lone", 3, *["clash"] * 8))   # no kept terms
    rows.append((901, None, "zz", "other", 3, *["clash"] * 8))
    return rows + rows[:3]


def plain(rows, min_df=3, top=200):
    docs = [(lang or "", source or "", Counter(terms_of(text))) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for *_, c in mine for t in c)
        kept = [t for t in df if df[t] >= min_df]
        groups = {s: Counter() for _, s, _ in mine}
        for _, s, c in mine:
            groups[s].update(c)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}
        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            parts = {"pair": [(o, sum((p[s][t] - p[o][t])**2 // p[o][t] for t in kept)) for o in groups if o != s],
                     "term": [(t, (p[s][t] - q[t])**2 // q[t]) for t in kept if groups[s][t] and p[s][t] > q[t]]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, n) for n, (item, value) in enumerate(items, 1) if part == "pair" or n <= top]
    return sorted(out)


def test_matches_plain_sums(spark):
    for seed, kw in ((1, {}), (2, dict(buffer_terms=20)), (3, dict(top_terms=4, min_df=2))):
        rows = make(seed)
        got = sorted(map(tuple, D.audit(frame(spark, rows), **kw).collect()))
        assert got == plain(rows, kw.get("min_df", 3), kw.get("top_terms", 200))


def test_vocabulary_vectors_and_sums_are_those_of_spark_ml(spark):
    rows = make(5)
    docs = frame(spark, rows).withColumns({"lang": F.coalesce("lang", F.lit("")), "source": F.coalesce("source", F.lit(""))})
    kept, _ = D.group_sums(docs)
    kept = kept.collect()
    vectors = D.document_vectors(docs).collect()
    for lang in ("en", "de", ""):
        own = docs.filter(F.col("lang") == lang).withColumn("terms", F.regexp_extract_all(
            F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase),
            F.lit(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"), 0))
        model = CountVectorizer(inputCol="terms", outputCol="v", minDF=3, vocabSize=2**31 - 1).fit(own)
        vocabulary = model.vocabulary
        assert set(vocabulary) == {r.term for r in kept if r.lang == lang}
        theirs = Counter((r.doc_id, r.source, tuple(sorted((vocabulary[i], int(n)) for i, n in zip(r.v.indices, r.v.values))))
                         for r in model.transform(own).select("doc_id", "source", "v").collect())
        mine = Counter((r.doc_id, r.source, tuple((t, n) for t, n in zip(r.terms, r.counts) if t in set(vocabulary)))
                       for r in vectors if r.lang == lang)
        mine = Counter({(d, s, tuple(sorted(v))): n for (d, s, v), n in mine.items()})
        assert mine == theirs
        sums = model.transform(own).groupBy("source").agg(Summarizer.sum(F.col("v")).alias("s")).collect()
        want = {(r.source, t): round(x) for r in sums for t, x in zip(vocabulary, r.s.toArray()) if x}
        assert {(x.source, r.term): x.n for r in kept if r.lang == lang for x in r.sums} == want


def test_one_group_holding_most_and_huge_counts(spark):
    rows = [(i, "same words again and again", "en", "hot", 1, *["clash"] * 8) for i in range(300)]
    rows += [(500 + i, f"same other words w{i % 3}", "en", f"s{i % 4}", 1, *["clash"] * 8) for i in range(12)]
    assert sorted(map(tuple, D.audit(frame(spark, rows, 9)).collect())) == plain(rows)
    # counts beyond 2**31 and products beyond 2**63
    kept = spark.createDataFrame([("en", "a", 3, 7 * 10**12, [("x", 7 * 10**12 - 1), ("y", 1)]), ("en", "b", 3, 5, [("y", 5)])],
                                 "lang string, term string, docs long, total long, sums array<struct<source:string,n:long>>")
    groups = spark.createDataFrame([("en", "x", 7 * 10**12 - 1, 1, 7 * 10**12 + 5, 2), ("en", "y", 6, 2, 7 * 10**12 + 5, 2)],
                                   "lang string, source string, n long, terms long, lang_n long, size long")
    entries = D._entries(kept, groups)
    counts = {"x": {"a": 7 * 10**12 - 1, "b": 0}, "y": {"a": 1, "b": 5}}
    p = {s: {t: 1 + 10**9 * (n + 1) // (sum(c.values()) + 2) for t, n in c.items()} for s, c in counts.items()}
    want = {(s, o): sum((p[s][t] - p[o][t])**2 // p[o][t] for t in "ab") for s, o in (("x", "y"), ("y", "x"))}
    assert {(r.source, r.item): r.value for r in D.pair_scores(entries, groups).collect()} == want


def test_terms_keep_what_stands_above_ascii():
    assert D.vector("Ünder ÉÉ it's x_y 3rd Ab c\x7f".encode()) == Counter(t.encode() for t in terms_of("Ünder ÉÉ it's x_y 3rd Ab c\x7f"))


def test_empty_tables(spark):
    assert D.audit(empty(spark)).count() == 0
    rows = [(1, None, None, None, 0, *["clash"] * 8), (2, "", "", "b", 0, *["clash"] * 8)]
    assert sorted(map(tuple, D.audit(frame(spark, rows)).collect())) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]
