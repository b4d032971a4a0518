"""SimHash near-dedup with pigeonring filtering.

Fingerprint: A-Z lower-cased, words split at ASCII blanks, k-word shingles
joined by one space (repeats included; fewer words than k: the whole
sequence), XXH64 with seed 42 of each; a bit is 1 if it is set in more than
half of the shingles' hashes.  A text without words has fingerprint 0.

Links: fingerprints at ``max_distance`` or fewer differing bits.  Documents
are first grouped by fingerprint, so copies never meet one another.  The 64
bits form a ring of ``segments`` segments.  With ``max_distance`` differing
bits at most, at least ``segments - max_distance`` segments agree, so each
fingerprint is filed under every choice of that many segments, and only
fingerprints under one key are compared.  A pair must then pass the pigeonring
test: from some segment on, every chain of 1, 2, ... consecutive segments
keeps its cumulative difference within its proportional share of the budget,
``length * max_distance / segments``.  Only survivors get the full Hamming
check.

A key shared by more than ``bucket_limit`` distinct fingerprints (dense
near-copy clusters) would cost the square of its size, so its fingerprints are
linked another exact way: two fingerprints are within d bits just when some
64-bit word lies within floor(d/2) bits of one and ceil(d/2) of the other.
Each is listed under all words within ceil(d/2) flips, and every word's
listing forms a star around the smallest fingerprint within floor(d/2) of it.
That is linear in the cluster and loses no link.

Components come from alternating stars over fingerprints.

Edge cases: null text counts as empty (fingerprint 0, linked like any other);
repeated rows and copies share a fingerprint; a null ``doc_id`` never becomes
a component id while a number is there; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsdq.llm.common import lookup_hot_safe, map_batches, staged
from claimsdq.llm.components import connected_components

BITS = 64
SEED = 42
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLOCK = 1 << 14


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit SimHash of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    digest, seed = xxhash.xxh64_intdigest, SEED
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = len(words) - shingle + 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, _BLOCK):       # bounded memory for very long texts
        s, e = starts[at:at + _BLOCK].tolist(), ends[at + shingle - 1:at + _BLOCK + shingle - 1].tolist()
        h = np.array([digest(joined[a:b], seed) for a, b in zip(s[:count - at], e)], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, fp bigint")


def _bit_mask(segment: int, segments: int) -> int:
    lo, hi = BITS * segment // segments, BITS * (segment + 1) // segments
    m = ((1 << (hi - lo)) - 1) << lo
    return m - (1 << 64) if m >> 63 else m


def pigeonring(diff: Column, segments: int, max_distance: int) -> Column:
    """True if some start on the ring keeps every prefix of consecutive
    segments within its share of the budget.  ``diff``: XOR of two words."""
    d = [F.bit_count(diff.bitwiseAND(F.lit(_bit_mask(i, segments)))) for i in range(segments)]
    starts = []
    for i in range(segments):
        total, viable = F.lit(0), F.lit(True)
        for length in range(1, segments):
            total = total + d[(i + length - 1) % segments]
            viable = viable & (total <= F.lit(length * max_distance // segments))
        starts.append(viable)
    ring = starts[0]
    for s in starts[1:]:
        ring = ring | s
    return ring


def _bucket_keys(fps: DataFrame, segments: int, max_distance: int) -> DataFrame:
    """(key, fp): one row per choice of segments that must agree."""
    keys = []
    for n, chosen in enumerate(combinations(range(segments), segments - max_distance)):
        mask = sum(_bit_mask(s, segments) for s in chosen)
        mask = (mask + (1 << 63)) % (1 << 64) - (1 << 63)
        keys.append(F.struct(F.lit(n).alias("n"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bits")))
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp").select("key.n", "key.bits", "fp")


def _flips(radius: int) -> list[tuple[int, int]]:
    """(number of flips, XOR mask) of every word within ``radius`` bits of 0."""
    out = []
    for r in range(radius + 1):
        for chosen in combinations(range(BITS), r):
            m = sum(1 << b for b in chosen)
            out.append((r, m - (1 << 64) if m >> 63 else m))
    return out


def links(fps: DataFrame, max_distance: int = 2, segments: int = 4, bucket_limit: int = 64) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of
    all pairs within ``max_distance`` bits.  ``fps``: distinct, a stored table."""
    if not 0 <= max_distance < segments <= BITS:
        raise ValueError("max_distance must be below segments")
    if max_distance == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter("false")
    keys = _bucket_keys(fps, segments, max_distance)
    sizes = staged(keys.groupBy("n", "bits").agg(F.count("*").alias("size")).filter("size > 1"), "simhash-buckets")
    light = sizes.filter(F.col("size") <= bucket_limit).drop("size")
    left = keys.join(light, ["n", "bits"]).withColumnRenamed("fp", "a")
    right = keys.withColumnRenamed("fp", "b")
    diff = F.col("a").bitwiseXOR(F.col("b"))
    pairs = left.join(right, ["n", "bits"]).filter(F.col("a") < F.col("b")) \
        .filter(pigeonring(diff, segments, max_distance)) \
        .filter(F.bit_count(diff) <= max_distance).select("a", "b")
    heavy = sizes.filter(F.col("size") > bucket_limit).drop("size")
    dense = keys.join(heavy, ["n", "bits"]).select("fp").distinct()
    near, far = max_distance // 2, (max_distance + 1) // 2
    flips = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(m).cast("long").alias("m")) for r, m in _flips(far)])
    listed = dense.select("fp", F.explode(flips).alias("f")) \
        .select("fp", "f.r", F.col("fp").bitwiseXOR(F.col("f.m")).alias("word"))
    centres = listed.groupBy("word").agg(F.count("*").alias("n"),
                                         F.min(F.when(F.col("r") <= near, F.col("fp"))).alias("a")) \
        .filter("n > 1 AND a IS NOT NULL").select("word", "a")
    stars = listed.join(centres, "word").filter("fp != a").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2, segments: int = 4,
                    bucket_limit: int = 64) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: the fingerprint as 16
    hex digits and the smallest ``doc_id`` reachable over links."""
    rows = staged(fingerprints(docs, shingle), "simhash-rows")
    fps = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "simhash-fps")
    roots = staged(connected_components(links(fps.select("fp"), max_distance, segments, bucket_limit)),
                   "simhash-roots")
    placed = fps.join(roots, fps["fp"] == roots["node"], "left") \
        .select("fp", "first_id", "n", F.coalesce("root", "fp").alias("root"))
    component = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = staged(placed.join(component, "root").select("fp", "n", "component_id"), "simhash-classes")
    return lookup_hot_safe(rows, by_fp, ["fp"], "n", rows.count()) \
        .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the
    smallest ``doc_id``; of rows repeating that ``doc_id``, one."""
    report = staged(near_duplicates(docs, **params), "simhash-report")
    mine = F.col("doc_id").eqNullSafe(F.col("component_id"))
    gone = report.filter(~mine).select(F.col("doc_id").alias("k_id")).distinct()
    stays = report.filter(mine).select(F.col("doc_id").alias("s_id")).groupBy("s_id").agg(F.count("*").alias("n"))
    # a doc_id may repeat with texts of different components: it stays if one of its rows does
    gone = staged(gone.join(stays, F.col("k_id").eqNullSafe(F.col("s_id")), "left_anti"), "simhash-gone")
    kept = docs.join(gone, docs["doc_id"].eqNullSafe(gone["k_id"]), "left_anti")
    repeated = staged(stays.filter("n > 1").select("s_id"), "simhash-repeated")
    if repeated.isEmpty():
        return kept
    same = kept["doc_id"].eqNullSafe(repeated["s_id"])
    once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id"])
    return kept.join(repeated, same, "left_anti").unionByName(once)
