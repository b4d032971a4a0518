"""Quality classifier: a factorisation machine over hashed words, structure and
metadata.

A text's features are sparse and fall into three fields:

* *words*: lower-cased words and word shapes (``Aa.``, ``a###``), hashed into
  ``BUCKETS`` numbers, each field scaled to length one;
* *structure*: shares of upper case, digits, marks, distinct words, lines and
  word pairs, the commonest word's share, lengths; each cut into steps, one
  number per (figure, step);
* *metadata*: ``n_chars`` in steps of a factor 2, or "unknown".

Language, source, identifiers and labels are no features.  The score of x is
``sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)`` with ``FACTORS``
numbers a feature; the pairs are summed in linear time by the identity
``2 sum_{i<j} = |sum v_i x_i|^2 - sum |v_i x_i|^2``.

The machine is trained on the driver (AdaGrad on the logistic loss) from at most
``sample_rows`` labelled documents, those with the smallest hash of their
``doc_id`` among the labelled ones that ``may_learn`` allows; tasks send
features, never texts.  Scoring covers whole texts of all rows in one pass
without a shuffle.

Edge cases: null text counts as empty and is scored like any; a null or missing
``n_chars`` is "unknown"; a null ``doc_id`` is hashed as the empty text and has
no label; several labels of one id count as their largest; repeated rows get
equal scores; an empty table gives an empty result, and without labels every
score is 0.5; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsdq.llm.common import map_batches

WORDS, SHAPES, STRUCTURE, META = 1 << 15, 1 << 10, 1 << 9, 1 << 6
BUCKETS = WORDS + SHAPES + STRUCTURE + META
FACTORS = 8
# Letters to a or A, digits to 9; bytes of characters above ASCII count as a.
_SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 57 if 48 <= b <= 57 else b
               for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


@lru_cache(maxsize=1 << 16)
def _shape_bucket(shape: bytes) -> int:
    return WORDS + crc32(_RUN.sub(rb"\1\1", shape)[:12]) % SHAPES


def _steps(share: float) -> int:
    """0 to 21: finer near 0 and 1."""
    if share <= 0:
        return 0
    return 1 + int(20 * share) if share < 1 else 21


def _doublings(n: int) -> int:
    return min(21, int(n).bit_length())


def _field(buckets: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal buckets added up, scaled to length one."""
    own, where = np.unique(buckets, return_inverse=True)
    x = np.bincount(where, weights, len(own))
    return own, x / max(1e-9, float(np.sqrt((x * x).sum())))


def features(data: bytes, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, values) of one text in UTF-8."""
    words, lines = data.lower().split(), data.split(b"\n")
    shaped = data.translate(_SHAPE)
    shapes = Counter(shaped.split())
    counts = Counter(words)
    n, letters = len(words), max(1, shaped.count(b"a") + shaped.count(b"A"))
    size = max(1, len(data))
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in lines if x.strip()]
    marked = sum(c for s, c in shapes.items() if s.strip(b"aA9") not in (b"", b".", b",", b"!", b"?"))
    figures = (
        _steps(shaped.count(b"A") / letters), _steps(shaped.count(b"9") / size), _steps(marked / max(1, n)),
        _steps(len(counts) / max(1, n)), _steps(pairs / max(1, n - 1)),
        _steps(max(counts.values(), default=0) / max(1, n)), _steps(len(set(lines)) / max(1, len(lines))),
        _doublings(n), _doublings(len(lines)), min(21, round(size / max(1, n))),
        _steps(1 - (letters + shaped.count(b"9") + n) / size), _steps(data.count(b".") / max(1, n)))
    parts = []
    if n:
        parts.append(_field(np.fromiter((crc32(w) % WORDS for w in counts), np.int64, len(counts)),
                            np.log1p(np.fromiter(counts.values(), float, len(counts)))))
        parts.append(_field(np.fromiter(map(_shape_bucket, shapes), np.int64, len(shapes)),
                            np.sqrt(np.fromiter(shapes.values(), float, len(shapes)))))
    at = WORDS + SHAPES
    parts.append((at + 22 * np.arange(len(figures)) + np.array(figures), np.full(len(figures), len(figures) ** -0.5)))
    meta = 0 if n_chars is None else 1 + min(40, max(0, int(n_chars)).bit_length())
    parts.append((np.array([at + STRUCTURE + meta]), np.array([0.5])))
    return np.concatenate([p[0] for p in parts]).astype(np.int32), np.concatenate([p[1] for p in parts]).astype(np.float32)


class Machine:
    """A factorisation machine with logistic loss."""

    def __init__(self, seed: int = 3):
        self.bias = 0.0
        self.linear = np.zeros(BUCKETS, np.float32)
        self.factors = (np.random.default_rng(seed).standard_normal((BUCKETS, FACTORS)) * 0.05).astype(np.float32)

    def _sums(self, at: np.ndarray, x: np.ndarray, start: np.ndarray):
        """Linear term, and the factors' sums and sums of squares, of each row
        (rows begin at ``start``; none is empty)."""
        v = self.factors[at] * x[:, None]
        return np.add.reduceat(self.linear[at] * x, start), np.add.reduceat(v, start), np.add.reduceat((v * v).sum(1), start), v

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        at, x, start = _stacked(rows)
        line, total, squares, _ = self._sums(at, x, start)
        return _sigmoid(self.bias + line + 0.5 * ((total * total).sum(1) - squares))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 6, batch: int = 64,
            rate: float = 0.1, decay: float = 1e-4, seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        p = np.clip(labels.mean(), 0.01, 0.99)
        self.bias = float(np.log(p / (1 - p)))
        seen_b, seen_w, seen_v = 1e-6, np.full(BUCKETS, 1e-6, np.float32), np.full((BUCKETS, FACTORS), 1e-6, np.float32)
        for _ in range(epochs):
            order = r.permutation(len(rows))
            for begin in range(0, len(rows), batch):
                some = order[begin:begin + batch]
                at, x, start = _stacked([rows[n] for n in some])
                line, total, squares, v = self._sums(at, x, start)
                error = (_sigmoid(self.bias + line + 0.5 * ((total * total).sum(1) - squares)) - labels[some]) / len(some)
                row = np.repeat(np.arange(len(some)), np.diff(np.append(start, len(at))))
                own, where = np.unique(at, return_inverse=True)
                g = (error[row] * x)[:, None]
                dw = np.bincount(where, g[:, 0], len(own)) + decay * self.linear[own]
                dv = np.zeros((len(own), FACTORS), np.float32)
                np.add.at(dv, where, g * (total[row] - v))
                dv += decay * self.factors[own]
                db = float(error.sum())
                seen_b += db * db
                seen_w[own] += dw * dw
                seen_v[own] += dv * dv
                self.bias -= rate * db / seen_b ** 0.5
                self.linear[own] -= rate * dw / np.sqrt(seen_w[own])
                self.factors[own] -= rate * dv / np.sqrt(seen_v[own])


def _stacked(rows):
    sizes = [len(at) for at, _ in rows]
    return np.concatenate([at for at, _ in rows]), np.concatenate([x for _, x in rows]), np.cumsum([0, *sizes[:-1]])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


# ------------------------------------------------------------------------- jobs

def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _input(docs: DataFrame) -> list[Column]:
    n_chars = F.col("n_chars").try_cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return [F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"), n_chars.alias("n_chars")]


def sample(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, sample_rows: int):
    """(features, labels) of the bounded sample, in an order of its own content."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & may_learn).groupBy("doc_id") \
        .agg(F.max(label).cast("int").alias("label"))
    few = known.orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(sample_rows) \
        .select(F.col("doc_id").alias("known_id"), "label")
    own = docs.select("doc_id", *_input(docs))
    rows = own.join(F.broadcast(few), own["doc_id"] == few["known_id"]).select("data", "n_chars", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [features(t.as_py(), n) for t, n in zip(b.column(0), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([at.tobytes() for at, _ in got], pa.binary()), pa.array([x.tobytes() for _, x in got], pa.binary()),
                 b.column(2)], names=["at", "x", "label"])
    # a doc_id that many rows share must not make the sample larger
    got = sorted((bytes(r["at"]), bytes(r["x"]), r["label"]) for r in
                 map_batches(rows, run, "at binary, x binary, label int").limit(sample_rows).collect())
    return [(np.frombuffer(at, np.int32), np.frombuffer(x, np.float32)) for at, x, _ in got], \
        np.array([y for *_, y in got], np.float32)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", may_learn: Column | None = None,
          sample_rows: int = 6000, epochs: int = 6) -> Machine:
    """The machine fitted to at most ``sample_rows`` labelled documents."""
    rows, y = sample(docs, labels, label, ~held_out(F.col("doc_id")) if may_learn is None else may_learn, sample_rows)
    machine = Machine()
    if rows:
        machine.fit(rows, y, epochs)
    else:
        machine.factors[:] = 0
    return machine


def classify(docs: DataFrame, machine: Machine, least: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                b = whole.slice(start, 256)
                score = machine.score([features(t.as_py(), n) for t, n in zip(b.column(2), b.column(3).to_pylist())])
                score = score.astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(score), pa.array((score >= least).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])
    return map_batches(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *_input(docs)), run,
                       f"doc_id {kind}, held_out boolean, score double, predicted int")
