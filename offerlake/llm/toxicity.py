"""Operator 9, toxicity: a factorization machine over hashed terms.

A text's terms are its distinct lower-cased words and their first four and
first five characters, hashed into a fixed number of slots.  The score is
``sigmoid(w0 + sum of w[i] + sum over pairs of <v[i], v[j]>)``: besides a
weight per term the machine learns which pairs of terms raise or lower the
score together, through k-dimensional factors.  The pair sum takes O(n k) by
``((sum v)^2 - sum v^2) / 2``.

It is fitted by AdaGrad in numpy on at most ``per_class`` labelled rows of
each class, the ones with the smallest hash of their id (a bounded sample;
labels are the only use made of the label table).  Scoring covers every row.

Defined cases: NULL, empty and blank texts have no terms and score
``sigmoid(w0)``, the share of toxic labels; a doc_id that is labelled more than once counts as toxic if
any label says so; NULL labels are left out; without labels of both classes
every row scores the share of toxic labels (0 without labels); a NULL id
counts as held out; repeated rows score alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from offerlake.llm.common import read, sliced

SLOT_BITS = 18
FACTORS = 6
#: Labelled rows of each class that a fit may use.
PER_CLASS = 4_000
#: Words whose slots a worker remembers.
REMEMBERED = 100_000

_memory: dict[bytes, tuple[int, ...]] = {}


def slots_of_word(word: bytes) -> tuple[int, ...]:
    """Slots of one lower-cased word: itself and its beginnings."""
    w = word.decode(errors="replace").lower().strip(".,;:!?\"'()[]|")
    mask = (1 << SLOT_BITS) - 1
    terms = {"w" + w, "4" + w[:4], "5" + w[:5]} if w else ()
    return tuple(sorted({zlib.crc32(t.encode()) & mask for t in terms}))


def slots(text: str | None) -> np.ndarray:
    """Distinct slots of a text, sorted."""
    if not text:
        return np.empty(0, np.int32)
    out: set[int] = set()
    for w in set(text.encode().lower().split()):
        s = _memory.get(w)
        if s is None:
            s = slots_of_word(w)
            if len(w) <= 64:
                if len(_memory) >= REMEMBERED:
                    _memory.clear()
                _memory[w] = s
        out.update(s)
    a = np.fromiter(out, np.int32, len(out))
    a.sort()
    return a


class Machine(NamedTuple):
    """Bias, weights [slots] and factors [slots, k]."""

    w0: float
    w: np.ndarray
    v: np.ndarray

    def raw(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid; row i holds flat[starts[i]:starts[i + 1]]."""
        n = len(starts) - 1
        out = np.full(n, self.w0)
        full = np.flatnonzero(np.diff(starts))
        if len(full):
            at = starts[:-1][full]
            v = self.v[flat]
            s = np.add.reduceat(v, at, axis=0, dtype=np.float64)
            q = np.add.reduceat(np.square(v, dtype=np.float64).sum(axis=1), at)
            out[full] += np.add.reduceat(self.w[flat], at, dtype=np.float64) + 0.5 * ((s * s).sum(axis=1) - q)
        return out

    def score(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(flat, starts))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def fit(
    rows: list[np.ndarray],
    labels: np.ndarray,
    prior: float | None = None,
    factors: int = FACTORS,
    epochs: int = 12,
    least_steps: int = 1_500,
    rate: float = 0.05,
    decay: float = 1e-3,
    batch: int = 64,
    seed: int = 7,
) -> Machine:
    """Logistic loss, AdaGrad, L2 on what a batch touches; both classes weigh alike.

    The bias stays at ``prior``, the share of toxic labels (the sample's own if
    None): a text without known terms is scored by it, however the classes
    were sampled.  A small sample gets more epochs, until ``least_steps`` batches were seen.
    """
    n_slots = 1 << SLOT_BITS
    y = np.asarray(labels, np.float64)
    if len(y) == 0 or y.min() == y.max():
        p = float(y.mean()) if len(y) else 0.0
        w0 = float(np.log((p + 1e-9) / (1 - p + 1e-9)))
        return Machine(w0, np.zeros(n_slots), np.zeros((n_slots, factors)))
    rng = np.random.default_rng(seed)
    known = np.flatnonzero(informative(rows, y, n_slots))
    place = np.full(n_slots, -1)
    place[known] = np.arange(len(known))
    rows = [p[p >= 0] for p in (place[r] for r in rows)]
    w, v = np.zeros(len(known)), rng.normal(0, 0.01, (len(known), factors))
    gw, gv = np.full(len(known), 1e-6), np.full((len(known), factors), 1e-6)
    share = min(max(float(y.mean()) if prior is None else prior, 1e-6), 1 - 1e-6)
    w0 = float(np.log(share / (1 - share)))
    cost = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    cost = cost / cost.mean()
    for _ in range(max(epochs, -(-least_steps * batch // len(rows)))):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            pick = order[lo : lo + batch]
            sizes = np.array([len(rows[i]) for i in pick])
            flat = np.concatenate([rows[i] for i in pick])
            starts = np.concatenate([[0], np.cumsum(sizes)])
            m = Machine(w0, w, v)
            d = (sigmoid(m.raw(flat, starts)) - y[pick]) * cost[pick] / len(pick)
            if not len(flat):
                continue
            row = np.repeat(np.arange(len(pick)), sizes)
            touched, inv = np.unique(flat, return_inverse=True)
            dr = d[row]
            grad = np.bincount(inv, dr, len(touched)) + decay * w[touched]
            gw[touched] += grad * grad
            w[touched] -= rate * grad / np.sqrt(gw[touched])
            vf = v[flat]
            sums = np.zeros((len(pick), factors))
            full = sizes > 0
            sums[full] = np.add.reduceat(vf, starts[:-1][full], axis=0)
            each = dr[:, None] * (sums[row] - vf)
            grad2 = np.stack([np.bincount(inv, each[:, f], len(touched)) for f in range(factors)], axis=1)
            grad2 += decay * v[touched]
            gv[touched] += grad2 * grad2
            v[touched] -= 0.2 * rate * grad2 / np.sqrt(gv[touched])
    whole_w, whole_v = np.zeros(n_slots), np.zeros((n_slots, factors))
    whole_w[known], whole_v[known] = w, v
    return Machine(w0, whole_w, whole_v)


def informative(rows: list[np.ndarray], y: np.ndarray, n_slots: int) -> np.ndarray:
    """Slots that may tell the classes apart, alone or in a pair.

    Either the slot's counts in the classes differ (chi-square of the 2x2
    table above 20) or it is in a tenth of the rows, where pairs with it can
    still carry a signal.  Rare slots without a difference only add noise.
    """
    row_y = np.repeat(y, [len(r) for r in rows])
    flat = np.concatenate(rows)
    n, pos = len(rows), y.sum()
    seen = np.bincount(flat, minlength=n_slots).astype(np.float64)
    hits = np.bincount(flat, row_y, minlength=n_slots)
    expected = seen * pos / n
    spread = expected * (1 - pos / n) * (1 - seen / n)
    chi2 = np.divide((hits - expected) ** 2, spread, out=np.zeros(n_slots), where=spread > 0)
    return ((chi2 > 20) & (seen >= 3)) | (seen >= 0.1 * n)


def held_out(id_col: Column) -> Column:
    """Rows that no fit may see: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learnable(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """One label for each id that a fit may see: (id, __y)."""
    return (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(id_col)
        .agg(F.max(F.col(label_col)).cast("int").alias("__y"))
    )


def sample(labels: DataFrame, per_class: int, id_col: str, label_col: str) -> DataFrame:
    """At most ``per_class`` ids of each class, by the smallest hash: (id, __y)."""
    one = learnable(labels, id_col, label_col)
    order = [F.xxhash64(id_col), F.col(id_col)]
    return one.filter("__y = 0").orderBy(*order).limit(per_class).unionAll(
        one.filter("__y = 1").orderBy(*order).limit(per_class)
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = PER_CLASS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Machine:
    """Fit on the bounded sample; its slots, not its texts, come to the driver."""
    ids = sample(labels, per_class, id_col, label_col).withColumnRenamed(id_col, "__id")
    # At most 2 * per_class rows of two numbers: a proven bound.
    picked = docs.select(id_col, text_col).join(F.broadcast(ids), F.col(id_col) == F.col("__id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 512):
            got = [slots(t).tobytes() for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.binary())], names=["i", "y", "s"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = picked.select("__id", "__y", text_col).mapInArrow(run, f"i {kind}, y int, s binary").toPandas()
    # Arrival order must not matter.
    rows = rows.sort_values(["i", "s"]).drop_duplicates(["i", "s"])
    prior = learnable(labels, id_col, label_col).agg(F.avg("__y")).first()[0]
    return fit([np.frombuffer(s, np.int32) for s in rows["s"]], rows["y"].to_numpy(), prior)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and score of every row.  The machine has a fixed size whatever the corpus."""
    shipped = docs.sparkSession.sparkContext.broadcast(
        (machine.w0, machine.w.astype(np.float32), machine.v.astype(np.float32))
    )
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Machine(*shipped.value)
        for b in sliced(batches, 512):
            rows = [slots(t) for t in b.column(1).to_pylist()]
            starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
            flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(m.score(flat, starts), pa.float64())],
                schema=pa.schema([("id", to_arrow_type(kind)), ("score", pa.float64())]),
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, score double")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that are not held out."""
    docs = read(spark, sf_dir, "documents")
    machine = train(docs, read(spark, sf_dir, "labels"))
    s = score(docs, machine)
    return s.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
