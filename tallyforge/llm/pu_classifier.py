"""A quality classifier learned from trusted positives and unlabelled text.

Documents become a few dozen measurements of form. A logistic model minimises the non-negative unbiased risk

    prior * E_positive[loss(+)] + max(0, E_unlabelled[loss(-)] - prior * E_positive[loss(-)])

with the class prior estimated from the labelled rows. It is minimised in two steps. For the logistic loss the risk without
the bound is convex, and Newton steps under a small ridge give a direction. Along it, the place of the boundary is the
minimum of the bounded risk itself, with the loss that counts errors: from histograms of the projections of all positives and
all unlabelled documents. Every sum of a step runs over all rows, as one small row per task.

Labels, languages, sources and ids are no inputs. Edge cases: null and empty texts measure zero and get a score like any
other; repeated rows count as often as they occur; a label that is null or repeated for an id counts as unlabelled or
once, as the largest; without any positive row every score is the prior (one half if there are no labels either); other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import SPACE, ship, slices, utf8, written

MEASURES = (
    "bias", "log_words", "word_length", "distinct_words", "repeated_windows", "repeated_lines", "line_words", "top_word",
    "lower", "upper", "digits", "beyond_ascii", "commas", "stops", "exclaims", "pipes", "hashes", "stars", "dollars",
    "percents", "ampersands", "brackets", "quotes", "other_marks", "symbol_words", "capital_words", "bare_words",
)
#: Ridge on all weights but the bias, a share of the unlabelled mass.
RIDGE = 1e-4
STEPS = 25
#: The ridge of a fit to one positive; it falls with their number.
PULL = 3.0
#: Deviations that a measurement counts at most.
MOST = 3.0
#: Projections are counted in cells from -REACH to REACH.
REACH, CELLS = 20.0, 4000

_SPACE = frozenset(SPACE.encode())
_GROUPS = {
    "lower": range(97, 123), "upper": range(65, 91), "digits": range(48, 58), "beyond_ascii": range(128, 256),
    "commas": b",", "stops": b".", "exclaims": b"!?", "pipes": b"|", "hashes": b"#", "stars": b"*", "dollars": b"$",
    "percents": b"%", "ampersands": b"&", "brackets": b"<>[]{}()", "quotes": b"\"'`",
}
_TABLE = np.zeros((256, len(_GROUPS) + 1))
for _at, _bytes in enumerate(_GROUPS.values()):
    _TABLE[list(_bytes), _at] = 1
_TABLE[[b for b in range(33, 127) if not _TABLE[b, :-1].any()], -1] = 1
_SYMBOLS = b"#*$%&|<>!"


def measured(text: str) -> list[float]:
    """The measurements of one text, most of them square roots of shares: what is rare still counts."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return [1.0] + [0.0] * (len(MEASURES) - 1)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    visible = max(1, int(counts.sum()) - sum(int(counts[b]) for b in _SPACE))
    shares = np.sqrt(counts @ _TABLE / visible)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = sum(c for c in windows.values() if c > 1) / max(1, n - 2)
    lines = [line for line in data.split(b"\n") if line.strip()]
    seen = Counter(words)
    symbols = sum(c for w, c in seen.items() if w[-1] in _SYMBOLS)
    capitals = sum(c for w, c in seen.items() if w.isupper() and len(w) > 1)
    bare = sum(c for w, c in seen.items() if not w[0] in b"|" and w.isalpha())
    return [
        1.0, math.log1p(n) / 5, visible / n / 10, len(seen) / n, math.sqrt(repeated),
        math.sqrt(1 - len(set(lines)) / len(lines)), math.log1p(n / len(lines)) / 5, math.sqrt(seen.most_common(1)[0][1] / n),
        *shares.tolist(), math.sqrt(symbols / n), math.sqrt(capitals / n), math.sqrt(bare / n),
    ]


def measurements(docs: DataFrame) -> DataFrame:
    """doc_id and the array ``x``, written once: every later pass reads these instead of the texts."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [measured(text or "") for text in batch.column("text").to_pylist()]
            flat = pa.array(np.array(rows, np.float64).ravel())
            bounds = pa.array(np.arange(len(rows) + 1) * len(MEASURES), pa.int32())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "x": pa.ListArray.from_arrays(bounds, flat)})

    id_type = dict(docs.dtypes)["doc_id"]
    return written(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, x array<double>"), "measurements")


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a missing id counts as an empty text."""
    return F.crc32(utf8(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))) % folds


def standard(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Measurements in deviations from the corpus mean; no single one can outweigh the rest."""
    return np.clip((x - centre) / scale, -MOST, MOST)


@dataclass
class Model:
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    prior: float

    def score(self, x: str = "x") -> Column:
        """Probability of label 1, as an expression over the measurements."""
        total = F.lit(float(self.weights[0]))
        for at in range(1, len(self.weights)):
            z = (F.get(F.col(x), F.lit(at)) - F.lit(float(self.centre[at]))) / F.lit(float(self.scale[at]))
            total = total + F.lit(float(self.weights[at])) * F.greatest(F.lit(-MOST), F.least(F.lit(MOST), z))
        return 1 / (1 + F.exp(-total))


def _sums(rows: DataFrame, summarise, size: int) -> np.ndarray:
    """The sum over all rows (x, role) of what ``summarise`` makes of a batch: ``size`` numbers per task reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            total += summarise(x, batch.column("role").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(size), pa.int32()), "value": pa.array(total)})

    summed = rows.select("x", "role").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(size)
    for row in summed.collect():  # ``size`` rows
        out[row["at"]] = row["value"]
    return out


def fit(rows: DataFrame, prior: float, steps: int = STEPS, ridge: float = RIDGE) -> Model:
    """``rows`` has x and role, 1 for trusted positives; all rows together are the unlabelled corpus.

    That the positives are also part of the corpus keeps the difference of the two means steady when there are few.
    """
    d = len(MEASURES)

    def moments(x, role):
        return np.concatenate([[len(x), (role == 1).sum()], x.sum(0), (x * x).sum(0)])

    found = _sums(rows, moments, 2 + 2 * d)
    n_unlabelled, n_positive = found[:2]
    weights = np.zeros(d)
    if not n_positive or not n_unlabelled:
        weights[0] = math.log(prior / (1 - prior))
        return Model(weights, np.zeros(d), np.ones(d), prior)
    centre = found[2:2 + d] / n_unlabelled
    spread = np.sqrt(np.maximum(found[2 + d:] / n_unlabelled - centre ** 2, 0))
    centre[0], spread[0] = 0, 1
    scale = np.where(spread > 1e-9, spread, 1.0)
    penalty = np.full(d, max(ridge, PULL / n_positive))  # few positives say little about many weights
    penalty[0] = 0

    def at(weights):
        """Gradient, curvature and the two risks at ``weights``."""

        def part(x, role):
            z = standard(x, centre, scale)
            g = z @ weights
            p = role == 1
            s = 1 / (1 + np.exp(-g))
            curve = (z * (s * (1 - s))[:, None]).T @ z
            minus = np.logaddexp(0, g)  # loss of calling a row negative
            plus = np.logaddexp(0, -g)
            return np.concatenate([z.T @ s, z[p].sum(0), curve.ravel(), [minus.sum(), minus[p].sum(), plus[p].sum()]])

        v = _sums(rows, part, 2 * d + d * d + 3)
        gradient = v[:d] / n_unlabelled - prior * v[d:2 * d] / n_positive + penalty * weights
        curve = v[2 * d:2 * d + d * d].reshape(d, d) / n_unlabelled + np.diag(penalty + 1e-9)
        risk = v[-3] / n_unlabelled + prior * (v[-1] - v[-2]) / n_positive + float(penalty @ weights ** 2) / 2
        return gradient, curve, risk

    weights[0] = math.log(prior / (1 - prior))
    gradient, curve, risk = at(weights)
    for _ in range(steps):
        step = np.linalg.solve(curve, gradient)
        for _ in range(4):
            trial = at(weights - step)
            if trial[2] <= risk:
                break
            step /= 2
        else:
            break
        weights, better = weights - step, risk - trial[2]
        gradient, curve, risk = trial
        if better < 1e-6:
            break
    place, slope = boundary(rows, weights, centre, scale, prior)
    weights *= slope
    weights[0] -= slope * place
    return Model(weights, centre, scale, prior)


def boundary(rows: DataFrame, weights: np.ndarray, centre: np.ndarray, scale: np.ndarray, prior: float) -> tuple[float, float]:
    """Where along the direction the non-negative risk is least, and a slope that fits the room there."""

    def histogram(x, role):
        at = np.clip((standard(x, centre, scale) @ weights + REACH) / (2 * REACH) * CELLS, 0, CELLS - 1).astype(np.int64)
        return np.concatenate([np.bincount(at, minlength=CELLS), np.bincount(at[role == 1], minlength=CELLS)])

    counts = _sums(rows, histogram, 2 * CELLS)
    everything, positive = counts[:CELLS] / counts[:CELLS].sum(), counts[CELLS:] / counts[CELLS:].sum()
    lost = np.concatenate([[0], np.cumsum(positive)])  # share of positives below each cell's start
    called = 1 - np.concatenate([[0], np.cumsum(everything)])  # share of the corpus from there on
    risk = prior * lost + np.maximum(0, called - prior * (1 - lost))
    first = int(np.argmin(risk))
    last = first
    while last < CELLS and risk[last + 1] <= risk[first] + 1e-9:
        last += 1
    width = 2 * REACH / CELLS
    return (first + last) / 2 * width - REACH, 4 / max((last - first) * width, 0.5)


def train(measured_docs: DataFrame, labels: DataFrame, held_out: Column) -> Model:
    """A model from the rows of ``measured_docs`` that are not held out; ``labels`` has doc_id and quality."""
    known = labels.groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality IS NOT NULL AND doc_id IS NOT NULL")
    rows = measured_docs.where(~held_out).join(known, "doc_id", "left")
    rows = written(rows.select("x", "quality", F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0)).alias("role")), "roles")
    share = rows.agg(F.avg("quality").alias("share")).first()["share"]
    return fit(rows, min(max(0.5 if share is None else float(share), 0.01), 0.99))


def scored(docs: DataFrame, labels: DataFrame, folds: int = 5, least: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Fold 0 never shows its labels."""
    x = measurements(docs)
    held_out = fold("doc_id", folds) == 0
    model = train(x, labels, held_out)
    return x.select("doc_id", held_out.alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= least).cast("int"))
