"""Ordinal quality grades: one linear score over hashed text features, cut by ordered thresholds.

P(grade >= k) = sigmoid(score - threshold_k), the cumulative-link model: all grades share the weights
and only the thresholds differ. It gives an expected grade and the chance of at least a chosen grade.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from loadtide.llm.rows import packed, unpacked
from loadtide.llm.words import _BASE, _BYTE, _LOWER, _power, as_bytes, mix, pieces

SLOTS = 1 << 18
BINS = 24
STEMS = (4, 5)
SCREEN = 1.0  # times the largest score statistic, in standard errors, that chance alone lets expect
GROUP = 64
STEP_ROUNDS = 100

_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_KINDS = np.zeros(256, np.uint8)  # 0 other, 1 lower or beyond ASCII, 2 upper, 3 digit, 4 punctuation, 5 space
_KINDS[97:123] = _KINDS[128:] = 1
_KINDS[65:91] = 2
_KINDS[48:58] = 3
_KINDS[33:48] = _KINDS[58:65] = _KINDS[91:97] = _KINDS[123:127] = 4
_KINDS[[9, 10, 11, 12, 13, 32]] = 5


def _stats(data: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Slots of the text's statistics, each cut into bins: one for every bin up to the text's own."""
    kinds = np.bincount(_KINDS[data], minlength=6) / len(data)
    letters = max(kinds[1] + kinds[2], 1e-9)
    shares = [
        kinds[2] / letters, kinds[3] ** 0.5, kinds[4] ** 0.5, kinds[5],
        min(1.0, np.log1p(len(tokens)) / 12), len(np.unique(tokens)) / len(tokens),
        min(1.0, len(data) / len(tokens) / 24),
    ]
    upto = [np.arange(int(min(s, 0.9999) * BINS) + 1, dtype=np.uint64) + np.uint64(k << 8) for k, s in enumerate(shares)]
    return np.concatenate(upto) + np.uint64(1 << 40)


def features(texts: list[bytes]):
    """For each text its sorted distinct slots: tokens (runs of letters and digits, A-Z lower-cased),
    their stems of four and five bytes, and binned statistics. Without a token: none."""
    for lo, hi in pieces(texts):
        data = np.frombuffer(b" ".join(texts[lo:hi]), np.uint8)
        if not len(data):
            yield from (np.empty(0, np.int32) for _ in range(hi - lo))
            continue
        inside = np.concatenate(([False], _LETTER[data], [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, stops = edge[::2], edge[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[_LOWER[data]] * _power("up", _BASE, len(data)), out=sums[1:])
        down = _power("down", pow(_BASE, -1, 1 << 64), len(data))[starts]
        whole = mix((sums[stops] - sums[starts]) * down)
        stems = [mix((sums[np.minimum(stops, starts + k)] - sums[starts]) * down + np.uint64(k)) for k in STEMS]
        at = 0
        first = 0
        for t in texts[lo:hi]:
            end = at + len(t)
            last = np.searchsorted(starts, end)
            if last == first:
                yield np.empty(0, np.int32)
            else:
                parts = [whole[first:last], *(s[first:last] for s in stems), mix(_stats(data[at:end], whole[first:last]))]
                yield np.unique(np.concatenate(parts) % np.uint64(SLOTS)).astype(np.int32)
            first, at = last, end + 1


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Sum of weights; minus infinity (lowest grade for certain) where a text has no token."""
        return np.array([self.weights[f].sum() if len(f) else -np.inf for f in features(texts)])


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _ascend(row, col, grades, levels: int, w: np.ndarray, used: int, l2: float, rounds: int) -> np.ndarray:
    """Full-batch Adam from ``w``: the weights of ``used`` columns, the first threshold, logs of the gaps between thresholds."""
    n = len(grades)
    w = w.copy()
    m, v = np.zeros(len(w)), np.zeros(len(w))
    for t in range(1, rounds + 1):
        s = np.bincount(row, w[col], minlength=n)
        gaps = np.exp(w[used + 1 :])
        theta = _edges(w[used:])
        a, b = _sigmoid(s - theta[grades]), _sigmoid(s - theta[grades + 1])
        p = np.maximum(a - b, 1e-12)
        ds = -(1 - a - b) / n
        g = np.empty(len(w))
        g[:used] = np.bincount(col, ds[row], minlength=used) + l2 * w[:used]
        at = np.bincount(grades, a * (1 - a) / p / n, minlength=levels)[1:]
        at -= np.bincount(grades, b * (1 - b) / p / n, minlength=levels)[:-1]
        g[used] = at.sum()
        g[used + 1 :] = np.cumsum(at[::-1])[::-1][1:] * gaps
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= 0.1 * (1 - t / (rounds + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w


def _edges(cuts: np.ndarray) -> np.ndarray:
    """Thresholds between minus and plus infinity from the first one and the logs of the gaps."""
    return np.concatenate(([-np.inf], cuts[0] + np.concatenate(([0.0], np.cumsum(np.exp(cuts[1:])))), [np.inf]))


def _score_statistic(row, col, grades, scores, theta, columns: int) -> np.ndarray:
    """Of each column the standard errors by which the likelihood's slope at weight 0 differs from 0, given ``scores``."""
    up = _sigmoid(scores[:, None] - theta[None])
    chance, slope = np.maximum(up[:, :-1] - up[:, 1:], 0), 1 - up[:, :-1] - up[:, 1:]
    spread = (chance * slope * slope).sum(axis=1)
    own = slope[np.arange(len(grades)), grades]
    total = np.bincount(col, own[row], minlength=columns)
    return np.abs(total) / np.sqrt(np.maximum(np.bincount(col, spread[row], minlength=columns), 0.1))


def fit_rows(slots: list[np.ndarray], grades: np.ndarray, levels: int, least: int, l2: float, rounds: int) -> OrdinalModel:
    """Maximum likelihood with an L2 penalty by full-batch Adam, on slots taken step by step.

    A step takes the slots of ``least`` rows or more that the model so far explains worst: those within half of the
    largest score statistic, ``GROUP`` at most, and trains again. It ends when none is above what the largest
    of as many statistics reaches by chance, sqrt(2 log slots). The bar thus follows the number of
    slots in the labelled rows, and once poor rows are explained, a slot of the middle grade stands out from the good ones.
    """
    n = len(slots)
    above = np.array([(grades >= k).sum() for k in range(1, levels)], float)
    share = (above + 0.5) / (n + 1)
    cuts = -np.log(share / (1 - share))
    cuts = np.maximum.accumulate(cuts + 1e-3 * np.arange(2 - levels, 1))
    weights = np.zeros(SLOTS)
    if n == 0 or len(np.unique(grades)) < 2:
        return OrdinalModel(weights, cuts)
    row = np.repeat(np.arange(n, dtype=np.int32), [len(s) for s in slots])
    col = np.concatenate(slots)
    keep = np.bincount(col, minlength=SLOTS)[col] >= least
    row, col = row[keep].astype(np.int64), col[keep].astype(np.int64)
    slot, col = np.unique(col, return_inverse=True)
    bar = SCREEN * np.sqrt(2 * np.log(max(len(slot), 2)))
    value = np.zeros(len(slot))
    place = np.full(len(slot), -1)
    tail = np.concatenate((cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))))

    def train(rounds: int) -> None:
        nonlocal tail
        used = np.flatnonzero(place >= 0)
        place[used] = np.arange(len(used))
        inside = place[col] >= 0
        w = _ascend(row[inside], place[col[inside]], grades, levels, np.concatenate((value[used], tail)), len(used), l2, rounds)
        value[used], tail = w[: len(used)], w[len(used) :]

    while (place < 0).any():
        z = _score_statistic(row, col, grades, np.bincount(row, value[col], minlength=n), _edges(tail), len(slot))
        z[place >= 0] = -1
        best = np.argsort(-z, kind="stable")[:GROUP]
        best = best[(z[best] >= bar) & (z[best] >= z[best[0]] / 2) & (z[best] >= 0)]
        if not len(best):
            break
        place[best] = 0
        train(STEP_ROUNDS)
    train(rounds)
    weights[slot] = value
    return OrdinalModel(weights, _edges(tail)[1:-1])


def fit(
    docs: DataFrame,
    graded: DataFrame,
    levels: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int = 8000,
    least: int = 8,
    l2: float = 1e-5,
    rounds: int = 400,
) -> OrdinalModel:
    """Fit on at most ``max_rows`` rows of ``graded`` (``id_col``, grade from 0 to ``levels`` - 1).

    The rows are those with the lowest hash of their id, so the sample is the same in every run. Repeated
    labels and repeated documents count once, before the limit. Rows
    with a null id, a null grade or no document are left out. Without two grades among them the
    weights are zero and the thresholds follow the grades' shares.
    """
    rows = graded.select(F.col(id_col).cast("long").alias("_id"), F.col("grade").cast("int").alias("grade"))
    rows = rows.where("_id is not null and grade is not null").distinct()
    rows = rows.orderBy(F.xxhash64("_id"), "_id", "grade").limit(max_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    labelled = texts.join(F.broadcast(rows), "_id")  # at most max_rows rows of two numbers

    def slots(batches):
        for batch in batches:
            found = list(features(as_bytes(batch.column(1))))
            key = [f.tobytes() for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(key, pa.binary())], names=["_id", "grade", "slots"])

    def train(table: pa.Table) -> pa.Table:
        ids, grades = table.column("_id").to_numpy(), table.column("grade").to_numpy().astype(np.int64)
        texts = table.column("slots").to_pylist()
        # the order doesn't depend on the partitions
        own = sorted(zip(ids.tolist(), grades.tolist(), texts))
        x = [np.frombuffer(t, np.int32) for _, _, t in own]
        model = fit_rows(x, np.array([g for _, g, _ in own], np.int64), levels, least, l2, rounds)
        return pa.table({"weights": [model.weights.tobytes()], "thresholds": [model.thresholds.tolist()]})

    # copies of a labelled document go before the limit, so the one task gets max_rows rows at most
    found = labelled.mapInArrow(slots, "_id long, grade int, slots binary").distinct()
    found = found.orderBy(F.xxhash64("_id"), "_id", "grade", "slots").limit(max_rows)
    row = found.groupBy(F.lit(0).alias("all")).applyInArrow(train, "weights binary, thresholds array<double>").collect()
    if not row:
        return fit_rows([], np.empty(0, np.int64), levels, least, l2, rounds)
    return OrdinalModel(np.frombuffer(row[0]["weights"], np.float64), np.array(row[0]["thresholds"]))


def score(model: OrdinalModel, text: Column) -> Column:
    """The model's score of a text as a column; null counts as empty."""

    @arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        return pa.array(model.scores(as_bytes(column)), pa.float64())

    return run(text.cast("string"))


def tail(model: OrdinalModel, scored: Column, grade: int) -> Column:
    """P(grade >= ``grade``) for a score."""
    return 1 / (1 + F.exp(F.lit(float(model.thresholds[grade - 1])) - scored))


def grade_documents(model: OrdinalModel, docs: DataFrame, at_least: int, chance: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` with expected_grade, tail_probability (of ``at_least`` or better) and accepted.

    Input columns of these names are replaced. Texts that are null, empty or without a letter or
    digit get expected grade 0 and aren't accepted. Equal texts get equal results.
    """
    names = ("expected_grade", "tail_probability", "accepted")
    out = docs.select(packed(docs, names), score(model, F.col(text_col)).alias("score"))
    expected = sum(tail(model, F.col("score"), k) for k in range(1, len(model.thresholds) + 1))
    out = out.select("row", expected.alias("expected_grade"), tail(model, F.col("score"), at_least).alias("tail_probability"))
    out = out.withColumn("accepted", F.col("tail_probability") >= chance)
    return out.select(*unpacked(out, docs, names), *names)


def grades_of(labels: DataFrame) -> DataFrame:
    """Grades from the labels table: 0 poor, 1 good but toxic, 2 good; null where quality is null."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0))
    grade = F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (toxic == 1), 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))
