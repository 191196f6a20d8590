"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is a linear function of features of its text: shares of kinds of characters, lengths and
variety of words and lines, repetition, and their squares; and of its words, as shares of LEXICAL cells that lower-case
words are hashed to.  It is learnt from preference pairs, a labelled good document over a labelled bad one, by logistic
loss on the difference of their features.  The threshold is a quantile of the strengths of the labelled documents that
were learnt from: as many of them lie below as are labelled bad.  The score is the logistic function of strength,
shifted so that the threshold has score THRESHOLD.

Learning takes every labelled document but those held out (crc32 of doc_id as text, modulo FOLDS, is 0), and every pair
of a good and a bad one.  Pairs are never made: what all documents of one label do to one of the other depends on its
strength alone, and is tabled over strengths in steps of STEP, between which it is linear (within 1e-5 for each pair).
So a Newton step is two passes over the features of labelled documents, of which sums come back, and the threshold is
found by counting.  The driver holds numbers for steps of strength and for pairs of features, never for documents.

Every whole text is read once, for its features, in 32 bits; learning and scores come from these.  A null text counts
as empty and has the features of an empty text.  Rows of labels with a null label, and labels without a document, are
not learnt from; if one of the labels is missing altogether, every score is THRESHOLD.  Of a doc_id that is labelled
twice the lesser label counts, of one that has several texts the one whose features sort first, as bytes.
A null doc_id is not held out.  Every row is scored by itself, so that repeated rows, and rows that share a doc_id, all
come back; equal texts have equal scores.  An empty table gives none.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Workspace, documents, lean, slices, texts, utf8
from .substring_dedup import Words

FOLDS = 5
THRESHOLD = 0.3
RIDGE = 1e-3
#: Newton steps at most, and how many are mixed; a step in which no weight moves by TOLERANCE is the last.
ROUNDS, MIXED, TOLERANCE = 25, 6, 1e-4
#: The step of the tables over strengths, and the knots of the curvature, at most.
STEP, KNOTS = 1 / 64, 32
#: Sums of so many tasks are added up by one; counted cells of strengths.
FAN, CELLS = 64, 4096

#: Kinds of bytes: lower case, upper case, digits, blanks, line ends, stops, marks of other kinds, bytes of other scripts.
_KIND = np.full(256, 6, np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[[32, 9]], _KIND[[10, 13]], _KIND[[44, 46]], _KIND[128:] = 0, 1, 2, 3, 4, 5, 7
KINDS = 8
_MARKS = "!?$%&*#|@^~=<>/\\_+"
#: Cells that words are hashed to.
LEXICAL = 128
N_SURFACE = KINDS + len(_MARKS) + 15
N_FEATURES = N_SURFACE + LEXICAL
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def features(column: pa.Array) -> np.ndarray:
    """A row of numbers for each text."""
    data, starts = utf8(column)
    n, sizes = len(starts) - 1, np.diff(starts)
    doc = np.repeat(np.arange(n), sizes)
    out = np.zeros((n, N_FEATURES))
    whole = np.maximum(sizes, 1)[:, None]
    out[:, :KINDS] = np.bincount(doc * KINDS + _KIND[data], minlength=n * KINDS).reshape(n, KINDS) / whole
    for k, mark in enumerate(_MARKS):
        out[:, KINDS + k] = np.bincount(doc[data == ord(mark)], minlength=n) / whole[:, 0]
    for i, text in enumerate(texts(column)):
        words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
        w, ls = max(1, len(words)), max(1, len(lines))
        lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
        line_lengths = np.fromiter(map(len, lines), np.int64, len(lines)) if lines else np.zeros(1)
        kinds = len(set(words))
        out[i, KINDS + len(_MARKS) : N_SURFACE] = (
            np.log1p(len(words)),
            lengths.mean() / 10,
            lengths.std() / 10,
            min(5.0, lengths.max() / 50),
            kinds / w,
            np.log1p(kinds) / np.log1p(w),
            len(set(lines)) / ls,
            np.log1p(ls),
            np.log1p(line_lengths.mean()) / 5,
            np.log1p(line_lengths.std()) / 5,
            sum(x[-1] in ".,;:" for x in words) / w,
            sum(not x[-1].isalnum() for x in words) / w,
            sum(x.isupper() for x in words) / w,
            sum(x[-1] in ".!?" for x in lines) / ls,
            (lengths <= 2).mean(),
        )
    words = Words(_LOWER[data], starts)
    cells = np.bincount(words.doc * LEXICAL + (words.symbols >> np.uint64(57)).astype(np.int64), minlength=n * LEXICAL).reshape(n, LEXICAL)
    out[:, N_SURFACE:] = cells / np.maximum(np.diff(words.starts), 1)[:, None]
    return out


def expand(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features, bounded, and the squares of those that are not of words."""
    z = np.clip((x - mean) / scale, -6, 6)
    return np.concatenate([z, z[:, :N_SURFACE] ** 2 - 1], axis=1)


class Model:
    """What fit() learns: a few hundred numbers."""

    def __init__(self, mean, scale, weights, cut, slope):
        self.mean, self.scale, self.weights, self.cut, self.slope = mean, scale, weights, cut, slope

    def scores(self, x: np.ndarray) -> np.ndarray:
        strength = expand(x, self.mean, self.scale) @ self.weights
        shift = np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(self.slope * (strength - self.cut) + shift, -30, 30)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def tally(strength: np.ndarray, good: np.ndarray) -> list[np.ndarray]:
    """Steps of strength, ascending, and good and bad documents there, each shared out linearly to the two steps beside it."""
    at = np.floor(strength / STEP).astype(np.int64)
    low = int(at.min()) if len(at) else 0
    at, rest = at - low, strength / STEP - at
    n = int(at.max()) + 2 if len(at) else 0
    # From floats, since bincount() of no documents gives integers, whatever its weights.
    counts = [np.zeros(n) + np.bincount(at[own], 1 - rest[own], n) + np.bincount(at[own] + 1, rest[own], n) for own in (good, ~good)]
    used = counts[0] + counts[1] > 0
    return [x[used] for x in (np.arange(low, low + n), *counts)]


class Pulls:
    """What all documents of one label do to one of the other, by steps of strength."""

    def __init__(self, steps: np.ndarray, good: np.ndarray, bad: np.ndarray):
        self.low, m = int(steps[0]), int(steps[-1] - steps[0]) + 2
        dense = np.zeros((2, m))
        dense[:, steps - self.low] = good, bad
        good, bad = dense
        lost = _sigmoid(-np.arange(1 - m, m) * STEP)  # the odds that a document so far above another is ranked below it

        def over(counts: np.ndarray, kernel: np.ndarray) -> np.ndarray:
            n = 1 << (3 * m).bit_length()
            return np.fft.irfft(np.fft.rfft(counts, n) * np.fft.rfft(kernel, n), n)[m - 1 : 2 * m - 1]

        self.on_good, self.on_bad = over(bad, lost), over(good, lost[::-1])
        self.pairs = float(good.sum() * bad.sum())
        # The curvature is linear between knots, which part it in about equal shares.
        bend = lost * (1 - lost)
        share = np.cumsum(np.maximum(good * over(bad, bend) + bad * over(good, bend), 0))
        inner = np.searchsorted(share, np.arange(1, KNOTS - 1) / (KNOTS - 1) * share[-1])
        self.knots = np.unique(np.concatenate([[0], inner, [m - 1]]))
        rank = _sigmoid((self.knots[:, None] - self.knots[None, :]) * STEP)
        self.bend = rank * (1 - rank)
        hats = self._hats(np.arange(m))
        self.bend_good, self.bend_bad = self.bend @ (bad @ hats), self.bend @ (good @ hats)

    def _hats(self, place: np.ndarray) -> np.ndarray:
        """The weights of the knots for places on the steps."""
        k = np.clip(np.searchsorted(self.knots, place, side="right") - 1, 0, len(self.knots) - 2)
        rest = (place - self.knots[k]) / (self.knots[k + 1] - self.knots[k])
        out = np.zeros((len(place), len(self.knots)))
        out[np.arange(len(place)), k], out[np.arange(len(place)), k + 1] = 1 - rest, rest
        return out

    def sums(self, z: np.ndarray, good: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Of some documents: their part of gradient and curvature, as one vector."""
        place = np.clip(z @ w / STEP - self.low, 0, len(self.on_good) - 1)
        at = np.minimum(place.astype(np.int64), len(self.on_good) - 2)
        rest = place - at
        pull = np.where(good, self.on_good[at] * (1 - rest) + self.on_good[at + 1] * rest, -(self.on_bad[at] * (1 - rest) + self.on_bad[at + 1] * rest))
        hats = self._hats(place)
        square = (z * np.where(good, hats @ self.bend_good, hats @ self.bend_bad)[:, None]).T @ z
        return np.concatenate([pull @ z, square.ravel(), (hats[good].T @ z[good]).ravel(), (hats[~good].T @ z[~good]).ravel()])

    def step(self, sums: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The Newton step."""
        n = len(w)
        gradient, square, (good, bad) = sums[:n], sums[n : n + n * n].reshape(n, n), sums[n + n * n :].reshape(2, -1, n)
        cross = good.T @ self.bend @ bad
        return np.linalg.solve((square - cross - cross.T) / self.pairs + RIDGE * np.eye(n), gradient / self.pairs - RIDGE * w)


def newton(size: int, tallied: Callable[[np.ndarray], list[np.ndarray]], summed: Callable[[np.ndarray, Pulls], np.ndarray]) -> np.ndarray:
    """The weights, from two passes for each step: tallies of strengths, then sums under the pulls that follow from them.

    The gradient is that of all pairs, the curvature near to theirs; so steps are mixed with those before (Anderson)."""
    w, before, steps = np.zeros(size), [], []
    for _ in range(ROUNDS):
        pulls = Pulls(*tallied(w))
        step = pulls.step(summed(w, pulls), w)
        before, steps = [*before[-MIXED:], w], [*steps[-MIXED:], step]
        if np.abs(step).max() < TOLERANCE:
            return w + step
        if len(steps) > 1:
            moved, turned = np.diff(before, axis=0), np.diff(steps, axis=0)
            step = step - np.linalg.lstsq(turned.T, step, rcond=1e-10)[0] @ (moved + turned)
        w = w + step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
    return w


def some_pairs(z: np.ndarray, a: np.ndarray, b: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The weights from so many random pairs of good and bad rows."""
    rng = np.random.default_rng(seed)
    d = z[rng.choice(a, n)] - z[rng.choice(b, n)]
    w = np.zeros(z.shape[1])
    for _ in range(ROUNDS):
        p = _sigmoid(-(d @ w))
        gradient = d.T @ p / n - RIDGE * w
        curvature = (d * (p * (1 - p))[:, None]).T @ d / n + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w += step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < TOLERANCE:
            break
    return w


def _nothing(mean: np.ndarray, scale: np.ndarray) -> Model:
    return Model(mean, scale, np.zeros(N_FEATURES + N_SURFACE), 0.0, 0.0)


def fit(x: np.ndarray, good: np.ndarray, seed: int = 7, pairs: int | None = None) -> Model:
    """Learns from feature rows at hand and whether each is good: from all pairs, or so many random ones if there are more."""
    if not len(x):
        return _nothing(np.zeros(N_FEATURES), np.ones(N_FEATURES))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = expand(x, mean, scale)
    a, b = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(a) or not len(b):
        return _nothing(mean, scale)
    if pairs is not None and pairs < len(a) * len(b):
        w = some_pairs(z, a, b, pairs, seed)
    else:
        w = newton(z.shape[1], lambda w: tally(z @ w, good), lambda w, pulls: pulls.sums(z, good, w))
    # The quantile with as many below as are labelled bad: midway between its two neighbours.
    strength = np.sort(z @ w)
    return Model(mean, scale, w, float((strength[len(b) - 1] + strength[len(b)]) / 2), 1.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def featured(docs: DataFrame) -> DataFrame:
    """doc_id and features of every row, x: as 32-bit numbers, in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = features(batch.column("text")).astype("<f4")
            ends = np.arange(len(x) + 1, dtype=np.int32) * (4 * N_FEATURES)
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(x.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), packed], names=["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, x binary")


def _rows(column: pa.Array) -> np.ndarray:
    return utf8(column)[0].view("<f4").reshape(-1, N_FEATURES).astype(float)


def _summed(rows: DataFrame, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of of(features, good) over all rows: by task, by FAN tasks, and of what is left; always in the same order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in slices(batches, "x"):
            own = of(_rows(batch.column("x")), batch.column("good").to_numpy(zero_copy_only=False))
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = sum(np.frombuffer(x.as_py()) for x in table.column("sums"))
        return pa.table({"part": table.column("part")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "part long, sums binary"
    found = rows.mapInArrow(lean(run), schema).groupBy(F.floor(F.col("part") / FAN)).applyInArrow(add, schema).collect()
    return sum(np.frombuffer(r.sums) for r in sorted(found, key=lambda r: r.part)) if found else None


def _tallied(rows: DataFrame, strength: Callable[[np.ndarray], np.ndarray]) -> list[np.ndarray]:
    """tally() of all rows."""
    names = ["good", "bad"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "x"):
            found = tally(strength(_rows(batch.column("x"))), batch.column("good").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["step", *names])

    steps = rows.mapInArrow(lean(run), "step long, " + ", ".join(f"{n} double" for n in names))
    found = steps.groupBy("step").agg(*(F.sum(n).alias(n) for n in names)).toPandas().sort_values("step")
    return [found[n].to_numpy() for n in ["step", *names]]


def _strengths(rows: DataFrame, strength: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """strength of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "x"):
            yield pa.RecordBatch.from_arrays([pa.array(strength(_rows(batch.column("x"))))], names=["strength"])

    return rows.mapInArrow(lean(run), "strength double")


def ranked(values: DataFrame, column: str, k: int) -> float:
    """The value with k before it, exactly: cells are counted, then cells of the one that it lies in."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    while low < high:
        cell = F.least(F.floor((F.col(column) - low) / ((high - low) / CELLS)), F.lit(CELLS - 1))
        counts = values.filter(F.col(column).between(low, high)).groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy("cell").collect()
        for r in counts:
            if k < r.n:
                break
            k -= r.n
        low, high = r.low, r.high
    return low


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """From all labelled documents that are not held out, and all of their pairs."""
    return learnt(featured(docs), labels, Workspace(docs.sparkSession, "quality"))


def learnt(rows: DataFrame, labels: DataFrame, ws: Workspace) -> Model:
    """train() from featured() rows."""
    usable = labels.filter("quality IN (0, 1)").filter(~held_out(F.col("doc_id"))).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    own = rows.join(usable, "doc_id").groupBy("doc_id").agg((F.min("quality") == 1).alias("good"), F.min("x").alias("x"))
    own = ws.table(own.select("good", "x"), "labelled")
    total = _summed(own, lambda x, good: np.concatenate([[len(x), good.sum()], x.sum(axis=0), (x * x).sum(axis=0)]))
    if total is None:
        return _nothing(np.zeros(N_FEATURES), np.ones(N_FEATURES))
    n, n_good = int(total[0]), int(total[1])
    mean = total[2 : 2 + N_FEATURES] / n
    scale = np.sqrt(np.maximum(total[2 + N_FEATURES :] / n - mean**2, 0)) + 1e-9
    if n_good in (0, n):
        return _nothing(mean, scale)
    w = newton(
        N_FEATURES + N_SURFACE,
        lambda w: _tallied(own, lambda x: expand(x, mean, scale) @ w),
        lambda w, pulls: _summed(own, lambda x, good: pulls.sums(expand(x, mean, scale), good, w)),
    )
    # The quantile with as many below as are labelled bad: midway between its two neighbours.
    strengths = ws.table(_strengths(own, lambda x: expand(x, mean, scale) @ w), "strengths")
    below, above = (ranked(strengths, "strength", k) for k in (n - n_good - 1, n - n_good))
    ws.drop("labelled")
    ws.drop("strengths")
    return Model(mean, scale, w, (below + above) / 2, 1.0)


def rated(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of featured() rows."""
    shared = rows.sparkSession.sparkContext.broadcast((model.mean, model.scale, model.weights, model.cut, model.slope))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in slices(batches, "x"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own.scores(_rows(batch.column("x"))))], names=["doc_id", "score"])

    return rows.mapInArrow(lean(run), "doc_id long, score double")


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    return rated(featured(docs), model)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "op4")
    rows = ws.table(featured(documents(spark, sf_dir)), "features")
    model = learnt(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), ws)
    return rated(rows, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
