"""Document quality with a linear-chain conditional random field over lines.

Every line is good or bad. Its features describe the line and both its neighbours; the
chain has a weight for each pair of successive labels. The marginals of the lines come
from forward and backward products of two-by-two matrices, taken for all lines of a
chunk at once by doubling, whatever the length of a document. A document's score is the
mean marginal of its lines, weighted by their length.

Labels are known for documents only, so in training a line has the label of its
document. The model is fitted on the driver on a bounded sample: at most about
``per_class`` documents of each label, chosen by a hash of the id, and of each at most
``SEGMENTS`` stretches of ``SEGMENT_LINES`` lines, evenly spread. Scoring reads every
line of every document.

Defined cases: a null or empty text is one empty line and gets that line's marginal; a
document with several labels has the smallest; labels without id or quality are left
out; without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from docstrata.llm.tables import disclose, enclose, inner, pick
from docstrata.llm.words import Hasher, Spans, Words, buffers, chunks, mix, not_space

PER_CLASS = 2000
SEGMENTS = 4
SEGMENT_LINES = 32
STEPS = 200
SEED = 0xC4F


def _bytes(text: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[np.frombuffer(text.encode(), np.uint8)] = True
    return out


_UPPER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _bytes("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _bytes("0123456789")
_POINT = _bytes(".,;:?'\"()-")
_SHOUT = _bytes("!")
_SYMBOL = _bytes("#$%&*+/<=>@[\\]^_`{|}~")
_BEYOND = np.arange(256) >= 128
_CLASSES = (_UPPER, _LOWER, _DIGIT, _POINT, _SHOUT, _SYMBOL, _BEYOND)
OWN = 16


@dataclass(frozen=True)
class Lines:
    """The lines of some documents: where they start and end, and their documents."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split_lines(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """Every document has one line more than it has line feeds."""
    feeds = np.flatnonzero(data == 10)
    of = np.searchsorted(offsets, feeds, side="right") - 1
    docs = np.arange(len(offsets) - 1)
    row = np.concatenate([docs, of])
    starts = np.concatenate([offsets[:-1], feeds + 1])
    order = np.lexsort((starts, row))
    ends = np.concatenate([offsets[1:], feeds])
    behind = np.lexsort((ends, row))
    first = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(docs)) + 1)])
    return Lines(starts[order], ends[behind], first)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[Lines, np.ndarray]:
    """The lines, and for each its own features and those of both neighbours."""
    lines = split_lines(data, offsets)
    size = (lines.ends - lines.starts).astype(np.float32)
    counts = []
    total = np.zeros(len(data) + 1, np.int64)
    for member in _CLASSES:
        np.cumsum(member[data], out=total[1:])
        counts.append((total[lines.ends] - total[lines.starts]).astype(np.float32))
    upper, lower, digit, point, shout, symbol, beyond = counts
    words = Words(data, offsets, not_space())
    hashes = words.hashes(Hasher(not_space(), SEED, fold=True))
    begin = np.searchsorted(words.starts, lines.starts)
    end = np.searchsorted(words.starts, lines.ends)
    n = (end - begin).astype(np.float32)
    of = np.repeat(np.arange(len(begin)), end - begin)
    distinct = np.unique(mix(hashes + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    unique = np.bincount(of[distinct], minlength=len(begin))
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    repeats = np.bincount(of[again], minlength=len(begin))
    line_hash = Spans(hashes, SEED)(begin, end)
    key = mix(line_hash + lines.row.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    times = np.where(n > 0, times[inverse], 1).astype(np.float32)
    some, letters = np.maximum(size, 1), np.maximum(upper + lower, 1)
    many = np.maximum(n, 1)
    own = np.stack(
        [
            np.ones_like(size),
            upper / letters,
            digit / some,
            point / many,
            np.minimum(shout / many, 3),
            np.minimum(symbol / many, 4),
            beyond / some,
            np.minimum(size / many, 40) / 10,
            np.log1p(n) / 4,
            unique / many,
            repeats / many,
            times > 1,
            np.log1p(times - 1) / 3,
            n == 0,
            (shout > 0),
            (symbol > 0),
        ],
        axis=1,
    ).astype(np.float32)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    after[:-1] = own[1:]
    before[lines.first[:-1]] = 0
    after[lines.first[1:] - 1] = 0
    return lines, np.concatenate([own, before, after], axis=1)


@dataclass(frozen=True)
class Model:
    """Weights of the features for "good", of successive labels (bad, good) and of the
    first label; ``centre`` and ``scale`` standardise features."""

    weights: np.ndarray
    pairs: np.ndarray
    opening: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    @classmethod
    def empty(cls, n: int = 3 * OWN) -> Model:
        return cls(np.zeros(n), np.zeros((2, 2)), np.zeros(2), np.zeros(n), np.ones(n))

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """The weight of "good" for each line from its features alone."""
        return np.clip(((x - self.centre) / self.scale) @ self.weights, -30, 30)


def _multiply(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    """Products of two-by-two matrices given by their four entries, scaled to a
    largest entry of one."""
    out = [
        a[0] * b[0] + a[1] * b[2],
        a[0] * b[1] + a[1] * b[3],
        a[2] * b[0] + a[3] * b[2],
        a[2] * b[1] + a[3] * b[3],
    ]
    largest = np.maximum(np.maximum(out[0], out[1]), np.maximum(out[2], out[3]))
    return [x / largest for x in out]


def _prefix(steps: list[np.ndarray], longest: int) -> list[np.ndarray]:
    """Products of all matrices up to each one, over at most ``longest`` of them."""
    done = 1
    while done < longest:
        grown = _multiply([x[:-done] for x in steps], [x[done:] for x in steps])
        steps = [np.concatenate([x[:done], g]) for x, g in zip(steps, grown, strict=True)]
        done *= 2
    return steps


def marginals(
    model: Model, evidence: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The probability of "good" for each line, and of each pair of labels (4 columns)
    for each line and the next one."""
    n = len(evidence)
    longest = int(np.diff(first).max())
    good = np.exp(np.minimum(evidence, 0))
    bad = np.exp(-np.maximum(evidence, 0))
    scaled = np.exp(model.pairs - model.pairs.max())
    forward = [scaled[0, 0] * bad, scaled[0, 1] * good, scaled[1, 0] * bad, scaled[1, 1] * good]
    backward = [np.append(x[1:], 1.0) for x in forward]
    opening = np.exp(model.opening - model.opening.max())
    heads, tails = first[:-1], first[1:] - 1
    for k, side in enumerate((bad, good, bad, good)):
        forward[k] = forward[k].copy()
        forward[k][heads] = opening[k % 2] * side[heads]
        backward[k][tails] = 1.0
    links = [np.array(x) for x in backward]
    alpha = _prefix(forward, longest)
    reverse = [x[::-1] for x in (backward[0], backward[2], backward[1], backward[3])]
    beta = _prefix(reverse, longest)
    beta = [x[::-1] for x in (beta[0], beta[2], beta[1], beta[3])]
    after = beta[0] + beta[1], beta[2] + beta[3]
    ahead = alpha[0], alpha[1]
    both = ahead[0] * after[0], ahead[1] * after[1]
    p = both[1] / (both[0] + both[1])
    pair = np.zeros((n, 4))
    inner = np.ones(n, dtype=bool)
    inner[tails] = False
    at = np.flatnonzero(inner)
    for k in range(4):
        pair[at, k] = ahead[k // 2][at] * links[k][at] * after[k % 2][at + 1]
    total = pair.sum(axis=1, keepdims=True)
    return p, np.divide(pair, total, out=np.zeros_like(pair), where=total > 0)


def fit(x: np.ndarray, first: np.ndarray, labels: np.ndarray, steps: int = STEPS) -> Model:
    """Maximum likelihood with a little shrinkage, by Adam. ``labels`` are by chain."""
    if len(np.unique(labels)) < 2:
        return Model.empty(x.shape[1] if x.ndim == 2 else 3 * OWN)
    x = x.astype(np.float64)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    centre[0], scale[0] = 0, 1
    z = (x - centre) / scale
    sizes = np.diff(first)
    y = np.repeat(labels, sizes).astype(float)
    weight = np.repeat(1 / sizes, sizes)
    observed = np.zeros((2, 2))
    for label in (0, 1):
        observed[label, label] = (labels == label).sum()
    opened = np.bincount(labels, minlength=2).astype(float)
    inner = np.ones(len(y), dtype=bool)
    inner[first[1:] - 1] = False
    share = (weight * inner)[:, None]
    observed = np.diag(np.bincount(y[inner].astype(int), weights=weight[inner], minlength=2))
    theta = np.zeros(z.shape[1] + 6)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    n = len(labels)
    ones, zeros = np.ones(z.shape[1]), np.zeros(z.shape[1])
    for step in range(1, steps + 1):
        model = Model(theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:], zeros, ones)
        p, pair = marginals(model, model.evidence(z), first)
        heads = p[first[:-1]]
        gradient = np.concatenate(
            [
                z.T @ ((p - y) * weight),
                (pair * share).sum(axis=0) - observed.ravel(),
                [(1 - heads).sum() - opened[0], heads.sum() - opened[1]],
            ]
        )
        gradient = gradient / n + 1e-3 * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model(theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:], centre, scale)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (quality, text) to stretches of lines: (quality, features)."""
    for batch in batches:
        data, offsets = buffers(batch["text"])
        quality = batch["quality"].to_numpy()
        labels, values = [], []
        for low, high in chunks(offsets):
            lines, x = features(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            for row in range(high - low):
                starts = np.arange(lines.first[row], lines.first[row + 1], SEGMENT_LINES)
                if len(starts) > SEGMENTS:
                    starts = starts[np.linspace(0, len(starts) - 1, SEGMENTS).astype(int)]
                for start in starts.tolist():
                    part = x[start : min(start + SEGMENT_LINES, lines.first[row + 1])]
                    labels.append(int(quality[low + row]))
                    values.append(part.astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(labels, pa.int32()), pa.array(values, pa.binary())], ["quality", "features"]
        )


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model from labels (doc_id, quality) of documents (doc_id, text)."""
    known = pick(labels, "doc_id", "quality").where("doc_id IS NOT NULL AND quality IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    size = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(size) < 2:
        return Model.empty()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    share = F.when(F.col("quality") == 1, min(1.0, per_class / size[1])).otherwise(
        min(1.0, per_class / size[0])
    )
    chosen = known.where(place < share)
    texts = pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.select("quality", "text").mapInArrow(_segments, "quality int, features binary").collect()
    rows.sort(key=lambda r: (r["quality"], r["features"]))
    parts = [np.frombuffer(r["features"], "<f4").reshape(-1, 3 * OWN) for r in rows]
    if not parts:
        return Model.empty()
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return fit(np.concatenate(parts), first, np.array([r["quality"] for r in rows]))


def line_scores(model: Model, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For ranges of texts: the marginals of all lines, their lengths, and the first
    line of each text."""
    data, offsets = buffers(texts)
    for low, high in chunks(offsets):
        lines, x = features(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        p, _ = marginals(model, model.evidence(x), lines.first)
        yield p, lines.ends - lines.starts, lines.first


def quality_score(model):
    """The column function for scores under a broadcast model."""

    def score(texts: pa.Array) -> pa.Array:
        out = []
        for p, size, first in line_scores(model.value, texts):
            weight = size + 1.0
            out.append(np.add.reduceat(p * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]))
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return arrow_udf(score, "double")


def line_quality(model):
    """The column function for the marginals of all lines of a text, in order."""

    def lines(texts: pa.Array) -> pa.Array:
        out = []
        for p, _, first in line_scores(model.value, texts):
            out += [x.tolist() for x in np.split(p, first[1:-1])]
        return pa.array(out, pa.list_(pa.float64()))

    return arrow_udf(lines, "array<double>")


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from 0.5 on)."""
    rows, names = enclose(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = rows.withColumn("score", quality_score(shared)(inner(names, "text")))
    scored = scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    return disclose(scored, names, "score", "predicted")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without those whose score is below 0.5."""
    rows, names = enclose(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return disclose(rows.where(quality_score(shared)(inner(names, "text")) >= 0.5), names)


def held_out(column: str = "doc_id"):
    """Documents whose labels no model may learn from; one without id is none of them."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 3 == 1, F.lit(False))
