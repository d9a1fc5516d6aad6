"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features, binned at the quantiles of the
training lines, are what it and the lines beside it are made of: length, case,
symbols, repeated words. The chain's transitions carry a verdict from line to
line; forward-backward gives each line's probability of being good, and a
document's score is their mean, weighted by the lines' lengths.

The training labels are those of documents: each line of a labelled document
has its label. So no training chain changes its label, and the fit would let
the transitions grow without bound; they are kept within 3, which is what a
verdict's persistence is worth here. Null texts count as empty, and an empty text as one empty line.
Repeated rows give repeated rows; an empty table an empty result; a null id
stays null (and counts as held out). With labels of one kind only, or none,
every score is the share of good labels, or 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import discard, held_out, map_arrow, window_hashes, word_hashes
from talkgrain.llm.sampling import labelled_sample

FEATURES = ("words", "word_length", "capitals", "symbols", "marks", "digits", "beyond_ascii", "distinct", "adjacent", "windows", "lone_signs", "ended", "seen")
_UPPER, _SYMBOLS, _MARKS, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#*$%&|<>~^=_\\/{}[]", b"!?", b"0123456789"
_HIGH = bytes(range(128, 256))


def line_features(line: bytes, seen: bool) -> list[float]:
    words, size = line.split(), max(len(line), 1)
    n = len(words)
    share = lambda chars: (len(line) - len(line.translate(None, chars))) / size
    distinct = len(set(words)) / n if n else 1.0
    adjacent = windows = 0.0
    if n > 1 and distinct < 1:
        adjacent = sum(map(bytes.__eq__, words, words[1:])) / n
    if n > 8 and distinct < 0.9:
        hashes = window_hashes(word_hashes(words), 4)
        windows = 1 - len(np.unique(hashes)) / len(hashes)
    return [
        n, len(line) / max(n, 1), share(_UPPER), share(_SYMBOLS), share(_MARKS), share(_DIGITS), share(_HIGH), distinct, adjacent, windows,
        sum(len(w) == 1 for w in words) / n if n else 0.0, float(line.rstrip()[-1:] in (b".", b"!", b"?", b":")), float(seen),
    ]


def lines_of(text: bytes) -> list[bytes]:
    return [line for line in text.split(b"\n") if line.strip()] or [b""]


def document_features(lines: list[bytes]) -> list[list[float]]:
    seen: set[bytes] = set()
    rows = []
    for line in lines:
        rows.append(line_features(line, line in seen))
        seen.add(line)
    return rows


def forward_backward(scores: np.ndarray, sizes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of label 1 by line, expected label pairs, and the sum of log-partitions, for chains laid end to end.

    ``scores``: of label 1 against 0. All chains advance together, the longest
    first, so that each step works on those that go on.
    """
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    lengths = sizes[order]
    alpha, beta = np.zeros((len(scores), 2)), np.zeros((len(scores), 2))
    alpha[starts, 1] = scores[starts]
    steps = [int(np.searchsorted(-lengths, -k, "left")) for k in range(1, int(lengths[0]) if len(lengths) else 1)]
    for k, going in enumerate(steps, 1):
        at = starts[:going] + k
        before = alpha[at - 1]
        alpha[at, 0] = np.logaddexp(before[:, 0] + table[0, 0], before[:, 1] + table[1, 0])
        alpha[at, 1] = np.logaddexp(before[:, 0] + table[0, 1], before[:, 1] + table[1, 1]) + scores[at]
    for k, going in reversed(list(enumerate(steps, 1))):
        at = starts[:going] + k
        zero, one = beta[at, 0], beta[at, 1] + scores[at]
        beta[at - 1, 0] = np.logaddexp(table[0, 0] + zero, table[0, 1] + one)
        beta[at - 1, 1] = np.logaddexp(table[1, 0] + zero, table[1, 1] + one)
    total = alpha + beta
    whole = np.logaddexp(total[:, 0], total[:, 1])
    marginal = np.exp(total[:, 1] - whole)
    inner = np.ones(len(scores), bool)
    inner[np.cumsum(sizes) - sizes] = False
    at = np.flatnonzero(inner)
    pairs = np.array([[np.exp(alpha[at - 1, a] + table[a, b] + beta[at, b] + b * scores[at] - whole[at]).sum() for b in (0, 1)] for a in (0, 1)])
    ends = np.cumsum(sizes) - 1
    return marginal, pairs, float(whole[ends].sum())


@dataclass
class LineField:
    edges: list[np.ndarray]
    weights: np.ndarray
    table: np.ndarray
    bias: float
    constant: float | None = None

    def columns(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The active binned features of each line, of the line before and of the line after; the last of each block is "no line"."""
        width = len(self.weights) // 3
        offset, own = 0, []
        for k, edges in enumerate(self.edges):
            own.append(offset + np.searchsorted(edges, x[:, k], "right"))
            offset += len(edges) + 1
        own = np.stack(own, 1)
        first = np.zeros(len(x), bool)
        last = np.zeros(len(x), bool)
        first[np.cumsum(sizes) - sizes] = True
        last[np.cumsum(sizes) - 1] = True
        before, after = np.roll(own, 1, 0) + width, np.roll(own, -1, 0) + 2 * width
        before[first] = 2 * width - 1
        after[last] = 3 * width - 1
        return np.concatenate([own, before, after], 1)

    def line_scores(self, columns: np.ndarray) -> np.ndarray:
        return self.weights[columns].sum(1) + self.bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None or not texts:
            return np.full(len(texts), self.constant or 0.0)
        documents = [lines_of(t) for t in texts]
        sizes = np.array([len(d) for d in documents])
        x = np.array([row for d in documents for row in document_features(d)])
        marginal, _, _ = forward_backward(self.line_scores(self.columns(x, sizes)), sizes, self.table)
        weight = np.array([max(len(line), 1) for d in documents for line in d], float)
        at = np.repeat(np.arange(len(texts)), sizes)
        return np.clip(np.bincount(at, weight * marginal) / np.bincount(at, weight), 0, 1)


def fit(x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, *, n_bins: int = 10, epochs: int = 80, rate: float = 0.3, ridge: float = 1.0) -> LineField:
    """Maximum likelihood with a quadratic penalty, by adaptive gradient steps."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, n_bins + 1)[1:])) for k in range(x.shape[1])]
    width = sum(len(e) + 1 for e in edges) + 1
    field = LineField(edges, np.zeros(3 * width), np.zeros((2, 2)), 0.0)
    columns, y = field.columns(x, sizes), np.repeat(labels, sizes).astype(float)
    inner = np.ones(len(x), bool)
    inner[np.cumsum(sizes) - sizes] = False
    same = np.bincount(np.repeat(labels, sizes - 1).astype(int), minlength=2)
    observed = np.diag(same.astype(float))
    n, flat = len(x), columns.ravel()
    squares, table_squares, bias_square = np.full(3 * width, 1e-8), np.full((2, 2), 1e-8), 1e-8
    for _ in range(epochs):
        marginal, pairs, _ = forward_backward(field.line_scores(columns), sizes, field.table)
        error = marginal - y
        step = (np.bincount(flat, np.repeat(error, columns.shape[1]), 3 * width) + ridge * field.weights) / n
        table_step = (pairs - observed + ridge * field.table) / n
        squares, table_squares, bias_square = squares + step**2, table_squares + table_step**2, bias_square + error.mean() ** 2
        field.weights -= rate * step / np.sqrt(squares)
        field.table = np.clip(field.table - rate * table_step / np.sqrt(table_squares), -3, 3)
        field.bias -= rate * error.mean() / np.sqrt(bias_square)
    return field


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", sample_documents: int = 4_000, max_chars: int = 40_000_000, id_col: str = "doc_id", text_col: str = "text") -> LineField:
    """Fit to all lines of at most ``sample_documents`` labelled rows that are not held out, of ``max_chars`` characters in all."""
    sample = labelled_sample(docs, labels, label=label, limit=sample_documents, max_chars=max_chars, id_col=id_col, text_col=text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [np.array(document_features(lines_of(raw or b"")), np.float64).ravel() for raw in batch.column(0).cast(pa.binary()).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.float64()))], ["label", "x"])

    rows = map_arrow(sample.select("_text", "_label"), run, "label int, x array<double>").orderBy("label", "x").toPandas()
    discard(sample)
    good = rows["label"].to_numpy(int) > 0
    if good.all() or not good.any():
        return LineField([], np.zeros(0), np.zeros((2, 2)), 0.0, float(good.mean()) if len(good) else 0.0)
    sizes = np.array([len(x) // len(FEATURES) for x in rows["x"]])
    return fit(np.concatenate(list(rows["x"])).reshape(-1, len(FEATURES)), sizes, good.astype(int))


def score(docs: DataFrame, field: LineField, *, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, score, predicted`` of every document; from the text alone."""
    rows = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = shared.value.scores([t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], [id_col, "held_out", "score", "predicted"])

    return map_arrow(rows, run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")
