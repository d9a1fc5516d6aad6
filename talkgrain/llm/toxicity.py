"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The labelled sample is split by a hash of the ids. One part yields a lexicon:
words and beginnings of words that toxic documents have far more often than
the others. The trees are fitted to a second part, over lexicon densities, how
near lexicon words stand to words that address the reader, capitals,
punctuation and obfuscated spellings; the third part calibrates their margin
by a monotone step function. No part is used twice, so the lexicon's luck on
its own rows fools neither trees nor calibration.

Null texts count as empty and get the score of an empty text. Repeated rows
give repeated rows; an empty table an empty result; a null id stays null (and
counts as held out). With no labels of either kind every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import discard, held_out, map_arrow
from talkgrain.llm.sampling import labelled_sample

#: Words that address the reader, in the corpus's languages (fixed values).
SECOND_PERSON = frozenset("you your yours yourself yourselves u ur du dich dir dein deine deinen deinem deiner ihr euch euer eure tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro vuestra".split())
#: Signs that stand for letters in obfuscated spellings (fixed values).
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "_": "", "-": "", ".": ""})
FEATURES = ("hits", "density", "strongest", "weight", "distinct", "strong", "nearness", "second_person", "capitals", "exclamations", "questions", "punctuation", "obfuscated", "hidden_hits", "length")
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PUNCTUATION = b",.;:-()[]{}\"'"
_EDGES = ".,;:!?\"'()[]{}<>«»¡¿*_-"
_MIXED = re.compile(r"[^\W\d_][0-9@$!*_.-]+[^\W\d_]")


def entries(word: str, shortest: int = 3, longest: int = 8) -> list[str]:
    """A word, marked as whole, and its beginnings."""
    return [f"{word}$", *(word[:n] for n in range(shortest, min(len(word), longest) + 1))]


def _bare(token: str) -> str:
    return token.strip(_EDGES)


class Lexicon:
    """Weights of words, by the heaviest of their entries."""

    LIMIT = 300_000

    def __init__(self, weights: dict[str, float], strong: float = 3.0) -> None:
        self.weights, self.strong = weights, strong
        self.seen: dict[str, tuple[float, int]] = {}

    def __reduce__(self):
        return Lexicon, (self.weights, self.strong)

    def weight(self, word: str) -> float:
        get = self.weights.get
        return max((get(e, 0.0) for e in entries(word)), default=0.0)

    def look(self, token: str) -> tuple[float, int]:
        """A lower-cased token's weight, and flags: 1 addresses the reader, 2 obfuscated, 4 a hit only when read plainly."""
        known = self.seen.get(token)
        if known is None:
            if len(self.seen) >= self.LIMIT:
                self.seen.clear()
            word = _bare(token)
            weight, flags = self.weight(word), int(word in SECOND_PERSON)
            if _MIXED.search(word) and not word.replace(".", "").replace("-", "").isalpha():
                flags |= 2
                plain = self.weight(word.translate(LOOKALIKES))
                if plain > weight:
                    weight, flags = plain, flags | 4
            known = self.seen[token] = weight, flags
        return known

    def features(self, raw: bytes) -> list[float]:
        tokens = raw.decode("utf-8", "replace").lower().split()
        look, seen = self.look, self.seen.get
        looked = [seen(t) or look(t) for t in tokens]
        n, size = max(len(tokens), 1), max(len(raw), 1)
        hits = [k for k, (w, _) in enumerate(looked) if w > 0]
        heavy = [looked[k][0] for k in hits]
        flagged = [(k, f) for k, (_, f) in enumerate(looked) if f]
        address = np.array([k for k, f in flagged if f & 1])
        near = 0.0
        if hits and len(address):
            at = np.searchsorted(address, hits)
            gaps = np.minimum(np.abs(address[np.minimum(at, len(address) - 1)] - hits), np.abs(address[np.maximum(at - 1, 0)] - hits))
            near = math.exp(-float(gaps.min()) / 5)
        share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / size
        return [
            math.log1p(len(hits)), len(hits) / n, max(heavy, default=0.0), sum(heavy) / n, math.log1p(len({_bare(tokens[k]) for k in hits})), math.log1p(sum(w >= self.strong for w in heavy)), near, len(address) / n,
            share(_UPPER), share(b"!"), share(b"?"), share(_PUNCTUATION), sum(bool(f & 2) for _, f in flagged) / n, float(sum(bool(f & 4) for _, f in flagged)), math.log1p(len(tokens)),
        ]


#: Parts of the sample; what is said about a part is learned from the others.
FOLDS = 4


def learn_lexicons(sample: DataFrame, *, most_entries: int = 4_000, least_weight: float = math.log(8)) -> list[Lexicon]:
    """Entries that toxic documents have at least ``exp(least_weight)`` times as often as the others: for each of ``_fold`` from the others, and last from all.

    Documents of all folds are counted in one pass, and then those that hold what toxic ones have.
    """

    def counting(wanted: frozenset | None):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts: Counter = Counter()
            for raw, fold in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {_bare(t) for t in (raw or b"").decode("utf-8", "replace").lower().split()}
                counts.update({(e, fold) for w in words if w for e in entries(w) if wanted is None or e in wanted})
            return pa.RecordBatch.from_arrays([pa.array([e for e, _ in counts], pa.string()), pa.array([f for _, f in counts], pa.int32()), pa.array(counts.values(), pa.int64())], ["entry", "fold", "n"])

        return run

    totals = np.zeros((2, FOLDS), np.int64)
    for r in sample.groupBy("_label", "_fold").agg(F.count("*").alias("n")).collect():
        totals[r["_label"], r["_fold"]] = r["n"]

    def tally(label: int, wanted: frozenset | None, least: int = 0) -> dict[str, np.ndarray]:
        told = map_arrow(sample.where(F.col("_label") == label).select("_text", "_fold"), counting(wanted), "entry string, fold int, n bigint")
        each = told.groupBy("entry").agg(*[F.coalesce(F.sum(F.when(F.col("fold") == k, F.col("n"))), F.lit(0)).alias(f"n{k}") for k in range(FOLDS)])
        total = sum((F.col(f"n{k}") for k in range(FOLDS)), F.lit(0))
        return {r.entry: np.array([r[f"n{k}"] for k in range(FOLDS)]) for r in each.where(total >= least).orderBy(total.desc(), "entry").limit(50_000).collect()}

    all_toxic = int(totals[1].sum())
    least_of = lambda toxic: max(2, min(4, toxic // 8), toxic // 500)
    often = tally(1, None, least_of(all_toxic)) if all_toxic else {}
    others = tally(0, frozenset(often)) if often else {}
    nothing, found = np.zeros(FOLDS, np.int64), []
    for left_out in [*range(FOLDS), None]:
        kept = np.arange(FOLDS) != left_out if left_out is not None else np.ones(FOLDS, bool)
        toxic, clean = int(totals[1][kept].sum()), int(totals[0][kept].sum())
        there = {e: int(n[kept].sum()) for e, n in often.items()} if toxic and clean else {}
        there = {e: n for e, n in there.items() if n >= least_of(toxic)}
        weights = {e: math.log((n + 0.5) / (toxic + 1)) - math.log((int(others.get(e, nothing)[kept].sum()) + 0.5) / (clean + 1)) for e, n in there.items()}
        best = sorted((e for e, w in weights.items() if w >= least_weight), key=lambda e: (-weights[e] * math.sqrt(there[e]), e))[:most_entries]
        found.append(Lexicon({e: weights[e] for e in best}))
    return found


@dataclass
class Trees:
    """Boosted regression trees of logistic loss over binned features; every tree is complete, of one depth."""

    edges: list[np.ndarray] = field(default_factory=list)
    feature: list[np.ndarray] = field(default_factory=list)
    limit: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], 1).astype(np.int32)

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins, total = self.binned(x), np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            while at.size and at[0] < len(feature):
                at = 2 * at + 1 + (bins[rows, feature[at]] > limit[at])
            total += leaf[at - len(feature)]
        return total

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, *, rounds: int = 60, depth: int = 3, rate: float = 0.2, n_bins: int = 32, ridge: float = 2.0, least: float | None = None) -> Trees:
        trees = Trees([np.unique(np.quantile(x[:, k], np.linspace(0, 1, n_bins + 1)[1:-1])) for k in range(x.shape[1])])
        prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        trees.start = math.log(prior / (1 - prior))
        if least is None:  # what a leaf needs follows the labels there are
            least = float(np.clip(len(y) * prior * (1 - prior) / 50, 0.5, 5.0))
        bins, total = trees.binned(x), np.full(len(y), trees.start)
        n_inner, n_features, rows = 2**depth - 1, x.shape[1], np.arange(len(y))
        offsets = np.arange(n_features) * n_bins
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-total))
            gradient, curve = p - y, np.maximum(p * (1 - p), 1e-6)
            feature, limit, at = np.zeros(n_inner, np.int64), np.full(n_inner, n_bins, np.int64), np.zeros(len(y), np.int64)
            for level in range(depth):
                first, n_nodes = 2**level - 1, 2**level
                cell = ((at - first)[:, None] * n_features * n_bins + offsets + bins).ravel()
                shape = (n_nodes, n_features, n_bins)
                g = np.bincount(cell, np.repeat(gradient, n_features), n_nodes * n_features * n_bins).reshape(shape).cumsum(2)
                h = np.bincount(cell, np.repeat(curve, n_features), n_nodes * n_features * n_bins).reshape(shape).cumsum(2)
                g_all, h_all = g[:, :, -1:], h[:, :, -1:]
                gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
                gain[(h < least) | (h_all - h < least)] = 0
                best = gain.reshape(n_nodes, -1).argmax(1)
                useful = gain.reshape(n_nodes, -1).max(1) > 1e-9
                nodes = np.arange(first, first + n_nodes)
                feature[nodes] = best // n_bins
                limit[nodes] = np.where(useful, best % n_bins, n_bins)
                at = 2 * at + 1 + (bins[rows, feature[at]] > limit[at])
            g, h = np.bincount(at - n_inner, gradient, n_inner + 1), np.bincount(at - n_inner, curve, n_inner + 1)
            leaf = -rate * g / (h + ridge)
            total += leaf[at - n_inner]
            trees.feature.append(feature)
            trees.limit.append(limit)
            trees.leaf.append(leaf)
        return trees


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the knots (margin, value) of the best monotone fit."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []
    for m, v in zip(margin[order], y[order], strict=True):
        blocks.append([float(v), 1.0, float(m), float(m)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, n, _, high = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + n, blocks[-1][2], high]
    knots = [(m, (total + 0.02) / (n + 0.04)) for total, n, low, high in blocks for m in (low, high)]
    return np.array([k[0] for k in knots]), np.maximum.accumulate([k[1] for k in knots])


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.zeros(len(texts))
        margin = self.trees.margin(np.array([self.lexicon.features(t) for t in texts]))
        if self.knots is None:
            return 1 / (1 + np.exp(-margin))
        return np.clip(np.interp(margin, *self.knots), 0, 1)


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", sample_documents: int = 20_000, max_chars: int = 200_000_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit to at most ``sample_documents`` labelled rows, of ``max_chars`` characters in all, by cross-fitting.

    A row's features come from a lexicon that the other folds' rows gave, and the
    margin that the calibration sees from trees of the other folds; the model's own lexicon
    and trees are those of all rows. So every label serves all three, and none judges itself.
    """
    written = labelled_sample(docs, labels, label=label, limit=sample_documents, max_chars=max_chars, id_col=id_col, text_col=text_col)
    sample = written.withColumn("_fold", F.col("_part") % FOLDS)
    *lexicons, lexicon = learn_lexicons(sample)
    names = [f"f{k}" for k in range(len(FEATURES))]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, folds = batch.column(0).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()
        x = np.array([lexicons[fold].features(raw or b"") for raw, fold in zip(texts, folds, strict=True)])
        return pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *(pa.array(x[:, k]) for k in range(x.shape[1]))], ["_label", "_fold", *names])

    rows = map_arrow(sample.select("_text", "_label", "_fold"), run, "_label int, _fold int, " + ", ".join(f"{n} double" for n in names)).orderBy("_fold", *names, "_label").toPandas()
    discard(written)
    x, y, fold = rows[names].to_numpy(), rows["_label"].to_numpy(float), rows["_fold"].to_numpy()
    if len(set(y)) < 2:
        return Model(lexicon, None, None)
    margin = np.full(len(y), np.nan)
    for k in range(FOLDS):
        if len(set(y[fold != k])) == 2 and (fold == k).any():
            margin[fold == k] = Trees.fit(x[fold != k], y[fold != k]).margin(x[fold == k])
    judged = ~np.isnan(margin)
    knots = isotonic(margin[judged], y[judged]) if len(set(y[judged])) == 2 else None
    return Model(lexicon, Trees.fit(x, y), knots)


def score(docs: DataFrame, model: Model, *, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, score, predicted`` of every document; from the text alone."""
    rows = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = shared.value.scores([t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], [id_col, "held_out", "score", "predicted"])

    return map_arrow(rows, run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")
