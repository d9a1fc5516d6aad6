"""Personal data: patterns, and a skip-chain conditional random field over what looks like it.

Base spans come from patterns. They also supervise the field, whose nodes are a
document's candidate tokens (those with a digit or an at sign) and the tokens
that repeat a part of a base span (the name before an at sign, the last digits
of a number). Adjacent nodes share a potential, and so does each node with the
next one of the same or a similar form, however far away, and each node outside
the base spans with the first base span of every kind that has its form: a
chain through the mentions and a star from each base span, so edges stay linear
in the nodes.

The weights of a node's shape and neighbouring tokens, of adjacent and of
distant label pairs are fitted together, by pseudo-likelihood, to the documents
of a bounded sample: each node is predicted from its neighbours' labels, once
with its own features and once without, as nodes without a digit or an at sign
have none of their own. A mention that shares its form with a base span and is
in none has no known label; it takes no part in the fit. Label pairs have a
prior that equal forms agree.

Loopy sum-product messages make the mentions of an entity agree; nodes in base
spans are clamped, and the other nodes whose marginal of a kind passes the
threshold become spans of that kind.

Null texts count as empty: no spans. Repeated rows give repeated rows; an empty
table an empty result; a null id stays null. A corpus without candidates leaves
the weights at their priors, and only base spans and what repeats them are
found. Every step is linear in a text's length.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import map_arrow
from talkgrain.llm.sampling import least_hashes, within

KINDS = ("email", "ip", "card", "phone")
_FACTS = bytes(b for b in range(256) if b not in b"0123456789@")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match begins where a run of digits begins: from inside one, nothing matches that did not before.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"\S+")
_FACT = re.compile("[0-9@]")
_EDGE = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>"


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of what the patterns find and the checks pass, in order."""
    found, done = [], 0
    for hit in _AT.finditer(text) if "@" in text else ():
        at = start = hit.start()
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at:
            done = hit.end()
            found.append((start, 0, done))
    for hit in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in hit.group().split(".")):
            found.append((hit.start(), 1, hit.end()))
    for hit in _CARD.finditer(text):
        if hit.end() - hit.start() >= 12:
            digits = hit.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((hit.start(), 2, hit.end()))
    for hit in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum("0" <= c <= "9" for c in hit.group()) <= 15:
            found.append((hit.start(), 3, hit.end()))
    return sorted(found)


@dataclass
class Node:
    start: int
    end: int
    token: str
    before: str
    """The token before it, whole."""
    after: str
    label: int
    """-1: not in a base span."""


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in _EDGE:
        start += 1
    while end > start and text[end - 1] in _EDGE:
        end -= 1
    return start, end


def _keys(token: str) -> set[str]:
    """The forms by which tokens are the same or similar."""
    low = token.lower()
    keys = {low}
    digits = "".join(c for c in low if "0" <= c <= "9")
    if len(digits) >= 7:
        keys |= {f"#{digits}", f"#{digits[-7:]}"}
    name, at, _ = low.partition("@")
    if at and _telling(name):
        keys.add(name)
    return keys


def _telling(name: str) -> bool:
    """Whether the part of an address before the at sign can be no plain short word."""
    return len(name) >= 6 or len(name) >= 3 and not name.isalpha()


def nodes_of(text: str, spans: list[tuple[int, int, int]]) -> list[Node]:
    """Candidate tokens, and tokens that repeat a part of a base span; in one pass over the text for all names."""
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    chosen = {k for k, (start, end) in enumerate(tokens) if _FACT.search(text, start, end)}
    names = {text[start:end].partition("@")[0] for start, kind, end in spans if kind == 0}
    names = {name for name in names if _telling(name)}
    if names:
        told = ahocorasick.Automaton()
        for name in names:
            told.add_word(name, len(name))
        told.make_automaton()
        starts = [start for start, _ in tokens]
        for last, size in told.iter(text):
            chosen.add(bisect_right(starts, last - size + 1) - 1)
    nodes, k = [], 0
    for at in sorted(chosen):
        start, end = tokens[at]
        while k < len(spans) and spans[k][2] <= start:
            k += 1
        over, label = k, -1
        while over < len(spans) and spans[over][0] < end:
            if spans[over][2] > start:
                label = spans[over][1]
                break
            over += 1
        left, right = _trimmed(text, start, end)
        if left < right:
            beside = [text[slice(*tokens[n])] if 0 <= n < len(tokens) else "" for n in (at - 1, at + 1)]
            nodes.append(Node(left, right, text[left:right], *beside, label))
    return nodes


def _shape(token: str) -> str:
    shape = "".join("9" if "0" <= c <= "9" else "a" if c.islower() else "A" if c.isalpha() else c for c in token)
    return re.sub(r"(.)\1+", r"\1+", shape)


def features(node: Node, size: int) -> list[int]:
    """Hashed features of a token and the tokens beside it."""
    digits = sum("0" <= c <= "9" for c in node.token)
    names = [
        "1", f"s{_shape(node.token)}", f"d{min(digits, 20)}", f"n{min(len(node.token), 24) // 3}", f"@{'@' in node.token}", f".{min(node.token.count('.'), 4)}", f"+{node.token[0]}",
        f"l{_shape(node.before)}", f"r{_shape(node.after)}", f"w{node.before.lower().strip(_EDGE)}",
    ]
    return [xxhash.xxh32_intdigest(n) % size for n in names]


@dataclass
class Field:
    """Weights of the field: of features by label, of adjacent and of distant label pairs, and of a label without features; label 0 is no kind."""

    weights: np.ndarray
    adjacent: np.ndarray
    distant: np.ndarray
    bare: np.ndarray
    threshold: float = 0.6
    rounds: int = 20

    def local(self, nodes: list[Node]) -> np.ndarray:
        """Tokens without a digit or an at sign have no features: only what they repeat speaks for them."""
        return np.array([self.weights[features(n, len(self.weights))].sum(0) if _FACT.search(n.token) else self.bare for n in nodes])

    @staticmethod
    def edges(nodes: list[Node]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        near = [(k, k + 1) for k in range(len(nodes) - 1) if nodes[k + 1].start - nodes[k].end <= 3]
        last: dict[str, int] = {}
        first: dict[str, dict[int, int]] = {}
        far, keys = set(), [_keys(node.token) for node in nodes]
        for k, node in enumerate(nodes):
            for key in keys[k]:
                if key in last:
                    far.add((last[key], k))
                last[key] = k
                if node.label >= 0:
                    first.setdefault(key, {}).setdefault(node.label, k)
        for k, node in enumerate(nodes):
            if node.label < 0:
                far |= {(min(k, base), max(k, base)) for key in keys[k] for base in first.get(key, {}).values()}
        return near, sorted(far)

    def marginals(self, nodes: list[Node]) -> np.ndarray:
        local = self.local(nodes)
        for k, node in enumerate(nodes):
            if node.label >= 0:
                local[k] = -1e9
                local[k, node.label + 1] = 0
        near, far = self.edges(nodes)
        pairs = np.array([*near, *far], np.int64).reshape(-1, 2)
        n = len(pairs)
        belief = local
        if n:
            tables = np.concatenate([np.repeat(self.adjacent[None], len(near), 0), np.repeat(self.distant[None], len(far), 0)])
            source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
            tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
            message = np.zeros((2 * n, local.shape[1]))
            for _ in range(self.rounds):
                belief = local.copy()
                np.add.at(belief, target, message)
                out = (belief[source] - message[back])[:, :, None] + tables
                top = out.max(1, keepdims=True)
                new = np.log(np.exp(out - top).sum(1)) + top[:, 0]
                new -= new.max(1, keepdims=True)
                change = np.abs(new - message).max()
                message = 0.5 * message + 0.5 * new
                if change < 1e-4:
                    break
            belief = local.copy()
            np.add.at(belief, target, message)
        belief = np.exp(belief - belief.max(1, keepdims=True))
        return belief / belief.sum(1, keepdims=True)

    def added(self, text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans of tokens outside the base spans to which the field gives a kind; adjacent ones of a kind are one."""
        nodes = nodes_of(text, spans)
        if not any(n.label < 0 for n in nodes):
            return []
        found: list[tuple[int, int, int]] = []
        for node, p in zip(nodes, self.marginals(nodes), strict=True):
            kind = int(p[1:].argmax())
            if node.label < 0 and p[kind + 1] >= self.threshold:
                if found and found[-1][1] == kind and node.start - found[-1][2] <= 3:
                    found[-1] = (found[-1][0], kind, node.end)
                else:
                    found.append((node.start, kind, node.end))
        return found


@dataclass
class Sample:
    """Nodes of all sampled documents: labels, which of them are known, feature ids, adjacent and distant pairs of nodes."""

    labels: np.ndarray
    known: np.ndarray
    ids: np.ndarray
    near: np.ndarray
    far: np.ndarray

    @staticmethod
    def gather(rows: list) -> Sample:
        labels = np.array([y for row in rows for y in row.labels], np.int64)
        starts = np.cumsum([0, *(len(row.labels) for row in rows)])
        pairs = lambda name: np.array([v + at for row, at in zip(rows, starts) for v in getattr(row, name)], np.int64).reshape(-1, 2)
        near, far = pairs("near"), pairs("far")
        known = np.ones(len(labels), bool)
        # What shares a base span's form and is in none: the patterns miss it, so its label says nothing.
        one_sided = far[(labels[far] > 0).sum(1) == 1].ravel()
        known[one_sided[labels[one_sided] == 0]] = False
        both = lambda p: p[known[p].all(1)]
        ids = np.array([f for row in rows for f in row.ids], np.int64).reshape(len(labels), -1 if rows else 1)
        return Sample(labels, known, ids, both(near), both(far))


#: What is believed of pairs before any are seen: nothing of adjacent ones, agreement of distant ones.
PRIOR_AGREEMENT = 2.5


def fit(sample: Sample, *, size: int, epochs: int = 80, rate: float = 0.5, ridge: float = 1e-4, pair_ridge: float = 1e-3) -> Field:
    """Pseudo-likelihood with quadratic penalties towards the priors, by adaptive gradient steps."""
    n_labels = len(KINDS) + 1
    weights, bare, prior = np.zeros((size, n_labels)), np.zeros(n_labels), np.eye(n_labels) * PRIOR_AGREEMENT
    adjacent, distant = np.zeros((n_labels, n_labels)), prior.copy()
    n = int(sample.known.sum())
    if not n:
        return Field(weights, adjacent, distant, bare)
    y, one_hot = sample.labels, np.eye(n_labels)[sample.labels]
    (left, right), (one, other) = sample.near.T, sample.far.T
    flat, width = sample.ids.ravel(), sample.ids.shape[1]
    squares = [np.full_like(t, 1e-6) for t in (weights, adjacent, distant, bare)]

    def summed(at: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
        return np.stack([np.bincount(at, values[:, k], rows) for k in range(n_labels)], 1)

    def error(logits: np.ndarray) -> np.ndarray:
        p = np.exp(logits - logits.max(1, keepdims=True))
        return (p / p.sum(1, keepdims=True) - one_hot) * sample.known[:, None] / n

    for _ in range(epochs):
        told = summed(left, adjacent[:, y[right]].T, len(y)) + summed(right, adjacent[y[left]], len(y)) + summed(one, distant[y[other]], len(y)) + summed(other, distant[y[one]], len(y))
        whole, plain = error(weights[sample.ids].sum(1) + told), error(bare + told)
        both = whole + plain
        pairs = summed(y[one], both[other], n_labels) + summed(y[other], both[one], n_labels)
        steps = [
            summed(flat, np.repeat(whole, width, 0), size) + ridge * weights, summed(y[right], both[left], n_labels).T + summed(y[left], both[right], n_labels) + pair_ridge * adjacent,
            (pairs + pairs.T) / 2 + pair_ridge * (distant - prior), plain.sum(0) + ridge * bare,
        ]
        for table, step, square in zip((weights, adjacent, distant, bare), steps, squares, strict=True):
            square += step * step
            table -= rate * step / np.sqrt(square)
    return Field(weights, adjacent, distant, bare)


def train(docs: DataFrame, *, text_col: str = "text", sample_documents: int = 2_000, max_chars: int = 40_000_000, size: int = 4_096, epochs: int = 80) -> Field:
    """Fit the field to all nodes of at most ``sample_documents`` different texts with a digit or an at sign, those of the least hashes, of ``max_chars`` characters in all."""
    rows = docs.select(F.col(text_col).cast("string").alias("_text")).where(F.col("_text").rlike("[0-9@]"))
    rows = within(least_hashes(rows, ["_text"], limit=sample_documents), ["_text"], max_chars)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], []]
        for raw in batch.column(0).cast(pa.binary()).to_pylist():
            text = raw.decode("utf-8", "replace")
            nodes = nodes_of(text, base_spans(text))
            adjacent, distant = Field.edges(nodes)
            found = [n.label + 1 for n in nodes], [f for n in nodes for f in features(n, size)], [v for pair in adjacent for v in pair], [v for pair in distant for v in pair]
            for column, value in zip(columns, found, strict=True):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int32())) for c in columns], ["labels", "ids", "near", "far"])

    found = map_arrow(rows, run, "labels array<int>, ids array<int>, near array<int>, far array<int>").collect()
    return fit(Sample.gather(sorted(found)), size=size, epochs=epochs)


def find_pii(docs: DataFrame, field: Field | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``; the field is fitted to ``docs`` unless given."""
    field = field or train(docs, text_col=text_col)
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, spans, added = np.zeros((4, batch.num_rows), np.int64), [], [], []
        join = lambda found: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)
        nothing = hashlib.sha256(b"").hexdigest()
        for row, raw in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
            if not raw or not raw.translate(None, _FACTS):
                digests.append(nothing)
                spans.append("")
                added.append(0)
                continue
            text = raw.decode("utf-8", "replace")
            base = base_spans(text)
            more = field.added(text, base)
            for _, k, _ in base:
                counts[k, row] += 1
            digests.append(hashlib.sha256(join(base).encode()).hexdigest())
            spans.append(join(sorted([*base, *more])))
            added.append(len(more))
        return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts), pa.array(digests), pa.array(spans), pa.array(added, pa.int64())], [id_col, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return map_arrow(rows, run, f"`{id_col}` {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint")


def masked(docs: DataFrame, field: Field | None = None, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every span's text replaced by its kind in brackets; nulls stay."""
    field = field or train(docs, text_col=text_col)
    where = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for raw in batch.column(where).cast(pa.binary()).to_pylist():
            if raw and raw.translate(None, _FACTS):
                text = raw.decode("utf-8", "replace")
                base = base_spans(text)
                parts, at = [], 0
                for start, k, end in sorted([*base, *field.added(text, base)]):
                    if end > at:
                        parts += [text[at : max(start, at)], f"[{KINDS[k].upper()}]" if start >= at else ""]
                        at = end
                raw = ("".join(parts) + text[at:]).encode()
            texts.append(raw)
        columns = list(batch.columns)
        columns[where] = pa.array(texts, pa.binary()).cast(batch.schema.types[where])
        return pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_arrow(docs, run, docs.schema)
