"""Exact token counts at every prefix, by dynamic programming over byte-pair encodings.

A byte-level byte-pair encoding has one last token for every prefix of a
piece, and the encoding of the prefix is that of what precedes this token,
followed by it. A token may follow another one exactly if the two, encoded
together, stay as they are. So one pass over a piece gives the token count of
each of its prefixes. Pieces are what the tokenizer's pattern splits a text
into; their tables are kept, so that a text's table is a concatenation of
tables of pieces, with a correction where a prefix ends in a run of white
space or inside a special string, which the pattern splits differently from
the whole text.

The table is stored as one signed byte for each code point: by how much the
count grows with it. ``n_tokens`` is its sum; ``tokens_at`` and
``longest_prefix`` answer questions about prefixes without encoding again.

Nulls count as empty texts (0 bytes, 0 tokens); repeated rows give repeated
rows; an empty table gives an empty table; a null id stays null.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import map_arrow

#: The pattern that byte-level tokenizers of this family split a text by (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Contractions whose prefix of two characters is two pieces (fixed value).
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in a byte-level vocabulary: letter -> byte."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(moved)}


class PrefixCounter:
    """Token counts of all prefixes under one vocabulary."""

    KEPT = 1_000_000
    #: Characters of all pieces whose tables are kept, and of one such piece.
    KEPT_CHARS, LONGEST_KEPT = 16_000_000, 200

    def __init__(self, tokens: list[bytes], special: tuple[str, ...] = ()) -> None:
        """``tokens``: the 256 bytes first, then what is merged, in the order of merging."""
        self.halves: list[tuple[int, int]] = [(-1, -1)] * 256
        self.merged: dict[tuple[int, int], int] = {}
        self.ids = {token: k for k, token in enumerate(tokens[:256])}
        self.follows: dict[int, bool] = {}
        self.trie: dict = {}
        for k, token in enumerate(tokens):
            node = self.trie
            for byte in token:
                node = node.setdefault(byte, {})
            node[-1] = k
        for k in range(256, len(tokens)):
            self._learn(k, tokens[k])
        self.tables: dict[str, bytes] = {}
        self.kept_chars = 0
        self.pieces = regex.compile(PATTERN).findall
        self.gaps = regex.compile(r"\s{2,}(?=\S)").finditer
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.special_strings = special

    def _learn(self, k: int, token: bytes) -> None:
        """Find the two tokens that become the next one: the ends of its encoding so far."""
        parts = [self.ids[token[i : i + 1]] for i in range(len(token))]
        while len(parts) > 2:
            across, at = min((self.merged.get(pair, 1 << 40), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if across == 1 << 40:
                raise ValueError(f"token {k} is not two earlier tokens")
            parts[at : at + 2] = [across]
        self.halves.append((parts[0], parts[1]))
        self.merged[parts[0], parts[1]] = self.ids[token] = k

    @staticmethod
    @lru_cache(maxsize=4)
    def load(path: str) -> PrefixCounter:
        """From a ``tokenizers`` file of a byte-level BPE; other files, whose splitting is not known, raise."""
        if not path.endswith(".json"):
            raise ValueError(f"{path} does not say by which pattern texts are split")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        letters = _byte_letters()
        as_bytes = lambda text: bytes(letters[c] for c in text)
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        return PrefixCounter([*(bytes([b]) for b in range(256)), *(as_bytes(a + b) for a, b in pairs)], tuple(t["content"] for t in spec.get("added_tokens") or ()))

    def can_follow(self, left: int, right: int) -> bool:
        """Whether two tokens, encoded together, stay as they are.

        They don't if a merge across their border comes before the merges that
        made the parts beside it. So take the border's two parts back, the one
        merged last first, and see whether a merge across comes earlier.
        """
        merged, halves = self.merged, self.halves
        before = len(halves)
        while True:
            across = merged.get((left, right))
            if across is not None and across < before:
                return False
            # Of equal parts the left one was merged first: a later merge of the right one still sees it.
            if left > right:
                first, second = halves[left][1], halves[right][0]
                if first >= 0:
                    before, left = left, first
                elif second >= 0:
                    before, right = right + 1, second
                else:
                    return True
            else:
                first, second = halves[right][0], halves[left][1]
                if first >= 0:
                    before, right = right + 1, first
                elif second >= 0:
                    before, left = left, second
                else:
                    return True

    def counts(self, piece: bytes) -> list[int]:
        """The token count of every prefix of a piece, in bytes; that of the empty prefix first."""
        counts, last, follows, trie = [0], [-1], self.follows, self.trie
        open_: list[tuple[int, dict]] = []
        for end, byte in enumerate(piece):
            # From each start at which a token may still go on, the longest first.
            open_.append((end, trie))
            going, found = [], False
            for start, node in open_:
                node = node.get(byte)
                if node is None:
                    continue
                going.append((start, node))
                token = node.get(-1)
                if found or token is None:
                    continue
                if start:
                    pair = last[start] << 32 | token
                    found = follows.get(pair)
                    if found is None:
                        if len(follows) > self.KEPT:
                            follows.clear()
                        found = follows[pair] = self.can_follow(last[start], token)
                    if not found:
                        continue
                found = True
                counts.append(counts[start] + 1)
                new = token
            last.append(new)
            open_ = going
        return counts

    def table(self, piece: str) -> bytes:
        """By how much the count of a piece's prefixes grows with each character."""
        known = self.tables.get(piece)
        if known is None:
            raw = piece.encode()
            counts = self.counts(raw)
            if len(raw) != len(piece):
                starts = [k for k, b in enumerate(raw) if b & 0xC0 != 0x80]
                counts = [counts[k] for k in [*starts, len(raw)]]
            if piece in LONG_CONTRACTIONS:
                counts[2] = counts[1] + self.counts(raw[1:2])[1]
            known = bytes([(after - before) & 255 for before, after in zip(counts, counts[1:])])
            if len(piece) <= self.LONGEST_KEPT:
                if len(self.tables) >= self.KEPT or self.kept_chars > self.KEPT_CHARS:
                    self.tables.clear()
                    self.kept_chars = 0
                self.tables[piece] = known
                self.kept_chars += len(piece)
        return known

    def _segment(self, text: str) -> np.ndarray:
        tables, table = self.tables, self.table
        joined = b"".join([tables.get(p) or table(p) for p in self.pieces(text)])
        grown = np.frombuffer(joined, np.int8)
        for gap in self.gaps(text):
            if grown.base is joined or not grown.flags.writeable:
                grown = grown.copy()
            start, end = gap.span()
            # A prefix that ends with this run has it as one piece.
            whole = self.counts(text[start:end].encode())[-1]
            change = whole - int(grown[start:end].sum())
            grown[end - 1] += change
            grown[end] -= change
        return grown

    def prefixes(self, text: str) -> np.ndarray:
        """For each character of a text, by how much the token count of its prefixes grows."""
        if self.special is None or not any(s in text for s in self.special_strings):
            return self._segment(text)
        parts, at = [], 0
        for hit in self.special.finditer(text):
            before = text[at : hit.start()]
            grown = self._segment(before)
            parts.append(grown)
            # Prefixes that end inside the special string take its start as ordinary text.
            pieces = self.pieces(before)
            tail = pieces[-1] if pieces else ""
            # The piece as such: what a run of white space before it adds and takes again is no part of it.
            base = int(grown.sum(dtype=np.int64)) - int(np.frombuffer(self.table(tail), np.int8).sum(dtype=np.int64)) if tail else 0
            counts = [int(grown.sum())]
            for k in range(1, hit.end() - hit.start()):
                counts.append(base + int(self._segment(tail + hit.group()[:k]).sum()))
            counts.append(counts[0] + 1)
            parts.append(np.diff(np.array(counts)).astype(np.int8))
            at = hit.end()
        parts.append(self._segment(text[at:]))
        return np.concatenate(parts)

    def count(self, text: str) -> int:
        return int(self.prefixes(text).sum(dtype=np.int64))


def tokens_at(prefix: bytes, n_chars: int) -> int:
    """How many tokens the first ``n_chars`` code points of a text have."""
    return int(np.frombuffer(prefix, np.int8)[: max(n_chars, 0)].sum(dtype=np.int64))


def longest_prefix(prefix: bytes, budget: int) -> int:
    """The most code points of a text that have ``budget`` tokens at most."""
    counts = np.concatenate([[0], np.cumsum(np.frombuffer(prefix, np.int8), dtype=np.int64)])
    return int(np.flatnonzero(counts <= budget)[-1]) if budget >= 0 else 0


def prefix_token_counts(docs: DataFrame, tokenizer: str, *, budget: int | None = None, id_col: str = "doc_id", text_col: str = "text", keep_prefixes: bool = True) -> DataFrame:
    """``id_col, n_bytes, n_tokens``, if kept ``prefix``, the table of each text, and with a budget ``budget_chars``.

    ``budget_chars`` is the most code points that a prefix of ``budget`` tokens
    has, read from the table. ``tokenizer`` is a file that every executor can
    read, such as one of an installed package.
    """
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = PrefixCounter.load(tokenizer)
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
        counts, kept, within = [], [], []
        for text in batch.column(1).to_pylist():
            grown = counter.prefixes(text or "")
            counts.append(int(grown.sum(dtype=np.int64)))
            if keep_prefixes:
                kept.append(grown.tobytes())
            if budget is not None:
                within.append(len(grown) if counts[-1] <= budget else longest_prefix(grown.tobytes(), budget))
        columns, names = [batch.column(0), sizes, pa.array(counts, pa.int64())], [id_col, "n_bytes", "n_tokens"]
        if keep_prefixes:
            columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "prefix"]
        if budget is not None:
            columns, names = [*columns, pa.array(within, pa.int64())], [*names, "budget_chars"]
        return pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(rows, run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint" + ", prefix binary" * keep_prefixes + ", budget_chars bigint" * (budget is not None))


def truncated(docs: DataFrame, counted: DataFrame, budget: int, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's longest prefix of at most ``budget`` tokens, from the stored tables alone.

    ``counted`` has one row an id, from ``prefix_token_counts``; documents whose
    id it does not hold are left out.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text")).join(counted.select(id_col, "prefix"), id_col)
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cut = [(t or "")[: longest_prefix(p, budget)] for t, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(cut, pa.string())], [id_col, "text"])

    return map_arrow(rows, run, f"`{id_col}` {kind}, text string")
