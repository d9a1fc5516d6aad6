"""Benchmark decontamination by a broadcast set of normalised test n-grams.

The windows of the benchmark's items are hashed and broadcast; one narrow pass
over the documents looks every window of theirs up, verifies hits word by word
and marks the words that lie in one. The benchmark is read in blocks of a
bounded number of words, each a query set against all documents. There is one pass
for any number of blocks: a worker takes some megabytes of text through one block after
the other and holds one of them at a time, as the driver does; the others are
on its machine's disk, as Spark keeps broadcasts.

Words are runs of ``[0-9a-z]`` and of characters beyond ASCII, after A-Z are
lower-cased. An item of fewer words than a window is one window; items without
words or without an id never hit. Null texts have no words. Repeated rows give
repeated rows, repeated items count once; empty tables on either side give
documents without hits, or no documents. A null id stays null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import covered, ensure_importable, texts_of, window_hashes

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
#: Bytes of text that are looked up in one block after the other.
_CHUNK_BYTES = 8_000_000
#: Lower-cases A-Z and turns what is in no word into a space.
NORMAL = bytes(b if b in _KEPT else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class _Known(dict):
    """Ids of the benchmark's words; 0 for any other word."""

    def __missing__(self, word: bytes) -> int:
        return 0


@dataclass
class WindowSet:
    """The windows of a block of items, by their number of words."""

    vocabulary: _Known
    widths: list[int]
    hashes: list[np.ndarray]
    windows: list[np.ndarray]
    items: list[list[list[str]]]

    @staticmethod
    def build(items: list[tuple[str, list[bytes]]], width: int) -> WindowSet:
        vocabulary = _Known()
        found: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for name, words in items:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
            size = min(width, len(ids))
            for k in range(len(ids) - size + 1 if size else 0):
                found.setdefault(size, {}).setdefault(tuple(ids[k : k + size]), set()).add(name)
        widths, hashes, windows, names = sorted(found), [], [], []
        for size in widths:
            rows = np.array(list(found[size]), np.uint64)
            total = np.array([window_hashes(row, size)[0] for row in rows], np.uint64)
            order = np.argsort(total, kind="stable")
            owners = list(found[size].values())
            hashes.append(total[order])
            windows.append(rows[order])
            names.append([sorted(owners[k]) for k in order])
        return WindowSet(vocabulary, widths, hashes, windows, names)

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in a window of an item, and the items."""
        ids = np.fromiter(map(self.vocabulary.__getitem__, words), np.uint64, len(words))
        hit, names = np.zeros(len(words), bool), set()
        strange = np.concatenate([[0], np.cumsum(ids == 0)])
        for size, hashes, windows, owners in zip(self.widths, self.hashes, self.windows, self.items, strict=True):
            starts = np.flatnonzero(strange[size:] == strange[:-size]) if len(ids) >= size else ()
            if not len(starts):
                continue
            total = window_hashes(ids, size)[starts]
            low, high = np.searchsorted(hashes, total, "left"), np.searchsorted(hashes, total, "right")
            verified = []
            for k in np.flatnonzero(low < high):
                start = starts[k]
                for at in range(low[k], high[k]):
                    if np.array_equal(windows[at], ids[start : start + size]):
                        verified.append(start)
                        names.update(owners[at])
            if verified:
                hit |= covered(np.array(sorted(set(verified))), size, len(ids))
        return hit, names


def blocks_of(benchmark: DataFrame, *, item_col: str, text_col: str, width: int, block_words: int):
    """Window sets of a bounded number of words each; the items stream through the driver a block at a time."""
    items = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string")).where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull()).distinct()
    block, held = [], 0
    for name, text in items.toLocalIterator():
        words = words_of(text.encode())
        for k in range(0, max(1, len(words) - width + 1), block_words):
            part = words[k : k + block_words + width - 1]
            if held + len(part) > block_words + width and block:
                yield WindowSet.build(block, width)
                block, held = [], 0
            block.append((name, part))
            held += len(part)
    yield WindowSet.build(block, width)


def _spans(hit: np.ndarray) -> list[int]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return edges.tolist()


def _in_turn(batches: Iterator[pa.RecordBatch], where: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows, and their texts, of some megabytes of text at once."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(where)), 0).to_numpy(zero_copy_only=False)
        upto, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + _CHUNK_BYTES, "right")))
            part = batch.slice(start, end - start)
            yield part, texts_of(part.column(where))
            start = end


def _scanned(docs: DataFrame, text_col: str, blocks: Iterator[WindowSet], finish: Callable[[pa.RecordBatch, list[bytes], list[int], list[list[int]], list[list[str]]], pa.RecordBatch], schema) -> DataFrame:
    """``finish(rows, texts, numbers of words, spans, items)`` of all rows, in one pass, whatever the number of blocks.

    A worker takes some megabytes of text, looks them up in one block after the
    other, and holds one block at a time.
    """
    ensure_importable(docs.sparkSession)
    where = docs.columns.index(text_col)
    shared = [docs.sparkSession.sparkContext.broadcast(windows) for windows in blocks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _in_turn(batches, where):
            words = [words_of(t) for t in texts]
            hits, names = [np.zeros(len(w), bool) for w in words], [set() for _ in words]
            for block in shared:
                windows = block.value
                for own, hit, found in zip(words, hits, names, strict=True):
                    here, items = windows.scan(own)
                    hit |= here
                    found |= items
                if len(shared) > 1:
                    vars(block).pop("_value", None)  # the next block takes its place; it is read from the worker's disk again
            yield finish(part, texts, [len(w) for w in words], [_spans(hit) for hit in hits], [sorted(n) for n in names])

    return docs.mapInArrow(run, schema)


def find_hits(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 10, block_words: int = 500_000) -> DataFrame:
    """``id_col, n_words, n_hit, spans, items``: spans are starts and ends of hit words, in turn."""
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()

    def counted(part: pa.RecordBatch, texts: list[bytes], sizes: list[int], spans: list[list[int]], items: list[list[str]]) -> pa.RecordBatch:
        hits = [sum(s[1::2]) - sum(s[::2]) for s in spans]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(hits, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))], [id_col, "n_words", "n_hit", "spans", "items"])

    blocks = blocks_of(benchmark, item_col=item_col, text_col=item_text_col, width=width, block_words=block_words)
    return _scanned(rows, "_text", blocks, counted, f"`{id_col}` {kind}, n_words bigint, n_hit bigint, spans array<int>, items array<string>")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def remove_hits(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 10, block_words: int = 500_000, most_share: float = 0.5) -> DataFrame:
    """``docs`` with the hit spans cut out of the texts, without the documents of which more than ``most_share`` of the words are hit.

    A span goes with what stands between its words and with the white space
    after it; texts without hits stay as they are, nulls too. The blocks of the
    benchmark are all looked up in the original text; what they hit together is
    measured and cut once.
    """
    names = docs.columns
    where = names.index(text_col)

    def cutter(part: pa.RecordBatch, texts: list[bytes], sizes: list[int], spans: list[list[int]], items: list[list[str]]) -> pa.RecordBatch:
        left, kept = part.column(where).cast(pa.binary()).to_pylist(), []
        for k, own in enumerate(spans):
            kept.append(not own or sum(own[1::2]) - sum(own[::2]) <= most_share * sizes[k])
            if own and kept[-1]:
                left[k] = _without(texts[k], own)
        columns = list(part.columns)
        columns[where] = pa.array(left, pa.binary()).cast(part.schema.types[where])
        return pa.RecordBatch.from_arrays(columns, names).filter(pa.array(kept, pa.bool_()))

    blocks = blocks_of(benchmark, item_col=item_col, text_col=item_text_col, width=width, block_words=block_words)
    return _scanned(docs, text_col, blocks, cutter, docs.schema)


def _without(text: bytes, spans: list[int]) -> bytes:
    normal = np.frombuffer(text.translate(NORMAL), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[0], normal.view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    parts, at = [], 0
    for first, after in zip(spans[::2], spans[1::2], strict=True):
        parts.append(text[at : starts[first]])
        at = int(ends[after - 1])
        while at < len(text) and text[at] in b" \t":
            at += 1
    parts.append(text[at:])
    return b"".join(parts)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
g AS (
  SELECT DISTINCT item, n, array_to_string(w[k : k + n - 1], ' ') AS gram
  FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)),
s AS (SELECT DISTINCT n FROM g),
h AS (
  SELECT x.doc_id, x.k, x.n, g.item
  FROM (SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS gram FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, s WHERE len(w) >= n)) x
  JOIN g ON x.n = g.n AND x.gram = g.gram),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM h) GROUP BY doc_id),
o AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, COALESCE(n_hit, 0)::BIGINT AS n_hit, COALESCE(n_items, 0)::BIGINT AS n_items, sha256(COALESCE(items, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN o ON d.doc_id = o.doc_id
"""
