"""Quality rules by compression bands.

A text that repeats itself compresses far better than prose, and noise far
worse. Every text is compressed whole with zstandard, and again in chunks of a
fixed size (from one chunk's length on; the last chunk ends with the text), so
that bad stretches of a long text show; the ratio of raw to
compressed size must stay inside a band that depends on the length, as short
texts compress less. A text is also rejected when most of its chunks leave
their band.

Beside the verdict there are the plain counts of the base rules. Nulls count
as empty texts, which fail the base rules; repeated rows give repeated rows; an
empty table gives an empty table; a null id stays null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import SPACES, covered, map_arrow, texts_of, window_hashes, word_hashes

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class CompressionBands:
    """``bands``: (bytes from, least ratio, most ratio), by length; below the first there is no limit."""

    level: int = 3
    chunk: int = 4096
    bands: tuple[tuple[int, float, float], ...] = ((200, 0.9, 2.4), (400, 1.0, 2.8), (1_000, 1.1, 3.2), (2_500, 1.2, 3.8), (10_000, 1.3, 5.0))
    chunk_band: tuple[float, float] = (1.15, 4.5)
    most_bad_chunks: float = 0.5
    least_words: int = 20
    most_repeated: int = 30
    window: int = 8

    def band(self, size: int) -> tuple[float, float]:
        low, high = 0.0, float("inf")
        for start, least, most in self.bands:
            if size >= start:
                low, high = least, most
        return low, high


def base_counts(text: bytes, window: int = 8) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, words in repeated windows."""
    words = text.split()
    n_chars = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    spaces = len(text) - len(text.translate(None, SPACES))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    repeated = 0
    if len(words) > window:
        hashes = window_hashes(word_hashes(words), window)
        order = np.argsort(hashes, kind="stable")
        same = hashes[order[1:]] == hashes[order[:-1]]
        if same.any():
            twice = np.zeros(len(hashes), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            repeated = int(covered(np.flatnonzero(twice), window, len(words)).sum())
    return len(words), n_chars - spaces, symbols, len(lines) - len(set(lines)), repeated


def judged(text: bytes, rules: CompressionBands, compressor: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """The whole text's ratio, the share of its chunks outside their band, and whether it passes."""
    size = len(text)
    if not size:
        return 0.0, 0.0, False
    ratio = size / len(compressor.compress(text))
    low, high = rules.band(size)
    bad = 0.0
    if size >= rules.chunk:
        # The last chunk ends where the text does, so that every byte is in one.
        chunks = [text[min(k, size - rules.chunk) :][: rules.chunk] for k in range(0, size, rules.chunk)]
        least, most = rules.chunk_band
        bad = sum(not least <= len(c) / len(compressor.compress(c)) <= most for c in chunks) / len(chunks)
    return ratio, bad, low <= ratio <= high and bad <= rules.most_bad_chunks


def quality_rules(docs: DataFrame, rules: CompressionBands | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: the base counts, ``base_failed``, ``kept``, ``ratio`` and ``bad_chunks``."""
    rules = rules or CompressionBands()
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        compressor = zstandard.ZstdCompressor(level=rules.level, write_content_size=False)
        texts = texts_of(batch.column(1))
        counts = np.array([base_counts(t, rules.window) for t in texts], np.int64).reshape(-1, 5)
        failed = (counts[:, 0] < rules.least_words) | (100 * counts[:, 4] > rules.most_repeated * counts[:, 0])
        verdicts = [judged(t, rules, compressor) for t in texts]
        kept = ~failed & np.array([v[2] for v in verdicts], bool)
        arrays = [batch.column(0), *(pa.array(counts[:, k]) for k in range(5)), pa.array(failed), pa.array(kept)]
        arrays += [pa.array([v[k] for v in verdicts], pa.float64()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(arrays, [id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "bad_chunks"])

    return map_arrow(rows, run, f"`{id_col}` {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, ratio double, bad_chunks double")


def keep_good(docs: DataFrame, rules: CompressionBands | None = None, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes all rules, with all their columns; one narrow pass."""
    rules = rules or CompressionBands()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        compressor = zstandard.ZstdCompressor(level=rules.level, write_content_size=False)
        good = []
        for text in texts_of(batch.column(batch.schema.names.index(text_col))):
            n_words, _, _, _, repeated = base_counts(text, rules.window)
            good.append(n_words >= rules.least_words and 100 * repeated <= rules.most_repeated * n_words and judged(text, rules, compressor)[2])
        return batch.filter(pa.array(good, pa.bool_()))

    return map_arrow(docs, run, docs.schema)
