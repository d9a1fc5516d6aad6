"""Helpers that the operators of this subpackage share.

Operators that return columns of their own select those they need by name
before they do anything else; operators that return the input's rows name their
own columns differently from all of the input's (``free_name``).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII white-space characters.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"

#: Rows that a function of ``map_arrow`` gets at once.
_ROWS = 500

_ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is shipped with ``--py-files``; the extra entry
    then names a folder that does not exist there, which Python ignores.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``fn`` to the rows of ``df``, a few hundred at a time, which bounds a worker's memory; narrow."""
    ensure_importable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                yield fn(batch.slice(start, _ROWS))

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as the empty text."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all executors share; an own one only where none is set and this machine does all the work."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = getattr(spark, "_talkgrain_checkpoints", None)
        if not root:
            root = tempfile.mkdtemp(prefix="talkgrain-")
            spark._talkgrain_checkpoints = root
    return root


_temporary: list[list[DataFrame]] = []


@contextmanager
def temporary() -> Iterator[None]:
    """Delete what ``cut`` writes inside, at the end; results must be cut with ``keep``."""
    _temporary.append([])
    try:
        yield
    finally:
        for df in _temporary.pop():
            discard(df)


def cut(df: DataFrame, *, name: str = "cut", keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage, so that what follows survives the loss of executors
    without running what came before again. The files go when the JVM ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/talkgrain/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    written = spark.read.schema(df.schema).parquet(path)
    written._folder = path
    if _temporary and not keep:
        _temporary[-1].append(written)
    return written


def reread(tables: list[DataFrame]) -> DataFrame:
    """All rows of tables that ``cut`` wrote and that have the same columns, in one scan."""
    return tables[0].sparkSession.read.schema(tables[0].schema).parquet(*(t._folder for t in tables))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value made once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def free_name(names: list[str], name: str) -> str:
    """``name`` with as many underscores behind it as make it different from all ``names``."""
    taken = {n.lower() for n in names}
    while name.lower() in taken:
        name += "_"
    return name


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``cut`` wrote and that nothing will read again."""
    sc = df.sparkSession.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(df._folder)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


class WordHashes(dict):
    """64-bit hash of a word, remembered up to a bound."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


_MULTIPLIER = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` ids, by its first position."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, factor = np.zeros(n, np.uint64), 1
    for k in range(width):
        total += ids[k : k + n] * np.uint64(factor)
        factor = factor * _MULTIPLIER % 2**64
    return mixed(total)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a run of ``width`` that begins at one of ``starts``."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + width, n), -1)
    return np.cumsum(edges[:-1]) > 0


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo 5; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


#: SQL of a table ``crc`` that ``crc32_sql`` reads, as a common table expression.
CRC32_TABLE = "crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"


def crc32_sql(text: str) -> str:
    """SQL of the unsigned crc32 of a text's UTF-8 bytes."""
    return f"xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)"
