"""Helpers shared by the training-data operators."""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import checkpoint_dir

# One Arrow batch holds whole texts: keep it small whatever the texts' length.
BATCH_ROWS, BATCH_BYTES = 2000, 8 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver found it."""
    sc = spark.sparkContext
    if getattr(sc, "_tripcast_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="tripcast-py-"), "tripcast_package.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(out)
    sc._tripcast_shipped = True


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that carry texts by bytes, not only by rows."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back.

    Unlike ``checkpoint()`` the copy keeps columns apart, so that later readers
    prune it; it survives lost executors because all of them see the folder.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what ``written`` wrote, once nothing reads it any more."""
    for t in tables:
        spark, path = t.sparkSession, getattr(t, "_written_at", None)
        if path:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def text_of(df: DataFrame, col: str = "text") -> Column:
    """The text as string; null counts as empty."""
    return F.coalesce(df[col].cast("string"), F.lit(""))


# ---------------------------------------------------------------------------
# Word hashing on flat byte arrays (whole Arrow batches at once)
# ---------------------------------------------------------------------------
_MULT = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_classes(keep) -> np.ndarray:
    """Lookup table byte -> 0 (separator) or the lower-cased byte + 1."""
    out = np.zeros(256, np.uint16)
    for b in range(256):
        if keep(b):
            out[b] = (b + 32 if 65 <= b <= 90 else b) + 1
    return out


#: words of any bytes but ASCII white space
SPACE_WORDS = byte_classes(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: words of digits, letters and all non-ASCII bytes
ALNUM_WORDS = byte_classes(lambda b: b >= 0x80 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)

_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(64, 2 * n)
        _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _MULT, np.uint64)]))
    return _POWERS


def word_hashes(texts: list[bytes], classes: np.ndarray = SPACE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word of each text, with A-Z lower-cased.

    Returns the flat hashes and ``bounds`` (len(texts) + 1): text i has the
    words ``hashes[bounds[i]:bounds[i + 1]]``.
    """
    flat = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    value = classes[flat]
    word = value > 0
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    after = np.cumsum(lengths + 1)
    bounds = np.concatenate([[0], np.searchsorted(starts, after)])
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    size = ends - starts
    inner = value[word].astype(np.uint64)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.arange(len(inner), dtype=np.int64) - np.repeat(first, size)
    inner *= _powers(int(size.max()))[place]
    return mix64(np.add.reduceat(inner, first) ^ (size.astype(np.uint64) * _ODD)), bounds


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text, with their text's index.

    A text of fewer than k words (but at least one) has one shingle: the whole
    sequence.  Repeated shingles are not removed here.
    """
    counts = np.diff(bounds)
    full = np.maximum(counts - k + 1, 0)
    n = len(words)
    if n >= k:
        acc = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            acc = acc * _MULT + words[j:n - k + 1 + j]
        owner = np.repeat(np.arange(len(counts)), full)
        first = np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(full)[:-1]]), full)
        out = mix64(acc[np.arange(int(full.sum())) + first])
    else:
        owner, out = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for x, i in enumerate(short):
            h = int(counts[i])
            for w in words[bounds[i]:bounds[i + 1]]:
                h = (h * int(_MULT) + int(w)) & 0xFFFFFFFFFFFFFFFF
            extra[x] = h
        owner = np.concatenate([owner, short])
        out = np.concatenate([out, mix64(extra ^ _ODD)])
    return out, owner


def distinct_per_text(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text: flat values and bounds."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    if len(h):
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])
        h, o = h[new], o[new]
    return h, np.searchsorted(o, np.arange(n + 1))


def chunks(items: list[bytes], limit: int = 2 * 1024 * 1024):
    """Index ranges whose texts have about ``limit`` bytes together (one text at least)."""
    start, total = 0, 0
    for i, x in enumerate(items):
        if i > start and total + len(x) > limit:
            yield start, i
            start, total = i, 0
        total += len(x)
    if start < len(items):
        yield start, len(items)


class Numbers(dict):
    """Numbers new words in the order in which they come."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n
