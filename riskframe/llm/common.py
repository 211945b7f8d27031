"""Helpers shared by the operators: shipping the package, text arrays, row keys."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir

ROOT = Path(__file__).resolve().parents[2]
MAX_LONG = (1 << 63) - 1


#: rows of whole texts that go to a Python worker at once, where the session has Spark's default
BATCH_ROWS = 1_000
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """Register the checkpoint folder, bound the batches of texts that Python
    workers hold (a session's own setting stays) and let executors import this package.

    Where the repository is on no worker's path, it is shipped with ``addPyFile``.
    """
    ensure_checkpoint_dir(spark)
    if spark.conf.get(BATCH_CONF, "10000") == "10000":
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    known = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if ROOT in known or any("riskframe_pkg" in f for f in sc.listFiles):
        return
    base = Path(tempfile.mkdtemp(prefix="riskframe-ship-")) / "riskframe_pkg"
    sc.addPyFile(shutil.make_archive(str(base), "zip", root_dir=ROOT, base_dir="riskframe"))


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def finished_shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries built inside remove their shuffle files when they end.

    For iterations of checkpoints: each step reads the step before it from its
    checkpoint, so the shuffle files of ended steps only fill the disks.  The
    session's own setting comes back afterwards.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read again.

    Cuts the lineage as checkpoint() does, but the plan goes on with the size of the
    files; a checkpoint keeps the estimated size, which joins multiply, and after some
    twenty rounds of an iteration planning takes longer than the work.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(col: str, mod: int) -> Column:
    """crc32 of the column as text, modulo ``mod`` (null for null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % mod


def replace_columns(df: DataFrame, source: Column, *names: str) -> DataFrame:
    """``df`` plus the named fields of the struct ``source``; an input column
    with the same name (any case) is replaced."""
    own = {n.lower() for n in names}
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in own]
    return df.select(*keep, source.alias("__out")).select(
        *[f"`{c}`" for c in df.columns if c.lower() not in own], *[f"__out.{n}" for n in names])


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sample_share(total: int | None, bound: int) -> float:
    """Share of rows (or of a weight) that keeps about ``bound`` of ``total``."""
    return 1.0 if not total or total <= bound else bound / total


def hash_share(*cols: str, seed: str = "s") -> Column:
    """A reproducible number in [0, 1) for a row, from the named columns."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in cols], F.lit(seed))
    return F.pmod(F.shiftrightunsigned(h, 1), F.lit(1 << 40)) / float(1 << 40)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64) for arrays of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    if n > 1:
        out[1:] = np.cumprod(np.full(n - 1, base, dtype=np.uint64))
    return out


SPACES = np.zeros(0x110000, dtype=bool)
SPACES[[c for c in range(0x3001) if chr(c).isspace()]] = True
_POW = _powers(4096, 0x9E3779B97F4A7C15)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all white-space-separated words of the texts, in order,
    and the number of words of each text.  A word's hash depends on it alone."""
    joined = "\n".join(texts)
    cp = code_points(joined)
    if not len(cp):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    gap = SPACES[cp]
    first = ~gap
    first[1:] &= gap[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    # position of each code point in its word; powers wrap for absurdly long words
    at = np.arange(len(cp), dtype=np.int64)
    word = np.cumsum(first) - 1
    pos = at - starts[np.maximum(word, 0)]
    value = (cp.astype(np.uint64) + np.uint64(1)) * _POW[pos & 4095]
    value += (pos >> 12).astype(np.uint64) * value
    value[gap] = 0
    total = np.cumsum(value)  # wraps; differences are right modulo 2^64
    ends = np.append(starts[1:], len(cp)) - 1
    sums = total[ends] - total[starts] + value[starts]
    ends_of_text = np.cumsum([len(t) + 1 for t in texts]) - 1
    counts = np.diff(np.searchsorted(starts, ends_of_text), prepend=0)
    return mixed(sums), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text; a text of fewer words (but
    at least one) has one shingle of all its words."""
    n = len(words)
    ends = np.cumsum(counts)
    starts = ends - counts
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    left = np.repeat(ends, counts) - np.arange(n)  # words from here to the end of the text
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        nxt = np.zeros(n, np.uint64)
        nxt[: max(0, n - j)] = words[j:]
        inside = left > j
        acc = np.where(inside, acc * np.uint64(0xD6E8FEB86659FD93) + nxt + np.uint64(1), acc)
    is_start = (left >= k)
    short = (counts > 0) & (counts < k)
    is_start[starts[short]] = True
    return mixed(acc[is_start]), np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))


def slices_by_size(sizes: list[int], limit: int):
    """Consecutive index ranges whose sizes sum to about ``limit`` (one item at least)."""
    begin, total = 0, 0
    for i, s in enumerate(sizes):
        if i > begin and total + s > limit:
            yield begin, i
            begin, total = i, 0
        total += s
    if begin < len(sizes):
        yield begin, len(sizes)
