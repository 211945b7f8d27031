"""Document fingerprints by improved consistent weighted sampling.

A text is a weighted set: its five-word shingles, each with its count as the
weight.  For sample k and term x with weight w, hashes of (k, x) give
r, c ~ Gamma(2, 1) and b ~ U(0, 1);  t = floor(ln w / r + b),
ln y = r (t - b),  ln a = ln c - ln y - r.  The sample is the pair (x, t) of the
smallest a: two texts agree in a sample with probability equal to their
generalised Jaccard similarity.  A fingerprint keeps 32 bits of each of
``SAMPLES`` samples, as hexadecimal text.

Results for odd input: a null text counts as empty; a text without a word has
the fingerprint "" and is like another such text (1.0) and unlike any other
(0.0); a text of fewer than five words has one shingle of all of them; equal
texts have equal fingerprints; ties of a go to the smaller term hash; repeated
rows are fingerprinted one by one; very long texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import mixed, prepare, shingle_hashes, shuffle_width, slices_by_size, table, word_hashes

SAMPLES = 64
WORDS = 5
#: characters and terms handled at once
SLICE = 400_000
TERMS = 4_096
#: place of rows without an id: the last one
NO_ID = -(1 << 63)


def _hashes(x: np.ndarray, salt: np.ndarray) -> np.ndarray:
    h = x[:, None] ^ salt[None, :]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(31)
    return h


def _unit(h: np.ndarray) -> np.ndarray:
    """31-bit values as numbers in (0, 1)."""
    u = h.astype(np.float32)
    u += np.float32(0.5)
    u *= np.float32(2.0 ** -31)
    return u


def _gamma(x: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Gamma(2, 1) for each (term, sample): minus the logarithm of two uniform numbers from one 64-bit hash."""
    h = _hashes(x, salt)
    u = _unit(h & np.uint64(0x7FFFFFFF))
    h >>= np.uint64(33)
    u *= _unit(h)
    np.maximum(u, np.float32(1e-37), out=u)
    np.log(u, out=u)
    return np.negative(u, out=u)


def _salts(samples: int) -> list[np.ndarray]:
    base = np.arange(1, samples + 1, dtype=np.uint64)
    return [mixed(base * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j * 7919)) for j in range(3)]


def sample_values(terms: np.ndarray, weights: np.ndarray, samples: int = SAMPLES) -> tuple[np.ndarray, np.ndarray]:
    """(ln a, t) for each term and sample; t is 0 wherever the weight is 1."""
    salts = _salts(samples)
    r, c = _gamma(terms, salts[0]), _gamma(terms, salts[1])
    beta = _unit(_hashes(terms, salts[2]) >> np.uint64(33))
    t = np.zeros_like(beta)
    many = np.flatnonzero(weights > 1)
    if len(many):
        t[many] = np.floor(np.log(weights[many].astype(np.float32))[:, None] / r[many] + beta[many])
    ln_a = np.log(c, out=c)
    ln_a -= r * (t - beta)
    ln_a -= r
    return ln_a, t


def signatures(texts: list[str], samples: int = SAMPLES, k: int = WORDS) -> np.ndarray:
    """texts x samples of 32-bit values; rows of texts without a word are 0."""
    words, counts = word_hashes(texts)
    terms, sizes = shingle_hashes(words, counts, k)
    out = np.zeros((len(texts), samples), np.uint32)
    if not len(terms):
        return out
    doc = np.repeat(np.arange(len(texts)), sizes)
    # weights: how often a text has the term
    order = np.lexsort((terms, doc))
    d, x = doc[order], terms[order]
    new = np.append(True, (d[1:] != d[:-1]) | (x[1:] != x[:-1]))
    at = np.flatnonzero(new)
    d, x, w = d[at], x[at], np.diff(np.append(at, len(x)))
    # (term, weight) pairs that texts share are sampled once
    pair = mixed(x ^ (w.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    _, first, inv = np.unique(pair, return_index=True, return_inverse=True)
    px, pw = x[first], w[first]
    ln_a = np.empty((len(px), samples), np.float32)
    level = np.empty((len(px), samples), np.float32)
    for b in range(0, len(px), TERMS):
        ln_a[b:b + TERMS], level[b:b + TERMS] = sample_values(px[b:b + TERMS], pw[b:b + TERMS], samples)
    starts = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
    ends = np.append(starts[1:], len(d))
    cols = np.arange(samples)
    for s, e, i in zip(starts.tolist(), ends.tolist(), d[starts].tolist()):
        rows = inv[s:e]
        won = rows[ln_a[rows].argmin(axis=0)]
        t = level[won, cols].astype(np.int64).astype(np.uint64)
        out[i] = ((px[won] ^ (t * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(32)).astype(np.uint32)
    return out


def fingerprints(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Hexadecimal text, signature and whether there is any word, for each text."""
    sig = np.zeros((len(texts), SAMPLES), np.uint32)
    for b, e in slices_by_size([len(t) for t in texts], SLICE):
        sig[b:e] = signatures(texts[b:e])
    some = np.array([bool(t.strip()) for t in texts], dtype=bool)
    return [s.astype(">u4").tobytes().hex() if ok else "" for s, ok in zip(sig, some)], sig, some


def likeness(a: np.ndarray, b: np.ndarray, some_a: bool, some_b: bool) -> float:
    if not (some_a and some_b):
        return float(some_a == some_b)
    return float((a == b).mean())


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` plus the fingerprint of each text."""
    @F.pandas_udf("string")
    def printed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(fingerprints([t if isinstance(t, str) else "" for t in texts])[0], dtype=object)

    return docs.withColumn(out, printed(F.col(f"`{text}`")))


def edited(text: str, nxt: str) -> str:
    """The last floor(n/2) code points replaced by the first as many of ``nxt``."""
    half = len(text) // 2
    return text[: len(text) - half] + nxt[:half]


def _text_place(text: Column) -> Column:
    """The first six bytes of a text as a number that orders texts as they do."""
    return F.conv(F.rpad(F.hex(F.substring(F.encode(text, "utf-8"), 1, 6)), 12, "0"), 16, 10).cast("long")


def in_blocks(docs: DataFrame, blocks: int) -> tuple[DataFrame, int]:
    """doc_id, text and block, and the number of blocks: about ``blocks`` runs of the order by descending
    doc_id (null last) and text, each run followed by the first document of the next
    (marked ``extra``), the last run by the first document of all.

    Borders are quantiles of doc_id.  An id that more than one of them meets (null, or an
    id that very many rows repeat) is cut into runs of its own at quantiles of its texts'
    first bytes; texts that begin alike in them stay together.  Of the documents only
    each run's first goes to two runs (and rows that repeat its id, or of an id cut
    into runs its id and text).
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    rows = docs.select(key.alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = [] if blocks < 2 else rows.select(
        F.percentile_approx("key", [i / blocks for i in range(1, blocks)], 100 * blocks)).first()[0] or []
    # quantiles are found in double precision: exact for these ids and for no id
    often = {k: n for k, n in Counter(cuts).items() if n > 1 and (abs(k) <= 1 << 53 or k == NO_ID)}
    splits = [-float("inf"), *sorted({float(c) for c in cuts}), float("inf")]
    place = _text_place(F.col("text"))
    sub = F.lit(0)
    if often:
        inside = rows.where(F.col("key").isin(list(often))).select(
            *[F.percentile_approx(F.when(F.col("key") == k, place), [i / n for i in range(1, n)], 100 * n) for k, n in often.items()])
        for k, borders in zip(often, inside.first()):
            borders = F.array(*[F.lit(c).cast("long") for c in sorted(set(borders or []))]).cast("array<long>")
            sub = F.when(F.col("key") == k, 1 + F.size(F.filter(borders, lambda c: c <= place))).otherwise(sub)

    def with_run(df: DataFrame) -> DataFrame:  # parts are counted from the highest ids
        at = df.withColumn("at", F.col("key").cast("double"))
        cut = Bucketizer(splits=splits, inputCol="at", outputCol="bucket", handleInvalid="keep")
        return (cut.transform(at) if cuts else at.withColumn("bucket", F.lit(0))).select(
            (-F.col("bucket")).cast("int").alias("part"), sub.cast("int").alias("sub"), *df.columns)

    firsts = with_run(rows if often else rows.select("key")).groupBy("part", "sub").agg(
        F.max("key").alias("top"), *([F.min(F.when(F.col("key").isin(list(often)), F.col("text"))).alias("text")] if often else []))
    tops = firsts.select("part", "sub", "top", (F.when(F.col("sub") > 0, F.xxhash64("text")) if often else F.lit(None).cast("long"))
                         .alias("first")).orderBy("part", "sub").collect()
    # at most two rows for each block: the first of each run also goes to the run before (the first of all to the last run)
    count = len(tops)
    runs = spark.createDataFrame([(t["part"], t["sub"], i, t["top"], t["first"], (i - 1) % count) for i, t in enumerate(tops)],
                                 "part int, sub int, block int, top long, first long, goes_to int")
    goes = (F.col("key") == F.col("top")) & (F.col("first").isNull() | (F.xxhash64("text") == F.col("first")))
    own = F.struct("block", F.lit(False).alias("extra"))
    copies = F.when(goes, F.array(own, F.struct(F.col("goes_to").alias("block"), F.lit(True).alias("extra")))).otherwise(F.array(own))
    spread = with_run(rows).join(F.broadcast(runs), ["part", "sub"]).select("key", "doc_id", "text", F.explode(copies).alias("c"))
    return spread.select("key", "doc_id", "text", "c.block", "c.extra"), count


OUT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
       ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def compare_with_next(docs: DataFrame, blocks: int) -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likenesses.

    Rows of equal doc_id follow one another by text.
    """
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (block, extra, doc_id, text): waits for its successor
        for batch in batches:
            block, extra = batch.column("block").to_pylist(), batch.column("extra").to_pylist()
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            todo = ([held] if held else []) + list(zip(block, extra, keys, texts))
            held = todo.pop()
            for b, e in slices_by_size([len(r[3]) for r in todo], SLICE):
                yield rows_of(todo[b:e], todo[e] if e < len(todo) else held)
        if held:
            yield rows_of([held], None)

    def rows_of(part: list, after) -> pa.RecordBatch:
        chain = part + ([after] if after else [])
        texts = [r[3] for r in chain]
        pairs = [(i, i + 1) for i in range(len(part)) if not part[i][1] and i + 1 < len(chain) and chain[i + 1][0] == part[i][0]]
        changed = [edited(texts[i], texts[j]) for i, j in pairs]
        prints, sig, some = fingerprints(texts + changed)
        n = len(texts)
        cols = [[part[i][2] for i, _ in pairs], [len(texts[i]) for i, _ in pairs],
                [hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed],
                [prints[i] for i, _ in pairs], prints[n:],
                [likeness(sig[i], sig[n + q], some[i], some[n + q]) for q, (i, _) in enumerate(pairs)],
                [likeness(sig[i], sig[j], some[i], some[j]) for i, j in pairs]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, OUT)], names=[x for x, _ in OUT])

    spread, count = in_blocks(docs, blocks)
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    # a run is a partition of its own
    return (spread.repartitionById(max(count, 1), F.col("block"))
            .sortWithinPartitions("block", "extra", F.desc("key"), "text").mapInArrow(compared, schema))


def op2_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return compare_with_next(docs, 2 * shuffle_width(spark))
