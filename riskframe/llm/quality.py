"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

A text becomes a sparse vector: its words hashed into buckets (log counts,
scaled to length one), one indicator for the range that each structure
statistic falls into, and indicators of metadata (the recorded length).  The
score is the logistic value of

    w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2],

linear in the number of non-zero entries.  The machine is fitted on a bounded
sample of labelled rows (``MAX_LABELLED``); scoring covers all rows, in Spark.

Results for odd input: a null text counts as empty and is scored on its
structure and metadata; null metadata gives no indicator; rows with a null
label are not learned from; repeated rows get equal scores; with no labelled
row every score is 0.5; an empty table gives an empty result; very long texts
are read whole; input columns named like an output are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import code_points, hash_share, prepare, remainder, replace_columns, sample_share, table

#: bound of the fit: about so many labelled rows
MAX_LABELLED = 8_000
WORD_BUCKETS = 1 << 15
RANGES = 16
FACTORS = 8
EPOCHS = 12
BATCH = 256
PREDICT_AT = 0.7
#: edges of the ranges of each structure statistic
STATISTICS = {
    "characters": np.geomspace(8, 1e5, RANGES - 1),
    "upper_share": np.linspace(0.02, 0.9, RANGES - 1),
    "digit_share": np.linspace(0.005, 0.4, RANGES - 1),
    "mark_share": np.linspace(0.01, 0.6, RANGES - 1),
    "blank_share": np.linspace(0.05, 0.4, RANGES - 1),
    "word_length": np.linspace(2, 12, RANGES - 1),
    "distinct_words": np.linspace(0.03, 0.98, RANGES - 1),
    "top_word": np.linspace(0.01, 0.6, RANGES - 1),
    "distinct_lines": np.linspace(0.1, 0.99, RANGES - 1),
    "words_per_line": np.geomspace(1, 400, RANGES - 1),
    "marked_words": np.linspace(0.05, 0.95, RANGES - 1),
    "lone_marks": np.linspace(0.01, 0.5, RANGES - 1),
    "followed_by_itself": np.linspace(0.005, 0.5, RANGES - 1),
}
META = "recorded_length"
SIZE = WORD_BUCKETS + RANGES * (len(STATISTICS) + 1)
#: weight of the indicators against the word part (whose length is one)
INDICATOR = 0.5


def _classes() -> np.ndarray:
    """0 other, 1 lower, 2 upper, 3 digit, 4 mark, 5 blank, 6 line end."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x3000):
        s = chr(c)
        out[c] = (6 if s == "\n" else 5 if s.isspace() else 3 if s.isdigit() else 2 if s.isupper()
                  else 1 if s.isalpha() else 4 if s.isprintable() else 0)
    out[0x3000:0xD7A4] = 1
    return out


class Features:
    """Texts to sparse rows; keeps a bounded memory of word buckets."""

    def __init__(self):
        self.classes = _classes()
        self.bucket: dict[str, int] = {}

    def _bucket(self, word: str) -> int:
        b = self.bucket.get(word)
        if b is None:
            if len(self.bucket) > 200_000:
                self.bucket.clear()
            h = 0xCBF29CE484222325
            for c in word.encode("utf-8", "surrogatepass"):
                h = ((h ^ c) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
            b = self.bucket[word] = (h ^ (h >> 29)) % WORD_BUCKETS
        return b

    def row(self, text: str | None, recorded: float | None) -> tuple[np.ndarray, np.ndarray]:
        text = text if isinstance(text, str) else ""
        words = text.lower().split()
        counts = Counter(words)
        n = max(1, len(words))
        kinds = np.bincount(self.classes[code_points(text)], minlength=7)
        size = max(1, len(text))
        lines = [x for x in text.split("\n") if x.strip()]
        marked = sum(1 for w in words if not w[-1].isalnum())
        stats = (len(text), kinds[2] / max(1, kinds[1] + kinds[2]), kinds[3] / size, kinds[4] / size, kinds[5] / size,
                 (size - kinds[5] - kinds[6]) / n, len(counts) / n, max(counts.values(), default=0) / n,
                 len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)), marked / n,
                 sum(c for w, c in counts.items() if len(w) == 1 and not w.isalnum()) / n,
                 sum(map(str.__eq__, words, words[1:])) / n)
        at = [WORD_BUCKETS + RANGES * i + int(np.searchsorted(edges, v))
              for i, (edges, v) in enumerate(zip(STATISTICS.values(), stats))]
        if recorded is not None and recorded == recorded:
            edges = STATISTICS["characters"]
            at.append(WORD_BUCKETS + RANGES * len(STATISTICS) + int(np.searchsorted(edges, recorded)))
        idx = np.fromiter(map(self._bucket, counts), np.int64, len(counts))
        val = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
        if len(val):
            val /= np.sqrt((val * val).sum())
        return (np.concatenate([idx, np.array(at, np.int64)]),
                np.concatenate([val, np.full(len(at), INDICATOR)]).astype(np.float32))


@dataclass
class Machine:
    bias: float
    weights: np.ndarray   # SIZE
    factors: np.ndarray   # SIZE x FACTORS

    def raw(self, idx: np.ndarray, val: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Values of rows given one after another (every row has an entry)."""
        part = self.factors[idx] * val[:, None]
        sums = np.add.reduceat(part, starts, axis=0)
        squares = np.add.reduceat((part * part).sum(axis=1), starts)
        return self.bias + np.add.reduceat(self.weights[idx] * val, starts) + 0.5 * ((sums * sums).sum(axis=1) - squares)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss by AdaGrad in small batches (deterministic)."""
    rng = np.random.default_rng(seed)
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(SIZE, np.float32),
                rng.normal(0, 0.02, (SIZE, FACTORS)).astype(np.float32))
    g_w, g_v = np.full(SIZE, 1e-4, np.float32), np.full((SIZE, FACTORS), 1e-4, np.float32)
    rate, decay = 0.08, 1e-5
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for b in range(0, len(order), BATCH):
            own = order[b:b + BATCH]
            idx, val = (np.concatenate([rows[i][k] for i in own]) for k in (0, 1))
            sizes = np.array([len(rows[i][0]) for i in own])
            starts = np.cumsum(sizes) - sizes
            err = (_logistic(m.raw(idx, val, starts)) - labels[own]).astype(np.float32) / len(own)
            part = m.factors[idx] * val[:, None]
            sums = np.add.reduceat(part, starts, axis=0)
            e = np.repeat(err, sizes)
            keys, inv = np.unique(idx, return_inverse=True)
            d_w = np.bincount(inv, e * val, len(keys)) + decay * m.weights[keys]
            grad = (e * val)[:, None] * (np.repeat(sums, sizes, axis=0) - part)
            d_v = np.stack([np.bincount(inv, grad[:, f], len(keys)) for f in range(FACTORS)], axis=1) + decay * m.factors[keys]
            g_w[keys] += d_w * d_w
            g_v[keys] += d_v * d_v
            m.weights[keys] -= rate * d_w / np.sqrt(g_w[keys])
            m.factors[keys] -= rate * d_v / np.sqrt(g_v[keys])
            m.bias -= 0.1 * float(err.sum())
    return m


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_LABELLED) -> Machine | None:
    """A machine from about ``max_rows`` labelled rows, chosen by a hash of doc_id."""
    known = labels.select(F.col("doc_id"), F.col(f"`{label}`").cast("int").alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).distinct()
    share = sample_share(known.count(), max_rows)
    chosen = known.where(hash_share("doc_id", seed="quality") < share)  # about max_rows rows at any size
    rows = docs.select("doc_id", "text", "n_chars").join(F.broadcast(chosen), "doc_id")

    def vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = Features()
        for f in frames:
            got = [tool.row(t, n) for t, n in zip(f["text"], f["n_chars"])]
            yield pd.DataFrame({"doc_id": f["doc_id"], "y": f["y"], "idx": [i.astype(np.int32) for i, _ in got], "val": [v for _, v in got]})

    got = rows.mapInPandas(vectors, "doc_id long, y int, idx array<int>, val array<float>").toPandas()
    if not len(got):
        return None
    got = got.sort_values(["doc_id", "y"], kind="stable")
    sparse = [(np.asarray(i, np.int64), np.asarray(v, np.float32)) for i, v in zip(got["idx"], got["val"])]
    return train(sparse, got["y"].to_numpy(np.float32))


def score(docs: DataFrame, machine: Machine | None, threshold: float = PREDICT_AT) -> DataFrame:
    """``docs`` plus score (0 to 1) and predicted (0 or 1)."""
    shipped = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def scored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        tool, m = Features(), shipped.value
        for texts, recorded in batches:
            if m is None:
                yield pd.Series(np.full(len(texts), 0.5))
                continue
            out = []
            for b in range(0, len(texts), 512):
                rows = [tool.row(t, n) for t, n in zip(texts.iloc[b:b + 512], recorded.iloc[b:b + 512])]
                sizes = np.array([len(i) for i, _ in rows])
                out.append(_logistic(m.raw(np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]),
                                           np.cumsum(sizes) - sizes)))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0), dtype="float64")

    result = scored(F.col("text"), F.col("n_chars"))
    got = docs.withColumn("__score", result)
    out = replace_columns(got, F.struct(F.col("__score").alias("score"), (F.col("__score") >= threshold).cast("int").alias("predicted")),
                          "score", "predicted")
    return out.drop("__score")


def not_learned() -> Column:
    return F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))


def op1_quality_classifier(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels")
    machine = fit(docs, labels.where(~not_learned()))
    return score(docs, machine).select("doc_id", not_learned().alias("held_out"), "score", "predicted")
