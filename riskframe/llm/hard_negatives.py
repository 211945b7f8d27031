"""Hard-negative mining with Fagin's threshold algorithm.

Candidates lie in blocks of at most about ``BLOCK_ROWS`` integer vectors; anchors
meet every block, ``ANCHORS_AT_ONCE`` in a task.  A block sorts each component
once.  An anchor reads the lists from the end that its own component's sign
favours (components that are zero in the anchor are not read), some rows deeper
in each step; every row met for the first time is scored by an integer inner
product; the threshold is the inner product of the anchor with the last values
read.  No unread row scores above it, so reading ends once it lies strictly
below the last wanted score of every window (or below the window itself).

A first search finds each anchor's positives, in one window without bounds over
the rows of its label; their scores span the windows of the second search, which
runs over the rows of other labels.  What a block returns is at most as many
rows as the answer may have; the blocks' answers are ranked together.

Results for odd input: rows with a null label, a null or empty vector or a null
or non-finite component take no part, nor rows whose integer vector has a
squared length of 2 ** 62 or more (scores of all others fit in 64 bits); vectors
of unlike length do not meet; rows that repeat an id are rows of their own, ties
among them go by their vectors; a null id is no anchor and ranks last among ties;
with fewer rows than asked for all are returned; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import MAX_LONG, prepare, table, written

#: scale of the components, and positives and negatives wanted
SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: a negative scores so many hundredths of its positive, and no more than it
LEAST, MOST = 80, 100
#: candidates of a block, anchors that meet a block in one task
BLOCK_ROWS = 8_192
ANCHORS_AT_ONCE = 256
#: rows of each list that are read first; every further step doubles them
FIRST_DEPTH = 16


class Lists:
    """Sorted component lists of a block of integer vectors."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.up = np.argsort(x, axis=0, kind="stable")
        self.values = np.take_along_axis(x, self.up, axis=0)

    def search(self, anchor: np.ndarray, wanted: np.ndarray, windows: list[tuple[int, int]], keep: int, tie: np.ndarray) -> list[np.ndarray]:
        """For each window (least, most) the positions of its ``keep`` best rows of
        those ``wanted``; ties go to the smaller ``tie``.

        Threshold algorithm: ends when no unread row can belong to an answer."""
        n = len(self.x)
        plus, minus = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen, score = np.zeros(n, bool), np.zeros(n, np.int64)
        depth, deeper = 0, min(FIRST_DEPTH, n)
        while True:
            new = np.zeros(n, bool)
            new[self.up[n - deeper:n - depth, plus].ravel()] = True
            new[self.up[depth:deeper, minus].ravel()] = True
            if not len(plus) and not len(minus):
                new[:] = True  # every score is zero: there is no list to read
            at = np.flatnonzero(new & ~seen)
            score[at] = self.x[at] @ anchor
            seen[at] = True
            threshold = int(self.values[n - deeper, plus] @ anchor[plus]) + int(self.values[deeper - 1, minus] @ anchor[minus])
            if deeper == n or seen.all() or all(self._closed(score, seen & wanted, threshold, w, keep) for w in windows):
                break
            depth, deeper = deeper, min(2 * deeper, n)
        return [self._best(score, seen & wanted, w, keep, tie) for w in windows]

    @staticmethod
    def _closed(score: np.ndarray, known: np.ndarray, threshold: int, window: tuple[int, int], keep: int) -> bool:
        least, most = window
        if threshold < least or most < least:
            return True
        inside = score[known & (score >= least) & (score <= most)]
        return len(inside) >= keep and threshold < np.partition(inside, len(inside) - keep)[len(inside) - keep]

    @staticmethod
    def _best(score: np.ndarray, known: np.ndarray, window: tuple[int, int], keep: int, tie: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(known & (score >= window[0]) & (score <= window[1]))
        if len(at) > keep:  # only what can be among the first
            at = at[score[at] >= np.partition(score[at], len(at) - keep)[len(at) - keep]]
        return at[np.lexsort((tie[at], -score[at]))[:keep]]


def prepared(rows: DataFrame, label: Column, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(node, sid, label, x, dims): the rows that take part, with integer vectors;
    ``node`` numbers the rows, ``sid`` is the id, largest for null."""
    v, x = F.col("v"), F.col("x")
    ok = v.isNotNull() & (F.size(v) > 0) & F.col("label").isNotNull() & ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    got = rows.select(F.col(f"`{key}`").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                      F.transform(F.col(f"`{vector}`"), lambda e: e.cast("double")).alias("v")).where(F.coalesce(ok, F.lit(False)))
    whole = got.withColumn("w", F.aggregate(v, F.lit(0.0), lambda a, e: a + (e * SCALE) * (e * SCALE)))
    # a wide bound before the components become integers, the exact one after
    whole = whole.where(F.col("w") < float(1 << 64)).withColumn("x", F.transform(v, lambda e: F.floor(e * SCALE).cast("long"))).drop("w", "v")
    whole = whole.where(F.aggregate(x, F.lit(0).cast("decimal(38,0)"), lambda a, e: (a + (e.cast("decimal(19,0)") * e)).cast("decimal(38,0)")) < F.lit(1 << 62))
    return written(whole.select(F.monotonically_increasing_id().alias("node"), F.coalesce("vec_id", F.lit(MAX_LONG)).alias("sid"), "label", "x", F.size("x").alias("dims")))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def _tiles(anchors: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with dims, ab, cb: every anchor meets every row of its length once.
    The anchors' columns get the prefix a_."""
    sizes = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).join(anchors.groupBy("dims").agg(F.count(F.lit(1)).alias("a")), "dims")
    sizes = sizes.select(F.col("dims").alias("sd"), F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("cbs"), F.ceil(F.col("a") / ANCHORS_AT_ONCE).cast("int").alias("abs"))

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        sized = side.join(sizes, F.col("dims") == F.col("sd"))
        return sized.withColumn(own, F.pmod(F.xxhash64("node"), F.col(f"{own}s")).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).drop("sd", "cbs", "abs")

    names = [*anchors.columns, "ab", "cb"]
    return dealt(anchors, "ab", "cb").select(*[F.col(c).alias(f"a_{c}") for c in names]), dealt(rows, "cb", "ab")


FOUND = "a_node long, window int, node long, sid long, score long, x array<long>"


def _search(same_label: bool, keep: int):
    def search(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        got: list[tuple[int, int, int, int]] = []
        if anchors.num_rows and rows.num_rows:
            rows = rows.take(pa.array(np.lexsort((rows["node"].to_numpy(), rows["sid"].to_numpy()))))
            x, label, node = _matrix(rows["x"]), rows["label"].to_numpy(), rows["node"].to_numpy()
            # ties: by id, rows of one id by their vectors
            tie = np.empty(len(x), np.int64)
            tie[np.lexsort((*x.T[::-1], rows["sid"].to_numpy()))] = np.arange(len(x))
            lists = Lists(x)
            for a, own, vector, windows in zip(*(anchors[f"a_{c}"].to_pylist() for c in ("node", "label")), _matrix(anchors["a_x"]), anchors["a_windows"].to_pylist()):
                wanted = (label == own) & (node != a) if same_label else label != own
                for w, best in enumerate(lists.search(vector, wanted, [(s["least"], s["most"]) for s in windows], keep, tie)):
                    got += [(a, w, int(i), int(x[i] @ vector)) for i in best]
        at = [g[2] for g in got]
        found = rows.take(pa.array(at, pa.int64()))
        return pa.table([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int32()), found["node"], found["sid"],
                         pa.array([g[3] for g in got], pa.int64()), found["x"]], names=["a_node", "window", "node", "sid", "score", "x"])
    return search


def threshold_search(anchors: DataFrame, rows: DataFrame, same_label: bool, keep: int) -> DataFrame:
    """(a_node, window, rank, node, sid, score): for each window of each anchor
    (node, label, x, dims, windows: array of least and most) its ``keep`` best of
    ``rows`` with the anchor's label (other rows) or with another label."""
    left, right = _tiles(anchors, rows)
    place = ("dims", "ab", "cb")
    met = left.groupBy(*[f"a_{c}" for c in place]).cogroup(right.groupBy(*place)).applyInArrow(_search(same_label, keep), FOUND)
    by = Window.partitionBy("a_node", "window").orderBy(F.desc("score"), "sid", "x", "node")
    return met.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= keep).drop("x")


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of
    ``rows`` as of ``prepared``; ``is_anchor`` is a condition on ``sid``."""
    anchors = rows.where(is_anchor & (F.col("sid") < MAX_LONG))
    whole = F.struct(F.lit(-MAX_LONG).alias("least"), F.lit(MAX_LONG).alias("most"))
    first = written(threshold_search(anchors.withColumn("windows", F.array(whole)), rows, True, positives))
    # window of the negatives: ceil of the least share up to the positive's own score
    spans = first.groupBy("a_node").agg(F.array_sort(F.collect_list(F.struct("rank", "sid", "score"))).alias("found"))
    share = lambda p: F.ceil(p["score"].cast("decimal(25,0)") * LEAST / F.lit(MOST)).cast("long")
    sought = anchors.join(spans, F.col("node") == F.col("a_node")).withColumn(
        "windows", F.transform("found", lambda p: F.struct(share(p).alias("least"), p["score"].alias("most")))).drop("a_node", "found")
    second = threshold_search(sought, rows, False, negatives)
    own = first.select(F.col("a_node").alias("pa"), (F.col("rank") - 1).alias("pw"), F.col("sid").alias("positive_sid"), F.col("score").alias("positive_score"))
    ids = anchors.select(F.col("node").alias("an"), F.col("sid").alias("anchor_id"))
    shown = lambda c: F.when(F.col(c) < MAX_LONG, F.col(c))
    return (second.join(own, (F.col("a_node") == F.col("pa")) & (F.col("window") == F.col("pw"))).join(ids, F.col("a_node") == F.col("an"))
            .select("anchor_id", shown("positive_sid").alias("positive_id"), "rank", shown("sid").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(prepared(table(spark, sf_dir, "embeddings"), label), F.col("sid") % 100 == 0)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda e: floor(256 * e)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id AND len(a.x) = len(b.x)),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id)
QUALIFY row_number() OVER w <= 5"""
