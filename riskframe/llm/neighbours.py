"""Approximate nearest neighbours by learned partitions (largest inner product).

A bounded sample of the distinct vectors gives a neighbour graph; recursive
spectral bisection with swap refinement cuts it into balanced parts; a small
network learns which parts hold the neighbours of a point.  The network files
every distinct vector under its most probable part and sends each query to
several most probable parts, where all vectors are ranked exactly (double
precision).

Equal vectors are indexed once, with their smallest ids (as many as an answer
can hold), so that any number of copies costs one row.  Large parts and large
query lists are split into blocks that meet block by block.

Results for odd input: vectors that are null, empty, all zero, hold a null or
non-finite component, or have another length than most take no part, nor do
rows with a null id; of rows with equal id the smallest vector counts; ties go
to the smaller id; with fewer candidates than asked for all are returned; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import hash_share, prepare, sample_share, table

#: bound of the fit: about so many distinct vectors
SAMPLE = 6_000
#: distinct vectors of a part, and most parts
PART_ROWS = 2_048
MAX_PARTS = 256
#: a query visits so many of its most probable parts that held-out queries of
#: the sample find this share of their true neighbours (by brute force)
RECALL = 0.95
HELD_OUT = 500
NEAREST = 20
NEIGHBOURS = 12
HIDDEN = 96
EPOCHS = 30
#: rows that meet in one task
INDEX_BLOCK = 2_048
QUERY_BLOCK = 512


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): valid vectors of the most common length, one for each id."""
    v = F.col("v")
    ok = (F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
          & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
          & F.exists(v, lambda x: x != 0))
    got = rows.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("v")).where(F.coalesce(ok, F.lit(False)))
    sizes = got.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not sizes:
        return got
    return got.where(F.size("v") == sizes[0]["n"]).groupBy("vec_id").agg(F.min("v").alias("v"))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(vid, v, ids): each distinct vector with its ``keep`` smallest ids; vid is the first."""
    by = Window.partitionBy("v").orderBy("vec_id")
    first = rows.withColumn("n", F.row_number().over(by)).where(F.col("n") <= keep)
    return first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("vid"), "v", "ids")


@dataclass
class Router:
    hidden: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.hidden + self.bias, 0) @ self.out + self.out_bias


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """For each row its k best others by inner product."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), np.int64)
    for b in range(0, len(x), 1024):
        s = x[b:b + 1024] @ x.T
        s[np.arange(len(s)), np.arange(b, b + len(s))] = -np.inf
        out[b:b + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def _bisect(nodes: np.ndarray, src: np.ndarray, dst: np.ndarray, rng) -> np.ndarray:
    """True for the half of ``nodes`` on one side; edges are inside ``nodes``."""
    n = len(nodes)
    degree = np.bincount(src, minlength=n) + 1.0
    root = np.sqrt(degree)
    top = root / np.linalg.norm(root)
    f = rng.normal(size=n)
    for _ in range(60):  # second vector of the lazy random walk
        f -= top * (top @ f)
        g = f / root
        f = 0.5 * (f + (np.bincount(src, g[dst], n) + g) / root)
        f /= np.linalg.norm(f) + 1e-30
    side = np.zeros(n, bool)
    side[np.argsort(f / root, kind="stable")[n // 2:]] = True
    for _ in range(8):  # swap the pairs that gain most, sides stay equal
        other = np.bincount(src, (side[src] != side[dst]).astype(float), n)
        gain = 2 * other - np.bincount(src, minlength=n)
        a = np.flatnonzero(side)[np.argsort(-gain[side], kind="stable")]
        b = np.flatnonzero(~side)[np.argsort(-gain[~side], kind="stable")]
        m = min(len(a), len(b))
        good = int(np.searchsorted(-(gain[a[:m]] + gain[b[:m]]), -2))  # both would gain
        swap = max(0, good // 2)
        if not swap:
            break
        side[a[:swap]], side[b[:swap]] = False, True
    return side


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 5) -> np.ndarray:
    """Part (0 .. parts-1, a power of two) of each node, of equal sizes within one per cut."""
    n, rng = len(graph), np.random.default_rng(seed)
    src, dst = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    src, dst = np.concatenate([src, dst]), np.concatenate([dst, src])
    label = np.zeros(n, np.int64)
    groups = 1
    while groups < parts:
        nxt = label * 2
        for g in range(groups):
            nodes = np.flatnonzero(label == g)
            if len(nodes) < 2:
                continue
            local = np.full(n, -1)
            local[nodes] = np.arange(len(nodes))
            inside = (local[src] >= 0) & (local[dst] >= 0)
            nxt[nodes[_bisect(nodes, local[src[inside]], local[dst[inside]], rng)]] += 1
        label, groups = nxt, groups * 2
    return label


def train_router(x: np.ndarray, label: np.ndarray, graph: np.ndarray, parts: int, seed: int = 6) -> Router:
    """Cross-entropy against the parts of a point and of its neighbours (Adam)."""
    rng = np.random.default_rng(seed)
    target = np.zeros((len(x), parts), np.float32)
    np.add.at(target, (np.arange(len(x)), label), 0.5)
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].ravel()), 0.5 / max(1, graph.shape[1]))
    d = x.shape[1]
    w = [rng.normal(0, np.sqrt(2 / d) * np.sqrt(d) / max(1e-9, np.sqrt((x * x).sum(1).mean())), (d, HIDDEN)).astype(np.float32),
         np.zeros(HIDDEN, np.float32), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)).astype(np.float32), np.zeros(parts, np.float32)]
    m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for b in range(0, len(order), 256):
            own = order[b:b + 256]
            pre = x[own] @ w[0] + w[1]
            act = np.maximum(pre, 0)
            z = act @ w[2] + w[3]
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            e = (p - target[own]) / len(own)
            back = (e @ w[2].T) * (pre > 0)
            t += 1
            for i, g in enumerate((x[own].T @ back, back.sum(0), act.T @ e, e.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.99 * v[i] + 0.01 * g * g
                w[i] -= 0.004 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.99 ** t)) + 1e-8)
    return Router(*w)


def probes_for(router: Router, x: np.ndarray, queries: np.ndarray, parts: int, target: float = RECALL) -> int:
    """Fewest parts to visit so that ``queries`` find ``target`` of their nearest rows of ``x``."""
    near = min(NEAREST, len(x))
    score = queries @ x.T
    top = np.argpartition(-score, near - 1, axis=1)[:, :near]
    home = router.logits(x).argmax(axis=1)
    rank = np.argsort(np.argsort(-router.logits(queries), axis=1, kind="stable"), axis=1)  # of each part, for each query
    turn = np.take_along_axis(rank, home[top], axis=1).ravel()  # visit at which each true neighbour is found
    found = np.cumsum(np.bincount(turn, minlength=parts)) / len(turn)
    return int(np.searchsorted(found, target) + 1)


def fit(vectors: DataFrame, count: int) -> tuple[Router | None, int, int]:
    """The router, the number of parts and how many a query visits, from a bounded sample."""
    parts = 1
    while parts < MAX_PARTS and parts * PART_ROWS < count:
        parts *= 2
    if parts == 1:
        return None, 1, 1
    got = vectors.where(hash_share("vid", seed="ann") < sample_share(count, SAMPLE)).select("vid", "v").toPandas().sort_values("vid")
    x = np.stack(got["v"].to_numpy()).astype(np.float32)
    x = x[np.random.default_rng(4).permutation(len(x))]
    asked, x = x[:min(HELD_OUT, len(x) // 8)], x[min(HELD_OUT, len(x) // 8):]
    graph = neighbour_graph(x, NEIGHBOURS)
    router = train_router(x, balanced_parts(graph, parts), graph, parts)
    return router, parts, min(parts, probes_for(router, x, asked, parts))


def routed(vectors: DataFrame, router: Router | None, probes: int) -> DataFrame:
    """``vectors`` plus parts: the ``probes`` most probable."""
    shipped = vectors.sparkSession.sparkContext.broadcast(router)

    @F.pandas_udf("array<int>")
    def choose(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in batches:
            if shipped.value is None or not len(v):
                yield pd.Series([[0]] * len(v))
                continue
            z = shipped.value.logits(np.stack(v.to_numpy()).astype(np.float32))
            yield pd.Series(list(np.argsort(-z, axis=1, kind="stable")[:, :probes].astype(np.int32)))

    return vectors.withColumn("parts", choose("v"))


def nearest_in_block(q: np.ndarray, c: np.ndarray, first: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, scores), queries x min(keep, rows): the best rows of ``c`` for
    each query, best first, ties to the smaller ``first``."""
    near = min(keep, len(c))
    wide = min(len(c), near + 8)
    rough = q @ c.T
    at = np.argpartition(-rough, wide - 1, axis=1)[:, :wide] if wide < len(c) else np.tile(np.arange(len(c)), (len(q), 1))
    exact = np.stack([(c[a] * v).sum(axis=1) for a, v in zip(at, q)])  # the same sum for a pair in any block
    order = np.lexsort((first[at], -exact), axis=1)[:, :near]
    at, score = np.take_along_axis(at, order, 1), np.take_along_axis(exact, order, 1)
    if wide < len(c):  # where more than ``wide`` rows tie with the last one wanted, rank them all
        floor = np.take_along_axis(rough, at[:, -1:], 1)
        for i in np.flatnonzero((rough >= floor - 1e-9).sum(axis=1) > wide):
            every = np.flatnonzero(rough[i] >= floor[i] - 1e-9)
            full = (c[every] * q[i]).sum(axis=1)
            o = np.lexsort((first[every], -full))[:near]
            at[i], score[i] = every[o], full[o]
    return at, score


def _meet(keep: int):
    def meet(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(index):
            return pd.DataFrame({"qid": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        c, q = (np.stack(f["v"].to_numpy()).astype(np.float64) for f in (index, queries))
        at, score = nearest_in_block(q, c, index["vid"].to_numpy(), keep)
        ids = index["ids"].to_list()
        found = pd.DataFrame({"qid": np.repeat(queries["qid"].to_numpy(), at.shape[1]), "at": at.ravel(), "score": score.ravel()})
        # what the query's first part has beaten already is not needed
        found = found[score.ravel() >= np.repeat(queries["floor"].to_numpy(np.float64), at.shape[1])]
        if max(map(len, ids)) == 1:  # no copies here
            return found.assign(vec_id=np.array([i[0] for i in ids])[found["at"]])[["qid", "vec_id", "score"]]
        found = found.assign(vec_id=[ids[i] for i in found["at"]]).explode("vec_id").astype({"vec_id": np.int64, "score": np.float64})
        found = found.sort_values(["qid", "score", "vec_id"], ascending=[True, False, True], kind="stable")
        return found.groupby("qid", sort=False).head(keep)[["qid", "vec_id", "score"]]
    return meet


def search(rows: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for the rows that
    ``is_query`` (a column of vec_id) selects, among all rows but the query's own."""
    spark, keep = rows.sparkSession, k + 1
    valid = usable(rows).checkpoint()
    index = distinct_vectors(valid, keep).checkpoint()
    router, parts, probes = fit(index, index.count())
    filed = routed(index, router, 1).withColumn("part", F.col("parts")[0]).drop("parts").checkpoint()
    asked = valid.where(is_query).select(F.col("vec_id").alias("query_id"), "v").join(index.select("v", "vid"), "v")
    asked = asked.select("query_id", F.col("vid").alias("qid"), "v").checkpoint()
    once = asked.groupBy("qid").agg(F.min("v").alias("v"))
    visits = routed(once, router, probes).select("qid", "v", F.posexplode("parts").alias("turn", "part")).checkpoint()
    # rows of each part (at most MAX_PARTS rows come to the driver)
    sizes = {r["part"]: r["count"] for r in filed.groupBy("part").count().collect()}
    hash_turn = lambda key, n: F.pmod(F.xxhash64(key), n).cast("int")

    def visited(queries: DataFrame) -> DataFrame:
        """The best rows of each query's parts, block by block."""
        loads = {r["part"]: r["count"] for r in queries.groupBy("part").count().collect()}
        plan = spark.createDataFrame([(p, -(-sizes.get(p, 0) // INDEX_BLOCK) or 1, -(-loads.get(p, 0) // QUERY_BLOCK) or 1) for p in range(parts)],
                                     "part int, index_blocks int, query_blocks int")
        left = (queries.join(F.broadcast(plan), "part").withColumn("qb", hash_turn("qid", F.col("query_blocks")))
                .withColumn("ib", F.explode(F.sequence(F.lit(0), F.col("index_blocks") - 1))))
        right = (filed.join(F.broadcast(plan), "part").withColumn("ib", hash_turn("vid", F.col("index_blocks")))
                 .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1))))
        return left.select("part", "ib", "qb", "qid", "v", "floor").groupBy("part", "ib", "qb").cogroup(
            right.select("part", "ib", "qb", "vid", "v", "ids").groupBy("part", "ib", "qb")).applyInPandas(
            _meet(keep), "qid long, vec_id long, score double")

    # the most probable part first: its last wanted score bounds what the others may return
    lowest = F.lit(float("-inf"))
    near = visited(visits.where("turn = 0").withColumn("floor", lowest)).checkpoint()
    place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id"))
    floors = near.withColumn("n", place).where(F.col("n") == keep).select("qid", F.col("score").alias("floor"))
    met = near
    if probes > 1:
        met = near.union(visited(visits.where("turn > 0").join(floors, "qid", "left").withColumn("floor", F.coalesce("floor", lowest))))
    order = [F.desc("score"), F.col("vec_id")]
    best = met.withColumn("n", F.row_number().over(Window.partitionBy("qid").orderBy(*order))).where(F.col("n") <= keep).drop("n")
    answers = asked.select("query_id", "qid").join(best, "qid").where(F.col("vec_id") != F.col("query_id"))
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op7_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
