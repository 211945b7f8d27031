"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors whose cosine is at least c differ by a squared distance of at most
D = 2 - 2c.  After a fixed random rotation, which spreads the distance evenly,
the components are split into blocks of ``BLOCK_DIMS``; a block of b of the d
components has the budget D * b / d.  Budgets sum to D, so each linked pair
keeps to the budget of one block at least.  Every block is range-joined by
itself: components are cut into intervals (about the mean, as many cells as the
label's vectors ask for), a vector is at home in one cell and is also sent to
the cells that the budget's radius reaches.  In a cell, home vectors meet all
others; pairs within the block's budget are verified exactly (cosine of the
original vectors, double precision).  A pair counts in the first block whose
budget it keeps, which both vectors tell alike, so that the union of the blocks
needs no table of pairs: a task returns each vector's number of links and a
spanning set of its links, at most one row for each vector it has read.

Equal vectors of a label are joined once and weighted.  Cells of more than
``TILE_ROWS`` vectors are split into tiles (chunk of home vectors by chunk of
others).

Results for odd input: vectors that are null, empty, all zero or hold a null or
non-finite component, and rows of null label, link with nothing; nor do vectors
of unlike length; equal rows and repeated ids are vectors of their own, a null
vec_id too (it names no component); an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import prepare, table, written
from riskframe.llm.near_dups import components

SIMILARITY = 0.98
BLOCK_DIMS = 8
#: vectors of a label that one cell is meant for, and rows of a cell that meet in one task
CELL_ROWS = 2_048
TILE_ROWS = 4_096
#: what rounding may add to a squared distance of stored (single precision) unit vectors
SLACK = 1e-6
SEED = 12
#: pairs that are verified at once
PAIRS_AT_ONCE = 50_000


def valid(v: Column) -> Column:
    """Whether an array is a vector of finite components, not all zero."""
    ok = (v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
          & F.exists(v, lambda x: x != 0))
    return F.coalesce(ok, F.lit(False))


def blocks(dims: int) -> np.ndarray:
    """First component of each block, and ``dims`` at the end."""
    return np.append(np.arange(0, dims, BLOCK_DIMS), dims)


def budgets(dims: int, similarity: float) -> np.ndarray:
    """Squared-distance budget of each block, in proportion to its components."""
    return (2 - 2 * similarity + SLACK) * np.diff(blocks(dims)) / dims


@functools.lru_cache(maxsize=8)
def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that squares neither overflow nor vanish."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def _matrix(column, dtype) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column("dims").to_numpy()
        for d in np.unique(dims):
            yield batch.take(pa.array(np.flatnonzero(dims == d)))


def _rotated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds u: the rotated unit vector, single precision."""
    for batch in _by_length(batches):
        v = scaled(_matrix(batch.column("v"), np.float64))
        u = (v / np.sqrt((v * v).sum(axis=1, keepdims=True)) @ rotation(v.shape[1])).astype(np.float32)
        yield batch.append_column("u", pa.array(list(u), pa.list_(pa.float32())))


def cut_bits(rows: int, dims: int, cell_rows: int = CELL_ROWS) -> np.ndarray:
    """Bits of each component of a block: 2 ** their sum cells hold ``rows`` vectors."""
    need = int(np.ceil(np.log2(max(1.0, rows / cell_rows))))
    return need // dims + (np.arange(dims) < need % dims)


def intervals(x: np.ndarray, mean: float, spread: float, bits: int) -> np.ndarray:
    """Interval (0 .. 2 ** bits - 1) of each value; cuts as for a normal distribution."""
    cuts = [mean + spread * NormalDist().inv_cdf(i / 2 ** bits) for i in range(1, 2 ** bits)]
    return np.searchsorted(np.array(cuts), x, side="right")


def reached_cells(u: np.ndarray, radius: float, mean: np.ndarray, spread: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home): the cells of a block that each row's ball reaches."""
    row, cell, home = np.arange(len(u)), np.zeros(len(u), np.int64), np.ones(len(u), bool)
    for j in np.flatnonzero(bits):
        low, own, high = (intervals(u[:, j] + by, mean[j], spread[j], int(bits[j])) for by in (-radius, 0.0, radius))
        n = (high - low + 1)[row]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        row, cell, home = np.repeat(row, n), np.repeat(cell, n), np.repeat(home, n)
        at = low[row] + step
        cell, home = cell * 2 ** int(bits[j]) + at, home & (at == own[row])
    return row, cell, home


def _filed(similarity: float, cell_rows: int):
    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector in its home cell and the cells it reaches, for every block."""
        for batch in _by_length(batches):
            label, n = batch.column("label").to_numpy(), batch.column("n").to_numpy()
            u = _matrix(batch.column("u"), np.float64)
            start, budget = blocks(u.shape[1]), budgets(u.shape[1], similarity)
            for g in np.unique(label):
                own = np.flatnonzero(label == g)
                group = batch.take(pa.array(own))
                mean, spread = (_matrix(group.column(c).slice(0, 1), np.float64)[0] for c in ("mean", "spread"))
                for b, (i, j) in enumerate(zip(start, start[1:])):
                    bits = cut_bits(n[own[0]], j - i, cell_rows)
                    row, cell, home = reached_cells(u[own, i:j], np.sqrt(budget[b]) * (1 + SLACK), mean[i:j], spread[i:j], bits)
                    for at in range(0, len(row), 10_000):
                        part = slice(at, at + 10_000)
                        got = group.take(pa.array(row[part])).select(["label", "dims", "node", "weight", "v", "u"])
                        yield (got.append_column("block", pa.array(np.full(got.num_rows, b), pa.int32()))
                               .append_column("cell", pa.array(cell[part])).append_column("home", pa.array(home[part])))
    return filed


FILED = "label long, dims int, node long, weight long, v array<{kind}>, u array<float>, block int, cell long, home boolean"


def _linked(v: np.ndarray, norm: np.ndarray, u: np.ndarray, a: np.ndarray, b: np.ndarray, block: int, similarity: float) -> np.ndarray:
    """Whether the pairs are similar and ``block`` is the first whose budget they keep.
    Sums run over a pair's own components, the same in any task and either way round."""
    out = np.zeros(len(a), bool)
    start, budget = blocks(u.shape[1])[:-1], budgets(u.shape[1], similarity)
    for at in range(0, len(a), PAIRS_AT_ONCE):
        x, y = a[at:at + PAIRS_AT_ONCE], b[at:at + PAIRS_AT_ONCE]
        apart = np.add.reduceat((u[x] - u[y]) ** 2, start, axis=1) <= budget
        first = apart[:, block] & ~apart[:, :block].any(axis=1)
        x, y = x[first], y[first]
        cosine = (v[x] * v[y]).sum(axis=1) / (norm[x] * norm[y])
        out[at + np.flatnonzero(first)] = cosine >= similarity
    return out


def joined_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (a smaller or the own position for each) after the links (a, b)."""
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        low = np.minimum(x, y)
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        while (root != root[root]).any():
            root = root[root]


def _cell(similarity: float):
    def cell(rows: pa.Table) -> pa.Table:
        """(node, links, root) of one block's cell, or tile of it: links of home vectors,
        and for each linked vector the smallest node that it is linked with here."""
        rows = rows.take(pa.array(np.argsort(rows["node"].to_numpy(), kind="stable")))
        node, weight, block = rows["node"].to_numpy(), rows["weight"].to_numpy(), int(rows["block"][0].as_py())
        v, u = scaled(_matrix(rows["v"], np.float64)), _matrix(rows["u"], np.float64)
        norm = np.sqrt((v * v).sum(axis=1))
        i, j = blocks(u.shape[1])[block:block + 2]
        limit = budgets(u.shape[1], similarity)
        home, other = np.flatnonzero(rows["as_home"].to_numpy()), np.flatnonzero(rows["as_other"].to_numpy())
        own, theirs = u[home], u[other]
        square = lambda m, s: (m[:, s] ** 2).sum(axis=1)
        links, root = np.zeros(len(node), np.int64), np.arange(len(node))
        step = max(1, 2_000_000 // max(1, len(other)))
        for at in range(0, len(home), step):
            part = own[at:at + step]

            def near(s: slice, most: float) -> np.ndarray:
                return square(part, s)[:, None] + square(theirs, s)[None, :] - 2 * part[:, s] @ theirs[:, s].T <= most

            ok = near(slice(i, j), limit[block] + 1e-9)
            if ok.sum() > 4 * len(part):  # many copies: leave out what surely counted in an earlier block
                for e, (k, m) in enumerate(zip(blocks(u.shape[1])[:block], blocks(u.shape[1])[1:])):
                    ok &= ~near(slice(k, m), limit[e] - 1e-9)
            x, y = np.nonzero(ok)
            x, y = home[at + x], other[y]
            x, y = x[x != y], y[x != y]
            good = _linked(v, norm, u, x, y, block, similarity)
            x, y = x[good], y[good]
            np.add.at(links, x, weight[y])
            root = joined_roots(root, x, y)
        told = np.flatnonzero((links > 0) | (root != np.arange(len(node))))
        return pa.table({"node": node[told], "links": links[told], "root": node[root[told]]})
    return cell


def linked_vectors(vectors: DataFrame, similarity: float = SIMILARITY, cell_rows: int = CELL_ROWS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(node, links, root) rows of ``vectors`` (label, dims, node, weight, v): sums of
    links by node are the weights of the other nodes linked with it, and the pairs
    (node, root) connect what links connect."""
    kind = vectors.schema["v"].dataType.elementType.simpleString()
    turned = written(vectors.mapInArrow(_rotated, f"label long, dims int, node long, weight long, v array<{kind}>, u array<float>"))
    x = turned.select("label", "dims", F.posexplode("u").alias("j", "x"))
    moments = x.groupBy("label", "dims", "j").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"), F.count(F.lit(1)).alias("n"))
    # one row for each label: a mean and a spread of every component
    groups = moments.groupBy(F.col("label").alias("gl"), F.col("dims").alias("gd")).agg(
        F.max("n").alias("n"), *[F.array_sort(F.collect_list(F.struct("j", c))).getField(c).alias(name) for c, name in (("m", "mean"), ("s", "spread"))])
    grouped = turned.join(groups, (F.col("label") == F.col("gl")) & (F.col("dims") == F.col("gd"))).drop("gl", "gd")
    filed = grouped.mapInArrow(_filed(similarity, cell_rows), FILED.format(kind=kind))
    place = ["label", "dims", "block", "cell"]
    large = filed.groupBy(*place).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > tile_rows).select(
        *[F.col(c).alias(f"l_{c}") for c in place], F.ceil(F.col("size") / tile_rows).cast("int").alias("m"))
    on = [F.col(c) == F.col(f"l_{c}") for c in place]
    # a vector of a large cell: its chunk of home vectors meets every chunk of others, and the other way round
    m, own, flags = F.coalesce("m", F.lit(1)), F.pmod(F.xxhash64("node"), F.coalesce("m", F.lit(1))).cast("int"), ("p", "q", "as_home", "as_other")
    tile = lambda p, q, a, o: F.struct(p.alias("p"), q.alias("q"), a.alias("as_home"), o.alias("as_other"))
    every = F.sequence(F.lit(0), m - 1)
    tiles = F.concat(F.transform(every, lambda k: tile(own, k, F.col("home"), k == own)),
                     F.transform(F.filter(every, lambda k: k != own), lambda k: tile(k, own, F.lit(False), F.lit(True))))
    dealt = filed.join(large, on, "left").withColumn("t", F.explode(tiles)).select(*filed.columns, *[f"t.{c}" for c in flags])
    return dealt.groupBy(*place, "p", "q").applyInArrow(_cell(similarity), "node long, links long, root long")


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", similarity: float = SIMILARITY,
                    cell_rows: int = CELL_ROWS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each of ``rows``: linked are
    vectors of equal label with a cosine of ``similarity`` at least."""
    named = rows.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("v"), F.col(f"`{label}`").cast("long").alias("label"))
    usable = valid(F.col("v")) & F.col("label").isNotNull()
    alone = named.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    some = named.where(usable)
    distinct = some.groupBy("label", "v").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first"))
    distinct = distinct.withColumn("node", F.monotonically_increasing_id())  # fixed by writing
    vectors = written(distinct.select("label", F.size("v").alias("dims"), "node", "weight", "v", "first"))
    links = written(linked_vectors(vectors.drop("first"), similarity, cell_rows, tile_rows))
    # a node's component: its own number where nothing is linked
    met = written(components(links.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct()))
    counts = links.groupBy(F.col("node").alias("ln")).agg(F.sum("links").alias("links"))
    of = (vectors.drop("v").join(met.select(F.col("node").alias("mn"), F.col("label").alias("component")), F.col("node") == F.col("mn"), "left")
          .join(counts, F.col("node") == F.col("ln"), "left").withColumn("component", F.coalesce("component", "node")))
    of = written(of.select("node", "component", "first", (F.coalesce("links", F.lit(0).cast("long")) + F.col("weight") - 1).alias("n_links")))
    names = of.groupBy(F.col("component").alias("cn")).agg(F.min("first").alias("component_id"))
    of = of.join(names, F.col("component") == F.col("cn")).select(F.col("node").alias("rn"), "n_links", "component_id")
    told = vectors.join(of, F.col("node") == F.col("rn")).select(F.col("label").alias("rl"), F.col("v").alias("rv"), "n_links", "component_id")
    back = some.join(told, (F.col("label") == F.col("rl")) & (F.col("v") == F.col("rv"))).select("vec_id", "n_links", "component_id")
    return back.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op12_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP12_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
near AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(near.b, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(near.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN near ON near.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""
