"""Conversation trie, embedding near-dedup and hard negatives against brute force."""

import hashlib
import math
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import hard_negatives, queries, tries, vector_dups

CONV = "conv_id long, turn long, role string, text string"
VEC = "vec_id long, embedding array<float>, label int"


def save(spark, rows, schema, folder, name):
    """A table under ``folder`` with columns whose names clash with outputs."""
    df = spark.createDataFrame(rows, schema).repartition(3)
    for c in ("node", "id", "parent", "depth", "pos", "k", "rank", "score", "sid", "x", "n_links", "kept", "child", "up"):
        df = df.withColumn(c, F.lit("clash"))
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


# ------------------------------------------------------------------ trie

def rebuilt(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    seqs = {c: [t[2:] for t in sorted(v)] for c, v in by.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 9 for c in seqs}
    return {c: seqs.get(c - c % 5, [])[:heads[c]] + s[heads[c]:] for c, s in seqs.items()}


def trie(seqs):
    members, kids = defaultdict(list), defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for key in members:
        if key:
            kids[key[:-1]].append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        leaves[key] = sum(leaves[k] for k in kids[key]) or 1
        saved[key] = sum(saved[k] for k in kids[key]) + ((len(members[key]) - 1) * len(key[-1][1].encode()) if key else 0)
    return {(min(m), len(key), min(members[key[:-1]]) if key else None, len(m), len(kids[key]), leaves[key], saved[key],
             hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(key)).encode()).hexdigest()) for key, m in members.items()}


def talk(seed, convs, most):
    rng = np.random.default_rng(seed)
    return [(int(c), t, ("user", "assistant")[t % 2], f"tür {rng.integers(0, 3)}") for c in rng.permutation(convs) for t in range(int(rng.integers(1, most)))]


ODD_TURNS = [(None, 0, "user", "lost"), (500, None, "user", "first"), (500, 0, None, None), (500, 0, None, None), (500, 1, "user", None),
             (501, 0, "user", ""), (502, 0, "", ""), (503, 7, "assistant", "x" * 5000), (504, 3, "user", "alone")]


EVERYTHING = (talk(2, 40, 14) + ODD_TURNS + [(1005 + c, t, "u", "same") for c, n in ((0, 150), (1, 90)) for t in range(n)]
              + [(2000 + i, 0, "u", "hello") for i in range(400)])


@pytest.mark.parametrize("rows", [EVERYTHING, [(3, 0, "u", "no base, all cut")]])
def test_trie_is_the_brute_force_one(spark, tmp_path, rows):
    got = tries.op11_conversation_trie(spark, save(spark, rows, CONV, tmp_path, "conversations"))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == trie(rebuilt(rows))


def test_trie_of_no_conversations(spark, tmp_path):
    assert tries.op11_conversation_trie(spark, save(spark, [], CONV, tmp_path, "conversations")).count() == 0


def test_chunks_of_ends_hash_as_one_text(spark, monkeypatch):
    monkeypatch.setattr(tries, "ENDS_IN_CHUNK", 7)
    ends = spark.range(100).select(F.lit(3).cast("long").alias("depth"), (F.col("id") % 2).alias("k1"), F.lit(0).cast("long").alias("k2"), F.col("id").alias("conv_id"))
    got = {r["k1"]: r["ends_sha256"] for r in tries.ends_digests(ends).collect()}
    assert got == {k: hashlib.sha256(",".join(str(i) for i in range(k, 100, 2)).encode()).hexdigest() for k in (0, 1)}


def test_contraction_of_trees(spark):
    """Totals over a random forest with a long chain and a wide node; rounds grow with the logarithm of the depth."""
    rng = np.random.default_rng(7)
    parent = {0: None, 1000: None}
    parent |= {i: i - 1 for i in range(1, 300)}
    parent |= {1000 + i: 1000 for i in range(1, 200)}
    parent |= {2000 + i: int(rng.choice([5, 1007, *range(2000, 2000 + i)])) for i in range(300)}
    own = {i: int(rng.integers(0, 9)) for i in parent}
    want = dict(own)
    for i in sorted(parent, key=lambda n: (lambda f: f(f, n))(lambda f, n: 0 if parent[n] is None else 1 + f(f, parent[n])), reverse=True):
        if parent[i] is not None:
            want[parent[i]] += want[i]
    tree = spark.createDataFrame([(i, p, own[i]) for i, p in parent.items()], "id long, parent long, w long")
    assert {r["id"]: r["total_w"] for r in tries.subtree_totals(tree, ["w"]).collect()} == want


def test_last_turns_of_nodes(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "b", "b"), (2, 0, "u", "a"), (2, 1, "b", "c")]
    talks = spark.createDataFrame(rows, CONV)
    turns = tries.turns_of(talks)
    nodes = tries.prefix_trie(turns, turns)
    said = tries.with_last_turns(nodes, talks.withColumnRenamed("turn", "pos")).select("conv_id", "depth", "last_text").collect()
    assert {tuple(r) for r in said} == {(1, 0, None), (1, 1, "a"), (1, 2, "b"), (2, 2, "c")}


# ------------------------------------------------------------------ vectors

def near_copies(seed=3, dims=24):
    """Groups of near and equal copies of some vectors among unrelated ones, three labels."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, dims))
    rows = []
    for i, b in enumerate(base):
        for k in range(int(rng.integers(1, 9)) if i else 60):
            rows.append((b * rng.uniform(0.5, 2) if k % 3 else b) + (rng.normal(size=dims) * rng.choice([0.0, 0.05, 0.13]) if k else 0))
    order = rng.permutation(len(rows))
    return [(int(i), [float(np.float32(x)) for x in rows[j]], int(j % 3) if j > 60 else 1) for i, j in enumerate(order)]


def odd_vectors(dims=24):
    one = [1.0] + [0.0] * (dims - 1)
    return [(900, None, 1), (901, [], 1), (902, [0.0] * dims, 1), (903, [math.nan] + one[1:], 1), (904, [math.inf] + one[1:], 1), (905, [None] + one[1:], 1),
            (906, one, None), (907, one, 1), (908, [3e38] + one[1:], 1), (909, [1e-40] + one[1:], 1), (910, [1.0, 0.0], 1), (911, [2.0, 0.0], 1),
            (912, one, 2), (912, one, 2), (None, one, 2), (700, [-x for x in one], 1)]


def classes(rows, least=0.98):
    """(vec_id, n_links, component_id, kept) of every row, by comparing all."""
    ok = [l is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, l in rows]
    unit = [np.array(v) / max(abs(x) for x in v) if o else None for (_, v, _), o in zip(rows, ok)]
    links = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j])
              and unit[i] @ unit[j] / math.sqrt((unit[i] @ unit[i]) * (unit[j] @ unit[j])) >= least] for i in range(len(rows))]
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in links[todo.pop()] if j not in seen and not seen.add(j)]
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((vec_id, len(links[i]), min(ids, default=None), vec_id is not None and vec_id == min(ids)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limits", [{}, {"cell_rows": 4, "tile_rows": 1_000}, {"cell_rows": 30, "tile_rows": 8}])
def test_links_and_classes(spark, tmp_path, limits):
    """Also with many cells and with cells in tiles."""
    rows = near_copies() + odd_vectors()
    want = classes(rows)
    assert sum(n for _, n, _, _ in want) > 500 and any(n and not k for _, n, _, k in want)
    df = spark.read.parquet(save(spark, rows, VEC, tmp_path, "embeddings") + "/embeddings.parquet")
    got = vector_dups.near_duplicates(df, **limits)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_no_linked_pair_is_lost_by_blocks():
    """Every close pair keeps the budget of a block, and meets in a cell of it."""
    rng = np.random.default_rng(5)
    for dims in (3, 8, 20, 64):
        a = rng.normal(size=(400, dims))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = a + rng.normal(size=a.shape) * 0.19 / np.sqrt(dims)
        b /= np.linalg.norm(b, axis=1, keepdims=True)
        close = (a * b).sum(axis=1) >= 0.98
        start, budget = vector_dups.blocks(dims), vector_dups.budgets(dims, 0.98)
        a, b = a[close], b[close]
        kept = np.add.reduceat((a - b) ** 2, start[:-1], axis=1) <= budget
        assert close.any() and kept.any(axis=1).all()
        for e, (i, j) in enumerate(zip(start, start[1:])):
            bits = np.resize([2, 1, 0, 3], j - i)
            where = lambda m: vector_dups.reached_cells(m[:, i:j], math.sqrt(budget[e]), np.zeros(j - i), np.full(j - i, 0.3), bits)
            row, cell, home = where(a)
            assert (np.bincount(row[home], minlength=len(a)) == 1).all()
            own = dict(zip(row[home].tolist(), cell[home].tolist()))
            reached = set(zip(*(c.tolist() for c in where(b)[:2])))
            assert all((k, own[k]) in reached for k in np.flatnonzero(kept[:, e]).tolist())


# ------------------------------------------------------------------ hard negatives

def mined(rows):
    x = {}
    for i, (vec_id, v, label) in enumerate(rows):
        if label is not None and v and all(e is not None and math.isfinite(e) for e in v):
            w = [math.floor(256 * e) for e in v]
            if sum(e * e for e in w) < 1 << 62:
                x[i] = (vec_id, w, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label)
    best = lambda pairs: sorted(pairs, key=lambda p: (-p[0], p[1] is None, p[1] or 0, p[2]))[:5]
    out = []
    for a, (anchor, w, label) in x.items():
        if anchor is None or anchor % 100:
            continue
        scored = [(sum(p * q for p, q in zip(w, u)), i, u, lab) for b, (i, u, lab) in x.items() if b != a and len(u) == len(w)]
        for positive, pid, _ in best([s[:3] for s in scored if s[3] == label]):
            for rank, (score, nid, _) in enumerate(best([s[:3] for s in scored if s[3] != label and 80 * positive <= 100 * s[0] <= 100 * positive]), 1):
                out.append((anchor, pid, rank, nid, positive, score))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limits", [{}, {"BLOCK_ROWS": 16, "ANCHORS_AT_ONCE": 2}])
def test_hard_negatives_are_the_brute_force_ones(spark, tmp_path, monkeypatch, limits):
    """With ties, repeated rows and odd ones; also over many blocks."""
    for name, value in limits.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(11)
    centre = rng.normal(size=(4, 6))
    rows = [(int(i) * 10, [float(np.float32(round(e, 1))) for e in centre[i % 4] + rng.normal(size=6) * 0.6], int(rng.integers(0, 4))) for i in range(150)]
    rows += rows[:20] + odd_vectors(6) + [(100, [0.0] * 6, 0), (10_000, [-1.0] * 6, 9)]
    want = mined(rows)
    assert len(want) > 100
    got = hard_negatives.op13_hard_negatives(spark, save(spark, rows, VEC, tmp_path, "embeddings"))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_threshold_algorithm_stops_early_and_finds_all():
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(3000, 4)) * 100).astype(np.int64)
    lists, tie = hard_negatives.Lists(x), rng.permutation(3000)
    for _ in range(40):
        a, wanted = (rng.normal(size=4) * 100).astype(np.int64), rng.random(3000) < 0.3
        top = int((x @ a).max())
        windows = [(-1 << 62, 1 << 62), (top // 2, top * 3 // 4), (top + 1, 1 << 62), (5, 4)]
        for (least, most), got in zip(windows, lists.search(a, wanted, windows, 5, tie)):
            score = x @ a
            at = np.flatnonzero(wanted & (score >= least) & (score <= most))
            assert got.tolist() == at[np.lexsort((tie[at], -score[at]))[:5]].tolist()
    # a strong anchor along one component ends within its first rows
    reads = []
    monkey = hard_negatives.Lists._closed
    hard_negatives.Lists._closed = staticmethod(lambda score, known, *rest: reads.append(known.sum()) or monkey(score, known, *rest))
    try:
        lists.search(np.array([100, 0, 0, 1]), np.ones(3000, bool), [(-1 << 62, 1 << 62)], 5, tie)
    finally:
        hard_negatives.Lists._closed = staticmethod(monkey)
    assert max(reads) < 300


@pytest.mark.parametrize("name", ["op12_embedding_near_dedup", "op13_hard_negatives"])
def test_empty_tables(spark, tmp_path, name):
    for rows in ([], [(5, None, 1)]):
        got = queries.queries()[name](spark, save(spark, rows, VEC, tmp_path, "embeddings"))
        assert [r[0] for r in got.collect()] == ([5] if rows and "12" in name else [])


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_on_planted_rows(spark, tmp_path, name):
    """The oracle on rows with links, ties and nulls (it names rows by their ids)."""
    vectors = near_copies() + [r for r in odd_vectors() if r[0] not in (None, 912, 908, 909)]
    folder = save(spark, vectors, VEC, tmp_path, "embeddings")
    save(spark, talk(2, 25, 14) + [t for t in ODD_TURNS if t[1:] != (0, None, None)], CONV, tmp_path, "conversations")
    con = duckdb.connect()
    for t in ("embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    df = queries.queries()[name](spark, folder)
    asked = con.execute(queries.oracle_sql()[name])
    assert df.columns == [d[0] for d in asked.description]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(asked.fetchall(), key=repr)
