"""Hosts of a single neighbour solved for before the rounds, against the whole equation."""

import numpy as np

from riskframe.llm import urls


def solved(seeds, moves):
    names = sorted({h for m in moves for h in m[:2]} | set(seeds))
    at = {h: i for i, h in enumerate(names)}
    out = {}
    for k in (0, 1):
        m = np.zeros((len(names), len(names)))
        for host, to, *share in moves:
            m[at[to], at[host]] += share[k]
        s = np.array([seeds.get(h, (0.0, 0.0))[k] for h in names])
        for h, x in zip(names, np.linalg.solve(np.eye(len(names)) - m, s)):
            out.setdefault(h, []).append(x)
    return out


def test_scores_without_leaves_are_those_of_the_whole(spark):
    """A star, a chain (its end is a leaf, then the next), a pair of two only, a ring without leaves."""
    links = [("hub", f"leaf{i}") for i in range(6)] + [("c1", "c2"), ("c2", "c3"), ("c3", "r1"), ("left", "right"),
                                                       ("r1", "r2"), ("r2", "r3"), ("r3", "r1"), ("hub", "r2")]
    degree = {}
    for a, b in links:
        degree[a], degree[b] = degree.get(a, 0) + 1, degree.get(b, 0) + 1
    moves = [(a, b, 0.85 / degree[a], 0.8 / degree[a]) for x, y in links for a, b in ((x, y), (y, x))]
    seeds = {"leaf0": (0.15, 0.0), "leaf1": (0.0, 0.15), "c1": (0.05, 0.1), "right": (0.1, 0.0), "r3": (0.0, 0.15), "lonely": (0.15, 0.15)}
    want = solved(seeds, moves)
    s = spark.createDataFrame([(h, *v) for h, v in seeds.items()], "host string, trust double, distrust double")
    m = spark.createDataFrame(moves, "host string, to string, t double, d double")
    rest, kept, back = urls.without_leaves(s, m)
    left = {r.host for r in kept.select("host").union(kept.select("to")).distinct().collect()}
    assert left == {"hub", "c2", "c3", "r1", "r2", "r3"}
    # the rest solved directly, then all the others from it
    core = solved({r.host: (r.trust, r.distrust) for r in rest.collect()}, [(r.host, r.to, r.t, r.d) for r in kept.collect()])
    whole = back(spark.createDataFrame([(h, float(x), float(y)) for h, (x, y) in core.items()], "host string, trust double, distrust double"))
    got = {r.host: (r.trust, r.distrust) for r in whole.collect()}
    assert set(got) == set(want)
    for h, v in want.items():
        assert np.allclose(got[h], v), h
    # no column of the smaller equation hands on more than before
    for k in ("t", "d"):
        assert kept.groupBy("host").sum(k).agg({f"sum({k})": "max"}).first()[0] <= 0.85 + 1e-12


def test_no_leaf_at_all(spark):
    ring = [(a, b, 0.4, 0.4) for a, b in [("a", "b"), ("b", "c"), ("c", "a"), ("b", "a"), ("c", "b"), ("a", "c")]]
    s = spark.createDataFrame([("a", 0.15, 0.0)], "host string, trust double, distrust double")
    assert urls.without_leaves(s, spark.createDataFrame(ring, "host string, to string, t double, d double")) is None
