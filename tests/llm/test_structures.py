"""Fingerprints, packing, token counts and nearest neighbours."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import counts, fingerprints, neighbours, packing
from riskframe.llm.tokens import open_tokenizer


def generalised_jaccard(a, b):
    def bag(t):
        w = t.split()
        return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
    x, y = bag(a), bag(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_collision_rate_is_generalised_jaccard(rows):
    """Over many samples and pairs, repeated shingles (weights over one) included."""
    base = [" ".join(r[1].split()) for r in rows[:12]]
    texts, want = [], []
    for i, t in enumerate(base):
        w = t.split()
        cut = len(w) * (i + 1) // 14
        other = " ".join(w[: len(w) - cut]) + " " + " ".join(w[: len(w) // 2]) * (i % 3)
        texts += [t + " " + t * (i % 2), other]
        want.append(generalised_jaccard(*texts[-2:]))
    sig = fingerprints.signatures(texts, samples=2048)
    got = (sig[0::2] == sig[1::2]).mean(axis=1)
    assert np.abs(got - np.array(want)).max() < 0.05


def test_samples_have_the_stated_distributions():
    terms = np.arange(1, 4001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for w in (1, 7):  # the least of many values with weight w is exponential with rate w
        ln_a, _ = fingerprints.sample_values(terms, np.full(len(terms), w), 16)
        assert abs(np.exp(ln_a).mean() * w - 1) < 0.05


def test_fingerprints_against_a_serial_version(odd, none, spark):
    got = fingerprints.compare_with_next(odd, 5).collect()
    assert len(got) == odd.count()
    order = sorted(((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in odd.select("doc_id", "text").collect()),
                   key=lambda r: (-r[0], r[1]))
    want = Counter()
    for (key, a), (_, b) in zip(order, order[1:] + order[:1]):
        e = fingerprints.edited(a, b)
        (fa, fe, fb), sig, some = fingerprints.fingerprints([a, e, b])
        want[(key if key >= 0 else None, len(a), hashlib.sha256(e.encode()).hexdigest(), fa, fe,
              fingerprints.likeness(sig[0], sig[1], some[0], some[1]), fingerprints.likeness(sig[0], sig[2], some[0], some[2]))] += 1
    assert Counter(tuple(r) for r in got) == want
    assert fingerprints.compare_with_next(none, 5).count() == 0
    one = spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")
    assert fingerprints.compare_with_next(one, 5).first().edited_sha256 == hashlib.sha256(b"abcdabcd").hexdigest()
    assert fingerprints.fingerprint(odd).count() == odd.count()


def test_packing_round_trip(odd, none):
    capacity = 64
    got = packing.pack(packing.pieces(odd, capacity=capacity), capacity, block_rows=50).collect()
    coder = open_tokenizer(packing.TOKENIZER)
    end = np.array([1], "<u4").tobytes()
    want = Counter()
    for r in odd.select("doc_id", "text").collect():
        raw = (coder._direct(r.text) if r.text else b"") + end
        n = len(raw) // 4
        for i, b in enumerate(range(0, n, capacity)):
            e = min(n, b + capacity)
            want[(r.doc_id, i, b, e - b, zlib.crc32(raw[4 * b:4 * e]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r.length for r in got) // capacity)
    assert len(bins) <= 1.05 * least + 2
    assert packing.pack(packing.pieces(none)).count() == 0


def test_sum_of_squares_rule_by_brute_force():
    rng = np.random.default_rng(4)
    capacity, sizes = 12, rng.integers(1, 12, 80).tolist()
    got = packing.sum_of_squares(sizes, capacity)
    gaps: dict[int, int] = {}
    for size, b in zip(sizes, got):
        def cost(change):
            n = Counter(g for g in change.values() if 0 < g < capacity)
            return sum(v * v for v in n.values())
        options = {x: g - size for x, g in gaps.items() if g >= size} | {len(gaps): capacity - size}
        best = min((cost(gaps | {x: left}), left) for x, left in options.items())
        assert (cost(gaps | {b: options[b]}), options[b]) == best
        gaps[b] = options[b]


def test_tokens_equal_the_tokenizer(odd, rows):
    coder = open_tokenizer("word_bpe_49k.json")
    texts = [r.text for r in odd.select("text").collect() if r.text] + ["İstanbul ΣΑΣ e\u0301te, 'tis it's 3,14 <|endoftext|> x\u00a0y\u2003z ... !!a!!"]
    for t in texts:
        assert coder.ids(t) == coder._direct(t)


def apply(text, edits):
    for e in edits or []:
        start = min(max(0, e[0] or 0), len(text))
        text = text[:start] + (e[2] or "") + text[start + max(0, e[1] or 0):]
    return text


def test_edited_counts_equal_a_full_count(spark, rows, odd_rows):
    rng = np.random.default_rng(5)
    coder = open_tokenizer(counts.TOKENIZER)
    data = []
    for i, r in enumerate(rows[:60] + odd_rows):
        n = len(r[1] or "")
        edits = [(int(rng.integers(0, n + 5)), int(rng.integers(0, 30)), ["", "new words here ", "x", "  ", "Ab!!\n"][int(rng.integers(5))])
                 for _ in range(int(rng.integers(0, 12)))]
        edits += [(None, None, None), (-3, -2, "q"), (10 ** 9, 5, " end")]
        data.append((i, r[1], None if i == 3 else edits, "clash"))
    df = spark.createDataFrame(data, f"doc_id long, text string, edits {counts.EDITS}, n_tokens string")
    for r in counts.count_with_edits(df).collect():
        t = data[r.doc_id][1] or ""
        e = apply(t, data[r.doc_id][2])
        assert (r.n_tokens, r.edited_tokens, r.edited_chars) == (len(coder._direct(t)) // 4, len(coder._direct(e)) // 4, len(e)), r.doc_id
    assert counts.count_with_edits(df.limit(0)).count() == 0


def test_an_edit_encodes_little(rows):
    text = " ".join(r[1] for r in rows)
    tree = counts.SegmentTree(text, open_tokenizer(counts.TOKENIZER))
    assert tree.edit(len(text) // 2, 3, "abc") < 200
    assert tree.whole_text() == apply(text, [(len(text) // 2, 3, "abc")])
    for level in range(1, tree.size):
        assert (tree.sums[:, level] == tree.sums[:, 2 * level] + tree.sums[:, 2 * level + 1]).all()


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(24, 16))
    x = (centres[rng.integers(24, size=3000)] + 0.3 * rng.normal(size=(3000, 16))).astype(np.float32)
    x[::9] = x[0]  # copies: a ninth of all rows
    return x


def test_recall_against_brute_force(spark, vectors, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 256)
    monkeypatch.setattr(neighbours, "INDEX_BLOCK", 100)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 40)
    odd = [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [float("nan")] * 16), (5004, [1.0, None] * 8), (5005, [1.0] * 3), (None, [1.0] * 16)]
    data = [(i, [float(v) for v in row]) for i, row in enumerate(vectors)] + odd + [(20, [float(v) for v in vectors[20]])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = neighbours.search(df, F.col("vec_id") % 20 == 0, 20).toPandas()
    x = vectors.astype(np.float64)
    hits = 0
    for q, found in got.groupby("query_id"):
        s = x @ x[q]
        ids = np.delete(np.arange(len(x)), q)
        want = ids[np.lexsort((ids, -(x[ids] * x[q]).sum(axis=1)))][:20]
        found = found.sort_values("rank")
        assert list(found["rank"]) == list(range(1, 21)) and q not in set(found["vec_id"])
        assert np.allclose(found["score"], s[found["vec_id"]])
        assert list(zip(-found["score"], found["vec_id"])) == sorted(zip(-found["score"], found["vec_id"]))
        hits += len(set(want) & set(found["vec_id"]))
        copies = [v for v in found["vec_id"] if v % 9 == 0]  # of many equal vectors the smallest ids
        assert copies == [v for v in range(0, 3000, 9) if v != q][:len(copies)]
    assert got["query_id"].nunique() == 150 and hits >= 0.9 * 20 * 150


def test_few_or_no_vectors(spark):
    few = spark.createDataFrame([(i, [1.0 * i, 1.0]) for i in range(5)], "vec_id long, embedding array<double>")
    got = neighbours.search(few, F.col("vec_id") % 2 == 0, 20)
    assert got.count() == 3 * 4
    assert [r.vec_id for r in got.where("query_id = 0").orderBy("rank").collect()] == [1, 2, 3, 4]
    assert neighbours.search(few.limit(0), F.col("vec_id") % 2 == 0, 20).count() == 0


def test_parts_are_balanced(vectors):
    x = vectors[:1000]
    part = neighbours.balanced_parts(neighbours.neighbour_graph(x, 8), 8)
    assert set(np.bincount(part, minlength=8)) <= {125}


def test_rows_without_ids_are_cut_into_runs(spark):
    """Null ids and a repeated id on two thirds of the rows: many runs, the same neighbours as in one."""
    texts = [f"{chr(97 + i % 26)}{i} some words of text number {i * 7 % 113} and more" for i in range(600)]
    docs = spark.createDataFrame([(None if i % 3 == 0 else 5 if i % 3 == 1 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    runs = [r["n"] for r in fingerprints.in_blocks(docs, 12)[0].where("NOT extra").groupBy("block").agg(F.count("*").alias("n")).collect()]
    assert sum(runs) == 600 and len(runs) > 8 and max(runs) <= 150
    got = Counter(tuple(r) for r in fingerprints.compare_with_next(docs, 12).collect())
    assert got == Counter(tuple(r) for r in fingerprints.compare_with_next(docs, 1).collect())
    assert sum(got.values()) == 600


def test_pieces_that_never_fit_together_end_in_blocks(spark, tmp_path, monkeypatch):
    """No task packs more than its block of pieces, and all pieces are placed."""
    packed, seen = packing._packed, tmp_path.as_posix()

    def noted(rows, capacity):
        with open(f"{seen}/{len(rows)}", "w"):
            return packed(rows, capacity)

    monkeypatch.setattr(packing, "_packed", noted)
    for step in (13, 29):  # of 2 100 to 4 000 tokens; with some that fit here and there
        lengths = [2_100 + i * step % 1_900 if i % 9 or step == 13 else 300 + i for i in range(400)]
        table = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], packing.PIECES)
        got = packing.pack(table, block_rows=50).collect()
        fill = Counter()
        for r in got:
            fill[r.sequence_id] += r.length
        assert len(got) == 400 and max(fill.values()) <= 4096
        assert step == 29 or len(fill) == 400
    assert max(int(p.name) for p in tmp_path.iterdir()) < 100
