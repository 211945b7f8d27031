"""URL filters, near duplicates, line dedup and the pipeline."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskframe.llm import lines, near_dups, urls

PAGES = "page_id long, url string, html string"


def pages_of(spark):
    link = '<a href="https://{}/x">'.format
    return spark.createDataFrame([
        (1, "https://WWW.Example.com/en/1?x=/de/", None), (2, "http://a.example.com/en/1", link("spam.org")), (3, "http://b.com/x", link("good.org") * 2),
        (4, "https://spam.org/p", ""), (5, "https://good.org/p", link("good.org")), (6, "nothing", "x"), (7, None, None), (8, "x://n.net/es/a#/fr/", link("spam.org")),
        (9, "ftp://n.net", None), (10, "http://m.net/fr/", link("evil.org")), (11, "http://evil.org/", link("m.net") + link("m.net")),
        (12, "http://helper.org/", '<img SRC=\'//Evil.org/i.png\'><a href=/local>'), (13, "https://example.comx/en/", None), (13, "https://example.comx/en/", None),
    ], PAGES).withColumn("host", F.lit("clash")).withColumn("verdict", F.lit("clash"))


def test_rules_and_parts(spark):
    got = {r.page_id: r for r in urls.judge(pages_of(spark), urls.RULES).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert (got[2].rule, got[2].verdict) == ("example.com/en/", "block")
    assert (got[3].rule, got[3].verdict) == ("com/", "allow")
    assert (got[8].host, got[8].path, got[8].rule, got[8].verdict) == ("n.net", "/es/a", "net/es/", "block")
    assert (got[9].path, got[9].rule) == ("", None)
    for k in (6, 7):
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == ("", "", None, "allow")
    assert got[13].rule is None
    assert got[5].verdict == "allow" and got[5].trust > 0
    assert urls.judge(pages_of(spark).limit(0), urls.RULES).count() == 0


def test_scores_equal_power_iteration(spark, monkeypatch):
    """Trust and distrust against dense matrices in numpy."""
    monkeypatch.setattr(urls, "TOLERANCE", 0.0)
    pages = pages_of(spark).drop("host", "verdict")
    got = {r.host: (r.trust, r.distrust) for r in urls.judge(pages, urls.RULES).collect()}
    edges, says, n = Counter(), defaultdict(Counter), Counter()
    host, path = urls.host_and_path(F.col("url"))
    rule, verdict = urls.rule_of(F.col("host"), F.col("path"), urls.RULES)
    for r in pages.withColumn("host", host).withColumn("path", path).withColumn("says", verdict).collect():
        n[r.host] += 1
        says[r.host][r.says] += 1
        for dst in re.findall(urls.LINK[4:], r.html or "", re.I):
            if r.host and dst.lower() != r.host:
                edges[(r.host, dst.lower())] += 1
    names = {h for h in n if h} | {d for _, d in edges}
    pairs = set()
    for h in list(names):
        while h.count(".") >= 2:
            up = h.split(".", 1)[1]
            pairs |= {(h, up), (up, h)}
            names.add(up)
            h = up
    for pair in pairs:
        edges[pair] += urls.OWNER
    names = sorted(names)
    at = {h: i for i, h in enumerate(names)}
    w = np.zeros((len(names), len(names)))
    for (a, b), v in edges.items():
        w[at[a], at[b]] = v
    seed = np.array([[says[h]["allow"] / n[h], says[h]["block"] / n[h]] if n[h] else [0, 0] for h in names]) * (1 - urls.DAMPING)
    out, into = w / np.maximum(w.sum(1, keepdims=True), 1e-12), w / np.maximum(w.sum(0, keepdims=True), 1e-12)
    t, d = seed[:, 0].copy(), seed[:, 1].copy()
    for _ in range(urls.ROUNDS):
        t, d = seed[:, 0] + urls.DAMPING * t @ out, seed[:, 1] + urls.DAMPING * into @ d
    for h in names:
        if n[h]:
            assert abs(got[h][0] - t[at[h]]) < 1e-9 and abs(got[h][1] - d[at[h]]) < 1e-9, h


def test_a_verdict_that_needs_many_rounds(spark, monkeypatch):
    """Two hosts in a cycle: the scores grow for long, the last hundredth decides."""
    pages = spark.createDataFrame([(1, "http://evil.net/fr/", '<a href="http://a.org/">'), (2, "http://a.org/", '<a href="http://evil.net/">')], PAGES)
    end = 0.85 * 0.15 / (1 - 0.85 ** 2)
    monkeypatch.setattr(urls, "BLOCK_AT", 0.99 * end / 0.15)
    got = {r.page_id: r for r in urls.judge(pages, urls.RULES).collect()}
    assert got[2].verdict == "block" and abs(got[2].distrust - end) < 1e-3
    monkeypatch.setattr(urls, "BLOCK_AT", (1 - 1e-6) * end / 0.15)  # far under TOLERANCE
    assert urls.judge(pages, urls.RULES).where("page_id = 2").first().verdict == "block"


def copies_of(rows, seed=8):
    """The rows and near copies of some, by few word edits."""
    rng = random.Random(seed)
    out = [r[:2] for r in rows]
    for r in rows[:40]:
        for c in range(1, 4):
            w = r[1].split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[rng.randrange(len(w))] = "edit"
            out.append((1000 + 10 * r[0] + c, " ".join(w)))
    out += [(5000 + i, rows[i][1]) for i in range(30)]
    passage = rows[50][1].split("\n")[0]
    return out + [(6000 + i, r[1] + "\n" + passage) for i, r in enumerate(rows[60:100])]


def brute_links(docs):
    seqs = {k: near_dups.labelled_shingles([t or ""])[0] for k, t in docs}
    pairs = set()
    keys = sorted(seqs)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = seqs[a].tolist(), seqs[b].tolist()
            if not x or not y or min(len(x), len(y)) < 0.8 * max(len(x), len(y)) or len(set(x) & set(y)) < 0.8 * max(len(x), len(y)):
                continue
            row = [0] * (len(y) + 1)  # longest common subsequence, the whole table
            for u in x:
                last = 0
                for j, v in enumerate(y):
                    last, row[j + 1] = row[j + 1], last + 1 if u == v else max(row[j + 1], row[j])
            if row[-1] / (len(x) + len(y) - row[-1]) >= 0.8:
                pairs.add((b, a))
    return pairs


def brute_classes(docs):
    label = {k: k for k, _ in docs}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k
    for a, b in brute_links(docs):
        x, y = sorted((root(a), root(b)))
        label[y] = x
    return {k: root(k) for k in label}


@pytest.mark.parametrize("block", [2048, 4])
def test_classes_equal_brute_force(spark, rows, block, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", block)
    data = copies_of(rows)
    got = near_dups.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    want = brute_classes(data)
    assert {r.doc_id: r.class_id for r in got} == want
    assert sum(r.representative for r in got) == len(set(want.values()))


def test_similar_texts_of_few_shingles_meet(spark):
    """Four of five shingles, and eight of ten, among others that hold the same
    shingles: too little for many equal sketches."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    data = []
    for i in range(60):
        w = [word() for _ in range(8 if i % 3 else 12)]
        data.append((100 * i, " ".join(w)))
        for k in range(1, 13):
            more = [word() for _ in range(1 if i % 3 else 2)]
            at = rng.choice((0, len(w)))
            data.append((100 * i + k, " ".join(w[:at] + more + w[at:])))
    assert {(0, k) for k in range(1, 13)} <= brute_links(data[:13])
    got = near_dups.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert [r.doc_id for r in got if r.class_id != r.doc_id - r.doc_id % 100] == []


def test_alignment_equals_the_whole_table():
    rng = np.random.default_rng(9)
    for _ in range(40):
        x = rng.permutation(60)[:50].astype(np.uint64)
        y = np.delete(x, rng.integers(0, 50, 3))
        if rng.random() < 0.5:
            i, j = rng.integers(0, len(y), 2)
            y[[i, j]] = y[[j, i]]
        row = [0] * (len(y) + 1)
        for u in x.tolist():
            last = 0
            for j, v in enumerate(y.tolist()):
                last, row[j + 1] = row[j + 1], last + 1 if u == v else max(row[j + 1], row[j])
        want = row[-1] / (len(x) + len(y) - row[-1])
        got = near_dups.aligned_similarity(x, y)
        assert got == want if want >= 0.8 else got < 0.8


def test_near_duplicates_of_odd_rows(odd, none):
    got = near_dups.near_duplicates(odd)
    assert got.count() == odd.count()
    by = defaultdict(set)
    for r in got.collect():
        by[r.doc_id].add(r.class_id)
    assert by[200] == by[201] == by[202] == {200}
    assert by[None] == {0} and by[206] == {5, 206}
    kept = near_dups.representatives(odd)
    assert kept.columns == odd.columns
    assert kept.groupBy("doc_id").count().where("count > 1").count() == 0
    assert near_dups.near_duplicates(none).count() == 0 and near_dups.representatives(none).count() == 0


def test_unlike_texts_without_or_with_equal_ids_stay(spark, rows):
    near = rows[2][1] + " more"
    data = [(None, rows[0][1]), (None, rows[1][1]), (None, rows[1][1]), (7, rows[2][1]), (7, rows[3][1]), (7, near), (8, rows[3][1] + " more")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    kept = Counter(tuple(r) for r in near_dups.representatives(docs).collect())
    assert set(kept.values()) == {1} and sum(t in (rows[2][1], near) for _, t in kept) == 1
    assert {(k, t) for k, t in kept if t not in (rows[2][1], near)} == {(None, rows[0][1]), (None, rows[1][1]), (7, rows[3][1])}
    got = near_dups.near_duplicates(docs).collect()
    assert sorted(Counter((r.class_id, r.class_text) for r in got).values()) == [1, 2, 2, 2]
    heads = Counter((r.class_id, r.class_text) for r in got if r.representative)
    assert sorted(heads.values()) == [1, 1, 1, 2]  # the row without an id that repeats


def brute_line_dedup(docs):
    """Documents in order; each against the earliest holder of its lines."""
    first, out = {}, {}
    for k, t in sorted(docs):
        found = []
        for key, pos, words in lines.line_keys(t):
            if key in first:
                found.append({"pos": pos, "words": words, "source": first[key][0], "source_hash": 0, "source_pos": first[key][1]})
            else:
                first[key] = (k, pos)
        gone = lines.aligned(found)
        out[k] = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    return out


def test_line_dedup_equals_a_serial_pass(spark, rows):
    shared = "a passage of more than fifty words " * 10
    data = [(r[0], r[1]) for r in rows] + [(300 + i, rows[i][1]) for i in range(10)]
    data += [(400 + i, f"{r[1]}\n{shared}\nshort end") for i, r in enumerate(rows[10:30])]
    data += [(500, "Of the.\nNew line that nobody else has in this corpus at all, really."), (501, "Of the."), (502, "x\n\n" + shared)]
    got = lines.with_deletions(spark.createDataFrame(data, "doc_id long, text string")).collect()
    want = brute_line_dedup(data)
    for r in got:
        assert r["__kept"] == (want[r.doc_id] if want[r.doc_id].strip() else ""), r.doc_id
    assert sum(shared.strip() in r["__kept"] for r in got) == 1
    assert next(r["__kept"] for r in got if r.doc_id == 501) == "Of the."
    new = {x.strip() for r in got for x in r["__kept"].split("\n")}
    assert {x.strip() for _, t in data for x in t.split("\n")} <= new  # nothing is lost from the corpus


def pairwise_line_dedup(docs):
    """Each document against every earlier one, with all the keys both hold."""
    held, out = {k: {w[0]: w[1:] for w in lines.windows(t)} for k, t in docs}, {}
    for k, t in docs:
        found = []
        for e in (e for e in held if e < k):
            found += [{"pos": held[k][w][0], "sizes": held[k][w][1], "back": held[k][w][2], "source": e, "source_hash": 0,
                       "source_pos": held[e][w][0]} for w in held[k] if w in held[e]]
        gone = {lines.sizes_of(t)[1][p] for p in lines.aligned(found)}
        out[k] = sorted(gone)
    return out


def test_short_lines_equal_all_pairs(spark, rows):
    long = [r[1].split("\n")[0] for r in rows]
    verse = "\n".join(f"verse {i} goes\n\non like this" if i % 2 else f"line {i} of it" for i in range(14))
    other = "\n".join(f"quite {i} other words" for i in range(9))
    changed = verse.replace("line 6 of", "line six of")
    han = "\n".join(["春眠不觉晓", "处处闻啼鸟", "夜来风雨声", "花落知多少"])
    data = [(1, f"{long[1]}\n{verse}\n{long[2]}"), (2, f"{long[3]}\n{verse}\nthe end"), (3, f"{other}\n{verse}"), (4, f"a start\n{changed}"),
            (5, f"{long[4]}\n{han}"), (6, f"山\n{han}\n水")]
    got = {r.doc_id: r for r in lines.with_deletions(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert {k: list(r["__deleted"]) for k, r in got.items()} == pairwise_line_dedup(data)
    assert got[2]["__kept"].split() == f"{long[3]} the end".split() and got[3]["__kept"].split() == other.split()
    assert "six" in got[4]["__kept"] and "verse 13" not in got[4]["__kept"] and "verse 1 " not in got[4]["__kept"]
    assert got[6]["__kept"] == "山\n水"


def test_crossing_lines_and_copies_equal_all_pairs(spark, rows):
    long = [r[1].split("\n")[0] for r in rows]
    data = [(10, f"{long[11]}\n{long[10]}"), *[(11 + i, f"{long[10]}\n{long[11]}") for i in range(5)],
            (20, long[20]), (21, f"{long[20]}\nshort s"), (22, f"{long[20]}\nshort s"), (30, f"{long[30]}\ncommon\n{long[31]}"), (31, f"common\n{long[32]}")]
    got = {r.doc_id: r for r in lines.with_deletions(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert {k: list(r["__deleted"]) for k, r in got.items()} == pairwise_line_dedup(data)
    assert [got[k]["__kept"] == "" for k in (12, 13, 14, 15, 22)] == [True] * 5 and got[31]["__kept"].startswith("common")


def test_alignment_keeps_what_is_out_of_order():
    at = lambda pos, there: {"pos": pos, "words": 9, "source": 1, "source_hash": 1, "source_pos": there}
    assert lines.aligned([at(0, 5), at(1, 6), at(2, 0), at(3, 7)]) == {0, 1, 3}
    assert lines.aligned([]) == set()
    assert lines.aligned([at(4, 4) | {"words": 3}]) == set()
    assert lines.aligned([at(4, 4) | {"words": 3}, at(5, 5) | {"words": 6}]) == {4, 5}


def test_line_dedup_of_odd_rows(odd, none):
    got = lines.with_deletions(odd.select("doc_id", "text")).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert by[200]["__kept"] is None and by[201]["__kept"] == "" and by[202]["__kept"] == " \n\t "
    kept = lines.deduped(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 205").count() == 1
    assert lines.deduped(none).count() == 0


def test_texts_are_cut_once(spark):
    long = "a line of quite enough words to be telling by itself"
    docs = spark.createDataFrame([(1, long), (2, long), (3, f"{long}\nits own line"), (4, None)], "doc_id long, text string")
    kept = lines.deduped(docs)
    # a condition moved below the cut would align every text in a second Python worker
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(map(tuple, kept.collect())) == [(1, long), (3, "its own line"), (4, None)]


def test_pipeline_stages(spark, odd, none, tmp_path):
    docs = odd.drop("id")
    for start in (docs, none.drop("id")):
        at = start
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            before = at
            path = f"{tmp_path}/{start.count()}-{name}"
            stage(spark, at, "").write.parquet(path)
            at = spark.read.parquet(path)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert at.columns == start.columns
            if name == "mix_to_targets":  # no document is lost by mixing
                assert {r.doc_id for r in before.collect()} == {r.doc_id for r in at.collect()}
            if name == "best_fit_packing":
                assert Counter(r.doc_id for r in before.collect()) == Counter(r.doc_id for r in at.where("piece = 0").collect())
