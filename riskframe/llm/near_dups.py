"""Near-duplicate classes by Order MinHash and banded alignment.

A text is the sequence of its five-word shingles, each labelled with how often
it occurred before, so that no element repeats.  Two texts are linked when the
longest common subsequence c of their sequences (lengths a and b) satisfies
c / (a + b - c) >= ``SIMILARITY``: the Jaccard similarity, counting only what
can be aligned in order.

Candidates: each of ``SKETCHES`` order-sensitive sketches takes the ``TAKEN``
labelled shingles of least hash and keeps them in text order; two texts meet
where a sketch is equal, and are candidates when ``AGREE`` = 2 sketches agree and
their lengths allow the similarity.  Of pairs at similarity 0.8 this loses (exact
binomials) about 2 in a million that share 40 of 50 shingles and 4 in 100 000
that share 8 of 10.  Pairs in which one text lacks a single shingle of the other,
which has at most ``FEW``, need no sketch: each text of few shingles looks up the
texts it becomes without one of them, and none is lost.  Of pairs of at most
``FEW`` shingles that leaves those of nine against nine that share eight, which
the sketches find.  Verification aligns the sequences in the band that the
similarity leaves.

Equal texts are one node.  Work on a bucket of equal sketches goes by leaders:
each text is first verified against one leader, of those that lead its
buckets the one it agrees with most; then only texts of a bucket that are
still in different classes are aligned, inside the task that holds the bucket
and until their classes meet, so a large group of copies costs a row for each
member and no link between different classes is lost.  Buckets of more than ``BLOCK`` texts are
worked on in blocks, whose leaders meet again on the next level.

Results for odd input: null and empty texts are equal to each other and to
texts of blanks only, and like nothing else; texts of fewer than five words
have one shingle of all their words; ties go to the smaller doc_id (null
last); repeated rows are in one class; an empty table gives an empty result;
very long texts are read whole; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import (MAX_LONG, finished_shuffles_removed, mixed, prepare, shingle_hashes, slices_by_size, table,
                                  word_hashes)

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 32
TAKEN = 4
#: agreeing sketches: of a candidate, and of a text and its leader
AGREE = 2
#: up to so many shingles similar texts differ by one shingle that only one of them has
FEW = 9
STRONG = 8
#: texts of a bucket that one task compares
BLOCK = 2_048
SLICE = 400_000


def labelled_shingles(texts: list[str]) -> list[np.ndarray]:
    """The occurrence-labelled five-word shingles of each text, in order."""
    out: list[np.ndarray] = []
    for b, e in slices_by_size([len(t) for t in texts], SLICE):
        words, counts = word_hashes(texts[b:e])
        terms, sizes = shingle_hashes(words, counts, WORDS)
        ends = np.cumsum(sizes)
        for s, t in zip((ends - sizes).tolist(), ends.tolist()):
            out.append(labelled(terms[s:t]))
    return out


def labelled(x: np.ndarray) -> np.ndarray:
    if len(x) < 2:
        return x
    order = np.argsort(x, kind="stable")
    same = np.append(False, x[order][1:] == x[order][:-1])
    if not same.any():
        return x
    at = np.arange(len(x))
    first = np.maximum.accumulate(np.where(same, 0, at))
    seen = np.empty(len(x), np.uint64)
    seen[order] = (at - first).astype(np.uint64)
    return np.where(seen > 0, mixed(x + seen * np.uint64(0x9E3779B97F4A7C15)), x)


_SALT = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def sketches(x: np.ndarray) -> np.ndarray:
    """SKETCHES values: each a hash of its least labelled shingles in text order."""
    h = (x[None, :] ^ _SALT[:, None]) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    take = min(TAKEN, len(x))
    at = np.argpartition(h, take - 1, axis=1)[:, :take] if take < len(x) else np.tile(np.arange(len(x)), (SKETCHES, 1))
    at.sort(axis=1)
    code = np.zeros(SKETCHES, np.uint64)
    for j in range(take):
        code = mixed(code * np.uint64(0xD6E8FEB86659FD93) + x[at[:, j]] + np.uint64(1))
    return code


def sequence_hash(x: np.ndarray) -> int:
    code = np.zeros(1, np.uint64)
    for v in x:
        code = mixed(code * np.uint64(0xD6E8FEB86659FD93) + v + np.uint64(1))
    return int(code.astype(np.int64)[0])


def without_one(x: np.ndarray) -> list[int]:
    """Hashes of the sequences that similar texts have which lack one shingle of x."""
    n = len(x)
    if n > FEW or n - 1 < SIMILARITY * n:
        return []
    return sorted({sequence_hash(np.delete(x, i)) for i in range(n)})


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY, order: np.ndarray | None = None) -> float:
    """c / (len a + len b - c) for the longest common subsequence c in the band
    that ``least`` leaves; no element repeats in a or in b (order: argsort of b)."""
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m)
    band = int((n + m) * (1 - least) / (1 + least)) + 1
    if abs(n - m) > band:
        return 0.0
    order = np.argsort(b) if order is None else order
    at = np.minimum(np.searchsorted(b[order], a), m - 1)
    place = order[at]
    hit = (b[place] == a) & (np.abs(place - np.arange(n)) <= band)
    if hit.sum() < least * max(n, m):
        return 0.0
    seq = place[hit]
    if (np.diff(seq) > 0).all():
        c = len(seq)
    else:  # longest increasing subsequence

        tails: list[int] = []
        for j in seq.tolist():
            p = bisect_left(tails, j)
            if p == len(tails):
                tails.append(j)
            else:
                tails[p] = j
        c = len(tails)
    return c / (n + m - c)


def text_hashes(text: str = "text") -> tuple[Column, Column]:
    """Two hashes of a text; null, empty and blank texts are equal."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    t = F.when(F.trim(F.regexp_replace(F.substring(t, 1, 64), r"\s+", "")) != "", t).otherwise(
        F.when(F.regexp_like(t, F.lit(r"\S")), t).otherwise(F.lit("")))
    return F.xxhash64(t), F.xxhash64(F.lit("second"), t)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for s in labelled_shingles([t or "" for t in batch.column(3).to_pylist()]):
            rows.append((len(s), sketches(s).astype("<u8").tobytes() if len(s) else None,
                         sequence_hash(s) if 0 < len(s) < FEW else None, without_one(s)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([r[0] for r in rows], pa.int64()),
                                          pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64()),
                                          pa.array([r[3] for r in rows], pa.list_(pa.int64()))],
                                         names=["id", "h1", "h2", "n", "sketch", "whole", "parts"])


def nodes_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(node, h1, h2, id, n, sketch, whole, parts): each distinct text once, id its smallest key."""
    h1, h2 = text_hashes(text)
    rows = docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(MAX_LONG)).alias("id"), h1.alias("h1"), h2.alias("h2"),
                       F.col(f"`{text}`").alias("text"))
    done = rows.mapInArrow(_sketched, "id long, h1 long, h2 long, n long, sketch binary, whole long, parts array<long>")
    once = done.groupBy("h1", "h2").agg(F.min("id").alias("id"), *[F.max(c).alias(c) for c in ("n", "sketch", "whole", "parts")])
    return once.select(F.monotonically_increasing_id().alias("node"), "*").checkpoint()


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """(j, key, node, id, n, sketch, size): the nodes of every sketch value that two or more share."""
    each = F.transform(F.sequence(F.lit(0), F.lit(SKETCHES - 1)),
                       lambda j: F.struct(j.alias("j"), F.substring("sketch", j * 8 + 1, F.lit(8)).alias("key")))
    # a row for each key: its hash joined with the number of the sketch
    spread = nodes.where(F.col("sketch").isNotNull()).select("node", F.explode(each).alias("e")).select(
        "node", F.col("e.j").cast("short").alias("j"), F.xxhash64("e.key", "e.j").alias("key"))

    return sized(spread).join(nodes.select("node", "id", "n", "sketch"), "node")


def sized(rows: DataFrame) -> DataFrame:
    """``rows`` with the number of rows of their key.  Counts are summed before they are
    exchanged and joined back, so that the rows of a hot key may lie in several tasks."""
    return rows.join(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key")


def links_of_few(nodes: DataFrame) -> DataFrame:
    """(a, b): texts of few shingles, b with one shingle more than a.  Texts of
    equal shingles meet by their sketches, so one of them is enough here."""
    whole = nodes.where("whole is not null").groupBy("whole").agg(F.min("node").alias("a"))
    parts = nodes.where(F.size("parts") > 0).select(F.col("node").alias("b"), F.explode("parts").alias("whole"))
    return parts.join(whole, "whole").select("a", "b").checkpoint()


def _agreement(sketch: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Agreeing sketches of each pair; 0 where the lengths rule the similarity out."""
    out = np.zeros((len(sketch), len(sketch)), np.int16)
    for k in range(SKETCHES):
        out += sketch[:, None, k] == sketch[None, :, k]
    least, most = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
    out[least < SIMILARITY * most] = 0
    return out


def _frame(rows: pa.Table) -> tuple[np.ndarray, ...]:
    order = np.argsort(rows["id"].to_numpy(), kind="stable")
    sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), "<u8").reshape(-1, SKETCHES)[order]
    return order, rows["node"].to_numpy()[order], sketch, rows["n"].to_numpy()[order]


PAIRS = "a long, b long"
_PAIR_NAMES = ["a", "b"]


def _pairs(a, b) -> pa.Table:
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=_PAIR_NAMES)


def _leaders(rows: pa.Table) -> pa.Table:
    """(a, b, agree): each node b of the bucket with its leader a (itself for a leader).

    Nodes that agree strongly with more others lead first: of a text and its
    edited copies that is the text, to which each copy is nearer than to
    another copy.
    """
    _, node, sketch, n = _frame(rows)
    agree = _agreement(sketch, n)
    strong = agree >= STRONG
    lead = np.full(len(node), -1)
    for i in np.argsort(-(agree * strong).sum(axis=1), kind="stable"):
        if lead[i] < 0:
            lead[i] = i
            lead[strong[i] & (lead < 0)] = i
    return _pairs(node[lead], node).append_column("agree", pa.array(agree[lead, np.arange(len(node))], pa.int32()))


def _candidate_matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, pairs, agreement): candidate pairs of the bucket in different
    classes, where this bucket is the first that the pair shares."""
    order, _, sketch, n = _frame(rows)
    label = rows["label"].to_numpy()[order]
    agree = _agreement(sketch, n)
    ok = np.triu(agree >= AGREE, 1) & (label[:, None] != label[None, :])
    for k in range(int(rows["j"][0].as_py())):
        ok &= sketch[:, None, k] != sketch[None, :, k]
    return order, ok, agree


def _involved(rows: pa.Table) -> pa.Table:
    """The rows of a bucket that are in a candidate pair."""
    order, ok, _ = _candidate_matrix(rows)
    return rows.take(pa.array(order[ok.any(axis=0) | ok.any(axis=1)]))


def _others(rows: pa.Table) -> pa.Table:
    """(a, b): links between the classes of a bucket.  Pairs are aligned here,
    those that agree most first, until their classes have met."""
    order, ok, agree = _candidate_matrix(rows)
    node, label = rows["node"].to_numpy()[order], rows["label"].to_numpy()[order].tolist()
    text = rows["text"].to_pylist()
    seq = labelled_shingles([text[i] for i in order])
    sort = [np.argsort(s) for s in seq]
    root = {k: k for k in label}

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    x, y = np.nonzero(ok)
    best = np.argsort(-agree[x, y], kind="stable")
    a, b = [], []
    for i, j in zip(x[best].tolist(), y[best].tolist()):
        u, v = find(label[i]), find(label[j])
        if u != v and aligned_similarity(seq[i], seq[j], order=sort[j]) >= SIMILARITY:
            root[v] = u
            a.append(node[i])
            b.append(node[j])
    return _pairs(a, b)


def _blocked(rows: DataFrame, level: int) -> DataFrame:
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("long")
    return rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(level)), blocks))


def _several(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one class."""
    keys = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    return rows.join(keys, "key")


def _meetings(marked: DataFrame) -> DataFrame:
    """The rows of mixed buckets with groups (key, p, q) in which every candidate
    pair of different classes meets.

    A candidate agrees in more than one sketch, so the texts of a bucket of more than
    ``BLOCK`` are dealt by each of their later sketches; what is then still larger
    is cut into blocks, of which every two meet.
    """
    mixed_rows = _several(marked)
    small, large = mixed_rows.where(F.col("size") <= BLOCK), mixed_rows.where(F.col("size") > BLOCK)
    later = F.explode(F.sequence(F.col("j") + 1, F.lit(SKETCHES - 1)).cast("array<int>"))
    dealt = large.where(F.col("j") < SKETCHES - 1).withColumn("k", later).withColumn(
        "key", F.xxhash64("key", "k", F.expr("substring(sketch, k * 8 + 1, 8)"))).drop("k")
    dealt = _several(sized(dealt.drop("size")))
    count = F.ceil(F.col("size") / F.lit(BLOCK)).cast("long")
    own = F.pmod(F.xxhash64("node"), count)
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    dealt = dealt.withColumn("p", F.least("own", "other")).withColumn("q", F.greatest("own", "other")).drop("own", "other")
    nought = F.lit(0).cast("long")
    return small.withColumn("p", nought).withColumn("q", nought).unionByName(dealt)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts align (texts: node, text)."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ta, tb = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            known: dict[int, np.ndarray] = {}
            for s, e in slices_by_size([len(x) + len(y) for x, y in zip(ta, tb)], 8 * SLICE):
                need = {i: t for i, t in [*zip(a[s:e], ta[s:e]), *zip(b[s:e], tb[s:e])] if i not in known}
                known |= dict(zip(need, labelled_shingles(list(need.values()))))
                good = [i for i in range(s, e) if aligned_similarity(known[a[i]], known[b[i]]) >= SIMILARITY]
                keep = set(a[e:e + 1])  # the next pairs often have the same leader
                known = {k: v for k, v in known.items() if k in keep}
                yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in good], pa.int64()), pa.array([b[i] for i in good], pa.int64())],
                                                 names=_PAIR_NAMES)

    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b"))
    return both.mapInArrow(check, PAIRS).checkpoint()


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each linked node's component.

    Each round takes the smallest label among a node and its neighbours (each node
    is its own neighbour too, which also keeps the label it had), then that label's label.
    """
    loops = links.select("a", F.col("a").alias("b")).union(links.select(F.col("b").alias("a"), "b"))
    edges = links.select("a", "b").union(links.select("b", "a")).union(loops).distinct().checkpoint()
    label = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).checkpoint()
    while True:
        near = edges.join(label, edges["b"] == label["node"]).groupBy("a").agg(
            F.min("label").alias("least"), F.min(F.when(F.col("a") == F.col("b"), F.col("label"))).alias("old"))
        goal = near.select(F.col("a").alias("least"), F.col("least").alias("label"))
        new = near.join(goal, "least").select(F.col("a").alias("node"), "label", "old").checkpoint()
        label = new.select("node", "label")
        if not new.where("label <> old").limit(1).count():
            return label


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(h1, h2, id, class_id, class_text, head, links): for each distinct text its
    smallest key; the smallest key of its class, the hash of the text that has it
    (of several the smallest hash) and whether this is that text, its class's head;
    the links of the text that were needed to find the class."""
    with finished_shuffles_removed(docs.sparkSession):
        return _classes(docs, key, text)


def _classes(docs: DataFrame, key: str, text: str) -> DataFrame:
    nodes = nodes_of(docs, key, text)
    rows = bucket_rows(nodes).checkpoint()
    # buckets of two: the smaller key leads
    member = F.struct("id", "node", "n")
    two = rows.where("size = 2").groupBy("key").agg(F.min(member).alias("x"), F.max(member).alias("y"))
    fit = F.least("x.n", "y.n") >= SIMILARITY * F.greatest("x.n", "y.n")
    star = two.where(fit).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.lit(0).alias("agree"))
    # leaders of the others, level by level where a bucket has more than one block
    level, at = 0, rows.where("size > 2")
    schema = "key long, a long, b long, agree int"
    while True:
        def led(t: pa.Table) -> pa.Table:
            p = _leaders(t)
            return p.add_column(0, "key", pa.array([t["key"][0].as_py()] * len(p), pa.int64()))

        got = _blocked(at, level).groupBy("key", "block").applyInArrow(led, schema).checkpoint()
        star = star.union(got.where("a <> b").select("a", "b", "agree"))
        again = at.where(F.col("size") > BLOCK)
        if not again.limit(1).count():
            break
        heads = got.where("a = b").select("key", F.col("a").alias("node"))

        again = sized(again.drop("size").join(heads, ["key", "node"]))
        before, after = at.where(F.col("size") > BLOCK).count(), again.count()
        if after > 0.7 * before:  # texts that differ and share a sketch: leaders no longer thin them out
            break
        level, at = level + 1, again.checkpoint()
    involved = rows.select("node").distinct()
    h1, h2 = text_hashes(text)
    own = nodes.join(involved, "node").select("node", "h1", "h2", "id")
    source = docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(MAX_LONG)).alias("id"), h1.alias("h1"), h2.alias("h2"),
                         F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    texts = source.join(own, ["h1", "h2", "id"]).groupBy("node").agg(F.first("text").alias("text")).checkpoint()
    best = F.max(F.struct("agree", (-F.col("a")).alias("o"))).alias("t")
    tried = star.groupBy("b").agg(best).select((-F.col("t.o")).alias("a"), "b").checkpoint()
    links = verified(tried, texts).union(links_of_few(nodes))
    label = components(links)
    # what the leaders left apart: candidates of a bucket in different classes
    marked = rows.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    meeting = _meetings(marked)
    few = meeting.groupBy("key", "p", "q").applyInArrow(_involved, meeting.schema).checkpoint()
    links = links.union(few.join(texts, "node").groupBy("key", "p", "q").applyInArrow(_others, PAIRS).checkpoint())
    label = components(links)
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count("*").alias("links"))
    out = nodes.join(label, "node", "left").join(degree, "node", "left").withColumn("label", F.coalesce("label", "node"))
    best = out.groupBy("label").agg(F.min(F.struct("id", "h1", "h2")).alias("best"))
    head = (F.col("h1") == F.col("best.h1")) & (F.col("h2") == F.col("best.h2"))
    return out.join(best, "label").select("h1", "h2", "id", F.col("best.id").alias("class_id"), F.col("best.h1").alias("class_text"),
                                          head.alias("head"), F.coalesce("links", F.lit(0)).alias("links")).checkpoint()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, class_id (the smallest key of the document's class; null only if
    all its keys are null), class_text (the hash of the text that stands for the
    class), representative (the row has that text and class_id as its key) and links.

    A class is named by (class_id, class_text): classes of unlike texts whose keys
    are null or repeat have the same class_id."""
    h1, h2 = text_hashes(text)
    found = classes(docs, key, text)
    rows = docs.select(F.col(f"`{key}`").alias(key), h1.alias("h1"), h2.alias("h2"))
    got = rows.join(found, ["h1", "h2"])
    own = F.coalesce(F.col(key).cast("long"), F.lit(MAX_LONG))
    return got.select(key, F.when(F.col("class_id") < MAX_LONG, F.col("class_id")).alias("class_id"), "class_text",
                      (F.col("head") & (own == F.col("class_id"))).alias("representative"), "links")


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each class: the row of the smallest doc_id; of rows that
    repeat it, the one of the smallest hash of the text."""
    h1, h2 = text_hashes()
    found = classes(docs.select("doc_id", "text")).where("head").select("h1", "h2", F.col("id").alias("__id"))
    rows = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(MAX_LONG))).withColumn("__h1", h1).withColumn("__h2", h2)
    kept = rows.join(found.withColumnsRenamed({"h1": "__h1", "h2": "__h2"}), ["__id", "__h1", "__h2"])
    return kept.dropDuplicates(["__id", "__h1", "__h2"]).select(*[f"`{c}`" for c in docs.columns])


def op8_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
