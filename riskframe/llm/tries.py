"""Conversation prefix trie with subtree totals by parallel tree contraction.

Every distinct sequence of first turns is a node.  A prefix is known by the
exclusive or of hashes of its turns and their places (two independent 64-bit
lanes), so a prefix's key is a running total: conversations of any length are
dealt over range partitions and no task holds a whole one.

Subtree totals come from contraction rounds over (node, parent) rows.  In a
round every leaf is raked into its parent, and of the unary chains every node
whose random priority is below its parent's and its child's is compressed: its
child moves up to its parent and carries what the node held.  A round is two
joins on node ids, each node meets one row there, and the leaves of a parent
are summed before the shuffle, so neither long chains (a constant share of a
chain goes in each round) nor wide nodes gather in a task.  A compressed node
is re-expanded from the node it stood on; following those references in
doubling steps gives every total.

Results for odd input: rows of null conv_id take no part; a null role or text
is an empty one; turns are ordered null first, equal turns of a conversation
by role and then by a hash of the text, repeated rows are turns of their own;
an empty table has no node, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import prepare, table, written
from riskframe.operators.core import keyed_join, range_buckets
from riskframe.operators.series import row_index

#: conversation ids of one text for the digest of a node's ends
ENDS_IN_CHUNK = 4_096
#: a conversation of the query takes its first turns from the first of so many ids
BLOCK_OF_CONVERSATIONS = 5
HEAD_TURNS = 9


def turns_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, t1, t2, n_bytes): the turns of each conversation, numbered
    from 0, with two hashes of role and text and the UTF-8 bytes of the text."""
    r, t = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.select(F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), r.alias("role"),
                                F.xxhash64(r, t).alias("t1"), F.xxhash64(F.lit("second"), t, r).alias("t2"),
                                F.octet_length(t).cast("long").alias("n_bytes")).where("conv_id IS NOT NULL")
    return row_index(rows, ["turn", "role", "t1", "t2"], ["conv_id"], out="pos").select("conv_id", "pos", "t1", "t2", "n_bytes")


def prefix_keys(turns: DataFrame) -> DataFrame:
    """``turns`` plus depth (1 for the first) and k1, k2 / p1, p2: keys of the
    prefix that ends with the turn and of the one before it.

    A running exclusive or: inside range partitions, and over their totals."""
    lanes = turns.withColumns({"l1": F.xxhash64("t1", "pos"), "l2": F.xxhash64("pos", "t2")})
    rows = range_buckets(lanes, [F.asc("conv_id"), F.asc("pos")])
    before = Window.partitionBy("conv_id").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    totals = rows.groupBy("conv_id", "_bucket").agg(*[F.bit_xor(c).alias(f"_{c}") for c in ("l1", "l2")])
    offsets = totals.select("conv_id", "_bucket", *[F.coalesce(F.bit_xor(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in ("l1", "l2")])
    inside = Window.partitionBy("conv_id", "_bucket").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    keyed = keyed_join(rows, offsets, ["conv_id", "_bucket"]).withColumns(
        {f"k{i}": F.bit_xor(f"l{i}").over(inside).bitwiseXOR(F.col(f"_l{i}")) for i in (1, 2)})
    return keyed.select("conv_id", "pos", (F.col("pos") + 1).alias("depth"), "n_bytes", "k1", "k2",
                        *[F.col(f"k{i}").bitwiseXOR(F.col(f"l{i}")).alias(f"p{i}") for i in (1, 2)])


def prefix_nodes(keyed: DataFrame, members: DataFrame) -> DataFrame:
    """One row for each node: depth, k1, k2 (its key), conv_id (smallest member),
    parent_conv_id, n_convs, n_children, n_bytes (of its last text).

    ``members`` holds the conv_id of every conversation, also of one without turns."""
    inner = keyed.groupBy("depth", "k1", "k2").agg(F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
                                                  F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"))
    nil, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        nil.alias("depth"), nil.alias("k1"), nil.alias("k2"), none.alias("p1"), none.alias("p2"), "conv_id", "n_convs", nil.alias("n_bytes"))
    nodes = written(inner.select(*root.columns).union(root))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("cd"), F.col("p1").alias("c1"), F.col("p2").alias("c2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("ad"), F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("conv_id").alias("parent_conv_id"))
    joined = (nodes.join(children, (F.col("depth") == F.col("cd")) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
              .join(above, (F.col("depth") == F.col("ad")) & (F.col("p1") == F.col("a1")) & (F.col("p2") == F.col("a2")), "left"))
    return joined.select("depth", "k1", "k2", "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", nil).alias("n_children"), "n_bytes")


def subtree_totals(tree: DataFrame, weights: list[str]) -> DataFrame:
    """(id, total_<weight>...): the sum of each weight over every node's subtree.

    ``tree`` holds id, parent (null for a root) and the weights, long numbers."""
    own, edge, total = ([f"{kind}_{w}" for w in weights] for kind in ("own", "edge", "total"))
    nil = F.lit(0).cast("long")
    degree = tree.where("parent IS NOT NULL").groupBy(F.col("parent").alias("up")).agg(F.count(F.lit(1)).alias("k"))
    live = tree.join(degree, F.col("id") == F.col("up"), "left").select(
        "id", "parent", F.coalesce("k", nil).alias("k"), *[F.col(w).cast("long").alias(o) for w, o in zip(weights, own)], *[nil.alias(e) for e in edge])
    rounds = []
    while True:
        seen = written(_round(live, own, edge, len(rounds)))
        rounds.append(seen)
        live = _next_round(seen, own, edge)
        if seen.where("act = 'stays'").limit(1).count() == 0:
            break
    done = reduce(DataFrame.unionByName, rounds)
    raked = done.where("act = 'raked'").select("id", *[F.col(o).alias(t) for o, t in zip(own, total)])
    # a compressed node is worth its child and what lay between; references double
    refs = done.where("act = 'compressed'").select("id", F.col("child").alias("to"), *[F.col(f"between_{w}").alias(t) for w, t in zip(weights, total)])
    reach = 1
    while reach < len(rounds):
        refs = written(refs)
        far = refs.select(F.col("id").alias("mid"), F.col("to").alias("end"), *[F.col(t).alias(f"far_{t}") for t in total])
        refs = refs.join(far, F.col("to") == F.col("mid"), "left").select(
            "id", F.coalesce("end", "to").alias("to"), *[(F.col(t) + F.coalesce(f"far_{t}", nil)).alias(t) for t in total])
        reach *= 2
    ends = raked.select(F.col("id").alias("end"), *[F.col(t).alias(f"end_{t}") for t in total])
    spread = refs.join(ends, F.col("to") == F.col("end")).select("id", *[(F.col(t) + F.col(f"end_{t}")).alias(t) for t in total])
    return written(raked.unionByName(spread))


def _priority(node: str, turn: int) -> Column:
    return F.xxhash64(F.col(node), F.lit(turn))


def _round(live: DataFrame, own: list[str], edge: list[str], turn: int) -> DataFrame:
    """``live`` with act (raked, compressed or stays), what its raked children
    bring added, and for a compressed node its child and what lies between."""
    leaf = F.col("k") == 0
    told = live.where("parent IS NOT NULL").groupBy(F.col("parent").alias("up")).agg(
        F.count_if(leaf).alias("raked"), F.min("id").alias("child"),
        *[F.sum(F.when(leaf, F.col(o) + F.col(e))).alias(f"brought_{o}") for o, e in zip(own, edge)],
        *[F.sum(e).alias(f"sole_{e}") for e in edge])  # the sole child's, where there is one
    seen = live.join(told, F.col("id") == F.col("up"), "left")
    low = (_priority("id", turn) < _priority("parent", turn)) & (_priority("id", turn) < _priority("child", turn))
    chain = (F.col("k") == 1) & (F.col("raked") == 0) & F.col("parent").isNotNull() & low
    act = F.when(leaf, "raked").when(F.coalesce(chain, F.lit(False)), "compressed").otherwise("stays")
    nil = F.lit(0).cast("long")
    return seen.select("id", "parent", (F.col("k") - F.coalesce("raked", nil)).alias("k"), act.alias("act"), "child",
                       *[(F.col(o) + F.coalesce(f"brought_{o}", nil)).alias(o) for o in own], *edge,
                       *[(F.col(o) + F.col(f"sole_{e}")).alias(o.replace("own_", "between_", 1)) for o, e in zip(own, edge)])


def _next_round(seen: DataFrame, own: list[str], edge: list[str]) -> DataFrame:
    """The nodes that stay; children of compressed nodes hang on the node above."""
    moved = seen.where("act = 'compressed'").select(F.col("child").alias("mover"), F.col("parent").alias("lifted"),
                                                   *[(F.col(o) + F.col(e)).alias(f"more_{e}") for o, e in zip(own, edge)])
    nil = F.lit(0).cast("long")
    return seen.where("act = 'stays'").join(moved, F.col("id") == F.col("mover"), "left").select(
        "id", F.coalesce("lifted", "parent").alias("parent"), "k", *own, *[(F.col(e) + F.coalesce(f"more_{e}", nil)).alias(e) for e in edge])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's id texts, which come in order; one hash is open at a time."""
    names = ["depth", "k1", "k2", "ends_sha256"]
    key, open_hash = None, None
    for batch in batches:
        out = []
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*names[:3], "ids"))):
            if node != key:
                if key:
                    out.append((*key, open_hash.hexdigest()))
                key, open_hash = node, hashlib.sha256()
            else:
                open_hash.update(b",")
            open_hash.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, open_hash.hexdigest())], names=names)


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of (depth, k1, k2, conv_id): SHA-256 of each node's
    ids in order, joined by commas.

    Ids are sorted in range partitions and joined to texts of ``ENDS_IN_CHUNK``; the
    hash of a node then runs over its texts in order, of which a task holds a batch."""
    node = ["depth", "k1", "k2"]
    rows = range_buckets(ends, [F.asc(c) for c in (*node, "conv_id")])
    place = F.row_number().over(Window.partitionBy(*node, "_bucket").orderBy("conv_id"))
    chunks = rows.withColumn("chunk", F.floor((place - 1) / ENDS_IN_CHUNK)).groupBy(*node, "_bucket", "chunk").agg(
        F.min("conv_id").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    ordered = chunks.repartition(*node).sortWithinPartitions(*node, "first").select(*node, "ids")
    return ordered.mapInArrow(_digests, "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The trie of the conversations in ``members`` (conv_id) with their ``turns``
    (as of ``turns_of``): a row for each node.

    conv_id (smallest member), depth, parent_conv_id, n_convs (members),
    n_children, n_leaves and saved_tokens (sums over the subtree of childless
    nodes and of (n_convs - 1) times the bytes of the last text), ends_sha256
    (of the members that end here)."""
    members = members.select("conv_id").distinct()
    keyed = written(prefix_keys(turns))
    nodes = written(prefix_nodes(keyed, members))
    node_id = F.struct("conv_id", "depth")  # of one depth no two nodes share a member
    tree = nodes.select(node_id.alias("id"), F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))).alias("parent"),
                        (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    totals = subtree_totals(tree, ["leaves", "saved"]).select(
        F.col("id.conv_id").alias("tc"), F.col("id.depth").alias("td"), F.col("total_leaves").alias("n_leaves"), F.col("total_saved").alias("saved_tokens"))
    nil = F.lit(0).cast("long")
    last = keyed.groupBy("conv_id").agg(F.max_by(F.struct("depth", "k1", "k2"), "depth").alias("n"))
    ends = members.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(f"n.{c}", nil).alias(c) for c in ("depth", "k1", "k2")])
    digest = ends_digests(ends).select(F.col("depth").alias("ed"), F.col("k1").alias("e1"), F.col("k2").alias("e2"), "ends_sha256")
    return (nodes.join(totals, (F.col("conv_id") == F.col("tc")) & (F.col("depth") == F.col("td")))
            .join(digest, (F.col("depth") == F.col("ed")) & (F.col("k1") == F.col("e1")) & (F.col("k2") == F.col("e2")), "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))


def with_last_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` of a trie over ``conversations`` plus last_role and last_text of
    each (null at the root); ``conversations`` holds conv_id, pos, role and text."""
    said = conversations.select(F.col("conv_id").alias("sc"), (F.col("pos") + 1).alias("sd"), F.col("role").alias("last_role"), F.col("text").alias("last_text"))
    return nodes.join(said, (F.col("conv_id") == F.col("sc")) & (F.col("depth") == F.col("sd")), "left").drop("sc", "sd")


def with_shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, members) of the query's conversations: c begins with the first
    h turns of conversation c - c % 5 instead of its own; h is crc32(c) % 9."""
    turns = written(turns)
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    c = F.col("conv_id")
    convs = convs.withColumns({"base": c - c % BLOCK_OF_CONVERSATIONS, "h": F.crc32(c.cast("string").cast("binary")) % HEAD_TURNS})
    bases = convs.select(F.col("conv_id").alias("b"), F.col("n").alias("base_n"))
    convs = written(convs.join(bases, F.col("base") == F.col("b"), "left").withColumn(
        "taken", F.least("h", F.coalesce("base_n", F.lit(0).cast("long")))).drop("b"))
    rest = [F.col(x) for x in ("t1", "t2", "n_bytes")]
    # at most five conversations share a head, and a head has at most eight turns
    heads = turns.where(F.col("pos") < HEAD_TURNS - 1).withColumnRenamed("conv_id", "from")
    begun = convs.join(heads, (F.col("base") == F.col("from")) & (F.col("pos") < F.col("taken"))).select("conv_id", "pos", *rest)
    own = turns.join(convs.select(F.col("conv_id").alias("own"), "h", "taken"), F.col("conv_id") == F.col("own"))
    kept = own.where(F.col("pos") >= F.col("h")).select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), *rest)
    return begun.union(kept), convs.select("conv_id")


def op11_conversation_trie(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    return prefix_trie(*with_shared_heads(turns_of(table(spark, sf_dir, "conversations"))))


OP11_SQL = """
WITH RECURSIVE crc AS (
  SELECT list(x ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS x
    FROM range(256) r(i))),
ordered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: ascii(ch))),
             lambda a, b: xor(a // 256, t[CAST(xor(a % 256, b) AS INTEGER) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM ordered), crc),
rebuilt AS (
  SELECT c.conv_id, o.pos, o.role, o.text FROM convs c JOIN ordered o ON o.conv_id = c.base AND o.pos < c.h
  UNION ALL
  SELECT c.conv_id, 100 + o.pos, o.role, o.text FROM convs c JOIN ordered o ON o.conv_id = c.conv_id AND o.pos >= c.h),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth, role, text FROM rebuilt),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS depth, '' AS key, '' AS parent, CAST(0 AS BIGINT) AS bytes FROM convs
  UNION ALL
  SELECT w.conv_id, t.depth, sha256(w.key || strlen(t.role) || ':' || t.role || t.text), w.key, CAST(strlen(t.text) AS BIGINT)
  FROM walk w JOIN turns t ON t.conv_id = w.conv_id AND t.depth = w.depth + 1),
nodes AS (
  SELECT key, depth, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM walk GROUP BY key, depth),
kids AS (SELECT parent AS key, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
below AS (
  SELECT a.key, a.depth, count(*) FILTER (WHERE k.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
  FROM nodes n LEFT JOIN kids k ON k.key = n.key AND k.depth = n.depth
  JOIN walk a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY 1, 2),
tails AS (
  SELECT w.key, w.depth, string_agg(CAST(w.conv_id AS VARCHAR), ',' ORDER BY w.conv_id) AS ids
  FROM walk w JOIN (SELECT conv_id, max(depth) AS depth FROM walk GROUP BY 1) l USING (conv_id, depth) GROUP BY 1, 2)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.key = n.parent AND p.depth = n.depth - 1
LEFT JOIN kids k ON k.key = n.key AND k.depth = n.depth
JOIN below b ON b.key = n.key AND b.depth = n.depth
LEFT JOIN tails e ON e.key = n.key AND e.depth = n.depth"""
