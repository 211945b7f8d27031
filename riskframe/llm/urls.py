"""URL filters by rules and by propagation over the link graph (native Spark).

Rules name a host and a path prefix.  A page that a rule fits gets the rule's
verdict (the longest rule wins; between equally long ones, block).  The other
pages get the verdict of their host: trust flows from hosts whose pages the
allow rules fit along links (personalised PageRank), distrust flows from hosts
whose pages the block rules fit against the links.  A host is blocked when its
distrust exceeds its trust and reaches ``BLOCK_AT`` of what a host has whose
pages are all blocked.  Rounds go on until no host's verdict can change any more:
scores only grow, a round hands on at most ``DAMPING`` of the last round's growth,
so the growth of all scores in a round bounds what any may still gain.

Before the rounds, hosts with a single neighbour (most hosts, where few pages
link elsewhere) are solved for: a leaf's score is its seed and what its hub hands
it, which put into the hub's equation leaves an equation without the leaf.  The
hub's score divided by what it gets back of itself, and each leaf's from its
hub's, follow after the rounds.  Of no host does the rest hand on more than ``DAMPING``, as before.

Edges of the host graph are the absolute links of each page and, with weight
``OWNER``, those between a host and the host above it (``a.b.c`` and ``b.c``),
in both directions, for hosts above with at least two labels.

Results for odd input: a null url or one without ``://`` has empty host and
path, no rule, and is allowed; null or empty html has no links; links to a
page's own host count for nothing; repeated rows are judged alike; a host
without seeds in reach is allowed; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import prepare, table

DAMPING = 0.85
#: 0.85 to this power is under 1e-28: no score still changes
ROUNDS = 400
#: a propagation ends when no score changes by this much in a round
#: and no verdict can change, or when no score can change by EXACT
TOLERANCE = 1e-4
EXACT = 5e-10
#: rounds between two checkpoints
CUT = 4
#: passes that solve for leaves (a pass may make new ones)
LEAF_PASSES = 3
BLOCK_AT = 0.5
OWNER = 0.5

#: (verdict, host and path)
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, or nulls."""
    rule, verdict = [], []
    for says, text in sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block", r[1])):
        where, slash, rest = text.partition("/")
        fits = ((host == where) | F.endswith(host, F.lit("." + where))) & F.startswith(path, F.lit(slash + rest))
        rule.append(F.when(fits, text))
        verdict.append(F.when(fits, says))
    none = F.lit(None).cast("string")
    return F.coalesce(*rule, none), F.coalesce(*verdict, none)


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, weight): links between different hosts and links to the host above."""
    links = (pages.select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
             .select(F.col("host").alias("src"), F.translate("dst", UPPER, LOWER).alias("dst"))
             .where((F.col("src") != F.col("dst")) & (F.col("src") != "")).groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight")))
    every = hosts.select("host").union(links.select("dst")).distinct().withColumn("labels", F.split("host", r"\."))
    tail = lambda i: F.array_join(F.slice("labels", i, F.size("labels")), ".")
    steps = F.when(F.size("labels") > 2, F.transform(F.sequence(F.lit(1), F.size("labels") - 2),
                                                     lambda i: F.struct(tail(i).alias("host"), tail(i + 1).alias("up"))))
    above = every.select(F.explode(steps).alias("e")).select("e.host", "e.up").distinct()
    own = above.select(F.col("host").alias("src"), F.col("up").alias("dst"), F.lit(OWNER).alias("weight"))
    own = own.union(above.select("up", "host", F.lit(OWNER)))
    return links.union(own).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def blocked(trust: Column, distrust: Column) -> Column:
    return (distrust > trust) & (distrust >= BLOCK_AT * (1 - DAMPING))


def open_verdicts(score: DataFrame, more_trust: float, more_distrust: float) -> bool:
    """Whether a host's verdict differs within what its scores may still gain."""
    t, d = F.col("trust"), F.col("distrust")
    return bool(score.where(blocked(t, d + more_distrust) & ~blocked(t + more_trust, d)).limit(1).count())


def without_leaves(seeds: DataFrame, moves: DataFrame):
    """(seeds, moves, back) of the graph without its hosts of a single neighbour, or
    None where there are none; ``back`` makes scores of the whole graph from those
    of the rest.  Of two hosts that have only each other the smaller one stays."""
    pairs = moves.select("host", "to").union(moves.select("to", "host"))
    single = pairs.groupBy("host").agg(F.min("to").alias("hub"), F.max("to").alias("far")).where("hub = far").select("host", "hub")
    other = single.select(F.col("host").alias("hub"), F.lit(True).alias("also"))
    single = single.join(other, "hub", "left").where(F.col("also").isNull() | (F.col("host") > F.col("hub")))
    up = moves.select("host", F.col("to").alias("hub"), F.col("t").alias("up_t"), F.col("d").alias("up_d"))
    down = moves.select(F.col("host").alias("hub"), F.col("to").alias("host"), F.col("t").alias("down_t"), F.col("d").alias("down_d"))
    legs = (single.select("host", "hub").join(up, ["host", "hub"], "left").join(down, ["host", "hub"], "left")
            .join(seeds, "host", "left").fillna(0.0).checkpoint())
    if not legs.limit(1).count():
        return None
    # what a hub gets from its leaves' seeds, and of its own score by way of them
    hubs = legs.groupBy("hub").agg(F.sum(F.col("up_t") * F.col("trust")).alias("trust"), F.sum(F.col("up_d") * F.col("distrust")).alias("distrust"),
                                   F.sum(F.col("up_t") * F.col("down_t")).alias("own_t"), F.sum(F.col("up_d") * F.col("down_d")).alias("own_d")).checkpoint()
    gone = legs.select("host")
    rest = seeds.join(gone, "host", "left_anti").union(hubs.select("hub", "trust", "distrust")).groupBy("host").agg(
        F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
    own = hubs.select(F.col("hub").alias("host"), "own_t", "own_d")
    kept = (moves.join(gone, "host", "left_anti").join(gone.select(F.col("host").alias("to")), "to", "left_anti").join(own, "host", "left")
            .select("host", "to", (F.col("t") / (1 - F.coalesce("own_t", F.lit(0.0)))).alias("t"), (F.col("d") / (1 - F.coalesce("own_d", F.lit(0.0)))).alias("d")))

    def back(score: DataFrame) -> DataFrame:
        whole = score.join(own, "host", "left").select("host", (F.col("trust") / (1 - F.coalesce("own_t", F.lit(0.0)))).alias("trust"),
                                                       (F.col("distrust") / (1 - F.coalesce("own_d", F.lit(0.0)))).alias("distrust"))
        hub = whole.select(F.col("host").alias("hub"), F.col("trust").alias("hub_t"), F.col("distrust").alias("hub_d"))
        leaves = legs.join(hub, "hub", "left").fillna(0.0).select(
            "host", (F.col("trust") + F.col("down_t") * F.col("hub_t")).alias("trust"), (F.col("distrust") + F.col("down_d") * F.col("hub_d")).alias("distrust"))
        return whole.union(leaves)

    return rest.checkpoint(), kept.checkpoint(), back


def host_scores(pages: DataFrame) -> DataFrame:
    """(host, trust, distrust) from pages with host, html and rule verdict."""
    seeds = pages.groupBy("host").agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("says") == "allow", 1).otherwise(0)).alias("allowed"),
        F.sum(F.when(F.col("says") == "block", 1).otherwise(0)).alias("blocked"))
    seeds = seeds.select("host", ((1 - DAMPING) * F.col("allowed") / F.col("n")).alias("trust"),
                         ((1 - DAMPING) * F.col("blocked") / F.col("n")).alias("distrust")).where("host <> ''").checkpoint()
    edges = host_edges(pages, seeds).checkpoint()
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    into = edges.groupBy("dst").agg(F.sum("weight").alias("total"))
    # what a host hands on: trust to those it links to, distrust to those that link to it
    moves = (edges.join(out, "src").select(F.col("src").alias("host"), F.col("dst").alias("to"),
                                           (DAMPING * F.col("weight") / F.col("total")).alias("t"), F.lit(0.0).alias("d"))
             .union(edges.join(into, "dst").select("dst", "src", F.lit(0.0), DAMPING * F.col("weight") / F.col("total")))
             .groupBy("host", "to").agg(F.sum("t").alias("t"), F.sum("d").alias("d")).checkpoint())
    backs = []
    for _ in range(LEAF_PASSES):
        smaller = without_leaves(seeds, moves)
        if smaller is None:
            break
        seeds, moves, back = smaller
        backs.append(back)

    def whole(score: DataFrame) -> DataFrame:
        for back in reversed(backs):
            score = back(score)
        return score

    if not moves.limit(1).count():
        return whole(seeds)
    # a hub's score grows by so much more than the sum it is divided from, at most
    wider = (1 - DAMPING ** 2) ** -len(backs)
    moves = moves.repartition("host").persist()
    score = seeds
    for turn in range(1, ROUNDS + 1):
        # moves stay where their host is, so a round has one exchange: that of the sums
        sent = score.join(moves, "host").select(F.col("to").alias("host"), (F.col("trust") * F.col("t")).alias("trust"),
                                                (F.col("distrust") * F.col("d")).alias("distrust"))
        new = seeds.union(sent).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if turn % CUT == 0 or turn == ROUNDS:
            last, score = score, new.checkpoint()
            grown = score.join(last.select("host", F.col("trust").alias("t0"), F.col("distrust").alias("d0")), "host", "left").select(
                "trust", "distrust", (F.col("trust") - F.coalesce("t0", F.lit(0.0))).alias("t"), (F.col("distrust") - F.coalesce("d0", F.lit(0.0))).alias("d"))
            change, t, d = grown.agg(F.max(F.greatest(F.abs("t"), F.abs("d"))), F.sum(F.abs("t")), F.sum(F.abs("d"))).first()
            past = wider * DAMPING / (1 - DAMPING)
            if change is None or past * max(t, d) < EXACT or (wider * change < TOLERANCE and not open_verdicts(whole(score), past * t, past * d)):
                break
        else:
            score = new
    else:
        raise RuntimeError(f"verdicts are open after {ROUNDS} rounds")
    moves.unpersist()
    return whole(score)


def judge(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for (page_id, url, html)."""
    host, path = host_and_path(F.col("url"))
    known = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    known = known.withColumn("rule", rule).withColumn("says", says)
    scores = host_scores(known)
    return known.drop("html").join(scores, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("says", F.when(blocked(F.col("trust"), F.col("distrust")), "block"), F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    return judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), RULES)
