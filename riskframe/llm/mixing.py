"""Soft-membership mixing to target weights (native Spark).

A naive Bayes classifier over hashed words, fitted on a bounded sample of a
labelled table, gives each text a posterior over domains.  Tokens are
white-space-separated words.  The expected tokens of domain d at rates r are
A_d = sum_i n_i p_id r_i.  Starting from rate one, projected gradient steps

    r_i <- max(least, r_i - sum_d p_id (A_d - target_d) / M_d),   M_d = A_d at rate one,

(``least`` is 0, or 1 where no document may go) reduce the squared distance to the target totals; scaled by M the largest
curvature is one, so the full step is safe.  Each step is one aggregate over
the texts; the rate of a text follows from its posterior and the steps so far,
so that only one number per domain comes to the driver in each step.  Rates
become whole numbers of copies by a hash of doc_id: floor(rate + u).

Results for odd input: a text that is null or has no word has no tokens, no
domain, rate 1 and one copy; labelled rows with a null text or domain are not
used; with no labelled row all rates are 1, but a target for a domain without
labelled rows is an error; a domain without tokens keeps
total 0, whatever its target; equal texts share their posterior and rate;
repeated rows get equal copies; an empty table gives an empty result; very long
texts are read whole; input columns named like an output are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import hash_share, prepare, replace_columns, sample_share, table

#: bound of the fit: about so many labelled rows, and so many of each domain besides
MAX_LABELLED = 20_000
LEAST_LABELLED = 500
BUCKETS = 1 << 14
SMOOTHING = 0.5
#: how sharply the mean log likelihood of a word tells domains apart
SHARPNESS = 6.0
STEPS = 40
TOLERANCE = 1e-4
#: the corpus' own share of a domain to this power is its target weight
FLATTEN = 0.7
#: target tokens above what keeps the largest domain whole
HEADROOM = 1.02


def _hashes(text: str) -> tuple[Column, Column]:
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return F.xxhash64(t).alias("h1"), F.xxhash64(F.lit("second"), t).alias("h2")


def _words(text: Column) -> Column:
    """Buckets of the words of a text."""
    return F.explode(F.split(F.trim(F.lower(text)), r"\s+"))


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def fit(labelled: DataFrame, text: str = "text", domain: str = "domain", max_rows: int = MAX_LABELLED) -> tuple[list[str], DataFrame | None]:
    """(domains, weights): weights has a row for each word bucket (at most
    ``BUCKETS`` + 1 rows) with the log likelihood in each domain, w0, w1, ..."""
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{domain}`").cast("string").alias("domain")).where(
        F.col("text").isNotNull() & F.col("domain").isNotNull() & F.regexp_like("text", F.lit(r"\S")))
    rows = rows.withColumn("u", hash_share("text", seed="mix"))
    known = rows.groupBy("domain").agg(F.count("*").alias("n"), F.min("u").alias("least")).collect()
    even, share = sample_share(sum(r["n"] for r in known), max_rows), F.lit(0.0)
    for r in known:  # a rare domain keeps its rows, and every domain one at least
        own = max(even, sample_share(r["n"], LEAST_LABELLED), r["least"])
        share = F.when(F.col("domain") == r["domain"], own).otherwise(share)
    words = (rows.where(F.col("u") <= share).select("domain", _words(F.col("text")).alias("word"))
             .where("word <> ''").groupBy("domain", _bucket(F.col("word")).alias("bucket")).agg(F.count("*").alias("n")).checkpoint())
    totals = {r["domain"]: r["n"] for r in words.groupBy("domain").agg(F.sum("n").alias("n")).collect()}
    domains = sorted(totals)
    if not domains:
        return [], None
    columns = []
    for i, d in enumerate(domains):
        n = F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("n"))), F.lit(0))
        columns.append(F.log((n + SMOOTHING) / (totals[d] + SMOOTHING * BUCKETS)).alias(f"w{i}"))
    return domains, words.groupBy("bucket").agg(*columns).checkpoint()


def posteriors(docs: DataFrame, domains: list[str], weights: DataFrame, text: str = "text") -> DataFrame:
    """(h1, h2, rows, tokens, p0, p1, ...) for each distinct text with a word;
    tokens are those of one copy."""
    h1, h2 = _hashes(text)
    unseen = [F.lit(0.0)] * len(domains)  # a bucket that no labelled text has says nothing
    # hashed before the words are taken apart: once for each text, not for each word
    texts = docs.where(F.col(f"`{text}`").isNotNull()).select(h1, h2, F.col(f"`{text}`").alias("text"))
    words = (texts.select("h1", "h2", _words(F.col("text")).alias("word")).where("word <> ''")
             .select("h1", "h2", _bucket(F.col("word")).alias("bucket")))
    # weights: a bounded number of buckets
    scored = words.join(F.broadcast(weights), "bucket", "left").groupBy("h1", "h2").agg(
        F.count("*").alias("words"), *[F.sum(F.coalesce(f"w{i}", u)).alias(f"s{i}") for i, u in enumerate(unseen)])
    copies = docs.where(F.col(f"`{text}`").isNotNull()).groupBy(h1, h2).agg(F.count("*").alias("rows"))
    got = scored.join(copies, ["h1", "h2"])
    mean = [F.col(f"s{i}") / F.col("words") * SHARPNESS for i in range(len(domains))]
    top = F.greatest(*mean) if len(mean) > 1 else mean[0]
    raw = [F.exp(m - top) for m in mean]
    total = reduce(lambda a, b: a + b, raw)
    return got.select("h1", "h2", "rows", (F.col("words") / F.col("rows")).cast("long").alias("tokens"),
                      *[(r / total).alias(f"p{i}") for i, r in enumerate(raw)]).checkpoint()


def rate_of(steps: list[list[float]], least: float = 0.0) -> Column:
    """The rate of a text after these steps (one number per domain each)."""
    rate = F.lit(1.0)
    for step in steps:
        move = reduce(lambda a, b: a + b, [F.col(f"p{i}") * F.lit(float(g)) for i, g in enumerate(step)])
        rate = F.greatest(F.lit(float(least)), rate - move)
    return rate


def totals(known: DataFrame, size: int, steps: list[list[float]], least: float = 0.0) -> list[float]:
    r = rate_of(steps, least)
    row = known.agg(*[F.sum(F.col("rows") * F.col("tokens") * F.col(f"p{i}") * r).alias(f"a{i}") for i in range(size)]).first()
    return [float(v or 0.0) for v in row]


def solve(known: DataFrame, targets: list[float], tolerance: float = TOLERANCE, most: int = STEPS, least: float = 0.0) -> list[list[float]]:
    """Steps of the projected gradient until every total is within ``tolerance``
    of its target, relative to the sum of targets."""
    start = totals(known, len(targets), [])
    steps: list[list[float]] = []
    now = start
    for _ in range(most):
        if max(abs(a - t) for a, t in zip(now, targets)) <= tolerance * max(sum(targets), 1.0):
            break
        steps.append([(a - t) / m if m > 0 else 0.0 for a, t, m in zip(now, targets, start)])
        now = totals(known, len(targets), steps, least)
    return steps


def flattened_targets(own: list[float], power: float = FLATTEN, headroom: float = HEADROOM) -> list[float]:
    """Totals whose shares are the own shares to ``power``, so large that no
    domain with tokens has to shrink."""
    weights = [a ** power if a > 0 else 0.0 for a in own]
    whole = max((a / w for a, w in zip(own, weights) if w > 0), default=0.0) * headroom
    return [whole * w for w in weights]


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, total: float | None = None,
        key: str = "doc_id", text: str = "text", least: float = 0.0) -> DataFrame:
    """``docs`` plus domain (most probable), posterior, tokens, rate and copies.

    ``weights``: target share of each domain (and ``total`` tokens, by default
    the corpus' own); without them the corpus' shares are flattened.  No rate
    falls below ``least``.
    """
    domains, model = fit(labelled)
    lost = sorted(d for d, w in (weights or {}).items() if w > 0 and d not in domains)
    if lost:
        raise ValueError(f"no labelled row for the target domains {lost}")
    none = F.struct(F.lit(None).cast("string").alias("domain"), F.lit(0.0).alias("posterior"), F.lit(0).cast("long").alias("tokens"),
                    F.lit(1.0).alias("rate"), F.lit(1).cast("long").alias("copies"))
    names = ("domain", "posterior", "tokens", "rate", "copies")
    if not domains:
        return replace_columns(docs, none, *names)
    known = posteriors(docs.select(F.col(f"`{text}`").alias("text")), domains, model)
    own = totals(known, len(domains), [])
    if weights is None:
        targets = flattened_targets(own)
    else:
        whole = sum(weights.get(d, 0.0) for d in domains) or 1.0
        targets = [(total if total is not None else sum(own)) * weights.get(d, 0.0) / whole for d in domains]
    steps = solve(known, targets, least=least)
    p = [F.col(f"p{i}") for i in range(len(domains))]
    best = F.greatest(*p) if len(p) > 1 else p[0]
    domain = F.coalesce(*[F.when(c == best, F.lit(d)) for c, d in zip(p, domains)])
    rates = known.select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.struct(
        domain.alias("domain"), best.alias("posterior"), "tokens", rate_of(steps, least).alias("rate")).alias("__mix"))
    h1, h2 = _hashes(text)
    got = docs.withColumn("__h1", h1).withColumn("__h2", h2).withColumn("__u", hash_share(key, seed="mix-copies"))
    got = got.join(rates, ["__h1", "__h2"], "left")
    out = F.when(F.col("__mix").isNull(), none).otherwise(F.struct(
        "__mix.domain", "__mix.posterior", "__mix.tokens", "__mix.rate",
        F.floor(F.col("__mix.rate") + F.col("__u")).cast("long").alias("copies")))
    return replace_columns(got, out, *names).drop("__h1", "__h2", "__u", "__mix")


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The rows as often as their copies say."""
    each = mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select(*[f"`{c}`" for c in columns])


def labelled_by_language(docs: DataFrame) -> DataFrame:
    return docs.select("text", F.col("lang").alias("domain"))


def op5_soft_mixing(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return mix(docs.select("doc_id", "text"), labelled_by_language(docs)).drop("text")
