"""Exact seeded sampling and splitting.

pandas/sklearn draw exact sample sizes; Spark's ``sample`` is Bernoulli.
Here a row's place in the sample is decided by the rank of ``md5(key‖seed)``:
exact sizes, reproducible across runs, engines and executor losses (no
dependence on partitioning or task order).  A sample needs only the hash at
which the rank reaches its size (``core.hash_cuts``): rows are compared with
it where they are and never shuffled.  Folds need every rank (``hash_rank``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .core import col, first_by_hash, hash_rank


def _k(frac: float, n) -> F.Column:
    # round half to even, as Python's round(frac * n)
    return F.bround(F.lit(frac) * n, 0)


def sample_exact(df: DataFrame, key: Sequence[str], frac: float, seed: int = 42,
                 exact: bool = True) -> DataFrame:
    """Exactly round(frac·n) rows without replacement (``exact=False``:
    Bernoulli ``df.sample``).  ``key`` must identify rows uniquely."""
    if not exact:
        return df.sample(withReplacement=False, fraction=frac, seed=seed)
    return first_by_hash(df, key, lambda n: _k(frac, n), seed).where("_first").select(*[col(c) for c in df.columns])


def stratified_split(df: DataFrame, key: Sequence[str], target: str, test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Adds ``split`` ∈ {train, test}: per class exactly round(test_size·n_c)
    test rows; with fewer than two classes the split is unstratified."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    n_classes = df.select(F.count_distinct(col(target))).first()[0]
    strata = [target] if n_classes >= 2 else []
    r = first_by_hash(df, key, lambda n: _k(test_size, n), seed, strata)
    return r.select(*[col(c) for c in df.columns], F.when(F.col("_first"), "test").otherwise("train").alias("split"))


def stratified_folds(df: DataFrame, key: Sequence[str], target: str, k: int = 5,
                     seed: int = 42) -> DataFrame:
    """D3: ``fold`` = (rank within class − 1) mod k — class-balanced folds whose
    sizes differ by at most one per class."""
    r = hash_rank(df, key, seed, strata=[target])
    return r.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).select(*df.columns, "fold")


def split_class_shares(df: DataFrame, target: str = "target", split: str = "split") -> DataFrame:
    """Per split: rows, good/bad counts and % (absent class = 0)."""
    t = col(target)
    g = df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"), F.count_if(t == 0).alias("good"),
                              F.count_if(t == 1).alias("bad"))
    return g.select(split, "rows", "good", "bad",
                    F.round(F.col("good") * 100.0 / F.col("rows"), 4).alias("good_pct"),
                    F.round(F.col("bad") * 100.0 / F.col("rows"), 4).alias("bad_pct"))
