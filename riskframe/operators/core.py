"""Shared building blocks used by most operators.

* ``one_pass``      – many per-column statistics in one aggregate job, long result
* ``melt``          – (id…, column, value) long form of several columns
* ``running_totals``– distributed prefix sums (no single-task window)
* ``hash_rank``     – exact, seeded, reproducible row rank (for exact samples,
                      stratified splits and folds)
* ``small_join``    – equi-join that broadcasts only a side of checked size

Nothing here collects data-sized results on the driver: the only driver
round trips are bucket boundaries and row counts of tables whose size is
bounded by construction (number of columns, number of buckets).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)

#: largest table (rows) we let Spark broadcast without further thought
BROADCAST_ROW_LIMIT = 2_000_000

#: statistics per aggregate job before codegen starts to suffer
CHUNK = 100


def col(name: str) -> Column:
    """Column by exact name (names may contain dots, e.g. ``default.payment.next.month``)."""
    return F.col(f"`{name}`")


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """pandas treats NaN as missing; make it NULL once so every aggregate skips it."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    targets = [c for c in (columns if columns is not None else df.columns) if c in floats]
    if not targets:
        return df
    return df.withColumns({c: F.when(F.isnan(col(c)), F.lit(None)).otherwise(col(c)) for c in targets})


def safe_corr(a: Column, b: Column) -> Column:
    """Pairwise-complete Pearson r; null (not an ANSI divide-by-zero error)
    when either side is constant.  Co-moment aggregates, numerically stable."""
    a2 = F.when(b.isNotNull(), a.cast("double"))
    b2 = F.when(a.isNotNull(), b.cast("double"))
    return F.try_divide(F.covar_pop(a2, b2), F.stddev_pop(a2) * F.stddev_pop(b2))


def _chunks(items: Sequence[str], size: int) -> list[Sequence[str]]:
    return [items[i:i + size] for i in range(0, len(items), size)] or [[]]


def one_pass(df: DataFrame, columns: Sequence[str],
             metrics: dict[str, Callable[[Column], Column]],
             chunk: int = CHUNK) -> DataFrame:
    """Long table ``(column, <metric>...)``: every metric of every column.

    All statistics of a chunk of columns are computed by a single aggregate
    (partial aggregation map-side, one tiny shuffle); chunks keep the
    generated code small for very wide tables.
    """
    if not columns:
        schema = "column string, " + ", ".join(f"`{m}` double" for m in metrics)
        return df.sparkSession.createDataFrame([], schema)
    parts = []
    for part in _chunks(list(columns), max(1, chunk // max(1, len(metrics)) or 1)):
        structs = [F.struct(F.lit(c).alias("column"), *[fn(col(c)).alias(m) for m, fn in metrics.items()])
                   for c in part]
        parts.append(df.agg(F.array(*structs).alias("_s")).select(F.inline("_s")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str],
         value_type: str = "double", drop_nulls: bool = True,
         name_col: str = "column", value_col: str = "value") -> DataFrame:
    """(ids…, column, value) for the given columns, values cast to one type."""
    cast = df.select(*[col(i) for i in ids], *[col(c).cast(value_type).alias(c) for c in columns])
    long = cast.unpivot([col(i) for i in ids], [col(c) for c in columns], name_col, value_col)
    return long.where(F.col(value_col).isNotNull()) if drop_nulls else long


def small_join(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = BROADCAST_ROW_LIMIT, known_rows: int | None = None) -> DataFrame:
    """Join where one side is expected to be small.

    With a static bound ``known_rows`` (e.g. number of columns, classes or
    buckets) at most ``max_rows`` the small side is broadcast.  Without one,
    no hint is given: adaptive execution measures the materialised small
    side at runtime and broadcasts it only when it is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise the join
    shuffles (skew-split by AQE).
    """
    if known_rows is not None and known_rows <= max_rows:
        return big.join(F.broadcast(small), on=on, how=how)
    return big.join(small, on=on, how=how)


def keyed_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner",
               known_rows: int | None = None, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Join on ``keys`` where null equals null (a null group is a group)."""
    side = small.withColumnsRenamed({k: f"_k_{i}" for i, k in enumerate(keys)})
    if known_rows is not None and known_rows <= max_rows:
        side = F.broadcast(side)
    on = None
    for i, k in enumerate(keys):
        cond = big[f"`{k}`"].eqNullSafe(side[f"_k_{i}"])
        on = cond if on is None else on & cond
    return big.join(side, on, how).drop(*[f"_k_{i}" for i in range(len(keys))])


def range_buckets(df: DataFrame, order: Sequence[Column], buckets: int | None = None) -> DataFrame:
    """``df`` in range partitions of ``order`` with the partition as ``_bucket``.

    The ranges come from Spark's own sample of the rows, so a large key is
    spread over as many buckets as its rows ask for, and their number
    follows ``spark.sql.shuffle.partitions``.  The checkpoint keeps the
    ranges the same for every later read.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(df.sparkSession)
    return df.repartitionByRange(n, *order).withColumn("_bucket", F.spark_partition_id()).checkpoint()


def running_totals(df: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str],
                   descending: bool = False, buckets: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``sums`` within ``keys`` ordered by ``order``.

    ``df`` must hold at most one row per (keys, order) — compress with a
    ``groupBy`` first.  Rows are dealt into range partitions of (keys,
    order); per-bucket totals are small, their offsets come from a window
    over the bucket rows only, and the final running sum is a window
    partitioned by (keys, bucket), so no window sees a whole large key.
    """
    keys = list(keys)
    by = F.desc(order) if descending else F.asc(order)
    b = range_buckets(df, [*[F.asc(f"`{k}`") for k in keys], by], buckets)
    totals = b.groupBy(*keys, "_bucket").agg(*[F.sum(col(s)).alias(f"_t_{s}") for s in sums])
    # a window over the bucket rows only: at most #keys + #buckets rows in total
    wo = _win(keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_bucket",
                            *[F.coalesce(F.sum(f"_t_{s}").over(wo), F.lit(0)).alias(f"_o_{s}") for s in sums])
    joined = keyed_join(b, offsets, [*keys, "_bucket"])
    wl = Window.partitionBy(*keys, "_bucket").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(*df.columns,
                         *[(F.col(f"_o_{s}") + F.sum(col(s)).over(wl)).alias(f"{prefix}{s}") for s in sums])


def value_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(column, q): exact quantiles by linear interpolation, from the counts of
    distinct values: no task holds a column's values."""
    counts = melt(df, [], columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    cum = running_totals(counts, ["column"], "value", ["_n"])
    size = counts.groupBy("column").agg(F.sum("_n").alias("_total"))
    ranked = small_join(cum, size, on="column", known_rows=len(columns))
    first, last = F.col("cum__n") - F.col("_n"), F.col("cum__n") - 1   # zero-based places of a value
    place = [F.lit(float(p)) * (F.col("_total") - 1) for p in probs]
    at = lambda k: F.max(F.when((first <= k) & (k <= last), F.col("value")))
    picked = ranked.groupBy("column", "_total").agg(
        *[at(F.floor(x)).alias(f"_lo{i}") for i, x in enumerate(place)], *[at(F.ceil(x)).alias(f"_hi{i}") for i, x in enumerate(place)])
    q = [F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (x - F.floor(x)) for i, x in enumerate(place)]
    return picked.select("column", F.array(*q).alias("q"))


def _win(keys: Sequence[str]):
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def hash_key(key_cols: Sequence[str], seed: int | str) -> Column:
    """md5 over ``key1|key2|…|seed`` — the same text DuckDB's md5(concat_ws('|', …)) hashes."""
    return F.md5(F.concat_ws("|", *[col(c).cast("string") for c in key_cols], F.lit(str(seed))))


def hash_rank(df: DataFrame, key_cols: Sequence[str], seed: int | str = 42,
              strata: Sequence[str] = (), prefix_chars: int = 4,
              rank_col: str = "_rank", size_col: str = "_stratum_n") -> DataFrame:
    """Exact 1-based rank of every row by ``md5(key‖seed)`` within ``strata``.

    The keys must be unique.  Two passes: (1) histogram of the first
    ``prefix_chars`` hex digits per stratum (bounded: 16**prefix_chars rows
    per stratum) turned into offsets by ``running_totals``; (2) a window
    partitioned by (stratum, prefix) — about n / 16**prefix_chars rows each
    — numbers the rows, plus the offset.  Adds ``rank_col`` and the stratum
    size ``size_col``.
    """
    strata = list(strata)
    h = df.withColumn("_h", hash_key(key_cols, seed)).withColumn(
        "_p", F.conv(F.substring("_h", 1, prefix_chars), 16, 10).cast("long"))
    hist = h.groupBy(*strata, "_p").agg(F.count(F.lit(1)).alias("_c"))
    cum = running_totals(hist, strata, "_p", ["_c"])
    sizes = hist.groupBy(*strata).agg(F.sum("_c").alias(size_col))
    offs = cum.select(*strata, "_p", (F.col("cum__c") - F.col("_c")).alias("_off"))
    if strata:
        offs = keyed_join(offs, sizes, strata)
    else:
        # one number: the table size
        offs = offs.withColumn(size_col, F.lit(sizes.first()[size_col] or 0).cast("long"))
    # offsets: at most 16**prefix_chars rows per stratum
    joined = keyed_join(h, offs, [*strata, "_p"],
                        known_rows=16 ** prefix_chars if not strata else None)
    w = Window.partitionBy(*strata, "_p").orderBy("_h")
    return joined.withColumn(rank_col, F.col("_off") + F.row_number().over(w)).drop("_off", "_p")


def hash_cuts(df: DataFrame, key_cols: Sequence[str], wanted: Callable[[Column], Column], seed: int | str = 42,
              strata: Sequence[str] = (), prefix_chars: int = 4) -> DataFrame:
    """(strata…, _cut): the rows of a stratum of n rows whose ``hash_key`` is at
    most _cut are its first ``wanted(n)`` by ``hash_rank`` (none below '').

    No row is shuffled: counts of hash prefixes say which prefix holds the cut,
    and only the hashes of that prefix, one in 16**prefix_chars, are ordered.
    The keys must be unique.
    """
    strata = list(strata)
    h = df.select(*[col(c) for c in strata], hash_key(key_cols, seed).alias("_h")).withColumn("_p", F.substring("_h", 1, prefix_chars))
    cum = running_totals(h.groupBy(*strata, "_p").agg(F.count(F.lit(1)).alias("_c")), strata, "_p", ["_c"])
    sizes = cum.groupBy(*strata).agg(F.max("cum__c").alias("_n"))
    sized = keyed_join(cum, sizes, strata) if strata else cum.crossJoin(sizes)  # one row of sizes
    before = F.col("cum__c") - F.col("_c")
    holds = sized.withColumn("_k", wanted(F.col("_n")).cast("long")).where((before < F.col("_k")) & (F.col("_k") <= F.col("cum__c"))).select(
        *strata, "_p", (F.col("_k") - before).alias("_need")).checkpoint()
    n = holds.count()  # one row for each stratum
    inside = keyed_join(h, holds, [*strata, "_p"], known_rows=n)
    place = F.row_number().over(_win(strata).orderBy("_h"))
    found = inside.withColumn("_place", place).where(F.col("_place") == F.col("_need")).select(*strata, F.col("_h").alias("_cut"))
    if not strata:
        return found
    return keyed_join(sizes.select(*strata), found, strata, "left", known_rows=n).withColumn("_cut", F.coalesce("_cut", F.lit(""))).checkpoint()


def first_by_hash(df: DataFrame, key_cols: Sequence[str], wanted: Callable[[Column], Column], seed: int | str = 42,
                  strata: Sequence[str] = (), out: str = "_first") -> DataFrame:
    """``df`` plus ``out``: whether the row is among its stratum's first ``wanted(n)``
    by ``hash_rank``; a comparison with the stratum's cut, no exchange of rows."""
    cuts = hash_cuts(df, key_cols, wanted, seed, strata)
    own = hash_key(key_cols, seed)
    if not strata:
        row = cuts.first()
        return df.withColumn(out, own <= F.lit(row["_cut"] if row else ""))
    marked = keyed_join(df.withColumn("_own", own), cuts, list(strata), known_rows=cuts.count())
    return marked.withColumn(out, F.col("_own") <= F.col("_cut")).drop("_own", "_cut")
