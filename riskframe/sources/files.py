"""Scans and sinks.

Tables are read and written as directories of files (parquet by default,
CSV for the reference's interchange), never coalesced to one file; reports
are appended as JSON rows partitioned by run date; models are Spark ML
``PipelineModel`` directories found through the Hadoop file system API, so
every path may live on a shared cluster store.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.core import nan_to_null

# names of summary tables are cut like spreadsheet sheet names
SHEET_NAME_LIMIT = 31


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A1: header CSV; explicit schema when known, else inferred; empty -> null; NaN -> null."""
    r = spark.read.option("header", True).option("nullValue", "").option("nanValue", "NaN")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return nan_to_null(r.csv(path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A2: dispatch on suffix: .csv or .parquet; anything else is an error."""
    p = path.rstrip("/").lower()
    if p.endswith(".csv"):
        return read_csv(spark, path)
    if p.endswith(".parquet"):
        return nan_to_null(spark.read.parquet(path))
    raise ValueError(f"unsupported file type: {path}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """A3: overwrite a table directory (header CSV or parquet), all partitions in parallel."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_json_report(report: DataFrame, path: str, run_ts: _dt.datetime | None = None) -> None:
    """A4: append the report rows as JSON, partitioned by run date, stamped with the run time."""
    ts = (run_ts or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y-%m-%d %H:%M:%S")
    (report.withColumn("run_ts", F.lit(ts)).withColumn("run_date", F.lit(ts[:10]))
           .write.mode("append").partitionBy("run_date").json(path))


def write_summaries(summaries: dict[str, DataFrame], path: str, fmt: str = "parquet") -> list[str]:
    """A5: one table directory per summary, named like a sheet (first 31 characters)."""
    names = []
    for name, df in summaries.items():
        n = name[:SHEET_NAME_LIMIT]
        if n in names:
            raise ValueError(f"two summaries are named {n!r} in their first {SHEET_NAME_LIMIT} characters")
        write_table(df, f"{path.rstrip('/')}/{n}", fmt)
        names.append(n)
    return names


def with_feature_info(df: DataFrame, descriptions: dict[str, str], target: str) -> DataFrame:
    """Attach feature descriptions / the target name as column metadata
    (kept by parquet), instead of a side file."""
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={"description": descriptions.get(c, ""),
                                                          "role": "target" if c == target else "feature"})
                       for c in df.columns])


def feature_info(df: DataFrame) -> dict:
    """A6 read back: {column: metadata}."""
    return {f.name: dict(f.metadata) for f in df.schema.fields}


# --------------------------------------------------------------------------- A7 / A8

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def model_dir_name(name: str) -> str:
    return "_".join(name.strip().lower().split())


def save_models(models: dict[str, PipelineModel], path: str) -> list[str]:
    """Save each fitted model under its lower_snake name (errored ones are absent)."""
    saved = []
    for name, m in models.items():
        if m is None:
            continue
        d = model_dir_name(name)
        m.write().overwrite().save(f"{path.rstrip('/')}/{d}")
        saved.append(d)
    return saved


def load_models(spark: SparkSession, path: str) -> dict[str, PipelineModel]:
    """Load every model directory, skipping scaler / preprocessor / feature ones."""
    out = {}
    for d in list_dirs(spark, path):
        if any(s in d.lower() for s in ("scaler", "preprocessor", "feature")):
            continue
        out[d] = PipelineModel.load(f"{path.rstrip('/')}/{d}")
    return out


def pick_model(spark: SparkSession, path: str) -> str | None:
    """best_tuned → best → any catboost/boosted → any non-scaler directory."""
    dirs = [d for d in list_dirs(spark, path) if "scaler" not in d.lower()]
    for want in ("best_tuned", "best", "catboost", "gradient_boosting"):
        # "best" is a whole word of the name; the others name a kind of model
        hit = [d for d in dirs if (want in re.split("[_-]", d.lower()) if want == "best" else want in d.lower())]
        if hit:
            return f"{path.rstrip('/')}/{hit[0]}"
    return f"{path.rstrip('/')}/{dirs[0]}" if dirs else None

