"""Language ID: interpolated Kneser-Ney character models in sorted hash arrays.

``fit`` counts character n-grams of a bounded sample of labelled texts in
Spark, builds one interpolated Kneser-Ney model per language and keeps all of
them in shared arrays sorted by n-gram hash: one row of log probabilities (a
column per language) for each n-gram seen in any language, and one row of
back-off weights for each context.  ``identify`` scores whole texts: the
language with the lowest cross-entropy per character wins, and a text whose
cross-entropy lies far above what the calibration texts of that language show
is rejected.

Results for odd input: a null text, an empty one or one without any letter is
``und`` with score 0 and rejected; ties between languages go to the first by
name; repeated rows get equal results; an empty table gives an empty result;
with no labelled text every row is ``und``; very long texts are scored whole,
in slices that overlap by the context; input columns named like an output are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import code_points, hash_share, prepare, remainder, replace_columns, sample_share, table

ORDER = 4
#: bound of the fit: about so many characters of labelled text per language
CHARS_PER_LANGUAGE = 600_000
#: share of the sampled texts kept for calibration
CALIBRATION = 0.3
#: a text is rejected at so many calibrated deviations above its language's mean
REJECT_AT = 8.0
#: least variance of a language's long texts (nats squared): below it, mixed but real text would be rejected
SPREAD_FLOOR = 0.0225
#: texts that a language needs to be calibrated; with fewer, all its texts are fitted
LEAST_CALIBRATION = 8
SLICE = 200_000
#: the sample takes parts of so many characters, so that long documents are neither all in nor all out
PART = 20_000
UNKNOWN = "und"
#: size of the code space, for the uniform end of the interpolation
CODE_SPACE = 0x110000
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(CODE_SPACE)], dtype=bool)


class Grams:
    """Texts to arrays: lower-cased letters, one blank (32) for each run of other
    characters, 0 before each text."""

    def __init__(self):
        self.letter = _letters()

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols, index of each symbol's text, letters per text); each text begins with a 0."""
        low = [t.replace("\0", " ").lower() for t in texts]
        cp = code_points("\0" + "\0".join(low))
        is_letter = self.letter[cp]
        sym = np.where(is_letter, cp, np.where(cp == 0, 0, 32)).astype(np.uint32)
        keep = np.ones(len(sym), bool)
        keep[1:] = (sym[1:] != 32) | ((sym[:-1] != 32) & (sym[:-1] != 0))
        doc = np.cumsum(cp == 0) - 1
        letters = np.bincount(doc, weights=is_letter, minlength=len(texts)).astype(np.int64)
        return sym[keep], doc[keep], letters

    def contexts(self, sym: np.ndarray) -> list[np.ndarray]:
        """The symbols 0, 1, ... ORDER-1 places before each; 0 before a text's start."""
        starts = np.flatnonzero(sym == 0)
        dist = np.arange(len(sym)) - np.repeat(starts, np.diff(np.append(starts, len(sym))))
        out = [sym.astype(np.uint64)]
        for k in range(1, ORDER):
            back = np.zeros(len(sym), np.uint64)
            back[k:] = sym[:-k]
            back[dist < k] = 0
            out.append(back)
        return out


def gram_hash(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of n-grams given as [last symbol, the one before, ...]."""
    h = np.zeros(len(parts[0]), np.uint64)
    for p in reversed(parts):
        h = (h ^ (p + np.uint64(1))) * _MULT
        h ^= h >> np.uint64(29)
    return h


@dataclass
class Level:
    keys: np.ndarray       # sorted n-gram hashes
    logp: np.ndarray       # n-grams x languages
    ctx_keys: np.ndarray   # sorted context hashes
    backoff: np.ndarray    # contexts x languages: log of the weight of the lower order


@dataclass
class Model:
    languages: list[str]
    levels: list[Level]    # order 1 first
    floor: np.ndarray      # log probability of an unseen symbol, per language
    mean: np.ndarray       # calibration: cross-entropy per symbol,
    spread: np.ndarray     # its variance as spread[0] + spread[1] / symbols
    temperature: float
    threshold: float

    def log_probabilities(self, parts: list[np.ndarray], order: int | None = None) -> np.ndarray:
        """symbols x languages; n-grams unseen at one order go to the next lower."""
        order = len(self.levels) if order is None else order
        if order == 0:
            return np.repeat(self.floor[None, :], len(parts[0]), axis=0)
        level = self.levels[order - 1]
        h = gram_hash(parts[:order])
        at = np.searchsorted(level.keys, h)
        np.minimum(at, len(level.keys) - 1, out=at)
        out = level.logp[at]
        miss = np.flatnonzero(level.keys[at] != h)
        if len(miss):
            rest = [p[miss] for p in parts]
            lower = self.log_probabilities(rest, order - 1)
            if order > 1:
                c = gram_hash(rest[1:order])
                i = np.minimum(np.searchsorted(level.ctx_keys, c), len(level.ctx_keys) - 1)
                seen = level.ctx_keys[i] == c
                lower[seen] += level.backoff[i[seen]]
            out[miss] = lower
        return out


def _discount(counts: np.ndarray) -> float:
    one, two = (counts == 1).sum(), (counts == 2).sum()
    return float(min(0.95, max(0.1, one / (one + 2 * two)))) if one else 0.5


def kneser_ney(grams: pd.DataFrame, languages: list[str]) -> tuple[list[Level], np.ndarray]:
    """Levels from the counts of ORDER-grams (columns lang, s0 (last) .. , n)."""
    code = {l: i for i, l in enumerate(languages)}
    lang = grams["lang"].map(code).to_numpy()
    parts = [grams[f"s{k}"].to_numpy(np.uint64) for k in range(ORDER)]
    n = grams["n"].to_numpy(np.float64)
    per_order = []  # (lang, parts, counts): raw at the top, then numbers of left extensions
    for order in range(ORDER, 0, -1):
        per_order.append((lang, parts, n))
        if order > 1:
            frame = pd.DataFrame({"l": lang} | {f"s{k}": parts[k] for k in range(order - 1)})
            lower = frame.groupby(list(frame.columns), sort=False).size()
            idx = lower.index.to_frame(index=False)
            lang = idx["l"].to_numpy()
            parts = [idx[f"s{k}"].to_numpy(np.uint64) for k in range(order - 1)]
            n = lower.to_numpy(np.float64)
    levels: list[Level] = []
    size = len(languages)
    floor = np.log(np.full(size, 1.0 / CODE_SPACE))
    model = Model(languages, levels, floor, np.zeros(size), np.zeros((2, size)), 1.0, 0.0)
    for order, (lang, parts, n) in enumerate(reversed(per_order), start=1):
        h = gram_hash(parts)
        ctx = gram_hash(parts[1:]) if order > 1 else np.zeros(len(h), np.uint64)
        keys, first, inv = np.unique(h, return_index=True, return_inverse=True)
        ctx_keys, ctx_inv = np.unique(ctx, return_inverse=True)
        total, kinds = np.zeros((len(ctx_keys), size)), np.zeros((len(ctx_keys), size))
        np.add.at(total, (ctx_inv, lang), n)
        np.add.at(kinds, (ctx_inv, lang), 1.0)
        counts = np.zeros((len(keys), size))
        counts[inv, lang] = n
        d = np.array([_discount(n[lang == l]) for l in range(size)])
        with np.errstate(divide="ignore", invalid="ignore"):
            weight = np.where(total > 0, d[None, :] * kinds / total, 1.0)
            own = ctx_inv[first]
            lower = np.exp(model.log_probabilities([p[first] for p in parts], order - 1))
            direct = np.where(total[own] > 0, np.maximum(counts - d[None, :], 0) / total[own], 0.0)
        prob = direct + weight[own] * lower
        if order == 1:
            floor = np.log(weight[0] / CODE_SPACE) if len(weight) else floor
            model.floor = floor
        levels.append(Level(keys, np.log(prob).astype(np.float32), ctx_keys, np.log(weight).astype(np.float32)))
    return levels, model.floor


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tool = Grams()
    for frame in frames:
        for lang, own in frame.groupby("lang"):
            sym, _, _ = tool.symbols(own["text"].tolist())
            parts = [p[sym != 0].astype(np.int32) for p in tool.contexts(sym)]
            if len(parts[0]):
                rows = pd.DataFrame({f"s{k}": p for k, p in enumerate(parts)})
                out = rows.groupby(list(rows.columns), sort=False).size().rename("n").reset_index()
                yield out.assign(lang=lang)[["lang", *rows.columns, "n"]]


def entropies(model: Model, tool: Grams, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Summed negative log probability (texts x languages), symbols and letters of each text."""
    total = np.zeros((len(texts), len(model.languages)))
    symbols, letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)

    def score(batch: list[str], ids: list[int], skip: int) -> None:
        """skip: symbols at the start of the (only) text that are context alone."""
        sym, doc, let = tool.symbols(batch)
        real = sym != 0
        if skip:
            real[: 1 + len(tool.symbols([batch[0][:skip]])[0]) - 1] = False
            let = let - tool.symbols([batch[0][:skip]])[2]
        parts = [p[real] for p in tool.contexts(sym)]
        lp, doc = model.log_probabilities(parts), doc[real]
        rows = np.array(ids)
        for l in range(lp.shape[1]):
            total[rows, l] -= np.bincount(doc, weights=lp[:, l], minlength=len(batch))
        np.add.at(symbols, rows, np.bincount(doc, minlength=len(batch)))
        np.add.at(letters, rows, let)

    batch, ids, size = [], [], 0
    for i, t in enumerate(texts):
        if len(t) > SLICE:  # whole, in slices that carry their context along
            for b in range(0, len(t), SLICE):
                lead = max(0, b - 64)
                score([t[lead:b + SLICE]], [i], b - lead)
            continue
        if size + len(t) > SLICE and batch:
            score(batch, ids, 0)
            batch, ids, size = [], [], 0
        batch.append(t)
        ids.append(i)
        size += len(t)
    if batch:
        score(batch, ids, 0)
    return total, symbols, letters


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        chars: int = CHARS_PER_LANGUAGE) -> Model | None:
    """Models from a sample of about ``chars`` characters for each language (all its
    texts where it has fewer); every labelled language gets a model; rows with a null or empty text or a null language are not used."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(key).alias("key"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0))
    count = F.ceil(F.length("text") / F.lit(PART)).cast("int")
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), count - 1))).select(
        "lang", "key", "part", F.expr(f"substring(text, part * {PART} + 1, {PART})").alias("text"))
    rows = rows.withColumn("u", hash_share("key", "part", "text", seed="langid"))
    totals = {r["lang"]: r for r in rows.groupBy("lang").agg(F.sum(F.length("text")).alias("c"), F.min("u").alias("least")).collect()}
    if not totals:
        return None
    share = F.lit(0.0)
    for l, r in sorted(totals.items()):  # of each language one part at least
        share = F.when(F.col("lang") == l, max(sample_share(r["c"], int(chars / (1 - CALIBRATION))), r["least"])).otherwise(share)
    sample = rows.where(F.col("u") <= share).withColumn("v", hash_share("key", "part", "text", seed="langcal")).drop("u", "part")
    sample = sample.repartition(max(1, len(totals)), hash_share("key", "text", seed="spread")).checkpoint()
    # a text is for calibration only where its language has enough of them, and another text to fit
    known = sample.groupBy("lang").agg(F.sum((F.col("v") < CALIBRATION).cast("int")).alias("n"), F.max("v").alias("most")).collect()
    cal = F.lit(False)
    for r in known:
        if r["n"] >= LEAST_CALIBRATION:
            cal = cal | ((F.col("lang") == r["lang"]) & (F.col("v") < min(CALIBRATION, r["most"])))
    sample = sample.withColumn("cal", cal)
    schema = "lang string, " + ", ".join(f"s{k} int" for k in range(ORDER)) + ", n long"
    grams = (sample.where(~F.col("cal")).select("lang", "text").mapInPandas(_counted, schema)
             .groupBy("lang", *[f"s{k}" for k in range(ORDER)]).agg(F.sum("n").alias("n")).toPandas())
    if not len(grams):
        return None
    languages = sorted(grams["lang"].unique())
    # a fixed order of rows makes the arrays the same in every run
    grams = grams.sort_values(["lang", *[f"s{k}" for k in range(ORDER)]]).reset_index(drop=True)
    levels, floor = kneser_ney(grams, languages)
    size = len(languages)
    model = Model(languages, levels, floor, np.full(size, 2.5), np.array([[SPREAD_FLOOR] * size, [1.0] * size]), 1.0, REJECT_AT)
    return _calibrated(model, sample)


def _calibrated(model: Model, sample: DataFrame) -> Model:
    """Mean and spread of each language's cross-entropy on its calibration
    texts, and the temperature of the posterior."""
    names = [f"h{i}" for i in range(len(model.languages))]
    shipped = sample.sparkSession.sparkContext.broadcast(model)

    def scored(frames):
        tool = Grams()
        for f in frames:
            h, n, _ = entropies(shipped.value, tool, f["text"].tolist())
            yield pd.DataFrame({"lang": f["lang"], "n": n} | {c: h[:, i] for i, c in enumerate(names)})

    schema = "lang string, n long, " + ", ".join(f"{c} double" for c in names)
    cal = sample.where("cal").select("lang", "text").mapInPandas(scored, schema).toPandas()
    cal = cal[(cal["n"] >= 20) & cal["lang"].isin(model.languages)].sort_values(["lang", "n", *names])
    if not len(cal):
        return model
    total, n = cal[names].to_numpy(), cal["n"].to_numpy(np.float64)
    own = cal["lang"].map({l: i for i, l in enumerate(model.languages)}).to_numpy()
    for l in range(len(model.languages)):
        at = own == l
        if at.sum() >= LEAST_CALIBRATION:
            h = total[at, l] / n[at]
            model.mean[l] = np.median(h)
            dev = (h - model.mean[l]) ** 2
            # the spread's two parts from long and short texts, robustly
            model.spread[1, l] = max(0.25, np.median(dev * n[at]) / 0.45)
            model.spread[0, l] = max(SPREAD_FLOOR, np.quantile(dev, 0.9) / 2.7)
    best, best_t = np.inf, 1.0
    for t in np.geomspace(0.02, 1.0, 12):
        z = -total / n[:, None] ** 0.5 * t
        z -= z.max(axis=1, keepdims=True)
        loss = float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), own]))
        if loss < best - 1e-6:
            best, best_t = loss, float(t)
    model.temperature = best_t
    return model


def _result(model: Model | None, tool: Grams, texts: pd.Series) -> pd.DataFrame:
    filled = [t if isinstance(t, str) else "" for t in texts]
    size = len(filled)
    if model is None:
        return pd.DataFrame({"lang_pred": [UNKNOWN] * size, "score": 0.0, "cross_entropy": np.nan, "rejected": True})
    total, n, letters = entropies(model, tool, filled)
    per = total / np.maximum(n, 1)[:, None]
    best = per.argmin(axis=1)
    low = per[np.arange(size), best]
    z = -total / np.sqrt(np.maximum(n, 1))[:, None] * model.temperature
    z -= z.max(axis=1, keepdims=True)
    post = np.exp(z)
    post = post[np.arange(size), best] / post.sum(axis=1)
    dev = (low - model.mean[best]) / np.sqrt(model.spread[0, best] + model.spread[1, best] / np.maximum(n, 1))
    none = letters == 0
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    return pd.DataFrame({"lang_pred": names[np.where(none, len(model.languages), best)],
                         "score": np.where(none, 0.0, post), "cross_entropy": np.where(none, np.nan, low),
                         "rejected": none | (dev > model.threshold)})


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` plus lang_pred, score, cross_entropy (nats per symbol) and rejected."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, cross_entropy double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tool = Grams()
        for texts in batches:
            yield _result(shipped.value, tool, texts)

    return replace_columns(docs, predict(F.col(f"`{text}`")), "lang_pred", "score", "cross_entropy", "rejected")


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(remainder("doc_id", 5) != 0)


def held_out() -> Column:
    return F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = fit(training_rows(docs))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(), "lang_pred", "score", "cross_entropy", "rejected")
