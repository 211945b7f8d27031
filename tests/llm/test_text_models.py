"""Language ID, quality classifier and mixing."""

import math

import numpy as np
import pytest

from riskframe.llm import language, mixing, quality


@pytest.fixture(scope="module")
def model(docs):
    return language.fit(docs)


def test_languages_are_told_apart(docs, model):
    got = language.identify(docs, model).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)
    assert not any(r.rejected for r in got)


def test_kneser_ney_probabilities_sum_to_one(model):
    """Over all symbols after a context, by brute force over the models' alphabet and the unseen rest."""
    symbols = sorted({c for t in ("the and über ción été ando lich" + "abcdefghijklmnopqrstuvwxyzäöüßéèêçñóíáúàô") for c in t if c.isalpha()} | {" "})
    codes = np.array([ord(c) for c in symbols], np.uint64)
    for ctx in ("the", " un", "zzq"):
        back = [np.full(len(codes), ord(c), np.uint64) for c in reversed(ctx)]
        p = np.exp(model.log_probabilities([codes, *back])).sum(axis=0)
        unseen = np.exp(model.log_probabilities([np.array([0x4E00], np.uint64), *[b[:1] for b in back]]))[0]
        total = p + unseen * (language.CODE_SPACE - len(codes))
        assert np.allclose(total, 1.0, atol=0.02), (ctx, total)


def test_odd_texts(odd, model):
    got = language.identify(odd, model)
    assert got.columns.count("score") == 1 and got.count() == odd.count()
    by = {r.doc_id: r for r in got.collect()}
    for k in (200, 201, 202, 203):
        assert (by[k].lang_pred, by[k].score, by[k].rejected) == ("und", 0.0, True)
    assert by[204].lang_pred in language_names(model) and 0 <= by[204].score <= 1


def language_names(model):
    return set(model.languages)


def test_slices_change_nothing(model, rows):
    text = " ".join(r[1] for r in rows[:40])
    whole = language.entropies(model, language.Grams(), [text])
    before = language.SLICE
    try:
        language.SLICE = 1000
        parts = language.entropies(model, language.Grams(), [text])
    finally:
        language.SLICE = before
    assert math.isclose(whole[0].min(), parts[0].min(), rel_tol=2e-3) and whole[2][0] == parts[2][0]


def test_text_in_no_known_language_is_rejected(spark, model):
    text = "Съешь же ещё этих мягких французских булок да выпей чаю " * 5
    got = language.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert got.rejected


def test_nothing_to_learn_from(none, docs):
    assert language.fit(none) is None
    got = language.identify(docs, None)
    assert {r.lang_pred for r in got.select("lang_pred").collect()} == {"und"}
    assert language.identify(none, None).count() == 0


def test_rare_languages_get_models(spark, rows):
    """Languages of one or two documents, and one of long documents under a small bound."""
    data = [(i, r[1], r[2]) for i, r in enumerate(rows)]
    data += [(1000 + i, f"{chr(0x430 + i)}{chr(0x431 + i)} " * 30, f"one{i}") for i in range(12)]
    data += [(2000 + i, f"{chr(0x3b1 + i // 2)}{chr(0x3b2 + i // 2)} " * 30, f"two{i // 2}") for i in range(12)]
    data += [(3000 + i, "ชซ " * 60_000, "long") for i in range(3)]
    model = language.fit(spark.createDataFrame(data, "doc_id long, text string, lang string"), chars=20_000)
    assert set(model.languages) == {r[2] for r in data}


@pytest.fixture(scope="module")
def graded(spark, rows):
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in r[1].split()), r[2], r[3], r[4]) for i, r in enumerate(rows)]
    docs = spark.createDataFrame(rows + bad, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows] + [(r[0], 0, 0) for r in bad] + [(None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


def test_quality_is_learned(graded):
    docs, labels = graded
    machine = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    got = {r.doc_id: r for r in quality.score(docs, machine).where("doc_id % 2 = 1").collect()}
    assert all(r.predicted == (1 if k < 1000 else 0) for k, r in got.items())


def test_machine_equals_all_pairs():
    """The sum-of-squares identity against the sum over all pairs."""
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=quality.SIZE).astype(np.float32), rng.normal(size=(quality.SIZE, quality.FACTORS)).astype(np.float32))
    idx, val = np.array([3, 77, 4000, 9]), np.array([0.5, 1.5, 0.25, 2.0], np.float32)
    want = 0.3 + float((m.weights[idx] * val).sum())
    for i in range(4):
        for j in range(i):
            want += float(m.factors[idx[i]] @ m.factors[idx[j]]) * float(val[i] * val[j])
    assert math.isclose(m.raw(idx, val, np.array([0]))[0], want, rel_tol=1e-4)


def test_quality_of_odd_texts(odd, none, graded):
    machine = quality.fit(*graded)
    got = quality.score(odd, machine).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    same = [r.score for r in got if r.doc_id == 206]
    assert same[0] == same[1] or same[0] == same[2] or same[1] == same[2]
    assert quality.score(none, machine).count() == 0
    assert quality.fit(none, graded[1]) is None
    assert {r.score for r in quality.score(odd, None).collect()} == {0.5}


def test_mixing_meets_its_targets(docs):
    want = {"en": 1.0, "de": 3.0, "fr": 2.0, "es": 0.5}
    got = mixing.mix(docs, mixing.labelled_by_language(docs), want, total=50_000.0).toPandas()
    domains, weights = mixing.fit(mixing.labelled_by_language(docs))
    known = mixing.posteriors(docs, domains, weights)
    steps = mixing.solve(known, [50_000.0 * want[d] / 6.5 for d in domains])
    have = mixing.totals(known, len(domains), steps)
    assert np.allclose(have, [50_000.0 * want[d] / 6.5 for d in domains], atol=0.002 * 50_000)
    assert (got["rate"] >= 0).all() and (got["domain"] == got["lang"]).mean() > 0.95
    assert (abs(got["copies"] - got["rate"]) <= 1).all()


def test_rates_equal_a_brute_force_projection(spark):
    """rate_of and solve against projected gradient in numpy, on given posteriors."""
    rng = np.random.default_rng(2)
    p, n = rng.dirichlet([0.3, 0.3, 0.3], 200), rng.integers(1, 400, 200)
    target, r = np.array([9000.0, 2000.0, 500.0]), np.ones(200)
    scale = (n[:, None] * p).sum(0)
    known = spark.createDataFrame([(1, int(w), *map(float, q)) for w, q in zip(n, p)], "rows long, tokens long, p0 double, p1 double, p2 double")
    steps = mixing.solve(known, list(target), most=12)
    for _ in range(len(steps)):
        r = np.maximum(0, r - p @ ((((n * r)[:, None] * p).sum(0) - target) / scale))
    assert np.allclose(mixing.totals(known, 3, steps), ((n * r)[:, None] * p).sum(0))


def test_mixing_odd_rows(odd, none):
    got = mixing.mix(odd, mixing.labelled_by_language(odd)).collect()
    assert len(got) == odd.count()
    for r in got:
        if r.doc_id in (200, 201, 202):
            assert (r.domain, r.tokens, r.rate, r.copies) == (None, 0, 1.0, 1)
    assert mixing.mix(none, mixing.labelled_by_language(none)).count() == 0
    assert mixing.mix(none, mixing.labelled_by_language(odd)).count() == 0
    plain = mixing.mix(odd, mixing.labelled_by_language(none))
    assert {r.rate for r in plain.select("rate").collect()} == {1.0}
    assert mixing.repeated(plain, odd.columns).count() == odd.count()


def test_flattened_targets_never_thin():
    own = [700.0, 100.0, 0.0, 50.0]
    got = mixing.flattened_targets(own)
    assert all(t >= a for t, a in zip(got, own)) and got[2] == 0


def test_rare_domains_are_fitted(spark):
    data = [(f"plain words number {i}", "much") for i in range(3000)] + [(f"rare text {i}", "rare") for i in range(2)] + [(" ", "blank")]
    labelled = spark.createDataFrame(data, "text string, domain string")
    assert mixing.fit(labelled, max_rows=20)[0] == ["much", "rare"]
    docs = spark.createDataFrame([(1, "rare text")], "doc_id long, text string")
    with pytest.raises(ValueError, match="blank"):
        mixing.mix(docs, labelled, {"rare": 1.0, "blank": 1.0})
