import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
STEMS = {"en": "the and ing tion er with that for ouble", "de": "der und ung heit ein schaft über für lich",
         "fr": "le des tion eux ment que été pour aux", "es": "el los ción mente que año para ando"}


def sentence(rng, lang, words):
    stems = STEMS[lang].split()
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(words)).capitalize() + "."


def corpus(n=120, seed=3):
    """Texts of several lines in four languages."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(STEMS))
        text = "\n".join(sentence(rng, lang, rng.randint(12, 40)) for _ in range(rng.randint(2, 5)))
        rows.append((i, text, lang, f"src{i % 3}", len(text)))
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).checkpoint()


@pytest.fixture(scope="session")
def odd_rows(rows):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows and texts."""
    long = " ".join(r[1] for r in rows) * 6
    return [(None, rows[0][1], None, None, None), (200, None, "en", "src0", 0), (201, "", "de", None, None), (202, " \n\t ", None, "src1", 4),
            (203, "1234 !!", "en", "src1", 7), (204, long, "en", "src1", len(long)), (205, "one two", "en", "src2", 7),
            (206, rows[5][1], "fr", "src2", 9), (206, rows[5][1], "fr", "src2", 9), (206, "other text under one id", "fr", "src2", 9),
            (207, "\x1c odd \x85breaks\x00", "es", "src2", 9)]


@pytest.fixture(scope="session")
def odd(spark, rows, odd_rows):
    """The corpus and the odd rows, with extra columns whose names clash with outputs."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows + odd_rows, DOCS)
    for c in ("score", "lang_pred", "predicted", "rejected", "copies", "rate", "domain", "n_tokens", "node", "key", "rid", "id"):
        df = df.withColumn(c, F.lit("clash"))
    return df.checkpoint()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
