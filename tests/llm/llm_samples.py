import random

import pytest

LETTERS = {"en": "the of and to in is was that with from", "de": "der die und ist von mit auch nicht ein zu",
           "fr": "le la est une dans pour que les sur avec", "es": "el la que de en los por una con para"}


def words(rng, n, lang="en"):
    common = LETTERS[lang].split()
    tail = {"en": "thing", "de": "ung", "fr": "eaux", "es": "ción"}[lang]
    return " ".join(rng.choice(common) if rng.random() < 0.5 else
                    "".join(rng.choice("aeiounrst") for _ in range(rng.randint(2, 6))) + tail
                    for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, empty and long texts, ties, repeated rows and clashing columns."""
    rng = random.Random(5)
    base = [words(rng, n) for n in (3, 40, 60, 200, 400, 7, 1)]
    near = base[3].split()
    near[17] = "Changed"
    rows = [(i, t, "en", "s1", len(t)) for i, t in enumerate(base)]
    rows += [(20, " ".join(near), "en", "s2", 0), (21, base[3], "de", None, None), (22, None, None, "s1", None),
             (23, "", "en", "s3", 0), (24, " \n\t", "en", "s3", 3), (25, "x" * 50_000, "en", "s3", 50_000),
             (26, words(rng, 20_000), "en", "é", 1), (3, base[3], "en", "s1", len(base[3])),
             (3, base[3], "en", "s1", len(base[3])), (None, base[1], "en", "s1", 1), (None, None, None, None, None),
             (None, words(rng, 30), "en", "S", 1), (27, base[4].upper(), "fr", "s1", 5), (28, "é ü \U0001f600 ß", "de", "s2", 8)]
    return spark.createDataFrame(
        [r + (f"own {i}", i, "mine", i * 1.5, i) for i, r in enumerate(rows)],
        "doc_id long, text string, lang string, source string, n_chars long, "
        "shard string, size int, row string, score double, tid int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
