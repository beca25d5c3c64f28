import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def prose():
    """Texts with exact copies, near copies, shared passages, junk, nulls and a long one."""
    rng = random.Random(5)
    texts = [" ".join(words(rng, rng.randrange(1, 120), 4000)) for _ in range(60)]
    for _ in range(6):
        texts.append(texts[rng.randrange(20)])
    for i in range(12):  # near copies of one text
        w = texts[3].split()
        w[rng.randrange(len(w))] = f"edit{i}"
        texts.append(" ".join(w))
    passage = " ".join(words(rng, 60, 4000))
    texts += [f"{' '.join(words(rng, 30, 4000))} {passage} {' '.join(words(rng, 30, 4000))}" for _ in range(8)]
    texts += [None, "", " \n\t ", "one", "One ONE one", "a b c d", "a b c d", "x" * 300, "x" * 300, "é" * 260, "aab" * 400,
              " ".join(words(rng, 6000, 50)), "A\x00B " * 80]
    return texts


@pytest.fixture(scope="session")
def docs(spark, prose):
    rows = [(i * 3, t, "en", None if i % 11 == 0 else f"s{i % 4}", len(t or "")) for i, t in enumerate(prose)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """The same documents with columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ("id", "row", "key", "size", "base", "t", "point", "tie", "doc", "sub", "n", "host", "finish", "start", "Words", "m")
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
