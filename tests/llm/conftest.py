import random

import pytest


def make_documents():
    """Copies, near copies, shared lines and passages, nulls, empty and long texts, repeated rows, several languages."""
    r = random.Random(7)
    vocabulary = ["".join(r.choice("abcdefghijklmnoprstuv") for _ in range(r.randint(2, 8))) for _ in range(400)]
    words = lambda n: [r.choice(vocabulary) for _ in range(n)]
    passage = " ".join(words(60))
    base = words(120)
    rows = []
    for i in range(60):
        w = words(r.randint(5, 150))
        if i % 6 == 0:
            w[3:3] = passage.split()
        text = " ".join(w)
        if i % 4 == 0:
            text += "\nA common closing line, Ltd.\n" + text[:40]
        rows.append((i, text, ["en", "de", None][i % 3], f"s{i % 4}"))
    for i in range(60, 75):  # near copies of one text
        w = list(base)
        for _ in range(i % 4):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((i, " ".join(w), "en", "s0"))
    rows += [(i, rows[5][1], "en", "s1") for i in range(75, 80)]  # copies
    rows += [
        (80, None, "en", None), (81, "", None, "s1"), (82, " \n\t\n", "en", "s1"), (83, "one", "en", "s1"), (84, "ab ab ab ab ab ab " * 400, "en", "s1"),
        (85, "Über çé ñ \U0001f600 日本 " * 30, "fr", "s2"), (86, " a common closing line, ltd. \nB", "de", "s2"), (None, rows[7][1], "en", "s3"), (87, " ".join(words(3000)), "en", "s0"),
        (5, rows[5][1], "en", "s1"),
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The documents with columns whose names operators might use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    from pyspark.sql import functions as F

    extra = {c: F.lit(1) for c in ("block", "shard", "h1", "words", "comp", "row_hash", "n", "kept", "label", "key", "seed")}
    return df.withColumns(extra).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")
