import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choice(["ba", "ko", "re", "ti", "lu", "sha", "nd"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows (id, text, lang, source, n_chars) with nulls, empty, long, equal and nearly equal texts."""
    rng = random.Random(3)
    rows = [(None, None, None, None, None), (1, "", "en", "s1", 0), (2, None, "en", None, None), (3, "one two", "en", "s1", 7),
            (4, " \n\t ", None, "s2", 4), (None, prose(rng, 80), "en", "s2", 9), (None, prose(rng, 70), "en", "s2", 9)]
    for i in range(10, 60):
        rows.append((i, "\n".join(prose(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 5))), "de", f"s{i % 4}", 1))
    base = prose(rng, 150).split()
    for i in range(60, 90):  # near copies of one text
        w = list(base)
        for j in range(i % 4):
            w[(j * 37 + i) % 150] = "changed"
        rows.append((i, " ".join(w), "en", "s0", 1))
    rows += [(90, rows[10][1], "en", "s3", 1), rows[12], rows[12], (91, " ".join(base), "en", "s0", 1)]  # copies, and repeated rows
    rows.append((92, prose(rng, 60_000), "en", "s1", 1))
    rows.append((93, "word " * 3_000, "en", "s1", 1))
    rows.append((94, "x" * 100_000, "en", "s1", 1))
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3, "doc_id", "lang")


@pytest.fixture(scope="session")
def clashing(docs):
    """The same with columns named like those that operators make."""
    names = ["row", "host", "n_words", "size", "batch", "version", "line_no", "class", "__text", "__row", "__id", "kept", "target", "id"]
    return docs.withColumns({n: F.lit(None).cast("string") for n in names})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
