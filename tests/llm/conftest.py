"""Documents with every awkward case, and the whole smallest table."""

import random

import pytest

SF = "/root/testdata/sf0.001"
#: Extra columns named like those that operators use inside or return.
CLASHING = ["_lf_id", "_lf_hash", "_lf_row", "fp", "part", "edits", "digest", "marks", "n_words", "kept", "g", "ids"]


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def awkward_rows():
    """(doc_id, text, lang, source): nulls anywhere, empty and very long texts,
    ties, repeated rows, equal ids with different texts."""
    rng = random.Random(4)
    base = [prose(rng, 120) for _ in range(12)]
    rows = [(k, t, ["en", "de", None][k % 3], ["s1", "s2", None][k % 3 - 1]) for k, t in enumerate(base)]
    rows += [(20, base[0], "en", "s1"), (21, base[0].replace(" ", "  "), "en", "s1"),      # equal but for spaces
             (20, base[0], "en", "s1"), (20, base[0], "en", "s1"),                        # repeated rows
             (22, base[1] + " tail", "de", None), (22, "another text under the same id " * 20, "de", "s2"),
             (None, base[2], "en", "s1"), (None, None, None, None), (30, None, "en", "s1"), (31, "", "en", "s1"),
             (32, " \t\n", None, "s2"), (33, "one", "en", "s1"), (34, "Ä ß 日本  x", "de", "s2"),
             (35, "x" * 200_000, "en", "s1"), (36, prose(rng, 30_000), "en", "s2"),
             (37, "de " * 400, "en", "s1"), (38, prose(rng, 60) + " " + base[3] + " " + prose(rng, 40), "en", "s1"),
             (39, "<|endoftext|> a  b\r\n<|end", "en", "s1")]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(awkward_rows(), "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.fixture(scope="session")
def no_rows(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
