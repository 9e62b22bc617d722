"""Fixtures of the training-data tests, imported by name."""

import random

import pytest
from pyspark.sql import functions as F

SF_CHECK = "/root/testdata/sf0.01"
SF_SMALL = "/root/testdata/sf0.001"

#: Names that operators use inside; as extra columns they must not matter.
CLASHING = ("sha", "_sha", "size", "key", "rank", "n", "rep", "taken", "score", "label", "content",
            "metadata", "kept", "group_size", "range", "ids", "words", "_row", "_id", "_part")


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def edge_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empty, blank, very long, tied and repeated rows."""
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(1, 90)) for _ in range(40)]
    rows = [(i, t, ("en", "de")[i % 2], f"src{i % 4}", len(t)) for i, t in enumerate(texts)]
    base = prose(rng, 120).split()
    for i in range(12):  # near copies: one word differs
        words = list(base)
        words[10 * i] = f"other{i}"
        rows.append((100 + i, " ".join(words), "en", "src0", None))
    rows += [(200, None, None, None, None), (201, "", "", "", 0), (202, " \n\t ", "en", "src1", 4),
             (203, "One two", "en", None, 7), (204, "one TWO", None, "src1", 7),
             (205, "Éa ÉA", "fr", "src2", 5), (206, "éa éa", "fr", "src2", 5),
             (207, "x" * 60_000, "en", "src0", 60_000), (208, prose(rng, 15_000), "en", "src0", None),
             (209, "a b c", "en", "src0", 5), (209, "a b c", "en", "src0", 5),
             (None, "no id at all", "en", "src3", 12), (210, "a  B c", "en", "src3", 6)]
    return rows


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def edge(spark):
    from chunkwise.llm.common import ship
    ship(spark)
    df = spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rng = random.Random(4)
    return spark.createDataFrame([(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 60)]
                                 + [(61, None, None), (None, 1, 1)],
                                 "doc_id bigint, quality int, toxic int")
