import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "the of and thing onble reath stion worth anea inder house water over under light éau straße niño".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) * (rng.random() < 0.7) for _ in range(n))


def odd_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows,
    copies that differ in case, passages shared by many documents."""
    passage = prose(99, 45)
    texts = {
        1: prose(1, 80), 2: prose(1, 80).upper(), 3: prose(1, 80), 4: "", 5: None, 6: "  \t\n ", 7: "word",
        8: prose(8, 30) + "\n" + passage + " " + prose(9, 30), 9: passage, 10: prose(10, 25) + " " + passage,
        11: prose(11, 6000), 12: prose(12, 19), 13: prose(13, 20), 14: prose(13, 20) + " " + prose(13, 20),
        15: "É" + prose(1, 80), 16: prose(16, 300), 17: prose(16, 298) + " other end", 18: "😀 ünï\x00cödé 漢字 " * 40,
        19: "a " * 500, 20: "no-break and separators" * 5, 21: "A" * 5000, 22: "<|endoftext|> x",
    }
    rows = [(i, t, ["en", "de", None][i % 3], [f"src{i % 4}", None][i % 7 == 0], None if t is None else len(t)) for i, t in texts.items()]
    rows += [rows[0], rows[0]]                                   # repeated rows
    rows += [(None, prose(1, 80), "en", "src1", 3), (None, None, None, None, None), (None, "only null ids have this text", "en", "src0", 1)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")
