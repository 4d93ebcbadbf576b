import pytest

SCHEMA = "doc_id long, text string, lang string, key string, n_words string, score string, bucket int, hits string, name string"
WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo".split()


def sentence(seed: int, n: int) -> str:
    """Words that differ from seed to seed."""
    return " ".join(f"{WORDS[(seed * 7 + i * i * 3 + i) % len(WORDS)]}{(seed * 31 + i * 17) % 97}" for i in range(n))


def row(key, text, lang="en"):
    return (key, text, lang, "k", "w", "s", 1, "h", "n")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows and keys, near and exact copies."""
    base, other = sentence(1, 80), sentence(2, 60)
    return [
        row(1, base),
        row(2, base),
        row(3, base.replace("alpha", "ALPHA") + " tail"),
        row(4, other + "\n" + base[:200]),
        row(5, None),
        row(6, ""),
        row(7, " \n\t "),
        row(8, "one two"),
        row(9, "one two"),
        row(9, "one two"),
        row(10, sentence(3, 40_000)),
        row(11, "ééé ß ñandú 中文 Ω <|endoftext|> it's 'LL 12 3 x\u0085y", None),
        row(12, "!!!! ???? 1234 ####", "en"),
        row(13, sentence(3, 300)),
        row(None, base),
        row(None, None, None),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """A table with more columns, some of which have names that operators use themselves."""
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
