import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "x", "yz"]) for _ in range(n))


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id long, n_words string, kept string, class_id string, score string, a string, key string"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rows = [(i, prose(i, 60), "en" if i % 3 else "de", f"s{i % 2}") for i in range(60)]
    rows += [
        (100, None, "en", "s0"), (101, "", "en", "s0"), (102, " \n\t ", None, None), (None, prose(3, 60), "en", "s1"),
        (None, None, None, None), (103, prose(1, 30000), "en", "s0"), (104, "x" * 150_000, "en", "s0"),
        (105, "### *** %%% " * 40, "en", "s1"), (106, "same same " * 60, "en", "s0"), (107, prose(7, 60), "en", "s0"),
        (7, prose(7, 60), "en", "s1"), (7, prose(7, 60), "en", "s1"), (108, "été   naïve 漢字 " * 30, "fr", "s0"),
    ]
    return [(i, t, g, s, None if t is None else len(t), 1, "w", "k", "c", "s", "a", "z") for i, t, g, s in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(odd_rows, COLUMNS).repartition(3, "text").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(odd):
    """The table without rows."""
    return odd.where("false")
