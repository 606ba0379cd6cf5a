import random

import pytest

SCHEMA = "score string, doc_id long, text string, label int, n_shingles string"


@pytest.fixture(scope="session")
def texts() -> dict[int, str | None]:
    """Copies, near copies, shared passages, odd texts."""
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdeinrst", k=draw.randint(2, 7))) for _ in range(400)]

    def prose(n: int) -> str:
        return " ".join(draw.choices(words, k=n))

    passage = prose(60)
    base = prose(200)
    edited = base.split()
    edited[50] = "changed"
    half = base.split()[:150] + prose(60).split()
    out: dict[int, str | None] = {
        1: base,
        2: base,
        3: " ".join(edited),
        4: " ".join(half),
        5: f"{prose(30)}. {passage}. {prose(30)}",
        6: f"{prose(40)}; {passage}",
        7: passage,
        8: None,
        9: "",
        10: " \n\t ",
        11: "one two",
        12: "One TWO",
        13: "ünïcode ünïcode\nünïcode ünïcode\n\nünïcode ünïcode",
        14: "same words " * 200,
        15: "a" * 5000,
        16: f"{prose(3000)}",
        17: base.upper(),
        18: "line one of this text\n" * 30 + prose(40),
    }
    for k in range(19, 60):
        out[k] = prose(draw.randint(4, 90))
    for k in range(60, 70):  # a family of near copies
        own = base.split()
        for _ in range(k % 5):
            own[draw.randrange(len(own))] = f"w{k}"
        out[k] = " ".join(own)
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with columns whose names the operators use themselves."""
    rows = [("x", i, t, i % 2, None) for i, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Repeated rows, an id with two texts, missing ids."""
    long = " ".join(f"word{k}" for k in range(40))
    other = " ".join(f"other{k}" for k in range(40))
    rows = [
        ("x", 1, long, None, None),
        ("x", 1, long, None, None),
        ("x", 2, long, 1, "7"),
        ("x", 3, other, 0, "7"),
        ("x", 3, long, 0, "7"),
        ("x", None, long, 0, "7"),
        ("x", None, None, 0, None),
        ("x", 4, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)
