import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, bucket int, run int, kept boolean, digest string"


def frame(spark, rows):
    """A table of documents from (doc_id, text), with columns whose names clash with ones that operators use."""
    data = [(i, t, "en" if k % 3 else None, f"src{k % 2}" if k % 5 else None, None if t is None else len(t), "x", k, None, None, "y") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def texts(seed=1, n=40):
    """Random documents of few words, with copies, near copies and shared passages."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "beta", "Gamma", "delta,", "é", "漢字", "x1", "zeta."])
    passage = " ".join(word() for _ in range(60))
    out = []
    for i in range(n):
        kind = rng.random()
        words = [word() for _ in range(rng.randint(0, 120))]
        if kind < 0.2 and out:
            words = rng.choice(out)[1].split(" ")
            if words and kind < 0.15:
                words = list(words)
                words[rng.randrange(len(words))] = word()
        elif kind < 0.4:
            at = rng.randint(0, len(words))
            words[at:at] = passage.split(" ")
        out.append((i * 3 % 101, rng.choice([" ", " ", "\n"]).join(words)))
    return out


#: Nulls, empty texts, ties and repeated rows, other white space, one long text.
EDGES = [(None, "alpha beta " * 30), (None, None), (500, None), (501, ""), (502, " \t\n"), (503, "one"), (504, "one"), (504, "one"), (505, "a\x1cb\x85c\xa0d e"), (506, "Gamma delta, " * 3000), (507, "Gamma delta, " * 3000), (508, "na " * 400)]


@pytest.fixture(scope="session")
def rows():
    return texts() + EDGES


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "documents.parquet")
    frame(spark, rows).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, []).limit(0)


@pytest.fixture
def ws(spark):
    from flowloom.llm._common import Workspace

    return Workspace(spark, "test")
