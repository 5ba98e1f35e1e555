import os
import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF


#: Columns that clash with names the operators use themselves.
CLASH = "doc_id long, text string, node string, cluster string, n int, h int, kept boolean, rank_id int, unit int, score string, entry int"


def clashing(rows):
    return [(i, t, "x", "y", 1, 2, True, 3, 4, "s", 5) for i, t in rows]


@pytest.fixture
def make(spark):
    """Documents with clashing extra columns, in several partitions."""
    return lambda rows: spark.createDataFrame(clashing(rows), CLASH).repartition(3)


def corpus(seed=1, n=60):
    """Texts with exact and near copies, shared lines, nulls, empty and odd ones; ids in no order, one row twice."""
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "and", *("".join(rnd.choice("abcdéßio") for _ in range(rnd.randint(2, 7))) for _ in range(400))]
    sentence = lambda: " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(3, 14))).capitalize() + rnd.choice(".!?")
    lines = [" ".join(sentence() for _ in range(rnd.randint(1, 3))) for _ in range(8)]
    texts = []
    for _ in range(n):
        k = rnd.random()
        if texts and k < 0.15:
            texts.append(rnd.choice(texts))
        elif texts and k < 0.4:
            w = rnd.choice(texts).split(" ")
            for _ in range(rnd.randint(1, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            texts.append(" ".join(w))
        else:
            own = [" ".join(sentence() for _ in range(rnd.randint(1, 6))) for _ in range(rnd.randint(1, 5))]
            own.insert(rnd.randint(0, len(own)), rnd.choice(lines))
            texts.append("\n".join(own))
    texts += [None, "", "   \n", "one", "Two words", "three short words", "!!! ... ???", "same same same same same same same same"]
    ids = rnd.sample(range(1000), len(texts))
    rows = list(zip(ids, texts, strict=True))
    return [*rows, rows[5], (None, "a row without an id that still has some words"), (rows[7][0], "another text with a known id")]
