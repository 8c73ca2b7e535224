from __future__ import annotations

import random

import pytest

from creditweave.llm.common import ship_code

DOCS = "doc_id long, text string, lang string, key long, tag string, score double, node string, kept string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_code(spark)


def made_texts(seed: int = 1, n: int = 60) -> list[str | None]:
    """Texts with exact and near copies, shared passages, odd white space, blanks, nulls and one long text."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abdeinorst", k=rng.randint(1, 7))) for _ in range(400)]
    passage = " ".join(rng.choices(words, k=60))
    texts: list[str | None] = []
    for k in range(n):
        kind = k % 10
        body = rng.choices(words, k=rng.randint(1, 120))
        if kind == 3 and texts[k - 1]:
            texts.append(texts[k - 1])
        elif kind == 4 and texts[k - 2]:
            near = texts[k - 2].split(" ")
            near[rng.randrange(len(near))] = "Changed"
            texts.append(" ".join(near))
        elif kind == 5:
            texts.append(" ".join(body[:20]) + "\n" + passage + "\t" + " ".join(body[20:40]))
        elif kind == 6:
            texts.append([None, "", " \n\t ", "One two", "naïve é ü 漢字 🙂 \x1c x", "In. " * 300][k // 10 % 6])
        else:
            texts.append("  ".join(body).replace("a b", "A B"))
    texts.append(" ".join(rng.choices(words, k=30_000)))
    return texts


@pytest.fixture(scope="session")
def corpus():
    """``(doc_id, text)`` with a null id, a repeated row and ids out of order."""
    texts = made_texts()
    rows = [(len(texts) - k, t) for k, t in enumerate(texts)]
    return [*rows, rows[2], (None, texts[0]), (None, "only here: " + "xyz " * 40)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus as a frame with columns whose names the operators use themselves."""
    rows = [(i, t, "en", 7, "t", 0.5, "n", "k") for i, t in corpus]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
