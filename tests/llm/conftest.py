from __future__ import annotations

import random

import pytest

WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="session")
def corpus() -> list[tuple[int, str | None]]:
    """Texts with copies, near copies, shared passages, runs, junk, odd characters, null and empty ones."""
    rnd = random.Random(11)
    vocabulary = ["the", "of", "and", "is", "ß", "été", "naïve", "漢字", "x"] + [f"w{k}" for k in range(300)]
    passages = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(55, 90))] for _ in range(4)] + [["x"] * 130, ["p", "q"] * 70]
    rows: list[tuple[int, str | None]] = []
    for i in range(160):
        words: list[str] = []
        for _ in range(rnd.randrange(1, 5)):
            words += rnd.choice(passages)[: rnd.randrange(30, 140)] if rnd.random() < 0.35 else [rnd.choice(vocabulary) for _ in range(rnd.randrange(5, 70))]
        text = " ".join(words)
        if rnd.random() < 0.3:
            text = text.replace(" ", "\n", 3).replace(" ", " \t", 2)
        rows.append((3 * i, text))
    for k, i in enumerate(rnd.sample(range(160), 40)):
        words = rows[i][1].split(" ")
        for _ in range(k % 3):
            words[rnd.randrange(len(words))] = "edit"
        rows.append((1000 + k, " ".join(words)))
    rows += [(5000, None), (5001, ""), (5002, " \n\t"), (5003, "one two"), (5004, "One TWO"), (5005, "### *** $$$ " * 30), (5006, "\x85 a\xa0 b　 'll ab1２")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    rows = [(i, t, ("a", "b", "c", None)[i % 4], i % 7) for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int").repartition(5)
