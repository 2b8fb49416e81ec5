from __future__ import annotations

import random

import pytest

#: Names that operators use inside; a table may have them too.
CLASHING = ["key", "kept", "copies", "fp", "text_hash", "digest", "part", "shard", "score", "rank", "pass", "length"]


def rows_of(count: int = 60, seed: int = 5) -> list[tuple]:
    """Small corpus: prose in two invented languages, copies, near copies, odd rows."""
    pick = random.Random(seed)
    north = "the and thing reading waterfall north house with under stone river making".split()
    south = "della ragazza perche mattina quello sempre amore giorno finestra vicino sole strada".split()
    rows = []
    for i in range(count):
        words = pick.choices(north if i % 3 else south, k=pick.randint(3, 90))
        text = " ".join(w.capitalize() if pick.random() < 0.1 else w for w in words) + "."
        rows.append((i, text, "aa" if i % 3 else "bb"))
    rows += [(100 + i, rows[i][1], rows[i][2]) for i in range(8)]  # exact copies
    rows += [(120 + i, rows[i][1].replace(" ", "\n ") + " ", rows[i][2]) for i in range(5)]  # white space differs
    rows += [(140 + i, rows[40 + i][1] + " end", rows[40 + i][2]) for i in range(5)]  # near copies
    rows += [
        (200, None, "aa"),
        (201, "", None),
        (202, " \t\n", "bb"),
        (203, "12 34 !!", None),
        (204, "word", "aa"),
        (None, "no id at all in this row", "aa"),
        (205, " ".join(pick.choices(north, k=6000)), "aa"),  # very long
        (206, "x" * 30000, "aa"),  # one very long word
        (207, "Straße İstanbul ΣΑΣ ½ don't 日本語 \x1c   é", "bb"),
        (0, rows[0][1], rows[0][2]),  # a repeated row
        (0, rows[0][1], rows[0][2]),
        (1, "another text under an id that is taken", "aa"),
    ]
    return rows


def frame(spark, rows: list[tuple]):
    columns = ", ".join(f"`{c}` string" for c in CLASHING)
    full = [(i, t, lang, "s", len(t or ""), *["clash"] * len(CLASHING)) for i, t, lang in rows]
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {columns}"
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="session")
def corpus():
    return rows_of()


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return frame(spark, corpus).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])
