from __future__ import annotations

import random

import pytest

#: Extra columns named like working columns of the operators.
EXTRA = ("doc", "id", "row", "key", "line", "block", "hash", "text_hash", "g", "fp", "n_words", "spans")
WORDS = "the of rend and that Über façade naïve 中文 don't end. x1 a,b".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "ing", "ed"]) for _ in range(n))


@pytest.fixture(scope="session")
def cases():
    """Rows (doc_id, text, source): nulls, empty and long texts, copies, repeated rows, ties."""
    rng = random.Random(7)
    shared = "a shared license line that many documents have"
    passage = sentence(rng, 40)
    rows = [
        (1, None, "b"),
        (2, "", "a"),
        (3, " \t\n\x0b ", None),
        (4, "one", ""),
        (5, "Two words", "b"),
        (6, "line\n\nline\n" + shared, "a"),
    ]
    for k in range(7, 40):
        body = sentence(rng, rng.randint(3, 120))
        if k % 3 == 0:
            body = f"{shared.upper() if k % 2 else ' ' + shared}\n{body}\n{shared}"
        if k % 4 == 0:
            body = f"{body} {passage} {sentence(rng, 5)}"
        rows.append((k, body, rng.choice(["a", "b", "c", "d", None])))
    rows += [(40, rows[10][1], "a"), (41, rows[10][1], "a"), (42, rows[12][1] + " x", "z")]
    rows += [rows[15], rows[15]]  # repeated rows
    rows.append((50, sentence(rng, 9000) + "\n" + shared, "a"))
    rows.append((51, "y" * 3000 + " " + passage, "c"))
    return rows


@pytest.fixture(scope="session")
def frame(spark):
    """A documents frame from rows, with clashing extra columns; ids may be null."""

    def build(rows, extra=True, partitions=3):
        schema = "doc_id long, text string, source string"
        df = spark.createDataFrame([tuple(r) for r in rows], schema).repartition(partitions)
        return df.selectExpr("*", *[f"doc_id AS `{name}`" for name in EXTRA]) if extra else df

    return build
