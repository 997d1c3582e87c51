import random

import pytest

from portolan.llm.tables import ship
from portolan.sinks import Staging

# Names that operators use for columns of their own.
CLASHES = ["record", "kept", "n_words", "leaks", "selected", "log_weight", "bpe", "language", "n_tokens", "fp", "spans", "role"]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def staging(spark):
    own = Staging(spark)
    yield own
    own.clear()


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}" + rng.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture
def corpus():
    """(id, text): copies, near copies, shared passages, repeats within, odd and empty texts, equal rows."""
    rng = random.Random(7)
    rows, passage = [], prose(rng, 60)
    for i in range(60):
        rows.append((i, prose(rng, rng.randint(1, 150))))
    for i in range(60, 90):  # near copies in chains
        w = rows[rng.randrange(len(rows) // 2)][1].split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w)))
    for i in range(90, 110):
        rows.append((i, prose(rng, 30) + "\n" + passage + "\t" + prose(rng, 10)))
    rows += [(i, rows[5][1]) for i in range(110, 125)]
    rows += [
        (200, None), (201, ""), (202, " \n\t "), (203, "one"), (204, "ONE"), (205, "a b"), (206, "A  B\n"),
        (207, "again " * 50), (208, "again " * 3000), (209, "x" * 30_000), (210, "é ß İ Σς 漢字 \u0085 <|endoftext|>tail"),
        (211, "tail of it"), (211, "tail of it"), (None, "without a number " * 10),
    ]
    return rows


@pytest.fixture
def docs(spark, corpus):
    return frame(spark, corpus)


def frame(spark, rows, partitions=5):
    extra = ", ".join(f"{c} string" for c in CLASHES)
    data = [(d, t, "en", "s", len(t) if t is not None else None, *["clash"] * len(CLASHES)) for d, t in rows]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    return spark.createDataFrame(data, schema).repartition(partitions)


@pytest.fixture
def empty(spark):
    return frame(spark, [], 1)
