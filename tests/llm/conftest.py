import random

import pytest

#: Columns whose names operators use inside.
EXTRA = "lang string, source string, n_chars long, start int, n int, h long, node long, spans string, part string, _id string, shard string, label int, score double, w string, same string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n):
    """Words that hardly ever repeat a sequence between seeds, with sentences and lines."""
    draw = random.Random(seed)
    out = []
    for k in range(n):
        out.append(draw.choice(WORDS) + draw.choice(WORDS)[:3] + ("." if k % 11 == 10 else "") + ("\n" if k % 33 == 32 else ""))
    return " ".join(out).replace("\n ", "\n")


@pytest.fixture(scope="session")
def docs(spark):
    """Builds documents of (doc_id, text) pairs, with extra columns of clashing names."""

    def build(pairs):
        rows = [(i, t, "en", "src", len(t or ""), 1, 2, 3, 4, "s", "p", "i", "sh", 1, 0.5, "w", "x") for i, t in pairs]
        return spark.createDataFrame(rows, "doc_id long, text string, " + EXTRA)

    return build


@pytest.fixture(scope="session")
def odd():
    """Null, empty, blank, short, repeated, tied and very long texts; a null id; a repeated row."""
    long = " ".join(prose(k, 400) for k in range(30))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, "One TWO three four five six"), (7, "one two three four five six"), (8, prose(8, 120)), (9, prose(8, 120)),
        (9, prose(8, 120)), (10, long), (11, long + " end"), (12, "Anoi " * 300), (13, "a\nb\nc\nd\na\nb\nc\nz"), (14, "\n\n\n\n"), (15, "é ü 　   x  y <|endoftext|> z"), (None, "no id"),
    ]
