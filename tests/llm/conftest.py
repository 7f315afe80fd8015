from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pulseframe.llm.ship import ship  # noqa: E402

#: Beside id and text, columns named like those that the operators use inside.
CLASHING = ["chunk", "bucket", "score", "label", "row", "words", "rest", "component", "lang", "source", "n_chars"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())] + [T.StructField(c, T.StringType()) for c in CLASHING]
)


@pytest.fixture(scope="session")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def make_docs(shipped):
    def make(rows):
        return shipped.createDataFrame([(i, t, *[f"{c}{i}" for c in CLASHING]) for i, t in rows], SCHEMA)

    return make


def sentence(rng, n, words="alpha beta gamma delta The of and Ünï token über zeta eta theta iota".split()):
    return " ".join(rng.choice(words) + (str(rng.randrange(50)) if rng.random() < 0.7 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Copies, near copies, shared passages and lines, ties, odd white space, nulls, blanks and a very long text."""
    rng = random.Random(5)
    base = sentence(rng, 120)
    passage = sentence(rng, 60)
    boiler = "Licensed under the terms that every document repeats at its end."
    block = "\n".join(sentence(rng, 9) for _ in range(5))
    rows = [(7, base), (3, base), (11, base.upper()), (12, base), (4, None), (5, ""), (6, " \t\n\x0b "), (8, "one"), (9, "one"), (10, "One two")]
    for k in range(12):
        w = base.split()
        for _ in range(rng.randrange(1, 6)):
            w[rng.randrange(len(w))] = f"changed{rng.randrange(999)}"
        rows.append((20 + k, " ".join(w)))
    for k in range(10):
        rows.append((40 + k, "\n".join([sentence(rng, 20), sentence(rng, rng.randrange(30)) + " " + passage + " " + sentence(rng, 10), boiler])))
    for k in range(6):
        rows.append((60 + k, "\n".join([sentence(rng, 12), block, "", boiler, sentence(rng, 8)])))
    rows.append((70, "\n".join([block] * 2)))
    rows.append((80, "ab " * 300))
    rows.append((81, "ab " * 200 + passage))
    rows.append((82, "é" * 130))
    rows.append((83, "x" + "é" * 90))
    rows.append((90, "\r\n".join([boiler, "a b\x1cc", boiler])))
    rows.append((95, passage + "\n" + "\n".join(sentence(rng, 40) for _ in range(500))))
    return rows
