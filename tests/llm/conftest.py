from __future__ import annotations

import pytest

WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon "
         "phi chi psi omega").split()


def prose(seed: int, n: int) -> str:
    """Words that look random and never repeat by chance."""
    return " ".join(f"{WORDS[(seed * 7 + i * i) % 24]}{(seed * 131 + i * 17) % 997}" for i in range(n))


def corpus() -> list[tuple[int | None, str | None, str]]:
    """Nulls, empties, copies, near copies, shared passages, long, periodic and repeated rows."""
    passage = "\n".join(prose(900 + i, 14) for i in range(6))
    base = prose(1, 120)
    rows = [(1, base), (2, base), (3, base.replace("alpha", "Alpha")), (4, " ".join(base.split()[:118]) + " new ending"),
            (5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "One TWO"), (10, prose(2, 60) + "\n" + passage),
            (11, passage + "\n" + prose(3, 50)), (12, prose(4, 30) + "\n" + passage + "\n" + prose(5, 30)),
            (13, "ha " * 400), (14, prose(6, 3000)), (15, "é ü ß " * 5 + prose(7, 40)), (16, prose(8, 25)),
            (16, prose(8, 25)), (17, prose(9, 19)), (18, prose(9, 20)), (19, prose(9, 21)), (20, "a\nb\na\nb\na\nb\na\nb"),
            (21, "x" * 450), (22, prose(10, 15) + " " + " ".join(base.split()[40:90]))]
    return [(i, t, "src") for i, t in rows]


@pytest.fixture(scope="session")
def docs(spark):
    """The corpus with columns whose names the operators also use inside."""
    rows = [(i, t, s, len(t or ""), 7, "key") for i, t, s in corpus()]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, n int, tk string").repartition(5)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("doc_id < 0")
