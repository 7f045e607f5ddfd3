"""Small documents that hold the odd cases every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

LICENSE = "Licensed under the Apache License, Version 2.0, as everyone knows by now."


def texts(n: int = 60, seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    out: list[str | None] = [None, "", " ", "\n\n", "one", "One  two\tthree", "Ünïcödé 日本語 ☃ text\x0bwith\x0codd spaces"]
    base = " ".join(rng.choice(words) for _ in range(80))
    for i in range(n):
        kind = i % 6
        body = " ".join(rng.choice(words) for _ in range(rng.randint(5, 120)))
        if kind == 0:
            own = base.split()
            own[rng.randrange(80)] = f"changed{i}"
            body = " ".join(own)
        elif kind == 1:
            body += "\n" + LICENSE + "\n" + body[:40]
        elif kind == 2:
            body += f' password = "hunter{i}secret" and AKIA{"ABCDEFGH12345678"} then {"0123456789abcdef" * 2}'
        elif kind == 3:
            body = "same text in several documents " * 4
        out.append(body)
    out.append(" ".join(rng.choice(words) for _ in range(6000)))  # a very long text
    return out


def documents(spark: SparkSession, given: list[str | None] | None = None, langs: tuple[str | None, ...] = ("en", "de", None)) -> DataFrame:
    given = texts() if given is None else given
    rows = [(i, t, langs[i % len(langs)], f"src{i % 4}", None if t is None else len(t)) for i, t in enumerate(given)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def clashing(docs: DataFrame) -> DataFrame:
    """Extra columns with names that operators use inside or return."""
    from pyspark.sql import functions as F

    names = ("start", "n_lines", "n_dropped", "kept", "rep", "band", "label", "key", "n", "t", "score", "distance")
    return docs.withColumns({c: F.lit("x") for c in names})
