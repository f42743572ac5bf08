"""Small inputs that several tests share, and plain rules to hold results against."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng: random.Random, n: int) -> str:
    words = ["the", "of", "stone", "river", "and", "in", "walks", "über", "señal", "a", "cold", "it", "marks", "house", "到"]
    return " ".join(rng.choice(words) + rng.choice(["", "", ".", ","]) for _ in range(n))


def documents(spark, rows, extra: str = ""):
    """A table of (doc_id, text), with columns whose names operators use inside."""
    schema = "doc_id bigint, text string, found string, blob string, words string, _text string, ids string, leaks string"
    return spark.createDataFrame([(i, t, "x", None, "y", "z", "w", "v") for i, t in rows], schema)


def awkward(rng: random.Random) -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, repeated rows, a long text and a long word."""
    return [
        (None, None), (None, "no id"), (1, None), (2, ""), (3, " \n\t "), (4, prose(rng, 30)), (4, None),
        (5, prose(rng, 4000)), (6, "x" * 30_000), (7, "tie tie"), (7, "tie tie"), (8, "　é 😀 end"),
    ]
