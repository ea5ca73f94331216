"""Small tables with the awkward cases, shared by the operator tests."""

from __future__ import annotations

import re

WORD = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, key int, cls int, kept_id long"


def words(text):
    return re.findall(WORD, text or "")


def prose(seed: int, n: int) -> str:
    return " ".join(f"w{(seed * 7919 + i * 104729) % 100003}" for i in range(n))


def awkward_docs(spark):
    """Nulls, empty and blank texts, repeats, near copies, a long text, clashing extra columns."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    texts = [
        (0, base), (1, base), (2, " ".join(near)), (3, None), (4, ""), (5, " \t\n "), (6, "one two"), (7, "One TWO"),
        (8, "a b c d e"), (9, "a b c d e f"), (10, prose(2, 30_000)), (11, "x" * 4000), (11, "x" * 4000),
        (12, "é 😀 ñ z " * 40), (13, "same line\n" * 30), (14, base + "\n" + prose(3, 60)), (None, prose(4, 80)), (None, None),
    ]
    rows = [(i, t, None if i == 6 else "en", None if i in (4, 6) else f"s{(i or 0) % 2}", None, 0.5, "big", 1, 2, 3) for i, t in texts]
    return spark.createDataFrame(rows, DOCS), texts
