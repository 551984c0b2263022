"""Plain versions of the operators, and rows that are hard to handle."""

from __future__ import annotations

import re

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
LONG = " ".join(f"w{i % 977}" for i in range(20_000))
ODD_TEXTS = [
    None, "", "   \n\t ", "one", "A b C d E", "A b C d E", "a B c D e", "   x　", "Ünḯcødé 日本語 🎉",
    "l1 a b\nl1 a b\n\nl2", "x " * 60, LONG,
]


def words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def lower_words(text: str | None) -> list[str]:
    return words((text or "").translate(LOWER))


def documents(spark, texts=ODD_TEXTS, ids=None):
    """Documents with a NULL id, a repeated row and columns whose names an operator might use itself."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "block", "score", 1.5) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, block string, predicted string, n_words double")


def components(nodes, links):
    label = {n: n for n in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
