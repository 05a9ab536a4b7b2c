"""Small document tables with all the awkward rows, and plain reference versions of the operators."""

from __future__ import annotations

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, key BIGINT, shard STRING, label STRING, kept BOOLEAN"


def prose(seed: int, n: int, letters: str = "abcdefghij") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(n))


def rows_of(texts: dict | list) -> list[tuple]:
    items = texts.items() if isinstance(texts, dict) else texts
    return [(i, t, "en", "s0", None, 7, "x", "y", True) for i, t in items]


def table(spark, texts: dict | list):
    """Documents with extra columns whose names occur inside the operators."""
    return spark.createDataFrame(rows_of(texts), DOCS)


AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "a b c d"), (6, "é　ü 日本 🙂"), (7, "same words in this row"), (8, "same words in this row"), (8, "same words in this row"), (None, "a row without an id"), (9, "x" * 300_000)]


def words(text: str | None) -> list[str]:
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return WORDS.findall(lower)


def shingles(text: str | None, short: bool = True) -> set[tuple]:
    w = words(text)
    if short and 0 < len(w) < 5:
        return {tuple(w)}
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def components(texts: dict) -> dict[int, int]:
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if either and sets[a] and sets[b] and 100 * both >= 75 * either:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}
