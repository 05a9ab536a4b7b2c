import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from fundlake.llm import periodic, queries
from tests.llm.cases import AWKWARD, prose, table

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w, least=1):
    """All runs by comparing the sequence with itself at every distance."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((b, q, e) for (b, e), q in found.items())


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def sequences():
    rng = random.Random(5)
    for n in range(0, 70, 3):
        for letters in (1, 2, 3):
            for _ in range(8):
                yield [rng.randrange(letters) for _ in range(n)]
    yield fibonacci(400)
    yield [bin(k).count("1") % 2 for k in range(512)]
    for p in (1, 2, 3, 5):
        for times in (4, 9, 30):
            root = list(range(p))
            half = root * times + root[: p // 2 + 1] if p > 1 else root * times + [9]
            yield half + half
            yield [7] + half + half + root * times + [8] + half
            yield half * 3 + root
    for _ in range(60):
        part = [rng.randrange(2) for _ in range(rng.randrange(3, 60))]
        other = part * rng.randrange(2, 5)
        yield [5] * rng.randrange(3) + other[: len(other) - rng.randrange(3)] + [rng.randrange(3) for _ in range(20)] + part + part


@pytest.mark.parametrize("small", [1, 2, 4, 16])
def test_all_runs_are_found(small):
    for w in sequences():
        got = [(int(b), int(q), int(e)) for b, e, q in periodic.find_runs(np.array(w, np.int64), small=small)]
        assert got == plain_runs(w), (small, w)


def plain_collapse(words, runs):
    gone = {i for b, q, e in runs for i in range(b + q, e)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_and_collapsed_texts(spark):
    rng = random.Random(6)
    texts = {}
    for k in range(60):
        words = prose(k, rng.randrange(5, 40), "ab").split()
        texts[100 + k] = "\n \n".join(" ".join(words * rng.randrange(1, 5) + prose(k + 500, 10).split()) for _ in range(rng.randrange(1, 3)))
    texts[200] = "a b c " * 3000
    texts[201] = prose(9, 30_000) + " end " + "x y " * 7
    rows = [(i, t) for i, t in texts.items()] + AWKWARD
    got = sorted(((r.doc_id or -1, r.n_words, [(x.start, x.period, x.start + x.length) for x in r.runs], r.collapsed) for r in periodic.find(table(spark, rows)).collect()))
    want = []
    for i, t in rows:
        words = WORDS.findall(t or "")
        runs = plain_runs(words, 12) if len(words) < 5000 else [(0, 3, 9000)] if i == 200 else [(30_001, 2, 30_015)]
        want.append((i or -1, len(words), runs, plain_collapse(words, runs)))
    assert got == sorted(want)
    assert periodic.find(table(spark, [])).count() == 0


def test_query_digests_what_was_planted(spark, tmp_path):
    rng = random.Random(7)
    rows = [(k, prose(k, rng.randrange(0, 120), "abc")) for k in range(200)] + [(k, t) for k, t in AWKWARD] + [(3000, "  ")]
    spark.createDataFrame([(i, t, "n", 4) for i, t in rows], "doc_id BIGINT, text STRING, runs STRING, start INT").write.parquet(str(tmp_path / "documents.parquet"))
    want, planted = [], 0
    for i, t in rows:
        words = WORDS.findall(t or "")
        n, h = len(words), zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words, planted = words[:a] + [words[a + (k - a) % p] for k in range(a, n)], planted + 1
        runs = plain_runs(words, 12)
        lines = "".join(f"{b},{e - b},{q}\n" for b, q, e in runs)
        best = max(((e - b, -b, -q) for b, q, e in runs), default=None)
        head = (-best[1], best[0], -best[2], 1000 * best[0] // -best[2]) if best else (None,) * 4
        want.append((-1 if i is None else i, len(runs), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()))
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).fillna({"doc_id": -1}).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and planted > 10
