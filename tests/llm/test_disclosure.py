import hashlib
import math
import random
import re
import time
from collections import defaultdict

import pytest

from fundlake.llm import disclosure, queries
from tests.llm.cases import AWKWARD, prose, table

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
TERM = re.compile("[A-Za-z0-9\x80-\U0010ffff]+")


def passes(kind, value):
    digits = [int(d) for d in value if d in "0123456789"]
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(map(int, str(2 * d))) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    found = [(m.start(), n, m.end(), kind, m.group()) for n, (kind, pattern) in enumerate(PATTERNS.items()) for m in pattern.finditer(text if kind != "email" or "@" in text else "") if passes(kind, m.group())]
    return sorted(found)


def test_values_equal_plain_patterns():
    rng = random.Random(8)
    parts = ["@", ".", "+", "-", " ", "(", ")", "a", "é", "Z_", "1", "42", "255", "256", "007", "x@y.z", "4111 1111 1111 1111", "4111111111111111", "+1 (555) 010-2030", "10.0.0.1", "..", "%+"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert [(f.start, f.kind, f.end) for f in disclosure.base_spans(text)] == [row[:3] for row in plain_spans(text)], text


@pytest.mark.parametrize("text", ["9" * 200_000, "@" * 200_000, "a" * 200_000 + "@", "a@" * 100_000, "+1" + " " * 200_000, "1." * 100_000, "+1 " * 70_000, "1 " * 100_000])
def test_long_rows_take_no_quadratic_time(text):
    begin = time.time()
    disclosure.base_spans(text)
    assert time.time() - begin < 5


def plain_terms(texts):
    """share by term, over lists of texts, by dictionaries of documents."""
    near, holding, contexts = defaultdict(set), defaultdict(set), defaultdict(set)
    entities = defaultdict(set)
    for d, text in enumerate(texts):
        spans = plain_spans(text)
        terms = [(m.start(), m.end(), m.group().translate({c: c + 32 for c in range(65, 91)})) for m in TERM.finditer(text) if len(m.group().encode()) >= 3]
        for *_, t in terms:
            holding[t].add(d)
        free = [(a, b, t) for a, b, t in terms if all(b <= s or a >= e for s, _, e, _, _ in spans)]
        first = set()
        for s, _, e, kind, value in spans:
            value = value.lower() if kind == "email" else re.sub("[^0-9]", "", value) if kind in ("card", "phone") else ".".join(str(int(x)) for x in value.split("."))
            around = [t for _, b, t in free if b <= s][-8:] + [t for a, _, t in free if a >= e][:8]
            entities[kind, value].add(d)
            for t in around:
                near[kind, value, t].add(d)
            if (kind, value) not in first:
                first.add((kind, value))
                context = tuple(around)
            for t in around:
                contexts[kind, value, t].add(context)
    shares = {}
    for (kind, value, t), docs in near.items():
        p = len(entities[kind, value]) / len(texts)
        given = (len(docs) - 1) / max(len(holding[t]) - 1, 1)
        if len(contexts[kind, value, t]) > 1 and given > 0 and -math.log2(p) >= 8 and math.log2(given / p) >= 8:
            share = math.log2(given / p) / -math.log2(p)
            if share >= disclosure.GENERALISED:
                shares[t] = max(shares.get(t, 0), share)
    return shares


def corpus():
    rng = random.Random(9)
    texts = [prose(k, 30) for k in range(1500)]
    for k in range(4):  # a name that stands with one address only, one that stands elsewhere too, and a common word
        texts[k] = f"{prose(7000 + k, 9)} Zebulon wrote from zeb.q@mail.example.com, said Quist{' often' * (k % 2)}. {prose(8000 + k, 12)}"
        texts[40 + k] = f"Quist stayed {prose(9000 + k, 20)}"
    texts[60] = f"{prose(1, 20)} ZEBULON again, without his address"
    texts[61] = texts[62] = f"{prose(2, 9)} onlycopied 10.9.8.7 {prose(3, 9)}"
    for k in range(100, 700):  # an address that protects nobody
        texts[k] += " contact help@desk.example.com for hotline"
    rng.shuffle(texts)
    return texts


def test_terms_that_reveal_equal_plain_counts(spark):
    texts = corpus()
    want = plain_terms(texts)
    assert "zebulon" in want and not {"quist", "onlycopied", "hotline", "contact"} & set(want)
    rows = [(k, t) for k, t in enumerate(texts)] + [(5000, None)]
    docs = table(spark, rows)
    found = {r.doc_id: r for r in disclosure.find(docs).collect()}
    n = len(rows)
    assert len(found) == n
    for k, text in enumerate(texts):
        assert [(s.start, s.kind, s.end) for s in found[k].base] == [(s, kind, e) for s, _, e, kind, _ in plain_spans(text)]
        assert [(s.start, s.end) for s in found[k].terms] == [(m.start(), m.end()) for m in TERM.finditer(text) if m.group().lower() in want]
    clean = {r.doc_id: r.text for r in disclosure.sanitise(docs).collect()}
    assert clean[5000] is None
    for k, text in enumerate(texts):
        if "zeb.q" in text:
            assert "[EMAIL]" in clean[k] and "Zebulon" not in clean[k] and "Quist" in clean[k]
        elif "again, without" in text:
            assert "ZEBULON" not in clean[k]
        elif "onlycopied" in text:
            assert clean[k] == text.replace("10.9.8.7", "[IP]")


def test_query_over_awkward_rows(spark, tmp_path):
    rows = AWKWARD + [(20, "é write to A.b@c.de or +1 (555) 010-2030, 4111 1111 1111 1111 at 10.0.0.255.1"), (20, "1.2.3.4, 1.2.3.4"), (21, "10.0.0.256 +12 345 4111111111111112")]
    spark.createDataFrame([(i, t, "b", 1) for i, t in rows], "doc_id BIGINT, text STRING, base STRING, slice INT").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(queries.op13_personal_data(spark, str(tmp_path)).fillna({"doc_id": -1}).collect())
    want = []
    for i, t in rows:
        spans = plain_spans(t or "")
        text = ",".join(f"{kind}:{s}:{e}" for s, _, e, kind, _ in spans)
        want.append((-1 if i is None else i, *(sum(s[3] == kind for s in spans) for kind in PATTERNS), hashlib.sha256(text.encode()).hexdigest(), text))
    assert [tuple(r) for r in got] == sorted(want)
    spark.createDataFrame([], "doc_id BIGINT, text STRING").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert queries.op13_personal_data(spark, str(tmp_path / "none")).count() == 0
