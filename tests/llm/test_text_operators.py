import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from fundlake.llm import bwt, compression, decontaminate, neardup, repeats, tables, text
from tests.llm.cases import AWKWARD, components, prose, shingles, table, words


def edited(base: str, rate: float, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(prose(rng.randrange(10**9), 1) if rng.random() < rate else w for w in base.split())


def test_blocks_see_nulls_slices_and_long_texts():
    column = pa.array(["skip", "Ab c", None, "", "é" * 10, "z" * 50]).slice(1)
    for limit in (1, 12, 1000):
        got = [b.bytes(i).decode() for b in text.blocks(column, limit) for i in range(len(b))]
        assert got == ["Ab c", "", "", "é" * 10, "z" * 50]


def test_shingle_sets_match_sets_of_words():
    texts = [t for _, t in AWKWARD] + [prose(k, k * 3) for k in range(12)] + ["A B c D e f A b C d E"]
    block = next(text.blocks(pa.array(texts), 1 << 30))
    grams, first = text.shingle_sets(block)
    assert np.diff(first).tolist() == [len(shingles(t)) for t in texts]
    assert (np.diff(text.words(block).first) == [len(words(t)) for t in texts]).all()
    assert len({int(g) for g in grams}) == len(set().union(*map(shingles, texts)))


@pytest.mark.parametrize("links", [[], [(1, 1)], [(k, k + 1) for k in range(30)], [(5, k) for k in range(12)] + [(20, 21), (21, 22), (9, 20)], [(2, 1), (1, 2), (4, 3)]])
def test_components_by_alternating_stars(spark, links):
    got = {r[0]: r[1] for r in tables.components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    parent = {x: x for pair in links for x in pair if pair[0] != pair[1]}
    for _ in links:
        for a, b in links:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == parent


def test_near_duplicates_match_all_pairs(spark):
    base = {0: prose(1, 80), 1: prose(2, 300)}
    texts = {10 + k: edited(base[k % 2], 0.012 * (k // 2), k) for k in range(60)}
    texts |= {100 + k: prose(50 + k, 40) for k in range(20)} | {200: texts[10], 5: texts[11], 201: "one two", 202: "ONE two", 203: "one two three"}
    want = components(texts)
    got = {r.doc_id: r for r in neardup.near_duplicates(table(spark, texts)).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) and r.n_shingles == len(shingles(texts[i])) for i, r in got.items())
    left = neardup.drop_near_duplicates(table(spark, texts))
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(want.values()))
    assert left.columns == table(spark, texts).columns


def test_near_duplicates_across_blocks(spark, monkeypatch):
    # Blocks of a few rows: all block pairs of a crowded bucket are compared, in tasks of their own.
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 4)
    base = prose(3, 60)
    texts = {k: edited(base, 0.05, k) for k in range(40)}
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table(spark, texts)).collect()}
    assert got == components(texts)


def test_near_duplicates_of_awkward_rows(spark):
    got = sorted(((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(table(spark, AWKWARD)).collect()))
    assert got == [(-1, 1, None, False), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 5, True), (6, 1, 6, True),
                   (7, 1, 7, True), (8, 1, 7, False), (8, 1, 7, False), (9, 1, 9, True)]
    assert neardup.near_duplicates(table(spark, [])).count() == 0


def test_near_duplicates_of_ids_with_several_texts(spark):
    a, b, c = prose(21, 60), prose(22, 60), prose(23, 60)
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, c), (5, None), (5, c + " z"), (6, ""), (7, prose(24, 60)), (7, prose(24, 60).upper())]
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7}
    got = neardup.near_duplicates(table(spark, rows)).collect()
    assert len(got) == len(rows) and all(r.component_id == want[r.doc_id] for r in got)
    left = neardup.drop_near_duplicates(table(spark, rows)).collect()
    assert sorted(r.doc_id for r in left) == [1, 4, 6, 7]
    assert neardup.drop_near_duplicates(table(spark, rows[::-1])).where("doc_id = 1").first().text == next(r.text for r in left if r.doc_id == 1)


def test_containment_matches_brute_force(spark):
    items = {k: prose(k, 6 + 5 * k) for k in range(10)} | {20: "too short", 21: None, 22: "exactly five words are here"}
    rng = random.Random(4)
    texts = {}
    for k in range(60):
        item = items[k % 10].split()
        part = item[rng.randrange(0, 3) :] if k % 3 else item
        texts[k] = " ".join([prose(900 + k, rng.randrange(0, 400)), *(w.upper() for w in part), prose(1900 + k, rng.randrange(0, 400))])
    texts[100] = "it says EXACTLY  five\nwords are here today"
    benchmark = spark.createDataFrame(list(items.items()), "item_id BIGINT, text STRING")
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in decontaminate.containments(table(spark, texts), benchmark).collect()}
    want = {}
    for i, item in items.items():
        own = shingles(item, short=False)
        for d, t in texts.items():
            shared = len(own & shingles(t, short=False))
            if own and shared >= 0.75 * len(own):
                want[d, i] = (shared, len(own))
    assert len(want) > 30 and got == want
    clean = {r.doc_id for r in decontaminate.drop_contaminated(table(spark, texts), benchmark).collect()}
    assert clean == set(texts) - {d for d, _ in want}


def test_containment_of_awkward_rows(spark):
    benchmark = spark.createDataFrame([(1, "same words in this row"), (1, "same words in this row"), (None, "a row without an id")], "item_id BIGINT, text STRING")
    rows = decontaminate.containments(table(spark, AWKWARD), benchmark).collect()
    assert sorted(tuple(r) for r in rows) == [(7, 1, 1, 1), (8, 1, 1, 1)]
    assert decontaminate.containments(table(spark, []), benchmark).count() == 0
    assert decontaminate.containments(table(spark, AWKWARD), benchmark.where("false")).count() == 0
    assert decontaminate.drop_contaminated(table(spark, AWKWARD), benchmark).count() == len(AWKWARD) - 3


def plain_counts(t: str | None) -> tuple:
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", t or "")]
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if __import__("re").search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(covered)


def test_compression_bands(spark):
    good, rng = prose(5, 400), random.Random(1)
    texts = AWKWARD[:10] + [(20, good), (21, " ".join(prose(6, 40).split() * 30)), (22, " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(9)) for _ in range(300))),
                            (23, "a line\n" * 3 + "\n\n \n other ## line\na line\n" + "é | " * 4), (24, good + " " + "ab " * 3000)]
    got = compression.judge(table(spark, texts)).collect()
    by_text = {r.doc_id: r for r in got}
    for i, t in texts:
        r = by_text[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(t), i
        assert r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words)
    assert by_text[20].kept and not by_text[21].kept and not by_text[21].in_band
    assert not by_text[22].base_failed and not by_text[22].kept
    assert len(got) == len(texts) and compression.judge(table(spark, [])).count() == 0


def encoded(kind: str, n: int, seed: int) -> str:
    rng = random.Random(seed)
    if kind == "hex":
        return rng.randbytes(n).hex()[:n]
    if kind == "letters":
        return prose(seed, n, "abcdefghijklmnopqrstuvwxyz")[:n]
    data = base64.b64encode(rng.randbytes(n)).decode()
    return " ".join(data[k : k + 9] for k in range(0, n, 9))[:n]


def test_compression_bands_follow_the_corpus(spark):
    # Ordinary text: words by a skewed law, so ratios are above those of random letters.
    rng = random.Random(3)
    lexicon = prose(11, 3000, "abcdefghijklmnopqrstuvwxyz").split()
    ordinary = lambda n: " ".join(lexicon[int(3000 ** rng.random()) - 1] for _ in range(n // 4))[:n]
    texts = {k: ordinary(n) for k, n in enumerate([2400] * 60 + [5500] * 60 + [20_000] * 60)}
    texts[170] = ordinary(500)
    for j, kind in enumerate(("hex", "letters", "base64")):
        texts |= {200 + 10 * j + k: encoded(kind, n, k) for k, n in enumerate((2400, 5500, 20_000))}
        texts |= {300 + 10 * j + k: ordinary(int(20_000 * (1 - part))) + " " + encoded(kind, int(20_000 * part), k) for k, part in enumerate((0.3, 0.4, 0.5))}
    texts |= {400 + k: ordinary(n // 20) * 20 for k, n in enumerate((2400, 5500, 20_000))}
    texts[500] = encoded("hex", 300_000, 5)  # a class with few members
    got = {r.doc_id: r.in_band for r in compression.judge(table(spark, texts)).collect()}
    assert not [i for i in texts if i >= 200 and got[i]]
    assert sum(got[i] for i in range(180)) >= 176


def plain_removal(rows: list[tuple], length: int) -> list[tuple]:
    seen, out = set(), []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if b[k : k + length] in seen:
                gone[k : k + length] = True
            seen.add(b[k : k + length])
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length", [20, 100])
def test_repeated_passages_match_brute_force(spark, length, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 2000)
    passage, other = prose(7, 40), prose(8, 25)
    rows = [(k, f"{prose(30 + k, 9)} {passage if k % 2 else other}{'' if k % 3 else '!'} {prose(60 + k, 7)} {passage[k : k + 120]}") for k in range(24)]
    rows += [(30, rows[3][1]), (31, "ab" * 150), (32, "ab" * 90 + "c"), (33, "é" * 70), (34, "é" * 70 + "x"), (35, prose(9, 12) + prose(9, 12)), (36, None), (37, ""), (38, passage[:99])]
    got = repeats.remove(table(spark, rows), length, with_text=True).collect()
    assert sorted(tuple(r)[:5] for r in got) == plain_removal(rows, length)


@pytest.mark.parametrize("length", [20, 100])
def test_hot_anchors_give_the_same_removals(spark, length):
    passage = prose(7, 60)
    rows = [(k, f"{prose(30 + k, 9)} {passage[k % 3 :]} {prose(60 + k, 7)} {passage[k : k + 120]}") for k in range(40)]
    rows += [(50, rows[3][1]), (51, "ab" * 150), (52, "ab" * 90 + "c"), (53, passage), (54, "é" * 70 + "x"), (55, None), (56, passage[:99]), (57, prose(9, 12) * 2)]
    got = repeats.remove(table(spark, rows), length, hot=5).collect()
    assert sorted(tuple(r)[:5] for r in got) == plain_removal(rows, length)


def test_no_bucket_gathers_the_edges_of_a_passage():
    passage, n, length, buckets = prose(7, 60), 600, 100, 64
    texts = [f"{prose(1000 + k, 20)} {passage} {prose(5000 + k, 20)}" for k in range(n)]
    rows = pa.RecordBatch.from_pydict({"key": list(range(n)), "h1": [7] * n, "text": texts})
    blocks = pa.Table.from_batches(list(repeats._survey([rows], length, 1)))
    most = {}
    for hot in (1 << 30, 50):
        shared = repeats._shared(blocks.filter(pa.compute.greater_equal(blocks["part"], 0)), hot)
        flags = repeats._by_document(blocks.filter(pa.compute.less(blocks["part"], 0)), shared).sort_by("key")
        cut = pa.RecordBatch.from_arrays([flags[c].combine_chunks() for c in ("key", "h1")] + [pa.array([texts[k] for k in flags["key"].to_pylist()])] +
                                         [flags[c].combine_chunks() for c in ("shared", "hot")], names=["key", "h1", "text", "shared", "hot"])
        packs = pa.Table.from_batches(list(repeats._cut([cut], length, buckets))).to_pylist()
        size = [sum(len(p["text"]) for p in packs if p["bucket"] == b) for b in range(buckets)]
        most[hot] = max(size) / (sum(size) / buckets)
    assert most[1 << 30] > 10 and most[50] < 3


def test_repeated_passages_of_awkward_rows(spark):
    rows = AWKWARD + [(10, "x" * 500), (None, "x" * 400), (11, prose(1, 40)), (11, prose(1, 40))]
    got = sorted((r.doc_id or 99, r.n_bytes, r.n_removed) for r in repeats.remove(table(spark, rows)).collect())
    size = len(prose(1, 40))
    assert [g for g in got if g[0] in (9, 10, 11)] == [(9, 300_000, 299_999), (10, 500, 500), (11, size, 0), (11, size, size)]
    assert (99, 400, 400) in got and len(got) == len(rows)
    assert repeats.remove(table(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_merged_transforms_give_the_intervals(seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(97, 97 + 2 + seed % 2, rng.integers(1, 60)).astype(np.uint8) for _ in range(rng.integers(1, 7))]
    length = int(rng.integers(1, 14))
    got = bwt.merge(texts, length)
    want = [bytes(t[(i + k) % len(t)] for k in range(length)) for t in texts for i in range(len(t))]
    names = {w: n for n, w in enumerate(sorted(set(want)))}
    assert got.tolist() == [names[w] for w in want]  # intervals in the order of the strings
