import math
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import zstandard
import pytest
from pyspark.sql import functions as F

from fundlake.llm import kdtree, labelled, language, mixing, ordinal, text, token_store, toxicity
from tests.llm.cases import AWKWARD, prose, table

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_language_of_held_out_texts(spark):
    alphabets = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "ijklmnéü"}
    rows = [(f"{prose(k, 60, alphabets[lang])}.", lang) for lang in alphabets for k in range(30)]
    samples = language.learn(spark.createDataFrame([*rows, (None, "aa"), ("12 34", "bb"), ("text", None)], "text STRING, lang STRING"))
    assert [lang for lang, _ in samples] == ["aa", "bb", "cc"]
    texts = {100 + k: prose(500 + k, 15, alphabets[("aa", "bb", "cc")[k % 3]]) for k in range(45)}
    got = {r.doc_id: r for r in language.identify(table(spark, texts), samples).collect()}
    assert all(r.lang_pred == ("aa", "bb", "cc")[(i - 100) % 3] and 0 <= r.score <= 1 for i, r in got.items())
    odd = {(r.doc_id or -1): r.lang_pred for r in language.identify(table(spark, [*AWKWARD[:10], (20, "123 !!")]), samples).collect()}
    assert odd[1] == odd[2] == odd[3] == odd[20] == "und" and odd[6] in alphabets
    assert {r.lang_pred for r in language.identify(table(spark, AWKWARD), ()).collect()} == {"und"}
    assert language.identify(table(spark, []), samples).count() == 0


def test_copies_take_one_place_of_the_language_sample(spark):
    texts = [prose(k, 20) for k in range(40)]
    # Among the first by hash, so that copies would take all places behind it.
    hashes = spark.createDataFrame([(t,) for t in texts], "text STRING").select("text", F.xxhash64("text").alias("h")).orderBy("h").collect()
    rows = [(t, "aa") for t in texts] + [(hashes[1].text, "aa")] * 1000
    (_, sample), = language.learn(spark.createDataFrame(rows, "text STRING, lang STRING").repartition(5))
    assert sorted(sample.split("\n")) == sorted(texts)


def test_cross_parsing_matches_greedy_search():
    sample, probe = prose(1, 120, "abc"), prose(2, 30, "abcd")
    number, width, tables = language._model((("x", sample),))
    own = language._letters(sample)
    symbols = number[language._letters(probe)]
    lengths = np.array([len(symbols)])
    got = int(language._phrases(symbols[:, None].astype(np.uint8), lengths, width, tables[0])[0])
    train, rest = bytes(number[own]), bytes(symbols)
    at = phrases = 0
    while at < len(rest):
        size = 0
        while at + size < len(rest) and rest[at : at + size + 1] in train:
            size += 1
        phrases += 1
        at += max(size, 1)
    assert got == phrases


def shard_table(spark, rows, **kwargs):
    assigned, n = kdtree.assign(table(spark, rows), **kwargs)
    return kdtree.numbered(assigned, n).select("doc_id", "text", "_kd_size", "_kd_shard", "_kd_slot").toPandas(), n


def test_shards_are_even_whole_and_gapless(spark):
    rng = random.Random(2)
    rows = [(k, prose(k, rng.randrange(1, 60))) for k in range(600)] + [(1000 + k, prose(7, 5)) for k in range(200)]
    got, n = shard_table(spark, rows, n_shards=8)
    size = got.groupby("_kd_shard")._kd_size.sum()
    assert len(size) == 8 and size.max() < 1.15 * size.min()
    assert got.groupby("text")._kd_shard.nunique().max() == 1
    assert len(got) == len(rows) and (got._kd_size == got.text.str.len() + 1).all()
    for _, part in got.groupby("_kd_shard"):
        assert sorted(part._kd_slot) == list(range(len(part)))


def test_a_hot_text_is_divided_and_targets_give_shard_counts(spark):
    rows = [(k, "the same text in half of all rows") for k in range(500)] + [(1000 + k, prose(k, 8)) for k in range(400)]
    got, n = shard_table(spark, rows, target_bytes=4000)
    assert n == -(-int(got._kd_size.sum()) // 4000)
    size = got.groupby("_kd_shard")._kd_size.sum()
    assert size.max() < 1.6 * size.mean()


def test_many_shards_of_a_hot_text_are_even(spark):
    rows = [(k, "the same text for all of these rows" if k < 6000 else prose(k, 6)) for k in range(10_000)]
    docs = spark.createDataFrame([(i, t, "en", "s", "mine", 3, "x", 4) for i, t in rows], "doc_id BIGINT, text STRING, lang STRING, source STRING, _g1 STRING, _bucket INT, _piece STRING, _own_piece INT")
    assigned, n = kdtree.assign(docs, n_shards=256)
    placed = kdtree.numbered(assigned, n)
    assert set(docs.columns) <= set(placed.columns) and placed.where("_g1 <> 'mine' OR _bucket <> 3 OR _piece <> 'x' OR _own_piece <> 4").count() == 0
    sizes = [r.n for r in placed.groupBy("_kd_shard").agg(F.sum("_kd_size").alias("n")).collect()]
    assert len(sizes) == 256 and max(sizes) < 1.25 * sum(sizes) / 256


def test_reached_totals_stand_beside_the_targets(spark):
    texts, ratings = graded(spark, 60)
    weights = mixing.fit(table(spark, texts), ratings.selectExpr("doc_id", "concat('d', rating) as domain"))
    targets = {"d1": 2.0, "d2": 3.0, "d3": 5.0}
    got = {r.domain: r for r in mixing.totals(table(spark, texts), weights, targets).collect()}
    assert {d: round(r.wanted, 9) for d, r in got.items()} == {"d1": 0.2, "d2": 0.3, "d3": 0.5}
    rows = mixing.rates(table(spark, texts), weights, targets).collect()
    n = sum(x._mix_tokens for x in rows)
    for d, row in enumerate(got[name] for name in sorted(got)):
        assert row.reached == pytest.approx(sum(x._mix_tokens * x._mix_rate * x._mix_posterior[d] for x in rows) / n) and row.gap <= mixing.GAP
    assert mixing.totals(table(spark, texts), {}, targets).count() == 0


def test_shards_of_awkward_tables(spark):
    got, _ = shard_table(spark, AWKWARD, n_shards=3)
    assert len(got) == len(AWKWARD) and got._kd_shard.between(0, 2).all()
    for _, part in got.groupby("_kd_shard"):
        assert sorted(part._kd_slot) == list(range(len(part)))
    assert len(shard_table(spark, [], n_shards=3)[0]) == 0
    again, _ = shard_table(spark, AWKWARD, n_shards=3)
    key = lambda d: sorted(zip(d.doc_id.fillna(-1), d._kd_shard))
    assert key(got) == key(again)


def reference_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_the_library():
    rng = random.Random(3)
    parts = [*"aAb st'reвελ9²  \n\t\r .,!?'\"-_é́ 　日🙂", "'s", "'ll", "'re", " '", "<|endoftext|>", "  ", "n't"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 25))) for _ in range(1500)]
    texts += [f"a{chr(c)}{chr(c)} {chr(c)}b1{chr(c)}' s{chr(c)}" for c in range(1, 0x2400, 3)] + [prose(1, 300), "", "x" * 5000]
    encoder = token_store._Encoder(TOKENIZER)
    assert [x.tolist() for x in encoder.encode(texts)] == reference_ids(texts)


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(-(1 << 62), 1 << 62, n))
    assert sorted(token_store.PerfectHash.build(keys).slots(keys)) == list(range(len(keys)))


@pytest.mark.skipif((os.cpu_count() or 1) < 2 or not os.path.isdir("/proc/self/task"), reason="threads are not seen here")
def test_encoding_starts_no_threads_beside_its_task():
    """The library would start one for each of the host's cores in every Python worker."""
    code = (
        "import os, sys; from fundlake.llm import token_store as t; e = t._Encoder(sys.argv[1])\n"
        "texts = [f'word{i} other{i * 7} x{i % 13}' for i in range(3000)]; before = len(os.listdir('/proc/self/task'))\n"
        "ids = e.encode(texts); print(len(os.listdir('/proc/self/task')) - before, sum(map(len, ids)) > 9000)")
    env = {k: v for k, v in os.environ.items() if not k.startswith(("TOKENIZERS_", "RAYON_"))}
    ran = subprocess.run([sys.executable, "-c", code, public_tokenizers.path("byte_bpe_50k.json")], env=env, capture_output=True, text=True, timeout=120, check=True,
                         cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    assert ran.stdout.split() == ["0", "True"]


def test_token_store_round_trip(spark):
    texts = {k * 7 - 50: prose(k, k % 30) for k in range(150)} | {5000: None, 5001: "<|endoftext|> é 🙂"}
    manifest, folder = token_store.write(table(spark, texts), "doc_id", "text", TOKENIZER, 2, shard_rows=10)
    assert manifest.count() >= 16 and max(r.n_documents for r in manifest.collect()) == 10
    back = token_store.read(manifest, folder)
    assert back.rdd.getNumPartitions() == manifest.count()
    got = sorted(tuple(r) for r in back.collect())
    ids = [np.array([*x, 2], "<u4") for x in reference_ids([texts[k] or "" for k in sorted(texts)])]
    ends = np.cumsum([len(x) for x in ids])
    assert got == [(k, int(e) - len(x), len(x), zlib.crc32(x.tobytes())) for k, x, e in zip(sorted(texts), ids, ends)]
    found = token_store.lookup(manifest, folder, [-50, 5001, 3, 10**9])
    assert {k: v.tolist() for k, v in found.items()} == {k: ids[sorted(texts).index(k)].tolist() for k in (-50, 5001)}


def test_token_store_of_awkward_rows(spark):
    manifest, folder = token_store.write(table(spark, [r for r in AWKWARD if r[0] != 9]), "doc_id", "text", TOKENIZER, 2)
    got = sorted((r.key, r.start) for r in token_store.read(manifest, folder).collect())
    assert [k for k, _ in got] == [1, 2, 3, 4, 5, 6, 7, 8, 8] and len({s for _, s in got}) == 9
    manifest, folder = token_store.write(table(spark, []), "doc_id", "text", TOKENIZER, 2)
    assert token_store.read(manifest, folder).count() == 0


def graded(spark, n):
    """Texts of three grades, told by their share of bad words."""
    texts, ratings = {}, []
    for k in range(n):
        grade = k % 3
        texts[k] = f"{prose(k, 30)} {' '.join(['junk'] * (8 * (2 - grade)))} {'fine ' * (5 * grade)}"
        ratings.append((k, grade + 1))
    return texts, spark.createDataFrame(ratings, "doc_id BIGINT, rating INT")


def test_ordinal_model_orders_grades(spark):
    texts, ratings = graded(spark, 240)
    model = ordinal.fit(table(spark, texts), ratings.where("doc_id < 180"))
    assert model.grades.tolist() == [1, 2, 3] and model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in ordinal.grade(table(spark, texts), model, least=3).collect()}
    held = [k for k in texts if k >= 180]
    assert np.mean([round(got[k].expected_grade) == k % 3 + 1 for k in held]) > 0.9
    assert np.mean([got[k].kept == (k % 3 == 2) for k in held]) > 0.9
    kept = ordinal.select(table(spark, texts), model, least=3)
    assert {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept} and kept.columns == table(spark, texts).columns


def test_ordinal_model_of_awkward_rows(spark):
    texts, ratings = graded(spark, 30)
    model = ordinal.fit(table(spark, texts), ratings.union(spark.createDataFrame([(None, 1), (3, None), (999, 2)], ratings.schema)))
    assert ordinal.grade(table(spark, AWKWARD), model, 2).count() == len(AWKWARD)
    assert ordinal.fit(table(spark, texts), ratings.where("rating = 1")) is None
    assert ordinal.fit(table(spark, []), ratings) is None
    assert ordinal.fit(table(spark, texts), ratings.where("false")) is None
    assert ordinal.select(table(spark, AWKWARD), None, 2).count() == len(AWKWARD)
    assert ordinal.grade(table(spark, []), model, 2).count() == 0


def test_samples_are_bounded_and_spread(spark):
    texts, ratings = graded(spark, 600)
    n = labelled.sample(table(spark, texts), ratings, 200).count()
    assert 130 < n < 270


def test_rates_meet_targets(spark):
    texts, ratings = graded(spark, 150)
    domains = ratings.select("doc_id", F.concat(F.lit("d"), "rating").alias("domain"))
    weights = mixing.fit(table(spark, texts), domains)
    targets = {"d1": 0.2, "d2": 0.3, "d3": 0.5}
    rows = mixing.rates(table(spark, texts), weights, targets).collect()
    p, n, r = (np.array([x[c] for x in rows]) for c in ("_mix_posterior", "_mix_tokens", "_mix_rate"))
    assert (r >= 0).all() and np.allclose(n, [len(texts[x.doc_id].split()) for x in rows])
    assert np.allclose((p * (r * n)[:, None]).sum(0) / n.sum(), [0.2, 0.3, 0.5], atol=0.02)
    # The same minimum by plain projected gradient in one process.
    share = (p * n[:, None]).sum(0) / n.sum()
    plain = np.ones(len(r))
    for _ in range(4000):
        residual = ((p * (plain * n)[:, None]).sum(0) / n.sum() - [0.2, 0.3, 0.5]) / share
        plain = np.maximum(0, plain - 0.9 * (p @ residual + mixing.RIDGE * (plain - 1)))
    assert np.abs(plain - r).max() < 0.05
    mixed = mixing.mix(table(spark, texts), weights, targets)
    counts = {x.doc_id: x["count"] for x in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == table(spark, texts).columns
    assert all(int(x._mix_rate) <= counts.get(x.doc_id, 0) <= int(x._mix_rate) + 1 for x in rows)


@pytest.mark.parametrize("spread", [0.01, 0.03])
def test_rates_of_weakly_separated_domains_are_optimal(spark, spread):
    rng = np.random.default_rng(5)
    p = np.clip(0.11 + spread * rng.standard_normal(2000), 0.001, 0.999)
    p, n = np.stack((p, 1 - p), 1), rng.integers(1, 200, 2000)
    wanted = np.array([0.2, 0.8])
    points = spark.createDataFrame([(int(x), y.tolist()) for x, y in zip(n, p)], "_mix_tokens BIGINT, _mix_posterior ARRAY<DOUBLE>")
    g, reached, gap = mixing.solve(points, wanted)
    w = n / n.sum()
    share = w @ p
    rates = np.array([r[0] for r in points.select(mixing._rate(g)).collect()])
    residual = (w * rates) @ p - wanted
    moved = np.maximum(0, rates - (p @ (residual / share) + mixing.RIDGE * (rates - 1)))
    assert gap <= mixing.GAP and np.allclose(reached, (w * rates) @ p) and np.abs(moved - rates).max() < 1e-4


def test_mixing_of_awkward_rows(spark):
    texts, ratings = graded(spark, 30)
    weights = mixing.fit(table(spark, texts), ratings.selectExpr("doc_id", "concat('d', rating) as domain"))
    assert mixing.rates(table(spark, AWKWARD), weights, {"d1": 1.0, "other": 3.0}).count() == len(AWKWARD)
    assert mixing.rates(table(spark, []), weights, {"d1": 1.0}).count() == 0
    assert mixing.fit(table(spark, texts), ratings.where("false").selectExpr("doc_id", "'d' as domain")) == {}
    assert mixing.mix(table(spark, AWKWARD), {}, {"d1": 1.0}).count() == len(AWKWARD)


def toxic_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        w = prose(seed * 10_000 + k, 60).split()
        toxic = k % 4 == 0
        for _ in range(3 if toxic else 0):
            w[rng.randrange(60)] = rng.choice(["qworthless", "zpathetic", "xdisgusting"])
        rows.append((k, " ".join(w), int(toxic)))
    return rows


def test_toxicity_of_held_out_texts(spark):
    train, probe = toxic_rows(400, 1), toxic_rows(200, 2)
    model = toxicity.fit(table(spark, [r[:2] for r in train]), spark.createDataFrame([(r[0], r[2]) for r in train], "doc_id BIGINT, label INT"))
    got = {r.doc_id: r for r in toxicity.score(table(spark, [r[:2] for r in probe]), model).collect()}
    assert np.mean([got[i].predicted == y for i, _, y in probe]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_savings_equal_windows_compressed_one_by_one():
    ordinary, toxic = b"the and of to in that ordinary words ", b"the and of to in that ordinary words   worthless  loser "
    texts = ["", "a", "The worthless text of that LOSER and others " * 3, prose(1, 70), "loser", "é" * 100]
    block = next(text.blocks(pa.array(texts)))
    want = []
    for t in texts:
        data = t.translate({c: c + 32 for c in range(65, 91)}).encode()
        found = [0]
        for a in range(0, max(len(data) - toxicity.WINDOW_BYTES, 0) + toxicity.STEP_BYTES, toxicity.STEP_BYTES):
            window = data[a : a + toxicity.WINDOW_BYTES]
            if window and (a == 0 or a + toxicity.WINDOW_BYTES - toxicity.STEP_BYTES < len(data)):
                sizes = [len(zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False).compress(window)) for d in (ordinary, toxic)]
                found.append(sizes[0] - sizes[1])
        want.append(max(found))
    assert toxicity.savings(block, toxicity.Model(ordinary, toxic, ())).tolist() == want and want[2] > 3


def test_evidence_is_a_bound_on_the_binomial_tail():
    for n in (1, 3, 10, 40):
        for share in (0.05, 0.3):
            for x in range(n + 1):
                tail = sum(math.comb(n, k) * share**k * (1 - share) ** (n - k) for k in range(x, n + 1))
                bound = math.exp(-float(toxicity.evidence(np.array([float(x)]), np.array([float(n)]), share)[0]))
                assert bound >= tail * (1 - 1e-9) and (x < n or bound == pytest.approx(tail))


def test_a_family_of_alike_texts_brings_in_few_words():
    # Words 0-3 each in other toxic texts, words 4-9 all in the same eight; word 10 everywhere.
    entries = [(w, 20 * w + t, 1.0) for w in range(4) for t in range(20)] + [(w, 100 + t, 1.0) for w in range(4, 10) for t in range(8)] + [(10, t, float(t < 108)) for t in range(400)]
    words, texts, toxic = (np.array(x) for x in zip(*entries))
    order = [w for w, _ in toxicity._taken(words, texts, toxic, np.ones(11), 0.2, math.log(1000 / 0.05), np.full(11, 8))]
    assert set(order[:4]) == {0, 1, 2, 3} and len([w for w in order if 4 <= w < 10]) == 1 and 10 not in order


def test_few_texts_suffice_and_phrases_are_found(spark):
    """A small sample with phrases of several words; half of the labels of plain text are wrong one time in ten."""
    rng = random.Random(12)
    phrases = ["go drown yourself", "utter waste of skin", "nobody wants you here"]
    rows = []
    for k in range(600):
        w = prose(90_000 + k, 50).split()
        bad = k % 5 == 0
        if bad:
            w[rng.randrange(40)] = rng.choice(phrases)
        rows.append((k, " ".join(w), int(bad or rng.random() < 0.05), bad))
    train, probe = rows[:300], rows[300:]
    model = toxicity.fit(table(spark, [r[:2] for r in train]), spark.createDataFrame([(r[0], r[2]) for r in train], "doc_id BIGINT, label INT"))
    got = {r.doc_id: r for r in toxicity.score(table(spark, [r[:2] for r in probe]), model).collect()}
    caught = [got[i].predicted for i, _, _, bad in probe if bad]
    alone = [1 - got[i].predicted for i, _, _, bad in probe if not bad]
    assert len({r.score for r in got.values()}) > 1 and np.mean(caught) > 0.8 and np.mean(alone) > 0.95


def test_toxicity_of_awkward_rows(spark):
    train = toxic_rows(60, 3)
    labels = spark.createDataFrame([(r[0], r[2]) for r in train] + [(None, 1), (5, None), (999, 1)], "doc_id BIGINT, label INT")
    docs = table(spark, [r[:2] for r in train])
    model = toxicity.fit(docs, labels)
    odd = toxicity.score(table(spark, AWKWARD), model).collect()
    assert len(odd) == len(AWKWARD) and min(r.score for r in odd) == {(r.doc_id): r.score for r in odd}[1]
    assert toxicity.fit(docs, labels.where("label = 0")) is None and toxicity.fit(docs, labels.where("false")) is None
    assert {r.score for r in toxicity.score(table(spark, AWKWARD), None).collect()} == {0.0}
    assert toxicity.score(table(spark, []), model).count() == 0
