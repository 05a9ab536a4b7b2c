import collections

import pytest

import corpus_pipeline
from fundlake.llm import queries
from tests.llm.cases import components, prose, rows_of, shingles


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder with documents, labels and benchmark; texts by id and what each is."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    item = prose(7777, 20)
    texts = {k: prose(k, 60 + k % 40) for k in range(120)}
    texts |= {200 + k: " ".join(f"{w}$$$" for w in prose(300 + k, 60).split()) for k in range(40)}
    texts |= {300 + k: texts[k] for k in range(10)} | {320 + k: f"{texts[k + 20]} tail" for k in range(10)}
    texts |= {400 + k: f"{prose(700 + k, 30)} {item} {prose(800 + k, 30)}" for k in range(6)}
    rows = [*texts.items(), (500, None), (501, ""), (None, prose(990, 50)), (0, texts[0])]
    spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in rows], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 0 if 200 <= i < 300 else 1, int(i % 9 == 0)) for i in texts if i % 2 == 0], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, item


def test_stages_take_effect(spark, corpus):
    folder, texts, item = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        ids[name] = collections.Counter(r[0] for r in docs.select("doc_id").collect())
        assert name == "sharding" or docs.columns == columns
    assert not {i for i in ids["quality"] if i and 200 <= i < 300}
    clean = {i for i in texts if not 200 <= i < 300}
    assert clean <= set(ids["quality"])
    left = {i: t for i, t in texts.items() if i in ids["quality"]}
    leaders = set(components(left).values())
    assert {i for i in ids["near_duplicates"] if i is not None and i < 500} == leaders and max(ids["near_duplicates"].values()) == 1
    assert ids["near_duplicates"][None] == 1  # the row without an id has a text of its own
    dirty = {i for i in leaders if len(shingles(item) & shingles(texts[i])) >= 0.75 * len(shingles(item))}
    assert len(dirty) == 6 and set(ids["near_duplicates"]) - set(ids["decontamination"]) == dirty
    assert set(ids["mixture"]) <= set(ids["decontamination"]) and max(ids["mixture"].values()) <= 3
    assert ids["sharding"] == ids["mixture"]
    placed = docs.select("shard", "slot").collect()
    by_shard = collections.defaultdict(list)
    for shard, slot in placed:
        by_shard[shard].append(slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values()) and max(by_shard) < 8


def test_stages_of_an_empty_corpus(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "conv_id BIGINT, turn BIGINT, role STRING, text STRING").write.parquet(f"{folder}/conversations.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
    for name, query in queries.QUERIES.items():
        assert query(spark, folder).count() == 0, name


def test_queries_return_their_columns(spark, corpus):
    folder, texts, _ = corpus
    n = len(rows_of(texts)) + 4
    wanted = {
        "op2_language": ["doc_id", "held_out", "lang_pred", "score"],
        "op3_kd_shards": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op4_token_store": ["doc_id", "start", "n_tokens", "ids_crc32"],
        "op5_quality_grades": ["doc_id", "expected_grade", "tail_probability", "kept"],
        "op6_compression_bands": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
        "op7_mixing": ["doc_id", "n_tokens", "posterior", "rate"],
        "op8_repeated_passages": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op9_toxicity": ["doc_id", "held_out", "score", "predicted"],
        "op10_near_duplicates": ["doc_id", "n_shingles", "component_id", "kept"],
        "op12_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
        "op13_personal_data": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    }
    for name, columns in wanted.items():
        got = queries.QUERIES[name](spark, folder)
        assert got.columns[: len(columns)] == columns
        assert got.count() == n - (name == "op4_token_store")  # a document without key is not stored
