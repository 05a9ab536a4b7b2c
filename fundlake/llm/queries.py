"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm import compression, decontaminate, disclosure, kdtree, language, mixing, neardup, ordinal, periodic, repeats, token_store, toxicity, turns
from fundlake.llm.labelled import crc_mod

#: Domains of `labels` (quality and toxic as q*t*) and the shares of words wanted of them.
DOMAIN_TARGETS = {"q1t0": 0.90, "q0t0": 0.06, "q1t1": 0.03, "q0t1": 0.01}
N_SHARDS = 8
END_ID = 2


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every (document, benchmark item) pair with containment of 0.75 or more."""
    found = decontaminate.containments(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_shared", "n_item")


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    samples = language.learn(docs.where(~F.coalesce(held_out, F.lit(False))).select("text", "lang"))
    found = language.identify(docs, samples)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang", "source", crc)
    assigned, n_shards = kdtree.assign(docs, n_shards=N_SHARDS)
    narrow = assigned.select("doc_id", "text_crc32", "_kd_size", "_kd_shard")
    return kdtree.numbered(narrow, n_shards).select(
        "doc_id", F.col("_kd_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"), F.col("_kd_shard").alias("shard"),
        F.col("_kd_slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op4_token_store(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    manifest, shards = token_store.write(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return token_store.read(manifest, shards).withColumnRenamed("key", "doc_id")


def op5_quality_grades(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = ordinal.fit(docs, _table(spark, folder, "labels").select("doc_id", F.col("quality").alias("rating")))
    return ordinal.grade(docs, model, least=1).select("doc_id", "expected_grade", "tail_probability", "kept")


def op6_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    return compression.judge(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "bad_chunks")


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words and rate of every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    weights = mixing.fit(docs, domains(spark, folder))
    rated = mixing.rates(docs, weights, DOMAIN_TARGETS)
    return rated.select("doc_id", F.col("_mix_tokens").alias("n_tokens"), F.col("_mix_posterior").alias("posterior"), F.col("_mix_rate").alias("rate"))


def domains(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, domain) of `labels`."""
    labels = _table(spark, folder, "labels").where("quality is not null and toxic is not null")
    return labels.select("doc_id", F.format_string("q%dt%d", "quality", "toxic").alias("domain"))


def op8_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove(_table(spark, folder, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    labels = _table(spark, folder, "labels").where(~held_out).select("doc_id", F.col("toxic").alias("label"))
    return toxicity.score(docs, toxicity.fit(docs, labels)).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest edits of every conversation after the damage that ``damaged`` does."""
    rows = _table(spark, folder, "conversations")
    return turns.repair(damaged(rows), everyone=rows)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows lost, emptied, cut, repeated or given the role user, by a checksum of conversation and turn."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    hit = F.col("_hit")
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("_hit")).where(hit != 0)
    copies = F.array_repeat(F.lit(0), F.when(hit == 3, 2).otherwise(1))
    return marked.select(
        "conv_id", "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("_copy")).drop("_copy")


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of words of every document, a tenth of which get a periodic tail first."""
    found = periodic.find(with_tails(_table(spark, folder, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("from"), (-r.period).alias("step"))))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.from")).alias("start"), F.col("_best.length").alias("length"),
        (-F.col("_best.step")).alias("period"), F.floor(1000 * F.col("_best.length") / -F.col("_best.step")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def with_tails(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by a checksum of its id, repeats the words from some place on."""
    planted = """CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 10 = 0 THEN
      array_join(transform(array(named_struct('w', regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0), 'g', crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) div 10)),
        v -> CASE WHEN size(v.w) = 0 THEN '' ELSE array_join(transform(sequence(0, size(v.w) - 1), i -> CASE WHEN i < v.g % size(v.w) THEN v.w[i] ELSE
          v.w[CAST(v.g % size(v.w) + (i - v.g % size(v.w)) % (1 + (size(v.w) - v.g % size(v.w)) div (3 + v.g % 8)) AS INT)] END), ' ') END), '')
      ELSE text END"""
    return docs.select("doc_id", F.expr(planted).alias("text"))


def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document, and the words that reveal it."""
    found = disclosure.find(_table(spark, folder, "documents"))
    kinds = F.array(*[F.lit(kind) for kind in disclosure.KINDS])
    place = lambda kind, s: F.struct(s["start"].alias("start"), F.array_position(kinds, kind).alias("rank"), s["end"].alias("end"), kind.alias("kind"))
    joined = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.transform("base", lambda s: place(s["kind"], s))
    terms = F.transform("terms", lambda s: place(F.lit("term"), s))
    of_kind = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [of_kind(kind).alias(f"n_{kind}") for kind in disclosure.KINDS[:-1]]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.concat(base, terms)).alias("spans"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

OP1_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM b)),
size AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
hit AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item FROM hit JOIN size USING (item_id) WHERE n_shared >= 0.75 * n_item
"""

OP10_SQL = rf"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.other = link.a)
SELECT doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_language": op2_language,
    "op3_kd_shards": op3_kd_shards,
    "op4_token_store": op4_token_store,
    "op5_quality_grades": op5_quality_grades,
    "op6_compression_bands": op6_compression_bands,
    "op7_mixing": op7_mixing,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_toxicity": op9_toxicity,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_personal_data": op13_personal_data,
}
SQL = {"op1_decontamination": OP1_SQL, "op10_near_duplicates": OP10_SQL}
