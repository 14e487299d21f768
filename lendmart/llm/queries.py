"""Queries over the corpus tables, with their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmart.llm import (bpe, exact_dedup, hard_negatives, licenses, mixing, ngram_lm, packing, pii, quality_cnn, quality_rules, simhash, toxicity,
                          whitening)
from lendmart.llm.texts import read_table

KEEP_SCORE = 0.3
TOXIC_SCORE = 0.5
TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path and word pattern of a byte-level vocabulary."""
    import public_tokenizers
    return public_tokenizers.path(name), public_tokenizers.PATTERN


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


@query("op1_pii")
def pii_query(spark, sf_dir):
    spans = F.col("pii")
    base = F.filter(spans, lambda s: s["kind"].isin([k.name for k in pii.KINDS if k.base]))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    found = pii.find_spans(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *(count(k.name).alias(f"n_{k.name}") for k in pii.KINDS), F.sha2(pii.listed(base), 256).alias("base_sha256"),
                        pii.listed(spans).alias("spans"), F.transform(spans, lambda s: s["score"]).alias("scores"))


@query("op2_exact_dedup", """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM n""")
def exact_dedup_query(spark, sf_dir):
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


@query("op3_ngram_lm")
def ngram_lm_query(spark, sf_dir):
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    scores = ngram_lm.score_documents(read_table(spark, sf_dir, "documents"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op4_licenses")
def licenses_query(spark, sf_dir):
    return licenses.scan_documents(read_table(spark, sf_dir, "documents"))


@query("op5_bpe")
def bpe_query(spark, sf_dir):
    coded = bpe.round_trip(read_table(spark, sf_dir, "documents"), tokenizer_path(), packed=True)
    return coded.select("doc_id", F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"),
                        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op6_packing")
def packing_query(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), *byte_vocabulary())


@query("op7_mixing")
def mixing_query(spark, sf_dir):
    mixed = mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", "mix.epoch", "mix.block", "mix.position")


@query("op8_quality_cnn")
def quality_cnn_query(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    # A row without doc_id is never learned from.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    net = quality_cnn.fit_labelled(docs, read_table(spark, sf_dir, "labels").where(~held_out))
    scored = quality_cnn.score_documents(docs, net)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def _prior(failed: str) -> str:
    """Mean and strength of the beta prior over hosts."""
    return f"""(SELECT mean, greatest(CASE WHEN n > 1 AND spread > 0 THEN mean * (1 - mean) / spread - 1 ELSE 1 END, 1) AS strength
      FROM (SELECT least(greatest(sum({failed}) / sum(n_docs), 1e-6), 1 - 1e-6) AS mean, var_pop({failed} / n_docs) AS spread, count(*) AS n FROM hosts))"""


RULES_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS rid FROM {docs}),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(5) r(k) GROUP BY rid),
m AS (SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN covered c ON c.rid = w.rid),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        CAST(n_words < 10 AS INT) + CAST(100 * n_repeat_words > 20 * n_words AS INT) + CAST(5 * n_symbols > n_words AS INT) + CAST(n_dup_lines > 3 AS INT)
        + CAST(word_chars < 2 * n_words OR word_chars > 15 * n_words AS INT) AS failures FROM m),
hosts AS (SELECT source, count(*) AS n_docs, count(*) FILTER (base_failed) AS n_base, count(*) FILTER (failures >= 2) AS n_several FROM f GROUP BY source),
hosts_rated AS (SELECT source, n_docs, a.mean AS mean_a, b.mean AS mean_b, a.strength AS weight_a, b.strength AS weight_b,
        (n_base + a.mean * a.strength) / (n_docs + a.strength) AS base_rate, (n_several + b.mean * b.strength) / (n_docs + b.strength) AS several_rate
      FROM hosts, """ + _prior("n_base") + " a, " + _prior("n_several") + r""" b),
low AS (SELECT *, base_rate - 1.645 * sqrt(base_rate * (1 - base_rate) / (n_docs + weight_a + 1)) AS low_a,
        several_rate - 1.645 * sqrt(several_rate * (1 - several_rate) / (n_docs + weight_b + 1)) AS low_b FROM hosts_rated),
v AS (SELECT source, base_rate, (low_a > 0.3 AND low_a / (1 - low_a) > 3 * mean_a / (1 - mean_a)) OR (low_b > 0.3 AND low_b / (1 - low_b) > 3 * mean_b / (1 - mean_b)) AS rejected FROM low)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept,
       round(base_rate, 6) AS host_rate, rejected AS host_rejected
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source"""


def _judged(docs, host: str = "source"):
    judged = quality_rules.judge(docs, host, columns=["doc_id"])
    q = F.col("quality")
    measured = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rejected")
    return judged.select("doc_id", *(q[c].alias(c) for c in measured), F.round(q["host_rate"], 6).alias("host_rate"))


@query("op9_quality_rules", RULES_SQL.replace("{docs}", "documents"))
def quality_rules_query(spark, sf_dir):
    return _judged(read_table(spark, sf_dir, "documents"))


# Some sources divided by length, so that one part of them is a host of short junk.
@query("quality_rules_by_section", RULES_SQL.replace("{docs}", """(SELECT doc_id, text, CASE WHEN source IN ('src1', 'src2') AND coalesce(length(text), 0) < 200 THEN 'short' ELSE source END AS source FROM documents)"""))
def quality_rules_by_section_query(spark, sf_dir):
    short = F.col("source").isin("src1", "src2") & (F.coalesce(F.char_length("text"), F.lit(0)) < 200)
    docs = read_table(spark, sf_dir, "documents").withColumn("section", F.when(short, "short").otherwise(F.col("source")))
    return _judged(docs, "section")


@query("op10_simhash")
def simhash_query(spark, sf_dir):
    groups = simhash.simhash_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hexadecimal(F.col("bits")).alias("fingerprint"), "component_id")


@query("op11_hard_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS found_id, a.label = c.label AS same, CAST(list_inner_product(a.vec, c.vec) AS BIGINT) AS score
      FROM v a, v c WHERE a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, found_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, found_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, found_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, found_id) QUALIFY row_number() OVER w <= 10""")
def hard_negatives_query(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", hard_negatives.whole_components("embedding").alias("vector"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


@query("op12_whitening")
def whitening_query(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


@query("op13_toxicity")
def toxicity_query(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    # A row without doc_id is never learned from.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    model = toxicity.fit_labelled(docs, read_table(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"))
