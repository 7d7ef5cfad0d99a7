"""The operators over the test tables, with production parameters, and SQL where it can express them."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apexlake.llm import (
    bpe, byte_bpe, centroids, decontaminate, html_text, importance, kneser_ney, licenses, passages, pii, quality, simhash,
)
from apexlake.llm.common import read_table
from apexlake.session import write_once

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.tiktoken"
# The secret key of a real run comes from the environment of the driver.
PII_KEY = os.environ.get("APEXLAKE_PII_KEY", "example key: set your own")
CONTEXT_LIMIT = 2048
SIMHASH = {"shingle": 4, "max_bits": 4}
CLUSTERS = {"k": 40, "rounds": 5, "dim": 64, "scale": 256.0, "seed": 2}
RESAMPLING = {"percent": 10, "least_words": 20, "seed": 2024, "longest": 1, "buckets": 10_000}

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, as ``--py-files`` would.

    The archive stays on the driver until it ends, for executors that join late.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="apexlake-package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        held = Path(folder, "content", package.name)
        shutil.copytree(package, held, ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", held.parent))
        _shipped.add(context.applicationId)


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    shipped.__name__, shipped.__doc__ = run.__name__, run.__doc__
    return shipped


def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    model = kneser_ney.train(docs.where(~held_out))
    return kneser_ney.score(model, docs).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, classes = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), **SIMHASH)
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(read_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.vote(quality.measure(read_table(spark, sf_dir, "documents").select("doc_id", "text")))
    voted = write_once(measured.drop("text"), "votes")
    return quality.judge(voted, quality.fit(voted)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_digest(docs, public_tokenizers.path(TOKENIZER)).drop("text")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = bpe.count_tokens(docs, public_tokenizers.path(TOKENIZER))
    return counted.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > CONTEXT_LIMIT).alias("over_limit"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY).select("doc_id", "text", F.size("pii_kinds").cast("bigint").alias("n_replaced"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"), **CLUSTERS).drop("centroid")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.encode_digest(docs, public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.PATTERN).drop("text")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), **RESAMPLING)


_DEALT = (
    op1_language_model, op2_html_text, op3_simhash, op4_licenses, op5_passages, op6_decontamination,
    op7_quality, op8_bpe, op9_token_counts, op10_pii, op11_centroids, op12_byte_bpe, op13_importance,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _query(f) for f in _DEALT}


def _resampling_sql(percent: int, least_words: int, seed: int, longest: int, buckets: int) -> str:
    """Features of one word; CRC-32 byte by byte over each distinct word."""
    assert longest == 1
    shift = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
    steps = "".join(f", t{k} AS (SELECT b, {shift.format('v')} AS v FROM t{k - 1})" for k in range(1, 9))
    return f"""
WITH t0 AS (SELECT b, b AS v FROM (SELECT unnest(range(0, 256)) AS b)){steps},
crc AS (SELECT list(v ORDER BY b) AS t FROM t8),
docs AS (SELECT row_number() OVER () AS place, doc_id, {_WORDS} FROM documents),
found AS (SELECT place, unnest(w) AS word FROM docs),
wanted AS (SELECT unnest(w) AS word FROM (SELECT {_WORDS} FROM benchmark)),
spelt AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM found UNION SELECT word FROM wanted)),
hashed AS (
    SELECT word, xor(list_reduce(
        list_prepend(4294967295::BIGINT, [('0x' || h[2 * i - 1:2 * i])::BIGINT FOR i IN range(1, len(h) // 2 + 1)]),
        lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % {buckets} AS bucket
    FROM spelt, crc),
source AS (SELECT bucket, count(*) AS s FROM found JOIN hashed USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (word) GROUP BY bucket),
sizes AS (SELECT (SELECT count(*) FROM found) AS s_all, (SELECT count(*) FROM wanted) AS t_all),
gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + {buckets}) / ((s + 1)::DOUBLE * (t_all + {buckets}))))::BIGINT AS gain
    FROM source LEFT JOIN target USING (bucket), sizes),
weights AS (
    SELECT place, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM found JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY place),
scored AS (
    SELECT place, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || sha256('{seed}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM docs LEFT JOIN weights USING (place)),
ranked AS (
    SELECT place, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS rank
    FROM scored WHERE n_features >= {least_words})
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= (SELECT {percent} * count(*) // 100 FROM ranked) THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (place)"""


def _clusters_sql(k: int, rounds: int, dim: int, scale: float, seed: int) -> str:
    """Every round as one comparison of all vectors with all centroids."""
    parts = [f"""
v AS MATERIALIZED (
    SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x
    FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), vec_id) - 1 AS c, x AS y
    FROM v QUALIFY c < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (
    SELECT place, min(ROW(d, c)) AS best
    FROM (SELECT place, c, list_sum(list_transform(list_zip(x, y), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{r})
    GROUP BY place)""")
        if r < rounds:
            parts.append(f"""
c{r + 1} AS MATERIALIZED (
    SELECT c, coalesce(z, y) AS y
    FROM c{r} LEFT JOIN (
        SELECT c, list(m ORDER BY i) AS z
        FROM (
            SELECT c, i, ((sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
            FROM (SELECT best[2] AS c, unnest(x) AS e, unnest(range(0, {dim})) AS i FROM v JOIN a{r} USING (place)) GROUP BY c, i)
        GROUP BY c) USING (c))""")
    return f"""
WITH {",".join(parts)}
SELECT vec_id, best[2]::INT AS cluster, best[1]::BIGINT AS distance, (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia,
       (sum(best[1]) OVER ())::BIGINT AS inertia, sha256(array_to_string(y, ',')) AS centroid_sha256
FROM v JOIN a{rounds} USING (place) JOIN c{rounds} ON c = best[2]"""


_WORDS = (
    "coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w")
# What SQL can express. The others rest on tokenizers, hashes, iteration or alignment and are tested against brute force.
SQL: dict[str, str] = {
    "op6_decontamination": f"""
WITH docs AS (SELECT doc_id, {_WORDS} FROM documents),
items AS (SELECT item_id::VARCHAR AS id, {_WORDS} FROM benchmark),
phrases AS (
    SELECT DISTINCT id, least(len(w), 13) AS n, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS p
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
places AS (
    SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS p
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM docs, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, n, id FROM places JOIN phrases USING (n, p)),
covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT id)) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_centroids": _clusters_sql(**CLUSTERS),
    "op13_importance": _resampling_sql(**RESAMPLING),
}
