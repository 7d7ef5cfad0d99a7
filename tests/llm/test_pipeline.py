"""The pipeline on a small table, stage by stage against plain Python."""

import hashlib
import math
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import xxhash
from apexlake.llm import decontaminate, quality
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.write_once(stage(spark, docs, SF), "test-stage")
        out.append((before, docs))
    return out


def test_columns(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns


def test_quality_keeps_long_clean_rows(spark, stages):
    before, after = stages[0]
    good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").join(before, "doc_id")
    lost = good.join(after, "doc_id", "left_anti").where("size(split(trim(text), '\\\\s+')) >= 10")
    assert lost.count() == 0 and 0 < after.count() < before.count()


def test_no_equal_texts_after_deduplication(stages):
    before, after = stages[1]
    assert after.count() == after.select("text").distinct().count() < before.count()


def test_no_contamination_left(spark, stages):
    _, after = stages[2]
    assert decontaminate.contamination(after, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").count() == 0


def test_rows_survive_the_last_stages(stages):
    assert stages[3][0].count() == stages[3][1].count() == stages[4][1].count()
    assert stages[4][1].where("n_tokens <> size(token_ids)").count() == 0


# Hard rows, stage by stage against plain Python

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, fp int, _hit string, _pii_text string, vote_symbols int, n_words string"
WORDS = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnrst"]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


@pytest.fixture(scope="module")
def hard(spark):
    benchmark = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = next(t for t in benchmark if len(decontaminated_words(t)) >= 13)
    long = prose(60_000, 1)
    texts = [
        (1, None), (2, ""), (3, " \t\n"), (4, "short text"), (5, long), (6, long + " end"), (7, prose(60, 2)), (7, prose(60, 2)), (7, prose(60, 3)),
        (None, prose(60, 4)), (None, None), (8, prose(60, 2)), (9, f"{prose(20, 5)} {leaked} {prose(20, 6)}"), (9, f"{prose(20, 5)} {leaked} {prose(20, 6)}"),
        (10, f"{prose(40, 7)} write to anna.b@example.com or 4111 1111 1111 1111 {prose(5, 8)}"), (11, "#$%& <> || " * 30), (12, "same words here again and over " * 20),
        (13, f"{prose(30, 9)} {long[:300_000]}"),
    ]
    rows = [(i, t, "en", "s", None if t is None else len(t), "k", 5, "h", "p", 3, "w") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


def decontaminated_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def bag(df, columns=None):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def test_quality_stage(spark, hard):
    kept = corpus_pipeline.quality_rules(spark, hard, SF)
    assert kept.columns == hard.columns
    votes = quality.vote(quality.measure(hard.select("doc_id", "text"))).collect()
    model, rules = quality.fit(quality.vote(quality.measure(hard.select("text")))), quality.RULES
    expected = Counter()
    for r in votes:
        odds = math.log(model.prior / (1 - model.prior)) + sum(
            {None: 0, 1: 1, 0: -1}[r[f"vote_{k}"]] * math.log(model.accuracy[k] / (1 - model.accuracy[k])) for k in rules)
        own = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        windows = Counter(tuple(own[i:i + 5]) for i in range(len(own) - 4))
        inside = {i + k for i in range(len(own) - 4) if windows[tuple(own[i:i + 5])] > 1 for k in range(5)}
        if len(own) >= 10 and 100 * len(inside) <= 20 * len(own) and odds >= 0:
            expected[r["doc_id"], r["text"]] += 1
    assert bag(kept, ["doc_id", "text"]) == expected and kept.where("key <> 'k' OR vote_symbols <> 3 OR n_words <> 'w'").isEmpty()


def test_near_duplicate_stage(spark, hard):
    kept = corpus_pipeline.near_duplicates(spark, hard, SF)
    rows = hard.select("doc_id", "text").collect()

    def fingerprint(text):
        own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        shingles = [" ".join(own[i:i + 4]) for i in range(max(1, len(own) - 3))] if own else []
        hashes = np.array([xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles], np.uint64)
        return sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes))

    prints = [fingerprint(r["text"]) for r in rows]
    part = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= 4:
                    part[i] = part[j] = min(part[i], part[j])
    groups = {}
    for r, p in zip(rows, part):
        groups.setdefault(p, []).append(r)
    got = kept.collect()
    assert kept.columns == hard.columns and len(got) == len(groups)
    for members in groups.values():
        ids = [r["doc_id"] for r in members if r["doc_id"] is not None]
        texts = {r["text"] for r in members if r["doc_id"] == (min(ids) if ids else None)}
        assert sum(1 for r in got if r["doc_id"] == (min(ids) if ids else None) and r["text"] in texts) == 1


def test_decontamination_stage(spark, hard):
    items = [decontaminated_words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[i:i + min(13, len(w))]) for w in items if w for i in range(max(1, len(w) - 12))}
    sizes = {len(w) for w in windows}

    def contaminated(text):
        own = decontaminated_words(text)
        hit = {i + k for n in sizes for i in range(len(own) - n + 1) if tuple(own[i:i + n]) in windows for k in range(n)}
        return len(hit) > 0 and 20 * len(hit) >= len(own)

    expected = Counter((r["doc_id"], r["text"]) for r in hard.collect() if not contaminated(r["text"]))
    kept = corpus_pipeline.decontamination(spark, hard, SF)
    assert kept.columns == hard.columns and bag(kept, ["doc_id", "text"]) == expected
    assert 9 not in {r["doc_id"] for r in kept.collect()}


def test_personal_data_stage(spark, hard):
    changed = corpus_pipeline.personal_data(spark, hard, SF)
    others = [c for c in hard.columns if c not in ("text", "n_chars")]
    assert changed.columns == hard.columns and bag(changed, others) == bag(hard, others)
    before, after = ({r["doc_id"]: r["text"] for r in df.where("doc_id = 10").collect()}[10] for df in (hard, changed))
    assert "anna.b@" not in after and "4111 1111" not in after and len(after) == len(before)
    untouched = "doc_id <> 10 OR doc_id IS NULL"
    assert bag(changed.where(untouched)) == bag(hard.where(untouched))
    assert corpus_pipeline.personal_data(spark, hard.drop("n_chars"), SF).columns == hard.drop("n_chars").columns


def test_encoding_stage(spark, hard):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation(), library.no_padding()
    expected = Counter()
    for r in hard.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        digest = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        expected[r["doc_id"], len(ids), tuple(ids), digest] += 1
    got = corpus_pipeline.encoding(spark, hard, SF).collect()
    assert Counter((r["doc_id"], r["n_tokens"], tuple(r["token_ids"]), r["decoded_sha256"]) for r in got) == expected


def test_every_stage_takes_an_empty_table(spark, hard):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, hard.limit(0), SF)
        assert out.columns == hard.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, hard.limit(0), SF).count() == 0
