"""The pipeline's stages on odd rows and on nothing."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from trajlake.llm import lang_backoff
from trajlake.llm.shared import write_stage

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid long, shard int, _copies int"
VOCABULARY = {"en": ["the", "house", "and", "water", "over", "green"], "de": ["das", "haus", "und", "wasser", "ueber", "gruen"]}


def prose(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choice(VOCABULARY[lang]) + str(rng.randint(0, 99)) * rng.randint(0, 1) for _ in range(n))


def write(spark, path, docs, items):
    spark.createDataFrame(docs, SCHEMA).coalesce(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and very long texts, copies, repeated rows, clashing names; each stage against plain rules."""
    rng = random.Random(8)
    item, copy = prose(rng, "en", 30), prose(rng, "de", 90)
    rest = (1, 1, 1, 1)
    rows = [(1, copy, "de", "a", *rest), (2, copy, "de", "a", *rest), (2, copy, "de", "a", *rest), (3, None, "en", "a", *rest), (4, "", "en", None, *rest),
            (5, "12 34", "en", "b", *rest), (None, prose(rng, "en", 40), None, None, None, None, None, None), (7, prose(rng, "en", 20000), "en", "b", *rest),
            (8, prose(rng, "en", 10) + " " + item + " " + prose(rng, "en", 10), "en", "b", *rest)]
    rows += [(100 + i, prose(rng, lang, rng.randint(20, 60)), lang, rng.choice("abc"), *rest) for i, lang in enumerate(["en", "de"] * 30)]
    sf = write(spark, tmp_path, rows, [(1, item), (2, None), (3, "")])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = {"": [tuple(r) for r in docs.collect()]}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert name == "sharding" or out.columns == docs.columns
        docs = write_stage(out, name)
        found[name] = [tuple(r) for r in docs.collect()]
    read = {r["uid"]: r for r in lang_backoff.identify(spark.read.parquet(f"{sf}/documents.parquet"), lang_backoff.learn(
        spark.read.parquet(f"{sf}/documents.parquet"))).collect()}
    accepted = Counter(r["doc_id"] for r in read.values() if r["lang_pred"] != "und" and r["score"] >= 0.5)
    assert Counter(r[0] for r in found["language"]) == accepted and {3, 4, 5}.isdisjoint(accepted) and {None, 1, 2, 7, 8} <= set(accepted)
    assert set(found["language"]) <= set(found[""])                       # rows are unchanged
    assert Counter(r[0] for r in found["near_duplicates"]) == accepted - Counter({2: 2})   # the copies of document 1 go
    assert Counter(r[0] for r in found["decontamination"]) == accepted - Counter({2: 2, 8: 1})
    times = Counter(found["mixing"])
    assert set(times) <= set(found["decontamination"]) and max(times.values()) <= 2
    shards = Counter(r[-2] for r in found["sharding"])
    assert len(found["sharding"]) == len(found["mixing"]) and max(shards.values()) - min(shards[s] for s in range(24)) <= 1
    assert all(sorted(r[-1] for r in found["sharding"] if r[-2] == s) == list(range(n)) for s, n in shards.items())
    assert Counter(r[0] for r in found["sharding"]) == Counter(r[0] for r in found["mixing"])


def test_run_on_nothing_and_without_labels(spark, tmp_path):
    empty = write(spark, tmp_path / "empty", [], [])
    out = corpus_pipeline.run(spark, empty)
    assert out.count() == 0 and {"doc_id", "text", "shard", "slot"} <= set(out.columns)
    rng = random.Random(1)
    bare = write(spark, tmp_path / "bare", [(i, prose(rng, "en", 20), None, "a", 1, 1, 1, 1) for i in range(5)], [(1, None)])
    assert corpus_pipeline.identify_language(spark, spark.read.parquet(f"{bare}/documents.parquet"), bare).count() == 0
