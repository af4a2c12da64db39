"""Uniformity of the shuffle, and language scores against a model of plain dictionaries."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajlake.llm import hyper_shuffle, lang_backoff


def test_copies_are_shuffled_like_other_rows(spark, tmp_path):
    """4,000 texts twice each over 24 shards: copies share a shard as often as chance has it, and are no neighbours there."""
    spark.createDataFrame([(i % 4000, f"text {i % 4000}") for i in range(8000)], "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "docs"))
    rows = hyper_shuffle.attach_shards(spark.read.parquet(str(tmp_path / "docs")), 24).collect()
    assert sorted(Counter(r["shard"] for r in rows).values()) == sorted(8000 // 24 + (s < 8000 % 24) for s in range(24))
    place = {}
    for r in rows:
        place.setdefault(r["doc_id"], []).append((r["shard"], r["slot"]))
    together = [p for p in place.values() if p[0][0] == p[1][0]]
    mean, sd = 4000 / 24, math.sqrt(4000 / 24 * 23 / 24)
    assert abs(len(together) - mean) < 3 * sd
    assert sum(abs(p[0][1] - p[1][1]) == 1 for p in together) <= 8   # about one by chance
    # every slot is as likely for a row of any partition: mean slot of a shard's rows by parity of id
    for s in range(24):
        slots = [r["slot"] for r in rows if r["shard"] == s]
        assert sorted(slots) == list(range(len(slots)))


@pytest.mark.parametrize("good, bad, n", [(40, 60, 30), (3000, 500, 900), (20, 4000, 100), (5000, 5000, 4000), (900, 100, 950)])
def test_large_populations_are_drawn_exactly(good, bad, n, monkeypatch):
    """The draw for large populations, forced on small ones, follows the hypergeometric law."""
    monkeypatch.setattr(hyper_shuffle, "_NUMPY_LIMIT", 0)
    rng = np.random.default_rng(1)
    got = Counter(hyper_shuffle._hypergeometric(rng, good, bad, n) for _ in range(8000))
    total = math.comb(good + bad, n)
    chi, cells, rest, rest_want = 0.0, 0, 0, 0.0
    for x in range(max(0, n - bad), min(good, n) + 1):
        want = 8000 * math.comb(good, x) * math.comb(bad, n - x) / total
        if want >= 8:
            chi, cells = chi + (got[x] - want) ** 2 / want, cells + 1
        else:
            rest, rest_want = rest + got[x], rest_want + want
    chi += (rest - rest_want) ** 2 / max(rest_want, 1)
    assert chi < cells + 4.5 * math.sqrt(2 * cells) + 5


def test_huge_populations():
    rng = np.random.default_rng(2)
    good, bad, n = 3 * 10 ** 12, 10 ** 12, 10 ** 7
    draws = np.array([hyper_shuffle._hypergeometric(rng, good, bad, n) for _ in range(300)])
    sd = math.sqrt(n * 0.75 * 0.25)
    assert abs(draws.mean() - 0.75 * n) < 4 * sd / math.sqrt(300) and 0.85 < draws.std() / sd < 1.15
    matrix = hyper_shuffle.draw_matrix([10 ** 7, 5], [10 ** 7 - 3, 8], 1)
    assert matrix.sum() == 10 ** 7 + 5 and matrix.sum(0).tolist() == [10 ** 7 - 3, 8]


# ---------------------------------------------------------------- language

def brute_language(train, texts):
    """Word-first back-off from plain dictionaries: (lang, score) of each text."""
    words = {}
    for lang, text in train:
        if lang is not None and text is not None:
            words.setdefault(lang, Counter()).update(re.findall(r"[^\W\d_]+", text.lower()))
    langs = sorted(k for k in words if words[k])
    grams = {lang: [Counter() for _ in range(5)] for lang in langs}
    for lang in langs:
        for w, c in words[lang].items():
            for k in range(1, 5):
                m = w if k == 1 else f"<{w}>"
                for i in range(len(m) - k + 1):
                    grams[lang][k][m[i:i + k]] += c

    def logs(counters, entry):
        size = len(set().union(*counters))
        return np.array([math.log((c[entry] + 0.5) / (sum(c.values()) + 0.5 * size + 0.5)) for c in counters])

    sets = {0: set().union(*(words[x] for x in langs))} if langs else {0: set()}
    for k in range(1, 5):
        sets[k] = set().union(*(grams[x][k] for x in langs)) if langs else set()
    memo = {}

    def of(word):
        if word not in memo:
            memo[word] = np.zeros(len(langs))
            if word in sets[0]:
                memo[word] = logs([words[x] for x in langs], word)
            else:
                for k in range(4, 0, -1):
                    m = word if k == 1 else f"<{word}>"
                    known = [logs([grams[x][k] for x in langs], m[i:i + k]) for i in range(len(m) - k + 1) if m[i:i + k] in sets[k]]
                    if known:
                        memo[word] = np.mean(known, axis=0)
                        break
        return memo[word]

    out = []
    for text in texts:
        ws = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not ws or not langs or not any(c.isalpha() for w in ws for c in w):
            out.append(("und", 0.0))
            continue
        total = sum(of(w) for w in ws) * (min(len(ws), lang_backoff.EVIDENCE) / len(ws))
        p = np.exp(total - total.max())
        p /= p.sum()
        out.append((langs[int(p.argmax())], float(p.max())))
    return out


def language_rows(n_langs, n, seed):
    rng = random.Random(seed)
    letters = [rng.sample("abcdefghijklmnopqrstuvwxyzßéñ", 8) for _ in range(n_langs)]
    rows = []
    for i in range(n):
        k = rng.randrange(n_langs)
        rows.append((i, " ".join("".join(rng.choice(letters[k]) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 25))), f"l{k:04d}" if i % 5 else None))
    return rows + [(n, None, "l0000"), (n + 1, "", None), (n + 2, "12 34 _", "l0001"), (None, "ab ba", None), (None, "ab ba", None)]


def check_language(spark, rows, model_of):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = lang_backoff.identify(docs, model_of(docs)).collect()
    want = brute_language([(r[2], r[1]) for r in rows], [r[1] for r in rows])
    by_id = {r[0]: w for r, w in zip(rows, want, strict=True)}
    assert len(got) == len(rows)
    for r in got:
        lang, score = by_id[r["doc_id"]]
        assert abs(r["score"] - score) < 1e-4
        assert r["lang_pred"] == lang or score < 0.55, (r, lang, score)
    return got


@pytest.mark.parametrize("words, grams", [(30_000, 10_000), (20, 10), (1, 1)])
def test_scores_equal_plain_dictionaries(spark, words, grams):
    rows = language_rows(3, 150, 4)
    got = check_language(spark, rows, lambda d: lang_backoff.learn(d, words, grams))
    whole = {(r["uid"], r["lang_pred"], r["score"]) for r in lang_backoff.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"),
                                                                                lang_backoff.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))).collect()}
    assert {(r["uid"], r["lang_pred"], r["score"]) for r in got} == whole   # the same to the last bit, whatever tasks hold


def test_a_thousand_languages(spark):
    rows = language_rows(1000, 3000, 8)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = lang_backoff.identify(docs, lang_backoff.learn(docs)).collect()
    assert len(got) == len(rows)
    right = [r["lang_pred"] == by for r, by in ((r, {x[0]: x[2] for x in rows if x[2]}.get(r["doc_id"])) for r in got) if by]
    assert sum(right) > 0.5 * len(right)
    assert lang_backoff.drop_unidentified(docs, lang_backoff.learn(docs)).where(F.col("text").isNull()).count() == 0


@pytest.mark.parametrize("columns", [64, 1])
def test_languages_without_words_are_none(spark, columns, monkeypatch):
    """Plain sums and lists of pairs give the same, also if the languages that hold words are not the first ones."""
    monkeypatch.setattr(lang_backoff, "_COLUMNS", columns)
    rows = [*language_rows(3, 60, 5), (900, "12 34", "a"), (901, None, "l0000b"), (902, "", "z")]
    for words, grams in ((30_000, 10_000), (5, 3)):
        check_language(spark, rows, lambda d, w=words, g=grams: lang_backoff.learn(d, w, g))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert lang_backoff.learn(docs).langs == ["l0000", "l0001", "l0002"]
    assert lang_backoff.learn(docs.where("lang in ('a', 'z')")).langs == []


def test_no_lists_of_rows_on_the_heap(spark, monkeypatch):
    """Words and n-grams are counted and looked up without aggregates of objects, which let an executor's heap grow."""
    plans, write = [], lang_backoff.write_stage

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(lang_backoff, "write_stage", noted)
    docs = spark.createDataFrame(language_rows(3, 60, 6), "doc_id long, text string, lang string")
    got = lang_backoff.identify(docs, lang_backoff.learn(docs, 5, 3))
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 5 and not any("ObjectHashAggregate" in p or "collect_list" in p for p in plans)


def test_texts_come_in_small_batches(spark, monkeypatch):
    """Batches of texts are bounded while stages are written, and the session's setting holds again afterwards."""
    key, seen, write = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, lang_backoff.write_stage

    def noted(df, name):
        seen[name] = int(spark.conf.get(key))
        return write(df, name)

    monkeypatch.setattr(lang_backoff, "write_stage", noted)
    before = spark.conf.get(key)
    docs = spark.createDataFrame(language_rows(2, 30, 7), "doc_id long, text string, lang string")
    lang_backoff.identify(docs, lang_backoff.learn(docs, 5, 3)).collect()
    assert seen["language-words"] == seen["language-texts"] == lang_backoff._BATCH and spark.conf.get(key) == before
