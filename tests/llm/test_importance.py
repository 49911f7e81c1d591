import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import SMOKE_DIR
from tidemark.llm import importance as x
from tidemark.llm.common import table
from tidemark.llm.importance import document_buckets, fit, gumbel, keep_selected, kth_largest, select
from tidemark.llm.words import split_words

DOCS = "doc_id bigint, text string, id string, key int"
LABELS = "doc_id bigint, quality int, toxic int, text string"


def brute_words(text):
    return [w for w in text.translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ") if w]


TEXTS = ["", " ", "a", "The THE the. (The) the", "!! ?? --", "é x ß12 3x", "x" * 50, "a b\nc\td  e", "aa aa aa\x0b!!\x0caa", "İſ K", "foo| | bar"]


def test_words_equal_brute_force():
    words = split_words([t.encode() for t in TEXTS])
    found = [[] for _ in TEXTS]
    for start, end, text in zip(words.start, words.end, words.text, strict=True):
        found[text].append(bytes(words.raw[start:end]).decode())
    assert found == [brute_words(t) for t in TEXTS]


def test_buckets_do_not_depend_on_neighbours(monkeypatch):
    alone = [next(iter(document_buckets([(0, t.encode())])))[1].tolist() for t in TEXTS]
    together = [b.tolist() for _, b in document_buckets([(i, t.encode()) for i, t in enumerate(TEXTS)])]
    assert alone == together
    assert [len(b) > 0 for b in alone] == [bool(brute_words(t)) for t in TEXTS]
    # Same word, same shape: the signs around a word are no part of its ends.
    assert set(alone[2]) & set(next(iter(document_buckets([(0, b"(a)")])))[1].tolist())


def test_sections_of_long_texts(monkeypatch):
    text = ("alpha beta, GAMMA\n" * 40).encode()
    whole = next(iter(document_buckets([(0, text)])))[1].tolist()
    monkeypatch.setattr(x.sections, "__defaults__", (30,))
    cut = dict(document_buckets([(0, text), (1, b"x"), (2, text)]))
    assert set(whole) <= set(cut[0].tolist()) and cut[0].tolist() == cut[2].tolist() and len(cut[1]) == 3
    # Only the pair of shapes at a cut may differ.
    assert len(cut[0]) - len(whole) <= 3


def corpus():
    pick = random.Random(2)
    clean, bad = [f"w{i}ord" for i in range(60)], ["idiotic", "scummy"]
    rows, labels = [], []
    for i in range(400):
        words = [pick.choice(clean) for _ in range(pick.randrange(3, 60))]
        if toxic := i % 5 == 0:
            words[1] = pick.choice(bad)
        rows.append((i, " ".join(words), "x", 0))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic), "x"))
    return rows, labels


def test_weights_equal_brute_force(spark):
    rows, labels = corpus()
    rows += [(None, None, None, None), (500, "", "", 0), (7, "w1ord idiotic", "", 0), (7, "w1ord idiotic", "", 0)]
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame([*labels, (3, 0, None, None), (None, 1, 0, "")], LABELS)
    found = fit(docs.repartition(3), known)
    kinds = x.read_labels(known)
    raw, target = Counter(), Counter()
    buckets = [set(next(iter(document_buckets([(0, (t or "").encode())])))[1].tolist()) for _, t, *_ in rows]
    for (key, *_), own in zip(rows, buckets, strict=True):
        raw.update(own)
        if kinds.of(key) == 1:
            target.update(own)
    n_raw, n_target = raw.total(), target.total()
    ratio = {b: math.log((target[b] + 10 * n_target / n_raw) / n_target) - math.log((raw[b] + 10) / n_raw) for b in raw}
    expected = sorted((str(key), round(sum(sorted(ratio[b] for b in own)[:2]), 9)) for (key, *_), own in zip(rows, buckets, strict=True))
    assert sorted((str(r["id"]), round(r["log_weight"], 9)) for r in found.rows.collect()) == expected
    got = select(docs, known).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["id"] is not None and r["id"] < 400 and r["id"] != 7:
            assert r["kept"] == (r["id"] % 5 != 0)
        if r["id"] in (None, 500):
            assert r["log_weight"] == 0 and r["kept"]
    kept = keep_selected(docs, known)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["id"]) for r in got if r["kept"])


@pytest.mark.parametrize("labels", [[], [(1, 1, 0, "")], [(1, 0, 0, "")]])
def test_all_stay_without_both_kinds_of_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b", "", 0), (2, "c d", "", 0)], DOCS)
    assert [r["kept"] for r in select(docs, spark.createDataFrame(labels, LABELS)).collect()] == [True, True]


def test_empty_table(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 1, 0, "")], LABELS)
    assert select(docs, labels).collect() == [] and keep_selected(docs, labels).collect() == []


def test_labels_are_bounded_and_the_worst_counts(spark):
    rows = [(i, 1, 0, "") for i in range(100)] + [(5, 1, 1, ""), (6, 0, 0, ""), (7, None, 0, "")]
    known = x.read_labels(spark.createDataFrame(rows, LABELS), 60)
    assert len(known.ids) == 60
    known = x.read_labels(spark.createDataFrame(rows, LABELS))
    assert known.of(5) == known.of(6) == 3 and known.of(7) in (1, 2) and known.of(None) == known.of(1000) == 0


def test_kth_largest(spark):
    pick = random.Random(3)
    values = [pick.choice([0.1, 0.1 + 2**-54, 0.2, -5.0, pick.random(), 1e300, -1e300]) for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 77, 250, 499, 500):
        assert kth_largest(rows, "v", k) == sorted(values, reverse=True)[k - 1]


def test_noise():
    noise = gumbel(np.arange(200_000), 1)
    assert abs(noise.mean() - 0.5772) < 0.01 and abs(noise.var() - math.pi**2 / 6) < 0.03
    assert (gumbel(np.arange(5), 1) == gumbel(np.arange(5), 1)).all() and (gumbel(np.arange(5), 1) != gumbel(np.arange(5), 2)).all()


def test_held_out_accuracy(spark):
    """Labels the fit has not seen: those with an odd id."""
    directory = SMOKE_DIR.replace("sf0.001", "sf0.1")
    labels = table(spark, directory, "labels")
    got = select(table(spark, directory, "documents"), labels.where("doc_id % 2 = 0")).withColumnRenamed("id", "doc_id")
    seen = got.join(labels.where("doc_id % 2 = 1"), "doc_id")
    good = F.expr("quality = 1 and toxic = 0")
    r = seen.agg(F.avg(F.when(good, F.col("kept").cast("int"))).alias("good"), F.avg(F.when(~good, F.col("kept").cast("int"))).alias("bad")).first()
    assert r["good"] > 0.98 and r["bad"] < 0.2, r


def brute_lowest(text, ratios, window):
    """By all windows of the whole text at once."""
    words = split_words([text])
    values = [math.fsum(ratios[b]) for b in x.ngram_buckets(words)[1].reshape(3, -1).T]
    sums = [math.fsum(values[i : i + window]) for i in range(max(1, len(values) - window + 1))]
    return (min(sums) if values else 0.0), len(sums)


@pytest.mark.parametrize("window", [1, 2, 5])
def test_lowest_windows_equal_brute_force(window):
    ratios = np.random.default_rng(4).normal(size=x.BUCKETS)
    texts = [t.encode() for t in TEXTS] + [b"one two one two three " * 40]
    got = list(x.lowest_windows(enumerate(texts), ratios, window))
    for (key, lowest, n), text in zip(got, texts, strict=True):
        expected = brute_lowest(text, ratios, window)
        assert (lowest, n) == (pytest.approx(expected[0]), expected[1])
        assert next(x.lowest_windows([(key, text)], ratios, window)) == (key, lowest, n)


def test_windows_go_on_over_sections(monkeypatch):
    ratios = np.random.default_rng(5).normal(size=x.BUCKETS)
    text = " ".join(f"w{i}x" for i in range(200)).encode()
    whole = list(x.lowest_windows([(0, text), (1, b"a b")], ratios, 3))
    monkeypatch.setattr(x.sections, "__defaults__", (12,))
    # A pair of shapes at a cut may differ, the n-grams of a word may not: leave pairs out of the ratios.
    plain = x.ngram_buckets
    monkeypatch.setattr(x, "ngram_buckets", lambda w: (plain(w)[0], np.where(np.arange(3 * len(w.start)) < 2 * len(w.start), plain(w)[1], 0)))
    cut = list(x.lowest_windows([(0, text), (1, b"a b")], ratios, 3))
    monkeypatch.setattr(x.sections, "__defaults__", (500_000,))
    assert cut == list(x.lowest_windows([(0, text), (1, b"a b")], ratios, 3))
    assert [n for *_, n in whole] == [n for *_, n in cut] == [198, 1]


def clean_kept(spark, known, joined=0):
    """For clean documents whose labels the fit does not get: (length, kept), shortest first; with ``joined`` also
    whether each text made of so many of them stays."""
    directory = SMOKE_DIR.replace("sf0.001", "sf0.1")
    labels = table(spark, directory, "labels")
    docs = table(spark, directory, "documents").select("doc_id", "text")
    good = "min(quality) = 1 and max(toxic) = 0"
    judged = labels.groupBy("doc_id").agg(F.expr(good).alias("good"))
    unseen = judged.where("good").join(labels.where(known), "doc_id", "left_anti")
    texts = [(r["doc_id"], r["text"]) for r in docs.join(unseen, "doc_id").orderBy("doc_id").collect()]
    long_ones = [(-1 - k, "\n".join(t for _, t in texts[k : k + joined])) for k in range(0, len(texts) - joined, joined)] if joined else []
    rows = docs.unionByName(spark.createDataFrame(long_ones, docs.schema)) if joined else docs
    kept = {r["id"]: r["kept"] for r in select(rows, labels.where(known)).collect()}
    return sorted((len(t), kept[i]) for i, t in texts), [kept[i] for i, _ in long_ones]


def test_long_clean_texts_stay_with_a_small_target(spark):
    """The target has 2 % of the rows."""
    found, _ = clean_kept(spark, "doc_id % 8 = 0")
    longest = [kept for _, kept in found[-len(found) // 10 :]]
    assert sum(longest) > 0.97 * len(longest)
    assert sum(kept for _, kept in found) > 0.98 * len(found)


def test_clean_texts_joined_stay(spark):
    found, long_ones = clean_kept(spark, "doc_id % 2 = 0", 100)
    assert len(long_ones) >= 10 and all(long_ones)
    assert sum(kept for _, kept in found) > 0.99 * len(found)
