import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from tests.llm.test_jaccard_join import brute as brute_groups
from tests.llm.test_secrets import brute as brute_spans
from tidemark.llm.importance import select


def write(spark, path, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return docs


def corpus():
    pick = random.Random(6)
    clean = [f"w{i}ord" for i in range(80)]
    rows, labels = [], []
    for i in range(300):
        words = [pick.choice(clean) for _ in range(pick.randrange(4, 80))]
        if i % 6 == 0:
            words[pick.randrange(4)] = pick.choice(["idiotic", "scummy"])
        if i % 7 == 0:
            words += ["token", "=", "deadbeef" * 4]
        text = " ".join(words)
        if i % 10 == 9:
            text = rows[-1][1].replace(" ", "  ", 2)
        if i % 10 == 8 and len(words) > 60:
            text = rows[-1][1] + " more"
        rows.append((i, text, "en", "src", len(text)))
        if i % 2 == 0:
            labels.append((i, 1, int("idiotic" in text or "scummy" in text)))
    rows += [(None, None, None, None, None), (1000, "", "en", "", 0), (1001, "\n", "en", "", 1), (5, rows[5][1], "en", "src", 1)]
    return rows, labels


def expected(rows, kept_ids):
    """The stages one after another, by brute force but for the classifier."""
    rows = [r for r in rows if r[0] in kept_ids]
    groups = {}
    for r in rows:
        groups.setdefault("".join((r[1] or "").split()), []).append(r)
    rows = [min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for g in groups.values()]
    stay = {i for i, n, c in brute_groups(rows, 80, 5) if i == c or n == 0}
    rows = [r for r in rows if r[0] in stay]
    out = []
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for key, text, *_ in rows:
        text = text or ""
        merged = []
        for start, _, end, _ in brute_spans(text)[1]:
            if merged and start < merged[-1][1]:
                merged[-1][1] = max(end, merged[-1][1])
            else:
                merged.append([start, end])
        for start, end in reversed(merged):
            text = text[:start] + "[secret]" + text[end:]
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        out.append((key, 0, 0, len(ids), zlib.crc32(ids.tobytes())))
    return sorted(out, key=str)


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows, labels = corpus()
    path = str(tmp_path / "in")
    docs = write(spark, path, rows, labels)
    kept = {r["id"] for r in select(docs, spark.read.parquet(f"{path}/labels.parquet")).collect() if r["kept"]}
    assert 200 < len(kept) < 290
    got = queries()["pipeline"](spark, path).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(rows, kept)
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)


def test_stages_keep_the_columns(spark, tmp_path):
    rows, labels = corpus()
    path = str(tmp_path / "in")
    docs = write(spark, path, rows, labels)
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, empty):
            result = stage(spark, given, path)
            if name != "best-fit packing":
                assert result.dtypes == docs.dtypes
            assert result.count() <= given.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "n-gram Jaccard join", "secret scans", "best-fit packing",
    ]


def test_columns_with_clashing_names_stay(spark, tmp_path):
    rows, labels = corpus()
    path = str(tmp_path / "in")
    docs = write(spark, path, rows, labels)
    names = ["_gone_id", "_Gone", "_tidemark_rank", "id", "mark", "kept", "any_kept", "n", "_row", "_text", "_spans", "keep_id", "a.b"]
    wide = docs.selectExpr("*", *(f"concat('{c} of ', doc_id) AS `{c}`" for c in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = sorted((r["doc_id"], r["text"]) for r in stage(spark, docs, path).where("doc_id is not null").collect())
        found = stage(spark, wide, path)
        assert found.columns == wide.columns
        kept = found.where("doc_id is not null").collect()
        assert sorted((r["doc_id"], r["text"]) for r in kept) == plain, name
        assert all(r[c] == f"{c} of {r['doc_id']}" for r in kept for c in names)
    packing = corpus_pipeline.STAGES[-1][1]
    assert packing(spark, wide, path).count() == packing(spark, docs, path).count()
