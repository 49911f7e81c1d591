import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import divergence
from tidemark.llm.divergence import audit, galloping, shares

TYPES = "doc_id bigint, text string, lang string, source string, term string, n int, block int"


def brute(rows, least_docs=30, top=50):
    docs = [(r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r[1] or "")) for r in rows]
    docs = [(a, b, ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]) for a, b, words in docs]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(w for d in own for w in set(d[2]))
        kept = [w for w, n in seen.items() if n >= least_docs]
        counts = {s: Counter(w for d in own if d[1] == s for w in d[2]) for s in {d[1] for d in own}}

        def priced(count, kept=kept):
            total = sum(count[w] for w in kept)
            return {w: 1 + 1_000_000_000 * (count[w] + 5) // (total + 5 * len(kept)) for w in kept}

        q = priced(sum(counts.values(), Counter()))
        p = {s: priced(c) for s, c in counts.items()}
        for s in counts:
            pairs = [(sum(abs(p[s][w] - p[t][w]) for w in kept), t) for t in counts if t != s]
            terms = [(p[s][w] - q[w], w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [
                    (lang, s, part, item, value, k) for k, (value, item) in enumerate(found, 1) if part == "pair" or k <= top
                ]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], TYPES).repartition(3)
    return sorted(map(tuple, audit(df, **options).collect()))


def corpus(seed, n, sources, words=60, langs=("en", "de", None, "")):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcXYZéß語😀", k=draw.randint(1, 4))) for _ in range(words)]
    rows = []
    for k in range(n):
        source = draw.choice([f"s{i}" for i in range(sources)] + ["hot"] * sources + [None])
        text = "".join(draw.choice(vocabulary) + draw.choice([" ", "\n", "7", "_", "\x00", "\x7f"]) for _ in range(draw.randint(0, 40)))
        rows.append((k, draw.choice([text, text.upper(), None] if k % 9 == 0 else [text]), draw.choice(langs), source))
    return rows


@pytest.mark.parametrize("block,tile", [(1 << 12, 4), (7, 1), (20, 3)])
def test_equals_brute_force(spark, block, tile):
    rows = corpus(1, 700, 6)
    assert found(spark, rows, block=block, tile=tile, least_docs=10, top=5) == brute(rows, 10, 5)


def test_production_parameters(spark):
    rows = corpus(2, 600, 3, langs=("en", "fr"))
    got = found(spark, rows)
    assert got == brute(rows) and any(r[2] == "term" for r in got)


def test_no_kept_terms_and_single_sources(spark):
    rows = [(1, "only once", "en", "a"), (2, None, "en", "b"), (3, "", "en", None), (4, "word", "de", "a"), (5, "x", None, None)]
    assert found(spark, rows) == brute(rows)
    assert {r[4] for r in found(spark, rows)} == {0}


def test_repeated_rows_count(spark):
    rows = [(1, "word other", "en", "a")] * 31 + [(2, "word", "en", "b")] * 5
    assert found(spark, rows) == brute(rows) and len(brute(rows)) > 2


def test_empty_table(spark):
    assert found(spark, []) == []


def test_long_texts_are_read_whole(spark, monkeypatch):
    long = " ".join(f"w{k % 500}x" for k in range(200_000)) + " last"
    rows = [(k, long if k == 0 else "last w x", "en", f"s{k % 3}") for k in range(40)] + [(99, "語" * 400_000, "en", "s0")]
    assert found(spark, rows, least_docs=2) == brute(rows, 2)


def test_counts_pass_on_when_many_are_held(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD", 5)
    batch = pa.RecordBatch.from_pydict({"lang": ["a"] * 6, "source": ["s"] * 6, "text": ["b c d e f g", "b", "c c", None, "B", "h"]})
    rows = [r for out in divergence._counted([batch]) for r in out.to_pylist()]
    total = Counter()
    for r in rows:
        total[r["term"]] += r["n"]
    assert total == {"b": 3, "c": 3, "d": 1, "e": 1, "f": 1, "g": 1, "h": 1} and len(rows) > 7


@pytest.mark.parametrize("sizes", [(0, 0), (0, 5), (1, 1000), (50, 3000), (2000, 2500), (700, 699)])
def test_galloping(sizes):
    for seed in range(20):
        draw = np.random.default_rng(seed)
        a, b = (np.sort(draw.choice(3000 + 200 * seed, n, replace=False)) for n in sizes)
        own, other = galloping(a, b)
        assert a[own].tolist() == b[other].tolist() == np.intersect1d(a, b).tolist()
        other, own = galloping(b, a)
        assert a[own].tolist() == np.intersect1d(a, b).tolist()


def test_shares_are_exact():
    draw = random.Random(3)
    for _ in range(300):
        kept, total = draw.randint(1, 10**6), draw.randint(0, 9 * 10**15)
        counts = [0, total, draw.randint(0, total)]
        expected = [1 + 10**9 * (c + 5) // (total + 5 * kept) for c in counts]
        assert shares(np.array(counts), total, kept).tolist() == expected
