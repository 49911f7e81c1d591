import hashlib
import random
import time

import pytest

from tidemark.llm import warc
from tidemark.llm.warc import archive, audit, fixity, leaves, read_archives, read_leaves, records_in, tree, unpacked, write_archives

PAGES = "page_id bigint, url string, html string, file string, digest string"
ROWS = [
    (1, "http://a/", "<p>é</p>", "x", "y"), (2, None, "x", "x", "y"), (3, "http://b/\r\nX: y", "", None, None), (4, "http://c/", None, "x", "y"),
    (None, None, None, None, None), (5, "http://d/", "WARC/1.1\r\n\r\n", "x", "y"), (5, "http://d/", "WARC/1.1\r\n\r\n", "x", "y"),
]
LEAVES = "file bigint, id bigint, offset bigint, length bigint, digest string"


def stored(spark, pages, path, size=warc.ARCHIVE, compression="gzip"):
    records = archive(spark.createDataFrame(pages, PAGES), size)
    write_archives(records, path, compression)
    return records, read_archives(spark, path)


def as_rows(leaves):
    return sorted(map(str, leaves.collect()))


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_are_read_again(spark, tmp_path, compression):
    records, archives = stored(spark, ROWS, str(tmp_path / "a"), compression=compression)
    (row,) = archives.collect()
    assert (row["content"][:2] == b"\x1f\x8b") == (compression == "gzip")
    data = unpacked(bytes(row["content"]))
    texts = [r["record"] for r in records.collect()]
    assert row["file"] == 0 and sorted(texts) == sorted(data[s:e].decode() for s, e, _, _ in records_in(data))
    assert sum(map(len, (t.encode() for t in texts))) == len(data)
    assert as_rows(read_leaves(archives)) == as_rows(leaves(records))
    pages = [page for _, _, page, _ in records_in(data)]
    assert pages == [None, 1, 2, 3, 4, 5, 5] and b"WARC-Target-URI: http://b/%0D%0AX: y\r\n" in data


def test_many_archives(spark, tmp_path):
    pages = [(i, f"http://h/{i}", f"page {i} é\r\n" * (i % 50), None, None) for i in range(2000)]
    records, archives = stored(spark, pages, str(tmp_path / "a"), 20_000)
    assert archives.count() == records.select("file").distinct().count() > 20
    assert as_rows(read_leaves(archives)) == as_rows(leaves(records))


def test_copies_are_dealt_out(spark, monkeypatch):
    """A third of all rows are one record; its copies go to as many archives as tasks have read them."""
    monkeypatch.setattr(warc, "COPIES", 50)
    pages = [(7, "u", "same", None, None) if i % 3 == 0 else (i, "u", str(i), None, None) for i in range(3000)]
    df = spark.createDataFrame(pages, PAGES).repartition(8)
    found = archive(df, 20_000)
    assert found.count() == 3000
    hot = {r["file"]: r["count"] for r in found.where("id = 7").groupBy("file").count().collect()}
    assert sum(hot.values()) == 1001 and max(hot.values()) <= 400


BYTES = b"".join(
    b"WARC/1.1\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, len(c), c)
    for i, c in enumerate([b"one", b"", b"three\r\n\r\nlines", b"WARC/1.1\r\n\r\n", b"five" * 100])
)


def pages_of(data):
    found = list(records_in(data))
    assert [s for s, *_ in found] == [0, *(e for _, e, *_ in found)][:-1] and found[-1][1] == len(data)
    return [page for _, _, page, _ in found]


def test_reading_goes_on_after_damage():
    assert pages_of(BYTES) == [0, 1, 2, 3, 4]
    assert pages_of(BYTES[:-1]) == [0, 1, 2, 3, None]
    assert pages_of(BYTES[1:]) == [None, 1, 2, 3, 4]
    assert pages_of(BYTES.replace(b"Length: 3", b"Length: 93", 1)) == [None, 1, 2, 3, 4]
    assert pages_of(BYTES.replace(b"Length: 3", b"Length: x", 1)) == [None, 1, 2, 3, 4]
    assert pages_of(b"junk" + BYTES) == [None, 0, 1, 2, 3, 4] and pages_of(BYTES + b"junk") == [0, 1, 2, 3, 4, None]
    assert pages_of(b"no record at all") == [None] and list(records_in(b"")) == []
    # Content that looks like a record is content, unless its own record is damaged.
    assert pages_of(BYTES.replace(b"Length: 12", b"Length: 13", 1)) == [0, 1, 2, None, None, 4]


def test_gzip_members():
    import gzip

    parts = [BYTES, b"", BYTES * 2000, b"end"]
    packed = b"".join(map(gzip.compress, parts))
    assert unpacked(packed) == b"".join(parts) and unpacked(BYTES) == BYTES and unpacked(b"") == b""
    for cut in (1, 5, 30, len(packed) // 2, len(packed) - 3):
        assert b"".join(parts).startswith(unpacked(packed[:cut])) or cut < 2
    broken = bytearray(packed)
    broken[len(packed) // 2] ^= 0xFF
    assert unpacked(bytes(broken))[: len(BYTES)] == BYTES


def test_any_damage_is_read():
    draw = random.Random(9)
    for _ in range(400):
        data = bytearray(BYTES)
        for _ in range(draw.randint(1, 6)):
            at = draw.randrange(len(data))
            data[at : at + draw.choice([0, 1, 1, 30])] = bytes(draw.choices(b"\r\n:0x<W", k=draw.choice([0, 1, 1, 20])))
        if data:
            pages_of(bytes(data))


def test_long_headers_and_records_take_linear_time():
    header = b"WARC/1.1\r\n" + b"X: y\r\n" * 300_000
    begun = time.perf_counter()
    assert pages_of(header) == [None]
    assert pages_of(header + b"Content-Length: 0\r\n\r\n\r\n\r\n" + BYTES) == [None, 0, 1, 2, 3, 4]
    assert time.perf_counter() - begun < 10


def test_faults_in_bytes_are_located(spark, tmp_path):
    """A byte, a length, a lost and a slipped-in record, and a cut through another, against comparing all leaves."""
    pages = [(i, "http://h/", f"page {i} " * 20, None, None) for i in range(3000)]
    _, archives = stored(spark, pages, str(tmp_path / "a"), 60_000)
    one, other = (sorted(map(tuple, read_leaves(archives, d).collect()), key=str) for d in (None, warc.damage))
    got = {}
    for r in fixity(read_leaves(archives), read_leaves(archives, warc.damage)).collect():
        got.setdefault(r["status"], []).append((r["file"], r["id"], r["offset"], r["digest"]))
    there = {(f, i, d): at for f, i, at, _, d in other}
    expected = {}
    unmatched = {(f, at): (f, i, at, d) for f, i, at, _, d in other if (f, i, d) not in {(g, j, e) for g, j, _, _, e in one}}
    for f, i, at, _, d in one:
        if (f, i, d) in there:
            status = "intact" if there[f, i, d] == at else "moved"
        else:
            status = "corrupt" if unmatched.pop((f, at), None) else "missing"
        expected.setdefault(status, []).append((f, i, at, d))
    expected["extra"] = list(unmatched.values())
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in expected.items()}
    assert {"intact", "moved", "missing", "corrupt", "extra"} == set(got)


def test_the_record_that_a_cut_goes_through_is_corrupt(spark, tmp_path):
    pages = [(i, "u", "x" * 500, None, None) for i in range(20)]
    _, archives = stored(spark, pages, str(tmp_path / "a"))
    found = fixity(read_leaves(archives), read_leaves(archives, lambda data: data[:-900])).orderBy("offset").collect()
    assert [r["status"] for r in found] == ["intact"] * 18 + ["corrupt", "missing"]


def test_leaves(spark):
    got = leaves(archive(spark.createDataFrame(ROWS, PAGES))).orderBy("offset").collect()
    end = 0
    for r in got:
        assert r["offset"] == end
        end += r["length"]
    assert len(got) == len(ROWS) and got[0]["id"] is None
    many = leaves(archive(spark.createDataFrame(ROWS * 20, PAGES), size=2000)).select("file").distinct().count()
    assert many > 3


def random_leaves(pick, files, most):
    rows = []
    for f in range(files):
        at = 0
        for k in range(pick.randrange(1, most)):
            length = pick.randrange(200, 30_000)
            rows.append((f, f * 10_000 + k, at, length, hashlib.sha256(f"{f} {k}".encode()).hexdigest()))
            at += length
    return rows


def changed(pick, rows, kinds):
    """A replica with some faults, and what the audit should say."""
    out, expected = [], {}
    shift = {}
    for f, i, at, length, digest in rows:
        kind = pick.choice(kinds) if pick.random() < 0.02 else "intact"
        move = shift.get(f, 0)
        if kind == "missing":
            expected[f, i] = kind
            shift[f] = move - length
            continue
        if kind == "corrupt" and not move:
            expected[f, i] = kind
            out.append((f, i, at, length, digest[::-1]))
            continue
        if move:
            expected[f, i] = "moved"
        out.append((f, i, at + move, length, digest))
    return out, expected


@pytest.mark.parametrize("seed, kinds", [(1, ["corrupt"]), (2, ["corrupt", "missing"]), (3, ["missing"])])
def test_faults_are_located(spark, seed, kinds):
    pick = random.Random(seed)
    rows = random_leaves(pick, 12, 120)
    replica, expected = changed(pick, rows, kinds)
    one, other = (spark.createDataFrame(r, LEAVES) for r in (rows, replica))
    got = fixity(one, other).collect()
    found = {(r["file"], r["id"]): r["status"] for r in got}
    # A place that another record has moved to holds the wrong record: it counts as corrupt or as missing.
    for key, status in {(f, i): expected.get((f, i), "intact") for f, i, *_ in rows}.items():
        if status == "missing":
            assert found[key] in ("missing", "corrupt")
        else:
            assert found[key] == status, key
    assert len(got) >= len(rows)


def test_equal_replicas_open_nothing(spark):
    rows = spark.createDataFrame(random_leaves(random.Random(4), 3, 50), LEAVES)
    one = tree(rows)
    assert audit(one, tree(rows.repartition(5))).collect() == []
    assert one.levels[-1].count() == 3


def test_lost_and_added_archives_and_records(spark):
    rows = random_leaves(random.Random(5), 4, 30)
    replica = [r for r in rows if r[0] != 1] + [(9, 1, 0, 10, "aa")]
    last = max((r for r in rows if r[0] == 2), key=lambda r: r[2])
    replica.append((2, 77, last[2] + last[3], 5, "bb"))
    replica.remove(max((r for r in rows if r[0] == 3), key=lambda r: r[2]))
    got = audit(tree(spark.createDataFrame(rows, LEAVES)), tree(spark.createDataFrame(replica, LEAVES))).collect()
    assert sorted((r["file"], r["id"]) for r in got if r["status"] == "extra") == [(2, 77), (9, 1)]
    missing = [(r["file"], r["id"]) for r in got if r["status"] == "missing"]
    assert len(missing) == sum(r[0] == 1 for r in rows) + 1 and len(got) == len(missing) + 2


def test_root_is_the_hash_of_its_ranges(spark):
    rows = [(0, 1, 0, 70_000, "aa"), (0, 2, 70_000, 10, "bb"), (0, 3, 70_010, 5, "cc")]
    levels = [t.collect() for t in tree(spark.createDataFrame(rows, LEAVES), (16,)).levels]
    low = hashlib.sha256(b"0:70000:aa").hexdigest(), hashlib.sha256(b"70000:70010:bb,70010:70015:cc").hexdigest()
    assert {r["digest"] for r in levels[0]} == set(low)
    assert levels[1][0]["digest"] == hashlib.sha256(f"0:70000:{low[0]},70000:70015:{low[1]}".encode()).hexdigest()


def test_empty_table(spark, tmp_path):
    records, archives = stored(spark, [], str(tmp_path / "a"))
    assert fixity(leaves(records), leaves(records)).collect() == []
    assert fixity(read_leaves(archives), read_leaves(archives, warc.damage)).collect() == []
