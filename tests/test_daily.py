"""Files that are sent again, and runs that die."""

import pytest

from tidemark.sources import MALFORMED, read_history, stream_csv
from tidemark.streaming import daily, ingest_available
from tidemark.tables import TableSpec

SPEC = TableSpec("items", ("k",), ("p",), ("t",), schema="k int, v string, t int, p string")
MONDAY = "k,v,t,p\n1,a,1,x\n2,b,1,x\n,c,1,x\n"


class Inbox:
    def __init__(self, spark, path):
        self.spark, self.path, self.folder = spark, path, path / "inbox"
        self.folder.mkdir()
        self.uri, self.rejects = str(path / "table"), str(path / "rejects")

    def send(self, name, text):
        (self.folder / name).write_text(text)

    def run(self, progress="one", files=1, **options):
        stream = stream_csv(self.spark, str(self.folder), SPEC.schema, keep_malformed=True, max_files_per_trigger=files)
        results = ingest_available(
            stream, SPEC, self.uri, str(self.path / progress), rejects_uri=self.rejects, **options
        )
        return sum(r.read for r in results), sum(r.appended for r in results), sum(r.rejected for r in results)

    def stored(self):
        return sorted(r.k for r in read_history(self.spark, self.uri, SPEC.schema).collect())

    def refused(self):
        return sorted(str(r[MALFORMED] or r.v) for r in self.spark.read.parquet(self.rejects).collect())


def test_a_file_sent_again_is_dropped_whole(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    inbox.send("monday.csv", MONDAY)
    assert inbox.run(repeats_within="7 days") == (3, 2, 1)
    inbox.send("monday again.csv", MONDAY + "3,d,much,x\n4,e,2,y\n")
    assert inbox.run(repeats_within="7 days") == (2, 1, 1)
    assert inbox.stored() == [1, 2, 4] and inbox.refused() == ["3,d,much,x", "c"]


def test_without_it_rows_are_looked_up_and_rejected_again(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    inbox.send("monday.csv", MONDAY)
    inbox.run()
    inbox.send("again.csv", MONDAY)
    assert inbox.run() == (3, 0, 1)
    assert inbox.stored() == [1, 2] and inbox.refused() == ["c", "c"]


def test_rows_that_differ_in_one_column_are_no_repeats(spark, tmp_path):
    """Within a micro-batch the latest row of a key wins, as without the option."""
    inbox = Inbox(spark, tmp_path)
    inbox.send("a.csv", "k,v,t,p\n1,old,1,x\n1,new,2,x\n1,new,2,x\n")
    assert inbox.run(repeats_within="1 hour") == (2, 1, 0)
    (row,) = read_history(spark, inbox.uri, SPEC.schema).collect()
    assert (row.v, row.t) == ("new", 2)


@pytest.mark.parametrize("options", [{}, {"repeats_within": "7 days"}], ids=["plain", "watermark"])
def test_a_run_that_died_leaves_each_reject_once(spark, tmp_path, monkeypatch, options):
    inbox = Inbox(spark, tmp_path)
    inbox.send("monday.csv", MONDAY)
    real = daily.ingest

    def dies(*args, **kwargs):
        real(*args, **kwargs)  # all is stored, but the stream does not learn of it
        raise RuntimeError("lost")

    monkeypatch.setattr(daily, "ingest", dies)
    with pytest.raises(Exception):
        inbox.run(**options)
    monkeypatch.undo()
    inbox.send("tuesday.csv", "k,v,t,p\n5,f,1,x\n,g,1,x\n")
    inbox.run(**options)
    assert inbox.stored() == [1, 2, 5] and inbox.refused() == ["c", "g"]


def test_another_checkpoint_leaves_earlier_rejects(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    inbox.send("monday.csv", MONDAY)
    inbox.run("one", repeats_within="1 day")
    inbox.run("two", repeats_within="1 day")
    assert inbox.stored() == [1, 2] and inbox.refused() == ["c", "c"]


def test_an_empty_inbox(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    assert inbox.run(repeats_within="1 day") == (0, 0, 0)
    inbox.send("empty.csv", "k,v,t,p\n")
    assert inbox.run(repeats_within="1 day") == (0, 0, 0)


def test_the_state_holds_hashes_only(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    stream = stream_csv(spark, str(inbox.folder), SPEC.schema)
    from pyspark.sql import functions as F

    plan = daily._without_repeats(stream, [F.col(c) for c in stream.columns], "1 day")._jdf.queryExecution().analyzed()
    line = next(x for x in plan.toString().splitlines() if "DeduplicateWithinWatermark" in x)
    assert "_row_1" in line and "_row_2" in line and line.count("#") == 2
