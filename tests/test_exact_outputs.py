"""Ordered outputs, logs that take a batch once, bounded dialogue runs, and datasets published once."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from tuneforge.operators.dialogue import pair_turns
from tuneforge.sinks import writers as W
from tuneforge.sinks.batch_log import append_once, committed_batches, read_log
from tuneforge.sinks.dialogues import write_dialogues
from tuneforge.sinks.ordered import read_manifest, read_ordered, write_ordered
from tuneforge.sources.jsonl import read_dialogues

ORDERED = "split string, k long, t string"


def test_ordered_parts_read_back_in_order(spark, tmp_path):
    rows = [("train" if i % 3 else "valid", (i * 7919) % 1000, "x\ny" * (i % 5)) for i in range(1000)]
    rows += [("train", None, "null key"), (None, 5, "no split"), ("valid", 2_000_000, "long " * 50_000)]
    df = spark.createDataFrame(rows, ORDERED).repartition(7)
    manifest = write_ordered(df, str(tmp_path / "o"), ["k", "t"], "split", "k", n_files=6).collect()
    got = read_ordered(spark, str(tmp_path / "o"), "k long, t string").collect()
    assert len(manifest) > 3 and sum(m.n_rows for m in manifest) == len(rows)
    for split in ("train", "valid", None):
        want = sorted((r[1:] for r in rows if r[0] == split), key=lambda r: (r[0] is not None, r[0] or 0))
        own = sorted((r.row_no, r.k, r.t) for r in got if r.split == split)
        assert [r[0] for r in own] == list(range(1, len(want) + 1))
        assert [r[1:] for r in own] == want


def test_ordered_empty_and_ties(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "same")] * 50, ORDERED)
    write_ordered(df.limit(0), str(tmp_path / "e"), ["k", "t"], "split", "k")
    assert read_manifest(spark, str(tmp_path / "e")).count() == 0
    assert read_ordered(spark, str(tmp_path / "e"), "k long, t string").count() == 0
    write_ordered(df, str(tmp_path / "t"), ["k", "t"], "split", "k")
    assert sorted(r.row_no for r in read_ordered(spark, str(tmp_path / "t"), "k long, t string").collect()) == list(range(1, 51))


def test_batch_taken_once_after_stops(spark, tmp_path):
    log, schema = str(tmp_path / "log"), "id long"
    assert read_log(spark, log, schema).count() == 0
    assert append_once(spark.range(5), log, 0) and not append_once(spark.range(5), log, 0)
    append_once(spark.range(100, 103), log, 12)
    os.remove(f"{log}/batch=12/_SUCCESS")  # a stop before the commit: its rows are not read, and it is written anew
    assert committed_batches(spark, log) == [0] and read_log(spark, log, schema).count() == 5
    assert append_once(spark.range(100, 103), log, 12)
    got = sorted((r.batch, r.id) for r in read_log(spark, log, schema).collect())
    assert got == [(0, i) for i in range(5)] + [(12, i) for i in (100, 101, 102)]


@pytest.mark.parametrize("run_turns", [1, 3, 4, 1000])
def test_dialogue_runs_pair_over_their_edges(spark, tmp_path, run_turns):
    hot = [(0, p, p + 1, None if p == 6 else f"h{p}") for p in range(300)]  # one dialogue holds half of all rows
    rows = hot + [(d, p, p + 1, f"{d}:{p}") for d in range(1, 101) for p in range(3)]
    df = spark.createDataFrame(rows, "dlg long, pos int, turn_num int, utterance string").repartition(5)
    root = str(tmp_path / "d")
    write_dialogues(df, root, run_turns=run_turns, runs_per_file=10)
    read = read_dialogues(spark, f"{root}/topic=*/*.txt")
    assert sorted((int(r.dlg), r.pos, r.turn_num, r.utterance or "") for r in read.collect()) \
        == sorted((d, p, t, u or "") for d, p, t, u in rows)
    longest = spark.read.option("multiLine", True).json(f"{root}/topic=*/*.txt").agg(F.max(F.size("utterances"))).first()[0]
    assert longest <= run_turns
    key = ("dlg", "turn_num", "input", "output")
    want = sorted(tuple(map(str, r)) for r in pair_turns(df).select(*key).collect())
    assert sorted(tuple(map(str, r)) for r in pair_turns(read).select(*key).collect()) == want


def test_two_drivers_build_once(spark, tmp_path):
    path, built, got = str(tmp_path / "data" / "set"), [], []

    def build():
        built.append(1)
        time.sleep(1)
        return spark.range(10)

    def driver():
        got.append(W.build_if_absent(spark, path, build, poll_seconds=0.1).count())

    both = [threading.Thread(target=driver) for _ in range(2)]
    for t in both:
        t.start()
    for t in both:
        t.join()
    assert got == [10, 10] and len(built) == 1
    assert sorted(n for n in os.listdir(tmp_path / "data") if not n.startswith(".")) == ["set"]


def test_crashed_builds_are_replaced(spark, tmp_path):
    path = tmp_path / "set"
    (path / "old").mkdir(parents=True)  # no _SUCCESS: not a finished build
    lease = tmp_path / "set.lease"
    lease.touch()
    os.utime(lease, (1, 1))  # left by a driver that crashed long ago
    with pytest.raises(ZeroDivisionError):
        W.build_if_absent(spark, str(path), lambda: 1 / 0, poll_seconds=0.01)
    assert not lease.exists()
    assert W.build_if_absent(spark, str(path), lambda: spark.range(3)).count() == 3
    assert not (path / "old").exists()
