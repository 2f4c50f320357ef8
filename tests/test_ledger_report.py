from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablelift.operators import ledger as led
from tablelift.operators import report, validate
from tablelift.sinks.batches import BatchLog
from tablelift.sources.storage import Store

STATES = (
    "table_name string, chunk_name string, status string, imported_rows bigint, "
    "output_rows bigint, error string"
)


def latest(ledger):
    return {(r["table_name"], r["chunk_name"]): (r["status"], r["output_rows"], r["error"])
            for r in ledger.latest().collect()}


def test_upsert_replaces_by_key(spark, tmp_path):
    ledger = led.ChunkLedger(spark, str(tmp_path / "l"))
    assert latest(ledger) == {}
    ledger.append_rows([("A", "w", "running", None, None, None),
                        ("B", "w", "running", None, None, None)])
    ledger.append_rows([("A", "w", "completed", 5, 5, None)])
    ledger.append_rows([("B", "w", "failed", None, None, "boom")])
    assert latest(ledger) == {("A", "w"): ("completed", 5, None), ("B", "w"): ("failed", None, "boom")}
    again = led.ChunkLedger(spark, str(tmp_path / "l"))
    again.append_rows([("B", "w", "completed", 1, 1, None)])
    assert latest(again)["B", "w"] == ("completed", 1, None)


def test_batch_without_its_mark_does_not_count(spark, tmp_path):
    ledger = led.ChunkLedger(spark, str(tmp_path / "l"))
    ledger.append_rows([("A", "w", "completed", 5, 5, None)])
    lost = spark.createDataFrame([("A", "w", "failed", None, None, "x")], STATES)
    lost = lost.withColumns({"batch": F.lit(2**62), "seq": F.lit(0).cast("bigint")})
    lost.write.parquet(str(tmp_path / "l" / "states" / f"batch-{2**62:020d}"))
    assert latest(ledger) == {("A", "w"): ("completed", 5, None)}


def test_many_batches_are_few_files(spark, tmp_path):
    """The reads of many batches touch a bounded number of directories and files."""
    ledger = led.ChunkLedger(spark, str(tmp_path / "l"), merge_after=8)
    row = lambda i: (f"T{i % 7}", f"c{i % 11}", "completed", i, i, None, f"h{i}", "t")
    touched = []
    for i in range(30):
        ledger.append_rows([row(5 * i + k) for k in range(5)], record=i % 3 == 0)
        touched.append(len(ledger.states.paths()))
    assert max(touched) <= 8 and len(ledger.records.paths()) <= 8
    assert len(list(Path(tmp_path / "l" / "states").rglob("*.parquet"))) <= 40
    wanted = {(f"T{i % 7}", f"c{i % 11}"): ("completed", i, None) for i in range(150)}
    assert latest(ledger) == wanted
    again = led.ChunkLedger(spark, str(tmp_path / "l"))
    assert {r["input_hash"] for r in again.latest().collect()} == {f"h{v[1]}" for v in wanted.values()}


@pytest.mark.parametrize("dies", ["_write", "mark", "_clean", "remove"])
def test_a_crash_while_merging_loses_nothing(spark, tmp_path, monkeypatch, dies):
    ledger = led.ChunkLedger(spark, str(tmp_path / "l"), merge_after=100)
    for i in range(6):
        ledger.append_rows([("T", f"c{i % 4}", "completed", i, i, None)])
    before = latest(ledger)

    class Dies(Exception):
        pass

    def fail(*_):
        raise Dies

    owner = BatchLog if dies.startswith("_") else Store
    with monkeypatch.context() as m:
        m.setattr(owner, dies, fail)
        with pytest.raises(Dies):
            ledger.states.compact()
    again = led.ChunkLedger(spark, str(tmp_path / "l"))
    assert latest(again) == before
    again.append_rows([("T", "c9", "running", None, None, None)])
    again.states.compact()
    assert latest(again) == before | {("T", "c9"): ("running", None, None)} and len(again.states.paths()) == 1


def test_old_column_name(spark):
    df = spark.createDataFrame(
        [("A", "w", "completed", 3, 4, None, 1)],
        "table_name string, chunk_name string, status string, imported_rows bigint, "
        "parquet_rows bigint, error string, seq int",
    )
    assert led.latest_states(df).first()["output_rows"] == 4


def test_one_hot_chunk_against_brute_force(spark):
    rows = [("T", "hot" if i % 3 else f"c{i % 50}", "running", i, i, None, (i * 7919) % 10007)
            for i in range(3000)]
    df = spark.createDataFrame(rows, f"{STATES}, seq int")
    expected = {}
    for r in sorted(rows, key=lambda r: r[-1]):
        expected[r[1]] = r[3]
    got = {r["chunk_name"]: r["imported_rows"] for r in led.latest_states(df).collect()}
    assert got == expected


def test_reconcile_adds_only_what_is_lost(spark, tmp_path):
    ledger = led.ChunkLedger(spark, str(tmp_path / "l"))
    assert ledger.reconcile() == 0
    ledger.append_rows([("A", "w", "failed", None, None, "x")])
    done = [("A", "w", "completed", 5, 5, None), ("B", "w/1", "completed", 7, 7, None)]
    ledger.write_records(spark.createDataFrame(done, STATES))
    records = Path(tmp_path / "l" / "records")
    (records / "bad.json").write_text('{"table_name": "C", \n')
    (records / "old.json").write_text('{"table_name": "D", "chunk_name": "w"}\n')
    assert ledger.reconcile() == 2
    assert latest(ledger) == {
        ("A", "w"): ("failed", None, "x"), ("B", "w/1"): ("completed", 7, None),
        ("D", "w"): ("completed", None, None),
    }
    assert ledger.reconcile() == 0


def test_pending_and_resumed(spark):
    plan = spark.createDataFrame([("A", "1"), ("A", "2"), ("A", "3")], "table_name string, chunk_name string")
    states = spark.createDataFrame(
        [("A", "1", "completed", 5, None, None), ("A", "2", "failed", None, None, "x")], STATES
    )
    assert {r[1] for r in led.pending_chunks(plan, states).collect()} == {"2", "3"}
    got = {r["chunk_name"]: (r["redo"], r["output_rows"]) for r in led.resume_chunks(plan, states).collect()}
    assert got == {"1": (False, 0), "2": (True, None), "3": (True, None)}


def test_fingerprint(one):
    import hashlib

    names = F.array(F.lit("b"), F.lit("a"))
    value = one(led.fingerprint(F.lit("img"), F.lit("docker"), F.lit("c"), led.listed(names)))
    assert value == hashlib.sha256("img\x1fdocker\x1fc\x1fa,b".encode()).hexdigest()
    assert one(led.fingerprint_check(F.lit(""), F.lit("x"))) == "unverified"
    assert one(led.fingerprint_check(F.lit("x"), F.lit("x"))) == "match"
    assert one(led.fingerprint_check(F.lit("y"), F.lit("x"))) == "mismatch"


PLAN = "schema string, table string, strategy string, reason string, chunk string"
RESULTS = (
    "schema string, table string, chunk string, status string, input_rows bigint, "
    "output_rows bigint, output_path string, error string"
)


def test_report_outcomes_and_statistics(spark):
    plan = spark.createDataFrame(
        [
            ("S", "OK", "partition", None, "p1"), ("S", "OK", "partition", None, "p2"),
            ("S", "BAD", "whole_table", None, "whole"), ("S", "GONE", "whole_table", None, "whole"),
            ("S", "EXT", "unsupported", "external", None),
        ],
        PLAN,
    )
    results = spark.createDataFrame(
        [
            ("S", "OK", "p1", "completed", 3, 3, "/o/p1", None),
            ("S", "OK", "p2", "completed", 0, 0, "/o/p2", None),
            ("S", "BAD", "whole", "failed", None, None, None, "overflow"),
            ("S", "EXT", "whole", "completed", 9, 9, "/o/x", None),
        ],
        RESULTS,
    )
    entries = report.report_entries(plan, results)
    got = {(r["table"], r["chunk"]): (r["outcome"], r["output_rows"], r["reason"]) for r in entries.collect()}
    assert got == {
        ("OK", "p1"): ("successful", 3, None), ("OK", "p2"): ("successful", 0, None),
        ("BAD", "whole"): ("failed", None, "overflow"),
        ("GONE", None): ("skipped", None, report.ABSENT_REASON),
        ("EXT", None): ("skipped", None, "external"),
    }
    assert report.report_statistics(entries).first().asDict() == {
        "total_output_rows": 3, "tables_total": 4, "tables_converted": 2, "tables_skipped": 2,
        "tables_failed": 1,
    }


def test_empty_report(spark):
    entries = report.report_entries(spark.createDataFrame([], PLAN), spark.createDataFrame([], RESULTS))
    assert report.report_statistics(entries).first()["total_output_rows"] == 0
    rollup = validate.results_rollup(spark.createDataFrame([], RESULTS)).collect()
    assert [r["output_rows"] for r in rollup if r["level"] == "plan"] in ([0], [])


def test_comparison_shows_missing_extra_and_empty_chunks(spark):
    planned = spark.createDataFrame([("a",), ("b",), ("e",)], "chunk string")
    source = spark.createDataFrame([("a", 2), ("b", 3)], "chunk string, input_rows bigint")
    output = spark.createDataFrame([("a", 2), ("z", 1)], "chunk string, output_rows bigint")
    got = {r["chunk"]: (r["input_rows"], r["output_rows"], r["valid"])
           for r in validate.compare_counts(planned, source, output).collect()}
    assert got == {"a": (2, 2, True), "b": (3, 0, False), "e": (0, 0, True), "z": (0, 1, False)}
