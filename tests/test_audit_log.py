"""Compaction of the run log: one file a day, no row lost, whatever stops."""

import glob
import uuid
from datetime import datetime, timezone

import pytest

from strata.plans import ddl
from strata.plans.audit import RunAudit
from strata.sinks import remove_unused, table_location


@pytest.fixture()
def log(spark, scratch_dir):
    db = f"au_{uuid.uuid4().hex[:8]}"
    return RunAudit(spark, ddl.create_audit_table(spark, scratch_dir, db)), db


def write(audit, day, step):
    audit.held.append(("r", "p", "{}", step, "end", 1, 0.5, datetime(2024, 1, day, 12, tzinfo=timezone.utc)))
    audit.flush()


def steps(spark, audit):
    return sorted(r["step"] for r in spark.table(audit.table).collect())


def files_of(spark, audit):
    return glob.glob(f"{table_location(spark, audit.table).removeprefix('file:')}/*.parquet")


def test_compacted_log_has_a_file_a_day_and_takes_more(spark, log, scratch_dir):
    audit, db = log
    assert audit.compact() == 0  # an empty log
    for i in range(8):
        write(audit, 1 + i % 2, f"s{i}")
    assert len(files_of(spark, audit)) == 8
    assert audit.compact() >= 6 and len(files_of(spark, audit)) <= 2
    assert steps(spark, audit) == [f"s{i}" for i in range(8)]
    assert audit.compact() == 0
    write(audit, 2, "s8")
    assert steps(spark, audit) == [f"s{i}" for i in range(9)]
    # created again, the table shows the compacted rows and the later one
    spark.sql(f"DROP TABLE {audit.table}")
    ddl.create_audit_table(spark, scratch_dir, db)
    assert steps(spark, audit) == [f"s{i}" for i in range(9)]
    assert remove_unused(spark, audit.table) == 8 and remove_unused(spark, audit.table) == 0
    assert steps(spark, audit) == [f"s{i}" for i in range(9)]


def test_stopped_compaction_loses_nothing(spark, log, scratch_dir, monkeypatch):
    audit, db = log
    for i in range(3):
        write(audit, 1, f"s{i}")

    def stopped(value):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr("strata.plans.audit.quoted", stopped)  # the folder is written, the table not pointed at it
        with pytest.raises(RuntimeError):
            audit.compact()
    assert steps(spark, audit) == ["s0", "s1", "s2"]
    write(audit, 1, "s3")
    spark.sql(f"DROP TABLE {audit.table}")
    ddl.create_audit_table(spark, scratch_dir, db)
    assert steps(spark, audit) == ["s0", "s1", "s2", "s3"]
    assert audit.compact() > 0 and steps(spark, audit) == ["s0", "s1", "s2", "s3"]
