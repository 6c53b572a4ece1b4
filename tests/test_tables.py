"""Catalog tables: merges that die half-way, the stored keys, the run registry, compaction, retention, statistics."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from bookflow.operators.reports import daily_kpi
from bookflow.plans import landing as L
from bookflow.plans import tables as TB
from bookflow.plans import versions as V
from bookflow.schema import RESERVATION_SCHEMA

from test_merge import TS1, TS2, _df, _row
from test_plans import plan, tree

D1, D2, D3 = dt.date(1998, 8, 1), dt.date(1998, 8, 5), dt.date(1998, 9, 1)
A = [_row("k1", date=D1), _row("k2", date=D1, head=4), _row("k3", date=D2)]
B = [_row("k1", date=D1, h="h2", head=7, ts=TS2, run="r2"), _row("k3", date=D3, h="moved", ts=TS2, run="r2"), _row("k4", date=D3, run="r2")]
AFTER_B = {"k1": (D1, 7), "k2": (D1, 4), "k3": (D3, 2), "k4": (D3, 2)}
COUNTS_B = {"inserted_rows": 1, "updated_rows": 2, "unchanged_rows": 0}


def _content(spark, db):
    return {r["record_key"]: (r["reserve_date"], r["headcount"]) for r in TB.read_production(spark, db).collect()}


def _kpi_is_right(spark, db):
    full = daily_kpi(TB.read_production(spark, db))
    stored = spark.table(f"{db}.daily_kpi").select(full.columns)
    return stored.exceptAll(full).count() == 0 == full.exceptAll(stored).count()


@pytest.mark.parametrize("where", ["_write_keys", "commit", "switch", "_add_days", "_vacuum"])
def test_merge_that_dies_is_made_good(spark, tmp_root, monkeypatch, where):
    """Killed before the commit nothing has changed; killed after it the next run carries it on. Nothing counts twice."""
    db = f"bf_dies_{where.strip('_')}"
    TB.create_tables(spark, db, tmp_root)
    TB.create_kpi_table(spark, db, tmp_root)
    TB.apply_merge(spark, db, _df(spark, A))
    TB.refresh_kpi(spark, db)
    before = _content(spark, db)
    module = TB if where == "_write_keys" else V

    def dies(*a, **k):
        if where == "_add_days" and not a[-1]:  # nothing to attach before the merge
            return
        if where == "_write_keys":
            module.real(*a, **k)  # what it wrote is left behind
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(module, "real", getattr(module, where), raising=False)
        m.setattr(module, where, dies)
        with pytest.raises(KeyboardInterrupt):
            TB.apply_merge(spark, db, _df(spark, B))
    committed = where in ("switch", "_add_days", "_vacuum")
    if not committed:
        assert _content(spark, db) == before
    got = TB.apply_merge(spark, db, _df(spark, B))
    assert got == ({"inserted_rows": 0, "updated_rows": 0, "unchanged_rows": 3} if committed else COUNTS_B)
    assert _content(spark, db) == AFTER_B
    TB.refresh_kpi(spark, db)
    assert _kpi_is_right(spark, db)
    parts = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.reservations").collect())
    assert parts == ["reserve_date=1998-08-01", "reserve_date=1998-09-01"]  # the vacated date is gone


def test_catalog_is_rebuilt_from_the_commits(spark, tmp_root):
    for db in ("bf_first", "bf_again"):
        TB.create_tables(spark, db, tmp_root)
        TB.create_kpi_table(spark, db, tmp_root)
        TB.apply_merge(spark, db, _df(spark, A))
        TB.apply_merge(spark, db, _df(spark, B))
        TB.refresh_kpi(spark, db)
        assert _content(spark, db) == AFTER_B and _kpi_is_right(spark, db)
        spark.sql(f"DROP DATABASE {db} CASCADE")


def test_keys_through_many_merges(spark, tmp_root):
    """Over more merges than segments: the last hash of a key counts, old segments and folders go."""
    from bookflow.storage import folders

    db = "bf_many"
    TB.create_tables(spark, db, tmp_root, key_buckets=2)
    TB.create_kpi_table(spark, db, tmp_root)
    for n in range(2 * TB.KEY_SEGMENTS + 2):
        got = TB.apply_merge(spark, db, _df(spark, [_row("k1", h=f"h{n}", head=n, date=D1 + dt.timedelta(n % 3)), _row(f"new{n}", date=D2)]))
        assert got == {"inserted_rows": 1 + (n == 0), "updated_rows": int(n > 0), "unchanged_rows": 0}
        if n % 5 == 4:
            TB.refresh_kpi(spark, db)
            assert _kpi_is_right(spark, db)
    assert TB.apply_merge(spark, db, _df(spark, [_row("k1", h=f"h{n}"), _row("new3", date=D2)])) == {"inserted_rows": 0, "updated_rows": 0, "unchanged_rows": 2}
    assert len(spark.sql(f"SHOW PARTITIONS {db}.reservation_keys").collect()) <= TB.KEY_SEGMENTS
    live = TB.read_production(spark, db).select("_metadata.file_path").distinct().count()
    versions = folders(spark, f"{tmp_root}/reservations_versions")
    assert len(versions) <= live + 2  # the live ones, and those that the last change replaced


def test_classification_reads_keys_only_and_in_their_buckets(spark, tmp_root):
    db = "bf_key_plan"
    TB.create_tables(spark, db, tmp_root, key_buckets=4)
    TB.apply_merge(spark, db, _df(spark, A))
    TB.apply_merge(spark, db, _df(spark, B))
    source = spark.createDataFrame(B, RESERVATION_SCHEMA)
    for size in ("10485760", "-1"):  # the run broadcast, and too large for it
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
        try:
            df = TB.classify_run(spark, db, source)
            p = plan(df)
            assert {r["record_key"]: r["action"] for r in df.collect()} == {"k1": "unchanged", "k3": "unchanged", "k4": "unchanged"}
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert f"{db}.reservations" not in p.replace(f"{db}.reservation_keys", "")
        lines = tree(p)
        scan = next(i for i, line in enumerate(lines) if "Scan parquet" in line and "reservation_keys" in line)

        def depth(line):
            return len(re.match(r"[\s:+\-*]*", line).group(0))

        at = depth(lines[scan])
        for i in range(scan - 1, -1, -1):  # its ancestors
            if depth(lines[i]) < at:
                at = depth(lines[i])
                assert "Exchange" not in lines[i].replace("BroadcastExchange", ""), lines[i]  # what matched may be broadcast


def test_run_filter_reads_the_run_s_partitions(spark, tmp_root):
    db = "bf_registry"
    TB.create_tables(spark, db, tmp_root)
    TB.append_stage(spark, db, _df(spark, [_row("a", ts=TS1, run="r1"), _row("b", ts=TS2, run="r1")]))
    TB.append_stage(spark, db, _df(spark, [_row("a", ts=TS2, run="r2")]))
    TB.append_stage(spark, db, _df(spark, []))
    assert sorted(r["record_key"] for r in TB.run_source(spark, db, "r1").collect()) == ["a", "b"]
    two = TB.run_source(spark, db, "r2")
    assert [r["record_key"] for r in two.collect()] == ["a"]
    p = plan(two)
    assert re.search(r"PartitionFilters: \[.*ingestion_date.*1998-08-01", p) and "1998-07-31" not in p
    assert TB.run_source(spark, db, "no such run").collect() == []


def test_compaction_and_retention(spark, tmp_root):
    db = "bf_compact"
    TB.create_tables(spark, db, tmp_root)
    for n in range(4):
        TB.append_stage(spark, db, _df(spark, [_row(f"a{n}", ts=TS1), _row(f"b{n}", ts=TS2)]))
    rows = sorted(map(str, TB.read_stage(spark, db).collect()))
    got = {r["day"].isoformat(): (r["files_before"], r["files_after"], r["num_rows"]) for r in TB.compact(spark, db).collect()}
    assert got == {"1998-07-31": (4, 1, 4), "1998-08-01": (4, 1, 4)}
    assert sorted(map(str, TB.read_stage(spark, db).collect())) == rows
    assert TB.compact(spark, db).collect() == []  # nothing is left to do
    TB.append_stage(spark, db, _df(spark, [_row("late", ts=TS1, run="r9")]))  # goes to the compacted date
    assert [r["record_key"] for r in TB.run_source(spark, db, "r9").collect()] == ["late"]
    TB.create_tables(spark, db, tmp_root)
    assert TB.read_stage(spark, db).count() == 9
    assert TB.expire_stage(spark, db, "1998-08-15") == [dt.date(1998, 7, 31)]
    assert TB.expire_stage(spark, db, "1998-08-15") == []
    spark.sql(f"DROP DATABASE {db} CASCADE")
    TB.create_tables(spark, db, tmp_root)  # a new catalog over the files that are left
    assert {r["record_key"] for r in TB.read_stage(spark, db).collect()} == {"b0", "b1", "b2", "b3"}


def test_compaction_of_production_keeps_keys_and_kpi(spark, tmp_root):
    db = "bf_compact_prod"
    TB.create_tables(spark, db, tmp_root)
    TB.create_kpi_table(spark, db, tmp_root)
    TB.apply_merge(spark, db, _df(spark, A))
    got = {r["day"]: r["files_after"] for r in TB.compact(spark, db, TB.PRODUCTION, file_bytes=1).collect()}
    assert got == {}  # one file of more bytes than that needs no fewer
    assert TB.apply_merge(spark, db, _df(spark, B)) == COUNTS_B
    TB.refresh_kpi(spark, db)
    assert _content(spark, db) == AFTER_B and _kpi_is_right(spark, db)


def test_load_statistics_and_profile(spark, tmp_root):
    db = "bf_stats"
    TB.create_tables(spark, db, tmp_root)
    files = spark.createDataFrame([("r1", "s1", 3, 700)], "run_id string, store_id string, input_files long, input_bytes long")
    TB.append_stage(spark, db, _df(spark, [_row("a"), _row("b"), _row("c", store="s2")]), "daily", files)
    got = {(r["run_id"], r["store_id"]): (r["source"], r["output_rows"], r["input_files"], r["input_bytes"]) for r in spark.table(f"{db}.load_stats").collect()}
    assert got == {("r1", "s1"): ("daily", 2, 3, 700), ("r1", "s2"): ("daily", 1, None, None)}
    prof = L.table_profile(spark, f"{db}.stage_reservations").first()
    spark.sql(f"ANALYZE TABLE {db}.stage_reservations COMPUTE STATISTICS")
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {db}.stage_reservations").collect()}
    size, n = map(int, re.match(r"(\d+) bytes, (\d+) rows", about["Statistics"]).groups())
    assert (prof["num_rows"], prof["num_bytes"]) == (3, size) and n == 3
    assert prof["num_files"] == len(spark.table(f"{db}.stage_reservations").inputFiles())
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert now - dt.timedelta(minutes=10) < prof["creation_time"] <= prof["last_modified_time"] + dt.timedelta(seconds=1) <= now + dt.timedelta(minutes=1)


def test_landing_expiry_deletes_and_says_what(spark, tmp_root):
    root = f"{tmp_root}/landing"
    L.write_landing(_df(spark, [_row("a", ts=TS1), _row("b", store="s2", ts=TS1)]), root)
    L.write_landing(_df(spark, [_row("c", ts=TS2, run="r2")]), root)
    assert L.expire_landing(spark, root, "1998-08-30 16:15:00", by="upload_ts").collect() == []  # strictly before
    gone = L.expire_landing(spark, root, "1998-08-31 16:15:00", by="upload_ts")
    assert sorted((r["run_id"], r["store_id"], r["record_count"]) for r in gone.collect()) == [("r1", "s1", 1), ("r1", "s2", 1)]
    assert [(r["run_id"], r["store_id"]) for r in L.inventory(spark, root).collect()] == [("r2", "s1")]
    L.expire_landing(spark, root, "2100-01-01 00:00:00", by="upload_ts")
    assert L.inventory(spark, root).count() == 0  # an emptied folder lists nothing


def test_manual_files_in_two_layouts(spark, tmp_root):
    from bookflow.plans.daily_run import manual_backfill

    rows = _df(spark, [_row("a", head=1), _row("b", head=2)]).withColumn("course_name", F.lit('x "y", z\nw'))
    one, two = rows.filter("record_key = 'a'"), rows.filter("record_key = 'b'")
    one.write.options(**L.CSV_OPTIONS).mode("append").csv(f"{tmp_root}/in")
    two.select(*reversed(two.columns), F.lit("?").alias("unknown")).write.options(**L.CSV_OPTIONS).mode("append").csv(f"{tmp_root}/in")
    spark.createDataFrame([("store_id,record_key\ns1,c,too many",)], "value string").coalesce(1).write.mode("append").text(f"{tmp_root}/in")
    out = manual_backfill(spark, f"{tmp_root}/in", "bf_layouts", f"{tmp_root}/tables", "manual_2")
    assert out["load"]["output_rows"] == 2 and out["rejected_files"] == 1 and out["merge"]["inserted_rows"] == 2
    got = sorted((r["record_key"], r["store_id"], r["reserve_date"], r["headcount"], r["course_name"]) for r in spark.table("bf_layouts.reservations").collect())
    assert got == [(k, "s1", D1, n, 'x "y", z\nw') for k, n in (("a", 1), ("b", 2))]


def test_stream_stops_at_another_layout(spark, tmp_root):
    from bookflow.streaming.landing_ingest import start_stage_ingest

    rows = _df(spark, [_row("a")])
    folder = f"{tmp_root}/data/ingest_date=1998-08-01/run=r1/store=s1"
    rows.select(*reversed(rows.columns)).write.options(**L.CSV_OPTIONS).csv(folder)
    q = start_stage_ingest(spark, tmp_root, f"{tmp_root}/stage", f"{tmp_root}/ckpt")
    with pytest.raises(Exception):
        q.awaitTermination()
    assert "FAILED_READ_FILE" in str(q.exception())
