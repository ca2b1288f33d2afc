"""Published versions, partial rebuilds, the clustered fact, the rollup, and
files whose schemas drifted."""

import dataclasses
import datetime as dt
import glob
import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_pipeline import T0, _sheet, make_folder
from xlsx_writer import write_workbook

from meterlake.operators.gold import build_gold
from meterlake.plans import drilldown as D
from meterlake.plans import pipeline as P
from meterlake.plans import queries as Q
from meterlake.plans import sql
from meterlake.sources import fixtures as FX
from meterlake.sources import lake, union, versions, workbook
from meterlake.streaming.incremental import ingest_available

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_rows(df) -> int:
    """Rows that the file scans of a query returned when it ran."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        p = todo.pop()
        if p.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(p.executedPlan())
        elif p.nodeName().endswith("QueryStage"):
            todo.append(p.plan())
        elif p.nodeName().startswith("Scan parquet"):
            total += p.metrics().apply("numOutputRows").value()
        else:
            todo += [p.children().apply(i) for i in range(p.children().size())]
    return total


def files(root, *layers):
    """Data files by name, with their times."""
    found = [f for x in layers for f in glob.glob(f"{root}/{x}/**/*.parquet", recursive=True)]
    return {f: os.stat(f).st_mtime_ns for f in found}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def two_folders():
    return make_folder({f"Export_H{i}.xlsx": [("A", _sheet("A", T0, 3 + i)), ("B", _sheet("B", T0, 5))] for i in range(1, 4)})


# ------------------------------------------------------------------ publication
def test_a_failed_write_leaves_the_published_gold_whole(spark, monkeypatch):
    root = lake.scratch_root(spark)
    gold = FX.readings_gold(spark, SF)
    lake.write_gold(gold, root)
    seen = lake.read_gold(spark, root)
    before = [rows(x) for x in (seen.fact, seen.dim_hall, seen.dim_meter, seen.rollup)]
    changed = build_gold(FX.readings(spark, SF).withColumn("value", F.lit(1.0)).withColumn("hall_label", F.lit("new")))
    real, written = lake._write_version, []

    def third_fails(df, root, layer, *a, **k):
        written.append(layer)
        if len(written) == 3:
            raise RuntimeError("disk full")
        return real(df, root, layer, *a, **k)

    monkeypatch.setattr(lake, "_write_version", third_fails)
    with pytest.raises(RuntimeError):
        lake.write_gold(changed, root)
    monkeypatch.undo()
    again = lake.read_gold(spark, root)
    assert [rows(x) for x in (again.fact, again.dim_hall, again.dim_meter, again.rollup)] == before
    # an open reader of the old version is not disturbed by the next one either
    lake.write_gold(changed, root)
    assert rows(seen.fact) == before[0]
    assert {r.hall_label for r in lake.read_gold(spark, root).dim_hall.collect()} == {"new"}


def test_superseded_and_failed_folders_can_be_dropped(spark):
    root = lake.scratch_root(spark)
    gold = FX.readings_gold(spark, SF)
    for _ in range(3):
        lake.write_gold(gold, root)
    os.makedirs(f"{root}/gold/dim_hall/v=00000009-failed")
    gone = versions.drop_unpublished(spark, root, list(lake.PUBLISHED_LAYERS), keep=2)
    assert len(gone) == 5 and "gold/dim_hall/v=00000009-failed" in gone
    assert lake.read_gold(spark, root).fact.count() == gold.fact.count()


@pytest.mark.parametrize("hall", ["H 1", "a=b", "x%y", "ä/ö", "007", "q'\"[{^", None, ""])
def test_any_hall_name_is_found_again(spark, hall):
    root = lake.scratch_root(spark)
    silver = FX.readings(spark, SF).where("hall_id = 'VIEW'").limit(50).withColumn("hall_id", F.lit(hall).cast("string"))
    lake.write_silver(silver, root)
    lake.write_silver(FX.readings(spark, SF).where("hall_id = 'CLICK'"), root, ["CLICK"])
    got = lake.read_silver(spark, root)
    assert {r.hall_id for r in got.select("hall_id").distinct().collect()} == {hall or None, "CLICK"}
    assert lake.read_silver(spark, root, [hall]).count() == 50
    lake.write_silver(silver.where("false"), root, [hall])
    assert {r.hall_id for r in lake.read_silver(spark, root).select("hall_id").distinct().collect()} == {"CLICK"}


def test_nothing_published_reads_as_empty(spark):
    root = lake.scratch_root(spark)
    assert lake.read_gold(spark, root).fact.count() == 0 and lake.read_silver(spark, root).count() == 0


# ------------------------------------------------------------- partial rebuilds
def test_a_call_touches_only_the_halls_that_arrived(spark):
    src, root = two_folders(), lake.scratch_root(spark)
    first = ingest_available(spark, src, root)
    assert first["files_rows"] == 3 and first["files_bytes"] > 0
    before = files(root, "silver", "gold", "bronze", "files")
    write_workbook(os.path.join(src, "Export_H2_new.xlsx"), [("A", _sheet("A neu", T0, 2)), ("C", _sheet("C", T0, 4))])
    second = ingest_available(spark, src, root)
    assert second["files_rows"] == 1 and second["silver_rows"] == 2 + 5 + 4 and second["bronze_read"] == 11
    after = files(root, "silver", "gold", "bronze", "files")
    new = set(after) - set(before)
    assert new and all("H2" in f for f in new)
    # nothing of another hall was written, renamed or removed
    other = {f: t for f, t in before.items() if "hall_id=H2" not in f}
    assert other == {f: t for f, t in after.items() if f in other}
    named = versions.published(spark, root).halls("gold/fact_measurement")
    assert named["hall_id=H1"] == named["hall_id=H3"] != named["hall_id=H2"]
    # equal to one batch run over all files
    batch = lake.scratch_root(spark)
    P.run_folder(spark, src, batch)
    a, b = lake.read_gold(spark, root), lake.read_gold(spark, batch)
    for t in ("fact", "dim_hall", "dim_meter", "rollup"):
        assert rows(getattr(a, t)) == rows(getattr(b, t)), t
    assert rows(lake.read_silver(spark, root)) == rows(lake.read_silver(spark, batch))


def test_archive_and_bronze_are_read_by_partition_value(spark):
    src, root = two_folders(), lake.scratch_root(spark)
    ingest_available(spark, src, root)
    some = workbook.archived(spark, root, [("H2", "Export_H2.xlsx")])
    assert [os.path.basename(os.path.dirname(f)) for f in some.inputFiles()] == ["file=Export_H2.xlsx"]
    assert "InMemoryFileIndex(1 paths)" in plan_of(some)
    p = plan_of(lake.read_bronze(spark, root, ["H2"]))
    assert "PartitionFilters: [isnotnull(hall_id" in p and "= H2)]" in p
    assert all("hall_id=H2" in f for f in lake.read_silver(spark, root, ["H2"]).inputFiles())


def test_run_log_of_a_call_equals_the_batch_run(spark):
    src = two_folders()
    a, b = lake.scratch_root(spark), lake.scratch_root(spark)
    ingest_available(spark, src, a, max_files_per_batch=2)
    P.run_folder(spark, src, b)
    x, y = ({r.metric: r.value for r in lake.run_metrics(spark, root).collect()} for root in (a, b))
    assert x.pop("batches") == 2 and x == y and x["files_rows"] == 3 and x["meter_day_rows"] == 6


def test_rounds_of_arrivals_keep_the_last_writer(spark, monkeypatch):
    from meterlake.streaming import incremental
    monkeypatch.setattr(incremental, "FILES_PER_ROUND", 1)
    src = make_folder({f"Export_H1_{c}.xlsx": [("A", _sheet(f"A {c}", T0, n))] for c, n in (("b", 4), ("c", 2), ("a", 3))})
    root = lake.scratch_root(spark)
    ingest_available(spark, src, root)
    assert {r.src_file for r in lake.read_bronze(spark, root).collect()} == {"Export_H1_c.xlsx"}


# ------------------------------------------------- clustered fact, point lookups
@pytest.fixture(scope="module")
def written(spark):
    """Sixty days of nine meters in three halls, in small row groups."""
    root = lake.scratch_root(spark)
    n = spark.range(60 * 96 * 27)
    silver = n.select(
        F.concat(F.lit("H"), (F.col("id") % 3).cast("string")).alias("hall_id"),
        F.concat(F.lit("H"), (F.col("id") % 3).cast("string")).alias("hall_label"),
        F.concat(F.lit("m"), (F.col("id") % 27).cast("string")).alias("meter_id"),
        F.lit("x").alias("meter_name"), F.lit("").alias("meter_desc"),
        F.timestamp_add("MINUTE", (F.floor(F.col("id") / 27) * 15), F.lit("2025-01-01").cast("timestamp_ntz")).alias("timestamp"),
        (F.xxhash64("id") % 100).cast("double").alias("value"))
    old = dict(lake.FACT_OPTIONS)
    lake.FACT_OPTIONS.update({"parquet.block.size": "5000", "parquet.page.size": "1000", "parquet.page.row.count.limit": "500"})
    try:
        lake.write_gold(build_gold(silver), root)
    finally:
        lake.FACT_OPTIONS.clear()
        lake.FACT_OPTIONS.update(old)
    return root, lake.read_gold(spark, root)


def test_a_day_of_a_hall_reads_few_row_groups(spark, written):
    root, gold = written
    day = dt.datetime(2025, 2, 3)
    hit = groups = 0
    for f in glob.glob(f"{root}/gold/fact_measurement/*/hall_id=H1/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.to_arrow_schema().get_field_index("timestamp")
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            groups += 1
            hit += s.min < day + dt.timedelta(days=1) and s.max >= day
    assert groups >= 100 and 1 <= hit <= groups / 20
    q = Q.meter_timeseries(gold, "H1", None, "2025-02-03", positive_only=False)
    assert q.count() == 9 * 96
    # the order by reads its input twice, once for its sample
    assert scanned_rows(q) <= 2 * gold.fact.where("hall_id = 'H1'").count() / 20


def test_a_meter_reads_only_what_holds_it(spark, written):
    _, gold = written
    one = Q.meter_timeseries(gold, "H1", "m4", "2025-02-03", positive_only=False)
    assert one.count() == 96 and scanned_rows(one) <= 2 * 9 * 96
    # a name inside the range of the file's names that no file holds
    assert scanned_rows(Q.meter_timeseries(gold, "H1", "m40", positive_only=False)) == 0


def test_rollup_answers_as_the_fact_does(spark, written):
    _, gold = written
    bare = dataclasses.replace(gold, rollup=None)
    whole = {"end_inclusive_day": True}
    for start, end, kw in ((None, None, {}), ("2025-01-05", "2025-01-20", {}), ("2025-01-05", "2025-01-20", whole),
                           ("2025-01-05 06:00:00", "2025-01-20", {}), (None, dt.date(2025, 1, 3), {}), ("2025-03-30", None, whole)):
        for ask in (lambda g: Q.daily_totals(g, None, start, end, **kw), lambda g: Q.top_day(g, "H2", start, end, **kw),
                    lambda g: Q.daily_totals(g, "H1", start, end, positive_only=False, **kw),
                    lambda g: D.peak_drilldown(g, None, start, end, **kw)):
            assert rows(ask(gold)) == rows(ask(bare)), (start, end)
    for kw in ({"day": "2025-01-07"}, {}, {"day": "2025-01-07", "positive_only": False}):
        assert rows(Q.meter_breakdown(gold, "H1", **kw)) == rows(Q.meter_breakdown(bare, "H1", **kw))
    for name, kw in (("daily_totals", {"start": "2025-01-05", "end": "2025-01-20"}), ("machine_breakdown", {"day": "2025-01-07"})):
        assert rows(sql.run(spark, gold, name, **kw)) == rows(sql.run(spark, dataclasses.replace(gold, fact=gold.fact.drop("reading_date")), name, **kw))
        assert "reading_date" in plan_of(sql.run(spark, gold, name, **kw)).split("PushedFilters", 1)[1]
    for df in (Q.daily_totals(gold, None, "2025-01-05", "2025-01-20"), Q.top_day(gold), Q.meter_breakdown(gold, "H1", "2025-01-07")):
        assert "fact_measurement" not in plan_of(df)


# ------------------------------------------------------------- drifting schemas
def test_union_by_name_widens_types(spark):
    base = tempfile.mkdtemp(prefix="ml-drift-")
    t = [T0, T0]
    parts = [pa.table({"hall_id": ["H1", "H1"], "value": pa.array([1, 2], pa.int32()), "timestamp": t}),
             pa.table({"VALUE": pa.array([2**40, 4], pa.int64()), "hall_id": ["H2", "H2"], "more": [True, False]}),
             pa.table({"timestamp": t, "hall_id": ["H3", "H3"], "value": [0.5, None]})]
    os.makedirs(f"{base}/deep/er")
    for i, p in enumerate(parts):
        pq.write_table(p, f"{base}/{'deep/er/' if i else ''}{i}.parquet")
    got = union.read_union(spark, base)
    assert dict(got.dtypes)["value"] == "double"
    assert sorted((r.hall_id, r.value) for r in got.collect() if r.value is not None) == [
        ("H1", 1.0), ("H1", 2.0), ("H2", 4.0), ("H2", float(2**40)), ("H3", 0.5)]
    assert got.where("hall_id = 'H2' and timestamp is null and more is not null").count() == 2
    assert len(union.files_by_schema(spark, base)) == 3 and union.read_union(spark, tempfile.mkdtemp()) is None
    gold = union.read_gold_union(spark, base, tempfile.mkdtemp(), tempfile.mkdtemp())
    assert gold.fact.count() == 6 and gold.dim_hall.count() == 0


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("decimal(10,2)", "int", "decimal(12,2)"),
    ("decimal(38,2)", "bigint", "decimal(38,2)"), ("float", "decimal(10,2)", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("string", "int", "string"), ("boolean", "int", "string"), ("void", "int", "int"), ("decimal(38,0)", "decimal(10,9)", "double")])
def test_wider(a, b, want):
    x, y = (T._parse_datatype_string(s) for s in (a, b))
    assert union.wider(x, y).simpleString() == want == union.wider(y, x).simpleString()


def test_run_without_rows_is_skipped(spark):
    root = lake.scratch_root(spark)
    m = P.run(spark, FX.cells(spark, SF).where("row_no < 0"), root)
    assert m["status"] == "skipped" and m["bronze_rows"] == 0
