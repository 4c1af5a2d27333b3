"""Workbooks on disk to answered queries."""

import hashlib
import os
import shutil
from datetime import date, datetime, timedelta, timezone

import pytest

from sheetstar import schemas
from sheetstar.plans.warehouse import Warehouse
from sheetstar.sources import workbooks
from sheetstar.sources.workbooks import scan_sheet, workbook_files
from sheetstar.streaming.arrivals import stream_directory
from tests.sheets import clean, write_workbook

T0 = datetime(2025, 1, 1, 12, tzinfo=timezone.utc)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def test_discovery(spark, landing):
    write_workbook(landing / "a.xlsm", clean())
    write_workbook(landing / "b.XLSM", clean())
    write_workbook(landing / "c.xlsx", clean())
    (landing / "sub").mkdir()
    write_workbook(landing / "sub" / "d.xlsm", clean())
    assert [r.path.rsplit("/", 1)[1] for r in workbook_files(spark, str(landing)).collect()] == ["a.xlsm"]
    assert workbook_files(spark, str(landing / "nowhere")).isEmpty()


def test_scan_reads_stored_values(spark, landing):
    rows = [["Label ", 1, 2.5, True, "text", None, datetime(2024, 12, 31)], [], ["x", "inline:in", "=A1&B1", 12.0, 1e-05]]
    write_workbook(landing / "a.xlsm", rows)
    scanned = scan_sheet(workbook_files(spark, str(landing)))
    assert scanned.schema == schemas.SHEET_ROWS
    found = {r.row_idx: [tuple(c) for c in r.cells] for r in scanned.collect() if r.cells}
    assert found[1] == [
        (1, "str", "Label ", None), (2, "int", "1", 1.0), (3, "float", "2.5", 2.5), (4, "bool", "True", 1.0),
        (5, "str", "text", None), (7, "datetime", "2024-12-31 00:00:00", None),
    ]
    assert found[3][1:] == [
        (2, "str", "in", None), (3, "str", "formula text", None), (4, "float", "12.0", 12.0), (5, "float", "1e-05", 1e-05),
    ]


def test_missing_sheet_and_broken_file_are_reported(spark, landing):
    write_workbook(landing / "a.xlsm", clean(), sheet="OTHER")
    (landing / "b.xlsm").write_bytes(b"not a workbook")
    errors = {r.file_id[-6:]: r.error for r in scan_sheet(workbook_files(spark, str(landing))).collect()}
    assert "MASTER sheet not found" in errors["a.xlsm"]
    assert "BadZipFile" in errors["b.xlsm"]


def test_load_and_query(spark, landing, warehouse):
    write_workbook(landing / "acme.xlsm", clean())
    write_workbook(landing / "beta.xlsm", clean(**{"Rated entity": ["Beta"], "Reporting Currency/Units": None}, Country_of_origin=["Nowhere"]))
    write_workbook(landing / "nobody.xlsm", clean(Rated_entity=None))
    write_workbook(landing / "heavy.xlsm", clean(Rated_entity=["Heavy"], Industry_weight=[10.5]))
    write_workbook(landing / "other.xlsm", clean(), sheet="OTHER")
    first = warehouse.load_directory(str(landing), T0)
    assert (first["new"], first["completed"], first["failed"]) == (5, 2, 3)

    # Failed content comes again, completed content does not.
    again = warehouse.load_directory(str(landing), T0 + timedelta(days=1))
    assert (again["new"], again["completed"], again["failed"]) == (3, 0, 3)

    # A file overwritten in place is noticed; a copy of known content is not new.
    write_workbook(landing / "acme.xlsm", clean(metric=[9.0, 8.0, 7.0]))
    shutil.copy(landing / "beta.xlsm", landing / "copy.xlsm")
    third = warehouse.load_directory(str(landing), T0 + timedelta(days=2))
    assert (third["new"], third["completed"]) == (4, 1)

    acme = warehouse.table("dim_company").filter("entity_name = 'Acme'").first()
    versions = warehouse.company_versions(acme.company_id).collect()
    assert [v.version_number for v in versions] == [1, 2]
    assert versions[0].valid_to == versions[1].valid_from and versions[1].is_current

    detail = warehouse.snapshot(acme.current_snapshot_id).first()
    assert detail.credit_metrics.years == ["2022", "2023", "2024E"]
    assert detail.raw_data["Rated entity"][0].text == "Acme"
    assert detail.risk_sub_scores["Liquidity"] == "-2 notches"
    assert detail.industry_weight == 1

    series = {(r.metric, r.year): r.num for r in warehouse.company_series(acme.company_id).collect()}
    assert series[("Scope-adjusted EBITDA interest cover", "2022")] == 9.0

    history = warehouse.company_history(acme.company_id).collect()
    assert [h.version_number for h in history] == [1, 2]

    compared = warehouse.compare_companies([acme.company_id, "missing", acme.company_id], date(2025, 1, 1)).collect()
    assert [(c.pos, c.found, c.version_number) for c in compared] == [(0, True, 1), (1, False, None), (2, True, 1)]
    assert [r.company_id for r in warehouse.compare_not_found([acme.company_id, "missing"], date(2025, 1, 1)).collect()] == ["missing"]
    assert warehouse.compare_not_found([acme.company_id], date(2024, 12, 31)).count() == 1

    stats = warehouse.upload_stats().first()
    assert (stats.total_uploads, stats.completed, stats.failed) == (12, 3, 9)
    assert stats.success_rate == 0.25

    labels = {r.filename: r.rows_extracted for r in warehouse.list_uploads().filter("status = 'completed'").collect()}
    assert labels == {"acme.xlsm": len(clean()), "beta.xlsm": len(clean()) - 1}
    failed = warehouse.list_uploads().filter("filename = 'nobody.xlsm'").first()
    assert failed.status == "failed" and "entity_name" in failed.error_message
    assert warehouse.upload(failed.upload_id).count() == 1
    assert warehouse.latest_snapshots().count() == 2
    assert warehouse.list_snapshots(currency="eur").count() == 2
    assert [r.entity_name for r in warehouse.list_companies(1, 1).collect()] == ["Beta"]

    star = {r.entity_name: r for r in warehouse.star().filter("is_current_snapshot").collect()}
    assert star["Acme"].region == "Western Europe" and star["Acme"].symbol == "€"
    assert star["Beta"].iso_alpha2 is None and star["Beta"].status == "completed"

    (landing / "beta.xlsm").unlink()
    presence = {r.filename: r.file_exists for r in warehouse.upload_files(str(landing)).collect()}
    assert presence["acme.xlsm"] and not presence["beta.xlsm"]

    for name, schema in schemas.TABLES.items():
        table = warehouse.table(name)
        expected = {f.name: f.dataType for f in schema.fields if f.name != "raw_data"}
        assert {f.name: f.dataType for f in table.schema.fields} == expected, name
    years = {r.year_value: (r.calendar_year, r.is_estimate, r.sort_order) for r in warehouse.table("dim_date").collect()}
    assert years == {"2022": (2022, False, 0), "2023": (2023, False, 1), "2024E": (None, True, 2)}


def test_quality_report(spark, landing, warehouse):
    write_workbook(landing / "a.xlsm", clean(CorporateSector=None, Segmentation_criteria=None, End_of_business_year=["Dec"]))
    warehouse.load_directory(str(landing), T0)
    report = warehouse.table("data_quality_report").first()
    assert (report.error_count, report.warning_count, report.present_fields) == (2, 2, 10)
    assert float(report.completeness_score) == 0.833
    assert [e.message for e in report.errors] == [
        "Required field 'CorporateSector' is missing or empty",
        "Invalid month 'Dec'. Must be a full month name e.g. 'December'",
    ]


def test_quarantine(spark, landing, warehouse):
    write_workbook(landing / "a.xlsm", clean(CorporateSector=None))
    write_workbook(landing / "b.xlsm", clean())
    result = warehouse.load_directory(str(landing), T0, on_error="quarantine")
    assert (result["completed"], result["failed"]) == (1, 1)
    with pytest.raises(ValueError):
        warehouse.load_directory(str(landing), T0, on_error="ignore")


def test_equal_files_of_one_batch_both_load(spark, landing, warehouse):
    for name in ("a.xlsm", "b.xlsm", "c.xlsm"):
        write_workbook(landing / name, clean())
    warehouse.load_directory(str(landing), T0)
    versions = warehouse.table("company_versions").orderBy("version_number").collect()
    assert [v.version_number for v in versions] == [1, 2, 3]
    assert sum(v.is_current for v in versions) == 1
    assert warehouse.load_directory(str(landing), T0 + timedelta(days=1))["new"] == 0
    rows = workbook_files(spark, str(landing))
    expected = hashlib.sha256("".join(str(v) for row in clean() for v in row).encode()).hexdigest()
    assert {r.file_sha256 for r in warehouse.list_uploads().collect()} == {expected}
    assert rows.count() == 3


def test_unfinished_batch_is_invisible_and_replaced(spark, landing, warehouse, monkeypatch):
    write_workbook(landing / "a.xlsm", clean())
    write = Warehouse._write

    def dies_at_audit(self, name, df, batch_id):
        if name == "upload_events":
            raise RuntimeError("executor lost")
        write(self, name, df, batch_id)

    monkeypatch.setattr(Warehouse, "_write", dies_at_audit)
    with pytest.raises(RuntimeError):
        warehouse.load_directory(str(landing), T0, batch_id="b1")
    assert warehouse.table("snapshot_fact").isEmpty() and warehouse.table("dim_company").isEmpty()
    monkeypatch.setattr(Warehouse, "_write", write)
    warehouse.load_directory(str(landing), T0, batch_id="b1")
    assert warehouse.table("snapshot_fact").count() == 1
    assert warehouse.table("dim_country").count() == 1


def test_nothing_to_load(spark, landing, warehouse):
    assert warehouse.load_directory(str(landing))["new"] == 0
    assert warehouse.load_directory(str(landing / "nowhere"))["new"] == 0
    assert warehouse.table("snapshot_fact").isEmpty()
    assert warehouse.upload_stats().first().success_rate == 0.0


def test_stream_loads_each_path_once(spark, landing, warehouse, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    write_workbook(landing / "a.xlsm", clean())
    stream_directory(warehouse, str(landing), checkpoint).awaitTermination()
    write_workbook(landing / "b.xlsm", clean(metric=[4.0]))
    stream_directory(warehouse, str(landing), checkpoint).awaitTermination()
    assert warehouse.table("company_versions").count() == 2
    assert warehouse.table("upload_audit").filter("status = 'completed'").count() == 2


def test_two_streams_load_into_one_warehouse(spark, landing, warehouse, tmp_path):
    other = tmp_path / "other"
    other.mkdir()
    write_workbook(landing / "a.xlsm", clean())
    write_workbook(other / "b.xlsm", clean(metric=[4.0]))
    stream_directory(warehouse, str(landing), str(tmp_path / "c1")).awaitTermination()
    stream_directory(warehouse, str(other), str(tmp_path / "c2")).awaitTermination()
    assert warehouse.table("snapshot_fact").count() == 2
    # A new checkpoint of a folder takes its files again, and finds their content loaded.
    stream_directory(warehouse, str(landing), str(tmp_path / "c3")).awaitTermination()
    assert warehouse.table("snapshot_fact").count() == 2


@pytest.mark.parametrize("name", ["report[1].xlsm", "a{b,c}.xlsm", "what?.xlsm", "star*.xlsm"])
def test_names_are_no_patterns(spark, landing, warehouse, name):
    write_workbook(landing / name, clean())
    write_workbook(landing / "plain.xlsm", clean(metric=[4.0]))
    assert warehouse.load_directory(str(landing), T0)["completed"] == 2


def test_a_batch_run_twice_keeps_what_it_loaded(spark, landing, warehouse):
    write_workbook(landing / "a.xlsm", clean())
    (landing / "broken.xlsm").write_bytes(b"no workbook")
    tables = ("snapshot_fact", "company_versions", "upload_audit", "dim_country", "dim_company")
    warehouse.load_directory(str(landing), T0, batch_id="b1")
    before = [warehouse.table(t).count() for t in tables]
    again = Warehouse(spark, warehouse.root).load_rows(scan_sheet(workbook_files(spark, str(landing))), T0, batch_id="b1")
    assert (again["completed"], again["failed"]) == (1, 1)
    assert [warehouse.table(t).count() for t in tables] == before == [1, 1, 2, 1, 1]


def test_a_repeated_batch_is_seen_whole_or_as_before(spark, landing, warehouse, monkeypatch):
    write_workbook(landing / "a.xlsm", clean())
    warehouse.load_directory(str(landing), T0, batch_id="b1")
    write = Warehouse._write

    def dies(self, name, df, attempt):
        if name == "upload_events":
            raise RuntimeError("executor lost")
        write(self, name, df, attempt)

    monkeypatch.setattr(Warehouse, "_write", dies)
    with pytest.raises(RuntimeError):
        warehouse.load_rows(scan_sheet(workbook_files(spark, str(landing))), T0, batch_id="b1")
    assert warehouse.table("snapshot_fact").count() == 1


def test_a_second_poll_decodes_only_what_changed(spark, landing, warehouse, monkeypatch):
    write_workbook(landing / "a.xlsm", clean())
    (landing / "broken.xlsm").write_bytes(b"no workbook")
    warehouse.load_directory(str(landing), T0)
    decoded = []
    from sheetstar.plans import warehouse as module

    def scan(files, *args):
        decoded.append(sorted(r.path.rsplit("/", 1)[1] for r in files.select("path").collect()))
        return scan_sheet(files, *args)

    monkeypatch.setattr(module.workbooks, "scan_sheet", scan)
    assert warehouse.load_directory(str(landing), T0 + timedelta(days=1))["failed"] == 1
    write_workbook(landing / "a.xlsm", clean(metric=[9.0, 8.0]))
    write_workbook(landing / "broken.xlsm", clean(metric=[5.0]))
    assert warehouse.load_directory(str(landing), T0 + timedelta(days=2))["completed"] == 2
    assert warehouse.load_directory(str(landing), T0 + timedelta(days=3))["new"] == 0
    assert decoded == [["broken.xlsm"], ["a.xlsm", "broken.xlsm"]]


@pytest.mark.parametrize("at_once", [10_000, 0])
def test_a_poll_opens_only_what_is_new(spark, landing, warehouse, monkeypatch, at_once):
    """A loaded file larger than the source may read is no trouble to later polls: nothing of it is read."""
    monkeypatch.setattr(workbooks.file_contents, "__defaults__", (at_once,))
    write_workbook(landing / "large.xlsm", clean() + [[f"row {i}", hashlib.sha256(b"%d" % i).hexdigest()] for i in range(4_000)])
    assert warehouse.load_directory(str(landing), T0)["completed"] == 1
    write_workbook(landing / "small.xlsm", clean(metric=[4.0]))
    sizes = {p.name: p.stat().st_size for p in landing.iterdir()}
    most = (sizes["small.xlsm"] + sizes["large.xlsm"]) // 2
    assert sizes["small.xlsm"] < most < sizes["large.xlsm"]
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", most)
    try:
        assert warehouse.load_directory(str(landing), T0 + timedelta(days=1))["completed"] == 1
        # A small old file that arrives late is loaded too.
        write_workbook(landing / "late.xlsm", clean(metric=[5.0]))
        os.utime(landing / "late.xlsm", (1_000_000_000, 1_000_000_000))
        assert warehouse.load_directory(str(landing), T0 + timedelta(days=2))["completed"] == 1
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert warehouse.table("snapshot_fact").count() == 3


@pytest.mark.parametrize("at_once", [10_000, 1])
def test_bounds_reach_the_scan_of_content(spark, landing, at_once):
    for name in ("a", "b", "c[1]", "d{x}"):
        write_workbook(landing / f"{name}.xlsm", clean())
    listing = workbook_files(spark, str(landing))
    chosen = listing.filter("path not like '%a.xlsm'").select("path", "length", "modificationTime")
    content = workbooks.file_contents(listing, chosen, at_once)
    plan = spark._jvm.PythonSQLUtils.explainString(content._jdf.queryExecution(), "formatted")
    scan = next(part for part in plan.split("\n\n") if "Scan binaryFile" in part and "content" in part and "PushedFilters" in part)
    pushed = next(line for line in scan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(modificationTime" in pushed and "LessThanOrEqual(length" in pushed
    assert sorted(r.path[-9:] for r in content.collect()) == sorted(r.path[-9:] for r in chosen.collect())
    assert workbooks.file_contents(listing, chosen.limit(0)) is None


def test_compaction_changes_no_result(spark, landing, warehouse):
    for day in range(3):
        write_workbook(landing / f"{day}.xlsm", clean(metric=[float(day)]))
        warehouse.load_directory(str(landing), T0 + timedelta(days=day))
    tables = ("snapshot_fact", "company_versions", "upload_audit", "dim_country", "dim_date", "data_quality_report", "raw_values")
    before = [sorted(map(str, warehouse.table(t).collect())) for t in tables]
    warehouse.compact()
    assert [sorted(map(str, warehouse.table(t).collect())) for t in tables] == before
    write_workbook(landing / "3.xlsm", clean(metric=[7.0]))
    warehouse.load_directory(str(landing), T0 + timedelta(days=4))
    assert warehouse.table("snapshot_fact").count() == 4


def test_empty_sheet_fails_without_entity(spark, landing, warehouse):
    write_workbook(landing / "a.xlsm", [])
    result = warehouse.load_directory(str(landing), T0)
    assert (result["new"], result["failed"]) == (1, 1)
    upload = warehouse.list_uploads().first()
    assert upload.file_sha256 == hashlib.sha256(b"").hexdigest()


def test_batches_at_once_give_one_row_a_key(spark, landing, warehouse, tmp_path, monkeypatch):
    """Two attempts that both see a country as new: the row stored first stays, as with an upsert."""
    write_workbook(landing / "a.xlsm", clean())
    other = tmp_path / "other"
    other.mkdir()
    write_workbook(other / "b.xlsm", clean(metric=[4.0]))
    write, inner = Warehouse._write, []

    def second_in_between(self, name, df, attempt):
        if name == "dim_country" and not inner:
            inner.append(True)
            # The first attempt has looked for known countries; another batch loads meanwhile.
            known = df.collect()
            Warehouse(self.spark, self.root).load_directory(str(other), T0 + timedelta(days=1))
            df = self.spark.createDataFrame(known, df.schema)
        write(self, name, df, attempt)

    monkeypatch.setattr(Warehouse, "_write", second_in_between)
    warehouse.load_directory(str(landing), T0)
    country = spark.read.parquet(f"{warehouse.root}/dim_country")
    assert country.count() == 2 and country.select("country_id").distinct().count() == 1
    rows = warehouse.table("dim_country").collect()
    assert len(rows) == 1 and rows[0].created_at.day == 2  # the batch that was complete first
    for name in ("dim_currency", "dim_date", "dim_company"):
        key = warehouse.table(name).columns[0]
        assert warehouse.table(name).count() == warehouse.table(name).select(key).distinct().count() > 0
    assert warehouse.table("snapshot_fact").count() == 2


def test_a_poll_reads_the_hashes_of_its_own_digits(spark, landing, warehouse):
    for i in range(6):
        write_workbook(landing / f"{i}.xlsm", clean(metric=[float(i)]))
    warehouse.load_directory(str(landing), T0)
    loaded = spark.read.parquet(f"{warehouse.root}/loaded_hashes")
    assert loaded.count() == 6
    one = loaded.select("file_sha256").limit(1)
    read = warehouse._completed(one)
    assert {f.rsplit("/digits=", 1)[1][:2] for f in read.inputFiles() if "/digits=" in f} == {one.first()[0][:2]}
    assert one.first()[0] in {r.file_sha256 for r in read.collect()}
    assert warehouse._completed(one, besides=T0.strftime("%Y%m%dT%H%M%S%f")).isEmpty()


def test_a_warehouse_without_a_table_of_hashes_gets_one(spark, landing, warehouse):
    write_workbook(landing / "a.xlsm", clean())
    (landing / "broken.xlsm").write_bytes(b"no workbook")
    warehouse.load_directory(str(landing), T0)
    shutil.rmtree(f"{warehouse.root}/loaded_hashes")
    shutil.copy(landing / "a.xlsm", landing / "copy.xlsm")
    again = warehouse.load_directory(str(landing), T0 + timedelta(days=1))
    assert (again["new"], again["completed"]) == (1, 0)
    assert spark.read.parquet(f"{warehouse.root}/loaded_hashes").count() == 1


def _rows_of(warehouse):
    tables = ("snapshot_fact", "company_versions", "upload_audit", "dim_country", "dim_date", "data_quality_report", "raw_values")
    return [sorted(map(str, warehouse.table(t).collect())) for t in tables]


def _folders(warehouse, table):
    return sorted(name for name in os.listdir(f"{warehouse.root}/{table}") if name.startswith("batch_id="))


def test_small_batches_are_merged_and_old_folders_expire(spark, landing, warehouse):
    for i in range(3):
        write_workbook(landing / f"big{i}.xlsm", clean(metric=[50.0 + i]))
    warehouse.load_directory(str(landing), T0)
    big = _folders(warehouse, "snapshot_fact")
    for day in range(3):
        write_workbook(landing / f"{day}.xlsm", clean(metric=[float(day)]))
        warehouse.load_directory(str(landing), T0 + timedelta(days=day + 1))
    before = _rows_of(warehouse)
    # A reader from before has its files listed.
    early = warehouse.table("snapshot_fact")
    early_files = early.inputFiles()
    assert warehouse.compact(max_loads=2) == 3
    assert _rows_of(warehouse) == before
    assert warehouse.compact(max_loads=2) == 0 or _rows_of(warehouse) == before
    assert warehouse.expire(timedelta(days=1)) == 0  # replaced only now
    assert early.count() == 6 and all(os.path.exists(f.removeprefix("file://")) for f in early_files)

    # An attempt that died long ago has no name; one that runs has young files.
    for name, age in (("died", 3), ("runs", 0)):
        folder = f"{warehouse.root}/snapshot_fact/batch_id={name}.1"
        shutil.copytree(f"{warehouse.root}/snapshot_fact/{big[0]}", folder)
        for file in os.listdir(folder):
            if age:
                os.utime(f"{folder}/{file}", (T0.timestamp(), T0.timestamp()))
    assert warehouse.expire(timedelta(days=1)) == 1
    assert "batch_id=runs.1" in _folders(warehouse, "snapshot_fact")
    assert "batch_id=died.1" not in _folders(warehouse, "snapshot_fact")

    assert warehouse.expire(timedelta(0)) > 0
    assert _rows_of(warehouse) == before
    left = _folders(warehouse, "snapshot_fact")
    assert len(left) == 2 and big[0] in left
    assert len(_folders(warehouse, "batches")) == 2 and len(_folders(warehouse, "seen_files")) == 1
    assert warehouse.expire(timedelta(0)) == 0
    # Content and files stay known.
    write_workbook(landing / "more.xlsm", clean(metric=[9.0]))
    shutil.copy(landing / "0.xlsm", landing / "copy.xlsm")
    assert warehouse.load_directory(str(landing), T0 + timedelta(days=9))["new"] == 1
    assert warehouse.load_directory(str(landing), T0 + timedelta(days=10))["new"] == 0
    assert warehouse.compact() == 3 and warehouse.expire(timedelta(0)) > 0
    assert len(_folders(warehouse, "batches")) == 1 and warehouse.table("snapshot_fact").count() == 7


def test_a_compaction_is_named_by_one_file(spark, landing, warehouse):
    for day in range(2):
        write_workbook(landing / f"{day}.xlsm", clean(metric=[float(day)]))
        warehouse.load_directory(str(landing), T0 + timedelta(days=day))
    warehouse.compact("merged")
    files = [f for f in os.listdir(f"{warehouse.root}/batches/batch_id=merged") if f.endswith(".parquet")]
    assert len(files) == 1
    with pytest.raises(ValueError, match="merged"):
        warehouse.compact("merged")
    assert Warehouse(spark, f"{warehouse.root}-new").compact() == 0
    assert Warehouse(spark, f"{warehouse.root}-new").expire() == 0


def test_a_merged_dimension_keeps_the_row_stored_first(spark, landing, warehouse):
    """The middle batch isn't merged and holds the first row of a key that the last one also wrote."""
    row = schemas.STORED["dim_country"]
    for i, (batch, names) in enumerate([("a", ["Aland"]), ("b", ["Beland"]), ("c", ["Beland", "Celand"])]):
        made = [(n.lower(), n, batch, None, None, T0 + timedelta(days=i)) for n in names]
        columns = ["country_id", "country_name", "iso_alpha2", "iso_alpha3", "region", "created_at"]
        warehouse._write("dim_country", spark.createDataFrame(made, row).select(*columns), f"{batch}.1")
        loads = [(f"{batch}{j}", "x", "x", "x", "x", T0) for j in range(5 if batch == "b" else 1)]
        names_of = ["upload_id", "company_id", "entity_name", "version_id", "snapshot_id", "loaded_at"]
        warehouse._write("load_log", spark.createDataFrame(loads, names_of), f"{batch}.1")
        done = spark.createDataFrame([(f"{batch}.1", T0 + timedelta(days=i), None, None)], "attempt string, completed_at timestamp, replaces string, replaced_at timestamp")
        from sheetstar.sources import tables
        tables.append(done, warehouse.root, "batches", done.schema, batch)
    for name in schemas.STORED:
        if name not in ("dim_country", "load_log"):
            warehouse._write(name, spark.createDataFrame([], schemas.STORED[name]), "a.1")
    spark.createDataFrame([("h", "00", "a.1")], "file_sha256 string, digits string, batch_id string").write.partitionBy("digits", "batch_id").parquet(f"{warehouse.root}/loaded_hashes")
    before = sorted(map(str, warehouse.table("dim_country").collect()))
    assert warehouse.compact(max_loads=2) == 2
    assert sorted(map(str, warehouse.table("dim_country").collect())) == before
    assert {r.iso_alpha2 for r in warehouse.table("dim_country").filter("country_name = 'Beland'").collect()} == {"b"}


def test_companies_come_off_the_states_of_batches(spark, landing, warehouse):
    """Also with a batch repeated, one from before there were states, and after a merger."""
    from sheetstar.operators import versions

    for day in range(4):
        for name in ("Alpha", "Beta")[: 1 + day % 2]:
            write_workbook(landing / f"{name}{day}.xlsm", clean(Rated_entity=[name], metric=[float(day)]))
        warehouse.load_directory(str(landing), T0 + timedelta(days=day), batch_id=f"b{day}")
    rows = scan_sheet(workbook_files(spark, str(landing))).filter("file_id like '%Beta3%'")
    warehouse.load_rows(rows, T0 + timedelta(days=9), batch_id="b3")

    def same():
        log = warehouse.stored("load_log")
        found = sorted(map(str, warehouse.table("dim_company").collect()))
        assert found == sorted(map(str, versions.companies(log).select(warehouse.table("dim_company").columns).collect()))
        current = versions.current_versions_of(warehouse.company_states())
        assert sorted(map(str, current.collect())) == sorted(map(str, versions.current_versions(log).select(current.columns).collect()))
        return found

    before = same()
    assert len(before) == 2
    files = warehouse.table("dim_company").inputFiles()
    assert files and not any("/load_log/" in f for f in files)
    # A warehouse from before: the log stands in for what has no states.
    named = [f for f in _folders(warehouse, "company_states") if f.startswith("batch_id=b1.")]
    shutil.rmtree(f"{warehouse.root}/company_states/{named[0]}")
    assert same() == before
    assert any("/load_log/" in f for f in warehouse.table("dim_company").inputFiles())
    assert warehouse.compact() == 4 and same() == before
    assert warehouse.expire(timedelta(0)) > 0 and same() == before
    assert not any("/load_log/" in f for f in warehouse.table("dim_company").inputFiles())
    first = warehouse.list_companies(1).first()
    assert [r.entity_name for r in warehouse.list_companies(5, after=(first.entity_name, first.company_id)).collect()] == ["Beta"]
