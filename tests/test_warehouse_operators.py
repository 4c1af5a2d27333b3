"""Versions, dimensions, audits and read queries on small frames."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sheetstar.operators import audits, companies, dims, fingerprints, snapshots, uploads, versions
from sheetstar.operators.sequence import number_rows
from sheetstar.plans import loading

DAY = datetime(2025, 1, 1)


def log(spark, *loads):
    rows = [(u, c, f"name {c}", f"v{u}", f"s{u}", DAY + timedelta(days=d)) for u, c, d in loads]
    return spark.createDataFrame(
        rows, "upload_id string, company_id string, entity_name string, version_id string, snapshot_id string, loaded_at timestamp_ntz"
    )


@pytest.mark.parametrize("hot_rows, range_rows", [(250_000, 16_384), (500, 100), (0, 37)])
def test_numbering_is_the_plain_one(spark, hot_rows, range_rows):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(20)}", rng.randrange(30), i) for i in range(3000)]
    rows += [("burst", 5, i) for i in range(3000, 3700)]  # one time for all
    rows += [(None, 1, i) for i in range(3700, 3710)]
    df = spark.createDataFrame(rows, "k string, t int, id int").repartition(8)
    numbered = number_rows(df, "k", ["t", "id"], "n", {"after": "t", "after_id": "id"}, hot_rows, range_rows)
    assert numbered.columns == ["k", "t", "id", "n", "after", "after_id"]
    got = {(r.k, r.id): (r.n, r.after, r.after_id) for r in numbered.collect()}
    expected = {}
    for key in {r[0] for r in rows}:
        ordered = sorted((t, i) for k, t, i in rows if k == key)
        for n, (t, i) in enumerate(ordered, 1):
            expected[(key, i)] = (n, *(ordered[n] if n < len(ordered) else (None, None)))
    assert got == expected


def test_numbering_of_nothing_and_of_equal_rows(spark):
    empty = spark.createDataFrame([], "k string, t int")
    assert number_rows(empty, "k", ["t"], "n", {"after": "t"}).collect() == []
    same = spark.createDataFrame([("a", 1)] * 50, "k string, t int")
    assert sorted(r.n for r in number_rows(same, "k", ["t"], "n", hot_rows=10, range_rows=7).collect()) == list(range(1, 51))


def test_a_million_loads_of_one_company_at_one_instant(spark):
    loads = spark.range(1_000_000).select(
        F.lit("c").alias("company_id"), F.concat(F.lit("v"), "id").alias("version_id"), F.sha2(F.col("id").cast("string"), 256).alias("upload_id"),
        F.lit(DAY).alias("loaded_at"),
    )
    found = versions.company_versions(loads)
    per_task = found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count_if("is_current").alias("open"), F.max("version_number").alias("last"), F.sum(F.col("version_number").cast("bigint")).alias("sum"))
    rows = per_task.collect()
    assert sum(r.n for r in rows) == max(r["last"] for r in rows) == 1_000_000
    assert sum(r["sum"] for r in rows) == 1_000_000 * 1_000_001 // 2 and sum(r.open for r in rows) == 1


def test_no_range_holds_more_than_a_fiftieth(spark):
    df = spark.range(400_000).select(F.lit("hot").alias("k"), F.lit(1).alias("t"), F.xxhash64("id").alias("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = number_rows(df, "k", ["t", "id"], "n", range_rows=4_000).select("n", F.spark_partition_id().alias("p"))
        # What one task sorts, and what one range holds, is a stretch of numbers.
        dealt = df.repartitionByRange(100, "k", "t", "id").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert dealt < 400_000 / 50
        assert placed.agg(F.count_distinct("n")).first()[0] == 400_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_building_plans_runs_no_job_but_for_the_counts(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "none")
    loads = log(spark, ("1", "a", 0), ("2", "a", 5))
    found = versions.companies(loads)
    lookup = versions.lookup_companies(loads, found, loads)
    companies.company_details(found, versions.current_versions(loads))
    assert not tracker.getJobIdsForGroup("plans")
    # Numbering looks for keys that are too large for one task.
    numbered = versions.company_versions(loads)
    versions.next_versions(loads.select("entity_name", "loaded_at", "upload_id"), lookup)
    counted = len(tracker.getJobIdsForGroup("plans"))
    companies.list_versions(found, numbered)
    assert len(tracker.getJobIdsForGroup("plans")) == counted
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_versions(spark):
    found = versions.company_versions(log(spark, ("1", "a", 0), ("2", "a", 5), ("3", "a", 9), ("4", "b", 1)))
    rows = found.filter("company_id = 'a'").orderBy("version_number").collect()
    assert [r.version_number for r in rows] == [1, 2, 3]
    assert [r.valid_to for r in rows] == [rows[1].valid_from, rows[2].valid_from, None]
    assert [r.is_current for r in rows] == [False, False, True]


def _tables(spark, *loads):
    loads = log(spark, *loads)
    facts = loads.select(
        "snapshot_id", "version_id", "company_id", "upload_id", "entity_name", F.lit("Chemicals").alias("corporate_sector"),
        F.lit("Switzerland").alias("country_name"), F.lit("eur").alias("currency_code"), F.lit("BB").alias("business_risk_profile"),
        F.lit("B").alias("financial_risk_profile"), F.col("loaded_at").alias("snapshot_at"),
    )
    return versions.companies(loads), versions.company_versions(loads), facts


@pytest.mark.parametrize("day, version", [(-1, None), (0, 1), (4, 1), (5, 2), (8, 2), (9, 4), (99, 4)])
def test_as_of_edges(spark, day, version):
    # Two loads at one time: the first of them never holds.
    loads = [("1", "a", 0), ("2", "a", 5), ("3", "a", 9), ("4", "a", 9)]
    found, _, facts = _tables(spark, *loads)
    tables = (found, log(spark, *loads), facts)
    found = companies.as_of_pick(*tables, (DAY + timedelta(days=day)).date(), ["a"]).collect()
    assert [r.version_number for r in found] == ([version] if version else [])


def test_comparison_keeps_request_order(spark):
    loads = [("1", "a", 0), ("2", "b", 0)]
    found, _, facts = _tables(spark, *loads)
    tables = (found, log(spark, *loads), facts)
    request = companies.requested(tables[0], ["b", "x", "a", "b"])
    found = companies.compare_companies(request, *tables, date(2025, 1, 2)).collect()
    assert [(r.company_id, r.found) for r in found] == [("b", True), ("x", False), ("a", True), ("b", True)]
    missing = companies.compare_not_found(request, *tables, date(2025, 1, 2)).collect()
    assert [(r.pos, r.company_id) for r in missing] == [(1, "x")]


DOCUMENT = "struct<years: array<string>, metrics: map<string, string>, sentinels: map<string, string>>"


def test_documents_are_joined_to_the_choice(spark):
    """No document is moved or sorted below the choice of the snapshot."""
    loads = [("1", "a", 0), ("2", "a", 5), ("3", "b", 9)]
    found, _, facts = _tables(spark, *loads)
    facts = facts.withColumn("credit_metrics", F.expr(f"cast(named_struct('years', array(snapshot_id), 'metrics', map(), 'sentinels', map()) as {DOCUMENT})"))
    request = companies.requested(found, ["b", "a"])
    asked = []

    def fetch(chosen):
        asked.append(sorted(r.snapshot_id for r in chosen.collect()))
        return facts.join(chosen, "snapshot_id", "left_semi")

    for way in (None, fetch):
        compared = companies.compare_companies(request, found, log(spark, *loads), facts, date(2025, 1, 7), way)
        assert [(r.company_id, r.found, r.credit_metrics and r.credit_metrics.years) for r in compared.collect()] == [("b", False, None), ("a", True, ["s2"])]
        last = companies.latest_documents(facts, fetch=way)
        assert {r.company_id: r.credit_metrics.years for r in last.collect()} == {"a": ["s2"], "b": ["s3"]}
    assert asked == [["s2"], ["s2", "s3"]]
    plan = spark._jvm.PythonSQLUtils.explainString(companies.as_of_pick(found, log(spark, *loads), facts, date(2025, 1, 7))._jdf.queryExecution(), "formatted")
    ranks = [part for part in plan.split("\n\n") if "Window" in part.split("\n")[0]]
    assert ranks and not any("credit_metrics" in part for part in ranks)


def test_company_queries(spark):
    found, numbered, facts = _tables(spark, ("1", "a", 0), ("2", "a", 5), ("3", "b", 9))
    assert companies.get_company(found, "a").count() == 1 and companies.get_company(found, "x").count() == 0
    detail = companies.company_details(found, numbered, ["a"]).first()
    assert detail.current_version.version_number == 2
    assert companies.company_details(found, numbered.filter("false"), "a").first().current_version is None
    assert companies.list_versions(found, numbered, "x").count() == 0
    assert [r.snapshot_id for r in companies.list_snapshots_of(facts, "a").collect()] == ["s1", "s2"]
    history = companies.company_history(numbered.filter("version_number = 1"), facts.withColumn("credit_metrics", F.lit(None).cast("struct<years: array<string>, metrics: map<string, string>, sentinels: map<string, string>>")), "a")
    assert [r.version_number for r in history.collect()] == [1, 0]


def test_pages(spark):
    frame = spark.range(60).select(
        F.col("id").cast("string").alias("company_id"), F.format_string("n%03d", "id").alias("entity_name"),
        F.lit(None).cast("string").alias("current_snapshot_id"), F.lit(DAY).alias("created_at"),
    )
    assert companies.list_companies(frame).count() == 50
    assert [r.entity_name for r in companies.list_companies(frame, 3, 10).collect()] == ["n010", "n011", "n012"]
    assert companies.list_companies(frame, 10, 55).count() == 5
    for bad in ({"limit": 0}, {"limit": 501}, {"offset": -1}):
        with pytest.raises(ValueError):
            companies.list_companies(frame, **bad)


def test_pages_of_equal_names_follow_the_id(spark):
    frame = spark.range(50).select(
        F.col("id").alias("company_id"), F.lit("same").alias("entity_name"), F.lit(None).cast("string").alias("current_snapshot_id"), F.lit(DAY).alias("created_at")
    ).repartition(7)
    assert [r.company_id for r in companies.list_companies(frame, 10, 20).collect()] == list(range(20, 30))


def test_snapshot_filters(spark):
    facts = _tables(spark, ("1", "a", 0), ("2", "a", 1), ("3", "b", 2))[2]
    assert [r.snapshot_id for r in snapshots.filter_snapshots(facts).collect()] == ["s3", "s2", "s1"]
    assert snapshots.filter_snapshots(facts, company_id="a", sector="CHEMICALS", country="switzerland", currency="EUR").count() == 2
    assert snapshots.filter_snapshots(facts, from_date=date(2025, 1, 2), to_date=date(2025, 1, 2)).count() == 1
    assert snapshots.filter_snapshots(facts, sector="", currency="usd").count() == 0
    with pytest.raises(ValueError):
        snapshots.filter_snapshots(facts, from_date=date(2025, 2, 1), to_date=date(2025, 1, 1))
    zoned = facts.withColumn("snapshot_at", F.col("snapshot_at").cast("timestamp"))
    assert snapshots.filter_snapshots(zoned, from_date=date(2025, 1, 2)).count() == 2


def test_filter_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "facts")
    facts = _tables(spark, ("1", "a", 0))[2]
    facts.withColumn("snapshot_at", F.col("snapshot_at").cast("timestamp")).write.parquet(path)
    found = snapshots.filter_snapshots(spark.read.parquet(path), company_id="a", from_date=date(2025, 1, 1))
    found.explain("formatted")
    pushed = next(line for line in capsys.readouterr().out.splitlines() if "PushedFilters" in line)
    assert "EqualTo(company_id,a)" in pushed and "GreaterThanOrEqual(snapshot_at" in pushed


def test_uploads(spark):
    schema = ("upload_id string, filename string, file_sha256 string, file_path string, status string, "
              "event_at timestamp_ntz, rows_extracted int, error_message string")
    at = [DAY + timedelta(seconds=s) for s in range(20)]
    events = spark.createDataFrame(
        [("1", "a", "h", "/a", "pending", at[0], None, None), ("1", None, None, None, "completed", at[4], 100, None),
         ("2", "b", "h", "/b", "pending", at[1], None, None), ("2", None, None, None, "failed", at[1], None, "bad"),
         ("3", "c", "h", "/c", "pending", at[9], None, None), ("4", "d", "h", "/d", "pending", at[2], None, None),
         ("4", None, None, None, "processing", at[3], None, None)], schema)
    current = uploads.current_uploads(events)
    assert {r.upload_id: r.status for r in current.collect()} == {"1": "completed", "2": "failed", "3": "pending", "4": "processing"}
    stats = uploads.upload_stats(current).first()
    assert (stats.total_uploads, stats.pending, stats.processing, stats.completed, stats.failed) == (4, 1, 1, 1, 1)
    assert (stats.success_rate, stats.avg_rows_extracted, stats.avg_processing_seconds) == (0.25, 100.0, 2.0)
    assert stats.latest_upload_at == at[9]
    assert [r.upload_id for r in uploads.list_uploads(current).collect()] == ["3", "4", "2", "1"]
    assert uploads.get_upload(current, "2").first().error_message == "bad"
    empty = uploads.upload_stats(current.filter("false")).first()
    assert (empty.total_uploads, empty.success_rate, empty.avg_rows_extracted, empty.latest_upload_at) == (0, 0.0, 0.0, None)


def test_new_files(spark):
    files = spark.createDataFrame([("a", "h1"), ("b", "h2"), ("c", "h2"), ("d", "h3")], "file_id string, file_sha256 string")
    audit = spark.createDataFrame([("h1", "completed"), ("h2", "pending"), ("h3", "failed")], "file_sha256 string, status string")
    assert {r.file_id for r in fingerprints.new_files(files, audit).collect()} == {"b", "c", "d"}


def test_dimensions(spark):
    frame = spark.createDataFrame(
        [("France", "eur", 2), ("France", "EUR", 1), ("Atlantis", "XXX", 3), ("", None, 4), (None, "", 5)], "c string, u string, t int"
    )
    countries = {r.country_name: (r.iso_alpha2, r.region, r.created_at) for r in dims.countries(frame, "c", "t").collect()}
    assert countries == {"France": ("FR", "Western Europe", 1), "Atlantis": (None, None, 3)}
    currencies = {r.currency_code: (r.symbol, r.created_at) for r in dims.currencies(frame, "u", "t").collect()}
    assert currencies == {"EUR": ("€", 1), "XXX": (None, 3)}
    years = spark.createDataFrame([(2, ["2025E", "2024"]), (1, ["n/a", "2024", "2025E"])], "t int, y array<string>")
    dates = {r.year_value: (r.calendar_year, r.is_estimate, r.sort_order) for r in dims.year_dates(years, "y", ["t"]).collect()}
    assert dates == {"n/a": (None, False, 0), "2024": (2024, False, 1), "2025E": (None, True, 2)}


def test_upsert_keeps_first(spark):
    stored = spark.createDataFrame([("a", 1)], "k string, v int")
    incoming = spark.createDataFrame([("a", 9), ("b", 2)], "k string, v int")
    assert sorted(dims.upsert(incoming, stored, "k").collect()) == [("a", 1), ("b", 2)]


def test_lookup_and_next_versions(spark):
    loads = log(spark, ("1", "a", 0), ("2", "a", 5))
    names = spark.createDataFrame([("name a", 1, "7"), ("name a", 2, "8"), ("name z", 1, "9")], "entity_name string, loaded_at int, upload_id string")
    lookup = versions.lookup_companies(names, versions.companies(loads), loads)
    assert {r.entity_name: (r.is_new_company, r.version_number) for r in lookup.collect()} == {"name a": (False, 2), "name z": (True, 0)}
    assert {r.upload_id: r.version_number for r in versions.next_versions(names, lookup).collect()} == {"7": 3, "8": 4, "9": 1}


def test_audits(spark):
    frame = spark.createDataFrame([("x", "a", "done", 1.0), ("x", "b", "failed", 10.5), (None, None, None, float("nan"))],
                                  "k string, parent string, status string, w double")
    assert audits.duplicate_keys(frame, "k").collect() == [("x", 2)]
    assert [r.parent for r in audits.orphans(frame, "parent", spark.createDataFrame([("a",)], "id string"), "id").collect()] == ["b"]
    assert [r.status for r in audits.outside_domain(frame, "status").collect()] == ["done"]
    broken = audits.missing_or_unfit(frame, ["k"], {"w": (5, 4)}).collect()
    assert sorted(len(r.problems) for r in broken) == [1, 2]


def test_events(spark):
    failures = spark.createDataFrame([("u", "é" * 600)], "upload_id string, error_message string")
    failed = loading.mark_failed(failures, DAY).first()
    assert (failed.status, failed.error_message, failed.rows_extracted) == ("failed", "é" * 500, None)
    files = spark.createDataFrame([("file:/in/a b.xlsm", "h")], "file_id string, file_sha256 string")
    first, again, other = (loading.register_pending(files, batch, DAY).first() for batch in ("1", "1", "2"))
    assert (first.filename, first.status, first.file_path) == ("a b.xlsm", "pending", "file:/in/a b.xlsm")
    assert first.upload_id == again.upload_id != other.upload_id


def test_states_merge_to_what_the_log_gives(spark):
    rng = random.Random(3)
    loads = log(spark, *[(str(i), f"c{rng.randrange(12)}", rng.randrange(6)) for i in range(200)])
    batches = loads.withColumn("batch", F.col("upload_id").cast("int") % 7)
    states = versions.company_states(batches, "batch")
    once = versions.merged_states(states.filter("batch < 4"))
    merged = versions.merged_states(once.unionByName(states.filter("batch >= 4").select(once.columns)))
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
    assert same(versions.companies_of(merged), versions.companies(loads))
    assert same(versions.current_versions_of(merged), versions.current_versions(loads))
    nothing = versions.merged_states(versions.company_states(loads.filter("false")))
    assert nothing.isEmpty() and versions.current_versions_of(nothing).isEmpty()


def test_versions_batch_by_batch_are_those_of_the_log(spark):
    """Ten batches, times that loads share within a batch, companies that come and go."""
    rng = random.Random(4)
    rows = [(f"{i:03d}", f"c{rng.randrange(9)}", i // 12) for i in range(120)]
    loads = log(spark, *rows).cache()
    kept = {}
    for batch in range(10):
        at = F.lit(DAY + timedelta(days=batch)).cast("timestamp_ntz")
        merged = versions.merged_states(versions.company_states(loads.filter(F.col("loaded_at") < at)))
        for r in versions.batch_versions(loads.filter(F.col("loaded_at") == at), merged).collect():
            kept[r.version_id] = r
    loads.unpersist()
    assert kept == {r.version_id: r for r in versions.company_versions(loads).collect()}


def test_pages_behind_a_row_are_the_offset_ones(spark, tmp_path):
    frame = spark.range(60).select(
        F.format_string("%02d", "id").alias("company_id"), F.concat(F.lit("n"), (F.col("id") % 9).cast("string")).alias("entity_name"),
        F.lit(None).cast("string").alias("current_snapshot_id"), F.lit(DAY).alias("created_at"),
    )
    path = str(tmp_path / "companies")
    frame.write.parquet(path)
    stored, after = spark.read.parquet(path), None
    for offset in range(0, 70, 10):
        page = companies.list_companies(stored, 10, after=after)
        assert page.collect() == companies.list_companies(stored, 10, offset).collect()
        after = tuple(page.collect()[-1][c] for c in ("entity_name", "company_id")) if offset < 60 else after
    plan = page._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(entity_name,n8)" in plan


def test_points_move_to_their_snapshot_once_and_documents_only_into_order(spark, tmp_path):
    """Series and documents are made where the points of a snapshot lie; their text is what is sorted."""
    from sheetstar.plans import catalog, views

    tables = {
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string, o_orderstatus string", [(1, 7, datetime(2024, 1, 1), "p", "F"), (2, 7, datetime(2024, 1, 2), "p", "F"), (2, 7, datetime(2024, 1, 3), "p", "F")]),
        "customer": ("c_custkey long, c_name string, c_mktsegment string, c_nationkey long, c_acctbal double", [(7, "seven", "m", 1, 1.0)]),
        "lineitem": ("l_orderkey long, l_linenumber int, l_shipdate timestamp, l_extendedprice double", [(2, 1, datetime(2024, 5, 1), 1.5), (2, 1, datetime(2024, 6, 1), 2.5), (2, 2, datetime(2025, 6, 1), 3.0), (None, 1, datetime(2024, 6, 1), 9.0)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    plan = views.metric_documents(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    history = catalog.company_history(spark, str(tmp_path))
    sort = history._jdf.queryExecution().executedPlan().toString().split("Exchange rangepartitioning")
    assert len(sort) == 2 and "credit_metrics" not in sort[0]
    got = [(r.snapshot_id, r.version_number, r.years, r["values"]) for r in history.collect()]
    assert got[0] == (1, 1, "", "") and len(got) == 5
    assert {g[2:] for g in got[1:]} == {("2024|2025", "line 1:2024:250|line 2:2025:300")}
