"""The warehouse: loading batches of workbooks, and the tables and queries over what is loaded.

Tables are append-only Parquet, one partition per attempt at a batch. The last write of an attempt
appends a row to ``batches`` that names it; readers see each batch's latest named attempt. So a load
that dies half way shows nothing, and one that is repeated replaces the batch in one step.
"""

from __future__ import annotations

import hashlib
import uuid
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetstar import fixed, schemas
from sheetstar.operators import companies, dims, fingerprints, metrics, rules, sheets, snapshots, uploads, versions
from sheetstar.plans import loading
from sheetstar.session import shared_folder
from sheetstar.sources import tables, workbooks

#: A compaction adds a row for each folder that it ``replaces``: an attempt, or ``seen_files/`` and an attempt.
BATCHES = T.StructType([
    T.StructField("attempt", T.StringType()), T.StructField("completed_at", T.TimestampType()),
    T.StructField("replaces", T.StringType()), T.StructField("replaced_at", T.TimestampType()),
])
#: Files whose content is loaded, as they were when seen: one that has not changed is not decoded again.
SEEN = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()), T.StructField("file_sha256", T.StringType()),
])
#: Records that a task checks and lays out, and tasks that write the folders of hashes.
RECORDS_PER_TASK, HASH_TASKS = 1_000, 16
#: Keys of the tables in which the row stored first stays, whatever batches wrote theirs at the same time.
FIRST_STAYS = {"dim_country": "country_id", "dim_currency": "currency_id", "dim_date": "date_id"}
#: Hashes of loaded content, in folders by their first two digits, so that a batch reads only those of its own.
HASHES = T.StructType([T.StructField("file_sha256", T.StringType())])


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        own = hashlib.md5(self.root.encode()).hexdigest()[:12]
        self.staging = f"{shared_folder(spark, self.root + '/_staging').rstrip('/')}/sheetstar-{own}"

    # -- stored and derived tables ---------------------------------------------------------

    def stored(self, name: str, besides: str | None = None) -> DataFrame:
        """A stored table, completed batches only; without the batch ``besides``."""
        if name not in FIRST_STAYS:
            rows = tables.read_table(self.spark, self.root, name, schemas.STORED[name])
            return rows.join(self._visible(besides), "batch_id", "left_semi").drop("batch_id")
        return self._first_rows(name, besides).drop("batch_id")

    def _first_rows(self, name: str, besides: str | None = None) -> DataFrame:
        """Of each key of a dimension the row stored first, with the ``batch_id`` that holds it."""
        rows = tables.read_table(self.spark, self.root, name, schemas.STORED[name])
        first = F.min_by(F.struct(*rows.columns), F.struct("completed_at", "batch_id")).alias("row")
        return rows.join(self._visible(besides), "batch_id").groupBy(FIRST_STAYS[name]).agg(first).select("row.*")

    def _visible(self, besides: str | None = None) -> DataFrame:
        """``batch_id`` (the latest named attempt of each batch, unless replaced), ``completed_at``; without the batch ``besides``."""
        done = tables.read_table(self.spark, self.root, "batches", BATCHES)
        replaced = done.filter("replaces is not null").select(F.col("replaces").alias("batch_id"))
        if besides is not None:
            done = done.filter(F.col("batch_id") != besides)
        latest = done.groupBy("batch_id").agg(F.max(F.struct("completed_at", "attempt")).alias("latest"))
        named = latest.select(F.col("latest.attempt").alias("batch_id"), "latest.completed_at")
        return named.join(replaced, "batch_id", "left_anti")

    def table(self, name: str, company_ids=None) -> DataFrame:
        """A table of the star schema. ``company_ids`` limits the derived ones early, before
        their versions are numbered."""
        if name == "upload_audit":
            return uploads.current_uploads(self.stored("upload_events"))
        if name == "dim_company":
            return versions.companies_of(self.company_states(company_ids))
        if name == "company_versions":
            return versions.company_versions(companies.wanted(self.stored("load_log"), company_ids))
        if name == "snapshot_fact":
            return companies.wanted(self.stored(name), company_ids)
        return self.stored(name)

    def company_states(self, company_ids=None) -> DataFrame:
        """One row per company off the batches' states: loads so far, first time, last load. The log of loads
        is read only of batches that were stored before there were states."""
        return versions.merged_states(companies.wanted(self._states(self._visible()), company_ids))

    def _states(self, batches: DataFrame) -> DataFrame:
        """States of ``batches``, with ``batch_id``; their rows must have been listed before this is called."""
        kept = tables.folders(self.spark, f"{self.root}/company_states")
        states = tables.read_batches(self.spark, self.root, "company_states", schemas.COMPANY_STATES, kept)
        without = sorted(set(tables.folders(self.spark, f"{self.root}/load_log")) - set(kept))
        if without:
            log = tables.read_batches(self.spark, self.root, "load_log", schemas.LOAD_LOG, without)
            states = states.unionByName(versions.company_states(log, "batch_id"))
        return states.join(batches.select("batch_id"), "batch_id", "left_semi")

    # -- queries ---------------------------------------------------------------------------

    def list_companies(self, limit: int = fixed.PAGE_LIMIT_DEFAULT, offset: int = 0, after: tuple | None = None) -> DataFrame:
        """``after``: name and id of the last row of the page before."""
        states = self._states(self._visible())
        if after is not None:
            # A company's name never changes, as its id derives from it: names before the page aren't merged.
            states = states.filter(F.col("entity_name") >= after[0])
        return companies.list_companies(versions.companies_of(versions.merged_states(states)), limit, offset, after)

    def company(self, company_id) -> DataFrame:
        states = self.company_states(company_id)
        return companies.company_details(versions.companies_of(states), versions.current_versions_of(states), company_id)

    def company_versions(self, company_id) -> DataFrame:
        return companies.list_versions(*self._tables(company_id, "dim_company", "company_versions"))

    def company_snapshots(self, company_id) -> DataFrame:
        return companies.list_snapshots_of(self.table("snapshot_fact", company_id))

    def company_history(self, company_id) -> DataFrame:
        return companies.company_history(*self._tables(company_id, "company_versions", "snapshot_fact"))

    def company_series(self, company_id) -> DataFrame:
        return companies.latest_series(self.table("snapshot_fact", company_id))

    def compare_companies(self, request, day: date) -> DataFrame:
        """``request``: list of company ids, or a DataFrame ``pos, company_id``."""
        request, found_in = self._comparison(request)
        return companies.compare_companies(request, *found_in, day)

    def compare_not_found(self, request, day: date) -> DataFrame:
        request, found_in = self._comparison(request)
        return companies.compare_not_found(request, *found_in, day)

    def list_snapshots(self, **filters) -> DataFrame:
        return snapshots.filter_snapshots(self.table("snapshot_fact"), **filters)

    def latest_snapshots(self) -> DataFrame:
        return snapshots.latest_per_company(self.table("snapshot_fact"))

    def snapshot(self, snapshot_id) -> DataFrame:
        return snapshots.snapshot_details(self.stored("snapshot_fact"), snapshot_id, self.stored("raw_values"))

    def list_uploads(self) -> DataFrame:
        return uploads.list_uploads(self.table("upload_audit"))

    def upload(self, upload_id) -> DataFrame:
        return uploads.get_upload(self.table("upload_audit"), upload_id)

    def upload_stats(self) -> DataFrame:
        return uploads.upload_stats(self.table("upload_audit"))

    def upload_files(self, directory: str) -> DataFrame:
        """Uploads and whether their file is still in ``directory``."""
        return workbooks.file_presence(self.table("upload_audit"), workbooks.workbook_files(self.spark, directory))

    def star(self) -> DataFrame:
        names = ["snapshot_fact", "dim_company", "company_versions", "upload_audit", "data_quality_report"]
        return snapshots.star(*[self.table(n) for n in names])

    def _tables(self, company_ids, *names: str) -> list[DataFrame]:
        return [self.table(name, company_ids) for name in names]

    def _comparison(self, request) -> tuple[DataFrame, list[DataFrame]]:
        if not isinstance(request, DataFrame):
            request = companies.requested(self.table("dim_company"), request)
        log = self.stored("load_log")
        return request, [self.table("dim_company", request), log, companies.wanted(self.table("snapshot_fact"), request)]

    # -- loading ---------------------------------------------------------------------------

    def load_directory(self, directory: str, batch_at: datetime | None = None, **options) -> dict:
        """Find workbooks with content not loaded yet and load them as one batch.

        Files that are as they were when their content was last found loaded are told by their listing and
        not opened. All others are read and decoded, once: new ones, ones overwritten in place and ones that failed.
        """
        found = workbooks.workbook_files(self.spark, directory)
        seen = tables.read_table(self.spark, self.root, "seen_files", SEEN).select(*workbooks.LISTED)
        unseen = found.select(*workbooks.LISTED).join(seen.distinct(), workbooks.LISTED, "left_anti")
        content = workbooks.file_contents(found, unseen)
        if content is None:
            return _result(0)
        return self.load_rows(workbooks.scan_sheet(content), batch_at, listed=unseen, **options)

    def load_rows(
        self,
        rows: DataFrame,
        batch_at: datetime | None = None,
        batch_id: str | None = None,
        on_error: str = "load",
        align: str = "packed",
        listed: DataFrame | None = None,
    ) -> dict:
        """Load scanned sheet rows as one batch; content loaded by other batches is left out.

        ``on_error="quarantine"`` fails files with error findings instead of loading them. ``listed``
        (``path, length, modificationTime``) are the files as listed, to be remembered once loaded.
        """
        if on_error not in ("load", "quarantine"):
            raise ValueError(f"on_error must be 'load' or 'quarantine', not {on_error!r}")
        batch_at = batch_at or datetime.now(timezone.utc)
        batch_id = batch_id or batch_at.strftime("%Y%m%dT%H%M%S%f")
        attempt = f"{batch_id}.{uuid.uuid4().hex}"

        # Decoding is the costly part and everything below reads it: keep it as a table.
        rows = self._stage(attempt, "rows", rows)
        hashes = self._stage(attempt, "hashes", self._file_hashes(rows))
        self._keep_former_hashes()
        new = fingerprints.new_files(hashes, self._completed(hashes, batch_id))
        pending = self._stage(attempt, "pending", loading.register_pending(new, batch_id, batch_at))
        result = _result(0)
        if not pending.isEmpty():
            result = self._load_pending(rows, pending, batch_id, attempt, batch_at, on_error, align)
        if listed is not None:
            loaded = hashes.join(fingerprints.completed_hashes(self._completed(hashes)), "file_sha256", "left_semi")
            known = listed.join(loaded.withColumnRenamed("file_id", "path"), "path")
            tables.write_batch(known, self.root, "seen_files", SEEN, attempt)
        tables.remove(self.spark, f"{self.staging}/batch_id={attempt}")
        return result

    def _load_pending(self, rows, pending, batch_id, attempt, batch_at, on_error, align) -> dict:
        registered = pending.select("upload_id", F.col("file_path").alias("file_id"))
        readable = registered.join(rows.filter("row_idx = 0 and error is null").select("file_id"), "file_id")
        new_rows = rows.join(registered.select("file_id"), "file_id", "left_semi")
        # Records are small but costly to check and to lay out as facts: they are spread by their number, not their size.
        tasks = -(-pending.count() // RECORDS_PER_TASK)
        records = sheets.records(new_rows, files=readable).join(registered, "file_id").repartition(tasks, "file_id")
        records = self._stage(attempt, "records", rules.check(metrics.with_series(records, align)))

        failure = loading.load_failure()
        if on_error == "quarantine":
            rejected = F.concat(F.lit("validation failed: errors "), F.col("error_count").cast("string"))
            failure = F.coalesce(failure, F.when(~F.col("is_valid"), rejected))
        judged = records.withColumn("error_message", failure)
        loads = judged.filter("error_message is null")
        failed = judged.filter("error_message is not null").select("upload_id", "error_message").unionByName(
            registered.join(rows.filter("error is not null"), "file_id").select(
                "upload_id", F.col("error").alias("error_message")
            )
        )

        # Dimensions, then versions and facts, then the audit; the batch row makes them visible.
        for name, key, incoming in self._dimension_rows(loads, batch_at):
            self._write(name, dims.new_members(incoming, self.stored(name, besides=batch_id), key), attempt)
        # In the order of reads by company and time, so that file statistics prune them.
        by_company = lambda df, time: df.sortWithinPartitions("company_id", time)
        log = loading.load_log(loads, batch_at)
        self._write("load_log", by_company(log, "loaded_at"), attempt)
        self._write("company_states", by_company(versions.company_states(log), "last_at"), attempt)
        self._write("snapshot_fact", by_company(loading.facts(loads, batch_at), "snapshot_at"), attempt)
        lineage = sheets.raw_values(new_rows).join(loads.select("file_id", "upload_id"), "file_id")
        self._write("raw_values", lineage, attempt)
        self._write("data_quality_report", loading.quality_reports(loads, batch_at), attempt)
        extracted = loading.rows_extracted(self.stored_batch("raw_values", attempt), "upload_id")
        events = [
            pending,
            loading.mark_failed(failed, batch_at),
            loading.mark_completed(loads, extracted, batch_at),
        ]
        self._write("upload_events", reduce(DataFrame.unionByName, events), attempt)
        self._keep_hashes(pending.join(loads.select("upload_id"), "upload_id").select("file_sha256").distinct().withColumn("batch_id", F.lit(attempt)))
        done = self.spark.createDataFrame([(attempt, datetime.now(timezone.utc), None, None)], BATCHES)
        tables.append(done, self.root, "batches", BATCHES, batch_id)

        counts = {r.status: r["count"] for r in self.stored_batch("upload_events", attempt).groupBy("status").count().collect()}
        return _result(counts.get("pending", 0), counts.get("completed", 0), counts.get("failed", 0), batch_id)

    def compact(self, batch_id: str | None = None, max_loads: int | None = None) -> int:
        """Rewrite visible batches as one, facts and log in the order of company and time; returns how many.

        ``max_loads``: only batches of at most so many loads are merged, larger ones stay as they are. Once its
        folders are complete, one file names the new batch and those that it replaces, so readers see either the former
        ones or the new one. Other batches may be loaded meanwhile; the merged ones mustn't be repeated, and one
        compaction runs at a time. ``expire`` removes the old folders. Names of batches pass the driver, rows don't.
        """
        self._keep_former_hashes()
        visible = self._visible()
        if max_loads is not None:
            loads = tables.read_table(self.spark, self.root, "load_log", schemas.STORED["load_log"]).groupBy("batch_id").count()
            visible = visible.join(loads, "batch_id", "left").filter(F.coalesce("count", F.lit(0)) <= max_loads)
        merged = {r.batch_id: r.completed_at for r in visible.select("batch_id", F.unix_micros("completed_at").alias("completed_at")).collect()}
        if len(merged) < (1 if max_loads is None else 2):
            return 0
        now = datetime.now(timezone.utc)
        batch_id = batch_id or f"compacted-{now.strftime('%Y%m%dT%H%M%S%f')}"
        taken = tables.read_table(self.spark, self.root, "batches", BATCHES).filter(F.col("batch_id") == batch_id)
        if not taken.isEmpty():
            raise ValueError(f"there is a batch {batch_id!r} already")
        attempt = f"{batch_id}.{uuid.uuid4().hex}"
        of_merged = F.col("batch_id").isin(list(merged))
        times = {"load_log": "loaded_at", "snapshot_fact": "snapshot_at", "company_states": "last_at"}
        for name, schema in schemas.STORED.items():
            # Of dimensions only the rows that readers see go over: the new batch counts as complete as early as its first.
            rows = self._first_rows(name) if name in FIRST_STAYS else tables.read_table(self.spark, self.root, name, schema)
            rows = rows.filter(of_merged)
            if name == "company_states":
                rows = versions.merged_states(self._states(visible))
            if name in times:
                rows = rows.repartitionByRange("company_id", times[name]).sortWithinPartitions("company_id", times[name])
            self._write(name, rows, attempt)
        hashes = tables.read_table(self.spark, self.root, "loaded_hashes", HASHES).filter(of_merged)
        self._keep_hashes(hashes.select("file_sha256").distinct().withColumn("batch_id", F.lit(attempt)))
        # What is known of files holds whatever their batch: all of it becomes one folder.
        known = tables.folders(self.spark, f"{self.root}/seen_files")
        if known:
            seen = tables.read_table(self.spark, self.root, "seen_files", SEEN).filter(F.col("batch_id").isin(known))
            tables.write_batch(seen.drop("batch_id").distinct(), self.root, "seen_files", SEEN, attempt)
        replaced = [None, *merged, *(f"seen_files/{name}" for name in known)]
        rows = self.spark.createDataFrame([(attempt, r, now) for r in replaced], "attempt string, replaces string, replaced_at timestamp")
        rows = rows.withColumn("completed_at", F.timestamp_micros(F.lit(min(merged.values()))))
        tables.append(rows.coalesce(1), self.root, "batches", BATCHES, batch_id)
        return len(merged)

    def expire(self, older_than: timedelta = timedelta(days=7)) -> int:
        """Remove folders that no reader has needed for ``older_than``; returns how many.

        These are folders of attempts that were replaced or repeated so long ago, and of attempts that were never
        named and whose newest file is so old. No load and no read may take as long as ``older_than``. Rows of
        ``batches`` go after what they hide, so an expiry that dies half way changes no result and is run again.
        """
        cutoff = datetime.now(timezone.utc) - older_than
        done = tables.read_table(self.spark, self.root, "batches", BATCHES)
        micros = [F.unix_micros(c).alias(c) for c in ("completed_at", "replaced_at")]
        # One row a batch, as the listing of folders has.
        pointers = done.select("batch_id", "attempt", "replaces", *micros).collect()
        visible = {r.batch_id for r in self._visible().select("batch_id").collect()}
        last, ended = {}, {}
        for p in pointers:
            last[p.batch_id] = max(last.get(p.batch_id, (0, "")), (p.completed_at, p.attempt))
        for p in pointers:
            if p.attempt != last[p.batch_id][1]:
                ended[p.attempt] = last[p.batch_id][0]
        ended |= {p.replaces: p.replaced_at for p in pointers if p.replaces}
        named = {p.attempt for p in pointers}
        limit = int(cutoff.timestamp() * 1_000_000)

        def over(path: str, attempt: str) -> bool:
            if attempt in visible:
                return False
            if attempt in ended or attempt in named:
                return ended.get(attempt, limit) < limit
            newest = tables.newest_file(self.spark, path)
            return newest is not None and newest < limit

        places = [f"{self.root}/{name}" for name in schemas.STORED]
        hashes = f"{self.root}/loaded_hashes"
        places += [f"{hashes}/digits={d}" for d in tables.folders(self.spark, hashes, "digits")]
        gone = [f"{at}/batch_id={a}" for at in (*places, self.staging) for a in tables.folders(self.spark, at) if over(f"{at}/batch_id={a}", a)]
        seen = f"{self.root}/seen_files"
        gone += [f"{seen}/batch_id={a}" for a in tables.folders(self.spark, seen) if ended.get(f"seen_files/{a}", limit) < limit]
        # A batch's row is hidden by the one that replaced it, which thus goes later.
        hidden = sorted((ended[a], b) for b, (_, a) in last.items() if ended.get(a, limit) < limit)
        gone += [f"{self.root}/batches/batch_id={b}" for _, b in hidden]
        for path in gone:
            tables.remove(self.spark, path)
        return len(gone)

    def stored_batch(self, name: str, attempt: str) -> DataFrame:
        return tables.read_table(self.spark, self.root, name, schemas.STORED[name]).filter(
            F.col("batch_id") == attempt
        )

    def _file_hashes(self, rows: DataFrame) -> DataFrame:
        """``file_id, file_sha256`` of every scanned file, empty and unreadable ones too."""
        files = rows.filter("row_idx = 0").select("file_id", "error")
        of_nothing = F.sha2(F.lit(""), 256)
        # Stands in where there is nothing to hash; never taken as loaded, as it never completes.
        of_error = F.sha2(F.concat_ws(":", "file_id", "error"), 256)
        file_hash = F.when(F.col("error").isNotNull(), of_error).otherwise(F.coalesce("file_sha256", of_nothing))
        return files.join(fingerprints.fingerprints(rows), "file_id", "left").select(
            "file_id", file_hash.alias("file_sha256")
        )

    def _completed(self, hashes: DataFrame, besides: str | None = None) -> DataFrame:
        """``file_sha256, status`` of the content loaded so far, as far as it may be in ``hashes``.

        Only folders of digits that ``hashes`` begin with are listed and read: of a batch of few files a small
        part of the history, however long that is.
        """
        digits = [r["digits"] for r in hashes.select(F.substring("file_sha256", 1, 2).alias("digits")).distinct().collect()]
        found = tables.read_parts(self.spark, self.root, "loaded_hashes", HASHES, "digits", digits)
        return found.join(self._visible(besides), "batch_id", "left_semi").select("file_sha256", F.lit("completed").alias("status"))

    def _keep_hashes(self, hashes: DataFrame) -> None:
        """Append ``file_sha256, batch_id`` of loaded content; of attempts that are never named no reader sees them."""
        by_digits = hashes.withColumn("digits", F.substring("file_sha256", 1, 2)).repartition(HASH_TASKS, "digits")
        by_digits.write.mode("append").partitionBy("digits", "batch_id").parquet(f"{self.root}/loaded_hashes")

    def _keep_former_hashes(self) -> None:
        """Hashes of a warehouse that was begun before they had a table of their own."""
        if tables.exists(self.spark, f"{self.root}/loaded_hashes") or not tables.exists(self.spark, f"{self.root}/batches"):
            return
        events = tables.read_table(self.spark, self.root, "upload_events", schemas.STORED["upload_events"])
        ended = events.groupBy("upload_id", "batch_id").agg(F.max("file_sha256").alias("file_sha256"), F.max(F.col("status") == "completed").alias("completed"))
        self._keep_hashes(ended.filter("completed").select("file_sha256", "batch_id").distinct())

    def _dimension_rows(self, loads: DataFrame, batch_at: datetime):
        loads = loads.withColumns(
            {"loaded_at": F.lit(batch_at), "years": metrics.years(F.col("year_values"))}
        )
        yield "dim_country", "country_id", dims.countries(loads, "country", "loaded_at")
        yield "dim_currency", "currency_id", dims.currencies(loads, "currency", "loaded_at")
        yield "dim_date", "date_id", dims.year_dates(loads, "years", ["upload_id"])

    def _write(self, name: str, df: DataFrame, attempt: str) -> None:
        tables.write_batch(df, self.root, name, schemas.STORED[name], attempt)

    def _stage(self, attempt: str, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.staging}/batch_id={attempt}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def _result(found: int, completed: int = 0, failed: int = 0, batch_id: str | None = None) -> dict:
    return {"batch_id": batch_id, "new": found, "completed": completed, "failed": failed}
