"""Wall time of the headline queries; prints one JSON line.

Each query runs once to warm up and is then timed to completion of all its rows.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from datetime import datetime, timezone
from pathlib import Path

from sheetstar.plans.catalog import QUERIES
from sheetstar.plans.warehouse import Warehouse
from sheetstar.session import local_session
from sheetstar.sources.workbooks import scan_sheet, workbook_files
from tests.sheets import clean, write_workbook

HEADLINE = [
    "snapshots_latest", "snapshots_filtered", "compare_as_of", "scd2_versions", "company_detail", "company_history",
    "company_series", "upload_stats", "file_fingerprint", "document_fingerprint", "new_files", "sheet_wide",
    "metric_series", "findings", "finding_summary", "loaded_facts", "integrity_unique", "integrity_fk",
    "dim_country", "dim_company", "next_versions", "snapshot_star",
]


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def load_times(spark, workbooks: int = 300) -> dict[str, float]:
    """Seconds to decode generated workbooks, to load them all, and to find nothing new in a second look."""
    folder = tempfile.TemporaryDirectory(prefix="bench-")
    landing = Path(folder.name) / "landing"
    landing.mkdir()
    for i in range(workbooks):
        write_workbook(landing / f"{i}.xlsm", clean(metric=[float(i), float(i + 1)]))
    warehouse = Warehouse(spark, f"{folder.name}/warehouse")
    found = {}
    start = time.perf_counter()
    scan_sheet(workbook_files(spark, str(landing))).write.format("noop").mode("overwrite").save()
    found["scan_workbooks"] = round(time.perf_counter() - start, 3)
    for name, day in (("load_workbooks", 1), ("poll_unchanged", 2)):
        start = time.perf_counter()
        warehouse.load_directory(str(landing), datetime(2025, 1, day, tzinfo=timezone.utc))
        found[name] = round(time.perf_counter() - start, 3)
    folder.cleanup()
    return found


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for name in HEADLINE:
        cold[name] = round(timed(QUERIES[name], spark, sf_dir), 3)
        warm[name] = round(timed(QUERIES[name], spark, sf_dir), 3)
    warm |= load_times(spark)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries, warm",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "spark": spark.version,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
