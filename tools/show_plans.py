"""Write the physical plans of the headline queries to PLANS.md.

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from countlens.plans import jobs  # noqa: E402
from countlens.plans import testbed as tb  # noqa: E402
from countlens.plans.reports import growth_report, top_n_from_day_totals  # noqa: E402
from countlens.plans.testbed import QUERIES  # noqa: E402
from countlens.session import build_session  # noqa: E402

SHOW = [
    ("top_n_by_day", "R1: daily top 10, label join that Spark may broadcast"),
    ("top_n_by_month", "R2: monthly top 10 rolled up from the daily report"),
    ("decline_report", "R3: one scan for both periods, OR-ed ranges pushed down"),
    ("growth_report", "R4: same shape as R3"),
    ("sensor_counts_data_tests", "C1-C7 on one table: one aggregate + one grouped count"),
]


def day_totals_plans(spark, sf_dir):
    """Plans of the month-partitioned job path (what the jobs write)."""
    raw_db, report_db = tb.build_incremental_mart(spark, sf_dir)
    days = spark.table(f"{report_db}.{jobs.DAY_TOTALS}")
    dim = spark.table(f"{raw_db}.{jobs.SENSOR_REFERENCE}")
    landed = tb.raw_count_file_rows(spark, sf_dir)
    batch = tb.scratch_path(spark, "plan-batch")
    landed.write.option("header", True).csv(batch)
    totals = jobs.day_totals(
        jobs.read_landed_counts(spark, batch), "date_time", "sensor_id", "hourly_count",
        keys=(jobs.MONTH_COL,),
    ).hint("rebalance", jobs.MONTH_COL)
    return [
        ("refresh_day_totals", "day totals of a landed batch, regrouped by month for the "
         "partitioned write", totals),
        ("top_n_by_day from day totals", "R1 from the stored day totals: ranking only; "
         "the small aggregate sums the NULL day of unparsed rows over source files",
         top_n_from_day_totals(jobs._one_row_per_day(days), dim)),
        ("growth_report from day totals", "R4 from the stored day totals: only the months "
         "of the two periods are read (PartitionFilters)",
         growth_report(days, dim, tb.CURRENT, tb.LAST, ts_col="day", value_col="total",
                       rows_col="n_rows", month_col=jobs.MONTH_COL)),
        ("data_tests from check failures", "row checks of the counts summed from the "
         "per-month failures; only unique(id) scans the counts (id column)",
         jobs.data_tests(spark, raw_db, report_db,
                         check_failures_table=f"{report_db}.{jobs.CHECK_FAILURES}")),
    ]


def plan_text(df, mode):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    # drop expression ids (#123) so the file is stable between runs
    text = re.sub(r"#\d+L?", "", buf.getvalue())
    # and the per-run tags of the scratch databases
    return re.sub(r"cl_(\w+?)_i_[0-9a-f]{32}", r"\1", text)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    out = [
        "# Physical plans of the headline queries",
        "",
        f"Generated by `tools/show_plans.py` on `{os.path.basename(sf_dir)}` "
        "(Spark 4.1, AQE on; plans before adaptive re-optimisation).",
        "",
    ]
    items = [(name, what, QUERIES[name](spark, sf_dir)) for name, what in SHOW]
    for name, what, df in items + day_totals_plans(spark, sf_dir):
        text = plan_text(df, "formatted")
        tree = text.split("\n\n")[0]
        scans = [
            re.sub(r"file:[^,\]]*", "<path>", ln)
            for ln in text.splitlines()
            if ln.startswith(("ReadSchema", "PushedFilters", "PartitionFilters"))
        ]
        out += [f"## {name}", "", what, "", "```", tree.strip(), "", *scans, "```", ""]
    spark.stop()
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
