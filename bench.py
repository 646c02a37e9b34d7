"""Time headline queries and print one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

import json
import os
import re
import time

from loanfold.bindings import REGISTRY
from loanfold.bindings.raw import RAW, raw_tables
from loanfold.session import local_session, scratch_path
from loanfold.sources.tables import Tables

# One query per kind of work, and every silver table.
HEADLINE = (
    "j8_two_roles", "j10_coalesced_key_join", "j15_entity_self_join", "a10_ordered_list", "a15_guarded_ratio", "w1_latest_per_key",
    "w7_newest_n", "w10_global_sequence", "w11_group_max", "c5_kyc_by_document", "c7_dpd_bucket", "c10_portfolio_quality",
    "c12_officer_scorecard", "c13_tenure_metrics", "c17_receipt_summary", "c22_last_sanctioner", "c26_dpd_trend",
    "c27_multi_loan_stress", "c29_non_starter", "c38_indicator_text", "c41_monthly_backfill", "c45_consecutive_bounces",
    "g1_loan_details", "g2_customer", "g3_contract_perf_monthly", "g4_asset", "g5_channel_partner", "g6_repayment_behavior", "g7_employee",
    "g8_branch", "g9_collections_daily", "g10_early_warning", "g11_branch_historical", "g12_enquiry", "g13_loan_processing",
)


def written(spark, sf_dir: str) -> Tables:
    """The derived loan tables as files, written before anything is timed."""
    folder, derived = scratch_path(spark, "raw"), raw_tables(spark, sf_dir)
    for name in RAW:
        derived[name].write.parquet(f"{folder}/{name}")
    return Tables.from_folder(spark, folder)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", "").split() or [n for n in HEADLINE if n in REGISTRY]
    if names == ["all"]:
        names = list(REGISTRY)
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "loanfold-bench", memory=os.environ.get("BENCH_MEMORY", "12g"))
    raw = written(spark, sf_dir)
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir, raw).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": float(found.group(1)) if found else None}))
    spark.stop()


if __name__ == "__main__":
    main()
