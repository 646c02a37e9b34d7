"""The silver tables in the order in which they read each other."""

from collections.abc import Callable, Sequence
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ..operators.signals import LOAN
from ..session import scratch
from ..sources.publish import recover
from ..sources.sinks import bucketed_refresh, full_refresh, layout
from ..sources.tables import Tables
from . import (
    asset, branch, channel_partner, collections_daily, contract_perf_monthly, customer, early_warning, employee,
    enquiry, loan_details, loan_processing, repayment_behavior,
)


class SilverTable(NamedTuple):
    build: Callable[..., DataFrame]
    key: str
    sort: Sequence[str] = ()


# Table name -> build, distribution key, sort keys. A table only reads those above it.
SILVER = {
    "slv_loan_details": SilverTable(loan_details.build, "loan_application_id", ["branch_id", "loan_application_id"]),  # read by either
    "slv_customer": SilverTable(customer.build, "applicant_id", ["loan_application_id"]),
    "slv_contract_perf_monthly": SilverTable(contract_perf_monthly.build, "loan_application_id", ["snapshot_date"]),
    "slv_asset": SilverTable(asset.build, "loan_application_id", ["property_detail_id"]),
    "slv_channel_partner": SilverTable(channel_partner.build, "dsa_id"),
    "slv_repayment_behavior": SilverTable(repayment_behavior.build, "loan_application_id", ["pay_schedule_id"]),
    "slv_enquiry": SilverTable(enquiry.build, "lead_id"),
    "slv_loan_processing": SilverTable(loan_processing.build, "loan_application_id"),
    "slv_employee": SilverTable(employee.build, "employee_id", ["branch_id"]),
    "slv_branch": SilverTable(branch.build, "branch_id"),
    "slv_collections_daily": SilverTable(collections_daily.build, "loan_application_id", ["loan_due_status_id"]),
    "slv_branch_historical": SilverTable(branch.build_history, "branch_id", ["snapshot_date"]),
}


def refresh(spark: SparkSession, raw: Tables, database: str, as_of: date, run_ts: datetime,
            names: Sequence[str] = (), buckets: int | None = None) -> None:
    """Rebuild the named tables (all by default) and append the day's early-warning rows.

    Tables keyed by loan are written in buckets of the loan (by default as many as there are shuffle partitions), so that
    the tables after them join them without a shuffle.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in SILVER:
        recover(spark, f"{database}.{name}")
    silver = Tables.from_catalog(spark, database)
    for name, table in SILVER.items():
        if not names or name in names:
            with scratch(spark):
                df = table.build(raw, silver, as_of, run_ts)
                if table.key == LOAN:
                    bucketed_refresh(df, f"{database}.{name}", LOAN, buckets, table.sort)
                else:
                    full_refresh(layout(df, table.key, table.sort), f"{database}.{name}")
    if not names or early_warning.TABLE in names:
        early_warning.run(spark, raw, silver, database, as_of, run_ts)
