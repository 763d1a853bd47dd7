"""Publishing of reports (PIPE-18, IO-11, IO-12)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitlens.sources.facts import Facts
from profitlens.sources.files import replace_table, swap_version, write_report, write_version
from profitlens.sources.versions import publish_set


def publish_reports(reports: Mapping[str, DataFrame], out_dir: str, company: str, period: str,
                    fmt: str = "parquet") -> dict[str, str]:
    """PIPE-18: every report under its own name, in the partition of a company and
    period; those of other companies and periods stay as they are. Plain folders, one
    after another; ``publish_reports_at_once`` commits the set."""
    return {name: write_report(df.withColumns({"company": F.lit(company), "period": F.lit(period)}), out_dir, name,
                               ("company", "period"), fmt) for name, df in reports.items()}


def publish_reports_at_once(reports: Mapping[str, DataFrame], root: str, company: str, period: str) -> int:
    """PIPE-18: the reports of a company and period as one commit (``read_published``
    reads them): readers see all of them or none. Returns the version."""
    return publish_set(reports, root, {"company": company, "period": period})


def publish_tables(reports: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """IO-10/IO-12: every report as a catalog table that replaces the last one. All are
    written before the first is swapped in."""
    made = {f"{prefix}{name}": write_version(df, f"{prefix}{name}") for name, df in reports.items()}
    for table, version in made.items():
        swap_version(next(iter(reports.values())).sparkSession, table, version)
    return [f"{prefix}{name}" for name in reports]


def stage_extracts(facts: Facts, tables: tuple[str, ...] = ("sales", "coupon"), prefix: str = "stage_") -> list[str]:
    """IO-11: conformed extracts as catalog tables, for the steps that run as SQL."""
    for t in tables:
        replace_table(getattr(facts, t), f"{prefix}{t}", zero_undefined=False)
    return [f"{prefix}{t}" for t in tables]
