"""Coupon reports (PIPE-01, PIPE-02)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from profitlens.operators.dims import first_wins
from profitlens.operators.rollup import combine, date_completeness

TYPE_MEASURES = ("net_sales_issued", "margin_issued", "net_sales_redeemed", "margin_redeemed",
                 "comp_net_alloc", "promo_comp_alloc")


def coupon_type_margin(coupon_type: DataFrame, coupon: DataFrame) -> DataFrame:
    """PIPE-02: issued / redeemed measures by store x coupon type ⟗ the coupon
    cost borne by the company (AGG-08 twice + full outer join as one shuffle)."""
    keys = ["store_id", "coupon_type_id"]
    return combine({"type": coupon_type, "cost": coupon}, keys,
                   {"type": list(TYPE_MEASURES), "cost": ["coupon_cost"]})


def union_extracts(extracts: Sequence[DataFrame]) -> DataFrame:
    """SET-01: N-way union by column name; columns missing in one extract are NULL."""
    out = extracts[0]
    for e in extracts[1:]:
        out = out.unionByName(e, allowMissingColumns=True)
    return out


def union_with_completeness(extracts: Sequence[DataFrame], date_col: str) -> DataFrame:
    """PIPE-01: union of period extracts and the per-day completeness check."""
    return date_completeness(union_extracts(extracts), date_col)


def coupon_type_master(coupon_type: DataFrame, coupon: DataFrame) -> DataFrame:
    """PIPE-03: coupon type names, the type extract first, then the coupon lines."""
    return first_wins([d.select("coupon_type_id", "coupon_type_name") for d in (coupon_type, coupon)],
                      "coupon_type_id", ["coupon_type_name"])
