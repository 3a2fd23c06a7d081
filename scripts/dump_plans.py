"""Write the physical plans of the headline stages to PLANS.md (stored inputs).

Usage: python scripts/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratum.plans import gold, merchants, transactions, users  # noqa: E402
from stratum.session import build_session, shared_path  # noqa: E402
from stratum.sources import fixtures  # noqa: E402


def formatted(df) -> str:
    """The plan as Spark would start it; adaptive execution may still change it."""
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    root = shared_path(spark, "plans", fresh=True)
    fixtures.raw_transactions(spark, sf_dir).write.parquet(f"{root}/bronze_tx")
    fixtures.raw_merchants(spark, sf_dir).write.parquet(f"{root}/bronze_m")
    fixtures.raw_users(spark, sf_dir).write.parquet(f"{root}/bronze_u")
    rd = spark.read.parquet
    transactions.clean(transactions.validate(rd(f"{root}/bronze_tx"))).write.parquet(f"{root}/tx")
    merchants.clean(merchants.validate(rd(f"{root}/bronze_m"))).write.parquet(f"{root}/m")
    k = gold.daily_kpis(rd(f"{root}/tx"))
    k.write.partitionBy("transaction_date").parquet(f"{root}/kpi")
    kpis = rd(f"{root}/kpi").select(*k.columns)
    stages = {
        "silver: transactions normalise + dedup + rules": transactions.validate(rd(f"{root}/bronze_tx")),
        "gold: daily KPIs": gold.daily_kpis(rd(f"{root}/tx")),
        "gold: merchant risk summary": gold.merchant_risk_summary(kpis, rd(f"{root}/m")),
        "gold: fraud alerts": gold.fraud_alerts(kpis),
        "silver: users flags": users.validated(rd(f"{root}/bronze_u"), keep=("_seq",)),
    }
    out = ["# Physical plans of the headline stages", "",
           f"Generated by `scripts/dump_plans.py` on `{sf_dir}` (plans before "
           "adaptive re-planning, inputs stored as Parquet as in the pipeline).", ""]
    for title, df in stages.items():
        out += [f"## {title}", "", "```", formatted(df).strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()
