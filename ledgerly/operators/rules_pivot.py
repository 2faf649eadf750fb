"""Account-rule match in the pivoted shape: rules pivoted by attribute, one
join per attribute, results stacked with ``UNION ALL``.

Kept as the equivalence reference for ``postings.match_rules`` (which does the
same in one join) and for users who store their rules pivoted. It scans the
line frame once per attribute, so prefer ``match_rules`` in pipelines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerly.functions import check_columns
from ledgerly.operators.rules import ACCOUNT_FIELDS, MATCH_KEYS, RuleSet


def pivoted_accounts(rules: RuleSet, names: list[str]) -> DataFrame:
    """Pivoted rules joined to the chart of accounts (account number only)."""
    wide = rules.rules_wide(names)
    chart = rules.chart_of_accounts.select("NUM_CUENTA", *ACCOUNT_FIELDS)
    return wide.join(chart, wide.COD_CUENTA == chart.NUM_CUENTA, "inner").drop("NUM_CUENTA")


def match_rules_pivot(lines: DataFrame, rules: RuleSet) -> DataFrame:
    names = check_columns(lines, rules.names()["attributes"], "account rules")
    cc = pivoted_accounts(rules, names)
    parts = []
    for a in names:
        side = cc.filter(F.col(f"`{a}`").isNotNull()).select(
            *[F.col(k).alias(f"R_{k}") for k in MATCH_KEYS],
            F.col(f"`{a}`").alias("R_VALOR"), "COD_CUENTA", *ACCOUNT_FIELDS)
        side = rules.small("rule_accounts", side)
        left_val = lines[a]
        dtype = lines.schema[a].dataType
        right_val = side.R_VALOR if isinstance(dtype, StringType) else side.R_VALOR.try_cast(dtype)
        cond = left_val == right_val
        for k in MATCH_KEYS:
            lk = lines[k].try_cast("int") if k == "NATURALEZA" else lines[k]
            cond = cond & (lk == side[f"R_{k}"])
        parts.append(lines.join(side, cond, "inner")
                     .select(*[lines[c] for c in lines.columns], "COD_CUENTA",
                             *ACCOUNT_FIELDS))
    if not parts:
        return lines.limit(0).select("*", *[F.lit(None).alias(c) for c in
                                            ["COD_CUENTA", *ACCOUNT_FIELDS]])
    return reduce(DataFrame.unionByName, parts)
