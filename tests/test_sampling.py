"""Stratified case sampling over the 4 x 2 x 5 case grid."""

import itertools

import pytest
from pyspark.sql import functions as F

from ledgerly.operators.filters import line_filter
from ledgerly.operators.sampling import case_sample
from ledgerly.plans.q_ops import (
    CASE_AGENCIES,
    CASE_LINE_GROUPS,
    CASE_STATUSES,
    case_dims,
)

GRID = list(itertools.product(range(len(CASE_STATUSES)), range(len(CASE_LINE_GROUPS)),
                              range(len(CASE_AGENCIES))))


@pytest.fixture(scope="module")
def sample(layers):
    f0 = line_filter(layers.f0)
    return f0, case_sample(f0, case_dims(), 5, ["COD_RECIBO"]).cache()


def test_total(sample):
    assert sample[1].count() == 198   # 40 cases, two of them short


@pytest.mark.parametrize("i,j,k", GRID)
def test_case(sample, i, j, k):
    f0, s = sample
    cond = ((F.col("COD_EST_REC") == CASE_STATUSES[i])
            & F.col("COD_RAMO").isin(*CASE_LINE_GROUPS[j])
            & (F.col("COD_AGENCIA") == CASE_AGENCIES[k]))
    expected = [r.COD_RECIBO for r in f0.filter(cond).orderBy("COD_RECIBO").limit(5).collect()]
    got = [r.COD_RECIBO for r in s.filter(F.col("CASE_ID") == f"{i}-{j}-{k}")
           .orderBy("COD_RECIBO").collect()]
    assert got == expected


def test_overlapping_predicates(spark):
    df = spark.range(20).withColumn("v", F.col("id"))
    dims = [[F.col("v") < 10, F.col("v") % 2 == 0]]
    s = case_sample(df, dims, 3, ["v"], overlapping=True)
    got = sorted((r.CASE_ID, r.v) for r in s.collect())
    assert got == [("0", 0), ("0", 1), ("0", 2), ("1", 0), ("1", 2), ("1", 4)]


def test_partial_group_limit_before_shuffle(layers):
    s = case_sample(line_filter(layers.f0), case_dims(), 5, ["COD_RECIBO"])
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
