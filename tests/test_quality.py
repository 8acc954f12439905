from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tidemark.fixtures import RAW_TABLES
from tidemark.functions.dates import instant
from tidemark.operators import quality as q
from tidemark.plans import checks
from tidemark.plans.refresh import MARTS, STAGED, refresh

# How many checks of each kind there are.
COLUMN_KINDS = {
    "not_null": 141, "positive": 53, "accepted_values": 20, "max": 14, "unique": 10, "min": 9,
}
BUSINESS_KINDS = {
    "violation": 46, "count": 14, "group": 5, "distinct": 3, "sum": 2, "latest": 2, "unique": 1,
    "order": 1,
}


@pytest.fixture(scope="module")
def tables(market):
    return {n: market.stored(n) for n in (*RAW_TABLES, *STAGED, *MARTS)}


def test_every_check_is_there(spark, tables):
    column = Counter(
        c.kind for n, df in tables.items() for c in checks.CONTRACTS[n].checks(df.columns)
    )
    business = checks.business_checks(instant(None))
    assert column == COLUMN_KINDS
    assert Counter(c.kind for cs in business.values() for c in cs) == BUSINESS_KINDS
    numbers = sorted(c.name[:3] for cs in business.values() for c in cs)
    assert numbers == [f"C{i:02d}" for i in range(1, 75)]
    assert set(business) == set(checks.CONTRACTS) == set(tables)


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(
        [("a", 1.0, "x"), ("a", -1.0, "y"), (None, None, None), ("b", 9.0, "z")],
        "k string, v double, w string",
    )


@pytest.mark.parametrize(
    ("check", "observed", "passed", "when_empty"),
    [
        (lambda: q.violation("c", F.col("v") < 0), 1, False, True),
        (lambda: q.violation("c", F.col("v") > 10), 0, True, True),
        (lambda: q.count("c", ">=", 4), 4, True, False),
        (lambda: q.count("c", "=", 1, F.col("k") == "b"), 1, True, False),
        (lambda: q.total("c", "v", 9.05, 0.1), 9, True, False),
        (lambda: q.total("c", "v", 9.1, 0.1), 9, False, False),
        (lambda: q.distinct("c", "k", "=", 2), 2, True, False),
        (lambda: q.unique("c", "k"), 2, False, True),
        (lambda: q.unique("c", "k", nulls_count=False), 1, False, True),
        (lambda: q.groups("c", ["k"], "=", 3), 3, True, False),
        (lambda: q.groups("c", ["k"], "=", 0, having=F.col("_n") > 1), 1, False, True),
        (lambda: q.latest_count("c", "v", "=", 1), 1, True, False),
        (lambda: q.latest_unique("c", "v", "k"), 0, True, True),
        (lambda: q.ordered("c", "w", "v"), 1, False, True),
    ],
)
def test_kinds(sample, check, observed, passed, when_empty):
    check = check()
    one = q.dq_suite("t", sample, [check]).first()
    assert (one.observed, one.passed) == (observed, passed)
    assert q.dq_suite("t", sample.limit(0), [check]).first().passed is when_empty


def test_contract_rules_do_not_judge_null(sample):
    contract = q.Contract(
        optional=("w",),
        positive=("v",),
        unique=("k",),
        accepted={"w": ["x", "y"]},
        least={"v": 0},
        most={"v": 5},
    )
    out = q.dq_suite("t", sample, contract.checks(sample.columns))
    assert rows(out, "check_name", "observed") == [
        ("k not_null", 1.0),
        ("k unique", 1.0),
        ("v max", 1.0),
        ("v min", 1.0),
        ("v not_null", 1.0),
        ("v positive", 1.0),
        ("w accepted_values", 1.0),
    ]


def test_suite_equals_one_query_per_check(market, tables):
    name = "assets"
    every = checks.all_checks({name: tables[name]}, market.now)[name]
    together = rows(q.dq_suite(name, tables[name], every))
    apart = [rows(q.dq_suite(name, tables[name], [c]))[0] for c in every]
    assert together == sorted(apart, key=repr)


def test_row_checks_share_one_scan(tables):
    text = q.dq_suite(
        "t", tables["raw_assets"], [c for c in checks.CONTRACTS["raw_assets"].checks(
            tables["raw_assets"].columns) if c.rows is not None],
    )._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation") == 1


def test_checks_of_one_key_set_share_a_grouping(market, tables):
    for name, scans, by in (("assets", 2, "id"), ("top_performers", 3, "performance_category")):
        suite = checks.all_checks({name: tables[name]}, market.now)[name]
        if name == "assets":
            assert {c.keys for c in suite if c.keys} == {("id",)}
        plan = q.dq_suite(name, tables[name], suite)._jdf.queryExecution().executedPlan().toString()
        # a reused subquery is listed again by its name only
        grouped = {line.split("functions=")[0].split("(", 1)[1] for line in plan.splitlines()
                   if f"HashAggregate(keys=[{by}#" in line and "partial_count" in line}
        assert len({g for g in grouped if g.count("#") == 1}) == 1
        assert plan.count("Scan parquet") <= scans * 2


def test_inversions_against_pairwise_join(spark):
    df = spark.createDataFrame(
        [(1, 10), (1, 40), (2, 20), (3, 50), (4, 45), (5, 60), (5, 5)], "d int, t int"
    )
    later = df.alias("b").join(
        df.alias("a"), (F.col("a.d") < F.col("b.d")) & (F.col("a.t") > F.col("b.t"))
    )
    assert rows(q.inversions(df, "d", "t")) == rows(later.select("b.d").distinct())


def test_failed_check_stops_the_refresh(spark, market, folder):
    raw = {n: market[n] for n in RAW_TABLES}
    with pytest.raises(q.QualityError, match="anchor asset present"):
        refresh(raw, folder("blocked"), market.now)
    tables = refresh(raw, folder("open"), market.now, blocking=False)
    assert set(tables) == {*RAW_TABLES, *STAGED, *MARTS}
    assert tables["market_regime"].count() == 1
