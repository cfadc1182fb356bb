"""Every registered query equals its independent DuckDB SQL (row count, column
names, types and exact values), plus cross-report invariants."""

import pytest

from tests.conftest import SF001
from riskloom.oracle.compare import compare

from __spark_entry__ import entry, oracle_sql, queries
from riskloom.plans.registry import all_queries

NAMES = sorted(all_queries())


def test_every_report_has_an_oracle():
    assert set(NAMES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_sf0001(spark, name):
    rec = compare(spark, SF001, [name], verbose=False)[name]
    assert "error" not in rec, rec
    assert rec["cols_match"] and rec["types_match"] and rec["hash_match"], rec


ORDERED = [n for n in NAMES if oracle_sql()[n].rstrip().rsplit("\n", 1)[-1].startswith(("ORDER BY", "LIMIT"))]


def test_the_reports_are_ordered():
    assert len(ORDERED) >= 20


@pytest.mark.parametrize("name", ORDERED)
def test_rows_come_in_the_report_order(spark, duck001, name):
    df = queries()[name](spark, SF001)
    cur = duck001.execute(oracle_sql()[name])
    at = [[d[0] for d in cur.description].index(c) for c in df.columns]
    assert [tuple(map(str, r)) for r in df.collect()] == [tuple(str(r[i]) for i in at) for r in cur.fetchall()]


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["kri_name", "kri_value", "unit"]


def _q(spark, name, sf=SF001):
    return queries()[name](spark, sf)


def test_shares_add_up(spark):
    for name, col, groups in [("portfolio_by_loan_type", "portfolio_share_pct", 6),
                              ("geographic_concentration", "exposure_share_pct", 25),
                              ("credit_score_bands", "pct_of_portfolio", 6)]:
        vals = [r[col] for r in _q(spark, name).collect()]
        assert abs(sum(vals) - 100) <= 0.005 * groups + 1e-9


def test_kri_total_equals_portfolio_sum(spark):
    kri = {r.kri_name: r.kri_value for r in _q(spark, "kri_master").collect()}
    total = sum(r.total_exposure_inr for r in _q(spark, "portfolio_by_loan_type").collect())
    assert kri["Total Portfolio Exposure (INR)"] == str(total)


def test_vintage_rates_agree(spark):
    a = {r.disbursement_year: r.default_rate_pct for r in _q(spark, "vintage_default_rate").collect()}
    b = {r.disbursement_year: r.default_rate_pct for r in _q(spark, "vintage_yoy").collect()}
    assert a == b


def test_dpd_bucket_counts_add_to_active(spark):
    from riskloom.sources.tables import load_domain

    active = load_domain(spark, SF001).loans.where("loan_status = 'Active'").count()
    assert sum(r.accounts for r in _q(spark, "dpd_buckets").collect()) == active


@pytest.mark.parametrize("limit", [1, 100, 257, 1000, None])
def test_ranking_is_one_path_for_all_limits(spark, duck01, limit):
    from tests.conftest import SF01
    from riskloom.oracle.compare import rows_hash
    from riskloom.plans import trends
    from riskloom.sources.tables import load_domain

    d = load_domain(spark, SF01)
    df = trends.customer_risk_ranking(d.loans, d.customers, limit=limit)
    srows = [tuple(r) for r in df.collect()]
    cur = duck01.execute(oracle_sql()["customer_risk_ranking_all"] + (f"LIMIT {limit}" if limit else ""))
    drows = [tuple(r) for r in cur.fetchall()]
    assert len(srows) == len(drows)
    assert rows_hash(df.columns, srows) == rows_hash([c[0] for c in cur.description], drows)
