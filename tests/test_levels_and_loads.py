"""Percentiles, cube, snapshot differences and the lake merge on odd rows."""

import random
from collections import Counter

import pytest

from riskloom.operators.quantiles import exact_percentiles
from riskloom.operators.snapshots import changes, multiset_difference
from riskloom.plans import merging
from riskloom.plans.portfolio_levels import concentration_cube
from riskloom.session import scratch_path
from riskloom.sources.tables import conform, load_domain
from tests.conftest import SF001


@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_percentiles_against_sorting(spark, by):
    rng = random.Random(1)
    big = 2 ** 62
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randint(0, 1), rng.choice([None, 7, 7, rng.randint(-big, big), rng.randint(-50, 50)]))
            for _ in range(600)] + [("only null", 0, None), ("one", 1, -big), ("wide", 0, -2 ** 63), ("wide", 0, 2 ** 63 - 1)]
    got = exact_percentiles(spark.createDataFrame(rows, "g string, h int, v long"), by, "v", [1, 50, 90, 100])
    groups = {}
    for g, h, v in rows:
        groups.setdefault(tuple({"g": g, "h": h}[b] for b in by), []).append(v)
    want = []
    for k, values in groups.items():
        vs = sorted(v for v in values if v is not None)
        want.append((*k, len(vs), *[vs[max(1, -(-len(vs) * p // 100)) - 1] if vs else None for p in (1, 50, 90, 100)]))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_percentiles_of_nothing(spark):
    assert exact_percentiles(spark.createDataFrame([], "g string, v long"), ["g"], "v", [50]).collect() == []


OLD = [(1, "a", 5), (1, "a", 5), (2, "b", None), (3, None, 1), (4, "d", 4), (None, "n", 1), (6, "f", 6), (7, "g", 1), (7, "h", 2)]
NEW = [(1, "a", 5), (2, "b", 3), (3, None, 1), (5, "e", 5), (None, "n", 2), (6, "f", 6), (6, "f", 6), (7, "g", 1), (7, "i", 9)]


def test_multiset_difference_and_changes(spark):
    frame = lambda rows: spark.createDataFrame(rows, "k int, copies_ string, v int")
    got = {tuple(r[:3]): r.copies for r in multiset_difference(frame(OLD), frame(NEW).select("v", "k", "copies_")).collect()}
    a, b = Counter(OLD), Counter(NEW)
    assert got == {r: b[r] - a[r] for r in set(OLD + NEW) if a[r] != b[r]}
    found = {r.k: tuple(r)[1:] for r in changes(frame(OLD), frame(NEW), ["k"]).collect()}
    assert found == {1: ("delete", 1, 0, None), 2: ("update", 1, 1, "v"), 4: ("delete", 1, 0, None), 5: ("insert", 0, 1, None),
                     None: ("update", 1, 1, "v"), 6: ("insert", 0, 1, None), 7: ("update", 1, 1, "copies_,v")}
    assert changes(frame(OLD), frame(OLD[::-1]), ["k"]).collect() == []


def test_cube_totals(spark):
    loans = load_domain(spark, SF001).loans
    rows = concentration_cube(loans).collect()
    total = [r for r in rows if r.level == 7]
    assert len(total) == 1 and total[0].total_loans == loans.count()
    assert total[0].borrowers == loans.select("customer_id").distinct().count()
    for level in range(8):
        assert sum(r.total_loans for r in rows if r.level == level) == total[0].total_loans


def _files(spark, name):
    return {f.split("/")[-1] for f in spark.table(name).inputFiles()}


def test_merge_rewrites_touched_years_only(spark):
    loans = conform(load_domain(spark, SF001).loans, "loan_applications")
    root = scratch_path(spark, "merge-test")
    spark.sql("CREATE DATABASE IF NOT EXISTS merge_test")
    name = "merge_test.loan_applications"
    merging.create_loan_table(spark, loans, name, root)
    before, rows = _files(spark, name), sorted(map(str, loans.collect()))
    years = sorted(r[0] for r in loans.select("disbursement_year").distinct().collect())
    one = loans.where(f"disbursement_year = {years[0]}").orderBy("loan_id").limit(2)
    ids = [r.loan_id for r in one.collect()]
    moved = one.withColumn("disbursement_year", one.disbursement_year + 1)  # to another partition
    for _ in range(2):  # merging again changes nothing
        assert merging.merge_loans(spark, name, root, moved) in ([years[0], years[0] + 1], [years[0] + 1])
        got = conform(spark.table(name), "loan_applications")
        assert got.count() == len(rows)
        assert {r.disbursement_year for r in got.where(got.loan_id.isin(ids)).collect()} == {years[0] + 1}
    kept = spark.table(name).where(f"disbursement_year > {years[0] + 1}").inputFiles()
    assert kept and {f.split("/")[-1] for f in kept} <= before  # untouched partitions keep their files
    # a whole year goes, and comes back
    last = loans.where(f"disbursement_year = {years[-1]}")
    assert merging.merge_loans(spark, name, root, loans.limit(0), last.select("loan_id")) == [years[-1]]
    assert spark.table(name).where(f"disbursement_year = {years[-1]}").count() == 0
    merging.merge_loans(spark, name, root, last.union(one))
    assert sorted(map(str, conform(spark.table(name), "loan_applications").collect())) == rows
    assert merging.merge_loans(spark, name, root, loans.limit(0)) == []
    # null ids enter and replace nothing
    odd = last.limit(1).selectExpr(*[f"CAST(NULL AS STRING) AS {c}" if c == "loan_id" else c for c in last.columns])
    merging.merge_loans(spark, name, root, odd, odd.select("loan_id"))
    assert spark.table(name).count() == len(rows) + 1
    spark.sql("DROP DATABASE merge_test CASCADE")
