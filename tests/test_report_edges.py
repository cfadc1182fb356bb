"""Hand-made edge rows: every report's Spark plan (pre-aggregation, distributed
ranking, exact rounding) against the row-level report SQL run by DuckDB on the
very same rows.

The fixture holds what the derived test tables do not: a customer_id present
twice with different attributes, NULL scores / amounts / DPD, negative DPD,
loans without a customer and transactions without a loan, HAVING edges
(2 vs 3 flagged withdrawals, an amount of exactly 100000, 9 vs 10
transactions, a reversal rate of exactly 15 %, 4 vs 5 risky loans), a loan
type whose exposure is 0, a month without loans, and tied exposures.
"""

import pyarrow as pa
import pytest

from riskloom import schema as S
from riskloom.oracle.compare import rows_hash, spark_types
from riskloom.oracle.reports_sql import BODY
from riskloom.plans.registry import domain_queries
from riskloom.sources.tables import Domain

_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}


def _cust(cid, score, seg="Retail", emp="Salaried", state="S1"):
    return (cid, 40, state, emp, seg, 50000, score, 3, 1, 2015)


CUSTOMERS = [
    _cust("C1", 550), _cust("C2", 599, "SME", "Freelancer", "S2"),
    _cust("C3", 700), _cust("C3", 720, "Corporate", "Salaried", "S2"),  # duplicated id
    _cust("C4", None, "Mass", "Government", "S3"), _cust("C5", 830, "Premium"),
    _cust("C6", 830, "Premium"), _cust("C7", 300, "SME", "Freelancer", "S4"),
]


def _loan(lid, cid, ltype, amount, status, year, month, dpd, state="N1"):
    return (lid, cid, ltype, amount, 36, 9.5, status, year, month, 1000.0, dpd, state, "BR0001")


LOANS = (
    [_loan(f"L1{i}", "C1", "Personal", 100000 + i, "Active", 2020, 1, d)
     for i, d in enumerate([60, 90, 120, 31, 240, 30])]
    + [_loan(f"L2{i}", "C2", "Home", 200000, "Active", 2020, 2, 60) for i in range(4)]
    + [_loan("L30", "C3", "Vehicle", 300000, "Default", 2020, 4, 0),
       _loan("L31", "C3", "Vehicle", 300000, "NPA", 2021, 1, 0, "N2"),
       _loan("L32", "C3", "Business", 50000, "Closed", 2021, 1, 0)]
    + [_loan("L40", "C4", "Personal", 70000, "Active", 2021, 1, None),
       _loan("L41", "C4", "Personal", None, "Active", 2021, 2, -5),
       _loan("L42", "C4", "Credit Card", 0, "Written-Off", 2021, 2, 0)]
    + [_loan("L50", "C5", "Education", 400000, "Restructured", 2022, 1, 0),
       _loan("L60", "C6", "Education", 400000, "Active", 2022, 1, 0),
       _loan("L70", "C7", "Personal", 90000, "Active", 2022, 1, 180),
       _loan("LX0", "CX", "Home", 120000, "NPA", 2022, 5, 0),  # customer unknown
       _loan("LZ0", "C5", "Zero", 0, "NPA", 2022, 6, 0)]      # exposure 0
)


def _txn(tid, lid, ttype, amount, flag, rev=0, hour=12, month=1, channel="ATM"):
    return (tid, lid, ttype, amount, channel, 2021, month, hour, flag, rev, "N1")


TXNS = (
    [_txn("T1", "L10", "Cash_Withdrawal", 150000.0, 1, month=1),
     _txn("T2", "L10", "Cash_Withdrawal", 200000.5, 1, month=1),
     _txn("T3", "L10", "Cash_Withdrawal", 100000.01, 1, month=2),
     _txn("T4", "L20", "Cash_Withdrawal", 300000.0, 1),
     _txn("T5", "L20", "Cash_Withdrawal", 250000.0, 1),
     _txn("T6", "L20", "Cash_Withdrawal", 100000.0, 1),               # not strictly above
     _txn("T7", "L30", "Cash_Withdrawal", 500000.0, 1, month=3),
     _txn("T8", "L30", "Cash_Withdrawal", 500000.0, 1, month=3),
     _txn("T9", "L30", "Cash_Withdrawal", 120000.0, 1, month=4)]      # C3 is duplicated
    + [_txn(f"TX{i}", "LX9", "Cash_Withdrawal", 400000.0 + i, 1) for i in range(3)]  # loan unknown
    + [_txn(f"TR{i}", "L60", "EMI_Payment", 1000.0 + i, 0, rev=int(i < 2), hour=h, channel="UPI")
       for i, h in enumerate([22, 23, 0, 5, 6, 1, 2, 3, 4, 12])]        # 10 txns, 20 % reversed
    + [_txn(f"TS{i}", "L70", "EMI_Payment", 10.0, 0, rev=int(i < 5)) for i in range(9)]  # 9 txns
    + [_txn(f"TQ{i}", "L50", "NEFT", 2.5, 0, rev=int(i < 3), channel="POS") for i in range(20)]  # 15 %
    + [_txn("TN0", "L50", "NEFT", None, 0, channel="POS")]
    + [_txn(f"TC{i}", "LC0", "NEFT", 0.004, 0, rev=1, hour=2, channel="Sub-cent") for i in range(1000)]
)


def _frames(spark, customers, loans, txns):
    data = {"customer_profiles": customers, "loan_applications": loans, "transactions": txns}
    dfs, arrow = {}, {}
    for t, rows in data.items():
        schema = S.SCHEMAS[t]
        dfs[t] = spark.createDataFrame(rows, schema)
        arrow[t] = pa.Table.from_pylist(
            [dict(zip(schema.names, r)) for r in rows],
            pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in schema]))
    dom = Domain(customers=dfs["customer_profiles"], loans=dfs["loan_applications"],
                 txns=dfs["transactions"])
    return dom, arrow


def _duck(arrow):
    import duckdb

    con = duckdb.connect()
    for t, tbl in arrow.items():
        con.register(t, tbl)
    return con


NAMES = sorted(n for n in BODY if n in domain_queries())


@pytest.fixture(scope="module")
def fixture(spark):
    dom, arrow = _frames(spark, CUSTOMERS, LOANS, TXNS)
    return dom, _duck(arrow)


@pytest.mark.parametrize("name", NAMES)
def test_report_on_edge_rows(spark, fixture, name):
    dom, con = fixture
    sdf = domain_queries()[name](dom)
    stypes = spark_types(sdf)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(BODY[name])
    dcols = [d[0] for d in cur.description]
    drows = [tuple(r) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows), (srows, drows)
    assert rows_hash(sdf.columns, srows) == rows_hash(dcols, drows), (sorted(srows), sorted(drows))
    dtypes = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE SELECT * FROM ({BODY[name]}) q").fetchall()}
    assert stypes == dtypes


def test_edges_are_exercised(spark, fixture):
    dom, _ = fixture
    q = domain_queries()
    aml = q["aml_structuring"](dom).collect()
    assert {r.loan_id for r in aml} == {"L10", "L30"}  # 2 flagged + exactly 100000 is out
    # C3 appears twice with different state/segment -> two groups of 3
    assert sorted((r.state, r.suspicious_txn_count) for r in aml if r.loan_id == "L30") == \
        [("S1", 3), ("S2", 3)]
    assert {r.loan_id for r in q["aml_structuring_txn_only"](dom).collect()} == {"L10", "L30", "LX9"}
    rev = {r.loan_id for r in q["aml_reversals"](dom).collect()}
    assert rev == {"L60", "LC0"}                       # 9 txns and exactly 15 % are out
    npa = {r.loan_type: r.gross_npa_rate_pct for r in q["gross_npa_rate"](dom).collect()}
    assert npa["Zero"] is None                         # exposure 0 -> NULL, no error
    hr = {r.segment for r in q["high_risk_micro_segments"](dom).collect()}
    assert hr == {"Retail"}                            # 5 risky loans in, 4 out


def test_small_amounts_add_up(spark, fixture):
    dom, _ = fixture
    volume = {r.loan_id: r.gross_volume for r in domain_queries()["aml_reversals"](dom).collect()}
    assert volume["LC0"] == 4.0


def test_amounts_without_a_decimal(spark):
    """NaN and infinite amounts give what a sum of doubles gives, and only in their group."""
    rows = [_txn(f"T{i}", "L1", "NEFT", a, 0, channel=c)
            for i, (a, c) in enumerate([(1.5, "a"), (float("nan"), "a"), (2.0, "b"), (float("inf"), "b"), (1e300, "c"),
                                        (1e300, "c"), (0.1, "d"), (0.2, "d"), (1e17, "e"), (1e17, "e"), (0.5, "e")])]
    dom, _ = _frames(spark, [], [], rows)
    got = {r.channel: r.avg_txn_amount for r in domain_queries()["channel_risk"](dom).collect()}
    assert got["a"] != got["a"] and got["b"] == float("inf") and got["c"] == 1e300 and got["d"] == 0.15
    assert got["e"] == pytest.approx((2 * 10**17 + 0.5) / 3, rel=1e-15)


def test_sums_beyond_64_bits_of_cents(spark):
    """3 * 10^6 rows of 10^13: 3e21 cents do not fit a BIGINT."""
    from riskloom.functions import sum_money

    assert spark.range(3_000_000).selectExpr("1e13D as amount").agg(sum_money("amount").alias("s")).first().s == 3e19


def test_many_copies_of_one_borrower(spark):
    """200,000 loans times 200,000 copies of their customer: 4e10 joined loans."""
    from pyspark.sql import functions as F

    from riskloom.plans import pd_curve

    dom, _ = _frames(spark, [_cust("C1", 700)], [_loan("L", "C1", "Home", 1, "Active", 2020, 1, 0)], [])
    many = spark.range(200_000)
    loans = dom.loans.crossJoin(many).drop("id")
    customers = dom.customers.crossJoin(many).drop("id")
    r = pd_curve.expected_status_mix(loans, customers).first()
    assert r.loans == 4 * 10**10
    shares = {"active": 50000, "closed": 25000, "default": 9000, "npa": 3750, "written_off": 1500, "restructured": 4250}
    for s, w in shares.items():
        assert abs(r[f"expected_{s}"] / 4e10 - w / sum(shares.values())) < 1e-8
    plan = pd_curve.expected_status_mix(dom.loans, dom.customers)._jdf.queryExecution().executedPlan().toString()
    # loans once; customers to be reduced and to meet them
    assert plan.count("hashpartitioning(customer_id") <= 3


def test_half_even_keys_differ_at_ties(spark):
    """1 of 800 customers is 0.125 %: half-up 0.13, half-even 0.12."""
    customers = [_cust(f"C{i}", 550 if i == 0 else 820) for i in range(800)]
    loans = [_loan("L0", "C0", "Home", 1, "NPA", 2020, 1, 0), _loan("L1", "C0", "Home", 799, "Active", 2020, 1, 0)]
    dom, arrow = _frames(spark, customers, loans, [])
    con, q = _duck(arrow), domain_queries()
    for name, up, even in [("gross_npa_rate", 0.13, 0.12), ("credit_score_bands", 0.13, 0.12)]:
        col = "gross_npa_rate_pct" if name == "gross_npa_rate" else "pct_of_portfolio"
        for key, want in [(name, up), (f"{name}_pandas", even)]:
            df = q[key](dom)
            assert min(r[col] for r in df.collect()) == want
            cur = con.execute(BODY[key])
            assert rows_hash(df.columns, [tuple(r) for r in df.collect()]) == \
                rows_hash([d[0] for d in cur.description], [tuple(r) for r in cur.fetchall()])


def test_empty_tables(spark):
    dom, arrow = _frames(spark, [], [], [])
    con = _duck(arrow)
    for name in ["kri_master", "kri_master_extended", "gross_npa_rate", "credit_score_bands",
                 "customer_risk_ranking", "aml_structuring"]:
        sdf = domain_queries()[name](dom)
        srows = [tuple(r) for r in sdf.collect()]
        drows = [tuple(r) for r in con.execute(BODY[name]).fetchall()]
        dcols = [d[0] for d in con.execute(BODY[name]).description]
        assert rows_hash(sdf.columns, srows) == rows_hash(dcols, drows), (name, srows, drows)


def test_hot_customer_is_reduced_before_the_shuffle(spark):
    """A third of all loans on one customer: the loan side is partially
    aggregated per customer before any exchange, and the results equal the
    row-level report SQL on the same rows."""
    import random

    rnd = random.Random(5)
    customers = [_cust(f"H{i}", 500 + i % 300, "Retail" if i % 2 else "SME") for i in range(60)]
    loans = [_loan(f"HL{i}", "H0" if i < 300 else f"H{rnd.randint(1, 59)}", "Home",
                   1000 + i, rnd.choice(["Active", "Default", "NPA"]), 2021, 1 + i % 12,
                   rnd.choice([0, 60, 120])) for i in range(900)]
    dom, arrow = _frames(spark, customers, loans, [])
    con = _duck(arrow)
    q = domain_queries()
    for name in ["geographic_concentration", "segment_concentration", "high_risk_micro_segments",
                 "customer_risk_ranking"]:
        sdf = q[name](dom)
        plan = sdf._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        checked = 0
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" not in line:
                continue
            depth = len(line) - len(line.lstrip(" :+-"))
            sub = []
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= depth:
                    break
                sub.append(nxt)
            text = "\n".join(sub)
            scans_loans = any("Scan" in x and "loan_amount" in x for x in sub)
            if scans_loans:  # loan rows reach this shuffle only through a partial aggregate
                assert "partial_" in text, (name, text[:600])
                checked += 1
        assert checked or name == "customer_risk_ranking", name  # HQ-14 reads its materialised table
        cur = con.execute(BODY[name])
        assert rows_hash(sdf.columns, [tuple(r) for r in sdf.collect()]) == \
            rows_hash([d[0] for d in cur.description], [tuple(r) for r in cur.fetchall()]), name


def test_reports_whose_sql_aggregates_first_row_by_row(fixture):
    """HQ-03, HQ-14 and HQ-16: sums over every joined row, without aggregating before the join."""
    from fractions import Fraction
    from math import floor

    def half_up(x, digits=0):
        return float(Fraction(floor(x * 10 ** digits + Fraction(1, 2)), 10 ** digits))

    def rows_of(name, columns):
        return fixture[1].execute(f"SELECT {columns} FROM ({BODY[name]}) q").fetchall()

    stressed = ("Default", "NPA", "Written-Off")
    joined = [(loan, c) for loan in LOANS for c in CUSTOMERS if loan[1] == c[0]]
    known = lambda values: [v for v in values if v is not None]
    total = lambda values: (lambda v: sum(v) if v else None)(known(values))

    want = set()
    for group in {(c[4], c[3]) for _, c in joined}:
        rows = [(loan, c) for loan, c in joined if (c[4], c[3]) == group]
        scores = known(c[6] for _, c in rows)
        bad = sum(loan[6] in stressed for loan, _ in rows)
        want.add((*group, len(rows), total(loan[3] for loan, _ in rows),
                  half_up(Fraction(sum(scores), len(scores))) if scores else None, bad,
                  half_up(Fraction(100 * bad, len(rows)), 2)))
    assert set(rows_of("segment_concentration", "segment, employment_type, loan_count, total_exposure, avg_credit_score, "
                       "stressed_accounts, stress_rate_pct")) == want

    per = {}
    for key in {c[0] for _, c in joined}:
        rows = [(loan, c) for loan, c in joined if c[0] == key]
        scores = known(c[6] for _, c in rows)
        per[key] = (total(loan[3] for loan, _ in rows), sum(scores) / len(scores) if scores else None,
                    sum(loan[6] in stressed for loan, _ in rows))
    order = lambda v: -1 if v is None else v
    want = {(key, amount, points, bad, 1 + sum(order(o[0]) > order(amount) for o in per.values()),
             1 + sum(order(o[1]) < order(points) for o in per.values())) for key, (amount, points, bad) in per.items()}
    assert set(rows_of("customer_risk_ranking_all", "customer_id, total_exposure, credit_score, default_count, "
                       "exposure_rank, risk_rank")) == want

    amount = sum(known(loan[3] for loan in LOANS))
    npa = sum(known(loan[3] for loan in LOANS if loan[6] == "NPA"))
    scores = known(c[6] for c in CUSTOMERS)
    want = {"INR": [amount], "Percentage": [half_up(Fraction(100 * npa, amount), 2)],
            "Score": [half_up(Fraction(sum(scores), len(scores)))],
            "Count": sorted([sum(loan[6] == "Active" for loan in LOANS), sum(known(t[8] for t in TXNS)),
                             sum(loan[6] == "Active" and (loan[10] or 0) > 90 for loan in LOANS)])}
    got = {}
    for unit, value in rows_of("kri_master", "unit, kri_value"):
        got.setdefault(unit, []).append(float(value))
    assert {unit: sorted(v) for unit, v in got.items()} == want
