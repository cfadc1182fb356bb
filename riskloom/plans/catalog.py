"""The registered report catalogue: one entry per report / operator.

"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators.topk import sort_small
from riskloom.plans import aml, credit, dashboard, lake, merge, merging, pd_curve, portfolio, portfolio_levels, portfolio_sketches, timeline, trends
from riskloom.plans.registry import register, register_raw
from riskloom.session import scratch_path
from riskloom.sources.tables import Domain, load_domain, read_table, timed_transactions


@register("portfolio_by_loan_type")  # HQ-01
def _hq01(d: Domain):
    return portfolio.portfolio_by_loan_type(d.loans)


@register("portfolio_by_loan_type_int")  # P-01
def _p01(d: Domain):
    return portfolio.portfolio_by_loan_type_int(d.loans)


@register("geographic_concentration")  # HQ-02
def _hq02(d: Domain):
    return portfolio.geographic_concentration(d.loans, d.customers)


@register("segment_concentration")  # HQ-03
def _hq03(d: Domain):
    return portfolio.segment_concentration(d.loans, d.customers)



@register("gross_npa_rate")  # HQ-04
def _hq04(d: Domain):
    return credit.gross_npa_rate(d.loans)


@register("dpd_buckets")  # HQ-05
def _hq05(d: Domain):
    return credit.dpd_buckets(d.loans)


@register("dpd_buckets_pandas")  # P-05
def _p05(d: Domain):
    return credit.dpd_buckets_pandas(d.loans)


@register("vintage_default_rate")  # HQ-06
def _hq06(d: Domain):
    return credit.vintage_default_rate(d.loans)


@register("vintage_default_rate_pandas")  # P-06
def _p06(d: Domain):
    return credit.vintage_default_rate_pandas(d.loans)


@register("high_risk_micro_segments")  # HQ-07
def _hq07(d: Domain):
    return credit.high_risk_micro_segments(d.loans, d.customers)


@register("credit_score_bands")  # HQ-08
def _hq08(d: Domain):
    return credit.credit_score_bands(d.customers)



@register("aml_structuring")  # HQ-09
def _hq09(d: Domain):
    return aml.aml_structuring(d.txns, d.loans, d.customers)


@register("aml_structuring_txn_only")  # P-09
def _p09(d: Domain):
    return aml.aml_structuring_txn_only(d.txns)


@register("aml_off_hours")  # HQ-10
def _hq10(d: Domain):
    return aml.aml_off_hours(d.txns)


@register("aml_off_hours_window")  # O-16: wrap-around range predicate
def _o16(d: Domain):
    return aml.aml_off_hours_window(d.txns)


@register("aml_reversals")  # HQ-11
def _hq11(d: Domain):
    return aml.aml_reversals(d.txns)


@register("channel_risk")  # HQ-12
def _hq12(d: Domain):
    return aml.channel_risk(d.txns)


@register("channel_risk_pandas")  # P-12
def _p12(d: Domain):
    return aml.channel_risk_pandas(d.txns)



@register("rolling_3m_defaults")  # HQ-13
def _hq13(d: Domain):
    return trends.rolling_3m_defaults(d.loans)


@register("customer_risk_ranking")  # HQ-14
def _hq14(d: Domain):
    return trends.customer_risk_ranking(d.loans, d.customers)


@register("customer_risk_ranking_all")  # HQ-14 before its LIMIT: every borrower ranked
def _hq14_all(d: Domain):
    return trends.customer_risk_ranking(d.loans, d.customers, limit=None)


@register("vintage_yoy")  # HQ-15
def _hq15(d: Domain):
    return trends.vintage_yoy(d.loans)



@register("kri_master")  # HQ-16
def _hq16(d: Domain):
    return dashboard.kri_master(d.loans, d.txns, d.customers)


@register("kri_master_extended")  # P-16
def _p16(d: Domain):
    return dashboard.kri_master_extended(d.loans, d.txns, d.customers)



@register("pd_by_customer")  # R-01
def _r01(d: Domain):
    return pd_curve.pd_by_customer(d.customers)


@register("expected_status_mix")  # R-02
def _r02(d: Domain):
    return pd_curve.expected_status_mix(d.loans, d.customers)


@register("loan_customer_merge")  # O-19: left join with state_x / state_y
def _o19(d: Domain):
    return merge.loan_customer_merge(d.loans, d.customers)



@register("gross_npa_rate_pandas")  # P-04: half-even
def _p04(d: Domain):
    return credit.gross_npa_rate(d.loans, "half_even")


@register("credit_score_bands_pandas")  # P-08: half-even
def _p08(d: Domain):
    return credit.credit_score_bands(d.customers, "half_even")


@register("large_amount_by_channel")  # F-17: transactions over the large-amount limit
def _f17(d: Domain):
    return aml.large_amount_by_channel(d.txns)


@register_raw("ingested_tables")  # O-01..O-07: landing CSV -> catalog tables, all three
def _ingest(spark, sf_dir: str):
    return lake.ingested_tables(spark, load_domain(spark, sf_dir))


@register_raw("report_csv_roundtrip")  # O-08: the CSV report sink, read back
def _sink(spark, sf_dir: str):
    return lake.report_through_csv(spark, portfolio.portfolio_by_loan_type(load_domain(spark, sf_dir).loans))


@register_raw("loan_lake_roundtrip")  # O-01/O-02/O-03/O-04: CSV landing -> partitioned ORC
def _lake(spark, sf_dir: str):
    return lake.loan_lake_roundtrip(spark, load_domain(spark, sf_dir))



@register_raw("channel_risk_streaming")  # HQ-12 maintained by a streaming query
def _hq12_stream(spark, sf_dir: str):
    from riskloom.streaming import aml_monitor

    stream = aml_monitor.transaction_stream(spark, f"{sf_dir}/lineitem.parquet")
    out = aml_monitor.run_available(aml_monitor.channel_risk_running(stream), "channel_risk_streaming")
    return sort_small(out, [("suspicion_rate_pct", False)], ["channel"])


@register_raw("aml_off_hours_streaming")  # HQ-10 maintained by a streaming query
def _hq10_stream(spark, sf_dir: str):
    from riskloom.streaming import aml_monitor

    stream = aml_monitor.transaction_stream(spark, f"{sf_dir}/lineitem.parquet")
    out = aml_monitor.run_available(aml_monitor.off_hours_running(stream), "aml_off_hours_streaming")
    return sort_small(out, [("suspicion_rate_pct", False)], ["transaction_hour"])


def _timed(spark, sf_dir: str):
    return timed_transactions(read_table(spark, sf_dir, "lineitem"))


@register_raw("withdrawal_loan_state")  # as-of join
def _asof(spark, sf_dir: str):
    return timeline.withdrawal_loan_state(_timed(spark, sf_dir))


@register_raw("early_flagged_withdrawals")  # interval join
def _interval(spark, sf_dir: str):
    return timeline.early_flagged_withdrawals(load_domain(spark, sf_dir).loans, _timed(spark, sf_dir))


@register_raw("withdrawal_bursts")  # sessions
def _bursts(spark, sf_dir: str):
    return timeline.withdrawal_bursts(_timed(spark, sf_dir))


@register_raw("structuring_windows")  # HQ-09's rule in sliding event-time windows
def _sliding(spark, sf_dir: str):
    return timeline.structuring_windows(_timed(spark, sf_dir))


@register("concentration_cube")  # HQ-02 and HQ-03 at every level
def _cube(d: Domain):
    return portfolio_levels.concentration_cube(d.loans)


@register("exposure_percentiles")  # exact percentiles per state
def _percentiles(d: Domain):
    return portfolio_levels.exposure_percentiles(d.loans)


@register("portfolio_changes")  # difference of two loads
def _changes(d: Domain):
    return portfolio_levels.portfolio_changes(portfolio_levels.earlier_load(d.loans), d.loans)


@register_raw("merged_loans")  # changes merged into the partitioned lake
def _merged(spark, sf_dir: str):
    return merging.merged_loans(spark, load_domain(spark, sf_dir).loans)


def _alarm_report(alarms):
    return alarms.select("loan_id", *[F.date_format(c, "yyyy-MM-dd HH:mm").alias(c) for c in ("since", "due")], "withdrawals", "total_amount")


@register_raw("unpaid_withdrawals")  # alarm for loans that draw cash and do not pay
def _unpaid(spark, sf_dir: str):
    from riskloom.streaming import loan_alarm

    return _alarm_report(loan_alarm.unpaid_withdrawals(_timed(spark, sf_dir)))


@register_raw("unpaid_withdrawals_streaming")  # the same by state and timers per loan
def _unpaid_stream(spark, sf_dir: str):
    from riskloom.streaming import aml_monitor, loan_alarm

    stream = aml_monitor.transaction_stream(spark, f"{sf_dir}/lineitem.parquet", timed=True)
    return _alarm_report(aml_monitor.run_to_table(loan_alarm.unpaid_withdrawals_running(stream), "unpaid-withdrawals"))


@register_raw("sketch_audit")  # kept sketches, merged per year, against exact figures
def _sketches(spark, sf_dir: str):
    loans = load_domain(spark, sf_dir).loans
    return portfolio_sketches.sketch_audit(loans, portfolio_sketches.keep(loans, scratch_path(spark, "portfolio-sketches")))
