"""Key-risk-indicator feed for dashboards.

The feed is a UNION ALL of single-value aggregates.  Instead of one scan per
KRI, each table is scanned once with all of its KRIs as conditional
aggregates (one global aggregate: partial per task, one row to merge), and the
one-row result is turned into KRI rows with ``inline`` (a generator, no
join).  The three per-table frames are unioned and put in feed order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions import pct, round_ratio
from riskloom.functions.formatting import percent2, rupees_billions, rupees_grouped
from riskloom.operators.topk import sort_small


_ORD = "_kri_order"


def _rows(agg: DataFrame, items: list[tuple[int, str, Column, str]],
          names=("kri_name", "kri_value", "unit")) -> DataFrame:
    """KRI rows (position, name, value as string, unit) out of a one-row aggregate."""
    arr = F.array(*[F.struct(F.lit(i).alias(_ORD), F.lit(n).alias(names[0]),
                             v.cast("string").alias(names[1]), F.lit(u).alias(names[2]))
                    for i, n, v, u in items])
    return agg.select(F.inline(arr))


def _feed(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return sort_small(out, [(_ORD, True)]).drop(_ORD)


def kri_master(loans: DataFrame, txns: DataFrame, customers: DataFrame) -> DataFrame:
    """Six KRIs as (kri_name, kri_value string, unit)."""
    active = F.col("loan_status") == "Active"
    la = loans.agg(
        F.sum("loan_amount").alias("exposure"),
        F.count_if(active).alias("active"),
        F.sum(F.when(F.col("loan_status") == "NPA", F.col("loan_amount")).otherwise(F.lit(0))).alias("npa"),
        F.count_if((F.col("dpd_days") > 90) & active).alias("dpd90"),
    )
    ta = txns.agg(F.sum("is_suspicious_flag").alias("suspicious"))
    ca = customers.agg(F.sum("credit_score").alias("s"), F.count("credit_score").alias("n"))
    return _feed(
        _rows(la, [
            (0, K.KRI_TOTAL_EXPOSURE, F.col("exposure"), K.UNIT_INR),
            (1, K.KRI_ACTIVE_LOANS, F.col("active"), K.UNIT_COUNT),
            (2, K.KRI_GROSS_NPA, pct("npa", "exposure", 2), K.UNIT_PCT),
            (3, K.KRI_DPD90, F.col("dpd90"), K.UNIT_COUNT),
        ]),
        _rows(ta, [(4, K.KRI_SUSPICIOUS, F.col("suspicious"), K.UNIT_COUNT)]),
        _rows(ca, [(5, K.KRI_AVG_SCORE, round_ratio("s", "n", 0), K.UNIT_SCORE)]),
    )


def kri_master_extended(loans: DataFrame, txns: DataFrame, customers: DataFrame) -> DataFrame:
    """Ten KRIs with formatted values and a fixed status per KRI (KRI, Value, Status).

    Formatting: exposure in billions with two decimals, rates with two
    decimals and '%', averages rounded half-even on the exact ratio, the
    average loan with thousands separators.
    """
    st = dict(K.KRI_EXTENDED_STATUS)
    active = F.col("loan_status") == "Active"
    la = loans.agg(
        F.sum("loan_amount").alias("exposure"),
        F.count("loan_amount").alias("n_amount"),
        F.count_if(active).alias("active"),
        F.sum(F.when(F.col("loan_status") == "NPA", F.col("loan_amount")).otherwise(F.lit(0))).alias("npa"),
        F.count_if((F.col("dpd_days") > 90) & active).alias("dpd90"),
        F.count_if(F.col("loan_status") == "Written-Off").alias("written_off"),
        F.count_if(F.col("loan_status") == "Restructured").alias("restructured"),
        F.countDistinct("customer_id").alias("borrowers"),
    )
    ta = txns.agg(F.coalesce(F.sum("is_suspicious_flag"), F.lit(0)).alias("suspicious"))
    ca = customers.agg(F.sum("credit_score").alias("s"), F.count("credit_score").alias("n"))
    billions = round_ratio("exposure", 10 ** 9, 2, "half_even")
    npa_rate = round_ratio("npa", "exposure", 2, "half_even", mult=100)
    avg_loan = round_ratio("exposure", "n_amount", 0, "half_even").cast("bigint")
    names = ("KRI", "Value", "Status")
    return _feed(
        _rows(la, [
            (0, K.KRI_TOTAL_EXPOSURE, rupees_billions(billions),
             st[K.KRI_TOTAL_EXPOSURE]),
            (1, K.KRI_ACTIVE_LOANS, F.col("active"), st[K.KRI_ACTIVE_LOANS]),
            (2, K.KRI_GROSS_NPA, percent2(npa_rate), st[K.KRI_GROSS_NPA]),
            (3, K.KRI_DPD90_PANDAS, F.col("dpd90"), st[K.KRI_DPD90_PANDAS]),
            (6, K.KRI_WRITTEN_OFF, F.col("written_off"), st[K.KRI_WRITTEN_OFF]),
            (7, K.KRI_RESTRUCTURED, F.col("restructured"), st[K.KRI_RESTRUCTURED]),
            (8, K.KRI_UNIQUE_BORROWERS, F.col("borrowers"), st[K.KRI_UNIQUE_BORROWERS]),
            (9, K.KRI_AVG_LOAN, rupees_grouped(avg_loan), st[K.KRI_AVG_LOAN]),
        ], names),
        _rows(ta, [(4, K.KRI_SUSPICIOUS, F.col("suspicious"), st[K.KRI_SUSPICIOUS])], names),
        _rows(ca, [(5, K.KRI_AVG_SCORE, round_ratio("s", "n", 0, "half_even").cast("bigint"),
                    st[K.KRI_AVG_SCORE])], names),
    )
