"""Controlled vocabularies and report labels.

FIXED VALUES — these strings and thresholds must equal the report
definitions exactly (labels appear verbatim in report output).  They are
listed here plainly, in natural order; the engine takes them from here.
"""

from __future__ import annotations

# --- fixed values: loan statuses -------------------------------------------
LOAN_STATUSES = ("Active", "Closed", "Default", "NPA", "Written-Off", "Restructured")

# Statuses that count as "stressed" in concentration / vintage / ranking reports.
STRESSED_STATUSES = ("Default", "NPA", "Written-Off")
# The narrower set used by the rolling 3-month default trend only.
DEFAULT_STATUSES = ("Default", "NPA")

# --- fixed values: days-past-due buckets (upper bound inclusive, label) -------
# dpd = 0 -> first label; dpd <= bound -> label; anything else (incl. NULL) -> last.
DPD_CURRENT_LABEL = "SMA-0 (Current)"
DPD_CURRENT_LABEL_PANDAS = "SMA-0 Current"
DPD_BUCKETS = (
    (30, "SMA-1 (1-30 DPD)"),
    (60, "SMA-2 (31-60 DPD)"),
    (90, "SMA-3 (61-90 DPD)"),
    (180, "Sub-Standard (91-180 DPD)"),
)
DPD_OVERFLOW_LABEL = "Doubtful (180+ DPD)"

# --- fixed values: credit-score bands (lower bound inclusive, label) ----------
SCORE_BANDS = (
    (800, "Excellent (800+)"),
    (750, "Very Good (750-799)"),
    (700, "Good (700-749)"),
    (650, "Fair (650-699)"),
    (600, "Below Average (600-649)"),
)
SCORE_FLOOR_LABEL = "Poor (<600)"

# --- fixed values: AML off-hours window (11 PM to 5 AM inclusive) -------------
OFF_HOURS_START = 23
OFF_HOURS_END = 5

# --- fixed values: KRI feed names, units and statuses -------------------------
KRI_TOTAL_EXPOSURE = "Total Portfolio Exposure (INR)"
KRI_ACTIVE_LOANS = "Total Active Loans"
KRI_GROSS_NPA = "Gross NPA Rate %"
KRI_DPD90 = "Accounts with DPD > 90"
KRI_DPD90_PANDAS = "Accounts DPD > 90 Days"
KRI_SUSPICIOUS = "Suspicious Transactions Flagged"
KRI_AVG_SCORE = "Avg Portfolio Credit Score"
KRI_WRITTEN_OFF = "Written-Off Accounts"
KRI_RESTRUCTURED = "Restructured Loans"
KRI_UNIQUE_BORROWERS = "Total Unique Borrowers"
KRI_AVG_LOAN = "Avg Loan Amount (INR)"

UNIT_INR = "INR"
UNIT_COUNT = "Count"
UNIT_PCT = "Percentage"
UNIT_SCORE = "Score"

# Status column of the extended KRI feed, one constant per KRI in feed order.
KRI_EXTENDED_STATUS = (
    (KRI_TOTAL_EXPOSURE, "MONITOR"),
    (KRI_ACTIVE_LOANS, "NORMAL"),
    (KRI_GROSS_NPA, "ALERT"),
    (KRI_DPD90_PANDAS, "ALERT"),
    (KRI_SUSPICIOUS, "REVIEW"),
    (KRI_AVG_SCORE, "NORMAL"),
    (KRI_WRITTEN_OFF, "ALERT"),
    (KRI_RESTRUCTURED, "MONITOR"),
    (KRI_UNIQUE_BORROWERS, "NORMAL"),
    (KRI_AVG_LOAN, "NORMAL"),
)
RUPEE = "₹"

# --- fixed values: probability-of-default curve ------------------------------
PD_SCORE_ANCHOR = 850          # pd = (anchor - score) / 1000
PD_FLOOR = 0.02
PD_CAP = 0.45
PD_UNKNOWN_SCORE = 650         # score assumed for a loan whose customer is unknown
# Status weights for a given pd, in LOAN_STATUSES order:
# Active 0.50, Closed 0.25, Default 0.6*pd, NPA 0.25*pd, Written-Off 0.1*pd,
# Restructured max(0.01, 0.05 - 0.05*pd); normalised to sum 1 per loan.

# --- report thresholds (defaults of the report arguments) --------------------
HIGH_RISK_MAX_SCORE = 600
HIGH_RISK_MIN_DPD = 30
HIGH_RISK_MIN_ACCOUNTS = 5
HIGH_RISK_LIMIT = 20
AML_MIN_AMOUNT = 100000
LARGE_AMOUNT = 200000
AML_MIN_TXNS = 3
AML_LIMIT = 50
AML_TXN_ONLY_LIMIT = 20
REVERSAL_MIN_RATE = 15
REVERSAL_MIN_TXNS = 10
REVERSAL_LIMIT = 30
RANKING_LIMIT = 100
DECILES = 10
ROLLING_ROWS = 3

# Event-time reports: what a transaction says about its loan from then on, and the windows.
STATE_EVENTS = ("EMI_Payment", "Interest_Credit", "Loan_Disbursement", "Reversal")
EARLY_WITHDRAWAL_DAYS = 60
BURST_GAP_DAYS = 45
BURST_MIN_TXNS = 2
WINDOW_DAYS, WINDOW_STEP_DAYS, WINDOW_MIN_TXNS = 120, 30, 2
ALARM_DAYS, ALARM_DELAY_DAYS = 90, 2
