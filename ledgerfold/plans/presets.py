"""Column sets of the credit-history marts, for data in that layout."""

from __future__ import annotations

from ledgerfold.operators.preprocess import TableConfig
from ledgerfold.plans.mart import GridSpec, HistorySpec, LeakFreeMart, SnapshotMart

# Column names of the credit-history layout.
TERMS = ("pre_since_opened", "pre_since_confirmed", "pre_pterm", "pre_fterm", "pre_till_pclose", "pre_till_fclose")
AMOUNTS = ("pre_loans_credit_limit", "pre_loans_next_pay_summ", "pre_loans_outstanding", "pre_loans_total_overdue",
           "pre_loans_max_overdue_sum", "pre_loans_credit_cost_rate")
DELAYS = ("pre_loans5", "pre_loans530", "pre_loans3060", "pre_loans6090", "pre_loans90")
USAGE = ("pre_util", "pre_over2limit", "pre_maxover2limit")
KINDS = ("enc_loans_account_holder_type", "enc_loans_credit_status", "enc_loans_account_cur", "enc_loans_credit_type")
CLOSED = ("pclose_flag", "fclose_flag")
ZERO_DELAYS = ("is_zero_loans5", "is_zero_loans530", "is_zero_loans3060", "is_zero_loans6090", "is_zero_loans90")
ZERO_USAGE = ("is_zero_util", "is_zero_over2limit", "is_zero_maxover2limit")

CREDIT_KEYS = HistorySpec(id="id", rn="rn", order="rn")
CREDIT_GRID = GridSpec(pattern="^enc_paym_[0-9]+$", special=(11, 24))

CREDIT_V1 = SnapshotMart(
    last=(*TERMS, "pre_loans_credit_limit", "pre_loans_credit_cost_rate", *KINDS, *CLOSED),
    first=("pre_loans_credit_limit", "enc_loans_credit_type", "enc_loans_credit_status"),
    shares=(*ZERO_DELAYS, *ZERO_USAGE, *CLOSED),
    ever_off={"ever_had_loans3060": "is_zero_loans3060", "ever_had_loans6090": "is_zero_loans6090",
              "ever_had_loans90": "is_zero_loans90"},
    coded=(*TERMS, *AMOUNTS, *DELAYS, *USAGE, *KINDS),
    local=("pre_loans_credit_limit", "pre_loans5", "pre_loans3060", "pre_loans6090", "pre_loans90",
           "pre_over2limit", "pre_maxover2limit", "enc_loans_credit_type"),
    distinct=("pre_loans_credit_limit", "pre_loans_credit_cost_rate", *DELAYS, *USAGE,
              "enc_loans_credit_type", "enc_loans_credit_status", "enc_loans_account_holder_type"),
    sequences=("pre_loans_credit_limit", "pre_loans5", "pre_loans3060", "pre_loans90",
               "enc_loans_credit_type", "enc_loans_credit_status"),
    first_eq_last=("pre_loans_credit_limit", "pre_loans5", "enc_loans_credit_type"),
    grid=CREDIT_GRID,
)

FULL = ("nunique", "first", "last", "change_count", "share_global_mode", "share_rare_bins")
CREDIT_V2 = LeakFreeMart(
    flags=CLOSED,
    overdue={"loans5": "is_zero_loans5", "loans530": "is_zero_loans530",
             "loans3060": "is_zero_loans3060", "loans90": "is_zero_loans90"},
    usage={"util": "is_zero_util", "over2limit": "is_zero_over2limit", "maxover2limit": "is_zero_maxover2limit"},
    usage_counted=("util",),
    serious=("is_zero_loans6090", "is_zero_loans90"),
    any=ZERO_DELAYS,
    mild="is_zero_loans5",
    coded={
        "pre_since_opened": FULL,
        "pre_since_confirmed": ("nunique", "first", "last", "share_global_mode"),
        "pre_loans_credit_limit": FULL,
        "pre_util": FULL,
        "pre_loans_outstanding": ("nunique", "last", "share_global_mode"),
        "pre_loans_credit_cost_rate": ("nunique", "last", "share_global_mode"),
        "pre_loans530": ("nunique", "changed_ever"),
        "pre_loans3060": ("nunique", "last", "changed_ever"),
        "pre_loans90": ("nunique", "share_global_mode"),
        "enc_loans_credit_type": ("nunique", "first", "last", "change_count"),
    },
    grid=CREDIT_GRID,
)

# Cleaning rules of the default configuration.
CREDIT_TABLE = TableConfig(
    target_col="flag", drop_cols=("id", "rn"), exact_excludes=("id", "rn", "pclose_flag", "fclose_flag"),
    prefix_excludes=("is_zero_",),
    suffix_excludes=("_share", "_share_global_mode", "_share_rare_bins", "_ratio", "_density", "_mean", "_count", "_nunique"),
    num_fill="median", cat_fill="Unknown", top_n=20, max_missing=0.90, max_constant=0.999, max_cardinality=100,
    outlier_method="iqr", outlier_threshold=1.5)

CREDIT_TRANSITIONS = {
    "cat_last_util_and_time": ("pre_util_last", "pre_since_opened_last"),
    "cat_last_type_and_limit": ("enc_loans_credit_type_last", "pre_loans_credit_limit_last"),
    "cat_limit_transition": ("pre_loans_credit_limit_first", "pre_loans_credit_limit_last"),
    "cat_type_transition": ("enc_loans_credit_type_first", "enc_loans_credit_type_last"),
    "cat_status_transition": ("first_enc_loans_credit_status", "last_enc_loans_credit_status"),
}
