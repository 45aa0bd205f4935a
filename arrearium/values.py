"""These must equal the source systems' and consumers' own spellings."""

# Text that means "no value" in cleaned columns (compared in lower case, trimmed).
NULL_TOKENS = ("", "nan", "none", "null")
# The lease ledger keeps the word "null" as text.
LEDGER_NULL_TOKENS = ("", "nan", "none")

# Cell texts that a CSV export uses for a missing value (exact match, not trimmed).
CSV_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Normalised contract status -> upper-case raw spellings.
STATUS_SPELLINGS = {
    "ENABLED": ("ACTIVE", "ENABLED", "AWAITING REMOVAL"),
    "REPOSSESSED": ("DISABLED", "REPOSSESSED"),
    "LOCKED": ("LOCKED",),
    "PAID_OFF": ("PAID_OFF", "PAIDOFF"),
    "CANCELLED": ("CANCELLED",),
}
TRUE_SPELLINGS = ("yes", "true", "1")
DEAL_SPELLINGS = {"PAYG": ("NO", "PAYG"), "FULL": ("YES", "FULL")}

# System A payment codes.
UPFRONT_CODES = ("DOWNPAYMENT_SUCCESS", "INCOMPLETE_DOWNPAYMENT")
RECHARGE_CODES = ("PAYMENT_SUCCESS", "INCOMPLETE_PAYMENT", "FINAL_PAYMENT")
IGNORED_CODES = ("REVERSED", "SURVEY_SUCCESS")

# Aging buckets: upper bound in days of each late bucket.
LATE_BOUNDS = (30, 60, 90, 120)
DAILY_BUCKETS = {
    "repossessed": "repossessed",
    "paid_off": "paidoff",
    "write_off": "writeoff",
    "on_time": "0. pas_retard",
    "late": ("1. PAR_1_30j", "2. PAR_31_60j", "3. PAR_61_90j", "4. PAR_91_120j"),
    "other": "autre",
}
REPORT_BUCKETS = {
    "repossessed": "repossessed",
    "paid_off": "paidoff",
    "write_off": "hors_portefeuille",
    "on_time": "a. pas_de_retard",
    "late": ("b. 1_30j", "c. 31_60j", "d. 61_90j", "e. 91_120j"),
    "other": "autre",
}

# Timestamp formats: the shape of the text, and the pattern to read it with (None: the
# standard ISO reading).  The first shape that fits and reads wins.
_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}"
_ZONE = r"(Z|[+-]\d{2}:?\d{2})?"
ISO_Z = (rf"^{_DAY}T{_CLOCK}(\.\d{{1,6}})?Z$", None)
ISO_DATE = (rf"^{_DAY}$", None)
NAMED_MONTH_TIME = (rf"^\d{{1,2}}-[A-Za-z]{{3}}-\d{{4}} {_CLOCK}$", "d-MMM-yyyy H:m:s")
NAMED_MONTH = (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy")
A_FORMATS = (ISO_Z,)
FORM_FORMATS = (ISO_Z, ISO_DATE)
TASK_FORMATS = (ISO_Z, ISO_DATE, NAMED_MONTH_TIME, NAMED_MONTH)
EVENT_FORMATS = (ISO_Z, (rf"^{_DAY} {_CLOCK}{_ZONE}$", None), ISO_DATE)
LENIENT_FORMATS = (
    (rf"^{_DAY}([ T]{_CLOCK}(\.\d{{1,9}})?{_ZONE})?$", None),
    (rf"^{_DAY} \d{{1,2}}:\d{{1,2}}$", "yyyy-M-d H:m"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (rf"^\d{{4}}/\d{{1,2}}/\d{{1,2}} {_CLOCK}$", "yyyy/M/d H:m:s"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}} {_CLOCK}$", "M/d/yyyy H:m:s"),
    NAMED_MONTH_TIME,
    NAMED_MONTH,
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
)
