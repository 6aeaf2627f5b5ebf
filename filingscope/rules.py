"""Fixed values of the scoring models and of the filing form.

Everything here must equal the published model or form; the code that uses it lives elsewhere.
"""

from __future__ import annotations

from typing import NamedTuple

# Severity order, most severe first.
CATEGORIES = ("Critical", "High", "Medium", "Low")

CATEGORY_DESCRIPTIONS = {
    "Low": "Minimal risk indicators",
    "Medium": "Some risk indicators present",
    "High": "Multiple risk indicators",
    "Critical": "Severe risk indicators requiring immediate attention",
}


class PointRule(NamedTuple):
    name: str
    points: int
    condition: str  # SQL predicate over a filing-change row


# Change model: points per condition. The gap between 24.9 and 25 scores nothing, as published.
CHANGE_POINTS = (
    PointRule("new_disclosure", 40, "new_disc_flag"),
    PointRule("raum_drop_severe", 25, "raum_drop_pct >= 25"),
    PointRule("raum_drop_moderate", 15, "raum_drop_pct BETWEEN 15 AND 24.9"),
    PointRule("client_drop_severe", 15, "client_drop_pct >= 25"),
    PointRule("client_drop_moderate", 8, "client_drop_pct BETWEEN 15 AND 24.9"),
    PointRule("account_drop_severe", 10, "acct_drop_pct >= 25"),
    PointRule("account_drop_moderate", 5, "acct_drop_pct BETWEEN 15 AND 24.9"),
    PointRule("officer_changed", 10, "cco_changed"),
    PointRule("trend_down", 10, "trend_down_flag"),
    PointRule("owner_moves", 10, "owner_moves_12m >= 2"),
    PointRule("young_adviser", 5, "adviser_age_years < 3"),
    PointRule("small_raum", 5, "raum < 50000000"),
)
SMALL_RAUM = 50_000_000
TREND_MEAN_PCT = 7  # mean drop over the last three filings
TREND_PERIODS = 3

# Lowest score of each category, per model; anything below the last is Low.
CHANGE_CUTOFFS = {"Critical": 80, "High": 60, "Medium": 30}
SINGLE_CUTOFFS = {"Critical": 50, "High": 30, "Medium": 15}
WEIGHTED_CUTOFFS = {"Critical": 0.8, "High": 0.6, "Medium": 0.3}

# Single-filing model.
DISCLOSURE_POINTS_EACH = 10
DISCLOSURE_POINTS_CAP = 25
SIZE_POINTS = ((10_000_000_000, 5), (1_000_000_000, 10), (100_000_000, 15))  # raum above -> points
SIZE_POINTS_ELSE = 20
CONCENTRATION_POINTS = ((10_000_000, 15), (1_000_000, 10), (100_000, 5))  # raum per client above -> points

# Quick preview score.
PREVIEW_SIZE_POINTS = ((1_000_000_000, 5), (100_000_000, 3), (10_000_000, 1))

# Weighted statistical model.
COMPONENT_WEIGHTS = {
    "disclosure_risk": 0.35,
    "aum_volatility_risk": 0.20,
    "client_concentration_risk": 0.15,
    "filing_compliance_risk": 0.15,
    "cco_stability_risk": 0.10,
    "size_factor_risk": 0.05,
}
DAYS_PER_YEAR = 365.25
MIN_YEARS = 0.1
VOLATILITY_SCALE = 10
RATIO_QUANTILE = 0.95
EXPECTED_FILINGS_PER_YEAR = 4
OFFICER_CHANGES_CAP = 5
OPTIMAL_RAUM = 5_000_000_000

# Score bands of the firm explorer: (label, lowest, below).
SCORE_BANDS = {
    "80+ (Critical)": (80, None),
    "60-79 (High)": (60, 80),
    "Below 60 (Medium/Low)": (None, 60),
}

# Filing form: header of the raw monthly file -> column of the filing table.
HEADERS = {
    "sec_number": "SEC#",
    "crd_number": "Organization CRD#",
    "firm_name": "Primary Business Name",
    "legal_name": "Legal Name",
    "sec_region": "SEC Region",
    "sec_status": "SEC Current Status",
    "sec_status_date": "SEC Status Effective Date",
    "raum": "5F(2)(c)",
    "account_count": "5F(2)(f)",
    "cco_name": "Chief Compliance Officer Name",
    "cco_phone": "Chief Compliance Officer Telephone",
    "cco_email": "Chief Compliance Officer E-mail",
    "firm_type": "Firm Type",
    "umbrella_registration": "Umbrella Registration",
    "website": "Website Address",
    "main_office_city": "Main Office City",
    "main_office_state": "Main Office State",
    "main_office_country": "Main Office Country",
}
CLIENT_HEADERS = tuple(f"5D({letter})(1)" for letter in "abcdefghijklmn")
DISCLOSURE_HEADER = "11"
DISCLOSURE_COUNT_SECTIONS = ("11A", "11B", "11C", "11D", "11E", "11F", "11G", "11H")
FILING_DATE_HEADER = "Latest ADV Filing Date"
DATA_EXTENSIONS = (".xlsx", ".xls", ".csv")
