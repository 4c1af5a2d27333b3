"""Fixed values.

Everything here has to be exactly this text (or number) for results to be right: sheet labels
are looked up by name, rating notations and currencies are closed lists, scores divide by a
fixed field count.
"""

SHEET_NAME = "MASTER"
WORKBOOK_GLOB = "*.xlsm"

# Column 1 of a sheet row is its label, columns 2 and up are its values.
LABEL_COLUMN = 1

SENTINELS = ["Locked", "No data"]
SENTINEL_MEANINGS = {
    "Locked": "data locked by system",
    "No data": "metric not applicable for this period",
}

# Column of the parsed record -> sheet label holding its (first) value.
SCALAR_LABELS = {
    "rated_entity": "Rated entity",
    "corporate_sector": "CorporateSector",
    "industry_risk": "Industry risk",
    "industry_risk_score": "Industry risk score",
    "segmentation_criteria": "Segmentation criteria",
    "currency": "Reporting Currency/Units",
    "country": "Country of origin",
    "accounting_principles": "Accounting principles",
    "business_year_end": "End of business year",
    "business_risk_profile": "Business risk profile",
    "financial_risk_profile": "Financial risk profile",
}
METHODOLOGIES_LABEL = "Rating methodologies applied"
WEIGHT_LABEL = "Industry weight"

SUB_SCORE_LABELS = [
    "(Blended) Industry risk profile",
    "Competitive Positioning",
    "Market share",
    "Diversification",
    "Operating profitability",
    "Sector/company-specific factors (1)",
    "Sector/company-specific factors (2)",
    "Leverage",
    "Interest cover",
    "Cash flow cover",
    "Liquidity",
]
LIQUIDITY_LABEL = "Liquidity"

YEARS_LABEL = "[Scope Credit Metrics]"
METRIC_LABELS = [
    "Scope-adjusted EBITDA interest cover",
    "Scope-adjusted debt/EBITDA",
    "Scope-adjusted FFO/debt",
    "Scope-adjusted loan/value",
    "Scope-adjusted FOCF/debt",
    "Liquidity",
]
METRIC_DECIMALS = 6

REQUIRED_FIELDS = [
    "rated_entity",
    "corporate_sector",
    "currency",
    "country",
    "accounting_principles",
    "business_year_end",
    "business_risk_profile",
    "financial_risk_profile",
    "industry_risk_score",
]
RECOMMENDED_FIELDS = {
    "industry_risk": "Industry risk",
    "industry_weight": "Industry weight",
    "segmentation_criteria": "Segmentation criteria",
}

CURRENCIES = ["CHF", "EUR", "GBP", "USD"]
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
RATING_NOTATIONS = [
    "AAA", "AA+", "AA", "AA-", "A+", "A", "A-",
    "BBB+", "BBB", "BBB-", "BB+", "BB", "BB-", "B+", "B", "B-",
    "CCC+", "CCC", "CCC-", "CC", "C", "D",
]

WEIGHT_MIN = 0.0
WEIGHT_MAX = 1.0
WEIGHT_TOLERANCE = 0.01
ENTITY_NAME_MAX = 200
SCORED_FIELDS = 12
ERROR_MESSAGE_MAX = 500

# country name, ISO 3166 alpha-2, alpha-3, region
COUNTRIES = [
    ("Federal Republic of Germany", "DE", "DEU", "Western Europe"),
    ("Switzerland", "CH", "CHE", "Western Europe"),
    ("France", "FR", "FRA", "Western Europe"),
    ("United Kingdom", "GB", "GBR", "Northern Europe"),
    ("United States", "US", "USA", "North America"),
]
# currency code, name, symbol
CURRENCY_NAMES = [
    ("EUR", "Euro", "€"),
    ("CHF", "Swiss Franc", "CHF"),
    ("USD", "US Dollar", "$"),
    ("GBP", "British Pound", "£"),
]

UPLOAD_STATUSES = ["pending", "processing", "completed", "failed"]

PAGE_LIMIT_DEFAULT = 50
PAGE_LIMIT_MAX = 500

#: Fixed texts of the findings; names in braces stand for values.
MESSAGES = {
    "required": "Required field '{label}' is missing or empty",
    "methodologies": "At least one rating methodology must be specified",
    "recommended": "Recommended field '{label}' is missing",
    "currency": f"Invalid currency '{{currency}}'. Must be one of {CURRENCIES}",
    "month": "Invalid month '{business_year_end}'. Must be a full month name e.g. 'December'",
    "weight_type": "Industry weight must be numeric, got '{industry_weight_text}'",
    "profile_notch": "'{profile}' is a notch adjustment — not a standard rating notation",
    "profile": "'{profile}' is not a valid rating notation",
    "weight_missing": "Industry weight is missing — cannot validate range",
    "weight_range": "Industry weight {_weight} is outside valid range [0, 1]",
    "weight_sum": f"Industry weight {{_weight}} deviates from 1.0 by {{_deviation}} (tolerance: {WEIGHT_TOLERANCE})",
    "without_financial": "Business risk profile present but financial risk profile is missing",
    "without_business": "Financial risk profile present but business risk profile is missing",
    "entity_name": f"Entity name length {{_name_length}} exceeds {ENTITY_NAME_MAX} characters",
    "metrics_missing": "No credit metrics found in MASTER sheet",
    "metrics_years": "Credit metrics found but year headers are missing — time-series data cannot be interpreted",
    "sub_score": "Sub-score '{s.score}' is not standard notation",
    "metric_value": "Non-numeric value '{p.text}' for year {p.year} in '{s.metric}'",
}
