"""Category names, word lists, lookup tables, thresholds.

Everything here must keep exactly these values for results to be right.
"""

# The ten profile categories, in reporting order.
CATEGORIES = [
    "about",
    "tuition_fees",
    "living_costs",
    "scholarships",
    "acceptance_rate",
    "graduate_employment",
    "average_salaries",
    "visa_policies",
    "intake_deadlines",
    "course_listings",
]

# Categories whose value is a list of items.
LIST_CATEGORIES = [
    "tuition_fees",
    "scholarships",
    "average_salaries",
    "intake_deadlines",
    "course_listings",
]

# Words that make a link relevant to a category.
CATEGORY_KEYWORDS = {
    "about": [
        "about", "history", "profile", "overview", "facts", "ranking",
        "rankings", "introduce", "introduction", "glance", "governance",
    ],
    "tuition_fees": [
        "fee", "fees", "tuition", "cost-of-study", "finance", "financial",
        "payment", "costs", "billing", "estimator", "expenses",
    ],
    "living_costs": [
        "living-cost", "living-costs", "expense", "expenses", "accommodation",
        "rent", "budget", "cost-of-living", "housing", "residence", "hostel",
    ],
    "scholarships": [
        "scholarship", "scholarships", "funding", "award", "awards",
        "bursary", "bursaries", "financial-aid", "grants", "fellowship",
    ],
    "acceptance_rate": [
        "acceptance-rate", "acceptance", "admission-stats", "admission-requirements",
        "profile", "enrollment", "rate", "statistics", "selectivity",
    ],
    "graduate_employment": [
        "employment", "employability", "career", "careers", "graduate-outcome",
        "outcomes", "destination", "destinations", "jobs", "placement",
    ],
    "average_salaries": [
        "salary", "salaries", "earnings", "income", "pay-scale",
        "compensation", "wages", "remuneration",
    ],
    "visa_policies": [
        "visa", "visas", "permit", "international-student", "immigration",
        "entry-requirements", "study-permit", "compliance",
    ],
    "intake_deadlines": [
        "deadline", "deadlines", "intake", "key-dates", "apply",
        "application-dates", "calendar", "timeline", "semester",
    ],
    "course_listings": [
        "course", "courses", "subject", "subjects", "catalog", "catalogue",
        "syllabus", "program", "programs", "handbook", "curriculum", "modules",
    ],
}

# Expected currency by country.
COUNTRY_CURRENCIES = {
    "United States": "USD",
    "United Kingdom": "GBP",
    "Canada": "CAD",
    "Australia": "AUD",
    "Germany": "EUR",
    "France": "EUR",
    "Japan": "JPY",
    "New Zealand": "NZD",
    "Singapore": "SGD",
}

# Words and query parameters that mark a pagination link.
PAGINATION_WORDS = ["next", "older", ">", "»"]
PAGINATION_PARAMETERS = ["page=", "p=", "pg="]
PAGINATION_CLASSES = ["next", "pagination"]

# Markup dropped before reading text.
CLEAN_TEXT_DROPS = ["script", "style", "noscript", "iframe", "nav", "footer"]
VISIBLE_TEXT_DROPS = ["script", "style", "noscript", "iframe"]

# Limits.
SHELL_TEXT_LENGTH = 200
MAX_URLS_PER_CATEGORY = 4
MAX_PAGES_PER_CATEGORY = 5
MAX_CONTEXT_CHARS = 12000
TRUNCATION_MARK = "\n...[TRUNCATED]..."
TEMPERATURE = 0.1
AMOUNT_CEILING = 500000
RENT_CEILING = 10000
EARLIEST_FOUNDING_YEAR = 1000
FEE_TOLERANCE = 0.05

# Confidence scoring.
BASE_CONFIDENCE = 1.0
EMPTY_CONFIDENCE = 0.3
SEVERITY_PENALTY = {"high": 0.5, "medium": 0.25, "low": 0.1}
SEVERITIES = ["high", "medium", "low"]

# Labels.
UNKNOWN_NAME = "Unknown"
UNKNOWN_TYPE = "unknown"
DEFAULT_CURRENCY = "USD"
INSTITUTION_TYPES = ["public", "private", "unknown"]
BLOCKED_BY_ROBOTS = "blocked_by_robots"
MISSING_ISSUE = "no data extracted"
FAILURE_FIELD = "orchestrator"
