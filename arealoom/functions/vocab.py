"""Fixed values that results depend on: word lists, patterns and cut-offs."""

# Tokens that stand for a suppressed or absent measure.
SUPPRESSED = [
    "", "-", "n.p", "n.p.", "n/a", "na", "nan", "none", "not available",
    "not published", "np", "null", "suppressed",
]

# How a cell says that a figure is withheld, or that there is none.
NOT_PUBLISHED = ["n.p", "n.p.", "not published", "np"]
NOT_AVAILABLE = ["", "n/a", "na", "nan", "none", "not available", "null"]

# Tokens that stand for an absent code.
NULL_CODES = ["", "nan", "none", "null"]

# Administrative words that carry no identity in an area name.
AREA_STOP_PHRASES = [
    "primary health network", "phn", "local government area", "lga", "city of",
    "shire of", "municipality of", "regional council",
]

# Month-name abbreviations, January first.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# Month words as they are written in period labels.
MONTH_WORDS = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|jun(?:e)?|jul(?:y)?|aug(?:ust)?"
    "|sep(?:t|tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)

# Accepted years and spreadsheet day serials of a reporting period.
YEAR_RANGE = (2000, 2035)
SERIAL_RANGE = (36526, 50000)

# Geography levels, finest first, with the header patterns that name them.
HEADER_LEVELS = [
    ("sa2", r"\bsa2\b|sa2_code|sa2_maincode|sa2_2021|sa2_2016"),
    ("sa3", r"\bsa3\b|sa3_code|sa3_2021|sa3_2016"),
    ("sa4", r"\bsa4\b|sa4_code|sa4_2021|sa4_2016"),
    ("lga", r"\blga\b|local_government|lga_code|lga_name"),
    ("phn", r"\bphn\b|primary_health_network|phn_code|phn_name"),
    ("ndis_service_area", r"service_district|service_area|ndis_region|participant_service"),
    ("state", r"\bstate\b|territory|jurisdiction|ste_code|ste_name|aust"),
]

# Shape of a code at each level.
VALUE_SHAPES = [
    ("sa2", r"^\d{9}$"),
    ("sa3", r"^\d{5}$"),
    ("sa4", r"^\d{3}$"),
    ("lga", r"^\d{5}$"),
    ("state", r"^[1-9]$"),
]

# Words of column names that are labels, words that make them counts all the same, and
# points of a name as the count measure.
LABEL_WORDS = "code|cd2016|cd2021|name|state|territory|sa2|sa3"
COUNT_WORDS = "participant|count|number|total"
MEASURE_POINTS = [
    (20, "participant"),
    (15, "count|number|num"),
    (15, "^(participants|participantcount|count|numberofparticipants|totalparticipants)$"),
    (-20, "rate|percent|percentage|pct|proportion"),
    (-25, "date|period|quarter|month|year|asat"),
]

# Points of a column that meets all demands on a feature, and of leftover categories.
FEATURE_POINTS = 100
LEFTOVER_POINTS = [(-20, "not_stated"), (-20, "unable_to_determine")]

# Words in cell text that hint at a level, with their weight.
VALUE_HINTS = [
    ("phn", r"primary health network|\bphn\b", 5),
    ("lga", r"local government|\blga\b", 5),
    ("state", r"state|territory|australia", 3),
]

# Labels for geographies mentioned in free text.
TEXT_GEOGRAPHIES = [
    ("SA2", r"\bsa2\b|statistical area level 2|sa2_?code"),
    ("SA3", r"\bsa3\b|statistical area level 3|sa3_?code"),
    ("SA4", r"\bsa4\b|statistical area level 4|sa4_?code"),
    ("LGA", r"\blga\b|local government area|lga_?code|council"),
    ("PHN", r"\bphn\b|primary health network|phn_?code"),
    ("PHA", r"\bpha\b|population health area|pha_?code"),
    ("STATE_TERRITORY", r"state|territory|jurisdiction|australia"),
    ("HHS_LHD", r"hospital and health service|local health district|\bhhs\b|\blhd\b"),
    ("POSTCODE", r"postcode|postal area|\bpoa\b"),
]

# Payment concepts by label pattern, first match wins.
PAYMENT_CONCEPTS = [
    ("age_pension", r"\bage pension\b"),
    ("jobseeker", r"\bjobseeker\b|\bnewstart\b"),
    ("youth_allowance", r"\byouth allowance\b"),
    ("disability_support_pension", r"\bdisability support pension\b|\bdsp\b"),
    ("carer_payment", r"\bcarer payment\b"),
    ("carer_allowance", r"\bcarer allowance\b"),
    ("parenting_payment", r"\bparenting payment\b"),
    ("family_tax_benefit", r"\bfamily tax benefit\b|\bftb\b"),
    ("commonwealth_rent_assistance", r"\bcommonwealth rent assistance\b|\brent assistance\b|\bcra\b"),
    ("health_care_card", r"\bhealth care card\b"),
    ("low_income_card", r"\blow income\b"),
    ("pensioner_concession_card", r"\bpension.*concession\b|\bpcc\b"),
    ("commonwealth_seniors_health_card", r"\bcommonwealth seniors health\b|\bcshc\b"),
    ("austudy", r"\baustudy\b"),
    ("abstudy", r"\babstudy\b"),
    ("special_benefit", r"\bspecial benefit\b"),
]

# Eighteen source signals by text pattern.
SIGNALS = [
    ("has_sa2_signal", r"\bsa2\b|statistical area 2"),
    ("has_sa3_signal", r"\bsa3\b|statistical area 3"),
    ("has_sa4_signal", r"\bsa4\b|statistical area 4"),
    ("has_lga_signal", r"\blga\b|local government area"),
    ("has_service_district_signal", r"service district|srvcdstrct|srvc dstrct"),
    ("has_phn_signal", r"\bphn\b|primary health network"),
    ("has_state_signal", r"\bstate\b|statecd"),
    ("has_postcode_signal", r"postcode"),
    ("has_psychosocial_signal", r"psychosocial|psycho social"),
    ("has_disability_signal", r"disability|dsblty|diagnosis"),
    ("has_support_category_signal", r"support category|suppcat"),
    ("has_support_class_signal", r"support class|suppclass"),
    ("has_participant_signal", r"participant"),
    ("has_payment_signal", r"payment"),
    ("has_provider_signal", r"provider|prvdr"),
    ("has_market_signal", r"market|concentration"),
    ("has_plan_budget_signal", r"plan budget|committed support"),
    ("has_utilisation_signal", r"utilisation|utilization|utlstn"),
]

# Words that mark a header row.
HEADER_KEYWORDS = [
    "sa2", "sa3", "sa4", "lga", "phn", "state", "territory", "area", "code", "name", "year",
    "number", "count", "percent", "%", "rate",
]

# Header keys that always hold a reporting period.
PERIOD_KEYS = [
    "rprtdt", "rptdt", "rptdate", "reportdt", "reportdate", "reportingdt", "reportingdate",
    "rprtdat", "asat", "asatdate", "extractdate", "referencedate", "referenceperiod",
    "reportingperiod",
]

# Header words that suggest a period, and words that rule one out.
PERIOD_WORDS = "date|period|quarter|month|year|asat|report|reference|extract"
NOT_PERIOD_WORDS = (
    "code|cd2016|cd2021|sa2cd|sa3cd|sa4cd|name|participants|count|number|total|amount|value"
)

# Words of ARIA-style remoteness classes and their order.
REMOTENESS_ORDER = {
    "Major Cities of Australia": 0,
    "Inner Regional Australia": 1,
    "Outer Regional Australia": 2,
    "Remote Australia": 3,
    "Very Remote Australia": 4,
}

# Column suffixes of split confidence intervals and reliability markers.
SUFFIX_RENAMES = [
    ("__95_confidence_interval_of_proportion", "__proportion_95ci_lower"),
    ("__unnamed_2", "__proportion_95ci_upper"),
    ("__unnamed", "__relative_root_mean_square_error_flag"),
    ("__relative_root_mean_square_error_a", "__relative_root_mean_square_error_pct"),
    ("__relative_root_mean_square_error_b", "__relative_root_mean_square_error_pct"),
]
