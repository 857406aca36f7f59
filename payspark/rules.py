"""Rule tables used by the column functions and operators.

Every value below is a fixed value: results depend on the exact words, order and numbers, so they are
stated plainly and never derived.  They are small driver-side constants that end up as literals in plans.
"""

from __future__ import annotations

# --- fixed values: source registry -------------------------------------------------------------------
# target column -> candidate source columns; the first candidate present in the schema wins, [] = null.
SOURCES = {
    "h1b": {
        "enabled": True,
        "priority": 1,
        "filename": "h1b_ai_salaries.parquet",
        "columns": {
            "job_title": ["job_title", "soc_title"],
            "employer_name": ["employer_name"],
            "location_city": ["worksite_city", "employer_city"],
            "location_state": ["worksite_state", "employer_state"],
            "annual_salary": ["annual_salary", "wage_from"],
            "year": ["fiscal_year", "year"],
            "soc_code": ["soc_code"],
        },
    },
    "adzuna": {
        "enabled": True,
        "priority": 2,
        "filename": "adzuna_jobs.parquet",
        "columns": {
            "job_title": ["title"],
            "employer_name": ["company"],
            "location_city": ["location"],
            "location_state": ["state"],
            "annual_salary": ["salary_avg"],
            "year": ["year"],
            "soc_code": [],
        },
    },
    "linkedin": {
        "enabled": True,
        "priority": 1,
        "filename": "linkedin_ai_jobs.parquet",
        "columns": {
            "job_title": ["job_title"],
            "employer_name": ["employer_name"],
            "location_city": [],
            "location_state": ["worksite_state"],
            "annual_salary": ["annual_salary"],
            "year": ["year"],
            "soc_code": [],
            "job_url": ["job_url"],
            "seniority_level": ["seniority_level"],
            "employment_type": ["employment_type"],
            "job_function": ["job_function"],
            "industries": ["industries"],
            "education": ["education"],
            "estimated_yoe": ["estimated_yoe"],
            "skills": ["skills"],
        },
    },
}
UNKNOWN_PRIORITY = 999

CANONICAL_TYPES = {
    "job_title": "string",
    "employer_name": "string",
    "location_city": "string",
    "location_state": "string",
    "annual_salary": "double",
    "year": "int",
    "soc_code": "string",
    "job_url": "string",
    "seniority_level": "string",
    "employment_type": "string",
    "job_function": "string",
    "industries": "string",
    "education": "string",
    "estimated_yoe": "int",
    "skills": "array<string>",
}

PROFILES = {
    "all": {"h1b": True, "adzuna": True, "linkedin": True},
    "h1b_only": {"h1b": True, "adzuna": False, "linkedin": False},
    "linkedin_only": {"h1b": False, "adzuna": False, "linkedin": True},
    "adzuna_only": {"h1b": False, "adzuna": True, "linkedin": False},
}

# --- fixed values: validation, dedup, quality ----------------------------------------------------------
SALARY_MIN = 35000.0
SALARY_MAX = 600000.0
IQR_MULTIPLIER = 3.0
IQR_MIN_ROWS = 10
DEFAULT_YEAR = 2024
REQUIRED_FIELDS = ("job_title", "annual_salary")
MIN_RECORDS_PER_SOURCE = 100
MATCH_FIELDS = ("job_title", "employer_name", "location_state", "year", "annual_salary", "job_url")
QUALITY_WEIGHTS = {
    "skills": 0.3,
    "estimated_yoe": 0.2,
    "education": 0.1,
    "seniority_level": 0.1,
    "employer_name": 0.1,
    "location_state": 0.1,
    "source_priority": 0.1,
}
STATE_NAMES = {
    "CALIFORNIA": "CA",
    "NEW YORK": "NY",
    "WASHINGTON": "WA",
    "TEXAS": "TX",
    "MASSACHUSETTS": "MA",
}

# --- fixed values: feed headers ------------------------------------------------------------------------
DISCLOSURE_HEADERS = {
    "CASE_NUMBER": "case_number",
    "CASE_STATUS": "case_status",
    "RECEIVED_DATE": "received_date",
    "DECISION_DATE": "decision_date",
    "EMPLOYER_NAME": "employer_name",
    "EMPLOYER_CITY": "employer_city",
    "EMPLOYER_STATE": "employer_state",
    "JOB_TITLE": "job_title",
    "SOC_CODE": "soc_code",
    "SOC_TITLE": "soc_title",
    "WAGE_RATE_OF_PAY_FROM": "wage_from",
    "WAGE_RATE_OF_PAY_TO": "wage_to",
    "WAGE_UNIT_OF_PAY": "wage_unit",
    "WORKSITE_CITY": "worksite_city",
    "WORKSITE_STATE": "worksite_state",
    "PREVAILING_WAGE": "prevailing_wage",
    "LCA_CASE_NUMBER": "case_number",
    "LCA_CASE_EMPLOYER_NAME": "employer_name",
    "LCA_CASE_JOB_TITLE": "job_title",
    "LCA_CASE_WAGE_RATE_FROM": "wage_from",
    "LCA_CASE_WAGE_RATE_TO": "wage_to",
}
SCRAPED_TABLE_HEADERS = {
    "EMPLOYER": "employer_name",
    "JOB TITLE": "job_title",
    "BASE SALARY": "wage_from",
    "LOCATION": "worksite_location",
    "SUBMIT DATE": "received_date",
    "START DATE": "start_date",
    "CASE STATUS": "case_status",
}
WAGE_SERIES = {
    "OEUN0000000000000015122104": ("15-1221", "Computer and Information Research Scientists"),
    "OEUN0000000000000015205104": ("15-2051", "Data Scientists"),
    "OEUN0000000000000015125204": ("15-1252", "Software Developers"),
    "OEUN0000000000000015204104": ("15-2041", "Statisticians"),
    "OEUN0000000000000015203104": ("15-2031", "Operations Research Analysts"),
    "OEUN0000000000000015121104": ("15-1211", "Computer Systems Analysts"),
    "OEUN0000000000000015124304": ("15-1243", "Database Architects"),
}

# --- fixed values: title filters -----------------------------------------------------------------------
AI_TITLE_PATTERNS = (
    "machine learning", "artificial intelligence", "data scientist", "ml engineer", "ai engineer",
    "deep learning", "nlp", "natural language", "computer vision", "research scientist",
    "applied scientist", "data engineer", "mlops", "analytics", "quantitative",
)
INCLUDE_KEYWORDS = (
    "machine learning", "ml engineer", "data scientist", "ai engineer", "deep learning", "nlp",
    "natural language processing", "computer vision", "mlops", "research scientist", "applied scientist",
    "ai research", "neural network", "tensorflow", "pytorch", "data science", "artificial intelligence",
    "quantitative", "analytics engineer", "modeling", "algorithm", "big data", "hadoop", "spark",
)
EXCLUDE_KEYWORDS = (
    "data entry", "virtual assistant", "clerk", "typist", "typing", "checkout", "fashion",
    "administrative", "capacitador", "receptionist", "medical office", "office assistant",
    "customer service", "cashier", "retail", "sales associate", "warehouse", "driver", "delivery",
    "cleaner", "janitor", "security guard", "restaurant", "cook", "dishwasher", "barista", "waiter",
    "waitress", "hostess",
)

# --- fixed values: location and seniority words --------------------------------------------------------
AREA_STATES = (
    ("california", "CA"), ("ca", "CA"),
    ("new york", "NY"), ("ny", "NY"),
    ("washington", "WA"), ("wa", "WA"),
    ("texas", "TX"), ("tx", "TX"),
    ("massachusetts", "MA"), ("ma", "MA"),
    ("illinois", "IL"), ("il", "IL"),
    ("georgia", "GA"), ("ga", "GA"),
    ("colorado", "CO"), ("co", "CO"),
    ("virginia", "VA"), ("va", "VA"),
    ("florida", "FL"), ("fl", "FL"),
    ("north carolina", "NC"), ("nc", "NC"),
)
SENIORITY_LABELS = (
    ("Senior", ("senior", "sr.", "sr ", "lead", "principal", "staff")),
    ("Junior", ("junior", "jr.", "jr ", "entry", "associate")),
    ("Executive", ("director", "head of", "vp ", "chief")),
    ("Manager", ("manager", "mgr")),
)

# --- fixed values: feature words and encodings ---------------------------------------------------------
SKILL_CATEGORIES = {
    "deep_learning": ("pytorch", "tensorflow", "keras", "deep learning", "neural network"),
    "nlp": ("nlp", "natural language", "bert", "gpt", "transformer", "llm", "langchain", "huggingface"),
    "computer_vision": ("computer vision", "opencv", "image recognition", "object detection", "yolo"),
    "mlops": ("mlops", "kubeflow", "mlflow", "airflow", "docker", "kubernetes"),
    "cloud_ml": ("sagemaker", "vertex ai", "azure ml", "databricks", "aws", "gcp", "azure"),
    "big_data": ("spark", "hadoop", "kafka", "flink", "distributed"),
    "traditional_ml": ("scikit-learn", "xgboost", "random forest", "regression", "classification"),
    "data_engineering": ("sql", "etl", "data pipeline", "data warehouse", "snowflake"),
}
COMPANY_TIERS = {
    "faang": ("google", "meta", "amazon", "apple", "netflix", "microsoft", "alphabet"),
    "tier1": ("openai", "anthropic", "deepmind", "nvidia", "tesla", "salesforce", "uber", "airbnb", "stripe"),
    "tier2": ("linkedin", "twitter", "snap", "lyft", "pinterest", "doordash", "instacart", "coinbase"),
    "finance": ("citadel", "two sigma", "jane street", "de shaw", "goldman", "morgan stanley", "jpmorgan"),
}
TITLE_FLAGS = {
    "is_senior": ("senior", "sr.", "sr "),
    "is_lead": ("lead",),
    "is_principal": ("principal",),
    "is_staff": ("staff",),
    "is_manager": ("manager", "mgr"),
    "is_director": ("director", "head of", "vp"),
    "is_entry": ("junior", "jr.", "entry", "associate", "intern"),
}
# flags -> years, first group with a set flag wins
TITLE_YEARS = (
    (("is_director",), 12),
    (("is_principal", "is_staff"), 10),
    (("is_lead", "is_manager"), 7),
    (("is_senior",), 5),
    (("is_entry",), 1),
)
DEFAULT_TITLE_YEARS = 3
ROLE_FLAGS = {
    "role_engineer": ("engineer",),
    "role_scientist": ("scientist",),
    "role_analyst": ("analyst",),
    "role_architect": ("architect",),
    "role_researcher": ("research",),
}
LOCATION_MULTIPLIERS = {
    "CA": 1.35, "NY": 1.30, "WA": 1.20, "MA": 1.25, "CO": 1.10, "TX": 1.00, "IL": 1.05, "GA": 0.95,
    "NC": 0.90, "FL": 1.00, "PA": 1.00, "VA": 1.10, "AZ": 0.95, "OR": 1.10, "MD": 1.15,
}
MAJOR_HUBS = ("CA", "WA", "NY")
SECONDARY_HUBS = ("MA", "CO", "TX", "IL", "GA")
REMOTE_FRIENDLY = ("CO", "TX", "FL", "AZ")
STATE_CODES = (
    "CA", "NY", "WA", "TX", "MA", "CO", "IL", "GA", "NC", "FL",
    "PA", "VA", "AZ", "OR", "MD", "NJ", "OH", "MI", "MN", "UT",
)
TIER_CODES = ("faang", "tier1", "tier2", "finance", "startup", "other", "unknown")
DATE_COLUMNS = ("received_date", "decision_date", "created_date", "date")
TARGET_COLUMNS = ("annual_salary", "salary_avg", "mean_annual_wage", "wage_from")
TARGET_MIN = 50000.0
TARGET_MAX = 1000000.0

# --- fixed values: description words -------------------------------------------------------------------
DESCRIPTION_SKILLS = (
    "machine learning", "deep learning", "neural networks", "nlp", "computer vision",
    "tensorflow", "pytorch", "keras", "scikit-learn", "pandas", "numpy",
    "python", "java", "javascript", "c++", "scala", "r", "go", "rust",
    "aws", "azure", "gcp", "google cloud", "docker", "kubernetes", "kafka",
    "sql", "postgresql", "mysql", "mongodb", "redis", "elasticsearch",
    "spark", "hadoop", "airflow", "mlflow", "git", "ci/cd", "rest api", "graphql",
)
EDUCATION_LEVELS = (
    ("PhD", ("ph.d", "phd", "doctorate")),
    ("Masters", ("master", "m.s.", "graduate degree")),
    ("Bachelors", ("bachelor", "b.s.", "b.a.", "undergraduate")),
)
DESCRIPTION_CUT = 500
NOT_SPECIFIED = "Not specified"

# --- fixed values: resume patterns ---------------------------------------------------------------------
TITLE_PATTERNS = (
    (r"\b(principal|staff|lead)\s+(ml|machine learning|ai|data)\s+(engineer|scientist)\b", "Principal ML Engineer"),
    (r"\b(senior|sr\.?)\s+(ml|machine learning)\s+engineer\b", "Senior ML Engineer"),
    (r"\b(senior|sr\.?)\s+data\s+scientist\b", "Senior Data Scientist"),
    (r"\b(senior|sr\.?)\s+ai\s+engineer\b", "Senior AI Engineer"),
    (r"\b(senior|sr\.?)\s+research\s+scientist\b", "Senior Research Scientist"),
    (r"\b(senior|sr\.?)\s+data\s+engineer\b", "Senior Data Engineer"),
    (r"\bmlops\s+engineer\b", "MLOps Engineer"),
    (r"\b(ml|machine learning)\s+engineer\b", "ML Engineer"),
    (r"\bdata\s+scientist\b", "Data Scientist"),
    (r"\bai\s+engineer\b", "AI Engineer"),
    (r"\bresearch\s+scientist\b", "Research Scientist"),
    (r"\bapplied\s+scientist\b", "Applied Scientist"),
    (r"\bdata\s+engineer\b", "Data Engineer"),
    (r"\b(director|head)\s+of\s+(ml|ai|machine learning)\b", "Director of ML"),
    (r"\bvp\s+of\s+(ai|ml)\b", "VP of AI"),
    (r"\b(ai|ml|machine learning)\s+manager\b", "AI/ML Manager"),
)
TITLE_NOUNS = ("engineer", "scientist", "director", "head", "vp", "manager")  # each title pattern needs one of them
SKILL_PATTERNS = {
    "Python": r"\bpython\b",
    "Machine Learning": r"\b(machine learning|ml)\b",
    "Deep Learning": r"\b(deep learning|dl)\b",
    "PyTorch": r"\bpytorch\b",
    "TensorFlow": r"\b(tensorflow|tf)\b",
    "NLP": r"\b(nlp|natural language processing)\b",
    "Computer Vision": r"\b(computer vision|cv|image processing)\b",
    "MLOps": r"\bmlops\b",
    "Kubernetes": r"\b(kubernetes|k8s)\b",
    "AWS": r"\b(aws|amazon web services)\b",
    "GCP": r"\b(gcp|google cloud)\b",
    "SQL": r"\bsql\b",
    "Spark": r"\b(spark|pyspark)\b",
    "LLMs": r"\b(llm|large language model|gpt|chatgpt)\b",
    "Transformers": r"\b(transformers|bert|attention)\b",
}
STATE_PATTERNS = {
    "CA": r"\b(california|ca|san francisco|los angeles|san diego|san jose|palo alto|mountain view)\b",
    "NY": r"\b(new york|ny|nyc|manhattan|brooklyn)\b",
    "WA": r"\b(washington|wa|seattle|redmond|bellevue)\b",
    "TX": r"\b(texas|tx|austin|dallas|houston)\b",
    "MA": r"\b(massachusetts|ma|boston|cambridge)\b",
    "CO": r"\b(colorado|co|denver|boulder)\b",
    "IL": r"\b(illinois|il|chicago)\b",
    "GA": r"\b(georgia|ga|atlanta)\b",
    "NC": r"\b(north carolina|nc|charlotte|raleigh|durham)\b",
    "FL": r"\b(florida|fl|miami|tampa|orlando)\b",
}
RANGE_YEARS_PATTERN = r"(\d+)\s*-\s*(\d+)\s+years"
YEARS_PATTERNS = (
    r"(\d+)\+?\s*years?\s*(?:of\s+)?(?:professional\s+)?experience",
    r"experience[:\s]+(\d+)\+?\s*years",
    r"(\d+)\+?\s*years?\s*in\s*(?:ml|ai|data|software)",
)
SUMMARY_WINDOW = 800
MID_WINDOW = 2000
RESUME_DEFAULT_YEARS = 3
RESUME_MAX_YEARS = 30
TITLE_YEARS_HINTS = (
    (("principal", "staff", "director", "vp"), 12),
    (("senior", "lead", "manager"), 7),
)
TEXT_YEARS_WORDS = ("principal", "staff", "director", "vp")
TEXT_YEARS = 8
SECTION_MARKERS = ("experience", "work history", "professional experience", "employment")
SECTION_WINDOW_LINES = 80
SECTION_LOOKAHEAD = 5
SECTION_LINE_MAX = 120
LOOSE_LINE_MAX = 100
SKILL_TITLE_HINTS = (
    ("MLOps Engineer", ("MLOps",), ("Kubernetes", "AWS", "GCP")),
    ("Data Engineer", ("SQL", "Spark"), ()),
    ("ML Engineer", ("Machine Learning", "Deep Learning"), ("PyTorch", "TensorFlow")),
    ("AI Engineer", ("LLMs",), ("Transformers", "NLP")),
    ("Data Scientist", ("Machine Learning", "Python"), ("NLP", "LLMs")),
    ("Research Scientist", ("Computer Vision",), ("Transformers", "NLP")),
)

# --- fixed values: scoring -----------------------------------------------------------------------------
HIGH_PAY_STATES = ("CA", "NY", "WA", "MA")
LOW_PAY_STATES = ("FL", "TX", "GA", "NC")
Z_90 = 1.645
Z_95 = 1.96
DEFAULT_RMSE = 20000.0
PREDICTION_FLOOR = 30000.0
HUB_STATES_NOTE = ("CA", "NY", "WA")
DEMAND_SKILLS = ("nlp", "llm", "pytorch", "deep learning")
HUB_NOTE = "Major tech hub: Salaries tend to be 20-30% above national average"
SENIOR_NOTE = "Senior/Lead roles: Total compensation often includes significant equity"
SKILL_NOTE = "High-demand AI skills detected: You have strong negotiating leverage"

# --- fixed values: profile columns ---------------------------------------------------------------------
KEY_FEATURES = (
    "job_title", "employer_name", "company", "location", "worksite_state", "state", "skills",
    "seniority_level", "experience_years", "estimated_yoe", "education", "employment_type",
    "job_function", "industries", "soc_code", "year",
)

# --- fixed values: model -------------------------------------------------------------------------------
MODEL_PARAMS = {
    "maxIter": 200,
    "maxDepth": 6,
    "stepSize": 0.1,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "minInstancesPerNode": 3,
    "seed": 42,
}
TUNE_GRID = {
    "maxDepth": (4, 6, 8),
    "stepSize": (0.05, 0.1, 0.15),
    "maxIter": (100, 200, 300),
    "minInstancesPerNode": (1, 3, 5),
}

# --- fixed values: scraped card markup -----------------------------------------------------------------
CARD_CLASSES = {
    "position": "base-search-card__title",
    "company": "base-search-card__subtitle",
    "location": "job-search-card__location",
    "salary": "job-search-card__salary-info",
    "ago_time": "job-search-card__listdate",
}
CARD_LINK_CLASS = "base-card__full-link"
CARD_LOGO_CLASS = "artdeco-entity-image"
DETAIL_CRITERIA = {
    "seniority_level": "Seniority level",
    "employment_type": "Employment type",
    "job_function": "Job function",
    "industries": "Industries",
}
