"""Word lists, lookup tables, bin edges and thresholds.

Everything in this module is data.  The values are part of the result contract
(a different keyword or edge gives a different answer), so they are stated
plainly and in their natural order.
"""

from datetime import datetime

# --- reference time --------------------------------------------------------
# Queries never read the clock; every "now" is this argument's default.
AS_OF = datetime(2024, 3, 1)

# --- columns of the contact record (fixed values) --------------------------
TEXT_COLUMNS = [
    "campaign", "personalization", "payload", "status_summary", "headline", "title", "enrichment_name",
]
TIMESTAMP_COLUMNS = [
    "timestamp_created", "timestamp_updated", "timestamp_last_contact", "timestamp_last_touch",
    "timestamp_last_open", "timestamp_last_click", "timestamp_last_reply",
    "timestamp_last_interest_change", "retrieval_timestamp", "inserted_at", "enriched_at",
]
CATEGORICAL_COLUMNS = [
    "organization", "status", "upload_method", "assigned_to", "verification_status",
    "enrichment_status", "api_status", "city", "state", "country", "seniority",
]
JSON_COLUMNS = ["employment_history", "organization_data", "account_data", "api_response_raw"]
ENGAGEMENT_COUNTS = ["email_open_count", "email_click_count", "email_reply_count"]
LEAKAGE_COLUMNS = [
    "email_reply_count", "email_click_count", "email_open_count",
    "email_opened_variant", "email_opened_step", "email_clicked_variant", "email_clicked_step",
    "email_replied_variant", "email_replied_step",
    "timestamp_last_open", "timestamp_last_reply", "timestamp_last_click", "timestamp_last_touch",
    "timestamp_last_interest_change", "it_interest_status",
]
PII_COLUMNS = [
    "email", "first_name", "last_name", "company_name", "phone", "website", "company_domain",
    "linkedin_url", "organization_website", "organization_phone",
]
ESSENTIAL_COLUMNS = ["email", "campaign", "timestamp_created"]
COMPLETENESS_COLUMNS = [
    "title", "organization_name", "organization_industry", "seniority", "departments", "functions",
]

# --- bins (fixed values): right-closed edges and their labels ----------------
INF = float("inf")
SIZE_BINS = ([-1, 0, 10, 50, 200, 1000, 10000, INF],
             ["Unknown", "1-10", "11-50", "51-200", "201-1000", "1001-10000", "10000+"])
SIZE_CATEGORY_BINS = ([0, 10, 50, 200, 1000, INF], ["Startup", "Small", "Medium", "Large", "Enterprise"])
AGE_CATEGORY_BINS = ([0, 5, 15, 30, INF], ["New", "Growing", "Established", "Mature"])
FRESHNESS_BINS = ([0, 30, 90, 180, INF], ["Fresh", "Recent", "Stale", "Old"])
HOUR_BINS = ([0, 6, 12, 18, 24], ["Night", "Morning", "Afternoon", "Evening"])
PAGE_BINS = ([0, 1, 5, 10, 20, 50, 100, INF],
             ["Page 1", "Pages 2-5", "Pages 6-10", "Pages 11-20", "Pages 21-50", "Pages 51-100", "Pages 100+"])
EMPLOYEE_RANGE_BINS = ([0, 5, 10, 25, 50, 100, 250, 500, 1000, 5000, INF],
                       ["1-5", "6-10", "11-25", "26-50", "51-100", "101-250", "251-500", "501-1K", "1K-5K", "5K+"])
FATIGUE_BINS = ([0, 10, 50, 100, 500, INF],
                ["Low (1-10)", "Medium (11-50)", "High (51-100)", "Very High (101-500)", "Extreme (500+)"])
INSPECT_SIZE_BINS = ([0, 10, 50, 200, 1000, INF], ["1-10", "11-50", "51-200", "201-1000", "1000+"])
INSPECT_AGE_BINS = ([0, 5, 10, 20, 50, INF],
                    ["0-5 years", "6-10 years", "11-20 years", "21-50 years", "50+ years"])
# upper bounds (inclusive) with labels; the last label has no bound
DAILY_LIMIT_LEVELS = [(100, "Low Volume (≤100)"), (250, "Medium-Low (101-250)"), (350, "Medium (251-350)"),
                      (450, "Medium-High (351-450)"), (650, "High (451-650)"), (None, "Very High (651+)")]
DAILY_LIMIT_SCORES = [(100, 5), (250, 2), (350, 3), (450, 2), (650, 4), (None, 4)]
DAILY_LIMIT_SCORES_COARSE = [(100, 4), (250, 2), (350, 3), (450, 2), (650, 3), (None, 4)]
COMPANY_AGE_LEVELS = [(3, "Startup (0-3 years)"), (10, "Young (4-10 years)"), (20, "Mature (11-20 years)"),
                      (50, "Established (21-50 years)"), (None, "Legacy (50+ years)")]
EMPLOYEE_LEVELS = [(10, "Micro (1-10)"), (50, "Small (11-50)"), (200, "Medium (51-200)"),
                   (1000, "Large (201-1K)"), (None, "Enterprise (1K+)")]
# first year that no longer belongs to the era
BUSINESS_ERAS = [(1980, "Pre-Digital Era"), (1995, "Early Tech Era"), (2000, "Internet Boom"),
                 (2008, "Social Media Era"), (2015, "Mobile Era"), (None, "Cloud/AI Era")]
EMPLOYEE_COUNT_BUCKETS = [(10, "startup", "1-10"), (50, "small", "11-50"), (250, "medium", "51-250"),
                          (1000, "large", "251-1000"), (None, "enterprise", "1000+")]
FIVE_LEVELS = ["Very Low", "Low", "Medium", "High", "Very High"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# --- keyword rules (fixed values): (category, keywords) in rule order --------
INDUSTRY_RULES = [
    ("Software", ["Software", "Technology", "SaaS", "IT Services", "Computer Software",
                  "information technology & services"]),
    ("Finance", ["Financial Services", "Banking", "Insurance", "Investment", "financial services", "banking",
                 "insurance"]),
    ("Healthcare", ["Healthcare", "Medical", "Pharmaceuticals", "Biotechnology", "hospital & health care",
                    "pharmaceuticals"]),
    ("Manufacturing", ["Manufacturing", "Industrial", "Automotive", "Aerospace",
                       "electrical/electronic manufacturing", "machinery"]),
    ("Retail", ["Retail", "E-commerce", "Consumer Goods", "retail"]),
    ("Consulting", ["Consulting", "Professional Services", "Management Consulting", "management consulting"]),
    ("Education", ["Education", "Training", "E-learning", "higher education", "professional training & coaching"]),
    ("Media", ["Media", "Entertainment", "Publishing", "Marketing", "marketing & advertising"]),
    ("Real Estate", ["Real Estate", "Construction", "Property", "real estate", "construction"]),
    ("Energy", ["Energy", "Oil & Gas", "Utilities", "oil & energy"]),
    ("Government", ["Government", "Public Sector", "Non-profit", "government administration",
                    "nonprofit organization management"]),
    ("Telecommunications", ["Telecommunications", "telecommunications"]),
    ("Mining", ["Mining", "mining & metals"]),
    ("Logistics", ["Logistics", "logistics & supply chain"]),
    ("Security", ["Security", "computer & network security"]),
    ("Staffing", ["Staffing", "staffing & recruiting"]),
    ("Venture Capital", ["Venture Capital", "venture capital & private equity"]),
    ("Research", ["Research", "research"]),
    ("Human Resources", ["Human Resources", "human resources"]),
    ("Legal", ["Legal", "law practice"]),
    ("Automotive", ["Automotive", "automotive"]),
    ("Fitness", ["Fitness", "health, wellness & fitness"]),
    ("Investment Management", ["Investment Management", "investment management"]),
    ("Accounting", ["Accounting", "accounting"]),
    ("Other", ["Other", "Unknown", "nan"]),
]
JSON_INDUSTRY_RULES = [
    ("Software", ["computer software", "software", "saas", "information technology"]),
    ("Finance", ["financial services", "banking", "insurance", "investment"]),
    ("Healthcare", ["healthcare", "medical", "pharmaceuticals", "biotechnology"]),
    ("Manufacturing", ["manufacturing", "industrial", "automotive", "aerospace"]),
    ("Retail", ["retail", "e-commerce", "consumer goods"]),
    ("Consulting", ["consulting", "professional services", "management consulting"]),
    ("Education", ["education", "training", "e-learning"]),
    ("Media", ["media", "entertainment", "publishing", "marketing"]),
    ("Real Estate", ["real estate", "construction", "property"]),
    ("Energy", ["energy", "oil & gas", "utilities"]),
    ("Government", ["government", "public sector", "non-profit"]),
    ("Telecommunications", ["telecommunications"]),
    ("Mining", ["mining", "metals"]),
    ("Logistics", ["logistics", "supply chain"]),
    ("Security", ["security", "cybersecurity"]),
    ("Staffing", ["staffing", "recruiting"]),
    ("Venture Capital", ["venture capital", "private equity"]),
    ("Research", ["research"]),
    ("Human Resources", ["human resources"]),
    ("Legal", ["legal", "law"]),
    ("Automotive", ["automotive"]),
    ("Fitness", ["fitness", "wellness"]),
    ("Investment Management", ["investment management"]),
    ("Accounting", ["accounting"]),
]
DOMAIN_INDUSTRY_RULES = [
    ("Software", [".io", ".ai", ".tech", ".app", ".dev", "software", "tech", "saas"]),
    ("Finance", [".bank", ".finance", ".capital", "bank", "finance", "capital"]),
    ("Healthcare", [".health", ".medical", ".care", "health", "medical", "care"]),
    ("Education", [".edu", ".education", ".learn", "edu", "education", "learn"]),
    ("Government", [".gov", ".org", "gov", "org"]),
    ("Media", [".media", ".tv", ".news", "media", "tv", "news"]),
    ("Retail", [".shop", ".store", ".retail", "shop", "store", "retail"]),
]
SENIORITY_RULES = [
    ("C-Level", ["c_suite", "C-Level", "CEO", "CTO", "CFO", "COO", "CMO", "CIO", "Founder", "Owner", "Chief"]),
    ("VP/Director", ["vp", "VP", "Vice President", "Director", "Head of", "director", "head"]),
    ("Manager", ["Manager", "Lead", "Senior Manager", "manager"]),
    ("Senior", ["Senior", "Senior Engineer", "Senior Developer", "Senior Analyst", "senior"]),
    ("Mid-Level", ["Mid", "Engineer", "Developer", "Analyst", "Specialist", "entry"]),
    ("Junior", ["Junior", "Entry", "Associate", "intern"]),
    ("Other", ["Other", "Unknown", "nan", "partner", "owner"]),
]
TITLE_SENIORITY_RULES = [
    ("C-Level", ["CEO", "CTO", "CFO", "COO", "CMO", "CIO", "Chief", "President", "Founder", "Owner"]),
    ("VP/Director", ["VP", "Vice President", "Director", "Head of", "Head"]),
    ("Manager", ["Manager", "Lead", "Senior Manager"]),
    ("Senior", ["Senior", "Senior Engineer", "Senior Developer", "Senior Analyst"]),
    ("Mid-Level", ["Engineer", "Developer", "Analyst", "Specialist"]),
    ("Junior", ["Junior", "Entry", "Associate", "Intern"]),
    ("Other", ["Other", "Unknown", "Partner", "Owner"]),
]
TITLE_RULES = [
    ("CEO/Founder", ["CEO", "Chief Executive Officer", "Founder", "Co-Founder", "President", "Owner"]),
    ("CTO/Technical", ["CTO", "Chief Technology Officer", "Technical Director", "VP Engineering",
                       "Head of Engineering"]),
    ("CFO/Finance", ["CFO", "Chief Financial Officer", "Finance Director", "VP Finance", "Head of Finance"]),
    ("CMO/Marketing", ["CMO", "Chief Marketing Officer", "Marketing Director", "VP Marketing", "Head of Marketing"]),
    ("Sales", ["Sales Director", "VP Sales", "Head of Sales", "Sales Manager", "Business Development"]),
    ("Product", ["Product Manager", "Product Director", "VP Product", "Head of Product"]),
    ("HR", ["HR Director", "VP HR", "Head of HR", "Human Resources", "Talent"]),
    ("Operations", ["Operations Director", "VP Operations", "Head of Operations", "COO"]),
    ("Consultant", ["Consultant", "Advisor", "Partner", "Principal"]),
    ("Developer", ["Developer", "Engineer", "Software Engineer", "Programmer"]),
    ("Analyst", ["Analyst", "Data Analyst", "Business Analyst", "Research Analyst"]),
    ("Manager", ["Manager", "Team Lead", "Supervisor"]),
    ("Other", ["Other", "Unknown", "nan"]),
]
SENIORITY_TITLE_RULES = [("CEO/Founder", SENIORITY_RULES[0][1])] + SENIORITY_RULES[1:]
SERVICE_INDUSTRY_RULES = [
    ("technology", ["software", "technology", "tech", "saas", "it"]),
    ("finance", ["finance", "financial", "banking", "investment"]),
    ("healthcare", ["healthcare", "medical", "health", "pharmaceutical"]),
    ("manufacturing", ["manufacturing", "industrial", "automotive"]),
    ("services", ["consulting", "services", "professional"]),
    ("retail", ["retail", "ecommerce", "commerce"]),
]
SERVICE_INDUSTRY_CODES = {"technology": 1, "finance": 2, "healthcare": 3, "manufacturing": 4, "services": 5,
                          "retail": 6, "other": 7, "unknown": 0}
DIRECT_INDUSTRY_CODES = [
    (1, ["software", "technology", "tech", "saas"]),
    (2, ["finance", "financial", "banking"]),
    (3, ["healthcare", "medical", "health"]),
    (4, ["manufacturing", "industrial"]),
    (5, ["consulting", "services"]),
    (6, ["retail", "ecommerce"]),
]
SIZE_TEXT_RULES = [
    ("startup", ["startup", "1-10"]), ("small", ["small", "11-50"]), ("medium", ["medium", "51-250"]),
    ("large", ["large", "251-1000"]), ("enterprise", ["enterprise", "1000+"]),
]
SIZE_CODES = {"startup": 1, "small": 2, "medium": 3, "large": 4, "enterprise": 5, "unknown": 0}
REVENUE_CODES = {"sub_1m": 1, "1m_10m": 2, "10m_100m": 3, "over_100m": 4, "unknown": 0}
REVENUE_LEVELS = [(1, "sub_1m"), (10, "1m_10m"), (100, "10m_100m"), (None, "over_100m")]

# --- word lists (fixed values) ----------------------------------------------
HIGH_VALUE_TITLES = ["ceo", "cto", "cfo", "president", "director", "vp", "vice president", "head of", "chief",
                     "founder", "owner", "manager"]
HIGH_VALUE_SENIORITY = ["c_level", "vp", "director", "head"]
TECH_DEPARTMENTS = ["engineering", "technology", "it", "data", "digital", "innovation"]
TECH_LEADERSHIP_TITLES = ["CEO", "CTO", "VP", "Director", "Manager", "Founder"]
TECH_INDUSTRIES = ["Technology", "Software", "Tech"]
TECH_EXECUTIVE_SENIORITY = ["C-level", "VP", "Director"]
SALES_INDUSTRIES = ["Sales", "Marketing"]
SALES_SENIORITY = ["Manager", "Director"]
HIGH_ENGAGEMENT_COUNTRIES = ["United States", "Canada", "United Kingdom", "Australia", "Germany"]
MANAGEMENT_WORDS = ["director", "manager", "head", "vp", "ceo", "cto", "cfo", "chief", "president"]
DECISION_WORDS = ["director", "vp", "president", "ceo", "cto", "cfo", "chief", "head", "lead"]
TECH_KEYWORDS = ["software", "technology", "tech", "digital", "ai", "cloud", "saas", "data", "cyber"]
OPEN_END_DATES = ["present", "current", ""]
DEGREE_LEVELS = [(4, ["phd", "doctorate"]), (3, ["master", "mba"]), (2, ["bachelor"]), (1, ["associate"])]
INTENT_SCORES = {"high": 3, "medium": 2, "low": 1}
CONTACTABILITY_SCORES = {"verified": 3, "likely": 2, "possible": 1}
SENIORITY_SCORES = {"senior": 4, "director": 5, "vp": 6, "svp": 7, "evp": 8, "c_level": 9, "entry": 1,
                    "junior": 1, "associate": 2, "manager": 3}
ORG_SIZE_BUCKETS = [(10, "startup"), (50, "small"), (250, "medium"), (1000, "large"), (None, "enterprise")]
RANK_TIERS = [(1000, "top_1k"), (10000, "top_10k"), (100000, "top_100k"), (None, "other")]
MATURITY_SETTINGS = {"development": (7, 3), "staging": (14, 7), "sales_team_preference": (14, 14),
                     "production": (30, 14)}
SOURCE_TYPE_KEYWORDS = {
    "web_scraping": ["timestamp", "url", "scraped", "crawled"],
    "human_input": ["name", "email", "phone", "company"],
    "sensor_data": ["measurement", "reading", "value", "sensor"],
    "api_data": ["api", "response", "payload", "json"],
}

# --- mail provider codes (fixed values) --------------------------------------
ESP_PROVIDERS = {
    1: "Gmail/Google Workspace", 2: "Microsoft Outlook/Office 365", 3: "Yahoo Mail", 4: "AOL Mail",
    5: "Apple iCloud Mail", 6: "ProtonMail", 7: "Tutanota", 8: "Zoho Mail", 9: "Fastmail", 10: "GMX Mail",
    11: "Yandex Mail", 12: "Custom/Unknown", 999: "Custom/Internal Email Servers",
    1000: "Unknown/Custom Configuration",
}
ESP_SCORES = {8: 5, 11: 4, 2: 3, 3: 2, 1: 2, 999: 1, 4: 1, 6: 1, 7: 1, 5: 1}
ESP_HIGH_PERFORMANCE = [8, 11, 2]
ESP_LABELS = [
    ([2], "Premium ESP (Code 2 - Outlook/Hotmail)"),
    ([1], "Major ESP (Code 1 - Gmail)"),
    ([8], "High-Performance Niche (Code 8)"),
    ([3, 6, 7], "Standard ESPs (Codes 3,6,7)"),
    ([4, 9, 10, 11, 12], "Low-Performance ESPs (Codes 4,9-12)"),
    ([999], "Default/Catch-All (Code 999)"),
    ([1000], "Enterprise/Custom (Code 1000)"),
]
ESP_RANGES = [(50, "Other Standard ESPs (1-50)"), (500, "Specialized Systems (51-500)"),
              (None, "Unknown/Custom Systems (500+)")]

# --- patterns (fixed values) -------------------------------------------------
EMAIL_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE_PATTERN = r"\d{3}[-.\s]?\d{3}[-.\s]?\d{4}"
URL_PATTERN = r"http|www\."
PROFILE_URL_PATTERN = r"^https?://(?:www\.)?linkedin\.com/in/[a-zA-Z0-9\-]+/?$"

# --- thresholds (fixed values) -----------------------------------------------
MATURITY_DAYS = 30
STALE_DAYS = 60
MONTHLY_CREDITS = 20_000
GOLD_MIN_QUALITY = 0.3
TRAINING_MIN_QUALITY = 0.5
MONTHLY_CREDITS = 20000
TRAINING_RESERVE = 2000
ALERT_THRESHOLDS = [  # category, metric, warning, critical, direction
    ("enrichment_credits", "remaining_credits", 2000.0, 500.0, "below"),
    ("data_quality", "quality_score", 0.7, 0.5, "below"),
    ("model_performance", "f1_score", 0.6, 0.4, "below"),
    ("data_freshness", "hours_since_update", 24.0, 48.0, "above"),
]
CONSTRAINT_RANGES = {  # column: (low, high)
    "engagement_level": (0, 2), "created_day_of_week": (0, 6), "created_month": (1, 12), "created_hour": (0, 23),
    "created_quarter": (1, 4), "created_is_weekend": (0, 1), "created_is_business_hours": (0, 1),
    "has_updated": (0, 1), "has_last_contact": (0, 1), "has_numbers_in_text": (0, 1),
    "text_quality_score": (0, 3), "has_enrichment": (0, 1), "is_high_value_title": (0, 1),
    "is_high_value_seniority": (0, 1), "is_tech_department": (0, 1), "data_quality_score": (0, 1),
}
