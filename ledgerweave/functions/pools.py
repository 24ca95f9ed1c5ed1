"""Value pools and distribution parameters."""

from __future__ import annotations

from typing import NamedTuple

# Everything in this module is a domain constant of the generated tables.

CURRENCIES = (
    "USD", "EUR", "GBP", "JPY", "CNY", "KRW", "CAD", "AUD", "CHF", "BRL", "MXN", "INR", "SGD",
    "HKD", "SEK",
)
CURRENCY_WEIGHTS = (35, 20, 10, 8, 7, 4, 3, 3, 2, 2, 2, 1, 1, 1, 1)
UNITS_PER_USD = {
    "EUR": 0.92, "GBP": 0.79, "JPY": 149.5, "CNY": 7.24, "KRW": 1340.0, "CAD": 1.36,
    "AUD": 1.53, "CHF": 0.89, "BRL": 4.98, "MXN": 17.2, "INR": 83.1, "SGD": 1.34,
    "HKD": 7.82, "SEK": 10.4,
}
RATE_TYPES = (("M", "Average Rate"), ("P", "Month-End Rate"), ("B", "Budget Rate"))
RATE_TARGETS = ("USD", "EUR")
EXCHANGE_RATE_ROWS = len(CURRENCIES) * len(RATE_TYPES) * len(RATE_TARGETS)

FISCAL_START_MONTH = 6
PERIODS_PER_YEAR = 13
PERIOD_WEIGHTS = (7, 7, 8, 8, 8, 8, 8, 8, 8, 8, 8, 9, 5)
DEFAULT_FISCAL_YEARS = (2019, 2025)

NEGATIVE_SHARE = 0.12
SALES_QTY_RANGE = (1, 100_000)
RETURNS_RATIO = 0.08


class AmountParams(NamedTuple):
    mean: float
    std_dev: float
    low: float
    high: float


AMOUNTS = {
    "revenue": AmountParams(500_000, 1_000_000, 10_000, 50_000_000),
    "cogs": AmountParams(250_000, 500_000, 5_000, 25_000_000),
    "opex": AmountParams(100_000, 200_000, 1_000, 5_000_000),
}


class AccountClass(NamedTuple):
    name: str
    label: str
    start: int
    end: int
    sign: str
    weight: int
    amounts: str


ACCOUNT_CLASSES = (
    AccountClass("revenue", "Revenue", 1_000_000, 1_999_999, "credit", 20, "revenue"),
    AccountClass("cogs", "COGS", 2_000_000, 2_999_999, "debit", 25, "cogs"),
    AccountClass("gross_profit", "Gross Profit", 3_000_000, 3_099_999, "credit", 5, "revenue"),
    AccountClass("selling", "Selling", 4_000_000, 4_499_999, "debit", 15, "opex"),
    AccountClass("admin", "Admin", 4_500_000, 4_999_999, "debit", 10, "opex"),
    AccountClass("rd", "R&D", 5_000_000, 5_499_999, "debit", 10, "opex"),
    AccountClass("other_income", "Other Income", 6_000_000, 6_499_999, "credit", 5, "revenue"),
    AccountClass("other_expense", "Other Expense", 6_500_000, 6_999_999, "debit", 5, "opex"),
    AccountClass("tax", "Tax", 7_000_000, 7_499_999, "debit", 5, "opex"),
)
# Cyclic style: number prefix and pad width by ``id % 9``.
CYCLIC_ACCOUNT_PREFIXES = (
    ("7", 6), ("1", 6), ("2", 6), ("3", 6), ("44", 5), ("45", 5), ("5", 6), ("6", 6), ("8", 6),
)

DOCUMENT_TYPES = (
    ("SA", "G/L Account Document"),
    ("KR", "Vendor Invoice"),
    ("KZ", "Vendor Payment"),
    ("DR", "Customer Invoice"),
    ("DZ", "Customer Payment"),
    ("AB", "Accounting Document"),
    ("WA", "Goods Issue"),
    ("WE", "Goods Receipt"),
    ("RE", "Invoice – Gross"),
    ("RN", "Invoice – Net"),
    ("MI", "Inventory Document"),
    ("PR", "Price Change"),
    ("ZP", "Payment Posting"),
    ("AA", "Asset Posting"),
    ("AF", "Dep. Posting"),
    ("CO", "Controlling Document"),
    ("RA", "Sub-Ledger Accrual"),
    ("RV", "SD Billing Transfer"),
    ("JV", "Journal Voucher"),
    ("IC", "Intercompany"),
)

VERSIONS = (
    ("010", "Actual"),
    ("100", "Budget"),
    ("110", "Budget"),
    ("120", "Forecast"),
    ("130", "Forecast"),
    ("200", "Plan"),
    ("300", "Plan"),
)

SECURITY_REGIONS = (
    "North America", "EMEA", "Greater China", "APLA", "Global", "Americas", "Europe",
    "Asia Pacific", "Latin America", "Middle East Africa", "Emerging Markets",
    "Developed Markets", "Corporate", "Digital", "Direct",
)
REGIONS = ("North America", "EMEA", "Greater China", "APLA")
COUNTRIES = (
    "US", "GB", "DE", "FR", "NL", "JP", "CN", "HK", "KR", "CA", "AU", "BR", "MX", "IN", "SG",
)

COMPANIES = (
    ("Nike USA Inc", "USD"),
    ("Nike Europe BV", "EUR"),
    ("Nike Japan KK", "JPY"),
    ("Nike Greater China Ltd", "CNY"),
    ("Nike Canada Corp", "CAD"),
    ("Nike Australia Pty Ltd", "AUD"),
    ("Nike UK Ltd", "GBP"),
    ("Nike Korea Ltd", "KRW"),
    ("Nike Brazil Ltda", "BRL"),
    ("Nike Mexico SA de CV", "MXN"),
    ("Converse Inc", "USD"),
    ("Nike Direct", "USD"),
    ("Nike Digital", "USD"),
    ("Jordan Brand", "USD"),
    ("Nike Golf", "USD"),
)

FUNCTIONAL_AREAS = (
    "Demand Creation", "Sales", "Logistics", "Operations", "Finance", "HR", "IT", "Legal",
    "Corporate", "Supply Chain", "Marketing", "Product", "Innovation", "Retail Operations",
    "Digital",
)

DIVISION_GROUPS = ("Footwear", "Apparel", "Equipment")

PROFIT_CENTER_SEGMENTS = (
    "North America", "EMEA", "Greater China", "APLA", "Global Brand Divisions", "Corporate",
)
PROFIT_CENTER_CHANNELS = ("Wholesale", "Direct", "Digital", "Factory")
OPERATING_SEGMENTS = (
    "Consumer Direct Acceleration", "Wholesale Partners", "Digital Commerce",
)

BRANDS = ("Nike", "Jordan", "Converse")
BRAND_WEIGHTS = (70, 20, 10)
CATEGORIES = ("Footwear", "Apparel", "Equipment", "Accessories")
CATEGORY_WEIGHTS = (55, 35, 6, 4)
GENDERS = ("Mens", "Womens", "Kids", "Unisex")
GENDER_WEIGHTS = (40, 35, 15, 10)
PLATFORMS = (
    "Running", "Training", "Basketball", "Football/Soccer", "Lifestyle", "Golf", "Tennis",
    "Baseball", "Skateboarding", "CrossFit",
)
SILHOUETTES = (
    "Low Top", "Mid Top", "High Top", "Slip On", "Sandal", "Boot", "Trainer", "Short", "Pant",
    "Jacket", "Top", "Bra", "Sock",
)
FRANCHISES = (
    "Air Max", "Air Force", "Jordan", "React", "ZoomX", "Free", "Pegasus", "Vaporfly", "Metcon",
    "Flex", "Dri-FIT", "Therma-FIT",
)
AGES = ("Adult", "Kids", "Youth", "Infant")
LEAGUES = ("NBA", "NFL", "FIFA", "MLB", "None", "None", "None")
TEAMS = ("Lakers", "Bulls", "Heat", "Celtics", "None", "None")
ATHLETES = ("LeBron James", "Cristiano Ronaldo", "Serena Williams", "Tiger Woods", "")
CONSTRUCT_SEGMENTS = ("Performance", "Lifestyle", "Jordan", "Converse")
CONSUMER_OFFENSES = ("Running", "Training", "Basketball", "Football", "Lifestyle")
CORE_FOCUSES = ("Category Focus", "Core", "Scale", "Amplify")
MERCHANDISING_CLASSES = ("Core", "Fashion", "Performance", "Training")
SILHOUETTE_TYPES = ("Low Cut", "Mid Cut", "High Cut", "Slip On")

CUSTOMER_CHANNELS = (
    "Nike Direct", "Wholesale", "Digital", "Retail Partner", "Department Store",
    "Sporting Goods", "Pure Player Digital",
)
CUSTOMER_CHANNEL_WEIGHTS = (25, 30, 20, 10, 5, 5, 5)
MARKETPLACE_CHANNELS = (
    "Nike.com", "Nike App", "SNKRS", "Nike Stores", "Nike Factory Store",
    "Nike Community Store", "Wholesale Digital", "Traditional Wholesale",
)
CUSTOMER_BUSINESS_TYPES = ("Direct to Consumer", "Wholesale", "Digital Native")
CUSTOMER_SUBTYPES = ("Premium", "Standard", "Value", "Key Account")
ACCOUNT_TIERS = ("Tier 1", "Tier 2", "Tier 3")
WHOLESALE_TIERS = ("Tier 1", "Tier 2", "Tier 3", "Key Account", "Standard")

BUSINESS_MODELS = ("DTC", "Wholesale", "Digital", "Marketplace")
DEMAND_STREAMS = ("Running", "Training", "Basketball", "Football", "Lifestyle", "Golf")
ATTRIBUTION_BUSINESS_TYPES = ("B2C", "B2B", "B2B2C")
MARKETING_TYPES = ("Performance", "Lifestyle", "Sport", "Culture")
GENDER_AGES = ("Mens", "Womens", "Kids", "Young Adult")
LIFECYCLES = ("Launch", "Core", "Carryover", "Closeout")
DISTRIBUTION_METHODS = ("Ship-to-Store", "Drop-Ship", "Pick-Pack", "Cross-Dock")
QUALITIES = ("A+", "A", "B", "C")
PRODUCT_GROUPS = (
    ("FW", "Footwear"), ("AP", "Apparel"), ("EQ", "Equipment"), ("ACC", "Accessories"),
)
SALES_ORDER_TYPES = ("ZOR", "ZOQ", "ZOB", "ZORE", "ZURB")
SALES_ITEM_CATEGORIES = ("TAN", "TAF", "TAS", "TAX")

COST_CENTER_CATEGORIES = (("A", "1"), ("B", "2"), ("C", "3"), ("D", "4"))
COST_CENTER_TYPES = (
    ("E", "Expenses"), ("F", "Finance"), ("L", "Logistics"), ("M", "Marketing"),
    ("P", "Production"),
)
COST_CENTER_CURRENCIES = ("USD", "EUR", "GBP", "JPY", "CNY")
COST_CENTER_CITIES = ("New York", "London", "Tokyo", "Shanghai", "Paris", "Sydney")

MEASURES = (
    "Net Revenue", "Gross Profit", "EBIT", "EBITDA", "Operating Income", "Net Income", "COGS",
    "Gross Margin", "Operating Expense", "Capital Expenditure",
)
CHARTS_OF_ACCOUNTS = ("US01", "EU01", "JP01", "CN01", "CONSO")
ACCOUNT_HIERARCHIES = ("P&L", "Balance Sheet", "Management", "CONSO")
SEGMENT_TYPES = ("Operating", "Reporting", "Management")

STORE_BRANDS = (("NK", "Nike"), ("JD", "Jordan"), ("CV", "Converse"))
RETAIL_CONCEPTS = (
    ("NSO", "Nike Store"),
    ("NFS", "Nike Factory Store"),
    ("NCS", "Nike Community Store"),
    ("EMPLOYEE", "Employee Store"),
)
STORE_CURRENCIES = ("USD", "EUR", "GBP", "JPY", "CNY")
STORE_CITIES = ("New York", "London", "Tokyo", "Shanghai", "Paris")

STATEMENT_DOCUMENT_TYPES = ("SA", "KR", "DR", "RV", "IC", "JV")
STATEMENT_CURRENCIES = CURRENCIES[:8]
LEDGERS = ("0L", "2L", "3L")
RECORD_TYPES = ("0", "1", "2", "3")
CONSOLIDATION_GROUPS = ("NIKE", "CONVERSE", "JORDAN", "TOTAL")
CONSOLIDATED_CHANNELS = ("Wholesale", "Direct", "Digital")
POSTING_LEVELS = ("00", "10", "20", "30")
BASE_UNITS = ("EA", "PR", "PK", "BX")
RATE_TYPE_CODES = ("M", "P", "B")

AUDIT_USERS = ("ETL_SERVICE", "BATCH_PROC", "SAP_LOAD", "MANUAL_ADJ", "SYSTEM")
AUDIT_SOURCES = ("SAP_ECC", "SAP_S4", "SALESFORCE", "CUSTOM_APP", "MANUAL")
AUDIT_SOURCE_WEIGHTS = (40, 30, 15, 10, 5)
AUDIT_WINDOW = ("2018-01-01", "2024-12-31")
AUDIT_UPDATE_SHARE = 0.3

# Rows per table when nothing else is asked for.  Facts are sized from the ledger.
DEFAULT_ROWS = {
    "accounting_document_type": 40,
    "atscale_geo_security": 15,
    "calendar_fiscal_period_v": 91,
    "company_code": 80,
    "version_forecast_mapping": 25,
    "functional_area": 150,
    "profit_center": 2_000,
    "division_text": 30,
    "division_text_dim_v": 30,
    "finance_product_dim_v": 500_000,
    "finance_customer_dim_v": 120_000,
    "copa_attribution_dim": 800,
    "cost_center_dim_v": 15_000,
    "geo_wholesale_value_business_dim": 500,
    "geo_marketplace_channel_dim": 200,
    "gl_account_dim": 8_000,
    "gl_account_zfsm_measures_hierarchy_dim": 300,
    "gl_account_hierarchy": 2_500,
    "management_gl_account_hierarchy": 2_500,
    "consolidation_functional_area_hierarchy": 600,
    "consolidation_segment_hierarchy_dim": 1_200,
    "segment_cost_center_hierarchy_dim_v": 1_500,
    "segment_profit_center_hierarchy": 200,
    "DisChannel_cost_center_hierarchy_dim_v": 1_000,
    "DisChannel_profit_center_hierarchy": 1_500,
    "PartDisChannel_profit_center_hierarchy": 1_500,
    "finance_foreign_currency_exchange_rate": EXCHANGE_RATE_ROWS,
    "retail_global_store_profile_v": 1_000,
}
FACT_RATIOS = {
    "general_ledger_fact": 1.0,
    "CIS_fact": 0.002,
    "consolidated_balance_sheet_fact": 0.0004,
}
