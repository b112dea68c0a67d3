"""Fixed values.

These values must equal the ones the original project uses for results to
agree; they are stated here once, in natural order, and every operator takes
them as overridable defaults.
"""

# --- fixed values: state -> sales region (row-level security region) -------
STATE_TO_REGION = {
    "Pichincha": "Highland", "Cotopaxi": "Highland",
    "Chimborazo": "Highland", "Imbabura": "Highland",
    "Tungurahua": "Highland", "Bolivar": "Highland",
    "Azuay": "Highland", "Loja": "Highland",
    "Guayas": "Coastal", "Manabi": "Coastal",
    "El Oro": "Coastal", "Santa Elena": "Coastal",
    "Los Rios": "Coastal", "Esmeraldas": "Coastal",
    "Santo Domingo de los Tsachilas": "Coastal",
    "Pastaza": "Amazon", "Orellana": "Amazon",
}
DEFAULT_REGION = "Other"

# --- fixed values: product family -> category --------------------------------
FAMILY_TO_CATEGORY = {
    "GROCERY I": "Grocery", "GROCERY II": "Grocery",
    "BEVERAGES": "Grocery", "PRODUCE": "Fresh",
    "MEATS": "Fresh", "POULTRY": "Fresh",
    "DAIRY": "Fresh", "DELI": "Fresh",
    "FROZEN FOODS": "Frozen", "PREPARED FOODS": "Frozen",
    "BREAD/BAKERY": "Bakery", "EGGS": "Fresh",
    "SEAFOOD": "Fresh", "CLEANING": "Household",
    "HOME AND KITCHEN I": "Household", "HOME AND KITCHEN II": "Household",
    "HOME CARE": "Household", "BABY CARE": "Personal Care",
    "BEAUTY": "Personal Care", "PERSONAL CARE": "Personal Care",
    "LINGERIE": "Apparel", "LADIESWEAR": "Apparel",
    "CELEBRATION": "Seasonal", "SCHOOL AND OFFICE SUPPLIES": "Seasonal",
    "AUTOMOTIVE": "Other", "HARDWARE": "Other",
    "BOOKS": "Other", "MAGAZINES": "Other",
    "LAWN AND GARDEN": "Other", "PLAYERS AND ELECTRONICS": "Electronics",
    "PET SUPPLIES": "Other", "LIQUOR,WINE,BEER": "Beverages",
}
DEFAULT_CATEGORY = "Other"

# --- fixed values: average unit price per category (currency, 2 dp) ---------
AVG_PRICES = {
    "Grocery": 2.50, "Fresh": 3.75, "Frozen": 4.50,
    "Bakery": 2.00, "Household": 5.00, "Personal Care": 6.00,
    "Apparel": 15.00, "Seasonal": 4.00, "Electronics": 25.00,
    "Beverages": 3.50, "Other": 5.00,
}
DEFAULT_PRICE = 5.00

# --- fixed values: margin rate per category ---------------------------------
MARGIN_RATES = {
    "Grocery": 0.22, "Fresh": 0.35, "Frozen": 0.28,
    "Bakery": 0.45, "Household": 0.30, "Personal Care": 0.40,
    "Apparel": 0.50, "Seasonal": 0.35, "Electronics": 0.15,
    "Beverages": 0.32, "Other": 0.25,
}
DEFAULT_MARGIN_RATE = 0.25

# --- fixed values: rule-based demo forecast base level per family -----------
DEMO_FAMILY_BASE = {
    "GROCERY I": 800, "GROCERY II": 200, "BEVERAGES": 400,
    "PRODUCE": 300, "MEATS": 150, "POULTRY": 100,
    "DAIRY": 250, "DELI": 80, "FROZEN FOODS": 60,
    "BREAD/BAKERY": 180, "CLEANING": 200, "EGGS": 120,
    "PERSONAL CARE": 90, "BEAUTY": 40, "BABY CARE": 30,
    "HOME AND KITCHEN I": 50, "HOME AND KITCHEN II": 30,
    "SCHOOL AND OFFICE SUPPLIES": 25, "CELEBRATION": 20,
}
DEMO_DEFAULT_BASE = 50.0
DEMO_WEEKEND_EFFECT = 1.15
DEMO_MONTH_AMPLITUDE = 0.15
DEMO_NOISE_SD = 0.15

# --- fixed values: scoring-frame assumptions --------------------------------
DEFAULT_TRANSACTIONS = 2000
UNKNOWN_PRODUCT_KEY = 1
FORECAST_HORIZON_DAYS = 90
HOLDOUT_DAYS = 90

# --- fixed values: forecast horizon bins (-1,30], (30,60], (60,90] ----------
HORIZON_BINS = [(-1, 30, "30-Day"), (30, 60, "60-Day"), (60, 90, "90-Day")]

# --- fixed values: measure formatting thresholds ----------------------------
YOY_GREEN, YOY_RED, YOY_GREY = "#059669", "#DC2626", "#6B7280"
YOY_BAND = 0.05
MAPE_STATUS = [(10, "Excellent"), (20, "Good"), (30, "Acceptable")]
MAPE_STATUS_ELSE = "Needs Improvement"
METRIC_SELECTOR = ["Revenue", "Units", "Margin"]

# --- fixed values: model feature columns, in order --------------------------
CATEGORICAL_COLS = ["family", "city", "state", "type"]
FEATURE_COLS = [
    "store_nbr", "family", "onpromotion", "city", "state", "type",
    "cluster", "oil_price", "is_holiday", "transactions",
    "year", "month", "day_of_week", "day_of_month",
    "week_of_year", "quarter", "is_weekend", "is_payday",
    "is_month_start", "oil_price_lag7",
]

# --- fixed values: row-level security roles ---------------------------------
ROLES = {"Highland": "Highland", "Coastal": "Coastal", "Amazon": "Amazon", "All": None}
