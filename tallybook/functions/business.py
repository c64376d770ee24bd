"""Business classifications, each one a plain ``when`` ladder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions.coerce import col, strip, title_case
from tallybook.schemas import GUEST_CODE, GUEST_ID

# Merchandise keywords (matched anywhere in the text, first category wins).
CATEGORY_KEYWORDS = {
    "Seasonal & Festive": ["HEART", "CHRISTMAS", "XMAS", "STAR", "LIGHT", "CANDLE", "TREE", "FESTIVE", "DECORATION"],
    "Kitchen & Dining": ["MUG", "CUP", "PLATE", "BOWL", "TEA", "COFFEE", "BAKING", "CUTLERY", "KITCHEN", "JAR", "BOTTLE"],
    "Bags & Travel": ["BAG", "TOTE", "PURSE", "WALLET", "LUGGAGE", "TRAVEL"],
    "Stationery & Office": ["PEN", "NOTEBOOK", "PENCIL", "CARD", "STICKER", "PAPER", "STATIONERY"],
    "Home Decor & Furnishing": ["BOX", "CLOCK", "FRAME", "MIRROR", "CUSHION", "SIGN", "LANTERN", "DOORSTOP"],
    "Toys & Children": ["TOY", "GAME", "DOLL", "PUZZLE", "CHILD"],
}
DEFAULT_CATEGORY = "Gifts & Accessories"

# Sales region -> (market tier, countries in title case).
REGION_COUNTRIES = {
    "Domestic UK": ("Tier 1 - Domestic", ["United Kingdom", "Uk"]),
    "Western Europe": (
        "Tier 2 - Core Europe",
        ["Germany", "France", "Eire", "Ireland", "Netherlands", "Belgium", "Switzerland", "Austria"]),
    "Southern Europe": ("Tier 2 - Core Europe", ["Spain", "Portugal", "Italy", "Greece", "Cyprus", "Malta"]),
    "Nordics": ("Tier 2 - Core Europe", ["Norway", "Sweden", "Finland", "Denmark", "Iceland"]),
    "Eastern Europe": ("Tier 3 - Extended EU", ["Poland", "Czech Republic", "Lithuania", "European Community"]),
    "North America": ("Tier 3 - International", ["Usa", "United States", "Canada"]),
    "Asia-Pacific": ("Tier 3 - International", ["Australia", "Japan", "Singapore", "Hong Kong"]),
    "Middle East": (
        "Tier 3 - International", ["United Arab Emirates", "Saudi Arabia", "Bahrain", "Israel", "Lebanon"]),
    "Africa": ("Tier 3 - International", ["Rsa", "South Africa", "Nigeria"]),
    "Latin America": ("Tier 3 - International", ["Brazil", "Argentina"]),
}
DEFAULT_REGION = ("Other / Overseas", "Tier 3 - International")

# Churn risk tiers (lowest probability, name, advice), the tag of scores, and the model as it is registered.
RISK_TIERS = [
    (0.70, "High Risk", "Trigger VIP win-back campaign with 20% discount coupon immediately."),
    (0.40, "Medium Risk", "Send personalized product recommendations and re-engagement email."),
]
LOW_RISK = ("Low Risk", "Standard loyalty engagement. Customer is active and healthy.")
MODEL_VERSION = "v1.0"
REGISTERED_NAME, REGISTERED_VERSION = "EcommerceChurnPredictor", "1.0"


def _ladder(branches: list[tuple[Column, str]], default: str) -> Column:
    chain = F.when(*branches[0])
    for condition, value in branches[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def product_category(description: Column | str) -> Column:
    text = F.upper(F.coalesce(col(description), F.lit("")))
    branches = [(text.rlike("|".join(words)), name) for name, words in CATEGORY_KEYWORDS.items()]
    return _ladder(branches, DEFAULT_CATEGORY)


def geography_region(country: Column | str) -> Column:
    name = F.coalesce(title_case(strip(country)), F.lit(""))
    return _ladder([(name.isin(cs), region) for region, (_, cs) in REGION_COUNTRIES.items()], DEFAULT_REGION[0])


def market_tier(country: Column | str) -> Column:
    name = F.coalesce(title_case(strip(country)), F.lit(""))
    return _ladder([(name.isin(cs), tier) for tier, cs in REGION_COUNTRIES.values()], DEFAULT_REGION[1])


# Thresholds and labels of the customer segments, in order of precedence.
def rfm_segment(r: Column | str, f: Column | str, m: Column | str) -> Column:
    r, f, m = col(r), col(f), col(m)
    return _ladder(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
            ((r <= 2) & ((f >= 3) | (m >= 3)), "At Risk - Needs Attention"),
            ((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers"),
            ((r >= 4) & (f <= 2), "New / Potential Loyalists"),
            (r >= 3, "Promising Customers"),
            (r == 1, "Lost Customers"),
            ((r <= 2) & (f <= 2) & (m <= 2), "Hibernating"),
        ],
        "Standard Regulars",
    )


def rfm_score(r: Column | str, f: Column | str, m: Column | str) -> Column:
    return F.concat(*[col(c).cast("string") for c in (r, f, m)])


def customer_code(customer_id: Column | str) -> Column:
    c = col(customer_id)
    return F.when(c == GUEST_ID, GUEST_CODE).otherwise(F.concat(F.lit("CUST_"), c.cast("string")))


def risk_level(probability: Column | str) -> Column:
    p = col(probability)
    return _ladder([(p >= floor, name) for floor, name, _ in RISK_TIERS], LOW_RISK[0])


def risk_advice(probability: Column | str) -> Column:
    p = col(probability)
    return _ladder([(p >= floor, advice) for floor, _, advice in RISK_TIERS], LOW_RISK[1])


# Thresholds and labels of the drift alerts.
def drift_alert(psi: Column | str, p_value: Column | str) -> Column:
    psi, p = col(psi), col(p_value)
    return _ladder(
        [
            ((psi >= 0.25) | (p < 0.01), "HIGH DRIFT (ALERT)"),
            ((psi >= 0.10) | (p < 0.05), "MODERATE DRIFT (WARNING)"),
        ],
        "STABLE (NO DRIFT)",
    )
