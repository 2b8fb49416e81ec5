"""Word lists, rule tables and constants that results depend on.

Everything here is data. Years and months of a calendar rule are listed as the business wrote them;
``functions.calendar.effective`` says how each rule profile reads such a list.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

# Raw input headers and their canonical names.
RAW_COLUMNS = {
    "Sales Date": "sale_date",
    "Store_names": "store",
    "Reseller City": "city",
    "Reseller Postal Code": "postal_code",
    "Super Division": "super_division",
    "Product Division": "product_division",
    "Business Unit": "business_unit",
    "Rslr Sales Quantity": "quantity",
    "Rslr Sales Amount": "amount",
}
RAW_ORG_ID = "Reseller Organization ID"
RAW_COUNTRY = "Reseller Country"
DIM_ORG_ID = "Org als Text"
DIM_STORE = "Unique Name (Masterlist)"
RAW_PROMO_COLUMNS = {
    "Sales Date": "sale_date",
    "Sales_Date": "sale_date",
    "Business Unit": "business_unit",
    "Business unit": "business_unit",
    "Discount_amount": "discount_amount",
}

COUNTRY = "Germany"

# Stores that no longer trade.
CLOSED_STORES = (
    "Saturn Connect Trier",
    "Media Markt Heilbronn 2",
    "Saturn Schweinfurt Schrammstraße",
    "Saturn Connect Köln",
    "Saturn Stuttgart-Hbf",
    "Saturn-Berlin Clayallee",
    "Saturn Mönchengladbach - Stresemannstraße",
    "Saturn Lübeck",
    "Saturn München Theresienhöhe",
    "Saturn Berlin-Alt-Treptow",
    "Media Markt Turnstraße",
    "Saturn Wiesbaden Bahnhofsplatz",
    "Media Markt Ellwangen - DAS",
    "Media Markt GmbH Nürtingen",
    "Media Markt Meppen",
    "Media Markt Schleswig",
    "Media-Saturn IT Services GmbH",
    "Meida Markt Waiblingen",
    "Saturn Bergisch Gladbach",
    "Saturn Wesel",
    "Saturn Hagen",
    "Media Markt Bad Cannstatt",
    "Saturn Heidelberg",
    "Saturn Hildesheim",
    "Saturn Münster am York-Ring",
    "Media Markt Köln-Chorweiler",
    "Saturn Dessau",
    "Saturn Essen-Steele",
    "Saturn Euskirchen",
    "Saturn Göttingen",
    "Saturn Hennef",
    "Saturn Herford",
    "Saturn Düsseldorf",
    "Saturn Itzehoe",
    "Saturn Siegburg",
    "Saturn Weiterstadt",
    "Saturn Bremerhaven - BSS",
    "Saturn Gelsenkirchen Buer",
)

# Exact and pattern replacements.
STORE_MERGES = {
    "Media Markt Heilbronn 2": "Media Markt Heilbronn",
    "Saturn Stuttgart-Hbf": "Saturn Stuttgart",
}
CITY_FIXES = {
    "M?llheim": "Müllheim",
    "Stuttgart-Vaihingen": "Stuttgart",
    "Berlin Köpenick": "Berlin",
    "Berlin-Steglitz": "Berlin",
}
CITY_FIXES_SHORT = {"M?llheim": "Müllheim", "Stuttgart-Vaihingen": "Stuttgart"}
CITY_PATTERNS = ((r"^.*Berlin.*$", "Berlin"), (r"^.*Stuggart.*$", "Stuttgart"))

# Divisions and products of the three product lines.
DEVICE_DIVISIONS = ("EDG Managed - Surface Devices",)
DEVICE_PRODUCTS = (
    "Surface Pro",
    "Surface Laptop",
    "Surface Book",
    "Surface Go",
    "Surface Laptop Go",
)
SUITE_DIVISIONS = ("EDG Managed - Office License and HP", "EDG Managed - O365 Commercial")
SUITE_PRODUCTS = ("Office Standard", "M365", "Office for Mac")
SUITE_MERGES = {"Office for Mac": "Office Standard"}
CONSOLE_SUCCESSORS = {
    "Xbox One X": "Xbox Series X",
    "Xbox One S": "Xbox Series S",
    "Xbox One S - All Digital": "Xbox Series S",
    "Xbox LIVE Gold Retail": "Game Pass PC",
}
CONSOLE_PRODUCTS = ("Xbox Series S", "Xbox Series X", "Game Pass PC")


class Rule(NamedTuple):
    """Set ``value`` for one product in the listed months of the listed years (no years: every year)."""

    product: str
    months: tuple[int, ...]
    years: tuple[int, ...]
    value: int


# Calendar rules, in order; a later rule wins.
DEVICE_BLACK_WEEK = (
    Rule("Surface Pro", (11,), (2017, 2018, 2019), 1),
    Rule("Surface Pro", (11,), (2020,), 2),
    Rule("Surface Go", (11,), (2019, 2021), 1),
    Rule("Surface Book", (11,), (2018, 2019), 1),
)
DEVICE_DECEMBER = (
    Rule("Surface Pro", (12,), (2017, 2018, 2019, 2020), 1),
    Rule("Surface Go", (12,), (2018, 2019, 2020, 2021), 1),
)
SUITE_BLACK_WEEK = (
    Rule("M365", (11,), (2017,), 1),
    Rule("Office Standard", (11,), (2019, 2020), 1),
)
SUITE_CHRISTMAS = (
    Rule("M365", (12,), (2017,), 1),
    Rule("M365", (12,), (2019,), 2),
    Rule("M365", (3,), (2021,), 1),
    Rule("Office Standard", (12,), (2017, 2018, 2019), 1),
    Rule("Office Standard", (9,), (2019,), 1),
    Rule("Office Standard", (9,), (2021,), 2),
    Rule("Office Standard", (4,), (2019,), 1),
    Rule("Office Standard", (7, 9), (2019,), 1),
)
CONSOLE_BLACK_WEEK = (
    Rule("Xbox Series S", (11,), (2017, 2018, 2019), 2),
    Rule("Xbox Series X", (11,), (2020,), 2),
    Rule("Xbox Series X", (11,), (2021,), 0),
    Rule("Game Pass PC", (11,), (), 0),
)
CONSOLE_CHRISTMAS = (
    Rule("Xbox Series S", (12,), (2017,), 2),
    Rule("Xbox Series S", (12,), (2018, 2019, 2021), 1),
    Rule("Xbox Series X", (12,), (2020, 2021), 1),
    Rule("Game Pass PC", (12,), (2017,), 2),
    Rule("Game Pass PC", (12,), (2018, 2019), 2),
)

# Lockdown ranges of the additive and of the Tweedie model.
LOCKDOWNS = (
    ("lock_down", dt.date(2020, 3, 22), dt.date(2020, 5, 3)),
    ("lock_down", dt.date(2020, 12, 13), dt.date(2021, 3, 7)),
)
TWEEDIE_LOCKDOWNS = (
    ("lock_down", dt.date(2020, 3, 22), dt.date(2020, 5, 4)),
    ("lock_down", dt.date(2020, 11, 2), dt.date(2021, 1, 10)),
)

# Training, search and publishing constants.
TRAIN_END = dt.date(2022, 2, 28)
INTERVAL_WIDTH = 0.95
GRID_CHANGEPOINT = (0.001, 0.01, 0.1, 0.5)
GRID_SEASONALITY = (0.01, 0.1, 1.0, 10.0)
BOUNDS_CHANGEPOINT = (0.001, 0.5)
BOUNDS_SEASONALITY = (0.01, 10.0)
TRIALS_LONG = 100
TRIALS_SHORT = 20
TWEEDIE_POWER = 1.1
TWEEDIE_FOLDS = 5
TWEEDIE_DRAWS = 10
TWEEDIE_SEED = 42
TWEEDIE_TRAIN_END = dt.date(2021, 12, 31)
TWEEDIE_VALID_FROM = dt.date(2021, 11, 30)
ROUND_UP_ABOVE = 0.8
PREDICTION_BATCH = 2500
HISTORIC_BATCH = 50000
PREDICTION_TABLE = "Xbox_prediction"
HISTORIC_TABLE = "Xbox_historic"
PREDICTION_FROM = dt.date(2021, 10, 1)
