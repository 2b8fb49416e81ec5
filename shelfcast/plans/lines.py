"""The three product lines as configurations."""

from __future__ import annotations

import dataclasses

from shelfcast import fixed_values as fixed
from shelfcast.fixed_values import Rule


@dataclasses.dataclass(frozen=True)
class Flag:
    """One calendar column: its value before rules ("november", "zero" or "keep") and its rules."""

    column: str
    base: str
    rules: tuple[Rule, ...]


@dataclasses.dataclass(frozen=True)
class LineConfig:
    """What sets one product line apart from another."""

    name: str
    products: tuple[str, ...]
    flags: tuple[Flag, ...]
    regressors: tuple[str, ...]
    country: str = fixed.COUNTRY
    super_divisions: tuple[str, ...] = ()
    promote: bool = False
    store_merges: dict[str, str] = dataclasses.field(default_factory=dict)
    product_merges: dict[str, str] = dataclasses.field(default_factory=dict)
    successors: dict[str, str] = dataclasses.field(default_factory=dict)
    city_fixes: dict[str, str] = dataclasses.field(default_factory=dict)
    city_patterns: tuple[tuple[str, str], ...] = ()
    closed_stores: tuple[str, ...] = fixed.CLOSED_STORES
    closed_in: tuple[str, ...] = ()
    group_keys: tuple[str, ...] = ("sale_date", "store", "city", "super_division", "business_unit")
    levels: tuple[str, ...] = ("super_division", "product_division")
    model_base: str = "union"
    promotions: bool = False


DEVICES = LineConfig(
    name="devices",
    super_divisions=fixed.DEVICE_DIVISIONS,
    products=fixed.DEVICE_PRODUCTS,
    promote=True,
    store_merges=fixed.STORE_MERGES,
    city_fixes=fixed.CITY_FIXES,
    closed_in=("new", "union"),
    levels=("super_division",),
    flags=(
        Flag("black_week", "zero", fixed.DEVICE_BLACK_WEEK),
        Flag("promos", "keep", fixed.DEVICE_DECEMBER),
    ),
    regressors=("black_week", "promos"),
    promotions=True,
)
DEVICES_WITH_CHRISTMAS = dataclasses.replace(
    DEVICES,
    name="devices_with_christmas",
    flags=(
        Flag("black_week", "zero", fixed.DEVICE_BLACK_WEEK),
        Flag("christmas", "zero", fixed.DEVICE_DECEMBER),
    ),
    regressors=("black_week", "promos", "christmas"),
)
SUITES = LineConfig(
    name="suites",
    super_divisions=fixed.SUITE_DIVISIONS,
    products=fixed.SUITE_PRODUCTS,
    product_merges=fixed.SUITE_MERGES,
    city_fixes=fixed.CITY_FIXES,
    closed_in=("history",),
    group_keys=(
        "sale_date",
        "store",
        "city",
        "super_division",
        "product_division",
        "business_unit",
    ),
    flags=(
        Flag("black_week", "zero", fixed.SUITE_BLACK_WEEK),
        Flag("christmas", "zero", fixed.SUITE_CHRISTMAS),
    ),
    regressors=("black_week", "christmas"),
)
CONSOLES = LineConfig(
    name="consoles",
    products=fixed.CONSOLE_PRODUCTS,
    successors=fixed.CONSOLE_SUCCESSORS,
    city_fixes=fixed.CITY_FIXES_SHORT,
    city_patterns=fixed.CITY_PATTERNS,
    closed_in=(),
    group_keys=(
        "sale_date",
        "store",
        "city",
        "postal_code",
        "super_division",
        "product_division",
        "business_unit",
    ),
    flags=(
        Flag("black_week", "november", fixed.CONSOLE_BLACK_WEEK),
        Flag("christmas", "zero", fixed.CONSOLE_CHRISTMAS),
    ),
    regressors=("black_week", "christmas"),
    model_base="new",
)
CONSOLES_FROM_UNION = dataclasses.replace(
    CONSOLES, name="consoles_from_union", closed_in=("union",), model_base="union"
)
LINES = {
    line.name: line
    for line in (DEVICES, DEVICES_WITH_CHRISTMAS, SUITES, CONSOLES, CONSOLES_FROM_UNION)
}
