"""The same queries as plain SQL over the star tables, written independently of the operators."""

from __future__ import annotations

SALES = """
sales AS (
  SELECT CAST(l_shipdate AS DATE) AS sale_date, n_name AS store, r_name AS city,
         LPAD(CAST(l_suppkey AS VARCHAR), 5, '0') AS postal_code,
         CASE WHEN p_size > 25 THEN 'LARGE GOODS' ELSE 'SMALL GOODS' END AS super_division,
         p_type AS product_division, p_brand AS business_unit,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
  FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""
KEPT = SALES + ",\nkept AS (SELECT * FROM sales WHERE quantity >= 0)"

# Last value of the attributes per store and per product.
LAST = """,
last_city AS (
  SELECT store, city FROM (SELECT store, city, row_number() OVER (
    PARTITION BY store ORDER BY sale_date DESC, city DESC) AS rn FROM kept) WHERE rn = 1),
last_postal AS (
  SELECT store, postal_code FROM (SELECT store, postal_code, row_number() OVER (
    PARTITION BY store ORDER BY sale_date DESC, postal_code DESC) AS rn FROM kept) WHERE rn = 1),
last_super AS (
  SELECT business_unit, super_division FROM (SELECT business_unit, super_division, row_number() OVER (
    PARTITION BY business_unit ORDER BY sale_date DESC, super_division DESC) AS rn FROM kept)
  WHERE rn = 1),
last_product AS (
  SELECT business_unit, product_division FROM (SELECT business_unit, product_division, row_number() OVER (
    PARTITION BY business_unit ORDER BY sale_date DESC, product_division DESC) AS rn FROM kept)
  WHERE rn = 1)"""

# Every observed series on every observed day, then summed to months.
DAILY = """,
cells AS (
  SELECT sale_date, store, business_unit, sum(quantity) AS quantity, sum(amount) AS amount
  FROM kept GROUP BY ALL),
grid AS (
  SELECT d.sale_date, p.store, p.business_unit, coalesce(c.quantity, 0) AS quantity,
         coalesce(c.amount, 0) AS amount
  FROM (SELECT DISTINCT sale_date FROM kept) d
  CROSS JOIN (SELECT DISTINCT store, business_unit FROM kept) p
  LEFT JOIN cells c ON c.sale_date = d.sale_date AND c.store = p.store
    AND c.business_unit = p.business_unit)"""
SERIES_TAIL = """,
series AS (
  SELECT g.store, a.city, s.super_division, q.product_division, g.business_unit,
         CAST(month(g.ds) = 11 AS INT) AS black_week, CAST(month(g.ds) = 12 AS INT) AS christmas,
         g.ds, g.y
  FROM (SELECT store, business_unit, last_day(sale_date) AS ds, CAST(sum(quantity) AS BIGINT) AS y
        FROM grid GROUP BY ALL) g
  JOIN last_city a ON a.store = g.store
  JOIN last_super s ON s.business_unit = g.business_unit
  JOIN last_product q ON q.business_unit = g.business_unit)"""
SERIES = KEPT + LAST + DAILY + SERIES_TAIL
STANDIN = (
    SERIES
    + """,
standin AS (
  SELECT store, city, super_division, product_division, business_unit, black_week, christmas, ds,
         CAST(y AS DOUBLE) AS y, y * 0.75::DOUBLE + month(ds) - 4.0::DOUBLE AS yhat,
         y * 1.25::DOUBLE + 1.0::DOUBLE AS yhat_upper, y * 0.5::DOUBLE - 9.0::DOUBLE AS yhat_lower
  FROM series)"""
)
PROMOS = """,
promos AS (
  SELECT p_brand AS business_unit, CAST(l_shipdate AS DATE) AS sale_date, l_discount AS discount_amount
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_discount >= {least}),
promo_months AS (
  SELECT business_unit, last_day(sale_date) AS month_end, sum(discount_amount) AS discount_amount
  FROM promos GROUP BY ALL)"""
MONTHLY = """,
monthly AS (
  SELECT store, business_unit, last_day(sale_date) AS sale_date, CAST(sum(quantity) AS BIGINT) AS quantity,
         CAST(trunc(sum(amount)) AS BIGINT) AS amount
  FROM kept GROUP BY ALL)"""
ROW = """CAST(sale_date AS VARCHAR) AS sale_date, store, city, postal_code, super_division,
  product_division, business_unit, quantity, CAST(amount AS DOUBLE) AS amount"""
SERIES_ROW = """store, city, super_division, product_division, business_unit, black_week, christmas,
  CAST(ds AS VARCHAR) AS ds, y"""
TOTALS = "count(*) AS n_rows, CAST(sum(quantity) AS BIGINT) AS quantity"


def _pivot() -> str:
    return ",\n".join(
        f"CAST(coalesce(sum(quantity) FILTER (store = 'NATION_{i}'), 0) AS BIGINT) AS \"NATION_{i}\""
        for i in range(25)
    )


def _case(rules: list[tuple[str, str, str, int]], fallback: str) -> str:
    """Rules as nested CASE: the first rule innermost, so that a later one wins."""
    text = fallback
    for product, months, years, value in rules:
        hit = f"business_unit = '{product}' AND month(sale_date) IN ({months})"
        if years:
            hit += f" AND year(sale_date) IN ({years})"
        text = f"CASE WHEN {hit} THEN {value} ELSE {text} END"
    return text


def _line(names: list[str], extra: str = "") -> str:
    """Monthly totals under a product line's names, twenty years later."""
    brand = "business_unit"
    for i, name in enumerate(names):
        brand = f"CASE WHEN business_unit = 'Brand#{i + 1}' THEN '{name}' ELSE {brand} END"
    return f""",
line AS (
  SELECT {brand} AS business_unit, last_day(sale_date + INTERVAL 20 YEAR) AS sale_date, quantity {extra}
  FROM monthly)"""


CONSOLES = ["Xbox Series S", "Xbox Series X", "Game Pass PC"]
SUITES = ["Office Standard", "M365", "Office for Mac"]
DEVICES = ["Surface Pro", "Surface Laptop", "Surface Book", "Surface Go", "Surface Laptop Go"]
CONSOLE_BLACK_WEEK = [
    ("Xbox Series S", "11", "2019", 2),
    ("Xbox Series X", "11", "2020", 2),
    ("Xbox Series X", "11", "2021", 0),
    ("Game Pass PC", "11", "", 0),
]
CONSOLE_CHRISTMAS = [
    ("Xbox Series S", "12", "2017", 2),
    ("Xbox Series S", "12", "2023", 1),
    ("Xbox Series X", "12", "2021", 1),
    ("Game Pass PC", "12", "2017", 2),
    ("Game Pass PC", "12", "2019", 2),
]
SUITE_BLACK_WEEK = [("M365", "11", "2017", 1), ("Office Standard", "11", "2023", 1)]
SUITE_CHRISTMAS = [
    ("M365", "12", "2017", 1),
    ("M365", "12", "2019", 2),
    ("M365", "3", "2021", 1),
    ("Office Standard", "12", "2019", 1),
    ("Office Standard", "9", "2019", 1),
    ("Office Standard", "9", "2021", 2),
    ("Office Standard", "4", "2019", 1),
]
DEVICE_BLACK_WEEK = [
    ("Surface Pro", "11", "2019", 1),
    ("Surface Pro", "11", "2020", 2),
    ("Surface Go", "11", "2023", 1),
    ("Surface Book", "11", "2019", 1),
]
DEVICE_DECEMBER = [("Surface Pro", "12", "2023", 1), ("Surface Go", "12", "2023", 1)]
NOVEMBER = "CAST(month(sale_date) = 11 AS INT)"


def _ruled(names: list[str], columns: dict[str, str], extra: str = "", monthly: str = MONTHLY) -> str:
    picked = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    flags = ", ".join(columns)
    return f"""WITH {KEPT}{monthly}{_line(names, extra)}
SELECT business_unit, CAST(sale_date AS VARCHAR) AS sale_date, {flags}, {TOTALS}
FROM (SELECT business_unit, sale_date, quantity, {picked} FROM line) GROUP BY ALL"""


EASTER = """
easter AS (
  SELECT year, make_date(year, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS sunday
  FROM (SELECT *, (a + 11 * h + 22 * l) // 451 AS m
    FROM (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l
      FROM (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h
        FROM (SELECT year, year % 19 AS a, year // 100 AS b, year % 100 AS c
              FROM (SELECT DISTINCT year(ds) AS year FROM {days}))))))"""
HOLIDAYS = """
SELECT year, 'Neujahr' AS holiday, make_date(year, 1, 1) AS ds FROM easter UNION ALL
SELECT year, 'Karfreitag', CAST(sunday - 2 AS DATE) FROM easter UNION ALL
SELECT year, 'Ostermontag', CAST(sunday + 1 AS DATE) FROM easter UNION ALL
SELECT year, 'Erster Mai', make_date(year, 5, 1) FROM easter UNION ALL
SELECT year, 'Christi Himmelfahrt', CAST(sunday + 39 AS DATE) FROM easter UNION ALL
SELECT year, 'Pfingstmontag', CAST(sunday + 50 AS DATE) FROM easter UNION ALL
SELECT year, 'Tag der Deutschen Einheit', make_date(year, 10, 3) FROM easter UNION ALL
SELECT year, 'Reformationstag', make_date(year, 10, 31) FROM easter WHERE year = 2017 UNION ALL
SELECT year, 'Erster Weihnachtstag', make_date(year, 12, 25) FROM easter UNION ALL
SELECT year, 'Zweiter Weihnachtstag', make_date(year, 12, 26) FROM easter"""

# Training part of the design: scaled time, and the changepoints at evenly spaced training rows.
TREND = """,
train AS (
  SELECT store, business_unit, ds, row_number() OVER (PARTITION BY store, business_unit ORDER BY ds) - 1
         AS at FROM series WHERE ds <= DATE '2001-09-30'),
scales AS (
  SELECT store, business_unit, min(ds) AS first, greatest(date_diff('day', min(ds), max(ds)), 1) AS span,
         greatest(least({points}, CAST(floor(count(*) * 0.8) AS INT) - 1), 0) AS n_cp,
         CAST(floor(count(*) * 0.8) AS INT) - 1 AS reach
  FROM train GROUP BY ALL),
points AS (
  SELECT s.store, s.business_unit, s.black_week, s.christmas, s.ds, s.y, c.n_cp, c.span, c.reach, c.first,
         date_diff('day', c.first, s.ds) / CAST(c.span AS DOUBLE) AS t,
         date_diff('day', DATE '1970-01-01', s.ds) AS days
  FROM series s JOIN scales c ON s.store = c.store AND s.business_unit = c.business_unit
  WHERE s.ds <= DATE '2001-10-31'),
bends AS (
  SELECT c.store, c.business_unit, k.k,
         date_diff('day', c.first, r.ds) / CAST(c.span AS DOUBLE) AS cp
  FROM scales c JOIN (SELECT unnest(range(1, {points} + 1)) AS k) k ON k.k <= c.n_cp
  JOIN train r ON r.store = c.store AND r.business_unit = c.business_unit
   AND r.at = round_even(k.k * c.reach / CAST(c.n_cp AS DOUBLE), 0))"""


def _folds(rows: str, fold: str) -> str:
    return f"""SELECT store, business_unit, {fold}, role, count(*) AS n_rows,
  CAST(min(ds) AS VARCHAR) AS first_ds, CAST(max(ds) AS VARCHAR) AS last_ds, CAST(sum(y) AS BIGINT) AS y
FROM ({rows}) GROUP BY ALL"""


CUTS = "(VALUES (DATE '2000-09-01'), (DATE '2000-12-01'), (DATE '2001-03-01'), (DATE '2001-06-01'))"
LATE = CUTS[:-1] + ", (DATE '2001-11-01'))"


def _origins(cuts: str, where: str = "") -> str:
    return f"""SELECT s.*, CAST(c.cutoff AS VARCHAR) AS cutoff,
  CASE WHEN s.ds <= c.cutoff THEN 'train' ELSE 'test' END AS role
FROM series s JOIN {cuts} c(cutoff) ON s.ds <= c.cutoff + 60 {where}"""


def _profile() -> str:
    columns = (
        "sale_date store city postal_code super_division product_division business_unit quantity amount"
    ).split()
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, {len(columns)} AS n_columns, "
        f"count(DISTINCT {c}) AS n_distinct, count(*) - count({c}) AS n_null, "
        f"CAST(count(*) > count({c}) AS INT) AS has_null FROM masked"
        for c in columns
    )


def _slices() -> str:
    ends = {"both": (">=", "<="), "left": (">=", "<"), "right": (">", "<="), "neither": (">", "<")}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS closed, * FROM sales WHERE sale_date {low} DATE '1998-01-15' "
        f"AND sale_date {high} DATE '1998-03-20'"
        for name, (low, high) in ends.items()
    )


CLIPPED = ", ".join(
    f"CASE WHEN {c} < 0 THEN 0.0 ELSE {c} END AS {c}" for c in ("yhat", "yhat_upper", "yhat_lower")
)


def _rounded_up(expressions: dict[str, str]) -> str:
    return ", ".join(
        f"CAST(floor({e}) + CASE WHEN {e} - floor({e}) > 0.8 THEN 1 ELSE 0 END AS BIGINT) AS {c}"
        for c, e in expressions.items()
    )


SCORES = """count(y - yhat) AS n_scored, round(sqrt(avg(abs(y - yhat))), 6) AS root_mae,
  round(avg(abs(y - yhat)), 6) AS mae, round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse,
  round(sqrt(avg(abs(y - yhat))) / nullif(max(y) - min(y), 0), 6) AS normalised"""

GRID_TOTALS = """SELECT CAST(sale_date AS VARCHAR) AS sale_date, store, count(*) AS n_rows,
  count(*) FILTER (amount = 0) AS n_zero, CAST(sum(quantity) AS BIGINT) AS quantity,
  CAST(sum(amount) AS DOUBLE) AS amount FROM grid GROUP BY ALL"""

FUTURE = """,
last AS (SELECT max(sale_date) AS d FROM kept),
template AS (
  SELECT DISTINCT super_division, product_division, business_unit FROM kept, last
  WHERE sale_date = d {only})"""

def _line_base(
    names: list[str], replaced: str, merged_columns: str, level: str = "product_division"
) -> str:
    """Raw sales of a product line from 2020 on, history before that, and both merged.

    ``replaced`` rewrites columns of the new sales only. The dense part has every series of the new
    sales on every day of theirs, with the last attributes of its store and product.
    """
    product = "business_unit"
    for i, name in enumerate(names):
        product = f"CASE WHEN business_unit = 'Brand#{i + 1}' THEN '{name}' ELSE {product} END"
    listed = ", ".join(f"'{n}'" for n in names)
    return f""",
mapped AS (
  SELECT * REPLACE ({product} AS business_unit, CAST(sale_date + INTERVAL 20 YEAR AS DATE) AS sale_date)
  FROM kept),
lines AS (SELECT * REPLACE ({level} AS product_division) FROM mapped WHERE business_unit IN ({listed})),
history AS (SELECT * FROM lines WHERE sale_date < DATE '2020-01-01'),
fresh AS (
  SELECT * {replaced} FROM lines WHERE sale_date >= DATE '2020-01-01' AND store <> 'NATION_8'
    AND store IN (SELECT store FROM history)),
fresh_cells AS (
  SELECT sale_date, store, business_unit, sum(quantity) AS quantity, sum(amount) AS amount
  FROM fresh GROUP BY ALL),
fresh_store AS (
  SELECT store, max(city) AS city, max(postal_code) AS postal_code FROM (
    SELECT store, first_value(city) OVER (PARTITION BY store ORDER BY sale_date DESC, city DESC) AS city,
      first_value(postal_code) OVER (PARTITION BY store ORDER BY sale_date DESC, postal_code DESC)
        AS postal_code FROM fresh) GROUP BY store),
fresh_product AS (
  SELECT business_unit, max(s) AS super_division, max(p) AS product_division FROM (
    SELECT business_unit,
      first_value(super_division) OVER (PARTITION BY business_unit
        ORDER BY sale_date DESC, super_division DESC) AS s,
      first_value(product_division) OVER (PARTITION BY business_unit
        ORDER BY sale_date DESC, product_division DESC) AS p FROM fresh) GROUP BY business_unit),
dense AS (
  SELECT d.sale_date, p.store, a.city, a.postal_code, b.super_division, b.product_division,
         p.business_unit, coalesce(c.quantity, 0) AS quantity, coalesce(c.amount, 0) AS amount
  FROM (SELECT DISTINCT sale_date FROM fresh) d
  CROSS JOIN (SELECT DISTINCT store, business_unit FROM fresh) p
  JOIN fresh_store a ON a.store = p.store
  JOIN fresh_product b ON b.business_unit = p.business_unit
  LEFT JOIN fresh_cells c ON c.sale_date = d.sale_date AND c.store = p.store
    AND c.business_unit = p.business_unit),
merged AS (
  SELECT {merged_columns} FROM (SELECT * FROM history UNION ALL SELECT * FROM dense))"""


def _line_frame(levels: str) -> str:
    """Months of the distinct merged sales, with zero rows up to the end of the next month."""
    return f""",
last_merged AS (SELECT max(sale_date) AS d FROM merged),
merged_store AS (
  SELECT store, max(city) AS city FROM (
    SELECT store, first_value(city) OVER (PARTITION BY store ORDER BY sale_date DESC, city DESC) AS city
    FROM merged) GROUP BY store),
ahead AS (
  SELECT s.store, s.city, {levels}, t.business_unit, m.ds
  FROM merged_store s
  CROSS JOIN (SELECT DISTINCT {levels}, business_unit FROM merged, last_merged WHERE sale_date = d) t
  CROSS JOIN (SELECT DISTINCT last_day(CAST(unnest(range(d + 1, last_day(d + INTERVAL 1 MONTH)
              + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE)) AS ds FROM last_merged) m),
frame AS (
  SELECT store, city, {levels}, business_unit, sale_date,
         CAST(sum(quantity) AS BIGINT) AS quantity, min(future) AS is_future
  FROM (SELECT store, city, {levels}, business_unit, last_day(sale_date) AS sale_date, quantity,
               0 AS future FROM merged
        UNION ALL SELECT *, 0, 1 FROM ahead)
  GROUP BY ALL)"""


CONSOLE_LINE = (
    _line_base(
        CONSOLES,
        "",
        """DISTINCT sale_date, store, city, postal_code, super_division, product_division,
         business_unit, quantity, CAST(amount AS DECIMAL(28,2)) AS amount""",
    )
    + _line_frame("super_division, product_division")
    + f"""
SELECT store, city, super_division, product_division, business_unit,
       {_case(CONSOLE_BLACK_WEEK, NOVEMBER)} AS black_week, {_case(CONSOLE_CHRISTMAS, "0")} AS christmas,
       CAST(sale_date AS VARCHAR) AS ds, quantity AS y, is_future
FROM frame"""
)
SUITE_LINE = (
    _line_base(
        SUITES,
        """REPLACE (CASE super_division WHEN 'SMALL GOODS' THEN 'EDG Managed - Office License and HP'
          ELSE 'EDG Managed - O365 Commercial' END AS super_division,
          CASE business_unit WHEN 'Office for Mac' THEN 'Office Standard' ELSE business_unit END
          AS business_unit)""",
        "*",
    )
    + f" SELECT store, super_division, business_unit, {TOTALS} FROM merged GROUP BY ALL"
)
DEVICE_LINE = (
    _line_base(
        DEVICES,
        "REPLACE ('EDG Managed - Surface Devices' AS super_division)",
        """DISTINCT sale_date, store, city, postal_code, super_division, business_unit, quantity,
         CAST(amount AS DECIMAL(28,2)) AS amount""",
        "business_unit",
    )
    + _line_frame("super_division")
    + PROMOS.format(least="0.09")
    + f""",
named_promos AS (
  SELECT DISTINCT CASE {" ".join(f"WHEN business_unit = 'Brand#{i + 1}' THEN '{n}'"
                                 for i, n in enumerate(DEVICES))} ELSE business_unit END AS product,
         last_day(sale_date + INTERVAL 20 YEAR) AS month_end FROM promos),
flagged AS (
  SELECT f.*, CASE WHEN p.product IS NULL THEN 0 ELSE 1 END AS promos FROM frame f
  LEFT JOIN named_promos p ON p.product = f.business_unit AND p.month_end = f.sale_date)
SELECT store, city, super_division, business_unit, {_case(DEVICE_BLACK_WEEK, "0")} AS black_week, promos,
       {_case(DEVICE_DECEMBER, "0")} AS christmas, CAST(sale_date AS VARCHAR) AS ds, quantity AS y,
       is_future
FROM flagged"""
)


def oracle_sql() -> dict[str, str]:
    """One statement per query that SQL can express."""
    kept, series, standin = f"WITH {KEPT}", f"WITH {SERIES}", f"WITH {STANDIN}"
    sales = f"WITH {SALES}"
    monthly = f"WITH {KEPT}{MONTHLY}"
    promo = PROMOS.format(least="0.1")
    small_z = """[1.0, t, h1, h2, h3, sin(2 * pi() * days / 365.25), cos(2 * pi() * days / 365.25),
      CAST(black_week AS DOUBLE), CAST(christmas AS DOUBLE), CAST(y AS DOUBLE)]"""
    waves = " + ".join(
        f"sin(days * (2 * pi() * {k} / 365.25)) + cos(days * (2 * pi() * {k} / 365.25))"
        for k in range(1, 11)
    )
    return {
        "star_sales": f"{sales} SELECT {ROW} FROM sales",
        "canonical_orders": """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS sale_date,
            o_orderstatus AS store, CAST(o_custkey AS VARCHAR) AS postal_code,
            o_orderpriority AS business_unit, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount
            FROM orders""",
        "typed_orders": """SELECT CAST(o_orderkey AS VARCHAR) AS postal_code,
            CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS sale_date,
            CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderpriority[1] AS BIGINT) END AS quantity,
            CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM orders""",
        "rejected_orders": """SELECT CAST(o_orderkey AS VARCHAR) AS postal_code,
            CASE WHEN o_orderstatus = 'P' THEN 'open' ELSE strftime(o_orderdate, '%-d.%-m.%Y') END AS sale_date,
            CASE WHEN o_orderpriority = '5-LOW' THEN o_orderpriority ELSE o_orderpriority[1] END AS quantity,
            CAST(o_totalprice AS VARCHAR) AS amount,
            concat_ws(',', CASE WHEN o_orderstatus = 'P' THEN 'sale_date' END,
              CASE WHEN o_orderpriority = '5-LOW' THEN 'quantity' END) AS rejected
            FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'""",
        "drop_returns": f"{kept} SELECT {ROW} FROM kept",
        "filter_equals": f"{sales} SELECT {ROW} FROM sales WHERE city = 'EUROPE'",
        "filter_in": f"""{sales} SELECT {ROW} FROM sales
            WHERE product_division IN ('PROMO', 'SMALL', 'LARGE')""",
        "keep_eligible": f"""{sales} SELECT {ROW} FROM sales WHERE postal_code IN (SELECT postal_code
            FROM sales WHERE year(sale_date) = 1995 AND business_unit = 'Brand#1')""",
        "drop_closed": f"""{sales} SELECT {ROW} FROM sales WHERE store NOT IN ('NATION_3', 'NATION_14')
            AND store NOT IN (SELECT n_name FROM nation WHERE n_regionkey = 2)""",
        "replace_values": f"""{sales} SELECT CASE product_division WHEN 'SMALL' THEN 'LARGE'
            WHEN 'LARGE' THEN 'HUGE' ELSE product_division END AS product_division, store, {TOTALS}
            FROM sales GROUP BY 1, 2""",
        "replace_regex": f"""{sales} SELECT CASE WHEN store LIKE '%\\_1%' ESCAPE '\\' THEN 'TEENS'
            WHEN length(store) = 8 THEN 'DIGITS' ELSE store END AS store, {TOTALS}
            FROM sales GROUP BY 1""",
        "promote_level": f"""{sales} SELECT store, product_division AS business_unit, {TOTALS}
            FROM sales GROUP BY ALL""",
        "select_series": f"""{sales} SELECT {ROW} FROM sales
            WHERE store = 'NATION_3' AND business_unit = 'Brand#7'""",
        "split_by_date": f"""{sales} SELECT CASE WHEN sale_date <= DATE '2001-09-30' THEN 'past'
            ELSE 'ahead' END AS part, store, {TOTALS} FROM sales GROUP BY ALL""",
        "date_slice": f"""{sales} SELECT closed, store, {TOTALS} FROM ({_slices()}) GROUP BY ALL""",
        "dedup": f"""{sales} SELECT DISTINCT CAST(sale_date AS VARCHAR) AS sale_date, store, business_unit
            FROM sales""",
        "fill": f"""{sales} SELECT CAST(sale_date AS VARCHAR) AS sale_date, store,
            CASE WHEN quantity >= 0 THEN quantity ELSE 0 END AS quantity FROM sales""",
        "stamp_run": f"""{sales} SELECT store, {TOTALS}, '2001-10-01' AS training_date
            FROM sales GROUP BY store""",
        "narrow_numeric": """WITH j AS (SELECT * FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
            SELECT 's_nationkey' AS column_name, 'tinyint' AS type_name, count(*) AS n_rows,
                   round(sum(CAST(s_nationkey AS DOUBLE)), 2) AS total FROM j UNION ALL
            SELECT 'l_linenumber', 'tinyint', count(*), round(sum(CAST(l_linenumber AS DOUBLE)), 2)
            FROM j UNION ALL
            SELECT 'l_tax', 'float', count(*), round(sum(l_tax), 2) FROM j""",
        "map_lookup": """SELECT coalesce(s_name, 'unmapped') AS store, count(*) AS n_rows,
            sum(l_quantity) AS quantity FROM lineitem LEFT JOIN (SELECT * FROM supplier
            WHERE s_acctbal > 0) s ON l_suppkey = s_suppkey GROUP BY 1""",
        "last_attribute_by_store": f"""{kept}{LAST} SELECT store, city, postal_code
            FROM last_city JOIN last_postal USING (store)""",
        "last_attribute_by_product": f"""{kept}{LAST} SELECT business_unit, super_division,
            product_division FROM last_super JOIN last_product USING (business_unit)""",
        "attach_last_attributes": f"""{kept}{LAST} SELECT k.store, l.postal_code, {TOTALS}
            FROM kept k JOIN last_postal l ON k.store = l.store GROUP BY ALL""",
        "add_promos": f"""{monthly}{promo} SELECT CAST(sale_date AS VARCHAR) AS sale_date, store,
            m.business_unit, quantity, amount, CASE WHEN p.month_end IS NULL THEN 0 ELSE 1 END AS promos
            FROM monthly m LEFT JOIN promo_months p
            ON p.business_unit = m.business_unit AND p.month_end = m.sale_date""",
        "join_actuals": f"""{series}, ahead AS (SELECT store, business_unit, ds, 0 AS is_future FROM series
            UNION ALL SELECT store, business_unit, last_day(max(ds) + INTERVAL 1 MONTH), 1 FROM series
            GROUP BY store, business_unit)
            SELECT a.store, a.business_unit, CAST(a.ds AS VARCHAR) AS ds, is_future,
            coalesce(s.y, -1) AS y FROM ahead a LEFT JOIN series s ON s.store = a.store
            AND s.business_unit = a.business_unit AND s.ds = a.ds""",
        "attach_regressors": f"""{monthly}{promo}, ahead AS (
            SELECT store, business_unit, sale_date AS ds, 0 AS is_future FROM monthly UNION ALL
            SELECT store, business_unit, last_day(max(sale_date) + to_months(CAST(k AS INT))), 1
            FROM monthly CROSS JOIN (VALUES (1), (2)) t(k) GROUP BY store, business_unit, k)
            SELECT a.store, a.business_unit, CAST(a.ds AS VARCHAR) AS ds, a.is_future,
              coalesce(m.quantity, -1) AS quantity,
              CASE WHEN m.store IS NOT NULL AND p.month_end IS NOT NULL THEN 1 ELSE 0 END AS promos
            FROM ahead a LEFT JOIN monthly m ON m.store = a.store AND m.business_unit = a.business_unit
              AND m.sale_date = a.ds
            LEFT JOIN promo_months p ON p.business_unit = a.business_unit AND p.month_end = a.ds""",
        "aggregate_sales": f"""{kept} SELECT CAST(sale_date AS VARCHAR) AS sale_date, store, city,
            super_division, product_division, business_unit, CAST(sum(quantity) AS BIGINT) AS quantity,
            CAST(sum(amount) AS DOUBLE) AS amount FROM kept GROUP BY ALL""",
        "densify_observed": f"{kept}{DAILY} {GRID_TOTALS}",
        "densify_calendar": f"""{kept}, cells AS (
              SELECT sale_date, store, business_unit, sum(quantity) AS quantity, sum(amount) AS amount
              FROM kept GROUP BY ALL),
            days AS (SELECT CAST(unnest(range(min(sale_date), max(sale_date) + INTERVAL 1 DAY,
              INTERVAL 1 DAY)) AS DATE) AS sale_date FROM kept),
            grid AS (SELECT d.sale_date, p.store, coalesce(c.quantity, 0) AS quantity,
              coalesce(c.amount, 0) AS amount FROM days d
              CROSS JOIN (SELECT DISTINCT store, business_unit FROM kept) p
              LEFT JOIN cells c USING (sale_date, store, business_unit))
            {GRID_TOTALS}""",
        "densify_monthly": f"""{kept}{DAILY} SELECT CAST(last_day(sale_date) AS VARCHAR) AS sale_date,
            store, business_unit, CAST(sum(quantity) AS BIGINT) AS quantity,
            CAST(sum(amount) AS DOUBLE) AS amount FROM grid GROUP BY ALL""",
        "densify_daily_attributes": f"""{kept}{LAST}{DAILY} SELECT g.store, city, postal_code,
            g.business_unit, super_division, product_division, {TOTALS} FROM grid g
            JOIN last_city USING (store) JOIN last_postal USING (store)
            JOIN last_super USING (business_unit) JOIN last_product USING (business_unit)
            GROUP BY ALL""",
        "pivot_series": f"""{kept} SELECT CAST(last_day(sale_date) AS VARCHAR) AS sale_date, {_pivot()}
            FROM kept GROUP BY 1""",
        "unpivot_series": f"""{kept} SELECT CAST(m.ds AS VARCHAR) AS sale_date, n_name AS store,
            CAST(coalesce(sum(quantity), 0) AS BIGINT) AS quantity
            FROM (SELECT DISTINCT last_day(sale_date) AS ds FROM kept) m CROSS JOIN nation
            LEFT JOIN kept ON last_day(sale_date) = m.ds AND store = n_name GROUP BY ALL""",
        "resample_month": f"""{kept} SELECT store, business_unit, product_division,
            CAST(last_day(sale_date) AS VARCHAR) AS sale_date, CAST(sum(quantity) AS BIGINT) AS quantity,
            CAST(trunc(sum(amount)) AS BIGINT) AS amount FROM kept GROUP BY ALL""",
        "resample_week": f"""{kept} SELECT store, CAST(CAST(date_trunc('week', sale_date) + INTERVAL 6 DAY
            AS DATE) AS VARCHAR) AS sale_date, CAST(sum(quantity) AS BIGINT) AS quantity,
            CAST(trunc(sum(amount)) AS BIGINT) AS amount FROM kept GROUP BY ALL""",
        "resample_event_week": """SELECT event_type AS store, CAST(CAST(date_trunc('week', CAST(ts AS DATE))
            + INTERVAL 6 DAY AS DATE) AS VARCHAR) AS sale_date, count(*) AS quantity,
            CAST(trunc(sum(CAST(value AS DECIMAL(18,2)))) AS BIGINT) AS amount FROM events GROUP BY 1, 2""",
        "monthly_promos": f"""WITH {SALES}{PROMOS.format(least="0.09")} SELECT business_unit,
            CAST(month_end AS VARCHAR) AS month_end, round(discount_amount, 4) AS discount_amount,
            1 AS promos FROM promo_months""",
        "forecast_optimum": f"""{series} SELECT store, business_unit, 1 AS settled, 0.0 AS slope FROM series
            WHERE ds <= DATE '2001-09-30' GROUP BY ALL HAVING count(DISTINCT ds) >= 2""",
        "search_agreement": f"""{series}, cuts AS (SELECT unnest([DATE '2000-09-01', DATE '2000-12-01', DATE '2001-03-01',
              DATE '2001-06-01']) AS c),
            folds AS (SELECT store, business_unit, c, count(*) FILTER (ds <= c) AS known,
              count(*) FILTER (ds > c AND ds <= c + INTERVAL 60 DAY) AS tested FROM series, cuts GROUP BY ALL)
            SELECT store, business_unit, CAST(sum(tested) AS BIGINT) AS n_scored, 1 AS searched, 1 AS halved
            FROM folds WHERE known >= 2 AND tested > 0 GROUP BY store, business_unit""",
        # November is the flag black_week on month ends, and no lockdown falls into these years.
        "tweedie_optimum": """SELECT 'month_' || m AS parameter, 0.0 AS score
            FROM (SELECT DISTINCT month(l_shipdate) AS m FROM lineitem) WHERE m NOT IN (1, 11)
            UNION ALL SELECT name, 0.0 FROM (VALUES ('intercept'), ('store_level'), ('business_unit_level'),
            ('year_centred'), ('black_week')) n(name)""",
        "series_frame": f"{series} SELECT {SERIES_ROW} FROM series",
        "published_series": f"{series} SELECT {SERIES_ROW} FROM series",
        "series_frame_by_day": f"""{kept}{LAST}{DAILY} SELECT g.store, city, super_division,
            product_division, g.business_unit,
            CASE WHEN month(sale_date) = 11 AND day(sale_date) > 23 THEN 1 ELSE 0 END AS black_week,
            CAST(last_day(sale_date) AS VARCHAR) AS ds, CAST(sum(quantity) AS BIGINT) AS y FROM grid g
            JOIN last_city USING (store) JOIN last_super USING (business_unit)
            JOIN last_product USING (business_unit) GROUP BY ALL""",
        "series_counts": f"""{kept} SELECT store, city, business_unit, count(*) AS n_rows
            FROM kept GROUP BY ALL""",
        "forecast_rollup": f"""{standin} SELECT business_unit, CAST(last_day(ds) AS VARCHAR) AS month_end,
            CAST(trunc(sum(y)) AS BIGINT) AS y, CAST(trunc(sum(yhat)) AS BIGINT) AS yhat FROM standin
            WHERE ds >= DATE '2000-01-31' GROUP BY 1, 2""",
        "sales_rollup": f"""{kept} SELECT super_division, product_division, business_unit,
            CAST(last_day(sale_date) AS VARCHAR) AS sale_date, CAST(sum(quantity) AS BIGINT) AS quantity,
            CAST(trunc(sum(amount)) AS BIGINT) AS amount FROM kept GROUP BY ALL""",
        "max_date": f"{sales} SELECT CAST(max(sale_date) AS VARCHAR) AS max_date FROM sales",
        "profile": f"""WITH {SALES}, masked AS (SELECT * REPLACE (CASE WHEN quantity >= 0 THEN quantity END
            AS quantity) FROM sales) {_profile()}""",
        "profile_merged": f"""WITH {SALES}, masked AS (SELECT * REPLACE (CASE WHEN quantity >= 0 THEN quantity END
            AS quantity) FROM sales) SELECT column_name, n_rows, n_null, 1 AS within FROM ({_profile()})""",
        "append_cells": f"""{kept} SELECT store, business_unit, CAST(last_day(sale_date) AS VARCHAR) AS month,
            CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(amount) AS DOUBLE) AS amount, count(*) AS n_rows,
            CAST(max(sale_date) AS VARCHAR) AS last_date FROM kept GROUP BY ALL""",
        "distinct_values": f"{sales} SELECT DISTINCT business_unit FROM sales",
        "time_series_folds": series
        + " "
        + _folds(
            """SELECT *, CASE WHEN pos < start THEN 'train' ELSE 'test' END AS role FROM (
            SELECT s.*, f.fold, s.n - (5 - f.fold) * (s.n // 6) AS start FROM (
              SELECT *, row_number() OVER (PARTITION BY store, business_unit ORDER BY ds) - 1 AS pos,
                count(*) OVER (PARTITION BY store, business_unit) AS n FROM series) s
            CROSS JOIN (VALUES (0), (1), (2), (3), (4)) f(fold))
            WHERE n // 6 > 0 AND pos < start + n // 6""",
            "fold",
        ),
        "rolling_origin_folds": f"{series} " + _folds(_origins(CUTS), "cutoff"),
        "rolling_origin_folds_complete": f"{series} "
        + _folds(
            _origins(LATE, "WHERE c.cutoff + 60 <= (SELECT max(ds) FROM series)"), "cutoff"
        ),
        "order_output": f"""{series} SELECT {SERIES_ROW} FROM series ORDER BY store, city, super_division,
            product_division, business_unit, ds""",
        "preview_first": f"""{series} SELECT {SERIES_ROW} FROM (SELECT * FROM series
            ORDER BY store, business_unit, ds LIMIT 10)""",
        "preview_last": f"""{series} SELECT {SERIES_ROW} FROM (SELECT * FROM series
            ORDER BY store DESC, business_unit DESC, ds DESC LIMIT 10)""",
        "best_trial": f"""{series}, scores AS (SELECT store, business_unit, CAST(month(ds) AS INT) AS trial_id,
            round(sqrt(avg(CAST((y - 20) * (y - 20) AS DOUBLE))), 3) AS rmse FROM series GROUP BY ALL)
            SELECT store, business_unit, trial_id, rmse FROM (SELECT *, row_number() OVER (
            PARTITION BY store, business_unit ORDER BY rmse, trial_id) AS rn FROM scores) WHERE rn = 1""",
        "append": f"""{kept} SELECT CASE WHEN sale_date <= DATE '2001-09-30' THEN city ELSE 'none' END
            AS city, store, {TOTALS} FROM kept GROUP BY 1, 2""",
        "future_frame": f"""{kept}{LAST}{FUTURE.format(only="")} SELECT store, city, postal_code,
            super_division, product_division, business_unit, CAST(f.day AS VARCHAR) AS sale_date,
            CAST(0 AS BIGINT) AS quantity, CAST(0 AS DOUBLE) AS amount FROM last_city JOIN last_postal USING (store) CROSS JOIN template
            CROSS JOIN (SELECT CAST(unnest(range(d + 1, last_day(d + INTERVAL 1 MONTH) + INTERVAL 1 DAY,
            INTERVAL 1 DAY)) AS DATE) AS day FROM last) f""",
        "future_frame_of_template": f"""{kept}{LAST}{FUTURE.format(only="AND store = 'NATION_4'")}
            SELECT store, city, postal_code, super_division, product_division, business_unit,
            CAST(f.day AS VARCHAR) AS sale_date, CAST(0 AS BIGINT) AS quantity, CAST(0 AS DOUBLE) AS amount
            FROM last_city JOIN last_postal USING (store) CROSS JOIN template
            CROSS JOIN (SELECT DISTINCT last_day(CAST(unnest(range(d + 1, last_day(d + INTERVAL 1 MONTH)
            + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE)) AS day FROM last) f""",
        "horizon_days": f"""{sales} SELECT DISTINCT CAST(sale_date AS VARCHAR) AS sale_date,
            CAST(date_diff('day', sale_date, last_day(sale_date + INTERVAL 1 MONTH)) AS INT) AS days
            FROM sales""",
        "black_week_flag": f"""{sales} SELECT DISTINCT CAST(sale_date AS VARCHAR) AS sale_date,
            CASE WHEN month(sale_date) = 11 AND day(sale_date) > 23 THEN 1 ELSE 0 END AS black_week,
            {NOVEMBER} AS november FROM sales""",
        "calendar_rules_consoles": _ruled(
            CONSOLES,
            {
                "black_week": _case(CONSOLE_BLACK_WEEK, NOVEMBER),
                "christmas": _case(CONSOLE_CHRISTMAS, "0"),
            },
        ),
        "calendar_rules_suites": _ruled(
            SUITES,
            {"black_week": _case(SUITE_BLACK_WEEK, "0"), "christmas": _case(SUITE_CHRISTMAS, "0")},
        ),
        "calendar_rules_devices": _ruled(
            DEVICES,
            {
                "black_week": _case(DEVICE_BLACK_WEEK, "0"),
                "christmas": _case(DEVICE_DECEMBER, "0"),
                "promos": _case(DEVICE_DECEMBER, "flag"),
            },
            ", flag",
            MONTHLY.replace("monthly AS", "plain AS")
            + promo
            + """,
monthly AS (SELECT l.*, CASE WHEN p.month_end IS NULL THEN 0 ELSE 1 END AS flag FROM plain l
  LEFT JOIN promo_months p ON p.business_unit = l.business_unit AND p.month_end = l.sale_date)""",
        ),
        "calendar_rules_intended": f"""{monthly} SELECT business_unit, CAST(sale_date AS VARCHAR) AS sale_date,
            promos, {TOTALS} FROM (SELECT *, {_case([
                ("Brand#1", "11", "1995, 1996, 1998", 1),
                ("Brand#1", "11, 12", "1998, 1999", 2),
                ("Brand#2", "12", "", 3),
            ], "0")} AS promos FROM monthly) GROUP BY ALL""",
        "black_friday_window": f"""{sales}, fridays AS (SELECT year, CAST(make_date(year, 11, 1)
            + to_days(CAST((5 - isodow(make_date(year, 11, 1)) + 7) % 7 + 21 AS INT)) AS DATE) AS friday
            FROM (SELECT DISTINCT CAST(year(sale_date) AS INT) AS year FROM sales))
            SELECT year, 'black_friday' AS event, CAST(CAST(friday + to_days(CAST(k AS INT)) AS DATE)
            AS VARCHAR) AS ds FROM fridays CROSS JOIN (VALUES (-4), (-3), (-2), (-1), (0), (1)) t(k)
            UNION ALL SELECT year, 'cyber_monday', CAST(CAST(friday + INTERVAL 3 DAY AS DATE) AS VARCHAR)
            FROM fridays""",
        "event_calendar": f"""{sales}, days AS (SELECT holiday, CAST(unnest(range(a, b + INTERVAL 1 DAY,
            INTERVAL 1 DAY)) AS DATE) AS ds FROM (SELECT postal_code AS holiday, min(sale_date) AS a,
            max(sale_date) AS b FROM sales GROUP BY 1))
            SELECT holiday, CAST(ds AS VARCHAR) AS ds FROM days WHERE ds = last_day(ds)""",
        "event_calendar_daily": f"""{sales}, days AS (SELECT holiday, CAST(unnest(range(a, b
            + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS ds FROM (SELECT postal_code AS holiday,
            min(sale_date) AS a, max(sale_date) AS b FROM sales GROUP BY 1))
            SELECT CAST(ds AS VARCHAR) AS ds, count(*) AS n_events FROM days GROUP BY 1""",
        "german_holidays": f"""WITH {SALES}, days AS (SELECT sale_date AS ds FROM sales),
            {EASTER.format(days="days")} SELECT CAST(year AS INT) AS year, holiday, CAST(ds AS VARCHAR) AS ds
            FROM ({HOLIDAYS})""",
        "extend_months": f"""{series} SELECT store, business_unit, CAST(ds AS VARCHAR) AS ds, 0 AS is_future
            FROM series UNION ALL SELECT store, business_unit, CAST(last_day(max(ds)
            + to_months(CAST(k AS INT))) AS VARCHAR), 1 FROM series CROSS JOIN (VALUES (1), (2)) t(k)
            GROUP BY store, business_unit, k""",
        "calendar_features": f"""{series}, shifted AS (SELECT last_day(ds + INTERVAL 20 YEAR) AS ds
            FROM series) SELECT CAST(ds AS VARCHAR) AS ds, CAST(year(ds) AS INT) AS year, CAST(month(ds) AS INT) AS month,
            CASE WHEN ds IN (DATE '2020-03-31', DATE '2020-04-30', DATE '2020-11-30', DATE '2020-12-31')
            THEN 0 ELSE 1 END AS corona_lockdown, count(*) AS n_rows FROM shifted GROUP BY ds""",
        "cutoffs": f"""{sales}, ends AS (SELECT min(sale_date) AS a, max(sale_date) AS b FROM sales),
            starts AS (SELECT CASE WHEN a = date_trunc('month', a) THEN a ELSE CAST(date_trunc('month', a)
            + INTERVAL 1 MONTH AS DATE) END AS s, b FROM ends)
            SELECT CAST(CAST(c AS DATE) AS VARCHAR) AS cutoff FROM (SELECT unnest(range(s,
            b + INTERVAL 1 DAY, INTERVAL 2 MONTH)) AS c FROM starts)""",
        "clip_negative": f"""{standin} SELECT store, business_unit, CAST(ds AS VARCHAR) AS ds, {CLIPPED}
            FROM standin""",
        "round_up_above": f"""{series} SELECT store, business_unit, CAST(ds AS VARCHAR) AS ds, {
            _rounded_up({
                "yhat": "(y / 7.0::DOUBLE - 2.0)",
                "yhat_upper": "(y / 5.0::DOUBLE)",
                "yhat_lower": "(-y / 3.0::DOUBLE)",
            })
        } FROM series""",
        "score": f"""{standin} SELECT store, {SCORES} FROM standin WHERE ds >= DATE '2001-01-31'
            GROUP BY store""",
        "score_one_date": f"{standin} SELECT {SCORES} FROM standin WHERE ds = DATE '2001-09-30'",
        "cv_metrics": f"""{standin} SELECT store, business_unit, CAST(quarter(ds) AS INT) AS trial_id,
            round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse, round(avg(abs(y - yhat)), 6) AS mae,
            count(y - yhat) AS n_scored FROM standin GROUP BY 1, 2, 3""",
        "design_matrix": f"""{series}{TREND.format(points=25)}, days AS (SELECT DISTINCT ds FROM points),
            {EASTER.format(days="days").strip()}, holidays AS ({HOLIDAYS})
            SELECT p.store, p.business_unit, CAST(p.ds AS VARCHAR) AS ds,
              CASE WHEN p.ds <= DATE '2001-09-30' THEN 1 ELSE 0 END AS is_train, p.n_cp,
              20 AS n_season, round(any_value(p.t), 6) AS t,
              round(sum(greatest(p.t - b.cp, 0)), 6) AS hinges,
              round(any_value({waves}), 6) AS waves,
              CAST(any_value((SELECT count(*) FROM holidays h WHERE h.ds = p.ds) + p.black_week) AS DOUBLE)
                AS flags, 2 + p.n_cp + 20 + 11 + 2 AS width
            FROM points p JOIN bends b ON b.store = p.store AND b.business_unit = p.business_unit
            GROUP BY p.store, p.business_unit, p.ds, p.n_cp""",
        "normal_stats": f"""{series}{TREND.format(points=3)}, wide AS (
            SELECT p.store, p.business_unit, p.ds, p.days, p.t, p.black_week, p.christmas, p.y,
              max(greatest(p.t - b.cp, 0)) FILTER (b.k = 1) AS h1,
              max(greatest(p.t - b.cp, 0)) FILTER (b.k = 2) AS h2,
              max(greatest(p.t - b.cp, 0)) FILTER (b.k = 3) AS h3
            FROM points p JOIN bends b ON b.store = p.store AND b.business_unit = p.business_unit
            WHERE p.ds <= DATE '2001-09-30' GROUP BY ALL),
            z AS (SELECT store, business_unit, {small_z} AS z FROM wide)
            SELECT store, business_unit, CAST(i AS INT) AS i, CAST(j AS INT) AS j, round(sum(z[i + 1] * z[j + 1]), 4) AS total, count(*) AS n
            FROM z CROSS JOIN (SELECT unnest(range(0, 10)) AS i) a
            JOIN (SELECT unnest(range(0, 10)) AS j) b ON b.j >= a.i GROUP BY ALL""",
        "boosting_histogram": f"""{series}, known AS (SELECT * FROM series WHERE ds <= DATE '2001-09-30'),
            wide AS (
              SELECT y, black_week, year(ds) AS year, month(ds) AS month,
                avg(y) OVER (PARTITION BY store) AS s, avg(y) OVER (PARTITION BY business_unit) AS b FROM known),
            numbered AS (
              SELECT y, dense_rank() OVER (ORDER BY s) - 1 AS store_level,
                dense_rank() OVER (ORDER BY b) - 1 AS business_unit_level, black_week,
                0 AS corona_lockdown, dense_rank() OVER (ORDER BY year) - 1 AS year, month - 1 AS month FROM wide),
            parts AS (
              UNPIVOT (SELECT y, store_level::BIGINT AS store_level, business_unit_level::BIGINT AS business_unit_level,
                black_week::BIGINT AS black_week, corona_lockdown::BIGINT AS corona_lockdown, year::BIGINT AS year,
                month::BIGINT AS month FROM numbered)
              ON store_level, business_unit_level, black_week, corona_lockdown, year, month
              INTO NAME feature VALUE bin),
            m AS (SELECT avg(y) AS m FROM known)
            SELECT feature, CAST(bin AS INT) AS bin, round(sum(pow(m, 0.9) - y * pow(m, -0.1)), 4) AS g,
              round(sum(0.9 * pow(m, 0.9) + 0.1 * y * pow(m, -0.1)), 4) AS h
            FROM parts, m GROUP BY feature, bin""",
        "simulated_interval": f"""{series}, known AS (
              SELECT store, business_unit, min(ds) AS first, max(ds) AS last, avg(y) AS yhat, stddev_pop(y) AS noise
              FROM series WHERE ds <= DATE '2001-09-30' GROUP BY ALL),
            steps AS (
              SELECT s.store, s.business_unit, s.ds, k.yhat, k.noise,
                (s.ds - k.first) / CAST(k.last - k.first AS DOUBLE) AS t
              FROM series s JOIN known k ON k.store = s.store AND k.business_unit = s.business_unit
              WHERE s.ds > DATE '2001-09-30'),
            gaps AS (
              SELECT *, greatest(t - coalesce(lag(t) OVER (PARTITION BY store, business_unit ORDER BY ds), 1), 0) AS gap
              FROM steps),
            drawn AS (
              SELECT *, md5(store || '|' || business_unit || '|' || draw || '|' || ds) AS m
              FROM gaps CROSS JOIN (SELECT unnest(range(1, 101)) AS draw)),
            numbers AS (
              SELECT *, list_transform(range(0, 5),
                lambda i: (CAST('0x' || substr(m, CAST(1 + 6 * i AS BIGINT), 6) AS BIGINT) + 0.5::DOUBLE) / 16777216) AS u
              FROM drawn),
            bent AS (
              SELECT *, t - (1 - u[3]) * gap AS at, CASE WHEN u[1] < 1 - exp(-25 * gap) THEN
                -noise * sqrt(25 * gap / (1 - exp(-25 * gap))) * sign(u[2] - 0.5) * ln(1 - 2 * abs(u[2] - 0.5))
                ELSE 0 END AS amount FROM numbers),
            paths AS (
              SELECT a.store, a.business_unit, a.ds, a.draw,
                any_value(a.yhat + a.noise * sqrt(-2 * ln(a.u[4])) * cos(2 * pi() * a.u[5]))
                  + sum(b.amount * (a.t - b.at)) AS value
              FROM bent a JOIN bent b ON b.store = a.store AND b.business_unit = a.business_unit AND b.draw = a.draw
                AND b.ds <= a.ds GROUP BY ALL)
            SELECT store, business_unit, CAST(ds AS VARCHAR) AS ds, round(quantile_cont(value, 0.1), 4) AS lower,
              round(quantile_cont(value, 0.9), 4) AS upper FROM paths GROUP BY ALL""",
        "tag_split": f"""{series} SELECT store, CAST(ds <= DATE '2001-09-30' AS INT) AS is_train,
            CAST(ds <= DATE '2001-09-30' AND ds > DATE '2001-08-31' AS INT) AS is_valid,
            CAST(ds > DATE '2001-09-30' AS INT) AS is_predict, count(*) AS n_rows,
            CAST(sum(y) AS BIGINT) AS y FROM series GROUP BY 1, 2, 3, 4""",
        "publish_historic": f"""{standin} SELECT DISTINCT store, city, super_division, product_division,
            business_unit, black_week, christmas, CAST(ds AS VARCHAR) AS ds, y, yhat, yhat_upper, yhat_lower
            FROM standin""",
        "publish_predicted": f"""{standin} SELECT DISTINCT store, city, super_division, product_division,
            business_unit, black_week, christmas, CAST(ds AS VARCHAR) AS ds, y, {
                _rounded_up({c: c for c in ("yhat", "yhat_upper", "yhat_lower")})
            } FROM standin WHERE ds > DATE '2001-09-30'""",
        "publish_database": f"""{standin} SELECT store, city, super_division, product_division,
            business_unit, black_week, christmas, CAST(ds AS VARCHAR) AS ds, y, {
                _rounded_up({c: c for c in ("yhat", "yhat_upper", "yhat_lower")})
            } FROM standin WHERE ds >= DATE '2001-01-01'""",
        "apply_per_series": f"""{series} SELECT store, business_unit, CAST(ds AS VARCHAR) AS ds,
            CAST(sum(y) OVER (PARTITION BY store, business_unit ORDER BY ds) AS BIGINT) AS running
            FROM series""",
        "register_sales": f"""{series} SELECT store, city, business_unit, count(*) AS n_rows
            FROM series GROUP BY ALL""",
        "console_line_frame": f"WITH {KEPT}{CONSOLE_LINE}",
        "suite_line_merged": f"WITH {KEPT}{SUITE_LINE}",
        "device_line_frame": f"WITH {KEPT}{DEVICE_LINE}",
    }
