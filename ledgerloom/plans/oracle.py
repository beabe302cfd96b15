"""The same queries in ANSI SQL, for an independent engine to check the results.

Values are cast as ``registry.comparable`` does: money to DOUBLE, counts to BIGINT, dates to text.
"""

from __future__ import annotations

from ledgerloom.functions.dates import MONTHS_RU, MONTHS_RU_OF

_BASE = {
    "buyers": """SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS city_id,
        c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(18,2)) AS credit_limit FROM customer""",
    "deals": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CAST(o_orderdate AS DATE) AS order_date, CAST(o_totalprice AS DECIMAL(18,2)) AS paid_amount,
        CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS picking_completed FROM orders""",
    "rows_sold": """SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS item_id,
        l_suppkey AS salesperson_id, CAST(l_quantity AS INTEGER) AS quantity,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price, CAST(l_shipdate AS DATE) AS ship_date,
        CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS picking_completed,
        CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS picked_quantity,
        CASE WHEN l_linestatus = 'F' THEN l_suppkey END AS picker_id FROM lineitem""",
    "goods": """SELECT p_partkey AS item_id, p_name AS item_name, p_brand AS brand, p_type AS kind,
        p_size AS weight, nullif(p_size % 5, 0) AS outer_quantity,
        CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price FROM part""",
    "staff": """SELECT s_suppkey AS person_id, s_name AS full_name, s_acctbal > 0 AS is_salesperson
        FROM supplier""",
    "stores": """SELECT c_custkey AS customer_id, 'Store (' || n_name || ')' AS customer_name,
        n_regionkey AS region_id FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "stock": """SELECT p_partkey AS item_id, p_name || ' #' || CAST(p_partkey AS VARCHAR) AS item_name,
        p_size AS supplier_id, p_size % 10 AS unit_package_id, p_size % 6 AS outer_package_id,
        nullif(p_size % 5, 0) AS quantity_per_outer, CAST(p_size / 8.0 AS DECIMAL(18,3)) AS typical_weight,
        p_size % 14 + 1 AS lead_time_days, p_type = 'SMALL' AS is_chiller_stock,
        CAST(15 AS DECIMAL(18,3)) AS tax_rate, CAST(p_retailprice AS DECIMAL(18,6)) AS unit_price,
        7 AS last_edited_by FROM part""",
    "lists": """SELECT p_partkey AS item_id,
        p_brand || ',' || p_type || ',' || replace(p_name, ' ', ',') AS data FROM part
        UNION ALL VALUES (-1, 'apple,pear,orange,banana,grape,kiwi'), (-2, 'pineapple,grape,banana,apple'),
        (-3, 'apricot,pear,strawberry,banana'), (-4, 'cherry,watermelon,orange,melon,grape')""",
}


def _with(base: str, body: str, recursive_parts: str = "") -> str:
    """``WITH`` the named base relations, then further ones, then the query."""
    parts = [f"{name} AS ({_BASE[name]})" for name in base.split()]
    if recursive_parts:
        parts.append(recursive_parts)
    return f"WITH {', '.join(parts)} {body}"


def _month(names: list[str], day: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names, 1))
    return f"CASE month({day}) {cases} END"


_YEAR_MONTH = (
    "CAST(year(order_date) AS BIGINT) AS year, CAST(month(order_date) AS BIGINT) AS month"
)
_AMOUNT = "unit_price * quantity"

_MONTHLY = f"""SELECT {_YEAR_MONTH}, CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS average_price,
    CAST(sum({_AMOUNT}) AS DOUBLE) AS total_amount
    FROM deals JOIN rows_sold USING (order_id) GROUP BY year(order_date), month(order_date)"""

# orders before, merged and after the deletion of a month's low-priority ones
_IN_MONTH = "order_date BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'"
_ORDERS_CHANGED = f"""plain AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
        o_orderpriority AS priority, CAST(o_totalprice AS DECIMAL(18,2)) AS paid_amount FROM orders),
    corrected AS (SELECT * REPLACE (CASE WHEN order_id % 14 = 0 THEN DATE '1998-04-15' ELSE order_date END AS order_date,
        CAST(paid_amount + 10 AS DECIMAL(18,2)) AS paid_amount) FROM plain WHERE {_IN_MONTH} AND order_id % 7 = 0),
    copied AS (SELECT * REPLACE (order_id + 1000000000 AS order_id, DATE '1998-05-02' AS order_date)
        FROM plain WHERE {_IN_MONTH} AND order_id % 11 = 0),
    merged AS (SELECT * FROM plain WHERE order_id NOT IN (SELECT order_id FROM corrected)
        UNION ALL SELECT * FROM corrected UNION ALL SELECT * FROM copied),
    kept AS (SELECT * FROM merged WHERE NOT ({_IN_MONTH} AND priority = '5-LOW'))"""


def _order_columns(prefix: str = "", source: str = "") -> str:
    dot = f"{source}." if source else ""
    kinds = {"order_date": "VARCHAR", "paid_amount": "DOUBLE"}
    names = ("order_id", "customer_id", "order_date", "priority", "paid_amount")
    return ", ".join((f"CAST({dot}{n} AS {kinds[n]})" if n in kinds else f"{dot}{n}") + f" AS {prefix}{n}" for n in names)


_NO_ORDER = "NULL, NULL, NULL, NULL, NULL"

_CALENDAR = f"""SELECT o.order_id, strftime(order_date, '%d.%m.%Y') AS dd_mm_year,
    {_month(MONTHS_RU, 'order_date')} AS month_name, CAST(quarter(order_date) AS BIGINT) AS quarter,
    CAST(ceil(month(order_date) / 4.0) AS BIGINT) AS third_of_year, customer_name
    FROM deals o JOIN rows_sold l ON o.order_id = l.order_id
        AND (unit_price > {{price}} OR quantity > {{quantity}}) AND NOT l.picking_completed IS NULL
    JOIN buyers c ON o.customer_id = c.customer_id"""

_SPAN = """span AS (SELECT CAST(year(m) AS BIGINT) AS year, CAST(month(m) AS BIGINT) AS month FROM (
    SELECT unnest(generate_series(DATE '1990-01-01', DATE '2003-12-01', INTERVAL 1 MONTH)) AS m))"""
_MONTH_TOTALS = f"""totals AS (SELECT {_YEAR_MONTH}, sum({_AMOUNT}) AS amount
    FROM deals JOIN rows_sold USING (order_id) GROUP BY ALL)"""
_CAPITALS = "CASE WHEN item_id % 2 = 0 THEN upper(item_name) ELSE item_name END"
_TAGS = "CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END"


def _slow_items(below: int) -> str:
    return f"""SELECT year, month, item_id, item_name, CAST(amount AS DOUBLE) AS total_amount,
        CAST(total_quantity AS BIGINT) AS total_quantity, CAST(first_sale AS VARCHAR) AS first_sale
        FROM (SELECT {_YEAR_MONTH}, item_id, sum({_AMOUNT}) AS amount, sum(quantity) AS total_quantity,
            min(order_date) AS first_sale
            FROM deals JOIN rows_sold USING (order_id) GROUP BY ALL HAVING sum(quantity) < {below})
        JOIN (SELECT item_id, item_name FROM goods) USING (item_id)"""


_IDLE = """SELECT person_id, full_name FROM staff WHERE is_salesperson AND NOT EXISTS (
    SELECT 1 FROM rows_sold JOIN deals USING (order_id)
    WHERE order_date = DATE '1998-07-04' AND salesperson_id = person_id)"""
_LOWEST = """SELECT item_id, item_name, CAST(unit_price AS DOUBLE) AS unit_price FROM goods
    WHERE unit_price = (SELECT min(unit_price) FROM goods)"""
_PAYERS = """SELECT customer_id, customer_name FROM buyers WHERE customer_id IN (
    SELECT customer_id FROM deals ORDER BY paid_amount DESC, order_id LIMIT 5)"""
_TOP_CITIES = """SELECT CAST(cp.city_id AS BIGINT) AS city_id, n_name AS city_name, coalesce(full_name, '--') AS picker FROM (
    SELECT DISTINCT city_id, picker_id
    FROM rows_sold JOIN deals USING (order_id) JOIN buyers USING (customer_id)
    WHERE order_id IN (SELECT order_id FROM rows_sold WHERE item_id IN (
        SELECT item_id FROM (SELECT item_id, rank() OVER (ORDER BY unit_price DESC) AS r FROM goods)
        WHERE r <= 3))) cp
    JOIN nation ON n_nationkey = cp.city_id LEFT JOIN staff ON person_id = picker_id"""

_RUNNING = f"""SELECT order_id AS invoice_id, customer_name, CAST(order_date AS VARCHAR) AS invoice_date,
    CAST(amount AS DOUBLE) AS invoice_amount, CAST(running AS DOUBLE) AS running_amount FROM (
        SELECT *, sum(amount) OVER (ORDER BY last_day(order_date)) AS running FROM (
            SELECT order_id, customer_id, order_date, sum({_AMOUNT}) AS amount
            FROM deals JOIN rows_sold USING (order_id)
            WHERE order_date >= DATE '1998-01-01' GROUP BY ALL)
    ) JOIN buyers USING (customer_id)"""

_BOUGHT = """bought AS (SELECT DISTINCT customer_id, item_id, unit_price, order_date
    FROM deals JOIN rows_sold USING (order_id))"""
_BOUGHT_OUT = """customer_id, customer_name, item_id, CAST(unit_price AS DOUBLE) AS unit_price,
    CAST(order_date AS VARCHAR) AS invoice_date"""

# the customer table after each change; keys of equal names count from the highest one
_CHANGES = """newest AS (SELECT * FROM buyers ORDER BY customer_id DESC LIMIT 5),
    added AS (SELECT (SELECT max(customer_id) FROM buyers) + row_number() OVER (ORDER BY customer_id)
        AS customer_id, 'TEST_' || customer_name AS customer_name, city_id, segment, credit_limit FROM newest),
    t1 AS (SELECT * FROM buyers UNION ALL SELECT * FROM added),
    t2 AS (SELECT * FROM t1 WHERE customer_id NOT IN (SELECT customer_id FROM t1
        WHERE customer_name ILIKE 'Test%' ORDER BY customer_id LIMIT 1)),
    t3 AS (SELECT customer_id, CASE WHEN customer_id IN (SELECT customer_id FROM t2
        WHERE customer_name ILIKE 'Test%' ORDER BY customer_id LIMIT 1) THEN '2Test' ELSE customer_name END
        AS customer_name, city_id, segment, credit_limit FROM t2),
    t4 AS (SELECT * FROM t3 WHERE NOT lower(customer_name) = '2test'),
    s1 AS (SELECT * FROM t3 ORDER BY customer_id DESC LIMIT 4),
    s2 AS (SELECT * FROM s1 WHERE customer_id NOT IN (SELECT customer_id FROM s1
        WHERE customer_name ILIKE 'Test%' ORDER BY customer_id LIMIT 2)),
    s3 AS (SELECT customer_id, CASE WHEN customer_id IN (SELECT customer_id FROM s2
        WHERE customer_name ILIKE 'Test%' ORDER BY customer_id LIMIT 1) THEN 'Test obn' ELSE customer_name END
        AS customer_name, city_id, segment, credit_limit FROM s2),
    fresh AS (SELECT (SELECT max(customer_id) FROM t4) + row_number() OVER (ORDER BY s3.customer_id)
        AS customer_id, customer_name, city_id, segment, credit_limit
        FROM s3 WHERE customer_id NOT IN (SELECT customer_id FROM t4))"""
_CUSTOMER = """customer_id, customer_name, CAST(city_id AS BIGINT) AS city_id, segment,
    CAST(credit_limit AS DOUBLE) AS credit_limit"""


def _logged(prefix: str, relation: str, name: str | None = None) -> str:
    name = name or f"{relation}.customer_name"
    return f"""{relation}.customer_id AS {prefix}_customer_id, {name} AS {prefix}_customer_name,
        CAST({relation}.city_id AS BIGINT) AS {prefix}_city_id, {relation}.segment AS {prefix}_segment,
        CAST({relation}.credit_limit AS DOUBLE) AS {prefix}_credit_limit"""


_STOCK_INTS = ["supplier_id", "unit_package_id", "outer_package_id", "quantity_per_outer", "lead_time_days"]
_STOCK_TYPES = {
    **{c: "BIGINT" for c in _STOCK_INTS},
    "typical_weight": "DOUBLE",
    "tax_rate": "DOUBLE",
    "unit_price": "DOUBLE",
    "is_chiller_stock": "BOOLEAN",
}


def _stock(relation: str, prefix: str = "") -> str:
    return ", ".join(
        f"CAST({relation}.{c} AS {t}) AS {prefix}{c}" for c, t in _STOCK_TYPES.items()
    )


_STOCK_PLAIN = f"SELECT item_name, {_stock('stock')} FROM stock"
_INCOMING = """incoming AS (SELECT * REPLACE (
        CASE WHEN supplier_id = 13 THEN 'new ' || item_name ELSE item_name END AS item_name,
        CAST(unit_price * 2 AS DECIMAL(18,6)) AS unit_price) FROM stock),
    fresh AS (SELECT (SELECT max(item_id) FROM stock) + row_number() OVER (ORDER BY item_name)
        AS item_id, incoming.* EXCLUDE (item_id) FROM incoming
        WHERE item_name NOT IN (SELECT item_name FROM stock))"""

_TOTALS = f"""totals AS (SELECT customer_id, sum({_AMOUNT}) AS total
    FROM deals JOIN rows_sold USING (order_id) GROUP BY customer_id)"""
_CUSTOMER_TOTALS = """SELECT customer_id, customer_name, CAST(total AS DOUBLE) AS total
    FROM buyers LEFT JOIN totals USING (customer_id)"""


def _sorted_list(separator: str) -> str:
    parts = (
        "list_transform(list_sort(list_transform(string_split(data, ','), "
        "lambda x: {'k': lower(x), 'v': x})), lambda x: x.v)"
    )
    return f"SELECT item_id, data, array_to_string({parts}, '{separator}') || '{separator}' AS sorted FROM lists"


def _pivot(key: str, values: list[str], source: str) -> str:
    cells = ", ".join(f"count(*) FILTER (WHERE {key} = '{v}') AS \"{v}\"" for v in values)
    return f"""SELECT strftime(date_trunc('month', order_date), '%d.%m.%Y') AS invoice_month, {cells}
        FROM {source} GROUP BY date_trunc('month', order_date)"""


_SHOP = """services AS (SELECT p_partkey AS id_service, p_name AS name_service,
        CASE WHEN p_size = 50 THEN repeat(p_type, 40) WHEN p_size <> 49 THEN p_type END AS description_service,
        CAST(CAST(p_retailprice AS DECIMAL(19,2)) - 901 AS DECIMAL(19,2)) AS price_service FROM part),
    sold AS (SELECT * FROM lineitem UNION ALL SELECT * REPLACE (l_partkey + 1000000000 AS l_partkey) FROM lineitem
        WHERE l_orderkey % 100 = 0 AND l_linenumber = 1),
    sales AS (SELECT l_orderkey AS id_sales, l_partkey AS id_service, o_custkey AS id_client,
        CAST(l_quantity AS INTEGER) AS quantity,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS date_created,
        l_shipdate - INTERVAL 30 DAY AS expected_date, l_suppkey AS id_employee
        FROM sold JOIN orders ON l_orderkey = o_orderkey),
    client AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 40 = 0 THEN 'client ' || (c_custkey - 1)
            ELSE 'Client ' || c_custkey END AS username,
        CASE WHEN c_acctbal < 0 THEN '8-000' ELSE lpad(CAST(c_custkey AS VARCHAR), 11, '7') END AS phone,
        CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name || '@example.org' END AS email FROM customer),
    employee AS (SELECT s_suppkey AS id, s_name AS username,
        CASE WHEN s_acctbal < 0 THEN '8-000' ELSE lpad(CAST(s_suppkey AS VARCHAR), 11, '7') END AS phone,
        s_nationkey % 7 AS skill FROM supplier),
    skill AS (SELECT r_regionkey AS id FROM region)"""


# the sales after a month of them was changed, and the services still offered
_SALES_CHANGED = """changed AS (
        SELECT * EXCLUDE (inside) REPLACE (
            CASE WHEN inside AND quantity > 25 THEN date_created - INTERVAL 1 DAY ELSE expected_date END AS expected_date,
            CASE WHEN inside AND quantity > 25 THEN id_client + 1000000000 ELSE id_client END AS id_client)
        FROM (SELECT *, coalesce(CAST(date_created AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-03-31', false) AS inside FROM sales)
        WHERE NOT (inside AND id_employee % 3 = 0)),
    offered AS (SELECT * FROM services WHERE id_service % 50 <> 3)"""


def _violation(table: str, rule: str, key: str, detail: str, source: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{rule}' AS rule, CAST({key} AS VARCHAR) AS row_key,
        CAST({detail} AS VARCHAR) AS detail FROM {source}"""


def _repeats(table: str, rule: str, key: str, source: str | None = None) -> str:
    return _violation(table, rule, key, "count(*)", f"{source or table} GROUP BY {key} HAVING count(*) > 1 OR {key} IS NULL")


def _orphans(table: str, key: str, column: str, parent: str, parent_key: str, rows: str | None = None) -> str:
    rows = rows or table
    source = f"""{rows} WHERE {column} IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM {parent} WHERE {parent}.{parent_key} = {rows}.{column})"""
    return _violation(table, f"foreign_key_{column}", key, column, source)


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _names_repeat(table: str, rule: str, key: str) -> str:
    return _violation(table, rule, f"min({key})", "count(*)", f"{table} GROUP BY lower({key}) HAVING count(*) > 1")


_PHONE = "NOT (length(phone) = 11 AND regexp_full_match(phone, '[0-9]*'))"

ORACLE: dict[str, str] = {
    "item_name_search": _with(
        "goods",
        "SELECT item_id, item_name FROM goods WHERE item_name ILIKE '%RING%' OR item_name ILIKE 'Small%'",
    ),
    "suppliers_without_orders": """SELECT s_suppkey AS supplier_id, s_name AS supplier_name
        FROM (SELECT s_suppkey, s_name FROM supplier UNION ALL
            SELECT s_suppkey + 1000000000, s_name || ' (new)' FROM supplier WHERE s_suppkey % 10 = 0)
        LEFT JOIN (SELECT DISTINCT l_suppkey FROM lineitem) p ON s_suppkey = l_suppkey
        WHERE l_suppkey IS NULL""",
    "order_calendar": _with("buyers deals rows_sold", _CALENDAR.format(price=90000, quantity=45)),
    "order_calendar_page": _with(
        "buyers deals rows_sold",
        _CALENDAR.format(price=100, quantity=20)
        + " ORDER BY quarter, third_of_year, order_date, o.order_id LIMIT 100 OFFSET 1000",
    ),
    "purchase_delivery": """SELECT r_name AS method_name, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS expected_date,
        s_name AS supplier_name, c_name AS contact_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN lineitem ON s_suppkey = l_suppkey AND l_linestatus = 'F'
            AND CAST(l_shipdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-01-31'
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN region ON n_regionkey = r_regionkey AND r_name IN ('ASIA', 'EUROPE')""",
    "latest_sales": _with(
        "buyers deals rows_sold staff",
        """SELECT order_id AS invoice_id, CAST(order_date AS VARCHAR) AS invoice_date, customer_name, full_name
        FROM rows_sold JOIN deals USING (order_id) JOIN buyers USING (customer_id)
        JOIN staff ON person_id = salesperson_id
        ORDER BY order_date DESC, order_id, line_number, salesperson_id LIMIT 10""",
    ),
    "buyers_of_item": _with(
        "buyers deals rows_sold goods",
        f"""SELECT customer_id, customer_name, segment, min({_CAPITALS}) AS item_name
        FROM deals JOIN rows_sold USING (order_id) JOIN goods USING (item_id) JOIN buyers USING (customer_id)
        WHERE lower(item_name) = 'blue bolt' GROUP BY customer_id, customer_name, segment""",
    ),
    "monthly_sales": _with("deals rows_sold", _MONTHLY),
    "monthly_sales_bucketed": _with("deals rows_sold", _MONTHLY),
    "running_total_bucketed": _with("buyers deals rows_sold", _RUNNING),
    "item_quantities_by_month": _with(
        "deals rows_sold",
        f"""SELECT item_id, CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum({_AMOUNT}) AS DOUBLE) AS total_amount
        FROM deals JOIN rows_sold USING (order_id)
        WHERE order_date BETWEEN DATE '1998-03-10' AND DATE '1998-04-09' GROUP BY item_id""",
    ),
    "quarter_sales_by_month": _with(
        "deals rows_sold",
        f"""SELECT {_YEAR_MONTH}, CAST(sum({_AMOUNT}) AS DOUBLE) AS total_amount, count(*) AS lines
        FROM deals JOIN rows_sold USING (order_id) WHERE quarter(order_date) = 3
        GROUP BY year(order_date), month(order_date)""",
    ),
    "big_months": _with(
        "deals rows_sold",
        f"""SELECT {_YEAR_MONTH}, CAST(sum({_AMOUNT}) AS DOUBLE) AS total_amount
        FROM deals JOIN rows_sold USING (order_id) GROUP BY year(order_date), month(order_date)
        HAVING sum({_AMOUNT}) > 1050000000""",
    ),
    "big_months_zero_filled": _with(
        "deals rows_sold",
        """SELECT year, month, CAST(amount AS DOUBLE) AS total_amount FROM totals WHERE amount > 1050000000
        UNION ALL SELECT year, month, CAST(0 AS DOUBLE) FROM span
        WHERE NOT EXISTS (SELECT 1 FROM totals t WHERE t.year = span.year AND t.month = span.month)""",
        f"{_SPAN}, {_MONTH_TOTALS}",
    ),
    "slow_items_by_month": _with("deals rows_sold goods", _slow_items(5)),
    "slow_items_by_month_zero_filled": _with(
        "deals rows_sold goods",
        f"""{_slow_items(5)}
        UNION ALL SELECT year, month, NULL, NULL, CAST(0 AS DOUBLE), CAST(0 AS BIGINT), NULL FROM span
        WHERE NOT EXISTS (SELECT 1 FROM totals t WHERE t.year = span.year AND t.month = span.month)""",
        f"{_SPAN}, {_MONTH_TOTALS}",
    ),
    "idle_salespeople_exists": _with("staff deals rows_sold", _IDLE),
    "idle_salespeople_left_join": _with("staff deals rows_sold", _IDLE),
    "min_price_items": _with("goods", _LOWEST),
    "min_price_join": _with("goods", _LOWEST),
    "min_price_items_sql": _with("goods", _LOWEST),
    "min_price_one": _with("goods", _LOWEST + " ORDER BY item_id LIMIT 1"),
    "top_payers_in": _with("buyers deals", _PAYERS),
    "top_payers_cte": _with("buyers deals", _PAYERS),
    "top_item_cities_nested": _with("buyers deals rows_sold goods staff", _TOP_CITIES),
    "top_item_cities_cte": _with("buyers deals rows_sold goods staff", _TOP_CITIES),
    "large_invoices_picked": _with(
        "deals rows_sold staff",
        f"""SELECT order_id AS invoice_id, CAST(order_date AS VARCHAR) AS invoice_date,
        (SELECT full_name FROM staff WHERE person_id = t.person) AS salesperson_name,
        CAST(amount AS DOUBLE) AS total_amount,
        CASE WHEN picking_completed IS NOT NULL THEN CAST(picked AS DOUBLE) END AS picked_amount
        FROM deals JOIN (SELECT order_id, sum({_AMOUNT}) AS amount, min(salesperson_id) AS person,
            sum(unit_price * picked_quantity) AS picked
            FROM rows_sold GROUP BY order_id HAVING sum({_AMOUNT}) > 10000000) t USING (order_id)""",
    ),
    "running_total_self_join": _with("buyers deals rows_sold", _RUNNING),
    "running_total_by_month": _with("buyers deals rows_sold", _RUNNING),
    "top2_items_per_month": _with(
        "deals rows_sold goods",
        f"""SELECT CAST(CAST(month_end AS DATE) AS VARCHAR) AS month_end, CAST(quantity AS BIGINT) AS quantity, item_name
        FROM (SELECT *, row_number() OVER (PARTITION BY month_end ORDER BY quantity DESC, folded) AS r FROM (
            SELECT last_day(order_date) AS month_end, lower(item_name) AS folded, min({_CAPITALS}) AS item_name,
                sum(quantity) AS quantity
            FROM deals JOIN rows_sold USING (order_id) JOIN (SELECT item_id, item_name FROM goods) USING (item_id)
            WHERE order_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
            GROUP BY last_day(order_date), lower(item_name)))
        WHERE r <= 2""",
    ),
    "item_window_profile": _with(
        "goods",
        """SELECT item_id, item_name, brand, CAST(unit_price AS DOUBLE) AS unit_price,
        row_number() OVER (PARTITION BY lower(left(item_name, 1)) ORDER BY lower(item_name), item_name, item_id) AS row_in_letter,
        count(outer_quantity) OVER () AS stock,
        count(outer_quantity) OVER (PARTITION BY lower(left(item_name, 1))) AS letter_stock,
        lead(item_id) OVER (ORDER BY lower(item_name), item_name, item_id) AS next_item_id,
        lag(item_id) OVER (ORDER BY lower(item_name), item_name, item_id) AS previous_item_id,
        lag(item_name, 2, 'No items') OVER (ORDER BY lower(item_name), item_name, item_id) AS item_name_two_before,
        ntile(30) OVER (ORDER BY weight, item_id) AS weight_group FROM goods""",
    ),
    "last_customer_per_salesperson": _with(
        "buyers deals rows_sold staff",
        f"""SELECT person_id, full_name, customer_id, customer_name, CAST(order_date AS VARCHAR) AS invoice_date,
        CAST(invoice_amount AS DOUBLE) AS invoice_amount FROM (
            SELECT salesperson_id, order_date, customer_id, sum({_AMOUNT}) OVER (PARTITION BY order_id) AS invoice_amount,
            row_number() OVER (PARTITION BY salesperson_id ORDER BY order_date DESC, order_id DESC) AS r
            FROM rows_sold JOIN deals USING (order_id))
        JOIN buyers USING (customer_id) JOIN staff ON person_id = salesperson_id WHERE r = 1""",
    ),
    "dearest_items_dense_rank": _with(
        "buyers deals rows_sold",
        f"""SELECT DISTINCT {_BOUGHT_OUT} FROM (
            SELECT *, dense_rank() OVER (PARTITION BY customer_id ORDER BY unit_price DESC NULLS LAST) AS r FROM bought)
        JOIN buyers USING (customer_id) WHERE r < 3""",
        _BOUGHT,
    ),
    "dearest_items_apply": _with(
        "buyers deals rows_sold",
        f"""SELECT DISTINCT {_BOUGHT_OUT} FROM bought JOIN buyers USING (customer_id)
        WHERE EXISTS (SELECT 1 FROM ranked r WHERE r.customer_id = bought.customer_id
            AND r.item_id = bought.item_id AND r.r <= 2)""",
        _BOUGHT
        + """, ranked AS (SELECT *, rank() OVER (PARTITION BY customer_id ORDER BY unit_price DESC NULLS LAST) AS r
            FROM (SELECT DISTINCT customer_id, item_id, unit_price FROM bought))""",
    ),
    "pivot_customers_by_month": _with(
        "deals stores",
        _pivot(
            "place",
            ["NATION_2", "NATION_7", "NATION_22", "NATION_12", "NATION_17"],
            """(SELECT order_date, substr(customer_name, instr(customer_name, '(') + 1,
                length(customer_name) - instr(customer_name, '(') - 1) AS place
                FROM deals JOIN stores USING (customer_id) WHERE region_id = 2)""",
        ),
    ),
    "pivot_dynamic": _with(
        "buyers deals",
        _pivot(
            "segment",
            ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
            "(SELECT * FROM deals JOIN buyers USING (customer_id))",
        ),
    ),
    "pivot_dynamic_sql": _with(
        "buyers deals",
        _pivot(
            "segment",
            ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
            "(SELECT * FROM deals JOIN buyers USING (customer_id))",
        ),
    ),
    "pivot_column_list": _with(
        "buyers deals",
        """SELECT string_agg(name, ', ' ORDER BY lower(name)) AS column_list FROM (
            SELECT min(CASE WHEN customer_id % 2 = 0 THEN lower(segment) ELSE segment END) AS name
            FROM buyers JOIN deals USING (customer_id) GROUP BY lower(segment))""",
    ),
    "text_in_parentheses": _with(
        "buyers stores",
        """SELECT customer_id, customer_name, substr(customer_name, instr(customer_name, '(') + 1,
            length(customer_name) - instr(customer_name, '(') - 1) AS place FROM (
            SELECT customer_id, customer_name FROM stores UNION ALL SELECT customer_id, customer_name FROM buyers)""",
    ),
    "unpivot_addresses": _with(
        "goods",
        """SELECT item_name AS customer_name, brand AS address_line FROM goods
            WHERE item_name ILIKE '%Ring%' AND brand IS NOT NULL
        UNION ALL SELECT item_name, kind FROM goods WHERE item_name ILIKE '%Ring%' AND nullif(kind, 'PROMO') IS NOT NULL""",
    ),
    "unpivot_codes": _with(
        "buyers",
        """SELECT customer_id, customer_name, segment AS code FROM buyers
        UNION ALL SELECT customer_id, customer_name, CAST(city_id AS VARCHAR) FROM buyers""",
    ),
    "date_parts": _with(
        "deals",
        f"""SELECT CAST(d AS VARCHAR) AS order_date, CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month,
        CAST(quarter(d) AS BIGINT) AS quarter, CAST(ceil(month(d) / 4.0) AS BIGINT) AS third_of_year,
        monthname(d) AS month_name_en, {_month(MONTHS_RU, 'd')} AS month_name_ru,
        day(d) || ' ' || {_month(MONTHS_RU_OF, 'd')} || ' ' || year(d) || ' г.' AS long_date_ru,
        dayname(d) || ', ' || monthname(d) || ' ' || day(d) || ', ' || year(d) AS long_date_en,
        strftime(d, '%d.%m.%Y') AS dotted_date,
        CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_start,
        CAST(last_day(d) AS VARCHAR) AS month_end
        FROM (SELECT DISTINCT order_date AS d FROM deals)""",
    ),
    "insert_generated_key": _with("buyers", f"SELECT {_CUSTOMER} FROM t1", _CHANGES),
    "delete_top": _with("buyers", f"SELECT {_CUSTOMER} FROM t2", _CHANGES),
    "update_top": _with("buyers", f"SELECT {_CUSTOMER} FROM t3", _CHANGES),
    "delete_where": _with("buyers", f"SELECT {_CUSTOMER} FROM t4", _CHANGES),
    "merge_customers": _with(
        "buyers",
        f"""SELECT {_CUSTOMER} FROM (
            SELECT t4.customer_id, CASE WHEN s3.customer_id IS NOT NULL THEN s3.customer_name
                ELSE t4.customer_name END AS customer_name, t4.city_id, t4.segment, t4.credit_limit
            FROM t4 LEFT JOIN s3 ON t4.customer_id = s3.customer_id
            UNION ALL SELECT * FROM fresh)""",
        _CHANGES,
    ),
    "merge_change_log": _with(
        "buyers",
        f"""SELECT {_logged('deleted', 't4')}, 'UPDATE' AS action, {_logged('inserted', 't4', 's3.customer_name')}
        FROM t4 JOIN s3 ON t4.customer_id = s3.customer_id
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 'INSERT', {_logged('inserted', 'fresh')} FROM fresh""",
        _CHANGES,
    ),
    "orders_changed_by_month": f"WITH {_ORDERS_CHANGED} SELECT {_order_columns()} FROM kept",
    "orders_changed_log": f"""WITH {_ORDERS_CHANGED}
        SELECT {_order_columns('deleted_', 'p')}, 'UPDATE' AS action, {_order_columns('inserted_', 'c')}
        FROM plain p JOIN corrected c USING (order_id)
        UNION ALL SELECT {_NO_ORDER}, 'INSERT', {_order_columns()} FROM copied
        UNION ALL SELECT {_order_columns()}, 'DELETE', {_NO_ORDER} FROM merged WHERE {_IN_MONTH} AND priority = '5-LOW'""",
    "order_totals_kept": f"""WITH {_ORDERS_CHANGED}
        SELECT CAST(month AS VARCHAR) AS month, orders, CAST(paid AS DOUBLE) AS paid_amount,
            CAST(sum(paid) OVER (ORDER BY month) AS DOUBLE) AS running_amount
        FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS orders, sum(paid_amount) AS paid
            FROM kept GROUP BY ALL)""",
    "catalog_table_cycle": _with(
        "buyers",
        f"""SELECT customer_id, customer_name FROM buyers UNION ALL
        SELECT (SELECT max(customer_id) FROM buyers) + row_number() OVER (ORDER BY customer_id), 'TEST_' || customer_name FROM newest""",
        "newest AS (SELECT * FROM buyers ORDER BY customer_id DESC LIMIT 5)",
    ),
    "bulk_round_trip": _with("buyers", "SELECT customer_id, customer_name FROM buyers"),
    "bulk_load_split": _with("buyers", "SELECT customer_id, customer_name FROM buyers"),
    "bulk_load_rejects": _with(
        "buyers",
        """SELECT 'not a valid row' AS reason, 'no. ' || customer_id || '@' || customer_name AS record
        FROM buyers WHERE customer_id % 10 = 3
        UNION ALL SELECT 'quote left open', customer_id || '@"' || customer_name FROM buyers WHERE customer_id % 10 = 5
        UNION ALL SELECT 'not a valid row', CAST(customer_id AS VARCHAR) FROM buyers WHERE customer_id % 10 = 7""",
    ),
    "xml_items_source": _with("stock", _STOCK_PLAIN),
    "xml_items_shred": _with("stock", _STOCK_PLAIN),
    "xml_items_split": _with("stock", _STOCK_PLAIN),
    "xml_load_rejects": _with(
        "stock",
        """SELECT 'not a valid record' AS reason, '<Item Name="' || item_name || '"><UnitPrice>'
            || CASE WHEN item_id % 10 = 3 THEN 'soon</UnitPrice>' ELSE CAST(unit_price AS VARCHAR) || '</Price>' END
            || '</Item>' AS record
        FROM stock WHERE item_id % 10 IN (3, 7)""",
    ),
    "xml_export_round_trip": _with("stock", _STOCK_PLAIN),
    "xml_items_merge": _with(
        "stock",
        f"""SELECT item_id, item_name, {_stock('m')}, CAST(last_edited_by AS BIGINT) AS last_edited_by FROM (
            SELECT s.item_id, s.item_name, {", ".join(
                f"CASE WHEN i.item_id IS NOT NULL THEN i.{c} ELSE s.{c} END AS {c}" for c in _STOCK_TYPES)},
                s.last_edited_by FROM stock s LEFT JOIN incoming i ON s.item_name = i.item_name
            UNION ALL SELECT item_id, item_name, {", ".join(_STOCK_TYPES)}, 1 FROM fresh) m""",
        _INCOMING,
    ),
    "xml_items_merge_log": _with(
        "stock",
        f"""SELECT s.item_id AS deleted_item_id, s.item_name AS deleted_item_name, {_stock('s', 'deleted_')},
            CAST(s.last_edited_by AS BIGINT) AS deleted_last_edited_by, 'UPDATE' AS action,
            s.item_id AS inserted_item_id, s.item_name AS inserted_item_name, {_stock('i', 'inserted_')},
            CAST(s.last_edited_by AS BIGINT) AS inserted_last_edited_by
        FROM stock s JOIN incoming i ON s.item_name = i.item_name
        UNION ALL SELECT NULL, NULL, {", ".join("NULL" for _ in _STOCK_TYPES)}, NULL, 'INSERT',
            item_id, item_name, {_stock('fresh', 'inserted_')}, CAST(1 AS BIGINT) FROM fresh""",
        _INCOMING,
    ),
    "json_fields": f"""SELECT p_partkey AS item_id, p_name AS item_name, p_type AS country,
        string_split({_TAGS}, ' ')[1] AS first_tag, string_split({_TAGS}, ' ')[2] AS second_tag,
        CAST(NULL AS VARCHAR) AS tags_value FROM part""",
    "json_tag_search": f"""SELECT item_id, item_name,  '["' || replace(spelt, ' ', '","') || '"]' AS tags_json,
        replace(spelt, ' ', ',') AS tags FROM (
            SELECT p_partkey AS item_id, p_name AS item_name, {_TAGS} AS spelt,
                unnest(string_split({_TAGS}, ' ')) AS tag FROM part)
        WHERE lower(tag) = 'ring'""",
    "best_customer": _with(
        "deals rows_sold",
        f"""SELECT customer_id FROM deals WHERE order_id = (SELECT order_id FROM rows_sold
            GROUP BY order_id ORDER BY sum({_AMOUNT}) DESC, order_id LIMIT 1)""",
    ),
    "customer_total_param": _with(
        "deals rows_sold",
        f"""SELECT CAST(sum({_AMOUNT}) AS DOUBLE) AS total
        FROM deals JOIN rows_sold USING (order_id) WHERE customer_id = 9""",
    ),
    "customer_total_int": _with(
        "buyers deals rows_sold",
        "SELECT customer_id, CAST(trunc(total) AS BIGINT) AS total FROM buyers LEFT JOIN totals USING (customer_id)",
        _TOTALS,
    ),
    "customer_totals_left_join": _with("buyers deals rows_sold", _CUSTOMER_TOTALS, _TOTALS),
    "customer_totals_lateral": _with("buyers deals rows_sold", _CUSTOMER_TOTALS, _TOTALS),
    "sort_list": _with("lists", _sorted_list(",")),
    "sort_list_spaced": _with("lists", _sorted_list(" ")),
    "dq_keys": f"WITH {_SHOP} "
    + _union(
        [
            _repeats("services", "primary_key", "id_service"),
            _repeats("sales", "primary_key", "id_sales"),
            _repeats("client", "primary_key", "id"),
            _repeats("employee", "primary_key", "id"),
            _repeats("skill", "primary_key", "id"),
            _names_repeat("services", "unique_name_service", "name_service"),
            _names_repeat("client", "unique_username", "username"),
            _names_repeat("employee", "unique_username", "username"),
        ]
    ),
    "dq_foreign_keys": f"WITH {_SHOP} "
    + _union(
        [
            _orphans("sales", "id_sales", "id_service", "services", "id_service"),
            _orphans("sales", "id_sales", "id_client", "client", "id"),
            _orphans("sales", "id_sales", "id_employee", "employee", "id"),
            _orphans("employee", "id", "skill", "skill", "id"),
        ]
    ),
    "dq_checks": f"WITH {_SHOP} "
    + _union(
        [
            _violation("services", "check_price_service", "id_service", "price_service", "services WHERE price_service < 0"),
            _violation(
                "services", "not_null_description_service", "id_service", "NULL", "services WHERE description_service IS NULL"
            ),
            _violation(
                "services", "max_length_description_service", "id_service", "length(description_service)",
                "services WHERE length(description_service) > 100",
            ),
            _violation("sales", "check_expected_date", "id_sales", "expected_date", "sales WHERE expected_date < date_created"),
            _violation("client", "check_phone", "id", "phone", f"client WHERE {_PHONE}"),
            _violation("client", "not_null_email", "id", "NULL", "client WHERE email IS NULL"),
            _violation("employee", "check_phone", "id", "phone", f"employee WHERE {_PHONE}"),
            _violation("skill", "check_id", "id", "id", "skill WHERE id NOT IN (1, 2, 3)"),
        ]
    ),
    "dq_sales_kept": f"WITH {_SHOP}, {_SALES_CHANGED} "
    + _union(
        [
            _violation("sales", "check_expected_date", "id_sales", "expected_date", "changed WHERE expected_date < date_created"),
            _repeats("sales", "primary_key", "id_sales", "changed"),
            _orphans("sales", "id_sales", "id_service", "offered", "id_service", "changed"),
            _orphans("sales", "id_sales", "id_client", "client", "id", "changed"),
            _orphans("sales", "id_sales", "id_employee", "employee", "id", "changed"),
        ]
    ),
    "dq_defaults": f"""WITH {_SHOP} SELECT id_sales, id_service, id_client, CAST(quantity AS BIGINT) AS quantity,
        CAST(date_created AS VARCHAR) AS date_created, CAST(expected_date AS VARCHAR) AS expected_date,
        id_employee, date_created IS NULL AS defaulted FROM sales""",
}
# the same rows by another way of reading the documents
ORACLE["json_fields_variant"] = ORACLE["json_fields"]
ORACLE["json_tag_search_variant"] = ORACLE["json_tag_search"]
