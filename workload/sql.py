"""The same tables and queries in plain SQL, written apart from the Spark code.

``CTES`` maps a name to its body; ``with_`` puts the ones a query needs, in
order, in front of it.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def with_(sql: str, extra: dict[str, str] | None = None) -> str:
    """``sql`` preceded by every CTE it refers to, directly or not."""
    bodies = {**CTES, **(extra or {})}
    needed: list[str] = []

    def visit(text: str, above: tuple = ()):
        for name in bodies:
            if name not in needed and name not in above and re.search(rf"\b{name}\b", text):
                visit(bodies[name], (*above, name))
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({bodies[n]})" for n in needed) + "\n" + sql


BEGIN = "TIMESTAMP '2013-01-01 00:00:00'"
OPEN = "TIMESTAMP '2099-12-31 00:00:00'"
FAR = "TIMESTAMP '2038-01-19 03:14:07.999999'"
LOAD_TO = "TIMESTAMP '2018-06-01 00:00:00'"


def _years(member: str, members: str, facts: str, ref: str, moment: str) -> str:
    return f"""
    SELECT m, vf, coalesce(lead(vf) OVER (PARTITION BY m ORDER BY vf), {OPEN}) AS vt, n,
           vf + INTERVAL 1 DAY AS loaded
    FROM (SELECT {member} AS m, {BEGIN} AS vf, 0 AS n FROM {members}
          UNION ALL
          SELECT * FROM (
            SELECT {ref} AS m, min({moment} + INTERVAL 18 YEAR) AS vf, count(*) AS n FROM {facts}
            GROUP BY {ref}, year({moment})) WHERE vf > {BEGIN})
    """


def _cuts(cuts: list[str]) -> str:
    ends = cuts[1:] + [OPEN]
    rows = [f"({i + 1}, {a}, {b}, {a} + INTERVAL 1 DAY)" for i, (a, b) in enumerate(zip(cuts, ends))]
    return f"(VALUES {', '.join(rows)}) AS cuts(version, vf, vt, loaded)"


CTES["customer_years"] = _years("c_custkey", "customer", "orders", "o_custkey", "o_orderdate")
CTES["supplier_years"] = _years("s_suppkey", "supplier", "lineitem", "l_suppkey", "l_shipdate")
CTES["part_years"] = _years("p_partkey", "part", "lineitem", "l_partkey", "l_shipdate")

CTES["x_cities"] = """
    SELECT c_custkey + 1 AS id, c_name AS name, c_nationkey + 1 AS state,
           'POINT (' || (c_nationkey - 12) || '.5 ' || (c_custkey % 90) || '.25)' AS location,
           CAST(c_nationkey - 12 || '.5' AS DOUBLE) AS lon, (c_custkey % 90) + 0.25::DOUBLE AS lat,
           CASE WHEN c_custkey % 7 <> 0 THEN n * 1000 + c_custkey END AS population, vf, vt, loaded
    FROM customer_years JOIN customer ON m = c_custkey
"""
CTES["x_states"] = f"""
    SELECT n_nationkey + 1 AS id, n_name AS name, n_regionkey + 1 AS country,
           'T' || (n_nationkey % 4) || '-' || version AS territory, vf, vt, loaded
    FROM nation, {_cuts([BEGIN, "TIMESTAMP '2016-01-01 00:00:00'"])}
"""
CTES["x_countries"] = f"""
    SELECT r_regionkey + 1 AS id, r_name AS name, 'R' || r_regionkey AS region, 'S' || version AS subregion,
           vf, vt, loaded
    FROM region, {_cuts([BEGIN, "TIMESTAMP '2017-07-01 00:00:00'"])}
"""
CTES["x_customers"] = """
    SELECT c_custkey + 1 AS id, c_name || ' v' || n AS name, c_custkey - c_custkey % 10 + 1 AS bill_to,
           ascii(c_mktsegment) AS category, CASE WHEN c_custkey % 11 <> 0 THEN c_nationkey % 3 + 1 END AS grp,
           c_custkey // 15 + 1 AS contact, c_custkey + 1 AS city, CAST(n + 90000 AS VARCHAR) AS postal, vf, vt, loaded
    FROM customer_years JOIN customer ON m = c_custkey
"""
CTES["x_categories"] = f"""
    SELECT ascii(c_mktsegment) AS id, c_mktsegment || ' v' || version AS name, vf, vt, loaded
    FROM (SELECT DISTINCT c_mktsegment FROM customer),
         {_cuts([BEGIN, "TIMESTAMP '2015-03-01 00:00:00'", "TIMESTAMP '2017-06-15 00:00:00'"])}
"""
CTES["x_groups"] = f"""
    SELECT g AS id, 'Group ' || g || ' v' || version AS name, vf, vt, loaded
    FROM (SELECT DISTINCT c_nationkey % 3 + 1 AS g FROM customer), {_cuts([BEGIN, "TIMESTAMP '2016-02-29 00:00:00'"])}
"""
CTES["x_people"] = f"""
    SELECT s_suppkey + 1 AS id, s_name || ' v' || n AS name, s_name AS preferred, s_suppkey % 3 <> 0 AS employee,
           s_suppkey % 2 = 0 AS seller, vf, vt, loaded
    FROM (SELECT m, vf, vt, n, loaded FROM supplier_years
          UNION ALL
          SELECT m, TIMESTAMP '2014-05-05 00:00:00', TIMESTAMP '2014-05-05 00:00:00', n, loaded
          FROM supplier_years WHERE m % 5 = 0 AND vf = {BEGIN}) JOIN supplier ON m = s_suppkey
"""
CTES["x_colors"] = f"""
    SELECT CAST(substr(p_brand, 7) AS INTEGER) AS id, p_brand || ' v' || version AS name, vf, vt, loaded
    FROM (SELECT DISTINCT p_brand FROM part), {_cuts([BEGIN, "TIMESTAMP '2016-01-01 00:00:00'"])}
"""
CTES["x_packages"] = f"""
    SELECT CAST(substr(p, 1, 1) AS INTEGER) AS id, substr(p, 3) || ' v' || version AS name, vf, vt, loaded
    FROM (SELECT DISTINCT o_orderpriority AS p FROM orders), {_cuts([BEGIN, "TIMESTAMP '2015-07-01 00:00:00'"])}
"""
CTES["x_items"] = """
    SELECT p_partkey + 1 AS id, p_name || ' ' || p_partkey AS name,
           CASE WHEN p_partkey % 6 <> 0 THEN CAST(substr(p_brand, 7) AS INTEGER) END AS color,
           p_size % 5 + 1 AS unit_package, p_partkey % 5 + 1 AS outer_package,
           CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS brand,
           CASE WHEN p_partkey % 9 <> 0 THEN CAST(p_size AS VARCHAR) END AS size,
           p_size AS lead, p_size % 12 + 1 AS per_outer, p_type = 'ECONOMY' AS chilled,
           CASE WHEN p_partkey % 8 = 0 THEN 'B' || p_partkey END AS barcode,
           CAST(CAST(p_retailprice AS DECIMAL(18,2)) + n AS DECIMAL(18,2)) AS price,
           CAST(p_retailprice AS DECIMAL(18,2)) AS retail, CAST(p_size AS DECIMAL(18,3)) AS weight, vf, vt, loaded
    FROM part_years JOIN part ON m = p_partkey
"""
CTES["x_suppliers"] = """
    SELECT s_suppkey + 1 AS id, s_name AS name, s_nationkey % 5 + 1 AS category, s_suppkey + 1 AS contact,
           'REF' || s_suppkey AS ref, n AS days, 'P' || s_nationkey AS postal, vf, vt, loaded
    FROM supplier_years JOIN supplier ON m = s_suppkey
"""
CTES["x_supplier_categories"] = f"""
    SELECT k AS id, 'Category ' || k || ' v' || version AS name, vf, vt, loaded
    FROM (SELECT DISTINCT s_nationkey % 5 + 1 AS k FROM supplier), {_cuts([BEGIN, "TIMESTAMP '2016-06-01 00:00:00'"])}
"""
CTES["x_headers"] = """
    SELECT o_orderkey + 1 AS id, o_custkey + 1 AS customer, o_custkey // 45 * 3 + 2 AS seller,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey // 15 + 1 END AS picker,
           CASE WHEN o_orderstatus = 'P' THEN o_orderkey END AS backorder,
           o_custkey - o_custkey % 10 + 1 AS bill_to, o_orderstatus AS status,
           o_orderdate + INTERVAL 18 YEAR AS moment,
           o_orderdate + INTERVAL 18 YEAR + INTERVAL 12 HOUR AS edited,
           CAST(date_trunc('month', o_orderdate + INTERVAL 18 YEAR) AS TIMESTAMP) + INTERVAL 1 MONTH AS loaded
    FROM orders
"""
CTES["x_lines"] = """
    SELECT l_orderkey + 1 AS doc, l_linenumber AS line,
           CASE WHEN l_partkey % 50 = 0 THEN l_partkey + 10000000 ELSE l_partkey + 1 END AS item,
           'Part ' || l_partkey AS description, l_linenumber % 5 + 1 AS package, CAST(l_quantity AS INTEGER) AS q,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
           CAST(CAST(l_tax AS DECIMAL(18,2)) * 100 AS DECIMAL(18,3)) AS rate,
           CAST(l_tax AS DECIMAL(18,2)) AS tax, CAST(l_discount AS DECIMAL(18,2)) AS discount,
           l_shipdate + INTERVAL 18 YEAR AS moment
    FROM lineitem
"""

# -------------------------------------------------------------------------- dimensions

CTES["city_pieces"] = f"""
    SELECT CAST(c.id AS INTEGER) AS "WWICityID", c.name AS "City", s.name AS "StateProvince", n.name AS "Country",
           n.name AS "Continent", s.territory AS "SalesTerritory", n.region AS "Region", n.subregion AS "Subregion",
           c.location AS "Location", coalesce(c.population, 0) AS "LatestRecordedPopulation",
           greatest(c.vf, s.vf, n.vf) AS "ValidFrom", least(c.vt, s.vt, n.vt) AS "ValidTo", c.lon, c.lat
    FROM x_cities c JOIN x_states s ON c.state = s.id JOIN x_countries n ON s.country = n.id
    WHERE c.loaded <= {LOAD_TO} AND s.loaded <= {LOAD_TO} AND n.loaded <= {LOAD_TO}
      AND least(c.vt, s.vt, n.vt) > greatest(c.vf, s.vf, n.vf)
"""


def _closing(end: str, newest: str, own: str = '"ValidTo"') -> str:
    return f"CASE WHEN {newest} = 1 AND {own} > {LOAD_TO} THEN {FAR} WHEN {newest} = 1 THEN {own} ELSE {end} END"


CTES["dim_city"] = f"""
    SELECT CAST(row_number() OVER (ORDER BY "ValidFrom", "WWICityID", vto) AS INTEGER) AS "CityKey",
           "WWICityID", "City", "StateProvince", "Country", "Continent", "SalesTerritory", "Region", "Subregion",
           "Location", "LatestRecordedPopulation", "ValidFrom", vto AS "ValidTo", 1 AS "LineageKey",
           lon AS "Longitude", lat AS "Latitude"
    FROM (SELECT *, {_closing('"ValidTo"', "newest")} AS vto
          FROM (SELECT *, row_number() OVER (PARTITION BY "WWICityID" ORDER BY "ValidFrom" DESC) AS newest
                FROM city_pieces))
    UNION ALL
    SELECT 0, 0, 'Unknown', 'N/A', 'N/A', 'N/A', 'N/A', 'N/A', 'N/A', NULL, 0, {BEGIN}, {FAR}, 0, 0.0, 0.0
"""


def _feed(number: int, source: str, alias: str, ref: str, extra: str = "") -> str:
    return f"""
    SELECT c.id, c.name, c.postal, c.bill_to, c.category, c.grp, c.contact, {alias}.vf AS moment, {alias}.vt AS raw_to,
           {alias}.loaded, {number} AS feed, {alias}.name AS own
    FROM {source} {alias} JOIN x_customers c ON c.{ref} = {alias}.id AND c.vf <= {alias}.vf AND {alias}.vf < c.vt
    WHERE {alias}.vf <> {BEGIN} {extra}"""


CTES["customer_feeds"] = f"""
    SELECT id, name, postal, bill_to, category, grp, contact, vf AS moment, vt AS raw_to, loaded, 0 AS feed, NULL AS own
    FROM x_customers
    UNION ALL {_feed(1, "x_categories", "cc", "category")}
    UNION ALL {_feed(2, "x_groups", "bg", "grp")}
    UNION ALL {_feed(3, "x_people", "p", "contact", "AND p.vf <> p.vt")}
"""
CTES["customer_starts"] = """
    SELECT f.*, b.name AS bill_name, CASE WHEN f.feed = 1 THEN f.own ELSE k.name END AS category_name,
           CASE WHEN f.feed = 2 THEN f.own ELSE g.name END AS group_name,
           CASE WHEN f.feed = 3 THEN f.own ELSE p.name END AS contact_name
    FROM customer_feeds f
    LEFT JOIN x_customers b ON b.id = f.bill_to AND b.vf <= f.moment AND f.moment < b.vt
    LEFT JOIN x_categories k ON k.id = f.category AND k.vf <= f.moment AND f.moment < k.vt
    LEFT JOIN x_groups g ON g.id = f.grp AND g.vf <= f.moment AND f.moment < g.vt
    LEFT JOIN x_people p ON p.id = f.contact AND p.vf <= f.moment AND f.moment < p.vt
    WHERE b.id IS NOT NULL AND (k.id IS NOT NULL OR f.feed = 1) AND (g.id IS NOT NULL OR f.feed = 2)
      AND (p.id IS NOT NULL OR f.feed = 3)
"""
CTES["customer_spans"] = """
    SELECT *, lead(moment) OVER (PARTITION BY id ORDER BY moment) AS next_at
    FROM (SELECT *, row_number() OVER (PARTITION BY id, moment ORDER BY feed, loaded DESC) AS nth FROM customer_starts)
    WHERE nth = 1
"""
CTES["dim_customer"] = f"""
    SELECT CAST(row_number() OVER (ORDER BY moment, id, vto) AS INTEGER) AS "CustomerKey",
           CAST(id AS INTEGER) AS "WWICustomerID", name AS "Customer", bill_name AS "BillToCustomer",
           category_name AS "Category", group_name AS "BuyingGroup", contact_name AS "PrimaryContact",
           postal AS "PostalCode", moment AS "ValidFrom", vto AS "ValidTo", 0 AS "LineageKey"
    FROM (SELECT *, {_closing("next_at", "newest", "raw_to")} AS vto
          FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY moment DESC) AS newest
                FROM customer_spans WHERE loaded <= {LOAD_TO}))
    UNION ALL
    SELECT 0, 0, 'Unknown', 'N/A', 'N/A', 'N/A', 'N/A', 'N/A', {BEGIN}, {FAR}, 0
"""
CTES["dim_employee"] = f"""
    SELECT CAST(row_number() OVER (ORDER BY vf, id, vto) AS INTEGER) AS "EmployeeKey",
           CAST(id AS INTEGER) AS "WWIEmployeeID", name AS "Employee", preferred AS "PreferredName",
           seller AS "IsSalesperson", CAST(NULL AS VARCHAR) AS "Photo", vf AS "ValidFrom", vto AS "ValidTo",
           3 AS "LineageKey"
    FROM (SELECT *, CASE WHEN vt < {LOAD_TO} THEN vt ELSE {FAR} END AS vto FROM x_people
          WHERE employee AND vf <> vt AND loaded <= {LOAD_TO})
    UNION ALL
    SELECT 0, 0, 'Unknown', 'N/A', false, NULL, {BEGIN}, {FAR}, 0
"""


def _item_dimension(rows: str) -> str:
    return f"""
    SELECT CAST(row_number() OVER (ORDER BY vf, id, vto) AS INTEGER) AS "StockItemKey",
           CAST(id AS INTEGER) AS "WWIStockItemID", name AS "StockItem", coalesce(color_name, 'N/A') AS "Color",
           selling AS "SellingPackage", buying AS "BuyingPackage", coalesce(brand, 'N/A') AS "Brand",
           coalesce(size, 'N/A') AS "Size", lead AS "LeadTimeDays", per_outer AS "QuantityPerOuter",
           chilled AS "IsChillerStock", coalesce(barcode, 'N/A') AS "Barcode", CAST(15 AS DECIMAL(18,3)) AS "TaxRate",
           price AS "UnitPrice", retail AS "RecommendedRetailPrice", weight AS "TypicalWeightPerUnit",
           CAST(NULL AS VARCHAR) AS "Photo", vf AS "ValidFrom", vto AS "ValidTo", 0 AS "LineageKey"
    FROM (SELECT *, coalesce(lead(vf) OVER (PARTITION BY id ORDER BY vf), {FAR}) AS vto FROM {rows})
    UNION ALL
    SELECT 0, 0, 'Unknown', 'N/A', 'N/A', 'N/A', 'N/A', 'N/A', 0, 0, false, 'N/A', 0, 0, 0, 0, NULL, {BEGIN}, {FAR}, 0
    """


CTES["item_names"] = f"""
    SELECT i.*, u.name AS selling, o.name AS buying, c.name AS color_name
    FROM x_items i
    JOIN x_packages u ON u.id = i.unit_package AND u.vf <= i.vf AND i.vf < u.vt
    JOIN x_packages o ON o.id = i.outer_package AND o.vf <= i.vf AND i.vf < o.vt
    LEFT JOIN x_colors c ON c.id = i.color AND c.vf <= i.vf AND i.vf < c.vt
    WHERE i.loaded <= {LOAD_TO}
"""
CTES["item_groups"] = f"""
    SELECT part + 1 AS item, name, vf, vt
    FROM (SELECT p_partkey AS part, k, CASE WHEN k = 1 THEN p_type ELSE 'STANDARD' END AS name, {BEGIN} AS vf,
                 {OPEN} AS vt, max(k) OVER (PARTITION BY p_partkey, CASE WHEN k = 2 AND p_partkey % 2 = 1
                 THEN 1 ELSE 0 END) AS last_k
          FROM part, (VALUES (1), (2)) AS t(k)) WHERE k = last_k
"""
CTES["item_names_by_group"] = """
    SELECT n.* FROM item_names n LEFT JOIN item_groups g ON g.item = n.id AND g.vf <= n.vf AND n.vf < g.vt
"""
CTES["dim_item"] = _item_dimension("item_names")
CTES["dim_item_by_group"] = _item_dimension("item_names_by_group")
CTES["dim_supplier"] = f"""
    SELECT CAST(row_number() OVER (ORDER BY "ValidFrom", "WWISupplierID", "ValidTo", "Category", "PrimaryContact")
                AS INTEGER) AS "SupplierKey", *
    FROM (SELECT DISTINCT CAST(s.id AS INTEGER) AS "WWISupplierID", s.name AS "Supplier", k.name AS "Category",
                 p.name AS "PrimaryContact", s.ref AS "SupplierReference", CAST(s.days AS INTEGER) AS "PaymentDays",
                 s.postal AS "PostalCode", s.vf AS "ValidFrom", s.vt AS "ValidTo", 6 AS "LineageKey"
          FROM x_suppliers s
          JOIN x_supplier_categories k ON s.category = k.id AND s.vf <= k.vt AND k.vf <= s.vt
          JOIN x_people p ON s.contact = p.id AND s.vf <= p.vt AND p.vf <= s.vt
          WHERE s.loaded <= {LOAD_TO} AND k.loaded <= {LOAD_TO} AND p.loaded <= {LOAD_TO})
    UNION ALL
    SELECT 0, 0, 'Unknown', 'N/A', 'N/A', 'N/A', 0, 'N/A', {BEGIN}, {FAR}, 0
"""

# -------------------------------------------------------------------------- facts

CTES["latest_package"] = "SELECT id, arg_max(name, vf) AS name FROM x_packages GROUP BY id"
CTES["latest_customer"] = "SELECT id, arg_max(city, vf) AS city FROM x_customers GROUP BY id"
CTES["latest_item"] = "SELECT id, arg_max(chilled, vf) AS chilled FROM x_items GROUP BY id"


def _lookup(alias: str, dim: str, member: str, ref: str) -> str:
    return (
        f'LEFT JOIN {dim} {alias} ON {alias}."{member}" = b.{ref} AND b.moment > {alias}."ValidFrom" '
        f'AND b.moment <= {alias}."ValidTo"'
    )


def _order_lines(where: str = "") -> str:
    return f"""
    SELECT CAST(h.moment AS DATE) AS order_date, CAST(l.moment AS DATE) AS picked, h.id AS doc, h.backorder, l.description,
           p.name AS package, l.q, l.price, l.rate, CAST(l.q * l.price AS DECIMAL(30,2)) AS net,
           CAST(CAST(round(l.q * l.price * l.rate, 0) AS DECIMAL(36,0)) * 0.01 AS DECIMAL(35,2)) AS tax,
           c.city, h.customer, l.item, h.seller, h.picker, l.line,
           CASE WHEN l.moment > h.edited THEN l.moment ELSE h.edited END AS moment, h.loaded
    FROM x_headers h JOIN x_lines l ON l.doc = h.id JOIN latest_customer c ON c.id = h.customer
    JOIN latest_package p ON p.id = l.package {where}
    """


CTES["order_lines"] = _order_lines()
CTES["order_found"] = f"""
    SELECT b.*, ci."CityKey" AS city_key, cu."CustomerKey" AS customer_key, i."StockItemKey" AS item_key,
           s."EmployeeKey" AS seller_key, k."EmployeeKey" AS picker_key, ci."ValidFrom" AS city_vf,
           cu."ValidFrom" AS customer_vf, i."ValidFrom" AS item_vf, s."ValidFrom" AS seller_vf,
           k."ValidFrom" AS picker_vf, ci."WWICityID" AS city_id, cu."WWICustomerID" AS customer_id,
           i."WWIStockItemID" AS item_id, s."WWIEmployeeID" AS seller_id, k."WWIEmployeeID" AS picker_id
    FROM order_lines b
    {_lookup("ci", "dim_city", "WWICityID", "city")} {_lookup("cu", "dim_customer", "WWICustomerID", "customer")}
    {_lookup("i", "dim_item", "WWIStockItemID", "item")} {_lookup("s", "dim_employee", "WWIEmployeeID", "seller")}
    {_lookup("k", "dim_employee", "WWIEmployeeID", "picker")}
"""
CTES["order_single"] = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc, item_key
                   ORDER BY line, item, q, price, rate, moment) AS nth FROM order_found) WHERE nth = 1
"""


def _running(role: str) -> str:
    return f"min({role}_key) OVER (PARTITION BY {role}_id ORDER BY {role}_vf)"


def order_fact(rows: str, earliest: bool = False) -> str:
    def key(role):
        return f"CAST(coalesce({_running(role) if earliest else role + '_key'}, 0) AS INTEGER)"

    # an unmatched member has no version, so its running minimum must not count
    def guarded(role):
        return f"CASE WHEN {role}_key IS NULL THEN 0 ELSE {key(role)} END"

    return f"""
    SELECT CAST(row_number() OVER (ORDER BY "WWIOrderID", line, item, "Quantity", "UnitPrice", "TaxRate", moment) - 1
                AS INTEGER) AS "OrderKey", * EXCLUDE (line, item, moment)
    FROM (SELECT {guarded("city")} AS "CityKey", {guarded("customer")} AS "CustomerKey",
                 {guarded("item")} AS "StockItemKey", order_date AS "OrderDateKey", picked AS "PickedDateKey",
                 {guarded("seller")} AS "SalespersonKey", {guarded("picker")} AS "PickerKey",
                 CAST(doc AS INTEGER) AS "WWIOrderID", CAST(backorder AS INTEGER) AS "WWIBackorderID",
                 description AS "Description", package AS "Package", q AS "Quantity", price AS "UnitPrice",
                 rate AS "TaxRate", net AS "TotalExcludingTax", tax AS "TaxAmount",
                 CAST(net + tax AS DECIMAL(36,2)) AS "TotalIncludingTax", 9 AS "LineageKey",
                 loaded AS "RawDataLoadDatetime", line, item, moment
          FROM {rows})
    """


CTES["sale_lines"] = """
    SELECT CAST(h.moment AS DATE) AS invoice_date, CASE WHEN h.status <> 'P' THEN CAST(h.moment + INTERVAL 2 DAY AS DATE) END
           AS delivered, h.id AS doc, l.description, p.name AS package, l.q, l.price, l.rate,
           CAST(l.tax * l.q AS DECIMAL(18,2)) AS tax, CAST(l.discount * 10 AS DECIMAL(18,2)) AS profit, i.chilled,
           c.city, h.customer, h.bill_to, l.item, h.seller, l.line,
           CASE WHEN l.moment > h.edited THEN l.moment ELSE h.edited END AS moment, h.loaded
    FROM x_headers h JOIN x_lines l ON l.doc = h.id JOIN latest_item i ON i.id = l.item
    JOIN latest_package p ON p.id = l.package JOIN latest_customer c ON c.id = h.customer
    WHERE h.bill_to IN (SELECT id FROM latest_customer)
"""
CTES["first_city"] = 'SELECT "WWICityID" AS id, min("CityKey") AS city_key FROM dim_city GROUP BY 1'
CTES["sale_found"] = f"""
    SELECT b.*, f.city_key, cu."CustomerKey" AS customer_key, bt."CustomerKey" AS bill_key,
           i."StockItemKey" AS item_key, s."EmployeeKey" AS seller_key, cu."ValidFrom" AS customer_vf,
           bt."ValidFrom" AS bill_vf, i."ValidFrom" AS item_vf, cu."WWICustomerID" AS customer_id,
           bt."WWICustomerID" AS bill_id, i."WWIStockItemID" AS item_id
    FROM sale_lines b LEFT JOIN first_city f ON f.id = b.city
    {_lookup("cu", "dim_customer", "WWICustomerID", "customer")}
    {_lookup("bt", "dim_customer", "WWICustomerID", "bill_to")}
    {_lookup("i", "dim_item", "WWIStockItemID", "item")} {_lookup("s", "dim_employee", "WWIEmployeeID", "seller")}
"""
CTES["sale_single"] = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc, item_key
                   ORDER BY line, item, q, price, rate, moment) AS nth FROM sale_found) WHERE nth = 1
"""


def sale_fact(rows: str, earliest: bool = False) -> str:
    def key(role):
        value = _running(role) if earliest else f"{role}_key"
        return f"CASE WHEN {role}_key IS NULL THEN 0 ELSE CAST({value} AS INTEGER) END"

    return f"""
    SELECT CAST(row_number() OVER (ORDER BY "WWIInvoiceID", line, item, "Quantity", "UnitPrice", "TaxRate", moment) - 1
                AS INTEGER) AS "SaleKey", * EXCLUDE (line, item, moment)
    FROM (SELECT CAST(coalesce(city_key, 0) AS INTEGER) AS "CityKey", {key("customer")} AS "CustomerKey",
                 {key("bill")} AS "BillToCustomerKey", {key("item")} AS "StockItemKey",
                 invoice_date AS "InvoiceDateKey", delivered AS "DeliveryDateKey",
                 CAST(coalesce(seller_key, 0) AS INTEGER) AS "SalespersonKey", CAST(doc AS INTEGER) AS "WWIInvoiceID",
                 description AS "Description", package AS "Package", q AS "Quantity", price AS "UnitPrice",
                 rate AS "TaxRate", CAST(price - tax AS DECIMAL(19,2)) AS "TotalExcludingTax", tax AS "TaxAmount",
                 profit AS "Profit", price AS "TotalIncludingTax", CASE WHEN chilled THEN 0 ELSE q END AS "TotalDryItems",
                 CASE WHEN chilled THEN q ELSE 0 END AS "TotalChillerItems", 11 AS "LineageKey",
                 loaded AS "RawDataLoadDatetime", line, item, moment
          FROM {rows})
    """


CTES["fact_sale"] = sale_fact("sale_found")
CTES["fact_order"] = order_fact("order_found")

# -------------------------------------------------------------------------- user histories

CTES["user_versions"] = f"""
    SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value, ts AS "ValidFrom",
           coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), {OPEN}) AS "ValidTo"
    FROM events WHERE event_type <> 'purchase'
"""


def user_history(kinds: str) -> str:
    return f"""
    SELECT event_id, user_id, event_type, ts AS vf,
           coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), {OPEN}) AS vt
    FROM events WHERE event_type IN ({kinds})
    """


CTES["history_a"] = user_history("'view', 'click'")
CTES["history_b"] = user_history("'signup', 'error'")
