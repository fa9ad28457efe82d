"""Oracle statements: every registered query once more, as plain SQL over the driver's tables.

Written from the definitions, not from the library: joins of separate sums, unpartitioned windows and repeated
scans are fine here, so that the two sides share no approach.
"""

from __future__ import annotations

def _key(prefix: str, number: str, width: int) -> str:
    """A padded key; longer numbers are not cut."""
    digits = f"CAST({number} AS VARCHAR)"
    return f"'{prefix}' || repeat('0', greatest({width} - length({digits}), 0)) || {digits}"


def _broken(number: str, lost: str, blank: str) -> str:
    return f"(CASE WHEN {blank} THEN NULL WHEN {lost} THEN {number} + 100000000 ELSE {number} END)"


_LINE_CUSTOMER = _key("C", _broken("o_custkey", "l_orderkey % 307 = 5", "l_orderkey % 1009 = 5"), 6)
_LINE_MATERIAL = _key("MAT-", _broken("l_partkey", "l_orderkey % 211 = 7", "l_orderkey % 1013 = 6"), 6)

# The planning tables, derived from the star schema.
SOURCES = f"""
material_master AS (
  SELECT {_key("MAT-", "p_partkey", 6)} AS Material_ID, p_name AS Material_Description,
         p_brand AS GPL_Code, p_type AS GPL_Name, {_key("S", "(p_partkey % 25)", 2)} AS Primary_Site,
         n_name AS Site_Name, r_name AS Site_Region, p_type AS Application_Segment,
         CASE WHEN p_size <= 10 THEN 'New' WHEN p_size <= 40 THEN 'Active' ELSE 'Phase-Out' END AS Lifecycle,
         CAST(p_size * 2 + 10 AS INTEGER) AS Lead_Time_Days, CAST(p_retailprice AS DECIMAL(18,2)) AS Unit_Price_USD
  FROM part JOIN nation ON n_nationkey = p_partkey % 25 JOIN region ON r_regionkey = n_regionkey
),
customer_master AS (
  SELECT {_key("C", "c_custkey", 6)} AS Customer_ID FROM customer
),
order_lines AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, {_LINE_CUSTOMER} AS Customer_ID,
         {_LINE_MATERIAL} AS Material_ID, l_quantity, l_orderkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
history_lines AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 1031 <> 9 THEN order_month END AS order_month) FROM order_lines
  WHERE order_month < DATE '2001-01-01'
),
actuals AS (
  SELECT order_month AS Demand_Month, Customer_ID, Material_ID,
         CASE WHEN l_orderkey % 997 = 3 THEN NULL WHEN l_orderkey % 991 = 4 THEN -CAST(l_quantity AS BIGINT)
              ELSE CAST(l_quantity AS BIGINT) END AS Actual_Demand_Units
  FROM history_lines
  UNION ALL
  SELECT order_month, Customer_ID, Material_ID, CAST(l_quantity AS BIGINT) FROM history_lines
  WHERE l_orderkey % 101 = 0 AND l_orderkey % 997 <> 3 AND l_orderkey % 991 <> 4
),
forecast_raw AS (
  SELECT order_month AS Forecast_Month, Customer_ID, Material_ID,
         CAST(sum(l_quantity) AS BIGINT) AS Current_Forecast_Units,
         CAST(sum(l_quantity - (l_orderkey % 3)) AS BIGINT) AS Customer_Demand_Units,
         CAST(sum(l_quantity - 2 + (l_orderkey % 5)) AS BIGINT) AS Prior_Cycle_Forecast_Units
  FROM order_lines WHERE order_month >= DATE '2001-01-01'
  GROUP BY order_month, Customer_ID, Material_ID
),
inventory AS (
  SELECT DATE '2000-12-31' AS Snapshot_Date,
         {_key("MAT-", _broken("p_partkey", "p_partkey % 151 = 11", "FALSE"), 6)} AS Material_ID,
         CASE WHEN p_partkey % 157 <> 13 THEN {_key("S", "(p_partkey % 25)", 2)} END AS Site_ID,
         CAST((p_partkey * 37) % 101 AS BIGINT) AS On_Hand_Units,
         CAST(CASE WHEN p_partkey % 10 = 0 THEN 5 ELSE 0 END AS BIGINT) AS Quality_Hold_Units,
         CAST((p_partkey * 37) % 101 - CASE WHEN p_partkey % 10 = 0 THEN 5 ELSE 0 END AS BIGINT) AS Available_Inventory_Units,
         CAST(p_size AS BIGINT) AS Safety_Stock_Units
  FROM part
),
deliveries AS (
  SELECT {_key("MAT-", "l_partkey", 6)} AS Material_ID, {_key("S", "(l_suppkey % 5)", 2)} AS Site_ID, l_quantity, l_shipdate
  FROM lineitem
),
multi_site_inventory AS (
  SELECT Snapshot_Date, Material_ID, Site_ID, CAST(sum(l_quantity) AS BIGINT) % 41 AS Available_Inventory_Units,
         CAST(10 AS BIGINT) AS Safety_Stock_Units
  FROM deliveries JOIN (VALUES (DATE '2000-12-01'), (DATE '2000-12-31')) AS d(Snapshot_Date) ON l_shipdate <= Snapshot_Date
  WHERE Site_ID <> 'S04' OR Snapshot_Date < DATE '2000-12-31'
  GROUP BY Snapshot_Date, Material_ID, Site_ID
),
last_counts AS (
  SELECT * FROM multi_site_inventory m WHERE Snapshot_Date = (SELECT max(Snapshot_Date) FROM multi_site_inventory n
    WHERE n.Material_ID = m.Material_ID AND n.Site_ID = m.Site_ID)
),
supply_raw AS (
  SELECT 'SUP-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS Supply_ID,
         {_key("MAT-", _broken("l_partkey", "l_orderkey % 223 = 3", "l_orderkey % 1021 = 8"), 6)} AS Material_ID,
         CASE WHEN l_orderkey % 1033 <> 1 THEN {_key("S", "(l_partkey % 25)", 2)} END AS Site_ID,
         CASE WHEN l_orderkey % 1039 <> 2 THEN CAST(date_trunc('month', l_shipdate) AS DATE) END AS Receipt_Month,
         CAST(l_quantity AS BIGINT) AS Planned_Supply_Units,
         CASE WHEN l_orderkey % 23 = 0 THEN NULL WHEN l_returnflag = 'N' THEN 'Confirmed'
              WHEN l_returnflag = 'A' THEN 'Planned' ELSE 'At Risk' END AS Supply_Status,
         CASE WHEN l_orderkey % 31 = 0 THEN NULL WHEN l_linestatus = 'O' THEN 'Production' ELSE 'Purchase' END AS Supply_Type
  FROM lineitem
)"""

# The analysis chain.
CHAIN = """,
forecast AS (
  SELECT Forecast_Month AS Month, Material_ID, CAST(sum(Current_Forecast_Units) AS BIGINT) AS Forecast_Units
  FROM forecast_raw GROUP BY Forecast_Month, Material_ID
),
supply AS (
  SELECT Receipt_Month AS Month, Material_ID,
         CAST(sum(Planned_Supply_Units) FILTER (Supply_Status = 'Confirmed') AS BIGINT) AS c,
         CAST(sum(Planned_Supply_Units) FILTER (Supply_Status = 'Planned') AS BIGINT) AS p,
         CAST(sum(Planned_Supply_Units) FILTER (Supply_Status = 'At Risk') AS BIGINT) AS r,
         CAST(sum(Planned_Supply_Units) FILTER (Supply_Status IS NULL) AS BIGINT) AS u
  FROM supply_raw GROUP BY Receipt_Month, Material_ID
),
all_balance AS (
  SELECT forecast.Month AS Month, forecast.Material_ID, Forecast_Units, coalesce(c, 0) AS Confirmed_Supply,
         coalesce(p, 0) AS Planned_Supply, coalesce(r, 0) AS At_Risk_Supply, coalesce(u, 0) AS Unknown_Supply
  FROM forecast LEFT JOIN supply ON forecast.Month = supply.Month AND forecast.Material_ID = supply.Material_ID
),
balance AS (SELECT * FROM all_balance WHERE Month >= DATE '2001-01-01' AND Month < DATE '2001-07-01'),
projection AS (
  SELECT b.Month AS Month, b.Material_ID, i.Site_ID, i.Available_Inventory_Units AS Starting_Inventory, i.Safety_Stock_Units,
         Forecast_Units, Confirmed_Supply, Planned_Supply, At_Risk_Supply, Unknown_Supply,
         CAST(i.Available_Inventory_Units + sum(Confirmed_Supply - Forecast_Units) OVER w AS BIGINT) AS Projected_Inventory,
         CAST(i.Available_Inventory_Units + sum(Confirmed_Supply + Planned_Supply - Forecast_Units) OVER w AS BIGINT)
           AS Projected_Inventory_With_Planned,
         CAST(i.Available_Inventory_Units + sum(Confirmed_Supply + Planned_Supply + At_Risk_Supply - Forecast_Units) OVER w AS BIGINT)
           AS Projected_Inventory_With_At_Risk
  FROM balance b LEFT JOIN inventory i ON b.Material_ID = i.Material_ID
  WINDOW w AS (PARTITION BY b.Material_ID, i.Site_ID ORDER BY b.Month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
analysis AS (
  SELECT Month, Material_ID, Site_ID, Starting_Inventory, Safety_Stock_Units, Forecast_Units, Confirmed_Supply, Planned_Supply,
         At_Risk_Supply, Unknown_Supply, Projected_Inventory,
         CAST(CASE WHEN Projected_Inventory < 0 THEN 1 ELSE 0 END AS INTEGER) AS Stockout_Risk_Flag
  FROM projection
),
first_month AS (
  SELECT Material_ID, min(Month) AS First_Stockout_Month FROM analysis WHERE Stockout_Risk_Flag = 1 GROUP BY Material_ID
),
priority AS (
  SELECT Material_ID, Site_ID, min(Month) AS First_Stockout_Month,
         min(Projected_Inventory_With_Planned) AS Worst_Projected_Inventory,
         CAST(CASE WHEN Material_ID IN (SELECT Material_ID FROM projection WHERE Projected_Inventory_With_At_Risk < 0 AND Material_ID IS NOT NULL)
              THEN 1 ELSE 0 END AS INTEGER) AS Critical_Stockout_Flag
  FROM projection WHERE Projected_Inventory_With_Planned < 0 GROUP BY Material_ID, Site_ID
),
prioritised AS (
  SELECT *, CASE WHEN Critical_Stockout_Flag = 1 THEN 'Critical Stockout' ELSE 'Stockout' END AS Stockout_Status FROM priority
),
severity AS (
  SELECT Material_ID, Site_ID, Stockout_Status, First_Stockout_Month,
         abs(Worst_Projected_Inventory) AS Projected_Shortfall_Units
  FROM prioritised
),
stockouts AS (
  SELECT s.Material_ID, Site_ID, Stockout_Status, First_Stockout_Month, Projected_Shortfall_Units AS Stockout_Units,
         Material_Description, GPL_Code, GPL_Name, Primary_Site, Site_Name, Site_Region, Application_Segment, Lifecycle,
         Lead_Time_Days, Unit_Price_USD, CAST(round(Projected_Shortfall_Units * Unit_Price_USD, 2) AS DECIMAL(18,2)) AS Stockout_Value_USD,
         {band} AS Lead_Time_Band
  FROM severity s LEFT JOIN material_master m ON s.Material_ID = m.Material_ID
),
critical AS (SELECT DISTINCT Material_ID FROM stockouts WHERE Stockout_Status = 'Critical Stockout'),
coverage AS (
  SELECT Material_ID, Site_ID, min(Projected_Inventory_With_At_Risk) AS Lowest_Projected_Inventory,
         CAST(sum(Forecast_Units) AS BIGINT) AS Six_Month_Forecast, CAST(sum(Confirmed_Supply) AS BIGINT) AS Confirmed_Supply,
         CAST(sum(Planned_Supply) AS BIGINT) AS Planned_Supply, CAST(sum(At_Risk_Supply) AS BIGINT) AS At_Risk_Supply,
         CAST(greatest(0, -coalesce(min(Projected_Inventory_With_At_Risk), 0)) AS BIGINT) AS Remaining_Shortfall_Units
  FROM projection WHERE Material_ID IN (SELECT Material_ID FROM critical) GROUP BY Material_ID, Site_ID
),
pareto_sums AS (
  SELECT Material_ID, Site_ID, Remaining_Shortfall_Units,
         CAST(sum(Remaining_Shortfall_Units) OVER (ORDER BY Remaining_Shortfall_Units DESC, Material_ID, Site_ID NULLS FIRST
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS Cumulative_Shortfall_Units,
         CAST(sum(Remaining_Shortfall_Units) OVER () AS BIGINT) AS Total_Shortfall_Units
  FROM coverage
),
pareto AS (
  SELECT Material_ID, Site_ID, Remaining_Shortfall_Units,
         round(Remaining_Shortfall_Units / nullif(Total_Shortfall_Units, 0) * 100, 1) AS Shortfall_Share_Pct, Cumulative_Shortfall_Units,
         round(Cumulative_Shortfall_Units / nullif(Total_Shortfall_Units, 0) * 100, 1) AS Cumulative_Shortfall_Pct, Total_Shortfall_Units
  FROM pareto_sums
),
report AS (
  SELECT s.* EXCLUDE (Lead_Time_Band), coalesce(c.Remaining_Shortfall_Units, 0) AS Remaining_Shortfall_Units
  FROM stockouts s LEFT JOIN coverage c ON s.Material_ID = c.Material_ID AND s.Site_ID IS NOT DISTINCT FROM c.Site_ID
),
site_stock AS (
  SELECT Material_ID, Site_ID, Available_Inventory_Units AS a, Safety_Stock_Units AS s FROM last_counts
  UNION ALL
  SELECT DISTINCT Material_ID, Site_ID, 0, 0 FROM supply_raw r
  WHERE Site_ID IS NOT NULL AND Receipt_Month >= DATE '2001-01-01' AND Receipt_Month < DATE '2001-07-01'
    AND Material_ID IN (SELECT Material_ID FROM last_counts)
    AND NOT EXISTS (SELECT 1 FROM last_counts l WHERE l.Material_ID = r.Material_ID AND l.Site_ID = r.Site_ID)
),
weights AS (
  SELECT *, CASE WHEN sum(greatest(a, 0)) OVER m > 0 THEN greatest(a, 0)
                 WHEN row_number() OVER o = 1 THEN 1 ELSE 0 END AS w, first(Site_ID) OVER o AS first_site
  FROM site_stock WINDOW m AS (PARTITION BY Material_ID), o AS (PARTITION BY Material_ID ORDER BY Site_ID)
),
shares AS (
  SELECT *, CAST(sum(w) OVER (PARTITION BY Material_ID ORDER BY Site_ID) AS BIGINT) AS upto,
         CAST(sum(w) OVER (PARTITION BY Material_ID) AS BIGINT) AS whole FROM weights
),
site_forecast AS (
  SELECT f.Month, f.Material_ID, Site_ID, CASE WHEN whole IS NULL THEN Forecast_Units
         ELSE (Forecast_Units * upto) // whole - (Forecast_Units * (upto - w)) // whole END AS Forecast_Units
  FROM forecast f LEFT JOIN shares s ON s.Material_ID = f.Material_ID
  WHERE Month >= DATE '2001-01-01' AND Month < DATE '2001-07-01'
),
site_supply AS (
  SELECT Receipt_Month AS Month, r.Material_ID, CASE WHEN f.Material_ID IS NOT NULL THEN coalesce(r.Site_ID, f.first_site) END AS Site_ID,
         sum(Planned_Supply_Units) FILTER (Supply_Status = 'Confirmed') AS c,
         sum(Planned_Supply_Units) FILTER (Supply_Status = 'Planned') AS p,
         sum(Planned_Supply_Units) FILTER (Supply_Status = 'At Risk') AS r,
         sum(Planned_Supply_Units) FILTER (Supply_Status IS NULL) AS u
  FROM supply_raw r LEFT JOIN (SELECT DISTINCT Material_ID, first_site FROM weights) f ON f.Material_ID = r.Material_ID
  GROUP BY ALL
),
site_projection AS (
  SELECT f.Month, f.Material_ID, f.Site_ID, t.a AS Starting_Inventory, t.s AS Safety_Stock_Units, f.Forecast_Units,
         CAST(coalesce(c, 0) AS BIGINT) AS Confirmed_Supply, CAST(coalesce(p, 0) AS BIGINT) AS Planned_Supply,
         CAST(coalesce(r, 0) AS BIGINT) AS At_Risk_Supply, CAST(coalesce(u, 0) AS BIGINT) AS Unknown_Supply
  FROM site_forecast f
  LEFT JOIN site_supply s ON s.Month = f.Month AND s.Material_ID = f.Material_ID AND s.Site_ID IS NOT DISTINCT FROM f.Site_ID
  LEFT JOIN site_stock t ON t.Material_ID = f.Material_ID AND t.Site_ID IS NOT DISTINCT FROM f.Site_ID
),
site_scenarios AS (
  SELECT Material_ID, Site_ID,
         Starting_Inventory + sum(Confirmed_Supply + Planned_Supply - Forecast_Units) OVER o AS with_planned,
         Starting_Inventory + sum(Confirmed_Supply + Planned_Supply + At_Risk_Supply - Forecast_Units) OVER o AS with_at_risk
  FROM site_projection
  WINDOW o AS (PARTITION BY Material_ID, Site_ID ORDER BY Month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
site_risk AS (
  SELECT Material_ID, Site_ID, min(with_planned) AS worst, greatest(0, -min(with_at_risk)) AS remaining,
         Material_ID IN (SELECT Material_ID FROM site_scenarios WHERE with_at_risk < 0) AS critical
  FROM site_scenarios GROUP BY Material_ID, Site_ID HAVING min(with_planned) < 0
)"""

# Lead-time bands.
BAND = """CASE WHEN Lead_Time_Days <= 30 THEN '≤30 Days' WHEN Lead_Time_Days <= 60 THEN '31–60 Days'
              WHEN Lead_Time_Days <= 90 THEN '61–90 Days' ELSE '>90 Days' END"""


def _with_sources(statement: str) -> str:
    return f"WITH {SOURCES}\n{statement}"


def _with_chain(statement: str) -> str:
    return f"WITH {SOURCES}{CHAIN.format(band=BAND)}\n{statement}"


def _uniqueness(table: str, relation: str, keys: list[str]) -> str:
    complete = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    columns = ", ".join(keys)
    return f"""SELECT '{table}' AS Table_Name, (SELECT count(*) FROM {relation}) AS Row_Count,
  (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {relation} WHERE {complete})) AS Distinct_Keys,
  (SELECT count(*) FROM (SELECT {columns} FROM {relation} GROUP BY {columns} HAVING count(*) > 1)) AS Duplicate_Groups,
  (SELECT count(*) FROM {relation}) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {relation})) AS Excess_Rows"""


_KEYS = {
    "material_master_raw": ("material_master", ["Material_ID"]),
    "customer_master_raw": ("customer_master", ["Customer_ID"]),
    "demand_actuals_raw": ("actuals", ["Demand_Month", "Customer_ID", "Material_ID"]),
    "demand_forecast_raw": ("forecast_raw", ["Forecast_Month", "Customer_ID", "Material_ID"]),
    "inventory_snapshot_raw": ("inventory", ["Snapshot_Date", "Material_ID", "Site_ID"]),
    "planned_supply_raw": ("supply_raw", ["Supply_ID"]),
}


def _orphans(table: str, relation: str, master: str, key: str) -> str:
    return f"""SELECT '{table}' AS Table_Name, {key} FROM {relation} f
  WHERE NOT EXISTS (SELECT 1 FROM {master} m WHERE m.{key} = f.{key})"""


_MATERIAL_ORPHANS = "\nUNION ALL\n".join(
    _orphans(table, _KEYS[table][0], "material_master", "Material_ID")
    for table in ("demand_actuals_raw", "demand_forecast_raw", "inventory_snapshot_raw", "planned_supply_raw")
)
_CUSTOMER_ORPHANS = "\nUNION ALL\n".join(
    _orphans(table, _KEYS[table][0], "customer_master", "Customer_ID") for table in ("demand_actuals_raw", "demand_forecast_raw")
)


def _check(table: str, check: str, relation: str, condition: str = "TRUE") -> str:
    return f"SELECT '{table}' AS Table_Name, '{check}' AS Check_Name, count(*) AS Violations FROM {relation} WHERE {condition}"


def _all_checks() -> str:
    required = {
        "demand_actuals_raw": ["Demand_Month", "Customer_ID", "Material_ID", "Actual_Demand_Units"],
        "demand_forecast_raw": ["Forecast_Month", "Customer_ID", "Material_ID"],
        "inventory_snapshot_raw": ["Snapshot_Date", "Material_ID", "Site_ID", "On_Hand_Units", "Available_Inventory_Units"],
        "planned_supply_raw": [
            "Supply_ID", "Material_ID", "Site_ID", "Receipt_Month", "Planned_Supply_Units", "Supply_Status", "Supply_Type",
        ],
    }
    negative = {
        "demand_actuals_raw": ["Actual_Demand_Units"],
        "inventory_snapshot_raw": ["On_Hand_Units", "Quality_Hold_Units", "Available_Inventory_Units", "Safety_Stock_Units"],
        "planned_supply_raw": ["Planned_Supply_Units"],
    }
    parts = []
    for table, (relation, keys) in _KEYS.items():
        columns = ", ".join(keys)
        parts.append(_check(table, "Rows", relation))
        parts.append(_check(table, "Duplicate_Keys", f"(SELECT {columns} FROM {relation} GROUP BY {columns} HAVING count(*) > 1)"))
        parts += [_check(table, f"Null_{c}", relation, f"{c} IS NULL") for c in required.get(table, [])]
        parts += [_check(table, f"Negative_{c}", relation, f"{c} < 0") for c in negative.get(table, [])]
    parts.append(
        _check("inventory_snapshot_raw", "Available_Inventory_Units_Above_On_Hand_Units", "inventory", "Available_Inventory_Units > On_Hand_Units")
    )
    for table in ("demand_actuals_raw", "demand_forecast_raw", "inventory_snapshot_raw", "planned_supply_raw"):
        parts.append(_check(table, "Orphan_Material_ID", f"({_orphans(table, _KEYS[table][0], 'material_master', 'Material_ID')})"))
    for table in ("demand_actuals_raw", "demand_forecast_raw"):
        parts.append(_check(table, "Orphan_Customer_ID", f"({_orphans(table, _KEYS[table][0], 'customer_master', 'Customer_ID')})"))
    parts.append(
        _check(
            "demand_actuals_raw",
            "Incomplete_History",
            "(SELECT 1 FROM actuals GROUP BY Customer_ID, Material_ID HAVING count(DISTINCT Demand_Month) <> 72)",
        )
    )
    parts.append(
        _check(
            "inventory_snapshot_raw",
            "Multi_Site_Materials",
            "(SELECT 1 FROM inventory GROUP BY Material_ID HAVING count(DISTINCT Site_ID) > 1)",
        )
    )
    return "\nUNION ALL\n".join(parts)


_FLOW = "b.Month AS Month, b.Material_ID, i.Site_ID, i.a AS Starting_Inventory, i.s AS Safety_Stock_Units, " \
    "Forecast_Units, Confirmed_Supply, Planned_Supply, At_Risk_Supply, Unknown_Supply"

_DUPLICATES = """SELECT Demand_Month, Customer_ID, Material_ID, count(*) AS Row_Count,
  count(DISTINCT Actual_Demand_Units) AS Distinct_Demand_Values,
  CASE WHEN count(Actual_Demand_Units) = 0 OR (count(DISTINCT Actual_Demand_Units) = 1 AND count(Actual_Demand_Units) = count(*))
       THEN 'exact' ELSE 'conflicting' END AS Duplicate_Class
  FROM actuals GROUP BY Demand_Month, Customer_ID, Material_ID HAVING count(*) > 1"""

_ANALYSIS = "SELECT * FROM analysis"
_PROJECTION = """SELECT Month, Material_ID, Site_ID, Starting_Inventory, Safety_Stock_Units, Forecast_Units, Confirmed_Supply,
  Planned_Supply, At_Risk_Supply, Unknown_Supply, Projected_Inventory FROM projection"""

_SOURCE_STATEMENTS = {
    "q_key_uniqueness": "\nUNION ALL\n".join(_uniqueness(table, relation, keys) for table, (relation, keys) in _KEYS.items()),
    "q_duplicate_groups": _DUPLICATES,
    "q_duplicate_rows": """SELECT a.* FROM actuals a JOIN (SELECT Demand_Month, Customer_ID, Material_ID FROM actuals
  GROUP BY ALL HAVING count(*) > 1) d ON a.Demand_Month IS NOT DISTINCT FROM d.Demand_Month
  AND a.Customer_ID IS NOT DISTINCT FROM d.Customer_ID AND a.Material_ID IS NOT DISTINCT FROM d.Material_ID""",
    "q_rows_matching": """SELECT * FROM supply_raw WHERE Receipt_Month = DATE '2001-02-01' AND Supply_Status = 'At Risk'
  AND Supply_Type IS NULL""",
    "q_dedupe_exact": "SELECT DISTINCT * FROM actuals",
    "q_dedupe_loss": """SELECT count(*) AS Rows_Before, (SELECT count(*) FROM (SELECT DISTINCT * FROM actuals)) AS Rows_After,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM actuals)) AS Rows_Removed FROM actuals""",
    "q_row_count": "SELECT count(*) AS Row_Count FROM actuals",
    "q_required_fields": """SELECT * FROM supply_raw WHERE Supply_ID IS NULL OR Material_ID IS NULL OR Site_ID IS NULL
  OR Receipt_Month IS NULL OR Planned_Supply_Units IS NULL OR Supply_Status IS NULL OR Supply_Type IS NULL""",
    "q_null_profile": """SELECT count(*) AS Total_Rows, count(*) - count(Supply_ID) AS Null_Supply_ID,
  count(*) - count(Material_ID) AS Null_Material_ID, count(*) - count(Site_ID) AS Null_Site_ID,
  count(*) - count(Receipt_Month) AS Null_Receipt_Month, count(*) - count(Planned_Supply_Units) AS Null_Planned_Supply_Units,
  count(*) - count(Supply_Status) AS Null_Supply_Status, count(*) - count(Supply_Type) AS Null_Supply_Type FROM supply_raw""",
    "q_range_violations": """SELECT *, 'Negative_Available_Inventory_Units' AS Violated_Rules FROM inventory
  WHERE Available_Inventory_Units < 0""",
    "q_rule_counts": """SELECT 'Negative_Actual_Demand_Units' AS Check_Name, count(*) AS Violations FROM actuals
  WHERE Actual_Demand_Units < 0""",
    "q_orphans_material": _MATERIAL_ORPHANS,
    "q_orphans_customer": _CUSTOMER_ORPHANS,
    "q_orphan_rows": """SELECT * FROM actuals a
  WHERE NOT EXISTS (SELECT 1 FROM customer_master c WHERE c.Customer_ID = a.Customer_ID)""",
    "q_orphan_keys": """SELECT Material_ID, count(*) AS Row_Count FROM actuals a
  WHERE NOT EXISTS (SELECT 1 FROM material_master m WHERE m.Material_ID = a.Material_ID) GROUP BY Material_ID""",
    "q_month_coverage": """SELECT 'demand_actuals_raw' AS Table_Name, count(DISTINCT Demand_Month) AS Distinct_Months,
  min(Demand_Month) AS Earliest_Month, max(Demand_Month) AS Latest_Month FROM actuals
UNION ALL SELECT 'demand_forecast_raw', count(DISTINCT Forecast_Month), min(Forecast_Month), max(Forecast_Month) FROM forecast_raw
UNION ALL SELECT 'inventory_snapshot_raw', count(DISTINCT Snapshot_Date), min(Snapshot_Date), max(Snapshot_Date) FROM inventory
UNION ALL SELECT 'planned_supply_raw', count(DISTINCT Receipt_Month), min(Receipt_Month), max(Receipt_Month) FROM supply_raw""",
    "q_distinct_months": "SELECT DISTINCT Demand_Month FROM actuals",
    "q_incomplete_history": """SELECT Customer_ID, Material_ID, count(DISTINCT Demand_Month) AS Distinct_Demand_Month FROM actuals
  GROUP BY Customer_ID, Material_ID HAVING count(DISTINCT Demand_Month) <> 72""",
    "q_pair_count": """SELECT count(DISTINCT (Customer_ID, Material_ID)) FILTER (Customer_ID IS NOT NULL AND Material_ID IS NOT NULL)
  AS Distinct_Count FROM actuals""",
    "q_status_distribution": """SELECT Supply_Status, count(*) AS Row_Count, CAST(sum(Planned_Supply_Units) AS BIGINT) AS Supply_Units
  FROM supply_raw GROUP BY Supply_Status""",
    "q_multi_site": """SELECT Material_ID, count(DISTINCT Site_ID) AS Site_Count FROM multi_site_inventory GROUP BY Material_ID
  HAVING count(DISTINCT Site_ID) > 1""",
    "q_quality_summary": _all_checks(),
}

_CHAIN_STATEMENTS = {
    "q_forecast_by_month": "SELECT * FROM forecast",
    "q_supply_by_status": """SELECT Month, Material_ID, coalesce(c, 0) AS Confirmed_Supply, coalesce(p, 0) AS Planned_Supply,
  coalesce(r, 0) AS At_Risk_Supply, coalesce(u, 0) AS Unknown_Supply FROM supply""",
    "q_balance": "SELECT * FROM all_balance",
    "q_balance_all_months": """SELECT coalesce(f.Month, s.Month) AS Month, coalesce(f.Material_ID, s.Material_ID) AS Material_ID,
  coalesce(Forecast_Units, 0) AS Forecast_Units, coalesce(c, 0) AS Confirmed_Supply, coalesce(p, 0) AS Planned_Supply,
  coalesce(r, 0) AS At_Risk_Supply, coalesce(u, 0) AS Unknown_Supply
  FROM forecast f FULL JOIN supply s ON f.Month = s.Month AND f.Material_ID = s.Material_ID""",
    "q_project_inventory": _PROJECTION,
    "q_project_pooled_sites": f"""SELECT {_FLOW}, CAST(i.a + sum(Confirmed_Supply - Forecast_Units) OVER (PARTITION BY b.Material_ID
  ORDER BY b.Month ROWS UNBOUNDED PRECEDING) AS BIGINT) AS Projected_Inventory
  FROM balance b LEFT JOIN (SELECT Material_ID, CASE WHEN count(*) > 1 THEN 'ALL' ELSE min(Site_ID) END AS Site_ID,
    CAST(sum(Available_Inventory_Units) AS BIGINT) AS a, CAST(sum(Safety_Stock_Units) AS BIGINT) AS s
    FROM last_counts GROUP BY Material_ID) i ON b.Material_ID = i.Material_ID""",
    "q_project_by_site": """SELECT *, CAST(Starting_Inventory + sum(Confirmed_Supply - Forecast_Units) OVER (
  PARTITION BY Material_ID, Site_ID ORDER BY Month ROWS UNBOUNDED PRECEDING) AS BIGINT) AS Projected_Inventory FROM site_projection""",
    "q_kpi_by_site": """SELECT (SELECT count(*) FROM material_master) AS Total_Materials, count(DISTINCT Material_ID) AS Materials_At_Risk,
  count(DISTINCT Material_ID) FILTER (critical) AS Critical_Materials,
  CAST(coalesce(sum(remaining) FILTER (critical), 0) AS BIGINT) AS Critical_Gap_Units,
  CAST(coalesce(sum(round(-worst * Unit_Price_USD, 2)), 0) AS DECIMAL(18,2)) AS Exposure_USD
  FROM site_risk LEFT JOIN material_master USING (Material_ID)""",
    "q_unmatched_supply": """SELECT CAST(count(*) FILTER (keyless) AS BIGINT) AS Keyless_Receipts,
  CAST(coalesce(sum(Planned_Supply_Units) FILTER (keyless), 0) AS BIGINT) AS Keyless_Units,
  CAST(count(*) FILTER (NOT keyless) AS BIGINT) AS Unplanned_Month_Receipts,
  CAST(coalesce(sum(Planned_Supply_Units) FILTER (NOT keyless), 0) AS BIGINT) AS Unplanned_Month_Units
  FROM (SELECT *, Receipt_Month IS NULL OR Material_ID IS NULL AS keyless FROM supply_raw r WHERE NOT EXISTS (
    SELECT 1 FROM forecast f WHERE f.Month = r.Receipt_Month AND f.Material_ID = r.Material_ID))""",
    "q_scenario_counts_safety_stock": """SELECT a AS At_Risk_Confirmed, b AS At_Risk_With_Planned, c AS At_Risk_With_At_Risk,
  a - b AS Mitigated_By_Planned, b - c AS Mitigated_By_At_Risk FROM (
  SELECT count(DISTINCT Material_ID) FILTER (Projected_Inventory < Safety_Stock_Units) AS a,
         count(DISTINCT Material_ID) FILTER (Projected_Inventory_With_Planned < Safety_Stock_Units) AS b,
         count(DISTINCT Material_ID) FILTER (Projected_Inventory_With_At_Risk < Safety_Stock_Units) AS c FROM projection)""",
    "q_stockout_null_profile": """SELECT count(*) AS Total_Rows, count(*) - count(Material_ID) AS Null_Material_ID,
  count(*) - count(Site_ID) AS Null_Site_ID, count(*) - count(Stockout_Status) AS Null_Stockout_Status,
  count(*) - count(First_Stockout_Month) AS Null_First_Stockout_Month, count(*) - count(Stockout_Units) AS Null_Stockout_Units,
  count(*) - count(Unit_Price_USD) AS Null_Unit_Price_USD, count(*) - count(Stockout_Value_USD) AS Null_Stockout_Value_USD
  FROM stockouts""",
    "q_stockout_analysis": _ANALYSIS,
    "q_stockout_material_count": "SELECT count(DISTINCT Material_ID) AS Stockout_Risk_Materials FROM analysis WHERE Projected_Inventory < 0",
    "q_unknown_inventory": """SELECT count(DISTINCT Material_ID) AS Unknown_Inventory_Materials, count(*) AS Unknown_Inventory_Rows
  FROM analysis WHERE Starting_Inventory IS NULL""",
    "q_first_stockout": "SELECT * FROM first_month",
    "q_stockout_timing": 'SELECT First_Stockout_Month, count(*) AS "count" FROM first_month GROUP BY First_Stockout_Month',
    "q_scenario_projection": """SELECT a.*, p.Projected_Inventory_With_Planned, p.Projected_Inventory_With_At_Risk
  FROM analysis a JOIN projection p ON a.Month IS NOT DISTINCT FROM p.Month AND a.Material_ID IS NOT DISTINCT FROM p.Material_ID""",
    "q_scenario_counts": """SELECT a AS At_Risk_Confirmed, b AS At_Risk_With_Planned, c AS At_Risk_With_At_Risk,
  a - b AS Mitigated_By_Planned, b - c AS Mitigated_By_At_Risk FROM (
  SELECT count(DISTINCT Material_ID) FILTER (Projected_Inventory < 0) AS a,
         count(DISTINCT Material_ID) FILTER (Projected_Inventory_With_Planned < 0) AS b,
         count(DISTINCT Material_ID) FILTER (Projected_Inventory_With_At_Risk < 0) AS c FROM projection)""",
    "q_residual_risk": """SELECT Material_ID, Site_ID, min(Projected_Inventory_With_Planned) AS Lowest_Projected_Inventory
  FROM projection WHERE Projected_Inventory_With_Planned < 0 GROUP BY Material_ID, Site_ID""",
    "q_prioritise": "SELECT * FROM prioritised",
    "q_severity": "SELECT * FROM severity",
    "q_valued": "SELECT * EXCLUDE (Lead_Time_Band) FROM stockouts",
    "q_rank_exposure": """SELECT Material_ID, Site_ID, Stockout_Status, Stockout_Units, Stockout_Value_USD, row_number() OVER (
  ORDER BY Stockout_Value_USD DESC NULLS LAST, Material_ID NULLS FIRST, Site_ID NULLS FIRST) AS Rank FROM stockouts""",
    "q_rank_residual_risk": """SELECT *, row_number() OVER (ORDER BY Lowest_Projected_Inventory, Material_ID NULLS FIRST,
  Site_ID NULLS FIRST) AS Rank FROM (SELECT Material_ID, Site_ID, min(Projected_Inventory_With_Planned) AS Lowest_Projected_Inventory
  FROM projection WHERE Projected_Inventory_With_Planned < 0 GROUP BY Material_ID, Site_ID)""",
    "q_rank_priorities": """SELECT *, row_number() OVER (ORDER BY Worst_Projected_Inventory, Material_ID NULLS FIRST,
  Site_ID NULLS FIRST) AS Rank FROM prioritised""",
    "q_rank_supply_coverage": """SELECT *, row_number() OVER (ORDER BY Remaining_Shortfall_Units DESC, Material_ID NULLS FIRST,
  Site_ID NULLS FIRST) AS Rank FROM coverage""",
    "q_status_counts": 'SELECT Stockout_Status, count(*) AS "count" FROM stockouts GROUP BY Stockout_Status',
    "q_lead_time_exposure": """SELECT Lead_Time_Band, Stockout_Status, count(DISTINCT Material_ID) AS Material_Count,
  CAST(round(sum(Stockout_Value_USD), 2) AS DECIMAL(18,2)) AS Stockout_Value_USD FROM stockouts GROUP BY Lead_Time_Band, Stockout_Status""",
    "q_critical_rate": f"""SELECT a.Lead_Time_Band, Total_Materials, coalesce(n, 0) AS Critical_Stockouts,
  round(coalesce(n, 0) / Total_Materials * 100, 1) AS Critical_Stockout_Rate_Pct
  FROM (SELECT {BAND} AS Lead_Time_Band, count(DISTINCT Material_ID) AS Total_Materials FROM material_master GROUP BY 1) a
  LEFT JOIN (SELECT Lead_Time_Band, count(DISTINCT Material_ID) AS n FROM stockouts WHERE Stockout_Status = 'Critical Stockout'
    GROUP BY Lead_Time_Band) b ON a.Lead_Time_Band = b.Lead_Time_Band""",
    "q_demand_signal": """SELECT c.Material_ID, Current_Forecast, Customer_Demand, Prior_Cycle_Forecast,
  Customer_Demand - Current_Forecast AS Customer_Demand_Gap, Current_Forecast - Prior_Cycle_Forecast AS Forecast_Change
  FROM critical c LEFT JOIN (SELECT Material_ID, CAST(sum(Current_Forecast_Units) AS BIGINT) AS Current_Forecast,
    CAST(sum(Customer_Demand_Units) AS BIGINT) AS Customer_Demand, CAST(sum(Prior_Cycle_Forecast_Units) AS BIGINT) AS Prior_Cycle_Forecast
    FROM forecast_raw GROUP BY Material_ID) s ON c.Material_ID = s.Material_ID""",
    "q_forecast_change": """SELECT CASE WHEN Material_ID IN (SELECT Material_ID FROM critical WHERE Material_ID IS NOT NULL) THEN 'Critical Stockout'
    ELSE 'Other Materials' END AS Risk_Group, count(DISTINCT Material_ID) AS Material_Count,
  round(avg(pct), 1) + 0.0 AS Avg_Forecast_Change_Pct, round(quantile_disc(pct, 0.5), 1) + 0.0 AS Median_Forecast_Change_Pct
  FROM (SELECT Material_ID, CASE WHEN sum(Prior_Cycle_Forecast_Units) > 0 THEN
      round(CAST(sum(Current_Forecast_Units) - sum(Prior_Cycle_Forecast_Units) AS BIGINT) / CAST(sum(Prior_Cycle_Forecast_Units) AS BIGINT) * 100, 1) END AS pct
    FROM forecast_raw GROUP BY Material_ID) GROUP BY 1""",
    "q_supply_coverage": "SELECT * FROM coverage",
    "q_pareto": "SELECT * FROM pareto",
    "q_pareto_priority": """SELECT * FROM pareto
  WHERE Cumulative_Shortfall_Units - Remaining_Shortfall_Units < CAST(0.8 AS DOUBLE) * Total_Shortfall_Units""",
    "q_report": "SELECT * FROM report",
    "q_cycle_report": "SELECT *, DATE '2000-12-31' AS Cycle_Date FROM report",
    "q_report_qa": """SELECT count(*) AS Total_Stockout_Materials,
  count(*) FILTER (Stockout_Status = 'Critical Stockout') AS Critical_Stockouts,
  count(*) FILTER (Stockout_Status = 'Stockout') AS Remaining_Stockouts,
  CAST(coalesce(sum(Remaining_Shortfall_Units), 0) AS BIGINT) AS Total_Remaining_Shortfall_Units,
  count(*) FILTER (Material_ID IS NULL) AS Null_Material_IDs, count(*) FILTER (Stockout_Value_USD IS NULL) AS Null_Stockout_Values
  FROM report""",
    "q_kpi": """SELECT (SELECT count(DISTINCT Material_ID) FROM material_master) AS Total_Materials,
  count(DISTINCT Material_ID) AS Materials_At_Risk,
  count(DISTINCT Material_ID) FILTER (Stockout_Status = 'Critical Stockout') AS Critical_Materials,
  CAST(coalesce(sum(Remaining_Shortfall_Units), 0) AS BIGINT) AS Critical_Gap_Units,
  CAST(coalesce(sum(Stockout_Value_USD), 0) AS DECIMAL(18,2)) AS Exposure_USD FROM report""",
    "q_plant_exposure": """SELECT Site_ID, count(DISTINCT Material_ID) AS Materials,
  count(DISTINCT Material_ID) FILTER (Stockout_Status = 'Critical Stockout') AS Critical_Materials,
  CAST(sum(Stockout_Units) AS BIGINT) AS Stockout_Units, CAST(sum(Stockout_Value_USD) AS DECIMAL(18,2)) AS Stockout_Value_USD,
  round(CAST(sum(Stockout_Value_USD) AS DOUBLE) / nullif(CAST((SELECT sum(Stockout_Value_USD) FROM report) AS DOUBLE), 0) * 100, 1)
    AS Value_Share_Pct
  FROM report GROUP BY Site_ID""",
    "q_recovery_timing": """SELECT Material_ID, Site_ID, Stockout_Status, First_Stockout_Month, Lead_Time_Days,
  First_Stockout_Month - Lead_Time_Days AS Recovery_By,
  CAST(date_diff('day', DATE '2000-12-31', First_Stockout_Month - Lead_Time_Days) AS INTEGER) AS Days_To_Act,
  First_Stockout_Month - Lead_Time_Days < DATE '2000-12-31' AS Overdue FROM report""",
}


_SIGNAL_RANK = """SELECT *, row_number() OVER (ORDER BY Customer_Demand_Gap DESC NULLS LAST, Material_ID NULLS FIRST) AS Rank
  FROM ({})"""
_CHAIN_STATEMENTS["q_rank_demand_signal"] = _SIGNAL_RANK.format(_CHAIN_STATEMENTS["q_demand_signal"])
_SOURCE_STATEMENTS["q_rank_multi_site"] = f"""SELECT *, row_number() OVER (ORDER BY Site_Count DESC, Material_ID NULLS FIRST) AS Rank
  FROM ({_SOURCE_STATEMENTS["q_multi_site"]})"""

# All results of a refresh as text: result -> its statement and its columns, in the order of the text.
_REFRESH = {
    "stockout_timing": ("q_stockout_timing", ["First_Stockout_Month", '"count"']),
    "scenario_counts": (
        "q_scenario_counts",
        ["At_Risk_Confirmed", "At_Risk_With_At_Risk", "At_Risk_With_Planned", "Mitigated_By_At_Risk", "Mitigated_By_Planned"],
    ),
    "status_counts": ("q_status_counts", ["Stockout_Status", '"count"']),
    "stockout_null_profile": (
        "q_stockout_null_profile",
        [
            "Null_First_Stockout_Month", "Null_Material_ID", "Null_Site_ID", "Null_Stockout_Status", "Null_Stockout_Units",
            "Null_Stockout_Value_USD", "Null_Unit_Price_USD", "Total_Rows",
        ],
    ),
    "lead_time_exposure": ("q_lead_time_exposure", ["Lead_Time_Band", "Material_Count", "Stockout_Status", "Stockout_Value_USD"]),
    "critical_rate_by_lead_time": (
        "q_critical_rate", ["Critical_Stockout_Rate_Pct", "Critical_Stockouts", "Lead_Time_Band", "Total_Materials"]
    ),
    "demand_signal_gap": (
        "q_demand_signal",
        ["Current_Forecast", "Customer_Demand", "Customer_Demand_Gap", "Forecast_Change", "Material_ID", "Prior_Cycle_Forecast"],
    ),
    "forecast_change_by_group": (
        "q_forecast_change", ["Avg_Forecast_Change_Pct", "Material_Count", "Median_Forecast_Change_Pct", "Risk_Group"]
    ),
    "pareto_priority": (
        "q_pareto_priority",
        [
            "Cumulative_Shortfall_Pct", "Cumulative_Shortfall_Units", "Material_ID", "Remaining_Shortfall_Units",
            "Shortfall_Share_Pct", "Site_ID", "Total_Shortfall_Units",
        ],
    ),
    "report_qa": (
        "q_report_qa",
        [
            "Critical_Stockouts", "Null_Material_IDs", "Null_Stockout_Values", "Remaining_Stockouts", "Total_Remaining_Shortfall_Units",
            "Total_Stockout_Materials",
        ],
    ),
    "kpi_summary": (
        "q_kpi", ["Critical_Gap_Units", "Critical_Materials", "Exposure_USD", "Materials_At_Risk", "Total_Materials"]
    ),
    "plant_exposure": (
        "q_plant_exposure",
        ["Critical_Materials", "Materials", "Site_ID", "Stockout_Units", "Stockout_Value_USD", "Value_Share_Pct"],
    ),
    "recovery_timing": (
        "q_recovery_timing",
        [
            "Days_To_Act", "First_Stockout_Month", "Lead_Time_Days", "Material_ID", "Overdue", "Recovery_By", "Site_ID", "Stockout_Status",
        ],
    ),
}


def _as_text(result: str) -> str:
    statement, columns = _REFRESH[result]
    values = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"SELECT '{result}' AS Result, {values} AS Row_Values FROM ({_CHAIN_STATEMENTS[statement]})"


_CHAIN_STATEMENTS["q_refresh_results"] = "\nUNION ALL\n".join(map(_as_text, _REFRESH))
_CHAIN_STATEMENTS["q_stored_rows"] = """SELECT 'created' AS Sink, (SELECT count(*) FROM (SELECT DISTINCT * FROM actuals)) AS Stored_Rows
UNION ALL SELECT 'replaced', (SELECT count(*) FROM analysis)
UNION ALL SELECT 'overwritten', (SELECT count(*) FROM stockouts)
UNION ALL SELECT 'bucketed', (SELECT count(*) FROM report)"""
_ACTUALS_TEXT = ["Actual_Demand_Units", "Customer_ID", "Demand_Month", "Material_ID"]
_REPORT_TEXT = [
    "Application_Segment", "First_Stockout_Month", "GPL_Code", "GPL_Name", "Lead_Time_Days", "Lifecycle", "Material_Description",
    "Material_ID", "Primary_Site", "Remaining_Shortfall_Units", "Site_ID", "Site_Name", "Site_Region", "Stockout_Status",
    "Stockout_Units", "Stockout_Value_USD", "Unit_Price_USD",
]


def _text_of(columns: list[str]) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)


_CHAIN_STATEMENTS["q_stored_contents"] = f"""SELECT 'created' AS Sink, {_text_of(_ACTUALS_TEXT)} AS Row_Values FROM (SELECT DISTINCT * FROM actuals)
UNION ALL SELECT 'replaced by itself', {_text_of(_REPORT_TEXT)} FROM report WHERE Remaining_Shortfall_Units > 0
UNION ALL SELECT 'other columns', {_text_of(["Material_ID", "Site_ID", "Stockout_Units"])} FROM report"""

_CHAIN_STATEMENTS["q_top_exposure"] = """SELECT * FROM report
  ORDER BY Stockout_Value_USD DESC NULLS LAST, Material_ID NULLS FIRST, Site_ID NULLS FIRST LIMIT 20"""

_SITE = "CASE WHEN Material_ID NOT LIKE '%7' THEN Site_ID END"
_CHAIN_STATEMENTS["q_reporting_table"] = f"""SELECT f.*, coalesce(c.Remaining_Shortfall_Units, 0) AS Remaining_Shortfall_Units
FROM (SELECT * EXCLUDE (Lead_Time_Band) REPLACE ({_SITE} AS Site_ID) FROM stockouts) f
LEFT JOIN (SELECT Material_ID, {_SITE} AS Site_ID, Remaining_Shortfall_Units FROM coverage) c
  ON c.Material_ID = f.Material_ID AND c.Site_ID IS NOT DISTINCT FROM f.Site_ID"""

_CHAIN_STATEMENTS["q_supply_coverage_of_list"] = """SELECT * FROM coverage WHERE Material_ID IN (
  SELECT Material_ID FROM stockouts WHERE Stockout_Status = 'Critical Stockout' AND Lead_Time_Days > 30)"""

# The second column says that the estimate keeps its error bound.
_SOURCE_STATEMENTS["q_sketched_pairs"] = """SELECT CAST(date_trunc('quarter', Demand_Month) AS DATE) AS Quarter,
  count(DISTINCT (Customer_ID, Material_ID)) AS Exact_Distinct, TRUE AS Within_Bound
  FROM actuals WHERE Demand_Month IS NOT NULL AND Customer_ID IS NOT NULL AND Material_ID IS NOT NULL GROUP BY 1
UNION ALL SELECT NULL, count(DISTINCT (Customer_ID, Material_ID)), TRUE
  FROM actuals WHERE Customer_ID IS NOT NULL AND Material_ID IS NOT NULL"""

_SOURCE_STATEMENTS["q_demand_quantiles"] = """SELECT Quarter, max(v) FILTER (r = greatest(ceil(n * 0.5), 1)) AS Median_Demand,
  max(v) FILTER (r = greatest(ceil(n * 0.9), 1)) AS P90_Demand, TRUE AS Within_Bound
  FROM (SELECT CAST(date_trunc('quarter', Demand_Month) AS DATE) AS Quarter, Actual_Demand_Units AS v,
               row_number() OVER (PARTITION BY date_trunc('quarter', Demand_Month) ORDER BY Actual_Demand_Units) AS r,
               count(*) OVER (PARTITION BY date_trunc('quarter', Demand_Month)) AS n
        FROM actuals WHERE Demand_Month IS NOT NULL AND Actual_Demand_Units IS NOT NULL)
  GROUP BY Quarter"""

_SOURCE_STATEMENTS["q_cast_losses"] = """SELECT 'planned_supply_raw' AS Table_Name, 'Receipt_Month' AS Column_Name,
  'date' AS Expected_Type, 'string' AS Actual_Type, count(*) FILTER (Planned_Supply_Units % 7 = 0) AS Unreadable_Rows,
  CAST(0 AS BIGINT) AS Changed_Rows FROM supply_raw
UNION ALL SELECT 'planned_supply_raw', 'Planned_Supply_Units', 'bigint', 'double', CAST(0 AS BIGINT),
  count(*) FILTER (Planned_Supply_Units % 2 <> 0) FROM supply_raw"""
_SOURCE_STATEMENTS["q_schema_violations"] = """SELECT * FROM (VALUES
  ('planned_supply_raw', 'Receipt_Month', 'date', 'string'),
  ('planned_supply_raw', 'Planned_Supply_Units', 'bigint', 'int'),
  ('planned_supply_raw', 'Supply_Status', 'string', NULL)) AS t(Table_Name, Column_Name, Expected_Type, Actual_Type)
  WHERE EXISTS (SELECT 1 FROM supply_raw)"""


def statements() -> dict[str, str]:
    return {
        **{name: _with_sources(statement) for name, statement in _SOURCE_STATEMENTS.items()},
        **{name: _with_chain(statement) for name, statement in _CHAIN_STATEMENTS.items()},
    }
