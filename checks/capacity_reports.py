"""Reference SQL of the capacity reports."""

from __future__ import annotations

from checks import adapters as a
from checks import expected as const
from checks.sqltext import div0, final, qty, values

_DAYS = "days AS (SELECT DATE '1998-01-01' + CAST(i AS INTEGER) AS d FROM range(31) AS r(i))"
_LOC = """loc AS (SELECT CASE WHEN type = 'Warehouse' THEN location_code ELSE lpad(location_code, 10, '0') END AS code,
    plant, can_capacity, end_capacity FROM warehousing_capacity WHERE type <> 'Plant')"""
_STOCK = f"""stock AS (SELECT date_of_analysis AS d, i.plant, storage_location AS sl, customer AS cu, t,
    {qty(div0('stock_at_plant', 'bstrf'))} AS q FROM vw_fct_inventory_aging i
    JOIN mara m ON m.matnr = i.material JOIN marc c ON c.matnr = i.material AND c.werks = i.plant
    JOIN pallets p ON p.g = m.matkl
    WHERE m.mtart = 'FERT' AND status <> 'Stock in Transit' AND storage_location <> '1300')"""
_DUE = f"""due AS (SELECT CAST(try_strptime(tddat, '%Y%m%d') AS DATE) AS d, werks AS plant, auart, kunnr, t,
    {qty(div0('wmeng * 1000', 'n'))} AS q FROM vbep s JOIN vbap l ON l.vbeln = s.vbeln AND l.posnr = s.posnr
    JOIN vbak h ON h.vbeln = s.vbeln JOIN mara m ON m.matnr = l.matnr JOIN pallets p ON p.g = m.matkl
    WHERE abgru = ' ' AND substr(m.matkl, 1, 1) IN ('8', '9')
    AND CAST(try_strptime(tddat, '%Y%m%d') AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-01-31')"""


def _pallets(rows) -> str:
    return f"pallets(g, n, t) AS ({values(rows)})"


def _split(name: str, keys: str, source: str, where: str = "TRUE") -> str:
    return f"""{name} AS (SELECT {keys}, coalesce(sum(CASE WHEN t = 'Cans' THEN q END), 0) AS cans,
        coalesce(sum(CASE WHEN t = 'Ends' THEN q END), 0) AS ends FROM {source} WHERE {where} GROUP BY {keys})"""


def plant_sql() -> str:
    codes = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in const.PLANT_CODES.items())
    outside = "sl NOT IN (SELECT code FROM loc) AND cu NOT IN (SELECT code FROM loc)"
    inside = "sl IN (SELECT code FROM loc) OR cu IN (SELECT code FROM loc)"
    ctes = [
        _pallets(const.PALLETS_PLANT),
        _DAYS,
        _LOC,
        f"""own AS (SELECT CASE location_code {codes} ELSE location_code END AS plant, sum(can_capacity) AS cc,
            sum(end_capacity) AS ec FROM warehousing_capacity WHERE type = 'Plant' GROUP BY 1)""",
        _STOCK,
        _split("sp", "d, plant", "stock", outside),
        _split("sa", "d, plant", "stock", inside),
        _DUE,
        _split("dp", "d, plant", "due", "auart <> 'ZBA3'"),
        _split("da", "d, plant", "due", "auart = 'ZBA3'"),
        f"""made AS (SELECT CAST(try_strptime(dtplan, '%Y%m%d') AS DATE) AS d, z.werks AS plant, z.matkl, t,
            {qty(div0('sum(quantidade) * 1000000', 'n'))} AS q FROM ztbbw_prd_lines z
            JOIN t023t g ON g.matkl = z.matkl AND g.spras = 'P' JOIN t001w w ON w.werks = z.werks
            JOIN pallets p ON p.g = z.matkl
            WHERE ctg_rep = '20' AND z.mandt = '300'
            AND dtcarga = (SELECT max(dtcarga) FROM ztbbw_prd_lines WHERE ctg_rep = '20')
            AND CAST(try_strptime(dtplan, '%Y%m%d') AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-01-31'
            GROUP BY 1, 2, 3, 4, n)""",
        "seen AS (SELECT * FROM made WHERE q > 0)",
        f"means AS (SELECT plant, matkl, t, {qty('CAST(sum(q) AS DOUBLE) / count(q)')} AS m FROM seen GROUP BY 1, 2, 3)",
        """filled AS (SELECT DISTINCT d.d, o.plant, m.t, coalesce(s.q, m.m) AS q FROM days d CROSS JOIN own o
            JOIN means m ON m.plant = o.plant
            LEFT JOIN seen s ON s.d = d.d AND s.plant = o.plant AND s.t = m.t)""",
        _split("mk", "d, plant", "filled"),
        """ext AS (SELECT l.plant, sum(can_capacity) AS cc, sum(end_capacity) AS ec FROM loc l
            JOIN t001k k ON k.bwkey = l.plant GROUP BY 1)""",
    ]

    def r(col: str) -> str:
        return f"round(coalesce({col}, 0), 0)"

    base = ["d.d AS date", "o.plant AS plant", "o.cc AS capacity_quantity_plant_cans", "o.ec AS capacity_quantity_plant_ends"]
    base += ["coalesce(ext.cc, 0) AS capacity_quantity_ag_cans", "coalesce(ext.ec, 0) AS capacity_quantity_ag_ends"]
    for alias, name in (
        ("sp", "stock_quantity_plant"),
        ("sa", "stock_quantity_ag"),
        ("dp", "sales_quantity_plant"),
        ("da", "sales_quantity_ag"),
        ("mk", "production_quantity_plant"),
    ):
        base += [f"{r(f'{alias}.{t}')} AS {name}_{t}" for t in ("cans", "ends")]
    joins = " ".join(f"LEFT JOIN {x} ON {x}.d = d.d AND {x}.plant = o.plant" for x in ("sp", "sa", "dp", "da", "mk"))
    ctes.append(
        f"base AS (SELECT {', '.join(base)} FROM days d CROSS JOIN own o {joins} LEFT JOIN ext ON ext.plant = o.plant)"
    )
    both = [
        f"{n}_cans + {n}_ends AS {n}"
        for n in (
            "capacity_quantity_plant",
            "capacity_quantity_ag",
            "stock_quantity_plant",
            "stock_quantity_ag",
            "sales_quantity_plant",
            "sales_quantity_ag",
            "production_quantity_plant",
        )
    ]
    ctes.append(f"summed AS (SELECT *, {', '.join(both)} FROM base)")
    over = "OVER (PARTITION BY plant ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    run, rates = [], []
    for e in ("_cans", "_ends", ""):
        run.append(f"capacity_quantity_plant{e} + capacity_quantity_ag{e} AS capacity_quantity_total{e}")
        change = f"stock_quantity_plant{e} - sales_quantity_plant{e} + production_quantity_plant{e}"
        run.append(f"sum({change}) {over} AS daily_result_plant{e}")
        run.append(f"sum(stock_quantity_ag{e} - sales_quantity_ag{e}) {over} AS daily_result_ag{e}")
    ctes.append(f"ran AS (SELECT *, {', '.join(run)} FROM summed)")
    totals = ", ".join(
        f"daily_result_plant{e} + daily_result_ag{e} AS daily_result_total{e}" for e in ("_cans", "_ends", "")
    )
    ctes.append(f"done AS (SELECT *, {totals} FROM ran)")
    for w in ("plant", "ag", "total"):
        for e in ("_cans", "_ends", ""):
            rate = div0(f"daily_result_{w}{e}", f"capacity_quantity_{w}{e}")
            rates.append(f"{rate} AS warehouse_ocupation_{w}{e}")
    plain = [m for m in const.PLANT_MEASURES if not m.startswith("warehouse_ocupation")]
    sql = f"WITH {', '.join(ctes)} SELECT date, plant, {', '.join(plain)}, {', '.join(rates)} FROM done"
    return final(a.with_inputs(sql), ["date"], const.PLANT_MEASURES)


def warehouse_sql(matched: bool = False) -> str:
    by_warehouse = " AND sold.kunnr = g.wh" if matched else ""
    ctes = [
        _pallets(const.PALLETS_WAREHOUSE),
        _DAYS,
        _LOC,
        "grid AS (SELECT DISTINCT d, plant, code AS wh FROM days CROSS JOIN loc)",
        _STOCK,
        """keyed AS (SELECT d, plant, sl AS wh, t, q FROM stock UNION ALL SELECT d, plant, cu, t, q FROM stock)""",
        _split("st", "d, plant, wh", "keyed", "wh IN (SELECT code FROM loc) AND wh <> ' '"),
        _DUE,
        _split("sold", "d, plant, kunnr", "due", "auart = 'ZBA3'"),
        """cap AS (SELECT l.plant, code AS wh, sum(can_capacity) AS cc, sum(end_capacity) AS ec FROM loc l
            JOIN t001k k ON k.bwkey = l.plant GROUP BY 1, 2)""",
        f"""base AS (SELECT g.d AS date, g.plant, g.wh AS warehouse, sold.kunnr AS k,
            coalesce(cap.cc, 0) AS capacity_cans, coalesce(cap.ec, 0) AS capacity_ends,
            round(coalesce(st.cans, 0), 0) AS stock_cans, round(coalesce(st.ends, 0), 0) AS stock_ends,
            round(coalesce(sold.cans, 0), 0) AS sales_cans, round(coalesce(sold.ends, 0), 0) AS sales_ends
            FROM grid g LEFT JOIN st ON st.d = g.d AND st.plant = g.plant AND st.wh = g.wh
            LEFT JOIN sold ON sold.d = g.d AND sold.plant = g.plant{by_warehouse}
            LEFT JOIN cap ON cap.plant = g.plant AND cap.wh = g.wh)""",
    ]
    over = (
        "OVER (PARTITION BY plant, warehouse ORDER BY date, k NULLS FIRST "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    both = "(SELECT *, " + ", ".join(f"{w}_cans + {w}_ends AS {w}_all" for w in ("capacity", "stock", "sales")) + " FROM base)"
    cols, rates = [], []
    for s, e in (("cans", "_cans"), ("ends", "_ends"), ("all", "")):
        cols += [f"{w}_{s} AS {w}_quantity_ag_only{e}" for w in ("capacity", "stock", "sales")]
        cols.append(f"sum(stock_{s} - sales_{s}) {over} AS daily_result_ag_only{e}")
        rate = div0(f"daily_result_ag_only{e}", f"capacity_quantity_ag_only{e}")
        rates.append(f"{rate} AS warehouse_ocupation_ag_only{e}")
    ctes.append(f"ran AS (SELECT date, plant, warehouse, {', '.join(cols)} FROM {both} AS b)")
    return final(
        a.with_inputs(f"WITH {', '.join(ctes)} SELECT *, {', '.join(rates)} FROM ran"), ["date"], const.WAREHOUSE_MEASURES
    )


def packaging_sql() -> str:
    sql = f"""WITH packs(material, kind, pp) AS ({values(const.PACKAGING)}),
    used AS (SELECT date_of_analysis AS date, i.material, m.mtart AS material_type, maktx AS material_description, i.plant,
        sum({qty(div0('stock_at_plant', 'CAST(pp AS DECIMAL(5,1))'))}) AS utilization_quantity
        FROM vw_fct_inventory_aging i JOIN mara m ON m.matnr = i.material
        JOIN makt t ON t.matnr = m.matnr AND t.spras = 'P' JOIN packs p ON p.material = m.matnr AND p.kind = m.mtart
        WHERE m.mtart IN ('LEIH', 'VERP') GROUP BY 1, 2, 3, 4, 5)
    SELECT u.*, pallet_capacity + topframe_capacity AS packaging_capacity,
        {div0('utilization_quantity', 'pallet_capacity + topframe_capacity')} AS packaging_utilization
        FROM used u JOIN warehousing_capacity w ON w.type = 'Plant' AND w.plant = u.plant"""
    return final(
        a.with_inputs(sql), ["date"], ["utilization_quantity", "packaging_capacity", "packaging_utilization"]
    )
