"""Reference SQL of the in-transit reconciliation."""

from __future__ import annotations

from checks import adapters as a
from checks import expected as const
from checks.sqltext import div0, final, in_list

_D = "CAST(try_strptime({}, '%Y%m%d') AS DATE)"
_sign = "CASE WHEN shkzg = 'S' THEN {0} ELSE -{0} END"
_stage = ", ".join(const.STAGE_COLUMNS)

_CTES = f"""WITH raw AS (
    SELECT b.bukrs AS comp_code, kunnr AS customer, lifnr AS vendor, vbund AS trading_partner, zuonr AS assignment,
        hkont AS gl_account, usnam AS user_name, bupla AS business_place, blart AS document_type, waers AS currency,
        b.belnr AS document_number, buzei AS line_item, {_D.format('budat')} AS posting_date,
        {_D.format('bldat')} AS document_date, kostl AS cost_center, {_sign.format('dmbtr')} AS amount_local,
        {_sign.format('dmbe3')} AS amount_third, xblnr AS reference, sgtxt AS text
    FROM bseg b JOIN bkpf h ON h.belnr = b.belnr AND h.bukrs = b.bukrs AND h.gjahr = b.gjahr
    CROSS JOIN (VALUES (1), (2)) AS k(kind)
    WHERE b.bukrs IN {in_list(const.LEDGER_COMPANIES)} AND hkont IN {in_list(const.LEDGER_ACCOUNTS)}
        AND vbund IN {in_list(const.LEDGER_PARTNERS)} AND CAST(budat AS INTEGER) >= 20140101
        AND strftime({_D.format('budat')}, '%Y/%m') <> '2021/07'
        AND CASE kind WHEN 1 THEN augbl = '' ELSE strftime({_D.format('augdt')}, '%Y/%m') = '2021/07' END),
led AS (SELECT *, year(posting_date) || '/' || month(posting_date) AS year_month,
        CAST(DATE '2021-07-15' - document_date AS INTEGER) AS aging,
        CASE WHEN DATE '2021-07-15' - document_date < 30 THEN 'Current' WHEN DATE '2021-07-15' - document_date = 30
        THEN 'Over 30 Days' WHEN DATE '2021-07-15' - document_date BETWEEN 31 AND 59 THEN '31-59 Days'
        WHEN DATE '2021-07-15' - document_date BETWEEN 60 AND 90 THEN '60-90 Days*'
        WHEN DATE '2021-07-15' - document_date > 90 THEN 'Over 91 Days*' ELSE '' END AS aging_category FROM raw),
byref AS (SELECT reference, sum(amount_local) AS total FROM led GROUP BY reference),
docs AS (SELECT led.*, CASE WHEN total = 0 THEN 'ZERO' ELSE 'BALANCE' END AS balance_result FROM led
    JOIN byref ON byref.reference = led.reference WHERE document_type NOT IN {in_list(const.NOTE_TYPES)}),
bytext AS (SELECT text, CASE WHEN abs(sum(amount_local)) <= 0.1 THEN 'ZERO' ELSE 'BALANCE' END AS verdict FROM docs
    WHERE balance_result = 'BALANCE' GROUP BY text),
notes AS (SELECT led.*, document_type IN {in_list(const.DEBIT_TYPES)} AS debit,
    CASE WHEN document_type IN {in_list(const.DEBIT_TYPES)} THEN regexp_replace(reference, '^(DEBIT NOTE |ND )', '')
         ELSE regexp_replace(reference, '^NC ', '') END AS note FROM led
    WHERE document_type IN {in_list(const.DEBIT_TYPES + const.CREDIT_TYPES)}),
bynote AS (SELECT debit, note, CASE WHEN sum(amount_local) = 0 THEN 'ZERO' ELSE 'BALANCE' END AS verdict FROM notes
    GROUP BY debit, note),
stages AS (SELECT {_stage}, balance_result, 'Reference' AS balance_type FROM docs
    UNION ALL SELECT {', '.join('docs.' + c for c in const.STAGE_COLUMNS)}, verdict, 'Text' FROM docs
        JOIN bytext ON bytext.text = docs.text
    UNION ALL SELECT {', '.join('n.' + c for c in const.STAGE_COLUMNS)}, verdict, 'Reference' FROM notes n
        JOIN bynote v ON v.debit = n.debit AND v.note = n.note),
cleared AS (SELECT * FROM stages WHERE balance_result = 'ZERO'),
kept AS (SELECT * FROM stages WHERE balance_result <> 'ZERO' AND comp_code || document_number || year_month NOT IN
    (SELECT comp_code || document_number || year_month FROM cleared)),
open_ledger AS (SELECT {', '.join(const.LEDGER_COLUMNS)} FROM led
    WHERE document_number IN (SELECT document_number FROM kept)),
sold AS (SELECT wwnnf AS nota_fiscal, c.bukrs AS comp_code, c.werks AS plant, kdgrp AS customer_group,
        kndnr AS customer, name1 AS name_1, c.mtart AS material_type, c.matkl AS material_group,
        artnr AS material_number, perde AS period, {_D.format('fkdat')} AS invoice_date, vv211 AS sales_quantity,
        vv211_me AS base_unit, vv100 AS sum_sales, vv140 AS rebate_1, vv210 AS condition_2, vv180 AS unexpected_sd,
        vv170 AS rebate_4, vv100 - vv210 - vv180 - vv170 AS net_revenue, rec_waers AS record_currency
    FROM vbrk k JOIN vbrp p ON p.vbeln = k.vbeln JOIN t001 t ON t.bukrs = k.bukrs JOIN kna1 n ON n.kunnr = k.kunag
    LEFT JOIN knvv v ON v.kunnr = k.kunag AND v.vkorg = k.vkorg AND v.vtweg = k.vtweg AND v.spart = k.spart
    JOIN mara m ON m.matnr = p.matnr
    LEFT JOIN mvke e ON e.vkorg = k.vkorg AND e.vtweg = k.vtweg AND e.matnr = p.matnr
    JOIN ce1bcsa c ON c.rbeln = p.vbeln AND c.rposn = p.posnr AND c.paledger = '01'
    LEFT JOIN t023t g ON g.matkl = m.matkl AND g.spras = 'P' LEFT JOIN makt x ON x.matnr = m.matnr AND x.spras = 'P'
    WHERE k.bukrs IN {in_list(const.SALES_COMPANIES)} AND rec_waers = 'USD' AND CAST(fkdat AS INTEGER) >= 20170601
    AND strftime({_D.format('fkdat')}, '%Y/%m') <> '2021/07' AND vv211 <> 0 AND wwnnf <> ' '),
totals AS (SELECT nota_fiscal, comp_code, plant, customer_group, invoice_date, material_group,
        sum(net_revenue) AS net_revenue, sum(sales_quantity) AS quantity, sum(sum_sales + rebate_1) AS sales_and_rebate
    FROM sold GROUP BY 1, 2, 3, 4, 5, 6 HAVING sum(net_revenue) <> 0),
pairs AS (SELECT t.*, o.document_number, o.document_date, o.reference, o.amount_third,
        sales_and_rebate - amount_third AS difference FROM totals t JOIN open_ledger o ON o.reference = t.nota_fiscal),
matched AS (SELECT * FROM pairs WHERE invoice_date = document_date AND difference BETWEEN -0.1 AND 0.1),
base AS (SELECT {', '.join('o.' + c for c in const.LEDGER_COLUMNS)}, m.customer_group, m.material_group,
        CASE WHEN coalesce(m.material_group, '1') = '1' THEN 'ACERTO CTB'
             WHEN substr(m.material_group, 1, 1) IN ('8', '9', 'A') THEN m.material_group ELSE 'OTHER' END AS product,
        CASE WHEN coalesce(m.material_group, '1') = '1' THEN 0 ELSE m.quantity END AS quantity,
        CASE WHEN coalesce(m.material_group, '1') = '1' THEN o.amount_third ELSE m.net_revenue END AS net_revenue
    FROM open_ledger o LEFT JOIN matched m ON m.document_number = o.document_number AND m.reference = o.reference
        AND m.comp_code = o.comp_code)
"""

_DATES = ["posting_date", "document_date"]
_AMOUNTS = ["amount_local", "amount_third"]
_SALES = ["sales_quantity", "sum_sales", "rebate_1", "condition_2", "unexpected_sd", "rebate_4", "net_revenue"]


def _sql(body: str) -> str:
    return a.with_inputs(f"{_CTES} {body}")


def summary_sql() -> str:
    body = f"""SELECT product, sum(quantity) AS sum_quantity, sum(amount_local) AS sum_amount_local,
        sum(amount_third) AS sum_amount_third, sum(net_revenue) AS total_net_revenue,
        round(CAST({div0('sum(net_revenue)', 'sum(quantity)')} AS DECIMAL(28,6)), 2) AS average_cost
        FROM base GROUP BY product"""
    numbers = ["sum_quantity", "sum_amount_local", "sum_amount_third", "total_net_revenue", "average_cost"]
    return final(_sql(body), numbers=numbers)


def cleared_sql() -> str:
    return final(_sql("SELECT * FROM cleared"), _DATES, _AMOUNTS)


def open_ledger_sql() -> str:
    return final(_sql("SELECT * FROM open_ledger"), _DATES, _AMOUNTS)


def diagnostic_sql() -> str:
    body = """SELECT nota_fiscal, comp_code, plant, invoice_date, document_number, document_date, material_group, quantity,
        net_revenue, sales_and_rebate, amount_third, difference, reference || amount_third AS pk1,
        nota_fiscal || sales_and_rebate AS pk2 FROM pairs"""
    numbers = ["quantity", "net_revenue", "sales_and_rebate", "amount_third", "difference"]
    return final(_sql(body), ["invoice_date", "document_date"], numbers)


def base_sql() -> str:
    return final(_sql("SELECT * FROM base"), _DATES, [*_AMOUNTS, "quantity", "net_revenue"])


def previous_month_sql() -> str:
    body = "SELECT * FROM sold WHERE strftime(invoice_date, '%Y/%m') = '2021/06'"
    return final(_sql(body), ["invoice_date"], _SALES)


def sales_sql() -> str:
    return final(_sql("SELECT * FROM sold"), ["invoice_date"], _SALES)
