"""Reference SQL of the two invoice reports."""

from __future__ import annotations

from checks import adapters as a
from checks import expected as const
from checks.sqltext import final, in_list, values

_D = "CAST(try_strptime({}, '%Y%m%d') AS DATE)"
_KEY = " || ".join(f"e.{p}" for p in const.KEY_PARTS)


def check_sql() -> str:
    def off(left: str, right: str) -> str:
        return f"abs({left} - {right}) > 0.05"

    conditions = [
        f"tax_process IN {in_list(const.CANCELLED_STATES)}",
        "own_tax_id = ''",
        "own_tax_id <> tax_recipient_id",
        "h.access_key = ''",
        off("total_value", "tax_total"),
        off("freight_total", "tax_freight"),
        off("insurance_total", "tax_insurance"),
        off("discount_total", "tax_discount"),
        off("other_total", "tax_other"),
        """NOT coalesce(tax_document_date IS NULL OR issue_date = tax_document_date OR issue_date = tax_issue_date, FALSE)
            AND NOT coalesce(tax_document_date - issue_date = 1 OR tax_issue_date - issue_date = 1, FALSE)""",
        "issue_date > posting_date",
        "posting_date <> creation_date AND NOT coalesce(issue_date > posting_date, FALSE)",
        "length(h.access_key) = 44 AND no_key AND no_number",
        "length(h.access_key) = 44 AND tax_access_key IS NULL AND NOT (no_key AND no_number)",
        "service_flag = 'X'",
        "length(h.access_key) < 44",
    ]
    flags = ", ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END AS e{i}" for i, c in enumerate(conditions, 1))
    total = " + ".join(f"e{i}" for i in range(1, 17))
    message = " || ".join(
        f"CASE e{i} WHEN 1 THEN '{m}' ELSE '' END" for i, m in enumerate(const.INVOICE_MESSAGES, 1)
    )
    bad, wrong, right = const.INVOICE_STATUS
    sql = f"""WITH tax AS (SELECT processo AS tax_process, chave_de_acesso AS tax_access_key,
        valor_total_do_frete AS tax_freight, valor_total_do_seguro AS tax_insurance,
        valor_total_do_desconto AS tax_discount, outros_custos_adicionais AS tax_other,
        lpad(CAST(cnpj_dest AS VARCHAR), 14, '0') AS tax_recipient_id,
        lpad(CAST(cnpj_emitente AS VARCHAR), 14, '0') AS tax_issuer_id, valor_total_incl_impostos AS tax_total,
        data_documento AS tax_document_date, numero_protocolo AS tax_protocol,
        lpad(CAST(numero_nfe AS VARCHAR), 9, '0') AS tax_number, {_D.format('left(data_hora_emissao, 8)')} AS tax_issue_date
        FROM sa_g3p_invoices WHERE year({_D.format('left(data_hora_emissao, 8)')}) >= 1997),
    lines AS (SELECT d.docnum AS doc_num, centro AS center, nftot AS total_value, l.netwr AS item_value,
        {_KEY} AS access_key, email, cnpj_bupla AS own_tax_id, cgc AS issuer_tax_id, nffre AS freight, nfins AS insurance,
        nfdis AS discount, nfoth AS other_cost, {_D.format('docdat')} AS issue_date, nfenum AS number, crenam AS user,
        d.parid || ' - ' || name1 AS partner, {_D.format('pstdat')} AS posting_date, {_D.format('credat')} AS creation_date,
        nfesrv AS service_flag, belnr AS ledger_document, bukrs AS company_code, gjahr AS fiscal_year, cancel AS cancelled
        FROM j_1bnfdoc d LEFT JOIN j_1bnfe_active e ON e.docnum = d.docnum JOIN j_1bnflin l ON l.docnum = d.docnum
        LEFT JOIN sa_excel_tax_plant_xref x ON x.cnpj = d.cnpj_bupla
        WHERE year({_D.format('pstdat')}) >= 1997 AND direct = '1' AND form = ' ' AND d.model <> '57'),
    hdr AS (SELECT {', '.join(const.INVOICE_HEADER)}, sum(freight) AS freight_total, sum(insurance) AS insurance_total,
        sum(discount) AS discount_total, sum(other_cost) AS other_total,
        NOT EXISTS (SELECT 1 FROM tax t WHERE t.tax_access_key = lines.access_key) AS no_key,
        NOT EXISTS (SELECT 1 FROM tax t WHERE t.tax_number = lines.number AND t.tax_issuer_id = lines.issuer_tax_id)
            AS no_number FROM lines GROUP BY ALL),
    flagged AS (SELECT h.doc_num, h.access_key, {flags} FROM hdr h LEFT JOIN tax ON tax.tax_access_key = h.access_key),
    judged AS (SELECT doc_num, access_key, {message} AS message,
        CASE WHEN e13 = 1 AND e16 = 0 THEN '{bad}' WHEN {total} <> 0 THEN '{wrong}' ELSE '{right}' END AS status
        FROM flagged),
    both_keys AS (SELECT l.*, status, message, tax.* FROM lines l
            JOIN judged j ON j.doc_num = l.doc_num AND j.access_key = l.access_key
            LEFT JOIN tax ON tax.tax_access_key = l.access_key
        UNION ALL SELECT l.*, status, message, tax.* FROM lines l
            JOIN judged j ON j.doc_num = l.doc_num AND j.access_key = l.access_key
            JOIN tax ON tax.tax_number = l.number AND tax.tax_issuer_id = l.issuer_tax_id)
    SELECT DISTINCT {', '.join(const.INVOICE_OUTPUT)} FROM both_keys
    WHERE tax_access_key IS NOT NULL OR status = '{bad}' OR length(access_key) < 44"""
    numbers = ["total_value", "item_value", "freight", "insurance", "discount", "other_cost", "tax_freight"]
    numbers += ["tax_insurance", "tax_discount", "tax_other", "tax_total"]
    return final(a.with_inputs(sql), ["issue_date", "posting_date", "tax_document_date", "tax_issue_date"], numbers)


def ptbr(text: str, by_width: bool) -> str:
    """Grouped text by explicit widths; the printed form of the original."""
    w = f"(strpos({text}, ',') - 1)"
    tail = f"right({text}, {w} - 1)" if by_width else f"right({text}, 2)"
    arms = []
    for width in range(4, 10):
        lead = (width - 1) % 3 + 1
        groups = " || '.' || ".join(f"substr({text}, {p}, 3)" for p in range(lead + 1, width, 3))
        arms.append(f"WHEN {w} = {width} THEN left({text}, {lead}) || '.' || {groups} || ',' || {tail}")
    return f"CASE {' '.join(arms)} ELSE {text} END"


def proper(number: str, decimals: int) -> str:
    """Brazilian number text: dots between thousands and a comma before the decimals."""
    return f"translate(format('{{:,.{decimals}f}}', CAST(CAST({number} AS DECIMAL(38,{decimals})) AS DOUBLE)), '.,', ',.')"


def snapshot_sql(compat: bool = True) -> str:
    def comma(expr: str) -> str:
        return f"replace(CAST({expr} AS VARCHAR), '.', ',')"

    def mask(c: str) -> str:
        return (
            f"substr({c}, 1, 2) || '.' || substr({c}, 3, 3) || '.' || substr({c}, 6, 3) || '/' || "
            f"substr({c}, 9, 4) || '-' || substr({c}, 13, 2)"
        )

    def party(f: str) -> str:
        return f"CASE WHEN natop = '{const.TRANSFER_OPERATION}' THEN kt.{f} ELSE kc.{f} END"

    q, p = "CAST(l.menge AS DECIMAL(13,4))", "CAST(l.netpr AS DECIMAL(13,6))"
    numbers = {
        "t_icms_base": "bt.total",
        "u_freight": "l.netfre",
        "v_icms": "it.icms",
        "x_insurance": "l.netins",
        "z1_discount": "l.nfdis",
        "z3_other_expenses": "l.netoth",
        "z5_ipi_total": "it.ipi",
        "z10_pis": "it.pis",
        "z11_cofins": "it.cofins",
        "z12_products_total": "nt.total",
        "z13_invoice_total": "nt.total + it.ipi",
        "z23_gross_weight": "CAST(d.brgew AS DECIMAL(20,3))",
        "z28_net_weight": "CAST(d.ntgew AS DECIMAL(20,3))",
        "z35_quantity": q,
        "z36_unit_price": p,
        "z37_total": f"CAST({q} * {p} AS DECIMAL(13,2))",
        "z38_discount": "l.netdis",
        "z39_icms_base": "bi.kwert",
        "z40_icms": "im.icms",
        "z41_ipi": "im.ipi",
    }
    texts = {n: comma(e) for n, e in numbers.items()}
    texts["z_icms_st_base"] = "CASE WHEN modbcst = ' ' THEN '0,00' ELSE replace(modbcst, '.', ',') END"
    raw = ", ".join(f"{t} AS {n}" for n, t in texts.items())
    printed = ", ".join(f"{ptbr(n, n in const.TAIL_BY_WIDTH)} AS {n}" for n in texts)
    if not compat:
        raw = ", ".join([f"{e} AS {n}" for n, e in numbers.items()] + [f"{texts['z_icms_st_base']} AS z_icms_st_base"])
        printed = ", ".join(f"{proper(n, const.DECIMALS.get(n, 2))} AS {n}" for n in numbers) + ", z_icms_st_base"

    def rate(kind: str) -> str:
        return comma(f"CASE WHEN left(nbm, 1) IN ('3', '4') THEN 0.00 ELSE CAST({kind} / 10 AS DECIMAL(6,2)) END")

    def wide(kinds: dict[str, tuple[str, str]]) -> str:
        first, *others = kinds.items()
        cols = ", ".join(f"k_{n}.{c} AS {n}" for n, (_, c) in kinds.items())
        joins = " ".join(
            f"JOIN konv k_{n} ON k_{n}.knumv = k_{first[0]}.knumv AND k_{n}.kposn = k_{first[0]}.kposn AND k_{n}.kschl = '{k}'"
            for n, (k, _) in others
        )
        f = first[0]
        return f"SELECT k_{f}.knumv, k_{f}.kposn, {cols} FROM konv k_{f} {joins} WHERE k_{f}.kschl = '{first[1][0]}'"

    taxes = {"icms": ("BX13", "kwert"), "ipi": ("BX23", "kwert"), "pis": ("BX82", "kwert"), "cofins": ("BX72", "kwert")}
    rates = {"icms": ("BX13", "kbetr"), "ipi": ("IPVA", "kbetr")}
    plain = {f"key_part_{i}": f"e.{k}" for i, k in enumerate(const.KEY_PARTS, 1)} | {
        "a_issuer_name": "ke.name1",
        "a_issuer_street": "ke.stras",
        "a_issuer_district": "ke.ort02",
        "a_issuer_postcode": "ke.pstlz",
        "a_issuer_city": "ke.ort01",
        "a_issuer_state": "ke.regio",
        "a_issuer_phone": "ke.telf1",
        "b_operation": "natop",
        "c_issuer_state_id": "ke.stcd3",
        "d_direction": "CASE direct WHEN '1' THEN '0' WHEN '2' THEN '1' WHEN '3' THEN '0' WHEN '4' THEN '1' END",
        "e_number": "nfenum",
        "f_series": "'00' || series",
        "g_access_key": _KEY,
        "h_protocol": f"""CASE WHEN authdate = '00000000' THEN authcod ELSE authcod || ' - ' || {_D.format('authdate')} || ' '
            || substr(authtime, 1, 2) || ':' || substr(authtime, 3, 2) || ':' || substr(authtime, 5, 2) END""",
        "i_issuer_tax_id_plain": "cnpj_bupla",
        "i_issuer_tax_id": mask("cnpj_bupla"),
        "j_customer_name": party("name1"),
        "k_customer_street": party("stras"),
        "l_customer_city": party("ort01"),
        "m_customer_tax_id": mask("cgc"),
        "n_customer_district": party("ort02"),
        "o_customer_state": party("regio"),
        "p_customer_phone": party("telf1"),
        "q_customer_postcode": party("pstlz"),
        "r_customer_state_id": party("stcd3"),
        "s_issue_date": f"CAST({_D.format('docdat')} AS VARCHAR)",
        "z2_icms_subst": "'0,000'",
        "z4_import_value": "'0,00'",
        "z6_icms_origin_state": "'0,00'",
        "z7_icms_target_state": "'0,00'",
        "z8_fcp_target_state": "'0,00'",
        "z9_tax_total": "CAST(0 AS DOUBLE)",
        "z14_carrier_name": "lf.name1",
        "z15_carrier_street": "lf.stras",
        "z16_packages": "anzpk",
        "z17_freight": "modfrete || ' - ' || tf.txt",
        "z21_carrier_city": "lf.ort01",
        "z24_state": "' '",
        "z25_carrier_state": "lf.regio",
        "z26_carrier_tax_id": mask("lf.stcd1"),
        "z27_carrier_state_id": "lf.stcd3",
        "item_number": "itmnum",
        "z29_product_code": "l.matnr",
        "z30_product_text": "l.maktx",
        "z31_goods_code": "nbm",
        "z32_origin_situation": "matorg || st.tax_situation",
        "z33_operation_code": "substr(cfop, 1, 4)",
        "z34_unit": "CASE meins WHEN 'TH' THEN 'MI' ELSE meins END",
        "unit_price_plain": f"CAST({p} AS DOUBLE)",
        "z42_icms_rate": rate("al.icms"),
        "z43_ipi_rate": rate("al.ipi"),
        "docnum": "d.docnum",
    }
    sql = f"""WITH freight(code, txt) AS ({values(const.FREIGHT_TYPES)}), imp AS ({wide(taxes)}), alq AS ({wide(rates)}),
    rows_ AS (SELECT {', '.join(f'{e} AS {n}' for n, e in plain.items())}, {raw}
    FROM j_1bnfdoc d LEFT JOIN j_1bnfe_active e ON e.docnum = d.docnum LEFT JOIN j_1bnflin l ON l.docnum = d.docnum
    LEFT JOIN kna1 kc ON kc.kunnr = e.parid LEFT JOIN kna1 kt ON kt.stcd1 = d.cgc
    LEFT JOIN t001w w ON w.bwkey = l.bwkey LEFT JOIN kna1 ke ON ke.kunnr = w.kunnr
    LEFT JOIN (SELECT docnum, sum(netwr) AS total FROM j_1bnflin GROUP BY docnum) nt ON nt.docnum = d.docnum
    LEFT JOIN freight tf ON tf.code = d.modfrete LEFT JOIN sa_bsp_tax_law_icms st ON st.icms_law = l.taxlw1
    LEFT JOIN vbrp vp ON vp.vbeln = l.refkey AND vp.posnr = l.refitm LEFT JOIN vbrk vk ON vk.vbeln = vp.vbeln
    LEFT JOIN mara m ON m.matnr = vp.matnr
    LEFT JOIN (SELECT * FROM konv WHERE kschl = 'BX10') bi ON bi.knumv = vk.knumv AND bi.kposn = vp.posnr
    LEFT JOIN (SELECT knumv, sum(kwert) AS total FROM konv WHERE kschl = 'BX10' GROUP BY knumv) bt ON bt.knumv = vk.knumv
    LEFT JOIN imp im ON im.knumv = vk.knumv AND im.kposn = vp.posnr
    LEFT JOIN (SELECT knumv, sum(icms) AS icms, sum(ipi) AS ipi, sum(pis) AS pis, sum(cofins) AS cofins FROM imp
        GROUP BY knumv) it ON it.knumv = vk.knumv
    LEFT JOIN alq al ON al.knumv = vk.knumv AND al.kposn = vp.posnr
    LEFT JOIN vbpa pa ON pa.vbeln = l.refkey AND pa.parvw IN ('CR', 'SP') LEFT JOIN lfa1 lf ON lf.lifnr = pa.lifnr
    WHERE {_KEY} IS NOT NULL AND natop IN {in_list(a.OPERATION_NAMES)}
    AND mtart IN {in_list(const.SNAPSHOT_MATERIAL_TYPES)} AND {_D.format('docdat')} = DATE '1997-12-29')
    SELECT {', '.join(plain)}, {printed} FROM rows_"""
    return a.with_inputs(sql)
