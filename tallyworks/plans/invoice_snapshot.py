"""One day's outgoing invoices as print-ready rows for issuing them by hand."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import (
    access_key,
    choose,
    comma_decimal,
    digits_to_time,
    format_ptbr,
    format_ptbr_compat,
    mask_tax_id,
    override_by_prefix,
    parse_yyyymmdd,
    remap,
)
from tallyworks.operators.membership import in_domain
from tallyworks.operators.reshape import combinations, kind_lists
from tallyworks.session import stage
from tallyworks.sources import Sources, inline
from tallyworks.sources import constants as const
from tallyworks.sources.layout import in_months

KEY_PARTS = ("regio", "nfyear", "nfmonth", "stcd1", "model", "serie", "nfnum9", "docnum9", "cdv")

#: Output name -> decimals of the numbers printed as text.
PRINTED = {
    "t_icms_base": 2,
    "u_freight": 2,
    "v_icms": 2,
    "x_insurance": 2,
    "z1_discount": 2,
    "z3_other_expenses": 2,
    "z5_ipi_total": 2,
    "z10_pis": 2,
    "z11_cofins": 2,
    "z12_products_total": 2,
    "z13_invoice_total": 2,
    "z23_gross_weight": 3,
    "z28_net_weight": 3,
    "z35_quantity": 4,
    "z36_unit_price": 6,
    "z37_total": 2,
    "z38_discount": 2,
    "z39_icms_base": 2,
    "z40_icms": 2,
    "z41_ipi": 2,
}
TAIL_BY_WIDTH = ("z23_gross_weight", "z28_net_weight", "z36_unit_price")


def _lines(src: Sources, as_of: dt.date, lag: int) -> DataFrame:
    """Invoice lines of the day, with the billing line each refers to.

    The day and the operation list cut the documents first; everything later joins to
    what is left of them.
    """
    day = as_of - dt.timedelta(days=lag)
    issued = in_months(src.client_table("j_1bnfdoc"), "docdat", day, day).filter(F.col("docdat") == day.strftime("%Y%m%d"))
    docs = in_domain(issued, "natop", const.OPERATIONS).select(
        "docnum",
        "direct",
        "natop",
        "nfenum",
        "series",
        "cnpj_bupla",
        "cgc",
        parse_yyyymmdd(F.col("docdat")).alias("issue_date"),
        "anzpk",
        "brgew",
        "ntgew",
        "modfrete",
    )
    keys = src.client_table("j_1bnfe_active").select(
        "docnum",
        *[F.col(p).alias(f"key_part_{i}") for i, p in enumerate(KEY_PARTS, start=1)],
        access_key(*[F.col(p) for p in KEY_PARTS]).alias("access_key"),
        "authcod",
        "authdate",
        "authtime",
        "parid",
    )
    lines = src.client_table("j_1bnflin").select(
        "docnum",
        "itmnum",
        F.col("matnr").alias("line_matnr"),
        "maktx",
        "nbm",
        "matorg",
        "cfop",
        "meins",
        "menge",
        "netpr",
        "netwr",
        "netdis",
        "netfre",
        "netins",
        "netoth",
        "nfdis",
        "modbcst",
        "bwkey",
        "refkey",
        "refitm",
        "taxlw1",
    )
    billing = src.client_table("vbrp").select(
        F.col("vbeln").alias("refkey"), F.col("posnr").alias("refitm"), "matnr"
    )
    invoices = src.client_table("vbrk").select(F.col("vbeln").alias("refkey"), "knumv")
    materials = in_domain(src.client_table("mara"), "mtart", const.SNAPSHOT_MATERIAL_TYPES).select("matnr", "mtart")
    return (
        docs.join(keys.filter(F.col("access_key").isNotNull()), "docnum")
        .join(lines, "docnum")
        .join(billing, ["refkey", "refitm"])
        .join(materials, "matnr")
        .join(invoices, "refkey", "left")
    )


#: Conditions of an item by list, and the columns read from their combinations.
LISTS = {
    "bases": (const.CONDITION_BASE, ["kwert"]),
    "icms_rows": (const.CONDITION_ICMS, ["kwert", "kbetr"]),
    "ipi_rows": (const.CONDITION_IPI, ["kwert"]),
    "pis_rows": (const.CONDITION_PIS, ["kwert"]),
    "cofins_rows": (const.CONDITION_COFINS, ["kwert"]),
    "ipi_rate_rows": (const.CONDITION_IPI_RATE, ["kbetr"]),
}
TAXES = {t: (f"{t}_rows", "kwert") for t in ("icms", "ipi", "pis", "cofins")}
RATES = {"icms_rate": ("icms_rows", "kbetr"), "ipi_rate": ("ipi_rate_rows", "kbetr")}


def _conditions(src: Sources, lines: DataFrame) -> DataFrame:
    """The conditions of each invoice item, a list per kind."""
    wanted = lines.select("knumv").filter(F.col("knumv").isNotNull()).distinct()
    rows = src.client_table("konv").select("knumv", "kposn", "kschl", "kwert", "kbetr")
    rows = in_domain(rows, "kschl", [k for k, _ in LISTS.values()]).join(wanted, "knumv", "left_semi")
    return kind_lists(rows, ["knumv", "kposn"], "kschl", LISTS)


def _totals(conditions: DataFrame) -> DataFrame:
    """Sums of the base and of the combined taxes per invoice; conditions without an item count for the base only."""
    kwert = conditions.schema["bases"].dataType.elementType["kwert"].dataType
    none = F.lit(None).cast(kwert)
    names = ["base", *TAXES]

    def rows(array: Column, given: Sequence[str], field: str | None = None) -> Column:
        return F.transform(array, lambda x: F.struct(*[(x[field or n] if n in given else none).alias(n) for n in names]))

    taxes = F.when(F.col("kposn").isNotNull(), rows(combinations(TAXES), list(TAXES))).otherwise(F.array())
    both = conditions.select("knumv", F.explode(F.concat(rows(F.col("bases"), ["base"], "kwert"), taxes)).alias("row"))
    return both.groupBy("knumv").agg(*[F.sum(f"row.{n}").alias(f"{n}_total") for n in names])


def _party(src: Sources, key: str, prefix: str) -> DataFrame:
    fields = ("name1", "stras", "ort01", "ort02", "pstlz", "regio", "telf1", "stcd3")
    return src.client_table("kna1").select(
        F.col(key).alias(f"{prefix}_key"), *[F.col(f).alias(f"{prefix}_{f}") for f in fields]
    )


def invoice_snapshot(
    src: Sources, as_of: dt.date, lag: int = 3, compat: bool = True, reuse: bool = True
) -> DataFrame:
    """Print-ready lines of the invoices issued ``lag`` days before ``as_of``.

    ``compat`` prints numbers exactly as the original report does, including its slips
    for some widths and scales; without it they are proper Brazilian number text.
    """
    keep = stage if reuse else (lambda df, _: df)
    lines = keep(_lines(src, as_of, lag), "snapshot-lines")
    conditions = keep(_conditions(src, lines), "snapshot-conditions")
    by_invoice = _totals(conditions)
    day_docs = lines.select("docnum").distinct()
    net_total = (
        src.client_table("j_1bnflin")
        .select("docnum", "netwr")
        .join(day_docs, "docnum", "left_semi")
        .groupBy("docnum")
        .agg(F.sum("netwr").alias("net_total"))
    )
    plants = src.client_table("t001w").select("bwkey", F.col("kunnr").alias("emit_key"))
    freight = inline(src.spark, ["modfrete", "freight_text"], const.FREIGHT_TYPES)
    laws = src.table("sa_bsp_tax_law_icms").select(F.col("icms_law").alias("taxlw1"), "tax_situation")
    partners = (
        src.client_table("vbpa").filter(F.col("parvw").isin("CR", "SP")).select(F.col("vbeln").alias("refkey"), "lifnr")
    )
    carriers = src.client_table("lfa1").select(
        "lifnr", *[F.col(c).alias(f"carrier_{c}") for c in ("name1", "stras", "ort01", "regio", "stcd1", "stcd3")]
    )
    df = lines
    df = df.join(_party(src, "kunnr", "cust"), F.col("parid") == F.col("cust_key"), "left")
    df = df.join(_party(src, "stcd1", "transf"), F.col("cgc") == F.col("transf_key"), "left")
    df = df.join(plants, "bwkey", "left").join(_party(src, "kunnr", "emit"), "emit_key", "left")
    df = df.join(net_total, "docnum", "left").join(freight, "modfrete", "left").join(laws, "taxlw1", "left")
    df = df.join(conditions.withColumnRenamed("kposn", "refitm"), ["knumv", "refitm"], "left")
    df = df.join(by_invoice, "knumv", "left")
    df = df.join(partners, "refkey", "left").join(carriers, "lifnr", "left")
    for one, several in (("base", F.col("bases")), ("tax", combinations(TAXES)), ("rate", combinations(RATES))):
        df = df.withColumn(one, F.explode_outer(several))
    df = df.withColumn("base_item", F.col("base.kwert")).withColumns(
        {t: F.col(f"tax.{t}") for t in TAXES} | {r: (F.col(f"rate.{r}") / 10).cast("decimal(6,2)") for r in RATES}
    )
    return _render(df, compat)


def _render(df: DataFrame, compat: bool) -> DataFrame:
    c = F.col
    transfer = c("natop") == const.TRANSFER_OPERATION

    def party(field: str) -> Column:
        return choose(transfer, c(f"transf_{field}"), c(f"cust_{field}"))

    authorised = F.concat(
        c("authcod"),
        F.lit(" - "),
        F.date_format(parse_yyyymmdd(c("authdate")), "yyyy-MM-dd"),
        F.lit(" "),
        digits_to_time(c("authtime")),
    )
    quantity = c("menge").cast("decimal(13,4)")
    unit_price = c("netpr").cast("decimal(13,6)")
    numbers = {
        "t_icms_base": c("base_total"),
        "u_freight": c("netfre"),
        "v_icms": c("icms_total"),
        "x_insurance": c("netins"),
        "z1_discount": c("nfdis"),
        "z3_other_expenses": c("netoth"),
        "z5_ipi_total": c("ipi_total"),
        "z10_pis": c("pis_total"),
        "z11_cofins": c("cofins_total"),
        "z12_products_total": c("net_total"),
        "z13_invoice_total": c("net_total") + c("ipi_total"),
        "z23_gross_weight": c("brgew").cast("decimal(20,3)"),
        "z28_net_weight": c("ntgew").cast("decimal(20,3)"),
        "z35_quantity": quantity,
        "z36_unit_price": unit_price,
        "z37_total": (quantity * unit_price).cast("decimal(13,2)"),
        "z38_discount": c("netdis"),
        "z39_icms_base": c("base_item"),
        "z40_icms": c("icms"),
        "z41_ipi": c("ipi"),
    }

    def printed(name: str) -> Column:
        if not compat:
            return format_ptbr(numbers[name], PRINTED[name])
        return format_ptbr_compat(comma_decimal(numbers[name]), name in TAIL_BY_WIDTH)

    none = F.lit(0).cast("decimal(6,2)")
    rate = {r: comma_decimal(override_by_prefix(c("nbm"), c(f"{r}_rate"), ("3", "4"), none)) for r in ("icms", "ipi")}
    st_base = F.when(c("modbcst") == " ", "0,00").otherwise(comma_decimal(c("modbcst")))
    direction = c("direct").cast("int")
    fields: dict[str, Column] = {f"key_part_{i}": c(f"key_part_{i}") for i in range(1, 10)}
    fields |= {
        "a_issuer_name": c("emit_name1"),
        "a_issuer_street": c("emit_stras"),
        "a_issuer_district": c("emit_ort02"),
        "a_issuer_postcode": c("emit_pstlz"),
        "a_issuer_city": c("emit_ort01"),
        "a_issuer_state": c("emit_regio"),
        "a_issuer_phone": c("emit_telf1"),
        "b_operation": c("natop"),
        "c_issuer_state_id": c("emit_stcd3"),
        "d_direction": F.when(direction.isin(1, 3), "0").when(direction.isin(2, 4), "1"),
        "e_number": c("nfenum"),
        "f_series": F.concat(F.lit("00"), c("series")),
        "g_access_key": c("access_key"),
        "h_protocol": F.when(c("authdate") == "00000000", c("authcod")).otherwise(authorised),
        "i_issuer_tax_id_plain": c("cnpj_bupla"),
        "i_issuer_tax_id": mask_tax_id(c("cnpj_bupla")),
        "j_customer_name": party("name1"),
        "k_customer_street": party("stras"),
        "l_customer_city": party("ort01"),
        "m_customer_tax_id": mask_tax_id(c("cgc")),
        "n_customer_district": party("ort02"),
        "o_customer_state": party("regio"),
        "p_customer_phone": party("telf1"),
        "q_customer_postcode": party("pstlz"),
        "r_customer_state_id": party("stcd3"),
        "s_issue_date": F.date_format(c("issue_date"), "yyyy-MM-dd"),
        "t_icms_base": printed("t_icms_base"),
        "u_freight": printed("u_freight"),
        "v_icms": printed("v_icms"),
        "x_insurance": printed("x_insurance"),
        "z_icms_st_base": format_ptbr_compat(st_base) if compat else st_base,
        "z1_discount": printed("z1_discount"),
        "z2_icms_subst": F.lit("0,000"),
        "z3_other_expenses": printed("z3_other_expenses"),
        "z4_import_value": F.lit("0,00"),
        "z5_ipi_total": printed("z5_ipi_total"),
        "z6_icms_origin_state": F.lit("0,00"),
        "z7_icms_target_state": F.lit("0,00"),
        "z8_fcp_target_state": F.lit("0,00"),
        "z9_tax_total": F.lit("0.00").cast("decimal(3,2)"),
        "z10_pis": printed("z10_pis"),
        "z11_cofins": printed("z11_cofins"),
        "z12_products_total": printed("z12_products_total"),
        "z13_invoice_total": printed("z13_invoice_total"),
        "z14_carrier_name": c("carrier_name1"),
        "z15_carrier_street": c("carrier_stras"),
        "z16_packages": c("anzpk"),
        "z17_freight": F.concat(c("modfrete"), F.lit(" - "), c("freight_text")),
        "z21_carrier_city": c("carrier_ort01"),
        "z23_gross_weight": printed("z23_gross_weight"),
        "z24_state": F.lit(" "),
        "z25_carrier_state": c("carrier_regio"),
        "z26_carrier_tax_id": mask_tax_id(c("carrier_stcd1")),
        "z27_carrier_state_id": c("carrier_stcd3"),
        "z28_net_weight": printed("z28_net_weight"),
        "item_number": c("itmnum"),
        "z29_product_code": c("line_matnr"),
        "z30_product_text": c("maktx"),
        "z31_goods_code": c("nbm"),
        "z32_origin_situation": F.concat(c("matorg"), c("tax_situation")),
        "z33_operation_code": F.substring(c("cfop"), 1, 4),
        "z34_unit": remap(c("meins"), {"TH": "MI"}),
        "z35_quantity": printed("z35_quantity"),
        "unit_price_plain": unit_price,
        "z36_unit_price": printed("z36_unit_price"),
        "z37_total": printed("z37_total"),
        "z38_discount": printed("z38_discount"),
        "z39_icms_base": printed("z39_icms_base"),
        "z40_icms": printed("z40_icms"),
        "z41_ipi": printed("z41_ipi"),
        "z42_icms_rate": rate["icms"],
        "z43_ipi_rate": rate["ipi"],
        "docnum": c("docnum"),
    }
    return df.select(*[col.alias(name) for name, col in fields.items()])
