"""Invoices compared between the tax system and the ledger system."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions import access_key, outside_tolerance, parse_yyyymmdd
from tallyworks.operators.reconcile import two_key_pairs
from tallyworks.operators.skew import group_apart
from tallyworks.operators.validate import Rule, status_verdict, validate
from tallyworks.session import stage
from tallyworks.sources import Sources
from tallyworks.sources import constants as const
from tallyworks.sources.layout import in_months

HEADER = (
    "doc_num",
    "center",
    "total_value",
    "access_key",
    "email",
    "own_tax_id",
    "issuer_tax_id",
    "issue_date",
    "number",
    "user",
    "partner",
    "posting_date",
    "creation_date",
    "service_flag",
    "ledger_document",
    "company_code",
    "fiscal_year",
    "cancelled",
)
TAX = (
    "tax_process",
    "tax_access_key",
    "tax_freight",
    "tax_insurance",
    "tax_discount",
    "tax_other",
    "tax_recipient_id",
    "tax_issuer_id",
    "tax_total",
    "tax_document_date",
    "tax_protocol",
    "tax_number",
    "tax_issue_date",
)
LOOKED_UP = ("access_key", "number", "issuer_tax_id")
LINE = ("item_value", "freight", "insurance", "discount", "other_cost")
OUTPUT = (
    "doc_num",
    "center",
    "total_value",
    "item_value",
    "access_key",
    "status",
    "email",
    "own_tax_id",
    "issuer_tax_id",
    "freight",
    "insurance",
    "discount",
    "other_cost",
    "issue_date",
    "number",
    "user",
    "partner",
    "posting_date",
    "service_flag",
    "ledger_document",
    "company_code",
    "fiscal_year",
    "cancelled",
    *TAX,
    "message",
)


def tax_feed(src: Sources, as_of: dt.date) -> DataFrame:
    """Invoices known to the tax system, this year and last."""
    issued = parse_yyyymmdd(F.left(F.col("data_hora_emissao").cast("string"), F.lit(8)))
    return (
        src.table("sa_g3p_invoices")
        .filter(F.year(issued) >= as_of.year - 1)
        .select(
            F.col("processo").alias("tax_process"),
            F.col("chave_de_acesso").alias("tax_access_key"),
            F.col("valor_total_do_frete").alias("tax_freight"),
            F.col("valor_total_do_seguro").alias("tax_insurance"),
            F.col("valor_total_do_desconto").alias("tax_discount"),
            F.col("outros_custos_adicionais").alias("tax_other"),
            F.lpad(F.col("cnpj_dest").cast("string"), 14, "0").alias("tax_recipient_id"),
            F.lpad(F.col("cnpj_emitente").cast("string"), 14, "0").alias("tax_issuer_id"),
            F.col("valor_total_incl_impostos").alias("tax_total"),
            F.col("data_documento").alias("tax_document_date"),
            F.col("numero_protocolo").alias("tax_protocol"),
            F.lpad(F.col("numero_nfe").cast("string"), 9, "0").alias("tax_number"),
            issued.alias("tax_issue_date"),
        )
    )


def ledger_documents(src: Sources, as_of: dt.date) -> DataFrame:
    """Incoming invoices of the ledger system with access key."""
    posted = parse_yyyymmdd(F.col("pstdat"))
    docs = (
        in_months(src.client_table("j_1bnfdoc"), "pstdat", dt.date(as_of.year - 1, 1, 1))
        .filter((F.col("pstdat") >= f"{as_of.year - 1}0101") & posted.isNotNull())
        .filter((F.col("direct") == "1") & (F.col("form") == " ") & (F.col("model") != "57"))
        .select(
            F.col("docnum").alias("doc_num"),
            F.col("nftot").alias("total_value"),
            F.col("cnpj_bupla").alias("own_tax_id"),
            F.col("cgc").alias("issuer_tax_id"),
            parse_yyyymmdd(F.col("docdat")).alias("issue_date"),
            F.col("nfenum").alias("number"),
            F.col("crenam").alias("user"),
            F.concat("parid", F.lit(" - "), "name1").alias("partner"),
            posted.alias("posting_date"),
            parse_yyyymmdd(F.col("credat")).alias("creation_date"),
            F.col("nfesrv").alias("service_flag"),
            F.col("belnr").alias("ledger_document"),
            F.col("bukrs").alias("company_code"),
            F.col("gjahr").alias("fiscal_year"),
            F.col("cancel").alias("cancelled"),
        )
    )
    parts = ("regio", "nfyear", "nfmonth", "stcd1", "model", "serie", "nfnum9", "docnum9", "cdv")
    keys = src.client_table("j_1bnfe_active").select(
        F.col("docnum").alias("doc_num"), access_key(*[F.col(p) for p in parts]).alias("access_key")
    )
    return docs.join(keys, "doc_num", "left")


def ledger_headers(src: Sources, as_of: dt.date) -> DataFrame:
    """Invoices of the ledger system with access key and plant contact, and how often each occurs."""
    contacts = src.table("sa_excel_tax_plant_xref").select(
        F.col("cnpj").alias("own_tax_id"), F.col("centro").alias("center"), "email"
    )
    joined = ledger_documents(src, as_of).join(contacts, "own_tax_id", "left")
    return joined.groupBy(*HEADER).agg(F.count(F.lit(1)).alias("times"))


def ledger_lines(src: Sources) -> DataFrame:
    """Values of the invoice lines of the ledger system."""
    return src.client_table("j_1bnflin").select(
        F.col("docnum").alias("doc_num"),
        F.col("netwr").alias("item_value"),
        F.col("nffre").alias("freight"),
        F.col("nfins").alias("insurance"),
        F.col("nfdis").alias("discount"),
        F.col("nfoth").alias("other_cost"),
    )


def line_kinds(lines: DataFrame) -> DataFrame:
    """Distinct lines and how many are ``alike``, dealt by invoice.

    All columns of a line are grouped by, so totals and listed lines are read from one exchange of the lines.
    """
    return lines.repartition("doc_num").groupBy("doc_num", *LINE).agg(F.count(F.lit(1)).alias("alike"))


def with_totals(headers: DataFrame, lines: DataFrame, alike: str | None = None) -> DataFrame:
    """Headers with the totals of their invoice's lines; headers without a line are dropped.

    A line stands under each header of its invoice, once for each time that header occurs. So lines
    are summed per invoice and the sums multiplied, and lines and headers aren't joined before.
    ``alike`` names a column that says how many lines a row of ``lines`` stands for, by default one.
    """
    each = F.col if alike is None else lambda c: F.col(c) * F.col(alike)
    sums = {f"{c}_total": F.sum(each(c)) for c in ("freight", "insurance", "discount")}
    sums["other_total"] = F.sum(each("other_cost"))
    totals = group_apart(lines, ["doc_num"], sums)
    joined = headers.join(totals, "doc_num")
    return joined.withColumns({name: F.col(name) * F.col("times") for name in sums}).drop("times")


def invoice_rules() -> list[Rule]:
    """The sixteen rules in report order. An unknown comparison breaks no rule."""
    c = F.col
    key_size = F.length("access_key")
    same_date = (
        c("tax_document_date").isNull()
        | (c("issue_date") == c("tax_document_date"))
        | (c("issue_date") == c("tax_issue_date"))
    )
    day_later = (F.datediff(c("tax_document_date"), c("issue_date")) == 1) | (
        F.datediff(c("tax_issue_date"), c("issue_date")) == 1
    )
    no = F.lit(False)
    conditions = [
        c("tax_process").isin(*const.CANCELLED_STATES),
        c("own_tax_id") == "",
        c("own_tax_id") != c("tax_recipient_id"),
        c("access_key") == "",
        outside_tolerance(c("total_value") - c("tax_total"), "0.05"),
        outside_tolerance(c("freight_total") - c("tax_freight"), "0.05"),
        outside_tolerance(c("insurance_total") - c("tax_insurance"), "0.05"),
        outside_tolerance(c("discount_total") - c("tax_discount"), "0.05"),
        outside_tolerance(c("other_total") - c("tax_other"), "0.05"),
        ~F.coalesce(same_date, no) & ~F.coalesce(day_later, no),
        c("issue_date") > c("posting_date"),
        (c("posting_date") != c("creation_date")) & (c("error_11") == 0),
        (key_size == 44) & c("missing_by_key") & c("missing_by_number"),
        (key_size == 44) & c("tax_access_key").isNull() & (c("error_13") == 0),
        c("service_flag") == "X",
        key_size < 44,
    ]
    return [
        Rule(f"error_{i:02d}", cond, text)
        for i, (cond, text) in enumerate(zip(conditions, const.INVOICE_MESSAGES), start=1)
    ]


def missing_marks(pairs: DataFrame) -> DataFrame:
    """Whether each invoice is missing by a key: any of its headers has no partner by it.

    ``pairs`` are those of :func:`two_key_pairs`; those of the second key may lack some that are found.
    """
    return group_apart(
        pairs,
        ["doc_num"],
        {
            "missing_by_key": F.max(F.col("by_primary") & ~F.col("found")),
            "missing_by_number": F.max(~F.col("by_primary") & ~F.col("found")),
        },
    )


def header_verdicts(pairs: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Pairs of headers and partners, each under every status and message of its invoice and access key.

    Status and message come from all headers of the invoice and key and their partners of the primary key. ``marks`` are by
    default those of the pairs. The verdicts of a key are gathered over the pairs themselves, which so are moved by invoice
    only, and not once more by invoice and key. Pairs without an access key have no verdict and are dropped.
    """
    marks = missing_marks(pairs) if marks is None else marks
    checked = validate(pairs.join(marks, "doc_num"), invoice_rules())
    not_loaded = (F.col("error_13") == 1) & (F.col("error_16") == 0)
    status = status_verdict(not_loaded, F.col("error_count"), const.INVOICE_STATUS)
    verdict = F.when(F.col("by_primary"), F.struct(status.alias("status"), F.col("message")))
    of_key = F.collect_set(verdict).over(Window.partitionBy("doc_num", "access_key"))
    judged = checked.withColumn("_verdicts", of_key).filter(F.col("access_key").isNotNull())
    judged = judged.withColumn("_verdict", F.explode("_verdicts"))
    return judged.select(*pairs.columns, "_verdict.status", "_verdict.message")


def with_partners(headers: DataFrame, pairs: DataFrame) -> DataFrame:
    """Headers under each pair of their invoice, access key, number and issuer, NULLs being equal.

    The join is dealt by the invoice alone, so that what follows by invoice needs no exchange. The other
    columns are compared as a range from one value to the same, as an equality would make them join keys.
    """
    key = F.struct(*[F.col(f"h.{c}") for c in LOOKED_UP])
    same = F.struct(*[F.col(f"p.{c}") for c in LOOKED_UP])
    on = (F.col("h.doc_num") == F.col("p.doc_num")) & key.between(same, same)
    extra = [F.col(f"p.{c}") for c in pairs.columns if c not in ("doc_num", *LOOKED_UP)]
    return headers.alias("h").join(pairs.alias("p"), on).select("h.*", *extra)


def invoice_check(src: Sources, as_of: dt.date, reuse: bool = True) -> DataFrame:
    """Invoice lines with their tax-system partner, status and messages.

    Partners are looked up by access key, and by number and issuer, once each and by the keys of headers only: these pairs give the
    marks of missing invoices, the rules' partners and the listed partners. A partner that both keys find stands
    under the first only, the usual case of two systems that agree. With ``reuse`` the tax system's
    invoices, the headers' keys and the pairs are written once and read back. Everything else, that is headers, pairs and lines, is moved
    once, by invoice: headers meet their pairs, rules are judged, and what is listed and the lines are made distinct there, before
    lines come last. So an invoice's headers, partners and lines are one task's.
    """
    keep = stage if reuse else (lambda df, _: df)
    lines = line_kinds(ledger_lines(src))
    tax = keep(tax_feed(src, as_of), "tax")
    looked_up = ledger_documents(src, as_of).select("doc_num", *LOOKED_UP).distinct()
    pairs = two_key_pairs(
        keep(looked_up, "invoice-headers"),
        tax,
        {"access_key": "tax_access_key"},
        {"number": "tax_number", "issuer_tax_id": "tax_issuer_id"},
    )
    twice = ~F.col("by_primary") & F.col("found") & F.col("access_key").eqNullSafe(F.col("tax_access_key"))
    pairs = keep(pairs.filter(~(twice & F.col("access_key").isNotNull())), "invoice-pairs")
    headers = with_totals(ledger_headers(src, as_of), lines, "alike")
    partners = with_partners(headers, pairs.filter(F.col("by_primary") | F.col("found")))
    listed = (
        F.col("tax_access_key").isNotNull()
        | (F.col("status") == const.INVOICE_STATUS[0])
        | (F.length("access_key") < 44)
    )
    judged = header_verdicts(partners, missing_marks(pairs)).filter(listed)
    judged = judged.select(*[c for c in OUTPUT if c not in LINE]).distinct()
    return judged.join(lines, "doc_num").select(*OUTPUT)
