"""Stock-in-transit ledger: clearing to zero and matching with sales."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import (
    access_key,
    ageing_bucket,
    ageing_days,
    digits_between,
    in_month,
    month_bounds,
    month_key,
    net_of,
    parse_yyyymmdd,
    signed,
    strip_prefix,
)
from tallyworks.operators.reconcile import (
    ClearingRule,
    enrich_or_default,
    judge_by_rules,
    net_to_zero,
    product_class,
    staged_clearing,
    summarise_by_class,
    tolerant_match,
    uncleared_keys,
)
from tallyworks.operators.skew import distinct_keys
from tallyworks.session import LazyTables, Workspace, stage
from tallyworks.sources import Sources
from tallyworks.sources import constants as const
from tallyworks.sources.layout import in_months

LEDGER_COLUMNS = (
    "comp_code",
    "customer",
    "vendor",
    "trading_partner",
    "assignment",
    "gl_account",
    "user_name",
    "business_place",
    "document_type",
    "currency",
    "document_number",
    "line_item",
    "year_month",
    "posting_date",
    "document_date",
    "cost_center",
    "amount_local",
    "amount_third",
    "reference",
    "text",
    "aging",
    "aging_category",
)


def ledger(src: Sources, as_of: dt.date) -> DataFrame:
    """Open items, and items cleared this month, posted before this month.

    Both kinds come from one scan and one join; an item that is open and also carries a
    clearing date of this month counts under both, as two separate lists would.
    """
    first, last = month_bounds(as_of)
    items = src.client_table("bseg").filter(
        F.col("bukrs").isin(*const.LEDGER_COMPANIES)
        & F.col("hkont").isin(*const.LEDGER_ACCOUNTS)
        & F.col("vbund").isin(*const.LEDGER_PARTNERS)
        & ((F.col("augbl") == "") | digits_between(F.col("augdt"), first, last))
    )
    heads = in_months(src.client_table("bkpf"), "budat", dt.date(2014, 1, 1)).filter(
        (F.col("budat") >= "20140101")
        & parse_yyyymmdd(F.col("budat")).isNotNull()
        & ~F.coalesce(digits_between(F.col("budat"), first, last), F.lit(False))
    )
    posting, document = parse_yyyymmdd(F.col("budat")), parse_yyyymmdd(F.col("bldat"))
    kinds = F.filter(
        F.array(
            F.when(F.col("augbl") == "", "Still Open Item"),
            F.when(digits_between(F.col("augdt"), first, last), "Open Item cleared in current month"),
        ),
        lambda k: k.isNotNull(),
    )
    return (
        items.join(
            heads.select("belnr", "bukrs", "gjahr", "usnam", "blart", "waers", "budat", "bldat", "xblnr"),
            ["belnr", "bukrs", "gjahr"],
        )
        .select(
            F.col("bukrs").alias("comp_code"),
            F.col("werks").alias("plant"),
            F.col("kunnr").alias("customer"),
            F.col("lifnr").alias("vendor"),
            F.col("vbund").alias("trading_partner"),
            F.col("zuonr").alias("assignment"),
            F.col("hkont").alias("gl_account"),
            F.col("usnam").alias("user_name"),
            F.col("bupla").alias("business_place"),
            F.col("blart").alias("document_type"),
            F.col("waers").alias("currency"),
            F.col("belnr").alias("document_number"),
            F.col("buzei").alias("line_item"),
            month_key(posting).alias("year_month"),
            posting.alias("posting_date"),
            document.alias("document_date"),
            F.col("kostl").alias("cost_center"),
            signed(F.col("dmbtr"), F.col("shkzg")).alias("amount_local"),
            signed(F.col("dmbe3"), F.col("shkzg")).alias("amount_third"),
            F.col("xblnr").alias("reference"),
            F.col("sgtxt").alias("text"),
            ageing_days(document, as_of).alias("aging"),
            F.explode(kinds).alias("open_item_category"),
        )
        .withColumn("aging_category", ageing_bucket(F.col("aging")))
    )


def sales(src: Sources, as_of: dt.date) -> DataFrame:
    """Invoiced sales lines of earlier months with their profitability values.

    What is looked up for an invoice or a material joins these first, and the lines before their values come:
    the wide rows of the values are only moved for the one join by line.
    """
    first, last = month_bounds(as_of)
    invoices = (
        in_months(src.client_table("vbrk"), "fkdat", dt.date(2017, 6, 1))
        .filter(F.col("bukrs").isin(*const.SALES_COMPANIES) & (F.col("fkdat") >= "20170601"))
        .filter(
            parse_yyyymmdd(F.col("fkdat")).isNotNull()
            & ~F.coalesce(digits_between(F.col("fkdat"), first, last), F.lit(False))
        )
        .select("vbeln", F.col("bukrs").alias("inv_bukrs"), "fkdat", "kunag", "vkorg", "vtweg", "spart")
    )
    lines = src.client_table("vbrp").select("vbeln", "posnr", "matnr")
    values = (
        src.client_table("ce1bcsa")
        .filter((F.col("paledger") == "01") & F.col("rec_waers").isin("USD"))
        .filter((F.col("vv211") != 0) & (F.col("wwnnf") != " "))
        .select(
            F.col("rbeln").alias("vbeln"),
            F.col("rposn").alias("posnr"),
            F.col("perde").alias("period"),
            F.col("artnr").alias("material_number"),
            F.col("wwnnf").alias("nota_fiscal"),
            F.col("bukrs").alias("comp_code"),
            F.col("werks").alias("plant"),
            F.col("kdgrp").alias("customer_group"),
            F.col("kndnr").alias("customer"),
            F.col("mtart").alias("material_type"),
            F.col("matkl").alias("material_group"),
            F.col("vv211").alias("sales_quantity"),
            F.col("vv211_me").alias("base_unit"),
            F.col("vv100").alias("sum_sales"),
            F.col("vv140").alias("rebate_1"),
            F.col("vv210").alias("condition_2"),
            F.col("vv180").alias("unexpected_sd"),
            F.col("vv170").alias("rebate_4"),
            F.col("rec_waers").alias("record_currency"),
        )
    )
    customers = src.client_table("kna1").select(F.col("kunnr").alias("kunag"), F.col("name1").alias("name_1"))
    areas = src.client_table("knvv").select(F.col("kunnr").alias("kunag"), "vkorg", "vtweg", "spart")
    companies = src.client_table("t001").select(F.col("bukrs").alias("inv_bukrs"))
    materials = src.client_table("mara").select("matnr", F.col("matkl").alias("mat_group"))
    ranges = src.client_table("mvke").select("vkorg", "vtweg", "matnr")
    groups = src.client_table("t023t").filter(F.col("spras") == "P").select(F.col("matkl").alias("mat_group"))
    texts = src.client_table("makt").filter(F.col("spras") == "P").select("matnr")
    sold = (
        invoices.join(companies, "inv_bukrs")
        .join(customers, "kunag")
        .join(areas, ["kunag", "vkorg", "vtweg", "spart"], "left")
        .select("vbeln", "vkorg", "vtweg", "fkdat", "name_1")
    )
    known = materials.join(groups, "mat_group", "left").join(texts, "matnr", "left").select("matnr")
    return (
        lines.join(known, "matnr")
        .join(sold, "vbeln")
        .join(ranges, ["vkorg", "vtweg", "matnr"], "left")
        .select("vbeln", "posnr", "fkdat", "name_1")
        .join(values, ["vbeln", "posnr"])
        .withColumn("invoice_date", parse_yyyymmdd(F.col("fkdat")))
        .withColumn(
            "net_revenue",
            net_of(F.col("sum_sales"), F.col("condition_2"), F.col("unexpected_sd"), F.col("rebate_4")),
        )
        .select(*SALES_COLUMNS)
    )


SALES_COLUMNS = (
    "nota_fiscal",
    "comp_code",
    "plant",
    "customer_group",
    "customer",
    "name_1",
    "material_type",
    "material_group",
    "material_number",
    "period",
    "invoice_date",
    "sales_quantity",
    "base_unit",
    "sum_sales",
    "rebate_1",
    "condition_2",
    "unexpected_sd",
    "rebate_4",
    "net_revenue",
    "record_currency",
)
STAGE_COLUMNS = tuple(c for c in LEDGER_COLUMNS if c != "line_item")


#: What the clearing rules and the test for open documents look at.
CLEARING_KEYS = ("comp_code", "document_number", "year_month", "document_type", "reference", "text")


def clearing_rules() -> list[ClearingRule]:
    """Rules that look at the whole ledger: by reference, and notes by the reference without its prefix."""
    kind, reference = F.col("document_type"), F.col("reference")

    def notes(types: Sequence[str], prefixes: Sequence[str]) -> ClearingRule:
        return ClearingRule("Reference", strip_prefix(reference, prefixes), counts=kind.isin(*types))

    return [
        ClearingRule("Reference", reference, shown=~kind.isin(*const.NOTE_TYPES)),
        notes(const.CREDIT_TYPES, const.CREDIT_PREFIXES),
        notes(const.DEBIT_TYPES, const.DEBIT_PREFIXES),
    ]


def clear(entries: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Ledger rows under each clearing rule with its verdict.

    Three rules are judged in one pass. The fourth, by text, sums what the first leaves open and is shown for all rows of the
    first, so it follows on the first one's rows; ``keep`` may store these, as they are read three times.
    """
    amount = "amount_local"
    judged = keep(judge_by_rules(entries, clearing_rules(), amount))
    by_reference = judged.filter("rule_no = 0").drop("balance_type", "rule_no")
    left = by_reference.filter(F.col("balance_result") == "BALANCE").drop("balance_result")
    by_text = net_to_zero(left, "text", amount, tol="0.1", rows=by_reference.drop("balance_result"))
    return judged.drop("rule_no").unionByName(by_text.withColumn("balance_type", F.lit("Text")))


def open_ledger_lines(
    entries: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """Ledger lines of the documents with open rows that no rule has cleared.

    The rules only need sums, so they are judged on one row per document, type, reference and
    text. Company, document and month are never NULL in the ledger, so the cleared test is one
    aggregation over the verdicts.
    """
    summed = entries.groupBy(*CLEARING_KEYS).agg(F.sum("amount_local").alias("amount_local"))
    documents = uncleared_keys(clear(summed, keep), ["comp_code", "document_number", "year_month"])
    return entries.select(*LEDGER_COLUMNS).join(
        distinct_keys(documents, F.col("document_number")), "document_number", "left_semi"
    )


def sales_totals(sold: DataFrame) -> DataFrame:
    """Sales per invoice reference, place, group and date, without those netting to 0."""
    return (
        sold.groupBy("nota_fiscal", "comp_code", "plant", "customer_group", "invoice_date", "material_group")
        .agg(
            F.sum("net_revenue").alias("net_revenue"),
            F.sum("sales_quantity").alias("quantity"),
            F.sum(F.col("sum_sales") + F.col("rebate_1")).alias("sales_and_rebate"),
        )
        .filter(F.col("net_revenue") != 0)
    )


def _partner(open_ledger: DataFrame) -> DataFrame:
    return open_ledger.select("document_number", "document_date", "reference", "amount_third")


def match_diagnostic(totals: DataFrame, open_ledger: DataFrame) -> DataFrame:
    """Every sale and open line sharing a reference, with their difference."""
    return tolerant_match(
        totals, _partner(open_ledger), {"nota_fiscal": "reference"}, "sales_and_rebate", "amount_third", tol=None
    ).select(
        "nota_fiscal",
        "comp_code",
        "plant",
        "invoice_date",
        "document_number",
        "document_date",
        "material_group",
        "quantity",
        "net_revenue",
        "sales_and_rebate",
        "amount_third",
        "difference",
        access_key(F.col("reference"), F.col("amount_third")).alias("pk1"),
        access_key(F.col("nota_fiscal"), F.col("sales_and_rebate")).alias("pk2"),
    )


def matched_sales(totals: DataFrame, open_ledger: DataFrame) -> DataFrame:
    """Sales equal to an open line by reference and date, and in amount within 0.1."""
    return tolerant_match(
        totals,
        _partner(open_ledger),
        {"nota_fiscal": "reference", "invoice_date": "document_date"},
        "sales_and_rebate",
        "amount_third",
        tol="0.1",
    ).select("reference", "comp_code", "document_number", "customer_group", "material_group", "quantity", "net_revenue")


def transit_tables(
    src: Sources, as_of: dt.date, reuse: bool = True, workspace: Workspace | None = None
) -> Mapping[str, DataFrame]:
    """All tables of the reconciliation report, each built when it is asked for.

    With ``reuse`` what feeds several of them (the ledger, its verdicts and open lines, the sales base) is written when first
    needed: to the ``workspace``, where a run that starts again finds it, or else to the shared folder. Without a workspace
    the sales base is only written for those who ask for it: the totals take its columns that they need.
    """
    made: dict[str, DataFrame] = {}

    def keep(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if workspace is not None:
            return workspace.table(name, make)
        return stage(make(), name) if reuse else make()

    def verdicts(rows: DataFrame, name: str) -> DataFrame:
        return clear(rows, lambda df: keep(name, lambda: df))

    def sales_base() -> DataFrame:
        made["sales"] = keep("sales", lambda: sales(src, as_of))
        return made["sales"]

    def totals() -> DataFrame:
        if workspace is not None:
            return sales_totals(t["sales_base"])
        if "totals" not in made:
            sold = made["sales"] if "sales" in made else sales(src, as_of)
            made["totals"] = keep("sales-totals", lambda: sales_totals(sold))
        return made["totals"]

    t = LazyTables(
        {
            "ledger": lambda: keep("ledger", lambda: ledger(src, as_of)),
            "sales_base": sales_base,
            "sales_previous_month": lambda: t["sales_base"].filter(in_month(F.col("invoice_date"), as_of, -1)),
            "cleared": lambda: staged_clearing(verdicts(t["ledger"].select(*STAGE_COLUMNS), "verdicts"))[0],
            "open_ledger": lambda: keep(
                "open-ledger",
                lambda: open_ledger_lines(t["ledger"], lambda df: keep("document-verdicts", lambda: df)),
            ),
            "match_diagnostic": lambda: match_diagnostic(totals(), t["open_ledger"]),
            "base": lambda: sap_base(t["open_ledger"], matched_sales(totals(), t["open_ledger"])),
            "summary": lambda: class_summary(t["open_ledger"], matched_sales(totals(), t["open_ledger"])),
        }
    )
    return t


def sap_base(open_ledger: DataFrame, matched: DataFrame) -> DataFrame:
    """Open ledger lines with their sale; lines without one become a booking correction."""
    group: Column = F.col("material_group")
    missing = group.isNull() | (group == "1")
    joined = enrich_or_default(
        open_ledger,
        matched.withColumnRenamed("quantity", "sold_quantity").withColumnRenamed("net_revenue", "sold_revenue"),
        ["document_number", "reference", "comp_code"],
        {
            "product": (F.lit("ACERTO CTB"), product_class(group)),
            "quantity": (F.lit(0), F.col("sold_quantity")),
            "net_revenue": (F.col("amount_third"), F.col("sold_revenue")),
        },
        missing,
    )
    return joined.select(*LEDGER_COLUMNS, "customer_group", "material_group", "product", "quantity", "net_revenue")


def class_summary(open_ledger: DataFrame, matched: DataFrame) -> DataFrame:
    """Totals and average cost per product class.

    The sums of :func:`sap_base`, without forming its rows: both sides are summed to the
    join key first, and the sums are weighted by how often the other side repeats.
    """
    keys = ["document_number", "reference", "comp_code"]
    lines = open_ledger.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("amount_local").alias("local"),
        F.sum("amount_third").alias("third"),
    )
    sold = matched.groupBy(*keys, "material_group").agg(
        F.count(F.lit(1)).alias("n_sold"), F.sum("quantity").alias("sold"), F.sum("net_revenue").alias("revenue")
    )
    times, lines_n = F.coalesce("n_sold", F.lit(1)), F.col("n_lines")
    group = F.col("material_group")
    missing = group.isNull() | (group == "1")
    weighted = lines.join(sold, keys, "left").select(
        F.when(missing, "ACERTO CTB").otherwise(product_class(group)).alias("product"),
        F.when(missing, F.lit(0)).otherwise(F.col("sold") * lines_n).alias("quantity"),
        (F.col("local") * times).alias("amount_local"),
        (F.col("third") * times).alias("amount_third"),
        F.when(missing, F.col("third") * times).otherwise(F.col("revenue") * lines_n).alias("net_revenue"),
    )
    return _by_class(weighted).orderBy("product")


def _by_class(rows: DataFrame) -> DataFrame:
    sums = {
        "sum_quantity": "quantity",
        "sum_amount_local": "amount_local",
        "sum_amount_third": "amount_third",
        "total_net_revenue": "net_revenue",
    }
    return summarise_by_class(rows, "product", sums, "sum_quantity", "total_net_revenue")


def transit_reconciliation(
    src: Sources, as_of: dt.date, reuse: bool = True, workspace: Workspace | None = None
) -> DataFrame:
    """The closing table of the report: totals per product class. Sales are read once here and aren't stored."""
    t = transit_tables(src, as_of, reuse, workspace)
    return class_summary(t["open_ledger"], matched_sales(sales_totals(sales(src, as_of)), t["open_ledger"]))
