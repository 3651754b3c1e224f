"""Reports over stored tables: sources, pushdown, options and agreement between variants."""

import datetime as dt
import decimal
import importlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.adapters import AS_OF, LEDGER_AS_OF, TABLES, adapted, on_spark
from tallyworks import plans
from tallyworks.operators import reconcile
from tallyworks.plans import capacity, cost_base, labels, transit
from tallyworks.plans.cost_overview import _regions, cost_overview
from tallyworks.session import LazyTables, Workspace, shared_dir, stage
from tallyworks.sources import Sources, inline
from tallyworks.sources import constants as const
from tallyworks.sources.layout import write_layout
from tallyworks.sources.tables import snake


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    for name in ("mara", "marc", "vw_fct_inventory_aging", "makt", "warehousing_capacity", "bseg", "bkpf", "vbap", "vbep"):
        on_spark(spark, sf_dir, f"SELECT * FROM {name}").write.parquet(f"{root}/{name}.parquet")
    return str(root)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_sources_read_display_names(spark, sf_dir, stored):
    direct = plans.packaging_availability(adapted(spark, sf_dir))
    assert rows(plans.packaging_availability(Sources.from_parquet(spark, stored))) == rows(direct)
    view = spark.read.parquet(f"{stored}/vw_fct_inventory_aging.parquet")
    shown = view.toDF(*[c.replace("_", " ").title() for c in view.columns])
    frames = {n: spark.read.parquet(f"{stored}/{n}.parquet") for n in ("mara", "makt", "warehousing_capacity")}
    src = Sources.from_frames(spark, frames | {"vw_fct_inventory_aging": shown})
    assert rows(plans.packaging_availability(src)) == rows(direct)
    assert snake("Storage Location") == "storage_location"


def test_sources_from_catalog(spark):
    spark.range(3).withColumn("mandt", F.lit("300")).createOrReplaceTempView("some_table")
    assert Sources.from_catalog(spark, {"t": "some_table"}).client_table("t").count() == 3
    assert Sources.from_catalog(spark, {"t": "some_table"}, client="100").client_table("t").count() == 0


def test_filters_and_columns_reach_the_scan(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    src = Sources.from_parquet(spark, stored)
    plan = transit.ledger(src, LEDGER_AS_OF)._jdf.queryExecution().executedPlan().toString()
    heads = next(line for line in plan.splitlines() if "bkpf.parquet" in line)
    assert "GreaterThanOrEqual(budat,20140101)" in heads
    items = next(line for line in plan.splitlines() if "bseg.parquet" in line)
    assert "In(bukrs" in items and "EqualTo(mandt,300)" in items
    stock = plans.packaging_availability(src)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in stock.splitlines() if "vw_fct_inventory_aging.parquet" in line)
    assert "In(material" in scan and "status" not in scan.split("ReadSchema")[1]


def test_inline_table_is_sized(spark):
    df = inline(spark, ["a", "b"], [("it's", 1), ("x\\y", None)])
    assert rows(df) == Counter([("it's", 1), ("x\\y", None)])


def test_stage_keeps_rows_in_the_shared_folder(spark):
    df = spark.range(10).withColumn("d", F.lit("1.50").cast("decimal(18,2)"))
    staged = stage(df, "numbers")
    assert staged.dtypes == df.dtypes and rows(staged) == rows(df)
    folder = shared_dir(spark)
    assert staged.inputFiles()[0].replace("file://", "").startswith(folder.replace("file://", ""))


def test_ledger_lists_an_item_under_both_kinds(spark, sf_dir):
    kinds = transit.ledger(adapted(spark, sf_dir), LEDGER_AS_OF).groupBy("document_number", "line_item").agg(
        F.collect_set("open_item_category").alias("k")
    )
    assert kinds.filter(F.size("k") == 2).count() > 0


def test_cleared_and_open_rows_of_one_rule_are_apart(spark, sf_dir):
    entries = transit.ledger(adapted(spark, sf_dir), LEDGER_AS_OF)
    judged = reconcile.judge_by_rules(entries, transit.clearing_rules(), "amount_local")
    per_ref = judged.filter("rule_no = 0").groupBy("reference").agg(F.countDistinct("balance_result").alias("n"))
    assert per_ref.filter("n > 1").count() == 0


def test_open_documents_are_the_same_from_whole_rows(spark, sf_dir):
    """Rules judged on one row per document key leave the same documents open as on all ledger rows."""
    entries = stage(transit.ledger(adapted(spark, sf_dir), LEDGER_AS_OF), "ledger")
    keys = ["comp_code", "document_number", "year_month"]
    whole = reconcile.uncleared_keys(transit.clear(entries), keys)
    documents = {r.document_number for r in whole.collect()}
    assert documents and {r.document_number for r in transit.open_ledger_lines(entries).collect()} == documents


def test_summary_equals_the_sums_of_the_base_rows(spark, sf_dir):
    tables = plans.transit_tables(adapted(spark, sf_dir), LEDGER_AS_OF)
    base = tables["base"].groupBy("product").agg(
        F.sum("quantity"), F.sum("amount_local"), F.sum("amount_third"), F.sum("net_revenue")
    )
    assert rows(tables["summary"].drop("average_cost")) == rows(base)
    unstaged = plans.transit_reconciliation(adapted(spark, sf_dir), LEDGER_AS_OF, reuse=False)
    assert rows(unstaged) == rows(tables["summary"])


def test_last_balance_is_the_sum_of_daily_changes(spark, sf_dir):
    df = plans.plant_capacity(adapted(spark, sf_dir), AS_OF, plants=["BRPE"])
    assert df.select("plant").distinct().count() == 1
    change = F.col("stock_quantity_plant") - F.col("sales_quantity_plant") + F.col("production_quantity_plant")
    total = df.agg(F.sum(change)).collect()[0][0]
    last = df.orderBy(F.desc("date")).select("daily_result_plant").first()[0]
    assert total == last
    assert df.count() == 31


def test_warehouse_sales_can_be_matched_by_warehouse(spark, sf_dir):
    df = plans.warehouse_capacity(adapted(spark, sf_dir), AS_OF, match_warehouse=True)
    assert df.count() == df.select("date", "plant", "warehouse").distinct().count()


def test_overview_shares_its_pass_over_the_costs(spark, sf_dir):
    src = adapted(spark, sf_dir)
    together = cost_overview(src)
    assert rows(together["regional_cost"]) == rows(plans.regional_cost(src, reuse=False))
    assert rows(together["shared_total"]) == rows(plans.shared_total(src))


def test_allocated_and_service_parts_add_up(spark, sf_dir):
    df = plans.cost_to_center(adapted(spark, sf_dir))
    off = df.filter(F.col("app_assigned_amount") + F.col("service_assigned_amount") != F.col("tco_cost_value"))
    assert off.count() == 0


def test_snapshot_numbers_without_compatibility(spark, sf_dir):
    src = adapted(spark, sf_dir)
    day = dt.date(1998, 1, 10)
    printed = plans.invoice_snapshot(src, day, compat=True, reuse=False)
    proper = plans.invoice_snapshot(src, day, compat=False, reuse=False)
    assert printed.columns == proper.columns
    weights = [r[0] for r in proper.select("z23_gross_weight").collect()]
    assert all("," in w and ",," not in w for w in weights)


def test_labels_cover_the_reports(spark, sf_dir):
    src = adapted(spark, sf_dir)
    shown = labels.with_labels(plans.plant_capacity(src, AS_OF), labels.CAPACITY)
    assert "Warehouse Ocupation Total - Cans" in shown.columns and "Capacity Quantity AG" in shown.columns
    shown = labels.with_labels(plans.warehouse_capacity(src, AS_OF), labels.CAPACITY)
    assert "Daily Result AG Only - Ends" in shown.columns
    snap = labels.with_labels(plans.invoice_snapshot(src, AS_OF, reuse=False), labels.SNAPSHOT)
    assert "Z36 - Valor Unitário" in snap.columns and not [c for c in snap.columns if c.startswith("z")]


def test_adapters_use_no_cross_join():
    assert not [n for n, sql in TABLES.items() if "CROSS JOIN" in sql]


@pytest.fixture(scope="module")
def invoices(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("invoices")
    for name in ("sa_g3p_invoices", "j_1bnfdoc", "j_1bnfe_active", "j_1bnflin", "sa_excel_tax_plant_xref"):
        on_spark(spark, sf_dir, f"SELECT * FROM {name}").write.parquet(f"{root}/{name}.parquet")
    return str(root)


def written_plans(monkeypatch, module):
    """Plans of everything that a report module stages."""
    seen = []

    def recorded(df, label):
        seen.append(df)
        return stage(df, label)

    monkeypatch.setattr(module, "stage", recorded)
    return seen


def scans(dfs, table):
    texts = [df._jdf.queryExecution().executedPlan().toString() for df in dfs]
    return sum(len(re.findall(rf"FileScan parquet.*/{table}[-.]", text)) for text in texts)


def test_invoice_check_reads_lines_and_tax_few_times(spark, invoices, monkeypatch):
    module = importlib.import_module("tallyworks.plans.invoice_check")
    seen = written_plans(monkeypatch, module)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    result = plans.invoice_check(Sources.from_parquet(spark, invoices), dt.date(1998, 6, 1))
    everything = [*seen, result]
    assert len(seen) == 3
    assert scans(everything, "j_1bnflin") == 2
    assert scans(everything, "sa_g3p_invoices") == 1 and scans(everything, "tax") == 2
    assert scans(everything, "invoice-headers") == 2


def test_invoice_check_with_repeated_headers_and_lines(spark):
    """An invoice with two keys and a contact listed twice: totals, marks and partners by plain loops."""
    check = importlib.import_module("tallyworks.plans.invoice_check")
    key = "".join(str(i % 10) for i in range(44))
    base = {c: None for c in check.HEADER}
    headers, lines, tax = [], [], []
    for doc, keys in (("d1", [key, "short"]), ("d2", [key]), ("d3", [None]), ("d4", [""]), ("d5", [key[::-1]])):
        for k in keys:
            headers.append(base | {"doc_num": doc, "access_key": k, "number": doc, "issuer_tax_id": "i", "times": 2 if doc == "d2" else 1})
        lines += [(doc, 10.0, 1.0), (doc, 10.0, 1.0), (doc, 11.0, 0.5)]
    lines.append(("none", 1.0, 1.0))
    kinds = ", ".join(f"{c} string" for c in check.HEADER) + ", times long"
    h = spark.createDataFrame([tuple(r[c] for c in (*check.HEADER, "times")) for r in headers], kinds)
    h = h.withColumns({"total_value": F.lit(5).cast("decimal(13,2)")} | {c: F.lit(dt.date(2024, 1, 1)) for c in ("issue_date", "posting_date", "creation_date")})
    li = spark.createDataFrame(lines, "doc_num string, v double, f double").select(
        "doc_num", *[F.col("f" if c == "freight" else "v").cast("decimal(13,2)").alias(c) for c in check.LINE]
    )
    totals = {r.doc_num: r.freight_total for r in check.with_totals(h, li).collect()}
    assert {k: float(v) for k, v in totals.items()} == {"d1": 2.5, "d2": 5.0, "d3": 2.5, "d4": 2.5, "d5": 2.5}
    for k, number, freight in ((key, "x", 2.5), ("other", "d1", 0.0), ("", "zz", 1.0), ("", "yy", 1.0)):
        tax.append((k, number, "i", freight))
    t = spark.createDataFrame(tax, "tax_access_key string, tax_number string, tax_issuer_id string, tax_freight double")
    missing = [c for c in check.TAX if c not in t.columns]
    t = t.withColumns({c: F.lit(None).cast("date" if "date" in c else "decimal(13,2)" if c.split("_")[1] in ("insurance", "discount", "other", "total") else "string") for c in missing})
    t = t.withColumn("tax_freight", F.col("tax_freight").cast("decimal(13,2)"))
    pairs = reconcile.two_key_pairs(
        check.with_totals(h, li), t, {"access_key": "tax_access_key"}, {"number": "tax_number", "issuer_tax_id": "tax_issuer_id"}
    )
    by = Counter((r.doc_num, r.access_key, r.by_primary, r.tax_number) for r in pairs.collect())
    expected = Counter()
    for r in headers:
        for first, hits in ((True, [x for x in tax if x[0] == r["access_key"]]), (False, [x for x in tax if x[1] == r["number"]])):
            expected.update([(r["doc_num"], r["access_key"], first, x[1]) for x in hits] or [(r["doc_num"], r["access_key"], first, None)])
    assert by == expected
    verdicts = {(r.doc_num, r.access_key): r.status for r in check.header_verdicts(pairs).collect()}
    bad, wrong, right = const.INVOICE_STATUS
    assert verdicts[("d1", key)] == right  # one of its keys is missing, but its number is known
    assert verdicts[("d2", key)] == wrong  # the contact's repeat doubles its freight
    assert verdicts[("d5", key[::-1])] == bad and verdicts[("d4", "")] == wrong and verdicts[("d1", "short")] == wrong


def test_tables_are_made_when_asked_for_and_found_again(spark, sf_dir, tmp_path, monkeypatch):
    src = adapted(spark, sf_dir)
    work = Workspace(spark, f"file://{tmp_path}/run")
    tables = plans.transit_tables(src, LEDGER_AS_OF, workspace=work)
    assert work.complete() == []
    sold = rows(tables["sales_previous_month"])
    assert work.complete() == ["sales"]  # no ledger

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(transit, "uncleared_keys", broken)
        with pytest.raises(RuntimeError):
            tables["summary"]
    assert work.complete() == ["document-verdicts", "ledger", "sales"]
    with monkeypatch.context() as m:  # a run that starts again reads what is there
        m.setattr(transit, "ledger", broken)
        m.setattr(transit, "sales", broken)
        again = plans.transit_tables(src, LEDGER_AS_OF, workspace=Workspace(spark, f"file://{tmp_path}/run"))
        assert rows(again["sales_previous_month"]) == sold
        summary = rows(again["summary"])
    assert summary == rows(plans.transit_reconciliation(src, LEDGER_AS_OF, reuse=False))
    assert set(again) == set(tables) and len(again) == 8
    work.clear()
    assert work.complete() == [] and not list((tmp_path / "run").iterdir())


def test_a_write_that_failed_is_not_complete(spark, tmp_path):
    work = Workspace(spark, f"file://{tmp_path}/w")
    bad = spark.range(4).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(Exception, match="no"):
        work.table("t", lambda: bad)
    assert work.complete() == []
    got = work.table("t", lambda: spark.range(3).withColumn("d", F.lit("1.5").cast("decimal(9,2)")))
    assert work.complete() == ["t"] and got.count() == 3 and got.dtypes == [("id", "bigint"), ("d", "decimal(9,2)")]
    lazy = LazyTables({"a": lambda: spark.range(1), "b": lambda: 1 / 0})
    assert lazy["a"] is lazy["a"] and list(lazy) == ["a", "b"]


def test_client_and_dates_choose_the_folders(spark, sf_dir, tmp_path):
    for name, date in (("vbep", "tddat"), ("vbap", None), ("bkpf", "budat"), ("bseg", None), ("mara", None)):
        table = on_spark(spark, sf_dir, f"SELECT * FROM {name}")
        other = table.withColumn("mandt", F.lit("030"))
        write_layout(table.unionByName(other), f"{tmp_path}/{name}", date)
    adapted(spark, sf_dir).table("vbak").write.parquet(f"{tmp_path}/vbak")
    src = Sources.from_layout(spark, str(tmp_path))
    assert {r.mandt for r in src.table("bkpf").select("mandt").distinct().collect()} == {"300", "030"}
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")

    def scan(df, name):
        line = next(x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if re.search(rf"FileScan.*/{name}[,\]]", x))
        return line.split("PartitionFilters: [")[1].split("], PushedFilters")[0]

    ledger = transit.ledger(src, LEDGER_AS_OF)
    assert "mandt" in scan(ledger, "bkpf") and "budat_month" in scan(ledger, "bkpf") and "201401" in scan(ledger, "bkpf")
    assert "mandt" in scan(ledger, "bseg")
    pallets = inline(spark, ["mat_group", "pnum", "types"], [("8000", 10, "Cans")])
    due = capacity.due_lines(src, pallets, AS_OF, 30)
    assert "mandt" in scan(due, "vbep") and "tddat_month" in scan(due, "vbep")
    direct = adapted(spark, sf_dir)
    assert rows(ledger) == rows(transit.ledger(direct, LEDGER_AS_OF))
    assert rows(due) == rows(capacity.due_lines(direct, pallets, AS_OF, 30))
    listed = src.table("vbep").filter("mandt = '030'").select("tddat_month").distinct().count()
    assert listed == on_spark(spark, sf_dir, "SELECT DISTINCT substring(tddat, 1, 6) FROM vbep").count()


def test_growing_dimensions_are_never_broadcast(spark, sf_dir):
    src = adapted(spark, sf_dir)
    costs = cost_base.costs(src)
    joined = cost_base.with_centers(src, cost_base.with_allocation(src, costs, by_id=True), by_id=True)
    joined = cost_base.with_applications(src, joined, by_id=True).withColumnRenamed("tco_cost_financial_plan", cost_base.PLAN)
    plan = joined.join(_regions(src), ["tco_applicationid", cost_base.PLAN], "left")
    assert "Broadcast" not in plan._jdf.queryExecution().executedPlan().toString()
    shared = plans.shared_cost(src, reuse=False)._jdf.queryExecution().executedPlan().toString()
    by_application = [line for line in shared.split("\n") if "Join" in line and "[tco_applicationid#" in line]
    assert by_application and all("SortMergeJoin" in line for line in by_application)


def test_stock_items_are_joined_once(spark, sf_dir):
    src = adapted(spark, sf_dir)
    plan = capacity._stock(src, capacity._pallets(src, const.PALLETS_PLANT))._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    first = next(i for i, line in enumerate(lines) if "Join Inner" in line)
    depth = lines[first].index("Join")
    left = [line for line in lines[first + 1 :] if line[depth : depth + 1] == ":"]
    assert left and not any("Join" in line for line in left)


def test_totals_do_not_store_all_sales(spark, sf_dir, monkeypatch):
    stored = []
    monkeypatch.setattr(transit, "stage", lambda df, name: stored.append(name) or df)
    tables = transit.transit_tables(adapted(spark, sf_dir), LEDGER_AS_OF)
    tables["base"], tables["match_diagnostic"]
    assert "sales" not in stored and stored.count("sales-totals") == 1
    tables["sales_base"]
    assert stored.count("sales") == 1


def test_values_of_sales_are_moved_for_one_join(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = transit.sales(adapted(spark, sf_dir), LEDGER_AS_OF)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = [len(re.match(r"[\s:+-]*", line)[0]) for line in plan]
    at = next(i for i, line in enumerate(plan) if re.search(r"AS (vv100|sum_sales)#", line))
    above, moved = depth[at], 0
    for i in range(at, -1, -1):
        if depth[i] < above:
            above = depth[i]
            moved += "Exchange" in plan[i]
    assert moved == 1


def test_sales_are_not_repeated_for_bands(spark):
    sales = spark.range(20).select(F.lit("r").alias("nota"), (F.col("id") / 7).cast("decimal(12,2)").alias("s_amt"))
    ledger = spark.createDataFrame([("r", 1.0)], "ref string, l_amt double")
    s, l = reconcile.in_bands(sales, ledger, "s_amt", "l_amt", "0.1")
    assert s.count() == 20 and l.count() == 2


def test_partners_found_by_both_keys_are_stored_once(spark, invoices, monkeypatch):
    module = importlib.import_module("tallyworks.plans.invoice_check")
    stored = {}
    monkeypatch.setattr(module, "stage", lambda df, name: stored.setdefault(name, stage(df, name)))
    src = Sources.from_parquet(spark, invoices)
    plans.invoice_check(src, dt.date(1998, 6, 1))
    pairs = stored["invoice-pairs"]
    assert pairs.filter("by_primary AND found").count() > 0
    assert pairs.filter("NOT by_primary AND found AND access_key = tax_access_key").count() == 0
    assert pairs.filter("NOT by_primary AND found").count() > 0 and pairs.filter("NOT by_primary AND NOT found").count() > 0


def moved(df, column):
    """Columns of each exchange of a query that moves ``column``."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    found = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    return [{c.split("#")[0] for c in columns.split(", ")} for columns in found if re.search(rf"\b{column}#", columns)]


def test_invoice_check_moves_headers_partners_and_lines_once(spark, invoices, monkeypatch):
    module = importlib.import_module("tallyworks.plans.invoice_check")
    seen = written_plans(monkeypatch, module)
    settings = {"spark.sql.debug.maxToStringFields": "200", "spark.sql.autoBroadcastJoinThreshold": "1k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        result = plans.invoice_check(Sources.from_parquet(spark, invoices), dt.date(1998, 6, 1))
        assert len(moved(result, "tax_protocol")) == 1
        lookups = [moved(df, "access_key") for df in seen]
        assert not [columns for found in lookups for columns in found if {"user", "crenam", "total_value", "nftot"} & columns]
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString()
        final = plan[plan.index("== Final Plan ==") : plan.index("== Initial Plan ==")]
        assert re.search(r"ReusedExchange \[doc_num#\d+, item_value#", final)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_headers_meet_the_pairs_of_equal_keys_and_nulls(spark):
    check = importlib.import_module("tallyworks.plans.invoice_check")
    keys = [("d", "k", "1", "i"), ("d", None, "1", "i"), ("d", "", "1", "i"), ("d", "k", None, "i"), ("e", "k", "1", None), (None, "k", "1", "i")]
    h = spark.createDataFrame([(*k, n) for n, k in enumerate(keys)], "doc_num string, access_key string, number string, issuer_tax_id string, n int")
    p = h.withColumnRenamed("n", "m").union(h.filter("n = 1"))
    got = sorted((r.n, r.m) for r in check.with_partners(h, p).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (2, 2), (3, 3), (4, 4)]


def test_invoice_check_lists_repeated_and_unknown_rows_once(spark):
    """Repeated lines, headers, contacts and tax rows, unknown numbers and keys, an invoice without lines: against hand-made rows."""
    key, other = "1" * 44, "2" * 44
    doc = "docnum string, nftot decimal(13,2), cnpj_bupla string, cgc string, docdat string, nfenum string, crenam string, parid string, name1 string, "
    doc += "pstdat string, credat string, nfesrv string, belnr string, bukrs string, gjahr string, cancel string, direct string, form string, model string, mandt string"

    def header(num, number, issuer="7"):
        day = "19980102"
        return (num, D("9.00"), "5", issuer, day, number, "u", "p", "n", day, day, " ", num, "1", "1998", " ", "1", " ", "55", "300")

    D = decimal.Decimal
    parts = ("regio", "nfyear", "nfmonth", "stcd1", "model", "serie", "nfnum9", "docnum9", "cdv")
    active = [("a", key), ("b", None), ("c", other), ("d", key)]
    line = ("300", D("1.00"), D("2.00"), D("0.00"), D("0.00"), D("0.00"))
    tax = [
        ("P", k, f, D("0.00"), D("0.00"), D("0.00"), 5, int(i), D("9.00"), dt.date(1998, 1, 2), "p" + k[:1], int(n), "19980102000000")
        for k, n, i, f in ((key, "1", "7", D("4.00")), (key, "1", "7", D("4.00")), ("short", "3", "7", D("2.00")))
    ]
    taxes = "processo string, chave_de_acesso string, valor_total_do_frete decimal(13,2), valor_total_do_seguro decimal(13,2), valor_total_do_desconto decimal(13,2), "
    taxes += "outros_custos_adicionais decimal(13,2), cnpj_dest long, cnpj_emitente long, valor_total_incl_impostos decimal(13,2), data_documento date, "
    taxes += "numero_protocolo string, numero_nfe long, data_hora_emissao string"
    lines = [("a", *line), ("a", *line), ("b", *line), ("c", *line), ("c", "300", D("1.00"), None, None, None, None)]
    frames = {
        "j_1bnfdoc": spark.createDataFrame([header("a", "000000001", "00000000000007"), header("b", "2"), header("c", "000000003", "00000000000007"), header("d", "9"), header("a", None, None)], doc),
        "j_1bnfe_active": spark.createDataFrame([(n, k, *[""] * 8, "300") for n, k in active], ", ".join(f"{c} string" for c in ("docnum", *parts, "mandt"))),
        "j_1bnflin": spark.createDataFrame(lines, "docnum string, mandt string, " + ", ".join(f"{c} decimal(13,2)" for c in ("netwr", "nffre", "nfins", "nfdis", "nfoth"))),
        "sa_g3p_invoices": spark.createDataFrame(tax, taxes),
        "sa_excel_tax_plant_xref": spark.createDataFrame([("5", "C1", "m1"), ("5", "C2", "m2"), ("5", "C2", "m2"), (None, "C3", "m3")], "cnpj string, centro string, email string"),
    }
    for reuse in (True, False):
        got = Counter(
            (r.doc_num, r.number, r.center, r.tax_access_key, None if r.freight is None else float(r.freight), r.status, r.message.strip())
            for r in plans.invoice_check(Sources.from_frames(spark, frames), dt.date(1998, 6, 1), reuse=reuse).collect()
        )
        bad, wrong, right = const.INVOICE_STATUS
        tax_id, freight, apart = (const.INVOICE_MESSAGES[i].strip() for i in (2, 5, 13))
        expected = Counter()
        for number in ("000000001", None):  # contact C2 stands twice, which doubles the totals of its headers
            for center in ("C1", "C2"):
                for message in (tax_id, f"{tax_id} {freight}"):
                    expected["a", number, center, key, 2.0, wrong, message] += 1
        for center in ("C1", "C2"):
            for value in (2.0, None):
                expected["c", "000000003", center, "short", value, wrong, apart] += 1
        assert got == expected
