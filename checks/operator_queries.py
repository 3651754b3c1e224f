"""Operators on the test tables, each with plain SQL for the same result."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.invoice_reports import ptbr
from checks.registry import register
from checks.sqltext import div0, final, qty
from tallyworks import functions as fn
from tallyworks.operators import allocate, membership, reconcile, reshape, spine, validate
from tallyworks.session import stage
from tallyworks.sources import inline

AS_OF = dt.date(1998, 1, 1)


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    return o.withColumns(
        {
            "o_date": F.col("o_orderdate").cast("date"),
            "o_amount": fn.money(F.col("o_totalprice")),
            "o_digits": F.date_format("o_orderdate", "yyyyMMdd"),
        }
    ).drop("o_orderdate", "o_totalprice")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem")
    return li.withColumns(
        {
            "l_day": F.col("l_shipdate").cast("date"),
            "price": F.col("l_extendedprice").cast("decimal(12,2)"),
            "disc": F.col("l_discount").cast("decimal(4,2)"),
            "tax": F.col("l_tax").cast("decimal(4,2)"),
            "qty": F.col("l_quantity").cast("decimal(12,2)"),
        }
    )


O = """o AS (SELECT *, CAST(o_orderdate AS DATE) AS o_date, CAST(o_totalprice AS DECIMAL(18,2)) AS o_amount,
    strftime(o_orderdate, '%Y%m%d') AS o_digits FROM orders)"""
L = """li AS (SELECT *, CAST(l_shipdate AS DATE) AS l_day, CAST(l_extendedprice AS DECIMAL(38,2)) AS price,
    CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(l_tax AS DECIMAL(4,2)) AS tax,
    CAST(l_quantity AS DECIMAL(38,2)) AS qty FROM lineitem)"""


def query(sql: str, nullable: tuple[str, ...] = ()):
    """Register the decorated function under its own name.

    ``nullable`` names integer columns that may be NULL; both sides show them as doubles.
    """

    def wrap(f):
        def run(spark, sf):
            return f(spark, sf).withColumns({c: F.col(c).cast("double") for c in nullable})

        register(f.__name__, run if nullable else f, final(sql, numbers=nullable))
        return f

    return wrap


# --- projection and filter -------------------------------------------------------------


@query(
    final(
        f"""WITH {L}, n AS (SELECT l_orderkey AS order_key, l_linenumber AS line, price * (1 - disc) AS net, tax FROM li)
    SELECT order_key, line, net, net * tax AS tax_amount, net + net * tax AS gross, 'BRL' AS currency FROM n""",
        numbers=["net", "tax_amount", "gross"],
    )
)
def p_project_rename(spark, sf):
    return (
        lines(spark, sf)
        .select(
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linenumber").alias("line"),
            (F.col("price") * (1 - F.col("disc"))).alias("net"),
            "tax",
        )
        .withColumn("tax_amount", F.col("net") * F.col("tax"))
        .withColumn("gross", F.col("net") + F.col("tax_amount"))
        .withColumn("currency", F.lit("BRL"))
        .drop("tax")
    )


@query(
    final(
        f"""WITH {L}, n AS (SELECT l_orderkey, l_linenumber, price * (1 - disc) AS net, disc - tax AS gap FROM li)
    SELECT *, abs(gap) > 0.05 AS wide FROM n WHERE net > 20000 AND (gap BETWEEN -0.02 AND 0.02 OR abs(gap) > 0.05)""",
        numbers=["net", "gap"],
    )
)
def p_alias_filter(spark, sf):
    gap = F.col("gap")
    return (
        lines(spark, sf)
        .select("l_orderkey", "l_linenumber", (F.col("price") * (1 - F.col("disc"))).alias("net"), (F.col("disc") - F.col("tax")).alias("gap"))
        .filter(F.col("net") > 20000)
        .filter(fn.within_tolerance(gap, "0.02") | fn.outside_tolerance(gap, "0.05"))
        .withColumn("wide", fn.outside_tolerance(gap, "0.05"))
    )


@query(
    """SELECT p_partkey, p_name, p_type, l_orderkey, l_linenumber FROM part LEFT JOIN lineitem ON l_partkey = p_partkey
    AND l_returnflag = 'R' WHERE p_name LIKE 'b%' AND p_type NOT IN ('SMALL', 'LARGE') AND p_size IN (1, 5, 9, 13)
    AND (l_orderkey IS NULL OR l_linenumber IS NOT NULL)""",
    nullable=('l_orderkey', 'l_linenumber'),
)
def p_in_like(spark, sf):
    returned = read(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    return (
        read(spark, sf, "part")
        .filter(F.col("p_name").like("b%") & ~F.col("p_type").isin("SMALL", "LARGE") & F.col("p_size").isin(1, 5, 9, 13))
        .join(returned, F.col("p_partkey") == F.col("l_partkey"), "left")
        .filter(F.col("l_orderkey").isNull() | F.col("l_linenumber").isNotNull())
        .select("p_partkey", "p_name", "p_type", "l_orderkey", "l_linenumber")
    )


@query(
    f"""WITH {O} SELECT o_orderkey, CASE WHEN o_orderpriority <> NULL THEN o_orderpriority ELSE o_orderstatus END AS product
    FROM o WHERE CAST(o_digits AS INTEGER) >= 19980101"""
)
def p_null_literal(spark, sf):
    # A comparison with NULL never holds, so the other branch is the answer.
    return (
        orders(spark, sf)
        .filter(F.col("o_digits").cast("int") >= 19980101)
        .select("o_orderkey", F.col("o_orderstatus").alias("product"))
    )


@query("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_nationkey || c_mktsegment <> '3BUILDING'")
def p_distinct(spark, sf):
    key = F.concat(F.col("c_nationkey").cast("string"), F.col("c_mktsegment"))
    return read(spark, sf, "customer").filter(key != "3BUILDING").select("c_nationkey", "c_mktsegment").distinct()


@query("SELECT c_mktsegment FROM customer GROUP BY c_nationkey, c_mktsegment")
def p_group_distinct(spark, sf):
    # grouping without aggregates: the distinct keys, of which fewer columns may be shown
    return read(spark, sf, "customer").select("c_nationkey", "c_mktsegment").distinct().select("c_mktsegment")


@query("SELECT o_orderkey, year(CAST(o_orderdate AS DATE)) AS year FROM orders WHERE year(CAST(o_orderdate AS DATE)) >= 1997")
def p_having_filter(spark, sf):
    # a HAVING on an alias, without grouping, is a filter after the projection
    year = F.year(F.col("o_orderdate").cast("date")).alias("year")
    return read(spark, sf, "orders").select("o_orderkey", year).filter(F.col("year") >= 1997)


# --- joins -------------------------------------------------------------------------------


@query(
    f"""WITH {O} SELECT o_orderkey, c_name, n_name FROM o JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey"""
)
def j_inner(spark, sf):
    return (
        orders(spark, sf)
        .join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "c_name", "n_name")
    )


@query("SELECT o_orderkey, o_orderstatus, l_linenumber FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey",
    nullable=('l_linenumber',),
)
def j_left(spark, sf):
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return (
        orders(spark, sf)
        .join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select("o_orderkey", "o_orderstatus", "l_linenumber")
    )


@query("SELECT c_custkey, o_orderkey FROM orders RIGHT JOIN customer ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'",
    nullable=('o_orderkey',),
)
def j_right(spark, sf):
    urgent = orders(spark, sf).filter(F.col("o_orderpriority") == "1-URGENT")
    return urgent.join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "right").select(
        "c_custkey", "o_orderkey"
    )


@query(
    """SELECT o_orderkey, l_linenumber FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R'
    AND l_linestatus <> ' '""",
    nullable=('l_linenumber',),
)
def j_left_const(spark, sf):
    li = read(spark, sf, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") != " "))
    return orders(spark, sf).join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "l_linenumber")


@query(
    """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    AND o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
    nullable=('o_orderkey',),
)
def j_left_latest(spark, sf):
    newest = membership.latest(orders(spark, sf), "o_date")
    return (
        read(spark, sf, "customer")
        .join(newest, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select("c_custkey", "o_orderkey")
    )


@query(
    """SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'"""
)
def j_outer_to_inner(spark, sf):
    return (
        orders(spark, sf)
        .join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .filter(F.col("c_mktsegment") == "BUILDING")
        .select("o_orderkey", "c_name")
    )


@query("SELECT p_partkey, r_name FROM part CROSS JOIN region")
def j_cross(spark, sf):
    parts = read(spark, sf, "part").select("p_partkey")
    return allocate.pair_with(parts, read(spark, sf, "region").select("r_name"))


@query(
    """SELECT c_custkey, n_name FROM customer JOIN nation ON upper(n_name) = 'NATION_' || c_nationkey"""
)
def j_expr_key(spark, sf):
    n = read(spark, sf, "nation").select(F.upper("n_name").alias("key"), "n_name")
    c = read(spark, sf, "customer").withColumn("key", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")))
    return c.join(n, "key").select("c_custkey", "n_name")


@query(
    """SELECT l_orderkey, l_linenumber, cn.n_name AS customer_nation, sn.n_name AS supplier_nation FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation cn ON cn.n_nationkey = c_nationkey JOIN nation sn ON sn.n_nationkey = s_nationkey"""
)
def j_roles(spark, sf):
    n = read(spark, sf, "nation")
    cn = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_nation"))
    sn = n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation"))
    c = read(spark, sf, "customer").join(cn, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "customer_nation")
    s = read(spark, sf, "supplier").join(sn, "s_nationkey").select(F.col("s_suppkey").alias("l_suppkey"), "supplier_nation")
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return (
        read(spark, sf, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_suppkey")
        .join(o, "l_orderkey")
        .join(c, "o_custkey")
        .join(s, "l_suppkey")
        .select("l_orderkey", "l_linenumber", "customer_nation", "supplier_nation")
    )


def _conditions(spark, sf):
    kinds = F.array(
        F.struct(F.lit("TAX").alias("kind"), F.col("tax").alias("value")),
        F.struct(F.lit("DISC").alias("kind"), F.when(F.col("disc") > 0, F.col("disc")).alias("value")),
    )
    rows = lines(spark, sf).select("l_orderkey", "l_linenumber", F.explode(kinds).alias("c"))
    return rows.select("l_orderkey", "l_linenumber", "c.kind", "c.value").filter(F.col("value").isNotNull())


@query(
    final(
        f"""WITH {L}, k AS (SELECT l_orderkey, l_linenumber, 'TAX' AS kind, tax AS value FROM li
        UNION ALL SELECT l_orderkey, l_linenumber, 'DISC', disc FROM li WHERE disc > 0)
    , lists AS (SELECT l_orderkey, l_linenumber, list(value) FILTER (WHERE kind = 'TAX') AS taxes,
        list(value) FILTER (WHERE kind = 'DISC') AS discs FROM k GROUP BY 1, 2),
    each_tax AS (SELECT l_orderkey, l_linenumber, unnest(taxes) AS tax_rate, discs FROM lists)
    SELECT l_orderkey, l_linenumber, tax_rate, unnest(discs) AS disc_rate FROM each_tax""",
        numbers=["tax_rate", "disc_rate"],
    )
)
def j_self_wide(spark, sf):
    return reshape.conditions_wide(
        _conditions(spark, sf),
        ["l_orderkey", "l_linenumber"],
        "kind",
        {"tax_rate": ("TAX", "value"), "disc_rate": ("DISC", "value")},
    )


@query(
    """SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""
)
def j_semi(spark, sf):
    c = read(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return orders(spark, sf).join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")


@query(
    """SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 5)
    OR l_suppkey IN (SELECT p_partkey FROM part WHERE p_size < 5)"""
)
def j_semi_or(spark, sf):
    small = read(spark, sf, "part").filter(F.col("p_size") < 5)
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return membership.in_any(li, ["l_partkey", "l_suppkey"], small, "p_partkey").select("l_orderkey", "l_linenumber")


_KEYS = "SELECT CASE WHEN c_custkey % 3 = 0 THEN c_custkey END AS k FROM customer"


@query(
    f"""SELECT o_orderkey, 'with null' AS list FROM orders WHERE o_custkey NOT IN ({_KEYS})
    UNION ALL SELECT o_orderkey, 'known' FROM orders WHERE CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END
        NOT IN ({_KEYS} WHERE c_custkey % 3 = 0)"""
)
def j_not_in(spark, sf):
    keys = read(spark, sf, "customer").select(F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey")).alias("k"))
    o = orders(spark, sf).select("o_orderkey", "o_custkey")
    some = o.withColumn("o_custkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")))
    with_null = membership.not_in(o, "o_custkey", keys, "k").withColumn("list", F.lit("with null"))
    known = membership.not_in(some, "o_custkey", keys.filter(F.col("k").isNotNull()), "k").withColumn("list", F.lit("known"))
    return with_null.unionByName(known).select("o_orderkey", "list")


@query("SELECT o_orderkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL")
def j_anti(spark, sf):
    return membership.anti(orders(spark, sf), read(spark, sf, "lineitem"), {"o_orderkey": "l_orderkey"}).select("o_orderkey")


@query(
    """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
    THEN 1 ELSE 0 END AS urgent FROM customer"""
)
def j_flag_in(spark, sf):
    urgent = orders(spark, sf).filter(F.col("o_orderpriority") == "1-URGENT")
    marked = membership.mark_in(read(spark, sf, "customer"), "c_custkey", urgent, "o_custkey", "hit")
    return marked.select("c_custkey", fn.flag(F.col("hit")).alias("urgent"))


@query(
    """SELECT 'inside' AS side, l_orderkey, l_linenumber FROM lineitem
    WHERE l_partkey % 50 IN (SELECT n_nationkey FROM nation) OR l_suppkey % 60 IN (SELECT n_nationkey FROM nation)
    UNION ALL SELECT 'outside', l_orderkey, l_linenumber FROM lineitem
    WHERE l_partkey % 50 NOT IN (SELECT n_nationkey FROM nation)
    AND CASE WHEN l_suppkey % 9 <> 0 THEN l_suppkey % 60 END NOT IN (SELECT n_nationkey FROM nation)"""
)
def j_membership_split(spark, sf):
    li = read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_partkey") % 50).alias("a"),
        (F.col("l_suppkey") % 60).alias("b"),
        "l_suppkey",
    )
    places = read(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("place"))
    inside = membership.in_any(li, ["a", "b"], places, "place")
    some = li.withColumn("b", F.when(F.col("l_suppkey") % 9 != 0, F.col("b")))
    _, outside = membership.split_by_membership(some, ["a", "b"], places, "place")
    cols = ["side", "l_orderkey", "l_linenumber"]
    return inside.withColumn("side", F.lit("inside")).select(*cols).unionByName(
        outside.withColumn("side", F.lit("outside")).select(*cols)
    )


@query(
    final(
        """SELECT o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n_lines,
        (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS n_suppliers FROM orders""",
        counts=["n_lines", "n_suppliers"],
    )
)
def j_corr_count(spark, sf):
    per = (
        read(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("l_suppkey").alias("n_suppliers"))
    )
    joined = orders(spark, sf).select("o_orderkey").join(per, "o_orderkey", "left")
    return joined.na.fill(0, ["n_lines", "n_suppliers"])


@query(
    final(
        f"""WITH {L} SELECT o_orderkey, (SELECT sum(qty) FROM li WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
        AS returned FROM orders""",
        numbers=["returned"],
    )
)
def j_corr_sum(spark, sf):
    per = validate.total_by(
        lines(spark, sf).filter(F.col("l_returnflag") == "R"), {"o_orderkey": "l_orderkey"}, "qty", "returned"
    )
    return orders(spark, sf).select("o_orderkey").join(per, "o_orderkey", "left")


@query(
    f"""WITH {O} SELECT o_orderkey, o_orderstatus FROM o WHERE o_date =
    (SELECT max(o_date) FROM o WHERE o_orderpriority = '2-HIGH')"""
)
def j_scalar_max(spark, sf):
    latest = membership.latest(orders(spark, sf), "o_date", where=F.col("o_orderpriority") == "2-HIGH")
    return latest.select("o_orderkey", "o_orderstatus")


# --- aggregation and windows ---------------------------------------------------------------


@query(
    final(
        f"""WITH {L} SELECT l_returnflag, l_linestatus, coalesce(sum(qty), 0) AS sum_qty, sum(price * (1 - disc)) AS revenue,
        sum(qty + tax) AS sum_both FROM li GROUP BY ALL""",
        numbers=["sum_qty", "revenue", "sum_both"],
    )
)
def a_sum(spark, sf):
    return (
        lines(spark, sf)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.coalesce(F.sum("qty"), F.lit(0)).alias("sum_qty"),
            F.sum(F.col("price") * (1 - F.col("disc"))).alias("revenue"),
            F.sum(F.col("qty") + F.col("tax")).alias("sum_both"),
        )
    )


@query(
    f"""WITH {L} SELECT p_brand, l_returnflag, round(CAST(CAST(sum(qty) AS DOUBLE) / count(qty) AS DECIMAL(28,6)), 4)::DOUBLE
    AS avg_qty FROM li JOIN part ON p_partkey = l_partkey GROUP BY 1, 2"""
)
def a_avg(spark, sf):
    mean = fn.quantity(fn.div0(F.sum("qty"), F.count("qty")))
    return (
        lines(spark, sf)
        .join(read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand", "l_returnflag")
        .agg(F.round(mean, 4).alias("avg_qty"))
    )


@query("SELECT o_custkey, count(o_orderkey) AS n_orders FROM orders GROUP BY 1")
def a_count(spark, sf):
    return orders(spark, sf).groupBy("o_custkey").agg(F.count("o_orderkey").alias("n_orders"))


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1")
def a_count_distinct(spark, sf):
    return read(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("n_parts"))


@query(
    final(
        f"""WITH {L}, t AS (SELECT l_orderkey, sum(price) AS total, count(*) FILTER (l_returnflag = 'R') AS n_returned
        FROM li GROUP BY 1) SELECT * FROM t WHERE total > 150000 AND n_returned > 0""",
        numbers=["total"],
    )
)
def a_having(spark, sf):
    li = lines(spark, sf)
    totals = li.groupBy("l_orderkey").agg(F.sum("price").alias("total")).filter(F.col("total") > 150000)
    returned = validate.flag_count(li, ["l_orderkey"], F.col("l_returnflag") == "R", "n_returned")
    return totals.join(returned, "l_orderkey")


@query(
    f"""WITH {O} SELECT o_custkey, CASE WHEN sum(CASE WHEN o_orderkey % 2 = 0 THEN o_amount ELSE -o_amount END) = 0
    THEN 'ZERO' ELSE 'BALANCE' END AS verdict FROM o GROUP BY 1"""
)
def a_flag(spark, sf):
    o = orders(spark, sf).withColumn("amount", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_amount")).otherwise(-F.col("o_amount")))
    return reconcile.key_verdicts(o, "o_custkey", "amount", verdict="verdict").select("o_custkey", "verdict")


@query(
    final(
        f"""WITH {L} SELECT l_returnflag, sum(t) AS total FROM (SELECT l_returnflag, l_suppkey, round(sum(price * disc), 0) AS t
        FROM li GROUP BY 1, 2) AS x GROUP BY 1""",
        numbers=["total"],
    )
)
def a_two_level(spark, sf):
    inner = lines(spark, sf).groupBy("l_returnflag", "l_suppkey").agg(F.round(F.sum(F.col("price") * F.col("disc")), 0).alias("t"))
    return inner.groupBy("l_returnflag").agg(F.sum("t").alias("total"))


@query(
    final(
        f"""WITH {L} SELECT l_suppkey, l_linenumber, round(CAST(sum(price) AS DECIMAL(38,10)) * CAST(l_linenumber * 0.01 AS DECIMAL(9,6)), 2)
        AS weighed FROM li GROUP BY 1, 2""",
        numbers=["weighed"],
    )
)
def a_factor(spark, sf):
    totals = allocate.subtotal(lines(spark, sf), ["l_suppkey", "l_linenumber"], F.col("price"), "total")
    weighed = allocate.weigh(totals, F.col("total"), F.col("l_linenumber"), 2)
    return totals.select("l_suppkey", "l_linenumber", weighed.alias("weighed"))


@query(
    final(
        f"""WITH {L}, d AS (SELECT s_nationkey AS nation, l_day AS day, sum(qty) AS qty FROM li
        JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2)
    SELECT nation, day, qty, sum(qty) OVER (PARTITION BY nation ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS running FROM d""",
        ["day"],
        ["qty", "running"],
    )
)
def w_running_sum(spark, sf):
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    daily = lines(spark, sf).join(s, "l_suppkey").groupBy("nation", F.col("l_day").alias("day")).agg(F.sum("qty").alias("qty"))
    return spine.running_balance(daily, ["nation"], "day", {"running": F.col("qty")})


@query(
    final(
        f"""WITH {L}, d AS (SELECT s_nationkey AS nation, l_returnflag AS flag, l_day AS day, sum(qty) AS qty, sum(tax) AS tax
        FROM li JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2, 3)
    SELECT nation, flag, day, sum(qty - tax) OVER (PARTITION BY nation, flag ORDER BY day
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM d""",
        ["day"],
        ["running"],
    )
)
def w_running_sum_2key(spark, sf):
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    daily = (
        lines(spark, sf)
        .join(s, "l_suppkey")
        .groupBy("nation", F.col("l_returnflag").alias("flag"), F.col("l_day").alias("day"))
        .agg(F.sum("qty").alias("qty"), F.sum("tax").alias("tax"))
    )
    out = spine.running_balance(daily, ["nation", "flag"], "day", {"running": F.col("qty") - F.col("tax")})
    return out.select("nation", "flag", "day", "running")


@query(
    """SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'F'"""
)
def u_union_all(spark, sf):
    li = read(spark, sf, "lineitem")
    cols = ["l_orderkey", "l_linenumber"]
    return li.filter(F.col("l_returnflag") == "R").select(*cols).unionByName(
        li.filter(F.col("l_linestatus") == "F").select(*cols)
    )


@query(
    """SELECT l_suppkey AS supplier, l_partkey AS part FROM lineitem WHERE l_returnflag = 'R'
    UNION SELECT s_suppkey, s_suppkey % 40 FROM supplier"""
)
def u_union(spark, sf):
    returned = read(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    suppliers = read(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("supplier"), (F.col("s_suppkey") % 40).alias("part")
    )
    return reconcile.union_distinct(
        returned.select(F.col("l_suppkey").alias("supplier"), F.col("l_partkey").alias("part")), suppliers
    )


@query(
    """SELECT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R'
    UNION SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linestatus = 'F'"""
)
def u_union_one_table(spark, sf):
    # Both parts read one table, so the union is one filter.
    li = read(spark, sf, "lineitem")
    keep = (F.col("l_returnflag") == "R") | (F.col("l_linestatus") == "F")
    return reconcile.consolidate(li, keep, ["l_orderkey", "l_partkey"])


@query(final(f"WITH {L} SELECT l_suppkey, sum(price) AS total FROM li GROUP BY 1 ORDER BY 1", numbers=["total"]))
def o_sorted(spark, sf):
    return lines(spark, sf).groupBy("l_suppkey").agg(F.sum("price").alias("total")).orderBy("l_suppkey")


# --- scalar functions ------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done,
    CASE WHEN o_totalprice < 1000 THEN 'low' WHEN o_totalprice < 100000 THEN 'mid' ELSE 'high' END AS band,
    CASE WHEN o_orderpriority LIKE '1%' THEN 'A' WHEN o_orderpriority LIKE '2%' THEN 'B' END AS grade,
    coalesce(CASE WHEN o_orderpriority LIKE '3%' THEN o_orderpriority END, '-') AS filled FROM orders"""
)
def f_conditional(spark, sf):
    price, pri = F.col("o_totalprice"), F.col("o_orderpriority")
    return read(spark, sf, "orders").select(
        "o_orderkey",
        fn.flag(F.col("o_orderstatus") == "F").alias("done"),
        F.when(price < 1000, "low").when(price < 100000, "mid").otherwise("high").alias("band"),
        F.when(pri.like("1%"), "A").when(pri.like("2%"), "B").alias("grade"),
        F.coalesce(F.when(pri.like("3%"), pri), F.lit("-")).alias("filled"),
    )


@query(
    final(
        f"""WITH {L} SELECT l_orderkey, l_linenumber, {div0('price', 'disc * 100')} AS ratio, round(price, 0) AS whole,
        round(price * disc, 2) AS cents, -1 * qty AS negative, CAST(price * disc AS DECIMAL(18,0)) AS units,
        CAST(price * tax AS DECIMAL(13,4)) AS fine FROM li""",
        numbers=["ratio", "whole", "cents", "negative", "units", "fine"],
    )
)
def f_numeric(spark, sf):
    c = F.col
    return lines(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        fn.div0(c("price"), c("disc") * 100).alias("ratio"),
        F.round(c("price"), 0).alias("whole"),
        F.round(c("price") * c("disc"), 2).alias("cents"),
        (c("qty") * -1).alias("negative"),
        (c("price") * c("disc")).cast("decimal(18,0)").alias("units"),
        (c("price") * c("tax")).cast("decimal(13,4)").alias("fine"),
    )


@query(
    f"""WITH {O} SELECT o_orderkey, upper(c_mktsegment) || '/' || c_name AS joined, lpad(CAST(o_orderkey AS VARCHAR), 3, '0') AS padded,
    left(c_name, 4) AS head, right(c_name, 3) AS tail, substr(c_name, 1, 2) AS sub0, substr(c_name, 3, 5) AS sub3,
    length(c_name) AS size, strpos(c_name, '#') AS hash_at, replace(CAST(o_amount AS VARCHAR), '.', ',') AS comma,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE c_name END || '!' AS nullable
    FROM o JOIN customer ON c_custkey = o_custkey"""
)
def f_string(spark, sf):
    c = F.col
    name = c("c_name")
    return (
        orders(spark, sf)
        .join(read(spark, sf, "customer"), c("o_custkey") == c("c_custkey"))
        .select(
            "o_orderkey",
            F.concat(F.upper("c_mktsegment"), F.lit("/"), name).alias("joined"),
            F.lpad(c("o_orderkey").cast("string"), 3, "0").alias("padded"),
            F.left(name, F.lit(4)).alias("head"),
            F.right(name, F.lit(3)).alias("tail"),
            F.substring(name, 0, 2).alias("sub0"),
            F.substring(name, 3, 5).alias("sub3"),
            F.length(name).cast("bigint").alias("size"),
            F.instr(name, "#").cast("bigint").alias("hash_at"),
            fn.comma_decimal(c("o_amount")).alias("comma"),
            F.concat(F.when(c("o_orderkey") % 3 != 0, name), F.lit("!")).alias("nullable"),
        )
    )


@query(
    f"""WITH {O}, d AS (SELECT *, CASE WHEN o_orderkey % 97 = 0 THEN '00000000' WHEN o_orderkey % 89 = 0 THEN '19991399'
        ELSE o_digits END AS digits FROM o)
    SELECT o_orderkey, CAST(CAST(try_strptime(digits, '%Y%m%d') AS DATE) AS VARCHAR) AS parsed, CAST(o_date + 7 AS VARCHAR) AS plus,
    CAST(o_date - 3 AS VARCHAR) AS minus, DATE '1998-01-01' - o_date AS days, year(o_date) AS y, month(o_date) AS m,
    strftime(o_date, '%Y-%m-%d') AS text FROM d"""
)
def f_date(spark, sf):
    key = F.col("o_orderkey")
    digits = F.when(key % 97 == 0, "00000000").when(key % 89 == 0, "19991399").otherwise(F.col("o_digits"))
    day = F.col("o_date")
    return orders(spark, sf).select(
        "o_orderkey",
        fn.parse_yyyymmdd(digits).alias("parsed"),
        F.date_add(day, 7).alias("plus"),
        F.date_sub(day, 3).alias("minus"),
        fn.ageing_days(day, AS_OF).cast("bigint").alias("days"),
        F.year(day).cast("bigint").alias("y"),
        F.month(day).cast("bigint").alias("m"),
        F.date_format(day, "yyyy-MM-dd").alias("text"),
    )


@query(
    """WITH t AS (SELECT o_orderkey, lpad(CAST(o_orderkey * 7 % 250000 AS VARCHAR), 6, '0') AS s FROM orders)
    SELECT o_orderkey, CASE WHEN CAST(left(s, 2) AS INTEGER) < 24 AND CAST(substr(s, 3, 2) AS INTEGER) < 60
    AND CAST(right(s, 2) AS INTEGER) < 60 THEN left(s, 2) || ':' || substr(s, 3, 2) || ':' || right(s, 2) END AS clock FROM t"""
)
def f_time(spark, sf):
    text = F.lpad((F.col("o_orderkey") * 7 % 250000).cast("string"), 6, "0")
    return read(spark, sf, "orders").select("o_orderkey", fn.digits_to_time(text).alias("clock"))


# --- spines and capacity -----------------------------------------------------------------------

_DAYS = "days AS (SELECT DATE '1998-01-01' + CAST(i AS INTEGER) AS date FROM range(31) AS r(i))"


@query(
    final(
        f"WITH {O}, {_DAYS} SELECT date, count(o_orderkey) AS n_orders FROM days LEFT JOIN o ON o_date = date GROUP BY 1",
        ["date"],
    )
)
def c_spine(spark, sf):
    days = spine.date_spine(spark, AS_OF)
    per_day = orders(spark, sf).groupBy(F.col("o_date").alias("date")).agg(F.count("o_orderkey").alias("n_orders"))
    return days.join(per_day, "date", "left").na.fill(0, ["n_orders"])


@query(final(f"WITH {_DAYS} SELECT DISTINCT date, c_custkey FROM days CROSS JOIN customer", ["date"]))
def c_densify(spark, sf):
    return spine.densify(read(spark, sf, "customer"), ["c_custkey"], AS_OF)


@query(final(f"WITH {_DAYS} SELECT date, s_nationkey, s_suppkey, s_acctbal FROM days CROSS JOIN supplier", ["date"]))
def c_spread(spark, sf):
    return spine.spread_over(read(spark, sf, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal"), AS_OF)


@query(
    """SELECT p_partkey, p_brand, v.pieces FROM part JOIN (VALUES ('Brand#1', 11616), ('Brand#2', 9504), ('Brand#3', 289800))
    AS v(b, pieces) ON v.b = p_brand"""
)
def c_lookup(spark, sf):
    table = inline(spark, ["p_brand", "pieces"], [("Brand#1", 11616), ("Brand#2", 9504), ("Brand#3", 289800)])
    return read(spark, sf, "part").join(table, "p_brand").select("p_partkey", "p_brand", "pieces")


@query(
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'HOUSE' WHEN 'HOUSEHOLD' THEN 'HOUSE' ELSE c_mktsegment END
    AS segment FROM customer"""
)
def c_remap(spark, sf):
    seg = fn.remap(F.col("c_mktsegment"), {"BUILDING": "HOUSE", "HOUSEHOLD": "HOUSE"})
    return read(spark, sf, "customer").select("c_custkey", seg.alias("segment"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR)
    ELSE lpad(CAST(o_custkey AS VARCHAR), 10, '0') END AS code FROM orders"""
)
def c_pad_key(spark, sf):
    code = fn.pad_key(F.col("o_custkey").cast("string"), F.col("o_orderstatus"), "F", 10)
    return read(spark, sf, "orders").select("o_orderkey", code.alias("code"))


@query(
    final(
        f"""WITH {L} SELECT l_orderkey, l_linenumber, {qty(div0('qty', 'p_size - 10'))} AS units FROM li
        JOIN part ON p_partkey = l_partkey""",
        numbers=["units"],
    )
)
def c_to_units(spark, sf):
    units = fn.quantity(fn.div0(F.col("qty"), F.col("p_size") - 10))
    return (
        lines(spark, sf)
        .join(read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", "l_linenumber", units.alias("units"))
    )


@query(
    final(
        f"""WITH {L} SELECT l_suppkey, coalesce(sum(CASE WHEN l_returnflag = 'R' THEN qty END), 0) AS returned,
        coalesce(sum(CASE WHEN l_returnflag = 'A' THEN qty END), 0) AS accepted FROM li
        WHERE l_returnflag IN ('R', 'A') GROUP BY 1""",
        numbers=["returned", "accepted"],
    )
)
def c_category_columns(spark, sf):
    return reshape.category_columns(
        lines(spark, sf), ["l_suppkey"], "l_returnflag", {"returned": "R", "accepted": "A"}, F.col("qty")
    )


@query(
    final(
        f"""WITH {L}, x AS (SELECT c_nationkey AS a, s_nationkey AS b, qty FROM li JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey)
    SELECT place, sum(qty) AS qty FROM (SELECT a AS place, qty FROM x UNION ALL SELECT b, qty FROM x) AS u
    WHERE place IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) GROUP BY 1""",
        numbers=["qty"],
    )
)
def c_alt_key_stack(spark, sf):
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("a"))
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("b"))
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    x = lines(spark, sf).select("l_orderkey", "l_suppkey", "qty").join(o, "l_orderkey").join(c, "o_custkey").join(s, "l_suppkey")
    places = read(spark, sf, "nation").filter(F.col("n_regionkey") == 1)
    stacked = reshape.stack_by_alt_key(x, ["a", "b"], places, "n_nationkey", "place")
    return stacked.groupBy("place").agg(F.sum("qty").alias("qty"))


@query(
    final(
        f"""WITH {L}, {O} SELECT l_orderkey, l_linenumber, l_day AS date, qty * 1000 AS quantity FROM li
        JOIN o ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
        WHERE l_day BETWEEN DATE '1998-01-01' AND DATE '1998-01-31' AND l_returnflag <> 'R' AND o_orderpriority <> '1-URGENT'
        AND p_type LIKE 'S%'""",
        ["date"],
        ["quantity"],
    )
)
def c_due_lines(spark, sf):
    end = AS_OF + dt.timedelta(days=30)
    due = lines(spark, sf).filter(F.col("l_day").between(F.lit(AS_OF), F.lit(end)) & (F.col("l_returnflag") != "R"))
    o = read(spark, sf, "orders").filter(F.col("o_orderpriority") != "1-URGENT").select(F.col("o_orderkey").alias("l_orderkey"))
    p = read(spark, sf, "part").filter(F.col("p_type").startswith("S")).select(F.col("p_partkey").alias("l_partkey"))
    return (
        due.join(o, "l_orderkey")
        .join(p, "l_partkey")
        .select("l_orderkey", "l_linenumber", F.col("l_day").alias("date"), (F.col("qty") * 1000).alias("quantity"))
    )


@query(
    final(
        f"""WITH {L}, {_DAYS}, made AS (SELECT l_suppkey AS s, l_returnflag AS f, l_day AS date, CAST(sum(qty) AS DECIMAL(28,6)) AS q FROM li
        WHERE l_day BETWEEN DATE '1998-01-01' AND DATE '1998-01-31' GROUP BY 1, 2, 3),
    means AS (SELECT s, f, CAST(CAST(sum(q) AS DOUBLE) / count(q) AS DECIMAL(28,6)) AS m FROM made GROUP BY 1, 2)
    SELECT DISTINCT d.date, n.s AS supplier, CAST(coalesce(q, m) AS DECIMAL(28,6)) AS q FROM days d
    CROSS JOIN (SELECT DISTINCT l_suppkey AS s FROM lineitem) n JOIN means ON means.s = n.s
    LEFT JOIN made ON made.s = n.s AND made.date = d.date""",
        ["date"],
        ["q"],
    )
)
def c_impute_mean(spark, sf):
    li = lines(spark, sf).withColumnRenamed("l_suppkey", "supplier")
    grid = spine.densify(li, ["supplier"], AS_OF)
    end = AS_OF + dt.timedelta(days=30)
    made = (
        li.filter(F.col("l_day").between(F.lit(AS_OF), F.lit(end)))
        .groupBy("supplier", "l_returnflag", F.col("l_day").alias("date"))
        .agg(fn.quantity(F.sum("qty")).alias("q"))
    )
    means = made.groupBy("supplier", "l_returnflag").agg(fn.quantity(fn.div0(F.sum("q"), F.count("q"))).alias("m"))
    return membership.impute_mean(grid, made, means, ["date", "supplier"], ["supplier"], "q", "m").select("date", "supplier", "q")


@query(
    final(
        f"""WITH {L}, d AS (SELECT l_suppkey AS s, l_day AS date, sum(CASE WHEN l_returnflag = 'R' THEN qty ELSE -qty END) AS c
        FROM li GROUP BY 1, 2),
    r AS (SELECT s, date, sum(c) OVER (PARTITION BY s ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance FROM d)
    SELECT s, date, balance, {div0('balance', 'CAST(s_acctbal AS DECIMAL(18,2))')} AS occupancy FROM r
    JOIN supplier ON s_suppkey = s""",
        ["date"],
        ["balance", "occupancy"],
    )
)
def c_occupancy(spark, sf):
    change = fn.signed(F.col("qty"), F.col("l_returnflag"), "R")
    daily = lines(spark, sf).groupBy(F.col("l_suppkey").alias("s"), F.col("l_day").alias("date")).agg(F.sum(change).alias("c"))
    run = spine.running_balance(daily, ["s"], "date", {"balance": F.col("c")})
    cap = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("s"), fn.money(F.col("s_acctbal")).alias("cap"))
    return run.join(cap, "s").select("s", "date", "balance", fn.div0(F.col("balance"), F.col("cap")).alias("occupancy"))


# --- ledger ------------------------------------------------------------------------------------


@query(
    final(
        f"""WITH {L} SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN price ELSE -price END AS amount FROM li""",
        numbers=["amount"],
    )
)
def c_signed(spark, sf):
    amount = fn.signed(F.col("price"), F.col("l_returnflag"), "R")
    return lines(spark, sf).select("l_orderkey", "l_linenumber", amount.alias("amount"))


@query(
    f"""WITH {O}, a AS (SELECT o_orderkey, DATE '2001-08-01' - o_date AS days FROM o)
    SELECT *, CASE WHEN days < 30 THEN 'Current' WHEN days = 30 THEN 'Over 30 Days' WHEN days <= 59 THEN '31-59 Days'
    WHEN days <= 90 THEN '60-90 Days*' ELSE 'Over 91 Days*' END AS bucket FROM a"""
)
def c_ageing(spark, sf):
    days = fn.ageing_days(F.col("o_date"), "2001-08-01")
    return orders(spark, sf).select("o_orderkey", days.cast("bigint").alias("days"), fn.ageing_bucket(days).alias("bucket"))


@query(
    f"""WITH {O} SELECT o_orderkey, year(o_date) || '/' || month(o_date) AS month_key,
    CASE WHEN strftime(o_date, '%Y%m') = '199801' THEN 1 ELSE 0 END AS this_month,
    CASE WHEN strftime(o_date, '%Y%m') = '199712' THEN 1 ELSE 0 END AS previous_month FROM o"""
)
def c_month_filter(spark, sf):
    day = F.col("o_date")
    return orders(spark, sf).select(
        "o_orderkey",
        fn.month_key(day).alias("month_key"),
        fn.flag(fn.in_month(day, "1998-01-15")).alias("this_month"),
        fn.flag(fn.in_month(day, "1998-01-15", -1)).alias("previous_month"),
    )


_REF = "CASE o_orderkey % 4 WHEN 0 THEN 'DEBIT NOTE ' WHEN 1 THEN 'ND ' WHEN 2 THEN 'NC ' ELSE '' END || o_orderkey"


@query(
    f"""SELECT o_orderkey, regexp_replace({_REF}, '^(DEBIT NOTE |ND )', '') AS debit,
    regexp_replace({_REF}, '^NC ', '') AS credit FROM orders"""
)
def c_strip_prefix(spark, sf):
    kind = F.col("o_orderkey") % 4
    head = F.when(kind == 0, "DEBIT NOTE ").when(kind == 1, "ND ").when(kind == 2, "NC ").otherwise("")
    ref = F.concat(head, F.col("o_orderkey").cast("string"))
    return read(spark, sf, "orders").select(
        "o_orderkey",
        fn.strip_prefix(ref, ("DEBIT NOTE ", "ND ")).alias("debit"),
        fn.strip_prefix(ref, ("NC ",)).alias("credit"),
    )


def ledger(spark, sf):
    """Two opposite lines per order; a third of the orders balance, a third are off by 0.05."""
    key = F.col("o_orderkey")
    off = F.when((key % 3 == 2) & (F.col("n") == 2), F.lit("0.05").cast("decimal(3,2)")).otherwise(F.lit("0.00").cast("decimal(3,2)"))
    rows = orders(spark, sf).withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).filter((key % 3 != 1) | (F.col("n") == 1))
    return rows.select(
        F.col("o_orderkey").alias("doc"),
        F.col("n").alias("line"),
        F.when(key % 13 == 0, " ").otherwise(F.concat(F.lit("R"), key.cast("string"))).alias("reference"),
        F.when(key % 11 != 0, F.concat(F.lit("T"), key.cast("string"))).alias("text"),
        (F.when(F.col("n") == 1, F.col("o_amount")).otherwise(-F.col("o_amount")) + off).alias("amount"),
    )


LEDGER = f"""{O}, led AS (SELECT o_orderkey AS doc, n AS line, CASE WHEN o_orderkey % 13 = 0 THEN ' ' ELSE 'R' || o_orderkey END AS reference,
    CASE WHEN o_orderkey % 11 <> 0 THEN 'T' || o_orderkey END AS text,
    CASE WHEN n = 1 THEN o_amount ELSE -o_amount END + CASE WHEN o_orderkey % 3 = 2 AND n = 2 THEN 0.05 ELSE 0 END AS amount
    FROM o CROSS JOIN (VALUES (1), (2)) AS v(n) WHERE o_orderkey % 3 <> 1 OR n = 1)"""
_BY_REF = """r AS (SELECT led.*, CASE WHEN sum(amount) OVER (PARTITION BY reference) = 0 THEN 'ZERO' ELSE 'BALANCE' END AS verdict FROM led)"""
_BY_TEXT = """t AS (SELECT led.*, CASE WHEN abs(sum(amount) OVER (PARTITION BY text)) <= 0.1 THEN 'ZERO' ELSE 'BALANCE' END AS verdict
    FROM led WHERE text IS NOT NULL)"""


@query(final(f"WITH {LEDGER}, {_BY_REF} SELECT * FROM r", numbers=["amount"]))
def c_net_to_zero(spark, sf):
    return reconcile.net_to_zero(ledger(spark, sf), "reference", "amount", verdict="verdict")


@query(final(f"WITH {LEDGER}, {_BY_TEXT} SELECT * FROM t", numbers=["amount"]))
def c_net_tolerance(spark, sf):
    return reconcile.net_to_zero(ledger(spark, sf), "text", "amount", tol="0.1", verdict="verdict")


def _stacked(spark, sf):
    rules = [
        reconcile.ClearingRule("Reference", F.col("reference")),
        reconcile.ClearingRule("Text", F.col("text"), tol="0.1"),
    ]
    return reconcile.judge_by_rules(ledger(spark, sf), rules, "amount", "verdict", "rule").drop("rule_no")


_STAGED = f"{LEDGER}, {_BY_REF}, {_BY_TEXT}, s AS (SELECT *, 'Reference' AS rule FROM r UNION ALL SELECT *, 'Text' FROM t)"


@query(
    final(
        f"""WITH {_STAGED} SELECT *, CASE WHEN verdict = 'ZERO' THEN 'cleared' ELSE 'open' END AS half FROM s""", numbers=["amount"]
    )
)
def c_staged_clearing(spark, sf):
    half = F.when(F.col("verdict") == "ZERO", "cleared").otherwise("open")
    return _stacked(spark, sf).withColumn("half", half)


@query(
    final(
        f"""WITH {_STAGED}, k AS (SELECT *, max(CASE WHEN verdict = 'ZERO' THEN 1 ELSE 0 END) OVER (PARTITION BY doc, line) AS hit
        FROM s) SELECT * EXCLUDE (hit) FROM k WHERE hit = 0""",
        numbers=["amount"],
    )
)
def c_uncleared(spark, sf):
    cleared, still_open = reconcile.staged_clearing(stage(_stacked(spark, sf), "clearing"), "verdict")
    mark = F.concat(F.col("doc").cast("string"), F.lit("/"))
    return reconcile.uncleared(
        still_open.withColumn("d", mark), cleared.withColumn("d", mark), ["d", "line"]
    ).drop("d")


@query(
    f"""WITH {_STAGED} SELECT doc FROM s GROUP BY doc HAVING count(*) FILTER (WHERE verdict = 'ZERO') = 0"""
)
def c_uncleared_keys(spark, sf):
    return reconcile.uncleared_keys(_stacked(spark, sf), ["doc"], "verdict")


# --- invoices -----------------------------------------------------------------------------------


@query(
    final(
        f"""WITH {L} SELECT l_orderkey, l_linenumber, price, sum(price) OVER (PARTITION BY l_orderkey) AS order_price,
        sum(tax) OVER (PARTITION BY l_orderkey) AS order_tax FROM li""",
        numbers=["price", "order_price", "order_tax"],
    )
)
def c_header_totals(spark, sf):
    li = lines(spark, sf).select("l_orderkey", "l_linenumber", "price", "tax")
    out = reshape.with_header_totals(li, ["l_orderkey"], {"order_price": F.col("price"), "order_tax": F.col("tax")})
    return out.drop("tax")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '43' END || lpad(CAST(o_custkey AS VARCHAR), 14, '0')
    || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS access_key FROM orders"""
)
def c_access_key(spark, sf):
    key = F.col("o_orderkey")
    parts = [
        F.when(key % 5 != 0, "43"),
        F.lpad(F.col("o_custkey").cast("string"), 14, "0"),
        F.lpad(key.cast("string"), 9, "0"),
    ]
    return read(spark, sf, "orders").select("o_orderkey", fn.access_key(*parts).alias("access_key"))


@query(
    """WITH t AS (SELECT c_custkey, lpad(CAST(c_custkey * 7919 AS VARCHAR), 14, '0') AS s FROM customer)
    SELECT c_custkey, substr(s, 1, 2) || '.' || substr(s, 3, 3) || '.' || substr(s, 6, 3) || '/' || substr(s, 9, 4) || '-'
    || substr(s, 13, 2) AS masked FROM t"""
)
def c_mask_id(spark, sf):
    digits = F.lpad((F.col("c_custkey") * 7919).cast("string"), 14, "0")
    return read(spark, sf, "customer").select("c_custkey", fn.mask_tax_id(digits).alias("masked"))


@query(
    f"""WITH {L}, v AS (SELECT l_orderkey, l_linenumber, CAST(price * l_linenumber * l_linenumber * 100 AS DECIMAL(18,2)) AS x FROM li),
    s AS (SELECT *, CAST(x AS VARCHAR) AS t FROM v), p AS (SELECT *, split_part(t, '.', 1) AS whole FROM s)
    SELECT l_orderkey, l_linenumber, CASE WHEN length(whole) > 6 THEN left(whole, length(whole) - 6) || '.'
        || substr(whole, length(whole) - 5, 3) || '.' || right(whole, 3)
    WHEN length(whole) > 3 THEN left(whole, length(whole) - 3) || '.' || right(whole, 3) ELSE whole END || ',' || split_part(t, '.', 2)
    AS proper, replace(t, '.', ',') AS plain FROM p"""
)
def c_format_ptbr(spark, sf):
    x = (F.col("price") * F.col("l_linenumber") * F.col("l_linenumber") * 100).cast("decimal(18,2)")
    return lines(spark, sf).select(
        "l_orderkey", "l_linenumber", fn.format_ptbr(x).alias("proper"), fn.comma_decimal(x).alias("plain")
    )


@query(
    f"""WITH {L}, t AS (SELECT l_orderkey, l_linenumber, replace(CAST(CAST(price * l_linenumber * 10 - 50000 AS DECIMAL(18,2)) AS VARCHAR),
        '.', ',') AS plain FROM li) SELECT l_orderkey, l_linenumber, {ptbr('plain', False)} AS last_two, {ptbr('plain', True)} AS by_width FROM t"""
)
def c_format_ptbr_compat(spark, sf):
    plain = fn.comma_decimal((F.col("price") * F.col("l_linenumber") * 10 - 50000).cast("decimal(18,2)"))
    return lines(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        fn.format_ptbr_compat(plain).alias("last_two"),
        fn.format_ptbr_compat(plain, tail_by_width=True).alias("by_width"),
    )


@query(
    final(
        f"""WITH {L} SELECT l_orderkey, l_linenumber, CASE WHEN left(CAST(l_partkey AS VARCHAR), 1) IN ('3', '4') THEN 0 ELSE tax END
        AS rate FROM li""",
        numbers=["rate"],
    )
)
def c_override(spark, sf):
    zero = F.lit(0).cast("decimal(4,2)")
    rate = fn.override_by_prefix(F.col("l_partkey").cast("string"), F.col("tax"), ("3", "4"), zero)
    return lines(spark, sf).select("l_orderkey", "l_linenumber", rate.alias("rate"))


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN s_name ELSE c_name END AS party FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey"""
)
def c_party_choice(spark, sf):
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    c = read(spark, sf, "customer").select("c_custkey", "c_name")
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    party = fn.choose(F.col("l_returnflag") == "R", F.col("s_name"), F.col("c_name"))
    return (
        read(spark, sf, "lineitem")
        .join(o, "l_orderkey")
        .join(c, "c_custkey")
        .join(s, "l_suppkey")
        .select("l_orderkey", "l_linenumber", party.alias("party"))
    )


@query(
    f"""WITH {O} SELECT o_orderkey, o_custkey, o_orderstatus FROM o WHERE o_date = DATE '1997-12-29'
    AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""
)
def c_snapshot(spark, sf):
    day = membership.snapshot_day(orders(spark, sf), "o_date", AS_OF)
    kept = membership.in_domain(day, "o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM"))
    return kept.select("o_orderkey", "o_custkey", "o_orderstatus")


def altered(spark, sf):
    """Orders as a second system sees them: some missing, some changed."""
    key = F.col("o_orderkey")
    cent = F.when(key % 7 == 0, "0.06").when(key % 7 == 1, "0.05").otherwise("0.00").cast("decimal(3,2)")
    return (
        orders(spark, sf)
        .filter(key % 17 != 13)
        .select(
            F.when(key % 17 == 14, -key).otherwise(key).alias("b_key"),
            F.concat(F.col("o_custkey").cast("string"), F.lit("-"), key.cast("string")).alias("b_alt"),
            (F.col("o_amount") + cent).alias("b_amount"),
            F.when(key % 19 == 0, F.date_add("o_date", 5)).otherwise(F.col("o_date")).alias("b_date"),
        )
    )


ALTERED = f"""{O}, b AS (SELECT CASE WHEN o_orderkey % 17 = 14 THEN -o_orderkey ELSE o_orderkey END AS b_key,
    o_custkey || '-' || o_orderkey AS b_alt,
    o_amount + CASE o_orderkey % 7 WHEN 0 THEN 0.06 WHEN 1 THEN 0.05 ELSE 0 END AS b_amount,
    CASE WHEN o_orderkey % 19 = 0 THEN o_date + 5 ELSE o_date END AS b_date FROM o WHERE o_orderkey % 17 <> 13),
    a AS (SELECT o_orderkey AS a_key, o_custkey || '-' || o_orderkey AS a_alt, o_amount AS a_amount, o_date AS a_date FROM o)"""


def own(spark, sf):
    return orders(spark, sf).select(
        F.col("o_orderkey").alias("a_key"),
        F.concat(F.col("o_custkey").cast("string"), F.lit("-"), F.col("o_orderkey").cast("string")).alias("a_alt"),
        F.col("o_amount").alias("a_amount"),
        F.col("o_date").alias("a_date"),
    )


def rules() -> list[validate.Rule]:
    return [
        validate.Rule("e1", fn.outside_tolerance(F.col("a_amount") - F.col("b_amount"), "0.05"), "amount. "),
        validate.Rule("e2", F.col("a_date") != F.col("b_date"), "date. "),
        validate.Rule("e3", F.col("b_key").isNull() & (F.col("e1") == 0), "missing. "),
    ]


_FLAGS = """CASE WHEN abs(a_amount - b_amount) > 0.05 THEN 1 ELSE 0 END AS e1, CASE WHEN a_date <> b_date THEN 1 ELSE 0 END AS e2,
    CASE WHEN b_key IS NULL THEN 1 ELSE 0 END AS e3"""
_VALID = f"""{ALTERED}, f AS (SELECT a_key, {_FLAGS} FROM a LEFT JOIN b ON b_key = a_key),
    v AS (SELECT *, e1 + e2 + e3 AS error_count, CASE WHEN e1 = 1 THEN 'amount. ' ELSE '' END ||
    CASE WHEN e2 = 1 THEN 'date. ' ELSE '' END || CASE WHEN e3 = 1 THEN 'missing. ' ELSE '' END AS message FROM f)"""


def _validated(spark, sf):
    pairs = own(spark, sf).join(altered(spark, sf), F.col("a_key") == F.col("b_key"), "left")
    return validate.validate(pairs, rules())


@query(f"WITH {_VALID} SELECT * FROM v")
def c_validate(spark, sf):
    return _validated(spark, sf).select("a_key", "e1", "e2", "e3", "error_count", "message")


_STATUS = "CASE WHEN e3 = 1 THEN 'not loaded' WHEN error_count <> 0 THEN 'faulty' ELSE 'correct' END AS status"


def _judged(spark, sf):
    status = validate.status_verdict(F.col("e3") == 1, F.col("error_count"), ("not loaded", "faulty", "correct"))
    return _validated(spark, sf).withColumn("status", status)


@query(f"WITH {_VALID} SELECT a_key, {_STATUS} FROM v")
def c_status(spark, sf):
    return _judged(spark, sf).select("a_key", "status")


_MATCHED = f"""{ALTERED}, m AS (SELECT a_key, b_key, b_amount FROM a LEFT JOIN b ON b_key = a_key
    UNION SELECT a_key, b_key, b_amount FROM a JOIN b ON b_alt = a_alt)"""


def _matched(spark, sf):
    return reconcile.match_with_fallback(
        own(spark, sf), altered(spark, sf), {"a_key": "b_key"}, {"a_alt": "b_alt"}, ["a_key", "b_key", "b_amount"]
    )


@query(final(f"WITH {_MATCHED} SELECT * FROM m", numbers=["b_amount"]),
    nullable=('b_key',),
)
def c_match_fallback(spark, sf):
    return _matched(spark, sf)


@query(f"WITH {_MATCHED} SELECT DISTINCT a_key, b_key FROM m WHERE b_key IS NOT NULL OR a_key % 17 = 13",
    nullable=('b_key',),
)
def c_consolidate(spark, sf):
    keep = F.col("b_key").isNotNull() | (F.col("a_key") % 17 == 13)
    return reconcile.consolidate(_matched(spark, sf), keep, ["a_key", "b_key"])


@query(
    f"""WITH {ALTERED} SELECT DISTINCT a_key, a_alt FROM a LEFT JOIN b ON b_key = a_key WHERE b_key IS NULL"""
)
def c_missing_keys(spark, sf):
    return membership.anti(own(spark, sf), altered(spark, sf), {"a_key": "b_key"}).select("a_key", "a_alt").distinct()


@query(
    final(
        f"""WITH {L} SELECT l_orderkey, l_linenumber, price - price * disc - price * tax - 0.25 AS net_revenue,
        price + price * disc AS sales_and_rebate FROM li""",
        numbers=["net_revenue", "sales_and_rebate"],
    )
)
def c_net_revenue(spark, sf):
    price = F.col("price")
    fee = F.lit("0.25").cast("decimal(3,2)")
    return lines(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        fn.net_of(price, price * F.col("disc"), price * F.col("tax"), fee).alias("net_revenue"),
        (price + price * F.col("disc")).alias("sales_and_rebate"),
    )


@query(
    final(
        f"""WITH {ALTERED} SELECT a_key, b_key, a_amount - b_amount AS difference FROM a JOIN b ON b_key = a_key AND b_date = a_date
        WHERE a_amount - b_amount BETWEEN -0.05 AND 0.05""",
        numbers=["difference"],
    )
)
def c_tolerant_match(spark, sf):
    return reconcile.tolerant_match(
        own(spark, sf), altered(spark, sf), {"a_key": "b_key", "a_date": "b_date"}, "a_amount", "b_amount", "0.05"
    ).select("a_key", "b_key", "difference")


_ENRICHED = f"""{ALTERED}, e AS (SELECT a_key, CASE WHEN b_key IS NULL OR p_brand = 'Brand#1' THEN 'ACERTO CTB'
        WHEN left(p_type, 1) IN ('S', 'L') THEN p_type ELSE 'OTHER' END AS product,
    CASE WHEN b_key IS NULL OR p_brand = 'Brand#1' THEN 0 ELSE p_size END AS quantity,
    CASE WHEN b_key IS NULL OR p_brand = 'Brand#1' THEN a_amount ELSE b_amount END AS revenue, a_amount AS amount
    FROM a LEFT JOIN b ON b_key = a_key
    LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS pk FROM lineitem GROUP BY 1) ON l_orderkey = b_key LEFT JOIN part ON p_partkey = pk)"""


def _enriched(spark, sf):
    part = read(spark, sf, "part").select(F.col("p_partkey").alias("pk"), "p_brand", "p_type", "p_size")
    first = read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("b_key")).agg(F.min("l_partkey").alias("pk"))
    sold = altered(spark, sf).join(first, "b_key", "left").join(part, "pk", "left")
    sold = sold.select(F.col("b_key").alias("a_key"), "b_amount", "p_brand", "p_type", "p_size", F.lit(True).alias("hit"))
    missing = F.col("hit").isNull() | (F.col("p_brand") == "Brand#1")
    kind = reconcile.product_class(F.col("p_type"), ("S", "L"))
    return reconcile.enrich_or_default(
        own(spark, sf).withColumnRenamed("a_amount", "amount"),
        sold,
        ["a_key"],
        {
            "product": (F.lit("ACERTO CTB"), kind),
            "quantity": (F.lit(0), F.col("p_size")),
            "revenue": (F.col("amount"), F.col("b_amount")),
        },
        missing,
    ).select("a_key", "product", "quantity", "revenue", "amount")


@query(final(f"WITH {_ENRICHED} SELECT * FROM e", numbers=["quantity", "revenue", "amount"]))
def c_enrich_default(spark, sf):
    return _enriched(spark, sf).withColumn("quantity", F.col("quantity").cast("double"))


@query(
    final(
        f"""WITH {_ENRICHED} SELECT CASE WHEN left(product, 1) IN ('8', '9', 'A') THEN product ELSE 'OTHER' END AS product,
        sum(quantity) AS sum_quantity, sum(revenue) AS sum_revenue,
        round(CAST({div0('sum(revenue)', 'sum(quantity)')} AS DECIMAL(28,6)), 2) AS average_cost FROM e GROUP BY 1""",
        numbers=["sum_revenue", "average_cost"],
        counts=["sum_quantity"],
    )
)
def c_class_summary(spark, sf):
    return reconcile.summarise_by_class(
        _enriched(spark, sf), "product", {"sum_quantity": "quantity", "sum_revenue": "revenue"}, "sum_quantity", "sum_revenue"
    )


_CLASSES = """k AS (SELECT CASE WHEN p_size % 7 = 0 THEN 'A' || p_size WHEN p_size % 11 <> 0 THEN CAST(p_size AS VARCHAR) END AS product,
    p_partkey % 9 AS quantity, CAST(p_retailprice AS DECIMAL(18,2)) AS revenue FROM part)"""


@query(
    final(
        f"""WITH {_CLASSES} SELECT CASE WHEN left(product, 1) IN ('8', '9', 'A') THEN product ELSE 'OTHER' END AS product,
        sum(quantity) AS sum_quantity, sum(revenue) AS sum_revenue,
        round(CAST({div0('sum(revenue)', 'sum(quantity)')} AS DECIMAL(28,6)), 2) AS average_cost FROM k GROUP BY 1""",
        numbers=["sum_revenue", "average_cost"],
        counts=["sum_quantity"],
    )
)
def c_class_summary_kept(spark, sf):
    size = F.col("p_size")
    product = F.when(size % 7 == 0, F.concat(F.lit("A"), size.cast("string"))).when(size % 11 != 0, size.cast("string"))
    rows = read(spark, sf, "part").select(
        product.alias("product"), (F.col("p_partkey") % 9).alias("quantity"), fn.money(F.col("p_retailprice")).alias("revenue")
    )
    sums = {"sum_quantity": "quantity", "sum_revenue": "revenue"}
    return reconcile.summarise_by_class(rows, "product", sums, "sum_quantity", "sum_revenue")


# --- completeness and allocation -------------------------------------------------------------------

_SHARES = """sh AS (SELECT p_partkey AS part, n.k AS k, CAST(CASE WHEN p_partkey % 4 = 1 THEN 49 ELSE 50 END AS DECIMAL(7,2)) AS pct
    FROM part CROSS JOIN (VALUES (0), (1)) AS n(k) WHERE p_partkey % 4 <> 2)"""


def shares(spark, sf):
    key = F.col("part")
    rows = read(spark, sf, "part").select(F.col("p_partkey").alias("part"), F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    pct = F.when(key % 4 == 1, 49).otherwise(50).cast("decimal(7,2)")
    return rows.filter(key % 4 != 2).withColumn("pct", pct)


@query(
    final(
        f"""WITH {_SHARES} SELECT p_partkey AS part, sum(pct) AS total, CASE WHEN round(sum(pct), 0) = 100 THEN 1 ELSE 0 END AS complete
        FROM part LEFT JOIN sh ON part = p_partkey GROUP BY 1""",
        numbers=["total"],
    )
)
def c_check_sum100(spark, sf):
    totals = validate.total_by(shares(spark, sf), {"part": "part"}, "pct", "total")
    parts = read(spark, sf, "part").select(F.col("p_partkey").alias("part"))
    return parts.join(totals, "part", "left").withColumn("complete", validate.sums_to(F.col("total")))


@query(
    f"""WITH {_SHARES} SELECT p_partkey AS part, CASE WHEN p_partkey IN (SELECT part FROM sh) THEN 1 ELSE 0 END AS present FROM part"""
)
def c_check_present(spark, sf):
    totals = validate.total_by(shares(spark, sf), {"part": "part"}, "pct", "total")
    parts = read(spark, sf, "part").select(F.col("p_partkey").alias("part"))
    return parts.join(totals, "part", "left").select("part", validate.is_present(F.col("total")).alias("present"))


@query(
    final(
        """WITH a AS (SELECT l_suppkey AS s, count(DISTINCT l_returnflag) AS n, sum(l_linenumber) AS t FROM lineitem GROUP BY 1),
        w AS (SELECT s_nationkey AS k, count(s_suppkey) AS m FROM supplier GROUP BY 1)
    SELECT s_suppkey, coalesce(n, 0) AS assigned, coalesce(m, 0) AS available,
        CASE WHEN coalesce(n, 0) = coalesce(m, 0) AND t IS NOT NULL THEN 1 ELSE 0 END AS complete FROM supplier
    LEFT JOIN a ON a.s = s_suppkey LEFT JOIN w ON w.k = s_nationkey""",
        counts=["assigned", "available"],
    )
)
def c_check_counts(spark, sf):
    a = (
        read(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("s_suppkey"))
        .agg(F.countDistinct("l_returnflag").alias("assigned"), F.sum("l_linenumber").alias("total"))
    )
    s = read(spark, sf, "supplier")
    w = s.groupBy("s_nationkey").agg(F.count("s_suppkey").alias("available"))
    df = s.join(a, "s_suppkey", "left").join(w, "s_nationkey", "left").na.fill(0, ["assigned", "available"])
    check = validate.counts_match(F.col("assigned"), F.col("available"), F.col("total"))
    return df.select("s_suppkey", "assigned", "available", check.alias("complete"))


@query(
    f"""WITH t AS (SELECT l_suppkey AS s, count(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 END) AS part_n,
        count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS whole_n FROM lineitem GROUP BY 1)
    SELECT s, part_n, whole_n, CASE WHEN whole_n = 0 THEN 1.0::DOUBLE ELSE round(part_n / whole_n, 2) END AS ratio,
    CASE WHEN whole_n = 0 OR part_n = whole_n THEN 1 ELSE 0 END AS complete FROM t"""
)
def c_check_ratio(spark, sf):
    returned = F.col("l_returnflag") == "R"
    t = (
        read(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("s"))
        .agg(
            F.count(F.when(returned & (F.col("l_linestatus") == "F"), 1)).alias("part_n"),
            F.count(F.when(returned, 1)).alias("whole_n"),
        )
    )
    a, b = F.col("part_n"), F.col("whole_n")
    return t.withColumn("ratio", validate.coverage(a, b)).withColumn("complete", validate.fully_covered(a, b))


@query(
    """SELECT DISTINCT s_suppkey, s_name, n_name, l_partkey FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN nation ON n_nationkey = s_nationkey WHERE n_name IS NOT NULL"""
)
def c_check_detail(spark, sf):
    n = read(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    s = read(spark, sf, "supplier").join(n, "s_nationkey").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "n_name")
    pairs = read(spark, sf, "lineitem").select("l_suppkey", "l_partkey").distinct()
    return pairs.join(s, "l_suppkey").select(F.col("l_suppkey").alias("s_suppkey"), "s_name", "n_name", "l_partkey")


_PCT = "CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 60 WHEN 2 THEN 33.25 ELSE 100 END"


def _costs(spark, sf):
    m = F.col("o_custkey") % 4
    pct = F.when(m == 1, F.lit("60")).when(m == 2, F.lit("33.25")).when(m == 3, F.lit("100")).cast("decimal(7,2)")
    p2 = F.when(F.col("o_orderkey") % 5 != 0, (F.col("o_orderkey") % 5 * 20).cast("decimal(7,2)"))
    return orders(spark, sf).withColumns({"pct": pct, "p2": p2})


_COSTS = f"""{O}, c AS (SELECT o_orderkey, o_custkey, o_amount AS amount,
    coalesce({_PCT}, 0) * 0.01 AS f1, {_PCT} AS pct,
    CAST(o_orderkey % 5 AS DECIMAL(3,0)) * 20 * 0.01 AS f2 FROM o)"""


@query(final(f"WITH {_COSTS} SELECT o_orderkey, amount * f1 * f2 AS share FROM c", numbers=["share"]))
def c_allocate(spark, sf):
    df = _costs(spark, sf)
    return df.select("o_orderkey", fn.charge_share(df, F.col("o_amount"), F.col("pct"), F.col("p2")).alias("share"))


@query(
    final(
        f"""WITH {_COSTS} SELECT o_orderkey, amount * f1 AS app, amount * (1 - f1) AS service,
        CASE WHEN pct IS NULL THEN 0 ELSE 1 END AS complete FROM c""",
        numbers=["app", "service"],
    )
)
def c_split_cost(spark, sf):
    df = _costs(spark, sf)
    app, service = allocate.split_cost(df, F.col("o_amount"), F.col("pct"))
    return df.select(
        "o_orderkey", app.alias("app"), service.alias("service"), fn.flag(F.col("pct").isNotNull()).alias("complete")
    )


@query(
    final(
        f"""WITH {_COSTS} SELECT o_orderkey, n_name, amount * f1 * f2 AS share, amount * f1 AS center, 100 - amount * f1 * f2 AS rest
        FROM c JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE pct IS NOT NULL""",
        numbers=["share", "center", "rest"],
    )
)
def c_cost_report(spark, sf):
    n = read(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    c = read(spark, sf, "customer").join(n, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "n_name")
    df = _costs(spark, sf)
    share = fn.charge_share(df, F.col("o_amount"), F.col("pct"), F.col("p2"))
    return (
        df
        .filter(F.col("pct").isNotNull())
        .join(c, "o_custkey")
        .select(
            "o_orderkey",
            "n_name",
            share.alias("share"),
            fn.charge_share(df, F.col("o_amount"), F.col("pct")).alias("center"),
            (100 - share).alias("rest"),
        )
    )


@query(
    """SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_values FROM orders GROUP BY 1
    HAVING count(DISTINCT o_orderpriority) > 1"""
)
def c_multi_owner(spark, sf):
    return validate.multi_valued(read(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", "n_values")


@query(
    final(f"WITH {_COSTS} SELECT o_custkey, sum(amount * f1 * f2) AS total FROM c GROUP BY 1 HAVING sum(amount * f1 * f2) = 0", numbers=["total"])
)
def c_zero_total(spark, sf):
    df = _costs(spark, sf)
    share = fn.charge_share(df, F.col("o_amount"), F.col("pct"), F.col("p2"))
    return validate.zero_total(df, ["o_custkey"], share, "total")


_REGIONAL = f"""{_COSTS}, t AS (SELECT o_custkey AS cust, sum(amount * f1) AS total FROM c GROUP BY 1),
    rp AS (SELECT r_regionkey AS region, CAST(10 + 5 * r_regionkey AS DECIMAL(7,2)) AS pct FROM region),
    w AS (SELECT cust, region, total, total * (pct * 0.01) AS amt FROM t CROSS JOIN rp)"""


def _regional(spark, sf):
    costs = _costs(spark, sf).withColumnRenamed("o_custkey", "cust")
    totals = allocate.subtotal(costs, ["cust"], fn.charge_share(costs, F.col("o_amount"), F.col("pct")), "total")
    rp = read(spark, sf, "region").select(
        F.col("r_regionkey").alias("region"), (10 + 5 * F.col("r_regionkey")).cast("decimal(7,2)").alias("rpct")
    )
    return allocate.pair_with(totals, rp)


@query(final(f"WITH {_REGIONAL} SELECT cust, region, round(amt, 2) AS amt FROM w", numbers=["amt"]))
def c_regional(spark, sf):
    df = _regional(spark, sf)
    return df.select("cust", "region", allocate.weigh(df, F.col("total"), F.col("rpct"), 2).alias("amt"))


@query(
    final(
        f"""WITH {_REGIONAL} SELECT cust % 10 AS owner, region, sum(amt) AS amt FROM w GROUP BY 1, 2""", numbers=["amt"]
    )
)
def c_shared_cost(spark, sf):
    df = _regional(spark, sf)
    weighed = df.withColumn("amt", allocate.weigh(df, F.col("total"), F.col("rpct")))
    return weighed.groupBy((F.col("cust") % 10).alias("owner"), "region").agg(F.sum("amt").alias("amt"))


@query(
    final(f"WITH {_REGIONAL} SELECT region, round(sum(round(amt, 2)), 2) AS amt FROM w GROUP BY 1", numbers=["amt"])
)
def c_shared_total(spark, sf):
    df = _regional(spark, sf)
    weighed = df.withColumn("amt", allocate.weigh(df, F.col("total"), F.col("rpct"), 2))
    return weighed.groupBy("region").agg(F.round(F.sum("amt"), 2).alias("amt"))


@query(
    final(
        f"""WITH {_REGIONAL} SELECT t.cust, r.r_name, x.amt FROM t CROSS JOIN region r
        LEFT JOIN w x ON x.cust = t.cust AND x.region = r.r_regionkey AND r.r_regionkey <> 2""",
        numbers=["amt"],
    )
)
def c_shared_by_region(spark, sf):
    df = _regional(spark, sf)
    weighed = df.select(
        "cust", F.col("region").alias("r_regionkey"), allocate.weigh(df, F.col("total"), F.col("rpct")).alias("amt")
    )
    grid = allocate.pair_with(
        weighed.select("cust").distinct(), read(spark, sf, "region").select("r_regionkey", "r_name")
    )
    kept = weighed.filter(F.col("r_regionkey") != 2)
    return grid.join(kept, ["cust", "r_regionkey"], "left").select("cust", "r_name", "amt")


@query(
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END, '') || 'shared' || o_custkey AS pk FROM orders"""
)
def c_text_key(spark, sf):
    part = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus"))
    return read(spark, sf, "orders").select(
        "o_orderkey", fn.text_key(part, F.lit("shared"), F.col("o_custkey")).alias("pk")
    )


@query(
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
    AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))"""
)
def c_in_domain(spark, sf):
    c = membership.in_domain(read(spark, sf, "customer"), "c_mktsegment", ("BUILDING", "MACHINERY"))
    o = membership.in_domain(read(spark, sf, "orders"), "o_orderpriority", ("1-URGENT", "5-LOW"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_orderpriority")


@query(
    """SELECT l_orderkey, count(*) AS n_returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1"""
)
def c_flag_count(spark, sf):
    return validate.flag_count(read(spark, sf, "lineitem"), ["l_orderkey"], F.col("l_returnflag") == "R", "n_returned")
