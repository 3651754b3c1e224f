import datetime as dt
import decimal
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyworks.functions import charge_share
from tallyworks.operators import allocate, membership, reconcile, reshape, skew, spine, validate
from tallyworks.session import tune


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("listed", [[1, 2], [1, None], [], [None]])
def test_not_in_follows_sql(spark, listed):
    left = spark.createDataFrame([(1,), (3,), (None,)], "a int")
    right = spark.createDataFrame([(v,) for v in listed], "k int")
    left.createOrReplaceTempView("not_in_left")
    right.createOrReplaceTempView("not_in_right")
    expected = spark.sql("SELECT * FROM not_in_left WHERE a NOT IN (SELECT k FROM not_in_right)")
    assert rows(membership.not_in(left, "a", right, "k")) == rows(expected)


def test_sides_of_a_location_list_leave_out_unknowns(spark):
    df = spark.createDataFrame([(1, 9), (9, 2), (9, 9), (9, None), (None, None), (1, None)], "a int, b int")
    places = spark.createDataFrame([(1,), (2,)], "k int")
    inside, outside = membership.split_by_membership(df, ["a", "b"], places, "k")
    assert rows(inside) == Counter([(1, 9), (9, 2), (1, None)])
    assert rows(outside) == Counter([(9, 9)])
    with_null = places.unionByName(spark.createDataFrame([(None,)], "k int"))
    assert membership.split_by_membership(df, ["a", "b"], with_null, "k")[1].count() == 0


def test_conditions_with_repeats_give_all_combinations(spark):
    data = [(1, "A", 10), (1, "B", 20), (2, "A", 11), (3, "A", 1), (3, "A", 2), (3, "B", 3), (3, "B", 4), (3, "C", 9)]
    df = spark.createDataFrame(data, "k int, kind string, v int")
    got = rows(reshape.conditions_wide(df, ["k"], "kind", {"a": ("A", "v"), "b": ("B", "v")}))
    by = defaultdict(lambda: defaultdict(list))
    for k, kind, v in data:
        by[k][kind].append(v)
    expected = Counter((k, a, b) for k, kinds in by.items() for a, b in itertools.product(kinds["A"], kinds["B"]))
    assert got == expected


def test_conditions_are_read_once_and_not_joined(spark):
    data = [(1, "A", 10), (1, "B", 20), (None, "A", 1), (None, "B", 2), (2, "A", None), (2, "B", 5), (2, "B", None), (4, "B", 1)]
    df = spark.createDataFrame(data, "k int, kind string, v int")
    wide = reshape.conditions_wide(df, ["k"], "kind", {"a": ("A", "v"), "b": ("B", "v"), "b2": ("B", "v")})
    assert rows(wide) == Counter([(1, 10, 20, 20), (2, None, 5, 5), (2, None, None, None)])
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("LogicalRDD") == 1
    lists = reshape.kind_lists(df, ["k"], "kind", {"a": ("A", ["v"]), "b": ("B", ["v"])})
    found = lists.select("k", F.explode(reshape.combinations({"x": ("a", "v"), "y": ("b", "v")})).alias("c")).select("k", "c.*")
    assert rows(found.filter("k IS NOT NULL")) == rows(wide.drop("b2"))


def test_category_columns_ignore_other_categories(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, "y", None), (2, "z", 7)], "k int, c string, v int")
    got = rows(reshape.category_columns(df, ["k"], "c", {"x": "x", "y": "y"}, F.col("v")))
    assert got == Counter([(1, 5, 0)])


def test_alternative_keys_count_twice(spark):
    df = spark.createDataFrame([("p", "q", 1), ("p", "z", 2), (None, "q", 4)], "a string, b string, v int")
    places = spark.createDataFrame([("p",), ("q",)], "k string")
    got = reshape.stack_by_alt_key(df, ["a", "b"], places, "k", "place").groupBy("place").agg(F.sum("v").alias("v"))
    assert rows(got) == Counter([("p", 3), ("q", 5)])


def test_imputation_uses_distinct_group_means(spark):
    day = dt.date(2024, 1, 1)
    grid = spine.densify(spark.createDataFrame([("P",), ("Q",)], "plant string"), ["plant"], day, 1)
    observed = spark.createDataFrame(
        [(day, "P", "g1", 4.0), (day, "P", "g2", 4.0), (day, "P", "g3", 6.0)], "date date, plant string, g string, v double"
    )
    means = observed.groupBy("plant", "g").agg(F.avg("v").alias("m"))
    got = rows(membership.impute_mean(grid, observed, means, ["date", "plant"], ["plant"], "v", "m").select("date", "plant", "v"))
    later = day + dt.timedelta(days=1)
    assert got == Counter([(day, "P", 4.0), (day, "P", 6.0), (later, "P", 4.0), (later, "P", 6.0)])


def test_spine_and_running_balance(spark):
    day = dt.date(2024, 2, 28)
    assert [r[0] for r in spine.date_spine(spark, day, 2).orderBy("date").collect()] == [
        dt.date(2024, 2, 28),
        dt.date(2024, 2, 29),
        dt.date(2024, 3, 1),
    ]
    df = spine.spread_over(spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int"), day, 2)
    got = spine.running_balance(df, ["k"], "date", {"total": F.col("v")}).orderBy("k", "date")
    assert [r["total"] for r in got.collect()] == [2, 4, 6, 3, 6, 9]


def test_net_to_zero_and_staged_clearing(spark):
    data = [(1, "r", "t1", 5), (2, "r", "t2", -5), (3, "s", "t3", 7), (4, "s", "t3", -6), (5, None, "t3", -1), (6, "u", None, 2)]
    df = spark.createDataFrame(data, "id int, ref string, text string, amt int")
    df = df.withColumn("amt", F.col("amt").cast("decimal(10,2)"))
    by_ref = reconcile.net_to_zero(df, "ref", "amt")
    by_text = reconcile.net_to_zero(df, "text", "amt", tol="0.1")
    assert {r["id"]: r["balance_result"] for r in by_ref.collect()} == {1: "ZERO", 2: "ZERO", 3: "BALANCE", 4: "BALANCE", 6: "BALANCE"}
    assert {r["id"] for r in by_text.filter("balance_result = 'ZERO'").collect()} == {3, 4, 5}
    rules = [reconcile.ClearingRule("Reference", F.col("ref")), reconcile.ClearingRule("Text", F.col("text"), tol="0.1")]
    judged = reconcile.judge_by_rules(df, rules, "amt")
    both = by_ref.select(*df.columns, "balance_result", F.lit("Reference")).union(by_text.select(*df.columns, "balance_result", F.lit("Text")))
    assert rows(judged.drop("rule_no")) == rows(both)
    cleared, still_open = reconcile.staged_clearing(judged)
    assert cleared.count() + still_open.count() == by_ref.count() + by_text.count()
    left = reconcile.uncleared(still_open, cleared, ["id"])
    assert {r["id"] for r in left.collect()} == {6}
    assert {r["id"] for r in reconcile.uncleared_keys(judged, ["id"]).collect()} == {6}


def test_rules_sum_what_counts_and_show_what_is_asked(spark):
    data = [("n", "a", 3), ("x", "a", -3), ("x", "b", 1), (None, "b", -1), ("n", None, 4), ("x", None, None), ("x", "c", None)]
    df = spark.createDataFrame(data, "kind string, key string, amt int").withColumn("amt", F.col("amt").cast("decimal(9,2)"))
    kind = F.col("kind")
    rules = [
        reconcile.ClearingRule("all", F.col("key"), shown=kind != "n"),
        reconcile.ClearingRule("notes", F.col("key"), counts=kind == "n", tol="3"),
    ]
    judged = reconcile.judge_by_rules(df, rules, "amt", "v", "r")
    got = Counter((r.r, r.kind, r.key, r.v) for r in judged.collect())
    assert got == Counter([("all", "x", "a", "ZERO"), ("all", "x", "b", "ZERO"), ("all", "x", "c", "BALANCE"), ("notes", "n", "a", "ZERO")])
    one_pass = judged._jdf.queryExecution().optimizedPlan().toString()
    assert one_pass.count("Aggregate") == 1


def test_uncleared_with_a_null_key_keeps_nothing(spark):
    still_open = spark.createDataFrame([("a", "1"), ("b", None)], "x string, y string")
    cleared = spark.createDataFrame([("c", "1")], "x string, y string")
    assert rows(reconcile.uncleared(still_open, cleared, ["x", "y"])) == Counter([("a", "1")])
    with_null = cleared.unionByName(spark.createDataFrame([("d", None)], "x string, y string"))
    assert reconcile.uncleared(still_open, with_null, ["x", "y"]).count() == 0


def test_match_with_fallback_against_loops(spark):
    a = [(1, "p"), (2, "q"), (3, "r"), (None, "s")]
    b = [(1, "p"), (9, "q"), (3, "z"), (None, "s")]
    left = spark.createDataFrame(a, "a1 int, a2 string")
    right = spark.createDataFrame(b, "b1 int, b2 string")
    got = rows(reconcile.match_with_fallback(left, right, {"a1": "b1"}, {"a2": "b2"}, ["a1", "a2", "b1", "b2"]))
    expected = set()
    for x in a:
        hits = [y for y in b if x[0] is not None and x[0] == y[0]]
        expected |= {x + y for y in hits} or {x + (None, None)}
        expected |= {x + y for y in b if x[1] == y[1]}
    assert got == Counter(expected)


def test_rules_count_and_explain(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (3, None)], "a int, b int")
    rules = [
        validate.Rule("e1", F.col("a") != 1, "one. "),
        validate.Rule("e2", (F.col("b") == 5) & (F.col("e1") == 0), "two. "),
    ]
    got = [tuple(r) for r in validate.validate(df, rules).select("e1", "e2", "error_count", "message").collect()]
    assert got == [(0, 1, 1, "two. "), (0, 1, 1, "two. "), (1, 0, 1, "one. ")]


def test_checks(spark):
    df = spark.createDataFrame([(100.2, 1, 2), (99.4, 2, 2), (None, 0, 0)], "t double, p bigint, w bigint")
    got = df.select(
        validate.sums_to(F.col("t")),
        validate.is_present(F.col("t")),
        validate.coverage(F.col("p"), F.col("w")),
        validate.fully_covered(F.col("p"), F.col("w")),
        validate.counts_match(F.col("p"), F.col("w"), F.col("t")),
    )
    assert [tuple(r) for r in got.collect()] == [(1, 1, 0.5, 0, 0), (0, 1, 1.0, 1, 1), (0, 0, 1.0, 1, 0)]


def test_pair_with_is_the_product(spark):
    left, right = spark.range(7).toDF("a"), spark.range(40).toDF("b")
    assert rows(allocate.pair_with(left, right)) == rows(left.crossJoin(right))


def test_pair_with_keeps_repeated_rows(spark):
    left = spark.createDataFrame([(1,), (1,)], "a int")
    right = spark.createDataFrame([("x",), ("x",), (None,)], "b string")
    assert rows(allocate.pair_with(left, right)) == Counter({(1, "x"): 4, (1, None): 2})


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    tune(spark)
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


N = 400_000
K7 = sum(1 for i in range(7, N, 50_000) if i % 3)  # rows of the one key the list lacks


@pytest.mark.parametrize(
    ("name", "expected"), [("net", N), ("mark", N), ("not_in", K7), ("anti", K7), ("header", N)]
)
def test_a_key_with_a_third_of_the_rows_is_split(skewed, name, expected):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50000).cast("string")))
    df = skewed.range(0, N, 1, 16).select(
        key.alias("key"),
        (F.col("id") % 7 - 3).cast("decimal(18,2)").alias("amt"),
        F.sha2(F.col("id").cast("string"), 256).alias("pay"),
    )
    other = df.filter(F.col("key") != "k7").select(F.col("key").alias("other_key"))
    result = {
        "net": lambda: reconcile.net_to_zero(df, "key", "amt"),
        "mark": lambda: membership.mark_in(df, "key", other, "other_key", "hit"),
        "not_in": lambda: membership.not_in(df, "key", other, "other_key"),
        "anti": lambda: membership.anti(df, other, {"key": "other_key"}),
        "header": lambda: reshape.with_header_totals(df, ["key"], {"t": F.col("amt")}),
    }[name]()
    total = result.agg(F.count("key").alias("n"), F.max("pay"))
    assert total.collect()[0]["n"] == expected
    assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()


def test_group_apart_equals_group_by(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (None, "b", 3), (None, "b", 4)], "k int, g string, v int")
    apart = skew.group_apart(df, ["k", "g"], {"s": F.sum("v")})
    assert rows(apart) == rows(df.groupBy("k", "g").agg(F.sum("v")))
    assert rows(skew.distinct_keys(df, F.col("k"))) == Counter([(1,)])


def test_shares_keep_every_digit(spark):
    """Costs with four places, percentages with six, one above 1000, and wide types, against Python's decimals."""
    D = decimal.Decimal
    rows_ = [("1234567.8901", "33.333333", "12.5"), ("0.0001", "0.000001", "100"), ("-5.5555", "1234.567891", "99.9"), ("7.0000", None, "3")]
    data = [(D(a), None if p is None else D(p), D(q)) for a, p, q in rows_]
    for kinds in ("decimal(18,4), p decimal(10,6), q decimal(5,2)", "decimal(24,4), p decimal(38,6), q decimal(9,4)"):
        df = spark.createDataFrame(data, f"a {kinds}")
        got = df.select(
            "a", "p", "q", charge_share(df, F.col("a"), F.col("p"), F.col("q")).alias("share"), *[
                c.alias(n) for n, c in zip(("part", "rest"), allocate.split_cost(df, F.col("a"), F.col("p")))
            ], allocate.factor_of(df, F.col("p")).alias("f"), allocate.weigh(df, F.col("a"), F.col("p"), 2).alias("w")
        ).collect()
        with decimal.localcontext(prec=60):
            for r in got:
                p = r.p or D(0)
                assert r.share == r.a * p * r.q / 10000
                assert r.part == r.a * p / 100 and r.part + r.rest == r.a
                assert r.f == (None if r.p is None else p / 100)
                assert r.w == (None if r.p is None else (r.a * p / 100).quantize(D("0.01"), decimal.ROUND_HALF_UP))


def test_shares_of_sums_and_of_other_types(spark):
    df = spark.createDataFrame([(10, 2.5, "7"), (20, 0.5, "9")], "i int, d double, t string")
    share = charge_share(df, F.col("i"), F.col("d"))
    assert [float(r[0]) for r in df.select(share).collect()] == [0.25, 0.1]
    assert [float(r[0]) for r in df.select(charge_share(df, F.col("t"), F.col("i"))).collect()] == [0.7, 1.8]
    wide = spark.createDataFrame([(decimal.Decimal("123456789012.1234"), decimal.Decimal("12.345678"))] * 3, "a decimal(18,4), p decimal(9,6)")
    total = wide.groupBy("p").agg(F.sum(charge_share(wide, F.col("a"), F.col("p"), F.col("p"))).alias("s"))
    got = total.select(allocate.weigh(total, F.col("s"), F.col("p"), 2)).first()[0]
    with decimal.localcontext(prec=60):
        exact = 3 * decimal.Decimal("123456789012.1234") * decimal.Decimal("0.12345678") ** 3
        assert got == exact.quantize(decimal.Decimal("0.01"), decimal.ROUND_HALF_UP)


@pytest.mark.parametrize(("left", "right", "tasks", "sides"), [(1000, 10, 64, (64, 1)), (100, 100, 64, (8, 8)), (0, 0, 4, (2, 2)), (1, 10**9, 16, (1, 16))])
def test_grid_follows_the_sizes(left, right, tasks, sides):
    assert allocate.grid_sides(left, right, tasks) == sides


def test_large_dimension_is_dealt_over_a_grid(skewed):
    left, right = skewed.range(300).toDF("a"), skewed.range(500).select(F.col("id").alias("b"), F.lit("x").alias("c"))
    both = allocate.pair_with(left, right, tasks=36)
    assert both.count() == 150_000 and both.distinct().count() == 150_000
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and not re.search("NestedLoop|Cartesian|BroadcastHash", plan)
    cells = allocate.in_grid(left, right, *allocate.grid_sides(300, 500, 36))[0].select("_row", "_column").distinct().count()
    assert cells > 8


def test_small_dimension_copies_no_rows(spark):
    both = allocate.pair_with(spark.range(7).toDF("a"), spark.range(3).select(F.col("id").alias("b c")))
    assert "Join" not in both._jdf.queryExecution().optimizedPlan().toString()
    assert both.columns == ["a", "b c"] and both.count() == 21
    assert allocate.pair_with(spark.range(7).toDF("a"), spark.range(0).toDF("b")).count() == 0


def test_band_join_gives_the_pairs_within_tolerance(spark):
    rng = random.Random(5)
    sales = [(rng.choice("ab"), decimal.Decimal(rng.randrange(-400, 400)) / 100) for _ in range(150)] + [("a", None), (None, decimal.Decimal(1))]
    ledger = [(rng.choice("ab"), decimal.Decimal(rng.randrange(-400, 400)) / 100) for _ in range(150)] + [("b", None), (None, decimal.Decimal(1))]
    for kind in ("decimal(12,2)", "double"):
        s = spark.createDataFrame(sales, "k string, x decimal(12,2)").withColumn("x", F.col("x").cast(kind))
        l = spark.createDataFrame(ledger, "r string, y decimal(12,2)").withColumn("y", F.col("y").cast(kind))
        for tol in ("0.1", "0.03", "0"):
            got = rows(reconcile.tolerant_match(s, l, {"k": "r"}, "x", "y", tol=tol).select("k", "x", "y"))
            num = decimal.Decimal if kind != "double" else float
            bound = num(tol)
            expected = Counter(
                (a, num(x), num(y)) for a, x in sales for b, y in ledger if a and a == b and None not in (x, y) and abs(num(x) - num(y)) <= bound
            )
            assert got == expected, (kind, tol)


def test_hot_reference_does_not_pair_all_with_all(spark):
    n = 10_000
    side = spark.range(n).select(F.lit("").alias("ref"), (F.col("id") / 4).cast("decimal(12,2)").alias("amt"))
    sales, ledger = side.toDF("nota", "s_amt"), side.toDF("ref", "l_amt")
    s, l = reconcile.in_bands(sales, ledger, "s_amt", "l_amt", "0.1")
    met = s.join(l, (F.col("nota") == F.col("ref")) & (F.col("_sale_band") == F.col("_ledger_band"))).count()
    assert n <= met <= 3 * n
    assert reconcile.tolerant_match(sales, ledger, {"nota": "ref"}, "s_amt", "l_amt").count() == n


def test_running_balance_in_blocks_is_one_window(spark):
    rng = random.Random(2)
    data = [(rng.choice(["p", "q", None]), rng.choice([1, 2, 3, None]), i, rng.choice([None, 1, -2, 5])) for i in range(200)]
    data += [("n", 1, 900, None), ("n", 2, 901, None), ("n", 3, 902, 4)]
    df = spark.createDataFrame(data, "k string, day int, seq int, v int").withColumn("v", F.col("v").cast("decimal(12,2)"))
    df = df.withColumn("order", F.struct("day", "seq"))
    one = spine.running_balance(df, ["k"], "order", {"a": F.col("v"), "b": F.col("v") * 2}).drop("order")
    blocks = spine.running_balance_in_blocks(df.drop("order"), ["k"], ["day", "seq"], {"a": F.col("v"), "b": F.col("v") * 2})
    assert rows(blocks) == rows(one) and blocks.dtypes == one.dtypes
    single = spine.running_balance_in_blocks(df.filter("seq < 900").groupBy("k", "day").agg(F.sum("v").alias("v")), ["k"], ["day"], {"a": F.col("v")})
    assert rows(single) == rows(spine.running_balance(df.filter("seq < 900").groupBy("k", "day").agg(F.sum("v").alias("v")), ["k"], "day", {"a": F.col("v")}))


def test_a_plant_with_a_third_of_the_rows_is_spread(skewed):
    df = skewed.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("plant"),
        (F.col("id") / 3 % 31).cast("int").alias("day"),
        F.col("id").alias("customer"),
    )
    out = spine.running_balance_in_blocks(df, ["plant"], ["day", "customer"], {"r": F.lit(1).cast("decimal(9,0)")})
    skewed.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = out.select("plant", F.spark_partition_id().alias("p")).filter("plant = 'hot'").distinct().count()
    skewed.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts >= 4
    assert out.filter("plant = 'hot'").agg(F.max("r")).first()[0] == 30_000


def test_blank_keys_are_spread_and_match_the_same_rows(spark):
    """A twentieth of the keys is blank and another NULL, on both sides."""
    rng = random.Random(4)

    def key(i):
        return "" if i % 20 == 0 else " " if i % 20 == 1 else None if i % 20 == 2 else f"k{rng.randrange(150)}"

    left = spark.createDataFrame([(i, key(i), key(i + 3)) for i in range(400)], "id int, key string, alt string")
    right = spark.createDataFrame([(i, key(i), key(i + 5)) for i in range(300)], "rid int, rkey string, ralt string")
    a, b = skew.spread_blank_keys(left, right, {"key": "rkey"}, parts=6)
    assert a.filter("key = ''").select("_spread").distinct().count() > 3
    assert a.filter("key IS NULL").select("_spread").distinct().count() > 3 and b.filter("rkey IS NULL").count() == 15
    assert b.filter("rkey = ''").count() == 15 * 6 and b.filter("rkey = 'k1'").count() == right.filter("rkey = 'k1'").count()
    for how in ("inner", "left"):
        plain = left.join(right, left.key == right.rkey, how)
        assert rows(a.join(b, (a.key == b.rkey) & (a._spread == b._spread), how).drop("_spread")) == rows(plain)
    pairs = reconcile.two_key_pairs(left, right, {"key": "rkey"}, {"alt": "ralt"})
    for first, cond in ((True, left.key == right.rkey), (False, left.alt == right.ralt)):
        plain = left.join(right.withColumn("f", F.lit(True)), cond, "left")
        assert rows(pairs.filter(F.col("by_primary") == first).select(*plain.columns[:-1], "found")) == rows(plain.fillna(False, ["f"]))
    got = reconcile.fallback_pairs(left, right, {"key": "rkey"}, {"alt": "ralt"})
    other = left.join(right, (left.alt == right.ralt) & ~F.coalesce(left.key == right.rkey, F.lit(False)))
    assert rows(got) == rows(left.join(right, left.key == right.rkey, "left").union(other))
