"""Reference SQL of the cost reports. Costs are joined line by line here, without subtotals."""

from __future__ import annotations

from checks import adapters as a
from checks.sqltext import final

_NEW = "(SELECT max(tco_financial_plan_nm) FROM tco_financial_plan)"


def _factor(p: str) -> str:
    return f"({p} * 0.01)"


def _share(*pcts: str) -> str:
    return " * ".join(["c.tco_cost_value", *[_factor(f"coalesce({p}, 0)") for p in pcts]])


def _weigh(total: str, pct: str) -> str:
    return f"{total} * {_factor(pct)}"


BOTH = _share("cca.tco_assignment", "aa.tco_assignment")
_CCA = "cca.tco_cost_center_allocation"


def chain(by_id: bool, accounts: str = "JOIN", centers: bool = True) -> str:
    """FROM clause of a cost report; plans matched by id or cut to the latest by name."""

    def plan(alias: str, plan_col: str = "tco_financial_plan", name: str = "tco_financial_planname") -> str:
        if by_id:
            return f"{alias}.{plan_col} = c.tco_cost_financial_plan"
        return f"{alias}.{name} = {_NEW}"

    sql = "FROM tco_cost c"
    if centers:
        sql += f" LEFT JOIN tco_cost_center cc ON cc.tco_cost_centerid = c.tco_cost_cost_center AND {plan('cc')}"
    if accounts:
        sql += (
            f" {accounts} tco_gl_account ga ON ga.tco_gl_accountid = c.tco_cost_gl_account"
            f" AND ga.tco_todisplay = '1' AND {plan('ga')}"
        )
    sql += (
        f" LEFT JOIN tco_cost_center_allocation cca ON {_CCA}_cost_center = c.tco_cost_cost_center"
        f" AND {_CCA}_gl_account = c.tco_cost_gl_account AND upper(cca.tco_monthname) = upper(c.tco_stringmonth)"
    )
    if by_id:
        sql += f" AND {_CCA}_financial_plan = c.tco_cost_financial_plan"
    else:
        sql += f" AND {_CCA}_financial_planname = {_NEW}"
    return sql


def apps(by_id: bool) -> str:
    plan = "aa.tco_financial_plan = c.tco_cost_financial_plan" if by_id else f"aa.tco_financial_planname = {_NEW}"
    own = "a.tco_financial_plan = c.tco_cost_financial_plan" if by_id else f"a.tco_financial_planname = {_NEW}"
    return f""" LEFT JOIN tco_application_assignment aa ON aa.tco_cost_center = c.tco_cost_cost_center
        AND aa.tco_gl_account = c.tco_cost_gl_account AND upper(aa.tco_monthname) = upper(c.tco_stringmonth) AND {plan}
        LEFT JOIN tco_application a ON a.tco_applicationid = aa.tco_application AND {own}"""


_COST = """c.tco_costid, c.tco_cost_id, c.tco_cost_financial_plan, c.tco_cost_financial_planname, c.tco_cost_gl_account,
    c.tco_cost_gl_accountname, c.tco_cost_value, c.tco_stringmonth, cc.tco_cost_center_id, cc.tco_cost_center_nm,
    cc.tco_function, cc.tco_totalassigned, ga.tco_gl_account_id, ga.tco_gl_account_account_group,
    ga.tco_gl_account_account_groupname"""
_LATEST_COST = f"c.tco_cost_financial_planname = {_NEW}"


def cost_to_application_sql() -> str:
    sql = f"""SELECT {_COST}, cc.tco_capabilityownername, cc.tco_capabilityowneryominame,
        {_share('cca.tco_assignment')} AS app_assigned_amount,
        CASE WHEN cca.tco_assignment IS NULL THEN 0 ELSE 1 END AS cost_center_assignment_complete,
        CASE WHEN aa.tco_assignment IS NULL THEN 0 ELSE 1 END AS application_assignment_complete,
        aa.tco_assignment AS application_assignment, {BOTH} AS app_assignment,
        {_share('aa.tco_assignment')} AS app_assignment2, 100 - {BOTH} AS app_unassigned,
        a.tco_applicationid, a.tco_application_id, a.tco_application_name, a.tco_shared_component_typename
        {chain(False)} {apps(False)} WHERE a.statuscodename = 'Active' AND {_LATEST_COST}"""
    numbers = ["tco_cost_value", "tco_totalassigned", "app_assigned_amount", "application_assignment"]
    return final(a.with_inputs(sql), numbers=[*numbers, "app_assignment", "app_assignment2", "app_unassigned"])


def cost_to_center_sql() -> str:
    sql = f"""SELECT {_COST}, cc.tco_capabilityowner, cc.tco_capabilityownername, cca.tco_assignment,
        {_share('cca.tco_assignment')} AS app_assigned_amount,
        c.tco_cost_value * ((100 - coalesce(cca.tco_assignment, 0)) * 0.01)
            AS service_assigned_amount,
        CASE WHEN cca.tco_assignment IS NULL THEN 0 ELSE 1 END AS assignment_complete
        {chain(True)} WHERE {_LATEST_COST}"""
    numbers = ["tco_cost_value", "tco_totalassigned", "tco_assignment", "app_assigned_amount", "service_assigned_amount"]
    return final(a.with_inputs(sql), numbers=numbers)


_OWNED = f"""{chain(False)} {apps(False)} WHERE a.tco_application_id IS NOT NULL AND a.statuscodename = 'Active'
    AND {_LATEST_COST}"""


def cross_owner_details_sql() -> str:
    return a.with_inputs(
        f"""SELECT DISTINCT a.tco_application_id, a.tco_application_name, c.tco_cost_financial_plan,
        cc.tco_cost_center_id, cc.tco_cost_center_nm, cc.tco_capabilityownername, cc.tco_function {_OWNED}"""
    )


def cross_owner_counts_sql() -> str:
    return a.with_inputs(
        f"""SELECT a.tco_application_id, a.tco_application_name, c.tco_cost_financial_plan,
        count(DISTINCT cc.tco_capabilityownername) AS count_owner {_OWNED} GROUP BY 1, 2, 3
        HAVING count(DISTINCT cc.tco_capabilityownername) > 1"""
    )


def zero_cost_sql() -> str:
    sql = f"""SELECT DISTINCT p AS tco_cost_financial_plan, pn AS tco_cost_financial_planname,
        o AS tco_capabilityownername, total AS total_app_assignment, tco_application_id, tco_application_name,
        1 AS app_with_no_cost_count, f AS tco_function FROM (
        SELECT c.tco_cost_financial_plan AS p, c.tco_cost_financial_planname AS pn, cc.tco_cost_center_id,
            cc.tco_cost_center_nm, cc.tco_capabilityownername AS o, cc.tco_function AS f, a.tco_application_id,
            a.tco_application_name, sum({BOTH}) AS total {chain(True, accounts='')} {apps(True)}
        WHERE a.statuscodename = 'Active' AND {_LATEST_COST} GROUP BY 1, 2, 3, 4, 5, 6, 7, 8) AS t WHERE total = 0"""
    return final(a.with_inputs(sql), numbers=["total_app_assignment"])


_REGIONS = """LEFT JOIN tco_application_buregion_assign bua ON bua.tco_application = b.app AND bua.tco_financial_plan = b.plan
    LEFT JOIN tco_shared_component_buregion_assignment sbua ON sbua.tco_buregionname = bua.tco_buregionname
        AND sbua.tco_financial_plan = b.plan"""
_NAMED = "LEFT JOIN tco_shared_component_assignment sha ON sha.tco_name = sbua.tco_shared_component_assignmentname"


def _lines(accounts: str, centers: bool = True) -> str:
    fn = ", cc.tco_function AS fn" if centers else ""
    return f"""SELECT a.tco_applicationid AS app, a.tco_application_name AS name, a.tco_financial_plan AS plan,
        a.tco_financial_planname AS plan_name, a.tco_capabilityownername AS owner,
        a.tco_shared_component_typename AS comp{fn}, {BOTH} AS amount
        {chain(True, accounts, centers)} {apps(True)} WHERE a.statuscodename = 'Active'"""


def _pk(plan: str, kind: str, comp: str, region: str) -> str:
    return f"coalesce({plan}, '') || '{kind}' || coalesce({comp}, '') || coalesce({region}, '')"


def regional_sql() -> str:
    amount = "tco_total_shared_component_app_buregion_assignment_amt"
    comp = "sha.tco_shared_component_typename"
    sql = f"""WITH b AS ({_lines('LEFT JOIN')}),
    direct AS (SELECT c.tco_cost_financial_plan AS plan, c.tco_cost_financial_planname AS plan_name,
        cc.tco_capabilityownername AS owner, a.tco_application_name AS name, cc.tco_function AS fn,
        bu.tco_buregionname AS region, bu.tco_assignment AS pct, {BOTH} AS amount
        {chain(True, 'LEFT JOIN')} {apps(True)}
        LEFT JOIN tco_application_buregion_assign bu ON bu.tco_application = a.tco_applicationid
            AND bu.tco_financial_plan = a.tco_financial_plan WHERE a.statuscodename = 'Active' AND {_LATEST_COST})
    SELECT {_pk('plan_name', 'shared', comp, 'bua.tco_buregionname')} AS pk, plan AS tco_financial_plan,
        plan_name AS tco_financial_planname, owner AS tco_capabilityownername, name AS tco_application_name,
        'shared' AS tco_cost_type, {comp} AS tco_shared_component_typename, fn AS tco_function,
        bua.tco_buregionname AS tco_buregionname, CAST({_factor('sbua.tco_assignment')} AS DOUBLE) AS tco_buregion_assignment,
        CAST(sum(amount) AS DOUBLE) AS sum_app_assignment,
        CAST(round({_weigh('sum(amount)', 'bua.tco_assignment')}, 2) AS DOUBLE) AS {amount}
    FROM b {_REGIONS} {_NAMED} WHERE plan_name = {_NEW}
    GROUP BY plan, plan_name, owner, name, {comp}, fn, bua.tco_buregionname, bua.tco_assignment, sbua.tco_assignment
    UNION ALL
    SELECT {_pk('plan_name', 'direct', "'Direct'", 'region')}, plan, plan_name, owner, name, 'direct', 'Direct', fn, region,
        CAST({_factor('pct')} AS DOUBLE), CAST(sum(amount) AS DOUBLE),
        CAST({_weigh('sum(amount)', 'pct')} AS DOUBLE) FROM direct GROUP BY plan, plan_name, owner, name, fn, region, pct"""
    return a.with_inputs(sql)


def shared_cost_sql() -> str:
    first = _lines("JOIN", centers=False)
    second = first.replace("a.tco_shared_component_typename AS comp", "sh2.tco_shared_component_typename AS comp")
    typed = """LEFT JOIN tco_shared_component_assignment s1
        ON s1.tco_shared_component_typename = a.tco_shared_component_typename AND s1.tco_assignment_type = 'bu-region' WHERE"""
    listed = """LEFT JOIN tco_shared_component_app_assignment sa ON sa.tco_application = a.tco_applicationid
        LEFT JOIN tco_shared_component_assignment sh2 ON sh2.tco_name = sa.tco_shared_component_assignmentname
            AND sh2.tco_financial_plan = sa.tco_financial_plan WHERE"""
    sql = f"""WITH b AS ({first.replace('WHERE a.status', typed + ' a.status')} AND {_LATEST_COST}
        UNION ALL {second.replace('WHERE a.status', listed + ' a.status')}),
    inner_ AS (SELECT plan, plan_name, owner, name, comp, bua.tco_buregionname AS region, sbua.tco_assignment AS pct,
        sum(amount) AS total FROM b {_REGIONS} WHERE plan_name = {_NEW} GROUP BY 1, 2, 3, 4, 5, 6, 7)
    SELECT {_pk('plan_name', 'shared', 'comp', 'region')} AS pk, plan AS tco_financial_plan,
        owner AS tco_capabilityownername, comp AS tco_shared_component_typename, region AS tco_buregionname,
        CAST({_weigh('sum(total)', 'pct')} AS DOUBLE) AS total_sum_app_assignment
    FROM inner_ GROUP BY plan, plan_name, owner, comp, region, pct"""
    return a.with_inputs(sql)


def shared_total_sql() -> str:
    sql = f"""WITH b AS ({_lines('LEFT JOIN')}),
    inner_ AS (SELECT name, plan_name, sha.tco_shared_component_typename AS comp, bua.tco_buregionname AS region,
        round({_weigh('sum(amount)', 'bua.tco_assignment')}, 2) AS amt
        FROM b {_REGIONS} {_NAMED} WHERE plan_name = {_NEW}
        GROUP BY name, plan_name, sha.tco_shared_component_typename, bua.tco_buregionname, bua.tco_assignment)
    SELECT {_pk('plan_name', 'shared', 'comp', 'region')} AS pk, region AS tco_buregionname,
        plan_name AS tco_financial_planname, comp AS tco_shared_component_typename,
        CAST(round(sum(amt), 2) AS DOUBLE) AS tco_shared_component_buregion_assignment_amt
    FROM inner_ GROUP BY region, plan_name, comp"""
    return a.with_inputs(sql)


def shared_by_region_sql() -> str:
    sql = f"""WITH ao AS (SELECT DISTINCT p.tco_financial_planname AS pn, p.tco_application_name AS name,
        p.tco_capabilityownername AS owner, cc.tco_function AS fn, b.tco_buregionname AS region, b.tco_assignment AS pct
        FROM tco_application p
        LEFT JOIN tco_application_assignment aa ON aa.tco_applicationname = p.tco_application_name
            AND aa.tco_financial_plan = p.tco_financial_plan
        LEFT JOIN tco_cost_center cc ON cc.tco_cost_centerid = aa.tco_cost_center
            AND cc.tco_financial_plan = aa.tco_financial_plan
        LEFT JOIN tco_application_buregion_assign b ON b.tco_application = p.tco_applicationid
            AND b.tco_financial_plan = p.tco_financial_plan)
    SELECT {_pk('x.tco_financial_planname', 'shared', 'sha.tco_shared_component_typename', 'r.tco_business_unit_region_name')}
        AS pk, x.tco_financial_plan, ao.owner AS tco_capabilityownername, ao.fn AS tco_function,
        x.tco_applicationname AS tco_application_name, 'shared' AS tco_cost_type, sha.tco_shared_component_typename,
        ao.region AS tco_buregionname,
        CAST({_factor('ao.pct')} AS DOUBLE) AS tco_shared_component_buregion_assignment_perc,
        CAST(x.tco_dolassigned AS DOUBLE) AS tco_shared_component_app_assignment_amt,
        CAST(round({_weigh('x.tco_dolassigned', 'ao.pct')}, 2) AS DOUBLE)
            AS tco_total_shared_component_app_buregion_assignment_amt
    FROM tco_shared_component_app_assignment x CROSS JOIN tco_business_unit_region r
    JOIN tco_shared_component_assignment sha ON sha.tco_name = x.tco_shared_component_assignmentname
        AND sha.tco_financial_plan = x.tco_financial_plan
    LEFT JOIN tco_shared_component_buregion_assignment bu ON bu.tco_buregionname = r.tco_business_unit_region_name
    LEFT JOIN tco_shared_component_type sc ON sc.tco_description = sha.tco_shared_component_typename
    LEFT JOIN ao ON ao.name = x.tco_applicationname AND ao.pn = x.tco_financial_planname
        AND ao.region = r.tco_business_unit_region_name
    WHERE x.tco_financial_planname = {_NEW}"""
    return a.with_inputs(sql)


_FUNCTIONS = f"""(SELECT DISTINCT tco_capabilityownername, tco_function FROM tco_cost_center
    WHERE tco_financial_planname = {_NEW})"""


def region_assignment_sql() -> str:
    sql = f"""SELECT c.tco_financial_plan, c.tco_applicationid, c.tco_application_name, c.tco_capabilityownername,
        c.tco_ownerstring, f.tco_function, b.total AS total_assignment,
        CASE WHEN round(b.total, 0) = 100 THEN 1 ELSE 0 END AS assignment_check,
        CAST(count(DISTINCT c.tco_applicationid) AS INTEGER) AS appburegion_count
    FROM tco_application c LEFT JOIN tco_application_buregion_assign x ON x.tco_application = c.tco_applicationid
        AND x.tco_financial_plan = c.tco_financial_plan
    LEFT JOIN {_FUNCTIONS} f ON f.tco_capabilityownername = c.tco_capabilityownername
    LEFT JOIN (SELECT tco_application, tco_financial_plan, sum(tco_assignment) AS total
        FROM tco_application_buregion_assign GROUP BY 1, 2) b
        ON b.tco_application = x.tco_application AND b.tco_financial_plan = x.tco_financial_plan
    WHERE c.statuscodename = 'Active' AND c.tco_financial_planname = {_NEW} GROUP BY 1, 2, 3, 4, 5, 6, 7"""
    return final(a.with_inputs(sql), numbers=["total_assignment"])


def cost_center_assignment_sql() -> str:
    sql = f"""SELECT c.tco_financial_plan, c.tco_cost_centerid, c.tco_cost_center_id, c.tco_cost_center_nm,
        c.tco_capabilityownername, c.tco_function, b.total AS total_assignment,
        CASE WHEN b.total IS NOT NULL THEN 1 ELSE 0 END AS assignment_check,
        CAST(count(DISTINCT c.tco_cost_centerid) AS INTEGER) AS cc_alloc_count
    FROM tco_cost_center c LEFT JOIN (SELECT tco_cost_center_allocation_cost_center AS k,
        tco_cost_center_allocation_financial_plan AS p, sum(tco_assignment) AS total
        FROM tco_cost_center_allocation GROUP BY 1, 2) b ON b.k = c.tco_cost_centerid AND b.p = c.tco_financial_plan
    WHERE c.tco_financial_planname = {_NEW} GROUP BY 1, 2, 3, 4, 5, 6, 7"""
    return final(a.with_inputs(sql), numbers=["total_assignment"])


def application_assignment_sql() -> str:
    sql = f"""WITH f AS (SELECT DISTINCT c.tco_financial_plan, c.tco_applicationid, c.tco_application_name,
        c.tco_application_id, c.tco_capabilityownername, c.tco_ownername, b.total,
        (SELECT count(DISTINCT e.tco_cost_center) FROM tco_application_assignment e
            WHERE e.tco_application = x.tco_application) AS assigned_cost_center_count,
        (SELECT count(d.tco_cost_centerid) FROM tco_cost_center d WHERE d.tco_financial_planname = {_NEW}
            AND d.tco_capabilityownername = c.tco_capabilityownername) AS cost_center_count
    FROM tco_application c LEFT JOIN tco_application_assignment x ON x.tco_application = c.tco_applicationid
        AND x.tco_financial_plan = c.tco_financial_plan
    LEFT JOIN (SELECT tco_application, tco_financial_plan, sum(tco_assignment) AS total FROM tco_application_assignment
        WHERE tco_financial_planname = {_NEW} GROUP BY 1, 2) b
        ON b.tco_application = x.tco_application AND b.tco_financial_plan = x.tco_financial_plan
    WHERE c.statuscodename = 'Active' AND c.tco_financial_planname = {_NEW})
    SELECT DISTINCT f.tco_financial_plan, tco_applicationid, tco_application_name, tco_application_id,
        f.tco_capabilityownername, tco_ownername, g.tco_function, assigned_cost_center_count, cost_center_count,
        CASE WHEN assigned_cost_center_count = cost_center_count AND total IS NOT NULL THEN 1 ELSE 0 END
            AS assignment_check, 1 AS app_assignment_count
    FROM f JOIN {_FUNCTIONS} g ON g.tco_capabilityownername = f.tco_capabilityownername
    WHERE g.tco_function IS NOT NULL"""
    return final(a.with_inputs(sql), counts=["assigned_cost_center_count", "cost_center_count"])


def shared_component_assignment_sql() -> str:
    def by(table: str) -> str:
        return f"""(SELECT sum(d.tco_assignment) FROM {table} d
            WHERE d.tco_shared_component_assignment = c.tco_shared_component_assignmentid
            AND d.tco_financial_planname = c.tco_financial_planname)"""

    sql = f"""WITH b AS (SELECT DISTINCT tco_shared_component_type AS k, tco_financial_plan,
        CASE WHEN tco_assignment_type = 'app' THEN {by('tco_shared_component_app_assignment')}
             ELSE {by('tco_shared_component_buregion_assignment')} END AS total
        FROM tco_shared_component_assignment c WHERE tco_financial_planname = {_NEW})
    SELECT tco_description, tco_ownername, CASE WHEN b.k IS NULL THEN 0 ELSE 1 END AS assignment_check,
        CASE WHEN round(total, 0) = 100 THEN 1 ELSE 0 END AS sums_to_100, 1 AS shared_comp_count
    FROM tco_shared_component_type g LEFT JOIN b ON b.k = g.tco_shared_component_typeid"""
    return a.with_inputs(sql)


_ASSET_FROM = f"""FROM tco_assets c LEFT JOIN tco_cost_center d ON d.tco_cost_centerid = c.tco_cost_center
    AND d.tco_financial_planname = c.tco_financial_planname
    WHERE c.tco_financial_planname = {_NEW} AND d.tco_function IS NOT NULL"""


def asset_assignment_sql() -> str:
    def n(extra: str) -> str:
        return f"""(SELECT count(e.tco_asset_item_number) FROM tco_assets e WHERE e.tco_cost_center = c.tco_cost_center
            AND e.tco_financial_plan = c.tco_financial_plan AND e.tco_app_releted = 1 {extra}
            AND e.tco_net_book_value > 1 AND e.tco_financial_planname = {_NEW})"""

    sql = f"""SELECT *, CAST(CASE WHEN assets_per_costctr = 0 THEN 1
            ELSE round(total_assignment / assets_per_costctr, 2) END AS DOUBLE) AS asset_total_assignment,
        CASE WHEN assets_per_costctr = 0 OR total_assignment = assets_per_costctr THEN 1 ELSE 0 END
            AS asset_assignment_check, 1 AS asset_count
    FROM (SELECT DISTINCT c.tco_financial_plan, d.tco_capabilityownername, c.tco_cost_center, c.tco_cost_centername,
        d.tco_function, {n('AND e.tco_application IS NOT NULL')} AS total_assignment, {n('')} AS assets_per_costctr
        {_ASSET_FROM} AND c.tco_net_book_value > 1) AS t"""
    return a.with_inputs(sql)


def asset_details_sql() -> str:
    columns = """c.tco_financial_plan, c.tco_financial_planname, d.tco_capabilityownername, c.tco_asset_item_number,
        c.tco_description, c.tco_app_reletedname, c.tco_cost_center, c.tco_cost_centername, d.tco_function"""
    return a.with_inputs(
        f"SELECT * EXCLUDE (tco_application) FROM (SELECT DISTINCT {columns}, c.tco_application {_ASSET_FROM}) AS t"
    )
