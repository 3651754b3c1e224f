"""Report inputs derived from the test tables.

Each input table is one SELECT in the SQL subset that Spark and DuckDB share. Spark runs
it over the parquet files; the reference SQL of a report carries the same text as CTEs.
Keys modulo a number decide which case a row exercises.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

from tallyworks.sources import Sources
from tallyworks.sources import constants as const

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
AS_OF = dt.date(1998, 1, 1)
LEDGER_AS_OF = dt.date(2021, 7, 15)
CHECK_AS_OF = dt.date(1998, 6, 30)


# The listed operation names, kept apart from the library's so that a wrong one there shows.
OPERATION_NAMES = (
    "Exportação Temporária",
    "Rem. ind.cta.ord.adq.merc.qndo ñ tran.estab.adq.",
    "Rem. ind.cta.ord.adq.merc.qndo ñ tran.estab.adq. /  Remessa",
    "Rem. ind.cta.ord.adq.merc.qndo ñ tran.estab.adq. /  Rem. ind",
    "Remessa de bem por contrato de comodato ou locação",
    "Remessa de vasilhame ou sacaria",
    "Remessa merc.conta ord.terc.em venda à\u00a0ordem",
    "Remessa p/ depós. fech. arm.geral ou outro est.",
    "Remessa p/ depósito fechado ou arm.geral",
    "Venda de mercadoria adquirida ou recebida terc.",
    "Venda de produção do estabelecimento",
    "Venda merc. adq. rec. terc. que ñ deva ele trans.",
    "Venda merc. adq. rec. terc. que ñ deva ele trans. /  Remessa",
    "Venda merc.adq. rec. terc. dest. ZFM Ár. Liv. Com.",
    "Venda merc.adq.receb.de terceiros",
    "Venda merc.adq.receb.de terceiros /  Remessa de vasilhame ou",
    "Venda merc.adq.receb.de terceiros /  Venda produção do estab",
    "Venda prod. estab. dest. ZFM Ár. Livre Comércio",
    "Venda prod. estab. ñ deva por ele transitar",
    "Venda prod.estab.ent.des.cnt.ord.adq.orig.vnd.ord.",
    "Venda produção do estabelecimento",
    "Venda produção do estabelecimento /  Remessa de vasilhame ou",
    "Vnd merc.adq.rec.terc.ent.des.vend.remet vnd.ord",
    "Vnd.mer.adq.rec.ter.rem.ind.cnt.o.adq.tra.est.adq.",
    "Vnd.prod.est.rem.ind.cnt.ord.adq.s/ tran.est.adq./ Vnd.mer",
    "Vnd.prod.est.rem.ind.cnt.ord.adq.s/ tran.est.adq.",
    "Venda produção do estabelecimento /  Venda merc.adq.receb.de",
)
# Names outside the list: transfers, and a listed name with one space less.
UNLISTED_NAMES = (
    "Transferência produção estabelecimento",
    "Venda produção do estabelecimento / Remessa de vasilhame ou",
)


def z(expr: str, width: int, pad: str = "0") -> str:
    return f"lpad(cast({expr} AS string), {width}, '{pad}')"


def d8(expr: str) -> str:
    return f"replace(cast(cast({expr} AS date) AS string), '-', '')"


def money(expr: str) -> str:
    return f"cast({expr} AS decimal(18,2))"


def pick(expr: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


PLANTS = ["BRPA", "BRPE", "BR3R", "BRSP"]
_groups = [g for g, _, _ in const.PALLETS_PLANT]
_packs = const.PACKAGING


def matnr(pk: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{code}'" for i, (code, _, _) in enumerate(_packs, start=1))
    return f"CASE {pk} {arms} ELSE {z(pk, 18)} END"


def mtart(pk: str) -> str:
    arms = " ".join(f"WHEN {pk} = {i} THEN '{kind}'" for i, (_, kind, _) in enumerate(_packs, start=1))
    return f"CASE {arms} WHEN {pk} % 10 = 9 THEN 'HALB' ELSE 'FERT' END"


def matkl(pk: str) -> str:
    return f"CASE WHEN {pk} % 23 = 0 THEN 'A7000' ELSE {pick(pk + ' % 19', _groups)} END"


def plant(sk: str) -> str:
    return pick(f"{sk} % 4", PLANTS)


_later = "cast(cast(o_orderdate AS date) + INTERVAL '240' MONTH AS date)"
_kinds = (("BX10", "1.00", "1000"), ("BX13", "0.18", "180"), ("BX23", "0.05", "50"), ("BX72", "0.07", "76"))
_kinds += (("BX82", "0.01", "16"), ("IPVA", "0.04", "45"))


def times(source: str, alias: str, items: list[object]) -> str:
    """Every row of ``source`` once per item, by an array rather than a join."""
    listed = ", ".join(f"'{i}'" if isinstance(i, str) else str(i) for i in items)
    return f"(SELECT *, explode(array({listed})) AS {alias} FROM {source}) AS by_{alias}"


def plans(source: str) -> str:
    return times(source, "plan_id", ["P0", "P1"])


PLAN_NAME = "CASE plan_id WHEN 'P0' THEN 'Plan 1997' ELSE 'Plan 1998' END"
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

_seen = """(SELECT DISTINCT o_custkey AS c, o_orderkey % 4 AS g, month(cast(o_orderdate AS date)) AS m FROM orders) AS seen"""


def owner(key: str) -> str:
    """Two neighbouring keys share an owner."""
    return f"cast({key} - {key} % 2 AS string)"


TABLES: dict[str, str] = {
    "line": f"""SELECT l_orderkey AS ok, l_linenumber AS ln,
        {money(f"sum({money('l_quantity')})")} AS qty, {money(f"sum({money('l_extendedprice')})")} AS price,
        max(cast(l_discount AS decimal(4,2))) AS disc, max(cast(l_tax AS decimal(4,2))) AS tax,
        min(l_partkey) AS pk, min(l_suppkey) AS sk, min(l_returnflag) AS rf, min(l_linestatus) AS ls,
        min(cast(l_shipdate AS date)) AS sd
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    # Logistics
    "mara": f"""SELECT {matnr('p_partkey')} AS matnr, {matkl('p_partkey')} AS matkl,
        {mtart('p_partkey')} AS mtart, '300' AS mandt FROM part""",
    "marc": f"""SELECT {matnr('p_partkey')} AS matnr, werks,
        cast(CASE WHEN p_partkey % 50 = 0 THEN 0 ELSE 10 * (1 + p_partkey % 7) END AS decimal(13,3)) AS bstrf,
        '300' AS mandt FROM {times('part', 'werks', PLANTS)}""",
    "makt": f"""SELECT {matnr('p_partkey')} AS matnr, CASE WHEN p_partkey % 40 = 39 THEN 'E' ELSE 'P' END AS spras,
        p_name AS maktx, '300' AS mandt FROM part""",
    "warehousing_capacity": f"""SELECT {pick('r_regionkey', ['BRPD', 'BRRE', 'RISC', 'BRSP', 'BRRC'])} AS location_code,
        r_name AS location_name, 'Plant' AS type, {pick('r_regionkey', [*PLANTS, 'BRPE'])} AS plant,
        'S' AS storage_type, {money('100000 + 5000 * r_regionkey')} AS can_capacity,
        {money('CASE WHEN r_regionkey = 3 THEN 0 ELSE 4000 * r_regionkey END')} AS end_capacity,
        {money('CASE WHEN r_regionkey = 2 THEN 0 ELSE 700 + r_regionkey END')} AS pallet_capacity,
        {money('CASE WHEN r_regionkey = 2 THEN 0 ELSE 50 END')} AS topframe_capacity,
        {money('0')} AS inventory_level_min, 'N' AS based_on_usage, r_name AS region, 'BR' AS country FROM region
        UNION ALL
        SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'W' || {z('n_nationkey', 3)} ELSE cast(n_nationkey AS string) END,
        n_name, CASE WHEN n_nationkey % 2 = 0 THEN 'Warehouse' ELSE 'Customer' END, {plant('n_nationkey')},
        'S', {money('CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE 1000 + 10 * n_nationkey END')},
        {money('300 * n_nationkey')}, {money('10')}, {money('1')}, {money('n_nationkey % 3')}, 'Y', n_name, 'BR'
        FROM nation""",
    "vw_fct_inventory_aging": f"""SELECT DATE '1998-01-01' + cast(pk % 3 AS int) AS date_of_analysis,
        {matnr('pk')} AS material, {plant('sk')} AS plant,
        CASE ok % 5 WHEN 0 THEN 'W' || {z('ok % 25', 3)} WHEN 1 THEN '1300' WHEN 2 THEN NULL WHEN 3 THEN '0001'
        ELSE '0002' END AS storage_location,
        CASE WHEN ok % 7 = 0 THEN NULL WHEN ok % 3 = 0 THEN {z('ok % 25', 10)} ELSE 'X' || {z('ok % 25', 9)} END AS customer,
        'V' AS vendor, CASE WHEN rf = 'R' THEN 'Stock in Transit' ELSE 'Unrestricted' END AS status,
        {money('qty * 100')} AS stock_at_plant FROM line""",
    "vbak": f"""SELECT {z('o_orderkey', 10)} AS vbeln,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 'ZBA3' ELSE 'ZOR' END AS auart,
        {z('o_custkey % 25', 10)} AS kunnr FROM orders""",
    "vbap": f"""SELECT {z('ok', 10)} AS vbeln, {z('ln', 6)} AS posnr, {matnr('pk')} AS matnr, {plant('sk')} AS werks,
        'W' || {z('sk % 25', 3)} AS lgort, CASE WHEN rf = 'R' THEN '01' ELSE ' ' END AS abgru,
        '300' AS mandt FROM line""",
    "vbep": f"""SELECT {z('ok', 10)} AS vbeln, {z('ln', 6)} AS posnr,
        CASE WHEN ok % 97 = 0 THEN '00000000' ELSE {d8('sd')} END AS tddat, cast(qty AS decimal(13,3)) AS wmeng,
        'TH' AS meins, '300' AS mandt FROM line""",
    "ztbbw_prd_lines": f"""SELECT CASE WHEN ln % 3 = 0 THEN '19980102' WHEN ok % 2 = 0 THEN '19971231' ELSE '19971230' END
        AS dtcarga, {d8('sd')} AS dtplan, {plant('sk')} AS werks, {matkl('pk')} AS matkl, qty AS quantidade,
        CASE WHEN ln % 3 = 0 THEN '10' ELSE '20' END AS ctg_rep,
        CASE WHEN ok % 101 = 0 THEN '200' ELSE '300' END AS mandt FROM line""",
    "t001k": f"SELECT {pick('r_regionkey', PLANTS)} AS bwkey, '300' AS mandt FROM region WHERE r_regionkey < 4",
    "t001w": f"""SELECT {pick('r_regionkey', PLANTS)} AS werks, {pick('r_regionkey', PLANTS)} AS bwkey,
        {z('r_regionkey', 10)} AS kunnr, '300' AS mandt FROM region WHERE r_regionkey < 4""",
    "t023t": "SELECT DISTINCT matkl, 'P' AS spras, '300' AS mandt FROM mara",
    # Ledger and profitability, moved twenty years ahead
    "bkpf": f"""SELECT {z('o_orderkey', 10)} AS belnr, '100' || cast(o_orderkey % 9 AS string) AS bukrs,
        cast(year({_later}) AS string) AS gjahr, 'U' || cast(o_orderkey % 3 AS string) AS usnam,
        {pick('o_orderkey % 7', ['DG', 'DR', 'R1', 'KR', 'RE', 'RV', 'RV'])} AS blart, 'BRL' AS waers,
        {d8(_later)} AS budat, {d8(_later)} AS bldat,
        CASE WHEN o_orderkey % 13 = 0 THEN ' '
             WHEN o_orderkey % 7 = 1 AND o_orderkey % 2 = 0 THEN 'DEBIT NOTE ' || {z('o_orderkey', 9)}
             WHEN o_orderkey % 7 IN (1, 3) THEN 'ND ' || {z('o_orderkey', 9)}
             WHEN o_orderkey % 7 IN (0, 2) THEN 'NC ' || {z('o_orderkey', 9)}
             ELSE {z('o_orderkey', 9)} END AS xblnr, '300' AS mandt FROM orders""",
    "bseg": f"""SELECT '100' || cast(o_orderkey % 9 AS string) AS bukrs, {z('o_orderkey', 10)} AS belnr,
        cast(year({_later}) AS string) AS gjahr, {z('n', 3)} AS buzei, {plant('o_custkey')} AS werks,
        {z('o_custkey', 10)} AS kunnr, 'V1' AS lifnr, '12100' || cast(1 + o_orderkey % 8 AS string) AS vbund,
        'Z' || cast(o_orderkey % 10 AS string) AS zuonr,
        CASE o_orderkey % 5 WHEN 0 THEN '0112410101' WHEN 4 THEN '0999999999' ELSE '0212200101' END AS hkont,
        'B1' AS bupla, 'K1' AS kostl, CASE WHEN n = 1 THEN 'S' ELSE 'H' END AS shkzg,
        {money("o_totalprice")} + CASE WHEN o_orderkey % 3 = 2 AND n = 2 THEN cast('0.05' AS decimal(3,2))
            ELSE cast('0.00' AS decimal(3,2)) END AS dmbtr,
        {money("o_totalprice")} AS dmbe3,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'T' || cast(o_orderkey AS string) END AS sgtxt,
        CASE WHEN o_orderkey % 4 <> 0 OR o_orderkey % 16 = 0 THEN '' ELSE 'CLR' END AS augbl,
        CASE WHEN o_orderkey % 4 <> 0 THEN '00000000' WHEN o_orderkey % 8 = 0 THEN '20210705' ELSE '20200105' END AS augdt,
        '300' AS mandt FROM {times('orders', 'n', [1, 2])} WHERE o_orderkey % 3 <> 1 OR n = 1""",
    "vbrk": f"""SELECT {z('o_orderkey', 10)} AS vbeln, '100' || cast(o_orderkey % 9 AS string) AS bukrs,
        {d8(_later + " + cast(CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS int)")} AS fkdat,
        ' ' AS fksto, {z('o_custkey', 10)} AS kunag, 'V1' AS vkorg, '01' AS vtweg, '01' AS spart,
        CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE {z('o_orderkey', 10)} END AS knumv, '300' AS mandt FROM orders""",
    "vbrp": f"""SELECT {z('ok', 10)} AS vbeln, {z('ln', 6)} AS posnr, {matnr('pk')} AS matnr, '300' AS mandt FROM line""",
    "ce1bcsa": f"""SELECT {z('ok', 10)} AS rbeln, {z('ln', 6)} AS rposn,
        CASE WHEN ln = 7 THEN '02' ELSE '01' END AS paledger, '001' AS perde, {matnr('pk')} AS artnr,
        CASE WHEN ok % 19 = 0 THEN ' ' ELSE {z('ok', 9)} END AS wwnnf, '100' || cast(ok % 9 AS string) AS bukrs,
        {plant('sk')} AS werks, 'G' || cast(ok % 4 AS string) AS kdgrp, {z('o_custkey', 10)} AS kndnr,
        {mtart('pk')} AS mtart, CASE WHEN pk % 29 = 0 THEN NULL WHEN pk % 31 = 0 THEN '70001' ELSE {matkl('pk')} END AS matkl,
        cast(CASE WHEN ok % 29 = 0 AND ln = 2 THEN 0 ELSE qty END AS decimal(15,3)) AS vv211, 'TH' AS vv211_me,
        CASE WHEN ln = 1 THEN {money('o_totalprice')} - cast('1.00' AS decimal(3,2)) + CASE ok % 4
            WHEN 0 THEN cast('0.00' AS decimal(3,2)) WHEN 1 THEN cast('0.10' AS decimal(3,2))
            WHEN 2 THEN cast('0.11' AS decimal(3,2)) ELSE cast('-0.10' AS decimal(3,2)) END ELSE price END AS vv100,
        {money('1')} AS vv140, {money('price * disc')} AS vv210, {money('0.5')} AS vv180, {money('0.25')} AS vv170,
        CASE WHEN ok % 31 = 0 THEN 'EUR' ELSE 'USD' END AS rec_waers, '300' AS mandt
        FROM line JOIN orders ON ok = o_orderkey""",
    "t001": "SELECT DISTINCT bukrs, '300' AS mandt FROM vbrk",
    "knvv": f"""SELECT {z('c_custkey', 10)} AS kunnr, 'V1' AS vkorg, '01' AS vtweg, '01' AS spart, '300' AS mandt
        FROM customer WHERE c_custkey % 2 = 0""",
    "mvke": f"SELECT 'V1' AS vkorg, '01' AS vtweg, {matnr('p_partkey')} AS matnr, '300' AS mandt FROM part",
    "kna1": f"""SELECT {z('c_custkey', 10)} AS kunnr, c_name AS name1, 'Rua ' || cast(c_custkey AS string) AS stras,
        'Cidade ' || cast(c_nationkey AS string) AS ort01, 'Bairro ' || cast(c_custkey % 9 AS string) AS ort02,
        {z('c_custkey', 8)} AS pstlz, 'S' || cast(c_nationkey AS string) AS regio, {z('c_custkey', 9, '5')} AS telf1,
        {z('c_custkey', 14)} AS stcd1, {z('c_custkey', 12, '7')} AS stcd3, '300' AS mandt FROM customer""",
    # Invoices
    "j_1bnfdoc": f"""SELECT {z('o_orderkey', 10)} AS docnum, CASE WHEN o_orderkey % 5 = 4 THEN '2' ELSE '1' END AS direct,
        {pick('o_orderkey % 29', [*OPERATION_NAMES, *UNLISTED_NAMES])} AS natop,
        {z('o_orderkey', 9)} AS nfenum, '1' AS series,
        CASE WHEN o_orderkey % 17 = 2 THEN '' ELSE {z('o_custkey % 25', 14, '1')} END AS cnpj_bupla,
        {z('o_custkey', 14)} AS cgc, {d8('o_orderdate')} AS docdat,
        CASE WHEN o_orderkey % 17 = 11 THEN {d8('cast(o_orderdate AS date) - 1')} ELSE {d8('o_orderdate')} END AS pstdat,
        CASE o_orderkey % 17 WHEN 12 THEN {d8('cast(o_orderdate AS date) + 2')}
            WHEN 11 THEN {d8('cast(o_orderdate AS date) - 1')} ELSE {d8('o_orderdate')} END AS credat,
        o_orderkey % 50 AS anzpk, cast({money('o_totalprice')} * cast('0.123' AS decimal(4,3)) AS decimal(15,3)) AS brgew,
        cast({money('o_totalprice')} * cast('0.017' AS decimal(4,3)) AS decimal(15,3)) AS ntgew,
        {pick('o_orderkey % 6', ['0', '1', '2', '3', '4', '9'])} AS modfrete, {money('o_totalprice')} AS nftot,
        'USER' || cast(o_orderkey % 5 AS string) AS crenam, {z('o_custkey', 10)} AS parid,
        CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE 'Parceiro ' || cast(o_custkey AS string) END AS name1,
        CASE WHEN o_orderkey % 17 = 15 THEN 'X' ELSE ' ' END AS nfesrv, {z('o_orderkey', 10)} AS belnr,
        '1000' AS bukrs, cast(year(cast(o_orderdate AS date)) AS string) AS gjahr, ' ' AS cancel,
        CASE WHEN o_orderkey % 43 = 0 THEN 'NF01' ELSE ' ' END AS form,
        CASE WHEN o_orderkey % 47 = 0 THEN '57' ELSE '55' END AS model, '300' AS mandt FROM orders""",
    "j_1bnflin": f"""SELECT {z('ok', 10)} AS docnum, {z('ln * 10', 6)} AS itmnum, {matnr('pk')} AS matnr,
        'Produto ' || cast(pk AS string) AS maktx, cast(1 + pk % 9 AS string) || '1234567' AS nbm,
        cast(pk % 3 AS string) AS matorg, '5101AA' AS cfop, CASE WHEN pk % 3 = 0 THEN 'TH' ELSE 'UN' END AS meins,
        qty AS menge, cast(price * cast('0.013371' AS decimal(7,6)) AS decimal(13,6)) AS netpr, price AS netwr,
        {money('price * disc')} AS netdis, {money('qty * disc * 100')} AS netfre, {money('qty * tax')} AS netins,
        {money('tax * 1000')} AS netoth, {money('price * tax')} AS nfdis, {money('1 + ln')} AS nffre,
        {money('qty * tax')} AS nfins, {money('tax * 10')} AS nfoth,
        CASE WHEN pk % 2 = 0 THEN ' ' ELSE '4' END AS modbcst, {plant('sk')} AS bwkey, {z('ok', 10)} AS refkey,
        {z('ln', 6)} AS refitm, 'L' || cast(pk % 3 AS string) AS taxlw1, '300' AS mandt FROM line""",
    "j_1bnfe_active": f"""SELECT {z('o_orderkey', 10)} AS docnum,
        CASE WHEN o_orderkey % 17 = 4 THEN '' ELSE '43' END AS regio,
        CASE WHEN o_orderkey % 17 = 4 THEN '' ELSE right(cast(year(cast(o_orderdate AS date)) AS string), 2) END AS nfyear,
        CASE WHEN o_orderkey % 17 = 4 THEN '' ELSE {z('month(cast(o_orderdate AS date))', 2)} END AS nfmonth,
        CASE WHEN o_orderkey % 17 = 4 THEN '' ELSE {z('o_custkey', 14)} END AS stcd1,
        CASE WHEN o_orderkey % 17 = 4 THEN '' ELSE '55' END AS model,
        CASE WHEN o_orderkey % 17 = 4 THEN '' ELSE '001' END AS serie,
        CASE WHEN o_orderkey % 17 = 4 THEN '' ELSE {z('o_orderkey', 9)} END AS nfnum9,
        CASE WHEN o_orderkey % 17 = 4 THEN '' ELSE {z('o_orderkey', 9, '1')} END AS docnum9,
        CASE WHEN o_orderkey % 17 IN (4, 16) THEN '' WHEN o_orderkey % 37 = 0 THEN NULL ELSE '7' END AS cdv,
        'AUT' || cast(o_orderkey AS string) AS authcod,
        CASE WHEN o_orderkey % 6 = 0 THEN '00000000' ELSE {d8('o_orderdate')} END AS authdate, '101530' AS authtime,
        {z('o_custkey', 10)} AS parid, '300' AS mandt FROM orders""",
    "line_sums": """SELECT docnum, sum(nffre) AS fre, sum(nfins) AS ins, sum(nfdis) AS dis, sum(nfoth) AS oth
        FROM j_1bnflin GROUP BY docnum""",
    "sa_g3p_invoices": f"""SELECT CASE WHEN o_orderkey % 17 = 14 THEN {z('o_orderkey', 44, '9')}
            WHEN o_orderkey % 17 = 4 THEN 'none' ELSE regio || nfyear || nfmonth || stcd1 || a.model || serie || nfnum9
            || docnum9 || coalesce(cdv, '') END AS chave_de_acesso,
        o_orderkey AS numero_nfe, o_custkey AS cnpj_emitente,
        CASE WHEN o_orderkey % 17 = 3 THEN '123' ELSE {z('o_custkey % 25', 14, '1')} END AS cnpj_dest,
        CASE WHEN o_orderkey % 17 = 1 THEN 'CANCEL01' ELSE 'AUTHOR' END AS processo,
        {money("fre + CASE o_orderkey % 17 WHEN 6 THEN 0.06 WHEN 0 THEN 0.05 ELSE 0 END")} AS valor_total_do_frete,
        {money("ins - CASE o_orderkey % 17 WHEN 7 THEN 0.06 WHEN 0 THEN 0.05 ELSE 0 END")} AS valor_total_do_seguro,
        {money("dis + CASE o_orderkey % 17 WHEN 8 THEN 0.06 WHEN 0 THEN 0.05 ELSE 0 END")} AS valor_total_do_desconto,
        {money("oth - CASE o_orderkey % 17 WHEN 9 THEN 0.06 WHEN 0 THEN 0.05 ELSE 0 END")} AS outros_custos_adicionais,
        {money("cast(o_totalprice AS decimal(18,2)) + CASE o_orderkey % 17 WHEN 5 THEN 0.06 WHEN 0 THEN 0.05 ELSE 0 END")}
            AS valor_total_incl_impostos,
        CASE WHEN o_orderkey % 17 = 10 THEN cast(o_orderdate AS date) + 5 WHEN o_orderkey % 23 = 0 THEN NULL
             WHEN o_orderkey % 29 = 0 THEN cast(o_orderdate AS date) + 1 ELSE cast(o_orderdate AS date) END AS data_documento,
        'PROT' || cast(o_orderkey AS string) AS numero_protocolo,
        CASE WHEN o_orderkey % 17 = 10 OR o_orderkey % 29 = 0 THEN {d8('cast(o_orderdate AS date) + 5')}
             ELSE {d8('o_orderdate')} END || '120000' AS data_hora_emissao
        FROM orders JOIN j_1bnfe_active AS a ON a.docnum = {z('o_orderkey', 10)}
        LEFT JOIN line_sums AS s ON s.docnum = a.docnum WHERE o_orderkey % 17 <> 13""",
    "sa_excel_tax_plant_xref": f"""SELECT {z('n_nationkey', 14, '1')} AS cnpj, 'CT' || cast(n_nationkey AS string) AS centro,
        'tax' || cast(n_nationkey AS string) || '@example.com' AS email FROM nation WHERE n_nationkey <> 24""",
    "konv": " UNION ALL ".join(
        f"""SELECT {z('ok', 10)} AS knumv, {z('ln', 6)} AS kposn, '{kind}' AS kschl,
        {money(f"price * cast('{rate}' AS decimal(4,2))")} AS kwert, {money(points)} AS kbetr, '300' AS mandt
        FROM line WHERE {cond}"""
        for kind, rate, points, cond in [
            (k, r, p, "ok % 53 <> 0" if k == "BX23" else "ok >= 0") for k, r, p in _kinds
        ]
        + [("BX82", "0.02", "17", "ok % 59 = 0"), ("ZZZZ", "0.50", "1", "ok % 10 = 0")]
    ),
    "vbpa": f"""SELECT {z('o_orderkey', 10)} AS vbeln, CASE WHEN o_orderkey % 3 = 0 THEN 'CR' WHEN o_orderkey % 3 = 1
        THEN 'SP' ELSE 'AG' END AS parvw, {z('o_custkey % 10', 10)} AS lifnr, '300' AS mandt FROM orders""",
    "lfa1": f"""SELECT {z('s_suppkey', 10)} AS lifnr, s_name AS name1, 'Av ' || cast(s_suppkey AS string) AS stras,
        'Cidade ' || cast(s_nationkey AS string) AS ort01, 'S' || cast(s_nationkey AS string) AS regio,
        {z('s_suppkey', 14, '3')} AS stcd1, {z('s_suppkey', 12, '4')} AS stcd3, '300' AS mandt FROM supplier""",
    "sa_bsp_tax_law_icms": """SELECT 'L' || cast(r_regionkey AS string) AS icms_law,
        '0' || cast(r_regionkey AS string) AS tax_situation, r_name AS description FROM region WHERE r_regionkey < 2""",
    # Costs
    "tco_financial_plan": "SELECT nm AS tco_financial_plan_nm FROM (VALUES ('Plan 1997'), ('Plan 1998')) AS pl(nm)",
    "tco_cost": f"""SELECT 'K' || cast(o_orderkey AS string) AS tco_costid, o_orderkey AS tco_cost_id,
        CASE WHEN o_orderkey % 5 = 0 THEN 'P0' ELSE 'P1' END AS tco_cost_financial_plan,
        CASE WHEN o_orderkey % 5 = 0 THEN 'Plan 1997' ELSE 'Plan 1998' END AS tco_cost_financial_planname,
        'G' || cast(o_orderkey % 4 AS string) AS tco_cost_gl_account,
        'Account ' || cast(o_orderkey % 4 AS string) AS tco_cost_gl_accountname, {money('o_totalprice')} AS tco_cost_value,
        'm' || {z('month(cast(o_orderdate AS date))', 2)} AS tco_stringmonth,
        'C' || cast(o_custkey AS string) AS tco_cost_cost_center FROM orders""",
    "tco_cost_center": f"""SELECT 'C' || cast(c_custkey AS string) AS tco_cost_centerid,
        'CC' || cast(c_custkey AS string) AS tco_cost_center_id, c_name AS tco_cost_center_nm,
        CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE 'F' || cast((c_custkey - c_custkey % 2) % 3 AS string) END AS tco_function,
        'O' || {owner('c_custkey')} AS tco_capabilityowner, 'Owner ' || {owner('c_custkey')} AS tco_capabilityownername,
        'Y' || {owner('c_custkey')} AS tco_capabilityowneryominame, {money('c_acctbal')} AS tco_totalassigned,
        plan_id AS tco_financial_plan, {PLAN_NAME} AS tco_financial_planname FROM {plans('customer')}
        WHERE plan_id = 'P1' OR c_custkey % 5 <> 0""",
    "tco_gl_account": f"""SELECT 'G' || cast(r_regionkey AS string) AS tco_gl_accountid,
        'GL' || cast(r_regionkey AS string) AS tco_gl_account_id, 'AG' || cast(r_regionkey % 2 AS string)
        AS tco_gl_account_account_group, 'Group ' || cast(r_regionkey % 2 AS string) AS tco_gl_account_account_groupname,
        CASE WHEN r_regionkey = 3 THEN '0' ELSE '1' END AS tco_todisplay,
        plan_id AS tco_financial_plan, {PLAN_NAME} AS tco_financial_planname FROM {plans('region')}
        WHERE r_regionkey < 4""",
    "tco_cost_center_allocation": f"""SELECT 'C' || cast(c AS string) AS tco_cost_center_allocation_cost_center,
        'G' || cast(g AS string) AS tco_cost_center_allocation_gl_account,
        plan_id AS tco_cost_center_allocation_financial_plan, {PLAN_NAME} AS tco_cost_center_allocation_financial_planname,
        'M' || {z('m', 2)} AS tco_monthname,
        cast(CASE c % 3 WHEN 0 THEN 100 WHEN 1 THEN 60 ELSE 33.25 END AS decimal(7,2)) AS tco_assignment
        FROM {plans(_seen)} WHERE (c + g + m) % 7 <> 0 AND c % 11 <> 3""",
    "tco_application": f"""SELECT 'A' || cast(p_partkey AS string) AS tco_applicationid,
        'APP' || cast(p_partkey AS string) AS tco_application_id, 'App ' || cast(p_partkey AS string) AS tco_application_name,
        'O' || {owner('p_partkey')} AS tco_capabilityowner, 'Owner ' || {owner('p_partkey')} AS tco_capabilityownername,
        'Lead ' || cast(p_partkey AS string) AS tco_ownername, 'lead' || cast(p_partkey AS string) AS tco_ownerstring,
        CASE WHEN p_partkey % 13 = 7 THEN 'Inactive' ELSE 'Active' END AS statuscodename,
        'S' || cast(p_partkey % 4 AS string) AS tco_shared_component_type,
        'Comp ' || cast(p_partkey % 4 AS string) AS tco_shared_component_typename,
        plan_id AS tco_financial_plan, {PLAN_NAME} AS tco_financial_planname FROM {plans('part')}""",
    "tco_application_assignment": f"""SELECT 'A' || cast(a AS string) AS tco_application,
        'App ' || cast(a AS string) AS tco_applicationname, 'C' || cast(c AS string) AS tco_cost_center,
        'G' || cast(g AS string) AS tco_gl_account, 'M' || {z('m', 2)} AS tco_monthname,
        cast(CASE WHEN a % 20 = 5 THEN 0 WHEN k = 0 THEN 60 ELSE 39.5 END AS decimal(7,2)) AS tco_assignment,
        plan_id AS tco_financial_plan, {PLAN_NAME} AS tco_financial_planname
        FROM (SELECT *, CASE WHEN k = 0 THEN c WHEN c % 4 < 2 THEN c + 1 - 2 * (c % 2) ELSE c + 6 END AS a
              FROM {times(plans(_seen), 'k', [0, 1])}) AS pairs
        WHERE (c * 3 + g + m) % 5 <> 0 AND NOT (plan_id = 'P1' AND c % 40 = 9)""",
    "tco_application_buregion_assign": f"""SELECT 'A' || cast(p_partkey AS string) AS tco_application,
        r_name AS tco_buregionname, cast(CASE WHEN p_partkey % 4 = 1 THEN 19.8 ELSE 20 END AS decimal(7,2)) AS tco_assignment,
        plan_id AS tco_financial_plan, {PLAN_NAME} AS tco_financial_planname
        FROM {times(plans('part'), 'r_name', REGIONS)} WHERE p_partkey % 4 <> 2""",
    "tco_business_unit_region": "SELECT r_name AS tco_business_unit_region_name FROM region",
    "tco_shared_component_type": """SELECT 'S' || cast(s_suppkey AS string) AS tco_shared_component_typeid,
        'Comp ' || cast(s_suppkey AS string) AS tco_description, 'Lead ' || s_name AS tco_ownername FROM supplier""",
    "tco_shared_component_assignment": f"""SELECT 'SA' || cast(s_suppkey AS string) || plan_id
        AS tco_shared_component_assignmentid, 'SA' || cast(s_suppkey AS string) AS tco_name,
        'S' || cast(s_suppkey AS string) AS tco_shared_component_type,
        'Comp ' || cast(s_suppkey AS string) AS tco_shared_component_typename,
        CASE WHEN s_suppkey % 2 = 0 THEN 'app' ELSE 'bu-region' END AS tco_assignment_type,
        plan_id AS tco_financial_plan, {PLAN_NAME} AS tco_financial_planname FROM {plans('supplier')}
        WHERE s_suppkey % 9 <> 8""",
    "tco_shared_component_app_assignment": f"""SELECT 'SA' || cast(p_partkey % 40 AS string) || plan_id
        AS tco_shared_component_assignment, 'SA' || cast(p_partkey % 40 AS string) AS tco_shared_component_assignmentname,
        'A' || cast(p_partkey AS string) AS tco_application, 'App ' || cast(p_partkey AS string) AS tco_applicationname,
        cast(CASE WHEN p_partkey >= 200 THEN 0 WHEN p_partkey % 40 < 20 THEN 20 ELSE 19 END AS decimal(7,2)) AS tco_assignment,
        {money('1000 + p_retailprice')} AS tco_dolassigned, plan_id AS tco_financial_plan,
        {PLAN_NAME} AS tco_financial_planname FROM {plans('part')} WHERE p_partkey % 5 <> 4""",
    "tco_shared_component_buregion_assignment": f"""SELECT 'SA' || cast(s AS string) || plan_id
        AS tco_shared_component_assignment, 'SA' || cast(s AS string) AS tco_shared_component_assignmentname,
        r_name AS tco_buregionname, cast(CASE WHEN s = 1 THEN 20 ELSE 12.5 + r_regionkey END AS decimal(7,2)) AS tco_assignment,
        plan_id AS tco_financial_plan, {PLAN_NAME} AS tco_financial_planname
        FROM {times(plans('region'), 's', [1, 3])} WHERE r_regionkey <> 4 OR s = 1""",
    "tco_assets": f"""SELECT 'AS' || cast(p_partkey AS string) AS tco_asset_item_number, p_name AS tco_description,
        cast(p_partkey % 2 AS int) AS tco_app_releted, CASE WHEN p_partkey % 2 = 1 THEN 'Yes' ELSE 'No' END AS tco_app_reletedname,
        CASE WHEN p_partkey % 30 < 10 THEN 'A1' WHEN p_partkey % 3 = 0 THEN NULL
            ELSE 'A' || cast(p_partkey % 20 AS string) END AS tco_application,
        'C' || cast(p_partkey - p_partkey % 10 + 1 AS string) AS tco_cost_center,
        'Center ' || cast(p_partkey - p_partkey % 10 + 1 AS string) AS tco_cost_centername,
        {money('CASE WHEN p_partkey % 6 = 0 THEN 0.5 ELSE p_retailprice END')} AS tco_net_book_value,
        CASE WHEN p_partkey % 4 = 0 THEN 'P0' ELSE 'P1' END AS tco_financial_plan,
        CASE WHEN p_partkey % 4 = 0 THEN 'Plan 1997' ELSE 'Plan 1998' END AS tco_financial_planname FROM part""",
}

_WORDS = {name: re.compile(rf"\b(?:FROM|JOIN)\s+{name}\b") for name in (*TABLES, *BASE_TABLES)}


def _needed(sql: str, found: dict[str, None]) -> None:
    for name, text in TABLES.items():
        if name not in found and _WORDS[name].search(sql):
            _needed(text, found)
            found[name] = None


def with_inputs(sql: str) -> str:
    """A query (which may start with WITH) behind the input tables it reads, for DuckDB."""
    return _with_inputs(sql).replace("explode(array(", "unnest(list_value(")


def _with_inputs(sql: str) -> str:
    found: dict[str, None] = {}
    _needed(sql, found)
    ctes = ", ".join(f"{name} AS ({TABLES[name]})" for name in found)
    if not ctes:
        return sql
    body = sql.strip()
    return f"WITH {ctes}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {ctes} {body}"


def on_spark(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run shared-subset SQL on Spark over the parquet files of ``sf_dir``."""
    text = _with_inputs(sql)
    used = [t for t in BASE_TABLES if _WORDS[t].search(text)]
    if not used:
        return spark.sql(text)
    ctes = ", ".join(f"{t} AS (SELECT * FROM parquet.`{sf_dir.rstrip('/')}/{t}.parquet`)" for t in used)
    return spark.sql(f"WITH {ctes}, {text[5:]}" if text.startswith("WITH ") else f"WITH {ctes} {text}")


def adapted(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(spark, lambda name: on_spark(spark, sf_dir, f"SELECT * FROM {name}"))
