"""What the reference SQL takes as given, written down apart from the library, so that a slip there shows."""

from __future__ import annotations

# Fixed values. They have to equal the published ones for equal results.
_PALLETS = """81222 11616 Cans|81262 11088 Cans|81312 9504 Cans|81362 8169 Cans|81372 {} Cans|81410 7080 Cans|81472 6224 Cans
81710 {} Cans|83262 11088 Cans|83312 9504 Cans|83372 8446 Cans|83472 6224 Cans|83710 4082 Cans|86262 11088 Cans|86312 9504 Cans
86473 6224 Cans|89002 289800 Ends|89202 275310 Ends|89209 146832 Ends"""


def _pallets(text: str) -> list[tuple[str, int, str]]:
    rows = [row.split() for row in text.replace("\n", "|").split("|")]
    return [(group, int(pieces), kind) for group, pieces, kind in rows]


PALLETS_PLANT = _pallets(_PALLETS.format(8448, 3768))
PALLETS_WAREHOUSE = _pallets(_PALLETS.format(8446, 4082))
PACKAGING = [
    ("000000000300000014", "VERP", "10"),
    ("000000000300000027", "VERP", "32.5"),
    ("000000000300000131", "VERP", "10"),
    ("000000000300000230", "VERP", "10"),
    ("000000000300000253", "VERP", "10"),
    ("000000000350000004", "LEIH", "10"),
    ("000000000350000006", "LEIH", "0"),
    ("000000000350000005", "LEIH", "10"),
    ("000000000350000007", "LEIH", "32.5"),
    ("000000000350000021", "LEIH", "10"),
    ("000000000350000034", "LEIH", "10"),
    ("000000000350000072", "LEIH", "10"),
]
PLANT_CODES = {"BRPD": "BRPA", "BRRE": "BRPE", "BRRC": "BRPE", "RISC": "BR3R"}
LEDGER_COMPANIES = "1000 1001 1002 1003 1004 1005 1006 1007".split()
LEDGER_ACCOUNTS = "0112410101 0212200101".split()
LEDGER_PARTNERS = "121001 121002 121003 121004 121005 121006 121007 126020".split()
SALES_COMPANIES = "1000 1001 1002 1003 1004 1005 1006 1007 1008 1021 1022 1025".split()
NOTE_TYPES = "DG DR R1 KR".split()
DEBIT_TYPES = "DR RE KR".split()
CREDIT_TYPES = "DG R1".split()
FREIGHT_TYPES = [
    ("0", "Contratação do Frete por conta do Remetente (CIF)"),
    ("1", "Contratação do Frete por conta do Destinatário (FOB)"),
    ("2", "Contratação do Frete por conta de Terceiros"),
    ("3", "Transporte Próprio por conta do Remetente"),
    ("4", "Transporte Próprio por conta do Destinatário"),
    ("9", "Sem Ocorrência de Transporte"),
]
TRANSFER_OPERATION = "Transferência produção estabelecimento"
SNAPSHOT_MATERIAL_TYPES = "HALB FERT LEIH VERP".split()
CANCELLED_STATES = "CANCEL00 CANCEL01 CANCEL02".split()
INVOICE_STATUS = ("Não Carregada", "Incorreta", "Correta")
INVOICE_MESSAGES = [
    "Existe um evento de cancelamento para o Doc Num. no GRC. ",
    "Campo CNPJ Vazio. ",
    "Diferença de CNPJ entre ECC e GRC. ",
    "NF não possui chave de acesso. ",
    "Existe uma diferença no Valor Total entre SAP e GRC. ",
    "Existe uma diferença no Valor Frete entre SAP e GRC. ",
    "Existe uma diferença no Valor Seguro entre SAP e GRC. ",
    "Existe uma diferença no Valor Desconto entre SAP e GRC. ",
    "Existe uma diferença no Valor Outros Custos entre SAP e GRC. ",
    "Data de Emissão no ECC diferente da Data Emissão no GRC. ",
    "Data de Emissão maior que Data de Lançamento. ",
    "Data do Lançamento diferente da Data de Criação. ",
    "NF não migrou para o G3P. ",
    "Chave de acesso do ECC divergente da chave de acesso do XML. ",
    "NF com flag de Serviço ativado. ",
    "Chave de Acesso menor que 44 caracteres. ",
]

# Columns of the reports.
KEY_PARTS = "regio nfyear nfmonth stcd1 model serie nfnum9 docnum9 cdv".split()
INVOICE_HEADER = """doc_num center total_value access_key email own_tax_id issuer_tax_id issue_date number user partner posting_date
    creation_date service_flag ledger_document company_code fiscal_year cancelled""".split()
INVOICE_OUTPUT = """doc_num center total_value item_value access_key status email own_tax_id issuer_tax_id freight insurance discount
    other_cost issue_date number user partner posting_date service_flag ledger_document company_code fiscal_year cancelled
    tax_process tax_access_key tax_freight tax_insurance tax_discount tax_other tax_recipient_id tax_issuer_id tax_total
    tax_document_date tax_protocol tax_number tax_issue_date message""".split()
#: Numbers printed with decimals other than two.
DECIMALS = {"z23_gross_weight": 3, "z28_net_weight": 3, "z35_quantity": 4, "z36_unit_price": 6}
#: Numbers whose printed decimals follow the width of the whole part.
TAIL_BY_WIDTH = ("z23_gross_weight", "z28_net_weight", "z36_unit_price")
STAGE_COLUMNS = """comp_code customer vendor trading_partner assignment gl_account user_name business_place document_type currency
    document_number year_month posting_date document_date cost_center amount_local amount_third reference text aging
    aging_category""".split()
LEDGER_COLUMNS = [*STAGE_COLUMNS, "line_item"]
_MEASURES = """capacity_quantity_plant capacity_quantity_ag capacity_quantity_total stock_quantity_plant stock_quantity_ag
    sales_quantity_plant sales_quantity_ag production_quantity_plant daily_result_plant daily_result_ag daily_result_total
    warehouse_ocupation_plant warehouse_ocupation_ag warehouse_ocupation_total""".split()
_ONLY = "capacity_quantity stock_quantity sales_quantity daily_result warehouse_ocupation".split()
_SPLITS = ("_cans", "_ends", "")
PLANT_MEASURES = [m + s for m in _MEASURES for s in _SPLITS]
WAREHOUSE_MEASURES = [f"{m}_ag_only{s}" for m in _ONLY for s in _SPLITS]
