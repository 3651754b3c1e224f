"""Display names for report columns, applied in a last step."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_labels(df: DataFrame, labels: Mapping[str, str] | Callable[[str], str]) -> DataFrame:
    """Rename columns for display; names without a label stay."""
    name = labels if callable(labels) else (lambda c: labels.get(c, c))
    return df.select(*[F.col(f"`{c}`").alias(name(c)) for c in df.columns])


def CAPACITY(column: str) -> str:
    """``stock_quantity_ag_cans`` -> ``Stock Quantity AG - Cans``."""
    words = ["AG" if w == "ag" else w.capitalize() for w in column.split("_")]
    if words[-1] in ("Cans", "Ends"):
        words.insert(-1, "-")
    return " ".join(words)


# Column headings of the ledger tables.
LEDGER = {
    "comp_code": "Comp. Code",
    "plant": "Plant",
    "customer_group": "Customer Group",
    "customer": "Customer",
    "vendor": "Vendor",
    "trading_partner": "Trading Partner",
    "assignment": "Assignment",
    "gl_account": "G/L Account",
    "user_name": "User name",
    "business_place": "Business Place",
    "document_type": "Document Type",
    "currency": "Currency",
    "document_number": "Document Number",
    "line_item": "Line Item",
    "year_month": "Year/Month",
    "posting_date": "Posting Date",
    "document_date": "Document Date",
    "cost_center": "Cost Center",
    "amount_local": "Amount in local cur.",
    "amount_third": "Valuated amt loc curr 3",
    "reference": "Reference",
    "text": "Text",
    "aging": "Aging",
    "aging_category": "Aging Category",
    "balance_result": "Balance Result",
    "balance_type": "Balance Type",
    "material_group": "Produto",
    "product": "Produto2",
    "quantity": "Quantity",
    "net_revenue": "Revenue/Net Revenue",
}

# Column headings of the sales tables.
SALES = {
    "nota_fiscal": "Nota Fiscal",
    "comp_code": "Comp. Code",
    "plant": "Plant",
    "customer_group": "Customer Group",
    "customer": "Customer",
    "name_1": "Name 1",
    "material_type": "Material Type",
    "material_group": "Material Group",
    "material_number": "Material Number",
    "period": "Period",
    "invoice_date": "Data fatura",
    "sales_quantity": "Sales Quantity",
    "base_unit": "Base Unit of Measure",
    "sum_sales": "Sum Sales",
    "rebate_1": "UNUSED Rebate 1",
    "condition_2": "UNUSED Condition 2",
    "unexpected_sd": "UNEXPECTED SD",
    "rebate_4": "UNUSED Rebate 4",
    "net_revenue": "Revenue/Net Revenue",
    "record_currency": "Currency of record",
    "document_number": "Document Number",
    "document_date": "Document Date",
    "quantity": "Quantity",
    "sales_and_rebate": "Sales + Rebate 1",
    "amount_third": "Valuated amt loc curr 3",
    "difference": "Check",
    "pk1": "PK1",
    "pk2": "PK2",
}

# Column headings of the class summary.
SUMMARY = {
    "product": "Produto",
    "sum_quantity": "Sum Quantity",
    "sum_amount_local": "Sum Amount in local cur.",
    "sum_amount_third": "Sum Valuated amt loc curr 3",
    "total_net_revenue": "Total Net Revenue",
    "average_cost": "Average Cost",
}

# Column headings of the invoice check.
CHECK = {
    "doc_num": "Doc Num",
    "center": "Centro",
    "total_value": "Valor Incl. Impostos",
    "item_value": "Vlr Item",
    "access_key": "Chave de Acesso",
    "status": "Indicador Status NF",
    "email": "Email",
    "own_tax_id": "CNPJ Empresa",
    "issuer_tax_id": "CNPJ Emitente",
    "freight": "Vlr Frete",
    "insurance": "Vlr Seguro",
    "discount": "Vlr Desconto",
    "other_cost": "Vlr Outros Custos",
    "issue_date": "Data Emissao",
    "number": "Num NF",
    "user": "Usuario",
    "partner": "Parceiro",
    "posting_date": "Data Lancamento",
    "service_flag": "Flag NF Serv",
    "ledger_document": "Inv Doc Number",
    "company_code": "Company Code",
    "fiscal_year": "Fiscal Year",
    "cancelled": "NF Cancelada",
    "tax_process": "GRC Processo",
    "tax_access_key": "GRC Chave de Acesso",
    "tax_freight": "GRC Valor Total do Frete",
    "tax_insurance": "GRC Valor Total do Seguro",
    "tax_discount": "GRC Valor Total do Desconto",
    "tax_other": "GRC Outros Custos Adicionais",
    "tax_recipient_id": "GRC CNPJ Destinatário",
    "tax_issuer_id": "GRC CNPJ Emitente",
    "tax_total": "GRC Valor Total Incl Impostos",
    "tax_document_date": "GRC Data Documento",
    "tax_protocol": "GRC Numero Protocolo",
    "tax_number": "GRC Num NF",
    "tax_issue_date": "GRC Data Emissao",
    "message": "Mensagem de Erro",
}

# Column headings of the invoice snapshot.
SNAPSHOT = {f"key_part_{i}": f"Componente Chave de Acesso {i}" for i in range(1, 10)} | {
    "a_issuer_name": "A - Identificação Emitente",
    "a_issuer_street": "A - Endereço Emitente",
    "a_issuer_district": "A - Bairro Emitente",
    "a_issuer_postcode": "A - CEP Emitente",
    "a_issuer_city": "A - Município Emitente",
    "a_issuer_state": "A - Estado Emitente",
    "a_issuer_phone": "A - Fone/Fax Emitente",
    "b_operation": "B - Natureza da Operação",
    "c_issuer_state_id": "C - Inscrição Estadual Emitente",
    "d_direction": "D - Direção",
    "e_number": "E - Num NF",
    "f_series": "F - Série",
    "g_access_key": "G - Chave de Acesso",
    "h_protocol": "H - Protocolo",
    "i_issuer_tax_id_plain": "I - CNPJ do Emitente - noformat",
    "i_issuer_tax_id": "I - CNPJ do Emitente",
    "j_customer_name": "J - Nome Cliente",
    "k_customer_street": "K - Endereço Cliente",
    "l_customer_city": "L - Município",
    "m_customer_tax_id": "M - CNPJ Cliente",
    "n_customer_district": "N - Bairro",
    "o_customer_state": "O - Estado",
    "p_customer_phone": "P - Fone/Tax",
    "q_customer_postcode": "Q - CEP",
    "r_customer_state_id": "R - Inscrição Estadual Cliente",
    "s_issue_date": "S - Data da Emissão",
    "t_icms_base": "T - Base de Calc do ICMS",
    "u_freight": "U - Valor do Frete",
    "v_icms": "V - Valor do ICMS",
    "x_insurance": "X - Valor do Seguro",
    "z_icms_st_base": "Z - Base de Calc ICMS S.T.",
    "z1_discount": "Z1 - Desconto",
    "z2_icms_subst": "Z2 - Valor do ICMS Subst.",
    "z3_other_expenses": "Z3 - Outras Despesas",
    "z4_import_value": "Z4 - Valor Importação",
    "z5_ipi_total": "Z5 - Valor Total IPI",
    "z6_icms_origin_state": "Z6 - ICMS UF Remetente",
    "z7_icms_target_state": "Z7 - ICMS UF Destino",
    "z8_fcp_target_state": "Z8 - Valor FCP UF Destino",
    "z9_tax_total": "Z9 - Valor Total Impostos",
    "z10_pis": "Z10 - Valor do PIS",
    "z11_cofins": "Z11 - Valor da COFINS",
    "z12_products_total": "Z12 - Valor Total Produtos",
    "z13_invoice_total": "Z13 - Valor Total da Nota",
    "z14_carrier_name": "Z14 - Nome Transportador",
    "z15_carrier_street": "Z15 - Endereço Transportador",
    "z16_packages": "Z16 - Quantidade",
    "z17_freight": "Z17 - Frete",
    "z21_carrier_city": "Z21 - Município Transportador",
    "z23_gross_weight": "Z23 - Peso Bruto",
    "z24_state": "Z24 - UF",
    "z25_carrier_state": "Z25 - UF",
    "z26_carrier_tax_id": "Z26 - CNPJ Transportador",
    "z27_carrier_state_id": "Z27 - Inscrição Estadual Transportador",
    "z28_net_weight": "Z28 - Peso Líquido",
    "item_number": "Número do Item",
    "z29_product_code": "Z29 - Código do Produto",
    "z30_product_text": "Z30 - Descrição do Produto",
    "z31_goods_code": "Z31 - NCM/SH",
    "z32_origin_situation": "Z32 - O/CST",
    "z33_operation_code": "Z33 - CFOP",
    "z34_unit": "Z34 - UN",
    "z35_quantity": "Z35 - Quantidade",
    "unit_price_plain": "teste",
    "z36_unit_price": "Z36 - Valor Unitário",
    "z37_total": "Z37 - Valor Total",
    "z38_discount": "Z38 - Valor Desconto",
    "z39_icms_base": "Z39 - Base de Calc do ICMS",
    "z40_icms": "Z40 - Valor do ICMS",
    "z41_ipi": "Z41 - Valor Total IPI",
    "z42_icms_rate": "Z42 - Alíquota ICMS",
    "z43_ipi_rate": "Z43 - Alíquota IPI",
}
