"""Fixed values. They have to equal the published ones for equal results."""

# Pieces per pallet by material group, used for plants.
PALLETS_PLANT = (
    ("81222", 11616, "Cans"),
    ("81262", 11088, "Cans"),
    ("81312", 9504, "Cans"),
    ("81362", 8169, "Cans"),
    ("81372", 8448, "Cans"),
    ("81410", 7080, "Cans"),
    ("81472", 6224, "Cans"),
    ("81710", 3768, "Cans"),
    ("83262", 11088, "Cans"),
    ("83312", 9504, "Cans"),
    ("83372", 8446, "Cans"),
    ("83472", 6224, "Cans"),
    ("83710", 4082, "Cans"),
    ("86262", 11088, "Cans"),
    ("86312", 9504, "Cans"),
    ("86473", 6224, "Cans"),
    ("89002", 289800, "Ends"),
    ("89202", 275310, "Ends"),
    ("89209", 146832, "Ends"),
)

# The same for warehouses; two groups differ.
PALLETS_WAREHOUSE = tuple(
    (group, {"81372": 8446, "81710": 4082}.get(group, pieces), kind) for group, pieces, kind in PALLETS_PLANT
)

# Pieces per pallet of packaging materials.
PACKAGING = (
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
)

# Location codes that report under another plant code.
PLANT_CODES = {"BRPD": "BRPA", "BRRE": "BRPE", "BRRC": "BRPE", "RISC": "BR3R"}

# Ledger scope.
LEDGER_COMPANIES = ("1000", "1001", "1002", "1003", "1004", "1005", "1006", "1007")
LEDGER_ACCOUNTS = ("0112410101", "0212200101")
LEDGER_PARTNERS = ("121001", "121002", "121003", "121004", "121005", "121006", "121007", "126020")
SALES_COMPANIES = LEDGER_COMPANIES + ("1008", "1021", "1022", "1025")
NOTE_TYPES = ("DG", "DR", "R1", "KR")
DEBIT_TYPES = ("DR", "RE", "KR")
CREDIT_TYPES = ("DG", "R1")
DEBIT_PREFIXES = ("DEBIT NOTE ", "ND ")
CREDIT_PREFIXES = ("NC ",)

# Freight codes on invoices.
FREIGHT_TYPES = (
    ("0", "Contratação do Frete por conta do Remetente (CIF)"),
    ("1", "Contratação do Frete por conta do Destinatário (FOB)"),
    ("2", "Contratação do Frete por conta de Terceiros"),
    ("3", "Transporte Próprio por conta do Remetente"),
    ("4", "Transporte Próprio por conta do Destinatário"),
    ("9", "Sem Ocorrência de Transporte"),
)

# Operation names of invoices that are snapshotted; the double spaces and the no-break space belong to them.
OPERATIONS = (
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
TRANSFER_OPERATION = "Transferência produção estabelecimento"
SNAPSHOT_MATERIAL_TYPES = ("HALB", "FERT", "LEIH", "VERP")

# Pricing condition kinds.
CONDITION_BASE = "BX10"
CONDITION_ICMS = "BX13"
CONDITION_IPI = "BX23"
CONDITION_COFINS = "BX72"
CONDITION_PIS = "BX82"
CONDITION_IPI_RATE = "IPVA"

# Messages of the invoice rules, in rule order.
INVOICE_MESSAGES = (
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
)
CANCELLED_STATES = ("CANCEL00", "CANCEL01", "CANCEL02")
INVOICE_STATUS = ("Não Carregada", "Incorreta", "Correta")
