"""Word lists, lookup tables, codes and labels that results depend on.

Nothing here is logic. The operators take these tables as parameters; other data sets pass their own.
"""

# Month abbreviations as written in the source files.
MONTH_NUMBERS = {
    "jan": 1, "fev": 2, "mar": 3, "abr": 4, "mai": 5, "jun": 6,
    "jul": 7, "ago": 8, "set": 9, "out": 10, "nov": 11, "dez": 12,
}

# Spellings of a customer segment, by match key.
SEGMENT_VARIANTS = {
    "atacado": "Atacado", "atac": "Atacado",
    "governo": "Governo", "gov": "Governo", "poder publico": "Governo",
    "industria": "Industria", "ind": "Industria",
    "varejo": "Varejo",
}

# Spellings of a region, by match key.
REGION_VARIANTS = {
    "sul": "Sul",
    "norte": "Norte",
    "nordeste": "Nordeste", "ne": "Nordeste", "nord este": "Nordeste",
    "sudeste": "Sudeste", "se": "Sudeste", "sudest": "Sudeste",
    "centro oeste": "Centro-Oeste", "co": "Centro-Oeste",
}

# Spellings of a customer status, by match key.
STATUS_VARIANTS = {"a": "Ativo", "ativo": "Ativo", "inativo": "Inativo"}

# State to region.
STATE_REGIONS = {
    "AC": "Norte", "AP": "Norte", "AM": "Norte", "PA": "Norte", "RO": "Norte", "RR": "Norte", "TO": "Norte",
    "AL": "Nordeste", "BA": "Nordeste", "CE": "Nordeste", "MA": "Nordeste", "PB": "Nordeste",
    "PE": "Nordeste", "PI": "Nordeste", "RN": "Nordeste", "SE": "Nordeste",
    "DF": "Centro-Oeste", "GO": "Centro-Oeste", "MT": "Centro-Oeste", "MS": "Centro-Oeste",
    "ES": "Sudeste", "MG": "Sudeste", "RJ": "Sudeste", "SP": "Sudeste",
    "PR": "Sul", "RS": "Sul", "SC": "Sul",
}

# Product subcategory to category.
SUBCATEGORY_CATEGORIES = {
    "Bombas": "Hidraulica", "Conexoes": "Hidraulica", "Mangueiras": "Hidraulica",
    "CLP": "Automacao", "Inversores": "Automacao", "Sensores": "Automacao",
    "Cabos": "Eletrica", "Iluminacao": "Eletrica", "Quadros": "Eletrica",
    "Eletricas": "Ferramentas", "Manuais": "Ferramentas", "Pneumaticas": "Ferramentas",
    "Protecao Cabeca": "EPI", "Protecao Maos": "EPI", "Protecao Respiratoria": "EPI",
}

# Company-form acronyms and how title case would spell them.
LEGAL_ACRONYMS = {"Eireli": "EIRELI", "Me": "ME", "Epp": "EPP"}

# Characters that may not stand in a column name.
FORBIDDEN_NAME_CHARACTERS = " ,;{}()\n\t="

# Day zero of spreadsheet serial dates, and the text that marks an open interval.
SERIAL_EPOCH = "1899-12-30"
OPEN_END = "9999-12-31"

# Codes and labels written into result columns.
MISSING_QUANTITY = "quantidade_ausente"
MISSING_PRICE = "valor_ausente"
INVALID_DATE = "data_invalida"
INVALID_CURRENCY = "moeda_invalida"
CANCELLED = "Cancelado"
BILLED = "Faturado"
FROM_PORTFOLIO = "carteira_historica"
FROM_ORDER = "pedido_original_sem_carteira"
FROM_NOBODY = "sem_vendedor"
ORPHAN_PARENT_LABEL = "Matriz não encontrada ("
TOTALS_LABEL = "TOTAL GERAL"
NATIONAL_SCOPE = "Nacional"

# The extra members of each dimension.
CUSTOMER_SENTINELS = [
    {"sk_cliente": -1, "id_cliente": "N/A", "razao_social": "Não Identificado",
     "segmento": "Não Identificado", "regiao": "Não Identificado", "situacao": "Não Identificado"},
]
PRODUCT_SENTINELS = [
    {"sk_produto": -1, "id_produto": "N/A", "id_produto_chave": "N/A", "descricao": "Não Identificado",
     "categoria": "Não Identificado", "subcategoria": "Não Identificado", "linha": "Não Identificado"},
]
SALESPERSON_SENTINELS = [
    {"sk_vendedor": 0, "id_vendedor": "N/A", "nome": "Sem vendedor associado (E-commerce)", "cargo": "N/A"},
    {"sk_vendedor": -1, "id_vendedor": "DESCONHECIDO", "nome": "Vendedor não identificado", "cargo": "N/A"},
    {"sk_vendedor": -2, "id_vendedor": "V001_AMBIGUO", "nome": "Vendedor ambíguo (código duplicado)", "cargo": "N/A"},
]

# Descriptions in the ambiguous-key report.
AMBIGUOUS_TAX_ID = "CNPJ em mais de um cliente"
AMBIGUOUS_SALESPERSON = "Código de vendedor usado por mais de uma pessoa"
AMBIGUOUS_SALES = "Venda com código de vendedor repetido"
AMBIGUOUS_PORTFOLIO = "Vínculo com código de vendedor repetido"
