"""Table schemas and fixed label values.

Fixed values below (column names, labels, account codes, weights) have to equal those of the data
sources and of the published gold tables, so they are stated as they are.
"""

from __future__ import annotations




STATEMENT_SCHEMA = "CNPJ_CIA string, DT_REFER string, VERSAO int, DT_FIM_EXERC string, ORDEM_EXERC string, " \
    "ESCALA_MOEDA string, CD_CONTA string, DS_CONTA string, VL_CONTA double"

MACRO_ITEM = "array<struct<securityIdentificationCode:string,description:string,groupDescription:string," \
    "value:string,rate:string,lastUpdate:string>>"

EVENTS_SCHEDULE_SOURCE = [
    "Data do Evento", "Data do Pagamento", "Emissor", "Ativo", "Evento", "Tipo", "Taxa/Percentual", "Liquidação",
]
EVENTS_SCHEDULE_COLUMNS = [
    "event_date", "payment_date", "issuer", "asset_code", "event", "yield_type", "rate_or_percent", "settlement_date",
]
EVENTS_SCHEDULE_GOLD = "event_date date, payment_date date, issuer string, asset_code string, event string, " \
    "yield_type string, rate_or_percent double, settlement_date date"

TRADED_PRICES_SOURCE = [
    "Data", "Emissor", "Código do Ativo", "ISIN", "Quantidade", "Número de Negócios", "PU Mínimo", "PU Médio",
    "PU Máximo", "% PU da Curva",
]
TRADED_PRICES_COLUMNS = [
    "ref_date", "issuer", "asset_code", "ISIN", "qty", "amt_of_trades", "min_unit_price", "avg_unit_price",
    "max_unit_price", "curve_price_percent",
]
TRADED_PRICES_GOLD = "ref_date date, issuer string, asset_code string, ISIN string, qty bigint, " \
    "amt_of_trades bigint, min_unit_price double, avg_unit_price double, max_unit_price double, " \
    "curve_price_percent double"

MACRO_GOLD = "security_id string, description string, data_type string, value double, ref_date date"

TERMS_COLUMNS = {
    "Serie Emissao": "series",
    "Data de Emissao": "issue_date",
    "Data de Vencimento": "maturity",
    "indice": "indexer",
    "Juros Criterio Novo - Taxa": "coupon",
    "Percentual Multiplicador/Rentabilidade": "coupon_alt",
    "Criterio de Calculo": "base",
    "Tipo de Amortizacao": "amort_type",
    "Garantia/Especie": "guarantees",
}
COVENANT_COLUMNS = ["Resgate Antecipado", "Escritura Padronizada", "Classe"]

STATEMENT_CODES = {
    "BPA": "BALANCO_PATRIMONIAL_ATIVO",
    "BPP": "BALANCO_PATRIMONIAL_PASSIVO",
    "DFC_MI": "FLUXO_DE_CAIXA_INDIRETO",
    "DRE": "DRE",
}
AGGREGATIONS = {"con": "Consolidado", "ind": "Individual"}
ACCOUNT_TYPES = {"BALANCO_PATRIMONIAL_ATIVO": "ATIVO", "BALANCO_PATRIMONIAL_PASSIVO": "PASSIVO"}
LAST_EXERCISE = "ÚLTIMO"
AMOUNT_SCALES = {"UNIDADE": 1, "MIL": 1_000, "MILHOES": 1_000_000, "MILHÕES": 1_000_000}

ACCOUNTS_EXACT = {
    "revenue": "3.01", "ebit": "3.05", "depreciation": "3.04.04", "cash": "1.01.01", "interest_is": "3.06.02",
}
ACCOUNTS_PREFIX = {
    "debt_short_term": "2.01.04", "debt_long_term": "2.02.01", "interest_cf": "6.01.02.02", "capex_raw": "6.02.01",
    "wc_change": "6.01.02",
}
FINANCIALS_COLUMNS = [
    "issuer_cnpj", "date", "quarter", "year", "revenue", "ebitda", "ebit", "depreciation", "net_debt", "total_debt",
    "debt_short_term", "debt_long_term", "cash", "interest_paid", "capex", "wc_change",
]

MACRO_TYPES = {
    "TAXAS DE CÂMBIO": "FX",
    "TAXAS DE JUROS INTERNACIONAL": "INTERNATIONAL_RATES",
    "TAXAS DE JUROS NACIONAL": "DOMESTIC_RATES",
}
FILING_CATEGORIES = {
    "Fato Relevante": "FATO_RELEVANTE",
    "Comunicado ao Mercado": "COMUNICADOS_AO_MERCADO",
    "Escrituras e aditamentos de debêntures": "ESCRITURAS_E_ADITAMENTO_DE_DEBENTURES",
}
RISK_LEVELS = {
    "high": "high", "medium": "medium", "low": "low", "Provável": "high", "Possível": "medium", "Remoto": "low",
}
LISTING_TABLE_CLASS = "Tab10333333"

# Retrieval settings.
CHUNK_TOKENS = 512
CHUNK_OVERLAP = 128
EMBEDDING_DIM = 1024
VECTOR_WEIGHT = 0.7
KEYWORD_WEIGHT = 0.3
RETRIEVAL_TOP_K = 20
RERANK_TOP_K = 5
SIMILARITY_THRESHOLD = 0.65
EXACT_MATCH_BOOST = 1.5
# profile -> (retrieval_top_k, rerank_top_k, similarity_threshold, vector_weight, keyword_weight)
AGENT_PROFILES = {
    "estruturacao": (20, 7, 0.62, 0.65, 0.35),
    "monitor": (15, 5, 0.70, 0.60, 0.40),
    "geral": (20, 5, 0.65, 0.70, 0.30),
}
# Names in the portal's buttons: fixed values.
PROTOCOL_PARAMETER, DOWNLOAD_CALL, PUBLICATION_CALL = "NumeroProtocoloEntrega", "OpenDownloadDocumentos", "mostraLocaisPublicacao"
# The words that expand a query unless a table is given.
SYNONYMS = {
    "lucro": ["resultado", "ganho", "lucro líquido"],
    "dívida": ["endividamento", "passivo", "débito"],
    "receita": ["faturamento", "vendas", "revenue"],
    "ebitda": ["lajida", "resultado operacional"],
    "alavancagem": ["leverage", "debt ratio"],
}
