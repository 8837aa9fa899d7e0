"""Clean values of the rendered rows as SQL fragments (common table expressions) over the test tables."""

# Customers with treated attributes.
CUSTOMERS = """
cust AS (
  SELECT c_custkey, 'C' || c_custkey AS id_cliente,
    c_name || CASE c_custkey % 4 WHEN 0 THEN ' Ltda' WHEN 1 THEN ' EIRELI' WHEN 2 THEN ' ME' ELSE ' S/A' END
      AS razao_social,
    CASE WHEN c_custkey % 61 = 7 THEN ''
      WHEN c_custkey % 53 = 5 THEN right(lpad(CAST(tax_no AS VARCHAR), 14, '0'), 13)
      ELSE lpad(CAST(tax_no AS VARCHAR), 14, '0') END AS cnpj_limpo,
    CASE WHEN c_custkey % 101 = 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 'Atacado'
      WHEN c_mktsegment = 'FURNITURE' THEN 'Governo' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Industria'
      ELSE 'Varejo' END AS segmento,
    CASE WHEN c_custkey % 90 = 52 THEN NULL ELSE region_name END AS regiao,
    (c_custkey % 45 = 7 AND c_custkey % 90 <> 52) AS regiao_inferida_por_uf,
    CASE WHEN c_custkey % 90 = 52 THEN 'XX' ELSE state_code END AS uf,
    'City ' || n_name AS cidade,
    CAST(DATE '1990-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS DATE) AS data_cadastro,
    CASE WHEN c_custkey % 77 = 3 THEN 'CX' || c_custkey
      WHEN c_custkey % 3 = 0 AND c_custkey % 50 <> 0 THEN 'C' || (c_custkey - c_custkey % 50) END AS id_matriz,
    CASE WHEN c_custkey % 3 = 2 THEN 'Inativo' ELSE 'Ativo' END AS situacao
  FROM (SELECT *, c_custkey - CASE WHEN c_custkey % 40 = 1 THEN 1 ELSE 0 END AS tax_no FROM customer)
  JOIN (SELECT n_nationkey, n_name,
          CASE n_regionkey WHEN 0 THEN 'Norte' WHEN 1 THEN 'Nordeste' WHEN 2 THEN 'Sudeste' WHEN 3 THEN 'Sul'
            ELSE 'Centro-Oeste' END AS region_name,
          CASE n_regionkey WHEN 0 THEN 'AM' WHEN 1 THEN 'BA' WHEN 2 THEN 'SP' WHEN 3 THEN 'RS' ELSE 'GO' END
            AS state_code
        FROM nation) ON c_nationkey = n_nationkey)"""

# Landed sale lines after exact-duplicate removal, unreadable cells as NULL.
LINES = """
line AS (
  SELECT CASE l_orderkey % 3 WHEN 0 THEN '2024' WHEN 1 THEN '2025' ELSE '2026' END AS safra,
    'PV' || l_orderkey || '-' || l_partkey || '-' || l_suppkey AS id_pedido,
    l_linenumber AS item,
    CASE WHEN (l_orderkey + l_partkey) % 83 <> 0 THEN CAST(o_orderdate AS DATE) END AS data_emissao,
    CASE WHEN o_custkey % 50 = 49 THEN 'X' ELSE 'C' END || o_custkey AS id_cliente,
    CASE WHEN l_partkey % 70 = 69 THEN 'Z' ELSE 'P' END || l_partkey AS id_produto,
    CASE WHEN (l_orderkey + l_linenumber) % 13 <> 0 THEN 'V' || l_suppkey END AS id_vendedor,
    CASE WHEN (l_orderkey + l_partkey) % 97 <> 0 THEN
      CAST(l_quantity AS INTEGER) * CASE WHEN l_orderkey % 3 = 0 AND cancelled THEN -1 ELSE 1 END END AS quantidade,
    CASE WHEN (l_orderkey + l_partkey) % 89 <> 0 THEN l_extendedprice END AS valor_unitario,
    l_discount AS desconto_fracao,
    CASE WHEN (l_orderkey + l_partkey) % 211 = 0 THEN NULL WHEN o_custkey % 10 = 0 THEN 'USD' ELSE 'BRL' END AS moeda,
    'Canal ' || (l_linenumber % 3) AS canal,
    CASE WHEN l_orderkey % 3 = 0 THEN CASE WHEN cancelled THEN 'Cancelado' ELSE 'Faturado' END
      WHEN (l_orderkey + l_linenumber) % 59 = 1 THEN NULL
      WHEN cancelled THEN 'Cancelado' ELSE 'Faturado' END AS status_pedido,
    CASE WHEN l_orderkey % 3 = 2 THEN 'F' || (l_suppkey % 5) END AS id_filial,
    CASE WHEN l_orderkey % 3 = 2 THEN l_tax END AS frete_rateado,
    CASE WHEN l_orderkey % 3 = 1 AND (l_orderkey + l_partkey) % 29 = 0 THEN 2 ELSE 1 END AS copies,
    CASE WHEN (l_orderkey + l_partkey) % 97 = 0 THEN 'quantidade_ausente' END AS r1,
    CASE WHEN (l_orderkey + l_partkey) % 89 = 0 THEN 'valor_ausente' END AS r2,
    CASE WHEN (l_orderkey + l_partkey) % 83 = 0 THEN 'data_invalida' END AS r3,
    CASE WHEN (l_orderkey + l_partkey) % 211 = 0 THEN 'moeda_invalida' END AS r4
  FROM (SELECT *, (l_linestatus = 'F' AND (l_orderkey + l_linenumber) % 10 = 0) AS cancelled FROM lineitem)
  JOIN orders ON l_orderkey = o_orderkey),
tagged AS (SELECT *, concat_ws('; ', r1, r2, r3, r4) AS motivo_rejeicao FROM line)"""

# Quotes, and valid sales with rate, status and revenue.
SALES = LINES + """,
quote AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS d,
    CAST(4500 + ((CAST(o_orderdate AS DATE) - DATE '1990-01-01') * 7919) % 2000 AS DOUBLE) / 1000 AS rate
  FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1995-01-16' AND isodow(o_orderdate) <= 5),
rated AS (
  SELECT t.*, CASE WHEN moeda = 'BRL' THEN 1.0::DOUBLE ELSE q.rate END AS taxa_cambio_aplicada
  FROM (SELECT * FROM tagged WHERE motivo_rejeicao = '') t ASOF LEFT JOIN quote q ON t.data_emissao >= q.d),
grossed AS (
  SELECT *, abs(quantidade) AS quantidade_absoluta,
    CASE WHEN coalesce(status_pedido = 'Cancelado', FALSE) THEN 0.0::DOUBLE
      ELSE CAST(abs(quantidade) AS DOUBLE) * valor_unitario * taxa_cambio_aplicada END AS receita_bruta
  FROM rated),
person AS (
  SELECT s_suppkey, s_name, 'V' || (s_suppkey - CASE WHEN s_suppkey % 10 = 9 THEN 1 ELSE 0 END) AS id_vendedor
  FROM supplier),
shared AS (SELECT id_vendedor FROM person GROUP BY 1 HAVING count(*) > 1),
sale AS (
  SELECT *, receita_bruta * (1.0::DOUBLE - desconto_fracao) AS receita_liquida, id_produto AS id_produto_chave,
    coalesce(id_vendedor IN (SELECT id_vendedor FROM shared), FALSE) AS id_vendedor_ambiguo
  FROM grossed)"""

# Assignments and their winner per sale.
PORTFOLIO = """
portfolio AS (
  SELECT 'C' || c_custkey AS id_cliente, 'V' || ((c_custkey * 7 + i * 13) % 10) AS id_vendedor, s AS vigencia_inicio,
    CASE WHEN i = 2 AND c_custkey % 3 <> 0 AND c_custkey % 11 <> 0 THEN
        CASE WHEN c_custkey % 97 = 1 THEN DATE '2999-12-31' ELSE DATE '9999-12-31' END
      ELSE CAST(s + CASE WHEN i = 2 THEN 400 ELSE 620 END AS DATE) END AS vigencia_fim
  FROM (SELECT c_custkey, i, CAST(CASE WHEN c_custkey % 11 = 0 THEN DATE '1980-01-01' ELSE DATE '1995-01-01' END
          + CAST(c_custkey % 200 + i * 500 AS INTEGER) AS DATE) AS s
        FROM customer, unnest([0, 1, 2]) AS u(i)))"""

# Returns joined to the sale they refer to (a sale key shared by several sales counts once).
RETURNS = SALES + """,
term AS (
  SELECT * FROM (
    SELECT *, count(*) OVER (PARTITION BY id_pedido, item) AS sales_of_key,
      row_number() OVER (PARTITION BY id_pedido, item ORDER BY safra DESC, valor_unitario DESC, desconto_fracao DESC,
        moeda DESC, taxa_cambio_aplicada DESC, status_pedido DESC, quantidade_absoluta DESC) AS pick
    FROM sale) WHERE pick = 1),
returned AS (
  SELECT 'D' || l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS id_devolucao,
    CASE WHEN (l_orderkey + l_linenumber) % 37 = 0 THEN 'PV2023' || l_orderkey
      ELSE 'PV' || l_orderkey || '-' || l_partkey || '-' || l_suppkey END AS id_pedido_origem,
    l_linenumber AS item,
    CAST(CAST(l_shipdate AS DATE) + 30 AS DATE) AS data_devolucao,
    CAST(l_quantity AS INTEGER) + CASE WHEN (l_orderkey + l_linenumber) % 41 = 0 THEN 1 ELSE 0 END
      AS quantidade_devolvida,
    'Motivo ' || (l_linenumber % 4) AS motivo
  FROM lineitem WHERE l_returnflag = 'R'),
valued AS (
  SELECT r.*, t.safra AS safra_origem, t.valor_unitario AS valor_unitario_origem,
    t.desconto_fracao AS desconto_fracao_origem, t.moeda AS moeda_origem,
    t.taxa_cambio_aplicada AS taxa_cambio_origem, t.status_pedido AS status_pedido_origem,
    t.quantidade_absoluta AS quantidade_faturada_origem,
    t.safra IS NOT NULL AS pedido_origem_encontrado,
    coalesce(r.quantidade_devolvida > t.quantidade_absoluta, FALSE) AS quantidade_excede_faturado,
    CASE WHEN t.safra IS NOT NULL THEN coalesce(t.status_pedido = 'Cancelado', FALSE) END
      AS devolucao_de_pedido_cancelado,
    coalesce(t.sales_of_key > 1, FALSE) AS origem_ambigua,
    CASE WHEN t.safra IS NULL THEN NULL WHEN coalesce(t.status_pedido = 'Cancelado', FALSE) THEN 0.0::DOUBLE
      ELSE CAST(r.quantidade_devolvida AS DOUBLE) * t.valor_unitario * t.taxa_cambio_aplicada END
      AS receita_devolucao_bruta
  FROM returned r LEFT JOIN term t ON r.id_pedido_origem = t.id_pedido AND r.item = t.item),
ret AS (
  SELECT *, receita_devolucao_bruta * (1.0::DOUBLE - desconto_fracao_origem) AS receita_devolucao_liquida
  FROM valued)"""

# Targets per year, region, segment and month.
TARGETS = """
cell AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS ano,
    CASE n_regionkey WHEN 0 THEN 'Norte' WHEN 1 THEN 'Nordeste' WHEN 2 THEN 'Sudeste' WHEN 3 THEN 'Sul'
      ELSE 'Centro-Oeste' END AS regiao,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Atacado' WHEN 'FURNITURE' THEN 'Governo'
      WHEN 'HOUSEHOLD' THEN 'Industria' ELSE 'Varejo' END AS segmento,
    CAST(month(o_orderdate) AS INTEGER) AS mes,
    sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS v
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3, 4),
annual AS (
  SELECT ano, regiao, segmento,
    CAST(sum(v) + CASE WHEN segmento = 'Varejo' THEN 1000 ELSE 0 END AS DOUBLE) AS meta_ano
  FROM cell GROUP BY 1, 2, 3),
monthly AS (
  SELECT a.ano, a.regiao, a.segmento, CAST(m.mes AS INTEGER) AS mes,
    CASE WHEN a.segmento = 'Governo' AND a.regiao IN ('Norte', 'Centro-Oeste') AND m.mes % 3 = 0 THEN NULL
      ELSE c.v END AS exact,
    CAST(CASE WHEN a.segmento = 'Governo' AND a.regiao IN ('Norte', 'Centro-Oeste') AND m.mes % 3 = 0 THEN NULL
      ELSE c.v END AS DOUBLE) AS meta_mensal,
    make_date(a.ano, m.mes, 1) AS data_referencia
  FROM annual a CROSS JOIN unnest(range(1, 13)) AS m(mes)
  LEFT JOIN cell c ON c.ano = a.ano AND c.regiao = a.regiao AND c.segmento = a.segmento AND c.mes = m.mes)"""

# Numbered dimensions: customers, products, salespeople with unique codes, region x segment.
DIMENSIONS = """
dcust AS (SELECT *, row_number() OVER (ORDER BY id_cliente) AS sk_cliente FROM cust),
dprod AS (SELECT 'P' || p_partkey AS id_produto_chave,
    row_number() OVER (ORDER BY 'P' || p_partkey) AS sk_produto FROM part),
dperson_all AS (
  SELECT id_vendedor, row_number() OVER (ORDER BY id_vendedor, lower(s_name)) AS sk_vendedor FROM person),
dperson AS (SELECT * FROM dperson_all WHERE id_vendedor NOT IN (SELECT id_vendedor FROM shared)),
dregseg AS (
  SELECT regiao, segmento, row_number() OVER (ORDER BY regiao, segmento) AS sk_regiao_segmento
  FROM (SELECT regiao, segmento FROM cust UNION SELECT regiao, segmento FROM annual)
  WHERE regiao IS NOT NULL AND segmento IS NOT NULL)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(part.strip("\n") for part in parts) + "\n"


def exact(column: str) -> str:
    """The sum without rounding an addend: whole parts and fractions apart, as the engine adds them."""
    whole = f"CAST(sum(CAST(trunc({column}) AS DECIMAL(38, 0))) AS DOUBLE)"
    return f"({whole} + CAST(sum(CAST(({column}) - trunc({column}) AS DECIMAL(38, 20))) AS DOUBLE))"
