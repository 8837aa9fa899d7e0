"""The test tables in the role of landed extracts.

Each function renders clean columns as the dirty text a source would deliver: mixed date shapes, amounts with
currency marks, spelling variants, blanks, broken cells, repeated rows. Whole tables are rendered. The SQL
fragments at the end state the clean values of the same rows, straight from the tables, for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.fixed_values import MONTH_NUMBERS, SUBCATEGORY_CATEGORIES

_MONTHS = ", ".join(f"'{m}'" for m in MONTH_NUMBERS)
_SUBCATEGORIES = ", ".join(f"'{s}'" for s in SUBCATEGORY_CATEGORIES)
_CATEGORIES = ", ".join(f"'{c}'" for c in SUBCATEGORY_CATEGORIES.values())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written_date(d: str, k: str) -> str:
    """SQL text that writes date ``d`` in one of five shapes, chosen by key ``k``."""
    return f"""CASE
        WHEN {k} % 5 = 4 AND year({d}) >= 2000 THEN
            concat(date_format({d}, 'dd'), '/', element_at(array({_MONTHS}), month({d})), '/', date_format({d}, 'yy'))
        WHEN {k} % 5 = 3 THEN cast(datediff({d}, date'1899-12-30') AS string)
        WHEN {k} % 5 = 2 THEN date_format({d}, 'dd-MM-yyyy')
        WHEN {k} % 5 = 1 THEN date_format({d}, 'yyyy-M-d')
        ELSE concat(' ', date_format({d}, 'd/M/yyyy'), ' ') END"""


def written_money(x: str, k: str) -> str:
    """SQL text that writes amount ``x`` as ``R$ 1.234,56``, ``1234,56`` or ``1234.56``, chosen by ``k``."""
    exact = f"cast({x} AS decimal(18, 2))"
    return f"""CASE {k} % 3
        WHEN 0 THEN concat('R$ ', translate(format_number({exact}, 2), ',.', '.,'))
        WHEN 1 THEN replace(cast({exact} AS string), '.', ',')
        ELSE cast({exact} AS string) END"""


# -- reference tables ------------------------------------------------------------------------------


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    tax_id = "lpad(cast(c_custkey - if(c_custkey % 40 = 1, 1, 0) AS string), 14, '0')"
    registered = "date_add(date'1990-01-01', cast(c_custkey % 3000 AS int))"
    return joined.selectExpr(
        "concat(' C', c_custkey, if(c_custkey % 2 = 0, ' ', '')) AS id_cliente",
        """CASE c_custkey % 4
            WHEN 0 THEN concat(upper(c_name), '  LTDA')
            WHEN 1 THEN concat(lower(c_name), ' eireli')
            WHEN 2 THEN concat(c_name, ' Me ')
            ELSE concat('  ', upper(c_name), ' s/a') END AS razao_social""",
        f"""CASE WHEN c_custkey % 61 = 7 THEN ' '
            WHEN c_custkey % 53 = 5 THEN right({tax_id}, 13)
            ELSE regexp_replace({tax_id}, '(..)(...)(...)(....)(..)', '$1.$2.$3/$4-$5') END AS cnpj""",
        """CASE WHEN c_custkey % 101 = 0 THEN 'Outros'
            WHEN c_mktsegment = 'BUILDING' THEN if(c_custkey % 2 = 0, 'Atac.', 'ATACADO')
            WHEN c_mktsegment = 'FURNITURE' THEN if(c_custkey % 2 = 0, 'Poder  Público', ' gov')
            WHEN c_mktsegment = 'HOUSEHOLD' THEN if(c_custkey % 2 = 0, 'Indústria', 'IND')
            ELSE if(c_custkey % 2 = 0, ' varejo', 'VAREJO') END AS segmento""",
        """CASE WHEN c_custkey % 45 = 7 THEN if(c_custkey % 2 = 0, cast(NULL AS string), '  ')
            ELSE element_at(if(c_custkey % 2 = 0,
                array('NORTE', 'Nord este', 'sudest', ' Sul ', 'CENTRO-OESTE'),
                array('norte', 'NE', 'SE', 'SUL', 'co')), n_regionkey + 1) END AS regiao""",
        """if(c_custkey % 90 = 52, 'XX',
            element_at(array(' am', 'BA', 'sp ', 'RS', 'go'), n_regionkey + 1)) AS uf""",
        "concat(' City ', n_name) AS cidade",
        f"{written_date(registered, 'c_custkey')} AS data_cadastro",
        """CASE WHEN c_custkey % 77 = 3 THEN concat('CX', c_custkey)
            WHEN c_custkey % 3 = 0 AND c_custkey % 50 <> 0 THEN concat('C', c_custkey - c_custkey % 50)
            WHEN c_custkey % 2 = 0 THEN '  ' END AS id_matriz""",
        "element_at(array('A', ' ativo', 'Inativo.'), cast(c_custkey % 3 AS int) + 1) AS situacao",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = "cast(cast(p_retailprice AS decimal(18, 2)) AS string)"
    return table(spark, sf_dir, "part").selectExpr(
        "concat(if(p_partkey % 2 = 0, 'P', ' p'), p_partkey) AS id_produto",
        "concat(p_name, ' ') AS descricao",
        f"""if(p_partkey % 78 = 0, if(p_partkey % 2 = 0, '  ', cast(NULL AS string)),
            element_at(array({_CATEGORIES}), p_size % 15 + 1)) AS categoria""",
        f"element_at(array({_SUBCATEGORIES}), p_size % 15 + 1) AS subcategoria",
        "p_brand AS linha",
        "'UN' AS unidade",
        f"if(p_partkey % 2 = 0, replace({price}, '.', ','), {price}) AS custo_padrao",
        f"if(p_partkey % 91 = 5, 'nan', {price}) AS preco_lista",
        "if(p_partkey % 10 = 0, '1 ', '0') AS flag_descontinuado",
    )


def salespeople(spark: SparkSession, sf_dir: str) -> DataFrame:
    hired = "date_add(date'1992-03-01', cast(s_suppkey % 900 AS int))"
    left = "date_add(date'2000-01-15', cast(s_suppkey % 300 AS int))"
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('V', s_suppkey - if(s_suppkey % 10 = 9, 1, 0), ' ') AS id_vendedor",
        "s_name AS nome",
        "concat(' ', upper(s_name), '@EXAMPLE.COM') AS email_corporativo",
        "'Vendedor' AS cargo",
        "concat('R', s_nationkey % 5) AS regiao",
        "concat('V', s_suppkey % 7) AS id_gestor",
        f"{written_date(hired, 's_suppkey')} AS data_admissao",
        f"if(s_suppkey % 7 = 0, {written_date(left, 's_suppkey')}, '') AS data_desligamento",
    )


def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three assignments per customer; the second overlaps both others, the third is often open.

    Every 11th customer's assignments ended before the first order, and one in 97 ends in the year 2999.
    """
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "explode(array(0, 1, 2)) AS i",
    ).selectExpr(
        "c_custkey", "i", "date_add(if(c_custkey % 11 = 0, date'1980-01-01', date'1995-01-01'), cast(c_custkey % 200 + i * 500 AS int)) AS s",
    ).selectExpr(
        "concat('C', c_custkey) AS id_cliente",
        "concat(' V', (c_custkey * 7 + i * 13) % 10) AS id_vendedor",
        "date_format(s, 'yyyy-MM-dd') AS vigencia_inicio",
        """if(i = 2 AND c_custkey % 3 <> 0 AND c_custkey % 11 <> 0, if(c_custkey % 97 = 1, '2999-12-31', '9999-12-31'),
            date_format(date_add(s, if(i = 2, 400, 620)), 'yyyy-MM-dd')) AS vigencia_fim""",
    )


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """National holidays on the order days that fall on the 7th, state ones on the 20th, one day listed twice."""
    days = table(spark, sf_dir, "orders").selectExpr("cast(o_orderdate AS date) AS d").filter(
        "dayofmonth(d) IN (7, 20)").distinct()
    listed = days.selectExpr("d", "explode(if(month(d) = 9, array('B', 'A'), array('A'))) AS copy")
    return listed.selectExpr(
        "date_format(d, 'yyyy-MM-dd') AS data",
        "concat('Feriado ', date_format(d, 'dd/MM'), ' ', copy) AS descricao",
        "if(dayofmonth(d) = 7, 'Nacional ', 'Estadual') AS abrangencia",
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate on each weekday that has orders, from mid-January of the first year.

    Days are an expression over the aggregate: a filter of the quotes would else be moved below it and parse every order's day.
    """
    days = table(spark, sf_dir, "orders").selectExpr("cast(o_orderdate AS date) AS d").filter(
        "d >= date'1995-01-16' AND dayofweek(d) BETWEEN 2 AND 6").groupBy("d").agg(F.count(F.lit(1)).alias("n")).selectExpr(
        "if(n >= 1, d, NULL) AS d")
    milli = days.selectExpr("d", "4500 + (datediff(d, date'1990-01-01') * 7919) % 2000 AS m")
    return milli.selectExpr(
        f"{written_date('d', 'm')} AS data_cotacao",
        "' USD' AS moeda",
        "concat(m div 1000, ',', lpad(cast(m % 1000 AS string), 3, '0')) AS taxa_ptax_venda",
    )


def access_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat(upper(s_name), '@EXAMPLE.COM ') AS email", "s_name AS nome", "'Gerente ' AS perfil",
        "concat('R', s_nationkey % 5) AS regiao_permitida", "'TODOS' AS segmento_permitido",
        "if(s_suppkey % 4 = 0, 'NAO', ' SIM') AS ativo")


# -- transactions ----------------------------------------------------------------------------------

_ORDER_ID = "concat('PV', l_orderkey, '-', l_partkey, '-', l_suppkey)"
_CANCELLED = "(l_linestatus = 'F' AND (l_orderkey + l_linenumber) % 10 = 0)"
_QUANTITY = "cast(l_quantity AS int)"


def _sale_lines(spark: SparkSession, sf_dir: str, layout: int) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_orderkey") % 3 == layout)
    return lines.join(table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))


def _sale_fields(layout: int) -> dict[str, str]:
    signed = f"if({_CANCELLED}, -{_QUANTITY}, {_QUANTITY})" if layout == 0 else _QUANTITY
    points = "concat(cast(round(l_discount * 100) AS int), ',00')"
    return {
        "id_pedido": f"concat({_ORDER_ID}, ' ')",
        "item": "concat(' ', l_linenumber)",
        "data_emissao": "if((l_orderkey + l_partkey) % 83 = 0, '31/02/2024', "
                        + written_date("cast(o_orderdate AS date)", "l_orderkey") + ")",
        "id_cliente": "concat(if(o_custkey % 50 = 49, 'X', 'C'), o_custkey)",
        "id_produto": "concat(if(l_partkey % 70 = 69, 'Z', 'P'), l_partkey)",
        "id_vendedor": "if((l_orderkey + l_linenumber) % 13 = 0, ' ', concat('V', l_suppkey))",
        "quantidade": f"if((l_orderkey + l_partkey) % 97 = 0, '', cast({signed} AS string))",
        "valor_unitario": "if((l_orderkey + l_partkey) % 89 = 0, 'n/d', "
                          + written_money("l_extendedprice", "l_linenumber") + ")",
        "desconto": "cast(l_discount AS string)" if layout == 1 else points,
        "moeda": "if((l_orderkey + l_partkey) % 211 = 0, cast(NULL AS string), if(o_custkey % 10 = 0, 'USD', 'BRL'))",
        "canal": "concat('Canal ', l_linenumber % 3)",
        "status_pedido": f"""if((l_orderkey + l_linenumber) % 59 = 1, cast(NULL AS string),
            if({_CANCELLED}, 'Cancelado', 'Faturado '))""",
        "id_filial": "concat('F', l_suppkey % 5)",
        "frete_rateado": "replace(cast(l_tax AS string), '.', ',')",
    }


# Column names of each yearly layout, by common field.
_LAYOUT_NAMES = (
    {"id_pedido": "ID_PEDIDO", "item": "ITEM", "data_emissao": "DT_EMISSAO", "id_cliente": "COD_CLIENTE",
     "id_produto": "COD_PRODUTO", "id_vendedor": "COD_VENDEDOR", "quantidade": "QTDE",
     "valor_unitario": "VLR_UNITARIO", "desconto": "DESCONTO", "moeda": "MOEDA", "canal": "CANAL"},
    {n: n for n in ("id_pedido", "item", "data_emissao", "id_cliente", "id_produto", "id_vendedor", "quantidade",
                    "valor_unitario", "moeda", "canal", "status_pedido")} | {"desconto": "desconto_pct"},
    {n: n for n in ("id_pedido", "item", "data_emissao", "id_cliente", "id_produto", "id_vendedor", "quantidade",
                    "valor_unitario", "moeda", "canal", "status_pedido", "id_filial", "frete_rateado")}
    | {"desconto": "desconto_pct"},
)


def sales_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three yearly layouts; the second one holds exact copies of some rows."""
    tables = []
    for layout, names in enumerate(_LAYOUT_NAMES):
        fields = _sale_fields(layout)
        if layout == 2:
            fields["id_produto"] = f"lower({fields['id_produto']})"
        lines = _sale_lines(spark, sf_dir, layout)
        if layout == 1:
            lines = lines.withColumn("_copy", F.expr(
                "explode(if((l_orderkey + l_partkey) % 29 = 0, array(1, 2), array(1)))"))
        tables.append(lines.selectExpr(*[f"{fields[field]} AS {name}" for field, name in names.items()]))
    return tables


def returned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = "date_add(cast(l_shipdate AS date), 30)"
    return table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").selectExpr(
        f"concat('D', substr({_ORDER_ID}, 3), '-', l_linenumber) AS id_devolucao",
        f"if((l_orderkey + l_linenumber) % 37 = 0, concat('PV2023', l_orderkey), {_ORDER_ID}) AS id_pedido_origem",
        "cast(l_linenumber AS string) AS item",
        f"{written_date(day, 'l_orderkey')} AS data_devolucao",
        f"cast({_QUANTITY} + if((l_orderkey + l_linenumber) % 41 = 0, 1, 0) AS string) AS quantidade_devolvida",
        "concat(' Motivo ', l_linenumber % 4) AS motivo",
    )


_TARGET_REGIONS = "element_at(array('NORTE', 'NORDESTE', 'SUDESTE', 'SUL', 'CENTRO-OESTE'), n_regionkey + 1)"
_TARGET_SEGMENTS = """CASE c_mktsegment WHEN 'BUILDING' THEN 'ATACADO' WHEN 'FURNITURE' THEN 'GOVERNO'
    WHEN 'HOUSEHOLD' THEN 'INDÚSTRIA' ELSE 'VAREJO' END"""


def target_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All yearly grids: a column per month, totals row, a blank row and a note row per year.

    Governo has no target in the last month of each quarter in Norte and Centro-Oeste.
    """
    ordered = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    )
    cells = ordered.selectExpr(
        "year(o_orderdate) AS ano", f"{_TARGET_REGIONS} AS Regiao", f"{_TARGET_SEGMENTS} AS Segmento",
        "month(o_orderdate) AS m", "cast(o_totalprice AS decimal(18, 2)) AS v",
    ).groupBy("ano", "Regiao", "Segmento", "m").agg(F.expr("cast(sum(v) AS decimal(18, 2))").alias("v"))
    undefined = "(Segmento = 'GOVERNO' AND Regiao IN ('NORTE', 'CENTRO-OESTE') AND m % 3 = 0)"
    shown = cells.withColumn("w", F.expr(f"if({undefined}, cast(NULL AS decimal(18, 2)), v)"))

    def grid(keys: list[str], annual: str) -> DataFrame:
        months = [F.expr(f"cast(sum(w) FILTER (WHERE m = {n}) AS decimal(18, 2))").alias(name.capitalize())
                  for name, n in MONTH_NUMBERS.items()]
        return shown.groupBy(*keys).agg(*months, F.expr(f"cast({annual} AS decimal(18, 2))").alias("Meta_Ano"))

    def written(df: DataFrame) -> DataFrame:
        amounts = [f"{written_money(n.capitalize(), f'(ano + {i})')} AS {n.capitalize()}"
                   for i, n in enumerate(MONTH_NUMBERS)]
        return df.selectExpr("ano", "Regiao", "Segmento", *amounts, f"{written_money('Meta_Ano', 'ano')} AS Meta_Ano")

    detail = written(grid(["ano", "Regiao", "Segmento"], "sum(v) + if(Segmento = 'VAREJO', 1000, 0)"))
    totals = written(grid(["ano"], "sum(v)").selectExpr(
        "*", "' Total Geral' AS Regiao", "cast(NULL AS string) AS Segmento"))
    extra = totals.selectExpr(
        "ano", "explode(array(cast(NULL AS string), 'Obs: metas dependem de contratos')) AS Regiao",
        "cast(NULL AS string) AS Segmento",
        *[f"cast(NULL AS string) AS {n.capitalize()}" for n in MONTH_NUMBERS], "cast(NULL AS string) AS Meta_Ano")
    return detail.unionByName(totals).unionByName(extra)
