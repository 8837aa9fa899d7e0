"""The distributor's tables: source specs, layouts, and the silver and gold table of each subject.

Every function takes DataFrames and returns a DataFrame; ``plans.medallion`` reads and writes the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions import money, parsing, text
from ledgerloom.operators import asof, keys, marts, membership, quality, returns, sums, targets
from ledgerloom.operators.layouts import Field, Layout, harmonize
from ledgerloom.sources.landing import DelimitedSource, GridSource, TextSource
from ledgerloom.sources.staging import staged_counted

BASE_CURRENCY = "BRL"
CURRENCIES = ("BRL", "USD")
SALE_GRAIN = ["safra", "id_pedido", "item"]


# Delimiter and charset of each yearly sales extract.
SALES_FILES = {"2024": (";", "ISO-8859-1"), "2025": (",", "UTF-8"), "2026": ("|", "UTF-8")}
TARGET_YEARS = (2024, 2025, 2026)


def source_specs(
    folder: str, multi_line: bool = True, sales_files: Mapping[str, tuple[str, str]] = SALES_FILES,
    target_years: Sequence[int] = TARGET_YEARS,
) -> list:
    """The landed extracts. Pass ``multi_line=False`` for large extracts without line breaks in fields.

    ``sales_files`` maps each sales layout to the delimiter and charset of its extract.
    """
    def delimited(table: str, delimiter: str, encoding: str = "UTF-8") -> DelimitedSource:
        return DelimitedSource(table, f"{folder}/{table}.csv", delimiter, encoding, multi_line)

    # Table, delimiter and charset of each extract.
    files = [
        delimited("cambio_usd", ","),
        delimited("carteira_historica", ";"),
        delimited("clientes", ";"),
        delimited("devolucoes", ";"),
        delimited("feriados", ";"),
        delimited("produtos", ";"),
        delimited("seguranca_acessos", ";"),
        *[delimited(f"vendas_{name}", *shape) for name, shape in sales_files.items()],
        delimited("vendedores", ";"),
    ]
    sheets = [
        GridSource(f"metas_comerciais_{year}", f"{folder}/metas_comerciais_{year}.csv", sheet=f"Metas {year}",
                   source_name="metas_comerciais.xlsx")
        for year in target_years
    ]
    notes = TextSource("metas_premissas", f"{folder}/metas_premissas.txt", source_name="metas_comerciais.xlsx")
    return [*files, *sheets, notes]


# How each yearly sales layout names and scales the common fields.
SALES_2024 = Layout("2024", {
    "id_pedido": Field("text", "ID_PEDIDO"),
    "item": Field("int", "ITEM"),
    "data_emissao": Field("date", "DT_EMISSAO"),
    "id_cliente": Field("text", "COD_CLIENTE"),
    "id_produto": Field("text", "COD_PRODUTO"),
    "id_vendedor": Field("optional_text", "COD_VENDEDOR"),
    "quantidade": Field("int", "QTDE"),
    "valor_unitario": Field("money", "VLR_UNITARIO"),
    "desconto_fracao": Field("percent", "DESCONTO"),
    "moeda": Field("text", "MOEDA"),
    "canal": Field("text", "CANAL"),
    "status_pedido_origem": Field("text"),
    "id_filial": Field("text"),
    "frete_rateado": Field("money"),
})
SALES_2025 = Layout("2025", {
    "id_pedido": Field("text", "id_pedido"),
    "item": Field("int", "item"),
    "data_emissao": Field("date", "data_emissao"),
    "id_cliente": Field("text", "id_cliente"),
    "id_produto": Field("text", "id_produto"),
    "id_vendedor": Field("optional_text", "id_vendedor"),
    "quantidade": Field("int", "quantidade"),
    "valor_unitario": Field("money", "valor_unitario"),
    "desconto_fracao": Field("fraction", "desconto_pct"),
    "moeda": Field("text", "moeda"),
    "canal": Field("text", "canal"),
    "status_pedido_origem": Field("text", "status_pedido"),
    "id_filial": Field("text"),
    "frete_rateado": Field("money"),
})
SALES_2026 = Layout("2026", {
    "id_pedido": Field("text", "id_pedido"),
    "item": Field("int", "item"),
    "data_emissao": Field("date", "data_emissao"),
    "id_cliente": Field("text", "id_cliente"),
    "id_produto": Field("code", "id_produto"),
    "id_vendedor": Field("optional_text", "id_vendedor"),
    "quantidade": Field("int", "quantidade"),
    "valor_unitario": Field("money", "valor_unitario"),
    "desconto_fracao": Field("percent", "desconto_pct"),
    "moeda": Field("text", "moeda"),
    "canal": Field("text", "canal"),
    "status_pedido_origem": Field("text", "status_pedido"),
    "id_filial": Field("text", "id_filial"),
    "frete_rateado": Field("money", "frete_rateado"),
})
SALES_LAYOUTS = [SALES_2024, SALES_2025, SALES_2026]
SIGN_STATUS_LAYOUTS = ["2024"]


def _trimmed(*names: str) -> list[Column]:
    return [F.trim(name).alias(name) for name in names]


# -- silver: reference tables ----------------------------------------------------------------------


def holidays(raw: DataFrame) -> DataFrame:
    return raw.select(parsing.iso_date(F.col("data")).alias("data"), *_trimmed("descricao", "abrangencia"))


def quotes(raw: DataFrame) -> DataFrame:
    return raw.select(
        parsing.flexible_date(F.col("data_cotacao")).alias("data_cotacao"),
        *_trimmed("moeda"),
        parsing.decimal_comma(F.col("taxa_ptax_venda")).alias("taxa_ptax_venda"),
    )


def products(raw: DataFrame) -> DataFrame:
    """Category from the file, else the one its subcategory implies."""
    typed = raw.select(
        *_trimmed("id_produto"),
        text.code_key(F.col("id_produto")).alias("id_produto_chave"),
        *_trimmed("descricao"),
        text.blank_to_null(F.col("categoria")).alias("categoria_original"),
        *_trimmed("subcategoria", "linha", "unidade"),
        parsing.decimal_comma(F.col("custo_padrao")).alias("custo_padrao"),
        parsing.decimal_comma(F.col("preco_lista")).alias("preco_lista"),
        (F.trim("flag_descontinuado") == "1").alias("descontinuado"),
    )
    implied = text.map_value(F.col("subcategoria"), fv.SUBCATEGORY_CATEGORIES)
    return quality.infer_missing(
        typed, "categoria", F.col("categoria_original"), implied, "categoria_inferida_por_subcategoria")


def salespeople(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        *_trimmed("id_vendedor", "nome"),
        F.lower(F.trim("email_corporativo")).alias("email_corporativo"),
        *_trimmed("cargo", "regiao", "id_gestor"),
        parsing.flexible_date(F.col("data_admissao")).alias("data_admissao"),
        parsing.flexible_date(F.col("data_desligamento")).alias("data_desligamento"),
    ).withColumn("vendedor_ativo", F.col("data_desligamento").isNull())
    return quality.flag_duplicates(typed, "id_vendedor", "id_vendedor_duplicado")


def portfolio(raw: DataFrame, people: DataFrame) -> DataFrame:
    """Customer to salesperson assignments over validity intervals."""
    typed = raw.select(
        *_trimmed("id_cliente", "id_vendedor"),
        parsing.iso_date(F.col("vigencia_inicio")).alias("vigencia_inicio"),
        parsing.iso_date(F.col("vigencia_fim")).alias("vigencia_fim"),
    ).withColumn("vigencia_aberta", F.col("vigencia_fim") == F.lit(fv.OPEN_END).cast("date"))
    return quality.flag_ambiguous(
        typed, "id_vendedor", people, "id_vendedor", "id_vendedor_duplicado", "id_vendedor_ambiguo")


def access_rules(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.lower(F.trim("email")).alias("email"),
        *_trimmed("nome", "perfil", "regiao_permitida", "segmento_permitido"),
        (F.trim("ativo") == "SIM").alias("ativo"),
    )


def customers(raw: DataFrame) -> DataFrame:
    """Treated columns next to the originals; region inferred from the state; shared tax ids flagged."""
    typed = raw.select(
        *_trimmed("id_cliente"),
        F.trim("razao_social").alias("razao_social_original"),
        text.title_name(F.col("razao_social")).alias("razao_social"),
        *_trimmed("cnpj"),
        text.digits(F.col("cnpj")).alias("cnpj_limpo"),
        F.col("segmento").alias("segmento_original"),
        text.canonical(F.col("segmento"), fv.SEGMENT_VARIANTS).alias("segmento"),
        F.col("regiao").alias("regiao_original"),
        F.upper(F.trim("uf")).alias("uf"),
        *_trimmed("cidade"),
        F.col("data_cadastro").alias("data_cadastro_original"),
        parsing.flexible_date(F.col("data_cadastro")).alias("data_cadastro"),
        text.blank_to_null(F.col("id_matriz")).alias("id_matriz"),
        F.col("situacao").alias("situacao_original"),
        text.canonical(F.col("situacao"), fv.STATUS_VARIANTS).alias("situacao"),
    )
    mapped = text.canonical(F.col("regiao_original"), fv.REGION_VARIANTS)
    by_state = text.map_value(F.col("uf"), fv.STATE_REGIONS)
    regional = quality.infer_missing(typed, "regiao", mapped, by_state, "regiao_inferida_por_uf")
    checked = regional.withColumn("cnpj_valido", F.length("cnpj_limpo") == 14)
    return quality.flag_duplicates(checked, "cnpj_limpo", "cnpj_duplicado")


# -- silver: sales, returns, targets ---------------------------------------------------------------


def landed_sales(
    tables: Sequence[DataFrame], layouts: Sequence[Layout] = tuple(SALES_LAYOUTS), keep: Sequence[str] = ()
) -> DataFrame:
    return harmonize(list(zip(layouts, tables, strict=True)), keep)


def sale_rules() -> dict[str, Column]:
    known = F.upper(F.trim("moeda")).isin(*CURRENCIES)
    return {
        fv.MISSING_QUANTITY: F.col("quantidade").isNull(),
        fv.MISSING_PRICE: F.col("valor_unitario").isNull(),
        fv.INVALID_DATE: F.col("data_emissao").isNull(),
        fv.INVALID_CURRENCY: ~F.coalesce(known, F.lit(False)),
    }


def tagged_sales(landed: DataFrame) -> DataFrame:
    """Exact duplicates removed before any arithmetic, then every row tagged with its reject reasons."""
    return quality.tag_rejects(quality.drop_exact_duplicates(landed), sale_rules())


def rated_sales(valid: DataFrame, fx: DataFrame) -> DataFrame:
    return asof.convert_currency(
        valid, fx, day="data_emissao", currency="moeda", base=BASE_CURRENCY, quote_day="data_cotacao",
        quote_currency="moeda", quote_rate="taxa_ptax_venda", out="taxa_cambio_aplicada")


def priced_sales(rated: DataFrame) -> DataFrame:
    """Unified status, absolute quantity, gross and net revenue, product join key."""
    by_sign = F.col("safra").isin(*SIGN_STATUS_LAYOUTS)
    unified = rated.withColumns({
        "status_pedido": money.unified_status(by_sign, F.col("quantidade"), F.col("status_pedido_origem")),
        "quantidade_absoluta": F.abs("quantidade"),
    }).drop("status_pedido_origem")
    gross = money.gross_revenue(
        F.col("quantidade_absoluta"), F.col("valor_unitario"), F.col("taxa_cambio_aplicada"),
        money.is_cancelled(F.col("status_pedido")))
    return unified.withColumn("receita_bruta", gross).withColumns({
        "receita_liquida": money.net_of_discount(F.col("receita_bruta"), F.col("desconto_fracao")),
        "id_produto_chave": text.code_key(F.col("id_produto")),
    })


def sales(valid: DataFrame, fx: DataFrame, people: DataFrame) -> DataFrame:
    return flagged_sales(priced_sales(rated_sales(valid, fx)), people)


def flagged_sales(rows: DataFrame, people: DataFrame) -> DataFrame:
    """Sales, priced or not yet, with the flag of a salesperson code that several people share."""
    return quality.flag_ambiguous(rows, "id_vendedor", people, "id_vendedor", "id_vendedor_duplicado", "id_vendedor_ambiguo")


def used_codes(landed: DataFrame) -> DataFrame:
    """Customer, product and salesperson codes of the landed sales, null on rejected ones, for checks of distinct keys.

    Copies stay, as they add no key, so nothing is shuffled. Codes are made null instead of filtered: a filter on what was
    read would be moved below the reading, which would then be done twice. The layout's name is asked for, as it is what
    keeps the projections of a layout apart, and so the code of each small enough to be compiled.
    """
    tagged = quality.tag_rejects(landed, sale_rules())
    valid = F.col("safra").isNotNull() & (F.col("motivo_rejeicao") == "")
    codes = {"id_cliente": F.col("id_cliente"), "id_produto_chave": text.code_key(F.col("id_produto")), "id_vendedor": F.col("id_vendedor")}
    return tagged.select(*[F.when(valid, code).alias(name) for name, code in codes.items()])


def sales_of_shared_codes(landed: DataFrame, people: DataFrame) -> DataFrame:
    """Valid sales with their flag ``id_vendedor_ambiguo``, without most of those whose code is nobody's or one person's.

    Exact copies share their code, so the filter comes before the removal of copies. All flagged sales are there.
    """
    shared, n = staged_counted(people.filter("id_vendedor_duplicado").select("id_vendedor").distinct(), "shared-codes")
    possible = landed.filter(membership.possibly_among({"id_vendedor": "id_vendedor"}, shared, n["rows"]))
    return flagged_sales(quality.split_tagged(tagged_sales(possible))[0], people)


# The columns of a landed return.
RETURN_COLUMNS = ["id_devolucao", "id_pedido_origem", "item", "data_devolucao", "quantidade_devolvida", "motivo"]
RETURN_TO_SALE = {"id_pedido_origem": "id_pedido", "item": "item"}
SALE_TERMS = {
    "safra": "safra_origem",
    "valor_unitario": "valor_unitario_origem",
    "desconto_fracao": "desconto_fracao_origem",
    "moeda": "moeda_origem",
    "taxa_cambio_aplicada": "taxa_cambio_origem",
    "status_pedido": "status_pedido_origem",
    "quantidade_absoluta": "quantidade_faturada_origem",
    # codes that the returns fact resolves
    "id_cliente": "id_cliente_origem",
    "id_produto_chave": "id_produto_chave_origem",
}


def typed_returns(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_trimmed("id_devolucao", "id_pedido_origem"),
        parsing.whole_number(F.col("item")).alias("item"),
        parsing.flexible_date(F.col("data_devolucao")).alias("data_devolucao"),
        parsing.whole_number(F.col("quantidade_devolvida")).alias("quantidade_devolvida"),
        *_trimmed("motivo"),
    )


def valued_returns(raw: DataFrame, sold: DataFrame) -> DataFrame:
    """Returns are parsed and written once: the filter of their keys, the keys themselves and the result read that."""
    typed, n = staged_counted(typed_returns(raw), "typed-returns")
    return _valued(typed, sold, n["rows"])


def valued_returns_of_landed(raw: DataFrame, landed: DataFrame, fx: DataFrame) -> DataFrame:
    """Returns at the terms of landed sales, of which those that no return names are left out before anything else.

    Exact copies share their key and every other step of the sales looks at one row, so the filter may come first: the
    sales that are read, made unique, tagged, rated and priced are those of the returns, not all.
    """
    typed, n = staged_counted(typed_returns(raw), "typed-returns")
    named = _possibly_named(landed, typed, n["rows"])
    return _valued(typed, priced_sales(rated_sales(quality.split_tagged(tagged_sales(named))[0], fx)), None)


def _possibly_named(landed: DataFrame, returned: DataFrame, n_returned: int) -> DataFrame:
    return landed.filter(membership.possibly_among({s: r for r, s in RETURN_TO_SALE.items()}, returned, n_returned))


def _valued(typed: DataFrame, sold: DataFrame, n_returns: int | None) -> DataFrame:
    return returns.value_returns(
        typed, sold, n_returns=n_returns, on=RETURN_TO_SALE, terms=SALE_TERMS, quantity="quantidade_devolvida",
        layout="safra_origem", price="valor_unitario_origem", discount="desconto_fracao_origem",
        rate="taxa_cambio_origem", status="status_pedido_origem", billed="quantidade_faturada_origem")


def orphan_returns(valued: DataFrame) -> DataFrame:
    return returns.orphan_returns(valued, RETURN_COLUMNS)


def explained_orphans(orphans: DataFrame, landed: DataFrame) -> DataFrame:
    """The orphans are written once; of the landed sales only those that an orphan names are grouped."""
    kept, n = staged_counted(orphans, "orphans")
    return returns.explain_orphans(
        kept, _possibly_named(landed, kept, n["rows"]), RETURN_TO_SALE, "existe_no_bruto_mas_foi_excluida")


def target_grid(sheets: dict[int, DataFrame]) -> DataFrame:
    """The yearly sheets as one typed grid, totals, blank and note rows still inside."""
    grid = None
    for year, sheet in sheets.items():
        typed = targets.typed_grid(sheet, year)
        grid = typed if grid is None else grid.unionByName(typed)
    return grid


# -- gold ------------------------------------------------------------------------------------------


# The columns that members are numbered by.
CUSTOMER_ORDER = ["id_cliente", "cnpj", "razao_social_original"]
PRODUCT_ORDER = ["id_produto_chave", "id_produto", "descricao"]


def customer_keys(raw: DataFrame) -> DataFrame:
    """Surrogate keys of the customers as the dimension numbers them, without its treated columns and special members.

    For facts that are built without the dimension: names, segments, regions and groups need not be treated.
    """
    named = raw.select(*_trimmed("id_cliente", "cnpj"), F.trim("razao_social").alias("razao_social_original"))
    return keys.with_surrogate_key(named, CUSTOMER_ORDER, "sk_cliente")


def product_keys(raw: DataFrame) -> DataFrame:
    """As ``customer_keys``, of the products."""
    named = raw.select(text.code_key(F.col("id_produto")).alias("id_produto_chave"), *_trimmed("id_produto", "descricao"))
    return keys.with_surrogate_key(named, PRODUCT_ORDER, "sk_produto")


def customer_dimension(base: DataFrame) -> DataFrame:
    grouped = keys.flatten_hierarchy(
        base, member="id_cliente", parent="id_matriz", name="razao_social", group="id_grupo_economico",
        group_name="nome_grupo_economico", is_head="eh_matriz", orphan="matriz_orfa",
        orphan_label=fv.ORPHAN_PARENT_LABEL)
    numbered = keys.with_surrogate_key(grouped, CUSTOMER_ORDER, "sk_cliente")
    return keys.with_sentinels(numbered, fv.CUSTOMER_SENTINELS)


def product_dimension(base: DataFrame) -> DataFrame:
    numbered = keys.with_surrogate_key(base, PRODUCT_ORDER, "sk_produto")
    return keys.with_sentinels(numbered, fv.PRODUCT_SENTINELS)


def salesperson_dimension(base: DataFrame) -> DataFrame:
    numbered = keys.with_surrogate_key(base, ["id_vendedor", "email_corporativo", "nome"], "sk_vendedor")
    return keys.with_sentinels(numbered, fv.SALESPERSON_SENTINELS)


def region_segment_dimension(base_customers: DataFrame, annual: DataFrame) -> DataFrame:
    return keys.conformed_dimension([base_customers, annual], ["regiao", "segmento"], "sk_regiao_segmento")


def attributed_sales(
    sold: DataFrame, assigned: DataFrame, months: Sequence[date] | None = None, beside: DataFrame | None = None
) -> DataFrame:
    """Responsible salesperson: the portfolio on the issue date, else the code on the order, else nobody.

    ``months`` are those of the issue dates, if they are known from the write of the sales. ``beside`` is a lookup by customer
    code whose columns come along (``asof.asof_interval``).
    """
    held = asof.asof_interval(
        sold, assigned, key="id_cliente", day="data_emissao", interval_key="id_cliente", start="vigencia_inicio",
        stop="vigencia_fim", is_open="vigencia_aberta",
        values={"id_vendedor": "vendedor_via_carteira", "id_vendedor_ambiguo": "vendedor_via_carteira_ambiguo"},
        months=months, beside=beside)
    by_portfolio = F.col("vendedor_via_carteira").isNotNull()
    return held.withColumns({
        "id_vendedor_atribuicao": F.coalesce("vendedor_via_carteira", "id_vendedor"),
        "vendedor_ambiguo_atribuicao": F.when(by_portfolio, F.col("vendedor_via_carteira_ambiguo")).otherwise(
            F.col("id_vendedor_ambiguo")),
        "vendedor_fonte": F.when(by_portfolio, F.lit(fv.FROM_PORTFOLIO))
        .when(F.col("id_vendedor").isNotNull(), F.lit(fv.FROM_ORDER))
        .otherwise(F.lit(fv.FROM_NOBODY)),
    }).drop("vendedor_via_carteira", "vendedor_via_carteira_ambiguo")


# The columns of the sales fact.
SALES_FACT = [
    "safra", "id_pedido", "item", "data_emissao", "sk_cliente", "sk_produto", "sk_vendedor_pedido",
    "sk_vendedor_responsavel", "vendedor_fonte", "id_cliente", "id_produto", "id_produto_chave", "id_vendedor",
    "id_vendedor_atribuicao", "canal", "moeda", "id_filial", "quantidade_absoluta", "valor_unitario",
    "desconto_fracao", "taxa_cambio_aplicada", "receita_bruta", "receita_liquida", "status_pedido", "frete_rateado",
]


def with_product_key(sold: DataFrame, d_products: DataFrame) -> DataFrame:
    return keys.resolve_key(
        sold, d_products, code="id_produto_chave", dim_code="id_produto_chave", dim_sk="sk_produto", out="sk_produto")


def with_party_keys(
    sold: DataFrame, assigned: DataFrame, d_customers: DataFrame, d_people: DataFrame, months: Sequence[date] | None = None
) -> DataFrame:
    """Responsible salesperson, and the keys of customer and salespeople: the sales are shuffled by the customer once for both."""
    person = {"dim_code": "id_vendedor", "dim_sk": "sk_vendedor", "missing": 0}
    buyers = keys.unique_lookup(d_customers, "id_cliente", "sk_cliente")
    fact = keys.resolve_key(attributed_sales(sold, assigned, months, buyers), None, code="id_cliente", out="sk_cliente")
    fact = keys.resolve_key(
        fact, d_people, code="id_vendedor", ambiguous="id_vendedor_ambiguo", out="sk_vendedor_pedido", **person)
    return keys.resolve_key(
        fact, d_people, code="id_vendedor_atribuicao", ambiguous="vendedor_ambiguo_atribuicao",
        out="sk_vendedor_responsavel", **person)


def sales_fact(
    sold: DataFrame, assigned: DataFrame, d_customers: DataFrame, d_products: DataFrame, d_people: DataFrame,
    months: Sequence[date] | None = None,
) -> DataFrame:
    """The product first: what the other lookups add is then in no shuffle of the whole sales."""
    return with_party_keys(with_product_key(sold, d_products), assigned, d_customers, d_people, months).select(*SALES_FACT)


def sales_fact_of_valid(
    valid: DataFrame, fx: DataFrame, assigned: DataFrame, d_customers: DataFrame, d_products: DataFrame, d_people: DataFrame,
    months: Sequence[date] | None = None,
) -> DataFrame:
    """``sales_fact`` of valid sales that have their flag (``flagged_sales``) and are rated and priced last.

    Rates and prices look at one row, so they may follow the lookups; neither the table that is written before these nor
    their shuffles hold amounts that follow from the other columns.
    """
    coded = valid.withColumn("id_produto_chave", text.code_key(F.col("id_produto")))
    keyed = with_party_keys(with_product_key(coded, d_products), assigned, d_customers, d_people, months)
    return priced_sales(rated_sales(keyed, fx)).select(*SALES_FACT)


# The columns of the returns fact.
RETURNS_FACT = [
    "id_devolucao", "id_pedido_origem", "item", "safra_origem", "data_devolucao", "sk_cliente", "sk_produto",
    "quantidade_devolvida", "valor_unitario_origem", "desconto_fracao_origem", "moeda_origem", "taxa_cambio_origem",
    "receita_devolucao_bruta", "receita_devolucao_liquida", "motivo", "pedido_origem_encontrado",
    "devolucao_de_pedido_cancelado", "quantidade_excede_faturado", "status_pedido_origem",
]


def returns_fact(valued: DataFrame, d_customers: DataFrame, d_products: DataFrame) -> DataFrame:
    """Customer and product keys of the sale the return refers to, -1 when there is none.

    The codes came with the sale's terms, so keys are looked up for the few returns and the sales are not read again.
    """
    fact = keys.resolve_key(
        valued, d_customers, code="id_cliente_origem", dim_code="id_cliente", dim_sk="sk_cliente", out="sk_cliente")
    fact = keys.resolve_key(
        fact, d_products, code="id_produto_chave_origem", dim_code="id_produto_chave", dim_sk="sk_produto", out="sk_produto")
    return fact.select(*RETURNS_FACT)


# The columns of the targets fact.
TARGETS_FACT = ["sk_regiao_segmento", "regiao", "segmento", "ano", "mes", "data_referencia", "meta_mensal",
                "meta_ano_referencia"]


def targets_fact(monthly: DataFrame, annual: DataFrame, d_region_segment: DataFrame) -> DataFrame:
    """Monthly targets with the member key (NULL on a miss) and the annual target repeated on each month.

    ``meta_ano_referencia`` repeats twelve times: sum it over distinct year, region and segment only.
    """
    member = ["regiao", "segmento"]
    lookup = d_region_segment.select(*member, "sk_regiao_segmento")
    yearly = annual.select("ano", *member, F.col("meta_ano").alias("meta_ano_referencia"))
    return monthly.join(lookup, member, "left").join(yearly, ["ano", *member], "left").select(*TARGETS_FACT)


# -- marts -----------------------------------------------------------------------------------------


def realized_by_member(
    f_sales: DataFrame, f_returns: DataFrame, d_customers: DataFrame, periods: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    """Net revenue (sales by issue date less returns by return date) per region, segment and period.

    ``periods`` names the columns of a period and makes each from the day. Amounts are summed per customer key and
    period before the member lookup, so that the join sees few rows; the sums stay exact until the last step.
    """
    member = d_customers.select("sk_cliente", "regiao", "segmento")
    signed = marts.signed_revenue(
        f_sales, f_returns, sale_day="data_emissao", sale_value="receita_liquida", return_day="data_devolucao",
        return_value="receita_devolucao_liquida", keep=["sk_cliente"])
    period = [of(F.col("data")).alias(name) for name, of in periods.items()]
    out, by = "receita_liquida_realizada", ["regiao", "segmento", *periods]
    per_key = sums.partial_sums(signed, ["sk_cliente", *period], {out: F.col("valor")})
    return sums.totals(sums.merged(per_key.join(member, "sk_cliente", "left"), by), by, [out])


def target_attainment(f_targets: DataFrame, realized: DataFrame) -> DataFrame:
    return marts.attainment(
        realized, f_targets, ["regiao", "segmento", "data_referencia"], "receita_liquida_realizada", "meta_mensal",
        "atingimento")
