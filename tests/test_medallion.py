"""A small set of raw files through the whole run."""

import pytest

from ledgerloom.plans import medallion

FILES = {
    "cambio_usd.csv": "data_cotacao,moeda,taxa_ptax_venda\n05/01/2024,USD,\"5,00\"\n2024-1-8,USD,\"6,00\"\n",
    "feriados.csv": "data;descricao;abrangencia\n2024-01-01;Ano novo;Nacional\n2024-07-09;Revolução;SP\n",
    "produtos.csv": "id_produto;descricao;categoria;subcategoria;linha;unidade;custo_padrao;preco_lista;flag_descontinuado\n"
                    "PrA;Bomba;;Bombas;L;UN;1,5;2,5;0\nPRB;Cabo;Eletrica;Cabos;L;UN;1;2;1\n",
    "vendedores.csv": "id_vendedor;nome;email_corporativo;cargo;regiao;id_gestor;data_admissao;data_desligamento\n"
                      "V001;Ana;ANA@X.COM;Rep;Sul;V009;07/jan/20;\nV001;Bia;bia@x.com;Rep;Sul;V009;44648;\n"
                      "V002;Caio;caio@x.com;Rep;Sul;V009;2020-01-01;01/02/2021\n",
    "carteira_historica.csv": "id_cliente;id_vendedor;vigencia_inicio;vigencia_fim\n"
                              "C1;V002;2024-01-01;9999-12-31\nC2;V001;2024-01-01;2024-12-31\n",
    "seguranca_acessos.csv": "email;nome;perfil;regiao_permitida;segmento_permitido;ativo\nA@X.com;Ana;G;Sul;Varejo;SIM\n",
    "clientes.csv": "id_cliente;razao_social;cnpj;segmento;regiao;uf;cidade;data_cadastro;id_matriz;situacao\n"
                    "C1;ALFA  LTDA;12.345.678/0001-90;Atac.;;SP;X;44648;;A\n"
                    "C2;beta me;12345678000190;gov;NE;BA;Y;2020-01-01;C1;inativo\n"
                    "C3;gama;1;Outro;Sul;RS;Z;xx;C9;ativo\n",
    "vendas_2024.csv": "ID_PEDIDO;ITEM;DT_EMISSAO;COD_CLIENTE;COD_PRODUTO;COD_VENDEDOR;QTDE;VLR_UNITARIO;DESCONTO;MOEDA;CANAL\n"
                       "A1;1;06/01/2024;C1;PRB;V002;2;R$ 1.000,00;12,50;USD;Loja\n"
                       "A2;1;06/01/2024;C2;PRB;;-3;10,00;0;BRL;São Paulo\n"
                       "A3;1;31/02/2024;C2;PRB;V001;;x;0;BRL;Loja\n",
    "vendas_2025.csv": "id_pedido,item,data_emissao,id_cliente,id_produto,id_vendedor,quantidade,valor_unitario,desconto_pct,moeda,canal,status_pedido\n"
                       "B1,1,2025-02-01,C3,PRB,V001,1,100.0,0.1,BRL,Web,Faturado\n"
                       "B1,1,2025-02-01,C3,PRB,V001,1,100.0,0.1,BRL,Web,Faturado\n"
                       "B2,1,2025-02-01,C7,ZZ,,1,100.0,0.0,BRL,Web,Cancelado\n",
    "vendas_2026.csv": "﻿id_pedido|item|data_emissao|id_cliente|id_produto|id_vendedor|quantidade|valor_unitario|desconto_pct|moeda|canal|status_pedido|id_filial|frete_rateado\n"
                       "D1|1|45000|C1|pra|V9|4|50,00|5.0|BRL|Web|Faturado|F1|1,5\n",
    "devolucoes.csv": "id_devolucao;id_pedido_origem;item;data_devolucao;quantidade_devolvida;motivo\n"
                      "R1;A1;1;10/02/2024;1;Avaria\nR2;A3;1;10/02/2024;1;Troca\nR3;PV2023;1;10/02/2024;1;Troca\n"
                      "R4;B2;1;2025-03-01;1;Avaria\n",
    "metas_premissas.txt": "Metas em BRL\n\nAno fiscal abril a março\n",
}
MONTHS = "Jan;Fev;Mar;Abr;Mai;Jun;Jul;Ago;Set;Out;Nov;Dez"
for year in (2024, 2025, 2026):
    FILES[f"metas_comerciais_{year}.csv"] = (
        f"Metas;;\n;;\nobs;;\nRegiao;Segmento;{MONTHS};Meta Ano\n"
        "SUDESTE;ATACADO;" + ";".join(["R$ 1.000,00"] * 12) + ";12500.0\n"
        "NORTE;GOVERNO;" + ";".join(["10"] * 11) + ";;120\n"
        "TOTAL GERAL;;" + ";".join(["1010"] * 11) + ";1000;12620\n")


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name, body in FILES.items():
        (folder / name).write_bytes(body.encode("ISO-8859-1" if name == "vendas_2024.csv" else "UTF-8"))
    return medallion.run(spark, str(folder), bronze="tb", silver="ts", gold="tg")


def table(layers, name, *columns, order=None):
    df = layers.spark.table(name)
    return [tuple(r) for r in df.select(*columns).orderBy(order or columns[0]).collect()]


def test_sales(layers):
    assert table(layers, "ts.vendas", "id_pedido", "safra", "status_pedido", "taxa_cambio_aplicada", "receita_bruta",
                 "receita_liquida", "id_vendedor_ambiguo", "canal") == [
        ("A1", "2024", "Faturado", 5.0, 10000.0, 8750.0, False, "Loja"),
        ("A2", "2024", "Cancelado", 1.0, 0.0, 0.0, False, "São Paulo"),
        ("B1", "2025", "Faturado", 1.0, 100.0, 90.0, True, "Web"),
        ("B2", "2025", "Cancelado", 1.0, 0.0, 0.0, False, "Web"),
        ("D1", "2026", "Faturado", 1.0, 200.0, 190.0, False, "Web")]
    assert table(layers, "ts.vendas_rejeitadas", "id_pedido", "motivo_rejeicao") == [
        ("A3", "quantidade_ausente; valor_ausente; data_invalida")]


def test_customers(layers):
    assert table(layers, "tg.dClientes", "sk_cliente", "id_cliente", "razao_social", "regiao", "segmento",
                 "cnpj_duplicado", "nome_grupo_economico", "matriz_orfa") == [
        (-1, "N/A", "Não Identificado", "Não Identificado", "Não Identificado", None, None, None),
        (1, "C1", "Alfa Ltda", "Sudeste", "Atacado", True, "Alfa Ltda", False),
        (2, "C2", "Beta ME", "Nordeste", "Governo", True, "Alfa Ltda", False),
        (3, "C3", "Gama", "Sul", None, False, "Matriz não encontrada (C9)", True)]


def test_sales_fact(layers):
    assert table(layers, "tg.fVendas", "id_pedido", "sk_cliente", "sk_produto", "sk_vendedor_pedido",
                 "sk_vendedor_responsavel", "vendedor_fonte", "id_produto_chave") == [
        ("A1", 1, 2, 3, 3, "carteira_historica", "PRB"), ("A2", 2, 2, 0, -2, "carteira_historica", "PRB"),
        ("B1", 3, 2, -2, -2, "pedido_original_sem_carteira", "PRB"), ("B2", -1, -1, 0, 0, "sem_vendedor", "ZZ"),
        ("D1", 1, 1, -1, -1, "pedido_original_sem_carteira", "PRA")]


def test_returns_fact(layers):
    assert table(layers, "tg.fDevolucoes", "id_devolucao", "sk_cliente", "pedido_origem_encontrado",
                 "receita_devolucao_liquida") == [
        ("R1", 1, True, 4375.0), ("R2", -1, False, None), ("R3", -1, False, None), ("R4", -1, True, 0.0)]
    assert table(layers, "ts.devolucoes_orfas", "id_devolucao") == [("R2",), ("R3",)]


def test_targets_fact(layers):
    fact = layers.spark.table("tg.fMetas")
    assert fact.count() == 72 and fact.filter("meta_mensal IS NULL").count() == 3
    assert fact.filter("sk_regiao_segmento IS NULL").count() == 0
    assert table(layers, "tg.dRegiaoSegmento", "sk_regiao_segmento", "regiao", "segmento") == [
        (1, "Nordeste", "Governo"), (2, "Norte", "Governo"), (3, "Sudeste", "Atacado")]


def test_quality(layers):
    assert table(layers, "ts.qualidade_volume_processado", "safra", "linhas_bronze", "linhas_validas",
                 "linhas_rejeitadas_ou_orfas", "duplicatas_removidas") == [
        ("2024", 3, 2, 1, 0), ("2025", 3, 2, 0, 1), ("2026", 1, 1, 0, 0), ("todas", 4, 2, 2, 0)]
    orphans = {(r.fato, r.coluna_fk): r.chaves_distintas_orfas
               for r in layers.spark.table("ts.qualidade_chaves_orfas").collect()}
    assert orphans == {("fVendas", "id_cliente"): 1, ("fVendas", "id_produto_chave"): 1, ("fVendas", "id_vendedor"): 1,
                       ("carteira_historica", "id_cliente"): 0, ("carteira_historica", "id_vendedor"): 0}
    assert table(layers, "ts.qualidade_chaves_ambiguas", "tabela", "quantidade") == [
        ("carteira_historica", 1), ("clientes", 2), ("vendas", 1), ("vendedores", 2)]
    assert table(layers, "ts.qualidade_metadata_atualizacao", "periodo_inicio", "periodo_fim") == [
        ("2023-03-15", "2025-02-01")]


def test_calendar_and_landing(layers):
    assert layers.spark.table("tg.dCalendario").count() == 1551
    assert layers.spark.table("tb.metas_comerciais_2024").count() == 3
    assert table(layers, "tb.metas_premissas", "texto_premissa") == [("Ano fiscal abril a março",), ("Metas em BRL",)]
    assert layers.spark.table("tb.vendas_2026").columns[0] == "id_pedido"
