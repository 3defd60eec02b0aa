"""Reports on hand-made facts."""

from helpers import dec, plan, published, rows, sales, values
from pyspark.sql import Window, functions as F

from salesmill.plans import headlines as h, kpis as k
from salesmill.plans.calendar import build_dim_tempo


def products(spark, *names, category="C"):
    return {"dim_produto": published(spark, "dim_produto", [
        {"sk_produto": i + 1, "nk_produto": i + 1, "nome_produto": n, "categoria_produto": category, "subcategoria_produto": f"S-{n}"}
        for i, n in enumerate(names)])}


def curve(spark, revenues, report=k.kpi5_abc_all, **options):
    dims = products(spark, *[f"p{i}" for i in range(len(revenues))])
    fact = sales(spark, [{"sk_produto": i + 1, "valor_liquido": dec(r)} for i, r in enumerate(revenues)])
    return {r["nome_produto"]: (r["percentual_acumulado"], r["classificacao_abc"][0]) for r in rows(report(fact, dims, **options))}


PEERS = {"p0": (dec("50.00"), "A"), "p1": (dec("90.00"), "B"), "p2": (dec("90.00"), "B"), "p3": (dec("100.00"), "C")}


def test_abc_with_peers(spark):
    assert curve(spark, [50, 20, 20, 10]) == PEERS
    assert curve(spark, [50, 20, 20, 10], ranges=3) == PEERS
    assert curve(spark, [50, 20, 20, 10], k.kpi5_abc_top30) == PEERS


def test_abc_single_product_is_c(spark):
    assert curve(spark, [100]) == {"p0": (dec("100.00"), "C")}


def test_abc_without_revenue(spark):
    assert curve(spark, [0, 0]) == {"p0": (None, "C"), "p1": (None, "C")}


def test_abc_top_counts_peers_beyond_the_limit(spark):
    """40 products of equal revenue: each of the 30 shown has the total of all 40 at or above it."""
    got = curve(spark, [1] * 40, k.kpi5_abc_top30)
    assert len(got) == 30 and set(got.values()) == {(dec("100.00"), "C")}


def test_margin_by_product(spark):
    dims = products(spark, "a", "a", "b", "c")
    dims["dim_produto"] = dims["dim_produto"].withColumn("subcategoria_produto", F.lit("S"))
    fact = sales(spark, [
        {"sk_produto": 1, "numero_pedido": 1, "valor_liquido": dec(600), "lucro_bruto": dec(60), "margem_contribuicao": dec("33.33"), "quantidade_vendida": 2},
        {"sk_produto": 2, "numero_pedido": 1, "numero_linha": 2, "valor_liquido": dec(500), "lucro_bruto": dec(50), "margem_contribuicao": dec("33.34"), "quantidade_vendida": 3},
        {"sk_produto": 3, "valor_liquido": dec(1000), "lucro_bruto": dec(1)},  # not above 1000
        {"sk_produto": 4, "valor_liquido": dec(0), "lucro_bruto": dec(-1)},  # nothing earned
    ])
    (got,) = rows(k.kpi1_product_margin(fact, dims))
    assert (got["nome_produto"], got["total_pedidos"], got["quantidade_total_vendida"]) == ("a", 1, 5)
    assert (got["receita_liquida"], got["margem_contribuicao_media_pct"], got["rentabilidade_pct"]) == (dec(1100), dec("33.34"), dec("10.00"))


def test_discount_bands_add_up(spark):
    fact = sales(spark, [{"percentual_desconto": None if p is None else dec(p), "valor_bruto": dec(10), "valor_desconto": dec(1), "valor_liquido": dec(9)}
                         for p in ("0", "5", "10", "30", "31", None)])
    got = rows(k.kpi2_discount_bands(fact))
    assert [(r["faixa_desconto"], r["numero_transacoes"]) for r in got] == [("1-10%", 2), ("21-30%", 1), ("Acima de 30%", 2), ("Sem Desconto", 1)]
    assert sum(r["valor_bruto_total"] for r in got) == 60 and {r["taxa_desconto_media_pct"] for r in got} == {dec("10.00")}


def regions(spark):
    return {"dim_regiao": published(spark, "dim_regiao", [
        {"sk_regiao": i, "nk_regiao": i, "nome_territorio": n, "continente": "X", "grupo_regional": "G"} for i, n in ((1, "N"), (2, "S"))])}


def test_sellers_without_quota_or_sales_drop_out(spark):
    dims = regions(spark) | {"dim_vendedor": published(spark, "dim_vendedor", [
        {"sk_vendedor": 1, "nk_vendedor": 1, "nome_vendedor": "Ana", "meta_anual": dec(200)},
        {"sk_vendedor": 2, "nk_vendedor": 2, "nome_vendedor": "Rui", "meta_anual": dec(0)}])}
    fact = sales(spark, [
        {"sk_vendedor": 1, "sk_regiao": 1, "valor_liquido": dec(100)}, {"sk_vendedor": 1, "sk_regiao": 2, "valor_liquido": dec(50)},
        {"sk_vendedor": 2, "valor_liquido": dec(9)}, {"sk_vendedor": None, "valor_liquido": dec(7)}, {"sk_vendedor": 1, "sk_regiao": None}])
    got = rows(k.kpi3_seller_quota(fact, dims))
    assert [(r["nome_territorio"], r["percentual_meta_atingido"]) for r in got] == [("N", dec("50.00")), ("S", dec("25.00"))]


def test_newest_months_with_sales(spark):
    """Fourteen months with sales and a gap of years: the newest twelve of them, newest first."""
    keys = [20100115] + [20120000 + m * 100 + 3 for m in range(1, 14) if m <= 12] + [20140228]
    dims = {"dim_tempo": build_dim_tempo(spark)}
    got = rows(k.kpi4_monthly_trend(sales(spark, [{"sk_tempo": s, "valor_liquido": dec(10)} for s in keys]), dims))
    assert [(r["ano"], r["mes"]) for r in got] == [(2014, 2)] + [(2012, m) for m in range(12, 1, -1)]
    assert got[0]["nome_mes"] == "February" and got[0]["ticket_medio"] == dec("10.00")


def test_shares_add_up_and_use_joined_rows_only(spark):
    dims = regions(spark) | products(spark, "a", "b")
    fact = sales(spark, [{"sk_regiao": 1, "valor_liquido": dec(75)}, {"sk_regiao": 2, "sk_produto": 2, "valor_liquido": dec(25)},
                         {"sk_regiao": None, "valor_liquido": dec(900)}])
    got = rows(k.kpi6_geography(fact, dims))
    assert [(r["nome_territorio"], r["participacao_receita_pct"]) for r in got] == [("N", dec("75.00")), ("S", dec("25.00"))]


def test_turnover_drops_the_remainder(spark):
    fact = sales(spark, [{"sk_produto": 1, "quantidade_vendida": 4, "valor_liquido": dec(1)}, {"sk_produto": 2, "quantidade_vendida": 3, "valor_liquido": dec(2)}])
    (got,) = rows(k.kpi7_category(fact, products(spark, "a", "b")))
    assert (got["giro_medio_produto"], got["total_produtos_categoria"], got["participacao_receita_total_pct"]) == (3, 2, dec("100.00"))
    assert got["receita_media_produto"] == dec("1.50")


def test_customer_value(spark):
    kinds = {1: "V", 2: "P", 3: "R", 4: "B", 5: "B"}
    dims = {"dim_cliente": published(spark, "dim_cliente", [
        {"sk_cliente": i, "nk_cliente": i, "tipo_cliente": t, "segmento": "Varejo"} for i, t in kinds.items()])}
    fact = sales(spark, [{"sk_cliente": i, "valor_liquido": dec(v)} for i, v in ((1, 50000), (2, 20000), (3, 5000), (4, 9999), (5, "0.98"))])
    got = {r["tipo_cliente"]: r for r in rows(k.kpi8_customer_value(fact, dims))}
    assert {t: r["categoria_segmento"] for t, r in got.items()} == {"V": "VIP", "P": "Premium", "R": "Regular", "B": "Basico"}
    assert (got["B"]["receita_media_por_cliente"], got["B"]["pedidos_por_cliente"]) == (dec("4999.99"), dec("1.00"))


def test_seasonality_order(spark):
    keys = [20130505, 20130506, 20130511, 20130106]  # Sunday, Monday, Saturday of May, Sunday of January
    got = rows(k.kpi9_seasonality(sales(spark, [{"sk_tempo": s} for s in keys]), {"dim_tempo": build_dim_tempo(spark)}))
    assert [(r["trimestre"], r["nome_dia_semana"], r["eh_fim_semana"]) for r in got] == [
        (1, "Sunday", True), (2, "Monday", False), (2, "Saturday", True), (2, "Sunday", True)]


def test_same_named_products_merge(spark):
    fact = sales(spark, [{"sk_produto": i, "valor_liquido": dec(10), "quantidade_vendida": 3} for i in (1, 2)])
    (got,) = rows(k.kpi10_top_products(fact, products(spark, "a", "a")))
    assert (got["receita_total"], got["quantidade_vendida"], got["preco_medio_unitario"]) == (dec("20.00"), 6, dec("3.33"))


def test_headlines(spark):
    dims = products(spark, "a", "b")
    fact = sales(spark, [
        {"sk_produto": 1, "sk_vendedor": 1, "valor_liquido": dec(10), "lucro_bruto": dec(5), "percentual_desconto": dec(10)},
        {"sk_produto": 2, "valor_liquido": dec(10), "lucro_bruto": dec(-1), "margem_contribuicao": dec(-10), "percentual_desconto": dec(11)},
        {"sk_produto": 2, "sk_tempo": 20140101}])
    assert h.no_seller_share(fact).first().sem_vendedor_pct == dec("66.7")
    assert h.negative_margin_share(fact).first().margem_negativa_pct == dec("33.3")
    assert h.best_subcategory(fact, dims).first().subcategoria_produto == "S-a"
    assert [(r["desconto_acima_10"], r["vendas"], r["lucro"]) for r in rows(h.discount_over_10(fact))] == [(False, 2, dec(5)), (True, 1, dec(-1))]
    total = h.totals(fact).first()
    assert (total.vendas, total.primeira_data, total.ultima_data, total.receita) == (3, 20130506, 20140101, dec(20))
    assert h.top_product(fact, dims).first().nome_produto == "a"


def test_shares_divide_by_the_joined_rows(spark):
    """A key that no dimension row has, as an orphan: its revenue is in no share and in no total."""
    dims = regions(spark) | products(spark, "a", "b")
    fact = sales(spark, [
        {"sk_regiao": 1, "sk_produto": 1, "valor_liquido": dec(75)}, {"sk_regiao": 2, "sk_produto": 2, "valor_liquido": dec(25)},
        {"sk_regiao": 99, "sk_produto": 99, "valor_liquido": dec(900)}])
    got = rows(k.kpi6_geography(fact, dims), "nome_territorio")
    assert [r["participacao_receita_pct"] for r in got] == [dec("75.00"), dec("25.00")]
    assert rows(k.kpi7_category(fact, dims))[0]["participacao_receita_total_pct"] == dec("100.00")
    for report in (k.kpi5_abc_all, k.kpi5_abc_top30):
        got = {r["nome_produto"]: r["percentual_acumulado"] for r in rows(report(fact, dims))}
        assert got == {"a": dec("75.00"), "b": dec("100.00")}


def test_reports_read_the_fact_once_and_do_not_copy_lines(spark, tmp_path):
    dims = regions(spark) | products(spark, "a", "b") | {"dim_tempo": build_dim_tempo(spark), "dim_cliente": published(
        spark, "dim_cliente", [{"sk_cliente": 1, "nk_cliente": 1, "tipo_cliente": "P", "segmento": "V"}])}
    sales(spark, [{"sk_regiao": 1, "valor_liquido": dec(75)}]).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    for report in (k.kpi6_geography, k.kpi7_category, k.kpi8_customer_value):
        assert plan(report(fact, dims)).count("valor_liquido") and plan(report(fact, dims)).count("FileScan parquet") == 1
    for report in (k.kpi4_monthly_trend, k.kpi6_geography, k.kpi8_customer_value):
        text = plan(report(fact, dims))
        assert "Expand" not in text  # nothing is copied
        below = text[text.index("bitmap_construct_agg") :]
        assert below.count("HashAggregate") >= 2  # orders are summed before they are counted
    for report in (k.kpi1_product_margin, k.kpi10_top_products):
        assert "hashpartitioning(_group" in plan(report(fact, dims)).replace("#", " ").replace("_group ", "_group")


def test_types_of_the_reports(spark):
    """The reports' own types, before anything is made portable."""
    dims = regions(spark) | products(spark, "a")
    fact = sales(spark, [{"sk_regiao": 1, "valor_liquido": dec(75), "lucro_bruto": dec(5)}])
    kinds = dict(k.kpi6_geography(fact, dims).dtypes)
    assert kinds["receita_total"] == "decimal(20,2)" and kinds["participacao_receita_pct"] == "decimal(18,2)"
    assert dict(k.kpi10_top_products(fact, dims).dtypes)["receita_total"] == "decimal(20,2)"
    assert dict(k.kpi5_abc_all(fact, dims).dtypes)["percentual_acumulado"] == "decimal(18,2)"
    assert dict(fact.dtypes)["sk_venda"] == "bigint"


def test_show_report_prints_every_row_and_their_number(spark, capsys):
    assert k.show_report("r", spark.range(101).repartition(3), page=50) is True
    lines = capsys.readouterr().out.splitlines()
    assert lines[0] == "r" and lines[-1] == "101 rows" and lines.count("id") == 3
    assert sorted(int(x) for x in lines if x.isdigit()) == list(range(101))


def test_show_report_tells_an_empty_result(spark, capsys):
    assert k.show_report("kpi2", k.kpi2_discount_bands(sales(spark, [{}]))) is True
    assert k.show_report("kpi2", k.kpi2_discount_bands(sales(spark, [{}]).where("false"))) is False
    assert "kpi2: no rows" in capsys.readouterr().out
