"""Dimension builds on hand-made rows."""

import datetime

import pytest
from helpers import dec, rows, staged, values
from pyspark.sql import functions as F

from salesmill.operators.upsert import (
    DuplicateKeyError, assign_keys, first_per_key, insert_if_absent, insert_if_empty, reject_duplicates, type1_upsert,
)
from salesmill.plans import dimensions as dim
from salesmill.plans.calendar import build_dim_date_v1, build_dim_tempo
from salesmill.schemas import DIM_CLIENTE, DIM_PRODUTO, DIM_REGIAO, conform


def test_calendar(spark):
    days = build_dim_tempo(spark)
    assert days.count() == 8401 and build_dim_date_v1(spark).count() == 6575
    sunday = days.where("sk_tempo = 20080106").first()
    assert (sunday.dia_semana, sunday.eh_fim_semana, sunday.nome_dia_semana, sunday.semana_ano) == (0, True, "Sunday", 1)
    assert sunday.eh_feriado is False and sunday.nome_mes == "January" and sunday.trimestre == 1


def test_customers(spark):
    src = staged(
        spark,
        stage_clientes=[(1, 100, None), (2, None, 9), (3, None, None), (4, 100, 9), (7, 101, None), (None, 100, None), (2, None, 9)],
        stage_pessoas=[(100, "Ana", "Lima"), (101, None, "X")],
    )
    got = rows(dim.build_dim_cliente(src["stage_clientes"], src["stage_pessoas"], "2024-01-01"), "nk_cliente")
    assert [(r["nk_cliente"], r["nome_cliente"], r["sobrenome"], r["nome_completo"], r["tipo_cliente"]) for r in got] == [
        (1, "Ana", "Lima", "Ana Lima", "Pessoa Física"),
        (2, "Desconhecido", "", "Cliente 2", "Empresa"),
        (3, "Desconhecido", "", "Cliente 3", "Indefinido"),
        (4, "Ana", "Lima", "Ana Lima", "Pessoa Física"),
        (7, "Desconhecido", "X", "Cliente 7", "Pessoa Física"),
    ]
    assert {r["segmento"] for r in got} == {"Varejo"}
    older = dim.build_dim_customer_v1(src["stage_clientes"], src["stage_pessoas"], "2024-01-01")
    assert older.count() == 7 and older.where("customer_id = 2 and full_name is null").count() == 2


def test_products(spark):
    src = staged(spark)
    got = rows(dim.build_dim_produto(src["stage_produtos"], src["stage_subcategorias"], src["stage_categorias"], "2024-01-01"), "nk_produto")
    bike, cap = got
    assert (bike["categoria_produto"], bike["subcategoria_produto"], bike["margem_percentual"]) == ("Bikes", "Road", dec("40.00"))
    assert (cap["categoria_produto"], cap["subcategoria_produto"]) == ("Sem Categoria", "Sem Subcategoria")
    assert (cap["linha_produto"], cap["cor_produto"], cap["tamanho"], cap["peso"]) == ("N/A", "N/A", "N/A", dec("0.00"))
    assert cap["data_inicio_vigencia"] == datetime.date(2024, 1, 1)
    assert (bike["status_ativo"], cap["status_ativo"]) == (True, False)


def test_list_margin_too_big_stops(spark):
    src = staged(spark)
    free = src["stage_produtos"].withColumn("ListPrice", F.lit("0.01").cast("decimal(15,4)"))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        dim.build_dim_produto(free, src["stage_subcategorias"], src["stage_categorias"]).collect()


def test_sellers(spark):
    src = staged(spark)
    regions = assign_keys(dim.build_dim_regiao(src["stage_territorios"]), "nk_regiao", "sk_regiao")
    got = rows(dim.build_dim_vendedor(src["stage_vendedores"], src["stage_funcionarios"], src["stage_pessoas"], regions), "nk_vendedor")
    assert [(r["nome_vendedor"], r["codigo_vendedor"], r["sk_regiao"], r["meta_anual"], r["comissao_percentual"]) for r in got] == [
        ("Rui Paz", "V00200", 1, dec("1000.00"), dec("0.01")),
        ("Vendedor 201", "V00201", None, dec("0.00"), dec("0.00")),
    ]
    assert [r["data_admissao"] for r in got] == [datetime.date(2010, 1, 2), None]


def test_older_quota_text(spark):
    src = staged(spark)
    text = spark.createDataFrame([(200, 1, "12.345"), (201, 1, "")], "BusinessEntityID bigint, TerritoryID bigint, SalesQuota string")
    territories = assign_keys(dim.build_dim_territory_v1(src["stage_territorios"]), "territory_id", "territory_key")
    got = dim.build_dim_sales_person_v1(text, src["stage_funcionarios"], src["stage_pessoas"], territories)
    assert [r["quota"] for r in rows(got, "sales_person_id")] == [dec("12.35"), dec("0.00")]


def test_offers(spark):
    got = rows(dim.build_dim_oferta(staged(spark)["stage_ofertas"]), "nk_oferta")
    assert [(r["percentual_desconto"], r["quantidade_minima"], r["quantidade_maxima"]) for r in got] == [
        (dec("0.00"), 0, 999999), (dec("0.10"), 0, 60),
    ]


def upsert(table, existing, incoming):
    return type1_upsert(existing, incoming, table.natural[0], table.surrogate, table.updates, table.stamp)


def test_region_keeps_its_first_continent(spark):
    build = lambda group: dim.build_dim_regiao(spark.createDataFrame(
        [(5, "Land", "LD", group)], "TerritoryID bigint, Name string, CountryRegionCode string, `Group` string"))
    first = upsert(DIM_REGIAO, None, build("Europe"))
    again = upsert(DIM_REGIAO, first, build("Pacific")).first()
    assert (again.sk_regiao, again.grupo_regional, again.continente) == (1, "Pacific", "Europa")


def test_upsert_overwrites_listed_columns_only(spark):
    def batch(records):
        ddl = "nk_produto bigint, nome_produto string, codigo_produto string, cor_produto string, custo_unitario decimal(15,4)"
        df = spark.createDataFrame(records, ddl)
        return df.select("*", *[F.lit(None).cast(c.type).alias(c.name) for c in DIM_PRODUTO.columns
                                if c.name not in df.columns and c.name != "sk_produto"])

    first = upsert(DIM_PRODUTO, None, batch([(8, "a", "A", "red", dec(1)), (4, "b", "B", "blue", dec(2))]))
    again = upsert(DIM_PRODUTO, first, batch([(8, "a2", "A2", None, dec(3)), (1, "c", "C", "x", dec(4))]))
    got = {r["nk_produto"]: (r["sk_produto"], r["nome_produto"], r["codigo_produto"], r["cor_produto"]) for r in rows(again)}
    assert got == {4: (1, "b", "B", "blue"), 8: (2, "a2", "A", None), 1: (3, "c", "C", "x")}


def test_stamp_moves_on_update_only(spark):
    old = datetime.datetime(2001, 1, 1)
    existing = conform(spark.createDataFrame(
        [(1, 10, "a", old), (2, 20, "b", old)],
        "sk_cliente bigint, nk_cliente bigint, nome_cliente string, ultima_atualizacao timestamp"), DIM_CLIENTE)
    incoming = existing.where("nk_cliente = 10").drop("sk_cliente", "ultima_atualizacao").withColumn("nome_cliente", F.lit("z"))
    got = {r["nk_cliente"]: r for r in rows(upsert(DIM_CLIENTE, existing, incoming))}
    assert got[20]["ultima_atualizacao"] == old and got[10]["ultima_atualizacao"] > old
    assert got[10]["nome_cliente"] == "z"


def test_loading_twice_changes_nothing(spark):
    batch = dim.build_dim_regiao(staged(spark)["stage_territorios"])
    once = upsert(DIM_REGIAO, None, batch)
    assert rows(upsert(DIM_REGIAO, once, batch), "nk_regiao") == rows(once, "nk_regiao")


def test_duplicate_key_in_one_batch_is_named(spark):
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "nk bigint, v string")
    with pytest.raises(DuplicateKeyError, match=r"\(1,\)"):
        reject_duplicates(batch, ["nk"], "dim")


def test_first_per_key_and_insert_if_absent(spark):
    new = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 2, "c"), (2, 1, None)], "o int, l int, v string")
    assert rows(first_per_key(new, ["o", "l"]), "o", "l") == [
        {"o": 1, "l": 1, "v": "a"}, {"o": 1, "l": 2, "v": "c"}, {"o": 2, "l": 1, "v": None}]
    old = spark.createDataFrame([(1, 1, "kept")], "o int, l int, v string")
    assert rows(insert_if_absent(old, new, ["o", "l"]), "o") == [{"o": 1, "l": 2, "v": "c"}, {"o": 2, "l": 1, "v": None}]


def test_insert_if_empty(spark):
    none, some = spark.range(0), spark.range(3)
    assert insert_if_empty(None, some) is some and insert_if_empty(none, some) is some
    assert insert_if_empty(some, spark.range(9)) is some


def test_defaults_fill_absent_columns_only(spark):
    df = spark.createDataFrame([(1, 2, None)], "sk_vendedor bigint, nk_vendedor bigint, sk_regiao bigint")
    from salesmill.schemas import DIM_VENDEDOR

    got = conform(df, DIM_VENDEDOR).first()
    assert got.status_ativo is True and got.sk_regiao is None
    explicit = conform(df.withColumn("status_ativo", F.lit(None).cast("boolean")), DIM_VENDEDOR)
    assert values(explicit, "status_ativo") == [None]
