"""Fact measures, the whole load, the store, and what a broken constraint does."""

import pytest
from helpers import MONDAY, ROWS, SMALL, day, dec, plan, published, rows, staged, values
from pyspark.sql import functions as F

from salesmill.operators.quality import QualityError
from salesmill.plans.fact import build_fact, fact_load_stats, measures
from salesmill.operators.staging import stage_table
from salesmill.operators.upsert import DuplicateKeyError, reject_duplicates
from salesmill.plans.pipeline import DIMENSIONS, load_dimension, loaded_keys, read_dims, read_fact, run_pipeline
from salesmill.plans.store import Warehouse
from salesmill.schemas import TABLES
from salesmill.session import scratch_path
from salesmill.sources.testdata import LINE_ORDER, TestTables


def measured(spark, q, p, d, c):
    df = spark.createDataFrame(
        [(q, dec(p), None if d is None else dec(d), None if c is None else dec(c))],
        "OrderQty int, UnitPrice decimal(15,4), UnitPriceDiscount decimal(18,4), custo_unitario decimal(15,4)",
    )
    return df.select(*[e.alias(n) for n, e in measures().items()]).first().asDict()


def test_ordinary_line(spark):
    m = measured(spark, 3, 100, "0.10", 60)
    assert [m[k] for k in ("valor_bruto", "valor_desconto", "valor_liquido", "custo_total", "lucro_bruto")] == [
        dec(300), dec(30), dec(270), dec(180), dec(90)]
    assert (m["percentual_desconto"], m["margem_contribuicao"]) == (dec("10.00"), dec("33.33"))


def test_free_line(spark):
    m = measured(spark, 3, 100, "1.00", 60)
    assert (m["valor_liquido"], m["lucro_bruto"], m["margem_contribuicao"]) == (dec(0), dec(-180), dec(0))


def test_missing_discount_and_cost(spark):
    m = measured(spark, 1, 10, None, 4)
    assert (m["valor_liquido"], m["margem_contribuicao"]) == (dec(10), dec("60.00"))
    assert measured(spark, 1, 10, None, None)["margem_contribuicao"] == dec("100.00")


def test_amounts_are_rounded_once(spark):
    m = measured(spark, 1, "0.0099", "0.0050", 0)
    assert (m["valor_desconto"], m["valor_liquido"]) == (dec("0.0000"), dec("0.0099"))


def test_margin_overflow_stops(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        measured(spark, 1, 10, 0, 200)


def load(spark, wh=None, stage=False, **changed):
    root = wh.root if wh else scratch_path(spark, "t")
    return run_pipeline(spark, staged(spark, **changed), root, stage=stage, load_date="2024-01-01")


@pytest.fixture
def wh(spark):
    return load(spark)


def test_whole_load(spark):
    wh = load(spark, stage=True)
    dims, fact = read_dims(wh), read_fact(wh)
    assert {n: df.count() for n, df in dims.items()} == {
        "dim_tempo": 8401, "dim_regiao": 2, "dim_cliente": 3, "dim_produto": 2, "dim_vendedor": 2, "dim_oferta": 2}
    got = rows(fact, "numero_pedido", "numero_linha")
    assert [(r["numero_pedido"], r["numero_linha"], r["valor_liquido"], r["sk_vendedor"], r["sk_tempo"], r["ano_mes"]) for r in got] == [
        (1000, 1, dec(270), 1, 20130506, 201305), (1000, 2, dec(10), 1, 20130506, 201305), (1001, 1, dec(200), None, 20130506, 201305)]
    assert len(set(values(fact, "sk_venda"))) == 3
    assert fact_load_stats(fact).first().asDict() == {"total_vendas": 3, "receita": dec(480), "lucro": dec(176)}


def test_loading_twice_adds_nothing(spark, wh):
    before = rows(read_fact(wh), "sk_venda")
    versions = {n: wh.version(n) for n in ("dim_tempo", "dim_cliente", "fato_vendas")}
    load(spark, wh)
    assert rows(read_fact(wh), "sk_venda") == before
    assert wh.version("dim_tempo") == versions["dim_tempo"]  # filled already
    assert wh.version("fato_vendas") == versions["fato_vendas"]  # nothing to add
    assert wh.version("dim_cliente") == versions["dim_cliente"] + 1


def test_a_loaded_line_never_changes(spark, wh):
    dearer = [(o, l, q, p, s, price * 2, d) for o, l, q, p, s, price, d in ROWS["stage_pedidos_detalhe"]]
    added = (1001, 2, 1, 11, 1, dec(10), dec(0))
    load(spark, wh, stage_pedidos_detalhe=[*dearer, added])
    got = rows(read_fact(wh), "numero_pedido", "numero_linha")
    assert [r["valor_liquido"] for r in got] == [dec(270), dec(10), dec(200), dec(10)]
    assert len({r["sk_venda"] for r in got}) == 4
    assert len(wh.folders("fato_vendas")) == 2  # the new line was added, old files were not rewritten


def test_lines_without_order_or_number_are_dropped(spark):
    lines = [*ROWS["stage_pedidos_detalhe"], (9999, 1, 1, 10, 1, dec(1), None), (1000, None, 1, 10, 1, dec(1), None)]
    assert read_fact(load(spark, stage_pedidos_detalhe=lines)).count() == 3


def test_repeated_headers_do_not_repeat_lines(spark):
    headers = [*ROWS["stage_pedidos_header"], *ROWS["stage_pedidos_header"]]
    assert read_fact(load(spark, stage_pedidos_header=headers)).count() == 3


@pytest.mark.parametrize(
    "changed, message",
    [
        ({"stage_pedidos_header": [(1000, MONDAY, 99, 1, 200), (1001, MONDAY, 2, 2, None)]}, "sk_cliente is missing"),
        ({"stage_pedidos_header": [(1000, day("2007-12-31"), 1, 1, 200), (1001, MONDAY, 2, 2, None)]}, "sk_tempo: 2 rows"),
        ({"stage_pedidos_detalhe": [(1000, 1, 3, 77, 2, dec(100), dec(0))]}, "sk_produto is missing"),
    ],
)
def test_broken_reference_publishes_nothing(spark, changed, message):
    other = Warehouse(spark, scratch_path(spark, "t"))
    with pytest.raises(QualityError, match=message):
        load(spark, other, **changed)
    assert other.version("fato_vendas") == 0 and read_fact(other).count() == 0


def test_long_text_publishes_nothing(spark, wh):
    long = [(1, "N" * 101, "US", "Europe")]
    with pytest.raises(QualityError, match="nome_territorio is longer than 100"):
        load(spark, wh, stage_territorios=long)
    assert sorted(values(wh.read("dim_regiao"), "nome_territorio")) == ["France", "Northwest"]


def test_duplicate_dimension_key_stops(spark):
    twice = [*ROWS["stage_territorios"], (1, "Other", "US", "Europe")]
    with pytest.raises(ValueError, match="dim_regiao"):
        load(spark, stage_territorios=twice)


def test_empty_sources(spark, caplog):
    wh = load(spark, stage=True, **{n: [] for n in ROWS})
    assert "is empty" in caplog.text
    assert read_fact(wh).count() == 0 and read_dims(wh)["dim_cliente"].columns == [c.name for c in TABLES["dim_cliente"].columns]


def test_ansi_off_is_refused(spark, setting):
    setting("spark.sql.ansi.enabled", "false")
    with pytest.raises(RuntimeError, match="ansi"):
        load(spark)


def test_gross_is_net_plus_discount(spark):
    src = TestTables(spark, SMALL)
    wh = run_pipeline(spark, src, scratch_path(spark, "t"), stage=False, order=LINE_ORDER)
    fact = read_fact(wh)
    assert fact.count() == 4599
    assert fact.where("abs(valor_bruto - valor_liquido - valor_desconto) > 0.0001").count() == 0


def test_a_folder_counts_once_the_pointer_names_it(spark):
    wh = Warehouse(spark, scratch_path(spark, "store"))
    n = {"rows": F.count(F.lit(1))}
    assert wh.read("t") is None and wh.version("t") == 0
    one, counted = wh.prepare("t", spark.range(3), n)
    assert counted == {"rows": 3} and wh.read("t") is None  # written, not published
    two, _ = wh.prepare("t", spark.range(10, 12), n)
    assert wh.publish("t", [one.name], {"last": 3}) == 1
    first = wh.read("t")
    assert wh.publish("t", [one.name, two.name]) == 2
    assert sorted(values(Warehouse(spark, wh.root).read("t"), "id")) == [0, 1, 2, 10, 11] and wh.pointer("t").notes == {"last": 3}
    assert first.count() == 3  # a reader keeps what it has resolved
    assert wh.publish("t", [two.name]) == 3 and sorted(values(wh.read("t"), "id")) == [10, 11]


def test_keys_of_a_load_that_was_not_published_do_not_count(spark, wh):
    lost = spark.createDataFrame([(1001, 2)], "numero_pedido bigint, numero_linha bigint")
    loaded_keys(wh).add("v=failed", lost)
    load(spark, wh, stage_pedidos_detalhe=[*ROWS["stage_pedidos_detalhe"], (1001, 2, 1, 11, 1, dec(10), dec(0))])
    assert read_fact(wh).count() == 4
    keys = loaded_keys(wh)
    assert rows(keys.read(wh.pointer("fato_vendas").folders).distinct(), "numero_pedido", "numero_linha") == rows(
        read_fact(wh).select("numero_pedido", "numero_linha"), "numero_pedido", "numero_linha")


def test_only_parts_with_changes_are_written_again(spark, monkeypatch):
    from salesmill.plans import pipeline

    monkeypatch.setattr(pipeline, "PART_ROWS", 4)
    table = TABLES["dim_regiao"]
    wh = Warehouse(spark, scratch_path(spark, "t"))

    def batch(names):
        return spark.createDataFrame([(i, n, "US", "United States", "Europe", "Europa") for i, n in names.items()],
                                     "nk_regiao bigint, nome_territorio string, codigo_pais string, nome_pais string, grupo_regional string, continente string")

    names = {i: f"T{i}" for i in range(40)}
    load_dimension(wh, table, batch(names))
    before = wh.pointer("dim_regiao")
    assert before.notes["parts"] == 10 and len(before.folders) == 10
    keys = {r["nk_regiao"]: r["sk_regiao"] for r in rows(wh.read("dim_regiao"))}
    load_dimension(wh, table, batch(names))
    assert wh.pointer("dim_regiao") == before
    names |= {7: None, 50: "new"}
    load_dimension(wh, table, batch({i: names[i] for i in (7, 8, 50)}))
    after = wh.pointer("dim_regiao")
    assert 8 <= len(set(after.folders) & set(before.folders)) <= 9
    got = {r["nk_regiao"]: r for r in rows(wh.read("dim_regiao"))}
    assert {i: r["nome_territorio"] for i, r in got.items()} == names
    assert {i: r["sk_regiao"] for i, r in got.items()} == keys | {50: 41}
    load_dimension(wh, table, batch({i: f"T{i}" for i in range(100, 160)}))  # outgrown: written anew in more parts
    assert wh.pointer("dim_regiao").notes["parts"] == 26 and wh.read("dim_regiao").count() == 101
    assert len(set(values(wh.read("dim_regiao"), "sk_regiao"))) == 101


def test_comparing_a_batch_reads_each_side_once(spark, wh):
    from salesmill.operators.upsert import upsert_changes

    table = TABLES["dim_regiao"]
    stored = wh.read("dim_regiao", table.schema)
    batch = stored.withColumn("nome_territorio", F.when(F.col("nk_regiao") == 1, None).otherwise(F.col("nome_territorio")))
    found = upsert_changes(stored, batch, "nk_regiao", "sk_regiao", table.updates, None, 1)
    assert found.first().asDict() == {"repeated": 0, "added": 0, "changed": 1, "rows": 2, "last": 2, "parts": [0]}
    assert plan(found).count("FileScan parquet") == 2
    assert upsert_changes(stored, stored, "nk_regiao", "sk_regiao", table.updates, None, 1).first()["changed"] == 0


def test_keys_and_references_are_checked_in_one_pass(spark, wh):
    from salesmill.operators.quality import key_faults

    fact, dims = read_fact(wh), read_dims(wh)
    faults = key_faults(fact, TABLES["fato_vendas"], dims)
    text = plan(faults)
    assert text.count("sk_venda") and len([x for x in text.splitlines() if "FileScan" in x and "sk_venda" in x]) == 1
    assert text.count("FileScan parquet") == 1 + 6
    assert all(r["values"] >= 1 and not r["lost"] and r["check"] >= 2 for r in rows(faults))
    twice = fact.unionByName(fact.where("numero_linha = 2").withColumn("sk_oferta", F.lit(99).cast("bigint")))
    found = {r["check"]: (r["values"], r["lost"]) for r in rows(key_faults(twice, TABLES["fato_vendas"], dims))}
    assert found[0] == found[1] == (1, 0) and found[7][1] == 1


def test_sound_keys_are_checked_without_moving_them_one_by_one(spark, wh, tmp_path):
    """64 neighbouring keys move as one row; every single fault is still found."""
    from salesmill.operators.quality import doubtful_keys, enforce_keys
    from salesmill.schemas import FATO_VENDAS

    fact, dims = read_fact(wh), read_dims(wh)
    doubtful = lambda df: doubtful_keys(df, FATO_VENDAS, dims).first()["doubtful"]
    assert doubtful(fact) == 0 and enforce_keys(fact, FATO_VENDAS, dims) is None
    last = fact.agg(F.max("sk_venda"), F.max("numero_linha")).first()
    assert doubtful(fact.unionByName(fact.where("numero_linha = 2"))) == 2
    assert doubtful(fact.unionByName(fact.where("numero_linha = 2").withColumn("sk_venda", F.lit(last[0] + 1)))) == 1
    assert doubtful(fact.unionByName(fact.where("numero_linha = 2").withColumn("numero_linha", F.lit(last[1] + 64)))) == 1
    for column in FATO_VENDAS.references:
        bad = F.when(F.col("numero_linha") == 2, F.lit(-70)).otherwise(F.col(column)).cast(fact.schema[column].dataType)
        assert doubtful(fact.withColumn(column, bad)) == 1
        with pytest.raises(QualityError, match=f"{column}: 1 rows"):
            enforce_keys(fact.withColumn(column, bad), FATO_VENDAS, dims)
    many = spark.range(1, 64_001, 1, 1).select(*[
        (F.col("id") if f.name in ("sk_venda", "numero_linha") else F.lit(1) if f.name == "numero_pedido" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in fact.schema])
    many.write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    faults = doubtful_keys(many, FATO_VENDAS, dims)
    text = faults._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in text and faults.first()["doubtful"] == 0


def test_measures_are_computed_after_rows_are_spread_by_month(spark, wh):
    from salesmill.plans.fact import build_fact

    src = staged(spark)
    text = plan(build_fact(src["stage_pedidos_detalhe"], src["stage_pedidos_header"], read_dims(wh), months=True))
    assert "REBALANCE" in text and "lucro_bruto" not in text[text.index("REBALANCE"):]


def test_a_seller_added_later_takes_the_defaults(spark, wh):
    assert set(values(wh.read("dim_vendedor"), "status_ativo")) == {True}
    more = [*ROWS["stage_vendedores"], (202, 1, dec(5), None)]
    load(spark, wh, stage_vendedores=more)
    got = rows(wh.read("dim_vendedor"), "nk_vendedor")
    assert [(r["nk_vendedor"], r["status_ativo"]) for r in got] == [(200, True), (201, True), (202, True)]


def test_unchanged_dimensions_are_not_published_again(spark, wh):
    names = ("dim_regiao", "dim_produto", "dim_vendedor", "dim_oferta")
    before = {n: wh.version(n) for n in names}
    load(spark, wh)
    assert {n: wh.version(n) for n in names} == before
    load(spark, wh, stage_territorios=[(1, "Northwest", "US", "North America"), (2, "Gaul", "FR", "Europe")])
    assert wh.version("dim_regiao") == before["dim_regiao"] + 1


@pytest.mark.parametrize("column, message", [("sk_regiao", "nk_regiao|sk_regiao"), ("nk_regiao", "nk_regiao")])
def test_repeated_keys_publish_nothing(spark, column, message):
    from salesmill.plans.pipeline import _publish_checked

    wh = Warehouse(spark, scratch_path(spark, "t"))
    twice = published(spark, "dim_regiao", [{"sk_regiao": i, "nk_regiao": i, "nome_territorio": "N"} for i in (1, 2)])
    twice = twice.withColumn(column, F.lit(1).cast("bigint"))
    with pytest.raises(QualityError, match=message):
        _publish_checked(wh, TABLES["dim_regiao"], twice)
    assert wh.version("dim_regiao") == 0


def test_a_seller_without_its_region_publishes_nothing(spark):
    from salesmill.plans.pipeline import _publish_checked

    wh = Warehouse(spark, scratch_path(spark, "t"))
    lost = published(spark, "dim_vendedor", [{"sk_vendedor": 1, "nk_vendedor": 1, "nome_vendedor": "A", "sk_regiao": 9}])
    with pytest.raises(QualityError, match="sk_regiao: 1 rows"):
        _publish_checked(wh, TABLES["dim_vendedor"], lost)
    assert wh.version("dim_vendedor") == 0


def test_duplicate_error_tells_how_many(spark):
    twice = spark.createDataFrame([(i % 11,) for i in range(22)], "k bigint")
    with pytest.raises(DuplicateKeyError, match="t: 11 keys"):
        reject_duplicates(twice, ["k"], "t")


def test_text_columns_are_staged_by_what_they_hold(spark):
    text = spark.createDataFrame([("1", "1.5", "x", "true", None), ("-20", "3", "7", "false", None)], "a string, b string, c string, d string, e string")
    typed = stage_table({"t": text}, "t", scratch_path(spark, "typed"), infer=True)
    assert dict(typed.dtypes) == {"a": "bigint", "b": "decimal(18,4)", "c": "string", "d": "boolean", "e": "string"}
    assert rows(typed, "a")[0] == {"a": -20, "b": dec(3), "c": "7", "d": False, "e": None}


def test_dimension_load_alone(spark):
    wh = Warehouse(spark, scratch_path(spark, "t"))
    from salesmill.plans.dimensions import build_dim_oferta

    load_dimension(wh, TABLES["dim_oferta"], build_dim_oferta(staged(spark)["stage_ofertas"]))
    assert wh.read("dim_oferta").count() == 2
    assert set(read_dims(wh)) == set(DIMENSIONS)
