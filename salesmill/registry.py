"""Every operator and report as a query over one folder of test tables.

Reports and checks run on a warehouse that is loaded once per session and folder; the load's own
steps are built straight from the source tables. Results leave as whole numbers, doubles, text and
booleans, so that another engine's rows can be compared with them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from salesmill.functions import columns as fn
from salesmill.operators import quality as q
from salesmill.operators.inference import infer_column_types
from salesmill.operators.lookup import look_up
from salesmill.operators.staging import stage_all, stage_table, staged_rows
from salesmill.operators.upsert import assign_keys, type1_upsert
from salesmill.plans import dimensions as dim
from salesmill.plans.calendar import build_dim_date_v1, build_dim_tempo, day_series
from salesmill.plans.fact import build_fact, build_fact_sales_v1, fact_load_stats, header_detail, known_lines, measures
from salesmill.plans.headlines import HEADLINES
from salesmill.plans.kpis import KPIS
from salesmill.plans.pipeline import DIMENSIONS, load_dimension, read_dims, read_fact, run_pipeline
from salesmill.plans.store import CODEC, Warehouse
from salesmill.schemas import DIM_TEMPO, FATO_VENDAS, TABLES, V1_UPDATES
from salesmill.session import scratch_path, written
from salesmill.sources.testdata import LINE_ORDER, TestTables

Query = Callable[[SparkSession, str], DataFrame]

LOAD_DATE = "2024-01-01"
# An earlier load, for the queries about loading again: what was sold before these days.
EARLIER_LOAD_DATE = "2010-01-01"
FIRST_DAYS, FIRST_MONTHS, FIRST_YEARS = "2008-01-02", "2008-04-01", "2011-01-01"

_sources: dict[tuple, TestTables] = {}
_warehouses: dict[tuple, Warehouse] = {}


def _fingerprint(spark: SparkSession, base: str) -> tuple:
    """Size and change time of the source files, from a directory listing on the driver."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found))


def _key(spark: SparkSession, base: str) -> tuple:
    return spark.sparkContext.applicationId, base, _fingerprint(spark, base)


def _source(spark: SparkSession, base: str) -> TestTables:
    """The staging shapes of `base`, opened again only if the session or the files changed."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("spark.sql.ansi.enabled must be on: a value that does not fit must stop the load")
    return _sources.setdefault(_key(spark, base), TestTables(spark, base))


def warehouse(spark: SparkSession, base: str) -> Warehouse:
    """The warehouse loaded from `base`, loaded again only if the session or the files changed."""
    key, source = _key(spark, base), _source(spark, base)
    if key not in _warehouses:
        root = scratch_path(spark, "warehouse")
        _warehouses[key] = run_pipeline(spark, source, root, stage=False, load_date=LOAD_DATE, order=LINE_ORDER)
    return _warehouses[key]


def portable(df: DataFrame) -> DataFrame:
    def out(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return c.cast("bigint").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c.cast("string").alias(f.name)
        return c

    return df.select(*[out(f) for f in df.schema.fields])


def _published(report, spark: SparkSession, base: str) -> DataFrame:
    wh = warehouse(spark, base)
    return report(read_fact(wh), read_dims(wh))


def _maybe(name: str) -> Column:
    """A whole number that is often missing leaves as a double; data frames have no missing integer."""
    return F.col(name).cast("double").alias(name)


# Staging

def stage_extract(spark, base):
    return _source(spark, base).raw("lineitem")


def stage_row_counts(spark, base):
    return staged_rows(stage_all(spark, _source(spark, base), scratch_path(spark, "staging")))


def _inferred(spark, base, **rules):
    src = _source(spark, base)
    return q.union_all(
        infer_column_types(src[name], **rules).select(F.lit(name).alias("table"), "column", "type")
        for name in src.keys()
    )


def stage_typed_orders(spark, base):
    """An extract of the orders in which every column is text, staged with the types it is written in."""
    text = _source(spark, base).raw("orders").select(
        F.col("o_orderkey").cast("string").alias("chave"),
        F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("total"),
        F.col("o_orderpriority").alias("prioridade"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("momento"),
        (F.col("o_orderstatus") == "F").cast("string").alias("fechado"),
    )
    staged = stage_table({"orders": text}, "orders", scratch_path(spark, "typed"), infer=True)
    return staged.select(
        "chave", "total", "prioridade", "fechado", F.date_format("momento", "yyyy-MM-dd").alias("dia"),
        *[F.lit(kind).alias(f"tipo_{name}") for name, kind in staged.dtypes],
    )


def infer_text(spark, base):
    """An untyped extract of the orders: every column is text, one is always empty."""
    status = F.col("o_orderstatus")
    key = F.col("o_orderkey").cast("string")
    total = F.col("o_totalprice").cast("decimal(15,2)")
    whole = total.cast("bigint").cast("string")
    text = _source(spark, base).raw("orders").select(
        key.alias("chave"),
        total.cast("string").alias("total"),
        F.when(status == "F", whole).otherwise(total.cast("string")).alias("total_misto"),
        F.concat(whole, F.lit("e0")).alias("total_float"),
        F.when(status == "F", whole).otherwise(F.concat(whole, F.lit("e0"))).alias("inteiro_ou_float"),
        F.col("o_orderpriority").alias("prioridade"),
        F.col("o_orderdate").cast("date").cast("string").alias("dia"),
        F.col("o_orderdate").cast("string").alias("momento"),
        (status == "F").cast("string").alias("fechado"),
        F.when(status == "F", key).alias("chave_ou_nada"),
        F.when(status == "F", key).otherwise(status).alias("chave_ou_texto"),
        F.lit(None).cast("string").alias("vazio"),
    )
    loose = infer_column_types(text, parse_text=True)
    strict = infer_column_types(text, null_as_text=True, date_as_timestamp=True, parse_text=True)
    return loose.join(strict.withColumnRenamed("type", "strict_type"), "column")


# Calendar

def calendar_series(spark, base):
    bounds = _source(spark, base)["stage_pedidos_header"].agg(
        F.min("OrderDate").alias("first"), F.max("OrderDate").alias("last")
    )
    return day_series(bounds, F.col("first"), F.col("last"))


def _with_orders(calendar: DataFrame, key: str, spark, base) -> DataFrame:
    """Every calendar day with the number of orders placed on it."""
    per_day = (
        _source(spark, base)["stage_pedidos_header"]
        .groupBy(fn.date_key(F.col("OrderDate").cast("date")).alias("_day"))
        .agg(F.count(F.lit(1)).alias("pedidos"))
    )
    return (
        calendar.join(per_day, F.col(key) == F.col("_day"), "left")
        .drop("_day")
        .withColumn("pedidos", F.coalesce("pedidos", F.lit(0)))
    )


def dim_tempo(spark, base):
    return _with_orders(build_dim_tempo(spark), "sk_tempo", spark, base)


def dim_date_v1(spark, base):
    return _with_orders(build_dim_date_v1(spark), "date_key", spark, base)


# Dimensions

def dim_cliente(spark, base):
    src = _source(spark, base)
    return dim.build_dim_cliente(src["stage_clientes"], src["stage_pessoas"], LOAD_DATE)


def dim_customer_v1(spark, base):
    src = _source(spark, base)
    return dim.build_dim_customer_v1(src["stage_clientes"], src["stage_pessoas"], LOAD_DATE)


def _hierarchy(src):
    return src["stage_subcategorias"], src["stage_categorias"]


def dim_produto(spark, base):
    src = _source(spark, base)
    return dim.build_dim_produto(src["stage_produtos"], *_hierarchy(src), LOAD_DATE)


def dim_product_v1(spark, base):
    src = _source(spark, base)
    return dim.build_dim_product_v1(src["stage_produtos"], *_hierarchy(src), LOAD_DATE)


def dim_regiao(spark, base):
    return dim.build_dim_regiao(_source(spark, base)["stage_territorios"])


def dim_territory_v1(spark, base):
    return dim.build_dim_territory_v1(_source(spark, base)["stage_territorios"])


def _staff(src):
    return src["stage_vendedores"], src["stage_funcionarios"], src["stage_pessoas"]


def dim_vendedor(spark, base):
    regions = assign_keys(dim_regiao(spark, base), "nk_regiao", "sk_regiao")
    return dim.build_dim_vendedor(*_staff(_source(spark, base)), regions)


def dim_sales_person_v1(spark, base):
    territories = assign_keys(dim_territory_v1(spark, base), "territory_id", "territory_key")
    return dim.build_dim_sales_person_v1(*_staff(_source(spark, base)), territories)


def dim_oferta(spark, base):
    return dim.build_dim_oferta(_source(spark, base)["stage_ofertas"])


def dim_promotion_v1(spark, base):
    return dim.build_dim_promotion_v1(_source(spark, base)["stage_ofertas"])


# Loading again

def _sold_before(spark, base, day: str) -> tuple[DataFrame, DataFrame]:
    """Headers before `day`, and their lines.

    Lines meet distinct order numbers: to tell these, Spark need not look up what the headers say of customers.
    """
    src = _source(spark, base)
    early = src["stage_pedidos_header"].where(F.col("OrderDate") < F.lit(day).cast("timestamp_ntz"))
    lines = src["stage_pedidos_detalhe"].join(early.select("SalesOrderID").distinct(), "SalesOrderID", "left_semi")
    return early, lines


def _only(df: DataFrame, key: str, used: DataFrame, used_key: str) -> DataFrame:
    return df.join(used.select(F.col(used_key).alias(key)), key, "left_semi")


def surrogate_key_assign(spark, base):
    """Customers of the first months keep the numbers they got first; the others are numbered after them."""
    early, _ = _sold_before(spark, base, FIRST_MONTHS)
    everyone = _source(spark, base)["stage_clientes"].select(F.col("CustomerID").alias("nk_cliente"))
    before = written(assign_keys(_only(everyone, "nk_cliente", early, "CustomerID"), "nk_cliente", "sk_cliente"), "keys")
    added = assign_keys(everyone.join(before, "nk_cliente", "left_anti"), "nk_cliente", "sk_cliente", before)
    return before.unionByName(added)


def _upserted(table: str, earlier: DataFrame, now: DataFrame, others: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Load `earlier` into an empty warehouse (after `others`), then `now`, and read what is published."""
    t, wh = TABLES[table], Warehouse(now.sparkSession, scratch_path(now.sparkSession, "upsert"))
    for name, rows in (others or {}).items():
        load_dimension(wh, TABLES[name], rows)
    for batch in (earlier, now):
        load_dimension(wh, t, batch)
    both = wh.read(table, t.schema)
    return both.drop(t.stamp) if t.stamp else both


def scd1_upsert_cliente(spark, base):
    """First load: customers of the first months, none of them linked to a person yet."""
    src = _source(spark, base)
    early, _ = _sold_before(spark, base, FIRST_MONTHS)
    unlinked = _only(src["stage_clientes"], "CustomerID", early, "CustomerID").withColumn(
        "PersonID", F.lit(None).cast("bigint")
    )
    earlier = dim.build_dim_cliente(unlinked, src["stage_pessoas"], EARLIER_LOAD_DATE)
    return _upserted("dim_cliente", earlier, dim_cliente(spark, base))


def _cheaper_products(src, lines: DataFrame) -> DataFrame:
    """Products on the given lines, at nine tenths of their price, without size, still on sale."""
    return (
        _only(src["stage_produtos"], "ProductID", lines, "ProductID")
        .withColumn("ListPrice", (F.col("ListPrice") * F.lit("0.9").cast("decimal(2,1)")).cast("decimal(15,4)"))
        .withColumn("Size", F.lit(None).cast("string"))
        .withColumn("SellEndDate", F.lit(None).cast("timestamp_ntz"))
    )


def scd1_upsert_produto(spark, base):
    src = _source(spark, base)
    _, lines = _sold_before(spark, base, FIRST_MONTHS)
    earlier = dim.build_dim_produto(_cheaper_products(src, lines), *_hierarchy(src), EARLIER_LOAD_DATE)
    return _upserted("dim_produto", earlier, dim_produto(spark, base))


def scd1_upsert_regiao(spark, base):
    """First load: territories of the first days, all of them then in one European group."""
    src = _source(spark, base)
    early, _ = _sold_before(spark, base, FIRST_DAYS)
    moved = _only(src["stage_territorios"], "TerritoryID", early, "TerritoryID").withColumn("Group", F.lit("Old Europe"))
    return _upserted("dim_regiao", dim.build_dim_regiao(moved), dim_regiao(spark, base))


def scd1_upsert_vendedor(spark, base):
    """First load: sellers of the first months, without quota and territory."""
    src = _source(spark, base)
    early, _ = _sold_before(spark, base, FIRST_MONTHS)
    sellers, employees, persons = _staff(src)
    plain = (
        _only(sellers, "BusinessEntityID", early, "SalesPersonID")
        .withColumn("SalesQuota", F.lit(None).cast("decimal(18,2)"))
        .withColumn("TerritoryID", F.lit(None).cast("bigint"))
    )
    regions = assign_keys(dim_regiao(spark, base), "nk_regiao", "sk_regiao")
    earlier = dim.build_dim_vendedor(plain, employees, persons, regions)
    return _upserted("dim_vendedor", earlier, dim_vendedor(spark, base), {"dim_regiao": dim_regiao(spark, base)})


def scd1_upsert_oferta(spark, base):
    """First load: offers of the first days, under an older description and discount."""
    src = _source(spark, base)
    _, lines = _sold_before(spark, base, FIRST_DAYS)
    old = (
        _only(src["stage_ofertas"], "SpecialOfferID", lines, "SpecialOfferID")
        .withColumn("Description", F.concat(F.lit("Old "), "Description"))
        .withColumn("Type", F.lit("Old"))
        .withColumn("DiscountPct", F.lit(None).cast("decimal(18,4)"))
    )
    return _upserted("dim_oferta", dim.build_dim_oferta(old), dim_oferta(spark, base))


def _upserted_v1(table: str, key: str, surrogate: str, earlier: DataFrame, now: DataFrame, stamp: str | None = None) -> DataFrame:
    """Two loads of a table of the older model."""
    updates = V1_UPDATES[table]
    first = written(type1_upsert(None, written(earlier, table), key, surrogate, updates, stamp), table)
    return type1_upsert(first, written(now, table), key, surrogate, updates, stamp)


def scd1_upsert_v1(spark, base):
    src = _source(spark, base)
    _, lines = _sold_before(spark, base, FIRST_MONTHS)
    earlier = dim.build_dim_product_v1(_cheaper_products(src, lines), *_hierarchy(src), EARLIER_LOAD_DATE)
    return _upserted_v1("dim_product", "product_id", "product_key", earlier, dim_product_v1(spark, base))


def scd1_upsert_v1_customer(spark, base):
    """First load: customers of the first months, nameless; `updated` tells who has an update date."""
    src = _source(spark, base)
    early, _ = _sold_before(spark, base, FIRST_MONTHS)
    unlinked = _only(src["stage_clientes"], "CustomerID", early, "CustomerID").withColumn("PersonID", F.lit(None).cast("bigint"))
    earlier = dim.build_dim_customer_v1(unlinked, src["stage_pessoas"], EARLIER_LOAD_DATE)
    both = _upserted_v1("dim_customer", "customer_id", "customer_key", earlier, dim_customer_v1(spark, base), "update_date")
    return both.withColumn("updated", F.col("update_date").isNotNull()).drop("update_date")


def scd1_upsert_v1_territory(spark, base):
    """First load: territories of the first days, in one old group."""
    src = _source(spark, base)
    early, _ = _sold_before(spark, base, FIRST_DAYS)
    moved = _only(src["stage_territorios"], "TerritoryID", early, "TerritoryID").withColumn("Group", F.lit("Old"))
    earlier = dim.build_dim_territory_v1(moved)
    return _upserted_v1("dim_territory", "territory_id", "territory_key", earlier, dim_territory_v1(spark, base))


def scd1_upsert_v1_sales_person(spark, base):
    """First load: sellers of the first months, without quota and territory."""
    src = _source(spark, base)
    early, _ = _sold_before(spark, base, FIRST_MONTHS)
    sellers, employees, persons = _staff(src)
    plain = (
        _only(sellers, "BusinessEntityID", early, "SalesPersonID")
        .withColumn("SalesQuota", F.lit(None).cast("decimal(18,2)"))
        .withColumn("TerritoryID", F.lit(None).cast("bigint"))
    )
    territories = assign_keys(dim_territory_v1(spark, base), "territory_id", "territory_key")
    earlier = dim.build_dim_sales_person_v1(plain, employees, persons, territories)
    return _upserted_v1("dim_sales_person", "sales_person_id", "sales_person_key", earlier, dim_sales_person_v1(spark, base))


def scd1_upsert_v1_promotion(spark, base):
    """First load: offers of the first days, under an older name and without discount."""
    src = _source(spark, base)
    _, lines = _sold_before(spark, base, FIRST_DAYS)
    old = (
        _only(src["stage_ofertas"], "SpecialOfferID", lines, "SpecialOfferID")
        .withColumn("Description", F.concat(F.lit("Old "), "Description"))
        .withColumn("DiscountPct", F.lit(None).cast("decimal(18,4)"))
    )
    return _upserted_v1("dim_promotion", "promotion_id", "promotion_key", dim.build_dim_promotion_v1(old), dim_promotion_v1(spark, base))


# Fact

def _orders_and_lines(spark, base):
    src = _source(spark, base)
    return src["stage_pedidos_header"], src["stage_pedidos_detalhe"]


def fact_header_detail(spark, base):
    header, detail = _orders_and_lines(spark, base)
    return header_detail(known_lines(detail), header).select(
        F.col("SalesOrderID").alias("numero_pedido"),
        F.col("SalesOrderDetailID").alias("numero_linha"),
        "ProductID", "OrderQty", "UnitPrice", "UnitPriceDiscount", "SpecialOfferID",
        "CustomerID", "TerritoryID", _maybe("SalesPersonID"),
        fn.date_key(F.col("OrderDate").cast("date")).alias("sk_tempo"),
    )


def _fact(spark, base):
    header, detail = _orders_and_lines(spark, base)
    return build_fact(detail, header, read_dims(warehouse(spark, base)), order=LINE_ORDER)


def fact_dim_lookup(spark, base):
    return _fact(spark, base).select(
        "numero_pedido", "numero_linha", "sk_tempo", "sk_cliente", "sk_produto", "sk_regiao", _maybe("sk_vendedor"), "sk_oferta"
    )


def fact_measures(spark, base):
    return _fact(spark, base).select("numero_pedido", "numero_linha", *measures())


def _old_costs(dims):
    cut = (F.col("custo_unitario") * F.lit("0.9").cast("decimal(2,1)")).cast("decimal(15,4)")
    return {**dims, "dim_produto": dims["dim_produto"].withColumn("custo_unitario", cut)}


def fact_load(spark, base):
    """Orders of the first years were loaded at lower costs; loading all orders leaves them as they are."""
    dims = read_dims(warehouse(spark, base))
    header, detail = _orders_and_lines(spark, base)
    early, early_lines = _sold_before(spark, base, FIRST_YEARS)
    before = written(build_fact(early_lines, early, _old_costs(dims), order=LINE_ORDER), "fact-before", CODEC)
    added = build_fact(detail, header, dims, existing=before, order=LINE_ORDER)
    return before.unionByName(added).select(
        "numero_pedido", "numero_linha", "sk_produto", "valor_liquido", "custo_total", "lucro_bruto", "margem_contribuicao"
    )


def fact_load_idempotent(spark, base):
    """Loading the same orders twice adds nothing the second time."""
    dims = read_dims(warehouse(spark, base))
    header, detail = _orders_and_lines(spark, base)
    loaded = read_fact(warehouse(spark, base))
    again = build_fact(detail, header, dims, existing=loaded, order=LINE_ORDER)
    first = loaded.agg(F.lit(1).alias("carga"), F.count(F.lit(1)).alias("linhas_novas"))
    second = again.agg(F.lit(2).alias("carga"), F.count(F.lit(1)).alias("linhas_novas"))
    return first.unionByName(second)


def load_stats(spark, base):
    return fact_load_stats(read_fact(warehouse(spark, base)))


def fact_sales_v1(spark, base):
    header, detail = _orders_and_lines(spark, base)
    keyed = {
        "dim_cliente": ("sk_cliente", "nk_cliente", dim_customer_v1, "customer_id", []),
        "dim_produto": ("sk_produto", "nk_produto", dim_product_v1, "product_id", ["standard_cost"]),
        "dim_regiao": ("sk_regiao", "nk_regiao", dim_territory_v1, "territory_id", []),
        "dim_vendedor": ("sk_vendedor", "nk_vendedor", dim_sales_person_v1, "sales_person_id", []),
        "dim_oferta": ("sk_oferta", "nk_oferta", dim_promotion_v1, "promotion_id", []),
    }
    dims = {}
    for name, (sk, nk, build, key, keep) in keyed.items():
        batch = build(spark, base).select(F.col(key).alias(nk), *keep)
        dims[name] = written(assign_keys(batch, nk, sk), f"v1-{name}")
    dims["dim_produto"] = dims["dim_produto"].withColumnRenamed("standard_cost", "custo_unitario")
    fact = build_fact_sales_v1(detail, header, dims, order=LINE_ORDER)
    return fact.withColumn("sales_person_key", _maybe("sales_person_key"))


def pipeline_summary(spark, base):
    """A full run with staging: rows of all staging and warehouse tables."""
    src = _source(spark, base)
    root = scratch_path(spark, "pipeline")
    wh = run_pipeline(spark, src, root, stage=True, load_date=LOAD_DATE, order=LINE_ORDER)
    staged = {name: spark.read.parquet(f"{root}/staging/{name}") for name in src.keys()}
    return q.row_counts({**staged, **read_dims(wh), "fato_vendas": read_fact(wh)})


# Checks

def _all_tables(spark, base):
    wh = warehouse(spark, base)
    return {**read_dims(wh), "fato_vendas": read_fact(wh)}


def dq_unique(spark, base):
    tables = _all_tables(spark, base)
    checks = [q.repeated_keys(df, n, [TABLES[n].surrogate]) for n, df in tables.items()]
    checks += [q.repeated_keys(df, n, TABLES[n].natural) for n, df in tables.items()]
    staged = _source(spark, base)["stage_pedidos_detalhe"]
    checks.append(q.repeated_keys(staged, "stage_pedidos_detalhe", ["SalesOrderID", "SalesOrderDetailID"]))
    return q.union_all(checks)


def dq_not_null(spark, base):
    """Required columns, and for contrast the optional references of the fact."""
    tables = _all_tables(spark, base)
    checks = [q.missing_values(df, n, TABLES[n].required) for n, df in tables.items()]
    checks.append(q.missing_values(tables["fato_vendas"], "fato_vendas", ["sk_regiao", "sk_vendedor", "sk_oferta"]))
    return q.union_all(checks)


def dq_foreign_keys(spark, base):
    """Published references, and the staged natural keys against the staged tables they name."""
    tables = _all_tables(spark, base)
    checks = [
        q.orphans(tables[n], n, column, tables[target], target, key)
        for n in tables
        for column, (target, key) in TABLES[n].references.items()
    ]
    src = _source(spark, base)
    checks.append(q.orphans(src["stage_clientes"], "stage_clientes", "StoreID", src["stage_vendedores"], "stage_vendedores", "BusinessEntityID"))
    checks.append(q.orphans(src["stage_vendedores"], "stage_vendedores", "BusinessEntityID", src["stage_pessoas"], "stage_pessoas", "BusinessEntityID"))
    return q.union_all(checks)


def dq_date_range(spark, base):
    """Order dates against the calendar: as loaded, and as they stand in the orders before the shift."""
    wh = warehouse(spark, base)
    days = wh.read("dim_tempo", DIM_TEMPO.schema)
    raw = _source(spark, base).raw("orders").select(
        fn.date_key(F.col("o_orderdate").cast("date")).alias("sk_tempo")
    )
    return q.union_all([
        q.orphans(read_fact(wh), "fato_vendas", "sk_tempo", days, "dim_tempo", "sk_tempo"),
        q.orphans(raw, "orders", "sk_tempo", days, "dim_tempo", "sk_tempo"),
    ])


def dq_numeric_overflow(spark, base):
    """Stored decimals, and margins as they would be with the line amount as the unit price."""
    fact = read_fact(warehouse(spark, base))
    stored = {c: (c, kind) for c, kind in FATO_VENDAS.decimals.items()}
    raw = look_up(
        _source(spark, base).raw("lineitem"), _source(spark, base)["stage_produtos"],
        "l_partkey", "ProductID", ["StandardCost"], ["l_orderkey", "l_linenumber"],
    ).select(
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        (F.col("StandardCost") * F.col("l_quantity").cast("int")).cast("decimal(18,4)").alias("cost"),
    )
    tried = {
        "margem_contribuicao": ("(price - cost) / price * 100", "decimal(5,2)"),
        "preco": ("price", "decimal(6,2)"),
    }
    return q.union_all([q.overflows(fact, "fato_vendas", stored), q.overflows(raw, "lineitem", tried)])


def dq_text_length(spark, base):
    tables = _all_tables(spark, base)
    checks = [q.overlong(df, n, TABLES[n].limits) for n, df in tables.items() if TABLES[n].limits]
    names = _source(spark, base).raw("part")
    return q.union_all([*checks, q.overlong(names, "part", {"p_name": 10, "p_brand": 7})])


def dq_row_counts(spark, base):
    """Published rows beside the rows the staged tables promise."""
    src = _source(spark, base)
    expected = q.union_all([
        q.row_counts({
            "dim_cliente": src["stage_clientes"], "dim_produto": src["stage_produtos"],
            "dim_regiao": src["stage_territorios"], "dim_vendedor": src["stage_vendedores"],
            "dim_oferta": src["stage_ofertas"], "dim_tempo": build_dim_tempo(spark),
        }),
        src["stage_pedidos_detalhe"].agg(
            F.lit("fato_vendas").alias("table"),
            F.countDistinct("SalesOrderID", "SalesOrderDetailID").alias("rows"),
        ),
    ])
    return q.against_expected(
        q.row_counts(_all_tables(spark, base)), expected.withColumnRenamed("rows", "expected")
    )


# Scalar functions

def scalar_nulls(spark, base):
    return _source(spark, base)["stage_clientes"].select(
        "CustomerID",
        F.coalesce("PersonID", "StoreID", F.lit(-1)).alias("primeiro_id"),
        F.nullif(F.col("CustomerID") % 3, F.lit(0).cast("bigint")).cast("double").alias("resto_ou_nulo"),
        F.col("PersonID").isNull().alias("sem_pessoa"),
        F.col("StoreID").isNotNull().alias("com_loja"),
    )


def scalar_case(spark, base):
    lines = _source(spark, base).raw("lineitem")
    pct = F.col("l_discount").cast("decimal(4,2)") * 500
    flag = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).when(F.col("l_returnflag") == "R", 3)
    return (
        lines.groupBy(
            fn.discount_band(pct).alias("faixa"),
            flag.alias("devolucao"),
            fn.abc_class(F.col("l_quantity") * 2).alias("classe"),
            fn.customer_class(F.col("l_extendedprice")).alias("segmento"),
        ).agg(F.count(F.lit(1)).alias("linhas"))
    )


def scalar_numeric(spark, base):
    qty, price = F.col("l_quantity").cast("int"), F.col("l_extendedprice").cast("decimal(15,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    return _source(spark, base).raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(price * (F.lit(1) - discount) * F.lit("0.5").cast("decimal(2,1)"), 2).cast("decimal(18,2)").alias("metade_liquida"),
        F.round(-price * discount * F.lit("0.05").cast("decimal(3,2)"), 2).cast("decimal(18,2)").alias("negativo"),
        (price + qty - discount).cast("decimal(18,2)").alias("soma"),
        fn.per(price, qty).alias("por_unidade"),
        (discount * 100).cast("decimal(5,2)").alias("desconto_pct"),
        F.expr("l_partkey div cast(l_quantity as int)").alias("divisao_inteira"),
    )


def scalar_strings(spark, base):
    return _source(spark, base).raw("part").select(
        "p_partkey",
        fn.full_name(F.nullif("p_type", F.lit("ECONOMY")), F.col("p_name"), "Produto ", F.col("p_partkey")).alias("nome"),
        fn.seller_code(F.col("p_partkey") * 1000).alias("codigo"),
        F.lpad("p_name", 12, ".").alias("nome_12"),
        F.col("p_name").like("%ring%").alias("tem_ring"),
        F.col("p_name").like("%Ring%").alias("tem_ring_maiusculo"),
        F.length("p_name").alias("tamanho"),
        F.col("p_partkey").cast("string").alias("texto"),
    )


def scalar_dates(spark, base):
    day = F.col("OrderDate").cast("date")
    return _source(spark, base)["stage_pedidos_header"].select(
        "SalesOrderID",
        day.alias("dia"),
        F.year(day).alias("ano"), F.quarter(day).alias("trimestre"), F.month(day).alias("mes"),
        F.dayofmonth(day).alias("dia_mes"), F.weekofyear(day).alias("semana"),
        fn.day_of_week(day).alias("dia_semana"),
        fn.date_key(day).alias("chave"),
        F.date_format(day, "MMMM").alias("nome_mes"),
        F.date_format(day, "EEEE").alias("nome_dia"),
        fn.week_position(F.date_format(day, "EEEE")).alias("posicao"),
        F.expr("date_add(cast(OrderDate as date), 1)").alias("dia_seguinte"),
    )


def scalar_casts(spark, base):
    price = F.col("l_extendedprice").cast("decimal(15,4)")
    return _source(spark, base).raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("int").alias("inteiro"),
        F.col("l_linenumber").cast("smallint").alias("curto"),
        F.col("l_shipdate").cast("date").alias("dia"),
        F.col("l_partkey").cast("string").alias("texto"),
        price.alias("numerico_15_4"),
        (price * F.lit("0.125").cast("decimal(4,3)")).cast("decimal(18,2)").alias("numerico_18_2"),
        F.col("l_partkey").cast("string").cast("int").alias("texto_inteiro"),
    )


def build_queries() -> dict[str, Query]:
    plain: dict[str, Query] = {
        "stage_extract": stage_extract,
        "stage_row_counts": stage_row_counts,
        "infer_column_types": _inferred,
        "infer_column_types_strict_null": partial(_inferred, null_as_text=True, date_as_timestamp=True),
        "infer_column_types_text": infer_text,
        "stage_typed_orders": stage_typed_orders,
        "calendar_series": calendar_series,
        "dim_tempo": dim_tempo,
        "dim_date_v1": dim_date_v1,
        "dim_cliente": dim_cliente,
        "dim_customer_v1": dim_customer_v1,
        "dim_produto": dim_produto,
        "dim_product_v1": dim_product_v1,
        "dim_regiao": dim_regiao,
        "dim_territory_v1": dim_territory_v1,
        "dim_vendedor": dim_vendedor,
        "dim_sales_person_v1": dim_sales_person_v1,
        "dim_oferta": dim_oferta,
        "dim_promotion_v1": dim_promotion_v1,
        "surrogate_key_assign": surrogate_key_assign,
        "scd1_upsert_cliente": scd1_upsert_cliente,
        "scd1_upsert_produto": scd1_upsert_produto,
        "scd1_upsert_regiao": scd1_upsert_regiao,
        "scd1_upsert_vendedor": scd1_upsert_vendedor,
        "scd1_upsert_oferta": scd1_upsert_oferta,
        "scd1_upsert_v1": scd1_upsert_v1,
        "scd1_upsert_v1_customer": scd1_upsert_v1_customer,
        "scd1_upsert_v1_territory": scd1_upsert_v1_territory,
        "scd1_upsert_v1_sales_person": scd1_upsert_v1_sales_person,
        "scd1_upsert_v1_promotion": scd1_upsert_v1_promotion,
        "fact_header_detail": fact_header_detail,
        "fact_dim_lookup": fact_dim_lookup,
        "fact_measures": fact_measures,
        "fact_load": fact_load,
        "fact_load_idempotent": fact_load_idempotent,
        "fact_load_stats": load_stats,
        "fact_sales_v1": fact_sales_v1,
        "pipeline_summary": pipeline_summary,
        "dq_unique": dq_unique,
        "dq_not_null": dq_not_null,
        "dq_foreign_keys": dq_foreign_keys,
        "dq_date_range": dq_date_range,
        "dq_numeric_overflow": dq_numeric_overflow,
        "dq_text_length": dq_text_length,
        "dq_row_counts": dq_row_counts,
        "scalar_nulls": scalar_nulls,
        "scalar_case": scalar_case,
        "scalar_numeric": scalar_numeric,
        "scalar_strings": scalar_strings,
        "scalar_dates": scalar_dates,
        "scalar_casts": scalar_casts,
    }
    reports = {name: partial(_published, report) for name, report in {**KPIS, **HEADLINES}.items()}
    return {name: _portable_query(query) for name, query in {**plain, **reports}.items()}


def _portable_query(query: Query) -> Query:
    return lambda spark, base: portable(query(spark, base))
