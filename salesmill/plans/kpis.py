"""The ten KPI reports over the published fact and dimensions.

Descending sorts put NULL first, and the group key breaks ties. Shares divide by the total of the
joined rows, which is the total of the report's own groups: the fact is read once. Reports that count
orders and customers first sum the lines of an order, so that only orders are counted.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmill.functions import columns as fn
from salesmill.operators.prefix import running_total_desc
from salesmill.schemas import FACT_PARTITION
from salesmill.session import written

Dims = Mapping[str, DataFrame]


def _down(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def _orders() -> Column:
    return F.countDistinct("numero_pedido")


def _total_of(groups_column: str) -> Column:
    """Total over a report's groups: a row for each member of a dimension's attribute, not for each line."""
    return F.sum(groups_column).over(Window.partitionBy())


def _by_order(joined: DataFrame, keys: list[str], *amounts: str, means: tuple[str, ...] = ()) -> DataFrame:
    """Lines summed by group, order and customer; for each of `means` also its sum and count."""
    sums = [F.sum(a).alias(a) for a in amounts]
    sums += [x for m in means for x in (F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n"))]
    return joined.groupBy(*keys, "numero_pedido", "sk_cliente").agg(*sums)


def _groups(by_order: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Rows of `_by_order` summed by group, with `_orders` and `_customers`.

    Customers are counted by exact bitmaps over their surrogate keys, which are dense: a bit for each key, a
    bitmap for each 32,768 of them. So one group and bitmap at a time are summed, and no row is copied as
    several distinct counts would. `more` are aggregates that can be summed up again.
    """
    key = F.col("sk_cliente")
    blocks = by_order.groupBy(*keys, F.bitmap_bucket_number(key).alias("_block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("_bits"), F.count("numero_pedido").alias("_orders"), *more
    )
    kept = [c for c in blocks.columns if c not in (*keys, "_block", "_bits")]
    return blocks.groupBy(*keys).agg(
        F.sum(F.when(F.col("_block").isNotNull(), F.bitmap_count("_bits")).otherwise(0)).alias("_customers"),
        *[F.sum(c).alias(c) for c in kept],
    )


def _mean_in(name: str) -> Column:
    return fn.per(F.col(f"{name}_sum"), F.col(f"{name}_n"))


def newest_months(fact: DataFrame, months: int) -> int | None:
    """The first of the newest `months` values of the partition column.

    Read from the names of the fact's folders, so nothing is scanned; a fact that is not in files is asked.
    """
    found = {int(m) for f in fact.inputFiles() for m in re.findall(rf"/{FACT_PARTITION}=(\d+)/", f)}
    if not found:
        newest = fact.select(FACT_PARTITION).distinct().orderBy(F.col(FACT_PARTITION).desc_nulls_last()).limit(months)
        found = {r[0] for r in newest.collect() if r[0] is not None}
    return min(sorted(found)[-months:], default=None)


def _named_alike(products: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(sk_produto, _group) and (_group, names): one number for all products of the same names.

    Counting orders by that number moves two numbers a line instead of names.
    """
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    groups = products.groupBy(*keys).agg(F.min("sk_produto").alias("_group"))
    renamed = groups.select("_group", *[F.col(k).alias(f"_{k}") for k in keys])
    return products.join(renamed, same).select("sk_produto", "_group"), groups


def kpi1_product_margin(fact: DataFrame, dims: Dims) -> DataFrame:
    keys = ["categoria_produto", "subcategoria_produto", "nome_produto"]
    numbers, names = _named_alike(dims["dim_produto"].select("sk_produto", *keys), keys)
    return (
        fact.where("valor_liquido > 0")
        .join(numbers, "sk_produto")
        .groupBy("_group")
        .agg(
            _orders().alias("total_pedidos"),
            F.sum("quantidade_vendida").alias("quantidade_total_vendida"),
            F.sum("valor_liquido").cast("decimal(28,4)").alias("receita_liquida"),
            F.sum("lucro_bruto").cast("decimal(28,4)").alias("lucro_bruto"),
            fn.mean("margem_contribuicao").alias("margem_contribuicao_media_pct"),
        )
        .where("receita_liquida > 1000")
        .withColumn("rentabilidade_pct", fn.percent(F.col("lucro_bruto"), F.col("receita_liquida")))
        .join(names, "_group")
        .select(
            *keys, "total_pedidos", "quantidade_total_vendida", "receita_liquida", "lucro_bruto",
            "margem_contribuicao_media_pct", "rentabilidade_pct",
        )
        .orderBy(_down("margem_contribuicao_media_pct"), *keys)
        .limit(20)
    )


def kpi2_discount_bands(fact: DataFrame, dims: Dims | None = None) -> DataFrame:
    return (
        fact.groupBy(fn.discount_band(F.col("percentual_desconto")).alias("faixa_desconto"))
        .agg(
            F.count(F.lit(1)).alias("numero_transacoes"),
            F.sum("quantidade_vendida").alias("unidades_vendidas"),
            fn.money(F.sum("valor_bruto")).alias("valor_bruto_total"),
            fn.money(F.sum("valor_desconto")).alias("desconto_concedido"),
            fn.money(F.sum("valor_liquido")).alias("receita_liquida"),
            fn.money(F.sum("lucro_bruto")).alias("lucro_total"),
            fn.mean("margem_contribuicao").alias("margem_media_pct"),
            fn.percent(F.sum("valor_desconto"), F.sum("valor_bruto")).alias("taxa_desconto_media_pct"),
        )
        .orderBy("faixa_desconto")
    )


def kpi3_seller_quota(fact: DataFrame, dims: Dims) -> DataFrame:
    """The whole yearly quota is set against each territory a seller sold in."""
    sellers = dims["dim_vendedor"].where("meta_anual > 0").select("sk_vendedor", "nome_vendedor", "meta_anual")
    regions = dims["dim_regiao"].select("sk_regiao", "grupo_regional", "nome_territorio")
    keys = ["grupo_regional", "nome_territorio", "nome_vendedor", "meta_anual"]
    net = F.sum("valor_liquido")
    return (
        fact.join(sellers, "sk_vendedor")
        .join(regions, "sk_regiao")
        .groupBy(*keys)
        .agg(
            _orders().alias("total_vendas"),
            fn.money(net).alias("receita_gerada"),
            fn.money(F.sum("lucro_bruto")).alias("lucro_gerado"),
            fn.percent(net, F.col("meta_anual")).alias("percentual_meta_atingido"),
            fn.per(net, _orders()).alias("ticket_medio_vendedor"),
            fn.mean("margem_contribuicao").alias("margem_media_pct"),
        )
        .orderBy(_down("receita_gerada"), *keys)
        .limit(15)
    )


def kpi4_monthly_trend(fact: DataFrame, dims: Dims) -> DataFrame:
    """The newest twelve months that have sales; the fact's folders of older months are not read."""
    since = newest_months(fact, 12)
    days = dims["dim_tempo"].select("sk_tempo", "ano", "mes", "nome_mes")
    net, profit, orders = F.col("valor_liquido"), F.col("lucro_bruto"), F.col("_orders")
    keys = ["ano", "mes", "nome_mes"]
    joined = fact.where(F.col(FACT_PARTITION) >= F.lit(since)).join(days, "sk_tempo")
    amounts = ("valor_liquido", "lucro_bruto")
    return (
        _groups(_by_order(joined, keys, *amounts), keys, *[F.sum(a).alias(a) for a in amounts])
        .select(
            *keys,
            fn.money(net).alias("receita_mensal"),
            fn.money(profit).alias("lucro_mensal"),
            fn.percent(profit, net).alias("margem_lucro_pct"),
            orders.alias("pedidos_mes"),
            F.col("_customers").alias("clientes_unicos"),
            fn.per(net, orders).alias("ticket_medio"),
        )
        .orderBy(_down("ano"), _down("mes"))
        .limit(12)
    )


def product_revenue(fact: DataFrame, dims: Dims) -> DataFrame:
    """Revenue and units of every product of the dimension that was sold."""
    per_product = fact.groupBy("sk_produto").agg(
        F.sum("valor_liquido").cast("decimal(28,4)").alias("receita_produto"),
        F.sum("quantidade_vendida").alias("quantidade_vendida"),
    )
    return per_product.join(dims["dim_produto"].select("sk_produto"), "sk_produto", "left_semi")


def _abc_columns(ranked: DataFrame, dims: Dims) -> DataFrame:
    names = dims["dim_produto"].select("sk_produto", "nome_produto", "categoria_produto")
    share = fn.percent(F.col("receita_acumulada"), F.col("receita_total"))
    return ranked.join(names, "sk_produto").withColumn("percentual_acumulado", share)


def _abc_report(curve: DataFrame) -> DataFrame:
    return curve.select(
        "nome_produto",
        "categoria_produto",
        fn.money(F.col("receita_produto")).alias("receita"),
        "quantidade_vendida",
        "percentual_acumulado",
        fn.abc_class(F.col("percentual_acumulado")).alias("classificacao_abc"),
    )


def _total(revenue: DataFrame) -> Column:
    return revenue.agg(F.sum("receita_produto")).scalar()


def kpi5_abc_top30(fact: DataFrame, dims: Dims) -> DataFrame:
    """First 30 rows of the curve. They have at most 30 distinct revenues, so the running total
    needs only the 30 highest distinct revenues, each with the sum of all products that have it."""
    revenue = product_revenue(fact, dims)
    top = revenue.orderBy(F.col("receita_produto").desc(), "sk_produto").limit(30)
    highest = (
        revenue.groupBy("receita_produto")
        .agg(F.sum("receita_produto").alias("_part"))
        .orderBy(F.col("receita_produto").desc())
        .limit(30)
    )
    upto = Window.orderBy(F.col("receita_produto").desc())
    sums = highest.select("receita_produto", F.sum("_part").over(upto).alias("receita_acumulada"))
    ranked = top.join(F.broadcast(sums), "receita_produto").withColumn("receita_total", _total(revenue))
    curve = _abc_columns(ranked, dims).orderBy(F.col("receita_produto").desc(), "sk_produto")
    return _abc_report(curve)


def kpi5_abc_all(fact: DataFrame, dims: Dims, ranges: int | None = None) -> DataFrame:
    """The whole curve, one row per product, unordered.

    Total, ranges, offsets and rows all need the products' revenues, so these are written once, a row per
    product, and the fact is read once.
    """
    revenue = written(product_revenue(fact, dims), "abc-revenue")
    ranked = running_total_desc(revenue, "receita_produto", "receita_acumulada", ranges)
    return _abc_report(_abc_columns(ranked.withColumn("receita_total", _total(revenue)), dims))


def kpi6_geography(fact: DataFrame, dims: Dims) -> DataFrame:
    keys = ["continente", "grupo_regional", "nome_territorio"]
    regions = dims["dim_regiao"].select("sk_regiao", *keys)
    net, orders = F.col("valor_liquido"), F.col("_orders")
    amounts = ("quantidade_vendida", "valor_liquido", "lucro_bruto")
    by_order = _by_order(fact.join(regions, "sk_regiao"), keys, *amounts, means=("margem_contribuicao",))
    sums = [F.sum(c).alias(c) for c in (*amounts, "margem_contribuicao_sum", "margem_contribuicao_n")]
    return (
        _groups(by_order, keys, *sums)
        .select(
            *keys,
            F.col("_customers").alias("total_clientes"),
            orders.alias("total_pedidos"),
            F.col("quantidade_vendida").alias("unidades_vendidas"),
            fn.money(net).alias("receita_total"),
            fn.money(F.col("lucro_bruto")).alias("lucro_total"),
            _mean_in("margem_contribuicao").alias("margem_media_pct"),
            fn.percent(net, _total_of("valor_liquido")).alias("participacao_receita_pct"),
            fn.per(net, orders).alias("ticket_medio_regiao"),
        )
        .orderBy(_down("receita_total"), *keys)
        .limit(15)
    )


def kpi7_category(fact: DataFrame, dims: Dims) -> DataFrame:
    """Turnover per product divides whole numbers and drops the remainder.

    Lines are summed by order, which also gathers the order's products. These are then counted by exact
    bitmaps over their surrogate keys; an order's sums go with its first product.
    """
    products = dims["dim_produto"].select("sk_produto", "categoria_produto")
    net, profit, units, count = (F.col(c) for c in ("valor_liquido", "lucro_bruto", "quantidade_vendida", "total_produtos_categoria"))
    amounts = ("quantidade_vendida", "valor_liquido", "custo_total", "lucro_bruto")
    sums = [F.sum(a).alias(a) for a in amounts]
    by_order = fact.join(products, "sk_produto").groupBy("categoria_produto", "numero_pedido").agg(
        F.collect_set("sk_produto").alias("_sold"), *sums)
    key, first = F.col("_product"), F.col("_at") == 0
    blocks = by_order.select("*", F.posexplode("_sold").alias("_at", "_product")).groupBy(
        "categoria_produto", F.bitmap_bucket_number(key).alias("_block")
    ).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("_bits"), F.count(F.when(first, F.col("numero_pedido"))).alias("_orders"),
        *[F.sum(F.when(first, F.col(a))).alias(a) for a in amounts],
    )
    return (
        blocks.groupBy("categoria_produto")
        .agg(F.sum(F.bitmap_count("_bits")).alias("total_produtos_categoria"), F.sum("_orders").alias("_orders"), *sums)
        .select(
            "categoria_produto",
            "total_produtos_categoria",
            F.col("_orders").alias("total_transacoes"),
            units.alias("unidades_vendidas"),
            fn.money(net).alias("receita_categoria"),
            fn.money(F.col("custo_total")).alias("custo_categoria"),
            fn.money(profit).alias("lucro_categoria"),
            fn.percent(profit, net).alias("margem_lucro_pct"),
            fn.per(net, count).alias("receita_media_produto"),
            F.expr("quantidade_vendida div nullif(total_produtos_categoria, 0)").alias("giro_medio_produto"),
            fn.percent(net, _total_of("valor_liquido")).alias("participacao_receita_total_pct"),
        )
        .orderBy(_down("receita_categoria"), "categoria_produto")
    )


def kpi8_customer_value(fact: DataFrame, dims: Dims) -> DataFrame:
    customers = dims["dim_cliente"].select("sk_cliente", "tipo_cliente", "segmento")
    keys = ["tipo_cliente", "segmento"]
    by_order = _by_order(fact.join(customers, "sk_cliente"), keys, "lucro_bruto", means=("valor_liquido",))
    groups = _groups(by_order, keys, *[F.sum(c).alias(c) for c in ("lucro_bruto", "valor_liquido_sum", "valor_liquido_n")])
    clients, net = F.col("_customers"), F.col("valor_liquido_sum")
    return groups.select(
        "tipo_cliente",
        "segmento",
        clients.alias("total_clientes"),
        fn.money(net).alias("receita_total"),
        fn.money(F.col("lucro_bruto")).alias("lucro_total"),
        fn.per(net, clients).alias("receita_media_por_cliente"),
        fn.per(F.col("lucro_bruto"), clients).alias("lucro_medio_por_cliente"),
        fn.per(F.col("_orders"), clients).alias("pedidos_por_cliente"),
        _mean_in("valor_liquido").alias("ticket_medio"),
        fn.customer_class(fn.quotient(net, clients)).alias("categoria_segmento"),
    ).orderBy(_down("receita_total"), "tipo_cliente", "segmento")


def kpi9_seasonality(fact: DataFrame, dims: Dims) -> DataFrame:
    keys = ["trimestre", "nome_dia_semana", "eh_fim_semana"]
    days = dims["dim_tempo"].select("sk_tempo", *keys)
    return (
        fact.join(days, "sk_tempo")
        .groupBy(*keys)
        .agg(
            _orders().alias("total_vendas"),
            F.sum("quantidade_vendida").alias("unidades_vendidas"),
            fn.money(F.sum("valor_liquido")).alias("receita_total"),
            fn.mean("valor_liquido").alias("valor_medio_transacao"),
            fn.money(F.sum("lucro_bruto")).alias("lucro_total"),
            fn.mean("margem_contribuicao").alias("margem_media_pct"),
        )
        .orderBy("trimestre", fn.week_position(F.col("nome_dia_semana")).asc_nulls_last())
    )


def kpi10_top_products(fact: DataFrame, dims: Dims) -> DataFrame:
    """Products of one name and category count as one."""
    keys = ["categoria_produto", "nome_produto"]
    numbers, names = _named_alike(dims["dim_produto"].select("sk_produto", *keys), keys)
    net, units = F.sum("valor_liquido"), F.sum("quantidade_vendida")
    return (
        fact.join(numbers, "sk_produto")
        .groupBy("_group")
        .agg(
            _orders().alias("total_pedidos"),
            units.alias("quantidade_vendida"),
            fn.money(net).alias("receita_total"),
            fn.money(F.sum("lucro_bruto")).alias("lucro_total"),
            fn.mean("margem_contribuicao").alias("margem_media_pct"),
            fn.per(net, units).alias("preco_medio_unitario"),
        )
        .join(names, "_group")
        .select(
            *keys, "total_pedidos", "quantidade_vendida", "receita_total", "lucro_total", "margem_media_pct",
            "preco_medio_unitario",
        )
        .orderBy(_down("receita_total"), *keys)
        .limit(10)
    )


KPIS = {
    "kpi1_product_margin": kpi1_product_margin,
    "kpi2_discount_bands": kpi2_discount_bands,
    "kpi3_seller_quota": kpi3_seller_quota,
    "kpi4_monthly_trend": kpi4_monthly_trend,
    "kpi5_abc_top30": kpi5_abc_top30,
    "kpi5_abc_all": kpi5_abc_all,
    "kpi6_geography": kpi6_geography,
    "kpi7_category": kpi7_category,
    "kpi8_customer_value": kpi8_customer_value,
    "kpi9_seasonality": kpi9_seasonality,
    "kpi10_top_products": kpi10_top_products,
}


def show_report(name: str, report: DataFrame, page: int = 1000) -> bool:
    """Print one KPI report with its number of rows; says so if it has none.

    All rows are printed, a partition at a time, so a report of any length passes through the driver
    in parts; the column names are repeated every `page` rows.
    """
    total = 0
    for row in report.toLocalIterator(prefetchPartitions=True):
        if total == 0:
            print(name)
        if total % page == 0:
            print(" | ".join(report.columns))
        print(" | ".join("NULL" if v is None else str(v) for v in row))
        total += 1
    print(f"{total} rows" if total else f"{name}: no rows")
    return total > 0
