"""Single findings over the fact: each is one aggregate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from salesmill.functions import columns as fn
from salesmill.plans.kpis import kpi10_top_products

Dims = Mapping[str, DataFrame]


def _share(condition: Column) -> Column:
    """Percentage of rows that meet the condition, to one place."""
    hits = F.count(F.when(condition, 1))
    return F.round(fn.quotient(hits, F.count(F.lit(1))) * 100, 1).cast("decimal(5,1)")


def top_product(fact: DataFrame, dims: Dims) -> DataFrame:
    return kpi10_top_products(fact, dims).limit(1).select("categoria_produto", "nome_produto", "receita_total")


def no_seller_share(fact: DataFrame, dims: Dims | None = None) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("vendas"),
        F.count(F.when(F.col("sk_vendedor").isNull(), 1)).alias("sem_vendedor"),
        _share(F.col("sk_vendedor").isNull()).alias("sem_vendedor_pct"),
    )


def negative_margin_share(fact: DataFrame, dims: Dims | None = None) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("vendas"),
        F.count(F.when(F.col("margem_contribuicao") < 0, 1)).alias("margem_negativa"),
        _share(F.col("margem_contribuicao") < 0).alias("margem_negativa_pct"),
    )


def best_subcategory(fact: DataFrame, dims: Dims) -> DataFrame:
    """No distinct count is needed, so lines are summed per product before the products are joined."""
    per_product = fact.groupBy("sk_produto").agg(
        F.sum("valor_liquido").alias("_net"), F.sum("lucro_bruto").alias("_profit")
    )
    products = dims["dim_produto"].select("sk_produto", "subcategoria_produto")
    return (
        per_product.join(products, "sk_produto")
        .groupBy("subcategoria_produto")
        .agg(F.sum("_net").alias("_net"), F.sum("_profit").alias("_profit"))
        .select(
            "subcategoria_produto",
            fn.money(F.col("_net")).alias("receita"),
            fn.money(F.col("_profit")).alias("lucro"),
            fn.percent(F.col("_profit"), F.col("_net")).alias("margem_pct"),
        )
        .orderBy(F.col("margem_pct").desc_nulls_last(), "subcategoria_produto")
        .limit(1)
    )


def discount_over_10(fact: DataFrame, dims: Dims | None = None) -> DataFrame:
    net, profit = F.sum("valor_liquido"), F.sum("lucro_bruto")
    return (
        fact.groupBy((F.col("percentual_desconto") > 10).alias("desconto_acima_10"))
        .agg(
            F.count(F.lit(1)).alias("vendas"),
            fn.money(net).alias("receita"),
            fn.money(profit).alias("lucro"),
            fn.percent(profit, net).alias("margem_pct"),
        )
        .orderBy("desconto_acima_10")
    )


def totals(fact: DataFrame, dims: Dims | None = None) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("vendas"),
        F.min("sk_tempo").cast("bigint").alias("primeira_data"),
        F.max("sk_tempo").cast("bigint").alias("ultima_data"),
        fn.money(F.sum("valor_liquido")).alias("receita"),
    )


HEADLINES = {
    "headline_top_product": top_product,
    "headline_no_seller_share": no_seller_share,
    "headline_negative_margin_share": negative_margin_share,
    "headline_best_subcategory": best_subcategory,
    "headline_discount_over_10": discount_over_10,
    "headline_totals": totals,
}
