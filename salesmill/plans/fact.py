"""The sales fact at order-line grain.

Each look-up is made at the grain its key belongs to: customer, territory and seller on the order
header (several times fewer rows), product and offer on the line. The lines are then joined to the
headers once. Lines already loaded are dropped before any look-up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from salesmill.functions.columns import date_key
from salesmill.operators.lookup import look_up
from salesmill.operators.upsert import first_per_key, insert_if_absent
from salesmill.schemas import FACT_PARTITION

LINE_KEY = ("SalesOrderID", "SalesOrderDetailID")

PRICE, DISCOUNT = "decimal(15,4)", "decimal(9,4)"
# Widest value the stored (18,4) amounts can hold, with the full scale of price x quantity x discount.
_EXACT = "decimal(22,8)"
_AMOUNT, _PERCENT = "decimal(18,4)", "decimal(5,2)"

Dims = Mapping[str, DataFrame]


def month_of_sale() -> Column:
    return F.expr("sk_tempo div 100").cast("int")


def known_lines(detail: DataFrame) -> DataFrame:
    """Lines that name their order and their number in it, both as BIGINT like the stored keys."""
    named = detail.where("SalesOrderID is not null and SalesOrderDetailID is not null")
    return named.withColumns({k: F.col(k).cast("bigint") for k in LINE_KEY})


def header_detail(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with what is known of their orders; lines without an order are dropped."""
    return lines.join(orders.where("SalesOrderID is not null"), "SalesOrderID")


def order_keys(header: DataFrame, dims: Dims) -> DataFrame:
    """One row per order: date key and the surrogate keys of customer, territory and seller."""
    wanted = header.where("SalesOrderID is not null").select(
        "SalesOrderID", "OrderDate", "CustomerID", "TerritoryID", "SalesPersonID"
    )
    orders = first_per_key(wanted, ["SalesOrderID"])
    by_order = ["SalesOrderID"]
    orders = look_up(orders, dims["dim_cliente"], "CustomerID", "nk_cliente", ["sk_cliente"], by_order)
    orders = look_up(orders, dims["dim_regiao"], "TerritoryID", "nk_regiao", ["sk_regiao"], by_order)
    orders = look_up(orders, dims["dim_vendedor"], "SalesPersonID", "nk_vendedor", ["sk_vendedor"], by_order)
    return orders.select(
        "SalesOrderID",
        date_key(F.col("OrderDate").cast("date")).alias("sk_tempo"),
        "sk_cliente", "sk_regiao", "sk_vendedor",
    )


def line_keys(detail: DataFrame, dims: Dims) -> DataFrame:
    """Lines with the surrogate keys of product and offer, and the product's present cost."""
    lines = look_up(
        detail, dims["dim_produto"], "ProductID", "nk_produto", ["sk_produto", "custo_unitario"], list(LINE_KEY)
    )
    return look_up(lines, dims["dim_oferta"], "SpecialOfferID", "nk_oferta", ["sk_oferta"], list(LINE_KEY))


def measures(price_type: str = PRICE) -> dict[str, Column]:
    """The nine measures. Every product is exact (8 places) until the one rounding to its stored type."""
    quantity = F.col("OrderQty").cast("int")
    price = F.col("UnitPrice").cast(price_type)
    discount = F.coalesce(F.col("UnitPriceDiscount"), F.lit(0)).cast(DISCOUNT)
    cost = F.coalesce(F.col("custo_unitario"), F.lit(0)).cast(PRICE) * quantity
    gross = price * quantity
    net = gross * (F.lit(1) - discount)
    profit = net - cost
    margin = profit.cast(_EXACT) / net.cast(_EXACT) * 100
    return {
        "quantidade_vendida": quantity,
        "valor_unitario": price,
        "valor_bruto": gross.cast(_AMOUNT),
        "valor_desconto": (gross * discount).cast(_AMOUNT),
        "valor_liquido": net.cast(_AMOUNT),
        "custo_total": cost.cast(_AMOUNT),
        "lucro_bruto": profit.cast(_AMOUNT),
        "percentual_desconto": (discount * 100).cast(_PERCENT),
        "margem_contribuicao": F.when(net > 0, margin.cast(_PERCENT)).otherwise(F.lit(0).cast(_PERCENT)),
    }


def build_fact(
    detail: DataFrame,
    header: DataFrame,
    dims: Dims,
    existing: DataFrame | None = None,
    order: Sequence[str] | None = None,
    price_type: str = PRICE,
    months: bool = False,
) -> DataFrame:
    """The fact rows to add: one per (order, line), none that `existing` already holds.

    With `months` rows are rebalanced by month, before the measures are computed: what they are computed from
    is half as wide.
    """
    lines = known_lines(detail)
    loaded = None
    if existing is not None:
        loaded = existing.select(
            F.col("numero_pedido").alias("SalesOrderID"), F.col("numero_linha").alias("SalesOrderDetailID")
        )
    fresh = insert_if_absent(loaded, lines, LINE_KEY, order, complete=True)
    joined = header_detail(line_keys(fresh, dims), order_keys(header, dims))
    if months:
        joined = joined.select(
            "sk_tempo", "sk_cliente", "sk_produto", "sk_regiao", "sk_vendedor", "sk_oferta", *LINE_KEY,
            "OrderQty", "UnitPrice", "UnitPriceDiscount", "custo_unitario", month_of_sale().alias(FACT_PARTITION),
        ).hint("rebalance", F.col(FACT_PARTITION))
    return joined.select(
        "sk_tempo", "sk_cliente", "sk_produto", "sk_regiao", "sk_vendedor", "sk_oferta",
        F.col("SalesOrderID").cast("bigint").alias("numero_pedido"),
        F.col("SalesOrderDetailID").cast("bigint").alias("numero_linha"),
        *[c.alias(name) for name, c in measures(price_type).items()],
    )


def fact_load_stats(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_vendas"),
        F.sum("valor_liquido").cast("decimal(28,4)").alias("receita"),
        F.sum("lucro_bruto").cast("decimal(28,4)").alias("lucro"),
    )


# Column names of the older English fact, and what they hold here.
V1_FACT_COLUMNS = {
    "date_key": "sk_tempo",
    "customer_key": "sk_cliente",
    "product_key": "sk_produto",
    "territory_key": "sk_regiao",
    "sales_person_key": "sk_vendedor",
    "promotion_key": "sk_oferta",
    "order_id": "numero_pedido",
    "order_line": "numero_linha",
    "quantity": "quantidade_vendida",
    "unit_price": "valor_unitario",
    "extended_price": "valor_bruto",
    "discount_amount": "valor_desconto",
    "total_amount": "valor_liquido",
    "cost_amount": "custo_total",
    "margin_amount": "lucro_bruto",
}


def build_fact_sales_v1(
    detail: DataFrame, header: DataFrame, dims: Dims, order: Sequence[str] | None = None
) -> DataFrame:
    """Older fact: the price is rounded to cents before it is multiplied, and seven measures are kept."""
    fact = build_fact(detail, header, dims, order=order, price_type="decimal(12,2)")
    return fact.select(*[F.col(old).alias(new) for new, old in V1_FACT_COLUMNS.items()])
