"""Rows, values and hand-made tables shared by the warehouse tests."""

from __future__ import annotations

import datetime
from decimal import Decimal

from salesmill.schemas import TABLES, conform

SMALL = "/root/testdata/sf0.001"


def dec(text) -> Decimal:
    return Decimal(str(text))


def day(text) -> datetime.datetime:
    return datetime.datetime.fromisoformat(text)


def rows(df, *keys) -> list[dict]:
    found = [r.asDict() for r in df.collect()]
    return sorted(found, key=lambda r: [str(r[k]) for k in keys]) if keys else found


def values(df, column) -> list:
    return [r[column] for r in df.collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Staged tables by hand: only the columns the load reads.

SCHEMAS = {
    "stage_clientes": "CustomerID bigint, PersonID bigint, StoreID bigint",
    "stage_pessoas": "BusinessEntityID bigint, FirstName string, LastName string",
    "stage_produtos": (
        "ProductID bigint, Name string, ProductNumber string, ProductLine string, Color string, Size string, "
        "Weight decimal(10,2), StandardCost decimal(15,4), ListPrice decimal(15,4), SellStartDate timestamp_ntz, "
        "SellEndDate timestamp_ntz, ProductSubcategoryID bigint, ProductModelID bigint"
    ),
    "stage_subcategorias": "ProductSubcategoryID bigint, ProductCategoryID bigint, Name string",
    "stage_categorias": "ProductCategoryID bigint, Name string",
    "stage_territorios": "TerritoryID bigint, Name string, CountryRegionCode string, `Group` string",
    "stage_vendedores": "BusinessEntityID bigint, TerritoryID bigint, SalesQuota decimal(18,2), CommissionPct decimal(18,4)",
    "stage_funcionarios": "BusinessEntityID bigint, HireDate date",
    "stage_ofertas": (
        "SpecialOfferID bigint, Description string, Type string, DiscountPct decimal(18,4), StartDate timestamp_ntz, "
        "EndDate timestamp_ntz, MinQty int, MaxQty int"
    ),
    "stage_pedidos_header": (
        "SalesOrderID bigint, OrderDate timestamp_ntz, CustomerID bigint, TerritoryID bigint, SalesPersonID bigint"
    ),
    "stage_pedidos_detalhe": (
        "SalesOrderID bigint, SalesOrderDetailID bigint, OrderQty int, ProductID bigint, SpecialOfferID bigint, "
        "UnitPrice decimal(15,4), UnitPriceDiscount decimal(18,4)"
    ),
}

MONDAY = day("2013-05-06")
ROWS = {
    "stage_clientes": [(1, 100, None), (2, None, 9), (3, None, None)],
    "stage_pessoas": [(100, "Ana", "Lima"), (200, "Rui", "Paz")],
    "stage_produtos": [
        (10, "Bike", "B-1", "R", "Red", "M", None, dec(60), dec(100), day("2012-01-01"), None, 1, 5),
        (11, "Cap", "C-1", None, None, None, None, dec(4), dec(10), None, day("2014-01-01"), None, None),
    ],
    "stage_subcategorias": [(1, 7, "Road")],
    "stage_categorias": [(7, "Bikes")],
    "stage_territorios": [(1, "Northwest", "US", "North America"), (2, "France", "FR", "Europe")],
    "stage_vendedores": [(200, 1, dec(1000), dec("0.012")), (201, None, None, None)],
    "stage_funcionarios": [(200, datetime.date(2010, 1, 2))],
    "stage_ofertas": [
        (1, "None", "No Discount", dec(0), day("2010-01-01"), day("2030-01-01"), 0, None),
        (2, "Bulk", "Volume", dec("0.1"), day("2010-01-01"), day("2030-01-01"), None, 60),
    ],
    "stage_pedidos_header": [(1000, MONDAY, 1, 1, 200), (1001, MONDAY, 2, 2, None)],
    "stage_pedidos_detalhe": [
        (1000, 1, 3, 10, 2, dec(100), dec("0.1")),
        (1000, 2, 1, 11, 1, dec(10), None),
        (1001, 1, 2, 10, 1, dec(100), dec(0)),
    ],
}


def staged(spark, **changed):
    """The eleven staged tables; keyword arguments replace the rows of single tables."""
    return {n: spark.createDataFrame(changed.get(n, ROWS[n]), SCHEMAS[n]) for n in SCHEMAS}


# Published tables by hand.

def published(spark, name: str, records: list[dict]):
    """A warehouse table with the given columns filled and all others at their default or NULL."""
    table = TABLES[name]
    kinds = {c.name: c.type for c in table.columns}
    columns = list(records[0])
    ddl = ", ".join(f"{c} {kinds[c]}" for c in columns)
    return conform(spark.createDataFrame([tuple(r[c] for c in columns) for r in records], ddl), table)


def sales(spark, lines: list[dict]):
    """Fact rows; unset measures are 0, and order and line are numbered unless given."""
    from salesmill.plans.pipeline import with_partition

    base = {
        "sk_tempo": 20130506, "sk_cliente": 1, "sk_produto": 1, "sk_regiao": 1, "sk_vendedor": None, "sk_oferta": None,
        "numero_linha": 1, "quantidade_vendida": 1, "valor_unitario": dec(0), "valor_bruto": dec(0),
        "valor_desconto": dec(0), "valor_liquido": dec(0), "custo_total": dec(0), "lucro_bruto": dec(0),
        "percentual_desconto": dec(0), "margem_contribuicao": dec(0),
    }
    records = [{"numero_pedido": i + 1, "sk_venda": i + 1, **base, **line} for i, line in enumerate(lines)]
    return with_partition(published(spark, "fato_vendas", records))
