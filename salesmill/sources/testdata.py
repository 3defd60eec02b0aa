"""The eleven staging shapes, derived from the TPC-H-like test tables (rules in FIXTURES.md §3)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmill.sources.extract import extract

# Looks a test table up by its name.
Read = Callable[[str], DataFrame]

# Customers' persons live beside sellers' persons in one table; this keeps their ids apart.
PERSON_OFFSET = 1_000_000_000
MONTHS_SHIFT = 156

# Which of two lines with the same order and line number counts as the first.
LINE_ORDER = (
    "ProductID", "SourceSupplier", "OrderQty", "SourceAmount",
    "UnitPriceDiscount", "SourceTax", "SourceShipDate",
)


def territories(read: Read) -> DataFrame:
    nation = read("nation")
    region = read("region")
    group = (
        F.when(F.col("r_name") == "AMERICA", "North America")
        .when(F.col("r_name") == "EUROPE", "Europe")
        .when(F.col("r_name") == "ASIA", "Pacific")
        .otherwise(F.concat(F.upper(F.substring("r_name", 1, 1)), F.expr("lower(substring(r_name, 2))")))
    )
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("TerritoryID"),
        F.col("n_name").alias("Name"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("CountryRegionCode"),
        group.alias("Group"),
    )


def sellers(read: Read) -> DataFrame:
    return read("supplier").select(
        F.col("s_suppkey").alias("BusinessEntityID"),
        F.col("s_nationkey").cast("bigint").alias("TerritoryID"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("SalesQuota"),
        F.lit("0.0120").cast("decimal(18,4)").alias("CommissionPct"),
    )


def employees(read: Read) -> DataFrame:
    return read("supplier").select(
        F.col("s_suppkey").alias("BusinessEntityID"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("s_suppkey") % 365).cast("int")).alias("HireDate"),
    )


def persons(read: Read) -> DataFrame:
    after_hash = lambda c: F.substring_index(c, "#", -1)
    buyers = read("customer").select(
        (F.col("c_custkey") + PERSON_OFFSET).alias("BusinessEntityID"),
        F.lit("Customer").alias("FirstName"),
        after_hash("c_name").alias("LastName"),
    )
    staff = read("supplier").where(F.col("s_suppkey") % 10 != 0).select(
        F.col("s_suppkey").alias("BusinessEntityID"),
        F.lit("Supplier").alias("FirstName"),
        after_hash("s_name").alias("LastName"),
    )
    return buyers.unionByName(staff)


def customers(read: Read) -> DataFrame:
    key = F.col("c_custkey")
    return read("customer").select(
        key.alias("CustomerID"),
        F.when(key % 3 == 0, key + PERSON_OFFSET).alias("PersonID"),
        F.when(key % 3 == 1, key).alias("StoreID"),
    )


def _brand_number():
    return F.substring_index("p_brand", "#", -1).cast("bigint")


def products(read: Read) -> DataFrame:
    key, price = F.col("p_partkey"), F.col("p_retailprice").cast("decimal(15,4)")
    ratio = F.lit("0.50").cast("decimal(4,2)") + F.lit("0.10").cast("decimal(3,2)") * (key % 7).cast("decimal(1,0)")
    return read("part").select(
        key.alias("ProductID"),
        F.col("p_name").alias("Name"),
        F.concat(F.lit("PN-"), key.cast("string")).alias("ProductNumber"),
        F.col("p_type").alias("ProductLine"),
        F.substring_index("p_name", " ", 1).alias("Color"),
        F.col("p_size").cast("string").alias("Size"),
        F.lit(None).cast("decimal(10,2)").alias("Weight"),
        (price * ratio).cast("decimal(15,4)").alias("StandardCost"),
        price.alias("ListPrice"),
        F.lit("2008-01-01").cast("timestamp_ntz").alias("SellStartDate"),
        F.when(key % 11 == 0, F.lit("2013-01-01").cast("timestamp_ntz")).alias("SellEndDate"),
        F.when(key % 50 != 0, _brand_number()).alias("ProductSubcategoryID"),
        (key % 100).alias("ProductModelID"),
    )


def subcategories(read: Read) -> DataFrame:
    brands = read("part").select(_brand_number().alias("id")).distinct()
    return brands.select(
        F.col("id").alias("ProductSubcategoryID"),
        (F.col("id") % 5).alias("ProductCategoryID"),
        F.concat(F.lit("Brand#"), F.col("id").cast("string")).alias("Name"),
    )


def categories(read: Read) -> DataFrame:
    ids = subcategories(read).select("ProductCategoryID").distinct()
    return ids.select(
        "ProductCategoryID",
        F.concat(F.lit("Cat "), F.col("ProductCategoryID").cast("string")).alias("Name"),
    )


def _discount():
    return F.col("l_discount").cast("decimal(4,2)")


def offers(read: Read) -> DataFrame:
    """One offer per discount step that really occurs on a line."""
    ids = (
        read("lineitem")
        .select((_discount() * 100 + 1).cast("bigint").alias("id"))
        .distinct()
    )
    key = F.col("id")
    even = key % 2 == 0
    return ids.select(
        key.alias("SpecialOfferID"),
        F.concat(F.lit("Offer "), key.cast("string")).alias("Description"),
        F.when(key == 1, "No Discount").otherwise("Volume Discount").alias("Type"),
        ((key - 1) * F.lit("0.05").cast("decimal(4,2)")).cast("decimal(18,4)").alias("DiscountPct"),
        F.lit("2008-01-01").cast("timestamp_ntz").alias("StartDate"),
        F.lit("2030-12-31").cast("timestamp_ntz").alias("EndDate"),
        F.when(~even, F.lit(1)).alias("MinQty"),
        F.when(even, F.lit(100)).alias("MaxQty"),
    )


def headers(read: Read) -> DataFrame:
    orders = read("orders")
    homes = read("customer").select(*["c_custkey", "c_nationkey"])
    key = F.col("o_orderkey")
    return orders.join(homes, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        key.alias("SalesOrderID"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("c_nationkey").cast("bigint").alias("TerritoryID"),
        F.add_months(F.col("o_orderdate").cast("date"), MONTHS_SHIFT).cast("timestamp_ntz").alias("OrderDate"),
        F.when(key % 4 < 2, F.expr("o_orderkey div 4") % 10).alias("SalesPersonID"),
    )


def details(read: Read) -> DataFrame:
    lines = read("lineitem")
    prices = read("part").select(*["p_partkey", "p_retailprice"])
    return lines.join(prices, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        F.col("l_orderkey").alias("SalesOrderID"),
        F.col("l_linenumber").cast("bigint").alias("SalesOrderDetailID"),
        F.col("l_partkey").alias("ProductID"),
        F.col("l_quantity").cast("int").alias("OrderQty"),
        F.col("p_retailprice").cast("decimal(15,4)").alias("UnitPrice"),
        (_discount() * 5).cast("decimal(9,4)").alias("UnitPriceDiscount"),
        (_discount() * 100 + 1).cast("bigint").alias("SpecialOfferID"),
        F.col("l_suppkey").alias("SourceSupplier"),
        F.col("l_extendedprice").alias("SourceAmount"),
        F.col("l_tax").alias("SourceTax"),
        F.col("l_shipdate").alias("SourceShipDate"),
    )


BUILDERS = {
    "stage_clientes": customers,
    "stage_pessoas": persons,
    "stage_produtos": products,
    "stage_subcategorias": subcategories,
    "stage_categorias": categories,
    "stage_territorios": territories,
    "stage_vendedores": sellers,
    "stage_funcionarios": employees,
    "stage_ofertas": offers,
    "stage_pedidos_header": headers,
    "stage_pedidos_detalhe": details,
}


class TestTables:
    """Lazy lookup of the staging shapes over one test data folder; each file is opened once."""

    __test__ = False

    def __init__(self, spark: SparkSession, base: str):
        self._spark, self._base = spark, base
        self._opened: dict[str, DataFrame] = {}

    def raw(self, table: str) -> DataFrame:
        if table not in self._opened:
            self._opened[table] = extract(self._spark, f"{self._base}/{table}.parquet")
        return self._opened[table]

    def __getitem__(self, stage: str) -> DataFrame:
        return BUILDERS[stage](self.raw)

    def keys(self):
        return BUILDERS.keys()
