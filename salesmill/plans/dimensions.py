"""The five sales dimensions from staged tables, by natural key; `type1_upsert` adds the surrogate key.

`load_date` is a date text; None means the current date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesmill.functions import columns as fn
from salesmill.operators.lookup import look_up


# What stands in for missing source values, and constants of the model.
UNKNOWN_NAME, UNKNOWN_SURNAME = "Desconhecido", ""
CUSTOMER_LABEL, SELLER_LABEL = "Cliente ", "Vendedor "
SEGMENT = "Varejo"
NO_CATEGORY, NO_SUBCATEGORY, NOT_GIVEN = "Sem Categoria", "Sem Subcategoria", "N/A"
LEAST_QUANTITY, MOST_QUANTITY = 0, 999999


def _today(load_date: str | None) -> Column:
    return F.lit(load_date).cast("date") if load_date else F.current_date()


def _names(persons: DataFrame) -> DataFrame:
    return persons.select(F.col("BusinessEntityID").alias("_person"), "FirstName", "LastName")


def _or_else(name: str, default: str) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def _decimal_or_zero(name: str, kind: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast(kind)


def build_dim_cliente(customers: DataFrame, persons: DataFrame, load_date: str | None = None) -> DataFrame:
    named = look_up(
        customers.where("CustomerID is not null"), _names(persons),
        "PersonID", "_person", ["FirstName", "LastName"], ["CustomerID"],
    )
    return named.select(
        F.col("CustomerID").cast("bigint").alias("nk_cliente"),
        _or_else("FirstName", UNKNOWN_NAME).alias("nome_cliente"),
        _or_else("LastName", UNKNOWN_SURNAME).alias("sobrenome"),
        fn.full_name(F.col("FirstName"), F.col("LastName"), CUSTOMER_LABEL, F.col("CustomerID")).alias("nome_completo"),
        fn.customer_type(F.col("PersonID"), F.col("StoreID")).alias("tipo_cliente"),
        F.lit(SEGMENT).alias("segmento"),
        _today(load_date).alias("data_cadastro"),
    ).distinct()


def with_category(products: DataFrame, subcategories: DataFrame, categories: DataFrame) -> DataFrame:
    subs = subcategories.select(
        F.col("ProductSubcategoryID").alias("_sub"), F.col("Name").alias("_sub_name"), F.col("ProductCategoryID").alias("_cat")
    )
    cats = categories.select(F.col("ProductCategoryID").alias("_cat_id"), F.col("Name").alias("_cat_name"))
    hierarchy = subs.join(cats, F.col("_cat") == F.col("_cat_id"), "left")
    return look_up(products, hierarchy, "ProductSubcategoryID", "_sub", ["_sub_name", "_cat_name"], ["ProductID"])


def build_dim_produto(
    products: DataFrame, subcategories: DataFrame, categories: DataFrame, load_date: str | None = None
) -> DataFrame:
    placed = with_category(products.where("ProductID is not null"), subcategories, categories)
    return placed.select(
        F.col("ProductID").cast("bigint").alias("nk_produto"),
        F.col("Name").alias("nome_produto"),
        F.col("ProductNumber").alias("codigo_produto"),
        _or_else("_cat_name", NO_CATEGORY).alias("categoria_produto"),
        _or_else("_sub_name", NO_SUBCATEGORY).alias("subcategoria_produto"),
        _or_else("ProductLine", NOT_GIVEN).alias("linha_produto"),
        _or_else("Color", NOT_GIVEN).alias("cor_produto"),
        _or_else("Size", NOT_GIVEN).alias("tamanho"),
        _decimal_or_zero("Weight", "decimal(10,2)").alias("peso"),
        _decimal_or_zero("StandardCost", "decimal(15,4)").alias("custo_unitario"),
        _decimal_or_zero("ListPrice", "decimal(15,4)").alias("preco_lista"),
        fn.list_margin(F.col("ListPrice"), F.col("StandardCost")).alias("margem_percentual"),
        F.coalesce(F.col("SellStartDate").cast("date"), _today(load_date)).alias("data_inicio_vigencia"),
        F.col("SellEndDate").isNull().alias("status_ativo"),
    ).distinct()


def build_dim_regiao(territories: DataFrame) -> DataFrame:
    """`nome_pais` repeats the country code, as the data model has it."""
    return territories.where("TerritoryID is not null").select(
        F.col("TerritoryID").cast("bigint").alias("nk_regiao"),
        F.col("Name").alias("nome_territorio"),
        F.col("CountryRegionCode").alias("codigo_pais"),
        F.col("CountryRegionCode").alias("nome_pais"),
        fn.continent(F.col("Group")).alias("continente"),
        F.col("Group").alias("grupo_regional"),
    ).distinct()


def _staffed(sellers: DataFrame, employees: DataFrame, persons: DataFrame) -> DataFrame:
    hired = employees.select(F.col("BusinessEntityID").alias("_employee"), "HireDate")
    found = look_up(sellers, hired, "BusinessEntityID", "_employee", ["HireDate"], ["SalesQuota"])
    return look_up(found, _names(persons), "BusinessEntityID", "_person", ["FirstName", "LastName"], ["SalesQuota"])


def build_dim_vendedor(
    sellers: DataFrame, employees: DataFrame, persons: DataFrame, dim_regiao: DataFrame
) -> DataFrame:
    """Needs `dim_regiao` with its surrogate keys, so regions must be loaded first."""
    staffed = _staffed(sellers.where("BusinessEntityID is not null"), employees, persons)
    placed = look_up(staffed, dim_regiao, "TerritoryID", "nk_regiao", ["sk_regiao"], ["BusinessEntityID"])
    key = F.col("BusinessEntityID")
    return placed.select(
        key.cast("bigint").alias("nk_vendedor"),
        fn.full_name(F.col("FirstName"), F.col("LastName"), SELLER_LABEL, key).alias("nome_vendedor"),
        fn.seller_code(key).alias("codigo_vendedor"),
        "sk_regiao",
        F.col("HireDate").cast("date").alias("data_admissao"),
        _decimal_or_zero("SalesQuota", "decimal(18,2)").alias("meta_anual"),
        _decimal_or_zero("CommissionPct", "decimal(5,2)").alias("comissao_percentual"),
    ).distinct()


def build_dim_oferta(offers: DataFrame) -> DataFrame:
    """`percentual_desconto` is a fraction here, while the fact holds percent."""
    return offers.where("SpecialOfferID is not null").select(
        F.col("SpecialOfferID").cast("bigint").alias("nk_oferta"),
        F.col("Description").alias("descricao_oferta"),
        F.col("Type").alias("tipo_oferta"),
        _decimal_or_zero("DiscountPct", "decimal(5,2)").alias("percentual_desconto"),
        F.col("StartDate").cast("date").alias("data_inicio"),
        F.col("EndDate").cast("date").alias("data_fim"),
        F.coalesce("MinQty", F.lit(LEAST_QUANTITY)).cast("int").alias("quantidade_minima"),
        F.coalesce("MaxQty", F.lit(MOST_QUANTITY)).cast("int").alias("quantidade_maxima"),
    ).distinct()


# The older English model: fewer defaults, other sizes.

def build_dim_customer_v1(customers: DataFrame, persons: DataFrame, load_date: str | None = None) -> DataFrame:
    named = look_up(customers, _names(persons), "PersonID", "_person", ["FirstName", "LastName"], ["CustomerID"])
    return named.select(
        F.col("CustomerID").cast("bigint").alias("customer_id"),
        F.col("FirstName").alias("first_name"),
        F.col("LastName").alias("last_name"),
        F.concat("FirstName", F.lit(" "), "LastName").alias("full_name"),
        F.lit(None).cast("string").alias("email"),
        _today(load_date).alias("create_date"),
        F.lit(None).cast("date").alias("update_date"),
    )


def build_dim_product_v1(
    products: DataFrame, subcategories: DataFrame, categories: DataFrame, load_date: str | None = None
) -> DataFrame:
    return with_category(products, subcategories, categories).select(
        F.col("ProductID").cast("bigint").alias("product_id"),
        F.col("Name").alias("product_name"),
        F.col("_cat_name").alias("category"),
        F.col("_sub_name").alias("subcategory"),
        F.col("ProductModelID").cast("string").alias("model"),
        F.col("Color").alias("color"),
        F.col("Size").alias("size"),
        _decimal_or_zero("StandardCost", "decimal(12,2)").alias("standard_cost"),
        _decimal_or_zero("ListPrice", "decimal(12,2)").alias("list_price"),
        _today(load_date).alias("start_date"),
    )


def build_dim_territory_v1(territories: DataFrame) -> DataFrame:
    return territories.select(
        F.col("TerritoryID").cast("bigint").alias("territory_id"),
        F.col("Name").alias("territory_name"),
        F.col("CountryRegionCode").alias("country_region"),
        F.col("Group").alias("group_name"),
    ).distinct()


def build_dim_sales_person_v1(
    sellers: DataFrame, employees: DataFrame, persons: DataFrame, dim_territory: DataFrame
) -> DataFrame:
    """A quota written as empty text counts as 0."""
    staffed = _staffed(sellers, employees, persons)
    placed = look_up(staffed, dim_territory, "TerritoryID", "territory_id", ["territory_key"], ["BusinessEntityID"])
    quota = F.nullif(F.col("SalesQuota").cast("string"), F.lit("")).cast("decimal(14,2)")
    return placed.select(
        F.col("BusinessEntityID").cast("bigint").alias("sales_person_id"),
        F.concat("FirstName", F.lit(" "), "LastName").alias("full_name"),
        "territory_key",
        F.col("HireDate").cast("date").alias("hire_date"),
        F.coalesce(quota, F.lit(0).cast("decimal(14,2)")).alias("quota"),
    )


def build_dim_promotion_v1(offers: DataFrame) -> DataFrame:
    return offers.select(
        F.col("SpecialOfferID").cast("bigint").alias("promotion_id"),
        F.col("Description").alias("promotion_name"),
        _decimal_or_zero("DiscountPct", "decimal(5,2)").alias("discount_pct"),
        F.col("StartDate").cast("date").alias("start_date"),
        F.col("EndDate").cast("date").alias("end_date"),
    )
