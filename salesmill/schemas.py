"""Fixed values of the warehouse: table names, columns, types, limits, keys and references.

Column names, text limits and decimal sizes are part of the data model and must stay as they are.
Keys are BIGINT here although the model says INT: order ids pass 2^31 long before 100 TB of lines.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

# Source table -> staging table.
STAGING = {
    "Sales.Customer": "stage_clientes",
    "Person.Person": "stage_pessoas",
    "Production.Product": "stage_produtos",
    "Production.ProductSubcategory": "stage_subcategorias",
    "Production.ProductCategory": "stage_categorias",
    "Sales.SalesTerritory": "stage_territorios",
    "Sales.SalesPerson": "stage_vendedores",
    "HumanResources.Employee": "stage_funcionarios",
    "Sales.SpecialOffer": "stage_ofertas",
    "Sales.SalesOrderHeader": "stage_pedidos_header",
    "Sales.SalesOrderDetail": "stage_pedidos_detalhe",
}


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False
    limit: int | None = None
    default: str | None = None


@dataclass(frozen=True)
class Table:
    name: str
    surrogate: str
    natural: tuple[str, ...]
    columns: tuple[Column, ...]
    # column -> (referenced table, referenced column)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    # columns overwritten when a natural key arrives again; all others keep their first value
    updates: tuple[str, ...] = ()
    stamp: str | None = None

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(
            ", ".join(f"{c.name} {c.type}{' not null' if c.required else ''}" for c in self.columns)
        )

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def limits(self) -> dict[str, int]:
        return {c.name: c.limit for c in self.columns if c.limit}

    @property
    def defaults(self) -> dict[str, str]:
        return {c.name: f"cast({c.default} as {c.type})" for c in self.columns if c.default}

    @property
    def decimals(self) -> dict[str, str]:
        return {c.name: c.type for c in self.columns if c.type.startswith("decimal")}


# The tables of the model.

DIM_TEMPO = Table(
    "dim_tempo", "sk_tempo", ("data_completa",),
    (
        Column("sk_tempo", "int", required=True),
        Column("data_completa", "date", required=True),
        Column("ano", "smallint", required=True),
        Column("trimestre", "smallint", required=True),
        Column("mes", "smallint", required=True),
        Column("dia", "smallint", required=True),
        Column("semana_ano", "smallint"),
        Column("dia_semana", "smallint"),
        Column("nome_mes", "string", limit=20),
        Column("nome_dia_semana", "string", limit=20),
        Column("eh_fim_semana", "boolean", default="false"),
        Column("eh_feriado", "boolean", default="false"),
    ),
)

DIM_CLIENTE = Table(
    "dim_cliente", "sk_cliente", ("nk_cliente",),
    (
        Column("sk_cliente", "bigint", required=True),
        Column("nk_cliente", "bigint", required=True),
        Column("nome_cliente", "string", limit=150),
        Column("sobrenome", "string", limit=100),
        Column("nome_completo", "string", limit=250),
        Column("tipo_cliente", "string", limit=30),
        Column("segmento", "string", limit=50),
        Column("data_cadastro", "date"),
        Column("ultima_atualizacao", "timestamp", default="current_timestamp()"),
    ),
    updates=("nome_cliente", "sobrenome", "nome_completo", "tipo_cliente"),
    stamp="ultima_atualizacao",
)

DIM_PRODUTO = Table(
    "dim_produto", "sk_produto", ("nk_produto",),
    (
        Column("sk_produto", "bigint", required=True),
        Column("nk_produto", "bigint", required=True),
        Column("nome_produto", "string", limit=150),
        Column("codigo_produto", "string", limit=50),
        Column("categoria_produto", "string", limit=100),
        Column("subcategoria_produto", "string", limit=100),
        Column("linha_produto", "string", limit=50),
        Column("cor_produto", "string", limit=30),
        Column("tamanho", "string", limit=20),
        Column("peso", "decimal(10,2)"),
        Column("custo_unitario", "decimal(15,4)"),
        Column("preco_lista", "decimal(15,4)"),
        Column("margem_percentual", "decimal(5,2)"),
        Column("data_inicio_vigencia", "date"),
        Column("data_fim_vigencia", "date"),
        Column("status_ativo", "boolean", default="true"),
    ),
    updates=(
        "nome_produto", "categoria_produto", "subcategoria_produto", "cor_produto",
        "custo_unitario", "preco_lista", "margem_percentual", "status_ativo",
    ),
)

DIM_REGIAO = Table(
    "dim_regiao", "sk_regiao", ("nk_regiao",),
    (
        Column("sk_regiao", "bigint", required=True),
        Column("nk_regiao", "bigint", required=True),
        Column("nome_territorio", "string", limit=100),
        Column("codigo_pais", "string", limit=10),
        Column("nome_pais", "string", limit=100),
        Column("continente", "string", limit=50),
        Column("grupo_regional", "string", limit=100),
    ),
    updates=("nome_territorio", "grupo_regional"),
)

DIM_VENDEDOR = Table(
    "dim_vendedor", "sk_vendedor", ("nk_vendedor",),
    (
        Column("sk_vendedor", "bigint", required=True),
        Column("nk_vendedor", "bigint", required=True),
        Column("nome_vendedor", "string", limit=150),
        Column("codigo_vendedor", "string", limit=50),
        Column("sk_regiao", "bigint"),
        Column("data_admissao", "date"),
        Column("meta_anual", "decimal(18,2)"),
        Column("comissao_percentual", "decimal(5,2)"),
        Column("status_ativo", "boolean", default="true"),
    ),
    references={"sk_regiao": ("dim_regiao", "sk_regiao")},
    updates=("nome_vendedor", "sk_regiao", "meta_anual", "comissao_percentual"),
)

DIM_OFERTA = Table(
    "dim_oferta", "sk_oferta", ("nk_oferta",),
    (
        Column("sk_oferta", "bigint", required=True),
        Column("nk_oferta", "bigint", required=True),
        Column("descricao_oferta", "string", limit=200),
        Column("tipo_oferta", "string", limit=50),
        Column("percentual_desconto", "decimal(5,2)"),
        Column("data_inicio", "date"),
        Column("data_fim", "date"),
        Column("quantidade_minima", "int"),
        Column("quantidade_maxima", "int"),
    ),
    updates=("descricao_oferta", "percentual_desconto", "data_fim"),
)

FATO_VENDAS = Table(
    "fato_vendas", "sk_venda", ("numero_pedido", "numero_linha"),
    (
        Column("sk_venda", "bigint", required=True),
        Column("sk_tempo", "int", required=True),
        Column("sk_cliente", "bigint", required=True),
        Column("sk_produto", "bigint", required=True),
        Column("sk_regiao", "bigint"),
        Column("sk_vendedor", "bigint"),
        Column("sk_oferta", "bigint"),
        Column("numero_pedido", "bigint", required=True),
        Column("numero_linha", "bigint", required=True),
        Column("quantidade_vendida", "int", required=True, default="0"),
        Column("valor_unitario", "decimal(15,4)", required=True, default="0"),
        Column("valor_bruto", "decimal(18,4)", required=True, default="0"),
        Column("valor_desconto", "decimal(18,4)", required=True, default="0"),
        Column("valor_liquido", "decimal(18,4)", required=True, default="0"),
        Column("custo_total", "decimal(18,4)", required=True, default="0"),
        Column("lucro_bruto", "decimal(18,4)", required=True, default="0"),
        Column("percentual_desconto", "decimal(5,2)"),
        Column("margem_contribuicao", "decimal(5,2)"),
        Column("data_carga", "timestamp", default="current_timestamp()"),
    ),
    references={
        "sk_tempo": ("dim_tempo", "sk_tempo"),
        "sk_cliente": ("dim_cliente", "sk_cliente"),
        "sk_produto": ("dim_produto", "sk_produto"),
        "sk_regiao": ("dim_regiao", "sk_regiao"),
        "sk_vendedor": ("dim_vendedor", "sk_vendedor"),
        "sk_oferta": ("dim_oferta", "sk_oferta"),
    },
)

# The fact files are split by this column (year and month of the order date).
FACT_PARTITION = "ano_mes"

TABLES = {
    t.name: t
    for t in (DIM_TEMPO, DIM_CLIENTE, DIM_PRODUTO, DIM_REGIAO, DIM_VENDEDOR, DIM_OFERTA, FATO_VENDAS)
}

# Update lists of the older English model, by table.
V1_UPDATES = {
    "dim_customer": ("first_name", "last_name", "full_name"),
    "dim_product": (
        "product_name", "category", "subcategory", "model", "color", "size",
        "standard_cost", "list_price",
    ),
    "dim_territory": ("territory_name", "country_region", "group_name"),
    "dim_sales_person": ("full_name", "territory_key", "hire_date", "quota"),
    "dim_promotion": ("promotion_name", "discount_pct", "start_date", "end_date"),
}


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Give `df` exactly the columns of `table`.

    A column the load leaves out takes its default (or NULL); an explicit NULL stays NULL.
    Casts follow ANSI rules, so a value that does not fit stops the job.
    """
    def pick(c: Column):
        if c.name in df.columns:
            return F.col(c.name).cast(c.type).alias(c.name)
        return F.expr(c.default or "null").cast(c.type).alias(c.name)

    return df.select(*[pick(c) for c in table.columns])


def with_stored_types(df: DataFrame, table: Table) -> DataFrame:
    """Cast the columns that `df` shares with `table` to the types they are stored in; the others stay."""
    kinds = {c.name: c.type for c in table.columns}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])
