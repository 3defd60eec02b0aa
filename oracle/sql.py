"""Independent answers: one DuckDB statement per registered query, over the same test tables.

Nothing here is shared with the Spark code. Amounts are decimals; a quotient is rounded half away
from zero in whole numbers, so no binary rounding comes in. Results leave as BIGINT, DOUBLE,
VARCHAR and BOOLEAN.
"""

from __future__ import annotations

import re

LOAD_DATE, EARLIER_LOAD_DATE = "2024-01-01", "2010-01-01"


def _ratio(num: str, den: str, factor: int) -> str:
    """num / den * factor for amounts with at most 8 places, rounded to 2 places."""
    units = "CAST(CAST({} AS DECIMAL(38,8)) * 100000000 AS HUGEINT)"
    n, d = f"({units.format(num)} * {factor * 100})", units.format(den)
    whole = f"(sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // (2 * nullif(abs({d}), 0))))"
    return f"(CAST({whole} AS DECIMAL(36,0)) * 0.01::DECIMAL(3,2))"


def pct(num: str, den: str) -> str:
    return _ratio(num, den, 100)


def per(num: str, den: str) -> str:
    return _ratio(num, den, 1)


def avg2(column: str) -> str:
    return per(f"sum({column})", f"count({column})")


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def money(x: str) -> str:
    return dbl(f"round({x}, 2)")


CTE: dict[str, str] = {}

# ---- staging shapes

CTE["t_territory"] = """
SELECT n_nationkey::BIGINT AS id, n_name AS name, 'N' || n_nationkey AS code,
       CASE r_name WHEN 'AMERICA' THEN 'North America' WHEN 'EUROPE' THEN 'Europe' WHEN 'ASIA' THEN 'Pacific'
            ELSE upper(substr(r_name, 1, 1)) || lower(substr(r_name, 2)) END AS grp
FROM nation JOIN region ON n_regionkey = r_regionkey"""
CTE["t_seller"] = """
SELECT s_suppkey AS id, s_nationkey::BIGINT AS territory, CAST(s_acctbal AS DECIMAL(18,2)) AS quota,
       0.0120::DECIMAL(18,4) AS commission, DATE '2000-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS hired
FROM supplier"""
CTE["t_person"] = """
SELECT c_custkey + 1000000000 AS id, 'Customer' AS first, split_part(c_name, '#', 2) AS last FROM customer
UNION ALL
SELECT s_suppkey, 'Supplier', split_part(s_name, '#', 2) FROM supplier WHERE s_suppkey % 10 <> 0"""
CTE["t_customer"] = """
SELECT c_custkey AS id,
       CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 1000000000 END AS person,
       CASE WHEN c_custkey % 3 = 1 THEN c_custkey END AS store
FROM customer"""
CTE["t_product"] = """
SELECT p_partkey AS id, p_name AS name, 'PN-' || p_partkey AS number, p_type AS line,
       split_part(p_name, ' ', 1) AS color, CAST(p_size AS VARCHAR) AS size,
       CAST(p_retailprice AS DECIMAL(15,4)) AS price,
       CAST(CAST(p_retailprice AS DECIMAL(13,2)) * ((5 + p_partkey % 7)::DECIMAL(2,0) * 0.1::DECIMAL(2,1)) AS DECIMAL(15,4)) AS cost,
       CASE WHEN p_partkey % 50 <> 0 THEN CAST(split_part(p_brand, '#', 2) AS BIGINT) END AS sub,
       p_partkey % 11 = 0 AS ended, p_partkey % 100 AS model
FROM part"""
CTE["t_sub"] = """
SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS id FROM part"""
CTE["t_cat"] = """
SELECT DISTINCT id % 5 AS id FROM t_sub"""
CTE["t_placed"] = """
SELECT p.*, 'Brand#' || s.id AS sub_name, 'Cat ' || c.id AS cat_name
FROM t_product p LEFT JOIN t_sub s ON p.sub = s.id LEFT JOIN t_cat c ON c.id = s.id % 5"""
CTE["t_offer"] = """
SELECT DISTINCT CAST(round(l_discount * 100) AS BIGINT) + 1 AS id FROM lineitem"""
CTE["t_header"] = """
SELECT o_orderkey AS id, o_custkey AS customer, c_nationkey::BIGINT AS territory,
       CAST(o_orderdate AS DATE) + INTERVAL 156 MONTH AS moment,
       CASE WHEN o_orderkey % 4 < 2 THEN (o_orderkey // 4) % 10 END AS seller
FROM orders LEFT JOIN customer ON c_custkey = o_custkey"""
CTE["t_detail"] = """
SELECT l_orderkey AS ord, l_linenumber::BIGINT AS line, l_partkey AS product, CAST(l_quantity AS INTEGER) AS qty,
       CAST(p_retailprice AS DECIMAL(15,4)) AS price,
       CAST(CAST(l_discount AS DECIMAL(4,2)) * 5 AS DECIMAL(9,4)) AS disc,
       CAST(round(l_discount * 100) AS BIGINT) + 1 AS offer,
       row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS nth
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey"""

# ---- dimensions, numbered by natural key

CTE["d_tempo"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS sk_tempo, CAST(d AS DATE) AS data_completa,
       CAST(year(d) AS BIGINT) AS ano, CAST(quarter(d) AS BIGINT) AS trimestre, CAST(month(d) AS BIGINT) AS mes,
       CAST(day(d) AS BIGINT) AS dia, CAST(weekofyear(d) AS BIGINT) AS semana_ano,
       CAST(dayofweek(d) AS BIGINT) AS dia_semana, monthname(d) AS nome_mes, dayname(d) AS nome_dia_semana,
       dayofweek(d) IN (0, 6) AS eh_fim_semana, FALSE AS eh_feriado
FROM range(DATE '2008-01-01', DATE '2031-01-01', INTERVAL 1 DAY) r(d)"""
CTE["d_regiao"] = """
SELECT row_number() OVER (ORDER BY id) AS sk_regiao, id AS nk_regiao, name AS nome_territorio, code AS codigo_pais,
       code AS nome_pais,
       CASE WHEN contains(grp, 'America') THEN 'Américas' WHEN contains(grp, 'Europe') THEN 'Europa'
            WHEN contains(grp, 'Pacific') THEN 'Ásia-Pacífico' ELSE 'Outros' END AS continente,
       grp AS grupo_regional
FROM t_territory"""
CTE["d_cliente"] = """
SELECT row_number() OVER (ORDER BY c.id) AS sk_cliente, c.id AS nk_cliente,
       ifnull(p.first, 'Desconhecido') AS nome_cliente, ifnull(p.last, '') AS sobrenome,
       ifnull(p.first || ' ' || p.last, 'Cliente ' || c.id) AS nome_completo,
       CASE WHEN c.person IS NOT NULL THEN 'Pessoa Física' WHEN c.store IS NOT NULL THEN 'Empresa'
            ELSE 'Indefinido' END AS tipo_cliente,
       'Varejo' AS segmento
FROM t_customer c LEFT JOIN t_person p ON p.id = c.person"""
CTE["d_produto"] = f"""
SELECT row_number() OVER (ORDER BY id) AS sk_produto, id AS nk_produto, name AS nome_produto, number AS codigo_produto,
       ifnull(cat_name, 'Sem Categoria') AS categoria_produto, ifnull(sub_name, 'Sem Subcategoria') AS subcategoria_produto,
       line AS linha_produto, color AS cor_produto, size AS tamanho, cost AS custo_unitario, price AS preco_lista,
       CASE WHEN price > 0 THEN {pct('price - cost', 'price')} ELSE 0 END AS margem_percentual,
       NOT ended AS status_ativo
FROM t_placed"""
CTE["d_vendedor"] = """
SELECT row_number() OVER (ORDER BY s.id) AS sk_vendedor, s.id AS nk_vendedor,
       ifnull(p.first || ' ' || p.last, 'Vendedor ' || s.id) AS nome_vendedor,
       'V' || CASE WHEN s.id < 100000 THEN format('{:05d}', s.id) ELSE substr(CAST(s.id AS VARCHAR), 1, 5) END AS codigo_vendedor,
       r.sk_regiao, s.hired AS data_admissao, s.quota AS meta_anual, 0.01::DECIMAL(5,2) AS comissao_percentual
FROM t_seller s LEFT JOIN t_person p ON p.id = s.id LEFT JOIN d_regiao r ON r.nk_regiao = s.territory"""
CTE["d_oferta"] = """
SELECT row_number() OVER (ORDER BY id) AS sk_oferta, id AS nk_oferta, 'Offer ' || id AS descricao_oferta,
       CASE id WHEN 1 THEN 'No Discount' ELSE 'Volume Discount' END AS tipo_oferta,
       CAST((id - 1)::DECIMAL(3,0) * 0.05::DECIMAL(3,2) AS DECIMAL(5,2)) AS percentual_desconto,
       '2008-01-01' AS data_inicio, '2030-12-31' AS data_fim,
       CAST(CASE WHEN id % 2 = 0 THEN 0 ELSE 1 END AS BIGINT) AS quantidade_minima,
       CAST(CASE WHEN id % 2 = 0 THEN 100 ELSE 999999 END AS BIGINT) AS quantidade_maxima
FROM t_offer"""

# ---- fact

CTE["f_line"] = """
SELECT d.ord AS numero_pedido, d.line AS numero_linha, CAST(strftime(h.moment, '%Y%m%d') AS BIGINT) AS sk_tempo, h.moment,
       c.sk_cliente, p.sk_produto, r.sk_regiao, v.sk_vendedor, o.sk_oferta,
       d.qty, d.price, d.disc, p.custo_unitario AS cost
FROM t_detail d JOIN t_header h ON h.id = d.ord
LEFT JOIN d_cliente c ON c.nk_cliente = h.customer
LEFT JOIN d_produto p ON p.nk_produto = d.product
LEFT JOIN d_regiao r ON r.nk_regiao = h.territory
LEFT JOIN d_vendedor v ON v.nk_vendedor = h.seller
LEFT JOIN d_oferta o ON o.nk_oferta = d.offer
WHERE d.nth = 1"""


def _measured(source: str) -> str:
    net = "(price * qty * (1 - disc))"
    cost = "(cost * qty)"
    return f"""
SELECT *, qty AS quantidade_vendida, price AS valor_unitario,
       CAST(price * qty AS DECIMAL(18,4)) AS valor_bruto,
       CAST(price * qty * disc AS DECIMAL(18,4)) AS valor_desconto,
       CAST({net} AS DECIMAL(18,4)) AS valor_liquido,
       CAST({cost} AS DECIMAL(18,4)) AS custo_total,
       CAST({net} - {cost} AS DECIMAL(18,4)) AS lucro_bruto,
       CAST(disc * 100 AS DECIMAL(5,2)) AS percentual_desconto,
       CASE WHEN {net} > 0 THEN CAST({pct(f'{net} - {cost}', net)} AS DECIMAL(5,2)) ELSE 0 END AS margem_contribuicao
FROM {source}"""


CTE["f"] = _measured("f_line")


def sql(body: str, **extra: str) -> str:
    """`body` with the named pieces it needs, directly or through another piece, in order."""
    pieces = {**CTE, **extra}
    used: set[str] = set()

    def need(text: str) -> None:
        for name in pieces:
            if name not in used and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                used.add(name)
                need(pieces[name])

    need(body)
    if not used:
        return body.strip()
    parts = ",\n".join(f"{name} AS ({text.strip()})" for name, text in pieces.items() if name in used)
    return f"WITH {parts}\n{body.strip()}"


Q: dict[str, str] = {}

# ---- staging

Q["stage_extract"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem"""

Q["stage_typed_orders"] = """
SELECT o_orderkey AS chave, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) AS total, o_orderpriority AS prioridade,
       o_orderstatus = 'F' AS fechado, strftime(o_orderdate, '%Y-%m-%d') AS dia,
       'bigint' AS tipo_chave, 'decimal(18,4)' AS tipo_total, 'string' AS tipo_prioridade, 'timestamp_ntz' AS tipo_momento,
       'boolean' AS tipo_fechado
FROM orders"""
Q["stage_row_counts"] = sql("""
SELECT 'stage_clientes' AS "table", count(*) AS "rows" FROM t_customer
UNION ALL SELECT 'stage_pessoas', count(*) FROM t_person
UNION ALL SELECT 'stage_produtos', count(*) FROM t_product
UNION ALL SELECT 'stage_subcategorias', count(*) FROM t_sub
UNION ALL SELECT 'stage_categorias', count(*) FROM t_cat
UNION ALL SELECT 'stage_territorios', count(*) FROM t_territory
UNION ALL SELECT 'stage_vendedores', count(*) FROM t_seller
UNION ALL SELECT 'stage_funcionarios', count(*) FROM t_seller
UNION ALL SELECT 'stage_ofertas', count(*) FROM t_offer
UNION ALL SELECT 'stage_pedidos_header', count(*) FROM t_header
UNION ALL SELECT 'stage_pedidos_detalhe', count(*) FROM t_detail""")

# Staged columns: name, declared type, and how many of its rows are filled.
_I, _T, _N, _D, _TS = "INTEGER", "TEXT", "NUMERIC(18,4)", "DOUBLE PRECISION", "TIMESTAMP"
STAGED_COLUMNS = {
    ("stage_clientes", "customer"): [
        ("CustomerID", _I, "count(*)"),
        ("PersonID", _I, "count(*) FILTER (c_custkey % 3 = 0)"),
        ("StoreID", _I, "count(*) FILTER (c_custkey % 3 = 1)"),
    ],
    ("stage_pessoas", "t_person"): [
        ("BusinessEntityID", _I, "count(id)"), ("FirstName", _T, "count(first)"), ("LastName", _T, "count(last)"),
    ],
    ("stage_produtos", "t_product"): [
        ("ProductID", _I, "count(id)"), ("Name", _T, "count(name)"), ("ProductNumber", _T, "count(number)"),
        ("ProductLine", _T, "count(line)"), ("Color", _T, "count(color)"), ("Size", _T, "count(size)"),
        ("Weight", _N, "count(NULL)"), ("StandardCost", _N, "count(cost)"), ("ListPrice", _N, "count(price)"),
        ("SellStartDate", _TS, "count(*)"), ("SellEndDate", _TS, "count(*) FILTER (ended)"),
        ("ProductSubcategoryID", _I, "count(sub)"), ("ProductModelID", _I, "count(model)"),
    ],
    ("stage_subcategorias", "t_sub"): [
        ("ProductSubcategoryID", _I, "count(id)"), ("ProductCategoryID", _I, "count(id)"), ("Name", _T, "count(id)"),
    ],
    ("stage_categorias", "t_cat"): [("ProductCategoryID", _I, "count(id)"), ("Name", _T, "count(id)")],
    ("stage_territorios", "t_territory"): [
        ("TerritoryID", _I, "count(id)"), ("Name", _T, "count(name)"), ("CountryRegionCode", _T, "count(code)"),
        ("Group", _T, "count(grp)"),
    ],
    ("stage_vendedores", "t_seller"): [
        ("BusinessEntityID", _I, "count(id)"), ("TerritoryID", _I, "count(territory)"),
        ("SalesQuota", _N, "count(quota)"), ("CommissionPct", _N, "count(commission)"),
    ],
    ("stage_funcionarios", "t_seller"): [("BusinessEntityID", _I, "count(id)"), ("HireDate", "date", "count(hired)")],
    ("stage_ofertas", "t_offer"): [
        ("SpecialOfferID", _I, "count(id)"), ("Description", _T, "count(id)"), ("Type", _T, "count(id)"),
        ("DiscountPct", _N, "count(id)"), ("StartDate", _TS, "count(id)"), ("EndDate", _TS, "count(id)"),
        ("MinQty", _I, "count(*) FILTER (id % 2 = 1)"), ("MaxQty", _I, "count(*) FILTER (id % 2 = 0)"),
    ],
    ("stage_pedidos_header", "t_header"): [
        ("SalesOrderID", _I, "count(id)"), ("CustomerID", _I, "count(customer)"), ("TerritoryID", _I, "count(territory)"),
        ("OrderDate", _TS, "count(moment)"), ("SalesPersonID", _I, "count(seller)"),
    ],
    ("stage_pedidos_detalhe", "t_detail"): [
        ("SalesOrderID", _I, "count(ord)"), ("SalesOrderDetailID", _I, "count(line)"), ("ProductID", _I, "count(product)"),
        ("OrderQty", _I, "count(qty)"), ("UnitPrice", _N, "count(price)"), ("UnitPriceDiscount", _N, "count(disc)"),
        ("SpecialOfferID", _I, "count(offer)"), ("SourceSupplier", _I, "count(*)"), ("SourceAmount", _D, "count(*)"),
        ("SourceTax", _D, "count(*)"), ("SourceShipDate", _TS, "count(*)"),
    ],
}


def _inferred(strict: bool) -> str:
    parts = []
    for (table, source), columns in STAGED_COLUMNS.items():
        for name, kind, filled in columns:
            if kind == "date":
                kind = _TS if strict else _T
            holds = f"{filled} = count(*)" if strict else f"{filled} > 0"
            parts.append(
                f"SELECT '{table}' AS \"table\", '{name}' AS \"column\", "
                f"CASE WHEN {holds} THEN '{kind}' ELSE 'TEXT' END AS \"type\" FROM {source}"
            )
    return sql("\nUNION ALL ".join(parts))


Q["infer_column_types"] = _inferred(False)
Q["infer_column_types_strict_null"] = _inferred(True)

_TEXT_SOURCE = """
SELECT CAST(o_orderkey AS VARCHAR) AS chave, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS total,
       o_orderpriority AS prioridade, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dia,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS momento, o_orderstatus AS status,
       CAST(CAST(trunc(CAST(o_totalprice AS DECIMAL(15,2))) AS BIGINT) AS VARCHAR) AS whole
FROM orders"""
_TEXT_COLUMNS = {
    "chave": "chave",
    "total": "total",
    "total_misto": "CASE status WHEN 'F' THEN whole ELSE total END",
    "total_float": "whole || 'e0'",
    "inteiro_ou_float": "CASE status WHEN 'F' THEN whole ELSE whole || 'e0' END",
    "prioridade": "prioridade",
    "dia": "dia",
    "momento": "momento",
    "fechado": "CASE status WHEN 'F' THEN 'true' ELSE 'false' END",
    "chave_ou_nada": "CASE status WHEN 'F' THEN chave END",
    "chave_ou_texto": "CASE status WHEN 'F' THEN chave ELSE status END",
    "vazio": "CAST(NULL AS VARCHAR)",
}


def _text_type(expression: str, strict: bool) -> str:
    date = _TS if strict else _T
    one = f"""CASE WHEN {expression} IS NULL THEN {"'TEXT'" if strict else 'NULL'}
        WHEN lower({expression}) IN ('true', 'false') THEN 'BOOLEAN'
        WHEN try_strptime({expression}, '%Y-%m-%d %H:%M:%S') IS NOT NULL THEN 'TIMESTAMP'
        WHEN try_strptime({expression}, '%Y-%m-%d') IS NOT NULL THEN '{date}'
        WHEN translate({expression}, '0123456789', '') = '' THEN 'INTEGER'
        WHEN translate({expression}, '0123456789', '') = '.' THEN 'NUMERIC(18,4)'
        WHEN translate({expression}, '0123456789', '') = 'e' THEN 'DOUBLE PRECISION'
        ELSE 'TEXT' END"""
    return (
        f"CASE WHEN count(DISTINCT {one}) = 1 THEN max({one}) "
        f"WHEN count(DISTINCT {one}) = 2 AND min({one}) = 'INTEGER' AND max({one}) = 'NUMERIC(18,4)' THEN 'NUMERIC(18,4)' "
        f"ELSE 'TEXT' END"
    )


Q["infer_column_types_text"] = sql(
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"column\", {_text_type(e, False)} AS \"type\", {_text_type(e, True)} AS strict_type FROM text_source"
        for name, e in _TEXT_COLUMNS.items()
    ),
    text_source=_TEXT_SOURCE,
)

# ---- calendar

Q["calendar_series"] = sql("""
SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS data_completa
FROM (SELECT unnest(generate_series(min(moment), max(moment), INTERVAL 1 DAY)) AS d FROM t_header) days""")

_PER_DAY = "SELECT CAST(strftime(moment, '%Y%m%d') AS BIGINT) AS day, count(*) AS n FROM t_header GROUP BY 1"

Q["dim_tempo"] = sql("""
SELECT t.* REPLACE (CAST(data_completa AS VARCHAR) AS data_completa), ifnull(n, 0) AS pedidos
FROM d_tempo t LEFT JOIN per_day ON day = sk_tempo""", per_day=_PER_DAY)

Q["dim_date_v1"] = sql("""
SELECT sk_tempo AS date_key, CAST(data_completa AS VARCHAR) AS full_date, ano AS "year", trimestre AS "quarter",
       mes AS "month", dia AS "day", nome_mes AS month_name, nome_dia_semana AS weekday_name, ifnull(n, 0) AS pedidos
FROM d_tempo LEFT JOIN per_day ON per_day.day = sk_tempo WHERE ano <= 2025""", per_day=_PER_DAY)

# ---- dimensions

Q["dim_cliente"] = sql(f"SELECT * EXCLUDE (sk_cliente), '{LOAD_DATE}' AS data_cadastro FROM d_cliente")
Q["dim_customer_v1"] = sql(f"""
SELECT c.id AS customer_id, first AS first_name, last AS last_name, first || ' ' || last AS full_name,
       CAST(NULL AS VARCHAR) AS email, '{LOAD_DATE}' AS create_date, CAST(NULL AS VARCHAR) AS update_date
FROM t_customer c LEFT JOIN t_person p ON p.id = c.person""")
_PRODUCT_OUT = """categoria_produto, subcategoria_produto, linha_produto, cor_produto, tamanho, CAST(0 AS DOUBLE) AS peso,
       CAST(custo_unitario AS DOUBLE) AS custo_unitario, CAST(preco_lista AS DOUBLE) AS preco_lista,
       CAST(margem_percentual AS DOUBLE) AS margem_percentual, '2008-01-01' AS data_inicio_vigencia, status_ativo"""
Q["dim_produto"] = sql(f"SELECT nk_produto, nome_produto, codigo_produto, {_PRODUCT_OUT} FROM d_produto")
CTE["v1_product"] = """
SELECT row_number() OVER (ORDER BY id) AS product_key, id AS product_id, name AS product_name, cat_name AS category,
       sub_name AS subcategory, CAST(model AS VARCHAR) AS model, color, size,
       CAST(cost AS DECIMAL(12,2)) AS standard_cost, CAST(price AS DECIMAL(12,2)) AS list_price
FROM t_placed"""
Q["dim_product_v1"] = sql(f"""
SELECT * EXCLUDE (product_key) REPLACE (CAST(standard_cost AS DOUBLE) AS standard_cost, CAST(list_price AS DOUBLE) AS list_price),
       '{LOAD_DATE}' AS start_date
FROM v1_product""")
Q["dim_regiao"] = sql("SELECT * EXCLUDE (sk_regiao) FROM d_regiao")
Q["dim_territory_v1"] = sql(
    "SELECT id AS territory_id, name AS territory_name, code AS country_region, grp AS group_name FROM t_territory"
)
Q["dim_vendedor"] = sql("""
SELECT * EXCLUDE (sk_vendedor) REPLACE (CAST(data_admissao AS VARCHAR) AS data_admissao,
       CAST(meta_anual AS DOUBLE) AS meta_anual, CAST(comissao_percentual AS DOUBLE) AS comissao_percentual)
FROM d_vendedor""")
Q["dim_sales_person_v1"] = sql("""
SELECT s.id AS sales_person_id, first || ' ' || last AS full_name, sk_regiao AS territory_key,
       CAST(hired AS VARCHAR) AS hire_date, CAST(quota AS DOUBLE) AS quota
FROM t_seller s LEFT JOIN t_person p ON p.id = s.id LEFT JOIN d_regiao ON nk_regiao = territory""")
Q["dim_oferta"] = sql("""
SELECT * EXCLUDE (sk_oferta) REPLACE (CAST(percentual_desconto AS DOUBLE) AS percentual_desconto) FROM d_oferta""")
Q["dim_promotion_v1"] = sql("""
SELECT nk_oferta AS promotion_id, descricao_oferta AS promotion_name, CAST(percentual_desconto AS DOUBLE) AS discount_pct,
       data_inicio AS start_date, data_fim AS end_date
FROM d_oferta""")

# ---- loading again

CTE["early_customer"] = "SELECT DISTINCT customer AS id FROM t_header WHERE moment < DATE '2008-04-01'"
CTE["early_seller"] = """
SELECT DISTINCT seller AS id FROM t_header WHERE moment < DATE '2008-04-01' AND seller IS NOT NULL"""
CTE["early_product"] = """
SELECT DISTINCT product AS id FROM t_detail JOIN t_header h ON h.id = ord WHERE moment < DATE '2008-04-01'"""
CTE["first_territory"] = "SELECT DISTINCT territory AS id FROM t_header WHERE moment < DATE '2008-01-02'"
CTE["first_offer"] = """
SELECT DISTINCT offer AS id FROM t_detail JOIN t_header h ON h.id = ord WHERE moment < DATE '2008-01-02'"""


def _renumbered(dim: str, nk: str, early: str) -> str:
    """Rows of `dim` with keys as two loads give them: the early ones first."""
    return f"""
SELECT d.*, e.id IS NOT NULL AS early, row_number() OVER (ORDER BY e.id IS NULL, d.{nk}) AS sk
FROM {dim} d LEFT JOIN {early} e ON e.id = d.{nk}"""


Q["surrogate_key_assign"] = sql(
    "SELECT nk_cliente, sk AS sk_cliente FROM numbered", numbered=_renumbered("d_cliente", "nk_cliente", "early_customer")
)
Q["scd1_upsert_cliente"] = sql(f"""
SELECT sk AS sk_cliente, nk_cliente, nome_cliente, sobrenome, nome_completo, tipo_cliente, segmento,
       CASE WHEN early THEN '{EARLIER_LOAD_DATE}' ELSE '{LOAD_DATE}' END AS data_cadastro
FROM numbered""", numbered=_renumbered("d_cliente", "nk_cliente", "early_customer"))
Q["scd1_upsert_produto"] = sql(f"""
SELECT sk AS sk_produto, nk_produto, nome_produto, codigo_produto,
       {_PRODUCT_OUT.replace('tamanho,', "CASE WHEN early THEN 'N/A' ELSE tamanho END AS tamanho,")},
       CAST(NULL AS VARCHAR) AS data_fim_vigencia
FROM numbered""", numbered=_renumbered("d_produto", "nk_produto", "early_product"))
Q["scd1_upsert_regiao"] = sql("""
SELECT sk AS sk_regiao, nk_regiao, nome_territorio, codigo_pais, nome_pais,
       CASE WHEN early THEN 'Europa' ELSE continente END AS continente, grupo_regional
FROM numbered""", numbered=_renumbered("d_regiao", "nk_regiao", "first_territory"))
Q["scd1_upsert_vendedor"] = sql("""
SELECT sk AS sk_vendedor, nk_vendedor, nome_vendedor, codigo_vendedor, sk_regiao,
       CAST(data_admissao AS VARCHAR) AS data_admissao, CAST(meta_anual AS DOUBLE) AS meta_anual,
       CAST(comissao_percentual AS DOUBLE) AS comissao_percentual, TRUE AS status_ativo
FROM numbered""", numbered=_renumbered("d_vendedor", "nk_vendedor", "early_seller"))
Q["scd1_upsert_oferta"] = sql("""
SELECT sk AS sk_oferta, nk_oferta, descricao_oferta, CASE WHEN early THEN 'Old' ELSE tipo_oferta END AS tipo_oferta,
       CAST(percentual_desconto AS DOUBLE) AS percentual_desconto, data_inicio, data_fim, quantidade_minima, quantidade_maxima
FROM numbered""", numbered=_renumbered("d_oferta", "nk_oferta", "first_offer"))
Q["scd1_upsert_v1"] = sql(f"""
SELECT sk AS product_key, product_id, product_name, category, subcategory, model, color, size,
       CAST(standard_cost AS DOUBLE) AS standard_cost, CAST(list_price AS DOUBLE) AS list_price,
       CASE WHEN early THEN '{EARLIER_LOAD_DATE}' ELSE '{LOAD_DATE}' END AS start_date
FROM numbered""", numbered=_renumbered("v1_product", "product_id", "early_product"))
Q["scd1_upsert_v1_customer"] = sql(f"""
SELECT sk AS customer_key, id AS customer_id, first AS first_name, last AS last_name, first || ' ' || last AS full_name,
       CAST(NULL AS VARCHAR) AS email, CASE WHEN early THEN '{EARLIER_LOAD_DATE}' ELSE '{LOAD_DATE}' END AS create_date,
       early AS updated
FROM numbered""", numbered=_renumbered(
    "(SELECT c.id, first, last FROM t_customer c LEFT JOIN t_person p ON p.id = c.person)", "id", "early_customer"))
Q["scd1_upsert_v1_territory"] = sql("""
SELECT sk AS territory_key, id AS territory_id, name AS territory_name, code AS country_region, grp AS group_name
FROM numbered""", numbered=_renumbered("t_territory", "id", "first_territory"))
Q["scd1_upsert_v1_sales_person"] = sql("""
SELECT sk AS sales_person_key, id AS sales_person_id, first || ' ' || last AS full_name, sk_regiao AS territory_key,
       CAST(hired AS VARCHAR) AS hire_date, CAST(quota AS DOUBLE) AS quota
FROM numbered""", numbered=_renumbered(
    "(SELECT s.id, first, last, sk_regiao, hired, quota FROM t_seller s LEFT JOIN t_person p ON p.id = s.id "
    "LEFT JOIN d_regiao ON nk_regiao = territory)", "id", "early_seller"))
Q["scd1_upsert_v1_promotion"] = sql("""
SELECT sk AS promotion_key, nk_oferta AS promotion_id, descricao_oferta AS promotion_name,
       CAST(percentual_desconto AS DOUBLE) AS discount_pct, data_inicio AS start_date, data_fim AS end_date
FROM numbered""", numbered=_renumbered("d_oferta", "nk_oferta", "first_offer"))

# ---- fact

Q["fact_header_detail"] = sql("""
SELECT ord AS numero_pedido, line AS numero_linha, product AS ProductID, qty::BIGINT AS OrderQty, price::DOUBLE AS UnitPrice,
       disc::DOUBLE AS UnitPriceDiscount, offer AS SpecialOfferID, customer AS CustomerID, territory AS TerritoryID,
       CAST(seller AS DOUBLE) AS SalesPersonID, CAST(strftime(moment, '%Y%m%d') AS BIGINT) AS sk_tempo
FROM t_detail JOIN t_header h ON h.id = ord""")
Q["fact_dim_lookup"] = sql("""
SELECT numero_pedido, numero_linha, sk_tempo, sk_cliente, sk_produto, sk_regiao,
       CAST(sk_vendedor AS DOUBLE) AS sk_vendedor, sk_oferta FROM f_line""")
_AMOUNTS = ["valor_unitario", "valor_bruto", "valor_desconto", "valor_liquido", "custo_total", "lucro_bruto",
            "percentual_desconto", "margem_contribuicao"]
Q["fact_measures"] = sql(f"""
SELECT numero_pedido, numero_linha, quantidade_vendida::BIGINT AS quantidade_vendida,
       {', '.join(f'{dbl(c)} AS {c}' for c in _AMOUNTS)}
FROM f""")
Q["fact_load"] = sql("""
SELECT numero_pedido, numero_linha, sk_produto, valor_liquido::DOUBLE AS valor_liquido, custo_total::DOUBLE AS custo_total,
       lucro_bruto::DOUBLE AS lucro_bruto, margem_contribuicao::DOUBLE AS margem_contribuicao
FROM f_old_costs""",
    line_old_costs="""
SELECT * REPLACE (CASE WHEN moment < DATE '2011-01-01' THEN CAST(cost * 0.9::DECIMAL(2,1) AS DECIMAL(15,4)) ELSE cost END AS cost)
FROM f_line""",
    f_old_costs=_measured("line_old_costs"))
Q["fact_load_idempotent"] = sql("""
SELECT 1::BIGINT AS carga, count(*) AS linhas_novas FROM f_line
UNION ALL SELECT 2::BIGINT, count(*) - count(DISTINCT (numero_pedido, numero_linha)) FROM f_line""")
Q["fact_load_stats"] = sql("""
SELECT count(*) AS total_vendas, sum(valor_liquido)::DOUBLE AS receita, sum(lucro_bruto)::DOUBLE AS lucro FROM f""")
Q["fact_sales_v1"] = sql("""
SELECT sk_tempo AS date_key, sk_cliente AS customer_key, sk_produto AS product_key, sk_regiao AS territory_key,
       CAST(sk_vendedor AS DOUBLE) AS sales_person_key, sk_oferta AS promotion_key, numero_pedido AS order_id, numero_linha AS order_line,
       qty::BIGINT AS quantity, cents::DOUBLE AS unit_price, CAST(cents * qty AS DOUBLE) AS extended_price,
       CAST(CAST(cents * qty * disc AS DECIMAL(18,4)) AS DOUBLE) AS discount_amount,
       CAST(CAST(cents * qty * (1 - disc) AS DECIMAL(18,4)) AS DOUBLE) AS total_amount,
       CAST(standard_cost * qty AS DOUBLE) AS cost_amount,
       CAST(CAST(cents * qty * (1 - disc) - standard_cost * qty AS DECIMAL(18,4)) AS DOUBLE) AS margin_amount
FROM rounded""", rounded="""
SELECT f_line.*, CAST(price AS DECIMAL(12,2)) AS cents, standard_cost FROM f_line LEFT JOIN v1_product ON product_key = sk_produto""")
_WAREHOUSE_TABLES = {"dim_tempo": "d_tempo", "dim_regiao": "d_regiao", "dim_cliente": "d_cliente", "dim_produto": "d_produto",
                     "dim_vendedor": "d_vendedor", "dim_oferta": "d_oferta", "fato_vendas": "f"}
_STAGE_TABLES = {"stage_clientes": "t_customer", "stage_pessoas": "t_person", "stage_produtos": "t_product",
                 "stage_subcategorias": "t_sub", "stage_categorias": "t_cat", "stage_territorios": "t_territory",
                 "stage_vendedores": "t_seller", "stage_funcionarios": "t_seller", "stage_ofertas": "t_offer",
                 "stage_pedidos_header": "t_header", "stage_pedidos_detalhe": "t_detail"}
Q["pipeline_summary"] = sql("\nUNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(*) AS \"rows\" FROM {source}"
    for name, source in {**_STAGE_TABLES, **_WAREHOUSE_TABLES}.items()))

# ---- checks

_KEYS = {"dim_tempo": ("sk_tempo", "data_completa"), "dim_regiao": ("sk_regiao", "nk_regiao"),
         "dim_cliente": ("sk_cliente", "nk_cliente"), "dim_produto": ("sk_produto", "nk_produto"),
         "dim_vendedor": ("sk_vendedor", "nk_vendedor"), "dim_oferta": ("sk_oferta", "nk_oferta")}


def _repeated(table: str, source: str, label: str, columns: str) -> str:
    return f"""SELECT '{table}' AS "table", '{label}' AS "key", count(*) AS repeated_keys,
       CAST(ifnull(sum(n - 1), 0) AS BIGINT) AS rows_too_many
FROM (SELECT count(*) AS n FROM {source} GROUP BY {columns} HAVING count(*) > 1) r"""


Q["dq_unique"] = sql("\nUNION ALL ".join(
    [_repeated(t, _WAREHOUSE_TABLES[t], k, k) for t, keys in _KEYS.items() for k in keys]
    + ["SELECT 'fato_vendas', 'sk_venda', 0::BIGINT, 0::BIGINT",
       _repeated("fato_vendas", "f_line", "numero_pedido+numero_linha", "numero_pedido, numero_linha"),
       _repeated("stage_pedidos_detalhe", "t_detail", "SalesOrderID+SalesOrderDetailID", "ord, line")]))

_REQUIRED = {
    "dim_tempo": ["sk_tempo", "data_completa", "ano", "trimestre", "mes", "dia"],
    **{t: list(k) for t, k in _KEYS.items() if t != "dim_tempo"},
    "fato_vendas": ["sk_venda", "sk_tempo", "sk_cliente", "sk_produto", "numero_pedido", "numero_linha", "quantidade_vendida",
                    "valor_unitario", "valor_bruto", "valor_desconto", "valor_liquido", "custo_total", "lucro_bruto",
                    "sk_regiao", "sk_vendedor", "sk_oferta"],
}
Q["dq_not_null"] = sql("\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) AS \"rows\", "
    f"{'0::BIGINT' if c == 'sk_venda' else f'count(*) - count({c})'} AS missing FROM {_WAREHOUSE_TABLES[t]}"
    for t, columns in _REQUIRED.items() for c in columns))


def _orphans(table: str, source: str, column: str, expr: str, target: str, target_source: str, key: str) -> str:
    return f"""SELECT '{table}' AS "table", '{column}' AS "column", '{target}' AS target, count({expr}) AS "references",
       count({expr}) FILTER ({expr} NOT IN (SELECT k.{key} FROM {target_source} k)) AS orphans
FROM {source}"""


Q["dq_foreign_keys"] = sql("\nUNION ALL ".join(
    [_orphans("dim_vendedor", "d_vendedor", "sk_regiao", "sk_regiao", "dim_regiao", "d_regiao", "sk_regiao")]
    + [_orphans("fato_vendas", "f_line", k, k, t, _WAREHOUSE_TABLES[t], k)
       for t, (k, _) in _KEYS.items()]
    + [_orphans("stage_clientes", "t_customer", "StoreID", "store", "stage_vendedores", "t_seller", "id"),
       _orphans("stage_vendedores", "t_seller", "BusinessEntityID", "id", "stage_pessoas", "t_person", "id")]))

Q["dq_date_range"] = sql("\nUNION ALL ".join([
    _orphans("fato_vendas", "f_line", "sk_tempo", "sk_tempo", "dim_tempo", "d_tempo", "sk_tempo"),
    _orphans("orders", "raw_days", "sk_tempo", "day", "dim_tempo", "d_tempo", "sk_tempo")]),
    raw_days="SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS day FROM orders")

_DECIMALS = {"valor_unitario": (15, 4), "valor_bruto": (18, 4), "valor_desconto": (18, 4), "valor_liquido": (18, 4),
             "custo_total": (18, 4), "lucro_bruto": (18, 4), "percentual_desconto": (5, 2), "margem_contribuicao": (5, 2)}
Q["dq_numeric_overflow"] = sql("\nUNION ALL ".join(
    [f"""SELECT 'fato_vendas' AS "table", '{c}' AS "column", 'decimal({p},{s})' AS "type", count({c}) AS "values",
       count(*) FILTER (abs({c}) >= 10::HUGEINT ** {p - s}) AS overflows FROM f""" for c, (p, s) in _DECIMALS.items()]
    + ["""SELECT 'lineitem', 'margem_contribuicao', 'decimal(5,2)', count(pct), count(*) FILTER (abs(pct) >= 999.995) FROM raw_margin""",
       """SELECT 'lineitem', 'preco', 'decimal(6,2)', count(price), count(*) FILTER (abs(price) >= 10000) FROM raw_margin"""]),
    raw_margin="""
SELECT CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
       (CAST(l_extendedprice AS DECIMAL(18,2)) - cost * CAST(l_quantity AS INTEGER)) / CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS pct
FROM lineitem LEFT JOIN t_product ON id = l_partkey""")

_LIMITS = {
    "dim_tempo": {"nome_mes": 20, "nome_dia_semana": 20},
    "dim_regiao": {"nome_territorio": 100, "codigo_pais": 10, "nome_pais": 100, "continente": 50, "grupo_regional": 100},
    "dim_cliente": {"nome_cliente": 150, "sobrenome": 100, "nome_completo": 250, "tipo_cliente": 30, "segmento": 50},
    "dim_produto": {"nome_produto": 150, "codigo_produto": 50, "categoria_produto": 100, "subcategoria_produto": 100,
                    "linha_produto": 50, "cor_produto": 30, "tamanho": 20},
    "dim_vendedor": {"nome_vendedor": 150, "codigo_vendedor": 50},
    "dim_oferta": {"descricao_oferta": 200, "tipo_oferta": 50},
    "part": {"p_name": 10, "p_brand": 7},
}
Q["dq_text_length"] = sql("\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", {n}::BIGINT AS allowed, max(length({c})) AS longest, "
    f"count(*) FILTER (length({c}) > {n}) AS overlong FROM {_WAREHOUSE_TABLES.get(t, t)}"
    for t, columns in _LIMITS.items() for c, n in columns.items()))

Q["dq_row_counts"] = sql("\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", (SELECT count(*) FROM {s}) AS \"rows\", ({e}) AS expected, "
    f"(SELECT count(*) FROM {s}) = ({e}) AS as_expected"
    for t, s, e in [
        ("dim_tempo", "d_tempo", "SELECT date_diff('day', DATE '2008-01-01', DATE '2031-01-01')"),
        ("dim_regiao", "d_regiao", "SELECT count(*) FROM nation"),
        ("dim_cliente", "d_cliente", "SELECT count(*) FROM customer"),
        ("dim_produto", "d_produto", "SELECT count(*) FROM part"),
        ("dim_vendedor", "d_vendedor", "SELECT count(*) FROM supplier"),
        ("dim_oferta", "d_oferta", "SELECT count(DISTINCT l_discount) FROM lineitem"),
        ("fato_vendas", "f_line", "SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) x"),
    ]))

# ---- reports

_BAND = """CASE WHEN {0} = 0 THEN 'Sem Desconto' WHEN {0} <= 10 THEN '1-10%' WHEN {0} <= 20 THEN '11-20%'
            WHEN {0} <= 30 THEN '21-30%' ELSE 'Acima de 30%' END"""
# Classes and their bounds, in the order the model states them.
_ABC = "CASE WHEN {0} <= 80 THEN 'A - Alto Valor' WHEN {0} <= 95 THEN 'B - Médio Valor' ELSE 'C - Baixo Valor' END"
_CLASS = """CASE WHEN {0} >= 50000 THEN 'VIP' WHEN {0} >= 20000 THEN 'Premium' WHEN {0} >= 5000 THEN 'Regular' ELSE 'Basico' END"""
_ORDERS = "count(DISTINCT numero_pedido)"
_NET, _PROFIT = "sum(valor_liquido)", "sum(lucro_bruto)"
_MARGIN = dbl(avg2("margem_contribuicao"))
_UNITS = "CAST(sum(qty) AS BIGINT)"

Q["kpi1_product_margin"] = sql(f"""
SELECT categoria_produto, subcategoria_produto, nome_produto, {_ORDERS} AS total_pedidos,
       {_UNITS} AS quantidade_total_vendida, {dbl(_NET)} AS receita_liquida, {dbl(_PROFIT)} AS lucro_bruto,
       {_MARGIN} AS margem_contribuicao_media_pct, {dbl(pct(_PROFIT, _NET))} AS rentabilidade_pct
FROM (SELECT * FROM f WHERE valor_liquido > 0) x JOIN d_produto USING (sk_produto)
GROUP BY 1, 2, 3 HAVING {_NET} > 1000 ORDER BY 8 DESC NULLS FIRST, 1, 2, 3 LIMIT 20""")
Q["kpi2_discount_bands"] = sql(f"""
SELECT {_BAND.format('percentual_desconto')} AS faixa_desconto, count(*) AS numero_transacoes, {_UNITS} AS unidades_vendidas,
       {money('sum(valor_bruto)')} AS valor_bruto_total, {money('sum(valor_desconto)')} AS desconto_concedido,
       {money(_NET)} AS receita_liquida, {money(_PROFIT)} AS lucro_total, {_MARGIN} AS margem_media_pct,
       {dbl(pct('sum(valor_desconto)', 'sum(valor_bruto)'))} AS taxa_desconto_media_pct
FROM f GROUP BY 1 ORDER BY 1""")
Q["kpi3_seller_quota"] = sql(f"""
SELECT grupo_regional, nome_territorio, nome_vendedor, {dbl('meta_anual')} AS meta_anual, {_ORDERS} AS total_vendas,
       {money(_NET)} AS receita_gerada, {money(_PROFIT)} AS lucro_gerado,
       {dbl(pct(_NET, 'meta_anual'))} AS percentual_meta_atingido, {dbl(per(_NET, _ORDERS))} AS ticket_medio_vendedor,
       {_MARGIN} AS margem_media_pct
FROM f JOIN (SELECT sk_vendedor, nome_vendedor, meta_anual FROM d_vendedor WHERE meta_anual > 0) v USING (sk_vendedor)
JOIN d_regiao USING (sk_regiao)
GROUP BY grupo_regional, nome_territorio, nome_vendedor, v.meta_anual
ORDER BY receita_gerada DESC NULLS FIRST, 1, 2, 3, 4 LIMIT 15""")
Q["kpi4_monthly_trend"] = sql(f"""
SELECT ano, mes, nome_mes, {money(_NET)} AS receita_mensal, {money(_PROFIT)} AS lucro_mensal,
       {dbl(pct(_PROFIT, _NET))} AS margem_lucro_pct, {_ORDERS} AS pedidos_mes, count(DISTINCT sk_cliente) AS clientes_unicos,
       {dbl(per(_NET, _ORDERS))} AS ticket_medio
FROM f JOIN d_tempo USING (sk_tempo) GROUP BY ano, mes, nome_mes ORDER BY ano DESC, mes DESC LIMIT 12""")
CTE["by_product"] = """
SELECT sk_produto, sum(valor_liquido) AS net, CAST(sum(qty) AS BIGINT) AS units FROM f GROUP BY 1"""
CTE["curve"] = f"""
SELECT sk_produto, nome_produto, categoria_produto, net, units,
       {pct('sum(net) OVER (ORDER BY net DESC RANGE UNBOUNDED PRECEDING)', 'sum(net) OVER ()')} AS upto
FROM by_product JOIN d_produto USING (sk_produto)"""
_CURVE_OUT = f"""SELECT nome_produto, categoria_produto, {money('net')} AS receita, units AS quantidade_vendida,
       {dbl('upto')} AS percentual_acumulado, {_ABC.format('upto')} AS classificacao_abc FROM curve"""
Q["kpi5_abc_top30"] = sql(f"{_CURVE_OUT} ORDER BY net DESC, sk_produto LIMIT 30")
Q["kpi5_abc_all"] = sql(_CURVE_OUT)
Q["kpi6_geography"] = sql(f"""
SELECT continente, grupo_regional, nome_territorio, count(DISTINCT sk_cliente) AS total_clientes, {_ORDERS} AS total_pedidos,
       {_UNITS} AS unidades_vendidas, {money(_NET)} AS receita_total, {money(_PROFIT)} AS lucro_total,
       {_MARGIN} AS margem_media_pct,
       {dbl(pct(_NET, '(SELECT sum(valor_liquido) FROM f JOIN d_regiao USING (sk_regiao))'))} AS participacao_receita_pct,
       {dbl(per(_NET, _ORDERS))} AS ticket_medio_regiao
FROM f JOIN d_regiao USING (sk_regiao) GROUP BY 1, 2, 3 ORDER BY receita_total DESC NULLS FIRST, 1, 2, 3 LIMIT 15""")
Q["kpi7_category"] = sql(f"""
SELECT categoria_produto, count(DISTINCT sk_produto) AS total_produtos_categoria, {_ORDERS} AS total_transacoes,
       {_UNITS} AS unidades_vendidas, {money(_NET)} AS receita_categoria, {money('sum(custo_total)')} AS custo_categoria,
       {money(_PROFIT)} AS lucro_categoria, {dbl(pct(_PROFIT, _NET))} AS margem_lucro_pct,
       {dbl(per(_NET, 'count(DISTINCT sk_produto)'))} AS receita_media_produto,
       CAST(sum(qty) // count(DISTINCT sk_produto) AS BIGINT) AS giro_medio_produto,
       {dbl(pct(_NET, '(SELECT sum(valor_liquido) FROM f JOIN d_produto USING (sk_produto))'))} AS participacao_receita_total_pct
FROM f JOIN d_produto USING (sk_produto) GROUP BY 1 ORDER BY receita_categoria DESC NULLS FIRST, 1""")
Q["kpi8_customer_value"] = sql(f"""
SELECT tipo_cliente, segmento, count(DISTINCT sk_cliente) AS total_clientes, {money(_NET)} AS receita_total,
       {money(_PROFIT)} AS lucro_total, {dbl(per(_NET, 'count(DISTINCT sk_cliente)'))} AS receita_media_por_cliente,
       {dbl(per(_PROFIT, 'count(DISTINCT sk_cliente)'))} AS lucro_medio_por_cliente,
       {dbl(per(_ORDERS, 'count(DISTINCT sk_cliente)'))} AS pedidos_por_cliente,
       {dbl(avg2('valor_liquido'))} AS ticket_medio,
       {_CLASS.format(f'{_NET} / count(DISTINCT sk_cliente)')} AS categoria_segmento
FROM f JOIN d_cliente USING (sk_cliente) GROUP BY 1, 2 ORDER BY receita_total DESC""")
Q["kpi9_seasonality"] = sql(f"""
SELECT trimestre, nome_dia_semana, eh_fim_semana, {_ORDERS} AS total_vendas, {_UNITS} AS unidades_vendidas,
       {money(_NET)} AS receita_total, {dbl(avg2('valor_liquido'))} AS valor_medio_transacao, {money(_PROFIT)} AS lucro_total,
       {_MARGIN} AS margem_media_pct
FROM f JOIN d_tempo USING (sk_tempo) GROUP BY 1, 2, 3, dia_semana ORDER BY 1, (dia_semana + 6) % 7""")
Q["kpi10_top_products"] = sql(f"""
SELECT categoria_produto, nome_produto, {_ORDERS} AS total_pedidos, {_UNITS} AS quantidade_vendida,
       {money(_NET)} AS receita_total, {money(_PROFIT)} AS lucro_total, {_MARGIN} AS margem_media_pct,
       {dbl(per(_NET, 'sum(qty)'))} AS preco_medio_unitario
FROM f JOIN d_produto USING (sk_produto) GROUP BY 1, 2 ORDER BY receita_total DESC NULLS FIRST, 1, 2 LIMIT 10""")

# ---- findings

Q["headline_top_product"] = sql(f"""
SELECT categoria_produto, nome_produto, {money(_NET)} AS receita_total
FROM f JOIN d_produto USING (sk_produto) GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 1""")
_SHARE1 = "CAST(round(CAST(1000 * {0} AS DECIMAL(38,6)) / count(*)) / 10 AS DOUBLE)"
Q["headline_no_seller_share"] = sql(f"""
SELECT count(*) AS vendas, count(*) - count(sk_vendedor) AS sem_vendedor,
       {_SHARE1.format('(count(*) - count(sk_vendedor))')} AS sem_vendedor_pct FROM f""")
Q["headline_negative_margin_share"] = sql(f"""
SELECT count(*) AS vendas, count(*) FILTER (margem_contribuicao < 0) AS margem_negativa,
       {_SHARE1.format('count(*) FILTER (margem_contribuicao < 0)')} AS margem_negativa_pct FROM f""")
Q["headline_best_subcategory"] = sql(f"""
SELECT subcategoria_produto, {money(_NET)} AS receita, {money(_PROFIT)} AS lucro, {dbl(pct(_PROFIT, _NET))} AS margem_pct
FROM f JOIN d_produto USING (sk_produto) GROUP BY 1 ORDER BY 4 DESC NULLS LAST, 1 LIMIT 1""")
Q["headline_discount_over_10"] = sql(f"""
SELECT percentual_desconto > 10 AS desconto_acima_10, count(*) AS vendas, {money(_NET)} AS receita, {money(_PROFIT)} AS lucro,
       {dbl(pct(_PROFIT, _NET))} AS margem_pct FROM f GROUP BY 1 ORDER BY 1""")
Q["headline_totals"] = sql(f"""
SELECT count(*) AS vendas, min(sk_tempo) AS primeira_data, max(sk_tempo) AS ultima_data, {money(_NET)} AS receita FROM f""")

# ---- scalar functions

Q["scalar_nulls"] = sql("""
SELECT id AS CustomerID, coalesce(person, store, -1) AS primeiro_id, CAST(nullif(id % 3, 0) AS DOUBLE) AS resto_ou_nulo,
       person IS NULL AS sem_pessoa, store IS NOT NULL AS com_loja FROM t_customer""")
Q["scalar_case"] = f"""
SELECT {_BAND.format('(CAST(l_discount AS DECIMAL(4,2)) * 500)')} AS faixa,
       CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS BIGINT) AS devolucao,
       {_ABC.format('(l_quantity * 2)')} AS classe, {_CLASS.format('l_extendedprice')} AS segmento, count(*) AS linhas
FROM lineitem GROUP BY 1, 2, 3, 4"""
Q["scalar_numeric"] = f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey,
       CAST(round(p * (1 - d) * 0.5::DECIMAL(2,1), 2) AS DOUBLE) AS metade_liquida,
       CAST(round(-p * d * 0.05::DECIMAL(3,2), 2) AS DOUBLE) AS negativo,
       CAST(p + q - d AS DOUBLE) AS soma, {dbl(per('p', 'q'))} AS por_unidade, CAST(d * 100 AS DOUBLE) AS desconto_pct,
       l_partkey // q AS divisao_inteira
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(15,2)) AS p, CAST(l_discount AS DECIMAL(4,2)) AS d,
             CAST(l_quantity AS INTEGER) AS q FROM lineitem) x"""
Q["scalar_strings"] = """
SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'Produto ' || p_partkey ELSE p_type || ' ' || p_name END AS nome,
       'V' || lpad(CAST(p_partkey * 1000 AS VARCHAR), 5, '0') AS codigo, lpad(p_name, 12, '.') AS nome_12,
       contains(p_name, 'ring') AS tem_ring, contains(p_name, 'Ring') AS tem_ring_maiusculo, length(p_name) AS tamanho,
       CAST(p_partkey AS VARCHAR) AS texto FROM part"""
Q["scalar_dates"] = sql("""
SELECT id AS SalesOrderID, CAST(CAST(moment AS DATE) AS VARCHAR) AS dia, CAST(year(moment) AS BIGINT) AS ano,
       CAST(quarter(moment) AS BIGINT) AS trimestre, CAST(month(moment) AS BIGINT) AS mes, CAST(day(moment) AS BIGINT) AS dia_mes,
       CAST(weekofyear(moment) AS BIGINT) AS semana, CAST(dayofweek(moment) AS BIGINT) AS dia_semana,
       CAST(strftime(moment, '%Y%m%d') AS BIGINT) AS chave, monthname(moment) AS nome_mes, dayname(moment) AS nome_dia,
       CAST(isodow(moment) AS BIGINT) AS posicao, CAST(CAST(moment AS DATE) + 1 AS VARCHAR) AS dia_seguinte
FROM t_header""")
Q["scalar_casts"] = """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS inteiro,
       CAST(l_linenumber AS BIGINT) AS curto, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS dia, CAST(l_partkey AS VARCHAR) AS texto,
       CAST(CAST(l_extendedprice AS DECIMAL(15,4)) AS DOUBLE) AS numerico_15_4,
       CAST(CAST(CAST(l_extendedprice AS DECIMAL(15,4)) * 0.125::DECIMAL(4,3) AS DECIMAL(18,2)) AS DOUBLE) AS numerico_18_2,
       CAST(CAST(l_partkey AS VARCHAR) AS BIGINT) AS texto_inteiro
FROM lineitem"""


def oracle_queries() -> dict[str, str]:
    return dict(Q)
