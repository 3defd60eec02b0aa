"""The load, step by step: calendar, staging, five dimensions, fact.

The driver only orders the steps; each step is one or a few Spark jobs that end in a published
table. A failed check raises before the publish, so the version before it stays current.
Regions come before sellers, because sellers refer to them.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from salesmill.operators.quality import counters, enforce, enforce_keys
from salesmill.operators.staging import stage_all
from salesmill.operators.upsert import insert_if_empty, part_of, reject_duplicates, type1_upsert, upsert_changes
from salesmill.plans import dimensions as dim
from salesmill.plans.calendar import build_dim_tempo
from salesmill.plans.fact import build_fact, fact_load_stats, month_of_sale
from salesmill.plans.store import PART, LoadedKeys, Warehouse
from salesmill.schemas import DIM_TEMPO, FACT_PARTITION, FATO_VENDAS, TABLES, Table, conform, with_stored_types
from salesmill.session import in_parallel, written

log = logging.getLogger("salesmill")

DIMENSIONS = ("dim_tempo", "dim_regiao", "dim_cliente", "dim_produto", "dim_vendedor", "dim_oferta")


#: Rows of a dimension that share a part; only parts with changes are written again.
PART_ROWS = 1 << 22


def _enforce_keys(wh: Warehouse, table: Table, rows: DataFrame) -> None:
    targets = {}
    for name, _ in table.references.values():
        found = wh.read(name, TABLES[name].schema)
        targets[name] = wh.spark.createDataFrame([], TABLES[name].schema) if found is None else found
    enforce_keys(rows, table, targets)


def _prepare_checked(wh: Warehouse, table: Table, df: DataFrame, partition_by: str | None = None):
    """Write rows of a table and check every constraint on what was written; nothing is published yet."""
    prepared, counted = wh.prepare(table.name, df, counters(table), partition_by)
    enforce(table, counted)
    _enforce_keys(wh, table, wh.read_prepared(prepared, table.schema))
    return prepared


def _publish_checked(wh: Warehouse, table: Table, df: DataFrame) -> None:
    prepared = _prepare_checked(wh, table, conform(df, table))
    wh.publish(table.name, [prepared.name])


def load_calendar(wh: Warehouse) -> None:
    existing = wh.read(DIM_TEMPO.name, DIM_TEMPO.schema)
    rows = insert_if_empty(existing, build_dim_tempo(wh.spark))
    if rows is not existing:
        _publish_checked(wh, DIM_TEMPO, rows)


def load_dimension(wh: Warehouse, table: Table, incoming: DataFrame) -> None:
    """Upsert a batch, writing only the parts of the table that change.

    Rows are dealt into parts by a hash of their natural key. One comparison of both sides tells which
    parts have new or changed keys; the others, and a table without any, are left as they are. Parts
    become more when the table has outgrown them, which writes it anew.
    """
    nk, now = table.natural[0], wh.pointer(table.name)
    batch = written(with_stored_types(incoming, table), table.name)
    parts, last, concerned, existing = now.notes.get("parts", 0), 0, None, None
    if now.version:
        stored = wh.read(table.name, table.schema)
        found = upsert_changes(stored, batch, nk, table.surrogate, table.updates, table.stamp, parts).first()
        rows, last, concerned, repeated = found["rows"], found["last"], set(found["parts"]), found["repeated"]
        if not concerned and not repeated:
            return
    else:
        rows, repeated = batch.count(), 1
    if repeated:  # also unknown before the first load
        reject_duplicates(batch, table.natural, table.name)
    wanted = max(1, -(-rows // PART_ROWS))
    if wanted > 2 * parts:
        parts, concerned = wanted, None
    if now.version:
        existing = wh.read(table.name, table.schema, concerned)
    if concerned is not None:
        batch = batch.where(part_of(nk, parts).isin(list(concerned)))
    merged = type1_upsert(existing, batch, nk, table.surrogate, table.updates, table.stamp, table.defaults, last)
    dealt = conform(merged, table).withColumn(PART, part_of(nk, parts))
    prepared = _prepare_checked(wh, table, dealt, PART)
    kept = [] if concerned is None else [f for f in now.folders if int(f.rsplit("=", 1)[1]) not in concerned]
    wh.publish(table.name, [*kept, *wh.parts_of(prepared)], {"parts": parts})


def load_dimensions(wh: Warehouse, src: Mapping[str, DataFrame], load_date: str | None = None) -> None:
    """Calendar and all five; those that do not refer to each other are loaded side by side."""
    persons = src["stage_pessoas"]

    def regions_then_sellers():
        load_dimension(wh, TABLES["dim_regiao"], dim.build_dim_regiao(src["stage_territorios"]))
        sellers = dim.build_dim_vendedor(
            src["stage_vendedores"], src["stage_funcionarios"], persons, wh.read("dim_regiao", TABLES["dim_regiao"].schema)
        )
        load_dimension(wh, TABLES["dim_vendedor"], sellers)

    def customers():
        load_dimension(wh, TABLES["dim_cliente"], dim.build_dim_cliente(src["stage_clientes"], persons, load_date))

    def products():
        built = dim.build_dim_produto(
            src["stage_produtos"], src["stage_subcategorias"], src["stage_categorias"], load_date
        )
        load_dimension(wh, TABLES["dim_produto"], built)

    def offers():
        load_dimension(wh, TABLES["dim_oferta"], dim.build_dim_oferta(src["stage_ofertas"]))

    in_parallel(wh.spark, [partial(load_calendar, wh), regions_then_sellers, customers, products, offers])


def with_partition(fact: DataFrame) -> DataFrame:
    return fact.withColumn(FACT_PARTITION, month_of_sale())


def load_fact(
    wh: Warehouse, detail: DataFrame, header: DataFrame, order: Sequence[str] | None = None
) -> int:
    """Add the lines not loaded yet; returns their number.

    Loaded keys are joined where they lie; only the batch is shuffled. Rows are rebalanced by month before
    the write: few files per month, and a month too big for one task is split. `sk_venda` is unique and grows
    from load to load, and needs no shuffle.
    """
    now = wh.pointer(FATO_VENDAS.name)
    keys = loaded_keys(wh)
    loaded = keys.read(now.folders) if now.folders else None
    fresh = build_fact(detail, header, read_dims(wh), loaded, order, months=True)
    last = now.notes.get("last", 0)
    numbered = fresh.withColumn(
        "sk_venda", F.lit(last + 1).cast("bigint") + F.monotonically_increasing_id()
    )
    rows = with_partition(conform(numbered, FATO_VENDAS))
    counts = {**counters(FATO_VENDAS), "last": F.max("sk_venda")}
    prepared, counted = wh.prepare(FATO_VENDAS.name, rows, counts, FACT_PARTITION)
    last = counted.pop("last")
    enforce(FATO_VENDAS, counted)
    if not counted["rows"]:
        wh.discard(prepared)
        return 0
    # Lines that earlier loads brought were dropped, so a key can only repeat among the added rows.
    added = wh.read_prepared(prepared, _fact_schema())
    # Keys of a folder that fails its check are never read.
    in_parallel(wh.spark, [partial(_enforce_keys, wh, FATO_VENDAS, added), partial(keys.add, prepared.name, added)])
    wh.publish(FATO_VENDAS.name, [*now.folders, prepared.name], {"last": last, "buckets": keys.buckets})
    return counted["rows"]


def loaded_keys(wh: Warehouse) -> LoadedKeys:
    """The keys of all loaded lines; they keep the number of buckets they got first."""
    buckets = wh.pointer(FATO_VENDAS.name).notes.get("buckets") or int(wh.spark.conf.get("spark.sql.shuffle.partitions"))
    return LoadedKeys(wh.spark, f"{wh.root}/{FATO_VENDAS.name}_keys-{buckets}", FATO_VENDAS.natural, buckets)


def read_dims(wh: Warehouse) -> dict[str, DataFrame]:
    """Published dimensions; one never loaded reads as an empty table of its schema."""
    return {
        name: wh.read(name, TABLES[name].schema) or wh.spark.createDataFrame([], TABLES[name].schema)
        for name in DIMENSIONS
    }


def _fact_schema() -> StructType:
    return FATO_VENDAS.schema.add(FACT_PARTITION, IntegerType())


def read_fact(wh: Warehouse) -> DataFrame:
    schema = _fact_schema()
    return wh.read(FATO_VENDAS.name, schema) or wh.spark.createDataFrame([], schema)


def run_pipeline(
    spark: SparkSession,
    source: Mapping[str, DataFrame],
    root: str,
    stage: bool = True,
    load_date: str | None = None,
    order: Sequence[str] | None = None,
) -> Warehouse:
    """Load everything from `source` (staging name -> DataFrame) into the warehouse at `root`.

    `stage=False` reads the source directly, for sources that are already columnar files in the
    same lake; a copy would only double the read.
    """
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("spark.sql.ansi.enabled must be on: a value that does not fit must stop the load")
    wh = Warehouse(spark, root)
    src = stage_all(spark, source, f"{root}/staging") if stage else source
    load_dimensions(wh, src, load_date)
    added = load_fact(wh, src["stage_pedidos_detalhe"], src["stage_pedidos_header"], order)
    log.info("%s lines added", added)
    return wh


def load_report(wh: Warehouse) -> DataFrame:
    return fact_load_stats(read_fact(wh))
