import zlib

import corpus_pipeline
import numpy as np

from salesmill.llm.pii import redacted
from tests.llm.test_decontaminate import expected as contaminated
from tests.llm.test_jaccard import components
from tests.llm.test_packing import ids_of
from tests.llm.conftest import prose


def test_stages_equal_brute_force(documents, spark, tmp_path):
    passage = prose(7, 12)
    rows = [(k, prose(k, 20 + k), "en") for k in range(30)]
    rows += [(100, rows[3][1], "en"), (101, rows[4][1].upper(), "en"), (102, prose(5, 25) + " extra", "en")]
    rows += [(103, "one " + passage + " two", "en"), (104, "write to jo (at) mill dot org or a@b.co today", "en")]
    rows += [(105, None, None), (106, "12 .. 34", "en"), (107, "", None)]
    docs = documents(rows, extra=True)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items = [(1, passage)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    kept = [(d, t) for d, t, _ in rows if any(c.isalpha() for c in t or "")]
    kept = [(d, t) for (d, t), (_, _, c) in zip(kept, components(kept)) if c == d]
    kept = [(d, t) for d, t in kept if not contaminated([(d, t)], items)[0][5]]
    kept = {d: redacted(t) for d, t in kept}
    assert 100 not in kept and 101 not in kept and 103 not in kept and "[email] or [email]" in kept[104]

    stage_docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        stage_docs = stage(spark, stage_docs, str(tmp_path))
        assert stage_docs.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in stage_docs.collect()} == {d: (t, len(t)) for d, t in kept.items()}

    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} == set(kept)
    for r in found:
        ids = np.array(ids_of(kept[r.doc_id]), np.uint32)
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert sum(r.length for r in found) == sum(len(ids_of(t)) for t in kept.values())


def test_stages_as_dealt():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontamination", "personal_data", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_queries_are_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline", *(f"op{n}" for n in range(1, 14))} <= {n.split("_")[0] for n in names}
    assert set(entry.oracle_sql()) <= names


def test_sql_equals_the_query(spark):
    import duckdb

    from salesmill.llm import queries
    from salesmill.llm.oracle import ORACLE

    folder, con = "/root/testdata/sf0.001", duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    for name, sql in ORACLE.items():
        expected = con.execute(sql).fetchall()
        columns = [d[0] for d in con.description]
        assert sorted(tuple(r) for r in queries.build_queries()[name](spark, folder).select(*columns).collect()) == sorted(expected)
