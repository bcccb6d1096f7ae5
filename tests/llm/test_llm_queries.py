"""Registered queries: SQL comparison, and the pipeline against a direct version."""
import duckdb
import pytest
from llm_cases import documents, prose

import corpus_pipeline
from tidewatch.llm import decontam, toxicity
from tidewatch.llm.registry import ORACLE, QUERIES
from tidewatch.sources.bind import TABLES

SF = "/root/testdata/sf0.001"


def norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    return sorted(repr(tuple(round(r[k], 6) if isinstance(r[k], float) else r[k] for k in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert norm(map(tuple, df.collect()), df.columns) == norm(res.fetchall(), cols)


def test_every_operator_has_one_query():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 14))


def test_pipeline_stages_against_direct_decisions(spark, tmp_path):
    from test_llm_join import direct

    item = prose(700, 40) + ". " + prose(701, 8) + "."
    rows = [(k, prose(k, 80) + (" vile nasty" if k % 5 == 0 else "")) for k in range(200)]
    rows += [(300, rows[1][1]), (301, rows[2][1] + " tail"), (302, prose(5_000, 50) + " " + item), (303, "password=0123456789abcdefZZ " + prose(6_000, 40)),
             (304, None), (305, ""), (306, prose(6_001, 4_000))]
    docs = documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 5 == 0)) for k in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at, left = docs, rows
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        at.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        outputs.append(at)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").distinct().collect())
    left = [r for r in left if not (r[0] < 200 and r[0] % 5 == 0)]
    assert ids(outputs[0]) == sorted(r[0] for r in left)
    keep = {c for _, _, c in direct(left)}
    left = [r for r in left if r[0] in keep]
    assert 300 not in keep and 301 not in keep and ids(outputs[1]) == sorted(keep)
    left = [r for r in left if r[0] != 302]
    assert ids(outputs[2]) == sorted(r[0] for r in left) == ids(outputs[3])
    assert all(o.columns == docs.columns for o in outputs[:4])
    text = {r.doc_id: r.text for r in outputs[3].collect()}
    assert text[303].startswith("[SECRET] ") and all(text[d] == t for d, t in left if d != 303)
    assert ids(outputs[4]) == sorted(text)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == outputs[4].count()


def test_names_are_used():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "best_fit_packing"]
    assert decontam.q_op3 in QUERIES.values() and toxicity.q_op2 in QUERIES.values()
