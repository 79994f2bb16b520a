"""The stages on their own input, and the registered queries against plain versions."""

import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="sample data not present")
duckdb = pytest.importorskip("duckdb")


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, DATA), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[1] == counts[0] and counts[0] > counts[2] > 0.7 * counts[0]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert out.count() == counts[4] and out.agg({"n_tokens": "sum"}).first()[0] == max(r.start + r.n_tokens for r in out.collect())


def test_language_stage_rejects_what_is_no_language(docs, spark):
    rows = [(i, "the river and the stone under the old bridge " * 3, "en") for i in range(40)] + [(100, "12 34 ..", "en"), (101, None, None), (102, "zqxj vvkw pqzx", None)]
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, docs(rows), DATA).collect()}
    assert kept == set(range(40))


@pytest.mark.parametrize("name", sorted(contract.llm.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'").fetchall()
    result = con.execute(contract.llm.SQL[name])
    names = [d[0] for d in result.description]
    want = sorted((tuple(r) for r in result.fetchall()), key=repr)
    df = contract.queries()[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=repr) == want


CLASHING = ["score", "lang_pred", "_h", "_hash", "_shard", "_order", "row", "key", "removed", "__key", "node", "hash", "id", "text_hash", "__text", "shard", "bucket"]


def test_stages_keep_clashing_columns_nulls_and_repeated_rows(docs, spark):
    text = lambda i: f"the river number {i} and the stone under the old bridge of town {i} " * 3
    rows = [(i, text(i), "en", f"s{i % 3}") for i in range(60)] + [(7, text(7), "en", "s1"), (None, text(99), "en", None), (101, None, None, None)]
    wide = docs(rows).selectExpr("*", *[f"{k} AS `{c}`" for k, c in enumerate(CLASHING)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, DATA)
        assert out.columns == wide.columns and out.schema.simpleString() == wide.schema.simpleString()
        got = out.collect()
        assert got and all([r[c] for c in CLASHING] == list(range(len(CLASHING))) for r in got)
        assert stage(spark, wide.limit(0), DATA).collect() == []
    ends = corpus_pipeline.STAGES[-1][1](spark, wide, DATA).collect()
    assert len(ends) == len(rows) and [r.n_tokens for r in ends if r.doc_id == 101] == [1]
    assert corpus_pipeline.STAGES[-1][1](spark, wide.limit(0), DATA).collect() == []


# Columns and types of each contract, and the table of which each query returns one row per row.
CONTRACTS = {
    "op1_quality_classifier": ("documents", "doc_id:bigint,held_out:boolean,score:double,predicted:int"),
    "op3_exact_dedup": ("documents", "doc_id:bigint,keep_id:bigint,group_size:bigint,kept:boolean,text_sha256:string"),
    "op4_language_id": ("documents", "doc_id:bigint,held_out:boolean,lang_pred:string,score:double"),
    "op6_chat_formatting": (None, "conv_id:bigint,n_turns:bigint,turns_sha256:string,loss_chars:bigint,loss_sha256:string,formatted_chars:bigint"),
    "op7_source_mixing": ("documents", "doc_id:bigint,size:bigint,source_size:bigint,target:double,taken:bigint"),
    "op8_html_extraction": ("pages", "page_id:bigint,url:string,text:string,n_chars:bigint"),
    "op9_token_output": ("documents", "doc_id:bigint,start:bigint,n_tokens:bigint,ids_crc32:bigint"),
    "op10_minhash_near_dedup": ("documents", "doc_id:bigint,n_shingles:bigint,component_id:bigint,kept:boolean"),
    "op11_conversation_repair": (None, "conv_id:bigint,gaps:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,cost:bigint,audit:string,repaired_sha256:string"),
    "op12_periodic_runs": ("documents", "doc_id:bigint,n_runs:bigint,start:bigint,length:bigint,period:bigint,exponent_milli:bigint,runs_sha256:string,collapsed_sha256:string"),
    "op13_vector_dedup": ("embeddings", "vec_id:bigint,n_links:bigint,component_id:bigint,kept:boolean"),
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_query_keeps_its_contract(spark, name):
    import zlib

    table, columns = CONTRACTS[name]
    df = contract.queries()[name](spark, DATA)
    assert ",".join(f"{n}:{t}" for n, t in df.dtypes) == columns
    rows = df.collect()
    if table:
        ids = sorted(r[0] for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(df.columns[0]).collect())
        assert sorted(r[0] for r in rows) == ids
    else:
        assert len({r[0] for r in rows}) == len(rows) == spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id").distinct().count() + (name[:3] == "op6")
    if "held_out" in df.columns:
        by, rest = (4, 2) if name.startswith("op1_") else (5, 0)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % by == rest) and 0 <= r.score <= 1 for r in rows)
    if name.startswith("op1_"):
        assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_every_operator_has_a_query():
    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
