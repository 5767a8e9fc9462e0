"""Every registered query over the smallest tables: columns, types, rows, and SQL where there is some."""

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_mix_sources": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op2_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op3_top_k": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op4_secrets": {"doc_id": "bigint", "begin": "int", "end": "int", "is_secret": "boolean"},
    "op5_chat_format": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op6_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op7_near_duplicates": {"doc_id": "bigint", "class_id": "bigint"},
    "op8_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9_imatch": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op10_lm_score": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
}
ROWS = {"op6_html_text": "pages"} | {q: "documents" for q in ("op1_mix_sources", "op2_bpe", "op7_near_duplicates", "op8_quality", "op9_imatch", "op10_lm_score")}


def test_all_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert set(COLUMNS) | {"pipeline"} <= set(names)
    assert [n for n in names if n.startswith("op")] == sorted(COLUMNS, key=lambda n: int(n[2:].split("_")[0]))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    import __spark_entry__

    df = __spark_entry__.queries()[name](spark, SF)
    rows = df.collect()
    types = dict(df.dtypes)
    assert {c: types.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    if name in ROWS:
        assert len(rows) == spark.read.parquet(f"{SF}/{ROWS[name]}.parquet").count()
    sql = __spark_entry__.oracle_sql().get(name)
    if sql:
        con = duckdb.connect()
        for t in ("embeddings", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        out = con.execute(sql)
        names = [d[0] for d in out.description]
        assert sorted(names) == sorted(df.columns)
        assert sorted(tuple(map(str, (r[c] for c in names))) for r in rows) == sorted(tuple(map(str, r)) for r in out.fetchall())
