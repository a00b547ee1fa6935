"""The registered queries: names, columns, and equality with their SQL."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from adspark.llm import queries

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
COLUMNS = {
    1: "doc_id start n_tokens ids_crc32", 2: "vec_id n_links component_id kept", 3: "doc_id n_words n_hit n_items items_sha256 contaminated",
    4: "doc_id held_out score predicted", 5: "doc_id n_words n_removed kept_sha256", 6: "page_id url text n_chars",
    7: "doc_id n_email n_ip n_card n_phone base_sha256 spans", 8: "page_id payload_bytes payload_digest record_type refers_to",
    9: "doc_id n_tokens", 10: "doc_id fingerprint component_id",
    11: "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    12: "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    13: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars"}


def test_all_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n in queries.QUERIES} == set(COLUMNS)
    assert "pipeline" in names and set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    got = queries.QUERIES[name](spark, FOLDER)
    want = COLUMNS[int(name[2:].split("_")[0])].split()
    assert got.columns[:len(want)] == want
    rows = got.collect()
    if int(name[2:].split("_")[0]) < 11:
        table = "embeddings" if name.startswith("op2_") else "pages" if name.startswith(("op6_", "op8_")) else "documents"
        assert len(rows) == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
    if name in queries.SQL:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
        sql = con.execute(queries.SQL[name])
        names = [d[0] for d in sql.description]
        assert sorted(names) == sorted(got.columns)
        key = sorted(names)
        assert sorted(str([r[names.index(c)] for c in key]) for r in sql.fetchall()) == sorted(str([r[c] for c in key]) for r in rows)
