"""Files, documents and stored intermediates."""

from __future__ import annotations

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerpulse.operators import ingest
from ledgerpulse.sources import documents, schemas, tables, workspace


def folder_client(folder):
    """Keyed store for tests: a file per document, a log line per commit.

    Defined inside a function, so that it travels to the workers by value.
    """

    class FolderClient:
        def __init__(self):
            self.folder = Path(folder)

        def commit(self, docs):
            with (self.folder / "commits.log").open("a") as log:
                log.write(f"{len(docs)}\n")
            for key, doc in docs:
                (self.folder / f"{key}.json").write_text(json.dumps(doc, default=str))

        def close(self):
            with (self.folder / "closed.log").open("a") as log:
                log.write("x")

    return FolderClient


def test_raw_gzip_export(spark, tmp_path):
    path = tmp_path / "raw.csv.gz"
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(
            "invoice,stockcode,description,quantity,invoicedate,price,customer_id,country\n"
            '489434,85048,"15CM ""BALL"", LIGHTS ",12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom\n'
            "C489449,22087,,-12,2009-12-01 10:33:00,2.95,,Australia\n"
        )
    star = ingest.normalize_invoices(tables.read_raw_invoices(spark, str(path)))
    assert star.transactions.schema.names == schemas.TRANSACTIONS.names
    rows = {r["invoice"]: r for r in star.transactions.collect()}
    assert rows["489434"]["customer_id"] == 13085 and str(rows["489434"]["price"]) == "6.950"
    assert rows["489434"]["invoice_date"].isoformat() == "2009-12-01T07:45:00"
    assert rows["C489449"]["is_cancellation"] and rows["C489449"]["customer_id"] is None
    assert {r["stock_code"]: r["description"] for r in star.products.collect()} == {
        "85048": '15CM "BALL", LIGHTS', "22087": None
    }
    assert [tuple(r) for r in star.customers.collect()] == [(13085, "United Kingdom")]


HEADER = "invoice,stockcode,description,quantity,invoicedate,price,customer_id,country\n"


def test_raw_export_keeps_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(HEADER + '1,85048,"two\nlines, ""quoted""",12,2009-12-01 07:45:00,6.95,13085.0,France\n')
    rows = tables.read_raw_invoices(spark, str(path)).collect()
    assert [(r["description"], r["quantity"], r["customer_id"]) for r in rows] == [('two\nlines, "quoted"', 12, "13085.0")]


@pytest.mark.parametrize("cells", ["3x,2009-12-01 07:45:00,6.95", "3,01/12/2009,6.95", "3,2009-12-01 07:45:00,free"])
def test_raw_export_with_a_bad_cell_fails(spark, tmp_path, cells):
    path = tmp_path / "raw.csv"
    path.write_text(HEADER + f"1,85048,lamp,{cells},13085.0,France\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ_FILE"):
        tables.read_raw_invoices(spark, str(path)).collect()


def test_csv_keeps_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([('a\nb "c", d', "x")], schemas.UTTERANCES)
    tables.write_csv(df, str(tmp_path / "u"))
    assert tables.read_csv(spark, str(tmp_path / "u"), schemas.UTTERANCES, multi_line=True).collect() == df.collect()


def classified(spark, n):
    return spark.range(n).select(
        F.col("id").alias("k"), (F.lit(n) - F.col("id")).alias("arrival"), F.lit("hi").alias("text"),
        F.lit("oos").alias("intent_name"), F.lit(None).cast("string").alias("category"), F.lit("oos").alias("pred"),
        F.lit(0.123456).alias("confidence"), F.lit(1).alias("correct"), F.lit(0).alias("batch"),
    )


def test_documents_survive_the_json_file(spark, tmp_path):
    docs = documents.to_documents(classified(spark, 3), "arrival", "k")
    documents.write_documents(docs, str(tmp_path / "d"))
    line = json.loads(next(iter(sorted((tmp_path / "d").glob("part*")))).read_text().splitlines()[0])
    assert set(line) == set(schemas.DOCUMENTS.names) and line["category"] is None
    flat = documents.flatten_documents(tables.read_json_lines(spark, str(tmp_path / "d")))
    assert flat.schema == schemas.CONVERSATIONS
    rows = sorted(flat.collect())
    assert [r["conversation_id"] for r in rows] == ["conv_000000", "conv_000001", "conv_000002"]
    assert float(rows[0]["confidence"]) == 0.1235 and rows[0]["is_correct"] is True


def test_broken_line_fails_the_read(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"conversation_id": "a"}\n{oops\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        tables.read_json_lines(spark, str(tmp_path / "x.json")).collect()


def test_upsert_in_chunks(spark, tmp_path):
    folder = str(tmp_path)
    rows = spark.range(0, 25, 1, 1).select(F.concat(F.lit("d"), "id").alias("key"), F.col("id").alias("v")).coalesce(1)
    documents.upsert_documents(rows, "key", folder_client(folder), chunk=10)
    sizes = [int(x) for x in (tmp_path / "commits.log").read_text().split()]
    assert sum(sizes) == 25 and max(sizes) <= 10
    # Run again with one document changed: still one file per key, the new value wins.
    again = rows.withColumn("v", F.when(F.col("key") == "d3", 99).otherwise(F.col("v")))
    documents.upsert_documents(again, "key", folder_client(folder), chunk=10)
    files = sorted(tmp_path.glob("*.json"))
    assert len(files) == 25 and json.loads((tmp_path / "d3.json").read_text())["v"] == 99
    assert (tmp_path / "closed.log").read_text()


def test_newest_copy_per_key(spark):
    rows = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, None)], "key string, at int, v string")
    out = {r["key"]: r["v"] for r in documents.newest_per_key(rows, "key", "at").collect()}
    assert out == {"a": "new", "b": None}


def test_materialize_prunes_and_uses_the_shared_folder(spark):
    stored = workspace.materialize(spark.range(10).withColumn("v", F.lit("x")), "t")
    assert stored.count() == 10
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert folder in stored.inputFiles()[0]
    plan = stored.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_replace_table(spark):
    name = "ledgerpulse_replace_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    location = workspace.fresh_path(spark, name)
    spark.range(3).write.option("path", location).saveAsTable(name)
    tables.replace_table(spark.range(5).withColumn("v", F.lit(1)), name)
    assert tables.read_query(spark, f"SELECT count(*) AS n, sum(v) AS s FROM {name}").first() == (5, 5)
    spark.sql(f"DROP TABLE {name}")


def test_read_query_over_frames(spark):
    out = tables.read_query(spark, "SELECT max(id) AS m FROM {t}", t=spark.range(4))
    assert out.first()["m"] == 3
