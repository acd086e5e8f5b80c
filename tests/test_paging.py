"""Pages through the data source, as batch and as stream, against the table or the text they come from."""

import os
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lexledger.sources import pages, paging

SF = "/root/testdata/sf0.001"


def key(rows):
    return sorted((r.page_number, r.text) for r in rows)


@pytest.fixture
def given(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").selectExpr("CAST(page_id AS INT) AS page_number", "html AS text")
    return key(rows.collect())


def test_a_table_read_in_batch_equals_the_table(spark, given):
    spark.dataSource.register(paging.page_source(paging.ParquetPages("html", "page_id"), "table_pages"))
    assert key(spark.read.format("table_pages").load(f"{SF}/pages.parquet").collect()) == given
    size = os.path.getsize(f"{SF}/pages.parquet")
    cut = spark.read.format("table_pages").option("splitBytes", size // 7).load(f"{SF}/pages.parquet")
    assert cut.rdd.getNumPartitions() == -(-size // (size // 7)) and key(cut.collect()) == given


def test_a_table_read_as_stream_equals_the_table(spark, given, tmp_path):
    spark.dataSource.register(paging.page_source(paging.ParquetPages("html", "page_id"), "table_pages"))
    table, inbox = pq.read_table(f"{SF}/pages.parquet"), tmp_path / "in"
    inbox.mkdir()
    thirds = [table.slice(k * table.num_rows // 3, (k + 1) * table.num_rows // 3 - k * table.num_rows // 3) for k in range(3)]

    def arrive(k):
        pq.write_table(thirds[k], tmp_path / f"{k}.part", row_group_size=20)
        os.utime(tmp_path / f"{k}.part", ns=(10**9 * (k + 1),) * 2)
        shutil.move(tmp_path / f"{k}.part", inbox / f"{9 - k}.parquet")

    def run():
        stream = spark.readStream.format("table_pages").option("splitBytes", "4000").load(str(inbox))
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
        return key(spark.read.schema(paging.PAGE).parquet(str(tmp_path / "out")).collect())

    arrive(0)
    arrive(1)
    (inbox / "_not-a-page").write_bytes(b"x")
    assert run() == sorted((p, t) for k in (0, 1) for p, t in zip(thirds[k]["page_id"].to_pylist(), thirds[k]["html"].to_pylist(), strict=True))
    arrive(2)
    assert run() == given == run()  # a run without new documents adds nothing


def test_text_documents(spark, tmp_path):
    spark.dataSource.register(paging.page_source(paging.FormFeedText(), "text_pages"))
    (tmp_path / "a.txt").write_text("one\ftwo ä\f")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/b.txt").write_text("BT-1 x\nline\fBT-2 y")
    (tmp_path / "c.log").write_text("no")
    (tmp_path / "empty.txt").write_text("")
    got = spark.read.format("text_pages").option("suffix", ".txt").load(str(tmp_path))
    assert sorted((r.path.rpartition("/")[2], r.page_number, r.text, r.tables) for r in got.collect()) == [("a.txt", 1, "one", []), ("a.txt", 2, "two ä", []), ("a.txt", 3, "", []), ("b.txt", 1, "BT-1 x\nline", []), ("b.txt", 2, "BT-2 y", []), ("empty.txt", 1, "", [])]
    assert got.rdd.getNumPartitions() == 1  # small files are gathered
    assert [r.line for r in pages.lines(got.where("path LIKE '%b.txt'")).orderBy("line_no").collect()] == ["BT-1 x", "line", "BT-2 y"]
    for split in (1, 7, 1000):
        cut = spark.read.format("text_pages").option("suffix", ".txt").option("splitBytes", split).load(str(tmp_path))
        assert sorted(map(str, cut.collect())) == sorted(map(str, got.collect()))
    (tmp_path / "none").mkdir()
    assert spark.read.format("text_pages").load(str(tmp_path / "none")).count() == 0


def test_tables_and_row_groups(spark, tmp_path):
    rows = [{"text": f"t{k}", "tables": [[["ID", None], [str(k)]]]} for k in range(500)]
    pq.write_table(pa.Table.from_pylist(rows), tmp_path / "x.parquet", row_group_size=70)
    spark.dataSource.register(paging.page_source(paging.ParquetPages(tables="tables"), "with_tables"))
    got = spark.read.format("with_tables").option("splitBytes", 300).load(f"file://{tmp_path}/x.parquet").orderBy("page_number").collect()
    assert [(r.page_number, r.text, r.tables) for r in got] == [(k + 1, f"t{k}", [[["ID", None], [str(k)]]]) for k in range(500)]
