import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from parley.plans import staging
from parley.session import cut_lineage, drop_tables, new_table_path, shared_folder
from parley.sources import schemas, tables


def test_conform_types_fills_and_keeps(spark):
    raw = spark.createDataFrame([(1, 7, "n", "extra")], "CHAT_ID int, message_id int, note string, more string")
    with pytest.raises(ValueError, match="message_date"):
        tables.conform(raw, schemas.CHAT_MESSAGE_JOIN)
    full = tables.conform(raw.withColumn("Message_Date", F.lit(3)), schemas.CHAT_MESSAGE_JOIN)
    assert full.dtypes == [
        ("chat_id", "bigint"), ("message_id", "bigint"), ("message_date", "bigint"),
        ("note", "string"), ("more", "string"),
    ]


def test_absent_optional_columns_become_nulls(spark):
    raw = spark.createDataFrame([(1, "g", "i", "s", None)], schemas.DECLARED[schemas.CHAT][0])
    chat = staging.stg_chat(tables.conform(raw, schemas.CHAT))
    assert len(chat.columns) == 28
    row = chat.first()
    assert (row.row_id, row.chat_identifier, row.style, row.properties) == (1, "i", None, None)


def test_write_replaces_and_preview(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.write_table(spark.range(100), path)
    tables.write_table(spark.range(10).withColumn("k", F.col("id") % 2), path, ["k"])
    assert spark.read.parquet(path).count() == 10
    assert (tmp_path / "table" / "k=0").is_dir()
    assert tables.preview(spark, path, 3).count() == 3
    assert tables.read_table(
        spark.newSession(), _write_link(spark, tmp_path), schemas.CHAT_MESSAGE_JOIN
    ).columns == ["chat_id", "message_id", "message_date"]


def _write_link(spark, tmp_path):
    path = str(tmp_path / "link")
    spark.range(3).selectExpr("id chat_id", "id message_id", "id message_date").write.parquet(path)
    return path


def test_sql_store_is_read_in_ranges(spark):
    asked = {}

    class Reader:
        def format(self, name):
            asked["format"] = name
            return self

        def options(self, **options):
            asked.update(options)
            return self

        def load(self):
            return spark.createDataFrame([], "chat_id bigint, message_id bigint, message_date bigint")

    class Session:
        read = Reader()

    tables.read_sql_table(
        Session(), "jdbc:x", schemas.CHAT_MESSAGE_JOIN, key="message_id", lowest=1, highest=9, partitions=4, driver="d"
    )
    assert asked == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "chat_message_join", "partitionColumn": "message_id",
        "lowerBound": "1", "upperBound": "9", "numPartitions": "4", "driver": "d",
    }


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured in shared_folder(spark)


def test_settled_rows_are_the_same(spark):
    df = spark.range(5).selectExpr("id", "cast(id as string) as text")
    assert cut_lineage(df).dtypes == df.dtypes
    assert sorted(cut_lineage(df).collect()) == sorted(df.collect())


def test_text_backfill_uses_a_given_decoder(spark):
    rows = [(1, "a", "text", b"body"), (2, "b", None, b"body"), (3, "c", None, None), (4, "d", "", b"body")]
    message = spark.createDataFrame(rows, "rowid bigint, guid string, text string, attributedbody binary")
    got = staging.text_backfill(message, lambda body: F.upper(F.decode(body, "UTF-8")))
    assert {r.rowid: r.text for r in got.collect()} == {1: "text", 2: "BODY", 3: None, 4: ""}
    default = {r.rowid: r.text for r in staging.text_backfill(message).collect()}
    assert default == {1: "text", 2: "body", 3: None, 4: ""}


def test_tables_of_the_application_are_dropped(spark, tmp_path):
    """Only what was written through ``new_table_path``; checkpoints and other tables stay."""
    path, other = new_table_path(spark), str(tmp_path / "other")
    spark.range(3).write.parquet(path)
    spark.range(3).write.parquet(other)
    settled = cut_lineage(spark.range(5))
    drop_tables(spark)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
    assert spark.read.parquet(other).count() == 3 and settled.count() == 5
    drop_tables(spark)
