from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from patronage import session
from patronage.model import FEATURE_TABLE
from patronage.plans.ingest import ingest, ingest_parquet
from patronage.sources import parquet
from patronage.sources.feature_table import (
    declared_features,
    insert_features,
    read_features,
    save_features,
    stored_features,
    typed_features,
)


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "raw")


def test_write_then_read(spark, base):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    path, rows = parquet.write_table(df, base, "numbers")
    assert (path, rows) == (f"{base}/numbers.parquet", 1000)
    assert parquet.read_table(spark, base, "numbers").agg(F.sum("x")).first()[0] == 999_000
    _, rows = parquet.write_table(df.limit(10), base, "numbers")
    assert rows == 10
    assert parquet.read_table(spark, base, "numbers").count() == 10


def test_empty_table_keeps_its_columns(spark, base):
    empty = spark.createDataFrame([], "a int, b string")
    assert parquet.write_table(empty, base, "empty")[1] == 0
    assert parquet.declared_schema(parquet.read_table(spark, base, "empty")) == [
        ("a", "int"),
        ("b", "string"),
    ]


def test_base_may_be_a_uri(spark, tmp_path):
    base = f"file://{tmp_path}/bucket"
    path, _ = parquet.write_table(spark.range(3), base, "t")
    assert path == f"{base}/t.parquet"
    assert parquet.list_tables(spark, base) == ["t"]


ODD_NAMES = ["my-table", "a b", "../x", "a;drop", "x.parquet", "é%20#?", "a=41=b", "{*}[c]", "Q$_1", ".hidden", "_x"]


@pytest.mark.parametrize("name", ODD_NAMES)
def test_any_table_name_is_written_read_and_listed(spark, base, name):
    path, rows = parquet.write_table(spark.range(3), base, name)
    assert rows == 3 and parquet.read_table(spark, base, name).count() == 3
    assert path.count("/") == base.count("/") + 1
    assert parquet.list_tables(spark, base) == [name]


def test_a_table_needs_a_name(spark, base):
    with pytest.raises(ValueError, match="empty"):
        parquet.read_table(spark, base, "")


def test_only_direct_children_are_listed(spark, tmp_path):
    base = str(tmp_path / "old.parquet" / "raw")
    parquet.write_table(spark.range(2), base, "one")
    parquet.write_table(spark.range(2), f"{base}/archive", "old")
    (tmp_path / "old.parquet" / "raw" / "notes.txt").write_text("x")
    assert parquet.list_tables(spark, base) == ["one"]
    assert dict(parquet.table_counts(spark, base).collect()) == {"one": 2}


def test_filters_and_columns_reach_the_scan(spark, base, capsys):
    df = spark.range(100).withColumns({"x": F.col("id") * 2, "y": F.col("id") * 3})
    parquet.write_table(df, base, "numbers")
    parquet.read_table(spark, base, "numbers").where("id > 7").select("x").explain()
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,7)]" in plan
    assert "ReadSchema: struct<id:bigint,x:bigint>" in plan


def test_typed_cast(spark):
    moment = datetime(2020, 2, 3, 4, 5, 6, 123_456)
    df = spark.createDataFrame(
        [(1, 2.345, moment, "7", None)],
        "i int, money double, at timestamp_ntz, y string, gone string",
    )
    declared = [
        ("money", "decimal(7,2)"),
        ("i", "int"),
        ("at", "datetime"),
        ("y", "year"),
        ("gone", "longtext"),
    ]
    out = parquet.typed_cast(df, declared)
    assert out.dtypes == [
        ("money", "decimal(7,2)"),
        ("i", "bigint"),
        ("at", "timestamp_ntz"),
        ("y", "int"),
        ("gone", "string"),
    ]
    cut = moment.replace(microsecond=123_000)
    assert tuple(out.first()) == (Decimal("2.35"), 1, cut, 7, None)
    wide = parquet.typed_cast(df, [("money", "decimal(7,2)")], policy="widen")
    assert wide.dtypes == [("money", "decimal(38,18)")]


def test_ingest_all_and_some(spark, base, tmp_path):
    source = str(tmp_path / "source")
    for name, rows in (("a", 5), ("b", 0), ("c", 7)):
        parquet.write_table(spark.range(rows).withColumn("x", F.lit(1)), source, name)
    manifest = ingest_parquet(spark, source, base, at_once=2)
    assert [tuple(r) for r in manifest.orderBy("table_name").collect()] == [
        ("a", f"{base}/a.parquet", 5, 2),
        ("b", f"{base}/b.parquet", 0, 2),
        ("c", f"{base}/c.parquet", 7, 2),
    ]
    assert parquet.list_tables(spark, base) == ["a", "b", "c"]
    some = ingest_parquet(spark, source, base, tables=["c"])
    assert [r["row_count"] for r in some.collect()] == [7]
    with pytest.raises(ValueError, match="no such tables"):
        ingest_parquet(spark, source, base, tables=["zz"])


def test_ingest_stops_at_the_first_failure(spark, base):
    def read(name):
        if name == "bad":
            raise RuntimeError("unreadable")
        return spark.range(1)

    with pytest.raises(RuntimeError, match="unreadable"):
        ingest(spark, read, ["good", "bad", "never"], base)
    assert parquet.list_tables(spark, base) == ["good"]


def test_table_reports(spark, base):
    parquet.write_table(spark.range(4).withColumn("s", F.lit("x")), base, "one")
    parquet.write_table(spark.range(2), base, "two")
    assert dict(parquet.table_counts(spark, base).collect()) == {"one": 4, "two": 2}
    plain = [tuple(r) for r in parquet.table_schemas(spark, base).collect()]
    rows = [tuple(r) for r in parquet.table_schemas(spark, base, counted=True).collect()]
    assert sorted(plain) == sorted(row[:4] for row in rows)
    assert sorted(rows) == [
        ("one", 1, "id", "bigint", 4),
        ("one", 2, "s", "string", 4),
        ("two", 1, "id", "bigint", 2),
    ]


def features(spark, **changes):
    row = {field.name: F.lit(None).cast(field.dataType) for field in FEATURE_TABLE.fields}
    row |= {"has_store_sales": F.lit(1), "store_transaction_count": F.lit(3)} | changes
    return spark.range(1).select(*[value.alias(name) for name, value in row.items()])


def test_feature_table_types(spark):
    typed = typed_features(features(spark))
    assert typed.dtypes == [(f.name, f.dataType.simpleString()) for f in FEATURE_TABLE.fields]
    assert len(typed.columns) == 33
    assert typed.first()["store_transaction_count"] == 3


def test_feature_table_refuses_nulls(spark):
    rows = features(spark, store_transaction_count=F.lit(None))
    with pytest.raises(PySparkException, match="NOT NULL column store_transaction_count"):
        typed_features(rows).collect()


@pytest.fixture
def shop(spark, tmp_path):
    spark.sql(f"CREATE DATABASE shop LOCATION '{tmp_path}/shop'")
    yield "shop.customer_features"
    spark.sql("DROP DATABASE shop CASCADE")


def test_feature_table_in_the_catalog(spark, shop):
    """Types and constraints are those of section 1.4, read back; a second save replaces the rows."""
    save_features(features(spark), shop)
    save_features(features(spark, has_store_sales=F.lit(0)), shop)
    rows = stored_features(spark, shop)
    assert rows.schema == FEATURE_TABLE == declared_features(spark, shop)
    assert [r["has_store_sales"] for r in rows.collect()] == [0]
    spark.sql(f"CREATE TABLE {shop}_other (a INT) USING parquet")
    with pytest.raises(ValueError, match="not a feature table"):
        save_features(features(spark), f"{shop}_other")


def test_inserts_keep_the_constraints(spark, shop):
    save_features(features(spark), shop)
    turned = features(spark, ca_city=F.lit("Oslo")).select(*reversed(FEATURE_TABLE.names))
    insert_features(turned, shop)  # columns go by name
    assert sorted(str(r["ca_city"]) for r in read_features(spark, shop).collect()) == ["None", "Oslo"]
    with pytest.raises(PySparkException, match="NOT NULL column store_transaction_count"):
        insert_features(features(spark, store_transaction_count=F.lit(None).cast("long")), shop)
    with pytest.raises(PySparkException, match="CANNOT_SAFELY_CAST"):
        insert_features(features(spark, hd_dep_count=F.lit("two")), shop)
    with pytest.raises(PySparkException, match="CAST_OVERFLOW"):
        insert_features(features(spark, hd_dep_count=F.lit(3_000_000_000)), shop)
    with pytest.raises(ValueError, match="columns differ"):
        insert_features(features(spark).drop("ca_city"), shop)
    assert read_features(spark, shop).count() == 2
    spark.sql(f"INSERT INTO {shop} (c_customer_sk) VALUES (1)")  # past the constraints
    with pytest.raises(PySparkException, match="NOT NULL column has_store_sales"):
        read_features(spark, shop).collect()


class FakeSession:
    """The two things ``shared_dir`` asks a session for."""

    def __init__(self, configured=None, made=None):
        self.conf = {} if configured is None else {"spark.checkpoint.dir": configured}
        self.sparkContext = self
        self.made = made

    def getCheckpointDir(self):
        return self.made


def test_shared_dir_follows_the_setting_and_has_no_default():
    assert session.shared_dir(FakeSession("hdfs:///shared/")) == "hdfs:///shared"
    assert session.shared_dir(FakeSession(made="/mnt/shared")) == "/mnt/shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession())


def test_run_folders_are_fresh_and_removed(spark, tmp_path):
    with session.run_folder(spark, str(tmp_path)) as one, session.run_folder(spark, str(tmp_path)) as two:
        assert one != two
        spark.range(3).write.parquet(f"{one}/t")
        assert spark.read.parquet(f"{one}/t").count() == 3
    with pytest.raises(ZeroDivisionError), session.run_folder(spark, str(tmp_path)) as three:
        spark.range(3).write.parquet(f"{three}/t")
        raise ZeroDivisionError
    assert list(tmp_path.iterdir()) == []


def test_a_year_that_arrives_as_a_date(spark):
    df = spark.sql("SELECT DATE '1999-01-01' AS y, 200S AS t, 4000000000L AS i")
    out = parquet.typed_cast(df, [("y", "year"), ("t", "tinyint unsigned"), ("i", "int unsigned")])
    assert tuple(out.first()) == (1999, 200, 4_000_000_000)
    assert out.dtypes == [("y", "int"), ("t", "smallint"), ("i", "bigint")]
