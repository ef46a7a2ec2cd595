"""What the JDBC source asks for. No database is started, so nothing is read here."""

from datetime import date, datetime, timedelta
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from patronage.plans.ingest import ingest_jdbc
from patronage.sources.jdbc import (
    JdbcDatabase,
    border_predicates,
    hash_predicates,
    literal,
    quoted,
    range_predicates,
)


class Answer:
    def __init__(self, rows):
        self.rows = rows

    def collect(self):
        return self.rows

    def first(self):
        return self.rows[0]


class FakeReader:
    """Records options and answers queries from a list of (part of the text, rows)."""

    def __init__(self, answers, options=None):
        self.answers = answers
        self.given = options or {}
        self.jdbc_call = None

    def format(self, name):
        return FakeReader(self.answers, {"format": name})

    def options(self, **more):
        return FakeReader(self.answers, self.given | more)

    def option(self, key, value):
        return self.options(**{key: value})

    def load(self):
        if "query" not in self.given:
            return self
        for part, rows in self.answers:
            if part in self.given["query"]:
                return Answer(rows)
        raise AssertionError(self.given["query"])

    def jdbc(self, url, table, predicates, properties):
        return SimpleNamespace(url=url, table=table, predicates=predicates, properties=properties)


COLUMNS = [
    {"position": 2, "name": "price", "type": "DECIMAL", "full_type": "decimal(7,2)", "digits": 7, "decimals": 2},
    {"position": 1, "name": "id", "type": "int", "full_type": "int unsigned", "digits": 10, "decimals": 0},
]
ANSWERS = [
    ("information_schema.tables", [{"table_name": "web_sales"}, {"table_name": "customer"}]),
    ("table_name = 'empty'", []),
    ("information_schema.columns", COLUMNS),
    ("statistics WHERE table_schema = 'shop' AND table_name = 'keyless'", []),
    (
        "information_schema.statistics",
        [
            {"name": "PRIMARY", "repeats": 0, "place": 1, "col": "id", "part": None},
            {"name": "by_price", "repeats": 1, "place": 1, "col": "price", "part": None},
        ],
    ),
    ("MIN(`id`)", [(5, 104)]),
    ("(`id` - 5) DIV 25", [(0, 50), (1, 100), (3, 40), (None, 10)]),
]


@pytest.fixture
def database():
    spark = SimpleNamespace(
        read=FakeReader(ANSWERS), sparkContext=SimpleNamespace(defaultParallelism=16)
    )
    return JdbcDatabase(spark, "jdbc:mysql://host/shop", "shop", {"user": "reader"})


def test_listing(database):
    assert database.list_tables() == ["customer", "web_sales"]
    assert database.declared_schema("web_sales") == [("id", "int unsigned"), ("price", "decimal(7,2)")]
    with pytest.raises(ValueError, match="no schema found"):
        database.declared_schema("empty")


@pytest.mark.parametrize("key", ["id", None])
def test_key_ranges(database, key):
    """Without a key the primary key's first column serves."""
    read = database.read_table("web_sales", key=key, partitions=4)
    assert read.table == "`web_sales`"
    assert read.predicates == [
        "`id` IS NULL",
        "`id` < 30",
        "`id` >= 30 AND `id` < 80 AND MOD(CRC32(CONCAT_WS('|', `id`, `price`)), 2) = 0",
        "`id` >= 30 AND `id` < 80 AND MOD(CRC32(CONCAT_WS('|', `id`, `price`)), 2) = 1",
        "`id` >= 80",
    ]


def test_keys_that_cannot_split(database):
    with pytest.raises(ValueError, match="no columns"):
        database.read_table("web_sales", key="nope")


def test_a_table_without_an_index_is_dealt_out_by_hash(database):
    assert database.read_table("keyless", partitions=3).predicates == hash_predicates(["id", "price"], 3)


def index(name, *columns, repeats=0, part=None):
    return [{"name": name, "repeats": repeats, "place": i, "col": c, "part": part} for i, c in enumerate(columns, 1)]


@pytest.mark.parametrize(
    ("rows", "key"),
    [
        (index("by_day", "day", repeats=1) + index("PRIMARY", "code", "day"), ["code", "day"]),
        (index("by_day", "day", repeats=1) + index("u2", "day", "code") + index("u1", "code"), ["code"]),
        (index("PRIMARY", "code", "kind", "day"), ["code"]),
        (index("PRIMARY", "kind", "day") + index("by_day", "day", repeats=1), ["day"]),
        (index("PRIMARY", "code", part=10) + index("expression", None), []),
        ([], []),
    ],
)
def test_the_index_to_split_by(rows, key):
    spark = SimpleNamespace(read=FakeReader([("information_schema.statistics", rows)]))
    declared = {"code": "varchar", "day": "date", "kind": "enum", "n": "int unsigned"}
    assert JdbcDatabase(spark, "jdbc:mysql://host/shop", "shop").ordered_key("t", declared) == key


class StandIn(JdbcDatabase):
    """Spark answers the statements in place of the database, over a view of the table's name."""

    def query(self, sql):
        return self.stand_in.sql(sql)

    def plan(self, session, table, key, reads):
        object.__setattr__(self, "stand_in", session)
        return self._border_predicates(table, key, reads, session.table(table).columns)


START = datetime(2020, 1, 1, 12, 30, 0, 250_000)
KEYS = {
    "text": ("string", lambda i: f"k{i * 7919 % 5000:04d}'\\x", "zz", ""),
    "day": ("date", lambda i: date(2000, 1, 1) + timedelta(days=i * 13 % 900), date(2100, 1, 1), date(1900, 1, 1)),
    "moment": ("timestamp_ntz", lambda i: START + timedelta(milliseconds=i * 37), datetime(2100, 1, 1), datetime(1900, 1, 1)),
    "amount": ("decimal(20,4)", lambda i: Decimal(i * 31 % 4000 - 2000).scaleb(-4), Decimal(10**9), Decimal(-(10**9))),
    "bytes": ("binary", lambda i: bytes([i % 251, i % 7]), b"\xff\xff", b""),
}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("wide", [False, True])
def test_borders_of_any_key_read_every_row_once(spark, kind, wide):
    """With ties, a key that holds a third of all rows, nulls, and rows that come after the count."""
    type_name, make, high, low = KEYS[kind]
    count, reads = 3000, 12
    hot = make(1234)
    rows = [(hot if i % 3 == 0 else None if i % 50 == 1 else make(i), None if i % 41 == 0 else i % 5, i) for i in range(count)]
    schema = f"k {type_name}, part int, id long"
    table = spark.createDataFrame(rows, schema)
    table.createOrReplaceTempView("keyed")
    predicates = StandIn(None, "", "shop").plan(spark, "keyed", ["k", "part"] if wide else ["k"], reads)
    assert reads_per_row(table, predicates) == [(1,)]
    assert max(table.where(p).count() for p in predicates) < 2.5 * count / reads
    assert reads + 1 <= len(predicates) <= 3 * reads
    late = [(high, 1, -1), (low, 1, -2), (None, None, -3), (hot, 9, -4), (make(17), -9, -5), (make(18), None, -6)]
    assert reads_per_row(spark.createDataFrame(late, schema), predicates) == [(1,)]


def test_borders_of_few_or_no_rows(spark):
    for rows in ([], [("a",)], [(None,)], [(None,)] * 40 + [("b",)] * 40):
        table = spark.createDataFrame(rows, "k string")
        table.createOrReplaceTempView("few")
        predicates = StandIn(None, "", "shop").plan(spark, "few", ["k"], 4)
        late = spark.createDataFrame([("",), ("a",), ("c",), (None,)], "k string")
        assert reads_per_row(table.unionAll(late), predicates) == [(1,)]


def test_ranges_of_several_columns_are_spelled_out():
    assert border_predicates(["a", "b"], [("x", 1), ("y", 2)], 0, 10, ["a", "b"]) == [
        "`a` IS NULL OR `b` IS NULL",
        "`a` IS NOT NULL AND `b` IS NOT NULL AND (`a` <= 'x' AND (`a` < 'x' OR `a` = 'x' AND (`b` < 1)))",
        "`a` IS NOT NULL AND `b` IS NOT NULL AND (`a` >= 'x' AND (`a` > 'x' OR `a` = 'x' AND (`b` >= 1)))"
        " AND (`a` <= 'y' AND (`a` < 'y' OR `a` = 'y' AND (`b` < 2)))",
        "`a` IS NOT NULL AND `b` IS NOT NULL AND (`a` >= 'y' AND (`a` > 'y' OR `a` = 'y' AND (`b` >= 2)))",
    ]


def test_constants():
    values = [3, True, Decimal("1E+3"), 0.1, b"\x00'", date(2020, 2, 3), START, "a\\'b"]
    assert [literal(v) for v in values] == [
        "3", "1", "1000", "0.1", "X'0027'", "'2020-02-03'", "'2020-01-01 12:30:00.250000'", "'a\\\\''b'",
    ]
    with pytest.raises(TypeError, match="no constant"):
        literal(None)


def test_ingest_needs_no_hash_for_a_text_or_composite_key(spark):
    """What ingest would send for a primary key of text and date; the session stands in for the source."""
    rows = [(f"c{i % 7}", date(2020, 1, 1 + i % 28), i) for i in range(200)]
    spark.createDataFrame(rows, "code string, day date, n int").createOrReplaceTempView("visits")
    declared = [
        {"position": i, "name": n, "type": t, "full_type": t, "digits": None, "decimals": None}
        for i, (n, t) in enumerate([("code", "varchar"), ("day", "date"), ("n", "int")])
    ]
    answers = {
        "information_schema.columns": declared,
        "information_schema.statistics": index("PRIMARY", "code", "day"),
    }

    class Source(JdbcDatabase):
        def query(self, sql):
            known = [rows for part, rows in answers.items() if part in sql]
            return Answer(known[0]) if known else spark.sql(sql)

    fake = SimpleNamespace(read=FakeReader([]), sparkContext=SimpleNamespace(defaultParallelism=4))
    read = Source(fake, "jdbc:mysql://host/shop", "shop").read_table("visits")
    assert 5 <= len(read.predicates) <= 12 and not any("CRC32" in p for p in read.predicates if "IS NOT NULL" in p)
    assert reads_per_row(spark.table("visits"), read.predicates) == [(1,)]


def test_shares_by_hash_on_request(database):
    read = database.read_table("web_sales", by_hash=True)
    assert len(read.predicates) == 16
    assert read.predicates[3] == "MOD(CRC32(CONCAT_WS('|', `id`, `price`)), 16) = 3"
    assert read.properties == {
        "user": "reader",
        "fetchsize": "10000",
        "preferTimestampNTZ": "true",
        "yearIsDateType": "false",
        "tinyInt1isBit": "false",
    }


def reads_per_row(table, predicates):
    hits = [F.when(F.expr(p), 1).otherwise(0) for p in predicates]
    return table.select(sum(hits[1:], hits[0]).alias("reads")).distinct().collect()


def test_every_row_is_read_once_and_hot_keys_are_split(spark):
    """Spark knows the functions the statements use, so it can stand in for the database."""
    far = F.when(F.col("id") < 6_000, F.col("id") - 500).otherwise(F.col("id") + 5_000)
    key = F.when(F.col("id") % 3 == 0, -7).when(F.col("id") % 3 == 1, far)
    table = spark.range(9_000).select("id", key.alias("k"), F.lit("x").alias("s"))
    low, high = table.agg(F.min("k"), F.max("k")).first()
    width = (high - low) // 12 + 1
    numbers = table.select(F.expr(f"(k - {low}) DIV {width}").alias("number"))
    rows = {row["number"]: row["count"] for row in numbers.groupBy("number").count().collect()}
    predicates = range_predicates("k", low, width, rows, ["id", "k", "s"], 750)
    assert reads_per_row(table, predicates) == [(1,)]
    # Rows that come after the count: beyond both bounds, in a gap, and without a key.
    gap = next(n for n in range(12) if not rows.get(n))
    late = [low - 10**6, low + gap * width + 1, high + 10**6, None]
    later = table.sparkSession.createDataFrame([(i, k, "x") for i, k in enumerate(late)], "id long, k long, s string")
    assert reads_per_row(table.unionByName(later), predicates) == [(1,)]
    assert range_predicates("k", 0, 1, {}, ["k"], 1) == ["`k` IS NULL", "`k` IS NOT NULL"]
    assert max(table.where(p).count() for p in predicates) < 1_000
    assert reads_per_row(table, hash_predicates(["id", "k", "s"], 7)) == [(1,)]


def test_names_are_quoted():
    assert quoted("a`b") == "`a``b`"
    assert hash_predicates(["x"], 1) == ["MOD(CRC32(CONCAT_WS('|', `x`)), 1) = 0"]


def test_ingest_takes_known_tables_only(database):
    with pytest.raises(ValueError, match="no such tables"):
        ingest_jdbc(database, "/nowhere", tables=["customer; drop table customer"])
