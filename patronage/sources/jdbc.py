"""Tables of a MySQL database, read over JDBC in parallel.

The driver jar comes from the cluster. Names are taken from the database's own listing, never
pasted unchecked into a statement.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal
from itertools import groupby

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

FETCH_SIZE = 10_000

# Driver settings under which a year is a number, not a date, and tinyint(1) keeps
# values other than 0 and 1.
DRIVER_SETTINGS = {"yearIsDateType": "false", "tinyInt1isBit": "false"}

INTEGER_TYPES = ("tinyint", "smallint", "mediumint", "int", "bigint")

# Types whose values the source sorts the way it compares them with a literal. Enums and sets are
# sorted by number but compared as text, and a time comes back as a point in time.
ORDERED_TYPES = (
    *INTEGER_TYPES,
    "decimal",
    "float",
    "double",
    "char",
    "varchar",
    "date",
    "datetime",
    "timestamp",
    "year",
    "binary",
    "varbinary",
)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "''") + "'"


def literal(value: object) -> str:
    """The value as a constant of a statement."""
    if isinstance(value, (bool, int)):
        return str(int(value))
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (bytes, bytearray)):
        return f"X'{value.hex()}'"
    if isinstance(value, datetime):
        return text_literal(value.isoformat(" "))
    if isinstance(value, date):
        return text_literal(value.isoformat())
    if isinstance(value, str):
        return text_literal(value)
    raise TypeError(f"no constant for a key of type {type(value).__name__}")


def hash_predicates(columns: Sequence[str], shares: int) -> list[str]:
    """Conditions that deal every row to exactly one of ``shares`` reads, by all its columns.

    Each read scans the rows at the source but sends only its share, however skewed any one
    column is.
    """
    values = ", ".join(quoted(column) for column in columns)
    bucket = f"MOD(CRC32(CONCAT_WS('|', {values})), {shares})"
    return [f"{bucket} = {i}" for i in range(shares)]


def range_predicates(
    key: str,
    low: int,
    width: int,
    rows: Mapping[int | None, int],
    columns: Sequence[str],
    most: int,
) -> list[str]:
    """Conditions that deal every row to exactly one read, by ranges of an integer key.

    ``rows`` counts the rows of range number ``(key - low) DIV width``, and of None for rows
    without a key. Counted ranges only place the borders: the first range is open below, the last
    open above, and each ends where the next starts, so rows that arrive after the count are read
    too, wherever they fall. A range with more than ``most`` rows is dealt out further by hash.
    """
    column = quoted(key)
    held = sorted(number for number, count in rows.items() if number is not None and count)
    borders = [low + number * width for number in held[1:]]
    ranges = [(f"{column} IS NULL", rows.get(None, 0))]
    for i in range(len(borders) + 1):
        limits = []
        if i > 0:
            limits.append(f"{column} >= {borders[i - 1]}")
        if i < len(borders):
            limits.append(f"{column} < {borders[i]}")
        inside = " AND ".join(limits) or f"{column} IS NOT NULL"
        ranges.append((inside, rows[held[i]] if held else 0))
    predicates = []
    for inside, count in ranges:
        shares = max(1, -(-count // most))
        if shares == 1:
            predicates.append(inside)
        else:
            predicates += [f"{inside} AND {share}" for share in hash_predicates(columns, shares)]
    return predicates


def beyond(key: Sequence[str], border: Sequence[object], side: str, equal: bool) -> str:
    """Whether a row's key stands on one ``side`` (``<`` or ``>``) of a border, or is equal to it.

    Keys of several columns are compared column by column, as rows are, but spelled out, with a
    condition on the first column alone in front: sources use an index for that form.
    """
    column, value = quoted(key[0]), literal(border[0])
    if len(key) == 1:
        return f"{column} {side}{'=' if equal else ''} {value}"
    rest = beyond(key[1:], border[1:], side, equal)
    return f"{column} {side}= {value} AND ({column} {side} {value} OR {column} = {value} AND ({rest}))"


def border_predicates(
    key: Sequence[str],
    borders: Sequence[Sequence[object]],
    bare: int,
    most: int,
    columns: Sequence[str],
) -> list[str]:
    """Conditions that deal every row to exactly one read, by borders of any ordered key.

    ``borders`` are keys in the source's order, about ``most`` rows apart. The first range is
    open below, the last open above, and each ends where the next starts, so rows that arrive
    later are read too. A key that several borders share holds more rows than one read should
    have: it gets reads of its own, by a hash of all columns. The ``bare`` rows with a null in
    the key are dealt out likewise.
    """
    some_null = " OR ".join(f"{quoted(column)} IS NULL" for column in key)
    no_null = " AND ".join(f"{quoted(column)} IS NOT NULL" for column in key)

    def dealt(inside: str, shares: int) -> list[str]:
        if shares <= 1:
            return [inside]
        return [f"({inside}) AND {share}" for share in hash_predicates(columns, shares)]

    predicates = dealt(some_null, -(-bare // most))
    start = ""
    for border, run in groupby(tuple(border) for border in borders):
        held = len(list(run))
        predicates.append(f"{no_null} AND {start}({beyond(key, border, '<', False)})")
        if held > 1:
            same = " AND ".join(
                f"{quoted(column)} = {literal(value)}" for column, value in zip(key, border, strict=True)
            )
            predicates += dealt(same, held)
        start = f"({beyond(key, border, '>', held == 1)}) AND "
    predicates.append(f"{no_null} AND {start}".removesuffix(" AND "))
    return predicates


@dataclass(frozen=True)
class JdbcDatabase:
    """One database behind a JDBC URL; ``properties`` carry user, password and driver."""

    spark: SparkSession
    url: str
    database: str
    properties: Mapping[str, str] = field(default_factory=dict)
    fetch_size: int = FETCH_SIZE

    def _options(self) -> dict[str, str]:
        """Times are read as the plain date and time they are stored as, without any zone."""
        fixed = {"fetchsize": str(self.fetch_size), "preferTimestampNTZ": "true"}
        return {**DRIVER_SETTINGS, **self.properties, **fixed}

    def _reader(self) -> DataFrameReader:
        return self.spark.read.format("jdbc").options(**self._options(), url=self.url)

    def query(self, sql: str) -> DataFrame:
        """Result of a statement the database runs itself."""
        return self._reader().option("query", sql).load()

    def list_tables(self) -> list[str]:
        """Names of the database's tables, in order."""
        rows = self.query(
            "SELECT table_name AS table_name FROM information_schema.tables "
            f"WHERE table_schema = {text_literal(self.database)}"
        ).collect()
        return sorted(row["table_name"] for row in rows)

    def declared_schema(self, table: str) -> list[tuple[str, str]]:
        """(column, declared type) in column order; decimals with precision and scale, and
        ``unsigned`` where declared so."""
        rows = self.query(
            "SELECT ordinal_position AS position, column_name AS name, data_type AS type, "
            "column_type AS full_type, numeric_precision AS digits, numeric_scale AS decimals "
            f"FROM information_schema.columns WHERE {self._of(table)}"
        ).collect()
        if not rows:
            raise ValueError(f"no schema found for table {table!r}")
        columns = []
        for row in sorted(rows, key=lambda row: row["position"]):
            declared, full = row["type"].lower(), row["full_type"].lower()
            if declared == "decimal":
                declared = f"decimal({row['digits']},{row['decimals']})"
            elif declared == "bit":
                declared = full
            if "unsigned" in full.split():
                declared += " unsigned"
            columns.append((row["name"], declared))
        return columns

    def ordered_key(self, table: str, declared: Mapping[str, str]) -> list[str]:
        """Columns of the index to split the table by, none without a usable index.

        The primary key is the first choice, then unique indexes, then others, those of fewer
        columns first. Of an index the columns before the first whose type has no plain order,
        or of which only a prefix or an expression is indexed, serve.
        """
        rows = self.query(
            "SELECT index_name AS name, non_unique AS repeats, seq_in_index AS place, "
            "column_name AS col, sub_part AS part "
            f"FROM information_schema.statistics WHERE {self._of(table)}"
        ).collect()
        ranked = []
        ordered = sorted(rows, key=lambda row: (row["name"], row["place"]))
        for name, members in groupby(ordered, key=lambda row: row["name"]):
            members = list(members)
            usable = []
            for row in members:
                kind = declared.get(row["col"], "").split("(")[0].split(" ")[0]
                if row["part"] is not None or kind not in ORDERED_TYPES:
                    break
                usable.append(row["col"])
            if usable:
                rank = (name != "PRIMARY", int(members[0]["repeats"]), len(members), name)
                ranked.append((rank, usable))
        return min(ranked)[1] if ranked else []

    def read_table(
        self,
        table: str,
        key: str | Sequence[str] | None = None,
        partitions: int | None = None,
        by_hash: bool = False,
    ) -> DataFrame:
        """The whole table, in about as many even reads as ``partitions``, or cores.

        Each read asks for a range of ``key``, one or several columns of any ordered type, by
        default those of the primary key or of another index. Ranges start and end at keys that
        the source has counted off, so they are even however the keys are spread; ranges of one
        integer are even steps, of which too full ones are split. A table without any index, or
        with ``by_hash``, is dealt out by a hash of all columns, for which the source scans it
        once per read.
        """
        declared = dict(self.declared_schema(table))
        columns = list(declared)
        reads = partitions or self.spark.sparkContext.defaultParallelism
        chosen = [key] if isinstance(key, str) else list(key or ())
        unknown = [column for column in chosen if column not in declared]
        if unknown:
            raise ValueError(f"table {table!r} has no columns {unknown}")
        for column in chosen:
            kind = declared[column].split("(")[0].split(" ")[0]
            if kind not in ORDERED_TYPES:
                raise ValueError(f"column {column!r} of table {table!r} has no order to split by: {kind}")
        if not by_hash:
            chosen = chosen or self.ordered_key(table, declared)
        if by_hash or not chosen:
            predicates = hash_predicates(columns, reads)
        elif len(chosen) == 1 and declared[chosen[0]].split(" ")[0] in INTEGER_TYPES:
            predicates = self._key_predicates(table, chosen[0], reads, columns)
        else:
            predicates = self._border_predicates(table, chosen, reads, columns)
        return self.spark.read.jdbc(
            self.url, quoted(table), predicates=predicates, properties=self._options()
        )

    def _border_predicates(
        self, table: str, key: Sequence[str], reads: int, columns: Sequence[str]
    ) -> list[str]:
        """The source sorts the key once and gives back every so many-th; it keeps none waiting here."""
        source, names = quoted(table), ", ".join(quoted(column) for column in key)
        some_null = " OR ".join(f"{quoted(column)} IS NULL" for column in key)
        no_null = " AND ".join(f"{quoted(column)} IS NOT NULL" for column in key)
        counted = self.query(
            f"SELECT COUNT(*) AS held, SUM(CASE WHEN {some_null} THEN 1 ELSE 0 END) AS bare FROM {source}"
        ).first()
        held, bare = int(counted["held"]), int(counted["bare"] or 0)
        most = max(1, -(-held // reads))
        rows = self.query(
            f"SELECT * FROM (SELECT {names}, ROW_NUMBER() OVER (ORDER BY {names}) AS border_place "
            f"FROM {source} WHERE {no_null}) AS ranked WHERE border_place % {most} = 0"
        ).collect()
        ordered = sorted(rows, key=lambda row: row["border_place"])
        return border_predicates(key, [tuple(row)[:-1] for row in ordered], bare, most, columns)

    def _key_predicates(
        self, table: str, key: str, reads: int, columns: Sequence[str]
    ) -> list[str]:
        column, source = quoted(key), quoted(table)
        bounds = self.query(f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {source}")
        low, high = bounds.first()
        low, high = (0, 0) if low is None else (int(low), int(high))
        width = (high - low) // reads + 1
        counted = self.query(
            f"SELECT ({column} - {low}) DIV {width} AS number, COUNT(*) AS held FROM {source} "
            f"GROUP BY ({column} - {low}) DIV {width}"
        ).collect()
        rows = {None if number is None else int(number): held for number, held in counted}
        most = max(1, -(-sum(rows.values()) // reads))
        return range_predicates(key, low, width, rows, columns, most)

    def _of(self, table: str) -> str:
        return f"table_schema = {text_literal(self.database)} AND table_name = {text_literal(table)}"
