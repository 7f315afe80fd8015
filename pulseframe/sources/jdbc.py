"""Tables over JDBC, read in parallel slices.

One read per table, joined in Spark: pushing the whole join into the database
would deliver it through a single connection and task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.schemas import CLINICAL_SCHEMAS, ClinicalTables

WHOLE = ("1 = 1",)


@dataclass(frozen=True)
class JdbcConnection:
    host: str
    dbname: str
    user: str
    password: str
    port: int = 5432
    driver: str = "org.postgresql.Driver"
    ssl_mode: str | None = None
    fetch_size: int = 10_000
    explicit_url: str | None = None

    @property
    def url(self) -> str:
        if self.explicit_url:
            return self.explicit_url
        address = f"jdbc:postgresql://{self.host}:{self.port}/{self.dbname}"
        return f"{address}?sslmode={self.ssl_mode}" if self.ssl_mode else address

    @property
    def properties(self) -> dict[str, str]:
        return {
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
        }


def range_slices(column: str, lower: int, upper: int, slices: int) -> list[str]:
    """WHERE clauses that cut an integer column into `slices` ranges.

    They are disjoint and cover every row: the end slices are open, and the
    first takes NULLs too. Each can use an index on the column. A value that
    holds a large share of the rows stays in one slice; see modulus_slices.
    """
    slices = min(slices, upper - lower)
    if slices < 2:
        return list(WHOLE)
    cuts = [lower + (upper - lower) * i // slices for i in range(1, slices)]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def cut_slices(column: str, cuts: Sequence[int]) -> list[str]:
    """WHERE clauses for the ranges between cut points; disjoint, and together they cover every row."""
    cuts = sorted(set(cuts))
    if not cuts:
        return list(WHOLE)
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def quantile_cuts(rows: DataFrame, column: str, slices: int, accuracy: int = 10_000) -> list[int]:
    """Cut points of an integer column between `slices` parts of about equal row count.

    From a quantile summary that is built where the rows are: its error is a fraction 1/accuracy of all rows. A table landed
    before, or a part of it, may stand for the source's. Ranges of equal width would follow the
    numbers, not the rows: most may lie in one of them.
    """
    places = [i / slices for i in range(1, slices)]
    if not places:
        return []
    found = rows.agg(F.percentile_approx(column, places, accuracy).alias("cuts")).first()["cuts"]
    return sorted({int(cut) for cut in found or []})


def quantile_query(table: str, column: str, slices: int) -> str:
    """A query, for the database itself, with the first value of each of `slices` parts of equal row count but the first."""
    parts = f"SELECT {column} AS v, NTILE({slices}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL"
    return f"SELECT MIN(v) AS cut FROM ({parts}) parts WHERE part > 1 GROUP BY part ORDER BY cut"


def read_quantile_cuts(spark: SparkSession, connection: JdbcConnection, table: str, column: str, slices: int) -> list[int]:
    """The cut points as the database finds them: one row for each slice."""
    reader = spark.read.format("jdbc").options(url=connection.url, query=quantile_query(table, column, slices), **connection.properties)
    return [int(row[0]) for row in reader.load().collect()]


def modulus_slices(columns: Sequence[str], slices: int) -> list[str]:
    """WHERE clauses by the remainder of the columns' sum, for skewed tables.

    Adding a column that differs between the rows of one admission, such as the
    item code or a row number, spreads a huge admission over all slices.
    """
    total = " + ".join(f"MOD(COALESCE({column}, 0), {slices})" for column in columns)
    return [f"ABS(MOD({total}, {slices})) = {part}" for part in range(slices)]


def slice_number(slices: Sequence[str]) -> Column:
    """Which slice a row falls into, as a Spark column; NULL if none takes it."""
    taken = [F.when(F.expr(clause), F.lit(number)) for number, clause in enumerate(slices)]
    return F.coalesce(*taken)


def read_jdbc(
    spark: SparkSession,
    connection: JdbcConnection,
    table: str,
    slices: Sequence[str] = WHOLE,
) -> DataFrame:
    """One connection and task per slice. Filters and column lists that later
    steps need are pushed into each slice's query by Catalyst."""
    return spark.read.jdbc(
        connection.url, table, predicates=list(slices), properties=connection.properties
    )


def read_clinical_jdbc(
    spark: SparkSession,
    connection: JdbcConnection,
    slices: Mapping[str, Sequence[str]] | None = None,
    codes: Sequence[int] | None = None,
) -> ClinicalTables:
    """The four clinical tables; `slices` holds WHERE clauses for those read in parallel.

    With `codes`, only valid readings of these item codes are read. Spark cannot know a database
    table's size: see staging.land.
    """
    slices = slices or {}
    raw = {
        name: read_jdbc(spark, connection, name, slices.get(name, WHOLE)) for name in CLINICAL_SCHEMAS
    }
    return typed_tables(raw, codes)


def typed_tables(raw: Mapping[str, DataFrame], codes: Sequence[int] | None = None) -> ClinicalTables:
    """The tables in the declared types, whatever types the source has.

    A filter on a cast column stays in Spark, so readings are filtered before their columns are cast:
    then the conditions are part of each slice's query. A code column of text is compared as text.
    """
    tables = dict(raw)
    if codes is not None:
        readings = raw["chartevents"]
        kind = readings.schema["itemid"].dataType
        listed = [F.lit(code).cast(kind) for code in codes]
        tables["chartevents"] = readings.where(
            F.col("itemid").isin(listed) & F.col("error").isNull() & F.col("valuenum").isNotNull()
        )
    return ClinicalTables(
        **{
            name: tables[name].select([F.col(f.name).cast(f.dataType) for f in schema.fields])
            for name, schema in CLINICAL_SCHEMAS.items()
        }
    )
