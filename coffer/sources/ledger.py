"""Raw ledger tables of all clients."""

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coffer.schemas import CLIENT, RAW_COLUMNS
from coffer.sources.catalog import table_exists


BAD_BOOLEANS = "bad_booleans"


def conform(df, table, cast="CAST", count_bad=False):
    """Project a raw frame onto the columns the engine uses, with their types.

    Column names match without regard to case.  A missing column raises here,
    by name, rather than deep inside a query.  ``count_bad`` adds how many of a
    row's booleans are stored as something else; they read as NULL.
    """
    stored = {field.name.lower(): field for field in df.schema}
    wanted = {CLIENT: "string", **RAW_COLUMNS[table]}
    missing = [name for name in wanted if name.lower() not in stored]
    if missing:
        raise ValueError(f"table {table!r} lacks columns {missing}")
    columns, bad = [], ["0"]
    cast = "try_cast" if count_bad else cast
    for name, kind in wanted.items():
        found = stored[name.lower()]
        if kind == "boolean":
            bad.append(f"CAST({unparsable(f'`{found.name}`', kind)} AS INT)")
        if kind and found.dataType.simpleString() != kind:
            columns.append(f"{cast}(`{found.name}` AS {kind}) AS {name}")
        else:
            columns.append(f"`{found.name}` AS {name}")
    if count_bad:
        columns.append(f"{' + '.join(bad)} AS {BAD_BOOLEANS}")
    return df.selectExpr(*columns)


def unparsable(value, kind):
    """SQL condition: a value that a strict cast would raise on."""
    return f"({value} IS NOT NULL AND try_cast(CAST({value} AS STRING) AS {kind}) IS NULL)"


def stored_schema(spark, path, fmt="parquet"):
    """Schema of a directory partitioned by client, client names being text.

    Partition discovery would turn a client called ``007`` into the number 7.
    """
    inferred = spark.read.format(fmt).load(path).schema
    return T.StructType(
        [T.StructField(CLIENT, T.StringType()) if f.name == CLIENT else f for f in inferred]
    )


def by_client(df, clients, how):
    """Semi or anti join on the client; a missing client is a client like any other."""
    named = clients.select(F.col(CLIENT).alias("_named"))
    return df.join(named, F.col(CLIENT).eqNullSafe(F.col("_named")), how)


@dataclass(frozen=True)
class Ledger:
    """The ten raw tables under one root, or given as frames.

    ``clients`` restricts every table to some clients; with data partitioned by
    client that is partition pruning.  ``excluded`` is a frame of clients to leave
    out.  ``amount_type`` is the type money is summed in: ``double`` as
    in the source systems, or a decimal type for sums that do not depend on order.
    ``on_zero_total`` is ``raise`` or ``null``, for documents with total zero.
    """

    spark: SparkSession
    root: str | None = None
    clients: tuple | None = None
    layout: str = "{root}/{table}"
    fmt: str = "parquet"
    frames: dict | None = None
    excluded: DataFrame | None = None
    amount_type: str = "double"
    on_zero_total: str = "raise"
    # Schemas read so far, by path: each table's files are opened for it once.
    schemas: dict = field(default_factory=dict, repr=False, compare=False)

    def path(self, table):
        return self.layout.format(root=self.root, table=table)

    def table(self, name):
        if name not in RAW_COLUMNS:
            raise KeyError(f"unknown ledger table {name!r}")
        # Clients go before types change.  Filters may still move below that join, so a cast
        # that only an excluded client's row fails must not raise there.
        cast = "CAST" if self.excluded is None else "try_cast"
        return conform(self.in_scope(self.raw(name)), name, cast)

    def checked(self, name):
        """A table of the clients in scope in which bad values are NULL, and bad booleans counted."""
        return conform(self.in_scope(self.raw(name)), name, count_bad=True)

    def raw(self, name):
        """A table as it is stored, of all clients."""
        if self.frames and name in self.frames:
            return self.frames[name]
        path = self.path(name)
        if path not in self.schemas:
            self.schemas[path] = stored_schema(self.spark, path, self.fmt)
        return self.spark.read.format(self.fmt).schema(self.schemas[path]).load(path)

    def in_scope(self, df):
        """Rows of the clients that this ledger covers."""
        if self.clients is not None:
            df = df.filter(F.col(CLIENT).isin(*self.clients))
        return df if self.excluded is None else by_client(df, self.excluded, "left_anti")

    def has(self, name):
        if self.frames and name in self.frames:
            return True
        return self.root is not None and table_exists(self.spark, self.path(name))

    def with_options(self, **changes):
        return replace(self, **changes)
