"""Row counts per source and client, and table profiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_signals.operators.lookup import lookup_match_count
from catalog_signals.operators.ranking import unread_amount
from catalog_signals.operators.scope import scoped_service_types
from catalog_signals.operators.spread import splittable_join
from catalog_signals.operators.versions import latest_version
from catalog_signals.sources.scans import Clients, of_clients, scan_lookup, scan_subscriptions
from catalog_signals.sources.tables import CatalogTables


def source_row_audit(
    tables: CatalogTables, clients: Clients = None, aliases: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Per client: rows of each source, catalogue rows before and after the dedupe by type, and
    subscriptions whose amount is given but can't be summed. Rows without a client are no one's.

    Each source is reduced to one row per client inside its tasks; the counts are then stacked and
    summed, so that no source has to be joined to another.
    """
    versions = latest_version(scoped_service_types(tables.service_types, clients, aliases), "clientId")
    matched = lookup_match_count(versions, scan_lookup(tables.lookup, clients))

    def rows_of(df: DataFrame, client: str = "clientID") -> DataFrame:
        return of_clients(df, clients, client).groupBy(F.col(client).alias("clientId")).agg(
            F.count(F.lit(1)).alias("n")
        )

    subscriptions = scan_subscriptions(tables.subscriptions, clients)
    counts = {
        "service_types": rows_of(versions, "clientId"),
        "merged_service_types": rows_of(tables.merged_service_types),
        "recurring_lookup": rows_of(tables.lookup, "clientId"),
        "before_dedupe": matched.groupBy("clientId").agg(F.sum("copies").alias("n")),
        "after_dedupe": rows_of(versions.select("clientId", "TYPE_ID").distinct(), "clientId"),
        "appointments": rows_of(tables.visits),
        "subscriptions": rows_of(tables.subscriptions),
        "unread_amounts": rows_of(subscriptions.where(unread_amount()), "clientId"),
    }
    return _stacked(counts)


def audit_of_reductions(
    versions: DataFrame, names: DataFrame, history: DataFrame, usage: DataFrame, validation: DataFrame
) -> DataFrame:
    """``source_row_audit`` out of what a report has reduced its inputs to, without reading them again.

    Exact whatever is run again after a lost executor, which counters kept beside a running query are not.
    """
    matches = F.col("n_true") + F.col("n_false") + F.col("n_other")

    def per_client(df: DataFrame, rows: Column) -> DataFrame:
        return df.groupBy("clientId").agg(F.sum(rows).alias("n"))

    one = F.lit(1).cast("bigint")
    by_name = names.select("clientId", F.col("serviceType").alias("DESCRIPTION"), matches.alias("_matches"))
    keys = ["clientId", "DESCRIPTION"]
    named = splittable_join(versions, by_name, keys, null_safe=["DESCRIPTION"])
    return _stacked({
        "service_types": per_client(versions, one),
        "merged_service_types": per_client(validation, F.col("copies")),
        "recurring_lookup": per_client(names, matches),
        "before_dedupe": per_client(named, F.greatest(F.coalesce("_matches", one), one)),
        "after_dedupe": per_client(versions.select("clientId", "TYPE_ID").distinct(), one),
        "appointments": per_client(history, F.col("type_visits")),
        "subscriptions": per_client(usage, F.col("subscriptions")),
        "unread_amounts": per_client(usage, F.col("unread")),
    })


def _stacked(counts: dict[str, DataFrame]) -> DataFrame:
    """One row per client with a column per source, 0 where a source has none of the client."""
    stacked = reduce(
        DataFrame.unionByName,
        [df.select("clientId", "n", F.lit(name).alias("source")) for name, df in counts.items()],
    )
    return stacked.groupBy("clientId").agg(
        *[F.sum(F.when(F.col("source") == s, F.col("n")).otherwise(0)).alias(s) for s in counts]
    )


def field_rows(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, str, str, str | None]]:
    """(path, type, mode, comment) per field, nested ones after their parent. An array counts as a
    repeated field of its element type."""
    for field in schema.fields:
        path = f"{prefix}{field.name}"
        dtype, mode = field.dataType, "NULLABLE" if field.nullable else "REQUIRED"
        while isinstance(dtype, T.ArrayType):
            dtype, mode = dtype.elementType, "REPEATED"
        is_struct = isinstance(dtype, T.StructType)
        yield path, "struct" if is_struct else dtype.simpleString(), mode, field.metadata.get("comment")
        if is_struct:
            yield from field_rows(dtype, f"{path}.")


_FIELDS = (
    "table_name string, field_path string, field_type string, mode string, comment string, "
    "table_comment string, error string, num_rows bigint"
)


def table_profile(
    spark: SparkSession, tables: Mapping[str, str | DataFrame | Callable[[], DataFrame]], at_once: int = 8
) -> DataFrame:
    """One row per table and field path, with the table's row count.

    A table is given as a catalogue name, a DataFrame, or a function that opens it. One that cannot be
    opened or counted yields a single row with the error, and the others their profile; hence a job of
    its own for each count, which is a single number. ``at_once`` of these jobs run side by side. A
    count asks for no column, so Parquet is counted from its footers.
    """

    def profile(name: str) -> list[tuple]:
        source, table_comment = tables[name], None
        try:
            if isinstance(source, str):
                df, table_comment = spark.table(source), spark.catalog.getTable(source).description
            else:
                df = source() if callable(source) else source
            rows, total = list(field_rows(df.schema)), df.count()
        except (PySparkException, Py4JError) as problem:
            return [(name, None, None, None, None, None, str(problem), None)]
        return [(name, *row, table_comment, None, total) for row in rows]

    with ThreadPoolExecutor(max(1, min(at_once, len(tables)))) as pool:
        profiles = list(pool.map(inheritable_thread_target(spark)(profile), tables))
    return spark.createDataFrame([row for rows in profiles for row in rows], _FIELDS)
