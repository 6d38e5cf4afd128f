"""Writing the reports. Every write replaces the previous run's data, all of it at one moment."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_signals.plans.outputs import review_queue, review_split, settled_summary
from catalog_signals.plans.report import REPORT_SCHEMA
from catalog_signals.sources.snapshots import Manifest, Snapshot, _Store, latest, open_entry

#: The delivery per client: which layer holds a client's rows.
_INDEX = "client_index"
#: A delivery of more layers than this is written anew as one.
MOST_LAYERS = 16


def conform(report: DataFrame) -> DataFrame:
    """The declared columns in the declared order and types; a missing column is an error."""
    return report.to(REPORT_SCHEMA)


def write_table(df: DataFrame, table: str) -> DataFrame:
    """Replace the rows of ``table`` and return it.

    The rows are written to a new folder beside the table's others, and one change of the catalogue points
    the table there; until then, and if the write fails, the table has its former rows. The folder before
    stays, for queries that are reading it; older ones go. A table of other columns isn't replaced.
    """
    spark = df.sparkSession
    root = f"{spark.conf.get('spark.sql.warehouse.dir')}/{table}.versions"
    version = uuid.uuid4().hex
    if spark.catalog.tableExists(table) and spark.table(table).schema.simpleString() != df.schema.simpleString():
        raise ValueError(f"{table} has other columns")
    df.write.parquet(f"{root}/{version}")
    before = None
    if spark.catalog.tableExists(table):
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
        before = described["Location"].rstrip("/").rsplit("/", 1)[-1]
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{root}/{version}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=f"{root}/{version}", source="parquet", schema=df.schema)
    store = _Store(spark, root)
    for status in store.listed():
        if status.getPath().getName() not in (version, before):
            store.delete(status.getPath().getName())
    return spark.table(table)


def report_outputs(
    run: Snapshot, report: DataFrame, queue: Callable[[DataFrame], DataFrame] = review_queue
) -> dict[str, DataFrame]:
    """``report``, ``review_queue``, ``ask_client`` and ``settled_summary``, as outputs of ``run``.

    The report is computed once and written; the other three are cut from the written files.
    """
    written = run.write("report", conform(report))
    parts = {
        "review_queue": queue(written),
        "ask_client": review_split(written)[0],
        "settled_summary": settled_summary(written),
    }
    return {"report": written, **{n: run.write(n, df) for n, df in parts.items()}}


def write_report(
    report: DataFrame, folder: str, queue: Callable[[DataFrame], DataFrame] = review_queue
) -> dict[str, DataFrame]:
    """The four outputs of a report under ``folder``, to be read with ``read_outputs``."""
    with Snapshot(report.sparkSession, folder) as run:
        return report_outputs(run, report, queue)


def _names(spark: SparkSession, clients: Sequence[str] | DataFrame) -> DataFrame:
    if isinstance(clients, DataFrame):
        return clients.select(F.col(clients.columns[0]).cast("string").alias("Client"))
    return spark.createDataFrame([(c,) for c in clients], "Client string")


def _layer_rows(spark: SparkSession, folder: str, manifest: Manifest) -> DataFrame | None:
    """The delivered rows of all clients, each from the layer that the index names."""
    if _INDEX not in manifest.outputs:
        return None
    index = open_entry(spark, folder, manifest.outputs[_INDEX])
    live = None
    for name, entry in manifest.layers.items():
        own = index.where(F.col("layer") == name).select("Client")
        rows = conform(open_entry(spark, folder, entry).join(own, "Client", "left_semi"))
        live = rows if live is None else live.unionByName(rows)
    return live


def deliver(
    run: Snapshot,
    report: DataFrame,
    covered: Sequence[str] | DataFrame = (),
    everyone: bool = False,
    fmt: str = "parquet",
) -> None:
    """A folder per client, as a part of ``run``; it replaces those of the clients that it covers and no others.

    Those are the clients of the report and ``covered``, which have no rows any more if they have none
    here; with ``everyone``, all. Nothing is deleted or moved: the rows are a new layer, and the index,
    written anew in one job, names the layer of every client. ``rebalance`` gathers a client's rows
    into few files, and splits those of a huge client.
    """
    spark = run.spark
    rows, layers = conform(report), dict(run.layers)
    index = open_entry(spark, run.folder, run.outputs[_INDEX]) if _INDEX in run.outputs else None
    if everyone or index is None:
        layers, index = {}, None
    else:
        gone = _names(spark, covered).unionByName(rows.select("Client").distinct())
        index = index.join(gone, "Client", "left_anti")
        if len(layers) >= MOST_LAYERS:
            before = _layer_rows(spark, run.folder, Manifest(0, run.outputs, layers))
            rows = rows.unionByName(conform(before.join(gone, "Client", "left_anti")))
            layers, index = {}, None
    layers[run.run] = run.save("clients", rows.hint("rebalance", "Client"), fmt, ("Client",))
    written = open_entry(spark, run.folder, layers[run.run])
    own = written.select("Client").distinct().withColumn("layer", F.lit(run.run))
    index = own if index is None else index.unionByName(own)
    run.write(_INDEX, index)
    run.layers = layers


def write_per_client(
    report: DataFrame,
    folder: str,
    fmt: str = "parquet",
    covered: Sequence[str] | DataFrame = (),
    everyone: bool = False,
) -> None:
    """``deliver`` as a run of its own."""
    with Snapshot(report.sparkSession, folder) as run:
        deliver(run, report, covered, everyone, fmt)


def read_delivery(spark: SparkSession, folder: str) -> DataFrame:
    """The delivered rows of all clients."""
    rows = _layer_rows(spark, folder, latest(spark, folder))
    return spark.createDataFrame([], REPORT_SCHEMA) if rows is None else rows


def read_client_report(spark: SparkSession, folder: str, client: str) -> dict[str, DataFrame]:
    """One client's delivery: all rows, the rows to ask about, the settled summary. The last two are
    cut from the client's folder, so they can never be older than the first."""
    manifest, rows = latest(spark, folder), spark.createDataFrame([], REPORT_SCHEMA)
    if _INDEX in manifest.outputs:
        index = open_entry(spark, folder, manifest.outputs[_INDEX])
        of = index.where(F.col("Client") == client).first()
        if of:
            rows = conform(open_entry(spark, folder, manifest.layers[of.layer])).where(F.col("Client") == client)
    return {
        "report": rows,
        "ask_client": review_split(rows)[0],
        "settled_summary": settled_summary(rows),
    }
