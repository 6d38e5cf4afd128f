from dataclasses import replace

import pytest
from frames import AS_OF, rows, sub_row, tables, type_row, visit_row

from catalog_signals import build_report, read_tables
from catalog_signals.operators import lookup, scope
from catalog_signals.operators.audit import audit_of_reductions, source_row_audit, table_profile
from catalog_signals.operators.versions import latest_types
from catalog_signals.plans import jobs, outputs
from catalog_signals.plans.report import analysed, evidence_frame, reduced_inputs
from catalog_signals.sources import scans, sinks, snapshots
from catalog_signals.sources.tables import TABLE_NAMES


def example(spark, clients="AB"):
    return tables(
        spark,
        types=[type_row(c, t, "x" if t != "3" else "Yard", FREQUENCY="1") for c in clients for t in "123"],
        merged=[("1", "A", "x")],
        visits=[visit_row(client=c, type_id=t) for c in clients for t in "12"],
        subs=[sub_row(client=c, type_id="1") for c in clients],
        lookup=[("A", "x", "TRUE"), ("A", "x", "FALSE")],
    )


def test_written_reports_can_be_replaced(spark, tmp_path):
    folder = str(tmp_path)
    report = build_report(example(spark), AS_OF)
    for _ in range(2):
        written = sinks.write_report(report, folder)
        assert set(written) == {"report", "review_queue", "ask_client", "settled_summary"}
        assert rows(snapshots.read_outputs(spark, folder)["report"], "*") == rows(report, "*")
        assert rows(written["review_queue"], "*") == rows(outputs.review_queue(report), "*")
        assert rows(written["settled_summary"], "*") == rows(outputs.settled_summary(report), "*")


def test_tables_are_replaced(spark):
    report = build_report(example(spark), AS_OF)
    for _ in range(2):
        assert rows(sinks.write_table(report, "report_under_test"), "*") == rows(report, "*")
    spark.sql("DROP TABLE report_under_test")


def test_a_run_replaces_only_its_own_clients(spark, tmp_path):
    path = str(tmp_path / "clients")
    sinks.write_per_client(build_report(example(spark), AS_OF), path)
    sinks.write_per_client(build_report(example(spark, "A"), AS_OF).where("TYPE_ID = 1"), path)
    a, b = (sinks.read_client_report(spark, path, c) for c in "AB")
    assert (a["report"].count(), b["report"].count()) == (1, 3)
    assert b["ask_client"].count() + b["settled_summary"].count() == 3
    assert rows(b["report"], "*") == rows(build_report(example(spark, "B"), AS_OF), "*")


def test_a_covered_client_without_rows_loses_its_folder(spark, tmp_path):
    path, report = str(tmp_path / "clients"), build_report(example(spark), AS_OF)
    sinks.write_per_client(report, path)
    sinks.write_per_client(report.limit(0), path, covered=["A", "Z"])
    left = sinks.read_delivery(spark, path)
    assert rows(left.select("Client").distinct(), "Client") == [("B",)]
    sinks.write_per_client(report.where("Client = 'A'"), path, everyone=True)
    assert rows(sinks.read_delivery(spark, path).select("Client").distinct(), "Client") == [("A",)]


def test_a_corrupt_file_spoils_its_own_table_only(spark, tmp_path):
    good, bad = str(tmp_path / "good"), tmp_path / "bad"
    spark.range(5).write.parquet(good)
    spark.range(5).repartition(2).write.parquet(str(bad))
    sorted(bad.glob("part-*"))[0].write_bytes(b"PAR1 broken")
    schema = spark.read.parquet(good).schema
    openers = {"good": lambda: spark.read.parquet(good), "bad": lambda: spark.read.schema(schema).parquet(str(bad))}
    profile = {r.table_name: r for r in table_profile(spark, openers).collect()}
    assert profile["good"].num_rows == 5 and profile["good"].error is None
    assert profile["bad"].num_rows is None and profile["bad"].error


def test_tables_are_read_by_path_or_name(spark, tmp_path):
    inputs = example(spark)
    for attribute, name in TABLE_NAMES.items():
        getattr(inputs, attribute).write.parquet(f"{tmp_path}/{name}")
        getattr(inputs, attribute).createOrReplaceTempView(f"v_{name}")
    expected = rows(build_report(inputs, AS_OF), "*")
    assert rows(build_report(read_tables(spark, path=str(tmp_path)), AS_OF), "*") == expected
    named = read_tables(spark, {a: f"v_{n}" for a, n in TABLE_NAMES.items()})
    assert rows(build_report(named, AS_OF), "*") == expected


def test_source_row_audit(spark):
    got = source_row_audit(example(spark)).orderBy("clientId").collect()
    assert [r.asDict() for r in got] == [
        {"clientId": "A", "service_types": 3, "merged_service_types": 1, "recurring_lookup": 2,
         "before_dedupe": 5, "after_dedupe": 3, "appointments": 2, "subscriptions": 1, "unread_amounts": 0},
        {"clientId": "B", "service_types": 3, "merged_service_types": 0, "recurring_lookup": 0,
         "before_dedupe": 3, "after_dedupe": 3, "appointments": 2, "subscriptions": 1, "unread_amounts": 0},
    ]


def test_table_profile_walks_nested_fields_and_survives_a_bad_table(spark):
    nested = spark.createDataFrame(
        [], "id bigint NOT NULL COMMENT 'key', tags array<string>, "
        "address struct<street: string, geo: struct<lat: double>>, lines array<struct<n: int>>"
    )
    profile = table_profile(
        spark,
        {"nested": nested, "three": spark.range(3), "missing": lambda: spark.read.parquet("/nowhere")},
    )
    found = [tuple(r) for r in profile.select("table_name", "field_path", "field_type", "mode", "comment", "num_rows").collect()]
    assert sorted(r for r in found if r[0] == "nested") == sorted([
        ("nested", "id", "bigint", "REQUIRED", "key", 0),
        ("nested", "tags", "string", "REPEATED", None, 0),
        ("nested", "address", "struct", "NULLABLE", None, 0),
        ("nested", "address.street", "string", "NULLABLE", None, 0),
        ("nested", "address.geo", "struct", "NULLABLE", None, 0),
        ("nested", "address.geo.lat", "double", "NULLABLE", None, 0),
        ("nested", "lines", "struct", "REPEATED", None, 0),
        ("nested", "lines.n", "int", "NULLABLE", None, 0),
    ])
    assert ("three", "id", "bigint", "REQUIRED", None, 3) in found
    bad = profile.where("table_name = 'missing'").collect()
    spark.sql("CREATE TABLE profiled (n int COMMENT 'count') USING parquet COMMENT 'about it'")
    by_name = table_profile(spark, {"p": "profiled", "q": "no_such_table"}).collect()
    spark.sql("DROP TABLE profiled")
    assert [(r.field_path, r.comment, r.table_comment, r.num_rows) for r in by_name if r.table_name == "p"] == [
        ("n", "count", "about it", 0)
    ]
    assert ["no_such_table" in r.error for r in by_name if r.table_name == "q"] == [True]
    assert len(bad) == 1 and bad[0].num_rows is None and "nowhere" in bad[0].error


def test_batch_runs(spark, tmp_path):
    inputs, folder = example(spark), str(tmp_path)
    written = jobs.run_report(inputs, AS_OF, f"{folder}/a")
    used = outputs.activity_filter(build_report(inputs, AS_OF))
    assert rows(written["report"], "*") == rows(used, "*")
    assert written["report"].count() == 4  # type 3 of either client is not in use
    client = sinks.read_client_report(spark, f"{folder}/a", "B")
    assert rows(client["report"], "*") == rows(used.where("Client = 'B'"), "*")
    assert rows(written["metrics"], "*") == rows(outputs.review_metrics(analysed(inputs, AS_OF)), "*")
    assert rows(written["audit"], "*") == rows(source_row_audit(inputs), "*")
    types = latest_types(scope.scoped_service_types(inputs.service_types), "clientId")
    mismatches = lookup.reference_mismatch(types, scans.scan_merged_service_types(inputs.merged_service_types))
    assert rows(written["mismatches"], "*") == rows(mismatches, "*")
    # a client that lost its activity loses its folder with the next run
    quiet = replace(inputs, visits=inputs.visits.where("clientID <> 'B'"), subscriptions=inputs.subscriptions.where("clientID <> 'B'"))
    jobs.run_report(quiet, AS_OF, f"{folder}/a", clients="A, B")
    left = sinks.read_delivery(spark, f"{folder}/a").select("Client").distinct()
    assert rows(left, "Client") == [("A",)]
    unfiltered = jobs.run_unfiltered_report(inputs, AS_OF, f"{folder}/b", clients=["A"])
    assert unfiltered["report"].count() == 5
    assert "Appointment Share Pct" not in unfiltered["review_queue"].columns
    shares = jobs.run_share_report(inputs, f"{folder}/c")
    assert rows(shares, "clientId", "TYPE_ID", "appointmentSharePct") == [
        ("A", 1, 50.0), ("A", 2, 50.0), ("B", 1, 50.0), ("B", 2, 50.0),
    ]


def test_reductions_replace_the_inputs(spark):
    """Evidence and audit taken from one reduction of every input are those of the inputs, for all clients."""
    inputs = example(spark)
    visits = inputs.visits.unionByName(inputs.visits.limit(1).selectExpr("* EXCEPT (type)", "'unknown' AS type"))
    more = spark.createDataFrame([sub_row("n/a", "x", "C"), sub_row("$1", "2", "A"), sub_row("1e400", "2", "B")], inputs.subscriptions.schema)
    inputs = replace(inputs, visits=visits, subscriptions=inputs.subscriptions.unionByName(more))
    stored = {}

    def store(name, df):
        stored[name] = spark.createDataFrame(df.collect(), df.schema)
        return stored[name]

    reduced = reduced_inputs(inputs, store)
    once, twice = (evidence_frame(t) for t in (reduced, inputs))
    columns = sorted(twice.columns)
    assert set(stored) == {"versions", "names", "history", "usage", "validation"}
    assert rows(once, *columns) == rows(twice, *columns)
    audit = audit_of_reductions(**stored)
    assert audit.columns == source_row_audit(inputs).columns
    assert rows(audit, "*") == rows(source_row_audit(inputs), "*")
    with pytest.raises(ValueError):
        evidence_frame(reduced, dedupe=False)


def test_row_counts_read_no_data_pages(spark, tmp_path):
    """Files whose pages are spoilt and whose footers are whole are counted, side by side."""
    for n in range(3):
        spark.range(1000 * (n + 1)).selectExpr("id", "uuid() AS t").coalesce(1).write.parquet(f"{tmp_path}/t{n}")
        for file in (tmp_path / f"t{n}").glob("part-*"):
            data = bytearray(file.read_bytes())
            footer = int.from_bytes(data[-8:-4], "little")
            data[4 : len(data) - 8 - footer] = b"\xff" * (len(data) - 12 - footer)
            file.write_bytes(bytes(data))
            (tmp_path / f"t{n}" / f".{file.name}.crc").unlink()
    names = {f"t{n}": (lambda n=n: spark.read.parquet(f"{tmp_path}/t{n}")) for n in range(3)}
    got = {(r.table_name, r.num_rows, r.error) for r in table_profile(spark, names, at_once=3).collect()}
    assert got == {("t0", 1000, None), ("t1", 2000, None), ("t2", 3000, None)}
    with pytest.raises(Exception):
        spark.read.parquet(f"{tmp_path}/t0").agg({"id": "sum"}).collect()
    assert table_profile(spark, {}).count() == 0


def test_clients_and_aliases_by_list_and_by_frame(spark, monkeypatch):
    """The same rows, whether names are literals, a broadcast or shuffled table, or a DataFrame."""
    inputs = example(spark, "ABCDE")
    aliases = {"AB": ["A", "B"], "C": ["C", "D"], "BC": ["B", "C"]}
    for names in (["AB", "E"], ["C"], ["A", "E", "nobody"], ["AB", "BC", "C", "AB"], ["nobody"], ["B"]):
        frame = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
        expected = scope.scoped_service_types(inputs.service_types, names, aliases)
        facts = scope.roll_up_facts(inputs, names, aliases)
        columns = expected.columns
        assert rows(scope.scoped_service_types(inputs.service_types, frame, aliases), *columns) == rows(expected, *columns)
        by_frame = scope.roll_up_facts(inputs, frame, aliases)
        for table, column in (("visits", "clientID"), ("lookup", "clientId"), ("subscriptions", "clientID")):
            mine, theirs = (
                rows(scans.of_clients(getattr(t, table), c, column), "*") for t, c in ((facts, names), (by_frame, frame))
            )
            assert mine == theirs
        short = rows(scans.of_clients(inputs.visits, names, "clientID"), "*")
        monkeypatch.setattr(scans, "MOST_LISTED", 0)
        for threshold in ("10MB", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            assert rows(scans.of_clients(inputs.visits, names, "clientID"), "*") == short
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        monkeypatch.undo()
