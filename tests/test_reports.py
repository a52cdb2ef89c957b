"""Dashboard queries, metrics, exports and sources."""

import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tarmac.operators.versions import Log
from tarmac.plans import dashboard, marts, metrics
from tarmac.plans.dashboard import Filters
from tarmac.plans.staging import stg_flights
from tarmac.schemas import LOAD_STAMP
from tarmac.sinks import export, models
from tarmac.sources import airports, raw as raw_source, spine
from tarmac.sources.landed import Landed
from tests.conftest import movement


@pytest.fixture
def fact(raw):
    return lambda *documents: marts.flights_performance(stg_flights(raw(*documents)))


def many(n, **fields):
    return [movement(**{"id": f"{fields}-{i}", "atda": "10:00", **fields}) for i in range(n)]


def test_terminal_is_normalised_before_grouping(fact):
    table = fact(*many(10, termsec=""), *many(10), *many(12, termsec="A"), *many(8, termsec="A "))
    rows = dashboard.run("terminal_perf", table).collect()
    assert {row.terminal: row.total_flights for row in rows} == {"sin terminal": 20, "A": 20}


def test_thresholds(fact):
    table = fact(*many(19, gate="G1"), *many(20, gate="G2"), *many(30, gate=" "))
    assert [row.gate for row in dashboard.run("gate_perf", table).collect()] == ["G2"]


def test_routes_are_oriented(fact):
    table = fact(*many(5), *many(3, mov="A", arpt="COR", IATAdestorig="AEP"), *many(4, arpt="EZE"))
    (row,) = dashboard.run("top_routes", table).collect()
    assert (row.origin_airport_code, row.destination_airport_code, row.total_flights) == ("AEP", "COR", 8)


def test_filters(fact):
    table = fact(
        movement(id="1", atda="10:00"),
        movement(id="2", x_date="2024-01-11", mov="A"),
        movement(id="3", arpt="EZE", aerolinea="Foehn", stda="23:00"),
    )

    def flights(**chosen):
        return dashboard.run("kpis", table, Filters(**chosen)).first().total_flights

    assert flights() == 3
    assert flights(date_range=(date(2024, 1, 11), None)) == 1
    assert flights(date_range=(None, date(2024, 1, 10))) == 2
    assert flights(airline="Foehn") == 1
    assert flights(airport=["AEP", "EZE"]) == 3
    assert flights(direction="arrival") == 1
    assert flights(time_of_day=["night"]) == 1
    assert flights(delay_category="on_time") == 1
    assert flights(airline=[]) == 3
    # The distribution shows all categories whatever category is chosen.
    rows = dashboard.run("delay_distribution", table, Filters(delay_category="on_time")).collect()
    assert {row.delay_category: row.pct for row in rows} == {"on_time": 33.3, "severe": 66.7}


def test_filters_reach_the_scan(fact, tmp_path):
    fact(movement()).write.partitionBy("flight_date").parquet(f"{tmp_path}/fact")
    stored = fact(movement()).sparkSession.read.parquet(f"{tmp_path}/fact")
    chosen = Filters(date_range=(date(2024, 1, 1), date(2024, 1, 31)), airport="AEP")
    plan = dashboard.run("hourly_profile", stored, chosen)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "EqualTo(airport_code,AEP)" in scan
    assert "flight_date" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    columns = scan.split("ReadSchema:")[1]
    assert "delay_minutes" in columns and "weather" not in columns


def test_labels(fact):
    table = fact(movement(stda="07:00", atda="07:40"))
    label = {name: dashboard.run(name, table, labelled=True).first().label for name in dashboard.LABELS}
    assert label == {
        "daily_trend": "01-10",
        "delay_distribution": "Moderada (30-60 min)",
        "hourly_profile": "07h",
        "weekday_profile": "Mié",
    }


def test_options(fact):
    table = fact(movement(id="1"), movement(id="2", aerolinea=None), movement(id="3", aerolinea="Aero"))
    assert [row[0] for row in dashboard.run("filter_airlines", table).collect()] == ["Aero", "Andes Regional"]
    assert len(dashboard.QUERIES) == 12


def test_metrics(fact):
    table = fact(
        movement(id="1", atda="10:20"),
        movement(id="2", estin=None),
        movement(id="3", x_date="2024-02-01", estin="C"),
        movement(id="4", x_date="2024-02-01", stda="00:10", atda="23:40"),
    )
    names = [name for name, m in metrics.METRICS.items() if m.model is metrics.FLIGHTS]
    rows = metrics.metric(table, names, ["flight_date"], "month").orderBy("flight_date").collect()
    assert [row.flight_date for row in rows] == [date(2024, 1, 1), date(2024, 2, 1)]
    assert [row.total_on_time for row in rows] == [0, 0]
    assert [row.avg_delay_minutes for row in rows] == [20.0, 1410.0]
    assert [row.cancellation_rate for row in rows] == [0.0, 0.5]
    assert metrics.metric(table, "delayed_percentage").first()[0] == 0.5
    assert metrics.metric(table, "total_flights", where=F.col("month") == 2).first()[0] == 2
    assert metrics.metric(table.limit(0), "on_time_percentage").first()[0] is None


def test_metric_errors(fact):
    table = fact(movement())
    with pytest.raises(KeyError):
        metrics.metric(table, "speed")
    with pytest.raises(ValueError, match="different models"):
        metrics.metric(table, ["total_flights", "route_total_flights"])
    with pytest.raises(ValueError, match="no dimension"):
        metrics.metric(table, "total_flights", ["terminal"])
    with pytest.raises(ValueError, match="grain"):
        metrics.metric(table, "total_flights", grain="hour")
    assert len(metrics.METRICS) == 11
    assert len(metrics.FLIGHTS.measures) + len(metrics.ROUTES.measures) == 11


def document(path):
    return json.loads("".join(part.read_text() for part in sorted(path.glob("part-*"))))


def test_export_round_trip(spark, tmp_path):
    df = spark.range(50).select(
        F.col("id").alias("n"),
        F.when(F.col("id") > 0, F.lit("ñandú \"x\"")).alias("text"),
        F.lit("2024-01-02").cast("date").alias("day"),
        F.lit("2024-01-02 03:04:05").cast("timestamp").alias("at"),
        F.lit("2024-01-02 03:04:05.25").cast("timestamp").alias("exact"),
        F.lit("1.50").cast("decimal(5,2)").alias("price"),
        F.array(F.lit(1), F.lit(2)).alias("list"),
    )
    ordered = df.orderBy(F.desc("n"))
    done = export.export_table(ordered, "t", f"{tmp_path}/t.json", "marts.t")
    got = document(tmp_path / "t.json")
    assert got["metadata"] == {
        "exported_at": done.exported_at.isoformat(), "source": "marts.t", "total_records": 50,
    }
    assert [row["n"] for row in got["data"]] == list(range(49, -1, -1))
    assert got["data"][-1] == {
        "n": 0, "text": None, "day": "2024-01-02", "at": "2024-01-02T03:04:05+00:00",
        "exact": "2024-01-02T03:04:05.250000+00:00", "price": 1.5, "list": [1, 2],
    }
    assert got["data"][0]["text"] == 'ñandú "x"'
    assert [p.name for p in tmp_path.iterdir()] == ["t.json"]


def test_a_large_document_has_many_parts(spark, tmp_path):
    df = spark.range(20_000).repartition(4).select(F.col("id").alias("n"), F.lit("a\nb]}").alias("text"))
    # As for a table whose bytes fill several partitions.
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        done = export.export_table(df, "routes_metrics", f"{tmp_path}/r.json")
        bare = export.export_table(df, "routes_metrics", f"{tmp_path}/raw.json", raw=True)
    finally:
        spark.conf.set(conf, old)
    assert len(done.parts) > 2
    # No part has all rows, and their bytes in order are the document.
    sizes = [(tmp_path / "r.json" / name).stat().st_size for name in done.parts]
    assert max(sizes) < 0.5 * sum(sizes)
    got = json.loads(b"".join((tmp_path / "r.json" / name).read_bytes() for name in done.parts))
    assert sorted(row["n"] for row in got["data"]) == list(range(20_000)) and done.records == 20_000
    assert got["metadata"]["total_records"] == 20_000 and got["data"][0]["text"] == "a\nb]}"
    assert json.loads(b"".join((tmp_path / "raw.json" / name).read_bytes() for name in bare.parts)) == got["data"]


def test_raw_and_empty_exports(spark, tmp_path):
    df = spark.range(2).withColumnRenamed("id", "n")
    done = export.export_all(
        {"a": df, "b": df.limit(0)}, str(tmp_path), {"a": "x/a.json", "b": "x/b.json"}, raw_tables=" a ,"
    )
    assert [entry.table for entry in done] == ["a"]
    assert document(tmp_path / "x" / "a.json") == [{"n": 0}, {"n": 1}]
    assert not (tmp_path / "x" / "b.json").exists()
    (row,) = export.manifest(spark, done, 7, datetime(2024, 1, 1, tzinfo=timezone.utc)).collect()
    assert (row.name, row.record_count, row.expires_at) == ("a", 2, datetime(2024, 1, 8))
    export.write_manifest(spark, done, f"{tmp_path}/manifest.json", 7, datetime(2024, 1, 1, tzinfo=timezone.utc))
    assert document(tmp_path / "manifest.json") == {
        "generated_at": "2024-01-01T00:00:00+00:00", "expires_at": "2024-01-08T00:00:00+00:00",
        "expiration_days": 7, "objects": {"a": f"{tmp_path}/x/a.json"},
    }


def test_export_targets():
    assert len(export.targets()) == 7
    assert export.targets()["routes_metrics"] == "data/routes_metrics.json"
    assert export.targets(tables="a, b,", blob_path="x/y/z.json") == {"a": "x/y/a.json", "b": "x/y/b.json"}
    assert export.targets({"a": "q/w.json", "b": "c"}, prefix="/p/") == {"a": "q/w.json", "b": "p/c"}
    with pytest.raises(ValueError, match="strings"):
        export.targets({"a": 1})


def test_saved_models_are_described(spark, tmp_path):
    models.save(spark.range(1).withColumnRenamed("id", "delay_minutes"), f"{tmp_path}/m")
    stored = spark.read.parquet(f"{tmp_path}/m")
    assert stored.columns == ["delay_minutes", LOAD_STAMP]
    assert "schedule" in stored.schema["delay_minutes"].metadata["comment"]
    models.publish_view(spark.range(3), "three")
    assert spark.table("three").columns == ["id", LOAD_STAMP]


def test_landed_files_are_read_from_the_mark_on(raw, spark, tmp_path):
    landed = Landed(spark, str(tmp_path))
    assert landed.deliveries().count() == 0 and landed.since(datetime(2024, 1, 1)).count() == 0
    for day in (9, 10, 11):
        landed.land(raw(*[(movement(id=f"{day}-{hour}"), hour, day) for hour in range(5)]))
    # A file that comes late, and deliveries that have no stamp.
    landed.land(raw((movement(id="late"), 7, 9), (movement(id="none"), None, 9)))
    version = landed.log.read()
    mark = datetime(2024, 1, 11, 3)
    files = landed.files_since(mark)
    assert files and len(files) < len(landed.table.paths(version)) and all("extracted_on=2024-01-11" in f for f in files)
    assert landed.since(mark).count() == 2
    assert landed.since(datetime(2024, 1, 9, 7)).count() == 11
    assert landed.deliveries().count() == 17

    class Beaten(Log):
        """Another writer is faster, once."""

        def commit(self, coming):
            if not hasattr(self, "lost"):
                self.lost = True
                Landed(spark, str(tmp_path)).land(raw((movement(id="other"), 1, 12)))
            super().commit(coming)

    landed.log = Beaten(spark, landed.log.path)
    landed.land(raw((movement(id="mine"), 2, 12)))
    assert landed.deliveries().count() == 19


def test_metrics_of_two_models(spark):
    flights = spark.createDataFrame(
        [("AR", date(2024, 1, 1), True), (None, date(2024, 1, 3), False), ("FO", date(2024, 1, 3), False)],
        "airline_code string, flight_date date, is_cancelled boolean",
    )
    routes = spark.createDataFrame(
        [("AR", date(2024, 1, 1), 5), (None, date(2024, 1, 3), 7), ("G3", date(2024, 1, 5), 9)],
        "airline_code string, flight_date date, total_flights long",
    )
    tables = {"flights_performance": flights, "routes_metrics_daily": routes}
    names = ["total_flights", "route_total_flights"]
    got = metrics.metrics_of(tables, names, ["airline_code"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("AR", 1, 5), (None, 1, 7), ("FO", 1, None), ("G3", None, 9)], key=repr
    )
    filled = metrics.metrics_of(tables, names, ["flight_date"], fill=True).orderBy("flight_date").collect()
    assert [tuple(r)[1:] for r in filled] == [(1, 5), (None, None), (2, 7), (None, None), (None, 9)]
    assert tuple(metrics.metrics_of(tables, names).first()) == (3, 21)
    with pytest.raises(ValueError, match="missing"):
        metrics.metrics_of({"flights_performance": flights}, names)
    with pytest.raises(ValueError, match="single time"):
        metrics.metrics_of(tables, names, ["airline_code"], fill=True)


def test_spine(spark):
    days = spine.time_spine(spark)
    assert days.count() == 4018
    ends = days.agg(F.min("date_day"), F.max("date_day")).first()
    assert tuple(ends) == (date(2020, 1, 1), date(2030, 12, 31))
    assert spine.spine_of(days.limit(0), "date_day").count() == 0


def test_landing(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.jsonl").write_text(json.dumps(movement(gate="G1")) + "\n\n" + json.dumps(movement(id="F2")) + "\n")
    at = F.lit("2024-01-11").cast("timestamp")
    landed = f"{tmp_path}/landed"
    for _ in range(2):
        raw_source.land(raw_source.stamped(raw_source.read_documents(spark, str(folder)), at), landed)
    rows = raw_source.read_raw(spark, landed)
    assert rows.count() == 4
    assert stg_flights(rows).count() == 2
    view = raw_source.typed_view(rows, "movements_raw")
    assert spark.table("movements_raw").filter("gate = 'G1'").count() == 2
    assert len(view.columns) == 29 + 6


def test_airport_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "airport_code,airport_name,city,region,country,latitude,longitude,timezone,is_international\n"
        "AEP,Jorge Newbery,Buenos Aires,CABA,Argentina,-34.56,,America/Argentina/Buenos_Aires,false\n"
    )
    (row,) = airports.read_airports(spark, f"{tmp_path}/a.csv").collect()
    assert (row.airport_code, row.latitude, row.longitude) == ("AEP", "-34.56", None)
