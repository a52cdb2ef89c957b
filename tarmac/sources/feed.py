"""A raw movement feed derived from the ``events`` table.

The given tables hold no flights. Each event becomes one raw delivery, by
integer arithmetic only, so that another engine can derive the expected typed
columns on its own. Pairs of events are two deliveries of one movement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schemas import AIRPORT_SCHEMA, EXTRACT_STAMPS, RAW_SCHEMA

# Codes of the derived feed, picked by index.
REPORTING = ["AEP", "EZE", "COR", "MDZ", "BRC", "IGR", "SLA", "NQN"]
OTHER_END = ["EZE", "GRU", "SCL", "MVD", "LIM", "MIA", "MAD", "AEP", "COR", "ASU", "XXX", "B1"]
OTHER_CITY = {"XXX": "Far Field"}
# Event type -> (airline code as delivered, airline name).
AIRLINES = {
    "error": ("AR", "Andes Regional"),
    "click": ("FO", "Foehn"),
    "purchase": ("WJ", "Westwind Jet"),
    "view": ("LA", "Llanura Air"),
    "signup": (" g3 ", "Garza"),
}


def _pick(values: list[str | None], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _clock(minutes: Column) -> Column:
    wrapped = F.pmod(minutes, F.lit(1440))
    return F.format_string("%02d:%02d", F.floor(wrapped / 60), wrapped % 60)


def _delivered(df: DataFrame) -> DataFrame:
    """Spread like deliveries that land in many files, however the events are stored."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def movement_feed(spark: SparkSession, sf_dir: str, keyless_every: int | None = None) -> DataFrame:
    """Raw deliveries with the landed table's schema; every so many movements lack their id, if asked."""
    events = _delivered(spark.read.parquet(f"{sf_dir}/events.parquet")).select(
        F.floor(F.col("event_id") / 2).alias("p"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("u"),
        "event_type",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )
    p, u, k, ts = F.col("p"), F.col("u"), F.col("k"), F.col("ts")
    minute = F.hour(ts) * 60 + F.minute(ts)
    drift = (k - 30) * 3
    arrival = F.floor(p / 8) % 2 == 1
    other = _pick(OTHER_END, F.floor(p / 16) % len(OTHER_END))
    airline = F.create_map(
        *[F.lit(v) for kind, pair in AIRLINES.items() for v in (kind, pair[0])]
    )[F.col("event_type")]
    name = F.create_map(
        *[F.lit(v) for kind, pair in AIRLINES.items() for v in (kind, pair[1])]
    )[F.col("event_type")]
    gate_clock = F.when((k < 85) & (k % 3 == 0), _clock(minute + drift + 4))
    tail = u % 7 != 0
    flight = F.concat(F.lit("F"), p.cast("string"))
    if keyless_every:
        flight = F.when(p % keyless_every != 7, flight)
    fields = {
        "id": flight,
        "arpt": _pick(REPORTING, p % len(REPORTING)),
        "mov": F.when(arrival, "A").otherwise("D"),
        "IATAdestorig": other,
        "destorig": F.when(other == "XXX", OTHER_CITY["XXX"]),
        "idaerolinea": airline,
        "aerolinea": name,
        "nro": F.concat(F.trim(F.upper(airline)), (1000 + p % 500).cast("string")),
        "x_date": F.date_format(ts, "yyyy-MM-dd"),
        "stda": _clock(minute),
        "etda": F.when(k % 5 == 0, _clock(minute + 20)),
        "atda": F.when(k < 85, _clock(minute + drift)),
        "blockon": F.when(arrival, gate_clock),
        "blockoff": F.when(~arrival, gate_clock),
        "estin": F.when(k >= 95, "Cancelado").when(k != 94, "Programado"),
        "gate": F.when(u % 10 == 0, "  ").otherwise(F.concat(F.lit("G"), (u % 30).cast("string"))),
        "termsec": _pick(["A", "B", "", None], u % 4),
        "sector": F.concat(F.lit("S"), (u % 3).cast("string")),
        "belt": F.when(arrival, F.concat(F.lit("B"), (u % 4).cast("string"))),
        "matricula": F.when(tail, F.concat(F.lit("LV-"), (u % 60).cast("string"))),
        "acftype": F.when(tail, _pick(["B738", "E190"], u % 2)),
        "sdtemp": F.when(k % 11 == 0, "n/a").otherwise((k - 40).cast("string")),
        "sdphrase": _pick(["Despejado", "Lluvia", None], k % 3),
        "x_fetched_at": F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    }
    return events.select(
        F.to_json(F.struct(*[value.alias(key) for key, value in fields.items()])).alias("data"),
        *[ts.alias(name) for name in EXTRACT_STAMPS],
        F.lit(None).cast("timestamp").alias("_sdc_deleted_at"),
        F.lit(None).cast("long").alias("_sdc_sequence"),
        F.lit(None).cast("long").alias("_sdc_table_version"),
    ).select(RAW_SCHEMA.names)


def airport_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw airport table derived from suppliers: codes to clean, texts to cast."""
    read = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("supplier", "nation", "region")}
    key = F.col("s_suppkey")
    letters = [F.char(65 + F.floor(key / 26**i) % 26) for i in range(3)]
    padded = F.when(key % 3 == 0, F.concat(F.lit(" "), F.lower(F.concat(*letters)), F.lit("\t")))
    rows = (
        read["supplier"]
        .join(read["nation"], F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(read["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    fields = {
        "airport_code": F.when(key % 50 != 49, F.coalesce(padded, F.concat(*letters))),
        "airport_name": F.col("s_name"),
        "city": F.concat(F.lit("City "), (key % 40).cast("string")),
        "region": F.col("r_name"),
        "country": F.when(F.col("n_name") == "NATION_0", "Argentina").otherwise(F.col("n_name")),
        "latitude": F.when(key % 5 == 0, "n/a").otherwise(F.concat((key * 37 % 90).cast("string"), F.lit(".25"))),
        "longitude": F.when(key % 4 == 0, "").otherwise(F.concat(F.lit("-"), (key * 53 % 180).cast("string"))),
        "timezone": F.lit("UTC"),
        "is_international": _pick(["true", "FALSE", "yes", None], key % 4),
    }
    return rows.select([fields[name].alias(name) for name in AIRPORT_SCHEMA.names])
