"""The airport dimension's CSV, and the small table that goes with the derived feed."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tarmac.schemas import AIRPORT_SCHEMA

# Airports of the derived feed
# (code, name, city, region, country, latitude, longitude, timezone, is_international).
FEED_AIRPORTS = [
    ("AEP", "Jorge Newbery", "Buenos Aires", "CABA", "Argentina", "-34.56", "-58.42", "America/Argentina/Buenos_Aires", "false"),
    ("EZE", "Ezeiza", "Buenos Aires", "Buenos Aires", "Argentina", "-34.82", "-58.54", "America/Argentina/Buenos_Aires", "true"),
    ("COR", "Taravella", "Cordoba", "Cordoba", "Argentina", "-31.32", "-64.21", "America/Argentina/Cordoba", "true"),
    ("MDZ", "El Plumerillo", "Mendoza", "Mendoza", "Argentina", "-32.83", "-68.79", "America/Argentina/Mendoza", "true"),
    ("BRC", "Bariloche", "Bariloche", "Rio Negro", "Argentina", "-41.15", "-71.16", "America/Argentina/Salta", "false"),
    ("IGR", "Cataratas", "Puerto Iguazu", "Misiones", "Argentina", "-25.74", "-54.47", "America/Argentina/Cordoba", "true"),
    ("SLA", "Guemes", "Salta", "Salta", "Argentina", "-24.86", "-65.49", "America/Argentina/Salta", "true"),
    ("NQN", "Presidente Peron", "Neuquen", "Neuquen", "Argentina", "-38.95", "-68.16", "America/Argentina/Salta", "false"),
    ("GRU", "Guarulhos", "Sao Paulo", "Sao Paulo", "Brazil", None, None, "America/Sao_Paulo", "true"),
    ("SCL", "Arturo Merino Benitez", "Santiago", "Santiago", "Chile", None, None, "America/Santiago", "true"),
    ("MVD", "Carrasco", "Montevideo", "Canelones", "Uruguay", None, None, "America/Montevideo", "true"),
    ("LIM", "Jorge Chavez", "Lima", "Callao", "Peru", None, None, "America/Lima", "true"),
    ("MIA", "Miami", "Miami", "Florida", "United States", None, None, "America/New_York", "true"),
    ("MAD", "Barajas", "Madrid", "Madrid", "Spain", None, None, "Europe/Madrid", "true"),
    ("ASU", "Silvio Pettirossi", "Asuncion", "Central", "Paraguay", None, None, "America/Asuncion", "true"),
]


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """Airport rows as text; the airport model does the casting."""
    return spark.read.schema(AIRPORT_SCHEMA).option("header", True).csv(path)


def feed_airports(spark: SparkSession) -> DataFrame:
    # From Arrow it is a local relation of known size, which Spark broadcasts by itself.
    columns = dict(zip(AIRPORT_SCHEMA.names, map(list, zip(*FEED_AIRPORTS))))
    return spark.createDataFrame(pa.table(columns), AIRPORT_SCHEMA)
