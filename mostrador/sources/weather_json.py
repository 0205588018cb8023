"""Daily weather payloads: parallel arrays, one entry per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mostrador.functions import cleaning as c
from mostrador.operators.barrier import evaluated_once
from mostrador.sources import payload

KEYS = ("fecha",)
POSITION = ("archivo", "linea")
DAY = "dia"
ARRAYS = {"temp_max": "temperature_2m_max", "temp_min": "temperature_2m_min", "lluvia_mm": "precipitation_sum"}
TYPES = {"temp_max": "decimal(4,1)", "temp_min": "decimal(4,1)", "lluvia_mm": "decimal(6,1)"}


def scan(documents: DataFrame) -> DataFrame:
    """One row per day as text: ``archivo``, ``linea`` (from 1), ``dia`` and the three measurements.

    A missing or empty measurement array stands for no value on any day; otherwise the shortest array
    decides how many days there are. A response that is no whole JSON object stops the load.
    """
    names = ", ".join(f"{name}: array<string>" for name in ["time", *ARRAYS.values()])
    documents = payload.checked(documents, "daily")
    daily = F.from_json("contenido", f"daily struct<{names}>")["daily"]
    days = F.coalesce(daily["time"], F.array().cast("array<string>"))
    nothing = F.array_repeat(F.lit(None).cast("string"), F.size(days))
    columns = {"dia": days}
    for name, source in ARRAYS.items():
        columns[name] = F.when(F.size(daily[source]) > 0, daily[source]).otherwise(nothing)
    shortest = F.least(*[F.size(values) for values in columns.values()])
    rows = F.slice(F.arrays_zip(*[values.alias(name) for name, values in columns.items()]), F.lit(1), shortest)
    zipped = documents.select("archivo", F.posexplode(rows).alias("_pos", "_row"))
    return zipped.select(
        "archivo",
        (F.col("_pos") + 1).alias("linea"),
        *[F.col("_row").getField(name).alias(name) for name in columns],
    )


def classify(rows: DataFrame) -> DataFrame:
    """Typed weather columns plus ``motivo``; a day with no measurement at all is rejected.

    A bad date or a measurement that is no number stops the load.
    """
    empty = F.coalesce(*ARRAYS).isNull()
    reason = F.when(empty, F.concat(F.coalesce("dia", F.lit("None")), F.lit(": sin datos todavía")))
    good = F.col("motivo").isNull()
    return evaluated_once(rows.withColumn("motivo", reason)).select(
        *POSITION,
        F.when(good, c.required_day(F.col("dia"), "fecha")).alias("fecha"),
        *[F.when(good, c.measurement(F.col(name), kind)).alias(name) for name, kind in TYPES.items()],
        "motivo",
    )
