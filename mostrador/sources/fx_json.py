"""Exchange-rate payloads: a map from day to a map from currency to rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mostrador.functions import cleaning as c
from mostrador.operators.barrier import evaluated_once
from mostrador.sources import payload

KEYS = ("fecha",)
POSITION = ("archivo", "linea")
DAY = "linea"
CURRENCY = "MXN"


def scan(documents: DataFrame) -> DataFrame:
    """One row per day as text: ``archivo``, ``linea`` (the day itself) and the rate or NULL.

    A response that is no whole JSON object stops the load.
    """
    documents = payload.checked(documents, "rates")
    rates = F.from_json("contenido", "rates map<string, map<string, string>>")["rates"]
    return documents.select("archivo", F.explode(rates).alias("linea", "_rates")).select(
        "archivo", "linea", F.try_element_at("_rates", F.lit(CURRENCY)).alias("tasa")
    )


def classify(rows: DataFrame) -> DataFrame:
    """Typed rate columns plus ``motivo``; a day without a positive rate is rejected.

    A bad date or a rate that is no number stops the load.
    """
    rate = c.measurement(F.col("tasa"), "decimal(38,18)")
    reason = F.when(
        F.col("tasa").isNull() | (rate <= 0), F.concat(F.col("linea"), F.lit(f": sin tipo de cambio {CURRENCY}"))
    )
    good = F.col("motivo").isNull()
    return evaluated_once(rows.withColumn("motivo", reason)).select(
        *POSITION,
        F.when(good, c.required_day(F.col("linea"), "fecha")).alias("fecha"),
        F.when(good, c.measurement(F.col("tasa"), "decimal(10,4)")).alias("usd_mxn"),
        "motivo",
    )
