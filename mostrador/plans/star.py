"""Star schema rows from the staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mostrador.functions import measures
from mostrador.operators.asof import asof_day_join
from mostrador.session import joinable, stored


def product_rows(products: DataFrame) -> DataFrame:
    return products.select("producto_id", "nombre", "marca", "tipo", F.col("precio").alias("precio_lista"))


def weather_rows(weather: DataFrame) -> DataFrame:
    return weather.select(
        "fecha", "temp_max", "temp_min", "lluvia_mm", measures.is_rainy(F.col("lluvia_mm")).alias("dia_lluvioso")
    )


def known_sales(sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Sales of catalogue products. The catalogue key is unique, so only its id column is read.

    No broadcast hint: the catalogue grows with the business. The ids are written once, so that their number is known: Spark
    broadcasts them while they are few and otherwise joins by shuffle, where AQE splits a hot product.
    """
    ids = stored(sales.sparkSession, dim_product.select("producto_id"), "ids-productos")
    return sales.join(joinable(ids), "producto_id", "left_semi")


def fact_rows(sales: DataFrame, dim_product: DataFrame, fx_rates: DataFrame) -> DataFrame:
    priced = asof_day_join(known_sales(sales, dim_product), fx_rates.select("fecha", "usd_mxn"), "fecha", "usd_mxn")
    qty, price, rate = F.col("cantidad"), F.col("precio_unitario"), F.col("usd_mxn")
    return priced.select(
        "folio",
        "producto_id",
        "fecha",
        measures.weekday_name(F.col("fecha")).alias("dia_semana"),
        "canal",
        "cantidad",
        "precio_unitario",
        measures.line_total(qty, price).alias("total_mxn"),
        "usd_mxn",
        measures.line_total_usd(qty, price, rate).alias("total_usd"),
    )
