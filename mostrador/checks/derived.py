"""Retail inputs derived by Spark from the supplied Parquet tables.

Every derivation reads whole tables. Dirty values (empty quantities, ``por definir`` prices, unknown channels,
days without data) are spread over them by rule so that each reject reason occurs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador.operators import keyed
from mostrador.operators.quality import Stage
from mostrador.plans import star
from mostrador.plans.daily_run import Inputs
from mostrador.session import joinable, scratch_path, stored
from mostrador.sources import catalogue_json, fx_json, landing, sales_csv, weather_json

# Ties within a key are settled by these columns; rows equal in all of them are equal in every field used.
ORDER = (
    "l_linenumber", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_returnflag", "l_suppkey",
)
ORDERS_PER_FILE = 50_000
PARTS_PER_DOCUMENT = 1_000
FIRST_FX_DAY = "1995-03-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all task slots when its input has fewer splits than that (a small or badly cut file);
    a larger input is left alone, so nothing is shuffled at scale."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def cents(amount: Column) -> Column:
    return amount.cast("decimal(10,2)")


# --- sales --------------------------------------------------------------------------------------


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text record per order line, with :data:`ORDER` and ``l_orderkey`` alongside."""
    lines = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", *ORDER))
    parts = joinable(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"))
    order, line, flag = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_returnflag")
    price = cents(F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice")).otherwise(F.col("p_retailprice")))
    price = price.cast("string")
    day = F.to_date("l_shipdate").cast("string")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.concat(F.lit("N-"), order).alias("folio"),
        F.when(line % 5 == 0, F.concat(F.substring(day, 9, 2), F.lit("/"), F.substring(day, 6, 2), F.lit("/"), F.substring(day, 1, 4)))
        .otherwise(day).alias("fecha"),
        F.col("l_partkey").cast("string").alias("producto_id"),
        F.when(order % 401 == 0, F.lit(None))
        .when(order % 397 == 0, F.lit("0"))
        .otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("cantidad"),
        F.when(order % 409 == 0, F.lit("por definir"))
        .when(line % 3 == 0, F.concat(F.lit("$"), price))
        .otherwise(price).alias("precio_unitario"),
        F.when(order % 419 == 0, F.lit("Feria"))
        .when(flag == "A", F.lit(" whatsapp "))
        .when(flag == "N", F.lit("TIENDA"))
        .otherwise(F.lit("Tienda")).alias("canal"),
        "l_orderkey",
        *ORDER,
    )


def checked_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_csv.classify(raw_sales(spark, sf_dir))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean sales, one per key."""
    return keyed.latest_by_key(good_sales(spark, sf_dir), sales_csv.KEYS, ORDER)


def good_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted sales with :data:`ORDER`, stored: they are read more than once, and parsed once."""
    good = sales_csv.accepted(checked_sales(spark, sf_dir)).select(*sales_csv.COLUMNS, *ORDER)
    return stored(spark, good, "ventas-buenas")


def landed_csv(spark: SparkSession, rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (of raw sales) written as CSV files and landed: ``(lines, files)``; files carry their ``grupo``.

    A file holds the lines of a bounded range of orders, so it is written by one task. Files are read in five splits or
    more, whatever their size.
    """
    csv_path = scratch_path(spark, f"{name}-csv")
    (
        rows.withColumn("grupo", F.floor(F.col("l_orderkey") / ORDERS_PER_FILE))
        .repartition("grupo")
        .sortWithinPartitions("grupo", "l_orderkey", *ORDER)
        .select("grupo", *sales_csv.COLUMNS)
        .write.partitionBy("grupo")
        .csv(csv_path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    )
    least = landing.file_list(spark, csv_path).agg(F.min("bytes")).first()[0] or 1
    reader = spark.newSession()  # with a split size of its own
    reader.conf.set("spark.sql.files.maxPartitionBytes", str(max(1, least // 5)))
    folder = landing.land_lines(reader, csv_path, "ventas", datetime(2026, 9, 13, 7), scratch_path(spark, "crudo"), sales_csv.COLUMNS)
    files = landing.landed_files(spark, folder).withColumn(
        "grupo", F.regexp_extract("archivo", "grupo=([0-9]+)", 1).cast("bigint")
    )
    return landing.landed_lines(spark, folder), files


def landed_sales(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return landed_csv(spark, raw_sales(spark, sf_dir), "ventas")


def landed_quoted_sales(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """As :func:`landed_sales`; the folios of every third order hold quotes, commas and one or two line ends, and those of
    every fifth a comma in quotes."""
    order = F.col("l_orderkey")
    folio = (
        F.when(order % 3 == 0, F.concat("folio", F.lit(', "a"\n'), F.when(order % 2 == 0, F.lit("\n")).otherwise(F.lit("")), F.col("l_linenumber").cast("string")))
        .when(order % 5 == 0, F.concat(F.lit("b, "), "folio"))
        .otherwise(F.col("folio"))
    )
    return landed_csv(spark, raw_sales(spark, sf_dir).withColumn("folio", folio), "ventas-citadas")


# --- catalogue ----------------------------------------------------------------------------------


def catalogue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON catalogues of up to a thousand part numbers each: ``(archivo, contenido)``.

    ECONOMY parts are listed a second time, later and one peso dearer.
    """
    parts = table(spark, sf_dir, "part")
    first = parts.withColumn("vuelta", F.lit(0))
    again = parts.where("p_type = 'ECONOMY'").withColumn("vuelta", F.lit(1))
    listed = first.unionByName(again)
    fields = [
        F.col("p_partkey").alias("id"), F.concat(F.lit(" "), "p_name").alias("nombre"),
        F.when(F.col("p_size") == 48, F.lit("  ")).otherwise(F.col("p_brand")).alias("marca"),
        F.col("p_type").alias("tipo"), F.lit("Bolsa 1 kg").alias("presentacion"),
    ]
    price = (cents(F.col("p_retailprice")) + F.col("vuelta")).cast("decimal(10,2)")
    element = (
        F.when(F.col("p_size") == 50, F.to_json(F.struct(*fields)))
        .when(F.col("p_size") == 49, F.to_json(F.struct(*fields, F.lit("agotado").alias("precio"))))
        .otherwise(F.to_json(F.struct(*fields, price.alias("precio"))))
    )
    placed = listed.select(
        F.floor(F.col("p_partkey") / PARTS_PER_DOCUMENT).alias("documento"), "vuelta", "p_partkey",
        element.alias("elemento"),
    )
    entries = F.sort_array(F.collect_list(F.struct("vuelta", "p_partkey", "elemento")))
    return placed.groupBy("documento").agg(entries.alias("e")).select(
        F.concat(F.lit("productos-"), "documento").alias("archivo"),
        F.concat(
            F.lit('{"moneda": "MXN", "productos": ['), F.array_join(F.col("e.elemento"), ", "), F.lit("]}")
        ).alias("contenido"),
    )


def checked_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue_json.classify(catalogue_json.scan(catalogue_documents(spark, sf_dir)))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean products, one per key. The accepted ones are stored: they are read more than once, and parsed once."""
    good = checked_products(spark, sf_dir).where("motivo IS NULL").drop("motivo")
    return keyed.latest_by_key(stored(spark, good, "productos-buenos"), catalogue_json.KEYS, catalogue_json.POSITION)


# --- daily payloads -----------------------------------------------------------------------------


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order day: number of orders and the smallest order and customer key."""
    return (
        table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("dia"))
        .agg(F.count("*").alias("n"), F.min("o_orderkey").alias("pedido"), F.min("o_custkey").alias("cliente"))
        .withColumn("mes", F.date_format("dia", "yyyy-MM"))
        .withColumn("texto", F.date_format("dia", "yyyy-MM-dd"))
    )


def _tenths(number: Column) -> Column:
    return (number.cast("decimal(10,0)") * F.lit(0.1).cast("decimal(2,1)")).cast("decimal(8,1)")


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly weather payloads from order days; the 31st of a month is missing, some values are null."""
    n, top = F.col("n"), F.col("cliente") % 150 + 150
    some = n % 7 != 0
    days = _order_days(spark, sf_dir).where(F.dayofmonth("dia") != 31).select(
        "mes",
        F.struct(
            F.col("texto").alias("dia"),
            F.when(some & (n % 5 != 0), _tenths(top)).alias("alta"),
            F.when(some, _tenths(top - 80)).alias("baja"),
            F.when(some & (n % 4 != 0), _tenths(F.col("pedido") % 40)).alias("lluvia"),
        ).alias("d"),
    )
    months = days.groupBy("mes").agg(F.sort_array(F.collect_list("d")).alias("d"))  # at most 30 entries
    daily = F.struct(
        F.col("d.dia").alias("time"), F.col("d.alta").alias("temperature_2m_max"),
        F.col("d.baja").alias("temperature_2m_min"), F.col("d.lluvia").alias("precipitation_sum"),
    )
    return months.select(
        F.concat(F.lit("clima-"), "mes").alias("archivo"), F.to_json(F.struct(daily.alias("daily"))).alias("contenido")
    )


def fx_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly rate payloads from order days, working days only; some days have no rate or a zero one."""
    n = F.col("n")
    rate = F.when(n % 13 == 0, F.lit(0)).otherwise(F.col("cliente") % 50000 + 150000)
    rate = (rate.cast("decimal(10,0)") * F.lit(0.0001).cast("decimal(5,4)")).cast("decimal(10,4)")
    one = F.create_map(F.lit("MXN"), rate)
    days = (
        _order_days(spark, sf_dir)
        .where(F.dayofweek("dia").between(2, 6) & (F.col("dia") >= F.lit(FIRST_FX_DAY).cast("date")))
        .select("mes", "texto", F.when(n % 11 == 0, F.map_filter(one, lambda k, v: F.lit(False))).otherwise(one).alias("r"))
    )
    months = days.groupBy("mes").agg(F.map_from_entries(F.collect_list(F.struct("texto", "r"))).alias("rates"))
    return months.select(
        F.concat(F.lit("cambio-"), "mes").alias("archivo"),
        F.to_json(F.struct(F.lit("USD").alias("base"), "rates")).alias("contenido"),
    )


def written_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The files of a daily run, written from the given tables."""
    root = scratch_path(spark, "entrada")
    sales = (
        raw_sales(spark, sf_dir)
        .withColumn("grupo", F.floor(F.col("l_orderkey") / ORDERS_PER_FILE))
        .repartition("grupo")
        .sortWithinPartitions("grupo", "l_orderkey", *ORDER)
        .select("grupo", *sales_csv.COLUMNS)
    )
    sales.write.partitionBy("grupo").csv(
        f"{root}/ventas", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    for name, documents in (
        ("productos", catalogue_documents(spark, sf_dir)), ("clima", weather_documents(spark, sf_dir)), ("cambio", fx_documents(spark, sf_dir)),
    ):
        documents.repartition("archivo").write.partitionBy("archivo").text(f"{root}/{name}")
    return Inputs(*[f"{root}/{name}" for name in ("ventas", "productos", "clima", "cambio")])


def landed_payloads(spark: SparkSession, documents: DataFrame, name: str) -> DataFrame:
    """``documents`` written as files of their own (a folder for each), landed, and read from there."""
    written = scratch_path(spark, f"{name}-json")
    documents.repartition("archivo").write.partitionBy("archivo").text(written)
    folder = landing.land_documents(spark, written, name, datetime(2026, 9, 13, 7), scratch_path(spark, "crudo"))
    return landing.landed_documents(spark, folder)


def doubtful_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate responses of all months; by month number some are cut, some are lists, HTML, null or empty."""
    month = F.substring("archivo", -2, 2).cast("int")
    text = F.col("contenido")
    return fx_documents(spark, sf_dir).select(
        "archivo",
        F.when(month == 1, F.left(text, F.length(text) - 1))
        .when(month == 2, F.left(text, F.floor(F.length(text) / 2).cast("int")))
        .when(month == 3, F.concat(F.lit("["), text, F.lit("]")))
        .when(month == 4, F.lit("<html>503</html>"))
        .when(month == 5, F.lit("{}")).when(month == 6, F.lit('{"rates": null}')).when(month == 7, F.lit('{"rates": 5}'))
        .when(month == 8, F.lit('{"rates": []}')).when(month == 9, F.lit("")).when(month == 10, F.lit("null"))
        .otherwise(text).alias("contenido"),
    )


def checked_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_json.classify(weather_json.scan(weather_documents(spark, sf_dir)))


def checked_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_json.classify(fx_json.scan(fx_documents(spark, sf_dir)))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_weather(spark, sf_dir).where("motivo IS NULL").drop("motivo", *weather_json.POSITION)


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_fx(spark, sf_dir).where("motivo IS NULL").drop("motivo", *fx_json.POSITION)


# --- star schema --------------------------------------------------------------------------------


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.product_rows(products(spark, sf_dir))


def dim_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.weather_rows(weather(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_rows(sales(spark, sf_dir), products(spark, sf_dir), fx_rates(spark, sf_dir))


def stored_stage(spark: SparkSession, sf_dir: str) -> Stage:
    """All tables of the star schema and its staging area, written out as a daily run leaves them."""
    kept_sales = stored(spark, sales(spark, sf_dir), "ventas")
    kept_products = stored(spark, products(spark, sf_dir), "productos")
    kept_weather = stored(spark, weather(spark, sf_dir), "clima")
    kept_rates = stored(spark, fx_rates(spark, sf_dir), "tipo_cambio")
    facts = star.fact_rows(kept_sales, kept_products, kept_rates)
    return Stage(
        sales=kept_sales, products=kept_products, weather=kept_weather, fx_rates=kept_rates,
        dim_product=star.product_rows(kept_products), dim_weather=star.weather_rows(kept_weather),
        fact=stored(spark, facts, "fact_ventas"),
    )
