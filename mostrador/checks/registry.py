"""One query per operator, over whole tables: ``QUERIES[name](spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador import tables as t
from mostrador.checks import derived as d
from mostrador.functions import cleaning as c
from mostrador.functions import measures
from mostrador.operators import audit, keyed, quality
from mostrador.operators.asof import asof_day_join
from mostrador.plans import daily_run, incremental, reports, star
from mostrador.plans.warehouse import Warehouse
from mostrador.session import scratch_path
from mostrador.sources import fx_json, landing, payload, sales_csv, weather_json

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_LOAD, SECOND_LOAD = "2026-09-12 07:00:00", "2026-09-13 07:00:00"
TODAY = date(2001, 6, 1)
WINDOW_END = date(2001, 7, 31)
HISTORY_START = date(1995, 1, 1)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def shown_stamp(df: DataFrame, stamp: str) -> DataFrame:
    return df.withColumn(stamp, F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"))


# --- scans, sources, sinks ----------------------------------------------------------------------


@query
def scan_sales_csv(spark, sf_dir):
    lines, files = d.landed_sales(spark, sf_dir)
    return sales_csv.scan(lines, files).join(files.select("archivo_no", "grupo"), "archivo_no").select(
        "grupo", *sales_csv.COLUMNS
    )


@query
def scan_quoted_csv(spark, sf_dir):
    """Records whose quoted folios run over line ends, in files that are read in several splits."""
    lines, files = d.landed_quoted_sales(spark, sf_dir)
    return sales_csv.scan(lines, files).join(files.select("archivo_no", "grupo"), "archivo_no").select(
        "grupo", "registro", *sales_csv.COLUMNS
    )


@query
def sales_header_check(spark, sf_dir):
    """How many files carry each required column; the load stops when one lacks any."""
    _, files = d.landed_sales(spark, sf_dir)
    found = files.select("archivo_no", F.explode(sales_csv.header_names(F.col("encabezado"))).alias("columna"))
    return found.groupBy("columna").agg(F.count_distinct("archivo_no").alias("archivos"))


@query
def sales_record_no(spark, sf_dir):
    lines, files = d.landed_sales(spark, sf_dir)
    rejects = sales_csv.rejected(sales_csv.classify(sales_csv.scan(lines, files)))
    numbered = sales_csv.number_records(rejects, lines)
    return numbered.join(files.select("archivo_no", "grupo"), "archivo_no").select(
        "grupo", "registro", "folio", "producto_id", "motivo"
    )


@query
def landing_roundtrip(spark, sf_dir):
    """Size and fingerprint of each landed file, and whether the pieces it is given back in are all of its bytes."""
    lines, files = d.landed_sales(spark, sf_dir)
    pieces = landing.restored_pieces(lines, files, size=1 << 16).select("archivo_no", "desde", F.octet_length("contenido").alias("largo"))
    whole = pieces.groupBy("archivo_no").agg(
        F.sum("largo").alias("total"), F.max(F.col("desde") + F.col("largo")).alias("fin_pieza"), F.count_distinct("desde").alias("distintas"), F.count("*").alias("piezas")
    )
    checked = landing.line_copy_check(lines, files).join(whole, "archivo_no")
    intact = (F.col("total") == F.col("bytes")) & (F.col("fin_pieza") == F.col("bytes")) & (F.col("distintas") == F.col("piezas"))
    return checked.select(
        F.regexp_extract("archivo", "grupo=([0-9]+)", 1).cast("bigint").alias("grupo"), "bytes", "lineas", "huella", intact.alias("entera")
    )


@query
def payload_check(spark, sf_dir):
    """Whether each of the responses can be loaded; some are cut or no object, by rule."""
    documents = d.doubtful_documents(spark, sf_dir)
    reason = payload.problem(F.col("contenido"), "rates")
    return documents.select("archivo", reason.isNull().alias("legible"))


@query
def scan_products_json(spark, sf_dir):
    """Catalogue documents written as files, landed whole, and read back element by element."""
    written = scratch_path(spark, "productos-json")
    d.catalogue_documents(spark, sf_dir).select("contenido").write.text(written)
    folder = landing.land_documents(
        spark, f"{written}/*.txt", "productos", datetime(2026, 9, 13, 7), scratch_path(spark, "crudo")
    )
    documents = landing.landed_documents(spark, folder)
    # A written file may hold several documents, one per line.
    one = documents.select("archivo", F.explode(F.split("contenido", "\n")).alias("contenido")).where("contenido <> ''")
    return d.catalogue_json.scan(one).select(
        F.get_json_object("elemento", "$.id").cast("bigint").alias("id"),
        F.get_json_object("elemento", "$.precio").try_cast("decimal(10,2)").alias("precio"),
        "linea",
    )


@query
def weather_rows(spark, sf_dir):
    """From landed files, byte for byte."""
    rows = weather_json.classify(weather_json.scan(d.landed_payloads(spark, d.weather_documents(spark, sf_dir), "clima")))
    return rows.where("motivo IS NULL").drop("motivo", *weather_json.POSITION)


@query
def fx_rows(spark, sf_dir):
    """From landed files, byte for byte."""
    rows = fx_json.classify(fx_json.scan(d.landed_payloads(spark, d.fx_documents(spark, sf_dir), "tipo_cambio")))
    return rows.where("motivo IS NULL").drop("motivo", *fx_json.POSITION)


@query
def upsert_sales(spark, sf_dir):
    """Lines shipped before 1999 are loaded first; then those shipped from 1998 on, with one more piece."""
    good = d.good_sales(spark, sf_dir)
    first = good.where("l_shipdate < timestamp_ntz'1999-01-01'")
    second = good.where("l_shipdate >= timestamp_ntz'1998-01-01'").withColumn("cantidad", F.col("cantidad") + 1)
    empty = spark.createDataFrame([], t.SALES.schema)
    loaded = keyed.upsert(empty, first, t.SALES.keys, t.SALES.stamp, moment(FIRST_LOAD), d.ORDER)
    merged = keyed.upsert(loaded, second, t.SALES.keys, t.SALES.stamp, moment(SECOND_LOAD), d.ORDER)
    return shown_stamp(merged, t.SALES.stamp)


@query
def upsert_last_wins(spark, sf_dir):
    """One batch that lists some products twice."""
    good = d.checked_products(spark, sf_dir).where("motivo IS NULL").drop("motivo")
    empty = spark.createDataFrame([], t.PRODUCTS.schema)
    merged = keyed.upsert(
        empty, good, t.PRODUCTS.keys, t.PRODUCTS.stamp, moment(FIRST_LOAD), d.catalogue_json.POSITION
    )
    return shown_stamp(merged, t.PRODUCTS.stamp)


@query
def upsert_dim_product(spark, sf_dir):
    """The catalogue as first listed, then the whole of ECONOMY at its last price."""
    good = d.checked_products(spark, sf_dir).where("motivo IS NULL").drop("motivo")
    first = star.product_rows(
        keyed.latest_by_key(good.withColumn("_antes", -F.col("linea")), ["producto_id"], ["_antes"])
    ).select(*t.DIM_PRODUCT.columns[:-1], moment(FIRST_LOAD).alias("actualizado_en"))
    second = star.product_rows(d.products(spark, sf_dir).where("tipo = 'ECONOMY'"))
    merged = keyed.upsert(first, second, t.DIM_PRODUCT.keys, t.DIM_PRODUCT.stamp, moment(SECOND_LOAD))
    return shown_stamp(merged, t.DIM_PRODUCT.stamp)


@query
def upsert_dim_weather(spark, sf_dir):
    """All days, then the days from 1998 on with their rain corrected by one millimetre."""
    days = d.weather(spark, sf_dir)
    first = star.weather_rows(days).withColumn("actualizado_en", moment(FIRST_LOAD))
    corrected = days.where("fecha >= date'1998-01-01'").withColumn(
        "lluvia_mm", (F.col("lluvia_mm") + 1).cast("decimal(6,1)")
    )
    merged = keyed.upsert(
        first, star.weather_rows(corrected), t.DIM_WEATHER.keys, t.DIM_WEATHER.stamp, moment(SECOND_LOAD)
    )
    return shown_stamp(merged, t.DIM_WEATHER.stamp)


@query
def upsert_fact(spark, sf_dir):
    """Facts up to 1998 first, then the sales from 1998 on: that year is updated, later days come in."""
    sales = d.stored(spark, d.sales(spark, sf_dir), "ventas")
    products, rates = d.products(spark, sf_dir), d.fx_rates(spark, sf_dir)
    early = star.fact_rows(sales, products, rates).where("fecha < date'1999-01-01'")
    first = early.withColumn("actualizado_en", moment(FIRST_LOAD)).select(*t.FACT_SALES.columns)
    late = star.fact_rows(sales.where("fecha >= date'1998-01-01'"), products, rates)
    merged = keyed.upsert(first, late, t.FACT_SALES.keys, t.FACT_SALES.stamp, moment(SECOND_LOAD))
    return shown_stamp(merged, t.FACT_SALES.stamp)


def _counters(spark, sf_dir) -> list[tuple[str, DataFrame]]:
    return [
        ("ventas_csv", audit.load_counters(d.checked_sales(spark, sf_dir), sales_csv.KEYS, flaw="falla")),
        ("productos_json", audit.load_counters(d.checked_products(spark, sf_dir), ["producto_id"])),
        ("clima_api", audit.load_counters(d.checked_weather(spark, sf_dir), ["fecha"], last_wins=False)),
        ("tipo_cambio_api", audit.load_counters(d.checked_fx(spark, sf_dir), ["fecha"], last_wins=False)),
    ]


@query
def load_counters(spark, sf_dir):
    parts = [df.select(F.lit(source).alias("fuente"), "*") for source, df in _counters(spark, sf_dir)]
    return reduce(DataFrame.unionByName, parts)


@query
def load_audit(spark, sf_dir):
    parts = [
        audit.audit_rows(df, "corrida-1", source, f"crudo/{source}", moment(FIRST_LOAD), i)
        for i, (source, df) in enumerate(_counters(spark, sf_dir))
    ]
    return audit.history(shown_stamp(reduce(DataFrame.unionByName, parts), "cargado_en"))


@query
def rerun_idempotent(spark, sf_dir):
    """Rows, rows with the same content and rows with a new load time after loading the same sales twice."""
    sales = d.sales(spark, sf_dir)
    empty = spark.createDataFrame([], t.SALES.schema)
    once = d.stored(spark, keyed.upsert(empty, sales, t.SALES.keys, t.SALES.stamp, moment(FIRST_LOAD)), "una")
    twice = keyed.upsert(once, sales, t.SALES.keys, t.SALES.stamp, moment(SECOND_LOAD))
    content = [name for name in t.SALES.columns if name not in (*t.SALES.keys, t.SALES.stamp)]
    renamed = once.select(*t.SALES.keys, *[F.col(name).alias(f"{name}_1") for name in (*content, t.SALES.stamp)])
    both = twice.join(renamed, list(t.SALES.keys), "full_outer")
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"{name}_1")) for name in content])
    return both.agg(
        F.count("*").alias("filas"), F.count_if(same).alias("iguales"),
        F.count_if(F.col("cargado_en") > F.col("cargado_en_1")).alias("recargadas"),
    )


@query
def rerun_whole_run(spark, sf_dir):
    """Rows of each table after a whole daily run, and how many are the same after a second one on the same files.

    The derived data breaks some rules on purpose, so each run ends with them, after its tables are published.
    """
    inputs, root = d.written_inputs(spark, sf_dir), scratch_path(spark, "casa")
    house = Warehouse(spark, root)
    states = []
    for day in (12, 13):
        started = datetime(2026, 9, day, 7, tzinfo=ZoneInfo("UTC"))
        with contextlib.suppress(quality.QualityError):
            daily_run.run_daily(
                spark, root, inputs, "igual", now=started, until=date(2100, 1, 1), history_start=date(1900, 1, 1)
            )
        states.append({
            table: house.read(table).select(*[name for name in table.columns if name != table.stamp])
            for table in (*t.STAGING, *t.STAR)
        })
    counted = []
    for table, before in states[0].items():
        same = before.intersectAll(states[1][table]).agg(F.count("*").alias("iguales"))
        counted.append(before.agg(F.lit(table.name).alias("tabla"), F.count("*").alias("filas")).withColumn("iguales", same.scalar()))
    return reduce(DataFrame.unionByName, counted)


# --- column expressions -------------------------------------------------------------------------


def _judged(df: DataFrame, value: Column, error: Column) -> DataFrame:
    """Distinct texts with their value, reason and number of occurrences."""
    return df.groupBy("texto").agg(F.count("*").alias("n")).select("texto", value.alias("valor"), error.alias("motivo"), "n")


@query
def clean_text(spark, sf_dir):
    """Every conversation turn, padded with white space of several kinds; the eighth turns are blank."""
    turns = d.table(spark, sf_dir, "conversations")
    padded = F.when(F.col("turn") == 7, F.lit(" \t　\n")).otherwise(F.concat(F.lit("\t "), "text", F.lit("  \r\n")))
    text = c.stripped(F.col("texto"))
    return turns.select("conv_id", "turn", padded.alias("texto")).select(
        "conv_id", "turn", F.md5(text.cast("binary")).alias("huella"), F.length(text).alias("largo"),
        c.text_error(text, "texto").alias("motivo"),
    )


@query
def clean_positive_int(spark, sf_dir):
    lines = d.table(spark, sf_dir, "lineitem")
    n, kind = F.col("l_partkey").cast("string"), F.col("l_linenumber")
    text = (
        F.when(kind == 1, F.concat(F.lit("+"), n)).when(kind == 2, F.concat(F.lit("00"), n))
        .when(kind == 3, F.concat(n, F.lit("_000"))).when(kind == 4, F.concat(n, F.lit(".0")))
        .when(kind == 5, F.concat(F.lit("-"), n)).when(kind == 6, F.concat(F.lit(" "), n, F.lit("\t")))
        .otherwise(F.lit(" "))
    )
    stripped = c.stripped(F.col("texto"))
    value, error = c.positive_int(stripped), c.positive_int_error(stripped, "cantidad")
    return _judged(lines.select(text.alias("texto")), F.when(error.isNull(), value), error)


@query
def clean_money(spark, sf_dir):
    """Plain, ``$``, half-cent ties, grouped thousands, exponents, no number, not finite."""
    lines = d.table(spark, sf_dir, "lineitem")
    kind, price = F.col("l_linenumber"), d.cents(F.col("l_extendedprice"))
    plain = price.cast("string")
    text = (
        F.when(kind == 1, plain).when(kind == 2, F.concat(F.lit(" $ "), plain)).when(kind == 3, F.concat(plain, F.lit("5")))
        .when(kind == 4, F.format_number(price, 2)).when(kind == 5, F.concat(F.col("l_quantity").cast("bigint"), F.lit("e1")))
        .when(kind == 6, F.concat(F.lit("-"), plain))
        .otherwise(F.when(F.col("l_quantity") > 25, F.lit("NaN")).otherwise(F.lit("por definir")))
    )
    stripped = c.stripped(F.col("texto"))
    amount = c.amount_text(stripped)
    error = F.coalesce(c.text_error(stripped, "precio"), c.money_error(amount, "precio", c.quoted(F.col("texto"))))
    return _judged(lines.select(text.alias("texto")), F.when(error.isNull(), c.money(amount)), error)


@query
def clean_date(spark, sf_dir):
    lines = d.table(spark, sf_dir, "lineitem")
    kind, shipped = F.col("l_linenumber"), "l_shipdate"
    text = (
        F.when(kind == 1, F.date_format(shipped, "yyyy-MM-dd")).when(kind == 2, F.date_format(shipped, "dd/MM/yyyy"))
        .when(kind == 3, F.date_format(shipped, "yyyy-M-d")).when(kind == 4, F.date_format(shipped, "d/M/yyyy"))
        .when(kind == 5, F.date_format(shipped, "yyyy-'30'-dd")).when(kind == 6, F.date_format(shipped, "'31'/M/yyyy"))
        .otherwise(F.date_format(shipped, "dd/MM/yy"))
    )
    stripped = c.stripped(F.col("texto"))
    value = c.day(stripped)
    return _judged(lines.select(text.alias("texto")), value, F.when(value.isNull(), c.day_error(stripped, "fecha")))


@query
def clean_channel(spark, sf_dir):
    raw = d.raw_sales(spark, sf_dir).select(F.col("canal").alias("texto"))
    stripped = c.stripped(F.col("texto"))
    value = c.channel(stripped)
    error = F.when(value.isNull(), c.channel_error(stripped, "canal", c.quoted(F.col("texto"))))
    return _judged(raw, value, error)


@query
def sales_rejects(spark, sf_dir):
    return sales_csv.rejected(d.checked_sales(spark, sf_dir)).select(
        "l_orderkey", "l_linenumber", "folio", "producto_id", "motivo"
    )


@query
def product_rejects(spark, sf_dir):
    return d.checked_products(spark, sf_dir).where("motivo IS NOT NULL").select("archivo", "linea", "motivo")


@query
def products_clean(spark, sf_dir):
    return d.checked_products(spark, sf_dir).where("motivo IS NULL").drop("motivo")


@query
def weather_rejects(spark, sf_dir):
    return d.checked_weather(spark, sf_dir).where("motivo IS NOT NULL").select("archivo", "linea", "motivo")


@query
def fx_rejects(spark, sf_dir):
    return d.checked_fx(spark, sf_dir).where("motivo IS NOT NULL").select("linea", "motivo")


@query
def weekday_name(spark, sf_dir):
    days = d.sales(spark, sf_dir).groupBy("fecha").agg(F.count("*").alias("ventas"))
    return days.select("fecha", measures.weekday_name(F.col("fecha")).alias("dia_semana"), "ventas")


@query
def line_total(spark, sf_dir):
    total = measures.line_total(F.col("cantidad"), F.col("precio_unitario"))
    return d.sales(spark, sf_dir).select("folio", "producto_id", total.alias("total_mxn"))


@query
def sales_usd(spark, sf_dir):
    priced = asof_day_join(d.sales(spark, sf_dir), d.fx_rates(spark, sf_dir), "fecha", "usd_mxn")
    usd = measures.line_total_usd(F.col("cantidad"), F.col("precio_unitario"), F.col("usd_mxn"))
    return priced.select("folio", "producto_id", usd.alias("total_usd"))


@query
def rainy_flag(spark, sf_dir):
    return d.dim_weather(spark, sf_dir)


# --- joins --------------------------------------------------------------------------------------


@query
def sales_enriched(spark, sf_dir):
    return star.known_sales(d.sales(spark, sf_dir), d.products(spark, sf_dir)).select(*sales_csv.COLUMNS)


@query
def asof_fx(spark, sf_dir):
    """The rate of every order line, dirty ones included, by its ship day."""
    lines = d.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("fecha"))
    return asof_day_join(lines, d.fx_rates(spark, sf_dir), "fecha", "usd_mxn").select(
        "l_orderkey", "l_linenumber", "fecha", "usd_mxn"
    )


# --- dedup --------------------------------------------------------------------------------------


@query
def sales_dedup(spark, sf_dir):
    return keyed.latest_by_key(d.good_sales(spark, sf_dir), sales_csv.KEYS, d.ORDER, copies="copias")


@query
def products_dedup(spark, sf_dir):
    return d.products(spark, sf_dir)


# --- star schema, reports -----------------------------------------------------------------------


@query
def fact_sales(spark, sf_dir):
    return d.fact(spark, sf_dir)


@query
def daily_report(spark, sf_dir):
    return reports.daily_report(spark, d.fact(spark, sf_dir), d.dim_weather(spark, sf_dir))


@query
def product_ranking(spark, sf_dir):
    ranked = reports.product_ranking(spark, d.fact(spark, sf_dir), d.dim_product(spark, sf_dir))
    return ranked.orderBy(F.desc("ingreso_mxn"), "producto_id")


@query
def sales_by_rain(spark, sf_dir):
    daily = reports.daily_report(spark, d.fact(spark, sf_dir), d.dim_weather(spark, sf_dir))
    return reports.sales_by_rain(spark, daily).orderBy("clima")


@query
def summary_totals(spark, sf_dir):
    return reports.totals(spark, d.fact(spark, sf_dir))


@query
def last_7_days(spark, sf_dir):
    stage = d.stored_stage(spark, sf_dir)
    return reports.last_days(spark, stage.fact, stage.dim_weather)


@query
def top_products(spark, sf_dir):
    return reports.top_products(spark, d.fact(spark, sf_dir), d.dim_product(spark, sf_dir))


# --- quality ------------------------------------------------------------------------------------


@query
def dq_nonempty(spark, sf_dir):
    tables = {
        "ventas": d.sales, "productos": d.products, "clima": d.weather, "tipo_cambio": d.fx_rates,
    }
    parts = [
        quality.is_empty(derive(spark, sf_dir)).select(F.lit(name).alias("tabla"), "problemas")
        for name, derive in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def dq_unknown_product(spark, sf_dir):
    return quality.unknown_products(d.stored_stage(spark, sf_dir))


@query
def dq_missing_in_fact(spark, sf_dir):
    return quality.missing_in_fact(d.stored_stage(spark, sf_dir))


@query
def dq_missing_fx(spark, sf_dir):
    return quality.missing_rates(d.stored_stage(spark, sf_dir))


@query
def dq_total_mismatch(spark, sf_dir):
    return quality.total_mismatches(d.stored_stage(spark, sf_dir))


@query
def dq_future_day(spark, sf_dir):
    return quality.future_days(d.stored_stage(spark, sf_dir), TODAY)


@query
def dq_days_without_weather(spark, sf_dir):
    return quality.days_without_weather(d.stored_stage(spark, sf_dir))


@query
def dq_price_vs_list(spark, sf_dir):
    return quality.prices_off_list(d.stored_stage(spark, sf_dir))


@query
def dq_report(spark, sf_dir):
    return quality.report(d.stored_stage(spark, sf_dir), TODAY)


@query
def constraint_report(spark, sf_dir):
    """Constraints of the staging and star tables, with a fact that also holds sales of unknown products."""
    stage = d.stored_stage(spark, sf_dir)
    loaded = {
        t.SALES: stage.sales, t.PRODUCTS: stage.products, t.WEATHER: stage.weather, t.FX_RATES: stage.fx_rates,
        t.DIM_PRODUCT: stage.dim_product, t.DIM_WEATHER: stage.dim_weather,
        t.FACT_SALES: star.fact_rows(stage.sales, stage.sales.select("producto_id"), stage.fx_rates),
    }
    stamped = {table: df.withColumn(table.stamp, moment(FIRST_LOAD)) for table, df in loaded.items()}
    return quality.constraint_report(
        stamped.__getitem__, tuple(loaded), t.FACT_SALES, t.DIM_PRODUCT
    )


def _emptied(spark, sf_dir) -> quality.Stage:
    none = lambda df: df.where("fecha > date'2100-01-01'")
    products = d.products(spark, sf_dir).where("producto_id < 0")
    sales, weather, rates = (none(f(spark, sf_dir)) for f in (d.sales, d.weather, d.fx_rates))
    return quality.Stage(sales, products, weather, rates, star.product_rows(products), star.weather_rows(weather), sales)


@query
def dq_broken(spark, sf_dir):
    """Rules that the other queries leave at 0: empty sources; a catalogue without every fifth product; facts of which every
    eleventh product is missing and every seventh has a total one cent off."""
    empty = _emptied(spark, sf_dir)
    parts = [("vacía", i, quality.is_empty(df)) for i, df in enumerate((empty.sales, empty.products, empty.weather, empty.fx_rates), 1)]
    stage = d.stored_stage(spark, sf_dir)
    off = F.when(F.col("producto_id") % 7 == 0, F.lit(0.01).cast("decimal(3,2)")).otherwise(F.lit(0).cast("decimal(3,2)"))
    fact = stage.fact.where("producto_id % 11 <> 0").withColumn("total_mxn", (F.col("total_mxn") + off).cast("decimal(12,2)"))
    altered = replace(stage, fact=fact, dim_product=stage.dim_product.where("producto_id % 5 <> 0"))
    rules = ((5, quality.unknown_products), (6, quality.missing_in_fact), (8, quality.total_mismatches))
    parts += [("alterada", number, rule(altered)) for number, rule in rules]
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(case).alias("caso"), F.lit(number).alias("regla"), F.col("problemas").cast("bigint").alias("problemas")) for case, number, df in parts
    ])


@query
def constraint_violations(spark, sf_dir):
    """Constraints of sales that break them: keys twice, no folio, no channel, no pieces, products the catalogue lacks."""
    sales = d.stored(spark, d.sales(spark, sf_dir), "ventas")
    number = F.col("producto_id")
    broken = sales.select(
        F.when(number % 17 != 0, F.col("folio")).alias("folio"), "fecha", "producto_id",
        F.when(number % 11 == 0, 0).otherwise(F.col("cantidad")).alias("cantidad"), "precio_unitario",
        F.when(number % 13 != 0, F.col("canal")).alias("canal"),
    ).unionByName(sales.where("producto_id % 10 = 0")).withColumn(t.SALES.stamp, moment(FIRST_LOAD))
    parts = [
        quality.row_constraints(t.SALES, broken), quality.key_constraint(t.SALES, broken),
        quality.reference_constraint(t.SALES, broken, d.products(spark, sf_dir), "producto_id"),
    ]
    return reduce(DataFrame.unionByName, [p.withColumn("problemas", F.col("problemas").cast("bigint")) for p in parts])


@query
def precision_limits(spark, sf_dir):
    """Values that do not fit the declared columns, per column: some pieces, prices and rates are far too large, by rule."""
    lines, orders = d.table(spark, sf_dir, "lineitem"), d.table(spark, sf_dir, "orders")
    order = F.col("l_orderkey")
    sales = lines.select(
        F.col("l_partkey").alias("producto_id"),
        (F.when(order % 41 == 0, 100_000_000).otherwise(1).cast("bigint") * F.col("l_quantity").cast("bigint")).alias("cantidad"),
        (F.when(order % 37 == 0, 5000).otherwise(1) * F.col("l_extendedprice").cast("decimal(12,3)")).alias("precio_unitario"),
    )
    rates = orders.select((F.col("o_custkey") % 50_000 * 60).cast("decimal(20,5)").alias("usd_mxn"))
    return quality.precision_limits(t.SALES, sales).unionByName(quality.precision_limits(t.FX_RATES, rates))


@query
def adhoc_query(spark, sf_dir):
    """Plain SQL with named parameters over a published table."""
    house = Warehouse(spark, scratch_path(spark, "casa"))
    house.bootstrap()
    house.publish({t.SALES: d.sales(spark, sf_dir).withColumn(t.SALES.stamp, moment(FIRST_LOAD))})
    return house.query(
        "SELECT producto_id, count(*) AS ventas, sum(cantidad) AS piezas, max(precio_unitario) AS precio_max FROM staging.ventas "
        "WHERE fecha BETWEEN :desde AND :hasta AND canal = :canal AND cantidad >= :piezas GROUP BY producto_id",
        desde=date(1997, 1, 1), hasta=date(1998, 6, 30), canal="WhatsApp", piezas=10,
    )


# --- incremental --------------------------------------------------------------------------------


@query
def incremental_window(spark, sf_dir):
    """Windows for the two daily sources, for a later end day and for a history that starts after the data."""
    parts = []
    for source, derive in (("clima", d.weather), ("tipo_cambio", d.fx_rates)):
        stored = derive(spark, sf_dir)
        for case, end, start in (
            ("normal", date(2001, 9, 1), HISTORY_START),
            ("fin anterior", date(2000, 1, 1), HISTORY_START),
            ("historia posterior", date(2026, 9, 13), incremental.HISTORY_START),
        ):
            window = incremental.incremental_window(stored, end, start)
            parts.append(window.select(F.lit(source).alias("fuente"), F.lit(case).alias("caso"), "inicio", "fin"))
    return reduce(DataFrame.unionByName, parts)


@query
def window_end(spark, sf_dir):
    """The last complete day at moments around midnight in the business zone, an hour apart for summer time."""
    orders = d.table(spark, sf_dir, "orders")
    hours = F.when(F.col("o_orderkey") % 2 == 0, 18_000).otherwise(21_600)
    seconds = hours - 2 + F.col("o_orderkey") % 5
    at = F.to_date("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    moments = orders.groupBy(at.alias("m")).agg(F.count("*").alias("n"))
    return moments.select(F.date_format("m", "yyyy-MM-dd HH:mm:ss").alias("momento"), incremental.last_complete_day(F.col("m")).alias("fin"), "n")


@query
def incremental_slice(spark, sf_dir):
    """Payload rows a second load takes when everything up to 2001-06-30 is stored."""
    days = d.weather(spark, sf_dir)
    window = incremental.incremental_window(days.where("fecha <= date'2001-06-30'"), WINDOW_END, HISTORY_START)
    return incremental.slice_days(days, window, F.col("fecha"))
