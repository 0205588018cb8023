"""Data-quality rules, declared constraints, and the gates that act on them.

Rules and constraints are DataFrames with one row per check, so they can be queried, stored or compared;
``enforce_*`` turn them into an error. Hot products and keys are counted before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.operators import keyed
from mostrador.session import joinable
from mostrador.tables import Table


@dataclass(frozen=True)
class Stage:
    """The tables the rules look at."""

    sales: DataFrame
    products: DataFrame
    weather: DataFrame
    fx_rates: DataFrame
    dim_product: DataFrame
    dim_weather: DataFrame
    fact: DataFrame


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("problemas"))


def _count_if(df: DataFrame, problem: Column | str) -> DataFrame:
    problem = F.expr(problem) if isinstance(problem, str) else problem
    return df.agg(F.count_if(problem).alias("problemas"))


def is_empty(df: DataFrame) -> DataFrame:
    """1 when there is no row, else 0; reads at most one row."""
    return df.select(F.lit(1).alias("_one")).limit(1).agg((1 - F.count("*")).alias("problemas"))


def unknown_products(stage: Stage) -> DataFrame:
    sold = stage.sales.groupBy("producto_id").agg(F.count("*").alias("ventas"))
    # Sorted and merged where the counts are: the catalogue's ids, however many, do not go through the driver.
    unknown = sold.join(stage.dim_product.select("producto_id").hint("merge"), "producto_id", "left_anti")
    return unknown.agg(F.coalesce(F.sum("ventas"), F.lit(0)).alias("problemas"))


def missing_in_fact(stage: Stage) -> DataFrame:
    """Keys are sorted by a hash of them, as many folios begin alike; the keys themselves decide."""
    keys = ["folio", "producto_id"]
    sold, known = (df.select(F.xxhash64(*keys).alias("_h"), *keys) for df in (stage.sales, stage.fact))
    return _count(sold.join(joinable(known), ["_h", *keys], "left_anti"))


MISSING_RATE = "usd_mxn IS NULL"
TOTAL_MISMATCH = "total_mxn <> cantidad * precio_unitario"


def missing_rates(stage: Stage) -> DataFrame:
    return _count_if(stage.fact, MISSING_RATE)


def total_mismatches(stage: Stage) -> DataFrame:
    return _count_if(stage.fact, TOTAL_MISMATCH)


def future_days(stage: Stage, today: date) -> DataFrame:
    return _count_if(stage.fact, F.col("fecha") > F.lit(today))


def days_without_weather(stage: Stage) -> DataFrame:
    measured = stage.dim_weather.where("lluvia_mm IS NOT NULL")
    return _count(stage.fact.select("fecha").distinct().join(measured, "fecha", "left_anti"))


def prices_off_list(stage: Stage) -> DataFrame:
    sold = stage.fact.groupBy("producto_id", "precio_unitario").agg(F.count("*").alias("ventas"))
    listed = joinable(stage.dim_product.select("producto_id", "precio_lista"))
    off = sold.join(listed, "producto_id").where("precio_unitario <> precio_lista")
    return off.agg(F.coalesce(F.sum("ventas"), F.lit(0)).alias("problemas"))


# Rule texts in report order, and whether a rule stops the run.
RULES = (
    ("Hay ventas cargadas", True),
    ("Hay productos cargados", True),
    ("Hay datos de clima", True),
    ("Hay tipos de cambio", True),
    ("Toda venta es de un producto del catálogo", True),
    ("Todas las ventas de staging llegaron a fact_ventas", True),
    ("Toda venta tiene tipo de cambio", True),
    ("El total en pesos cuadra con cantidad x precio", True),
    ("Ningún pedido tiene fecha futura", True),
    ("Los días con ventas tienen dato de clima", False),
    ("Precio vendido igual al de lista (descuentos o cambios de precio)", False),
)


def report(stage: Stage, today: date) -> DataFrame:
    """One row per rule: ``(regla, descripcion, obligatoria, problemas, estado)``.

    The three rules that look at single fact rows share one pass over the facts.
    """
    row_rules = stage.fact.agg(
        F.count_if(F.expr(MISSING_RATE)).alias("r7"),
        F.count_if(F.expr(TOTAL_MISMATCH)).alias("r8"),
        F.count_if(F.col("fecha") > F.lit(today)).alias("r9"),
    ).select(F.expr("stack(3, 7, r7, 8, r8, 9, r9) AS (regla, problemas)"))
    single: list[tuple[int, DataFrame]] = [
        (1, is_empty(stage.sales)),
        (2, is_empty(stage.products)),
        (3, is_empty(stage.weather)),
        (4, is_empty(stage.fx_rates)),
        (5, unknown_products(stage)),
        (6, missing_in_fact(stage)),
        (10, days_without_weather(stage)),
        (11, prices_off_list(stage)),
    ]
    counts = [df.select(F.lit(number).alias("regla"), F.col("problemas")) for number, df in single]
    counted = reduce(DataFrame.unionByName, counts, row_rules)
    texts = F.array(*[F.lit(text) for text, _ in RULES])
    severity = F.array(*[F.lit(mandatory) for _, mandatory in RULES])
    rated = counted.withColumn("descripcion", F.element_at(texts, F.col("regla"))).withColumn(
        "obligatoria", F.element_at(severity, F.col("regla"))
    )
    state = F.when(F.col("problemas") == 0, "OK").when(F.col("obligatoria"), "FALLA").otherwise("AVISO")
    return rated.select(
        "regla", "descripcion", "obligatoria", F.col("problemas").cast("bigint").alias("problemas"), state.alias("estado")
    )


class QualityError(ValueError):
    """A mandatory rule or a declared constraint does not hold."""


def enforce_report(rated: DataFrame) -> dict:
    """Read the (eleven-row) report; raise once with every failed mandatory rule, else return the warnings."""
    rows = rated.orderBy("regla").collect()
    failed = [f"{row.descripcion}: {row.problemas}" for row in rows if row.estado == "FALLA"]
    if failed:
        raise QualityError("Falló la validación de calidad: " + "; ".join(failed))
    return {
        "reglas": len(rows),
        "avisos": [f"{row.descripcion}: {row.problemas}" for row in rows if row.estado == "AVISO"],
    }


# --- declared constraints -----------------------------------------------------------------------


def _row_checks(table: Table) -> list[tuple[str, Column]]:
    checks = [(f"{name} no nulo", F.col(name).isNull()) for name in table.required]
    return checks + [(f"{name} mayor a 0", F.col(name) <= 0) for name in table.positive]


def row_constraints(table: Table, df: DataFrame) -> DataFrame:
    """NOT NULL and greater-than-zero violations of one table, counted in a single pass."""
    checks = _row_checks(table)
    counts = df.agg(*[F.count_if(problem).alias(f"c{i}") for i, (_, problem) in enumerate(checks)])
    pairs = ", ".join(f"'{text}', c{i}" for i, (text, _) in enumerate(checks))
    return counts.select(
        F.lit(table.name).alias("tabla"), F.expr(f"stack({len(checks)}, {pairs}) AS (restriccion, problemas)")
    )


def observed(table: Table, df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` whose violations of the row constraints are counted while it is written, without another pass."""
    seen = Observation(f"restricciones {table.name}")
    counts = [F.count_if(problem).alias(text) for text, problem in _row_checks(table)]
    return df.observe(seen, *counts), seen


def observed_violations(table: Table, seen: Observation) -> list[tuple[str, str, int]]:
    """``(table, constraint, count)`` of what :func:`observed` saw. A repeated task may count a row twice, never a good one."""
    return [(table.name, text, count) for text, count in seen.get.items() if count]


def key_constraint(table: Table, df: DataFrame) -> DataFrame:
    """Number of keys that occur more than once. Keys are counted by hash; only repeated ones are compared as a whole."""
    keys = list(table.keys)
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_h"))
    suspect = hashed.join(keyed.known_repeats(df, keys), "_h", "left_semi")
    repeated = suspect.groupBy(*keys).agg(F.count("*").alias("veces")).where("veces > 1")
    return _named(_count(repeated), table, f"llave única ({', '.join(keys)})")


def reference_constraint(table: Table, df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Number of rows whose ``key`` the parent table does not have. The parent's keys are merged with the counts, not broadcast."""
    used = df.groupBy(key).agg(F.count("*").alias("veces"))
    orphans = used.join(parent.select(key).hint("merge"), key, "left_anti")
    return _named(
        orphans.agg(F.coalesce(F.sum("veces"), F.lit(0)).alias("problemas")), table, f"{key} existe en el catálogo"
    )


def _named(counted: DataFrame, table: Table, text: str) -> DataFrame:
    return counted.select(F.lit(table.name).alias("tabla"), F.lit(text).alias("restriccion"), "problemas")


def constraint_report(read: Callable[[Table], DataFrame], tables: tuple[Table, ...], fact: Table, catalogue: Table) -> DataFrame:
    """Every declared constraint of ``tables`` with its number of violations."""
    parts = [row_constraints(table, read(table)) for table in tables]
    parts += [key_constraint(table, read(table)) for table in tables]
    parts.append(reference_constraint(fact, read(fact), read(catalogue), catalogue.keys[0]))
    return reduce(DataFrame.unionByName, parts)


def precision_limits(table: Table, df: DataFrame) -> DataFrame:
    """``(tabla, columna, tipo, problemas)``: per numeric column of ``table`` that ``df`` has, how many values do not fit its
    declared type after rounding. ``df`` has them in wider types; nothing is raised."""
    fields = [f for f in table.schema.fields if isinstance(f.dataType, (T.IntegerType, T.DecimalType)) and f.name in df.columns]
    counts = [F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f"c{i}") for i, f in enumerate(fields)]
    rows = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', c{i}" for i, f in enumerate(fields))
    return df.agg(*counts).select(F.lit(table.name).alias("tabla"), F.expr(f"stack({len(fields)}, {rows}) AS (columna, tipo, problemas)"))


def enforce_constraints(violations: DataFrame, seen: list[tuple[str, str, int]] = ()) -> None:
    """Raise with all of ``violations`` (one row per constraint) and ``seen`` that have a count."""
    counted = violations.where("problemas > 0").select("tabla", "restriccion", "problemas").collect()
    broken = sorted({*seen, *map(tuple, counted)})
    if broken:
        raise QualityError("restricciones violadas: " + "; ".join(f"{table} {text}: {count}" for table, text, count in broken))
