"""Product catalogue: JSON documents with a ``productos`` list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mostrador.functions import cleaning as c
from mostrador.operators.barrier import evaluated_once

KEYS = ("producto_id",)
POSITION = ("archivo", "linea")
FIELDS = ("id", "nombre", "marca", "tipo", "precio")


def scan(documents: DataFrame) -> DataFrame:
    """One row per list element: ``archivo``, ``linea`` (from 1) and the element's text.

    Elements stay text so that loosely typed or mixed lists survive and ``1.0`` is not read as ``1``.
    A document without a list stops the load.
    """
    has_list = F.json_array_length(F.get_json_object("contenido", "$.productos")).isNotNull()
    problem = F.raise_error(F.lit('El JSON de productos debe tener una lista "productos"')).cast("string")
    text = F.when(has_list, F.col("contenido")).otherwise(problem)
    elements = F.from_json(text, "productos array<string>")["productos"]
    return documents.select("archivo", F.posexplode(elements).alias("_pos", "elemento")).select(
        "archivo", (F.col("_pos") + 1).alias("linea"), "elemento"
    )


def classify(elements: DataFrame) -> DataFrame:
    """Typed catalogue columns plus ``motivo``; fields that are not listed are dropped."""
    is_object = F.coalesce(F.startswith(F.ltrim("elemento"), F.lit("{")), F.lit(False))
    fields = F.from_json("elemento", ", ".join(f"{name} string" for name in FIELDS))
    opened = elements.select(
        *POSITION, "elemento", is_object.alias("_objeto"), F.when(is_object, fields).alias("_f")
    )
    text = {name: F.col(f"_t_{name}") for name in FIELDS}
    raw_price = F.col("_f.precio")
    typed = opened.select(
        "*",
        *[c.stripped(F.col(f"_f.{name}")).alias(f"_t_{name}") for name in FIELDS],
        c.amount_text(c.stripped(raw_price)).alias("_monto"),
    ).select("*", c.positive_int(text["id"]).alias("_v_id"), c.money(F.col("_monto")).alias("_v_precio"))
    # Numbers appear in reasons as they are, text in quotes.
    is_text = F.contains(F.schema_of_variant(F.try_parse_json("elemento")), F.lit("precio: STRING"))
    shown = F.when(is_text, c.quoted(raw_price)).otherwise(raw_price)
    reason = F.coalesce(
        F.when(~F.col("_objeto"), F.lit("el producto no es un objeto")),
        c.positive_int_error(text["id"], "id"),
        c.text_error(text["nombre"], "nombre"),
        c.text_error(text["marca"], "marca"),
        c.text_error(text["tipo"], "tipo"),
        c.text_error(text["precio"], "precio"),
        c.money_error(F.col("_monto"), "precio", shown),
    )
    good = (F.col("_v_id") > 0) & (F.col("_v_precio") > 0)
    for name in ("nombre", "marca", "tipo"):
        good = good & ~c.is_blank(text[name])
    # An element that has a value missing but nothing wrong holds a number that does not fit its column.
    flaw = F.when(~F.coalesce(good, F.lit(False)), c.must_fit(reason, F.col("elemento")))
    values = {
        "producto_id": F.col("_v_id"), "nombre": text["nombre"], "marca": text["marca"], "tipo": text["tipo"],
        "precio": F.col("_v_precio"),
    }
    judged = evaluated_once(typed.select(flaw.alias("motivo"), *POSITION, *[v.alias(n) for n, v in values.items()]))
    kept = F.col("motivo").isNull()
    return judged.select(
        *POSITION, *[F.when(kept, F.col(name)).alias(name) for name in values], "motivo"
    )
