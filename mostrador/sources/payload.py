"""What a saved service response must look like before its days are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def problem(content: Column, field: str) -> Column:
    """Why a response cannot be loaded, NULL when it can.

    It has to be one whole JSON object. ``field`` may be missing, or empty in any way (null, ``{}``, ``[]``, ``""``,
    ``0``, ``false``); otherwise it must be an object as well.
    """
    # In brackets, text behind the object is no longer a list of one; the parser alone would leave it unread.
    alone = F.json_array_length(F.concat(F.lit("["), content, F.lit("]"))) == 1
    whole = F.when(alone, F.try_parse_json(content))
    inner = F.try_variant_get(whole, f"$.{field}", "variant")
    kind = F.schema_of_variant(inner)
    empty = F.to_json(inner).isin("null", "[]", '""', "0", "0.0", "false")
    return (
        F.when(whole.isNull(), F.lit("no es un documento JSON completo"))
        .when(~F.startswith(F.schema_of_variant(whole), F.lit("OBJECT")), F.lit("no es un objeto JSON"))
        .when(inner.isNotNull() & ~F.startswith(kind, F.lit("OBJECT")) & ~empty, F.lit(f'"{field}" no es un objeto'))
    )


def checked(documents: DataFrame, field: str) -> DataFrame:
    """``documents`` (archivo, contenido); reading one with a :func:`problem` stops the load and names its file."""
    reason = problem(F.col("contenido"), field)
    stop = F.raise_error(F.concat(F.lit("respuesta ilegible en "), "archivo", F.lit(": "), reason)).cast("string")
    return documents.withColumn("contenido", F.when(reason.isNull(), F.col("contenido")).otherwise(stop))
