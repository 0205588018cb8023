"""Sales CSV: landed lines to records, validation and record numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mostrador.functions import cleaning as c
from mostrador.operators.barrier import evaluated_once
from mostrador.session import stored
from mostrador.sources.landing import BLANK, FIELD, JOINED, PLAIN, broadcast_if_few, closes, header_text, without_return

# Columns the file must have.
COLUMNS = ("folio", "fecha", "producto_id", "cantidad", "precio_unitario", "canal")
KEYS = ("folio", "producto_id")
POSITION = ("archivo_no", "bloque", "linea_id", "parte")

RETURN = "\r"

# No field may be longer; a longer one (usually a quote left open) stops the load.
FIELD_LIMIT = 131_072


# --- headers ------------------------------------------------------------------------------------


def header_names(header: Column) -> Column:
    """Column names of a header line as an array: quotes around a field taken off, doubled ones single."""
    fields = F.regexp_extract_all(F.concat(F.lit(","), header), F.lit(f",({FIELD})"), F.lit(1))
    bare = lambda f: F.replace(F.regexp_replace(f, r'^"((?:[^"]|"")*)"', "$1"), F.lit('""'), F.lit('"'))
    return F.transform(fields, lambda f: F.when(F.startswith(f, F.lit('"')), bare(f)).otherwise(f))


def column_map(files: DataFrame) -> DataFrame:
    """``(archivo_no, primera, ancho, lugares)`` of landed files that have a line: number of header columns, and the place
    (from 1; 0: missing) of each of :data:`COLUMNS`. Of repeated names the last one counts."""
    names = header_names(F.coalesce("encabezado", F.lit("")))
    found = files.where("primera IS NOT NULL").select("archivo_no", "primera", names.alias("nombres"))
    size = F.size("nombres")
    place = [F.array_position(F.reverse("nombres"), name) for name in COLUMNS]
    places = F.array(*[F.when(p == 0, 0).otherwise(size + 1 - p).cast("int") for p in place])
    return found.select("archivo_no", "primera", size.alias("ancho"), places.alias("lugares"))


def check_headers(lines: DataFrame, mapped: DataFrame) -> None:
    """Stop the load when a header lacks required columns, naming all of them. At most one header reaches the driver."""
    lacking = mapped.where(F.array_contains("lugares", 0)).orderBy("archivo_no").limit(1)
    bad = lacking.first()
    missing = None
    if bad is not None:
        # Landing marks first lines with all names; what this one has is read now.
        text = lines.where((F.col("archivo_no") == bad.archivo_no) & (F.col("linea_id") == bad.primera)).select(header_names(header_text()).alias("x"))
        names = text.first().x
        missing = [name for name in COLUMNS if name not in names]
    elif mapped.isEmpty():
        missing = list(COLUMNS)
    if missing:
        raise ValueError(f"Al CSV de ventas le faltan columnas: {', '.join(missing)}")


# --- records ------------------------------------------------------------------------------------


def _padded(text: Column, width: int) -> Column:
    """Records of files with fewer columns get empty ones at their end, so the parser finds all it expects."""
    lacking = F.lit(width) - F.col("ancho")
    return F.when((lacking > 0) & closes(text), F.concat(text, F.repeat(F.lit(","), lacking))).otherwise(text)


def _joined_records(lines: DataFrame) -> DataFrame:
    """Records of files in which some quoted field runs over line ends.

    Whether a line starts inside quotes depends on all lines before it, yet each line only maps the state
    before to the state after: it keeps it, flips it, or fixes it whatever it was. Those maps are composed
    within each file split (a bounded piece of the file), then over the splits (one row each), so no task
    ever needs a whole file.
    """
    parts = lines.select(
        "archivo_no", "archivo", "bloque", "linea_id",
        F.posexplode(F.split(without_return(F.col("contenido")), RETURN)).alias("parte", "texto"),
    )
    from_outside = F.when(closes(F.col("texto")), 0).otherwise(1)
    from_inside = (
        F.when(~F.contains("texto", F.lit('"')), 1)
        .when(closes(F.concat(F.lit('"'), F.col("texto"))), 0)
        .otherwise(1)
    )
    split = W.partitionBy("archivo_no", "bloque").orderBy("linea_id", "parte")
    so_far = split.rowsBetween(W.unboundedPreceding, W.currentRow)
    odd_flips = F.col("giros") % 2
    # What depends on the state in which the split starts is worked out for both (0: outside, 1: inside quotes), in the one
    # pass over the sorted lines.
    starts = (0, 1)
    after = {s: F.coalesce("fijo", F.lit(s)).bitwiseXOR(odd_flips) for s in starts}
    before = {s: F.coalesce(F.lag(after[s]).over(split), F.lit(s)) for s in starts}
    head = {s: F.when((F.col(f"antes{s}") == 0) & (F.col("texto") != ""), 1).otherwise(0) for s in starts}
    states = (
        parts.withColumn("fuera", from_outside).withColumn("dentro", from_inside)
        .withColumn("giros", F.sum(F.when(F.col("fuera") > F.col("dentro"), 1).otherwise(0)).over(so_far))
        .withColumn("fijo", F.when(F.col("fuera") == F.col("dentro"), F.col("fuera").bitwiseXOR(odd_flips)))
        .withColumn("fijo", F.last("fijo", ignorenulls=True).over(so_far))
        .drop("fuera", "dentro")
        .withColumns({f"antes{s}": before[s] for s in starts})
        .withColumn("comillas", F.contains("texto", F.lit('"')).cast("int"))
        .withColumns({f"en_bloque{s}": F.sum(head[s]).over(so_far) for s in starts} | {"citas_hasta": F.sum("comillas").over(so_far)})
    )
    # Written once: the splits, the check and the records all come from it.
    states = stored(lines.sparkSession, states, "lineas-unidas")

    # The same composition over splits gives the state in which each split starts.
    by_split = W.partitionBy("archivo_no").orderBy("bloque")
    earlier = by_split.rowsBetween(W.unboundedPreceding, -1)
    ends = F.struct("fijo", "giros", *[f"en_bloque{s}" for s in starts], "citas_hasta")
    splits = (
        states.groupBy("archivo_no", "bloque")
        .agg(F.max_by(ends, F.struct("linea_id", "parte")).alias("fin"))
        .select("archivo_no", "bloque", "fin.*")
        .withColumn("total", F.sum("giros").over(by_split.rowsBetween(W.unboundedPreceding, W.currentRow)))
        .withColumn("ancla", F.col("fijo").bitwiseXOR(F.col("giros") % 2).bitwiseXOR(F.col("total") % 2))
        .withColumn("previa", F.coalesce(F.last("ancla", ignorenulls=True).over(earlier), F.lit(0)))
        .withColumn("inicio", F.col("previa").bitwiseXOR((F.col("total") - F.col("giros")) % 2))
        .withColumn("cabezas", F.when(F.col("inicio") == 1, F.col("en_bloque1")).otherwise(F.col("en_bloque0")))
        .select(
            "archivo_no", "bloque", "inicio", F.coalesce(F.sum("cabezas").over(earlier), F.lit(0)).alias("anteriores"),
            F.coalesce(F.sum("citas_hasta").over(earlier), F.lit(0)).alias("citas_antes"),
        )
    )
    # A row per split, written so that its size is known: the lines are not shuffled to meet it.
    splits = stored(lines.sparkSession, splits, "cortes")
    chosen = [F.when(F.col("inicio") == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0")).alias(name) for name in ("antes", "en_bloque")]
    placed = (
        states.join(splits, ["archivo_no", "bloque"])
        .select(*parts.columns, "comillas", "citas_hasta", "anteriores", "citas_antes", *chosen)
        # Blank lines count for nothing between records, but belong to a quoted field.
        .where((F.col("antes") == 1) | (F.col("texto") != ""))
    )
    _check_open_quotes(placed)
    piece = F.struct("bloque", "linea_id", "parte", "texto")
    return (
        placed
        .groupBy("archivo_no", (F.col("anteriores") + F.col("en_bloque")).alias("registro"))
        .agg(F.sort_array(F.collect_list(piece)).alias("piezas"))
        .where("registro > 1")  # the first record is the header
        .select(
            "archivo_no",
            F.col("piezas")[0]["bloque"].alias("bloque"),
            F.col("piezas")[0]["linea_id"].alias("linea_id"),
            F.col("piezas")[0]["parte"].alias("parte"),
            "registro",
            F.array_join(F.col("piezas.texto"), "\n").alias("texto"),
        )
    )


def _check_open_quotes(heads: DataFrame) -> None:
    """Stop the load when lines without a quote, all inside one quoted field, are longer than a field may be.

    Only lengths are added up, so a file whose quote stays open to its end is found before any record is put together.
    """
    inside = (F.col("antes") == 1) & (F.col("comillas") == 0)
    runs = (
        heads.where(inside)
        .groupBy("archivo", (F.col("citas_antes") + F.col("citas_hasta")).alias("corrida"))
        .agg(F.sum(F.length("texto") + 1).alias("largo"), F.min(F.col("anteriores") + F.col("en_bloque")).alias("registro"))
    )
    found = runs.where(F.col("largo") > FIELD_LIMIT).orderBy("archivo", "registro").limit(1).collect()
    if found:
        raise ValueError(_too_long(found[0].archivo, found[0].registro))


def _too_long(file: str, record: int) -> str:
    return f"campo de más de {FIELD_LIMIT} caracteres (¿comillas sin cerrar?) en {file}, registro {record}"


def _within_limit(text: Column, count: int) -> Column:
    """``text`` of a record of up to ``count`` fields; one with a field over the limit stops the load. Only long records are
    looked into."""
    record = F.from_csv(text, ", ".join(f"_{i} string" for i in range(count)), {"escape": '"', "maxCharsPerColumn": "-1"})
    longest = F.greatest(F.lit(0), *[F.coalesce(F.length(record[f"_{i}"]), F.lit(0)) for i in range(count)])
    start = F.left(text, F.lit(60))
    stop = F.raise_error(F.concat(F.lit(f"campo de más de {FIELD_LIMIT} caracteres en el registro que empieza con: "), start))
    return F.when(F.length(text) <= FIELD_LIMIT, text).when(longest <= FIELD_LIMIT, text).otherwise(stop.cast("string"))


def scan(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Raw records of landed CSV files: :data:`POSITION`, ``registro`` and the required text columns.

    Where no field runs over a line end, which one look at the line kinds tells, each line is a record and
    nothing is shuffled. Only files with such fields have their lines put together first; there the record
    number is known at once, otherwise ``registro`` stays NULL until :func:`number_records` fills it.

    Headers were landed with ``files``. Records are parsed by position, once; files that spell their headers differently
    have their positions joined in, so the plan is the same for two spellings or a million.
    """
    mapped = column_map(files)
    check_headers(lines, mapped)
    seen = mapped.agg(
        F.count("*").alias("n"), F.min("ancho").alias("narrow"), F.max("ancho").alias("width"),
        F.min("lugares").alias("least"), F.max("lugares").alias("most"),
    ).first()
    joined = lines.where(F.col("clase") == JOINED).select("archivo_no").distinct()
    any_joined = not joined.isEmpty()

    plain = lines.where(F.col("clase") == PLAIN)
    if any_joined:
        plain = plain.join(broadcast_if_few(joined, seen.n), "archivo_no", "left_anti")
    first = mapped.select("archivo_no", F.col("primera").alias("linea_id"))
    plain = plain.join(broadcast_if_few(first, seen.n), ["archivo_no", "linea_id"], "left_anti")
    records = plain.select(
        "archivo_no", "bloque", "linea_id", F.lit(0).alias("parte"),
        F.lit(None).cast("bigint").alias("registro"), without_return(F.col("contenido")).alias("texto"),
    )
    if any_joined:
        together = lines.join(broadcast_if_few(joined, seen.n), "archivo_no", "left_semi")
        records = records.unionByName(_joined_records(together))
    # Short records are padded with NULL, fields beyond the header are dropped.
    record = F.from_csv("texto", ", ".join(f"_{i} string" for i in range(1, seen.width + 1)), {"escape": '"'}).alias("_registro")
    checked = _within_limit(F.validate_utf8("texto"), seen.width)
    if (seen.narrow, seen.least) == (seen.width, seen.most):
        fields = [F.col(f"_registro._{place}").alias(name) for name, place in zip(COLUMNS, seen.least, strict=True)]
        return records.withColumn("texto", checked).select(*POSITION, "registro", record).select(*POSITION, "registro", *fields)
    own = mapped.select("archivo_no", "ancho", "lugares")
    found = records.join(broadcast_if_few(own, seen.n), "archivo_no").withColumn("texto", _padded(checked, seen.width))
    every = F.array(*[F.col(f"_registro._{i}") for i in range(1, seen.width + 1)])
    return (
        found.select(*POSITION, "registro", "lugares", record)
        .select(*POSITION, "registro", "lugares", every.alias("_todos"))
        .select(*POSITION, "registro", *[F.element_at("_todos", F.col("lugares")[i]).alias(name) for i, name in enumerate(COLUMNS)])
    )


def number_records(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Fill ``registro``: the record's number in its file, counting the header and skipping blank lines.

    Meant for the rejected rows. It adds the lines of earlier splits (one row per split) to the place within
    the split, which the line id gives directly; only blank lines are counted one by one.
    """
    splits = lines.groupBy("archivo_no", "bloque").agg(
        F.min("linea_id").alias("primera"),
        F.sum(F.when(F.col("clase") == BLANK, 0).otherwise(1)).alias("llenas"),
    )
    earlier = W.partitionBy("archivo_no").orderBy("bloque").rowsBetween(W.unboundedPreceding, -1)
    starts = splits.select(
        "archivo_no", "bloque", "primera", F.coalesce(F.sum("llenas").over(earlier), F.lit(0)).alias("anteriores")
    )
    blanks = lines.where(F.col("clase") == BLANK).select(
        "archivo_no", "bloque", "linea_id", F.lit(0).alias("parte"), F.lit(1).alias("vacia")
    )
    so_far = W.partitionBy("archivo_no", "bloque").orderBy("linea_id", "parte")
    place = F.col("anteriores") + F.col("linea_id") - F.col("primera") + 1 - F.col("vacias")
    return (
        rows.withColumn("vacia", F.lit(0))
        .unionByName(blanks, allowMissingColumns=True)
        .withColumn("vacias", F.sum("vacia").over(so_far))
        .where("vacia = 0")
        .join(starts, ["archivo_no", "bloque"])
        .withColumn("registro", F.coalesce("registro", place))
        .drop("vacia", "vacias", "primera", "anteriores")
    )


# --- validation ---------------------------------------------------------------------------------

# The order in which fields are checked; the first failing one gives the reason.
CHECK_ORDER = ("folio", "producto_id", "cantidad", "precio_unitario", "fecha", "canal")


def classify(raw: DataFrame) -> DataFrame:
    """Typed columns, ``falla`` (the first field that fails, NULL for a good record) and, for bad records only,
    ``crudo`` with the raw fields; other columns stay. Typed values of bad records are NULL."""
    others = [name for name in raw.columns if name not in COLUMNS]
    cut = raw.select(
        *others,
        F.struct(*COLUMNS).alias("_crudo"),
        *[c.stripped(F.col(name)).alias(name) for name in COLUMNS],
    )
    # Reading, typing and judging are generated as methods of their own; as one they outgrow what the JIT compiles.
    typed = evaluated_once(cut).select(
        *others,
        "_crudo",
        F.nullif("folio", F.lit("")).alias("folio"),
        c.day(F.col("fecha")).alias("fecha"),
        c.positive_int(F.col("producto_id")).alias("producto_id"),
        c.positive_int(F.col("cantidad")).alias("cantidad"),
        c.money(c.amount_text(F.col("precio_unitario"))).alias("precio_unitario"),
        c.channel(F.col("canal")).alias("canal"),
    )
    typed = evaluated_once(typed)
    passes = {name: F.col(name) > 0 for name in ("producto_id", "cantidad", "precio_unitario")}
    fails = [
        F.when(~F.coalesce(passes.get(name, F.col(name).isNotNull()), F.lit(False)), F.lit(name))
        for name in CHECK_ORDER
    ]
    judged = typed.withColumn("falla", F.coalesce(*fails))
    good = F.col("falla").isNull()
    return judged.select(
        *others, *[F.when(good, F.col(name)).alias(name) for name in COLUMNS],
        "falla", F.when(~good, F.col("_crudo")).alias("crudo"),
    )


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where("falla IS NULL").drop("falla", "crudo")


def rejected(classified: DataFrame) -> DataFrame:
    """Bad records: position, raw fields and ``motivo``. A valid value that does not fit stops the load."""
    others = [name for name in classified.columns if name not in (*COLUMNS, "falla", "crudo")]
    failed = classified.where("falla IS NOT NULL").select(
        *others, "falla", "crudo.*",
        *[c.stripped(F.col(f"crudo.{name}")).alias(f"_{name}") for name in COLUMNS],
    ).withColumn("_monto", c.amount_text(F.col("_precio_unitario")))
    text = {name: F.col(f"_{name}") for name in COLUMNS}
    price = F.coalesce(
        c.text_error(text["precio_unitario"], "precio_unitario"),
        c.money_error(F.col("_monto"), "precio_unitario", c.quoted(F.col("precio_unitario"))),
    )
    reasons = {
        "folio": c.text_error(text["folio"], "folio"),
        "producto_id": c.positive_int_error(text["producto_id"], "producto_id"),
        "cantidad": c.positive_int_error(text["cantidad"], "cantidad"),
        "precio_unitario": price,
        "fecha": c.day_error(text["fecha"], "fecha"),
        "canal": c.channel_error(text["canal"], "canal", c.quoted(F.col("canal"))),
    }
    reason = F.coalesce(*[F.when(F.col("falla") == name, reasons[name]) for name in CHECK_ORDER])
    shown = F.concat_ws(", ", *COLUMNS)
    return failed.select(*others, *COLUMNS, c.must_fit(reason, shown).alias("motivo"))
