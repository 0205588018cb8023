"""Validation and normalisation of raw text fields.

Every rule comes in two parts. The plain function gives the typed value of *stripped* text by the cheapest
route, or NULL; that is all the usual record needs. The ``*_error`` function runs on the few records that lack
a value and gives the reject reason, or NULL when the text is valid but does not fit the declared column type;
that is no reject but stops the load (``must_fit``), whatever ``spark.sql.ansi.enabled`` says.

Keeping the two apart keeps the generated code of the usual case small enough for the JIT compiler.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space dropped at both ends of a field.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Sales channels by lower-case spelling.
CHANNELS = {"whatsapp": "WhatsApp", "tienda": "Tienda"}

INTEGER = r"^[+-]?[0-9]+(_[0-9]+)*$"
ABOVE_ZERO = r"^\+?[0_.]*[1-9]"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
LONG_NUMBER = r"^([+-]?[0-9]*\.[0-9]{17})([0-9]+)$"
NOT_FINITE = r"(?i)^[+-]?(inf|infinity|s?nan[0-9]*)$"
ISO_DAY = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-([0-9]{1,2}| [1-9])$"
SLASH_DAY = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$"


def stripped(raw: Column) -> Column:
    """``raw`` without white space at its ends; the full set is only tried on unusual end characters."""
    text = F.trim(raw)
    usual = F.left(text, F.lit(1)).between("!", "~") & F.right(text, F.lit(1)).between("!", "~")
    return F.when(usual, text).otherwise(F.btrim(raw, F.lit(WHITE_SPACE)))


# All decimal digits but the ASCII ones, by the rule that Unicode gives; they count like 0 to 9.
_ZEROS = [chr(code) for code in range(128, sys.maxunicode + 1) if unicodedata.decimal(chr(code), None) == 0]
OTHER_DIGITS = "".join(chr(ord(zero) + value) for zero in _ZEROS for value in range(10))


def ascii_digits(text: Column) -> Column:
    """``text`` with decimal digits of other scripts as 0 to 9; only tried where there is a character beyond ASCII."""
    beyond = F.octet_length(text) > F.char_length(text)
    return F.when(beyond, F.translate(text, OTHER_DIGITS, "0123456789" * len(_ZEROS))).otherwise(text)


def quoted(raw: Column) -> Column:
    """Text as shown in reject reasons: quoted, with control characters escaped."""
    shown = F.replace(raw, F.lit("\\"), F.lit("\\\\"))
    for char, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        shown = F.replace(shown, F.lit(char), F.lit(escape))
    both = F.contains(raw, F.lit("'")) & F.contains(raw, F.lit('"'))
    shown = F.when(both, F.replace(shown, F.lit("'"), F.lit("\\'"))).otherwise(shown)
    mark = F.when(F.contains(raw, F.lit("'")) & ~both, F.lit('"')).otherwise(F.lit("'"))
    return F.concat(mark, shown, mark)


def must_fit(reason: Column, shown: Column) -> Column:
    """The reason to reject a value; an error when there is none, so that the value is valid but too large
    (or rounds to nothing) for its column."""
    return F.coalesce(reason, F.raise_error(F.concat(F.lit("value does not fit its column: "), shown)))


# --- required text ------------------------------------------------------------------------------


def is_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def text_error(text: Column, field: str) -> Column:
    return F.when(is_blank(text), F.lit(f"{field} vacío"))


# --- positive integers --------------------------------------------------------------------------


def positive_int(text: Column) -> Column:
    """The number, underscores between digits allowed; NULL when it is none or does not fit an int."""
    text = ascii_digits(text)
    grouped = F.when(text.rlike(INTEGER), F.replace(text, F.lit("_"), F.lit("")).try_cast("int"))
    return F.coalesce(text.try_cast("int"), grouped)


def positive_int_error(text: Column, field: str) -> Column:
    plain = ascii_digits(text)
    digits = F.regexp_replace(F.regexp_replace(plain, "[_+]", ""), "^(-?)0+(?=[0-9])", "$1")
    number = F.when(digits == "-0", F.lit("0")).otherwise(digits)
    return (
        F.when(is_blank(text), F.lit(f"{field} vacío"))
        .when(~plain.rlike(INTEGER), F.concat(F.lit(f"{field} no es un número entero: "), quoted(text)))
        .when(~plain.rlike(ABOVE_ZERO), F.concat(F.lit(f"{field} debe ser mayor a 0: "), number))
    )


# --- money --------------------------------------------------------------------------------------


def amount_text(text: Column) -> Column:
    """Text of an amount without currency sign and digit grouping."""
    marked = reduce(Column.__or__, [F.contains(text, F.lit(mark)) for mark in "$,_"])
    bare = reduce(lambda kept, mark: F.replace(kept, F.lit(mark), F.lit("")), "$,_", text)
    return F.when(marked, stripped(bare)).otherwise(text)


def money(amount: Column) -> Column:
    """Amount with two places, ties to the even cent (``cast`` and ``round`` would go half up).

    With at most two places and no exponent there is nothing to round and the direct cast is exact. Of more than 17
    places the rest only tells whether the value lies above the 17th: one digit stands for it, so no tie appears or is
    lost. (With an exponent and more than 18 places the cast rounds to these first.)
    """
    amount = ascii_digits(amount)
    point = F.instr(amount, ".")
    exponent = F.contains(amount, F.lit("e")) | F.contains(amount, F.lit("E"))
    short = ((point == 0) | (F.length(amount) - point <= 2)) & ~exponent
    rest = F.when(F.regexp_extract(amount, LONG_NUMBER, 2).rlike("[1-9]"), F.lit("1")).otherwise(F.lit("0"))
    cut = F.when(amount.rlike(LONG_NUMBER), F.concat(F.regexp_extract(amount, LONG_NUMBER, 1), rest)).otherwise(amount)
    rounded = F.bround(cut.try_cast("decimal(38,18)"), 2).try_cast("decimal(10,2)")
    return F.when(short, amount.try_cast("decimal(10,2)")).otherwise(rounded)


def money_error(amount: Column, field: str, shown: Column) -> Column:
    """``shown`` is the raw value as it appears in the reason."""
    amount = ascii_digits(amount)
    return (
        F.when(F.coalesce(amount, F.lit("")) == "", F.concat(F.lit(f"{field} no es una cantidad: "), shown))
        .when(
            ~amount.rlike(NUMBER) & ~amount.rlike(NOT_FINITE),
            F.concat(F.lit(f"{field} no es una cantidad: "), shown),
        )
        .when(
            amount.rlike(NOT_FINITE) | ~amount.rlike(ABOVE_ZERO),
            F.concat(F.lit(f"{field} debe ser mayor a 0: "), shown),
        )
    )


# --- dates --------------------------------------------------------------------------------------


def day(text: Column) -> Column:
    """ISO or day/month/year text as a date, NULL when it is neither."""
    text = ascii_digits(text)
    iso = F.when(F.contains(text, F.lit("/")), F.regexp_replace(text, SLASH_DAY, "$3-$2-$1")).otherwise(text)
    return F.when(iso.rlike(ISO_DAY), F.replace(iso, F.lit(" "), F.lit("")).try_cast("date"))


def day_error(text: Column, field: str) -> Column:
    """Why a text that is no day is rejected."""
    return F.when(is_blank(text), F.lit(f"{field} vacío")).otherwise(
        F.concat(F.lit(f"{field} no es una fecha válida: "), quoted(text))
    )


def required_day(raw: Column, field: str) -> Column:
    """A day whose absence stops the load."""
    text = stripped(raw)
    return F.coalesce(day(text), F.raise_error(day_error(text, field)).cast("date"))


# --- channels -----------------------------------------------------------------------------------


def channel(text: Column) -> Column:
    spelling = F.lower(text)
    return F.coalesce(*[F.when(spelling == key, F.lit(label)) for key, label in CHANNELS.items()])


def channel_error(text: Column, field: str, shown: Column) -> Column:
    """Why a text that is no known channel is rejected."""
    return F.when(is_blank(text), F.lit(f"{field} vacío")).otherwise(
        F.concat(F.lit(f"{field} desconocido: "), shown)
    )


# --- measurements in API payloads ---------------------------------------------------------------


def measurement(raw: Column, target: str) -> Column:
    """Number from a payload, half up to the column's scale; anything else stops the load."""
    value = raw.try_cast("decimal(38,18)").try_cast(target)
    problem = F.raise_error(F.concat(F.lit(f"no {target}: "), raw)).cast(target)
    return F.when(raw.isNotNull(), F.coalesce(value, problem))
