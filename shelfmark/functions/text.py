"""Text expressions: value rendering, word splitting, word counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What Python's str.split() treats as white space; one or more end a word.
WORD_BREAK = r"(?U)[\s\x1c-\x1f]+"

# What Python's repr() escapes beyond quotes, backslash, \t, \n and \r.
UNPRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"

LIST_STYLES = ("repr", "flatten", "join")


def words(text: Column) -> Column:
    """Words of a string by the rules of ``str.split()``; null gives null."""
    return F.array_remove(F.split(text, WORD_BREAK), "")


def word_count(value: Column, dtype: T.DataType, strict: bool = False) -> Column:
    """Number of words, never null.

    For a list the counts of its elements are summed, which is the count over the
    elements joined by a space; null elements count 0. A plain string counts its words,
    or 0 with ``strict``. Any other type counts 0.
    """
    if isinstance(dtype, T.ArrayType):
        text = F.array_join(value, " ")
    elif isinstance(dtype, T.StringType) and not strict:
        text = value
    else:
        return F.lit(0)
    return F.coalesce(F.size(words(text)), F.lit(0))


def render_text(value: Column, dtype: T.DataType, list_style: str = "repr") -> Column:
    """Value as text. Null stays null.

    ``repr`` writes a list as Python's ``str(list)`` would, ``join`` puts a space between
    its elements, ``flatten`` returns the elements as an array of strings.
    """
    if list_style not in LIST_STYLES:
        raise ValueError(f"list_style must be one of {LIST_STYLES}, not {list_style!r}")
    if not isinstance(dtype, T.ArrayType):
        return _scalar_text(value, dtype)
    if list_style == "repr":
        return _list_repr(value, dtype.elementType)
    if isinstance(dtype.elementType, T.StringType):
        parts = value
    else:
        parts = F.transform(value, lambda e: render_text(e, dtype.elementType))
    return parts if list_style == "flatten" else F.array_join(parts, " ")


def is_truthy(value: Column, dtype: T.DataType) -> Column:
    """Python truthiness: null, "", [], 0 and False are false. Never null."""
    if isinstance(dtype, T.ArrayType):
        test = F.size(value) > 0
    elif isinstance(dtype, T.StringType):
        test = value != ""
    elif isinstance(dtype, T.BooleanType):
        test = value
    elif isinstance(dtype, T.NumericType):
        test = value != 0
    else:
        test = value.isNotNull()
    return F.coalesce(test, F.lit(False))


def _scalar_text(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, T.BooleanType):
        return F.initcap(value.cast("string"))
    if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        return _double_text(value.cast("double"))
    if isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.NullType)):
        return value.cast("string")
    raise TypeError(f"No text form for {dtype.simpleString()}")


def _double_text(value: Column) -> Column:
    """A double as Python prints it: the fewest digits that give the same number, with an
    exponent only below 1e-4 and from 1e16 on. (Subnormal numbers may get a digit more.)"""
    plain = value.cast("string")
    # Up to 15 digits are the fewest already; without an exponent they are written alike.
    alike = (F.length(plain) <= 16) & ~plain.rlike("[EaI]")
    size = F.abs(value)
    return (
        F.when(alike, plain)
        .when(F.isnan(value), "nan")
        .when(value == float("inf"), "inf")
        .when(value == float("-inf"), "-inf")
        .when((size >= 1e-4) & (size < 1e16), _with(_shortest(value), _without_exponent))
        .when(value.isNotNull(), _with(_shortest(value), _trim_mantissa))
    )


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _shortest(value: Column) -> Column:
    """Exponent form with 15 digits if they give the same number, else 16, else 17."""
    forms = [F.format_string(f"%.{n}e", value) for n in (14, 15)]
    # (A null is formatted as the text "null".)
    exact = [F.when(form.try_cast("double") == value, form) for form in forms]
    return F.coalesce(*exact, F.format_string("%.16e", value))


def _without_exponent(scientific: Column) -> Column:
    # 17 digits from 1e-4 on take 20 decimals at most.
    padded = scientific.try_cast("decimal(38, 20)").cast("string")
    return F.regexp_replace(padded, r"(\.\d+?)0*$", "$1")


def _trim_mantissa(scientific: Column) -> Column:
    return F.regexp_replace(scientific, r"\.?0*e", "e")


def _list_repr(value: Column, element: T.DataType) -> Column:
    if isinstance(element, T.StringType):
        form = _string_repr
    elif isinstance(element, T.ArrayType):
        def form(e: Column) -> Column:
            return _list_repr(e, element.elementType)
    else:
        def form(e: Column) -> Column:
            return _scalar_text(e, element)

    def in_full(items: Column) -> Column:
        parts = F.transform(items, lambda e: F.coalesce(form(e), F.lit("None")))
        return F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))

    if not isinstance(element, T.StringType):
        return in_full(value)

    def in_short(items: Column) -> Column:
        # Most lists need no escapes: one look at the whole list, a null showing as a quote.
        plain = _with(
            F.array_join(items, " ", "'"),
            lambda t: ~(t.contains("'") | t.contains("\\") | t.rlike(UNPRINTABLE)),
        )
        quoted = F.concat(F.lit("['"), F.array_join(items, "', '"), F.lit("']"))
        return F.when((F.size(items) > 0) & plain, quoted).otherwise(in_full(items))

    return _with(value, in_short)


def _string_repr(text: Column) -> Column:
    body = text
    # The backslash first, then the named escapes.
    for raw, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(raw), F.lit(escaped))
    body = F.when(body.rlike(UNPRINTABLE), _escape_unprintable(body)).otherwise(body)
    quote = F.lit("'")
    return F.when(
        text.contains("'") & ~text.contains('"'), F.concat(F.lit('"'), body, F.lit('"'))
    ).otherwise(F.concat(quote, F.replace(body, quote, F.lit("\\'")), quote))


def _escape_unprintable(text: Column) -> Column:
    def escape(char: Column) -> Column:
        code = F.ascii(char)
        form = (
            F.when(code < 0x100, F.format_string("\\x%02x", code))
            .when(code < 0x10000, F.format_string("\\u%04x", code))
            .otherwise(F.format_string("\\U%08x", code))
        )
        return F.when(char.rlike(UNPRINTABLE), form).otherwise(char)

    return F.array_join(F.transform(F.split(text, ""), escape), "")
