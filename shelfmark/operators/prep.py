"""Validation, projection and text combination of records."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import is_truthy, render_text

# Default columns and the separator between combined fields.
TEXT_COLUMNS = ("asin", "title", "description", "feature", "brand")
LABEL_COLUMN = "main_cat"
COMBINED_COLUMN = "combined_text"
SEPARATOR = " | "


def validate_input(
    df: DataFrame | None,
    text_columns: Sequence[str] | None = None,
    label_column: str = LABEL_COLUMN,
) -> None:
    """Raise ``ValueError`` for an absent or empty input, then for missing columns.

    Emptiness is a one-row probe; a stream cannot be probed and counts as non-empty.
    Names must match in case.
    """
    # Callers match the beginnings of both messages.
    if df is None or (not df.isStreaming and df.isEmpty()):
        raise ValueError("Input DataFrame is empty or None.")
    required = [*(text_columns or TEXT_COLUMNS), label_column]
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"Input DataFrame is missing required columns: {missing}")


def project_columns(
    df: DataFrame,
    text_columns: Sequence[str] | None = None,
    label_column: str = LABEL_COLUMN,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Keep the text columns, the label and ``keep``, in this order, where present.

    Rows are neither dropped nor filled.
    """
    wanted = dict.fromkeys([*(text_columns or TEXT_COLUMNS), label_column, *keep])
    return df.select(*[name for name in wanted if name in df.columns])


def combined(
    df: DataFrame,
    columns: Sequence[str],
    list_style: str = "repr",
    skip: str = "null",
    exclude: Collection[str] = (),
) -> Column:
    """The combined text of a row as an expression; see :func:`combine_text`."""
    if skip not in ("null", "falsy"):
        raise ValueError("skip must be 'null' or 'falsy'")
    parts = []
    for name in columns:
        if name in exclude or name not in df.columns:
            continue
        dtype = df.schema[name].dataType
        part = render_text(F.col(name), dtype, list_style)
        parts.append(part if skip == "null" else F.when(is_truthy(F.col(name), dtype), part))
    return F.concat_ws(SEPARATOR, *parts)


def combine_text(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    out: str = COMBINED_COLUMN,
    list_style: str = "repr",
    skip: str = "null",
    exclude: Collection[str] = (),
) -> DataFrame:
    """Add one text column made of several columns in the given order.

    ``skip="null"`` leaves out nulls only; ``skip="falsy"`` also leaves out "", [], 0 and
    False. A row without any part gets "". Columns that the input lacks are passed over.
    """
    text = combined(df, columns or TEXT_COLUMNS, list_style, skip, exclude)
    return df.withColumn(out, text)


def preprocess(
    df: DataFrame,
    text_columns: Sequence[str] | None = None,
    label_column: str = LABEL_COLUMN,
    out: str = COMBINED_COLUMN,
    list_style: str = "repr",
    skip: str = "null",
    keep: Sequence[str] = (),
    validate: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Validate, project, combine: ``(out, label, *keep)`` with one row per input row.

    ``partitions`` deals the validated rows out to so many, before the texts are made.
    """
    if validate:
        validate_input(df, text_columns, label_column)
    projected = project_columns(df, text_columns, label_column, keep)
    projected = projected.repartition(partitions) if partitions else projected
    names = dict.fromkeys([label_column, *keep])
    text = combined(projected, text_columns or TEXT_COLUMNS, list_style, skip)
    return projected.select(text.alias(out), *[n for n in names if n in projected.columns])


# Field types of a record declaration and the Spark types that satisfy them.
_ACCEPTED = {
    "str": (T.StringType,),
    "int": (T.IntegralType,),
    "float": (T.NumericType,),
    "bool": (T.BooleanType,),
    "list": (T.ArrayType,),
}
_DECLARED = {"str": "string", "int": "bigint", "float": "double", "bool": "boolean"}


def record_schema(schema: Mapping[str, str]) -> T.StructType:
    """``{field: type}`` as a ``StructType`` with all fields required."""
    fields = []
    for name, declared in schema.items():
        base, element = _parse_type(declared)
        if base == "list":
            dtype = T.ArrayType(_simple_type(element or "str"))
        else:
            dtype = _simple_type(base)
        fields.append(T.StructField(name, dtype, nullable=False))
    return T.StructType(fields)


def conform(
    df: DataFrame, schema: Mapping[str, str], corrupt_column: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split rows by a record declaration ``{field: type}``, every field required.

    Types are ``str``, ``int``, ``float``, ``bool`` and ``list``, with or without an
    element type. ``list[str]`` asks for a list of anything, ``List[str]`` also checks
    the elements. Returns the conforming rows,
    projected to the declared fields, and the other rows as they came with a
    ``reject_reason``. With ``corrupt_column``, lines the reader could not parse are
    rejected as malformed.
    """
    reason = _reason(df, schema, corrupt_column)
    fields = [name for name in schema if name in df.columns]
    valid = df.filter(reason == "").select(*fields)
    rejected = df.withColumn("reject_reason", reason).filter(F.col("reject_reason") != "")
    return valid, rejected


def conforming(
    df: DataFrame, schema: Mapping[str, str], corrupt_column: str | None = None
) -> DataFrame:
    """The rows that :func:`conform` finds valid, with all their columns."""
    return df.filter(_reason(df, schema, corrupt_column) == "")


#: Types that a JSON value shows, by declared type.
_SHOWN = {
    "str": "STRING",
    "int": "BIGINT",
    "float": r"BIGINT|DOUBLE|DECIMAL\(.*\)",
    "bool": "BOOLEAN",
    "list": "ARRAY<.*>",
}


def conform_lines(
    lines: DataFrame, schema: Mapping[str, str], line: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """:func:`conform` on JSON lines, each value judged by the type it has in its own line.

    A schema that is declared or inferred for the whole file casts a field that is sometimes a list and
    sometimes text; here every such line is rejected with its reason, and keeps its text. A line that isn't
    a JSON object with distinct names, null and blank lines included, is malformed. Whole numbers beyond 64 bits
    are no ``int``. Elements are checked as in :func:`conform`; a list whose unchecked elements can't be cast to
    their type comes as null. Narrow: a line is parsed once, nothing is shuffled.
    """
    record, reason = "_record", "reject_reason"
    parsed = lines.withColumn(record, F.try_parse_json(F.col(line)))
    whole = F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))
    problems = [_problem_in_line(_field(record, name, "variant"), name, d) for name, d in schema.items()]
    malformed = F.when(~whole, F.lit("malformed line"))
    judged = parsed.withColumn(reason, malformed.otherwise(F.concat_ws("; ", *problems)))
    fields = [
        _field(record, f.name, f.dataType.simpleString()).alias(f.name) for f in record_schema(schema).fields
    ]
    valid = judged.filter(F.col(reason) == "").select(*fields)
    return valid, judged.filter(F.col(reason) != "").drop(record)


def _field(record: str, name: str, kind: str) -> Column:
    if "'" in name:
        raise ValueError(f"A field of a line can't be called {name!r}.")
    return F.try_variant_get(F.col(record), f"$['{name}']", kind)


def _problem_in_line(value: Column, name: str, declared: str) -> Column:
    """Why a value of a line does not conform, or null."""
    base, element = _parse_type(declared)

    def shows(v: Column, kind: str) -> Column:
        return F.coalesce(F.schema_of_variant(v).rlike(f"^({_SHOWN[kind]})$"), F.lit(False))

    wrong = F.lit(f"{name}: not {declared}")
    problem = F.when(value.isNull(), F.lit(f"{name}: missing")).when(
        F.is_variant_null(value), F.lit(f"{name}: null")
    )
    problem = problem.when(~shows(value, base), wrong)
    if declared.startswith("List") and element:
        elements = F.try_variant_get(value, "$", "array<variant>")
        problem = problem.when(F.exists(elements, lambda e: ~shows(e, element)), wrong)
    return problem


def _reason(df: DataFrame, schema: Mapping[str, str], corrupt_column: str | None) -> Column:
    problems = [_problem(df, name, declared) for name, declared in schema.items()]
    if corrupt_column and corrupt_column in df.columns:
        malformed = F.when(F.col(corrupt_column).isNotNull(), F.lit("malformed line"))
        problems.insert(0, malformed)
    return F.concat_ws("; ", *problems)


def _parse_type(declared: str) -> tuple[str, str | None]:
    base, _, element = declared.partition("[")
    base = base.strip().lower()
    if base not in _ACCEPTED:
        raise ValueError(f"Unknown field type: {declared!r}")
    return base, element.rstrip("] ").strip() or None


def _simple_type(name: str) -> T.DataType:
    if name not in _DECLARED:
        raise ValueError(f"Unknown field type: {name!r}")
    return T.DataType.fromDDL(_DECLARED[name])


def _problem(df: DataFrame, name: str, declared: str) -> Column:
    """Why a field of a row does not conform, or null."""
    base, element = _parse_type(declared)
    if name not in df.columns:
        return F.lit(f"{name}: missing")
    dtype, value = df.schema[name].dataType, F.col(name)
    problem = F.when(value.isNull(), F.lit(f"{name}: null"))
    wrong = F.lit(f"{name}: not {declared}")
    if not isinstance(dtype, _ACCEPTED[base]):
        return problem.otherwise(wrong)
    if declared.startswith("List") and element:
        if not isinstance(dtype.elementType, _ACCEPTED[element]):
            return problem.when(F.size(value) > 0, wrong)
        return problem.when(F.exists(value, lambda e: e.isNull()), wrong)
    return problem
