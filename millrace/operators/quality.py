"""Column and schema checks."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numeric types, narrow to wide; a column may be written into a wider one.
_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_FLOATS = (T.FloatType(), T.DoubleType())


class SchemaMismatch(ValueError):
    """Columns do not fit; ``problems`` holds one text per column."""

    def __init__(self, problems: Iterable[str]):
        self.problems = list(problems)
        super().__init__("schema mismatch: " + "; ".join(self.problems))


def check_column_names(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """``df`` if its column names are exactly ``expected``, in any order and of any type."""
    expected, actual = set(expected), set(df.columns)
    if expected != actual:
        raise SchemaMismatch([f"expected columns {sorted(expected)}, got {sorted(actual)}"])
    return df


def fits_type(incoming: T.DataType, target: T.DataType) -> bool:
    """Equal types, or a cast that keeps every value."""
    if incoming == target:
        return True
    for family in (_INTEGERS, _FLOATS):
        if incoming in family and target in family:
            return family.index(incoming) <= family.index(target)
    return False


def schema_problems(
    incoming: T.StructType,
    target: T.StructType,
    allow_new: bool = False,
    allow_missing: bool = False,
    widen: bool = True,
) -> list[str]:
    """What keeps rows of ``incoming`` out of a table of ``target``; empty if nothing does.

    Order does not matter. Types must be equal, or with ``widen`` castable without loss. Whether a
    required column really holds nulls is for :func:`fit_to` to find: Spark reports every column
    read from a file as nullable.
    """
    have = {f.name: f for f in incoming}
    want = {f.name: f for f in target}
    problems = []
    for name, field in want.items():
        if name not in have and not (allow_missing and field.nullable):
            problems.append(f"{name}: missing")
    for name, field in have.items():
        if name not in want:
            if not allow_new:
                problems.append(f"{name}: not in the table")
            continue
        source, sink = field.dataType, want[name].dataType
        if not (fits_type(source, sink) if widen else source == sink):
            problems.append(f"{name}: {source.simpleString()} does not fit {sink.simpleString()}")
    return sorted(problems)


def with_required(schema: T.StructType, required: Iterable[str]) -> T.StructType:
    """The schema with exactly these columns required, whatever nullability the plan implies."""
    required = set(required)
    unknown = required - set(schema.names)
    if unknown:
        raise SchemaMismatch([f"{name}: required but missing" for name in sorted(unknown)])
    return T.StructType(
        [T.StructField(f.name, f.dataType, f.name not in required, f.metadata) for f in schema]
    )


def merged_schema(table: T.StructType, incoming: T.StructType) -> T.StructType:
    """The table's columns, then the new ones, which older rows lack and so are nullable."""
    known = set(table.names)
    new = [T.StructField(f.name, f.dataType, True) for f in incoming if f.name not in known]
    return T.StructType(list(table.fields) + new)


def fit_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``, in its order and types; absent columns are null.

    A null in a required column fails the job that computes the rows.
    """
    have = set(df.columns)

    def fitted(field: T.StructField):
        source = F.col(f"`{field.name}`") if field.name in have else F.lit(None)
        value = source.cast(field.dataType)
        if not field.nullable:
            refusal = F.raise_error(f"null in required column {field.name}").cast(field.dataType)
            value = F.coalesce(value, refusal)
        return value.alias(field.name)

    return df.select(*[fitted(field) for field in schema])


def schema_report(df: DataFrame, expected: T.StructType | None = None) -> DataFrame:
    """One row per column: type, number of rows and nulls, and what ``expected`` says against it.

    One aggregate over all columns, then a transposition of its single row.
    """
    wanted = {f.name: f for f in expected} if expected is not None else None
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"_{i}") for i, f in enumerate(df.schema)],
    )
    entries = []
    for i, field in enumerate(df.schema):
        kind = field.dataType.simpleString()
        nulls = F.col("_rows") - F.col(f"_{i}")
        if wanted is None:
            problem = F.lit(None).cast("string")
        elif field.name not in wanted:
            problem = F.lit("not expected")
        elif not fits_type(field.dataType, wanted[field.name].dataType):
            problem = F.lit(f"expected {wanted[field.name].dataType.simpleString()}")
        elif not wanted[field.name].nullable:
            problem = F.when(nulls > 0, F.lit("null in a required column"))
        else:
            problem = F.lit(None).cast("string")
        entries.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(kind).alias("column_type"),
                F.col("_rows").alias("rows"),
                nulls.alias("nulls"),
                problem.alias("problem"),
            )
        )
    for field in expected or []:
        if field.name not in df.columns:
            entries.append(
                F.struct(
                    F.lit(field.name).alias("column_name"),
                    F.lit(field.dataType.simpleString()).alias("column_type"),
                    F.col("_rows").alias("rows"),
                    F.col("_rows").alias("nulls"),
                    F.lit("missing").alias("problem"),
                )
            )
    return counts.select(F.inline(F.array(*entries)))


def outcome(job: Callable[[], object]) -> dict:
    """Run ``job``; its result, or the error text if it raised, with a status."""
    try:
        return {"status": "success", "result": job()}
    except Exception as error:  # every failure becomes a record
        return {"status": "failed", "error": str(error)}
