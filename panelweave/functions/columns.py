"""Column expressions for cleaning, recoding and deriving survey variables.

All are built-in Spark expressions. Null is the only missing marker.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelweave.fixed_values import MISSING_CODES

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Tables have many columns, so expressions applied to all of them are SQL text:
# one call to the JVM per column instead of one per literal.


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def number_sql(name: str) -> str:
    return f"CASE WHEN {quoted(name)} RLIKE r'{NUMBER}' THEN TRY_CAST({quoted(name)} AS DOUBLE) END"


def without_codes_sql(value: str, codes: Iterable[float] = MISSING_CODES) -> str:
    """The value, null for a code. A run of whole numbers becomes a range test, which is shorter code."""
    low, high = min(codes), max(codes)
    if sorted(codes) == list(range(int(low), int(high) + 1)):
        coded = f"{value} BETWEEN {float(low)}D AND {float(high)}D AND {value} = rint({value})"
    else:
        coded = f"{value} IN ({', '.join(f'{float(c)}D' for c in codes)})"
    return f"CASE WHEN NOT ({coded}) THEN {value} END"


def numeric(name: str) -> Column:
    """Text column to double; anything that is not a plain number becomes null.

    The pattern is needed because a cast alone accepts ``5d`` and ``nan``.
    """
    return F.expr(number_sql(name))


def without_codes(name: str, codes: Iterable[float] = MISSING_CODES) -> Column:
    """Numeric column as double, missing-answer codes as null."""
    return F.expr(without_codes_sql(f"CAST({quoted(name)} AS DOUBLE)", codes))


def clean(name: str, text: bool = True) -> Column:
    """Text or numeric answers to double; missing-answer codes and NaN as null."""
    value = number_sql(name) if text else f"nanvl(CAST({quoted(name)} AS DOUBLE), NULL)"
    return F.expr(without_codes_sql(value))


def whole_number_sql(name: str) -> str:
    return f"coalesce(TRY_CAST({quoted(name)} AS BIGINT), CAST({number_sql(name)} AS BIGINT))"


def whole_number(name: str) -> Column:
    """Column as whole numbers, also when written as ``12.0``; anything that is not a number as null."""
    return F.expr(whole_number_sql(name))


def identifier(name: str) -> Column:
    """Whole-number id, also when written as ``12.0``; missing-answer codes as null."""
    return F.expr(without_codes_sql(whole_number_sql(name)))


def recode(value: Column, mapping: Mapping, unlisted: str = "keep") -> Column:
    """Replace values by one simultaneous mapping; ``None`` as new value gives null.

    ``unlisted`` says what happens to values outside the mapping: ``keep`` or ``null``.
    """
    branches = None
    for old, new in mapping.items():
        result = F.lit(None if new is None else float(new)).cast("double")
        branches = (F if branches is None else branches).when(value == float(old), result)
    if unlisted == "null":
        return branches if branches is not None else F.lit(None).cast("double")
    return value if branches is None else branches.otherwise(value.cast("double"))


def first_version(versions: Iterable[tuple[Column, Mapping | None]]) -> Column:
    """First non-null version of a question, each recoded on its own (unlisted codes are null)."""
    recoded = [c.cast("double") if m is None else recode(c, m, "null") for c, m in versions]
    return F.coalesce(*recoded) if recoded else F.lit(None).cast("double")


def category_of(name: str, categories: Iterable[tuple[int, Iterable[int]]]) -> Column:
    """Category id whose code list holds the column's value; null when no list does.

    The lists become two constant arrays, codes and the categories at the same
    places: no join, any code, and generated code stays short enough to be
    compiled. Values between whole numbers are no codes.
    """
    by_code = {int(code): int(category) for category, codes in categories for code in codes}
    if not by_code:
        return F.expr("CAST(NULL AS INT)")
    codes = ", ".join(f"{code}D" for code in by_code)
    found = ", ".join(map(str, by_code.values()))
    return F.expr(f"get(array({found}), CAST(array_position(array({codes}), CAST({quoted(name)} AS DOUBLE)) AS INT) - 1)")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, null unless the denominator is positive."""
    return numerator / F.when(denominator > 0, denominator)


def log_floored(value: Column, floor: float = 1.0) -> Column:
    """ln(max(value, floor)); null stays null (``greatest`` alone would skip it)."""
    return F.when(value.isNotNull(), F.ln(F.greatest(value, F.lit(floor))))


def flag(condition: Column, null_as_zero: bool = False) -> Column:
    """1.0 / 0.0 of a condition; null stays null unless it should count as 0."""
    return (F.coalesce(condition, F.lit(False)) if null_as_zero else condition).cast("double")


def label_of(code: Column, labels: Mapping[int, str]) -> Column:
    """Label of a code, null when unlisted."""
    branches = None
    for key, label in labels.items():
        branches = (F if branches is None else branches).when(code == float(key), F.lit(label))
    return branches if branches is not None else F.lit(None).cast("string")


def label_text(name: Column, labels: Mapping[str, str]) -> Column:
    """Label of a name, the name itself when unlisted."""
    branches = F
    for key, label in labels.items():
        branches = branches.when(name == key, F.lit(label))
    return branches.otherwise(name)


def stars(p_value: Column) -> Column:
    """Significance marks at 1, 5 and 10 percent."""
    return (
        F.when(p_value < 0.01, "***").when(p_value < 0.05, "**").when(p_value < 0.10, "*").otherwise("")
    )


def fixed(value: Column, digits: int) -> Column:
    """Number as text with fixed decimals, ties to even."""
    return F.call_function("format_number", value, F.lit("0." + "0" * digits if digits else "0"))


def percent_text(share: Column) -> Column:
    """Share as whole percent, ties to even."""
    return F.concat(fixed(share * 100, 0), F.lit("%"))
