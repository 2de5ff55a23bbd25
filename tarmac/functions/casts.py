"""Strict text-to-type casts that never lose a value silently.

They behave the same with ANSI mode on or off: a value that does not fit its
type fails the job and is named in the message.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.sqltext import column_name, text_literal
from tarmac.session import compile_wide_rows

# The words the extracts' usual reader takes for a missing cell.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

INTEGER_RANGES = {
    "tinyint": (-(2**7), 2**7 - 1),
    "smallint": (-(2**15), 2**15 - 1),
    "int": (-(2**31), 2**31 - 1),
}


def _present(name: str, na_tokens: Sequence[str]) -> str:
    """SQL test: the cell holds something and no missing-value word."""
    cell = column_name(name)
    if not na_tokens:
        return f"{cell} is not null"
    words = ", ".join(map(text_literal, na_tokens))
    return f"({cell} is not null and {cell} not in ({words}))"


def missing_to_null(name: str, na_tokens: Sequence[str] = NA_TOKENS) -> Column:
    """The text column, null where it holds one of the missing-value words."""
    cell = column_name(name)
    return F.expr(f"case when {_present(name, na_tokens)} then {cell} end").alias(name)


def _refused(name: str, dtype: str) -> str:
    return f"raise_error(concat('{name}: not a valid {dtype}: ', {column_name(name)}))"


def _suffixed(cell: str) -> str:
    """``1d`` and ``1f`` parse as floating numbers but are none here."""
    return "(" + " or ".join(f"endswith({cell}, '{letter}')" for letter in "dDfF") + ")"


def _first_try(name: str, dtype: str) -> str:
    """A plain cast that is right for nearly every cell; null where it gives no answer.

    A failing cast costs far more than a good one, so a cell with a decimal point is
    cast by what stands before it, if only zeros follow.
    """
    cell = column_name(name)
    if dtype == "float":
        return f"try_cast({cell} as float)"
    point = f"instr({cell}, '.')"
    zeros = f"translate(substr({cell}, {point} + 1), '0', '') = ''"
    return f"""case when {point} = 0 then try_cast({cell} as {dtype})
        when {zeros} then try_cast(substr({cell}, 1, {point} - 1) as {dtype}) end"""


def _judged(name: str, dtype: str, na_tokens: Sequence[str]) -> str:
    """The first try where it is good, else what the cell may also stand for, or an error.

    A floating number that is infinite, spelled so or by overflow, is refused.
    """
    cell, tried = column_name(name), column_name(f"_tried_{name}")
    present, refused = _present(name, na_tokens), _refused(name, dtype)
    if dtype == "float":
        finite = f"{tried} between -3.4028235e38D and 3.4028235e38D"
        return f"""case when {finite} and not {_suffixed(cell)} then {tried}
            when {present} then {refused} end"""
    low, high = INTEGER_RANGES[dtype]
    number = f"try_cast({cell} as double)"
    whole = f"{number} between {low} and {high} and rint({number}) = {number}"
    return f"""case when {tried} is not null then {tried}
        when {cell} is null then null
        when {whole} and not {_suffixed(cell)} then cast({number} as {dtype})
        when {present} then {refused} end"""


def _reads_as_number(word: str) -> bool:
    try:
        return float(word) == float(word)
    except ValueError:
        return False


def strict_casts(
    text: DataFrame,
    dtypes: Mapping[str, str],
    *extra: Column,
    na_tokens: Sequence[str] = NA_TOKENS,
) -> DataFrame:
    """The named all-text columns under their types, followed by ``extra``.

    Integers may be spelled ``0.00`` or ``0005``; ``1.5``, overflow and other
    text fail, and so does an infinite float, ``1e39`` or the word ``Infinity``.
    Each number is tried as its own type in a projection of its own and judged in
    the next: one plain cast for nearly every cell, and generated code that stays
    small enough to be compiled for a hundred columns. The expressions are SQL text
    because building as many column objects takes longer than a month's rows.
    """
    compile_wide_rows(text.sparkSession)
    if any(map(_reads_as_number, na_tokens)):
        text = text.withColumns({name: missing_to_null(name, na_tokens) for name in dtypes})
        na_tokens = ()
    numeric = [(name, dtype) for name, dtype in dtypes.items() if dtype != "string"]
    tried = text.selectExpr(
        "*",
        *[f"{_first_try(n, dtype)} as {column_name(f'_tried_{n}')}" for n, dtype in numeric],
    )
    typed = [
        missing_to_null(n, na_tokens)
        if dtype == "string"
        else F.expr(_judged(n, dtype, na_tokens)).alias(n)
        for n, dtype in dtypes.items()
    ]
    return tried.select(*typed, *extra)


def iso_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text to a date; other text fails the job."""
    failed = F.raise_error(F.concat(F.lit("not a yyyy-MM-dd date: "), text))
    parsed = F.try_to_date(text, "yyyy-MM-dd")
    return F.coalesce(parsed, F.when(text.isNotNull(), failed))
