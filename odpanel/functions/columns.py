"""Null-aware arithmetic, cell cleaning and typed-literal parsing.

Spark 4 runs with ANSI mode on: ``x / 0`` and a bad cast raise. The analysed
application relied on the non-ANSI behaviour (division by zero and bad casts
give NULL), so every division and parse here goes through ``try_*``.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Text that marks a suppressed or empty cell in the source grids.
SENTINELS = ["", "..", ".", "-"]
# Blank and control characters that surround a cell's or a label's text.
BLANK_CHARS = "".join(map(chr, range(33)))


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def trim_blanks(c) -> Column:
    """The text without leading and trailing blank and control characters."""
    return F.btrim(_c(c), F.lit(BLANK_CHARS))


def safe_div(num, den, positive_only: bool = False) -> Column:
    """``num / den`` or NULL when the denominator is 0 (or <= 0 if asked)."""
    num, den = _c(num), _c(den)
    q = F.try_divide(num, den)
    return F.when(den > 0, q) if positive_only else q


MEAN_TYPE = "decimal(25,8)"
WEIGHT_TYPE = "decimal(10,0)"


def exact_mean(value, weight=None) -> Column:
    """Mean of a double column; with ``weight``, each value counts so many
    times.

    Where every value is a decimal of at most 17 digits before and 8 after the
    point (and every weight below 1e10), the mean is taken from their exact
    sum, so that it does not hang on the order of summation. Where any is not
    - beyond that range, finer, NaN or infinite - it is the plain mean of the
    doubles, in which each value counts as it is. NULL values are left out."""
    v = _c(value).cast("double")
    d = v.try_cast(MEAN_TYPE)
    fits = F.coalesce(d.cast("double") == v, F.lit(False))
    if weight is None:
        total, n, plain = F.try_sum(d), F.count(v), F.avg(v)
    else:
        w = F.when(v.isNotNull(), _c(weight))
        part = w.try_cast(WEIGHT_TYPE)
        fits = fits & (part.isNotNull() | w.isNull())
        total, n = F.try_sum(d * part), F.sum(w)
        plain = F.try_divide(F.sum(v * w), n.cast("double"))
    whole = F.count_if(v.isNotNull() & ~fits) == 0
    return F.coalesce(F.when(whole, F.try_divide(total.cast("double"), n)), plain)


def null_strict_sum(cols) -> Column:
    """Sum of several columns; one NULL operand makes the result NULL."""
    return reduce(add, [_c(c) for c in cols])


def clean_cell(num="num", text="text") -> Column:
    """Numeric value of a grid cell.

    A numeric cell keeps its number; a text cell is trimmed, sentinel text
    gives NULL, anything else is parsed as a double (NULL when it does not
    parse). A cell with neither gives NULL.
    """
    t = trim_blanks(text)
    parsed = F.when(t.isin(*SENTINELS), F.lit(None).cast("double")).otherwise(
        t.try_cast("double"))
    return F.coalesce(_c(num), parsed)


def literal_text(raw) -> Column:
    """Strip the quoting of a typed literal: ``"text"`` and ``#date#`` lose
    their delimiters; other text is only trimmed."""
    s = trim_blanks(raw)
    quoted = s.startswith('"') & s.endswith('"') & (F.length(s) >= 2)
    hashed = s.startswith("#") & s.endswith("#") & (F.length(s) >= 2)
    inner = F.substring(s, F.lit(2), F.length(s) - 2)
    return F.when(quoted | hashed, inner).otherwise(s)


def literal_number(raw) -> Column:
    """Typed literal as a double: numbers parse, quoted text gives NULL."""
    return literal_text(raw).try_cast("double")


def literal_bool(raw) -> Column:
    """``#TRUE#`` / ``#FALSE#`` literal as a boolean (NULL otherwise)."""
    t = trim_blanks(raw)
    return F.when(t == "#TRUE#", F.lit(True)).when(t == "#FALSE#", F.lit(False))


def literal_date(raw) -> Column:
    """``#yyyy-mm-dd#`` literal as a date (NULL when it is not a date)."""
    return literal_text(raw).try_cast("date")


def year_prefix(c) -> Column:
    """First four characters of the value's text form, as an int (or NULL)."""
    return F.substring(_c(c).cast("string"), 1, 4).try_cast("int")


def blank_or_null(c: str, dtype, blanks=("", "..")) -> Column:
    """NULL-or-blank test that is valid for any column type under ANSI.

    Strings also count the ``blanks`` texts after trimming; other types can
    only be NULL (comparing them with text would raise a cast error).
    """
    if isinstance(dtype, StringType):
        return F.col(c).isNull() | F.trim(F.col(c)).isin(*blanks)
    return F.col(c).isNull()

