"""Column expressions. All are Spark built-ins, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

#: Text that a cast to a whole number or to a decimal can take. A cast that fails raises inside the
#: task, which costs a hundred times one that succeeds, so other text is not tried.
WHOLE_TEXT = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"
DECIMAL_TEXT = (
    r"^[\x00-\x20]*[+-]?(\p{Nd}+\.?\p{Nd}*|\.\p{Nd}+)([eE][+-]?\p{Nd}+)?[\x00-\x20]*$"
)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """Backtick a column name so dots, quotes and backticks in sample names are literal."""
    return "`" + name.replace("`", "``") + "`"


def cpm(count: ColumnOrName, library_size: ColumnOrName) -> Column:
    """Counts per million. An empty library gives null instead of an ANSI division error."""
    return F.try_divide(_col(count), _col(library_size)) * F.lit(1e6)


def log2p1(x: ColumnOrName) -> Column:
    return F.log2(_col(x) + F.lit(1.0))


def log2fc(level: ColumnOrName, baseline: ColumnOrName) -> Column:
    """Fold change of two values that are already on the log2 scale."""
    return _col(level) - _col(baseline)


def absolute(x: ColumnOrName) -> Column:
    return F.abs(_col(x))


def _whole(x: ColumnOrName, to: str) -> Column:
    """Text to a whole number, truncating decimals; text that is no number becomes null.

    Plain integers take the first branch. The decimal detour runs only for what is left, such as
    ``12.9``, and accepts exponents: ``1e3`` is 1000. Values that are no text are cast as they are.
    """
    value, text = _col(x), _col(x).cast("string")
    other = ~F.startswith(F.typeof(value), F.lit("string"))
    plain = F.when(other | text.rlike(WHOLE_TEXT), value.try_cast(to))
    decimal = F.when(other | text.rlike(DECIMAL_TEXT), value.try_cast("decimal(38,18)"))
    return F.coalesce(plain, decimal.try_cast(to))


def to_int(x: ColumnOrName) -> Column:
    return _whole(x, "int")


def to_count(x: ColumnOrName) -> Column:
    return _whole(x, "bigint")


def element(array: ColumnOrName, index: int) -> Column:
    """Array element by position from 0; null past the end."""
    return F.get(_col(array), F.lit(index))
