"""Strict casts: a value converts exactly, or the result is null.

All of it is built-in SQL expressions, so a conversion stays inside whole-stage code
generation.  Spark's own ``try_cast`` is laxer than the rules here (it trims blanks, takes
``inf``, ``yes`` or ``2022``), so each text rule adds a guard to it.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import types as T

from dockhand.errors import SpecError
from dockhand.functions.sql import sql_literal, sql_type

# The text forms each target type accepts.  They end in \z, as $ would
# let a final line break pass.
INTEGER = r"^[+-]?[0-9]+\z"
INTEGER_ANY_SCRIPT = r"^[+-]?\p{Nd}+\z"
DECIMAL = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)\z"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?)?\z"

# How text with a non-finite value must begin.  A numeral is one out of
# range; of the words Spark knows, only these two spellings are numbers.
NON_FINITE = r"^[\x00-\x20]*[+-]?(NaN|Infinity|[0-9.])"

# Digits of other scripts, and the digits they stand for, in the same order.
OTHER_DIGITS = "".join(chr(c) for c in range(0x80, 0x10000) if unicodedata.category(chr(c)) == "Nd")
PLAIN_DIGITS = "".join(str(unicodedata.decimal(c)) for c in OTHER_DIGITS)

_WIDTH = {T.ByteType(): 1, T.ShortType(): 2, T.IntegerType(): 4, T.LongType(): 8}
_FLOATING = (T.FloatType(), T.DoubleType())
_MOMENTS = (T.DateType(), T.TimestampType(), T.TimestampNTZType())
_LOADABLE = (
    T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
    T.BinaryType, T.NullType,
)


def check_pair(name: str, source: T.DataType, target: T.DataType) -> None:
    """Raise when no value of the input type could become the declared type."""
    if not isinstance(source, _LOADABLE):
        raise SpecError(f"column {name}: values of type {source.simpleString()} cannot be loaded")
    if isinstance(source, T.BinaryType) and not isinstance(target, T.BinaryType):
        raise SpecError(f"column {name}: binary values cannot become {target.simpleString()}")


def can_fail(source: T.DataType, target: T.DataType) -> bool:
    """Whether a non-null value of ``source`` may have no ``target`` value."""
    if isinstance(source, T.NullType) or isinstance(target, (T.StringType, T.BinaryType)):
        return False
    return source != target and not _never_fails(source, target)


def _never_fails(source: T.DataType, target: T.DataType) -> bool:
    """Casts between other types that always give a value."""
    if source in _WIDTH and target in _WIDTH:
        return _WIDTH[source] <= _WIDTH[target]
    if target in _FLOATING:
        return source in _WIDTH or isinstance(source, T.DecimalType)
    return isinstance(target, (T.DateType, T.TimestampType)) and source in _MOMENTS


def attempt(value: str, source: T.DataType, target: T.DataType) -> str:
    """First half of a strict cast: ``value`` as ``target`` under Spark's or stricter rules.

    Casting in two halves lets a projection compute the attempt once and :func:`accept`
    look at it more than once.
    """
    kind = sql_type(target)
    text = _text(value, source)
    if isinstance(source, T.NullType):
        return f"CAST({value} AS {kind})"
    if isinstance(target, T.TimestampType):
        moment = _cast(value, source, target) if source in _MOMENTS else text_to_timestamp(text)
        return f"date_trunc('MILLISECOND', {moment})"
    if not can_fail(source, target):
        return _cast(value, source, target)
    if target in _WIDTH or target in _FLOATING:
        return f"try_cast({value if source in _WIDTH else text} AS {kind})"
    if isinstance(target, T.BooleanType):
        return text_to_boolean(text)
    if isinstance(target, T.DateType):
        return text_to_date(text)
    if isinstance(target, T.DecimalType):
        if isinstance(source, T.NumericType) and source not in _FLOATING:
            return f"try_cast({value} AS {kind})"
        return f"CASE WHEN {_matches(text, DECIMAL)} THEN try_cast({text} AS {kind}) END"
    raise SpecError(f"no conversion to {target.simpleString()}")


def accept(value: str, tried: str, source: T.DataType, target: T.DataType) -> str:
    """Second half of a strict cast: the attempt, or null where Spark was too lax."""
    if not can_fail(source, target):
        return tried
    if target in _WIDTH and source not in _WIDTH:
        return accept_integer(_text(value, source), tried, target)
    if target in _FLOATING:
        return accept_floating(_text(value, source), tried)
    return tried


def strict_cast(value: str, source: T.DataType, target: T.DataType) -> str:
    """``value`` as ``target``, null where it is null or does not convert."""
    return accept(value, attempt(value, source, target), source, target)


def accept_integer(text: str, number: str, target: T.DataType) -> str:
    """Decimal digits with an optional sign and nothing else, in the target's range.

    Text that prints back as itself is already in that form, which spares most values
    the regular expression.  Digits of other scripts count as digits too; they are only
    looked at where the plain form failed.
    """
    digits = f"translate({text}, {sql_literal(OTHER_DIGITS)}, {sql_literal(PLAIN_DIGITS)})"
    return (
        f"CASE WHEN CAST({number} AS STRING) = {text} OR {_matches(text, INTEGER)} THEN {number}"
        f" WHEN {_matches(text, INTEGER_ANY_SCRIPT)} THEN try_cast({digits} AS {sql_type(target)}) END"
    )


def accept_floating(text: str, number: str) -> str:
    """Numbers as Java prints or reads them; only non-finite results need a second look."""
    finite = f"abs({number}) < CAST('Infinity' AS DOUBLE)"
    return f"CASE WHEN {finite} OR {_matches(text, NON_FINITE)} THEN {number} END"


def text_to_boolean(text: str) -> str:
    """``true`` or ``false`` in any letter case."""
    return f"CASE lower({text}) WHEN 'true' THEN true WHEN 'false' THEN false END"


def text_to_date(text: str) -> str:
    """``yyyy-MM-dd``, or the day of ``yyyy-MM-dd HH:mm:ss[.f]``."""
    return (
        f"CASE WHEN {_matches(text, DATE)} THEN try_cast({text} AS date)"
        f" WHEN {_matches(text, TIMESTAMP)} THEN CAST(try_cast({text} AS timestamp_ntz) AS date) END"
    )


def text_to_timestamp(text: str) -> str:
    """``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss[.f]``."""
    return f"CASE WHEN {_matches(text, TIMESTAMP)} THEN try_cast({text} AS timestamp_ltz) END"


def _text(value: str, source: T.DataType) -> str:
    return value if isinstance(source, T.StringType) else f"CAST({value} AS STRING)"


def _cast(value: str, source: T.DataType, target: T.DataType) -> str:
    return value if source == target else f"CAST({value} AS {sql_type(target)})"


def _matches(text: str, pattern: str) -> str:
    return f"{text} RLIKE {sql_literal(pattern)}"
