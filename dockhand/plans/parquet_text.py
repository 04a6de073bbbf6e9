"""Parquet message text as a Spark schema."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import types as T

from dockhand.errors import SpecError

# What a column of a physical type holds, without and with an annotation.
PLAIN: dict[str, T.DataType] = {
    "boolean": T.BooleanType(), "int32": T.IntegerType(), "int64": T.LongType(),
    "int96": T.TimestampType(), "float": T.FloatType(), "double": T.DoubleType(),
    "binary": T.BinaryType(), "fixed_len_byte_array": T.BinaryType(),
}
ANNOTATED: dict[tuple[str, str], T.DataType] = {
    ("int32", "INT_8"): T.ByteType(), ("int32", "INT_16"): T.ShortType(),
    ("int32", "INT_32"): T.IntegerType(), ("int64", "INT_64"): T.LongType(),
    ("int32", "INTEGER(8,TRUE)"): T.ByteType(), ("int32", "INTEGER(16,TRUE)"): T.ShortType(),
    ("int32", "INTEGER(32,TRUE)"): T.IntegerType(), ("int64", "INTEGER(64,TRUE)"): T.LongType(),
    ("int32", "DATE"): T.DateType(),
    ("int64", "TIMESTAMP_MILLIS"): T.TimestampType(), ("int64", "TIMESTAMP_MICROS"): T.TimestampType(),
    ("int64", "TIMESTAMP(MILLIS,TRUE)"): T.TimestampType(),
    ("int64", "TIMESTAMP(MICROS,TRUE)"): T.TimestampType(),
    ("binary", "UTF8"): T.StringType(), ("binary", "STRING"): T.StringType(),
    ("binary", "ENUM"): T.StringType(), ("binary", "JSON"): T.StringType(),
}
# Decimal digits that fit the physical types; those of bytes follow from their number.
DECIMAL_DIGITS = {"int32": 9, "int64": 18, "binary": 38}

REPETITIONS = ("required", "optional", "repeated")


class _Token(NamedTuple):
    text: str
    at: int


class _Text:
    """The words and signs of a message, one after the other."""

    def __init__(self, text: str) -> None:
        self._text = text
        self._tokens: Iterator[_Token] = (
            _Token(m[0], m.start()) for m in re.finditer(r"[^\s;{}(),=]+|[;{}(),=]", text)
        )
        self.next = self._advance()

    def _advance(self) -> _Token:
        return next(self._tokens, _Token("", len(self._text)))

    def wrong(self, why: str, token: _Token | None = None) -> SpecError:
        token = token or self.next
        before = self._text[:token.at]
        line, column = before.count("\n") + 1, token.at - before.rfind("\n")
        found = repr(token.text) if token.text else "the end"
        return SpecError(f"parquet schema, line {line}, column {column}, at {found}: {why}")

    def take(self) -> _Token:
        token, self.next = self.next, self._advance()
        return token

    def word(self, what: str) -> _Token:
        if not self.next.text or self.next.text in ";{}(),=":
            raise self.wrong(f"{what} is expected")
        return self.take()

    def sign(self, sign: str) -> None:
        if self.next.text != sign:
            raise self.wrong(f"{sign!r} is expected")
        self.take()

    def number(self, what: str) -> int:
        token = self.word(what)
        if not re.fullmatch(r"[0-9]+", token.text):
            raise self.wrong(f"{what} is expected", token)
        return int(token.text)


def parse_parquet_schema(text: str) -> T.StructType:
    """``message name { optional int32 a; required binary b (UTF8); ... }`` as a schema.

    Type names and annotations are read in any letter case.  A column is ``required`` when
    null in it is to be rejected.  Groups, repeated columns and types that a load has no
    values for are a :class:`SpecError` that tells where, as is anything the grammar lacks.
    """
    source = _Text(text)
    if source.next.text.lower() != "message":
        raise source.wrong("'message' is expected")
    source.take()
    source.word("the name of the message")
    source.sign("{")
    fields: list[T.StructField] = []
    names: set[str] = set()
    while source.next.text != "}":
        token, field = _column(source)
        if field.name.lower() in names:
            raise source.wrong("there is a column of this name already", token)
        names.add(field.name.lower())
        fields.append(field)
    if not fields:
        raise source.wrong("a column is expected")
    source.sign("}")
    if source.next.text:
        raise source.wrong("nothing is expected after the message")
    return T.StructType(fields)


def _column(source: _Text) -> tuple[_Token, T.StructField]:
    repetition = source.word("required, optional or repeated")
    if repetition.text.lower() not in REPETITIONS:
        raise source.wrong("required, optional or repeated is expected", repetition)
    if repetition.text.lower() == "repeated":
        raise source.wrong("repeated columns are not supported", repetition)
    kind = source.word("a type")
    physical = kind.text.lower()
    if physical == "group":
        raise source.wrong("groups are not supported", kind)
    if physical not in PLAIN:
        raise source.wrong(f"the type is none of {sorted(PLAIN)}", kind)
    length = None
    if physical == "fixed_len_byte_array":
        source.sign("(")
        length = source.number("a number of bytes")
        source.sign(")")
        if not length:
            raise source.wrong("a number of bytes above 0 is expected", kind)
    name = source.word("a column name")
    data_type = _logical(source, physical, length) if source.next.text == "(" else PLAIN[physical]
    if source.next.text == "=":
        source.take()
        source.number("a field id")
    source.sign(";")
    return name, T.StructField(name.text, data_type, repetition.text.lower() == "optional")


def _logical(source: _Text, physical: str, length: int | None) -> T.DataType:
    source.sign("(")
    token = source.word("an annotation")
    name, arguments = token.text.upper(), []
    if source.next.text == "(":
        source.take()
        arguments.append(source.word("an argument"))
        while source.next.text == ",":
            source.take()
            arguments.append(source.word("an argument"))
        source.sign(")")
    source.sign(")")
    if name == "DECIMAL":
        return _decimal(source, token, arguments, physical, length)
    if arguments:
        name += f"({','.join(a.text.upper() for a in arguments)})"
    try:
        return ANNOTATED[physical, name]
    except KeyError:
        raise source.wrong(f"{name} of {physical} is not supported", token) from None


def _decimal(
    source: _Text, token: _Token, arguments: list[_Token], physical: str, length: int | None
) -> T.DecimalType:
    if len(arguments) not in (1, 2) or not all(re.fullmatch(r"[0-9]+", a.text) for a in arguments):
        raise source.wrong("DECIMAL takes a precision and a scale", token)
    precision = int(arguments[0].text)
    scale = int(arguments[1].text) if len(arguments) == 2 else 0
    if length:  # the digits of the largest number of so many bytes, one bit of which is the sign
        most = min(38, len(str(2 ** (8 * length - 1) - 1)) - 1)
    elif physical in DECIMAL_DIGITS:
        most = DECIMAL_DIGITS[physical]
    else:
        raise source.wrong(f"DECIMAL of {physical} is not supported", token)
    if not 1 <= precision <= most:
        raise source.wrong(f"a precision from 1 to {most} fits the type", arguments[0])
    if scale > precision:
        raise source.wrong("the scale is above the precision", arguments[1])
    return T.DecimalType(precision, scale)
