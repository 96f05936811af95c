"""Text to pinned types, loudly: nothing becomes NULL because it did not parse.

The functions take and return SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import types as T

from lakeproof.functions.sqltext import literal

# A neutral literal per type, only there to make a guarded column non-nullable.
# Literals, not casts of text: a cast of text is nullable in the schema.
_NEUTRAL = {
    T.BooleanType: "false",
    T.FloatType: "0F",
    T.DoubleType: "0D",
    T.DecimalType: "0BD",
    T.DateType: "DATE '1970-01-01'",
    T.TimestampNTZType: "TIMESTAMP_NTZ '1970-01-01 00:00:00'",
    T.TimestampType: "TIMESTAMP '1970-01-01 00:00:00'",
    T.TimeType: "TIME '00:00:00'",
    T.StringType: "''",
}


def _exact(text: str, to: T.DecimalType) -> str:
    """Whether a number's text fits the scale: by its length, or by comparing wider."""
    plain = f"NOT contains({text}, 'E') AND NOT contains({text}, 'e')"
    short = f"{plain} AND (instr({text}, '.') = 0 OR length({text}) - instr({text}, '.') <= {to.scale})"
    widest = 38 - (to.precision - to.scale)
    same = f"try_cast({text} AS DECIMAL(38,{widest})) = try_cast({text} AS {to.simpleString()})"
    return f"({short}) OR {same}"


def _in_micros(text: str) -> str:
    """Whether a time has no digit but zero beyond the sixth of its fraction."""
    return f"NOT rlike({text}, '[.][0-9]{{6}}[0-9]*[1-9]')"


def parsed(text: str, to: T.DataType) -> str:
    """Cast text to ``to``; NULL where it is NULL or does not parse.

    Holds with ANSI mode on or off. Decimals must fit their scale and times
    their microseconds exactly, dates must be written in full, timestamps need
    a date and a time of day, bits are 0, 1, true or false, floating numbers
    are written in digits. ``text`` should be a column: it is repeated.
    """
    if isinstance(to, T.StringType):
        return text
    of = to.simpleString()
    typed = f"try_cast({text} AS {of})"
    if isinstance(to, T.DecimalType) and 38 - (to.precision - to.scale) > to.scale:
        typed = f"if({_exact(text, to)}, {typed}, NULL)"
    elif isinstance(to, T.DateType):
        typed = f"if(length(trim({text})) = 10, {typed}, NULL)"
    elif isinstance(to, (T.TimestampType, T.TimestampNTZType)):
        typed = f"if(length({text}) >= 16 AND {_in_micros(text)}, {typed}, NULL)"
    elif isinstance(to, T.TimeType):
        typed = f"if({_in_micros(text)}, {typed}, NULL)"
    elif isinstance(to, T.BooleanType):
        typed = f"if(lower({text}) IN ('0', '1', 'true', 'false'), {typed}, NULL)"
    elif isinstance(to, (T.FloatType, T.DoubleType)):
        typed = f"if(rlike({text}, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'), {typed}, NULL)"
    return typed


def strict_cast(text: str, to: T.DataType, label: str) -> str:
    """``parsed``, but what does not parse raises; NULL stays NULL."""
    if isinstance(to, T.StringType):
        return text
    of = to.simpleString()
    refused = f"CAST(raise_error(concat({literal(f'{label}: not a {of}: ')}, {text})) AS {of})"
    return f"coalesce({parsed(text, to)}, if({text} IS NULL, NULL, {refused}))"


def not_null(value: str, of: T.DataType, label: str) -> str:
    """Raise on NULL; the result is non-nullable in the schema.

    The neutral literal is never produced, the raise comes first.
    """
    kind = of.simpleString()
    refused = f"CAST(raise_error({literal(f'{label}: NULL in a NOT NULL column')}) AS {kind})"
    return f"coalesce({value}, {refused}, CAST({_NEUTRAL.get(type(of), '0')} AS {kind}))"
