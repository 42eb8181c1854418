"""Column expressions. All of them are built-in Spark functions and stay inside generated code."""

from funnelwright.functions.keys import deterministic_uuid, key_text, uuid5
from funnelwright.functions.parsing import parse_boolean, parse_date, parse_integer, parse_string, parse_timestamp
from funnelwright.functions.rates import percentage
from funnelwright.functions.text import collapse_whitespace, quoted, snake_case

__all__ = [
    "collapse_whitespace",
    "deterministic_uuid",
    "key_text",
    "parse_boolean",
    "parse_date",
    "parse_integer",
    "parse_string",
    "parse_timestamp",
    "percentage",
    "quoted",
    "snake_case",
    "uuid5",
]
