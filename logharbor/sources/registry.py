"""Parsers by log type; a parser turns raw lines into rows tagged with `reason`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from logharbor.sources.firewall import parse_firewall_lines
from logharbor.sources.json_logs import parse_json_lines

Parser = Callable[..., DataFrame]

_PARSERS: dict[str, Parser] = {
    "firewall": parse_firewall_lines,
    "json": lambda lines, as_of=None, **options: parse_json_lines(lines, **options),
}


def register_parser(log_type: str, parser: Parser) -> None:
    _PARSERS[log_type] = parser


def parser_for(log_type: str) -> Parser:
    if log_type not in _PARSERS:
        raise ValueError(f"Unsupported log type: {log_type}")
    return _PARSERS[log_type]
