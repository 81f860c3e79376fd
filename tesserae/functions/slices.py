"""Barcode expressions: slices of reads, their reversal and concatenation, parsed into Columns (never evaluated as code).

    expression := term ('+' term)*
    term       := name slice* | quoted string
    slice      := '[' [int] ':' [int] [':' '-1'] ']'  |  '[' int ']'
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = re.compile(r"\s*(?:(?P<name>[A-Za-z_]\w*)|(?P<text>\"[^\"]*\"|'[^']*')|(?P<sign>[\[\]:+])|(?P<int>-?\d+))")


class SliceError(ValueError):
    pass


def _tokens(expression: str) -> list[tuple[str, str]]:
    out, at = [], 0
    expression = expression.rstrip()
    while at < len(expression):
        m = TOKEN.match(expression, at)
        if not m:
            raise SliceError(f"{expression!r}: unexpected {expression[at:]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return [*out, ("end", "")]


def _part(seq: Column, start: int | None, stop: int | None, backwards: bool) -> Column:
    n = F.length(seq)
    if backwards:
        return _part(F.reverse(seq), None if start is None else -start - 1, None if stop is None else -stop - 1, False)
    edge = lambda i, default: F.lit(default) if i is None else F.lit(i) if i >= 0 else F.greatest(n + i, F.lit(0))
    low = edge(start, 0)
    high = n if stop is None else edge(stop, 0)
    return F.substr(seq, low + 1, F.greatest(high - low, F.lit(0)))


def parse_slices(expression: str, columns: dict[str, Column]) -> Column:
    """The Column of a barcode expression over the named columns."""
    tokens = _tokens(expression)
    at = 0

    def take(kind: str, value: str | None = None, must: bool = False) -> str | None:
        nonlocal at
        if tokens[at][0] == kind and value in (None, tokens[at][1]):
            at += 1
            return tokens[at - 1][1]
        if must:
            raise SliceError(f"{expression!r}: expected {value or kind}, found {tokens[at][1]!r}")
        return None

    def term() -> Column:
        text = take("text")
        if text is not None:
            return F.lit(text[1:-1])
        name = take("name", must=True)
        if name not in columns:
            raise SliceError(f"{expression!r}: no column {name}; there are {sorted(columns)}")
        seq = columns[name]
        while take("sign", "["):
            start = take("int")
            if not take("sign", ":"):
                if start is None:
                    raise SliceError(f"{expression!r}: empty slice")
                take("sign", "]", must=True)
                i = int(start)
                seq = _part(seq, i, i + 1 if i != -1 else None, False)
                continue
            stop = take("int")
            step = take("int") if take("sign", ":") else None
            if step not in (None, "1", "-1"):
                raise SliceError(f"{expression!r}: step {step}")
            take("sign", "]", must=True)
            seq = _part(seq, start and int(start), stop and int(stop), step == "-1")
        return seq

    parts = [term()]
    while take("sign", "+"):
        parts.append(term())
    take("end", must=True)
    return parts[0] if len(parts) == 1 else F.concat(*parts)
