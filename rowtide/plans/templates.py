"""``${...}`` tokens in source conditions and selects.

* ``${state.<key>}``: the stored mark of ``key``, or its first-run lower bound;
* ``${env.<NAME>}``: an environment variable, as text;
* ``${sys.now('<format>') [+-]N<S|M|H|D>}``: the run's clock, formatted.

Spark queries get their values as bound parameters; text that goes to a database is
rendered with literals.  An unterminated token is left as it stands.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import zlib
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

from rowtide.errors import TemplateError
from rowtide.sources.dialects import literal, spans
from rowtide.types import Constant

_TOKEN = re.compile(r"\$\{([^}]*)\}")
_NOW = re.compile(r"now\(\s*'([^']*)'\s*\)(.*)", re.DOTALL)
_OFFSET = re.compile(r"([+-]?)([0-9]+)([SMHD])")
_BARE = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*|[+-]?[0-9]+(\.[0-9]+)?")

# Seconds per offset unit, and the format letters that are understood.
UNIT_SECONDS = {"S": 1, "M": 60, "H": 3600, "D": 86400}
FORMATS = {
    "Y": "%Y", "y": "%y", "m": "%m", "d": "%d", "H": "%H", "M": "%M", "S": "%S",
    "F": "%Y-%m-%d", "T": "%H:%M:%S", "z": "%z", "Z": "%z", "%": "%%",
}


@dataclass(frozen=True)
class Bound:
    """A query text with its named parameters."""

    sql: str
    args: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Template:
    """Resolves tokens; ``now`` is one fixed moment per run."""

    state: Callable[[str], Constant]
    now: dt.datetime
    env: Mapping[str, str] = field(default_factory=lambda: os.environ)

    def bind(self, text: str) -> Bound:
        """``text`` for ``spark.sql``: tokens become named parameters."""
        args: dict[str, str] = {}

        def put(name: str, value: Constant | str) -> str:
            if isinstance(value, str):
                args[name] = value
                return f":{name}"
            kind = "string" if isinstance(value.dtype, T.NullType) else value.dtype.simpleString()
            if value.value is None:
                return f"CAST(NULL AS {kind})"
            args[name] = value.text()
            return f"CAST(:{name} AS {kind})"

        def one(kind: str, value: Any, key: str, quoted: bool) -> str:
            if kind == "env":
                if quoted:
                    return value.replace("\\", "\\\\").replace("'", "''")
                if _BARE.fullmatch(value):
                    return value
                return put(f"env_{_name(key)}", value)
            if quoted:
                raise TemplateError(f"${{{kind}.{key}}} stands inside quotes; it brings its own")
            return put(f"{kind}_{_name(key)}", value)

        return Bound(self._replace(text, one, True), args)

    def render(self, text: str, dialect: str = "") -> str:
        """``text`` with literals of the ``dialect``, for a query that a database runs."""

        def one(kind: str, value: Any, key: str, quoted: bool) -> str:
            if kind == "env":
                return value
            return literal(dialect, value.value if isinstance(value, Constant) else value)

        return self._replace(text, one, dialect == "mysql")

    def _replace(self, text: str, one: Callable[[str, Any, str, bool], str], backslashes: bool) -> str:
        out, at = [], 0
        texts = [(start, end) for start, end, kind in spans(text, backslashes) if kind == "'"]
        for m in _TOKEN.finditer(text):
            out.append(text[at : m.start()])
            quoted = any(start < m.start() < end for start, end in texts)
            out.append(one(*self._resolve(m[1].strip()), quoted))
            at = m.end()
        return "".join([*out, text[at:]])

    def _resolve(self, token: str) -> tuple[str, Any, str]:
        if token.startswith("state."):
            return "state", self.state(token[6:]), token[6:]
        if token.startswith("env."):
            name = token[4:]
            if name not in self.env:
                raise TemplateError(f"environment variable {name!r} is not set")
            return "env", self.env[name], name
        if token.startswith("sys."):
            return "now", clock_text(token[4:].strip(), self.now), token[4:]
        raise TemplateError(f"unknown token ${{{token}}}")


def _name(key: str) -> str:
    """A parameter name that differs for different keys."""
    plain = re.sub(r"\W", "_", key, flags=re.ASCII)
    return plain if plain == key else f"{plain}_{zlib.crc32(key.encode())}"


def clock_text(expr: str, now: dt.datetime) -> str:
    """The text of ``now('<format>') [+-]N<unit>``; text after the unit is ignored."""
    m = _NOW.match(expr)
    if m is None:
        raise TemplateError(f"bad clock expression {expr!r}: expected now('<format>') with an offset")
    moment, offset = now, m[2].strip()
    if offset:
        o = _OFFSET.match(offset)
        if o is None:
            raise TemplateError(f"bad offset {offset!r}: expected a number and S, M, H or D")
        seconds = int(o[2]) * UNIT_SECONDS[o[3]]
        try:
            moment = now + dt.timedelta(seconds=-seconds if o[1] == "-" else seconds)
        except OverflowError as e:
            raise TemplateError(f"offset {offset!r} leaves the calendar") from e
    return moment.strftime(clock_format(m[1]))


def clock_format(text: str) -> str:
    """``text`` in ``strftime`` terms, or an error at a letter that is not understood."""

    def letter(m: re.Match[str]) -> str:
        if m[1] not in FORMATS:
            raise TemplateError(f"unsupported format %{m[1]} in {text!r}")
        return FORMATS[m[1]]

    return re.sub(r"%(.?)", letter, text, flags=re.DOTALL)
