"""Named connections: databases through JDBC, or folders of files."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from rowtide.errors import ConfigError
from rowtide.types import quoted

# The default ports and the MySQL character sets that are accepted.
PORTS = {"mysql": 3306, "postgresql": 5432, "oracle": 1521}
MYSQL_CHARSETS = {"utf8": "utf8mb4", "utf8mb4": "utf8mb4", "latin1": "latin1", "gbk": "gbk", "big5": "big5"}
# Java's names of those sets, as the driver wants them.
JAVA_CHARSETS = {"utf8mb4": "UTF-8", "latin1": "ISO-8859-1", "gbk": "GBK", "big5": "Big5"}
MYSQL_TLS = {"require": "REQUIRED", "required": "REQUIRED", "verify_ca": "VERIFY_CA", "verify_identity": "VERIFY_IDENTITY"}
DATABASES = ("mysql", "postgresql", "oracle")


def expand_env(text: str, env: Mapping[str, str] | None = None) -> str:
    """``${VAR}`` and ``${env.VAR}`` from the environment; unknown names stay as they are."""
    env = os.environ if env is None else env
    return re.sub(r"\$\{(?:env\.)?([^}]*)\}", lambda m: env.get(m[1], m[0]), text)


def _scalar(value: Any) -> str:
    """A YAML scalar as text: an unquoted numeric password is still a password."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    return str(value)


@dataclass(frozen=True)
class Connection:
    """One entry of the connections document.

    ``type`` is ``mysql``, ``postgresql``, ``oracle``, ``files`` (a folder of tables, by
    ``path``) or ``catalog`` (tables Spark knows by name, in the namespace ``database``).
    """

    name: str
    type: str
    host: str = "localhost"
    port: int = 0
    database: str = ""
    schema: str | None = None
    username: str = ""
    password: str = field(default="", repr=False)
    params: Mapping[str, str] = field(default_factory=dict, repr=False)
    max_pool_size: int = 4
    connect_timeout_secs: int = 15
    path: str = ""
    format: str = "parquet"
    pattern: str = "{table}"

    @property
    def is_database(self) -> bool:
        return self.type in DATABASES

    @staticmethod
    def parse(name: str, raw: Mapping[str, Any], env: Mapping[str, str] | None = None) -> Connection:
        if not isinstance(raw, Mapping) or not isinstance(raw.get("type"), str):
            raise ConfigError(f"connection {name!r}: missing type")
        kind = raw["type"]
        if kind not in (*DATABASES, "files", "catalog"):
            raise ConfigError(f"connection {name!r}: unknown type {kind!r}")
        host = _scalar(raw.get("host", "localhost"))
        if not host:
            raise ConfigError(f"connection {name!r}: missing host")
        if kind == "files" and not raw.get("path"):
            raise ConfigError(f"connection {name!r}: missing path")
        params = {str(k): expand_env(_scalar(v), env) for k, v in (raw.get("params") or {}).items()}
        if "ssl_mode" in raw:
            params.setdefault("ssl_mode", _scalar(raw["ssl_mode"]))
        return Connection(
            name=name,
            type=kind,
            host=host,
            port=int(raw.get("port") or PORTS.get(kind, 0)),
            database=_scalar(raw.get("database")),
            schema=raw.get("schema"),
            username=_scalar(raw.get("username")),
            password=expand_env(_scalar(raw.get("password")), env),
            params=params,
            max_pool_size=max(1, int(raw.get("max_pool_size") or 4)),
            connect_timeout_secs=max(1, int(raw.get("connect_timeout_secs") or 15)),
            path=_scalar(raw.get("path")).rstrip("/"),
            format=_scalar(raw.get("format")) or "parquet",
            pattern=_scalar(raw.get("pattern")) or "{table}",
        )

    def table_name(self, table: str) -> str:
        """A table of a catalogue, as SQL text."""
        return ".".join(quoted(part) for part in (*filter(None, self.database.split(".")), table))

    def jdbc_options(self) -> dict[str, str]:
        """Options for Spark's JDBC reader and writer."""
        options = {"numPartitions": str(self.max_pool_size)}
        if self.username:
            options["user"] = self.username
            options["password"] = self.password
        return {**options, **_BUILDERS[self.type](self)}


def _mysql(c: Connection) -> dict[str, str]:
    options = {
        "url": f"jdbc:mysql://{c.host}:{c.port}/{c.database}",
        "driver": "com.mysql.cj.jdbc.Driver",
        "connectTimeout": str(c.connect_timeout_secs * 1000),
        "rewriteBatchedStatements": "true",
    }
    charset = c.params.get("charset")
    if charset is not None:
        if charset.lower() not in MYSQL_CHARSETS:
            raise ConfigError(f"connection {c.name!r}: unsupported mysql charset {charset!r}")
        options["characterEncoding"] = JAVA_CHARSETS[MYSQL_CHARSETS[charset.lower()]]
    tls = MYSQL_TLS.get(c.params.get("ssl_mode", "").lower())
    if tls:
        options["sslMode"] = tls
    return options


def _postgresql(c: Connection) -> dict[str, str]:
    options = {
        "url": f"jdbc:postgresql://{c.host}:{c.port}/{c.database}",
        "driver": "org.postgresql.Driver",
        "connectTimeout": str(c.connect_timeout_secs),
        "ApplicationName": f"rowtide/{c.name}",
        "reWriteBatchedInserts": "true",
    }
    if c.schema:
        options["currentSchema"] = c.schema
    if c.params.get("ssl_mode"):
        options["sslmode"] = c.params["ssl_mode"].lower().replace("_", "-")
    return options


def _oracle(c: Connection) -> dict[str, str]:
    options = {
        "url": f"jdbc:oracle:thin:@//{c.host}:{c.port}/{c.database}",
        "driver": "oracle.jdbc.OracleDriver",
        "oracle.net.CONNECT_TIMEOUT": str(c.connect_timeout_secs * 1000),
    }
    if c.schema:
        quoted = c.schema.replace('"', '""')
        options["sessionInitStatement"] = f'ALTER SESSION SET CURRENT_SCHEMA = "{quoted}"'
    return options


_BUILDERS = {"mysql": _mysql, "postgresql": _postgresql, "oracle": _oracle}


def load_connections(doc: Mapping[str, Any], env: Mapping[str, str] | None = None) -> dict[str, Connection]:
    """The ``connections`` section of a document, by name."""
    section = doc.get("connections") if isinstance(doc, Mapping) else None
    if not isinstance(section, Mapping):
        raise ConfigError("missing 'connections' section")
    return {str(n): Connection.parse(str(n), c, env) for n, c in section.items()}
