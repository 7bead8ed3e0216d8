"""Exceptions raised while a job is read, planned or run."""

from __future__ import annotations


class RowtideError(Exception):
    """Base class."""


class ConfigError(RowtideError, ValueError):
    """A job, connection or step definition is wrong."""


class TemplateError(RowtideError, ValueError):
    """A ``${...}`` token cannot be resolved."""


class ExpressionError(RowtideError, ValueError):
    """A filter condition or a cast is not valid for the column types at hand."""


class StateError(RowtideError):
    """Stored high-water marks cannot be read or written."""
