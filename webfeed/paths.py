"""Path helpers: joining delivery paths and escaping Hadoop glob characters.

Spark treats any path containing ``{}[]*?\\`` as a glob, so names taken from a
manifest or a feed name are escaped before they are handed to a reader.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

_GLOB_SPECIAL = set("\\{}[]*?,")


def glob_escape(text: str) -> str:
    """Escape Hadoop glob metacharacters so ``text`` matches itself only."""
    return "".join("\\" + c if c in _GLOB_SPECIAL else c for c in text)


def normal(name: str) -> str:
    """A manifest's file name as a path relative to the directory (no leading or doubled slash)."""
    return re.sub("/+", "/", name).lstrip("/")


def literal_paths(directory: str, names: Iterable[str]) -> list[str]:
    """Reader-safe paths (glob-escaped) for files named in a manifest."""
    d = glob_escape(directory.rstrip("/"))
    return [d + "/" + glob_escape(normal(n)) for n in names]


def any_of(directory: str, names: Iterable[str]) -> str:
    """One glob matching exactly the given file names in ``directory``.

    Names that do not exist are skipped by the glob, so one read tells which of
    them are present.
    """
    escaped = sorted({glob_escape(n) for n in names})
    d = glob_escape(directory.rstrip("/"))
    if len(escaped) == 1:
        return d + "/" + escaped[0]
    return d + "/{" + ",".join(escaped) + "}"


def java_regex_literal(text: str) -> str:
    """Escape ``text`` for use inside a Java regular expression."""
    return "".join(c if c.isalnum() or c == "_" else "\\" + c for c in text)


def quoted(name: str) -> str:
    """A column name as Spark reads it literally (dots and backticks included)."""
    return "`" + name.replace("`", "``") + "`"
