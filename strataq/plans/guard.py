"""A guard for SQL that may only read: one statement, a query, nothing that writes."""

from __future__ import annotations

import re

# Literals, quoted names and comments, which hold no keywords.
_QUIET = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/", re.DOTALL)
# Words that begin or hold a change.
_WRITES = frozenset("insert update delete merge replace create alter drop truncate grant revoke attach detach pragma vacuum reindex copy load install export import call execute begin commit rollback set use refresh cache uncache analyze msck".split())


class NotReadOnly(ValueError):
    """The statement may change something."""


def assert_read_only(sql: str) -> str:
    """The statement without its closing semicolon if it is one SELECT, VALUES or WITH query; NotReadOnly otherwise, also where a quote or comment stays open."""
    plain = _QUIET.sub(" ", sql)
    if any(x in plain for x in ("'", '"', "`", "/*", "*/")):
        raise NotReadOnly("a quote or comment stays open")
    body = plain.strip().removesuffix(";").strip()
    if ";" in body:
        raise NotReadOnly("more than one statement")
    words = re.findall(r"[a-z_]\w*", body.lower())
    if not words or words[0] not in ("select", "with", "values"):
        raise NotReadOnly("no query")
    called = set(re.findall(r"([a-z_]\w*)\s*\(", body.lower()))
    if bad := sorted((set(words) & _WRITES) - called):  # replace(…) and the like are functions
        raise NotReadOnly(f"holds {', '.join(bad)}")
    return sql.strip().removesuffix(";").rstrip()


def page_windows(total: int, page: int, size: int = 50, near: int = 2) -> list[int | None]:
    """Numbers of the pages to show: the first, the last, those near the present one; None where some are left out."""
    last = max(1, -(-total // size))
    page = min(max(1, page), last)
    shown = sorted({1, last, *range(max(1, page - near), min(last, page + near) + 1)})
    out: list[int | None] = []
    for p in shown:
        if out and p - (out[-1] or 0) == 2:
            out.append(p - 1)
        elif out and p - (out[-1] or 0) > 2:
            out.append(None)
        out.append(p)
    return out
