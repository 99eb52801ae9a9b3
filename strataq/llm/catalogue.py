"""Queries of the subpackage with the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from strataq.llm import queries_duplicates, queries_pages, queries_personal, queries_text

MODULES = [queries_text, queries_duplicates, queries_personal, queries_pages]

QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}
