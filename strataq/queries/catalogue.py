"""All queries of the core with the SQL that gives the same rows."""

from __future__ import annotations

from strataq.queries import audits, core_problems, documents, quality, records, registers, relational, search, temporal

MODULES = [core_problems, temporal, relational, search, quality, documents, audits, records, registers]

QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}
