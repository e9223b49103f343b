"""Queries and SQL of this folder's operators."""

from __future__ import annotations

from . import binary, extract, langid, licences, mixing, neardup, packing, quality, urlrules, veclinks

MODULES = [packing, urlrules, mixing, neardup, licences, veclinks, langid, extract, quality, binary]

QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
