"""The queries of this package and the SQL that some of them must equal."""

from __future__ import annotations

from vitalgrid.llm import bpe, conversations, exact, licenses, mixing, quality, rules, simhash, substrings, toxicity, warc, whitening, wordpiece

MODULES = (wordpiece, mixing, bpe, simhash, toxicity, exact, quality, warc, rules, licenses, whitening, conversations, substrings)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
