"""Names of the queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from seamark.llm import queries as q
from seamark.llm.infilling import infilling_sql
from seamark.llm.license_sql import license_sql
from seamark.llm.prefix_trie import trie_sql
from seamark.llm.urls import url_sql


def queries() -> dict:
    return {name: f for name, f in vars(q).items() if name.startswith("op")} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": license_sql(), "op6_url_filter": url_sql(), "op11_fill_in_middle": infilling_sql(), "op13_prefix_trie": trie_sql()}
