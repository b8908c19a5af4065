"""The registered queries of this subpackage, each beside SQL that states its result, where SQL can."""

from __future__ import annotations

from matchgrid.llm import audit, bpe, codebook, decontaminate, mtree, pii, quality, sharding, simhash, tokenfile, toxicity, url_rules, vptree

FAMILIES = (tokenfile, quality, mtree, toxicity, pii, sharding, decontaminate, bpe, url_rules, simhash, audit, codebook, vptree)
QUERIES = {name: fn for family in FAMILIES for name, fn in family.QUERIES.items()}
ORACLE = {name: sql for family in FAMILIES for name, sql in family.ORACLE.items()}
