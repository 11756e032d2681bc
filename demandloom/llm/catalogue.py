"""The registered queries of this package and the SQL that some are checked against."""

from __future__ import annotations

from demandloom.llm import (
    alignment,
    ann,
    bpe,
    classifier,
    licenses,
    packing,
    pages,
    rules,
    sharding,
    simhash,
    suffixes,
    topk,
    trie,
)
from demandloom.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

QUERIES = {
    "op1_rule_ensemble": classifier.op1,
    "op2_collision_counting": ann.op2,
    "op3_isolation_forest_rules": rules.op3,
    "op4_columnwise_suffixes": suffixes.op4,
    "op5_histogram_sort_shards": sharding.op5,
    "op6_host_suffix_pages": pages.op6,
    "op7_license_diagonals": licenses.op7,
    "op8_ordered_packing": packing.op8,
    "op9_simhash_pigeonring": simhash.op9,
    "op10_recursive_bpe": bpe.op10,
    "op11_fragment_monoid": alignment.op11,
    "op12_branch_and_bound": topk.op12,
    "op13_truncation_peeling": trie.op13,
}
