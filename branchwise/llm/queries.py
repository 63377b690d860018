"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from branchwise.llm import decontam, linededup, mixing, neardup, periods, quality, rans, repeats, sharding, tokencount, trie, urlfilter, warc

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_url_filter": urlfilter.op2_url_filter,
    "op3_decontamination": decontam.op3_decontamination,
    "op4_line_dedup": linededup.op4_line_dedup,
    "op5_mixing": mixing.op5_mixing,
    "op6_minhash_near_dedup": neardup.op6_minhash_near_dedup,
    "op7_token_counts": tokencount.op7_token_counts,
    "op8_sharding": sharding.op8_sharding,
    "op9_suffix_dedup": repeats.op9_suffix_dedup,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_rans_ids": rans.op11_rans_ids,
    "op12_conversation_trie": trie.op12_conversation_trie,
    "op13_periodic_runs": periods.op13_periodic_runs,
}
ORACLE_SQL = {
    "op2_url_filter": urlfilter.ORACLE_SQL,
    "op4_line_dedup": linededup.ORACLE_SQL,
    "op10_quality_rules": quality.ORACLE_SQL,
}
