"""The queries of this package and the SQL of those that SQL can express."""

from tidelog.llm import arrow_files, jaccard_join, line_dedup, merge_replay, packing, prefix_trie, pu_classifier, repair, rule_votes, simhash, stream_dedup, suffix_dedup, superkmer

_MODULES = (suffix_dedup, jaccard_join, rule_votes, packing, prefix_trie, pu_classifier, stream_dedup, line_dedup, merge_replay, superkmer, arrow_files, prefix_trie, simhash, repair)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in getattr(m, "ORACLES", {}).items()}
