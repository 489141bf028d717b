"""The queries of the corpus operators and their DuckDB SQL."""

from . import byte_bpe, decontaminate, language_id, license_scan, line_dedup, near_dup, packing, periodic, pii, spelling, suffix_dedup, topk_search, url_filter

_modules = [url_filter, near_dup, topk_search, decontaminate, line_dedup, license_scan, language_id, pii, packing, suffix_dedup, spelling, periodic, byte_bpe]
QUERIES = {k: v for m in _modules for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in _modules for k, v in m.ORACLES.items()}
