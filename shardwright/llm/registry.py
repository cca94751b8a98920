"""All queries of this package and their SQL."""

from . import alignment, bpe, exact_dedup, fill_in_middle, language_id, line_dedup, lm_scoring, media, mixing, secrets, simhash, substring_dedup, token_counts

MODULES = (mixing, bpe, substring_dedup, secrets, token_counts, exact_dedup, media, lm_scoring, language_id, simhash, alignment, line_dedup, fill_in_middle)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
