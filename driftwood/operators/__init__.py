"""Relational operators (DataFrame -> DataFrame)."""

from .content import (bloom_of, content_join3, content_lookup, content_row, dedup_content, distinct_ids,
                      first_per_id, id_counts, ids_from_text_rows, known_ids, maybe_in, new_ids, new_ids_filtered,
                      render_content_text,
                      snapshot_merge, stored_join3, with_shard)
from .logs import (click_label, dedup_clicks, dedup_daily, default_order, flatten_log, flatten_text, label_json,
                   line_fate, strategy_filter, strategy_prefilter, with_pair_key)
from .variant_logs import flatten_variant_text, kept_docs, pair_docs, parse_variant, with_log
from .vectors import (block_vocab, category_vector, combine_repeats, content_vectors, first_vectors,
                      first_vectors_unpartitioned, hot_words, join_words, keyword_segments, tag_tokens, tag_vector, tag_vectors_multi,
                      token_vectors, token_vectors_broadcast, vector_lookup_one, vector_norms, vector_sums,
                      with_zero_vectors)

__all__ = [n for n in dir() if not n.startswith("_")]
