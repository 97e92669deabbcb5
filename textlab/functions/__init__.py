"""Column -> Column functions."""

from .labels import (  # noqa: F401
    NA_TOKENS, article_id, binarize_label, label_raw, null_tokens, severity_to_binary, to_label,
)
from .scores import apply_threshold, mistake_strength, outcome_group, softmax2  # noqa: F401
from .text import (  # noqa: F401
    analyzed_terms, clean_text, enrich_text, ngrams_1_2, normalize_text, token_count,
    truncate_tokens, word_tokens,
)
