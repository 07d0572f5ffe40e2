from recflow.functions.columns import (  # noqa: F401
    comparable,
    cosine_dense,
    cosine_sparse,
    decay,
    event_weight,
    f1_score,
    geo_match,
    geo_weights,
    rounded_double,
    tag_overlap,
    word_set,
)
