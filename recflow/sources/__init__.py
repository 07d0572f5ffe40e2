from recflow.sources.dimensions import (  # noqa: F401
    EVENT_WEIGHTS,
    REC_ALGORITHMS,
    category_dimension,
    event_weights,
    load_stopwords,
    tag_dimension,
)
from recflow.sources.snapshots import (  # noqa: F401
    jdbc_table,
    read_or_empty,
    read_snapshot,
    read_table,
    snapshot,
    stored_days,
)
