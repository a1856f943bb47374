"""Sources and sinks: explicit schemas, Parquet first, CSV at the edge."""

from seqwise.sources.io import (  # noqa: F401
    load_model, read_csv, read_events, read_lookup, save_model, write_csv, write_splits,
)
from seqwise.sources.fixtures import events, plays, players, table  # noqa: F401
