"""Writers: typed append, partition unload, partitioned JSON lines, gzip JSON, stamped CSV."""

from .batches import KeyedBatchSink, write_batches  # noqa: F401
from .merge import merge_partitions, touched_partitions  # noqa: F401
from .writers import (  # noqa: F401
    TEXT_TS_OPTIONS,
    clustered,
    load_append,
    unload_partition,
    write_csv_stamped,
    write_date_folders,
    write_json_gzip,
    write_json_parts,
)
