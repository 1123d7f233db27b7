from tallytide.sources.published import publish_table, read_published, replace_partitions
from tallytide.sources.readers import (
    METADATA_COLUMNS,
    read_annotation,
    read_count_matrix,
    read_sample_metadata,
    read_table,
)
from tallytide.sources.writers import write_result, write_table

__all__ = [
    "METADATA_COLUMNS",
    "publish_table",
    "read_annotation",
    "read_count_matrix",
    "read_published",
    "read_sample_metadata",
    "read_table",
    "replace_partitions",
    "write_result",
    "write_table",
]
