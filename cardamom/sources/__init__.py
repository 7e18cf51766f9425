"""Reading and writing."""

from cardamom.sources.partitions import (
    create_partitioned_table,
    drop_partition,
    finish_rewrite,
    of_partitions,
    replace_partitions,
    rewrite_partitions,
    rewrite_table,
)
from cardamom.sources.readers import (
    infer_csv_schema,
    read_csv,
    read_csv_lines,
    read_export,
    read_json_documents,
    read_pipe_lines,
    read_tsv_matches,
    records,
)
from cardamom.sources.stored import KeyViolation, broken_keys, change_columns, insert_checked
from cardamom.sources.writers import (
    append_rows,
    create_namespace,
    create_table_as,
    export_csv,
    external_csv_table,
    overwrite_partitions,
    publish_view,
    read_partitioned,
    write_csv,
    write_parquet,
    write_partitioned_fact,
)

__all__ = [
    "KeyViolation",
    "append_rows",
    "broken_keys",
    "change_columns",
    "create_namespace",
    "create_partitioned_table",
    "create_table_as",
    "drop_partition",
    "export_csv",
    "external_csv_table",
    "finish_rewrite",
    "infer_csv_schema",
    "insert_checked",
    "of_partitions",
    "overwrite_partitions",
    "publish_view",
    "read_csv",
    "read_csv_lines",
    "read_export",
    "read_json_documents",
    "read_partitioned",
    "read_pipe_lines",
    "read_tsv_matches",
    "records",
    "replace_partitions",
    "rewrite_partitions",
    "rewrite_table",
    "write_csv",
    "write_parquet",
    "write_partitioned_fact",
]
