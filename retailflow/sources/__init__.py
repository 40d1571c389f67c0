from .compaction import compact, compact_new, read_compacted
from .landing import landing_hours, landing_inventory, read_entity, read_landing
from .runs import commit_run, committed, committed_runs, one_per_key, open_run
from .scratch import scratch_dir
from .warehouse import (
    append_dim,
    append_fact,
    describe_table,
    drop_database,
    dump_csv,
    ensure_database,
    list_databases,
    load_dim,
    load_fact_run,
    load_wide_run,
    product_history,
    read_csv_dump,
    read_orc_table,
    read_run,
    table_sections,
    write_wide_table,
)

__all__ = [
    "append_dim",
    "append_fact",
    "commit_run",
    "committed",
    "committed_runs",
    "compact",
    "compact_new",
    "describe_table",
    "drop_database",
    "dump_csv",
    "ensure_database",
    "landing_hours",
    "landing_inventory",
    "list_databases",
    "load_dim",
    "load_fact_run",
    "load_wide_run",
    "one_per_key",
    "open_run",
    "product_history",
    "read_compacted",
    "read_csv_dump",
    "read_entity",
    "read_landing",
    "read_orc_table",
    "read_run",
    "scratch_dir",
    "table_sections",
    "write_wide_table",
]
