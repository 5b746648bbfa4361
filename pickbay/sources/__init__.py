from pickbay.sources.tables import (  # noqa: F401
    active_scan,
    as_of,
    day_scan,
    partition_scan,
    read_csv_upload,
    read_partitioned,
    read_tsv,
)
