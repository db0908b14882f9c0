"""Sources (CSV / parquet table sets, generated-data views) and sinks."""

from coursepulse.sources.fixture import fixture_tables  # noqa: F401
from coursepulse.sources.tables import (  # noqa: F401
    conform,
    load_csv_tables,
    load_csv_with_rejects,
    load_parquet_tables,
    write_tables,
)
