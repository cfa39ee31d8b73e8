from lodestar.sources.files import (  # noqa: F401
    read_csv, read_csv_parts, read_json, read_text_lines, write_bucketed, write_csv, write_json,
    write_observed, write_parquet,
)
from lodestar.sources.jdbc import read_jdbc, write_jdbc  # noqa: F401
from lodestar.sources.local import from_rows, schema_report  # noqa: F401
from lodestar.sources.tables import TABLES, load, register_views  # noqa: F401
