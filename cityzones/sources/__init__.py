"""Sources (landing-zone readers, lookups) and sinks."""

from cityzones.sources.files import (  # noqa: F401
    path_date_columns, read_csv, read_csv_columns, read_csv_naive, read_csv_strict,
    read_incidents, read_income, read_json_lines, read_rent, read_snapshots,
)
from cityzones.sources.lookups import incident_lookup, income_lookup, rent_lookup  # noqa: F401
from cityzones.sources.sinks import (  # noqa: F401
    save_model, write_csv, write_jdbc, write_parquet,
)
from cityzones.sources.versions import (  # noqa: F401
    current_version, expire, overwrite_table, list_versions, publish, read_table, write_version,
)
