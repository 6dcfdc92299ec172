from assetqueue.sources.tables import (  # noqa: F401
    read_required, read_optional, read_quarantined, parse_dates, require_parsed, drop_invalid_dates,
    write_table, write_report, save_model, load_model, load_models, normalised, stamp_results, latest_results,
)
from assetqueue.sources.run_store import Run, RunStore  # noqa: F401
