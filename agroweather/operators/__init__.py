from agroweather.operators.batching import point_batches
from agroweather.operators.bucketing import bucket_count, bucketed_table, write_bucketed
from agroweather.operators.checks import (
    broken_rules,
    content_digest,
    differing_groups,
    duplicate_keys,
    freshness,
    null_counts,
    orphan_keys,
    out_of_range,
    reconcile,
    unexpected_values,
)
from agroweather.operators.dedupe import latest_per_key
from agroweather.operators.gate import (
    RecordLimitExceeded,
    enforce_record_limit,
    record_counts,
    work_list,
)
from agroweather.operators.probes import high_watermark, year_is_loaded, year_probe
from agroweather.operators.publish import recover
from agroweather.operators.sinks import (
    RequiredFieldError,
    land_bronze,
    load_raw,
    refresh_from_watermark,
    require_not_null,
    write_partitioned,
    write_table,
)

__all__ = [
    "RecordLimitExceeded",
    "RequiredFieldError",
    "broken_rules",
    "bucket_count",
    "bucketed_table",
    "content_digest",
    "differing_groups",
    "duplicate_keys",
    "enforce_record_limit",
    "freshness",
    "high_watermark",
    "land_bronze",
    "latest_per_key",
    "load_raw",
    "null_counts",
    "orphan_keys",
    "out_of_range",
    "point_batches",
    "reconcile",
    "record_counts",
    "recover",
    "refresh_from_watermark",
    "require_not_null",
    "unexpected_values",
    "work_list",
    "write_bucketed",
    "write_partitioned",
    "write_table",
    "year_is_loaded",
    "year_probe",
]
