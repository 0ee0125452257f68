"""Schemas of the manifest, the run reports and the side outputs."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_STR, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()

_SIZES = _struct(record_count=_LONG, content_length=_LONG)

MANIFEST = _struct(
    date=_STR,
    format=_STR,
    meta=_SIZES,
    entities=T.ArrayType(
        _struct(
            entity=_STR,
            content_length=_LONG,
            files=T.ArrayType(_struct(url=_STR, meta=_SIZES)),
        )
    ),
)

DATASET_SUMMARY = _struct(
    dataset=_STR, items_scanned=_LONG, succeeded=_LONG, failed=_LONG, skipped=_LONG
)

FAILURE = _struct(
    dataset=_STR,
    phase=_STR,
    rel_path=_STR,
    source_path=_STR,
    output_path=_STR,
    error_message=_STR,
    suggested_recovery=_STR,
)

STEP_RUN = _struct(step=_STR, status=_STR, report_path=_STR, message=_STR)

REPORT = _struct(
    command=_STR,
    cli_version=_STR,
    report_nonce=_LONG,
    started_at_unix=_LONG,
    finished_at_unix=_LONG,
    duration_seconds=_DOUBLE,
    args=T.MapType(_STR, _STR),
    totals_items_scanned=_LONG,
    totals_succeeded=_LONG,
    totals_failed=_LONG,
    totals_skipped=_LONG,
    datasets=T.ArrayType(DATASET_SUMMARY),
    failures=T.ArrayType(FAILURE),
    step_runs=T.ArrayType(STEP_RUN),
)

ID_INDEX = _struct(
    id=_STR, id_block=T.IntegerType(), parquet_file=_STR, file_row_number=_LONG
)
