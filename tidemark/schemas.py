"""Fixed names and schemas of the layered tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The payload arrays an envelope must hold, and the column each one fills.
METRICS = {"prices": "price", "market_caps": "market_cap", "total_volumes": "total_volume"}
PAYLOAD_ARRAYS = tuple(METRICS)

# Default spans in days.
INCREMENTAL_DAYS = 2


def _schema(**columns) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns.items()])


RAW = _schema(
    ingestion_time=TimestampType(),
    entity=StringType(),
    days_requested=LongType(),
    payload=StringType(),
)
LANDED = StructType([*RAW.fields, StructField("run_date", DateType(), True)])
# What a reader of landed files adds: the file, and the text of a line that is no envelope.
ORIGIN = _schema(source_file=StringType(), corrupt=StringType())
INTAKE = StructType(
    [
        *LANDED.fields,
        *ORIGIN.fields,
        StructField("missing", ArrayType(StringType()), True),
        StructField("load_id", StringType(), True),
    ]
)
STAGING = _schema(
    entity=StringType(),
    event_time=TimestampType(),
    price=DoubleType(),
    market_cap=DoubleType(),
    total_volume=DoubleType(),
    ingestion_time=TimestampType(),
)
# ``point`` is the JSON text of what the arrays hold at the position.
BAD_POINTS = _schema(
    entity=StringType(),
    ingestion_time=TimestampType(),
    payload_key=LongType(),
    position=IntegerType(),
    point=StringType(),
)
CURATED = _schema(
    entity=StringType(),
    date=DateType(),
    avg_price=DoubleType(),
    max_price=DoubleType(),
    min_price=DoubleType(),
    total_volume=DoubleType(),
    avg_market_cap=DoubleType(),
    daily_price_change_pct=DoubleType(),
)
STATE = _schema(
    pipeline_name=StringType(), last_processed_date=DateType(), updated_at=TimestampType()
)
STATUS = _schema(
    entity=StringType(), run_date=DateType(), ok=BooleanType(), reason=StringType(), run_id=StringType()
)


@dataclass(frozen=True)
class TableSpec:
    """A table's data columns, its key, and the partition columns it is laid out by.

    ``partitions`` maps a partition column to its type; ``derived`` gives the SQL expression for
    those that follow from the data columns. The others come with the rows.
    """

    name: str
    schema: StructType
    keys: tuple[str, ...] = ()
    partitions: dict[str, str] = field(default_factory=dict)
    derived: dict[str, str] = field(default_factory=dict)

    @property
    def full_schema(self) -> StructType:
        return StructType.fromDDL(
            ", ".join([self.schema.toDDL(), *[f"`{c}` {t}" for c, t in self.partitions.items()]])
        )


# ``outcome`` keeps the loaded envelopes (the raw table), the rejected ones and broken lines in one
# layout, so that a single pass over the landed files writes all of them. A load has the ``batch`` of
# its own id until it is packed with others.
INTAKE_TABLE = TableSpec(
    "intake",
    INTAKE,
    partitions={"outcome": "string", "ingestion_date": "date", "batch": "string"},
    derived={
        "outcome": "CASE WHEN corrupt IS NOT NULL THEN 'corrupt' WHEN size(missing) = 0 THEN 'loaded' ELSE 'rejected' END",
        "ingestion_date": "to_date(ingestion_time)",
    },
)
STAGING_TABLE = TableSpec(
    "staging",
    STAGING,
    keys=("entity", "event_time"),
    partitions={"event_date": "date"},
    derived={"event_date": "to_date(event_time)"},
)
BAD_POINTS_TABLE = TableSpec(
    "bad_points",
    BAD_POINTS,
    keys=("entity", "ingestion_time", "payload_key", "position"),
    partitions={"ingestion_date": "date"},
    derived={"ingestion_date": "to_date(ingestion_time)"},
)
CURATED_TABLE = TableSpec(
    "curated",
    CURATED,
    keys=("entity", "date"),
    partitions={"month": "date"},
    derived={"month": "to_date(date_trunc('MM', date))"},
)
STATE_TABLE = TableSpec(
    "state",
    STATE,
    keys=("pipeline_name",),
    partitions={"bucket": "int"},
    derived={"bucket": "cast(pmod(xxhash64(pipeline_name), 16) AS int)"},
)
# A run, like a load, has a batch of its own until it is packed with others.
STATUS_TABLE = TableSpec("status", STATUS, partitions={"pipeline_name": "string", "batch": "string"})

TABLES = {
    spec.name: spec
    for spec in (INTAKE_TABLE, STAGING_TABLE, BAD_POINTS_TABLE, CURATED_TABLE, STATE_TABLE, STATUS_TABLE)
}
