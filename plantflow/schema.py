"""Table and wire schemas. Nothing in the package infers a schema."""

from pyspark.sql import types as T

# Names that devices and gateways use on the wire.
DATA_VALID = "DataValid"
MACHINE_ANOMALY = "MachineAnomaly"
PIECE_COUNTER = "MachinePieceCounter"
REJECT_COUNTER = "MachineRejectedPieces"
LINE_COUNTER = "LinePieceCounter"
MACHINE_STATES = ("InAlarm", "InBypass", "InCycle", "InWarning")
RAW, DERIVED = "R", "D"
UNKNOWN_TYPE = "Unknown"

# The event table. `event_id` orders rows that share a timestamp.
MACHINE_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("machine_id", T.IntegerType(), False),
        T.StructField("variable", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("value", T.IntegerType(), False),
        T.StructField("event_type", T.StringType(), False),
    ]
)

MODEL_COLUMNS = tuple(f.name for f in MACHINE_EVENTS)

# The six payload fields. `value` is read as text because devices send booleans, integers or floats.
PAYLOAD = T.StructType(
    [
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("machine_id", T.IntegerType()),
        T.StructField("variable", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("event_type", T.StringType()),
    ]
)

# A received message. Time and number of receipt are optional; a broker that knows them settles the order of messages.
MESSAGE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("received_at", T.TimestampType()),
        T.StructField("message_id", T.LongType()),
    ]
)
