"""Table shapes shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

QUANTITY = T.DecimalType(38, 0)

# The order row, in file order first, then lineage.
ORDERS = T.StructType(
    [
        T.StructField("customer", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("delivery_date", T.DateType()),
        T.StructField("baked_good_type", T.StringType()),
        T.StructField("quantity", QUANTITY),
        T.StructField("source_file_name", T.StringType()),
        T.StructField("load_ts", T.TimestampType()),
    ]
)
ORDER_COLUMNS = ORDERS.fieldNames()
FILE_COLUMNS = ORDER_COLUMNS[:5]
MERGE_KEYS = ["customer", "delivery_date", "baked_good_type"]

# Field names of the nested order document.
DOCUMENT = T.StructType(
    [
        T.StructField("Customer", T.StringType()),
        T.StructField("Order date", T.DateType()),
        T.StructField(
            "Orders",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("Delivery date", T.DateType()),
                        T.StructField(
                            "Orders by day",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("Baked good type", T.StringType()),
                                        T.StructField("Quantity", QUANTITY),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        ),
    ]
)

RAW_DOCUMENTS = T.StructType(
    [
        T.StructField("customer_orders", T.VariantType()),
        T.StructField("source_file_name", T.StringType()),
        T.StructField("load_ts", T.TimestampType()),
    ]
)

SUMMARY = T.StructType(
    [
        T.StructField("delivery_date", T.DateType()),
        T.StructField("baked_good_type", T.StringType()),
        T.StructField("total_quantity", QUANTITY),
    ]
)

# What the sums are of: a group without rows is gone, a sum of no quantities is NULL.
SUMMARY_COUNTS = [T.StructField("order_rows", T.LongType()), T.StructField("quantities", T.LongType())]

# Staging tables keep the physical file of each row for the load history; readers do not see it.
FILE_PATH = T.StructField("file_path", T.StringType())
FILE_FIELDS = [
    FILE_PATH,
    T.StructField("file_size", T.LongType()),
    T.StructField("file_modification_time", T.TimestampType()),
]
LOAD_ID = T.StructField("load_id", T.StringType())

# Merge targets and summaries are partitioned by the first day of the delivery period.
PERIOD = T.StructField("delivery_period", T.DateType())

LOAD_HISTORY = T.StructType(
    [
        T.StructField("schema_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("source_file_name", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("file_modification_time", T.TimestampType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("last_load_time", T.TimestampType()),
    ]
)

REJECTS = T.StructType(
    [
        T.StructField("source_file_name", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("line", T.LongType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

RUN_LEDGER = T.StructType(
    [
        T.StructField("process", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("token", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("at", T.TimestampType()),
    ]
)

EVENT_LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("severity", T.StringType()),
        T.StructField("procedure_name", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)


def with_fields(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, *fields])
