"""Where the tables of one installation live, and their registration for SQL users."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orderloom import storage, versions
from orderloom.functions.casts import strict_sql
from orderloom.operators.combine import combine_feeds
from orderloom.operators.flatten import flattened_view
from orderloom.operators.ledger import RunLedger
from orderloom.operators.load import StagingTable, read_staged_documents, read_staged_orders
from orderloom.plans.event_log import EventLog
from orderloom.schema import EVENT_LOG, LOAD_HISTORY, LOAD_ID, ORDERS, RAW_DOCUMENTS, REJECTS, RUN_LEDGER, SUMMARY, with_fields
from orderloom.storage import OrderTable, SummaryTable


PLACE = [*(LOAD_HISTORY[name] for name in ("schema_name", "table_name")), LOAD_ID]


@dataclass(frozen=True)
class Workspace:
    """``database`` is where order tables and summaries have SQL names that each publication keeps up to date."""

    root: str
    grain: str = "month"
    database: str | None = None

    def _name(self, name: str) -> str | None:
        return self.database and f"{self.database}.{name}"

    def _staging(self, schema_name: str, name: str) -> StagingTable:
        return StagingTable(f"{self.root}/{schema_name}/{name}", schema_name, name, self.history_path)

    @property
    def history_path(self) -> str:
        return f"{self.root}/load_history"

    @property
    def internal_staging(self) -> StagingTable:
        return self._staging("orders", "orders_stg")

    @property
    def external_staging(self) -> StagingTable:
        return self._staging("external_orders", "orders_external_stg")

    @property
    def document_staging(self) -> StagingTable:
        return self._staging("external_json_orders", "orders_json_raw_stg")

    @property
    def customer_orders(self) -> OrderTable:
        return OrderTable(f"{self.root}/orders/customer_orders", self.grain, self._name("customer_orders"))

    @property
    def summary_orders(self) -> SummaryTable:
        return SummaryTable(f"{self.root}/orders/summary_orders", self._name("summary_orders"))

    @property
    def customer_orders_combined(self) -> OrderTable:
        return OrderTable(
            f"{self.root}/transform/customer_orders_combined", self.grain, self._name("customer_orders_combined")
        )

    @property
    def summary_orders_combined(self) -> SummaryTable:
        return SummaryTable(f"{self.root}/transform/summary_orders", self._name("summary_orders_combined"))

    @property
    def event_log(self) -> EventLog:
        return EventLog(f"{self.root}/transform/events")

    @property
    def rejects_path(self) -> str:
        return f"{self.root}/load_rejects"

    @property
    def run_ledger(self) -> RunLedger:
        return RunLedger(f"{self.root}/orders/run_ledger")

    def create(self, spark: SparkSession) -> Workspace:
        """Create all tables that do not exist yet."""
        for table in (self.internal_staging, self.external_staging, self.document_staging):
            storage.make_folder(spark, table.path)
        for path in (self.history_path, self.event_log.path, self.run_ledger.path, self.rejects_path):
            storage.make_folder(spark, path)
        for target in (self.customer_orders, self.customer_orders_combined):
            target.create(spark)
        for summary in (self.summary_orders, self.summary_orders_combined):
            summary.create(spark)
        return self

    def document_orders(self, spark: SparkSession) -> DataFrame:
        """Staged documents as order rows."""
        return flattened_view(read_staged_documents(spark, self.document_staging))

    def combined_staging(self, spark: SparkSession) -> DataFrame:
        """All three feeds as staged."""
        return combine_feeds(
            read_staged_orders(spark, self.internal_staging),
            read_staged_orders(spark, self.external_staging),
            self.document_orders(spark),
        )

    def _tables(self) -> list[tuple[str, str, object, list[str]]]:
        """Name, path, schema and partition columns of each table."""
        return [
            ("orders_stg", self.internal_staging.path, with_fields(ORDERS, LOAD_ID), [LOAD_ID.name]),
            ("orders_external_stg", self.external_staging.path, with_fields(ORDERS, LOAD_ID), [LOAD_ID.name]),
            ("orders_json_raw_stg", self.document_staging.path, with_fields(RAW_DOCUMENTS, LOAD_ID), [LOAD_ID.name]),
            ("load_history", self.history_path, LOAD_HISTORY, ["schema_name", "table_name", "load_id"]),
            ("load_rejects", self.rejects_path, with_fields(REJECTS, *PLACE), [field.name for field in PLACE]),
            ("event_log", self.event_log.path, EVENT_LOG, []),
            ("run_ledger", self.run_ledger.path, RUN_LEDGER, []),
        ]

    def _versioned(self) -> list[tuple[str, str, object]]:
        """Name, path and schema of the tables that are published in versions."""
        return [
            ("customer_orders", self.customer_orders.path, ORDERS),
            ("customer_orders_combined", self.customer_orders_combined.path, ORDERS),
            ("summary_orders", self.summary_orders.path, SUMMARY),
            ("summary_orders_combined", self.summary_orders_combined.path, SUMMARY),
        ]

    def register(self, spark: SparkSession, database: str = "default", replace: bool = False) -> None:
        """Make the tables and views known to the session's catalog, so that they can be queried in SQL."""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/catalog'")
        for name, path, schema, partitions in self._tables():
            if replace:
                spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet {by} LOCATION '{path}'")
        for name, _, _ in self._versioned():
            if replace:
                versions.drop_named(spark, f"{database}.{name}")
        columns = "customer, order_date, delivery_date, baked_good_type, quantity, source_file_name, load_ts"
        date = ORDERS["order_date"].dataType
        order_date = strict_sql("variant_get(r.customer_orders, '$[\"Order date\"]', 'string')", date, "Order date")
        delivery_date = strict_sql("variant_get(d.value, '$[\"Delivery date\"]', 'string')", date, "Delivery date")
        spark.sql(
            f"""CREATE OR REPLACE VIEW {database}.orders_json_stg AS
            SELECT variant_get(r.customer_orders, '$.Customer', 'string') AS customer,
                   {order_date} AS order_date,
                   {delivery_date} AS delivery_date,
                   variant_get(i.value, '$["Baked good type"]', 'string') AS baked_good_type,
                   variant_get(i.value, '$.Quantity', 'decimal(38,0)') AS quantity,
                   r.source_file_name, r.load_ts
            FROM {database}.orders_json_raw_stg AS r,
                 LATERAL variant_explode(variant_get(r.customer_orders, '$.Orders', 'variant')) AS d,
                 LATERAL variant_explode(variant_get(d.value, '$["Orders by day"]', 'variant')) AS i"""
        )
        spark.sql(
            f"""CREATE OR REPLACE VIEW {database}.orders_combined_stg AS
            SELECT {columns} FROM {database}.orders_stg
            UNION ALL SELECT {columns} FROM {database}.orders_external_stg
            UNION ALL SELECT {columns} FROM {database}.orders_json_stg"""
        )
        self.refresh(spark, database)

    def refresh(self, spark: SparkSession, database: str = "default") -> None:
        """Let the catalog see what the jobs have written since."""
        for name, _, _, partitions in self._tables():
            if partitions:
                spark.catalog.recoverPartitions(f"{database}.{name}")
            spark.catalog.refreshTable(f"{database}.{name}")
        for name, path, schema in self._versioned():
            versions.show_named(spark, f"{database}.{name}", path, schema)
