"""Raw tables, messages and model answers over one folder of test data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shopvitals.operators.complaints import classify_complaint_rules
from shopvitals.operators.features import activity
from shopvitals.operators.ingest import quarantine
from shopvitals.plans import monitor, warehouse
from shopvitals.session import materialize, pin_session, pin_streaming
from shopvitals.sources.tables import fixture_tables, fixture_view, scan_parquet
from shopvitals.sources.topics import fixture_messages

# Model answers, one or two attempts for each n. Runs unchanged in Spark and in the check.
# Most kinds are wrong in one way each.
MODEL_ANSWERS = """
SELECT n, run_timestamp, attempt,
       CASE WHEN kind = 4 THEN left(answer, 40)
            WHEN kind = 5 THEN concat('[', answer, ']')
            WHEN kind = 6 THEN concat(answer, ' as asked')
            ELSE answer END AS response,
       'openai' AS provider, 'gpt-4o-mini' AS model, 100 + n % 900 AS latency_ms
FROM (
  SELECT n, run_timestamp, attempt, kind,
         concat('{"status":"',
                CASE WHEN kind = 7 THEN 'Critical' WHEN n % 3 = 0 THEN 'critical'
                     WHEN n % 3 = 1 THEN 'degraded' ELSE 'healthy' END,
                '","severity":',
                CASE WHEN kind = 8 THEN 'true' WHEN kind = 9 THEN '"0.5"' WHEN kind = 10 THEN '1.2'
                     WHEN n % 11 = 0 THEN '1' ELSE concat('0.', n % 10) END,
                ',"confidence":', concat('0.', 2 + n % 7),
                ',"issue_summary":"answer ', n, '",',
                CASE WHEN kind = 11 THEN '"cause"' ELSE '"root_cause"' END,
                ':"gateway","business_impact":"lost sales","suggested_fix":"call the gateway"',
                ',"investigation_sql":"SELECT 1","tags":',
                CASE WHEN kind = 12 THEN '"x"' ELSE concat('["payment","t', n % 4, '"]') END,
                '}') AS answer
  FROM (
    SELECT n, run_timestamp, attempt, (n * 7 + attempt) % 17 AS kind
    FROM (SELECT n, run_timestamp, 1 AS attempt FROM {runs}
          UNION ALL SELECT n, run_timestamp, 2 AS attempt FROM {runs}) attempts
  ) kinds
) answers
"""

# Answers to complaint texts: whole, with a null, no object, broken, absent, empty.
LABEL_ANSWERS = """
SELECT concat('CMP-', doc_id) AS complaint_id, text AS complaint_text,
       CASE doc_id % 6
            WHEN 0 THEN '{"category":"other","severity":"critical","customer_emotion":"calm","business_impact":"operational_risk","recommended_action":"Call the customer."}'
            WHEN 1 THEN '{"category":null,"severity":"low"}'
            WHEN 2 THEN '["payment_issue"]'
            WHEN 3 THEN '{"category":"app_issue"'
            WHEN 4 THEN NULL
            ELSE '{}' END AS response
FROM documents
"""


# Answers to the complaints that come as events, two attempts each; the first is whole for one in two.
COMPLAINT_ANSWERS = """
SELECT complaint_id, attempt,
       CASE WHEN (n + attempt) % 4 = 0 THEN NULL
            WHEN (n + attempt) % 4 = 1 THEN '{"category":"late_delivery"'
            ELSE concat('{"category":"other","severity":"critical","customer_emotion":null,"recommended_action":"call ',
                        attempt, '"}') END AS response
FROM (SELECT complaint_id, CAST(substr(complaint_id, 5) AS BIGINT) AS n, 1 AS attempt FROM {complaints}
      UNION ALL SELECT complaint_id, CAST(substr(complaint_id, 5) AS BIGINT) AS n, 2 AS attempt FROM {complaints}) a
"""


#: Stored audit tables by session and folder of test data; queries on movement share one.
_AUDITS: dict[tuple[str, str], DataFrame] = {}


class Inputs:
    """Lazily built inputs of the registered queries."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = pin_session(spark)
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """Scan of one table of the test data; its footer is read once."""
        if name not in self._tables:
            self._tables[name] = scan_parquet(self.spark, f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def view(self, name: str, **instead: DataFrame) -> DataFrame:
        """A fixture view; ``instead`` replaces source tables, for example by a stream."""
        tables = {table: self.table(table) for table in fixture_tables(name) if table not in instead}
        return fixture_view(name, {**tables, **instead})

    def raw(self, family: str, *names: str) -> dict[str, DataFrame]:
        """Raw tables of one family, all five unless named."""
        names = names or ("raw_orders", "raw_payments", "raw_deliveries", "raw_complaints", "raw_refunds")
        tables = {}
        for name in names:
            if name == "raw_complaints":
                tables[name] = classify_complaint_rules(self.view(f"{family}_complaint_events"))
            else:
                tables[name] = self.view(f"{family}_{name}")
        return tables

    @property
    def events(self) -> DataFrame:
        return self.table("events")

    def event_stream(self, path: str | None = None, glob: str = "events.parquet") -> DataFrame:
        return (
            pin_streaming(self.spark).readStream.schema(self.events.schema)
            .option("pathGlobFilter", glob)
            .parquet(path or self.sf_dir)
        )

    @property
    def messages(self) -> DataFrame:
        return fixture_messages(self.events)

    def activity(self, events: DataFrame | None = None) -> DataFrame:
        """Activity rows of the event-grain family, optionally over a stream of events."""
        instead = {} if events is None else {"events": events}
        raw = {
            name: self.view(f"b_{name}", **instead)
            for name in ("raw_orders", "raw_payments", "raw_deliveries")
        }
        raw["raw_complaints"] = classify_complaint_rules(self.view("b_complaint_events", **instead))
        return activity(**raw)

    def cells(self, *names: str) -> DataFrame:
        return monitor.history_cells(self.raw("b", *(names or monitor.MONITORED)))

    def reports(self) -> DataFrame:
        return monitor.reports_replay(self.cells())

    def answers(self, runs: DataFrame) -> DataFrame:
        """Model answers for (n, run_timestamp)."""
        # The text holds JSON braces, so the table is named and not formatted in.
        runs.createOrReplaceTempView("_answer_runs")
        return self.spark.sql(MODEL_ANSWERS.replace("{runs}", "_answer_runs"))

    def answers_per_event(self) -> DataFrame:
        return self.answers(
            self.events.select(F.col("event_id").alias("n"), F.col("ts").alias("run_timestamp"))
        )

    def answers_per_tick(self) -> DataFrame:
        """For every quarter hour that ends after some event."""
        tick = F.floor(F.unix_seconds("ts") / F.lit(900)).cast("bigint") + 1
        return self.answers(
            self.events.select(tick.alias("n"))
            .distinct()
            .select("n", F.timestamp_seconds(F.col("n") * 900).alias("run_timestamp"))
        )

    def label_answers(self) -> DataFrame:
        self.table("documents").createOrReplaceTempView("_label_documents")
        return self.spark.sql(LABEL_ANSWERS.replace("FROM documents", "FROM _label_documents"))

    def complaint_answers(self) -> DataFrame:
        self.view("b_complaint_events").createOrReplaceTempView("_answer_complaints")
        return self.spark.sql(COMPLAINT_ANSWERS.replace("{complaints}", "_answer_complaints"))

    def movement(self, family: str = "b", logs: bool = False) -> dict[str, DataFrame]:
        """The tables that are backed up and loaded, with the log if that is wanted too."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _AUDITS:
            _AUDITS[key] = materialize(self.audit(), "audit")
        tables = {**self.raw(family), "ai_pipeline_diagnosis": _AUDITS[key]}
        return {**tables, "pipeline_logs": quarantine(self.messages)} if logs else tables

    def selected(self) -> DataFrame:
        return monitor.select_diagnoses(self.reports(), self.answers_per_tick())

    def audit(self) -> DataFrame:
        """Audit table of the replayed history."""
        return monitor.audit_rows(self.reports(), self.answers_per_tick())

    def staging(self, family: str) -> dict[str, DataFrame]:
        """Staging views of a family; the diagnoses are always those of the replay."""
        return warehouse.staging_views(self.movement(family))


def comparable(frame: DataFrame) -> DataFrame:
    """Plain column types: instants without zone, decimals as DOUBLE, lists as text."""

    def plain(f: T.StructField) -> Column:
        column = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        return column.alias(f.name)

    return frame.select(*[plain(f) for f in frame.schema])
