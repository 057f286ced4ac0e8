"""Token budgets over arriving documents, with the running totals in keyed state.

The state of a dump, its admitted tokens and rows, lives in the query's RocksDB store under the dump's
name: it is versioned with the checkpoint, so a retried batch starts from the totals before it, and it
is neither listed nor read as a table. Only narrow rows pass through it; texts are fetched by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from corpusledger.operators.select import DUMP, SEEDED_ORDER
from corpusledger.runtime import session_settings

STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Totals are read by later versions of the library too.
    "spark.sql.streaming.stateStore.encodingFormat": "avro",
}
STATE = "tokens bigint, rows bigint"
ADMITTED = f"{DUMP} string, key string, doc_id bigint, token_count bigint"
#: Rows gathered beyond those admitted so far before the cut is made again.
SLACK = 100_000


def admissible(rows: pd.DataFrame, room: int) -> pd.DataFrame:
    """The rows in key order while the tokens before them stay below ``room``."""
    ordered = rows.sort_values(SEEDED_ORDER, kind="stable")
    before = ordered["token_count"].cumsum() - ordered["token_count"]
    return ordered[before < room]


class BudgetProcessor(StatefulProcessor):
    """Admits a dump's rows of each batch, in key order, until its quota is crossed.

    Rows come in chunks. Whatever the cut drops among the chunks seen so far no later chunk can bring
    back, so memory holds the rows that the quota still admits and at most ``SLACK`` more.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        tokens, count = self.totals.get() if self.totals.exists() else (0, 0)
        held, waiting, room = [], 0, None
        for chunk in rows:
            if room is None:
                room = int(chunk["token_quota"].iloc[0]) - tokens
            if room <= 0:
                continue  # a met quota admits nothing; the rest is read past
            held.append(chunk)
            waiting += len(chunk)
            if waiting > SLACK:
                held, waiting = [admissible(pd.concat(held), room)], 0
        if not held:
            return
        kept = admissible(pd.concat(held), room)
        self.totals.update((tokens + int(kept["token_count"].sum()), count + len(kept)))
        yield kept[[DUMP, "key", "doc_id", "token_count"]]

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        self.totals.update((int(row["tokens"]), int(row["rows"])))

    def close(self) -> None:
        pass


def stream_budget_keyed(
    counted: DataFrame, plans: DataFrame, out: str, checkpoint: str, initial: DataFrame | None = None
) -> None:
    """Admit arriving documents per dump until its quota is crossed; ``out`` gets the admitted rows.

    ``counted`` is a stream with key, doc_id and token_count, ``plans`` has token_quota per dump; rows
    of dumps without a plan are left out. Batches are admitted in arrival order, documents inside a
    batch in key order, the same as ``stream_budget`` does. ``initial`` (source_config, tokens, rows)
    is what a finished batch run has admitted already; it counts at the query's first start only. A
    dump's rows of one batch meet in one task, so bound batches at the source (``read_stream``).
    """
    spark = counted.sparkSession
    narrow = counted.select(DUMP, "key", "doc_id", F.col("token_count").cast("bigint").alias("token_count"))
    planned = narrow.join(plans.select(DUMP, F.col("token_quota").cast("bigint").alias("token_quota")), DUMP)
    start = None
    if initial is not None:
        start = initial.select(DUMP, *(F.col(name).cast("bigint").alias(name) for name in ("tokens", "rows")))
        start = start.groupBy(DUMP)
    with session_settings(spark, STORE):
        admitted = planned.groupBy(DUMP).transformWithStateInPandas(
            statefulProcessor=BudgetProcessor(), outputStructType=StructType.fromDDL(ADMITTED),
            outputMode="Append", timeMode="None", initialState=start,
        )
        query = (
            admitted.writeStream.format("parquet").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()


def keyed_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(source_config, tokens, rows) as the query's state has them after its last batch."""
    with session_settings(spark, STORE):
        state = spark.read.format("statestore").option("stateVarName", "totals").load(checkpoint)
        return state.select(f"key.{DUMP}", "value.tokens", "value.rows")


def admitted_keyed(spark: SparkSession, out: str) -> DataFrame:
    """Everything admitted so far: what the sink's log names, not what a failed batch left behind."""
    return spark.read.schema(ADMITTED).parquet(out)
