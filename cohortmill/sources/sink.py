"""A relational database as the place where marts are served from.

Tasks write the rows of a batch to a staging table, in parallel and without a transaction that spans
them: a task may fail and be tried again, so nobody reads that table. One short transaction then moves
the rows inside the database and notes the batch in the log table there. A crash before it leaves a
staging table that the retry overwrites; after it the log tells that the batch is in.

The statements of that transaction go to ``run``, which the caller gives, as Spark writes to databases
but does not run statements in them: a function that executes all of them on one connection and commits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..schemas import Contract, empty_frame

LOG = "pipeline_sync_log"


@dataclass(frozen=True)
class JdbcSink:
    spark: SparkSession
    url: str
    run: Callable[[Sequence[str]], None]
    properties: dict[str, str] = field(default_factory=dict)
    batch_size: int = 1_000  # rows a round trip
    partitions: int = 8  # connections at once, whatever the number of tasks before

    def options(self, table: str) -> dict[str, str]:
        """Writer options. Connector/J sends one row a round trip without its own setting."""
        mysql = self.url.startswith(("jdbc:mysql:", "jdbc:mariadb:"))
        return {
            "url": self.url,
            "dbtable": table,
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.partitions),
            "isolationLevel": "READ_COMMITTED",
            **({"rewriteBatchedStatements": "true"} if mysql else {}),
            **self.properties,
        }

    @staticmethod
    def staging(contract: Contract) -> str:
        """One per table: whatever a crash left there is overwritten by the next batch."""
        return f"{contract.name}_staged"

    @staticmethod
    def column_types(contract: Contract) -> str:
        """Texts as wide as the contract allows; without a width Spark makes them unbounded."""
        return ", ".join(f"{column} VARCHAR({width})" for column, width in contract.widths.items())

    def create(self, contracts: Iterable[Contract]) -> None:
        """The log and the tables, where they are missing."""
        self.run([f"CREATE TABLE IF NOT EXISTS {LOG} (table_name VARCHAR(100) NOT NULL, batch VARCHAR(200) NOT NULL,"
                  " PRIMARY KEY (table_name, batch))"])
        for contract in contracts:
            types = self.column_types(contract)
            empty_frame(self.spark, contract.schema).write.format("jdbc").options(
                **self.options(contract.name), **({"createTableColumnTypes": types} if types else {})).mode("ignore").save()

    def log_query(self, contract: Contract) -> str:
        return f"SELECT batch FROM {LOG} WHERE table_name = '{contract.name}'"

    def batches(self, contract: Contract) -> set[str]:
        """Batches of a table that the database holds: at most one row a run, by its log."""
        found = self.spark.read.format("jdbc").options(url=self.url, query=self.log_query(contract), **self.properties).load()
        return {row[0] for row in found.collect()}

    def stage(self, contract: Contract, rows: DataFrame) -> None:
        rows.select(*contract.columns).write.format("jdbc").options(
            **self.options(self.staging(contract))).mode("overwrite").save()

    def rows_query(self, contract: Contract, *, replace: bool = False) -> str:
        """The staged rows to take: those with a new key, or all."""
        staged, columns = self.staging(contract), ", ".join(f"s.{c}" for c in contract.columns)
        same = " AND ".join(f"t.{c} = s.{c}" for c in contract.key)
        unseen = "" if replace else f" WHERE NOT EXISTS (SELECT 1 FROM {contract.name} t WHERE {same})"
        return f"SELECT {columns} FROM {staged} s{unseen}"

    def statements(self, contract: Contract, batch: str, *, replace: bool = False) -> list[str]:
        """One transaction: the log row first, whose key (table, batch) stops a second writer of the batch."""
        quoted = batch.replace("'", "''")
        moved = f"INSERT INTO {contract.name} ({', '.join(contract.columns)}) {self.rows_query(contract, replace=replace)}"
        return [
            f"INSERT INTO {LOG} (table_name, batch) VALUES ('{contract.name}', '{quoted}')",
            *([f"DELETE FROM {contract.name}"] if replace else []),
            moved,
        ]

    def write(self, contract: Contract, rows: DataFrame, batch: str, *, replace: bool = False) -> bool:
        """Rows of a batch, once; ``replace`` makes them the whole table. Tells whether anything was written."""
        if batch in self.batches(contract):
            return False
        self.stage(contract, rows)
        self.run(self.statements(contract, batch, replace=replace))
        return True
