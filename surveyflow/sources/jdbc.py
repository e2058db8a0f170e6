"""Relational sink over JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Database:
    host: str
    database: str
    user: str
    password: str
    port: str = "5432"
    schema: str = "public"
    driver: str = "org.postgresql.Driver"
    batch_size: int = 1000
    connections: int = 4

    @property
    def url(self) -> str:
        return f"jdbc:postgresql://{self.host}:{self.port}/{self.database}"

    def options(self, table: str) -> dict[str, str]:
        """Writer options: quoted table, batched inserts, bounded connections, truncate on overwrite."""
        return {
            "url": self.url,
            "dbtable": f'"{self.schema}"."{table}"',
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.connections),
            "truncate": "true",
        }


def write_jdbc(df: DataFrame, table: str, database: Database) -> None:
    """Replace the rows of a table."""
    df.write.format("jdbc").options(**database.options(table)).mode("overwrite").save()
