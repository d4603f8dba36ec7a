"""Joins on keys of which one may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, stored


class KeyTable:
    """A table with one row per key, joined to rows whose keys may be hot.

    `table` counts in column `size` how many rows each key will meet. A key with more than its share
    of all rows is hot: its rows are dealt over slots, and only its row of the table is copied to
    those slots. Shares are so large that there can't be more than `4 * slots` hot keys, whatever the
    rows, so the list of them is small. Without hot keys rows are shuffled as they are. Keys match
    null-safely. The table is stored once.
    """

    def __init__(self, table: DataFrame, on: list[str], size: str):
        spark = table.sparkSession
        shares = 4 * max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.on, self.key = on, F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(on)])
        self.table = stored(table, "keys")
        share = max(1, -(-(self.table.agg(F.sum(size).cast("decimal(38,0)")).first()[0] or 0) // shares))
        parts = F.ceil(F.col(size) / F.lit(int(share))).cast("int").alias("_parts")
        self.hot = cut_lineage(self.table.filter(F.col(size) > int(share)).select(self.key.alias("_key"), parts))
        self.has_hot = not self.hot.isEmpty()

    def _parts(self, keyed: DataFrame) -> DataFrame:
        return keyed.join(F.broadcast(self.hot), "_key", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))

    def dealt(self, rows: DataFrame, by: str) -> DataFrame:
        """`rows` with _key and _slot, the rows of a hot key dealt by the column `by`."""
        keyed = rows.withColumn("_key", self.key)
        if not self.has_hot:
            return keyed.withColumn("_slot", F.lit(0))
        slot = F.pmod(F.xxhash64(by), F.col("_parts")).cast("int")
        return self._parts(keyed).withColumn("_slot", slot).drop("_parts")

    def join(self, rows: DataFrame, by: str, *columns: str) -> DataFrame:
        """`rows` that have their key in the table, with its `columns`."""
        if not self.has_hot:
            names = [f"_k{i}" for i in range(len(self.on))]
            values = self.table.select(*[F.col(c).alias(k) for c, k in zip(self.on, names)], *columns)
            same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(self.on, names)]
            return rows.join(values, same).drop(*names)
        values = self.table.select(self.key.alias("_key"), *columns)
        copies = self._parts(values).withColumn("_slot", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
        return self.dealt(rows, by).join(copies, ["_key", "_slot"]).drop("_key", "_slot")
