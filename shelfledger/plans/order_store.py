"""Order documents stored in buckets of the order number.

Order lines, receipts and allocations are written once, each in the same number of buckets by the number of
their order. Reports over them join bucket by bucket: no row is shuffled by order number again, however often
they run. Rows that are dealt by one join key may meet on more: storing and reporting set
``spark.sql.requireAllClusterKeysForCoPartition=false``. Receipts without an order number meet none and are not stored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from shelfledger.plans.supply_chain import Documents, documents
from shelfledger.session import shuffles_freed

#: Column of the order number in each stored table.
ORDER_NUMBER = {"orders": "POM_RefNo", "receipts": "GRC_PORefNo", "allocations": "POCFT_RefNo"}


def store(tables: Mapping[str, DataFrame], name: str, buckets: int, path: str | None = None) -> Documents:
    """Writes catalog tables ``{name}_orders``, ``{name}_receipts`` and ``{name}_allocations`` and returns them.

    Labels of items and branches are those of the day of storing. A table of that name is replaced. A
    bucket should be about as large as a shuffle partition; an order is never split, so a
    hot order number makes one large bucket. ``path``: the folder for the files, by default the warehouse.
    """
    made = documents(tables, buckets)
    spark = made.orders.sparkSession
    for kind, number in ORDER_NUMBER.items():
        rows = getattr(made, kind)
        # joined in the partitioning of the buckets, so that a task writes its whole bucket and not a piece of each
        writer = rows.write.mode("overwrite").option("compression", "zstd").bucketBy(buckets, number).sortBy(number)
        with shuffles_freed(spark):
            (writer.option("path", f"{path}/{kind}") if path else writer).saveAsTable(f"{name}_{kind}")
    return read(spark, name)


def read(spark: SparkSession, name: str) -> Documents:
    told = spark.sql(f"DESCRIBE EXTENDED {name}_orders").filter("col_name = 'Num Buckets'").first()
    return Documents(*[spark.table(f"{name}_{kind}") for kind in ORDER_NUMBER], buckets=int(told["data_type"]))
