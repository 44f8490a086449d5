"""Relational sink."""

from pyspark.sql import DataFrame


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str,
    connections: int,
    batch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Writer options: at most ``connections`` tasks write at a time, in batches
    of ``batch_size`` rows, and the table is emptied rather than dropped."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
        "truncate": "true",
        **extra,
    }


def write_jdbc(frame: DataFrame, options: dict[str, str]) -> None:
    """Replace the table; errors are raised to the caller.

    Rows are dealt to the connections by a shuffle, so that what comes before
    the write runs in as many tasks as it needs.
    """
    dealt = frame.repartition(int(options["numPartitions"]))
    dealt.write.format("jdbc").options(**options).mode("overwrite").save()
