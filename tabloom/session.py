"""Session settings the jobs are written for."""

from pyspark.sql import SparkSession


def local_session(cores="*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks on one machine.

    On a cluster the session comes from the submit command; the only settings
    the operators rely on there are adaptive execution (on by default) and
    ``spark.checkpoint.dir``.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
