"""Session settings."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# HotSpot leaves a Java method above 8000 bytes of bytecode to the interpreter, and compiles
# one near that size late. Spark's default lets a generated stage be eight times as long.
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_SPARK_DEFAULT = "65535"
_PREFERRED = "7000"

_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prefer_compiled_methods(spark: SparkSession) -> SparkSession:
    """Lets stages with a long generated method fall back to many short ones.

    The cleaning projections are such stages; they run about twice as fast that way. A limit
    that the session sets itself is left alone.
    """
    if spark.conf.get(_METHOD_LIMIT, _SPARK_DEFAULT) == _SPARK_DEFAULT:
        spark.conf.set(_METHOD_LIMIT, _PREFERRED)
    return spark


def side_by_side(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Runs steps that do not need each other at the same time, so that the last tasks of one leave no core idle.

    All are run to their end; the first that failed, in the order given, then raises its error. The first step runs in the
    caller's thread, as a step that writes to a data source registered in Python must: Spark knows those there only.
    """
    first, *others = steps
    with ThreadPoolExecutor(max(1, len(others))) as pool:
        # Each thread gets the caller's job group and other local properties.
        started = [pool.submit(inheritable_thread_target(spark)(step)) for step in others]
        first()
    for step in started:
        step.result()


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Within it, the shuffle files of a query go when the query ends, not when the driver happens to collect garbage."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


def local_session(cores: int = 8, memory: str = "8g", name: str = "chalkline") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
