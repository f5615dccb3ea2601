"""Tables an operator writes between its steps, in the folder every executor shares."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ordermill.session import work_folder

#: Whether Spark deletes a query's shuffle files at its end, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def held(df: DataFrame, label: str) -> DataFrame:
    """The rows as written files: lineage ends there, and later steps do not run the plan again. Nothing
    reads the shuffle files of the step from then on; they go at once, so that steps do not add up on disk."""
    path, conf = work_folder(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a step that one task takes where the step's size is known: some 15 MB with a sketch each.
ROWS_A_TASK = 50_000


def fewer(df: DataFrame, amount: int, each: int = ROWS_A_TASK) -> DataFrame:
    """The rows in one task for every ``each`` of ``amount``, in three a core at least, and never in more tasks
    than before: a small step starts no task and writes no file for every shuffle partition. To be
    called before Python takes the rows, or else each former partition starts it."""
    return df.coalesce(max(amount // each + 1, 3 * df.sparkSession.sparkContext.defaultParallelism))


def fresh(name: str, df: DataFrame) -> str:
    """A column name that ``df`` has not got, in any case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name in taken:
        name = f"_{name}"
    return name
