"""Run under local[4,3]: the first attempt of every other task fails; results must not change."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import pandas as pd  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import BooleanType  # noqa: E402

from faceoff import schemas  # noqa: E402
from faceoff.operators import reports as R  # noqa: E402
from faceoff.operators import tables as T  # noqa: E402
from faceoff.operators.ranking import global_row_number  # noqa: E402
from faceoff.session import build_session  # noqa: E402


@F.pandas_udf(BooleanType())
def flaky(s: pd.Series) -> pd.Series:
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return pd.Series([True] * len(s))


def main() -> None:
    spark = build_session(master="local[4,3]", extra={"spark.ui.showConsoleProgress": "false"})
    df = spark.range(20000).repartition(8).filter(flaky("id")).select(
        (F.col("id") % 7).alias("a"), (F.col("id") % 1000).alias("b"), F.lit("x").alias("c")
    )
    rows = global_row_number(df, [R.desc("a"), "b"]).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, 20001)), "positions"
    keys = [(-r.a, r.b) for r in rows]
    assert keys == sorted(keys), "order"

    db = T.create_database(spark, "retry")
    name = f"{db}.users"
    T.create_keyed_table(spark, name, schemas.USERS, "Username", buckets=8)
    users = spark.range(500).repartition(4).filter(flaky("id")).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("Username"),
        F.lit("p").alias("Password"), F.lit("basic").alias("UserType"), F.lit("est").alias("Timezone"),
    )
    T.append_rows(spark, name, users)
    changes = spark.range(0, 500, 5).repartition(4).filter(flaky("id")).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("Username"), F.lit("pst").alias("Timezone")
    )
    T.update_by_key(spark, name, changes)
    got = {r.Username: r.Timezone for r in T.read_table(spark, name).collect()}
    assert len(got) == 500, "row count"
    assert all((tz == "pst") == (int(u[1:]) % 5 == 0) for u, tz in got.items()), "updated rows"
    print("RETRY-OK")
    spark.stop()


if __name__ == "__main__":
    main()
