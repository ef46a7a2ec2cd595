"""What the operators of this subpackage share: the shared folder, tables written to cut lineage, words and salted joins."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.session import file_system, shared_dir

#: A word: a run of code points other than blank and the ASCII control spaces.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A-Z to a-z and nothing else.
LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused folder below the one that `spark.checkpoint.dir` names and all executors share; without that setting this is an error.

    All folders of a session lie in one, which is removed when the session's JVM ends: results read them until then.
    """
    own = f"{shared_dir(spark)}/patronage-llm-{spark.sparkContext.applicationId}"
    system, path = file_system(spark, own)
    system.mkdirs(path)
    system.deleteOnExit(path)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: what stands above it is not computed twice, nor after the loss of an executor."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salted_join(left: DataFrame, right: DataFrame, on: list[str], salt: Column, salts: int = 16) -> DataFrame:
    """Left join to `right`, which is unique in `on`, with rows of one key of `left` spread over `salts` tasks by the hash of `salt`.

    Keys are compared by `=`, so a null key finds nothing; such rows spread too.
    """
    cell = F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int")
    spread = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", cell).join(spread, [*on, "_salt"], "left").drop("_salt")
