"""Reading, checking, writing and registering tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chorale.columns import EVENT, IS_TRAIN, TIME
from chorale.sources import schemas


def conform(df: DataFrame, schema: T.StructType, keep_types: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the columns of ``schema``, cast to its types; absent columns become nulls.

    Columns named in ``keep_types`` keep the type they have.
    """
    columns = []
    for field in schema.fields:
        if field.name not in df.columns:
            column = F.lit(None).cast(field.dataType)
        elif field.name in keep_types:
            column = F.col(field.name)
        else:
            column = F.col(field.name).cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def read_interactions(spark: SparkSession, path: str) -> DataFrame:
    """An event table. The time may be a timestamp or a number of seconds; an event id
    is taken along where there is one, further columns are never read."""
    found = spark.read.parquet(path)
    optional = {EVENT} - set(found.columns)
    wanted = [field for field in schemas.INTERACTIONS.fields if field.name not in optional]
    return conform(found, T.StructType(wanted), keep_types=(TIME,))


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.parquet(path), schemas.TRACKS)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.parquet(path), schemas.USERS)


def load_ratings(spark: SparkSession, path: str) -> DataFrame:
    """A table of counted pairs."""
    return conform(spark.read.parquet(path), schemas.RATINGS)


def write_table(df: DataFrame, path: str) -> None:
    """Parquet at ``path``, replacing what is there."""
    df.write.mode("overwrite").parquet(path)


def write_split(tagged: DataFrame, path: str) -> None:
    """Both sides of a split in one job, as partitions ``split=train`` and ``split=validation``."""
    side = F.when(F.col(IS_TRAIN), F.lit("train")).otherwise(F.lit("validation"))
    tagged.withColumn("split", side).drop(IS_TRAIN).write.mode("overwrite").partitionBy(
        "split"
    ).parquet(path)


def load_split(spark: SparkSession, path: str, side: str) -> DataFrame:
    """One side of a written split; the other side's files are not read."""
    return spark.read.parquet(path).where(F.col("split") == side).drop("split")


def write_files(df: DataFrame, path: str, n_files: int = 1) -> None:
    """``n_files`` parquet files of about equal length; one, unless the caller wants more.

    Rows are spread by hash before, so that the tasks that make them stay as many as
    they are; only the writing is done by ``n_files`` tasks.
    """
    spread = df.repartition(n_files, F.xxhash64(*df.columns))
    spread.write.mode("overwrite").parquet(path)


MANIFEST = "_inputs.json"


def _where(spark: SparkSession, path: str, name: str | None = None):
    """The file system of a path, and the path (or ``name`` in it)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    found = hadoop(path) if name is None else hadoop(path, name)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), found


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a finished write lies at ``path`` (it leaves a success mark)."""
    files, mark = _where(spark, path, "_SUCCESS")
    return files.exists(mark)


def manifest(spark: SparkSession, inputs: Sequence[str], **parameters: object) -> str:
    """What a table is made from: each input file with its size and time, and parameters."""
    listed = []
    for path in inputs:
        files, root = _where(spark, path)
        found = files.listFiles(root, True)
        while found.hasNext():
            file = found.next()
            listed.append([file.getPath().toString(), file.getLen(), file.getModificationTime()])
    return json.dumps({"inputs": sorted(listed), "parameters": parameters}, sort_keys=True, default=str)


def _read_manifest(spark: SparkSession, path: str) -> str | None:
    files, file = _where(spark, path, MANIFEST)
    if not files.exists(file):
        return None
    stream = files.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write_manifest(spark: SparkSession, path: str, text: str) -> None:
    files, file = _where(spark, path, MANIFEST)
    stream = files.create(file, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def is_current(spark: SparkSession, path: str, made_from: str) -> bool:
    """Whether a finished write at ``path`` was made from just that (see ``manifest``)."""
    return is_written(spark, path) and _read_manifest(spark, path) == made_from


def build_once(spark: SparkSession, path: str, made_from: str, build: Callable[[], None]) -> bool:
    """Calls ``build``, which writes ``path``, unless what is there was made from the same
    inputs and parameters; true if it was called. The manifest is written last, so a write
    that broke off is made anew."""
    if is_current(spark, path, made_from):
        return False
    build()
    _write_manifest(spark, path, made_from)
    return True


def materialize(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], made_from: str | None = None
) -> DataFrame:
    """The table at ``path``; ``build`` is called and written there only if it is missing, or,
    with ``made_from``, if it was made from anything else."""
    if made_from is not None:
        build_once(spark, path, made_from, lambda: write_table(build(), path))
    elif not is_written(spark, path):
        write_table(build(), path)
    return spark.read.parquet(path)


def write_results(results: DataFrame, path: str) -> None:
    """A tuning results table, one row per grid point, as one CSV file with a header line."""
    results.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


@dataclass(frozen=True)
class Dataset:
    """Where the tables of one data set lie. ``variant`` is ``small`` or ``full``.

    Fixed values: the file names of the input tables.

    Inputs are under ``root``, derived tables under ``work``. The small variant
    has train tables of its own; the test tables are the same for both.
    """

    root: str
    work: str
    variant: str = "full"

    def __post_init__(self) -> None:
        if self.variant not in ("small", "full"):
            raise ValueError(f"variant must be 'small' or 'full', not {self.variant!r}")

    @property
    def suffix(self) -> str:
        return "_small" if self.variant == "small" else ""

    @property
    def has_test(self) -> bool:
        return self.variant == "full"

    def input(self, table: str, part: str = "train") -> str:
        """Path of ``interactions``, ``tracks`` or ``users``, part ``train`` or ``test``."""
        suffix = self.suffix if part == "train" else ""
        return f"{self.root}/{table}_{part}{suffix}.parquet"

    def split(self, ratio: float = 0.8) -> str:
        """The split's counted pairs, both sides; another ratio has another path."""
        return f"{self.work}/split{self.suffix}-{ratio}.parquet"

    @property
    def test(self) -> str:
        return f"{self.work}/test.parquet"

    @property
    def results(self) -> str:
        return f"{self.work}/results{self.suffix}.csv"

    def sample(self, side: str) -> str:
        return f"{self.work}/{side}_sample{self.suffix}.parquet"
