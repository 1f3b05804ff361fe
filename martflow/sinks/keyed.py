"""Changes of a stored table that rewrite only the folders they touch.

Rows lie in folders by a hash of their key. A change finds the folders that it
touches, reads those, and replaces them by one dynamic partition overwrite: new files
are written aside first and take the old ones' place when all tasks are done. Files of
other folders aren't opened, and a change that fails before that leaves the table as it
was. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martflow.operators import mutate
from martflow.sinks.writers import write

FOLDER = "_folder"


def with_folder(df: DataFrame, keys: Sequence[str], folders: int) -> DataFrame:
    return df.withColumn(FOLDER, F.pmod(F.xxhash64(*keys), F.lit(folders)).cast("int"))


class KeyedTable:
    """A Parquet table at ``path`` in ``folders`` folders by the hash of ``keys``.

    The number of folders is fixed by the first write; choose it for 100 MB to 1 GB a folder.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], folders: int):
        self.spark, self.path, self.keys, self.folders = spark, path, list(keys), folders

    def create(self, df: DataFrame) -> None:
        """Write ``df`` as the whole table; what was there goes."""
        whole = with_folder(df, self.keys, self.folders).hint("rebalance", FOLDER)
        write(whole, self.path, partition_by=[FOLDER], partitionOverwriteMode="static")

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(FOLDER)

    def find(self, key: Mapping[str, object]) -> DataFrame:
        """The rows of one key, from its folder alone."""
        stored = self._stored()
        values = [F.lit(key[name]).cast(stored.schema[name].dataType) for name in self.keys]
        folder = self.spark.range(1).select(F.pmod(F.xxhash64(*values), F.lit(self.folders))).head()[0]
        found = stored.where(F.col(FOLDER) == folder)
        for name, value in zip(self.keys, values):
            found = found.where(F.col(name).eqNullSafe(value))
        return found.drop(FOLDER)

    def _files(self, folder: int) -> set[str]:
        place = self._hadoop.Path(f"{self.path}/{FOLDER}={folder}")
        files = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return {x.getPath().getName() for x in files.listStatus(place)} if files.exists(place) else set()

    @property
    def _hadoop(self):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs

    def _aligned(self, df: DataFrame) -> DataFrame:
        """Columns in the table's order and types, so that equal keys hash alike."""
        return df.select(*[F.col(f.name).cast(f.dataType) for f in self.read().schema])

    def _replace(self, touched: list[int], change: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Rewrite the folders ``touched`` as ``change`` of their rows; those left without rows are removed."""
        if not touched:
            return []
        before = {folder: self._files(folder) for folder in touched}
        old = self._stored().where(F.col(FOLDER).isin(touched)).drop(FOLDER)
        dealt = with_folder(self._aligned(change(old)), self.keys, self.folders)
        # A row that falls elsewhere would replace a folder that was not read.
        wrong = F.raise_error(F.lit("a change may not move rows to other folders")).cast("int")
        checked = dealt.withColumn(FOLDER, F.when(F.col(FOLDER).isin(touched), F.col(FOLDER)).otherwise(wrong))
        write(checked.hint("rebalance", FOLDER), self.path, partition_by=[FOLDER], partitionOverwriteMode="dynamic")
        for folder, files in before.items():
            # The overwrite leaves a folder that gets no rows as it is; until it is removed here, running the change again heals.
            if files & self._files(folder):
                place = self._hadoop.Path(f"{self.path}/{FOLDER}={folder}")
                place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        return touched

    def upsert(self, source: DataFrame) -> list[int]:
        """Rows of ``source`` replace rows of the same key, others are added; the folders rewritten.

        A repeated key in ``source`` fails before anything is written.
        """
        source = mutate.require_unique(self._aligned(source), self.keys)
        dealt = with_folder(source, self.keys, self.folders)
        touched = sorted(row[FOLDER] for row in dealt.select(FOLDER).distinct().collect())  # at most one row a folder
        return self._replace(touched, lambda old: mutate.upsert(old, source, self.keys))

    def _hit(self, pred: Column) -> list[int]:
        hit = self._stored().where(F.coalesce(pred, F.lit(False)))
        return sorted(row[FOLDER] for row in hit.select(FOLDER).distinct().collect())

    def delete_where(self, pred: Column) -> list[int]:
        """Rows for which ``pred`` is true go; folders without such rows stay as they are."""
        return self._replace(self._hit(pred), lambda old: mutate.delete_where(old, pred))

    def update_where(self, pred: Column, values: Mapping[str, Column]) -> list[int]:
        """Set columns, other than keys, where ``pred`` is true."""
        if wrong := set(values) & set(self.keys):
            raise ValueError(f"keys can't be updated: {sorted(wrong)}")
        return self._replace(self._hit(pred), lambda old: mutate.update_where(old, pred, values))

    def overwrite_where(self, new: DataFrame, pred: Column) -> list[int]:
        """Rows for which ``pred`` is true go, and ``new`` comes in."""
        new = self._aligned(new)
        dealt = with_folder(new, self.keys, self.folders)
        coming = {row[FOLDER] for row in dealt.select(FOLDER).distinct().collect()}
        return self._replace(sorted(coming | set(self._hit(pred))), lambda old: mutate.overwrite_where(old, new, pred))
