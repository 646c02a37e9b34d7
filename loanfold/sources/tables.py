"""Named tables to read, from a catalog database, a folder of files, or frames at hand."""

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession


class Tables(Mapping):
    """Looks tables up by lower-case name; columns come out in lower case. Nothing is read until used."""

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._seen: dict[str, DataFrame] = {}

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> "Tables":
        return cls(lambda name: spark.table(f"{database}.{name}"))

    @classmethod
    def from_folder(cls, spark: SparkSession, folder: str, suffix: str = "") -> "Tables":
        """Parquet under folder/<name><suffix>."""
        return cls(lambda name: spark.read.parquet(f"{folder.rstrip('/')}/{name}{suffix}"))

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame]) -> "Tables":
        return cls(lambda name: frames[name])

    def __getitem__(self, name: str) -> DataFrame:
        name = name.lower()
        if name not in self._seen:
            df = self._load(name)
            self._seen[name] = df.toDF(*[c.lower() for c in df.columns])
        return self._seen[name]

    def __iter__(self):
        return iter(self._seen)

    def __len__(self) -> int:
        return len(self._seen)
