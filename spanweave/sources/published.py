"""A folder of tables that change all at once, by video.

A table is a list of parts, each the rows of some videos; of a video the last part that names it counts.
A run writes parts for the videos that changed, with a digest for each, and then one manifest that lists
the parts of all tables.  Readers take the manifest of the greatest number, so they see the whole of one
run or nothing of it, and a run that ends half way leaves what was there.  The manifest gets its name by a
rename to one that must not exist: of two runs at once the second sees the first's.

Parts are sorted by video in short pages, so a read of few videos skips the pages of others; digests say what
changed without a read of the rows.  A table of ``MOST`` parts is written anew as one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.intervals import apart

#: Parts of a table beyond which it is made one.
MOST = 8
#: Manifests that are kept; data that none of them names is swept.
KEPT = 3
KEY = "video_id"
#: Rows of a page, which is the least that is read.
PAGE_ROWS = 500


def digest(df: DataFrame) -> DataFrame:
    """``video_id, h, n``: a sum over each video's rows whatever their order, and their number."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]))
    return df.groupBy(KEY).agg(F.sum(F.xxhash64(row).cast("decimal(38,0)")).alias("h"), F.count("*").alias("n"))


class Published:
    """The published tables of a folder, on any file system of Spark's."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self.number, self.parts = self.last()

    def path(self, name: str):
        return self.hadoop.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def last(self) -> tuple[int, dict[str, list[dict]]]:
        """Number and content of the last manifest."""
        numbers = [n for n in self.names("_published") if n.endswith(".json")]
        if not numbers:
            return 0, {}
        stream = self.fs.open(self.path(f"_published/{numbers[-1]}"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return int(numbers[-1].removesuffix(".json")), json.loads(text)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/_data/{name}")

    def resolved(self, parts: list[dict], kind: str, videos: list | None = None) -> DataFrame:
        """Rows (or digests) of the last part that names each video; of some videos, where they are named."""
        frames = []
        for i, part in enumerate(parts):
            df = self.read(part[kind])
            if videos is not None:
                df = df.where(F.col(KEY).isin(videos))
            if later := parts[i + 1 :]:
                df = df.join(reduce(DataFrame.unionByName, (self.read(p["digests"]).select(KEY) for p in later)), KEY, "left_anti")
            frames.append(apart(df) if len(parts) > 1 else df)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def table(self, name: str, videos: list | None = None) -> DataFrame:
        return self.resolved(self.parts[name], "rows", videos)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in self.parts}

    def digests(self) -> dict[str, DataFrame]:
        """``video_id, h, n`` of each table, as written with it."""
        return {name: self.resolved(parts, "digests").where("n > 0") for name, parts in self.parts.items()}

    def write(self, name: str, rows: DataFrame, videos: DataFrame | None) -> dict:
        """A part; ``videos`` are those that it stands for, also those without rows."""
        of = f"{name}-{uuid.uuid4().hex}"
        ranged = rows.repartitionByRange(KEY).sortWithinPartitions(KEY)
        ranged.write.option("parquet.page.row.count.limit", PAGE_ROWS).parquet(f"{self.folder}/_data/{of}")
        found = digest(self.read(of))
        if videos is not None:
            found = videos.select(KEY).distinct().join(found, KEY, "left").select(KEY, "h", F.coalesce("n", F.lit(0)).alias("n"))
        found.write.parquet(f"{self.folder}/_data/{of}-digests")
        return {"rows": of, "digests": f"{of}-digests"}

    def publish(self, changes: Mapping[str, tuple[DataFrame, DataFrame | None]]) -> int:
        """Publish (rows, videos) of tables: the rows take the place of all that these videos had; without videos, of all.

        The number of the manifest.  What fails before the last rename changes nothing for readers.
        """
        made: dict[str, dict] = {}
        for name, (rows, videos) in changes.items():
            made[name] = {"whole": videos is None, **self.write(name, rows, videos)}
        while True:
            self.number, self.parts = self.last()
            parts = dict(self.parts)
            for name, part in made.items():
                own = {k: part[k] for k in ("rows", "digests")}
                parts[name] = [own] if part["whole"] else [*parts.get(name, []), own]
                if len(parts[name]) >= MOST:
                    parts[name] = [self.write(name, self.resolved(parts[name], "rows"), None)]
            if self.named(self.number + 1, parts):
                break
        self.number, self.parts = self.number + 1, parts
        self.sweep({p[k] for p in made.values() for k in ("rows", "digests")})
        return self.number

    def named(self, number: int, parts: dict[str, list[dict]]) -> bool:
        """Write a manifest under its number; False where another run has taken it."""
        whole = self.path(f"_published/{number:010d}.json")
        part = self.path(f"_published/.{uuid.uuid4().hex}")
        out = self.fs.create(part)
        try:
            out.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
        finally:
            out.close()
        if not self.fs.exists(whole) and self.fs.rename(part, whole):
            return True
        self.fs.delete(part, False)
        return False

    def sweep(self, own: set[str]) -> None:
        """Delete manifests but the last ``KEPT``, and the data that only they named."""
        numbers = [n for n in self.names("_published") if n.endswith(".json")]
        old, gone, used = numbers[:-KEPT], set(), set(own)
        for n in numbers:
            stream = self.fs.open(self.path(f"_published/{n}"))
            try:
                listed = {p[k] for parts in json.loads(bytes(stream.readAllBytes()).decode()).values() for p in parts for k in ("rows", "digests")}
            finally:
                stream.close()
            (gone if n in old else used).update(listed)
        for name in gone - used:
            self.fs.delete(self.path(f"_data/{name}"), True)
        for n in old:
            self.fs.delete(self.path(f"_published/{n}"), False)
