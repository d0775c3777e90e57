"""Token totals by source, language and tokenizer version, kept up by signed deltas.

A batch is a table of signed rows: an insert adds a document's count, a delete takes it away, a
revision takes the old count away and adds the new one. Each batch is summed up first (map-side) and
stored as a folder of its own under its id, which Spark's writer commits as a whole. A batch that is
committed already is not written again, so a repeated or restarted batch changes nothing. Totals are
the sums over the committed batches; compaction folds them into a snapshot that names them.
"""

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "version")
DELTA = "source string, lang string, version string, docs long, tokens long"


def signed(docs: DataFrame, version: str, tokens, sign: int = 1, docs_too: bool = True) -> DataFrame:
    """Delta rows of documents: ``tokens`` (column or name) counted with ``sign``. Null counts are 0.
    A revision passes ``docs_too=False``, as the number of documents stays."""
    n = F.coalesce(F.col(tokens) if isinstance(tokens, str) else tokens, F.lit(0)).cast("long")
    return docs.select(
        "source",
        "lang",
        F.lit(version).alias("version"),
        F.lit(sign if docs_too else 0).cast("long").alias("docs"),
        (n * sign).alias("tokens"),
    )


def summed(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


@dataclasses.dataclass
class Totals:
    """A store of committed batches in the folder ``path``."""

    spark: SparkSession
    path: str

    def _exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _names(self, folder: str) -> list[str]:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(place):
            return []
        found = [x.getPath().getName() for x in files.listStatus(place)]
        return sorted(x for x in found if self._exists(f"{self.path}/{folder}/{x}/_SUCCESS"))

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Store a batch; False if this id is committed already. What an attempt without end left
        behind is overwritten."""
        if not batch or not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"not a batch id: {batch!r}")
        if self._exists(f"{self.path}/batches/{batch}/_SUCCESS") or batch in self._snapshot()[1]:
            return False
        summed(deltas).write.mode("overwrite").parquet(f"{self.path}/batches/{batch}")
        return True

    def committed(self) -> list[str]:
        return sorted({*self._names("batches"), *self._snapshot()[1]})

    def _snapshot(self) -> tuple[str | None, list[str]]:
        """Newest snapshot and the batches in it."""
        names = self._names("snapshots")
        if not names:
            return None, []
        path = f"{self.path}/snapshots/{max(names)}"
        return path, [r[0] for r in self.spark.read.parquet(f"{path}").select(F.explode("batches")).distinct().collect()]

    def _listed(self) -> tuple[str | None, list[str], list[str]]:
        """Newest snapshot, the batches in it, and the committed ones beside it."""
        path, held = self._snapshot()
        return path, held, [b for b in self._names("batches") if b not in held]

    def _summed(self, path: str | None, batches: list[str]) -> DataFrame:
        rows = self.spark.createDataFrame([], DELTA)
        if batches:
            folders = [f"{self.path}/batches/{b}" for b in batches]
            rows = rows.unionByName(self.spark.read.schema(DELTA).parquet(*folders))
        if path:
            rows = rows.unionByName(self.spark.read.parquet(path).drop("batches"))
        return summed(rows).where("docs <> 0 or tokens <> 0")

    def totals(self) -> DataFrame:
        """Totals of all committed batches; groups whose documents and tokens are all gone are left
        out. Null sources and languages are groups like others; no batch, no rows."""
        path, _, batches = self._listed()
        return self._summed(path, batches)

    def compact(self) -> None:
        """Fold all committed batches into a new snapshot; readers switch when it is whole. The batches
        are listed once: the snapshot sums and names the same ones, and a batch committed meanwhile is
        in neither."""
        path, held, batches = self._listed()
        number = f"{len(self._names('snapshots')) + 1:08d}"
        names = F.array(*(F.lit(b) for b in sorted({*held, *batches}))).cast("array<string>")
        kept = self._summed(path, batches).withColumn("batches", names)
        kept.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/snapshots/{number}")


# ---- tokenizers that Spark counts itself


def space_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def alnum_words(text: Column) -> Column:
    return F.regexp_count(
        F.coalesce(text, F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    )


def without_repeated_lines(text: Column) -> Column:
    return F.array_join(F.array_distinct(F.split(F.coalesce(text, F.lit("")), "\n")), "\n")


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, text_hash) with counts by two tokenizers, and by the second after a
    revision of the text that drops repeated lines."""
    return docs.select(
        "doc_id",
        "source",
        "lang",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash"),
        space_words(F.col("text")).cast("long").alias("space"),
        alnum_words(F.col("text")).cast("long").alias("alnum"),
        alnum_words(without_repeated_lines(F.col("text"))).cast("long").alias("alnum_revised"),
    )


def first_copies(counts: DataFrame) -> DataFrame:
    """One row per different text: that of the smallest doc_id (map-side combined)."""
    names = [c for c in counts.columns if c != "text_hash"]
    return counts.groupBy("text_hash").agg(F.min(F.struct(*names)).alias("x")).select("x.*")
