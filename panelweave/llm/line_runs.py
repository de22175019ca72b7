"""Line de-duplication with levelled, sorted runs of line hashes. DataFrame functions only.

Null and empty texts are one empty line. Every row is a document of its own;
rows that share the largest ``doc_id`` of a line all keep it, and a null
``doc_id`` never is the largest. Extra columns pass through inside a struct, so
their names clash with nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.shared import ascii_lower, ascii_strip, hash128, partitions
from panelweave.session import run_folder, stage

MIN_CHARS, MIN_DOCS = 20, 3
BATCHES = 4  # of the one-off query; a feed has as many as it likes
FANOUT = 3  # runs of one level that are compacted into one of the next

KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(ascii_strip(line))


def document_lines(docs: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, *keep, h1, h2): each document's distinct keys of at least ``MIN_CHARS``."""
    keys = F.array_distinct(F.filter(F.transform(lines_of(F.col("text")), ascii_strip), lambda x: F.length(x) >= MIN_CHARS))
    keys = F.array_distinct(F.transform(keys, ascii_lower))
    h1, h2 = hash128(F.col("key"))
    return docs.select("doc_id", *keep, F.explode(keys).alias("key")).select("doc_id", *keep, h1.alias("h1"), h2.alias("h2"))


class LineRuns:
    """The keys seen so far: sorted runs in levels, under the shared folder.

    ``fresh`` runs hold a key once, with the batch that first brought it;
    ``echoes`` hold how many more documents repeat it. Batches come in
    descending ``doc_id``, so a key's first batch has its largest ``doc_id``.
    Runs are bucketed and sorted by the hash: a batch is dealt out once and
    merge-joins every run where it lies. A run moves only when it is compacted.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.buckets = spark, partitions(spark)
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.folder = f"{run_folder(spark)}/{self.name}"
        self.levels: dict[str, list[list[str]]] = {"fresh": [], "echoes": []}
        self.made = 0

    def _write(self, rows: DataFrame, total: bool = False) -> str:
        self.made += 1
        name = f"{self.name}_{self.made}"
        dealt = rows.repartition(self.buckets, *KEY)
        if total:
            dealt = dealt.groupBy(*KEY).agg(F.sum("n").alias("n"))
        dealt.sortWithinPartitions(*KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.folder}/{self.made}").saveAsTable(name)
        return name

    def _drop(self, names: list[str]) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for name in names:
            self.spark.sql(f"drop table {name}")
            folder = path(f"{self.folder}/{name.rsplit('_', 1)[1]}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def runs(self, kind: str) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels[kind] for name in level]

    def _add(self, kind: str, name: str, level: int = 0) -> None:
        levels = self.levels[kind]
        if level == len(levels):
            levels.append([])
        levels[level].append(name)
        if len(levels[level]) == FANOUT:
            old, levels[level] = levels[level], []
            # read as plain files: a union of bucketed scans passes for dealt rows, and is not
            merged = self.spark.read.schema(self.spark.table(old[0]).schema).parquet(*[f"{self.folder}/{name.rsplit('_', 1)[1]}" for name in old])
            # a key can echo in many batches, but is fresh in one only
            self._add(kind, self._write(merged, total=kind == "echoes"), level + 1)
            self._drop(old)

    def add(self, batch: DataFrame) -> None:
        """Take a batch's (doc_id, h1, h2): unseen keys become its run, seen ones are counted."""
        own = self._write(batch.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top")))
        unseen, seen = self.spark.table(own), []
        for run in self.runs("fresh"):
            unseen = unseen.join(run.select(*KEY).hint("merge"), KEY, "left_anti")
            seen.append(self.spark.table(own).join(run.select(*KEY).hint("merge"), KEY, "left_semi").select(*KEY, "n"))
        if seen:
            echoes = seen[0]
            for more in seen[1:]:
                echoes = echoes.union(more)
            fresh = self._write(unseen)
            self._add("echoes", self._write(echoes))
            self._drop([own])
        else:
            fresh = own
        self._add("fresh", fresh)

    def common(self, least: int) -> DataFrame:
        """(h1, h2, top) of the keys in at least ``least`` documents; ``top`` is the largest ``doc_id``."""
        found = None
        for run in self.runs("fresh"):
            total = F.col("n")
            for k, echo in enumerate(self.runs("echoes")):
                run = run.join(echo.select(*KEY, F.col("n").alias(f"n{k}")).hint("merge"), KEY, "left")
                total = total + F.coalesce(F.col(f"n{k}"), F.lit(0))
            part = run.filter(total >= least).select(*KEY, "top")
            found = part if found is None else found.union(part)
        return found

    def close(self) -> None:
        for kind in self.levels:
            self._drop([name for level in self.levels[kind] for name in level])
            self.levels[kind] = []


def _batch_of(docs: DataFrame, batches: int) -> Column:
    """Which batch a ``doc_id`` falls in: 0 has the largest ids, nulls come last. Cuts are quantiles of the ids alone."""
    shares = [k / batches for k in range(1, batches)]
    cuts = docs.select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", shares, 0.01) if shares else []
    later = F.lit(0)
    for cut in cuts:
        later = later + F.when(F.col("doc_id") > F.lit(int(cut)), 0).otherwise(1)
    return later


def dropped_keys(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc_id, h1, h2) of every line that goes."""
    with_batch = docs.select("doc_id", "text", _batch_of(docs, batches).alias("batch"))
    lines = stage(document_lines(with_batch, "batch"))
    runs = LineRuns(docs.sparkSession)
    for k in range(batches):
        runs.add(lines.filter(F.col("batch") == k).select("doc_id", *KEY))
    common = stage(runs.common(MIN_DOCS))
    runs.close()
    return lines.join(common, KEY).filter(~F.col("doc_id").eqNullSafe(F.col("top"))).select("doc_id", *KEY)


def without_common_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(row, n_lines, n_dropped): each row of ``docs`` with the lines to keep in its ``text``.

    Dropped keys come to their document as two arrays, and a line goes if both
    of its hashes are there, so the lines themselves are never dealt out.
    """
    goes = dropped_keys(docs, batches).groupBy(F.col("doc_id").alias("of"))
    goes = stage(goes.agg(F.collect_set("h1").alias("d1"), F.collect_set("h2").alias("d2")))
    joined = docs.select(F.struct("*").alias("row"), "doc_id").join(goes, F.col("doc_id").eqNullSafe(F.col("of")), "left")

    def stays(line: Column) -> Column:
        h1, h2 = hash128(line_key(line))
        return ~((F.length(ascii_strip(line)) >= MIN_CHARS) & F.array_contains("d1", h1) & F.array_contains("d2", h2))

    lines = lines_of(F.col("row.text"))
    kept = F.when(F.col("d1").isNull(), lines).otherwise(F.filter(lines, stays))
    split = joined.select("row", F.size(lines).cast("bigint").alias("n_lines"), kept.alias("kept"))
    row = F.col("row").withField("text", F.array_join("kept", "\n"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length(F.array_join("kept", "\n")).cast("bigint"))
    return split.select(row.alias("row"), "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"))


def digest(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The query's columns: doc_id, n_lines, n_dropped, kept_sha256."""
    out = without_common_lines(docs.select("doc_id", "text"), batches)
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("row.text", 256).alias("kept_sha256"))


def thinned(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``docs`` without the lines that go; ``n_chars`` follows the text."""
    return without_common_lines(docs, batches).select("row.*")


SQL = r"""
with docs as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
lines as (select r, doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as pos from docs),
keyed as (select r, doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
common as (select k, max(doc_id) as top from keyed where length(k) >= 20 group by k having count(distinct r) >= 3),
marked as (select r, doc_id, line, pos, c.k is not null and doc_id is distinct from top as gone from keyed left join common c using (k))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by r, doc_id
"""
