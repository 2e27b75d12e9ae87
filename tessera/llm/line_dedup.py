"""Line dedup: levelled sorted runs of line hashes (native).

A *run* is a Parquet table of (h1, h2, n_docs), bucketed and sorted by the
128-bit line hash. Documents come in batches; the distinct line keys of a batch are
counted (partial aggregates leave one row per key and task, so a line found
everywhere costs one row per task). A new batch is merged with each run on the
hash; keys whose counts in the runs already reach ``min_docs`` are left out
(nothing is left to learn about those), the others become a new run at level 0.
``fan_in`` runs of a level are compacted into one run of the next level by merging
them and summing their counts. All these joins are merges of sorted buckets: no row
of a run is shuffled or sorted again to be read (``spark.sql.shuffle.partitions``
at the first write sets the buckets). With a ``folder`` of its own, ``save`` and ``load``
keep the runs for later batches, also in another session.

Defined results: null or empty text is one empty line; the empty key is never
dropped; a key repeated inside one document counts once; repeated rows are
separate documents; an empty table gives an empty result; extra columns,
whatever their names, are carried through untouched.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm._common import ASCII_SPACE, CLEAN, ascii_lower, text_key
from tessera.session import own_table, shared_path

BATCHES = 4
FAN_IN = 2


def line_keys(text: Column) -> Column:
    """Array of keys, one per line: stripped at both ends, A-Z lower-cased."""
    lines = F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n", -1)
    return F.transform(lines, lambda x: F.btrim(x, F.lit(ASCII_SPACE)))


def _hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def _distinct_hashes(keys: Column) -> Column:
    return F.transform(F.filter(F.array_distinct(keys), lambda x: x != ""), _hash)


_KEY = ["h1", "h2"]
_SORTED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def _merged(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two runs as one: counts of the same key are added."""
    n = F.coalesce(F.col("n_docs"), F.lit(0)) + F.coalesce(F.col("more"), F.lit(0))
    return left.join(right.withColumnRenamed("n_docs", "more").hint("merge"), _KEY, "full").select(*_KEY, n.alias("n_docs"))


def _bucketed(rows: DataFrame, path: str, buckets: int) -> str:
    """Write a table bucketed and sorted by the line hash; its name. Spark may
    delete the job's shuffle files once it is written."""
    spark, name = rows.sparkSession, f"line_run_{uuid.uuid4().hex}"
    before = {key: spark.conf.get(key, "false") for key in (_SORTED, CLEAN)}
    try:
        for key in before:
            spark.conf.set(key, "true")
        rows.write.format("parquet").bucketBy(buckets, *_KEY).sortBy(*_KEY).option("path", path).saveAsTable(name)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return own_table(spark, name)


class LineRuns:
    """The levels: ``levels[i]`` holds up to ``fan_in - 1`` runs of level i, as paths."""

    def __init__(self, spark: SparkSession, min_docs: int, fan_in: int = FAN_IN, folder: str | None = None):
        self.spark, self.min_docs, self.fan_in, self.folder = spark, min_docs, fan_in, folder
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self._tables: dict[str, str] = {}
        self.version = 0

    @classmethod
    def load(cls, spark: SparkSession, folder: str, min_docs: int, fan_in: int = FAN_IN) -> LineRuns:
        """The runs last saved in ``folder``."""
        self = cls(spark, min_docs, fan_in, folder)
        saved = spark.read.parquet(f"{folder}/levels")
        # One row per run: their number grows with the logarithm of the batches.
        newest = saved.where(F.col("version") == saved.agg(F.max("version")).first()[0]).collect()
        self.version = newest[0].version
        self.buckets = newest[0].buckets
        for row in sorted(newest, key=lambda r: (r.level, r.place)):
            while len(self.levels) <= row.level:
                self.levels.append([])
            if row.path is not None:
                self.levels[row.level].append(row.path)
        return self

    def save(self) -> None:
        """Write which runs make up the levels; earlier states stay readable until then."""
        if self.folder is None:
            raise ValueError("runs without a folder of their own end with the session's scratch")
        self.version += 1
        rows = [(level, i, path, self.buckets) for level, paths in enumerate(self.levels) for i, path in enumerate(paths)]
        states = self.spark.createDataFrame(rows or [(0, 0, None, self.buckets)], "level int, place int, path string, buckets int")
        states.coalesce(1).write.parquet(f"{self.folder}/levels/version={self.version}")

    def _read(self, path: str) -> DataFrame:
        if path not in self._tables:
            name = f"line_run_{uuid.uuid4().hex}"
            self.spark.sql(
                f"CREATE TABLE {name} (h1 BIGINT, h2 BIGINT, n_docs BIGINT) USING parquet "
                f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
            self._tables[path] = own_table(self.spark, name)
        return self.spark.table(self._tables[path])

    def _write(self, rows: DataFrame, label: str) -> str:
        """A new run of rows that lie by bucket already: one file per bucket."""
        path = f"{self.folder}/{label}-{uuid.uuid4().hex}" if self.folder else shared_path(self.spark, label)
        self._tables[path] = _bucketed(rows, path, self.buckets)
        return path

    def runs(self) -> list[DataFrame]:
        return [self._read(path) for level in self.levels for path in level]

    def totals(self) -> DataFrame | None:
        """(h1, h2, n_docs) over all runs."""
        runs = self.runs()
        return reduce(_merged, runs) if runs else None

    def frequent(self) -> DataFrame | None:
        """Keys found in at least ``min_docs`` documents so far."""
        totals = self.totals()
        return None if totals is None else totals.where(F.col("n_docs") >= self.min_docs).select(*_KEY)

    def add(self, counts: DataFrame, dealt: bool = False) -> None:
        """Add a batch's (h1, h2, n_docs), one row per key: merge-anti-join, write,
        compact. ``dealt``: the rows lie by the runs' buckets already."""
        if not dealt:
            counts = counts.repartition(self.buckets, *_KEY)
        # The batch is the left side of every merge, so it keeps its place.
        known = F.lit(0)
        for i, run in enumerate(self.runs()):
            counts = counts.join(run.select(*_KEY, F.col("n_docs").alias(f"n{i}")).hint("merge"), _KEY, "left")
            known = known + F.coalesce(F.col(f"n{i}"), F.lit(0))
        self._push(0, counts.where(known < self.min_docs).select(*_KEY, "n_docs"))

    def _push(self, level: int, rows: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._write(rows, f"line-run-l{level}"))
        if len(self.levels[level]) >= self.fan_in:
            paths, self.levels[level] = self.levels[level], []
            # Two at a time: the keys of a merge of both sides carry no
            # partitioning that Spark knows, so each is written.
            while len(paths) > 2:
                two = _merged(self._read(paths.pop(0)), self._read(paths.pop(0)))
                paths.append(self._write(two, f"line-run-l{level}"))
            self._push(level + 1, _merged(*map(self._read, paths)))


def add_documents(runs: LineRuns, docs: DataFrame, text: str = "text", batches: int = 1) -> LineRuns:
    """Feed ``docs`` to the runs in ``batches`` batches; the text is read once, one
    exchange lays the counts of all batches by bucket."""
    keyed = docs.select(
        F.pmod(text_key(F.col(text))[0], F.lit(batches)).cast("int").alias("batch"),
        F.explode(_distinct_hashes(line_keys(F.col(text)))).alias("h"),
    )
    per_batch = [F.count_if(F.col("batch") == b).alias(f"n{b}") for b in range(batches)]
    counts = keyed.groupBy("h.h1", "h.h2").agg(*per_batch)
    if runs.buckets != int(runs.spark.conf.get("spark.sql.shuffle.partitions")):
        counts = counts.repartition(runs.buckets, *_KEY)  # else the grouping lays them by bucket
    name = _bucketed(counts, shared_path(runs.spark, "line-counts"), runs.buckets)
    for b in range(batches):
        batch = runs.spark.table(name).where(F.col(f"n{b}") > 0)
        runs.add(batch.select(*_KEY, F.col(f"n{b}").alias("n_docs")), dealt=True)
    return runs


def build_runs(docs: DataFrame, min_docs: int, text: str = "text", batches: int = BATCHES, fan_in: int = FAN_IN) -> LineRuns:
    """New runs of all lines of ``docs``."""
    return add_documents(LineRuns(docs.sparkSession, min_docs, fan_in), docs, text, batches)


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, text: str = "text", batches: int = BATCHES, fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: ``row`` (struct of all input columns), ``n_lines``,
    ``n_dropped`` (long) and ``kept`` (the other lines joined by newline)."""
    frequent = build_runs(docs, min_docs, text, batches, fan_in).frequent()
    col = F.col(text)
    # Where each distinct text has frequent lines: semi-join on the line hash
    # (a hot line's partition is split by AQE), then the places per text.
    placed = F.posexplode(F.transform(line_keys(col), lambda x: F.when(x != "", _hash(x)))).alias("place", "h")
    hits = (
        docs.select(*text_key(col), placed)
        .where("h IS NOT NULL")
        .select("k1", "k2", "place", "h.h1", "h.h2")
        .join(frequent, ["h1", "h2"], "left_semi")
        .groupBy("k1", "k2")
        .agg(F.collect_set("place").alias("bad"))
    )
    rows = docs.select(F.struct(*docs.columns).alias("row"), *text_key(col))
    body = F.coalesce(F.col("row").getField(text), F.lit(""))
    lines = F.split(body, "\n", -1)
    # The other places in order, by a hash set; the lines are bound to a name,
    # so that a text is split once. Linear in the number of lines.
    others = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("bad"))
    kept_lines = F.get(
        F.transform(F.array(F.struct(lines.alias("lines"), others.alias("places"))), lambda x: F.transform(x["places"], lambda p: F.get(x["lines"], p))), 0
    )
    n_lines = F.size(lines).cast("long")
    return (
        rows.join(hits, ["k1", "k2"], "left")
        .select(
            "row",
            n_lines.alias("n_lines"),
            F.when(F.col("bad").isNull(), F.array(body)).otherwise(kept_lines).alias("parts"),
            F.col("bad").isNull().alias("whole"),
        )
        .select(
            "row",
            "n_lines",
            F.when(F.col("whole"), F.lit(0)).otherwise(F.col("n_lines") - F.size("parts")).cast("long").alias("n_dropped"),
            F.array_join("parts", "\n").alias("kept"),
        )
    )


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of what is left."""
    return drop_frequent_lines(docs.select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


# DuckDB form of digest(documents).
DIGEST_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT rid, i, lines[i] AS line,
         trim(translate(lines[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM d, unnest(range(1, len(lines) + 1)) AS t(i)),
f AS (SELECT key FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10),
m AS (SELECT l.*, f.key IS NOT NULL AS bad FROM l LEFT JOIN f USING (key))
SELECT d.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE bad) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT bad), '')) AS kept_sha256
FROM d JOIN m USING (rid) GROUP BY d.rid, d.doc_id
"""
