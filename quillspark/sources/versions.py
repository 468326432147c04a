"""An index in a directory: immutable Parquet batches, and one small row per committed version.

Layout under ``path``::

    versions/V.json                        one row per commit, created last and never overwritten
    docs/batch=N/doc_bucket=B/             clustered by hash of the key
    postings/batch=N/field=F/term_bucket=B/  clustered by hash of the term, sorted by term and key; pairs of frequent
                                           words are terms of a field F+pairs
    tiers/batch=N/field=F/term_bucket=B/   how many postings of a frequent term are in each tier, for the fields that have them
    ranges/field=F/batch=N/part=P/         values and keys of a field, in folders by ranges of the value
    summaries/batch=N/                     count, extremes and sketches of the fields that have a summary
    grams/batch=N/field=F/gram_bucket=B/   pieces of three letters to terms, for the fields that have it
    terms/batch=N/field=F/term_bucket=B/   the batch's vocabulary; what a delete takes away has counts below zero
    deletes/batch=N/                       keys removed from batches before N
    stem_maps/tokenizer=T/

A commit writes new files only, under a batch number of its own, and is visible once its row is there; a job that
fails before that leaves the previous version as it was. Of two writers that start from one version, one commits and
the other gets a ``CommitConflict``. A row lists what its commit added; every ``SNAPSHOT_EVERY`` versions one lists all,
so opening reads a bounded number of rows and the log grows in proportion to the commits.

The shuffles that cluster a batch are ``rebalance`` hints, so AQE splits the directory of a very
frequent term over several tasks and files, and joins small ones, by their real sizes.
"""

from __future__ import annotations

import datetime as dt
import json
import secrets
from collections.abc import Callable
from collections.abc import Mapping as Dict
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.errors import CommitConflict, MappingError
from quillspark.functions import analysis
from quillspark.functions.coerce import coerce
from quillspark.mapping import Mapping
from quillspark.plans.compile import BROADCAST_KEYS, matches
from quillspark.plans.query import Query, Term
from quillspark.sources import tables
from quillspark.sources.index import Index

TERM_BUCKETS = 8
DOC_BUCKETS = 8
SNAPSHOT_EVERY = 32
# Batch numbers grow with the version; the rest is drawn, so that two attempts never share a folder.
ATTEMPTS = 1 << 24

_VERSION_ROW = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("mapping", T.StringType()),
        T.StructField("key_type", T.StringType()),
        T.StructField("term_buckets", T.IntegerType()),
        T.StructField("doc_buckets", T.IntegerType()),
        T.StructField("stem_maps", T.ArrayType(T.StringType())),
        T.StructField("batches", T.ArrayType(T.LongType())),
        T.StructField("deletes", T.ArrayType(T.LongType())),
        T.StructField("terms", T.ArrayType(T.LongType())),
        T.StructField("whole", T.BooleanType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("tokens", T.StringType()),
        T.StructField("streams", T.StringType()),
        T.StructField("paired", T.StringType()),
        T.StructField("lengths", T.StringType()),
        T.StructField("deleted", T.LongType()),
        T.StructField("cuts", T.StringType()),
        T.StructField("committed_at", T.StringType()),
    ]
)


@dataclass
class _Version:
    version: int
    mapping: Mapping
    key_type: str
    term_buckets: int
    doc_buckets: int
    stem_maps: list[str]
    batches: list[int]
    deletes: list[int]
    terms: list[int]
    n_docs: int
    tokens: dict[str, int]
    # The last batch of each stream that is in this version.
    streams: dict[str, int]
    # The words of each field whose pairs every batch has; None until there is a batch.
    paired: dict[str, list[str]] | None = None
    # The lengths that tiers of postings are made with.
    lengths: dict[str, float] | None = None
    # At most so many keys are listed as deleted; None if that is not known.
    deleted: int | None = None
    # What parts the ranges of the fields whose values are kept by range.
    cuts: dict[str, list[str]] | None = None


class IndexDirectory:
    """Creates, changes and opens the versions of one index. Buckets are fixed at creation: aim at a
    few hundred MB of postings per bucket (thousands of buckets for a corpus of many TB)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- versions ----------------------------------------------------------------------------

    def versions(self) -> DataFrame:
        """The commit log, one row per version."""
        return self.spark.read.schema(_VERSION_ROW).json(f"{self.path}/versions")

    def _file(self, version: int):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions/{version:012d}.json")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _latest(self) -> int | None:
        path, system = self._file(0)
        if not system.exists(path.getParent()):
            return None
        names = [f.getPath().getName() for f in system.listStatus(path.getParent())]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=None)

    def _row(self, version: int) -> dict | None:
        path, system = self._file(version)
        if not system.exists(path):
            return None
        stream = system.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8") or "null")
        finally:
            stream.close()

    def _load(self, version: int | None = None) -> _Version | None:
        at = self._latest() if version is None else version
        while version is None and at and self._row(at) is None:
            at -= 1  # an empty file: its writer died before rows were put there as a whole
        rows = []
        while at is not None:
            row = self._row(at)
            if row is None:
                return None
            rows.append(row)
            if row["whole"]:
                break
            at -= 1
        if not rows:
            return None
        found = rows[0] | {k: [n for row in reversed(rows) for n in row[k]] for k in ("batches", "deletes", "terms")}
        for name in ("committed_at", "whole"):
            found.pop(name)
        found["mapping"] = Mapping.from_json(found["mapping"])
        found.setdefault("deleted", None)
        found["tokens"], found["streams"] = json.loads(found["tokens"]), json.loads(found["streams"])
        found["paired"], found["lengths"] = (json.loads(found.get(k) or "null") for k in ("paired", "lengths"))
        found["cuts"] = json.loads(found.get("cuts") or "null")
        return _Version(**found)

    def _commit(self, v: _Version, since: _Version | None) -> int:
        """``since`` is the version this one adds to; None where it starts anew."""
        whole = since is None or v.version % SNAPSHOT_EVERY == 0
        added = lambda name: getattr(v, name)[0 if whole else len(getattr(since, name)) :]
        row = {
            "version": v.version, "mapping": v.mapping.to_json(), "key_type": v.key_type, "term_buckets": v.term_buckets,
            "doc_buckets": v.doc_buckets, "stem_maps": v.stem_maps, "batches": added("batches"), "deletes": added("deletes"),
            "terms": added("terms"), "whole": whole, "n_docs": v.n_docs, "tokens": json.dumps(v.tokens),
            "streams": json.dumps(v.streams), "paired": json.dumps(v.paired),
            "lengths": json.dumps(v.lengths), "deleted": v.deleted,
            "cuts": json.dumps(v.cuts), "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(),
        }
        path, system = self._file(v.version)
        self._put(path, json.dumps(row).encode(), v.version)
        return v.version

    def _put(self, path, data: bytes, version: int) -> None:
        """The row is there as a whole or not at all: it is written aside and renamed, which fails if it is there already."""
        package = self.spark._jvm.org.apache.spark.sql.execution.streaming.checkpointing
        managers = getattr(getattr(package, "CheckpointFileManager$"), "MODULE$")
        manager = managers.create(path.getParent(), self.spark.sparkContext._jsc.hadoopConfiguration())
        manager.mkdirs(path.getParent())
        system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if system.exists(path) and not system.getFileStatus(path).getLen():
            system.delete(path, False)
        out = manager.createAtomic(path, False)
        try:
            out.write(bytearray(data))
        except Py4JJavaError:
            out.cancel()
            raise
        try:
            out.close()
        except Py4JJavaError as error:
            raise CommitConflict(f"version {version} of {self.path} is there already") from error

    def exists(self) -> bool:
        return self._load() is not None

    def current_version(self) -> int:
        return self._require().version

    def _require(self, version: int | None = None) -> _Version:
        found = self._load(version)
        if found is None:
            raise FileNotFoundError(f"no index version at {self.path}" + (f": {version}" if version is not None else ""))
        return found

    # -- creating and reading ----------------------------------------------------------------

    def create(
        self,
        mapping: Mapping,
        key_type: T.DataType | None = None,
        term_buckets: int = TERM_BUCKETS,
        doc_buckets: int = DOC_BUCKETS,
        stem_maps: Dict[str, DataFrame] | None = None,
    ) -> IndexDirectory:
        """Create an empty index, or keep the one that is there."""
        if self.exists():
            return self
        for tokenizer, words in (stem_maps or {}).items():
            words.select("term", "stem").write.mode("overwrite").parquet(f"{self.path}/stem_maps/tokenizer={tokenizer}")
        kind = (key_type or T.LongType()).simpleString()
        self._commit(
            _Version(0, mapping, kind, term_buckets, doc_buckets, sorted(stem_maps or {}), [], [], [], 0, {}, {}, deleted=0), None
        )
        return self

    def open(self, version: int | None = None) -> Index:
        """The current version, or an earlier one; later commits do not show in it."""
        return self._index(self._require(version))

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """What a later version has other than an earlier one: ``change``, the key and the fields kept with documents.

        A ``removed`` row is a document of the earlier version as it was there, an ``added`` row one of the later version; a
        replaced document has both. Only the batches and lists of deleted keys that were committed in between are read, and
        the documents with those keys. Between the two no batches may have been folded."""
        a, b = self._require(since), self._require(until)
        if a.version > b.version or not set(a.batches) <= set(b.batches):
            raise ValueError(f"versions {a.version} and {b.version} are not apart by additions and deletions alone")
        key = a.mapping.key
        schema = T.StructType([T.StructField(key, T._parse_datatype_string(a.key_type))])
        gone = self._read("deletes", [d for d in b.deletes if d not in a.deletes], schema).select(key).distinct()
        removed = self._index(a).docs_of(gone, "left_semi")
        added = self._index(replace(b, batches=[n for n in b.batches if n not in a.batches])).docs
        columns = [F.col(key), *(F.col(f"`{f.name}`") for f in a.mapping.doc_fields)]
        return removed.select(F.lit("removed").alias("change"), *columns).unionByName(added.select(F.lit("added").alias("change"), *columns))

    def commits(self) -> DataFrame:
        """The commit log as a stream: a row for each version, as it is committed."""
        return self.spark.readStream.schema(_VERSION_ROW).json(f"{self.path}/versions")

    def _read(self, table: str, batches: list[int], schema: T.StructType) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/{table}/batch={b}" for b in batches]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}").parquet(*paths)

    def _stem_maps(self, v: _Version) -> dict[str, DataFrame]:
        return {
            t: self.spark.read.schema("term string, stem string").parquet(f"{self.path}/stem_maps/tokenizer={t}")
            for t in v.stem_maps
        }

    def _index(self, v: _Version) -> Index:
        key, key_type = v.mapping.key, T._parse_datatype_string(v.key_type)
        batch = T.StructField("batch", T.LongType())
        bucket = T.StructField("term_bucket", T.IntegerType())
        docs = tables.docs_schema(v.mapping, key_type).add(batch).add("doc_bucket", T.IntegerType())
        postings = tables.postings_schema(v.mapping, key_type)
        if v.mapping.tiered:
            postings = postings.add("tier", T.IntegerType())
        postings = postings.add(batch).add(bucket)
        terms = T.StructType(
            [T.StructField("field", T.StringType()), T.StructField("term", T.StringType()),
             T.StructField("df", T.LongType()), T.StructField("cf", T.LongType()), batch, bucket]
        )
        live = {"docs": self._read("docs", v.batches, docs), "postings": self._read("postings", v.batches, postings)}
        for f in v.mapping.ranged:
            schema = T.StructType([T.StructField(key, key_type), T.StructField(f, v.mapping.field(f).spark_type), batch])
            live[f"values of {f}"] = self._read(f"ranges/field={f}", v.batches, schema.add("part", T.IntegerType()))
        if v.deletes:
            gone = self._read("deletes", v.deletes, T.StructType([T.StructField(key, key_type), batch]))
            if v.deleted is not None and v.deleted <= BROADCAST_KEYS:
                gone = F.broadcast(gone.withColumnRenamed("batch", "before"))
            else:
                gone = gone.groupBy(key).agg(F.max("batch").alias("before"))
            for name, rows in live.items():
                dead = (rows[key] == gone[key]) & (rows["batch"] < gone["before"])
                live[name] = rows.join(gone, dead, "left_anti")
        vocabulary = self._read("terms", v.terms, terms).drop("batch")
        if len(v.terms) > 1:
            vocabulary = vocabulary.groupBy("field", "term", "term_bucket").agg(
                F.sum("df").alias("df"), F.sum("cf").alias("cf")
            )
        if any(t < 0 for t in v.terms):
            vocabulary = vocabulary.filter("df > 0")
        return Index(
            self.spark, v.mapping, live["docs"].drop("batch"), live["postings"].drop("batch"), vocabulary,
            (v.n_docs, v.tokens), v.term_buckets, v.doc_buckets, self._stem_maps(v), v.paired, self._grams(v),
            self._tiers(v), v.lengths, self._summaries(v),
            {f: live[f"values of {f}"].drop("batch") for f in v.mapping.ranged}, v.cuts,
        )

    def _summaries(self, v: _Version) -> DataFrame | None:
        """Summaries of fields, a row per batch; none while documents of a batch are deleted."""
        if not v.mapping.summarized or v.deletes:
            return None
        schema = T._parse_datatype_string(tables.SUMMARY).add("batch", T.LongType())
        return self._read("summaries", v.batches, schema).drop("batch")

    def _tiers(self, v: _Version) -> DataFrame | None:
        """Counts of postings by tier; none while deleted documents are among them."""
        if not v.mapping.tiered or v.deletes or not v.batches:
            return None
        schema = "field string, term string, tiers array<struct<tier:int,n:bigint>>, batch bigint, term_bucket int"
        return self._read("tiers", v.batches, T._parse_datatype_string(schema)).drop("batch")

    def _grams(self, v: _Version) -> DataFrame | None:
        """Pieces to terms, of every batch's vocabulary."""
        if not v.mapping.grammed:
            return None
        schema = T._parse_datatype_string("field string, gram string, term string, batch bigint, gram_bucket int")
        return self._read("grams", [t for t in v.terms if t > 0], schema).drop("batch")

    # -- changing ----------------------------------------------------------------------------

    def append(self, records: DataFrame, stream_batch: tuple[str, int] | None = None) -> int:
        """Add a batch and commit; all of it or, if a value does not parse or a key is not new, none of it."""
        return self._change(records, None, stream_batch)

    def delete(self, field: str, value) -> int:
        """Delete the documents whose field is exactly this value and commit."""
        return self.delete_matching(Term(field, value))

    def delete_matching(self, query: Query) -> int:
        """Delete every document a query matches and commit."""
        return self._change(None, lambda index: matches(query, index).select(index.mapping.key), None)

    def upsert(self, records: DataFrame, stream_batch: tuple[str, int] | None = None, order_by: str | None = None) -> int:
        """Replace the documents with these keys, adding those that are new, in one commit.

        With ``order_by``, a field kept with the documents, the largest value of a key wins, among the records (of equal
        ones any) and against what is indexed: an older record changes nothing. Without it keys must not repeat."""
        if order_by is not None:
            records = self._newer(records, order_by)

        def replaced(index: Index) -> DataFrame:
            keys = records.select(index.mapping.key).distinct()
            return index.docs_of(keys, "left_semi").select(index.mapping.key)

        return self._change(records, replaced, stream_batch)

    def _newer(self, records: DataFrame, order_by: str) -> DataFrame:
        """The newest record of each key, unless a newer one is indexed. Nulls are the oldest."""
        v = self._require()
        key = v.mapping.key
        if not v.mapping.has(order_by) or v.mapping.field(order_by) not in v.mapping.doc_fields:
            raise MappingError(f"records cannot be ordered by {order_by}: it is not kept with the documents")
        last = Window.partitionBy(key).orderBy(F.col(order_by).desc_nulls_last())
        newest = records.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").drop("_rank")
        if not v.batches:
            return newest
        index = self._index(v)
        known = index.docs_of(newest.select(key)).select(F.col(key), F.col(f"`{order_by}`").alias("_known"))
        mine = coerce(newest.select(key, order_by), Mapping.build([v.mapping.field(order_by)], key=key)).select(
            F.col(key), F.col(f"`{order_by}`").alias("_mine")
        )
        newer = mine.join(known, key, "left").filter("_known is null or _mine >= _known").select(key)
        return newest.join(newer, key, "left_semi")

    def replace(self, query: Query, records: DataFrame) -> int:
        """Delete what a query matches and add a batch, both visible together."""
        return self._change(records, lambda index: matches(query, index).select(index.mapping.key), None)

    def _change(
        self,
        records: DataFrame | None,
        victims: Callable[[Index], DataFrame] | None,
        stream_batch: tuple[str, int] | None,
    ) -> int:
        since = self._require()
        n = (since.version + 1) * ATTEMPTS + secrets.randbelow(ATTEMPTS)
        v = replace(since, version=since.version + 1, tokens=dict(since.tokens), streams=dict(since.streams))
        if victims is not None and v.batches:
            self._remove(v, n, victims)
        if records is not None:
            self._write_batch(v, n, records)
        if stream_batch is not None:
            v.streams[stream_batch[0]] = stream_batch[1]
        return self._commit(v, since)

    def _remove(self, v: _Version, n: int, victims: Callable[[Index], DataFrame]) -> None:
        """Lists the keys to remove, and writes what they take from the vocabulary as counts below zero: only the
        removed documents are read again, never the remaining ones."""
        where, key = f"{self.path}/deletes/batch={n}", v.mapping.key
        index = self._index(v)
        victims(index).select(key).distinct().write.parquet(where)
        gone = self.spark.read.schema(T.StructType([T.StructField(key, T._parse_datatype_string(v.key_type))])).parquet(where)
        removed = gone.count()
        if not removed:
            return
        self._write_terms(self._terms_of(index, gone).withColumns({"df": -F.col("df"), "cf": -F.col("cf")}), v, -n)
        v.deletes, v.terms, v.n_docs = [*v.deletes, n], [*v.terms, -n], v.n_docs - removed
        v.deleted = None if v.deleted is None else v.deleted + removed
        self._count_tokens(v, -n)

    def _terms_of(self, index: Index, keys: DataFrame) -> DataFrame:
        """The vocabulary of the documents with these keys: from their stored text if all of it is kept, and else from
        their postings."""
        kept = {f.name for f in index.mapping.doc_fields}
        if kept.issuperset(tables.indexed_fields(index.mapping)):
            documents = index.docs_of(keys, "left_semi")
            return tables.terms_table(tables.postings_table(documents, index.mapping, index.stem_maps))
        return tables.terms_table(index.postings.join(keys, index.mapping.key, "left_semi"))

    def _count_tokens(self, v: _Version, n: int) -> None:
        for name, tokens in self._token_counts([n]).items():
            v.tokens[name] = v.tokens.get(name, 0) + tokens

    def _token_counts(self, numbers: list[int]) -> dict[str, int]:
        schema = "field string, cf bigint, batch bigint, term_bucket int"
        rows = self._read("terms", numbers, T._parse_datatype_string(schema)).groupBy("field").agg(F.sum("cf").alias("n"))
        return {r["field"]: r["n"] for r in rows.collect()}

    def _write_batch(self, v: _Version, n: int, records: DataFrame) -> None:
        key = v.mapping.key
        before = self._index(v) if v.batches else None
        documents = coerce(records, v.mapping)
        docs = tables.docs_table(documents, v.mapping)
        self._write_docs(docs.withColumn("doc_bucket", tables.bucket_of(F.col(key), v.doc_buckets)), v, n)
        key_type = T._parse_datatype_string(v.key_type)
        added = self._check_keys(v, n, before)
        kept = {f.name for f in v.mapping.doc_fields}
        if kept.issuperset(tables.indexed_fields(v.mapping)):
            # The text is in the batch just written, parsed and evenly spread: no second look at the source.
            documents = self._read("docs", [n], tables.docs_schema(v.mapping, key_type).add("doc_bucket", T.IntegerType()))
        else:
            documents = tables.spread(documents)
        self._write_words(v, n, documents, added)
        v.batches, v.terms, v.n_docs = [*v.batches, n], [*v.terms, n], v.n_docs + added
        self._count_tokens(v, n)

    def _write_words(self, v: _Version, n: int, documents: DataFrame, rows: int) -> None:
        """Postings and vocabulary of a batch. The first batch says which words are frequent enough for their pairs."""
        key_type = T._parse_datatype_string(v.key_type)
        if v.paired is None and v.mapping.paired:
            v.paired = tables.frequent_words(self._some(documents), v.mapping)
        if v.lengths is None and v.mapping.tiered:
            v.lengths = tables.mean_lengths(self._some(documents), v.mapping)
        slots = {name: analysis.word_slots(self.spark, words) for name, words in (v.paired or {}).items()}
        v.paired = {name: sorted(filter(None, words)) for name, words in slots.items()} if v.paired is not None else None
        cores, values = self.spark.sparkContext.defaultParallelism, rows * len(tables.indexed_fields(v.mapping))
        # A field stemmed by a map is shuffled to join the map, whatever the shares.
        shares = None if v.stem_maps else tables.shares_of(tables.size_of(documents), values, cores, v.term_buckets)
        if shares:
            documents = documents.repartition(shares, v.mapping.key)
            postings = tables.sorted_postings(documents, v.mapping, v.term_buckets, slots, v.lengths)
        else:
            postings = tables.postings_table(documents, v.mapping, self._stem_maps(v), slots)
            postings = postings.withColumn("term_bucket", tables.bucket_of(F.col("term"), v.term_buckets))
        self._write_postings(postings, v, n, dealt=shares is not None)
        schema = tables.postings_schema(v.mapping, key_type).add("batch", T.LongType()).add("term_bucket", T.IntegerType())
        self._write_terms(tables.terms_table(self._read("postings", [n], schema)), v, n)

    @staticmethod
    def _some(documents: DataFrame) -> DataFrame:
        """Some documents, of one bucket where they lie in buckets."""
        if "doc_bucket" in documents.columns:
            first = documents.select("doc_bucket").first()
            documents = documents.filter(F.col("doc_bucket") == (first["doc_bucket"] if first else -1))
        return documents.limit(tables.PAIRED_SAMPLE)

    def _check_keys(self, v: _Version, n: int, before: Index | None) -> int:
        """How many documents the batch has; an error if a key is null, repeated, or in the index already."""
        key = v.mapping.key
        schema = T.StructType([T.StructField(key, T._parse_datatype_string(v.key_type))])
        keys = self._read("docs", [n], schema).select(key)
        counted = keys.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
            F.sum("n").alias("rows"), F.count(key).alias("keys")
        )
        rows, distinct = counted.first()
        if (rows or 0) != distinct:
            raise MappingError(f"{(rows or 0) - distinct} records have a null key or one that repeats: {key}")
        if before is not None and not before.docs_of(keys, "left_semi").isEmpty():
            raise MappingError(f"records have keys that are in the index already (upsert replaces them): {key}")
        return distinct

    def _write_docs(self, docs: DataFrame, v: _Version, n: int) -> None:
        (
            docs.hint("rebalance", "doc_bucket")
            .sortWithinPartitions("doc_bucket", v.mapping.key)
            .write.partitionBy("doc_bucket")
            .parquet(f"{self.path}/docs/batch={n}")
        )
        if v.mapping.ranged:
            schema = tables.docs_schema(v.mapping, T._parse_datatype_string(v.key_type)).add("doc_bucket", T.IntegerType())
            rows = self._read("docs", [n], schema)
            if v.cuts is None:
                v.cuts = tables.range_cuts(self._some(rows), v.mapping)
            for f in v.mapping.ranged:
                value = F.col(f"`{f}`")
                (
                    rows.filter(value.isNotNull())
                    .select(v.mapping.key, value, tables.range_of(v.mapping, f, value, v.cuts.get(f, [])).alias("part"))
                    .hint("rebalance", "part")
                    .sortWithinPartitions("part", f"`{f}`")
                    .write.partitionBy("part")
                    .parquet(f"{self.path}/ranges/field={f}/batch={n}")
                )
        if v.mapping.summarized:
            rows = self._read("docs", [n], tables.docs_schema(v.mapping, T._parse_datatype_string(v.key_type)))
            tables.summary_table(rows, v.mapping).write.parquet(f"{self.path}/summaries/batch={n}")

    def _write_postings(self, postings: DataFrame, v: _Version, n: int, dealt: bool = False) -> None:
        """With ``dealt``, the postings of a task are enough for files of their own and stay where they are."""
        tier = []
        if v.mapping.tiered:
            postings, tier = tables.with_tiers(postings, v.lengths or {}), [F.desc("tier")]
        (
            (postings if dealt else postings.hint("rebalance", "field", "term_bucket"))
            .sortWithinPartitions("field", "term_bucket", "term", *tier, v.mapping.key)
            .write.option("parquet.bloom.filter.enabled#term", "true")
            .partitionBy("field", "term_bucket")
            .parquet(f"{self.path}/postings/batch={n}")
        )
        if v.mapping.tiered:
            schema = T._parse_datatype_string("field string, term string, tier int, batch bigint, term_bucket int")
            (
                tables.tiers_table(self._read("postings", [n], schema))
                .withColumn("term_bucket", tables.bucket_of(F.col("term"), v.term_buckets))
                .hint("rebalance", "field", "term_bucket")
                .sortWithinPartitions("field", "term_bucket", "term")
                .write.partitionBy("field", "term_bucket")
                .parquet(f"{self.path}/tiers/batch={n}")
            )

    def _write_terms(self, terms: DataFrame, v: _Version, n: int) -> None:
        (
            terms.withColumn("term_bucket", tables.bucket_of(F.col("term"), v.term_buckets))
            .hint("rebalance", "field", "term_bucket")
            .sortWithinPartitions("field", "term_bucket", "term")
            .write.partitionBy("field", "term_bucket")
            .parquet(f"{self.path}/terms/batch={n}")
        )
        if n > 0 and v.mapping.grammed:
            schema = T._parse_datatype_string("field string, term string, batch bigint, term_bucket int")
            pieces = tables.grams_table(self._read("terms", [n], schema), v.mapping)
            (
                pieces.withColumn("gram_bucket", tables.bucket_of(F.col("gram"), v.term_buckets))
                .hint("rebalance", "field", "gram_bucket")
                .sortWithinPartitions("field", "gram_bucket", "gram", "term")
                .write.partitionBy("field", "gram_bucket")
                .parquet(f"{self.path}/grams/batch={n}")
            )

    def rewrite(self) -> int:
        """Fold all batches and deletes into one batch; earlier versions stay readable. Words whose pairs are kept are
        chosen anew if the text is stored."""
        since = self._require()
        n = (since.version + 1) * ATTEMPTS + secrets.randbelow(ATTEMPTS)
        index = self._index(since)
        v = replace(since, version=since.version + 1, batches=[n], deletes=[], terms=[n], deleted=0)
        v.cuts = None
        self._write_docs(index.docs, v, n)
        if v.mapping.paired and {f.name for f in v.mapping.doc_fields}.issuperset(tables.indexed_fields(v.mapping)):
            v.paired = v.lengths = None
            schema = tables.docs_schema(v.mapping, T._parse_datatype_string(v.key_type)).add("doc_bucket", T.IntegerType())
            self._write_words(v, n, self._read("docs", [n], schema), v.n_docs)
        else:
            self._write_postings(index.everything, since, n)
            self._write_terms(index.statistics.select("field", "term", "df", "cf"), since, n)
        return self._commit(v, None)

    def compact(self, batches: list[int]) -> int:
        """Fold some batches into one, without their deleted documents, and commit; the others are not read.

        Deletes that no older batch is left for are forgotten. The vocabulary is summed up, as it is after any change."""
        since = self._require()
        chosen = [b for b in since.batches if b in set(batches)]
        if not chosen:
            return since.version
        n = (since.version + 1) * ATTEMPTS + secrets.randbelow(ATTEMPTS)
        part = self._index(replace(since, batches=chosen))
        self._write_docs(part.docs, since, n)
        self._write_postings(part.everything, since, n)
        self._write_terms(self._index(since).statistics.select("field", "term", "df", "cf"), since, n)
        rest = [b for b in since.batches if b not in chosen]
        deletes = [d for d in since.deletes if any(b < d for b in rest)]
        return self._commit(replace(since, version=since.version + 1, batches=[*rest, n], deletes=deletes, terms=[n]), None)

    def small_batches(self, most_docs: int) -> list[int]:
        """The batches of the current version with at most so many documents, deleted ones included."""
        v = self._require()
        rows = self._read("docs", v.batches, T.StructType([T.StructField("batch", T.LongType())]))
        counts = rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= most_docs)
        return sorted(r["batch"] for r in counts.select("batch").collect())

    def expire(self, keep_versions: int) -> list[str]:
        """Delete the folders and rows that none of the last versions needs, and return the folders' names.

        Opened indexes of older versions stop working, and so must no change be running."""
        latest = self._require().version
        kept = [self._require(n) for n in range(max(0, latest - keep_versions + 1), latest + 1)]
        used = {(table, b) for v in kept for b in v.batches for table in ("docs", "postings", "tiers", "summaries")}
        used |= {("deletes", d) for v in kept for d in v.deletes}
        used |= {(table, t) for v in kept for t in v.terms for table in ("terms", "grams")}
        _, system = self._file(0)
        gone = []
        for table in ("docs", "postings", "deletes", "terms", "grams", "tiers", "summaries"):
            top = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
            for status in system.listStatus(top) if system.exists(top) else ():
                name = status.getPath().getName()
                if name.startswith("batch=") and (table, int(name[6:])) not in used:
                    system.delete(status.getPath(), True)
                    gone.append(f"{table}/{name}")
        for f in kept[-1].mapping.ranged:
            top = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/ranges/field={f}")
            for status in system.listStatus(top) if system.exists(top) else ():
                name = status.getPath().getName()
                if name.startswith("batch=") and ("docs", int(name[6:])) not in used:
                    system.delete(status.getPath(), True)
                    gone.append(f"ranges/field={f}/{name}")
        first = kept[0].version
        while not self._row(first)["whole"]:
            first -= 1
        for n in range(first):
            path, _ = self._file(n)
            system.delete(path, False)
        return gone

    def has_stream_batch(self, stream: str, batch: int) -> bool:
        """Whether this micro-batch, or a later one of its stream, is committed already."""
        return self._require().streams.get(stream, -1) >= batch


def build_index(
    records: DataFrame,
    mapping: Mapping,
    path: str,
    term_buckets: int = TERM_BUCKETS,
    doc_buckets: int = DOC_BUCKETS,
    stem_maps: Dict[str, DataFrame] | None = None,
) -> Index:
    """Index a whole batch of records into a new directory and open it."""
    if mapping.key not in records.columns:
        raise MappingError(f"key column not found: {mapping.key}")
    directory = IndexDirectory(records.sparkSession, path)
    directory.create(mapping, records.schema[mapping.key].dataType, term_buckets, doc_buckets, stem_maps)
    directory.append(records)
    return directory.open()
