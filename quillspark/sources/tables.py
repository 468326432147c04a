"""The tables an index is made of, derived from documents.

``docs``      key and typed fields
``postings``  field, term, key, tf, dl, positions - one row per term and document
``terms``     field, term, df, cf - the vocabulary with its statistics
"""

from __future__ import annotations

from collections.abc import Callable
from collections.abc import Mapping as Dict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.errors import MappingError
from quillspark.functions import analysis, scoring
from quillspark.functions.grouping import Words, grouped
from quillspark.mapping import PAIRED, Mapping
from quillspark.plans import grams

#: Ranges of the values of a field.
RANGES = 64
#: Sizes of the sketches of a field's summary: of quantiles, and of distinct values in bits.
QUANTILE_SIZE, DISTINCT_BITS = 400, 14
#: Terms with fewer postings have no counts of tiers.
TIERED_POSTINGS = 128
#: The words whose pairs are kept: at most so many of a field, in at least one of so many documents of a sample.
PAIRED_WORDS, PAIRED_SHARE, PAIRED_SAMPLE = 512, 24, 2_000
#: So many values of a field are told apart while frequent ones are counted.
TRACKED = 12_288
#: A batch from this many bytes, or values of its fields, on is dealt out in shares of at most so many of either, smaller
#: ones only for idle cores; a share writes its own postings into every bucket, which has to get so many bytes of it.
LARGE_BATCH, LARGEST_SHARE, SMALLEST_SHARE, BUCKET_SHARE = 32 << 20, 16 << 20, 2 << 20, 1 << 20
LARGE_VALUES, SHARE_VALUES = 8_000_000, 2_000_000


def indexed_fields(mapping: Mapping) -> list[str]:
    return [f.name for f in mapping.fields if f.in_postings]


def spread(records: DataFrame) -> DataFrame:
    """A source that is less than one read split per core, over all the cores; a larger one as it is, without a shuffle.

    Sizes are the optimizer's estimate, so no file list reaches the driver and no job runs."""
    spark = records.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = size_of(records)
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return records.repartition(cores) if size < cores * split else records


def size_of(records: DataFrame) -> int:
    """The optimizer's estimate in bytes."""
    return int(str(records._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shares_of(size: int, values: int, cores: int, buckets: int) -> int | None:
    """In how many shares a batch of that many bytes and values writes its postings; None if it is too small, or the
    buckets too many, to do without a shuffle of the postings."""
    if size < LARGE_BATCH and values < LARGE_VALUES or LARGEST_SHARE // buckets < BUCKET_SHARE:
        return None
    return max(-(-size // LARGEST_SHARE), -(-values // SHARE_VALUES), min(cores, size // SMALLEST_SHARE))


def docs_schema(mapping: Mapping, key_type: T.DataType) -> T.StructType:
    fields = [T.StructField(f.name, f.spark_type) for f in mapping.doc_fields]
    return T.StructType([T.StructField(mapping.key, key_type), *fields])


def postings_schema(mapping: Mapping, key_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("field", T.StringType()),
            T.StructField("term", T.StringType()),
            T.StructField(mapping.key, key_type),
            T.StructField("tf", T.IntegerType()),
            T.StructField("dl", T.IntegerType()),
            T.StructField("positions", T.ArrayType(T.IntegerType())),
        ]
    )


def _entries(mapping: Mapping, name: str) -> Column:
    analyzer = mapping.field(name).analyzer
    base = "default" if analysis.is_stemmed(analyzer) else analyzer
    return analysis.token_entries(F.col(f"`{name}`"), base)


def _tagged(name: str, groups: Column) -> Column:
    return F.transform(
        groups,
        lambda g: F.struct(
            F.lit(name).alias("field"), g["term"].alias("term"), g["tf"].alias("tf"), g["dl"].alias("dl"),
            g["positions"].alias("positions"),
        ),
    )


def docs_table(documents: DataFrame, mapping: Mapping) -> DataFrame:
    return documents.select(mapping.key, *[F.col(f"`{f.name}`") for f in mapping.doc_fields])


def _paired(name: str, entries: Column, slots: list[str]) -> Column:
    """The groups of a field's pairs of words; their length is that of the text in words."""
    groups = analysis.grouped_entries(analysis.pair_entries(entries, slots))
    with_length = lambda g: F.struct(g["term"].alias("term"), g["tf"].alias("tf"), F.size(entries).alias("dl"), g["positions"].alias("positions"))
    return _tagged(name + PAIRED, F.transform(groups, with_length))


def frequent_words(sample: DataFrame, mapping: Mapping) -> Dict[str, list[str]]:
    """For each field whose pairs are kept the words that are frequent in some documents, most frequent first: at most
    ``PAIRED_WORDS`` rows a field reach the driver."""
    rows, found = sample.count(), {}
    for name in mapping.paired:
        words = sample.select(F.explode(F.array_distinct(F.transform(_entries(mapping, name), lambda e: e["term"]))).alias("term"))
        counts = words.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * PAIRED_SHARE >= rows)
        found[name] = [r["term"] for r in counts.orderBy(F.desc("n"), "term").limit(PAIRED_WORDS).collect()]
    return found


def with_tiers(postings: DataFrame, lengths: Dict[str, float]) -> DataFrame:
    """Postings with ``tier``, null in fields without; pairs of words are in their field's."""
    fields = {f: v for name, v in lengths.items() for f in (name, name + PAIRED)}
    length = F.lit(None).cast("double")
    for name, value in fields.items():
        length = F.when(F.col("field") == name, F.lit(value)).otherwise(length)
    return postings.withColumn("tier", scoring.tier_of(F.col("tf"), F.col("dl"), length))


def tiers_table(postings: DataFrame) -> DataFrame:
    """``field``, ``term`` and ``tiers``, how many postings are in each tier, of the terms that have ``TIERED_POSTINGS``."""
    counts = postings.filter("tier is not null").groupBy("field", "term", "tier").agg(F.count(F.lit(1)).alias("n"))
    listed = counts.groupBy("field", "term").agg(F.collect_list(F.struct("tier", "n")).alias("tiers"), F.sum("n").alias("df"))
    return listed.filter(F.col("df") >= TIERED_POSTINGS).drop("df")


def mean_lengths(sample: DataFrame, mapping: Mapping) -> Dict[str, float]:
    """About how many tokens the fields with tiers have; any number is right, near ones cut best."""
    if not mapping.tiered:
        return {}
    sizes = [F.avg(F.coalesce(F.size(_entries(mapping, n)), F.lit(0))).alias(n) for n in mapping.tiered]
    row = sample.agg(*sizes).first()
    return {n: max(1.0, float(row[n] or 1.0)) for n in mapping.tiered}


SUMMARY = "field string, n bigint, low double, high double, quantiles binary, distinct_values binary, frequent struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>"


def _summary_text(f) -> str:
    return f"cast(unix_millis(`{f.name}`) as string)" if f.type == "date" else f"cast(`{f.name}` as string)"


def summary_table(docs: DataFrame, mapping: Mapping) -> DataFrame:
    """A row per summarized field, in one pass over the documents; each task makes its own sketches, which are merged."""
    rows = []
    for name in mapping.summarized:
        f, column = mapping.field(name), F.col(f"`{name}`")
        number = F.unix_millis(column) if f.type == "date" else column.cast("int") if f.type == "bool" else column
        number = number.cast("double") if f.numeric else F.lit(None).cast("double")
        whole = F.unix_millis(column) if f.type == "date" else column
        plain = whole if f.type in ("i64", "date") else whole.cast("string")
        rows.append(
            F.struct(
                F.lit(name).alias("field"), F.count(column).alias("n"), F.min(number).alias("low"), F.max(number).alias("high"),
                (F.kll_sketch_agg_double(number, F.lit(QUANTILE_SIZE)) if f.numeric else F.lit(None).cast("binary")).alias("quantiles"),
                F.hll_sketch_agg(plain, F.lit(DISTINCT_BITS)).alias("distinct_values"),
                F.expr(f"approx_top_k_accumulate({_summary_text(f)}, {TRACKED}) filter (where `{name}` is not null)").alias("frequent"),
            )
        )
    return docs.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def range_cuts(sample: DataFrame, mapping: Mapping) -> Dict[str, list[str]]:
    """For each field kept by range the values that part the ranges, as texts, from at most ``PAIRED_SAMPLE`` documents."""
    if not mapping.ranged:
        return {}
    written = [F.sort_array(F.collect_list(F.col(f"`{n}`"))).alias(n) for n in mapping.ranged]
    row = sample.agg(*written).select(*[F.transform(F.col(f"`{n}`"), _text_of(mapping, n)).alias(n) for n in mapping.ranged]).first()
    return {n: list(dict.fromkeys(row[n][i * len(row[n]) // RANGES] for i in range(1, RANGES) if row[n])) for n in mapping.ranged}


def _text_of(mapping: Mapping, name: str) -> Callable[[Column], Column]:
    if mapping.type_of(name) == "date":
        return lambda value: F.unix_micros(value).cast("string")
    return lambda value: value.cast("string")


def range_of(mapping: Mapping, name: str, value: Column, cuts: list[str]) -> Column:
    """The range a value is in; folds to a constant for a literal."""
    kind = mapping.field(name).spark_type
    part = F.lit(0)
    for cut in cuts:
        edge = F.timestamp_micros(F.lit(int(cut))) if mapping.type_of(name) == "date" else F.lit(cut).cast(kind)
        part = part + F.when(value >= edge, 1).otherwise(0)
    return part


def grams_table(terms: DataFrame, mapping: Mapping) -> DataFrame:
    """``field``, ``gram``, ``term``: the pieces of every term of the fields that have such a table."""
    chosen = terms.filter(F.col("field").isin(mapping.grammed))
    return chosen.select("field", F.explode(grams.pieces_of(F.col("term"))).alias("gram"), "term")


def postings_table(
    documents: DataFrame,
    mapping: Mapping,
    stem_maps: Dict[str, DataFrame] | None = None,
    slots: Dict[str, list[str]] | None = None,
) -> DataFrame:
    """One row per (field, term, document), built inside each document's own row, and one per pair of adjacent words that
    are both in the ``slots`` of their field.

    Only a field stemmed by a caller's map needs a shuffle, to join that map.
    """
    stem_maps = stem_maps or {}
    names = indexed_fields(mapping)
    if not names:
        schema = postings_schema(mapping, documents.schema[mapping.key].dataType)
        return documents.sparkSession.createDataFrame([], schema)
    staged = documents.select(mapping.key, *[_entries(mapping, n).alias(f"e_{n}") for n in names])
    for n in names:
        analyzer = mapping.field(n).analyzer
        if analysis.has_builtin_stemmer(analyzer) and analyzer not in stem_maps:
            staged = staged.withColumn(f"e_{n}", analysis.grouped_entries(F.col(f"e_{n}")))
            staged = staged.withColumn(f"e_{n}", analysis.stemmed_entries(F.col(f"e_{n}")))
        elif analysis.is_stemmed(analyzer) and analyzer not in stem_maps:
            raise _no_stem_map(analyzer)
    # Columns of their own: what an array function is given by another is copied whole at each step.
    staged = staged.withColumns({f"s_{n}": F.sort_array(F.col(f"e_{n}")) for n in names})
    staged = staged.withColumns({f"at_{n}": analysis.run_starts(F.col(f"s_{n}")) for n in names})
    groups = [analysis.runs(F.col(f"s_{n}"), F.col(f"at_{n}"), field=F.lit(n)) for n in names]
    groups += [_paired(n, F.col(f"e_{n}"), words) for n, words in (slots or {}).items() if any(words)]
    present = [F.coalesce(g, F.array()) for g in groups]
    rows = staged.select(mapping.key, F.inline(F.concat(*present) if len(present) > 1 else present[0]))
    rows = rows.select("field", "term", mapping.key, "tf", "dl", "positions")
    for analyzer, stem_map in stem_maps.items():
        mapped = [n for n in names if mapping.field(n).analyzer == analyzer]
        if mapped:
            rows = _stem_by_map(rows, mapping.key, mapped, stem_map, len(mapped) == len(names) and not slots)
    return rows


def _no_stem_map(analyzer: str) -> MappingError:
    return MappingError(f"tokenizer {analyzer} needs a stem map (term, stem) for this language")


def sorted_postings(
    documents: DataFrame,
    mapping: Mapping,
    buckets: int,
    slots: Dict[str, list[str]] | None = None,
    lengths: Dict[str, float] | None = None,
) -> DataFrame:
    """The rows of ``postings_table`` with their ``term_bucket``, where no field is stemmed by a map. The documents of a
    partition are grouped together, some MB at a time, and their postings come in the order they are written in, so that
    the sort before that has nothing left to move."""
    fields = []
    for name in indexed_fields(mapping):
        analyzer = mapping.field(name).analyzer
        if analysis.is_stemmed(analyzer) and not analysis.has_builtin_stemmer(analyzer):
            raise _no_stem_map(analyzer)
        words = tuple(filter(None, (slots or {}).get(name, [])))
        fields.append(Words(name, analyzer, words, (lengths or {}).get(name)))
    schema = postings_schema(mapping, documents.schema[mapping.key].dataType)
    if not fields:
        return documents.sparkSession.createDataFrame([], schema.add("term_bucket", T.IntegerType()))
    texts = [mapping.key]
    for i, f in enumerate(fields):
        words, as_is = analysis.separated(F.col(f"`{f.name}`"), f.analyzer)
        texts += [words.alias(f"words_{i}"), as_is.alias(f"as_is_{i}")]
    listed = T.StructType(
        [
            schema["field"], schema["term"], T.StructField("run", T.IntegerType()),
            T.StructField("first", schema[mapping.key].dataType),
            T.StructField("rows", T.ArrayType(T.StructType(schema.fields[2:]))),
        ]
    )
    found = documents.sortWithinPartitions(mapping.key).select(*texts).mapInArrow(grouped(fields, mapping.key), listed)
    found = found.withColumn("term_bucket", bucket_of(F.col("term"), buckets))
    found = found.sortWithinPartitions("field", "term_bucket", "term", "run", "first")
    return found.select("field", "term", "term_bucket", F.inline("rows")).select(*schema.names, "term_bucket")


def _stem_by_map(rows: DataFrame, key: str, fields: list[str], stem_map: DataFrame, alone: bool = False) -> DataFrame:
    """Replace the terms of ``fields`` by their stems and merge the words that now coincide. With no other fields (``alone``)
    the documents are not split into words a second time for them.

    The map joins the distinct terms of each document, not its tokens; Spark broadcasts the map only
    if it is small, and AQE splits a frequent term's partition otherwise.
    """
    words = stem_map.select(F.col("term"), F.col("stem"))
    merged = (
        (rows if alone else rows.filter(F.col("field").isin(fields)))
        .join(words, "term", "left")
        .groupBy("field", F.coalesce("stem", "term").alias("term"), key)
        .agg(
            F.sum("tf").cast("int").alias("tf"),
            F.max("dl").alias("dl"),
            F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions"),
        )
    )
    return merged if alone else rows.filter(~F.col("field").isin(fields)).unionByName(merged)


def terms_table(postings: DataFrame) -> DataFrame:
    """Document and collection frequency per term; counts are combined before the shuffle."""
    return postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def bucket_of(value: Column, buckets: int) -> Column:
    """The directory a term or a key lives in; folds to a constant for a literal."""
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")
