"""What an index holds, field by field."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.analysis import has_tokens
from quillspark.sources.index import Index


def field_profile(index: Index) -> DataFrame:
    """Type and options of every field, documents with a value, vocabulary size and tokens.

    Vocabulary figures come from the term statistics; documents with a value are counted in one pass over the documents,
    where only a row per field is shuffled, or over the postings for text that is not kept.
    """
    mapping = index.mapping
    rows = [(i, f.name, f.type, f.stored, f.indexed, f.fast) for i, f in enumerate(mapping.fields)]
    declared = index.spark.createDataFrame(
        rows, "position int, field string, type string, stored boolean, indexed boolean, fast boolean"
    )
    vocabulary = index.terms.groupBy("field").agg(F.count(F.lit(1)).alias("terms"), F.sum("cf").alias("tokens"))
    has_value = {
        f.name: has_tokens(F.col(f"`{f.name}`"), f.analyzer) if f.type == "text" else F.col(f"`{f.name}`").isNotNull()
        for f in mapping.fields
        if f.in_docs
    }
    elsewhere = [f.name for f in mapping.fields if f.in_postings and not f.in_docs]
    values = index.postings.filter(F.col("field").isin(elsewhere)).groupBy("field")
    values = values.agg(F.count_distinct(F.col(mapping.key)).alias("docs_with_value"))
    if has_value:
        counts = [F.struct(F.lit(n).alias("field"), F.count_if(c).alias("docs_with_value")) for n, c in has_value.items()]
        values = values.unionByName(index.docs.agg(F.array(*counts).alias("c")).select(F.inline("c")))
    return (
        declared.join(values, "field", "left")
        .join(vocabulary, "field", "left")
        .select(
            "position", "field", "type", "stored", "indexed", "fast",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("docs_with_value", "terms", "tokens")],
        )
    )
