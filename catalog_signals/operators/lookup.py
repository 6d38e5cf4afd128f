"""Attaching the sales-mapping lookup, and checking types against the validation table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_signals.operators.signals import mapping_text
from catalog_signals.operators.spread import splittable_join

_BY_NAME = ["clientId", "serviceType"]
#: Copies that are written out at a time.
_BLOCK = 4096


def _join_by_name(types: DataFrame, named: DataFrame) -> DataFrame:
    """``named`` joined to types whose DESCRIPTION equals its ``serviceType``; NULL equals NULL.

    One description may belong to a third of all types, hence a join that can be split.
    """
    keyed = named.withColumnRenamed("serviceType", "DESCRIPTION")
    return splittable_join(types, keyed, ["clientId", "DESCRIPTION"], null_safe=["DESCRIPTION"])


def best_text(column: str = "isRecurring") -> Column:
    """Aggregate: the greatest mapping text that says TRUE or FALSE, else the greatest of all."""
    usable = F.coalesce(mapping_text(F.col(column)).isin("TRUE", "FALSE"), F.lit(False))
    return F.max(F.struct(usable.alias("usable"), F.col(column).alias("text")))["text"]


def lookup_attach(types: DataFrame, lookup: DataFrame) -> DataFrame:
    """Adds ``isRecurring``; where the lookup is ambiguous, a text that says TRUE or FALSE wins over
    one that says neither, then the greatest."""
    one_per_name = lookup.groupBy(*_BY_NAME).agg(best_text().alias("isRecurring"))
    return _join_by_name(types, one_per_name)


def lookup_attach_copies(types: DataFrame, lookup: DataFrame) -> DataFrame:
    """One row per type and *distinct* lookup value, with ``copies``, the number of matches it
    stands for (1 for a type without a match).

    Equal matches stay counted until ``expand_copies`` writes them out, so that a name that is
    frequent on both sides is never multiplied in a shuffle.
    """
    counted = lookup.groupBy(*_BY_NAME, "isRecurring").agg(F.count(F.lit(1)).alias("copies"))
    joined = _join_by_name(types, counted)
    return joined.withColumn("copies", F.coalesce("copies", F.lit(1)))


def expand_copies(df: DataFrame) -> DataFrame:
    """Each row ``copies`` times; a narrow step, to be the last one.

    In two levels, so that no task holds an array as long as the number of copies.
    """
    block = F.lit(_BLOCK).cast("bigint")
    first = F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("copies") / block) - 1)
    blocks = df.where("copies > 0").withColumn("_block", F.explode(first))
    inside = F.least(block, F.col("copies") - F.col("_block") * block)
    repeated = blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), inside)))
    return repeated.drop("_block", "_copy", "copies")


def lookup_attach_fanout(types: DataFrame, lookup: DataFrame) -> DataFrame:
    """Adds ``isRecurring``; a type is repeated for every lookup row it matches."""
    return expand_copies(lookup_attach_copies(types, lookup))


def lookup_match_count(types: DataFrame, lookup: DataFrame) -> DataFrame:
    """Adds ``copies``, the number of rows the fan-out would give each type."""
    counted = lookup.groupBy(*_BY_NAME).agg(F.count(F.lit(1)).alias("copies"))
    return _join_by_name(types, counted).withColumn("copies", F.coalesce("copies", F.lit(1)))


def name_facts(types: DataFrame, lookup: DataFrame) -> DataFrame:
    """Per client and name: the lookup value a deduped type gets (``isRecurring``), the lookup rows by
    mapping text (``n_true``, ``n_false``, ``n_other``), and the number of types so named
    (``n_types``, 0 for the NULL name, which never repeats). One aggregation over both inputs.
    """
    text, no_row = mapping_text(F.col("isRecurring")), F.lit(0)
    from_lookup = lookup.select(
        *_BY_NAME,
        "isRecurring",
        F.when(text == "TRUE", 1).otherwise(0).alias("n_true"),
        F.when(text == "FALSE", 1).otherwise(0).alias("n_false"),
        F.when(text.isNull(), 1).otherwise(0).alias("n_other"),
        no_row.alias("n_types"),
    )
    from_types = types.select(
        "clientId",
        F.col("DESCRIPTION").alias("serviceType"),
        F.lit(None).cast("string").alias("isRecurring"),
        *[no_row.alias(f"n_{kind}") for kind in ("true", "false", "other")],
        F.when(F.col("DESCRIPTION").isNotNull(), 1).otherwise(0).alias("n_types"),
    )
    sums = [F.sum(n).alias(n) for n in ("n_true", "n_false", "n_other", "n_types")]
    facts = from_lookup.unionByName(from_types).groupBy(*_BY_NAME)
    return facts.agg(best_text().alias("isRecurring"), *sums)


def repeated_names(types: DataFrame) -> DataFrame:
    """Adds ``repeated_name``: is the description on more than one row of the client? NULL never is.

    Counts are pre-aggregated per task and only repeated names are joined back.
    """
    repeated = (
        types.where("DESCRIPTION is not null")
        .groupBy("clientId", F.col("DESCRIPTION").alias("serviceType"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1")
        .select(*_BY_NAME, F.lit(True).alias("repeated_name"))
    )
    joined = _join_by_name(types, repeated)
    return joined.withColumn("repeated_name", F.coalesce("repeated_name", F.lit(False)))


def name_types(types: DataFrame, facts: DataFrame) -> DataFrame:
    """Adds ``isRecurring`` and ``repeated_name`` to deduped types."""
    wanted = facts.where("isRecurring is not null or n_types > 1").select(
        *_BY_NAME, "isRecurring", (F.col("n_types") > 1).alias("repeated_name")
    )
    named = _join_by_name(types, wanted)
    return named.withColumn("repeated_name", F.coalesce("repeated_name", F.lit(False)))


def name_types_fanout(types: DataFrame, facts: DataFrame) -> DataFrame:
    """Adds ``isRecurring`` (as mapping text) and ``repeated_name`` to types that repeat for every
    lookup match; ``copies`` is the number of matches a row stands for, at least 1.

    A type's matches are at most three rows here, one per mapping text, however many there are.
    """
    total = F.col("n_true") + F.col("n_false") + F.col("n_other")
    other = F.when(total == 0, 1).otherwise(F.col("n_other"))
    matches = [
        F.struct(F.lit(text).cast("string").alias("isRecurring"), copies.alias("copies"))
        for text, copies in (("TRUE", F.col("n_true")), ("FALSE", F.col("n_false")), (None, other))
    ]
    wanted = facts.select(
        *_BY_NAME,
        (F.col("n_types") * F.greatest(total, F.lit(1)) > 1).alias("repeated_name"),
        F.array(*matches).alias("_matches"),
    )
    named = _join_by_name(types, wanted)
    return named.select(*types.columns, "repeated_name", F.inline("_matches")).where("copies > 0")


def reference_mismatch(types: DataFrame, merged: DataFrame) -> DataFrame:
    """Types that the validation table lacks or describes differently (NULL counts as lacking).

    A type is repeated for each of its differing validation rows. Those rows are counted per
    distinct description first, and one left join serves the lacking and the differing types.
    """
    return mismatch_of_counts(types, validation_counts(merged))


def validation_counts(merged: DataFrame) -> DataFrame:
    """Validation rows per client, type and description, as ``copies``."""
    return merged.groupBy("clientId", "TYPE_ID", "DESCRIPTION").agg(F.count(F.lit(1)).alias("copies"))


def mismatch_of_counts(types: DataFrame, validation: DataFrame) -> DataFrame:
    """``reference_mismatch`` out of ``validation_counts``."""
    mine = types.select("clientId", "TYPE_ID", "DESCRIPTION")
    theirs = validation.select(
        F.col("clientId").alias("_client"), F.col("TYPE_ID").alias("_type"),
        F.col("DESCRIPTION").alias("DESCRIPTION_MERGED"), "copies",
    )
    same_type = (F.col("clientId") == F.col("_client")) & F.col("TYPE_ID").eqNullSafe(F.col("_type"))
    joined = mine.join(theirs, same_type, "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    merged_text = F.col("DESCRIPTION_MERGED")
    differing = joined.where(merged_text.isNull() | ~merged_text.eqNullSafe(F.col("DESCRIPTION")))
    return expand_copies(differing.select("clientId", "TYPE_ID", "DESCRIPTION", "DESCRIPTION_MERGED", "copies"))
