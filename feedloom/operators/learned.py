"""Matching of column names by what approved pairs teach: no glossary, no weights set by hand.

A column is a set of features: pieces of its name's tokens (two and three letters, with a mark where a token begins), pieces of
the tokens without vowels, as abbreviations keep them, and the shapes of its sample values. An inverted index counts, per feature
and target, the approved columns that have it. Features that few targets have weigh more (inverse frequency), features that many
columns of one target share weigh more for that target. A column's score for a target is the cosine of the two, times the share
of the column's features that the index knows, times how often approved columns of the target have the column's type family.

Columns meet targets, not other columns, through equal features, so the work grows with the number of distinct columns times
their features times the targets, which the model bounds. Columns of equal name, type family and shapes are one from the start:
features are taken of the different ones only, and the rows meet their match by these three.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import scratch_dir
from ..functions.text import name_tokens, type_family

NO_MATCH = "NO_MATCH"
#: What a column's features follow from.
NAME = ("local_column_name", "_family", "_shapes")


def _pieces(text: Column, size: int) -> Column:
    """All runs of ``size`` letters; of a shorter text none."""
    return F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(text), F.lit(1))), lambda i: F.substring(text, i, F.lit(size))), lambda p: F.char_length(p) == size)


def name_features(name: Column | str) -> Column:
    """Different features of a column name."""

    def of(token: Column) -> Column:
        begun = F.concat(F.lit("^"), token)
        bare = F.concat(F.lit("^"), F.left(token, F.lit(1)), F.translate(F.substring(token, F.lit(2), F.char_length(token)), "aeiou", ""))
        return F.concat(_pieces(begun, 2), _pieces(begun, 3), F.transform(_pieces(bare, 2), lambda p: F.concat(F.lit("~"), p)))

    return F.array_distinct(F.flatten(F.transform(name_tokens(name), of)))


def shape_features(samples: Column | str) -> Column:
    """Different shapes of sample values: runs of letters and of digits become one letter, one digit."""

    def of(value: Column) -> Column:
        return F.concat(F.lit("#"), F.regexp_replace(F.regexp_replace(value, r"[\p{L}]+", "a"), "[0-9]+", "9"))

    samples = F.col(samples) if isinstance(samples, str) else samples
    return F.coalesce(F.array_distinct(F.transform(F.filter(samples, lambda v: v.isNotNull()), of)), F.array().cast("array<string>"))


def _shaped(columns: DataFrame) -> DataFrame:
    """With the type family and the shapes of the samples; these and the name are all that the features depend on."""
    shapes = shape_features("sample_values") if "sample_values" in columns.columns else F.array().cast("array<string>")
    return columns.withColumns({"_family": F.coalesce(type_family("local_data_type"), F.lit("string")), "_shapes": F.array_sort(shapes)})


def _once(names: DataFrame) -> DataFrame:
    """Written, as the plan would otherwise take the features of every row to see whether there are any, before it finds equal names."""
    path = scratch_dir(names.sparkSession, "learned-names")
    names.write.parquet(path)
    return names.sparkSession.read.schema(names.schema).parquet(path)


def _described(names: DataFrame) -> DataFrame:
    """With the features. Pieces of names are dear, so ``names`` are different ones, not the rows of columns."""
    return names.withColumn("_features", F.array_sort(F.concat(name_features("local_column_name"), "_shapes")))


def _approved(names: DataFrame, *extra: str) -> DataFrame:
    """Different approved columns with their features."""
    named = names.filter("local_column_name is not null").withColumn("_target", F.coalesce("global_column_name", F.lit(NO_MATCH)))
    return _described(named.select(*extra, "_target", *NAME).distinct())


def learned_matches(columns: DataFrame, pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``columns`` with ``proposed`` (a target, or NO_MATCH) and ``score`` (0 to 1).

    ``columns`` have local_column_name, local_data_type and maybe sample_values; ``pairs``, approved columns of other sources,
    have these and global_column_name, where null stands for columns that no target takes. With ``by`` there is one index per
    value of these columns of both inputs. Columns that share no feature with any approved one, and those with a null name, get
    NO_MATCH and 0; ties go to the first target by name. Equal approved pairs count once.
    """
    key = [*by, *NAME]
    asked = _shaped(columns)
    known = _approved(_once(_shaped(pairs).select(*key, "global_column_name").distinct()), *by)
    found = _matched(_once(asked.select(*key).distinct()), known, list(by))
    return asked.join(found, key, "left").select(
        *columns.columns, F.coalesce("proposed", F.lit(NO_MATCH)).alias("proposed"), F.coalesce("score", F.lit(0.0)).alias("score")
    )


def _matched(names: DataFrame, known: DataFrame, by: list[str]) -> DataFrame:
    """The different ``names`` with ``proposed`` and ``score``."""
    sizes = known.groupBy(*by, "_target").agg(F.count(F.lit(1)).alias("_n"))
    families = known.groupBy(*by, "_target", "_family").agg(F.count(F.lit(1)).alias("_same"))
    counted = known.select(*by, "_target", F.explode("_features").alias("_f")).groupBy(*by, "_f", "_target").agg(F.count(F.lit(1)).alias("_c"))
    spread = counted.groupBy(*by, "_f").agg(F.count(F.lit(1)).alias("_df"))
    if by:
        spread = spread.join(sizes.groupBy(*by).agg(F.count(F.lit(1)).alias("_all")), by)
    else:
        spread = spread.withColumn("_all", sizes.agg(F.count(F.lit(1))).scalar())
    rare = spread.select(*by, "_f", F.log1p(F.col("_all") / F.col("_df")).alias("_idf"))
    index = counted.join(rare, [*by, "_f"]).join(sizes, [*by, "_target"]).select(*by, "_f", "_target", "_idf", (F.col("_idf") * F.col("_c") / F.col("_n")).alias("_w"))
    length = index.groupBy(*by, "_target").agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_length"))

    asked = _described(names)
    key = [*by, "_family", "_features"]
    features = asked.select(*key).distinct().withColumn("_f", F.explode("_features"))
    own = features.join(rare, [*by, "_f"]).groupBy(*key).agg(
        F.sqrt(F.sum(F.col("_idf") * F.col("_idf"))).alias("_own"), (F.count(F.lit(1)) / F.size("_features")).alias("_share")
    )
    dots = features.join(index, [*by, "_f"]).groupBy(*key, "_target").agg(F.sum(F.col("_idf") * F.col("_w")).alias("_dot"))
    scored = (
        dots.join(length, [*by, "_target"])
        .join(own, key)
        .join(sizes, [*by, "_target"])
        .join(families, [*by, "_target", "_family"], "left")
        .withColumn("_fits", (F.coalesce("_same", F.lit(0)) + 0.5) / (F.col("_n") + 1))
        .withColumn("_score", F.round(F.col("_dot") / (F.col("_length") * F.col("_own")) * F.col("_share") * F.col("_fits"), 6))
    )
    best = scored.groupBy(*key).agg(F.min(F.struct((-F.col("_score")).alias("minus"), F.col("_target").alias("target"))).alias("_best"))
    return asked.join(best, key, "left").select(
        *names.columns,
        F.coalesce("_best.target", F.lit(NO_MATCH)).alias("proposed"),
        F.coalesce(-F.col("_best.minus"), F.lit(0.0)).alias("score"),
    )


def held_out_accuracy(columns: DataFrame, group: str) -> DataFrame:
    """Per group of sources how many columns are matched rightly by an index that has seen no source of the group.

    ``columns`` have local_column_name, local_data_type, global_column_name and maybe sample_values. Returns rows (group, n_columns,
    n_right, accuracy); the groups are few, as each gets an index of the others' different columns. Columns of a null group teach
    all groups and are themselves matched by none.
    """
    # All that the columns of one name, family and set of shapes are to the matching, with the number of them.
    names = _once(_shaped(columns).groupBy(group, *NAME, "global_column_name").agg(F.count(F.lit(1)).alias("_rows")))
    seen = _approved(names, group)
    groups = seen.agg(F.collect_set(group)).scalar()
    # A column teaches the indexes of all groups but its own.
    known = seen.withColumn(group, F.explode(F.array_except(groups, F.array(group)))).distinct()
    right = F.when(F.col("proposed") == F.coalesce("global_column_name", F.lit(NO_MATCH)), F.col("_rows")).otherwise(F.lit(0))
    found = _matched(names, known, [group])
    out = found.groupBy(group).agg(F.sum("_rows").alias("n_columns"), F.sum(right).alias("n_right"))
    return out.withColumn("accuracy", F.round(F.col("n_right") / F.col("n_columns"), 4))
