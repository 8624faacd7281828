"""Predicates on mapping targets and review states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def real_target(target: Column | str) -> Column:
    """TRUE if the target names a column: not NULL, not empty, not NO_MATCH in any case."""
    c = as_col(target)
    return F.coalesce((c != "") & (F.upper(c) != "NO_MATCH"), F.lit(False))


#: Letters that upper case would merge with others, and the marks that stand for them meanwhile. Fixed values.
DOTLESS_I, KEPT_I = "\u0131", "\ue131"


def folded(text: Column | str) -> Column:
    """Full case folding: texts that differ in case only become equal, also where a letter's other case is two letters.

    Lower case alone leaves a sharp s, ligatures and the final sigma apart from their
    upper case. Going up and down again spells them out; the dotless i has no case of
    its own to go to and is kept from becoming an i.
    """
    spelled = F.upper(F.translate(F.lower(as_col(text)), DOTLESS_I, KEPT_I))
    # Something must stand between the two cases, as the optimizer takes the lower case of an upper case for one step.
    return F.translate(F.lower(F.translate(spelled, KEPT_I, DOTLESS_I)), "\u03c2", "\u03c3")


def folded_target(target: Column | str) -> Column:
    """Target with its case folded, NULL and the empty string read as no match."""
    c = as_col(target)
    return folded(F.coalesce(F.nullif(c, F.lit("")), F.lit("no_match")))


def holds(predicate: Column) -> Column:
    """Three-valued predicate to boolean: NULL counts as not fulfilled."""
    return F.coalesce(predicate, F.lit(False))


def is_set(text: Column | str) -> Column:
    """TRUE if a text is neither NULL nor empty."""
    return holds(as_col(text) != "")


def null_of(type_name: str = "string") -> Column:
    return F.lit(None).cast(type_name)
