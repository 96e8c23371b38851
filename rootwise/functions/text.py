"""Formula texts as Spark columns: references in, argument values out.

A reference is ``item(<id>)``. A text is cut at every ``item(``; what follows up to the
first ``)`` is the id. Ids are compared as plain text, so ``_ % . '`` have no special
meaning; an id cannot contain ``)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the formula language.
REFERENCE = "item"
OPENING = "item("
ANY_REFERENCE = "%item(%)%"
INT_MAX = 2147483647
INT_MIN = -2147483648


def _cuts(formula: Column) -> Column:
    return F.split(formula, r"item\(")


def has_opening(formula: Column) -> Column:
    return formula.contains(OPENING)


def is_standalone(formula: Column) -> Column:
    """True for a text without any reference."""
    return ~formula.like(ANY_REFERENCE)


def mentioned_ids(formula: Column) -> Column:
    """Distinct ids a text refers to, as an array."""
    after = F.slice(_cuts(formula), F.lit(2), F.size(_cuts(formula)))
    closed = F.filter(after, lambda piece: piece.contains(")"))
    return F.array_distinct(F.transform(closed, lambda piece: F.substring_index(piece, ")", 1)))


def reference_pieces(formula: Column) -> Column:
    """A text with references as ``array<struct<pos, lead, ref, tail>>``.

    ``lead || item(ref) || tail`` over all pieces in ``pos`` order is the text again. An
    ``item(`` that is never closed has a NULL ``ref`` and sits in ``tail``.
    """
    cuts = _cuts(formula)
    after = F.slice(cuts, F.lit(2), F.size(cuts))

    def piece(part: Column, pos: Column) -> Column:
        ref = F.when(part.contains(")"), F.substring_index(part, ")", 1))
        return F.struct(
            pos.alias("pos"),
            F.when(pos == 0, cuts[0]).otherwise("").alias("lead"),
            ref.alias("ref"),
            F.when(ref.isNull(), F.concat(F.lit(OPENING), part))
            .otherwise(F.substr(part, F.length(ref) + 2))
            .alias("tail"),
        )

    return F.transform(after, piece)


def filled_piece(lead: Column, ref: Column, tail: Column, argument: Column) -> Column:
    """A piece's text with the reference replaced by ``argument``, or kept where NULL."""
    kept = F.when(ref.isNull(), F.lit("")).otherwise(F.concat(F.lit(OPENING), ref, F.lit(")")))
    return F.concat(lead, F.coalesce(argument, kept), tail)


def int_text(value: Column) -> Column:
    """A double cut toward zero and written as a 32-bit int; saturates, NaN is 0."""
    return (
        F.when(value.isNull(), None)
        .when(F.isnan(value), "0")
        .when(value >= INT_MAX, str(INT_MAX))
        .when(value <= INT_MIN, str(INT_MIN))
        .otherwise(value.cast("int").cast("string"))
    )


def is_open(text: Column) -> Column:
    """True while a text still holds anything that reads as a reference."""
    return text.contains(REFERENCE)
