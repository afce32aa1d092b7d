"""Column expressions for consequence terms, LoF confidence and frequencies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tailfold import vocab
from tailfold.functions.values import one_of, strip, to_double

HC_RANK, LC_RANK = 0, 1


def _severity_array() -> Column:
    return F.expr("array('" + "', '".join(vocab.CONSEQUENCE_SEVERITY) + "')")


def consequence_terms(c: Column) -> Column:
    """Terms between ``&`` or ``,`` without blanks, missing tokens and repeats."""
    terms = F.split(strip(c), r"(?U)\s*[&,]\s*")
    return F.array_distinct(
        F.filter(terms, lambda t: ~one_of(F.lower(t), vocab.MISSING_CONSEQUENCE))
    )


def term_ranks(terms: Column) -> Column:
    """1 = most severe term of the vocabulary, 0 = not in it, per term."""
    listed = F.lit(",".join(vocab.CONSEQUENCE_SEVERITY))
    return F.transform(terms, lambda t: F.find_in_set(t, listed))


def unknown_terms(terms: Column) -> Column:
    return F.array_except(terms, _severity_array())


def severity_rank(ranks: Column) -> Column:
    """0 = most severe recognised term, from ``term_ranks``; NULL when none is known."""
    return F.array_min(F.filter(ranks, lambda r: r > 0)) - 1


def consequence_of_rank(rank: Column) -> Column:
    return F.get(_severity_array(), rank)


def loftee_rank(word: Column) -> Column:
    """Rank of a stripped, upper-cased LoF label."""
    return F.when(word == "HC", HC_RANK).when(word == "LC", LC_RANK)


def loftee_of_rank(rank: Column) -> Column:
    return F.when(rank == HC_RANK, "HC").when(rank == LC_RANK, "LC")


def is_missing_label(word: Column) -> Column:
    return one_of(F.lower(word), vocab.MISSING_GENE)


def is_missing_gene(c: Column) -> Column:
    return one_of(F.lower(c), vocab.MISSING_GENE)


def frequency(c: Column, number: Column | None = None) -> Column:
    """struct(status, raw_af, maf, converted) of an allele-frequency text.

    Above one half the minor frequency is ``1 - AF`` in decimal arithmetic, so
    0.99 gives exactly 0.01 and an inclusive cut-off keeps it.  ``number`` takes
    the already parsed value, to parse each text once.
    """
    raw = to_double(c) if number is None else number
    inside = raw.between(0.0, 1.0)
    exact_complement = (F.lit(1) - F.trim(c).try_cast("decimal(29,28)")).cast("double")
    status = (
        F.when(inside, "valid").when(raw.isNotNull(), "out_of_range")
        .when(one_of(F.lower(strip(c)), vocab.MISSING_FREQUENCY), "missing")
        .otherwise("non_numeric")
    )
    return F.struct(
        status.alias("status"),
        F.when(inside, raw).alias("raw_af"),
        F.when(inside, F.when(raw <= 0.5, raw).otherwise(exact_complement)).alias("maf"),
        F.coalesce(inside & (raw > 0.5), F.lit(False)).alias("converted"),
    )
