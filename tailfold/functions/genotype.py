"""Column expressions over VCF INFO, FORMAT and sample arrays.

Everything stays on the record's own row: counting alleles over the sample array
needs no shuffle, and only the rare non-reference calls are walked per ALT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tailfold.functions.values import INTEGER


def info_ac_items(info: Column) -> Column:
    """Comma-separated text of the first ``AC=`` entry, or NULL without one."""
    hits = F.filter(F.split(info, ";"), lambda item: item.startswith("AC="))
    return F.split(F.substring(F.get(hits, F.lit(0)), 4, 2**31 - 1), ",")


def info_ac(info: Column, alt_index: Column) -> Column:
    """INFO allele count of one ALT (1-based index); NULL when not given."""
    return F.try_element_at(info_ac_items(info), alt_index).try_cast("bigint")


def info_ac_problem(info: Column, alt_count: Column) -> Column:
    items = info_ac_items(info)
    given = items.isNotNull() & ~((F.size(items) == 1) & (items[0] == "."))
    known = F.filter(items, lambda v: v != ".")
    return (
        F.when(given & (F.size(items) != alt_count), "an INFO/AC count that differs from ALT")
        .when(given & F.exists(known, lambda v: ~v.rlike(INTEGER)), "a non-integer INFO/AC")
        .when(given & F.exists(known, lambda v: v.try_cast("bigint") < 0), "a negative INFO/AC")
    )


def genotype_index(fmt: Column) -> Column:
    """0-based position of GT in FORMAT, -1 when absent."""
    return (F.array_position(F.split(fmt, ":"), "GT") - 1).cast("int")


def genotype_texts(samples: Column, gt_index: Column) -> Column:
    """GT text per sample with ``/`` as the only separator; '.' when not given."""

    def gt(sample: Column) -> Column:
        first = F.substring_index(sample, ":", 1)
        other = F.coalesce(F.get(F.split(sample, ":"), gt_index), F.lit("."))
        return F.translate(F.when(gt_index == 0, first).otherwise(other), "|", "/")

    return F.transform(samples, gt)


def calls(texts: Column) -> Column:
    """array<struct<pos, called, tokens, alts>> from normalised GT texts."""

    def call(text: Column, position: Column) -> Column:
        tokens = F.split(text, "/")
        called = F.filter(tokens, lambda t: (t != ".") & (t != ""))
        return F.struct(
            position.alias("pos"),
            F.size(called).alias("called"),
            F.size(tokens).alias("tokens"),
            F.transform(
                F.filter(called, lambda t: t != "0"), lambda t: t.try_cast("int")
            ).alias("alts"),
        )

    return F.transform(texts, call)


def genotype_problem(texts: Column, alt_count: Column) -> Column:
    """Message for a record holding an allele index that is not 0..ALT count."""

    def bad(text: Column) -> Column:
        tokens = F.filter(F.split(text, "/"), lambda t: t != ".")
        return F.exists(
            tokens, lambda t: ~F.coalesce(t.try_cast("int").between(0, alt_count), F.lit(False))
        ) & (text != "")

    return F.when(F.exists(texts, bad), "a GT allele index outside REF/ALT")


def state_counts(call_array: Column) -> dict[str, Column]:
    """Per-record numbers of complete, partial and fully missing genotypes."""

    def count(test) -> Column:
        return F.size(F.filter(call_array, test)).cast("bigint")

    missing = count(lambda c: c["called"] == 0)
    partial = count(lambda c: (c["called"] > 0) & (c["called"] < c["tokens"]))
    return {
        "complete": F.size(call_array).cast("bigint") - missing - partial,
        "partial": partial,
        "fully_missing": missing,
    }


def with_alt(call_array: Column) -> Column:
    """The calls that carry at least one ALT allele."""
    return F.filter(call_array, lambda c: F.exists(c["alts"], lambda a: a > 0))


def alt_allele_count(alt_calls: Column, alt_index: Column) -> Column:
    return F.aggregate(
        alt_calls,
        F.lit(0).cast("bigint"),
        lambda n, c: n + F.size(F.filter(c["alts"], lambda a: a == alt_index)),
    )


def alt_carriers(alt_calls: Column, alt_index: Column) -> Column:
    """Sample positions that carry the ALT, each once."""
    return F.transform(
        F.filter(alt_calls, lambda c: F.array_contains(c["alts"], alt_index)),
        lambda c: c["pos"],
    )
