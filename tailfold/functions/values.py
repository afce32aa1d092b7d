"""Column expressions for identifiers, numbers and flags in text inputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tailfold import vocab

# fixed values: identifier and number patterns (Java regular expressions)
TRAILING_VERSION = r"\.[0-9]+$"
GENE_PREFIX = "ENSG"
GENE_TOKEN = r"(?<![A-Za-z0-9])(ENSG[0-9]+)(?:\.[0-9]+)?"
WHOLE_GENE_WITH_VERSION = r"^(ENSG[0-9]+)\.[0-9]+$"
INTEGER = r"^\s*[+-]?[0-9]+\s*$"
JAVA_SUFFIX = "[dDfF]"
DIGITS = tuple("0123456789")


# every character Unicode counts as white space
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip(c: Column) -> Column:
    """Trim Unicode white space; plain ``trim`` would only remove spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank(c: Column) -> Column:
    """Whether ``strip`` leaves nothing; looks no further than the first other character."""
    return F.ltrim(c, F.lit(WHITESPACE)) == ""


def one_of(c: Column, words) -> Column:
    return c.isin(*words)


# ------------------------------------------------------------- identifiers


def drop_version(c: Column) -> Column:
    """Remove one trailing ``.digits`` from any identifier."""
    return F.regexp_replace(c, TRAILING_VERSION, "")


def gene_tokens(c: Column) -> Column:
    """All Ensembl gene IDs inside a composite identifier, without versions."""
    return F.regexp_extract_all(c, F.lit(GENE_TOKEN), F.lit(1))


def single_gene(c: Column) -> Column:
    """The only gene ID of a composite identifier, or NULL for none or several.

    Most identifiers hold the prefix once and so have no second gene to look for.
    """
    tokens = gene_tokens(c)
    only = F.get(tokens, F.lit(0))
    several = F.substring_index(c, GENE_PREFIX, 2) != c
    return F.when(several, F.when(F.size(tokens) == 1, only)).otherwise(only)


def gene_problem(c: Column) -> Column:
    tokens = gene_tokens(c)
    return (
        F.when(blank(c), F.lit("an empty ID"))
        .when(F.size(tokens) == 0, F.lit("an unsupported ID"))
        .when(F.size(tokens) > 1, F.lit("an ambiguous ID"))
    )


def match_gene(c: Column) -> Column:
    """Remove the version only when the whole string is a versioned gene ID."""
    return F.regexp_replace(c, WHOLE_GENE_WITH_VERSION, "$1")


# ----------------------------------------------------------------- numbers


def to_long(c: Column) -> Column:
    return F.when(c.rlike(INTEGER), F.trim(c).try_cast("bigint"))


def to_double(c: Column) -> Column:
    """Finite double, or NULL.

    Suffixed and hexadecimal literals, which only Java accepts, are kept out.  Most
    numbers end in a digit and never meet the pattern.  No finite number begins with
    an N: missing values, most cells of a sparse matrix, skip the failing cast.
    """
    number = c.try_cast("double")
    finite = F.abs(number) < F.lit(float("inf"))
    plain = F.substring(c, -1, 1).isin(*DIGITS) | ~c.rlike(JAVA_SUFFIX)
    named = c.startswith("N") | c.startswith("n")
    return F.when(~named & finite & plain & ~c.contains("x") & ~c.contains("X"), number)


def is_missing_phenotype(c: Column) -> Column:
    return (c == "NA") | one_of(F.lower(strip(c)), vocab.MISSING_PHENOTYPE)


def phenotype(c: Column) -> Column:
    """Phenotype value; missing tokens and bad numbers are both NULL."""
    return to_double(c)


def is_bad_phenotype(c: Column) -> Column:
    return (c != "NA") & to_double(c).isNull() & ~is_missing_phenotype(c)


def tss_problem(start: Column, end: Column) -> Column:
    lo, hi = to_long(start), to_long(end)
    return (
        F.when(lo.isNull() | hi.isNull(), F.lit("non-integer BED coordinates"))
        .when((lo < 0) | (hi < 1), F.lit("invalid BED coordinates"))
        .when(hi - lo != 1, F.lit("a TSS interval that is not one base wide"))
    )


# ------------------------------------------------------------------- flags


def truth(c: Column) -> Column:
    word = F.lower(strip(c))
    return F.when(one_of(word, vocab.TRUE_WORDS), True).when(
        one_of(word, vocab.FALSE_WORDS), False
    )


def class_tokens(c: Column) -> Column:
    """Upper-cased, de-duplicated comma-separated class labels."""
    upper = F.transform(F.split(c, ","), lambda t: F.upper(strip(t)))
    return F.array_distinct(F.filter(upper, lambda t: t != ""))


def outlier(value: Column, threshold, tail: str) -> Column:
    limit = F.lit(threshold) if not isinstance(threshold, Column) else threshold
    return {
        "absolute": F.abs(value) >= limit,
        "positive": value >= limit,
        "negative": value <= -limit,
    }[tail]


# -------------------------------------------------------------- attributes


def gtf_attributes(c: Column) -> Column:
    """``key "value";`` text as a map; the last of repeated keys wins."""
    parts = F.filter(
        F.transform(F.split(c, ";"), strip), lambda p: p.rlike(r"(?U)^\S+\s+\S")
    )

    def entry(part: Column) -> Column:
        raw = F.regexp_replace(part, r"(?U)^\S+\s+", "")
        return F.struct(
            F.regexp_extract(part, r"(?U)^(\S+)", 1).alias("k"),
            F.regexp_replace(raw, r'(?s)^"(.*)"$', "$1").alias("v"),
        )

    return F.transform(parts, entry)


def gtf_attribute(c: Column, key: str) -> Column:
    hits = F.filter(gtf_attributes(c), lambda e: e["k"] == key)
    return F.try_element_at(hits, F.lit(-1))["v"]
