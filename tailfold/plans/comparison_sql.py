"""Plain SQL for the registered queries, to check them on another engine.

Each text states the same result independently: theta joins instead of bins, window
formulas instead of the blocked QR, log-gamma sums instead of the recurrence.
"""

from __future__ import annotations

from tailfold import vocab
from tailfold.plans import file_queries as FQ
from tailfold.plans import queries as Q
from tailfold.plans import surrogates as S


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _round(*columns) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


TERMS = _list(vocab.CONSEQUENCE_SEVERITY)

# ------------------------------------------------------------ shared tables

LINES = """lines AS (
  SELECT l.*, CAST(l_suppkey AS VARCHAR) AS sample_id, p_brand AS gene_id
  FROM lineitem l JOIN part ON l_partkey = p_partkey)"""

OBS = f"""obs AS (
  SELECT gene_id, sample_id,
    CASE WHEN count(*) >= {S.MIN_CELL_ROWS}
      THEN CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) END AS value
  FROM lines GROUP BY ALL)"""

PAIRS = """pairs AS (
  SELECT sample_id, gene_id, true AS is_any_lof, bool_or(l_linestatus = 'F') AS is_hc,
    true AS is_hc_or_lc
  FROM lines WHERE l_returnflag = 'R' AND l_quantity >= 49 GROUP BY ALL)"""

FLAGGED = """flagged AS (
  SELECT o.gene_id, o.sample_id, value, coalesce(is_any_lof, false) AS is_any_lof,
    coalesce(is_hc, false) AS is_hc, coalesce(is_hc_or_lc, false) AS is_hc_or_lc
  FROM obs o LEFT JOIN pairs p ON o.gene_id = p.gene_id AND o.sample_id = p.sample_id)"""


def _z(first: str, second: str) -> str:
    """Nested residual z-scores by Gram-Schmidt within each gene with enough samples."""
    return f"""usable AS (
  SELECT gene_id, sample_id, value AS y, {first} AS a, {second} AS b
  FROM obs JOIN supplier ON sample_id = CAST(s_suppkey AS VARCHAR) WHERE value IS NOT NULL),
r0 AS (
  SELECT gene_id, sample_id, y - avg(y) OVER g AS r0, a - avg(a) OVER g AS a, b - avg(b) OVER g AS b
  FROM usable WINDOW g AS (PARTITION BY gene_id)),
r1 AS (
  SELECT *, r0 - a * (sum(a * r0) OVER g / sum(a * a) OVER g) AS r1,
    b - a * (sum(a * b) OVER g / sum(a * a) OVER g) AS bp
  FROM r0 WINDOW g AS (PARTITION BY gene_id)),
r2 AS (
  SELECT *, r1 - bp * (sum(bp * r1) OVER g / sum(bp * bp) OVER g) AS r2
  FROM r1 WINDOW g AS (PARTITION BY gene_id)),
wide AS (
  SELECT gene_id, sample_id, count(*) OVER g AS n, r0 / sqrt(avg(r0 * r0) OVER g) AS z0,
    r1 / sqrt(avg(r1 * r1) OVER g) AS z1, r2 / sqrt(avg(r2 * r2) OVER g) AS z2
  FROM r2 WINDOW g AS (PARTITION BY gene_id)),
zs AS (
  SELECT gene_id, sample_id, step, z
  FROM (SELECT *, unnest([0, 1, 2]) AS step, unnest([z0, z1, z2]) AS z FROM wide)
  WHERE n > step + 2)"""


def _statistics(n11, outliers, n01, others) -> str:
    """Rates and ratios from (carriers, group size) of both groups."""
    b, d = f"({outliers} - {n11})", f"({others} - {n01})"
    return f"""
    CAST({n11} AS DOUBLE) / nullif({outliers}, 0) AS outlier_carrier_rate,
    CAST({n01} AS DOUBLE) / nullif({others}, 0) AS nonoutlier_carrier_rate,
    (CAST({n11} AS DOUBLE) / nullif({outliers}, 0))
      / nullif(CAST({n01} AS DOUBLE) / nullif({others}, 0), 0) AS carrier_rate_ratio,
    (CAST({n11} AS DOUBLE) * {d}) / nullif(CAST({n01} AS DOUBLE) * {b}, 0) AS odds_ratio,
    (({n11} + 0.5::DOUBLE) * ({d} + 0.5::DOUBLE)) / (({n01} + 0.5::DOUBLE) * ({b} + 0.5::DOUBLE))
      AS odds_ratio_corrected_0_5"""


def _fisher(source: str) -> str:
    """CTE ``tested``: ``source`` plus fisher_p_value by summing the support."""
    def logp(x):
        return f"""(lgamma(r + 1) - lgamma({x} + 1) - lgamma(r - {x} + 1)
        + lgamma(s + 1) - lgamma(c - {x} + 1) - lgamma(s - c + {x} + 1)
        - lgamma(r + s + 1) + lgamma(c + 1) + lgamma(r + s - c + 1))"""

    return f"""margins AS (
  SELECT DISTINCT n11, n10, n01, n00, n11 + n10 AS r, n01 + n00 AS s, n11 + n01 AS c FROM {source}),
support AS (
  SELECT *, unnest(generate_series(greatest(0, c - s), least(r, c))) AS x FROM margins),
fisher AS (
  SELECT n11, n10, n01, n00,
    least(1.0, sum(CASE WHEN {logp('x')} <= {logp('n11')} + 1e-7 THEN exp({logp('x')}) ELSE 0 END))
      AS fisher_p_value
  FROM support GROUP BY ALL),
tested AS (
  SELECT t.*, fisher_p_value FROM {source} t JOIN fisher f
    ON t.n11 = f.n11 AND t.n10 = f.n10 AND t.n01 = f.n01 AND t.n00 = f.n00)"""


def _bh(source: str, p: str, out: str) -> str:
    """CTE ``adjusted``: Benjamini-Hochberg over all rows of ``source``."""
    return f"""ranked AS (
  SELECT *, {p} * count(*) OVER () / count(*) OVER (ORDER BY {p}) AS scaled FROM {source}),
adjusted AS (
  SELECT * EXCLUDE (scaled),
    least(1.0, min(scaled) OVER (ORDER BY {p} DESC)) AS {out}
  FROM ranked)"""


def _lof_pc(first: str, second: str, steps: dict[int, int]) -> str:
    step_case = " ".join(f"WHEN {s} THEN {k}" for s, k in steps.items())
    return _with(
        LINES, OBS, PAIRS, FLAGGED, _z(first, second),
        f"""scored AS (
  SELECT CASE step {step_case} END AS pc_count, z.gene_id, z, is_any_lof, is_hc, is_hc_or_lc
  FROM zs z JOIN flagged f ON z.gene_id = f.gene_id AND z.sample_id = f.sample_id
  WHERE step IN ({', '.join(map(str, steps))})),
grid AS (
  SELECT *, unnest({_list(S.Z_LOW)}) AS t, unnest_def AS carrier_definition,
    CASE unnest_def WHEN 'any_lof' THEN is_any_lof WHEN 'HC' THEN is_hc ELSE is_hc_or_lc END AS carrier
  FROM (SELECT *, unnest({_list(vocab.CARRIER_DEFINITIONS)}) AS unnest_def FROM scored)),
counted AS (
  SELECT CAST(pc_count AS INTEGER) AS pc_count, CAST(t AS DOUBLE) AS z_threshold, carrier_definition,
    count(DISTINCT gene_id) AS eligible_gene_count, count(*) AS total_observations,
    count(*) FILTER (z <= t) AS outlier_observations,
    count(*) FILTER (carrier) AS carrier_observations,
    count(*) FILTER (carrier AND z <= t) AS n11, count(*) FILTER (carrier AND z > t) AS n10,
    count(*) FILTER (NOT carrier AND z <= t) AS n01, count(*) FILTER (NOT carrier AND z > t) AS n00
  FROM grid GROUP BY ALL)""",
        _fisher("counted"), _bh("tested", "fisher_p_value", "fisher_fdr_bh"),
        f"""final AS (SELECT *, {_statistics('n11', '(n11 + n01)', 'n10', '(n10 + n00)')}
  FROM adjusted)""",
    ) + f"""SELECT * EXCLUDE ({', '.join(Q.STAT_COLUMNS)}), {_round(*Q.STAT_COLUMNS)} FROM final"""


SUPPLIER_TABLES = """tables AS (
  SELECT l_returnflag, l_suppkey,
    count(*) FILTER (l_quantity >= 30 AND l_linestatus = 'F') AS n11,
    count(*) FILTER (l_quantity < 30 AND l_linestatus = 'F') AS n10,
    count(*) FILTER (l_quantity >= 30 AND l_linestatus <> 'F') AS n01,
    count(*) FILTER (l_quantity < 30 AND l_linestatus <> 'F') AS n00
  FROM lineitem GROUP BY ALL)"""

SWEEP = """sweep AS (
  SELECT l_linenumber * 10 AS pc_count, -3.0 - floor((l_quantity - 1) / 13) AS z_threshold,
    CASE l_returnflag WHEN 'R' THEN 'HC' WHEN 'A' THEN 'any_lof' ELSE 'HC_or_LC' END
      AS carrier_definition,
    CAST(count(*) FILTER (l_discount > 0.045 AND l_linestatus = 'F') AS DOUBLE)
      * count(*) FILTER (l_discount <= 0.045 AND l_linestatus <> 'F')
      / nullif(CAST(count(*) FILTER (l_discount <= 0.045 AND l_linestatus = 'F') AS DOUBLE)
      * count(*) FILTER (l_discount > 0.045 AND l_linestatus <> 'F'), 0) AS odds_ratio
  FROM lineitem GROUP BY ALL),
points AS (
  SELECT carrier_definition, pc_count, median(ln(odds_ratio)) AS median_log_odds_ratio,
    exp(median(ln(odds_ratio))) AS median_odds_ratio,
    count(DISTINCT z_threshold) AS n_thresholds,
    string_agg(DISTINCT CAST(CAST(z_threshold AS INTEGER) AS VARCHAR), ','
      ORDER BY CAST(CAST(z_threshold AS INTEGER) AS VARCHAR)) AS thresholds_present
  FROM sweep WHERE carrier_definition IN ('HC', 'any_lof') AND odds_ratio > 0 GROUP BY ALL)"""

# ------------------------------------------------------- variants, features

FEATURES = f"""features AS (
  SELECT 'chr' || p_size % 5 AS chrom, p_partkey * {S.BASES_PER_PART} + 1 AS tss,
    'ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') || '.' || p_size % 9 AS feature_id,
    'ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') AS gene_key, p_partkey
  FROM part)"""

VARIANTS = f"""variants AS (
  SELECT o_orderkey, 'chr' || o_custkey % 5 AS chrom, o_orderkey * {S.BASES_PER_ORDER} + 1 AS pos,
    'A' AS ref, o_orderstatus AS alt, coalesce(ac, 0) AS ac
  FROM orders LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_suppkey) AS ac FROM lineitem GROUP BY 1)
    ON o_orderkey = l_orderkey)"""

TRANSCRIPTS = f"""raw_rows AS (
  SELECT chrom, pos, ref, alt, o_orderkey,
    (l_linenumber, l_partkey, l_suppkey, l_quantity, l_tax, l_discount) AS ord,
    CASE WHEN l_quantity = 1 THEN 'NA' WHEN l_quantity = 2 THEN '.' ELSE 'ENSG' ||
      lpad(CAST(greatest(CAST(floor(o_orderkey * {S.BASES_PER_ORDER} / {S.BASES_PER_PART}) AS BIGINT)
        + l_linenumber - 4, 0) AS VARCHAR), 11, '0') || '.' || l_linenumber END AS gene_id,
    {TERMS}[l_partkey % 41 + 1] AS first_term,
    CASE WHEN l_suppkey % 7 = 0 THEN 'made_up_term' WHEN l_suppkey % 7 = 1 THEN 'NA'
      ELSE {TERMS}[l_suppkey % 41 + 1] END AS second_term,
    CASE WHEN l_linestatus = 'F' THEN '&' ELSE ', ' END AS separator,
    CASE WHEN l_tax > 0.075 THEN 'NA' WHEN l_quantity = 50 THEN 'abc' WHEN l_quantity = 49 THEN '1.5'
      WHEN l_discount > 0.095 THEN '0.25' ELSE
      {_list(("0.001", "0.99", "9.99e-1", "0.02", "0.01"))}[o_orderkey % 5 + 1] END AS gvs_max_af,
    CASE l_returnflag WHEN 'R' THEN ' hc' WHEN 'A' THEN 'LC'
      ELSE CASE WHEN l_linestatus = 'F' THEN '.' ELSE 'OS' END END AS lof
  FROM lineitem JOIN variants ON l_orderkey = o_orderkey),
transcripts AS (
  SELECT *,
    CASE WHEN gene_id IN ('NA', '.') THEN NULL ELSE split_part(gene_id, '.', 1) END AS gene_key,
    list_filter(list_distinct([first_term, second_term]), lambda t: t <> 'NA') AS terms,
    list_filter([list_position({TERMS}, first_term), list_position({TERMS}, second_term)],
      lambda p: p > 0) AS positions,
    CASE WHEN second_term = 'made_up_term' THEN 1 ELSE 0 END AS n_unknown,
    CASE lof WHEN ' hc' THEN 'hc' WHEN 'LC' THEN 'lc' WHEN '.' THEN 'missing'
      ELSE 'unrecognized' END AS loftee_state,
    CASE gvs_max_af WHEN 'NA' THEN 'missing' WHEN 'abc' THEN 'non_numeric'
      WHEN '1.5' THEN 'out_of_range' ELSE 'valid' END AS status,
    CASE WHEN gvs_max_af NOT IN ('NA', 'abc', '1.5') THEN CAST(gvs_max_af AS DOUBLE) END AS raw_af
  FROM raw_rows),
mafs AS (
  SELECT *, CASE WHEN raw_af <= 0.5 THEN raw_af
    ELSE CAST(1 - CAST(CAST(raw_af AS VARCHAR) AS DECIMAL(18,12)) AS DOUBLE) END AS maf
  FROM transcripts)"""

FREQUENCIES = f"""anchored AS (
  SELECT chrom, pos, ref, alt, arg_min(raw_af, ord) FILTER (status = 'valid') AS raw_af,
    arg_min(maf, ord) FILTER (status = 'valid') AS maf,
    arg_max(status, ord) FILTER (status <> 'valid') AS problem
  FROM mafs GROUP BY ALL),
apart AS (
  SELECT DISTINCT a.chrom, a.pos, a.ref, a.alt FROM anchored a JOIN mafs m
    ON a.chrom = m.chrom AND a.pos = m.pos AND a.ref = m.ref AND a.alt = m.alt
  WHERE abs(m.raw_af - a.raw_af) > {vocab.FREQUENCY_TOLERANCE}),
frequencies AS (
  SELECT a.chrom, a.pos, a.ref, a.alt,
    CASE WHEN x.pos IS NOT NULL THEN 'inconsistent' ELSE coalesce(problem, 'valid') END AS status,
    raw_af, maf
  FROM anchored a LEFT JOIN apart x
    ON a.chrom = x.chrom AND a.pos = x.pos AND a.ref = x.ref AND a.alt = x.alt)"""

ANNOTATIONS = f"""annotations AS (
  SELECT chrom, pos, ref, alt, gene_key,
    {TERMS}[min(list_min(positions))] AS consequence,
    CASE WHEN bool_or(loftee_state = 'hc') THEN 'HC' WHEN bool_or(loftee_state = 'lc') THEN 'LC' END
      AS loftee
  FROM mafs WHERE gene_key IS NOT NULL GROUP BY ALL)"""

RARE_PAIRS = f"""near_pairs AS (
  SELECT v.o_orderkey, v.chrom, v.pos, v.ref, v.alt, v.ac, f.tss, f.feature_id, f.gene_key,
    abs(v.pos - f.tss) AS distance
  FROM variants v JOIN frequencies q
    ON v.chrom = q.chrom AND v.pos = q.pos AND v.ref = q.ref AND v.alt = q.alt
  JOIN features f ON v.chrom = f.chrom AND abs(v.pos - f.tss) <= {Q.DISTANCE}
  WHERE q.status = 'valid' AND q.maf <= {Q.MAX_MAF}),
rare_pairs AS (
  SELECT n.*, a.gene_key IS NOT NULL AS matched, consequence, loftee
  FROM near_pairs n LEFT JOIN annotations a ON n.chrom = a.chrom AND n.pos = a.pos
    AND n.ref = a.ref AND n.alt = a.alt AND n.gene_key = a.gene_key)"""

_AC_LABELS = [(f"AC={v}", f"ac = {v}") for v in Q.EXACT_AC] + [
    (f"AC<={v}", f"ac <= {v}") for v in Q.CUMULATIVE_AC]
_AC_LIST = "[" + ", ".join(f"CASE WHEN {t} THEN '{n}' END" for n, t in _AC_LABELS) + "]"

MINIMA = f"""strata AS (
  SELECT * FROM (SELECT *, unnest({_AC_LIST}) AS ac_class, unnest_key.f AS annotation_family,
      unnest_key.c AS annotation_class
    FROM (SELECT *, unnest([
        {{'f': 'baseline', 'c': 'all_rare_variants'}},
        {{'f': 'consequence', 'c': CASE WHEN consequence IN ({_quoted(S.CONSEQUENCES)})
          THEN consequence END}},
        {{'f': 'loftee', 'c': loftee}}]) AS unnest_key FROM rare_pairs))
  WHERE ac_class IS NOT NULL AND annotation_class IS NOT NULL),
minima AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS sample_id, feature_id, ac_class, annotation_family,
    annotation_class, min(distance) AS minimum_distance_bp
  FROM strata JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)"""

RARE_CHAIN = (VARIANTS, TRANSCRIPTS, FREQUENCIES, ANNOTATIONS, FEATURES, RARE_PAIRS)

FEATURE_OBS = """fobs AS (
  SELECT feature_id, CAST(l_suppkey AS VARCHAR) AS sample_id,
    (CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) FILTER (l_discount < 0.095) AS DOUBLE)
      / nullif(count(*) FILTER (l_discount < 0.095), 0) - 50000.0::DOUBLE) / 20000.0::DOUBLE AS value
  FROM lineitem JOIN features ON l_partkey = p_partkey GROUP BY feature_id, l_suppkey)"""


def _merged(low: str, high: str, apart: str) -> str:
    """CTE ``merged``: gaps-and-islands over feature windows."""
    return f"""windows AS (SELECT chrom, {low} AS lo, {high} AS hi FROM features),
reach AS (
  SELECT *, max(hi) OVER (PARTITION BY chrom ORDER BY lo, hi
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM windows),
islands AS (
  SELECT *, sum(CASE WHEN before IS NULL OR lo {apart} before THEN 1 ELSE 0 END)
    OVER (PARTITION BY chrom ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island FROM reach),
merged AS (SELECT chrom, min(lo) AS lo, max(hi) AS hi FROM islands GROUP BY chrom, island)"""


OPEN_WINDOWS = _merged(f"greatest(0, tss - {Q.WINDOW} - 1)", f"tss + {Q.WINDOW}", ">=")
CLOSED_WINDOWS = _merged(f"greatest(1, tss - {Q.WINDOW})", f"tss + {Q.WINDOW}", ">")

REACH_CHUNKS = _merged(f"greatest(1, tss - {FQ.REACH})", f"tss + {FQ.REACH}", ">") + f""",
chunks AS (
  SELECT chrom, lo AS window_start, (s - lo) // {FQ.REACH_CHUNK} AS piece, s,
    least(hi, s + {FQ.REACH_CHUNK} - 1) AS e
  FROM (SELECT *, unnest(generate_series(lo, hi, {FQ.REACH_CHUNK})) AS s FROM merged)),
spans AS (
  SELECT o_orderkey, chrom, pos, pos + o_orderkey % {S.LONG_RECORD_BP}
    + CASE WHEN o_orderkey % 500 = 3 THEN {S.FAR_RECORD_BP} ELSE 0 END AS end_pos FROM variants),
met AS (
  SELECT r.o_orderkey, r.chrom, end_pos, window_start, piece, pos >= s AS starts_here
  FROM spans r JOIN chunks c ON r.chrom = c.chrom AND pos <= e AND end_pos >= s)"""

# ---------------------------------------------------------------- VCF texts



def _per_line(expression: str) -> str:
    return ", ".join(f"max({expression}) FILTER (l_linenumber = {j}) AS s{j}" for j in range(1, 8))


# genotype text sorts like this with the depth suffix the texts carry
_SUFFIXED = _list(("0/0:9", "0/1:9", "1|2:9", "./.:9", "1/.:9", "2"))
GENOTYPES = f"""per_line AS (
  SELECT l_orderkey, {_per_line(f"{_SUFFIXED}[CAST(l_quantity AS INTEGER) % 6 + 1]")}
  FROM lineitem GROUP BY 1),
gts AS (
  SELECT o_orderkey, chrom, pos, ref, alt AS status,
    [{', '.join(f"split_part(coalesce(s{j}, '.'), ':', 1)" for j in range(1, 8))}] AS gt
  FROM variants LEFT JOIN per_line ON o_orderkey = l_orderkey),
states AS (
  SELECT *, len(list_filter(gt, lambda g: g IN ('.', './.'))) AS fully_missing,
    len(list_filter(gt, lambda g: g = '1/.')) AS partial FROM gts),
alts AS (
  SELECT *, unnest([1, 2]) AS alt_index, unnest(['C', 'G']) AS alt FROM states),
alleles AS (
  SELECT chrom, pos, ref, alt, alt_index, fully_missing, partial, o_orderkey,
    CASE WHEN o_orderkey % 4 = 0 THEN alt_index
      WHEN o_orderkey % 4 = 2 AND alt_index = 1 THEN 3 END::BIGINT AS info_ac,
    CASE alt_index WHEN 1 THEN len(list_filter(gt, lambda g: g IN ('0/1', '1|2', '1/.')))
      ELSE len(list_filter(gt, lambda g: g IN ('1|2', '2'))) END AS genotype_ac,
    fully_missing + partial = 0 AS complete, fully_missing < 7 AS any_called,
    array_to_string(list_filter([0,1,2,3,4,5,6], lambda i: CASE alt_index
      WHEN 1 THEN gt[i + 1] IN ('0/1', '1|2', '1/.') ELSE gt[i + 1] IN ('1|2', '2') END), ',')
      AS carriers
  FROM alts)"""

# the same alleles once for every chunk that their record reaches
CHUNK_ALLELES = """chunk_alleles AS (
  SELECT a.*, m.end_pos, m.starts_here, coalesce(info_ac, CASE WHEN any_called THEN genotype_ac END) AS ac
  FROM alleles a JOIN met m ON a.o_orderkey = m.o_orderkey)"""
CALLED = """called AS (
  SELECT o_orderkey, chrom, pos, ref, status AS alt, coalesce(info_ac, CASE WHEN any_called THEN genotype_ac END) AS ac
  FROM (SELECT a.*, status FROM alleles a JOIN states USING (o_orderkey))
  WHERE alt_index = 1 AND (info_ac IS NOT NULL OR any_called)
    AND o_orderkey IN (SELECT o_orderkey FROM met WHERE starts_here)),
carried AS (
  SELECT o_orderkey, unnest(list_filter([1, 2, 4, 5, 6, 7],
    lambda i: gt[i] IN ('0/1', '1|2', '1/.'))) AS line FROM states)"""
CALLED_MINIMA = MINIMA.replace("CAST(l_suppkey AS VARCHAR) AS sample_id", "chrom, 'L' || line AS sample_id").replace(
    "JOIN lineitem ON o_orderkey = l_orderkey", "JOIN carried USING (o_orderkey)")


# ------------------------------------------------------------------- texts

EXCLUSIONS = """cells AS (
  SELECT l_partkey, l_suppkey, max(CASE WHEN l_quantity >= 45 THEN l_quantity END) AS q
  FROM lineitem GROUP BY 1, 2),
vals AS (SELECT l_partkey AS g, l_suppkey % 2 AS x,
  CASE WHEN q >= 48 THEN 1.0::DOUBLE WHEN q IS NOT NULL THEN 0.0::DOUBLE END AS y FROM cells),
by_x AS (
  SELECT g, x, count(y) AS n, sum(y) AS s, sum(y * y) AS ss FROM vals GROUP BY 1, 2),
genes AS (
  SELECT g, CAST(sum(n) AS BIGINT) AS usable, count(*) FILTER (n > 0) AS groups,
    sum(ss) AS ss, sum(s) AS s, sum(CASE WHEN n > 0 THEN s * s / n ELSE 0 END) AS between_x
  FROM by_x GROUP BY 1),
fits AS (
  SELECT *, unnest([0, 1]) AS pc_count, unnest([1, least(groups, 2)]) AS r,
    unnest([ss - s * s / nullif(usable, 0), ss - between_x]) AS sse FROM genes),
judged AS (
  SELECT *, CASE WHEN usable = 0 THEN 'other' WHEN usable <= r + 1 THEN 'insufficient_dof'
    WHEN r < pc_count + 1 THEN 'rank_deficiency'
    WHEN sse < 1e-9 THEN 'invalid_or_zero_residual_sd' END AS reason FROM fits)"""

_ROW_COUNTERS = f"""count(*) FILTER (raw_af > 0.5) AS converted_gvs_max_af_values,
    CAST(sum(len(terms)) AS BIGINT) AS consequence_terms_parsed,
    CAST(sum(len(terms) - n_unknown) AS BIGINT) AS recognized_consequence_terms,
    CAST(sum(n_unknown) AS BIGINT) AS unknown_consequence_rows,
    {', '.join(f"count(*) FILTER (gene_key IS NOT NULL AND loftee_state = '{s}') AS loftee_{s}_values"
               for s in ('hc', 'lc', 'missing', 'unrecognized'))}"""
_COUNTERS = """
SELECT chrom, count(*) FILTER (first) AS extracted_records, count(*) AS alt_alleles,
  CAST(sum(7 - fully_missing - partial) FILTER (first) AS BIGINT) AS complete_genotype_calls,
  CAST(sum(partial) FILTER (first) AS BIGINT) AS partial_genotype_calls,
  CAST(sum(fully_missing) FILTER (first) AS BIGINT) AS fully_missing_genotype_calls,
  CAST(sum(fully_missing + partial) FILTER (first) AS BIGINT) AS missing_genotypes,
  count(info_ac) AS info_ac_alt_alleles,
  count(*) FILTER (info_ac IS NULL AND any_called) AS genotype_ac_fallback_alt_alleles,
  count(*) FILTER (info_ac IS NULL AND NOT any_called) AS unavailable_ac_alt_alleles,
  count(info_ac) FILTER (complete) AS info_genotype_ac_compared_alt_alleles,
  count(*) FILTER (complete AND info_ac <> genotype_ac) AS info_genotype_ac_mismatch_alt_alleles,
  count(info_ac) FILTER (NOT complete) AS info_genotype_ac_unchecked_alt_alleles,
  count(*) FILTER (info_ac IS NOT NULL OR any_called) AS classified_alt_alleles
FROM (SELECT *, alt_index = 1 AS first FROM {}) GROUP BY 1"""

SQL = {
    "identifier_normalisation": """
WITH ids AS (
  SELECT *, 'ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') AS bare,
    'ENSG' || lpad(CAST(p_size AS VARCHAR), 11, '0') AS other FROM part)
SELECT p_partkey, bare AS plain_id, bare || '.' || p_size AS one_suffix,
  'GENE.' || p_size AS kept_id, bare AS matched_id,
  CASE WHEN p_size % 3 = 0 THEN bare END AS token,
  CASE p_size % 3 WHEN 1 THEN 'an ambiguous ID' WHEN 2 THEN 'an unsupported ID' END AS problem,
  p_name AS trimmed
FROM ids""",
    "value_parsing": """
SELECT CASE WHEN l_linenumber <= 3 THEN true WHEN l_linenumber <= 6 THEN false END AS truth,
  l_discount >= 0.005 AND (l_tax < 0.005 OR l_tax > 0.075) AS bad, l_linestatus,
  count(*) AS n_rows, count(v) AS n_values, min(v) AS lowest, max(v) AS highest
FROM (SELECT *, CASE WHEN l_discount >= 0.005 AND l_tax BETWEEN 0.005 AND 0.075
  THEN l_extendedprice END AS v FROM lineitem) GROUP BY 1, 2, 3""",
    "phenotype_bed_long": """
SELECT sample_id, 'chr' || l_linenumber AS chrom, count(*) AS n_rows, count(value) AS n_values,
  0::BIGINT AS n_bad, count(DISTINCT l_partkey) AS n_genes, min(value) AS lowest,
  max(value) AS highest
FROM (SELECT l_linenumber, l_partkey,
    unnest(['quantity', 'price', 'discount', 'tax']) AS sample_id,
    unnest([l_quantity, l_extendedprice, CASE WHEN l_discount >= 0.015 THEN l_discount END, l_tax])
      AS value FROM lineitem) GROUP BY 1, 2""",
    "phenotype_bed_validation": """
SELECT 'chr' || l_linenumber AS chrom,
  CASE l_linenumber WHEN 7 THEN 'a TSS interval that is not one base wide'
    WHEN 6 THEN 'non-integer BED coordinates' END AS problem, count(*) AS n_rows
FROM lineitem GROUP BY 1, 2""",
    "gtf_coding_genes": """
SELECT 'ENSG' || lpad(CAST(p_partkey // 2 AS VARCHAR), 11, '0') AS gene_id, count(*) AS n_records
FROM part WHERE p_size % 10 <> 0 AND p_type <> 'ECONOMY' GROUP BY 1""",
    "carrier_definitions": _with(LINES, PAIRS) + "SELECT * FROM pairs",
    "carrier_definition_counts": _with(LINES, PAIRS) + """
SELECT count(*) AS any_lof, count(*) FILTER (is_hc) AS "HC", count(*) AS "HC_or_LC" FROM pairs""",
    "gene_min_collapse": _with(LINES) + """
SELECT gene_id, sample_id, min(l_extendedprice) FILTER (l_discount > 0.005) AS value
FROM lines GROUP BY 1, 2""",
    "sample_intersection": """
SELECT CAST(s_suppkey AS VARCHAR) AS sample_id FROM supplier
WHERE s_suppkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
  AND s_suppkey IN (SELECT o_custkey FROM orders)""",
    "sample_overlap_counts": """
SELECT count(*) FILTER (s IS NOT NULL AND c IS NOT NULL) AS shared_sample_count,
  count(*) FILTER (c IS NULL) AS left_only_sample_count,
  count(*) FILTER (s IS NULL) AS right_only_sample_count
FROM (SELECT s_suppkey AS s FROM supplier WHERE s_acctbal > 1000)
FULL JOIN (SELECT c_custkey AS c FROM customer WHERE c_acctbal > 0) ON s = c""",
    "flagged_observations": _with(LINES, OBS, PAIRS, FLAGGED) + """
SELECT * EXCLUDE (value), round(value, 6) AS value FROM flagged""",
    "standardized_expression": _with(LINES, OBS, _z("s_acctbal", "s_nationkey")) + """
SELECT gene_id, sample_id, round(z, 6) AS z FROM zs WHERE step = 0""",
    "residual_z_scores": _with(LINES, OBS, _z("s_acctbal", "s_nationkey")) + """
SELECT gene_id, sample_id, CAST(step AS INTEGER) AS pc_count, round(z, 6) AS z FROM zs""",
    "residual_exclusions": _with(EXCLUSIONS) + """
SELECT CAST(g AS VARCHAR) AS gene_id, CAST(pc_count AS INTEGER) AS pc_count, usable,
  CAST(CASE WHEN usable > 0 THEN r END AS INTEGER) AS rank,
  CASE WHEN reason IS NULL THEN round(sqrt(sse / usable), 6)
    WHEN reason = 'invalid_or_zero_residual_sd' THEN 0.0 END AS residual_sd, reason
FROM judged""",
    "sweep_exclusion_totals": _with(EXCLUSIONS) + """
SELECT CAST(pc_count AS INTEGER) AS pc_count,
  count(*) FILTER (reason IS NULL) AS eligible_gene_count,
  CAST(coalesce(sum(usable) FILTER (reason IS NULL), 0) AS BIGINT) AS total_observations,
""" + ", ".join(f"count(*) FILTER (reason = '{r}') AS {r}" for r in vocab.EXCLUSION_REASONS) + """
FROM judged GROUP BY 1""",
    "lof_pc_enrichment": _lof_pc("s_acctbal", "s_nationkey", {0: 0, 1: 1, 2: 2}),
    "lof_pc_with_covariate": _lof_pc("s_acctbal", "s_nationkey", {1: 0, 2: 1}),
    "lof_pc_intercept_only": _lof_pc("s_acctbal", "s_nationkey", {0: 0}),
    "fisher_two_sided": _with(SUPPLIER_TABLES, _fisher("tables")) + """
SELECT * EXCLUDE (fisher_p_value), round(fisher_p_value, 6) AS fisher_p_value FROM tested""",
    "table_rates_and_odds": _with(SUPPLIER_TABLES) + f"""
SELECT l_returnflag, l_suppkey, n11, n10, n01, n00, {_round(*Q.STAT_COLUMNS[:5])}
FROM (SELECT *, {_statistics('n11', '(n11 + n01)', 'n10', '(n10 + n00)')} FROM tables)""",
    "bh_fdr": _with(
        """shares AS (SELECT o_orderkey, o_totalprice / 500000.0::DOUBLE AS u FROM orders),
ps AS (SELECT o_orderkey, u * u * u * u AS p FROM shares)""", _bh("ps", "p", "q")) + """
SELECT o_orderkey, round(p, 6) AS p, round(q, 6) AS q FROM adjusted""",
    "shard_merge_global_fdr": _with(
        SUPPLIER_TABLES, _fisher("tables"),
        """short AS (SELECT * EXCLUDE (fisher_p_value), round(fisher_p_value, 6) AS fisher_p_value
  FROM tested)""", _bh("short", "fisher_p_value", "fisher_fdr_bh")) + """
SELECT * EXCLUDE (fisher_fdr_bh), round(fisher_fdr_bh, 6) AS fisher_fdr_bh FROM adjusted""",
    "median_log_odds": _with(SWEEP) + f"""
SELECT pc_count, carrier_definition, {_round('median_log_odds_ratio', 'median_odds_ratio')}
FROM points WHERE n_thresholds = 4""",
    "plateau_pc_count": _with(SWEEP) + """,
tops AS (SELECT carrier_definition, max(median_log_odds_ratio) AS top FROM points
  WHERE n_thresholds = 4 GROUP BY 1)
SELECT carrier_definition, round(top, 6) AS max_median_log_odds_ratio,
  round(top + ln(0.95::DOUBLE), 6) AS plateau_log_odds_ratio,
  min(pc_count) FILTER (median_log_odds_ratio >= top + ln(0.95::DOUBLE)) AS minimum_pc_count
FROM points JOIN tops USING (carrier_definition) WHERE n_thresholds = 4 GROUP BY ALL""",
    "sweep_percent_of_maximum": _with(SWEEP) + """,
best AS (
  SELECT carrier_definition, pc_count AS maximum_pc, median_odds_ratio AS top FROM points
  QUALIFY row_number() OVER (PARTITION BY carrier_definition
    ORDER BY median_odds_ratio DESC, pc_count) = 1)
SELECT carrier_definition, pc_count, n_thresholds, thresholds_present, maximum_pc,
  round(median_log_odds_ratio, 6) AS median_log_odds_ratio,
  round(median_odds_ratio, 6) AS median_odds_ratio, round(top, 6) AS maximum_median_odds_ratio,
  round(100 * median_odds_ratio / top, 6) AS percent_of_maximum
FROM points JOIN best USING (carrier_definition)""",
    "outlier_tails": "SELECT l_returnflag, " + ", ".join(
        f"count(*) FILTER ({test}) AS {tail}_{i}"
        for i, t in enumerate((0.5, 1.0, 2.0))
        for tail, test in (("absolute", f"abs(v) >= {t}"), ("positive", f"v >= {t}"),
                           ("negative", f"v <= -{t}"))) + """
FROM (SELECT l_returnflag, (l_extendedprice - 50000.0::DOUBLE) / 20000.0::DOUBLE AS v FROM lineitem)
GROUP BY 1""",
    "phenotype_totals": _with(FEATURES, FEATURE_OBS) + """
SELECT count(value) AS total_observations, count(*) FILTER (value IS NULL) AS missing_z_observations,
""" + ", ".join(f"count(*) FILTER (abs(value) >= {t}) AS o{i}" for i, t in enumerate(Q.Z_HIGH)) + """
FROM fobs""",
    "vcf_alt_alleles": _with(VARIANTS, GENOTYPES) + """
SELECT chrom, pos, ref, alt, alt_index, info_ac, genotype_ac,
  coalesce(info_ac, CASE WHEN any_called THEN genotype_ac END) AS ac, complete, any_called, carriers
FROM alleles""",
    "vcf_allele_counters": _with(VARIANTS, GENOTYPES) + _COUNTERS.format("alleles"),
    "ac_class_membership": _with(VARIANTS) + f"""
SELECT chrom, ac_class, count(*) AS n_alleles
FROM (SELECT chrom, unnest({_AC_LIST}) AS ac_class FROM variants) WHERE ac_class IS NOT NULL
GROUP BY 1, 2""",
    "consequence_severity": _with(VARIANTS, TRANSCRIPTS) + f"""
SELECT {TERMS}[list_min(positions)] AS consequence, loftee_state, count(*) AS n_rows,
  CAST(sum(len(terms)) AS BIGINT) AS n_terms, CAST(sum(n_unknown) AS BIGINT) AS n_unknown
FROM mafs GROUP BY 1, 2""",
    "transcript_collapse": _with(VARIANTS, TRANSCRIPTS, ANNOTATIONS) + "SELECT * FROM annotations",
    "minor_allele_frequency": _with(VARIANTS, TRANSCRIPTS) + """
SELECT gvs_max_af, status, raw_af, maf, coalesce(raw_af > 0.5, false) AS converted,
  count(*) AS n_rows FROM mafs GROUP BY ALL""",
    "frequency_consistency": _with(VARIANTS, TRANSCRIPTS, FREQUENCIES) + "SELECT * FROM frequencies",
    "unknown_consequence_terms": _with(VARIANTS, TRANSCRIPTS) + """
SELECT chrom, second_term AS term, count(*) AS row_count FROM mafs WHERE n_unknown = 1
GROUP BY 1, 2""",
    "vat_counters": _with(VARIANTS, TRANSCRIPTS, FREQUENCIES, ANNOTATIONS) + f""",
row_part AS (
  SELECT chrom, count(*) AS vat_rows, max(raw_af) AS observed_raw_gvs_max_af,
    {_ROW_COUNTERS},
    count(*) - count(DISTINCT (pos, ref, alt, gene_id, first_term || separator || second_term,
      gvs_max_af, lof)) AS duplicate_vat_rows
  FROM mafs GROUP BY 1),
frequency_part AS (
  SELECT chrom, count(*) AS unique_vat_alleles,
    {', '.join(f"count(*) FILTER (status = '{s}') AS {s}_frequency_alleles"
               for s in ('missing', 'non_numeric', 'out_of_range', 'inconsistent'))},
    count(*) FILTER (status = 'valid' AND maf > {Q.MAX_MAF}) AS above_maf_threshold_alleles
  FROM frequencies GROUP BY 1),
pair_part AS (
  SELECT chrom, count(*) AS unique_vat_allele_gene_pairs,
    count(*) FILTER (consequence IN ({_quoted(S.CONSEQUENCES)})) AS configured_consequence_annotations
  FROM annotations GROUP BY 1)
SELECT * FROM row_part JOIN frequency_part USING (chrom) JOIN pair_part USING (chrom)""",
    "tss_windows": _with(FEATURES, OPEN_WINDOWS) + """
SELECT chrom, lo AS start, hi AS "end" FROM merged""",
    "query_chunks": _with(FEATURES, CLOSED_WINDOWS) + f"""
SELECT chrom, s AS start, least(hi, s + {Q.CHUNK} - 1) AS "end"
FROM (SELECT chrom, hi, unnest(generate_series(lo, hi, {Q.CHUNK})) AS s FROM merged)""",
    "variants_in_query_windows": _with(FEATURES, VARIANTS, CLOSED_WINDOWS) + f"""
SELECT o_orderkey, v.chrom, pos, lo AS window_start, (pos - lo) // {Q.CHUNK} AS piece
FROM variants v JOIN merged m ON v.chrom = m.chrom AND pos BETWEEN lo AND hi""",
    "records_in_query_chunks": _with(FEATURES, VARIANTS, REACH_CHUNKS) + """
SELECT o_orderkey, chrom, window_start, piece, starts_here FROM met""",
    "block_gzip_lines": """
SELECT o_orderpriority, count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars, sum(o_orderkey)::BIGINT AS keys,
  sum(cents)::BIGINT AS cents, count(DISTINCT o_orderstatus) AS n_states
FROM (SELECT *, concat_ws(chr(9), o_orderkey, o_orderstatus, o_orderpriority, cents) AS line
  FROM (SELECT *, CAST(CAST(o_totalprice * 100 AS DECIMAL(18, 0)) AS BIGINT) AS cents FROM orders))
GROUP BY 1""",
    "region_allele_counters": _with(FEATURES, VARIANTS, GENOTYPES, REACH_CHUNKS, CHUNK_ALLELES)
    + _COUNTERS.format("chunk_alleles"),
    "region_record_starts": _with(FEATURES, VARIANTS, GENOTYPES, REACH_CHUNKS, CHUNK_ALLELES) + """
SELECT chrom, alt_index, count(*) FILTER (starts_here) AS n_starting,
  count(*) FILTER (NOT starts_here) AS n_reaching, min(pos) AS first_pos, max(end_pos) AS last_pos,
  sum(ac)::BIGINT AS ac_total
FROM chunk_alleles GROUP BY 1, 2""",
    "genotype_carrier_minima": _with(
        VARIANTS, TRANSCRIPTS, FREQUENCIES, ANNOTATIONS, FEATURES, GENOTYPES, REACH_CHUNKS, CALLED,
        RARE_PAIRS.replace("variants v", "called v").replace(f"<= {Q.DISTANCE}", f"<= {FQ.REACH}"),
        CALLED_MINIMA) + "SELECT * FROM minima",
    "variant_feature_range_join": _with(FEATURES, VARIANTS) + f"""
SELECT v.chrom, pos, tss, feature_id, abs(pos - tss) AS distance
FROM variants v JOIN features f ON v.chrom = f.chrom AND abs(pos - tss) <= {Q.DISTANCE}""",
    "gene_matched_pairs": _with(*RARE_CHAIN) + f"""
SELECT chrom, count(*) AS variant_feature_pairs,
  count(*) FILTER (distance = {Q.DISTANCE}) AS boundary_variant_feature_pairs,
  count(*) FILTER (matched) AS gene_matched_variant_feature_pairs,
  count(*) FILTER (NOT matched) AS gene_unmatched_variant_feature_pairs
FROM rare_pairs GROUP BY 1""",
    "carrier_minimum_distance": _with(*RARE_CHAIN, MINIMA) + "SELECT * FROM minima",
    "gather_minimum_distance": _with(*RARE_CHAIN, MINIMA) + "SELECT * FROM minima",
    "carrier_key_counts": _with(*RARE_CHAIN, MINIMA) + """
SELECT annotation_family, count(*) AS n_keys, count(DISTINCT feature_id) AS n_features
FROM minima GROUP BY 1""",
    "annotation_enrichment": _with(
        *RARE_CHAIN, MINIMA, FEATURE_OBS,
        f"""totals AS (
  SELECT t, count(value) AS total_observations,
    count(*) FILTER (abs(value) >= t) AS outlier_observations
  FROM (SELECT value, unnest({_list(Q.Z_HIGH)}) AS t FROM fobs) GROUP BY 1),
ac_dim AS (SELECT unnest({_list([n for n, _ in _AC_LABELS])}) AS ac_class),
class_dim AS (
  SELECT 'baseline' AS annotation_family, 'all_rare_variants' AS annotation_class
  UNION ALL SELECT 'consequence', unnest({_list(S.CONSEQUENCES)})
  UNION ALL SELECT 'loftee', unnest(['HC', 'LC'])),
distance_dim AS (SELECT unnest({_list(Q.DISTANCES)}) AS d),
cells_grid AS (SELECT * FROM totals CROSS JOIN ac_dim CROSS JOIN class_dim CROSS JOIN distance_dim),
hits AS (
  SELECT annotation_family, annotation_class, ac_class, value, minimum_distance_bp AS near
  FROM minima m JOIN fobs o ON m.feature_id = o.feature_id AND m.sample_id = o.sample_id
  WHERE value IS NOT NULL),
counted AS (
  SELECT t AS z_threshold, 'absolute' AS tail, annotation_family, annotation_class, ac_class,
    CASE WHEN ac_class LIKE 'AC<%' THEN 'cumulative' ELSE 'exact' END AS ac_kind,
    CAST(regexp_extract(ac_class, '[0-9]+') AS BIGINT) AS ac_value,
    CAST(d AS BIGINT) AS distance_bp, total_observations, outlier_observations,
    count(*) FILTER (near <= d AND abs(value) >= t) AS n11,
    count(*) FILTER (near <= d AND abs(value) < t) AS n01
  FROM cells_grid LEFT JOIN hits USING (annotation_family, annotation_class, ac_class)
  GROUP BY ALL),
filled AS (
  SELECT *, outlier_observations - n11 AS n10,
    total_observations - outlier_observations AS nonoutlier_observations,
    total_observations - outlier_observations - n01 AS n00 FROM counted)""",
        _fisher("filled"), _bh("tested", "fisher_p_value", "fisher_fdr_bh"),
        f"""final AS (SELECT *,
    {_statistics('n11', 'outlier_observations', 'n01', 'nonoutlier_observations')}
  FROM adjusted)""",
    ) + f"""SELECT * EXCLUDE ({', '.join(Q.STAT_COLUMNS)}), CAST(z_threshold AS DOUBLE) AS z_threshold,
  {_round(*Q.STAT_COLUMNS)} FROM final""".replace(
        "EXCLUDE (", "EXCLUDE (z_threshold, "),
}

# ---------------------------------------------------------------- from files

_ENSG = "'ENSG' || lpad(regexp_extract(gene_id, '[0-9]+'), 11, '0')"
SQL |= {
    "sample_matrix_files": """
WITH s AS (SELECT *, s_suppkey AS k FROM supplier WHERE s_acctbal > 0)
SELECT name, count(*) AS n_samples, round(sum(value), 2) AS total, min(value) AS lowest, max(value) AS highest
FROM (SELECT unnest(['PC1', 'PC2', 'PC3', 'age', 'bal']) AS name,
  unnest([s_acctbal, s_nationkey, k, s_nationkey, s_acctbal]::DOUBLE[]) AS value FROM s) GROUP BY 1""",
    "lof_carrier_file": _with(LINES, PAIRS) + f"SELECT * REPLACE ({_ENSG} AS gene_id) FROM pairs",
    "coding_gene_file": """
WITH g AS (
  SELECT 'ENSG' || lpad(CAST(p_partkey // 2 AS VARCHAR), 11, '0') AS gene_id, p_size % 10 <> 0 AS gene,
    p_type <> 'ECONOMY' AS coding FROM part)
SELECT count(DISTINCT gene_id) FILTER (gene AND coding) AS n_genes,
  min(gene_id) FILTER (gene AND coding) AS first_gene, max(gene_id) FILTER (gene AND coding) AS last_gene,
  count(DISTINCT gene_id) FILTER (gene AND coding) AS listed,
  count(*) FILTER (gene AND coding) - count(DISTINCT gene_id) FILTER (gene AND coding)
    AS duplicate_normalized_gene_records,
  count(*) FILTER (gene) AS nine_field_gene_records,
  count(*) FILTER (gene AND coding) AS protein_coding_gene_records, count(*) AS total_lines FROM g""",
    "feature_file": _with(FEATURES) + "SELECT chrom, tss, feature_id FROM features WHERE tss >= 1",
    "sample_file": "SELECT CAST(s_suppkey AS VARCHAR) AS sample_id FROM supplier",
    "gathered_minima_files": """
SELECT CAST(l_suppkey AS VARCHAR) AS sample_id, CAST(l_partkey AS VARCHAR) AS feature_id,
  'AC=' || l_linenumber AS ac_class, 'baseline' AS annotation_family,
  'all_rare_variants' AS annotation_class, CAST(min(l_quantity) AS BIGINT) AS minimum_distance_bp
FROM lineitem GROUP BY ALL""",
    "selection_from_file": SQL["plateau_pc_count"],
    "phenotype_bed_file": _with(LINES, OBS) + """
SELECT CAST(s_suppkey AS VARCHAR) AS sample_id, count(*) AS n_cells, count(value) AS n_values,
  round(sum(value), 3) AS total
FROM supplier CROSS JOIN (SELECT DISTINCT gene_id FROM obs) g
LEFT JOIN obs o ON o.gene_id = g.gene_id AND o.sample_id = CAST(s_suppkey AS VARCHAR) GROUP BY 1""",
    "lof_pc_files": SQL["lof_pc_enrichment"],
    "lof_pc_merged_files": SQL["lof_pc_enrichment"],
    "gene_pc_qc_files": _with(LINES, OBS) + f"""
SELECT pc_count, CASE WHEN n <= pc_count + 2 THEN 'excluded' ELSE 'included' END AS status,
  CASE WHEN n = 0 THEN 'other' WHEN n <= pc_count + 2 THEN 'insufficient_dof' ELSE '' END
    AS exclusion_reason,
  CASE WHEN n = 0 THEN 'NA' ELSE CAST(least(n, pc_count + 1) AS VARCHAR) END AS rank,
  count(*) AS n_genes, CAST(sum(n) AS BIGINT) AS usable_samples
FROM (SELECT gene_id, count(value) AS n, unnest({list(S.PC_COUNTS)}) AS pc_count FROM obs GROUP BY 1)
GROUP BY ALL""",
    "lof_pc_documents": _with(LINES, OBS, PAIRS, FLAGGED, f"""genes AS (
  SELECT gene_id, count(value) AS n, count(value) FILTER (is_any_lof) AS any_lof,
    count(value) FILTER (is_hc) AS hc, count(value) FILTER (is_hc_or_lc) AS hc_or_lc
  FROM flagged GROUP BY 1),
steps AS (
  SELECT *, n > pc_count + 2 AS kept FROM (SELECT *, unnest({list(S.PC_COUNTS)}) AS pc_count FROM genes)),
per_pc AS (
  SELECT pc_count, count(*) FILTER (kept) AS "eligible_gene_count",
    coalesce(sum(n) FILTER (kept), 0)::BIGINT AS "total_observations",
    coalesce(sum(any_lof) FILTER (kept), 0)::BIGINT AS "carrier_observations.any_lof",
    coalesce(sum(hc_or_lc) FILTER (kept), 0)::BIGINT AS "carrier_observations.HC_or_LC",
    coalesce(sum(hc) FILTER (kept), 0)::BIGINT AS "carrier_observations.HC",
    count(*) FILTER (n > 0 AND NOT kept) AS "exclusion_counts.insufficient_dof",
    0::BIGINT AS "exclusion_counts.rank_deficiency",
    0::BIGINT AS "exclusion_counts.invalid_or_zero_residual_sd",
    count(*) FILTER (n = 0) AS "exclusion_counts.other"
  FROM steps GROUP BY 1),
sizes AS (
  SELECT (SELECT count(*) FROM genes) AS genes, (SELECT count(*) FROM supplier) AS samples,
    (SELECT count(DISTINCT p_brand) FROM part) AS coding, (SELECT count(*) FROM lines) AS carrier_rows,
    (SELECT count(*) FROM lines WHERE l_returnflag = 'R' AND l_quantity >= 49) AS truthy,
    (SELECT count(*) FROM pairs) AS any_lof, (SELECT count(*) FROM pairs WHERE is_hc) AS hc,
    (SELECT count(*) FROM pairs WHERE is_hc_or_lc) AS hc_or_lc, 0::BIGINT AS none)""") + """
SELECT counter, value FROM (UNPIVOT (
  SELECT genes AS "bed_feature_count", genes AS "bed_gene_count", samples AS "bed_sample_count",
    none AS "duplicate_feature_count", none AS "additional_covariate_count",
    none AS "additional_covariate_sample_count", samples AS "pc_sample_count",
    genes AS "protein_coding_bed_feature_count", genes AS "protein_coding_bed_gene_count",
    none AS "protein_coding_duplicate_feature_count", coding AS "protein_coding_gene_count",
    samples AS "shared_bed_pc_sample_count", samples AS "shared_bed_pc_covariate_sample_count",
    any_lof AS "pre_join_carrier_pair_counts.any_lof", hc AS "pre_join_carrier_pair_counts.HC",
    hc_or_lc AS "pre_join_carrier_pair_counts.HC_or_LC",
    carrier_rows AS "lof_carrier_table.input_row_count", truthy AS "lof_carrier_table.truthy_row_count",
    any_lof AS "lof_carrier_table.unique_any_lof_pair_count",
    hc_or_lc AS "lof_carrier_table.unique_hc_or_lc_pair_count",
    hc AS "lof_carrier_table.unique_hc_pair_count"
  FROM sizes) ON COLUMNS(*) INTO NAME counter VALUE value)
UNION ALL
SELECT 'per_pc.' || pc_count || '.' || counter, value
FROM (UNPIVOT per_pc ON COLUMNS(* EXCLUDE pc_count) INTO NAME counter VALUE value)""",
    "prepared_phenotypes": _with(FEATURES, FEATURE_OBS, f"""chosen AS (
  SELECT * FROM features WHERE chrom IN {FQ.PREPARED}),
seen AS (
  SELECT value FROM fobs JOIN chosen USING (feature_id)
  WHERE CAST(sample_id AS BIGINT) % 3 <> 0 AND value IS NOT NULL),
sizes AS (
  SELECT (SELECT count(*) FROM part) AS parts, (SELECT count(*) FROM chosen) AS chosen,
    (SELECT count(*) FROM supplier) AS suppliers, (SELECT count(*) FROM nation) AS nations,
    (SELECT count(*) FROM supplier WHERE s_suppkey % 3 <> 0) AS shared,
    (SELECT count(*) FROM seen) AS present)""") + """
SELECT counter, value FROM (UNPIVOT (
  SELECT suppliers - shared AS "bed_only_sample_count", suppliers AS "bed_sample_count",
    chosen AS "feature_count", chosen AS "selected_feature_count", chosen AS "listed_features",
    parts AS "input_feature_count", parts - chosen AS "unselected_feature_count",
    chosen * shared - present AS "missing_z_observations", present AS "non_missing_observations",
    shared AS "shared_sample_count", shared AS "listed_samples", nations AS "vcf_only_sample_count",
    shared + nations AS "vcf_sample_count", """ + ", ".join(
    f"(SELECT count(*) FROM seen WHERE abs(value) >= {t}) AS \"outlier_observations.{t}\"" for t in Q.Z_HIGH) + """
  FROM sizes) ON COLUMNS(*) INTO NAME counter VALUE value)""",
    "calculate_files": SQL["annotation_enrichment"],
    "vcf_file": _with(VARIANTS) + f"""
SELECT chrom, count(*) AS n_records, CAST(sum(pos) AS BIGINT) AS positions,
  CAST(sum(pos + o_orderkey % {S.LONG_RECORD_BP}
    + CASE WHEN o_orderkey % 500 = 3 THEN {S.FAR_RECORD_BP} ELSE 0 END) AS BIGINT) AS ends,
  0 AS gt_index, 7 AS n_samples, 5 AS n_contigs FROM variants GROUP BY 1""",
    "annotation_file_counters": _with(VARIANTS, TRANSCRIPTS, FREQUENCIES, FEATURES, REACH_CHUNKS, """near AS (
  SELECT m.* FROM mafs m JOIN merged w ON m.chrom = w.chrom AND m.pos BETWEEN w.lo AND w.hi)""") + f"""
SELECT chrom, count(*) AS vat_rows, max(raw_af) AS observed_raw_gvs_max_af,
  {_ROW_COUNTERS}, source
FROM (SELECT *, unnest(['text', 'layout']) AS source FROM near) GROUP BY chrom, source""",
}
