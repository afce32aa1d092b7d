"""Residual z-scores of every gene over a sweep of nested linear models.

The sample x gene matrix is cut into bounded tiles (gene block x sample block),
and least squares runs as a blocked QR over those tiles:

1. *factor*: each tile factorises its rows of the design once per missingness
   pattern and reduces every gene to the short vector ``Q'y`` plus a remainder;
2. *merge*: factors of sample blocks are stacked and factorised again, a fixed
   number of blocks at a time, until one factor per gene block is left.  Models
   are nested, so that one factor yields rank, residual SD and exclusion reason
   for every PC count of the sweep;
3. *apply*: tiles are visited a second time to turn values into z-scores, which
   are counted on the spot.  No z-score leaves its task.

No task ever holds more of a gene than one sample block, a whole sample or the
whole design matrix, and nothing is broadcast: design rows travel to the tiles that
use them.  Tiles hold the cells that exist, so a sparse matrix costs what it holds:
genes of few samples share one sample block, and only design rows that some cell of
a tile uses go there.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tailfold.operators.collapse import FLAGS
from tailfold.operators.samples import block_samples

SAMPLE_BLOCK = 4096
GENE_BLOCK = 512
FAN_IN = 32
SMALLEST_GENE_BLOCK = 16
MERGE_BUDGET_BYTES = 512 << 20
ZERO_SD_FACTOR = 16.0


@dataclass(frozen=True)
class Sweep:
    """Shape of the models: fixed covariates, PC counts and tile counts."""

    fixed: int
    pc_counts: tuple[int, ...]
    sample_blocks: int
    gene_blocks: int
    fan_in: int = FAN_IN
    # runs that the samples of a block are numbered in
    runs: int = 1
    # fewer cells than design rows over all tiles: send rows by the cells
    sparse: bool = False

    @property
    def width(self) -> int:
        return 1 + self.fixed + max(self.pc_counts)

    def columns(self, pc_count: int) -> int:
        return 1 + self.fixed + pc_count


def plan_sweep(flagged: DataFrame, design: DataFrame, fixed: int, pc_counts,
               sample_block: int = SAMPLE_BLOCK, fan_in: int = FAN_IN) -> Sweep:
    """Choose tile counts so that every task of the sweep stays bounded.

    With missing values each gene may need a factor of its own, so fewer genes
    share a block as the design gets wider.  Small matrices are cut finer than that,
    to give every core a tile.
    """
    facts = flagged.groupBy("gene_id").agg(
        F.count("value").alias("present"), F.count(F.lit(1)).alias("cells")
    ).agg(
        F.count("gene_id").alias("genes"), F.coalesce(F.sum("present"), F.lit(0)).alias("present"),
        F.coalesce(F.sum("cells"), F.lit(0)).alias("cells"), F.coalesce(F.max("cells"), F.lit(0)).alias("most"),
    ).first()
    samples = design.count()
    # no gene has more cells in a block than a block has samples, up to the luck of the hash
    blocks = max(1, math.ceil(min(samples, facts.most) / sample_block))
    width = 1 + fixed + max(pc_counts)
    genes = GENE_BLOCK
    if facts.present < facts.genes * samples:
        per_gene = 8 * min(width, sample_block) * width * min(blocks, fan_in)
        genes = max(SMALLEST_GENE_BLOCK, min(GENE_BLOCK, MERGE_BUDGET_BYTES // per_gene))
    cores = design.sparkSession.sparkContext.defaultParallelism
    wanted = math.ceil(cores / blocks)
    finest = max(1, facts.genes // SMALLEST_GENE_BLOCK)
    gene_blocks = max(math.ceil(facts.genes / genes), min(wanted, finest), 1)
    runs = max(1, math.ceil(samples / (blocks * sample_block)))
    return Sweep(fixed, tuple(pc_counts), blocks, gene_blocks, fan_in, runs,
                 facts.cells < gene_blocks * samples)


# ------------------------------------------------------------ Arrow helpers


def _flat(table: pa.Table, name: str):
    """Flattened values and row lengths of a list column."""
    lists = table.column(name).combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), lengths


def _cells(table: pa.Table, positions: np.ndarray, *names: str):
    """Cells by gene and design row: where each gene begins, rows, and the named lists.

    Of a cell that comes twice the last one counts.
    """
    at, lengths = _flat(table, "pos_list")
    gene = np.repeat(np.arange(table.num_rows), lengths)
    row = np.searchsorted(positions, at)
    order = np.lexsort((row, gene))
    gene, row = gene[order], row[order]
    last = np.ones(len(row), dtype=bool)
    last[:-1] = (gene[1:] != gene[:-1]) | (row[1:] != row[:-1])
    starts = np.searchsorted(gene[last], np.arange(table.num_rows + 1))
    return [starts, row[last], *[_flat(table, f"{name}_list")[0][order][last] for name in names]]


def _present(table: pa.Table, positions: np.ndarray, *names: str):
    """``_cells`` with a finite value, the values first among the lists."""
    starts, row, value, *others = _cells(table, positions, "value", *names)
    finite = np.isfinite(value.astype(float))
    before = np.append(0, np.cumsum(finite))
    return [before[starts], row[finite], value[finite].astype(float), *[o[finite] for o in others]]


def _design(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted sample positions of a tile and their design rows."""
    position = table.column("pos").to_numpy()
    order = np.argsort(position)
    out = np.ones((len(position), width))
    if width > 1:
        values, _ = _flat(table, "vec")
        out[:, 1:] = values.reshape(len(position), width - 1)[order]
    return position[order], out


def _records(table: pa.Table) -> list[dict]:
    """Rows as dictionaries, with the long ``vec`` lists as array slices."""
    values, lengths = _flat(table, "vec")
    vectors = np.split(values, np.cumsum(lengths)[:-1]) if table.num_rows else []
    rows = table.drop_columns(["vec"]).to_pylist()
    return [{**row, "vec": vec} for row, vec in zip(rows, vectors)]


def _digest(parts) -> str:
    return hashlib.blake2b("|".join(parts).encode(), digest_size=16).hexdigest()


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "bigint", pa.float64(): "double", pa.string(): "string"}

    def spell(t):
        return f"array<{names[t.value_type]}>" if pa.types.is_list(t) else names[t]

    return ", ".join(f"{f.name} {spell(f.type)}" for f in schema)


FACTOR = pa.schema([
    ("gb", pa.int32()), ("blk", pa.int32()), ("gene_id", pa.string()), ("pattern", pa.string()),
    ("n", pa.int64()), ("lo", pa.float64()), ("hi", pa.float64()),
    ("vec", pa.list_(pa.float64())), ("rest", pa.float64()),
])
FIT = pa.schema([
    ("gb", pa.int32()), ("gene_id", pa.string()), ("pattern", pa.string()), ("n", pa.int64()),
    ("ranks", pa.list_(pa.int32())), ("sds", pa.list_(pa.float64())),
    ("reasons", pa.list_(pa.string())), ("vec", pa.list_(pa.float64())),
])


# ------------------------------------------------------------------ kernels


def _factor_tile(sweep: Sweep):
    def kernel(key, cells, design):
        if not cells.num_rows or not design.num_rows:
            return _table([], FACTOR)
        gb, sb = (int(k.as_py()) for k in key)
        positions, x = _design(design, sweep.width)
        starts, row, value = _present(cells, positions)
        genes = cells.column("gene_id").to_pylist()
        groups: dict[bytes, list[int]] = {}
        for j in range(len(genes)):
            groups.setdefault(row[starts[j]:starts[j + 1]].tobytes(), []).append(j)
        rows = []
        for members in groups.values():
            used = row[starts[members[0]]:starts[members[0] + 1]]
            n = len(used)
            base = {"gb": gb, "blk": sb, "n": n}
            if n == 0:
                rows += [{**base, "gene_id": genes[j], "vec": [], "rest": 0.0} for j in members]
                continue
            pattern = _digest([str(sb), positions[used].tobytes().hex()])
            q, r = np.linalg.qr(x[used])
            block = np.column_stack([value[starts[j]:starts[j + 1]] for j in members])
            scores = q.T @ block
            rest = np.linalg.norm(block - q @ scores, axis=0)
            lo, hi = block.min(axis=0), block.max(axis=0)
            rows.append({**base, "pattern": pattern, "vec": r.ravel()})
            rows += [
                {**base, "gene_id": genes[j], "pattern": pattern, "vec": scores[:, i],
                 "rest": rest[i], "lo": lo[i], "hi": hi[i]}
                for i, j in enumerate(members)
            ]
        return _table(rows, FACTOR)

    return kernel


def _stacked(table: pa.Table, width: int):
    """Merge the blocks of one group: yields (pattern, R, n, genes, scores, rest, lo, hi).

    Genes with the same patterns in the same blocks share one factorisation.
    """
    factors, genes = {}, {}
    for row in _records(table):
        if row["gene_id"] is None:
            factors[row["pattern"]] = row["vec"].reshape(-1, width)
        else:
            parts = genes.setdefault(row["gene_id"], [])
            if row["n"]:
                parts.append(row)
    shared: dict[tuple, list] = {}
    for gene, parts in genes.items():
        parts.sort(key=lambda p: (p["blk"], p["pattern"]))
        shared.setdefault(tuple(p["pattern"] for p in parts), []).append((gene, parts))
    for patterns, members in shared.items():
        names = [gene for gene, _ in members]
        if not patterns:
            yield None, None, 0, names, None, None, None, None
            continue
        q, r = np.linalg.qr(np.vstack([factors[p] for p in patterns]))
        before = np.column_stack([np.concatenate([p["vec"] for p in ps]) for _, ps in members])
        scores = q.T @ before
        rests = np.array([[p["rest"] for p in ps] for _, ps in members]).T
        lost = np.linalg.norm(before - q @ scores, axis=0)
        rest = np.sqrt((rests**2).sum(axis=0) + lost**2)
        lo = np.array([min(p["lo"] for p in ps) for _, ps in members])
        hi = np.array([max(p["hi"] for p in ps) for _, ps in members])
        n = sum(p["n"] for p in members[0][1])
        yield _digest(patterns), r, n, names, scores, rest, lo, hi


def _merge_blocks(sweep: Sweep):
    def kernel(key, table):
        gb, blk = (int(k.as_py()) for k in key)
        rows = []
        for pattern, r, n, names, scores, rest, lo, hi in _stacked(table, sweep.width):
            base = {"gb": gb, "blk": blk, "pattern": pattern, "n": n}
            if not n:
                rows += [{**base, "gene_id": g, "vec": [], "rest": 0.0} for g in names]
                continue
            rows.append({**base, "vec": r.ravel()})
            rows += [
                {**base, "gene_id": g, "vec": scores[:, i], "rest": rest[i],
                 "lo": lo[i], "hi": hi[i]}
                for i, g in enumerate(names)
            ]
        return _table(rows, FACTOR)

    return kernel


def _rank(r: np.ndarray, n: int, columns: int) -> int | None:
    """Numerical rank of the first ``columns`` design columns (default tolerance)."""
    try:
        singular = np.linalg.svd(r[:, :columns], compute_uv=False)
    except np.linalg.LinAlgError:
        return None
    cut = singular.max() * max(n, columns) * np.finfo(float).eps
    return int((singular > cut).sum())


def _ranks(r: np.ndarray, n: int, sweep: Sweep) -> list[int | None]:
    """Ranks of all nested models; a full-rank largest model settles the others."""
    widest = sweep.columns(max(sweep.pc_counts))
    if _rank(r, n, widest) == widest:
        return [sweep.columns(k) for k in sweep.pc_counts]
    return [_rank(r, n, sweep.columns(k)) for k in sweep.pc_counts]


def _fit_block(sweep: Sweep):
    steps = range(len(sweep.pc_counts))

    def kernel(key, table):
        gb = int(key[0].as_py())
        rows = []
        for pattern, r, n, names, scores, rest, lo, hi in _stacked(table, sweep.width):
            base = {"gb": gb, "pattern": pattern, "n": n}
            if not n:
                rows += [
                    {**base, "gene_id": g, "ranks": [None for _ in steps],
                     "sds": [None for _ in steps], "reasons": ["other" for _ in steps], "vec": []}
                    for g in names
                ]
                continue
            ranks = _ranks(r, n, sweep)
            shared_reasons = [_design_problem(n, ranks[s], sweep.columns(sweep.pc_counts[s]))
                              for s in steps]
            zero = np.finfo(float).eps * ZERO_SD_FACTOR * np.maximum(
                1.0, np.maximum(np.abs(lo), np.abs(hi)))
            sds = np.full((len(sweep.pc_counts), len(names)), np.nan)
            for s in steps:
                left = scores[sweep.columns(sweep.pc_counts[s]):]
                sds[s] = np.sqrt(((left**2).sum(axis=0) + rest**2) / n)
            flat = ~np.isfinite(sds) | (sds <= zero) | (lo == hi)
            rows.append({**base, "vec": r.ravel()})
            for i, gene in enumerate(names):
                reasons = [
                    reason or ("invalid_or_zero_residual_sd" if flat[s, i] else None)
                    for s, reason in enumerate(shared_reasons)
                ]
                known = [None if shared_reasons[s] else float(sds[s, i]) for s in steps]
                rows.append({**base, "gene_id": gene, "ranks": ranks, "sds": known,
                             "reasons": reasons, "vec": scores[:, i]})
        return _table(rows, FIT)

    return kernel


def _design_problem(n: int, rank: int | None, columns: int) -> str | None:
    if rank is None:
        return "other"
    if n <= rank + 1:
        return "insufficient_dof"
    return "rank_deficiency" if rank < columns else None


def _residuals(sweep: Sweep, cells: pa.Table, side: pa.Table, *names: str):
    """Yield (step, gene index array, residual matrix, sd vector, named matrices) of genes that
    share their samples; absent cells are not in the matrices."""
    rows = np.array(side.column("kind").to_pylist())
    positions, x = _design(side.filter(pa.array(rows == "design")), sweep.width)
    starts, row, *lists = _present(cells, positions, *names)
    where = {g: j for j, g in enumerate(cells.column("gene_id").to_pylist())}
    factors = {
        row["pattern"]: row["vec"].reshape(-1, sweep.width)
        for row in _records(side.filter(pa.array(rows == "factor")))
    }
    fits: dict[str, list[dict]] = {}
    for fit in _records(side.filter(pa.array(rows == "fit"))):
        if fit["gene_id"] in where and fit["pattern"] is not None:
            fits.setdefault(fit["pattern"], []).append(fit)
    for pattern, members in fits.items():
        good = [s for s in range(len(sweep.pc_counts))
                if any(m["reasons"][s] is None for m in members)]
        at = np.array([where[m["gene_id"]] for m in members])
        used = row[starts[at[0]]:starts[at[0] + 1]]
        if not good or not len(used):
            continue
        y, *others = (np.column_stack([v[starts[j]:starts[j + 1]] for j in at]) for v in lists)
        top = sweep.columns(sweep.pc_counts[good[-1]])
        basis = np.linalg.solve(factors[pattern][:top, :top].T, x[used, :top].T).T
        scores = np.column_stack([m["vec"][:top] for m in members])
        fitted, done = np.zeros(y.shape), 0
        for s in good:
            upto = sweep.columns(sweep.pc_counts[s])
            fitted += basis[:, done:upto] @ scores[done:upto]
            done = upto
            keep = np.array([m["reasons"][s] is None for m in members])
            sd = np.array([m["sds"][s] for m in members if m["reasons"][s] is None])
            yield s, at[keep], y[:, keep] - fitted[:, keep], sd, [o[:, keep] for o in others]


def _count_tile(sweep: Sweep, thresholds: tuple[float, ...], schema: pa.Schema):
    def kernel(key, cells, side):
        if not cells.num_rows or not side.num_rows:
            return _table([], schema)
        names = cells.column("gene_id").to_pylist()
        rows = []
        for s, genes, residual, sd, flags in _residuals(sweep, cells, side, *FLAGS):
            z = residual / sd
            finite = np.isfinite(z)
            marks = [f.astype(bool) & finite for f in flags]
            columns = {"residual_sum": np.where(finite, residual, 0.0).sum(axis=0)}
            for d, mark in enumerate(marks):
                columns[f"c{d}"] = mark.sum(axis=0)
            for t, threshold in enumerate(thresholds):
                low = z <= threshold
                columns[f"o{t}"] = low.sum(axis=0)
                for d, mark in enumerate(marks):
                    columns[f"x{t}_{d}"] = (low & mark).sum(axis=0)
            rows += [
                {"gene_id": names[j], "step": s, **{c: v[i].item() for c, v in columns.items()}}
                for i, j in enumerate(genes)
            ]
        return _table(rows, schema)

    return kernel


def _z_tile(sweep: Sweep, schema: pa.Schema):
    def kernel(key, cells, side):
        if not cells.num_rows or not side.num_rows:
            return _table([], schema)
        names = cells.column("gene_id").to_pylist()
        parts = []
        for s, genes, residual, sd, (labels,) in _residuals(sweep, cells, side, "sample_id"):
            i, j = np.nonzero(np.isfinite(residual))
            parts.append(pa.table({
                "gene_id": pa.array([names[g] for g in genes[j]], pa.string()),
                "sample_id": pa.array(labels[i, j], pa.string()),
                "pc_count": pa.array(np.full(len(i), sweep.pc_counts[s], dtype=np.int32)),
                "z": pa.array((residual / sd)[i, j]),
            }))
        return pa.concat_tables(parts) if parts else _table([], schema)

    return kernel


# ------------------------------------------------------------ Spark operators


def _tiles(flagged: DataFrame, blocks: DataFrame, sweep: Sweep, with_labels: bool) -> DataFrame:
    """One row per gene and sample block, holding at most one block of values.

    Repartitioning by tile first lets the packing run without another exchange,
    and the cached result keeps that partitioning for both passes.
    """
    keep = ["pos", "value", *FLAGS] + (["sample_id"] if with_labels else [])
    placed = (
        flagged.join(blocks.select("sample_id", "sb", "pos"), "sample_id")
        .withColumn("gb", F.pmod(F.xxhash64("gene_id"), F.lit(sweep.gene_blocks)).cast("int"))
        .repartition("gb", "sb")
    )
    packed = placed.groupBy("gb", "sb", "gene_id").agg(
        F.collect_list(F.struct(*keep)).alias("cells")
    )
    return packed.select(
        "gb", "sb", "gene_id", *[F.col("cells")[c].alias(f"{c}_list") for c in keep]
    ).persist(StorageLevel.MEMORY_AND_DISK)


def _spread(df: DataFrame, column: str, count: int) -> DataFrame:
    """Repeat every row once per block number of the other tile axis.

    The renaming gives fresh columns, so a tile can meet rows of its own lineage.
    """
    fresh = df.select(*[F.col(c).alias(c) for c in df.columns])
    return fresh.withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(count - 1))))


def _design_rows(tiles: DataFrame, blocks: DataFrame, sweep: Sweep) -> DataFrame:
    """Design rows ``(gb, sb, pos, vec)`` of every tile, no more of them than cells or so."""
    rows = blocks.select("sb", "pos", F.col("x").alias("vec"))
    if not sweep.sparse:
        return _spread(rows, "gb", sweep.gene_blocks)
    used = tiles.select(F.col("gb").alias("gb"), F.col("sb").alias("sb"), F.explode("pos_list").alias("pos"))
    return used.distinct().join(rows, ["sb", "pos"]).select("gb", "sb", "pos", "vec")


def fit_models(tiles: DataFrame, blocks: DataFrame, sweep: Sweep) -> DataFrame:
    """Per gene: usable samples, rank, residual SD and exclusion per PC count."""
    design = _design_rows(tiles, blocks, sweep)
    state = (
        tiles.select("gb", "sb", "gene_id", "pos_list", "value_list")
        .groupBy("gb", "sb")
        .cogroup(design.groupBy("gb", "sb"))
        .applyInArrow(_factor_tile(sweep), _ddl(FACTOR))
    )
    remaining = sweep.sample_blocks
    while remaining > sweep.fan_in:
        state = (
            state.withColumn("blk", F.floor(F.col("blk") / sweep.fan_in).cast("int"))
            .groupBy("gb", "blk")
            .applyInArrow(_merge_blocks(sweep), _ddl(FACTOR))
        )
        remaining = math.ceil(remaining / sweep.fan_in)
    return state.groupBy("gb").applyInArrow(_fit_block(sweep), _ddl(FIT))


def _side(tiles: DataFrame, blocks: DataFrame, fits: DataFrame, sweep: Sweep) -> DataFrame:
    design = _design_rows(tiles, blocks, sweep).withColumn("kind", F.lit("design"))
    kind = F.when(F.col("gene_id").isNull(), "factor").otherwise("fit")
    fitted = _spread(
        fits.select("gb", "gene_id", "pattern", "sds", "reasons", "vec", kind.alias("kind")),
        "sb", sweep.sample_blocks,
    )
    return design.unionByName(fitted, allowMissingColumns=True)


def _prepare(flagged, design, fixed, pc_counts, with_labels, sweep, cached):
    sweep = sweep or plan_sweep(flagged, design, fixed, pc_counts)
    blocks = block_samples(design, sweep.sample_blocks, sweep.runs).persist(StorageLevel.MEMORY_AND_DISK)
    tiles = _tiles(flagged, blocks, sweep, with_labels)
    fits = fit_models(tiles, blocks, sweep).persist(StorageLevel.MEMORY_AND_DISK)
    if cached is not None:
        cached += [blocks, tiles, fits]
    return sweep, blocks, tiles, fits


def gene_sweep(flagged: DataFrame, design: DataFrame, fixed: int, pc_counts,
               thresholds, sweep: Sweep | None = None, cached: list | None = None) -> DataFrame:
    """Per (gene, PC count): fit summary plus outlier and carrier counts.

    Tiles and fits are cached, because both passes read them; the frames are added to
    ``cached`` for the caller to unpersist once the result is written.
    """
    thresholds = tuple(thresholds)
    sweep, blocks, tiles, fits = _prepare(flagged, design, fixed, pc_counts, False, sweep, cached)
    counts = count_columns(len(thresholds))
    schema = pa.schema(
        [("gene_id", pa.string()), ("step", pa.int32()), ("residual_sum", pa.float64())]
        + [(c, pa.int64()) for c in counts]
    )
    partial = (
        tiles.groupBy("gb", "sb")
        .cogroup(_side(tiles, blocks, fits, sweep).groupBy("gb", "sb"))
        .applyInArrow(_count_tile(sweep, thresholds, schema), _ddl(schema))
    )
    totals = partial.groupBy("gene_id", "step").agg(
        *[F.sum(c).alias(c) for c in ["residual_sum", *counts]]
    )
    summaries = fits.where("gene_id IS NOT NULL").select(
        "gene_id", F.col("n").alias("usable"),
        F.posexplode(F.arrays_zip("ranks", "sds", "reasons")).alias("step", "fit"),
    )
    grid = F.array(*[F.lit(k) for k in sweep.pc_counts])
    joined = summaries.join(totals, ["gene_id", "step"], "left")
    reason = F.col("fit.reasons")
    has_sd = F.col("fit.sds").isNotNull()
    return joined.select(
        "gene_id", grid[F.col("step")].alias("pc_count"), "usable",
        F.col("fit.ranks").alias("rank"),
        F.when(has_sd, F.coalesce(F.col("residual_sum") / F.col("usable"), F.lit(0.0)))
        .alias("residual_mean"),
        F.col("fit.sds").alias("residual_sd"), reason.alias("reason"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
    )


def residual_z(observations: DataFrame, design: DataFrame, fixed: int, pc_counts,
               sweep: Sweep | None = None) -> DataFrame:
    """Long z-scores of the eligible genes, for a few PC counts."""
    flagged = observations.select(
        "gene_id", "sample_id", "value", *[F.lit(False).alias(f) for f in FLAGS])
    sweep, blocks, tiles, fits = _prepare(flagged, design, fixed, pc_counts, True, sweep, None)
    schema = pa.schema([("gene_id", pa.string()), ("sample_id", pa.string()),
                        ("pc_count", pa.int32()), ("z", pa.float64())])
    return (
        tiles.groupBy("gb", "sb")
        .cogroup(_side(tiles, blocks, fits, sweep).groupBy("gb", "sb"))
        .applyInArrow(_z_tile(sweep, schema), _ddl(schema))
    )


# ---------------------------------------------------- intercept-only models


def count_columns(thresholds: int) -> list[str]:
    """Names of the count columns: carriers, outliers, outlying carriers."""
    kinds = range(len(FLAGS))
    return (
        [f"c{d}" for d in kinds]
        + [f"o{t}" for t in range(thresholds)]
        + [f"x{t}_{d}" for t in range(thresholds) for d in kinds]
    )


def gene_moments(observations: DataFrame) -> DataFrame:
    """Intercept-only fit of each gene: one map-side combined aggregation."""
    value = F.col("value")
    moments = observations.groupBy("gene_id").agg(
        F.count(value).alias("usable"), F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("sd"), F.max(F.abs(value)).alias("peak"),
        F.min(value).alias("lo"), F.max(value).alias("hi"),
    )
    zero = F.lit(float(np.finfo(float).eps) * ZERO_SD_FACTOR) * F.greatest(F.lit(1.0), "peak")
    reason = (
        F.when(F.col("usable") == 0, "other")
        .when(F.col("usable") <= 2, "insufficient_dof")
        .when((F.col("sd") <= zero) | (F.col("lo") == F.col("hi")), "invalid_or_zero_residual_sd")
    )
    return moments.select("gene_id", "usable", "mean", "sd", reason.alias("reason"))


def standardize(observations: DataFrame) -> DataFrame:
    """Gene-wise z-scores without covariates or PCs, in the JVM only."""
    good = gene_moments(observations).where("reason IS NULL")
    z = (F.col("value") - F.col("mean")) / F.col("sd")
    scored = observations.where("value IS NOT NULL").join(good, "gene_id").withColumn("z", z)
    return scored.drop("usable", "mean", "sd", "reason")


def gene_baseline(flagged: DataFrame, thresholds) -> DataFrame:
    """``gene_sweep`` for the intercept-only model, without a Python worker."""
    moments = gene_moments(flagged)
    scored = flagged.join(moments, "gene_id", "left")
    z = F.when(F.col("reason").isNull(), (F.col("value") - F.col("mean")) / F.col("sd"))
    scored = scored.withColumn("z", z)
    seen = F.col("z").isNotNull()
    aggregates = [F.count_if(seen & F.col(f)).alias(f"c{d}") for d, f in enumerate(FLAGS)]
    for t, threshold in enumerate(thresholds):
        low = F.col("z") <= F.lit(threshold)
        aggregates.append(F.count_if(low).alias(f"o{t}"))
        aggregates += [F.count_if(low & F.col(f)).alias(f"x{t}_{d}") for d, f in enumerate(FLAGS)]
    known = ~F.coalesce(F.col("reason"), F.lit("")).isin("other", "insufficient_dof")
    return scored.groupBy("gene_id", "usable", "mean", "sd", "reason").agg(*aggregates).select(
        "gene_id", F.lit(0).alias("pc_count"), "usable",
        F.when(F.col("usable") > 0, F.lit(1)).alias("rank"),
        F.when(known, F.lit(0.0)).alias("residual_mean"),
        F.when(known, F.col("sd")).alias("residual_sd"),
        "reason", *count_columns(len(thresholds)),
    )
