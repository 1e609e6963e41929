"""Copy number from coverage: normalisation, reference choice, segments, clusters, gene calls.

Long tables: target, sample, cov. Medians, joins and windows are SQL; a local regression and a
segmentation, which need a series whole, run per sample (and chromosome) in applyInPandas, where
the size of a group is the number of a panel's targets.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixtab.functions import scalars as X
from helixtab.operators.scans import SUM, ranged, scan
from helixtab.operators.windows import adjust, gap_clusters, longest_run


def batch_adjusted(df: DataFrame, target: str = "target", batch: str = "batch", value: str = "lr", sexes: str | None = None, sex_targets: str | None = None, least: int = 3) -> DataFrame:
    """value less its batch's median per target, plus the median over all batches.

    sexes, sex_targets: on the targets so marked only samples of the same sex are compared, where
    a batch has at least so many of them.
    """
    group = [target]
    rows = df
    if sexes and sex_targets:
        rows = rows.withColumn("_sex", F.when(F.col(sex_targets), F.col(sexes)).otherwise(F.lit("any")))
        group = [target, "_sex"]
    own = rows.groupBy(*group, batch).agg(F.median(value).alias("_own"), F.count(value).alias("_n"))
    every = rows.groupBy(*group).agg(F.median(value).alias("_all"))
    moved = rows.join(own, [*group, batch]).join(every, group)
    shift = F.when(F.col("_n") >= least, F.col("_all") - F.col("_own")).otherwise(0.0) if len(group) > 1 else F.col("_all") - F.col("_own")
    return moved.withColumn(value, F.col(value) + shift).drop("_own", "_n", "_all", "_sex")


def log_ratios(tumors: DataFrame, normals: DataFrame, least_share: float = 0.1) -> DataFrame:
    """(target, tumor, normal, lr): log2 ratios; targets under a share of the median coverage of the normals are null."""
    low = normals.groupBy("normal").agg((F.median("n_cov") * least_share).alias("_low"))
    n = normals.join(low, "normal").withColumn("n_cov", F.when(F.col("n_cov") >= F.col("_low"), F.col("n_cov"))).drop("_low")
    ratio = F.when((F.col("cov") > 0) & (F.col("n_cov") > 0), F.log2(F.col("cov") / F.col("n_cov")))
    return tumors.join(n, "target").withColumn("lr", ratio)


def best_normals(ratios: DataFrame, most_missing: int = 100, order: str = "normal") -> DataFrame:
    """(tumor, normal, noise): for each tumor the normal of least summed squares, the first on ties. Sums that are equal to nine digits are ties: their last digits depend on the order of rows."""
    noise = ratios.groupBy("tumor", order).agg(F.when(F.count_if(F.col("lr").isNull()) <= most_missing, F.sum(F.col("lr") * F.col("lr"))).alias("noise"))
    by = Window.partitionBy("tumor").orderBy(F.round("noise", 9).asc_nulls_last(), order)
    return noise.withColumn("_nth", F.row_number().over(by)).where("_nth = 1 and noise is not null").drop("_nth")


def _local_fit(x: np.ndarray, n: np.ndarray, total: np.ndarray, span: float) -> np.ndarray:
    """Local quadratic regression with tricube weights (Cleveland), evaluated directly at each level x, of which there are n values with that total."""
    rows = int(n.sum())
    k = max(4, min(rows, int(np.floor(span * rows + 1e-5))))
    out = np.empty(len(x))
    for i, p in enumerate(x):
        d = np.abs(x - p)
        near = np.argsort(d, kind="stable")
        h = max(d[near[np.searchsorted(np.cumsum(n[near]), min(k, rows))]], 1e-12)
        w = np.clip(1 - (d / h) ** 3, 0, None) ** 3
        on = w > 0
        q = np.sqrt(w[on] * n[on])
        a = np.vander(x[on] - p, 3, increasing=True) * q[:, None]
        out[i] = np.linalg.lstsq(a, total[on] / n[on] * q, rcond=None)[0][0]
    return out


def _best_span(x: np.ndarray, n: np.ndarray, total: np.ndarray, low: float = 0.3, high: float = 0.75) -> float:
    """The span that leaves the least variance after a second fit, by golden section."""

    def left(span: float) -> float:
        again = _local_fit(x, n, total - n * _local_fit(x, n, total, span), span)
        return float(np.average((again - np.average(again, weights=n)) ** 2, weights=n))

    g = (5**0.5 - 1) / 2
    a, b = high - g * (high - low), low + g * (high - low)
    fa, fb = left(a), left(b)
    for _ in range(8):
        if fa < fb:
            high, b, fb = b, a, fa
            a = high - g * (high - low)
            fa = left(a)
        else:
            low, a, fa = a, b, fb
            b = low + g * (high - low)
            fb = left(b)
    return (low + high) / 2


def gc_normalised(df: DataFrame, sample: str = "sample", span: float | None = None, digits: int = 3) -> DataFrame:
    """(sample, target, norm) of (sample, target, chrom, tiling, gc, cov): coverage without its trend over gc, relative to the sample's median.

    On square roots, tiling and other targets apart; span is chosen on tiling targets off Y if not given. gc is rounded to digits, and targets
    are counted and summed per level before the regression, so what meets in a task is the levels of a sample (1001 for tiling and others each, with
    three digits), however many targets it has.
    """
    y = F.sqrt(F.col("cov").cast("double"))
    rows = df.select(sample, "target", F.coalesce("tiling", F.lit(False)).alias("_tiling"), F.round(F.col("gc").cast("double"), digits).alias("_level"), y.alias("_y"), (~F.coalesce(F.col("chrom").isin("Y", "chrY"), F.lit(False))).alias("_basis"))
    levels = rows.groupBy(sample, "_tiling", "_level").agg(F.count("*").alias("n"), F.sum("_y").alias("total"), F.count_if("_basis").alias("n_basis"), F.sum(F.when(F.col("_basis"), F.col("_y")).otherwise(0.0)).alias("total_basis"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_tiling", "_level"])
        tiling = pdf["_tiling"].to_numpy(bool)
        x, n, total = (pdf[c].to_numpy(float) for c in ("_level", "n", "total"))
        n_basis, total_basis = pdf["n_basis"].to_numpy(float) * tiling, pdf["total_basis"].to_numpy(float) * tiling
        if n[tiling].sum() < 10:  # all targets, levels of tiling and other ones together
            x_all, at = np.unique(x, return_inverse=True)
            x_basis, n_basis, total_basis = x_all, np.bincount(at, n), np.bincount(at, total)
        else:
            x_basis = x
        on = n_basis > 0
        use = span or (_best_span(x_basis[on], n_basis[on], total_basis[on]) if n_basis.sum() >= 10 else 0.5)
        out = np.full(len(x), np.nan)
        for part in (tiling, ~tiling):
            if n[part].sum() >= 5:
                out[part] = _local_fit(x[part], n[part], total[part], use)
        return pdf.assign(_fit=out)[[sample, "_tiling", "_level", "_fit"]]

    kind = df.schema[sample].dataType.simpleString()
    fits = levels.groupBy(sample).applyInPandas(fit, f"{sample} {kind}, _tiling boolean, _level double, _fit double")
    middle = rows.groupBy(sample).agg(F.coalesce(F.median(F.when(F.col("_y") > 0, F.col("_y"))), F.lit(1.0)).alias("_middle"))
    centre = rows.groupBy(sample, "_tiling").agg(F.median("_y").alias("_centre"))
    out = rows.join(fits, [sample, "_tiling", "_level"]).join(centre, [sample, "_tiling"]).join(middle, sample)
    flat = F.when(F.isnan("_fit"), F.col("_y")).otherwise(F.col("_y") - F.col("_fit") + F.col("_centre"))
    return out.select(sample, "target", F.pow(F.greatest(flat / F.col("_middle"), F.lit(0.0)), 2).alias("norm"))


def _arc(x: np.ndarray, least: int) -> tuple[float, int, int]:
    """(t, start, end) of the arc of greatest mean difference in a series, over all arcs of at least so many values inside and outside.

    Sums are cut into blocks; a pair of blocks is looked at in full only if the spread of its sums,
    over the least weight an arc between them has, can beat the best arc so far. So it is exact at any length.
    """
    n = len(x)
    s = np.concatenate(([0.0], np.cumsum(x - x.mean())))
    size = max(16, int((n + 1) ** 0.5))
    at = np.arange(0, n + 1, size)
    ends = np.append(at[1:], n + 1)
    low, high = np.minimum.reduceat(s, at), np.maximum.reduceat(s, at)
    p, q = np.triu_indices(len(at))
    k_low, k_high = np.maximum(least, at[q] - ends[p] + 1), np.minimum(n - least, ends[q] - 1 - at[p])
    on = k_low <= k_high
    p, q, k_low, k_high = p[on], q[on], k_low[on], k_high[on]
    weight = np.minimum(k_low * (n - k_low), k_high * (n - k_high)) / n
    bound = np.maximum(high[q] - low[p], high[p] - low[q]) / np.sqrt(weight)
    best = (0.0, 0, 0)
    for m in np.argsort(-bound, kind="stable"):
        if bound[m] <= best[0]:
            break
        i, j = np.arange(at[p[m]], ends[p[m]])[:, None], np.arange(at[q[m]], ends[q[m]])[None, :]
        k = j - i
        good = (k >= least) & (k <= n - least)
        t = np.where(good, np.abs(s[j] - s[i]) / np.sqrt(np.where(good, k * (n - k) / n, 1.0)), -1.0)
        b = int(np.argmax(t))
        if t.flat[b] > best[0]:
            best = float(t.flat[b]), int(i[b // t.shape[1], 0]), int(j[0, b % t.shape[1]])
    return best


def _split(x: np.ndarray, rng: np.random.Generator, alpha: float, permutations: int, least: int) -> tuple[int, int] | None:
    """The arc of greatest mean difference in a series, if permutations say so."""
    if len(x) < 2 * least:
        return None
    top, i, j = _arc(x, least)
    beyond, turn = 0, 0
    while (beyond + 1) / (permutations + 1) <= alpha:  # more can only add to it
        if turn == permutations:
            return (i, j)
        beyond += _arc(rng.permutation(x), least)[0] >= top
        turn += 1
    return None


def smoothed(x: np.ndarray, region: int = 10, far: float = 4.0, near: float = 2.0, trim: float = 0.025) -> np.ndarray:
    """x with single outliers drawn in: a value further than far sds beyond all values within region places is put near sds from their median.

    The sd is that of the differences of neighbours, the trimmed share of the largest left out.
    """
    if len(x) < 3:
        return x
    steps = np.sort(np.abs(np.diff(x)))
    steps = steps[: max(1, int(np.ceil(len(steps) * (1 - 2 * trim))))]
    sd = float(np.sqrt(np.mean(steps**2) / 2))
    padded = np.concatenate((np.full(region, np.nan), x, np.full(region, np.nan)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * region + 1)
    others = np.delete(windows, region, axis=1)
    high, low, middle = np.nanmax(others, axis=1), np.nanmin(others, axis=1), np.nanmedian(windows, axis=1)
    return np.where(x > high + far * sd, middle + near * sd, np.where(x < low - far * sd, middle - near * sd, x))


def circular_segments(x: np.ndarray, alpha: float = 0.01, permutations: int = 199, least: int = 2, undo_sd: float = 2.0, seed: int = 0) -> list[tuple[int, int, float]]:
    """(start, end, mean) of circular binary segmentation with splits undone whose means are near (in sds of the noise)."""
    if (permutations + 1) * alpha < 1:
        raise ValueError("too few permutations: none could show a split at this alpha")
    rng = np.random.default_rng(seed)
    todo, cuts = [(0, len(x))], {0, len(x)}
    while todo:
        a, b = todo.pop()
        found = _split(x[a:b], rng, alpha, permutations, least)
        if found:
            inner = sorted({a, a + found[0], a + found[1], b})
            if len(inner) > 2:
                cuts |= set(inner)
                todo += [(p, q) for p, q in zip(inner, inner[1:], strict=False) if q - p < b - a]
    edges = sorted(cuts)
    noise = float(np.median(np.abs(np.diff(x)))) / 0.9539 if len(x) > 2 else 0.0
    while len(edges) > 2:  # undo the smallest step while it is small
        m = [float(np.mean(x[p:q])) for p, q in zip(edges, edges[1:], strict=False)]
        steps = [abs(p - q) for p, q in zip(m, m[1:], strict=False)]
        k = int(np.argmin(steps))
        if steps[k] >= undo_sd * noise:
            break
        edges.pop(k + 1)
    return [(p, q, float(np.mean(x[p:q]))) for p, q in zip(edges, edges[1:], strict=False)]


def segments(df: DataFrame, group: list[str], position: str, value: str, smooth: bool = False, **options) -> DataFrame:
    """group, start, end, n, mean: segments of each series in order of position; missing values are left out; smooth: see smoothed()."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name in group)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=[value]).sort_values([position])
        at, x = pdf[position].to_numpy(float), pdf[value].to_numpy(float)
        x = smoothed(x) if smooth else x
        found = circular_segments(x, **options) if len(x) else []
        return pd.DataFrame([(*pdf[group].iloc[0], at[p], at[q - 1], q - p, m) for p, q, m in found], columns=[*group, "start", "end", "n", "mean"])

    return df.select(*group, position, value).groupBy(*group).applyInPandas(run, f"{kinds}, start double, end double, n long, mean double")


def significance(df: DataFrame, group: list[str], value: str, null_mean: str, null_sd: str, fold: float = 2, p: float = 0.05) -> DataFrame:
    """df with z, p, p_adjusted, fc and significant: far from the null cluster, and by much."""
    out = df.withColumn("z", (F.col(value) - F.col(null_mean)) / F.col(null_sd)).withColumn("p", X.normal_p_value(F.col("z"))).withColumn("fc", X.fold_change(F.col(value)))
    out = adjust(out, group, "p")
    return out.withColumn("significant", (F.abs("fc") >= fold) & (F.col("p_adjusted") < p))


def null_cluster(df: DataFrame, group: list[str], value: str, gap: float = 0.08, least: int = 3) -> DataFrame:
    """(group, null_mean, null_sd): of the cluster of levels that has the most rows, the nearest to 0 on ties."""
    levels = gap_clusters(df, group, value, gap, least)
    named = df.join(levels, [*group, value]).where("cluster > 0")
    stats = named.groupBy(*group, "cluster").agg(F.count("*").alias("n"), F.avg(value).alias("null_mean"), F.stddev_samp(value).alias("null_sd"))
    by = Window.partitionBy(*group).orderBy(F.desc("n"), F.abs("null_mean"), "cluster")
    return stats.withColumn("_nth", F.row_number().over(by)).where("_nth = 1").drop("_nth", "n", "cluster")


def two_means(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """group, cut, low_mean, high_mean, ratio: the split of sorted values that leaves least within, exactly, by prefix sums.

    ratio: total over remaining sum of squares. Equal values are counted first and different ones scanned in ranges, so a group may have any number
    of rows: within is concave while a value's rows move over, so a split after a value's first row or its last one is best.
    """
    v = F.col(value)
    counts = df.where(v.isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_m"))
    levels = ranged(counts, group, [value])
    sums = scan(levels, group, [value], {"_i0": (SUM, F.col("_m")), "_s0": (SUM, v * F.col("_m")), "_q0": (SUM, v * v * F.col("_m"))}, before=True)
    total = levels.groupBy(*group).agg(F.sum("_m").alias("_n"), F.sum(v * F.col("_m")).alias("_ts"), F.sum(v * v * F.col("_m")).alias("_tq"))
    same = F.lit(True)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    rows = sums.join(total.select(*(F.col(c).alias(f"_t_{c}") for c in group), "_n", "_ts", "_tq"), same)
    rows = rows.withColumn("_k", F.explode(F.array_distinct(F.array(F.lit(1).cast("long"), "_m"))))
    rows = rows.withColumn("_i", F.col("_i0") + F.col("_k")).withColumn("_s", F.col("_s0") + v * F.col("_k")).withColumn("_q", F.col("_q0") + v * v * F.col("_k"))
    rows = rows.where("_i < _n").withColumn("within", F.expr("(_q - _s * _s / _i) + (_tq - _q - (_ts - _s) * (_ts - _s) / (_n - _i))"))
    kept = F.struct(v.alias("cut"), "_s", "_i", "_ts", "_tq", "_n", "within")
    best = rows.groupBy(*group).agg(F.min_by(kept, F.struct(F.round("within", 9), "_i")).alias("_b")).select(*group, "_b.*")
    return best.select(*group, "cut", F.expr("_s / _i").alias("low_mean"), F.expr("(_ts - _s) / (_n - _i)").alias("high_mean"), F.expr("try_divide(_tq - _ts * _ts / _n, within)").alias("ratio"))


def intragenic(df: DataFrame, group: list[str], position: str, value: str, ratio: float = 3.7, single: float = 1.0, several: float = 0.5, share: float = 0.5, loss: bool = True, significant: str | None = None) -> DataFrame:
    """Genes of which a stretch of targets is lost (or gained): two well-parted clusters, the outer one mostly in one run.

    An outer cluster of one target needs a difference of means of single, of two to five several and over
    share of it in its longest run, of more several and at least share. Genes need three targets and three
    different values; with significant (a boolean column) some but not all targets must be.
    """
    known = df.where(F.col(value).isNotNull())
    mixed = F.lit(True) if significant is None else (F.count_if(significant) > 0) & (F.count_if(~F.col(significant)) > 0)
    fit = known.groupBy(*group).agg((F.count("*") >= 3).alias("_many"), (F.count_distinct(value) > 2).alias("_unlike"), mixed.alias("_mixed")).where("_many and _unlike and _mixed").select(*group)
    parted = two_means(known.join(fit, group), group, value).where(F.col("ratio") >= ratio)
    rows = known.join(parted, group).withColumn("_outer", (F.col(value) <= F.col("cut")) if loss else (F.col(value) > F.col("cut")))
    sizes = rows.groupBy(*group).agg(F.count_if("_outer").alias("n_outer"), F.any_value("low_mean").alias("low_mean"), F.any_value("high_mean").alias("high_mean"), F.any_value("ratio").alias("ratio"))
    runs = longest_run(rows, group, [position], F.col("_outer"), "run")
    out = sizes.join(runs, group).withColumn("difference", F.col("high_mean") - F.col("low_mean")).withColumn("share", F.col("run") / F.col("n_outer"))
    rule = (
        F.when(F.col("n_outer") == 1, F.col("difference") >= single)
        .when(F.col("n_outer") < 6, (F.col("difference") >= several) & (F.col("share") > share))
        .otherwise((F.col("difference") >= several) & (F.col("share") >= share))
    )
    return out.where(rule)


def gene_calls(df: DataFrame, gene: str = "gene", sample: str = "sample", fold: str = "fc", significant: str = "significant") -> DataFrame:
    """(gene, sample, call): 2 gained, -2 lost, 0 neither."""
    return df.select(gene, sample, F.when(F.col(significant) & (F.col(fold) > 0), 2).when(F.col(significant) & (F.col(fold) < 0), -2).otherwise(0).alias("call"))


def sex_by_coverage(df: DataFrame, sample: str = "sample", chrom: str = "chrom", value: str = "cov", least: float = 0.2) -> DataFrame:
    """(sample, y_share, sex): median coverage on Y over that elsewhere; Male from least on."""
    y = X.without_chr(F.col(chrom)) == "Y"
    share = df.groupBy(sample).agg(F.try_divide(F.median(F.when(y, F.col(value))), F.median(F.when(~y, F.col(value)))).alias("y_share"))
    return share.withColumn("sex", F.when(F.col("y_share") >= least, "Male").otherwise("Female"))


def best_normals_by_sex(ratios: DataFrame, tumor_sex: DataFrame, normal_sex: DataFrame, most_missing: int = 100) -> DataFrame:
    """best_normals() among normals of the tumor's sex, for targets on X; (tumor, sex) and (normal, sex)."""
    same = ratios.join(tumor_sex.select("tumor", F.col("sex").alias("_t")), "tumor").join(normal_sex.select("normal", F.col("sex").alias("_n")), "normal").where("_t = _n").drop("_t", "_n")
    return best_normals(same, most_missing)


def patient_pairs(samples: DataFrame) -> DataFrame:
    """(patient, tumor, normal, sex): each tumor with the first normal of its patient, null if it has none; samples: sample, patient, class, sex."""
    first = samples.where("class = 'Normal'").groupBy("patient").agg(F.min("sample").alias("normal"))
    return samples.where("class = 'Tumor'").select("patient", F.col("sample").alias("tumor"), "sex").join(first, "patient", "left").select("patient", "tumor", "normal", "sex")
