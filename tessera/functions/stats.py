"""One-pass column statistics, exact quantiles and null-safe correlation.

Every helper here fuses the statistics of *all* requested columns into a single
aggregate, so a profile of p columns costs one scan, not p scans.  Results that are
bounded by the number of columns (not rows) are returned to the driver as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kinds import q, sql_double, sql_name

# Quantile strategies.
#   "exact" (default): interpolated exactly like pandas `quantile` / DuckDB
#       `quantile_cont`, computed with bounded memory in two passes (see
#       `exact_quantiles`): a `percentile_approx` sketch brackets each needed order
#       statistic, then one more aggregate counts the rows below the bracket and keeps
#       only the values strictly inside it (at most ~8n/ACCURACY values per target).
#   "map": Spark's `percentile` (exact, one pass, but its state is a value->count map
#       that grows with the number of distinct values).
#   "approx": `percentile_approx` only (rank error n/accuracy, no interpolation).
EXACT, MAP, APPROX = "exact", "map", "approx"
CHUNK = 50         # columns per aggregate
ACCURACY = 10_000
MAX_BRACKET = 200_000  # values kept per order statistic in the final pass


def _pct(col: Column, probs: Sequence[float], method: str, accuracy: int) -> Column:
    """Single-pass quantile expression (used inside grouped aggregates)."""
    arr = F.array(*[F.lit(float(p)) for p in probs])
    if method == APPROX:
        return F.percentile_approx(col, arr, accuracy)
    return F.percentile(col, arr)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    accuracy: int = ACCURACY, max_bracket: int = MAX_BRACKET) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles for all columns with bounded memory.

    Pass 1 sketches every column; while a bracket could still hold more than
    ``max_bracket`` rows (n > ~max_bracket * accuracy / 8), one more pass re-sketches the
    rows inside each bracket only, shrinking it by a factor of about accuracy / 6; the
    final pass keeps the values inside the brackets.  Two passes up to ~2.5e8 rows per
    column, three up to ~1e12."""
    if len(cols) > CHUNK:  # one aggregate row holds the brackets of a bounded number of columns
        out: dict = {}
        for i in range(0, len(cols), CHUNK):
            out.update(exact_quantiles(df, cols[i:i + CHUNK], probs, accuracy, max_bracket))
        return out
    delta = 3.0 / accuracy
    brackets = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-delta, delta)})
    ends = ", ".join(map(sql_double, brackets))
    r1 = df.selectExpr(*[f"count({sql_name(c)}) AS n{i}" for i, c in enumerate(cols)],
                       *[f"percentile_approx(cast({sql_name(c)} AS double), array({ends}), {accuracy}) AS a{i}"
                         for i, c in enumerate(cols)]).first()
    plan = []  # (column index, lo, hi, [ranks])
    for i, c in enumerate(cols):
        n = r1[f"n{i}"]
        if not n:
            continue
        approx = dict(zip(brackets, r1[f"a{i}"]))
        for j, p in enumerate(probs):
            h = (n - 1) * p
            k1 = int(h // 1)
            k2 = min(k1 + 1, n - 1)
            lo = approx[min(1.0, max(0.0, p - delta))]
            hi = approx[min(1.0, max(0.0, p + delta))]
            plan.append((i, j, lo, hi, k1, k2, h - k1))
    if not plan:
        return {c: [None] * len(probs) for c in cols}
    est = [8.0 * r1[f"n{i}"] / accuracy for (i, *_r) in plan]
    for _ in range(8):
        big = [t for t in range(len(plan)) if est[t] > max_bracket]
        if not big:
            break
        aggs_n = []
        for t in big:
            i, j, lo, hi = plan[t][:4]
            x = q(cols[i]).cast("double")
            inb = (x >= F.lit(lo)) & (x <= F.lit(hi))
            k1, k2 = plan[t][4], plan[t][5]
            aggs_n += [F.sum((x < F.lit(lo)).cast("long")).alias(f"lt{t}"), F.sum(inb.cast("long")).alias(f"c{t}")]
        rn = df.agg(*aggs_n).first()
        aggs_s, probs_of = [], {}
        for t in big:
            i, j, lo, hi, k1, k2, frac = plan[t]
            lt, cnt = rn[f"lt{t}"], rn[f"c{t}"]
            pl = max(0.0, (k1 - lt) / cnt - delta) if cnt else 0.0
            ph = min(1.0, (k2 - lt + 1) / cnt + delta) if cnt else 1.0
            probs_of[t] = (pl, ph, cnt)
            x = q(cols[i]).cast("double")
            inb = (x >= F.lit(lo)) & (x <= F.lit(hi))
            aggs_s.append(F.percentile_approx(F.when(inb, x), F.array(F.lit(pl), F.lit(ph)), accuracy).alias(f"s{t}"))
        rs = df.agg(*aggs_s).first()
        for t in big:
            pl, ph, cnt = probs_of[t]
            sk = rs[f"s{t}"]
            if sk and sk[0] is not None:
                i, j, lo, hi, k1, k2, frac = plan[t]
                plan[t] = (i, j, sk[0], sk[1], k1, k2, frac)
            est[t] = (ph - pl) * cnt + 2.0 * cnt / accuracy
    aggs2 = []
    for t, (i, j, lo, hi, k1, k2, _) in enumerate(plan):
        x, a, b = f"cast({sql_name(cols[i])} AS double)", sql_double(lo), sql_double(hi)
        aggs2 += [f"sum(cast({x} < {a} AS long)) AS lt{t}", f"sum(cast({x} = {a} AS long)) AS eqlo{t}",
                  f"sum(cast({x} = {b} AS long)) AS eqhi{t}",
                  f"array_sort(collect_list(CASE WHEN {x} > {a} AND {x} < {b} THEN {x} END)) AS mid{t}"]
    r2 = df.selectExpr(*aggs2).first()
    out = {c: [None] * len(probs) for c in cols}
    redo = set()
    for t, (i, j, lo, hi, k1, k2, frac) in enumerate(plan):
        lt, eqlo, eqhi, mid = r2[f"lt{t}"], r2[f"eqlo{t}"], r2[f"eqhi{t}"], r2[f"mid{t}"] or []
        if hi == lo:
            eqhi = 0

        def at(k):
            r = k - lt
            if r < 0:
                return None
            if r < eqlo:
                return lo
            r -= eqlo
            if r < len(mid):
                return mid[r]
            r -= len(mid)
            return hi if r < eqhi else None
        v1, v2 = at(k1), at(k2)
        if v1 is None or v2 is None:
            redo.add(i)
            continue
        # numpy's lerp (pandas quantile): a + (b-a)t below one half, b - (b-a)(1-t) above
        out[cols[i]][j] = v1 if not frac else (v1 + (v2 - v1) * frac if frac < 0.5 else v2 - (v2 - v1) * (1 - frac))
    if redo:  # the sketch missed its error bound: fall back to the one-pass exact map
        fb = [cols[i] for i in sorted(redo)]
        out.update(quantiles(df, fb, probs, MAP))
    return out


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              method: str = EXACT, accuracy: int = 10000) -> dict[str, list[float | None]]:
    """{col: [q(p) for p in probs]}; all-null column -> Nones."""
    if not cols:
        return {}
    if method == EXACT:
        return exact_quantiles(df, cols, probs)
    row = df.agg(*[_pct(q(c), probs, method, accuracy).alias(f"q{i}")
                   for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        v = row[f"q{i}"]
        out[c] = [None if v is None else (None if x is None else float(x)) for x in (v or [None] * len(probs))]
    return out


def medians(df: DataFrame, cols: Sequence[str], method: str = EXACT) -> dict[str, float | None]:
    return {c: v[0] for c, v in quantiles(df, cols, [0.5], method).items()}


def mad_bounds(df: DataFrame, cols: Sequence[str], k: float = 3.0,
               method: str = EXACT) -> tuple[dict, dict]:
    """median +/- k * median(|x - median|): two aggregate passes for all columns."""
    med = medians(df, cols, method)
    live = [c for c in cols if med[c] is not None]
    dev = df.select(*[F.abs(q(c) - F.lit(med[c])).alias(c) for c in live])
    mad = medians(dev, live, method)
    lo, hi = {}, {}
    for c in live:
        lo[c] = med[c] - k * mad[c]
        hi[c] = med[c] + k * mad[c]
    return lo, hi


#: A variance below this share of the mean square is a constant side.
CONSTANT = 1e-13
MOMENTS = "a int, b int, n long, sa double, sb double, saa double, sbb double, sab double, odd long"


def _moments(shift, left: Sequence[int], right: Sequence[int], upper: bool):
    """One task's sums over the rows where both columns of a pair are present, as matrix
    products of the values and their presence masks."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        acc = None
        for batch in batches:
            X = np.empty((batch.num_rows, batch.num_columns))
            known = np.empty(X.shape)
            for j in range(batch.num_columns):
                c = batch.column(j)
                known[:, j] = c.is_valid().to_numpy(zero_copy_only=False)
                X[:, j] = c.fill_null(0.0).to_numpy(zero_copy_only=False)
            odd = ((~np.isfinite(X)) & (known > 0)).astype(float)
            X = np.where((known > 0) & (odd == 0), X - shift, 0.0)
            A, B, KA, KB, OA, OB = X[:, left], X[:, right], known[:, left], known[:, right], odd[:, left], odd[:, right]
            part = np.stack([KA.T @ KB, A.T @ KB, KA.T @ B, (A * A).T @ KB, KA.T @ (B * B), A.T @ B, OA.T @ KB + KA.T @ OB])
            acc = part if acc is None else acc + part
        if acc is None:
            return
        ia, ib = np.meshgrid(np.array(left, np.int32), np.array(right, np.int32), indexing="ij")
        pick = ia <= ib if upper else ia != ib
        cols = [ia[pick], ib[pick], acc[0][pick].astype(np.int64), *(acc[i][pick] for i in range(1, 6)), acc[6][pick].astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], [c.split()[0] for c in MOMENTS.split(", ")])
    return run


def co_moments(df: DataFrame, cols: Sequence[str], targets: Sequence[str] | None = None) -> DataFrame:
    """Masked co-moment matrix of the columns in one scan: per pair of column numbers a <= b (with
    targets: every column against each target) the count, sums, squares and products over the rows
    where both are present, taken from a provisional centre so that no digits are lost, and the
    number of such rows that hold a NaN or an infinity (left out of the sums).  A task emits one
    row per pair; they are summed per pair."""
    import numpy as np

    from ..session import ship_package
    ship_package(df.sparkSession)
    every = list(dict.fromkeys([*cols, *(targets or ())]))
    x = df.select(*[q(c).cast("double").alias(f"c{i}") for i, c in enumerate(every)])
    some = x.limit(1000).toPandas().to_numpy(float)  # bounded: the centre only has to be near the data
    shift = np.zeros(len(every))
    for j in range(len(every)):
        v = np.sort(some[np.isfinite(some[:, j]), j])
        shift[j] = v[len(v) // 2] if len(v) else 0.0
    left = [every.index(c) for c in cols]
    right = [every.index(t) for t in targets] if targets is not None else left
    sums = [F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab", "odd")]
    return x.mapInArrow(_moments(shift, left, right, targets is None), MOMENTS).groupBy("a", "b").agg(*sums)


def corr_long(df: DataFrame, cols: Sequence[str], pairs: str = "upper",
              targets: Sequence[str] | None = None) -> DataFrame:
    """Correlations in long form (a, b, r) from one scan, each over the rows where both columns
    are present; NULL for a constant side, NaN where such a row holds a NaN or an infinity.

    pairs='upper': a before b in `cols` order; 'all': every ordered pair incl. the
    diagonal; targets=[t]: (a, t) for every a != t.
    """
    cols = list(cols)
    full = targets is None and pairs != "upper"
    if not cols or (targets is not None and not [c for c in cols if [t for t in targets if t != c]]):
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    every = list(dict.fromkeys([*cols, *(targets or ())]))
    names = F.array(*[F.lit(c) for c in every])
    n = F.col("n")

    def var(s: str, ss: str) -> Column:
        v = F.try_divide(F.col(ss), n) - F.pow(F.try_divide(F.col(s), n), F.lit(2.0))
        return F.when(v > F.lit(CONSTANT) * F.try_divide(F.col(ss), n), v)  # below: rounding of a constant
    cov = F.try_divide(F.col("sab"), n) - F.try_divide(F.col("sa"), n) * F.try_divide(F.col("sb"), n)
    r = F.when(F.col("odd") > 0, F.lit(float("nan"))).otherwise(cov / F.sqrt(var("sa", "saa") * var("sb", "sbb")))
    same = F.col("a") == F.col("b")
    r = F.when(same & (F.col("odd") == 0), F.when(var("sa", "saa").isNotNull(), F.lit(1.0))).otherwise(r)
    out = co_moments(df, cols, targets).select("a", "b", r.cast("double").alias("r"))
    if targets is None and not full:
        out = out.filter(~same)
    if full:  # both orders of a pair from its one row
        there, back = F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r")
        out = out.select(F.inline(F.when(same, F.array(there)).otherwise(F.array(there, back))))
    return out.select(names[F.col("a")].alias("a"), names[F.col("b")].alias("b"), "r")


def _by_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where a null key equals a null key; the left keys are kept."""
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def grouped_quantile(long: DataFrame, keys: Sequence[str], x: str, p: float = 0.5, method: str = EXACT,
                     accuracy: int = ACCURACY, out: str = "q", max_bracket: int = MAX_BRACKET) -> DataFrame:
    """Exact interpolated p-quantile of ``x`` per group of ``keys`` -> (keys..., out).

    "exact": a percentile_approx bracket per group, then per group the count below the
    bracket, the counts equal to its ends and only the values strictly inside (about
    8 n_g / accuracy values).  Hot groups whose bracket could exceed ``max_bracket``
    values (a key holding a large share of all rows) are taken out and solved one by one
    with ``exact_quantiles``, whose narrowing passes keep memory bounded at any size.
    "map": Spark's one-pass `percentile`."""
    from ..session import cut_lineage
    keys = list(keys)
    xv = F.col(x).cast("double")
    if method != EXACT:
        return long.groupBy(*keys).agg(_pct(xv, [p], method, accuracy)[0].alias(out))
    d = 3.0 / accuracy
    plo, phi = max(0.0, p - d), min(1.0, p + d)
    s1 = (long.filter(xv.isNotNull()).groupBy(*keys)
          .agg(F.count(xv).alias("__n"), F.percentile_approx(xv, F.array(F.lit(plo), F.lit(phi)), accuracy).alias("__a"))
          .select(*keys, "__n", F.col("__a")[0].alias("__lo"), F.col("__a")[1].alias("__hi")))
    s1 = cut_lineage(s1)
    hot_n = max_bracket * accuracy / 8.0
    hot = s1.filter(F.col("__n") > F.lit(hot_n)).select(*keys).collect()  # at most rows / hot_n groups
    hot_parts = []
    for h in hot:
        cond = None
        for k in keys:
            c = F.col(k).isNull() if h[k] is None else (F.col(k) == F.lit(h[k]))
            cond = c if cond is None else cond & c
        v = exact_quantiles(long.filter(cond), [x], [p], accuracy, max_bracket)[x][0]
        hot_parts.append(tuple(h[k] for k in keys) + (v,))
    if hot:
        hot_df = long.sparkSession.createDataFrame(hot_parts, s1.select(*keys).schema.add(out, "double"))
        s1 = _by_keys(s1, hot_df.select(*keys), keys, "left_anti")
    j = _by_keys(long.filter(xv.isNotNull()), s1, keys, "inner")
    lo, hi = F.col("__lo"), F.col("__hi")
    s2 = j.groupBy(*keys).agg(
        F.first("__n").alias("__n"), F.first("__lo").alias("__lo"), F.first("__hi").alias("__hi"),
        F.sum((xv < lo).cast("long")).alias("__lt"), F.sum((xv == lo).cast("long")).alias("__eqlo"),
        F.sum(((xv == hi) & (hi != lo)).cast("long")).alias("__eqhi"),
        F.array_sort(F.collect_list(F.when((xv > lo) & (xv < hi), xv))).alias("__mid"))
    h = (F.col("__n") - 1) * F.lit(p)
    k1 = F.floor(h)
    k2 = F.least(k1 + 1, F.col("__n") - 1)
    frac = h - k1

    missed = F.lit(float("nan"))  # the sketch missed its bound: solved again below

    def at(k):
        r = k - F.col("__lt")
        in_mid = r - F.col("__eqlo")
        return (F.when(r < 0, missed).when(r < F.col("__eqlo"), lo)
                .when(in_mid < F.size("__mid"), F.element_at("__mid", (in_mid + 1).cast("int")))
                .when(in_mid - F.size("__mid") < F.col("__eqhi") + F.when(hi == lo, 1).otherwise(0), hi).otherwise(missed))
    v1, v2 = at(k1), at(k2)
    val = F.when(frac == 0, v1).when(frac < 0.5, v1 + (v2 - v1) * frac).otherwise(v2 - (v2 - v1) * (F.lit(1.0) - frac))
    res = cut_lineage(s2.select(*keys, val.alias(out)))
    again = res.filter(F.isnan(out)).select(*keys)
    if again.limit(1).count():
        exact = (_by_keys(long.filter(xv.isNotNull()), again, keys, "left_semi").groupBy(*keys).agg(_pct(xv, [p], MAP, accuracy)[0].alias(out)))
        res = res.filter(~F.isnan(out)).unionByName(exact)
    return res.unionByName(hot_df) if hot else res


def grouped_quantiles_wide(df: DataFrame, key: Column, cols: Sequence[str], p: float = 0.5,
                           method: str = EXACT, prefix: str = "__g") -> DataFrame:
    """(__key, {prefix}0.., {prefix}k) : per-group p-quantile of each column (null key
    rows dropped), via the long view and a pivot over the (few) column indexes."""
    items = F.array(*[F.struct(F.lit(i).alias("__t"), q(c).cast("double").alias("__x")) for i, c in enumerate(cols)])
    long = df.filter(key.isNotNull()).select(key.alias("__key"), F.inline(items))
    qq = grouped_quantile(long, ["__key", "__t"], "__x", p, method)
    wide = qq.groupBy("__key").pivot("__t", list(range(len(cols)))).agg(F.first("q"))
    return wide.select("__key", *[F.col(str(i)).alias(f"{prefix}{i}") for i in range(len(cols))])
