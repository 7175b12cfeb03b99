"""Class balance report and resampling (IB1-IB11).

Sampling targets follow the reference: ``'auto'`` balances to 1:1; a float r means
minority / majority = r after resampling.  Random choices come from seeded md5 hashes of
the row id, so results do not depend on partitioning.  Neighbour-based resamplers use
the exact kNN join in ``functions.neighbors``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.kinds import q
from ..session import stage_table
from .split import exact_first_n


def class_counts(df: DataFrame, label: str) -> dict:
    return {r[0]: r[1] for r in df.groupBy(q(label)).count().collect()}


def balance_report(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """IB1 — per class: train/test counts and %, the %-point gap, and (same on every row)
    the max/min ratio on train with its severity (> 10 strong, > 3 moderate, else mild)."""
    a = train.groupBy(q(label).alias("class")).agg(F.count(F.lit(1)).alias("n_train"))
    b = test.groupBy(q(label).alias("class")).agg(F.count(F.lit(1)).alias("n_test"))
    j = a.join(b, "class", "full").fillna(0, ["n_train", "n_test"])
    tot = j.agg(F.sum("n_train").alias("tr"), F.sum("n_test").alias("te"),
                F.max("n_train").alias("mx"), F.min("n_train").alias("mn")).first()
    ratio = (tot["mx"] / tot["mn"]) if tot["mn"] else None
    sev = "strong" if ratio is not None and ratio > 10 else ("moderate" if ratio is not None and ratio > 3 else "mild")
    pt = F.col("n_train") * 100.0 / F.lit(float(max(tot["tr"], 1)))
    pe = F.col("n_test") * 100.0 / F.lit(float(max(tot["te"], 1)))
    return j.select("class", "n_train", "n_test", pt.alias("pct_train"), pe.alias("pct_test"),
                    F.abs(pt - pe).alias("gap"), F.lit(ratio).alias("ratio"), F.lit(sev).alias("severity"))


def _targets(counts: dict, strategy) -> tuple:
    classes = sorted(counts, key=lambda k: (counts[k], str(k)))
    minority, majority = classes[0], classes[-1]
    return minority, majority


def undersample(df: DataFrame, label: str, id_col: str = "id", features: Sequence[str] | None = None,
                sampling_strategy="auto", seed: int = 42) -> DataFrame:
    """IB2 — keep every minority row; keep exactly the wanted number of every other class
    (``'auto'``: the minority count; float r: floor(n_min / r)), chosen by seeded hash."""
    counts = class_counts(df, label)
    minority, _ = _targets(counts, sampling_strategy)
    n_min = counts[minority]
    want_other = n_min if sampling_strategy == "auto" else int(n_min / float(sampling_strategy))
    want = {k: (v if k == minority else min(v, want_other)) for k, v in counts.items() if k is not None}
    return df.filter(exact_first_n(df, label, id_col, want, seed, "under"))


def identity(df: DataFrame, *args, **kwargs) -> DataFrame:
    return df


def minority_majority(df: DataFrame, label: str) -> tuple:
    counts = class_counts(df, label)
    mn, mj = _targets(counts, "auto")
    return mn, mj, counts


def n_synthetic(counts: dict, minority, majority, sampling_strategy="auto") -> int:
    if sampling_strategy == "auto":
        return max(counts[majority] - counts[minority], 0)
    return max(int(float(sampling_strategy) * counts[majority]) - counts[minority], 0)


def numeric_features(df: DataFrame, features: Sequence[str] | None, exclude: Sequence[str]) -> list[str]:
    from ..functions.kinds import numeric_columns
    return list(features) if features is not None else numeric_columns(df, exclude)


# ----------------------------------------------------------------------------- IB3 / IB4
def _neighbours(df: DataFrame, label: str, id_col: str, features: Sequence[str], k: int):
    from ..functions.neighbors import knn_join
    from ..session import cut_lineage
    base = cut_lineage(df.select(q(id_col).cast("long").alias("id"), q(label).alias("y"),
                                 F.array(*[q(c).cast("double") for c in features]).alias("vec")))
    n = base.count()
    nn = knn_join(base, base, k, q_count=n, b_count=n)
    ys = base.select("id", "y")
    nn = (nn.join(ys.withColumnRenamed("id", "qid").withColumnRenamed("y", "qy"), "qid")
          .join(ys.withColumnRenamed("id", "nid").withColumnRenamed("y", "ny"), "nid"))
    return base, nn


def tomek_links(df: DataFrame, label: str, id_col: str = "id", features: Sequence[str] | None = None,
                remove: str = "majority") -> DataFrame:
    """IB3 — a Tomek link is a pair of opposite-class rows that are each other's nearest
    neighbour; the majority member of every link is removed (``remove='both'`` drops both)."""
    feats = numeric_features(df, features, (id_col, label))
    base, nn = _neighbours(df, label, id_col, feats, 1)
    first = stage_table(nn.filter(F.col("rank") == 1).select("qid", "nid", "qy", "ny"))  # read twice
    mutual = first.alias("x").join(first.alias("y"), (F.col("x.qid") == F.col("y.nid")) & (F.col("x.nid") == F.col("y.qid")))
    links = mutual.filter(F.col("x.qy") != F.col("x.ny")).select(F.col("x.qid").alias("id"), F.col("x.qy").alias("y"))
    if remove == "majority":
        _, majority, _ = minority_majority(df, label)
        links = links.filter(F.col("y") == F.lit(majority))
    drop = links.select(F.col("id").alias("__drop")).distinct()
    return df.join(drop, q(id_col).cast("long") == F.col("__drop"), "left_anti")


def edited_nearest_neighbours(df: DataFrame, label: str, id_col: str = "id", features: Sequence[str] | None = None,
                              n_neighbors: int = 3, clean: str = "majority") -> DataFrame:
    """IB4 — a row of a cleaned class is removed unless ALL its k nearest other rows share
    its class (kind_sel='all'); ``clean='majority'`` cleans the majority class only
    ('auto'), ``'all'`` every class."""
    feats = numeric_features(df, features, (id_col, label))
    base, nn = _neighbours(df, label, id_col, feats, n_neighbors)
    agree = nn.groupBy("qid", "qy").agg(F.bool_and(F.col("qy") == F.col("ny")).alias("ok"))
    bad = agree.filter(~F.col("ok"))
    if clean == "majority":
        _, majority, _ = minority_majority(df, label)
        bad = bad.filter(F.col("qy") == F.lit(majority))
    drop = bad.select(F.col("qid").alias("__drop"))
    return df.join(drop, q(id_col).cast("long") == F.col("__drop"), "left_anti")


# ----------------------------------------------------------------------------- IB5-IB9
def _hash_unit(*cols, seed: int = 42):
    """Seeded uniform in [0, 1) from a 64-bit hash (deterministic, partition-independent)."""
    h = F.xxhash64(F.lit(seed), *cols)
    return (F.pmod(h, F.lit(1 << 40)).cast("double") / F.lit(float(1 << 40)))


#: Copies that one row of the generator makes; a seed with more is cut into pieces.
COPIES_PER_PIECE = 10_000


def _synthesise(seeds: DataFrame, partners: DataFrame, copies: DataFrame, feats: Sequence[str],
                label: str, minority, id_offset: int, seed: int, u_max_col: str | None = None) -> DataFrame:
    """seeds: (id, vec); partners: (qid, rank, pvec[, u_max]); copies: (id, n_copies).
    For copy j of seed s: the partner from a seeded hash, u in [0, u_max) from another.

    A seed meets its few partners once.  Running totals of the copies give every seed its
    interval of new ids; intervals are cut into pieces that are spread over all tasks, so a
    seed of any number of copies is no hot key and the new rows themselves are never moved."""
    from ..functions.prefix import running_totals
    u_max = F.col(u_max_col) if u_max_col else F.lit(1.0)
    met = (partners.groupBy(F.col("qid").alias("id"))
           .agg(F.array_sort(F.collect_list(F.struct("rank", "pvec", u_max.alias("u_max")))).alias("met")))
    plan = seeds.join(copies.filter("n_copies > 0").select("id", F.col("n_copies").cast("long").alias("n")), "id").join(met, "id")
    placed = running_totals(stage_table(plan), ["id"], ["n"])  # a range shuffle reads its input twice
    size = F.lit(COPIES_PER_PIECE).cast("long")
    pieces = placed.select("id", "vec", "met", "n", (F.col("cum_n") - F.col("n")).alias("start"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / size))).alias("piece"))
    pieces = pieces.repartition(int(seeds.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id", "piece")
    first = F.col("piece") * size
    ex = pieces.select("id", "vec", "met", "start", F.explode(F.sequence(first + 1, F.least(first + size, F.col("n")))).alias("j"))
    partner = F.element_at("met", (F.pmod(F.xxhash64(F.lit(seed), F.lit("nb"), "id", "j"), F.size("met")) + 1).cast("int"))
    ex = ex.select((F.lit(id_offset) + F.col("start") + F.col("j") - 1).alias("id"), "vec", partner.alias("p"),
                   _hash_unit(F.lit("u"), "id", "j", seed=seed).alias("u"))
    u = F.col("u") * F.col("p.u_max")
    made = ex.select("id", F.zip_with("vec", "p.pvec", lambda a, b: a + u * (b - a)).alias("vec"))
    return made.select("id", *[F.col("vec")[i].alias(c) for i, c in enumerate(feats)], F.lit(minority).alias(label))


def _copies(ids: DataFrame, total: int, seed: int, purpose: str) -> DataFrame:
    """Spread ``total`` copies over the rows of ``ids`` (id) exactly: base copies for all,
    one more for the first (total mod n) rows in seeded hash order."""
    n = ids.count()
    if n == 0 or total <= 0:
        return ids.select("id", F.lit(0).alias("n_copies"))
    base, extra = divmod(total, n)
    first = exact_first_n(ids, None, "id", {"": extra}, seed, purpose) if extra else F.lit(False)
    return ids.select("id", (F.lit(base) + first.cast("int")).alias("n_copies"))


def _prep(df, label, id_col, features):
    feats = numeric_features(df, features, (id_col, label))
    mn, mj, counts = minority_majority(df, label)
    return feats, mn, mj, counts


def _vec_table(df, id_col, feats):
    return df.select(q(id_col).cast("long").alias("id"), F.array(*[q(c).cast("double") for c in feats]).alias("vec"))


def _append(df, syn, id_col, label, feats):
    syn = syn.withColumnRenamed("id", id_col)
    for c in df.columns:
        if c not in syn.columns:
            syn = syn.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
    syn = syn.select(*[F.col(c).cast(df.schema[c].dataType).alias(c) for c in df.columns])
    return df.unionByName(syn)


def smote(df: DataFrame, label: str, id_col: str = "id", features: Sequence[str] | None = None,
          k_neighbors: int = 5, sampling_strategy="auto", seed: int = 42) -> DataFrame:
    """IB5 — SMOTE: x + u * (neighbour - x), neighbour among the k nearest minority rows,
    u in [0, 1); exactly n_majority - n_minority new rows for 'auto' (floor(r * n_maj) -
    n_min for a float r), spread evenly over the minority rows in seeded hash order."""
    from ..functions.neighbors import knn_join
    feats, mn, mj, counts = _prep(df, label, id_col, features)
    g = n_synthetic(counts, mn, mj, sampling_strategy)
    if g == 0:
        return df
    minority = stage_table(_vec_table(df.filter(q(label) == F.lit(mn)), id_col, feats))
    nmin = counts[mn]
    nn = knn_join(minority, minority, min(k_neighbors, max(nmin - 1, 1)), q_count=nmin, b_count=nmin)
    partners = nn.join(minority.select(F.col("id").alias("nid"), F.col("vec").alias("pvec")), "nid") \
        .select("qid", "rank", "pvec")
    copies = _copies(minority.select("id"), g, seed, "smote")
    offset = (df.agg(F.max(q(id_col).cast("long"))).first()[0] or 0) + 1
    syn = _synthesise(minority, partners, copies, feats, label, mn, offset, seed)
    return _append(df, syn, id_col, label, feats)


def borderline_smote(df: DataFrame, label: str, id_col: str = "id", features: Sequence[str] | None = None,
                     k_neighbors: int = 5, m_neighbors: int = 10, kind: str = "borderline-1",
                     sampling_strategy="auto", seed: int = 42) -> DataFrame:
    """IB6 — seeds are the "danger" minority rows (m/2 <= majority among m neighbours < m).
    borderline-1 interpolates with minority neighbours only; borderline-2 also with the
    nearest majority rows, using u in [0, 0.5) for those (as in the paper)."""
    from ..functions.neighbors import knn_join
    feats, mn, mj, counts = _prep(df, label, id_col, features)
    g = n_synthetic(counts, mn, mj, sampling_strategy)
    if g == 0:
        return df
    allv = stage_table(df.select(q(id_col).cast("long").alias("id"), q(label).alias("y"),
                                 F.array(*[q(c).cast("double") for c in feats]).alias("vec")))
    n = sum(counts.values())
    minority = allv.filter(F.col("y") == F.lit(mn)).select("id", "vec")
    nn_all = knn_join(minority, allv, m_neighbors, q_count=counts[mn], b_count=n)
    maj = (nn_all.join(allv.select(F.col("id").alias("nid"), "y"), "nid")
           .groupBy("qid").agg(F.sum((F.col("y") != F.lit(mn)).cast("int")).alias("n_maj")))
    danger = maj.filter((F.col("n_maj") >= m_neighbors / 2.0) & (F.col("n_maj") < m_neighbors)) \
        .select(F.col("qid").alias("id"))
    seeds = stage_table(minority.join(danger, "id", "left_semi"))
    if seeds.limit(1).count() == 0:
        return df
    nmin = counts[mn]
    nn_min = knn_join(seeds, minority, min(k_neighbors, max(nmin - 1, 1)), b_count=nmin)
    partners = nn_min.join(minority.select(F.col("id").alias("nid"), F.col("vec").alias("pvec")), "nid") \
        .select("qid", "rank", "pvec", F.lit(1.0).alias("u_max"))
    if kind == "borderline-2":
        others = allv.filter(F.col("y") != F.lit(mn)).select("id", "vec")
        nn_maj = knn_join(seeds, others, k_neighbors, exclude_self=False)
        partners = stage_table(partners)
        kmin = partners.agg(F.max("rank")).first()[0] or 0
        pm = nn_maj.join(others.select(F.col("id").alias("nid"), F.col("vec").alias("pvec")), "nid") \
            .select("qid", (F.col("rank") + F.lit(kmin)).alias("rank"), "pvec", F.lit(0.5).alias("u_max"))
        partners = partners.unionByName(pm)
    copies = _copies(seeds.select("id"), g, seed, "bsmote")
    offset = (df.agg(F.max(q(id_col).cast("long"))).first()[0] or 0) + 1
    syn = _synthesise(seeds, partners, copies, feats, label, mn, offset, seed, u_max_col="u_max")
    return _append(df, syn, id_col, label, feats)


def adasyn(df: DataFrame, label: str, id_col: str = "id", features: Sequence[str] | None = None,
           n_neighbors: int = 5, sampling_strategy="auto", seed: int = 42) -> DataFrame:
    """IB7 — ADASYN: r_i = majority share among the k nearest rows of minority row i;
    copies_i = round(r_i / sum(r) * G); interpolation with minority neighbours."""
    from ..functions.neighbors import knn_join
    feats, mn, mj, counts = _prep(df, label, id_col, features)
    g = n_synthetic(counts, mn, mj, sampling_strategy)
    if g == 0:
        return df
    allv = stage_table(df.select(q(id_col).cast("long").alias("id"), q(label).alias("y"),
                                 F.array(*[q(c).cast("double") for c in feats]).alias("vec")))
    minority = allv.filter(F.col("y") == F.lit(mn)).select("id", "vec")
    nmin, n = counts[mn], sum(counts.values())
    nn_all = knn_join(minority, allv, n_neighbors, q_count=nmin, b_count=n)
    r = stage_table(nn_all.join(allv.select(F.col("id").alias("nid"), "y"), "nid")
                    .groupBy("qid").agg(F.avg((F.col("y") != F.lit(mn)).cast("double")).alias("r")))
    tot = r.agg(F.sum("r")).first()[0] or 0.0
    if tot == 0:
        return df
    copies = r.select(F.col("qid").alias("id"), F.round(F.col("r") / F.lit(tot) * F.lit(g)).cast("int").alias("n_copies"))
    nn_min = knn_join(minority, minority, min(n_neighbors, max(nmin - 1, 1)), q_count=nmin, b_count=nmin)
    partners = nn_min.join(minority.select(F.col("id").alias("nid"), F.col("vec").alias("pvec")), "nid") \
        .select("qid", "rank", "pvec")
    offset = (df.agg(F.max(q(id_col).cast("long"))).first()[0] or 0) + 1
    syn = _synthesise(minority, partners, copies, feats, label, mn, offset, seed)
    return _append(df, syn, id_col, label, feats)


def smote_enn(df: DataFrame, label: str, id_col: str = "id", features: Sequence[str] | None = None,
              smote_k: int = 3, enn_k: int = 3, sampling_strategy="auto", clean: str = "all", seed: int = 42):
    """IB8 — SMOTE then ENN (``clean='all'`` cleans both classes, as the published
    combination; 'majority' cleans only the majority)."""
    from ..session import cut_lineage
    s = cut_lineage(smote(df, label, id_col, features, smote_k, sampling_strategy, seed))
    return edited_nearest_neighbours(s, label, id_col, features, enn_k, clean)


def smote_tomek(df: DataFrame, label: str, id_col: str = "id", features: Sequence[str] | None = None,
                smote_k: int = 5, sampling_strategy="auto", remove: str = "both", seed: int = 42):
    """IB9 — SMOTE then removal of Tomek links (both members by default)."""
    from ..session import cut_lineage
    s = cut_lineage(smote(df, label, id_col, features, smote_k, sampling_strategy, seed))
    return tomek_links(s, label, id_col, features, remove)


RESAMPLERS = {
    "Original": identity,
    "RandomUnderSampler": undersample,
    "TomekLinks": tomek_links,
    "EditedNearestNeighbours": edited_nearest_neighbours,
    "SMOTE": smote,
    "BorderlineSMOTE": borderline_smote,
    "ADASYN": adasyn,
    "SMOTEENN": smote_enn,
    "SMOTETomek": smote_tomek,
}
QUICK = ["Original", "RandomUnderSampler", "SMOTE", "SMOTETomek"]
