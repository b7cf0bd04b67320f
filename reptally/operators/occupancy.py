"""Step 4: is a rare feature real? Scored from its detections across replicates.

The model gives every location (feature at a site) an occupancy psi ~ Beta(2, 2), every
feature a true detection rate p11 ~ Beta(2, 2) and a false one p10 ~ Beta(1, 10). Whether
a row has detections is data, so all three posteriors are Beta distributions with counts
that plain aggregates give. The reported probability is the posterior mean of

    psi p11^N (1-p11)^(K-N) / (psi p11^N (1-p11)^(K-N) + (1-psi) p10^N (1-p10)^(K-N)),

integrated by the trapezoid rule over the log-odds of the three rates, once for each distinct set
of parameters.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reptally.functions.bins import bin_width, centred_bin
from reptally.functions.joins import attach, total_of
from reptally.functions.storage import cut
from reptally.operators.blanks import group_columns

# fixed values: priors of the model
PRIOR_PSI = (2, 2)
PRIOR_P11 = (2, 2)
PRIOR_P10 = (1, 10)

# fixed values: names of the cut-offs and of the verdicts
CUTOFFS = ("som_min_threshold_1", "som_min_threshold_2", "som_min_threshold_3")
TOSS = "Toss"
KEEP = "Keep"
BORDERLINE = "Borderline"

# the rates' log-odds run to where their density is below exp(-_FALL) in a tail, or this many
# spreads from the middle
_FALL, _SPREADS = 17.0, 4.5
# change from half the nodes from which on a set is integrated on more of them, and their limit
SETTLED = 1e-3
MOST_POINTS = 256

PARAMETERS = ["a_psi", "b_psi", "a_p11", "b_p11", "a_p10", "b_p10"]


def detections(long: DataFrame, mode: str = "double") -> DataFrame:
    """Distinct (feature, taxon, site, bio_rep[, tech_rep]) with reads."""
    level = ["bio_rep", "tech_rep"] if group_columns(mode) == ["site", "bio_rep"] else ["bio_rep"]
    return long.select("feature", "taxon", "site", *level).distinct()


def replicate_count(found: DataFrame, mode: str = "double") -> DataFrame:
    """Replicates K per site: distinct technical or, in single mode, biological ones."""
    level = "tech_rep" if mode == "double" else "bio_rep"
    return found.groupBy("site").agg(F.count_distinct(level).alias("k"))


def detection_counts(found: DataFrame, mode: str = "double") -> DataFrame:
    """Detections per feature, site and biological replicate; per feature and site in single mode."""
    keys = ["feature", "taxon", *group_columns(mode)]
    return found.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_det"))


def presence_pattern(found: DataFrame, mode: str = "double") -> DataFrame:
    """One row per feature and site with K and its detections over all biological replicates.

    The pattern names the replicates that have detections and how many, sorted and joined
    by dots (``A=2.B=1``); a replicate that is not named has none.
    """
    # one shuffle serves both aggregates; a feature at a site has few rows, one per replicate
    near = found.repartition("feature", "site")
    cells = near.groupBy("feature", "taxon", "site", "bio_rep").agg(F.count(F.lit(1)).alias("n_det"))
    named = F.concat_ws("=", "bio_rep", F.col("n_det").cast("string"))
    patterns = cells.groupBy("feature", "taxon", "site").agg(
        F.array_join(F.array_sort(F.collect_list(named)), ".").alias("pattern"),
        F.sum("n_det").alias("detections"),
        F.max("n_det").alias("max_detections"),
    )
    return attach(patterns, replicate_count(found, mode), ["site"], by=["feature"])


def unique_patterns(patterns: DataFrame, by_k: bool = True) -> DataFrame:
    """One representative (the smallest feature and site) per K and pattern.

    ``by_k=False`` keys by the pattern alone; rows with another K then find no partner.
    """
    keys = ["k", "pattern"] if by_k else ["pattern"]
    return patterns.groupBy(*keys).agg(
        F.min(F.struct("feature", "site", "k", "detections", "max_detections")).alias("_first"),
        F.count(F.lit(1)).alias("n_rows"),
    ).select(
        "pattern",
        "n_rows",
        "_first.feature",
        "_first.site",
        "_first.k",
        "_first.detections",
        "_first.max_detections",
    )


def model_rows(unique: DataFrame, found: DataFrame, mode: str = "double") -> DataFrame:
    """Rows of the model: N detections out of K for each representative (and biological replicate)."""
    if mode == "single":
        return unique.select("feature", "site", F.lit("all").alias("bio_rep"), "k", F.col("detections").alias("n"))
    # a representative is one (feature, site), which has one row per replicate: no hot keys
    own = found.join(unique.select("feature", "site", "k"), ["feature", "site"])
    return own.groupBy("feature", "site", "bio_rep", "k").agg(F.count(F.lit(1)).alias("n"))


def occupancy_fit(rows: DataFrame) -> DataFrame:
    """Posterior Beta parameters of psi per location and of p11 and p10 per feature."""
    hit = (F.col("n") > 0).cast("bigint")
    miss = F.lit(1) - hit
    place = rows.groupBy("feature", "site").agg(
        (F.sum(hit) + PRIOR_PSI[0]).alias("a_psi"), (F.sum(miss) + PRIOR_PSI[1]).alias("b_psi")
    )
    failed = F.col("k") - F.col("n")
    kind = rows.groupBy("feature").agg(
        (F.sum(hit * F.col("n")) + PRIOR_P11[0]).alias("a_p11"),
        (F.sum(hit * failed) + PRIOR_P11[1]).alias("b_p11"),
        (F.sum(miss * F.col("n")) + PRIOR_P10[0]).alias("a_p10"),
        (F.sum(miss * failed) + PRIOR_P10[1]).alias("b_p10"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    placed = rows.join(place, ["feature", "site"])
    return attach(placed, kind, ["feature"], "inner", by=["site", "bio_rep"], counted="n_rows")


def _nodes(a: str, b: str, points: int, effect: Callable[[Column, Column], Column]) -> Column:
    """Evenly spaced log-odds of a Beta(a, b) rate: weight (the largest is about 1) and effect.

    In log-odds the density falls off exponentially on both sides and is smooth everywhere, so
    that the plain sum converges faster than any power of the spacing; the ends are where it is
    below 1e-7 of its top. ``effect`` gets the logs of the rate and of its complement.
    """
    p, q = F.col(a).cast("double"), F.col(b).cast("double")
    middle, spread = F.ln(p / q), F.sqrt(1 / p + 1 / q)
    low = middle - F.lit(_FALL) / p - spread * _SPREADS
    high = middle + F.lit(_FALL) / q + spread * _SPREADS
    top = -p * F.log1p(q / p) - q * F.log1p(p / q)

    def node(i: Column) -> Column:
        y = low + (high - low) * (i / F.lit(float(points)))
        log_x, log_rest = -F.log1p(F.exp(-y)), -F.log1p(F.exp(y))
        return F.struct(F.exp(p * log_x + q * log_rest - top).alias("w"), effect(log_x, log_rest).alias("e"))

    return F.transform(F.sequence(F.lit(0), F.lit(points)), node)


def _sums(psi: Column, p11: Column, p10: Column) -> Column:
    """(w, m, q): sums of the weights, and of the probability and its square by weight."""
    # one chain of sums through all three, since whatever a lambda names twice is computed twice
    def add(acc: Column, w: Column, r: Column) -> Column:
        return F.struct((acc["w"] + w).alias("w"), (acc["m"] + w * r).alias("m"), (acc["q"] + w * F.pow(r, F.lit(2.0))).alias("q"))

    def inner(acc: Column, s: Column, u: Column) -> Column:
        return F.aggregate(p10, acc, lambda x, v: add(x, s["w"] * u["w"] * v["w"], 1 / (1 + F.exp(s["e"] - u["e"] + v["e"]))))

    def middle(acc: Column, s: Column) -> Column:
        return F.aggregate(p11, acc, lambda x, u: inner(x, s, u))

    nothing = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("m"), F.lit(0.0).alias("q"))
    return F.aggregate(psi, nothing, middle)


def _integrated(sets: DataFrame, points: int) -> DataFrame:
    """Mean, deviation and the change from half the points, for sets of parameters."""
    k, n = F.col("k"), F.col("n")
    nodes = F.struct(
        # the false rate has the widest range of the three
        _nodes("a_psi", "b_psi", points * 5 // 8, lambda x, rest: rest - x).alias("psi"),
        _nodes("a_p11", "b_p11", points * 5 // 8, lambda x, rest: n * x + (k - n) * rest).alias("p11"),
        _nodes("a_p10", "b_p10", points, lambda x, rest: n * x + (k - n) * rest).alias("p10"),
    )

    def both(z: Column) -> Column:
        half = [F.filter(z[c], lambda _, i: i % 2 == 0) for c in ("psi", "p11", "p10")]
        return F.struct(_sums(z["psi"], z["p11"], z["p10"]).alias("fine"), F.transform(F.array(F.struct(*[h.alias(c) for h, c in zip(half, "abc")])), lambda h: _sums(h["a"], h["b"], h["c"])).alias("coarse"))

    # bound to a variable, so that the nodes are made once
    found = sets.withColumn("_s", F.element_at(F.transform(F.array(nodes), both), 1))
    fine, coarse = F.col("_s.fine"), F.element_at("_s.coarse", 1)
    mean = fine["m"] / fine["w"]
    return found.select(
        *sets.columns,
        mean.alias("mean"),
        F.sqrt(F.greatest(F.lit(0.0), fine["q"] / fine["w"] - mean * mean)).alias("sd"),
        F.abs(mean - coarse["m"] / coarse["w"]).alias("change"),
    )


def occupancy_prob(fit: DataFrame, points: int = 80, change: bool = False) -> DataFrame:
    """Posterior mean and standard deviation of the occupancy probability of every row.

    Work is shared: each distinct set of parameters is integrated once, with ``points`` nodes for
    the false rate and five eighths as many for the other two. The same sum over every second node
    comes along; sets whose mean changes by more than ``SETTLED`` between the two, which happens
    with many replicates, are integrated again on twice the nodes, up to ``MOST_POINTS``. The
    error falls off so fast that it is far below that change. ``change`` adds it as a column.
    """
    keys = ["k", "n", *PARAMETERS]
    tasks = int(fit.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = cut(fit.select(*keys).distinct(), "parameter-sets")
    done: DataFrame | None = None
    while done is None or not rest.isEmpty():
        found = cut(_integrated(rest.repartition(tasks, *keys), points), "integrated")
        good = F.lit(True) if points * 2 > MOST_POINTS else F.coalesce(F.col("change") <= SETTLED, F.lit(True))
        done = found.filter(good) if done is None else done.unionByName(found.filter(good))
        rest, points = found.filter(~good).select(*keys), points * 2
    done = done if change else done.drop("change")
    return attach(fit, done, keys, "inner", by=["feature", "site", "bio_rep"])


def occupancy_plugin(rows: DataFrame, psi: float, p11: float, p10: float) -> DataFrame:
    """The same probability at given parameter values."""
    n, missed = F.col("n"), F.col("k") - F.col("n")
    real = F.lit(psi) * F.pow(F.lit(p11), n) * F.pow(F.lit(1 - p11), missed)
    false = F.lit(1 - psi) * F.pow(F.lit(p10), n) * F.pow(F.lit(1 - p10), missed)
    return rows.withColumn("prob", F.try_divide(real, real + false))


def site_max_occupancy(probs: DataFrame) -> DataFrame:
    """Largest mean over the rows of a representative."""
    return probs.groupBy("feature", "site").agg(F.max("mean").alias("occupancy"))


def pattern_occupancy(unique: DataFrame, best: DataFrame) -> DataFrame:
    """Representatives with their occupancy probability."""
    return unique.join(best, ["feature", "site"], "left")


def attach_occupancy(patterns: DataFrame, scored: DataFrame) -> DataFrame:
    """Every feature and site gets the probability of its (K, pattern)."""
    keys = ["k", "pattern"]
    best = scored.select(*keys, "occupancy", "n_rows")
    return attach(patterns, best, keys, by=["feature", "site"], counted="n_rows")


def occupancy_cutoffs(scored: DataFrame, mode: str = "double") -> DataFrame:
    """Three cut-offs in one row.

    The largest probability of a single detection; the largest of one detection in every
    replicate that has any (double) or of two detections (single); the smallest of three.
    """
    total = F.col("detections")
    second = F.col("max_detections") == 1 if mode == "double" else total == 2
    prob = F.col("occupancy")
    return scored.agg(
        F.max(F.when(total == 1, prob)).alias(CUTOFFS[0]),
        F.max(F.when(second, prob)).alias(CUTOFFS[1]),
        F.min(F.when(total == 3, prob)).alias(CUTOFFS[2]),
    )


def occupancy_verdict(results: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """How many rows fall below the first cut-off, above the second, or between."""
    prob = F.col("occupancy")
    low = cutoffs.select(CUTOFFS[0]).scalar()
    high = cutoffs.select(CUTOFFS[1]).scalar()
    verdict = F.when(prob < low, TOSS).when(prob > high, KEEP).otherwise(BORDERLINE)
    counted = results.groupBy(verdict.alias("to_keep")).agg(F.count(F.lit(1)).alias("n"))
    share = F.round(F.col("n") * 100.0 / total_of(results, F.count(F.lit(1))), 2)
    return counted.withColumn("per", share)


def occupancy_filter(results: DataFrame, cutoffs: DataFrame, choice: str = CUTOFFS[0]) -> DataFrame:
    """Rows at or above the chosen cut-off; rows without a probability go."""
    if choice not in CUTOFFS:
        raise ValueError(f"cut-off must be one of {CUTOFFS}")
    return results.filter(F.col("occupancy") >= cutoffs.select(choice).scalar())


def keep_taxa(long: DataFrame, kept: DataFrame, on: Sequence[str] = ("taxon",)) -> DataFrame:
    """Rows whose taxon passed at any site; a missing taxon is one of its own."""
    on = list(on)
    named = {f"_on{i}": F.struct(F.col(c).isNull().alias("none"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("name")) for i, c in enumerate(on)}
    known = kept.select(*[x.alias(n) for n, x in named.items()]).distinct()
    return attach(long.withColumns(named), known, list(named), "left_semi", by=["feature", "sample"]).select(*long.columns)


def occupancy_hist(results: DataFrame, bins: int = 30) -> DataFrame:
    """Histogram of the probabilities, equal bins centred on the smallest and the largest."""
    ends = results.agg(F.min("occupancy").alias("low"), F.max("occupancy").alias("high"))
    low = ends.select("low").scalar()
    width = ends.select(bin_width(F.col("low"), F.col("high"), bins).alias("w")).scalar()
    known = results.filter(F.col("occupancy").isNotNull())
    return known.groupBy(centred_bin(F.col("occupancy"), low, width).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
