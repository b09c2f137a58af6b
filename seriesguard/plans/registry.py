"""Detection by method name (E3, E5): any mix of methods over one frame, one long result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesguard.frame import SeriesFrame, store
from seriesguard.operators import statistical
from seriesguard.operators.grubbs import grubbs_flags
from seriesguard.operators.hbos import hbos_scores
from seriesguard.operators.iforest import iforest_scores
from seriesguard.operators.neighbors import neighbour_scores
from seriesguard.operators.ocsvm import ocsvm_scores
from seriesguard.operators.pca import pca_scores
from seriesguard.operators.stats import contamination_cut

# Method names, in the order results are listed, and the members of the votes.
STATISTICAL = ("zscore", "modified_zscore", "iqr", "moving_average", "ema", "seasonal", "grubbs")
LEARNED = ("isolation_forest", "lof", "knn", "ocsvm", "hbos", "autoencoder")
VOTES = ("ensemble_stat", "ensemble_ml")
ALIASES = {"ensemble": "ensemble_stat"}
LEARNED_VOTERS = ("isolation_forest", "lof", "knn")
SHARE = 0.5
CONTAMINATION = 0.1
NEIGHBOURS = {"knn": 5, "lof": 20}


def normalize(methods: Sequence[str]) -> list[str]:
    """Resolve aliases, drop repeats and put methods into result order."""
    named = {ALIASES.get(m, m) for m in methods}
    known = (*STATISTICAL, *LEARNED, *VOTES)
    unknown = sorted(named - set(known))
    if unknown:
        raise ValueError(f"unknown methods {unknown}; known are {list(known)}")
    return [m for m in known if m in named]


def detect(frame: SeriesFrame, methods: Sequence[str], params: Mapping[str, Mapping] | None = None,
           window: int = 10, contamination: float = CONTAMINATION) -> DataFrame:
    """One row per input row and method: the row, ``method``, ``is_anomaly``, ``anomaly_score``.

    ``params`` holds keyword parameters per method. Rows without a value are kept and not flagged.
    """
    chosen = normalize(methods)
    wide = detect_wide(frame, chosen, params, window, contamination)
    flags = F.array(*[F.struct(F.lit(m).alias("method"), F.col(f"`{m}`").alias("is_anomaly")) for m in chosen])
    rows = wide.select(*frame.columns, F.inline(flags))
    return rows.withColumn("anomaly_score", F.col("is_anomaly").cast("double"))


def detect_wide(frame: SeriesFrame, methods: Sequence[str], params: Mapping[str, Mapping] | None = None,
                window: int = 10, contamination: float = CONTAMINATION) -> DataFrame:
    """The rows with one boolean column per method."""
    chosen = normalize(methods)
    params = {ALIASES.get(m, m): dict(p) for m, p in (params or {}).items()}
    normalize(list(params))
    if set(chosen) - {"zscore", "modified_zscore", "iqr"}:
        frame = frame.stored
    votes = {m: _vote_settings(m, params.get(m, {})) for m in chosen if m in VOTES}
    members = {v for s in votes.values() for v in s["members"]}
    custom = {m for m in chosen if m not in VOTES and params.get(m)}

    dense = [m for m in STATISTICAL[:-1] if m in members or (m in chosen and m not in custom)]
    # methods with their own parameters share the pass too, unless a vote needs their defaults
    tuned = [m for m in STATISTICAL[:-1] if m in custom and m not in members]
    sparse: dict[str, DataFrame] = {}
    for m in custom & members:
        if m in STATISTICAL:
            flagged = statistical.flag_columns(frame, [m], {m: params[m]}, indexed=True)
            sparse[m + "*"] = flagged.where(F.col(m)).select(*frame.keys, "i")
    if "grubbs" in chosen:
        sparse["grubbs"] = grubbs_flags(frame, **params.get("grubbs", {}))
    learned = [m for m in LEARNED if m in members or (m in chosen and m not in custom)]
    sparse.update(learned_flags(frame, learned, {}, window, contamination))
    tuned_learned = [m for m in LEARNED if m in custom]
    own = learned_flags(frame, tuned_learned, params, window, contamination)
    sparse.update({m + "*" if m in members else m: flags for m, flags in own.items()})

    columns = [*dense, *tuned]
    rows = (statistical.flag_columns(frame, columns, {m: params[m] for m in tuned}, indexed=bool(sparse))
            if columns else frame.indexed)
    rows = add_sparse(frame, rows, sparse)
    for name, s in votes.items():
        rows = rows.withColumn(name, statistical.vote(rows, s["members"], s["listed"], s["share"]))
    picked = [F.col(f"`{m}*`" if m in custom and m in members else m).alias(m) for m in chosen]
    rows = rows.select(*frame.columns, *picked)
    missing = frame.invalid.select(*frame.columns, *[F.lit(False).alias(m) for m in chosen])
    return rows.unionByName(missing)


def add_sparse(frame: SeriesFrame, rows: DataFrame, sparse: Mapping[str, DataFrame]) -> DataFrame:
    """Boolean columns from tables of flagged positions: one join for all of them."""
    if not sparse:
        return rows
    at = [*frame.keys, "i"]
    listed = reduce(DataFrame.unionByName, [
        flags.select(*at, F.lit(name).alias("_method")) for name, flags in sparse.items()])
    flags = listed.groupBy(*at).agg(*[
        F.max(F.col("_method") == name).alias(name) for name in sparse])
    rows = rows.join(flags, at, "left")
    return rows.withColumns({name: F.coalesce(F.col(f"`{name}`"), F.lit(False)) for name in sparse})


def learned_flags(frame: SeriesFrame, methods: Sequence[str], params: Mapping[str, Mapping],
                  window: int = 10, contamination: float = CONTAMINATION) -> dict[str, DataFrame]:
    """Positions flagged by each learned method; neighbour methods share one search.

    Scores are written before they are cut, as the percentile and the comparison both read them.
    """
    keys, profile = list(frame.keys), frame.profile

    def cut(scores: DataFrame, share: float = contamination, score: str = "score") -> DataFrame:
        return contamination_cut(scores, keys, share, profile.longest, profile.n_series,
                                 score).select(*keys, "i")

    flags = {}
    near = [m for m in ("knn", "lof") if m in methods]
    if near:
        counts = {m: _settings(m, {"n_neighbors": NEIGHBOURS[m]}, params)["n_neighbors"] for m in near}
        scores = store(neighbour_scores(frame, window, **counts))
        flags.update({m: cut(scores, score=m) for m in near})
    if "isolation_forest" in methods:
        flags["isolation_forest"] = cut(store(iforest_scores(
            frame, window, **_settings("isolation_forest", {"n_estimators": 100}, params))))
    if "hbos" in methods:
        flags["hbos"] = cut(store(hbos_scores(
            frame, window, **_settings("hbos", {"n_bins": 10}, params))))
    if "autoencoder" in methods:
        percentile = _settings("autoencoder", {"threshold_percentile": 95.0}, params)["threshold_percentile"]
        flags["autoencoder"] = cut(store(pca_scores(frame, window)), 1.0 - percentile / 100.0)
    if "ocsvm" in methods:
        given = _settings("ocsvm", {"nu": 0.1, "kernel": "rbf"}, params)
        scores = ocsvm_scores(frame, window, **given)
        flags["ocsvm"] = scores.where(F.col("score") > 0).select(*keys, "i")
    return {m: flags[m] for m in LEARNED if m in flags}


def _vote_settings(name: str, given: Mapping) -> dict:
    default, known = ((statistical.VOTERS, STATISTICAL) if name == "ensemble_stat"
                      else (LEARNED_VOTERS, LEARNED))
    unknown = set(given) - {"methods", "voting_threshold"}
    listed = list(given.get("methods") or default)
    if unknown or set(listed) - set(known):
        raise ValueError(f"{name}: cannot use {sorted(unknown | (set(listed) - set(known)))}")
    # seasonal and grubbs may be listed and count as members, but cast no vote
    voters = statistical.VOTERS if name == "ensemble_stat" else LEARNED
    members = [m for m in voters if m in listed]
    if not members:
        raise ValueError(f"{name}: none of {listed} can vote")
    return {"members": members, "listed": len(listed), "share": given.get("voting_threshold", SHARE)}


def _settings(method: str, defaults: Mapping, params: Mapping[str, Mapping]) -> dict:
    given = dict(params.get(method) or {})
    if set(given) - set(defaults):
        raise ValueError(f"{method} has no parameter {sorted(set(given) - set(defaults))}")
    return {**defaults, **given}
