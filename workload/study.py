"""The win study on box scores derived from line items: features, scores, models, ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoopline.operators import models as M
from hoopline.operators import scores as C
from hoopline.plans import importance
from hoopline.plans.boxscore import (
    BOX_COLUMNS,
    MISC_METRICS,
    NOTEBOOK_FEATURES,
    SCRIPT_FEATURES,
    feature_matrix,
    team_boxscore_features,
)
from hoopline.session import stage
from workload import sql as S
from workload.registry import query
from workload.views import games, team_advanced, team_logs, team_misc

#: The season threshold of q9; the study reads all seasons.
SINCE = 1996
ALL_SEASONS = 0
#: The library's forests grow to depth 30. On these rows one such fit of 100 trees takes over seven minutes, so the
#: queries stop at 10; see README.
DEPTH = 10
KEYS = ["game_id", "team"]

_BOX_NAMES = [c.lower() for c in BOX_COLUMNS]
_FEATURES_CTE = f"""{S.BOX}, boxscores as (
  select tl.bare_id as game_id, "SEASON_YEAR" as season, mm.date, "TEAM" as team, "OPPONENT" as opp,
    case when "WL" = 'W' then 1 else 0 end as "win?",
    {", ".join(f'"{c.upper()}" as {c}' for c in _BOX_NAMES)}, {", ".join(MISC_METRICS)}, assist_to_turnover, pace
  from team_log tl join misc mm on tl.bare_id = mm.game_id and tl."TEAM_ID" = mm.team_id
  join advanced am on mm.game_id = am.game_id and mm.team_id = am.team_id)"""


def _box(spark, sf, since=ALL_SEASONS):
    """The three box-score tables exist as stored tables in use, so their common source is stored once."""
    g = stage(games(spark, sf), "games")
    return team_boxscore_features(
        team_logs(spark, sf, g), team_misc(spark, sf, g), team_advanced(spark, sf, g), since
    )


@query(
    "q9_team_boxscore_features", f"with {_FEATURES_CTE} select * from boxscores where season >= {SINCE}"
)
def q9(spark, sf):
    return _box(spark, sf, SINCE)


def _with_two_point(inner="boxscores"):
    return f"(select *, fgm - fg3m as fg2m, fga - fg3a as fg2a, \"win?\" as win from {inner})"


_MATRIX_CTE = f"""{_FEATURES_CTE}, matrix as (select game_id, team, win, {", ".join(
    f"coalesce({c}, avg({c}) over ()) as {c}" for c in NOTEBOOK_FEATURES)} from {_with_two_point()})"""


def _matrix(spark, sf, features=NOTEBOOK_FEATURES):
    """Its rows are stored by ``feature_matrix``: every score and fit reads them."""
    return feature_matrix(_box(spark, sf), features)


@query(
    "p13_feature_matrix",
    f"""with {_MATRIX_CTE} select game_id, team, win, {", ".join(f"round({c}, 6) as {c}" for c in NOTEBOOK_FEATURES)} from matrix""",
)
def p13_matrix(spark, sf):
    matrix = _matrix(spark, sf)
    return matrix.withColumns({c: F.round(c, 6) for c in NOTEBOOK_FEATURES})


def _long_sql(source, value, name="score"):
    """One select per feature; ``value`` has {c} for the feature's column."""
    return " union all ".join(
        f"select '{c}' as feature, {value.format(c=c)} as {name} from {source}" for c in NOTEBOOK_FEATURES
    )


@query(
    "a13_missing_values",
    f"""with {_FEATURES_CTE} select * from ({" union all ".join(
        f"select '{c}' as feature, count(*) - count({c}) as missing from boxscores" for c in SCRIPT_FEATURES)})
where missing > 0""",
)
def a13(spark, sf):
    return C.missing_counts(_box(spark, sf), SCRIPT_FEATURES)


@query("a14_class_counts", f"""with {_FEATURES_CTE} select "win?", count(*) as rows from boxscores group by 1""")
def a14(spark, sf):
    return C.class_counts(_box(spark, sf), "win?")


@query("a14_win_rate", f"""with {_FEATURES_CTE} select round(avg("win?"), 6) as rate from boxscores""")
def a14_rate(spark, sf):
    return C.class_rate(_box(spark, sf), "win?").withColumn("rate", F.round("rate", 6))


@query("a15_label_correlation", f"with {_MATRIX_CTE} {_long_sql('matrix', 'round(abs(corr({c}, win)), 8)', 'correlation')}")
def a15(spark, sf):
    found = C.label_correlations(_matrix(spark, sf), NOTEBOOK_FEATURES, "win")
    return found.withColumn("correlation", F.round("correlation", 8))


def _anova_sql(c):
    return f"""select '{c}' as feature, round((sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 6) as score
from (select count({c}) as n, avg({c}) as m, var_pop({c}) as v, (select avg({c}) from matrix) as g from matrix group by win)"""


_ANOVA_SQL = " union all ".join(_anova_sql(c) for c in NOTEBOOK_FEATURES)


@query("m9_anova_f", f"with {_MATRIX_CTE} {_ANOVA_SQL}")
def m9(spark, sf):
    return C.anova_f(_matrix(spark, sf), NOTEBOOK_FEATURES, "win").withColumn("score", F.round("score", 6))


def _information_sql(c, bins=32):
    return f"""select '{c}' as feature, round(sum(n / t * ln(n * t / (nc * nl))), 8) as score from (
  select n, sum(n) over () as t, sum(n) over (partition by cell) as nc, sum(n) over (partition by win) as nl from (
    select cell, win, cast(count(*) as double) as n from (
      select win, least(floor(coalesce(({c} - lo) * {bins} / nullif(hi - lo, 0), 0)), {bins - 1}) as cell
      from matrix, (select min({c}) as lo, max({c}) as hi from matrix)) group by 1, 2))"""


_INFORMATION_SQL = " union all ".join(_information_sql(c) for c in NOTEBOOK_FEATURES)


@query("m10_mutual_information", f"with {_MATRIX_CTE} {_INFORMATION_SQL}")
def m10(spark, sf):
    found = C.mutual_information(_matrix(spark, sf), NOTEBOOK_FEATURES, "win")
    return found.withColumn("score", F.round("score", 8))


def _psi_sql(x: str) -> str:
    y = f"(({x}) + 8.0)"
    i = f"(1.0 / ({y} * {y}))"
    steps = " + ".join(f"1.0 / (({x}) + {j}.0)" for j in range(8))
    return (f"(ln({y}) - 0.5 / {y} - {i} * (1.0 / 12 - {i} * (1.0 / 120 - {i} * (1.0 / 252 - {i} * (1.0 / 240 - {i} / 132)))) "
            f"- ({steps}))")


_LONG = " union all ".join(f"select win as class, rid, '{c}' as feature, cast({c} as double) as value from numbered" for c in NOTEBOOK_FEATURES)
_NEAR = ", ".join(f"abs({f}(value, {j}) over w - value)" for f in ("lag", "lead") for j in (1, 2, 3))
_NEIGHBOUR_SQL = f"""with {_MATRIX_CTE}, numbered as (select *, row_number() over () as rid from matrix),
long as ({_LONG}),
pts as (select * from (select *, count(*) over (partition by feature, class) as class_size from long
  where value is not null and class is not null) where class_size > 1),
nb as (select feature, rid, value, class_size, least(3, class_size - 1) as k,
  list_sort(list_filter([{_NEAR}], lambda x: x is not null)) as d from pts window w as (partition by feature, class order by value, rid)),
rad as (select feature, rid, value, class_size, k, d[k] as r from nb),
ev as (select feature, value, 1 as kind, 1 as point, cast(null as bigint) as rid, cast(null as varchar) as e from rad
  union all select feature, value - r, case when r = 0 then 0 else 2 end, 0, rid, 'low' from rad
  union all select feature, value + r, case when r = 0 then 2 else 0 end, 0, rid, 'high' from rad),
cnt as (select *, coalesce(sum(point) over (partition by feature order by value, kind rows between unbounded preceding and 1 preceding), 0) as before from ev),
m as (select feature, rid, sum(case when e = 'high' then before end) - sum(case when e = 'low' then before end) as m
  from cnt where point = 0 group by feature, rid)
select feature, round(greatest({_psi_sql("count(*)")} + avg({_psi_sql("k")}) - avg({_psi_sql("class_size")}) - avg({_psi_sql("m")}), 0), 8) as score
from rad join m using (feature, rid) group by feature"""


@query("m10_neighbour_information", _NEIGHBOUR_SQL)
def m10_neighbours(spark, sf):
    """Mutual information of each feature with winning by 3 nearest neighbours, as the study's library computes it."""
    found = C.neighbour_information(_matrix(spark, sf), NOTEBOOK_FEATURES, "win")
    return found.withColumn("score", F.round("score", 8))


def _statistics(spark, sf):
    """Scores by three statistical methods, rounded so that both engines rank the same numbers."""
    matrix = _matrix(spark, sf)
    methods = {
        "Correlation": C.label_correlations(matrix, NOTEBOOK_FEATURES, "win").withColumnRenamed("correlation", "score"),
        "F-statistic": C.anova_f(matrix, NOTEBOOK_FEATURES, "win"),
        "Mutual Information": C.mutual_information(matrix, NOTEBOOK_FEATURES, "win"),
    }
    digits = {"Correlation": 8, "F-statistic": 6, "Mutual Information": 8}
    frames = [
        frame.select("feature", F.lit(name).alias("method"), F.round("score", digits[name]).alias("score"))
        for name, frame in methods.items()
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


_STATISTICS_CTE = f"""{_MATRIX_CTE}, statistics as (
  select feature, 'Correlation' as method, correlation as score from ({_long_sql('matrix', 'round(abs(corr({c}, win)), 8)', 'correlation')})
  union all select feature, 'F-statistic', score from ({_ANOVA_SQL})
  union all select feature, 'Mutual Information', score from ({_INFORMATION_SQL})),
scaled as (select feature, method, (score - min(score) over (partition by method))
  / nullif(max(score) over (partition by method) - min(score) over (partition by method), 0) as score from statistics),
averaged as (select feature, method, round(score, 6) as score from scaled
  union all select feature, 'Average', round(avg(score), 6) from scaled group by 1),
ranks as (select feature, method, rank() over (partition by method order by score desc) as rank from averaged)"""


@query("m12_min_max", f"with {_STATISTICS_CTE} select feature, method, round(score, 6) as score from scaled")
def m12(spark, sf):
    return C.min_max(_statistics(spark, sf)).withColumn("score", F.round("score", 6))


def _averaged(spark, sf):
    return C.with_average(C.min_max(_statistics(spark, sf))).withColumn("score", F.round("score", 6))


@query("m13_method_average", f"with {_STATISTICS_CTE} select * from averaged where method = 'Average'")
def m13(spark, sf):
    return _averaged(spark, sf).filter("method = 'Average'").select("feature", "method", "score")


@query("w11_method_ranks", f"with {_STATISTICS_CTE} select feature, method, cast(rank as int) as rank from ranks")
def w11(spark, sf):
    return C.method_ranks(_averaged(spark, sf))


@query(
    "m14_rank_consistency",
    f"""with {_STATISTICS_CTE} select feature, round(stddev_samp(rank), 6) as rank_std from ranks
where method <> 'Average' group by 1""",
)
def m14(spark, sf):
    ranks = C.method_ranks(_averaged(spark, sf))
    return C.rank_consistency(ranks, ["Correlation", "F-statistic", "Mutual Information"]).withColumn(
        "rank_std", F.round("rank_std", 6)
    )


@query(
    "a16_category_means",
    f"""with {_STATISTICS_CTE}, categories(category, feature) as (values {", ".join(
        f"('{k}', '{f}')" for k, fs in C.CATEGORIES.items() for f in fs)})
select category, round(avg(score), 6) as score from averaged join categories using (feature)
where method = 'Average' group by 1""",
)
def a16(spark, sf):
    averages = _averaged(spark, sf).filter("method = 'Average'")
    return C.category_means(averages).withColumn("score", F.round("score", 6))


@query(
    "m3_standardise",
    f"""with {_MATRIX_CTE} select game_id, team, {", ".join(
        f"round(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 6) as {c}" for c in ("dreb", "ast", "pace"))} from matrix""",
)
def m3(spark, sf):
    names = ["dreb", "ast", "pace"]
    matrix = _matrix(spark, sf).select(*KEYS, *names)
    scaled = M.standardise(matrix, matrix, names)
    return scaled.withColumns({c: F.round(c, 6) for c in names})


@query(
    "m8_accuracy",
    f"""with {S.TEAM_LOG} select round(avg(case when ("PLUS_MINUS" > 0) = ("WL" = 'W') then 1.0 else 0.0 end), 8) as accuracy from team_log""",
)
def m8(spark, sf):
    scored = team_logs(spark, sf).select(
        (F.col("WL") == "W").cast("double").alias("label"), (F.col("PLUS_MINUS") > 0).cast("double").alias("prediction")
    )
    return scored.agg(F.round(M.accuracy(), 8).alias("accuracy"))


@query(
    "m2_stratified_split",
    f"""with {_MATRIX_CTE}, ranked as (select game_id, team, win,
  row_number() over (partition by win order by md5(concat_ws('|', game_id, team, win, '1'))) as place,
  count(*) over (partition by win) as n from matrix)
select game_id, team, win, place <= floor(n * 20 / 100.0 + 0.5) as is_test from ranked""",
)
def m2(spark, sf):
    """The side of the split of every row."""
    split = M.stratified_split(_matrix(spark, sf), KEYS, "win", seed=1)
    return split.select(*KEYS, "win", "is_test")


def _training(spark, sf, seed=1):
    """Split matrix with folds, written once because several fits read it."""
    split = M.with_folds(M.stratified_split(_matrix(spark, sf), KEYS, "win", seed), KEYS, "win", seed)
    rows = stage(split, "study-rows")
    return rows.filter(~F.col("is_test")), rows.filter("is_test")


def _fit(estimator, train):
    """A fit reads the dealt rows several times."""
    held = M.assemble(M.dealt(train, KEYS), NOTEBOOK_FEATURES, "win").persist()
    try:
        return M.fit(estimator, held)
    finally:
        held.unpersist()


def _importances(spark, model, test):
    hit = model.transform(test).agg(M.accuracy()).first()[0]
    scores = M.score_rows(spark, NOTEBOOK_FEATURES, "importance", model.featureImportances.toArray())
    return scores.withColumn("accuracy", F.lit(hit))


@query("m4_random_forest")
def m4(spark, sf):
    train, test = _training(spark, sf)
    return _importances(spark, _fit(M.random_forest(1, depth=DEPTH), train), M.assemble(test, NOTEBOOK_FEATURES, "win"))


@query("m5_gradient_boosting")
def m5(spark, sf):
    train, test = _training(spark, sf)
    return _importances(spark, _fit(M.gradient_boosting(1), train), M.assemble(test, NOTEBOOK_FEATURES, "win"))


def _scaled(spark, sf):
    train, test = _training(spark, sf)
    return M.standardise(train, train, NOTEBOOK_FEATURES), M.standardise(test, train, NOTEBOOK_FEATURES)


@query("m6_logistic_regression")
def m6(spark, sf):
    train, test = _scaled(spark, sf)
    model = _fit(M.logistic_regression(train.count()), train)
    hit = model.transform(M.assemble(test, NOTEBOOK_FEATURES, "win")).agg(M.accuracy()).first()[0]
    scores = M.score_rows(spark, NOTEBOOK_FEATURES, "importance", [abs(c) for c in model.coefficients.toArray()])
    return scores.withColumn("accuracy", F.lit(hit))


@query(
    "m7_fold_sizes",
    f"""with {_MATRIX_CTE}, placed as (select win,
  (row_number() over (partition by win order by md5(concat_ws('|', game_id, team, win, '1'))) - 1) % 5 as fold from matrix)
select win, cast(fold as int) as fold, count(*) as n_rows from placed group by win, fold""",
)
def m7_folds(spark, sf):
    """Rows per class and fold: exact, within one row of each other."""
    folded = M.with_folds(_matrix(spark, sf), KEYS, "win", seed=1)
    return folded.groupBy("win", "fold").agg(F.count(F.lit(1)).alias("n_rows"))


@query("m7_cross_validation")
def m7(spark, sf):
    """Five folds of each of the study's models."""
    return _study(spark, sf).performance.select("model", "cv_score")


@query("m11_permutation_importance")
def m11(spark, sf):
    """Of the forest, as in the study."""
    train, test = _training(spark, sf)
    model = _fit(M.random_forest(1, depth=DEPTH), train)
    return M.permutation_importance(model, test, NOTEBOOK_FEATURES, "win", KEYS)


_STUDIES = {}


def _study(spark, sf):
    """The whole study: 100 trees, 100 rounds, 10 repeats, 5 folds of each model. Its queries share one run, of
    which the tables are stored, within a session."""
    run = (spark.sparkContext.applicationId, sf)
    if run not in _STUDIES:
        _STUDIES[run] = importance.feature_importance(_matrix(spark, sf), NOTEBOOK_FEATURES, "win", KEYS, seed=1, depth=DEPTH)
    return _STUDIES[run]


@query("q10_feature_importance")
def q10(spark, sf):
    """Scaled scores of all six methods and their average, best first."""
    return _study(spark, sf).detailed


@query("m15_run_summary")
def m15(spark, sf):
    return _study(spark, sf).summary
