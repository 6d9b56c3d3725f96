"""Queries for splitting, training, scoring and evaluation."""

from __future__ import annotations

from datetime import date

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from contestlab.operators.frames import fill_missing
from contestlab.plans import matches, modelling, squads
from contestlab.plans.bayes import GaussianBayes
from contestlab.registry import query, views
from contestlab.registry.match_queries import features_sql
from contestlab.session import pinned, scratch_path
from contestlab.sources import tables

LEVELS = ["Away", "Draw", "Home"]
FEATURES = [c for c in matches.TRAINING_COLUMNS if c != "winner"]

# A fixed rule as the prediction, so that the evaluation queries have an exact answer.
RULE = """CASE WHEN (home + season) % 3 = 0 THEN 'Home' WHEN (home + season) % 3 = 1 THEN 'Away' ELSE 'Draw' END"""
PRED = views.LEDGER + f", pred AS (SELECT contest_id, winner, {RULE} AS predicted FROM ledger WHERE winner IS NOT NULL)"


def predictions(spark, sf_dir):
    turn = (F.col("home") + F.col("season")) % 3
    rule = F.when(turn == 0, "Home").when(turn == 1, "Away").otherwise("Draw")
    return views.ledger(spark, sf_dir).filter(F.col("winner").isNotNull()).select(
        "contest_id", "winner", rule.alias("predicted"))


@query("split_exact", f"""WITH {views.LEDGER}, ranked AS (SELECT contest_id, ROW_NUMBER() OVER
      (ORDER BY MD5('456|' || contest_id), contest_id) AS r, COUNT(*) OVER () AS n FROM ledger)
    SELECT contest_id, r <= CAST(ROUND_EVEN(n * 0.9, 0) AS BIGINT) AS is_train FROM ranked""")
def _split(spark, sf_dir):
    return modelling.split_exact(views.ledger(spark, sf_dir).select("contest_id"), 0.9, "contest_id", 456)


@query("split_hash", f"""WITH {views.LEDGER} SELECT contest_id,
    CAST('0x' || SUBSTR(MD5('456|' || contest_id), 1, 8) AS BIGINT) < CAST(FLOOR(0.8 * 4294967296) AS BIGINT) AS is_train FROM ledger""")
def _split_hash(spark, sf_dir):
    return modelling.split_hash(views.ledger(spark, sf_dir).select("contest_id"), 0.8, "contest_id", 456)


@query("label_index", f"""WITH {views.LEDGER} SELECT contest_id, winner, CAST(DENSE_RANK() OVER (ORDER BY winner) - 1 AS DOUBLE) AS label
    FROM ledger WHERE winner IS NOT NULL""")
def _label(spark, sf_dir):
    games = views.ledger(spark, sf_dir).filter(F.col("winner").isNotNull()).select("contest_id", "winner")
    return modelling.label_index(games, "winner")[0]


@query("class_weights", f"""WITH {views.LEDGER}, p AS (SELECT contest_id, winner FROM ledger WHERE winner IS NOT NULL)
    SELECT contest_id, winner, (SELECT COUNT(*) FROM p) * 1.0::DOUBLE / (COUNT(*) OVER (PARTITION BY winner) * 3) AS weight FROM p""")
def _weights(spark, sf_dir):
    games = views.ledger(spark, sf_dir).filter(F.col("winner").isNotNull()).select("contest_id", "winner")
    return modelling.class_weights(games, "winner")


@query("confusion_matrix", f"WITH {PRED} SELECT winner, " + ", ".join(
    f"""COUNT(CASE WHEN predicted = '{v}' THEN 1 END) AS "{v}" """ for v in LEVELS) + "FROM pred GROUP BY winner")
def _confusion(spark, sf_dir):
    return modelling.confusion_matrix(predictions(spark, sf_dir), LEVELS)


@query("accuracy", f"WITH {PRED} SELECT AVG(CAST(winner = predicted AS INTEGER)) AS accuracy FROM pred")
def _accuracy(spark, sf_dir):
    return modelling.accuracy(predictions(spark, sf_dir))


@query("accuracy_literal", f"""WITH {PRED}, c AS (SELECT winner, predicted, COUNT(*) AS n FROM pred GROUP BY winner, predicted),
    r AS (SELECT *, DENSE_RANK() OVER (ORDER BY winner) AS i, DENSE_RANK() OVER (ORDER BY predicted) AS j FROM c)
    SELECT CAST(SUM(CASE WHEN i = j THEN n ELSE 0 END) AS DOUBLE) / SUM(n) AS accuracy FROM r""")
def _accuracy_literal(spark, sf_dir):
    return modelling.accuracy(predictions(spark, sf_dir), mode="literal")


@query("mean_per_class_error", f"""WITH {PRED} SELECT 1 - AVG(recall) AS mean_per_class_error FROM
    (SELECT AVG(CAST(winner = predicted AS INTEGER)) AS recall FROM pred GROUP BY winner) AS t""")
def _error(spark, sf_dir):
    return modelling.mean_per_class_error(predictions(spark, sf_dir))


@query("review", f"""WITH {PRED} SELECT l.*, predicted FROM ledger l JOIN pred p ON p.contest_id = l.contest_id""")
def _review(spark, sf_dir):
    return modelling.review(predictions(spark, sf_dir), views.ledger(spark, sf_dir))


@query("log_result", f"""WITH {PRED}, a AS (SELECT AVG(CAST(winner = predicted AS INTEGER)) AS result FROM pred)
    SELECT 'rule' AS approach, result, '2020-02-01' AS time_run FROM a
    UNION ALL SELECT 'rule', result, '2020-02-02' FROM a""")
def _log(spark, sf_dir):
    target = scratch_path(spark, "runs")
    result = modelling.accuracy(predictions(spark, sf_dir))
    for day in (date(2020, 2, 1), date(2020, 2, 1), date(2020, 2, 2)):
        tables.log_result(result, target, "rule", day)
    return tables.read_table(spark, target, tables.MODEL_RESULT)


def training(spark, sf_dir):
    """Training rows with a split mark, written once because fitting reads them many times."""
    features = matches.match_features(views.ledger(spark, sf_dir))
    rows = pinned(fill_missing(matches.training_set(features, drop_seasons=[1995])))
    return modelling.split_exact(rows, 0.9, "contest_id", 456)


def _halves(spark, sf_dir):
    rows = training(spark, sf_dir)
    return rows.filter("is_train").drop("is_train"), rows.filter("NOT is_train").drop("is_train")


def _logistic(train):
    indexed, labels = modelling.label_index(train, "winner")
    weighted = modelling.class_weights(indexed, "label")
    plan = modelling.pipeline(
        LogisticRegression(featuresCol="scaled", labelCol="label", weightCol="weight", maxIter=20), FEATURES)
    return plan.fit(weighted), labels


# What SQL can state of a model's output: the rows it is for, and that each value is possible.
HALVES = views.LEDGER + """,
rows AS (SELECT contest_id, winner, day, home, away FROM ledger WHERE season <> 1995 AND winner IS NOT NULL),
halves AS (SELECT *, ROW_NUMBER() OVER (ORDER BY MD5('456|' || contest_id), contest_id)
             <= CAST(ROUND_EVEN(COUNT(*) OVER () * 0.9, 0) AS BIGINT) AS is_train FROM rows)"""


def _known(labels):
    return F.coalesce(F.col("predicted").isin(*labels), F.lit(False)).alias("predicted_known")


@query("model_leaderboard", """SELECT model, 'fitted' AS status, TRUE AS metric_in_range
    FROM (VALUES ('logistic_regression'), ('random_forest'), ('boosted_trees'), ('perceptron')) AS t(model)""")
def _leaderboard(spark, sf_dir):
    """Every candidate is fitted and judged on all rows; whoever searches under a budget halves the field instead."""
    train, _ = _halves(spark, sf_dir)
    found = modelling.search_models(
        train, "winner", FEATURES, "contest_id", metric="mean_per_class_error", folds=2, balance=True, halve=False)
    return found.leaderboard.select("model", "status", F.col("mean_per_class_error").between(0, 1).alias("metric_in_range"))


# Naive Bayes in SQL. `fitted` and `asked` have rows (run, contest_id, winner, feature, x); every run is a model of its own.
LONG = features_sql("intended") + f""",
halves AS (SELECT *, ROW_NUMBER() OVER (ORDER BY MD5('456|' || contest_id), contest_id)
             <= CAST(ROUND_EVEN(COUNT(*) OVER () * 0.9, 0) AS BIGINT) AS is_train
           FROM features WHERE season <> 1995 AND winner IS NOT NULL),
wide AS (SELECT contest_id, winner, is_train, {", ".join(f"COALESCE({c}, 0)::DOUBLE AS {c}" for c in FEATURES)} FROM halves),
long AS MATERIALIZED (SELECT * FROM (UNPIVOT wide ON {", ".join(FEATURES)} INTO NAME feature VALUE x))"""
BAYES = """
centres AS (SELECT run, feature, ROUND_EVEN(AVG(x), 0) AS c FROM fitted GROUP BY run, feature),
sums AS MATERIALIZED (
  SELECT run, feature, winner, c, COUNT(x) AS k, SUM(x - c) AS s, SUM((x - c) * (x - c)) AS q
  FROM fitted JOIN centres USING (run, feature) GROUP BY run, feature, winner, c),
least AS (SELECT run, 1e-9::DOUBLE * MAX(v) AS least
  FROM (SELECT run, feature, SUM(q) / SUM(k) - (SUM(s) / SUM(k)) * (SUM(s) / SUM(k)) AS v FROM sums GROUP BY run, feature) GROUP BY run),
moments AS MATERIALIZED (
  SELECT run, feature, winner AS class, c + s / k AS mean, GREATEST(q / k - (s / k) * (s / k), 0) + least AS v FROM sums JOIN least USING (run)),
shares AS (SELECT run, winner AS class, n::DOUBLE / SUM(n) OVER (PARTITION BY run) AS share
  FROM (SELECT run, winner, COUNT(DISTINCT contest_id) AS n FROM fitted GROUP BY run, winner)),
logs AS (
  SELECT run, contest_id, winner, class, LN(shares.share) - SUM(0.5 * (LN(2 * PI() * v) + (x - mean) * (x - mean) / v)) AS l
  FROM asked JOIN moments USING (run, feature) JOIN shares USING (run, class) GROUP BY run, contest_id, winner, class, shares.share),
parts AS (SELECT *, EXP(l - MAX(l) OVER w) AS part, ROW_NUMBER() OVER (w ORDER BY l DESC, class) AS place FROM logs
          WINDOW w AS (PARTITION BY run, contest_id)),
scored AS MATERIALIZED (SELECT run, contest_id, winner, MAX(CASE WHEN place = 1 THEN class END) AS predicted,
    """ + ", ".join(f"SUM(CASE WHEN class = '{v}' THEN part ELSE 0 END) / SUM(part) AS {v.lower()}" for v in LEVELS) + """
  FROM parts GROUP BY run, contest_id, winner)"""
HELD_OUT = f"""WITH {LONG}, fitted AS (SELECT 1 AS run, * FROM long WHERE is_train), asked AS (SELECT 1 AS run, * FROM long WHERE NOT is_train),
{BAYES} SELECT contest_id, winner, predicted, {", ".join(f"ROUND({v.lower()}, 6) AS {v.lower()}" for v in LEVELS)} FROM scored"""


def _bayes(train, features):
    indexed, labels = modelling.label_index(train, "winner")
    return modelling.pipeline(GaussianBayes(featuresCols=list(features)), features).fit(indexed), labels


def _shares(scored):
    return scored.select("contest_id", "winner", "predicted", *[F.round(v.lower(), 6).alias(v.lower()) for v in LEVELS])


@query("bayes_score", HELD_OUT)
def _bayes_score(spark, sf_dir):
    """Predictions and probabilities of a model that has a closed form."""
    train, test = _halves(spark, sf_dir)
    model, labels = _bayes(train, FEATURES)
    return _shares(modelling.score(model, test, labels, probabilities=True))


@query("stored_model_score", HELD_OUT)
def _stored(spark, sf_dir):
    """The same by the second version of a store, written, opened and checked against the table."""
    train, test = _halves(spark, sf_dir)
    store = scratch_path(spark, "models")
    for features in (FEATURES[:2], FEATURES):
        model, labels = _bayes(train, features)
        modelling.store_model(model, store, train, features, labels)
    return _shares(modelling.open_model(spark, store).score(test, probabilities=True))


SUBSETS = {"all": FEATURES, "form": [c for c in FEATURES if c.endswith("form")], "points": [c for c in FEATURES if c.endswith("points_before")],
           "standing": [c for c in FEATURES if c.endswith("standing")]}


@query("bayes_leaderboard", f"""WITH {LONG},
subsets(model, feature) AS (VALUES {", ".join(f"('{m}', '{c}')" for m, own in SUBSETS.items() for c in own)}),
marked AS (SELECT *, CAST('0x' || SUBSTR(MD5('456|' || contest_id), 1, 8) AS BIGINT) % 2 AS fold,
             CAST('0x' || SUBSTR(MD5('456|' || contest_id), 9, 8) AS BIGINT) AS number FROM long WHERE is_train),
turns AS (SELECT turn, GREATEST(share, LEAST(1, 1000 / n)) AS share
          FROM (VALUES (1, 0.5::DOUBLE), (2, 1::DOUBLE)) AS t(turn, share), (SELECT COUNT(DISTINCT contest_id) AS n FROM marked)),
samples AS (SELECT * FROM marked JOIN turns ON number < CAST(FLOOR(share * 4294967296) AS BIGINT)),
runs AS MATERIALIZED (SELECT turn || '|' || model || '|' || f AS run, turn, model, f, s.* EXCLUDE (turn)
  FROM samples s JOIN subsets USING (feature), (VALUES (0), (1)) AS folds(f)),
fitted AS (SELECT * FROM runs WHERE fold <> f), asked AS (SELECT * FROM runs WHERE fold = f),
{BAYES},
rates AS (SELECT run, AVG(CAST(winner = predicted AS INTEGER)) AS rate FROM scored GROUP BY run),
judged AS (SELECT CAST(SPLIT_PART(run, '|', 1) AS INTEGER) AS round, SPLIT_PART(run, '|', 2) AS model, AVG(rate) AS accuracy FROM rates GROUP BY ALL),
first_ AS (SELECT *, ROW_NUMBER() OVER (ORDER BY accuracy DESC, model) <= 2 AS kept FROM judged WHERE round = 1),
second_ AS (SELECT *, ROW_NUMBER() OVER (ORDER BY accuracy DESC, model) <= 1 AS kept FROM judged
            WHERE round = 2 AND model IN (SELECT model FROM first_ WHERE kept)),
both_ AS (SELECT * FROM first_ UNION ALL SELECT * FROM second_)
SELECT round, (SELECT COUNT(DISTINCT contest_id) FROM samples WHERE turn = round) AS rows, model, ROUND(accuracy, 9) AS accuracy, kept,
  CAST(CASE WHEN round = 2 THEN ROW_NUMBER() OVER (PARTITION BY round ORDER BY accuracy DESC, model)
       WHEN NOT kept THEN 2 + ROW_NUMBER() OVER (PARTITION BY round, kept ORDER BY accuracy DESC, model) END AS INTEGER) AS rank
FROM both_""")
def _bayes_leaderboard(spark, sf_dir):
    """Every round of a search over models with a closed form, and the place of those that ended with it."""
    train, _ = _halves(spark, sf_dir)
    candidates = {name: GaussianBayes(featuresCols=own) for name, own in SUBSETS.items()}
    found = modelling.search_models(train, "winner", FEATURES, "contest_id", candidates=candidates, folds=2)
    ended = found.leaderboard.select("model", "round", "rank")
    return found.rounds.join(ended, ["model", "round"], "left").select(
        "round", "rows", "model", F.round("accuracy", 9).alias("accuracy"), "kept", "rank")


@query("perceptron", f"WITH {HALVES} SELECT contest_id, winner, TRUE AS predicted_known FROM halves WHERE NOT is_train")
def _perceptron(spark, sf_dir):
    train, test = _halves(spark, sf_dir)
    indexed, labels = modelling.label_index(train, "winner")
    model = modelling.pipeline(modelling.perceptron(len(FEATURES), len(labels)), FEATURES).fit(indexed)
    return modelling.score(model, test, labels).select("contest_id", "winner", _known(labels))


@query("score", f"WITH {HALVES} SELECT contest_id, winner, TRUE AS predicted_known FROM halves WHERE NOT is_train")
def _score(spark, sf_dir):
    train, test = _halves(spark, sf_dir)
    model, labels = _logistic(train)
    return modelling.score(model, test, labels).select("contest_id", "winner", _known(labels))


@query("score_probabilities", f"""WITH {HALVES} SELECT contest_id, day, home, away, winner, TRUE AS predicted_known,
    TRUE AS sums_to_one, TRUE AS highest_is_predicted FROM halves WHERE is_train""")
def _probabilities(spark, sf_dir):
    train, _ = _halves(spark, sf_dir)
    model, labels = _logistic(train)
    shares = [F.col(v.lower()) for v in labels]
    own = F.element_at(F.create_map(*[x for v in labels for x in (F.lit(v), F.col(v.lower()))]), F.col("predicted"))
    scored = modelling.score(model, train, labels, probabilities=True).select(
        "contest_id", _known(labels), (F.abs(sum(shares) - 1) < 1e-9).alias("sums_to_one"),
        (own == F.greatest(*shares)).alias("highest_is_predicted"))
    games = views.ledger(spark, sf_dir).select("contest_id", "day", "home", "away", "winner")
    return games.join(scored, "contest_id")


@query("lineup_model", f"""WITH {views.LINEUP}, {views.windows_sql(2, 1992, 1998, 2)},
feats AS (
  SELECT DISTINCT l.contest_id, l.team FROM lineup l JOIN windows w ON w.player = l.player AND w.window_end = l.season
  WHERE l.is_starting = 1),
rows AS (
  SELECT g.contest_id, g.winner FROM ledger g JOIN feats h ON h.contest_id = g.contest_id AND h.team = g.home
  JOIN feats a ON a.contest_id = g.contest_id AND a.team = g.away WHERE g.winner IS NOT NULL),
halves AS (SELECT *, ROW_NUMBER() OVER (ORDER BY MD5('456|' || contest_id), contest_id)
             <= CAST(ROUND_EVEN(COUNT(*) OVER () * 0.9, 0) AS BIGINT) AS is_train FROM rows)
SELECT contest_id, winner, TRUE AS predicted_known FROM halves WHERE NOT is_train""")
def _lineup_model(spark, sf_dir):
    """A model over the line-ups of both sides and a text column, the day of the week."""
    summary = squads.player_summary(views.player_season(spark, sf_dir), {"pl": "A", "cl": "N"})
    windows = squads.player_windows(summary, 2, 1992, 1998, observed=views.player_season(spark, sf_dir))
    games = views.ledger(spark, sf_dir).filter(F.col("winner").isNotNull()).withColumn("weekday", F.date_format("day", "E"))
    table = squads.match_model_table(games, squads.lineup_features(views.lineup(spark, sf_dir), windows), keep=("contest_id", "winner", "weekday"))
    rows = modelling.split_exact(pinned(fill_missing(table)), 0.9, "contest_id", 456)
    train, test = rows.filter("is_train"), rows.filter("NOT is_train")
    indexed, labels = modelling.label_index(train, "winner")
    features = [c for c in table.columns if c not in ("contest_id", "winner")]
    plan = modelling.pipeline(LogisticRegression(featuresCol="scaled", labelCol="label", maxIter=20), features, train)
    return modelling.score(plan.fit(indexed), test, labels).select("contest_id", "winner", _known(labels))
