"""The batch jobs: merge, clean, features, exploration, statistics, models, clusters.

Each job takes DataFrames and returns DataFrames. A unique integer column, `row_key` by
default, is carried along where the input has one; splits and quantile
buckets need it. Jobs that read their input many times should be given a
stored table (`sources.write_table`, Parquet), not a long lazy chain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline import schema
from stopline.functions import calendar, geo, text
from stopline.models import bagging, cluster, encode, evaluate, grove, linear, trees
from stopline.models import lasso as lasso_models
from stopline.operators import cleaning, joins, quality, selection, stats
from stopline.session import discard_at_exit, new_path, store
from stopline.sources import tables

KEY = "row_key"


# ---- merge, clean, features ----

def merge_weather(stops: DataFrame, weather: DataFrame) -> DataFrame:
    """Stops joined to the weather of their nearest hour."""
    hourly = cleaning.drop_columns(weather, ["location", "resolved_address"]).withColumn(
        "date_time", calendar.parse_timestamp(F.col("date_time"), "MM/dd/yyyy HH:mm"))
    hourly = hourly.fillna(0, subset=schema.WEATHER_NUMBERS)
    timed = cleaning.unite_datetime(
        tables.drop_index(stops), "date_of_stop", "time_of_stop", "date_time")
    return joins.join_nearest_hour(timed, hourly, "date_time")


def repair_weather(df: DataFrame) -> DataFrame:
    """Zero heat index, and zero wind chill in warm air, mean "not measured"."""
    return cleaning.null_if(cleaning.null_if(df, ["heat_index"]), ["wind_chill"],
                            when=F.col("temperature") > 40)


def clean(merged: DataFrame, key: str = KEY) -> DataFrame:
    """Typed, filtered and repaired stops in the 51-column layout (and the key, if any)."""
    df = cleaning.drop_columns(merged, ["x", "agency", "geolocation"])
    df = repair_weather(cleaning.cast_types(df, {"year": "int"}))
    df = cleaning.require_columns(df, ["violation_type", "fatal", "personal_injury"])
    df = cleaning.require_columns(df, ["model", "driver_city"])
    df = cleaning.filter_lat_range(df, "latitude")
    df = cleaning.filter_lon_range(df, "longitude")
    df = cleaning.derive_equals(df, "search_outcome", "Arrest", "arrest")
    df = cleaning.drop_columns(df, ["search_outcome", "search_reason_for_stop"])
    df = cleaning.rename_columns(
        df, {"search_arrest_reason": "arrest_reason", "arrest_type": "asset_type"})
    df = cleaning.filter_in_list(df, "state", schema.STATE_CODES)
    df = cleaning.filter_contradictions(df, "state", "dl_state")
    df = cleaning.filter_year_by_type(df, "year", "vehicle_type")
    df = cleaning.filter_year_range(df, "year")
    df = cleaning.filter_in_list(df, "driver_state", schema.STATE_CODES)
    df = cleaning.filter_in_list(df, "dl_state", schema.STATE_CODES)
    df = cleaning.fill(df, {"search_conducted": "No", "article": "Safety Violation"})
    df = cleaning.pedestrian_overwrite(df)
    keep = [*schema.CLEAN_COLUMNS, *([key] if key in df.columns else [])]
    return cleaning.reorder_columns(df, keep)


def features(cleaned: DataFrame) -> DataFrame:
    """Road flags and the short charge code."""
    return repair_weather(cleaned).withColumns({
        "highway": text.highway_flag(F.col("location")),
        "major_road": text.major_road_flag(F.col("location")),
        "short_charge": text.extract_code(F.col("charge")),
    })


# ---- exploration and statistics ----

def exploration_frame(df: DataFrame) -> DataFrame:
    """Two-class stops with geohash, region, repeat, weekday and hour columns."""
    df = cleaning.drop_columns(df, ["commercial_license"]).withColumn(
        "geohash", geo.geohash(F.col("latitude"), F.col("longitude")))
    df = cleaning.filter_response(df, "violation_type").withColumns({
        "veh_state_group": text.region_flag(F.col("state")),
        "dl_state_group": text.region_flag(F.col("dl_state")),
    })
    return calendar.calendar_parts(joins.repeat_flag(df, "seq_id"), "date_time")


def explore(frame: DataFrame, key: str = KEY) -> dict[str, DataFrame]:
    """Rate tables by calendar part, factor and weather bucket, and histogram counts."""
    response, positive = "violation_type", "Citation"
    ts = F.col("date_time")
    span = selection.extents(frame, ["temperature", "precipitation", "wind_speed", "year"])
    rain = frame.where("precipitation != 0")
    out = {
        "dow": stats.rate_by(frame, calendar.day_name(ts), response),
        "dom": stats.rate_by(frame, calendar.day_of_month(ts), response),
        "hour": stats.rate_by(frame, calendar.hour_text(ts), response),
        "factors": stats.rate_by_all(frame, schema.RATE_FACTORS, response, positive),
        "temperature_hist": stats.histogram(
            frame, "temperature", response, width=5.0, span=span["temperature"]),
        "precipitation_hist": stats.histogram(rain, "precipitation", response, bins=10),
        "wind_hist": stats.histogram(
            frame, "wind_speed", response, bins=10, span=span["wind_speed"]),
        "year_hist": stats.histogram(frame, "year", response, bins=50, span=span["year"]),
    }
    if key in frame.columns:
        for col, k in (("temperature", 10), ("precipitation", 5), ("wind_speed", 10)):
            out[f"{col}_buckets"] = stats.rate_by_quantile(
                frame, col, key, k, response, positive, span=span[col])
    return out


LEVEL_LISTS = ("sub_agency", "conditions", "accident", "personal_injury", "property_damage",
               "fatal", "alcohol", "search_conducted", "race", "gender", "arrest_reason")
FREQUENCY_LISTS = ("search_disposition", "search_type", "state", "driver_city")
TOP_LISTS = ("description", "location", "search_reason", "color", "vehicle_type")
RACE_LISTS = ("location", "description", "search_disposition", "search_reason")
WEATHER_SUMMARY = ("temperature", "wind_chill", "heat_index", "precipitation", "snow_depth", "wind_speed",
                   "cloud_cover")


def descriptive(df: DataFrame, k: int = 5, nested_k: int = 3) -> dict[str, DataFrame]:
    """Time extent, level counts, numeric summaries and the top-k lists.

    One stored cube of level counts, from one scan, gives all lists; the extent is one scan,
    the quartiles are a few scans common to all columns.
    """
    def is_yes(c: str):
        return F.col(c) == "Yes"

    flags = {c: is_yes(c) for c in ("accident", "personal_injury", "property_damage", "fatal",
                                    "alcohol", "search_conducted")}
    flags["arrest"] = F.col("arrest")
    flags["arrest_reason=Stop"] = F.col("arrest_reason") == "Stop"
    flags["gender=F"] = F.col("gender") == "F"
    cols = sorted({*LEVEL_LISTS, *FREQUENCY_LISTS, *TOP_LISTS, *RACE_LISTS, "arrest"})
    cube = store(stats.level_cube(
        df, cols, flags, ["location", "description", "sub_agency"], "race", RACE_LISTS,
        [("location", "description")]), "cube")
    out = {"extent": stats.time_extent(df, "date_time"), "cube": cube}
    for c in LEVEL_LISTS:
        out[f"levels_{c}"] = stats.fold_levels(stats.cube_levels(cube, c))
    out["numbers"] = stats.numeric_summary(df, WEATHER_SUMMARY)
    out["arrest"] = stats.cube_levels(cube, "arrest").select(F.col("level").cast("boolean").alias("value"), "n")
    agencies = cube.where("column = 'sub_agency' and level is not null")
    for name, rows in (("top_sub_agency", agencies), ("top_injury_sub_agency", stats.cube_flags(agencies, list(flags)).where(
            "flag = 'personal_injury'"))):
        best = F.max(F.struct("n", "level"))  # the last name wins a tie
        out[name] = rows.groupBy("level").agg(F.sum("n").alias("n")).agg(best.alias("b")).select("b.level", "b.n")
    for c in FREQUENCY_LISTS:
        out[f"frequency_{c}"] = stats.cube_levels(cube, c).withColumnRenamed("level", c).orderBy(F.desc("n"), c)
    first = store(stats.cube_topk(cube.where(F.col("column").isin(*TOP_LISTS)), k), "top")
    for c in TOP_LISTS:
        out[f"top_{c}"] = first.where(F.col("column") == c).select(F.col("level").alias(c), "n").orderBy(F.desc("n"), c)
    flagged = stats.cube_topk(stats.cube_flags(
        cube.where("column in ('location', 'description')"), list(flags)), k, ["column", "flag"])
    for c in ("location", "description"):
        out[f"top_{c}_by_flag"] = flagged.where(F.col("column") == c).drop("column")
    races = stats.cube_topk(cube.where(F.col("column").isin(*RACE_LISTS)), k, ["column", "by"])
    for c in RACE_LISTS:
        out[f"top_{c}_by_race"] = races.where(F.col("column") == c).select(
            F.col("by").alias("race"), F.col("level").alias(c), "n", "rank")
    pairs = cube.where("column = 'location>description'").join(
        F.broadcast(first.where("column = 'location'").select(F.col("level").alias("outer"))), "outer")  # k rows
    out["top_description_at_top_locations"] = stats.cube_topk(pairs, nested_k, ["outer"]).select(
        F.col("outer").alias("location"), F.col("level").alias("description"), "n", "rank")
    return out


def descriptive_report(found: dict[str, DataFrame]) -> DataFrame:
    """All lists of `descriptive` as (section, level, n, value)."""
    def part(df, section, level, n="n", value=None):
        section = section if not isinstance(section, str) else F.lit(section)
        return df.select(section.alias("section"), level.cast("string").alias("level"),
                         (F.col(n) if n else F.lit(None)).cast("long").alias("n"),
                         (F.lit(None) if value is None else value).cast("double").alias("value"))

    parts = [part(found[f"top_{c}"], "top", F.col(c)) for c in TOP_LISTS]
    parts += [part(found[f"top_{c}_by_flag"], F.col("flag"), F.col("level")) for c in ("location", "description")]
    parts += [part(found[f"top_{c}_by_race"].where("race is not null"), F.col("race"), F.col(c)) for c in RACE_LISTS]
    parts += [part(found[f"levels_{c}"], c, F.col("level")) for c in LEVEL_LISTS]
    parts += [part(found[f"frequency_{c}"], f"frequency_{c}", F.col(c)) for c in FREQUENCY_LISTS]
    parts.append(part(found["arrest"], "arrest", F.col("value")))
    parts += [part(found["extent"], f"extent_{end}", F.date_format(end, "yyyy-MM-dd HH:mm:ss"), None)
              for end in ("first", "last")]
    parts += [part(found[name], name, F.col("level")) for name in ("top_sub_agency", "top_injury_sub_agency")]
    parts.append(part(found["top_description_at_top_locations"], F.concat(F.lit("at "), "location"), F.col("description")))
    cells = F.inline(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).cast("double").alias("v"))
                               for m in ("min", "q1", "median", "mean", "q3", "max", "n_null")]))
    parts.append(part(found["numbers"].select("column", cells), F.concat(F.lit("summary_"), "column"), F.col("m"), None, F.col("v")))
    return stats.union_reports(*parts)


# ---- models ----

def model_frame(frame: DataFrame, key: str = KEY) -> DataFrame:
    """Predictors and response without missing values, plus key and 0/1 label."""
    df = cleaning.drop_columns(frame, [c for c in schema.MODEL_DROP if c != key])
    short = text.shorten_code(text.shorten_code(F.col("short_charge")), r"\d\d")
    df = cleaning.complete_cases(df.withColumn("short_charge", short))
    return df.withColumn("label", text.binary_label(F.col("violation_type")))


def predictor_kinds(df: DataFrame, key: str = KEY) -> tuple[list[str], list[str]]:
    """(factors, numbers) among the predictors; the hour counts as a number."""
    skip = {key, "violation_type", "label", "fold"}
    types = {c: t for c, t in df.dtypes if c not in skip}
    numbers = [c for c, t in types.items() if t in ("double", "int", "bigint", "float")]
    return [c for c in types if c not in numbers], numbers


def _prepare(frame: DataFrame, key: str, fraction: float, dummies: bool):
    """(train, test, encoder, feature names); trees take the hour as a number.

    Both parts are filters of one encoded frame, which is stored.
    """
    if not dummies and "hour" in frame.columns:
        frame = frame.withColumn("hour", F.col("hour").cast("int"))
    cats, nums = predictor_kinds(frame, key)
    build = encode.encode if dummies else encode.index_only
    encoder = build(frame, cats, nums)
    coded = encoder.transform(encode.as_factors(frame, cats))
    names = encode.feature_names(coded) if dummies else [*cats, *nums]
    inputs = [] if dummies else [*[f"{c}_ix" for c in cats], *nums]
    slim = store(coded.select(key, "violation_type", "label", "features", *inputs), "coded")
    train, test = selection.split_exact(slim, key, fraction)
    return train, test, encoder, names


def class_names(df: DataFrame) -> DataFrame:
    """Predicted and actual class as names."""
    return df.withColumn("predicted",
                         F.when(F.col("prediction") == 1.0, "Citation").otherwise("Warning"))


def forest(frame: DataFrame, key: str = KEY, fraction: float = 0.7,
           grid: Sequence[dict] = ({"trees": 50, "mtry": 4}, {"trees": 100, "mtry": 4},
                                   {"trees": 150, "mtry": 4}, {"trees": 50, "mtry": 2},
                                   {"trees": 50, "mtry": 6}),
           max_depth: int = 20, model_path: str | None = None) -> dict:
    """Forest sweep: out-of-bag and test results of all, importances and tree measures of the first."""
    df = cleaning.drop_columns(frame, schema.WEAK_FLAGS)
    return forest_results(*_prepare(df, key, fraction, dummies=False), key, grid, max_depth, model_path)


def forest_results(train: DataFrame, test: DataFrame, encoder: PipelineModel, names: Sequence[str], key: str,
                   grid: Sequence[dict], max_depth: int, model_path: str | None = None) -> dict:
    """The tables of `forest` from prepared rows; votes, nodes and the first forest are stored."""
    spark = train.sparkSession
    bins = grove.bins_of(train.unionByName(test))
    most = max(g["trees"] for g in grid)
    mine = grove.blocks(train, key, bins, most, held=False, partner=True, carry="violation_type")
    rows = mine.unionByName(grove.blocks(test, key, bins, most, held=True, carry="violation_type"))
    first = grid[0]["trees"], grid[0]["mtry"]
    path = model_path or new_path(spark, "forest")
    sizes = {m: sorted({g["trees"] for g in grid if g["mtry"] == m}) for m in dict.fromkeys(g["mtry"] for g in grid)}

    def grow(mtry):
        def run():
            return grove.fit(mine, bins, sizes[mtry][-1], mtry, max_depth)
        return run

    def judge(mtry):
        def run():
            return grove.votes(grown[mtry], rows, key, bins, sizes[mtry][-1], sizes[mtry])
        return run

    def measure():
        grown[first[1]].where(F.col("tree") < first[0]).write.parquet(path)
        if not model_path:
            discard_at_exit(spark, path)
        best = grove.load(spark, path)
        return (grove.votes(best, mine, key, bins, first[0], [first[0]], importance=True),
                store(grove.tree_nodes(best, bins, names), "nodes"))

    grown = dict(zip(sizes, trees.in_parallel(spark, [grow(m) for m in sizes], len(sizes))))
    (local, nodes), *judged = trees.in_parallel(spark, [measure, *map(judge, sizes)], len(sizes) + 1)
    judged = dict(zip(sizes, judged))
    votes = {(g["trees"], g["mtry"]): (judged[g["mtry"]], sizes[g["mtry"]].index(g["trees"])) for g in grid}
    permuted = bagging.accuracy_importance(local, names)
    run = {g: f"{g[0]} trees, mtry {g[1]}" for g in votes}
    scored = {g: class_names(grove.predicted(v, at, "violation_type")) for g, (v, at) in votes.items()}
    out_of_bag = {g: (v.where("not held"), at) for g, (v, at) in votes.items()}
    classes = stats.union_reports(*[
        bagging.oob_class_table(v, at).select(
            F.lit(g[0]).alias("trees"), F.lit(g[1]).alias("mtry"),
            F.when(F.col("label") == 1, "Citation").otherwise("Warning").alias("violation_type"),
            F.col("votes_1").alias("citation"), F.col("votes_0").alias("warning"), "class_error")
        for g, (v, at) in out_of_bag.items()])

    def score(g):
        return lambda: (*g, bagging.oob_error(*out_of_bag[g]), trees.prediction_counts(scored[g], "label"))

    def report(g):
        return lambda: evaluate.confusion_report(spark, evaluate.confusion_counts(
            scored[g], "predicted", "violation_type", "Citation"), run[g])

    done = trees.in_parallel(spark, [f(g) for f in (score, report) for g in votes], 2 * len(votes))
    scores, confusions = done[:len(votes)], done[len(votes):]
    return {
        "scores": bagging.scores_table(spark, scores),
        "out_of_bag": classes,
        "confusion": stats.union_reports(*confusions),
        "importance": trees.rank_importance(grove.impurity_importance(spark, nodes, names)),
        "permutation": permuted,
        "local": bagging.local_importance(local, key, names),
        "nodes": nodes.drop("copies"),
        "min_depth": trees.min_depth_distribution(nodes),
        "measures": trees.forest_measures(nodes, permuted),
        "predicted": scored[first], "path": path, "rows": rows, "bins": bins,
    }


def forest_report(out: dict) -> DataFrame:
    """All result tables of a forest sweep as (section, item, metric, value); the distribution of depths is counted."""
    depths = out["min_depth"].groupBy("variable", "minimal_depth").agg(F.count(F.lit(1)).alias("trees"))
    long = evaluate.long_form
    return stats.union_reports(
        long(out["scores"], "scores", ["trees", "mtry"]),
        long(out["out_of_bag"], "out_of_bag", ["trees", "mtry", "violation_type"]),
        out["confusion"].select("section", F.col("run").alias("item"), "metric", "value"),
        long(out["importance"], "importance", ["variable"]),
        long(out["permutation"], "permutation", ["variable"]),
        long(depths, "min_depth", ["variable", "minimal_depth"]),
        long(out["measures"], "measures", ["variable"]))


def boosted(frame: DataFrame, key: str = KEY, fraction: float = 0.6,
            trees_grid: Sequence[int] = (10, 50, 100), depths: Sequence[int] = (1, 2, 3),
            shrinkages: Sequence[float] = (0.01, 0.1), folds: int = 5) -> dict:
    """Boosted trees: cross-validated grid, best model, importances and test report."""
    df = cleaning.drop_columns(frame, schema.WEAK_FLAGS)
    return boosted_results(*_prepare(df, key, fraction, dummies=False), key, trees_grid, depths, shrinkages, folds)


def boosted_results(train: DataFrame, test: DataFrame, encoder: PipelineModel, names: Sequence[str], key: str,
                    trees_grid: Sequence[int] = (10, 50, 100), depths: Sequence[int] = (1, 2, 3),
                    shrinkages: Sequence[float] = (0.01, 0.1), folds: int = 5) -> dict:
    spark = train.sparkSession
    model, best, table = trees.fit_gbt_grid(
        train, key, encode.max_levels(encoder), trees_grid, depths, shrinkages, folds=folds)
    is_best = ((F.col("shrinkage") == best[0]) & (F.col("depth") == best[1]) & (F.col("trees") == best[2]))
    counts = evaluate.confusion_counts(
        class_names(model.transform(test)), "predicted", "violation_type", "Citation")
    importance = trees.impurity_importance(spark, model, names)
    return {
        "cv": table.withColumn("best", is_best), "best": best, "model": model,
        "importance": trees.scaled_importance(importance),
        "confusion": evaluate.confusion_report(spark, counts, "boosted"),
    }


def boosted_report(out: dict) -> DataFrame:
    """All result tables of the boosted grid as (section, item, metric, value)."""
    return stats.union_reports(
        evaluate.long_form(out["cv"].withColumn("best", F.col("best").cast("int")), "cv", ["shrinkage", "depth", "trees"]),
        evaluate.long_form(out["importance"], "importance", ["variable"]),
        out["confusion"].select("section", F.col("run").alias("item"), "metric", "value"))


def lasso_frame(frame: DataFrame, drop_extra: Sequence[str] = ()) -> DataFrame:
    """The modelling frame without weak flags, rare levels and the columns dropped for the reduced fit."""
    df = cleaning.drop_columns(frame, [*schema.WEAK_FLAGS, *drop_extra])
    return cleaning.filter_not_in(df, {
        c: v for c, v in {"color": schema.RARE_COLORS, "asset_type": schema.RARE_ASSETS,
                          "short_charge": schema.RARE_CHARGES,
                          "vehicle_type": schema.RARE_VEHICLES}.items() if c in df.columns})


def lasso(frame: DataFrame, key: str = KEY, fraction: float = 0.7, n_lambda: int = 100,
          folds: int = 5, rule: str = "1se", drop_extra: Sequence[str] = (),
          ratio: float = 1e-4) -> dict:
    """Cross-validated L1 logistic path; `drop_extra` gives the reduced refit."""
    spark = frame.sparkSession
    train, test, _, names = _prepare(lasso_frame(frame, drop_extra), key, fraction, dummies=True)
    path = lasso_models.lasso_path(train, key, names, n_lambda, ratio, folds)
    chosen = lasso_models.lambda_rule(path, rule)
    coefs = lasso_models.path_coefficients(spark, path, chosen)
    every = lasso_models.path_coefficients(spark, path, chosen, nonzero=False)
    counts = evaluate.confusion_counts(
        class_names(lasso_models.predict(test, path, chosen)), "predicted", "violation_type", "Citation")
    ends = {name: linear.rank_coefficients(every, 12, largest).withColumn(
        "probability", text.inv_logit(F.round("estimate", 4)))
        for name, largest in (("largest", True), ("smallest", False))}
    return {
        "path": lasso_models.path_table(spark, path).withColumns({
            "is_min": F.col("lambda") == lasso_models.lambda_rule(path, "min"),
            "is_1se": F.col("lambda") == lasso_models.lambda_rule(path, "1se")}),
        "lambda": chosen, "model": path, "coefficients": coefs, **ends,
        "confusion": evaluate.confusion_report(spark, counts, f"lasso {rule}"),
    }


def lasso_report(out: dict) -> DataFrame:
    """All result tables of a lasso path as (section, item, metric, value)."""
    path = out["path"].withColumns({c: F.col(c).cast("int") for c in ("is_min", "is_1se")})
    return stats.union_reports(
        evaluate.long_form(path, "path", ["lambda"]),
        *[evaluate.long_form(out[t], t, ["term"]) for t in ("coefficients", "largest", "smallest")],
        out["confusion"].select("section", F.col("run").alias("item"), "metric", "value"))


def logistic(train: DataFrame, test: DataFrame, names: Sequence[str], g: linear.Gram) -> dict:
    """Plain logistic model of the second class (Warning), scored at 0.5."""
    spark = train.sparkSession
    terms = linear.independent_terms(g)
    model = linear.logistic_glm(train.withColumn("event", 1 - F.col("label")), "event",
                                terms=terms)
    scored = model.transform(test).withColumn(
        "predicted", evaluate.threshold_class(F.col("prediction")))
    coefficients, fit = linear.glm_coefficients(spark, model, names, terms), linear.glm_fit_statistics(spark, model)
    model.training_rows.unpersist()
    return {
        "model": model,
        "error": evaluate.test_error(scored, "predicted", "violation_type"),
        "table": evaluate.confusion_table(scored, "predicted", "violation_type"),
        "coefficients": coefficients, "fit": fit,
    }


def subset(frame: DataFrame, key: str = KEY, fraction: float = 0.8, trees_count: int = 50,
           mtry: int = 4, max_depth: int = 20, max_terms: int = 300, quick_look: tuple[int, int] = (128, 50),
           chosen: Sequence[str] = tuple(schema.SUBSET_FEATURES)) -> dict:
    """Full and reduced logistic and forest results, both stepwise selections, and a look at the forward one.

    `quick_look`: the size of the forward subset (or the largest below) and how many of its least coefficients.
    """
    spark = frame.sparkSession
    df = cleaning.drop_columns(frame, schema.WEAK_FLAGS)
    out, errors, confusions = {}, [], []
    reduced = df.select(key, "violation_type", "label", *[c for c in chosen if c in df.columns])
    for name, data in (("full", df), ("subset", reduced)):
        train, test, _, names = _prepare(data, key, fraction, dummies=True)
        train = train.persist()
        g = linear.gram(train, "features", "label", names)
        plain = logistic(train, test, names, g)
        errors.append(plain["error"].select(F.lit(f"logistic {name}").alias("run"), "test_error"))
        out[f"coefficients_{name}"], out[f"fit_{name}"] = plain["coefficients"], plain["fit"]
        confusions.append(plain["table"].withColumn("run", F.lit(f"logistic {name}")))
        train.unpersist()
        if name == "full":
            forward, backward = (linear.stepwise(spark, g, d, max_terms) for d in ("forward", "backward"))
            steps = stats.union_reports(forward, backward)
            out["steps"], out["sizes"] = steps, linear.selection_sizes(steps)
            terms = [r["term"] for r in forward.where(F.col("size") <= quick_look[0]).orderBy("size").collect()]
            out["smallest_forward"] = linear.rank_coefficients(
                linear.subset_coefficients(spark, g, terms), quick_look[1], largest=False)
        train, test, encoder, names = _prepare(data, key, fraction, dummies=False)
        bins = grove.bins_of(train.unionByName(test))
        grown = grove.fit(grove.blocks(train, key, bins, trees_count, held=False), bins, trees_count, mtry, max_depth)
        held = grove.blocks(test, key, bins, trees_count, held=True, carry="violation_type")
        scored = class_names(grove.predicted(
            grove.votes(grown, held, key, bins, trees_count, [trees_count]), 0, "violation_type"))
        errors.append(evaluate.test_error(scored, "predicted", "violation_type").select(
            F.lit(f"forest {name}").alias("run"), "test_error"))
        confusions.append(evaluate.confusion_table(scored, "predicted", "violation_type").withColumn(
            "run", F.lit(f"forest {name}")))
        out[f"importance_{name}"] = grove.impurity_importance(spark, grove.tree_nodes(grown, bins, names), names)
    out["errors"] = stats.union_reports(*errors)
    out["tables"] = stats.union_reports(*confusions)
    return out


def subset_report(out: dict) -> DataFrame:
    """All result tables of the subset job as (section, item, metric, value)."""
    long = evaluate.long_form
    return stats.union_reports(
        long(out["errors"], "errors", ["run"]),
        long(out["tables"], "tables", ["run", "prediction", "reference"]),
        *[long(out[f"{t}_{n}"], f"{t} {n}", [i]) for n in ("full", "subset")
          for t, i in (("coefficients", "term"), ("fit", "metric"), ("importance", "variable"))],
        long(out["steps"], "steps", ["method", "size", "term"]),
        long(out["sizes"], "sizes", ["method"]),
        long(out["smallest_forward"], "smallest_forward", ["term"]))


# ---- clusters ----

def accident_frame(df: DataFrame) -> DataFrame:
    """Accident stops with merged levels, ready for clustering."""
    df = calendar.calendar_parts(df, "date_time").withColumns({
        "vehicle_type": text.combine_levels(text.combine_levels(
            F.col("vehicle_type"), schema.CAR_TYPES, "Cars"), schema.NON_CAR_TYPES, "Non-Cars"),
        "color": text.combine_levels(text.combine_levels(
            F.col("color"), schema.NEUTRAL_COLORS, "Neutral_Color"),
            schema.OTHER_COLORS, "NonNeutral_Color"),
        "conditions": text.combine_levels(
            F.col("conditions"), schema.CLOUDED_CONDITIONS, "Not_Clear"),
        "race": text.combine_levels(F.col("race"), schema.MERGED_RACES, "Other"),
    })
    df = df.where(F.col("gender").isin("F", "M") & (F.col("accident") == "Yes"))
    df = df.select(
        "seq_id", "maximum_temperature", "minimum_temperature", "precipitation", "snow_depth",
        "wind_speed", "cloud_cover", "relative_humidity", "conditions", "belts",
        "personal_injury", "property_damage", "alcohol", "work_zone", "vehicle_type", "year",
        "color", "race", "gender", "highway", "dow", "hour",
        text.region_flag(F.col("state")).alias("veh_state_group"),
        text.region_flag(F.col("dl_state")).alias("dl_state_group"),
        *([KEY] if KEY in df.columns else []))
    df = cleaning.complete_cases(df)
    return df.withColumns({
        "year": calendar.decade_label(F.col("year")),
        "highway": text.yes_no(F.col("highway")),
        "hour": calendar.hour_band(F.col("hour")),
        "dow": calendar.weekpart(F.col("dow")),
        "belts": text.map_levels(F.col("belts"), {"No": "BeltsNo", "Yes": "BeltsYes"}),
        "alcohol": text.map_levels(F.col("alcohol"), {"No": "AlcoholNo", "Yes": "AlcoholYes"}),
        "personal_injury": text.map_levels(
            F.col("personal_injury"), {"No": "PersInjuryNo", "Yes": "PersInjuryYes"}),
        "gender": text.map_levels(F.col("gender"), {"F": "Female", "M": "Male"}),
    })


def clusters(df: DataFrame, k: int = 5,
             cols: Sequence[str] = tuple(schema.CLUSTER_COLUMNS)) -> dict[str, DataFrame]:
    """Clusters of the accident frame by k-modes, and their profiles.

    The rows are read once to count the distinct profiles, and once more only
    if the labelled rows are asked for.
    """
    profiles = cluster.distinct_profiles(df, cols)
    modes = cluster.k_modes(profiles, cols, k)
    labelled = cluster.assign(profiles, cols, modes)
    return {
        "profiles": labelled, "rows": cluster.assign(df, cols, modes),
        "sizes": stats.cluster_sizes(labelled, "cluster", "weight"),
        "heat": stats.cluster_profile(
            stats.profile_level_counts(labelled, "weight", "cluster", cols), "cluster"),
        "shares": stats.level_share_by_cluster(
            labelled, "cluster", cols, range(1, k + 1), digits=2, weight="weight"),
    }


def score(df: DataFrame) -> DataFrame:
    """Percent of missing or wrong cells, as taken before and after cleaning."""
    return quality.score_stops(df)
