"""Occupation scores: targets, presence, ability exposure, task exposure, and score sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import clip01, mean_of_present, number, weighted_mean

# Titles that count as public sector.
PUBLIC_SECTOR_TITLES = (
    "Judges, Magistrate Judges, and Magistrates",
    "Administrative Law Judges, Adjudicators, and Hearing Officers",
    "Judicial Law Clerks",
    "Coroners",
    "Bailiffs",
    "Probation Officers and Correctional Treatment Specialists",
    "Court, Municipal, and License Clerks",
    "Tax Examiners and Collectors, and Revenue Agents",
    "First-Line Supervisors of Police and Detectives",
    "Detectives and Criminal Investigators",
    "Police Identification and Records Officers",
    "Intelligence Analysts",
    "Fish and Game Wardens",
    "Parking Enforcement Workers",
    "Police and Sheriff's Patrol Officers",
    "Customs and Border Protection Officers",
    "Transit and Railroad Police",
    "Transportation Security Screeners",
    "Emergency Management Directors",
    "First-Line Supervisors of Firefighting and Prevention Workers",
    "Firefighters",
    "Fire Inspectors and Investigators",
    "Forest Fire Inspectors and Prevention Specialists",
    "Public Safety Telecommunicators",
    "First-Line Supervisors of Correctional Officers",
    "Correctional Officers and Jailers",
    "Postmasters and Mail Superintendents",
    "Postal Service Clerks",
    "Postal Service Mail Carriers",
    "Postal Service Mail Sorters, Processors, and Processing Machine Operators",
    "Eligibility Interviewers, Government Programs",
    "Government Property Inspectors and Investigators",
    "Air Traffic Controllers",
)

# Element ids of each dimension, by source table.
PRESENCE_ELEMENTS = {
    "physical": {
        "work_context": ("4.C.2.a.3", "4.C.1.a.2.l", "4.C.1.a.4", "4.C.2.d.1.b", "4.C.2.d.1.g", "4.C.2.d.1.h", "4.C.2.d.1.f", "4.C.2.d.1.d", "4.C.2.d.1.i", "4.C.2.d.1.e", "4.C.1.b.1.e", "4.C.2.c.1.b", "4.C.2.a.1.c", "4.C.1.a.2.c", "4.C.2.e.1.d"),
        "gwas": ("4.A.3.a.1", "4.A.4.a.8", "4.A.3.a.2", "4.A.3.a.4", "4.A.1.b.2", "4.A.3.a.3"),
        "skills": ("2.B.1.b",),
    },
    "emotional": {
        "work_context": ("4.C.1.d.2", "4.C.1.d.1", "4.C.1.d.3", "4.C.1.b.1.f", "4.C.1.c.1", "4.C.1.c.2", "4.C.3.a.1", "4.C.3.a.2.a", "4.C.1.b.1.g", "4.C.3.d.1"),
        "gwas": ("4.A.4.a.5", "4.A.4.a.7", "4.A.4.a.4", "4.A.4.b.5", "4.A.4.b.4", "4.A.4.b.3", "4.A.4.b.6", "4.A.4.a.1", "4.A.4.b.2", "4.A.4.a.3", "4.A.4.a.6", "4.A.4.a.2"),
        "skills": ("2.B.1.a", "2.B.1.f", "2.B.1.d", "2.A.1.b", "2.A.1.d", "2.B.1.c", "2.B.1.e", "2.B.4.e"),
    },
    "creative": {
        "work_context": ("4.C.3.a.4", "4.C.3.b.8", "4.C.3.c.1"),
        "gwas": ("4.A.2.b.2",),
        "skills": ("2.A.1.c",),
    },
}

# Progress of each application in each scenario.
APPLICATIONS = ("abstract_strategy_games", "realtime_video_games", "image_recognition", "visual_question_answering", "image_generation", "reading_comprehension", "language_modeling", "translation", "speech_recognition", "instrumental_track_recognition")
PROGRESS = {
    "felten_original": (1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
    "baseline_2025": (1.0, 1.3, 1.1, 1.5, 1.5, 1.4, 1.5, 1.3, 1.1, 1.2),
    "conservative_2025": (0.90, 0.50, 0.82, 0.72, 0.78, 0.82, 0.88, 0.78, 0.88, 0.60),
    "genai_only": (0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 1.0, 0.0, 0.0, 0.0),
}


def element_table(spark: SparkSession, elements=PRESENCE_ELEMENTS) -> DataFrame:
    """(dimension, source, element_id)."""
    return spark.createDataFrame([(d, s, e) for d, sources in elements.items() for s, ids in sources.items() for e in ids], "dimension string, source string, element_id string")


def top_per_group(df: DataFrame, key: str, by: str, tie: str, n: int) -> DataFrame:
    """The n rows of each key that are largest by `by`, nulls last, ties by `tie`; with rn from 1."""
    order = Window.partitionBy(key).orderBy(F.desc_nulls_last(by), F.col(tie))
    return df.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= n)


def ordered_list(value: str, *order: str):
    """Aggregate: the values of a group as a list in the order given."""
    names = [f"o{i}" for i in range(len(order))]
    structs = F.collect_list(F.struct(*[F.col(c).alias(n) for c, n in zip(order, names, strict=True)], F.col(value).alias("v")))
    return F.transform(F.array_sort(structs), lambda x: x["v"])


def targets(occupations: DataFrame, tasks: DataFrame, ratings: DataFrame, titles: DataFrame, top_n: int = 10, leave_out=PUBLIC_SECTOR_TITLES) -> DataFrame:
    """(onet_code, title, description, top_tasks, alternate_titles) of occupations that have tasks.

    tasks: (onet_code, task_id, task); ratings: (onet_code, task_id, scale, value) with value as text; titles:
    (onet_code, alternate_title). leave_out: titles to leave out, none if empty.
    """
    rated = ratings.filter(F.col("scale") == "IM").withColumn("value", F.expr("try_cast(value as double)")).join(tasks, ["onet_code", "task_id"])
    best = top_per_group(rated, "onet_code", "value", "task_id", top_n).groupBy("onet_code").agg(ordered_list("task", "rn").alias("top_tasks"))
    also = titles.groupBy("onet_code").agg(ordered_list("alternate_title", "alternate_title").alias("alternate_titles"))
    out = occupations.join(best, "onet_code").join(also, "onet_code", "left")
    out = out.withColumn("alternate_titles", F.coalesce("alternate_titles", F.array().cast("array<string>"))).filter(F.size("top_tasks") > 0)
    return out.filter(~F.trim("title").isin(*leave_out)) if leave_out else out


def presence(ratings: DataFrame, elements: DataFrame, codes: DataFrame) -> DataFrame:
    """(onet_code, presence_<dimension>..., presence_composite) for all codes.

    ratings: (source, onet_code, element_id, scale, value). Importance and context are (x - 1) / 4, level is x / 7, all
    limited to [0, 1]; an element of two scales is half their sum, with a missing level as 0; a source is the mean of
    its elements, a dimension that of the sources there are, the composite that of the dimensions there are.
    """
    names = [r[0] for r in elements.select("dimension").distinct().orderBy("dimension").collect()]
    r = ratings.join(elements, ["source", "element_id"]).withColumn("value", number(F.col("value")))
    scaled = clip01(F.when(F.col("scale") == "LV", F.col("value") / 7).otherwise((F.col("value") - 1) / 4))
    r = r.withColumn("x", scaled)
    of = lambda scale: F.when(F.col("scale") == scale, F.col("x"))
    element = r.filter(F.when(F.col("source") == "work_context", F.col("scale") == "CX").otherwise(F.col("scale").isin("IM", "LV")))
    element = element.groupBy("dimension", "source", "onet_code", "element_id").agg(F.count_if(F.col("scale") == "IM").alias("n"), F.avg(of("IM")).alias("im"), F.avg(of("LV")).alias("lv"), F.sum(of("CX")).alias("cx"), F.count(of("CX")).alias("n_cx"))
    two = F.avg(F.when(F.col("n") > 0, (F.col("im") + F.coalesce("lv", F.lit(0.0))) / 2))
    score = F.when(F.col("source") == "work_context", F.try_divide(F.sum("cx"), F.sum("n_cx"))).otherwise(two)
    of_source = element.groupBy("dimension", "source", "onet_code").agg(score.alias("score"))
    wide = of_source.groupBy("onet_code").agg(*[F.avg(F.when(F.col("dimension") == d, F.col("score"))).alias(f"presence_{d}") for d in names])
    return codes.join(wide, "onet_code", "left").withColumn("presence_composite", mean_of_present(*[F.col(f"presence_{d}") for d in names]))


def ability_exposure(matrix: DataFrame, progress: DataFrame) -> DataFrame:
    """(ability, exposure): the mean of an ability's relations to applications, by progress, over applications with any.

    matrix: (ability, application, relation); progress: (application, progress).
    """
    used = progress.filter(F.col("progress") > 0)
    return matrix.join(used, "application").groupBy("ability").agg((F.sum(F.col("relation") * F.col("progress")) / F.sum("progress")).alias("exposure"))


def felten(abilities: DataFrame, exposure: DataFrame, alpha: float = 0.5) -> DataFrame:
    """(onet_code, felten_score): exposure of abilities weighted by importance / 5 and level / 7.

    abilities: (onet_code, ability, scale, value, pos); the first value by pos counts. An occupation needs a row of
    either scale, an ability must be known to both scales, and a rating that is missing weighs 0. A score without any
    weight is null.
    """
    a = abilities.filter(F.col("value").isNotNull() & F.col("scale").isin("IM", "LV"))
    first = a.groupBy("onet_code", "ability", "scale").agg(F.min_by("value", "pos").alias("value"))
    both = first.groupBy("ability").agg(F.count_distinct("scale").alias("n")).filter("n = 2").select("ability")
    codes = a.groupBy("onet_code").agg(F.count_distinct("scale").alias("n")).filter("n = 2").select("onet_code")
    part = lambda scale, top: F.coalesce(clip01(F.max(F.when(F.col("scale") == scale, F.col("value"))) / top), F.lit(0.0))
    w = first.join(both, "ability").join(codes, "onet_code").groupBy("onet_code", "ability").agg((alpha * part("IM", 5.0) + (1 - alpha) * part("LV", 7.0)).alias("w"))
    score = F.try_divide(F.sum(F.col("w") * F.col("exposure")), F.sum("w"))
    return w.join(exposure, "ability").groupBy("onet_code").agg(clip01(score).alias("felten_score"))


def task_exposure(labels: DataFrame) -> DataFrame:
    """Per occupation: mean and importance-weighted exposure of labels 0, 1, 2 scaled to [0, 1], counts and shares of levels.

    labels: (onet_code, exposure, task_importance, confidence). Weights that sum to zero: the plain mean.
    """
    x = F.col("exposure").cast("double")
    share = lambda k: (100.0 * F.count_if(F.col("exposure") == k) / F.count(F.lit(1))).alias(f"pct_{k}")
    return labels.groupBy("onet_code").agg(
        clip01(F.avg(x) / 2).alias("task_exposure_mean"), clip01(weighted_mean(x, F.coalesce(F.col("task_importance"), F.lit(0.0))) / 2).alias("task_exposure_weighted"), F.avg("confidence").alias("confidence"),
        *[F.count_if(F.col("exposure") == k).alias(f"n_{k}") for k in (0, 1, 2)], *[share(k) for k in (0, 1, 2)], (F.count_if(F.col("exposure") >= 1) / F.count(F.lit(1))).alias("binary_exposure"),
    )


def same_codes(tables: dict[str, DataFrame], key: str = "onet_code") -> None:
    """Raise ValueError, with counts, unless all tables have the same keys."""
    names = sorted(tables)
    base = tables[names[0]].select(key).distinct()
    for n in names[1:]:
        other = tables[n].select(key).distinct()
        missing, extra = base.join(other, key, "left_anti").count(), other.join(base, key, "left_anti").count()
        if missing or extra:
            raise ValueError(f"{n}: {missing} keys of {names[0]} are missing, {extra} are not in it")


def combine(tables: dict[str, DataFrame], key: str = "onet_code") -> DataFrame:
    """All score tables in one, in the order of their names; they must have the same keys."""
    same_codes(tables, key)
    return reduce(lambda a, b: a.join(b, key), (tables[n] for n in sorted(tables)))


def violations(scores: DataFrame, key: str = "onet_code", slack: float = 0.001) -> DataFrame:
    """One row: rows, keys that are null, keys given more than once, and per score column nulls or NaN and values out of range."""
    names = [c for c in scores.columns if c != key]
    out = [F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(key).isNull()).alias("null_keys"), (F.count(key) - F.count_distinct(key)).alias("repeated_keys")]
    for c in names:
        x = F.col(c).cast("double")
        out += [F.count_if(x.isNull() | F.isnan(x)).alias(f"missing_{c}"), F.count_if((x < -slack) | (x > 1 + slack)).alias(f"outside_{c}")]
    return scores.agg(*out)


def check_scores(scores: DataFrame, key: str = "onet_code") -> DataFrame:
    """scores, or ValueError if it breaks a rule of score sets."""
    if key not in scores.columns or len(scores.columns) < 2:
        raise ValueError(f"a score set has {key} and at least one score")
    bad = {k: v for k, v in violations(scores, key).first().asDict().items() if k != "n_rows" and v}
    if bad:
        raise ValueError(f"not a score set: {bad}")
    return scores
