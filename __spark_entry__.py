"""

``entry(spark)`` runs the flagship product (the wide session report) on
sf0.001. ``queries()`` maps every product and operator to a callable
``(spark, sf_dir) -> DataFrame``; each reads the driver's flat tables, builds
the bundle fixture from them with Spark, and runs the product over the whole
of it. ``oracle_sql()`` gives, per key, DuckDB SQL computing the same answer
from the flat tables directly (see ``equilibra.oracle``).

Standard deviation columns are rounded to 6 places here and in the SQL, so
that summation order does not decide equality.
"""

from __future__ import annotations

import importlib.util
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra import oracle
from equilibra.operators import flatten_nested, observations, sample_rows, timed_samples
from equilibra.operators.rejects import quarantine
from equilibra.operators.shred import flat, shred, sizes, write_shredded
from equilibra.oracle import STD_DIGITS
from equilibra.plans import PRODUCTS, SYMPTOM_KEYS
from equilibra.plans.families import FAMILIES, publish_products
from equilibra.plans.movement import movement_statistics
from equilibra.plans.refresh import refresh, stored_product
from equilibra.plans.scores import score_session_mean, score_session_sum, score_statistics, score_weekly_mean, score_weekly_sum
from equilibra.plans.symptoms import symptom_reported, symptom_statistics, symptom_weekly_sum
from equilibra.session import shared_dir
from equilibra.sources import FLAG_FIELDS, build_index, event_bundle, hard_bundle, load_bundle, publish, publish_version, read_published, read_version, session_bundle, write_clustered

SMOKE_DIR = "/root/testdata/sf0.001"
ALL_CODES = [
    *C.SYMPTOMS,
    C.RANGE_OF_MOVEMENT,
    C.SPEED_OF_MOVEMENT,
    C.SESSION_SCORE,
    C.DURATION,
    C.REPETITIONS,
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def session_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_bundle(_table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem"))


def event_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_bundle(_table(spark, sf_dir, "events"))


def _rounded(df: DataFrame) -> DataFrame:
    """Round standard-deviation columns for comparison."""
    return df.select(
        *[F.round(c, STD_DIGITS).alias(c) if ("STD" in c) else F.col(f"`{c}`") for c in df.columns]
    )


def _product(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(PRODUCTS[name](session_bundles(spark, sf_dir)))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the wide per-session report on sf0.001."""
    return _product("session_report", spark, SMOKE_DIR)


def _flatten_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_nested(session_bundles(spark, sf_dir))


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(session_bundles(spark, sf_dir), ALL_CODES)


def _samples(code: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rows(session_bundles(spark, sf_dir), code)


def _samples_timed(code: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_samples(session_bundles(spark, sf_dir), code)


def _statistics(fn: Callable[[DataFrame], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(fn(session_bundles(spark, sf_dir)))


def _load_bundle_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save the bundles as a table, read it by name without sample text, run a product."""
    name = f"bundles_{uuid.uuid4().hex}"
    session_bundles(spark, sf_dir).write.option("path", f"{shared_dir(spark)}/tables/{name}").saveAsTable(name)
    bundles = load_bundle(spark, name, fields=FLAG_FIELDS)
    spark.sql(f"DROP TABLE {name}")  # its files stay: the path is our own
    return PRODUCTS["vision_weekly_sum"](bundles)


def _publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a product with the sink and read it back."""
    df = PRODUCTS["disorientation_weekly_sum"](session_bundles(spark, sf_dir))
    name = f"disorientation_weekly_sum_{uuid.uuid4().hex}"
    publish(df, name)
    return read_published(spark, name)


def hard_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_bundle(_table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem"))


def _hard(fn: Callable[[DataFrame], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product of the hard fixture, whose values aren't whole: measures are rounded for comparison."""
    df = fn(hard_bundles(spark, sf_dir))
    return df.select(*[F.round(F.col(f"`{c}`").cast("double"), STD_DIGITS).alias(c) if t in ("double", "float") else F.col(f"`{c}`") for c, t in df.dtypes])


def _own_dir(spark: SparkSession, name: str) -> str:
    """A new folder of one run under the shared one."""
    return f"{shared_dir(spark)}/runs/{name}-{uuid.uuid4().hex}"


def _skipped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the event bundles by their codes, index them, read only files with the code."""
    folder = _own_dir(spark, "skipping")
    source = write_clustered(event_bundles(spark, sf_dir), f"{folder}/bundles", 16)
    index = build_index(spark, source, f"{folder}/index")
    return symptom_weekly_sum(load_bundle(spark, source, fields=FLAG_FIELDS, index=index, codes=[C.DISORIENTATION]), C.DISORIENTATION)


def _refreshed(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold the hard bundles into stored state in three parts, each repeating some of the one
    before and holding late dates, and make a product of the state."""
    folder = _own_dir(spark, "refresh")
    hard_bundles(spark, sf_dir).withColumn("of", F.pmod(F.xxhash64("entry"), F.lit(4))).write.parquet(f"{folder}/bundles")
    bundles = spark.read.parquet(f"{folder}/bundles")
    for some in ("of < 2", "of in (1, 2)", "of >= 2"):
        refresh(bundles.filter(some).drop("of"), folder, grain="yyyy")
    df = stored_product(spark, name, folder)
    return df.select(*[F.round(c, STD_DIGITS).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


def _rejected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(hard_bundles(spark, sf_dir), [C.RANGE_OF_MOVEMENT, C.SPEED_OF_MOVEMENT])


def _family(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish all products of a family from its shared frame; one of them as read back."""
    folder = _own_dir(spark, "families")
    family = next(f for f in FAMILIES.values() if name in f.products)
    publish_products(hard_bundles(spark, sf_dir), family.products, root=folder)
    df = read_version(spark, name, root=folder)
    return df.select(*[F.round(F.col(f"`{c}`").cast("double"), STD_DIGITS).alias(c) if t in ("double", "float") else F.col(f"`{c}`") for c, t in df.dtypes])


def _published_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish a report with wrong values in some years, then replace those years alone."""
    folder, year = _own_dir(spark, "versions"), F.year(C.DATE)
    PRODUCTS["headache_reported"](session_bundles(spark, sf_dir)).write.parquet(f"{folder}/right")
    right = spark.read.parquet(f"{folder}/right")  # the bundles are built once for both versions
    publish_version(right.withColumn("Headache", F.when(year % 2 == 0, "?").otherwise(F.col("Headache"))), "report", root=folder, by=year)
    publish_version(right.filter(year % 2 == 0), "report", root=folder, by=year)
    return read_version(spark, "report", root=folder)


def _shredded(spark: SparkSession, sf_dir: str) -> dict:
    folder = _own_dir(spark, "shredding")
    return write_shredded(shred(session_bundles(spark, sf_dir), f"{folder}/numbered"), f"{folder}/tables")


def _shred_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store one table per array, join them all: the rows of the generic flatten."""
    return flat(_shredded(spark, sf_dir))


def _shredded_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sizes(spark, _shredded(spark, sf_dir))


#: Products of the hard fixture.
HARD = {
    "hard_vision_weekly_sum": PRODUCTS["vision_weekly_sum"],
    "hard_dizziness_reported": PRODUCTS["dizziness_reported"],
    "hard_score_session_sum": PRODUCTS["score_session_sum"],
    "hard_score_weekly_mean": PRODUCTS["score_weekly_mean"],
    "hard_range_mean": PRODUCTS["range_mean"],
    "hard_range_std": PRODUCTS["range_std"],
    "hard_speed_std": PRODUCTS["speed_std"],
    "hard_segment_mean_speed": PRODUCTS["segment_mean_speed"],
    "hard_segment_std_range": PRODUCTS["segment_std_range"],
    "hard_session_report": PRODUCTS["session_report"],
    "year_vision_weekly_sum": partial(symptom_weekly_sum, code=C.ABNORMAL_VISION, with_year=True),
    "year_score_weekly_sum": partial(score_weekly_sum, with_year=True),
    "year_speed_std": partial(PRODUCTS["speed_std"], with_year=True),
}
#: One product of each family that is published from its shared frame.
PUBLISHED = ("dizziness_reported", "score_weekly_mean", "range_std", "segment_mean_speed")
REFRESHED = ("range_std", "speed_weekly_mean", "vision_weekly_sum", "score_weekly_sum")


def _events(fn: Callable[[DataFrame], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn(event_bundles(spark, sf_dir))


def _events_rounded(fn: Callable[[DataFrame], DataFrame], name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values are not integers: round the summed measure for comparison."""
    df = fn(event_bundles(spark, sf_dir))
    return df.withColumn(name, F.round(name, STD_DIGITS))


EVENT_SCORES = {
    "score_session_mean": (score_session_mean, "Mean_for_session"),
    "score_weekly_mean": (score_weekly_mean, "Mean_of_weekly_score"),
    "score_session_sum": (score_session_sum, "Sum_of_session"),
    "score_weekly_sum": (score_weekly_sum, "Sum_of_weekly_score"),
}


def _has(module: str) -> bool:
    """Whether a module that may have been taken away is there."""
    return importlib.util.find_spec(module) is not None


def optional_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    if _has("equilibra.llm"):
        from equilibra.llm import queries as llm

        out.update(llm.queries())
        if _has("corpus_pipeline"):
            import corpus_pipeline

            out["pipeline"] = corpus_pipeline.run
    return out


def _optional_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    if _has("equilibra.llm"):
        from equilibra.llm import queries as llm

        out.update(llm.oracle_sql())
        if _has("corpus_pipeline"):
            import corpus_pipeline

            if corpus_pipeline.ORACLE_SQL:
                out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        name: partial(_product, name) for name in PRODUCTS
    }
    out.update(
        {
            "flatten_bundle": _flatten_bundle,
            "observations": _observations,
            "samples_range": partial(_samples, C.RANGE_OF_MOVEMENT),
            "samples_speed": partial(_samples, C.SPEED_OF_MOVEMENT),
            "samples_timed": partial(_samples_timed, C.RANGE_OF_MOVEMENT),
            "samples_timed_speed": partial(_samples_timed, C.SPEED_OF_MOVEMENT),
            "symptom_statistics": partial(_statistics, symptom_statistics),
            "score_statistics": partial(_statistics, score_statistics),
            "range_statistics": partial(_statistics, partial(movement_statistics, code=C.RANGE_OF_MOVEMENT)),
            "speed_statistics": partial(_statistics, partial(movement_statistics, code=C.SPEED_OF_MOVEMENT)),
            "load_bundle_table": _load_bundle_table,
            "publish_roundtrip": _publish_roundtrip,
            "skipped_files": _skipped_files,
            "published_version": _published_version,
            "rejected_values": _rejected_values,
            "shred_flatten": _shred_flatten,
            "shredded_sizes": _shredded_sizes,
        }
    )
    out.update({name: partial(_hard, fn) for name, fn in HARD.items()})
    out.update({f"published_{name}": partial(_family, name) for name in PUBLISHED})
    out.update({f"refreshed_{name}": partial(_refreshed, name) for name in REFRESHED})
    for name, code in SYMPTOM_KEYS.items():
        out[f"events_{name}_weekly_sum"] = partial(_events, partial(symptom_weekly_sum, code=code))
        out[f"events_{name}_reported"] = partial(_events, partial(symptom_reported, code=code))
    for key, (fn, col) in EVENT_SCORES.items():
        out[f"events_{key}"] = partial(_events_rounded, fn, col)
    out.update(optional_queries())
    return out


def oracle_sql() -> dict[str, str]:
    W, D, P = C.WEEK, C.DATE, C.PATIENT
    E, T = C.DISPLAY, C.TEXT
    sql: dict[str, str] = {}
    for name, code in SYMPTOM_KEYS.items():
        sql[f"{name}_weekly_sum"] = oracle.symptom_weekly_sum(code)
        sql[f"{name}_reported"] = oracle.symptom_reported(code)
    sql["score_session_mean"] = oracle.score([D, E], "avg", "Mean_for_session")
    sql["score_weekly_mean"] = oracle.score([W, D, P, E], "avg", "Mean_of_weekly_score")
    sql["score_session_sum"] = oracle.score([D, W, P], "sum", "Sum_of_session")
    sql["score_weekly_sum"] = oracle.score([W, P], "sum", "Sum_of_weekly_score")
    detail = [P, D, W, E, T]
    rng, spd = C.RANGE_OF_MOVEMENT, C.SPEED_OF_MOVEMENT
    sql["range_mean"] = oracle.movement(rng, detail, "avg", "Range_of_movement")
    sql["range_std"] = oracle.movement(rng, [W, E, T], "stddev_samp", "STD_value")
    sql["range_min"] = oracle.movement(rng, detail, "min", "Min_value")
    sql["range_max"] = oracle.movement(rng, detail, "max", "Max_value")
    sql["speed_weekly_mean"] = oracle.movement(spd, [P, W, E], "avg", "Speed_of_movement")
    sql["speed_std"] = oracle.movement(spd, [P, W, E, T], "stddev_samp", "STD_value")
    sql["speed_min"] = oracle.movement(spd, detail, "min", "Min_value")
    sql["speed_max"] = oracle.movement(spd, detail, "max", "Max_value")
    for measure, code in C.MEASURES.items():
        for stat in ("Mean", "STD", "Min", "Max"):
            sql[f"segment_{stat.lower()}_{measure}"] = oracle.segment(code, stat)
    sql["session_report"] = oracle.session_report()
    sql["flatten_bundle"] = oracle.flattened_bundle()
    sql["observations"] = oracle.observation_rows()
    sql["samples_range"] = oracle.sample_rows(rng)
    sql["samples_speed"] = oracle.sample_rows(spd)
    sql["samples_timed"] = oracle.timed_samples(rng)
    sql["samples_timed_speed"] = oracle.timed_samples(spd)
    sql["symptom_statistics"] = oracle.symptom_statistics()
    sql["score_statistics"] = oracle.score_statistics()
    sql["range_statistics"] = oracle.movement_statistics(rng)
    sql["speed_statistics"] = oracle.movement_statistics(spd)
    sql["load_bundle_table"] = oracle.symptom_weekly_sum(C.ABNORMAL_VISION)
    sql["publish_roundtrip"] = oracle.symptom_weekly_sum(C.DISORIENTATION)
    ev, hard = oracle.EVENT_BASE, oracle.HARD_BASE
    sql["skipped_files"] = oracle.symptom_weekly_sum(C.DISORIENTATION, ev)
    sql["published_version"] = oracle.symptom_reported(C.HEADACHE)
    sql["shred_flatten"] = oracle.flattened_bundle()
    sql["shredded_sizes"] = oracle.shredded_sizes()
    sql["hard_vision_weekly_sum"] = sql["refreshed_vision_weekly_sum"] = oracle.symptom_weekly_sum(C.ABNORMAL_VISION, hard)
    sql["hard_dizziness_reported"] = oracle.symptom_reported(C.DIZZINESS, hard)
    sql["hard_score_session_sum"] = oracle.score([D, W, P], "sum", "Sum_of_session", hard)
    sql["hard_score_weekly_mean"] = oracle.score([W, D, P, E], "avg", "Mean_of_weekly_score", hard, STD_DIGITS)
    sql["refreshed_score_weekly_sum"] = oracle.score([W, P], "sum", "Sum_of_weekly_score", hard)
    sql["hard_range_mean"] = oracle.movement(rng, detail, "avg", "Range_of_movement", hard, STD_DIGITS)
    sql["hard_range_std"] = sql["refreshed_range_std"] = oracle.movement(rng, [W, E, T], "stddev_samp", "STD_value", hard)
    sql["hard_speed_std"] = oracle.movement(spd, [P, W, E, T], "stddev_samp", "STD_value", hard)
    sql["refreshed_speed_weekly_mean"] = oracle.movement(spd, [P, W, E], "avg", "Speed_of_movement", hard, STD_DIGITS)
    sql["hard_segment_mean_speed"] = oracle.segment_groups(spd, "Mean", hard)
    sql["hard_segment_std_range"] = oracle.segment_groups(rng, "STD", hard)
    sql["hard_session_report"] = oracle.session_report(hard, STD_DIGITS)
    for name in PUBLISHED:
        sql[f"published_{name}"] = sql[f"hard_{name}"]
    sql["rejected_values"] = oracle.rejected_values([rng, spd], hard)
    sql["year_vision_weekly_sum"] = oracle.year_symptom(C.ABNORMAL_VISION, hard)
    sql["year_score_weekly_sum"] = oracle.year_score(hard)
    sql["year_speed_std"] = oracle.year_movement(spd, [P, E, T], hard)
    for name, code in SYMPTOM_KEYS.items():
        sql[f"events_{name}_weekly_sum"] = oracle.symptom_weekly_sum(code, ev)
        sql[f"events_{name}_reported"] = oracle.symptom_reported(code, ev)
    sql["events_score_session_mean"] = oracle.score([D, E], "avg", "Mean_for_session", ev, STD_DIGITS)
    sql["events_score_weekly_mean"] = oracle.score([W, D, P, E], "avg", "Mean_of_weekly_score", ev, STD_DIGITS)
    sql["events_score_session_sum"] = oracle.score([D, W, P], "sum", "Sum_of_session", ev, STD_DIGITS)
    sql["events_score_weekly_sum"] = oracle.score([W, P], "sum", "Sum_of_weekly_score", ev, STD_DIGITS)
    sql.update(_optional_sql())
    return sql
