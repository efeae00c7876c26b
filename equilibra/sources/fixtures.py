"""Bundle tables derived by Spark from the driver's flat tables.

No bundle data ships with the project, so the test and bench inputs are
built from ``orders`` + ``lineitem`` (``session_bundle``) and from ``events``
(``event_bundle``). The rules below are the fixture's definition; the DuckDB
oracle SQL in ``equilibra.oracle`` derives the same values from the flat
tables without going through any nesting.

Both builders are plain DataFrame plans: one aggregation of ``lineitem`` by
order (a TPC-H order has a handful of lines, so one order's lines stay a small
array), one equi-join to ``orders``, and struct/array construction per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equilibra import codes
from equilibra.sources.bundles import COMPONENT_TYPE

# --- fixed values: fixture rules ---------------------------------------------
SPEED_FLAG = "N"  # lines with this return flag form the speed signal
RANGE_FLAGS = ("A", "R")  # one range component per flag present
FAST_FLAG = "A"  # sampled every 7.5 s; other flags every 15 s
FAST_STEP_MS = 7500
SLOW_STEP_MS = 15000
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
CATEGORIES = ("a", "b")  # an unrelated sibling array: must change no answer
OTHER_CODING = ("0000", "other")  # a second observation coding: filtered out
EVENT_COMPONENTS = {  # event_type -> component code
    "error": codes.DISORIENTATION,
    "click": codes.ABNORMAL_VISION,
    "view": codes.DIZZINESS,
    "signup": codes.HEADACHE,
    "purchase": codes.SESSION_SCORE,
}


def _component(
    code: str,
    *,
    text: Column | None = None,
    flag: Column | None = None,
    quantity: Column | None = None,
    data: Column | None = None,
    times: Column | None = None,
    twice: Column | None = None,
) -> Column:
    """A component; where ``twice`` is true it holds its coding twice."""
    coding = F.struct(F.lit(code).alias("code"))
    codings = F.array(coding)
    if twice is not None:
        codings = F.when(twice, F.array(coding, coding)).otherwise(codings)
    field = lambda name: F.lit(None).cast(COMPONENT_TYPE[name].dataType)
    sampled = (
        F.struct(data.alias("data"), F.array(F.struct(times.alias("valueString"))).alias("extension"))
        if data is not None
        else field("valueSampledData")
    )
    return F.struct(
        F.struct(codings.alias("coding"), (text if text is not None else F.lit(None).cast("string")).alias("text")).alias("code"),
        (flag if flag is not None else field("valueBoolean")).alias("valueBoolean"),
        (F.struct(quantity.cast("double").alias("value")) if quantity is not None else field("valueQuantity")).alias("valueQuantity"),
        sampled.alias("valueSampledData"),
    )


def _resource(subject: Column, effective: Column, display: Column, components: Column, recoded: Column | None = None) -> Column:
    """An entry; where ``recoded`` is true it holds its session coding once more."""
    session = F.struct(F.lit(codes.SESSION).alias("code"), display.alias("display"))
    other = F.struct(F.lit(OTHER_CODING[0]).alias("code"), F.lit(OTHER_CODING[1]).alias("display"))
    coding = F.array(session, other)
    if recoded is not None:
        coding = F.when(recoded, F.array(session, other, session)).otherwise(coding)
    resource = F.struct(
        F.struct(subject.alias("reference")).alias("subject"),
        effective.alias("effectiveDateTime"),
        F.array(*[F.struct(F.lit(c).alias("text")) for c in CATEGORIES]).alias("category"),
        F.struct(coding.alias("coding")).alias("code"),
        components.alias("component"),
    )
    return F.struct(resource.alias("resource"))


def _bundle(subject: Column, effective: Column, display: Column, components: Column) -> Column:
    return F.array(_resource(subject, effective, display, components))


def _bracketed(texts: Column, first: Column | None = None, last: Column | None = None) -> Column:
    parts = [F.lit("[[["), first, F.concat_ws(" ", texts), last, F.lit("]]]")]
    return F.concat(*[p for p in parts if p is not None])


def session_bundle(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One bundle holding one session observation per order; one without lines
    has no sampled component and 0 repetitions.

    Patient = customer, exercise (display) = order priority, time of day =
    ``(o_orderkey * 37) % 86400`` s after midnight of the order date. Line
    quantities of a return flag form a sampled signal ordered by
    ``(ms, quantity)`` with ``ms = (linenumber - 1) * step``.
    """
    joined = _order_lines(orders, lineitem, F.col("l_quantity"))
    key = F.col("o_orderkey")
    entry = _bundle(_subject(), F.date_format(_session_time(), TIME_FORMAT), F.col("o_orderpriority"), _session_components(key))
    return joined.select(entry.alias("entry"))


def hard_bundle(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The sessions of ``session_bundle`` as a careless source would send them. By order key:

    * samples aren't whole numbers (quantity x 0.37, three places); every 6th signal starts
      with an empty token, every 4th ends with one that is no number;
    * every 11th time is no date, of the others every 3rd ends in ``Z`` (no start time);
    * every 2nd bundle holds its observation twice, every 13th bundle comes twice, every 5th
      observation has its session coding twice, every 7th has each component's coding twice.

    So without its DISTINCT every product that counts, adds or spreads comes out wrong.
    """
    marks = lambda k: (F.when(k % 6 == 0, " ").otherwise(""), F.when(k % 4 == 0, " n/a").otherwise(""))
    joined = _order_lines(orders, lineitem, (F.col("l_quantity") * 0.37).cast("decimal(12,3)"), marks, lambda k: k % 7 == 0)
    key = F.col("o_orderkey")
    every = lambda n: key % n == 0
    time = F.date_format(_session_time(), "yyyy-MM-dd'T'HH:mm:ss")
    effective = F.when(every(11), F.lit("not a date")).when(every(3), F.concat(time, F.lit("Z"))).otherwise(F.concat(time, F.lit("+00:00")))
    components = _session_components(key, every(7))
    resource = _resource(_subject(), effective, F.col("o_orderpriority"), components, every(5))
    entry = F.when(every(2), F.array("_e", "_e")).otherwise(F.array("_e"))
    # Rows are doubled before their bundles are built, so that no finished bundle is copied for it.
    copies = F.when(every(13), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    joined = joined.select("*", F.explode(copies))
    return joined.select(key, resource.alias("_e")).select(entry.alias("entry"))


def _order_lines(
    orders: DataFrame,
    lineitem: DataFrame,
    quantity: Column,
    marks: Callable[[Column], tuple[Column, Column]] | None = None,
    twice: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Orders with the number of their lines (``n_lines``) and the sampled components that they
    have (``sampled``; null where an order has no lines), in the order of the return flags.

    Lines and orders meet by order key in a shuffle, never in a broadcast: both grow with the
    data. The shuffle keeps its number of partitions (one given by number isn't merged at run
    time): a bundle costs far more time than the bytes it is made of, which merging goes by.

    The aggregation collects times and values alone and hands on two texts per flag, so that
    the sort and the join carry flat rows; the components are made after it.
    """
    step = F.when(F.col("l_returnflag") == FAST_FLAG, F.lit(FAST_STEP_MS)).otherwise(F.lit(SLOW_STEP_MS))
    lines = lineitem.select("l_orderkey", "l_returnflag", F.struct(((F.col("l_linenumber") - 1) * step).alias("ms"), quantity.alias("qty")).alias("line"))
    parts = int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority").repartition(parts, "o_orderkey")
    coded = {SPEED_FLAG: codes.SPEED_OF_MOVEMENT, **{f: codes.RANGE_OF_MOVEMENT for f in RANGE_FLAGS}}
    texts = marks(F.col("l_orderkey")) if marks else ()

    def signal(flag: str) -> list[Column]:
        """The value and time texts of a flag's lines; null without such lines."""
        found = F.sort_array(F.collect_list(F.when(F.col("l_returnflag") == flag, F.col("line"))))
        text = lambda field, *more: F.when(F.size(found) > 0, _bracketed(found[field].cast("array<string>"), *more))
        return [text("qty", *texts).alias(f"qty_{flag}"), text("ms").alias(f"ms_{flag}")]

    per_order = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("int").alias("n_lines"), *[c for f in coded for c in signal(f)])
    joined = kept.join(per_order.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")

    def sampled(flag: str, code: str) -> Column:
        component = _component(code, text=F.lit(flag), data=F.col(f"qty_{flag}"), times=F.col(f"ms_{flag}"), twice=twice and twice(F.col("o_orderkey")))
        return F.when(F.col(f"qty_{flag}").isNotNull(), F.array(component)).otherwise(F.array().cast(T.ArrayType(COMPONENT_TYPE)))

    return joined.withColumn("n_lines", F.coalesce("n_lines", F.lit(0))).withColumn("sampled", F.concat(*[sampled(f, c) for f, c in coded.items()]))


def _subject() -> Column:
    return F.concat(F.lit("Patient/"), F.col("o_custkey").cast("string"))


def _session_time() -> Column:
    return F.timestamp_add("SECOND", (F.col("o_orderkey") * 37) % 86400, F.col("o_orderdate"))


def _session_components(key: Column, twice: Column | None = None) -> Column:
    """All components that an order's session has, the sampled ones first; ``twice``: see ``_component``."""
    none = F.array().cast(T.ArrayType(COMPONENT_TYPE))

    def one(code: str, **fields: Column) -> Column:
        return F.array(_component(code, twice=twice, **fields))

    return F.concat(
        F.coalesce("sampled", none),
        one(codes.DISORIENTATION, flag=key % 2 == 0),
        one(codes.ABNORMAL_VISION, flag=key % 3 == 0),
        one(codes.DIZZINESS, flag=F.when(key % 5 == 0, F.lit(None)).otherwise(key % 4 == 0)),
        one(codes.HEADACHE, flag=key % 7 == 0),
        F.when(key % 4 != 1, one(codes.SESSION_SCORE, quantity=key % 100)).otherwise(none),
        one(codes.DURATION, quantity=F.lit(30) + key % 600),
        one(codes.REPETITIONS, quantity=F.col("n_lines")),
    )


def event_bundle(events: DataFrame) -> DataFrame:
    """One bundle per event: many reports per patient and day.

    ``error``/``click``/``view``/``signup`` become the four symptom flags
    (true when ``event_id % 3 = 0``); ``purchase`` becomes a session score
    equal to ``value``; the exercise is ``ex<user_id % 4>``.
    """
    etype, flag = F.col("event_type"), F.col("event_id") % 3 == 0
    component = None
    for name, code in EVENT_COMPONENTS.items():
        one = F.array(_component(code, quantity=F.col("value")) if code == codes.SESSION_SCORE else _component(code, flag=flag))
        component = F.when(etype == name, one) if component is None else component.when(etype == name, one)
    entry = _bundle(
        F.concat(F.lit("Patient/"), F.col("user_id").cast("string")),
        F.date_format(F.date_trunc("second", F.col("ts")), TIME_FORMAT),
        F.concat(F.lit("ex"), (F.col("user_id") % 4).cast("string")),
        component.otherwise(F.array().cast(T.ArrayType(COMPONENT_TYPE))),
    )
    return events.select(entry.alias("entry"))
