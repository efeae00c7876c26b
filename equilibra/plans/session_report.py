"""Wide per-session report.

Definition (key K = Patient_id, Date, exercise), as a chain of USING full
outer joins on K: speed stats per text, range stats per text, the four
symptom Yes/No rows, the score rows; then a full outer join with the
duration rows on (K, Start_time); then a full outer join with the repetition
rows on K. Per key the rows multiply: n speed texts x m range texts x the
symptom rows x the score rows. A row with a null key part never matches and
stands alone. Columns:

    Patient_id, Date, entry_resource_code_coding_display, Start_time,
    Min_speed, Max_speed, Mean_speed, Min_range, Max_range, Mean_range,
    Disorientation, Abnormal Vision, Dizziness, Headache,
    Session_score, Duration, Total_reps

Plan, instead of 12 re-shuffling full joins:

* Two DISTINCTs: of the samples, as moments (``move_rows``), and of the small components
  (``fact_rows``): scores, durations and repetitions as their values, the symptoms as
  presence bits of a row per key. Beside them, rows that only say by bits what a key, and a
  key and start time, have at all: they are merged in the task that reads, and spare
  every later search for keys that only one side has. All sides are filters on
  *outputs* of an aggregate or generator above the two, which Catalyst cannot push
  under them, so all reuse two shuffles.
* Speed, range, symptoms and repetitions of a key, whose rows are few, become one row
  of arrays (``key_rows``), so their product isn't made before the last join.
* Scores meet durations by key and start time, and these sessions meet the row of their key:
  two inner joins of completed sides. Each side gets a row of nulls for each key that only
  the other has, known from the bits. Its rows are those of the full outer
  join, and AQE can split a hot key of either side over tasks, as it never can in an
  outer join. The product of a key's sides is unnested after the last join.
* Rows with a null key part match nothing: each side's rows go straight to the report
  (``lone_rows``). So durations that match no score row meet the repetitions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.functions import sample_floats
from equilibra.operators.moments import add_moments, max_of, mean_of, min_of, partial_aggs
from equilibra.operators.observations import observations
from equilibra.plans.movement import MOMENTS, fingerprint

K = [C.PATIENT, C.DATE, C.DISPLAY]
TK = [*K, C.START]

COLUMNS = [
    C.PATIENT,
    C.DATE,
    C.DISPLAY,
    C.START,
    "Min_speed",
    "Max_speed",
    "Mean_speed",
    "Min_range",
    "Max_range",
    "Mean_range",
    *C.SYMPTOMS.values(),
    "Session_score",
    "Duration",
    "Total_reps",
]

MOVE_CODES = [C.SPEED_OF_MOVEMENT, C.RANGE_OF_MOVEMENT]
FACT_CODES = [*C.SYMPTOMS, C.SESSION_SCORE, C.DURATION, C.REPETITIONS]
#: Kinds of rows: one per code whose values are kept, and what a key, and a key and start time, have at all.
KINDS = [*MOVE_CODES, C.SESSION_SCORE, C.DURATION, C.REPETITIONS]
SPEED, RANGE, SCORE, DURATION, REPS = range(len(KINDS))
DAY, TIME = len(KINDS), len(KINDS) + 1
#: Bits of DAY and TIME rows; the lower ones are the symptoms', three each: true, false, null.
HAS_SCORE, HAS_DURATION, HAS_SIDE = (1 << (3 * len(C.SYMPTOMS) + k) for k in range(3))


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _tag(code_col: Column, codes: list[str]) -> Column:
    """Small integer per code: keeps aggregation buffers fixed-width (hash
    aggregation; a string ``max`` would force a sort-based aggregate)."""
    out = None
    for i, code in enumerate(codes):
        out = F.when(code_col == code, F.lit(i)) if out is None else out.when(code_col == code, F.lit(i))
    return out


def _identity(text: str) -> Column:
    """A text where it is short, else its fingerprint: 32 bytes at most, equal only for equal texts
    (a fingerprint has 32 bytes, a short text less)."""
    return F.when(F.octet_length(text) < 32, F.col(text).cast("binary")).otherwise(fingerprint(text))


def _bits() -> Column:
    """What a component says of its key: its code's presence, a symptom's flag."""
    code, flag = F.col(C.COMPONENT_CODE), F.col(C.FLAG)
    out = F.when(code == C.SESSION_SCORE, HAS_SCORE).when(code == C.DURATION, HAS_DURATION)
    for k, c in enumerate(C.SYMPTOMS):
        out = out.when(code == c, F.when(flag, 1).when(~flag, 2).otherwise(4) * (1 << (3 * k)) + HAS_SIDE)
    return out.otherwise(0)


def move_rows(bundles: DataFrame) -> DataFrame:
    """One row per distinct sampled observation, as moments: ``_n``, ``_v`` (the sum), ``_mn``, ``_mx``.

    ``_code`` (a kind) and ``_lone`` (a null key part) come of a generator on purpose: Catalyst pushes no
    filter on its output below the DISTINCT, so all users share one shuffle."""
    obs = observations(bundles, MOVE_CODES).filter(F.col(C.SAMPLES).isNotNull())
    obs = obs.select(_tag(F.col(C.COMPONENT_CODE), KINDS).alias("_kind"), *K, C.EFFECTIVE, C.TEXT, _identity(C.SAMPLES).alias("_id"), sample_floats(C.SAMPLES).alias("_vals"))
    m = F.col(MOMENTS)
    rows = add_moments(obs, MOMENTS, F.col("_vals"), std=False).select(
        "_kind", *K, C.EFFECTIVE, C.TEXT, "_id", m["n"].alias("_n"), m["s"].alias("_v"), m["mn"].alias("_mn"), m["mx"].alias("_mx")
    )
    both = F.array(F.col("_kind") * 2 + _any_null(K).cast("int"))
    moves = rows.distinct().select("*", F.explode_outer(both).alias("_is"))
    return moves.withColumn("_code", F.shiftright("_is", 1)).withColumn("_lone", F.col("_is").bitwiseAND(1) == 1)


def fact_rows(bundles: DataFrame, moves: DataFrame) -> DataFrame:
    """One DISTINCT over the flag and quantity components, and ``_bits`` of what a key (with its
    ``moves``), and a key and start time, have.

    Scores and durations are told apart by (K, Start_time, value), repetitions by (K, value).
    Of a key with a null part there are no bits but the symptoms', each in a row of its
    own (by ``_v``). ``_code``, ``_lone`` and ``_bits`` are aggregate outputs on purpose.
    """
    obs = observations(bundles, FACT_CODES).select(*K, C.START, C.QUANTITY, _tag(F.col(C.COMPONENT_CODE), KINDS).alias("_k"), _bits().alias("_b"), _any_null(K).alias("_l"))
    kind, bits, lone = F.col("_k"), F.col("_b"), F.col("_l")
    flagged, timed = kind.isNull(), kind < REPS
    none = {t: F.lit(None).cast(t) for t in ("string", "double")}

    def row(kind: Column, at: Column, value: Column, bits: Column) -> Column:
        return F.struct(kind.alias("_kind"), at.alias("_at"), value.alias("_v"), bits.alias("_bits"))

    own = row(kind, F.when(timed, F.col(C.START)), F.col(C.QUANTITY), F.lit(0))
    day = row(F.lit(DAY), none["string"], F.when(lone, bits.cast("double")), bits)
    time = row(F.lit(TIME), F.col(C.START), none["double"], bits)
    each = F.when(flagged, F.array(day)).when(lone, F.array(own)).when(timed, F.array(own, day, time)).otherwise(F.array(own, day))
    rows = obs.select(*K, F.explode_outer(each).alias("_r")).select(*K, "_r.*")
    moved = moves.filter(~F.col("_lone")).select(*K, F.lit(DAY).alias("_kind"), none["string"].alias("_at"), none["double"].alias("_v"), F.lit(HAS_SIDE).alias("_bits"))
    keys = ["_kind", *K, "_at", "_v"]
    return rows.unionByName(moved).groupBy(*keys).agg(F.max("_kind").alias("_code"), F.bit_or("_bits").alias("_bits"), F.max(_any_null(K)).alias("_lone"))


def _has(bit: int) -> Column:
    return F.col("_bits").bitwiseAND(bit) > 0


def _by_text(moves: DataFrame, facts: DataFrame, keys: list[Column]) -> DataFrame:
    """Samples merged per key and text, beside the rows of facts as they are."""
    moves = moves.select(*K, F.lit(None).cast("string").alias("_at"), "_code", C.TEXT, F.lit(None).cast("double").alias("_value"), F.struct(F.col("_n").alias("n"), F.col("_v").alias("s"), F.col("_mn").alias("mn"), F.col("_mx").alias("mx")).alias("_m"))
    facts = facts.select(*K, "_at", "_code", F.col("_v").alias("_value"), "_bits")
    rows = moves.unionByName(facts, allowMissingColumns=True)
    if keys == K:
        rows = rows.repartition(*K)
    return rows.groupBy(*keys, "_code", C.TEXT, "_value").agg(*partial_aggs(F.col("_m"), "_a"), F.bit_or("_bits").alias("_bits"))


def key_rows(moves: DataFrame, facts: DataFrame) -> DataFrame:
    """One row per key without nulls: arrays of its speed, range and repetition rows, its symptoms' bits.

    The rows, distinct and narrow by now, meet by key alone, which is a patient's exercise of one day; they are
    merged by text as a stream before the arrays are made."""
    sides = _by_text(moves.filter(~F.col("_lone")), facts.filter(~F.col("_lone") & F.col("_code").isin(REPS, DAY)), K)
    stats = F.struct(min_of("_a").alias("Min"), max_of("_a").alias("Max"), mean_of("_a").alias("Mean"))
    held = lambda kind, value, name: F.collect_list(F.when(F.col("_code") == kind, value)).alias(name)
    return sides.groupBy(*K).agg(held(SPEED, stats, "_speed"), held(RANGE, stats, "_range"), held(REPS, F.struct("_value"), "_reps"), F.bit_or("_bits").alias("_flags"))


def sessions(facts: DataFrame) -> DataFrame:
    """Score rows with their durations (equal K and Start_time); the durations that no score row matches
    (``_alone``); and a row of nulls for each key whose other sides would else meet none."""
    mine, code = facts.filter(~F.col("_lone")), F.col("_code")
    at = F.col("_at").alias(C.START)
    score = mine.filter((code == SCORE) | (code == TIME) & ~_has(HAS_SCORE)).select(*K, at, F.col("_v").alias("Session_score"), (code == TIME).alias("_alone"))
    duration = mine.filter((code == DURATION) | (code == TIME) & ~_has(HAS_DURATION)).select(*K, at, F.col("_v").alias("Duration"))
    none = mine.filter((code == DAY) & ~_has(HAS_SCORE) & (_has(HAS_SIDE) | ~_has(HAS_DURATION))).select(*K, F.lit(False).alias("_alone"))
    return _product(score, duration, TK).unionByName(none, allowMissingColumns=True)


def lone_rows(moves: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows with a null key part, which stand alone in each side."""
    code = F.col("_code")
    sides = _by_text(moves.filter("_lone"), facts.filter("_lone"), [*K, "_at"])
    of = lambda kind, value, name: F.when(code == kind, value).alias(name)
    move = lambda kind, label: [of(kind, min_of("_a"), f"Min_{label}"), of(kind, max_of("_a"), f"Max_{label}"), of(kind, mean_of("_a"), f"Mean_{label}")]
    symptoms = [F.element_at(_flag_values(F.col("_bits"), k), 1).alias(name) for k, name in enumerate(C.SYMPTOMS.values())]
    value = F.col("_value")
    return sides.select(*K, F.col("_at").alias(C.START), *move(SPEED, "speed"), *move(RANGE, "range"), *symptoms, of(SCORE, value, "Session_score"), of(DURATION, value, "Duration"), of(REPS, value, "Total_reps"))


def _flag_values(bits: Column, k: int) -> Column:
    """The Yes/No values of the k-th symptom: one for each distinct flag (at most three)."""
    given = bits.bitwiseAND(7 << (3 * k))
    values = F.lit(None).cast("array<string>")
    for held in range(1, 8):
        texts = [F.lit(t) for b, t in ((1, "Yes"), (2, "No"), (4, "No")) if held & b]
        values = F.when(given == held << (3 * k), F.array(*texts)).otherwise(values)
    return values


def _on(left: list[str], right: list[str]) -> Column:
    """Equality of two key lists as one struct each, null parts equal. The sides'
    partitioning doesn't match a struct, so an inner join on it gets its own
    exchange on both sides, which AQE's skew handling needs to split a hot key."""
    return F.struct(*left).eqNullSafe(F.struct(*right))


def _presence(keys: list[str], **sides: DataFrame) -> DataFrame:
    """Distinct ``keys`` of the sides with a boolean column per side: whether it has the key.

    A bit per side in one aggregate, which a filter reads: whichever columns are used, and
    even with none, the aggregation is the same one, and its exchange is shared."""
    rows = [d.select(*keys, F.lit(1 << k).alias("_in")) for k, d in enumerate(sides.values())]
    met = reduce(DataFrame.unionByName, rows).groupBy(*keys).agg(F.bit_or("_in").alias("_in")).filter(F.col("_in") > 0)
    return met.select(*keys, *[(F.col("_in").bitwiseAND(1 << k) > 0).alias(n) for k, n in enumerate(sides)])


def _product(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys``, null parts equal; the keys once."""
    r = right.select(*[F.col(c).alias("_r" + c) if c in keys else F.col(c) for c in right.columns])
    return left.join(r, _on(keys, ["_r" + k for k in keys]), "inner").drop(*["_r" + k for k in keys])


def session_report(bundles: DataFrame, components: DataFrame | None = None) -> DataFrame:
    """``components``: the same bundles read without sample text (``FACT_FIELDS``), for
    the symptoms, scores, durations and repetitions; unset, ``bundles`` serves both."""
    moves = move_rows(bundles)
    facts = fact_rows(bundles if components is None else components, moves)
    main = _product(sessions(facts), key_rows(moves, facts), K)
    own = ~F.col("_alone")
    main = main.select(
        *K, C.START, "Session_score", "Duration", "_reps",
        F.when(own, F.col("_speed")).alias("_speed"),
        F.when(own, F.col("_range")).alias("_range"),
        *[F.when(own, _flag_values(F.col("_flags"), k)).alias(f"_{name}") for k, name in enumerate(C.SYMPTOMS.values())],
    )
    # Unnested one after the other, a key's rows are the product of its sides; an empty one counts as a null.
    for held in ("_speed", "_range", "_reps", *[f"_{name}" for name in C.SYMPTOMS.values()]):
        main = main.withColumn(held, F.explode_outer(held))
    move = lambda side: [F.col(side)[stat].alias(f"{stat}{side}") for stat in ("Min", "Max", "Mean")]
    main = main.select(
        *K, C.START, *move("_speed"), *move("_range"), *[F.col(f"_{n}").alias(n) for n in C.SYMPTOMS.values()],
        "Session_score", "Duration", F.col("_reps")["_value"].alias("Total_reps"),
    )
    return main.unionByName(lone_rows(moves, facts)).select(*COLUMNS)
