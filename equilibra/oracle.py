"""Reference answers as DuckDB SQL over the driver's flat tables.

The bundle fixtures (``equilibra.sources.fixtures``) are built by Spark from
``orders``/``lineitem``/``events``; the SQL here derives every component
straight from those flat tables, with no nesting, and applies each product's
definition literally (DISTINCT, GROUP BY, and for the segment products and
the session report the full-outer-join chains). Equal answers therefore test
the fixture, the unnesting, the parsing and the plan rewrites together.

Standard deviations, and sums/means of non-integer event values, are
rounded to 6 places on both sides of the comparison: floating-point sums in
a different order differ in the last bits.
"""

from __future__ import annotations

from equilibra import codes as C

E = C.DISPLAY
T = C.TEXT
STD_DIGITS = 6

_BRACKETS = r"(^\[\[\[)|(\]\]\]$)"


def session_base(hard: bool = False) -> str:
    """Components of the session fixture, one row each, from flat tables. ``hard``: with the
    values of the hard fixture; what that repeats is here once, as DISTINCT would have it."""
    q = "CAST(CAST(l_quantity * 0.37 AS DECIMAL(12,3)) AS VARCHAR)" if hard else "CAST(l_quantity AS VARCHAR)"
    first, last = ("CASE WHEN ok % 6 = 0 THEN ' ' ELSE '' END", "CASE WHEN ok % 4 = 0 THEN ' n/a' ELSE '' END") if hard else ("''", "''")
    dt, day, start = "strftime(o.ts, '%Y-%m-%dT%H:%M:%S') || '+00:00'", "CAST(o.ts AS DATE)", "strftime(o.ts, '%H:%M:%S') || '+00:00'"
    if hard:
        dt = f"CASE WHEN o.o_orderkey % 11 = 0 THEN 'not a date' WHEN o.o_orderkey % 3 = 0 THEN strftime(o.ts, '%Y-%m-%dT%H:%M:%S') || 'Z' ELSE {dt} END"
        day = f"CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE {day} END"
        start = f"CASE WHEN o.o_orderkey % 11 = 0 OR o.o_orderkey % 3 = 0 THEN '' ELSE {start} END"
    return f"""
li AS (
  SELECT l_orderkey AS ok, l_returnflag AS f, l_quantity AS q, {q} AS qt,
         (l_linenumber - 1) * CASE WHEN l_returnflag = 'A' THEN 7500 ELSE 15000 END AS ms
  FROM lineitem),
cnt AS (SELECT ok, count(*) AS n_lines FROM li GROUP BY ok),
sess AS (
  SELECT o.o_orderkey AS ok,
         CAST(o.o_custkey AS VARCHAR) AS "Patient_id",
         o.o_orderpriority AS {E},
         {dt} AS dt,
         {day} AS "Date",
         CAST(weekofyear({day}) AS INTEGER) AS "Week",
         {start} AS "Start_time",
         coalesce(c.n_lines, 0) AS n_lines
  FROM (SELECT *, o_orderdate + to_seconds(CAST((o_orderkey * 37) % 86400 AS BIGINT)) AS ts FROM orders) o
  LEFT JOIN cnt c ON c.ok = o.o_orderkey),
sig AS (
  SELECT ok, f,
         '[[[' || {first} || string_agg(qt, ' ' ORDER BY ms, q) || {last} || ']]]' AS data,
         '[[[' || string_agg(CAST(ms AS VARCHAR), ' ' ORDER BY ms, q) || ']]]' AS times
  FROM li GROUP BY ok, f),
comp AS (
  SELECT s.*, '{C.SPEED_OF_MOVEMENT}' AS code, g.f AS {T}, NULL::BOOLEAN AS flag, NULL::DOUBLE AS qty,
         g.data, g.times
    FROM sess s JOIN sig g ON g.ok = s.ok AND g.f = 'N'
  UNION ALL
  SELECT s.*, '{C.RANGE_OF_MOVEMENT}', g.f, NULL, NULL, g.data, g.times
    FROM sess s JOIN sig g ON g.ok = s.ok AND g.f IN ('A', 'R')
  UNION ALL SELECT s.*, '{C.DISORIENTATION}', NULL, s.ok % 2 = 0, NULL, NULL, NULL FROM sess s
  UNION ALL SELECT s.*, '{C.ABNORMAL_VISION}', NULL, s.ok % 3 = 0, NULL, NULL, NULL FROM sess s
  UNION ALL SELECT s.*, '{C.DIZZINESS}', NULL,
         CASE WHEN s.ok % 5 = 0 THEN NULL ELSE s.ok % 4 = 0 END, NULL, NULL, NULL FROM sess s
  UNION ALL SELECT s.*, '{C.HEADACHE}', NULL, s.ok % 7 = 0, NULL, NULL, NULL FROM sess s
  UNION ALL SELECT s.*, '{C.SESSION_SCORE}', NULL, NULL, CAST(s.ok % 100 AS DOUBLE), NULL, NULL
    FROM sess s WHERE s.ok % 4 <> 1
  UNION ALL SELECT s.*, '{C.DURATION}', NULL, NULL, CAST(30 + s.ok % 600 AS DOUBLE), NULL, NULL FROM sess s
  UNION ALL SELECT s.*, '{C.REPETITIONS}', NULL, NULL, CAST(s.n_lines AS DOUBLE), NULL, NULL FROM sess s)
"""


SESSION_BASE, HARD_BASE = session_base(), session_base(hard=True)

# Components of the event fixture, one row per event.
EVENT_BASE = f"""
ev AS (
  SELECT event_id, event_type, value,
         CAST(user_id AS VARCHAR) AS "Patient_id",
         'ex' || CAST(user_id % 4 AS VARCHAR) AS {E},
         date_trunc('second', ts) AS t
  FROM events),
comp AS (
  SELECT "Patient_id", {E},
         strftime(t, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS dt,
         CAST(t AS DATE) AS "Date",
         CAST(weekofyear(CAST(t AS DATE)) AS INTEGER) AS "Week",
         strftime(t, '%H:%M:%S') || '+00:00' AS "Start_time",
         CASE event_type WHEN 'error' THEN '{C.DISORIENTATION}' WHEN 'click' THEN '{C.ABNORMAL_VISION}'
                         WHEN 'view' THEN '{C.DIZZINESS}' WHEN 'signup' THEN '{C.HEADACHE}'
                         WHEN 'purchase' THEN '{C.SESSION_SCORE}' END AS code,
         NULL::VARCHAR AS {T},
         CASE WHEN event_type = 'purchase' THEN NULL ELSE event_id % 3 = 0 END AS flag,
         CASE WHEN event_type = 'purchase' THEN value END AS qty,
         NULL::VARCHAR AS data, NULL::VARCHAR AS times
  FROM ev WHERE event_type IN ('error', 'click', 'view', 'signup', 'purchase'))
"""


def _with(base: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([base.strip(), *[c.strip() for c in ctes]])


def _tokens(col: str) -> str:
    return f"string_split(regexp_replace({col}, '{_BRACKETS}', '', 'g'), ' ')"


def _days(code: str) -> str:
    return (
        f'days AS (SELECT DISTINCT "Date", "Week", "Patient_id", {E}, flag AS {C.FLAG} '
        f"FROM comp WHERE code = '{code}')"
    )


def symptom_weekly_sum(code: str, base: str = SESSION_BASE) -> str:
    return _with(base, _days(code)) + (
        f'\nSELECT "Patient_id", "Week", {E}, SUM(CAST({C.FLAG} AS DOUBLE)) AS "Sum" '
        f'FROM days GROUP BY "Patient_id", "Week", {E}'
    )


def symptom_reported(code: str, base: str = SESSION_BASE) -> str:
    name = C.SYMPTOMS[code]
    return _with(base, _days(code)) + (
        f'\nSELECT "Patient_id", "Date", "Week", {E}, '
        f"CASE WHEN {C.FLAG} THEN 'Yes' ELSE 'No' END AS \"{name}\" FROM days"
    )



def symptom_statistics() -> str:
    days = (
        f'days AS (SELECT DISTINCT "Date", "Week", "Patient_id", {E}, code, flag '
        f"FROM comp WHERE code IN ({', '.join(repr(c) for c in C.SYMPTOMS)}))"
    )
    sums = ", ".join(f"SUM(CASE WHEN code = '{c}' THEN CAST(flag AS DOUBLE) END) AS \"{n}\"" for c, n in C.SYMPTOMS.items())
    return _with(SESSION_BASE, days) + f'\nSELECT "Patient_id", "Week", {E}, {sums} FROM days GROUP BY "Patient_id", "Week", {E}'


_SCORES = (
    f'sc AS (SELECT DISTINCT "Patient_id", {E}, qty AS "Session_score", "Date", "Week", "Start_time" '
    f"FROM comp WHERE code = '{C.SESSION_SCORE}')"
)


def score(keys: list[str], fn: str, name: str, base: str = SESSION_BASE, digits: int | None = None) -> str:
    k = ", ".join(f'"{c}"' if c != E else E for c in keys)
    agg = f'{fn}("Session_score")'
    if digits is not None:
        agg = f"ROUND({agg}, {digits})"
    return _with(base, _SCORES) + f'\nSELECT {k}, {agg} AS "{name}" FROM sc GROUP BY {k}'


def weekly(rows: list[str], keys: list[str], agg: str, name: str, source: str, base: str) -> str:
    """A grouping by weeks of their years. ``rows``: the expressions that lead to ``source``."""
    k = ", ".join(f'"{c}"' for c in keys)
    year = 'CAST(isoyear("Date") AS INTEGER)'
    return _with(base, *rows) + f'\nSELECT {year} AS "Week_year", "Week", {k}, {agg} AS "{name}" FROM {source} GROUP BY {year}, "Week", {k}'


def year_symptom(code: str, base: str) -> str:
    return weekly([_days(code)], [C.PATIENT, E], f"SUM(CAST({C.FLAG} AS DOUBLE))", "Sum", "days", base)


def year_score(base: str) -> str:
    return weekly([_SCORES], [C.PATIENT], 'sum("Session_score")', "Sum_of_weekly_score", "sc", base)


def year_movement(code: str, keys: list[str], base: str) -> str:
    return weekly(_samples(code), keys, f"ROUND(stddev_samp(col), {STD_DIGITS})", "STD_value", "smp", base)


def score_statistics() -> str:
    k = f'"Patient_id", "Date", "Week", {E}'
    stats = 'count("Session_score") AS "Scores", avg("Session_score") AS "Mean", sum("Session_score") AS "Sum"'
    return _with(SESSION_BASE, _SCORES) + f"\nSELECT {k}, {stats} FROM sc GROUP BY {k}"


def _samples(code: str) -> list[str]:
    return [
        f"mo AS (SELECT DISTINCT \"Patient_id\", {E}, {T}, data, dt, \"Date\", \"Week\" "
        f"FROM comp WHERE code = '{code}')",
        f'tok AS (SELECT "Patient_id", "Date", "Week", {E}, {T}, unnest({_tokens("data")}) AS tk FROM mo)',
        f'smp AS (SELECT "Patient_id", "Date", "Week", {E}, {T}, TRY_CAST(tk AS FLOAT) AS col FROM tok)',
    ]


def sample_rows(code: str) -> str:
    return _with(SESSION_BASE, *_samples(code)) + f'\nSELECT "Patient_id", "Date", "Week", {E}, {T}, col FROM smp'


def movement(code: str, keys: list[str], fn: str, name: str, base: str = SESSION_BASE, digits: int | None = None) -> str:
    k = ", ".join(f'"{c}"' if c not in (E, T) else c for c in keys)
    agg = f"ROUND(stddev_samp(col), {STD_DIGITS})" if fn == "stddev_samp" else f"ROUND({fn}(col), {digits})" if digits else f"{fn}(col)"
    return _with(base, *_samples(code)) + f'\nSELECT {k}, {agg} AS "{name}" FROM smp GROUP BY {k}'


def movement_statistics(code: str) -> str:
    k = f'"Patient_id", "Date", "Week", {E}, {T}'
    stats = f'avg(col) AS "Mean", ROUND(stddev_samp(col), {STD_DIGITS}) AS "STD", min(col) AS "Min", max(col) AS "Max"'
    return _with(SESSION_BASE, *_samples(code)) + f"\nSELECT {k}, {stats} FROM smp GROUP BY {k}"


def _timed(code: str) -> list[str]:
    return [
        f"mt AS (SELECT DISTINCT \"Patient_id\", {E}, {T}, data, times, dt, \"Date\", \"Week\" "
        f"FROM comp WHERE code = '{code}')",
        f'tt AS (SELECT "Patient_id", {E}, {T}, dt, "Date", "Week", '
        f'unnest(coalesce({_tokens("data")}, [NULL::VARCHAR])) AS vt, '
        f'unnest(coalesce({_tokens("times")}, [NULL::VARCHAR])) AS st FROM mt)',
        f'pt AS (SELECT "Patient_id", {E}, {T}, dt, "Date", "Week", TRY_CAST(vt AS FLOAT) AS data_values, '
        f"TRY_CAST(st AS FLOAT) AS seconds, CAST(TRY_CAST(st AS FLOAT) AS DOUBLE) / 1000 AS sec FROM tt)",
    ]


def timed_samples(code: str) -> str:
    return _with(SESSION_BASE, *_timed(code)) + (
        f'\nSELECT "Patient_id", {E}, {T}, dt AS {C.EFFECTIVE}, "Date", "Week", data_values, seconds, sec FROM pt'
    )


_SEG_KEYS = f'"Patient_id", "Date", "Week", {E}, {T}'
_SEG_FN = {"Mean": "avg", "STD": "stddev_samp", "Min": "min", "Max": "max"}


def segment(code: str, stat: str) -> str:
    """The literal form: four filtered aggregates, full outer joins on 5 keys."""
    parts = []
    for j, (lo, hi) in enumerate(C.SEGMENTS):
        agg = f"{_SEG_FN[stat]}(data_values)"
        if stat == "STD":
            agg = f"ROUND({agg}, {STD_DIGITS})"
        parts.append(
            f'g{j} AS (SELECT {_SEG_KEYS}, {agg} AS "{lo}_{hi} {stat}" FROM pt '
            f"WHERE sec BETWEEN {lo} AND {hi} GROUP BY {_SEG_KEYS})"
        )
    using = f'USING ("Patient_id", "Date", "Week", {E}, {T})'
    body = "g0" + "".join(f" FULL OUTER JOIN g{j} {using}" for j in range(1, len(C.SEGMENTS)))
    cols = ", ".join(f'"{lo}_{hi} {stat}"' for lo, hi in C.SEGMENTS)
    return _with(SESSION_BASE, *_timed(code), *parts) + f"\nSELECT {_SEG_KEYS}, {cols} FROM {body}"


def segment_groups(code: str, stat: str, base: str) -> str:
    """The same as one grouping, in which a key with a null part is one row."""
    aggs = ", ".join(f'ROUND({_SEG_FN[stat]}(data_values) FILTER (sec BETWEEN {lo} AND {hi}), {STD_DIGITS}) AS "{lo}_{hi} {stat}"' for lo, hi in C.SEGMENTS)
    first, last = C.SEGMENTS[0][0], C.SEGMENTS[-1][1]
    return _with(base, *_timed(code)) + f"\nSELECT {_SEG_KEYS}, {aggs} FROM pt WHERE sec BETWEEN {first} AND {last} GROUP BY {_SEG_KEYS}"


def session_report(base: str = SESSION_BASE, digits: int | None = None) -> str:
    k3 = f'"Patient_id", "Date", {E}'
    ctes = []
    for name, code in (("spd", C.SPEED_OF_MOVEMENT), ("rng", C.RANGE_OF_MOVEMENT)):
        ctes.append(
            f"{name}_o AS (SELECT DISTINCT \"Patient_id\", {E}, {T}, data, dt, \"Date\", \"Week\" "
            f"FROM comp WHERE code = '{code}')"
        )
        ctes.append(
            f'{name}_t AS (SELECT "Patient_id", "Date", {E}, {T}, unnest({_tokens("data")}) AS tk FROM {name}_o)'
        )
        label = "speed" if name == "spd" else "range"
        ctes.append(
            f'{name} AS (SELECT {k3}, min(TRY_CAST(tk AS FLOAT)) AS "Min_{label}", '
            f'max(TRY_CAST(tk AS FLOAT)) AS "Max_{label}", avg(TRY_CAST(tk AS FLOAT)) AS "Mean_{label}" '
            f"FROM {name}_t GROUP BY {k3}, {T})"
        )
    flag_names = []
    for j, (code, name) in enumerate(C.SYMPTOMS.items()):
        ctes.append(
            f"f{j} AS (SELECT {k3}, CASE WHEN flag THEN 'Yes' ELSE 'No' END AS \"{name}\" FROM "
            f"(SELECT DISTINCT \"Date\", \"Week\", \"Patient_id\", {E}, flag FROM comp WHERE code = '{code}'))"
        )
        flag_names.append(f'"{name}"')
    ctes.append(
        f'sco AS (SELECT DISTINCT "Patient_id", {E}, qty AS "Session_score", "Date", "Week", "Start_time" '
        f"FROM comp WHERE code = '{C.SESSION_SCORE}')"
    )
    ctes.append(
        f'dur AS (SELECT DISTINCT "Patient_id", {E}, qty AS "Duration", "Date", "Week", "Start_time" '
        f"FROM comp WHERE code = '{C.DURATION}')"
    )
    ctes.append(
        f'rep AS (SELECT DISTINCT "Patient_id", {E}, qty AS "Total_reps", "Date" '
        f"FROM comp WHERE code = '{C.REPETITIONS}')"
    )
    u3 = f"USING ({k3})"
    body = (
        f'(SELECT {k3}, "Min_speed", "Max_speed", "Mean_speed" FROM spd)'
        f' FULL OUTER JOIN (SELECT {k3}, "Min_range", "Max_range", "Mean_range" FROM rng) {u3}'
        + "".join(f" FULL OUTER JOIN f{j} {u3}" for j in range(len(C.SYMPTOMS)))
        + f' FULL OUTER JOIN (SELECT {k3}, "Start_time", "Session_score" FROM sco) {u3}'
        f' FULL OUTER JOIN (SELECT {k3}, "Start_time", "Duration" FROM dur) USING ({k3}, "Start_time")'
        f' FULL OUTER JOIN (SELECT {k3}, "Total_reps" FROM rep) {u3}'
    )
    number = lambda c: f'ROUND(CAST("{c}" AS DOUBLE), {digits}) AS "{c}"' if digits else f'"{c}"'
    measures = ", ".join(number(f"{stat}_{m}") for m in ("speed", "range") for stat in ("Min", "Max", "Mean"))
    cols = f'{k3}, "Start_time", {measures}, {", ".join(flag_names)}, "Session_score", "Duration", "Total_reps"'
    return _with(base, *ctes) + f"\nSELECT {cols} FROM {body}"


def observation_rows() -> str:
    return _with(SESSION_BASE) + (
        f'\nSELECT \'Patient/\' || "Patient_id" AS {C.REFERENCE}, '
        f'dt AS {C.EFFECTIVE}, \'{C.SESSION}\' AS {C.SESSION_CODE}, {E}, code AS {C.COMPONENT_CODE}, '
        f'{T}, flag AS {C.FLAG}, qty AS {C.QUANTITY}, data AS {C.SAMPLES}, '
        f'"Patient_id", "Date", "Week", "Start_time" FROM comp'
    )


def flattened_bundle() -> str:
    """Every row of the generic flatten: category x coding x component x
    component coding x sample-time extension (outer)."""
    return _with(SESSION_BASE) + f"""
SELECT 'Patient/' || c."Patient_id" AS {C.REFERENCE},
       c.dt AS {C.EFFECTIVE},
       cat.t AS entry_resource_category_text,
       cd.code AS {C.SESSION_CODE},
       cd.disp AS {E},
       c.{T} AS {T},
       c.flag AS {C.FLAG},
       c.code AS {C.COMPONENT_CODE},
       c.qty AS {C.QUANTITY},
       c.data AS {C.SAMPLES},
       c.times AS {C.SAMPLE_TIMES}
FROM comp c
CROSS JOIN (VALUES ('a'), ('b')) cat(t)
CROSS JOIN LATERAL (SELECT '{C.SESSION}' AS code, c.{E} AS disp UNION ALL SELECT '0000', 'other') cd"""


def shredded_sizes() -> str:
    """Rows of each array's table: elements, not products of elements."""
    return _with(SESSION_BASE) + """
SELECT '' AS path, count(*) AS rows FROM sess
UNION ALL SELECT 'entry', count(*) FROM sess
UNION ALL SELECT 'entry_resource_category', 2 * count(*) FROM sess
UNION ALL SELECT 'entry_resource_code_coding', 2 * count(*) FROM sess
UNION ALL SELECT 'entry_resource_component', count(*) FROM comp
UNION ALL SELECT 'entry_resource_component_code_coding', count(*) FROM comp
UNION ALL SELECT 'entry_resource_component_valueSampledData_extension', count(*) FROM comp WHERE data IS NOT NULL"""


def rejected_values(codes: list[str], base: str) -> str:
    """Tokens that are no numbers, with their places, and times that are no dates."""
    named = ", ".join(f"'{c}'" for c in codes)
    keys = f'"Patient_id", {E}, {T}, code, dt'
    told = f'"Patient_id", {E}, {T}, code AS {C.COMPONENT_CODE}, dt AS {C.EFFECTIVE}'
    rows = (
        f"mo AS (SELECT DISTINCT {keys}, data FROM comp WHERE code IN ({named}))",
        f"tok AS (SELECT {keys}, unnest({_tokens('data')}) AS tk, generate_subscripts({_tokens('data')}, 1) - 1 AS place FROM mo)",
    )
    return _with(base, *rows) + f"""
SELECT {told}, 'valueSampledData.data' AS field, CAST(place AS INTEGER) AS place, tk AS value,
       CASE WHEN tk = '' THEN 'empty token' ELSE 'not a number' END AS reason
FROM tok WHERE TRY_CAST(tk AS FLOAT) IS NULL
UNION ALL
SELECT {told}, 'effectiveDateTime', NULL, dt, 'not a date' FROM mo WHERE TRY_CAST(left(dt, 10) AS DATE) IS NULL"""
