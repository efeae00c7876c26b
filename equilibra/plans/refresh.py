"""Products kept up to date from stored state: new bundles are folded in, old ones aren't read again.

The state is four tables, in parts by a grain of the date (days, months, ...), committed
together (``equilibra.sources.versions``):

* ``seen_samples``: the identity of each sampled observation (keys, time, fingerprint), so that
  one that arrives again counts once, as in the products' DISTINCT;
* ``sample_cells``: mergeable cells per code, day, patient, exercise and text
  (``equilibra.operators.moments``), from which every mean, deviation, minimum and maximum follows;
* ``symptom_days`` and ``scores``: the DISTINCT rows themselves, which are small.

``refresh`` reads the new bundles, and of the state only the parts that the new
bundles' dates lie in: late observations open an old part, others leave it alone. What is new is added
to these parts. Cells of one key from several refreshes add up when a product is made;
``compact`` merges them in parts that have gathered many. Nothing is ever changed in place, so a
refresh that fails leaves the old state, and each product can be made as of an older version.

Observations without a date (null) share a part. Null key parts are compared null-safely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.operators.observations import observations
from equilibra.plans.movement import DETAIL_KEYS, FINGERPRINT, MOVEMENT_PRODUCTS, merge_cells, movement_product_of_cells, observation_cells, observation_moments
from equilibra.plans.scores import SCORE, SCORE_PRODUCTS, score_product
from equilibra.plans.symptoms import DAY, reports, weekly_sums
from equilibra.session import shared_dir
from equilibra.sources.versions import Store, Write

SEEN, CELLS, DAYS, SCORES = "seen_samples", "sample_cells", "symptom_days", "scores"
IDENTITY = [C.COMPONENT_CODE, C.PATIENT, C.DISPLAY, C.TEXT, C.EFFECTIVE, C.DATE, C.WEEK, FINGERPRINT]
#: Key columns of days and scores alike.
SHARED = [C.PATIENT, C.DISPLAY, C.DATE, C.WEEK]
SYMPTOM_CODES = {"disorientation": C.DISORIENTATION, "dizziness": C.DIZZINESS, "headache": C.HEADACHE, "vision": C.ABNORMAL_VISION}


def _store(spark: SparkSession, root: str | None) -> Store:
    return Store(spark, f"{root or shared_dir(spark)}/state")


def _part(grain: str) -> Column:
    return F.date_format(C.DATE, grain)


def _days_and_scores(bundles: DataFrame) -> DataFrame:
    """Distinct symptom days and scores, which are small, from one scan and one unnesting;
    the columns of each lie in a struct that is null in the other's rows."""
    code = F.col(C.COMPONENT_CODE)
    obs = observations(bundles, [*C.SYMPTOMS, C.SESSION_SCORE])
    flag = F.when(code.isin(list(C.SYMPTOMS)), F.struct(C.FLAG)).alias(DAYS)
    score = F.when(code == C.SESSION_SCORE, F.struct(F.col(C.QUANTITY).alias(SCORE), C.START)).alias(SCORES)
    return obs.select(C.COMPONENT_CODE, *SHARED, flag, score).distinct()


def _unseen(store: Store, name: str, new: DataFrame, identity: list[str], known: bool, grain: str) -> DataFrame:
    """Rows of ``new`` that the state hasn't; only parts of their dates are read."""
    if not known:
        return new
    parts = [r[0] for r in new.select(_part(grain)).distinct().collect()]  # one value per part
    old = store.read(name, parts=parts).select([F.col(f"`{c}`").alias(f"_old_{c}") for c in identity])
    # A hash to sort and meet by, then the identities themselves; in structs nulls are equal.
    held = [f"_old_{c}" for c in identity]
    same = (F.xxhash64(*identity) == F.xxhash64(*held)) & (F.struct(*identity) == F.struct(*[F.col(o).alias(c) for o, c in zip(held, identity)]))
    return new.join(old, same, "left_anti")


def refresh(bundles: DataFrame, root: str | None = None, *, grain: str = "yyyy-MM") -> int:
    """Fold ``bundles`` into the state under ``root`` (the shared folder if not given); returns
    the state's new version. Bundles may repeat what earlier ones held, and arrive late.

    ``grain``: the date pattern whose values are the state's parts; the same at every refresh.
    """
    spark = bundles.sparkSession
    store = _store(spark, root)
    known = store.version() > 0
    if known and any(r["part"] not in (None, "n") and len(r["part"]) != len(grain) + 1 for r in store.current(SEEN)):
        raise ValueError(f"the state isn't in parts of {grain}")
    # What is new is written once before it is compared: dates and rows come from one reading.
    staged = Store(spark, f"{store.root}/staged")
    at = staged.commit([Write(SEEN, observation_moments(bundles, [C.RANGE_OF_MOVEMENT, C.SPEED_OF_MOVEMENT])), Write("facts", _days_and_scores(bundles))])
    facts = staged.read("facts", version=at)
    new = {
        SEEN: staged.read(SEEN, version=at),
        DAYS: facts.filter(F.col(DAYS).isNotNull()).select(C.COMPONENT_CODE, *[f"{DAYS}.{c}" if c == C.FLAG else c for c in DAY]),
        SCORES: facts.filter(F.col(SCORES).isNotNull()).select(C.PATIENT, C.DISPLAY, f"{SCORES}.{SCORE}", C.DATE, C.WEEK, f"{SCORES}.{C.START}"),
    }
    fresh = {}
    for name, rows in new.items():
        fresh[name] = _unseen(store, name, rows, IDENTITY if name == SEEN else rows.columns, known, grain)
    if known:  # met once, for the two tables made of it
        fresh[SEEN] = staged.read(SEEN, version=staged.commit([Write(SEEN, fresh[SEEN])]))
    return store.commit(
        [
            Write(SEEN, fresh[SEEN].select(IDENTITY), "add", _part(grain)),
            Write(CELLS, observation_cells(fresh[SEEN]), "add", _part(grain)),
            Write(DAYS, fresh[DAYS], "add", _part(grain)),
            Write(SCORES, fresh[SCORES], "add", _part(grain)),
        ]
    )


def compact(spark: SparkSession, root: str | None = None, least: int = 8, *, grain: str = "yyyy-MM") -> int:
    """Rewrite the parts that at least ``least`` refreshes have added to: their cells are merged,
    their rows put together. Products stay the same. Returns the state's version."""
    store = _store(spark, root)
    writes = []
    for name in (SEEN, CELLS, DAYS, SCORES):
        held: dict[str, int] = {}
        for r in store.current(name):
            if r["rows"]:
                held[r["part"]] = held.get(r["part"], 0) + 1
        parts = [p for p, n in held.items() if n >= least]
        if parts:
            rows = store.read_folders(name, parts)
            rows = merge_cells(rows, [C.COMPONENT_CODE, *DETAIL_KEYS]).select(rows.columns) if name == CELLS else rows
            writes.append(Write(name, rows, "part", _part(grain)))
    return store.commit(writes) if writes else store.version()


def stored_product(spark: SparkSession, name: str, root: str | None = None, *, version: int | None = None, sort: bool = True, with_year: bool = False) -> DataFrame:
    """A movement, symptom or score product (named as in ``PRODUCTS``) from the state."""
    store = _store(spark, root)
    if name in MOVEMENT_PRODUCTS:
        return movement_product_of_cells(store.read(CELLS, version=version), name, sort=sort, with_year=with_year)
    if name in SCORE_PRODUCTS:
        return score_product(store.read(SCORES, version=version), name, sort=sort, with_year=with_year)
    symptom, _, kind = name.partition("_")
    if symptom in SYMPTOM_CODES and kind in ("weekly_sum", "reported"):
        code = SYMPTOM_CODES[symptom]
        days = store.read(DAYS, version=version).filter(F.col(C.COMPONENT_CODE) == code)
        return weekly_sums(days, sort=sort, with_year=with_year) if kind == "weekly_sum" else reports(days, code)
    raise ValueError(f"{name} isn't kept as state")
