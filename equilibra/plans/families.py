"""All products of a family from one reading of the bundles.

Products of a family share what is costly: the scan, the unnesting, the parsing and the
DISTINCT. ``publish_products`` writes that shared frame once per family, makes each product from
the stored frame, and publishes a family's products in one commit, so that readers never
see some of them new and others old. The bundles are read once per family, whatever number of
its products is asked for (a segment family per measure; the report is a family of its own).

While the frame is written, ``DataFrame.observe`` counts its rows and, for sampled signals, the
values that were rejected on the way; these are published as the table ``rejects``, from the same frame.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.operators.rejects import REJECTS, reject_counts, unnest_rejects
from equilibra.plans import PRODUCTS, SYMPTOM_KEYS
from equilibra.plans.movement import MOVEMENT_PRODUCTS, movement_product, observation_moments
from equilibra.plans.scores import SCORE_PRODUCTS, score_product, session_scores
from equilibra.plans.segments import KEYS, segment_label, segment_statistics
from equilibra.plans.symptoms import all_symptom_days, reports, weekly_sums
from equilibra.session import shared_dir
from equilibra.sources.versions import Store, Write


@dataclass(frozen=True)
class Family:
    """The shared frame of some products, and each product as made from it."""

    frame: Callable[[DataFrame], DataFrame]
    products: dict[str, Callable[[DataFrame], DataFrame]]
    rejects: bool = False


def _symptom(name: str) -> dict[str, Callable[[DataFrame], DataFrame]]:
    code = SYMPTOM_KEYS[name]
    days = lambda frame: frame.filter(F.col(C.COMPONENT_CODE) == code)
    return {f"{name}_weekly_sum": lambda f: weekly_sums(days(f)), f"{name}_reported": lambda f: reports(days(f), code)}


def _segment(stat: str) -> Callable[[DataFrame], DataFrame]:
    return lambda f: f.select(*KEYS, *[F.col(f"`{segment_label(lo, hi)} {stat}`") for lo, hi in C.SEGMENTS])


FAMILIES: dict[str, Family] = {
    "symptoms": Family(all_symptom_days, {k: v for name in SYMPTOM_KEYS for k, v in _symptom(name).items()}),
    "scores": Family(session_scores, {p: (lambda f, p=p: score_product(f, p)) for p in SCORE_PRODUCTS}),
    "movement": Family(
        lambda b: observation_moments(b, [C.RANGE_OF_MOVEMENT, C.SPEED_OF_MOVEMENT], rejects=True),
        {p: (lambda f, p=p: movement_product(f, p)) for p in MOVEMENT_PRODUCTS},
        rejects=True,
    ),
    "session_report": Family(PRODUCTS["session_report"], {"session_report": lambda f: f}),
}
for _measure, _code in C.MEASURES.items():
    FAMILIES[f"segments_{_measure}"] = Family(
        lambda b, code=_code: segment_statistics(b, code), {f"segment_{s.lower()}_{_measure}": _segment(s) for s in ("Mean", "STD", "Min", "Max")}
    )


@dataclass
class Published:
    """What one family's commit holds: its version, its shared frame's rows, rejected values by reason."""

    version: int
    products: list[str]
    rows: int
    rejected: dict[str, int] = field(default_factory=dict)


def publish_products(bundles: DataFrame, names: Iterable[str] | None = None, *, root: str | None = None) -> dict[str, Published]:
    """Publish products (all 29, if none are named) under ``root``, a commit per family. They are
    read with ``read_version(spark, name, root=root)``; rejected values as ``rejects``."""
    spark = bundles.sparkSession
    base = (root or f"{shared_dir(spark)}/published").rstrip("/")
    asked = set(PRODUCTS if names is None else names)
    unknown = asked.difference(p for f in FAMILIES.values() for p in f.products)
    if unknown:
        raise ValueError(f"no such products: {sorted(unknown)}")
    out, store = {}, Store(spark, base)
    for name, family in FAMILIES.items():
        mine = [p for p in family.products if p in asked]
        if not mine:
            continue
        frame, seen = family.frame(bundles), Observation()
        metrics = reject_counts() if family.rejects else [F.count_if(F.lit(False)).alias("none")]
        at = f"{base}/frames/{name}-{uuid.uuid4().hex}"
        frame.observe(seen, F.count(F.lit(1)).alias("all_rows"), *metrics).write.parquet(at)
        held = spark.read.schema(frame.schema).parquet(at)
        writes = [Write(p, family.products[p](held)) for p in mine]
        if family.rejects:
            keys = [C.COMPONENT_CODE, C.PATIENT, C.DISPLAY, C.TEXT, C.EFFECTIVE]
            writes.append(Write("rejects", unnest_rejects(held, keys)))
        counts = dict(seen.get)
        rows = counts.pop("all_rows")
        out[name] = Published(store.commit(writes), mine, rows, {k: v or 0 for k, v in counts.items()} if family.rejects else {})
    return out
