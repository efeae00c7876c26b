"""Sink round trip, including column names with spaces."""

from equilibra.plans import PRODUCTS
from equilibra.sources import load_bundle, publish_all, read_published


def test_publish_round_trip(spark, small_bundles):
    b = load_bundle(spark, small_bundles)
    products = {n: PRODUCTS[n](b) for n in ("segment_mean_range", "vision_reported", "session_report")}
    paths = publish_all(products)
    for name, df in products.items():
        back = read_published(spark, name)
        assert back.columns == df.columns
        assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
        assert paths[name].endswith(name)
