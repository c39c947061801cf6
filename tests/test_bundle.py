import datetime as dt

from tests.builders import silver

from ratings_engine.operators.bundle import review_bundle

SEPARATOR = "\n\n---\n\n"


def reviews(product, texts, rating=4.0):
    """Reviews of a product, the first text the newest."""
    return [dict(review_id=f"{product}{i:04}", parent_asin=product, review_text=text, rating=rating,
                 review_timestamp=dt.datetime(2024, 1, 1) - dt.timedelta(minutes=i))
            for i, text in enumerate(texts)]


def bundles(spark, rows, *wanted):
    products = spark.createDataFrame([(p, "Gift_Cards") for p in wanted], "parent_asin string, category string")
    return {r.parent_asin: (r.review_count, r.reviews_block)
            for r in review_bundle(silver(spark, *rows), products).collect()}


def test_blocks_written_out(spark):
    rows = (reviews("edge", ["x" * 500, "y" * 501, "  z" + "w" * 499 + " \n"])
            + reviews("blank", ["", " \n", None, " kept "], None) + reviews("half", ["ok"], 4.5)
            + reviews("none", ["", None]) + reviews("other", ["not wanted"]))
    assert bundles(spark, rows, "edge", "blank", "half", "none", "unknown", "edge") == {
        "edge": (3, "[Rating: 4.0] " + "x" * 500 + SEPARATOR + "[Rating: 4.0] " + "y" * 500 + "..."
                 + SEPARATOR + "[Rating: 4.0] z" + "w" * 499),
        "blank": (1, "[Rating: None] kept"), "half": (1, "[Rating: 4.5] ok")}


def test_newest_fifty_of_which_thirty_are_shown(spark):
    # Of 49, 50 and 51 reviews only the oldest has text; of 31 all have.
    rows = [row for n in (49, 50, 51) for row in reviews(f"n{n}", [""] * (n - 1) + ["oldest"])]
    got = bundles(spark, rows + reviews("n31", [f"t{i}" for i in range(31)]), "n31", "n49", "n50", "n51")
    assert {p: got[p] for p in got if p != "n31"} == {p: (1, "[Rating: 4.0] oldest") for p in ("n49", "n50")}
    assert got["n31"][0] == 30
    assert got["n31"][1].startswith("[Rating: 4.0] t0" + SEPARATOR + "[Rating: 4.0] t1" + SEPARATOR)
    assert got["n31"][1].endswith("[Rating: 4.0] t29")
