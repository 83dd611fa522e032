"""Mining reports: time per URL, candidates read once, and bodies of popular assets joined to the winners only."""

from svgspark.operators import mine as M

LOG = "page_id long, url string, attempt int, status int, content_type string, body string, ms int"
ASSETS = "abs_url string, body string, content_type string, status int, ms int"
ICON = '<svg id="i\\"/>'


def tables(spark):
    page = '<p><svg>own</svg><img src="/i.svg"><img src="/gone.svg"></p>'
    log = [(1, "http://a/1", 1, 503, "text/html", "x", 10), (1, "http://a/1", 2, 200, "text/html", page, 20), (1, "http://a/1", 3, 200, "text/html", page, 40),
           (2, "http://a/2", 1, 200, "text/html", '<img src="/i.svg">', 5), (3, "http://a/3", 1, 404, "text/html", page, 7), (3, "http://a/3", 2, 404, "text/html", None, 8),
           (3, "http://a/3", 3, 500, None, None, 9), (3, "http://a/3", 4, 200, "text/html", page, 1), (4, "http://a/4", 1, 200, "image/png", page, 3),
           (5, "http://a/5", 1, 200, "text/html", "", 2)]
    assets = [("http://a/i.svg", ICON, "image/svg+xml", 200, 100), ("http://a/gone.svg", None, "text/html", 404, 1000)]
    return spark.createDataFrame(log, LOG), spark.createDataFrame(assets, ASSETS)


def test_results_per_url(spark):
    got = {r.url[-1]: (r.success, r.svg_matched, r.svg_found, r.svg_saved, r.time_taken) for r in M.url_result(*tables(spark)).collect()}
    assert got == {"1": (True, 1, 2, 2, 1.13), "2": (True, 0, 1, 0, 0.105), "3": (False, 0, 0, 0, 0.024), "4": (False, 0, 0, 0, 0.003), "5": (False, 0, 0, 0, 0.002)}


def test_asset_bodies_join_the_winners(spark):
    log, assets = tables(spark)
    mined = M.mine_svgs(log, assets.unionByName(assets))  # an asset that was fetched twice is one
    assert {(r.page_id, r.svg) for r in mined.collect()} == {(1, "<svg>own</svg>"), (1, '<svg id="i"/>')}
    assert mined.select("hash", "shard").exceptAll(M.mined_hashes(log, assets)).isEmpty()
    plan = M.mined_hashes(log, assets)._jdf.queryExecution().executedPlan().toString()
    assert "_asset#" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_counters(spark):
    r = M.crawl_counters(*tables(spark)).first()
    assert (r.pages_fetched, r.failed_fetches, r.retried_requests, r.svg_saved) == (3, 2, 5, 2)
