"""Path data as columns: compact arc flags, numbers that make no whole command."""

import pytest
from pyspark.sql import functions as F

from svgspark.operators import geom as G
from svgspark.operators import normalize as N

SHORT, BEFORE = "path data: numbers missing or left over", "path data: numbers before the first command"
ARC = [1.0, 1.0, 0.0, 0.0, 1.0, 2.0, 2.0]
ROWS = {
    "10 10 M1 2": ([("M", [1.0, 2.0])], BEFORE),
    "10 10": ([], BEFORE),
    "M0 0a1 1 0 01 2 2": ([("M", [0.0, 0.0]), ("a", ARC)], None),
    "a1 1 0 012 2": ([("a", ARC)], None),
    "M0 0A1,1,0,0,1,2,2 1 1 0 012 2": ([("M", [0.0, 0.0]), ("A", ARC), ("A", ARC)], None),
    "M0 0a1.5.5-30 10-.5.25.5.5 0 1 0 1-1z": ([("M", [0.0, 0.0]), ("a", [1.5, 0.5, -30.0, 1.0, 0.0, -0.5, 0.25]), ("a", [0.5, 0.5, 0.0, 1.0, 0.0, 1.0, -1.0]), ("z", [])], None),
    "M0 0a1 1 0 0 1 22": ([("M", [0.0, 0.0])], SHORT),
    "M0 0A1 1 0 2 1 5 5 1 1 0 012 2 3": ([("M", [0.0, 0.0]), ("A", [1.0, 1.0, 0.0, 2.0, 1.0, 5.0, 5.0])], SHORT),
    "M0 0L1 1 2": ([("M", [0.0, 0.0]), ("L", [1.0, 1.0])], SHORT),
    "M0 0C1 1 2 2": ([("M", [0.0, 0.0])], SHORT),
    "M0 0L": ([("M", [0.0, 0.0])], SHORT),
    "M0 0Z1": ([("M", [0.0, 0.0]), ("Z", [])], SHORT),
    "M0 0L1 1z": ([("M", [0.0, 0.0]), ("L", [1.0, 1.0]), ("z", [])], None),
    "": ([], None),
    None: ([], None),
}


def test_commands_and_reasons(spark):
    df = spark.createDataFrame([(d,) for d in ROWS], "d string").withColumn("t", G.path_tokens("d")).withColumn("i", G.command_index("t"))
    got = {r.d: r for r in df.select("d", G.path_commands("t", "i").alias("c"), G.path_reason("t", "i").alias("reason")).collect()}
    for d, (want, reason) in ROWS.items():
        assert [(c.cmd, c.args) for c in got[d].c] == want, d
        assert got[d].reason == reason, d


@pytest.mark.parametrize("d, status, reason", [("M0 0L1 1 2", "parse_error", SHORT), ("1 M0 0L1 1", "parse_error", BEFORE), ("M0 0a1 1 0 01 2 2", "ok", None)])
def test_normalize_names_torn_paths(spark, d, status, reason):
    svg = f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 128 128"><path d="M0 0L10 10L20 20L30 30Z"/><path d="{d}"/></svg>'
    r = N.normalize_corpus(spark.createDataFrame([(1, svg)], "rec_id long, svg string")).collect()
    assert [(x.status, x.reason) for x in r] == [(status, reason)]
    assert (r[0].svg_out is None) == (status != "ok")


def test_paths_of_many_commands(spark):
    n = 60_000
    d = "M0 0" + "h1v1" * (n // 2) + "z"
    toks = spark.range(1).select(G.path_tokens(F.concat(F.lit(d), F.col("id").cast("string").substr(2, 1))).alias("t"))
    cmds = toks.withColumn("i", G.command_index("t")).select(G.path_commands("t", "i").alias("c"))
    r = cmds.select(G.path_absolute("c").alias("s")).select(F.size("s").alias("n"), F.element_at("s", -1)["p0"].alias("end"), F.element_at("s", 1025)["pts"][0].alias("p")).first()
    assert (r.n, r.end.x, r.end.y, r.p.x, r.p.y) == (n + 2, n / 2, n / 2, 512, 512)
