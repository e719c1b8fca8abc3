"""Whole texts and whole tables."""

from chronoflow.llm import q_residue
from chronoflow.llm.truncation import field_limits


def published(spark, folder, schema, rows):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/published.parquet")
    return str(folder)


def test_long_unfilled_places(spark, tmp_path):
    fill = "ruler | name = of the land | reign = from then to now | " * 9
    plain = "the name of the person who held the office in that year and the place " * 9
    bad = [f"The holder is {a}{x}{z} of Lark." for a, x, z in (("{{Infobox ", fill, "}}"), ("<%= ", fill, "%>"), ("{% ", fill, "%}"), ("${", fill, "}"), ("[insert ", fill, "]"), ("<<", plain, ">>"), ("<insert ", fill, ">"))]
    bad.append(f"The holder is [insert {fill}")
    good = [f"The holder is {fill} of Lark.", f"The holder is ({plain}) of Lark."]
    d = published(spark, tmp_path, "row_id bigint, text string", list(enumerate(bad + good)))
    assert sorted(r.row_id for r in q_residue.QUERIES["p4_found"](spark, d).collect()) == list(range(len(bad)))
    assert sorted(r.row_id for r in q_residue.QUERIES["p4_clean"](spark, d).select("row_id").collect()) == [len(bad), len(bad) + 1]


def test_limit_below_longer_exceptions(spark):
    spread = [*range(20, 118, 2)]
    lengths = {"piled": spread + [120] * 30, "one longer": spread + [120] * 30 + [300], "some longer": spread + [120] * 30 + [131, 150, 150, 400], "stray": spread + [120] * 60 + [123], "even": spread * 3, "small": [20, 40, 120]}
    rows = spark.createDataFrame([(s, "x" * n) for s, ns in lengths.items() for n in ns], "s string, x string")
    assert {r.s: r.limit for r in field_limits(rows, "x", "s").collect()} == dict.fromkeys(["piled", "one longer", "some longer", "stray"], 120)
