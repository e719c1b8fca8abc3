"""One group, contributor or set of copies holds a third of all rows."""

import random

from pyspark.sql import functions as F

from chronoflow.llm.capping import cap_contributors
from chronoflow.llm.neardup import near_duplicates
from chronoflow.llm.topn import top_n


def test_hot_group_and_contributor(spark):
    n = 30_000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 997).cast("string"))).alias("c"), (F.col("id") * 7919 % 101 / 100.0).alias("w"))
    top = top_n(df, ["c"], "w", "id", 2)
    assert top.count() == 2 * 998
    cap = n // 50
    state = cap_contributors(df, F.col("c"), "w", "id", cap)
    assert state.displaced().count() == n // 3 - cap and state.kept.count() == n - (n // 3 - cap)


def test_many_copies(spark):
    rnd = random.Random(1)
    words = [f"n{i}" for i in range(3000)]
    hot = " ".join(words[:20])
    rows = [(i, hot) for i in range(4000)] + [(4000 + i, " ".join(words[:19] + [words[100 + i]])) for i in range(60)] + [(5000 + i, " ".join(rnd.sample(words, 20))) for i in range(8000)]
    found = near_duplicates(spark.createDataFrame(rows, "id bigint, text string"), "id", "text")
    groups = found.groups()
    hot_group = groups.where("group = 0")
    assert hot_group.count() == 4060
    # every edited text is linked to the copies' text and to every other edited one
    assert found.links.count() == 60 + 60 * 59 // 2
    assert groups.count() == len(rows)
