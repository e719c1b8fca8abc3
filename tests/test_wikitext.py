"""Wikitext functions on worked cases."""

from chronoflow.functions import wikitext as W
from chronoflow.operators import wikitext as X


def test_templates():
    assert W.templates("{{convert|5|ft|6|in|m}} tall") == ("5 ft 6 in tall", True)
    assert W.templates("{{USS|New Jersey|BB-62}} sails") == ("USS New Jersey sails", True)
    assert W.templates("a {{cite web|x={{lang|fr|y}}}} b") == ("a  b", True)
    assert W.templates("{{unknown thing|x}}")[1] is False
    assert W.measure(["1500", "km"]) == "1,500 km" and W.measure(["1", "acre"]) == "1 acre" and W.measure(["3", "furlong"]) is None


def test_lines():
    said, links, good = W.clean_line("* [[March 3]] &ndash; The [[Battle of X|battle]] is won by ''Y''.<ref name=a>[[z]]</ref>")
    assert (said, links, good) == ("March 3 – The battle is won by Y.", ["March 3", "Battle of X"], True)
    assert W.without_media("a [[File:x.jpg|thumb|a [[b]] c]] d") == "a  d"
    for bad in ("* short", "* ends on a colon, as it does:", "* an unpaired (bracket is here", "* left {{over|markup"):
        assert W.clean_line(bad)[2] is False


def test_trees():
    assert W.bullet_tree(["* a", "** b", "*** c", "** d", "* e"]) == [(0, 1, None, "a"), (1, 2, 0, "b"), (2, 3, 1, "c"), (3, 2, 0, "d"), (4, 1, None, "e")]


def test_deep_trees(spark):
    """Beyond six levels too."""
    text = "\n".join("*" * d + " x" for d in (1, 2, 3, 4, 5, 6, 7, 8, 9, 7, 8, 3))
    got = [(r.depth, r.parent) for r in X.bullet_trees(spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, t string"), "id", "t").orderBy("n").collect()]
    assert got == [(1, None), (2, 0), (3, 1), (4, 2), (5, 3), (6, 4), (7, 5), (8, 6), (9, 7), (7, 5), (8, 9), (3, 1)]


def test_grid():
    table = '{| class="wikitable"\n! a !! b\n|-\n| rowspan="2" | x || 1\n|-\n| 2\n|-\n| colspan="2" | y\n|}'
    assert W.grid(table) == [[["a", "b"], ["x", "1"], ["x", "2"], ["y", "y"]]]


def test_terms():
    assert W.terms("1991–1992, 1996–1999") == ([(1991, 1992), (1996, 1999)], [])
    assert W.terms("since 26 September 2017") == ([(2017, None)], [])
    assert W.terms("c. 1200–1210, 1500–") == ([(1500, None)], ["c. 1200–1210"])


def test_main_text():
    page = "<html><head><script>var a='<p>x</p>';</script></head><body><nav>menu</nav><div class='x'><p>One &amp; two.</p><p>Three<br>four</p></div><!-- no --><div class=\"ad\">buy</div><footer>f</footer></body></html>"
    assert W.main_text(page) == "One & two.\nThree\nfour"


def test_claims(spark):
    text = "== Events ==\n* [[May 3]] &ndash; The assembly at Lark elects Dolm as its chancellor.\n* [[May 3]] &ndash; The assembly at Lark elects Dolm as its chancellor.\n* short"
    rows = X.claims(spark.createDataFrame([(1, text, 1500), (2, None, 1500), (3, "", None)], "id int, t string, y int"), "id", "t", "y").collect()
    assert [(r.id, r.n, r.trail, r.links) for r in rows if True] and len(rows) == 1 and rows[0].text.startswith("May 3 – The assembly")
    tree = X.bullet_trees(spark.createDataFrame([(1, "* a\n** b\n*** c\n** d\nx\n* e")], "id int, t string"), "id", "t").orderBy("n").collect()
    assert [(r.n, r.depth, r.parent) for r in tree] == [(0, 1, None), (1, 2, 0), (2, 3, 1), (3, 2, 0), (5, 1, None)]


SOURCE = """{{Year header|1969}}
* a bullet above all sections, which belongs to none of them
== Events ==
<!-- * [[May 1]] &ndash; this line was taken off the page by its editor.
* [[May 2]] &ndash; and so was this one, which is as long. -->
* [[January 26]]
** The assembly at [[Lark]] elects Dolm as its chancellor once more.
** February 10 &ndash; The 17th congress of the guilds of Brook opens.
* September 9 (killed at the battle of Flodden):
** [[James Dolm]], the archbishop of the see of Lark (b. 1473)
:* The river at Brook rises above the walls and floods the market.
* December 7 (December 8 - 3:18 a.m., Eastern Time) - War:
** The fleet at Brook is attacked by ships from the coast of Lark.
* The treaty of Lark ends the war of the two rivers for good.
** a continuation that is long enough to be kept as a sentence here
* too short
=== March ===
* The bridge at Lark is opened to all carts of the valley of Dolm.
==Births==
* [[July 3]] &ndash; Dolm of Lark, physician and author of letters (d. 1999)
* [[July 3]] &ndash; Dolm of Lark, physician and author of letters (d. 1999)
== References ==
* The list of sources that the article rests on, which is no claim.
==Works of art==
* A painting of the bridge, now in the hall of the guild at Brook.
"""


def test_claims_as_written(spark):
    rows = spark.createDataFrame([(1, SOURCE, 1969, "1969")], "id int, t string, y int, title string")
    got = {(r.kind, r.month, r.day, "/".join(r.trail), r.text, r.prefix, r.suffix) for r in X.claims(rows, "id", "t", "y", "title").collect()}
    flodden = "killed at the battle of Flodden"
    assert got == {
        ("event", 1, 26, "Events", "January 26 – The assembly at Lark elects Dolm as its chancellor once more.", "January 26", None),
        ("event", 2, 10, "Events", "February 10 – The 17th congress of the guilds of Brook opens.", None, None),
        ("event", 9, 9, "Events", f"September 9 – James Dolm, the archbishop of the see of Lark (b. 1473) — {flodden}", "September 9", flodden),
        ("event", 9, 9, "Events", f"September 9 – The river at Brook rises above the walls and floods the market. — {flodden}", "September 9", flodden),
        ("event", 12, 7, "Events", "December 7 – The fleet at Brook is attacked by ships from the coast of Lark.", "December 7", None),
        ("event", None, None, "Events", "The treaty of Lark ends the war of the two rivers for good.", None, None),
        ("event", None, None, "Events", "a continuation that is long enough to be kept as a sentence here", None, None),
        ("event", 3, None, "Events/March", "The bridge at Lark is opened to all carts of the valley of Dolm.", None, None),
        ("birth", 7, 3, "Births", "July 3 – Dolm of Lark, physician and author of letters (d. 1999)", None, None),
    }


def test_scope_and_month_markers(spark):
    text = "== Events ==\n* 44: The assembly at Lark elects Dolm as its chancellor.\n* 44–40: The assembly at Brook elects Dolm as its chancellor.\n* The assembly at Tarn elects Dolm as its chancellor.\n=== AD 44 ===\n;May\n* The assembly at Vell elects Dolm as its chancellor."
    rows = spark.createDataFrame([(1, text, 44, "40s"), (2, text, 44, "AD 44")], "id int, t string, y int, title string")
    got = {(r.id.split(":")[0], r.text[-45:], r.month) for r in X.claims(rows.where("id = 1").withColumnRenamed("id", "k"), "k", "t", "y", "title", month_markers=True).collect()}
    assert got == {("44", "The assembly at Lark elects Dolm as its chancellor."[-45:], None), ("44", "The assembly at Vell elects Dolm as its chancellor."[-45:], 5)}
    assert X.claims(rows.where("id = 2").withColumnRenamed("id", "k"), "k", "t", "y", "title").count() == 4
    assert X.claims(rows.limit(0).withColumnRenamed("id", "k"), "k", "t", "y").count() == 0


def test_tables_and_holders(spark):
    table = '{| class="wikitable"\n! a !! b\n|-\n| rowspan="2" | x || 1\n|-\n| 2\n|}'
    rows = spark.createDataFrame([(1, table), (2, None), (3, "no table")], "id int, t string")
    assert [(r.tab, r.row, r.cells) for r in X.tables(rows, "id", "t").orderBy("row").collect()] == [(0, 0, ["a", "b"]), (0, 1, ["x", "1"]), (0, 2, ["x", "2"])]
    lines = spark.createDataFrame([(1, "* [[Dolm]] and [[X|Tarn]], Wardens of [[Lark]] (1991–1992, c. 1993, 1996–)"), (2, "Vell, King (since 26 September 2017)"), (3, None), (4, "no terms at all")], "id int, t string")
    got = {(r.id, r.place, r.person, r.post, r.start, r.until, r.open, r.why) for r in X.holders(lines, "id", "t").collect()}
    assert got == {(1, p, n, "Wardens of Lark", a, b, o, w) for p, n in ((0, "Dolm"), (1, "Tarn")) for a, b, o, w in ((1991, 1992, False, None), (1996, None, True, None), (None, None, False, "c. 1993"))} | {(2, 0, "Vell", "King", 2017, None, True, None)}
