"""Residue, truncation and encoding damage."""

import random

import pytest

from chronoflow.llm.mojibake import misread, repair_encoding, repairer
from chronoflow.llm.residue import residue
from chronoflow.llm.truncation import truncated

SCHEMA = "id bigint, text string, site string, k string, x string, limit int"


def frame(spark, texts, site="s"):
    return spark.createDataFrame([(i, t, site, None, "x", 1) for i, t in enumerate(texts)], SCHEMA)


def test_residue(spark):
    bad = [
        "{{event_name}} is held at Brook.", "The ship reaches [INSERT place] under Dolm.", "%s becomes %s of Lark.", "404 - the page “Lark” was not found on this server.",
        "Please enable JavaScript to read Lark. Request 77", "Lorem ipsum dolor sit amet labore.", "Access denied. You do not have permission to view /lark on this server.",
    ]
    good = [
        "Page 41 of the Lark register, not found since the fire at Brook, is returned by Dolm.", "The Lark script is required reading in the schools of Brook.", "A printing error in the Lark almanac lists 24 towns.",
        "The gatekeepers of Lark deny access to Dolm and 12 followers.", "Dolm publishes the notation {x, y} for pairs.", "About 50% of the holders of Lark bonds are paid.", None, "", "  ", "word " * 20_000,
    ]
    df = frame(spark, bad + good + bad[:2])
    got = sorted(r.id for r in residue(df, "id", "text").collect())
    assert got == [*range(len(bad)), len(bad) + len(good), len(bad) + len(good) + 1]
    assert residue(frame(spark, []), "id", "text").count() == 0


def sentences(n, seed):
    rnd = random.Random(seed)
    name = lambda: "".join(rnd.choice(["ka", "lor", "min", "tes", "vul", "bra"]) for _ in range(3)).title()
    kinds = [
        lambda: f"The assembly at {name()} elects {name()} {name()} as chancellor over the rival {name()}, and the news spreads within {rnd.randrange(2, 90)} days.",
        lambda: f"{name()} {name()} opens the {name()} infirmary with {rnd.randrange(2, 900)} beds, to the great relief of the whole coast.",
        lambda: f"Fire in the {name()} quarter of {name()} leaves {rnd.randrange(2, 900)} families homeless, which {name()} later calls the worst mistake of the reign.",
    ]
    return [rnd.choice(kinds)() for _ in range(n)]


def test_truncation_held_out(spark):
    rnd = random.Random(4)
    whole, held = sentences(1500, 1), sentences(300, 2)
    cut = [t[: rnd.randrange(30, len(t) - 12)] + rnd.choice(["", "", "…"]) for t in held[:150]]
    bare = [t[:-1] for t in held[150:]]
    out = {r.id: r.cut for r in truncated(frame(spark, whole + cut + bare + [None, "", " "]), "id", "text", "site").collect()}
    assert len(out) == 1800
    found = sum(out[1500 + i] for i in range(150))
    false = sum(out[i] for i in range(1500)) + sum(out[1650 + i] for i in range(150))
    assert found >= 135 and false <= 15
    assert truncated(frame(spark, []), "id", "text", "site").count() == 0
    assert not any(r.cut for r in truncated(frame(spark, ["One.", "Two"]), "id", "text", "site").collect())


@pytest.mark.parametrize("encoding", ["cp1252", "latin-1", "cp1250", "mac_roman"])
def test_round_trip(encoding):
    own = repairer()
    for text in ("Zoë at Škofja in Łódź – “naïve”", "the café", "Ærø, Ťažko, Žďár"):
        bad = misread(text.encode(), encoding)
        assert own.repair(bad)[:2] == (text, True), bad
        twice = misread(bad.encode(), "cp1252")
        assert own.repair(twice)[0] == text, twice


def test_cyrillic_and_mixed():
    own = repairer()
    word = "Лышон".encode("koi8-r").decode("cp1251")
    assert own.repair(f"born Ðorin ({word}) at Žal")[0] == "born Ðorin (Лышон) at Žal"
    bad = misread("Щолаго Чыне".encode(), "cp1251")
    assert own.repair(f"Žal ({bad}).")[0] == "Žal (Щолаго Чыне)."


def test_repair_frame(spark):
    good = ["Žofín, Łâckøst and Ânskur", "for £40 at 3½ miles’ distance (€ 12 in today’s money)", "(in the local tongue Лышон)", "plain", "Why?", None, "", " "]
    bad = ["FeilohoarnÅ¡tad", "Lae?dian yields", "To�dourn", "krã¸atoakium survey of fokgreizo"]
    rows = {r.id: r for r in repair_encoding(frame(spark, good + bad + bad[:1]), "id", "text").collect()}
    assert sorted(rows) == [8, 9, 10, 11, 12]
    assert rows[8].restored == "Feilohoarnštad" and rows[8].complete
    assert not rows[9].complete and not rows[10].complete
    assert rows[11].restored == "krøatoakium survey of fokgreizo"
    assert repair_encoding(frame(spark, []), "id", "text").count() == 0
