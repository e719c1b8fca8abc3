"""Problem 6: round trips of every pair of encodings, evidence for lost letters, letter-pair statistics."""

import pytest

from chronoflow.llm import mojibake as M

TEXTS = ("Zoë at Škofja in Łódź – “naïve”", "the café", "Ærø, Ťažko, Žďár", "Ștefan of Țara", "Việt Ðorin")


@pytest.mark.parametrize("encoding", [*M.COMMON, *M.OTHERS])
def test_rounds(encoding):
    """One to seven misreadings come back, whatever the first one was."""
    own = M.repairer()
    for text in TEXTS:
        bad = text
        for n in range(7):
            bad = M.misread(bad.encode(), encoding if n == 0 else "cp1252")
            assert own.repair(bad) == (text, True, False), (n, bad)


@pytest.mark.parametrize("pair", M.CYRILLIC)
def test_one_byte_cyrillic(pair):
    own = M.repairer()
    for word in ("Лышон", "Мослова", "Щолаго Чыне", "Дон", "Чыне"):
        text = f"born Ðorin ({word}) at Žal"
        assert own.repair(f"born Ðorin ({M.misread(word.encode(pair[0]), pair[1])}) at Žal") == (text, True, False)


@pytest.mark.parametrize("pair,text", [(("cp1252", "mac_roman"), "the café of Zürich"), (("cp1252", "cp437"), "the crêpe of Grünau"), (("mac_roman", "cp1252"), "the café of Zürich")])
def test_one_byte_western(pair, text):
    assert M.repairer().repair(M.misread(text.encode(pair[0]), pair[1])) == (text, True, False)


def test_other_scripts():
    own = M.repairer()
    for text in ("日本語のテキスト", "שלום", "العربية"):
        assert own.repair(M.misread(text.encode(), "cp1252"))[0] == text


def test_correct_text_stays():
    own = M.repairer()
    for text in ("See page?id=3 for more", "Who goes there?asked the guard", "Why?", "çà et là", "Привет мир", "МОСКВА", "日本語", "Ça va, où ça?", "in the local tongue Лышон", "50 % ± 3", "100 ‰", "Ý ½ ¾"):
        assert own.repair(text) == (text, False, False), text


def test_lost_letters():
    own = M.repairer()
    for text in ("Lae?dian yields", "taken at ?uneiika in spring", "To�dourn", "The castle of Fukriâ", "Fempa? and D?astiwol rule", "What did Lae?dian say to D?astiwol"):
        fixed, found, lost = own.repair(text)
        assert lost and not found and fixed == text, text
    fixed, found, lost = own.repair("FeilohoarnÅ¡tad and BrÃtad")  # what followed the second lead is gone
    assert fixed == "Feilohoarnštad and BrÃtad" and found and lost


def test_letter_pairs(spark):
    """Pairs of the corpus tell readings apart where the prior can't."""
    rows = spark.createDataFrame([("Лышон и Лышон",), ("уСФБО",), (None,), ("plain",)], "x string")
    got = M.letter_pairs(rows, "x")
    assert got == {"лы": 2, "ыш": 2, "шо": 2, "он": 2}
    assert M.Repair({"щы": 500})._usual("щыщы") > M.Repair()._usual("щыщы")
