"""Problem 4: forms, learned threshold, labelled texts held out, lines written after the labels."""

import random

from chronoflow.llm import residue as R
from chronoflow.llm import residue_labels as L

#: Residue of other wording than any label; no label was taken from it.
FRESH = (
    "Sorry, this article has been removed or moved to another address", "403 - You are not allowed to open this directory", "This video player needs JavaScript, please switch it on", "Please wait… checking your connection before proceeding", "Type your text here",
    "Here goes the introduction text", "[Your company name] was founded in [year]", "Dear ${customer.firstName}, thank you", "<%= user.name %> joined", "Error: database unavailable, please try again", "The requested resource is no longer available (410)",
    "Our website is currently undergoing scheduled maintenance", "Page is loading, please wait", "You have reached the limit of free articles, sign in to read more", "Registrieren Sie sich, um weiterzulesen", "Esta página requiere JavaScript", "Seite nicht gefunden (404)",
    "lorem ipsum dolor sit amet, consectetur", "qwerty asdf test test", "PHP Warning: Undefined variable $x in /srv/index.php on line 8", "Fatal error: out of memory in main.php on line 3", "undefined", "TODO: rewrite this paragraph", "Too many requests. Please try again later",
    "Blocked: your network sent too many requests", "Confirm that you are not a robot to continue", "Cookies must be enabled in order to view this site", "This is sample text. Replace before publishing", "null", "NaN",
)


def corpus(n=4000):
    """Honest sentences; one in ten has words that the labels have too."""
    rnd = random.Random(5)
    name = lambda: "".join(rnd.choice(["ka", "lor", "min", "tes", "vul", "bra"]) for _ in range(3)).title()
    kinds = [
        lambda: f"Page {rnd.randrange(9, 9000)} of the {name()} register, not found since the fire at {name()}, is returned by {name()}.",
        lambda: f"The {name()} service between {name()} and {name()} is temporarily unavailable after {name()} dismisses {rnd.randrange(9, 900)} drivers.",
        lambda: f"The {name()} script is required reading in the schools of {name()} under {name()}, who opens {rnd.randrange(9, 900)} of them.",
        lambda: f"A printing error in the {name()} almanac lists {rnd.randrange(9, 900)} towns that {name()} cannot find.",
        lambda: f"{name()} of {name()} publishes the notation {{x, y}} for pairs, and about {rnd.randrange(9, 99)}% of the holders are paid.",
        lambda: f"The assembly at {name()} elects {name()} to the seat with {rnd.randrange(9, 900)} votes, in the year the bridge is built.",
        lambda: f"{name()} {name()} opens the {name()} infirmary with {rnd.randrange(9, 900)} beds, to the great relief of {name()}.",
        lambda: f"Fire in the {name()} quarter of {name()} leaves {rnd.randrange(9, 900)} families homeless, as {name()} records.",
    ]
    return [rnd.choice(kinds[:5] if i % 10 == 0 else kinds[5:])() for i in range(n)]


def weights(texts):
    words, seen = R.vocabulary(R.flat(L.labelled())), {}
    for x in texts:
        for t in words.intersection(R.tokens(x)):
            seen[t] = seen.get(t, 0) + 1
    return seen, len(texts)


def test_forms():
    assert R.tokens("${ruler} and {x, y} at 50% [LATER Struck] #person_1#.") == ["ruler", "${a}", "and", "x", "{a", "y", "a}", "at", "50", "0%", "later", "[A", "struck", "a]", "person", "1", "#a_a#"]
    assert R.exemplar_tokens("{{…_…}} is … [NAME] <%= … %>") == ["{{a_a}}", "is", "[A]", "<%=", "%>"]
    assert R.tokens("a.b_c d_e x.y 1.5") == ["a", "b", "c", "d", "e", "x", "y", "1", "5"]


def test_learned_and_held_out():
    texts = corpus()
    seen, n = weights(texts)
    exemplars = R.flat(L.labelled())
    need = R.learn(exemplars, L.LOOKALIKES, seen, n)
    assert 0.4 < need < 0.7
    held = R.held_out(exemplars, seen, n)
    assert len(held) > 200 and sum(s >= need for s in held) / len(held) >= 0.85
    index = R.Index(exemplars, seen, n, need)
    assert sum(index.best(x)[0] >= need for x in FRESH) / len(FRESH) >= 0.7
    assert sum(index.best(x)[0] >= need for x in L.LOOKALIKES) <= len(L.LOOKALIKES) / 8
    assert not [x for x in texts if index.best(x)[0] >= need]
    kept = ("The word lorem is printed ten times in the almanac of ipsum dolor", "A sonnet by Dolor Magna Aliqua is read", "The clerk marks [LATER STRUCK OUT] in the margin")
    assert not [x for x in kept if index.best(x)[0] >= need]
    lines = ("Site under maintenance, please check back later", "Please turn off your ad blocker to view this site", "HTTP 410 Gone", "Click here to edit this paragraph", "Erreur 404: page introuvable", "This domain is for sale")
    assert not [x for x in lines if index.best(x)[0] < need]


def test_freely_used_forms_decide_nothing():
    """Where the corpus itself is full of a form, an exemplar of nothing else is no match."""
    exemplars = R.flat(L.labelled())
    index = R.Index(exemplars, {"{{a}}": 5000, "%a": 9000, "s": 9000}, 10_000, 0.55)
    assert index.best("{{cite}} as in the record")[0] < 0.55 and index.best("a %s here")[0] < 0.55
    assert R.Index(exemplars, {"{{a}}": 5}, 10_000, 0.55).best("{{cite}} as in the record")[0] == 1.0


def test_no_hot_token_is_needed_twice():
    """Heads prune: with and without them the same texts match."""
    texts = corpus(300) + list(FRESH)
    seen, n = weights(texts)
    exemplars = R.flat(L.labelled())
    whole, pruned = R.Index(exemplars, seen, n, 0.0), R.Index(exemplars, seen, n, 0.55)
    assert [whole.best(x)[0] >= 0.55 for x in texts] == [pruned.best(x)[0] >= 0.55 for x in texts]
