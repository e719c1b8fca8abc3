"""Wikitext to plain sentences: balanced templates, media, links, measures, tables, terms.

What nests (templates, media blocks, tables) needs a scan with a stack and lives in plain functions
that run on Arrow batches; what does not is a chain of expressions in ``chronoflow.operators.wikitext``.
"""

from __future__ import annotations

import html
import re

#: Templates whose text is an argument: name and the argument's position.
KEEP = {"lang": 1, "nowrap": 0, "small": 0, "nobr": 0, "abbr": 0, "transl": 1, "noitalic": 0, "circa": 0, "as of": 0}
#: Units by their sign and plural.
UNITS = {"ft": ("ft", "ft"), "in": ("in", "in"), "m": ("m", "m"), "km": ("km", "km"), "mi": ("mile", "miles"), "kg": ("kg", "kg"), "lb": ("lb", "lb"), "ha": ("ha", "ha"), "acre": ("acre", "acres"), "t": ("t", "t"), "yd": ("yd", "yd"), "km2": ("km²", "km²"), "sqmi": ("sq mi", "sq mi")}
#: Templates that hold nothing of a sentence.
DROP = re.compile(r"(?i)^(?:cite|citation|cn|fact|dubious|sfn|efn|ref|webarchive|dead link|year header|main|see also|anchor|nbsp|when|who|clarify|update|failed verification|better source|page needed)\b")
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def parts_of(template: str) -> list[str]:
    """Arguments of a template's inside, split at bars outside links and templates."""
    out, depth, start = [], 0, 0
    for i, pair in enumerate(zip(template, template[1:] + " ")):
        sign = "".join(pair)
        if sign in ("{{", "[["):
            depth += 1
        elif sign in ("}}", "]]"):
            depth -= 1
        elif sign[0] == "|" and depth <= 0:
            out.append(template[start:i])
            start = i + 1
    return [*out, template[start:]]


def number(text: str) -> str:
    """A figure with commas from four digits on."""
    t = text.replace(",", "").strip()
    whole, dot, rest = t.partition(".")
    return f"{int(whole):,}{dot}{rest}" if whole.isdigit() and len(whole) >= 4 else text.strip()


def measure(args: list[str]) -> str | None:
    """ "5 ft 6 in" of a conversion's arguments: figures with their units, up to the target unit."""
    out, i = [], 0
    args = [a.strip() for a in args if "=" not in a]
    while i + 1 < len(args) and re.fullmatch(r"[\d.,]+", args[i]):
        value, sign = args[i], args[i + 1]
        if sign in ("-", "–", "to", "by", "x", "and") and i + 3 < len(args):
            out += [number(value), sign]
            i += 2
            continue
        if sign not in UNITS:
            return None
        out.append(f"{number(value)} {UNITS[sign][0 if value == '1' else 1]}")
        i += 2
    return " ".join(out) if out else None


def render(inside: str) -> str | None:
    """The text that a template stands for: empty if it holds none, None if it isn't known."""
    args = parts_of(inside)
    name = args[0].strip().lower()
    if DROP.match(name):
        return ""
    if name in ("convert", "cvt"):
        return measure(args[1:])
    if name in ("uss", "hms", "ss", "ship"):
        given = [a.strip() for a in args[1:]]
        return " ".join([args[0].strip().upper(), given[0]]) if name != "ship" and given else " ".join(given[:2]) or None
    if name in KEEP and len(args) > KEEP[name] + 1:
        return args[KEEP[name] + 1].strip()
    return None


def templates(text: str, deepest: int = 6) -> tuple[str, bool]:
    """(text without templates, whether all were known). Inner ones first, ``deepest`` levels."""
    clean = True
    for _ in range(deepest):
        done, at = [], 0
        for m in re.finditer(r"\{\{((?:(?!\{\{|\}\}).)*)\}\}", text, re.S):
            said = render(m.group(1))
            clean &= said is not None
            done += [text[at : m.start()], said or ""]
            at = m.end()
        if not done:
            break
        text = "".join(done) + text[at:]
    return text, clean and "{{" not in text and "}}" not in text


def without_media(text: str) -> str:
    """Text without file and image blocks, links inside them counted."""
    out, at = [], 0
    for m in re.finditer(r"(?i)\[\[(?:file|image):", text):
        if m.start() < at:
            continue
        depth, i = 0, m.start()
        while i < len(text):
            if text.startswith("[[", i):
                depth, i = depth + 1, i + 2
            elif text.startswith("]]", i):
                depth, i = depth - 1, i + 2
                if not depth:
                    break
            else:
                i += 1
        out.append(text[at : m.start()])
        at = i
    return "".join(out) + text[at:]


def clean_line(line: str) -> tuple[str, list[str], bool]:
    """(sentence, links, whether it may be published) of one line of wikitext."""
    t = re.sub(r"(?s)<!--.*?-->", "", line)
    t = re.sub(r"(?is)<ref[^>/]*/>|<ref[^>]*>.*?</ref>", "", t)
    t, known = templates(without_media(t))
    links = [m.group(1).strip() for m in re.finditer(r"\[\[([^\[\]|#]+)[^\[\]]*\]\]", t)]
    t = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", t)
    t = re.sub(r"\[https?://\S+\s+([^\]]*)\]", r"\1", t)
    t = html.unescape(re.sub(r"</?[a-zA-Z][^>]*>", "", t.replace("'''", "").replace("''", "")))
    t = re.sub(r"\s+", " ", t).lstrip(" *:#").rstrip()
    body = re.sub(rf"^(?:(?:{MONTHS})(?: \d{{1,2}})?|\d{{1,2}} (?:{MONTHS}))\s*[–—-]\s*", "", t)
    good = known and len(body) >= 12 and not re.search(r"[\[\]{}|]|^[,;.:)]|:$", body) and t.count("(") == t.count(")") and t.count("“") == t.count("”")
    return t, list(dict.fromkeys(links))[:12], good


def grid(text: str) -> list[list[list[str]]]:
    """Tables of a text as rows of cells, spans filled in."""
    tables, depth, start = [], 0, 0
    for m in re.finditer(r"\{\||\|\}", text):
        if m.group() == "{|":
            depth += 1
            start = m.end() if depth == 1 else start
        elif depth:
            depth -= 1
            if not depth:
                tables.append(text[start : m.start()])
    return [_rows(t) for t in tables]


def _cell(text: str) -> tuple[str, int, int]:
    attrs, bar, rest = text.partition("|")
    if bar and "=" in attrs and "[[" not in attrs and "{{" not in attrs:
        span = {k: int(v) for k, v in re.findall(r'(rowspan|colspan)\s*=\s*"?(\d+)', attrs)}
        return rest.strip(), span.get("rowspan", 1), span.get("colspan", 1)
    return text.strip(), 1, 1


def _rows(table: str) -> list[list[str]]:
    out, open_ = [], {}
    for block in re.split(r"\n\|-[^\n]*", table)[0:]:
        cells = []
        for line in re.findall(r"(?ms)^[|!](?![-+}])(.*?)(?=^[|!]|\Z)", block):
            cells += re.split(r"\|\||!!", line)
        if not cells and not open_:
            continue
        row, col = [], 0
        given = [_cell(c) for c in cells]
        while given or col in open_:
            if col in open_:
                value, left = open_.pop(col)
                row.append(value)
                if left > 1:
                    open_[col] = (value, left - 1)
                col += 1
                continue
            value, down, across = given.pop(0)
            for _ in range(across):
                row.append(value)
                if down > 1:
                    open_[col] = (value, down - 1)
                col += 1
        if row:
            out.append(row)
    return out


def bullet_tree(lines: list[str]) -> list[tuple[int, int, int | None, str]]:
    """(line, depth, parent's line, text) of nested bullets."""
    out, stack = [], []
    for n, line in enumerate(lines):
        if m := re.match(r"^(\*+)\s*(.*)$", line):
            depth = len(m.group(1))
            stack = [s for s in stack if s[0] < depth]
            out.append((n, depth, stack[-1][1] if stack else None, m.group(2)))
            stack.append((depth, n))
    return out


def terms(text: str) -> tuple[list[tuple[int, int | None]], list[str]]:
    """(terms as start and end, parts dropped as vague) of "1991–1992, 1996–" or "since 26 September 2017"."""
    good, vague = [], []
    for part in re.split(r"[,;]", text):
        p = part.strip()
        if re.search(r"(?i)\b(c\.|circa|before|after|early|late|\?)", p):
            vague.append(p)
        elif m := re.fullmatch(r"(?:\d{1,2} \w+ )?(\d{1,4})\s*[–-]\s*(?:(?:\d{1,2} \w+ )?(\d{1,4})|present)?", p):
            good.append((int(m.group(1)), int(m.group(2)) if m.group(2) else None))
        elif m := re.fullmatch(r"since (?:\d{1,2} )?(?:\w+ )?(\d{1,4})", p):
            good.append((int(m.group(1)), None))
        elif m := re.fullmatch(r"\d{1,4}", p):
            good.append((int(p), int(p)))
        elif p:
            vague.append(p)
    return good, vague


def holder_terms(line: str) -> list[tuple[int, str, str, int | None, int | None, str | None]]:
    """(place, person, post, start, end, vague part) of a line of an office list, a row per person and term."""
    opened = line.rfind("(")
    inside, before = (line[opened + 1 :].rstrip(" .)"), line[:opened]) if opened >= 0 and line.rstrip(" .").endswith(")") else ("", line)
    before = re.sub(r"^[*:#\s]+", "", before)
    persons, rest = [], before
    while m := re.match(r"(?:\s*(?:,|and|&)\s*)?\[\[(?:[^\[\]|]*\|)?([^\[\]|]+)\]\]", rest):
        persons.append(m.group(1).strip())
        rest = rest[m.end() :]
    if not persons:
        name, _, rest = before.partition(",")
        persons = [name.strip()] if name.strip() else []
    post = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]+)\]\]", r"\1", rest).strip(" ,–—-")
    good, vague = terms(inside)
    return [(n, p, post, *t) for n, p in enumerate(persons) for t in [*((a, b, None) for a, b in good), *((None, None, v) for v in vague)]]


_SKIP = ("script", "style", "nav", "header", "footer", "aside", "form", "noscript", "template")


def main_text(page: str) -> str:
    """Visible text of an HTML page's content: no scripts, navigation, asides, forms or comments; one line per block."""
    t = re.sub(r"(?s)<!--.*?-->", " ", page)
    for tag in _SKIP:
        t = re.sub(rf"(?is)<{tag}\b.*?</{tag}\s*>", " ", t)
    t = re.sub(r'(?is)<(div|section|ul)\b[^>]*(?:class|id)="[^"]*\b(?:ad|ads|advert|sidebar|menu|cookie)\b[^"]*".*?</\1\s*>', " ", t)
    t = re.sub(r"(?i)<(?:br|/p|/div|/li|/h[1-6]|/tr|/section|/article)\b[^>]*>", "\n", t)
    t = html.unescape(re.sub(r"<[^>]+>", " ", t))
    return "\n".join(x for x in (re.sub(r"[^\S\n]+", " ", line).strip() for line in t.split("\n")) if x)
