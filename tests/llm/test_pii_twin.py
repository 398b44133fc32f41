"""PII surrogates against a plain-Python twin, row by row; what is found, and what is left alone."""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from tallylog.llm import pii

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


# ---------------------------------------------------------------- the twin

def _re(pattern):
    return regex.compile(f"(?V1){pattern}")


ANY, LABEL, SPACE = _re(pii.ANY), _re(pii._LABEL), _re(pii._SPACE)
LEADS = {g: _re(pii._title(g)) for g in pii.TITLES}


def _stream(key, n):
    return "".join(hashlib.sha256(f"{pii.KEY}:{i}:{key}".encode()).hexdigest() for i in range(n // 64 + 1))


def _digits(h):
    return h.translate(str.maketrans("abcdef", "012345"))


def _letters(h):
    return base64.b64encode(bytes.fromhex(h)).decode().lower().translate(str.maketrans("0123456789+/", "abcdefghijkl", "="))


def _refill(form, digits, letters):
    out, at = [], 0
    for c in form:
        if c in "0123456789":
            c, at = digits[at:at + 1], at + 1
        elif c.isalpha():
            c, at = (letters[at:at + 1].upper() if c.isupper() else letters[at:at + 1]), at + 1
        out.append(c)
    return "".join(out)


def _plain(form, h):
    return _refill(form, _digits(h), _letters(h))


def _luhn(number):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(number))) % 10


def _parse(e):
    """kind, lead, core, canon"""
    lead = LABEL.match(e)
    if lead:
        return "secret", lead.group(), e[lead.end():], e[lead.end():]
    if "@" in e:
        return "email", "", e, e.lower()
    if regex.fullmatch("(AKIA|ASIA)[0-9A-Z]{16}", e):
        return "aws_key", "", e, e
    if regex.fullmatch("[0-9]{1,3}([.][0-9]{1,3}){3}", e):
        return "ip", "", e, e
    if regex.fullmatch("[0-9]{3}-[0-9]{2}-[0-9]{4}", e):
        return "ssn", "", e, e
    number = "".join(c for c in e if c in "0123456789")
    if regex.fullmatch("(?:[0-9]{4}[ -]?){3}[0-9]{1,7}", e) and _luhn(number) == 0:
        return "card", "", e, number
    for gender, title in LEADS.items():
        lead = title.match(e)
        if lead:
            core = e[lead.end():]
            return gender + ("_cyrillic" if regex.match(r"\p{IsCyrillic}", core) else ""), lead.group(), core, core
    if e[0] in "+(0123456789" and not regex.fullmatch("(?:[0-9]{4}[ -]?){3}[0-9]{1,7}", e):
        code = _code(e)
        return "phone", "", e, (code or "+1") + "-" + "".join(c for c in e[len(code):] if c in "0123456789")
    return None, "", e, e


def _code(phone):
    m = regex.match(r"\+[0-9]{1,3}(?=[ .(-])|\+[0-9]", phone)
    return m.group() if m else ""


def _word(token):
    return bool(regex.match(r"\p{Lu}", token)) and not token.endswith(".")


def _units(kind, core, canon):
    if kind not in pii.GIVEN:
        return [(kind, canon)]
    *first, last = SPACE.split(core)
    return [(f"given:{kind}", w.lower()) for w in first if _word(w)] + [(f"family:{'cyrillic' if kind.endswith('cyrillic') else 'latin'}", last.lower())]


def _pick(values, h, i):
    values = values.split(" ")
    return values[int(h[2 * i:2 * i + 2], 16) % len(values)]


def _given(gender, word, draw):
    h = _stream(f"{gender}:{word}:{draw}", 2 * draw + 2)
    return "-".join(_pick(pii.GIVEN[gender], h, i) for i in range(draw + 1))


def _family(script, word, draw):
    h = _stream(f"{script}:{word}:{draw}", 2 * draw + 8)
    return "".join(_pick(pii.SYLLABLES[script], h, i) for i in range(draw + 4)).capitalize()


def _drawn(kind, core, canon, draw):
    more = max(draw - pii.KEEP_FORMAT, 0)
    h = _stream(f"{kind}:{canon}:{draw}", 2 * len(core) + 64)
    tail = _digits(h[::-1])[:more]
    if kind == "email":
        local, domain = core.split("@")
        top = regex.search(r"[.]\p{L}+$", domain).group()
        site = _plain(domain[:-len(top)], _stream("domain:" + domain.lower(), 2 * len(domain)))
        return _plain(local, h) + _letters(h[::-1])[:more] + "@" + site + top
    if kind == "ip":
        octet = [str(int(h[4 * i:4 * i + 4], 16) % 254 + 1) for i in range(4)]
        m = regex.match(r"(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|169\.254)\.", canon)
        kept = m.group() if m else ""
        if not kept:
            out = ".".join([str(int(h[:4], 16) % 99 + 11), *octet[1:]])
        elif more:
            out = ".".join(["10", *octet[1:]])
        else:
            out = kept + ".".join(octet[1:] if kept in ("10.", "127.") else octet[2:])
        extra = more - pii.KEEP_FORMAT
        return out + ("-" + _digits(h[::-1])[:extra] if extra > 0 else "")
    if kind == "card":
        body = canon[0] + _digits(h)[1:len(canon) - 1]
        whole = body + str((10 - _luhn(body + "0")) % 10)
        return _refill(core, whole, whole) + tail
    if kind == "phone":
        code, d = _code(core), _digits(h)
        d = d[0].translate(str.maketrans("01", "79")) + d[1:]
        return code + _refill(core[len(code):], d, d) + tail
    if kind == "aws_key":
        return core[:4] + _plain(core[4:], h) + _letters(h[::-1])[:more].upper()
    if kind == "secret":
        if more:
            return _letters(h)[:len(core) + more]
        return h[:len(core)] if regex.fullmatch("[0-9a-f]+", core) else _plain(core, h)
    return _plain(core, h) + tail


def _unit_surrogate(kind, canon, draw):
    family, _, of = kind.partition(":")
    return {"given": _given, "family": _family}[family](of, canon, draw) if of else _drawn(kind, canon, canon, draw)


def _draws(units):
    draw = dict.fromkeys(units, 0)
    taken = {(k, c.lower()) for k, c in units if not k.startswith("given:")}
    while True:
        new = {u: _unit_surrogate(*u, d) for u, d in draw.items()}
        groups = defaultdict(list)
        for (kind, canon), d in draw.items():
            groups[kind, new[kind, canon]].append((d, canon))
        again = {u for u in draw if min(groups[u[0], new[u]]) != (draw[u], u[1]) or (u[0], new[u].lower()) in taken}
        if not again:
            return draw
        for u in again:
            draw[u] += 1


def _cased(new, old):
    return new.upper() if len(old) > 1 and old == old.upper() else new


def _surrogate(kind, core, canon, draw):
    if kind not in pii.GIVEN:
        return _drawn(kind, core, canon, draw[kind, canon])
    script = "cyrillic" if kind.endswith("cyrillic") else "latin"
    *first, last = SPACE.split(core)
    spaces = [*SPACE.findall(core), ""]
    out = []
    for w in first:
        if _word(w):
            out.append(_cased(_given(kind, w.lower(), draw[f"given:{kind}", w.lower()]), w))
        else:
            out.append("".join(_given(kind, c.lower(), 0)[0] + "." for c in regex.findall(r"\p{Lu}", w)) if w.endswith(".") else w)
    out.append(_cased(_family(script, last.lower(), draw[f"family:{script}", last.lower()]), last))
    return "".join(a + b for a, b in zip(out, spaces))


def _replace(text, draw):
    """New text and number of entities."""
    pieces, made, names, n, at = [], [], {}, 0, 0
    for m in ANY.finditer(text):
        kind, lead, core, canon = _parse(m.group())
        pieces.append(text[at:m.start()])
        at = m.end()
        if kind is None:
            made.append(m.group())
            continue
        new = _surrogate(kind, core, canon, draw)
        made.append(lead + new)
        n += 1
        if kind in pii.GIVEN:
            names.setdefault(core, new)
    pieces.append(text[at:])
    if names:
        split = [list(zip(SPACE.split(c), SPACE.split(new))) for c, new in names.items()]
        known = dict(names)
        for words in [[s[-1]] for s in split] + split:
            for w, new in words:
                if _word(w) and len(w) > 1:
                    known.setdefault(w, new)
        longest = sorted(known, key=lambda c: (-len(c), c))
        repeat = regex.compile(r"(?<![\p{L}\p{N}_])(?:" + "|".join(map(regex.escape, longest)) + r")(?![\p{L}\p{N}_])")
        for i, p in enumerate(pieces):
            pieces[i], k = repeat.subn(lambda m: known[m.group()], p)
            n += k
    return "".join(a + b for a, b in zip(pieces, [*made, ""])), n


def _twin(rows):
    units = {u for _, t in rows for m in ANY.finditer(t or "") for p in [_parse(m.group())] if p[0] for u in _units(p[0], p[2], p[3])}
    draw = _draws(units)
    return {i: (None, 0) if t is None else _replace(t, draw) for i, t in rows}


# ---------------------------------------------------------------- tests

FOUND = [
    # text, the parts that must be gone
    ("Mr. McDonald came", ["McDonald", "Donald"]), ("Ms. MacArthur, Mr. DeVito.", ["Arthur", "Vito"]),
    ("Mr. O'Brien's house", ["Brien"]), ("Mr. Łukasz Kowalski", ["ukasz", "Kowalski"]), ("MR. JOHN SMITH", ["JOHN", "SMITH"]),
    ("Mr. John Q. Smith; Smith", ["John", "Smith"]), ("Mr. John Šimek", ["John", "Šimek", "imek"]), ("Herr Ludwig van Beethoven", ["Ludwig", "Beethoven"]),
    ("Mrs. Anne-Marie\nSmith-Jones", ["Anne", "Marie", "Smith", "Jones"]), ("Mr. Иван Петров", ["Иван", "Петров"]), ("Miss Emma Jones", ["Emma Jones"]),
    ("token=" + "a1" * 300 + " end", ["a1a1a1"]), ("password: hunter2.", ["hunter2"]), ("password: p@ss!w0rd9, x", ["p@ss!w0rd9"]),
    ("x@a.b.c.d.e.f.g.h.i.j.com y", ["a.b.c", "i.j"]), ("x@" + ".".join(["wxyzwxyz"] * 300) + ".wxyzw.com.", ["wxyzw"]), ("q" * 100 + "@b.com", ["q" * 30]),
    ("jürgen.müller@bücher.de", ["rgen", "ller", "cher"]), ("call 988-555-2485 or +1 988 555 2485", ["988", "2485"]),
    ("Mr. A" + "-b" * 2_000 + " z", ["-b-b"]),
]
CLEAN = ["Dear Sir Please Call Back", "Miss Universe Pageant", "Don Smith", "Mr. and Mrs. are titles", "the mister smith", "password is required",
         "v1.2.3.4.5 of 2024-01-01", "1234 5678 9012 3456 is no card", "a @ b", "", "Mrs. x"]


def test_found_whole_and_clean_left_alone(spark):
    rows = [(i, t) for i, (t, _) in enumerate(FOUND)] + [(100 + i, t) for i, t in enumerate(CLEAN)] + [(200, None)]
    got = {r.doc_id: r for r in pii.replace_pii(spark.createDataFrame(rows, DOCS)).collect()}
    for i, (text, gone) in enumerate(FOUND):
        assert got[i].n_entities and not [g for g in gone if g in got[i].text], (text[:60], got[i].text[:80])
    assert [got[100 + i].text for i in range(len(CLEAN))] == CLEAN
    want = _twin(rows)
    assert {i: (r.text, r.n_entities) for i, r in got.items()} == want


def test_mentions_agree(spark):
    texts = ["988-555-2485 / +1 988 555 2485 / (988) 555-2485 / +1 (988) 555-2485", "MR. JOHN SMITH, Mr. John Smith, Smith", "Mr. J. Smith and Mr. John Q. Smith"]
    got = [r.text for r in sorted(pii.replace_pii(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect())]
    assert len({"".join(c for c in p if c.isdigit())[-10:] for p in got[0].split(" / ")}) == 1
    loud, calm, alone = got[1].split(", ")
    assert loud == calm.upper() and calm.endswith(alone)
    assert got[2].count(alone) == 2


def test_table_equals_the_twin(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.text, r.n_entities) for r in pii.replace_pii(docs).collect()}
    want = _twin(rows)
    assert sum(n for _, n in want.values()) > 20
    assert got == want


@pytest.mark.parametrize("weak", [False, True])
def test_collisions_equal_the_twin(spark, monkeypatch, weak):
    rows = [(i, f"{c}@x.com and 192.168.1.{i + 1} with Mr. {w} Smith{c}") for i, (c, w) in enumerate(zip("abcdefghijklmnopqrst", ["John", "Jim", "Bob", "Al"] * 5))]
    if weak:  # few given names, so that many collide
        monkeypatch.setitem(pii.GIVEN, "male", "James Robert")
    got = {r.doc_id: (r.text, r.n_entities) for r in pii.replace_pii(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == _twin(rows)
    assert len({t for t, _ in got.values()}) == len(rows)


def test_columns_of_any_name_are_kept(spark):
    docs = spark.createDataFrame([(1, "Mr. John Smith")], DOCS).withColumns({"a.b": F.lit(7), "core": F.lit("x"), "n_entities": F.lit("old")})
    row = pii.replace_pii(docs).first()
    assert row["a.b"] == 7 and row["core"] == "x" and row["n_entities"] == 1
