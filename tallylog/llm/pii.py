"""PII surrogates, in DataFrame operations only.

Each detected entity is replaced by a keyed surrogate of its type and format: the
digits and letters come from a keyed hash of the entity, so an entity has the same
surrogate wherever it occurs. Marks, letter case, digit counts, the country code of
a phone number, the issuer digit and check digit of a card, the top domain of an
address, the prefix of a key, and the private range of a network address stay; the
replacement of a name has its gender and script.

Names are found behind a title and replaced word by word: the family name follows
from the surname alone, and a given name from the given name and gender, so the
mentions of a person agree. Where a text holds a name behind a title, the untitled
repeats of that name, of its surname and of its given names are replaced as well.

Distinctness: the distinct units (entities; of names, the words) are counted and
their surrogates compared. A surrogate that two units share, or that is itself a
unit of the documents (a given name may be), is drawn anew (the smallest unit keeps
it) until no collision is left. Draws after KEEP_FORMAT grow by a character each, and
names with every draw, so no format can be used up: addresses get a longer local
part, numbers and keys more characters, secrets other letters, and private network
addresses go to 10.*, then get a suffix. Only the units drawn anew are looked up
by the rewriting, which draws all the others in place. So texts without an entity are
never shuffled; those with one are joined with the draws, by the hash of the text, if
any unit was drawn anew (Spark broadcasts the draws while they are few).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallylog.llm.common import let, stage, table

KEY = "tallylog-surrogates-1"
#: Draws that keep the format; each one after them adds a character.
KEEP_FORMAT = 4

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: A word of a name, whole: any Latin or Cyrillic letters after a capital, inner capitals, hyphens and apostrophes.
_LETTER = r"[\p{IsLatin}\p{IsCyrillic}\p{M}]"
_CAPITAL = r"[\p{Lu}&&[\p{IsLatin}\p{IsCyrillic}]]"
_WORD = rf"{_CAPITAL}{_LETTER}*+(?:-{_LETTER}++|['\u2019]{_CAPITAL}{_LETTER}*+)*+(?![\p{{L}}\p{{N}}_])"
_INITIALS = rf"(?:{_CAPITAL}\.)++"
_SPACE = r"[\s\u00A0]"
#: Words in lower case that stand within names.
PARTICLES = "van von der den de del della di da dos du la le ten ter zu bin ibn al el"
_PARTICLE = f"(?:{'|'.join(PARTICLES.split())})"
_NAME = rf"(?:(?:{_INITIALS}|{_WORD}|{_PARTICLE}){_SPACE}){{0,4}}{_WORD}"
_ALONE = r"(?<![\p{L}\p{N}_])"

#: Titles by gender. The second line of each are words of other meanings too, and count in front of a known given name only.
TITLES = {
    "male": "Mr Mister Monsieur Herrn Herr Señor г-н господин",
    "female": "Mrs Ms Madame Mme Mlle Frau Señorita Señora Doña г-жа госпожа",
}
WEAK_TITLES = {
    "male": "Sir Don",
    "female": "Miss Madam",
}
#: Given names by gender and script, then consonants and vowels of family names by script.
GIVEN = {
    "male": "James Robert Michael David Thomas Daniel Paul Mark Peter Simon Martin Victor Hugo Louis Felix Oscar "
            "Adam Bruno Carl Edward Frank George Henry Isaac Jacob Leon Max Nathan Otto Philip Ralph Walter",
    "female": "Mary Anna Laura Susan Emma Julia Sarah Helen Clara Alice Marie Nora Ruth Vera Lucy Sofia "
              "Amelia Bella Carla Diana Edith Flora Grace Hanna Irene Judith Karen Linda Monica Olivia Paula Rosa",
    "male_cyrillic": "Иван Пётр Павел Олег Игорь Роман Антон Максим Борис Семён Денис Артём Глеб Фёдор Егор Тимур "
                     "Андрей Богдан Вадим Виктор Герман Даниил Захар Илья Кирилл Лев Марк Никита Руслан Степан Юрий Яков",
    "female_cyrillic": "Анна Мария Ольга Елена Ирина Вера Нина Дарья Юлия Алла Софья Полина Лидия Раиса Тамара Зоя "
                       "Алиса Белла Валерия Галина Диана Ева Жанна Инна Кира Лариса Марина Надежда Римма Светлана Ульяна Яна",
}
SYLLABLES = {
    "latin": " ".join(c + v for c in "bdfghjklmnprstvz" for v in "aeio"),
    "cyrillic": " ".join(c + v for c in "бвгдзклмнпрстфхц" for v in "аеио"),
}
#: Labels in front of secrets.
LABELS = "(?i:access_token|token|password|passwd|secret|api_key|apikey)"
_LABEL = f"{LABELS}[ ]?[=:][ ]?[\"']?"
#: A secret ends with white space, a quote or a mark that separates, and not with the mark of a sentence.
_SECRET = r"[^\s\"'<>,;]"
_SECRET_END = r"[^\s\"'<>,;.!?:)\]}]"


def _any_case(titles: str) -> str:
    """Titles as they are and in capitals; the longer first."""
    both = {t for title in titles.split() for t in (title, title.upper())}
    return "|".join(sorted(both, key=lambda t: (-len(t), t)))


def _title(gender: str) -> str:
    """A title with what stands between it and the name."""
    given = "|".join(" ".join(GIVEN[g] for g in GIVEN if g.startswith(gender)).split())
    after = rf"(?:\.{_SPACE}{{0,3}}|{_SPACE}{{1,3}})"
    return rf"(?:(?:{_any_case(TITLES[gender])}){after}|(?:{_any_case(WEAK_TITLES[gender])}){after}(?=(?i:{given})(?![\p{{L}}\p{{N}}_])))"


_FIRST_OF_TITLES = "".join(sorted({c[0] for t in (*TITLES.values(), *WEAK_TITLES.values()) for w in t.split() for c in (w, w.upper())}))


def _alone_after(first: str, *patterns: str) -> str:
    """Any of some patterns, tried only at the characters that they can begin with."""
    return f"(?=[{first}])(?:{'|'.join(patterns)})"


#: What an entity looks like, in order of precedence; a secret comes with its label and a name with its title.
EMAIL = r"(?<![\p{L}\p{N}_.+%-])[\p{L}\p{N}][\p{L}\p{N}_.+%-]*+@(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]*+(?<!-))\.(?=[\p{L}\p{N}]))++\p{L}{2,}+(?!\p{N})"
OTHERS = "|".join([
    _alone_after("aApPsStT", rf"(?<![A-Za-z0-9]){_LABEL}(?:{_SECRET}{{7,}}|(?={_SECRET}*+(?<=[0-9]{_SECRET}{{0,7}})){_SECRET}{{3,6}}){_SECRET_END}"),
    _alone_after("A", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"),
    _alone_after(
        "0-9(+",
        rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        r"(?<![0-9+])(?:[0-9]{4}[ -]?){3}[0-9]{1,7}(?![0-9])",
        r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])",
        r"(?<![0-9(])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"),
    _alone_after(_FIRST_OF_TITLES, *[f"{_ALONE}{_title(gender)}{_NAME}" for gender in TITLES]),
])
ANY = f"{EMAIL}|{OTHERS}"


def _by_pattern(text: Column, use: Callable[[str], Column]) -> Column:
    """``use`` of the pattern of all entities; for a text without the sign of an address, of that of the others."""
    return F.when(F.contains(text, F.lit("@")), use(ANY)).otherwise(use(OTHERS))


_SOME_TITLE = rf"(?=[{_FIRST_OF_TITLES}])(?:{'|'.join(_any_case(t) for t in (*TITLES.values(), *WEAK_TITLES.values()))})[.\s\u00A0]"


def may_hold(text: Column) -> Column:
    """What a text with an entity holds: a digit or the sign of an address, the beginning of a key, a label or a title.
    It is faster to look for."""
    labelled = (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & text.rlike(LABELS)
    return text.rlike("[0-9@]") | F.contains(text, F.lit("AKIA")) | F.contains(text, F.lit("ASIA")) | labelled | text.rlike(_SOME_TITLE)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits, modulo 10."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10


def parse_entity(e: Column) -> Column:
    """struct(kind, lead, core, canon) of a match; kind is null where it is no entity after all.

    ``lead`` (label or title) stays; ``core`` is replaced; ``canon`` is what makes two entities the same: an
    address in lower case, the country code and digits of a phone number, the digits of a card.
    """
    card = r"^(?:[0-9]{4}[ -]?){3}[0-9]{1,7}$"
    kind = F.when(e.rlike(f"^{_LABEL}"), "secret").when(e.contains("@"), "email").when(e.rlike("^(AKIA|ASIA)[0-9A-Z]{16}$"), "aws_key")
    kind = kind.when(e.rlike("^[0-9]{1,3}([.][0-9]{1,3}){3}$"), "ip").when(e.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
    kind = kind.when(e.rlike(card), F.when(_luhn(_digits(e)) == 0, "card"))
    lead = F.regexp_extract(e, f"^(?:{_LABEL}|" + "|".join(_title(gender) for gender in TITLES) + ")", 0)
    core = F.substring(e, F.length(lead) + 1, F.length(e))
    script = F.when(core.rlike(r"^\p{IsCyrillic}"), "_cyrillic").otherwise("")
    for gender in TITLES:
        kind = kind.when(e.rlike(f"^{_title(gender)}"), F.concat(F.lit(gender), script))
    kind = kind.when(e.rlike("^[+(0-9]"), "phone")
    code = _country_code(core)
    canon = (F.when(kind == "email", F.lower(core)).when(kind == "card", _digits(core))
             .when(kind == "phone", F.concat(F.when(code == "", "+1").otherwise(code), F.lit("-"), _digits(F.substring(core, F.length(code) + 1, F.length(core)))))
             .otherwise(core))
    return F.struct(kind.alias("kind"), lead.alias("lead"), core.alias("core"), canon.alias("canon"))


def _country_code(phone: Column) -> Column:
    """The country code that a number is written with; numbers in US form without one are of +1."""
    return F.regexp_extract(phone, r"^(\+[0-9]{1,3}(?=[ .(-])|\+[0-9])", 1)


def _stream(key: Column, length: Column) -> Column:
    """At least ``length`` hex digits of the keyed hash of ``key``."""
    parts = F.transform(F.sequence(F.lit(0), F.floor(length / 64).cast("int")),
                        lambda i: F.sha2(F.concat(F.lit(KEY), F.lit(":"), i.cast("string"), F.lit(":"), key).cast("binary"), 256))
    return F.array_join(parts, "")


def _as_digits(hex_: Column) -> Column:
    return F.translate(hex_, "abcdef", "012345")


def _refill(form: Column, digits: Column, letters: Column) -> Column:
    """``form`` with its i-th letter or digit replaced by the i-th of ``letters`` or ``digits``, in its case."""
    def step(a: Column, c: Column) -> Column:
        at = a["at"]
        letter = F.substring(letters, at, F.lit(1))
        new = F.when(c.rlike("[0-9]"), F.substring(digits, at, F.lit(1))).when(c.rlike(r"\p{Lu}"), F.upper(letter)).when(c.rlike(r"\p{L}"), letter)
        return F.struct(F.concat(a["s"], F.coalesce(new, c)).alias("s"), (at + F.when(new.isNull(), 0).otherwise(1)).alias("at"))

    return F.aggregate(F.split(form, ""), F.struct(F.lit("").alias("s"), F.lit(1).alias("at")), step, lambda a: a["s"])


def _as_letters(hex_: Column) -> Column:
    """Letters of all the alphabet: two for three hex digits."""
    return F.translate(F.lower(F.base64(F.unhex(hex_))), "0123456789+/=\r\n", "abcdefghijkl")


def _plain(form: Column, hex_: Column) -> Column:
    return _refill(form, _as_digits(hex_), _as_letters(hex_))


def _one_of(lists: dict[str, str], which: Column) -> Column:
    """The list of values of a kind, as an array."""
    out = F.when(F.lit(False), F.lit(""))
    for name, values in lists.items():
        out = out.when(which == name, values)
    return F.split(out, " ")


def _pick(values: Column, hex_: Column, i: Column) -> Column:
    """One of the values, by the ``i``-th two digits of ``hex_``."""
    return F.get(values, F.conv(F.substring(hex_, 1 + 2 * i, F.lit(2)), 16, 10).cast("int") % F.size(values))


def _script(gender: Column) -> Column:
    return F.when(gender.endswith("cyrillic"), "cyrillic").otherwise("latin")


def _named(lists: dict[str, str], which: Column, word: Column, draw: Column, n: Column, between: str) -> Column:
    """``n`` values of a list, by the keyed hash of a word."""
    both = F.struct(_stream(F.concat_ws(":", which, word, draw.cast("string")), 2 * n).alias("h"), _one_of(lists, which).alias("values"))
    return let(both, lambda x: F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: _pick(x["values"], x["h"], i)), between))


def _given(gender: Column, word: Column, draw: Column) -> Column:
    """The given name for one; draw n has n + 1 names, joined by a hyphen."""
    return _named(GIVEN, gender, word, draw, draw + 1, "-")


def _family(script: Column, word: Column, draw: Column) -> Column:
    """The family name for a surname; draw n has n + 4 syllables."""
    return F.initcap(_named(SYLLABLES, script, word, draw, draw + 4, ""))


def _is_word(token: Column) -> Column:
    """Is a token of a name a word, and neither initials nor a particle?"""
    return token.rlike(r"^\p{Lu}") & ~token.endswith(".")


def _tokens(name: Column) -> Column:
    return F.split(name, _SPACE)


def units(entity: Column) -> Column:
    """array of struct(kind, canon): what of an entity (struct of parse_entity) has a surrogate of its own: names by words,
    in whatever letter case."""
    def unit(kind: Column, canon: Column) -> Column:
        return F.struct(kind.alias("kind"), canon.alias("canon"))

    kind = entity["kind"]
    tokens = _tokens(entity["core"])
    given = F.transform(F.filter(F.slice(tokens, F.lit(1), F.size(tokens) - 1), _is_word), lambda w: unit(F.concat(F.lit("given:"), kind), F.lower(w)))
    script = F.when(kind.endswith("cyrillic"), "family:cyrillic").otherwise("family:latin")
    return F.when(kind.isin(*GIVEN), F.concat(given, F.array(unit(script, F.lower(F.element_at(tokens, -1)))))).otherwise(F.array(unit(kind, entity["canon"])))


def _in_case(new: Column, old: Column) -> Column:
    return F.when((F.length(old) > 1) & (old == F.upper(old)), F.upper(new)).otherwise(new)


def surrogate(entity: Column, draw_of: Callable[[Column, Column], Column]) -> Column:
    """The surrogate of an entity's core (struct of parse_entity), without lead; null for no entity.

    ``draw_of`` gives the draw of a unit by its kind and canon. Of a name, particles and the
    spaces between words stay, and initials become others.
    """
    kind, core = entity["kind"], entity["core"]
    tokens = _tokens(core)
    given, family = F.concat(F.lit("given:"), kind), F.concat(F.lit("family:"), _script(kind))

    def word(w: Column) -> Column:
        """Of a token of a name but the last: a given name, initials or a particle."""
        drawn = F.transform(F.when(w.endswith("."), F.regexp_extract_all(w, F.lit(r"\p{Lu}"), F.lit(0))).otherwise(F.array(w)),
                            lambda c: let(F.when(w.endswith("."), 0).otherwise(draw_of(given, F.lower(c))), lambda d: _given(kind, F.lower(c), d)))
        return F.when(_is_word(w), _in_case(drawn[0], w)).when(
            w.endswith("."), F.array_join(F.transform(drawn, lambda n: F.concat(F.substring(n, 1, 1), F.lit("."))), "")).otherwise(w)

    first = F.transform(F.slice(tokens, F.lit(1), F.size(tokens) - 1), word)
    last = let(F.element_at(tokens, -1), lambda w: let(draw_of(family, F.lower(w)), lambda d: _in_case(_family(_script(kind), F.lower(w), d), w)))
    spaces = F.concat(F.regexp_extract_all(core, F.lit(_SPACE), F.lit(0)), F.array(F.lit("")))
    name = F.array_join(F.zip_with(F.concat(first, F.array(last)), spaces, lambda a, b: F.concat(a, b)), "")
    return (F.when(kind.isNull(), F.lit(None).cast("string")).when(kind.isin(*GIVEN), name)
            .otherwise(let(draw_of(kind, entity["canon"]), lambda d: _drawn(entity, d))))


def unit_surrogate(kind: Column, canon: Column, draw: Column) -> Column:
    """The surrogate of a unit, as ``surrogate`` puts it in the place of the unit's canon."""
    of = F.substring_index(kind, ":", -1)
    return (F.when(kind.isNull(), F.lit(None).cast("string")).when(kind.startswith("given:"), _given(of, canon, draw))
            .when(kind.startswith("family:"), _family(of, canon, draw))
            .otherwise(_drawn(F.struct(kind.alias("kind"), canon.alias("core"), canon.alias("canon")), draw)))


def _drawn(entity: Column, draw: Column) -> Column:
    """The surrogate, in the given draw, of the core of an entity that is no name."""
    kind, core, canon = entity["kind"], entity["core"], entity["canon"]
    key = F.concat(kind, F.lit(":"), canon, F.lit(":"), draw.cast("string"))
    more = F.greatest(draw - KEEP_FORMAT, F.lit(0))

    def digits(hex_: Column, n: Column) -> Column:
        """``n`` digits for the end of a number; they are apart from those within it."""
        return F.substring(_as_digits(F.reverse(hex_)), F.lit(1), n)

    def email(hex_: Column) -> Column:
        local, domain = F.substring_index(core, "@", 1), F.substring_index(core, "@", -1)
        top = F.regexp_extract(domain, r"[.]\p{L}+$", 0)
        site = F.substring(domain, F.lit(1), F.length(domain) - F.length(top))
        site_hex = _stream(F.concat(F.lit("domain:"), F.lower(domain)), 2 * F.length(domain))
        longer = F.substring(_as_letters(F.reverse(hex_)), F.lit(1), more)
        return F.concat(_plain(local, hex_), longer, F.lit("@"), _plain(site, site_hex), top)

    def octet(hex_: Column, i: int) -> Column:
        return (F.conv(F.substring(hex_, 1 + 4 * i, 4), 16, 10).cast("int") % 254 + 1).cast("string")

    def ip(hex_: Column) -> Column:
        kept = F.regexp_extract(canon, r"^(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|169\.254)\.", 0)
        fresh = F.concat_ws(".", (F.conv(F.substring(hex_, 1, 4), 16, 10).cast("int") % 99 + 11).cast("string"), *[octet(hex_, i) for i in (1, 2, 3)])
        two = F.concat_ws(".", octet(hex_, 2), octet(hex_, 3))
        wide = F.concat(F.lit("10."), octet(hex_, 1), F.lit("."), two)
        new = F.when(kept == "", fresh).when(more > 0, wide).when(kept.rlike("^(10|127)"), F.concat(kept, octet(hex_, 1), F.lit("."), two))
        suffix = F.when(more > KEEP_FORMAT, F.concat(F.lit("-"), digits(hex_, more - KEEP_FORMAT))).otherwise("")
        return F.concat(new.otherwise(F.concat(kept, two)), suffix)

    def card(hex_: Column) -> Column:
        n = F.length(canon)
        body = F.concat(F.substring(canon, 1, 1), F.substring(_as_digits(hex_), F.lit(2), n - 2))
        whole = let(body, lambda b: F.concat(b, ((F.lit(10) - _luhn(F.concat(b, F.lit("0")))) % 10).cast("string")))
        return F.concat(let(whole, lambda w: _refill(core, w, w)), digits(hex_, more))

    def phone(hex_: Column) -> Column:
        code = _country_code(core)
        d = _as_digits(hex_)
        d = F.concat(F.translate(F.substring(d, 1, 1), "01", "79"), F.substring(d, F.lit(2), F.length(d)))
        rest = F.substring(core, F.length(code) + 1, F.length(core))
        return F.concat(code, _refill(rest, d, d), digits(hex_, more))

    def key_id(hex_: Column) -> Column:
        return F.concat(F.substring(core, 1, 4), _plain(F.substring(core, F.lit(5), F.length(core)), hex_),
                        F.upper(F.substring(_as_letters(F.reverse(hex_)), F.lit(1), more)))

    def secret(hex_: Column) -> Column:
        other = F.when(more > 0, F.substring(_as_letters(hex_), F.lit(1), F.length(core) + more))
        return other.when(core.rlike("^[0-9a-f]+$"), F.substring(hex_, F.lit(1), F.length(core))).otherwise(_plain(core, hex_))

    hex_ = _stream(key, 2 * F.length(core) + 64)
    return let(hex_, lambda h: (
        F.when(kind == "email", email(h)).when(kind == "ip", ip(h)).when(kind == "card", card(h)).when(kind == "phone", phone(h))
        .when(kind == "aws_key", key_id(h)).when(kind == "secret", secret(h)).when(kind == "ssn", F.concat(_plain(core, h), digits(h, more)))))


def _matches(text: Column) -> Column:
    """All matches in a text, in order; an empty array for a null text or one without."""
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(may_hold(text), _by_pattern(text, lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(0)))), none)


def redraws(entities: DataFrame) -> DataFrame:
    """The units (kind, canon; distinct) whose first surrogate collides: kind, canon, draw.

    A surrogate collides with a unit of its kind, itself included (but not with a
    given name), and with the surrogate of a unit that has an earlier draw or, in the
    same draw, is smaller. As draws grow, there is always a next one to settle it.
    """
    entities = stage(entities, "pii-entities")
    taken = entities.filter(~F.col("kind").startswith("given:")).select(F.col("kind").alias("k"), F.col("canon").alias("c"))
    drawn = entities.withColumn("draw", F.lit(0))
    while True:
        drawn = stage(drawn.withColumn("new", unit_surrogate(F.col("kind"), F.col("canon"), F.col("draw"))), "pii-drawn")
        place = F.row_number().over(Window.partitionBy("kind", "new").orderBy("draw", "canon"))
        clash = drawn.withColumn("place", place).join(taken, (F.col("kind") == F.col("k")) & (F.lower("new") == F.lower("c")), "left")
        marked = stage(clash.select("kind", "canon", "draw", ((F.col("place") > 1) | F.col("c").isNotNull()).alias("again")).distinct(), "pii-marked")
        if marked.filter("again").isEmpty():
            return marked.filter("draw > 0").select("kind", "canon", "draw")
        drawn = marked.select("kind", "canon", (F.col("draw") + F.col("again").cast("int")).alias("draw"))


def _repeats(pieces: Column, names: Column) -> Column:
    """``pieces`` of a text as struct(s, n): with the untitled repeats of ``names`` (struct(core, new)) replaced, and how many.

    A repeat is a whole name, its surname or one of its given names (no initials, no
    particles), in the same letter case and no part of a longer word; the longest goes first.
    """
    def words(part: Callable[[Column], Column]) -> Column:
        pairs = F.flatten(F.transform(names, lambda x: F.arrays_zip(part(_tokens(x["core"])).alias("core"), part(_tokens(x["new"])).alias("new"))))
        return F.filter(pairs, lambda x: _is_word(x["core"]) & (F.length(x["core"]) > 1))

    # of words that are both, the surname counts
    known = F.array_distinct(F.concat(names, words(lambda w: F.slice(w, F.size(w), F.lit(1))), words(lambda w: w)))
    by_length = F.sort_array(F.array_distinct(F.transform(known, lambda x: F.struct(F.length(x["core"]).alias("l"), x["core"].alias("core")))), False)

    def replaced(piece: Column, known: Column, pattern: Column) -> Column:
        found = F.regexp_extract_all(piece, pattern, F.lit(0))
        new = F.transform(found, lambda m: F.element_at(F.filter(known, lambda x: x["core"] == m), 1)["new"])
        rest = F.zip_with(F.split(piece, pattern, -1), F.concat(new, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
        return F.struct(F.array_join(rest, "").alias("s"), F.size(found).alias("n"))

    pattern = F.concat(F.lit(f"{_ALONE}(?:"), F.array_join(F.transform(by_length["core"], lambda c: F.replace(c, F.lit("."), F.lit("[.]"))), "|"), F.lit(r")(?![\p{L}\p{N}_])"))
    both = F.struct(known.alias("known"), pattern.alias("pattern"))
    return let(both, lambda x: F.transform(pieces, lambda p: replaced(p, x["known"], x["pattern"])))


def replace_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the entities of ``text`` replaced by surrogates; n_chars, where there, follows the new length.

    Adds ``n_entities`` (int, replaced if there). A null text stays null, with 0
    entities; a text without entities stays as it is. Repeated rows are replaced
    alike. An untitled repeat of a name counts as an entity. An empty table gives no
    rows. Texts of any length are searched whole. Other columns, of any name, are kept;
    those of the names __m, __e, __p, __names, __mark, __draws are not allowed.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns]
    found = docs.select(F.explode(_matches(F.col(text))).alias("m")).select(parse_entity(F.col("m")).alias("e"))
    of_each = found.filter("e.kind is not null").select(F.explode(units(F.col("e"))).alias("u"))
    entities = of_each.groupBy("u.kind", "u.canon").agg(F.count(F.lit(1)).alias("n")).select("kind", "canon")
    again = stage(redraws(entities), "pii-redraws")

    def rewritten(df: DataFrame, draw_of) -> DataFrame:
        pieces = _by_pattern(F.col(text), lambda p: F.split(F.col(text), p, -1))
        e = F.transform(F.col("__m"), lambda m: let(parse_entity(m), lambda x: let(surrogate(x, draw_of), lambda new: F.struct(
            F.coalesce(F.concat(x["lead"], new), m).alias("s"), x["kind"].isNotNull().cast("int").alias("n"),
            F.when(x["kind"].isin(*GIVEN), F.struct(x["core"].alias("core"), new.alias("new"))).alias("name")))))
        df = df.withColumn("__e", F.when(F.size("__m") > 0, e)).withColumn("__names", F.array_distinct(F.filter("__e.name", lambda x: x.isNotNull())))
        same = F.transform(pieces, lambda p: F.struct(p.alias("s"), F.lit(0).alias("n")))
        df = df.withColumn("__p", F.when(F.size("__names") > 0, _repeats(pieces, F.col("__names"))).when(F.size("__m") > 0, same))
        new = F.array_join(F.zip_with("__p.s", F.concat(F.col("__e.s"), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
        df = df.withColumn(text, F.when(F.col("__e").isNotNull(), new).otherwise(F.col(text)))
        df = df.withColumn("n_entities", F.coalesce(F.aggregate(F.concat("__e.n", "__p.n"), F.lit(0), lambda a, b: a + b), F.lit(0)))
        if "n_chars" in docs.columns:
            changed = F.col("n_entities") > 0
            df = df.withColumn("n_chars", F.when(changed, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
        return df.select(*kept, *(["n_entities"] if "n_entities" not in docs.columns else []))

    rows = docs.withColumn("__m", _matches(F.col(text)))
    if again.isEmpty():
        return rewritten(rows, lambda kind, canon: F.lit(0))
    # texts with an entity that was drawn anew get its draws, by their hash; the others stay where they are
    mark = F.sha2(F.col(text).cast("binary"), 256)
    with_any = rows.filter(F.size("__m") > 0).withColumn("__mark", mark)
    each = with_any.select("__mark", F.explode("__m").alias("m")).select("__mark", parse_entity(F.col("m")).alias("e")).select("__mark", F.explode(units(F.col("e"))).alias("u")).select("__mark", "u.kind", "u.canon")
    draws = (each.join(again, ["kind", "canon"]).groupBy("__mark")
             .agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws(":", "kind", "canon"), "draw"))).alias("__draws")))
    some = rewritten(with_any.join(draws, "__mark", "left"), lambda kind, canon: F.coalesce(
        F.try_element_at(F.col("__draws"), F.concat_ws(":", kind, canon)), F.lit(0)))
    return some.unionByName(rewritten(rows.filter(F.size("__m") == 0), lambda kind, canon: F.lit(0)))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with surrogates for their PII."""
    return replace_pii(table(spark, sf_dir, "documents"))
