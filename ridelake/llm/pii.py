"""Personal data replaced by surrogates of the same kind (DataFrame functions only).

Found are e-mail addresses, IBANs, IPv4 addresses, card numbers, US social security numbers, telephone numbers, and
persons: a form of address with one to three names, or a known given name with a family name.

*Keyed and consistent.* A surrogate is a function of a secret key and of what the entity says, not how it is
written: telephone numbers with other punctuation get the same digits, an e-mail domain the same domain, a family
name the same family name, alone or after a given name. So entities that are one stay one, in all documents.

*Same kind and look.* Digits become digits, letters letters of the same script; punctuation, the country code of a
number with a plus sign (of others the first digit), the country of an IBAN and a card's first digit stay, and check
digits are valid where they were. Given names are exchanged within a list of the same gender and script, by a shift that
the key chooses; family names are built of syllables, with the feminine ending where the script has one, and keep
capitals throughout and hyphens; each part of a double name is a name of its own. Addresses come out in lower case.

*Distinct.* All entities of the corpus are compared once, mail domains for themselves: where two would share a surrogate,
or a surrogate is itself an entity of the corpus, all but one draw again, until nothing collides. Later draws of names,
mail domains and what stands before them are longer, so that short ones do not run out. Draws after the first are few, as there are
some hundred million names; up to ``REDRAWN_BYTES`` of them go into the plan as a map, and texts are rewritten where they
lie. Beyond, texts meet theirs by a join.

A null text stays null. Text around entities does not change.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.shared import stored

KEY = "ridelake-surrogates-1"
REDRAWN_BYTES = 64 * 1024

# Own tables. The lists of a script have the same meaning in the same order of genders.
TITLES = {
    "m": ["Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Госпожа"],
    "n": ["Dr", "Prof"],
}
GIVEN = {
    ("m", "latin"): ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Charles", "Daniel", "Peter",
                     "Paul", "Hans", "Klaus", "Stefan", "Jürgen", "Pierre", "Jacques", "Luc", "Carlos", "Juan", "José",
                     "Miguel", "Antonio"],
    ("f", "latin"): ["Mary", "Anna", "Linda", "Susan", "Sarah", "Emma", "Laura", "Julia", "Alice", "Claire", "Marie",
                     "Sophie", "Camille", "Ursula", "Heike", "Sabine", "Petra", "Carmen", "Lucía", "Elena", "Isabel",
                     "Rosa", "Pilar"],
    ("m", "cyrillic"): ["Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай", "Андрей"],
    ("f", "cyrillic"): ["Анна", "Мария", "Елена", "Ольга", "Ирина", "Наталья", "Светлана"],
}
# Beginnings, vowels and ends of syllables; three syllables give 480 cubed and 700 cubed names.
SYLLABLES = {
    "latin": ["b c d f g h k l m n p r s t v w", "a e i o u", "l m n r s t"],
    "cyrillic": ["б в г д з к л м н п р с т ф", "а е и о у", "в к л м н п р с т х"],
}
# Country codes of one and two digits; all others have three.
COUNTRY_CODE = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"

_NAME = r"\p{Lu}[\p{L}'’-]+"
_ANY_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
_ANY_GIVEN = "|".join(n for names in GIVEN.values() for n in names)
# In the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.]?\d)",
    "card": r"(?<![\w+-])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])\+\d{8,15}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\w)"
             r"|(?<![\w-])\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?![\w-])",
    "person": rf"(?=\p{{Lu}})(?<!\p{{L}})(?:(?:{_ANY_TITLE})\.? {_NAME}(?: {_NAME}){{0,2}}|(?:{_ANY_GIVEN}) {_NAME})",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# A quick look at a text: nothing is found in one without either. Only at capitals are names compared.
_HINTS = [r"[@\d]", rf"(?=\p{{Lu}})(?<!\p{{L}})(?:{_ANY_TITLE}|{_ANY_GIVEN})\.? \p{{Lu}}"]
_CASES = {"lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789"}


def kind_of(entity: Column) -> Column:
    found = F
    for kind, pattern in PATTERNS.items():
        found = found.when(entity.rlike(f"^(?:{pattern})$"), F.lit(kind))
    return found


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where it is used within lambdas."""
    return F.transform(F.array(value), use)[0]


def _digest(*parts: Column | str) -> Column:
    return F.sha2(F.concat_ws("\u0001", *[F.lit(p) if isinstance(p, str) else p for p in parts]), 512)


def _number(hexed: Column, i: Column | int) -> Column:
    """The i-th of the digest's 60 numbers, which come round again."""
    at = (F.lit(i) if isinstance(i, int) else i) % 60 * 2 + 1
    return F.conv(hexed.substr(at.cast("int"), F.lit(4)), 16, 10).cast("int")


def _characters(text: Column, use) -> Column:
    """The text with each character (and its place from 0) replaced."""
    places = F.sequence(F.lit(1), F.length(text))
    return F.when(F.length(text) == 0, F.lit("")).otherwise(F.array_join(
        F.transform(places, lambda i: use(text.substr(i, F.lit(1)), i - 1)), ""))


def _classwise(text: Column, hexed: Column) -> Column:
    def drawn(alphabet: str, i: Column) -> Column:
        return F.lit(alphabet).substr(_number(hexed, i) % len(alphabet) + 1, F.lit(1))
    return _characters(text, lambda c, i: F.when(c.rlike("[a-z]"), drawn(_CASES["lower"], i)).when(
        c.rlike("[A-Z]"), drawn(_CASES["upper"], i)).when(c.rlike("[0-9]"), drawn(_CASES["digit"], i)).otherwise(c))


def _check_digit(digits: Column) -> Column:
    """The digit that completes ``digits`` to a number with a valid check sum (modulus 10)."""
    def weighted(i: Column) -> Column:
        d = digits.substr(i, F.lit(1)).cast("int")
        doubled = F.when((F.length(digits) - i) % 2 == 0, d * 2).otherwise(d)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + weighted(i))
    return ((10 - total % 10) % 10).cast("string")


def _mod97(text: Column) -> Column:
    """Remainder of digits and capitals (A is 10) by 97."""
    def step(rest: Column, i: Column) -> Column:
        c = text.substr(i, F.lit(1))
        return F.when(c.rlike("[0-9]"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), step)


def _longer(drawn: Column, h: Column, attempt: Column) -> Column:
    letters = F.transform(F.sequence(F.lit(1), attempt), lambda i: F.lit(_CASES["lower"]).substr(
        _number(h, i + 40) % 26 + 1, F.lit(1)))
    return F.when(attempt == 0, drawn).otherwise(F.concat(drawn, F.array_join(letters, "")))


def canonical(kind: Column, entity: Column) -> Column:
    """What an entity says. Persons are taken apart before (see ``units``)."""
    digits = F.regexp_replace(entity, "[^0-9]", "")
    return F.when(kind == "email", F.lower(entity)).when(
        kind == "iban", F.regexp_replace(entity, " ", "")).when(
        kind.isin("card", "ssn"), digits).when(
        kind == "phone", F.concat(F.when(entity.startswith("+"), F.lit("+")).otherwise(F.lit("")), digits)).otherwise(entity)


def surrogate(kind: Column, said: Column, attempt: Column, key: str) -> Column:
    """The canonical surrogate of a canonical unit."""
    def drawn(h: Column) -> Column:
        local, domain = F.split_part(said, F.lit("@"), F.lit(1)), F.split_part(said, F.lit("@"), F.lit(2))
        host, top = F.regexp_extract(said, r"^(.*)\.([a-z]+)$", 1), F.regexp_extract(said, r"^(.*)\.([a-z]+)$", 2)
        # Domains are drawn for themselves, distinctly; so addresses need be distinct within theirs only.
        email = F.concat(_longer(_classwise(local, h), h, attempt), F.lit("@"), domain)
        hosts = F.concat(_longer(_classwise(host, h), h, attempt), F.lit("."), top)
        country, account = said.substr(F.lit(1), F.lit(2)), said.substr(F.lit(5), F.length(said))
        checked = _mod97(F.concat(account, said.substr(F.lit(1), F.lit(4)))) == 1
        iban = _bound(_classwise(account, h), lambda new: F.concat(country, F.when(checked, F.lpad(
            (98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")).otherwise(
            _classwise(said.substr(F.lit(3), F.lit(2)), h)), new))
        octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_number(h, i * 2) % 254 + 1).cast("string")), ".")
        body = F.concat(said.substr(F.lit(1), F.lit(1)), _classwise(said.substr(F.lit(2), F.length(said) - 2), h))
        valid = _check_digit(said.substr(F.lit(1), F.length(said) - 1)) == said.substr(F.length(said), F.lit(1))
        card = F.when(valid, F.concat(body, _bound(body, _check_digit))).otherwise(
            F.concat(body, _classwise(said.substr(F.length(said), F.lit(1)), h)))
        # Area 001 to 665, no group or serial of zeros.
        ssn = F.concat(F.lpad((_number(h, 0) % 665 + 1).cast("string"), 3, "0"),
                       F.lpad((_number(h, 2) % 99 + 1).cast("string"), 2, "0"),
                       F.lpad((_number(h, 4) % 9999 + 1).cast("string"), 4, "0"))
        stays = F.when(said.startswith("+"), F.concat(F.lit("+"), F.regexp_extract(said, COUNTRY_CODE, 1))).otherwise(
            said.substr(F.lit(1), F.lit(1)))
        phone = F.concat(stays, _classwise(said.substr(F.length(stays) + 1, F.length(said)), h))
        return (F.when(kind == "email", email).when(kind == "host", hosts).when(kind == "iban", iban).when(kind == "ip", octets)
                .when(kind == "card", card).when(kind == "ssn", ssn).when(kind == "phone", phone)
                .otherwise(_family(kind, h, attempt)))
    return _bound(_digest(key, kind, attempt.cast("string"), said), drawn)


def _family(kind: Column, h: Column, attempt: Column) -> Column:
    """Three syllables, and one more for every further draw, in lower case. Kinds are family_<gender>_<script>."""
    def of(script: str) -> Column:
        def sound(i: Column, at: int) -> Column:
            letters = SYLLABLES[script][at].split()
            return F.element_at(F.array(*[F.lit(x) for x in letters]), _number(h, i * 6 + 2 * at) % len(letters) + 1)
        return F.array_join(F.transform(F.sequence(F.lit(0), attempt + 2), lambda i: F.concat(
            sound(i, 0), sound(i, 1), sound(i, 2))), "")
    return F.when(kind.endswith("latin"), of("latin")).when(
        kind == "family_f_cyrillic", F.concat(of("cyrillic"), F.lit("ова"))).otherwise(
        F.concat(of("cyrillic"), F.lit("ов")))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"^\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))


def _gender(entity: Column) -> Column:
    first = F.regexp_extract(entity, r"^([\p{L}]+)", 1)
    given = F.regexp_extract(entity, rf"(?:^|\. | )({_ANY_GIVEN})(?= |$)", 1)
    found = F
    for gender in ("m", "f"):
        names = [n for (g, _), names in GIVEN.items() if g == gender for n in names]
        found = found.when(first.isin(TITLES[gender]) | given.isin(names), F.lit(gender))
    return found.otherwise(F.lit("n"))


def _shifted_given(word: Column, key: str) -> Column:
    """Another name of the list, by a shift over it: distinct for distinct names, and never the same name."""
    found = F
    for (gender, script), names in GIVEN.items():
        table = F.array(*[F.lit(n) for n in names])
        shift = _number(_digest(key, "given", gender, script), 0) % (len(names) - 1) + 1
        place = (F.array_position(table, word).cast("int") - 1 + shift) % len(names) + 1
        found = found.when(word.isin(names), F.element_at(table, place))
    return found


def _all_given() -> list[str]:
    return [n for names in GIVEN.values() for n in names]


def _all_titles() -> list[str]:
    return [x for titles in TITLES.values() for t in titles for x in (t, f"{t}.")]


def units(entity: Column) -> Column:
    """Array of (kind, said): an entity's parts that need a surrogate; a person's are its family names."""
    def of(kind: Column) -> Column:
        names = F.filter(F.split(entity, " "), lambda w: ~w.isin(_all_titles() + _all_given()))
        parts = F.filter(F.flatten(F.transform(names, lambda w: F.split(w, "-"))), lambda w: F.length(w) > 0)
        family = F.transform(parts, lambda w: F.struct(
            F.concat(F.lit("family_"), F.when(_script(w) == "cyrillic", F.when(
                _gender(entity) == "f", F.lit("f")).otherwise(F.lit("m"))).otherwise(F.lit("n")),
                F.lit("_"), _script(w)).alias("kind"), F.lower(w).alias("said")))
        mail = F.lower(entity)
        addresses = F.array(F.struct(F.lit("email").alias("kind"), mail.alias("said")), F.struct(
            F.lit("host").alias("kind"), F.split_part(mail, F.lit("@"), F.lit(2)).alias("said")))
        return F.when(kind == "person", family).when(kind == "email", addresses).otherwise(
            F.array(F.struct(kind.alias("kind"), canonical(kind, entity).alias("said"))))
    return _bound(kind_of(entity), of)


def _written(entity: Column, kind: Column, new: Column) -> Column:
    """The canonical surrogate in the writing of the entity: its digits or characters one after another."""
    def spread(pattern: str) -> Column:
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
        def step(done, i):
            c = entity.substr(i, F.lit(1))
            taken = c.rlike(pattern)
            return F.struct(
                F.concat(done["out"], F.when(taken, new.substr(done["at"], F.lit(1))).otherwise(c)).alias("out"),
                F.when(taken, done["at"] + 1).otherwise(done["at"]).alias("at"))
        return F.aggregate(F.sequence(F.lit(1), F.length(entity)), start, step, lambda done: done["out"])
    new = F.when(kind == "phone", F.ltrim(new, F.lit("+"))).otherwise(new)
    return F.when(kind.isin("card", "ssn", "phone"), spread("[0-9]")).when(
        kind == "iban", spread("[A-Z0-9]")).otherwise(new)


def replacement(entity: Column, attempts: Column | None, key: str) -> Column:
    """The surrogate of an entity as written. ``attempts``: map from ``kind|said`` to draws after the first."""
    def draws(unit: Column) -> Column:
        if attempts is None:
            return F.lit(0)
        return F.coalesce(attempts[F.concat_ws("|", unit["kind"], unit["said"])], F.lit(0))

    def one(unit: Column) -> Column:
        return _bound(surrogate(unit["kind"], unit["said"], draws(unit), key),
                      lambda new: _written(entity, unit["kind"], new))

    def of(parts: Column) -> Column:
        return _bound(F.transform(parts, one), lambda new: put_together(parts, new))

    def put_together(parts: Column, new: Column) -> Column:
        kind = F.get(parts, F.lit(0))["kind"]
        mail = F.concat(F.split_part(F.get(new, F.lit(0)), F.lit("@"), F.lit(1)), F.lit("@"), F.get(new, F.lit(1)))
        said = F.transform(parts, lambda p: p["said"])

        def family(word: Column) -> Column:
            """The surrogate of a family name, in its capitals."""
            drawn = F.get(new, F.array_position(said, F.lower(word)).cast("int") - 1)
            return F.when(F.length(word) == 0, word).when(
                (F.upper(word) == word) & (F.length(word) > 1), F.upper(drawn)).otherwise(F.initcap(drawn))
        person = F.array_join(F.transform(F.split(entity, " "), lambda w: F.when(w.isin(_all_titles()), w).when(
            w.isin(_all_given()), _shifted_given(w, key)).otherwise(
            F.array_join(F.transform(F.split(w, "-"), family), "-"))), " ")
        return F.when(kind == "email", mail).when(
            kind.isNotNull() & ~kind.startswith("family_"), F.get(new, F.lit(0))).otherwise(person)
    return _bound(units(entity), of)


def entities(text: Column) -> Column:
    none = F.expr("cast(array() as array<string>)")
    hinted = text.rlike(_HINTS[0]) | text.rlike(_HINTS[1])
    return F.when(hinted, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)


def redrawn(docs: DataFrame, key: str = KEY) -> DataFrame:
    """kind, said, attempt of the units that collide at the first draw, with a draw that does not."""
    all_units = docs.select(F.explode(entities(F.col("text"))).alias("entity")).distinct().select(
        F.explode(units(F.col("entity"))).alias("unit")).select("unit.*").distinct()
    drawn = stored(all_units.withColumn("attempt", F.lit(0)), "units")
    real = drawn.select("kind", F.col("said").alias("new"))
    while True:
        named = drawn.withColumn("new", surrogate(F.col("kind"), F.col("said"), F.col("attempt"), key))
        # Draws that are not the first of their surrogate; a group is as small as chance makes collisions.
        order = Window.partitionBy("kind", "new").orderBy("attempt", "said")
        losers = named.withColumn("place", F.row_number().over(order)).where("place > 1").select(
            "kind", "said").union(named.join(real, ["kind", "new"], "left_semi").select("kind", "said")).distinct()
        losers = stored(losers.withColumn("again", F.lit(1)), "collisions")
        if losers.isEmpty():
            return drawn.where("attempt > 0")
        drawn = stored(drawn.join(losers, ["kind", "said"], "left").select(
            "kind", "said", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt")), "units")


def _rewrite(text: Column, found: Column, attempts: Column | None, key: str) -> Column:
    pieces = F.split(text, ANY, -1)
    new = F.transform(found, lambda entity: replacement(entity, attempts, key))
    joined = F.array_join(F.transform(F.arrays_zip(
        F.slice(pieces, F.lit(1), F.size(found)).alias("before"), new.alias("new")),
        lambda x: F.concat(x["before"], x["new"])), "")
    return F.when(F.size(found) == 0, text).otherwise(F.concat(joined, F.element_at(pieces, -1)))


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, text with surrogates, and the number of entities of each kind, for every row of ``docs``."""
    again = redrawn(docs, key)
    rows = docs.select("doc_id", "text").withColumn("found", entities(F.col("text")))
    counts = [F.size(F.filter(F.coalesce(F.transform("found", kind_of), F.array().cast("array<string>")), lambda k: k == kind)
                     ).cast("long").alias(f"n_{kind}") for kind in PATTERNS]
    size = again.agg(F.sum(F.octet_length("said") + F.octet_length("kind") + 12)).first()[0] or 0
    if size <= REDRAWN_BYTES:
        draws = {f"{row['kind']}|{row['said']}": row["attempt"] for row in again.collect()}
        attempts = F.from_json(F.lit(json.dumps(draws)), "map<string,int>") if draws else None
        return rows.select("doc_id", _rewrite(F.col("text"), F.col("found"), attempts, key).alias("text"), *counts)
    # Only texts with an entity that drew again need the table; they meet it by digest, equal texts once.
    keyed = rows.withColumn("text_key", F.when(F.size("found") > 0, F.sha2("text", 256)))
    used = keyed.where("text_key IS NOT NULL").select("text_key", "found").dropDuplicates(["text_key"]).select(
        "text_key", F.explode("found").alias("entity")).select("text_key", F.explode(units(F.col("entity"))).alias("u"))
    maps = used.select("text_key", "u.*").distinct().join(again, ["kind", "said"]).groupBy("text_key").agg(
        F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "said"), "attempt"))).alias("attempts"))
    with_map = keyed.where("text_key IS NOT NULL").join(maps, "text_key", "left").select(
        "doc_id", _rewrite(F.col("text"), F.col("found"), F.col("attempts"), key).alias("text"), *counts)
    return with_map.union(keyed.where("text_key IS NULL").select("doc_id", "text", *counts))
