"""Surrogates for personal data, in DataFrame functions only.

Every entity that a pattern finds gets a replacement drawn by a keyed hash: the same kind of thing in the same format, the
same one for the same entity wherever it stands. All entities of the corpus are drawn together and checked: where two would share a
replacement, or a replacement is itself a real entity of the corpus, the later ones are drawn again.

A person is found by titles ("Mrs Anna Weber", "Prof. Dr. J. R. Smith", "Mr van der McDonald"); from then on the text is searched for the bare name and surname too. Surnames and given
names are entities of their own: a surname has one surrogate everywhere, so "Ms Weber" and "Weber" follow "Anna Weber", and a given name is drawn for each full name. Particles ("van
der") stay; initials move on in the alphabet by a step that follows from the surrogate, so that different initials stay different.

A bare surname is no person where it begins another name ("King County"). One that the text also has in lower case as a word, or that is an auxiliary verb, is a person only
inside a sentence and before no word such as "you" or "the" ("Will you come"); a bare mention of Mrs May that opens a sentence therefore stays, and "in May" goes.

Found are: emails, phone numbers, payment cards, IBANs, SSNs, IPv4 and IPv6 (also shortened), MACs, secrets by their look or after a word such as password,
and persons with a title of _TITLES. Not found are persons that no title ever precedes in the text, given names standing alone, names in capitals throughout, postal addresses and dates.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "г-жа", "κυρία"),
    "m": ("Mr", "Herr", "Señor", "Monsieur", "г-н", "κύριος"),
    "x": ("Dr", "Prof"),
}
_TITLE = "(?:" + "|".join(t for ts in _TITLES.values() for t in ts) + ")"
#: Titles in a row, the spaces between them included; none of them is taken for a name.
_TITLED = rf"{_TITLE}(?:\.? (?:{_TITLE}(?![\p{{L}}\p{{N}}])|(?:med|phil|jur|rer|nat|habil)(?=\.))){{0,5}}+\.? "
_FIRST_OF_TITLE = "(?=[" + "".join(sorted({t[0] for ts in _TITLES.values() for t in ts})) + "])"
#: A word of a name: Weber, McDonald, O'Neill, Meyer-DeVito. It ends where letters end.
_PART = r"(?:\p{Lu}['’])?(?:\p{Lu}[\p{Ll}\p{M}]+)+"
_NAME = rf"(?!{_TITLE}(?![\p{{L}}\p{{N}}])){_PART}(?:['’-]{_PART})*+(?![\p{{L}}\p{{M}}\p{{N}}])"
_LETTERS = r"(?:\p{Lu}(?:\. ?| )){1,4}"
_PARTICLE = "(?:von|van|zu|der|den|ter|ten|del|della|de|di|da|do|dos|du|la|le|bin|ibn|al|el)"
_PERSON = rf"(?:{_LETTERS})?(?:{_NAME} (?:{_LETTERS})?)?(?:{_PARTICLE} ){{0,3}}{_NAME}"
#: Surnames that open a question as verbs do, and words that a verb but hardly a name stands before.
_VERBS = ("Will", "May", "Can", "Might", "Must", "Shall")
_AFTER_VERB = "(?:I|you|he|she|it|we|they|the|a|an|this|that|these|those|there|be|not)"
#: A word before a value that is secret whatever it looks like.
_KEYWORD = r"(?i:token|secret|password|passwd|api[_-]?key|access_key) {0,2}[=:] {0,2}[\"']?"
#: In this order: of two patterns that match at a place the earlier one decides. Each begins with what the next character has to be, so that
#: most places cost one look.
PATTERNS = {
    "KEYED": rf"(?=[tTsSpPaA])(?<![\p{{L}}\p{{N}}])(?:{_KEYWORD})[^\s\"',;]{{8,}}",
    "EMAIL": r"(?=[\p{L}\p{N}_%+])(?<![\p{L}\p{N}._%+'-])[\p{L}\p{N}._%+'-]{1,64}+@[\p{L}\p{N}][\p{L}\p{N}-]{0,62}(?:\.[\p{L}\p{N}-]{1,63})*\.\p{L}{2,24}",
    "SECRET": r"(?=[0-9a-fA-Fsprgxe])(?<![\p{L}\p{N}_-])(?:(?=[a-fA-F]*[0-9])[0-9a-fA-F]{32,}+|(?=[A-Za-z_-]{1,64}[0-9])(?:(?:sk|pk|rk|ghp|gho|ghs|xoxb|xoxp|AKIA|ASIA|AIza)[_-]?[A-Za-z0-9_-]{16,}+|eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+))(?![\p{L}\p{N}_])",
    "MAC": r"(?=[0-9a-fA-F]{2}[:-])(?<![\p{L}\p{N}:])(?:[0-9a-fA-F]{2}[:-]){5}[0-9a-fA-F]{2}(?![\p{L}\p{N}:])",
    "IPV6": r"(?=[0-9a-fA-F]{1,4}:[0-9a-fA-F:]*[0-9])(?<![\p{L}\p{N}:])(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|(?:[0-9a-fA-F]{1,4}:){2,6}(?::[0-9a-fA-F]{1,4}){1,5}|[0-9a-fA-F]{1,4}:(?::[0-9a-fA-F]{1,4}){2,6}|(?:[0-9a-fA-F]{1,4}:){3,7}:)(?![\p{L}\p{N}:])",
    "IPV4": rf"(?=\d)(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "IBAN": r"(?=[A-Z]{2}\d)(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "SSN": r"(?=\d)(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "CARD": r"(?=\d)(?<![\d+])\d(?:[ -]?\d){12,18}(?!\d)",
    "PHONE": r"(?=[\d+(])(?<![\p{L}\p{N}])(?:\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,5}){2,5}(?!\d)|(?:\(\d{2,4}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d))",
    "PERSON": rf"{_FIRST_OF_TITLE}\b{_TITLED}{_PERSON}",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What a text must hold to be searched: a digit, @, = or : for most patterns, two hexadecimal pairs with a hyphen for MACs of letters alone, a title for
#: persons. Cheap scans spare most texts the patterns.
_HINTS = ("[0-9@=:]", rf"{_FIRST_OF_TITLE}{_TITLE}\.? (?:\p{{Lu}}|{_PARTICLE} )", "[a-fA-F]{2}-[a-fA-F]{2}-[a-fA-F]{2}-")
_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

# Parts of invented names; a replacement is a given name and a surname made of a stem and an ending.
_GIVEN = {
    ("latin", "f"): "Alma Berta Clara Dora Edda Flora Greta Hedda Irma Julia Karla Lena Marta Nora Olga Paula Rita Selma Thea Vera".split(),
    ("latin", "m"): "Albin Bruno Carlo Darian Edgar Felix Gustav Henrik Ivo Jonas Kasper Linus Marius Nils Oskar Pablo Rufus Simon Tomas Viktor".split(),
    ("latin", "x"): "Alexis Andrea Ariel Cameron Dana Eden Jamie Jordan Kim Kelly Lou Morgan Noel Quinn Remy Robin Sascha Sam Toni Val".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Зоя Инна Лидия Мария Нина Ольга".split(),
    ("cyrillic", "m"): "Антон Борис Вадим Глеб Денис Егор Иван Кирилл Максим Олег".split(),
    ("greek", "f"): "Άννα Ελένη Ειρήνη Ζωή Μαρία Νίκη Σοφία Χαρά Δάφνη Κλειώ".split(),
    ("greek", "m"): "Αλέξης Γιώργος Δήμος Ηλίας Θωμάς Κώστας Λουκάς Μάρκος Νίκος Πέτρος".split(),
}
_STEM = {"latin": "Ahl Berg Cast Dorn Elm Falk Gold Hart Jans Kess Lind Mont Nord Oster Pell Quist Rosen Sand Torr Vald".split(), "cyrillic": "Бел Волк Гор Дуб Зим Кор Лес Мор Нов Сав".split(), "greek": "Αγγελ Βασιλ Δημητρ Ηλι Καρ Λαμπρ Μαρκ Παππ Σταμ Φωτ".split()}
_ENDING = {"latin": "a er holm ini man mark ner ova sen stein stad strom ton wald well".split(), "cyrillic": "енко ко ук юк чук".split(), "greek": "άκης όπουλος ίδης άτος έας ιάδης".split()}
#: Between stem and ending of names that were drawn in vain.
_SYLLABLE = {"latin": "ba de fi go hu ka le mi no pu ra se ti vo lu zo".split(), "cyrillic": "ба де жи го ку ла ме ни по ру са те ви хо зу ше".split(), "greek": "βα δε ζι γο κου λα με νι πο ρου σα τε φι χο θυ ξε".split()}


def kind_of(m: Column) -> Column:
    """The type of a match."""
    out = None
    for name, p in PATTERNS.items():
        out = (F if out is None else out).when(m.rlike(rf"^(?:{p})$"), F.lit("SECRET" if name == "KEYED" else name))
    return out.when(m.rlike(rf"^{_PERSON}$"), F.lit("PERSON")).otherwise(F.lit("SECRET"))


def name_of(m: Column) -> Column:
    """The name in a match of a person, without its titles."""
    return F.regexp_replace(m, rf"^{_TITLED}", "")


def _surname(name: Column) -> Column:
    return F.regexp_extract(name, "[^ .]+$", 0)


def _before_surname(name: Column) -> Column:
    return F.regexp_extract(name, "^(.*[ .])?[^ .]+$", 1)


def plain_name(name: Column) -> Column:
    """First name and surname, or the surname alone, without initials and particles."""
    return F.concat_ws(" ", F.nullif(F.regexp_extract(_before_surname(name), rf"(?<![\p{{L}}\p{{M}}]){_NAME}", 0), F.lit("")), _surname(name))


def _gender(m: Column) -> Column:
    title = F.regexp_extract(m, r"^([^. ]+)", 1)
    return F.when(title.isin(*_TITLES["f"]), F.lit("f")).when(title.isin(*_TITLES["m"]), F.lit("m")).otherwise(F.lit("x"))


def canonical(m: Column, kind: Column) -> Column:
    """What matches of one entity have in common: digits of numbers, lower-case addresses, lower-case names without their title."""
    compact = F.regexp_replace(m, r"[ .()-]", "")
    return (
        F.when(kind == "EMAIL", F.lower(m)).when(kind.isin("CARD", "SSN", "PHONE", "IBAN"), compact)
        .when(kind.isin("MAC", "IPV6"), F.lower(F.regexp_replace(m, "-", ":")))
        .when(kind == "SECRET", F.regexp_replace(m, f"^{_KEYWORD}", ""))
        .when(kind == "PERSON", F.lower(F.translate(plain_name(name_of(m)), "’", "'")))
        .otherwise(m)
    )


def _hex(key: str, what: Column, n: Column) -> Column:
    """At least n keyed hexadecimal digits."""
    blocks = F.sequence(F.lit(0), F.floor(n / 64).cast("int"))
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat(F.lit(key + "|"), what, F.lit("|"), b.cast("string")), 256)), "")


def _byte(stream: Column, at: Column) -> Column:
    return F.conv(F.substring(stream, at * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))


def _redraw(text: Column, stream: Column, first: Column | int = 0, digits: bool = False, surely_hex: bool = False) -> Column:
    """Letters become letters and digits digits of the same case; in hexadecimal texts they stay hexadecimal. The first
    `first` characters stay."""
    hexadecimal = F.lit(False) if digits else F.lit(True) if surely_hex else text.rlike(r"^[0-9a-f:]+$|^[0-9A-F]+$") & text.rlike("[0-9]")

    def one(c, i):
        x = _byte(stream, i)
        return (
            F.when(i < first, c)
            .when(hexadecimal & c.rlike("[0-9a-f]"), F.lower(F.hex(x % 16)))
            .when(hexadecimal & c.rlike("[A-F]"), F.hex(x % 16))
            .when(c.rlike("[0-9]"), (x % 10).cast("string"))
            .when(c.rlike(r"\p{IsCyrillic}"), F.substring(F.lit("абвгдежзиклмнопрстуф"), x % 20 + 1, F.lit(1)))
            .when(c.rlike(r"\p{IsGreek}"), F.substring(F.lit("αβγδεζηθικλμνξοπρστυ"), x % 20 + 1, F.lit(1)))
            .when(c.rlike(r"\p{Lu}"), F.char(x % 26 + 65))
            .when(c.rlike(r"\p{L}"), F.char(x % 26 + 97))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10 of a text of digits."""
    n = F.length(digits)

    def one(c, i):
        d = c.cast("int")
        twice = (n - i) % 2 == 0
        return F.when(twice, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), one), F.lit(0), lambda a, d: a + d) % 10


def _mod_97(iban: Column) -> Column:
    """The remainder that tells whether the check digits of an IBAN hold (1 if they do)."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def add(rest, c):
        n = F.conv(c, 36, 10).cast("int")
        return (rest * F.when(n > 9, 100).otherwise(10) + n) % 97

    return F.aggregate(F.split(moved, ""), F.lit(0), add)


def _with_check_digits(iban: Column, remainder: Column) -> Column:
    """iban with check digits from 02 to 98 that give this remainder."""
    zero = F.concat(F.substring(iban, 1, 2), F.lit("00"), F.substring(iban, F.lit(5), F.length(iban)))
    digits = (remainder + 95 + 97 - _mod_97(zero)) % 97 + 2
    return F.concat(F.substring(iban, 1, 2), F.lpad(digits.cast("string"), 2, "0"), F.substring(iban, F.lit(5), F.length(iban)))


#: Letters that initials move on among, alphabet by alphabet.
_ALPHABETS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞŁŚŠŻŽ", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")


def _initials_moved(text: Column, replacement: Column) -> Column:
    """text with its capitals that stand alone moved on by a step of 1 to 23, which the replacement decides."""
    step = (F.crc32(replacement) % 23 + 1).cast("int")
    moved = F.concat(*[F.substring(F.lit(a + a), step + 1, F.lit(len(a))) for a in _ALPHABETS])
    letters = F.split(text, "")
    return F.array_join(F.transform(letters, lambda c: F.call_function("translate", c, F.lit("".join(_ALPHABETS)), moved)), "")


def draw(kind: Column, canon: Column, hint: Column, key: str, attempt: Column) -> Column:
    """The canonical form of a replacement: same length and make-up; IP addresses have valid octets, card numbers the check digit that
    keeps them as valid or invalid as the original (as do those of IBANs), emails keep their top-level domain and share a domain where originals do. A SURNAME keeps its script; a GIVEN (a full
    name, of which only the first name is drawn) its script and its gender, which hint tells.

    From the second attempt on names get longer, from the third on (attempt 2) a format is taken to be too full, and what there is to draw from grows by a factor with each
    attempt: local parts of emails and names get more syllables, secrets take any letters and digits; from attempt 4 on phone numbers and SSNs get more digits. A secret without
    letters and digits takes them from the start."""
    what = F.concat(kind, F.lit("|"), canon, F.lit("|"), attempt.cast("string"))
    stream = _hex(key, what, F.length(canon) * 2 + 16)
    more = _hex(key, F.concat(F.lit("more|"), what), F.lit(64))
    longer = F.greatest(F.lit(0), (attempt - 1) * 2)
    digits = F.when(attempt > 3, F.substring(F.translate(more, "abcdef", "012345"), F.lit(1), (attempt - 3) * 2)).otherwise(F.lit(""))
    local, host = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    top = F.substring_index(host, ".", -1)
    site = F.substring(host, F.lit(1), F.length(host) - F.length(top) - 1)
    local = _redraw(local, stream, digits=True)
    local = F.when(attempt > 1, F.concat(F.substring(local, F.lit(1), 64 - longer), F.substring(more, F.lit(1), longer))).otherwise(local)
    email = F.concat(local, F.lit("@"), _redraw(site, _hex(key, F.concat(F.lit("site|"), host), F.length(host) * 2), digits=True), F.lit("."), top)
    octets = F.array_join(F.transform(F.split(canon, r"\."), lambda o, i: (_byte(stream, i) % 254 + 1).cast("string")), ".")
    card = _redraw(F.substring(canon, F.lit(1), F.length(canon) - 1), stream, 1, digits=True)
    check = (_luhn(canon) - _luhn(F.concat(card, F.lit("0"))) + 10) % 10
    script = F.when(canon.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).when(canon.rlike(r"\p{IsGreek}"), F.lit("greek")).otherwise(F.lit("latin"))
    number = lambda k: F.conv(F.substring(stream, k * 6 + 1, 6), 16, 10).cast("long")
    given = surname = None
    for s in _STEM:
        # two more syllables with each attempt: the space of names grows 256-fold
        syllables = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), attempt * 2)), lambda k: _pick(_SYLLABLE[s], _byte(more, k)))  # noqa: B023
        inside = F.when(attempt > 0, F.array_join(syllables, "")).otherwise(F.lit(""))
        surname = (F if surname is None else surname).when(script == s, F.concat(_pick(_STEM[s], number(1)), inside, _pick(_ENDING[s], number(2))))
        for g in "fmx":
            names = _GIVEN.get((s, g)) or _GIVEN[s, "m"]
            first = _pick(names, number(0))
            double = F.concat(first, F.lit("-"), _pick(names, number(3)))
            made = F.when(attempt == 0, first).when(attempt == 1, double).otherwise(F.concat(first, F.array_join(F.slice(syllables, 1, F.greatest(F.lit(1), longer)), "")))
            given = (F if given is None else given).when((script == s) & (hint == g), made)
    wide = F.array_join(F.transform(F.split(canon, ""), lambda c, i: F.substring(F.lit(_ALNUM), _byte(stream, i) % len(_ALNUM) + 1, F.lit(1))), "")
    return (
        F.when(kind == "EMAIL", email).when(kind == "IPV4", octets).when(kind == "CARD", F.concat(card, check.cast("string")))
        .when(kind == "SURNAME", F.lower(surname)).when(kind == "GIVEN", F.concat(F.lower(given), F.lit(" "), F.substring_index(canon, " ", -1)))
        .when(kind == "PHONE", F.concat(_redraw(canon, stream, F.when(canon.startswith("+"), F.lit(2)).otherwise(F.lit(0)), digits=True), digits))
        .when(kind == "IBAN", _with_check_digits(_redraw(canon, stream, 2, digits=True), _mod_97(canon))).when(kind == "SSN", F.concat(_redraw(canon, stream, digits=True), digits))
        .when(kind.isin("MAC", "IPV6"), _redraw(canon, stream, surely_hex=True))
        .when((kind == "SECRET") & ((attempt > 1) | ~canon.rlike(r"[\p{L}0-9]")), wide)
        .otherwise(_redraw(canon, stream))
    )


def dress(m: Column, kind: Column, replacement: Column) -> Column:
    """A replacement in the format of a match: its separators, its capitals, its title. Digits that it has more stand at the end."""
    # the k-th letter or digit of the match becomes the k-th of the replacement
    body = F.regexp_replace(replacement, r"[^\p{L}\p{N}]", "")
    held = F.length(F.regexp_replace(m, r"[^\p{L}\p{N}]", ""))
    filled = F.array_join(F.transform(F.split(m, ""), lambda c, i: F.when(c.rlike(r"[\p{L}\p{N}]"), F.substring(body, F.length(F.regexp_replace(F.substring(m, F.lit(1), i), r"[^\p{L}\p{N}]", "")) + 1, F.lit(1))).otherwise(c)), "")
    capitals = F.array_join(F.transform(F.split(replacement, "(?<=[ -])"), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))), "")
    # what stands before the surname: pieces without a small letter are initials, those with a capital the first name, others particles
    pieces = F.split(_before_surname(name_of(m)), "(?<=[ .])")
    before = F.transform(pieces, lambda w: F.when(w.rlike(r"\p{Lu}.*\p{Ll}"), F.concat(F.substring_index(capitals, " ", 1), F.lit(" "))).when(w.rlike(r"\p{Lu}"), _initials_moved(w, F.substring_index(replacement, " ", -1))).otherwise(w))
    name = F.concat(F.regexp_extract(m, rf"^(?:{_TITLED})?", 0), F.array_join(before, ""), F.substring_index(capitals, " ", -1))
    return (
        F.when(kind == "PERSON", name).when(kind == "SECRET", F.concat(F.regexp_extract(m, f"^{_KEYWORD}", 0), replacement))
        .when(kind.isin("CARD", "IBAN"), filled)
        .when(kind.isin("SSN", "PHONE"), F.concat(filled, F.substring(body, held + 1, F.length(body))))
        .when(kind.isin("MAC", "IPV6"), F.when(m.rlike("[A-F]"), F.upper(F.when(m.contains("-"), F.regexp_replace(replacement, ":", "-")).otherwise(replacement))).otherwise(F.when(m.contains("-"), F.regexp_replace(replacement, ":", "-")).otherwise(replacement)))
        .otherwise(replacement)
    )


def assign(entities: DataFrame, key: str, most_rounds: int = 12) -> DataFrame:
    """(kind, canon, replacement) for distinct entities (kind, canon, hint): no two of a kind share a replacement, and none is an entity. A GIVEN's
    replacement is its new first name before its old surname, so that first names differ among those of one surname.

    In each round all that are left draw; of those that draw the same the smallest wins, and who draws an entity or what was given
    before draws again. Few are left after the first round, so the later ones are small. Where a format is so full that many are left, draw() makes it
    wider with each attempt. IPv4 addresses alone can't be wider; they fail when a large share of all 254**4 stand in the corpus."""
    entities = stored(entities.groupBy("kind", "canon").agg(F.min("hint").alias("hint")), "entities")
    left, given = entities.withColumn("attempt", F.lit(0)), None
    for k in range(most_rounds):
        drawn = left.select("kind", "canon", "hint", draw(F.col("kind"), F.col("canon"), F.col("hint"), key, F.lit(k)).alias("replacement"))
        drawn = stored(drawn, "drawn")
        won = drawn.groupBy("kind", "replacement").agg(F.min("canon").alias("canon"))
        won = won.join(entities.select("kind", F.col("canon").alias("replacement")), ["kind", "replacement"], "left_anti")
        if given is not None:
            won = won.join(given.select("kind", "replacement"), ["kind", "replacement"], "left_anti")
        won = stored(won.select("kind", "canon", "replacement"), "won")
        given = won if given is None else given.unionByName(won)
        left = stored(drawn.join(won, ["kind", "canon"], "left_anti").select("kind", "canon", "hint"), "left")
        if left.isEmpty():
            return given
    raise RuntimeError("replacements could not be made distinct: too many entities of a short format")


def _entities(places: DataFrame) -> DataFrame:
    """(kind, canon, hint) of what places (kind, canon, match) hold; a person is a SURNAME and, with a first name, a GIVEN, whose hint is the gender
    that its titles tell in the corpus (x if none does, or several)."""
    person, none = F.col("kind") == "PERSON", F.lit(None).cast("string")
    other = places.where(~person).select("kind", "canon").distinct().withColumn("hint", none)
    names = places.where(person).groupBy("canon").agg(F.collect_set(F.nullif(_gender(F.col("__pii_match")), F.lit("x"))).alias("g"))
    gender = F.when(F.size("g") == 1, F.element_at("g", 1)).otherwise(F.lit("x"))
    full = names.where(F.col("canon").contains(" ")).select(F.lit("GIVEN").alias("kind"), "canon", gender.alias("hint"))
    last = names.select(F.lit("SURNAME").alias("kind"), F.substring_index("canon", " ", -1).alias("canon"), none.alias("hint")).distinct()
    return other.unionByName(full).unionByName(last)


def session_key(spark: SparkSession) -> str:
    """The secret that surrogates are drawn by: the setting docketry.pii.key, or, where it is unset, a random one for this session. Who knows it can find out which
    surrogate belongs to a guessed entity, so it is not kept in code."""
    found = spark.conf.get("docketry.pii.key", None)
    if found is None:
        found = secrets.token_hex(32)
        spark.conf.set("docketry.pii.key", found)
    return found


def _with_bare_names(rows: DataFrame, text_col: str) -> DataFrame:
    """rows with __pii_pattern: PATTERN, and for a text with titled persons also the names that titles have introduced there, full names first, then surnames where they
    read as names. Null where __pii_found is null or empty."""
    found, titled, surnames, words = (F.col(f"__pii_{c}") for c in ("found", "titled", "surnames", "words"))
    either = lambda names: F.concat(F.lit(r"(?:\Q"), F.array_join(names, r"\E|\Q"), F.lit(r"\E)"))
    longest_first = lambda names: F.transform(F.array_sort(F.transform(F.array_distinct(names), lambda n: F.struct((-F.length(n)).alias("l"), n.alias("n")))), lambda x: x["n"])
    any_of = lambda names, pattern: F.when(F.size(names) > 0, pattern)
    end = F.lit(r"(?![\p{L}\p{M}\p{N}])")
    rows = rows.withColumn("__pii_titled", F.transform(F.filter(found, lambda m: m.rlike(rf"^{PATTERNS['PERSON']}$")), lambda m: name_of(m)))
    rows = rows.withColumn("__pii_surnames", longest_first(F.transform(titled, _surname)))
    rows = rows.withColumn("__pii_full", longest_first(F.filter(F.concat(titled, F.transform(titled, plain_name)), lambda n: n.rlike("[ .]"))))
    # surnames that the text has in lower case as words of their own, not as parts of addresses
    lower = F.concat(F.lit(r"(?<![\p{L}\p{N}.@_/-])"), either(F.transform(surnames, F.lower)), F.lit(r"(?![\p{L}\p{M}\p{N}@_/]|[.-]\p{L})"))
    written = F.when(F.size(titled) > 0, F.array_distinct(F.regexp_extract_all(F.col(text_col), lower, F.lit(0))))
    rows = rows.withColumn("__pii_words", F.concat(written, F.array(*[F.lit(v.lower()) for v in _VERBS])))
    rows = rows.withColumn("__pii_sure", F.filter(surnames, lambda n: ~F.array_contains(words, F.lower(n))))
    full, sure = F.col("__pii_full"), F.col("__pii_sure")
    unsure = F.array_except(surnames, sure)
    no_other_name = F.concat(F.lit("(?! (?!"), either(surnames), end, F.lit(r")\p{Lu}\p{Ll})"))
    bare = F.concat_ws(
        "|",
        any_of(full, F.concat(either(full), end)),
        any_of(sure, F.concat(either(sure), end, no_other_name)),
        any_of(unsure, F.concat(F.lit(r"(?<=[\p{L},;] )"), either(unsure), end, no_other_name, F.lit(rf"(?! {_AFTER_VERB}(?!\p{{L}}))"))),
    )
    pattern = F.when(F.size(titled) > 0, F.concat(F.lit(PATTERN + r"|(?<![\p{L}\p{M}\p{N}])(?:"), bare, F.lit(")"))).otherwise(F.lit(PATTERN))
    return rows.withColumn("__pii_pattern", F.when(F.size(found) > 0, pattern)).drop(titled, surnames, full, words, sure)


def replace_entities(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """docs with text_col rewritten and n_entities (long), the number of matches replaced. key is a secret of the caller's: the same key gives the same surrogates.

    Null texts stay null and empty ones empty, with 0 entities. An entity has one replacement in all rows; distinct entities
    have distinct ones. Equal texts are rewritten once, so a group of copies is no large group. Repeated rows stay repeated. A column of docs named
    n_entities is replaced; names that begin with __pii_ are used inside. Names without a title are found in texts that hold the same name or surname with one, in
    the same spelling. An email doesn't follow the surrogate of a person whose name it holds.
    """
    text = F.col(text_col)
    has = F.coalesce(text.rlike(_HINTS[0]) | text.rlike(_HINTS[1]) | text.rlike(_HINTS[2]), F.lit(False))
    found = F.when(has, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    rows = docs.withColumn("__pii_found", found)
    rows = _with_bare_names(rows.withColumn("__pii_text_key", F.when(F.size("__pii_found") > 0, F.sha2(text, 256))), text_col)
    m = F.col("__pii_match")
    all_found = F.when(F.col("__pii_pattern") == PATTERN, F.col("__pii_found")).otherwise(F.regexp_extract_all(text, F.col("__pii_pattern"), F.lit(0)))
    places = rows.where("__pii_text_key is not null").select("__pii_text_key", F.posexplode(all_found).alias("__pii_at", "__pii_match")).distinct()
    places = places.withColumn("kind", kind_of(m)).withColumn("canon", canonical(m, F.col("kind")))
    places = stored(places, "places")
    given = stored(assign(_entities(places), key), "given")
    person = F.col("kind") == "PERSON"
    # a person's replacement is the first name of its GIVEN and that of its SURNAME
    plain_given = given.where("kind not in ('GIVEN', 'SURNAME')")
    first = given.where("kind = 'GIVEN'").select("canon", F.substring_index("replacement", " ", 1).alias("__pii_first"))
    last = given.where("kind = 'SURNAME'").select(F.col("canon").alias("__pii_surname"), F.col("replacement").alias("__pii_last"))
    people = places.where(person).select("kind", "canon").distinct().withColumn("__pii_surname", F.substring_index("canon", " ", -1))
    people = people.join(first, "canon", "left").join(last, "__pii_surname").select("kind", "canon", F.concat_ws(" ", "__pii_first", "__pii_last").alias("replacement"))
    swaps = places.join(plain_given.unionByName(people), ["kind", "canon"]).select("__pii_text_key", "__pii_at", dress(m, F.col("kind"), F.col("replacement")).alias("__pii_swap"))
    swaps = swaps.groupBy("__pii_text_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("__pii_at", "__pii_swap"))), lambda x: x["__pii_swap"]).alias("__pii_swaps"))
    other = [c for c in docs.columns if c not in (text_col, "n_entities")]
    plain = rows.where("__pii_text_key is null").select(*other, text_col, F.lit(0).cast("long").alias("n_entities"))
    pieces = F.split(text, F.col("__pii_pattern"), -1)
    done = F.array_join(F.zip_with(pieces, F.concat("__pii_swaps", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    changed = rows.where("__pii_text_key is not null").drop("__pii_found").join(stored(swaps, "swaps"), "__pii_text_key").select(*other, done.alias(text_col), F.size("__pii_swaps").cast("long").alias("n_entities"))
    order = [c for c in docs.columns if c != "n_entities"]
    return plain.unionByName(changed).select(*order, "n_entities")


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), session_key(spark)).select("doc_id", "n_entities", "text")
