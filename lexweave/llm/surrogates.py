"""Personal data replaced by keyed surrogates of the same type and format. Column functions only."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

KEY = "lexweave-surrogates"
#: Tweaks of the key that are tried.
ROUNDS = 20

#: Titles that show a person's gender.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "госпожа", "г-жа"],
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин", "г-н"],
    "n": ["Dr", "Prof"],
}
_TITLE = "(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\.?"
_TITLES = f"(?:{_TITLE} )+"
#: A word with inner capitals, apostrophes and hyphens, or an initial; a possessive s is not part of it.
_NAME_WORD = rf"(?!{_TITLE} )(?:\p{{Lu}}\.|\p{{Lu}}[\p{{L}}\p{{M}}]*+(?:-[\p{{L}}\p{{M}}]++|['’](?:\p{{Lu}}[\p{{L}}\p{{M}}]*+|[\p{{Ll}}\p{{M}}]{{3,}}+))*+)"
_PARTICLE = "(?:van|von|der|den|de|del|della|di|da|du|dos|la|le|ter|zu)"
#: Words of names that are replaced without their title only as part of the whole name: fixed values.
ORDINARY = (
    "April May June August March Monday Friday Sunday Summer Winter Spring Rose Lily Daisy Grace Hope Faith Joy Will "
    "Mark Bill Rich Grant Chase Art Dean Earl Duke Prince Pope Bishop King Queen Knight Page Major Black White Brown "
    "Green Gray Grey Gold Silver Young Old Long Short Little Small Large Strong Wise Good Best Sharp Hill Wood Woods "
    "Forest Field Fields Stone Rivers Lake Banks Bush Park Church House Street West North South East Bird Fox Wolf Lamb "
    "Bull Fish Rice Bell Ball Bond Price Love Power Day Moon Star Snow Frost Rain The A An In On At And But He She It"
).split()
#: Countries that issue IBANs.
_IBAN_COUNTRY = (
    "(?:AD|AE|AL|AT|AZ|BA|BE|BG|BH|BR|BY|CH|CR|CY|CZ|DE|DK|DO|EE|EG|ES|FI|FO|FR|GB|GE|GI|GL|GR|GT|HR|HU|IE|IL|IQ|IS|IT|JO|"
    "KW|KZ|LB|LC|LI|LT|LU|LV|LY|MC|MD|ME|MK|MR|MT|MU|NL|NO|PK|PL|PS|PT|QA|RO|RS|SA|SC|SE|SI|SK|SM|ST|SV|TL|TN|TR|UA|VA|VG|XK)"
)
_IBAN = rf"(?![0-9A-F]{{32,}}(?![A-Za-z0-9_])){_IBAN_COUNTRY}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{0,2}}[0-9])?"
#: Letters of addresses: Latin, Greek and Cyrillic; scripts without blanks between words would run into them.
_W = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0370-\u03ff\u0400-\u052f"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

#: Type, what finds it in a text, and what tells it from the other types, in order.
TYPES = [
    (
        "email",
        rf"(?<![{_W}0-9._%+-])[{_W}0-9._%+-]++@[{_W}0-9-]+(?:\.[{_W}0-9-]+)*\.[{_W}]{{2,}}",
        "@",
    ),
    (
        "iban",
        rf"(?<![A-Za-z0-9_]){_IBAN}(?![A-Za-z0-9_])",
        rf"^{_IBAN}$",
    ),
    (
        "secret",
        r"(?<![A-Za-z0-9_])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|AKIA[0-9A-Z]{16}|(?:ghp_|sk-)[A-Za-z0-9]{20,}+)(?![A-Za-z0-9_])",
        r"^(?=.{20})[A-Za-z0-9_-]+$(?<=[A-Za-z0-9])(?<!^[0-9 -]{1,31})",
    ),
    ("ip", rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])", r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"),
    ("card", r"(?<![0-9])(?:(?:[0-9]{4}[ -]?){3}[0-9]{4}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9])", r"^(?:[0-9][ -]?){15,16}$"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
    (
        "phone",
        r"(?:(?<![0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}|(?<![0-9(+-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}|(?<![0-9.,(+-])0[1-9][0-9]{1,3}[ -][0-9]{3,4}[ -]?[0-9]{3,4})(?![0-9])",
        r"^[+(0-9]",
    ),
    ("name", rf"(?<!\p{{L}}){_TITLES}{_NAME_WORD}(?:(?: {_PARTICLE})* {_NAME_WORD})*+", r"^\p{L}"),
]
KINDS = [t for t, _, _ in TYPES]
PATTERN = "|".join(p for _, p, _ in TYPES)
#: A text without any of these holds nothing to replace.
_HINT = rf"[0-9]{{2}}|[0-9]\.[0-9]|@|(?:AKIA|ghp_|sk-)|[0-9A-Fa-f]{{32}}|{_TITLE} \p{{Lu}}"

_DIGITS, _LETTERS, _HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"


def _cased(first: int, last: int) -> list[str]:
    """Lower-case letters of a range that a capital stands for, one to one."""
    found = map(chr, range(first, last + 1))
    return [c for c in found if len(c.upper()) == 1 and c.upper() != c and c.upper().lower() == c]


def _sounds(letters: list[str], vowels: str) -> list[str]:
    """Consonants and vowels, by the letter without its marks."""
    is_vowel = [unicodedata.normalize("NFD", c)[0] in vowels for c in letters]
    return ["".join(c for c, v in zip(letters, is_vowel) if v == want) for want in (False, True)]


#: Letters that take each other's place in names, by script and sound.
_SOUNDS = [
    *_sounds(_cased(0x61, 0x7A), "aeiouy"),
    *_sounds(_cased(0xDF, 0x17F), "aeiouyæœø"),
    *_sounds(_cased(0x430, 0x44F), "аеиоуыэюя"),
    *_sounds(_cased(0x3AC, 0x3CE), "αεηιουω"),
    # rarer letters of these, Armenian, Georgian, Cherokee
    *map("".join, (
        _cased(0x180, 0x24F) + _cased(0x1E00, 0x1EFF), _cased(0x450, 0x52F), _cased(0x370, 0x3AB) + _cased(0x3CF, 0x3FF) + _cased(0x1F00, 0x1FFF),
        _cased(0x561, 0x586), _cased(0x10D0, 0x10FF), _cased(0xAB70, 0xABBF),
    )),
]
#: Endings of given names by script and gender.
_ENDINGS = {
    r"\p{IsCyrillic}": {"f": "на", "m": "рд", "n": "л"},
    r"\p{IsGreek}": {"f": "να", "m": "ος", "n": "λ"},
    r"\p{IsArmenian}": {"f": "նա", "m": "րդ", "n": "լ"},
    "": {"f": "na", "m": "rd", "n": "l"},
}


def _number(key: Column) -> Column:
    """28 bits of the key's SHA-256, as a number."""
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 7), 16, 10).cast("bigint")


def _place(c: Column, alphabets: list[str]) -> tuple[Column, Column, Column]:
    """Where a character stands in the joined alphabets, 0 if nowhere, where its own starts and its size."""
    at = F.instr(F.lit("".join(alphabets)), c)
    starts = [sum(map(len, alphabets[:i])) for i in range(len(alphabets))]
    # one flat choice: nested ones take the analyser a time that doubles with each level
    first, size = F, F
    for start, alphabet in zip(starts, alphabets):
        within = at <= start + len(alphabet)
        first, size = first.when(within, start), size.when(within, len(alphabet))
    return at, first, size


def _turned(at: Column, first: Column, size: Column, shift: Column, alphabets: list[str]) -> Column:
    """The character ``shift`` places on in its alphabet."""
    return F.substring(F.lit("".join(alphabets)), (first + F.pmod(at - 1 - first + shift, size) + 1).cast("int"), F.lit(1))


def _chain(chars: Column, seed: Column, alphabets: list[str], undo: bool = False) -> Column:
    """Each character of an alphabet moves by a keyed amount that all characters before decide.

    Others stay and decide nothing. Undone character by character, so different inputs of one
    shape have different outputs. ``undo`` takes the outputs and gives the inputs.
    """

    def step(state: Column, c: Column) -> Column:
        at, first, size = _place(c, alphabets)
        shift = _number(F.concat(seed, state["past"]))
        moved = F.when(at > 0, _turned(at, first, size, -shift if undo else shift, alphabets)).otherwise(c)
        return F.struct(
            F.concat(state["done"], F.array(moved)).alias("done"),
            F.when(at > 0, F.concat(state["past"], moved if undo else c)).otherwise(state["past"]).alias("past"),
        )

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("past"))
    return F.aggregate(chars, start, step, lambda s: s["done"])


#: Longer secrets are permuted in blocks of BLOCK characters, each keyed by the one before.
LONG, BLOCK = 128, 64


def _permuted_blocks(text: Column, seed: Column, alphabets: list[str]) -> Column:
    """A keyed permutation in time that follows the length."""
    parts = F.regexp_extract_all(text, F.lit(rf"[\s\S]{{1,{BLOCK}}}"), F.lit(0))
    numbered = F.transform(F.array(parts), lambda ps: F.transform(ps, lambda p, i: F.struct(
        p.alias("part"), F.concat_ws("|", i.cast("string"), F.get(ps, i - 1), F.lit("")).alias("mark")
    )))[0]
    long = F.array_join(F.transform(numbered, lambda z: _permuted(z["part"], F.concat(seed, z["mark"]), alphabets)), "")
    return F.when(F.char_length(text) > LONG, long).otherwise(_permuted(text, seed, alphabets))


def _permuted(text: Column, seed: Column, alphabets: list[str]) -> Column:
    """A keyed permutation of the texts of one shape: once forwards, once backwards."""
    ahead = _chain(F.split(text, ""), F.concat(seed, F.lit(">")), alphabets)
    back = _chain(F.reverse(ahead), F.concat(seed, F.lit("<")), alphabets)
    return F.array_join(F.reverse(back), "")


def _displaced(text: Column, seed: Column, alphabets: list[str]) -> Column:
    """A keyed permutation of the texts of one shape that leaves none with a letter of an alphabet as it is.

    The text's permutation has its first such letter moved on by one and is then undone.
    """
    before, after = F.concat(seed, F.lit(">")), F.concat(seed, F.lit("<"))
    mixed = F.split(_permuted(text, seed, alphabets), "")

    def step(s: Column, c: Column) -> Column:
        at, first, size = _place(c, alphabets)
        here = (at > 0) & ~s["moved"]
        return F.struct(
            F.concat(s["done"], F.array(F.when(here, _turned(at, first, size, F.lit(1), alphabets)).otherwise(c))).alias("done"),
            (s["moved"] | here).alias("moved"),
        )

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(False).alias("moved"))
    next_one = F.aggregate(mixed, start, step, lambda s: s["done"])
    ahead = F.reverse(_chain(F.reverse(next_one), after, alphabets, undo=True))
    return F.array_join(_chain(ahead, before, alphabets, undo=True), "")


def _shaped(original: Column, plain: Column) -> Column:
    """The characters of ``plain``, upper case where the original is."""
    pairs = F.arrays_zip(F.split(original, "").alias("o"), F.split(plain, "").alias("p"))
    return F.array_join(F.transform(pairs, lambda z: F.when(z["o"].rlike(r"\p{Lu}"), F.upper(z["p"])).otherwise(z["p"])), "")


def _refilled(original: Column, digits: Column) -> Column:
    """The original with its digits replaced in order; separators stay."""
    state = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))

    def step(s: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.struct(
            F.concat(s["text"], F.when(digit, F.substring(digits, s["at"], F.lit(1))).otherwise(c)).alias("text"),
            (s["at"] + F.when(digit, 1).otherwise(0)).alias("at"),
        )

    return F.aggregate(F.split(original, ""), state, step, lambda s: s["text"])


def _luhn(digits: Column) -> Column:
    """The digit sum of the Luhn rule for digits that a check digit would follow, modulo 10."""
    numbered = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(
        i % 2 == 0, F.lit(2) * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)
    ).otherwise(c.cast("int")))
    return F.aggregate(numbered, F.lit(0), lambda a, x: a + x) % 10


def kind_of(entity: Column) -> Column:
    """The type of a string that PATTERN found."""
    found = F.lit("name")
    for name, _, tell in reversed(TYPES):
        found = F.when(entity.rlike(tell), name).otherwise(found)
    return found


def _digits(entity: Column) -> Column:
    return F.regexp_replace(entity, "[^0-9]", "")


def _name_words(entity: Column) -> Column:
    """The words of a name without its title."""
    return F.split(F.regexp_replace(entity, rf"^{_TITLES}", ""), " ")


def _title(entity: Column) -> Column:
    return F.regexp_extract(entity, rf"^{_TITLES}", 0)


def _gender(entity: Column) -> Column:
    bare = F.split(F.regexp_replace(_title(entity), r"\.", ""), " ")
    gender = F.lit("n")
    for g in ("m", "f"):
        gender = F.when(F.arrays_overlap(bare, F.array(*map(F.lit, TITLES[g]))), g).otherwise(gender)
    return gender


#: Country codes after a plus sign, by their first digits: fixed values. All others have three digits.
_COUNTRY = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def _code(phone: Column) -> Column:
    """The digits of a phone number's country code, which stay; separators do not matter."""
    return F.regexp_extract(F.regexp_replace(phone, "[^0-9+]", ""), _COUNTRY, 1)


def _new_words(words: Column, gender: Column, seed: Column) -> Column:
    """New words of the old ones' shape: letters change within script and sound, capitals stay.

    The last word is the family name; words before are given names and end as the gender does.
    Initials stay initials, particles stay.
    """

    def new(word: Column, i: Column) -> Column:
        family, initial = i == F.size(words) - 1, word.rlike(r"^\p{Lu}\.?$")
        part = F.when(initial, "initial").when(family, "family||").otherwise(F.concat(F.lit("given|"), gender, F.lit("|")))
        made = _shaped(word, _displaced(F.lower(word), F.concat(seed, part), _SOUNDS))
        ending = F
        for script, ends in _ENDINGS.items():
            ending = ending.when(word.rlike(script), F.when(gender == "f", ends["f"]).when(gender == "m", ends["m"]).otherwise(ends["n"]))
        ending = F.when(initial | family, "").when(word == F.upper(word), F.upper(ending)).otherwise(ending)
        return F.when(word.rlike(rf"^{_PARTICLE}$"), word).otherwise(F.concat(made, ending))

    return F.transform(words, new)


def _ninety_seven(letters: Column) -> Column:
    """A text of digits and capitals, A as 10 to Z as 35, modulo 97."""

    def step(rest: Column, c: Column) -> Column:
        number = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return (rest * F.when(number > 9, 100).otherwise(10) + number) % 97

    return F.aggregate(F.split(letters, ""), F.lit(0), step)


def _new_iban(entity: Column, seed: Column) -> Column:
    """Country, blanks and the remainder modulo 97 stay; the account's digits and letters are permuted."""
    plain = F.replace(entity, F.lit(" "), F.lit(""))
    account = F.substring(plain, F.lit(5), F.char_length(plain))
    fresh = F.upper(_permuted(F.lower(account), seed, [_DIGITS, _LETTERS]))
    place = lambda a, check: F.concat(a, F.substring(plain, 1, 2), check)
    rest = _ninety_seven(place(account, F.substring(plain, 3, 2)))
    check = F.pmod(rest - _ninety_seven(place(fresh, F.lit("00"))) - 2, F.lit(97)) + 2
    # check digits are issued from 02 to 98; others stay, so different accounts stay different
    old = F.substring(plain, 3, 2)
    check = F.when(old.isin("00", "01", "99"), old).otherwise(F.lpad(check.cast("string"), 2, "0"))
    chars = F.split(F.concat(F.substring(plain, 1, 2), check, fresh), "")
    state = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    return F.aggregate(F.split(entity, ""), state, lambda s, c: F.struct(
        F.concat(s["text"], F.when(c == " ", c).otherwise(F.get(chars, s["at"]))).alias("text"),
        (s["at"] + F.when(c == " ", 0).otherwise(1)).alias("at"),
    ), lambda s: s["text"])


def canonical(entity: Column, kind: Column) -> Column:
    """What makes two mentions the same: digits of numbers, lower case of addresses and names."""
    number = kind.isin("card", "ssn")
    # a particle is a word of its own, apart from the same word with a capital
    words = F.array_join(F.transform(_name_words(entity), lambda w: F.when(w.rlike(rf"^{_PARTICLE}$"), F.concat(w, F.lit("~"))).otherwise(F.lower(w))), " ")
    # a family name alone has one surrogate for all titles
    name = F.when(F.size(_name_words(entity)) > 1, F.concat(_gender(entity), F.lit("|"), words)).otherwise(words)
    phone = F.concat(_code(entity), F.lit(" "), F.substring(_digits(entity), F.char_length(_code(entity)) + 1, F.lit(99)))
    return (
        F.when(number, _digits(entity)).when(kind == "phone", phone).when(kind == "name", name)
        .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit(""))).otherwise(F.lower(entity))
    )


def surrogate(entity: Column, kind: Column, key: str = KEY, tweak: int = 0) -> Column:
    """The replacement of one mention.

    Addresses, numbers and secrets are permuted by a key among the strings of their shape, so
    different ones stay different; separators, letter case, the country code of a phone, the
    Luhn remainder of a card and the country and remainder of an IBAN stay. Domains are permuted
    by themselves, so addresses of one domain share one. Words of names are permuted within
    script, vowels and consonants, none stays as it is, and given names get an ending of their
    title's gender; the same word always becomes the same; initials and particles stay such.
    """
    seed = F.lit(f"{key}|{tweak}|")
    low = F.lower(entity)
    own = lambda kind_: F.concat(seed, F.lit(kind_))
    alnum = [_DIGITS, _LETTERS]
    local, domain = F.substring_index(low, "@", 1), F.substring_index(low, "@", -1)
    letters = [*alnum, *_SOUNDS[2:]]
    email = F.concat(_permuted(local, own("local"), letters), F.lit("@"), _permuted(domain, own("domain"), letters))
    secret = F.when(low.rlike("^[0-9a-f]+$"), _permuted_blocks(low, own("hex"), [_HEX])).otherwise(_permuted_blocks(low, own("key"), alnum))

    octets = F.transform(F.split(entity, r"\."), lambda x: x.cast("int"))

    def turned(numbers: Column, mark: str) -> Column:
        start = F.struct(F.array().cast("array<int>").alias("done"), F.lit("").alias("past"))
        return F.aggregate(numbers, start, lambda s, x: F.struct(
            F.concat(s["done"], F.array(((x + _number(F.concat(own("ip" + mark), s["past"]))) % 256).cast("int"))).alias("done"),
            F.concat(s["past"], F.lit("."), x.cast("string")).alias("past"),
        ), lambda s: s["done"])

    ip = F.array_join(F.reverse(turned(F.reverse(turned(octets, ">")), "<")).cast("array<string>"), ".")

    digits = _digits(entity)
    most = F.substring(digits, F.lit(1), F.char_length(digits) - 1)
    fresh = _permuted(most, own("card"), [_DIGITS])
    check = (F.substring(digits, -1, 1).cast("int") + _luhn(most) - _luhn(fresh)) % 10
    card = _refilled(entity, F.concat(fresh, F.pmod(check, F.lit(10)).cast("string")))
    ssn = _refilled(entity, _permuted(digits, own("ssn"), [_DIGITS]))
    code = _code(entity)
    rest = F.substring(digits, F.char_length(code) + 1, F.lit(99))
    phone = _refilled(entity, F.concat(code, _permuted(rest, own("phone"), [_DIGITS])))

    words, gender = _name_words(entity), _gender(entity)
    name = F.concat(_title(entity), F.array_join(_new_words(words, gender, own("name")), " "))

    return (
        F.when(kind == "email", _shaped(entity, email))
        .when(kind == "secret", F.when(entity.rlike("[a-z]"), _shaped(entity, secret)).otherwise(F.upper(secret)))
        .when(kind == "iban", _new_iban(entity, own("iban"))).when(kind == "ip", ip).when(kind == "card", card).when(kind == "ssn", ssn)
        .when(kind == "phone", phone).otherwise(name)
    )


def entities(text: Column) -> Column:
    """Mentions of a text in order, as ``kind, entity``."""
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    return F.transform(found, lambda e: F.struct(kind_of(e).alias("kind"), e.alias("entity")))


def collisions(found: DataFrame, key: str, tweak: int) -> tuple[int, int]:
    """Of distinct entities: surrogates that two of them share, and entities left as they are. One pass."""
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = found.repartition(parts, "canonical").select("kind", "canonical", surrogate(F.col("entity"), F.col("kind"), key, tweak).alias("s"))
    made = made.select("kind", "canonical", canonical(F.col("s"), F.col("kind")).alias("same"))
    shared = made.groupBy("kind", "same").agg(
        (F.count_distinct("canonical") - 1).alias("n"), F.max((F.col("same") == F.col("canonical")).cast("int")).alias("kept")
    )
    row = shared.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("kept"), F.lit(0)).alias("kept")).first()
    return row["n"], row["kept"]


def choose_tweak(docs: DataFrame, text: str = "text", key: str = KEY) -> int:
    """The first tweak under which no two entities of the corpus share a surrogate.

    Distinct entities are counted by Spark, one mention for each, and written once. A tweak
    that also leaves no entity as it is goes first; among tweaks without collisions the first.
    """
    mentions = docs.filter(F.col(text).rlike(_HINT)).select(F.explode(entities(F.col(text))).alias("m")).select("m.*")
    mentions = mentions.withColumn("canonical", canonical(F.col("entity"), F.col("kind")))
    found = materialize(mentions.groupBy("kind", "canonical").agg(F.min("entity").alias("entity")), "entities")
    distinct = None
    for tweak in range(ROUNDS):
        shared, kept = collisions(found, key, tweak)
        if not shared and not kept:
            return tweak
        if not shared and distinct is None:
            distinct = tweak
    if distinct is None:
        raise ValueError("no tweak keeps all surrogates distinct; choose another key")
    return distinct


def _bare(found: Column, key: str, tweak: int) -> Column:
    """What titled names of a text are without the title, ``bare, new``: whole names and single words, longer ones first.

    Single words that are ordinary words too (``ORDINARY``) are only part of whole names.
    """
    seed = F.lit(f"{key}|{tweak}|name")
    titled = F.transform(F.filter(found, lambda m: m["kind"] == "name"), lambda m: m["entity"])

    def forms(entity: Column) -> Column:
        words = _name_words(entity)
        whole = lambda new: F.struct(F.array_join(words, " ").alias("bare"), F.array_join(new, " ").alias("new"))
        single = lambda new: F.filter(
            F.zip_with(words, new, lambda w, n: F.struct(w.alias("bare"), n.alias("new"))),
            lambda z: z["bare"].rlike(r"^\p{Lu}.*[^.]$") & ~z["bare"].isin(ORDINARY),
        )
        both = lambda new: F.concat(F.filter(F.array(whole(new)), lambda z: F.size(words) > 1), F.reverse(single(new)))
        return F.flatten(F.transform(F.array(_new_words(words, _gender(entity), seed)), both))

    pairs = F.flatten(F.transform(titled, forms))
    length = lambda z: F.char_length(z["bare"])
    return F.array_sort(F.filter(pairs, lambda z: length(z) > 1), lambda x, y: length(y) - length(x))


def _pattern(bare: Column) -> Column:
    """PATTERN, and the bare names of one text after it."""
    quoted = F.array_distinct(F.transform(bare, lambda z: F.replace(z["bare"], F.lit("."), F.lit("\\."))))
    names = F.concat(F.lit(r"|(?<![\p{L}\p{M}])(?:"), F.array_join(quoted, "|"), F.lit(r")(?![\p{L}\p{M}])"))
    return F.concat(F.lit(PATTERN), F.when(F.size(quoted) > 0, names).otherwise(""))


def _with_mentions(docs: DataFrame, text: str, key: str, tweak: int) -> DataFrame:
    """Adds ``_found``, the mentions of a text, and ``_new``, the text with them replaced; null stays null.

    A name that stands after a title is also found where it stands without one in the same text.
    """
    none = F.array().cast("array<struct<kind:string,entity:string>>")
    some = docs.withColumn("_found", F.when(F.col(text).rlike(_HINT), entities(F.col(text))).otherwise(none))
    some = some.withColumn("_named", F.exists("_found", lambda m: m["kind"] == "name"))
    some = some.withColumn("_bare", F.when(F.col("_named"), _bare(F.col("_found"), key, tweak)))
    some = some.withColumn("_pattern", F.when(F.col("_named"), _pattern(F.col("_bare"))))
    every = F.transform(F.regexp_extract_all(F.col(text), F.col("_pattern"), F.lit(0)), lambda e: F.struct(
        F.when(F.exists("_bare", lambda z: z["bare"] == e), "name").otherwise(kind_of(e)).alias("kind"), e.alias("entity")
    ))
    some = some.withColumn("_found", F.when(F.col("_named"), every).otherwise(F.col("_found")))
    pieces = F.when(F.col("_named"), F.split(F.col(text), F.col("_pattern"), -1)).otherwise(F.split(F.col(text), PATTERN, -1))
    new = F.transform("_found", lambda m: F.coalesce(
        F.get(F.filter("_bare", lambda z: z["bare"] == m["entity"]), F.lit(0))["new"], surrogate(m["entity"], m["kind"], key, tweak)
    ))
    joined = F.zip_with(pieces, new, lambda p, s: F.concat(p, F.coalesce(s, F.lit(""))))
    some = some.withColumn("_new", F.when(F.size("_found") > 0, F.array_join(joined, "")).otherwise(F.col(text)))
    return some.drop("_named", "_bare", "_pattern")


def replace_entities(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """Documents with personal data replaced in ``text``; all other columns stay.

    A projection: surrogates follow from the key and the entity alone, so mentions of one
    entity agree everywhere, and no text is shuffled. Null and empty texts stay; repeated rows
    and clashing column names do not matter.
    """
    tweak = choose_tweak(docs, text, key)
    found = _with_mentions(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text).alias("_text")), "_text", key, tweak)
    return found.select(*[F.col("_new").alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns])


def surrogate_report(docs: DataFrame, key_column: str = "doc_id", text: str = "text", key: str = KEY) -> DataFrame:
    """``key, text, n_entities`` and a count for each type, for every row."""
    tweak = choose_tweak(docs, text, key)
    rows = _with_mentions(docs.select(F.col(key_column), F.col(text).alias("_text")), "_text", key, tweak)
    kinds = F.transform("_found", lambda m: m["kind"])
    counts = [(F.size("_found") - F.size(F.array_remove(kinds, k))).alias(f"n_{k}") for k in KINDS]
    return rows.select(key_column, F.col("_new").alias("text"), F.size("_found").alias("n_entities"), *counts)
