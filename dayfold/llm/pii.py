"""Surrogates for personal data, with DataFrame functions only.

Detected are e-mail addresses, phone, card, social security and IBAN numbers, IPv4 addresses,
cloud keys, long hexadecimal tokens, values after ``password=`` and names after a form of address.
Each entity is replaced by one of its own kind and format: digits by digits, letters by letters of
the same script and case, separators, prefixes that tell the kind and top-level domains stay; card
numbers that pass their check still do; names get names of the same gender, as the form of address
tells it, in the same script.

A surrogate follows from a secret key and the normal form of the entity alone: equal entities get
equal surrogates in all documents, whatever their case or separators, and so do the parts of a
name and the domains of addresses. Different entities may meet in one surrogate, or a surrogate may
be an entity that occurs; all distinct entities are checked for that, and those in the way try
again until none is. After some attempts a surrogate grows, or an address gets an octet above 255,
so that every entity gets one however many occur. Only these exceptions are joined to the documents.
What has no letter or digit to replace, such as a masked password, stays.

A null text stays null, an empty one empty, and a text without entities stays as it is. Repeated
rows get equal surrogates. Other columns, whatever their names, are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import free_names, small_side, written

KEY = "surrogate key, to be replaced by a secret one"

# Rounds of the collision check; each leaves a small part of the entities of the one before.
ROUNDS = 60

# Attempts that keep the length; those after them grow by a character each. Kinds of a fixed format
# have large spaces and keep it longer.
FREE, FIXED = 4, 30

# Forms of address by gender.
MALE = ("Mr", "Herr", "Herrn", "Señor", "Monsieur", "господин", "κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mademoiselle", "госпожа", "κυρία")
NEITHER = ("Mx", "Dr", "Prof")

_TITLES = "|".join(sorted(MALE + FEMALE + NEITHER, key=len, reverse=True))

# What is looked for, in this order at each place.
PATTERNS = (
    r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    r"(?<![\p{L}\p{N}])[Pp]assword[=:] ?[^\s\"']{4,}",
    r"(?<![\p{L}\p{N}])AKIA[0-9A-Z]{16}(?![\p{L}\p{N}])",
    r"(?<![\p{L}\p{N}])[0-9A-Fa-f]{32,128}(?![\p{L}\p{N}])",
    r"(?<![\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?\p{N})",
    r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{N}-])",
    r"(?<![\p{L}\p{N}-])[0-9](?:[ -]?[0-9]){12,18}(?![\p{N}-])",
    r"(?<![\p{L}\p{N}])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}(?!\p{N})",
    r"(?<![\p{L}\p{N}])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?!\p{N})",
    r"(?<![\p{L}\p{N}-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\p{N}-])",
    rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLES})\.? \p{{Lu}}\p{{Ll}}+(?: (?!(?:{_TITLES})(?!\p{{L}}))\p{{Lu}}\p{{Ll}}+)?(?![\p{{L}}\p{{N}}])",
)
ENTITY = "|".join(PATTERNS)

# A cheap look that every text with an entity passes: most texts need no more.
_HINT = rf"[0-9][ .-]?[0-9]|@|assword[=:]|AKIA|[0-9A-Fa-f]{{32}}|(?:{_TITLES})\.? \p{{Lu}}"

# Letters of each script that has its own, and syllables for names.
_ACCENTED, _CYRILLIC, _GREEK = "àáâãäåæçèéêëìíîïñòóôõöøùúûüý", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"
_ALPHABET = "abcdefghijklmnopqrstuvwxyz"
_SYMBOLS = "!#$%&*+-=?@^_~"
_LETTERS = {
    "Cyrillic": _CYRILLIC, "Greek": _GREEK, "Latin": _ACCENTED,
    "Han": "人大中国上下小天日月山水火木金土王李张刘陈杨赵黄周吴徐孙马朱胡林", "Hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほ",
    "Katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホ", "Hangul": "가나다라마바사아자차카타파하고노도로모보소오조초코토포호",
    "Arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת", "Armenian": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցփքօֆ",
    "Georgian": "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ", "Devanagari": "अआइईउऊकखगघचछजझटठडढतथदधनपफबभमयरलवशषसह", "Bengali": "কখগঘচছজঝটঠডঢতথদধনপফবভমযরলশষসহ",
    "Tamil": "கஙசஞடணதநபமயரலவழளறன", "Thai": "กขคฆงจฉชซฌญฎฏฐฑฒณดตถทธนบปผฝพฟภมยรลวศษสหอฮ",
}
_NUMERALS = ("٠١٢٣٤٥٦٧٨٩", "۰۱۲۳۴۵۶۷۸۹", "०१२३४५६७८९")
_SYLLABLES = {
    "latin": "ba be bo da de do fa ga ka la le li lo ma me mi mo na ne ni no pa ra re ri ro sa se si so ta te".split(),
    "cyrillic": "ба бе бо да де до га ка ла ле ли ло ма ме ми мо на не ни но па ра ре ри ро са се си со та те ва ве".split(),
    "greek": "βα βε βο δα δε δο γα κα λα λε λι λο μα με μι μο να νε νι νο πα ρα ρε ρι ρο σα σε σι σο τα τε φα".split(),
}
_ENDINGS = {  # of given names: male, female, either
    "latin": ("no", "na", "ne"), "cyrillic": ("н", "на", "не"), "greek": ("νος", "να", "νι"),
}


def _kind(m: Column) -> Column:
    """The kind of a match."""
    return (
        F.when(m.rlike(r"^[Pp]assword[=:]"), "password")  # before e-mail, as its value may have "@" in it
        .when(m.contains("@"), "email")
        .when(m.rlike(r"^AKIA[0-9A-Z]{16}$"), "cloud_key")
        .when(m.rlike(r"^[0-9A-Fa-f]{32,128}$"), "token")
        .when(m.rlike(r"^[0-9]+(\.[0-9]+){3}$"), "ip")
        .when(m.rlike(r"^[A-Z]{2}[0-9]{2}[A-Z0-9 ]+$"), "iban")
        .when(m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(m.rlike(r"^[0-9](?:[ -]?[0-9]){12,18}$"), "card")
        .when(m.rlike(r"^\p{L}"), "person")
        .otherwise("phone")
    )


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _normal(kind: Column, m: Column) -> Column:
    """The form in which mentions of one entity are alike."""
    return (
        F.when(kind.isin("email", "token"), F.lower(m))
        .when(kind == "password", F.regexp_replace(m, r"^[Pp]assword[=:] ?", ""))
        .when(kind.isin("ssn", "card"), _digits(m))
        .when(kind == "iban", F.replace(m, F.lit(" "), F.lit("")))
        .when(kind == "phone", F.when(F.length(_digits(m)) > 10, F.right(_digits(m), F.lit(10))).otherwise(_digits(m)))
        .otherwise(m)
    )


def _names(m: Column) -> Column:
    """Words after the form of address."""
    return F.slice(F.split(m, " "), 2, 2)


def _title(m: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(m, " "), 1), r"\.$", "")


def _gender(m: Column) -> Column:
    return F.when(_title(m).isin(*MALE), "m").when(_title(m).isin(*FEMALE), "f").otherwise("n")


def _entities(m: Column) -> Column:
    """The entities of a match, as kind and normal form: one, or the parts of a name or address."""
    kind = _kind(m)

    def entity(k, value):
        return F.struct(k.alias("kind"), value.alias("normal"))

    surname = entity(F.lit("surname"), F.lower(F.element_at(_names(m), -1)))
    given = entity(F.concat(F.lit("given_"), _gender(m)), F.lower(F.element_at(_names(m), 1)))
    return (
        F.when(kind == "person", F.when(F.size(_names(m)) > 1, F.array(surname, given)).otherwise(F.array(surname)))
        .when(kind == "email", F.array(
            entity(kind, F.lower(m)), entity(F.lit("domain"), F.substring_index(F.lower(m), "@", -1))))
        .otherwise(F.array(entity(kind, _normal(kind, m))))
    )


def _stream(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    """128 bytes, as hexadecimal digits, that only who has the key can tell."""
    seed = F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), normal)
    return F.concat(*[F.sha2(F.concat_ws("|", F.lit(str(i)), seed), 256) for i in range(4)])


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, (i % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, byte: Column) -> Column:
    return F.substring(F.lit(letters), byte % len(letters) + 1, F.lit(1))


def _alike(c: Column, byte: Column, low: Column) -> Column:
    """A character of the same sort as ``c``; letters of a script without a list become Latin ones."""
    own = (
        F.when(c.rlike("[0-9]"), "0123456789")
        .when(c.rlike("[a-z]"), low)
        .when(c.rlike("[A-Z]"), _ALPHABET)
        .when(c.rlike(r"[^\p{L}\p{N}]"), c)
    )
    for script, letters in _LETTERS.items():
        own = own.when(c.rlike(rf"[\p{{Is{script}}}&&\p{{L}}]"), letters)
    for digits in _NUMERALS:
        own = own.when(c.rlike(f"[{digits}]"), digits)
    own = own.when(c.rlike(r"\p{N}"), "0123456789").otherwise(_ALPHABET)
    return _cased(c, F.substring(own, byte % F.length(own) + 1, F.lit(1)))


def _cased(like: Column, c: Column) -> Column:
    return F.when(like.rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)


def _changed(text: Column, stream: Column, left: Column, right: Column, low: Column) -> Column:
    """The text with each character replaced by one alike, but for so many at either end."""
    n = F.length(text)

    def one(i):
        c = F.substring(text, i, F.lit(1))
        return F.when((i <= left) | (i > n - right), c).otherwise(_alike(c, _byte(stream, i), low))

    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), n), one), "")).otherwise(text)


def _symbols(text: Column, stream: Column) -> Column:
    """As many symbols as the text, which has no others, has."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: _pick(_SYMBOLS, _byte(stream, i))), "")


def _luhn(digits: Column) -> Column:
    """The check sum of a card number, 0 for a valid one."""
    n = F.length(digits)

    def one(i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    parts = F.transform(F.sequence(F.lit(0), n - 1), one)
    return F.aggregate(parts, F.lit(0), lambda a, b: a + b) % 10


def _name(normal: Column, stream: Column, size: Column, ending: int | None) -> Column:
    """A name of so many syllables in the script of the given one."""

    def in_script(script):
        listed = F.array(*[F.lit(s) for s in _SYLLABLES[script]])
        syllables = F.transform(F.sequence(F.lit(1), size), lambda i: F.element_at(listed, _byte(stream, i) % 32 + 1))
        made = F.array_join(syllables, "")
        return made if ending is None else F.concat(made, F.lit(_ENDINGS[script][ending]))

    return (
        F.when(normal.rlike(r"\p{IsCyrillic}"), in_script("cyrillic"))
        .when(normal.rlike(r"\p{IsGreek}"), in_script("greek"))
        .otherwise(in_script("latin"))
    )


def _bare(kind: Column, normal: Column) -> Column:
    """Whether an entity has nothing to replace: no letter or digit, and in a password one and the same symbol."""
    return (
        F.when(kind == "password", normal.rlike(r"^([^\p{L}\p{N}])\1*$"))
        .when(kind == "email", ~F.substring_index(normal, "@", 1).rlike(r"[\p{L}\p{N}]"))
        .when(kind == "domain", ~normal.rlike(r"[\p{L}\p{N}].*\."))
        .otherwise(F.lit(False))
    )


def _more(attempt: Column, steady: int, letter: str) -> Column:
    """By what an attempt beyond those that keep the length lengthens an entity, before its characters change."""
    return F.repeat(F.lit(letter), F.greatest(attempt - (steady - 1), F.lit(0)))


def surrogate(kind: Column, normal: Column, attempt: Column, stream: Column) -> Column:
    """What stands for an entity, in normal form.

    Addresses and tokens grow at the front, all others at the end.
    """
    free, digits = _more(attempt, FREE, "a"), _more(attempt, FIXED, "0")
    local = F.substring_index(normal, "@", 1)
    top = F.length(F.substring_index(normal, ".", -1)) + 1  # the top-level domain and its dot
    whole = F.struct(
        F.when(kind == "email", F.concat(free, local)).when(kind == "domain", F.concat(free, normal)).when(
            kind == "token", F.concat(digits, normal)).when(kind == "password", F.concat(normal, free)).otherwise(
            F.concat(normal, digits)).alias("text"),
        F.when(kind == "cloud_key", 4).when(kind == "iban", 2).when(kind == "card", 1).otherwise(0).alias("left"),
        F.when(kind == "domain", top).otherwise(0).alias("right"),
        F.when(kind == "token", "abcdef").otherwise(_ALPHABET).alias("low"),
    )
    first = _byte(stream, F.lit(0))  # no address that occurs has an octet above 255
    octets = [F.when(attempt < FIXED, first % 254 + 1).otherwise(first + 256).cast("string")]
    octets += [(_byte(stream, F.lit(i)) % 254 + 1).cast("string") for i in range(1, 4)]

    def checked(card):
        head = F.substring(card, F.lit(1), F.length(card) - 1)
        return F.concat(head, ((10 - _luhn(F.concat(head, F.lit("0")))) % 10).cast("string"))

    # Arrays of one, so that what is read more than once is made once.
    changed = F.transform(F.array(whole), lambda x: _changed(x["text"], stream, x["left"], x["right"], x["low"]))
    changed = F.transform(changed, lambda x: F.when((kind == "card") & (_luhn(normal) == 0), checked(x)).otherwise(x))
    out = (
        F.when(_bare(kind, normal), F.when(kind == "email", local).otherwise(normal))
        .when((kind == "password") & ~normal.rlike(r"[\p{L}\p{N}]"), _symbols(F.concat(normal, free), stream))
        .when(kind == "ip", F.concat_ws(".", *octets))
        .when(kind == "surname", _name(normal, stream, attempt + 4, None))
    )
    for i, gender in enumerate("mfn"):
        out = out.when(kind == f"given_{gender}", _name(normal, stream, attempt + 3, i))
    return out.otherwise(F.element_at(changed, 1))


def _lay_out(m: Column, kind: Column, parts: Column) -> Column:
    """The surrogate in the format of the mention; ``parts`` are those of its entities."""
    first, second = F.element_at(parts, 1), F.element_at(parts, 2)
    size = F.length(_normal(kind, m))
    grown = F.substring(first, size + 1, F.length(first))  # what an attempt that grows has added

    def digits(i):  # digits take the place of digits, counted from the right
        c = F.substring(m, i, F.lit(1))
        after = F.length(_digits(F.substring(m, i, F.length(m)))) - 1
        place = size - after
        return F.when(c.rlike("[0-9]") & (place > 0), F.substring(first, place, F.lit(1))).otherwise(c)

    def letters(i):  # for an IBAN, blanks stay where they are
        before = F.length(F.replace(F.substring(m, F.lit(1), i), F.lit(" "), F.lit("")))
        c = F.substring(m, i, F.lit(1))
        return F.when(c == " ", c).otherwise(F.substring(first, before, F.lit(1)))

    places = F.sequence(F.lit(1), F.length(m))
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    as_name = lambda original, name: F.when(original.rlike(r"^\p{Lu}"), F.initcap(name)).otherwise(name)
    title = F.element_at(F.split(m, " "), 1)
    return (
        F.when(kind == "email", F.concat(_with_case(local, first), F.lit("@"), _with_case(domain, second)))
        .when(kind == "password", F.concat(F.regexp_extract(m, r"^[Pp]assword[=:] ?", 0), first))
        .when(kind == "token", _with_case(m, first))
        .when(kind.isin("phone", "card", "ssn"), F.concat(F.array_join(F.transform(places, digits), ""), grown))
        .when(kind == "iban", F.concat(F.array_join(F.transform(places, letters), ""), grown))
        .when((kind == "person") & (F.size(parts) > 1), F.concat_ws(
            " ", title, as_name(F.element_at(_names(m), 1), second), as_name(F.element_at(_names(m), -1), first)))
        .when(kind == "person", F.concat_ws(" ", title, as_name(F.element_at(_names(m), 1), first)))
        .otherwise(first)
    )


def _with_case(like: Column, text: Column) -> Column:
    """The text, upper case where the other one, of the same length or shorter by what the text has
    grown at the front, is."""
    before = F.greatest(F.length(text) - F.length(like), F.lit(0))

    def one(i):
        c = F.substring(text, i, F.lit(1))
        return F.when((i > before) & F.substring(like, i - before, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)

    return F.when(like.rlike(r"\p{Lu}"), F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")).otherwise(text)


def mentions(text: Column) -> Column:
    """All entities' mentions in a text, in order; null where a look shows that there are none."""
    return F.when(text.rlike(_HINT), F.regexp_extract_all(text, F.lit(ENTITY), 0))


def entity_table(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct entities of all documents: ``kind`` and ``normal``."""
    found = docs.select(F.explode(mentions(F.col(f"`{text}`"))).alias("m"))
    parts = found.select(F.explode(_entities(F.col("m"))).alias("e"))
    return parts.select("e.kind", "e.normal").distinct()


def exceptions(entities: DataFrame, key: str = KEY) -> DataFrame | None:
    """Entities that need another attempt than the first, ``kind``, ``normal`` and ``attempt``.

    In each round the surrogates of all entities are compared with each other and with the entities
    that occur. Of those that meet, the one with the fewest attempts stays.
    """
    own = written(entities.withColumn("attempt", F.lit(0)), "entities")
    for _ in range(ROUNDS):
        stream = _stream(key, F.col("kind"), F.col("normal"), F.col("attempt"))
        with_stream = own.withColumn("stream", stream)
        value = surrogate(F.col("kind"), F.col("normal"), F.col("attempt"), F.col("stream"))
        # Local parts of addresses need to differ only within their domain.
        space = F.when(F.col("kind") == "email", F.concat(F.lit("email "), F.substring_index("normal", "@", -1))).otherwise(F.col("kind"))
        made = written(with_stream.select("kind", "normal", "attempt", space.alias("space"), value.alias("made")), "surrogates")
        order = F.struct("attempt", "normal")
        met = made.groupBy("space", "made").agg(F.count("*").alias("n"), F.min(order).alias("stays")).filter("n > 1")
        twice = made.join(met, ["space", "made"]).filter(order != F.col("stays")).select("kind", "normal")
        taken = made.select("space", F.when(F.col("kind") == "email", F.substring_index("normal", "@", 1)).otherwise(
            F.col("normal")).alias("made")).distinct()
        real = made.join(taken, ["space", "made"], "left_semi").select("kind", "normal")
        again = twice.unionByName(real).filter(~_bare(F.col("kind"), F.col("normal"))).distinct()
        again = written(again, "collisions")
        if again.isEmpty():
            rest = own.filter("attempt > 0")
            return None if rest.isEmpty() else rest
        marked = own.join(small_side(again.withColumn("again", F.lit(1))), ["kind", "normal"], "left")
        own = written(marked.select("kind", "normal", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt")), "entities")
    raise ValueError(f"entities without a surrogate of their own after {ROUNDS} rounds")


def _replaced(text: Column, attempts: Column | None, key: str) -> tuple[Column, Column]:
    """The text with surrogates, and the number of mentions."""
    found = mentions(text)

    def attempt(e):
        if attempts is None:
            return F.lit(0)
        return F.coalesce(F.element_at(attempts, F.concat_ws("|", e["kind"], e["normal"])), F.lit(0))

    # Each step makes an array, so that the next one reads what it needs of it more than once.
    known = F.transform(found, lambda m: F.struct(m.alias("m"), _kind(m).alias("kind"), _entities(m).alias("entities")))
    streams = F.transform(known, lambda x: F.struct(x["m"].alias("m"), x["kind"].alias("kind"), F.transform(
        x["entities"], lambda e: F.struct(
            e["kind"].alias("kind"), e["normal"].alias("normal"), attempt(e).alias("attempt"),
            _stream(key, e["kind"], e["normal"], attempt(e)).alias("stream"))).alias("entities")))
    made = F.transform(streams, lambda x: F.struct(x["m"].alias("m"), x["kind"].alias("kind"), F.transform(
        x["entities"], lambda e: surrogate(e["kind"], e["normal"], e["attempt"], e["stream"])).alias("parts")))
    laid = F.transform(made, lambda x: _lay_out(x["m"], x["kind"], x["parts"]))
    gaps = F.split(text, ENTITY, -1)
    joined = F.array_join(F.zip_with(gaps, laid, lambda g, r: F.concat(g, F.coalesce(r, F.lit("")))), "")
    return F.when(F.size(found) > 0, joined).otherwise(text), F.coalesce(F.greatest(F.size(found), F.lit(0)), F.lit(0)).cast("long")


def replace(docs: DataFrame, text: str = "text", key: str = KEY, count: str | None = None) -> DataFrame:
    """Documents, with their own columns, whose personal data is replaced; ``count`` names a column
    for the number of mentions, if one is wanted."""
    columns = docs.columns
    body = F.col(f"`{text}`")
    odd = exceptions(entity_table(docs, text), key)
    attempts = None
    if odd is not None:
        sha, tried = free_names(docs, "__sha", "__tried")
        docs = docs.withColumn(sha, F.sha2(body.cast("binary"), 256))
        in_texts = docs.select(sha, F.explode(mentions(body)).alias("m")).select(
            sha, F.explode(_entities(F.col("m"))).alias("e")).select(sha, "e.kind", "e.normal").distinct()
        pairs = in_texts.join(small_side(odd), ["kind", "normal"]).groupBy(sha).agg(F.map_from_entries(F.collect_set(
            F.struct(F.concat_ws("|", "kind", "normal"), "attempt"))).alias(tried))
        docs = docs.join(small_side(written(pairs, "tried")), sha, "left")
        attempts = F.col(tried)
    changed, n = _replaced(body, attempts, key)
    out = [changed.alias(c) if c == text else F.col(f"`{c}`") for c in columns]
    return docs.select(*out, *([n.alias(count)] if count else []))
