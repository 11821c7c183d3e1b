"""Personal data replaced by keyed surrogates.

Entities are found by patterns: e-mail addresses, IPv4 and IPv6 addresses, card numbers,
telephone numbers, social security numbers, IBANs, access keys and names after a
form of address. Each is replaced by a made-up one of the same type and format: a
letter by a letter of the same script and case, a digit by a digit; a name by a name of the
same gender and script in the same case; a card number keeps its first digit and, if it had
one, a valid check digit; mail domains end in ``.example`` and IP addresses lie
in ranges that are never routed.

The surrogate is a function of the key, the type, the entity and an attempt
number, so an entity gets the same one in every document and run (coreference), also
where case or separators differ. No
two entities may share a surrogate and none may be given one that is itself an entity of
the corpus: the distinct entities are listed once, collisions are
found by grouping their surrogates, and all but the first entity of each group go on
to the next attempt until none is left. The texts that hold entities then take
their surrogates in a join.

A name is up to ``MAX_NAME_WORDS`` capitalised words and initials behind a title. Its words are what
gets surrogates: each word one of its own per gender, in lower case and collision-checked
like all entities; the name's surrogate has theirs in its own case, word by word, and initials go
through a keyed permutation of their alphabet (Latin, accented Latin, Cyrillic, Greek; others stay).
So names of different words differ, in every part that a mention shows, and "Mr Smith" agrees
with "Mr John Smith" in all documents. Where a document has one of its names once more without a title, or
its last word alone, that is replaced likewise; of persons of both genders with one last word the first counts.

Name words come from short lists first, then from syllables, one more with every attempt.

Defined cases: NULL and empty texts stay as they are and have no entities.
Repeated rows are rewritten alike. Overlapping matches: the one that starts first,
then the first in the order of ``PATTERNS``. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.words import fresh_name
from footfall.sources.workspace import materialize

# Forms of address and given names, by gender.
TITLES = {
    "male": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "Г-н", "господин", "Господин"],
    "female": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "Г-жа", "госпожа", "Госпожа"],
}
LATIN_NAMES = {
    "male": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leo"],
    "female": ["Alma", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Ida", "Julia", "Klara", "Lena"],
}
CYRILLIC_NAMES = {
    "male": ["Адам", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"],
    "female": ["Алла", "Белла", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Клара"],
}
# Further names: syllables of these consonants and vowels, and a last letter by gender.
SYLLABLES = {"latin": ("bdfgklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу")}
LAST_LETTERS = {"latin": {"male": "lnrs", "female": "a"}, "cyrillic": {"male": "лнрс", "female": "а"}}
# Initials, by alphabet.
ALPHABETS = [
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ",
    "АБВГДЕЁЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
]

TITLED = "|".join(TITLES["male"] + TITLES["female"])
# The word boundary of regular expressions may know ASCII letters only.
NO_LETTER = r"(?<![\p{L}\p{N}_])"
# An apostrophe belongs to a word, but not that of a genitive.
APOSTROPHE = r"(?:['’](?!s(?!\p{L}))[\p{L}-]++)"
# A capitalised word or an initial.
NAME_WORD = rf"(?:\p{{Lu}}(?:[\p{{L}}-]++{APOSTROPHE}*+|{APOSTROPHE}++)|\p{{Lu}}\.(?!\p{{L}}))"

# A longer run of capitalised words, a heading say, isn't all a name. (Java matches groups
# by recursion, so a run of any length would also overflow its stack.)
MAX_NAME_WORDS = 16

# Behind a word that announces a telephone number (of one length each, as some engines demand).
ANNOUNCED = "|".join(
    rf"(?<=\b{word}{end})" for word in ("[Tt]el", "[Pp]hone", "[Cc]all", "[Mm]obile", "[Ff]ax") for end in (" ", "[.:] ")
)

# Order matters: what an earlier pattern matches at a place, a later one doesn't get.
PATTERNS = {
    "email": r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "ipv4": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?![0-9])(?!\.[0-9])",
    "ipv6": (
        r"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*[0-9])"
        r"(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
        r"|(?=(?:[0-9A-Fa-f]*:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:]))(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})"
        r"(?![0-9A-Za-z:])"
    ),
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9_-])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|(?:gh[pousr]|sk|pk|xox[abp])[_-][A-Za-z0-9_-]{16,255}|[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9_-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[1-9][0-9]{3}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])",
    "phone": "|".join(
        [
            r"(?<![0-9A-Za-z+])\+(?=(?:[ .-]?[0-9]){8,15}(?![0-9]))[1-9][0-9]{0,2}(?:[ .-][0-9]{1,8}){2,6}(?![0-9])",
            r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
            r"(?<![0-9A-Za-z+])\+[0-9]{8,14}(?![0-9])",
            r"(?<![0-9A-Za-z+.-])0[1-9](?:[ .-][0-9]{2}){4}(?![0-9])",
            r"(?<![0-9A-Za-z+.-])0[1-9][0-9]{0,3}[ /-][0-9]{5,8}(?![0-9])",
            # Without separators only behind a word that announces a number.
            rf"(?=[0-9]{{9,15}}(?![0-9]))(?:{ANNOUNCED})[0-9]{{9,15}}",
        ]
    ),
    "name": rf"(?=\p{{Lu}})(?<={NO_LETTER}(?:{TITLED})\.? ){NAME_WORD}(?: {NAME_WORD}){{0,{MAX_NAME_WORDS - 1}}}+",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

# Without one of these no pattern can match. Keys alone match without digit or title.
HINT = (
    rf"[0-9@]|(?:{TITLED})\.? |(?:AKIA|ASIA)[A-Z]{{16}}"
    r"|(?:gh[pousr]|sk|pk|xox[abp])[_-][A-Za-z_-]{16}|[a-f]{32}|[A-F]{32}"
)


def _type(entity: Column) -> Column:
    """The first pattern that fits the whole entity.

    Names and bare telephone numbers stand behind a word that isn't part of the match, so
    they are what is left.
    """
    found = F.when(entity.rlike(r"\A[0-9]+\z"), "phone").otherwise("name")
    for name, pattern in reversed(list(PATTERNS.items())):
        if name != "name":
            found = F.when(entity.rlike(rf"\A(?:{pattern})\z"), name).otherwise(found)
    return found


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *parts), 512)


def _number(digest: Column, at: Column | int, span: int) -> Column:
    """A number below ``span`` from six hex digits of the digest."""
    at = F.lit(at) if isinstance(at, int) else at
    bits = F.conv(F.substring(digest, (at * 3) % 120 + 1, F.lit(6)), 16, 10).cast("bigint")
    return bits % span


def _letter(digest: Column, at: Column, letters: str) -> Column:
    return F.substring(F.lit(letters), (_number(digest, at, len(letters)) + 1).cast("int"), F.lit(1))


def _same_shape(text: Column, digest: Column, is_hex: Column) -> Column:
    """Letters and digits drawn anew, all other characters kept; hexadecimal stays so.

    What is drawn depends on the place among letters and digits alone, so a number
    written with other separators gets the same digits.
    """
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def drawn(c: Column, place: Column) -> Column:
        before = F.substring(text, F.lit(1), place)
        i = F.char_length(F.regexp_replace(before, "[^A-Za-z0-9]", ""))
        hex_digit = F.substring(digest, (i % 128) + 1, F.lit(1))
        return (
            F.when(is_hex, F.when(c.rlike("[A-F]"), F.upper(hex_digit)).otherwise(hex_digit))
            .when(c.rlike("[0-9]"), _number(digest, i, 10).cast("string"))
            .when(c.rlike("[a-z]"), _letter(digest, i, lower))
            .when(c.rlike("[A-Z]"), _letter(digest, i, upper))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), drawn), "")


def _luhn_sum(digits: Column, doubled_parity: Column) -> Column:
    """Sum of the digits, those at positions of the given parity doubled."""
    values = F.transform(
        F.split(digits, ""),
        lambda c, i: F.when(
            i % 2 == doubled_parity,
            F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2),
        ).otherwise(c.cast("int")),
    )
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _with_check_digit(entity: Column, drawn: Column) -> Column:
    """The last digit replaced by the right check digit, if the entity had the right one."""
    own = F.regexp_replace(entity, "[^0-9]", "")
    parity = F.char_length(own) % 2
    digits = F.regexp_replace(drawn, "[^0-9]", "")
    body = F.concat(F.substring(digits, F.lit(1), F.char_length(digits) - 1), F.lit("0"))
    check = (10 - _luhn_sum(body, parity) % 10) % 10
    valid = F.concat(
        F.substring(drawn, F.lit(1), F.char_length(drawn) - 1), check.cast("string")
    )
    return F.when(_luhn_sum(own, parity) % 10 == 0, valid).otherwise(drawn)


def _name_word(word: Column, digest: Column, attempt: Column) -> Column:
    """A name of the same gender and script, in lower case: a listed one first, then syllables."""

    def listed(names: dict[str, list[str]], gender: str) -> Column:
        options = [x.lower() for x in names[gender]]
        return F.element_at(F.lit(options), (_number(digest, 0, len(options)) + 1).cast("int"))

    def made(script: str, gender: str) -> Column:
        consonants, vowels = SYLLABLES[script]
        syllables = F.transform(
            F.sequence(F.lit(1), F.least(attempt, F.lit(6)) + 2),
            lambda i: F.concat(_letter(digest, i * 4, consonants), _letter(digest, i * 4 + 2, vowels)),
        )
        end = _letter(digest, F.lit(0), LAST_LETTERS[script][gender])
        # Those of women end in a vowel, so its place has a consonant before it.
        before = _letter(digest, F.lit(2), consonants) if gender == "female" else F.lit("")
        return F.concat(F.array_join(syllables, ""), before, end)

    def of_gender(gender: str) -> Column:
        cyrillic = word.rlike(r"\p{IsCyrillic}")
        return F.when(
            attempt == 0,
            F.when(cyrillic, listed(CYRILLIC_NAMES, gender)).otherwise(listed(LATIN_NAMES, gender)),
        ).otherwise(F.when(cyrillic, made("cyrillic", gender)).otherwise(made("latin", gender)))

    return F.when(F.col("gender") == "female", of_gender("female")).otherwise(of_gender("male"))


def _initial(initial: Column, key: str) -> Column:
    """Another initial; different ones stay different."""
    given, drawn = "", ""
    for letters in ALPHABETS:
        digest = hashlib.sha256(f"{key}\x1f{letters}".encode()).digest()
        shift = 1 + int.from_bytes(digest[:8], "big") % (len(letters) - 1)
        given, drawn = given + letters, drawn + letters[shift:] + letters[:shift]
    return F.translate(initial, given, drawn)


# What of an entity is kept in front of the part that is drawn anew, by type.
KEPT = {
    "phone": r"^\+[0-9]{1,3}(?=[ .-])",
    "iban": r"^[A-Z]{2}",
    "card": r"^[0-9]",
    "key": r"^(?:AKIA|ASIA|gh[pousr][_-]|sk[_-]|pk[_-]|xox[abp][_-])",
}


def with_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``surrogate`` for every row of ``type``, ``entity``, ``gender`` and ``attempt``."""
    entity, kind, digest = F.col("entity"), F.col("type"), F.col("digest")
    kept = F.lit("")
    for name, pattern in KEPT.items():
        kept = F.when(kind == name, F.regexp_extract(entity, f"({pattern})?", 1)).otherwise(kept)
    domain = F.lower(F.substring_index(entity, "@", -1))
    # Case and separators don't make another entity.
    same = F.when(kind.isin("email", "ipv6"), F.lower(entity)).when(
        kind.isin("card", "phone", "ssn", "iban"), F.regexp_replace(entity, "[^A-Z0-9]", "")
    )
    parts = entities.withColumns(
        {
            "digest": _digest(
                F.lit(key), kind, F.coalesce(same, entity), F.col("attempt").cast("string")
            ),
            # Addresses of one domain stay in one domain.
            "domain_digest": _digest(F.lit(key), F.lit("domain"), domain),
            "kept": kept,
            "is_hex": (kind == "key") & entity.rlike(r"\A(?:[0-9a-f]+|[0-9A-F]+)\z"),
        }
    )
    core = (
        F.when(kind.isin("word", "ipv4", "ipv6"), "")
        .when(kind == "email", F.substring_index(entity, "@", 1))
        .otherwise(F.expr("substring(entity, char_length(kept) + 1)"))
    )
    labels = F.when(kind == "email", F.regexp_replace(domain, r"\.[^.]*$", "")).otherwise("")
    drawn = parts.withColumns({"core": core, "labels": labels}).withColumns(
        {
            "drawn": F.concat("kept", _same_shape(F.col("core"), digest, F.col("is_hex"))),
            "domain": _same_shape(F.col("labels"), F.col("domain_digest"), F.lit(False)),
        }
    )
    ip = F.concat_ws(
        ".",
        (_number(digest, 0, 14) + 241).cast("string"),
        *[_number(digest, i, 256).cast("string") for i in (1, 2)],
        (_number(digest, 3, 254) + 1).cast("string"),
    )
    # Set aside for documentation.
    groups = [F.substring(digest, 4 * i + 1, 4) for i in range(6)]
    ipv6 = F.concat_ws(":", F.lit("2001:db8"), *groups)
    ipv6 = F.when(entity.rlike("[A-F]"), F.upper(ipv6)).otherwise(ipv6)
    surrogate = (
        F.when(kind == "email", F.concat("drawn", F.lit("@"), "domain", F.lit(".example")))
        .when(kind == "ipv4", ip)
        .when(kind == "ipv6", ipv6)
        .when(kind == "card", _with_check_digit(entity, F.col("drawn")))
        .when(kind == "word", _name_word(entity, digest, F.col("attempt")))
        .otherwise(F.col("drawn"))
    )
    helpers = ["digest", "domain_digest", "kept", "is_hex", "core", "labels", "drawn", "domain"]
    return drawn.withColumn("surrogate", surrogate).drop(*helpers)


def found_entities(docs: DataFrame) -> DataFrame:
    """``id`` and, in order, ``place``, ``entity``, ``type`` and ``gender`` of all matches.

    The gender is that of the title right before a name, which is the end of the
    text between the matches.
    """
    text = F.col("text")
    female = rf"{NO_LETTER}(?:{'|'.join(TITLES['female'])})\.? \z"
    matched = docs.where(text.rlike(HINT)).select(
        "id",
        F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1)).alias("entities"),
        F.split(text, ANY, -1).alias("between"),
    )
    rows = matched.where(F.size("entities") > 0).select(
        "id", F.posexplode(F.arrays_zip("entities", "between")).alias("place", "x")
    )
    return rows.where(F.col("x.entities").isNotNull()).select(
        "id",
        "place",
        F.col("x.entities").alias("entity"),
        _type(F.col("x.entities")).alias("type"),
        F.when(F.col("x.between").rlike(female), "female").otherwise("male").alias("gender"),
    )


def _canonical(found: DataFrame) -> DataFrame:
    """Gender matters for names alone: one surrogate for each other entity."""
    gender = F.when(F.col("type") == "name", F.col("gender")).otherwise("")
    return found.withColumn("gender", gender)


def resolve_collisions(entities: DataFrame, key: str) -> DataFrame:
    """The distinct entities with the first attempt whose surrogate is theirs alone.

    Distinct means distinct in ``type``, ``gender`` and ``entity``. Each round
    settles at least one entity of every group that shares a surrogate.
    """
    todo = entities.withColumn("attempt", F.lit(0))
    settled = None
    names = entities.select(F.col("type").alias("t_"), F.col("entity").alias("e_")).distinct()
    identity = F.struct("gender", "entity")
    while True:
        tried = materialize(with_surrogates(todo, key), "tried")
        if settled is not None:
            taken = settled.select(F.col("type").alias("t_"), F.col("surrogate").alias("e_"))
            taken = taken.unionAll(names)
        else:
            taken = names
        free = tried.join(
            taken, (F.col("type") == F.col("t_")) & (F.col("surrogate") == F.col("e_")), "left_anti"
        )
        first = free.groupBy(F.col("type").alias("t_"), F.col("surrogate").alias("s_")).agg(
            F.min(identity).alias("first")
        )
        won = (
            free.join(first, (F.col("type") == F.col("t_")) & (F.col("surrogate") == F.col("s_")))
            .where(identity == F.col("first"))
            .select("type", "gender", "entity", "attempt", "surrogate")
        )
        won = materialize(won, "won")
        settled = won if settled is None else materialize(settled.unionAll(won), "settled")
        todo = tried.join(won, ["type", "gender", "entity"], "left_anti").select(
            "type", "gender", "entity", (F.col("attempt") + 1).alias("attempt")
        )
        todo = materialize(todo, "todo")
        if todo.isEmpty():
            return settled


def surrogates(docs: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The entities of all documents by place, and the surrogate of each distinct one."""
    found = materialize(_canonical(found_entities(docs)), "found")
    distinct = materialize(found.select("type", "gender", "entity").distinct(), "distinct")
    is_name = F.col("type") == "name"
    words = distinct.where(is_name).select(
        "gender", "entity", F.posexplode(F.split("entity", " ")).alias("place", "word")
    )
    initial, word = F.col("word").rlike(r"\A\p{Lu}\.\z"), F.lower("word")
    own = words.where(~initial).select(F.lit("word").alias("type"), "gender", word.alias("entity"))
    settled = resolve_collisions(distinct.where(~is_name).unionAll(own.distinct()), key)
    of_word = settled.where("type = 'word'").select(
        F.col("gender").alias("g_"), F.col("entity").alias("w_"), "surrogate", "attempt"
    )
    title = F.concat(F.upper(F.substring("surrogate", 1, 1)), F.expr("substring(surrogate, 2)"))
    shown = (
        F.when(initial, _initial(F.col("word"), key))
        .when(F.col("word").rlike(r"\A[\p{Lu}'’-]{2,}\z"), F.upper("surrogate"))
        .otherwise(title)
    )
    by_place = F.array_sort(F.collect_list(F.struct("place", shown.alias("shown"))))
    names = (
        words.join(of_word, (F.col("gender") == F.col("g_")) & (word == F.col("w_")), "left")
        .groupBy("gender", "entity")
        .agg(
            F.coalesce(F.max("attempt"), F.lit(0)).alias("attempt"),
            F.array_join(F.transform(by_place, lambda x: x.shown), " ").alias("surrogate"),
        )
        .select(F.lit("name").alias("type"), "gender", "entity", "attempt", "surrogate")
    )
    return found, settled.where("type <> 'word'").unionByName(names)


def _mentions(places: Column) -> Column:
    """What untitled mentions of a text's names look like (``seen``), and their ``surrogate``."""
    names = F.filter(places, lambda x: x.person.isNotNull())
    whole = F.transform(names, lambda x: F.struct(x.person.alias("seen"), x.surrogate.alias("surrogate")))

    def last(x: Column) -> Column:
        words = F.split(x.person, " ")
        own = F.get(F.split(x.surrogate, " "), F.size(words) - 1)
        return F.struct(F.element_at(words, -1).alias("seen"), own.alias("surrogate"))

    # Initials alone say nothing.
    return F.filter(
        F.concat(whole, F.transform(names, last)), lambda x: x.seen.rlike(r"\p{L}{2}")
    )


def _mention_pattern(mentions: Column) -> Column:
    """A regular expression for all of them, the longest first."""
    seen = F.array_distinct(F.transform(mentions, lambda x: x.seen))
    by_length = F.array_sort(F.transform(seen, lambda x: F.struct((-F.length(x)).alias("n"), x.alias("x"))))
    # Names hold no other character that means something in a pattern.
    parts = F.transform(by_length, lambda x: F.replace(x.x, F.lit("."), F.lit("\\.")))
    return F.concat(
        F.lit(r"(?<![\p{L}\p{N}_])(?:"), F.array_join(parts, "|"), F.lit(r")(?![\p{L}\p{N}_])")
    )


def _interleaved(pieces: Column, between: Column) -> Column:
    """``pieces`` with one of ``between`` behind each but the last."""
    return F.array_join(
        F.flatten(F.zip_with(pieces, between, lambda x, s: F.array_compact(F.array(x, s)))), ""
    )


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with rewritten ``text`` and one more column, ``n_entities``.

    All other columns pass unchanged; an input column called ``n_entities`` is kept
    and the new one gets a longer name. Only texts that may hold an entity are
    shuffled. Entities belong to a text, by its digest, so copies share the work.
    """
    places, digest, count, other, mentions, pattern = (
        fresh_name(docs, c)
        for c in ("places_", "digest_", "n_entities", "found_in_", "mentions_", "pattern_")
    )
    hinted = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    found, chosen = surrogates(
        docs.where(hinted).select(F.md5("text").alias("id"), "text"), key
    )
    person = F.when(F.col("type") == "name", F.col("entity")).alias("person")
    by_text = (
        found.dropDuplicates(["id", "place"])
        .join(chosen, ["type", "gender", "entity"])
        .groupBy(F.col("id").alias(other))
        .agg(F.array_sort(F.collect_list(F.struct("place", "surrogate", person))).alias(places))
        .withColumn(mentions, _mentions(F.col(places)))
        .withColumn(pattern, F.when(F.size(mentions) > 0, _mention_pattern(F.col(mentions))))
    )
    by_text = materialize(by_text, "by_text")
    pieces = F.split("text", ANY, -1)

    def seen(piece: Column) -> Column:
        return F.regexp_extract_all(piece, F.col(pattern), F.lit(0))

    def surrogate_of(mention: Column) -> Column:
        return F.get(F.filter(mentions, lambda m: m.seen == mention), F.lit(0)).surrogate

    def without_names(piece: Column) -> Column:
        return _interleaved(F.split(piece, F.col(pattern), -1), F.transform(seen(piece), surrogate_of))

    untitled = F.transform(pieces, without_names)
    n_untitled = F.aggregate(pieces, F.lit(0), lambda n, piece: n + F.size(seen(piece)))
    n_untitled = F.when(F.col(pattern).isNull(), 0).otherwise(n_untitled)
    rewritten = _interleaved(
        F.when(F.col(pattern).isNull(), pieces).otherwise(untitled),
        F.transform(F.col(places), lambda x: x.surrogate),
    )
    new_text = F.when(F.col(places).isNull(), F.col("text")).otherwise(rewritten).alias("text")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    joined = (
        docs.where(hinted)
        .withColumn(digest, F.md5("text"))
        .join(by_text, F.col(digest) == F.col(other), "left")
        .select(
            *[new_text if c == "text" else F.col(f"`{c}`") for c in docs.columns],
            F.coalesce(F.size(places) + n_untitled, F.lit(0)).cast("long").alias(count),
        )
    )
    untouched = docs.where(~hinted).select(*cols, F.lit(0).cast("long").alias(count))
    return untouched.unionAll(joined)
