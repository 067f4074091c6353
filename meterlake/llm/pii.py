"""Surrogates for personal data.

Entities are found by pattern, brought to a canonical form, and given a replacement that a
secret key derives from type and canonical form: one entity gets one surrogate in every
document. Surrogates keep the type and its format: letters stay letters of the same case,
digits stay digits, card numbers pass the Luhn test, names keep title, gender and script. The
surrogates of all entities are checked against each other and against all originals; those
that collide are derived again, so that different entities stay different. Every word of a
name is an entity of its own, whatever the title and the case, and names are composed of theirs.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterlake.llm.common import free_names, row_key, stored

# The session's setting that holds the key; Spark hides settings of such names in its logs.
KEY_SETTING = "spark.meterlake.surrogates.secret"
# Attempts with the exact format; later ones are made longer until they are distinct.
SAME_FORMAT_ATTEMPTS = 8
# Of a name: 32 ** 5 are 33 million. Later attempts have more.
SYLLABLES = 5

# Titles that show a gender.
MALE_TITLES = ("Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor",
               "Господин", "Господина", "Κύριος", "Κύριε", "Κυρίου")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Madam", "Lady", "Frau", "Fräulein", "Madame", "Mme",
                 "Mademoiselle", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Signora",
                 "Госпожа", "Госпожи", "Κυρία", "Κυρίας")
OTHER_TITLES = ("Dr", "Prof", "Professor")
# Titles that are also written small before a name; "miss" and others are words as well.
SMALL_TITLES = ("Monsieur", "Madame", "Mademoiselle", "Señor", "Señora", "Señorita", "Signor",
                "Signora", "Господин", "Господина", "Госпожа", "Госпожи", "Κύριος", "Κύριε",
                "Κυρίου", "Κυρία", "Κυρίας")
# Small words inside a name, which stay.
PARTICLES = ("de", "del", "della", "den", "der", "di", "da", "do", "dos", "das", "du", "van",
             "von", "zu", "ter", "la", "le", "el", "al", "bin", "ibn", "y", "e")
LATIN = ("ba", "be", "bo", "da", "de", "do", "ka", "ke", "ko", "la", "le", "lo", "ma", "me", "mo",
         "na", "ne", "no", "ra", "re", "ro", "sa", "se", "so", "ta", "te", "to", "va", "ve", "vo",
         "zi", "mi")
CYRILLIC = ("ба", "бе", "бо", "да", "де", "до", "ка", "ке", "ко", "ла", "ле", "ло", "ма", "ме",
            "мо", "на", "не", "но", "ра", "ре", "ро", "са", "се", "со", "та", "те", "то", "ва",
            "ве", "во", "зи", "ми")
GREEK = ("βα", "βε", "βο", "δα", "δε", "δο", "κα", "κε", "κο", "λα", "λε", "λο", "μα", "με", "μο",
         "να", "νε", "νο", "ρα", "ρε", "ρο", "σα", "σε", "σο", "τα", "τε", "το", "φα", "φε", "φο",
         "ζι", "μι")
# Script, syllables, endings of given names (of men, of women) and of family names. Syllables
# have two letters, so that an ending can be told.
SCRIPTS = (
    ("IsCyrillic", CYRILLIC, ("н", "на"), ("нов", "нова")),
    ("IsGreek", GREEK, ("ς", "να"), ("ς", "υ")),
    ("L", LATIN, ("n", "na"), ("n", "n")),
)
ENDINGS = sorted({ending for *_, given, family in SCRIPTS for ending in given + family})
# Letters that replace others of their script.
LETTERS = (
    (r"\p{IsCyrillic}", "абвгдежзиклмно"),
    (r"\p{IsGreek}", "αβγδεζηθικλμνξ"),
    (r"\p{IsArabic}", "بتثجحخدذرزسشصض"),
    (r"\p{IsHebrew}", "אבגדהוזחטילמנס"),
    (r"\p{IsDevanagari}", "कखगघचछजझटठडढणत"),
    (r"\p{IsHangul}", "가나다라마바사아자차카타파하"),
    (r"\p{IsHiragana}", "かきくけこさしすせそたちつて"),
    (r"\p{IsKatakana}", "カキクケコサシスセソタチツテ"),
    (r"\p{IsHan}", "山川田木林森水火土金石花草竹"),
    (r"\p{L}", "abcdefghijklmnopqrstuvwxyz"),
)

TITLES = tuple(
    dict.fromkeys(
        [*MALE_TITLES, *FEMALE_TITLES, *OTHER_TITLES]
        + [t.upper() for t in (*MALE_TITLES, *FEMALE_TITLES, *OTHER_TITLES)]
        + [t.lower() for t in SMALL_TITLES]
    )
)
_TITLE = rf"(?:{'|'.join(TITLES)})\.? "
_FIRST_LETTERS = "".join(sorted({title[0] for title in TITLES}))
# What names a secret; the secret follows.
_LABEL = r"(?i:password|passwd|secret|token|api_?key|access_key)[ ]{0,2}[=:][ ]{0,2}[\"']?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Inside a word an apostrophe belongs to it, but for a possessive at its end.
_REST = r"[\p{L}\p{M}]*(?:['’](?![sS](?!\p{L}))[\p{L}\p{M}]+)*"
_WORD = rf"\p{{Lu}}(?=[\p{{L}}\p{{M}}'’-]\p{{L}}?){_REST}(?:[-‐‑]\p{{L}}{_REST})*"
_BEFORE = rf"(?:\p{{Lu}}\. ?|(?:{'|'.join(PARTICLES)}) ){{0,3}}"
_NAME = rf"(?:{_TITLE})+{_BEFORE}{_WORD}(?: (?!{_TITLE}){_BEFORE}{_WORD}){{0,3}}"
_GROUP = "[0-9A-Fa-f]{1,4}"
PATTERNS = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*-----END [A-Z ]*PRIVATE KEY-----",
    r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+",
    rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)",
    # IPv6: all eight groups, or a first one of four digits and a gap.
    rf"(?<![\p{{L}}\d:.])(?:(?:{_GROUP}:){{7}}{_GROUP}"
    rf"|(?=[a-fA-F:]*\d)[0-9A-Fa-f]{{4}}(?::{_GROUP}){{0,5}}::(?:{_GROUP}(?::{_GROUP}){{0,5}})?)"
    r"(?![\p{L}\d:])",
    r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    r"(?<![\p{L}\d])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3}(?:[ \-]?\d{1,3})?|\d{4}[ \-]\d{6}[ \-]\d{5})(?!\d)",
    r"(?<![\p{L}\d])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){1,4}(?!\d)",
    r"(?<![\p{L}\d])(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[.\-]\d{4}(?!\d)",
    r"(?<![\p{L}\d])[A-Z]{2}\d{2}(?: ?[A-Z\d]{4}){3,7}(?: ?[A-Z\d]{1,3})?(?![\p{L}\d])",
    r"(?<![\p{L}\d])(?:AKIA|ASIA)[A-Z\d]{16}(?![\p{L}\d])",
    r"(?<![\p{L}\d])(?:ghp_|gho_|sk-|xox[abp]-)[A-Za-z\d_\-]{16,}",
    rf"(?<![\p{{L}}]){_LABEL}[^\s\"'=:|&#%$*]{{6,}}",
    r"(?<![\p{L}\d])[0-9a-f]{32,}(?![\p{L}\d])",
    rf"(?<![\p{{L}}\d])(?=[{_FIRST_LETTERS}]){_NAME}",
)
ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS)
# Text without any of these holds no entity; much cheaper than the patterns.
_HINTS = ("PRIVATE KEY", "AKIA", "ASIA", "ghp_", "gho_", "sk-", "xox")
_LABEL_HINTS = ("passw", "secret", "token", "key")


def may_hold(text: Column) -> Column:
    hints = [text.contains(word) for word in _HINTS]
    lower = F.lower(text)
    labels = [lower.contains(word) for word in _LABEL_HINTS]
    # One pass for all titles: a search for each of them costs far more.
    found = text.rlike("[0-9@]") | text.rlike(rf"(?<![\p{{L}}\d])(?=[{_FIRST_LETTERS}]){_TITLE}")
    for hint in (*hints, *labels):
        found |= hint
    return found


def kind_of(value: Column) -> Column:
    """Type of a found entity."""
    digits = F.length(F.regexp_replace(value, r"\D", ""))
    return (
        F.when(value.startswith("-----BEGIN"), "key_block")
        .when(value.rlike(f"^{_LABEL}"), "secret")
        .when(value.rlike(r"^[^@\s]+@[A-Za-z0-9.\-]+$"), "email")
        .when(value.rlike(r"^\d+(?:\.\d+){3}$"), "ipv4")
        .when(value.contains(":") & value.rlike("^[0-9A-Fa-f:]+$"), "ipv6")
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(value.rlike(r"^[\d \-]+$") & (digits >= 13), "card")
        .when(value.rlike(r"^[+(\d][\d ().\-]+$") & (digits <= 19) & (digits >= 7), "phone")
        .when(titled(value, FEMALE_TITLES), "name_f")
        .when(titled(value, MALE_TITLES), "name_m")
        .when(titled(value, OTHER_TITLES), "name")
        .when(value.rlike(r"^[A-Z]{2}\d{2}(?: ?[A-Z\d]{4}){3,7}(?: ?[A-Z\d]{1,3})?$"), "iban")
        .otherwise("secret")
    )


def titled(value: Column, titles: tuple[str, ...]) -> Column:
    """Whether one of the titles stands among those before the name, in any case."""
    return value.rlike(rf"^(?:{_TITLE})*(?iu:{'|'.join(titles)})\.? ")


def canonical_of(kind: Column, value: Column) -> Column:
    """What the spellings of one entity have in common."""
    return (
        F.when(kind.isin("email", "ipv6"), F.lower(value))
        .when(kind.isin("card", "ssn"), F.regexp_replace(value, r"\D", ""))
        .when(kind == "phone", F.regexp_replace(value, r"[^+\d]", ""))
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .when(kind.startswith("name"), F.translate(F.lower(without_titles(value)), "’‐‑", "'--"))
        .otherwise(F.regexp_replace(value, f"^{_LABEL}", ""))
    )


def without_titles(name: Column) -> Column:
    return F.regexp_replace(name, f"^(?:{_TITLE})+", "")


# --- derivation


def noise(key: str, *parts: Column) -> Column:
    """128 hex digits that only the key's owner can derive."""
    text = F.concat_ws("\x1f", F.lit(key), *parts)
    return F.concat(F.sha2(text, 256), F.sha2(F.concat(text, F.lit("\x1f+")), 256))


def number(hexes: Column, i: Column) -> Column:
    """The i-th number below 65536 of the noise, starting over after 32."""
    return F.conv(F.substring(hexes, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def pick(alphabet: str, at: Column) -> Column:
    return F.substring(F.lit(alphabet), at % len(alphabet) + 1, F.lit(1))


def same_shape(value: Column, hexes: Column, keep: Column) -> Column:
    """Digits become digits, letters letters of their script and case; the first `keep` stay."""

    def swapped(char: Column, i: Column) -> Column:
        table = F.when(i < keep, "").when(char.rlike("[0-9]"), "0123456789")
        for script, letters in LETTERS:
            table = table.when(char.rlike(script), letters)
        return F.transform(F.array(table), lambda t: one_of(t, char, i))[0]

    def one_of(table: Column, char: Column, i: Column) -> Column:
        new = F.substring(table, number(hexes, i) % F.length(table) + 1, F.lit(1))
        cased = F.when(F.lower(char) == char, new).otherwise(F.upper(new))
        return F.when(F.coalesce(table, F.lit("")) == "", char).otherwise(cased)

    return F.array_join(F.transform(F.split(value, ""), swapped), "")


def hex_shape(value: Column, hexes: Column) -> Column:
    """For values of hex digits; colons stay."""

    def swapped(char: Column, i: Column) -> Column:
        return F.when(char == ":", char).otherwise(pick("0123456789abcdef", number(hexes, i)))

    return F.array_join(F.transform(F.split(value, ""), swapped), "")


def with_luhn(digits: Column) -> Column:
    """The last digit replaced by the check digit of those before it."""
    body = F.reverse(F.substring(digits, F.lit(1), F.length(digits) - 1))

    def weighed(char: Column, i: Column) -> Column:
        n = char.cast("int")
        doubled = F.when(n * 2 > 9, n * 2 - 9).otherwise(n * 2)
        return F.when(i % 2 == 0, doubled).otherwise(n)

    total = F.aggregate(
        F.transform(F.split(body, ""), weighed), F.lit(0), lambda a, x: a + x
    )
    return F.concat(F.reverse(body), ((F.lit(10) - total % 10) % 10).cast("string"))


def octets(hexes: Column) -> Column:
    parts = [(number(hexes, F.lit(i)) % 254 + 1).cast("string") for i in range(4)]
    return F.concat_ws(".", *parts)


def name_stem(key: str, word: Column, attempt: int) -> Column:
    """Syllables in the script of the word."""
    hexes = noise(key, F.lit("name"), word, F.lit(str(attempt)))
    size = SYLLABLES + max(0, attempt - SAME_FORMAT_ATTEMPTS + 1)

    def syllables(table: tuple) -> Column:
        choices = F.array(*map(F.lit, table))
        return F.concat(*(choices[number(hexes, F.lit(i)) % len(table)] for i in range(size)))

    return by_script(word, [syllables(table) for _, table, *_ in SCRIPTS])


def by_script(word: Column, values: list[Column]) -> Column:
    """The value that stands where the script of the word stands in `SCRIPTS`, else the last."""
    found = F.when(F.lit(False), values[-1])
    for (script, *_), value in zip(SCRIPTS[:-1], values):
        found = found.when(word.rlike(rf"\p{{{script}}}"), value)
    return found.otherwise(values[-1])


def initial(key: str, letter: Column) -> Column:
    """Another letter for an initial: the alphabet turned by a number that the key gives."""
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω"):
        digest = hashlib.sha256(f"{key}\x1finitial".encode()).digest()
        turn = 1 + int.from_bytes(digest[:8], "big") % (len(alphabet) - 1)
        letter = F.translate(letter, alphabet, alphabet[turn:] + alphabet[:turn])
    return letter


def surrogate(key: str, kind: Column, canonical: Column, attempt: int) -> Column:
    """The canonical surrogate of all but names."""
    tried = F.lit(str(attempt))
    hexes = noise(key, kind, canonical, tried)
    text = F.when(kind == "email", F.substring_index(canonical, "@", 1)).otherwise(canonical)
    prefixed = (kind == "secret") & canonical.rlike("^(?:AKIA|ASIA|ghp_|gho_|xox.-)")
    keep = (
        F.when((kind == "iban") | (kind == "phone") & canonical.startswith("+"), 2)
        .when(prefixed, 4)
        .otherwise(0)
    )

    def finished(shaped: Column) -> Column:
        return (
            F.when(kind == "email", F.concat(shaped, F.lit("@example.net")))
            .when(kind == "ipv4", octets(hexes))
            .when(kind == "card", with_luhn(shaped))
            .when(kind == "ssn", F.concat(F.lit("9"), F.substring(shaped, 2, 8)))
            .when(kind == "key_block", F.concat(F.lit("[private key "), F.substring(hexes, 1, 16), F.lit("]")))
            .when((kind == "ipv6") | (kind == "secret") & canonical.rlike("^[0-9a-f]+$"), hex_shape(canonical, hexes))
            .otherwise(shaped)
        )

    # A lambda's argument stands in the plan once, however often it is used.
    made = F.transform(F.array(same_shape(text, hexes, keep)), finished)[0]
    if attempt < SAME_FORMAT_ATTEMPTS:
        return made
    more = F.conv(F.substring(hexes, 1, 12), 16, 10)
    return F.when(kind == "email", F.concat(more, made)).otherwise(F.concat(made, more))


def in_format_of(value: Column, kind: Column, made: Column) -> Column:
    """The canonical surrogate in the spelling of one occurrence."""
    digits = F.regexp_replace(made, r"\D", "")
    shape = F.transform(
        F.split(value, ""), lambda char, i: F.struct(char.alias("char"), char.rlike(r"\d").alias("d"))
    )
    spelled = F.aggregate(
        shape,
        F.struct(F.lit("").alias("text"), F.lit(0).alias("used")),
        lambda state, c: F.when(
            c["d"],
            F.struct(
                F.concat(state["text"], F.substring(digits, state["used"] + 1, F.lit(1))).alias("text"),
                (state["used"] + 1).alias("used"),
            ),
        ).otherwise(
            F.struct(F.concat(state["text"], c["char"]).alias("text"), state["used"].alias("used"))
        ),
    )
    spelled_name = without_titles(value)
    large = (F.upper(spelled_name) == spelled_name) & spelled_name.rlike(r"\p{Lu}{2}")
    name = F.when(large, F.upper(made)).otherwise(made)
    longer = F.concat(spelled["text"], F.substring(digits, spelled["used"] + 1, F.length(digits)))
    return (
        F.when(kind.isin("phone", "card", "ssn"), longer)
        .when(kind.startswith("name"), F.concat(F.regexp_extract(value, f"^(?:{_TITLE})+", 0), name))
        .otherwise(F.concat(F.regexp_extract(value, f"^(?:{_LABEL})?", 0), made))
    )


# --- tables


def session_key(spark: SparkSession) -> str:
    """The key of the session's setting. Where it is unset, a random one is set for the session:
    then surrogates agree within the session only."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def entities(docs: DataFrame, row: str) -> DataFrame:
    """`row, at, kind, value, canonical`: every entity of every document, in order."""
    return (
        docs.select(
            F.col(row).alias("row"),
            F.posexplode(F.regexp_extract_all("text", F.lit(ANY), 0)).alias("at", "value"),
        )
        .withColumn("kind", kind_of(F.col("value")))
        .withColumn("canonical", canonical_of(F.col("kind"), F.col("value")))
    )


def assign(found: DataFrame, key: str | None = None) -> DataFrame:
    """`kind, canonical, surrogate` for each different entity of `found(kind, canonical)`.

    No two of one kind share a surrogate, and no surrogate is an original of its kind; for this,
    words of names are of one kind, whatever the title. Without `key` see `session_key`.
    """
    key = key or session_key(found.sparkSession)
    originals = stored(found.select("kind", "canonical").distinct(), "entities")
    is_name = F.col("kind").startswith("name")
    others = originals.where(~is_name)
    taken = others.select("kind", F.col("canonical").alias("surrogate"))

    def made(attempt: int) -> Column:
        return surrogate(key, F.col("kind"), F.col("canonical"), attempt)

    return collision_rounds(others, taken, made).unionByName(
        assign_names(originals.where(is_name), key)
    )


def collision_rounds(
    originals: DataFrame, taken: DataFrame, made: Callable[[int], Column]
) -> DataFrame:
    """`kind, canonical, surrogate`: distinct in each kind, and none of `taken`.

    Of entities that collide the smallest keeps the surrogate, the others try again.
    """
    pending, assigned, attempt = originals, None, 0
    while True:
        tried = pending.withColumn("surrogate", made(attempt))
        free = tried.join(taken, ["kind", "surrogate"], "left_anti")
        given = stored(
            free.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical")), "surrogates"
        )
        assigned = given if assigned is None else assigned.unionByName(given)
        pending = stored(pending.join(given, ["kind", "canonical"], "left_anti"), "pending")
        if pending.isEmpty():
            return assigned
        taken = taken.unionByName(given.select("kind", "surrogate"))
        attempt += 1


def assign_names(names: DataFrame, key: str) -> DataFrame:
    """`kind, canonical, surrogate` of names. A word keeps its surrogate alone, with others, in a
    compound and under any title; gender only chooses the ending. Initials become other
    initials, small words between names stay."""
    parts = F.regexp_extract_all(F.lower("canonical"), F.lit("[^ -]+|[ -]"), 0)
    exploded = stored(
        names.select("kind", "canonical", F.posexplode(parts).alias("at", "part"))
        .withColumn("at", F.col("at").cast("int")),
        "name-parts",
    )
    part, given_until = F.col("part"), F.col("last_gap")
    # A word has two letters at least, as `_WORD` has.
    is_word = part.rlike(r"\p{L}['\p{L}\p{M}]") & ~part.isin(*PARTICLES) & ~part.endswith(".")
    words = exploded.where(is_word).select(F.lit("word").alias("kind"), part.alias("canonical"))
    words = stored(words.distinct(), "name-words")
    # A stem that would give an original with some ending is taken.
    stems = F.array(*(F.regexp_extract("canonical", f"^(.+){e}$", 1) for e in ENDINGS))
    taken = words.select("kind", F.explode(stems).alias("surrogate")).where("surrogate <> ''")
    found = collision_rounds(
        words, taken.distinct(), lambda n: name_stem(key, F.col("canonical"), n)
    )
    # Words behind the last space are of the family.
    gaps = exploded.groupBy("kind", "canonical").agg(
        F.coalesce(F.max(F.when(part == " ", F.col("at"))), F.lit(-1)).alias("last_gap")
    )
    stem_of = found.select(F.col("canonical").alias("part"), F.col("surrogate").alias("stem"))
    female = F.col("kind") == "name_f"
    given, family = (
        by_script(part, [F.when(female, endings[1]).otherwise(endings[0]) for endings in table])
        for table in zip(*((g, f) for *_, g, f in SCRIPTS))
    )
    ending = F.when(F.col("at") > given_until, family).otherwise(given)
    other = F.when(part.endswith("."), F.upper(initial(key, part))).otherwise(part)
    made = F.coalesce(F.initcap(F.concat("stem", ending)), other)
    return (
        exploded.join(stem_of, "part", "left")
        .join(gaps, ["kind", "canonical"])
        .groupBy("kind", "canonical")
        .agg(F.sort_array(F.collect_list(F.struct("at", made.alias("made")))).alias("parts"))
        .select("kind", "canonical", F.array_join("parts.made", "").alias("surrogate"))
    )


def redact(docs: DataFrame, key: str | None = None) -> DataFrame:
    """The rows of `docs` with surrogates in `text`, and `n_entities` (long) added, as by
    `with_surrogates`. A column of that name is replaced."""
    return with_surrogates(docs.drop("n_entities"), key, "n_entities")


def with_surrogates(
    docs: DataFrame, key: str | None = None, count: str | None = None
) -> DataFrame:
    """The rows of `docs` with surrogates in `text`; their number in a new column `count`.

    Documents without entities pass through without a shuffle. Null and empty texts stay as
    they are, with 0 entities; long texts are searched whole. Rows that repeat a doc_id are
    treated each by its own text; a null doc_id is no obstacle. Other columns stay, whatever
    their names; an empty table gives no rows. Without `key` see `session_key`.
    """
    row, woven_in = free_names(docs, "row", "made")
    hit = F.coalesce(may_hold(F.col("text")) & F.col("text").rlike(ANY), F.lit(False))
    counted = {count: F.lit(0).cast("long")} if count else {}
    clean = docs.where(~hit).withColumns(counted)
    private = stored(docs.where(hit).withColumn(row, row_key()), "private")
    found = stored(entities(private.select(row, "text"), row).distinct(), "occurrences")
    replaced = (
        found.join(assign(found, key), ["kind", "canonical"])
        .withColumn("made", in_format_of(F.col("value"), F.col("kind"), F.col("surrogate")))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("at", "made"))).alias("made"))
        .select(F.col("row").alias(row), F.col("made").alias(woven_in))
    )
    between = F.split("text", ANY, -1)
    woven = F.zip_with(
        between,
        F.col(woven_in)["made"],
        lambda gap, made: F.concat(gap, F.coalesce(made, F.lit(""))),
    )
    changed = (
        private.join(replaced, row)
        .withColumn("text", F.array_join(woven, ""))
        .withColumns({name: F.size(woven_in).cast("long") for name in counted})
    )
    return clean.unionByName(changed.select(*clean.columns))


def digest(docs: DataFrame) -> DataFrame:
    """`doc_id, n_entities, redacted_text` for every row; a null text counts as empty."""
    return redact(docs.select("doc_id", "text")).select(
        "doc_id", "n_entities", F.coalesce("text", F.lit("")).alias("redacted_text")
    )
