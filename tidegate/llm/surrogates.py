"""Surrogates for personal data: every entity found in a text is replaced by a keyed stand-in of its own type and format.

Found are e-mail and IP addresses, phone, card and account numbers, social security numbers, and names after a title. A stand-in
is made from a keyed hash of the entity's canonical spelling: lower case for e-mail and names, digits without separators for
numbers. So all spellings of an entity get stand-ins that agree, in all documents, and each keeps its own separators and case.
Numbers keep their length, phones their first digit after a plus, cards their first digit and a valid check digit where they had
one, e-mail its top-level domain, names the gender of the title and the script.

Stand-ins are checked over the whole corpus: if two entities of a type have the same one, or one is itself an entity there, all
but the first entity are keyed anew, until no clash is left. Short e-mail addresses and names have few stand-ins of their own form, so from the
second try on they get a letter or syllable more for every other try: there is always room. Numbers keep their length. Their
forms have 10**9 stand-ins and more; if ``TRIES`` do not part two entities, a corpus holds most numbers of a form, and that is an error.

Null and empty texts stay as they are. Rows are changed independently, so repeated rows come out alike; rows with the same
doc_id may have different texts. Other columns pass through, but for one called
n_entities, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.common import folded, unfolded
from tidegate.session import written

KEY = "tidegate"
TRIES = 60
MALE = "Mr|Herr|Monsieur|Señor|Sr|Sig|Don|Господин"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Doña|Госпожа"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
NAME = r"\p{Lu}[\p{L}’'-]*+"
IP = rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?!\d|\.\d)"
LOCAL_PHONE = r"(?<!\w)(?:\(\d{3}\) ?|\d{3}[-. ])\d{3}[-.]\d{4}(?!\w)"
SSN = r"(?<!\w)\d{3}-\d{2}-\d{4}(?!\w)"
# Phones and cards in groups of digits end where an entity with a form of its own begins; that alternative comes first. Without
# one, a phone has 15 digits at most, eleven after +1 if they end there, and a card written in one piece ends with it.
NEXT = f"{IP}|{SSN}|{LOCAL_PHONE}"
NUMBER = r"\d(?:[ -]?\d){12,18}(?!\w)"
GROUPS = r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)"
DIGIT = r"(?:(?:[ .-]?(?<=\+[\d .-]{1,4})\((?=\d{1,4}\))|\)[ .-]?|[ .-](?=\d\d))?\d)"
PHONE = (
    rf"(?<![\w+]){GROUPS}(?<=\+[ .()\d-]{{9,40}})(?=[ .-](?:{NEXT}|{NUMBER}))",
    rf"(?<![\w+])(?={GROUPS})\+(?:1{DIGIT}{{10}}|\d{DIGIT}{{4,14}})(?!\w)",
)
CARD = (
    rf"(?<!\w)\d(?:[ -]?\d){{12,18}}(?=[ -](?:{NEXT}))",
    r"(?<!\w)\d(?:(?:(?<!\d{13})[ -])?\d){12,18}(?!\w)",
)
PATTERNS = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    IP,
    *PHONE,
    LOCAL_PHONE,
    SSN,
    *CARD,
    rf"(?<!\w)[A-Z]{{2}}\d{{2}}(?: ?(?!{NEXT})[A-Z0-9]{{4}}){{3,7}}(?:(?: (?!{NEXT}))?[A-Z0-9]{{1,3}})?(?!\w)",
    rf"(?<!\p{{L}})(?:{MALE}|{FEMALE})\.? {NAME}(?: {NAME}){{0,2}}",
)
ENTITY = "|".join(PATTERNS)
LATIN = ("b d f g k l m n p r s t v z br tr", "a e i o u", "n r s k", "a")
CYRILLIC = ("б в г д з к л м н п р с т ф бр тр", "а е и о у", "н р в к", "а")


def kind(value: Column) -> Column:
    number = F.regexp_count(value, F.lit("[0-9]"))
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
        .when(value.rlike(r"^[+(]") | value.rlike(r"^\d{3}[-. ]\d{3}[-.]\d{4}$"), "phone")
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(value.rlike(r"^[0-9 -]+$") & (number >= 13), "card")
        .when(value.rlike(r"^[A-Z]{2}\d{2}"), "account")
        .otherwise("name")
    )


def canonical(value: Column) -> Column:
    k = kind(value)
    return F.when(k.isin("email", "ip"), F.lower(value)).otherwise(F.regexp_replace(value, "[^+0-9A-Z]", ""))


def parts(value: Column) -> Column:
    """The entities in a match, as structs of type and canonical spelling: one, or a name's given and last names apart."""
    gender = F.when(value.rlike(f"^(?:{FEMALE})(?![\\p{{L}}])"), "f").otherwise("m")
    names = F.slice(F.split(value, " "), F.lit(2), F.size(F.split(value, " ")))

    def named(word: Column, i: Column) -> Column:
        script = F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
        role = F.when(i == F.size(names) - 1, F.concat(F.lit("last:"), script)).otherwise(F.concat(F.lit("given:"), script, F.lit(":"), gender))
        return F.struct(role.alias("type"), F.lower(word).alias("canon"))

    single = F.array(F.struct(kind(value).alias("type"), canonical(value).alias("canon")))
    return F.when(kind(value) == "name", F.transform(names, named)).otherwise(single)


def _luhn(digits: Column) -> Column:
    def part(c: Column, i: Column) -> Column:
        twice = 2 * c.cast("int")
        return F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), part), F.lit(0), lambda a, x: a + x) % 10


def stand_in(type_: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The canonical spelling of an entity's stand-in."""
    stream = F.sha2(F.concat_ws("|", F.lit(key), type_, attempt.cast("string"), canon), 512)

    def number(i: Column | int) -> Column:
        return F.conv(F.substring(stream, 2 * F.pmod(i if isinstance(i, Column) else F.lit(i), F.lit(64)) + 1, F.lit(2)), 16, 10).cast("int")

    def fixed(i: Column) -> Column:
        first = F.when(canon.startswith("+"), 1).when(type_ == "card", 0).when(type_ == "account", 1).otherwise(-1)
        return (i <= first) | ((type_ == "email") & (i >= F.length(canon) - F.length(F.substring_index(canon, ".", -1))))

    def swapped(c: Column, i: Column) -> Column:
        other = (
            F.when(c.rlike("[0-9]"), (number(i) % 10).cast("string"))
            .when(c.rlike("[a-z]"), F.char(97 + number(i) % 26))
            .when(c.rlike("[A-Z]"), F.char(65 + number(i) % 26))
            .otherwise(c)
        )
        return F.when(fixed(i), c).otherwise(other)

    more = F.floor(attempt / 2).cast("int")
    added = F.when(more > 0, F.sequence(F.lit(1), more)).otherwise(F.array().cast("array<int>"))
    letters = F.array_join(F.transform(added, lambda i: F.char(97 + number(63 - i) % 26)), "")
    swapped_text = F.array_join(F.transform(F.split(canon, ""), swapped), "")
    plain = F.when(type_ == "email", F.concat(letters, swapped_text)).otherwise(swapped_text)
    check = F.substring(plain, F.lit(1), F.length(plain) - 1)
    valid = F.concat(check, ((10 - _luhn(F.concat(check, F.lit("0")))) % 10).cast("string"))
    card = F.when(_luhn(canon) == 0, valid).otherwise(plain)
    address = F.concat_ws(".", *[((number(2 * i) * 7 + number(2 * i + 1)) % 254 + 1).cast("string") for i in range(4)])

    def name(sounds: tuple[str, str, str, str]) -> Column:
        first, vowel, close, female = (F.array(*[F.lit(x) for x in group.split()]) for group in sounds)
        pick = lambda group, i: F.get(group, number(i) % F.size(group))
        longer = F.array_join(F.transform(added, lambda i: F.concat(pick(first, 6 + 2 * i), pick(vowel, 7 + 2 * i))), "")
        stem = F.concat(pick(first, 0), pick(vowel, 1), pick(first, 2), pick(vowel, 3), pick(first, 4), pick(vowel, 5), longer)
        return F.concat(stem, pick(close, 6), F.when(type_.endswith(":f"), pick(female, 7)).otherwise(F.lit("")))

    return (
        F.when(type_ == "card", card).when(type_ == "ip", address)
        .when(type_.contains("cyrillic"), name(CYRILLIC)).when(type_.contains("latin"), name(LATIN)).otherwise(plain)
    )


def rendered(value: Column, stand_ins: Column) -> Column:
    """The match with the stand-ins of its parts, in its own separators and case."""
    k = kind(value)
    only = F.get(stand_ins, F.lit(0))
    more = F.length(only) - F.length(value)  # letters that an e-mail address got in front

    def at(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(value, F.lit(1), i), "[^+0-9A-Z]", ""))
        return F.when(c.rlike("[+0-9A-Z]"), F.substring(only, before + 1, F.lit(1))).otherwise(c)

    def cased(c: Column, i: Column) -> Column:
        new = F.substring(only, i + 1 + more, F.lit(1))
        return F.when(c.rlike("[A-Z]"), F.upper(new)).otherwise(new)

    def word(w: Column, i: Column) -> Column:
        new = F.get(stand_ins, i - 1)
        return F.when(i == 0, w).when((F.length(w) > 1) & (F.upper(w) == w), F.upper(new)).otherwise(F.initcap(new))

    return (
        F.when(k == "ip", only)
        .when(k == "email", F.concat(F.substring(only, F.lit(1), more), F.array_join(F.transform(F.split(value, ""), cased), "")))
        .when(k == "name", F.array_join(F.transform(F.split(value, " "), word), " "))
        .otherwise(F.array_join(F.transform(F.split(value, ""), at), ""))
    )


def _found(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def clashes(docs: DataFrame, key: str) -> DataFrame:
    """``type, canon, attempt`` of the entities that need another than the first try, so that no two stand-ins agree."""
    each = docs.select(F.explode(_found(F.col("text"))).alias("value"))
    each = each.select(F.explode(parts(F.col("value"))).alias("e")).select("e.type", "e.canon").distinct()
    entities = written(each.withColumn("attempt", F.lit(0)), "entities")
    for _ in range(TRIES):
        made = entities.withColumn("made", stand_in(F.col("type"), F.col("canon"), F.col("attempt"), key))
        keepers = made.groupBy("type", "made").agg(F.min("canon").alias("first"), F.count(F.lit(1)).alias("n"))
        taken = entities.select(F.col("type").alias("_t"), F.col("canon").alias("_c"))
        own = keepers.join(taken, (F.col("type") == F.col("_t")) & (F.col("made") == F.col("_c")), "left")
        bad = own.where((F.col("n") > 1) | F.col("_c").isNotNull())
        bad = written(bad.select(F.col("type").alias("_t"), F.col("made").alias("_m"), F.when(F.col("_c").isNull(), F.col("first")).alias("_keep")), "clashes")
        if bad.isEmpty():
            return entities.where("attempt > 0")
        again = made.join(bad, (F.col("type") == F.col("_t")) & (F.col("made") == F.col("_m")), "left")
        more = F.when(F.col("_m").isNotNull() & ~F.col("canon").eqNullSafe(F.col("_keep")), 1).otherwise(0)
        entities = written(again.select("type", "canon", (F.col("attempt") + more).alias("attempt")), "entities")
    raise RuntimeError(f"{TRIES} tries left entities with the same stand-in")


def replaced(docs: DataFrame, key: str = KEY) -> DataFrame:
    """All rows of ``docs`` with their entities replaced in ``text``, and ``n_entities``."""
    again = written(clashes(docs, key), "attempts")
    df = folded(docs, "doc_id", "text").withColumn("_found", F.coalesce(_found(F.col("text")), F.array().cast("array<string>")))
    if again.isEmpty():
        df = df.withColumn("_again", F.lit(None).cast("map<string,int>"))
    else:
        row = F.xxhash64("text")
        each = df.select(row.alias("_row"), F.explode("_found").alias("value"))
        each = each.select("_row", F.explode(parts(F.col("value"))).alias("e")).select("_row", "e.type", "e.canon").distinct()
        tries = each.join(again, ["type", "canon"]).groupBy("_row")
        tries = tries.agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "type", "canon"), "attempt"))).alias("_again"))
        df = df.join(tries.withColumnRenamed("_row", "_r"), row == F.col("_r"), "left")

    def new(value: Column) -> Column:
        def one(e: Column) -> Column:
            attempt = F.coalesce(F.element_at("_again", F.concat_ws("|", e["type"], e["canon"])), F.lit(0))
            return stand_in(e["type"], e["canon"], attempt, key)

        made = F.transform(F.array(F.transform(parts(value), one)), lambda s: rendered(value, s))
        return F.get(made, F.lit(0))

    between = F.split("text", ENTITY, -1)
    both = F.transform(between, lambda s, i: F.concat(s, F.coalesce(F.get("_new", i), F.lit(""))))
    df = df.withColumn("_new", F.transform("_found", new))
    text = F.when(F.size("_found") == 0, F.col("text")).otherwise(F.array_join(both, ""))
    kept = [c for c in docs.columns if c != "n_entities"]
    return df.select(*unfolded(df, kept, ("doc_id", "text"), text=text), F.size("_found").cast("long").alias("n_entities"))
