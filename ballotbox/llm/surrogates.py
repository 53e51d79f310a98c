"""Personal data replaced by keyed surrogates, in DataFrame functions only.

Entities are found by one pattern over the whole text: mail addresses, access
keys and hexadecimal secrets, IBANs, US social security numbers, IPv4 addresses,
card numbers, phone numbers, and names after a form of address or a common given
name. An entity's canonical form and a secret key give its surrogate by a keyed
digest, so one entity has one surrogate in all documents and formats:

* mail addresses in lower case, numbers without separators;
* phone numbers as their national number, with or without country code and trunk zero;
* names by their parts, so that ``Mr Smith``, ``Mr. Smith's`` and ``Mrs. Ann Smith`` share
  a family name. A given name's gender is its own or that of the form of address.

Surrogates keep the type: letters stay letters, digits digits, and case, separators,
top-level domains, country marks, key prefixes and forms of address stay;
addresses stay valid; card numbers and IBANs with a right check digit get one; a
name keeps its gender and script. A long number without separators is a card number
if it has 16 digits or a right check digit.

Collision checks keep distinct entities distinct: in each round, of the entities
that want one surrogate the least gets it, unless it is taken or is itself an
entity of the corpus; the others draw again with the next round's number. From
round ``GROW`` on surrogates get longer by a character a round, so shapes with few
surrogates (``x@y.co``) run out of none.

Only entities are shuffled for that. Texts are shuffled once, to meet their
surrogates; positions come from splitting the text with the same pattern, so a
replacement is never searched for by its text. Patterns have bounded repeats and
start at token borders, so a very long token costs no more than its length.

Defined cases. NULL text: stays NULL, no entities. Empty text: unchanged. NULL
doc_id: kept. Rows equal in doc_id and text share their replacements; rows that
share a doc_id with other texts do not. Empty table: empty result. Other columns
are kept by ``apply``, also ones named like the added ``n_entities``, which
``apply`` does not add.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ballotbox.llm.common import materialize, text_key

KEY = "surrogate-key"       # a default for tests; pass the deployment's own secret
ROUNDS, GROW = 64, 3

# Patterns in order of precedence; forms of address by gender.
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа|Κυρία"
MALE = "Mr|Herr|Monsieur|Señor|Sr|Господин|Κύριος"
NEUTRAL = "Dr|Prof"
TITLE = rf"(?:{FEMALE}|{MALE}|{NEUTRAL})\.?"
# Given names that make a name of a capital word after them, by gender.
GIRLS = ("Alice|Amanda|Amy|Andrea|Angela|Anna|Anne|Ann|Barbara|Carol|Catherine|Christine|Claire|Clara|Deborah|Diana|Elena|Elizabeth|"
         "Emily|Emma|Eva|Greta|Hannah|Helen|Ingrid|Irene|Isabel|Jane|Jennifer|Jessica|Julia|Karen|Kate|Katherine|Laura|Linda|"
         "Lisa|Lucy|Margaret|Maria|Marie|Martha|Mary|Monica|Nancy|Nicole|Olivia|Patricia|Paula|Rachel|Rebecca|Rosa|Ruth|Sandra|"
         "Sarah|Sofia|Sophie|Susan|Teresa|Ursula|Vera|Victoria")
BOYS = ("Adam|Alan|Albert|Alexander|Andrew|Anthony|Antonio|Arthur|Benjamin|Brian|Carlos|Charles|Christopher|Daniel|David|Dennis|"
        "Edward|Eric|Felix|Francis|Frank|Fred|George|Gregory|Hans|Harry|Henry|Hugo|Ivan|Jack|Jacob|James|Jason|Jean|Jeffrey|John|"
        "Jonathan|Jose|Joseph|Juan|Karl|Kevin|Klaus|Kurt|Louis|Luis|Manuel|Mark|Martin|Matthew|Michael|Nicholas|Oliver|Oscar|"
        "Patrick|Paul|Pedro|Peter|Philip|Pierre|Ralph|Richard|Robert|Roger|Samuel|Simon|Stephen|Steven|Thomas|Timothy|Victor|"
        "Walter|William")
# Country calling codes of one and two digits; all others have three.
COUNTRY = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
_WORD = r"\p{Lu}[\p{L}'-]{1,30}"
PHONES = [
    r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}",
    r"(?:(?:\+|00)[1-9][0-9]{0,2}[ .-]?(?:\(0\)[ .-]?)?|0)[1-9][0-9]{0,2}(?:[ .-][0-9]{2}){3,4}",      # 01 23 45 67 89
    r"(?:(?:\+|00)[1-9][0-9]{0,2}[ .-]?(?:\(0\)[ .-]?)?|0|(?=[89]))[1-9][0-9][ .-][0-9]{3}(?:[ .-][0-9]{2}){2}",      # 91 123 45 67
    r"[6-9][0-9]{2}(?:[ .-][0-9]{2}){3}",                                                               # 612 34 56 78
    r"\+[1-9][0-9]{0,2}[ .-]?[0-9]{6,12}",                                                              # no separators
    r"\+(?=[0-9](?:[ .-]?[0-9]){6})[1-9][0-9]{0,2}[ .-]?[0-9]{1,4}(?:[ .-][0-9]{2,4}){1,4}",            # +33 1 2345 6789
]
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "hex": r"(?<![A-Za-z0-9])[0-9a-f]{32,128}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "ip": rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])",
    "card": (r"(?<![0-9])(?:[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{1,4}(?: [0-9]{1,3})?|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{1,4}(?:-[0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}"
             r"|(?!97[89][0-9]{10}(?![0-9]))[0-9]{13,19})(?![0-9])"),
    "phone": rf"(?<![0-9A-Za-z])(?:{'|'.join(PHONES)})(?![0-9])",
    "name": rf"(?<!\p{{L}})(?:{TITLE} {_WORD}(?: {_WORD})?|(?:{GIRLS}|{BOYS}) {_WORD})",
}
ANY = "|".join(PATTERNS.values())
GIVEN = {       # by script and gender
    ("latin", "f"): "Anna Clara Diana Elena Irene Julia Laura Maria Nora Paula Rosa Sofia Teresa Vera Alma Livia",
    ("latin", "m"): "Adrian Bruno Carl David Emil Felix Hugo Ivan Karl Leo Martin Oscar Paul Robert Simon Victor",
    ("latin", "n"): "Alexis Andrea Charlie Dominique Jamie Jordan Kim Lou Morgan Noel Pat Robin Sam Sascha Sidney Toni",
    ("cyrillic", "f"): "Анна Вера Елена Ирина Мария Ольга Софья Татьяна",
    ("cyrillic", "m"): "Алексей Борис Виктор Иван Максим Николай Павел Сергей",
    ("cyrillic", "n"): "Саша Женя Валя Слава",
    ("greek", "f"): "Άννα Ελένη Ειρήνη Μαρία Σοφία Κατερίνα Δήμητρα Ζωή",
    ("greek", "m"): "Γιώργος Νίκος Κώστας Πέτρος Παύλος Στέφανος Ανδρέας Λεωνίδας",
    ("greek", "n"): "Άλεξ Ρένα Φίλη Χάρη",
}
SYLLABLES = {
    "latin": "ba de fi go ku la me ni po ru sa te vi lo ma ren bel dor fan gil har kos lin mar nes pol ril sol tan ver wen zan",
    "cyrillic": "ба де фи го ку ла ме ни по ру са те ви ло ма рен бел дор ган лин мар нес пол тан вер зан ков рин лев сан мир дан",
    "greek": "βα δε φι γο κυ λα με νι πο ρυ σα τε λο μα ρεν βελ δορ γαν λιν μαρ νες πολ ταν ζαν κος ριν λεβ σαν μιρ δαν θεο πα",
}


def kind_of(value: Column) -> Column:
    """The first type whose pattern takes all of the value."""
    return reduce(lambda rest, k: F.when(value.rlike(f"^(?:{PATTERNS[k]})$"), F.lit(k)).otherwise(rest),
                  reversed(list(PATTERNS)), F.lit("name"))


def _body(value: Column) -> Column:
    """The parts of a name without its form of address."""
    return F.split(F.regexp_replace(value, f"^{TITLE} ", ""), " ")


def _given(value: Column) -> Column:
    """Gender and given name of a name, NULL where it has none."""
    parts, title = _body(value), F.regexp_extract(value, f"^({TITLE}) ", 1)
    given = F.when(F.size(parts) == 2, F.element_at(parts, 1))
    gender = (F.when(title.rlike(rf"^(?:{FEMALE})\.?$") | given.rlike(f"^(?:{GIRLS})$"), F.lit("f"))
              .when(title.rlike(rf"^(?:{MALE})\.?$") | given.rlike(f"^(?:{BOYS})$"), F.lit("m")).otherwise(F.lit("n")))
    return F.concat(gender, F.lit(":"), given)


_AFTER = r"(?:'s|['-])*$"       # what a family name ends on and is no part of it


def canonical(kind: Column, value: Column) -> Column:
    """The form that all occurrences of an entity share (of a name: its family name)."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    national = (F.when(value.startswith("+"), F.regexp_replace(digits, f"^(?:{COUNTRY})0?", ""))
                .when(value.startswith("00"), F.regexp_replace(digits, f"^00(?:{COUNTRY})0?", ""))
                .otherwise(F.regexp_replace(digits, "^0", "")))
    return (F.when(kind == "email", F.lower(value)).when(kind == "phone", national)
            .when(kind.isin("iban", "ssn", "card"), F.regexp_replace(value, r"[ -]", ""))
            .when(kind == "name", F.regexp_replace(F.element_at(_body(value), -1), _AFTER, ""))
            .otherwise(value))


def luhn(digits: Column) -> Column:
    """Check sum of a card number modulo 10: 0 for a right one."""
    back = F.reverse(digits)

    def one(total: Column, i: Column) -> Column:
        d = F.substring(back, i + 1, 1).cast("int")
        return total + F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), one) % 10


def mod97(iban: Column) -> Column:
    """Remainder of an IBAN: 1 for a right one."""
    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))

    def one(rest: Column, i: Column) -> Column:
        ch = F.substring(turned, i, 1)
        return F.when(ch.rlike("[0-9]"), rest * 10 + F.ascii(ch) - 48).otherwise(rest * 100 + F.ascii(ch) - 55) % 97
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), one)


def _pick(words: str, byte: Column) -> Column:
    listed = words.split()
    return F.element_at(F.array(*map(F.lit, listed)), (byte % len(listed) + 1).cast("int"))


def _letter(alphabet: str, byte: Column) -> Column:
    return F.substring(F.lit(alphabet), byte % len(alphabet) + 1, 1)


def surrogate(kind: Column, core: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a canonical form, in canonical form."""
    digest = F.sha2(F.concat_ws("\x00", F.lit(key), kind, core, attempt.cast("string")), 512)

    def byte(i) -> Column:
        at = (F.lit(i) if isinstance(i, int) else i) % 64
        return F.conv(F.substring(digest, at * 2 + 1, 2), 16, 10).cast("int")

    def shaped(head: Column, tail: Column) -> Column:
        """Letters and digits replaced by their like, but for ``head`` first and ``tail`` last characters."""
        def one(i: Column) -> Column:
            ch, b = F.substring(core, i + 1, 1), byte(i)
            kept = (i < head) | (i >= F.length(core) - tail)
            return (F.when(kept, ch).when(ch.rlike("[0-9]"), _letter("0123456789", b))
                    .when(ch.rlike("[a-z]"), _letter("abcdefghijklmnopqrstuvwxyz", b))
                    .when(ch.rlike("[A-Z]"), _letter("ABCDEFGHIJKLMNOPQRSTUVWXYZ", b)).otherwise(ch))
        return F.concat_ws("", F.transform(F.sequence(F.lit(0), F.length(core) - 1), one))

    none = F.lit(0)

    def many(alphabet: str, n: Column) -> Column:
        return F.when(n > 0, F.concat_ws("", F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: _letter(alphabet, byte(i + 40))))).otherwise(F.lit(""))

    longer = F.greatest(attempt - (GROW - 1), F.lit(0))         # characters more than the shape has
    more = many("0123456789", longer)
    hexes = F.concat_ws("", F.transform(F.sequence(F.lit(0), F.length(core) - 1), lambda i: _letter("0123456789abcdef", byte(i))))
    ip = F.concat_ws(".", *[(byte(i) % 254 + 1).cast("string") for i in range(4)])
    ip = F.when(longer > 0, F.concat(ip, F.lit(":1"), more)).otherwise(ip)
    mail = F.concat(many("abcdefghijklmnopqrstuvwxyz", longer), shaped(none, F.length(F.regexp_extract(core, r"\.([A-Za-z]+)$", 1))))
    digits = F.concat(shaped(F.lit(1), none), more)
    card = F.substring(digits, F.lit(1), F.length(digits) - 1)
    check = ((10 - luhn(F.concat(card, F.lit("0")))) % 10).cast("string")
    card = F.when(luhn(core) == 0, F.concat(card, check)).otherwise(digits)
    iban = F.concat(shaped(F.lit(2), none), more)
    blank = F.concat(F.substring(core, 1, 2), F.lit("00"), F.substring(iban, 5, 64))
    right = F.lpad((98 - mod97(blank)).cast("string"), 2, "0")
    iban = F.when(mod97(core) == 1, F.concat(F.substring(core, 1, 2), right, F.substring(iban, 5, 64))).otherwise(iban)
    phone = F.concat(_letter("23456789", byte(0)), F.substring(shaped(none, none), 2, 64), more)      # no trunk zero

    own = F.regexp_replace(core, "^[fmn]:", "")
    script = F.when(own.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).when(own.rlike(r"\p{IsGreek}"), F.lit("greek")).otherwise(F.lit("latin"))

    def syllables(n: Column) -> Column:
        return reduce(lambda other, k: F.when(script == k, F.concat_ws("", F.transform(
            F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: _pick(SYLLABLES[k], byte(i))))).otherwise(other), SYLLABLES, F.lit(""))

    # a family name of three syllables, a given name of the list; one syllable more in each round
    gender = F.substring(core, 1, 1)
    given = reduce(lambda other, k: F.when((script == k[0]) & (gender == k[1]), _pick(GIVEN[k], byte(0))).otherwise(other), GIVEN, F.lit(""))
    given = F.concat(gender, F.lit(":"), given, F.when(attempt > 0, syllables(attempt)).otherwise(F.lit("")))
    return (F.when(kind == "email", mail).when(kind == "key", F.concat(shaped(F.lit(4), none), more)).when(kind == "hex", F.concat(hexes, more))
            .when(kind == "iban", iban).when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", phone)
            .when(kind == "name", F.initcap(syllables(attempt + 3))).when(kind == "given", given)
            .otherwise(F.concat(shaped(none, none), more)))


def formatted(kind: Column, value: Column, core: Column, new: Column, given: Column) -> Column:
    """The surrogate ``new`` of ``core`` in the format of one occurrence; ``given``: that
    of a name's given name, or NULL."""
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    before = F.when(kind == "phone", digits - F.length(core)).otherwise(F.lit(0))       # country code, trunk zero
    mark = F.when(kind == "phone", F.lit("[^0-9]")).otherwise(F.lit("[ -]"))

    def one(i: Column) -> Column:
        ch = F.substring(value, i, 1)
        at = F.length(F.regexp_replace(F.substring(value, F.lit(1), i), mark, "")) - before
        return F.when(F.regexp_like(ch, mark) | (at < 1), ch).otherwise(F.substring(new, at, 1))

    def cased(i: Column) -> Column:
        ch, other = F.substring(new, -i, 1), F.substring(value, -i, 1)
        return F.when((i <= F.length(value)) & (other != F.lower(other)), F.upper(ch)).otherwise(ch)

    places = F.sequence(F.lit(1), F.length(value))
    refilled = F.concat(F.concat_ws("", F.transform(places, one)), F.substring(new, F.length(core) + 1, 64))
    mail = F.reverse(F.concat_ws("", F.transform(F.sequence(F.lit(1), F.length(new)), cased)))
    family = F.element_at(_body(value), -1)
    after = F.substring(family, F.length(F.regexp_replace(family, _AFTER, "")) + 1, 64)
    name = F.concat(F.concat_ws(" ", F.nullif(F.regexp_extract(value, f"^({TITLE}) ", 1), F.lit("")),
                                F.regexp_replace(given, "^[fmn]:", ""), new), after)
    return (F.when(kind.isin("iban", "ssn", "card", "phone"), refilled).when(kind == "email", mail)
            .when(kind == "name", name).otherwise(new))


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``entities``: distinct (kind, core). Adds ``core_surrogate``, distinct
    within the corpus and never an entity of it."""
    taken = entities.select(F.col("core").alias("s")).distinct()
    open_, done = entities.withColumn("attempt", F.lit(0)), None
    for _ in range(ROUNDS):
        wishes = open_.withColumn("s", surrogate(F.col("kind"), F.col("core"), F.col("attempt"), key))
        marked = (wishes.withColumn("wish", F.lit(1))
                  .unionByName(taken.select("s", F.lit(0).alias("wish")), allowMissingColumns=True))
        order = Window.partitionBy("s").orderBy("wish", "kind", "core")
        ranked = marked.withColumn("at", F.row_number().over(order)).filter("wish = 1")
        ranked = materialize(ranked, "pii-round", 4)        # what goes on is cut off from the rounds before
        won = ranked.filter("at = 1").select("kind", "core", F.col("s").alias("core_surrogate"))
        done = won if done is None else done.unionByName(won)
        taken = taken.unionByName(won.select(F.col("core_surrogate").alias("s")))
        open_ = ranked.filter("at > 1").select("kind", "core", (F.col("attempt") + 1).alias("attempt"))
        if open_.isEmpty():
            return done
    raise RuntimeError(f"surrogates still collide after {ROUNDS} rounds")


def _replaced(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``_new_text`` and ``_found`` (number of entities)."""
    found = F.regexp_extract_all("text", F.lit(f"({ANY})"), F.lit(1))
    core, kind = F.col("core"), F.col("kind")
    hits = materialize(
        docs.select("doc_id", "text").filter(reduce(Column.__or__, [F.col("text").rlike(p) for p in (
            "[@0-9]", *(PATTERNS[k] for k in ("name", "key", "hex")))]))        # these may be without a digit
        .select("doc_id", text_key(F.col("text")).alias("txt_key"), F.posexplode(found).alias("at", "value"))
        .withColumn("kind", kind_of(F.col("value")))
        .withColumn("core", canonical(kind, F.col("value")))
        .withColumn("kind", F.when((kind == "card") & (F.col("value") == core) & (F.length(core) != 16) & (luhn(core) != 0),
                                   F.lit("number")).otherwise(kind))
        .withColumn("given", F.when(kind == "name", _given(F.col("value")))), "pii-hits")
    entities = (hits.filter("kind <> 'number'").select("kind", "core")
                .unionByName(hits.filter("given IS NOT NULL").select(F.lit("given").alias("kind"), F.col("given").alias("core"))).distinct())
    known = materialize(assign(entities, key), "pii-known", 4)
    given = known.filter("kind = 'given'").select(F.col("core").alias("given"), F.col("core_surrogate").alias("given_surrogate"))
    new = formatted(kind, F.col("value"), core, F.col("core_surrogate"), F.col("given_surrogate"))
    lists = (hits.join(known, ["kind", "core"], "left").join(given, "given", "left")
             .withColumn("s", F.when(kind == "number", F.col("value")).otherwise(new))
             .groupBy("doc_id", "txt_key").agg(F.array_sort(F.collect_set(F.struct("at", "s", (kind != "number").alias("is")))).alias("_hits"))
             .select(F.col("doc_id").alias("_hit_id"), F.col("txt_key").alias("_hit_key"), F.col("_hits.s").alias("_hits"),
                     F.size(F.filter("_hits", lambda h: h["is"])).alias("_n_hits")))
    joined = docs.join(lists, docs["doc_id"].eqNullSafe(lists["_hit_id"]) & (text_key(docs["text"]) == lists["_hit_key"]), "left")
    between = F.split(docs["text"], ANY, -1)
    new = F.concat_ws("", F.flatten(F.zip_with(between, F.col("_hits"), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))))
    return (joined.withColumn("_new_text", F.when(F.col("_hits").isNull(), docs["text"]).otherwise(new))
            .withColumn("_found", F.coalesce("_n_hits", F.lit(0))).drop("_hit_id", "_hit_key", "_hits", "_n_hits"))


def apply(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with its texts replaced (and ``n_chars``, if there, counted anew)."""
    out = _replaced(docs, key)
    return out.select(*[
        F.col("_new_text").alias(c) if c == "text" else
        F.length("_new_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def report(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, text with surrogates, n_entities."""
    return _replaced(docs.select("doc_id", "text"), key).select(
        "doc_id", F.col("_new_text").alias("text"), F.col("_found").cast("long").alias("n_entities"))
