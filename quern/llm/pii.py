"""PII replaced by keyed surrogates (operator 6), in DataFrame functions only.

Detected: e-mail addresses, phone numbers, card and social-security numbers, IPv4
addresses, IBANs, secrets (keys and tokens), and persons by title or given name.

A surrogate is made from a keyed SHA-256 of the entity's canonical form (digits only,
lower case, ...), so an entity gets the same surrogate wherever and however it is
written. It keeps the type and format: separators, length, issuer digit and check digit
of cards, country codes, private networks. A person's title stays; given names are
permuted among names of one gender and script; other names become pronounceable names
of the same script (Latin, Cyrillic, Greek), so "Mr Smith" and "John Smith" stay one.

Collision check: all distinct entities are gathered, and one whose surrogate another
entity has too, or that is itself an entity of the data, gets the next attempt until none
is left. Where the data fill a small range (a private block of addresses), later attempts
take a wider one, and after ``AVOID_REAL`` rounds only distinctness is asked for. Only these few carry an attempt number, which is joined to their documents.

Defined results: a null text stays null, a text without entities stays as it is. Rows
without doc_id and repeated rows are treated alike. Other columns pass unchanged.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import prepare, small_side, staged, table, unused

KEY = "quern"                              # give a secret one in production
MAX_BROADCAST_ROWS = 50_000
# Attempts with an address's own private block, then with the widest one; attempts that also
# avoid the data's own entities; attempts at all.
OWN_BLOCK, PRIVATE, AVOID_REAL, MOST_ATTEMPTS = 8, 24, 32, 1000

# Titles and given names by gender and script.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Mlle",
          "Señor", "Señora", "Sr", "Sra", "Господин", "Госпожа", "Κύριος", "Κυρία")
GIVEN = (
    ("John", "James", "Robert", "Michael", "William", "David", "Thomas", "Richard", "Charles", "Hans", "Jürgen",
     "Klaus", "Wolfgang", "Pierre", "François", "Michel", "Carlos", "Miguel"),
    ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Ursula",
     "Monika", "Ingrid", "Nathalie", "Isabelle", "Sylvie", "Carmen", "Lucía", "Pilar"),
    ("Иван", "Сергей", "Дмитрий", "Алексей", "Николай", "Михаил"),
    ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна"),
    ("Γιώργος", "Νίκος", "Δημήτρης", "Κώστας"),
    ("Μαρία", "Ελένη", "Σοφία", "Κατερίνα"),
)
SCRIPTS = {"latin": ("bdfghklmnprstvwz", "aeiouyaeiouyaeio"),
           "cyrillic": ("бвгдзклмнпрстфхш", "аеиоуяаеиоуяаеио"),
           "greek": ("βγδζθκλμνπρστφχψ", "αεηιουαεηιουαεηι")}
HEX = "0123456789abcdef"

# Patterns. Each begins where no letter or digit stands before.
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# A name after one white space: initials and particles before a capitalised word, or an initial alone.
GAP = r"(?:\r\n|[\s\u00a0])"
INITIAL = r"(?:\p{Lu}\.)++"
BEFORE = rf"(?:{INITIAL}{GAP}?){{0,3}}(?:(?:van|von|der|den|de|del|della|di|da|dos|du|la|le|zu|zur|ten|ter|bin|ibn|al|el){GAP}){{0,3}}"
NAME = rf"{GAP}(?:{BEFORE}\p{{Lu}}[\p{{L}}\p{{M}}'’\-]++|{INITIAL})"
CAPITALS = rf"{GAP}(?:{BEFORE}\p{{Lu}}[\p{{Lu}}'’\-]++(?!\p{{Ll}})|{INITIAL})"
UNCASED = rf"{GAP}\p{{Lo}}[\p{{Lo}}\p{{M}}]*+"
EMAIL = r"[\p{L}\p{N}][\p{L}\p{N}._%+\-]*+@[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"
IP = rf"(?<!\d\.)(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)"
SSN = r"\d{3}-\d{2}-\d{4}(?!\d)"
PHONE = (r"\+\d{1,3}[ .\-]?\(\d{3}\)[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)|\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\d)"
         r"|\d{3}[ .\-]\d{3}[ .\-]\d{4}(?!\d)|\+\d{1,3}(?:[ .\-]\d{2,4}){2,5}(?!\d)|\+\d{9,14}(?!\d)")
CARD = r"\d{4}(?<sep>[ \-]?)\d{4}\k<sep>\d{4}\k<sep>\d{4}(?!\d)|\d{4}[ \-]\d{6}[ \-]\d{5}(?!\d)|\d{13,19}(?!\d)"
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?\d{1,3})?(?![A-Za-z0-9])"
VALUE = r"[A-Za-z0-9+/_\-]{12,}"
SECRET = (r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
          rf"|(?i:token|secret|password|passwd|api[_\-]?key|access[_\-]?key|key)\s{{0,3}}[=:]\s{{0,3}}\"?{VALUE}\"?")
PERSON = (rf"(?:{'|'.join(TITLES)})\.?(?:{NAME}|{UNCASED}){{1,3}}|(?:{'|'.join(n for g in GIVEN for n in g)})(?:{NAME}){{1,2}}"
          rf"|(?:{'|'.join(t.upper() for t in TITLES)})\.?(?:{CAPITALS}){{1,3}}"
          rf"|(?:{'|'.join(n.upper() for g in GIVEN for n in g)})(?:{CAPITALS}){{1,2}}")
ENTITY = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join((IP, SSN, PHONE, CARD, IBAN, SECRET, EMAIL, PERSON))})"
TOKEN = r"[\p{L}\p{M}'’\-]+|[^\p{L}\p{M}'’\-]+"


def entities(text: Column) -> Column:
    """All entities of a text in order."""
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def kind(m: Column) -> Column:
    return (F.when(m.contains("@"), "email")
            .when(m.rlike(rf"^(?:{SECRET})$"), "secret")
            .when(m.rlike(rf"^{IP}$"), "ip")
            .when(m.rlike(rf"^{SSN}$"), "ssn")
            .when(m.rlike(rf"^(?:{PHONE})$"), "phone")
            .when(m.rlike(r"^\d"), "card")
            .when(m.rlike(r"^[A-Z]{2}\d{2}"), "iban")
            .otherwise("person"))


def digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def canonical(k: Column, m: Column) -> Column:
    """One form for all ways to write an entity; persons are taken name by name."""
    return (F.when(k == "email", F.lower(m))
            .when(k == "secret", F.regexp_extract(m, rf'({VALUE})"?$', 1))
            .when(k == "phone", F.regexp_extract(digits(m), r"(\d{1,10})$", 1))
            .when(k.isin("ssn", "card"), digits(m))
            .when(k == "iban", F.regexp_replace(m, " ", ""))
            .otherwise(m))


def script(name: Column) -> Column:
    return F.when(name.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")


def given_names(key: str) -> dict[str, str]:
    """A keyed permutation of the given names within gender and script; none stays itself."""
    out = {}
    for names in GIVEN:
        order = sorted(names, key=lambda n: hashlib.sha256(f"{key}|{n}".encode()).digest())
        out.update(zip(order, order[1:] + order[:1]))
    return out


def is_name(token: Column) -> Column:
    """A person's token that becomes a made name: neither title nor given name."""
    known = [*TITLES, *(n for g in GIVEN for n in g)]
    return token.rlike(r"^[\p{Lu}\p{Lo}]") & ~token.isin(*known, *(n.upper() for n in known))


def parts(key: str, found: Column) -> Column:
    """Per entity its parts ``(m, k, c)``: surface, type and canonical form.

    An entity is one part, but for persons: there every name is one, and given names
    (already replaced), titles and blanks are parts of type ``text``.
    """
    given = F.create_map(*[F.lit(x) for n, m in given_names(key).items() for x in (n, m, n.upper(), m.upper())])

    def token(t: Column) -> Column:
        made = is_name(t)
        return F.struct(t.alias("m"), F.when(made, script(t)).otherwise("text").alias("k"),
                        F.when(made, F.lower(t)).otherwise(F.coalesce(given[t], t)).alias("c"))

    def one(e: Column) -> Column:
        return F.when(e["k"] == "person", F.transform(F.regexp_extract_all(e["m"], F.lit(TOKEN), F.lit(0)), token)) \
            .otherwise(F.array(F.struct(e["m"].alias("m"), e["k"].alias("k"), canonical(e["k"], e["m"]).alias("c"))))

    return F.transform(F.transform(found, lambda m: F.struct(m.alias("m"), kind(m).alias("k"))), one)


def units(found: Column) -> Column:
    """The ``(type, canon)`` of a text's parts that have a surrogate of their own."""
    return F.transform(F.filter(F.flatten(found), lambda e: e["k"] != "text"),
                       lambda e: F.struct(e["k"].alias("type"), e["c"].alias("canon")))


def luhn_sum(x: Column) -> Column:
    each = F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.struct(
        (i % 2 == 0).alias("twice"), F.substr(x, F.length(x) - i + 1, F.lit(1)).cast("int").alias("d")))
    return F.aggregate(each, F.lit(0), lambda a, s: a + F.when(~s["twice"], s["d"])
                       .when(s["d"] > 4, s["d"] * 2 - 9).otherwise(s["d"] * 2))


def keyed(key: str, k: Column, canon: Column, attempt: Column) -> Column:
    """The 64 hex digits that a surrogate is made of."""
    return F.sha2(F.concat_ws("|", F.lit(key), k, canon, attempt.cast("string")), 256)


def surrogate(key: str, k: Column, canon: Column, h: Column, attempt: Column) -> Column:
    """Replacement of a canonical form, in canonical form; ``h`` is its keyed hash.

    Later attempts take private addresses from wider blocks, as data may fill a small one.
    """
    d = F.translate(h, "abcdef", "012345")                  # 64 decimal digits
    n = F.length(canon)
    letters = "ghijklmnop"
    domain = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), F.regexp_extract(canon, "@(.*)$", 1)), 256)
    email = F.concat(F.translate(F.substring(h, 1, 10), "0123456789", letters), F.lit("."), F.substring(d, 11, 2),
                     F.lit("@"), F.translate(F.substring(domain, 1, 8), "0123456789", letters), F.lit(".example"))
    octets = [(F.conv(F.substring(h, 1 + 2 * i, 2), 16, 10).cast("int") % 254 + 1).cast("string") for i in range(4)]
    private = F.regexp_extract(canon, r"^(10\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.)", 1)
    private = F.when((private == "") | (attempt < OWN_BLOCK), private).when(attempt < PRIVATE, "10.").otherwise("")
    kept = F.length(F.regexp_replace(private, r"[^.]", ""))
    ip = F.concat(private, F.array_join(F.slice(F.array(*octets), F.lit(1), 4 - kept), "."))
    phone = F.concat(F.translate(F.substring(d, 1, 1), "01", "23"), F.substring(d, 2, 2),
                     F.translate(F.substring(d, 4, 1), "01", "23"), F.substring(d, 5, 6))
    body = F.concat(F.substring(canon, 1, 1), F.substr(d, F.lit(2), n - 2))
    check = ((10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    card = F.concat(body, F.when(luhn_sum(canon) % 10 == 0, check).otherwise(F.substring(d, 60, 1)))
    iban = F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.when(i <= 2, F.substr(canon, i, F.lit(1)))
                        .when(F.substr(canon, i, F.lit(1)).rlike(r"\d"), F.substr(d, i, F.lit(1)))
                        .otherwise(F.translate(F.substr(h, i, F.lit(1)), HEX, "ABCDEFGHIJKLMNOP"))), "")
    long = F.concat(h, F.sha2(h, 256))
    hexed = F.substr(F.repeat(long, F.ceil(n / 128).cast("int")), F.lit(1), n)
    secret = F.when(canon.rlike("^AKIA"), F.concat(F.lit("AKIA"), F.upper(F.translate(F.substring(h, 1, 16), "0123456789", letters)))) \
        .when(canon.rlike("[g-zG-Z]"), F.translate(hexed, "0123456789", letters)).otherwise(hexed)

    def made(name: str) -> Column:
        c, v = (F.translate(F.substring(h, at, 4), HEX, s) for at, s in zip((1, 9), SCRIPTS[name]))
        parts = [F.concat(F.substring(c, i, 1), F.substring(v, i, 1)) for i in range(1, 5)]
        return F.concat(*parts)

    russian = F.concat(made("cyrillic"), F.when(canon.rlike("[ая]$"), "ва").otherwise("в"))
    return (F.when(k == "email", email).when(k == "secret", secret).when(k == "ip", ip)
            .when(k == "ssn", F.substring(d, 1, 9)).when(k == "phone", F.substr(phone, F.lit(1), n)).when(k == "card", card)
            .when(k == "iban", iban).when(k == "cyrillic", russian).when(k == "greek", made("greek"))
            .otherwise(made("latin")))


def laid(surface: Column, chars: Column, one: str) -> Column:
    """``chars`` in the places of the last characters of ``surface`` that match ``one``."""
    pieces = F.regexp_extract_all(surface, F.lit(rf"(?:(?!{one}).)*{one}"), F.lit(0))
    first = F.size(pieces) - F.length(chars)
    put = F.transform(pieces, lambda p, i: F.when(i < first, p).otherwise(
        F.concat(F.regexp_replace(p, rf"{one}$", ""), F.substr(chars, i - first + 1, F.lit(1)))))
    return F.concat(F.array_join(put, ""), F.regexp_extract(surface, rf"((?:(?!{one}).)*)$", 1))


def replaced(key: str, found: Column, attempts: Column) -> Column:
    """Per entity the text that takes its place. Each step adds one value to the parts."""
    def each(step):
        return lambda of: F.transform(of, lambda ps: F.transform(ps, step))

    numbered = each(lambda e: F.struct(
        e["m"].alias("m"), e["k"].alias("k"), e["c"].alias("c"),
        F.coalesce(attempts[F.concat_ws("|", e["k"], e["c"])], F.lit(0)).alias("a")))
    hashed = each(lambda e: F.struct(e["m"].alias("m"), e["k"].alias("k"), e["c"].alias("c"), e["a"].alias("a"),
                                     keyed(key, e["k"], e["c"], e["a"]).alias("h")))
    made = each(lambda e: F.struct(
        e["m"].alias("m"), e["k"].alias("k"),
        F.when(e["k"] == "text", e["c"]).otherwise(surrogate(key, e["k"], e["c"], e["h"], e["a"])).alias("s")))

    def put(e: Column) -> Column:
        m, k, s = e["m"], e["k"], e["s"]
        return (F.when(k.isin(*SCRIPTS), F.when(m.rlike(r"^\p{Lu}$"), F.upper(F.substring(s, 1, 1)))
                        .when(m.rlike(r"\p{Lu}") & (F.upper(m) == m), F.upper(s)).otherwise(F.initcap(s)))
                .when(k.isin("ssn", "phone", "card"), laid(m, s, r"\d"))
                .when(k == "iban", laid(m, s, r"\S"))
                .when(k == "secret", F.concat(F.regexp_extract(m, rf'(?s)^(.*?){VALUE}"?$', 1), s, F.regexp_extract(m, r'("?)$', 1)))
                .otherwise(s))

    return F.transform(made(hashed(numbered(found))), lambda ps: F.array_join(F.transform(ps, put), ""))


def collisions(found: DataFrame, key: str) -> DataFrame:
    """``(type, canon, attempt)`` of the entities that need a later attempt than the first."""
    rows = staged(found.withColumn("attempt", F.lit(0)), "entities")
    for attempt in range(MOST_ATTEMPTS):
        made = rows.withColumn("h", keyed(key, F.col("type"), F.col("canon"), F.col("attempt"))) \
            .withColumn("made", surrogate(key, F.col("type"), F.col("canon"), F.col("h"),
                                           F.col("attempt"))).drop("h")
        shared = made.groupBy("type", "made").agg(F.count("*").alias("n"), F.min("canon").alias("first")).where("n > 1")
        clash = made.join(shared, ["type", "made"]).where("canon <> first").select("type", "canon")
        if attempt < AVOID_REAL:
            real = made.join(found.select("type", F.col("canon").alias("made")), ["type", "made"], "left_semi")
            clash = clash.unionByName(real.select("type", "canon"))
        again = staged(clash.distinct(), "collisions")
        if again.isEmpty():
            return rows.where("attempt > 0")
        rows = staged(rows.join(again.withColumn("hit", F.lit(1)), ["type", "canon"], "left")
                      .select("type", "canon", (F.col("attempt") + F.coalesce("hit", F.lit(0))).alias("attempt")), "entities")
    raise ValueError(f"no distinct surrogates after {MOST_ATTEMPTS} attempts: the data fill a type's whole range")


def replace_pii(docs: DataFrame, key: str = KEY, count_col: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text`` (and ``n_chars`` after it, where there is one)."""
    prepare(docs.sparkSession)
    each = docs.select("doc_id", F.xxhash64("text").alias("_th"), entities(F.col("text")).alias("m")) \
        .select("doc_id", "_th", units(parts(key, F.col("m"))).alias("u"))
    found = staged(each.select(F.explode("u").alias("u")).select("u.*").distinct(), "vault")
    later = staged(collisions(found, key), "attempts")
    n = later.count()
    th, own, own_th, m, later_of = (unused(docs, c) for c in ("_th", "_id", "_h", "_m", "_attempts"))
    rows = docs.withColumn(th, F.xxhash64("text"))
    if n:
        held = each.select("doc_id", "_th", F.explode("u").alias("u")) \
            .select("doc_id", "_th", "u.*").distinct() \
            .join(small_side(later, n, MAX_BROADCAST_ROWS), ["type", "canon"]) \
            .groupBy("doc_id", "_th").agg(F.map_from_entries(F.collect_list(
                F.struct(F.concat_ws("|", "type", "canon"), "attempt"))).alias(later_of)) \
            .select(F.col("doc_id").alias(own), F.col("_th").alias(own_th), later_of)
        held = staged(held, "held")
        held = small_side(held, held.count(), MAX_BROADCAST_ROWS // 10)
        rows = rows.join(held, rows["doc_id"].eqNullSafe(held[own]) & (rows[th] == held[own_th]), "left").drop(own, own_th)
    else:
        rows = rows.withColumn(later_of, F.lit(None).cast("map<string,int>"))
    rows = rows.withColumn(m, entities(F.col("text")))
    put = replaced(key, parts(key, F.col(m)), F.col(later_of))
    gaps = F.split("text", ENTITY, -1)
    text = F.when(F.size(m) > 0, F.array_join(F.zip_with(gaps, put, lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")) \
        .otherwise(F.col("text"))
    changed = {"text": text}
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.size(m) > 0, changed["n_chars"]).otherwise(F.col("n_chars")))
    extra = [F.greatest(F.size(m), F.lit(0)).alias(count_col)] if count_col else []
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], *extra)


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced, and the number of entities."""
    prepare(spark)
    return replace_pii(table(spark, sf_dir, "documents"), count_col="entities")
