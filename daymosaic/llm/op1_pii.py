"""Surrogates for personal data: keyed, type-consistent, distinct and coreferent.

Found are e-mail, IPv4 and IPv6 addresses, telephone, card, bank account (IBAN) and social security numbers, long
hexadecimal secrets, access keys with a known prefix, and names after a title or a known given name. An entity is its
canonical form: numbers by their digits, addresses in lower case, names word by word. So the same entity
gets the same surrogate in every document and in every spelling of it, and ``Mr. John Smith``
and ``Mr. Smith`` keep their surname in common.

A surrogate comes from a keyed hash of kind and canonical form and keeps what the kind and the
format show: digits stay digits in the original's punctuation, a card keeps its first digit and whether its
check digit holds, an account its country and whether its check digits hold, a telephone number its country code, a
private IP address its private prefix, a key its prefix, an address becomes one at a reserved example domain
or in a block kept for documentation, a name stays in its script (Latin, Cyrillic, Greek) and its gender, given
by the title or the given name; initials stay.

Collision checks: a surrogate that equals any entity found, or another surrogate
of its kind, is drawn again with a higher attempt number; of several entities with one surrogate the
first by keyed hash keeps it. What has been drawn is therefore distinct over the whole corpus. A format may have
fewer surrogates than a corpus has entities. From attempt ``WIDER`` on, more is drawn anew: private addresses leave
their block for 10.0.0.0/8 and then all private ones for public blocks, and numbers grow by a digit an attempt. So what is
drawn from outgrows what is asked for, and drawing ends.

Everything is DataFrame functions. Texts are searched once, and written to the shared folder with what was
found in them and a row number; those with entities are joined to their surrogates by it.

Defined results: null and empty texts stay; texts without entities stay as they are, byte by byte; repeated rows stay
repeated; other columns stay, but one named ``n_entities`` or ``kinds`` is replaced; an empty table gives an empty
result. Names of other scripts and names without title or known given name are not found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymosaic.llm.tables import hidden, let, save, table

KEY = "replace this key"
#: attempts after which a format is given up
WIDER, PUBLIC = 4, 10

TITLES = {
    "m": "Mr Herr Monsieur Señor Sr господин κύριος".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Señora Sra госпожа κυρία".split(),
    "x": "Dr Prof".split(),
}
GIVEN_NAMES = {
    "m": "James John Robert Michael William David Thomas Hans Peter Jürgen Pierre Jean Luc José Juan Carlos Иван Пётр Сергей Γιώργος".split(),
    "f": "Mary Patricia Jennifer Linda Elizabeth Susan Sarah Anna Petra Ursula Marie Sophie Camille María Carmen Lucía Ольга Анна Мария Ελένη".split(),
}

_WORD = r"\p{Lu}[\p{L}'’-]+"
_SCRIPT_WORD = r"(?:(?=[\p{IsLatin}\p{IsCyrillic}\p{IsGreek}])" + _WORD + ")"
_INITIAL = r"\p{Lu}\."
_TITLE_WORDS = [w for ts in TITLES.values() for t in ts for w in dict.fromkeys((t, t.upper()))]
_TITLE = "(?:" + "|".join(_TITLE_WORDS) + ")"
_GIVEN = "(?:" + "|".join(n for ns in GIVEN_NAMES.values() for n in ns) + ")"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

#: kind to pattern; earlier kinds win
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "token": r"(?<![0-9A-Za-z_])(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|[sr]k_(?:live|test)_[0-9A-Za-z]{16,}"
             r"|xox[abprs]-[0-9A-Za-z-]{10,})(?![0-9A-Za-z_])",
    "secret": r"(?<![0-9A-Za-z])(?=[a-fA-F]*\d)(?=\d*[a-fA-F])[0-9a-fA-F]{32,}(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "phone": r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d(?:[ .-]?\d){5,11}(?!\d)"
             r"|(?<![\d.+-])(?:\(\d{3}\) ?\d{3}[-. ]|\d{3}-\d{3}-|\d{3}\.\d{3}\.)\d{4}(?![\d-])",
    "ipv6": r"(?<![0-9A-Za-z:.])(?=[0-9a-fA-F:]*\d)(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}"
            r"|(?:[0-9a-fA-F]{1,4}:){1,6}(?::[0-9a-fA-F]{1,4}){1,6})(?![0-9A-Za-z:])",
    "ipv4": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "card": r"(?<!\d)(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)",
    "name": rf"(?<!\p{{L}})(?:{_TITLE}\.? (?:{_INITIAL} ){{0,2}}{_SCRIPT_WORD}(?: (?:{_INITIAL}|{_SCRIPT_WORD})){{0,2}}"
            rf"|{_GIVEN}(?: {_INITIAL}){{0,2}}(?: {_SCRIPT_WORD}){{1,2}})",
}
COMBINED = "(?:" + "|".join(PATTERNS.values()) + ")"
#: every entity has one of these; cheaper to look for
CHEAP = rf"[0-9@]|{_TITLE}\.? \p{{Lu}}|{_GIVEN} \p{{Lu}}|[a-fA-F]{{32}}"

_TITLES_ANY_CASE = {g: [w for t in ts for w in dict.fromkeys((t, t.upper()))] for g, ts in TITLES.items()}
_SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ga ge ha he ka ke la le li lo ma me mi mo na ne ra re sa se ta te".split(),
    "cyrillic": "ба бе би бо да де ди до фа фе га ге ха хе ка ке ла ле ли ло ма ме ми мо на не ра ре са се та те".split(),
    "greek": "βα βε βι βο δα δε δι δο φα φε γα γε χα χε κα κε λα λε λι λο μα με μι μο να νε ρα ρε σα σε τα τε".split(),
}
_ENDINGS = {
    "latin": {"f": "na", "m": "n", "x": "ri", "surname": "ler"},
    "cyrillic": {"f": "на", "m": "н", "x": "ри", "surname": "лер"},
    "greek": {"f": "να", "m": "ν", "x": "ρι", "surname": "λερ"},
}


def kind_of(value: Column) -> Column:
    kind = F.lit("name")
    for name, pattern in reversed(list(PATTERNS.items())):
        kind = F.when(value.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    return kind


def _one_of(value: Column, words: list[str]) -> Column:
    return value.isin(words)


def _gender(word: Column, by: dict[str, list[str]]) -> Column:
    out = F.lit("x")
    for gender, words in by.items():
        out = F.when(_one_of(word, words), F.lit(gender)).otherwise(out)
    return out


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")


def _part(kind: Column, canon: Column, shown: Column) -> Column:
    return F.struct(kind.alias("kind"), canon.alias("canon"), shown.alias("shown"))


def parts_of(kind: Column, value: Column) -> Column:
    """The parts of an entity: what has a surrogate of its own, and ``text`` for what stays."""
    digits = F.regexp_replace(value, r"\D", "")
    canon = F.when(kind.isin("phone", "card", "ssn"), digits).when(kind.isin("email", "secret", "ipv6"), F.lower(value)).when(
        kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).otherwise(value)

    def named(word, what):
        return _part(F.concat(F.lit("name:"), what, F.lit(":"), _script(word)), word, word)

    def part(word, i, words, titled, gender):
        """A word of a name: the title and initials stay, the last one is the surname, those before it are given names."""
        stays = (titled & (i == 0)) | word.rlike(r"\.$")
        return F.when(stays, _part(F.lit("text"), F.lit(""), word)).when(i == F.size(words) - 1, named(word, F.lit("surname"))).otherwise(
            named(word, F.when(_gender(word, GIVEN_NAMES) != "x", _gender(word, GIVEN_NAMES)).otherwise(gender)))

    def name_parts(words):
        title = F.regexp_replace(words[0], r"\.$", "")
        return let(F.struct(words.alias("w"), _one_of(title, _TITLE_WORDS).alias("titled"), _gender(title, _TITLES_ANY_CASE).alias("gender")), lambda x: F.flatten(
            F.transform(x["w"], lambda word, i: F.array(
                _part(F.lit("text"), F.lit(""), F.when(i > 0, F.lit(" ")).otherwise(F.lit(""))), part(word, i, x["w"], x["titled"], x["gender"])))))

    return F.when(kind == "name", name_parts(F.split(value, " "))).otherwise(F.array(_part(kind, canon, value)))


def _number(stream: Column, i, below: int) -> Column:
    """A number from two digits of the hexadecimal ``stream``."""
    at = (i * F.lit(2)) % F.lit(126) + F.lit(1)
    return F.conv(F.substr(stream, at.cast("int"), F.lit(2)), 16, 10).cast("int") % below


def _shaped(value: Column, stream: Column) -> Column:
    """``value`` with its digits and ASCII letters drawn anew."""
    def drawn(c, i):
        return F.when(c.rlike("[0-9]"), _number(stream, i, 10).cast("string")).when(
            c.rlike("[a-z]"), F.char(_number(stream, i, 26) + 97)).when(
            c.rlike("[A-Z]"), F.char(_number(stream, i, 26) + 65)).otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), drawn), "")


def _luhn(digits: Column, doubled: int) -> Column:
    """Sum of ``digits`` from the right, every second one doubled, beginning with place ``doubled``."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: let(
        c.cast("int") * F.when(i % 2 == doubled, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def _mod97(account: Column) -> Column:
    """Rest by 97 of an account number whose letters count 10 to 35, its first four characters taken last."""
    turned = F.concat(F.substr(account, F.lit(5), F.length(account)), F.substr(account, F.lit(1), F.lit(4)))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda r, c: F.when(c.rlike("[0-9]"), (r * 10 + c.try_cast("int")) % 97).otherwise(
        (r * 100 + F.ascii(c) - 55) % 97))


def drawn(kind: Column, canon: Column, attempt: int, key: str) -> Column:
    """Canonical form of the surrogate."""
    message = F.concat_ws("|", kind, F.lit(str(attempt)), canon)
    stream = F.sha2(F.concat(F.lit(key), F.sha2(F.concat(F.lit(key), message), 256)), 512)
    n = F.length(canon)
    digits = _shaped(canon, stream)
    country = F.when(canon.rlike("^[17]"), 1).otherwise(2)
    phone = F.concat(F.substr(canon, F.lit(1), country), F.substr(digits, country + 1, n))
    body = F.concat(F.substr(canon, F.lit(1), F.lit(1)), F.substr(digits, F.lit(2), n - 2))
    check = ((F.lit(10) - _luhn(body, 0) % 10) % 10).cast("string")
    wrong = ((F.lit(11) - _luhn(body, 0) % 10) % 10).cast("string")
    card = F.concat(body, F.when(_luhn(canon, 1) % 10 == 0, check).otherwise(wrong))
    ssn = F.concat((_number(stream, F.lit(60), 8) + 1).cast("string"), F.substr(digits, F.lit(2), n))
    octets = [(_number(stream, F.lit(i), 254) + 1).cast("string") for i in range(4)]
    public = F.lit(11) + _number(stream, F.lit(40), 112)  # 11 to 122: no private, loopback or reserved block
    given_octets = F.split(canon, r"\.")
    more_digits = F.lit("") if attempt < WIDER else F.substr(F.conv(F.substr(stream, F.lit(90), F.lit(12)), 16, 10), F.lit(1), F.lit(attempt - WIDER + 1))
    private = F.lit(False) if attempt >= PUBLIC else canon.rlike(r"^(?:10\.|127\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.)")
    two = canon.rlike(r"^(?:192|172)\.")
    if attempt < WIDER:
        ipv4 = F.concat_ws(".", F.when(private, given_octets[0]).otherwise(public.cast("string")),
                           F.when(private & two, given_octets[1]).otherwise(octets[1]), octets[2], octets[3])
    else:
        ipv4 = F.concat_ws(".", F.when(private, F.lit("10")).otherwise(public.cast("string")), *octets[1:])
    ipv6 = F.concat(F.lit("2001:db8"), *[F.concat(F.lit(":"), F.substr(stream, F.lit(1 + 4 * i), F.lit(4))) for i in range(6)])
    prefix = F.regexp_extract(canon, r"^(?:A[KS]IA|gh[pousr]_|[sr]k_(?:live|test)_|xox[abprs]-)", 0)
    token = F.concat(prefix, F.substr(_shaped(canon, stream), F.length(prefix) + 1, n), more_digits)
    country_code = F.substr(canon, F.lit(1), F.lit(2))
    account = F.substr(F.concat(_shaped(canon, stream), more_digits), F.lit(5), F.lit(40))
    check_digits = F.lpad((F.lit(98) - _mod97(F.concat(country_code, F.lit("00"), account))).cast("string"), 2, "0")
    # a number that does not check gets digits that do not either
    iban = F.concat(country_code, F.when(_mod97(canon) == 1, check_digits).otherwise(F.lit("00")), account)
    local = F.substring_index(canon, "@", 1)
    hosts = F.array(*[F.lit(f"example.{d}") for d in ("com", "net", "org")])
    more = F.lit("") if not attempt else F.concat(F.lit("."), F.substr(F.conv(F.substr(stream, F.lit(100), F.lit(8)), 16, 10), F.lit(1), F.lit(3 + attempt)))
    email = F.concat(_shaped(local, stream), more, F.lit("@"), F.get(hosts, _number(stream, F.lit(61), 3)))
    secret = F.concat(F.substr(F.repeat(stream, F.ceil(n / 128).cast("int")), F.lit(1), n), more_digits)
    out = F.when(kind == "phone", F.concat(phone, more_digits)).when(kind == "card", F.concat(card, more_digits)).when(
        kind == "ssn", F.concat(ssn, more_digits)).when(kind == "ipv4", ipv4).when(kind == "email", email).when(
        kind == "secret", secret).when(kind == "ipv6", ipv6).when(kind == "token", token).when(kind == "iban", iban)
    for script, syllables in _SYLLABLES.items():
        listed = F.array(*[F.lit(s) for s in syllables])
        stem = F.concat(*[F.get(listed, _number(stream, F.lit(k), len(syllables))) for k in range(3 + attempt)])
        for what, ending in _ENDINGS[script].items():
            out = out.when(kind == f"name:{what}:{script}", F.initcap(F.concat(stem, F.lit(ending))))
    return out


def shown(part: Column, surrogate: Column) -> Column:
    """``surrogate`` in the format the entity was written in."""
    written = part["shown"]
    # the surrogate's characters in the place of the written ones, punctuation as written; what it has more comes last
    numbers = F.aggregate(
        F.split(written, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")),
        lambda s, c: F.when(c.rlike("[0-9A-Z]"), F.struct(
            F.concat(s["out"], F.substr(surrogate, s["k"], F.lit(1))).alias("out"), (s["k"] + 1).alias("k"))
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["k"].alias("k"))),
        lambda s: F.concat(s["out"], F.substr(surrogate, s["k"], F.lit(40))))
    capitals = (written == F.upper(written)) & (written != F.lower(written))
    return F.when(part["kind"] == "text", written).when(part["kind"].isin("phone", "card", "ssn", "iban"), numbers).when(
        (part["kind"].isin("email", "secret", "ipv6") | part["kind"].startswith("name:")) & capitals & (F.length(written) > 1), F.upper(surrogate)).otherwise(surrogate)


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, canon, surrogate) for distinct (kind, canon), all surrogates of a kind distinct and none an entity."""
    pending, seen = save(entities, "entities")
    originals = pending.select(F.col("kind").alias("k"), F.col("canon").alias("s"))
    done, attempt = None, 0
    while seen["rows"]:
        offered = pending.withColumn("surrogate", drawn(F.col("kind"), F.col("canon"), attempt, key))
        taken = originals if done is None else originals.unionByName(
            done.select(F.col("kind").alias("k"), F.col("surrogate").alias("s")))
        # hot surrogates are reduced before they move
        first = offered.groupBy("kind", "surrogate").agg(
            F.min_by("canon", F.sha2(F.concat(F.lit(key), "canon"), 256)).alias("canon"))
        free, _ = save(first.join(taken, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("s")), "left_anti"), "drawn")
        done = free if done is None else done.unionByName(free)
        pending, seen = save(pending.join(free.select("kind", "canon"), ["kind", "canon"], "left_anti"), "pending")
        attempt += 1
    return pending.withColumn("surrogate", F.lit("")) if done is None else done.select("kind", "canon", "surrogate")


def masked(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with ``text`` masked, and ``n_entities`` and ``kinds`` (distinct, sorted).

    Columns of ``docs`` with these two names are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_entities", "kinds")]
    plain, back = hidden(docs.select(*[F.col(f"`{c}`") for c in names]))
    t, none = F.col(back[text]), F.array().cast("array<string>")
    found = F.when(t.rlike(CHEAP), F.regexp_extract_all(t, F.lit(COMBINED), F.lit(0)))
    searched, seen = save(plain.withColumns({"__row": F.monotonically_increasing_id(), "__found": F.coalesce(found, none)}), "pii-texts",
                          entities=F.sum(F.size("__found")))
    restored = [F.col(back[c]).alias(c) for c in names]
    clean = searched.where(F.size("__found") == 0).select(*restored, F.lit(0).cast("bigint").alias("n_entities"), none.alias("kinds"))
    if not seen["entities"]:
        return clean
    held = searched.where(F.size("__found") > 0)
    each = held.select("__row", F.posexplode("__found").alias("at", "value"))
    values, _ = save(each.groupBy("value").agg(F.lit(1).alias("one")).select(
        "value", kind_of(F.col("value")).alias("kind")).withColumn("parts", parts_of(F.col("kind"), F.col("value"))), "pii-values")
    parts = values.select("value", "kind", F.posexplode("parts").alias("place", "part"))
    table_ = surrogates(parts.select("part.kind", "part.canon").where(F.col("kind") != "text").distinct(), key)
    known = table_.select(F.col("kind").alias("s_kind"), "canon", "surrogate")
    rendered = parts.join(known, (F.col("part.kind") == F.col("s_kind")) & (F.col("part.canon") == known["canon"]), "left").select(
        "value", "kind", "place", shown(F.col("part"), F.col("surrogate")).alias("shown"))
    # an entity has a few parts at most
    whole, _ = save(rendered.groupBy("value", "kind").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("place", "shown"))), lambda x: x["shown"]), "").alias("shown")), "pii-surrogates")
    placed = each.join(whole, "value").groupBy("__row").agg(
        F.sort_array(F.collect_list(F.struct("at", "shown"))).alias("__new"),
        F.sort_array(F.collect_set("kind")).alias("kinds"))
    between = F.split(t, COMBINED, -1)
    rebuilt = let(F.struct(between.alias("p"), F.col("__new.shown").alias("s")), lambda x: F.array_join(
        F.zip_with(x["p"], x["s"], lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""))
    done = held.join(placed.withColumnRenamed("__row", "__r"), F.col("__row") == F.col("__r")).withColumn(
        "n_entities", F.size("__found").cast("bigint")).withColumn(back[text], rebuilt)
    return clean.unionByName(done.select(*restored, "n_entities", "kinds"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "text", "n_entities", F.array_join("kinds", ",").alias("kinds"))
