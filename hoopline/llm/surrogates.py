"""Surrogates for personal data: each detected entity is replaced by an invented one of the same kind and format.

Only DataFrame functions are used. Found are e-mail addresses, IPv4 addresses, phone numbers with a country code, social
security numbers, payment cards (with a valid check digit), secrets behind a keyword, and persons behind a form of address.

1. Matches of all texts are brought to entities: lower case for addresses, digits alone for numbers, given name and
   surname for persons. Each distinct entity gets one surrogate, so all mentions in all documents stay mentions of one
   thing, however they are written.
2. A surrogate is made from SHA-256 of a key, the kind and the entity, so it can be made again but not undone without the
   key. Digits become digits and letters letters; kept are separators, lengths, domain endings, country digits, private
   address ranges and check digits. Equal e-mail domains stay equal. Names keep script and gender (by the form of address).
3. Surrogates that equal a real entity or another's surrogate are made again with the next attempt, until all are distinct.
   Names, local parts of addresses and secrets grow longer with the attempts, so they always end. A closed format (addresses
   in one private range, numbers of one length and first digit) that still has open entities after ``CLOSED_ATTEMPTS`` is
   mapped by a keyed permutation of all its values instead: no two surrogates are equal and none is its own entity, but one
   may be the real value of another entity, as there may be no others left.
4. Texts with a match are cut at the matches and put together with the surrogates in the mention's own layout. In a
   document with a person, later mentions by surname alone get the same surname. Other texts are passed on as they are.

Cases: a null text stays null and an empty one empty, without entities. Rows that repeat an id are told apart by their
texts; equal rows get equal results. Rows without an id are handled alike. Extra columns are not read. Numbers without a
valid check digit are no cards and stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoopline.llm.frames import stage

#: Attempts before local parts and secrets grow, and before a closed format is permuted.
SAME_LENGTH_ATTEMPTS = 4
CLOSED_ATTEMPTS = 8
CLOSED = ("ip", "phone", "ssn", "card")
PERMUTATION_ROUNDS = 8

# Patterns, and the fixed words of forms of address and keywords.
#: Host labels of at most 63 characters and at most 127 of them (253 characters), as DNS allows; the bounds also
#: keep the regex engine's recursion, one level per label, small on any text.
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){0,125}\.[A-Za-z]{2,63}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP = rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])"
PHONE = r"\+[0-9]{1,3}[ .\-]?\(?[0-9]{2,4}\)?(?:[ .\-]?[0-9]{2,4}){2,4}(?![0-9])"
SSN = r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"
CARD = r"(?<![0-9\-])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){3}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5})(?![0-9])"
KEYWORD = r"(?<![A-Za-z0-9])(?i:token|api[_\-]?key|access[_\-]?key|secret|password|passwd|pwd)"
SECRET_HEAD = KEYWORD + r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
SECRET_VALUE = r"[A-Za-z0-9+/_\-]{16,}"
MALE = "Mr|Herr|Monsieur|Señor|Sr|Г-н|господин"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Г-жа|госпожа"
NEUTRAL = "Dr|Prof|Mx"
#: One of these is part of each form of address.
TITLE_PARTS = "Mr Ms Mx Miss Dr Prof Herr Frau Monsieur Madame Mme Señor Sr Г- господин госпожа".split()
NAME = r"\p{Lu}[\p{L}'’\-]+"
ADDRESS = rf"(?<![\p{{L}}])(?:{MALE}|{FEMALE}|{NEUTRAL})\.?\s"
PERSON = rf"{ADDRESS}{NAME}(?:\s{NAME})?"
ANY = "|".join((SECRET_HEAD + SECRET_VALUE, PERSON, EMAIL, IP, PHONE, SSN, CARD))

GIVEN = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karim Leon Marco Nils Oscar Pavel".split(),
    ("latin", "f"): "Anna Berta Clara Diana Elena Fiona Greta Hanna Irene Julia Karla Lucia Maria Nora Olga Paula".split(),
    ("latin", "n"): "Alex Robin Kim Sascha Jamie Noa Charlie Dominique".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Павел".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Ирина Мария Ольга".split(),
    ("cyrillic", "n"): "Саша Женя Валя Шура".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe fo ga ge go ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va ve vo".split(),
    "cyrillic": "ба бе бо ва ве во га да де до ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та те то".split(),
}
KINDS = ("email", "ip", "phone", "ssn", "card", "secret", "person")


def may_match(text: Column) -> Column:
    """A cheap test that every text with a match of ``ANY`` passes: no kind goes without one of these."""
    # all but secrets, addresses and persons begin with or contain a digit followed like this
    numbers = text.rlike("[0-9](?:[0-9]{3}|[.\\-][0-9])|\\+[0-9]")
    titles = [text.contains(t) for t in TITLE_PARTS]
    return reduce(lambda a, b: a | b, [text.contains("@"), text.contains("="), text.contains(":"), numbers, *titles])


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """The weighted digit sum of the check-digit rule; a valid number's is a multiple of 10."""

    def weighted(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        double = digit * 2
        return total + F.when(i % 2 == 0, F.when(double > 9, double - 9).otherwise(double)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), weighted)


def kind_of(match: Column) -> Column:
    """The kind of a match of ``ANY``."""
    return (
        F.when(match.rlike(f"^{SECRET_HEAD}{SECRET_VALUE}$"), "secret")
        .when(match.contains("@"), "email")
        .when(match.rlike(f"^{OCTET}(?:\\.{OCTET}){{3}}$"), "ip")
        .when(match.startswith("+"), "phone")
        .when(match.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(match.rlike("^[0-9][0-9 \\-]+$"), F.when(luhn_sum(_digits(match)) % 10 == 0, F.lit("card")))
        .otherwise("person")
    )


def _names(match: Column) -> tuple[Column, Column, Column]:
    """(given name or '', surname, gender) of a person's match."""
    pattern = rf"^{ADDRESS}({NAME})(?:\s({NAME}))?$"
    one, two = F.regexp_extract(match, pattern, 1), F.regexp_extract(match, pattern, 2)
    gender = F.when(match.rlike(rf"^(?:{FEMALE})\.?\s"), "f").when(match.rlike(rf"^(?:{MALE})\.?\s"), "m").otherwise("n")
    return F.when(two == "", F.lit("")).otherwise(one), F.when(two == "", one).otherwise(two), gender


def entities_of(match: Column) -> Column:
    """Array of (kind, written, entity) for a match; persons have up to two, unknown numbers none."""

    def part(kind: Column, written: Column, entity: Column) -> Column:
        return F.struct(kind.alias("kind"), written.alias("written"), entity.alias("entity"))

    kind = kind_of(match)
    given, surname, gender = _names(match)
    value = F.regexp_replace(match, f"^{SECRET_HEAD}", "")
    person = F.filter(
        F.array(part(F.concat(F.lit("given_"), gender), given, given), part(F.lit("surname"), surname, surname)),
        lambda x: x["written"] != "",
    )
    plain = part(
        kind,
        F.when(kind == "secret", value).otherwise(match),
        F.when(kind == "email", F.lower(match)).when(kind.isin("phone", "ssn", "card"), _digits(match)).otherwise(
            F.when(kind == "secret", value).otherwise(match)
        ),
    )
    return F.when(kind == "person", person).when(kind.isNotNull(), F.array(plain)).otherwise(F.slice(F.array(plain), 1, 0))


def stream_of(key: str, *values: Column) -> Column:
    """128 bytes in hexadecimal from SHA-256 of the key, a kind, a value and the attempt."""
    return F.concat(*[F.sha2(F.concat_ws("\x1f", F.lit(key), *values, F.lit(k)), 256) for k in range(4)])


class _Stream:
    """Bytes of a stored stream."""

    def __init__(self, hexadecimal: Column):
        self.hexadecimal = hexadecimal

    def byte(self, i: Column) -> Column:
        return F.conv(F.substring(self.hexadecimal, i % 128 * 2 + 1, F.lit(2)), 16, 10).cast("int")

    def digit(self, i: Column) -> Column:
        return (self.byte(i) % 10).cast("string")

    def shaped(self, value: Column) -> Column:
        """``value`` with other digits for digits and other letters for letters."""

        def char(i: Column) -> Column:
            c, b = F.substring(value, i, F.lit(1)), self.byte(i)
            return (
                F.when(c.rlike("[0-9]"), (b % 10).cast("string"))
                .when(c.rlike("[a-z]"), F.char(b % 26 + 97))
                .when(c.rlike("[A-Z]"), F.char(b % 26 + 65))
                .otherwise(c)
            )

        return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(value), F.lit(1))), char), "")


def _script(value: Column) -> Column:
    return F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _pick(items: list[str], b: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in items]), (b % len(items) + 1).cast("int"))


def _word(stream: _Stream, script: Column, start: int, count: Column) -> Column:
    def syllable(i: Column) -> Column:
        return F.when(script == "cyrillic", _pick(SYLLABLES["cyrillic"], stream.byte(i + start))).otherwise(
            _pick(SYLLABLES["latin"], stream.byte(i + start))
        )

    return F.array_join(F.transform(F.sequence(F.lit(1), count), syllable), "")


def with_surrogates(entities: DataFrame, key: str, attempt: int) -> DataFrame:
    """Adds ``surrogate``. The streams are columns of their own, as every character takes a byte of them."""
    domain = F.substring_index("entity", "@", -1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(F.substring_index(domain, ".", -1)) - 1)
    streams = entities.withColumns(
        {
            "stream": stream_of(key, F.col("kind"), F.col("entity"), F.lit(str(attempt))),
            # the domain's surrogate does not depend on the attempt, so that equal domains stay equal
            "host_stream": F.when(F.col("kind") == "email", stream_of(key, F.lit("domain"), host)),
            "host": host,
        }
    )
    made = make_surrogate(F.col("kind"), F.col("entity"), F.lit(attempt))
    return streams.withColumn("surrogate", made).drop("stream", "host_stream", "host")


def _fixed_octets(address: Column) -> Column:
    """How many leading octets say that an address is private; they are kept."""
    two = address.rlike(r"^(?:192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\.")
    return F.when(two, 2).when(address.rlike(r"^(?:10|127)\."), 1).otherwise(0)


def closed_format(kind: Column, entity: Column) -> Column:
    """The closed format that an entity is a value of, with all its surrogates; null for the kinds that can grow."""
    kept = F.when(kind == "ip", _head(entity))
    kept = kept.when(kind.isin("phone", "card"), F.concat_ws("/", F.substring(entity, 1, 1), F.length(entity)))
    return F.when(kind.isin(*CLOSED), F.concat_ws(":", kind, kept))


def _head(address: Column) -> Column:
    fixed = _fixed_octets(address)
    return F.when(fixed == 2, F.substring_index(address, ".", 2)).when(fixed == 1, F.substring_index(address, ".", 1)).otherwise("")


def permuted(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` (kind, entity, format, value) with ``surrogate``, the image of ``value`` in its format under a permutation
    without fixed points: with Q a keyed Feistel network over pairs of numbers, Q, a shift of the first number, Q undone."""
    # the format is the entity's, also where ``value`` is an image outside it
    kind, value, fixed = F.col("kind"), F.col("value"), _fixed_octets(F.col("entity"))
    octets = F.split(value, r"\.")
    free = F.when(kind == "ssn", F.length(value)).otherwise(F.length(value) - F.when(kind == "card", 2).otherwise(1)).cast("int")
    start = F.when(kind == "ssn", 1).otherwise(2)
    half = F.floor(free / 2).cast("int")

    def number(i: int) -> Column:
        return octets[i].cast("long")

    ten = F.lit(10).cast("double")
    ip = kind == "ip"
    rows = rows.withColumns(
        {
            "a_size": F.when(ip, F.when(fixed == 0, 65536).otherwise(256)).otherwise(F.pow(ten, half)).cast("long"),
            "b_size": F.when(ip, F.when(fixed == 2, 256).otherwise(65536)).otherwise(F.pow(ten, free - half)).cast("long"),
            "a": F.when(
                ip, F.when(fixed == 2, number(2)).when(fixed == 1, number(1)).otherwise(number(0) * 256 + number(1))
            ).otherwise(F.substring(value, start, half).cast("long")),
            "b": F.when(ip, F.when(fixed == 2, number(3)).otherwise(number(2) * 256 + number(3))).otherwise(
                F.substring(value, start + half, free - half).cast("long")
            ),
        }
    )

    def drawn(what: Column, turn: Column, size: Column) -> Column:
        digest = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("permutation"), F.col("format"), turn, what), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size

    def turned(pair: Column, step: Column) -> Column:
        turn = F.when(step < PERMUTATION_ROUNDS, step).otherwise(2 * PERMUTATION_ROUNDS - step)
        sign = F.when(step < PERMUTATION_ROUNDS, 1).otherwise(-1)
        first = turn % 2 == 1
        a_size, b_size = F.col("a_size"), F.col("b_size")
        moved = sign * drawn(
            F.when(first, pair["b"]).otherwise(pair["a"]), turn, F.when(first, a_size).otherwise(b_size)
        )
        # odd, so not 0, and every value of an even size comes before the first again
        shift = F.floor(drawn(F.lit(""), F.lit("shift"), a_size) / 2).cast("long") * 2 + 1
        middle = step == PERMUTATION_ROUNDS
        a = F.when(middle, (pair["a"] + shift) % a_size).when(first, F.pmod(pair["a"] + moved, a_size)).otherwise(pair["a"])
        b = F.when(middle | first, pair["b"]).otherwise(F.pmod(pair["b"] + moved, b_size))
        return F.struct(a.alias("a"), b.alias("b"))

    def written(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]
        low = [F.floor(b / 256).cast("string"), (b % 256).cast("string")]
        address = (
            F.when(fixed == 2, F.concat_ws(".", octets[0], octets[1], a.cast("string"), b.cast("string")))
            .when(fixed == 1, F.concat_ws(".", octets[0], a.cast("string"), *low))
            .otherwise(F.concat_ws(".", F.floor(a / 256).cast("string"), (a % 256).cast("string"), *low))
        )
        first = F.when(kind == "ssn", "").otherwise(F.substring(value, 1, 1))
        digits = F.concat(first, F.lpad(a.cast("string"), half, F.lit("0")), F.lpad(b.cast("string"), free - half, F.lit("0")))
        check = ((10 - luhn_sum(F.concat(digits, F.lit("0"))) % 10) % 10).cast("string")
        return F.when(ip, address).when(kind == "card", F.concat(digits, check)).otherwise(digits)

    steps = F.sequence(F.lit(0), F.lit(2 * PERMUTATION_ROUNDS))
    pair = F.aggregate(steps, F.struct(F.col("a").alias("a"), F.col("b").alias("b")), turned)
    # bound to a variable, so that it is made once
    return rows.select("kind", "entity", "format", F.transform(F.array(pair), written)[0].alias("surrogate"))


def permuted_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate) of entities of closed formats by permutation. An image of another format (a private address
    for a public one) is mapped again, until it is one of its own; images stay distinct so."""
    rows, done = entities.withColumn("format", closed_format(F.col("kind"), F.col("entity"))).withColumn("value", F.col("entity")), None
    while True:
        made = stage(permuted(rows.select("kind", "entity", "format", "value"), key), "permuted")
        fits = closed_format(F.col("kind"), F.col("surrogate")) == F.col("format")
        good = made.filter(fits).select("kind", "entity", "surrogate")
        done = good if done is None else done.unionByName(good)
        rows = made.filter(~fits).withColumnRenamed("surrogate", "value")
        if rows.isEmpty():
            return done


def make_surrogate(kind: Column, entity: Column, attempt: Column) -> Column:
    """The surrogate of an entity in its bare form (digits of numbers, lower-case addresses), from its streams."""
    s, host = _Stream(F.col("stream")), F.col("host")
    local, ending = F.substring_index(entity, "@", 1), F.substring_index(entity, ".", -1)
    # later attempts have four letters more each
    more = F.greatest(attempt - SAME_LENGTH_ATTEMPTS + 1, F.lit(0)) * 4
    letters = F.transform(F.sequence(F.lit(1), F.greatest(more, F.lit(1))), lambda i: F.char(s.byte(F.length(entity) + i) % 26 + 97))
    longer = F.when(more > 0, F.array_join(letters, "")).otherwise("")
    email = F.concat(s.shaped(local), longer, F.lit("@"), _Stream(F.col("host_stream")).shaped(host), F.lit("."), ending)

    def number(first: Column, last: Column | None = None) -> Column:
        end = F.length(entity) if last is None else F.length(entity) - 1
        middle = F.transform(F.sequence(F.lit(2), F.greatest(end, F.lit(2))), s.digit)
        return F.concat(first, F.array_join(middle, ""))

    body = number(F.substring(entity, 1, 1), F.lit(1))
    card = F.concat(body, ((10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))
    ssn = number((s.byte(F.lit(1)) % 5 + 1).cast("string"))

    octets, fixed = F.split(entity, r"\."), _fixed_octets(entity)
    made = [F.when(fixed > i, octets[i]).otherwise(((s.byte(F.lit(i)) % (116 if i == 0 else 254)) + (11 if i == 0 else 1)).cast("string")) for i in range(4)]

    size = F.sequence(F.lit(1), F.length(entity))
    hexadecimal = F.array_join(F.transform(size, lambda i: F.substring(s.hexadecimal, i % 256 + 1, F.lit(1))), "")
    secret = (
        F.when(entity.rlike("^[0-9]+$"), s.shaped(entity))
        .when(entity.rlike("^[0-9a-f]+$"), hexadecimal)
        .when(entity.rlike("^[0-9A-F]+$"), F.upper(hexadecimal))
        .otherwise(s.shaped(entity))
    )
    script = _script(entity)
    surname = F.initcap(_word(s, script, 0, F.lit(3) + attempt))
    given = reduce(
        lambda c, k: c.when((script == k[0]) & (kind == f"given_{k[1]}"), _pick(GIVEN[k], s.byte(F.lit(0)))), GIVEN, F.when(F.lit(False), "")
    )
    given = F.when(attempt == 0, given).otherwise(F.concat(given, _word(s, script, 1, attempt)))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", F.concat_ws(".", *made))
        .when(kind == "phone", number(F.substring(entity, 1, 1)))
        .when(kind == "ssn", ssn)
        .when(kind == "card", card)
        .when(kind == "secret", F.concat(secret, longer))
        .when(kind == "surname", surname)
        .otherwise(given)
    )


def written_as(kind: Column, written: Column, surrogate: Column) -> Column:
    """A surrogate in the layout of a mention: digits at its digits' places, capitals if it is in capitals."""

    def place(i: Column) -> Column:
        c = F.substring(written, i, F.lit(1))
        rank = F.length(_digits(F.substring(written, F.lit(1), i)))
        return F.when(c.rlike("[0-9]"), F.substring(surrogate, rank, F.lit(1))).otherwise(c)

    laid = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(written), F.lit(1))), place), "")
    capitals = (written == F.upper(written)) & (written != F.lower(written)) & kind.isin("email", "surname", "given_m", "given_f", "given_n")
    return F.when(kind.isin("phone", "ssn", "card"), laid).when(capitals, F.upper(surrogate)).otherwise(surrogate)


def distinct_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate), one row per distinct entity; surrogates differ from one another and from entities."""
    entities = stage(entities.select("kind", "entity").distinct(), "entities")
    real = entities.select("kind", F.col("entity").alias("surrogate"))
    open_rows, done = entities, None
    attempt, permuted_ones = 0, None
    while True:
        made = with_surrogates(open_rows, key, attempt)
        taken = real if done is None else real.unionByName(done.select("kind", "surrogate"))
        first = made.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        good = stage(first.join(taken, ["kind", "surrogate"], "left_anti"), "surrogates")
        done = good if done is None else done.unionByName(good)
        open_rows = stage(open_rows.join(good, ["kind", "entity"], "left_anti"), "collided")
        attempt += 1
        if open_rows.isEmpty():
            break
        if attempt == CLOSED_ATTEMPTS:
            named = closed_format(F.col("kind"), F.col("entity"))
            full = stage(open_rows.select(named.alias("full")).filter("full is not null").distinct(), "full-formats")
            if not full.isEmpty():
                # all entities of such a format, with those that had a surrogate
                permuted_ones = permuted_surrogates(entities.join(full, named == F.col("full"), "left_semi"), key)
                done = done.join(full, named == F.col("full"), "left_anti")
                open_rows = open_rows.filter(named.isNull())
                if open_rows.isEmpty():
                    break
    done = done.select("kind", "entity", "surrogate")
    return done if permuted_ones is None else done.unionByName(permuted_ones)


def replace_personal_data(documents: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, the number of mentions by kind (a person counts once per mention), and the text."""
    rows = documents.select(
        documents[doc_id].alias("doc_id"), documents[text].cast("string").alias("text"),
    )
    found = F.when(may_match(F.col("text")), F.col("text").rlike(ANY))
    rows = rows.withColumn("hit", F.coalesce(found, F.lit(False)))
    hits = rows.filter("hit").select(
        "doc_id", "text", F.xxhash64("text").alias("name"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("found")
    )
    parts = hits.select("doc_id", "name", F.explode("found").alias("match")).groupBy("doc_id", "name", "match").count()
    parts = stage(
        parts.select("doc_id", "name", "match", F.explode(entities_of(F.col("match"))).alias("part")).select(
            "doc_id", "name", "match", "part.*"
        ),
        "mentions",
    )
    known = distinct_surrogates(parts, key)
    named = parts.join(known, ["kind", "entity"]).select(
        "doc_id", "name", "kind", "written", written_as(F.col("kind"), F.col("written"), F.col("surrogate")).alias("instead")
    )
    maps = named.distinct().groupBy("doc_id", "name").agg(
        F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "written"), "instead"))).alias("instead"),
        F.collect_set(F.when(F.col("kind") == "surname", F.struct("written", "instead"))).alias("surnames"),
    )
    maps = maps.select(F.col("doc_id").alias("map_id"), F.col("name").alias("map_name"), "instead", "surnames")
    same = F.col("doc_id").eqNullSafe(F.col("map_id")) & (F.col("name") == F.col("map_name"))
    joined = hits.join(maps, same, "left")

    def surrogate(match: Column) -> Column:
        kind = kind_of(match)
        given, surname, gender = _names(match)
        head = F.regexp_extract(match, f"^({ADDRESS})", 1)
        person = F.concat(
            head,
            F.when(given == "", F.lit("")).otherwise(
                F.concat(_found(F.concat(F.lit("given_"), gender), given), F.lit(" "))
            ),
            _found(F.lit("surname"), surname),
        )
        prefix = F.regexp_extract(match, f"^({SECRET_HEAD})", 1)
        secret = F.concat(prefix, _found(kind, F.regexp_replace(match, f"^{SECRET_HEAD}", "")))
        return F.when(kind.isNull(), match).when(kind == "person", person).when(kind == "secret", secret).otherwise(_found(kind, match))

    def _found(kind: Column, written: Column) -> Column:
        return F.coalesce(F.try_element_at("instead", F.concat_ws("|", kind, written)), written)

    def later_mentions(piece: Column) -> Column:
        def one(done: Column, x: Column) -> Column:
            word = F.concat(F.lit(r"(?<![\p{L}])"), x["written"], F.lit(r"(?![\p{L}])"))
            return F.regexp_replace(done, word, x["instead"])

        return F.when(F.size("surnames") > 0, F.aggregate("surnames", piece, one)).otherwise(piece)

    pieces = F.zip_with(
        F.split("text", ANY, -1), F.transform("found", surrogate),
        lambda piece, new: F.concat(later_mentions(piece), F.coalesce(new, F.lit(""))),
    )
    kinds = F.transform("found", kind_of)

    def count(kind: str) -> Column:
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    changed = joined.select("doc_id", F.array_join(pieces, "").alias("text"), kinds.alias("kinds")).select("doc_id", *counts, "text")
    plain = rows.filter(~F.col("hit")).select("doc_id", *[F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS], "text")
    return plain.unionByName(changed)
