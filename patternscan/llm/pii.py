"""Surrogates for personal data.

Entities are found by rules, names by the title before them and from there in the
whole document; each different entity of a corpus gets one
surrogate, derived from a secret key: of the same kind, in the same format, for
names of the same gender and script.  A surrogate that another entity has too,
or that occurs in the corpus as a real entity, is derived again, so that
different entities stay different, mentions of one stay together and none is
given a real one's value.

Everything is DataFrame functions.  Only texts with an entity are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patternscan.llm.frames import check_columns, saved, shared_folder

#: Titles that show a gender.
TITLES = {
    "name_m": "Mr|Herr|Monsieur|Señor|г-н|господин|κύριος",
    "name_f": "Mrs|Ms|Frau|Madame|Mme|Mlle|Señora|г-жа|госпожа|κυρία",
    "name_n": "Mx|Dr|Prof",
}
_TITLE = "|".join(TITLES.values())
_L = r"[\p{L}\p{M}]"
#: A capitalised word, without a possessive s and not a title; a name is a run of them.
TOKEN = rf"(?<!{_L})(?!(?:{_TITLE})(?:\. |[ .]?$| \p{{Lu}}))\p{{Lu}}(?=['’\-]?{_L}){_L}*+(?:['’\-](?!s(?!{_L})){_L}++)*+"
_BETWEEN = r"(?:\p{Lu}\.|von(?: der| dem| den)?|van(?: der| den| de)?|de(?: la| los| las)?|di|bin|ibn|al)"
_RUN = rf"(?:(?:\p{{Lu}}|{_BETWEEN}) ){{0,4}}{TOKEN}(?: (?:{_BETWEEN} ){{0,3}}{TOKEN})*+"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_HEX = "[0-9A-Fa-f]{1,4}"
# cheap tests first: a capital or a particle after a space
_BEGIN = r"(?=\p{Lu}|v[ao]n |d[ei] |bin |ibn |al )"
_NAME = rf"{_BEGIN}(?<= )(?<=(?<![\p{{L}}\-])(?:{_TITLE})\.? ){_RUN}"
#: Countries with account numbers of this form.
_IBAN = (
    "A[DELTZ]|B[AEGHRY]|C[HRYZ]|D[EKO]|E[EGS]|F[IOR]|G[BEILRT]|H[RU]|I[ELQST]|JO|K[WZ]|L[BCITUVY]|M[CDEKRTU]|N[LO]"
    "|P[KLST]|QA|R[OS]|S[ACDEIKMTV]|T[LNR]|UA|V[AG]|XK"
)


#: Kind and expression of each entity; an earlier kind goes first.
ENTITIES = {
    "email": r"(?<![\p{L}\p{N}._%+\-@])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]*[\p{L}\p{N}])+",
    "secret": r"(?<![\p{L}\p{N}])(?:(?=[0-9A-Fa-f]*[A-Fa-f])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,}+|(?:(?:sk|pk|ghp|gho|xoxb)[\-_]|AKIA)[\-_A-Za-z0-9]{16,}+)(?![\p{L}\p{N}])",
    "iban": rf"(?<![\p{{L}}\p{{N}}])(?:{_IBAN})\d{{2}}(?:(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?|[A-Z0-9]{{11,30}})(?![\p{{L}}\p{{N}}])",
    "ipv6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[0-9A-Fa-f:]{{0,39}}[0-9])(?:(?:{_HEX}:){{7}}{_HEX}"
    rf"|(?=[0-9A-Fa-f]{{3,4}}:)(?!(?:[0-9A-Fa-f]*:+){{8}}){_HEX}(?::{_HEX}){{0,6}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![\p{{L}}\p{{N}}:])",
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)(?!\p{{L}})",
    "ssn": r"(?<![\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{N}\-])",
    "phone": r"(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .\-]?\(\d{1,5}\)[ .\-]?\d{2,5}(?:[ .\-]\d{2,5}){0,3}"
    r"|\+\d{1,3}(?:[ .\-]\d{2,8}){2,4}|\+\d{8,15}|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?!\d)"
    # without a country code: French, German, Spanish
    r"|(?<![\p{L}\p{N}])(?<!\d[ .\-/])(?:0[1-9](?:[ .\-]\d{2}){4}|0[1-9]\d{8}|0\d{2,4}[ /\-]\d{5,8}|\(0\d{1,4}\) ?\d{4,8}"
    r"|[6-9]\d{2}(?: \d{2}){3}|[67]\d{2} \d{3} \d{3}|9\d \d{3} \d{2} \d{2})(?![ .\-/]?\d|\p{L})",
    "card": r"(?<![\p{L}\p{N}+])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3}(?:[ \-]\d{1,3})?|\d{4}[ \-]\d{6}[ \-]\d{5})(?![\p{L}\p{N}])",
}
ENTITY = "|".join(f"(?:{pattern})" for pattern in (*ENTITIES.values(), _NAME))
#: The same and all capitalised words: a text with names is cut at these.
ENTITY_OR_WORD = f"{ENTITY}|(?:{TOKEN})"
NAMED = rf"(?:{_TITLE})\.? {_BEGIN}"
#: Every entity holds a digit or an @, begins with a key's prefix or follows a title.
CLUES = (
    "sk-", "sk_", "pk-", "pk_", "ghp-", "ghp_", "gho-", "gho_", "xoxb-", "xoxb_", "AKIA",
    *(title for titles in TITLES.values() for title in titles.split("|")),
)

#: Syllables and endings of made-up names by script; endings are
#: for a man, a woman, and either.
SCRIPTS = {
    "Latin": (
        "ba be bo da de do fa fe ga ge go ka ke ko la le lo ma me mo na ne no pa pe po ra re ro sa se so ta te to va ve vo",
        ("len", "rick", "mond", "ton"),
        ("lina", "rissa", "nelle", "tia"),
        ("ley", "ry", "nis", "ko"),
    ),
    "Cyrillic": (
        "ба бе бо да де до га ге ка ке ко ла ле ло ма ме мо на не но па пе по ра ре ро са се со та те то ва ве во",
        ("лов", "рин", "нев", "тов"),
        ("лова", "рина", "нева", "това"),
        ("ленко", "рук", "ных", "тько"),
    ),
    "Greek": (
        "βα βε βο δα δε δο γα γε κα κε κο λα λε λο μα με μο να νε νο πα πε πο ρα ρε ρο σα σε σο τα τε το",
        ("λος", "ρης", "νας", "τος"),
        ("λη", "ρα", "νια", "τη"),
        ("λι", "ρι", "νι", "τι"),
    ),
}

#: What a telephone number keeps, a trunk zero or the country code
#: (no code begins with another one); a number that still collides after so many
#: attempts keeps neither.
CODE = r"^(?:0|\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}))"
_KEEP_CODE = 8


@dataclass(frozen=True)
class PiiParams:
    """``key`` decides all surrogates; ``rounds`` is how often colliding ones are
    derived again before the work is given up with an error."""

    key: str = "change me"
    rounds: int = 24


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def _key(kind: Column, raw: Column) -> Column:
    return F.concat(kind, F.lit("\x1f"), raw)


def entities(text: Column) -> Column:
    """``array<struct<before, kind, raw>>``: the text in order, cut into what is
    before an entity and the entity; the last has neither kind nor ``raw``.

    A name is what follows a title, and every later or earlier mention of one of
    its words in the text.  Its gender is that of the title before it or else of
    the first title in the text that shows one for this word.  A capitalised
    word that is no name has no kind.
    """
    none = F.lit(None).cast("string")

    def one(e: Column) -> Column:
        """A run of names in words, any other entity as it is."""
        before, raw = e["before"], e["raw"]
        end = F.right(before, F.lit(40))
        named = none
        for kind in reversed(TITLES):
            title = rf"(?<![\p{{L}}\-])(?:{TITLES[kind]})\.? (?:(?:{TITLES['name_n']})\.? ){{0,2}}$"
            named = F.when(end.rlike(title), F.lit(kind)).otherwise(named)
        other = none
        for kind in reversed(ENTITIES):
            other = F.when(raw.rlike(f"^(?:{ENTITIES[kind]})$"), F.lit(kind)).otherwise(other)
        words = F.arrays_zip(F.split(raw, TOKEN, -1).alias("gap"), F.regexp_extract_all(raw, F.lit(TOKEN), F.lit(0)).alias("word"))
        run = F.transform(
            F.filter(words, lambda w: w["word"].isNotNull()),
            lambda w, i: F.struct(
                F.when(i == 0, F.concat(before, w["gap"])).otherwise(w["gap"]).alias("before"),
                F.coalesce(named, F.lit("word")).alias("kind"),
                w["word"].alias("raw"),
            ),
        )
        is_run = raw.rlike(f"^{_RUN}$") & ~raw.rlike(f"^(?:{ENTITIES['secret']})$")
        whole = F.array(F.struct(before.alias("before"), other.alias("kind"), raw.alias("raw")))
        return F.when(raw.isNull(), F.array(F.struct(before.alias("before"), none.alias("kind"), raw.alias("raw")))).when(
            is_run, run
        ).otherwise(whole)

    def resolved(flat: Column) -> Column:
        def names(kinds: list[str]) -> Column:
            held = F.filter(flat, lambda e: e["kind"].isin(kinds))
            return F.transform(held, lambda e: F.struct(F.lower(e["raw"]).alias("word"), e["kind"].alias("kind")))

        def judged(known: Column) -> Column:
            def kind(e: Column) -> Column:
                word = F.lower(e["raw"])
                at = F.array_position(known["shown"]["word"], word)
                shown = F.when(at > 0, F.try_element_at(known["shown"]["kind"], at.cast("int")))
                any_title = F.when(F.array_contains(known["all"]["word"], word), F.lit("name_n"))
                return F.when(e["kind"].isin("word", "name_n"), F.coalesce(shown, any_title)).otherwise(e["kind"])

            return F.transform(flat, lambda e: F.struct(e["before"].alias("before"), kind(e).alias("kind"), e["raw"].alias("raw")))

        return _let(F.struct(names(["name_m", "name_f"]).alias("shown"), names(list(TITLES)).alias("all")), judged)

    def cuts(rule: str) -> Column:
        return F.arrays_zip(F.split(text, rule, -1).alias("before"), F.regexp_extract_all(text, F.lit(rule), F.lit(0)).alias("raw"))

    found = F.when(text.rlike(NAMED), cuts(ENTITY_OR_WORD)).otherwise(cuts(ENTITY))
    return _let(F.flatten(F.transform(found, one)), resolved)


def may_hold_entity(text: Column) -> Column:
    """A cheap test that every text with an entity passes."""
    found = text.rlike("[0-9@]")
    for clue in CLUES:
        if any(other != clue and other in clue for other in CLUES):
            continue  # the shorter one tells
        found = found | text.contains(clue)
    return found


def canonical(kind: Column, raw: Column) -> Column:
    """What all mentions of an entity have in common."""
    digits = F.regexp_replace(raw, "[^0-9]", "")

    def groups(part: Column) -> Column:
        return F.filter(F.split(part, ":"), lambda g: g != "")

    left = groups(F.substring_index(raw, "::", 1))
    right = F.when(raw.contains("::"), groups(F.substring_index(raw, "::", -1))).otherwise(F.array().cast("array<string>"))
    zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.size(left) - F.size(right)))
    address = F.transform(F.concat(left, zeros, right), lambda g: F.lpad(F.lower(g), 4, "0"))
    return (
        F.when(kind == "iban", F.upper(F.regexp_replace(raw, " ", "")))
        .when(kind == "ipv6", F.array_join(address, ":"))
        .when((kind == "phone") & raw.startswith("+"), F.concat(F.lit("+"), digits))
        .when(kind.isin("phone", "card", "ssn"), digits)
        .otherwise(F.lower(raw))
    )


def _stream(params: PiiParams, salt: str) -> Column:
    """64 hexadecimal digits that the key decides for ``kind, canon, attempt``."""
    return F.sha2(F.concat_ws("\x1f", F.lit(params.key), F.lit(salt), "kind", "canon", F.col("attempt").cast("string")), 256)


def _byte(stream: Column, k: int) -> Column:
    return F.conv(F.substring(stream, 1 + 2 * k, 4), 16, 10).cast("int")


def _poured(canon: Column, digits: Column, letters: Column) -> Column:
    """The text with each digit and each letter replaced by that of a stream."""
    return F.array_join(
        F.transform(
            F.split(canon, ""),
            lambda c, i: F.when(c.rlike(r"\p{N}"), F.substring(digits, i % 64 + 1, F.lit(1)))
            .when(c.rlike(r"\p{L}"), F.substring(letters, i % 64 + 1, F.lit(1)))
            .otherwise(c),
        ),
        "",
    )


def _luhn(digits: Column) -> Column:
    """The remainder of a digit string by the checksum of card numbers."""

    def digit(c: Column) -> Column:
        return c.try_cast("int")

    places = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, digit(c)).otherwise(2 * digit(c) - F.when(digit(c) > 4, 9).otherwise(0)),
    )
    return F.aggregate(places, F.lit(0), lambda s, x: s + x) % 10


def _mod97(account: Column) -> Column:
    """The remainder of an account number, letters as 10 to 35."""

    def add(s: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), s * 10 + F.ascii(c) - 48).otherwise(s * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.split(account, ""), F.lit(0), add)


def _surrogate(params: PiiParams) -> Column:
    """The surrogate of ``kind, canon, attempt`` in canonical form."""
    stream, more = _stream(params, "a"), _stream(params, "b")
    digits = F.translate(stream, "abcdef", "204713")
    letters = F.translate(more, "0123456789abcdef", "bdfghjklmnprstvz")
    canon = F.col("canon")

    local, host = F.substring_index(canon, "@", 1), F.substring_index(F.substring_index(canon, "@", -1), ".", 1)
    top = F.substring_index(canon, ".", -1)
    email = F.concat(
        _poured(local, digits, letters),
        F.when(F.char_length(local) < 8, F.concat(F.lit("."), F.substring(letters, 41, 6))).otherwise(""),
        F.lit("@"),
        _poured(host, F.reverse(digits), F.reverse(letters)),
        F.lit(".example."),
        F.when(top.isin("com", "net", "org"), top).otherwise("org"),
    )
    secret = F.array_join(
        F.transform(
            F.split(canon, ""),
            lambda c, i: F.when(c.rlike("[0-9a-f]"), F.substring(F.concat(stream, more), i % 128 + 1, F.lit(1)))
            .when(c.rlike("[a-z]"), F.substring(letters, i % 64 + 1, F.lit(1)))
            .otherwise(c),
        ),
        "",
    )
    ip = F.array_join(F.array(*((_byte(stream, 2 * k) % 254 + 1).cast("string") for k in range(4))), ".")
    begin = F.when(F.col("attempt") <= _KEEP_CODE, F.regexp_extract(canon, CODE, 0)).otherwise(F.regexp_extract(canon, r"^\+?", 0))
    number = F.concat(begin, F.substring(digits, F.lit(1), F.char_length(canon) - F.char_length(begin)))
    ssn = F.concat(F.lit("9"), F.substring(digits, 2, 8))
    body = F.substring(digits, F.lit(1), F.char_length(canon) - 1)
    check = ((10 - _luhn(F.concat(body, F.lit("0")))) % 10).cast("int")
    valid = _luhn(canon) == 0
    card = F.concat(body, F.when(valid, check).otherwise((check + 1 + _byte(more, 3) % 9) % 10).cast("string"))

    documents = F.array(F.lit("2001"), F.lit("0db8"), *(F.substring(more, 1 + 4 * k, 4) for k in range(6)))  # 2001:db8::/32
    country = F.substring(canon, 1, 2)
    account = F.expr("substring(canon, 5)")
    account = F.upper(_poured(account, digits, letters))
    right_sum = _mod97(F.concat(F.expr("substring(canon, 5)"), F.substring(canon, 1, 4))) == 1
    sum_digits = F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0")
    iban = F.concat(country, F.when(right_sum, sum_digits).otherwise(F.substring(digits, 61, 2)), account)

    def name(kind: int) -> Column:
        made = None
        for script, (syllables, *endings) in SCRIPTS.items():
            parts, ends = syllables.split(" "), endings[kind]
            array, last = F.array(*map(F.lit, parts)), F.array(*map(F.lit, ends))
            count = 2 + F.when(F.col("attempt") > 3, 2).otherwise(0)
            picked = F.concat(
                *(F.element_at(array, _byte(stream, 2 * k) % len(parts) + 1) for k in range(2)),
                F.when(count > 2, F.concat(*(F.element_at(array, _byte(stream, 4 + 2 * k) % len(parts) + 1) for k in range(2)))).otherwise(""),
                F.element_at(last, _byte(more, 1) % len(ends) + 1),
            )
            if made is None:
                made = picked
            else:
                made = F.when(canon.rlike(rf"\p{{Is{script}}}"), picked).otherwise(made)
        return made

    by_kind = {
        "email": email, "secret": secret, "ip": ip, "ssn": ssn, "phone": number, "card": card,
        "iban": iban, "ipv6": F.array_join(documents, ":"),
        "name_m": name(0), "name_f": name(1), "name_n": name(2),
    }
    out = F.lit(None).cast("string")
    for kind, value in by_kind.items():
        out = F.when(F.col("kind") == kind, value).otherwise(out)
    return out


def surrogates(found: DataFrame, params: PiiParams, folder: str) -> DataFrame:
    """``kind, canon, surrogate`` for the different entities in ``kind, canon``.

    Of entities with one surrogate the smallest keeps it and the others try
    again, as do those whose surrogate is a real entity of the same kind.
    Names are of one kind here, whatever their gender.
    """
    alike = F.when(F.col("kind").startswith("name"), F.lit("name")).otherwise(F.col("kind")).alias("alike")
    real = saved(found.select("kind", "canon").distinct(), folder, "entities")
    made = saved(real.withColumn("attempt", F.lit(0)).withColumn("surrogate", _surrogate(params)), folder, "made-0")
    names = real.select(alike, F.col("canon").alias("surrogate"), F.lit(True).alias("is_real")).distinct()
    for k in range(1, params.rounds + 1):
        tried = made.withColumn("alike", alike)
        first = tried.groupBy("alike", "surrogate").agg(F.min(F.struct("canon", "kind")).alias("owner"))
        judged = tried.join(first, ["alike", "surrogate"]).join(names, ["alike", "surrogate"], "left")
        judged = judged.withColumn("again", (F.struct("canon", "kind") != F.col("owner")) | F.col("is_real").isNotNull())
        if judged.filter("again").isEmpty():
            return made.select("kind", "canon", "surrogate")
        judged = judged.select("kind", "canon", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))
        made = saved(judged.withColumn("surrogate", _surrogate(params)), folder, f"made-{k}")
    raise RuntimeError(f"surrogates still collide after {params.rounds} rounds")


def in_format(kind: Column, raw: Column, surrogate: Column) -> Column:
    """A surrogate written as the mention is: its separators and case.

    Every digit of the surrogate is written, so what is distinct stays so.
    """
    characters, plain = F.split(raw, ""), F.regexp_replace(surrogate, r"^\+", "")

    def digit(c: Column, i: Column) -> Column:
        nth = F.char_length(F.regexp_replace(F.substring(raw, F.lit(1), i + 1), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substring(plain, nth, F.lit(1))).otherwise(c)

    def sign(c: Column, i: Column) -> Column:
        nth = F.char_length(F.regexp_replace(F.substring(raw, F.lit(1), i + 1), " ", ""))
        return F.when(c != " ", F.substring(surrogate, nth, F.lit(1))).otherwise(c)

    numeric = F.array_join(F.transform(characters, digit), "")
    account = F.array_join(F.transform(characters, sign), "")
    all_upper = (raw == F.upper(raw)) & (raw != F.lower(raw))
    return (
        F.when(kind.isin("phone", "card", "ssn"), numeric)
        .when(kind == "iban", account)
        .when(all_upper, F.upper(surrogate))
        .when(kind.startswith("name"), F.initcap(surrogate))
        .otherwise(surrogate)
    )


def replace_entities(
    docs: DataFrame,
    params: PiiParams = PiiParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
    count_col: str | None = None,
) -> DataFrame:
    """The rows with every entity in the text replaced by its surrogate.

    The other columns stay as they are; ``count_col`` adds the number of
    entities.  A null text stays null, a text without an entity as it is.  Rows
    without id and repeated rows are rewritten like any others; one entity has
    one surrogate in all of them.
    """
    check_columns(docs, id_col, text_col)
    folder = shared_folder(docs.sparkSession)
    text = F.col(text_col).cast("string")
    has = F.coalesce(may_hold_entity(text) & text.rlike(ENTITY), F.lit(False))
    dirty = docs.filter(has).withColumn("_llm_hash", F.xxhash64(text))
    parts = entities(text)
    mentions = dirty.select(
        F.col(id_col).alias("_llm_id"),
        F.col("_llm_hash").alias("_llm_same"),
        F.explode(F.array_distinct(F.transform(F.filter(parts, lambda e: e["kind"].isNotNull()), lambda e: F.struct(e["kind"].alias("kind"), e["raw"].alias("raw"))))).alias("e"),
    ).select("_llm_id", "_llm_same", "e.kind", "e.raw").distinct()
    mentions = saved(mentions.withColumn("canon", canonical(F.col("kind"), F.col("raw"))), folder, "mentions")
    table = surrogates(mentions, params, folder)
    new = in_format(F.col("kind"), F.col("raw"), F.col("surrogate"))
    written = mentions.join(table, ["kind", "canon"]).select(
        "_llm_id", "_llm_same", F.struct(_key(F.col("kind"), F.col("raw")).alias("k"), new.alias("s")).alias("s")
    )
    gathered = written.groupBy("_llm_id", "_llm_same").agg(F.map_from_entries(F.collect_list("s")).alias("_llm_new"))
    joined = dirty.join(
        gathered, dirty[id_col].eqNullSafe(gathered["_llm_id"]) & (dirty["_llm_hash"] == gathered["_llm_same"]), "left"
    )
    lost = F.raise_error(F.lit("an entity has no surrogate")).cast("string")

    def rewritten(e: Column) -> Column:
        new = F.when(e["kind"].isNull(), F.coalesce(e["raw"], F.lit(""))).otherwise(
            F.coalesce(F.try_element_at(F.col("_llm_new"), _key(e["kind"], e["raw"])), lost)
        )
        return F.concat(e["before"], new)

    def whole(p: Column) -> Column:
        return F.struct(
            F.array_join(F.transform(p, rewritten), "").alias("text"),
            F.size(F.filter(p, lambda e: e["kind"].isNotNull())).cast("bigint").alias("count"),
        )

    joined = joined.withColumn("_llm_out", _let(parts, whole))
    count = {count_col: F.col("_llm_out")["count"]} if count_col else {}
    zero = {count_col: F.lit(0).cast("bigint")} if count_col else {}
    columns = [*docs.columns, *count]
    changed = joined.withColumns({text_col: F.col("_llm_out")["text"]} | count).select(*columns)
    return docs.filter(~has).withColumns(zero).select(*columns).unionByName(changed)
