"""Surrogates for personal data: every detected entity gets a keyed replacement of its kind.

One regular expression finds all kinds. The text is split by it, and the pieces are put
together again with each match replaced. A replacement is derived from a key, the kind
and the normalised entity, so an entity is replaced alike wherever and however it is
written (digits with or without separators, upper or lower case). It keeps kind, length
of digit groups, separators, case, script, gender ending, and valid check digits.

Distinct entities could by chance get equal surrogates, or one that is somebody else's
entity. The distinct entities of the corpus are checked for that, and those that collide
are drawn again; only these exceptions are joined back to the documents.

A name found beside its title is also replaced where the same document repeats it without
one: the whole name, and the family name alone, as written or in capitals. Such places are
of kind ``mention``. Families and given names have surrogates of their own, so all mentions
of a person stay mentions of one person.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelake.llm.common import shielded, where_computed
from ratelake.session import materialize

# Draws of an entity before its surrogates may grow longer, and before giving up.
WIDER_AFTER = 12
MOST_DRAWS = 64

# Forms of address by gender; a dot may follow those that are short for something.
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Lady", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "Госпожа", "г-жа", "Κυρία")
MALE_TITLES = ("Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Господин", "г-н", "Κύριος")
OTHER_TITLES = ("Dr", "Prof", "Professor")

# A blank or a no-break space.
GAP = "[  ]"
_TITLE = "(?:" + "|".join(f"{t}\\.?" if len(t) <= 4 and t.isascii() else t for t in (*FEMALE_TITLES, *MALE_TITLES, *OTHER_TITLES)) + ")"
_TITLES = rf"(?:{_TITLE}{GAP})+"
_WORD = r"\p{Lu}[\p{L}'’-]+"
# The kinds in the order in which they are tried at one place of the text.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "password": r"(?<![\p{L}\p{N}])(?:[Pp]assword|PASSWORD|[Pp]asswd|[Pp]assphrase)[ ]?[:=][ ]?(?=[^\s\"'<>,;]{0,64}[0-9])[^\s\"'<>,;]{4,64}",
    "token": r"(?<![0-9A-Za-z_-])(?:[spr]k_(?:live|test)_|gh[pousr]_|xox[abpr]-|AKIA)(?=[A-Za-z_-]{0,128}[0-9])[0-9A-Za-z_-]{8,128}(?![0-9A-Za-z_-])",
    "secret": r"(?<![0-9A-Za-z])(?=[a-fA-F]*[0-9])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "ip6": r"(?<![0-9A-Za-z:])(?=[A-Fa-f:]{0,39}[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"
    r"|0[1-9][0-9]{1,3}[ /][0-9]{6,8}|0[1-9](?: [0-9]{2}){4})(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z.])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])",
    "name": rf"(?<![\p{{L}}\p{{N}}]){_TITLES}{_WORD}(?:{GAP}{_WORD})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# A text without these has no entity: one cheap test spares most texts the long expression.
HINT = rf"@|[0-9]|(?<![\p{{L}}\p{{N}}]){_TITLE}{GAP}"

# One syllable for each hexadecimal digit; the letters of other scripts.
SYLLABLES = ("ba", "do", "ki", "lu", "me", "na", "po", "ri", "sa", "te", "vo", "zi", "ga", "len", "mar", "tor")
LATIN = "abdegiklmnoprstuvz"
SCRIPTS = {"cyrillic": "абдегиклмнопрстувз", "greek": "αβδεγικλμνοπρστυωζ"}
IN_SCRIPT = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}


def _is(text: Column, pattern: str) -> Column:
    return F.regexp_like(text, F.lit(f"^(?:{pattern})$"))


def kind_of(match: Column) -> Column:
    """The kind of a match: the first pattern that fits it whole."""
    out = F.lit("name")
    for kind in reversed([k for k in PATTERNS if k != "name"]):
        out = F.when(_is(match, PATTERNS[kind]), F.lit(kind)).otherwise(out)
    return out


def digest(key: str, kind: Column | str, entity: Column, attempt: Column) -> Column:
    """64 hexadecimal digits that depend on the key and all three."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.sha2(F.concat_ws("|", F.lit(key), kind, entity, attempt.cast("string")), 256)


def decimal_digits(hexadecimal: Column) -> Column:
    """A digit for each hexadecimal digit."""
    return F.translate(hexadecimal, "abcdef", "283746")


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def syllables(hexadecimal: Column, start: int, count: Column | int) -> Column:
    table = F.array(*[F.lit(s) for s in SYLLABLES])
    number = F.lit(count) if isinstance(count, int) else count
    picked = F.transform(
        F.split(F.substr(hexadecimal, F.lit(start), number.cast("int")), ""),
        lambda c: F.element_at(table, F.conv(c, 16, 10).cast("int") + 1),
    )
    return F.array_join(picked, "")


def refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in turn by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        return F.struct(
            F.concat(s["out"], F.when(digit, F.substr(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + digit.cast("int")).alias("at"),
        )

    return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])


def luhn_sum(digits: Column) -> Column:
    """Check sum of a digit string, doubling every second digit from the right, the last one left alone."""
    def add(total: Column, digit: Column, place: Column) -> Column:
        twice = digit * 2
        return total + F.when(place % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    placed = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(placed, F.lit(0), lambda s, x: add(s, x["d"], x["i"])) % 10


def card_digits(original: Column, hexadecimal: Column) -> Column:
    """As many digits, the first kept; if the original has a valid check digit, so has this."""
    size = F.length(original)
    drawn = F.concat(F.substring(original, 1, 1), F.substr(decimal_digits(hexadecimal), F.lit(1), size - 1))
    body = F.substr(drawn, F.lit(1), size - 1)
    check = (10 - luhn_sum(F.concat(body, F.lit("0")))) % 10
    return F.when(luhn_sum(original) == 0, F.concat(body, check.cast("string"))).otherwise(drawn)


def iban_text(original: Column, hexadecimal: Column) -> Column:
    """Country kept, digits for digits, letters for letters, and valid check digits."""
    rest = F.array_join(
        F.transform(
            F.split(F.substr(original, F.lit(5), F.length(original) - 4), ""),
            lambda c, i: F.when(
                c.between("0", "9"), decimal_digits(F.substr(hexadecimal, i + 1, F.lit(1)))
            ).otherwise(F.translate(F.substr(hexadecimal, i + 1, F.lit(1)), "0123456789abcdef", "ABCDEFGHJKLMNPQR")),
        ),
        "",
    )
    country = F.substring(original, 1, 2)

    def add(s: Column, c: Column) -> Column:
        value = F.conv(c, 36, 10).cast("int")
        return (s * F.when(value > 9, 100).otherwise(10) + value) % 97

    check = 98 - F.aggregate(F.split(F.concat(rest, country, F.lit("00")), ""), F.lit(0), add)
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), rest)


def address(hexadecimal: Column) -> Column:
    """Four numbers from 1 to 254."""
    part = lambda i: (F.conv(F.substring(hexadecimal, 8 * i + 1, 6), 16, 10).cast("int") % 254 + 1).cast("string")
    return F.concat_ws(".", part(0), part(1), part(2), part(3))


def name_word(kind: Column, word: Column, attempt: Column, drawn: Column) -> Column:
    """A name of made-up syllables in the word's script, with an ending by gender; ``word`` is in lower case."""
    ending = F.when(kind == "female", "na").when(kind == "male", "n").otherwise(F.lit("ler"))
    latin = F.concat(syllables(drawn, 1, 3 + attempt), ending)
    out = latin
    for script, letters in SCRIPTS.items():
        out = F.when(word.rlike(IN_SCRIPT[script]), F.translate(latin, LATIN, letters)).otherwise(out)
    return out


def titles_of(mention: Column) -> Column:
    return F.regexp_extract(mention, f"^{_TITLES}", 0)


def name_words(mention: Column) -> Column:
    """The words of a name mention after its titles."""
    return F.split(F.regexp_replace(mention, f"^{_TITLES}", ""), GAP)


def gender_of(mention: Column) -> Column:
    """By the first title that tells one; ``person`` where none does."""
    said = F.transform(F.split(titles_of(mention), GAP), lambda t: F.regexp_replace(t, r"\.$", ""))
    telling = F.filter(said, lambda t: t.isin(*FEMALE_TITLES, *MALE_TITLES))
    return F.when(F.size(telling) == 0, "person").when(F.get(telling, F.lit(0)).isin(*FEMALE_TITLES), "female").otherwise("male")


def entities_of(mention: Column, kind: Column) -> Column:
    """The normalised entities of a mention, as ``(kind, entity)``; a name has one for each word."""
    entity = (
        F.when(kind.isin("email", "secret", "ip6"), F.lower(mention))
        .when(kind == "password", F.regexp_replace(mention, "^[^:=]*[:=] ?", ""))
        .when(kind == "phone", F.regexp_replace(mention, "[^0-9+]", ""))
        .when(kind.isin("card", "ssn"), only_digits(mention))
        .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
        .otherwise(mention)
    )
    words = name_words(mention)
    named = F.transform(
        words,
        lambda w, i: F.struct(F.when(i + 1 == F.size(words), "family").otherwise(gender_of(mention)).alias("kind"), F.lower(w).alias("entity")),
    )
    return F.when(kind == "name", named).otherwise(F.array(F.struct(kind.alias("kind"), entity.alias("entity"))))


def surrogate_of(kind: Column, entity: Column, attempt: Column, drawn: Column, key: str) -> Column:
    """The normalised surrogate of a normalised entity; ``drawn`` is the digest of the key and the three.

    Numbers of few digits have few surrogates; after ``WIDER_AFTER`` draws theirs get one more
    digit a draw.
    """
    digits = decimal_digits(drawn)
    wider = F.greatest(attempt - WIDER_AFTER, F.lit(0))
    tail = F.substr(F.concat(drawn, F.sha2(drawn, 256)), F.lit(1), F.length(entity))
    prefix = F.regexp_extract(entity, "^(?:[a-z]{2}_(?:live|test)_|[a-z]{3}_|[a-z]{4}-|AKIA)", 0)
    token = F.concat(prefix, F.substr(tail, F.lit(1), F.length(entity) - F.length(prefix)))
    groups = [F.substring(drawn, 4 * i + 1, 4) for i in range(6)]
    at = F.instr(entity, "@")
    domain = F.substr(entity, at + 1, F.length(entity))
    email = F.concat(
        syllables(drawn, 1, 5),
        F.when(F.substr(entity, F.lit(1), at - 1).rlike("[0-9]"), F.concat(F.lit("."), F.substring(digits, 9, 4))).otherwise(F.lit("")),
        F.lit("@"),
        syllables(digest(key, "domain", domain, F.lit(0)), 1, 4),
        F.lit(".example."),
        F.regexp_extract(entity, r"\.([a-z]+)$", 1),
    )
    # The country code of an international number is kept: one digit in zones 1 and 7, two elsewhere; so is a leading 0.
    code = F.when(entity.rlike(r"^\+[17]"), 2).when(entity.startswith("+"), 3).when(entity.startswith("0"), 1).otherwise(0)
    area = F.translate(F.substring(digits, 1, 1), "01", "79")
    return (
        F.when(kind == "email", email)
        .when(kind == "secret", tail)
        .when(kind == "token", F.when(prefix == "AKIA", F.upper(token)).otherwise(token))
        .when(kind == "password", F.concat(syllables(drawn, 1, 3), F.substring(digits, 9, 4)))
        .when(kind == "ip6", F.concat_ws(":", F.lit("2001"), F.lit("db8"), *groups))
        .when(kind == "iban", iban_text(entity, drawn))
        .when(kind == "ip", address(drawn))
        .when(kind == "phone", F.concat(F.substr(entity, F.lit(1), code), area, F.substr(digits, F.lit(2), F.length(entity) - code - 1 + wider)))
        .when(kind == "ssn", F.substr(digits, F.lit(1), 9 + wider))
        .when(kind == "card", card_digits(entity, drawn))
        .otherwise(name_word(kind, entity, attempt, drawn))
    )


def _like_case(word: Column, like: Column) -> Column:
    return F.when((F.length(like) > 1) & (like == F.upper(like)), F.upper(word)).otherwise(F.initcap(word))


def with_surrogates(parts: Column, attempts: Column, key: str) -> Column:
    """The entities of a mention with ``made``, their surrogates.

    Each step is a transform of its own, so that what it computes is computed once and
    named in the next; nested in one expression it would be repeated at every use.
    """
    tried = F.transform(
        parts,
        lambda p: F.struct(
            p["kind"].alias("kind"), p["entity"].alias("entity"), F.coalesce(attempts[F.concat_ws("|", p["kind"], p["entity"])], F.lit(0)).alias("attempt")
        ),
    )
    drawn = F.transform(tried, lambda p: p.withField("drawn", digest(key, p["kind"], p["entity"], p["attempt"])))
    return F.transform(drawn, lambda p: surrogate_of(p["kind"], p["entity"], p["attempt"], p["drawn"], key))


def rewritten(kind: Column, match: Column, made: Column) -> Column:
    """The replacement of a match in the match's own format; ``made`` are the surrogates of its entities."""
    one = made[0]
    iban = F.when(F.contains(match, F.lit(" ")), F.rtrim(F.regexp_replace(one, "(.{4})", "$1 "))).otherwise(one)
    name = F.concat(titles_of(match), F.array_join(F.zip_with(made, name_words(match), _like_case), " "))
    upper = (match == F.upper(match)) & match.rlike("[A-Z]")
    shape_digits = F.length(only_digits(match))
    # Digits of a surrogate that had to grow follow the last one of the shape.
    refilled = F.concat(refill(match, only_digits(one)), F.substr(only_digits(one), shape_digits + 1, F.length(one)))
    return (
        F.when(kind == "name", name)
        .when(kind.isin("phone", "card", "ssn"), refilled)
        .when(kind == "iban", iban)
        .when(kind == "password", F.concat(F.regexp_extract(match, "^[^:=]*[:=] ?", 0), one))
        .when(kind == "token", one)
        .when(upper, F.upper(one))
        .otherwise(one)
    )


def _bare_forms(name: Column) -> Column:
    """The forms in which a name found beside titles may come again, each with these titles."""
    words = name_words(name)
    plain = F.regexp_replace(name, f"^{_TITLES}", "")
    forms = F.array(plain, F.upper(plain), F.element_at(words, -1), F.upper(F.element_at(words, -1)))
    return F.transform(F.array_distinct(forms), lambda form: F.struct(form.alias("form"), titles_of(name).alias("titles")))


def _with_matches(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_pattern`` and ``_found``, the matches of the text in order as ``(kind, mention, titles)``.

    Where names were found the text is searched once more, for their bare forms as well
    (longest first); ``titles`` are those that a bare form was found with.
    """
    body = F.col(text)
    named = F.filter("_matches", lambda m: _is(m, PATTERNS["name"]))
    bare = F.array_sort(F.array_distinct(F.transform("_forms", lambda f: f["form"])), lambda a, b: F.length(b) - F.length(a))
    longer = F.concat(F.lit(ANY + r"|(?<![\p{L}\p{N}])(?:"), F.array_join(bare, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    again = F.size("_forms") > 0
    titles = lambda m: F.get(F.filter("_forms", lambda f: f["form"] == m), F.lit(0))["titles"]
    return (
        df.withColumn("_matches", F.when(body.rlike(HINT), F.regexp_extract_all(body, F.lit(ANY), F.lit(0))))
        .withColumn("_forms", F.coalesce(F.flatten(F.transform(named, _bare_forms)), F.array().cast("array<struct<form:string,titles:string>>")))
        .withColumn("_pattern", F.when(again, longer).otherwise(F.lit(ANY)))
        .withColumn("_matches", F.when(again, F.regexp_extract_all(body, F.col("_pattern"), F.lit(0))).otherwise(F.col("_matches")))
        .withColumn("_found", F.transform("_matches", lambda m: F.struct(kind_of(m).alias("kind"), m.alias("mention"), F.lit("").alias("titles"))))
        .withColumn(
            "_found",
            F.when(
                again,
                F.transform(
                    "_found",
                    lambda m: F.when(
                        (m["kind"] == "name") & ~_is(m["mention"], PATTERNS["name"]), m.withField("titles", F.coalesce(titles(m["mention"]), F.lit("")))
                    ).otherwise(m),
                ),
            ).otherwise(F.col("_found")),
        )
    )


def _entities(found: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and the normalised entities of the rows that have any."""
    mentions = where_computed(found, F.size("_found") > 0).select(*columns, F.explode("_found").alias("m"))
    return mentions.select(*columns, F.explode(entities_of(F.concat("m.titles", "m.mention"), F.col("m.kind"))).alias("e")).select(*columns, "e.*")


def redrawn(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, entity, attempt)`` of those distinct entities whose first surrogate is not usable.

    Of the entities that drew the same surrogate all but one draw again, and so does one
    whose surrogate is itself an entity of the corpus, until no two agree. That ends, as names
    and numbers grow longer with the draws; kinds that cannot grow and are full are an error.
    """
    state = entities.withColumn("attempt", F.lit(0))
    real = entities.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
    same = Window.partitionBy("kind", "surrogate").orderBy("attempt", "entity")
    for _ in range(MOST_DRAWS):
        drawn = state.withColumn("drawn", digest(key, F.col("kind"), F.col("entity"), F.col("attempt")))
        drawn = drawn.withColumn("surrogate", surrogate_of(F.col("kind"), F.col("entity"), F.col("attempt"), F.col("drawn"), key))
        judged = drawn.withColumn("place", F.row_number().over(same)).join(real, ["kind", "surrogate"], "left")
        state = judged.withColumn("bad", (F.col("place") > 1) | F.col("real").isNotNull())
        state = materialize(state.select("kind", "entity", "bad", (F.col("attempt") + F.col("bad").cast("int")).alias("attempt")), "drawn")
        if state.where("bad").isEmpty():
            return state.where("attempt > 0").select("kind", "entity", "attempt")
        state = state.drop("bad")
    full = [r.kind for r in state.where("attempt >= 2").select("kind").distinct().orderBy("kind").collect()]
    raise ValueError(f"no free surrogates are left after {MOST_DRAWS} draws; kinds: {', '.join(full)}")


def pseudonymize(df: DataFrame, key: str, text: str = "text", row: str = "doc_id") -> DataFrame:
    """``df`` with surrogates in ``text``, plus ``entities``: ``(kind, mention, surrogate)`` in text order.

    ``key`` is the caller's secret: equal keys give equal surrogates, and without it none can be
    computed. NULL and empty texts stay as they are, and so does a text without entities, down
    to the byte. ``row`` names the rows that need a second draw; rows that share it, NULL
    included, share their draws, which changes nothing since draws go by entity. Extra columns
    pass through whatever their names; an existing ``entities`` column is replaced.
    """
    out, back = _rewrite(df, key, text, row)
    return out.select(*[c for name, c in back.items() if name != "entities"], "entities")


def pseudonymized(df: DataFrame, key: str, text: str = "text", row: str = "doc_id") -> DataFrame:
    """``df`` with surrogates in ``text`` and its other columns as they were, ``entities`` included."""
    out, back = _rewrite(df, key, text, row)
    return out.select(*back.values())


def _rewrite(df: DataFrame, key: str, text: str, row: str) -> tuple[DataFrame, dict[str, Column]]:
    if not key:
        raise ValueError("surrogates need a key")
    inside, back = shielded(df, text, row)
    found = _with_matches(inside, text)
    distinct = materialize(_entities(found).distinct(), "entities")
    again = materialize(redrawn(distinct, key), "redrawn")
    if again.isEmpty():
        ready = found.withColumn("_attempts", F.create_map().cast("map<string,int>"))
    else:
        # Only rows that hold such an entity get a map of their own.
        named = _entities(found, row).distinct().join(again, ["kind", "entity"])
        maps = named.groupBy(F.col(row).alias("_row")).agg(
            F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "entity"), "attempt"))).alias("_attempts")
        )
        maps = materialize(maps, "attempts")
        ready = found.join(maps, F.col(row).eqNullSafe(F.col("_row")), "left").drop("_row")
        ready = ready.withColumn("_attempts", F.coalesce("_attempts", F.create_map().cast("map<string,int>")))
    found_or_none = F.coalesce("_found", F.array().cast("array<struct<kind:string,mention:string,titles:string>>"))
    whole = F.transform(found_or_none, lambda m: m.withField("whole", F.concat(m["titles"], m["mention"])))
    with_parts = F.transform(whole, lambda m: m.withField("made", with_surrogates(entities_of(m["whole"], m["kind"]), F.col("_attempts"), key)))
    made = F.transform(
        with_parts,
        lambda m: F.struct(
            F.when(m["titles"] == "", m["kind"]).otherwise("mention").alias("kind"),
            m["mention"].alias("mention"),
            F.substr(rewritten(m["kind"], m["whole"], m["made"]), F.length(m["titles"]) + 1, F.lit(1 << 30)).alias("surrogate"),
        ),
    )
    pieces = F.zip_with(F.split(text, F.col("_pattern"), -1), "entities", lambda piece, e: F.concat(piece, F.coalesce(e["surrogate"], F.lit(""))))
    # A column of the caller's named so is shielded by now.
    rewriting = ready.withColumn("entities", made)
    return rewriting.withColumn(text, F.when(F.size("entities") > 0, F.array_join(pieces, "")).otherwise(F.col(text))), back
