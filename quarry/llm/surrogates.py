"""Personal data and secrets replaced by keyed, type-consistent surrogates.

Detected: e-mail addresses, phone, card and social-security
numbers, IBANs, IPv4 addresses, access keys, labelled secrets, long hexadecimal secrets,
and person names behind a title. A name found so is looked for again in its whole text:
in full without a title, and its surname alone, titled or not, which is the same person
(of several of that surname the one of the title's gender, else the first by name).
An entity is what its mentions have in common (a phone number's last ten digits, an
address in lower case, a name with the gender its titles in the text give it), so all
mentions of one entity, in whatever format and document, get the same surrogate, written
in the mention's own format. A surrogate keeps the type (country, network or key prefix, digits for
digits, letters for letters in their script and case, a valid check digit where the
original has one; a name's gender, from its title, and its script).

Surrogates come from SHA-512 of key, type, entity and attempt. A collision check
over all distinct entities gives another attempt to every entity whose surrogate is
some entity itself or is already another's, so distinct entities stay distinct.

Only DataFrame functions are used. Only documents that can hold a mention (a digit, an
@, a label's sign or a title) are searched, only those with one are written and take
part in the join, and the join's rows are the mentions; the others pass through. Entities are counted once before
the join, so one that a third of all documents mention is a single row there. A text is
replaced once, however many documents have it, and meets their rows as a written table.

Defined cases: a null or empty text stays as it is. Repeated rows are treated alike.
Ids are not read. Other columns are carried, whatever their names; one named like
``types_column`` is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import carried, discard, materialise, unused

#: Titles by gender, and given names by gender and script.
TITLES = {"f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Señora", "Sra", "Госпожа"),
          "m": ("Mr", "Herr", "Señor", "Sr", "Господин"), "": ("Dr", "Prof")}
GIVEN = {
    ("f", "latin"): ("Alma", "Clara", "Edith", "Greta", "Ida", "Lena", "Nora", "Vera"),
    ("m", "latin"): ("Anton", "Bruno", "Emil", "Hugo", "Ivo", "Karl", "Oscar", "Rolf"),
    ("", "latin"): ("Robin", "Kim", "Sasha", "Noel", "Eden", "Jules", "Alexis", "Quinn"),
    ("f", "cyrillic"): ("Анна", "Вера", "Дарья", "Зоя", "Инна", "Лидия", "Нина", "Ольга"),
    ("m", "cyrillic"): ("Антон", "Борис", "Глеб", "Егор", "Иван", "Олег", "Павел", "Семён"),
    ("", "cyrillic"): ("Саша", "Женя", "Валя", "Слава", "Шура", "Паша", "Юля", "Миша"),
}
SYLLABLES = {"latin": ("ba", "den", "fel", "gor", "hal", "kin", "lor", "mar", "nes", "pol", "ran", "sto", "tir", "vel", "wen", "zan"),
             "cyrillic": ("ба", "ден", "фел", "гор", "хал", "кин", "лор", "мар", "нес", "пол", "ран", "сто", "тир", "вел", "вен", "зан")}

_NAME = r"\p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+){0,2}"
_ALL_TITLES = "|".join(t for group in TITLES.values() for t in group)
_LABEL = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)"
#: Type -> pattern, in order of precedence; together they are one alternation.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}",
    "secret": rf"(?<={_LABEL}[ ]{{0,2}}[=:][ ]{{0,2}}[\"']?)[A-Za-z0-9+/_\-]{{8,}}",
    "access_key": r"\bAKIA[A-Z0-9]{16}\b",
    "hex": r"\b(?=[0-9a-f]*[0-9])[0-9a-f]{32,}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,4}(?![\d-])"
            r"|(?<![\d-])3[47]\d{2}[ -]?\d{6}[ -]?\d{5}(?![\d-])",
    "phone": r"(?<![\d(])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)",
    "name": rf"(?<=\b(?:{_ALL_TITLES})\.? ){_NAME}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def searched(text: Column) -> Column:
    """Whether a text can hold a mention: every one holds a digit, an @ or AKIA, or
    stands behind the = or : of a label or behind a title. The character class costs a
    fraction of the patterns, and so do the plain searches for titles."""
    title = F.lit(False)
    for t in (t for group in TITLES.values() for t in group):
        title = title | F.contains(text, F.lit(t + " ")) | F.contains(text, F.lit(t + ". "))
    return text.rlike("[0-9@=:]") | F.contains(text, F.lit("AKIA")) | title


def kind(mention: Column) -> Column:
    """The type of a mention that ANY found (labelled secrets by elimination)."""
    out = F.lit("secret")
    for name in reversed([n for n in PATTERNS if n not in ("secret", "name")]):
        bare = PATTERNS[name].replace(r"(?<![\d.])", "").replace(r"(?<![\d-])", "").replace(r"(?<![\d(])", "")
        out = F.when(mention.rlike(f"^(?:{bare})$"), name).otherwise(out)
    return F.when(mention.rlike(rf"^{_NAME}$") & ~mention.rlike("[0-9]") & ~mention.rlike(f"^{PATTERNS['access_key']}$"),
                  "name").otherwise(out)


def entity(mention: Column, type_: Column) -> Column:
    digits = F.regexp_replace(mention, "[^0-9]", "")
    return (F.when(type_ == "phone", F.when(F.length(digits) > 10, F.substring(digits, -10, 10)).otherwise(digits))
            .when(type_.isin("card", "ssn"), digits)
            .when(type_ == "iban", F.replace(mention, F.lit(" "), F.lit("")))
            .when(type_.isin("email", "name"), F.lower(mention)).otherwise(mention))


def _draw(seed: Column, i: Column, n: int) -> Column:
    """A number in [0, n) from a keyed hash of ``seed`` and place ``i``."""
    block = F.sha2(F.concat_ws(":", seed, F.floor((i - 1) / 16).cast("string")), 512)
    return F.pmod(F.conv(F.substr(block, F.pmod(i - 1, F.lit(16)).cast("int") * 8 + 1, F.lit(8)), 16, 10).cast("long"),
                  F.lit(n)).cast("int")


def _each(s: Column, f) -> Column:
    """``f(character, place)`` over a string's characters, joined again."""
    chars = F.filter(F.split(s, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, lambda c, i: f(c, i + 1)), "")


def _pick(values: tuple[str, ...] | str, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), at + 1)


def _shape(s: Column, seed: Column) -> Column:
    """Digits for digits, letters for letters in their case and script."""
    def one(c: Column, i: Column) -> Column:
        def letter(first: str, n: int) -> Column:
            return F.chr(F.lit(ord(first)) + _draw(seed, i, n)) if ord(first) < 128 else _pick(
                [chr(ord(first) + k) for k in range(n)], _draw(seed, i, n))
        return (F.when(c.rlike("[0-9]"), letter("0", 10)).when(c.rlike("[a-z]"), letter("a", 26))
                .when(c.rlike("[A-Z]"), letter("A", 26)).when(c.rlike("[а-яё]"), letter("а", 32))
                .when(c.rlike("[А-ЯЁ]"), letter("А", 32)).otherwise(c))
    return _each(s, one)


def _hex(s: Column, seed: Column) -> Column:
    return _each(s, lambda c, i: F.lower(F.hex(_draw(seed, i, 16).cast("long"))))


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, its last digit undoubled."""
    d = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))
    return F.aggregate(F.transform(d, lambda x, i: F.when(i % 2 == 0, x).otherwise(
        F.when(x > 4, x * 2 - 9).otherwise(x * 2))), F.lit(0), lambda a, x: a + x)


def surrogate(type_: Column, ent: Column, gender: Column, key: str, attempt: Column) -> Column:
    """The surrogate of an entity, in the entity's own (canonical) writing."""
    seed = F.concat_ws("|", F.lit(key), type_, ent, attempt.cast("string"))
    local, domain = F.substring_index(ent, "@", 1), F.substring_index(ent, "@", -1)
    labels = F.split(domain, r"\.")
    top = F.element_at(labels, -1)
    below = F.when(F.size(labels) > 2, F.concat(
        _shape(F.array_join(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), "."),
               F.concat_ws("|", F.lit(key), F.lit("domain"), domain)), F.lit("."))).otherwise("")
    email = F.concat(_shape(local, seed), F.when(attempt > 3, attempt.cast("string")).otherwise(""), F.lit("@"),
                     below, F.lit("example."), F.when(top.isin("com", "net", "org"), top).otherwise("org"))
    octets = F.split(ent, r"\.")
    private = ent.rlike(r"^(?:10|127)\.|^192\.168\.|^172\.(?:1[6-9]|2\d|3[01])\.")
    ip = F.array_join(F.transform(octets, lambda o, i: F.when(
        private & (i < 2), o).otherwise((_draw(seed, i + 1, 223) + 1).cast("string"))), ".")
    digits = _each(ent, lambda c, i: _draw(seed, i, 10).cast("string"))
    card0 = F.concat(F.substring(ent, 1, 1), F.substr(digits, F.lit(2), F.length(ent) - 2))
    check = F.pmod(F.lit(10) - F.pmod(_luhn_sum(F.concat(card0, F.lit("0"))), F.lit(10)), F.lit(10))
    card = F.concat(card0, F.when(F.pmod(_luhn_sum(ent), F.lit(10)) == 0, check.cast("string"))
                    .otherwise(F.substring(digits, -1, 1)))
    ten = F.concat((_draw(seed, F.lit(60), 8) + 2).cast("string"), F.substring(digits, 2, 2),
                   F.when(F.substring(ent, 4, 3) == "555", "555").otherwise(
                       F.concat((_draw(seed, F.lit(61), 8) + 2).cast("string"), F.substring(digits, 5, 2))),
                   F.substring(digits, 7, 4))
    phone = F.when(F.length(ent) == 10, ten).otherwise(digits)
    script = F.when(ent.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    given, sur = None, None
    for (g, s), names in GIVEN.items():
        case = (gender == g) & (script == s)
        given = F.when(case, _pick(names, _draw(seed, F.lit(1), len(names)))) if given is None else given.when(
            case, _pick(names, _draw(seed, F.lit(1), len(names))))
    for s, parts in SYLLABLES.items():
        built = F.initcap(F.array_join(F.transform(F.sequence(F.lit(2), F.lit(4) + attempt), lambda i: _pick(
            parts, _draw(seed, i, len(parts)))), ""))
        sur = F.when(script == s, built) if sur is None else sur.when(script == s, built)
    name = F.when(F.instr(ent, " ") > 0, F.concat_ws(" ", given, sur)).otherwise(sur)
    hexed = ent.rlike("^[0-9a-f]+$")
    return (F.when(type_ == "email", email).when(type_ == "ip", ip).when(type_ == "card", card)
            .when(type_ == "phone", phone).when(type_ == "ssn", digits).when(type_ == "name", name)
            .when(type_ == "access_key", F.concat(F.lit("AKIA"), _shape(F.substr(ent, F.lit(5)), seed)))
            .when(type_ == "iban", F.concat(F.substring(ent, 1, 2), _shape(F.substr(ent, F.lit(3)), seed)))
            .when(hexed, _hex(ent, seed)).otherwise(_shape(ent, seed)))


def written_as(mention: Column, type_: Column, new: Column) -> Column:
    """The surrogate in the mention's format: its separators, leading digits and case."""
    count = F.length(F.regexp_replace(mention, "[^0-9]", "")) - F.length(new)

    def digit(c: Column, i: Column) -> Column:
        at = F.length(F.regexp_replace(F.substr(mention, F.lit(1), i), "[^0-9]", "")) - count
        return F.when(c.rlike("[0-9]") & (at >= 1), F.substr(new, at, F.lit(1))).otherwise(c)

    spaced = _each(mention, lambda c, i: F.when(c == " ", c).otherwise(F.substr(
        new, i - (i - F.length(F.replace(F.substr(mention, F.lit(1), i), F.lit(" "), F.lit("")))), F.lit(1))))
    shout = (mention == F.upper(mention)) & (mention != F.lower(mention))
    return (F.when(type_.isin("phone", "card", "ssn"), _each(mention, digit))
            .when(type_ == "iban", spaced)
            .when(type_.isin("email", "name") & shout, F.upper(new)).otherwise(new))


def gender_of(text: Column, mention: Column) -> Column:
    """Gender of the titles before a name's mentions in its text ('' without any; of
    both, that of the first mention)."""
    out = F.lit("")
    before = F.substr(text, F.lit(1), F.instr(text, mention) - 1)
    for g in ("f", "m"):
        titled = F.concat(F.lit(rf"\b(?:{'|'.join(TITLES[g])})\.? \Q"), mention, F.lit(r"\E(?![\p{L}\p{N}])"))
        out = F.when(F.regexp_count(text, titled) > 0, g).otherwise(out)
    for g in ("f", "m"):
        out = F.when(before.rlike(rf"\b(?:{'|'.join(TITLES[g])})\.? $"), g).otherwise(out)
    return out


def surname(name: Column) -> Column:
    return F.substring_index(name, " ", -1)


def is_name(mention: Column) -> Column:
    return kind(mention) == "name"


def known_names(mentions: Column) -> Column:
    """The full names among a text's mentions, each once and in order."""
    return F.array_sort(F.array_distinct(F.filter(mentions, lambda m: F.contains(m, F.lit(" ")) & is_name(m))))


def with_known(names: Column) -> Column:
    """The pattern of all mentions in a text that has ``names``: theirs in full and their
    surnames too, also in capitals, as whole words and longer ones first."""
    def quoted(xs: Column) -> Column:
        return F.array_join(F.transform(F.array_distinct(F.concat(xs, F.transform(xs, F.upper))),
                                        lambda x: F.concat(F.lit(r"\Q"), x, F.lit(r"\E"))), "|")
    more = F.concat(F.lit(ANY + r"|(?<![\p{L}\p{N}])(?:"), quoted(names), F.lit("|"), quoted(F.transform(names, surname)),
                    F.lit(r")(?![\p{L}\p{N}])"))
    return F.when(F.size(names) > 0, more).otherwise(F.lit(ANY))


def assign(entities: DataFrame, key: str, max_attempts: int = 50) -> DataFrame:
    """(type, entity, gender) with ``surrogate``: distinct, and none an entity.

    Every round settles, of the entities still open, the smallest one of each
    surrogate that is neither an entity nor already given; the others try again. What a
    round draws is written first: the drawing is a large expression, which the driver then
    plans once, not on both sides of a join and again as each of its shuffles ends.
    """
    who = ["type", "entity", "gender"]
    originals = entities.select("type", F.col("entity").alias("surrogate"))
    left, done = entities, None
    for attempt in range(max_attempts):
        tried = materialise(left.withColumn("surrogate", surrogate(F.col("type"), F.col("entity"), F.col("gender"), key, F.lit(attempt))),
                            "tried")
        taken = originals if done is None else originals.union(done.select("type", "surrogate"))
        first = tried.groupBy("type", "surrogate").agg(F.min(F.struct("entity", "gender")).alias("winner"))
        free = first.join(taken, ["type", "surrogate"], "left_anti")
        won = tried.join(free, ["type", "surrogate"]).where("entity = winner.entity and gender = winner.gender")
        settled = won.select(*who, "surrogate")
        before, done = done, materialise(settled if done is None else done.union(settled), "surrogates")
        discard(entities.sparkSession, tried, *([] if before is None else [before]))
        left = entities.join(done, who, "left_anti")
        if left.isEmpty():
            return done
    raise RuntimeError(f"entities without a free surrogate after {max_attempts} attempts")


def replace_entities(docs: DataFrame, *, text: str = "text", key: str = "quarry-surrogates",
                     types_column: str | None = None, check_digit: bool = False) -> DataFrame:
    """``docs`` with its text's mentions replaced; with ``types_column`` also the
    types of the mentions in order (empty without any). With ``check_digit`` a number is a
    card only if its check digit is right; other numbers of its form stay."""
    body = F.col(text)
    mentions = F.when(searched(body), F.regexp_extract_all(body, F.lit(ANY), F.lit(0)))
    # The other columns travel in one struct, so no name of theirs can clash.
    others = [c for c in carried(docs, None, [], [types_column]) if c != text]
    rows = materialise(docs.select(F.struct(*others, F.lit(0).alias(unused(docs, "_"))).alias("row"), body.alias("body"), mentions.alias("mentions")),
                       "searched")
    plain = rows.where(F.coalesce(F.size("mentions"), F.lit(0)) <= 0)
    hit = rows.where(F.size("mentions") > 0).withColumn("rid", F.sha2("body", 256))
    # Each text once: combined where it is read, so a text of a third of all rows is one row.
    texts = hit.groupBy("rid").agg(F.first("body").alias("body"), F.first("mentions").alias("mentions"))
    texts = texts.withColumn("names", known_names(F.col("mentions"))).withColumn("pattern", with_known(F.col("names")))
    texts = materialise(texts.withColumn("mentions", F.when(F.size("names") > 0, F.regexp_extract_all("body", F.col("pattern"), F.lit(0)))
                                         .otherwise(F.col("mentions"))), "texts")
    each = (texts.select("rid", "body", "names", F.explode(F.array_distinct("mentions")).alias("mention"))
            .withColumn("type", kind(F.col("mention"))))
    if check_digit:
        each = each.where((F.col("type") != "card") | (F.pmod(_luhn_sum(F.regexp_replace("mention", "[^0-9]", "")), F.lit(10)) == 0))
    named_ = F.col("type") == "name"
    each = each.withColumn("gender", F.when(named_, gender_of(F.col("body"), F.col("mention"))).otherwise(""))
    # A surname alone is the person of that surname in the text.
    bearers = F.filter("names", lambda n: F.lower(surname(n)) == F.lower("mention"))
    each = each.withColumn("full", F.when(named_ & ~F.contains("mention", F.lit(" ")) & (F.size(bearers) > 0), F.coalesce(
        F.get(F.filter(bearers, lambda n: (F.col("gender") != "") & (gender_of(F.col("body"), n) == F.col("gender"))), 0), F.get(bearers, 0))))
    each = each.withColumn("alone", F.col("full").isNotNull()).withColumn("entity", F.coalesce(
        F.lower("full"), entity(F.col("mention"), F.col("type")))).select("rid", "mention", "type", "entity", "gender", "alone")
    each = materialise(each, "mentions")
    # One gender a person and text: of the mentions in full, else of the others.
    settled = each.where(named_).groupBy("rid", "entity").agg(F.max(F.struct(
        (~F.col("alone") & (F.col("gender") != "")).alias("full"), "gender")).alias("g")).select("rid", "entity", F.col("g.gender").alias("settled"))
    each = each.join(settled.withColumn("type", F.lit("name")), ["rid", "type", "entity"], "left").withColumn(
        "gender", F.coalesce("settled", F.lit(""))).drop("settled")
    each = materialise(each, "mentions")
    entities = materialise(each.select("type", "entity", "gender").distinct(), "entities")
    named = assign(entities, key)
    discard(docs.sparkSession, entities)
    whole = F.when(F.col("alone"), surname(F.col("surrogate"))).otherwise(F.col("surrogate"))
    new = written_as(F.col("mention"), F.col("type"), whole)
    maps = (each.join(named, ["type", "entity", "gender"]).select("rid", F.struct("mention", new.alias("new")).alias("pair"))
            .groupBy("rid").agg(F.map_from_entries(F.array_distinct(F.collect_list("pair"))).alias("news")))
    joined = texts.join(maps, "rid")
    parts = F.when(F.size("names") > 0, F.split("body", F.col("pattern"), -1)).otherwise(F.split("body", ANY, -1))
    replaced = F.array_join(F.flatten(F.zip_with(parts, F.transform("mentions", lambda m: F.coalesce(F.try_element_at(F.col("news"), m), m)),
                                                 lambda p, m: F.array(p, F.coalesce(m, F.lit(""))))), "")
    types = F.transform(F.filter("mentions", lambda m: F.map_contains_key("news", m)), kind)
    made = materialise(joined.select("rid", replaced.alias("new_body"), types.alias("types")), "replaced")
    none = F.array().cast("array<string>")
    # Two plain tables, so a text that most rows have is split. A text without an entity
    # (its only mention a wrong card number) is not in ``made``.
    changed = hit.join(made, "rid", "left").select("row", F.coalesce("new_body", "body").alias("new_body"), F.coalesce("types", none).alias("types"))
    same = plain.select("row", F.col("body").alias("new_body"), none.alias("types"))
    out = [F.col("new_body").alias(c) if c == text else F.col("row")[c].alias(c) for c in carried(docs, None, [], [types_column])]
    tail = [F.col("types").alias(types_column)] if types_column else []
    return changed.unionByName(same).select(*out, *tail)
