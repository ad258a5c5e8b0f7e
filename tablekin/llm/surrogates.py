"""Replacing personal data by keyed surrogates of the same type and form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekin.llm.common import stage_packed

# What the types of personal data look like.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
# A key in any case, perhaps quoted, = or : with spaces, then a quoted value or, also behind an open quote, one up to a space, quote or bracket.
SECRET_HEAD = (
    r"(?i:password|passwd|passphrase|pwd|secret|token|(?:api|access|private|secret)[_-]?key)"
    r"(?:\\?[\"'])?\h*+(?:={1,3}+>?|:)\h*+(?:\\?[\"'])?"
)
_FREE = r"\s\"'`,;<>(){}\[\]|&\\"
SECRET = (
    SECRET_HEAD + r"(?:(?<=\")(?=[^\"\n]*[\p{L}\p{N}])[^\"\n]++\"|(?<=')(?=[^'\n]*[\p{L}\p{N}])[^'\n]++'"
    rf"|(?=[^{_FREE}]*[\p{{L}}\p{{N}}])[^{_FREE}]+(?<![.!?:])(?:&(?!\w+=)[^{_FREE}]+(?<![.!?:])){{0,64}})"
)
ADDRESS = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
CARD = r"(?<![\d-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\d-])"
PHONE = r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\d)"
SOCIAL = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
NAME = r"(?<!\p{L})(?:Mr|Mrs|Ms|Herr|Frau|Señora?|Monsieur|Madame|Господин|Госпожа)\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?"
PATTERN = "|".join((EMAIL, SECRET, ADDRESS, SOCIAL, CARD, PHONE, NAME))
# Given names by script and gender, syllables of family names by script.
GIVEN = {
    ("latin", "f"): "Anna Clara Elena Emma Ida Julia Laura Lena Maria Nora Olivia Paula Rosa Sara Sofia Vera",
    ("latin", "m"): "Adam Anton David Emil Felix Hugo Jonas Leo Lukas Marco Martin Oscar Pablo Simon Tomas Victor",
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Ксения Лидия Мария Нина Ольга Полина Раиса София Тамара Ульяна Юлия",
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Максим Никита Олег Павел Роман Семён",
}
SYLLABLES = {"latin": "ba de fi go hu ka le mi no pu ra se ti vo wa zu", "cyrillic": "ба де фи го ху ка ле ми но пу ра се ти во ва зу"}
ROUNDS = 6


def kind_of(entity: Column) -> Column:
    # A secret may hold an @, a mail address neither = nor :.
    kinds = (("address", ADDRESS), ("social", SOCIAL), ("phone", PHONE), ("card", CARD))
    kind = F.when(F.rlike(entity, F.lit(f"^(?:{SECRET})$")), "secret").when(F.contains(entity, F.lit("@")), "email")
    for name, pattern in kinds:
        kind = kind.when(F.rlike(entity, F.lit(f"^(?:{pattern})$")), name)
    return kind.otherwise("name")


def _digest(key: str, kind: Column, value: Column, attempt: Column, part: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(f"{key}|{part}"), kind, value, attempt.cast("string")).cast("binary"), 256)


def _in_form(text: Column, digest: Column, digit: str = "[0-9]", small: str = "[a-z]", capital: str = "[A-Z]") -> Column:
    """``text`` with every digit, small and capital letter (of these classes) replaced by an ASCII one; the rest stays."""

    def one(char: Column, place: Column) -> Column:
        pair = F.conv(F.substring(F.repeat(digest, F.lit(1) + F.floor(place / 32).cast("int")), place * 2 + 1, F.lit(2)), 16, 10).cast("int")
        return (
            F.when(F.rlike(char, F.lit(digit)), (pair % 10).cast("string"))
            .when(F.rlike(char, F.lit(small)), F.char(F.lit(97) + pair % 26))
            .when(F.rlike(char, F.lit(capital)), F.char(F.lit(65) + pair % 26))
            .otherwise(char)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _nibble(digest: Column, place: int) -> Column:
    return F.conv(F.substring(digest, place, 1), 16, 10).cast("int")


def _names(entity: Column, digest: Column) -> Column:
    title = F.regexp_extract(entity, r"^(\S+)", 1)
    script = F.when(F.rlike(entity, F.lit(r"\p{IsCyrillic}")), "cyrillic").otherwise("latin")
    gender = F.when(F.rlike(title, F.lit("^(?:Mrs|Ms|Frau|Señora|Madame|Госпожа)")), "f").otherwise("m")
    given, family = F.lit(None).cast("string"), F.lit(None).cast("string")
    for (s, g), names in GIVEN.items():
        chosen = F.element_at(F.array(*[F.lit(n) for n in names.split()]), _nibble(digest, 1) + 1)
        given = F.when((script == s) & (gender == g), chosen).otherwise(given)
    for s, syllables in SYLLABLES.items():
        parts = F.array(*[F.lit(x) for x in syllables.split()])
        made = F.initcap(F.concat(*[F.element_at(parts, _nibble(digest, k) + 1) for k in range(2, 7)]))
        family = F.when(script == s, made).otherwise(family)
    one_name = F.size(F.split(entity, " ")) <= 2
    return F.concat_ws(" ", title, F.when(one_name, family).otherwise(F.concat_ws(" ", given, family)))


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """A keyed stand-in of the same type: separators, lengths, capitals, country code, issuer, title and script stay.

    Equal mail domains get equal stand-ins, and the last label stays.  A secret is its value alone, without key and quotes.
    """
    digest = _digest(key, kind, value, attempt, "entity")
    at = F.instr(value, "@")
    domain = F.substr(value, at + 1)
    last = F.regexp_extract(domain, r"(\.[^.]*)$", 1)
    host = F.substr(domain, F.lit(1), F.length(domain) - F.length(last))
    no_attempt = F.lit(0)
    email = F.concat(
        _in_form(F.substr(value, F.lit(1), at - 1), digest), F.lit("@"), _in_form(host, _digest(key, kind, domain, no_attempt, "domain")), last
    )
    secret = _in_form(value, digest, r"\p{N}", r"[\p{L}&&[^\p{Lu}]]", r"\p{Lu}")
    octets = [(F.conv(F.substring(digest, 2 * k + 1, 2), 16, 10)).cast("string") for k in range(4)]
    code = F.regexp_extract(value, r"^(\+\d{1,3}[ .(-]*)", 1)
    phone = F.concat(code, _in_form(F.substr(value, F.length(code) + 1), digest))
    card = F.concat(F.substr(value, F.lit(1), F.lit(1)), _in_form(F.substr(value, F.lit(2)), digest))
    return (
        F.when(kind == "email", email)
        .when(kind == "secret", secret)
        .when(kind == "address", F.concat_ws(".", *octets))
        .when(kind == "phone", phone)
        .when(kind == "card", card)
        .when(kind == "social", _in_form(value, digest))
        .otherwise(_names(value, digest))
    )


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, stand_in) for the distinct ``entities`` (kind, value).

    A stand-in that equals another one's, or an original value, is drawn again for all
    but one of its values; what is left after ``ROUNDS`` draws (a type with few forms)
    gets a number behind it, so that distinct values stay distinct.
    """
    values = stage_packed(entities.select("kind", "value").distinct(), "surrogate-values")
    attempt = F.lit(0)
    table = values.withColumn("attempt", attempt).withColumn("stand_in", surrogate(key, F.col("kind"), F.col("value"), F.col("attempt")))
    originals = values.select(F.col("kind").alias("o_kind"), F.col("value").alias("o_value"))
    for round_ in range(ROUNDS):
        table = stage_packed(table, "surrogates")
        taken = table.groupBy("kind", "stand_in").agg(F.count("*").alias("holders"), F.min("value").alias("first"))
        taken = taken.join(originals, (F.col("kind") == F.col("o_kind")) & (F.col("stand_in") == F.col("o_value")), "left")
        bad = taken.where("holders > 1 OR o_value IS NOT NULL").select(
            F.col("kind").alias("b_kind"), F.col("stand_in").alias("b_stand_in"), "first", "o_value"
        )
        if bad.isEmpty():
            return table.select("kind", "value", "stand_in")
        same = (F.col("kind") == F.col("b_kind")) & (F.col("stand_in") == F.col("b_stand_in"))
        table = table.join(bad, same, "left")
        again = F.col("b_kind").isNotNull() & (F.col("o_value").isNotNull() | (F.col("value") != F.col("first")))
        if round_ == ROUNDS - 1:
            tagged = F.concat("stand_in", F.lit("-"), F.substring(F.md5(F.col("value").cast("binary")), 1, 12))
            table = table.withColumn("stand_in", F.when(again, tagged).otherwise(F.col("stand_in")))
        else:
            table = table.withColumn("attempt", F.col("attempt") + again.cast("int"))
            drawn = surrogate(key, F.col("kind"), F.col("value"), F.col("attempt"))
            table = table.withColumn("stand_in", F.when(again, drawn).otherwise(F.col("stand_in")))
        table = table.select("kind", "value", "attempt", "stand_in")
    return table.select("kind", "value", "stand_in")


def replace_personal(docs: DataFrame, key: str = "surrogate") -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with personal data replaced: doc_id, text, n_entities, kinds.

    The same value gets the same stand-in everywhere (``key`` decides which), a secret's
    behind any key and in any quotes, which stay with the separator.  ``kinds``
    lists the types found, in order of place, comma separated.  Texts without personal
    data, empty and null texts come back as they are.  Repeated rows are treated alike;
    an empty table gives no rows.  Only the rows with findings are joined, by id and
    digest of the text.
    """
    text = F.col("text")
    rows = docs.select("doc_id", text, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)).alias("found"))
    holding = rows.where(F.size("found") > 0).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.md5(text.cast("binary")).alias("digest"), "found"
    )
    holding = stage_packed(holding.distinct(), "surrogate-found")
    places = holding.select("id", "digest", F.posexplode("found").alias("place", "entity"))
    places = places.withColumn("kind", kind_of(F.col("entity")))
    secret = F.col("kind") == "secret"
    places = places.withColumn("head", F.when(secret, F.regexp_extract("entity", f"^{SECRET_HEAD}", 0)).otherwise(""))
    places = places.withColumn("tail", F.when(secret, F.regexp_extract("entity", r"\\?[\"']$", 0)).otherwise(""))
    bare = F.substr("entity", F.length("head") + 1, F.length("entity") - F.length("head") - F.length("tail"))
    places = places.withColumn("value", bare)
    table = surrogate_table(places, key).withColumnRenamed("stand_in", "new_value")
    placed = places.join(table, ["kind", "value"]).withColumn("stand_in", F.concat("head", "new_value", "tail")).groupBy("id", "digest")
    placed = placed.agg(F.array_sort(F.collect_list(F.struct("place", "kind", "stand_in"))).alias("placed"))
    side = docs.select(
        "doc_id", text, F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.md5(text.cast("binary")).alias("_digest")
    )
    joined = side.join(placed, (F.col("_id") == F.col("id")) & (F.col("_digest") == F.col("digest")), "left")
    gaps = F.split(text, PATTERN, -1)
    stand_ins = F.transform("placed", lambda p: p["stand_in"])
    mixed = F.zip_with(gaps, stand_ins, lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))))
    return joined.select(
        "doc_id",
        F.when(F.col("placed").isNull(), text).otherwise(F.array_join(mixed, "")).alias("text"),
        F.coalesce(F.size("placed"), F.lit(0)).cast("long").alias("n_entities"),
        F.coalesce(F.array_join(F.transform("placed", lambda p: p["kind"]), ","), F.lit("")).alias("kinds"),
    )
