"""Surrogates for personal data.

Entities are found by pattern, and each is replaced by one of its own kind: a hash with a
secret key gives the letters and digits, the original gives length, punctuation, case,
script and, for people, title and gender. The same entity gets the same surrogate in all
documents, however it is written. The names of a person whom a text calls by a title are
replaced wherever else the text has them. A check over the distinct entities of the whole table
finds surrogates that two entities share, or that are entities of the table themselves;
all but one are drawn again until none is left. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.llm.tables import kept_table

# Titles by gender.
WOMEN_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "Госпожа")
MEN_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Господин")
ANY_TITLES = ("Dr", "Prof", "Professor", "Доктор", "Профессор")

_TITLE = r"(?:" + "|".join((*WOMEN_TITLES, *MEN_TITLES, *ANY_TITLES)) + r")\.?"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_NOT_IN_WORD, _WORD_OVER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"

# Runs that have no longest length are possessive, which keeps matching linear; a host has 127
# labels of 63 at most.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]{1,63}\.){1,126}\p{L}{2,24}" + _WORD_OVER
IP = r"(?<![\p{L}0-9.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?![\p{L}0-9]|\.[0-9])"
SECRET = (
    _NOT_IN_WORD
    + r"(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|AKIA[0-9A-Z]{16}|(?:ghp|gho|ghs|sk|pk)[_-][A-Za-z0-9]{20,}+)"
    + _WORD_OVER
)
IBAN = _NOT_IN_WORD + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _WORD_OVER
SSN = r"(?<![\p{L}0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}0-9-])"
CARD = r"(?<![\p{L}0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}(?![\p{L}0-9])"
PHONE = (
    r"(?<![\p{L}0-9+])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![\p{L}0-9])"
)
PERSON = _NOT_IN_WORD + _TITLE + r" \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?" + _WORD_OVER
#: The kinds, in the order in which a place of the text is tried.
KINDS = {"email": EMAIL, "ip": IP, "secret": SECRET, "iban": IBAN, "ssn": SSN, "card": CARD, "phone": PHONE, "person": PERSON}
ENTITY = "|".join(KINDS.values())
#: A word or what is between two, of which a text consists.
TOKEN = r"([\p{L}\p{M}\p{N}]++|[^\p{L}\p{M}\p{N}]++)"
#: Texts without a match of this have no entity.
HINT = r"[0-9@]|AKIA|gh[pos]_|[sp]k[_-]|" + _TITLE + " "

_LATIN, _CYRILLIC, _GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω"
# Draws beyond this one may leave the original's format: it can have fewer values than entities.
FORMAT_DRAWS = 8


def _hex(hash_: Column, at: Column | int, digits: int = 2) -> Column:
    """Some hex digits of a hash as a number, from a place that wraps around."""
    place = (F.lit(at) if isinstance(at, int) else at) % (64 - digits) + 1
    return F.conv(F.substring(hash_, place, F.lit(digits)), 16, 10).cast("int")


def _letter(alphabet: str, hash_: Column, at: Column) -> Column:
    return F.substring(F.lit(alphabet), _hex(hash_, at) % len(alphabet) + 1, F.lit(1))


def _like(char: Column, hash_: Column, at: Column, hexadecimal: Column, capitals: Column) -> Column:
    """A character of the same kind: a hex digit, a digit, or a letter of the same script and case."""
    low = F.lower(char)
    new = (
        F.when(hexadecimal, F.when(capitals, F.upper(F.substring(hash_, at % 64 + 1, F.lit(1)))).otherwise(F.substring(hash_, at % 64 + 1, F.lit(1))))
        .when(char.rlike(r"^\p{N}$"), (_hex(hash_, at) % 10).cast("string"))
        .when(char.rlike(r"^\p{IsCyrillic}$"), _letter(_CYRILLIC, hash_, at))
        .when(char.rlike(r"^\p{IsGreek}$"), _letter(_GREEK, hash_, at))
        .otherwise(_letter(_LATIN, hash_, at))
    )
    return F.when(~char.rlike(r"^[\p{L}\p{N}]$"), char).when((low != char) & ~hexadecimal, F.upper(new)).otherwise(new)


def _name(hash_: Column, kind: Column, like: Column) -> Column:
    """A name of syllables, in the script of the original; a given name with its gender's ending."""

    def syllables(consonants: str, vowels: str, woman: str, man: str) -> Column:
        parts = [_letter(a, hash_, F.lit(3 * i)) for i, a in enumerate((consonants, vowels, consonants, vowels, consonants, vowels))]
        end = F.when(kind == "given woman", F.lit(woman)).when(kind == "given man", F.lit(man)).otherwise(
            F.concat(_letter(consonants, hash_, F.lit(20)), _letter(vowels, hash_, F.lit(23)))
        )
        return F.concat(*parts, end)

    return F.initcap(
        F.when(like.rlike(r"^\p{IsCyrillic}"), syllables("бвгдзклмнпрст", "аеиоу", "на", "слав"))
        .when(like.rlike(r"^\p{IsGreek}"), syllables("βγδζκλμνπρστ", "αεηιο", "να", "νος"))
        .otherwise(syllables("bdfghjklmnprstvwz", "aeiou", "lina", "mund"))
    )


def kind_of(entity: Column) -> Column:
    kind = None
    for name, pattern in KINDS.items():
        whole = entity.rlike(f"^(?:{pattern})$")
        kind = F.when(whole, F.lit(name)) if kind is None else kind.when(whole, F.lit(name))
    return kind


def _bare(entity: Column) -> Column:
    """What two spellings of one number share: its letters and digits, in lower case."""
    return F.lower(F.regexp_replace(entity, r"[^\p{L}\p{N}]", ""))


def atoms(entity: Column) -> Column:
    """The parts of an entity that are replaced, as an array of structs: kind, canon, part.

    Most entities are one part. A person is a title, which stays, a given name if there
    are two names, and a surname. canon is what all spellings of a part share.
    """
    kind = kind_of(entity)
    names = F.split(F.regexp_replace(entity, f"^{_TITLE} ", ""), " ")
    titled = lambda titles: entity.rlike("^(?:" + "|".join(titles) + r")\.? ")
    gender = F.when(titled(WOMEN_TITLES), "given woman").when(titled(MEN_TITLES), "given man").otherwise("given")

    def named(part: Column, place: Column) -> Column:
        last = place == F.size(names) - 1
        return F.struct(F.when(last, "surname").otherwise(gender).alias("kind"), F.lower(part).alias("canon"), part.alias("part"))

    canon = F.when(kind.isin("email", "ip"), F.lower(entity)).otherwise(_bare(entity))
    whole = F.struct(kind.alias("kind"), canon.alias("canon"), entity.alias("part"))
    return F.when(kind == "person", F.transform(names, named)).otherwise(F.array(whole))


def drawn(atom: Column, draw: Column, key: str) -> Column:
    """atom (kind, canon, part) as a struct with hash: 64 hex digits of this draw."""
    secret = F.concat_ws("\u0001", F.lit(key), atom["kind"], atom["canon"], draw.cast("string"))
    return F.struct(
        atom["kind"].alias("kind"), atom["canon"].alias("canon"), atom["part"].alias("part"), draw.alias("draw"), F.sha2(secret, 256).alias("hash")
    )


def surrogate(x: Column, key: str) -> Column:
    """What replaces the part of a drawn atom."""
    kind, part, hash_ = x["kind"], x["part"], x["hash"]
    # The letters and digits of numbers are counted without punctuation, so that two
    # spellings of a number get the same ones. A phone's country code and an IBAN's stay.
    stay = (
        F.when(kind == "phone", F.length(F.regexp_extract(part, r"^\+([0-9]{1,3})(?=[ .(-])", 1)))
        .when(kind == "iban", F.lit(2))
        .when((kind == "secret") & part.rlike(r"^(AKIA|[a-z]+[_-])"), F.length(F.regexp_extract(part, r"^(AKIA|[a-z]+)", 1)))
        .otherwise(F.lit(0))
    )
    capitals = part.rlike("[A-Z]")
    hexadecimal = (kind == "secret") & part.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$")

    def spelled(text: Column) -> Column:
        chars = F.split(text, "")

        def each(char: Column, place: Column) -> Column:
            at = F.length(_bare(F.substring(text, F.lit(1), place)))
            return F.when(at < stay, char).otherwise(_like(char, hash_, at, hexadecimal, capitals))

        return F.array_join(F.transform(chars, each), "")

    domain = F.lower(F.substring_index(part, "@", -1))
    ending = F.regexp_extract(domain, r"\.(com|org|net)$", 1)
    host = F.concat(
        F.lit("d"),
        F.substring(F.sha2(F.concat_ws("\u0001", F.lit(key), F.lit("domain"), domain), 256), 1, 10),
        F.lit(".example."),
        F.when(ending == "", "com").otherwise(ending),
    )
    local = F.substring_index(part, "@", 1)
    upper = (F.upper(part) == part) & (F.lower(part) != part)
    octets = F.concat_ws(".", *[(_hex(hash_, 4 * i) % 254 + 1).cast("string") for i in range(4)])
    new = (
        F.when(kind == "email", F.concat(spelled(local), F.lit("@"), F.when(upper, F.upper(host)).otherwise(host)))
        .when(kind == "ip", octets)
        .when(kind.startswith("given") | (kind == "surname"), _name(hash_, kind, part))
        .otherwise(spelled(part))
    )
    return F.when(x["draw"] < FORMAT_DRAWS, new).otherwise(F.concat(new, F.lit("-"), F.substring(hash_, 1, 12)))


def entities(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(f"({ENTITY})"))
    return F.when(text.rlike(HINT), found).otherwise(F.array().cast("array<string>"))


def redraws(documents: DataFrame, key: str, draw: Callable[[Column], Column] | None = None) -> DataFrame:
    """kind, canon and draw of the entities whose first surrogate is not theirs alone.

    An entity's draw goes up by one as long as another entity with a lower draw, or the
    same and a lower canon, has its surrogate, or its surrogate is an entity of the table,
    itself included. Distinct entities are found with partial aggregation, so one that a
    third of all documents hold is a row a task.
    """
    draw = draw or (lambda x: surrogate(x, key))
    found = documents.select(F.explode(entities(F.col("text"))).alias("entity")).distinct()
    state = kept_table(
        found.select(F.explode(atoms(F.col("entity"))).alias("a"))
        .groupBy("a.kind", "a.canon")
        .agg(F.min("a.part").alias("part"))
        .withColumn("draw", F.lit(0)),
        "entities",
        light=True,
    )
    group = F.when(F.col("kind").startswith("given"), "given").otherwise(F.col("kind"))
    originals = state.select(group.alias("of"), F.col("canon").alias("own")).distinct()
    while True:
        x = drawn(F.struct("kind", "canon", "part"), F.col("draw"), key)
        new = state.withColumn("x", F.array(x)).withColumn("new", F.transform("x", lambda a: draw(a))[0]).drop("x")
        spelled = F.when(F.col("kind").isin("email", "ip"), F.lower("new")).otherwise(_bare(F.col("new")))
        new = kept_table(new.withColumns({"of": group, "own": spelled}), "draws", light=True)
        first = new.groupBy("of", "own").agg(F.min(F.struct("draw", "kind", "canon")).alias("first"))
        judged = new.join(first, ["of", "own"]).join(originals.withColumn("real", F.lit(True)), ["of", "own"], "left")
        lost = (F.col("first.canon") != F.col("canon")) | (F.col("first.kind") != F.col("kind")) | F.col("real").isNotNull()
        state = kept_table(
            judged.select("kind", "canon", "part", (F.col("draw") + lost.cast("int")).alias("draw"), lost.alias("lost")), "judged", light=True
        )
        if state.where("lost").isEmpty():
            return state.where("draw > 0").select("kind", "canon", "draw")
        state = state.drop("lost")


def people(atoms_: Column) -> Column:
    """Of the drawn atoms of a text's entities, the names of people: canon, rank and the atom,
    in order. A name that is of more kinds ranks as a surname first, then by its gender."""
    named = F.filter(F.flatten(atoms_), lambda a: (a["kind"] == "surname") | a["kind"].startswith("given"))
    rank = lambda a: F.when(a["kind"] == "surname", 0).when(a["kind"] != "given", 1).otherwise(2)
    return F.array_sort(
        F.array_distinct(F.transform(named, lambda a: F.struct(a["canon"].alias("canon"), rank(a).alias("rank"), a.alias("atom"))))
    )


def mention(token: Column, names: Column) -> Column:
    """What replaces a word that is a person's name: capital letters stay, null if it is none."""
    new = F.when(token.rlike(r"^\p{Lu}"), F.try_element_at(names, F.lower(token)))
    return F.when((F.upper(token) == token) & (F.length(token) > 1), F.upper(new)).otherwise(new)


def pseudonymised(documents: DataFrame, key: str) -> DataFrame:
    """documents with surrogates in text, and n_replaced, the places replaced in it.

    Kinds: email, IP address, secret (hex and known prefixes), IBAN, social security
    number, card number, phone number, and people named after a title. Their names get the
    same surrogates wherever else the same text has them as words with a capital letter; a
    person whom a text never gives a title is not known. A null text stays null with 0
    replaced; empty text and text without entities is unchanged. Repeated rows get equal
    texts. Other columns, whatever their names, are carried along; n_replaced is replaced.
    An empty table gives one. Given the same table and key, reruns agree; another key gives
    other surrogates.
    """
    carried = [c for c in documents.columns if c.lower() != "n_replaced"]
    text = next(c for c in carried if c.lower() == "text")
    # The other columns travel in a struct by their place, so that none has a name in use here.
    kept = {c: f"c{i}" for i, c in enumerate(carried) if c != text}
    row = F.struct(F.lit(0).alias("c"), *[F.col(f"`{c}`").alias(name) for c, name in kept.items()])
    rows = documents.select(row.alias("row"), F.col(text).alias("text"))
    again = kept_table(redraws(rows, key), "redraws", light=True)
    found = rows.withColumn("found", entities(F.col("text")))
    if again.isEmpty():
        placed = found.withColumn("draws", F.create_map().cast("map<string,int>"))
    else:
        # Draws by the hash of the text: two texts of one hash only share the lookup.
        some = found.select(F.xxhash64("text").alias("hash"), F.explode("found").alias("entity")).distinct()
        some = some.select("hash", F.explode(atoms(F.col("entity"))).alias("a")).select("hash", "a.kind", "a.canon")
        draws = some.join(again, ["kind", "canon"]).groupBy("hash").agg(
            F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\u0001", "kind", "canon"), "draw"))).alias("draws")
        )
        placed = found.withColumn("hash", F.xxhash64("text")).join(kept_table(draws, "text-draws", light=True), "hash", "left").drop("hash")
    draw = lambda a: F.coalesce(
        F.try_element_at("draws", F.concat_ws("\u0001", a["kind"], a["canon"])), F.lit(0)
    )
    # Step by step, so that each entity is hashed once and not once a character.
    prepared = placed.withColumn(
        "atoms", F.transform("found", lambda e: F.transform(atoms(e), lambda a: drawn(a, draw(a), key)))
    ).withColumn("people", people(F.col("atoms")))
    title = lambda e: F.regexp_extract(e, f"^({_TITLE} )(?=\\p{{Lu}})", 1)
    news = F.zip_with(
        "found",
        F.transform("atoms", lambda some: F.array_join(F.transform(some, lambda a: surrogate(a, key)), " ")),
        lambda e, new: F.concat(title(e), new),
    )
    first = F.filter("people", lambda x, i: (i == 0) | (F.get("people", i - 1)["canon"] != x["canon"]))
    names = F.map_from_entries(F.transform(first, lambda x: F.struct(x["canon"], surrogate(x["atom"], key))))
    between = F.split("text", ENTITY, -1)
    prepared = prepared.withColumns({"news": news, "names": names, "between": F.when(F.size("found") > 0, between)})
    # Each part between two entities as a list of (token, its surrogate if it is a name).
    words = F.transform(
        "between",
        lambda part: F.transform(
            F.regexp_extract_all(part, F.lit(TOKEN)), lambda t: F.struct(t.alias("old"), mention(t, F.col("names")).alias("new"))
        ),
    )
    prepared = prepared.withColumn("words", F.when(F.size("people") > 0, words))
    renamed = F.transform("words", lambda part: F.array_join(F.transform(part, lambda w: F.coalesce(w["new"], w["old"])), ""))
    joined = F.array_join(
        F.zip_with(
            F.coalesce(renamed, "between"), "news", lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))
        ),
        "",
    )
    mentions = F.size(F.filter(F.flatten("words"), lambda w: w["new"].isNotNull()))
    changed = F.when(F.size("found") > 0, joined).otherwise(F.col("text"))
    return prepared.select(
        *[changed.alias(c) if c == text else F.col(f"row.{kept[c]}").alias(c) for c in carried],
        (F.greatest(F.size("found"), F.lit(0)) + F.when(F.size("people") > 0, mentions).otherwise(0)).cast("long").alias("n_replaced"),
    )
