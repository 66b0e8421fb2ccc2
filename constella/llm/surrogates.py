"""Personal data and secrets replaced by surrogates, with DataFrame functions only.

One pattern finds the mentions of a whole text; a mention is split into parts, and each part that names something is
an entity (kind, canonical form).  Mentions that differ in case, spacing or punctuation share a canonical form, so
they get the same surrogate (coreference), written in each mention's own format: digits stand where digits stood,
capitals where capitals were, separators stay.  A surrogate is drawn from a keyed digest of the entity:

* phone numbers keep their country code or their leading 0, cards their first digit and (in)validity of the check digit,
  IBANs their country and get the check digits of their new number, addresses in private networks their network, e-mail
  addresses their top-level domain, hexadecimal secrets stay hexadecimal;
* names after a title keep their script (Latin, Cyrillic, Greek); given names end by the title's gender, and so do
  Cyrillic family names; given and family name are entities of their own, so "Mr Smith" follows "Mr John Smith".

Collision checks run over the distinct entities of the whole table: no two entities of a kind share a surrogate and
none is a form that occurs in the table.  The larger of two that clash, or the one that hit a real form, draws again
with the next attempt number until no clash is left.  Those few attempt numbers are joined to the texts that need them.

What isn't detected is listed in the README.

The pattern runs over each text once: its pieces, mentions at the odd places, are written to the shared folder and read
again for the entities and for the new text.

Nulls and ties: a null text stays null with zero entities; repeated rows are treated alike; other columns pass
through, one named ``n_entities`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from constella.llm.common import cut, free

# Titles by gender, and the letters from which names are built
MALE = ["Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Г-н", "Господин", "господин", "Κύριος", "κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Г-жа", "Госпожа", "госпожа", "Κυρία", "κυρία"]
NEUTRAL = ["Dr", "Prof"]
SCRIPTS = {
    "latin": ("bdfgklmnprstvz", "aeiou", {"m": ["n", "r", "s"], "f": ["a", "ia", "ina"], "x": ["y", "en"]},
              {"m": ["son", "er", "ard"], "f": ["son", "er", "ard"], "x": ["son", "er", "ard"]}),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", {"m": ["н", "р", "с"], "f": ["а", "ия", "ина"], "x": ["й", "ен"]},
                 {"m": ["ов", "ин"], "f": ["ова", "ина"], "x": ["ко"]}),
    "greek": ("βγδζκλμνπρστ", "αεηιου", {"m": ["ος", "ης"], "f": ["α", "ια"], "x": ["ις"]},
              {"m": ["ίδης", "ος"], "f": ["ίδου", "ου"], "x": ["άκη"]}),
}
#: Lengths of the IBANs of a country, without spaces
IBANS = {15: "NO", 16: "BE", 18: "DK FO FI GL NL SD", 19: "MK SI", 20: "AT BA EE KZ XK LT LU", 21: "HR LV LI CH",
         22: "BH BG CR GE DE IE ME RS GB VA", 23: "GI IQ IL TL AE", 24: "AD CZ MD PK RO SA SK ES SE TN VG", 25: "LY PT ST",
         26: "IS TR", 27: "FR GR IT MR MC SM", 28: "AL AZ BY CY DO SV GT HU LB PL", 29: "BR EG PS QA UA", 30: "JO KW MU",
         31: "MT SC", 32: "LC"}
#: Country calling codes: these, and three digits for all others
CODES = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
         "81 82 84 86 90 91 92 93 94 95 98")
#: Private networks, and how many values of the second octet they span
_PRIVATE = {r"^(10)\.": None, r"^(127)\.": None, r"^(192)\.168\.": (168, 1), r"^(169)\.254\.": (254, 1),
            r"^(172)\.(?:1[6-9]|2\d|3[01])\.": (16, 16), r"^(100)\.(?:6[4-9]|[7-9]\d|1[01]\d|12[0-7])\.": (64, 64)}
#: Stands around mentions while a text is cut into pieces; a text that holds it is cut by two passes instead
_MARK = "\x01"
_KEYWORD = r"(?i:\b(?:token|api[_-]?key|secret(?:[_-]?key)?|password|passwd))"
_GAP = r"[^\p{L}\p{N}_\n]+"
_SECRET = _KEYWORD + _GAP
_ASSIGNED = _KEYWORD + r"(?=[^\p{L}\p{N}_\n]*[:=：＝])" + _GAP
_RUN = r"[^\s。，、；！？」』）]"
# a value ends with its last letter or digit: signs stay where they are in any case
_VALUE = rf"(?:[\p{{L}}\p{{N}}_]{_RUN}*)?[\p{{L}}\p{{N}}]"


def _quoted(q: str) -> str:
    """The value between two quotes, spaces and escaped quotes included."""
    return rf"(?<={q})(?=[^{q}\n]{{4,}}{q})[^{q}\n]*[\p{{L}}\p{{N}}](?:[^\p{{L}}\p{{N}}{q}\n]*(?<=\\){q}[^{q}\n]*[\p{{L}}\p{{N}}])*"


def _iban(length: int) -> str:
    groups, rest = divmod(length - 4, 4)
    return rf"(?:{IBANS[length].replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (rf" ?[A-Z0-9]{{{rest}}}" if rest else "")


_TITLE = "(?:" + "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True)) + r")\.? "
_LOW = r"[\p{Ll}\p{M}]+"
_WORD = rf"(?:\p{{Lu}}['’])?\p{{Lu}}\p{{M}}*{_LOW}(?:\p{{Lu}}{_LOW})?(?:['’-]\p{{Lu}}\p{{M}}*{_LOW}(?:\p{{Lu}}{_LOW})?)*"
_NATIONAL = r"^(?:(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}|0\d(?:[ .-]\d{2}){4}|0\d{2,4}[ /-]\d{5,8})$"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERN = "|".join([
    _ASSIGNED + "(?:" + "|".join(map(_quoted, "\"'`")) + rf"|(?={_RUN}{{4}}){_VALUE})",
    # in running text only what no word looks like: with a digit, or long
    _SECRET + rf"(?={_RUN}{{8}})(?={_RUN}*\d|[A-Za-z0-9_-]{{16}}){_VALUE}",
    r"(?<![\w.+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}",
    r"(?<!\w)(?:" + "|".join(map(_iban, IBANS)) + r")(?!\w)",
    r"(?<!\w)[A-Z]{2}\d{2} ?[A-Z0-9]{4}(?: ?\d{4}){1,6}(?: ?\d{1,3})?(?!\w)",
    r"(?<![\w+])\+\d{1,3}[^\w\n]{0,5}\(\d{2,4}\)[^\w\n]{0,5}\d{3}[^\w\n]{1,3}\d{4}(?!\d)",
    r"(?<![\w+])\+\d{1,3}(?:[ .-]\d{2,4}){2,4}(?!\d)",
    r"(?<![\w+(])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)",
    r"(?<![\w+])\+(?=(?:[ ()./-]{0,3}\d){8})\d{1,15}[ .-]?(?:\(\d{1,4}\)[ .-]?)?(?:\d{1,10}(?:[ ./-]\d{2,8}){0,5})?(?!\d)",
    r"(?<![\w.+-])(?:1[ .-])?(?:\d{3}[ .-]\d{3}[ .-]\d{4})(?!\w|[.-]\d)",
    r"(?<![\w.+/-])(?:0\d(?:[ .-]\d{2}){4}|0\d{2,4}[ /-]\d{5,8})(?!\w|[./-]\d)",
    rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    r"(?<![\w.])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}(?:-\d{3})?|\d{4}[ -]\d{6}[ -]\d{4,5})(?!\w)",
    r"(?<!\w)" + _TITLE + rf"{_WORD}(?: {_WORD})?(?![\p{{L}}\p{{M}}\p{{N}}_])",
])


def _kind(m: Column) -> Column:
    return (F.when(m.rlike("^" + _SECRET), "secret").when(m.contains("@"), "email")
            .when(m.rlike(r"^[A-Z]{2}\d{2}"), "iban").when(m.rlike(r"^[+(]") | m.rlike(_NATIONAL), "phone")
            .when(m.rlike(r"^\d+\.\d+\.\d+\.\d+$"), "address").when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(m.rlike(r"^\d"), "card").otherwise("name"))


def _part(kind: Column | str, value: Column) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), value.alias("value"))


def _parts(m: Column) -> Column:
    """A mention as parts; those of kind "" are kept as they are."""
    head = F.regexp_extract(m, "^" + _SECRET, 0)
    title = F.regexp_extract(m, "^" + _TITLE, 0)
    bare = F.regexp_replace(title, r"\.? $", "")
    words = F.split(F.substr(m, F.length(title) + 1), " ")
    gender = F.when(bare.isin(MALE), "m").when(bare.isin(FEMALE), "f").otherwise("x")
    script = F.when(words[0].rlike(r"\p{IsCyrillic}"), "cyrillic").when(words[0].rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    family = F.concat(F.lit("family:"), script, F.lit(":"), F.when(script == "latin", "x").otherwise(gender))
    given = F.concat(F.lit("given:"), script, F.lit(":"), gender)
    return (F.when(m.rlike("^" + _SECRET), F.array(_part("", head), _part("secret", F.substr(m, F.length(head) + 1))))
            .when(_kind(m) != "name", F.array(_part(_kind(m), m)))
            .when(F.size(words) == 1, F.array(_part("", title), _part(family, words[0])))
            .otherwise(F.array(_part("", title), _part(given, words[0]), _part("", F.lit(" ")),
                               _part(family, F.get(words, F.lit(1))))))


def _canonical(part: Column) -> Column:
    kind, value = part["kind"], part["value"]
    # İ is the one letter that is longer in lower case
    return (F.when(kind == "secret", F.lower(F.translate(value, "İ", "i"))).when(kind == "email", F.lower(value))
            # a country code counts whether it is written +1 or 1
            .when(kind == "phone", F.concat(F.when(value.rlike(r"^(\+|1[ .-])"), "+").otherwise(""), F.regexp_replace(
                value, "[^0-9]", "")))
            .when(kind.isin("card", "ssn"), F.regexp_replace(value, "[^0-9]", ""))
            .when(kind == "iban", F.regexp_replace(value, " ", "")).otherwise(F.translate(value, "’", "'")))


def _digest(kind: Column, canonical: Column, attempt: Column, key: str) -> Column:
    """256 hexadecimal digits that nobody without the key can foretell."""
    said = F.concat_ws("|", F.lit(key), kind, canonical, attempt.cast("string"), F.lit(key))
    return F.concat(F.sha2(said, 512), F.sha2(F.concat(said, F.lit("+")), 512))


def _byte(digest: Column, i: Column) -> Column:
    return F.conv(F.substr(digest, (i % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str | list[str], n: Column) -> Column:
    return F.get(F.array(*map(F.lit, letters)), (n % len(letters)).cast("int"))


def _characters(text: Column, change) -> Column:
    """``change(character, place from 0)`` at every place, joined."""
    return F.array_join(F.transform(F.split(text, ""), change), "")


def _luhn(digits: Column, n: Column) -> Column:
    """Sum of the first n digits, doubled so that a check digit could follow."""
    def weight(s, i):
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 1, d * 2).otherwise(d)
        return s + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), weight)


def _mod97(text: Column) -> Column:
    """Remainder by 97 of a text of digits and capitals, in which A counts as 10 and Z as 35."""
    return F.aggregate(F.split(text, ""), F.lit(0), lambda r, c: F.when(
        c.rlike("[0-9]"), (r * 10 + c.cast("int")) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97).cast("int"))


def _drawn(e: Column) -> Column:
    """The canonical surrogate of an entity (kind, canonical, attempt, digest)."""
    kind, canonical, attempt, digest = (e[c] for c in ("kind", "canonical", "attempt", "digest"))
    digit = lambda i: (_byte(digest, i) % 10).cast("string")
    letter = lambda i, letters: _pick(letters, _byte(digest, i))
    # the country code, or a leading 0, stays; what follows it is neither 0 nor 1
    code = F.regexp_extract(canonical, rf"^(\+(?:{CODES.replace(' ', '|')}|\d{{3}})|0?)", 1)
    keep = F.length(code)
    phone = _characters(canonical, lambda c, i: F.when(i < keep, c).when(
        i == keep, (_byte(digest, i) % 8 + 2).cast("string")).otherwise(digit(i)))
    raw = _characters(canonical, lambda c, i: F.when(i == 0, c).otherwise(digit(i)))
    n = F.length(canonical) - 1
    check = lambda d: ((10 - _luhn(d, n) % 10) % 10).cast("string")
    valid = check(canonical) == F.substr(canonical, n + 1, F.lit(1))
    body = F.substr(raw, F.lit(1), n)
    card = F.when(valid, F.concat(body, check(body))).otherwise(raw)
    ssn = _characters(canonical, lambda c, i: F.when(i == 0, (_byte(digest, i) % 5 + 1).cast("string")).otherwise(digit(i)))
    octet = lambda i: (_byte(digest, F.lit(i)) % 254 + 1).cast("string")
    first = _pick([str(x) for x in range(1, 224) if x not in (10, 100, 127, 169, 172, 192, 198, 203)],
                  _byte(digest, F.lit(0)) * 256 + _byte(digest, F.lit(9)))
    net, second = first, octet(1)
    for network, span in _PRIVATE.items():
        net = F.when(canonical.rlike(network), F.regexp_extract(canonical, network, 1)).otherwise(net)
        if span:
            second = F.when(canonical.rlike(network), (_byte(digest, F.lit(1)) % span[1] + span[0]).cast("string")).otherwise(second)
    address = F.concat_ws(".", net, second, octet(2), octet(3))
    top = F.regexp_extract(canonical, r"\.\p{L}+$", 0)
    rest = F.substr(canonical, F.lit(1), F.length(canonical) - F.length(top))
    email = F.concat(_characters(rest, lambda c, i: F.when(c.rlike(r"\p{N}"), digit(i)).when(
        c.rlike(r"\p{L}"), letter(i, "abcdefghijklmnopqrstuvwxyz")).otherwise(c)), top)
    hexa = canonical.rlike("^[0-9a-f]+$")
    secret = _characters(canonical, lambda c, i: F.when(c.rlike(r"\p{N}"), digit(i)).when(c.rlike(r"\p{L}"), F.when(
        hexa, letter(i, "abcdef")).otherwise(letter(i, "abcdefghijklmnopqrstuvwxyz"))).otherwise(c))
    # short ones have few others of their length: they grow in the end
    secret = F.when(attempt < 8, secret).otherwise(F.concat(secret, F.array_join(F.transform(
        F.sequence(F.lit(0), attempt), lambda i: letter(i + 64, "abcdefghijklmnopqrstuvwxyz")), "")))
    account = _characters(F.substr(canonical, F.lit(5)), lambda c, i: F.when(c.rlike("[0-9]"), digit(i)).otherwise(
        letter(i, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")))
    country = F.substr(canonical, F.lit(1), F.lit(2))
    iban = F.concat(country, F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)
    drawn = (F.when(kind == "phone", phone).when(kind == "card", card).when(kind == "ssn", ssn)
             .when(kind == "address", address).when(kind == "email", email).when(kind == "secret", secret)
             .when(kind == "iban", iban))
    for script, (consonants, vowels, given, family) in SCRIPTS.items():
        # syllables that grow in number with the attempts, so that there is always another name
        syllables = F.array_join(F.transform(F.sequence(F.lit(0), 2 + F.floor(attempt / 4).cast("int")), lambda i: F.concat(
            _pick(consonants, _byte(digest, i * 2)), _pick(vowels, _byte(digest, i * 2 + 1)))), "")
        for gender in "mfx":
            for group, ends in (("given", given[gender]), ("family", family[gender])):
                drawn = drawn.when(kind == f"{group}:{script}:{gender}",
                                   F.initcap(F.concat(syllables, _pick(ends, _byte(digest, F.lit(120))))))
    return drawn


def _written(value: Column, drawn: Column) -> Column:
    """``drawn`` in the format of ``value``: its letters and digits one after the other, capitals where they were."""
    marks = F.regexp_replace(drawn, r"[^\p{L}\p{N}]", "")
    step = lambda s, i: F.struct(
        F.concat(s["out"], F.when(F.substr(value, i, F.lit(1)).rlike(r"[\p{L}\p{N}]"), F.when(
            F.substr(value, i, F.lit(1)).rlike(r"\p{Lu}"), F.upper(F.substr(marks, s["k"], F.lit(1)))).otherwise(
            F.substr(marks, s["k"], F.lit(1)))).otherwise(F.substr(value, i, F.lit(1)))).alias("out"),
        (s["k"] + F.when(F.substr(value, i, F.lit(1)).rlike(r"[\p{L}\p{N}]"), 1).otherwise(0)).alias("k"))
    return F.aggregate(F.sequence(F.lit(1), F.length(value)), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")),
                       step, lambda s: s["out"])


def _secret_written(value: Column, drawn: Column) -> Column:
    """Like ``_written`` for a surrogate with a character for each of ``value``, or more; in linear time."""
    return F.array_join(F.zip_with(F.split(value, ""), F.split(drawn, ""), lambda a, b: F.when(
        a.isNull(), b).when(a.rlike(r"\p{Lu}"), F.upper(b)).when(a.rlike(r"[\p{L}\p{N}]"), b).otherwise(a)), "")


def _with_digest(entity: Column, attempt: Column, key: str) -> Column:
    return F.struct(entity["kind"].alias("kind"), entity["canonical"].alias("canonical"), attempt.alias("attempt"),
                    _digest(entity["kind"], entity["canonical"], attempt, key).alias("digest"))


def pieces(text: Column) -> Column:
    """A text cut before and after every mention: mentions at the odd places (from 0), what lies between at the even."""
    marked = F.split(F.regexp_replace(text, PATTERN, f"{_MARK}$0{_MARK}"), _MARK, -1)
    between, found = F.split(text, PATTERN, -1), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    by_two = F.flatten(F.zip_with(between, found, lambda a, m: F.when(m.isNull(), F.array(a)).otherwise(F.array(a, m))))
    return F.when(text.contains(_MARK), by_two).otherwise(marked)


def mentions(cut_up: Column) -> Column:
    """The mentions among ``pieces``, in order."""
    return F.filter(cut_up, lambda _, i: i % 2 == 1)


def entities(found: DataFrame, mentioned: str) -> DataFrame:
    """(kind, canonical): the distinct entities of a column of mentions."""
    parts = found.select(F.explode(mentioned).alias("m")).select(F.explode(_parts(F.col("m"))).alias("p"))
    return parts.filter("p.kind <> ''").select(F.col("p.kind").alias("kind"), _canonical(F.col("p")).alias("canonical")).distinct()


def assign(found: DataFrame, key: str, rounds: int = 64) -> DataFrame:
    """(kind, canonical, attempt, surrogate) without clashes among surrogates or with real forms."""
    def draw(df: DataFrame) -> DataFrame:
        df = df.withColumn("e", _with_digest(F.struct("kind", "canonical"), F.col("attempt"), key))
        return df.select("kind", "canonical", "attempt", _drawn(F.col("e")).alias("surrogate"))

    now = cut(draw(found.withColumn("attempt", F.lit(0))), name="entities")
    for _ in range(rounds):
        twice = now.groupBy("kind", "surrogate").agg(F.count("*").alias("c"), F.min("canonical").alias("owner")).filter("c > 1")
        losers = now.join(twice, ["kind", "surrogate"]).filter("canonical <> owner").select("kind", "canonical")
        real = now.select("kind", F.col("canonical").alias("surrogate"))
        losers = losers.union(now.join(real, ["kind", "surrogate"], "left_semi").select("kind", "canonical")).distinct()
        losers = cut(losers, name="clashes")
        if losers.isEmpty():
            return now
        again = draw(now.join(losers, ["kind", "canonical"], "left_semi").select(
            "kind", "canonical", (F.col("attempt") + 1).alias("attempt")))
        now = cut(now.join(losers, ["kind", "canonical"], "left_anti").union(again), name="entities")
    raise RuntimeError("surrogates still clash: the formats of some entities leave too few others")


def replace(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``df`` with every mention in ``text`` replaced, and ``n_entities`` (mentions found)."""
    df = df.drop("n_entities")
    order = [f"`{c}`" for c in df.columns]
    at, again, whole, said, n = (free(df, name) for name in ("_pieces", "_again", "_text", "_entity", "_n"))
    df = cut(df.withColumn(text, pieces(F.col(text).cast("string"))).withColumnRenamed(text, at), name="pieces")
    found = mentions(F.col(at))
    settled = assign(entities(df.select(found.alias("m")).filter("size(m) > 0"), "m"), key)
    more = settled.filter("attempt > 0").select(F.concat_ws("|", "kind", "canonical").alias(said), F.col("attempt").alias(n))
    if more.isEmpty():
        df = df.withColumn(again, F.lit(None).cast("map<string,int>"))
    else:
        # a text's own mentions bound its map
        named = F.transform(F.flatten(F.transform(found, _parts)), lambda p: F.concat_ws("|", p["kind"], _canonical(p)))
        df = df.withColumn(whole, F.sha2(F.array_join(at, ""), 256))
        texts = df.filter(F.size(at) > 1).select(whole, F.explode(named).alias(said)).distinct()
        attempts = texts.join(more, said).groupBy(whole).agg(
            F.map_from_entries(F.collect_list(F.struct(said, n))).alias(again))
        df = df.join(attempts, whole, "left").drop(whole)
    attempt = lambda e: F.coalesce(F.col(again)[F.concat_ws("|", e["kind"], e["canonical"])], F.lit(0))
    # one transform after the other, so that each step's value is worked out once
    steps = F.transform(found, _parts)
    each = lambda change: lambda parts: F.transform(parts, change)
    steps = F.transform(steps, each(lambda p: F.struct(p["kind"].alias("kind"), p["value"].alias("value"), _canonical(p).alias("canonical"))))
    steps = F.transform(steps, each(lambda p: F.struct(p["kind"].alias("kind"), p["value"].alias("value"), F.when(
        p["kind"] != "", _with_digest(p, attempt(p), key)).alias("e"))))
    steps = F.transform(steps, each(lambda p: F.struct(p["kind"].alias("kind"), p["value"].alias("value"), _drawn(p["e"]).alias("drawn"))))
    written = F.transform(steps, lambda parts: F.array_join(F.transform(parts, lambda p: F.when(
        p["kind"] == "", p["value"]).when(p["kind"] == "secret", _secret_written(p["value"], p["drawn"])).when(p["kind"].rlike("^(address|given|family)"), p["drawn"])
        .otherwise(_written(p["value"], p["drawn"]))), ""))
    between = F.filter(at, lambda _, i: i % 2 == 0)
    joined = F.array_join(F.zip_with(between, written, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    entities_found = F.greatest(F.floor(F.size(at) / 2), F.lit(0)).cast("bigint")
    return df.withColumn("n_entities", entities_found).withColumn(text, joined).select(*order, "n_entities")
