"""Personal data replaced by keyed surrogates of the same kind and format. DataFrame functions only.

Entities: e-mail addresses, IPv4 and IPv6 addresses, phone numbers, card numbers,
IBANs, national numbers, secrets (keys, tokens, passwords) and names after a
title, with their bare mentions elsewhere in the same text. Dates, ranges of
years and of times look like phone numbers and stay. The README lists what is
not detected.
An entity has a canonical form, so one phone number in two layouts is one
entity and gets one surrogate, in either layout. Digits become digits and
letters letters of the same case and script; a card number keeps its check
digit's validity, a name its gender. A surrogate that is another entity's, or
equals any entity of the corpus, is drawn again, so distinct entities stay
distinct.

A null text stays null, with no entity. Repeated rows come back each; extra
columns pass through a struct. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.llm.shared import hash128
from panelweave.session import stage

KEY = "replace with a secret of the corpus"
DRAWS = 40

# fixed values: titles by gender and script
FEMALE = ["Mrs", "Ms", "Miss", "Mme", "Madame", "Mlle", "Frau", "Sra", "Señora", "Srta", "Dra", "Profa", "г-жа", "госпожа"]
MALE = ["Mr", "Monsieur", "Herr", "Sr", "Señor", "г-н", "господин"]
NEUTRAL = ["Dr", "Prof", "Professor", "Doctor", "Doktor", "Docteur", "д-р", "проф"]
# fixed values: given names by gender and script
GIVEN = {
    "female latin": ["Alma", "Berta", "Clara", "Dora", "Edith", "Flora", "Greta", "Hanna", "Ines", "Julia", "Klara", "Laura", "Marta", "Nora", "Olga", "Paula"],
    "male latin": ["Anton", "Bruno", "Carlo", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leo", "Max", "Noel", "Oscar", "Paul"],
    "neutral latin": ["Alex", "Andrea", "Chris", "Dominique", "Jamie", "Kim", "Luca", "Maxime", "Nicola", "Noa", "Robin", "Sam", "Sascha", "Sidney", "Toni", "Vanja"],
    "neutral cyrillic": ["Валя", "Женя", "Паша", "Саша", "Слава", "Тоня", "Шура", "Юля"],
    "female cyrillic": ["Алла", "Вера", "Дарья", "Елена", "Жанна", "Зоя", "Инна", "Лидия"],
    "male cyrillic": ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"],
}
# fixed values: syllables that surnames are made of
SYLLABLES = {
    "latin": ["ba", "be", "bo", "da", "de", "do", "ka", "ke", "ko", "la", "le", "lo", "ma", "me", "mo", "na", "ne", "no", "ra", "re", "ro", "sa", "se", "so", "ta", "te", "to", "va", "ve", "vo", "za", "zo"],
    "cyrillic": ["ба", "бе", "бо", "да", "де", "до", "ка", "ке", "ко", "ла", "ле", "ло", "ма", "ме", "мо", "на", "не", "но", "ра", "ре", "ро", "са", "се", "со", "та", "те", "то", "ва", "ве", "во", "за", "зо"],
}

_TITLES = "|".join(sorted(FEMALE + MALE + NEUTRAL, key=len, reverse=True))
_TITLE = rf"(?:(?:{_TITLES})(?:\.\s{{0,2}}|\s{{1,2}})){{1,4}}+"
_PART = r"(?:(?:van|von|vom|zu|zum|zur|der|den|de|del|della|di|da|das|do|dos|du|la|le|ten|ter|al|el|bin|ibn)[ ]){0,3}+(?=\p{Lu}[\p{L}\p{M}'’-])\p{Lu}[\p{L}\p{M}]*+(?:['’-](?!s(?![\p{L}]))[\p{L}\p{M}]++)*+"
_NAME = rf"(?:\p{{Lu}}(?:\.[ ]?|[ ]))*+{_PART}(?:[ ](?:\p{{Lu}}(?:\.[ ]?|[ ]))*+{_PART})*+"
_SECRET = r"(?i:(?:password|passwd|pwd|secret|token|api[_-]?key) {0,3}[=:] {0,3}[\"']?|bearer {1,3}(?=[a-z+/_.~-]*+[0-9])(?=[a-z0-9+/_.~-]{20}))"
_ISSUED = r"AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|sk-|[rs]k_(?:live|test)_|xox[abeprs]-|AIza|eyJ"
_KEY = r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])|(?:gh[pousr]_|github_pat_|glpat-|sk-|[rs]k_(?:live|test)_|xox[abeprs]-|AIza)(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{16,}+|eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]++)?+"
_HEX = r"[0-9A-Fa-f]{1,4}"
_IP6 = rf"(?<![0-9A-Za-z:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?=[0-9A-Fa-f:]{{0,39}}[0-9])[0-9A-Fa-f]{{3,4}}(?::{_HEX}){{0,6}}::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?![0-9A-Za-z:])"
#: One separator of a phone number, and one more digit of it; a separator stands before two digits at least.
_GAP = r"[ \u00A0.\u2011/-]"
_MORE = rf"(?:{_GAP}(?=[0-9][0-9]))?[0-9]"
_PHONE = "|".join([
    # written with the country: eleven digits in North America, else 7 to 15
    rf"\+1{_GAP}?(?:\([0-9]{{3}}\)|[0-9]{{3}}){_GAP}?[0-9]{{3}}{_GAP}?[0-9]{{4}}(?![0-9A-Za-z])",
    rf"\+[0-9](?:{_GAP}?\(?[0-9]\)?){{6,14}}(?![0-9A-Za-z])",
    # an area code in brackets, which is no year
    rf"\((?!(?:19|20)[0-9]{{2}}\))(?:[0-9]{{2}}\){_GAP}?[0-9](?:{_MORE}){{4,12}}|[0-9]{{3,5}}\){_GAP}?[0-9](?:{_MORE}){{3,9}})(?![0-9A-Za-z])",
    # three groups or more, or a national prefix and one more group
    rf"(?:(?=[0-9]{{2,12}}{_GAP}[0-9]{{2,12}}{_GAP}[0-9]{{2}})|(?=0[0-9]{{1,5}}{_GAP}[0-9]{{3}}))[0-9]{{2}}(?:{_MORE}){{5,13}}(?![0-9A-Za-z])",
    # an area code in brackets inside, two groups of common formats, and bare runs
    rf"[0-9]{{1,3}}{_GAP}?\([0-9]{{2,5}}\){_GAP}?[0-9](?:{_MORE}){{4,9}}(?![0-9A-Za-z])",
    r"(?:[0-9]{3}-[0-9]{4}|(?!(?:19|20)[0-9]{2} )[0-9]{3,5}[ \u00A0-][0-9]{6,8}|[6-9][0-9]{4} [0-9]{5})(?![0-9A-Za-z])",
    r"(?:[1-9][0-9]{9,11}|0[0-9]{8,11})(?![0-9A-Za-z]|[.,][0-9])",
])
_DAY, _MONTH, _YEAR = "(?:0?[1-9]|[12][0-9]|3[01])", "(?:0?[1-9]|1[0-2])", "(?:1[5-9]|20)[0-9]{2}"
#: What phone patterns would take for a number: dates by each separator, ranges of years and of times.
_DATE = "|".join([f"{_YEAR}{g}{_MONTH}{g}{_DAY}|{_DAY}{g}{_DAY}{g}{end}" for g, end in [(g, f"(?:{_YEAR}|[0-9]{{2}})") for g in ("-", r"\.", "/")] + [(" ", _YEAR)]] + [f"{_YEAR} ?[-–/] ?{_YEAR}", r"[0-2]?[0-9]\.[0-5][0-9] ?[-–] ?[0-2]?[0-9]\.[0-5][0-9]"])
#: kind -> (what it can begin with, pattern); the first that fits at a place wins. Repeats are bounded or give nothing back, so a long run of letters costs no more than its length.
PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z])"),
    "key": (r"[AaegrsxG]", rf"(?<![A-Za-z0-9])(?:{_KEY})"),
    "secret": (r"[AaBbPpSsTt]", _SECRET + r"[A-Za-z0-9+/_.~-]{6,}+"),
    "iban": (r"[A-Z]", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "card": (r"[0-9]", r"(?<![0-9A-Za-z])[0-9]{4}(?:[ -]?[0-9]{3,4}){3}[0-9]{0,3}(?![0-9A-Za-z])"),
    "national": (r"[0-9]", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "ip": (r"[0-9]", r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"),
    "ip6": (r"[0-9A-Fa-f]", _IP6),
    "date": (r"[0-9]", rf"(?<![0-9A-Za-z])(?<![0-9][.,/-])(?:{_DATE})(?![0-9A-Za-z]|[.,/-][0-9])"),
    "phone": (r"[0-9+(]", rf"(?<![0-9A-Za-z_])(?<![0-9][.,])(?:{_PHONE})"),
    "mobile": (r"\+", r"(?<![0-9A-Za-z])\+[0-9]{8,15}(?![0-9A-Za-z])"),
    "name": (f"[{''.join(sorted({t[0] for t in FEMALE + MALE + NEUTRAL}))}]", rf"(?<![\p{{L}}]){_TITLE}{_NAME}"),
}
#: Only alphanumerics tell two of these apart; the rest is layout.
SPACED = ["iban", "card", "national", "phone", "mobile"]
ANY = "|".join(f"(?={first})(?:{p})" for first, p in PATTERNS.values())


def hinted(text: Column) -> Column:
    """False only for a text without an entity: nearly all are told by a plain search for a digit or an at sign."""
    spoken = F.lower(text)
    hint = text.rlike("[0-9@]")
    for word in ("password", "passwd", "pwd", "secret", "token", "key", "bearer"):
        hint = hint | spoken.contains(word)
    titles = FEMALE + MALE + NEUTRAL
    for word in ["AKIA", "ASIA", "eyJ", "::", *(t for t in titles if not any(t != u and u in t for u in titles))]:
        hint = hint | text.contains(word)
    return F.coalesce(hint, F.lit(False))


def kind_of(raw: Column) -> Column:
    """Kind of a matched text."""
    kind = F.lit(None).cast("string")
    for name, (_, pattern) in reversed(PATTERNS.items()):
        kind = F.when(raw.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return F.when(kind == "mobile", "phone").otherwise(kind)


def canonical(kind: Column, raw: Column) -> Column:
    """What all layouts of an entity share."""
    bare = F.regexp_replace(raw, r"[^0-9A-Za-z]", "")
    person = F.lower(F.regexp_replace(raw, f"^{_TITLE}", ""))
    return F.when(kind.isin(SPACED), bare).when(kind.isin("email", "ip6"), F.lower(raw)).when(kind == "name", person).when(kind == "secret", F.regexp_replace(raw, f"^{_SECRET}", "")).otherwise(raw)


def variant(kind: Column, raw: Column) -> Column:
    """Gender and script of a name; empty for the rest. A doctor's or professor's gender is not known."""
    title = F.regexp_extract(raw, f"^({_TITLE})", 1)

    def has(words: list[str]) -> Column:
        return title.rlike(rf"(?<![\p{{L}}])(?:{'|'.join(words)})(?![\p{{L}}])")

    gender = F.when(has(FEMALE), "female").when(has(MALE), "male").otherwise("neutral")
    script = F.when(raw.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    return F.when(kind == "name", F.concat_ws(" ", gender, script)).otherwise("")


def _bound(value: Column, made) -> Column:
    """``made(value)``, with the value worked out once, also where ``made`` repeats it for each character."""
    return F.transform(F.array(value), made)[0]


def _stream(key: str, draw: Column) -> Column:
    """A keyed hexadecimal stream in blocks of 64 digits, four digits for each character of the canonical form."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), "kind", "canonical", draw.cast("string")), 256)
    blocks = F.sequence(F.lit(0), F.floor(F.length("canonical") / F.lit(16)).cast("int"))
    return _bound(seed, lambda s: F.transform(blocks, lambda b: F.sha2(F.concat_ws("|", s, b.cast("string")), 256)))


def _at(stream: Column, i: Column, size: Column | int) -> Column:
    number = F.conv(F.substr(stream[F.shiftright(i, 4)], F.pmod(i, F.lit(16)) * 4 + 1, F.lit(4)), 16, 10).cast("int")
    return F.pmod(number, size if isinstance(size, Column) else F.lit(size))


def _pick(text: str, at: Column) -> Column:
    return F.substr(F.lit(text), at + 1, F.lit(1))


def _like(stream: Column) -> Column:
    """Each character replaced by one of its class; hexadecimal stays hexadecimal, the last label of an address stays."""
    hexa = F.col("canonical").rlike("^[0-9a-f]{8,}$") | (F.col("kind") == "ip6")
    fixed = F.when(F.col("kind") == "email", F.length("canonical") - F.length(F.substring_index("canonical", ".", -1))).otherwise(F.length("canonical"))
    begin = F.when(F.col("kind") == "key", F.length(F.regexp_extract("canonical", f"^(?:{_ISSUED})", 0))).when(F.col("kind") == "iban", 2).otherwise(0)

    def swap(c: Column, i: Column, own: Column) -> Column:
        letter = F.when(own["hexa"], _pick("abcdef", _at(stream, i, 6))).otherwise(_pick("abcdefghijklmnopqrstuvwxyz", _at(stream, i, 26)))
        digit = F.when((i == 0) & (F.col("kind") == "phone"), _pick("123456789", _at(stream, i, 9))).otherwise(_pick("0123456789", _at(stream, i, 10)))
        made = F.when(c.rlike("[0-9]"), digit).when(c.rlike("[a-z]"), letter).when(c.rlike("[A-Z]"), F.upper(_pick("abcdefghijklmnopqrstuvwxyz", _at(stream, i, 26)))).otherwise(c)
        return F.when((i < own["begin"]) | (i >= own["fixed"]), c).otherwise(made)

    whole = F.struct(hexa.alias("hexa"), begin.alias("begin"), fixed.alias("fixed"))
    return _bound(whole, lambda own: F.array_join(F.transform(F.split("canonical", ""), lambda c, i: swap(c, i, own)), ""))


def _luhn(digits: Column) -> Column:
    """The check sum of a card number, whose last digit counts once."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10


def _card(made: Column) -> Column:
    """``made`` with the last digit that gives it the original's check sum."""
    head = F.substr(made, F.lit(1), F.length(made) - 1)
    return F.concat(head, F.pmod(_luhn(F.col("canonical")) - _luhn(F.concat(head, F.lit("0"))), F.lit(10)).cast("string"))


def _ip(stream: Column) -> Column:
    octets = F.transform(F.split("canonical", r"\."), lambda x, i: (_at(stream, i, 254) + 1).cast("string"))
    return F.array_join(octets, ".")


def _person(stream: Column) -> Column:
    """Given names of the gender and script, and a surname of four syllables; as many words as the original has, and initials for initials."""
    given, sound = F.lit(None), F.lit(None)
    for name, words in GIVEN.items():
        given = F.when(F.col("variant") == name, F.array(*map(F.lit, words))).otherwise(given)
    for name, parts in SYLLABLES.items():
        sound = F.when(F.col("variant").endswith(name), F.array(*map(F.lit, parts))).otherwise(sound)
    words = F.split("canonical", " ")

    letters = F.when(F.col("variant").endswith("cyrillic"), F.lit("абвгдежзиклмнопрстуфхцчшэюя")).otherwise(F.lit("abcdefghijklmnopqrstuvwxyz"))

    def word(own: Column, i: Column) -> Column:
        initial = F.concat(F.substr(letters, _at(stream, i, F.length(letters)) + 1, F.lit(1)), F.when(own.contains("."), ".").otherwise(""))
        first = F.when(own.rlike(r"^\p{L}(?:\.|$)"), initial).otherwise(given[_at(stream, i, F.size(given))])
        last = F.initcap(F.concat(*[sound[_at(stream, i + k, F.size(sound))] for k in range(4)]))
        return F.when(i < F.size(words) - 1, first).otherwise(last)

    return F.lower(F.array_join(F.transform(words, word), " "))


def drawn(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (kind, canonical, variant, draw) with the surrogate of that draw."""
    with_stream = entities.withColumn("_s", _stream(key, F.col("draw")))
    s, kind = F.col("_s"), F.col("kind")
    like = with_stream.withColumn("_like", _like(s))
    made = F.when(kind == "ip", _ip(s)).when(kind == "name", _person(s)).when(kind == "card", _card(F.col("_like"))).otherwise(F.col("_like"))
    return like.withColumn("surrogate", made).drop("_s", "_like")


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, canonical, variant, surrogate): distinct entities with distinct surrogates, none of which is an entity itself.

    Of several that drew the same, the least keeps it; the others and those
    that hit a real entity draw again, until none has to.
    """
    current = stage(drawn(entities.withColumn("draw", F.lit(0)), key))
    real = entities.select("kind", F.col("canonical").alias("surrogate"), F.lit(True).alias("real")).distinct()
    who = F.struct("canonical", "variant")
    for _ in range(DRAWS):
        keeper = current.groupBy("kind", "surrogate").agg(F.min(who).alias("keeper"))
        seen = current.join(keeper, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        again = (who != F.col("keeper")) | F.coalesce(F.col("real"), F.lit(False))
        marked = stage(seen.select("kind", "canonical", "variant", "draw", "surrogate", again.alias("again")))
        if marked.filter("again").isEmpty():
            return marked.select("kind", "canonical", "variant", "surrogate")
        anew = drawn(marked.filter("again").select("kind", "canonical", "variant", (F.col("draw") + 1).alias("draw")), key)
        current = stage(marked.filter("not again").drop("again").unionByName(anew))
    raise RuntimeError(f"surrogates still collide after {DRAWS} draws")


def laid_out(kind: Column, raw: Column, made: Column) -> Column:
    """A canonical surrogate in the layout of the text that it replaces."""
    chars = F.split(raw, "")

    def spaced(c: Column, i: Column) -> Column:
        place = F.length(F.regexp_replace(F.substr(raw, F.lit(1), i + 1), r"[^0-9A-Za-z]", ""))
        return F.when(c.rlike("[0-9A-Za-z]"), F.substr(made, place, F.lit(1))).otherwise(c)

    def cased(c: Column, i: Column) -> Column:
        one = F.substr(made, i + 1, F.lit(1))
        return F.when(c.rlike("[A-Z]"), F.upper(one)).otherwise(one)

    title = F.regexp_extract(raw, f"^({_TITLE})", 1)
    return (
        F.when(kind.isin(SPACED), F.array_join(F.transform(chars, spaced), ""))
        .when(kind.isin("email", "ip6"), F.array_join(F.transform(chars, cased), ""))
        .when(kind == "name", F.concat(title, F.initcap(made)))
        .when(kind == "secret", F.concat(F.regexp_extract(raw, f"^({_SECRET})", 1), made))
        .otherwise(made)
    )


def one_gender(forms: DataFrame) -> DataFrame:
    """``forms`` in which a name met with a neutral title only now and then has the gender of its other titles."""
    names = forms.filter("kind = 'name'").select("canonical", "variant").distinct()
    told = names.filter("variant not like 'neutral%'").groupBy("canonical").agg(F.min("variant").alias("told"))
    fits = F.col("variant").startswith("neutral") & F.col("told").isNotNull()
    return forms.join(told, "canonical", "left").withColumn("variant", F.when(fits, F.col("told")).otherwise(F.col("variant"))).drop("told")


def bare_names(named: DataFrame) -> DataFrame:
    """(h1, h2, bare, names): for each text the pattern of its names without their titles, and what each becomes.

    ``named`` has h1, h2, pos, raw and made of the names found. A surname alone goes
    with the first full name that ends in it, unless it is a name of its own.
    """
    def untitled(c: str) -> Column:
        return F.regexp_replace(c, f"^{_TITLE}", "")

    whole = named.select("h1", "h2", "pos", untitled("raw").alias("old"), untitled("made").alias("new"))
    last = whole.filter("old like '% %'").select("h1", "h2", "pos", F.substring_index("old", " ", -1).alias("old"), F.substring_index("new", " ", -1).alias("new"))
    both = whole.withColumn("part", F.lit(0)).unionByName(last.withColumn("part", F.lit(1)))
    each = both.groupBy("h1", "h2", "old").agg(F.min(F.struct("part", "pos", "new")).alias("x"))
    names = each.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct(F.length("old").alias("n"), "old", F.col("x.new").alias("new"))), asc=False).alias("names"))
    bare = F.concat(F.lit(r"(?<![\p{L}\p{M}])(?=\p{L})(?:\Q"), F.array_join("names.old", r"\E|\Q"), F.lit(r"\E)(?![\p{L}\p{M}])"))
    return names.select("h1", "h2", bare.alias("bare"), F.map_from_entries(F.transform("names", lambda n: F.struct(n["old"], n["new"]))).alias("names"))


def replaced(docs: DataFrame, key: str = KEY) -> DataFrame:
    """(row, n_entities, text): each row of ``docs`` with its text's entities replaced.

    Texts without a hint of an entity pass by. The rest are keyed by a hash of the text,
    so copies are worked out once; entities travel without their texts and
    come back as one array a text, which its gaps are filled from. Bare
    mentions of a text's names are replaced in the gaps, and count.
    """
    text = F.col("row.text")
    h1, h2 = hash128(text)
    rows = docs.select(F.struct("*").alias("row"))
    hit = rows.filter(hinted(text)).select("row", h1.alias("h1"), h2.alias("h2"))
    raws = stage(hit.select("h1", "h2", F.posexplode(F.regexp_extract_all(text, F.lit(f"({ANY})"), 1)).alias("pos", "raw")).distinct())
    kind = kind_of(F.col("raw"))
    forms = raws.select("raw").distinct().select("raw", kind.alias("kind")).select("raw", "kind", canonical(F.col("kind"), F.col("raw")).alias("canonical"), variant(F.col("kind"), F.col("raw")).alias("variant"))
    forms = stage(one_gender(stage(forms)))
    entities = forms.filter("kind <> 'date'").select("kind", "canonical", "variant").distinct()
    drawn_forms = forms.join(surrogates(stage(entities), key), ["kind", "canonical", "variant"]).select("raw", "kind", laid_out(F.col("kind"), F.col("raw"), F.col("surrogate")).alias("made"))
    made = stage(drawn_forms.union(forms.filter("kind = 'date'").select("raw", "kind", F.col("raw").alias("made"))))
    # a very common entity is split by the join at run time
    met = raws.join(made, "raw")
    lists = met.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("pos", "made"))).alias("fill"), F.count_if(F.col("kind") != "date").alias("n"))
    names = bare_names(raws.join(made.filter("kind = 'name'"), "raw"))
    joined = hit.join(stage(lists.join(names, ["h1", "h2"], "left")), ["h1", "h2"], "left").withColumn("gaps", F.when(F.col("fill").isNotNull(), F.split(text, ANY, -1)))
    joined = joined.withColumn("said", F.when(F.col("bare").isNotNull(), F.transform("gaps", lambda g: F.regexp_extract_all(g, F.col("bare"), F.lit(0)))))

    def filled(gap: Column, i: Column) -> Column:
        named = F.transform(F.split(gap, F.col("bare"), -1), lambda p, k: F.concat(F.when(k > 0, F.col("names")[F.col("said")[i][k - 1]]).otherwise(F.lit("")), p))
        return F.concat(F.when(i > 0, F.col("fill")[i - 1]["made"]).otherwise(F.lit("")), F.when(F.col("bare").isNull(), gap).otherwise(F.array_join(named, "")))

    whole = F.array_join(F.transform(F.col("gaps"), filled), "")
    n = F.coalesce("n", F.lit(0)) + F.when(F.col("said").isNotNull(), F.size(F.flatten("said"))).otherwise(0)
    done = joined.select("row", n.cast("bigint").alias("n_entities"), F.coalesce(whole, text).alias("text"))
    return rows.filter(~hinted(text)).select("row", F.lit(0).cast("bigint").alias("n_entities"), text.alias("text")).union(done)


def digest(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The query's columns: doc_id, n_entities, text."""
    return replaced(docs.select("doc_id", "text"), key).select("row.doc_id", "n_entities", "text")
