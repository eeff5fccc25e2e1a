"""Text canonicalisation as Column expressions: no Python runs on the rows."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.ml.feature import StopWordsRemover

WHITE = r"[\x20\x09-\x0D]+"


def _accents() -> tuple[str, str]:
    """Letters that decompose to an ASCII letter with marks, and these letters, by rule."""
    pairs = []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accents()
#: Fixed values, which keys must agree on: spellings that tokenisation would break, words before and after a title.
SKILL_SPELLINGS = ((".net", " dotnet"), ("c++", "cplusplus"), ("c#", "csharp"), ("f#", "fsharp"), ("tcp/ip", "tcpip"), ("co-ordin", "coordin"))
TITLE_PREFIXES = ("senior", "junior", "lead", "head", "chief", "honorary", "apprentice", "intern", "freelance", "trainee", "associate", "staff", "graduate")
TITLE_SUFFIXES = ("intern", "apprentice")
LEGAL_FORMS = ("limited", "ltd", "inc", "plc", "uk")
LANGUAGES = {"en": "english", "de": "german", "fr": "french", "es": "spanish"}


def stop_words(lang: str) -> list[str]:
    """Spark's own list of a language, accents stripped."""
    from pyspark.sql import SparkSession

    SparkSession.active()
    words = StopWordsRemover.loadDefaultStopWords(LANGUAGES[lang])
    return sorted({w.lower().translate(str.maketrans(ACCENTED, PLAIN)) for w in words})


def strip_accents(text: Column) -> Column:
    return F.translate(text, ACCENTED, PLAIN)


def without_brackets(text: Column) -> Column:
    """Drops what stands in round, square or curly brackets, up to six levels deep; a bracket without its partner stays."""
    for _ in range(6):
        text = F.regexp_replace(text, r"\([^()\[\]{}]*\)|\[[^()\[\]{}]*\]|\{[^()\[\]{}]*\}", "")
    return text


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITE, " "))


def tokens(text: Column, keep: str = "", nospace: str = "", brackets: bool = False, replace: tuple = (), stop: list[str] | tuple = (), stem_words: bool = False, order: bool = False, distinct: bool = False) -> Column:
    """The canonical words of a text: accents off, lower case, spellings, brackets, signs to blanks, stop words off."""
    out = F.lower(strip_accents(text))
    for old, new in replace:
        out = F.replace(out, F.lit(old), F.lit(new))
    if brackets:
        out = without_brackets(out)
    quoted = "".join("\\" + c for c in keep)
    if nospace:
        out = F.regexp_replace(out, f"[{''.join(chr(92) + c for c in nospace)}]", "")
    out = F.regexp_replace(out, f"[^a-z0-9{quoted}]+", " ")
    words = F.filter(F.split(out, " "), lambda w: w != "")
    if len(stop):
        words = F.filter(words, lambda w: ~w.isin(*stop))
    if stem_words:
        words = stems(words)
    if distinct:
        words = F.array_distinct(words)
    return F.array_sort(words) if order else words


def let(value: Column, f) -> Column:
    """f(value) with the value worked out once, however often f reads it."""
    return F.transform(F.array(value), lambda v: f(v))[0]


def filled(text: Column) -> Column:
    """A text; null when it is empty."""
    return let(text, lambda x: F.when(x != "", x))


def clean(text: Column, **options) -> Column:
    """`tokens` joined by blanks; null when nothing is left."""
    return filled(F.array_join(tokens(text, **options), " "))


_V, _C = "[aeiouy]", "[^aeiouy]"
#: Up to where the first region begins: behind the first consonant after a vowel, or one of three beginnings.
_REGION = rf"^(?:gener|commun|arsen|(?!gener|commun|arsen).*?{_V}{_C})"
_SHORT = rf"{_C}{_V}[^aeiouywxY]$|^{_V}{_C}$"
#: Fixed values of the published English stemming rules: suffixes with what stands for them, and words that do not follow the rules.
STEM_2 = {"tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": ""}
STEM_3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
STEM_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion")
STEM_WORDS = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes"}
STEM_KEPT = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")


def stem(word: Column) -> Column:
    """The English stem of a lower-case word."""
    return stems(F.array(word))[0]


def stems(words: Column) -> Column:
    """The English stems of an array of lower-case words, by the published rules (the revised Porter stemmer). Each step is one
    pass over the array, so no expression is worked out twice; a word keeps its regions from the start."""
    cut = lambda w, n: F.left(w, F.length(w) - n)
    ends = lambda w, *suffixes: w.rlike("(?:" + "|".join(suffixes) + ")$")

    def start(w: Column) -> Column:
        marked = F.regexp_replace(F.regexp_replace(w, "^y", "Y"), "([aeiouy])y", "$1Y")
        special = F.when(F.length(w) <= 2, w).when(w.isin(*STEM_WORDS), F.element_at(F.create_map(*[F.lit(x) for pair in STEM_WORDS.items() for x in pair]), w))
        return F.struct(marked.alias("w"), special.alias("held"))

    def regions(x: Column) -> Column:
        w = x["w"]
        return F.struct(w.alias("w"), x["held"].alias("held"), F.when(w.rlike(_REGION), F.length(F.regexp_extract(w, _REGION, 0))).otherwise(F.length(w)).alias("p1"))

    def second_region(x: Column) -> Column:
        rest = F.substr(x["w"], x["p1"] + 1)
        return F.struct(x["w"].alias("w"), x["held"].alias("held"), x["p1"].alias("p1"), (x["p1"] + F.when(rest.rlike(f"{_V}{_C}"), F.length(F.regexp_extract(rest, f"^.*?{_V}{_C}", 0))).otherwise(F.length(rest))).alias("p2"))

    def changed(x: Column, w: Column, held: Column | None = None) -> Column:
        return F.struct(w.alias("w"), (x["held"] if held is None else F.coalesce(x["held"], held)).alias("held"), x["p1"].alias("p1"), x["p2"].alias("p2"))

    def plural(x: Column) -> Column:
        w = x["w"]
        return changed(x, F.when(ends(w, "sses"), cut(w, 2)).when(ends(w, "ied", "ies"), F.when(F.length(w) > 4, cut(w, 2)).otherwise(cut(w, 1))).when(ends(w, "us", "ss"), w).when(w.rlike(f"{_V}.+s$"), cut(w, 1)).otherwise(w))

    def tense(x: Column) -> Column:
        """Takes off -ed and -ing; what is left comes back marked, as the next step has to mend its end."""
        w = x["w"]
        s = F.regexp_extract(w, "^.*?(eedly|eed|ingly|edly|ing|ed)$", 1)
        rest = cut(w, F.length(s))
        eed = F.when(F.length(rest) >= x["p1"], F.concat(rest, F.lit("ee"))).otherwise(w)
        return changed(x, F.when(s.startswith("eed"), eed).when((s != "") & rest.rlike(_V), F.concat(rest, F.lit("|"))).otherwise(w), F.when(w.isin(*STEM_KEPT), w))

    def mended(x: Column) -> Column:
        w = cut(x["w"], 1)
        double = ends(w, *[2 * c for c in "bdfgmnprt"])
        end = F.when(ends(w, "at", "bl", "iz"), F.concat(w, F.lit("e"))).when(double, cut(w, 1)).when((x["p1"] >= F.length(w)) & w.rlike(_SHORT), F.concat(w, F.lit("e"))).otherwise(w)
        return changed(x, F.when(x["w"].endswith("|"), end).otherwise(x["w"]))

    def last_y(x: Column) -> Column:
        return changed(x, F.when(x["w"].rlike(f"^.+{_C}[yY]$"), F.concat(cut(x["w"], 1), F.lit("i"))).otherwise(x["w"]))

    def by_suffix(rules: dict[str, str], region: str, allowed) -> list:
        """The longest suffix of a word gives way if it lies in the region."""
        pattern = "^.*?(" + "|".join(sorted(rules, key=lambda r: (-len(r), r))) + ")$"
        to = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])

        def find(x: Column) -> Column:
            return F.struct(*[x[c].alias(c) for c in ("w", "held", "p1", "p2")], F.regexp_extract(x["w"], pattern, 1).alias("s"))

        def replace(x: Column) -> Column:
            w, s = x["w"], x["s"]
            good = (s != "") & (F.length(w) - F.length(s) >= x[region]) & allowed(x)
            return changed(x, F.when(good, F.concat(cut(w, F.length(s)), F.element_at(to, s))).otherwise(w))

        return [find, replace]

    def last_letters(x: Column) -> Column:
        w, n = x["w"], F.length(x["w"]) - 1
        e = w.endswith("e") & ((n >= x["p2"]) | ((n >= x["p1"]) & ~cut(w, 1).rlike(_SHORT)))
        return changed(x, F.when(e | (w.endswith("ll") & (n >= x["p2"])), cut(w, 1)).otherwise(w))

    steps = [
        start, regions, second_region, plural, tense, mended, last_y,
        *by_suffix(STEM_2, "p1", lambda x: ((x["s"] != "ogi") | x["w"].endswith("logi")) & ((x["s"] != "li") | x["w"].rlike("[cdeghkmnrt]li$"))),
        *by_suffix(STEM_3, "p1", lambda x: (x["s"] != "ative") | (F.length(x["w"]) - 5 >= x["p2"])),
        *by_suffix(dict.fromkeys(STEM_4, ""), "p2", lambda x: (x["s"] != "ion") | x["w"].rlike("[st]ion$")),
        last_letters, lambda x: F.coalesce(x["held"], F.lower(x["w"])),
    ]
    for step in steps:
        words = F.transform(words, step)
    return words


def key(kind: str, source: str | Column, lang: str | Column, name: Column) -> Column:
    """type:source:language:name; null when a part is null or empty."""
    parts = [F.lit(kind), *[F.lit(x) if isinstance(x, str) else x for x in (source, lang)], name]
    return let(F.array(*parts), lambda p: F.when(F.forall(p, lambda x: F.coalesce(x, F.lit("")) != ""), F.array_join(p, ":")))


def key_parts(k: Column) -> Column:
    """The four parts of a key; anything else is an error."""
    parts = F.split(k, ":")
    return F.when(k.isNull() | (F.size(parts) == 4), parts).otherwise(F.raise_error(F.concat(F.lit("not a key: "), k)).cast("array<string>"))


def parsed_title(name: Column, separators: tuple[str, ...] = (" at ", " for ")) -> Column:
    """The title itself: brackets off, cut at separators, then up to the first part that is more than prefix words."""
    out = squeeze(without_brackets(F.lower(strip_accents(name))))
    for s in separators:
        out = F.substring_index(out, s, 1)
    parts = F.filter(F.transform(F.split(out, r"(?:- | / |,)"), lambda p: squeeze(F.regexp_replace(p, r"[^a-z0-9&/\-'+#.]+", " "))), lambda p: p != "")
    is_prefix = lambda p: F.forall(F.split(p, " "), lambda w: w.isin(*TITLE_PREFIXES))
    state = F.struct(F.array().cast("array<string>").alias("taken"), F.lit(False).alias("done"))
    step = lambda s, p: F.struct(F.when(s["done"], s["taken"]).otherwise(F.array_append(s["taken"], p)).alias("taken"), (s["done"] | ~is_prefix(p)).alias("done"))
    return filled(F.array_join(F.aggregate(parts, state, step, lambda s: s["taken"]), " "))


def split_title(words: Column) -> Column:
    """struct<prefix, title>: leading prefix words and, reversed, trailing suffix words; and what is between."""
    def leading(words: Column, known: tuple[str, ...]) -> Column:
        count = lambda s, w: let(s["on"] & w.isin(*known), lambda on: F.struct((s["n"] + on.cast("int")).alias("n"), on.alias("on")))
        return F.aggregate(words, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), count, lambda s: s["n"])

    def cut(words: Column, lead: Column, back: Column) -> Column:
        """back: what stands behind the leading words, reversed."""
        ends = let(leading(back, TITLE_SUFFIXES), lambda tail: F.struct(
            F.array_join(F.concat(F.slice(words, F.lit(1), lead), F.slice(back, F.lit(1), tail)), " ").alias("prefix"),
            F.array_join(F.reverse(F.slice(back, tail + 1, F.size(back) - tail)), " ").alias("title")))
        return let(ends, lambda x: F.struct(*[F.when(x[c] != "", x[c]).alias(c) for c in ("prefix", "title")]))

    behind = lambda w, lead: F.reverse(F.slice(w, lead + 1, F.size(w) - lead))
    return let(words, lambda w: let(leading(w, TITLE_PREFIXES), lambda lead: let(behind(w, lead), lambda back: cut(w, lead, back))))


#: Skill words that a post's title keeps, and words before which it keeps any.
KEPT_SKILLS = ("software", "scrum", "business", "android", "ios", "engineering", "front-end", "frontend")
KEPT_BEFORE = ("engineer", "manager")


def without_skills(title: Column, skills: list[str], protect: tuple[str, ...] = KEPT_SKILLS, protect_before: tuple[str, ...] = KEPT_BEFORE) -> Column:
    """Drops skill words that are not protected and don't stand right before a protected word."""
    words = F.split(title, " ")
    skills = [w for w in skills if w not in protect]
    following = lambda i: F.coalesce(F.get(words, i + 1), F.lit(""))
    return F.nullif(F.array_join(F.filter(words, lambda w, i: ~w.isin(*skills) | following(i).isin(*protect_before)), " "), F.lit(""))


_ORDINAL = r"(\d(st|nd|rd|th)|first|second|third)"
#: How many ordinals and connectors may stand before "line".
_LINE_REACH = 4


def job_post_title(name: Column) -> Column:
    """A post's title, word by word: without the head count at either end, pay, contract length and support line.

    Each word is judged by itself and the words beside it, lower case and without the signs around it."""
    is_number = lambda w: w.rlike(r"^\d+$")
    level = lambda w: w.rlike(rf"^{_ORDINAL}([/&-]{_ORDINAL})*$")
    bare = lambda words: F.transform(words, lambda w: F.regexp_replace(F.lower(w), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    marked = lambda words: F.transform(words, lambda w: F.struct(w.alias("w"), is_number(w).alias("number"), level(w).alias("level")))

    def dropped(marks: Column, i: Column) -> Column:
        last = F.size(marks) - 1
        at = lambda k: F.coalesce(F.get(marks, k)["w"], F.lit(""))
        number, ordinal = (lambda k, c=c: F.coalesce(F.get(marks, k)[c], F.lit(False)) for c in ("number", "level"))

        def counted() -> Column:
            two = lambda k: (number(k) & (at(k + 1) == "x")) | ((at(k) == "x") & number(k + 1))
            alone = ((i == 0) | (i == last)) & at(i).rlike(r"^(x\d+|\d+x)$")
            return alone | ((i <= 1) & two(F.lit(0))) | ((i >= last - 1) & (last >= 1) & two(last - 1))

        def pay() -> Column:
            thousands = at(i).endswith("k") & at(i).rlike(r"^([a-z]{3})?\d[\d,.]*(k?[-–]\W?\d[\d,.]*)?k$")
            large = at(i).rlike(r"^\d{2,3},?\d{3}$") & F.length(F.regexp_replace(at(i), ",", "")).between(5, 6)
            up_to = lambda k: (at(k) == "up") & (at(k + 1) == "to") & at(k + 2).rlike(r"^\d{2,}")
            return thousands | large | up_to(i) | up_to(i - 1) | up_to(i - 2)

        def length() -> Column:
            months = lambda k: at(k + 1).isin("month", "months") & number(k) & (F.length(at(k)) <= 2)
            return months(i) | months(i - 1) | (months(i - 2) & (at(i) == "contract"))

        def line() -> Column:
            joint = lambda k: ordinal(k) | at(k).isin("", "and", "to")
            found, between = (at(i) == "line") & ordinal(i - 1), joint(i)
            for k in range(1, _LINE_REACH + 1):
                found = found | ((at(i + k) == "line") & between & ordinal(i + k - 1) & (ordinal(i) | ordinal(i - 1)))
                between = between & joint(i + k)
            return found

        return counted() | pay() | length() | line()

    kept = lambda words: let(marked(bare(words)), lambda marks: F.filter(words, lambda w, i: ~dropped(marks, i)))
    return F.array_join(let(F.split(squeeze(name), " "), kept), " ")


#: Letters of each degree, its name, and words that a degree's key loses.
DEGREES = (("b s c", "bachelor of science"), ("b a", "bachelor of arts"), ("b eng", "bachelor of engineering"), ("m s c", "master of science"), ("m a", "master of arts"), ("m b a", "master of business administration"), ("m phil", "master of philosophy"), ("ph d", "doctor of philosophy"))
DEGREE_STOP = ("degree", "hons", "honours", "honors", "first", "class")


def degree_name(name: Column, stop: tuple[str, ...] = (), **options) -> Column:
    """A degree in full: what stands before the first comma, its letters (with or without full stops and blanks between
    them) written out, years and ordinals off. "a" and "as" stay."""
    out = F.regexp_replace(F.lower(F.substring_index(name, ",", 1)), r"\b[0-9]+(st|nd|rd|th)?\b", "")
    for letters, full in DEGREES:
        out = F.regexp_replace(out, r"\b" + r"\.?\s*".join(letters.split(" ")) + r"\b", full)
    words = [w for w in stop if w not in ("a", "as")]
    return clean(out, nospace="'’.", brackets=True, stop=[*words, *DEGREE_STOP], **options)


def entity_key(kind: str, source: str | Column, lang: str | Column, name: Column, stop: tuple[str, ...] = ()) -> Column:
    """The key of any type of entity; an unknown type is an error. Sectors are keyed without stems."""
    stemmed = {"stop": stop, "stem_words": True}
    makers = {
        "skill": lambda: clean(name, replace=SKILL_SPELLINGS, brackets=True, distinct=True, **stemmed),
        "title": lambda: clean(split_title(F.split(parsed_title(name), " "))["title"], **stemmed),
        "job_title": lambda: clean(job_post_title(name), **stemmed),
        "company": lambda: company_name(name, list(stop)),
        "sector": lambda: clean(name, stop=stop),
        "institute": lambda: clean(F.regexp_replace(F.lower(name), r"\bu\.", "university"), order=True, **stemmed),
        "degree": lambda: degree_name(name, stop, stem_words=True),
        "subject": lambda: clean(F.substring_index(name, "/", 1), **stemmed),
    }
    if kind not in makers:
        raise ValueError(f"unknown type of entity: {kind}")
    return key(kind, source, lang, makers[kind]())


def company_name(name: Column, stop: list[str]) -> Column:
    """Legal forms and stop words off, cut at commas, dashes and slashes that stand free."""
    cut = F.substring_index(F.substring_index(F.substring_index(name, ",", 1), " - ", 1), " / ", 1)
    return clean(cut, keep="-/&", stop=[*stop, *LEGAL_FORMS])


def is_company(name: Column) -> Column:
    return F.arrays_overlap(tokens(name), F.lit(["limited", "ltd"]))


def first_number(text: Column) -> Column:
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("long")


#: Words that labels of rankings lose.
RANK_WORDS = ("rankings", "ranking", "ranks", "rank")


def without_words(text: Column, words: tuple[str, ...]) -> Column:
    """Whole words off, whatever their case."""
    return squeeze(F.regexp_replace(text, rf"(?i)\b(?:{'|'.join(words)})\b", ""))


def leading_digit(text: Column) -> Column:
    """The first character as a number ("3 years"); null if it is none."""
    return F.substring(F.trim(text), 1, 1).try_cast("int")


def points_range(text: Column) -> tuple[Column, Column]:
    """(low, high) of "104-120"; one number has no high, anything else gives nulls."""
    parts = F.split(F.trim(text), "-")
    return F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"(?s)<[^>]*>", "")


def posting_body(html: Column, elements: tuple[str, ...] = ("article", "p")) -> Column:
    """A posting's body: the description of a JSON-LD JobPosting, else of microdata, else the first of the given elements that
    has any text; empty when there is none."""
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    parsed = F.transform(blocks, lambda x: F.from_json(x, "`@type` string, description string"))
    linked = F.get(F.filter(parsed, lambda x: (x["@type"] == "JobPosting") & (F.coalesce(x["description"], F.lit("")) != "")), F.lit(0))["description"]
    micro = F.regexp_extract(html, r"""(?is)<(\w+)[^>]*\bitemprop=["']description["'][^>]*>(.*?)</\1>""", 2)
    plain = [F.regexp_extract(html, f"(?s)<{x}>(.*?)</{x}>", 1) for x in elements]
    return F.coalesce(linked, *[F.nullif(x, F.lit("")) for x in (micro, *plain)], F.lit(""))


def money(text: Column) -> Column:
    """Whole pounds of a display text; null for anything else. A trailing k is a thousand."""
    plain = F.lower(F.regexp_replace(text, "[£$€, ]", ""))
    value = F.regexp_replace(plain, "k$", "").try_cast("long")
    return F.when(plain.endswith("k"), value * 1000).otherwise(value)


def first_time(text: Column) -> Column:
    """A timestamp in one of the accepted shapes, null otherwise; `_` is a blank."""
    t = F.trim(F.translate(text, "_", " "))
    shapes = ("yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd HH", "yyyy-MM-dd")
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(s)) for s in shapes]).cast("timestamp_ntz")


def month_or_year(text: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(s)) for s in ("MMMM yyyy", "yyyy")]).cast("date")
