"""Scalar operators as Spark column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- predicates -------------------------------------------------------------


def between(value: Column, low=None, high=None, inclusive: bool = False) -> Column:
    """Range test; open where a bound is None; exclusive unless asked. Null is outside."""
    tests = []
    if low is not None:
        tests.append(value >= low if inclusive else value > low)
    if high is not None:
        tests.append(value <= high if inclusive else value < high)
    return all_of(value.isNotNull(), *tests)


def attribute(value: Column, expected) -> Column:
    """Equality with a value, or a predicate applied to the column."""
    return holds(expected(value) if callable(expected) else value == F.lit(expected))


def holds(test: Column) -> Column:
    """A test that is false instead of null."""
    return F.coalesce(test, F.lit(False))


def all_of(*tests: Column) -> Column:
    return reduce(lambda a, b: a & b, map(holds, tests), F.lit(True))


def any_of(*tests: Column) -> Column:
    return reduce(lambda a, b: a | b, map(holds, tests), F.lit(False))


def negated(test: Column) -> Column:
    return ~holds(test)


def text_matches(
    text: Column, pattern: str | None = None, equals: str | None = None, starts: str | None = None,
    ends: str | None = None, normalize: bool = False,
) -> Column:
    """All of the given tests on a text; the pattern may occur anywhere."""
    text = squeezed(text) if normalize else text
    tests = [text.isNotNull()]
    if equals is not None:
        tests.append(text == equals)
    if starts is not None:
        tests.append(text.startswith(starts))
    if ends is not None:
        tests.append(text.endswith(ends))
    if pattern is not None:
        tests.append(text.rlike(pattern))
    return all_of(*tests)


def metadata(values: Column, key: str, default) -> Column:
    """A map's value, or the default where the key or its value is missing."""
    return F.coalesce(F.try_element_at(values, F.lit(key)), F.lit(default))


# --- texts --------------------------------------------------------------------

SPACE = r"(?U)\s+"


def stripped(text: Column) -> Column:
    """Without any Unicode white space at the ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def squeezed(text: Column) -> Column:
    return stripped(F.regexp_replace(text, SPACE, " "))


def word_count(text: Column) -> Column:
    """Words parted by white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"(?U)\S+")), F.lit(0))


def is_upper(text: Column) -> Column:
    """At least one cased letter and no lower-case one."""
    return text.rlike(r"\p{Lu}") & ~text.rlike(r"[\p{Ll}\p{Lt}]")


def leading_capitals(text: Column) -> Column:
    """Capitals before the first lower-case letter."""
    return F.length(F.regexp_replace(F.regexp_extract(text, r"^[^\p{Ll}]*", 0), r"[^\p{Lu}]", ""))


#: Letters with marks of the languages at hand, and their plain forms.
MARKED = "áàâäãåčćçđðéèêëěíìîïłñńóòôöőõøřšśťúùûüűůýžźżÁÀÂÄÃÅČĆÇĐÐÉÈÊËĚÍÌÎÏŁÑŃÓÒÔÖŐÕØŘŠŚŤÚÙÛÜŰŮÝŽŹŻ"
PLAIN = "aaaaaacccddeeeeeiiiilnnooooooorsstuuuuuuyzzzAAAAAACCCDDEEEEEIIIILNNOOOOOOORSSTUUUUUUYZZZ"
assert len(MARKED) == len(PLAIN)


def unmarked(text: Column) -> Column:
    """Letters without their marks."""
    return F.translate(text, MARKED, PLAIN)


def ascii_slug(text: Column, fallback: str = "corpus") -> Column:
    """Lower-case ASCII letters and figures, all else one hyphen."""
    plain = F.regexp_replace(unmarked(text), r"[^\x00-\x7F]", "")
    slug = F.lower(F.regexp_replace(F.regexp_replace(plain, r"[^A-Za-z0-9]+", "-"), r"^-+|-+$", ""))
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit(fallback))


def short_slug(text: Column, limit: int = 28) -> Column:
    """A slug of bounded length without the text's leading number, `document`
    for nothing; a cut one ends with eight digits of a hash of the whole slug."""
    bare = F.regexp_replace(text, r"^\s*\d+\s*[.)\-]?\s*", "")
    slug = ascii_slug(bare, "document")
    head = F.regexp_replace(F.left(slug, F.lit(limit - 9)), "-+$", "")
    return F.when(F.length(slug) <= limit, slug).otherwise(F.concat(head, F.lit("-"), F.left(F.sha1(F.encode(slug, "UTF-8")), F.lit(8))))


def xml_id(text: Column, prefix: str = "id") -> Column:
    """A valid identifier: other characters become one hyphen; the prefix
    stands for nothing, and before a bad first character."""
    clean = F.regexp_replace(stripped(text), r"[^\p{L}\p{N}_.\-]", "-")
    clean = F.regexp_replace(F.regexp_replace(clean, "-+", "-"), "^-+|-+$", "")
    clean = F.coalesce(clean, F.lit(""))
    return F.when(clean == "", prefix).when(clean.rlike(r"^[\p{L}_]"), clean).otherwise(F.concat(F.lit(prefix + "-"), clean))


#: Characters that may not stand in XML.
UNFIT = r"[^\t\n\r\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"


def xml_safe(text: Column) -> Column:
    """Characters that XML forbids, as visible tokens (`[U+0001]`)."""
    token = lambda c: F.concat(F.lit("[U+"), F.lpad(F.hex(F.ascii(c)), F.lit(4), F.lit("0")), F.lit("]"))
    shown = F.array_join(F.transform(F.split(text, ""), lambda c: F.when(c.rlike(f"^{UNFIT}$"), token(c)).otherwise(c)), "")
    return F.when(text.rlike(UNFIT), shown).otherwise(text)


def safe_component(text: Column, limit: int = 100) -> Column:
    """A file name part: forbidden signs as hyphens, reserved names marked, a
    long one cut and ended with ten digits of a hash."""
    clean = F.regexp_replace(F.regexp_replace(text, r'[\x00-\x1f<>:"/\\|?*]', "-"), r"[ .]+$", "")
    clean = F.coalesce(F.nullif(F.trim(clean), F.lit("")), F.lit("document"))
    clean = F.when(F.upper(F.substring_index(clean, ".", 1)).rlike(r"^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])$"), F.concat(F.lit("_"), clean)).otherwise(clean)
    cut = F.concat(F.regexp_replace(F.left(clean, F.lit(limit - 11)), r"[ .]+$", ""), F.lit("-"), F.left(F.sha1(F.encode(clean, "UTF-8")), F.lit(10)))
    return F.when(F.length(clean) > limit, cut).otherwise(clean)


def two_digits(number: Column) -> Column:
    """At least two digits; longer numbers stay whole."""
    return F.when(F.length(number) < 2, F.lpad(number, F.lit(2), F.lit("0"))).otherwise(number)


def folder_key(label: Column) -> Column:
    """`3. name (1950-1954)` as `name-03`: the leading number as a suffix of
    two digits, a range of years at the end dropped."""
    bare = F.regexp_replace(label, r"\s*\(\s*\d{4}\s*[-–]\s*\d{4}\s*\)\s*$", "")
    number = F.regexp_extract(bare, r"^\s*(\d+)\s*[.)\-]\s*", 1)
    name = ascii_slug(F.regexp_replace(bare, r"^\s*\d+\s*[.)\-]\s*", ""))
    return F.when(number == "", name).otherwise(F.concat(name, F.lit("-"), two_digits(number)))


def file_stem(path: Column) -> Column:
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.regexp_replace(name, r"\.[^.]*$", "")


def component_stem(prefix: str, code: str, path: Column, date: Column) -> Column:
    """prefix-code_date-folder-number of a document's path; `undated` without
    a date, a slug where the file name has no leading number."""
    folder = F.regexp_extract(path, r"(?:^|/)([^/]+)/[^/]*$", 1)
    number = F.regexp_extract(file_stem(path), r"^\s*(\d+)", 1)
    last = F.when(number == "", short_slug(file_stem(path))).otherwise(two_digits(number))
    return F.concat_ws(
        "-", F.concat(F.lit(f"{prefix}-{code.upper()}_"), F.coalesce(date.cast("string"), F.lit("undated"))), folder_key(folder), last
    )


def visible(text: Column, limit: int = 80) -> Column:
    """Line breaks and tabs escaped; a longer text is cut and ends in dots."""
    for raw, seen in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(seen))
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit - 3)), F.lit("..."))).otherwise(text)


def query_escape(text: Column) -> Column:
    """For a quoted string of a graph query."""
    for raw, seen in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(seen))
    return text


def valid_code(text: Column) -> Column:
    """Two letters, then hyphened parts."""
    return text.rlike(r"^[A-Za-z]{2}(-[A-Za-z0-9]+)*$")


def valid_prefix(text: Column) -> Column:
    """Begins with an ASCII letter; single separators between parts."""
    return text.rlike(r"^[A-Za-z][A-Za-z0-9]*([._-][A-Za-z0-9]+)*$")


def title_case(text: Column) -> Column:
    """Capitals after everything that is no letter, small letters else."""
    chars = F.split(text, "")
    pairs = F.arrays_zip(chars.alias("c"), F.concat(F.array(F.lit(" ")), chars).alias("before"))
    cased = F.transform(F.filter(pairs, lambda p: p["c"].isNotNull()), lambda p: F.when(p["before"].rlike(r"^\p{L}$"), F.lower(p["c"])).otherwise(F.upper(p["c"])))
    return F.array_join(cased, "")


def casefold(text: Column) -> Column:
    """For comparing without regard to case: capitals first, so that ß is ss."""
    return F.lower(F.upper(text))


def word_core(word: Column) -> Column:
    return F.regexp_replace(word, r"[^0-9A-Za-zČŠŽĆĐčšžćđ]", "")


def compact_qualifier(text: Column) -> Column:
    """Whether the first brackets hold one to four letters and figures."""
    inside = F.length(F.regexp_replace(F.regexp_extract(text, r"\(([^)]*)\)", 1), r"[^\p{L}\p{N}]", ""))
    return holds(inside.between(1, 4))


def collapsed_letters(text: Column) -> Column:
    """Words of letters set apart joined: a run of three tokens at least, of one
    or two letters each, two of them single. A capital after a small letter, and
    what follows `dr`, begins a word."""
    tokens = F.transform(F.filter(F.split(text, r"(?U)\s+"), lambda t: t != ""), lambda t: F.struct(t.alias("t"), word_core(t).alias("c")))
    short = lambda x: F.length(x["c"]).between(1, 2)
    empty = F.expr("cast(array() as array<struct<t:string,c:string>>)")
    runs = F.aggregate(tokens, F.struct(F.expr("cast(array() as array<array<struct<t:string,c:string>>>)").alias("done"), empty.alias("run")), lambda s, x: F.when(
        short(x), F.struct(s["done"].alias("done"), F.array_append(s["run"], x).alias("run"))).otherwise(F.struct(
            F.array_append(F.when(F.size(s["run"]) > 0, F.array_append(s["done"], s["run"])).otherwise(s["done"]), F.array(x)).alias("done"), empty.alias("run"))))
    every = F.when(F.size(runs["run"]) > 0, F.array_append(runs["done"], runs["run"])).otherwise(runs["done"])
    spelled = lambda r: (F.size(r) >= 3) & (F.size(F.filter(r, lambda x: F.length(x["c"]) == 1)) >= 2)
    word = lambda r: F.regexp_replace(F.regexp_replace(F.array_join(F.transform(r, lambda x: x["c"]), ""), r"(?iu)^(dr)(?=\p{L}{2})", "$1 "), r"(?<=\p{Ll})(?=\p{Lu})", " ")
    return F.array_join(F.transform(every, lambda r: F.when(spelled(r), word(r)).otherwise(F.array_join(F.transform(r, lambda x: x["t"]), " "))), " ")


# --- dates ----------------------------------------------------------------------

# Month names, by language.
MONTH_NAMES = """
januar januarja januara siječanj siječnja january; februar februarja februara veljača veljače february;
marec marca mart marta ožujak ožujka march; april aprila travanj travnja; maj maja svibanj svibnja may;
junij junija jun juna lipanj lipnja june; julij julija jul jula srpanj srpnja july; avgust avgusta august kolovoz kolovoza;
september septembra septembar rujan rujna; oktober oktobra oktobar listopad listopada october;
november novembra novembar studeni studenoga; december decembra decembar prosinac prosinca
"""
MONTHS = {name: i for i, names in enumerate(MONTH_NAMES.split(";"), 1) for name in names.split()}
_NAMED = "|".join(sorted(MONTHS, key=lambda n: (-len(n), n)))


def _date(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", year, F.lpad(month, F.lit(2), F.lit("0")), F.lpad(day, F.lit(2), F.lit("0")))
    return F.try_to_date(F.nullif(text, F.lit("")), "yyyy-MM-dd")


def first_date(text: Column) -> Column:
    """The earliest valid date of a text: figures with the year first or last,
    or with a month's name; a day range gives its first day, a missing year
    comes from the rest of the text. Null if there is none."""
    iso = r"(?<!\d)((?:18|19|20)\d{2})[-./](\d{1,2})[-./](\d{1,2})(?!\d)"
    figures = r"(?<!\d)(\d{1,2})\.\s*(\d{1,2})\.\s*((?:18|19|20)\d{2})(?!\d)"
    named = rf"(?iu)(?<!\d)(\d{{1,2}})\.?(?:\s*[-–]\s*\d{{1,2}}\.?)?\s*({_NAMED})\b\.?\s*((?:18|19|20)\d{{2}})?"
    month = F.create_map(*[F.lit(x) for n, i in MONTHS.items() for x in (n, str(i))])
    every = lambda p, i: F.regexp_extract_all(text, F.lit(p), F.lit(i))

    def dates(kind: int, pattern: str, year: int, month_: int, day: int) -> Column:
        found = F.arrays_zip(every(pattern, 0).alias("all"), every(pattern, year).alias("y"), every(pattern, month_).alias("m"), every(pattern, day).alias("d"))

        def place(f: Column) -> Column:
            at = F.instr(text, f["all"])
            rest = F.substring(text, at + F.length(f["all"]), F.lit(64))
            later = F.regexp_extract(rest, r"(?<!\d)((?:18|19|20)\d{2})(?!\d)", 1)
            y = F.coalesce(F.nullif(f["y"], F.lit("")), later) if kind == 2 else f["y"]
            m = F.try_element_at(month, F.lower(f["m"])) if kind == 2 else f["m"]
            return F.struct(at.alias("at"), F.lit(kind).alias("kind"), _date(y, m, f["d"]).alias("date"))

        return F.filter(F.transform(found, place), lambda x: x["date"].isNotNull())

    return F.array_min(F.concat(dates(0, iso, 1, 2, 3), dates(1, figures, 3, 2, 1), dates(2, named, 3, 2, 1)))["date"]


# --- speakers ------------------------------------------------------------------

_TITLE = r"(?iu)^(?:(?:mag|dr|prof|inž|ing|tov|mr)\.\s*)+"
_OFFICE = r"(?iu)^(?:pod)?(?:predsednik|predsednica|predsedujoči|predsedujoča|predsjednik|predsednikov\w*|tajnik|minister|poročevalec|sekretar)\s+"
_OFFICES = r"(?iu)(podpredsedni|predsedni|predsedujoč|predsjedni|minist|sekretar|poročeval|poslan|delegat|tajni|zastopni|član)\p{L}*"


def label_organization(label: Column) -> Column:
    """The text in brackets at a label's end; null without."""
    return F.nullif(F.regexp_extract(label, r"\(([^()]+)\)\s*:?\s*$", 1), F.lit(""))


def label_role(label: Column) -> Column:
    """The office before the name, or after a comma; null without."""
    bare = F.regexp_replace(label, r"\s*\([^()]*\)\s*:?\s*$|:\s*$", "")
    before = F.nullif(F.trim(F.regexp_extract(bare, _OFFICE, 0)), F.lit(""))
    tail = F.trim(F.regexp_extract(bare, r",\s*(.+)$", 1))
    return F.coalesce(before, F.when(tail.rlike(_OFFICES), tail))


def label_name(label: Column) -> Column:
    """The name in a label: no brackets, colon, office or title."""
    bare = F.regexp_replace(label, r"\s*\([^()]*\)\s*:?\s*$|:\s*$", "")
    bare = F.when(F.regexp_extract(bare, r",\s*(.+)$", 1).rlike(_OFFICES), F.regexp_replace(bare, r",.*$", "")).otherwise(bare)
    return squeezed(F.regexp_replace(F.regexp_replace(bare, _OFFICE, ""), _TITLE, ""))


def forename(name: Column) -> Column:
    return F.when(name.contains(" "), F.substring_index(name, " ", 1)).otherwise(F.lit(""))


def surname(name: Column) -> Column:
    return F.when(name.contains(" "), F.regexp_replace(name, r"^\S+\s+", "")).otherwise(name)


def role_value(role: Column, default: str = "member") -> Column:
    """The first word of office in a role, or its first word; the default for none."""
    stem = F.regexp_extract(role, _OFFICES, 0)
    word = F.when(stem != "", stem).otherwise(F.regexp_extract(role, r"^\s*(\S+)", 1))
    clean = F.regexp_replace(F.lower(word), r"[^\p{L}\p{N}.\-]", "")
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit(default))


def org_id(organization: Column) -> Column:
    return F.concat(F.lit("org."), xml_id(organization, "UnknownOrganization"))


def speaker_ref(label: Column) -> Column:
    """`#` and the letters of the name before the first colon."""
    name = label_name(F.substring_index(label, ":", 1))
    return F.concat(F.lit("#"), xml_id(F.regexp_replace(name, r"[^\p{L}\p{N}]", ""), "Unknown"))


def menu_path(url: Column, host: str) -> Column:
    """The digits path after `menu` of an address of that host, or a bare
    path; null for other hosts, steps up, and addresses without it."""
    bare = F.when(url.rlike(r"^[A-Za-z]+://"), F.when(F.try_parse_url(url, F.lit("HOST")) == host, F.try_parse_url(url, F.lit("PATH")))).otherwise(url)
    parts = F.filter(F.split(bare, "/"), lambda p: p != "")
    at = F.array_position(parts, "menu")
    tail = F.when(at > 0, F.slice(parts, (at + 1).cast("int"), F.greatest(F.size(parts) - at, F.lit(0)).cast("int"))).when(~url.rlike(r"^[A-Za-z]+://"), parts)
    good = (F.size(tail) > 0) & ~F.exists(tail, lambda p: p.isin(".", ".."))
    return F.when(good, F.array_join(tail, "/"))
