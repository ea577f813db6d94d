"""Headers, lists and corpus files as XML text, built by expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from . import speakers


def escaped(text: Column) -> Column:
    """Text for element content and attributes; control signs as tokens."""
    text = C.xml_safe(text)
    for raw, seen in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(seen))
    return text


def element(tag: str, content: Column | None = None, always: bool = False, **attrs: Column) -> Column:
    """One element; null where content and attributes are, unless it is always
    wanted. Attributes that are null are left out. Content is XML already."""
    body = F.lit("") if content is None else F.coalesce(content, F.lit(""))
    given = F.concat_ws("", *[F.concat(F.lit(f' {k.replace("_", ":")}="'), escaped(v.cast("string")), F.lit('"')) for k, v in attrs.items()])
    made = F.concat(F.lit(f"<{tag}"), given, F.when(body == "", "/>").otherwise(F.concat(F.lit(">"), body, F.lit(f"</{tag}>"))))
    if always:
        return made
    some = F.lit(False) if content is None else content.isNotNull() & (content != "")
    for v in attrs.values():
        some = some | v.isNotNull()
    return F.when(some, made)


def joined(*parts: Column) -> Column:
    return F.concat_ws("", *parts)


def localized(tag: str, texts: Column) -> Column:
    """One element for each language of a map, ordered; empty without."""
    one = lambda p: F.concat(F.lit(f'<{tag} xml:lang="'), p["key"], F.lit('">'), escaped(p["value"]), F.lit(f"</{tag}>"))
    return F.coalesce(F.array_join(F.transform(F.array_sort(F.map_entries(texts)), one), ""), F.lit(""))


def meeting(labels: Column) -> Column:
    """The last label that names a term or meeting, with its number, as an element."""
    from .corpus import meeting_label, meeting_number

    label = meeting_label(labels)
    return element("meeting", escaped(label), n=meeting_number(label))


def header(titles: Column, sub: Column, meetings: Column, texts: Column, speeches: Column, words: Column, date: Column, language: Column, notes: Column | None = None) -> Column:
    """A document's header. Titles, extent, publication, source and language
    are always given; what repeats only where there is something. Measures of
    no speeches or words are left out."""
    title = joined(localized("title", titles), element("title", escaped(sub), type=F.when(sub.isNotNull(), "sub")))
    measure = lambda unit, n: F.concat(F.lit(f'<measure unit="{unit}" quantity="'), n.cast("string"), F.lit('"/>'))
    counted = lambda unit, n: F.when(F.coalesce(n, F.lit(0)) > 0, measure(unit, n))
    extent = joined(measure("texts", texts), counted("speeches", speeches), counted("words", words))
    described = joined(
        element("titleStmt", joined(title, meetings), always=True), element("extent", extent, always=True), element("publicationStmt", always=True),
        F.lit("") if notes is None else F.coalesce(notes, F.lit("")),
        element("sourceDesc", element("bibl", element("date", date.cast("string"), when=date.cast("string"))), always=True),
    )
    profile = element("profileDesc", element("langUsage", element("language", ident=language)), always=True)
    return element("teiHeader", joined(element("fileDesc", described, always=True), profile), always=True)


def enriched(existing: Column, inferred: Column) -> Column:
    """What is given, or else inferred, if blank."""
    return F.coalesce(F.nullif(F.trim(existing), F.lit("")), inferred)


def conversion_notes(messages: DataFrame, doc: str, kind: str, text: str, order: str) -> DataFrame:
    """doc, notes: recoveries and warnings of a document as one element of
    numbered notes, each text of a kind once, as first met."""
    firsts = messages.where(F.col(text).isNotNull()).groupBy(doc, kind, text).agg(F.min(order).alias("__at"))
    w = Window.partitionBy(doc).orderBy("__at", kind, text)
    rows = firsts.withColumn("n", F.row_number().over(w))
    note = element("note", escaped(F.col(text)), type=F.col(kind), n=F.col("n"))
    listed = F.array_sort(F.collect_list(F.struct("n", note.alias("x"))))
    return rows.groupBy(doc).agg(element("notesStmt", F.array_join(F.transform(listed, lambda r: r["x"]), ""), always=True).alias("notes"))


def list_person(people: DataFrame, by: list[str], ref: str, label: str) -> DataFrame:
    """by..., xml: the speakers of a scope, ordered by id, each with name and
    affiliation; a scope none of whose rows has a speaker gets the unknown one."""
    rows = speakers.list_person(people.where(F.col(ref).isNotNull() & F.col(label).isNotNull()), by, ref, label).groupBy(*by, "id").agg(F.min(F.struct("name", "role", "organization", "org_id")).alias("r"))
    member = element("affiliation", escaped(F.col("r.organization")), always=True, role=F.col("r.role"), ref=F.concat(F.lit("#"), F.col("r.org_id")))
    one = element("person", joined(element("persName", escaped(F.col("r.name"))), F.when(F.col("r.organization").isNotNull(), member)), always=True, xml_id=F.col("id"))
    listed = F.array_sort(F.collect_list(F.struct("id", one.alias("x"))))
    lists = rows.groupBy(*by).agg(F.array_join(F.transform(listed, lambda r: r["x"]), "").alias("x"))
    unknown = F.lit('<person xml:id="UnknownSpeaker"><persName>Unknown speaker</persName></person>')
    scopes = people.select(*by).distinct()
    return scopes.join(lists, by, "left").select(*by, element("listPerson", F.coalesce("x", unknown), always=True).alias("xml"))


def list_org(rows: DataFrame, by: list[str], organization: str, ord: Column) -> DataFrame:
    """by..., xml: the bodies of a scope, ordered by id."""
    bodies = speakers.list_org(rows, organization, ord, by)
    one = element("org", element("orgName", escaped(F.col("name"))), always=True, xml_id=F.col("org_id"))
    listed = F.array_sort(F.collect_list(F.struct("org_id", one.alias("x"))))
    return bodies.groupBy(*by).agg(element("listOrg", F.array_join(F.transform(listed, lambda r: r["x"]), ""), always=True).alias("xml"))


def person_entries(records: DataFrame) -> DataFrame:
    """p, xml: records of a register (speakers.person_records) as persons with
    all that is known: dates, sex, occupations, nationalities, bodies, numbers."""
    each = lambda c, f: F.array_join(F.transform(c, f), "")
    plain = lambda tag: lambda v: F.concat(F.lit(f"<{tag}>"), escaped(v), F.lit(f"</{tag}>"))
    dated = lambda tag: lambda v: F.concat(F.lit(f'<{tag} when="'), escaped(v), F.lit('"/>'))
    number = lambda kind: lambda v: F.concat(F.lit(f'<idno type="{kind}">'), escaped(v), F.lit("</idno>"))
    body = lambda a: F.concat(F.lit("<affiliation"), F.coalesce(F.concat(F.lit(' ref="'), escaped(a["party"]), F.lit('"')), F.lit("")), F.lit(">"), F.coalesce(escaped(a["party_label"]), F.lit("")), F.lit("</affiliation>"))
    known = F.filter("affiliations", lambda a: a["party_label"].isNotNull() | a["party"].isNotNull())
    return records.select("p", joined(
        element("persName", escaped(F.col("name"))), element("idno", escaped(F.col("p")), type=F.lit("URI")), each("viaf", number("VIAF")), each("gnd", number("GND")), each("isni", number("ISNI")),
        each("births", dated("birth")), each("deaths", dated("death")), element("sex", value=F.col("sex")), each("occupations", plain("occupation")), each("nationalities", plain("nationality")), each(known, body),
    ).alias("xml"))


def owner(folder: Column) -> Column:
    """Where a folder's corpus file lies: in the folder above; the root's in itself."""
    return F.when(F.coalesce(folder, F.lit("")) == "", "").otherwise(F.regexp_extract(folder, r"^(.*)/[^/]*$", 1))


def relative(path: Column, base: Column) -> Column:
    """A path relative to a folder above it, or as it is."""
    return F.when((base != "") & path.startswith(F.concat(base, F.lit("/"))), F.substring(path, F.length(base) + 2, F.length(path))).otherwise(path)


def corpus_files(totals: DataFrame, children: DataFrame, people: DataFrame | None = None) -> DataFrame:
    """folder, xml: a corpus file for each folder with its subtree's totals
    (corpus.rollup: folder, texts, words), lists of bodies and persons, and
    inclusions of what lies directly in it (folder, href)."""
    inside = F.array_sort(F.collect_list(F.col("href")))
    links = children.groupBy("folder").agg(F.array_join(F.transform(inside, lambda h: F.concat(F.lit('<xi:include href="'), escaped(h), F.lit('"/>'))), "").alias("links"))
    measure = lambda unit, n: F.concat(F.lit(f'<measure unit="{unit}" quantity="'), n.cast("string"), F.lit('"/>'))
    extent = element("extent", joined(measure("texts", F.col("texts")), F.when(F.col("words") > 0, measure("words", F.col("words")))), always=True)
    head = element("teiHeader", element("fileDesc", extent, always=True), always=True)
    lists = F.lit('<xi:include href="listOrg.xml"/><xi:include href="listPerson.xml"/>') if people is None else F.lit("")
    head = joined(head, element("particDesc", lists, always=True))
    return totals.join(links, "folder", "left").select("folder", element("teiCorpus", joined(head, F.col("links")), always=True).alias("xml"))


def forest(folders: DataFrame, root: bool) -> DataFrame:
    """Which corpus files are written: all below the root, the root's too if
    asked for or if documents lie loose in it (folder, depth, loose)."""
    return folders.where(F.col("depth") > 0) if not root else folders


def failure_document(source: Column, message: Column) -> Column:
    """A document for one that failed: header, a note, the text as unparsed."""
    title = element("title", escaped(source))
    notes = element("notesStmt", element("note", escaped(message), type=F.lit("recovery"), n=F.lit(1)), always=True)
    head = element("teiHeader", element("fileDesc", joined(element("titleStmt", title, always=True), notes), always=True), always=True)
    body = element("body", element("p", escaped(F.coalesce(message, F.lit(""))), always=True, type=F.lit("unparsed")), always=True)
    return element("TEI", joined(head, element("text", body, always=True)), always=True)
