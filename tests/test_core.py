"""Core operators on small tables, with nulls, ties, empty tables and clashing names."""

import io
import itertools
import random
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from foliospark import api
from foliospark.functions import columns as C
from foliospark.operators import corpus, footnotes, headers, jobs, layout, pages, speakers, structure
from foliospark.operators.carry import carry_last
from foliospark.plans import cascade, rules, volumes
from foliospark.sources import pdf, readers, writers
from foliospark.streaming.incremental import incremental, sessions, windowed_counts


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize(
    ("text", "date"),
    [
        ("13.-14. junija.1950", "1950-06-13"), ("14. februarja - 16. februarja 1949", "1949-02-14"), ("Meeting 21.10.1949", "1949-10-21"),
        ("Meeting 7 February 1962", "1962-02-07"), ("31. 2. 1950 in 1951-03-04", "1951-03-04"), ("nič", None), ("", None), (None, None),
    ],
)
def test_first_date(spark, text, date):
    got = spark.createDataFrame([(text,)], "t string").select(C.first_date(F.col("t")).cast("string")).first()[0]
    assert got == date


def test_text_functions(spark):
    df = spark.createDataFrame([("Člen 1.", "  Đuro  Ž\x01 "), (None, None), ("", "")], "a string, b string")
    got = df.select(
        C.ascii_slug(F.col("a")), C.xml_id(F.col("a")), C.xml_safe(F.col("b")), C.squeezed(F.col("b")), C.word_count(F.col("b")), C.leading_capitals(F.col("a")),
    ).collect()
    assert tuple(got[0]) == ("clen-1", "Člen-1.", "  Đuro  Ž[U+0001] ", "Đuro Ž\x01", 2, 1)
    assert got[1][0] == "corpus" and got[1][1] == "id" and got[1][4] == 0
    assert got[2][0] == "corpus" and got[2][3] == ""


def test_selectors_are_never_null(spark):
    df = spark.createDataFrame([(None, None), (5.0, "ab")], "v double, t string")
    got = df.select(C.between(F.col("v"), 5), C.between(F.col("v"), 5, inclusive=True), C.text_matches(F.col("t"), starts="a"), C.negated(F.col("v") > 1)).collect()
    assert [tuple(r) for r in got] == [(False, False, False, True), (False, True, True, False)]


def test_names_of_files_and_folders(spark):
    path = "Mandat/1. sklic (1947-1950)/01 - Zasedanje.pdf"
    df = spark.createDataFrame([(path, "con.txt", "x" * 200)], "p string, f string, l string")
    got = df.select(C.component_stem("Corpus", "si", F.col("p"), F.lit(None).cast("date")), C.safe_component(F.col("f")), F.length(C.safe_component(F.col("l"))), F.length(C.short_slug(F.col("l")))).first()
    assert got[0] == "Corpus-SI_undated-sklic-01-01"
    assert got[1] == "_con.txt" and got[2] <= 100 and got[3] <= 28


def test_menu_path(spark):
    rows = [("https://h.org/a/menu/1/7/397",), ("1/7",), ("../x",), ("https://other.org/menu/1",), (None,)]
    got = spark.createDataFrame(rows, "u string").select(C.menu_path(F.col("u"), "h.org")).collect()
    assert [r[0] for r in got] == ["1/7/397", "1/7", None, None, None]


def test_labels(spark):
    rows = [("PREDSEDNIK dr. Zoran Polič (SR Slovenija):",), ("Ana Kovač, sekretar za promet:",), ("Kovač:",), ("",)]
    df = speakers.details(spark.createDataFrame(rows, "label string"), "label")
    got = [tuple(r) for r in df.select("lookup_name", "role", "organization", C.role_value(F.col("role"))).collect()]
    assert got[0] == ("Zoran Polič", "PREDSEDNIK", "SR Slovenija", "predsednik")
    assert got[1] == ("Ana Kovač", "sekretar za promet", None, "sekretar")
    assert got[2] == ("Kovač", None, None, "member") and got[3][0] == ""


def test_carry_last_equals_a_loop(spark):
    random.seed(1)
    rows = [(d, p, i, random.choice([None, None, None, p * 100 + i])) for d in ("a", "b") for p in random.sample(range(900), 60) for i in range(3)]
    rows += [("c", None, 0, 7), ("c", 3, 0, None)]
    df = spark.createDataFrame(rows, "doc string, page int, idx int, v int")
    for before in (False, True):
        got = {(r.doc, r.page, r.idx): r.c for r in carry_last(df, "doc", "page", ["idx"], F.col("v"), "c", block=4, before=before).collect()}
        for d, part in itertools.groupby(sorted(rows, key=lambda r: (r[0], -1 if r[1] is None else r[1], r[2])), key=lambda r: r[0]):
            last = None
            for _, p, i, v in part:
                if before:
                    assert got[d, p, i] == last
                last = v if v is not None else last
                if not before:
                    assert got[d, p, i] == last


def test_islands_and_lines(spark):
    rows = [("d", 0, "A", 10.0, 100.0), ("d", 1, "A", 10.0, 100.4), ("d", 2, None, 10.0, 88.0), ("d", 3, None, 10.0, 88.0), ("d", 4, "A", 9.0, 88.0)]
    df = spark.createDataFrame(rows, "doc string, seq int, font string, size double, y double")
    assert [r.island for r in layout.islands(df, ["doc"], ["seq"], ["font", "size"]).orderBy("seq").collect()] == [0, 0, 1, 1, 2]
    assert [r.line_id for r in layout.line_groups(df, ["doc"], ["seq"], "y", 2.0).orderBy("seq").collect()] == [0, 0, 1, 1, 1]
    assert layout.islands(df.limit(0), ["doc"], ["seq"], ["font"]).count() == 0


def test_block_islands_and_sums_equal_a_loop(spark):
    random.seed(4)
    rows = [(d, i, random.choice("ab"), random.choice([None, 1, 2])) for d in ("x", "y", None) for i in range(60)]
    df = spark.createDataFrame(rows, "doc string, i int, v string, n int").withColumn("block", F.floor(F.col("i") / 7))
    from foliospark.operators.carry import carry_sum

    sums = {(r.doc, r.i): r.s for r in carry_sum(df, "doc", "block", ["i"], F.col("n"), "s", block=3).collect()}
    got = {(r.doc, r.i): r.island for r in layout.block_islands(df, "doc", "block", ["i"], ["v"]).collect()}
    for d in ("x", "y", None):
        mine, island, total = [r for r in rows if r[0] == d], 0, 0
        for k, r in enumerate(mine):
            island += k > 0 and mine[k - 1][2] != r[2]
            total += r[3] or 0
            assert got[d, r[1]] == island and sums[d, r[1]] == total
    assert layout.block_islands(df.limit(0), "doc", "block", ["i"], ["v"]).count() == 0
    kept = layout.take_while(df, ["doc"], ["i"], F.col("i") == 5)
    assert kept.count() == 15 and layout.take_while(df, ["doc"], ["i"], F.lit(None).cast("boolean")).count() == 180


def test_anchor_clusters_equal_a_loop(spark):
    random.seed(2)
    xs = [round(random.uniform(0, 60), 1) for _ in range(40)]
    df = spark.createDataFrame([("p", i, x) for i, x in enumerate(xs)] + [("p", 99, None)], "page string, i int, x double")
    got = dict(values(layout.anchor_clusters(df, ["page"], "x", "i", 6.0), "i", "anchor"))
    anchor = None
    for x, i in sorted((x, i) for i, x in enumerate(xs)):
        if anchor is None or abs(x - anchor) > 6:
            anchor = x
        assert got[i] == anchor
    assert 99 not in got


def test_merged_runs(spark):
    run = "struct<text:string,x:double,y:double,font_name:string,font_size:double,space_before:boolean>"
    runs = [("A", 0.0, 0.0, "F", 12.0, False), ("B", 1.0, 0.0, "F", 10.0, True), ("C", 2.0, 0.03, "F", 10.04, True), ("1", 3.0, 2.0, "F", 10.0, False)]
    df = spark.createDataFrame([(runs,), (runs[:2],), ([],), (None,)], f"runs array<{run}>").select(layout.merged_runs(F.col("runs")).alias("m"))
    got = [None if r.m is None else [x.text for x in r.m] for r in df.collect()]
    assert got == [["A", "B C", "1"], ["A", "B"], [], None]


def test_dehyphenated(spark):
    rows = [("d", 0, "be-", False), ("d", 1, "12", True), ("d", 2, "seda", False), ("d", 3, None, False)]
    df = layout.dehyphenated(spark.createDataFrame(rows, "doc string, i int, t string, out boolean").withColumn("page", F.floor(F.col("i") / 2)), "doc", "page", ["i"], "t", F.col("out")).orderBy("i")
    assert [(r.text_joined, r.space_before) for r in df.collect()] == [("be", False), ("12", False), ("seda", False), (None, True)]


def test_page_ranges(spark):
    got = spark.range(1).select(layout.page_ranges(F.lit(0), F.lit(10), 4), layout.page_ranges(F.lit(0), F.lit(2), 4), layout.page_ranges(F.lit(3), F.lit(3), 4)).first()
    assert [tuple(r) for r in got[0]] == [(0, 3), (3, 6), (6, 8), (8, 10)]
    assert [tuple(r) for r in got[1]] == [(0, 1), (1, 2)] and got[2] == []


def test_page_automaton_equals_a_loop(spark):
    random.seed(3)
    keys = ("session", "debate", "cue", "index", "appendix")
    rows = [(d, p, *[random.random() < 0.2 for _ in keys]) for d in range(20) for p in range(12)]
    got = {(r.doc, r.page): r for r in pages.page_automaton(spark.createDataFrame(rows, f"doc int, page int, {', '.join(k + ' boolean' for k in keys)}"), "doc", "page").collect()}
    for d in range(20):
        seen = active = index = back = False
        for row in (r for r in rows if r[0] == d):
            m = dict(zip(keys, row[2:]))
            seen |= m["session"]
            strong = m["debate"] and m["cue"]
            resume = strong if back else m["debate"] or (seen and m["cue"])
            back = True if m["appendix"] else False if strong else back
            active |= resume
            index = True if m["index"] else False if resume else index
            r = got[d, row[1]]
            assert (r.seen_session, r.back_matter, r.speaker_index) == (active, back, index)
            assert r.structure_active == (active and not index and not back)


def test_rules(spark):
    t = F.col("text")
    group = rules.RuleGroup([rules.Rule("A", t.startswith("a")), rules.Rule("AB", t.startswith("ab")), rules.Rule("E", rules.FALLBACK)])
    df = spark.createDataFrame([("abc",), ("x",), ("",), (None,)], "text string").select(group.first_match(t).alias("r"))
    assert [r.r for r in df.collect()] == ["A", "E", None, None]
    with pytest.raises(ValueError):
        rules.RuleGroup([rules.Rule("A", t == "a"), rules.Rule("A", t == "b")])
    with pytest.raises(TypeError):
        rules.RuleGroup([rules.Rule("A", "no column")])


def test_trees(spark):
    rows = [("d", 1, "Ana:", "S"), ("d", 2, "Hvala <lepa>.", None), ("d", 3, "še -", None), ("d", 4, "Miha:", "S"), ("d", 5, None, None), ("d", 6, "x", "BAD"), ("e", 1, "", None)]
    chunks = spark.createDataFrame(rows, "doc string, seq int, text string, rule string")
    actions = {"S": (("pop_to", "body"), ("push", "note", {"type": "speaker"}), ("append",), ("pop",), ("push", "u", {"n": "{seq}"})), "BAD": (("fly",),)}
    nodes = structure.build_trees(chunks, "doc", ["seq"], "rule", actions)
    xml = dict(values(structure.serialized(nodes, "doc"), "doc", "xml"))
    root = ElementTree.fromstring(xml["d"])
    assert [u.get("n") for u in root.findall("u")] == ["1", "4"]
    assert root.find("u").text == "Hvala &lt;lepa&gt;. še -".replace("&lt;", "<").replace("&gt;", ">")
    assert root.findall("u")[1].find("seg").get("type") == "unparsed"
    assert "e" not in xml or xml["e"] == "<body></body>"
    assert values(structure.extents(nodes, "doc"), "doc", "speeches")[0] == ("d", 2)


def test_ids(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a-2"), (4, "a")], "k int, b string")
    ids = values(structure.unique_ids(df, [], ["k"], F.col("b")), "id")
    assert len(set(ids)) == 4
    chain = [(1, "a"), (2, "a"), (3, "a-2"), (4, "a-2-2"), (5, "a"), (6, None), (7, None), (8, "b"), (9, "b")]
    made = {r.k: r.id for r in structure.unique_ids(spark.createDataFrame(chain, "k int, b string"), [], ["k"], F.col("b")).collect()}
    assert [made[k] for k in (1, 2, 3, 4, 5, 8, 9)] == ["a", "a-2", "a-2-2", "a-2-2-2", "a-3", "b", "b-2"]
    notes = spark.createDataFrame([("d", 1, 0, 1), ("d", 1, 1, 2), ("d", 1, 1, 3)], "doc string, number int, page int, seq int")
    assert [r.id for r in structure.footnote_ids(notes, "doc", "number", "page", ["seq"]).orderBy("seq").collect()] == ["note1", "note1-p2", "note1-p2-2"]


def test_rollup(spark):
    rows = [("Mandate/Sub1/a", 3, 100), ("Mandate/Sub1/b", 5, 200), ("Mandate/Sub2/c", 2, 50), ("Mandate/d", 1, 10), (None, None, None)]
    df = spark.createDataFrame(rows, "path string, speeches int, words int")
    got = {r.folder: (r.texts, r.speeches, r.words) for r in corpus.rollup(df, "path", ["speeches", "words"]).collect()}
    assert got["Mandate"] == (4, 11, 360) and got["Mandate/Sub1"] == (2, 8, 300) and got[""] == (5, 11, 360)
    tree = {r.folder: (r.parent, r.n_children) for r in corpus.folder_tree(df, "path").collect()}
    assert tree == {"Mandate": ("", 2), "Mandate/Sub1": ("Mandate", 0), "Mandate/Sub2": ("Mandate", 0)}


def test_increments(spark):
    jobs = spark.createDataFrame([("a", "1"), ("b", "2"), (None, "3")], "source string, fingerprint string")
    done = spark.createDataFrame([("a", "1", "ok"), ("b", "2", "failed")], "source string, fingerprint string, status string")
    assert values(corpus.pending(jobs, done), "source") == [("b",), (None,)]
    assert values(corpus.stale(jobs, done.where("source = 'a'"), done.limit(0), "source"), "source") == [("b",), (None,)]
    assert tuple(corpus.manifest(done, []).first()) == (1, 0, 1, 0, 2)


def test_merged_mapping(spark):
    rows = [("#A", "A#?:", 1), ("#A", "Ana A (X):", 2), ("#A", "Ana A (X):", 3), (None, "x", 4), ("#B", None, 5)]
    df = spark.createDataFrame(rows, "ref string, label string, ord int")
    assert values(speakers.merged_mapping(df, "ref", "label", F.col("ord")), "ref", "label", "n") == [("#A", "Ana A (X):", 3)]
    clusters = spark.createDataFrame([("d", "#FerdoKozak", 1), ("d", "#LerdoKozak", 2), ("d", "#MihaMarinko", 3), ("d", "#MilanMarinko", 4), ("d", None, 5)], "doc string, ref string, ord int")
    assert dict(values(speakers.alias_clusters(clusters, "doc", "ref", "ord"), "ref", "leader"))["#LerdoKozak"] == "#FerdoKozak"


def test_docx(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = f"""<w:document {w}><w:body><w:p><w:pPr><w:framePr w:x="100" w:y="20" w:w="50" w:h="9"/><w:jc w:val="center"/></w:pPr>
      <w:r><w:rPr><w:b/></w:rPr><w:t>Seja</w:t></w:r><w:r><w:rPr><w:b w:val="0"/><w:vertAlign w:val="superscript"/></w:rPr><w:t>1</w:t></w:r></w:p><w:p><w:r><w:t>no frame</w:t></w:r></w:p></w:body></w:document>"""
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", body)
    (tmp_path / "a.DOCX").write_bytes(data.getvalue())
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    (tmp_path / "c.txt").write_bytes(b"other")
    files = readers.discover(spark, [str(tmp_path)])
    assert files.count() == 2
    rows = readers.docx_runs(files).orderBy("path", "run").collect()
    assert [(r.text, r.bold, r.superscript, r.x, r.alignment) for r in rows if r.error is None] == [("Seja", True, False, 100.0, "center"), ("1", False, True, 100.0, "center")]
    assert sum(r.error is not None for r in rows) == 1
    assert all(r.error for r in readers.pdf_glyphs(files).collect())


def test_sidecars(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.json").write_text('{"data": {"speakers": {"#A": "Ana:"}}}')
    (tmp_path / "j/b.json").write_text('{"#B": "Bor:"}')
    (tmp_path / "j/c.json").write_text("no json")
    assert values(readers.json_speakers(spark, str(tmp_path / "j")), "speaker_ref", "label") == [("#A", "Ana:"), ("#B", "Bor:")]
    (tmp_path / "x").mkdir()
    (tmp_path / "x/a.xml").write_text('<TEI xmlns="urn:x"><extent><measure unit="words" quantity="5"/><measure unit="words" quantity="2"/></extent></TEI>')
    assert values(readers.xml_extents(spark, str(tmp_path / "x")), "unit", "quantity") == [("words", 7)]
    done = writers.write_files(spark.createDataFrame([("s/a.xml", "<a/>")], "name string, text string"), "name", "text", str(tmp_path / "out"))
    assert values(done, "name", "bytes") == [("s/a.xml", 4)] and (tmp_path / "out/s/a.xml").read_text() == "<a/>"


def test_streams(spark, tmp_path):
    src = str(tmp_path / "src")
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id int, text string")
    df.write.parquet(src)
    count = lambda d: d.select("doc_id", C.word_count(F.col("text")).alias("n"))
    for _ in range(2):
        incremental(spark, src, df.schema, count, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert values(spark.read.parquet(str(tmp_path / "out")), "doc_id", "n") == [(1, 2), (2, 0)]
    events = spark.createDataFrame([("2024-01-01 00:00:00", 1), ("2024-01-01 00:20:00", 1), ("2024-01-01 02:00:00", 1)], "at string, u int").withColumn("at", F.to_timestamp("at"))
    assert values(sessions(events, "at", "u"), "n") == [(1,), (2,)]
    assert values(windowed_counts(events, "at", ["u"]), "n") == [(1,), (2,)]


def test_word_lines_equal_a_loop(spark):
    random.seed(8)
    words = [("p", i, random.choice([0.0, 2.0, 4.0, 12.0, 14.0]), random.choice([7.0, 10.0])) for i in range(40)]
    df = spark.createDataFrame([*words, ("p", 99, None, 1.0)], "page string, i int, top double, size double")
    got = dict(values(layout.word_lines(df, ["page"], "i", "top", "size"), "i", "line"))
    anchor, line = None, -1
    for _, i, top, size in words:
        if anchor is None or abs(top - anchor) > 3.2:
            anchor, line = top, line + 1
        elif size >= 9:
            anchor = top
        assert got[i] == line
    assert 99 not in got


def test_headers_and_packages(spark, tmp_path):
    df = spark.createDataFrame([("a", 2, 0), ("b", None, 5)], "k string, texts int, words int")
    assert values(corpus.extent_header(df, "k", {"texts": "texts", "words": "words"}), "header")[0] == ('<extent><measure unit="texts" quantity="0"/><measure unit="words" quantity="5"/></extent>',)
    maps = spark.createDataFrame([("a", {"sl": "A&B", "en": "C"}), ("b", None)], "k string, m map<string,string>")
    assert values(corpus.localized(maps, "k", "title", F.col("m")), "k", "xml") == [("a", '<title xml:lang="en">C</title><title xml:lang="sl">A&amp;B</title>'), ("b", "")]
    (tmp_path / "c").mkdir()
    (tmp_path / "c/a.xml").write_text("<a/>")
    (tmp_path / "c/b.json").write_text("{}")
    assert writers.package(str(tmp_path / "c"), str(tmp_path / "c.zip")) == 1
    assert zipfile.ZipFile(tmp_path / "c.zip").namelist() == ["a.xml"]


def test_numbers_of_three_digits(spark):
    df = spark.createDataFrame([("1. sklic/123 seja.pdf",), ("1. sklic/124 seja.pdf",), ("123. sklic/7 seja.pdf",)], "p string")
    stems = [r[0] for r in df.select(C.component_stem("c", "si", F.col("p"), F.lit(None).cast("date"))).collect()]
    assert stems == ["c-SI_undated-sklic-01-123", "c-SI_undated-sklic-01-124", "c-SI_undated-sklic-123-07"]
    slugs = spark.createDataFrame([("12. Seja zbora",), ("***",), (None,)], "t string").select(C.short_slug(F.col("t")), C.safe_component(F.col("t"))).collect()
    assert [r[0] for r in slugs] == ["seja-zbora", "document", "document"] and slugs[2][1] == "document"


def test_xml_safe_covers_all_unfit_characters(spark):
    df = spark.createDataFrame([("a\x0bb\ufffec\uffffd\t\U0001f600",), (None,), ("",)], "t string").select(C.xml_safe(F.col("t")))
    assert [r[0] for r in df.collect()] == ["a[U+000B]b[U+FFFE]c[U+FFFF]d\t\U0001f600", None, ""]
    assert structure.printable("a\x0b\ufffe") == "a[U+000B][U+FFFE]"


@pytest.mark.parametrize(
    ("label", "person"),
    [
        ("Predsednik Ivan Novak", True), ("Ana Kovač, sekretar za promet", True), ("P i r n a t Jože", True), ("Predsednik vlade je predložil", False), ("Uradni list SRS", False),
        ("Drago Sotler za člane pa", False), ("Ivan Novak; Ana Kovač", False), ("(opomba)", False), ("SKLEPI IN PREDLOGI ODBORA", False), ("g o v o r n i k", False), ("Ivan Novak, Ana Kovač in Jože Rus", False), ("", False),
    ],
)
def test_person_like(spark, label, person):
    assert spark.createDataFrame([(label,)], "l string").select(cascade.person_like(F.col("l"))).first()[0] is person
    assert spark.createDataFrame([(None,)], "l string").select(cascade.person_like(F.col("l"))).first()[0] is False


RUN = "array<struct<text:string,x:double,y:double,font_name:string,font_size:double,space_before:boolean>>"


def volume(spark, *texts, doc="d"):
    """Lines: text, or (text, x, y, size, font)."""
    out = []
    for i, t in enumerate(texts):
        text, x, y, size, font = t if isinstance(t, tuple) else (t, 72.0, 700.0 - 12 * i, 10.0, "F")
        out.append((doc, 0, i, text, x, y, None if x is None else x + 100, size, [(text, x, y, font, size, False)], 480.0, 760.0))
    return spark.createDataFrame(out, f"doc_id string, page_num int, line_idx int, text string, x double, y double, x_end double, font_size double, runs {RUN}, page_width double, page_height double")


def test_cascade(spark):
    lines = volume(
        spark, ("3. SEJA", 200.0, 680.0, 14.0, "F"), ("(23. aprila 1957)", 200.0, 660.0, 10.0, "F"), "Predsedoval je Ivan Novak", "Zapisnikar: Ana Kovač", "Začetek seje ob 9. uri",
        "Predsednik Ivan Novak: Začenjam sejo.", "in nadaljujem", ("Nov odstavek govora.", 86.0, 560.0, 10.0, "F"), ("(Ploskanje.)", 86.0, 548.0, 10.0, "F"), "Vrsta po opombi",
        "Ana Kovač:", "Hvala.", ("1 Glej zakon o cestah.", 72.0, 90.0, 7.0, "F"), ("nadaljevanje opombe", 72.0, 80.0, 7.0, "F"), None, "",
    )
    profile = spark.createDataFrame([("d", 10.0, False), ("x", None, None)], "doc_id string, body_size double, styled boolean")
    got = [r.rule for r in cascade.classified(lines, profile).orderBy("line_idx").collect()]
    assert got == ["HEAD", "TIME", "CHAIRMAN", "SCRIBE", "TIME", "SPEAKER", None, "SEG", "GENERIC_NOTE", "AFTER_GENERIC_NOTE", "SPEAKER", "UNMATCHED_LINE", "FOOTNOTE_ENTRY", "FOOTNOTE_CONTINUATION", None, None]
    nodes = cascade.classified(lines, profile).select("doc_id", F.explode("nodes").alias("n")).select("doc_id", "n.*")
    xml = structure.serialized(nodes, "doc_id").first().xml
    root = ElementTree.fromstring(xml)
    assert [u.get("who") for u in root.iter("u")] == ["Predsednik Ivan Novak", "Ana Kovač"]
    assert [n.get("n") for n in root.iter("note") if n.get("place") == "foot"] == ["1"]
    assert root.find("div").get("type") == "debateSection"
    assert cascade.classified(lines.limit(0), profile).count() == 0
    # in a styled volume a name in capitals at the left edge is a label without a colon
    shouted = volume(spark, ("3. SEJA", 200.0, 680.0, 14.0, "F"), "Predsednik Ivan Novak: Začenjam.", "VESELIN DJURANOVIĆ, predsednik", "Hvala.")
    styled = spark.createDataFrame([("d", 10.0, True)], profile.schema)
    assert [r.rule for r in cascade.classified(shouted, styled).orderBy("line_idx").collect()][1:4] == ["SPEAKER", "SPEAKER", "SPEECH_START"]
    # after an appendix's heading the debate is over
    back = volume(spark, "PRILOGA", "vsebina priloge")
    assert [r.rule for r in cascade.classified(back, profile).orderBy("line_idx").collect()][0] == "APPENDIX_HEAD"


def test_rule_sets_of_volumes(spark):
    profile = spark.createDataFrame([], "doc_id string, body_size double, styled boolean")
    old = volume(spark, ("2. SEJA", 200.0, 500.0, 12.0, "F"), ("( d. 3. maja 1957 )", 200.0, 480.0, 10.0, "F"), "predsedoval Ivan Novak", "Tajnik: Ana", "Začetek seje ob devetih", ("(Opomba)", 90.0, 400.0, 9.0, "F"), ("Ivan Novak: Hvala.", 72.0, 380.0, 9.0, "F"), ("govor", 90.0, 360.0, 9.0, "F"))
    rule = lambda df, name: [r.rule for r in volumes.classified(cascade.measured(df, profile), name).orderBy("line_idx").collect()]
    assert rule(old, "sessions_of_1957") == ["SESSION_HEADING", "SESSION_DATE", "CHAIRMAN", "SCRIBE", "START_TIME", "GENERIC_NOTE", "SPEAKER", "SEG"]
    hall = volume(spark, ("OD 3. MAJA", 100.0, 700.0, 12.0, "F"), ("4. SEDNICA", 100.0, 690.0, 12.0, "F"), ("ZBOR", 100.0, 680.0, 12.0, "F"), ("PREDSEDAVA NOVAK", 220.0, 600.0, 11.0, "F"), ("Početak u 9", 220.0, 590.0, 11.0, "F"), ("smeh", 150.0, 585.0, 11.0, "F-Italic"), ("SADRŽAJ", 50.0, 580.0, 9.0, "F"), ("stavka", 50.0, 570.0, 9.0, "F"))
    assert rule(hall, "chamber") == ["SEJA_DATE", "SEJA_NUM", "SEJA_DECLARATION", "CHAIRMAN", "TIME", "GENERIC_NOTE", "CONTENTS", "CONTENTS"]
    house = volume(spark, ("7. seja", 200.0, 607.0, 12.0, "F-Bold"), ("zbora", 200.0, 570.0, 12.0, "F-Bold"), ("ob 9", 200.0, 595.0, 10.0, "F-Italic"), ("PREDSEDUJE Novak", 180.0, 580.0, 10.0, "F"), ("in Kovač", 180.0, 570.0, 10.0, "F"), ("1 opomba", 50.0, 100.0, 7.0, "F"), ("smeh", 330.0, 90.0, 10.0, "F-Italic"), ("IVAN NOVAK", 50.0, 80.0, 9.5, "F"), ("govor", 50.0, 70.0, 9.5, "F"))
    assert rule(house, "republics") == ["SEJA_DECLARATION", "SEJA_DECLARATION", "TIME", "CHAIRMAN", "CHAIRMAN", "REFERENCE_ENTRY", "GENERIC_NOTE", "SPEAKER", "SEG"]
    runs = [("p", 0, 0, "Seja", 5000.0, True, False, False, "left", None), ("p", 1, 0, "ob 9", 5000.0, False, True, False, "left", None), ("p", 2, 0, "Predseduje N", 5000.0, False, False, False, "left", None), ("p", 3, 0, "1", 1000.0, False, False, True, "left", None), ("p", 4, 0, "smeh", 1000.0, False, True, False, "center", None), ("p", 5, 0, "NOVAK:", 1000.0, False, False, False, "left", 0.0), ("p", 6, 0, "govor", 1000.0, False, False, False, "left", 200.0)]
    word = spark.createDataFrame([(a, b, c, d, x, 1.0, 100.0, 9.0, e, f, g, h, i, None) for a, b, c, d, x, e, f, g, h, i in runs], readers.DOCX_RUNS)
    assert [r.rule for r in volumes.classified_runs(word).orderBy("para").collect()] == ["SEJA_DECLARATION", "TIME", "CHAIRMAN", "REFERENCE_ENTRY", "GENERIC_NOTE", "SPEAKER", "SEG"]


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_elements(spark):
    L = F.lit  # noqa: N806
    none = L(None).cast("string")
    assert one(spark, headers.element("a", headers.escaped(L('<x> & "y"')), n=L(1), m=none)) == '<a n="1">&lt;x&gt; &amp; &quot;y&quot;</a>'
    assert one(spark, headers.element("a", none, n=none)) is None and one(spark, headers.element("a", always=True)) == "<a/>"
    titles = F.create_map(L("sl"), L("Seja"), L("en"), L("Session"))
    xml = one(spark, headers.header(titles, L("1. sklic / 2. seja"), headers.meeting(F.array(L("Zbor"), L("1. sklic"))), L(1), L(0), L(None).cast("int"), L("1950-01-02").cast("date"), L("sl")))
    root = ElementTree.fromstring(xml)
    assert [t.text for t in root.iter("title")] == ["Session", "Seja", "1. sklic / 2. seja"] and root.find(".//meeting").get("n") == "1"
    assert [m.get("unit") for m in root.iter("measure")] == ["texts"] and root.find(".//date").get("when") == "1950-01-02" and root.find(".//language").get("ident") == "sl"
    assert one(spark, headers.enriched(L("  "), L("x"))) == "x" and one(spark, headers.enriched(none, L("x"))) == "x" and one(spark, headers.enriched(L("y"), L("x"))) == "y"
    ElementTree.fromstring(one(spark, headers.failure_document(L("a<b"), none)))
    assert one(spark, headers.owner(L("a/b"))) == "a" and one(spark, headers.owner(L(""))) == "" and one(spark, headers.relative(L("a/b/c"), L("a"))) == "b/c"


def test_lists(spark):
    rows = [("d", "#A", "Ana A (X&Y):", "x", 1), ("d", "#A", "Ana A (X&Y):", "x", 2), ("d", None, None, "x", 3), ("e", None, None, "x", 1)]
    df = spark.createDataFrame(rows, "doc string, ref string, label string, x string, ord int")
    got = dict(values(headers.list_person(df, ["doc"], "ref", "label"), "doc", "xml"))
    assert [p.find("affiliation").text for p in ElementTree.fromstring(got["d"]).iter("person")] == ["X&Y"] and "UnknownSpeaker" in got["e"]
    orgs = dict(values(headers.list_org(df, ["doc"], "label", F.col("ord")), "doc", "xml"))
    assert [o.text for o in ElementTree.fromstring(orgs["d"]).iter("orgName")] == ["Ana A (X&Y):", "Unknown organization"]
    assert headers.list_person(df.limit(0), ["doc"], "ref", "label").count() == 0
    notes = spark.createDataFrame([("d", "warning", "b", 2), ("d", "warning", "b", 1), ("d", "recovery", "a", 3), ("d", "recovery", None, 0)], "doc string, kind string, text string, at int")
    assert headers.conversion_notes(notes, "doc", "kind", "text", "at").first().notes == '<notesStmt><note type="warning" n="1">b</note><note type="recovery" n="2">a</note></notesStmt>'


def test_jobs(spark, tmp_path):
    df = spark.createDataFrame([("b/X.pdf", "2"), ("a/y.PDF", "1"), ("A/z.pdf", "3"), ("c/x.pdf", "2"), (None, None)], "path string, source string")
    assert [r.path for r in jobs.ordered_jobs(df.where("path is not null"), "path", "source").orderBy("ord").collect()] == ["a/y.PDF", "A/z.pdf", "b/X.pdf"]
    documents, warnings = jobs.discovered(df, "path", ("pdf",), excluded=["a"], roots=["b", "zz", "c/x.pdf"])
    assert values(documents, "path") == [("A/z.pdf",), ("b/X.pdf",), ("c/x.pdf",)] and values(warnings, "warning") == [("missing: zz",)]
    assert values(jobs.source_roots(spark.createDataFrame([("a/x",), ("b/x",)], "p string"), "p"), "root") == [("a",), ("b",)]
    assert values(jobs.source_roots(spark.createDataFrame([("a/x",), ("x",)], "p string"), "p"), "root") == [("",)]
    long = spark.createDataFrame([(i, "g" * 40 + "/" + "h" * 90, "t" * 300) for i in range(3)] + [(3, "G", "con"), (4, "g", "CON"), (5, None, None)], "k int, g string, t string")
    got = [r.path for r in jobs.unique_paths(long, ["k"], "/out", F.col("g"), F.col("t")).orderBy("k").collect()]
    assert len({p.lower() for p in got}) == 6 and all(len(p) <= 240 for p in got) and got[3:5] == ["G/_con", "g/_CON-2"] and got[5] == "document"
    line = jobs.progress(spark.createDataFrame([(1, "a", "ok", 1.25, None), (2, "b", "failed", 0.5, "bad")], "i int, n string, s string, t double, m string"), "i", "n", "s", "t", "m")
    assert [r.line for r in line.orderBy("i").collect()] == ["[1/2] OK a (1.3 s)", "[2/2] FAILED b (0.5 s) - bad"]
    files = spark.createDataFrame([("a.xml",), ("b.xml",)], "path string")
    manifest = spark.createDataFrame([(["a.xml", "b.xml", "c.xml", "a.xml"], ["b.xml", "x.json"])], "one array<string>, two array<string>")
    assert values(jobs.manifest_sections(manifest, ["one", "two"], files, "path"), "path", "section", "ord") == [("a.xml", "one", 1), ("b.xml", "one", 2)]
    request = {k: F.lit(v).cast("string") for k, v in {"inputs": "", "menu": None, "output": "o", "prefix": "-", "code": "sl", "workers": "0", "timeout": "x"}.items()}
    assert one(spark, jobs.request_errors(request)) == ["nothing to convert", "bad prefix", "workers must be at least 1", "timeout must be positive"]
    assert one(spark, jobs.text_lines(F.lit(" a \n\n b"))) == ["a", "b"] and one(spark, jobs.log_tail(F.lit("abc\ndef\n"), 6)) == "def\n"
    assert one(spark, jobs.month_key(F.lit("Sep-Okt"))) == "sepokt" and one(spark, jobs.counted(F.lit("x"))) == 0 and one(spark, jobs.checkpoint_steps(F.lit(250))) == 2
    assert jobs.statuses(spark.createDataFrame([("a", "ok")], "source string, status string"), F.lit("f")).first().completed_at.endswith("+00:00")


@pytest.mark.parametrize(
    ("text", "joined"),
    [("Predsednik d r. F e r d o K o z a k", "Predsednik dr Ferdo Kozak"), ("Ana Kovač", "Ana Kovač"), ("a b", "a b"), ("", ""), ("P i r n a t Jože", "Pirnat Jože")],
)
def test_collapsed_letters(spark, text, joined):
    assert one(spark, C.collapsed_letters(F.lit(text))) == joined
    assert one(spark, C.collapsed_letters(F.lit(None).cast("string"))) is None


def test_title_case(spark):
    assert one(spark, C.title_case(F.lit("o'neil JANEZ-novak č"))) == "O'Neil Janez-Novak Č" and one(spark, C.casefold(F.lit("Straße"))) == "strasse"


def test_footnotes(spark):
    def run(text, y, size, x=0.0):
        return (text, x, y, "F", size, False)

    lines = [
        ("d", 0, 0, 600.0, [run("Zakon", 600.0, 10.0), run("1", 604.0, 6.0), run("5", 604.0, 6.0), run("velja", 600.0, 10.0)]),
        ("d", 0, 1, 580.0, [run("sto", 580.0, 10.0), run("5", 584.0, 6.0), run("%", 580.0, 10.0)]), ("d", 0, 2, 570.0, [run("nizko", 570.0, 10.0), run("7", 570.0, 6.0)]),
        ("d", 0, 3, 100.0, [run("1", 100.0, 6.0), run("5", 100.0, 6.0), run("Glej zakon", 98.0, 8.0)]), ("d", 0, 4, 90.0, [run("nadaljevanje", 90.0, 8.0)]),
        ("d", 0, 5, 80.0, [run("16", 80.0, 6.0), run("Tudi to", 78.0, 8.0)]), ("d", 0, 6, 70.0, [run("347", 70.0, 6.0), run("Brez sklica", 68.0, 8.0)]),
        ("d", 1, 0, 600.0, [run("besede", 600.0, 10.0), run("120", 604.0, 6.0)]), ("d", 1, 1, 100.0, [run("120", 100.0, 6.0), run("Sklicana", 98.0, 8.0)]), ("d", 1, 2, 90.0, [run("121", 90.0, 6.0), run("Naslednja", 88.0, 8.0)]), ("d", 1, 3, 80.0, None),
    ]
    df = spark.createDataFrame([(*r[:4], 760.0, r[4]) for r in lines], f"doc_id string, page_num int, line_idx int, y double, page_height double, runs {RUN}")
    body = spark.createDataFrame([("d", 10.0)], "doc_id string, body double")
    runs = footnotes.exploded_runs(df, body)
    found = footnotes.marks(runs)
    definitions, references = footnotes.definitions_and_references(found)
    assert values(definitions, "page_num", "number") == [(0, "15"), (0, "16"), (1, "120"), (1, "121")]
    assert values(references, "page_num", "number") == [(0, "15"), (1, "120")]
    assert footnotes.consumed_runs(runs, found).count() == runs.count() - 2
    assert values(footnotes.continuations(df, definitions), "line_idx", "number") == [(3, "121"), (4, "15"), (6, "16")]
    assert footnotes.marks(runs.limit(0)).count() == 0


def fake_backend():
    """Pages parted by form feeds, words by spaces; `!` on a page breaks it."""
    def page(content, n):
        text = content.decode().split("\f")[n]
        if "!" in text:
            raise ValueError("broken page")
        return text

    def rows(n, parts):
        return [(n, i, t, 10.0 * i, 10.0 * i + 5, 700.0, "F", 10.0, 480.0, 760.0) for i, t in enumerate(parts)]

    def pages(content):
        if content == b"no pdf":
            raise ValueError("no document")
        return len(content.decode().split("\f"))

    return pdf.Backend("fake", pages, lambda c, n: rows(n, "" if page(c, n).startswith("#") else page(c, n)), lambda c, n: rows(n, page(c, n).lstrip("#").split()))


def test_pdf_pages_are_tasks(spark):
    b = fake_backend()
    book = "\f".join(f"p{i} x" for i in range(10))
    files = spark.createDataFrame([("a", book.encode()), ("b", b"no pdf"), ("c", b"one\f!\ftwo"), ("d", b"#seen by words")], "path string, content binary")
    tasks = pdf.page_tasks(files, b, pages_per_task=4)
    assert values(tasks, "path", "start", "end")[:3] == [("a", 0, 4), ("a", 4, 7), ("a", 7, 10)]
    words = pdf.scanned(files, b, "words", pages_per_task=4)
    assert [r.text for r in words.where("path = 'a'").orderBy("page_num", "seq").collect()][:4] == ["p0", "x", "p1", "x"] and words.where("path = 'a'").count() == 20
    assert values(pdf.page_warnings(words), "path", "warning") == [("b", "ValueError: no document"), ("c", "page 2 extraction failed: ValueError: broken page")]
    assert pdf.scanned(files, b, "words", start=2, end=5).where("path = 'a'").count() == 6
    mode = spark.createDataFrame([("a", "ocr")], "path string, mode string")
    read = pdf.adaptive(files.where("path in ('a', 'd')"), b, mode)
    assert [r.text for r in read.where("path = 'd'").orderBy("seq").collect()] == ["seen", "by", "words"] and read.where("path = 'a'").count() == 20
    more = pdf.enriched(words, F.col("text").isNotNull(), {"n_words": F.count("*")}, {"is_start": F.col("seq") == 0})
    assert values(more.where("path = 'c'"), "page_num", "n_words", "is_start") == [(0, 1, True), (2, 1, True)]
    assert values(pdf.coordinates(words, needle="P3"), "page_num", "text", "font_size") == [(3, "p3x", 10.0)] and pdf.coordinates(words, page=0).where("path = 'a'").count() == 1
    assert pdf.scanned(files, None).where("error like '%no PDF library%'").count() == 4


def test_documents_to_bundles(spark, tmp_path):
    lines = volume(spark, ("3. SEJA", 200.0, 680.0, 14.0, "F"), "Predsednik Ivan Novak: Začenjam.", "Ana Kovač: Hvala & na svidenje.", "Ana Kovač: Še to.")
    profile = spark.createDataFrame([("d", 10.0, False)], "doc_id string, body_size double, styled boolean")
    seen = []
    result = api.parse(lines, profile, {"on_start": lambda df: seen.append("start") or df, "on_end": lambda df: df.where("kind <> 'comment'")})
    assert seen == ["start"]
    assert values(result.speakers(), "label", "n") == [("Ana Kovač", 2), ("Predsednik Ivan Novak", 1)]
    leaders = spark.createDataFrame([("d", "Ana Kovač", "#ana")], "doc_id string, who string, leader string")
    assert values(api.canonical(result.nodes(), leaders).where("tag = 'u'").select(F.col("attrs")["who"].alias("w")), "w") == [("#ana",), ("#ana",), ("Predsednik Ivan Novak",)]
    done = values(result.write(str(tmp_path)), "name")
    assert done == [("d/data.json",), ("d/diagnostics.json",), ("d/document.xml",), ("d/listPerson.xml",)]
    root = ElementTree.fromstring((tmp_path / "d/document.xml").read_text())
    assert [u.get("who") for u in root.iter("u")] == ["Predsednik Ivan Novak", "Ana Kovač", "Ana Kovač"]
    assert '"SPEAKER":3' in (tmp_path / "d/diagnostics.json").read_text() and "Ana" in (tmp_path / "d/listPerson.xml").read_text()
    register = spark.createDataFrame([("ana kovač", "ent-1"), ("Ana Kovač", "ent-2"), (None, None)], "search_name string, p string")
    assert values(api.with_register(result.speakers(), register, "label"), "label", "p") == [("Ana Kovač", "ent-1"), ("Predsednik Ivan Novak", None)]
