"""Training-data operators: brute force, held-out accuracy, and awkward input.

Awkward input: nulls in any column, empty and very long texts, repeated rows,
ties, empty tables, and extra columns whose names the operators use themselves.
"""

import os
import random
import subprocess
import threading
from datetime import datetime
from itertools import permutations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foliospark.llm import common, confusables, langid, leakage, matching, mixture, names, queries, readability, scans, transcripts

SF = "/root/testdata/sf0.001"
GRADED = "/root/testdata/sf0.01/graded_passage.parquet"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")

SAMPLE = {
    "sl": "Zbor sprejema predlog zakona, odbor pa pregleduje poročilo o žetvi v drugem branju. Vlada zahteva novo cesto proti mestu.",
    "en": "The chamber adopts the draft bill, while the committee reviews the harvest report at second reading. The treasury demands a new road.",
    "de": "Die Kammer genehmigt den Gesetzentwurf, während der Ausschuss den Erntebericht in zweiter Lesung prüft. Die Minderheit verlangt eine Straße.",
}


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)


def with_clashes(df):
    """Extra columns with names that operators use inside."""
    for c in ("kind", "r", "n", "word", "key", "block", "label_", "part", "rank", "g", "margin", "edge", "context", "starts", "person", "id_"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("x"))
    return df


# --- languages ---------------------------------------------------------------------


def cross_parse(text, reference):
    """Phrases by brute force: the longest stretch that occurs in the reference."""
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in reference:
            j += 1
        n, i = n + 1, max(j - 1, i + 1)
    return n


def test_phrases_equal_brute_force():
    parser = langid.CrossParser(SAMPLE)
    texts = [SAMPLE["sl"][20:60], "the harvest report of the chamber", "Straße qqq", "x"]
    letters = lambda t: "".join(map(chr, langid._ids([t])[0]))
    got = parser.phrases(texts)
    for t, counts in zip(texts, got):
        for lang, count in zip(parser.languages, counts):
            assert abs(count - cross_parse(letters(t), letters(SAMPLE[lang]))) <= 1
    assert list(parser.phrases(texts[::-1])[::-1].ravel()) == list(got.ravel())


def test_cyrillic_is_read_as_latin():
    a, b = langid._ids(["Његова љубав"]), langid._ids(["Njegova ljubav"])
    assert a[0].tolist() == b[0].tolist()


def test_document_languages(spark):
    labelled = spark.createDataFrame([(k, v) for k, v in SAMPLE.items()] + [(None, "x"), ("sl", None)], "lang string, text string")
    mixed = SAMPLE["sl"] * 3 + "\n\n" + SAMPLE["en"]
    docs = [(1, SAMPLE["de"], None), (2, mixed, "sl"), (3, None, "sl"), (4, "", "en"), (5, "123 . --", None), (6, SAMPLE["en"] * 20_000, "EN"), (7, mixed, "sl")]
    df = with_clashes(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    got = {(r.doc_id, r.seg_no): r.lang for r in langid.document_languages(df, labelled).collect()}
    assert got[1, -1] == "de" and got[2, -1] == "sl" and got[2, 1] == "en" and got[7, 1] == "en" and got[6, -1] == "en"
    assert (3, -1) not in got and got[4, -1] is None
    assert langid.document_languages(df.limit(0), labelled).count() == 0
    with pytest.raises(ValueError):
        langid.labelled_texts(labelled.limit(0))


def test_sampled_texts_are_whole():
    texts = [chr(97 + i) * 40 for i in range(20)]
    kept = langid.sampled(texts, 200)
    assert len(kept) == 5 and kept == [t for t in texts if t in kept] and langid.sampled(texts, 10_000) == texts


def test_unknown_script_has_no_language(spark):
    labelled = spark.createDataFrame(list(SAMPLE.items()), "lang string, text string")
    df = spark.createDataFrame([(1, "漢字漢字漢字漢字漢字漢字漢字", "zh")], "doc_id long, text string, lang string")
    assert langid.document_languages(df, labelled).first().lang is None


def test_labels(spark):
    labels = ["sl", "SL", "sl-SI", "slv", "Slovenian", "deu", "ger", "fr", "und", "?", "", None]
    df = spark.createDataFrame([(x,) for x in labels], "l string").select(langid.label_language(F.col("l")).alias("two"))
    assert [r.two for r in df.collect()] == ["sl"] * 5 + ["de"] * 2 + ["fr"] + [None] * 4


# --- reading level -----------------------------------------------------------------


@pytest.mark.skipif(not os.path.exists(GRADED), reason="needs the test tables")
def test_levels_of_held_out_passages():
    passages = [tuple(x) for x in pd.read_parquet(GRADED)[["lang", "band", "text"]].itertuples(index=False)]
    random.Random(1).shuffle(passages)
    cut = len(passages) // 4
    scale = readability.Scale(passages[cut:])
    _, _, level = scale.estimate([t for _, _, t in passages[:cut]])
    right = np.floor(level + 0.5) == [b for _, b, _ in passages[:cut]]
    assert right.mean() > 0.95


def test_syllables():
    cases = {("sl", "predlagatelj"): 4, ("hr", "prvi"): 2, ("en", "table"): 2, ("en", "made"): 1, ("de", "bauer"): 2, ("it", "ciao"): 1, ("hu", "képviselő"): 4, ("sr", "њива"): 2}
    for (lang, word), n in cases.items():
        assert abs(readability.syllables(word, lang) - n) <= (1 if lang == "it" else 0), (lang, word)


@pytest.mark.parametrize(
    ("word", "lang", "parts"),
    [("predlagatelj", "sl", "pre-dla-ga-telj"), ("prvi", "hr", "pr-vi"), ("kmetija", "sl", "kme-ti-ja"), ("odbor", "sl", "od-bor"), ("straße", "de", "stra-ße"), ("garten", "de", "gar-ten"), ("made", "en", "made"), ("report", "en", "re-port"), ("magyarország", "hu", "ma-gya-ror-szág"), ("", "sl", ""), ("tst", "en", "tst")],
)
def test_divided(word, lang, parts):
    assert "-".join(readability.divided(word, lang)) == parts


@pytest.mark.skipif(not os.path.exists(GRADED), reason="needs the test tables")
def test_reading_levels(spark):
    graded = spark.read.parquet(GRADED)
    easy = graded.where("lang = 'sl' and band = 1").first().text
    docs = [(1, easy), (2, None), (3, ""), (4, "Le tri besede."), (5, easy * 3000), (6, easy)]
    got = {r.doc_id: r.band for r in readability.reading_levels(with_clashes(spark.createDataFrame(docs, "doc_id long, text string")), graded).collect()}
    assert got == {1: 1, 5: 1, 6: 1}
    assert readability.reading_levels(spark.createDataFrame([], "doc_id long, text string"), graded).count() == 0


# --- leakage -----------------------------------------------------------------------


def test_leaks_equal_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(6))
    usual = [word() for _ in range(40)]
    items = [(i, [rng.choice(usual) if rng.random() < 0.6 else word() for _ in range(45)]) for i in range(30)]
    docs, truth = [], set()
    for d in range(120):
        text = [rng.choice(usual) if rng.random() < 0.6 else word() for _ in range(rng.choice([60, 300, 900]))]
        if d % 2 == 0:
            i, w = items[d % 30]
            n = rng.choice([26, 32, 45])
            at, to = rng.randrange(45 - n + 1), rng.randrange(len(text))
            part = w[at : at + n]
            part[rng.randrange(n)] = word()
            text[to:to] = [p.upper() if d % 4 else p for p in part]
            truth.add((d, i))
        elif d % 3 == 0:
            text[10:10] = items[d % 30][1][:9]  # a short quotation is no case
        docs.append((d, " ".join(text)))
    docs += [(1000, None), (1001, ""), (1002, docs[0][1]), (1003, "one two")]
    truth |= {(1002, i) for d, i in truth if d == 0}
    item_rows = [(i, " ".join(w)) for i, w in items] + [(0, " ".join(items[0][1])), (500, None), (501, ""), (502, "too short")]
    df = with_clashes(spark.createDataFrame(docs, "doc_id long, text string"))
    it = spark.createDataFrame(item_rows, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leakage.leaks(df, it).collect()}
    assert len(truth - got) <= 0.05 * len(truth) and not got - truth
    assert leakage.leaks(df, it.limit(0)).count() == 0 and leakage.leaks(df.limit(0), it).count() == 0


def test_items_go_round_by_round(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(40))
    items = spark.createDataFrame([(i, f"{text} x{i}") if i == 7 else (i, " ".join(f"v{i}a{j}" for j in range(30))) for i in range(10)], "item_id long, text string")
    monkeypatch.setattr(leakage, "ITEMS_PER_ROUND", 3)
    assert rows(leakage.leaks(spark.createDataFrame([(1, "a b " + text)], "doc_id long, text string"), items), "doc_id", "item_id") == [(1, 7)]


def test_usual_phrases_do_not_depend_on_ids_or_rounds(spark, monkeypatch):
    text, phrase = " ".join(f"w{i}" for i in range(40)), " ".join(f"u{i}" for i in range(30))
    data = [(i, text) for i in range(5)] + [(i, f"{phrase} x{i} y{i} z{i}") for i in range(10, 15)]
    items = spark.createDataFrame(data, "item_id long, text string")
    df = spark.createDataFrame([(1, "a b " + text), (2, "a b " + phrase)], "doc_id long, text string")
    for n in (100, 3):
        monkeypatch.setattr(leakage, "ITEMS_PER_ROUND", n)
        assert rows(leakage.leaks(df, items), "doc_id", "item_id") == [(1, i) for i in range(5)]


def test_near_equal_and_short_items(spark):
    words = [f"w{i}" for i in range(40)]
    data = [(i, " ".join([*words[:-1], f"z{i}"])) for i in range(6)]  # one item in six suites, its last word changed in each
    data += [(20, " ".join(f"k{i}" for i in range(9)))]
    items = spark.createDataFrame(data, "item_id long, text string")
    df = spark.createDataFrame([(1, "a b " + " ".join(words)), (2, "c " + " ".join(f"k{i}" for i in range(9)) + " d"), (3, "c " + " ".join(f"k{i}" for i in range(8)) + " d")], "doc_id long, text string")
    assert rows(leakage.leaks(df, items), "doc_id", "item_id") == [(1, i) for i in range(6)] + [(2, 20)]


def test_items_of_usual_phrases(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(6))
    phrases = [[word() for _ in range(16)] for _ in range(40)]
    ends = [word() for _ in range(12)]
    # two usual phrases and two words of their own; all words usual, but no phrase of more than two of them
    items = [p + q + [word(), word()] for p, q in rng.sample(list(permutations(phrases, 2)), 200)] + [[rng.choice(ends) for _ in range(24)] for _ in range(60)] + [[rng.choice(ends) for _ in range(9)]]
    docs = [(i, " ".join([word() for _ in range(100)] + w + [word() for _ in range(100)])) for i, w in enumerate(items)]
    it = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), it).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in range(len(items))]
    assert all(r.n_words == len(items[r.item_id]) and r.containment == 1 for r in got)


@pytest.mark.parametrize(("n", "altered", "least"), [(24, 0.05, 0.95), (30, 0.1, 0.9), (45, 0.1, 0.95)])
def test_recall_of_altered_passages(spark, n, altered, least):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(6))
    items = [[word() for _ in range(60)] for _ in range(80)]
    docs = []
    for i, w in enumerate(items):
        at = rng.randrange(60 - n + 1)
        docs.append((i, " ".join([word() for _ in range(100)] + [word() if rng.random() < altered else x for x in w[at : at + n]] + [word() for _ in range(100)])))
    it = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = rows(leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), it), "doc_id", "item_id")
    assert all(d == i for d, i in got) and len(got) >= least * len(items)


# --- mixture -----------------------------------------------------------------------


def test_rates_and_repeats(spark):
    for mean, cap in [(0.3, 1), (1.7, 2), (4.0, 8)]:
        assert abs(mixture.capped_mean(mixture.rate_for(mean, cap), cap) - mean) < 1e-6
    for mean, cap in [(800, 10_000), (9_900, 10_000)]:  # no rate is too large
        assert abs(mixture.capped_mean(mixture.rate_for(mean, cap), cap) - mean) < 1e-3 * mean
        many = spark.range(4_000).select(mixture.repeats(F.col("id"), F.lit(mixture.rate_for(mean, cap)), F.lit(cap)).alias("n")).agg(F.avg("n"), F.max("n")).first()
        assert abs(many[0] - mean) < 0.01 * mean and many[1] <= cap
    assert mixture.rate_for(2, 2) is None
    n = spark.range(40_000).select(mixture.repeats(F.col("id"), F.lit(mixture.rate_for(1.7, 3)), F.lit(3)).alias("n"))
    r = n.agg(F.avg("n"), F.max("n"), F.min("n")).first()
    assert abs(r[0] - 1.7) < 0.03 and r[1] == 3 and r[2] == 0


def test_mixture(spark):
    sized = spark.createDataFrame([(i, "big" if i < 900 else "small", 10) for i in range(1000)] + [(5000, None, 10)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 2), ("none", 0.2, 3), ("big", 0.5, 1), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    plan = mixture.replication_plan(sized, targets)
    assert rows(plan, "source", "reachable") == [("big", True), ("none", False), ("small", False)]
    texts = sized.select("doc_id", "source", F.concat(F.lit("text "), "doc_id").alias("text"))
    mixed = mixture.mix(texts, plan)
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    assert mixed.where("source = 'small'").count() == 200
    assert rows(mixed) == rows(mixture.mix(texts.repartition(7), plan)) and mixed.first().text.startswith("text ")
    shares = {r.source: r.actual_share for r in mixture.shares(sized, plan).collect()}
    assert shares["none"] == 0 and abs(sum(shares.values()) - 1) < 1e-9
    assert mixture.replication_plan(sized.limit(0), targets).where("documents = 0 and wanted = 0 and reachable").count() == 3  # nothing is wanted


def test_token_count(spark):
    df = spark.createDataFrame([(None,), ("",), ("a b",), ("čšž " * 50_000,)], "t string").select(mixture.token_count(F.col("t")).alias("n"))
    n = [r.n for r in df.collect()]
    assert n[:3] == [0, 0, 2] and n[3] > 50_000


# --- look-alikes -------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "form"),
    [
        ("zaνrača", "zavrača"), ("ｅｍｅｌ １９", "emel 19"), ("počitek", "počitek"), ("k​metij", "kmetij"), ("a b", "a b"), ("Ⅳ ĳ ǉ", "IV ij lj"),
        ("𝐀𝖻", "Ab"), ("Ðorđe", "Đorđe"), ("мишљeња", "мишљења"), ("закон о путевима", "закон о путевима"), ("„so“ – ½ x² …", "„so“ – ½ x² …"),
        ("Σ μικρά", "Σ μικρά"), ("façade Straße", "façade Straße"), ("", ""),
    ],
)
def test_consistent(text, form):
    assert confusables.consistent(text) == form
    assert confusables.consistent(form) == form
    assert confusables.skeleton(text) == confusables.skeleton(form)


@pytest.mark.parametrize(("text", "form"), [("zakօn", "zakon"), ("ꓢeja", "Seja"), ("Ꭺna", "Ana"), ("sᴇja", "seja"), ("Հայաստան", "Հայաստան")])
def test_other_scripts(text, form):
    assert confusables.consistent(text) == form and confusables.skeleton(text) == confusables.skeleton(form)


def test_the_group_of_equal_skeleton_decides(spark):
    # words that mix scripts take the form their group has most in one script
    data = [(1, "d", 0, "cова"), (2, "d", 0, "сова"), (3, "d", 0, "сова"), (4, "e", 0, "pасa"), (5, "e", 0, "paca"), (6, "e", 0, "paca")]
    df = spark.createDataFrame(data, "run_id long, doc_id string, page_num int, text string")
    got = {r.run_id: r.consistent for r in confusables.runs_in_form(df).collect()}
    assert got == {1: "сова", 2: "сова", 3: "сова", 4: "paca", 5: "paca", 6: "paca"}


def test_runs_in_form(spark):
    data = [(1, "d", 0, "sеja"), (2, "d", 0, "seja"), (2, "d", 0, "seja"), (3, "d", 0, None), (4, None, None, ""), (5, "d", 0, "se​ja " * 30_000), (6, "e", 0, "со"), (7, "e", 0, "цена соли")]
    df = with_clashes(spark.createDataFrame(data, "run_id long, doc_id string, page_num int, text string"))
    got = {r.run_id: r for r in confusables.runs_in_form(df).collect()}
    assert {k for k, r in got.items() if r.changed} == {1, 5}
    assert got[1].consistent == "seja" and got[3].consistent is None
    assert [r.n_forms for r in confusables.look_alikes(df).collect()] == [2]
    assert confusables.runs_in_form(df.limit(0)).count() == 0


# --- scanned pages -----------------------------------------------------------------


def scan(spark, texts, doc="d"):
    """Pages of lines: (text, x, y) or text alone."""
    out = []
    for p, page in enumerate(texts):
        for i, t in enumerate(page):
            text, x, y = t if isinstance(t, tuple) else (t, 72.0, 740.0 - 12 * i)
            out.append((doc, p, i, text, x, y, 9.5, 800.0, datetime(2020, 1, 1)))
    df = spark.createDataFrame(out, "doc_id string, page_num int, line_idx int, text string, x double, y double, font_size double, page_height double, extracted_at timestamp_ntz")
    return with_clashes(df)


def test_defects(spark):
    body = ["odbor obravnava poročilo o žetvi", "kulturno-prosvetni odbor zavrača predlog", "pod- in nadzemni odbor govori"] * 12
    page = [("12. SEJA", 200.0, 768.0), *body, "tukaj govori odbor o predlo-", "gu zakona in kulturno-", "prosvetni odbor zavrača pre¬", ("- 5 -", 290.0, 30.0)]
    other = ["dlog zakona odb0r", "kamara odbor karnara obravnava", "o d b o r govori", ("1498", 330.0, 600.0), None, "", "predlog predlog predlog predlog predlog", "kamara " * 60]
    df = scan(spark, [page, [("13. SEJA", 200.0, 768.0), *other]])
    got = {(r.page_num, r.line_idx, r.defect) for r in scans.defects(df.unionByName(df)).collect()}
    assert {x for x in got if x[2] == "furniture"} == {(0, 0, "furniture"), (0, 40, "furniture"), (1, 0, "furniture")}
    assert {x for x in got if x[2] == "hyphen"} == {(0, 37, "hyphen"), (0, 39, "hyphen")}
    assert {x for x in got if x[2] == "glyph"} == {(1, 1, "glyph"), (1, 2, "glyph"), (1, 3, "glyph")}
    assert scans.defects(df.limit(0)).count() == 0
    text = " ".join(r.text for r in scans.paragraphs(df).orderBy("page_num", "line_idx").collect())
    assert "predlogu zakona in kulturno-prosvetni odbor zavrača predlog zakona odbor" in text and "SEJA" not in text


def test_word_goes_on_after_an_empty_page(spark):
    page = ["kamara obravnava odbor"] * 12 + ["tukaj govori od-"]
    got = scans.with_next(scans.text_lines(scan(spark, [page, [""], ["bor zavrača"] * 2]))).where("page_num = 0 and line_idx = 12").first()
    assert (got.following, got.next_page, got.next_line) == ("bor zavrača", 2, 0)


def test_misread_word_cut_by_the_line(spark):
    page = ["kamara obravnava odbor"] * 12 + ["tukaj govori ka-", "rnara in od-", "bor zavrača"]
    got = {(r.line_idx, r.defect) for r in scans.defects(scan(spark, [page])).where("defect <> 'furniture'").collect()}
    assert got == {(12, "hyphen"), (13, "hyphen"), (13, "glyph")}


def test_corrections_equal_brute_force(spark):
    words = [("predlog", 100), ("pred1og", 2), ("odbor", 90), ("0db0r", 1), ("kamara", 80), ("karnara", 3), ("zakon", 50), ("drugo", 2), ("sol", 40), ("s0l", 30)]
    df = spark.createDataFrame(words, "word string, n long")
    assert dict(rows(scans.corrections(df), "word", "right")) == {"pred1og": "predlog", "0db0r": "odbor", "karnara": "kamara"}


# --- transcripts -------------------------------------------------------------------


def test_unknown_speakers_have_turns_of_their_own(spark):
    mapping = spark.createDataFrame([("t", 1, "#A", "Ana Novak:")], "doc_id string, ord int, speaker_ref string, label string")
    text = ["Ana Novak: Prva.", "Peter Hribar: Vmes.", "še vmes", "Predlagam naslednje: tole.", "Ana Novak: Druga."]
    df = spark.createDataFrame([("t", i, t, None) for i, t in enumerate(text)], "doc_id string, line_idx int, text string, received_at timestamp_ntz")
    assert rows(transcripts.turn_starts(df, mapping), "line_idx", "speaker_ref") == [(0, "#A"), (4, "#A")]
    got = {r.line_idx: (r.speaker_ref, r.text) for r in transcripts.turns(df, mapping).collect()}
    assert got == {0: ("#A", "Prva."), 1: (None, "Vmes. še vmes Predlagam naslednje: tole."), 4: ("#A", "Druga.")}


def test_near_keys_equal_all_pairs(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randint(6, 12))).strip() for _ in range(60)]
    base = [b for b in base if len(b) >= 6]
    asked = spark.createDataFrame([("d", b) for b in set(base)], "doc_id string, key string")
    other = {b[:3] + b[4:] for b in base[:20]} | {b[:2] + "x" + b[2:] for b in base[20:40]} | set(base[40:])
    known = spark.createDataFrame([("d", b) for b in other], "doc_id string, key string")
    got = {(r.key, r.known) for r in transcripts.near_keys(asked, known).collect()}
    all_pairs = asked.join(known.withColumnRenamed("key", "known"), "doc_id").where("levenshtein(key, known) <= 2 and size(split(key, ' ')) = size(split(known, ' ')) and length(known) >= 4")
    assert got == {(r.key, r.known) for r in all_pairs.collect()}


@pytest.mark.parametrize(("line", "clean"), [("Hm, eee to je äh … res mhm", "to je res"), ("Emil in Ema", "Emil in Ema"), ("aaaa uhm da", "da"), ("Vem, da ne", "Vem, da ne")])
def test_fillers(spark, line, clean):
    assert spark.range(1).select(transcripts.speech(F.lit(line))).first()[0] == clean


def test_turns(spark):
    mapping = spark.createDataFrame(
        [("t", 1, "#AnaNovak", "Ana Novak (KSD):"), ("t", 2, "#MihaKranjčar", "Predsednik MIHA KRANJČAR:"), ("t", 3, "#AnaNovakova", "Ana Novak:"), ("t", 4, "#MihaKranjcarr", "Miha Kranjčarr:"), ("t", 4, None, None)],
        "doc_id string, ord int, speaker_ref string, label string",
    )
    text = [
        "brez govorca", "[00:01:02] Ana Novak: eee, Dober dan dan vsem.", "[smeh] Sklep: sprejeto (čl. 3).", "(9.15) KRANJČAR (ZMK): hm … [kašelj]", "Novak Ana (nadaljuje): Hvala.",
        "PREDSEDNIK: Prosim.", None, "", "<v Miha Kranjčar> Naprej.", "00:02:00 >> A. Novak: Konec", "Kakor je dejal Kranjčar: drži.", "KRANJČAR – Res.", "x " * 100_000,
    ]
    lines = [("t", i, t, datetime(2020, 1, 1)) for i, t in enumerate(text)] + [("t", 1, "Miha Kranjčar: pozno", datetime(2021, 1, 1)), (None, 0, "Ana Novak: x", None), ("u", 0, "Ana Novak: x", None)]
    df = with_clashes(spark.createDataFrame(lines, "doc_id string, line_idx int, text string, received_at timestamp_ntz"))
    starts = rows(transcripts.turn_starts(df, mapping), "line_idx", "speaker_ref")
    assert starts == sorted([(1, "#AnaNovak"), (5, "#MihaKranjčar"), (9, "#AnaNovak"), (11, "#MihaKranjčar")], key=repr)
    got = {r.line_idx: r.text for r in transcripts.turns(df, mapping).collect()}
    assert got[1] == "Dober dan vsem. Sklep: sprejeto (čl. 3). Hvala."
    assert got[5] == "Prosim. Naprej."
    assert transcripts.turn_starts(df.limit(0), mapping).count() == 0 and transcripts.turn_starts(df, mapping.limit(0)).count() == 0


# --- names and matches -------------------------------------------------------------


@pytest.mark.parametrize(
    ("typed", "words"),
    [
        ("tov. Ludvik Keliranelj", "ludvik keliranelj"), ("Keliranelj, Lude", "lude keliranelj"), ("Damijan T r a v r a f a n e c", "damijan travrafanec"),
        ("Kristina F. Mešislanič-Stala", "kristina f mesislanic stala"), ("Штеф Фанчонданич", "stef fancondanic"), ("", ""),
        ("G. Mešislanič-Stala", "g mesislanic stala"), ("Keliranelj, G.", "g keliranelj"), ("tov. G. Keliranelj", "g keliranelj"),
        ("g. Ana Keliranelj", "ana keliranelj"), ("g. dr. Keliranelj", "keliranelj"), ("Keliranelj, g. Ana", "ana keliranelj"),
    ],
)
def test_name_words(typed, words):
    assert " ".join(names.name_words(typed)[0]) == words


LASTS = ("Keliranelj", "Mofekanec", "Zubofanič", "Trangonvranec", "Hostaninec", "Stunhendanelj")
FIRSTS = ("Ana", "Gustav", "Helena", "Peter", "Zofija", "Karel")


def directory(spark, *extra):
    """Names that forenames and forms can be learned from, and others."""
    data = [(1000 + 10 * i + j, f"{f} {last}", f"KS Kraj{i}{j}") for i, f in enumerate(FIRSTS) for j, last in enumerate(LASTS)]
    return with_clashes(spark.createDataFrame([*data, *extra], "speaker_id long, lookup_name string, organization string"))


def linked_pairs(df):
    got = rows(names.same_person_pairs(names.persons(df, "speaker_id", "lookup_name", "organization"), "speaker_id"))
    return [p for p in got if p[0] < 1000 or p[1] < 1000]


def test_forename_at_either_end(spark):
    got = rows(names.oriented(directory(spark, (1, "Mofekanec Ana", None), (2, "Novinec Peter", None), (3, "Novinec P.", None)), "lookup_name").where("lookup_name like '%Novinec%' or lookup_name like 'Mof%'"))
    assert [(r[1], r[2]) for r in got] == [("ana", "mofekanec"), ("p", "novinec"), ("peter", "novinec")]


def test_familiar_forenames_are_learned(spark):
    extra = [(i, n, f"Zveza {o}") for i, (n, o) in enumerate([(f"{f} {last}", o) for o, last in zip("ABCD", LASTS) for f in ("Helena", "Jelka")])]
    forms = directory(spark, *extra).select(F.split("lookup_name", " ")[0].alias("first"), F.split("lookup_name", " ")[1].alias("last"), F.col("organization").alias("org"), F.lit(1).alias("n"))
    assert rows(names.familiar(forms), "first", "formal") == [("Jelka", "Helena")]


def test_bodies_and_acronyms_are_learned(spark):
    written = ["Gibanje Beli most", "Gibanje Beli most (GBM)", "GBM", "G.B.M.", "Gib. Beli most", "Gibanje Bleli most", "KS Zaplana", "Krajevni svet Zaplana", "Kraj. svet Zaplana", "Zaplana, krajevni svet", "KRAJEVNI SVET ZAPLANA", "Okrajni odbor Muljava", None, "", "?!"]
    places = "Gostinje Trnovec Brezovica Lukovo Hrastnik Cerkno Podgora Vransko Ljubno Dolič Železniki Postojna Metlika Kamnik Ribnica Ormož Ptuj Senovo Šmarje Laško Ziri".split()
    others = [f"{('Zadružna zveza', 'Občinski zbor', 'Stranka')[i % 3]} {place}" for i, place in enumerate(places)]
    df = spark.createDataFrame(enumerate(written + others), "i int, b string")
    org = [r.org for r in names.bodies(df, "b").orderBy("i").collect()]
    assert len(set(org[:6])) == 1, org[:6]
    assert len(set(org[6:11])) == 1, org[6:11]
    assert org[12:15] == [""] * 3 and len(set(org[15:])) >= 20, org[12:]  # rarity is coarse in so few spellings
    assert len({org[0], org[6], org[11]}) == 3
    assert names.bodies(df.limit(0), "b").count() == 0


def test_linkage():
    a, b, s = np.array([0, 1, 0, 3]), np.array([1, 2, 2, 4]), np.array([0.9, 0.8, 0.1, 0.3])
    of = names.average_linkage(5, a, b, s, 0.4)
    assert of[0] == of[1] == of[2] and of[3] != of[4]


def test_similar_equals_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeklmnorst") for _ in range(9)) for _ in range(40)]
    texts = base + [t[:4] + t[5:] for t in base] + [t[:3] + "x" + t[4:] for t in base]
    df = spark.createDataFrame([(i, "b", t) for i, t in enumerate(texts)], "id long, block string, text string")
    v = names.vectors(df, ["text"], names.body_vector, 0.4)
    dense = np.zeros((len(texts), names.BUCKETS))
    for r in v.collect():
        dense[r.id, r.at] = r.w
    cosine = dense @ dense.T
    want = {(i, j) for i, j in permutations(range(len(texts)), 2) if i < j and cosine[i, j] >= 0.4}
    for hot in (512, 3):
        monkeypatch.setattr(names, "HOT", hot)
        assert {(r.a, r.b) for r in names.similar(v, None, 0.4).collect()} == want


@pytest.mark.parametrize(("held", "long"), [(20_000, 64), (20_000, 2), (7, 64)])
def test_met_equals_brute_force(spark, monkeypatch, held, long):
    monkeypatch.setattr(names, "HELD", held)
    monkeypatch.setattr(names, "LONG", long)
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeklmnorst") for _ in range(9)) for _ in range(30)]
    texts = base + [t[:4] + t[5:] for t in base] + [t[:3] + "x" + t[4:] for t in base]
    data = [(i, f"b{i % 2}", rng.random() < 0.7, rng.random() < 0.7, "ana" if i % 3 else "a", t, f"t{i}") for i, t in enumerate(texts)] + [(900, "alone", True, True, "ana", texts[0], "t")]
    df = spark.createDataFrame(data, "id long, block string, ask boolean, answer boolean, first string, last string, tag string")
    weights = names.rarity(df, ["first", "last"])
    dense = np.zeros((len(data), names.BUCKETS))
    for k, r in enumerate(data):
        at, w = names.name_vector(weights, r[4], r[5])
        dense[k, at] = w
    cosine = dense @ dense.T
    want = {(a[0], b[0], b[6], i % 3 > 0 and j % 3 > 0) for i, a in enumerate(data) for j, b in enumerate(data) if i != j and a[1] == b[1] and a[2] and b[3] and cosine[i, j] >= 0.5}
    got = names.met(df, names.name_vector, weights, 0.5).collect()
    assert {(r.a, r.b, r.tag, r.own) for r in got} == want and len(want) > 30
    assert all(abs(r.cosine - cosine[[d[0] for d in data].index(r.a), [d[0] for d in data].index(r.b)]) < 1e-5 for r in got)


def test_of_homes_only_the_nearest_two_are_given(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdeklmnorst") for _ in range(9)) for _ in range(12)]
    texts = [t[:k] + rng.choice("xyz") + t[k + 1 :] for t in base for k in range(8)]
    data = [(i, f"b{b}", i % 3 == 0, i % 3 > 0, "ana" if i % 4 else "a", t, f"t{i % 5}") for i, t in enumerate(texts) for b in range(1 + i % 2)]
    df = spark.createDataFrame(data, "id long, block string, ask boolean, answer boolean, first string, last string, tag string")
    weights = names.rarity(df, ["first", "last"])

    def homes(found):
        best = {}
        for r in found:
            best.setdefault(r.a, {})[r.tag] = max(best.get(r.a, {}).get(r.tag, (False, 0.0)), (r.own, round(r.cosine, 6)))
        return {a: sorted(of.items(), key=lambda x: x[1])[::-1][:2] for a, of in best.items()}

    want = homes(names.met(df, names.name_vector, weights, 0.4).collect())
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch in (before, "7"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            few = names.met(df, names.name_vector, weights, 0.4, nearest=True).collect()
            assert {a: [v for _, v in x] for a, x in homes(few).items()} == {a: [v for _, v in x] for a, x in want.items()}
            assert any(len(x) > 1 for x in want.values()) and (batch == "7" or len(few) <= 4 * len(want))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def similar_names():
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdeklmnorst") for _ in range(8)) for _ in range(10)]
    return [(rng.choice(["ana", "anica", "a", "alma"]), t[:k] + rng.choice("xyz") + t[k + 1 :]) for t in base for k in range(8) for _ in range(2)]


def groups_over_all_pairs(x, weights):
    """Groups of the rows of one part each, by average linkage over all pairs that may meet."""
    dense = np.zeros((len(x), names.BUCKETS))
    for k, (f, z) in enumerate(zip(x["first"], x["last"])):
        at, w = names.name_vector(weights, f, z)
        dense[k, at] = w
    cosine, first, rare, part = dense @ dense.T, list(x["first"]), list(x["rare"]), list(x["part"])
    may = lambda i, j: first[i] == first[j] or min(len(first[i]), len(first[j])) < 2 or rare[i] or rare[j]
    pairs = [(i, j) for i in range(len(x)) for j in range(i) if part[i] == part[j] and may(i, j) and cosine[i, j] >= 0.5]
    a, b = np.array(pairs).T
    return {tuple(np.flatnonzero(g)) for of in [names.average_linkage(len(x), a, b, cosine[a, b], 0.45)] for g in of == np.unique(of)[:, None]}


@pytest.mark.parametrize(("lot", "at_once"), [(20_000, 200_000), (9, 4), (1, 1)])
def test_names_linked_in_lots_equal_linkage_over_all_pairs(monkeypatch, lot, at_once):
    monkeypatch.setattr(names, "LOT", lot)
    monkeypatch.setattr(names, "LINKED", at_once)
    x = pd.DataFrame(similar_names(), columns=["first", "last"])
    x["part"], x["rare"] = np.arange(len(x)) % 3, x["first"] == "alma"
    weights = np.ones(names.BUCKETS, np.float32)
    group = names._linked_parts(x, lambda f, z: names.name_vector(weights, f, z), 0.5, 0.45)
    got = {tuple(np.flatnonzero(group == g)) for g in np.unique(group)}
    assert got == groups_over_all_pairs(x, weights) and 20 < len(got) < len(x)


def test_parts_may_begin_and_end_within_a_batch(spark):
    x = pd.DataFrame(similar_names(), columns=["first", "last"])
    x["part"], x["rare"], x["id"], x["home"] = np.arange(len(x)) ** 2 % 23, x["first"] == "alma", np.arange(len(x)), "h"
    weights = np.ones(names.BUCKETS, np.float32)
    want = groups_over_all_pairs(x, weights)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch in (before, "7", "1"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            got = names.linked_in_place(spark.createDataFrame(x), names.name_vector, weights, 0.5, 0.45).toPandas()
            assert len(got) == len(x) and set(got["home"]) == {"h"} and {tuple(sorted(g)) for _, g in got.groupby("person")["id"]} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_the_cosine_decides(spark):
    extra = [(1, "Ana Brodnikovec", "Zveza A"), (2, "Ana Brodinkovec", "Zveza A"), (3, "Ana Mofekanec", "Zveza A"), (5, "P. Brodnikovec", "Zveza A"), (6, "Helena Zorec", "Zveza A"), (7, "H. Zorec", "Zveza A")]
    assert linked_pairs(directory(spark, *extra)) == [(1, 2), (6, 7)]


def speakers(spark):
    data = [
        (1, "Ana Keliranelj", "GBM", datetime(1960, 1, 1).date()), (2, "KELIRANELJ, ANA", "Gibanje Beli most (GBM)", None), (3, "Ana Keliranellj", None, None), (4, "Ana Keliranelj", "KS Zaplana", None),
        (5, None, None, None), (6, "", "GBM", None), (7, "Ana Keliranelj", "GBM", datetime(1850, 1, 1).date()), (1, "Ana Keliranelj", "GBM", None), (8, "x" * 20_000, "y" * 20_000, None),
    ]
    return with_clashes(spark.createDataFrame(data, "speaker_id long, lookup_name string, organization string, session_date date"))


def test_persons(spark):
    df = speakers(spark).where("speaker_id <> 4")
    got = rows(names.same_person_pairs(names.persons(df, "speaker_id", "lookup_name", "organization"), "speaker_id"))
    assert got == [(1, 2), (1, 3), (1, 7), (2, 3), (2, 7), (3, 7)]
    two = rows(names.same_person_pairs(names.persons(speakers(spark), "speaker_id", "lookup_name", "organization"), "speaker_id"))
    assert (1, 4) not in two and (1, 2) in two
    assert names.persons(df.limit(0), "speaker_id", "lookup_name", "organization").count() == 0


def test_names_without_body(spark):
    helena, herman = (1, "Helena Keliranelj", "Zveza A"), (2, "Herman Keliranelj", "Odbor Slivnica")
    assert linked_pairs(directory(spark, helena, (3, "H. Brdnik", None))) == []
    data = [helena, (3, "Keliranelj, Helena", None), (4, "A. Keliranelj", None)]
    df = spark.createDataFrame(data, "speaker_id long, lookup_name string, organization string")
    assert linked_pairs(df) == [(1, 3)]
    # in two bodies: to none of them; a full forename comes before an initial
    df = spark.createDataFrame([helena, herman, (3, "H. Keliranelj", None)], df.schema)
    assert linked_pairs(df) == []
    df = spark.createDataFrame([helena, (2, "H. Keliranelj", "Odbor Slivnica"), (3, "Helena Keliranelj", None)], df.schema)
    assert linked_pairs(df) == [(1, 3)]


def test_matches(spark):
    columns = "binding_id long, search_name string, p_label string, given_label string, family_label string, birth string, death string, party_label string"
    register = [
        (1, None, "Keliranelj, Ana", "Ana", "Keliranelj", "3. 4. 1900", None, "Gib. Beli most"), (2, "Ana Keliranelj", None, None, None, None, None, "KS Slivnica"),
        (1, None, "Keliranelj, Ana", "Ana", "Keliranelj", "3. 4. 1900", None, "Gib. Beli most"), (3, None, None, None, None, None, None, None),
    ]
    df = speakers(spark).where("speaker_id not in (3, 4)")
    got = matching.matches(df, spark.createDataFrame(register, columns))
    assert rows(got, "speaker_id", "binding_id") == [(1, 1), (2, 1)]  # 7 spoke before the birth
    assert all(0 < r.confidence <= 1 for r in got.collect())
    assert matching.matches(df.limit(0), spark.createDataFrame(register, columns)).count() == 0


def test_assignment_is_best():
    rng = np.random.default_rng(6)
    for n, m in [(1, 1), (3, 3), (4, 2), (2, 5), (5, 5)] * 8:
        value = rng.random((n, m)).round(3) * (rng.random((n, m)) < 0.7)
        i, j = np.nonzero(value)
        to = matching.assign(i, j, value[i, j])
        assert len(set(to.values())) == len(to)
        got = sum(value[a, b] for a, b in to.items())
        best = max(sum(value[i, p[i]] for i in range(n)) for p in permutations(range(m), n)) if n <= m else max(sum(value[p[j], j] for j in range(m)) for p in permutations(range(n), m))
        assert abs(got - best) < 1e-9


def test_neighbours_equal_a_loop(spark, monkeypatch):
    monkeypatch.setattr(matching, "BUCKET", 16)
    rng = random.Random(7)
    data = [(i, i % 2, "a", "".join(rng.choice("abc") for _ in range(4)), "") for i in range(150)]
    df = spark.createDataFrame(data, "id long, side int, first string, last string, org string")
    got = {tuple(r) for r in matching.neighbours(df, [F.col("last")], 5).collect()}
    order = sorted(data, key=lambda r: (r[3], r[0]))
    want = {(a[0], b[0]) if a[1] == 0 else (b[0], a[0]) for i, a in enumerate(order) for b in order[i + 1 : i + 6] if a[1] != b[1]}
    assert got == want


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the test tables")
@pytest.mark.parametrize(("name", "most"), [("p1_found", 10_000_000), ("p5_found", 6_000_000)])
def test_steps_leave_little_on_disk(spark, name, most):
    common.checkpointed(spark.range(1))  # the folder is set
    folders = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    folders.append(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    lying, over = [], threading.Event()

    def watch():
        while not over.wait(0.1):
            sizes = subprocess.run(["du", "-sb", *folders], capture_output=True, text=True).stdout.split("\n")
            lying.append(sum(int(x.split()[0]) for x in sizes if x))

    watching = threading.Thread(target=watch)
    watching.start()
    try:
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.1").count()
    finally:
        over.set()
        watching.join()
    assert max(lying) - lying[0] < most


def test_pairs_of_alike_names_stay_off_the_disk(spark):
    rng = random.Random(8)
    stem = "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(12))
    data = [(i, f"Ana {stem}{a}{b}", "Zveza A" if i % 8 else None) for i, (a, b) in enumerate((a, b) for a in "bdfgklmnprstvzhjc" for b in (x + y for x in "aeiou" for y in "bdfgklmnprst"))]
    df = spark.createDataFrame(data, "speaker_id long, lookup_name string, organization string")
    folders = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    common.checkpointed(spark.range(1))  # the folder is set
    folders.append(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    lying, over = [], threading.Event()

    def watch():
        while not over.wait(0.02):
            sizes = subprocess.run(["du", "-sb", *folders], capture_output=True, text=True).stdout.split("\n")
            lying.append(sum(int(x.split()[0]) for x in sizes if x))

    watching = threading.Thread(target=watch)
    watching.start()
    try:
        people = names.persons(df, "speaker_id", "lookup_name", "organization")
        assert people.count() == len(data)
    finally:
        over.set()
        watching.join()
    assert max(lying) - lying[0] < 1_000_000


# --- queries -----------------------------------------------------------------------


@needs_data
@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n.endswith("_found")])
def test_found(spark, name):
    got = queries.QUERIES[name](spark, SF)
    assert got.count() == got.distinct().count()
