"""The queries over the core operators, and their SQL.

Every query runs over its whole tables. SQL is DuckDB's; queries that SQL can't
express have none and are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import corpus, footnotes, headers, jobs as batch, layout, pages, speakers, structure
from ..streaming.incremental import sessions, windowed_counts
from . import cascade, rules, volumes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
FLAGSHIP = "speech_extents"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """line_record, of repeated lines the one extracted first; only the
    columns asked for are read."""
    key = ["doc_id", "page_num", "line_idx"]
    df = table(spark, sf_dir, "line_record").select(*key, "extracted_at", *dict.fromkeys(("text", *columns)))
    return corpus.first_wins(df, key, ["extracted_at", "text"])


LINES = "L AS (SELECT * FROM line_record QUALIFY row_number() OVER (PARTITION BY doc_id, page_num, line_idx ORDER BY extracted_at, text) = 1)"


def transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "transcript_line").select("doc_id", "line_idx", "received_at", "text", "page_num")
    return corpus.first_wins(df, ["doc_id", "line_idx"], ["received_at", "text"])


SPOKEN = "T AS (SELECT * FROM transcript_line QUALIFY row_number() OVER (PARTITION BY doc_id, line_idx ORDER BY received_at, text) = 1)"


def character_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "character_run").dropDuplicates(["run_id"])


RUNS = "R AS (SELECT * FROM character_run QUALIFY row_number() OVER (PARTITION BY run_id) = 1)"


def by_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number of their day, the block of forward fills."""
    return table(spark, sf_dir, "events").withColumn("day", F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")))


# --- records and selectors ------------------------------------------------------


@query("""SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_idx, x AS text FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
  WHERE length(trim(x)) > 0""")
def line_records(spark, sf_dir):
    return layout.text_lines(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(f"""WITH {LINES} SELECT doc_id, count(*) FILTER (starts_with(text, 'Predsednik')) AS n_starts, count(*) FILTER (ends_with(text, '.')) AS n_ends,
  count(*) FILTER (regexp_matches(text, '[0-9]{{4}}')) AS n_pattern, count(*) FILTER (trim(regexp_replace(text, '\\s+', ' ', 'g')) = 'V imenu odbora') AS n_equal,
  count(*) FILTER (starts_with(text, 'V') AND NOT ends_with(text, '.') AND (contains(text, 'odbor') OR contains(text, 'zbor'))) AS n_all FROM L GROUP BY doc_id""")
def text_selectors(spark, sf_dir):
    t, n = F.col("text"), lambda c: F.count_if(c)
    both = C.all_of(C.text_matches(t, starts="V"), C.negated(C.text_matches(t, ends=".")), C.any_of(t.contains("odbor"), t.contains("zbor")))
    return lines(spark, sf_dir).groupBy("doc_id").agg(
        n(C.text_matches(t, starts="Predsednik")).alias("n_starts"), n(C.text_matches(t, ends=".")).alias("n_ends"),
        n(C.text_matches(t, pattern="[0-9]{4}")).alias("n_pattern"), n(C.text_matches(t, equals="V imenu odbora", normalize=True)).alias("n_equal"), n(both).alias("n_all"),
    )


@query("""SELECT l_returnflag, count(*) FILTER (l_quantity > 10 AND l_quantity < 20) AS n_open, count(*) FILTER (l_quantity BETWEEN 10 AND 20) AS n_closed,
  count(*) FILTER (l_discount > 0.05) AS n_above, count(*) FILTER (l_linestatus = 'O' AND NOT (l_tax > 0.04)) AS n_both FROM lineitem GROUP BY l_returnflag""")
def between_selectors(spark, sf_dir):
    q = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count_if(C.between(q, 10, 20)).alias("n_open"), F.count_if(C.between(q, 10, 20, True)).alias("n_closed"), F.count_if(C.between(F.col("l_discount"), 0.05)).alias("n_above"),
        F.count_if(C.all_of(C.attribute(F.col("l_linestatus"), "O"), C.negated(C.between(F.col("l_tax"), 0.04)))).alias("n_both"),
    )


@query("""SELECT event_type, coalesce(json_extract_string(props, '$.k'), 'none') AS k, count(*) AS n FROM events GROUP BY ALL""")
def metadata_default(spark, sf_dir):
    values = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").groupBy("event_type", C.metadata(values, "k", "none").alias("k")).agg(F.count("*").alias("n"))


@query(f"""WITH {LINES}, D AS (SELECT doc_id, CAST(max(page_num) + 1 AS BIGINT) AS n FROM L GROUP BY doc_id), P AS (SELECT *, least(4, n) AS k FROM D),
  X AS (SELECT *, unnest(generate_series(0, k - 1)) AS i FROM P)
  SELECT doc_id, i AS worker, (n // k) * i + least(i, n % k) AS start, (n // k) * (i + 1) + least(i + 1, n % k) AS "end" FROM X""")
def page_ranges(spark, sf_dir):
    docs = table(spark, sf_dir, "line_record").groupBy("doc_id").agg((F.max("page_num") + 1).cast("long").alias("n"))
    runs = layout.page_ranges(F.lit(0).cast("long"), F.col("n"), 4)
    return docs.select("doc_id", F.posexplode(runs).alias("worker", "r")).select("doc_id", F.col("worker").cast("long").alias("worker"), "r.start", "r.end")


@query(f"""WITH {LINES} SELECT doc_id, count(*) AS n_lines, count(DISTINCT page_num) AS n_pages FROM L WHERE page_num >= 1 AND page_num < 5 GROUP BY doc_id""")
def page_range_filter(spark, sf_dir):
    return lines(spark, sf_dir).where(layout.in_range(F.col("page_num"), 1, 5)).groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_distinct("page_num").alias("n_pages"))


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, max(CAST(event_type = 'error' AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM events) WHERE s = 0""")
def take_while(spark, sf_dir):
    df = layout.take_while(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")
    return df.select("user_id", "event_id", "event_type")


# --- rules -----------------------------------------------------------------------


def line_rules() -> rules.RuleGroup:
    t = F.col("text")
    return rules.RuleGroup([
        rules.Rule("NUMBER", t.rlike(r"^\W*\d+\W*$")), rules.Rule("HEAD", C.is_upper(t) & (F.length(t) <= 100) & ~t.endswith(":")),
        rules.Rule("SPEAKER", t.rlike(r"^\p{Lu}[^:]{2,72}:(\s|$)")), rules.Rule("NOTE", t.rlike(r"^\(.*\)$")),
        rules.Rule("SENTENCE", t.rlike(r"^\p{Lu}")), rules.Rule("REST", rules.FALLBACK),
    ])


RULE = """CASE WHEN text IS NULL OR text IN ('', chr(10)) THEN NULL WHEN regexp_matches(text, '^[^\\p{L}0-9_]*[0-9]+[^\\p{L}0-9_]*$') THEN 'NUMBER'
  WHEN regexp_matches(text, '\\p{Lu}') AND NOT regexp_matches(text, '[\\p{Ll}\\p{Lt}]') AND length(text) <= 100 AND NOT ends_with(text, ':') THEN 'HEAD'
  WHEN regexp_matches(text, '^\\p{Lu}[^:]{2,72}:(\\s|$)') THEN 'SPEAKER' WHEN regexp_matches(text, '^\\(.*\\)$') THEN 'NOTE' WHEN regexp_matches(text, '^\\p{Lu}') THEN 'SENTENCE' ELSE 'REST' END"""


@query(f"WITH {LINES} SELECT doc_id, coalesce({RULE}, 'UNMATCHED') AS rule, count(*) AS n FROM L GROUP BY ALL")
def rule_first_match(spark, sf_dir):
    df = lines(spark, sf_dir).withColumn("rule", line_rules().first_match(F.col("text")))
    return rules.rule_counts(df, ["doc_id"], "rule")


@query(f"""WITH {SPOKEN}, M AS (SELECT *, {RULE} AS rule FROM T)
  SELECT doc_id, line_idx, rule, last_value(CASE WHEN rule = 'SPEAKER' THEN line_idx END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_idx) AS opened FROM M""")
def rule_fallback(spark, sf_dir):
    df = transcript(spark, sf_dir).withColumn("rule", line_rules().first_match(F.col("text")))
    df = rules.carried(df.withColumn("block", F.floor(F.col("line_idx") / 64)), "doc_id", "block", ["line_idx"], F.when(F.col("rule") == "SPEAKER", F.col("line_idx")), "opened")
    return df.select("doc_id", "line_idx", "rule", "opened")


@query("""SELECT CASE WHEN c > 4550 AND c < 6560 THEN 'center' WHEN c > 2500 AND c < 3660 THEN 'left' WHEN c > 7820 AND c < 8460 THEN 'right' ELSE '_else' END AS alignment,
  count(*) AS n FROM (SELECT l_extendedprice / 10 + l_quantity * 10 / 2 AS c FROM lineitem) GROUP BY 1""")
def alignment_router(spark, sf_dir):
    group = rules.aligned(F.col("l_extendedprice") / 10, F.col("l_quantity") * 10)
    return table(spark, sf_dir, "lineitem").groupBy(group.alias("alignment")).agg(F.count("*").alias("n"))


@query(f"""WITH {LINES}, M AS (SELECT doc_id, {RULE} AS rule, font_name, font_size, page_num FROM L)
  SELECT doc_id, 'rule' AS key, rule AS value, count(*) AS n FROM M GROUP BY ALL UNION ALL SELECT doc_id, 'font_name', font_name, count(*) FROM M GROUP BY ALL
  UNION ALL SELECT doc_id, 'font_size', CAST(font_size AS VARCHAR), count(*) FROM M GROUP BY ALL UNION ALL SELECT doc_id, 'page_num', CAST(page_num AS VARCHAR), count(*) FROM M GROUP BY ALL""")
def diagnostics(spark, sf_dir):
    df = lines(spark, sf_dir, "font_name", "font_size").withColumn("rule", line_rules().first_match(F.col("text")))
    return rules.diagnostics(df, "doc_id", ["rule", "font_name", "font_size", "page_num"])


@query(f"""WITH {LINES} SELECT doc_id, page_num, line_idx, text, sample FROM (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_num, line_idx) AS INTEGER) AS sample
  FROM L WHERE {RULE} = 'REST') WHERE sample <= 25""")
def unmatched_samples(spark, sf_dir):
    df = lines(spark, sf_dir).where(line_rules().first_match(F.col("text")) == "REST")
    return rules.samples(df, ["doc_id"], ["page_num", "line_idx"]).select("doc_id", "page_num", "line_idx", "text", "sample")


# --- rule sets ------------------------------------------------------------------------

_MEASURED = ("x", "y", "x_end", "font_size", "runs", "page_width", "page_height")


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "line_profile").select("doc_id", "body_size", "styled")


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.measured(lines(spark, sf_dir, *_MEASURED), profiles(spark, sf_dir))


_SEJ = r"(sej(a|e|i|o|ah|ami)?|s(jed|ed)nic(a|e|i|o|u|om|ama)?|zas(jed|ed)anj(e|a|u|em|ima)?)"
_NUMBERED = rf"[0-9]+\.\s*((izredn|redn|skupn|zajedni)[\p{{L}}\p{{N}}_]*\s+)?{_SEJ}"
_END, _BEGIN = r"([^\p{L}\p{N}_]|$)", r"(^|[^\p{L}\p{N}_])"
#: Measured lines (M) in SQL.
MEASURED = rf"""P AS (SELECT doc_id, max(body_size) AS bs, max(styled) AS st FROM line_profile GROUP BY doc_id),
  M AS (SELECT L.doc_id, L.page_num, L.line_idx, L.text, L.x, L.y, L.font_size, L.page_height, L.page_width, trim(regexp_replace(L.text, '\s+', ' ', 'g')) AS t, coalesce(P.bs, 10.0) AS body, coalesce(P.st, false) AS styled,
    min(L.x) OVER (PARTITION BY L.doc_id, L.page_num) AS "left", coalesce(list_bool_or(list_transform(runs, lambda r: contains(lower(r.font_name), 'bold'))), false) AS bold,
    len(list_filter(runs, lambda r: trim(r.text) <> '')) > 0 AND coalesce(list_bool_and(list_transform(list_filter(runs, lambda r: trim(r.text) <> ''), lambda r: coalesce(regexp_matches(lower(r.font_name), 'italic|oblique'), false))), false) AS italic,
    regexp_matches(L.text, '\p{{Lu}}') AND NOT regexp_matches(L.text, '[\p{{Ll}}\p{{Lt}}]') AS upper, length(regexp_replace(regexp_extract(L.text, '^[^\p{{Ll}}]*'), '[^\p{{Lu}}]', '', 'g')) AS caps FROM L LEFT JOIN P ON L.doc_id = P.doc_id)"""


@query(r"""WITH {LINES}, {MEASURED}, G AS (SELECT *, coalesce(bool_or(regexp_matches(t, '(?i){_BEGIN}{_NUMBERED}{_END}')) OVER (PARTITION BY doc_id, page_num), false) AS page FROM M)
  SELECT doc_id, rule, CAST(n AS BIGINT) AS n FROM (UNPIVOT (SELECT doc_id, count(*) FILTER (page AND font_size >= 11.5) AS "SESSION_HEADING", count(*) FILTER (page AND regexp_matches(t, '^\(\s*d\..*19[0-9][0-9]\.?\s*\)\.?$')) AS "SESSION_DATE",
    count(*) FILTER (page AND starts_with(lower(t), 'predsedoval')) AS "CHAIRMAN", count(*) FILTER (page AND regexp_matches(t, '(?i)^(Zapisnikar|Tajnik)[\p{{L}}\p{{N}}_]*\s*:')) AS "SCRIBE",
    count(*) FILTER (page AND regexp_matches(t, '(?i)^(Začetek|Pričetek|Kačctek)\s+seje{_END}')) AS "START_TIME", count(*) FILTER (x >= "left" + 8 AND (starts_with(t, '(') OR regexp_matches(t, '(?i)^Seja\s+(je\s+)?bila{_END}'))) AS "GENERIC_NOTE",
    count(*) FILTER (font_size BETWEEN 8.8 AND 10.6 AND y > 34 AND y < 590 AND x >= "left" + 14) AS "SEG" FROM G GROUP BY doc_id) ON * EXCLUDE (doc_id) INTO NAME rule VALUE n)""".format(LINES=LINES, MEASURED=MEASURED, _BEGIN=_BEGIN, _END=_END, _NUMBERED=_NUMBERED))
def sessions_1957_tests(spark, sf_dir):
    tests = {k: v for k, v in volumes.sessions_of_1957()[0].items() if k != "SPEAKER"}
    return volumes.test_counts(volumes.prepared(measured(spark, sf_dir)), tests)


@query(r"""WITH {LINES}, {MEASURED} SELECT doc_id, rule, CAST(n AS BIGINT) AS n FROM (UNPIVOT (SELECT doc_id, count(*) FILTER (x < 160 AND y > 640 AND upper AND starts_with(t, 'OD ')) AS "SEJA_DATE", count(*) FILTER (x < 160 AND y > 640 AND upper AND contains(t, 'SEDNICA')) AS "SEJA_NUM",
    count(*) FILTER (x < 160 AND y > 640 AND upper) AS "SEJA_DECLARATION", count(*) FILTER (x > 200 AND x < 285 AND (starts_with(t, 'PREDSEDAVA') OR upper)) AS "CHAIRMAN", count(*) FILTER (x > 200 AND x < 285 AND (starts_with(t, 'Početak') OR italic)) AS "TIME",
    count(*) FILTER (starts_with(t, 'SADR')) AS "CONTENTS", count(*) FILTER (x > 140 AND x < 280 AND italic) AS "GENERIC_NOTE", count(*) FILTER (ends_with(t, ':') AND length(t) < 100 AND bold) AS "SPEAKER",
    count(*) FILTER (font_size > 10.4 AND font_size < 11.6 AND CASE WHEN page_num % 2 = 0 THEN x > 60 AND x < 90 ELSE x > 75 AND x < 105 END) AS "SEG" FROM M GROUP BY doc_id) ON * EXCLUDE (doc_id) INTO NAME rule VALUE n)""".format(LINES=LINES, MEASURED=MEASURED))
def chamber_tests(spark, sf_dir):
    tests = {k: v for k, v in volumes.chamber()[0].items() if not k.startswith("s_")}
    return volumes.test_counts(volumes.prepared(measured(spark, sf_dir)), tests)


@query(r"""WITH {LINES}, {MEASURED}, G AS (SELECT *, coalesce(page_num <> lag(page_num, 1) OVER f, false) OR coalesce(page_num <> lag(page_num, 2) OVER f, false) OR coalesce(page_num <> lag(page_num, 3) OVER f, false) AS turn,
    coalesce(line_idx = min(CASE WHEN coalesce(NOT ((y > 724 AND y < 742) OR length(t) <= 2), false) THEN line_idx END) OVER p, false) AS top, abs(x - lag(x) OVER (PARTITION BY doc_id, page_num ORDER BY line_idx)) AS dx, abs(y - lag(y) OVER (PARTITION BY doc_id, page_num ORDER BY line_idx)) AS dy
    FROM M WINDOW f AS (PARTITION BY doc_id ORDER BY page_num, line_idx), p AS (PARTITION BY doc_id, page_num))
  SELECT doc_id, rule, CAST(n AS BIGINT) AS n FROM (UNPIVOT (SELECT doc_id, count(*) FILTER (turn) AS "HEADER", count(*) FILTER (y > 605 AND y < 610 AND bold) AS "SEJA_DECLARATION", count(*) FILTER (italic AND y > 590 AND y < 600) AS "TIME",
    count(*) FILTER (starts_with(t, 'PREDSEDUJE') AND NOT italic AND x > 174) AS "CHAIRMAN", count(*) FILTER (upper AND x > 194 AND x < 360 AND top) AS "SEJA_SECTION", count(*) FILTER ((font_size = 7.0 OR (font_size > 6.9 AND font_size < 7.0)) AND regexp_matches(t, '^[0-9]+')) AS "REFERENCE_ENTRY",
    count(*) FILTER (x > 323 AND x < 457 AND italic AND t <> '') AS "GENERIC_NOTE", count(*) FILTER (((x > 0 AND x < 55) OR (x > 271 AND x < 293)) AND caps >= 5) AS "SPEAKER",
    count(*) FILTER (CASE WHEN dx IS NULL OR dx > 240 OR coalesce(dy > 230, false) THEN font_size > 8.9 AND font_size < 10.1 ELSE ((x >= CASE WHEN page_num <= 2 THEN 48.0 ELSE 41.0 END AND x <= 64) OR (x >= 287 AND x <= 303)) AND font_size >= 9.0 AND font_size < 10.1 END) AS "SEG" FROM G GROUP BY doc_id) ON * EXCLUDE (doc_id) INTO NAME rule VALUE n)""".format(LINES=LINES, MEASURED=MEASURED))
def republics_tests(spark, sf_dir):
    tests = {k: v for k, v in volumes.republics()[0].items() if not k.startswith("s_")}
    return volumes.test_counts(volumes.prepared(measured(spark, sf_dir)), tests)


@query(r"""WITH {LINES}, {MEASURED} SELECT doc_id, rule, CAST(n AS BIGINT) AS n FROM (UNPIVOT (SELECT doc_id, count(*) FILTER (regexp_matches(t, '(?i)^(SADR[ŽZ]AJ|VSEBINA){_END}')) AS "CONTENTS",
    count(*) FILTER (regexp_matches(t, '(?i)^(Zapisnikar|Tajnik)[\p{{L}}\p{{N}}_]*\s*:')) AS "SCRIBE" FROM M GROUP BY doc_id) ON * EXCLUDE (doc_id) INTO NAME rule VALUE n)""".format(LINES=LINES, MEASURED=MEASURED, _END=_END))
def cascade_marks(spark, sf_dir):
    """Tests of the general cascade that read a line's text alone."""
    return volumes.test_counts(measured(spark, sf_dir), {k: v for k, v in cascade.tests().items() if k in ("CONTENTS", "SCRIBE")})


@query()
def cascade_tests(spark, sf_dir):
    """On how many lines of a document each test of the cascade holds."""
    return volumes.test_counts(measured(spark, sf_dir), cascade.tests())


@query()
def cascade_rules(spark, sf_dir):
    """The rule of the general cascade that each line gets."""
    df = cascade.classified(lines(spark, sf_dir, *_MEASURED), profiles(spark, sf_dir))
    return rules.rule_counts(df, ["doc_id"], "rule")


@query()
def cascade_tree(spark, sf_dir):
    """Nodes of the trees of the general cascade."""
    df = cascade.classified(lines(spark, sf_dir, *_MEASURED), profiles(spark, sf_dir)).select("doc_id", F.explode("nodes").alias("n"))
    return df.select("doc_id", "n.node_id", "n.parent_id", "n.depth", "n.kind", "n.tag", F.to_json("n.attrs").alias("attrs"), "n.text")


@query()
def speaker_usage(spark, sf_dir):
    """Who speaks in scanned volumes, and in how many utterances."""
    from .. import api

    return api.parse(lines(spark, sf_dir, *_MEASURED), profiles(spark, sf_dir)).speakers()


def _volume(name: str):
    def run(spark, sf_dir):
        return rules.rule_counts(volumes.classified(measured(spark, sf_dir), name), ["doc_id"], "rule")

    run.__name__ = f"{name}_rules"
    run.__doc__ = "The rule of the volume's set that each line gets."
    return run


for _name in volumes.SETS:
    query()(_volume(_name))


# --- layout --------------------------------------------------------------------------


@query(f"""WITH {LINES}, D AS (SELECT *, lag(y) OVER (PARTITION BY doc_id, page_num ORDER BY line_idx) - y AS d FROM L)
  SELECT doc_id, page_num, count(*) AS n, CAST(sum(CAST(coalesce(abs(d) > 2.5, false) AS INTEGER)) AS BIGINT) + 1 AS n_lines FROM D GROUP BY ALL""")
def line_grouping(spark, sf_dir):
    df = layout.line_groups(lines(spark, sf_dir, "y"), ["doc_id", "page_num"], ["line_idx"], "y", 2.5)
    return df.groupBy("doc_id", "page_num").agg(F.count("*").alias("n"), (F.max("line_id") + 1).alias("n_lines"))


@query(f"""WITH {LINES}, D AS (SELECT *, lag(y) OVER (PARTITION BY doc_id, page_num ORDER BY line_idx) - y AS d FROM L)
  SELECT doc_id, page_num, count(*) AS n, CAST(sum(CAST(coalesce(d > 2.5 OR abs(d) > 12.5, false) AS INTEGER)) AS BIGINT) + 1 AS n_lines FROM D GROUP BY ALL""")
def line_grouping_downward(spark, sf_dir):
    df = layout.line_groups(lines(spark, sf_dir, "y"), ["doc_id", "page_num"], ["line_idx"], "y", 2.5, downward=True)
    return df.groupBy("doc_id", "page_num").agg(F.count("*").alias("n"), (F.max("line_id") + 1).alias("n_lines"))


@query("""WITH C AS (SELECT *, event_type IS DISTINCT FROM lag(event_type) OVER w AND row_number() OVER w > 1 AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  I AS (SELECT *, CAST(sum(CAST(c AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS island FROM C)
  SELECT user_id, island, min(event_type) AS event_type, count(*) AS n, min(event_id) AS first_id FROM I GROUP BY user_id, island""")
def run_islands(spark, sf_dir):
    df = layout.block_islands(by_days(spark, sf_dir), "user_id", "day", ["ts", "event_id"], ["event_type"])
    return df.groupBy("user_id", "island").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query(f"""WITH {RUNS}, C AS (SELECT *, row_number() OVER w > 1 AND (font_name IS DISTINCT FROM lag(font_name) OVER w OR font_size IS DISTINCT FROM lag(font_size) OVER w OR coalesce(abs(x0 - lag(x0) OVER w) >= 200, false)) AS c
  FROM R WINDOW w AS (PARTITION BY doc_id, page_num ORDER BY seq, run_id)) SELECT doc_id, page_num, count(*) AS n, CAST(sum(CAST(c AS INTEGER)) AS BIGINT) + 1 AS n_runs FROM C GROUP BY ALL""")
def run_grouping(spark, sf_dir):
    df = layout.run_groups(character_runs(spark, sf_dir), ["doc_id", "page_num"], ["seq", "run_id"], "font_name", "font_size", "x0", 200.0)
    return df.groupBy("doc_id", "page_num").agg(F.count("*").alias("n"), (F.max("run_id") + 1).alias("n_runs"))


@query(f"""WITH {RUNS}, C AS (SELECT *, coalesce(x0 - lag(x1) OVER (PARTITION BY doc_id, page_num, y0 ORDER BY seq, run_id) > 1.7, false) AS s FROM R)
  SELECT doc_id, page_num, y0, string_agg(CASE WHEN s THEN ' ' ELSE '' END || text, '' ORDER BY seq, run_id) AS text FROM C WHERE text IS NOT NULL GROUP BY ALL""")
def gap_spacing(spark, sf_dir):
    by = ["doc_id", "page_num", "y0"]
    df = layout.spaced(character_runs(spark, sf_dir), by, ["seq", "run_id"], "x0", "x1", 1.7)
    return layout.joined_text(df.where("text is not null"), by, ["seq", "run_id"], "text", F.col("space_before"))


@query(f"""WITH {LINES} SELECT doc_id, page_num, line_idx, coalesce(NOT lag(ends_with(text, ' ')) OVER (PARTITION BY doc_id ORDER BY page_num, line_idx), false) AS space_before FROM L""")
def pending_space(spark, sf_dir):
    df = layout.pending_space(lines(spark, sf_dir), "doc_id", "page_num", ["line_idx"], F.col("text").endswith(" "))
    return df.select("doc_id", "page_num", "line_idx", "space_before")


@query(f"""WITH {LINES}, O AS (SELECT *, y < 50 OR page_height - y < 45 AS o, regexp_matches(rtrim(text), '[-‐‑]$') AND NOT (y < 50 OR page_height - y < 45) AS h FROM L)
  SELECT doc_id, page_num, line_idx, CASE WHEN h THEN regexp_replace(rtrim(text), '[-‐‑]$', '') ELSE text END AS text_joined,
  CASE WHEN row_number() OVER w = 1 THEN false ELSE NOT coalesce(last_value(CASE WHEN NOT o THEN h END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page_num, line_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) END AS space_before
  FROM O WINDOW w AS (PARTITION BY doc_id ORDER BY page_num, line_idx)""")
def dehyphenate(spark, sf_dir):
    out = (F.col("y") < 50) | (F.col("page_height") - F.col("y") < 45)
    df = layout.dehyphenated(lines(spark, sf_dir, "y", "page_height"), "doc_id", "page_num", ["line_idx"], "text", out)
    return df.select("doc_id", "page_num", "line_idx", "text_joined", "space_before")


@query(f"""WITH {LINES}, G AS (SELECT *, CAST(coalesce(x - lag(x) OVER (PARTITION BY doc_id, page_num ORDER BY x) > 0.18 * page_width, false) AS INTEGER) AS g FROM L WHERE x IS NOT NULL),
  K AS (SELECT *, CAST(sum(g) OVER (PARTITION BY doc_id, page_num ORDER BY x ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM G),
  N AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page_num, cluster ORDER BY x RANGE BETWEEN CURRENT ROW AND 3.0 FOLLOWING) AS near, count(*) OVER (PARTITION BY doc_id, page_num, cluster) AS k FROM K)
  SELECT doc_id, page_num, cluster, coalesce(min(x) FILTER (near >= greatest(3, k // 20)), min(x)) AS edge, count(*) AS n FROM N GROUP BY ALL""")
def column_clusters(spark, sf_dir):
    df = lines(spark, sf_dir, "x", "page_width").where("x is not null")
    return layout.column_edges(df, ["doc_id", "page_num"], "x", F.col("page_width") * 0.18)


@query(f"""WITH {LINES} SELECT doc_id, page_num, line_idx, coalesce(list_max(list_filter([72.0, 84.0, 230.0, 330.0], lambda c: c <= x + 2)), x) AS col,
  list_min(list_transform([72.0, 84.0, 230.0, 330.0], lambda c: abs(x - c))) AS distance FROM L""")
def nearest_column(spark, sf_dir):
    known = F.array(*[F.lit(c) for c in (72.0, 84.0, 230.0, 330.0)])
    return lines(spark, sf_dir, "x").select("doc_id", "page_num", "line_idx", layout.nearest_column(F.col("x"), known).alias("col"), layout.column_distance(F.col("x"), known).alias("distance"))


@query()
def anchor_clusters(spark, sf_dir):
    """Clusters of x on each page, by distance from a cluster's first."""
    return layout.anchor_clusters(lines(spark, sf_dir, "x"), ["doc_id", "page_num"], "x", "line_idx", 6.0)


@query()
def merged_runs(spark, sf_dir):
    """Runs of each line before and after nearby ones are merged."""
    df = lines(spark, sf_dir, "runs").select("doc_id", "page_num", "line_idx", F.size("runs").alias("n_before"), layout.merged_runs(F.col("runs")).alias("merged"))
    return df.select("doc_id", "page_num", "line_idx", "n_before", F.size("merged").alias("n_after"), F.to_json("merged").alias("runs"))


@query("""SELECT user_id, event_id, last_value(CASE WHEN event_type <> 'error' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM events""")
def previous_in_flow(spark, sf_dir):
    df = layout.previous_in_flow(by_days(spark, sf_dir), "user_id", "day", ["ts", "event_id"], "event_id", F.col("event_type") == "error")
    return df.select("user_id", "event_id", "previous")


@query(f"""WITH {LINES} SELECT a.doc_id, a.page_num, a.line_idx FROM L a WHERE EXISTS (SELECT 1 FROM L b WHERE a.doc_id = b.doc_id AND a.page_num = b.page_num AND a.line_idx <> b.line_idx
  AND abs(a.y - b.y) <= 2.5 AND b.x >= a.x + 0.15 * a.page_width)""")
def band_semi_join(spark, sf_dir):
    df = layout.band_semi_join(lines(spark, sf_dir, "x", "y", "page_width"), ["doc_id", "page_num"], "line_idx", "y", "x", F.col("page_width"))
    return df.select("doc_id", "page_num", "line_idx")


@query(f"""WITH {LINES}, K AS (SELECT *, nullif(regexp_extract(text, '^\\s*(\\S+)', 1), '') AS k FROM L) SELECT a.doc_id, a.page_num, a.line_idx FROM K a WHERE EXISTS (SELECT 1 FROM K b
  WHERE a.doc_id = b.doc_id AND a.page_num = b.page_num AND a.line_idx <> b.line_idx AND a.k = b.k AND abs(a.x - b.x) <= 1.5)""")
def peer_semi_join(spark, sf_dir):
    key = F.nullif(F.regexp_extract("text", r"^\s*(\S+)", 1), F.lit(""))
    df = layout.peer_semi_join(lines(spark, sf_dir, "x"), ["doc_id", "page_num"], "line_idx", key, "x", 1.5)
    return df.select("doc_id", "page_num", "line_idx")


@query()
def word_lines(spark, sf_dir):
    """Runs of characters gathered into lines by a moving anchor."""
    return layout.word_lines(character_runs(spark, sf_dir), ["doc_id", "page_num"], "run_id", "y0", "font_size")


@query(f"""WITH {LINES}, P AS (SELECT doc_id, max(body_size) AS body FROM line_profile GROUP BY doc_id), U AS (SELECT doc_id, page_num, line_idx, unnest(runs) AS r, generate_subscripts(runs, 1) - 1 AS i FROM L),
  D AS (SELECT U.*, coalesce(regexp_matches(trim(r.text), '^[0-9]+$') AND r.font_size <= coalesce(body, 10.0), false) AS d FROM U LEFT JOIN P USING (doc_id)),
  C AS (SELECT *, d IS DISTINCT FROM lag(d) OVER w AND row_number() OVER w > 1 AS c FROM D WINDOW w AS (PARTITION BY doc_id, page_num, line_idx ORDER BY i)), S AS (SELECT *, sum(CAST(c AS INTEGER)) OVER (PARTITION BY doc_id, page_num, line_idx ORDER BY i) AS g FROM C)
  SELECT doc_id, page_num, line_idx, CAST(min(i) AS INTEGER) AS i, string_agg(trim(r.text), '' ORDER BY i) AS number FROM S WHERE d GROUP BY doc_id, page_num, line_idx, g""")
def numeric_groups(spark, sf_dir):
    """Figures no larger than the body's type, neighbours as one number."""
    body = table(spark, sf_dir, "line_profile").groupBy("doc_id").agg(F.max("body_size").alias("body"))
    runs = footnotes.exploded_runs(lines(spark, sf_dir, "runs", "page_height"), body)
    return layout.numeric_groups(runs, ["doc_id", "page_num", "line_idx"], "i", "text", F.col("font_size") <= F.col("body"))


@query(f"""WITH {LINES}, R AS (SELECT doc_id, page_num, line_idx, list_filter(runs, lambda r: trim(r.text) <> '') AS s, runs FROM L), U AS (SELECT doc_id, page_num, line_idx, round(x.font_size, 2) AS z, i FROM (SELECT *, unnest(s) AS x, generate_subscripts(s, 1) AS i FROM R)),
  M AS (SELECT doc_id, page_num, line_idx, z FROM (SELECT doc_id, page_num, line_idx, z, count(*) AS n, min(i) AS f FROM U GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY doc_id, page_num, line_idx ORDER BY n DESC, f) = 1)
  SELECT doc_id, page_num, line_idx, list_min(list_transform(runs, lambda r: r.x)) AS x0, list_max(list_transform(runs, lambda r: r.x)) AS x1, list_transform(list_filter(s, lambda r: abs(r.font_size - z) < 0.05), lambda r: r.y)[1] AS baseline,
  len(runs) > 0 AND coalesce(list_bool_and(list_transform(runs, lambda r: contains(lower(coalesce(r.font_name, '')), 'bold'))), false) AS bold, len(runs) > 0 AND coalesce(list_bool_and(list_transform(runs, lambda r: contains(lower(coalesce(r.font_name, '')), 'italic'))), false) AS italic
  FROM R LEFT JOIN M USING (doc_id, page_num, line_idx)""")
def line_boxes(spark, sf_dir):
    """Extent, baseline and style of every line, from its runs."""
    return lines(spark, sf_dir, "runs").select("doc_id", "page_num", "line_idx", footnotes.line_box(F.col("runs")).alias("b")).select("doc_id", "page_num", "line_idx", "b.*")


def _marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = table(spark, sf_dir, "line_profile").groupBy("doc_id").agg((F.max("body_size") + 2.0).alias("body"))  # the volumes have no smaller figures
    return footnotes.marks(footnotes.exploded_runs(lines(spark, sf_dir, "runs", "page_height"), body))


@query()
def footnote_marks(spark, sf_dir):
    """Marks of figures on lines, with what tells references from definitions."""
    return _marks(spark, sf_dir)


@query()
def footnote_definitions(spark, sf_dir):
    return footnotes.definitions_and_references(_marks(spark, sf_dir))[0]


# --- pages and profiles -----------------------------------------------------------------


@query(f"""WITH {LINES}, U AS (SELECT doc_id, page_num, line_idx, unnest(runs) AS r FROM L), W AS (SELECT doc_id, r.font_name AS f, sum(greatest(1, length(r.text))) AS w, min((page_num, line_idx)) AS o FROM U WHERE r.font_name IS NOT NULL GROUP BY ALL)
  SELECT doc_id, f AS font_name FROM W QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, o) = 1""")
def weighted_mode(spark, sf_dir):
    runs = lines(spark, sf_dir, "runs").select("doc_id", "page_num", "line_idx", F.explode("runs").alias("r")).select("doc_id", "page_num", "line_idx", "r.text", F.col("r.font_name").alias("font"))
    return pages.weighted_mode(runs, ["doc_id"], "font", F.greatest(F.lit(1), F.length("text")), F.struct("page_num", "line_idx"), "font_name")


@query(f"""WITH {LINES}, U AS (SELECT doc_id, page_num, line_idx, unnest(runs) AS r FROM L),
  S AS (SELECT doc_id, coalesce(sum(length(r.text)), 0) AS n, coalesce(sum(length(r.text) - length(replace(r.text, ' ', ''))), 0) AS b,
    coalesce(bool_or(regexp_matches(lower(r.font_name), 'invisible|ocr')), false) AS ocr, coalesce(bool_or(regexp_matches(lower(r.font_name), 'bold|italic')), false) AS fancy FROM U GROUP BY doc_id),
  H AS (SELECT doc_id, round_even(r.font_size * 2, 0) / 2 AS h, sum(length(trim(r.text))) AS w, min((page_num, line_idx)) AS o FROM U WHERE length(trim(r.text)) > 0 AND r.font_size IS NOT NULL GROUP BY ALL),
  B AS (SELECT doc_id, h FROM H QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, o) = 1)
  SELECT S.doc_id, coalesce(h, 10.0) AS body_size, b / greatest(n, 1) AS space_ratio, CASE WHEN ocr OR n = 0 THEN 'ocr' WHEN b / greatest(n, 1) < 0.05 THEN 'char-break' ELSE 'char-preserve' END AS mode,
  NOT (ocr OR n = 0) AND fancy AS styled FROM S LEFT JOIN B USING (doc_id)""")
def doc_profile(spark, sf_dir):
    runs = lines(spark, sf_dir, "runs").select("doc_id", "page_num", "line_idx", F.explode("runs").alias("r")).select("doc_id", "page_num", "line_idx", "r.text", "r.font_name", "r.font_size")
    return pages.document_profile(runs, "doc_id", "text", "font_name", "font_size", F.struct("page_num", "line_idx"))


MARKS = rf"""M AS (SELECT doc_id, page_num, coalesce(bool_or(regexp_matches(text, '(?i){_BEGIN}{_NUMBERED}{_END}')), false) AS session,
  coalesce(bool_or(regexp_matches(text, '(?i){_BEGIN}{_NUMBERED}{_END}') AND regexp_matches(text, '(?i){_BEGIN}(sej(a|e|i|o|ah|ami)?|s(jed|ed)nic(a|e|i|o|u|om|ama)?){_END}')), false) AS debate,
  coalesce(bool_or(regexp_matches(text, '^\p{{Lu}}') AND regexp_matches(text, '(?i)^(pred?sedni[kc][\p{{L}}\p{{N}}_]*|podpredsedni[\p{{L}}\p{{N}}_]*|potpredsedni[\p{{L}}\p{{N}}_]*|predsedujo\S+|predsedava[\p{{L}}\p{{N}}_]*)\s+(dr\.?\s+)?\S.{{0,70}}:')), false) AS cue,
  coalesce(bool_or(regexp_matches(text, '(?i)^SEZNAM\s+GOVORNIKOV{_END}')), false) AS "index", coalesce(bool_or(regexp_matches(text, '^PRILOG[EIA]?{_END}')), false) AS appendix,
  coalesce(bool_or(regexp_matches(text, '\p{{Lu}}') AND NOT regexp_matches(text, '[\p{{Ll}}\p{{Lt}}]') AND regexp_matches(text, '(?i)^\s*[0-9]+\.\s*(TOČK[AE]|TAČK[AE])\s+(DNEVNEGA|DNEVNOG)\s+REDA{_END}')), false) AS agenda FROM L GROUP BY ALL)"""


@query(f"WITH {LINES}, {MARKS} SELECT * FROM M")
def page_marks(spark, sf_dir):
    return pages.page_marks(lines(spark, sf_dir), ["doc_id", "page_num"], "text")


@query(f"""WITH {LINES}, {MARKS}, A AS (SELECT *, bool_or(session) OVER w AS seen, debate AND cue AS strong, coalesce(last_value(CASE WHEN appendix THEN true WHEN debate AND cue THEN false END IGNORE NULLS) OVER w, false) AS back_matter FROM M
    WINDOW w AS (PARTITION BY doc_id ORDER BY page_num)),
  B AS (SELECT *, CASE WHEN lag(back_matter, 1, false) OVER (PARTITION BY doc_id ORDER BY page_num) THEN strong ELSE debate OR (seen AND cue) END AS resume FROM A),
  C AS (SELECT *, bool_or(resume) OVER w AS seen_session, coalesce(last_value(CASE WHEN "index" THEN true WHEN resume THEN false END IGNORE NULLS) OVER w, false) AS speaker_index FROM B WINDOW w AS (PARTITION BY doc_id ORDER BY page_num))
  SELECT doc_id, page_num, seen_session, back_matter, speaker_index, seen_session AND NOT speaker_index AND NOT back_matter AS structure_active, (seen_session AND NOT speaker_index AND NOT back_matter) OR session AS heading_active FROM C""")
def page_automaton(spark, sf_dir):
    df = pages.page_automaton(pages.page_marks(lines(spark, sf_dir), ["doc_id", "page_num"], "text"), "doc_id", "page_num")
    return df.select("doc_id", "page_num", "seen_session", "back_matter", "speaker_index", "structure_active", "heading_active")


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = table(spark, sf_dir, "line_profile").groupBy("doc_id").agg(F.coalesce(F.max("body_size"), F.lit(pages.DEFAULT_SIZE)).alias("body"))
    df = lines(spark, sf_dir, "y", "font_size", "page_height").join(profile, "doc_id", "left")
    kind = pages.artifact_kind(F.col("text"), F.col("y"), F.col("font_size"), F.col("page_height"), F.coalesce("body", F.lit(pages.DEFAULT_SIZE)))
    return df.withColumn("kind", kind).where("kind is not null")


ARTIFACTS = r"""P AS (SELECT doc_id, coalesce(max(body_size), 10.0) AS body FROM line_profile GROUP BY doc_id), J AS (SELECT L.*, coalesce(body, 10.0) AS b FROM L LEFT JOIN P USING (doc_id)),
  Q AS (SELECT *, y > page_height * 0.915 AND (font_size <= b - 1 OR length(trim(text)) <= 4) AS top FROM J),
  K AS (SELECT doc_id, page_num, line_idx, text, CASE WHEN regexp_matches(text, '(?i)^SEZNAM\s+GOVORNIKOV([^\p{L}\p{N}_]|$)') THEN 'speakerIndex' WHEN top AND regexp_matches(trim(text), '^[0-9]+$') THEN 'pageNumber' WHEN top THEN 'runningHeader'
    WHEN y < page_height * 0.085 AND font_size <= b - 1 AND regexp_matches(text, '(?i)^([0-9]+\s+)?(st|[šs]t)\.?\s+(bele[žšz]k|zapis)[\p{L}\p{N}_]*') THEN 'runningFooter' END AS kind FROM Q)"""


@query(f"WITH {LINES}, {ARTIFACTS} SELECT doc_id, page_num, line_idx, kind FROM K WHERE kind IS NOT NULL")
def source_artifacts(spark, sf_dir):
    return artifacts(spark, sf_dir).select("doc_id", "page_num", "line_idx", "kind")


@query(f"""WITH {LINES}, {ARTIFACTS}, N AS (SELECT doc_id, kind, page_num, string_agg(text, chr(10) ORDER BY line_idx) AS text, min(line_idx) AS f FROM K WHERE kind IS NOT NULL GROUP BY ALL)
  SELECT doc_id, kind, page_num, text, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_num, f) AS INTEGER) AS ord FROM N""")
def artifact_notes(spark, sf_dir):
    return pages.artifact_notes(artifacts(spark, sf_dir), ["doc_id"], "kind", "page_num", "line_idx", "text")


@query(f"""WITH {LINES}, P AS (SELECT doc_id, max(body_size) AS body FROM line_profile GROUP BY doc_id)
  SELECT doc_id, count(*) AS n, count(*) FILTER (coalesce(abs(font_size - body) <= 1.6, false)) AS n_body,
  count(*) FILTER (abs(x - (page_width - coalesce(x_end, x + length(text) * font_size * 0.48))) <= greatest(18.0, page_width * 0.06)) AS n_centered FROM L LEFT JOIN P USING (doc_id) GROUP BY doc_id""")
def line_geometry(spark, sf_dir):
    profile = table(spark, sf_dir, "line_profile").groupBy("doc_id").agg(F.max("body_size").alias("body"))
    df = lines(spark, sf_dir, "x", "x_end", "font_size", "page_width").join(profile, "doc_id", "left")
    mid = pages.is_centered(F.col("x"), F.col("x_end"), F.col("text"), F.col("font_size"), F.col("page_width"))
    return df.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(pages.is_body_size(F.col("font_size"), F.col("body"))).alias("n_body"), F.count_if(mid).alias("n_centered"))


# --- trees ------------------------------------------------------------------------------


#: What the rules of transcripts do to the stack of open elements.
ACTIONS = {
    "SPEAKER": (("pop_to", "div", "body"), ("push", "note", {"type": "speaker"}), ("append",), ("pop",), ("push", "u", {"n": "{line_idx}"})),
    "HEAD": (("pop_to", "body"), ("push", "div", {"type": "section"}), ("push", "head"), ("append",), ("pop",)),
    "NOTE": (("push", "note"), ("append",), ("pop",)),
    "NUMBER": (("comment",),),
}


def trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = transcript(spark, sf_dir).withColumn("rule", line_rules().first_match(F.col("text")))
    return structure.build_trees(chunks, "doc_id", ["line_idx"], "rule", ACTIONS)


@query()
def stack_tree(spark, sf_dir):
    """Nodes of the trees of transcripts, from the stack automaton."""
    return trees(spark, sf_dir).withColumn("attrs", F.to_json("attrs"))


@query()
def serialize_xml(spark, sf_dir):
    return structure.serialized(trees(spark, sf_dir), "doc_id")


_TEXT = "regexp_matches(text, '\\S')"


@query(f"""WITH {SPOKEN}, M AS (SELECT *, {RULE} AS rule FROM T) SELECT doc_id, count(*) FILTER (rule = 'SPEAKER') AS speeches,
  CAST(sum(CASE WHEN rule IS DISTINCT FROM 'NUMBER' THEN len(regexp_extract_all(text, '\\S+')) ELSE 0 END) AS BIGINT) AS words FROM M GROUP BY doc_id""")
def speech_extents(spark, sf_dir):
    """Counted from the rules: what each does is known without its tree."""
    df = transcript(spark, sf_dir).withColumn("rule", line_rules().first_match(F.col("text")))
    words = F.when(F.col("rule").eqNullSafe("NUMBER"), 0).otherwise(F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)))
    return df.groupBy("doc_id").agg(F.count_if(F.col("rule") == "SPEAKER").alias("speeches"), F.sum(words).cast("long").alias("words"))


@query(f"""WITH {SPOKEN}, M AS (SELECT *, {RULE} AS rule FROM T) SELECT doc_id, tag, count(*) AS n FROM (SELECT DISTINCT doc_id, 'body' AS tag, 0 AS i FROM M UNION ALL SELECT doc_id, 'note', line_idx FROM M WHERE rule IN ('SPEAKER', 'NOTE')
  UNION ALL SELECT doc_id, 'u', line_idx FROM M WHERE rule = 'SPEAKER' UNION ALL SELECT doc_id, 'div', line_idx FROM M WHERE rule = 'HEAD' UNION ALL SELECT doc_id, 'head', line_idx FROM M WHERE rule = 'HEAD') GROUP BY ALL""")
def tag_usage(spark, sf_dir):
    """Elements that the rules open, counted before the shuffle."""
    opened = {rule: [a[1] for a in actions if a[0] == "push"] for rule, actions in ACTIONS.items()}
    df = transcript(spark, sf_dir).withColumn("rule", line_rules().first_match(F.col("text")))
    tags = F.create_map(*[x for rule, names in opened.items() for x in (F.lit(rule), F.array(*map(F.lit, names)) if names else F.expr("cast(array() as array<string>)"))])
    counts = df.groupBy("doc_id", "rule").agg(F.count("*").alias("n")).select("doc_id", "n", F.explode(tags[F.col("rule")]).alias("tag"))
    roots = df.select("doc_id", F.lit("body").alias("tag")).distinct().withColumn("n", F.lit(1).cast("long"))
    return counts.groupBy("doc_id", "tag").agg(F.sum("n").alias("n")).unionByName(roots)


@query(f"""WITH {SPOKEN}, M AS (SELECT doc_id, CAST(line_idx AS BIGINT) AS seq, CASE {RULE} WHEN 'HEAD' THEN 1 WHEN 'SPEAKER' THEN 2 ELSE 3 END AS lv FROM T)
  SELECT doc_id, seq, lv, greatest(CASE WHEN lv > 1 THEN max(CASE WHEN lv = 1 THEN seq END) OVER w END, CASE WHEN lv > 2 THEN max(CASE WHEN lv = 2 THEN seq END) OVER w END) AS parent_seq FROM M
  WINDOW w AS (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def level_tree(spark, sf_dir):
    rule = line_rules().first_match(F.col("text"))
    df = transcript(spark, sf_dir).select("doc_id", F.col("line_idx").cast("long").alias("seq"), F.when(rule == "HEAD", 1).when(rule == "SPEAKER", 2).otherwise(3).alias("lv"))
    return structure.level_tree(df, "doc_id", "seq", "lv")


@query("""SELECT p_partkey, p_type || '.' || p_brand || row_number() OVER (PARTITION BY p_type, p_brand ORDER BY p_partkey) AS id FROM part""")
def sequential_ids(spark, sf_dir):
    df = structure.sequential_ids(table(spark, sf_dir, "part"), ["p_type"], ["p_partkey"], F.col("p_brand"), F.col("p_type"))
    return df.select("p_partkey", "id")


@query("""SELECT p_partkey, CASE WHEN n = 1 THEN b ELSE b || '-' || n END AS id FROM (SELECT p_partkey, replace(p_name, ' ', '-') AS b, row_number() OVER (PARTITION BY replace(p_name, ' ', '-') ORDER BY p_partkey) AS n FROM part)""")
def unique_ids(spark, sf_dir):
    return structure.unique_ids(table(spark, sf_dir, "part"), [], ["p_partkey"], C.xml_id(F.col("p_name"))).select("p_partkey", "id")


_NOTES = """N AS (SELECT o_custkey AS doc, o_orderkey AS seq, CAST(o_orderkey % 5 + 1 AS INTEGER) AS number, CAST(o_orderkey % 7 AS INTEGER) AS page FROM orders)"""


def _definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), k.alias("seq"), (k % 5 + 1).cast("int").alias("number"), (k % 7).cast("int").alias("page"))


_NOTE_IDS = """I AS (SELECT *, row_number() OVER (PARTITION BY doc, number ORDER BY seq) AS rd, row_number() OVER (PARTITION BY doc, number, page ORDER BY seq) - CAST(page = first_value(page) OVER (PARTITION BY doc, number ORDER BY seq) AS INTEGER) AS k FROM N),
  F AS (SELECT doc, seq, number, page, CASE WHEN rd = 1 THEN 'note' || number WHEN k <= 1 THEN 'note' || number || '-p' || (page + 1) ELSE 'note' || number || '-p' || (page + 1) || '-' || k END AS id FROM I)"""


@query(f"WITH {_NOTES}, {_NOTE_IDS} SELECT doc, seq, id FROM F")
def footnote_ids(spark, sf_dir):
    return structure.footnote_ids(_definitions(spark, sf_dir), "doc", "number", "page", ["seq"]).select("doc", "seq", "id")


@query(f"""WITH {_NOTES}, {_NOTE_IDS}, G AS (SELECT doc, page, number, min(id) AS id FROM F GROUP BY ALL), X AS (SELECT l_orderkey, l_linenumber, o_custkey AS doc, CAST(l_orderkey % 7 AS INTEGER) AS page, l_linenumber AS number FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  SELECT X.l_orderkey, X.l_linenumber, '#' || id AS target, CASE WHEN id IS NULL THEN 'superscript' END AS rend FROM X LEFT JOIN G USING (doc, page, number)""")
def footnote_link(spark, sf_dir):
    ids = structure.footnote_ids(_definitions(spark, sf_dir), "doc", "number", "page", ["seq"])
    refs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("doc")), "l_orderkey")
    refs = refs.withColumn("page", (F.col("l_orderkey") % 7).cast("int")).withColumn("number", F.col("l_linenumber"))
    return structure.linked_footnotes(refs, ids, ["doc", "page", "number"]).select("l_orderkey", "l_linenumber", "target", "rend")


@query("""WITH T AS (SELECT c_custkey, unnest(['CUST' || c_custkey, '#NATION_' || c_nationkey, '#' || c_mktsegment]) AS t, unnest([0, 1, 2]) AS p FROM customer)
  SELECT c_custkey, string_agg(CASE WHEN n_nationkey IS NULL THEN t ELSE '#nation.' || n_nationkey END, ' ' ORDER BY p) AS refs FROM T LEFT JOIN nation ON n_name = regexp_replace(t, '^#', '') GROUP BY c_custkey""")
def reference_rewrite(spark, sf_dir):
    refs = F.concat_ws(" ", F.concat(F.lit("CUST"), "c_custkey"), F.concat(F.lit("#NATION_"), "c_nationkey"), F.concat(F.lit("#"), "c_mktsegment"))
    ids = table(spark, sf_dir, "nation").select(F.col("n_name").alias("raw"), F.concat(F.lit("nation."), "n_nationkey").alias("id"))
    return structure.rewritten_references(table(spark, sf_dir, "customer").select("c_custkey", refs.alias("refs")), ["c_custkey"], "refs", ids)


# --- names and identifiers -----------------------------------------------------------------


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.first_wins(table(spark, sf_dir, "batch_job"), ["job_source"], ["started_at", "status", "fingerprint"])


JOBS = "B AS (SELECT * FROM batch_job WHERE job_source IS NOT NULL QUALIFY row_number() OVER (PARTITION BY job_source ORDER BY started_at NULLS FIRST, status NULLS FIRST, fingerprint NULLS FIRST) = 1)"
_PLAIN = f"translate(title, '{C.MARKED}', '{C.PLAIN}')"


@query(f"""WITH {JOBS} SELECT job_source, coalesce(nullif(lower(regexp_replace(regexp_replace(regexp_replace({_PLAIN}, '[^\\x00-\\x7F]', '', 'g'), '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')), ''), 'corpus') AS slug,
  regexp_matches(job_group, '^[A-Za-z][A-Za-z0-9]*([._-][A-Za-z0-9]+)*$') AS good_prefix, CASE WHEN length(z) > 12 THEN left(z, 9) || '...' ELSE z END AS seen FROM (SELECT *, replace(replace(title, '\\', '\\\\'), chr(10), '\\n') AS z FROM B)""")
def identifiers(spark, sf_dir):
    return jobs(spark, sf_dir).where("job_source is not null").select("job_source", C.ascii_slug(F.col("title")).alias("slug"), C.valid_prefix(F.col("job_group")).alias("good_prefix"), C.visible(F.col("title"), 12).alias("seen"))


@query()
def component_stems(spark, sf_dir):
    """Names of documents in a corpus, with ids and safe file names."""
    t = F.col("title")
    return jobs(spark, sf_dir).select(
        "job_source", C.component_stem("Corpus", "sl", F.col("job_source"), C.first_date(t)).alias("stem"), C.short_slug(F.col("job_source")).alias("slug"),
        C.xml_id(t).alias("id"), C.safe_component(t).alias("file"), C.xml_safe(t).alias("text"),
    )


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders""")
def first_date(spark, sf_dir):
    """Dates written in four ways, found in text."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    names = ["januar", "februarja", "ožujka", "april", "maja", "lipnja", "julija", "august", "septembra", "listopada", "november", "decembra"]
    named = F.concat_ws(" ", F.concat(F.dayofmonth(d), F.lit(".")), F.element_at(F.array(*map(F.lit, names)), F.month(d)), F.year(d).cast("string"))
    ways = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "d. M. yyyy")).when(k == 2, named).otherwise(F.concat(F.lit("31. 2. 1950 / "), F.date_format(d, "d.M.yyyy")))
    text = F.concat(F.lit("Zapisnik 12 seje dne "), ways, F.lit(", potem 1.1.2001"))
    return table(spark, sf_dir, "orders").select("o_orderkey", C.first_date(text).alias("date"))


@query(f"""WITH {JOBS} SELECT job_source, CASE WHEN contains(job_source, '/../') THEN NULL ELSE 'a/' || regexp_replace(job_source, '/+', '/', 'g') END AS path FROM B""")
def menu_path(spark, sf_dir):
    url = F.concat(F.lit("https://menu.example.org/x/menu/a/"), F.replace(F.col("job_source"), F.lit(" "), F.lit("%20")))
    df = jobs(spark, sf_dir).where("job_source is not null").select("job_source", C.menu_path(url, "menu.example.org").alias("path"))
    return df.withColumn("path", F.replace("path", F.lit("%20"), F.lit(" ")))


# --- speakers -------------------------------------------------------------------------------


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "speaker_detail").select("label").where("label is not null").distinct()


_OFFICES = "podpredsedni|predsedni|predsedujoč|predsjedni|minist|sekretar|poročeval|poslan|delegat|tajni|zastopni|član"
_BEFORE = "^(?:pod)?(?:predsednik|predsednica|predsedujoči|predsedujoča|predsjednik|predsednikov[0-9A-Za-z_]*|tajnik|minister|poročevalec|sekretar)\\s+"
DETAILS = rf"""A AS (SELECT DISTINCT label FROM speaker_detail WHERE label IS NOT NULL), A1 AS (SELECT label, regexp_replace(label, '\s*\([^()]*\)\s*:?\s*$|:\s*$', '') AS bare,
    nullif(regexp_extract(label, '\(([^()]+)\)\s*:?\s*$', 1), '') AS organization FROM A),
  A2 AS (SELECT *, trim(regexp_extract(bare, ',\s*(.+)$', 1)) AS tail, nullif(trim(regexp_extract(bare, '(?i){_BEFORE}')), '') AS before FROM A1),
  A3 AS (SELECT *, coalesce(before, CASE WHEN regexp_matches(tail, '(?i)({_OFFICES})') THEN tail END) AS role, CASE WHEN regexp_matches(regexp_extract(bare, ',\s*(.+)$', 1), '(?i)({_OFFICES})') THEN regexp_replace(bare, ',.*$', '') ELSE bare END AS b2 FROM A2),
  A4 AS (SELECT label, role, organization, trim(regexp_replace(regexp_replace(regexp_replace(b2, '(?i){_BEFORE}', ''), '(?i)^(?:(?:mag|dr|prof|inž|ing|tov|mr)\.\s*)+', ''), '\s+', ' ', 'g')) AS lookup_name FROM A3)"""


@query(f"""WITH {DETAILS} SELECT label, role, organization, lookup_name, CASE WHEN contains(lookup_name, ' ') THEN split_part(lookup_name, ' ', 1) ELSE '' END AS forename,
  CASE WHEN contains(lookup_name, ' ') THEN regexp_replace(lookup_name, '^\\S+\\s+', '') ELSE lookup_name END AS surname FROM A4""")
def speaker_details(spark, sf_dir):
    return speakers.details(labels(spark, sf_dir), "label").select("label", "role", "organization", "lookup_name", "forename", "surname")


@query(f"""WITH {DETAILS} SELECT coalesce(nullif(regexp_replace(lower(CASE WHEN regexp_extract(role, '(?i)({_OFFICES})\\p{{L}}*') <> '' THEN regexp_extract(role, '(?i)({_OFFICES})\\p{{L}}*') ELSE regexp_extract(role, '^\\s*(\\S+)', 1) END), '[^\\p{{L}}\\p{{N}}.\\-]', '', 'g'), ''), 'member') AS role_value,
  count(*) AS n FROM A4 GROUP BY 1""")
def role_values(spark, sf_dir):
    return labels(spark, sf_dir).groupBy(C.role_value(C.label_role(F.col("label"))).alias("role_value")).agg(F.count("*").alias("n"))


@query("""WITH S AS (SELECT DISTINCT * FROM speaker_mapping WHERE speaker_ref IS NOT NULL AND label IS NOT NULL), N AS (SELECT *, length(regexp_replace(label, '[\\p{L}\\s.,()\\-:'']', '', 'g')) AS noise,
    regexp_matches(label, '\\([^()]+\\)\\s*:?\\s*$') OR regexp_matches(regexp_replace(label, '\\s*\\([^()]*\\)\\s*:?\\s*$|:\\s*$', ''), '(?i)^(?:pod)?(?:predsednik|predsednica|predsedujoči|predsedujoča|predsjednik|tajnik|minister|poročevalec|sekretar)\\s+') AS has FROM S)
  SELECT doc_id, speaker_ref, label, n FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, speaker_ref) AS n, row_number() OVER (PARTITION BY doc_id, speaker_ref ORDER BY noise, has DESC, length(label), ord) AS r FROM N) WHERE r = 1""")
def merge_speakers(spark, sf_dir):
    mapping = table(spark, sf_dir, "speaker_mapping").distinct()
    return speakers.merged_mapping(mapping, "speaker_ref", "label", F.col("ord"), ["doc_id"])


@query()
def merge_speakers_similarity(spark, sf_dir):
    """As merge_speakers, the label most like the ref first."""
    return speakers.merged_mapping(table(spark, sf_dir, "speaker_mapping").distinct(), "speaker_ref", "label", F.col("ord"), ["doc_id"], similar=True)


@query()
def alias_clusters(spark, sf_dir):
    """Refs of each transcript grouped by similar spelling."""
    return speakers.alias_clusters(table(spark, sf_dir, "speaker_mapping"), "doc_id", "speaker_ref", "ord")


_ORG = """CASE WHEN organization IS NULL THEN 'org.UnknownOrganization' ELSE 'org.' || (SELECT CASE WHEN z = '' THEN 'UnknownOrganization' WHEN regexp_matches(z, '^[\\p{L}_]') THEN z ELSE 'UnknownOrganization-' || z END
  FROM (SELECT regexp_replace(regexp_replace(regexp_replace(trim(organization), '[^\\p{L}\\p{N}_.\\-]', '-', 'g'), '-+', '-', 'g'), '^-+|-+$', '', 'g') AS z)) END"""


@query(f"""SELECT org_id, arg_min(coalesce(organization, 'Unknown organization'), speaker_id) AS name FROM (SELECT *, {_ORG} AS org_id FROM (SELECT speaker_id, min(organization) AS organization FROM speaker_detail GROUP BY 1)) GROUP BY org_id""")
def list_org(spark, sf_dir):
    rows = table(spark, sf_dir, "speaker_detail").groupBy("speaker_id").agg(F.min("organization").alias("organization"))
    return speakers.list_org(rows, "organization", F.col("speaker_id"))


@query("""WITH S AS (SELECT DISTINCT doc_id, speaker_ref, label FROM speaker_mapping) SELECT doc_id, regexp_replace(speaker_ref, '^#', '') AS id, trim(regexp_replace(split_part(label, ':', 1), '\\s+', ' ', 'g')) AS name,
  nullif(regexp_extract(label, '\\(([^()]+)\\)\\s*:?\\s*$', 1), '') AS organization FROM S""")
def list_person(spark, sf_dir):
    mapping = table(spark, sf_dir, "speaker_mapping").select("doc_id", "speaker_ref", "label").distinct()
    return speakers.list_person(mapping, ["doc_id"], "speaker_ref", "label").select("doc_id", "id", "name", "organization")


@query("""WITH B AS (SELECT DISTINCT * FROM person_binding WHERE p IS NOT NULL) SELECT p, arg_max(p_label, (length(p_label), p_label)) AS name, min(CASE WHEN lower(sex_label) IN ('moški', 'male', 'muški') THEN 'M' WHEN lower(sex_label) IN ('ženski', 'female', 'ženska') THEN 'F' ELSE 'U' END) AS sex,
  array_to_string(list_sort(list(DISTINCT split_part(birth, 'T', 1)) FILTER (birth IS NOT NULL)), '|') AS births, array_to_string(list_sort(list(DISTINCT split_part(death, 'T', 1)) FILTER (death IS NOT NULL)), '|') AS deaths,
  array_to_string(list_sort(list(DISTINCT occ_label) FILTER (occ_label IS NOT NULL)), '|') AS occupations, array_to_string(list_sort(list(DISTINCT citizen_label) FILTER (citizen_label IS NOT NULL)), '|') AS nationalities, array_to_string(list_sort(list(DISTINCT viaf) FILTER (viaf IS NOT NULL)), '|') AS viaf,
  array_to_string(list_sort(list(DISTINCT gnd) FILTER (gnd IS NOT NULL)), '|') AS gnd, array_to_string(list_sort(list(DISTINCT isni) FILTER (isni IS NOT NULL)), '|') AS isni, count(DISTINCT (party_label, party)) AS affiliations, count(*) AS n FROM B GROUP BY p""")
def person_records(spark, sf_dir):
    df = speakers.person_records(table(spark, sf_dir, "person_binding").distinct())
    text = lambda c: F.when(F.size(c) > 0, F.array_join(c, "|"))
    listed = ("births", "deaths", "occupations", "nationalities", "viaf", "gnd", "isni")
    return df.select("p", "name", "sex", *[text(c).alias(c) for c in listed], F.size("affiliations").alias("affiliations"), "n")


@query(f"""WITH {SPOKEN}, M AS (SELECT doc_id, line_idx, CASE WHEN {RULE} = 'SPEAKER' THEN split_part(text, ':', 1) END AS s FROM T)
  SELECT doc_id, line_idx, nullif(count(s) OVER w, 0) AS utterance, last_value(s IGNORE NULLS) OVER w AS who FROM M WINDOW w AS (PARTITION BY doc_id ORDER BY line_idx)""")
def utterances(spark, sf_dir):
    rule = line_rules().first_match(F.col("text"))
    df = speakers.utterances(transcript(spark, sf_dir).withColumn("block", F.floor(F.col("line_idx") / 64)), "doc_id", "block", ["line_idx"], F.when(rule == "SPEAKER", F.substring_index("text", ":", 1)))
    return df.select("doc_id", "line_idx", "utterance", "who")


# --- corpora ----------------------------------------------------------------------------------


def sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").select("doc_id", "job_source", "n_chars", F.regexp_count("text", F.lit(r"\S+")).cast("long").alias("words"))
    return df.where("job_source is not null")


_FOLDERS = "X AS (SELECT job_source, n_chars, len(regexp_extract_all(text, '\\S+')) AS w, regexp_extract(job_source, '^(.*)/[^/]*$', 1) AS own FROM documents WHERE job_source IS NOT NULL)"


@query(f"""WITH {_FOLDERS}, Y AS (SELECT *, list_filter(string_split(own, '/'), lambda p: p <> '') AS parts FROM X), Z AS (SELECT *, unnest(generate_series(0, len(parts))) AS i FROM Y)
  SELECT CASE WHEN i = 0 THEN '' ELSE array_to_string(parts[1:i], '/') END AS folder, CAST(i AS INTEGER) AS depth, count(*) AS texts, CAST(sum(n_chars) AS BIGINT) AS n_chars, CAST(sum(w) AS BIGINT) AS words FROM Z GROUP BY ALL""")
def subtree_rollup(spark, sf_dir):
    return corpus.rollup(sized(spark, sf_dir), "job_source", ["n_chars", "words"])


_SUBTREES = f"""{_FOLDERS}, Y AS (SELECT *, list_filter(string_split(own, '/'), lambda p: p <> '') AS parts FROM X), Z AS (SELECT *, unnest(generate_series(0, len(parts))) AS i FROM Y),
  T AS (SELECT CASE WHEN i = 0 THEN '' ELSE array_to_string(parts[1:i], '/') END AS folder, count(*) AS texts, CAST(sum(w) AS BIGINT) AS words FROM Z GROUP BY ALL)"""


@query(f"""WITH {_SUBTREES} SELECT folder, '<extent><measure unit="texts" quantity="' || texts || '"/>' || CASE WHEN words > 0 THEN '<measure unit="words" quantity="' || words || '"/>' ELSE '' END || '</extent>' AS header FROM T""")
def corpus_headers(spark, sf_dir):
    return corpus.extent_header(corpus.rollup(sized(spark, sf_dir), "job_source", ["words"]), "folder", {"texts": "texts", "words": "words"})


def _xml(text: str) -> str:
    return f"replace(replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


@query(f"""WITH {_SUBTREES}, C AS (SELECT own AS folder, string_agg('<xi:include href="' || {_xml("h")} || '"/>', '' ORDER BY h) AS links FROM (SELECT DISTINCT own, CASE WHEN own = '' THEN job_source ELSE substr(job_source, length(own) + 2) END AS h FROM X) GROUP BY own)
  SELECT folder, '<teiCorpus><teiHeader><fileDesc><extent><measure unit="texts" quantity="' || texts || '"/>' || CASE WHEN words > 0 THEN '<measure unit="words" quantity="' || words || '"/>' ELSE '' END || '</extent></fileDesc></teiHeader><particDesc><xi:include href="listOrg.xml"/><xi:include href="listPerson.xml"/></particDesc>'
  || coalesce(links, '') || '</teiCorpus>' AS xml FROM T LEFT JOIN C USING (folder)""")
def corpus_files(spark, sf_dir):
    """A corpus file for every folder: its subtree's totals, its own documents."""
    totals = corpus.rollup(sized(spark, sf_dir), "job_source", ["words"])
    own = corpus.folder_of(F.col("job_source"))
    children = table(spark, sf_dir, "documents").where("job_source is not null").select(own.alias("folder"), headers.relative(F.col("job_source"), own).alias("href")).distinct()
    return headers.corpus_files(totals, children)


@query(f"""WITH {JOBS} SELECT job_source, '<teiHeader><fileDesc><titleStmt><title xml:lang="' || {_xml("coalesce(corpus_language, 'und')")} || '">' || {_xml("coalesce(nullif(trim(title), ''), job_source)")} || '</title>'
  || CASE WHEN len(group_labels) > 0 THEN '<title type="sub">' || {_xml("array_to_string(group_labels, ' / ')")} || '</title>' ELSE '' END || '</titleStmt><extent><measure unit="texts" quantity="1"/></extent><publicationStmt/><sourceDesc/></fileDesc><profileDesc>'
  || CASE WHEN corpus_language IS NOT NULL THEN '<langUsage><language ident="' || {_xml("corpus_language")} || '"/></langUsage>' ELSE '' END || '</profileDesc></teiHeader>' AS header FROM B""")
def document_headers(spark, sf_dir):
    """The header of every job: title (or its source), labels, extent, language."""
    titles = F.create_map(F.coalesce("corpus_language", F.lit("und")), headers.enriched(F.col("title"), F.col("job_source")))
    sub = F.when(F.size("group_labels") > 0, F.array_join("group_labels", " / "))
    made = headers.header(titles, sub, F.lit(""), F.lit(1), F.lit(0), F.lit(0), F.lit(None).cast("date"), F.col("corpus_language"))
    return jobs(spark, sf_dir).where("job_source is not null").select("job_source", made.alias("header"))


@query(f"""WITH {JOBS}, X AS (SELECT job_group, status AS kind, title AS text, min(job_source) AS o FROM B WHERE title IS NOT NULL AND job_group IS NOT NULL AND status IS NOT NULL GROUP BY ALL), N AS (SELECT *, row_number() OVER (PARTITION BY job_group ORDER BY o, kind, text) AS n FROM X)
  SELECT job_group, '<notesStmt>' || string_agg('<note type="' || {_xml("kind")} || '" n="' || n || '">' || {_xml("text")} || '</note>', '' ORDER BY n) || '</notesStmt>' AS notes FROM N GROUP BY job_group""")
def conversion_notes(spark, sf_dir):
    rows = jobs(spark, sf_dir).where("job_group is not null and status is not null and job_source is not null")
    return headers.conversion_notes(rows, "job_group", "status", "title", "job_source")


@query(f"""WITH {JOBS}, N AS (SELECT job_source, {_xml("job_source")} AS s, {_xml("coalesce(title, 'failed')")} AS m FROM B WHERE status = 'failed')
  SELECT job_source, '<TEI><teiHeader><fileDesc><titleStmt><title>' || s || '</title></titleStmt><notesStmt><note type="recovery" n="1">' || m || '</note></notesStmt></fileDesc></teiHeader><text><body><p type="unparsed">' || m || '</p></body></text></TEI>' AS xml FROM N""")
def failure_documents(spark, sf_dir):
    failed = jobs(spark, sf_dir).where("status = 'failed' and job_source is not null")
    return failed.select("job_source", headers.failure_document(F.col("job_source"), F.coalesce("title", F.lit("failed"))).alias("xml"))


@query()
def person_lists(spark, sf_dir):
    """The list of persons of every transcript."""
    return headers.list_person(table(spark, sf_dir, "speaker_mapping").select("doc_id", "speaker_ref", "label").distinct(), ["doc_id"], "speaker_ref", "label")


@query()
def body_lists(spark, sf_dir):
    """The list of bodies of every transcript."""
    rows = table(spark, sf_dir, "speaker_detail").groupBy("speaker_id").agg(F.min("doc_id").alias("doc_id"), F.min("organization").alias("organization"))
    return headers.list_org(rows, ["doc_id"], "organization", F.col("speaker_id"))


@query()
def register_entries(spark, sf_dir):
    """Persons of the register with all that is known of them."""
    return headers.person_entries(speakers.person_records(table(spark, sf_dir, "person_binding").distinct()))


@query(f"""WITH {_FOLDERS}, Y AS (SELECT DISTINCT list_filter(string_split(own, '/'), lambda p: p <> '') AS parts FROM X), Z AS (SELECT DISTINCT array_to_string(parts[1:i], '/') AS folder, i AS depth FROM (SELECT parts, unnest(generate_series(1, len(parts))) AS i FROM Y)),
  P AS (SELECT folder, depth, regexp_extract(folder, '^(.*)/[^/]*$', 1) AS parent FROM Z) SELECT a.folder, a.parent, CAST(a.depth AS INTEGER) AS depth, count(b.folder) AS n_children FROM P a LEFT JOIN P b ON b.parent = a.folder GROUP BY ALL""")
def folder_tree(spark, sf_dir):
    return corpus.folder_tree(table(spark, sf_dir, "documents").where("job_source is not null"), "job_source")


@query("""SELECT n.n_name AS nation, r.r_name AS region, count(*) AS texts, CAST(sum(o.o_totalprice * 100) AS BIGINT) AS cents FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey GROUP BY ALL""")
def region_rollup(spark, sf_dir):
    """Totals of orders by nation and region; the small tables are broadcast
    by their size, orders are summed by customer before the join."""
    sums = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("texts"), F.sum(F.col("o_totalprice") * 100).alias("cents"))
    df = sums.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    df = df.groupBy("c_nationkey").agg(F.sum("texts").alias("texts"), F.sum("cents").alias("cents"))
    df = df.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return df.select(F.col("n_name").alias("nation"), F.col("r_name").alias("region"), "texts", F.round("cents").cast("long").alias("cents"))


@query(f"""WITH {JOBS}, C AS (SELECT *, CASE status WHEN 'success' THEN 'ok' ELSE status END AS s FROM B) SELECT job_group, count(*) FILTER (s = 'ok') AS ok, count(*) FILTER (s = 'recovered') AS recovered, count(*) FILTER (s = 'failed') AS failed,
  count(*) FILTER (s = 'skipped') AS skipped, count(*) AS total FROM C GROUP BY job_group""")
def manifest_counts(spark, sf_dir):
    df = jobs(spark, sf_dir).where("job_source is not null").withColumn("status", F.when(F.col("status") == "success", "ok").otherwise(F.col("status")))
    return corpus.manifest(df, ["job_group"])


@query(f"""WITH {JOBS}, D AS (SELECT job_source, sha256(concat_ws(chr(31), job_source, coalesce(title, chr(0)), coalesce(corpus_language, chr(0)))) AS fp, job_group IS NOT NULL AS written, status FROM B),
  N AS (SELECT DISTINCT job_source, sha256(concat_ws(chr(31), job_source, coalesce(title, chr(0)), coalesce(corpus_language, chr(0)))) AS fp FROM (SELECT job_source, CASE WHEN length(job_source) % 2 = 0 THEN title ELSE upper(title) END AS title, corpus_language FROM B))
  SELECT N.job_source FROM N WHERE NOT EXISTS (SELECT 1 FROM D WHERE D.job_source = N.job_source AND D.fp = N.fp AND D.written AND D.status = 'success')""")
def incremental_skip(spark, sf_dir):
    """Jobs that must run: no successful run with the fingerprint of today's
    inputs whose output is there. Today every other title has changed."""
    every = jobs(spark, sf_dir).where("job_source is not null")
    key = lambda title: corpus.fingerprint(F.col("job_source"), title, F.col("corpus_language"))
    done = every.select("job_source", key(F.col("title")).alias("fingerprint"), "status", F.col("job_group").isNotNull().alias("written"))
    title = F.when(F.length("job_source") % 2 == 0, F.col("title")).otherwise(F.upper("title"))
    wanted = every.select("job_source", key(title).alias("fingerprint")).distinct()
    return corpus.pending(wanted, done, "job_source", ("success",), "written").select("job_source")


@query(f"""WITH {JOBS} SELECT job_source FROM B WHERE job_source NOT IN (SELECT job_source FROM documents WHERE job_source IS NOT NULL) AND status IS DISTINCT FROM 'failed'""")
def stale_outputs(spark, sf_dir):
    every = jobs(spark, sf_dir).where("job_source is not null")
    wanted = table(spark, sf_dir, "documents").select("job_source").where("job_source is not null").distinct()
    return corpus.stale(every.select("job_source"), wanted, every.where("status = 'failed'"), "job_source")


@query(f"""WITH {JOBS} SELECT job_source, status, fingerprint FROM B""")
def dedup_first_wins(spark, sf_dir):
    return jobs(spark, sf_dir).where("job_source is not null").select("job_source", "status", "fingerprint")


@query("""SELECT source, lang, CAST(row_number() OVER (PARTITION BY source ORDER BY f, lang) AS INTEGER) AS ord FROM (SELECT source, lang, min(doc_id) AS f FROM documents WHERE lang IS NOT NULL GROUP BY ALL)""")
def ordered_unique(spark, sf_dir):
    return corpus.ordered_unique(table(spark, sf_dir, "documents").select("source", "lang", "doc_id"), ["source"], "lang", "doc_id")


@query(f"""WITH {JOBS} SELECT job_group, count(*) AS n, string_agg('<xi:include href="' || job_source || '"/>', chr(10) ORDER BY job_source) AS body FROM B GROUP BY job_group""")
def xinclude_list(spark, sf_dir):
    return corpus.includes(jobs(spark, sf_dir).where("job_source is not null"), "job_group", "job_source", F.col("job_source"))


@query(f"""WITH {JOBS}, M AS (SELECT job_source, list_filter(group_labels, lambda x: regexp_matches(lower(x), 'sklic|mandat|zasedanj|sej|sednic|sjednic|session')) AS f FROM B), N AS (SELECT job_source, f[len(f)] AS label FROM M) SELECT job_source, label, nullif(regexp_extract(label, '^\\s*([0-9]+)', 1), '') AS number FROM N""")
def meeting_labels(spark, sf_dir):
    df = jobs(spark, sf_dir).where("job_source is not null").select("job_source", corpus.meeting_label(F.col("group_labels")).alias("label"))
    return df.withColumn("number", corpus.meeting_number(F.col("label")))


@query(f"""WITH {JOBS} SELECT job_source, row_number() OVER (ORDER BY lower(job_source), job_source) AS place FROM B""")
def job_order(spark, sf_dir):
    """Jobs in discovery order; their places come from the sorted ranges."""
    df = batch.ordered_jobs(jobs(spark, sf_dir).where("job_source is not null"), "job_source", "job_source").select("job_source", "ord")
    earlier = F.count("*").over(Window.orderBy("ord"))  # one row per job of a batch
    return df.select("job_source", earlier.alias("place"))


@query(f"""WITH {JOBS}, R AS (SELECT CASE WHEN contains(job_source, '/') THEN split_part(job_source, '/', 1) ELSE '' END AS root, count(*) AS n FROM B GROUP BY 1) SELECT root, n FROM R WHERE root = '' OR NOT EXISTS (SELECT 1 FROM R WHERE root = '')""")
def source_roots(spark, sf_dir):
    return batch.source_roots(jobs(spark, sf_dir).where("job_source is not null"), "job_source")


@query(f"""WITH {JOBS} SELECT job_source, 'out' || CASE WHEN coalesce(job_group, '') = '' THEN '' ELSE '/' || job_group END || '/' || t || '.xml' AS xml, 'audit' || CASE WHEN coalesce(job_group, '') = '' THEN '' ELSE '/' || job_group END || '/' || t AS metadata,
  'audit' || CASE WHEN coalesce(job_group, '') = '' THEN '' ELSE '/' || job_group END || '/' || t || '/listPerson.xml' AS list FROM (SELECT *, coalesce(title, 'untitled') AS t FROM B)""")
def output_paths(spark, sf_dir):
    where = batch.outputs("out", F.col("job_group"), F.coalesce("title", F.lit("untitled")), "audit")
    return jobs(spark, sf_dir).where("job_source is not null").select("job_source", *[c.alias(k) for k, c in where.items()])


@query()
def unique_paths(spark, sf_dir):
    """Paths of jobs within the budget, none twice."""
    df = batch.unique_paths(jobs(spark, sf_dir).where("job_source is not null"), ["job_source"], "/srv/out", F.col("job_group"), F.coalesce("title", F.lit("untitled")))
    return df.select("job_source", "path")


@query(f"""WITH {JOBS} SELECT job_source, CASE WHEN regexp_matches(job_group, '^[A-Za-z][A-Za-z0-9]*([._-][A-Za-z0-9]+)*$') AND regexp_matches(corpus_language, '^[A-Za-z]{{{{2}}}}(-[A-Za-z0-9]+)*$') THEN job_group || '-' || upper(corpus_language) END AS corpus,
  coalesce(TRY_CAST(elapsed_seconds AS BIGINT), 0) AS seconds FROM B""".replace("{{2}}", "{2}"))
def corpus_names(spark, sf_dir):
    """Names of corpora, and counters that may be no numbers."""
    df = jobs(spark, sf_dir).where("job_source is not null")
    return df.select("job_source", batch.corpus_name(F.col("job_group"), F.col("corpus_language")).alias("corpus"), batch.counted(F.round("elapsed_seconds")).alias("seconds"))


@query("""SELECT label, array_to_string(list_transform(range(1, length(label) + 1), lambda i: CASE WHEN i > 1 AND regexp_matches(label[i - 1], '^\\p{L}$') THEN lower(label[i]) ELSE upper(label[i]) END), '') AS titled,
  coalesce(length(regexp_replace(regexp_extract(label, '\\(([^)]*)\\)', 1), '[^\\p{L}\\p{N}]', '', 'g')) BETWEEN 1 AND 4, false) AS compact FROM (SELECT DISTINCT label FROM speaker_detail WHERE label IS NOT NULL)""")
def title_cases(spark, sf_dir):
    return labels(spark, sf_dir).select("label", C.title_case(F.col("label")).alias("titled"), C.compact_qualifier(F.col("label")).alias("compact"))


@query(f"""WITH {LINES} SELECT doc_id, count(*) AS n_lines, count(*) FILTER (x = m) AS at_left FROM (SELECT *, min(x) OVER (PARTITION BY doc_id, page_num) AS m FROM L) GROUP BY doc_id""")
def page_left(spark, sf_dir):
    """Lines that stand at their page's left edge."""
    df = volumes.placed(lines(spark, sf_dir, "x", "y").withColumn("t", C.squeezed(F.col("text"))))
    return df.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(F.col("x") == F.col("left")).alias("at_left"))


@query(f"""WITH {JOBS} SELECT job_group, CAST(greatest(coalesce(sum(TRY_CAST(elapsed_seconds AS BIGINT)), 0), coalesce(max(len(group_labels)), 0)) AS BIGINT) AS recovery_count FROM B GROUP BY job_group""")
def recovery_counts(spark, sf_dir):
    df = jobs(spark, sf_dir).where("job_source is not null").withColumn("n", F.round("elapsed_seconds").cast("long"))
    return batch.recoveries(df, ["job_group"], "n", "group_labels")


# --- events -------------------------------------------------------------------------------------


@query("""SELECT event_type, date_trunc('hour', ts) AS start, count(*) AS n FROM events GROUP BY ALL""")
def event_windows(spark, sf_dir):
    return windowed_counts(table(spark, sf_dir, "events"), "ts", ["event_type"])


@query("""WITH G AS (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 30 MINUTE, false) AS g FROM events), S AS (SELECT *, sum(CAST(g AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM G)
  SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM S GROUP BY user_id, s""")
def event_sessions(spark, sf_dir):
    return sessions(table(spark, sf_dir, "events"), "ts", "user_id")
