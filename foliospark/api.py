"""Documents from lines to bundles of files: the way through the operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.columns import safe_component, speaker_ref
from .operators import headers, structure
from .plans import cascade, rules
from .sources import writers


@dataclass
class Result:
    """What a rule set made of lines: `lines` (doc_id, place, rule, nodes).
    Every view is lazy; nothing runs before it is written or shown."""

    lines: DataFrame
    warnings: DataFrame | None = None
    hooks: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    def nodes(self) -> DataFrame:
        out = self.lines.select("doc_id", F.explode("nodes").alias("n")).select("doc_id", "n.*")
        return self.hooks["on_end"](out) if "on_end" in self.hooks else out

    def diagnostics(self) -> DataFrame:
        """doc_id, rule, n; lines without a rule are UNMATCHED."""
        return rules.rule_counts(self.lines, ["doc_id"], "rule")

    def speakers(self) -> DataFrame:
        """doc_id, speaker_ref, label, n: who speaks, and in how many utterances."""
        return usage(self.nodes())

    def documents(self, head: DataFrame | None = None) -> DataFrame:
        """doc_id, xml: whole documents; `head` has doc_id and header."""
        body = structure.serialized(self.nodes(), "doc_id")
        head = body.select("doc_id", F.lit("<teiHeader/>").alias("header")) if head is None else head
        text = F.concat(F.lit("<TEI>"), F.coalesce("header", F.lit("<teiHeader/>")), F.lit("<text>"), "xml", F.lit("</text></TEI>"))
        return body.join(head, "doc_id", "left").select("doc_id", text.alias("xml"))

    def bundles(self, head: DataFrame | None = None) -> DataFrame:
        """name, text of all files of all bundles: the document, diagnostics and
        data as JSON, and the list of persons where somebody speaks."""
        at = lambda name: F.concat(safe_component(F.col("doc_id")), F.lit("/"), F.lit(name))
        xml = self.documents(head).select(F.concat(safe_component(F.col("doc_id")), F.lit("/document.xml")).alias("name"), F.col("xml").alias("text"))
        counts = self.diagnostics().groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("rule", "n")))).alias("rules"))
        diagnostics = counts.select(at("diagnostics.json").alias("name"), F.to_json(F.struct("doc_id", "rules")).alias("text"))
        people = self.speakers()
        data = people.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("speaker_ref", "label")))).alias("speakers"))
        data = data.select(at("data.json").alias("name"), F.to_json(F.struct(F.struct("speakers").alias("data"))).alias("text"))
        lists = headers.list_person(people, ["doc_id"], "speaker_ref", "label").select(at("listPerson.xml").alias("name"), F.col("xml").alias("text"))
        return xml.unionByName(diagnostics).unionByName(data).unionByName(lists)

    def write(self, folder: str, head: DataFrame | None = None) -> DataFrame:
        """Write all bundles below a folder that all executors share; name,
        bytes of what was written (an action is needed to write)."""
        return writers.write_files(self.bundles(head), "name", "text", folder)


def usage(nodes: DataFrame) -> DataFrame:
    """doc_id, speaker_ref, label, n: utterances of everybody who speaks."""
    talk = nodes.where("tag = 'u'").select("doc_id", F.col("attrs")["who"].alias("label")).where("label is not null")
    return talk.withColumn("speaker_ref", speaker_ref(F.col("label"))).groupBy("doc_id", "speaker_ref").agg(F.mode("label", True).alias("label"), F.count("*").alias("n"))


def canonical(nodes: DataFrame, leaders: DataFrame) -> DataFrame:
    """Utterances' `who` by the leader of its group (doc_id, who, leader)."""
    who = nodes.join(leaders.select("doc_id", F.col("who").alias("__who"), "leader"), (nodes["doc_id"] == leaders["doc_id"]) & (nodes["attrs"]["who"] == F.col("__who")), "left").drop(leaders["doc_id"])
    changed = F.when((F.col("tag") == "u") & F.col("leader").isNotNull(), F.map_concat(F.map_filter("attrs", lambda k, v: k != "who"), F.create_map(F.lit("who"), "leader"))).otherwise(F.col("attrs"))
    return who.select(*[changed.alias("attrs") if c == "attrs" else F.col(c) for c in nodes.columns])


def with_register(people: DataFrame, bindings: DataFrame, name: str) -> DataFrame:
    """Persons with the register's record of their name, if there is one."""
    records = bindings.where("p is not null").groupBy(F.lower("search_name").alias("__name")).agg(F.min("p").alias("p"))
    return people.join(records, F.lower(name) == F.col("__name"), "left").drop("__name")


def parse(lines: DataFrame, profiles: DataFrame, hooks: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> Result:
    """Lines of documents through the general cascade. Hooks: `on_start` of
    the lines, `on_end` of the nodes."""
    hooks = hooks or {}
    lines = hooks["on_start"](lines) if "on_start" in hooks else lines
    return Result(cascade.classified(lines, profiles), hooks=hooks)
